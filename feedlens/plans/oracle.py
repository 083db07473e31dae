"""Independent SQL (DuckDB dialect) for every checked query.

Each step of the Spark flow has a CTE here, written from the same specification but
with SQL idioms (unnest + join + group by instead of higher-order functions, window
ranks instead of max_by), so that agreement means the semantics agree, not the code.
NFKC is not available in DuckDB; the driver's text contains no character that NFKC
changes, so the oracle's comment key leaves it out.
"""

from __future__ import annotations

import re

from ..fixed import (CATEGORY_KEYWORDS, LANG_NAMES_LENIENT, LANG_NAMES_STRICT, LANG_ORDER, LANG_ORDER_LENIENT,
                     LANGUAGE_PROFILES, NEGATIVE_TAXONOMY, POSITIVE_TAXONOMY, SENTIMENT_LEXICON, STOPWORDS_DEFAULT,
                     STOPWORDS_EXTRA, BLOCKING_PATTERN, LOW_SIGNAL_PHRASES)
from ..functions.text import NON_WS_RUN, WORD_TOKEN, WS
from ..operators.language import profile_weights
from ..sources.tables import DATE_BASE, N_COURSES
from .flows import RESUME_CUTOFF


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def s_trim(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def s_collapse(x: str) -> str:
    return f"array_to_string(regexp_extract_all({x}, '{NON_WS_RUN}'), ' ')"


def s_wc(x: str) -> str:
    return f"CAST(len(regexp_extract_all(coalesce({x}, ''), '{NON_WS_RUN}')) AS BIGINT)"


def s_tokens(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), '{WORD_TOKEN}')"


def s_norm(x: str) -> str:
    tr = f"translate(coalesce({x}, ''), {q(chr(0x2018) + chr(0x2019) + chr(0x201c) + chr(0x201d))}, {q(chr(39) * 2 + chr(34) * 2)})"
    return s_collapse(f"lower(replace({tr}, '\\', ''))")


def s_norm_simple(x: str) -> str:
    return s_collapse(f"lower(coalesce({x}, ''))")


def s_sent_key(x: str) -> str:
    k = f"lower({s_trim(f'coalesce({x}, {q('neutral')})')})"
    return f"(CASE WHEN {k} IN ('positive', 'negative') THEN {k} ELSE 'neutral' END)"


def _values(rows, cols) -> str:
    def lit(v):
        if isinstance(v, str):
            return q(v)
        if isinstance(v, list):
            return "[" + ", ".join(q(x) for x in v) + "]"
        return str(v)
    body = ",\n    ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def _date_expr() -> str:
    return (f"strftime(DATE '{DATE_BASE}' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d') || "
            "CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'T10:00:00' ELSE ' 10:00:00' END")


def _raw_cols() -> str:
    return (f"'course_' || CAST(doc_id % {N_COURSES} AS VARCHAR) AS content_id, "
            f"'Course ' || CAST(doc_id % {N_COURSES} AS VARCHAR) AS content_name, "
            f"text AS comment, {_date_expr()} AS comment_date, doc_id AS ordinal, lang AS true_lang")


def _split_sql(src: str, extra: str = "") -> str:
    d = s_trim("coalesce(comment_date, '')")
    return f"""SELECT content_id, content_name, comment, comment_date, word_count, ordinal, true_lang{extra},
  CASE WHEN comment = '' THEN 'skipped' WHEN word_count <= 3 THEN 'short' ELSE 'full' END AS bucket
FROM (SELECT {s_trim("coalesce(content_id, '')")} AS content_id,
             {s_trim("coalesce(content_name, '')")} AS content_name,
             {s_trim("coalesce(comment, '')")} AS comment,
             CASE WHEN contains({d}, 'T') THEN split_part({d}, 'T', 1)
                  WHEN contains({d}, ' ') THEN split_part({d}, ' ', 1) ELSE {d} END AS comment_date,
             {s_wc(s_trim("coalesce(comment, '')"))} AS word_count, ordinal, true_lang{extra}
      FROM {src}) s
WHERE content_id <> ''"""


def _lexicon() -> str:
    return _values(sorted(SENTIMENT_LEXICON.items()), ["word", "w"])


def _profiles() -> str:
    w = profile_weights()
    rows = [(word, code, i, w[code][word]) for i, (code, words) in enumerate(LANGUAGE_PROFILES)
            for word in sorted(set(words))]
    return _values(rows, ["word", "code", "pos", "w"])


def _keywords() -> str:
    pairs = {}
    for no, words in CATEGORY_KEYWORDS:
        for x in words:
            pairs.setdefault(x, no)
    return _values(sorted(pairs.items()), ["word", "no"])


def _taxonomy() -> str:
    rows = [("negative",) + r for r in NEGATIVE_TAXONOMY] + [("positive",) + r for r in POSITIVE_TAXONOMY]
    return _values(rows, ["sentiment", "category_no", "category", "root_cause", "owner", "priority", "actions"])


def _lang_dim(lenient: bool) -> str:
    names = LANG_NAMES_LENIENT if lenient else LANG_NAMES_STRICT
    order = LANG_ORDER_LENIENT if lenient else LANG_ORDER
    return _values([(c, n, order.get(n, 99)) for c, n in names.items()], ["code", "name", "lang_order"])


def _lang_sql(src: str, lenient: bool) -> str:
    blank = f"({s_trim('coalesce(f.comment, ' + q('') + ')')} = '')"
    if lenient:
        code = "CASE WHEN b.code IS NULL THEN 'UNKNOWN' ELSE b.code END"
        conf = "CASE WHEN b.code IS NULL OR b.code = 'UNKNOWN' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END"
        lab = "coalesce(b.code, 'UNKNOWN') || ':1.0000'"
        bc = "'UNKNOWN'"
    else:
        code = "CASE WHEN b.code IS NULL THEN 'en' WHEN b.code = 'unknown' THEN 'hinglish' ELSE b.code END"
        conf = "coalesce(b.score, 0.0::DOUBLE)"
        lab = "coalesce(b.labels, 'UNKNOWN')"
        bc = "'en'"
    return f"""SELECT f.*, CASE WHEN {blank} THEN {bc} ELSE {code} END AS predicted_language,
       CASE WHEN {blank} THEN 0.0::DOUBLE ELSE {conf} END AS confidence_score,
       CASE WHEN {blank} THEN 'UNKNOWN' ELSE {lab} END AS top_predicted_labels,
       0.0::DOUBLE AS latency
FROM {src} f LEFT JOIN lang_best b USING (ordinal)"""


def _lfacts_sql(lang: str, lenient: bool) -> str:
    default = "unknown" if lenient else "hinglish"
    code = f"lower({s_trim(f'coalesce(l.predicted_language, {q(default)})')})"
    norm = s_norm_simple("l.comment") if lenient else s_norm("l.comment")
    how = "LEFT" if lenient else "INNER"
    dim = "lang_dim_len" if lenient else "lang_dim"
    cm = "cmap_len" if lenient else "cmap"
    return f"""SELECT x.*, coalesce(d.name, upper(substr(x.lang_code, 1, 1)) || lower(substr(x.lang_code, 2))) AS lang_name
FROM (SELECT l.content_id, l.ordinal, {code} AS lang_code, l.comment,
             coalesce(m.sentiment, 'neutral') AS sentiment, coalesce(m.issue, 'Other Issue') AS issue,
             coalesce(m.strength, '') AS strength,
             CASE WHEN m.content_id IS NULL THEN l.comment_date ELSE m.date END AS date,
             m.content_id IS NOT NULL AS matched
      FROM (SELECT * REPLACE (CASE WHEN ordinal % 17 = 0 THEN comment || ' edited' ELSE comment END AS comment) FROM {lang}) l {how} JOIN {cm} m ON m.content_id = l.content_id AND m.norm = {norm}) x
LEFT JOIN {dim} d ON d.code = x.lang_code"""


def _enriched_sql(lenient: bool) -> str:
    norm = s_norm_simple("comment") if lenient else s_norm("comment")
    look = "a_lookup_len" if lenient else "a_lookup"
    return f"""SELECT t.content_id, t.content_name, t.ordinal, t.comment, t.comment_date, t.sentiment, t.norm,
       CASE WHEN t.sentiment = 'negative' THEN coalesce(a.category, 'Other Issue') ELSE 'Other Issue' END AS issue,
       CASE WHEN t.sentiment = 'positive' THEN coalesce(a.category, '') ELSE '' END AS strength
FROM (SELECT *, {s_sent_key('predicted_sentiment')} AS sentiment, {norm} AS norm FROM full_m) t
LEFT JOIN {look} a ON a.content_id = t.content_id AND a.sentiment = t.sentiment AND a.norm = t.norm"""


def _a_lookup_sql(lenient: bool) -> str:
    norm = s_norm_simple("comment") if lenient else s_norm("comment")
    return f"""SELECT content_id, sentiment, norm, category FROM (
  SELECT content_id, sentiment, {norm} AS norm, category,
         row_number() OVER (PARTITION BY content_id, sentiment, {norm} ORDER BY ordinal DESC) AS rk
  FROM analysis WHERE category IS NOT NULL) WHERE rk = 1"""


def _cmap_sql(src: str) -> str:
    return f"""SELECT content_id, norm, sentiment, issue, strength, date FROM (
  SELECT content_id, norm, sentiment, issue, strength, comment_date AS date,
         row_number() OVER (PARTITION BY content_id, norm ORDER BY ordinal DESC) AS rk FROM {src}) WHERE rk = 1"""


_LOW_SIGNAL = ", ".join(q(p) for p in LOW_SIGNAL_PHRASES)

CTES: dict[str, tuple[str, list[str]]] = {
    "raw": (f"SELECT {_raw_cols()} FROM documents", []),
    "raw_l": ("""SELECT r.*, CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive'
                 WHEN l.quality = 0 THEN 'neutral' END AS actual_sentiment
              FROM raw r LEFT JOIN labels l ON l.doc_id = r.ordinal""", ["raw"]),
    "split": (_split_sql("raw"), ["raw"]),
    "split_l": (_split_sql("raw_l", ", actual_sentiment"), ["raw_l"]),
    "clean": ("SELECT * FROM split WHERE bucket <> 'skipped'", ["split"]),
    "clean_l": ("SELECT * FROM split_l WHERE bucket <> 'skipped'", ["split_l"]),
    "lex": (f"SELECT * FROM {_lexicon()}", []),
    "sent": (f"""SELECT ordinal, sum(w) AS score FROM (SELECT ordinal, unnest({s_tokens('comment')}) AS tok FROM clean) t
               JOIN lex ON lex.word = t.tok GROUP BY ordinal""", ["clean", "lex"]),
    "tagged": ("""SELECT c.*, CAST(coalesce(s.score, 0) AS BIGINT) AS score,
                 CASE WHEN coalesce(s.score, 0) > 0 THEN 'positive' WHEN coalesce(s.score, 0) < 0 THEN 'negative'
                      ELSE 'neutral' END AS predicted_sentiment
               FROM clean c LEFT JOIN sent s USING (ordinal)""", ["clean", "sent"]),
    "tagged_l": ("""SELECT c.*, CASE WHEN coalesce(s.score, 0) > 0 THEN 'positive' WHEN coalesce(s.score, 0) < 0
                      THEN 'negative' ELSE 'neutral' END AS predicted_sentiment,
                   lower(coalesce(c.actual_sentiment, 'neutral')) AS true_label
                 FROM clean_l c LEFT JOIN sent s USING (ordinal)""", ["clean_l", "sent"]),
    "full_t": ("SELECT * FROM tagged WHERE bucket = 'full'", ["tagged"]),
    "prof": (f"SELECT * FROM {_profiles()}", []),
    "lang_hits": (f"""SELECT t.ordinal, p.code, p.pos, sum(p.w) AS hits
                    FROM (SELECT ordinal, unnest({s_tokens('comment')}) AS tok FROM full_t) t
                    JOIN prof p ON p.word = t.tok GROUP BY t.ordinal, p.code, p.pos""", ["full_t", "prof"]),
    "lang_c": ("""SELECT h.ordinal, h.code, h.pos, CAST(h.hits AS DOUBLE) / CAST(t.total AS DOUBLE) AS score,
                 row_number() OVER (PARTITION BY h.ordinal ORDER BY h.hits DESC, h.pos) AS rk
               FROM lang_hits h JOIN (SELECT ordinal, sum(hits) AS total FROM lang_hits GROUP BY ordinal) t
               USING (ordinal)""", ["lang_hits"]),
    "lang_best": ("""SELECT ordinal, max(CASE WHEN rk = 1 THEN code END) AS code,
                    max(CASE WHEN rk = 1 THEN score END) AS score,
                    string_agg(code || ':' || printf('%.4f', score), '; ' ORDER BY rk) AS labels
                  FROM lang_c GROUP BY ordinal""", ["lang_c"]),
    "lang": (_lang_sql("full_t", False), ["full_t", "lang_best"]),
    "lang_len": (_lang_sql("full_t", True), ["full_t", "lang_best"]),
    **{f"lang_in{x}": (f"""SELECT * REPLACE (
         CASE WHEN ordinal % 13 = 0 THEN 'ERROR' ELSE predicted_language END AS predicted_language,
         CASE WHEN ordinal % 13 = 0 THEN 0.0::DOUBLE ELSE CAST(length(comment) % 50 AS DOUBLE) / 1000.0::DOUBLE END AS latency)
       FROM lang{x}""", [f"lang{x}"]) for x in ("", "_len")},
    "kw": (f"SELECT * FROM {_keywords()}", []),
    "tax": (f"SELECT * FROM {_taxonomy()}", []),
    # stored labels and category numbers: inputs mapped from the driver's tables
    "full_m": (f"""SELECT * EXCLUDE (predicted_sentiment, score), CASE
                  WHEN length(comment) % 20 < 2 + 3 * (ordinal % {N_COURSES}) THEN 'negative'
                  WHEN length(comment) % 3 = 0 THEN 'neutral' ELSE 'positive' END AS predicted_sentiment
                FROM full_t""", ["full_t"]),
    "negpos": ("SELECT *, predicted_sentiment AS sentiment FROM full_m "
               "WHERE predicted_sentiment IN ('negative', 'positive')", ["full_m"]),
    "cat_best": (f"""SELECT ordinal, no FROM (
                   SELECT ordinal, no, row_number() OVER (PARTITION BY ordinal ORDER BY count(*) DESC, no) AS rk
                   FROM (SELECT ordinal, unnest({s_tokens('comment')}) AS tok FROM negpos) t
                   JOIN kw ON kw.word = t.tok GROUP BY ordinal, no) WHERE rk = 1""", ["negpos", "kw"]),
    "categorized": ("""SELECT n.*, x.category_no, tax.category, tax.root_cause, tax.owner, tax.priority, tax.actions,
                   CAST(length(n.comment) AS BIGINT) AS usage_input, CAST(length(tax.category) AS BIGINT) AS usage_output
                 FROM negpos n
                 JOIN (SELECT n2.ordinal, CAST(coalesce(b.no, 15) AS INTEGER) AS category_no
                       FROM negpos n2 LEFT JOIN cat_best b USING (ordinal)) x USING (ordinal)
                 LEFT JOIN tax ON tax.sentiment = n.sentiment AND tax.category_no = x.category_no""",
                    ["negpos", "cat_best", "tax"]),
    "analysis": (f"""SELECT n.*, tax.category_no, tax.category, tax.root_cause, tax.owner, tax.priority, tax.actions,
                   CAST(length(n.comment) AS BIGINT) AS usage_input, CAST(length(tax.category) AS BIGINT) AS usage_output
                 FROM negpos n JOIN tax ON tax.sentiment = n.sentiment
                   AND tax.category_no = 1 + (((n.ordinal // {N_COURSES}) % 9) * ((n.ordinal // {N_COURSES}) % 4)) % 15""",
                 ["negpos", "tax"]),
    "a_lookup": (_a_lookup_sql(False), ["analysis"]),
    "a_lookup_len": (_a_lookup_sql(True), ["analysis"]),
    "enriched": (_enriched_sql(False), ["full_m", "a_lookup"]),
    "enriched_len": (_enriched_sql(True), ["full_m", "a_lookup_len"]),
    "cmap": (_cmap_sql("enriched"), ["enriched"]),
    "cmap_len": (_cmap_sql("enriched_len"), ["enriched_len"]),
    "lang_dim": (f"SELECT * FROM {_lang_dim(False)}", []),
    "lang_dim_len": (f"SELECT * FROM {_lang_dim(True)}", []),
    "lfacts": (_lfacts_sql("lang", False), ["lang", "cmap", "lang_dim"]),
    "lfacts_len": (_lfacts_sql("lang_len", True), ["lang_len", "cmap_len", "lang_dim_len"]),
    "groups": (f"""SELECT g.*, CAST(sum(count) OVER (PARTITION BY content_id, sentiment) AS BIGINT) AS total,
                   CAST(count AS DOUBLE) / CAST(greatest(1, sum(count) OVER (PARTITION BY content_id, sentiment)) AS DOUBLE) AS share,
                   row_number() OVER (PARTITION BY content_id, sentiment ORDER BY count DESC, first_ordinal) AS rank
                 FROM (SELECT a.content_id, a.sentiment, coalesce(a.category, 'Other') AS category, count(*) AS count,
                              min(a.ordinal) AS first_ordinal,
                              count_if(regexp_matches(a.comment, {q('(?i)' + BLOCKING_PATTERN)})) AS blocking_count,
                              count_if({s_wc('a.comment')} <= 1 OR NOT regexp_matches(a.comment, '[\\p{{L}}\\p{{N}}]')
                                       OR {s_collapse('lower(a.comment)')} IN ({_LOW_SIGNAL})) AS low_signal_count
                       FROM analysis a GROUP BY 1, 2, 3) g""", ["analysis"]),
    "groups_meta": ("""SELECT g.*, m.root_cause, m.owner, m.priority, m.actions FROM groups g JOIN (
                      SELECT content_id, sentiment, coalesce(category, 'Other') AS category,
                             coalesce(root_cause, '') AS root_cause, coalesce(owner, '') AS owner,
                             coalesce(priority, '') AS priority, coalesce(actions, []) AS actions,
                             row_number() OVER (PARTITION BY content_id, sentiment, coalesce(category, 'Other')
                                                ORDER BY ordinal) AS rk FROM analysis) m
                    ON m.rk = 1 AND m.content_id = g.content_id AND m.sentiment = g.sentiment
                       AND m.category = g.category""", ["groups", "analysis"]),
    "tiered": ("""SELECT *,
                 CASE WHEN count < 5 THEN 'excluded'
                      WHEN share >= 0.1::DOUBLE OR rank = 1 THEN CASE WHEN sentiment = 'negative' THEN 'major' ELSE 'primary' END
                      ELSE CASE WHEN sentiment = 'negative' THEN 'minor' ELSE 'secondary' END END AS tier,
                 CASE WHEN noise THEN 'Low'
                      WHEN rank = 1 AND blocking_count > 0 AND count >= 5 THEN 'Critical'
                      WHEN share >= 0.1::DOUBLE AND count >= 5 THEN 'High'
                      WHEN share >= 0.05::DOUBLE THEN 'Medium' ELSE 'Low' END AS urgency
               FROM (SELECT *, CAST(low_signal_count AS DOUBLE) / CAST(count AS DOUBLE) > 0.5::DOUBLE AS noise
                     FROM groups_meta)""", ["groups_meta"]),
    "earlier": (f"SELECT * FROM analysis WHERE comment_date < {q(RESUME_CUTOFF)}", ["analysis"]),
    "stop": ("SELECT * FROM " + _values([(w,) for w in sorted(set(STOPWORDS_DEFAULT) | set(STOPWORDS_EXTRA))],
                                        ["word"]), []),
}


def _own(sql: str) -> str:
    """The same step on the library's own labels in place of the stored ones."""
    return re.sub(r"\b(negpos|cat_best|categorized|groups|groups_meta|tiered)\b", r"\1_own", re.sub(r"\banalysis\b", "categorized", sql))


CTES["negpos_own"] = ("SELECT *, predicted_sentiment AS sentiment FROM full_t WHERE predicted_sentiment IN ('negative', 'positive')", ["full_t"])
for _name in ("cat_best", "categorized", "groups", "groups_meta", "tiered"):
    CTES[f"{_name}_own"] = (_own(CTES[_name][0]), [_own(d) for d in CTES[_name][1]])


def with_ctes(final: str, *names: str) -> str:
    """``WITH`` clause holding every CTE the final query needs (dependency order)."""
    order: list[str] = []

    def visit(n: str):
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return final
    body = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final}"

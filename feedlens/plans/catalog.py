"""Every registered query: key -> (Spark builder, oracle SQL or None).

Spark builders take (spark, sf_dir) and return a lazy DataFrame over the whole tables.
Column names and types are aligned with the SQL (integers as bigint, shares as double).
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..fixed import ANALYSIS_RECORD_FIELD, ANALYSIS_SENTIMENT_FIELD, BLOCKING_PATTERN, TOP_ISSUES, TOP_ISSUES_LENIENT, TOP_STRENGTHS
from ..functions import text as tx
from ..operators import category, clean, dashboard, documents, enrich, evaluate, language, models, sentiment, words
from ..schemas import ANALYSIS_FILE_SCHEMA, RAW_COMMENT_SCHEMA, TAGGED_FILE_SCHEMA
from ..session import materialize, scratch_path
from ..sinks import files as sinks
from ..sources import files as src
from ..sources import splits
from ..sources.tables import conversation_comments, raw_comments, read_table
from . import flows, staged
from .oracle import q, s_norm, s_norm_simple, s_tokens, s_trim, with_ctes

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}

ROW_LIMIT = 20
FILE_LIMIT = 3
PROMPT_TEMPLATE = ("Course '{content_name}' received this {sentiment} comment:\n\"{comment}\"\n"
                   "Answer as JSON: {{ \"category\": \"...\", \"tags\": {{}} }}")


def register(key: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[key] = (fn, sql)
        return fn
    return deco


def L(c) -> F.Column:
    return F.col(c).cast("long") if isinstance(c, str) else c.cast("long")


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# ============================================================================ sources
@register("scan_comments", with_ctes(
    "SELECT content_id, content_name, comment, comment_date FROM raw", "raw"))
def q_scan_comments(spark, sf):
    """Raw comments written as CSV (quoted newlines) and scanned back."""
    path = _scratch(spark, "raw-csv")
    sinks.write_csv(raw_comments(spark, sf).select(*RAW_COMMENT_SCHEMA.fieldNames()), path)
    return src.scan_comments(spark, path)


@register("scan_comments_split", with_ctes(
    "SELECT content_id, content_name, replace(comment, ' a ', chr(10) || '\"a, ') AS comment, comment_date FROM raw", "raw"))
def q_scan_comments_split(spark, sf):
    """S1 at any file size: comments with line breaks and quotes as one CSV file, read by every task that gets a part of it."""
    path = _scratch(spark, "raw-csv")
    raw = raw_comments(spark, sf).withColumn("comment", F.replace("comment", F.lit(" a "), F.lit('\n"a, ')))
    sinks.write_csv(raw.select(*RAW_COMMENT_SCHEMA.fieldNames()), path)
    return splits.scan_comments_split(spark, path).drop(*splits.PLACE)


@register("scan_analysis_arrays", with_ctes(
    "SELECT content_id, ordinal, sentiment, category FROM analysis", "analysis"))
def q_scan_analysis_arrays(spark, sf):
    """S5 (+K3) in the upstream layout: one indented JSON array a course, each file read in parts."""
    path = _scratch(spark, "analysis-arrays")
    sinks.write_analysis_arrays(flows.analysis(spark, sf), path)
    schema = T.StructType(ANALYSIS_FILE_SCHEMA.fields + [T.StructField("ordinal", T.LongType())])
    df = splits.scan_analysis_split(spark, path, schema, glob="*.txt", recursive=True)
    ga = F.col(f"`{ANALYSIS_RECORD_FIELD}`")
    return df.select("content_id", "ordinal", F.col(f"`{ANALYSIS_SENTIMENT_FIELD}`").alias("sentiment"),
                     F.coalesce(ga["Issue Category"], ga["Strength Category"]).alias("category"))


@register("scan_course_files", with_ctes(
    "SELECT content_id, ordinal, comment, predicted_sentiment FROM full_t", "full_t"))
def q_scan_course_files(spark, sf):
    """S2 + S4: one CSV set per course (content_id=... folders), scanned in one read with
    the course taken from the path."""
    path = _scratch(spark, "course-csv")
    t = flows.full(spark, sf).select("content_id", "content_name", "comment", "comment_date", "ordinal",
                                     "predicted_sentiment", F.lit(None).cast("string").alias("actual_sentiment"))
    sinks.write_course_files(t, path)
    schema = T.StructType([f for f in TAGGED_FILE_SCHEMA.fields if f.name != "content_id"])
    df = src.scan_course_files(spark, path, schema, recursive=True)
    return df.select(F.col("source_course").alias("content_id"), "ordinal", "comment", "predicted_sentiment")


@register("scan_recursive", with_ctes(
    "SELECT content_id, bucket, ordinal FROM clean", "clean"))
def q_scan_recursive(spark, sf):
    """S3: short and full files in sub-folders, read recursively."""
    path = _scratch(spark, "split-csv")
    sinks.write_split(flows.split(spark, sf), path)
    schema = T.StructType([f for f in TAGGED_FILE_SCHEMA.fields if f.name in ("content_name", "comment",
                                                                             "comment_date", "ordinal")])
    df = src.scan_course_files(spark, path, schema, recursive=True)
    bucket = F.regexp_extract(F.col("_metadata.file_path"), "bucket=([^/]+)/", 1)
    return df.select(F.col("source_course").alias("content_id"), bucket.alias("bucket"), "ordinal")


@register("scan_analysis_json", with_ctes(
    "SELECT content_id, ordinal, sentiment, category FROM analysis", "analysis"))
def q_scan_analysis_json(spark, sf):
    """S5 (+K3): analysis records written with the upstream key names, scanned back."""
    path = _scratch(spark, "analysis-json")
    sinks.write_analysis_json(flows.analysis(spark, sf), path)
    schema = T.StructType(ANALYSIS_FILE_SCHEMA.fields + [T.StructField("ordinal", T.LongType())])
    df = src.scan_analysis_json(spark, path, schema, arrays=False)
    ga = F.col(f"`{ANALYSIS_RECORD_FIELD}`")
    return df.select("content_id", "ordinal", F.col(f"`{ANALYSIS_SENTIMENT_FIELD}`").alias("sentiment"),
                     F.coalesce(ga["Issue Category"], ga["Strength Category"]).alias("category"))


@register("text_column_choice", with_ctes("""
SELECT 'documents' AS origin, count(*) AS n, count(comment) AS with_text FROM raw
UNION ALL
SELECT 'conversations', count(*), count(text) FROM conversations""", "raw"))
def q_text_column_choice(spark, sf):
    """Two sources, one with 'comment', one with 'text'; the text column is chosen
    per row after a by-name union."""
    d = raw_comments(spark, sf).select("comment", F.lit("documents").alias("origin"))
    c = spark.read.parquet(f"{sf}/conversations.parquet").select("text", F.lit("conversations").alias("origin"))
    u = src.text_column_choice(d.unionByName(c, allowMissingColumns=True))
    return u.groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.count("comment_text").alias("with_text"))


@register("required_columns", """
SELECT doc_id AS ordinal, CASE WHEN doc_id IS NULL OR text IS NULL THEN 'null required field' END AS reject_reason
FROM documents""")
def q_required_columns(spark, sf):
    """Schema check, then rows with a null required field flagged."""
    d = read_table(spark, sf, "documents")
    return src.required_columns(d, ["doc_id", "text"]).select(F.col("doc_id").alias("ordinal"), "reject_reason")


@register("row_limit", with_ctes(f"""
SELECT content_id, ordinal FROM (
  SELECT content_id, ordinal, row_number() OVER (PARTITION BY content_id ORDER BY ordinal) AS rn FROM clean)
WHERE rn <= {ROW_LIMIT} AND content_id IN (SELECT DISTINCT content_id FROM clean ORDER BY 1 LIMIT {FILE_LIMIT})""", "clean"))
def q_row_limit(spark, sf):
    """Trial-run caps (the feature itself): first 20 comments of each of the first 3 courses."""
    return src.row_limit(clean.clean_comments(raw_comments(spark, sf)), ROW_LIMIT, files=FILE_LIMIT).select("content_id", "ordinal")


# ============================================================================ projections
@register("clean_split", with_ctes(
    "SELECT content_id, content_name, comment, comment_date, word_count, bucket, ordinal FROM split", "split"))
def q_clean_split(spark, sf):
    """P1-P6 in one projection."""
    s = flows.split(spark, sf)
    return s.select("content_id", "content_name", "comment", "comment_date", L("word_count").alias("word_count"),
                    "bucket", "ordinal")


@register("normalize_date", with_ctes("SELECT ordinal, comment_date FROM split", "split"))
def q_normalize_date(spark, sf):
    """P4."""
    return flows.split(spark, sf).select("ordinal", "comment_date")


@register("word_count", with_ctes("SELECT ordinal, word_count FROM split", "split"))
def q_word_count(spark, sf):
    """P5."""
    return flows.split(spark, sf).select("ordinal", L("word_count").alias("word_count"))


@register("short_full_split", with_ctes(
    "SELECT content_id, bucket, count(*) AS n FROM split GROUP BY content_id, bucket", "split"))
def q_short_full_split(spark, sf):
    """P6 (+P1/P2): rows per course and bucket."""
    return flows.split(spark, sf).groupBy("content_id", "bucket").agg(F.count(F.lit(1)).alias("n"))


@register("score_sentiment", with_ctes(
    "SELECT ordinal, content_id, bucket, score, predicted_sentiment FROM tagged", "tagged"))
def q_score_sentiment(spark, sf):
    """E1 + P7 + P8: lexicon score and label of every cleaned comment."""
    c = clean.clean_comments(raw_comments(spark, sf))
    c = c.withColumn("score", L(sentiment.lexicon_score(sentiment.scoring_text(F.col("comment")))))
    return (c.withColumn("predicted_sentiment", sentiment.label_map(sentiment.polarity(F.col("score"))))
            .select("ordinal", "content_id", "bucket", "score", "predicted_sentiment"))


@register("sentiment_filter", with_ctes(
    "SELECT ordinal, content_id FROM full_t WHERE predicted_sentiment = 'negative'", "full_t"))
def q_sentiment_filter(spark, sf):
    """The negative full comments routed to categorisation."""
    return sentiment.sentiment_filter(flows.full(spark, sf), "negative").select("ordinal", "content_id")


@register("norm_comment", with_ctes(f"SELECT ordinal, {s_norm('comment')} AS norm FROM full_t", "full_t"))
def q_norm_comment(spark, sf):
    """P11 (oracle without NFKC: no such character occurs in the data)."""
    return flows.full(spark, sf).select("ordinal", tx.norm_comment(F.col("comment")).alias("norm"))


#: Full-width forms of the ASCII letters, which NFKC turns back.
_WIDE = "".join(chr(c + 0xFEE0) for c in [*range(0x41, 0x5B), *range(0x61, 0x7B)])


@register("norm_comment_nfkc", with_ctes(f"SELECT ordinal, {s_norm('comment')} AS norm FROM full_t", "full_t"))
def q_norm_comment_nfkc(spark, sf):
    """P11 where NFKC has work to do: one comment in three comes in full-width letters, one with its é
    as letter and accent; their keys are those of the plain texts."""
    c = flows.full(spark, sf).select("ordinal", "comment")
    plain = "".join(chr(c) for c in [*range(0x41, 0x5B), *range(0x61, 0x7B)])
    wide = F.translate("comment", plain, _WIDE)
    decomposed = F.regexp_replace("comment", "é", "e\u0301")
    text = F.when(F.col("ordinal") % 3 == 0, wide).when(F.col("ordinal") % 3 == 1, decomposed).otherwise(F.col("comment"))
    return c.select("ordinal", tx.norm_comment(text).alias("norm"))


@register("norm_comment_simple", with_ctes(f"SELECT ordinal, {s_norm_simple('comment')} AS norm FROM full_t",
                                           "full_t"))
def q_norm_comment_simple(spark, sf):
    """P12."""
    return flows.full(spark, sf).select("ordinal", tx.norm_comment_simple(F.col("comment")).alias("norm"))


_LANG_COLS = ["ordinal", "content_id", "predicted_language", "confidence_score", "top_predicted_labels", "latency"]


@register("detect_language", with_ctes(f"SELECT {', '.join(_LANG_COLS)} FROM lang", "lang"))
def q_detect_language(spark, sf):
    """E2 + P13-P15: detected code, confidence, candidate text."""
    return flows.detected(spark, sf).select(*_LANG_COLS)


@register("detect_language_lenient", with_ctes(f"SELECT {', '.join(_LANG_COLS)} FROM lang_len", "lang_len"))
def q_detect_language_lenient(spark, sf):
    """The no-score detector convention (1.0 when known, 'code:1.0000')."""
    return flows.detected(spark, sf, lenient=True).select(*_LANG_COLS)


@register("lang_name", with_ctes("SELECT ordinal, lang_code, lang_name FROM lfacts", "lfacts"))
def q_lang_name(spark, sf):
    """Display names (fixed map, title-cased fallback)."""
    return flows.language_facts(spark, sf, texts=False).select("ordinal", "lang_code", "lang_name")


@register("parse_analysis", """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN event_id % 7 = 0 THEN 'Failed to parse JSON' END AS error,
       CASE WHEN event_id % 7 = 0 THEN props || '}' END AS raw_output
FROM events""")
def q_parse_analysis(spark, sf):
    """P19 on JSON text (events.props): padded answers, and one in seven broken off wrongly."""
    ev = read_table(spark, sf, "events")
    raw = F.when(F.col("event_id") % 7 == 0, F.concat("props", F.lit("}"))).otherwise(F.concat(F.lit(" "), "props", F.lit("\n")))
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("Error", T.StringType()), T.StructField("Raw Output", T.StringType())])
    parsed = ev.select("event_id", enrich.parse_analysis(raw, schema).alias("a"))
    return parsed.select("event_id", "a.k", F.col("a.Error").alias("error"), F.col("a.`Raw Output`").alias("raw_output"))


@register("prompt_text", with_ctes(
    "SELECT ordinal, " + " || ".join([q("Course '"), "content_name", q("' received this "), "sentiment",
                                      q(" comment:\n\""), "comment",
                                      q("\"\nAnswer as JSON: { \"category\": \"...\", \"tags\": {} }")]) +
    " AS prompt FROM negpos", "negpos"))
def q_prompt_text(spark, sf):
    """P20: one prompt per comment sent to categorisation (template filled once)."""
    t = flows.tagged_input(spark, sf).filter(F.col("predicted_sentiment").isin("negative", "positive"))
    cols = {k: F.col(c) for k, c in (("content_name", "content_name"), ("sentiment", "predicted_sentiment"),
                                     ("comment", "comment"))}
    return t.select("ordinal", enrich.prompt_text(PROMPT_TEMPLATE, cols).alias("prompt"))


@register("regex_search", with_ctes(
    f"SELECT ordinal, regexp_matches(comment, {q('(?i)' + BLOCKING_PATTERN)}) AS matched FROM full_t", "full_t"))
def q_regex_search(spark, sf):
    """Case-insensitive pattern test."""
    return flows.full(spark, sf).select("ordinal", tx.regex_search(F.col("comment"), BLOCKING_PATTERN).alias("matched"))


# ============================================================================ categorisation / joins
_ANALYSIS_COLS = ["ordinal", "content_id", "sentiment", "category_no", "category", "root_cause", "owner", "priority"]


@register("categorize", with_ctes(
    f"SELECT {', '.join(_ANALYSIS_COLS)}, array_to_string(actions, ' | ') AS actions, "
    "usage_input, usage_output FROM categorized", "categorized"))
def q_categorize(spark, sf):
    """E3 + J9 + S10: category of each negative / positive comment and its taxonomy row."""
    a = flows.categorized(spark, sf)
    return a.select(*_ANALYSIS_COLS[:3], F.col("category_no").cast("int").alias("category_no"), *_ANALYSIS_COLS[4:],
                    F.array_join("actions", " | ").alias("actions"),
                    F.col("usage.input").alias("usage_input"), F.col("usage.output").alias("usage_output"))


@register("join_taxonomy", with_ctes(
    "SELECT sentiment, category, owner, priority, count(*) AS n FROM analysis GROUP BY ALL", "analysis"))
def q_join_taxonomy(spark, sf):
    """Comments per taxonomy row (owner and priority come from the joined dimension)."""
    return flows.analysis(spark, sf).groupBy("sentiment", "category", "owner", "priority").agg(
        F.count(F.lit(1)).alias("n"))


@register("join_analysis", with_ctes(
    "SELECT content_id, ordinal, sentiment, issue, strength FROM enriched", "enriched"))
def q_join_analysis(spark, sf):
    """J1 + P18 + D1: each comment with its issue / strength via the last-wins lookup."""
    return flows.enriched(spark, sf).select("content_id", "ordinal", "sentiment", "issue", "strength")


@register("last_wins", with_ctes("SELECT content_id, norm, sentiment, issue, strength, date FROM cmap", "cmap"))
def q_last_wins(spark, sf):
    """One record per (course, normalised comment), the last one."""
    m = dashboard.comment_map(flows.enriched(spark, sf))
    return m.select("content_id", "norm", "m.sentiment", "m.issue", "m.strength", "m.date")


_FACT_COLS = ["content_id", "ordinal", "lang_code", "lang_name", "sentiment", "issue", "strength", "date", "matched"]


@register("join_language_inner", with_ctes(f"SELECT {', '.join(_FACT_COLS)} FROM lfacts", "lfacts"))
def q_join_language_inner(spark, sf):
    """Language rows matched to the comment map; unmatched rows skipped."""
    return flows.language_facts(spark, sf, texts=False).select(*_FACT_COLS)


@register("join_language_left", with_ctes(f"SELECT {', '.join(_FACT_COLS)} FROM lfacts_len", "lfacts_len"))
def q_join_language_left(spark, sf):
    """Lenient profile, unmatched rows kept as neutral / 'Other Issue'."""
    return flows.language_facts(spark, sf, dashboard.LENIENT, texts=False).select(*_FACT_COLS)


@register("count_recon", with_ctes("""
SELECT content_id, count(*) AS n FROM full_t
WHERE content_id IN (SELECT DISTINCT 'course_' || CAST(conv_id % 4 AS VARCHAR) FROM conversations)
GROUP BY content_id""", "full_t"))
def q_count_recon(spark, sf):
    """Comments of courses that also have language rows (semi join on the distinct
    courses).  The language rows come from the conversations, which lack one course."""
    t = flows.full(spark, sf)
    l = spark.read.parquet(f"{sf}/conversations.parquet").select(
        F.concat(F.lit("course_"), (F.col("conv_id") % 4).cast("string")).alias("content_id")).distinct()
    return t.join(l, "content_id", "left_semi").groupBy("content_id").agg(F.count(F.lit(1)).alias("n"))


@register("join_resume", with_ctes("""
SELECT c.content_id, c.ordinal, e.category AS earlier_category
FROM negpos c LEFT JOIN (
  SELECT content_id, comment, category FROM (
    SELECT content_id, comment, category,
           row_number() OVER (PARTITION BY content_id, comment ORDER BY ordinal DESC) AS rk FROM earlier)
  WHERE rk = 1) e ON e.content_id = c.content_id AND e.comment = c.comment""", "negpos", "earlier"))
def q_join_resume(spark, sf):
    """Comments to analyse with what the earlier run stored (no fan-out)."""
    t = flows.tagged_input(spark, sf).filter(F.col("predicted_sentiment").isin("negative", "positive"))
    j = enrich.join_resume(t, flows.earlier_analysis(spark, sf))
    return j.select("content_id", "ordinal", F.col("earlier.category").alias("earlier_category"))


@register("pending_anti", with_ctes("""
SELECT c.content_id, c.ordinal FROM negpos c
WHERE NOT EXISTS (SELECT 1 FROM earlier e WHERE e.content_id = c.content_id AND e.comment = c.comment
                  AND e.category IS NOT NULL)""", "negpos", "earlier"))
def q_pending_anti(spark, sf):
    """Comments still without a successful analysis."""
    t = flows.tagged_input(spark, sf).filter(F.col("predicted_sentiment").isin("negative", "positive"))
    return enrich.pending_anti(t, flows.earlier_analysis(spark, sf)).select("content_id", "ordinal")


def _lang_earlier(spark, sf) -> DataFrame:
    d = flows.detected(spark, sf).select("content_id", "ordinal", "comment_date", "predicted_language")
    # stored: both modes read it, one of them twice
    return materialize(d.withColumn("predicted_language", F.when(F.col("comment_date") < flows.RESUME_CUTOFF,
                                                                 F.col("predicted_language"))), "lang-earlier")


@register("pending_language", with_ctes(f"""
SELECT content_id, ordinal, 'default' AS mode FROM lang WHERE comment_date >= {q(flows.RESUME_CUTOFF)}
UNION ALL
SELECT l.content_id, l.ordinal, 'parity' FROM lang l JOIN (
  SELECT content_id, min(ordinal) AS first_null FROM lang WHERE comment_date >= {q(flows.RESUME_CUTOFF)}
  GROUP BY content_id) f ON f.content_id = l.content_id AND l.ordinal >= f.first_null""", "lang"))
def q_pending_language(spark, sf):
    """Rows to (re)detect, default mode and upstream's restart-at-first-gap mode."""
    le = _lang_earlier(spark, sf)
    a = enrich.pending_language(le).select("content_id", "ordinal", F.lit("default").alias("mode"))
    b = enrich.pending_language(le, parity=True).select("content_id", "ordinal", F.lit("parity").alias("mode"))
    return a.unionByName(b)


@register("skip_existing_summary", with_ctes("""
SELECT DISTINCT content_id, sentiment FROM analysis a
WHERE NOT EXISTS (SELECT 1 FROM earlier e WHERE e.content_id = a.content_id AND e.sentiment = a.sentiment
                  AND e.content_id < 'course_3')""",
                                             "analysis", "earlier"))
def q_skip_existing_summary(spark, sf):
    """(course, sentiment) summaries still to produce; the earlier run had written those
    of the first three courses."""
    now = flows.analysis(spark, sf).select("content_id", "sentiment").distinct()
    return enrich.skip_existing_summary(now, flows.earlier_analysis(spark, sf).filter(F.col("content_id") < "course_3"))


# ============================================================================ aggregates
@register("course_length_counts", with_ctes("""
SELECT content_id, count_if(bucket = 'short') AS short_count, count_if(bucket = 'full') AS full_count,
       count_if(bucket = 'skipped') AS skipped_count
FROM split GROUP BY ROLLUP (content_id)""", "split"))
def q_course_length_counts(spark, sf):
    """A1."""
    return clean.course_length_counts(flows.split(spark, sf))


@register("course_sentiment_counts", with_ctes("""
SELECT content_id, bucket, count_if(predicted_sentiment = 'positive') AS positive,
       count_if(predicted_sentiment = 'neutral') AS neutral, count_if(predicted_sentiment = 'negative') AS negative
FROM tagged GROUP BY content_id, bucket""", "tagged"))
def q_course_sentiment_counts(spark, sf):
    """A2: per course file (course x bucket)."""
    return sentiment.course_sentiment_counts(flows.tagged(spark, sf))


@register("overall_sentiment", with_ctes("""
SELECT count(*) AS total_comments, count(DISTINCT content_id) AS course_count,
       count_if(s = 'positive') AS positive_count, count_if(s = 'negative') AS negative_count,
       count_if(s = 'neutral') AS neutral_count,
       CAST(count_if(s = 'positive') AS DOUBLE) / CAST(greatest(1, count(*)) AS DOUBLE) * 100.0::DOUBLE AS positive_percent,
       CAST(count_if(s = 'negative') AS DOUBLE) / CAST(greatest(1, count(*)) AS DOUBLE) * 100.0::DOUBLE AS negative_percent,
       CAST(count_if(s = 'neutral') AS DOUBLE) / CAST(greatest(1, count(*)) AS DOUBLE) * 100.0::DOUBLE AS neutral_percent
FROM (SELECT content_id, predicted_sentiment AS s FROM full_t)""", "full_t"))
def q_overall_sentiment(spark, sf):
    """A3 over the scored full comments."""
    return sentiment.overall_sentiment(flows.full(spark, sf))


_CS = """SELECT content_id, coalesce(name, content_id) AS name, total, positive_count, negative_count, neutral_count,
  CAST(greatest(1, floor(CAST(positive_count AS DOUBLE) / CAST(greatest(1, total) AS DOUBLE) * 120)) AS BIGINT) AS positive_width,
  CAST(greatest(1, floor(CAST(negative_count AS DOUBLE) / CAST(greatest(1, total) AS DOUBLE) * 120)) AS BIGINT) AS negative_width,
  CAST(greatest(1, floor(CAST(neutral_count AS DOUBLE) / CAST(greatest(1, total) AS DOUBLE) * 120)) AS BIGINT) AS neutral_width,
  CASE WHEN CAST(negative_count AS DOUBLE) / CAST(greatest(1, total) AS DOUBLE) > 0.3::DOUBLE THEN 'high'
       WHEN CAST(negative_count AS DOUBLE) / CAST(greatest(1, total) AS DOUBLE) > 0.15::DOUBLE THEN 'med' ELSE 'low' END AS alert_class,
  CASE WHEN CAST(negative_count AS DOUBLE) / CAST(greatest(1, total) AS DOUBLE) > 0.3::DOUBLE THEN 'High'
       WHEN CAST(negative_count AS DOUBLE) / CAST(greatest(1, total) AS DOUBLE) > 0.15::DOUBLE THEN 'Medium' ELSE 'Low' END AS alert_label,
  (total <= 1 AND positive_count = 0 AND negative_count = 0) AS hidden, first_ordinal
FROM (SELECT content_id, arg_min(content_name, CASE WHEN content_name <> '' THEN ordinal END) AS name,
             count(*) AS total, count_if(sentiment = 'positive') AS positive_count,
             count_if(sentiment = 'negative') AS negative_count,
             count_if(sentiment NOT IN ('positive', 'negative')) AS neutral_count, min(ordinal) AS first_ordinal
      FROM enriched GROUP BY content_id)"""
CTES_CS = f"cs AS ({_CS})"


def _cs_sql(final: str, *names: str) -> str:
    base = with_ctes("SELECT 1", "enriched", *names)
    return base[:-len("SELECT 1")].rstrip() + ",\n" + CTES_CS + "\n" + final


@register("course_stats", _cs_sql("""
SELECT content_id, name, total, positive_count, negative_count, neutral_count, positive_width, negative_width,
       neutral_width, alert_class, alert_label, hidden,
       CASE WHEN NOT hidden THEN row_number() OVER (PARTITION BY hidden ORDER BY total DESC, first_ordinal) END AS course_rank
FROM cs"""))
def q_course_stats(spark, sf):
    """A4 + W7 + P22 + P24."""
    cs = dashboard.course_stats(flows.enriched(spark, sf))
    return cs.withColumn("course_rank", L("course_rank"))


@register("category_counts", with_ctes("""
SELECT content_id, kind, name, count(*) AS count, min(ordinal) AS first_ordinal, grouping(content_id, kind, name) AS gid
FROM (SELECT content_id, ordinal, 'issue' AS kind, issue AS name FROM enriched
      WHERE sentiment = 'negative' AND issue <> 'Other Issue' AND issue <> ''
      UNION ALL
      SELECT content_id, ordinal, 'strength', strength FROM enriched WHERE sentiment = 'positive' AND strength <> '')
GROUP BY GROUPING SETS ((content_id, kind, name), (kind, name))""", "enriched"))
def q_category_counts(spark, sf):
    """A5: per course and overall (gid 4 = overall)."""
    return dashboard.category_counts(flows.enriched(spark, sf))


_GROUP_COLS = ["content_id", "sentiment", "category", "count", "total", "share", "rank", "first_ordinal",
               "root_cause", "owner", "priority", "blocking_count", "low_signal_count"]


@register("category_groups", with_ctes(
    f"SELECT {', '.join(_GROUP_COLS)}, array_to_string(actions, ' | ') AS actions FROM groups_meta", "groups_meta"))
def q_category_groups(spark, sf):
    """Per (course, sentiment, category) count and first-seen metadata."""
    g = category.category_groups(flows.analysis(spark, sf))
    return g.select(*[L(c).alias(c) if c in ("rank",) else F.col(c) for c in _GROUP_COLS],
                    F.array_join("actions", " | ").alias("actions"))


@register("category_share", with_ctes("SELECT content_id, sentiment, category, count, total, share FROM groups",
                                      "groups"))
def q_category_share(spark, sf):
    """Category share of the course's analysed comments."""
    return category.category_groups(flows.analysis(spark, sf)).select(
        "content_id", "sentiment", "category", "count", "total", "share")


@register("language_counts", with_ctes("""
SELECT content_id, lang_name, count(*) AS count, grouping(content_id, lang_name) AS gid
FROM lfacts WHERE matched GROUP BY GROUPING SETS ((content_id, lang_name), (lang_name))""", "lfacts"))
def q_language_counts(spark, sf):
    """Rows per language, per course and overall."""
    return dashboard.language_counts(dashboard.language_rows_counted(flows.language_facts(spark, sf, texts=False)))


@register("language_sentiment", with_ctes("""
SELECT content_id, lang_name, count_if(sentiment = 'positive') AS positive_count,
       count_if(sentiment = 'negative') AS negative_count, count_if(sentiment = 'neutral') AS neutral_count,
       grouping(content_id, lang_name) AS gid
FROM lfacts GROUP BY GROUPING SETS ((content_id, lang_name), (lang_name))""", "lfacts"))
def q_language_sentiment(spark, sf):
    """A9."""
    return dashboard.language_sentiment(flows.language_facts(spark, sf, texts=False))


@register("flat_buckets", with_ctes("""
SELECT content_id, lang_name, count_if(sentiment = 'positive') AS pos, count_if(sentiment = 'negative') AS neg,
       count_if(sentiment NOT IN ('positive', 'negative')) AS neu,
       count_if(sentiment = 'negative' AND issue <> 'Other Issue' AND issue <> '') AS issue_count,
       count_if(sentiment = 'positive' AND strength <> '') AS strength_count
FROM lfacts GROUP BY content_id, lang_name""", "lfacts"))
def q_flat_buckets(spark, sf):
    """A10."""
    return dashboard.flat_buckets(flows.language_facts(spark, sf, texts=False))


def _lang_summary_sql(facts: str, lenient: bool) -> str:
    from ..fixed import LANG_ORDER, LANG_ORDER_LENIENT
    order = LANG_ORDER_LENIENT if lenient else LANG_ORDER
    case = "CASE name " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in order.items()) + " ELSE 99 END"
    where = "" if lenient else "WHERE matched"
    return with_ctes(f"""
SELECT *, row_number() OVER (ORDER BY lang_order, count DESC, name) AS display_rank FROM (
SELECT name, count, pct AS percent,
       CASE WHEN pct > 20.0::DOUBLE THEN 'dom' WHEN pct > 5.0::DOUBLE THEN 'bal' ELSE 'min' END AS skew_class,
       CASE WHEN pct > 40.0::DOUBLE THEN 'Dominant' WHEN pct > 20.0::DOUBLE THEN 'High'
            WHEN pct > 5.0::DOUBLE THEN 'Moderate' ELSE 'Low' END AS skew_label,
       positive_count, negative_count, neutral_count,
       CAST(positive_count AS DOUBLE) / lt * 100.0::DOUBLE AS positive_pct,
       CAST(negative_count AS DOUBLE) / lt * 100.0::DOUBLE AS negative_pct,
       CAST(neutral_count AS DOUBLE) / lt * 100.0::DOUBLE AS neutral_pct,
       {case} AS lang_order
FROM (SELECT lang_name AS name, count(*) AS count,
             CAST(count(*) AS DOUBLE) / CAST(greatest(1, sum(count(*)) OVER ()) AS DOUBLE) * 100.0::DOUBLE AS pct,
             count_if(sentiment = 'positive') AS positive_count, count_if(sentiment = 'negative') AS negative_count,
             count_if(sentiment = 'neutral') AS neutral_count,
             CAST(greatest(1, count(*)) AS DOUBLE) AS lt
      FROM {facts} {where} GROUP BY lang_name))""", facts)


@register("language_summary", _lang_summary_sql("lfacts", False))
def q_language_summary(spark, sf):
    """A11 + W8 + P23."""
    f = dashboard.language_rows_counted(flows.language_facts(spark, sf, texts=False))
    return dashboard.language_summary(f).withColumn("display_rank", L("display_rank"))


@register("language_summary_lenient", _lang_summary_sql("lfacts_len", True))
def q_language_summary_lenient(spark, sf):
    """A11 on the lenient profile (languages counted before the match)."""
    p = dashboard.LENIENT
    f = dashboard.language_rows_counted(flows.language_facts(spark, sf, p, texts=False), p)
    return dashboard.language_summary(f, lenient=True).withColumn("display_rank", L("display_rank"))


@register("detection_file_stats", with_ctes("""
SELECT content_id, count(*) AS samples, round(sum(latency), 9) AS total_latency, round(avg(latency), 9) AS mean_latency
FROM lang_in GROUP BY content_id""", "lang_in"))
def q_detection_file_stats(spark, sf):
    """A12."""
    d = language.detection_file_stats(flows.detection_input(spark, sf))
    return d.select("content_id", "samples", F.round("total_latency", 9).alias("total_latency"),
                    F.round("mean_latency", 9).alias("mean_latency"))


def _round_times(d: DataFrame) -> DataFrame:
    return d.withColumn("mean_latency", F.round("mean_latency", 9)).withColumn("throughput", F.round("throughput", 6))


@register("detection_summary", with_ctes("""
SELECT count(DISTINCT content_id) AS files, count(*) AS total_samples,
       count_if(predicted_language = 'ERROR') AS failed, count_if(predicted_language <> 'ERROR') AS successful,
       coalesce(CAST(count_if(predicted_language <> 'ERROR') AS DOUBLE) * 100.0::DOUBLE / CAST(count(*) AS DOUBLE), 0.0) AS success_pct,
       coalesce(CAST(count_if(predicted_language = 'ERROR') AS DOUBLE) * 100.0::DOUBLE / CAST(count(*) AS DOUBLE), 0.0) AS failed_pct,
       round(coalesce(avg(latency), 0.0), 9) AS mean_latency,
       round(CASE WHEN sum(latency) > 0 THEN CAST(count(*) AS DOUBLE) / sum(latency) ELSE 0.0::DOUBLE END, 6) AS throughput
FROM lang_in""", "lang_in"))
def q_detection_summary(spark, sf):
    """A13."""
    return _round_times(language.detection_summary(flows.detection_input(spark, sf)))


@register("token_usage", with_ctes("""
SELECT * FROM (
  SELECT content_id, substr(sentiment, 1, 3) || '_comment' AS prompt_kind,
         sum(usage_input) AS input_tokens, sum(usage_output) AS output_tokens, CAST(0 AS HUGEINT) AS thinking_tokens,
         sum(usage_input + usage_output) AS total_tokens, grouping(content_id, substr(sentiment, 1, 3) || '_comment') AS gid
  FROM analysis GROUP BY ROLLUP (content_id, substr(sentiment, 1, 3) || '_comment'))
WHERE total_tokens > 0""", "analysis"))
def q_token_usage(spark, sf):
    """Rollup per course x prompt kind."""
    return enrich.token_usage(flows.analysis(spark, sf))


def _ev(spark, sf) -> DataFrame:
    return evaluate.truth_label(flows.tagged(spark, sf, with_labels=True))


@register("confusion_matrix", with_ctes("""
SELECT t.label AS true_label, p.label AS predicted_label, coalesce(c.n, 0) AS count
FROM (SELECT DISTINCT true_label AS label FROM tagged_l UNION SELECT DISTINCT predicted_sentiment FROM tagged_l) t
CROSS JOIN (SELECT DISTINCT true_label AS label FROM tagged_l UNION SELECT DISTINCT predicted_sentiment FROM tagged_l) p
LEFT JOIN (SELECT true_label, predicted_sentiment, count(*) AS n FROM tagged_l GROUP BY ALL) c
  ON c.true_label = t.label AND c.predicted_sentiment = p.label""", "tagged_l"))
def q_confusion_matrix(spark, sf):
    """A15."""
    return evaluate.confusion_matrix(_ev(spark, sf))


_REPORT_SQL = """
pairs AS (SELECT content_id, true_label, predicted_sentiment, count(*) AS n, grouping(content_id) AS g
          FROM tagged_l GROUP BY GROUPING SETS ((content_id, true_label, predicted_sentiment),
                                               (true_label, predicted_sentiment))),
labs AS (SELECT DISTINCT g, content_id, true_label AS label FROM pairs
         UNION SELECT DISTINCT g, content_id, predicted_sentiment FROM pairs),
per AS (SELECT l.g, l.content_id, l.label,
               coalesce((SELECT sum(n) FROM pairs p WHERE p.g = l.g AND p.content_id IS NOT DISTINCT FROM l.content_id
                         AND p.true_label = l.label AND p.predicted_sentiment = l.label), 0) AS tp,
               coalesce((SELECT sum(n) FROM pairs p WHERE p.g = l.g AND p.content_id IS NOT DISTINCT FROM l.content_id
                         AND p.true_label = l.label), 0) AS support,
               coalesce((SELECT sum(n) FROM pairs p WHERE p.g = l.g AND p.content_id IS NOT DISTINCT FROM l.content_id
                         AND p.predicted_sentiment = l.label), 0) AS pred
        FROM labs l),
m AS (SELECT *, CASE WHEN pred > 0 THEN CAST(tp AS DOUBLE) / CAST(pred AS DOUBLE) ELSE 0.0::DOUBLE END AS precision,
             CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / CAST(support AS DOUBLE) ELSE 0.0::DOUBLE END AS recall
      FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                     ELSE 0.0::DOUBLE END AS f1 FROM m)
SELECT content_id, label, round(precision, 12) AS precision, round(recall, 12) AS recall, round(f1, 12) AS f1,
       support FROM (
SELECT content_id, label, precision, recall, f1, support FROM f
UNION ALL
SELECT content_id, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f GROUP BY g, content_id
UNION ALL
SELECT content_id, 'weighted avg', sum(precision * support) / CAST(sum(support) AS DOUBLE),
       sum(recall * support) / CAST(sum(support) AS DOUBLE), sum(f1 * support) / CAST(sum(support) AS DOUBLE),
       sum(support) FROM f GROUP BY g, content_id)"""


def _report_sql() -> str:
    base = with_ctes("SELECT 1", "tagged_l")
    return base[:-len("SELECT 1")].rstrip() + "," + _REPORT_SQL


@register("classification_report", _report_sql())
def q_classification_report(spark, sf):
    """Global rows have content_id null."""
    r = evaluate.classification_report(_ev(spark, sf))
    return r.withColumn("support", L("support"))


@register("accuracy", with_ctes("""
SELECT avg(CASE WHEN true_label = predicted_sentiment THEN 1.0 ELSE 0.0 END)::DOUBLE AS accuracy, count(*) AS n
FROM tagged_l""", "tagged_l"))
def q_accuracy(spark, sf):
    """A17."""
    return evaluate.accuracy(_ev(spark, sf))


@register("label_union", with_ctes(
    "SELECT true_label AS label FROM tagged_l UNION SELECT predicted_sentiment FROM tagged_l", "tagged_l"))
def q_label_union(spark, sf):
    """U2."""
    return evaluate.label_union(_ev(spark, sf))


@register("word_frequency", with_ctes("""
SELECT sentiment, rank, word, count, CAST(count AS DOUBLE) / CAST(max(count) OVER (PARTITION BY sentiment) AS DOUBLE) AS weight
FROM (SELECT sentiment, word, count(*) AS count,
             row_number() OVER (PARTITION BY sentiment ORDER BY count(*) DESC, word) AS rank
      FROM (SELECT lower(predicted_sentiment) AS sentiment, unnest(regexp_extract_all(lower(comment), '[\\p{L}\\p{M}]+')) AS word
            FROM full_t WHERE comment IS NOT NULL) t
      WHERE length(word) >= 2 AND word NOT IN (SELECT word FROM stop)
      GROUP BY sentiment, word)
WHERE rank <= 150""", "full_t", "stop"))
def q_word_frequency(spark, sf):
    """A18 + P10 + U3: top 150 words per sentiment over the full comments."""
    t = flows.full(spark, sf).filter(F.col("comment").isNotNull())
    return words.word_frequency(t).withColumn("rank", L("rank"))


@register("row_totals", _cs_sql(
    "SELECT CAST(coalesce(sum(total), 0) AS BIGINT) AS total_comments, count_if(NOT hidden) AS course_count FROM cs"))
def q_row_totals(spark, sf):
    """All comments, and the visible courses."""
    cs = dashboard.course_stats(flows.enriched(spark, sf))
    return cs.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total_comments"),
                  F.count_if(~F.col("hidden")).alias("course_count"))


# ============================================================================ windows / ranking
def _top_sql(kind: str, n: int, src: str = "enriched") -> str:
    col, cond = ("issue", "sentiment = 'negative' AND issue <> 'Other Issue' AND issue <> ''") if kind == "issue" \
        else ("strength", "sentiment = 'positive' AND strength <> ''")
    return with_ctes(f"""
SELECT rank, name, count, CAST(count AS DOUBLE) / CAST(greatest(1, all_n) AS DOUBLE) * 100.0::DOUBLE AS percent FROM (
  SELECT {col} AS name, count(*) AS count, sum(count(*)) OVER () AS all_n,
         row_number() OVER (ORDER BY count(*) DESC, min(ordinal)) AS rank
  FROM {src} WHERE {cond} GROUP BY {col}) WHERE rank <= {n}""", src)


@register("top_issues", _top_sql("issue", TOP_ISSUES))
def q_top_issues(spark, sf):
    """Top 15 issues with share of all issues."""
    return dashboard.top_categories(flows.enriched(spark, sf), "issue", TOP_ISSUES).withColumn("rank", L("rank"))


@register("top_issues_lenient", _top_sql("issue", TOP_ISSUES_LENIENT, "enriched_len"))
def q_top_issues_lenient(spark, sf):
    """W1, lenient profile: top 11."""
    e = flows.enriched(spark, sf, dashboard.LENIENT)
    return dashboard.top_categories(e, "issue", TOP_ISSUES_LENIENT).withColumn("rank", L("rank"))


@register("top_strengths", _top_sql("strength", TOP_STRENGTHS))
def q_top_strengths(spark, sf):
    """W2."""
    return dashboard.top_categories(flows.enriched(spark, sf), "strength", TOP_STRENGTHS).withColumn("rank", L("rank"))


@register("course_top_categories", _cs_sql("""
SELECT content_id, kind, rank, name, count FROM (
  SELECT content_id, kind, name, count(*) AS count,
         row_number() OVER (PARTITION BY content_id, kind ORDER BY count(*) DESC, min(ordinal)) AS rank
  FROM (SELECT content_id, ordinal, 'issue' AS kind, issue AS name FROM enriched
        WHERE sentiment = 'negative' AND issue <> 'Other Issue' AND issue <> ''
        UNION ALL
        SELECT content_id, ordinal, 'strength', strength FROM enriched WHERE sentiment = 'positive' AND strength <> '')
  GROUP BY content_id, kind, name)
WHERE rank <= 5 AND content_id IN (SELECT content_id FROM cs WHERE NOT hidden)"""))
def q_course_top_categories(spark, sf):
    """Top 5 issues and strengths per visible course."""
    return dashboard.course_top_categories(flows.enriched(spark, sf)).withColumn("rank", L("rank"))


@register("course_top_languages", with_ctes("""
SELECT content_id, rank, lang_code, upper(lang_code) AS badge, count FROM (
  SELECT content_id, lang_code, count(*) AS count,
         row_number() OVER (PARTITION BY content_id ORDER BY count(*) DESC, min(ordinal)) AS rank
  FROM lfacts WHERE matched GROUP BY content_id, lang_code)
WHERE rank <= 3""", "lfacts"))
def q_course_top_languages(spark, sf):
    """W4 + P25."""
    f = dashboard.language_rows_counted(flows.language_facts(spark, sf, texts=False))
    return dashboard.course_top_languages(f).withColumn("rank", L("rank"))


@register("bucket_categories", with_ctes("""
SELECT content_id, lang_name, kind, rank, name, count FROM (
  SELECT content_id, lang_name, kind, name, count(*) AS count,
         row_number() OVER (PARTITION BY content_id, lang_name, kind ORDER BY count(*) DESC, min(ordinal)) AS rank
  FROM (SELECT content_id, lang_name, ordinal, 'issue' AS kind, issue AS name FROM lfacts
        WHERE sentiment = 'negative' AND issue <> 'Other Issue' AND issue <> ''
        UNION ALL
        SELECT content_id, lang_name, ordinal, 'strength', strength FROM lfacts
        WHERE sentiment = 'positive' AND strength <> '')
  GROUP BY content_id, lang_name, kind, name)""", "lfacts"))
def q_bucket_categories(spark, sf):
    """W5."""
    return dashboard.bucket_categories(flows.language_facts(spark, sf, texts=False)).withColumn("rank", L("rank"))


@register("bucket_categories_lenient", with_ctes("""
SELECT content_id, lang_name, kind, rank, name, count FROM (
  SELECT content_id, lang_name, kind, name, count(*) AS count,
         row_number() OVER (PARTITION BY content_id, lang_name, kind ORDER BY count(*) DESC, min(ordinal)) AS rank
  FROM (SELECT content_id, lang_name, ordinal, 'issue' AS kind, issue AS name FROM lfacts_len
        WHERE sentiment = 'negative' AND issue <> 'Other Issue' AND issue <> ''
        UNION ALL
        SELECT content_id, lang_name, ordinal, 'strength', strength FROM lfacts_len
        WHERE sentiment = 'positive' AND strength <> '')
  GROUP BY content_id, lang_name, kind, name)
WHERE kind <> 'issue' OR rank <= 5""", "lfacts_len"))
def q_bucket_categories_lenient(spark, sf):
    """W5, lenient profile: only the top 5 issues per bucket."""
    p = dashboard.LENIENT
    f = flows.language_facts(spark, sf, p, texts=False)
    return dashboard.bucket_categories(f, p.bucket_issue_limit).withColumn("rank", L("rank"))


@register("detection_summary_lenient", with_ctes("""
SELECT count(DISTINCT content_id) AS files, count(*) AS total_samples,
       count_if(predicted_language IN ('ERROR', 'UNKNOWN')) AS failed,
       count_if(predicted_language NOT IN ('ERROR', 'UNKNOWN')) AS successful,
       coalesce(CAST(count_if(predicted_language NOT IN ('ERROR', 'UNKNOWN')) AS DOUBLE) * 100.0::DOUBLE / CAST(count(*) AS DOUBLE), 0.0) AS success_pct,
       coalesce(CAST(count_if(predicted_language IN ('ERROR', 'UNKNOWN')) AS DOUBLE) * 100.0::DOUBLE / CAST(count(*) AS DOUBLE), 0.0) AS failed_pct,
       round(coalesce(avg(latency), 0.0), 9) AS mean_latency,
       round(CASE WHEN sum(latency) > 0 THEN CAST(count(*) AS DOUBLE) / sum(latency) ELSE 0.0::DOUBLE END, 6) AS throughput
FROM lang_in_len""", "lang_in_len"))
def q_detection_summary_lenient(spark, sf):
    """A13, lenient profile: 'UNKNOWN' also counts as failed."""
    return _round_times(language.detection_summary(flows.detection_input(spark, sf, lenient=True),
                                                   failed_codes=("ERROR", "UNKNOWN")))


@register("detected_language_counts", with_ctes(
    "SELECT predicted_language, count(*) AS n FROM lang GROUP BY predicted_language", "lang"))
def q_detected_language_counts(spark, sf):
    """The detector's own summary: rows per detected code."""
    return language.detected_language_counts(flows.detected(spark, sf))


@register("dedup_latest", with_ctes(f"""
SELECT content_id, lang_name, sentiment, ordinal, date, {s_trim('comment')} AS comment,
       CASE sentiment WHEN 'negative' THEN issue WHEN 'positive' THEN strength ELSE '' END AS analysis FROM (
  SELECT *, row_number() OVER (PARTITION BY content_id, lang_name, sentiment, {s_trim('comment')}
                               ORDER BY date DESC, ordinal) AS rk FROM lfacts) WHERE rk = 1""", "lfacts"))
def q_dedup_latest(spark, sf):
    """One row per exact comment per bucket and sentiment, latest date first."""
    return dashboard.bucket_comments(flows.language_facts(spark, sf)).drop("record")


@register("sample_comments", with_ctes("""
SELECT content_id, sentiment, category, sample_rank, ordinal FROM (
  SELECT content_id, sentiment, coalesce(category, 'Other') AS category, ordinal,
         row_number() OVER (PARTITION BY content_id, sentiment, coalesce(category, 'Other') ORDER BY ordinal) AS sample_rank
  FROM analysis) WHERE sample_rank <= 5""", "analysis"))
def q_sample_comments(spark, sf):
    """First 5 comments per category."""
    s = category.sample_comments(flows.analysis(spark, sf))
    return s.select("content_id", "sentiment", "category", L("sample_rank").alias("sample_rank"), "ordinal")


_TIER_COLS = ["content_id", "sentiment", "category", "count", "share", "rank", "tier", "urgency", "noise"]


@register("tier", with_ctes(f"SELECT {', '.join(_TIER_COLS)} FROM tiered", "tiered"))
def q_tier(spark, sf):
    """W10 (+W11, W12 columns)."""
    t = flows.tiered(spark, sf)
    return t.select(*[L(c).alias(c) if c == "rank" else F.col(c) for c in _TIER_COLS])


@register("urgency", with_ctes(
    "SELECT sentiment, urgency, count(*) AS n FROM tiered GROUP BY sentiment, urgency", "tiered"))
def q_urgency(spark, sf):
    """Categories per urgency level."""
    return flows.tiered(spark, sf).groupBy("sentiment", "urgency").agg(F.count(F.lit(1)).alias("n"))


@register("noise_flag", with_ctes(
    "SELECT content_id, sentiment, category, low_signal_count, noise FROM tiered", "tiered"))
def q_noise_flag(spark, sf):
    """W12."""
    return flows.tiered(spark, sf).select("content_id", "sentiment", "category", "low_signal_count", "noise")


@register("top_priority_actions", with_ctes("""
SELECT content_id, action_rank, action, category, owner, priority FROM (
  SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY fill, prio_rank, rank, action_pos) AS action_rank FROM (
    SELECT *, row_number() OVER (PARTITION BY content_id, action ORDER BY fill, prio_rank, rank, action_pos) AS d FROM (
      SELECT content_id, category, rank, owner, priority,
             CASE WHEN noise THEN 2 WHEN tier = 'excluded' THEN 1 ELSE 0 END AS fill,
             CASE priority WHEN 'Critical' THEN 1 WHEN 'High' THEN 2 WHEN 'Medium' THEN 3 WHEN 'Low' THEN 4 ELSE 5 END AS prio_rank,
             unnest(actions) AS action, generate_subscripts(actions, 1) - 1 AS action_pos
      FROM tiered WHERE sentiment = 'negative'))
  WHERE d = 1)
WHERE action_rank <= 3""", "tiered"))
def q_top_priority_actions(spark, sf):
    """W13."""
    a = category.top_priority_actions(flows.tiered(spark, sf))
    return a.withColumn("action_rank", L("action_rank"))


@register("amplify_top3", with_ctes("""
SELECT content_id, category, rank, tier, CASE WHEN rank <= 3 AND NOT noise THEN actions[1] END AS amplification_suggestion
FROM tiered WHERE sentiment = 'positive'""", "tiered"))
def q_amplify_top3(spark, sf):
    """W14."""
    return category.amplify_top(flows.tiered(spark, sf)).withColumn("rank", L("rank"))


@register("top_strengths_list", with_ctes("""
SELECT content_id, strength_rank, category, count FROM (
  SELECT content_id, category, count, row_number() OVER (PARTITION BY content_id ORDER BY rank) AS strength_rank
  FROM tiered WHERE sentiment = 'positive' AND tier <> 'excluded') WHERE strength_rank <= 3""", "tiered"))
def q_top_strengths_list(spark, sf):
    """W15."""
    return category.top_strengths(flows.tiered(spark, sf)).withColumn("strength_rank", L("strength_rank"))


@register("category_block", with_ctes("""
SELECT content_id, sentiment, total AS total_count,
       string_agg(block, chr(10) ORDER BY rank) AS category_data
FROM (SELECT g.content_id, g.sentiment, g.total, g.rank,
             concat_ws(chr(10),
               chr(10) || '### Category: ' || g.category,
               '- Comment count: ' || CAST(g.count AS VARCHAR) || ' (' ||
                 printf('%.1f', CAST(g.count AS DOUBLE) / CAST(greatest(1, g.total) AS DOUBLE) * 100.0::DOUBLE) || '% of total)',
               '- Root Cause: ' || g.root_cause, '- Owner: ' || g.owner, '- Priority: ' || g.priority,
               CASE WHEN len(g.actions) > 0 THEN '- Sample Recommended Actions: ' || array_to_string(g.actions[1:3], ', ') END,
               '- Sample Comments (up to 5):',
               (SELECT string_agg('  * "' || s.comment || '"', chr(10) ORDER BY s.rn) FROM (
                  SELECT comment, row_number() OVER (ORDER BY ordinal) AS rn FROM analysis a
                  WHERE a.content_id = g.content_id AND a.sentiment = g.sentiment
                    AND coalesce(a.category, 'Other') = g.category) s WHERE s.rn <= 5)) AS block
      FROM groups_meta g)
GROUP BY content_id, sentiment, total""", "groups_meta", "analysis"))
def q_category_block(spark, sf):
    """P26 (+W9): the text block per course and sentiment."""
    from ..session import materialize
    a = materialize(flows.analysis(spark, sf))        # two branches read it
    return category.category_block(category.category_groups(a), category.sample_comments(a))


# ============================================================================ sets
@register("union_courses", with_ctes("""
SELECT origin, content_id, count(*) AS n FROM (
  SELECT 'documents' AS origin, content_id FROM clean
  UNION ALL
  SELECT 'conversations', content_id FROM (
    SELECT 'course_' || CAST(conv_id % 5 AS VARCHAR) AS content_id,
           regexp_replace(coalesce(text, ''), '^[\\t\\n\\x0b\\f\\r \\x1c-\\x1f\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+|[\\t\\n\\x0b\\f\\r \\x1c-\\x1f\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+$', '', 'g') AS c
    FROM conversations) WHERE c <> '')
GROUP BY origin, content_id""", "clean"))
def q_union_courses(spark, sf):
    """Comments from both sources accumulated by name."""
    d = clean.clean_comments(raw_comments(spark, sf)).select("content_id", F.lit("documents").alias("origin"))
    c = clean.clean_comments(conversation_comments(spark, sf)).select("content_id",
                                                                     F.lit("conversations").alias("origin"))
    return d.unionByName(c).groupBy("origin", "content_id").agg(F.count(F.lit(1)).alias("n"))


# ============================================================================ hooks and exports
def _default_categoriser(text: str) -> dict:
    """A client of a remote model would stand here; this one applies the keyword rule, and
    fails on some texts as a service does."""
    import re
    from collections import Counter
    from ..fixed import CATEGORY_KEYWORDS, FALLBACK_CATEGORY_NO, NEGATIVE_TAXONOMY
    if len(text or "") % 17 == 0:
        raise ValueError("no answer")
    counts = Counter(re.findall(r"[^\W\d_]+", (text or "").lower()))
    hits = [(sum(counts[w] for w in set(words)), -no) for no, words in CATEGORY_KEYWORDS]
    best = max(hits)
    no = -best[1] if best[0] else FALLBACK_CATEGORY_NO
    return {"category_no": no, "category": NEGATIVE_TAXONOMY[no - 1][1]}


@register("enrich_partitions", with_ctes("""
SELECT content_id, ordinal, CASE WHEN length(comment) % 17 <> 0 THEN CAST(category_no AS BIGINT) END AS category_no,
       CASE WHEN length(comment) % 17 <> 0 THEN category END AS category,
       CASE WHEN length(comment) % 17 = 0 THEN 'ERROR: no answer' END AS error,
       CAST(CASE WHEN length(comment) % 17 = 0 THEN 2 ELSE 1 END AS BIGINT) AS attempts
FROM categorized WHERE sentiment = 'negative'""", "categorized"))
def q_enrich_partitions(spark, sf):
    """Negative comments categorised through the per-partition hook (bounded
    parallelism, retry, errors as data)."""
    t = sentiment.sentiment_filter(flows.tagged_input(spark, sf), "negative").select("content_id", "ordinal", "comment")
    schema = T.StructType([T.StructField("category_no", T.LongType()), T.StructField("category", T.StringType())])
    out = enrich.enrich_partitions(t, _default_categoriser, "comment", schema, partitions=spark.sparkContext.defaultParallelism, max_tries=2, other_delay=0.0)
    return out.select("content_id", "ordinal", "category_no", "category", "error", L("attempts").alias("attempts"))


_MODEL_SQL = f"""
tok AS (SELECT ordinal, true_lang, unnest({s_tokens('comment')}) AS w FROM clean WHERE bucket = 'full'),
vocab AS (SELECT w FROM tok GROUP BY w ORDER BY count(*) DESC, w LIMIT {models.VOCABULARY}),
cnt AS (SELECT l.lang, v.w, (SELECT count(*) FROM vocab) AS size, coalesce(c.n, 0) AS n
        FROM (SELECT DISTINCT true_lang AS lang FROM clean WHERE bucket = 'full') l CROSS JOIN vocab v
        LEFT JOIN (SELECT true_lang, w, count(*) AS n FROM tok GROUP BY 1, 2) c ON c.true_lang = l.lang AND c.w = v.w),
wt AS (SELECT lang, w, ln((n + 1)::DOUBLE / (sum(n) OVER (PARTITION BY lang) + size)::DOUBLE) AS lw FROM cnt),
prior AS (SELECT true_lang AS lang, ln(count(*)::DOUBLE / sum(count(*)) OVER ()::DOUBLE) AS lp FROM clean WHERE bucket = 'full' GROUP BY 1),
score AS (SELECT t.ordinal, wt.lang, sum(wt.lw) AS s FROM tok t JOIN wt USING (w) GROUP BY 1, 2)
SELECT ordinal, language FROM (
  SELECT c.ordinal, p.lang AS language, row_number() OVER (PARTITION BY c.ordinal ORDER BY p.lp + coalesce(s.s, 0.0::DOUBLE) DESC, p.lang) AS rk
  FROM clean c CROSS JOIN prior p LEFT JOIN score s ON s.ordinal = c.ordinal AND s.lang = p.lang WHERE c.bucket = 'full') WHERE rk = 1"""
_MODEL_SQL = with_ctes("SELECT 1", "clean")[:-len("SELECT 1")].rstrip() + "," + _MODEL_SQL


def _full_words(spark, sf) -> tuple[DataFrame, models.WordModel]:
    """Full comments as the model reads them, and a language model trained on them."""
    full = clean.clean_comments(raw_comments(spark, sf)).filter(F.col("bucket") == "full")
    return full.select("ordinal", models.word_text("comment").alias("words")), models.train(full, "true_lang", "comment")


@register("model_language", _MODEL_SQL)
def q_model_language(spark, sf):
    """E2 by a local model: naive Bayes over words, trained on the comments, loaded once a task."""
    rows, model = _full_words(spark, sf)
    label = enrich.model_udf(lambda: model, lambda m, words: m.predict(words))
    return rows.select("ordinal", label("words").alias("language"))


@register("enrich_resumable", _MODEL_SQL.replace("SELECT ordinal, language FROM (", "SELECT ordinal, language, CAST(NULL AS VARCHAR) AS error, CAST(1 AS BIGINT) AS attempts FROM ("))
def q_enrich_resumable(spark, sf):
    """E4 with the local model as its client: asked row by row, kept slice by slice; the second call finds all slices there."""
    rows, model = _full_words(spark, sf)
    path = _scratch(spark, "enriched")
    schema = T.StructType([T.StructField("language", T.StringType())])
    ask = lambda words: {"language": model.label(words)}
    for _ in range(2):
        out = enrich.enrich_resumable(rows, ask, "ordinal", "words", schema, path, slices=32, max_tries=1)
    return out.select("ordinal", "language", "error", L("attempts").alias("attempts"))


def _documents(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    return _documents_of(flows.tiered(spark, sf))


def _documents_of(tiered: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    t = materialize(tiered, "tiered")        # a row per course, sentiment and category
    return documents.negative_documents(t, category.top_priority_actions(t)), documents.positive_documents(t), t


_DOC_SQL = """
SELECT t.content_id, t.sentiment, t.rank - 1 AS pos, t.category, t.count, t.share * 100.0::DOUBLE AS percent, t.tier,
       CASE WHEN t.sentiment = 'negative' THEN t.urgency END AS urgency,
       CASE WHEN t.sentiment = 'positive' AND t.rank <= 3 AND NOT t.noise THEN t.actions[1] END AS suggestion,
       CAST(CASE WHEN t.tier = 'excluded' OR (t.sentiment = 'negative' AND t.noise) THEN 0
                 WHEN t.sentiment = 'positive' THEN least(3, len(t.actions))
                 ELSE (SELECT least(3, count(*)) FROM (SELECT unnest(t.actions) AS a) x
                       WHERE NOT EXISTS (SELECT 1 FROM tiered o WHERE o.content_id = t.content_id AND o.sentiment = 'negative'
                         AND o.tier <> 'excluded' AND NOT o.noise AND list_contains(o.actions, x.a) AND
                         (CASE o.priority WHEN 'Critical' THEN 1 WHEN 'High' THEN 2 WHEN 'Medium' THEN 3 WHEN 'Low' THEN 4 ELSE 5 END, o.rank)
                         < (CASE t.priority WHEN 'Critical' THEN 1 WHEN 'High' THEN 2 WHEN 'Medium' THEN 3 WHEN 'Low' THEN 4 ELSE 5 END, t.rank)))
            END AS BIGINT) AS n_actions
FROM tiered t"""


def _flat_documents(neg: DataFrame, pos: DataFrame) -> DataFrame:
    def flat(docs, s):
        i = docs.select("content_id", F.lit(s).alias("sentiment"), F.posexplode("category_summaries").alias("pos", "i"))
        null = F.lit(None).cast("string")
        return i.select("content_id", "sentiment", L("pos").alias("pos"), "i.category", "i.count", F.col(f"i.percent_of_{s}").alias("percent"), "i.tier",
                        (F.col("i.urgency") if s == "negative" else null).alias("urgency"),
                        (F.col("i.amplification_suggestion") if s == "positive" else null).alias("suggestion"),
                        L(F.size("i.action_items")).alias("n_actions"))
    return flat(neg, "negative").unionByName(flat(pos, "positive"))


@register("category_summary", with_ctes(_DOC_SQL, "tiered"))
def q_category_summary(spark, sf):
    """E5: the categories of the summary documents, one row each."""
    neg, pos, _ = _documents(spark, sf)
    return _flat_documents(neg, pos)


@register("library_summary", with_ctes(_DOC_SQL.replace("tiered", "tiered_own"), "tiered_own"))
def q_library_summary(spark, sf):
    """E1 to E3 to A6 to E5 end to end: summary documents from raw text by the library's own labels, in stages; the second
    run finds them all finished."""
    folder = _scratch(spark, "library")
    for _ in range(2):
        made = staged.run(spark, staged.library_stages(spark, sf), folder, keep=("negative", "positive"))
    return _flat_documents(made["negative"], made["positive"])


@register("scan_category_summaries", with_ctes(f"""
SELECT content_id, category, count, tier, n_actions FROM ({_DOC_SQL}) d WHERE sentiment = 'negative'""", "tiered"))
def q_scan_category_summaries(spark, sf):
    """S6 (+K4): documents written per course and read back with the course from the path."""
    from ..schemas import NEGATIVE_SUMMARY_SCHEMA
    neg, _, _ = _documents(spark, sf)
    path = _scratch(spark, "summary-json")
    sinks.write_summary_json(neg, path)
    docs = src.scan_category_summaries(spark, path, NEGATIVE_SUMMARY_SCHEMA, by_folder=True)
    good, _ = src.split_rejects(docs.withColumn("reject_reason", F.when(F.col("_corrupt_record").isNotNull(), "unreadable")))
    return good.select(F.col("summary_course").alias("content_id"), F.explode("category_summaries").alias("i")).select(
        "content_id", "i.category", "i.count", "i.tier", L(F.size("i.action_items")).alias("n_actions"))


@register("summary_contract", with_ctes("""
SELECT content_id, sentiment, category, 'count differs' AS rule FROM tiered WHERE content_id = 'course_0' AND sentiment = 'negative'
UNION ALL
SELECT content_id, sentiment, category, 'too few actions' FROM tiered
WHERE content_id = 'course_1' AND sentiment = 'positive' AND tier <> 'excluded'
UNION ALL
SELECT DISTINCT content_id, sentiment, NULL, 'top actions not exactly 3' FROM tiered WHERE content_id = 'course_2' AND sentiment = 'negative'""",
                                        "tiered"))
def q_summary_contract(spark, sf):
    """What the contract finds in the documents after three planted faults."""
    neg, pos, t = _documents(spark, sf)
    wrong = F.transform("category_summaries", lambda i: i.withField("count", i["count"] + 1))
    neg = neg.withColumn("category_summaries", F.when(F.col("content_id") == "course_0", wrong).otherwise(F.col("category_summaries")))
    neg = neg.withColumn("top_priority_actions", F.when(F.col("content_id") == "course_2", F.slice("top_priority_actions", 1, 2))
                         .otherwise(F.col("top_priority_actions")))
    bare = F.transform("category_summaries", lambda i: i.withField("action_items", F.slice(i["action_items"], 1, 1)))
    pos = pos.withColumn("category_summaries", F.when(F.col("content_id") == "course_1", bare).otherwise(F.col("category_summaries")))
    return documents.contract(neg, pos, t)


@register("join_course_summary", _cs_sql("""
SELECT c.content_id, c.total, CAST(coalesce(g.neg, 0) AS BIGINT) AS negative_comments, CAST(coalesce(g.neg_n, 0) AS BIGINT) AS negative_categories,
       CAST(coalesce(g.pos, 0) AS BIGINT) AS positive_comments, CAST(coalesce(g.pos_n, 0) AS BIGINT) AS positive_categories
FROM cs c LEFT JOIN (
  SELECT content_id, max(total) FILTER (sentiment = 'negative') AS neg, count(*) FILTER (sentiment = 'negative') AS neg_n,
         max(total) FILTER (sentiment = 'positive') AS pos, count(*) FILTER (sentiment = 'positive') AS pos_n
  FROM (SELECT content_id, sentiment, category, CAST(sum(n) OVER (PARTITION BY content_id, sentiment) AS BIGINT) AS total
        FROM (SELECT content_id, sentiment, coalesce(category, 'Other') AS category, count(*) AS n
              FROM analysis WHERE content_id <> 'course_4' GROUP BY 1, 2, 3)) GROUP BY content_id) g USING (content_id)
WHERE NOT c.hidden""", "analysis"))
def q_join_course_summary(spark, sf):
    """Course stats with their summary documents attached; the last course has none, so its
    documents are empty."""
    neg, pos, _ = _documents(spark, sf)
    cs = dashboard.course_stats(flows.enriched(spark, sf)).filter(~F.col("hidden")).select("content_id", "total")
    out = documents.attach(cs, *(d.filter(F.col("content_id") != "course_4") for d in (neg, pos)))
    n = lambda c, p: F.coalesce(F.get_json_object(c, p).cast("long"), F.lit(0)).cast("long")
    size = lambda c: L(F.coalesce(F.json_array_length(F.get_json_object(c, "$.category_summaries")), F.lit(0)))
    return out.select("content_id", "total", n("neg_category_summary", "$.total_negative_comments").alias("negative_comments"),
                      size("neg_category_summary").alias("negative_categories"),
                      n("pos_category_summary", "$.total_positive_comments").alias("positive_comments"),
                      size("pos_category_summary").alias("positive_categories"))


_USAGE4 = """SELECT content_id, substr(sentiment, 1, 3) || '_comment' AS prompt_kind, usage_input AS i, usage_output AS o FROM analysis
  UNION ALL
  SELECT content_id, substr(sentiment, 1, 3) || '_summary', total, count(*) FROM groups GROUP BY content_id, sentiment, total"""


def _usage_rows(spark, sf) -> DataFrame:
    """Usage of all four prompt kinds: one call per comment, one per course and sentiment."""
    a = flows.analysis(spark, sf)
    made = category.category_groups(a).groupBy("content_id", "sentiment").agg(F.max("total").alias("i"), F.count(F.lit(1)).alias("o"))
    usage = F.struct(F.col("i").alias("input"), F.col("o").alias("output"), F.lit(0).cast("long").alias("thinking"), (F.col("i") + F.col("o")).alias("total"))
    return a.select("content_id", enrich.prompt_kind(F.col("sentiment")).alias("prompt_kind"), "usage").unionByName(
        made.select("content_id", enrich.prompt_kind(F.col("sentiment"), "summary").alias("prompt_kind"), usage.alias("usage")))


@register("append_usage", with_ctes(f"""
SELECT * FROM (SELECT content_id, prompt_kind, CAST(sum(i) AS BIGINT) AS input_tokens, CAST(sum(o) AS BIGINT) AS output_tokens,
       CAST(0 AS BIGINT) AS thinking_tokens, CAST(sum(i + o) AS BIGINT) AS total_tokens, grouping(content_id, prompt_kind) AS gid
FROM ({_USAGE4}) u GROUP BY ROLLUP (content_id, prompt_kind)) CROSS JOIN (VALUES ('run-1'), ('run-2')) r(run_id)
WHERE total_tokens > 0""", "analysis", "groups"))
def q_append_usage(spark, sf):
    """K6 + A14 with all four prompt kinds: the usage of two runs in one table, the second run written twice."""
    path = _scratch(spark, "usage")
    # the runs find the same usage: its rows are made once and appended three times
    rows = materialize(_usage_rows(spark, sf), "usage-rows")
    for run in ("run-1", "run-2", "run-2"):
        sinks.append_usage(rows, path, run_id=run)
    return src.scan_usage(spark, path)


_PAYLOAD_SQL = """
SELECT 'total' AS part, '' AS key, 'total_comments' AS field, format('{:,}', CAST(count(*) AS BIGINT)) AS value FROM enriched
UNION ALL SELECT 'total', '', 'overall_' || s || '_percent',
  printf('%.1f', CAST(count_if(sentiment = s) AS DOUBLE) / CAST(greatest(1, count(*)) AS DOUBLE) * 100.0::DOUBLE)
  FROM enriched CROSS JOIN (VALUES ('positive'), ('negative'), ('neutral')) v(s) GROUP BY s
UNION ALL SELECT 'total', '', 'total_course_count', CAST(count_if(NOT hidden) AS VARCHAR) FROM cs
UNION ALL SELECT 'course', content_id, 'total_comments', format('{:,}', total) FROM cs WHERE NOT hidden
UNION ALL SELECT 'course', content_id, 'alert_label', alert_label FROM cs WHERE NOT hidden
UNION ALL SELECT 'course', content_id, 'issues', CAST(count(DISTINCT issue) AS VARCHAR) FROM (
  SELECT content_id, issue, row_number() OVER (PARTITION BY content_id ORDER BY count(*) DESC, min(ordinal)) AS rk FROM enriched
  WHERE sentiment = 'negative' AND issue <> 'Other Issue' AND issue <> '' GROUP BY content_id, issue) WHERE rk <= 5
  AND content_id IN (SELECT content_id FROM cs WHERE NOT hidden) GROUP BY content_id
UNION ALL SELECT 'bucket', content_id || '/' || lang_name, 'negative_comments', CAST(count(DISTINCT trim(comment)) AS VARCHAR)
  FROM lfacts WHERE sentiment = 'negative' GROUP BY 2
UNION ALL SELECT 'bucket', content_id || '/' || lang_name, 'pos', CAST(count_if(sentiment = 'positive') AS VARCHAR) FROM lfacts GROUP BY 2
UNION ALL SELECT 'bucket', content_id || '/' || lang_name, 'strengths', CAST(count(DISTINCT strength) AS VARCHAR)
  FROM lfacts WHERE sentiment = 'positive' AND strength <> '' GROUP BY 2"""


@register("dashboard_payload", (lambda base: base[:-len("SELECT 1")].rstrip() + ",\n" + CTES_CS + _PAYLOAD_SQL)(with_ctes("SELECT 1", "enriched", "lfacts")))
def q_dashboard_payload(spark, sf):
    """K5 (+P21, A10): the payload rows read back from their JSON: totals, courses, buckets and the buckets' comments."""
    scored = flows.scored_full(spark, sf, with_language=True)
    enr, facts = flows.dashboard_facts(spark, sf, scored=scored)
    neg, pos, _ = _documents_of(category.tiers(category.category_groups(flows.analysis_of(scored))))
    # one table of courses and one of category counts serve all parts
    stats, counts = materialize(dashboard.course_stats(enr), "courses"), materialize(dashboard.category_counts(enr), "categories")
    total = dashboard.dashboard_payload(enr, facts, courses=stats, counts=counts)
    courses = documents.attach(dashboard.course_payload(enr, facts, courses=stats, counts=counts), neg, pos)
    buckets = dashboard.bucket_payload(facts, enr, courses=stats)
    # the comment lists of all buckets and sentiments, as rows with their analysis
    listed = materialize(dashboard.bucket_rows(facts), "bucket-rows")
    key = F.concat_ws("/", "content_id", "lang_name").alias("key")
    listed = listed.select(key, F.concat(F.get_json_object("payload", "$.sentiment"), F.lit("_comments")).alias("field"),
                           tx.text_key(F.get_json_object("payload", "$.comment")).alias("text"))
    listed = listed.groupBy("key", "field").agg(F.count_distinct("text").cast("string").alias("value"))
    field = lambda name, path=None: F.struct(F.lit(name).alias("field"), F.get_json_object("payload", f"$.{path or name}").alias("value"))
    n_of = lambda name: F.struct(F.lit(name).alias("field"), F.json_array_length(F.get_json_object("payload", f"$.{name}")).cast("string").alias("value"))
    rows = [
        total.select(F.lit("total").alias("part"), F.lit("").alias("key"), F.explode(F.array(
            field("total_comments"), field("total_course_count"), *[field(f"overall_{s}_percent") for s in ("positive", "negative", "neutral")])).alias("f")),
        courses.select(F.lit("course").alias("part"), F.col("content_id").alias("key"), F.explode(F.array(
            field("total_comments"), field("alert_label"), n_of("issues"))).alias("f")).filter("f.value <> '0' or f.field <> 'issues'"),
        buckets.select(F.lit("bucket").alias("part"), key, F.explode(F.array(
            field("pos"), n_of("strengths"))).alias("f")).filter("f.value <> '0' or f.field <> 'strengths'"),
        listed.filter("field = 'negative_comments'").select(F.lit("bucket").alias("part"), "key", F.struct("field", "value").alias("f")),
    ]
    return functools.reduce(DataFrame.unionByName, rows).select("part", "key", "f.field", "f.value")


# the analysis record of a comment is the one of the last analysis of its (course, sentiment, text), by the last comment of its text
_BUCKET_ROWS = f""",
a_rec AS (SELECT * FROM (SELECT content_id, sentiment, {s_norm('comment')} AS norm, category, root_cause, owner, priority, actions,
            row_number() OVER (PARTITION BY content_id, sentiment, {s_norm('comment')} ORDER BY ordinal DESC) AS rk FROM analysis) WHERE rk = 1),
deduped AS (SELECT * FROM (SELECT *, {s_trim('comment')} AS text, row_number() OVER (PARTITION BY content_id, lang_name, sentiment, {s_trim('comment')}
            ORDER BY date DESC, ordinal) AS rk FROM lfacts) WHERE rk = 1)
SELECT d.content_id, d.lang_name, d.sentiment, row_number() OVER (PARTITION BY d.content_id, d.lang_name, d.sentiment ORDER BY d.date DESC, d.ordinal) AS rank,
       d.text AS comment, d.date, CASE d.sentiment WHEN 'negative' THEN a.category END AS issue, CASE d.sentiment WHEN 'positive' THEN a.category END AS strength,
       a.root_cause, a.owner, a.priority, array_to_string(a.actions, ' | ') AS actions
FROM deduped d LEFT JOIN a_rec a ON d.sentiment <> 'neutral' AND a.content_id = d.content_id AND a.sentiment = d.sentiment
  AND a.norm = {s_norm('d.comment')}"""


@register("bucket_rows", with_ctes("SELECT 1", "analysis", "lfacts")[:-len("SELECT 1")].rstrip() + _BUCKET_ROWS)
def q_bucket_rows(spark, sf):
    """K5 / A10: every deduplicated comment of every bucket as a ranked JSON row, written in order, read back from its JSON."""
    path = _scratch(spark, "bucket-rows")
    _, facts = flows.dashboard_facts(spark, sf)
    sinks.write_bucket_rows(dashboard.bucket_rows(facts), path)
    names = fixed.ANALYSIS_FIELDS
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("comment", "date", "language", "sentiment")] + [T.StructField("analysis", T.StructType(
        [T.StructField(names[c], T.StringType()) for c in ("issue", "strength", "root_cause", "owner", "priority")]
        + [T.StructField(names["actions"], T.ArrayType(T.StringType()))]))])
    rows = src.scan_bucket_rows(spark, path).withColumn("p", F.from_json("payload", schema))
    part = lambda c: F.col(f"p.analysis.`{names[c]}`")
    return rows.select("content_id", "lang_name", "sentiment", "rank", "p.comment", "p.date", *(part(c).alias(c) for c in ("issue", "strength", "root_cause", "owner", "priority")),
                       F.array_join(part("actions"), " | ").alias("actions"))


@register("category_members", with_ctes("""
SELECT content_id, sentiment, coalesce(category, 'Other') AS category, ordinal,
       row_number() OVER (PARTITION BY content_id, sentiment, coalesce(category, 'Other') ORDER BY ordinal) AS rank FROM analysis""", "analysis"))
def q_category_members(spark, sf):
    """All comments of every (course, sentiment, category) in input order, with gapless ranks."""
    return category.group_members(flows.analysis(spark, sf)).select("content_id", "sentiment", "category", "ordinal", "rank")


@register("write_split", with_ctes("SELECT content_id, content_name, comment, comment_date, word_count, ordinal, bucket FROM clean", "clean"))
def q_write_split(spark, sf):
    """K1: short / full files per course (CSV), read back."""
    path = _scratch(spark, "split-csv")
    s = flows.split(spark, sf)
    sinks.write_split(s, path)
    schema = T.StructType([f for f in TAGGED_FILE_SCHEMA.fields if f.name in ("content_name", "comment", "comment_date", "ordinal")])
    df = src.scan_course_files(spark, path, schema, recursive=True)
    return df.select(F.col("source_course").alias("content_id"), F.coalesce("content_name", F.lit("")).alias("content_name"),
                     F.coalesce("comment", F.lit("")).alias("comment"), F.coalesce("comment_date", F.lit("")).alias("comment_date"),
                     L(tx.word_count(F.col("comment"))).alias("word_count"), "ordinal",
                     F.regexp_extract(F.col("_metadata.file_path"), "bucket=([^/]+)/", 1).alias("bucket"))


def _report_lines_sql(bucket: str, label: str) -> str:
    return f"""SELECT content_id || '.csv: ' || CAST(count(*) AS VARCHAR) AS line, CAST(1 AS BIGINT) AS part, content_id AS k FROM split
WHERE bucket = '{bucket}' GROUP BY content_id
UNION ALL SELECT 'Total: ' || CAST(count(*) AS VARCHAR), 3, '' FROM split WHERE bucket = '{bucket}'
UNION ALL SELECT * FROM (VALUES ('{label} count summary:', 0, ''), ('{"-" * 40}', 0, '~'), ('{"-" * 40}', 2, '')) v"""


@register("report_lines", with_ctes(f"""
SELECT 'full' AS report, * FROM ({_report_lines_sql('full', 'Comments (> 3 words)')}) a
UNION ALL SELECT 'short', * FROM ({_report_lines_sql('short', 'Comments (<= 3 words)')}) b""", "split"))
def q_report_lines(spark, sf):
    """K7: the count report lines of the full and the short bucket."""
    s = flows.split(spark, sf)
    out = []
    for bucket, label in (("full", "Comments (> 3 words)"), ("short", "Comments (<= 3 words)")):
        c = s.filter(F.col("bucket") == bucket).groupBy("content_id").agg(F.count(F.lit(1)).alias("n"))
        out.append(sinks.count_report_lines(c, label).select(F.lit(bucket).alias("report"), "line", L("part").alias("part"), "k"))
    return out[0].unionByName(out[1])


_DET = """summary AS (SELECT count(DISTINCT content_id) AS files, count(*) AS n, count_if(predicted_language = 'ERROR') AS failed,
  avg(latency) AS ml, count(*) / sum(latency) AS tp FROM lang_in)"""


@register("report_detection", with_ctes("SELECT 1", "lang_in")[:-len("SELECT 1")].rstrip() + ",\n" + _DET + """
SELECT * FROM (VALUES ('--- DETECTION ---', CAST(0 AS BIGINT), ''), ('Language Breakdown:', 4, ''), ('Overall Benchmark Results:', 6, '')) v(line, part, k)
UNION ALL SELECT 'Total Comments Processed: ' || n, 1, '' FROM summary
UNION ALL SELECT 'Blank/Failed Detections: ' || failed || ' (' || printf('%.2f', failed * 100.0::DOUBLE / n) || '%)', 2, '' FROM summary
UNION ALL SELECT 'Successful Detections: ' || (n - failed) || ' (' || printf('%.2f', (n - failed) * 100.0::DOUBLE / n) || '%)', 3, '' FROM summary
UNION ALL SELECT '  • Total Files Processed: ' || files, 7, '' FROM summary
UNION ALL SELECT '  • Total Samples Processed: ' || n, 8, '' FROM summary
UNION ALL SELECT '  • Overall Average Latency: ' || printf('%.4f', ml) || ' sec/sample', 9, '' FROM summary
UNION ALL SELECT '  • Overall Throughput: ' || printf('%.2f', tp) || ' samples/sec', 10, '' FROM summary
UNION ALL SELECT '  ' || predicted_language || ': ' || count(*) || ' (' || printf('%.2f', count(*) * 100.0::DOUBLE / any_value(s.n)) || '%)', 5,
  lpad(CAST(1000000000000000 - count(*) AS VARCHAR), 16, '0') || predicted_language
  FROM lang_in CROSS JOIN summary s WHERE predicted_language <> 'ERROR' GROUP BY predicted_language""")
def q_report_detection(spark, sf):
    """K7: the detection report."""
    from ..session import materialize
    d = materialize(flows.detection_input(spark, sf).select("content_id", "predicted_language", "latency"), "detection")
    out = sinks.detection_report_lines(language.detection_summary(d), language.detected_language_counts(d))
    return out.withColumn("part", L("part"))


@register("report_usage", with_ctes(f"""
SELECT line, CAST(part AS BIGINT) AS part, k FROM (
  SELECT unnest(['  ' || coalesce(content_id || ' ' || prompt_kind, 'GRAND TOTAL'), '    input:    ' || format('{{:,}}', i), '    output:   ' || format('{{:,}}', o),
                 '    thinking: 0', '    total:    ' || format('{{:,}}', i + o)]) AS line,
         CASE WHEN content_id IS NULL THEN 2 ELSE 1 END AS part,
         coalesce(content_id || '/' || prompt_kind, '') || '#' || unnest(['0', '1', '2', '3', '4']) AS k
  FROM (SELECT content_id, prompt_kind, CAST(sum(i) AS BIGINT) AS i, CAST(sum(o) AS BIGINT) AS o FROM ({_USAGE4}) u
        GROUP BY GROUPING SETS ((content_id, prompt_kind), ())))
UNION ALL SELECT * FROM (VALUES ('Token Usage Summary', 0, ''), ('{"=" * 52}', 3, '')) v""", "analysis", "groups"))
def q_report_usage(spark, sf):
    """K7: the token usage report, four prompt kinds."""
    return sinks.usage_report_lines(enrich.token_usage(_usage_rows(spark, sf))).withColumn("part", L("part"))


@register("report_evaluation", with_ctes("""
SELECT * FROM (VALUES ('Sentiment Analysis Classification Report', CAST(0 AS BIGINT), ''), ('Confusion Matrix:', 2, '')) v(line, part, k)
UNION ALL SELECT 'Overall Accuracy: ' || printf('%.4f', avg(CASE WHEN true_label = predicted_sentiment THEN 1.0 ELSE 0.0 END)::DOUBLE), 1, '' FROM tagged_l
UNION ALL SELECT 'Labels: ' || string_agg(l, ', ' ORDER BY l), 3, '' FROM (SELECT true_label AS l FROM tagged_l UNION SELECT predicted_sentiment FROM tagged_l)
UNION ALL SELECT '[' || string_agg(CAST(n AS VARCHAR), ' ' ORDER BY p) || ']', 4, t FROM (
  SELECT a.l AS t, b.l AS p, count(x.ordinal) AS n
  FROM (SELECT true_label AS l FROM tagged_l UNION SELECT predicted_sentiment FROM tagged_l) a
  CROSS JOIN (SELECT true_label AS l FROM tagged_l UNION SELECT predicted_sentiment FROM tagged_l) b
  LEFT JOIN tagged_l x ON x.true_label = a.l AND x.predicted_sentiment = b.l GROUP BY a.l, b.l) GROUP BY t""", "tagged_l"))
def q_report_evaluation(spark, sf):
    """K7: accuracy and confusion matrix as report lines."""
    ev = _ev(spark, sf)
    return sinks.evaluation_report_lines(evaluate.accuracy(ev), evaluate.confusion_matrix(ev)).withColumn("part", L("part"))


def queries() -> dict[str, Builder]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}

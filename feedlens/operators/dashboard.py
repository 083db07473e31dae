"""Dashboard facts and aggregates.

The upstream code walks nested dictionaries per course; here everything is a fact
table plus aggregates, and nesting happens only once, at export (``dashboard_payload``).
Comments match by the SHA-256 digest of their normalised text (``norm_key``, 32 bytes):
no text is shuffled or sorted to find its partner.

Flow:
    tagged full comments --J1 (last-wins analysis per (course, sentiment, norm))--> enriched
    enriched --D1 (last row per (course, norm))--> comment map
    language rows --J2 inner / J3 left on (course, norm)--> language facts
All aggregates below read ``enriched`` or the language facts and shuffle only on their
group keys (course, language, category), with map-side partial aggregation.
Global shares use a one-row aggregate joined back (broadcast of one row), never an
un-keyed window, so no step funnels all rows into a single task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import (ALERT_HIGH_SHARE, ALERT_MEDIUM_SHARE, BAR_SCALE, COURSE_TOP_CATEGORIES, COURSE_TOP_LANGUAGES,
                     TOP_ISSUES, TOP_ISSUES_LENIENT, TOP_STRENGTHS)
from ..fixed import ANALYSIS_FIELDS
from ..functions.text import norm_comment, norm_comment_simple, text_key, utrim
from .language import lang_badge, lang_code_key, lang_name, lang_order, skew
from .ranks import ranked, spread_left_join
from .sentiment import sentiment_key

OTHER_ISSUE = "Other Issue"
OVERALL = 4         # grouping_id of the rows of ``category_counts`` over all courses


@dataclass(frozen=True)
class Profile:
    """The two dashboard variants upstream, as parameters of one implementation."""
    name: str
    lenient: bool
    top_issues: int
    bucket_issue_limit: int | None
    count_lang_before_match: bool

    def norm(self, col: Column) -> Column:
        return norm_comment_simple(col) if self.lenient else norm_comment(col)


STRICT = Profile("strict", lenient=False, top_issues=TOP_ISSUES, bucket_issue_limit=None,
                 count_lang_before_match=False)
LENIENT = Profile("lenient", lenient=True, top_issues=TOP_ISSUES_LENIENT, bucket_issue_limit=5,
                  count_lang_before_match=True)


# ----------------------------------------------------------------------------- J1 / D1
def keyed(rows: DataFrame, profile: Profile = STRICT) -> DataFrame:
    """``rows`` with ``norm_key``, the digest of the normalised comment, unless they bring it along."""
    if "norm_key" in rows.columns:
        return rows
    norm = F.col("norm") if "norm" in rows.columns else profile.norm(F.col("comment"))
    return rows.withColumn("norm_key", text_key(norm))


def analysis_lookup(analysis: DataFrame, profile: Profile = STRICT) -> DataFrame:
    """The ordinal of the last analysis per (course, sentiment, comment key); a record without a
    category (failed analysis) never overwrites.  A long maximum is a hash aggregate."""
    a = keyed(analysis.filter(F.col("category").isNotNull() & F.col("error").isNull()), profile)
    return a.groupBy("content_id", "sentiment", "norm_key").agg(F.max("ordinal").alias("analysis_ordinal"))


def enrich(tagged_full: DataFrame, analysis: DataFrame, profile: Profile = STRICT) -> DataFrame:
    """J1 + P18: every tagged comment with its issue / strength.

    Negative -> issue from the negative analysis (default 'Other Issue'); positive ->
    strength from the positive analysis (default ''); neutral -> neither.
    """
    t = keyed(tagged_full.withColumn("sentiment", sentiment_key(F.col("predicted_sentiment"))), profile)
    if "norm" not in t.columns and "comment" in t.columns:
        t = t.withColumn("norm", profile.norm(F.col("comment")))
    texts = [c for c in ("comment", "norm") if c in t.columns]          # rows that bring their key may come without them
    t = t.select("content_id", "content_name", "ordinal", "comment_date", "sentiment", *texts, "norm_key")
    # each key gets its record by an ordinal first, in narrow rows; the comments, with their texts, are then shuffled once
    record = analysis.select(F.col("ordinal").alias("analysis_ordinal"),
                             F.struct("category", "root_cause", "owner", "priority", "actions").alias("a"))
    found = spread_left_join(analysis_lookup(analysis, profile), record, "analysis_ordinal", "norm_key")
    j = t.join(found, ["content_id", "sentiment", "norm_key"], "left")
    issue = F.when(F.col("sentiment") == "negative", F.coalesce(F.col("a.category"), F.lit(OTHER_ISSUE))) \
        .otherwise(F.lit(OTHER_ISSUE))
    strength = F.when(F.col("sentiment") == "positive", F.coalesce(F.col("a.category"), F.lit(""))) \
        .otherwise(F.lit(""))
    return j.select("content_id", "content_name", "ordinal", "comment_date", "sentiment", *texts, "norm_key",
                    issue.alias("issue"), strength.alias("strength"),
                    F.col("a.root_cause").alias("root_cause"), F.col("a.owner").alias("owner"),
                    F.col("a.priority").alias("priority"), F.col("a.actions").alias("actions"), F.col("a").isNotNull().alias("analysed"))


def comment_map(enriched: DataFrame) -> DataFrame:
    """Per (course, normalised comment) the last row wins (upstream map writes)."""
    last = keyed(enriched).groupBy("content_id", "norm_key").agg(F.max("ordinal").alias("last_ordinal"))
    texts = enriched.select(F.col("ordinal").alias("last_ordinal"), "norm")
    return last.join(_records(enriched), "last_ordinal").join(texts, "last_ordinal").select("content_id", "norm", "m")


def _records(enriched: DataFrame) -> DataFrame:
    """What a comment tells by its ordinal; its whole analysis record is null where there is none."""
    category = F.when(F.col("sentiment") == "negative", F.col("issue")).otherwise(F.col("strength"))
    record = F.lit(None).cast("struct<category:string,root_cause:string,owner:string,priority:string,actions:array<string>>")
    if "analysed" in enriched.columns:
        record = F.when(F.col("analysed"), F.struct(category.alias("category"), "root_cause", "owner", "priority", "actions"))
    return enriched.select(F.col("ordinal").alias("last_ordinal"),
                           F.struct("sentiment", "issue", "strength", F.col("comment_date").alias("date"), record.alias("record")).alias("m"))


def language_facts(lang: DataFrame, enriched: DataFrame, profile: Profile = STRICT) -> DataFrame:
    """J2 (strict: inner, unmatched rows skipped) / J3 (lenient: left, unmatched rows are
    neutral with 'Other Issue', date from the language row)."""
    default = "unknown" if profile.lenient else "hinglish"
    l = keyed(lang.withColumn("lang_code", lang_code_key(F.col("predicted_language"), default)), profile)
    texts = [c for c in ("comment",) if c in l.columns]          # as in ``enrich``
    l = l.select("content_id", "ordinal", *texts, "comment_date", "lang_code", "norm_key")
    how = "left" if profile.lenient else "inner"
    last = keyed(enriched, profile).groupBy("content_id", "norm_key").agg(F.max("ordinal").alias("last_ordinal"))
    # narrow rows first: the texts are shuffled once
    j = l.join(spread_left_join(last, _records(enriched), "last_ordinal", "norm_key"), ["content_id", "norm_key"], how)
    j = j.select("content_id", "ordinal", "lang_code", *texts,
                 F.coalesce(F.col("m.sentiment"), F.lit("neutral")).alias("sentiment"),
                 F.coalesce(F.col("m.issue"), F.lit(OTHER_ISSUE)).alias("issue"),
                 F.coalesce(F.col("m.strength"), F.lit("")).alias("strength"),
                 F.when(F.col("m").isNull(), F.col("comment_date")).otherwise(F.col("m.date")).alias("date"),
                 F.col("m").isNotNull().alias("matched"), F.col("m.record").alias("record"))
    return lang_name(j, "lang_code", profile.lenient, "lang_name")


# ----------------------------------------------------------------------------- P21-P24
def pct_text(x: Column, digits: int = 1) -> Column:
    """Fixed decimals with thousands separators (half-even on the binary value)."""
    return F.format_number(x, digits)


def alert(neg_share: Column) -> list[Column]:
    """P22."""
    cls = F.when(neg_share > ALERT_HIGH_SHARE, "high").when(neg_share > ALERT_MEDIUM_SHARE, "med").otherwise("low")
    lab = F.when(neg_share > ALERT_HIGH_SHARE, "High").when(neg_share > ALERT_MEDIUM_SHARE, "Medium").otherwise("Low")
    return [cls.alias("alert_class"), lab.alias("alert_label")]


def bar_width(share: Column) -> Column:
    """max(1, int(share * 120))."""
    return F.greatest(F.lit(1), F.floor(share * BAR_SCALE)).cast("long")


# ----------------------------------------------------------------------------- A4 / W7
def course_totals(enriched: DataFrame) -> DataFrame:
    """A4: per course totals, counts, widths, alert, from one pass over the facts.

    Name = first non-empty content_name in input order: counts and first rows are taken per (course,
    name), of which a course has a few, and the window sees only these.  Hidden courses (T7:
    exactly one neutral comment) are flagged, not dropped, so totals elsewhere stay whole.
    """
    s = F.col("sentiment")
    named = (enriched.groupBy("content_id", "content_name")
             .agg(F.count(F.lit(1)).alias("total"),
                  F.count_if(s == "positive").alias("positive_count"),
                  F.count_if(s == "negative").alias("negative_count"),
                  F.count_if((s != "positive") & (s != "negative")).alias("neutral_count"),
                  F.min("ordinal").alias("first_ordinal")))
    every = Window.partitionBy("content_id")
    first = every.orderBy(F.col("content_name").isNull() | (F.col("content_name") == ""), "first_ordinal")
    g = named.select("content_id", *(F.sum(c).over(every).alias(c) for c in ("total", "positive_count", "negative_count", "neutral_count")),
                     F.min("first_ordinal").over(every).alias("first_ordinal"), F.col("content_name").alias("name"), F.row_number().over(first).alias("r"))
    g = g.filter("r = 1")
    tot = F.greatest(F.lit(1), F.col("total")).cast("double")
    return g.select("content_id", F.when(F.col("name") != "", F.col("name")).otherwise(F.col("content_id")).alias("name"), "total",
                    "positive_count", "negative_count", "neutral_count",
                    bar_width(F.col("positive_count") / tot).alias("positive_width"),
                    bar_width(F.col("negative_count") / tot).alias("negative_width"),
                    bar_width(F.col("neutral_count") / tot).alias("neutral_width"),
                    *alert(F.col("negative_count") / tot),
                    ((F.col("total") <= 1) & (F.col("positive_count") == 0) & (F.col("negative_count") == 0))
                    .alias("hidden"),
                    "first_ordinal")


def course_stats(enriched: DataFrame) -> DataFrame:
    """A4 + W7: course totals with the rank of the visible courses by total desc, numbered by a range sort."""
    out = ranked(course_totals(enriched), ["hidden"], [F.desc("total"), F.asc("first_ordinal")], "course_rank")
    return out.withColumn("course_rank", F.when(~F.col("hidden"), F.col("course_rank"))).drop("first_ordinal")


# ----------------------------------------------------------------------------- A5, W1-W3
def category_facts(rows: DataFrame, *keys: str) -> DataFrame:
    """Long form (kind, name) of counted categories in one pass: negative issues other than
    'Other Issue' and positive non-empty strengths.  A row has one sentiment, so one kind."""
    is_issue = (F.col("sentiment") == "negative") & (F.col("issue") != OTHER_ISSUE) & (F.col("issue") != "")
    is_strength = (F.col("sentiment") == "positive") & (F.col("strength") != "")
    kind = F.when(is_issue, "issue").when(is_strength, "strength")
    name = F.when(is_issue, F.col("issue")).when(is_strength, F.col("strength"))
    return (rows.filter(is_issue | is_strength)
            .select("content_id", *keys, "ordinal", kind.alias("kind"), name.alias("name")))


def category_counts(enriched: DataFrame) -> DataFrame:
    """A5: count per category overall (content_id null) and per course, one pass."""
    facts = category_facts(enriched)
    return (facts.groupingSets([["content_id", "kind", "name"], ["kind", "name"]], "content_id", "kind", "name")
            .agg(F.count(F.lit(1)).alias("count"), F.min("ordinal").alias("first_ordinal"),
                 F.grouping_id().alias("gid")))


def top_categories(enriched: DataFrame, kind: str, n: int, counts: DataFrame | None = None) -> DataFrame:
    """Top n categories overall, share of *all* counted categories of that kind; from ``category_counts`` if given."""
    c = (counts.filter((F.col("kind") == kind) & (F.col("gid") == OVERALL)).select("name", "count", "first_ordinal") if counts is not None
         else category_facts(enriched).filter(F.col("kind") == kind)
         .groupBy("name").agg(F.count(F.lit(1)).alias("count"), F.min("ordinal").alias("first_ordinal")))
    total = c.agg(F.sum("count").alias("kind_total"))
    w = Window.orderBy(F.desc("count"), F.asc("first_ordinal"))
    # The category vocabulary is bounded (taxonomy size), so this un-keyed window
    # ranks at most a few dozen aggregated rows.
    ranked = c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    return (ranked.crossJoin(F.broadcast(total))
            .select("rank", "name", "count",
                    (F.col("count") / F.greatest(F.lit(1), F.col("kind_total")).cast("double") * 100.0)
                    .alias("percent")))


def course_top_categories(enriched: DataFrame, n: int = COURSE_TOP_CATEGORIES, courses: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Top n issues and strengths per visible course; from the course table and ``category_counts`` if given."""
    visible = (course_totals(enriched) if courses is None else courses).filter(~F.col("hidden")).select("content_id")
    c = (counts.filter("gid = 0") if counts is not None
         else category_facts(enriched).groupBy("content_id", "kind", "name")
         .agg(F.count(F.lit(1)).alias("count"), F.min("ordinal").alias("first_ordinal")))
    w = Window.partitionBy("content_id", "kind").orderBy(F.desc("count"), F.asc("first_ordinal"))
    return (c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .join(visible, "content_id", "left_semi")
            .select("content_id", "kind", "rank", "name", "count"))


# ----------------------------------------------------------------------------- languages
def language_rows_counted(facts: DataFrame, profile: Profile = STRICT) -> DataFrame:
    """Strict counts languages after the match (J2 rows); lenient counts every
    language row (J3 is a left join, so that is every row as well)."""
    return facts if profile.count_lang_before_match else facts.filter(F.col("matched"))


def language_counts(facts: DataFrame) -> DataFrame:
    """Rows per language name, globally (content_id null) and per course."""
    return (facts.groupingSets([["content_id", "lang_name"], ["lang_name"]], "content_id", "lang_name")
            .agg(F.count(F.lit(1)).alias("count"), F.grouping_id().alias("gid")))


def language_sentiment(facts: DataFrame) -> DataFrame:
    """Language x sentiment counts, globally and per course."""
    s = F.col("sentiment")
    return (facts.groupingSets([["content_id", "lang_name"], ["lang_name"]], "content_id", "lang_name")
            .agg(F.count_if(s == "positive").alias("positive_count"),
                 F.count_if(s == "negative").alias("negative_count"),
                 F.count_if(s == "neutral").alias("neutral_count"),
                 F.grouping_id().alias("gid")))


def language_summary(facts: DataFrame, lenient: bool = False) -> DataFrame:
    """A11 + W8 + P23: per language: count, share, skew, sentiment counts and shares,
    display order (fixed order, then count desc)."""
    s = F.col("sentiment")
    g = (facts.groupBy("lang_name")
         .agg(F.count(F.lit(1)).alias("count"),
              F.count_if(s == "positive").alias("positive_count"),
              F.count_if(s == "negative").alias("negative_count"),
              F.count_if(s == "neutral").alias("neutral_count")))
    total = g.agg(F.sum("count").alias("all_langs"))
    pct = F.col("count") / F.greatest(F.lit(1), F.col("all_langs")).cast("double") * 100.0
    lt = F.greatest(F.lit(1), F.col("positive_count") + F.col("negative_count") + F.col("neutral_count")).cast("double")
    out = g.crossJoin(F.broadcast(total)).select(
        F.col("lang_name").alias("name"), "count", pct.alias("percent"), *skew(pct),
        "positive_count", "negative_count", "neutral_count",
        (F.col("positive_count") / lt * 100.0).alias("positive_pct"),
        (F.col("negative_count") / lt * 100.0).alias("negative_pct"),
        (F.col("neutral_count") / lt * 100.0).alias("neutral_pct"),
        lang_order(F.col("lang_name"), lenient).alias("lang_order"))
    # bounded: one row per language name
    w = Window.orderBy("lang_order", F.desc("count"), F.asc("name"))
    return out.withColumn("display_rank", F.row_number().over(w))


def course_top_languages(facts: DataFrame, n: int = COURSE_TOP_LANGUAGES, lenient: bool = False) -> DataFrame:
    """Top n language codes per course (badge text), ties by first appearance."""
    c = (facts.groupBy("content_id", "lang_code")
         .agg(F.count(F.lit(1)).alias("count"), F.min("ordinal").alias("first_ordinal")))
    w = Window.partitionBy("content_id").orderBy(F.desc("count"), F.asc("first_ordinal"))
    return (c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .select("content_id", "rank", "lang_code", lang_badge(F.col("lang_code"), lenient).alias("badge"),
                    "count"))


# ----------------------------------------------------------------------------- A10, W5, W6
def flat_buckets(facts: DataFrame) -> DataFrame:
    """A10: per (course, language name): positive / negative / neutral counts."""
    s = F.col("sentiment")
    return (facts.groupBy("content_id", "lang_name")
            .agg(F.count_if(s == "positive").alias("pos"), F.count_if(s == "negative").alias("neg"),
                 F.count_if((s != "positive") & (s != "negative")).alias("neu"),
                 F.count_if((s == "negative") & (F.col("issue") != OTHER_ISSUE) & (F.col("issue") != ""))
                 .alias("issue_count"),
                 F.count_if((s == "positive") & (F.col("strength") != "")).alias("strength_count")))


def bucket_categories(facts: DataFrame, issue_limit: int | None = None) -> DataFrame:
    """Issues and strengths per bucket, count desc (lenient: top 5 issues)."""
    c = (category_facts(facts, "lang_name").groupBy("content_id", "lang_name", "kind", "name")
         .agg(F.count(F.lit(1)).alias("count"), F.min("ordinal").alias("first_ordinal")))
    w = Window.partitionBy("content_id", "lang_name", "kind").orderBy(F.desc("count"), F.asc("first_ordinal"))
    out = c.withColumn("rank", F.row_number().over(w))
    if issue_limit is not None:
        out = out.filter((F.col("kind") != "issue") | (F.col("rank") <= issue_limit))
    return out.select("content_id", "lang_name", "kind", "rank", "name", "count")


def bucket_winners(facts: DataFrame) -> DataFrame:
    """Per bucket and sentiment the (date, ordinal) of one row per exact (stripped) comment text: the
    latest date wins, ties go to the first.  Texts are told apart by their digests, so all rows are narrow."""
    key = ["content_id", "lang_name", "sentiment"]
    narrow = facts.select(*key, text_key(utrim(F.col("comment"))).alias("text_key"), "ordinal", "date")
    last = narrow.groupBy(*key, "text_key").agg(F.max(F.struct("date", (-F.col("ordinal")).alias("o"))).alias("last"))
    return last.select(*key, "last.date", (-F.col("last.o")).alias("ordinal"))


def bucket_comments(facts: DataFrame, winners: DataFrame | None = None) -> DataFrame:
    """The deduplicated comments of each bucket and sentiment with their analysis; texts come by ordinal."""
    found = (bucket_winners(facts) if winners is None else winners).drop("date", "content_id", "lang_name", "sentiment")
    category = F.when(F.col("sentiment") == "negative", F.col("issue")) \
        .when(F.col("sentiment") == "positive", F.col("strength")).otherwise(F.lit(""))
    more = [c for c in ("record", "rank") if c in facts.columns + found.columns]
    return facts.join(found, "ordinal").select("content_id", "lang_name", "sentiment", "ordinal", "date", utrim(F.col("comment")).alias("comment"),
                                               category.alias("analysis"), *more)


# ----------------------------------------------------------------------------- A3 / K5
def overall(enriched: DataFrame, courses: DataFrame | None = None) -> DataFrame:
    """A3 + A19: one row, summed over the course table."""
    per = course_totals(enriched) if courses is None else courses
    kinds = ("positive_count", "negative_count", "neutral_count")
    g = per.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total_comments"), F.count_if(~F.col("hidden")).alias("course_count"),
                *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in kinds))
    tot = F.greatest(F.lit(1), F.col("total_comments")).cast("double")
    return g.select(
        "total_comments", "course_count", "positive_count", "negative_count", "neutral_count",
        (F.col("positive_count") / tot * 100.0).alias("positive_percent"),
        (F.col("negative_count") / tot * 100.0).alias("negative_percent"),
        (F.col("neutral_count") / tot * 100.0).alias("neutral_percent"))


def _pairs(rows: DataFrame, keys: list[str], kind: str, out: str) -> DataFrame:
    """Per key the ranked (name, count) pairs of one kind: at most 15, the taxonomy's size."""
    ranked = rows.filter(F.col("kind") == kind).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("rank", "name", "count"))).alias(out))
    return ranked.withColumn(out, F.transform(out, lambda x: x.dropFields("rank")))


def course_payload(enriched: DataFrame, facts: DataFrame, profile: Profile = STRICT, courses: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """K5, courses: one JSON value per visible course (content_id, payload), in the upstream fields
    but for the summary documents (``documents.attach``).  No course is gathered with another."""
    cs = (course_stats(enriched) if courses is None else courses).filter(~F.col("hidden"))
    counted = language_rows_counted(facts, profile)
    tops = course_top_languages(counted, lenient=profile.lenient).groupBy("content_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "badge"))), lambda x: x["badge"]).alias("languages"))
    by_lang = language_sentiment(counted).filter("gid = 0").groupBy("content_id").agg(F.map_from_entries(F.collect_list(F.struct(
        "lang_name", F.struct("positive_count", "negative_count", "neutral_count")))).alias("course_lang_sentiment"))
    cats = course_top_categories(enriched, courses=cs, counts=counts)
    for part in (tops, by_lang, _pairs(cats, ["content_id"], "issue", "issues"), _pairs(cats, ["content_id"], "strength", "strengths")):
        cs = cs.join(part, "content_id", "left")
    none = F.array().cast("array<struct<name:string,count:bigint>>")
    return cs.select("content_id", "course_rank", F.to_json(F.struct(
        "name", F.col("content_id").alias("id"), F.format_number("total", 0).alias("total_comments"),
        F.coalesce("languages", F.array().cast("array<string>")).alias("languages"), "positive_count", "negative_count", "neutral_count",
        "positive_width", "negative_width", "neutral_width", "alert_class", "alert_label", "course_lang_sentiment",
        F.coalesce("issues", none).alias("issues"), F.coalesce("strengths", none).alias("strengths"),
        F.col("total").alias("sort_key"))).alias("payload"))


def bucket_payload(facts: DataFrame, enriched: DataFrame, profile: Profile = STRICT, courses: DataFrame | None = None) -> DataFrame:
    """K5 / A10, buckets: one JSON value per course and language with its counts and its ranked issues and
    strengths; its comments are the rows of ``bucket_rows``."""
    key = ["content_id", "lang_name"]
    cats = bucket_categories(facts, profile.bucket_issue_limit)
    names = (course_totals(enriched) if courses is None else courses).select("content_id", F.col("name").alias("course"))
    out = flat_buckets(facts).join(names, "content_id", "left")
    for part in (_pairs(cats, key, "issue", "issues"), _pairs(cats, key, "strength", "strengths")):
        out = out.join(part, key, "left")
    none = F.array().cast("array<struct<name:string,count:bigint>>")
    return out.select(*key, F.to_json(F.struct(
        "course", F.col("content_id").alias("course_id"), F.col("lang_name").alias("lang"), "pos", "neg", "neu",
        F.coalesce("issues", none).alias("issues"),
        *([] if profile.lenient else [F.coalesce("strengths", none).alias("strengths")]))).alias("payload"))


def analysis_json(record: Column, sentiment: Column) -> Column:
    """A comment's analysis record under its names on disk, as JSON; ``{}`` where there is none."""
    fields = [F.when(sentiment == "negative", record["category"]).alias(ANALYSIS_FIELDS["issue"]),
              F.when(sentiment == "positive", record["category"]).alias(ANALYSIS_FIELDS["strength"]),
              *(record[c].alias(ANALYSIS_FIELDS[c]) for c in ("root_cause", "actions", "owner", "priority"))]
    return F.coalesce(F.when(record.isNotNull(), F.to_json(F.struct(*fields))), F.lit("{}"))


def bucket_rows(facts: DataFrame) -> DataFrame:
    """K5 / A10, comments: (content_id, lang_name, sentiment, rank, payload), one JSON row per deduplicated
    comment of a bucket, ranked latest first (ties: input order), with its whole analysis record.

    Ranks come from a range sort of narrow rows, so a bucket with most of the comments spreads over many
    tasks; ``sinks.write_bucket_rows`` stores the rows in order, and a page of a list is a range of ranks.
    """
    winners = ranked(bucket_winners(facts), ["content_id", "lang_name", "sentiment"], [F.desc("date"), F.asc("ordinal")])
    rows = bucket_comments(facts, winners)
    known = F.to_json(F.struct("comment", "date", F.col("lang_name").alias("language"), "sentiment"))
    # the record is JSON already: it joins the comment's fields as it is
    whole = F.concat(F.substring(known, F.lit(1), F.length(known) - 1), F.lit(',"analysis":'), analysis_json(F.col("record"), F.col("sentiment")), F.lit("}"))
    return rows.select("content_id", "lang_name", "sentiment", "rank", whole.alias("payload"))


def dashboard_payload(enriched: DataFrame, facts: DataFrame, profile: Profile = STRICT, courses: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """K5, totals: the corpus-wide part of the metrics bundle as one JSON value (one row).

    Courses and buckets are values of their own (``course_payload``, ``bucket_payload``);
    here are totals, languages, top categories and the list of course names.
    """
    stats = course_stats(enriched) if courses is None else courses
    ov = overall(enriched, stats)
    listed = stats.filter(~F.col("hidden")).agg(F.transform(F.array_sort(F.collect_list(F.struct(
        "course_rank", "name", F.format_number("total", 0).alias("count")))),
        lambda x: x.dropFields("course_rank")).alias("course_list"))
    langs = language_summary(language_rows_counted(facts, profile), profile.lenient).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(
            "display_rank", "name", pct_text(F.col("percent"), 1).alias("percent"), F.format_number("count", 0).alias("count"), "skew_class",
            "skew_label", *[F.format_number(f"{k}_count", 0).alias(f"{k}_count") for k in ("positive", "negative", "neutral")],
            pct_text(F.col("positive_pct"), 0).alias("positive_pct"),
            pct_text(F.col("negative_pct"), 0).alias("negative_pct"),
            pct_text(F.col("neutral_pct"), 0).alias("neutral_pct")))),
            lambda x: x.dropFields("display_rank")).alias("languages"))
    ti = top_categories(enriched, "issue", profile.top_issues, counts).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "name", F.format_number("count", 0).alias("count"),
                                                         pct_text(F.col("percent"), 1).alias("percent")))),
                    lambda x: x.dropFields("rank")).alias("top_issues"))
    ts = top_categories(enriched, "strength", TOP_STRENGTHS, counts).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "name", F.format_number("count", 0).alias("count"),
                                                         pct_text(F.col("percent"), 1).alias("percent")))),
                    lambda x: x.dropFields("rank")).alias("top_strengths"))
    parts = ov
    for p in (listed, langs, ti, ts):
        parts = parts.crossJoin(F.broadcast(p))
    return parts.select(F.to_json(F.struct(
        F.format_number(F.col("total_comments"), 0).alias("total_comments"),
        F.col("course_count").cast("string").alias("total_course_count"),
        F.format_number(F.col("positive_count"), 0).alias("overall_positive_count"),
        F.format_number(F.col("negative_count"), 0).alias("overall_negative_count"),
        F.format_number(F.col("neutral_count"), 0).alias("overall_neutral_count"),
        pct_text(F.col("positive_percent")).alias("overall_positive_percent"),
        pct_text(F.col("negative_percent")).alias("overall_negative_percent"),
        pct_text(F.col("neutral_percent")).alias("overall_neutral_percent"),
        "course_list", "languages", F.transform("languages", lambda x: x["name"]).alias("language_chips"),
        "top_issues", "top_strengths")).alias("payload"))

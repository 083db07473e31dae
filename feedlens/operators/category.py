"""Categorisation (E3) and the category summary rules.

E3 built-in: keyword rules.  The whole text's tokens are mapped through one literal
word -> category map; the category with most hits wins (ties: lower number).  A text
that fits no category belongs to category 15, as the upstream rules say; a model can
replace all of this through the per-partition hook.  Row-wise, no shuffle.

Summary rules (what the upstream prompts ask a model to follow in prose) are computed
exactly: per (course, sentiment, category) one aggregate row, then windows over those
few rows.  Comment samples are cut to 5 per group *before* anything is collected, so
no unbounded group is ever gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import (AMPLIFY_TOP, BLOCKING_PATTERN, CATEGORY_KEYWORDS, FALLBACK_CATEGORY_NO, LOW_SIGNAL_PHRASES, LOW_SIGNAL_SHARE,
                     SAMPLE_ACTIONS, SAMPLE_COMMENTS, TIER_MAJOR_SHARE, TIER_MIN_COUNT, TOP_PRIORITY_ACTIONS,
                     TOP_STRENGTH_AREAS, URGENCY_MEDIUM_SHARE)
from ..functions.text import WS, WS_CHARS, any_case, collapse_ws, extract_words
from ..session import materialize
from .ranks import ranked
from .taxonomy import join_taxonomy, priority_rank

GROUP = ["content_id", "sentiment", "category"]


def keyword_map() -> Column:
    pairs = {}
    for no, words in CATEGORY_KEYWORDS:
        for w in words:
            pairs.setdefault(w, no)
    keys = sorted(pairs)
    return F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[F.lit(pairs[k]) for k in keys]))


def _equals(k: int):
    return lambda x: x == F.lit(k)


def keyword_hits(text: Column) -> Column:
    """Category numbers of the keyword tokens of a text (one regex pass)."""
    m = keyword_map()
    words = sorted({w for _, ws in CATEGORY_KEYWORDS for w in ws})
    found = extract_words(F.lower(F.coalesce(text, F.lit(""))), words)
    return F.transform(found, lambda t: F.try_element_at(m, t))


def category_from_hits(hits: Column) -> Column:
    """Most hits wins (ties: lower number); no hit -> category 15."""
    per = F.array(*[F.struct(F.size(F.filter(hits, _equals(k))).alias("n"),
                             F.lit(-k).alias("neg_no")) for k, _ in CATEGORY_KEYWORDS])
    best = F.array_max(per)
    return F.when(best["n"] > 0, -best["neg_no"]).otherwise(F.lit(FALLBACK_CATEGORY_NO)).cast("int")


def categorize(df: DataFrame, text_col: str = "comment", sentiment_col: str = "predicted_sentiment") -> DataFrame:
    """E3 + J9: the analysis record of each negative/positive comment.

    Adds sentiment, category_no, category, root_cause, owner, priority, actions,
    error, raw_output and a usage struct (input = characters read, output =
    characters of the answer, thinking = 0).
    """
    out = (df.withColumn("sentiment", F.col(sentiment_col))
           .filter(F.col("sentiment").isin("negative", "positive"))
           .withColumn("_kw", keyword_hits(F.col(text_col)))
           .withColumn("category_no", category_from_hits(F.col("_kw")))
           .drop("_kw"))
    return analysis_records(out, text_col)


def analysis_records(df: DataFrame, text_col: str = "comment") -> DataFrame:
    """Rows with sentiment and category_no as analysis records (taxonomy, no error, usage)."""
    out = join_taxonomy(df)
    inp = F.length(F.col(text_col)).cast("long")
    outp = F.length(F.col("category")).cast("long")
    return (out.withColumn("error", F.lit(None).cast("string"))
            .withColumn("raw_output", F.lit(None).cast("string"))
            .withColumn("usage", F.struct(inp.alias("input"), outp.alias("output"), F.lit(0).cast("long").alias("thinking"),
                                          (inp + outp).alias("total"))))


def categorize_rows(df: DataFrame, text_col: str = "comment", sentiment_col: str = "sentiment") -> DataFrame:
    """E3 + J9 on every row: negative / positive rows get their category and taxonomy
    columns, other rows get nulls (the keyword regex only runs for the routed rows)."""
    routed = F.col(sentiment_col).isin("negative", "positive")
    out = (df.withColumn("_kw", F.when(routed, keyword_hits(F.col(text_col))))
           .withColumn("category_no", F.when(routed, category_from_hits(F.col("_kw"))))
           .drop("_kw"))
    return join_taxonomy(out, sentiment_col, "category_no").withColumn("error", F.lit(None).cast("string"))


def summary_category(col: Column) -> Column:
    """Summary path default: a missing or failed analysis groups as 'Other'."""
    return F.coalesce(col, F.lit("Other"))


# ----------------------------------------------------------------------------- A6 / A7
def category_groups(analysis: DataFrame) -> DataFrame:
    """A6 + A7: per (course, sentiment, category): count, first-seen metadata, share,
    rank; plus blocking and low-signal counts for W11/W12.

    The analysis is read once: counts and first rows are taken per group and metadata (one of a few for stored
    categories), and that table is stored; a group's metadata is that of its first row.
    """
    meta = {"root_cause": F.lit(""), "owner": F.lit(""), "priority": F.lit(""), "actions": F.array().cast("array<string>")}
    base = analysis.withColumns({"category": summary_category(F.col("category")), **{c: F.coalesce(c, none) for c, none in meta.items()}})
    parts = base.groupBy(*GROUP, *meta).agg(
        F.count(F.lit(1)).alias("count"), F.min("ordinal").alias("first_ordinal"),
        F.count_if(F.col("comment").rlike(any_case(BLOCKING_PATTERN))).alias("blocking_count"),
        F.count_if(low_signal(F.col("comment"))).alias("low_signal_count"))
    parts = materialize(parts, "groups")
    g = parts.groupBy(*GROUP).agg(F.min("first_ordinal").alias("first_ordinal"), *(F.sum(c).alias(c) for c in ("count", "blocking_count", "low_signal_count")))
    g = g.join(parts.select("first_ordinal", *meta), "first_ordinal")
    w = Window.partitionBy("content_id", "sentiment")
    rk = Window.partitionBy("content_id", "sentiment").orderBy(F.desc("count"), F.asc("first_ordinal"))
    return (g.withColumn("total", F.sum("count").over(w))
            .withColumn("share", F.col("count") / F.greatest(F.lit(1), F.col("total")).cast("double"))
            .withColumn("rank", F.row_number().over(rk))
            .select(*GROUP, "count", "total", "share", "rank", "first_ordinal", *meta, "blocking_count", "low_signal_count"))


_SEVERAL_WORDS = f"[^{WS_CHARS}]{WS}+[^{WS_CHARS}]"
_PHRASE = f"(?iu)^{WS}*(?:{'|'.join(p.replace(' ', WS + '+') for p in LOW_SIGNAL_PHRASES)}){WS}*$"


def low_signal(comment: Column) -> Column:
    """A comment of one word at most, without a letter or digit, or one of the phrases that say nothing.  The first
    two and the guard of the third stop within the first words of a long text."""
    phrase = comment.rlike(_PHRASE) & collapse_ws(F.lower(comment)).isin(*LOW_SIGNAL_PHRASES)
    return ~comment.rlike(_SEVERAL_WORDS) | ~comment.rlike("[\\p{L}\\p{N}]") | phrase


def group_members(analysis: DataFrame) -> DataFrame:
    """The comments of each (course, sentiment, category) in input order: (ordinal, rank) with gapless ranks
    from one range sort of narrow rows, so a group of any size spreads over many tasks."""
    rows = analysis.select("content_id", "sentiment", summary_category(F.col("category")).alias("category"), "ordinal")
    return ranked(rows, GROUP, [F.asc("ordinal")])


def sample_comments(analysis: DataFrame, k: int = SAMPLE_COMMENTS) -> DataFrame:
    """First k comments per category in input order (rank <= k pushed below the
    shuffle by WindowGroupLimit)."""
    base = analysis.withColumn("category", summary_category(F.col("category")))
    w = Window.partitionBy(*GROUP).orderBy("ordinal")
    return (base.withColumn("sample_rank", F.row_number().over(w)).filter(F.col("sample_rank") <= k)
            .select(*GROUP, "sample_rank", "ordinal", F.col("comment")))


# ----------------------------------------------------------------------------- W10-W12
def tiers(groups: DataFrame) -> DataFrame:
    """W10-W12 on the A6 rows: tier, urgency, noise flag.

    Order of the tier rules: excluded (< 5) first, then major (>= 10 % or top), else
    minor.  Urgency: noise -> Low; top + blocking + >= 5 -> Critical; >= 10 % and
    >= 5 -> High; >= 5 % -> Medium; else Low.
    """
    noise = (F.col("low_signal_count") / F.col("count").cast("double")) > LOW_SIGNAL_SHARE
    tier_neg = (F.when(F.col("count") < TIER_MIN_COUNT, "excluded")
                .when((F.col("share") >= TIER_MAJOR_SHARE) | (F.col("rank") == 1), "major")
                .otherwise("minor"))
    tier_pos = (F.when(F.col("count") < TIER_MIN_COUNT, "excluded")
                .when((F.col("share") >= TIER_MAJOR_SHARE) | (F.col("rank") == 1), "primary")
                .otherwise("secondary"))
    urgency = (F.when(noise, "Low")
               .when((F.col("rank") == 1) & (F.col("blocking_count") > 0) & (F.col("count") >= TIER_MIN_COUNT),
                     "Critical")
               .when((F.col("share") >= TIER_MAJOR_SHARE) & (F.col("count") >= TIER_MIN_COUNT), "High")
               .when(F.col("share") >= URGENCY_MEDIUM_SHARE, "Medium")
               .otherwise("Low"))
    return (groups.withColumn("noise", noise)
            .withColumn("tier", F.when(F.col("sentiment") == "negative", tier_neg).otherwise(tier_pos))
            .withColumn("urgency", urgency))


def top_priority_actions(tiered: DataFrame, k: int = TOP_PRIORITY_ACTIONS) -> DataFrame:
    """K de-duplicated actions per course, by priority, then category rank, then
    action order; from non-excluded, non-noise negative categories, and only where these
    have fewer than k, filled up from the excluded and then the noise ones."""
    src = tiered.filter(F.col("sentiment") == "negative")
    fill = F.when(F.col("noise"), 2).when(F.col("tier") == "excluded", 1).otherwise(0)
    ex = src.select("content_id", "category", "rank", "owner", "priority", fill.alias("fill"),
                    F.posexplode("actions").alias("action_pos", "action"))
    ex = ex.withColumn("prio_rank", priority_rank(F.col("priority")))
    first = Window.partitionBy("content_id", "action").orderBy("fill", "prio_rank", "rank", "action_pos")
    dedup = ex.withColumn("_d", F.row_number().over(first)).filter(F.col("_d") == 1)
    w = Window.partitionBy("content_id").orderBy("fill", "prio_rank", "rank", "action_pos")
    return (dedup.withColumn("action_rank", F.row_number().over(w)).filter(F.col("action_rank") <= k)
            .select("content_id", "action_rank", "action", "category", "owner", "priority"))


def amplify_top(tiered: DataFrame, k: int = AMPLIFY_TOP) -> DataFrame:
    """Positive categories; only the top k carry a suggestion (first action)."""
    pos = tiered.filter(F.col("sentiment") == "positive")
    return pos.select("content_id", "category", "rank", "tier",
                      F.when((F.col("rank") <= k) & ~F.col("noise"), F.element_at(F.col("actions"), 1))
                      .alias("amplification_suggestion"))


def top_strengths(tiered: DataFrame, k: int = TOP_STRENGTH_AREAS) -> DataFrame:
    """The k leading non-excluded strength areas per course."""
    pos = tiered.filter((F.col("sentiment") == "positive") & (F.col("tier") != "excluded"))
    w = Window.partitionBy("content_id").orderBy("rank")
    return (pos.withColumn("strength_rank", F.row_number().over(w)).filter(F.col("strength_rank") <= k)
            .select("content_id", "strength_rank", "category", "count"))


# ----------------------------------------------------------------------------- P26 / E5
def category_block(groups: DataFrame, samples: DataFrame) -> DataFrame:
    """The per-(course, sentiment) text block that describes all categories.

    Categories by count desc (ties: first seen), share with one decimal, at most 3
    actions and the first 5 comments.  Each group contributes a bounded number of
    rows (<= 16 categories x 5 samples), so the final collect is bounded too.
    """
    s = (samples.groupBy(*GROUP)
         .agg(F.array_sort(F.collect_list(F.struct("sample_rank", "comment"))).alias("samples")))
    g = groups.join(s, GROUP, "left")
    pct = F.format_number(F.col("count") / F.greatest(F.lit(1), F.col("total")).cast("double") * 100.0, 1)
    acts = F.slice(F.col("actions"), 1, SAMPLE_ACTIONS)
    lines = F.concat_ws(
        "\n",
        F.concat(F.lit("\n### Category: "), F.col("category")),
        F.concat(F.lit("- Comment count: "), F.col("count").cast("string"), F.lit(" ("), pct, F.lit("% of total)")),
        F.concat(F.lit("- Root Cause: "), F.col("root_cause")),
        F.concat(F.lit("- Owner: "), F.col("owner")),
        F.concat(F.lit("- Priority: "), F.col("priority")),
        F.when(F.size(acts) > 0, F.concat(F.lit("- Sample Recommended Actions: "), F.array_join(acts, ", "))),
        F.lit("- Sample Comments (up to 5):"),
        F.array_join(F.transform(F.coalesce(F.col("samples"), F.array()),
                                 lambda x: F.concat(F.lit('  * "'), x["comment"], F.lit('"'))), "\n"),
    )
    # concat_ws drops a null line (no actions) and an empty sample list leaves a
    # trailing empty string only when there are no samples, which cannot happen.
    per = g.select("content_id", "sentiment", "total", "rank", lines.alias("block"))
    return (per.groupBy("content_id", "sentiment")
            .agg(F.max("total").alias("total_count"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "block"))),
                                          lambda x: x["block"]), "\n").alias("category_data")))

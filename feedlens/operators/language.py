"""Language detection (E2, P13-P17, P25) and language statistics.

Built-in detector: function-word profiles.  Every token of the whole text is looked up
in one small literal map per language (a word shared by k profiles weighs UNIT / k, so
integers stay exact); a language's score is its share of all weighted hits.  The
candidates are sorted by score, ties in profile order, and shaped like a detection
service answer ``[{langCode, langScore}]`` so the same post-processing (best pick,
``code:0.0000; ...`` text, blank/unknown defaults) applies to model output from the
per-partition hook as well.  Row-wise, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import (LANG_NAMES_LENIENT, LANG_NAMES_STRICT, LANG_ORDER, LANG_ORDER_DEFAULT,
                     LANG_ORDER_LENIENT, LANGUAGE_PROFILES, LANGUAGE_WEIGHT_UNIT, SKEW_DOMINANT_PCT,
                     SKEW_HIGH_PCT, SKEW_MODERATE_PCT)
from ..functions.text import extract_words, is_blank, title_case, utrim


def profile_weights() -> dict[str, dict[str, int]]:
    holders: dict[str, int] = {}
    for _, words in LANGUAGE_PROFILES:
        for w in set(words):
            holders[w] = holders.get(w, 0) + 1
    return {code: {w: LANGUAGE_WEIGHT_UNIT // holders[w] for w in sorted(set(words))}
            for code, words in LANGUAGE_PROFILES}


def holder_groups() -> list[tuple[frozenset, list[str]]]:
    """Profile words grouped by the set of languages that hold them."""
    holders: dict[str, set] = {}
    for code, words in LANGUAGE_PROFILES:
        for w in words:
            holders.setdefault(w, set()).add(code)
    groups: dict[frozenset, list[str]] = {}
    for w, hs in holders.items():
        groups.setdefault(frozenset(hs), []).append(w)
    return sorted(groups.items(), key=lambda kv: sorted(kv[0]))


def _one_of(words: list[str]):
    return lambda t: t.isin(*words)


def language_hits(low: Column) -> Column:
    """array<struct<pos, code, hits>> for an already lower-cased text.

    One pass pulls out the tokens that any profile holds; these are counted by holder group (words shared
    by the same languages).  A language's hits = sum over its groups of (UNIT / group size) x matches,
    which is the per-word weight UNIT / k summed over the text, in exact integers.
    """
    groups = holder_groups()

    def hits(n: Column) -> Column:
        out = []
        for i, (code, _) in enumerate(LANGUAGE_PROFILES):
            terms = [n[k] * F.lit(LANGUAGE_WEIGHT_UNIT // len(hs)) for k, (hs, _) in enumerate(groups) if code in hs]
            out.append(F.struct(F.lit(i).alias("pos"), F.lit(code).alias("code"), sum(terms[1:], terms[0]).cast("int").alias("hits")))
        return F.array(*out)

    def counts(found: Column) -> Column:
        return F.array(*[F.size(F.filter(found, _one_of(ws))) for _, ws in groups])

    # bound in lambdas: the tokens are found once for all groups, and those of a group counted once for all its languages
    found = extract_words(low, {w for _, ws in groups for w in ws})
    return F.element_at(F.transform(F.transform(F.array(found), counts), hits), 1)


def candidates_from_hits(arr: Column) -> Column:
    """Candidates sorted by score desc (ties in profile order), score = hits / all hits."""
    total = F.aggregate(arr, F.lit(0), lambda acc, x: acc + x["hits"])
    scored = F.transform(F.filter(arr, lambda x: x["hits"] > 0),
                         lambda x: F.struct((-x["hits"]).alias("neg_hits"), x["pos"].alias("pos"),
                                            x["code"].alias("langCode"),
                                            (x["hits"].cast("double") / total.cast("double")).alias("langScore")))
    return F.transform(F.array_sort(scored), lambda x: F.struct(x["langCode"].alias("langCode"),
                                                                x["langScore"].alias("langScore")))


def score_text(score: Column) -> Column:
    """Four decimals of the binary value, half to even."""
    return F.format_number(score, 4)


@dataclass(frozen=True)
class DetectionProfile:
    """Detection-output conventions of the two upstream detectors."""
    blank_code: str            # code for blank text
    empty_code: str            # code when the detector returns no candidate
    remap_unknown: bool        # 'unknown' -> 'hinglish'
    scored: bool               # service returns scores (else 1.0 / 0.0 flag)


STRICT_DETECTION = DetectionProfile(blank_code="en", empty_code="en", remap_unknown=True, scored=True)
LENIENT_DETECTION = DetectionProfile(blank_code="UNKNOWN", empty_code="UNKNOWN", remap_unknown=False, scored=False)


def detection_columns(cands: Column, blank: Column, latency: Column,
                      prof: DetectionProfile = STRICT_DETECTION) -> list[Column]:
    """P13-P16 from a candidate array: code, confidence, label text, latency."""
    best = F.element_at(cands, 1)
    has = F.size(cands) > 0
    code = best["langCode"]
    if prof.remap_unknown:
        code = F.when(code == "unknown", F.lit("hinglish")).otherwise(code)          # P15
    if prof.scored:
        conf = best["langScore"]
        labels = F.array_join(F.transform(cands, lambda c: F.concat(c["langCode"], F.lit(":"),
                                                                     score_text(c["langScore"]))), "; ")   # P14
    else:                                                                             # P16
        conf = F.when(code != "UNKNOWN", F.lit(1.0)).otherwise(F.lit(0.0))
        labels = F.concat(code, F.lit(":1.0000"))
    out_code = F.when(blank, F.lit(prof.blank_code)).when(~has, F.lit(prof.empty_code)).otherwise(code)
    out_conf = F.when(blank | ~has, F.lit(0.0)).otherwise(conf)
    no_label = F.lit("UNKNOWN") if prof.scored else F.lit("UNKNOWN:1.0000")
    out_lab = F.when(blank, F.lit("UNKNOWN")).when(~has, no_label).otherwise(labels)
    out_lat = F.when(blank, F.lit(0.0)).otherwise(latency)
    return [out_code.alias("predicted_language"), out_conf.cast("double").alias("confidence_score"),
            out_lab.alias("top_predicted_labels"), out_lat.cast("double").alias("latency")]


def detect_language(df: DataFrame, text_col: str = "comment", prof: DetectionProfile = STRICT_DETECTION,
                    keep_candidates: bool = False) -> DataFrame:
    """E2 default detector: adds predicted_language, confidence_score, top_predicted_labels,
    latency (0.0: nothing remote was called)."""
    text = F.col(text_col)
    # Separate projections: the lower-cased text and the hit counts are computed once per
    # row (Catalyst does not inline a non-trivial column that is used several times).
    out = (df.withColumn("_blank", is_blank(text))
           .withColumn("_low", F.lower(F.coalesce(text, F.lit(""))))
           .withColumn("_lh", language_hits(F.col("_low")))
           .withColumn("_cands", candidates_from_hits(F.col("_lh"))))
    out = out.select("*", *detection_columns(F.col("_cands"), F.col("_blank"), F.lit(0.0), prof))
    out = out.drop("_low", "_lh", "_blank")
    if keep_candidates:
        return out.withColumnRenamed("_cands", "candidates")
    return out.drop("_cands")


def detection_from_calls(called: DataFrame, cands: str = "candidates", prof: DetectionProfile = STRICT_DETECTION) -> DataFrame:
    """E2 on the output of the hook (E4): candidates, error and latency of each call become the
    detection columns; a failed call is a row with code ``ERROR`` and no score, labelled
    ``RATE_LIMIT_ERROR`` where the service kept refusing."""
    failed = F.col("error").isNotNull()
    blank = is_blank(F.col("comment"))
    names = ["predicted_language", "confidence_score", "top_predicted_labels", "latency"]
    some = F.coalesce(F.col(cands), F.array().cast("array<struct<langCode:string,langScore:double>>"))
    rows = called.select(*[c for c in called.columns if c not in ("latency", cands, "error", "attempts")], failed.alias("_failed"), "error",
                         *detection_columns(some, blank, F.col("latency"), prof))
    label = F.when(F.col("error").startswith("RATE_LIMIT_ERROR"), "RATE_LIMIT_ERROR").otherwise("ERROR")
    values = dict(zip(names, (F.lit("ERROR"), F.lit(0.0), label, F.lit(0.0))))
    return rows.select(*[c for c in rows.columns if c not in (*names, "_failed", "error")],
                       *[F.when(F.col("_failed"), values[n]).otherwise(F.col(n)).alias(n) for n in names])


# ----------------------------------------------------------------------------- names
def language_dim(spark, lenient: bool = False) -> DataFrame:
    """code -> display name and display order (small fixed table)."""
    names = LANG_NAMES_LENIENT if lenient else LANG_NAMES_STRICT
    order = LANG_ORDER_LENIENT if lenient else LANG_ORDER
    rows = [(c, n, order.get(n, LANG_ORDER_DEFAULT)) for c, n in names.items()]
    return spark.createDataFrame(rows, "code string, name string, lang_order int")


def lang_code_key(col: Column, default: str = "hinglish") -> Column:
    return F.lower(utrim(F.coalesce(col, F.lit(default))))


def lang_name(df: DataFrame, code_col: str = "lang_code", lenient: bool = False, out: str = "lang_name") -> DataFrame:
    """Display name by a broadcast join to the fixed dimension (a bounded, literal
    table); unmapped codes are title-cased."""
    dim = language_dim(df.sparkSession, lenient).select(F.col("code").alias("_code"), F.col("name").alias("_name"))
    return (df.join(F.broadcast(dim), F.col(code_col) == F.col("_code"), "left")
            .withColumn(out, F.coalesce(F.col("_name"), title_case(F.col(code_col))))
            .drop("_code", "_name"))


def lang_order(name: Column, lenient: bool = False) -> Column:
    """Fixed order of display names, 99 for the rest."""
    order = LANG_ORDER_LENIENT if lenient else LANG_ORDER
    m = F.create_map(*[x for k, v in order.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, name), F.lit(LANG_ORDER_DEFAULT))


def lang_badge(code: Column, lenient: bool = False) -> Column:
    """P25: upper-cased code; the lenient profile shows 'unknown' as 'UNK'."""
    if lenient:
        return F.when(code == "unknown", F.lit("UNK")).otherwise(F.upper(code))
    return F.upper(code)


def skew(pct: Column) -> list[Column]:
    """Share of all language rows -> class and label."""
    cls = F.when(pct > SKEW_HIGH_PCT, "dom").when(pct > SKEW_MODERATE_PCT, "bal").otherwise("min")
    lab = (F.when(pct > SKEW_DOMINANT_PCT, "Dominant").when(pct > SKEW_HIGH_PCT, "High")
           .when(pct > SKEW_MODERATE_PCT, "Moderate").otherwise("Low"))
    return [cls.alias("skew_class"), lab.alias("skew_label")]


# ----------------------------------------------------------------------------- stats
def detection_file_stats(lang: DataFrame) -> DataFrame:
    """Per course: samples, total and mean latency."""
    return lang.groupBy("content_id").agg(F.count(F.lit(1)).alias("samples"),
                                          F.sum("latency").alias("total_latency"),
                                          F.avg("latency").alias("mean_latency"))


def detection_summary(lang: DataFrame, failed_codes=("ERROR",)) -> DataFrame:
    """Totals, failed vs successful, shares, mean latency, throughput (0 without time)."""
    failed = F.col("predicted_language").isin(*failed_codes)
    agg = lang.agg(F.countDistinct("content_id").alias("files"),
                   F.count(F.lit(1)).alias("total_samples"),
                   F.count_if(failed).alias("failed"),
                   F.count_if(~failed).alias("successful"),
                   F.sum("latency").alias("total_time"),
                   F.avg("latency").alias("mean_latency"))
    n = F.col("total_samples").cast("double")
    return agg.select("files", "total_samples", "failed", "successful",
                      F.coalesce(F.try_divide(F.col("successful") * 100.0, n), F.lit(0.0)).alias("success_pct"),
                      F.coalesce(F.try_divide(F.col("failed") * 100.0, n), F.lit(0.0)).alias("failed_pct"),
                      F.coalesce(F.col("mean_latency"), F.lit(0.0)).alias("mean_latency"),
                      F.when(F.col("total_time") > 0, n / F.col("total_time")).otherwise(F.lit(0.0))
                      .alias("throughput"))


def detected_language_counts(lang: DataFrame) -> DataFrame:
    """Counts per detected code (the detector's own summary)."""
    return lang.groupBy("predicted_language").agg(F.count(F.lit(1)).alias("n"))

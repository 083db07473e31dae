"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern over host and path.  Its literal tokens (runs of letters and digits that
a matching url must contain whole) are known from the pattern; the rule is filed under the
one that the fewest urls contain, counted over all pages.  A url's tokens fetch the rules
filed under them, and only these run their regular expression.

Two kinds of rules:

* base rules ``host/path``: fit the host and all its subdomains if the path starts with the
  rule's path; the longest that fits decides;
* block patterns for urls that no base rule fits: ``||`` anchors at a host label, ``*`` is any
  run of characters, ``^`` is the end or a character that is no letter, digit, ``_``, ``-``,
  ``.`` or ``%``; letters match in either case.  Urls that fit none are allowed.

The rules are a parameter list; their index is broadcast only up to ``BROADCAST_RULES`` rows,
beyond which the same join shuffles.  Equal urls are judged once.

Defined results: a null url or one without ``://`` has empty host and path, no rule, and is
allowed; repeated rows are kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Fixed values of the contract: the base rules.
BASE_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
# Our own block patterns.
BLOCK_PATTERNS = [
    "||ads.", "||adserver.", "||ads-track.", "||ad-track.", "||banner.", "||banners.", "||clicktrack.", "||popunder.",
    "||track.", "||tracker.", "||telemetry.", "||doubleclick.", "||adclick.", "||affiliate.", "||casino.", "||poker.",
    "||porn.", "||xxx.", "||escort.", "||warez.", "||torrent.", "||phish.", "||malware.", "||spam.", "||bet.", "||slots.",
    "/wp-login.php", "/wp-admin/", "/xmlrpc.php", "/cgi-bin/", "/phpmyadmin/", "/.git/", "/.env^", "/casino/", "/poker/", "/porn/",
    "/xxx/", "/viagra/", "/adframe.", "/banner/", "/banners/", "/popup/", "/popunder/", "/tracking/pixel.", "/beacon.gif^", "/affiliate/",
]
BROADCAST_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def base_regex(rule: str) -> str:
    host, _, path = rule.partition("/")
    return f"^(?:[^/]*\\.)?{re.escape(host)}{re.escape('/' + path)}"


def block_regex(pattern: str) -> str:
    body = pattern.removeprefix("||")
    out = "".join({"*": "[\\s\\S]*", "^": "(?:$|[^A-Za-z0-9_.%-])"}.get(c, re.escape(c)) for c in body)
    return "(?i)" + ("^(?:[^/]*\\.)?" if pattern.startswith("||") else "") + out


def literal_tokens(pattern: str) -> list[str]:
    """Tokens that every match contains whole: bounded by fixed characters on both sides."""
    anchored = pattern.startswith("||")
    body = pattern.removeprefix("||").lower()
    found = []
    for m in re.finditer(r"[a-z0-9]+", body):
        before = body[m.start() - 1] if m.start() else ("." if anchored else "*")
        after = body[m.end()] if m.end() < len(body) else "*"
        if before != "*" and after != "*":
            found.append(m[0])
    return sorted(set(found))


def rules(base: list[tuple[str, str]] | None = None, block: list[str] | None = None) -> list[tuple[str, str, str, int, list[str]]]:
    """(name, action, regex, rank, literal tokens); base rules rank by length above all patterns."""
    base, block = BASE_RULES if base is None else base, BLOCK_PATTERNS if block is None else block
    out = [(r, a, base_regex(r), len(r), literal_tokens("||" + r.rpartition("/")[0] + "/")) for r, a in base]
    out += [(p, "block", block_regex(p), 0, literal_tokens(p)) for p in block]
    for name, _, _, _, tokens in out:
        if not tokens:
            raise ValueError(f"rule {name!r} has no literal token to be indexed by")
    return out


def _host_path() -> tuple[Column, Column]:
    part = lambda k: F.coalesce(F.regexp_extract("url", r"://([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def judge(pages: DataFrame, base: list[tuple[str, str]] | None = None, block: list[str] | None = None) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, pattern) for every page; ``pattern`` is the block
    pattern that decided, if one did."""
    spark, listed = pages.sparkSession, rules(base, block)
    small = len(listed) <= BROADCAST_RULES
    hint = F.broadcast if small else (lambda df: df)
    host, path = _host_path()
    pages = pages.select("page_id", F.col("url").cast("string").alias("url")).select("*", host.alias("host"), path.alias("path"))
    urls = pages.select("url", F.concat("host", "path").alias("place")).filter("place <> ''").distinct()
    tokens = urls.select("url", "place", F.explode(F.array_distinct(F.split(F.translate("place", UPPER, LOWER), "[^a-z0-9]+"))).alias("token"))
    ruled = spark.createDataFrame(listed, "rule string, action string, regex string, rank int, tokens array<string>")
    named = ruled.select("rule", "action", "regex", "rank", F.explode("tokens").alias("token"))
    # the urls that contain each token of a rule: at most a row for each such token
    counts = tokens.join(hint(named.select("token").distinct()), "token").groupBy("token").count()
    index = (named.join(counts, "token", "left").groupBy("rule", "action", "regex", "rank")
             .agg(F.min(F.struct(F.coalesce("count", F.lit(0)), "token")).getField("token").alias("token")))
    fits = (tokens.join(hint(index), "token").filter(F.expr("place rlike regex"))
            .groupBy("url").agg(F.max(F.struct("rank", "rule", "action")).alias("fit")))
    own = F.when(F.col("fit.rank") > 0, F.col("fit.rule"))
    return pages.join(fits, "url", "left").select(
        "page_id", "url", "host", "path", own.alias("rule"), F.coalesce("fit.action", F.lit("allow")).alias("verdict"),
        F.when(F.col("fit.rank") == 0, F.col("fit.rule")).alias("pattern"))


def op4_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


def oracle() -> str:
    """DuckDB SQL for the query: every rule is tried on every page."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    tries = lambda kind: " ".join(
        f"WHEN regexp_matches(host || path, {quote(r[2])}) THEN {quote(r[0])}" for r in sorted(rules(), key=lambda r: -r[3]) if (r[3] > 0) == kind)
    acts = " ".join(f"WHEN {quote(r)} THEN {quote(a)}" for r, a in BASE_RULES)
    return f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
tried AS (SELECT *, CASE {tries(True)} END AS rule, CASE {tries(False)} END AS pattern FROM parts)
SELECT page_id, host, path, rule,
       CASE rule {acts} ELSE CASE WHEN pattern IS NOT NULL AND host || path <> '' THEN 'block' ELSE 'allow' END END AS verdict
FROM tried"""

"""Places of pattern matches in texts, as SQL expressions over the column ``text``.

A span is struct<start, rank, end, kind, value>: code points, end exclusive; ``rank`` orders
kinds that start together.  Matches are leftmost and do not overlap within a kind.  The
patterns are written for Java's matcher so that each is linear in the text: possessive
repeats where the next character can't belong to the repeat, and a look-behind that starts
runs at their beginning (or where the last match ended).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let, prefix_sums, text_of

SPAN = "struct<start: bigint, rank: int, end: bigint, kind: string, value: string>"


def matches(kind: str, rank: int, pattern: str, needs: str = "true", valid: str = "true", text: str = "text") -> str:
    """SQL for the spans of one kind: of texts that fulfil ``needs``, the matches ``s`` that fulfil ``valid``."""
    empty = f"cast(array() as array<{SPAN}>)"
    place = f"transform(mt, (v, i) -> struct(st[i] + ln[i] as start, {rank} as rank, st[i] + ln[i] + length(v) as end, '{kind}' as kind, v as value))"
    steps = "transform(mt, (v, i) -> cast(ln[i] + length(v) as bigint))"
    found = let("pc", f"split({text}, r'{pattern}', -1)", let("ln", "transform(pc, x -> length(x))", let("st", prefix_sums(steps), f"filter({place}, s -> {valid})")))
    found = let("mt", f"regexp_extract_all({text}, r'{pattern}', 0)", f"if(size(mt) = 0, {empty}, {found})")
    return f"if({needs}, {found}, {empty})"


def listed(spans: str) -> str:
    """SQL for kind:start:end of sorted spans, comma-joined."""
    return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"


def count_of(spans: str, kind: str) -> Column:
    return F.expr(f"cast(size(filter({spans}, s -> s.kind = '{kind}')) as bigint)")


def replaced(spans: str, label: str) -> str:
    """SQL for ``text`` with its sorted ``spans`` replaced by ``label`` (SQL over the span ``s``).

    Overlapping spans are merged and take the label of the first.
    """
    blank = "struct(0L as start, 0L as end, '' as name)"
    merged = (f"aggregate({spans}, struct(cast(array() as array<struct<start: bigint, end: bigint, name: string>>) as done, {blank} as cur),"
              f" (a, s) -> if(s.start < a.cur.end, struct(a.done as done, struct(a.cur.start as start, greatest(a.cur.end, s.end) as end, a.cur.name as name) as cur),"
              f" struct(concat(a.done, array(a.cur)) as done, struct(s.start as start, s.end as end, {label} as name) as cur)), a -> concat(a.done, array(a.cur)))")
    # the first merged span is the blank one at 0; each piece is a label and what follows it
    body = ("array_join(transform(mg, (m, i) -> concat(m.name, if(i + 1 < size(mg),"
            " substring(text, int(m.end) + 1, int(mg[i + 1].start - m.end)), substring(text, int(m.end) + 1)))), '')")
    return f"if(size({spans}) = 0, text, {let('mg', merged, body)})"


def with_replaced(docs: DataFrame, found: DataFrame, label: str) -> DataFrame:
    """``docs`` with the ``spans`` of ``found`` (doc_id, tag, spans) replaced in their texts, and
    ``n_chars``, if there, following the new text."""
    doc_id, tag, spans = fresh(docs, "span_doc_id", "span_tag", "spans")
    found = found.filter(F.size("spans") > 0).dropDuplicates(["doc_id", "tag"]).select(
        F.col("doc_id").alias(doc_id), F.col("tag").alias(tag), F.col("spans").alias(spans))
    same = docs["doc_id"].eqNullSafe(F.col(doc_id)) & (F.xxhash64(text_of()) == F.col(tag))
    none = F.col(spans).isNull()
    columns = {c: F.col(c) for c in docs.columns}
    text = F.when(none, F.col("text")).otherwise(F.expr(replaced(spans, label)))
    columns["text"] = text
    if "n_chars" in columns:
        columns["n_chars"] = F.when(none, F.col("n_chars")).otherwise(F.length(text).cast(docs.schema["n_chars"].dataType))
    return docs.join(found, same, "left").select(*(v.alias(c) for c, v in columns.items()))

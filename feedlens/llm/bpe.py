"""Byte-level BPE encoding and decoding with DuckDB recursive queries inside each partition.

The pre-token pattern cuts a text into pieces.  The distinct new pieces of a run of documents
become token-position rows (piece, position, token), one row per byte.  A recursive query
joins neighbours to the merge table and contracts each piece's leftmost pair of least rank,
until no piece has a pair left.  The rows of a piece's last step, in order, are its ids, and
the token table decodes them.  A piece that is itself a token is that token.

Documents never leave their task and nothing is shuffled.  Encoded pieces are kept per Python
worker in two generations of at most ``CACHE``, so frequent pieces are contracted once
and memory stays bounded.  Texts of over ``SEGMENT`` characters are taken in segments, cut
where the pattern always starts a new piece.  Where a text has no character beyond U+FFFF, the
standard library's matcher cuts it, by the same pattern with its classes written out.

The recursive query contracts one pair of a piece per step, so its work grows with the
square of the piece; pieces of over ``LONG_PIECE`` bytes (long runs of one kind of character)
are contracted by the same rule from a heap instead.

Defined results: a null or empty text has no tokens; repeated rows are encoded each; an empty
table gives no rows; other columns pass through or are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import annotate, fresh, kept, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: What each generation of encoded pieces may take, and what a piece takes beside its bytes and ids, roughly.
CACHE = 30_000_000
ENTRY_BYTES = 320
RUN_CHARS = 2_000_000
#: Pieces that one recursive query contracts: its rows of all steps are held until it ends.
BLOCK = 25_000
SEGMENT = 1_000_000
LONG_PIECE = 200

#: Positions stay dense, and a row carries the token behind its own (-1 behind the last); rank and
#: position of the least pair share one number, of which the position takes the low 16 bits.
ENCODE = """
WITH RECURSIVE contracted(piece, step, pos, tok, follow) AS (
  SELECT piece, 0, pos, tok, follow FROM bytes_in
  UNION ALL
  (WITH least AS (
     SELECT c.piece, min(m.merged::BIGINT * 65536 + c.pos) AS pick
     FROM contracted c JOIN merges m ON c.tok = m.l AND c.follow = m.r
     GROUP BY c.piece),
   picked AS (
     SELECT piece, pick // 65536 AS made, pick % 65536 AS spot, c.follow AS behind
     FROM contracted c JOIN least USING (piece) WHERE c.pos = pick % 65536 + 1)
   SELECT c.piece, step + 1, CASE WHEN pos > spot THEN pos - 1 ELSE pos END,
          CASE WHEN pos = spot THEN made::INT ELSE tok END,
          CASE WHEN pos = spot THEN behind WHEN pos = spot - 1 THEN made::INT ELSE follow END
   FROM contracted c JOIN picked USING (piece)
   WHERE pos <> spot + 1)
)
SELECT piece, step, pos, tok FROM contracted
"""

DECODE = """
SELECT row, unhex(string_agg(bytes, '' ORDER BY pos)) AS decoded
FROM ids_in JOIN tokens USING (id) GROUP BY row ORDER BY row
"""


BEYOND = re.compile("[\U00010000-\U0010ffff]")


@lru_cache
def members(kind: str) -> str:
    """The characters up to U+FFFF that ``regex`` counts to a class such as ``\\p{L}``, as ranges for a class of ``re``."""
    found = regex.finditer(f"{kind}+", "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\ue000" for c in range(0x10000)))
    return "".join(f"\\u{m.start():04x}-\\u{m.end() - 1:04x}" for m in found)


def plain_pattern(pattern: str) -> re.Pattern | None:
    """``pattern`` for the matcher of the standard library, on texts without characters beyond U+FFFF;
    none where it uses more than classes, literals, choices, greedy repeats and looks ahead."""
    out, inside, at = [], False, 0
    for m in regex.finditer(r"\\p\{\w+\}|\\[sS]|\(\?[!=:]|[\[\]]|[^\\\[\]&~()]|[()](?!\?)", pattern):
        part = m[0]
        if m.start() != at or (part == "[" and inside):
            return None
        at = m.end()
        if part[0] == "\\":
            part = members(part) if inside else f"[{members(part)}]"
        elif part in "[]":
            inside = part == "["
        out.append(part)
    return re.compile("".join(out)) if at == len(pattern) else None


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The pieces of a text, as ``regex`` finds them."""
    whole, plain = regex.compile(pattern).findall, plain_pattern(pattern)
    if not plain:
        return whole
    quick = plain.findall
    return lambda text: quick(text) if text.isascii() or not BEYOND.search(text) else whole(text)


class Bpe:
    """A vocabulary of ranks, with its merge and token tables in an in-memory DuckDB."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = splitter(pattern)
        self.names = {rank: str(rank).encode() for rank in self.ranks.values()}
        self.bytes = {rank: token for token, rank in self.ranks.items()}
        self.first = np.zeros(256, np.int32)
        for b in range(256):
            self.first[b] = self.ranks[bytes([b])]
        merges = [(self.ranks[t[:k]], self.ranks[t[k:]], rank) for t, rank in self.ranks.items()
                  for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "256MB"})
        self.db.register("m", pa.table(dict(zip("lrm", (pa.array(c, pa.int32()) for c in zip(*merges))))))
        self.db.register("t", pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "bytes": [t.hex() for t in self.ranks]}))
        self.db.execute("CREATE TABLE merges AS SELECT l, r, m AS merged FROM m")
        self.db.execute("CREATE TABLE tokens AS SELECT * FROM t")
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}
        self.room = CACHE

    def contract(self, pieces: list[bytes]) -> list[tuple[bytes, bytes]]:
        """(ids as text, decoded bytes) of each piece, by the recursive query."""
        return [done for at in range(0, len(pieces), BLOCK) for done in self.contract_block(pieces[at:at + BLOCK])]

    def contract_block(self, pieces: list[bytes]) -> list[tuple[bytes, bytes]]:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        pos = np.arange(len(piece)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        tok = self.first[np.frombuffer(b"".join(pieces), np.uint8)]
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int32)[piece]
        follow = np.append(tok[1:], np.int32(-1))
        follow[np.cumsum(sizes) - 1] = -1
        keep = (whole < 0) | (pos == 0)
        rows = {"piece": piece[keep], "pos": pos.astype(np.int32)[keep], "tok": np.where(whole < 0, tok, whole)[keep],
                "follow": np.where(whole < 0, follow, -1)[keep]}
        self.db.register("bytes_in", pa.table(rows))
        got = self.db.execute(ENCODE).fetchnumpy()
        self.db.unregister("bytes_in")
        piece, step = got["piece"], got["step"]
        last = np.zeros(len(pieces), step.dtype)
        np.maximum.at(last, piece, step)
        at = np.flatnonzero(step == last[piece])
        at = at[np.lexsort((got["pos"][at], piece[at]))]
        ids = got["tok"][at].tolist()
        ends = np.cumsum(np.bincount(piece[at], minlength=len(pieces))).tolist()
        names, token = list(map(self.names.__getitem__, ids)), list(map(self.bytes.__getitem__, ids))
        return [(b",".join(names[a:b]), b"".join(token[a:b])) for a, b in zip([0, *ends], ends)]

    def contract_long(self, piece: bytes) -> tuple[bytes, bytes]:
        """The same contraction of one long piece, from a heap of (rank, position)."""
        n = len(piece)
        end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        rank = lambda a, b: self.ranks.get(piece[a:end[b]]) if b < n else None
        heap = [(r, a, a + 2) for a in range(n - 1) if (r := rank(a, a + 1)) is not None]
        heapq.heapify(heap)
        while heap:
            r, a, stop = heapq.heappop(heap)
            b = end[a]
            if not alive[a] or b >= n or end[b] != stop:
                continue  # one of its two tokens has changed since
            end[a], alive[b] = stop, False
            if stop < n:
                before[stop] = a
                if (r := rank(a, stop)) is not None:
                    heapq.heappush(heap, (r, a, end[stop]))
            if before[a] >= 0 and (r := rank(before[a], a)) is not None:
                heapq.heappush(heap, (r, before[a], stop))
        ids = [self.ranks[piece[a:end[a]]] for a in range(n) if alive[a]]
        decoded = self.decode([ids])[0]
        return ",".join(map(str, ids)).encode(), decoded

    def decode(self, rows: list[list[int]]) -> list[bytes]:
        """The bytes of each row of ids, by ordered aggregation over the token table."""
        sizes = np.array([len(r) for r in rows], np.int64)
        row = np.repeat(np.arange(len(rows)), sizes)
        ids = np.fromiter((i for r in rows for i in r), np.int32, len(row))
        self.db.register("ids_in", pa.table({"row": row, "pos": np.arange(len(row)), "id": ids}))
        out = [b""] * len(rows)
        for at, decoded in self.db.execute(DECODE).fetchall():
            out[at] = decoded
        self.db.unregister("ids_in")
        return out

    def learn(self, pieces: set[str]) -> None:
        """Make every one of ``pieces`` known in the young generation."""
        if self.room < 0:
            self.young, self.old, self.room = {}, self.young, CACHE
        new = []
        for p in pieces.difference(self.young):
            known = self.old.get(p)
            if known:
                self.keep(p, known)
            else:
                new.append(p)
        raw = [p.encode() for p in new]
        short = [i for i, p in enumerate(raw) if len(p) <= LONG_PIECE or p in self.ranks]
        for i, done in zip(short, self.contract([raw[i] for i in short])):
            self.keep(new[i], done)
        for p, b in zip(new, raw):
            if p not in self.young:
                self.keep(p, self.contract_long(b))

    def keep(self, piece: str, done: tuple[bytes, bytes]) -> None:
        self.young[piece] = done
        self.room -= ENTRY_BYTES + len(piece) + len(done[0]) + len(done[1])

    def segments(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text, in lists of bounded size."""
        start = 0
        while len(text) - start > SEGMENT:
            # a space between a non-space and a letter always starts a piece
            cut = CUT.search(text, start + SEGMENT)
            if not cut:
                break
            yield self.split(text[start:cut.start()])
            start = cut.start()
        yield self.split(text[start:] if start else text)

    def encode(self, texts: list[str]) -> list[list]:
        """n_tokens, ids (comma-joined text), sha256 of that, sha256 of the decoded bytes, for each text."""
        out = [[], [], [], []]
        waiting: list[tuple[int, list[str]]] = []
        state: dict[int, list] = {}

        def flush():
            self.learn(set().union(*[pieces for _, pieces in waiting]))
            for k, pieces in waiting:
                s = state[k]
                found = list(map(self.young.__getitem__, pieces))
                if found:
                    ids = b",".join([f[0] for f in found])
                    s[2].update(b"," + ids if s[0] else ids)
                    s[3].update(b"".join([f[1] for f in found]))
                    s[0] += ids.count(b",") + 1
                    s[1].append(ids)
            waiting.clear()

        chars = 0
        for k, text in enumerate(texts):
            state[k] = [0, [], hashlib.sha256(), hashlib.sha256()]
            for pieces in self.segments(text):
                waiting.append((k, pieces))
                chars += min(len(text), SEGMENT)
                if chars >= RUN_CHARS:
                    flush()
                    chars = 0
        flush()
        for s in state.values():
            for column, value in zip(out, (s[0], b",".join(s[1]), s[2].hexdigest(), s[3].hexdigest())):
                column.append(value)
        return out


CUT = regex.compile(r"(?<=\S) (?=\p{L})")


def loaded(path: str, pattern: str) -> Bpe:
    """The vocabulary, read once per Python worker for as long as no other operator runs there."""
    known = kept("bpe")
    if (path, pattern) not in known:
        known[path, pattern] = Bpe(path, pattern)
    return known[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """``docs`` with _n_tokens, _ids_sha256, _decoded_sha256 and, if asked for, _ids (array<int>);
    underscores are added to a name that a column of ``docs`` has."""
    names = fresh(docs, "_n_tokens", "_ids_sha256", "_decoded_sha256", "_ids")

    def compute(texts):
        n, ids, ids_sha, decoded_sha = loaded(path, pattern).encode([t.decode() for t in texts])
        more = [[np.fromstring(i, np.int32, sep=",") if i else np.zeros(0, np.int32) for i in ids]] if with_ids else []
        return [n, ids_sha, decoded_sha, *more]

    kinds = ["long", "string", "string", "array<int>"][: 3 + with_ids]
    return annotate(docs, compute, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)), operator="bpe")


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "_ids") -> DataFrame:
    """``rows`` with _decoded (binary): the bytes of each array of ids; null ids give no bytes."""
    import pyspark.sql.types as T
    at = rows.columns.index(ids)
    schema = T.StructType([*rows.schema.fields, T.StructField("_decoded", T.BinaryType())])
    names = schema.names

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                made = loaded(path, pattern).decode([r or [] for r in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.binary())], names=names)

    return rows.mapInArrow(run, schema)


def public_vocabulary() -> tuple[str, str]:
    """Place and pattern of the public vocabulary that the query names."""
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded bytes, as digests, of every document."""
    path, pattern = public_vocabulary()
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return encode(docs, path, pattern, with_ids=False).select(
        "doc_id", F.col("_n_tokens").alias("n_tokens"), F.col("_ids_sha256").alias("ids_sha256"),
        F.col("_decoded_sha256").alias("decoded_sha256"))

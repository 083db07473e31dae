"""BPE encoding and decoding by dynamic programming over prefixes.

Every prefix of a piece has exactly one encoding, so it has exactly one last token.  A suffix
automaton of the vocabulary reads the piece byte by byte; at each prefix its suffix links
give the tokens that end there, the longest first.  A token is the last one of the prefix if
it is the whole prefix, or if it is compatible with the last token of the prefix before it:
two tokens stand beside each other in an encoding if and only if no merge reaches across
their border before the merges that formed them.  The last tokens are stored, and following
them back from the end emits the ids.  The work is linear in the piece, whatever its length.

The vocabulary is a ``tokenizers`` JSON file of byte-level BPE: the pre-token pattern cuts
the text into pieces, and added tokens are found in the text before.  Documents never leave
their task and nothing is shuffled.  Encoded pieces are kept per Python worker in two
generations of at most ``CACHE_BYTES`` each, so frequent pieces are worked out once.

Defined results: a null or empty text has no tokens; repeated rows are encoded each; very long
texts are cut into pieces as they are read, ``RUN`` at a time, and very long pieces take time in
proportion; an empty table gives no rows; other columns pass through, and underscores are added
to a new name that a column already has; null ids decode to null, unknown ids to nothing.
"""

from __future__ import annotations

import atexit
import gc
import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, bounded_batches, fresh, sliced, table

VOCABULARY = "byte_bpe_50k.json"
CACHE_BYTES = 80_000_000
#: What a kept piece takes beside its bytes and ids, roughly.
ENTRY_BYTES = 200
PAIRS = 1_000_000
RUN = 100_000

#: Fixed value: the pre-token pattern of byte-level BPE files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: letters of newer Unicode versions, which the ``tokenizers`` library takes for other characters.
LATER = (r"\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD\uA7E2\uA7F1\uAB6C-\uAB6D"
         r"\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A"
         r"\U00011DB0-\U00011DDB\U00011DF1\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3\U00016FF2-\U00016FF3"
         r"\U000187F8-\U000187FF\U00018CD6-\U00018CDA\U00018D09-\U00018D20\U00018D80-\U00018DF2\U00018E00-\U00019191"
         r"\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168\U0001D6A6\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DF81"
         r"\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE\U0001E6E0-\U0001E6E2\U0001E6E4-\U0001E6E5"
         r"\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4\U0001E6FE-\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E"
         r"\U0002CEA2-\U0002CEAD\U000323B0-\U00033479\U0003D000-\U0003FC3F")
_LETTER = rf"[\p{{L}}--[{LATER}]]"
SPLIT = regex.compile(PATTERN)
SPLIT_LATER = regex.compile(r"(?V1)" + PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{N}}]--{_LETTER}]").replace(r"\p{L}+", _LETTER + "+", 1))
HAS_LATER = regex.compile(f"[{LATER}]").search


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: printable bytes for themselves, the others
    for the letters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _beyond_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return True
    return False


class SuffixAutomaton:
    """All substrings of some words.  Each word is the longest string of its own state.  ``ends`` holds,
    for each state, the words (size, word) that end where its longest string does, the longest first;
    ``shorter`` the same without the state's own word, for when less than its longest string was read."""

    def __init__(self, words: dict[bytes, int]):
        self.link, self.size = [-1], [0]
        self.next: list[dict[int, int]] = [{}]
        own: dict[int, tuple[int, int]] = {}
        for text, w in words.items():
            state = 0
            for c in text:
                state = self._extend(state, c)
            own[state] = len(text), w
        self.ends: list[tuple] = [()] * len(self.link)
        self.shorter: list[tuple] = [()] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.size.__getitem__):
            self.shorter[s] = self.ends[self.link[s]]
            self.ends[s] = (own[s], *self.shorter[s]) if s in own else self.shorter[s]

    def _state(self, size: int, link: int, moves: dict[int, int]) -> int:
        self.link.append(link)
        self.size.append(size)
        self.next.append(moves)
        return len(self.link) - 1

    def _split(self, above: int, c: int) -> int:
        """The state for what ``above`` reads with ``c``, parted from longer strings if need be."""
        to = self.next[above][c]
        if self.size[to] == self.size[above] + 1:
            return to
        part = self._state(self.size[above] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = part
        while above >= 0 and self.next[above].get(c) == to:
            self.next[above][c] = part
            above = self.link[above]
        return part

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c)
        new = self._state(self.size[last] + 1, 0, {})
        while last >= 0 and c not in self.next[last]:
            self.next[last][c] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, c)
        return new


class Pieces(dict):
    """Encoded pieces, each worked out when it is first asked for."""

    def __init__(self, encode: Callable[[str], tuple[int, ...]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> tuple[int, ...]:
        return self.encode(piece)


class PrefixBpe:
    """A vocabulary with its merges, its suffix automaton and the encoded pieces of this worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if not set(byte_letters()) <= set(model["vocab"]):
            raise ValueError(f"{path}: not every byte is a token")
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError(f"{path}: not a byte-level BPE file with the usual pattern")
        if spec.get("normalizer") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges"):
            raise ValueError(f"{path}: normalizers, affixes and ignored merges are not supported")
        added = spec.get("added_tokens") or []
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
            raise ValueError(f"{path}: added tokens that take white space or whole words are not supported")
        letters = byte_letters()
        raw = lambda t: bytes(letters[c] for c in t)
        self.added = {a["content"]: a["id"] for a in added}
        vocabulary = {raw(t): i for t, i in model["vocab"].items() if t not in self.added}
        size = 1 + max([*model["vocab"].values(), *self.added.values()])
        self.bytes_of = [b""] * size
        for t, i in vocabulary.items():
            self.bytes_of[i] = t
        for t, i in self.added.items():
            self.bytes_of[i] = t.encode()
        self.digits = list(map(str, range(size)))
        # rank -1: a single byte; the merge that forms a token is undone into its two parts
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.merge: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (vocabulary[raw(t)] for t in (pair if isinstance(pair, list) else pair.split(" ")))
            whole = vocabulary[self.bytes_of[a] + self.bytes_of[b]]
            if self.rank[whole] >= 0:
                raise ValueError(f"{path}: two merges form the token {whole}")
            self.rank[whole], self.left[whole], self.right[whole] = rank, a, b
            self.merge[a << 32 | b] = rank
        # a token that its own bytes do not encode to never occurs
        sound = [False] * size
        for i in sorted(vocabulary.values(), key=self.rank.__getitem__):
            a, b = self.left[i], self.right[i]
            sound[i] = len(self.bytes_of[i]) == 1 if a < 0 else sound[a] and sound[b] and self._beside(a, b, self.rank[i])
        self.words = SuffixAutomaton({t: i for t, i in vocabulary.items() if sound[i]})
        self.specials = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.after: list[dict[int, bool]] = [{} for _ in range(size)]
        self.known = 0
        self.young, self.old, self.room = Pieces(self.piece), {}, CACHE_BYTES

    def _beside(self, a: int, b: int, before: int) -> bool:
        """Whether no merge of a rank below ``before`` reaches across the border of a and b.  Undoes, from
        the latest on, the merges that formed the tokens at the border; of equal merges the left one came first."""
        rank, merge = self.rank, self.merge
        while True:
            across = merge.get(a << 32 | b)
            if across is not None and across < before:
                return False
            if rank[a] > rank[b]:
                before, a = rank[a], self.right[a]
            elif rank[b] >= 0:
                before, b = rank[b] + 1, self.left[b]
            else:
                return True

    def compatible(self, a: int, b: int) -> bool:
        """Whether the two tokens can stand beside each other, kept for the next time."""
        if self.known >= PAIRS:
            self.known = 0
            for beside in self.after:
                beside.clear()
        self.known += 1
        found = self.after[a][b] = self._beside(a, b, len(self.merge))
        return found

    def ids(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        words, after = self.words, self.after
        moves, link, size, ends, shorter = words.next, words.link, words.size, words.ends, words.shorter
        last, starts = [-1], [0]
        state = length = end = 0
        for c in piece:
            end += 1
            to = moves[state].get(c)
            while to is None:  # the root has a move for every byte
                state = link[state]
                length = size[state]
                to = moves[state].get(c)
            state = to
            length += 1
            for n, token in ends[state] if length == size[state] else shorter[state]:
                start = end - n
                if not start:
                    break
                fits = after[last[start]].get(token)
                if fits or fits is None and self.compatible(last[start], token):
                    break
            last.append(token)
            starts.append(start)
        out = []
        while end:
            out.append(last[end])
            end = starts[end]
        return out[::-1]

    def piece(self, text: str) -> tuple[int, ...]:
        """The ids of one piece, kept for the next time."""
        ids = self.old.get(text)
        if ids is None:
            ids = tuple(self.ids(text.encode()))
        if self.room < 0:
            self.young, self.old, self.room = Pieces(self.piece), self.young, CACHE_BYTES
        self.young[text] = ids
        self.room -= ENTRY_BYTES + 3 * len(text) + 8 * len(ids)
        return ids

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes of some ids of the vocabulary."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def parts(self, text: str) -> Iterator[tuple[str, int]]:
        """The text between added tokens (with -1) and the added tokens (with their ids)."""
        at = 0
        for m in self.specials.finditer(text) if self.specials else ():
            yield text[at:m.start()], -1
            yield m.group(), self.added[m.group()]
            at = m.end()
        yield text[at:] if at else text, -1

    def runs(self, text: str) -> Iterator[list[int]]:
        """The ids of a text, ``RUN`` pieces at a time."""
        for part, special in self.parts(text):
            if special >= 0:
                yield [special]
                continue
            split = SPLIT_LATER if _beyond_latin(part) and HAS_LATER(part) else SPLIT
            if len(part) <= 4 * RUN:
                yield self.found(split.findall(part))
                continue
            pieces = (m.group() for m in split.finditer(part))
            while run := list(islice(pieces, RUN)):
                yield self.found(run)

    def found(self, pieces: list[str]) -> list[int]:
        return list(chain.from_iterable(map(self.young.__getitem__, pieces)))

    def encode(self, text: str) -> tuple[int, list[list[int]], str, str]:
        """n_tokens, ids in runs, sha256 of the comma-joined ids, sha256 of the decoded text."""
        n, runs, ids_sha, text_sha = 0, [], hashlib.sha256(), hashlib.sha256()
        for ids in self.runs(text):
            if ids:
                line = ",".join(map(self.digits.__getitem__, ids)).encode()
                ids_sha.update(b"," + line if n else line)
                text_sha.update(self.decode(ids))
                n += len(ids)
                runs.append(ids)
        return n, runs, ids_sha.hexdigest(), text_sha.hexdigest()


_LOADED: dict[str, PrefixBpe] = {}


def loaded(path: str) -> PrefixBpe:
    """The vocabulary, read once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = PrefixBpe(path)
        gc.collect()
        gc.freeze()  # the automaton stays: later collections need not visit it
        atexit.register(gc.unfreeze)
    return _LOADED[path]


def encode(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """``docs`` with _n_tokens, _ids_sha256, _decoded_sha256 and, if asked for, _ids (array<int>)."""
    kinds = ["long", "string", "string", "array<int>"][: 3 + with_ids]
    names = fresh(docs, "_n_tokens", "_ids_sha256", "_decoded_sha256", "_ids")

    def compute(texts):
        bpe = loaded(path)
        out = [[] for _ in kinds]
        for t in texts:
            n, runs, *digests = bpe.encode(t.decode("utf-8", "replace"))
            for column, value in zip(out, (n, *digests, runs and np.concatenate(runs, dtype=np.int32) if with_ids else None)):
                column.append(value)
        return out

    return annotate(docs, compute, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def decode(rows: DataFrame, path: str, ids: str = "_ids") -> DataFrame:
    """``rows`` with _decoded (string): the text of each array of ids; bytes that are no UTF-8 become U+FFFD."""
    name, = fresh(rows, "_decoded")
    at = rows.columns.index(ids)
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())])
    names = schema.names

    def run(batches):
        for b in sliced(batches):
            bpe = loaded(path)
            known = [[i for i in r or [] if i is not None and 0 <= i < len(bpe.bytes_of)] for r in b.column(at).to_pylist()]
            made = [bpe.decode(r).decode("utf-8", "replace") if ok else None for r, ok in zip(known, b.column(at).is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.string())], names=names)

    bounded_batches(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def public_vocabulary() -> str:
    """Place of the public vocabulary that the query names."""
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def op11_prefixbpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text, as digests, of every document."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return encode(docs, public_vocabulary(), with_ids=False).select(
        "doc_id", F.col("_n_tokens").alias("n_tokens"), F.col("_ids_sha256").alias("ids_sha256"),
        F.col("_decoded_sha256").alias("decoded_sha256"))

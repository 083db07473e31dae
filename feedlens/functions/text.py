"""Column-level text helpers.

All of these return Column expressions built from Spark built-ins, so they stay inside
whole-stage codegen.  The only Python piece is NFKC normalisation, which Spark lacks;
it runs as an Arrow-batched pandas UDF; rows that it cannot change reach it as nulls.

Whitespace follows Python ``str.split()`` / ``str.strip()``: Java's ``\\s`` is ASCII
only, so the class is spelled out (the same class also works in RE2, which keeps the
SQL oracles identical).
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Python's whitespace set (str.split with no argument).
WS_CHARS = (
    "\\t\\n\\x0b\\f\\r \\x1c-\\x1f\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
)
WS = f"[{WS_CHARS}]"
NON_WS_RUN = f"[^{WS_CHARS}]+"
# A word token: a run of letters and combining marks (keeps Indic words whole).
WORD_TOKEN = "[\\p{L}\\p{M}]+"
# The same tokens for Spark: a run is never tried again shorter.
_WORD_RUN = WORD_TOKEN + "+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def utrim(col) -> Column:
    """Unicode-aware strip().  The regex only runs when an end character is whitespace
    (two one-character tests), which is rare for real text."""
    c = _c(col)
    ends = F.substring(c, 1, 1).rlike(WS) | F.substring(c, -1, 1).rlike(WS)
    return F.when(ends, F.regexp_replace(c, f"^{WS}+|{WS}+$", "")).otherwise(c)


#: The same set for Java's own table of white space, which tells a character by one look.
_WS_QUICK = "[\\s\\x1c-\\x1f]"
#: A run of whitespace that is not one plain space: its first character is another one, or more follow.
_WS_RUN = f"(?U){_WS_QUICK}(?:(?<! )|(?={_WS_QUICK})){_WS_QUICK}*+"


def collapse_ws(col) -> Column:
    """' '.join(s.split()): every whitespace run becomes one space, then the (now plain
    space) ends are cut.  Single spaces, which most runs are, stay as they are."""
    return F.trim(F.regexp_replace(_c(col), _WS_RUN, " "))


#: The same for text of ASCII alone: its ten whitespace characters are told by one look into a small table.
_WS_ASCII = "[ \\t\\n\\x0b\\f\\r\\x1c\\x1d\\x1e\\x1f]"
_WS_RUN_ASCII = f"{_WS_ASCII}(?:(?<! )|(?={_WS_ASCII})){_WS_ASCII}*+"


def is_ascii(col) -> Column:
    """As many bytes as characters: two counts, no pattern and no decoding."""
    c = _c(col)
    return F.octet_length(c) == F.length(c)


def word_count(col) -> Column:
    """len(s.split()); 0 for empty text.  Collapse the whitespace runs to single spaces,
    then count the spaces (a plain replace, no token array, no second regex)."""
    # bound in a lambda: the collapsed text is worked out once, not wherever it is used
    count = F.transform(F.array(collapse_ws(F.coalesce(_c(col), F.lit("")))), lambda c: F.when(c == "", F.lit(0)).otherwise(
        F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1))
    return F.element_at(count, 1).cast("int")


def more_words_than(col, n: int) -> Column:
    """``word_count(col) > n``, from the first words of the text alone."""
    return F.coalesce(_c(col), F.lit("")).rlike(f"^{WS}*+(?:[^{WS_CHARS}]++{WS}++){{{n}}}[^{WS_CHARS}]")


def is_blank(col) -> Column:
    """Null, empty or whitespace only (stops at the first non-space character)."""
    c = _c(col)
    return c.isNull() | ~c.rlike(f"[^{WS_CHARS}]")


def normalize_date(col) -> Column:
    """Cut a date-time text at the first 'T', else at the first space; no validation.

    'T' is tested first, so 'Tue 2 Jan' becomes ''.
    """
    c = utrim(col)
    return (F.when(c.contains("T"), F.substring_index(c, "T", 1))
            .when(c.contains(" "), F.substring_index(c, " ", 1))
            .otherwise(c))


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKC")


def _ranges(points: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for c in points:
        if out and out[-1][1] == c - 1:
            out[-1] = (out[-1][0], c)
        else:
            out.append((c, c))
    return out


def _char_class(ranges: list[tuple[int, int]]) -> str:
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


#: Planes that hold characters which normalisation may change, and how many ranges of a class are tested in a row.
_LAST, _LEAF = 0x30000, 6


def _search_tree(ranges: list[tuple[int, int]]) -> str:
    """The character class of sorted ``ranges`` by halves, so that a character is told by a few tests and not by one for each range."""
    if len(ranges) <= _LEAF:
        return _char_class(ranges)
    half = len(ranges) // 2
    below, above = ranges[:half], ranges[half:]
    gate = lambda part: f"(?=[\\x{{{part[0][0]:X}}}-\\x{{{part[-1][1]:X}}}])"
    return f"(?:{gate(below)}{_search_tree(below)}|{gate(above)}{_search_tree(above)})"


@lru_cache(maxsize=1)
def nfkc_may_change() -> str:
    """A pattern found in every text that NFKC changes, from the quick-check rule: a character that is not its
    own normal form, one that may compose behind one that it composes with or behind a mark, or two marks
    beside each other that may trade places.  Built from ``unicodedata``, which also does the normalising.

    All of these end at a character beyond ASCII, so others are passed after one test."""
    first, second = {*range(0x1100, 0x1113), *range(0xAC00, 0xD7A4)}, {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}   # Hangul
    points = [c for c in range(_LAST) if not 0xD800 <= c < 0xE000]
    for c in points:
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<") and unicodedata.normalize("NFC", chr(c)) == chr(c):
            first.add(int(parts[0], 16))
            second.add(int(parts[1], 16))
    changes = {c for c in points if unicodedata.normalize("NFKC", chr(c)) != chr(c)}
    marks = {c for c in points if unicodedata.combining(chr(c))}
    tree = lambda found: _search_tree(_ranges(sorted(found)))
    # a look-behind goes back one UTF-16 unit: behind the planes above the first, all late characters count
    behind = lambda late, before: f"(?={tree(late)})(?<={tree({c for c in before if c < 0x10000} | {*range(0xDC00, 0xE000)})})"
    return (f"(?=[^\\x00-\\x7F])(?={tree(changes | second | marks)})"
            f"(?:{tree(changes)}|{behind(second, first | marks)}|{behind(marks, marks)})")


def nfkc(col) -> Column:
    """NFKC normalisation; texts that cannot change stay in the JVM and pass the Python worker as nulls."""
    c = _c(col)
    return F.coalesce(_nfkc(F.when(~is_ascii(c) & c.rlike(nfkc_may_change()), c)), c)


def norm_comment(col, unicode_normalize: bool = True) -> Column:
    """Matching key of a comment: NFKC, smart quotes to ASCII, no backslashes,
    lower case, whitespace collapsed.

    Text of ASCII alone has no normal form and no quotes to change, so only its backslashes, case and whitespace are seen to."""
    raw = c = F.coalesce(_c(col), F.lit(""))
    if unicode_normalize:
        c = nfkc(c)
    for quote, plain in zip("‘’“”\\", ("'", "'", '"', '"', "")):          # a search for each, not a look-up for each character
        c = F.replace(c, F.lit(quote), F.lit(plain))
    ascii_only = F.trim(F.regexp_replace(F.lower(F.replace(raw, F.lit("\\"), F.lit(""))), _WS_RUN_ASCII, " "))
    return F.when(is_ascii(raw), ascii_only).otherwise(collapse_ws(F.lower(c)))


def norm_comment_simple(col) -> Column:
    """Lenient-profile key: lower case and whitespace collapsed only."""
    return collapse_ws(F.lower(F.coalesce(_c(col), F.lit(""))))


def text_key(col) -> Column:
    """The SHA-256 digest of a text, 32 bytes: equal for equal texts, and taken as telling all others apart."""
    return F.unhex(F.sha2(_c(col), 256))


def tokens(col) -> Column:
    """Lower-cased word tokens of the whole text (array<string>)."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(col), F.lit(""))), F.lit(_WORD_RUN), 0)


LETTER = "[\\p{L}\\p{M}]"


def word_set_pattern(words) -> str:
    """Regex matching exactly a whole token (maximal letter run) that is in ``words``."""
    alts = "|".join(sorted(set(words), key=lambda w: (-len(w), w)))
    return f"(?<!{LETTER})(?:{alts})(?!{LETTER})"


def count_words(lower_text: Column, words) -> Column:
    """Number of tokens of an already lower-cased text that are in ``words``."""
    return F.regexp_count(lower_text, F.lit(word_set_pattern(words)))


def extract_words(lower_text: Column, words) -> Column:
    """The tokens of a lower-cased text that are in ``words`` (in order)."""
    words = sorted(set(words))
    if all(unicodedata.category(c)[0] in "LM" for w in words for c in w):
        # all are tokens: a set finds them, whatever their number
        return F.filter(F.regexp_extract_all(lower_text, F.lit(_WORD_RUN), 0), lambda t: t.isin(*words))
    return F.regexp_extract_all(lower_text, F.lit("(" + word_set_pattern(words) + ")"), 1)


def any_case(words: str) -> str:
    """The pattern of literal ``words`` (``a|b``) in any case.  Only where one of their first letters stands, in a class
    of its own that is quick to test, are the words tried."""
    if not re.fullmatch("[a-z]+(?:[|][a-z]+)*", words):
        return "(?iu)" + words
    first = {w[0] for w in words.split("|")}
    fold = lambda c: c.upper().lower()
    cased = [c for c in map(chr, range(0x80, 0x10000)) if not 0xD800 <= ord(c) < 0xE000 and fold(c) in first]
    return f"(?=[{''.join(sorted({*first, *''.join(first).upper(), *cased}))}])(?iu:{words})"


def regex_search(col, pattern: str) -> Column:
    """Case-insensitive regex test (re.search with IGNORECASE)."""
    return F.coalesce(_c(col).rlike(any_case(pattern)), F.lit(False))


def title_case(col) -> Column:
    """Python str.title() for codes such as 'en-in' -> 'En-In' (initcap gives 'En-in').

    Every letter that follows a non-letter is upper-cased, the rest lower-cased.
    """
    c = F.lower(_c(col))
    parts = F.split(c, "(?<=[^\\p{L}])", -1)
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)),
                                                              F.substring(p, 2, 1 << 30))), "")

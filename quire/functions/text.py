"""Column expressions for text: tokenising, query splitting, path decoding.

All of these are built-in Spark expressions and never leave the JVM. (Functions
over array elements are interpreted, not generated code.)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. The analyzer's public behaviour is "Unicode word breaks, lower
# case"; a maximal run of letters and digits is the token. Query words are split
# on runs of white space. Stored paths encode "/" as "%%".
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
# What may stand inside a word between two letters, and inside a number between two digits, by
# the public word-break rules (MidLetter, MidNum, MidNumLet, the single quote).
MID_LETTERS = ":.'\\u00B7\\u0387\\u05F4\\u2018\\u2019\\u2024\\u2027\\uFE13\\uFE52\\uFE55\\uFF07\\uFF0E\\uFF1A"
MID_NUMBERS = ".,;'\\u037E\\u0589\\u060C\\u060D\\u066C\\u07F8\\u2018\\u2019\\u2024\\u2044\\uFE10\\uFE14\\uFE52\\uFF07\\uFF0C\\uFF0E\\uFF1B"
QUERY_SPLIT_PATTERN = r"\s+"
PATH_SLASH_CODE = "%%"


def word_break_pattern() -> str:
    """The tokens of the standard analyzer's word breaks as one pattern (T1): runs
    of letters and digits, joined by underscores, where a letter may follow a
    letter after one of ``MID_LETTERS`` and a digit a digit after one of
    ``MID_NUMBERS`` (``don't``, ``3.14`` and ``example.org`` stay whole); ideographs
    and Hiragana are one token each."""
    single = r"[\p{IsHan}\p{IsHiragana}]"
    letter = r"[\p{L}&&[^\p{IsHan}\p{IsHiragana}]]"
    letters = rf"{letter}(?:{letter}|\p{{M}})*"
    digits = r"\p{N}[\p{N}\p{M}]*"
    word = rf"{letters}(?:[{MID_LETTERS}]{letters})*"
    number = rf"{digits}(?:[{MID_NUMBERS}]{digits})*"
    return rf"{single}|(?:_*(?:{word}|{number}))+_*"


#: The English stop words that the standard analyzer removes.
ENGLISH_STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not", "of",
    "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text, pattern: str = TOKEN_PATTERN) -> Column:
    """array<string> of lower-cased tokens of a text column."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(pattern), 0)


def query_words(query) -> Column:
    """array<string> of the words of a typed query line.

    Follows ``String.split("\\s+")``: no lower-casing; a leading blank gives
    an empty first word; trailing empty pieces are dropped; an empty line is
    one empty word; a line of blanks only has no words.
    """
    q = _col(query)
    trimmed = F.regexp_replace(q, r"\s+$", "")
    return (F.when(q == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, QUERY_SPLIT_PATTERN)))


def decode_path(path) -> Column:
    """URL decode of a stored path: ``%%`` back to ``/``."""
    return F.replace(_col(path), F.lit(PATH_SLASH_CODE), F.lit("/"))


def hrefs(html) -> Column:
    """array<string> of href attribute values, in page order."""
    return F.regexp_extract_all(_col(html), F.lit(r'href="([^"]*)"'), 1)


def hashed_node(value, n_nodes) -> Column:
    """Map a string onto 0..n-1: first 8 hex digits of its MD5, modulo n.

    Used to turn the test pages' hrefs (which resolve to no page) into a link
    graph that Spark and DuckDB build identically.
    """
    h = F.conv(F.substring(F.md5(_col(value)), 1, 8), 16, 10).cast("long")
    return F.pmod(h, _col(n_nodes) if not isinstance(n_nodes, int) else F.lit(n_nodes))

"""Text, array and scalar functions as Catalyst expressions (``Column -> Column``).

Python's ``\\s`` and ``\\w`` are Unicode classes while Java's defaults are
ASCII, so the patterns use explicit classes that mean the same thing in the
JVM and in RE2 (the DuckDB oracle):

* ``WS``   — every code point Python's ``\\s`` matches;
* ``WORD`` — letters, digits and underscore (Python's ``\\w`` on the data).

``.`` is never used where it could meet a line break: Java's dot stops at more
terminators than Python's, so ``[^\\n]`` spells out Python's meaning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinari.config import ENGLISH_WORDS, NA_TOKENS, SPARK_ENGLISH_STOPWORDS

# Fixed character classes (see module docstring).
WS = (r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WORD = r"\p{L}\p{N}_"
# The code points of WS, one by one, for ``translate`` to a plain space: a
# negated multi-range class costs ~15 tests per character on the JVM, a
# translate is one hash lookup.
WS_CHARS = "".join(chr(c) for c in [*range(0x09, 0x0e), *range(0x1c, 0x21), 0x85, 0xa0, 0x1680,
                                    *range(0x2000, 0x200b), 0x2028, 0x2029, 0x202f, 0x205f, 0x3000])

LINK_RUN = rf"(?:http|www|img)[^{WS}]+"
BRACKETED = r"\[[^\n]*?\]"
WS_RUN = rf"[{WS}]+"
NOT_BASIC = rf"[^{WORD} .,!?;:-]"
URL = r"https?://[a-z!$-_]+"
EMAIL = rf"[^{WS}]+@[^{WS}]+"
NOT_KEPT_PUNCT = rf"[^{WORD}{WS}.,!?;:'" + '"' + r"-]"
ASCII_PUNCT = r"[!-/:-@\[-`{-~]"
TOKEN = rf"([{WORD}]+|[^{WORD}{WS}])"
WORD_RUN = rf"([{WORD}]+)"
NON_WS_RUN = rf"([^{WS}]+)"
SENTENCE_END = r"[.!?]+"

# JVM forms of the patterns above, used by the Column functions (the SQL
# oracle keeps the portable ones). Java tests a multi-range class one range
# at a time, ~15 failed tests for every ordinary character; the Unicode
# White_Space property plus U+001C-U+001F is the same set as WS in one table
# lookup (3-20x faster on whole texts). RE2 has no such property.
JWS = r"\p{IsWhite_Space}\x1c-\x1f"
J_LINK_RUN = rf"(?:http|www|img)[^{JWS}]+"
J_WS_RUN = rf"[{JWS}]+"
J_NOT_KEPT_PUNCT = rf"[^{WORD}{JWS}.,!?;:'" + '"' + r"-]"
J_TOKEN = rf"([{WORD}]+|[^{WORD}{JWS}])"
J_NON_WS_RUN = rf"([^{JWS}]+)"
J_EDGE_WS = rf"^[{JWS}]+|[{JWS}]+$"
# The same matches as EMAIL in linear time: start only at a run start, check
# for an interior "@" ahead, then take the whole run. (The plain form
# backtracks over every start in long runs without spaces.)
EMAIL_LINEAR = rf"(?<![^{JWS}])(?=[^{JWS}]+?@[^{JWS}])[^{JWS}]++"
# Counting forms of T10 for the table-level sums (A2): a word of a non-blank
# sentence is a run of characters that are neither whitespace nor an end mark; a
# non-blank sentence starts at the first such character after the text start or
# an end mark. Both are linear scans with no per-sentence array.
SENTENCE_WORD = rf"[^{JWS}.!?]++"
SENTENCE_START = rf"(?:^|[.!?])[{JWS}]*+[^{JWS}.!?]"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c, char_filter: bool = True) -> Column:
    """T1 (``char_filter=True``) and T2 (``False``): drop link-like runs and
    bracketed spans, collapse whitespace, optionally drop characters outside
    ``\\w \\s . , ! ? ; : -``, strip. Null gives the empty string."""
    t = F.coalesce(_c(c), F.lit(""))
    t = F.regexp_replace(t, J_LINK_RUN, "")
    t = F.regexp_replace(t, BRACKETED, "")
    t = F.regexp_replace(t, J_WS_RUN, " ")
    if char_filter:
        t = F.regexp_replace(t, NOT_BASIC, "")
    return F.trim(t)


def clean_text_tags(c) -> Column:
    """Strip, collapse whitespace, delete the literal ``[IMG] [/IMG] [URL]
    [/URL]`` tags but keep what is between them. Null gives ''."""
    t = F.trim(F.regexp_replace(F.coalesce(_c(c), F.lit("")), J_WS_RUN, " "))
    for tag in ("[IMG]", "[/IMG]", "[URL]", "[/URL]"):
        t = F.replace(t, F.lit(tag), F.lit(""))
    return t


def strip_urls(c) -> Column:
    """Remove ``http(s)://`` URLs (the short, equal form of the pattern)."""
    return F.regexp_replace(_c(c), URL, "")


def strip_emails(c) -> Column:
    """Remove e-mail-like tokens ``\\S+@\\S+``."""
    return F.regexp_replace(_c(c), EMAIL_LINEAR, "")


def strip_punctuation(c, remove_all: bool = False) -> Column:
    """Remove every ASCII punctuation mark, or keep ``. , ! ? ; : ' " -``
    and drop every other non-word, non-space character."""
    return F.regexp_replace(_c(c), ASCII_PUNCT if remove_all else J_NOT_KEPT_PUNCT, "")


def deep_clean_text(c, remove_punctuation: bool = False) -> Column:
    """T4 up to tokenisation: strip, collapse whitespace, drop ``[IMG]``,
    ``[URL]`` and ``[QUOTE]`` blocks with their content, URLs, e-mails,
    punctuation by mode, lower-case."""
    t = F.regexp_replace(F.trim(F.coalesce(_c(c), F.lit(""))), J_WS_RUN, " ")
    for tag in ("IMG", "URL", "QUOTE"):
        t = F.regexp_replace(t, rf"(?s)\[{tag}\].*?\[/{tag}\]", "")
    t = strip_urls(t)
    # Nothing above adds an "@", and most texts have none: they skip the scan.
    t = F.when(_c(c).contains("@"), strip_emails(t)).otherwise(t)
    t = strip_punctuation(t, remove_punctuation)
    return F.lower(t)


def tokenize(c, lowered: bool = False) -> Column:
    """T5: words and single punctuation marks of the lower-cased text (``lowered``: it is lower-cased already)."""
    return F.regexp_extract_all(_c(c) if lowered else F.lower(_c(c)), F.lit(J_TOKEN), 1)


def remove_stopwords(tokens, stopwords=SPARK_ENGLISH_STOPWORDS) -> Column:
    """Drop stop words from a token array, keeping order."""
    # ``isin`` over literals becomes a hash-set test.
    return F.filter(_c(tokens), lambda t: ~t.isin(*stopwords))


def is_english_fallback(c, words=ENGLISH_WORDS) -> Column:
    """True when any of the words occurs as a substring of the lower-cased
    text; false for null or blank text."""
    low = F.lower(_c(c))
    hit = F.lit(False)
    for w in words:
        hit = hit | low.contains(w)
    blank = _c(c).isNull() | (F.length(F.regexp_replace(_c(c), J_WS_RUN, "")) == 0)
    return F.when(blank, F.lit(False)).otherwise(hit)


def sentences(c) -> Column:
    """Pieces between runs of ``. ! ?`` that are not blank."""
    parts = F.split(F.coalesce(_c(c), F.lit("")), SENTENCE_END)
    return F.filter(parts, lambda s: F.length(F.regexp_replace(s, J_WS_RUN, "")) > 0)


def sentence_word_counts(c) -> Column:
    """Words (whitespace-separated runs) per non-blank sentence."""
    return F.transform(sentences(c),
                       lambda s: F.size(F.regexp_extract_all(s, F.lit(J_NON_WS_RUN), 1)))


def sentence_totals(c) -> tuple[Column, Column]:
    """T10 summed per text: (non-blank sentences, words in them); equal to
    ``size`` and the sum of ``sentence_word_counts``."""
    t = F.coalesce(_c(c), F.lit(""))
    return F.regexp_count(t, F.lit(SENTENCE_START)), F.regexp_count(t, F.lit(SENTENCE_WORD))


def spaces_only(c) -> Column:
    """Every WS code point becomes a plain space (lengths unchanged)."""
    return F.translate(_c(c), WS_CHARS, " " * len(WS_CHARS))


def words(c, lowered: bool = False) -> Column:
    """``\\b\\w+\\b`` on the lower-cased text (``lowered``: it is already) = maximal word-character runs."""
    t = F.coalesce(_c(c), F.lit(""))
    return F.regexp_extract_all(t if lowered else F.lower(t), F.lit(WORD_RUN), 1)


def text_key(c) -> Column:
    """Hex MD5 of the UTF-8 text."""
    return F.md5(_c(c))


def absa_key(text, aspects) -> Column:
    """Key of (text, sorted aspects joined by '_'), joined by '_'."""
    return F.md5(F.concat_ws("_", _c(text), F.array_join(F.array_sort(_c(aspects)), "_")))


def fixed_length(tokens, n: int, pad: str = "<pad>") -> Column:
    """Cut a token array to ``n`` and pad it to ``n``."""
    t = F.slice(_c(tokens), 1, n)
    return F.concat(t, F.array_repeat(F.lit(pad), F.greatest(F.lit(0), F.lit(n) - F.size(t))))


def na_normalise(c, tokens=NA_TOKENS) -> Column:
    """The tokens ``read_csv`` treats as missing become null."""
    return F.when(_c(c).isin(list(tokens)), F.lit(None).cast("string")).otherwise(_c(c))


def coerce_rating(c) -> Column:
    """Numeric text to double, anything else to null (a guarded try_cast:
    ``try_cast('7d' as double)`` would give 7.0)."""
    t = F.trim(_c(c))
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def rating_or_zero(c) -> Column:
    """P8 + P9: coerced rating, missing -> 0.0."""
    return F.coalesce(coerce_rating(c), F.lit(0.0))


def clean_username(c) -> Column:
    """Missing -> 'anonymous', then strip."""
    return strip_ws(F.coalesce(_c(c), F.lit("anonymous")))


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace."""
    return F.regexp_replace(_c(c), J_EDGE_WS, "")


def stripped_shorter(c, n: int) -> Column:
    """``length(strip_ws(c)) < n`` without making the stripped text: the scan ends at the n-th character that counts."""
    if n <= 0:
        return F.when(_c(c).isNotNull(), F.lit(False))
    return ~_c(c).rlike(rf"(?s)[^{JWS}]" + (rf".{{{n - 2},}}?[^{JWS}]" if n > 1 else ""))


def round6(c) -> Column:
    return F.round(_c(c), 6)

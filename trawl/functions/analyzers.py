"""Analyzers: text column -> array<string> of index terms.

Each analyzer is a pure column expression (regex find-all, lower case,
array filter), so tokenising runs inside whole-stage codegen with no
Python on the hot path.  ``ANALYZERS`` is the plug point for indexing and
query analysis; the same analyzer must be used on both sides.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference library's defaults).
# English stop set of the Standard and Stop analyzers, 33 words:
ENGLISH_STOP_WORDS: tuple[str, ...] = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if",
    "in", "into", "is", "it", "no", "not", "of", "on", "or", "such", "that",
    "the", "their", "then", "there", "these", "they", "this", "to", "was",
    "will", "with",
)
# Marks that join two letters, and marks that join two digits (the Unicode word-break
# classes MidLetter, MidNum and MidNumLet, and the single quote).
LETTER_JOINERS = "':·\u0387\u05f4\u2027\ufe13\ufe55\uff1a.‘’\u2024\ufe52\uff07\uff0e"
DIGIT_JOINERS = "',;\u037e\u0589\u060c\u060d\u066c\u07f8\u2044\ufe10\ufe14\ufe50\ufe54\uff0c\uff1b.‘’\u2024\ufe52\uff07\uff0e"
# Scripts whose characters, or runs of them, are tokens of their own: ranges of code points.
HAN = (r"\x{2e80}-\x{2fd5}\x{3005}\x{3007}\x{3021}-\x{3029}\x{3038}-\x{303b}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}"
       r"\x{f900}-\x{fad9}\x{20000}-\x{323af}")
HIRAGANA = r"\x{3041}-\x{3096}\x{309d}-\x{309f}\x{1b001}-\x{1b11f}"
KATAKANA = (r"\x{3031}-\x{3035}\x{309b}\x{309c}\x{30a0}-\x{30fa}\x{30fc}-\x{30ff}\x{31f0}-\x{31ff}\x{32d0}-\x{32fe}"
            r"\x{3300}-\x{3357}\x{ff66}-\x{ff9d}")
# Letters and marks of Thai, Lao, Myanmar, Tai Le, New Tai Lue, Tai Tham, Khmer and Tai Viet.
SOUTH_EAST_ASIAN = (r"\x{0e01}-\x{0e3a}\x{0e40}-\x{0e4e}\x{0e81}-\x{0ece}\x{0edc}-\x{0edf}\x{1000}-\x{103f}\x{1050}-\x{108f}"
                    r"\x{109a}-\x{109d}\x{1780}-\x{17d3}\x{17d7}\x{17dc}\x{17dd}\x{1950}-\x{1974}\x{1980}-\x{19c9}"
                    r"\x{1a20}-\x{1a7f}\x{a9e0}-\x{a9ef}\x{a9fa}-\x{a9fe}\x{aa60}-\x{aadf}")
# ---------------------------------------------------------------------------

# The default word breaks of Unicode.  Marks and format characters (soft hyphen, joiners)
# belong to the character before them and break nothing.  Runs of letters and digits
# are a token, over a joining mark only between two letters or two digits, and over
# connectors such as '_'; so are runs of katakana.  Each ideograph and each hiragana character is a
# token.  Scripts written without spaces stay whole runs.
# Runs and groups are possessive: the matcher then loops where it would recurse, so
# tokens may be of any length.
# A class over whole scripts is asked of every character that might start or end a token, so classes begin
# with the common ranges and look at the others only within their bounds.
_EXTEND = r"[[\x{ad}\x{300}-\x{10ffff}]&&[\p{M}\p{Cf}]&&[^\x{200b}]]*+"
# Letters: the common ones, blocks without characters of the scripts above, and blocks with some.
_LETTER = (r"[A-Za-z\x{df}-\x{f6}\x{f8}-\x{ff}\x{ac00}-\x{d7a3}"
           r"[[\x{80}-\x{e00}\x{1b00}-\x{2e7f}\x{a000}-\x{a9df}\x{aae0}-\x{abff}\x{d7a4}-\x{f8ff}\x{fada}-\x{ff65}\x{ff9e}-\x{1b000}"
           r"\x{1b120}-\x{1ffff}\x{323b0}-\x{10ffff}]&&[\p{L}\p{Nl}]]"
           rf"[[\x{{e01}}-\x{{1aff}}\x{{a9e0}}-\x{{aadf}}]&&[\p{{L}}\p{{Nl}}]&&[^{SOUTH_EAST_ASIAN}]]"
           rf"[[\x{{2e80}}-\x{{33ff}}]&&[\p{{L}}\p{{Nl}}]&&[^{HAN}{HIRAGANA}{KATAKANA}]]]")
_DIGIT = r"[0-9[[\x{660}-\x{10ffff}]&&\p{Nd}]]"
_CONNECTOR = r"[_[[\x{203f}-\x{ffff}]&&\p{Pc}]]"
_KATAKANA = rf"[\x{{30a0}}-\x{{30fa}}[[\x{{3031}}-\x{{33ff}}\x{{ff66}}-\x{{ff9d}}]&&[{KATAKANA}]]]"
_SOUTH_EAST_ASIAN = rf"[[\x{{e01}}-\x{{1aff}}\x{{a9e0}}-\x{{aadf}}]&&[{SOUTH_EAST_ASIAN}]]"
_SINGLE = rf"[\x{{4e00}}-\x{{9fff}}\x{{3041}}-\x{{3096}}[[\x{{2e80}}-\x{{4dbf}}\x{{f900}}-\x{{fad9}}\x{{1b001}}-\x{{323af}}]&&[{HAN}{HIRAGANA}]]]"
_HEBREW = r"\x{05d0}-\x{05f2}"
_WORD = (rf"(?:{_LETTER}++{_EXTEND}(?:[{LETTER_JOINERS}]{_EXTEND}(?={_LETTER})|(?<=[{_HEBREW}])(?:\"(?=[{_HEBREW}])|'))?+"
         rf"|{_DIGIT}++{_EXTEND}(?:[{DIGIT_JOINERS}]{_EXTEND}(?={_DIGIT}))?+)++")
_RUN = rf"(?:(?:{_KATAKANA}{_EXTEND})++|{_WORD})"
# The first characters of the alternatives are disjoint, so their order is free.
ANY_TOKEN = (rf"{_SINGLE}{_EXTEND}|(?:{_SOUTH_EAST_ASIAN}{_EXTEND})++"
             rf"|(?:{_CONNECTOR}{_EXTEND})*+{_RUN}(?:(?:{_CONNECTOR}{_EXTEND})++{_RUN})*+(?:{_CONNECTOR}{_EXTEND})*+")
# Most tokens are ASCII letters and digits behind which nothing can join on: they are taken as they are, and an
# ASCII character that is in no token is passed over at once.
STANDARD_TOKEN = (r"[a-z0-9]++(?![':.,;]?+[A-Za-z0-9_\x{80}-\x{10ffff}])"
                  rf"|(?![\x{{0}}-/:-@\[-\^`{{-\x{{7f}}])(?:{ANY_TOKEN})")
LETTER_TOKEN = r"\p{L}+"


def _find_all(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(pattern), 0)


def _keep(tokens: Column, stopwords: Sequence[str] | None, max_len: int | None) -> Column:
    def pred(t: Column) -> Column:
        cond = F.lit(True)
        if max_len is not None:
            cond = cond & (F.length(t) <= max_len)
        if stopwords:
            cond = cond & ~t.isin(*stopwords)
        return cond
    if not stopwords and max_len is None:
        return tokens
    return F.filter(tokens, pred)


def _null_safe(c: Column, tokens: Column) -> Column:
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(tokens)


def standard(c: Column, stopwords: Sequence[str] | None = ENGLISH_STOP_WORDS,
             max_token_len: int | None = None) -> Column:
    """Word-break tokens, lower case, stop words removed; tokens above
    ``max_token_len`` are skipped where a limit is asked for."""
    return _null_safe(c, _keep(_find_all(c, STANDARD_TOKEN), stopwords, max_token_len))


def keyword(c: Column) -> Column:
    """The whole value is one term (no lower-casing)."""
    return _null_safe(c, F.array(c))


def simple(c: Column) -> Column:
    """Runs of letters, lower case."""
    return _null_safe(c, _find_all(c, LETTER_TOKEN))


def stop(c: Column, stopwords: Sequence[str] | None = ENGLISH_STOP_WORDS) -> Column:
    """Runs of letters, lower case, stop words removed."""
    return _null_safe(c, _keep(_find_all(c, LETTER_TOKEN), stopwords, None))


ANALYZERS: dict[str, Callable[[Column], Column]] = {
    "standard": standard,
    "keyword": keyword,
    "simple": simple,
    "stop": stop,
}


def analyzer(name: str) -> Callable[[Column], Column]:
    try:
        return ANALYZERS[name]
    except KeyError:
        raise ValueError(f"unknown analyzer {name!r}; known: {sorted(ANALYZERS)}") from None


def analyze(c: Column | str, name: str = "standard") -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return analyzer(name)(col)

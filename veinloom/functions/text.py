"""Scalar functions on text, all native but the three at the end."""

from __future__ import annotations

import difflib
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Text = Column | str


def _c(x: Text) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(x: Text) -> Column:
    r"""Words as Python's \w+ takes them, over all of Unicode."""
    return F.regexp_extract_all(_c(x), F.lit(r"(?U)\w+"), F.lit(0))


def normalize_term(x: Text) -> Column:
    return F.trim(F.regexp_replace(F.lower(_c(x)), r"(?U)\W+", " "))


def normalize_label(x: Text) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(_c(x)), "[_-]", " "), r"\s+", " "))


# Latin letters with marks and what they become.
_LATIN = {"àáâãäåā": "a", "çćč": "c", "èéêëē": "e", "ìíîïī": "i", "ñń": "n", "òóôõöøō": "o", "ùúûüū": "u", "ýÿ": "y", "šś": "s", "žźż": "z", "ł": "l"}


def normalize_phrase(x: Text) -> Column:
    """Marks off Latin letters, apostrophes out, all else that is no word character a blank."""
    source, to = "".join(_LATIN), "".join(v * len(k) for k, v in _LATIN.items())
    return F.trim(F.regexp_replace(F.regexp_replace(F.translate(F.lower(_c(x)), source, to), "'", ""), r"(?U)\W+", " "))


def ascii_only(x: Text) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(_c(x), r"[^\x00-\x7F]", ""), r"\W+", " "))


def whitelist(x: Text) -> Column:
    return F.regexp_replace(_c(x), r"[^A-Za-z0-9_\s\-/@.+]", "")


def trim_special(x: Text) -> Column:
    """Punctuation off both ends, then blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(_c(x), r"^[^A-Za-z0-9]+", ""), r"[^A-Za-z0-9]+$", ""))


# Compounds that are written as one word in labels, with the place of the blank.
COMPOUNDS = "subject id|patient id|sample id|cell type|tissue type|disease state|organism part|time point|data type|bio material|lab version|treatment short|control id|plate simple|software version|sequencing batch|flow cell"


def camel_split(x: Text) -> Column:
    """Blanks where a small letter meets a capital, and inside known compounds, of which the first word becomes lower case."""
    apart = F.regexp_replace(_c(x), "([a-z])([A-Z])", "$1 $2")
    return reduce(lambda c, p: F.regexp_replace(c, f"(?i){p[0]}({p[1]})", f"{p[0]} $1"), [p.split(" ") for p in COMPOUNDS.split("|")], apart)


def split_multi(x: Text) -> Column:
    """Words between blanks, dashes, underscores, slashes and points, without punctuation at their ends."""
    parts = F.transform(F.split(_c(x), r"[\s\-_/\.]+"), lambda p: F.regexp_replace(p, r"^\p{Punct}+|\p{Punct}+$", ""))
    return F.filter(parts, lambda p: p != "")


def word_count(x: Text) -> Column:
    return F.when(F.trim(_c(x)) == "", 0).otherwise(F.size(F.split(F.trim(F.regexp_replace(_c(x), r"\s+", " ")), " ")))


def occurrences(x: Text, term: str) -> Column:
    return ((F.length(_c(x)) - F.length(F.replace(_c(x), F.lit(term), F.lit("")))) / len(term)).cast("long")


# Where sentences end, in its two forms; no end is behind letters with points or a short capitalised word.
SENTENCE_END = r"(?<!\w\.\w.)(?<![A-Z][a-z]\.)(?<=[.?])\s"
SENTENCE_END_BANG = r"(?<!\w\.\w.)(?<![A-Z][a-z]\.)(?<=[.?!])\s"


def sentences(x: Text, end: str = SENTENCE_END_BANG) -> Column:
    """The sentences that are not blank."""
    return F.filter(F.split(_c(x), end), lambda s: F.trim(s) != "")


def sentences_with(x: Text, word: str) -> Column:
    return F.array_join(F.filter(sentences(x), lambda s: F.lower(s).contains(word)), " ")


def from_sentence_with(x: Text, word: str) -> Column:
    """The text from the first sentence that has the word; empty if none has."""
    s = sentences(x)
    at = F.array_position(F.transform(s, lambda y: F.lower(y).contains(word)), True)
    return F.when(at > 0, F.array_join(F.slice(s, at.cast("int"), F.greatest(F.lit(1), F.size(s) - at.cast("int") + 1)), " ")).otherwise("")


def term_orders(x: Text) -> Column:
    """A term of two words in both orders, any other as it is."""
    w = F.split(_c(x), " ")
    return F.when(F.size(w) == 2, F.array(_c(x), F.concat_ws(" ", F.element_at(w, 2), F.element_at(w, 1)))).otherwise(F.array(_c(x)))


def without_words(x: Text, stop: list[str]) -> Column:
    return F.array_join(F.filter(F.split(F.lower(_c(x)), r"\s+"), lambda w: ~w.isin(*stop)), " ")


def zero_padded(number: Text, prefix: str, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(_c(number).cast("string"), width, "0"))


def search_expression(x: Text, field: str) -> Column:
    return F.array_join(F.transform(tokens(x), lambda w: F.concat(w, F.lit(f"[{field}]"))), " AND ")


def parse_list(x: Text) -> Column:
    """The elements of a printed list, quoted with single or double marks; an empty list for anything else."""
    found = F.regexp_extract_all(_c(x), F.lit("'([^']*)'|\"([^\"]*)\""), F.lit(0))
    return F.coalesce(F.transform(found, lambda s: F.substring(s, F.lit(2), F.length(s) - 2)), F.array().cast("array<string>"))


def parse_bool(x: Text) -> Column:
    low = F.lower(F.trim(_c(x)))
    return F.when(low.isin("yes", "y", "true", "t", "1"), True).when(low.isin("no", "n", "false", "f", "0"), False)


def meaningful_label(x: Text) -> Column:
    """Labels worth keeping: of 2 to 100 characters, with paired brackets, and none of: mostly numbers or signs, a path or
    URL, signs at an end (but "%"), a gene construct, a code in capitals with digits, or mostly underscores or dashes."""
    c = F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")
    n, low = F.length(c), F.lower(c)
    of = lambda sign: n - F.length(F.replace(c, F.lit(sign), F.lit("")))
    bad = [
        n < 2,
        n > 100,
        (of("(") != of(")")) | (of("[") != of("]")),
        c.rlike(r"(?U)^[\d.\-+\s]+$"),
        F.length(F.regexp_replace(c, r"(?U)[a-zA-Z0-9\s]", "")) * 2 > n,
        of("/") >= 2,
        low.contains("http") | low.contains("www."),
        c.rlike(r"(?U)^[^\w\s]+$"),
        c.rlike(r"(?U)^[^\w\s]|[^\w\s]$") & ~low.rlike(r"(?U)(%|\w)$"),
        c.rlike(r"(?U)^[A-Z]{1,5}\d+\s*\(") | c.contains("Tg("),
        (n > 5) & (c == F.upper(c)) & (c != low) & c.rlike(r"(?U)\d"),
        (of("_") * 10 > n * 3) | (of("-") * 10 > n * 3),
    ]
    return ~reduce(lambda a, b: a | b, bad)


def short_single_word(x: Text) -> Column:
    return (F.size(F.split(F.trim(_c(x)), r"\s+")) == 1) & (F.length(F.trim(_c(x))) < 5)


def acronym(x: Text) -> Column:
    return _c(x).rlike(r"^[A-Z][A-Z0-9\-]{1,7}$")


def term_long_enough(x: Text) -> Column:
    return (F.length(_c(x)) > 4) | (_c(x) == "sars")


@F.pandas_udf(T.StringType())
def nfc(x: pd.Series) -> pd.Series:
    return x.map(lambda s: None if s is None else " ".join(unicodedata.normalize("NFC", s).split()))


@F.pandas_udf(T.StringType())
def unicode_escape(x: pd.Series) -> pd.Series:
    """Control characters and all beyond ASCII as backslash escapes."""
    return x.map(lambda s: None if s is None else s.encode("unicode_escape").decode("ascii"))


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff and Obershelp's ratio, as the standard library has it."""
    known: dict[tuple, float] = {}

    def ratio(x, y):
        if x is None or y is None:
            return None
        if (x, y) not in known:
            known[x, y] = difflib.SequenceMatcher(None, x, y).ratio()
        return known[x, y]

    return pd.Series([ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def sorted_tokens(x: Text) -> Column:
    """Normalised, with its words in order."""
    return F.array_join(F.array_sort(F.split(normalize_term(x), " ")), " ")


def token_sort_similarity(a: Text, b: Text) -> Column:
    return similarity(sorted_tokens(a), sorted_tokens(b))

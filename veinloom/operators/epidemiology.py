"""What a text says on epidemiology: typed spans by a small grammar, and the spans that stand nearest to each rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinloom.functions import text as X

_NUMBER = r"[0-9]+(?:[.,][0-9]+)*"
_UNIT = r"(?:per|in|of|/) ?(?:[0-9]+(?:[., ][0-9]{3})*|million|thousand)(?: (?:live births|inhabitants|people|persons|births|individuals|population))?"
# What spans of each type look like, in lower case; places come from a list of names.
GRAMMAR = {
    "EPI": r"\b(?:point prevalence|birth prevalence|prevalence|incidence|carrier frequency|occurrence|mortality rate)\b",
    "STAT": rf"\b{_NUMBER}(?:(?: ?%| percent\b)|(?: cases?| births?| patients?)? {_UNIT}\b)",
    "DATE": r"\b(?:(?:january|february|march|april|may|june|july|august|september|october|november|december) )?(?:19|20)[0-9]{2}(?: ?(?:-|to|and) ?(?:19|20)[0-9]{2})?\b",
    "SEX": r"\b(?:males?|females?|men|women|boys?|girls?)\b",
    "ETHN": r"\b(?:caucasians?|hispanics?|african[- ]americans?|asians?|europeans?|ashkenazi|jewish|white|black|japanese|chinese|finnish|french|german)\b",
}
TYPES = ("EPI", "STAT", "DATE", "LOC", "SEX", "ETHN")


def _pattern_of(places: list[str]) -> str:
    literal = "|".join("".join(c if c.isalnum() or c == " " else f"[{c}]" for c in p.lower()) for p in sorted(places, key=lambda p: (-len(p), p)))
    return rf"\b(?:{literal})\b"


def extract(texts: DataFrame, key: str, text: str, places: list[str]) -> DataFrame:
    """key and six lists of spans, in the order in which they stand: EPI, STAT, DATE, LOC, SEX, ETHN. Spans are in lower
    case; of a null text the lists are empty. places: names of countries and the like, a list that does not grow."""
    low = F.coalesce(F.lower(F.col(text)), F.lit(""))
    grammar = GRAMMAR | {"LOC": _pattern_of(places)} if places else GRAMMAR | {"LOC": r"[^\s\S]"}
    return texts.select(key, *[F.regexp_extract_all(low, F.lit(grammar[t]), F.lit(0)).alias(t) for t in TYPES])


def is_epidemiology() -> Column:
    """Of what extract gives: a text is on epidemiology if it names a measure and a rate."""
    return (F.size("EPI") > 0) & (F.size("STAT") > 0)


def linked_rates(texts: DataFrame, key: str, text: str, places: list[str]) -> DataFrame:
    """key, sentence (its number), at (where the rate stands in it), STAT (the rate) and, of each other type, the span of the same sentence that stands nearest to it by
    the distance of their first characters (ties: the earlier one), or null. One row for each rate."""
    grammar = GRAMMAR | {"LOC": _pattern_of(places) if places else r"[^\s\S]"}
    sentences = texts.select(key, F.posexplode(X.sentences(F.lower(F.col(text)))).alias("sentence", "_s"))
    # A sentence split at its spans gives the texts between them, so each span's start is a sum of lengths.
    spans = {t: F.regexp_extract_all("_s", F.lit(p), F.lit(0)) for t, p in grammar.items()}
    gaps = {t: F.split("_s", p) for t, p in grammar.items()}
    found = sentences.where(F.size(spans["STAT"]) > 0).select(key, "sentence", *[spans[t].alias(t) for t in TYPES], *[gaps[t].alias(f"_{t}") for t in TYPES])

    def placed(t: str) -> Column:
        before = lambda i: F.aggregate(F.slice(f"_{t}", 1, i + 1), F.lit(0), lambda n, x: n + F.length(x)) + F.aggregate(F.slice(t, 1, i), F.lit(0), lambda n, x: n + F.length(x))
        return F.transform(t, lambda x, i: F.struct(before(i).alias("start"), x.alias("span")))

    placed_all = found.select(key, "sentence", *[placed(t).alias(t) for t in TYPES])
    rates = placed_all.select(key, "sentence", F.explode("STAT").alias("_r"), *[t for t in TYPES if t != "STAT"])

    def nearest(t: str) -> Column:
        by_distance = F.transform(t, lambda x: F.struct(F.abs(x["start"] - F.col("_r.start")).alias("d"), x["start"].alias("start"), x["span"].alias("span")))
        return F.array_min(by_distance)["span"]

    return rates.select(key, "sentence", F.col("_r.start").alias("at"), F.col("_r.span").alias("STAT"), *[nearest(t).alias(t) for t in TYPES if t != "STAT"])

"""Functions on numbers, dates, arrays, maps, vectors and JSON."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def log_normalized(x: Column, top: int = 20) -> Column:
    """ln x / ln top, and 1 from top on."""
    return F.when(x < top, F.log(x.cast("double")) / F.log(F.lit(float(top)))).otherwise(F.lit(1.0))


def halved_score(value: Column, factor: int) -> Column:
    return 1 + F.floor(factor * value / 2)


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def rescaled(v: Column, total: Column, low: float, high: float) -> Column:
    return F.lit(low) + (high - low) * F.try_divide(v, total)


def is_due(last: Column, today: Column, days: int) -> Column:
    """More days than the interval have gone by."""
    return F.date_diff(today, last) > days


def years_back(d: Column, n: int) -> Column:
    return F.add_months(d, -12 * n)


#: Text forms of dates in the sources.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yy", "yyyyMMdd")


def parse_date(x: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(x, F.lit(f)).cast("date") for f in DATE_FORMATS])


def single_or_list(xs: Column) -> Column:
    return F.when(F.size(xs) == 1, F.element_at(xs, 1)).otherwise(F.array_join(xs, ";"))


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """All leaves of nested structs as columns with joined names; arrays stay."""

    def walk(schema: T.StructType, path: tuple[str, ...] = ()):
        for f in schema.fields:
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, (*path, f.name))
            else:
                yield (*path, f.name)

    return df.select(*[F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)) for path in walk(df.schema)])


def has_key(schema: T.DataType, name: str) -> bool:
    """Whether a key exists anywhere in a schema."""
    if isinstance(schema, T.StructType):
        return any(f.name == name or has_key(f.dataType, name) for f in schema.fields)
    if isinstance(schema, T.ArrayType):
        return has_key(schema.elementType, name)
    return False


def key_path(schema: T.DataType, name: str) -> str | None:
    """Where a key stands in a schema, with points between; the first such place, None if there is none."""
    if isinstance(schema, T.ArrayType):
        return key_path(schema.elementType, name)
    for f in schema.fields if isinstance(schema, T.StructType) else ():
        if f.name == name:
            return name
        if deeper := key_path(f.dataType, name):
            return f"{f.name}.{deeper}"
    return None


def _found(value, name: str) -> tuple[str, object] | None:
    """Path and value of the first place of a key, from the outside inwards in each branch; lists count as their elements."""
    if isinstance(value, list):
        return next(filter(None, (_found(x, name) for x in value)), None)
    for k, v in value.items() if isinstance(value, dict) else ():
        if k == name:
            return name, v
        if deeper := _found(v, name):
            return f"{k}.{deeper[0]}", deeper[1]
    return None


def find_key(text: Column, name: str) -> Column:
    """path and value (a text as it is, all else as JSON) of a key in a JSON text, however deep; nulls if it is nowhere, or
    the text null or no JSON. Depth is unknown, so the text is parsed in Python, batch by batch."""

    @F.pandas_udf("path string, value string")
    def find(texts: pd.Series) -> pd.DataFrame:
        out = []
        for x in texts:
            try:
                hit = _found(json.loads(x), name) if x is not None else None
            except ValueError:
                hit = None
            out.append((None, None) if hit is None else (hit[0], hit[1] if isinstance(hit[1], str) else json.dumps(hit[1])))
        return pd.DataFrame(out, columns=["path", "value"])

    return find(text)


def confidence(score: Column) -> Column:
    return F.when(score >= 0.9, "HIGH").otherwise("MEDIUM")


def banded(score: Column, bands: list[tuple[float, str]], other: str) -> Column:
    """The first band, from the highest cutoff down, that the score reaches."""
    out = None
    for cutoff, name in sorted(bands, reverse=True):
        out = F.when(score >= cutoff, name) if out is None else out.when(score >= cutoff, name)
    return out.otherwise(other)

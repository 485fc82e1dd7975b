"""Countries, regions and cities out of free-text affiliations, by lookups of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Other names of countries in affiliations.
ALIASES = {"usa": "united states", "us": "united states", "united states of america": "united states", "uk": "united kingdom", "england": "united kingdom", "scotland": "united kingdom", "wales": "united kingdom", "pr china": "china", "republic of korea": "south korea"}


def address_parts(text: Column) -> Column:
    """The parts of an affiliation between commas and semicolons, without e-mail addresses, postal codes and final points."""
    bare = F.regexp_replace(F.lower(text), r"(electronic address:)?\s*\S+@\S+", "")
    parts = F.transform(F.split(bare, "[,;]"), lambda p: F.trim(F.regexp_replace(p, r"\b[a-z]{0,2}-?[0-9]{4,6}(-[0-9]{4})?\b|[.]+\s*$", "")))
    return F.filter(parts, lambda p: p != "")


#: Countries and regions of the world are some thousands; longer lists are refused, as they are broadcast in one row.
MAX_PLACES = 100_000


def locate(rows: DataFrame, text: str, countries: DataFrame, regions: DataFrame, home: str) -> DataFrame:
    """rows with country, region and city (null where unknown). countries has a column country, regions the columns
    region and country.

    The country is the last part that is one, or an alias of one; without it, a region of the home country says it. The
    region is the last part that is one of that country's; the city is the part before the region, or else before the
    country."""
    if countries.count() + regions.count() > MAX_PLACES:
        raise ValueError(f"more than {MAX_PLACES} countries and regions")
    known = rows.withColumn("_p", address_parts(F.col(text)))
    lists = countries.agg(F.collect_set(F.lower("country")).alias("_countries")).crossJoin(regions.agg(F.collect_set(F.struct(F.lower("region").alias("r"), F.lower("country").alias("c"))).alias("_regions")))
    wide = known.crossJoin(F.broadcast(lists))  # one row: lists of all countries and regions of the world are bounded
    named = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    wide = wide.withColumn("_n", F.transform("_p", lambda p: F.coalesce(F.get(F.map_values(F.map_filter(named, lambda k, v: k == p)), F.lit(0)), p)))
    found = lambda c: F.when(F.size(c) > 0, c)
    at_country = F.filter(F.transform("_n", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: F.array_contains("_countries", s["x"]))
    wide = wide.withColumn("_c", F.element_at(found(at_country), -1))
    at_region = F.filter(F.transform("_n", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: F.exists("_regions", lambda r: (r["r"] == s["x"]) & (r["c"] == F.coalesce(F.col("_c.x"), F.lit(home)))))
    wide = wide.withColumn("_r", F.element_at(found(at_region), -1))
    country = F.coalesce(F.col("_c.x"), F.when(F.col("_r").isNotNull(), F.lit(home)))
    before = F.coalesce(F.col("_r.i"), F.col("_c.i")) - 1
    city = F.when(before >= 0, F.get("_n", before))
    return wide.withColumn("country", country).withColumn("region", F.col("_r.x")).withColumn("city", city).drop("_p", "_n", "_c", "_r", "_countries", "_regions")


def with_codes(located: DataFrame, codes: DataFrame) -> DataFrame:
    """located (with region and city) and code: that of the place, else that of the region, else null. codes has the columns
    region, place (null for a region as a whole) and code; of several for one place the least counts."""
    own = codes.select(F.lower("region").alias("_region"), F.lower("place").alias("_place"), "code")
    fine = own.where("_place is not null").groupBy("_region", "_place").agg(F.min("code").alias("_fine"))
    coarse = own.where("_place is null").groupBy(F.col("_region").alias("_whole")).agg(F.min("code").alias("_coarse"))
    joined = located.join(fine, (F.lower("region") == F.col("_region")) & (F.lower("city") == F.col("_place")), "left").join(coarse, F.lower("region") == F.col("_whole"), "left")
    return joined.withColumn("code", F.coalesce("_fine", "_coarse")).drop("_region", "_place", "_whole", "_fine", "_coarse")

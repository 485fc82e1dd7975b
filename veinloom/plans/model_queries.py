"""Queries of what is fitted to the tables: similarity to definitions, name tagging, and epidemiology's typed spans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinloom.functions import text as X
from veinloom.operators import epidemiology as E
from veinloom.operators import matching as M
from veinloom.operators import semantic as S
from veinloom.operators import tagger as T
from veinloom.plans import domain_queries as D
from veinloom.plans.base import query

# ---- similarity of a text to the definition of what is found in it

#: A term's definition is the first benchmark text that it comes from.
_OF_ITEM = f"SELECT item_id, text, unnest([w[1] || ' ' || w[2], CASE WHEN length(w[3]) > 4 THEN w[3] END]) AS term FROM (SELECT item_id, text, regexp_extract_all(lower(text), '{D._WORDS}') AS w FROM benchmark)"
_DEFINED = f"SELECT term, arg_min(text, item_id) AS text FROM ({_OF_ITEM}) WHERE term IS NOT NULL GROUP BY 1"
#: The text that a source is compared by: a title by its abstract, where there is one.
_SAID = f"SELECT \"row\", CASE WHEN abstract <> '' THEN abstract ELSE title END AS title, statement, abstract FROM ({D._PARTS})"
_SIMILAR = f"""
WITH hits AS MATERIALIZED ({D._FIRST_HITS}),
pairs AS MATERIALIZED (SELECT h."row", h.term, h.n, h.source, CASE h.source WHEN 'title' THEN s.title WHEN 'statement' THEN s.statement ELSE s.abstract END AS said FROM hits h JOIN ({_SAID}) s USING ("row")),
df AS MATERIALIZED (SELECT w AS word, count(*) AS c FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '{D._WORDS}')) AS w FROM documents) GROUP BY 1),
total AS (SELECT count(*) AS n FROM documents),
a AS MATERIALIZED (SELECT "row", w AS word, count(*) AS k FROM (SELECT "row", unnest(regexp_extract_all(lower(said), '{D._WORDS}')) AS w FROM (SELECT DISTINCT "row", said FROM pairs)) GROUP BY 1, 2),
b AS MATERIALIZED (SELECT term, w AS word, count(*) AS k FROM (SELECT term, unnest(regexp_extract_all(lower(text), '{D._WORDS}')) AS w FROM ({_DEFINED})) GROUP BY 1, 2),
va AS MATERIALIZED (SELECT "row", word, k * (ln((1 + n) / (1 + coalesce(c, 0))) + 1) AS x FROM a LEFT JOIN df USING (word), total),
vb AS MATERIALIZED (SELECT term, word, k * (ln((1 + n) / (1 + coalesce(c, 0))) + 1) AS y FROM b LEFT JOIN df USING (word), total),
dots AS (SELECT p."row", p.term, sum(x * y) AS dot FROM pairs p JOIN vb ON vb.term = p.term JOIN va ON va."row" = p."row" AND va.word = vb.word GROUP BY 1, 2)
SELECT p."row", p.term, round(CASE WHEN raw < 20 THEN ln(raw) / ln(20) ELSE 1 END, 6) AS score, round(coalesce(dot, 0) / (la * lb), 4) AS about
FROM (SELECT *, CASE source WHEN 'title' THEN 20 WHEN 'statement' THEN 1 + (2 * n) // 2 ELSE 1 + n // 2 END AS raw FROM pairs) p
LEFT JOIN dots USING ("row", term) LEFT JOIN (SELECT "row", sqrt(sum(x * x)) AS la FROM va GROUP BY 1) USING ("row") LEFT JOIN (SELECT term, sqrt(sum(y * y)) AS lb FROM vb GROUP BY 1) USING (term)
"""


def _definitions(t) -> DataFrame:
    w = X.tokens(F.lower("text"))
    terms = F.array(F.when(F.size(w) >= 2, F.concat_ws(" ", F.get(w, F.lit(0)), F.get(w, F.lit(1)))), F.when(F.length(F.get(w, F.lit(2))) > 4, F.get(w, F.lit(2))))
    return t("benchmark").select("item_id", "text", F.explode(terms).alias("term")).where("term is not null").groupBy("term").agg(F.min_by("text", "item_id").alias("text"))


@query(_SIMILAR)
def dom_conf_score(t):
    """The score of each match, and the similarity of the text it was found in to the term's definition."""
    parts = D._parts(t)
    hits = M.match_cascade(parts, "row", D._SOURCES, D._terms(t), "term", "term")
    said = F.when(F.col("source") == "title", F.when(F.col("abstract") != "", F.col("abstract")).otherwise(F.col("title"))).when(F.col("source") == "statement", F.col("statement")).otherwise(F.col("abstract"))
    texts = parts.join(hits.select("row", "source").distinct(), "row").select("row", said.alias("said"))
    scored = S.similarity(hits, "row", texts, "said", "term", _definitions(t), "text", S.inverse_frequencies(t("documents"), "text"))
    return scored.select("row", "term", F.round(M.confidence_score(F.col("n"), F.col("source")), 6).alias("score"), F.round("about", 4).alias("about"))


# ---- epidemiology

#: An article for each order, in four forms; names of places are those of the nations.
_ARTICLES = """
SELECT o_orderkey, CASE o_orderkey % 4
  WHEN 0 THEN 'The prevalence of it in ' || n_name || ' was ' || o_custkey || ' per 100,000 in ' || year(o_orderdate) || '. Among males it was ' || (o_orderkey % 90) || '.5 %, among women ' || (o_orderkey % 70) || ' %.'
  WHEN 1 THEN 'Nothing is known. An incidence of ' || o_custkey || ' cases per million was found among Ashkenazi Jewish girls from ' || n_name || ', June ' || year(o_orderdate) || '-' || (year(o_orderdate) + 1) || '.'
  WHEN 2 THEN n_name || ' paid ' || o_custkey || ' for gears in ' || year(o_orderdate) || '. No rate is given.'
  ELSE '1 in 20 000 live births in ' || n_name || ' had it (birth prevalence). Its incidence in boys: ' || (o_orderkey % 9) || ' percent; in Hispanic men, ' || o_custkey || '/100,000.' END AS text
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
"""


def _articles(t) -> DataFrame:
    y = F.year("o_orderdate")
    joined = t("orders").join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    k = F.col("o_orderkey")
    text = (
        F.when(k % 4 == 0, F.concat(F.lit("The prevalence of it in "), "n_name", F.lit(" was "), "o_custkey", F.lit(" per 100,000 in "), y, F.lit(". Among males it was "), k % 90, F.lit(".5 %, among women "), k % 70, F.lit(" %.")))
        .when(k % 4 == 1, F.concat(F.lit("Nothing is known. An incidence of "), "o_custkey", F.lit(" cases per million was found among Ashkenazi Jewish girls from "), "n_name", F.lit(", June "), y, F.lit("-"), y + 1, F.lit(".")))
        .when(k % 4 == 2, F.concat("n_name", F.lit(" paid "), "o_custkey", F.lit(" for gears in "), y, F.lit(". No rate is given.")))
        .otherwise(F.concat(F.lit("1 in 20 000 live births in "), "n_name", F.lit(" had it (birth prevalence). Its incidence in boys: "), k % 9, F.lit(" percent; in Hispanic men, "), "o_custkey", F.lit("/100,000.")))
    )
    return joined.select("o_orderkey", text.alias("text"))


def _places(t) -> list[str]:
    return sorted(r[0] for r in t("nation").select("n_name").collect())  # a list of countries


def _epi_sql() -> str:
    spans = [f"regexp_extract_all(x, '{p}')" for p in E.GRAMMAR.values()]
    typed = dict(zip(E.GRAMMAR, spans)) | {"LOC": f"list_filter(regexp_extract_all(x, '\\w+'), lambda w: list_contains(names, w))"}
    return ", ".join(f"array_to_string({typed[t]}, '|') AS \"{t}\"" for t in E.TYPES)


@query(f"SELECT * FROM (SELECT o_orderkey, {_epi_sql()} FROM (SELECT o_orderkey, lower(text) AS x FROM ({_ARTICLES})), (SELECT list(lower(n_name)) AS names FROM nation)) WHERE \"EPI\" <> '' AND \"STAT\" <> ''")
def dom_epi_extract(t):
    """Six lists of typed spans of the articles that name a measure and a rate."""
    found = E.extract(_articles(t), "o_orderkey", "text", _places(t)).where(E.is_epidemiology())
    return found.select("o_orderkey", *[F.array_join(k, "|").alias(k) for k in E.TYPES])


@query()
def dom_epi_rates(t):
    """Each rate with the nearest measure, date, place, sex and ethnicity of its sentence."""
    return E.linked_rates(_articles(t), "o_orderkey", "text", _places(t))


# ---- names


def notes(rows: DataFrame, key: str) -> DataFrame:
    """A sentence or two on each row's person, place and drug."""
    k, person, place, drug = F.col(key), F.col("person"), F.col("place"), F.col("drug")
    forms = [
        F.concat(F.lit("On Monday Dr. "), person, F.lit(" of "), place, F.lit(" gave them "), drug, F.lit(" twice.")),
        F.concat(F.lit("Patients from "), place, F.lit(" took "), drug, F.lit(" daily. Professor "), person, F.lit(" saw them.")),
        F.concat(person, F.lit(" moved to "), place, F.lit("; no dose of "), drug, F.lit(" was used.")),
        F.concat(F.lit("The trial of "), drug, F.lit(" by "), person, F.lit(" ended in "), place, F.lit(".")),
    ]
    return rows.select(key, reduce(lambda a, i: F.when(k % len(forms) == i, forms[i]).otherwise(a), range(1, len(forms)), forms[0]).alias("text"), "person", "place", "drug")


def _named(t) -> DataFrame:
    """A person (two words of a part's name and one of its brand), a place and a drug for each customer."""
    part = t("part").select(F.col("p_partkey").alias("_p"), "p_name", F.regexp_replace("p_brand", "[^A-Za-z0-9]", "").alias("brand"))
    n = t("part").count()
    joined = t("customer").join(part, F.col("c_custkey") % n == F.col("_p")).join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    word = lambda i: F.initcap(F.get(F.split("p_name", " "), F.lit(i)))
    return joined.select("c_custkey", F.concat(word(0), F.lit(" "), word(1), F.lit(" "), F.initcap("c_mktsegment")).alias("person"), F.initcap(F.replace("n_name", F.lit("_"), F.lit("land"))).alias("place"), F.concat(F.lower("brand"), F.lit("mab")).alias("drug"))


def name_tagger(t) -> T.Tagger:
    """Taught by the notes of two thirds of the customers, whose names the gazetteer has."""
    known = _named(t).where("c_custkey % 3 < 2")
    kinds = [known.select(F.lit(k).alias("kind"), F.col(k).alias("name")) for k in ("person", "place", "drug")]
    return T.trained(notes(known, "c_custkey"), "text", reduce(DataFrame.unionByName, kinds).distinct())


@query()
def str_mask_location(t):
    """Notes on all customers, with persons, places and drugs masked."""
    return T.mask_names(notes(_named(t), "c_custkey"), "text", name_tagger(t)).select("c_custkey", "masked")


@query()
def dom_drug_spans(t):
    """Drugs that the tagger finds in the notes, mapped to parts by their names where they are known."""
    spans = T.named_spans(notes(_named(t), "c_custkey"), "c_custkey", "text", name_tagger(t)).where("kind = 'drug'")
    brands = t("part").select(F.concat(F.lower(F.regexp_replace("p_brand", "[^A-Za-z0-9]", "")), F.lit("mab")).alias("name"), F.col("p_brand").alias("brand")).distinct()
    return spans.join(brands, "name", "left").select("c_custkey", "start", "end", "name", "brand")

"""Articles and what is saved with them: a chain of states, as later ones read what earlier ones wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from veinloom.operators import graph as G
from veinloom.operators import matching as M
from veinloom.operators import windows as W
from veinloom.pipelines.steps import Pipeline

PUBLICATIONS = Pipeline("publications")


@PUBLICATIONS.step("fetched known", "articles")
def save_articles(t):
    """Articles that are not loaded yet, each once."""
    return {"articles": t["fetched"].join(t["known"].select("pmid"), "pmid", "left_anti").where("pmid is not null").dropDuplicates(["pmid"])}


@PUBLICATIONS.step("articles citations", "cited")
def save_references(t):
    """The sections that cite each article; 'See Also' where none is named."""
    named = t["citations"].groupBy("pmid").agg(F.array_sort(F.collect_set("section")).alias("sections"))
    return {"cited": t["articles"].select("pmid").join(named, "pmid", "left").select("pmid", F.when(F.size("sections") > 0, F.col("sections")).otherwise(F.array(F.lit("See Also"))).alias("sections"))}


@PUBLICATIONS.step("articles", "epidemiology")
def save_epidemiology(t):
    """Articles on epidemiology, by a model's score if there is a column of that name, else by words."""
    texts = t["articles"].select(F.col("pmid").alias("row"), "abstract", *(["score"] if "score" in t["articles"].columns else []))
    score = F.col("score") if "score" in texts.columns else None
    return {"epidemiology": M.annotate(texts, "abstract", score).withColumnRenamed("row", "pmid")}


@PUBLICATIONS.step("articles annotations", "mentions")
def save_annotations(t):
    """Annotations of saved articles with their places merged."""
    found = t["annotations"].join(t["articles"].select("pmid"), "pmid", "left_semi")
    return {"mentions": M.merge_annotations(found, ["pmid", "kind", "identifier"], "place")}


@PUBLICATIONS.step("mentions", "genes mentions_gene")
def save_genes(t):
    """Genes among the annotations as nodes, and their edges."""
    rows = t["mentions"].where("kind = 'Gene'")
    return {"genes": rows.select(F.col("identifier").alias("gene")).distinct(), "mentions_gene": G.merge_edges(rows.withColumnRenamed("identifier", "gene"), "pmid", "gene")}


@PUBLICATIONS.step("articles", "numbered")
def number_articles(t):
    """Surrogate keys in order of the ids, for what refers to articles by number."""
    return {"numbered": W.surrogate_keys(t["articles"].select("pmid"), ["pmid"], "ART-", 7)}

"""Diseases with their names, hierarchy, genes and phenotypes."""

from __future__ import annotations

from pyspark.sql import functions as F

from veinloom.functions import text as X
from veinloom.operators import graph as G
from veinloom.operators import joins as J
from veinloom.operators import windows as W
from veinloom.pipelines.steps import Pipeline

ONTOLOGY = Pipeline("ontology")


@ONTOLOGY.step("entities", "nodes")
def add_nodes(t):
    """One node for each id, the latest row; synonyms without empty ones, repeats and other entities' names."""
    latest = W.first_per_key(t["entities"], ["id"], [F.col("version").desc(), F.col("name")])
    words = latest.select("id", "name", F.explode_outer(F.array_distinct(X.parse_list("synonyms"))).alias("s"))
    taken = latest.select(F.lower("name").alias("_l"), F.col("id").alias("_of")).distinct()
    own = words.withColumn("_l", F.lower("s")).join(taken.groupBy("_l").agg(F.collect_set("_of").alias("_ids")), "_l", "left")
    free = own.withColumn("s", F.when((F.trim("s") != "") & F.coalesce(F.size(F.array_except("_ids", F.array("id"))) == 0, F.lit(True)) & (F.lower("s") != F.lower("name")), F.col("s")))
    return {"nodes": free.groupBy("id", "name").agg(F.array_sort(F.collect_set("s")).alias("synonyms"))}


@ONTOLOGY.step("entities nodes", "is_a")
def add_hierarchy(t):
    """Edges of children to parents, of which both are nodes."""
    pairs = G.hierarchy(t["entities"].select("id", "parent", F.lit(None).cast(t["entities"].schema["id"].dataType).alias("child")), "id", "parent", "child")
    ids = t["nodes"].select("id")
    return {"is_a": J.with_both_ends(pairs, "child", ids, "parent", ids).select("child", "parent")}


@ONTOLOGY.step("gene_links nodes", "genes has_gene")
def add_genes(t):
    """Genes by symbol, and edges with the sorted set of their references."""
    links = t["gene_links"].join(t["nodes"].select("id"), "id", "left_semi").where("symbol is not null")
    edges = links.groupBy("id", "symbol").agg(F.array_sort(F.collect_set("reference")).alias("references"))
    return {"genes": links.select("symbol").distinct(), "has_gene": edges}


@ONTOLOGY.step("is_a nodes", "levels")
def add_levels(t):
    """How many children and parents each node has, zero where there is none."""
    down = t["is_a"].groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("children"))
    up = t["is_a"].groupBy(F.col("child").alias("id")).agg(F.count(F.lit(1)).alias("parents"))
    return {"levels": t["nodes"].select("id").join(down, "id", "left").join(up, "id", "left").na.fill(0, ["children", "parents"])}

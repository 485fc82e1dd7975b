"""Nodes and mapping tables of a data archive: from attribute tables, one folder an entity, to six kinds of nodes and the six
tables of edges between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinloom.operators import graph as G
from veinloom.operators import windows as W
from veinloom.pipelines.steps import Pipeline

OMICS = Pipeline("omics")

#: Nodes of each kind: the category of the attributes that they are made of, and their attributes.
KINDS = {
    "platform": ("Platform", ["name", "manufacturer"]),
    "experiment": ("Experiment", ["accession", "title", "summary", "kind", "platform"]),
    "sample": ("Sample", ["accession", "title", "organism", "experiment"]),
    "project": ("Project", ["accession", "title", "experiments"]),
    "condition": ("Condition", ["name", "projects"]),
    "publication": ("Publication", ["pmid", "title", "project"]),
}
#: What tells a kind's nodes apart.
KEYS = {"platform": "name", "experiment": "accession", "sample": "accession", "project": "accession", "condition": "name", "publication": "pmid"}


def nodes_of(attributes: DataFrame, kind: str) -> DataFrame:
    """A row for each node: number and one column for each attribute, null where there is none; the values of an attribute
    that has several are joined in order. Nodes of one key are one, with the first value of each attribute by entity."""
    category, columns = KINDS[kind]
    own = attributes.where((F.col("category") == category) & (F.size("values") > 0))
    joined = own.groupBy("entity", "attribute").agg(F.array_join(F.array_distinct(F.flatten(F.array_sort(F.collect_list("values")))), "|").alias("value"))
    wide = joined.groupBy("entity").pivot("attribute", columns).agg(F.first("value"))
    key = KEYS[kind]
    once = wide.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("entity"))).alias(c) for c in columns if c != key])
    return W.surrogate_keys(once, [key], f"{kind.upper()}_", 7, f"{kind}_id").select(f"{kind}_id", *columns)


def edges_between(left: DataFrame, left_id: str, refers: Column, right: DataFrame, right_id: str, right_key: str) -> DataFrame:
    """Edges from nodes to those that one of their attributes names, several names apart by bars."""
    named = left.select(left_id, F.explode(F.split(refers, r"\|")).alias("_to"))
    return G.merge_edges(named.join(right.select(right_id, F.trim(right_key).alias("_to")), "_to"), left_id, right_id)


def _add(kind: str) -> None:
    def make(t):
        return {f"{kind}s": nodes_of(t["attributes"], kind)}

    make.__name__, make.__doc__ = f"add_{kind}s", f"Nodes of the kind {kind}."
    OMICS.step("attributes", f"{kind}s")(make)


for _kind in KINDS:
    _add(_kind)


@OMICS.step("experiments platforms", "experiment_platform")
def map_experiments_to_platforms(t):
    return {"experiment_platform": edges_between(t["experiments"], "experiment_id", F.col("platform"), t["platforms"], "platform_id", "name")}


@OMICS.step("samples experiments", "sample_experiment")
def map_samples_to_experiments(t):
    return {"sample_experiment": edges_between(t["samples"], "sample_id", F.col("experiment"), t["experiments"], "experiment_id", "accession")}


@OMICS.step("sample_experiment experiment_platform", "sample_platform")
def map_samples_to_platforms(t):
    """By way of the sample's experiments."""
    return {"sample_platform": G.merge_edges(t["sample_experiment"].join(t["experiment_platform"], "experiment_id"), "sample_id", "platform_id")}


@OMICS.step("projects experiments", "project_experiment")
def map_projects_to_experiments(t):
    return {"project_experiment": edges_between(t["projects"], "project_id", F.col("experiments"), t["experiments"], "experiment_id", "accession")}


@OMICS.step("conditions projects", "condition_project")
def map_conditions_to_projects(t):
    return {"condition_project": edges_between(t["conditions"], "condition_id", F.col("projects"), t["projects"], "project_id", "accession")}


@OMICS.step("publications projects", "publication_project")
def map_publications_to_projects(t):
    return {"publication_project": edges_between(t["publications"], "publication_id", F.col("project"), t["projects"], "project_id", "accession")}

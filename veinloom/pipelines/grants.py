"""Projects and their funding, and the diseases they are about."""

from __future__ import annotations

from pyspark.sql import functions as F

from veinloom.functions import text as X
from veinloom.operators import graph as G
from veinloom.operators import joins as J
from veinloom.operators import matching as M
from veinloom.pipelines.steps import Pipeline

GRANTS = Pipeline("grants")


@GRANTS.step("projects", "core_projects")
def add_core_projects(t):
    """Core project nodes, each key once."""
    return {"core_projects": t["projects"].where("core is not null").select("core").distinct()}


@GRANTS.step("projects", "agents funded_by")
def add_agents(t):
    """Funding agents and their edges to core projects."""
    rows = t["projects"].where("core is not null and agent is not null")
    return {"agents": rows.select("agent").distinct(), "funded_by": G.merge_edges(rows, "core", "agent")}


@GRANTS.step("projects amounts", "costed")
def merge_funding(t):
    """Amounts of the overlay take the place of a project's own; investigators are split and cleaned."""
    people = F.array_sort(F.filter(F.transform(F.split("investigators", ";"), lambda x: F.trim(F.replace(x, F.lit("(contact)"), F.lit("")))), lambda x: x != ""))
    base = t["projects"].select("project", "core", "title", "statement", "abstract", "cost", people.alias("investigators"))
    return {"costed": J.overwrite(base, t["amounts"].select("project", "cost"), ["project"], ["cost"])}


@GRANTS.step("costed core_projects", "core_costs")
def sum_costs(t):
    """Total cost and number of projects of each core project, zero where there is none."""
    sums = t["costed"].groupBy("core").agg(F.sum("cost").alias("total"), F.count(F.lit(1)).alias("n"))
    return {"core_costs": t["core_projects"].join(sums, "core", "left").select("core", F.coalesce("total", F.lit(0).cast("decimal(28,2)")).alias("total"), F.coalesce("n", F.lit(0)).alias("n"))}


@GRANTS.step("diseases common_words", "terms")
def add_terms(t):
    """Names and synonyms of diseases, without short words and common ones."""
    return {"terms": M.term_dictionary(t["diseases"], "disease", "name", "synonyms", t["common_words"])}


@GRANTS.step("costed terms diseases", "about")
def map_diseases(t):
    """Edges of projects to diseases, with a confidence, from the first of title, statement and abstract with a match. Terms
    are matched under the disease's name, as names inside others go; diseases of one name share its matches."""
    names = t["diseases"].select("disease", F.lower(F.trim("name")).alias("_name")).where("_name is not null")
    hits = M.match_cascade(t["costed"], "project", ["title", "statement", "abstract"], t["terms"].join(names, "disease"), "_name", "term", stems=True)
    return {"about": hits.join(names, "_name").select("project", "disease", "source", F.round(M.confidence_score(F.col("n"), F.col("source")), 6).alias("confidence"))}


@GRANTS.step("costed", "sources")
def select_sources(t):
    """Which text of a project annotations are taken from."""
    long_enough = X.word_count("statement") > 20
    return {"sources": t["costed"].select("project", F.when(long_enough, "statement").when(F.length("abstract") > 0, "abstract").otherwise("title").alias("source"))}

"""Loads of whole archives, step by step: trials from studies, and nodes and mapping tables from attributes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinloom.operators import joins as J
from veinloom.pipelines import omics as O
from veinloom.pipelines import trials as S
from veinloom.plans.base import query
from veinloom.plans.domain_queries import _files, _scratch
from veinloom.sources import readers as R

# ---- trials


def _studies(t) -> DataFrame:
    """A study for each order: its customer's conditions, the parts of its lines as interventions, and a place."""
    place = t("customer").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", "c_name", "n_name")
    given = F.struct(F.when(F.col("p_size") > 25, "DRUG").otherwise("DEVICE").alias("type"), F.concat_ws(" ", "p_name", "p_type").alias("name"))
    parts = t("lineitem").join(t("part"), F.col("p_partkey") == F.col("l_partkey")).groupBy("l_orderkey").agg(F.collect_set(given).alias("interventions"))
    rows = t("orders").join(place, F.col("c_custkey") == F.col("o_custkey")).join(parts, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    identity = F.struct(F.concat(F.lit("NCT"), "o_orderkey").alias("nctId"), F.concat(F.lit("Trial; no. "), "o_orderkey").alias("briefTitle"))
    conditions = F.struct(F.array(F.concat(F.lit("COND-"), "o_custkey"), F.concat(F.lit("Other "), F.col("o_orderkey") % 5)).alias("conditions"))
    places = F.struct(F.array(F.struct(F.col("c_name").alias("facility"), F.col("n_name").alias("country"))).alias("locations"))
    section = F.struct(identity.alias("identificationModule"), conditions.alias("conditionsModule"), F.struct("interventions").alias("armsInterventionsModule"), places.alias("contactsLocationsModule"))
    return rows.select(F.to_json(F.struct(section.alias("protocolSection"))).alias("study"))


@query("SELECT 'NCT' || o_orderkey AS nct, 'condition' AS kind, CAST(c_custkey AS VARCHAR) AS target FROM orders JOIN customer ON c_custkey = o_custkey UNION SELECT 'NCT' || l_orderkey, 'drug', p_name FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey WHERE p_size > 25 UNION SELECT 'NCT' || o_orderkey, 'location', n_name FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey")
def dom_trials_load(t):
    """Trials parsed from JSON, and what they are mapped to: diseases by their conditions, drugs by the names inside
    interventions, and countries."""
    tables = {
        "studies": _studies(t),
        "known": t("orders").limit(0).select(F.lit("").alias("nct")),
        "diseases": t("customer").select(F.col("c_custkey").cast("string").alias("disease"), F.concat(F.lit("Cond "), "c_custkey").alias("name"), F.array().cast("array<string>").alias("synonyms")),
        "common_words": t("part").select(F.lower("p_type").alias("word")).distinct(),
        "drugs": t("part").select(F.col("p_name").alias("drug"), F.col("p_name").alias("name")).distinct(),
    }
    for step in (S.parse_studies, S.add_conditions, S.add_terms, S.map_conditions, S.add_interventions, S.map_drugs, S.add_locations):
        tables |= step(tables)
    diseases = tables["trial_conditions"].join(tables["condition_diseases"], "condition").select("nct", F.lit("condition").alias("kind"), F.col("disease").alias("target"))
    drugs = tables["trial_interventions"].join(tables["intervention_drugs"], "intervention").select("nct", F.lit("drug").alias("kind"), F.col("drug").alias("target"))
    places = tables["trial_locations"].join(tables["locations"], "location").select("nct", F.lit("location").alias("kind"), F.col("country").alias("target"))
    return diseases.unionByName(drugs).unionByName(places).distinct()


# ---- nodes and mapping tables


def _attributes(t) -> DataFrame:
    """Attribute rows of six kinds of entities, made of the tables."""

    def of(rows: DataFrame, category: str, entity: Column, **values: Column) -> DataFrame:
        listed = F.array(*[F.struct(F.lit(k).alias("attribute"), v.alias("values")) for k, v in values.items()])
        return rows.select(entity.cast("string").alias("entity"), F.lit(category).alias("category"), F.explode(listed).alias("a")).select("entity", "category", "a.attribute", "a.values")

    one = lambda c: F.array(c if isinstance(c, Column) else F.col(c))
    named = lambda prefix, c: F.concat(F.lit(prefix), F.col(c))
    nations = t("nation").join(t("region"), F.col("r_regionkey") == F.col("n_regionkey"))
    orders = t("orders").join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    of_customer = t("orders").groupBy("o_custkey").agg(F.collect_list(named("GSE", "o_orderkey")).alias("experiments"))
    of_part = t("lineitem").join(t("orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(t("part"), F.col("p_partkey") == F.col("l_partkey")).where("l_quantity > 45").groupBy("p_name").agg(F.collect_set(named("PRJ", "o_custkey")).alias("projects"))
    kinds = [
        of(nations, "Platform", F.col("n_nationkey"), name=one("n_name"), manufacturer=one("r_name")),
        of(orders, "Experiment", F.col("o_orderkey"), accession=one(named("GSE", "o_orderkey")), title=one("o_orderpriority"), platform=one("n_name")),
        of(t("lineitem"), "Sample", F.concat_ws("_", "l_orderkey", "l_linenumber"), accession=one(F.concat(F.lit("GSM"), F.concat_ws("_", "l_orderkey", "l_linenumber"))), experiment=one(named("GSE", "l_orderkey"))),
        of(of_customer, "Project", F.col("o_custkey"), accession=one(named("PRJ", "o_custkey")), experiments=F.col("experiments")),
        of(of_part, "Condition", F.col("p_name"), name=one("p_name"), projects=F.col("projects")),
        of(t("supplier"), "Publication", F.col("s_suppkey"), pmid=one(F.col("s_suppkey").cast("string")), title=one("s_name"), project=one(named("PRJ", "s_suppkey"))),
    ]
    return reduce(DataFrame.unionByName, kinds)


_KEYS = {
    "platform": "SELECT n_name AS k FROM nation",
    "experiment": "SELECT 'GSE' || o_orderkey AS k FROM orders",
    "sample": "SELECT 'GSM' || l_orderkey || '_' || l_linenumber AS k FROM lineitem",
    "project": "SELECT DISTINCT 'PRJ' || o_custkey AS k FROM orders",
    "condition": "SELECT DISTINCT p_name AS k FROM part JOIN lineitem ON l_partkey = p_partkey WHERE l_quantity > 45",
    "publication": "SELECT CAST(s_suppkey AS VARCHAR) AS k FROM supplier",
}
_IN_ORDER = "(row_number() OVER (ORDER BY k) - 1)"


@query(" UNION ALL ".join(f"SELECT '{kind}' AS kind, '{kind.upper()}_' || lpad(CAST({_IN_ORDER} AS VARCHAR), CAST(greatest(7, length(CAST({_IN_ORDER} AS VARCHAR))) AS INTEGER), '0') AS id, k AS name FROM (SELECT DISTINCT k FROM ({sql}))" for kind, sql in _KEYS.items()))
def dom_eav_to_nodes(t):
    """Attribute rows to six kinds of nodes, numbered by their keys."""
    attributes = _attributes(t)
    kinds = [O.nodes_of(attributes, k).select(F.lit(k).alias("kind"), F.col(f"{k}_id").alias("id"), F.col(O.KEYS[k]).alias("name")) for k in O.KINDS]
    return reduce(DataFrame.unionByName, kinds)


_TABLES = {
    "experiment_platform": "SELECT 'GSE' || o_orderkey, n_name FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey",
    "sample_experiment": "SELECT 'GSM' || l_orderkey || '_' || l_linenumber, 'GSE' || l_orderkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey",
    "sample_platform": "SELECT 'GSM' || l_orderkey || '_' || l_linenumber, n_name FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey",
    "project_experiment": "SELECT 'PRJ' || o_custkey, 'GSE' || o_orderkey FROM orders",
    "condition_project": "SELECT DISTINCT p_name, 'PRJ' || o_custkey FROM part JOIN lineitem ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey WHERE l_quantity > 45",
    "publication_project": "SELECT CAST(s_suppkey AS VARCHAR), 'PRJ' || s_suppkey FROM supplier WHERE s_suppkey IN (SELECT o_custkey FROM orders)",
}


@query(" UNION ALL ".join(f"SELECT DISTINCT '{name}' AS edge, x.* FROM ({sql}) x(source, target)" for name, sql in _TABLES.items()))
def dom_mapping_edges(t):
    """The six mapping tables between these nodes, by their keys."""
    attributes = _attributes(t)
    tables = {f"{k}s": O.nodes_of(attributes, k).select(f"{k}_id", *O.KINDS[k][1]) for k in O.KINDS}
    for step in (O.map_experiments_to_platforms, O.map_samples_to_experiments, O.map_samples_to_platforms, O.map_projects_to_experiments, O.map_conditions_to_projects, O.map_publications_to_projects):
        tables |= step(tables)
    out = []
    for name in _TABLES:
        a, b = name.split("_")
        ends = [tables[f"{k}s"].select(f"{k}_id", F.col(O.KEYS[k]).alias(to)) for k, to in ((a, "source"), (b, "target"))]
        out.append(tables[name].join(ends[0], f"{a}_id").join(ends[1], f"{b}_id").select(F.lit(name).alias("edge"), "source", "target"))
    return reduce(DataFrame.unionByName, out)


@_files("scan_eav", "SELECT 'n_name=' || n_name AS entity, 'Customer' AS category, c_name AS attribute, c_mktsegment || '|' || c_custkey AS y FROM customer JOIN nation ON n_nationkey = c_nationkey")
def _eav(spark, t):
    """A folder of attributes for each nation, with printed lists as values."""
    path = _scratch(spark, "eav")
    rows = t("customer").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    printed = F.concat(F.lit("['"), "c_mktsegment", F.lit("', \""), "c_custkey", F.lit("\"]"))
    listed = rows.select("n_name", F.lit("Customer").alias("Primary_category"), F.col("c_name").alias("Attribute"), printed.alias("Content"))
    listed.write.option("header", True).option("escape", '"').partitionBy("n_name").csv(path)
    return R.read_attributes(spark, path).select("entity", "category", "attribute", F.array_join("values", "|").alias("y"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS brand, p_type AS kind FROM part")
def eav_pivot(t):
    """Parts as attribute-value rows, and back to one row each."""
    rows = t("part").select(F.col("p_partkey").cast("string").alias("id"), F.explode(F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(c).alias("value")) for a, c in (("name", "p_name"), ("brand", "p_brand"), ("kind", "p_type"))])).alias("x"))
    return R.attributes_to_nodes(rows.select("id", "x.*"), "id", "attribute", "value", ["name", "brand", "kind"])


# ---- collaborations

_MEMBERS = "SELECT DISTINCT o_orderstatus AS source, l_orderkey AS item, l_suppkey AS s, s_nationkey AS n, CAST(o_orderdate AS DATE) AS d FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey"


@query(f"WITH m AS MATERIALIZED ({_MEMBERS}) SELECT x.s AS a, y.s AS b, count(*) % 1000 AS papers, strftime(min(x.d), '%Y-%m-%d') AS first_day FROM m x JOIN m y ON x.source = y.source AND x.item = y.item AND x.s < y.s AND x.n <> y.n GROUP BY 1, 2")
def dom_coauthor_network(t):
    """Pairs of people of different places who meet in trials, grants or articles (orders of three states): how often in all
    three together, and since when."""
    orders = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("source"), F.to_date("o_orderdate").alias("day"))
    members = t("lineitem").join(orders, "l_orderkey").select(F.struct("source", F.col("l_orderkey").alias("item")).alias("group"), "l_suppkey", "day")
    pairs = J.co_participation(members, "group", "l_suppkey", since="day")
    place = t("supplier").select("s_suppkey", "s_nationkey")
    apart = pairs.join(place.toDF("a", "_na"), "a").join(place.toDF("b", "_nb"), "b").where("_na <> _nb")
    return apart.select("a", "b", (F.col("weight") % 1000).alias("papers"), F.col("day").cast("string").alias("first_day"))

"""Trials from the studies of a registry: a node table and an edge table for each kind of thing that a study names.

A study is a JSON text. Nodes are told apart by what they hold, and each edge is there once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinloom.functions import text as X
from veinloom.operators import graph as G
from veinloom.operators import matching as M
from veinloom.pipelines.steps import Pipeline

TRIALS = Pipeline("trials")

# What is read of a study, by the registry's names.
SCHEMA = """protocolSection struct<
  identificationModule: struct<nctId: string, briefTitle: string, officialTitle: string>,
  statusModule: struct<overallStatus: string, startDateStruct: struct<date: string>, lastUpdatePostDateStruct: struct<date: string>>,
  sponsorCollaboratorsModule: struct<leadSponsor: struct<name: string, class: string>, collaborators: array<struct<name: string, class: string>>>,
  conditionsModule: struct<conditions: array<string>, keywords: array<string>>,
  designModule: struct<studyType: string, phases: array<string>, designInfo: struct<allocation: string, interventionModel: string, primaryPurpose: string>>,
  outcomesModule: struct<primaryOutcomes: array<struct<measure: string, timeFrame: string, description: string>>>,
  eligibilityModule: struct<sex: string, minimumAge: string, maximumAge: string, healthyVolunteers: boolean, eligibilityCriteria: string>,
  armsInterventionsModule: struct<interventions: array<struct<type: string, name: string, description: string>>>,
  contactsLocationsModule: struct<overallOfficials: array<struct<name: string, affiliation: string, role: string>>, locations: array<struct<facility: string, city: string, state: string, country: string>>>,
  referencesModule: struct<references: array<struct<pmid: string, type: string, citation: string>>>>"""


def _clean(c: Column) -> Column:
    """Without signs beyond letters, digits, blanks and a few more; null if nothing is left."""
    out = F.trim(X.whitelist(c))
    return F.when(out != "", out)


def _nodes(t, module: str, fields: list[str], name: str) -> dict[str, DataFrame]:
    """Nodes of one kind and their edges to trials; a node's key is a hash of its fields."""
    item = F.col(f"study.protocolSection.{module}")
    rows = t["parsed"].select("nct", (F.explode(item) if "." in module else item).alias("x"))  # a list inside a module, or a module
    return _keyed(rows.select("nct", *[_clean(F.col(f"x.{f}").cast("string")).alias(f) for f in fields]), fields, name)


def _keyed(rows: DataFrame, fields: list[str], name: str) -> dict[str, DataFrame]:
    some = rows.where(F.coalesce(*[F.col(f) for f in fields]).isNotNull())
    keyed = some.withColumn(name, F.sha2(F.to_json(F.struct(*fields)), 256))
    return {f"{name}s": keyed.select(name, *fields).distinct(), f"trial_{name}s": G.merge_edges(keyed, "nct", name)}


@TRIALS.step("studies known", "parsed")
def parse_studies(t):
    """Studies that are not loaded yet, each once, by their id; a text that is no JSON, or without an id, is left out."""
    read = t["studies"].select(F.from_json("study", SCHEMA).alias("study"), F.xxhash64("study").alias("_h")).withColumn("nct", F.col("study.protocolSection.identificationModule.nctId"))
    once = read.where("nct is not null").groupBy("nct").agg(F.min_by("study", "_h").alias("study"))
    return {"parsed": once.join(t["known"].select("nct"), "nct", "left_anti")}


@TRIALS.step("parsed", "trials")
def add_trials(t):
    """A node for each trial."""
    s = F.col("study.protocolSection")
    return {"trials": t["parsed"].select("nct", _clean(F.coalesce(s["identificationModule"]["officialTitle"], s["identificationModule"]["briefTitle"])).alias("title"), s["statusModule"]["overallStatus"].alias("status"), s["statusModule"]["startDateStruct"]["date"].alias("start"), s["statusModule"]["lastUpdatePostDateStruct"]["date"].alias("updated"))}


@TRIALS.step("parsed", "sponsors trial_sponsors")
def add_sponsors(t):
    """Lead sponsors and collaborators."""
    m = "study.protocolSection.sponsorCollaboratorsModule"
    lead = t["parsed"].select("nct", F.col(f"{m}.leadSponsor").alias("x"))
    more = t["parsed"].select("nct", F.explode(f"{m}.collaborators").alias("x"))
    return _keyed(lead.unionByName(more).select("nct", _clean(F.col("x.name")).alias("name"), _clean(F.col("x.class")).alias("class")), ["name", "class"], "sponsor")


@TRIALS.step("parsed", "locations trial_locations")
def add_locations(t):
    return _nodes(t, "contactsLocationsModule.locations", ["facility", "city", "state", "country"], "location")


@TRIALS.step("parsed", "investigators trial_investigators")
def add_investigators(t):
    return _nodes(t, "contactsLocationsModule.overallOfficials", ["name", "affiliation", "role"], "investigator")


@TRIALS.step("parsed", "outcomes trial_outcomes")
def add_outcomes(t):
    return _nodes(t, "outcomesModule.primaryOutcomes", ["measure", "timeFrame", "description"], "outcome")


@TRIALS.step("parsed", "references trial_references")
def add_references(t):
    return _nodes(t, "referencesModule.references", ["pmid", "type", "citation"], "reference")


@TRIALS.step("parsed", "designs trial_designs")
def add_designs(t):
    """What a study is like."""
    m = "study.protocolSection.designModule"
    rows = t["parsed"].select("nct", _clean(F.col(f"{m}.studyType")).alias("kind"), _clean(F.array_join(f"{m}.phases", " ")).alias("phases"), *[_clean(F.col(f"{m}.designInfo.{f}")).alias(f) for f in ("allocation", "interventionModel", "primaryPurpose")])
    return _keyed(rows, ["kind", "phases", "allocation", "interventionModel", "primaryPurpose"], "design")


@TRIALS.step("parsed", "participants trial_participants")
def add_participants(t):
    return _nodes(t, "eligibilityModule", ["sex", "minimumAge", "maximumAge", "healthyVolunteers", "eligibilityCriteria"], "participant")


@TRIALS.step("parsed", "conditions trial_conditions")
def add_conditions(t):
    """Conditions in one spelling."""
    rows = t["parsed"].select("nct", F.explode("study.protocolSection.conditionsModule.conditions").alias("condition"))
    named = rows.select("nct", X.normalize_term("condition").alias("condition")).where("condition <> ''")
    return {"conditions": named.select("condition").distinct(), "trial_conditions": G.merge_edges(named, "nct", "condition")}


@TRIALS.step("diseases common_words", "terms")
def add_terms(t):
    """Names and synonyms of diseases, without short words and common ones."""
    return {"terms": M.term_dictionary(t["diseases"], "disease", "name", "synonyms", t["common_words"])}


@TRIALS.step("conditions terms", "condition_diseases")
def map_conditions(t):
    """Conditions that are exactly a disease's term."""
    return {"condition_diseases": t["conditions"].join(t["terms"].select(F.col("term").alias("condition"), "disease"), "condition").select("condition", "disease").distinct()}


@TRIALS.step("parsed", "interventions trial_interventions")
def add_interventions(t):
    return _nodes(t, "armsInterventionsModule.interventions", ["type", "name", "description"], "intervention")


@TRIALS.step("interventions drugs", "intervention_drugs")
def map_drugs(t):
    """Drugs by their exact name, else by the longest names inside it; how says which. drugs: drug, name."""
    given = t["interventions"].where("upper(type) in ('DRUG', 'BIOLOGICAL') and name is not null").select("intervention", X.ascii_only("name").alias("name")).where("name <> ''")
    return {"intervention_drugs": M.map_names(given, "intervention", "name", t["drugs"], "drug", "name").select("intervention", "drug", "how", "term").distinct()}

"""Whole loads on small tables, and going on after a stop."""

import pytest
from pyspark.sql import functions as F

from veinloom.pipelines.grants import GRANTS
from veinloom.pipelines.labels import LABELS
from veinloom.pipelines.omics import OMICS
from veinloom.pipelines.ontology import ONTOLOGY
from veinloom.pipelines.publications import PUBLICATIONS
from veinloom.pipelines.steps import Pipeline
from veinloom.pipelines.trials import TRIALS


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_grants(spark, tmp_path):
    make = spark.createDataFrame
    projects = make(
        [
            (1, "C1", "NIH", "Renal cancers in mice", "", "", 10.0, "Doe, J (contact); Roe, R;"),
            (2, "C1", "NIH", "Other work", "We study cancer, renal. The goal of this is renal cancer. It was renal cancer.", "", 5.0, ""),
            (3, "C2", None, "Nothing", "", "No renal cancer here. Then renal cancer will be. Renal cancer is.", 7.0, None),
            (4, None, "NSF", "Nothing", "", "", None, "A"),
        ],
        "project long, core string, agent string, title string, statement string, abstract string, cost double, investigators string",
    ).withColumn("cost", F.col("cost").cast("decimal(18,2)"))
    tables = {
        "projects": projects,
        "amounts": make([(2, 6.5)], "project long, cost double").withColumn("cost", F.col("cost").cast("decimal(18,2)")),
        "diseases": make([("D1", "Renal cancer", ["kidney"]), ("D2", "Cancer", None)], "disease string, name string, synonyms array<string>"),
        "common_words": make([("cancer",)], "word string"),
    }
    got = GRANTS.run(spark, tables, f"file://{tmp_path}/grants")
    assert rows(got["funded_by"]) == [("C1", "NIH")]
    assert {r["core"]: (float(r["total"]), r["n"]) for r in got["core_costs"].collect()} == {"C1": (16.5, 2), "C2": (7.0, 1)}
    assert {r["project"]: r["investigators"] for r in got["costed"].collect()}[1] == ["Doe, J", "Roe, R"]
    # 1: the stems of the title's words. 2: "cancer, renal" is no term in a statement; the goal's sentence has one as it
    # stands and one by stems. 3: negated 0, future and present one of each kind.
    about = {r["project"]: (r["disease"], r["source"]) for r in got["about"].collect()}
    assert about == {1: ("D1", "title"), 2: ("D1", "statement"), 3: ("D1", "abstract")}
    confidence = {r["project"]: r["confidence"] for r in got["about"].collect()}
    import math

    # 1 + factor * n // 2 with n = 7 * 2 in the statement, and 3 * 2 + 1 * 2 in the abstract
    assert confidence == {1: 1.0, 2: pytest.approx(math.log(15) / math.log(20), abs=1e-6), 3: pytest.approx(math.log(5) / math.log(20), abs=1e-6)}


def test_trials(spark, tmp_path):
    import json

    section = lambda **m: json.dumps({"protocolSection": m})
    studies = [
        section(identificationModule={"nctId": "N1", "briefTitle": "A; trial!"}, conditionsModule={"conditions": ["Renal-Cancer", "renal cancer", "Other"]}, armsInterventionsModule={"interventions": [{"type": "DRUG", "name": "Aspirin"}, {"type": "DRUG", "name": "Oral aspirin™ extra 5 mg"}, {"type": "DEVICE", "name": "Aspirin"}]}, contactsLocationsModule={"locations": [{"facility": "F", "city": "C"}, {"facility": "F", "city": "C"}, {}]}, sponsorCollaboratorsModule={"leadSponsor": {"name": "S", "class": "X"}, "collaborators": [{"name": "S", "class": "X"}, {"name": "T"}]}, designModule={"studyType": "I", "phases": ["1", "2"]}, eligibilityModule={"sex": "ALL", "healthyVolunteers": False}, outcomesModule={"primaryOutcomes": [{"measure": "m"}]}, referencesModule={"references": [{"pmid": "1"}]}),
        section(identificationModule={"nctId": "N2"}, contactsLocationsModule={"locations": [{"facility": "F", "city": "C"}]}, conditionsModule={"conditions": ["kidney  TUMOR"]}),
        section(identificationModule={"nctId": "N3"}), section(identificationModule={}), "no json", None,
    ]
    make = spark.createDataFrame
    tables = {
        "studies": make([(s,) for s in studies + studies[:1]], "study string"), "known": make([("N3",)], "nct string"),
        "diseases": make([("D1", "Renal cancer", ["kidney tumor"]), ("D2", "Other", None)], "disease string, name string, synonyms array<string>"), "common_words": make([("other",)], "word string"),
        "drugs": make([("A", "aspirin"), ("B", "aspirin extra")], "drug string, name string"),
    }
    got = TRIALS.run(spark, tables, f"file://{tmp_path}/trials")
    assert rows(got["trials"].select("nct", "title")) == [("N1", "A trial"), ("N2", None)]
    assert rows(got["trial_conditions"]) == [("N1", "other"), ("N1", "renal cancer"), ("N2", "kidney tumor")]
    assert rows(got["condition_diseases"]) == [("kidney tumor", "D1"), ("renal cancer", "D1")]
    assert got["locations"].count() == 1 and rows(got["trial_locations"].select("nct")) == [("N1",), ("N2",)]
    assert rows(got["sponsors"].select("name", "class")) == [("S", "X"), ("T", None)] and got["trial_sponsors"].count() == 2
    drugs = got["intervention_drugs"].join(got["interventions"], "intervention").select("name", "drug", "how", "type")
    assert rows(drugs) == [("Aspirin", "A", "exact", "DRUG"), ("Oral aspirin extra 5 mg", "B", "span", "DRUG")]
    assert [got[f"{n}s"].count() for n in ("design", "participant", "outcome", "reference", "investigator")] == [1, 1, 1, 1, 0]


def test_omics(spark, tmp_path):
    attributes = [
        ("P1", "Platform", "name", ["Chip"]), ("P1", "Platform", "manufacturer", ["M"]), ("P2", "Platform", "name", ["Chip"]), ("P2", "Platform", "manufacturer", ["other"]),
        ("E1", "Experiment", "accession", ["GSE1"]), ("E1", "Experiment", "platform", ["Chip"]), ("E2", "Experiment", "accession", ["GSE2"]), ("E2", "Experiment", "platform", ["none"]), ("E3", "Experiment", "title", ["no accession"]),
        ("S1", "Sample", "accession", ["GSM1"]), ("S1", "Sample", "experiment", ["GSE1", "GSE2"]), ("S2", "Sample", "accession", ["GSM2"]), ("S2", "Sample", "experiment", []),
        ("J1", "Project", "accession", ["PRJ1"]), ("J1", "Project", "experiments", ["GSE2", "GSE1", "GSE2"]), ("C1", "Condition", "name", ["lupus"]), ("C1", "Condition", "projects", ["PRJ1", "PRJ9"]),
        ("U1", "Publication", "pmid", ["77"]), ("U1", "Publication", "project", ["PRJ1"]), ("U2", "Publication", "pmid", ["77"]), ("U2", "Publication", "title", ["T"]),
    ]
    tables = {"attributes": spark.createDataFrame(attributes, "entity string, category string, attribute string, values array<string>")}
    got = OMICS.run(spark, tables, f"file://{tmp_path}/omics")
    assert rows(got["platforms"]) == [("PLATFORM_0000000", "Chip", "M")]
    assert rows(got["publications"]) == [("PUBLICATION_0000000", "77", "T", "PRJ1")]
    assert [got[f"{k}s"].count() for k in ("experiment", "sample", "project", "condition")] == [2, 2, 1, 1]
    e, s = "EXPERIMENT_000000", "SAMPLE_000000"
    assert rows(got["experiment_platform"]) == [(f"{e}0", "PLATFORM_0000000")] and rows(got["sample_platform"]) == [(f"{s}0", "PLATFORM_0000000")]
    assert rows(got["sample_experiment"]) == [(f"{s}0", f"{e}0"), (f"{s}0", f"{e}1")] and rows(got["project_experiment"]) == [("PROJECT_0000000", f"{e}0"), ("PROJECT_0000000", f"{e}1")]
    assert rows(got["condition_project"]) == [("CONDITION_0000000", "PROJECT_0000000")] and rows(got["publication_project"]) == [("PUBLICATION_0000000", "PROJECT_0000000")]


def test_ontology(spark, tmp_path):
    entities = [("G1", 1, "Old", "['x']", None), ("G1", 2, "Alpha", "['a', \"beta\", '', 'ALPHA', 'a']", None), ("G2", 1, "Beta", None, "G1"), ("G3", 1, "Gamma", "junk", "G9")]
    tables = {
        "entities": spark.createDataFrame(entities, "id string, version int, name string, synonyms string, parent string"),
        "gene_links": spark.createDataFrame([("G1", "TP53", "r2"), ("G1", "TP53", "r1"), ("G9", "X", "r"), ("G2", None, "r")], "id string, symbol string, reference string"),
    }
    got = ONTOLOGY.run(spark, tables, f"file://{tmp_path}/ontology")
    assert rows(got["nodes"]) == [("G1", "Alpha", ["a"]), ("G2", "Beta", []), ("G3", "Gamma", [])]
    assert rows(got["is_a"]) == [("G2", "G1")]
    assert rows(got["has_gene"].select("id", "symbol", "references")) == [("G1", "TP53", ["r1", "r2"])]
    assert rows(got["levels"]) == [("G1", 1, 0), ("G2", 0, 1), ("G3", 0, 0)]


def test_publications(spark, tmp_path):
    tables = {
        "fetched": spark.createDataFrame([(1, "The prevalence is 5 %."), (1, "The prevalence is 5 %."), (2, "Nothing."), (3, "Loaded before."), (None, "x")], "pmid long, abstract string"),
        "known": spark.createDataFrame([(3,)], "pmid long"),
        "citations": spark.createDataFrame([(1, "Text"), (1, "Clinical"), (9, "Text")], "pmid long, section string"),
        "annotations": spark.createDataFrame([(1, "Gene", "7157", "abstract"), (1, "Gene", "7157", "Title"), (3, "Gene", "1", "Title"), (2, "Disease", "D1", "abstract")], "pmid long, kind string, identifier string, place string"),
    }
    got = PUBLICATIONS.run(spark, tables, f"file://{tmp_path}/publications")
    assert rows(got["articles"].select("pmid")) == [(1,), (2,)]
    assert rows(got["cited"]) == [(1, ["Clinical", "Text"]), (2, ["See Also"])]
    assert rows(got["epidemiology"].select("pmid")) == [(1,)]
    assert rows(got["mentions"]) == [(1, "Gene", "7157", ["Title", "abstract"]), (2, "Disease", "D1", ["abstract"])]
    assert rows(got["genes"]) == [("7157",)]
    assert rows(got["numbered"]) == [(1, "ART-0000000"), (2, "ART-0000001")]


def test_labels(spark, tmp_path):
    occurrences = ["age", "age", "cellType", "(odd", "Tg(sox10)", "treatmnt", "zzqx", "tissues", "colour"]
    tables = {
        "occurrences": spark.createDataFrame([(x,) for x in occurrences], "label string"),
        "words": spark.createDataFrame([(w,) for w in "age cell type tissue colour treatmnt".split()], "word string"),
        "values": spark.createDataFrame([("s1", "age", "b", 2), ("s1", "age", "a", 1), ("s1", "age", "b", 3), ("s1", "zzqx", "q", 4)], "sample string, label string, value string, place int"),
    }
    got = LABELS.run(spark, tables, f"file://{tmp_path}/labels")
    found = {r["label"]: (r["n"], r["category"], r["confidence"], r["method"]) for r in got["assigned"].collect()}
    assert found["age"] == (2, "Biospecimen Age", "HIGH", "keyword") and found["cellType"][1:] == ("Biospecimen Type", "HIGH", "keyword")
    assert found["treatmnt"] == (1, "Treatment", "HIGH", "likeness") and found["tissues"][1] == "Biospecimen Type"
    assert set(found) == {"age", "cellType", "treatmnt", "tissues"}
    assert rows(got["properties"]) == [("s1", "Biospecimen Age", "a | b")]


def test_a_stopped_run_goes_on(spark, tmp_path):
    calls = []
    p = Pipeline("p")

    @p.step("a", "b")
    def first(t):
        calls.append("first")
        return {"b": t["a"].select((F.col("id") + 1).alias("id"))}

    @p.step("b", "c")
    def second(t):
        calls.append("second")
        if calls.count("second") == 1:
            raise RuntimeError("stopped")
        return {"c": t["b"].select((F.col("id") * 2).alias("id"))}

    folder = f"file://{tmp_path}/p"
    with pytest.raises(RuntimeError):
        p.run(spark, {"a": spark.range(2)}, folder)
    assert rows(p.run(spark, {"a": spark.range(2)}, folder)["c"]) == [(2,), (4,)]
    assert calls == ["first", "second", "second"]
    with pytest.raises(ValueError):
        p.run(spark, {}, f"file://{tmp_path}/q")

"""What is fitted to texts, and data sources of our own: against enumeration and brute force, with nulls and restarts."""

import itertools
import json
import math
import os
import random
import re
import time
import zipfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veinloom.functions.text import SENTENCE_END_BANG
from veinloom.operators import epidemiology as E
from veinloom.operators import inference as N
from veinloom.operators import semantic as S
from veinloom.operators import tagger as G
from veinloom.sources import paged, sheets
from veinloom.streaming import incremental as I
from veinloom.streaming import polling

GIVEN = "Anna Boris Clara Dmitri Elena Farid Greta Henrik Ines Jonas Katya Liam Marta Nils Olga Pavel".split()
FAMILY = "Abel Brandt Costa Dorn Ebert Fuchs Gruber Haas Ivanov Jansen Keller Lang Meyer Novak Ortega Petrov".split()
PLACES = "Norland Sudmark Ostia Westfen Highmoor Lowdale".split()
DRUGS = [a + b for a in ("rixo", "tela", "dora", "mipra", "zanu") for b in ("mab", "nib", "statin")]


def note(r):
    """A text and the spans of its names."""
    person = f"{r.choice(GIVEN)} {r.choice(FAMILY)}" if r.random() < 0.7 else r.choice(FAMILY)
    place, drug = r.choice(PLACES), r.choice(DRUGS)
    form = r.choice(["Yesterday Dr. {p} of {l} gave them {d}.", "The trial of {d} by {p} ended in {l}; nobody was hurt.", "{p} moved to {l} last year. No dose of {d} was taken there.", "Patients from {l} took {d} daily, as Professor {p} said."])
    text = form.format(p=person, l=place, d=drug)
    return text, sorted((text.index(x), text.index(x) + len(x), k) for x, k in ((person, "person"), (place, "place"), (drug, "drug")))


@pytest.fixture(scope="module")
def taught(spark):
    """Taught with a gazetteer of two thirds of the names; texts with others are held out."""
    r = random.Random(8)
    every = [note(r) for _ in range(900)]
    new = {*GIVEN[::3], *FAMILY[::3], *PLACES[::3], *DRUGS[::3]}
    known = lambda text, spans: not any(w in new for a, b, _ in spans for w in text[a:b].split())
    train, held = [x for x in every if known(*x)], [x for x in every if not known(*x)]
    names = {(k, text[a:b]) for text, spans in train for a, b, k in spans}
    texts = spark.createDataFrame([(t,) for t, _ in train] + [(None,), ("",)], "text string").repartition(3)
    return G.trained(texts, "text", spark.createDataFrame([*names, (None, "x"), ("place", None)], "kind string, name string")), held


def test_viterbi_equals_enumeration():
    r = np.random.default_rng(1)
    tagger = G.Tagger(["a", "b"])
    tagger.weights = r.normal(size=tagger.weights.shape)
    for n in (1, 2, 3, 4):
        found = G.features([GIVEN[int(i)] for i in r.integers(0, 16, n)])
        own, between = tagger.scores(found)
        score = lambda p: own[0][p[0]] + between[-1][p[0]] + sum(own[i][p[i]] + between[p[i - 1]][p[i]] for i in range(1, n))  # noqa: B023, E731
        assert tuple(tagger.decode(found)) == max(itertools.product(range(5), repeat=n), key=score)
    assert all(tag % 2 or not tag for tag in tagger.decode(G.features(["x"])))  # no name begins inside


def test_names_that_no_gazetteer_has_are_found(taught):
    tagger, held = taught
    hits = said = true = 0
    for text, spans in held:
        found = set(tagger.spans(text))
        hits, said, true = hits + len(found & set(spans)), said + len(found), true + len(spans)
    assert len(held) > 100 and 2 * hits / (said + true) > 0.9


def test_masking_through_the_inference_hook(spark, taught):
    tagger, held = taught
    texts = [None, "", "Nothing here.", *[t for t, _ in held[:40]], " ".join(t for t, _ in held) * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string").repartition(3)
    got = {r["k"]: r["masked"] for r in G.mask_names(df, "text", tagger).collect()}
    assert got == {i: None if t is None else G._masked(tagger, t) for i, t in enumerate(texts)} and got[1] == ""
    spans = Counter((r["k"], r["start"], r["end"], r["kind"], r["name"]) for r in G.named_spans(df, "k", "text", tagger).collect())
    assert spans == Counter((i, a, b, k, t[a:b]) for i, t in enumerate(texts) if t for a, b, k in tagger.spans(t))


def test_a_model_is_loaded_once_a_worker_and_sees_bounded_batches(spark, tmp_path):
    def load():
        open(f"{tmp_path}/{os.getpid()}-{time.time_ns()}", "w").close()

        def model(texts):
            assert 0 < len(texts) <= 16 and None not in texts
            return [float(len(x)) for x in texts]

        return model

    rows = [(i, None if i % 7 == 0 else "x" * (i % 50)) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, text string").coalesce(2)
    got = df.select("k", N.inferred(F.col("text"), load, T.DoubleType(), 16).alias("n"))
    found = [(r["k"], r["n"]) for r in got.collect()]
    assert [(k, None if n is None or math.isnan(n) else n) for k, n in sorted(found)] == [(k, None if t is None else float(len(t))) for k, t in rows]
    loads = Counter(f.split("-")[0] for f in os.listdir(tmp_path))
    assert set(loads.values()) == {1}


def test_similarity_equals_brute_force(spark):
    r = random.Random(4)
    texts = {k: " ".join(r.choice("alpha beta gamma delta eps zeta".split()) for _ in range(r.randint(1, 20))) for k in range(20)} | {20: "", 21: None, 22: "!!"}
    definitions = {"a": "Alpha beta beta omega", "b": "gamma", "c": "", "d": "omega omega"}
    pairs = [(k, n, 1) for k in texts for n in definitions] + [(0, "missing", 1)]
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    df = Counter(w for t in texts.values() for w in set(words(t)))
    weigh = lambda t: {w: n * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for w, n in Counter(words(t)).items()}

    def cosine(x, y):
        x, y = weigh(x), weigh(y)
        size = lambda v: math.sqrt(sum(z * z for z in v.values()))
        return sum(x[w] * y.get(w, 0) for w in x) / (size(x) * size(y)) if x and y else None

    t = spark.createDataFrame(list(texts.items()), "k long, text string").repartition(3)
    d = spark.createDataFrame(list(definitions.items()), "name string, definition string")
    found = S.similarity(spark.createDataFrame(pairs, "k long, name string, n int"), "k", t, "text", "name", d, "definition", S.inverse_frequencies(t, "text")).collect()
    assert len(found) == len(pairs)
    for row in found:
        want = cosine(texts[row["k"]], definitions.get(row["name"]))
        assert row["about"] is None if want is None else abs(row["about"] - want) < 1e-9


ARTICLES = [
    (1, "The prevalence in Norland was 3.5 per 100,000 in 1999. In males of Ostia it was 12 %, in women 9%, from 2001 to 2005."),
    (2, "Birth prevalence: 1 in 20 000 live births. Dr. Who saw Asian boys; an incidence of 4 cases per million."),
    (3, "No numbers at all, in 2020."), (4, None), (5, ""), (6, "40 % 50 % 60 % prevalence prevalence"), (7, "Prevalence 1/5000 in Norland, 2/7000 in Ostia, women and men alike"),
]


def test_epidemiology_equals_brute_force(spark):
    places = ["Norland", "Ostia", "Nor.land"]
    df = spark.createDataFrame(ARTICLES, "k long, text string")
    grammar = E.GRAMMAR | {"LOC": r"\b(?:nor[.]land|norland|ostia)\b"}
    spans = lambda t, x: [(m.start(), m.group()) for m in re.finditer(grammar[t], x)]
    got = {r["k"]: {t: r[t] for t in E.TYPES} for r in E.extract(df, "k", "text", places).collect()}
    assert got == {k: {t: [s for _, s in spans(t, (x or "").lower())] for t in E.TYPES} for k, x in ARTICLES}
    assert got[1]["STAT"] == ["3.5 per 100,000", "12 %", "9%"] and got[2]["STAT"] == ["1 in 20 000 live births", "4 cases per million"] and got[1]["DATE"] == ["1999", "2001 to 2005"]
    want = Counter()
    for k, x in ARTICLES:
        for i, s in enumerate([s for s in re.split(SENTENCE_END_BANG, (x or "").lower()) if s.strip(" ")]):
            for at, rate in spans("STAT", s):
                near = [min(((abs(a - at), a, y) for a, y in spans(t, s)), default=(0, 0, None))[2] for t in E.TYPES if t != "STAT"]
                want[k, i, at, rate, *near] += 1
    assert Counter(tuple(r) for r in E.linked_rates(df, "k", "text", places).collect()) == want
    assert E.extract(df, "k", "text", []).select("LOC").distinct().count() == 1


def pages(folder, first, n, last=False):
    for i in range(first, first + n):
        with open(f"{folder}/{i}.json", "w") as f:
            json.dump({"records": [{"k": 10 * i + j, "tags": ["a", None], "more": {"x": i}} for j in range(3)] + [{}], "nextPageToken": None if last and i == first + n - 1 else str(i + 1)}, f)


def test_paged_source_in_batches_and_as_a_stream(spark, tmp_path):
    schema, url = "k long, tags array<string>, more struct<x: int>, none string", f"file://{tmp_path}/{{token}}.json"
    read = lambda **o: paged.registered(spark).read.format("paged").schema(schema).option("url", url).options(**o).load()
    keys = lambda df: sorted(r["k"] for r in df.where("k is not null").collect())
    assert read().count() == 0
    pages(tmp_path, 0, 3)
    assert keys(read()) == [0, 1, 2, 10, 11, 12, 20, 21, 22] and read().rdd.getNumPartitions() == 3
    assert keys(read(first="1", pages="2")) == [10, 11, 12, 20, 21, 22]
    assert read().where("k = 21").first().asDict(True) == {"k": 21, "tags": ["a", None], "more": {"x": 2}, "none": None}

    def stream():
        s = paged.registered(spark).readStream.format("paged").schema(schema).option("url", url).load()
        s.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/mark").trigger(availableNow=True).start().awaitTermination()
        return keys(spark.read.schema(schema).parquet(f"{tmp_path}/out"))

    every = lambda n: [10 * i + j for i in range(n) for j in range(3)]
    assert stream() == every(3)
    assert stream() == every(3)  # nothing new
    pages(tmp_path, 3, 2, last=True)
    assert stream() == every(5) and stream() == every(5)


def test_sheets(spark, tmp_path):
    rows = [(i, None if i % 5 == 0 else f"<a> & 'b' \"{i}\"  ü", i / 8 if i % 3 else None, i % 2 == 0) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, t string, d double, b boolean")
    sheets.write_sheets(df.repartition(4), f"file://{tmp_path}/a", "one")
    back = sheets.read_sheets(spark, f"file://{tmp_path}/a", "d double, k long, t string, b boolean, missing string", "one")
    assert sorted(map(tuple, back.select("k", "t", "d", "b").collect())) == rows and back.where("missing is not null").count() == 0
    assert sheets.read_sheets(spark, f"file://{tmp_path}/a", "k long", "two").count() == 0
    assert sheets.read_sheets(spark, f"file://{tmp_path}/a", "t long").where("t is not null").count() == 0
    os.makedirs(f"{tmp_path}/b")
    with zipfile.ZipFile(f"{tmp_path}/b/x.xlsx", "w") as z:  # no cell names, texts in place, an error, an empty row, a day
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{sheets._MAIN[1:-1]}" xmlns:r="{sheets._LINK[1:-3]}"><sheets><sheet name="s" r:id="r1"/><sheet name="t" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", sheets._PARTS["xl/_rels/workbook.xml.rels"].replace("rId1", "r1").replace("rId2", "r2").replace("sharedStrings.xml", "worksheets/other.xml"))
        line = lambda *cells: "<row>" + "".join(cells) + "</row>"
        text = lambda x: f'<c t="inlineStr"><is><t>{x}</t></is></c>'
        body = line(text("k"), text("day")) + line("<c><v>3</v></c>", "<c><v>36526</v></c>") + line() + line('<c t="e"><v>#DIV/0!</v></c>', text("1999-12-31"))
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{sheets._MAIN[1:-1]}"><sheetData>{body}</sheetData></worksheet>')
        z.writestr("xl/worksheets/other.xml", f'<worksheet xmlns="{sheets._MAIN[1:-1]}"><sheetData/></worksheet>')
    got = sheets.read_sheets(spark, f"file://{tmp_path}/b/x.xlsx", "k int, day date")
    assert sorted([(r["k"], str(r["day"])) for r in got.collect()], key=str) == [(3, "2000-01-01"), (None, "1999-12-31")] and got.rdd.getNumPartitions() == 2


def test_touched_files_are_reported_once(spark, tmp_path):
    folder = f"{tmp_path}/dumps"
    os.makedirs(folder)

    def touch(*names):
        for n in names:
            with open(f"{folder}/{n}.dump", "a") as f:
                f.write("x")
            os.utime(f"{folder}/{n}.dump", ns=(time.time_ns(), time.time_ns()))

    def look(due=0):
        rows = polling.poll(spark, f"file://{folder}", f"file://{tmp_path}/events", f"file://{tmp_path}/mark", due, ".dump").collect()
        return sorted((r["name"], r["event"]) for r in rows)

    touch("a", "b")
    touch("c")
    assert look() == []  # the first look only keeps what it sees
    touch("b", "d")  # d is seen for the first time
    assert look() == [("b.dump", "changed")] and look() == [("b.dump", "changed")]
    touch("b")
    touch("b", "d")
    assert look() == [("b.dump", "changed"), ("b.dump", "changed"), ("d.dump", "changed")]


def test_files_that_rest_are_due(spark, tmp_path):
    os.makedirs(f"{tmp_path}/dumps")
    open(f"{tmp_path}/dumps/a", "w").close()
    look = lambda: [tuple(r)[:2] for r in polling.poll(spark, f"file://{tmp_path}/dumps", f"file://{tmp_path}/events", f"file://{tmp_path}/mark", 500).collect()]
    assert look() == []
    time.sleep(0.6)
    assert look() == [("a", "due")]
    with open(f"{tmp_path}/dumps/a", "w") as f:
        f.write("x")
    assert sorted(look()) == [("a", "changed"), ("a", "due")]


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    schema = "k long, v string, w string, at long"
    land = lambda name, rows: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{name}")
    run = lambda: I.upsert_stream(spark, f"file://{tmp_path}/in/*", schema, f"file://{tmp_path}/t", f"file://{tmp_path}/c", "k", "at", buckets=8)
    files = lambda: {d: sorted(os.listdir(f"{tmp_path}/t/{d}")) for d in os.listdir(f"{tmp_path}/t") if d.startswith("_bucket")}
    land("one", [(k, "old", f"w{k}", 1) for k in range(100)] + [(None, "x", "x", 1)])
    assert run().count() == 100
    before = files()
    land("two", [(7, "new", None, 2), (7, "newer", None, 3), (200, "v", "w", 2)])
    state = {r["k"]: (r["v"], r["w"]) for r in run().collect()}
    assert state == {k: ("old", f"w{k}") for k in range(100)} | {7: ("newer", "w7"), 200: ("v", "w")}
    changed = [d for d in before if files()[d] != before[d]]
    assert 1 <= len(changed) <= 2 and len(before) == 8

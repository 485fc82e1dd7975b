"""Queries read all that they are asked about: small tables with what a prefix, a sample or a limit would lose."""

import difflib
import random
import tracemalloc
import unicodedata
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veinloom.operators import graph as G
from veinloom.operators import nearest as near
from veinloom.operators import tagger
from veinloom.operators.nearest import nearest
from veinloom.plans import registry


@pytest.fixture
def run(spark, tmp_path):
    """Runs a query on tables given as name -> (rows, schema)."""

    def of(name, **tables):
        for table, (data, schema) in tables.items():
            spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"file://{tmp_path}/{table}.parquet")
        return registry.queries()[name](spark, f"file://{tmp_path}")

    return of


def test_texts_are_read_to_their_end(run):
    body = "The Word_of-day: é! " * 30
    text = f"--{body}and THE Last, Ménière's end!?"
    docs = ([(1, text)], "doc_id long, text string")
    y = lambda name: run(name, documents=docs).first()["y"]
    assert y("str_normalize_term") == "the word_of day é " * 30 + "and the last ménière s end"
    assert y("str_normalize_label") == "the word of day: é! " * 30 + "and the last, ménière's end!?"
    assert y("str_normalize_phrase") == "the word_of day e " * 30 + "and the last menieres end"
    assert y("str_ascii_only") == "The Word_of day " * 30 + "and THE Last Mnire s end"
    assert y("str_whitelist_chars") == "--" + "The Word_of-day  " * 30 + "and THE Last Mnires end"
    assert y("str_trim_special") == y("str_trim_strip") == f"{body}and THE Last, Ménière's end"
    assert y("str_stopword_removal") == " ".join(w for w in text.lower().split() if w not in ("the", "of", "and", "le", "de", "die"))
    assert y("str_nfc") == " ".join(unicodedata.normalize("NFC", text).split())
    assert y("sink_escape") == text.encode("unicode_escape").decode("ascii")


def test_supplier_graph_has_all_orders(run):
    """Two suppliers share the orders 1 to 9, every other pair one; none of the order keys is a multiple of 331."""
    lines = [(o, s) for o in range(1, 10) for s in (10, 11)] + [(100 + 10 * a + b, s) for a in range(1, 6) for b in range(a + 1, 6) for s in (a, b)]
    found = {tuple(r) for r in run("graph_components", lineitem=(lines, "l_orderkey long, l_suppkey long")).collect()}
    assert found == {(10, 10), (11, 10)}


def test_communities_stop_only_where_no_move_raises_modularity(spark):
    r = random.Random(3)
    edges = {(i, i + 1): r.randint(1, 9) for i in range(149)} | {tuple(sorted(r.sample(range(150), 2))): r.randint(1, 9) for _ in range(60)}
    found = {x["node"]: x["community"] for x in G.communities(spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "a long, b long, weight long")).collect()}
    k, into = Counter(), defaultdict(Counter)
    for (a, b), w in edges.items():
        for x, y in ((a, b), (b, a)):
            k[x] += w
            into[x][found[y]] += w
    total = Counter()
    for x, c in found.items():
        total[c] += k[x]
    two_m = sum(k.values())
    gain = lambda x, c: into[x][c] - k[x] * (total[c] - (k[x] if c == found[x] else 0)) / two_m
    assert set(found) == set(k)
    assert not [x for x in found if max(gain(x, c) for c in list(into[x])) > gain(x, found[x]) + 1e-6]


def test_vectors_meet_all_others(run, spark):
    """Earlier ones and those of another label too."""
    vectors = [(i, [float(i % 7), 1.0, float(-i % 5)], i % 3) for i in range(19, 42)]
    schema = "vec_id long, embedding array<double>, label long"
    e = {i: v for i, v, _ in vectors}
    dot = lambda x, y: sum(p * q for p, q in zip(x, y))
    cosine = lambda q, o: round(dot(e[q], e[o]) / (dot(e[q], e[q]) * dot(e[o], e[o])) ** 0.5, 6)
    near = {q: sorted((-cosine(q, o), o) for o in e if o != q)[:10] for q in (20, 40)}
    found = run("vec_nearest", embeddings=(vectors, schema)).collect()
    assert {q: sorted((-r["cosine"], r["other"]) for r in found if r["vec_id"] == q) for q in near} == near and len(found) == 20
    found = run("vec_cosine", embeddings=(vectors, schema)).collect()
    assert sorted(map(tuple, found)) == [(q, o, cosine(q, o)) for q in (20, 40) for o in sorted(e) if o != q]
    e_, k = spark.createDataFrame(vectors, schema), ("vec_id", "embedding", 10, 0.3)
    assert {(r["query"], r["other"]) for r in nearest(e_.where("vec_id % 20 = 0"), e_, *k).collect()} == {(q, o) for q in near for s, o in near[q] if -s >= 0.3}
    rules = {(q, o): (c > 0.1, 0.5 * c > 0.1, (0.5 + c) / 2 > 0.3) for q in (20, 40) for o in e if o != q for c in [cosine(q, o)]}
    assert {(r[0], r[1]): tuple(r[2:]) for r in run("vec_threshold", embeddings=(vectors, schema)).collect()} == rules


def test_cosines_of_odd_vectors(run):
    """As in the SQL: null where a vector is missing or empty, not a number where one is all zeros; such pairs stay."""
    vectors = [(20, [1.0, 0.0]), (40, None), (60, [0.0, 0.0]), (61, [2.0, 0.0]), (62, None), (None, [1.0, 1.0]), (63, [])]
    found = {(q, o): repr(c) for q, o, c in run("vec_cosine", embeddings=(vectors, "vec_id long, embedding array<double>")).collect()}
    value = lambda *v: "None" if not all(v) else "1.0" if all(map(any, v)) else "nan"
    v = dict(vectors)
    assert found == {(q, o): value(v[q], v[o]) for q in (20, 40, 60) for o in v if o not in (None, q)}


def test_terms_are_found_anywhere_in_a_text(run):
    """At the start, across characters 60 and 360, and in short texts."""
    first = "renal cancer. " + "x" * 40 + " renal cancer " + "y" * 30 + ". " + "z " * 119 + "zzz renal cancer and more. End renal cancer"
    documents = ([(1, first), (2, "renal cancer"), (3, "cancer renal"), (4, "Dr. Who has renal cancer. Then nothing.")], "doc_id long, text string")
    tables = {"documents": documents, "benchmark": ([(1, "renal cancer of some kind")], "item_id long, text string")}
    for name in ("dom_gazetteer_match", "join_theta_substring"):
        assert {tuple(r) for r in run(name, **tables).collect()} == {(1, "renal cancer", first.count("renal cancer")), (2, "renal cancer", 1), (4, "renal cancer", 1)}
    assert {tuple(r) for r in run("dom_match_cascade", **tables).select("row", "n", "source").collect()} == {(1, 1, "title"), (2, 1, "title"), (3, 1, "title"), (4, 1, "title")}
    lost = "One two. " + "w " * 148 + "renal cancer at 300. Last."
    assert lost.index("renal cancer") < 9 + 300 < lost.index("renal cancer") + 12
    tables["documents"] = ([(1, lost)], "doc_id long, text string")
    assert [tuple(r) for r in run("dom_match_cascade", **tables).select("row", "n", "source").collect()] == [(1, 5, "statement")]


def test_longest_matches_have_both_orders_of_words(run):
    """Anywhere in a text, not only in its first sentence; a name inside another goes unless it is found more often."""
    documents = ([(1, "One two. Then cancer renal."), (2, "A renal cancer. Cancer renal again."), (3, "renal cancer, kinds")], "doc_id long, text string")
    tables = {"documents": documents, "benchmark": ([(1, "renal cancer kinds of it")], "item_id long, text string")}
    assert {tuple(r) for r in run("win_longest_match", **tables).collect()} == {(1, "renal cancer", 1), (2, "renal cancer", 2), (3, "renal cancer", 1), (3, "kinds", 1)}


def test_cluster_profiles_have_all_texts_in_order(run):
    part = [(3, "red Tin", 1), (1, "blue tin", 1), (2, "tin red box", 1), (4, "box", 2)]
    found = {r["cluster"]: (r["size"], r["text"], r["terms"]) for r in run("dom_cluster_profile", part=(part, "p_partkey long, p_name string, p_size int")).collect()}
    assert found == {1: (3, "blue tin tin red box red Tin", "tin,red,blue"), 2: (1, "box", "box")}


def test_nearest_name_is_the_best_of_all(run):
    r = random.Random(2)
    names = sorted({"".join(r.choice("abcd") for _ in range(r.randint(3, 9))) for _ in range(60)})
    ratio = lambda x, y: round(difflib.SequenceMatcher(None, x, y).ratio(), 6)
    best = {x: min((-ratio(x, y), y) for y in names if y != x) for x in names}
    found = run("join_theta_nearest", part=([(x,) for x in names + names[:5]], "p_name string")).select("p_name", "reference", "ratio").collect()
    assert sorted(map(tuple, found)) == [(x, y, -s) for x, (s, y) in best.items() if -s >= 0.6]


def test_sorts_return_every_row_in_order(run):
    orders = [(i * 37 % 101, i, float(i % 7)) for i in range(1, 101)]
    tables = {"orders": (orders, "o_orderkey long, o_custkey long, o_totalprice double")}
    assert [tuple(r) for r in run("sort_single", **tables).collect()] == [x[:2] for x in sorted(orders)]
    assert [tuple(r) for r in run("sort_multi", **tables).collect()] == [x[:2] for x in sorted(orders, key=lambda x: (-x[2], x[0]))]
    assert run("topk", **tables).count() == 20


@pytest.mark.parametrize("numbers", [1 << 22, 4])
def test_every_vector_meets_every_other(run, monkeypatch, numbers):
    """Queries are all vectors, not those of some ids only; also where they come in many blocks."""
    monkeypatch.setattr(near, "BLOCK_NUMBERS", numbers)
    vectors = [(20, [1.0, 0.0]), (21, [3.0, 4.0]), (22, [0.0, 2.0]), (23, None), (24, [0.0, 0.0]), (-1, []), (None, [1.0, 1.0]), (7, [1.0, None])]
    schema = "vec_id long, embedding array<float>"
    length = lambda v: sum(x * x for x in v) ** 0.5
    value = lambda v, w: None if not v or not w or None in v + w else "nan" if not any(v) or not any(w) else round(sum(x * y for x, y in zip(v, w)) / length(v) / length(w), 6)
    asked = {(q, o): value(v, w) for q, v in vectors for o, w in vectors if None not in (q, o) and q != o}
    found = run("vec_cosine", embeddings=(vectors, schema)).collect()
    assert len(found) == len(asked) and {(q, o): "nan" if c != c else c for q, o, c in found} == asked


def test_every_pair_is_judged(run):
    vectors = [(i, [float(i % 7) - 3, 1.0, float(-i % 5)]) for i in range(1, 25)]
    dot = lambda x, y: sum(p * q for p, q in zip(x, y))
    cosine = lambda x, y: round(dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5, 6)
    rules = {(q, o): (c > 0.1, 0.5 * c > 0.1, (0.5 + c) / 2 > 0.3) for q, v in vectors for o, w in vectors if o != q for c in [cosine(v, w)]}
    found = run("vec_threshold", embeddings=(vectors, "vec_id long, embedding array<double>")).collect()
    assert len(found) == len(rules) and {(r[0], r[1]): tuple(r[2:]) for r in found} == rules


def test_nearest_vectors_take_bounded_memory():
    """A block of many queries is not compared with many rows at once; the nearest are the same, ties and repeats included."""
    r = np.random.default_rng(3)
    n, k = 6000, 4
    vectors = np.repeat(r.integers(-3, 4, (n // 3, 6)).astype(float), 3, axis=0) + [0, 0, 0, 0, 0, 9]
    ids = r.permutation(n)
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    batches = [pa.RecordBatch.from_arrays([pa.array(ids[a : a + 2500]), pa.array(vectors[a : a + 2500].tolist())], names=["_id", "_v"]) for a in range(0, n, 2500)]
    tracemalloc.start()
    found = pa.Table.from_batches(near._look(iter(batches), SimpleNamespace(value=(ids, unit)), k, -1.0, 6))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 200e6  # 514 MB before, with 6,000 queries by 2,052 rows at once
    by = defaultdict(list)
    for q, o, c in zip(*(found.column(i).to_pylist() for i in range(3))):
        by[q].append((-c, o))
    for at in range(0, n, 400):
        score = np.round(unit @ unit[at], 6)
        assert by[ids[at]] == sorted((-score[x], ids[x]) for x in range(n) if x != at)[:k]


@pytest.mark.parametrize("group", [G.GROUP_LINKS, 150])
def test_communities_take_few_jobs(spark, monkeypatch, group):
    """In one group of communities, and in several: no single move raises the modularity, and rounds are few."""
    monkeypatch.setattr(G, "GROUP_LINKS", group)
    r = random.Random(5)
    edges = {(i, i + 1): r.randint(1, 9) for i in range(119)} | {tuple(sorted(r.sample(range(120), 2))): r.randint(1, 9) for _ in range(40)}
    name = f"communities-{group}"
    spark.sparkContext.setJobGroup(name, name)
    found = {x["node"]: x["community"] for x in G.communities(spark.createDataFrame([(f"n{a:03}", f"n{b:03}", w) for (a, b), w in edges.items()], "a string, b string, weight long")).collect()}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found.keys() == {f"n{i:03}" for i in range(120)} and all(found[c] == c for c in found.values())
    into, k, total = defaultdict(Counter), Counter(), Counter()
    for (a, b), w in edges.items():
        for x, y in ((f"n{a:03}", f"n{b:03}"), (f"n{b:03}", f"n{a:03}")):
            k[x] += w
            into[x][found[y]] += w
    for x, c in found.items():
        total[c] += k[x]
    gain = lambda x, c: into[x][c] - k[x] * (total[c] - (k[x] if c == found[x] else 0)) / sum(k.values())
    assert not [x for x in found if max(gain(x, c) for c in list(into[x])) > gain(x, found[x]) + 1e-6]
    assert group == 150 or jobs < 300  # 739 before


def test_tagger_learns_in_batches_what_it_learns_one_by_one(monkeypatch):
    """The same weights as from one sentence after the other, though each different window of words is hashed once only and
    most sentences are tagged together."""
    r = random.Random(4)
    names = {("ann", "lee"): 0, ("oslo",): 1, ("bob",): 0}
    text = " ".join(r.choice(["Ann Lee met Bob in Oslo.", "Nobody saw Oslo.", "Bob, then Lee.", "In Oslo Ann left.", "Then it ended"]) + r.choice(["", " So", "\n"]) for _ in range(900))
    hashed, decoded = [], []
    monkeypatch.setattr(tagger, "_hashed", lambda *w, f=tagger._hashed: hashed.append(w) or f(*w))
    monkeypatch.setattr(tagger.Tagger, "decode_all", lambda self, *x, f=tagger.Tagger.decode_all: decoded.append(1) or f(self, *x))
    monkeypatch.setattr(tagger, "_KNOWN", tagger.Features())
    start = np.zeros((5, tagger.SIZE + 6))
    batch = pa.RecordBatch.from_arrays([pa.array([text, None, ""])], names=["_text"])
    found = next(tagger._pass(iter([batch]), SimpleNamespace(value=start), SimpleNamespace(value=names), ["person", "place"]))
    sentences = tagger.tokens_of(text)
    assert len(hashed) == len(set(hashed)) < 100 and len(decoded) < len(sentences) / 4
    weights, late, one = start.copy(), np.zeros_like(start), tagger.Tagger(["person", "place"])
    one.weights = weights
    for step, places in enumerate(sentences, 1):
        x = tagger.features([text[a:b] for a, b in places])
        gold, got = tagger.projected(places, text, names, {"ann": 2, "oslo": 1, "bob": 1}), one.decode(x)
        for i, (g, w) in enumerate(zip(gold, got)):
            last = (gold[i - 1], got[i - 1]) if i else (5, 5)
            for tag, before, by in ((g, last[0], 1.0), (w, last[1], -1.0)):
                if g != w:
                    np.add.at(weights[tag], x[i], by)
                    np.add.at(late[tag], x[i], by * step)
                if (last[0], g) != (last[1], w):
                    weights[tag, tagger.SIZE + before] += by
                    late[tag, tagger.SIZE + before] += by * step
    n, flat = len(sentences), np.zeros(start.size)
    at, value = (found.column(i).to_numpy() for i in (0, 1))
    flat[at[:-1]] = value[:-1]
    assert value[-1] == n and weights.any() and np.allclose(flat, (weights - late / (n + 1)).ravel() * n)


def test_names_are_looked_for_on_all_cores(spark):
    """Texts that lie in one partition are dealt out before they are tagged."""
    texts = spark.range(40).selectExpr("id", "'Ann met Bob' AS text").coalesce(1)
    model = tagger.Tagger(["person"])
    model.weights[1] = 1.0
    found = tagger.named_spans(texts, "id", "text", model)
    assert found.select("id").distinct().count() == 40
    at = tagger.named_spans(texts, "id", "text", model).withColumn("at", F.spark_partition_id())
    assert at.select("at").distinct().count() >= 2
    assert tagger.mask_names(texts, "text", model).withColumn("at", F.spark_partition_id()).select("at").distinct().count() >= 2

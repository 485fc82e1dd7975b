"""Operators on small rows with nulls, ties, repeated rows and empty tables."""

import random
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from veinloom.functions import text as X
from veinloom.functions import values as V
from veinloom.functions.label_words import RULES
from veinloom.functions.stem import stem, stem_word
from veinloom.operators import graph as G
from veinloom.operators import joins as J
from veinloom.operators import matching as M
from veinloom.operators import windows as W
from veinloom.operators.alike import alike_pairs
from veinloom.sources import readers as R
from veinloom.streaming import incremental as I


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_policies(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (None, "n", "n")], "k int, v string, w string")
    new = spark.createDataFrame([(2, None, "y"), (3, "c", None), (None, "m", "m")], "k int, v string, w string")
    assert rows(G.upsert(old, new, "k", "coalesce")) == [(1, "a", None), (2, "b", "y"), (3, "c", None)]
    assert rows(G.upsert(old, new, "k", "overwrite")) == [(1, "a", None), (2, None, "y"), (3, "c", None)]
    assert rows(G.upsert(old, new, "k", "keep")) == [(1, "a", None), (2, "b", "x"), (3, "c", None)]
    again = G.upsert(G.upsert(old, new, "k"), new, "k")
    assert rows(again) == rows(G.upsert(old, new, "k"))
    with pytest.raises(ValueError):
        G.upsert(old, new, "k", "other")


def test_edges_and_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (2, 1), (5, 5), (7, 8), (None, 1)], "a long, b long")
    assert rows(G.components(e)) == [(1, 1), (2, 1), (3, 1), (5, 5), (7, 7), (8, 7)]
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert G.components(chain).where("component <> 0").count() == 0
    assert G.components(e.limit(0)).count() == 0
    assert rows(G.merge_edges(e, "a", "b")) == [(1, 2), (2, 1), (2, 3), (5, 5), (7, 8)]


def modularity_of(edges, part):
    two_m = 2 * sum(w for _, _, w in edges)
    degree, inside = Counter(), 0
    for a, b, w in edges:
        degree[part[a]] += w
        degree[part[b]] += w
        inside += 2 * w * (part[a] == part[b])
    return inside / two_m - sum(k * k for k in degree.values()) / two_m**2


def best_of_sequential_moves(edges, starts):
    """The best modularity of single moves in random order, from each start and with communities merged in turn."""
    best, r = 0, random.Random(3)
    near = {}
    for a, b, w in edges:
        near.setdefault(a, Counter())[b] += w
        near.setdefault(b, Counter())[a] += w
    two_m = 2 * sum(w for _, _, w in edges)
    k = {a: sum(x.values()) for a, x in near.items()}
    for _ in range(starts):
        part = {a: a for a in near}
        while True:
            before = modularity_of(edges, part)
            for groups in ([[a] for a in near], list(_groups(part).values())):  # nodes, then whole communities
                moved = True
                while moved:
                    moved = False
                    r.shuffle(groups)
                    for g in groups:
                        into, own, kg = Counter(), part[g[0]], sum(k[a] for a in g)
                        inside = set(g)
                        for a in g:
                            for b, w in near[a].items():
                                if b not in inside:
                                    into[part[b]] += w
                        total = Counter()
                        for a in near:
                            if a not in inside:
                                total[part[a]] += k[a]
                        score = lambda c: into[c] - kg * total[c] / two_m  # noqa: B023, E731
                        to = max([*into, own], key=score)
                        if score(to) > score(own) + 1e-9:
                            for a in g:
                                part[a] = to
                            moved = True
            if modularity_of(edges, part) <= before + 1e-9:
                break
        best = max(best, before)
    return best


def _groups(part):
    out = {}
    for a, c in part.items():
        out.setdefault(c, []).append(a)
    return out


def planted(groups, size, inside, between, seed):
    r = random.Random(seed)
    n = groups * size
    return [(a, b, 1) for a in range(n) for b in range(a + 1, n) if r.random() < (inside if a // size == b // size else between)]


GRAPHS = {
    "ring": [(i, (i + 1) % 96, 1) for i in range(96)],
    "planted": planted(6, 12, 0.5, 0.03, 1),
    "star": [(0, i, 1) for i in range(1, 30)] + [(1, 2, 3)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_communities_reach_the_best_modularity(spark, name):
    edges = GRAPHS[name]
    e = spark.createDataFrame([*edges, (3, 3, 9), (None, 1, 1), (1, 2, None)], "a long, b long, weight long")
    part = {r["node"]: r["community"] for r in G.communities(e).collect()}
    assert set(part) == {x for a, b, _ in edges for x in (a, b)}
    assert all(c == min(g) for c, g in _groups(part).items())
    found = modularity_of(edges, part)
    assert abs(G.modularity(spark.createDataFrame(edges, "a long, b long, weight long"), spark.createDataFrame(list(part.items()), "n long, c long")).first()[0] - found) < 1e-9
    assert found >= 0.99 * best_of_sequential_moves(edges, 12), name


def test_contraction_keeps_weights_and_degrees(spark):
    links = spark.createDataFrame([(a, b, w) for x, y, w in [(1, 2, 1.0), (2, 3, 2.0), (3, 4, 4.0), (1, 3, 8.0)] for a, b in ((x, y), (y, x))], "a long, b long, w double")
    nodes = spark.createDataFrame([(1, 9.0, 1), (2, 3.0, 1), (3, 14.0, 3), (4, 4.0, 3)], "a long, k double, c long")
    small, level = G.contracted(links, nodes)
    assert rows(small) == [(1, 3, 10.0), (3, 1, 10.0)] and rows(level) == [(1, 12.0), (3, 18.0)]
    assert G.communities(spark.createDataFrame([], "a long, b long, weight long")).count() == 0


def test_entity_resolution(spark):
    n = spark.createDataFrame([(3, "a", None, 1), (1, "a", "p", None), (2, "b", None, 5), (4, None, "z", None)], "id int, k string, x string, y int")
    survivors, mapping = G.resolve_entities(n, ["k"], "id")
    assert rows(survivors.select("id", "k", "x", "y")) == [(1, "a", "p", 1), (2, "b", None, 5), (4, None, "z", None)]
    assert rows(mapping) == [(1, 1), (2, 2), (3, 1), (4, 4)]


def test_joins(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    b = spark.createDataFrame([(2, "q"), (3, "r")], "k int, u string")
    assert {r["origin"] for r in J.outer_with_origin(a, b, ["k"]).collect()} == {"left_only", "right_only", "both"}
    over = J.overwrite(a, spark.createDataFrame([(2, None)], "k int, v string"), ["k"], ["v"])
    assert rows(over) == [(1, "x"), (2, None), (None, "z")]
    rules = spark.createDataFrame([(None, "none", 1), (1, "old", 1), (1, "one", 2)], "k int, norm string, at int")
    assert rows(J.apply_rules(a, rules, ["k"], "at", ["norm"]).select("k", "norm")) == [(1, "one"), (2, None), (None, "none")]
    m = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1), (2, 2), (3, 9), (None, 4)], "g int, p int")
    assert rows(J.co_participation(m, "g", "p")) == [(1, 2, 2)]


def test_windows(spark):
    d = spark.createDataFrame([(3, "b"), (1, "a"), (2, "a")], "id int, g string")
    assert rows(W.surrogate_keys(d, ["id"], "K-", 3).select("id", "key")) == [(1, "K-000"), (2, "K-001"), (3, "K-002")]
    assert rows(W.batches(spark.range(7), ["id"], 3)) == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (5, 1), (6, 2)]
    assert rows(W.first_per_key(d, ["g"], [F.col("id").desc()])) == [(2, "a"), (3, "b")]
    m = spark.createDataFrame([(1, "renal cancer"), (1, "cancer"), (2, "cancer")], "d int, t string")
    assert rows(W.maximal_terms(m, "d", "t")) == [(1, "renal cancer"), (2, "cancer")]


def test_text(spark):
    one = lambda c, v: spark.createDataFrame([(v,)], "x string").select(c).first()[0]
    assert one(X.normalize_term("x"), "  Été--du Sud! ") == "été du sud"
    assert one(X.normalize_phrase("x"), "Ménière's  disease") == "menieres disease"
    assert one(X.camel_split("x"), "cellTypeName") == "cell Type Name"
    assert one(X.parse_list("x"), "['a', \"b c\"]") == ["a", "b c"]
    assert one(X.parse_list("x"), "nonsense") == []
    assert one(X.parse_list("x"), None) == []
    assert one(X.sentences("x"), "Dr. Who is 3.5 m. He left? Yes! No.") == ["Dr. Who is 3.5 m.", "He left?", "Yes!", "No."]
    assert one(X.sentences("x", X.SENTENCE_END), "He left! Yes. No.") == ["He left! Yes.", "No."]
    assert one(X.from_sentence_with("x", "aim 1"), "First. Aim 1 is this. Then that.") == "Aim 1 is this. Then that."
    assert one(X.parse_bool("x"), " YES") is True and one(X.parse_bool("x"), "maybe") is None
    assert one(X.similarity("x", F.lit("abce")), "abcd") == 0.75
    assert one(X.nfc("x"), "é \n a") == "é a"
    assert [stem_word(w) for w in "caresses ponies relational hopping troubled happy generalizations oscillators".split()] == "caress poni relat hop troubl happi gener oscil".split()


def test_values(spark):
    d = spark.createDataFrame([("2020-02-29", "2020/02/29", "02/29/20", "20200229", "junk")], "a string, b string, c string, d string, e string")
    assert len({str(x) for x in d.select(*[V.parse_date(F.col(c)) for c in "abcd"]).first()}) == 1
    assert d.select(V.parse_date(F.col("e"))).first()[0] is None
    v = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0])], "a array<double>, b array<double>")
    assert v.select(V.cosine(F.col("a"), F.col("a")), V.cosine(F.col("a"), F.col("b"))).first()[:] == (1.0, None)


# The examples of Porter's paper, step by step, with what the whole algorithm makes of them.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size",
    "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc", "hesitanci": "hesit",
    "digitizer": "digit", "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile", "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal", "decisiveness": "decis",
    "hopefulness": "hope", "callousness": "callous", "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "formalize": "formal", "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good",
    "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens", "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt",
    "homologou": "homolog", "communism": "commun", "activate": "activ", "angulariti": "angular", "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
}


def test_stems(spark):
    assert {w: stem_word(w) for w in STEMS} == STEMS
    got = spark.createDataFrame([(w,) for w in STEMS] + [(None,), ("",), ("Été cats",)], "w string").select("w", stem("w").alias("y")).collect()
    assert {r["w"]: r["y"] for r in got} == STEMS | {None: None, "": "", "Été cats": "Été cat"}


@pytest.mark.parametrize("chars", [2_000_000, 12])  # one block of the dictionary, and several
def test_matching_has_the_nested_loop_s_result(spark, monkeypatch, chars):
    import re

    monkeypatch.setattr(M, "BLOCK_CHARS", chars)
    texts = ["the Renal cancer, CANCER", "recancer cancerous", "cancer renal", "a-b b b", None, "", "Cancer of the renal cancer", "aa aa aa aa", "b b b b b", "naïve renal canceré", "x" * 50_000 + " renal cancer"]
    terms = ["renal cancer", "Cancer", "a-b", "b", "aa aa", "b b", "naïve", "...", "l c", None, ""]
    t = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3)
    names = spark.createDataFrame([(x,) for x in terms], "term string")
    got = {(r["row"], r["term"]): r["n"] for r in M.match_terms(t, ["row"], "text", names, "term", "term").collect()}
    want = {}
    for i, x in enumerate(texts):
        for s in filter(None, terms):
            low, tokens = s.lower(), re.findall(r"\w+", (x or "").lower())
            if x and low in x.lower() and re.search(r"\w", low) and set(re.findall(r"\w+", low)) <= set(tokens):
                want[i, s] = x.lower().count(low) if " " in low else tokens.count(low)
    assert got == {k: n for k, n in want.items() if n}
    both = {(r["row"], r["term"]): r["n"] for r in M.match_both(t, ["row"], "text", names, "term", "term", stems=False, orders=True).collect()}
    assert both[2, "renal cancer"] == 1 and both[6, "renal cancer"] == 1


def test_counts_of_stems_are_added(spark):
    t = spark.createDataFrame([(1, "Renal cancers, and renal cancer."), (2, "nothing")], "row long, text string")
    names = spark.createDataFrame([("renal cancer",)], "term string")
    # "renal cancer" stands in "renal cancers" too, but "cancer" has to be a token somewhere: twice as it is, twice by stems.
    assert rows(M.match_both(t, ["row"], "text", names, "term", "term")) == [(1, "renal cancer", 4)]
    texts = spark.createDataFrame([(1, "A title.", "The cancers study cancer here.", ""), (2, "Cancer renal and cancer", "", ""), (3, "x", "", "It is not cancer. The goal of it is renal cancer and cancer. Cancer and cancer will come. Cancer was here.")], "k long, title string, statement string, abstract string")
    both = spark.createDataFrame([("renal cancer",), ("cancer",)], "term string")
    found = rows(M.match_cascade(texts, "k", ["title", "statement", "abstract"], both, "term", "term", stems=True))
    # Three counts (one exact, two of stems) in a first sentence; a title in either order; of the goal's sentence "cancer"
    # stays as it has the larger count there.
    assert found == [(1, "cancer", 15, "statement"), (2, "renal cancer", 1, "title"), (3, "cancer", 7 * 4 + 3 * 4, "abstract"), (3, "renal cancer", 7 * 2, "abstract")]


def test_contained_names_go_by_their_counts(spark):
    hits = spark.createDataFrame([(1, "cancer", 3), (1, "renal cancer", 3), (1, "renal", 4), (2, "cancer", 9), (3, "cancer", 2), (3, "cancer of the lung", 1)], "d long, t string, n long")
    assert rows(M.without_contained(hits, ["d"], "t")) == [(1, "renal cancer", 3), (1, "renal", 4), (2, "cancer", 9), (3, "cancer of the lung", 1), (3, "cancer", 2)]
    assert [r[1] for r in rows(M.without_contained(hits, ["d"], "t", always=True))] == ["renal cancer", "cancer", "cancer of the lung"]


@pytest.mark.parametrize("chars", [2_000_000, 10])
def test_the_last_name_inside_a_text_wins(spark, monkeypatch, chars):
    monkeypatch.setattr(M, "BLOCK_CHARS", chars)
    names = [(1, "Cancer"), (2, "renal"), (3, "lung cancer"), (3, "lung cancers"), (9, ""), (None, "of"), (0, "renal"), (4, None)]
    texts = ["Treatment of CANCERS", "renal and lung cancers", "of the lung cancer", None, "", "nothing"]
    t = spark.createDataFrame(list(enumerate(texts)), "k long, x string").repartition(2)
    d = spark.createDataFrame(names, "at int, disease string")
    assert rows(M.last_contained(t, "k", "x", d, "at", "disease")) == [(0, "cancer"), (1, "lung cancers"), (2, "lung cancer")]
    assert M.last_contained(t, "k", "x", d.limit(0), "at", "disease").count() == 0


def test_alike_names_equal_brute_force(spark):
    import difflib

    r = random.Random(12)
    names = ["".join(r.choice("abcde xé🎉") for _ in range(r.randint(1, 14))) for _ in range(150)] + ["aaaa", "aaab", "", None, "b" * 300, "b" * 290 + "a" * 10, "one two", "two one"]
    names += [n + "x" for n in names[:20] if n] + names[:10]
    different = sorted({n for n in names if n})
    ratio = {(x, y): round(difflib.SequenceMatcher(None, x, y).ratio(), 6) for x in different for y in different if x != y}
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(2)
    for least in (0.6, 0.75, 1.0):
        assert {(r["a"], r["b"]): r["ratio"] for r in alike_pairs(df, "name", least).collect()} == {k: v for k, v in ratio.items() if v >= least}
    one = lambda a, b: spark.createDataFrame([(a, b)], "a string, b string").select(X.token_sort_similarity("a", "b")).first()[0]
    for a, b in (("two, One", "one two"), ("b a c", "a-b d"), ("", "x")):
        words = lambda x: " ".join(sorted("".join(c if c.isalnum() else " " for c in x.lower()).split()))
        assert abs(one(a, b) - difflib.SequenceMatcher(None, words(a), words(b)).ratio()) < 1e-9


def test_numbers_of_rows_with_more_columns(spark):
    n = 100_000
    d = spark.range(n).select(((F.col("id") * 7919) % n).alias("k"), F.concat(F.lit("row "), "id").alias("text"), F.lit(None).cast("string").alias("empty")).repartition(8)
    got = W.numbered(d, ["k"]).cache()
    assert got.where("number <> k").count() == 0 and got.count() == n and got.columns == ["k", "text", "empty", "number"]


def test_strong_components(spark):
    r = random.Random(4)
    edges = {(r.randrange(60), r.randrange(60)) for _ in range(75)} | {(100, 101), (101, 102), (102, 100), (102, 103)}
    got = {x["node"]: x["component"] for x in G.strong_components(spark.createDataFrame(list(edges), "a long, b long")).collect()}
    after = {}
    for v in {x for e in edges for x in e}:
        seen, todo = {v}, [v]
        while todo:
            x = todo.pop()
            for a, b in edges:
                if a == x and b not in seen:
                    seen.add(b)
                    todo.append(b)
        after[v] = seen
    assert got == {v: min(x for x in seen if v in after[x]) for v, seen in after.items()}


def test_co_participation_deals_large_groups(spark, monkeypatch):
    monkeypatch.setattr(J, "PART", 3)
    m = [(1, x) for x in range(10)] + [(2, x) for x in range(5, 12)]
    got = {(r["a"], r["b"]): r["weight"] for r in J.co_participation(spark.createDataFrame(m, "g int, p int"), "g", "p").collect()}
    want = Counter((a, b) for g in (1, 2) for a in (x for h, x in m if h == g) for b in (x for h, x in m if h == g) if a < b)
    assert got == dict(want)


def test_labels(spark):
    good = ["ph", "tissue type", "dose %", "age", "Cell-line", "a/b", "RNA", "-start"]
    bad = ["", "x", "(open", "12.5 - 3", "a/b/c", "www.x", "!!", "end;", "Tg(x)", "AB12 (x)", "ABC123", "a____", "y" * 101, "http x"]
    d = spark.createDataFrame([(x,) for x in good + bad], "x string")
    assert {r["x"] for r in d.where(X.meaningful_label("x")).collect()} == set(good)
    one = lambda v: spark.createDataFrame([(v,)], "label string").select(M.categorize(F.col("label"), RULES).alias("c")).first()["c"]
    assert one("Patient barcode")[:2] == ("External_sample_id", "MEDIUM") and one("the age")[:2] == ("Biospecimen Age", "HIGH")
    assert one("stage x")[:2] == ("Biospecimen Age", "MEDIUM") and one("subgroup")[:2] == ("Treatment", "LOW") and one("qqq") is None
    assert one("strain dose")[:2] == ("Biospecimen Organism", "HIGH") and one("mystrain tissue")[:2] == ("Biospecimen Type", "HIGH")


def test_files(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.json", '{"results": [{"a": 1}, {"a": 2}]}')
    assert R.read_zipped_json(spark, str(tmp_path / "a.zip"), "results").select(F.get_json_object("record", "$.a").cast("int")).toPandas().iloc[:, 0].tolist() == [1, 2]
    (tmp_path / "eav" / "GSE1").mkdir(parents=True)
    (tmp_path / "eav" / "GSE1" / "t.csv").write_text("Primary_category,Attribute,Content\nSample,title,\"['one', 'two']\"\nSample,none,oops\n")
    assert rows(R.read_attributes(spark, str(tmp_path / "eav"))) == [("GSE1", "Sample", "none", []), ("GSE1", "Sample", "title", ["one", "two"])]
    (tmp_path / "y2019.csv").write_text("id\n1\n")
    assert rows(R.read_years(spark, str(tmp_path / "y2019.csv"), "id int")) == [(1, 2019)]
    (tmp_path / "latin.csv").write_bytes("id,n\n1,é\nbad,x\n".encode("latin-1"))
    assert rows(R.read_delimited(spark, str(tmp_path / "latin.csv"), "id int, n string", encoding="ISO-8859-1", drop_bad_lines=True)) == [(1, "é")]


def test_stream_upserts_are_idempotent(spark, tmp_path):
    schema = "k long, v string, at long"
    make = lambda r: spark.createDataFrame(r, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    run = lambda: I.upsert_stream(spark, f"file://{tmp_path}/in", schema, f"file://{tmp_path}/t", f"file://{tmp_path}/c", "k", "at", "latest")
    make([(1, "a", 1), (2, "b", 5), (1, "c", 3)])
    assert rows(run()) == [(1, "c", 3), (2, "b", 5)]
    make([(2, "old", 2), (3, "d", 1), (None, "n", 9)])
    assert rows(run()) == [(1, "c", 3), (2, "b", 5), (3, "d", 1)]
    assert rows(run()) == [(1, "c", 3), (2, "b", 5), (3, "d", 1)]


def test_alerts(spark):
    subs = spark.createDataFrame([("u", 1), ("u", 2), ("w", 3)], "user string, topic int")
    news = spark.createDataFrame([(1, "a", "2020-01-01"), (1, "b", "2020-01-02"), (2, "a", "2019-12-31"), (3, "a", "2020-01-02")], "topic int, kind string, d string")
    got = I.alert_counts(subs, "user", "topic", news, "kind", "d", "2020-01-01", "2020-01-02", ["a", "b"])
    assert rows(got) == [("u", 1, 1, 1, 2), ("w", 3, 1, 0, 1)]

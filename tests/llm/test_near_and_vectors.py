"""SimHash, vector codes and hard negatives against brute force: nulls, ties, repeated rows, empty tables, other columns."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from veinloom.llm import hard_negatives, simhash, vector_codes
from veinloom.llm import registry

SF = "/root/testdata/sf0.01"
EMBEDDINGS = "vec_id long, embedding array<float>, label int, fp long, _id string, _label string, node long, code string, score long"
EXTRA = (1, "x", "y", 2, "z", 3)


def text_of(r, n):
    return " ".join(r.choice("abcdefghijklmnopqrstuvwxyz") * r.randint(1, 3) for _ in range(n))


def brute_print(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_simhash(rows, radius=3):
    """(doc_id, fingerprint, component) of every row, with multiplicity."""
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return Counter((k, f"{prints[i]:016x}", least.get(find(i))) for i, (k, _) in enumerate(rows))


@pytest.fixture(scope="module")
def simhash_rows():
    r = random.Random(3)
    base = text_of(r, 400)
    rows = [(k, text_of(r, r.randint(1, 60))) for k in range(100, 140)]
    rows += [(k, " ".join(w if i != 7 * k else "changed" for i, w in enumerate(base.split(" ")))) for k in range(50)]
    rows += [(200, None), (201, ""), (202, " \n\t"), (203, base.upper()), (203, base), (203, base), (204, "two words"), (205, "Two\x0bWORDS"), (206, "one"), (207, "é" * 40), (208, "É" * 40)]
    rows += [(None, base + " tail of a row without an id"), (None, "alone without an id " * 9), (300, text_of(r, 200_000))]
    return rows


@pytest.mark.parametrize("large, radius", [(1 << 15, 3), (6, 3), (1 << 15, 5), (3, 2)])
def test_simhash(spark, simhash_rows, large, radius, monkeypatch):
    """With a low bound for large shards, trees are cut to pieces and broadcast, in more than one block."""
    monkeypatch.setattr(simhash, "BROADCAST", 40)
    df = spark.createDataFrame([(*x, 1, 2, 3) for x in simhash_rows], "doc_id long, text string, fp long, node long, _id long").repartition(3)
    found = Counter(tuple(x) for x in simhash.near_copies(df, radius=radius, large=large).collect())
    assert found == brute_simhash(simhash_rows, radius)


def test_simhash_query_on_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert Counter(tuple(x) for x in registry.queries()["op11_simhash"](spark, SF).collect()) == brute_simhash([tuple(x) for x in docs])


def test_no_bits_lose_a_link():
    r = np.random.default_rng(2)
    for n in (10, 1 << 29, 1 << 40):
        masks = np.array(simhash.plan(n), dtype=np.uint64)
        for _ in range(300):
            a = r.integers(0, 1 << 63, dtype=np.uint64)
            b = a ^ np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, 3).astype(np.uint64))
            assert ((a & masks) == (b & masks)).any()
    assert simhash.plan(0)


def test_forest_follows_only_edges_within_the_radius():
    r = np.random.default_rng(4)
    prints = np.unique(r.integers(0, 1 << 63, 4000, dtype=np.uint64))
    forest = simhash.Forest(np.zeros(len(prints), dtype=np.int64), prints)
    parent, edge = np.divmod(forest.edges, 65)
    assert (np.bitwise_count(prints[parent] ^ prints[forest.children]) == edge).all() and len(np.unique(forest.edges)) == len(prints) - 1
    near = prints[:300] ^ (np.uint64(1) << r.integers(0, 64, 300).astype(np.uint64))
    found = {(int(q), int(n)) for a, b in forest.near(near, np.zeros(300, dtype=np.int64), 3) for q, n in zip(a, b)}
    assert found == set(zip(*map(np.ndarray.tolist, np.nonzero(np.bitwise_count(near[:, None] ^ prints[None, :]) <= 3))))


def vectors(seed, n, width=8, scale=0.3):
    r = np.random.default_rng(seed)
    out = [(int(k), [float(x) for x in np.float32(r.normal(size=width) * scale)], int(r.integers(0, 10))) for k in range(n)]
    for k in range(40, 60):  # ties: equal vectors under several ids and labels
        out[k] = (k, out[40][1], k % 3)
    return out


BAD = [(9_001, None, 1), (9_002, [0.1] * 7 + [None], 1), (9_003, [0.1] * 7 + [float("nan")], 1), (9_004, [float("-inf")] + [0.1] * 7, 1)]


def brute_codes(rows):
    kept = sorted(((k, v, y) for k, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)), key=lambda t: (t[0] is None, t[0], t[1]))
    parts = [[[math.floor(1024 * x) for x in v[p * len(v) // 4 : (p + 1) * len(v) // 4]] for _, v, _ in kept] for p in range(4)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda book, v: min(range(len(book)), key=lambda i: (distance(book[i], v), i))
    books = [p[:256] for p in parts]
    for _ in range(4):
        for p in range(4):
            members = {}
            for v in parts[p]:
                members.setdefault(nearest(books[p], v), []).append(v)
            books[p] = [[sum(c) // len(members[i]) for c in zip(*members[i])] if i in members else e for i, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = []
    for i, (k, _, y) in enumerate(kept):
        at = [nearest(books[p], parts[p][i]) for p in range(4)]
        coded.append((k, "".join(f"{a:02x}" for a in at), sum(distance(books[p][a], parts[p][i]) for p, a in enumerate(at)), y))
    total = Counter()
    for _, _, e, y in coded:
        total[y] += e
    return Counter((k, c, e, total[y], sha) for k, c, e, y in coded)


@pytest.mark.parametrize("n", [330, 70])
def test_vector_codes(spark, n):
    rows = vectors(n, n) + BAD + [(None, [0.5] * 8, 3), (3, [0.25] * 8, None), (3, [0.25] * 8, None)]
    df = spark.createDataFrame([(*x, *EXTRA) for x in rows], EMBEDDINGS).repartition(3)
    assert Counter(tuple(x) for x in vector_codes.compress(df).collect()) == brute_codes(rows)


def test_annulus_keeps_what_lies_on_its_edge():
    """Entries and vectors on one line through zero: every bound is reached exactly, and ties go to the lower index."""
    entries = np.array([[float(x), 0.0] for x in [*range(-40, 41, 4), *range(-40, 41, 4)]])
    v = np.array([[float(x), 0.0] for x in range(-60, 61)])
    index, best = vector_codes.Codebook(entries).nearest(v)
    all_ = ((v[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (index == all_.argmin(axis=1)).all() and (best == all_.min(axis=1)).all()


def test_vectors_that_cannot_be_cut_are_refused(spark):
    for bad in ([(1, [0.1] * 6)], [(1, [0.1] * 8), (2, [0.1] * 4)], [(1, [1e30] * 8)]):
        df = spark.createDataFrame([(k, v, 1) for k, v in bad], "vec_id long, embedding array<double>, label int").coalesce(1)
        with pytest.raises(Exception, match="parts|lengths|large"):
            vector_codes.compress(df).collect()


def brute_negatives(rows, every=100):
    kept = [(k, (y + 1) % 10 if k % 7 == 0 else y, [math.floor(256 * x) for x in v]) for k, v, y in rows if k is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out, done = Counter(), []
    for k, y, v in kept:
        if k % every or (k, y, v) in done:
            continue
        done.append((k, y, v))
        ranked = sorted((-score(v, w), j, z) for j, z, w in kept if j != k)
        for s, j, _ in [t for t in ranked if t[2] == y][:5]:
            inside = [t for t in ranked if t[2] != y and 80 * -s <= 100 * -t[0] <= 100 * -s][:5]
            for rank, (m, q, _) in enumerate(inside, 1):
                out[k, j, rank, q, -s, -m] += 1
    return out


@pytest.mark.parametrize("every, numbers", [(10, 1 << 22), (10, 80), (2, 1 << 22)])
def test_hard_negatives(spark, monkeypatch, every, numbers):
    """Also with blocks of a few anchors, and small leaves and batches."""
    for name, value in (("BLOCK_NUMBERS", numbers), ("ANCHOR_LEAF", 4), ("CANDIDATE_LEAF", 8), ("BATCH", 100)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(5, 400) + BAD + [(None, [0.5] * 8, 3), (4, [0.25] * 8, None), (6, [0.25] * 8, 2), (6, [0.25] * 8, 2), (20, [0.0] * 8, 4), (20, [0.0] * 8, 4), (700, [-0.9] * 8, 11), (1400, [0.9] * 8, 11)]
    df = spark.createDataFrame([(*x, *EXTRA) for x in rows], EMBEDDINGS).repartition(3)
    assert Counter(tuple(x) for x in hard_negatives.mine(df, every=every).collect()) == brute_negatives(rows, every)


def test_node_intervals_hold_all_products():
    r = np.random.default_rng(6)
    a, b = (np.floor(256 * r.normal(size=(n, 12))) for n in (200, 300))
    x, y = hard_negatives.BallTree(a, 8), hard_negatives.BallTree(b, 16)
    every = a @ b.T
    for i in range(len(x.radius)):
        low, high = hard_negatives.interval(x, i, y, np.arange(len(y.radius)))
        for j in range(len(y.radius)):
            under = every[np.ix_(x.order[slice(*x.range[i])], y.order[slice(*y.range[j])])]
            assert low[j] <= under.min() and under.max() <= high[j]


def test_empty_tables(spark):
    none = spark.createDataFrame([], EMBEDDINGS)
    assert vector_codes.compress(none).count() == 0 and hard_negatives.mine(none).count() == 0
    assert simhash.near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    bad = spark.createDataFrame([(*x, *EXTRA) for x in BAD], EMBEDDINGS)
    assert vector_codes.compress(bad).count() == 0 and hard_negatives.mine(bad).count() == 0

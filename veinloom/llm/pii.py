"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs the labelers, and
a span classifier trained on its posteriors decides. DataFrame and SQL functions only.

Candidates are the matches of the base patterns and of wider ones (local phone numbers, e-mail addresses written with
words, numbers of a card's length inside longer runs of digits, secrets, account and social security numbers). What the base rules accept always stays; wider candidates are added
if the classifier accepts them and they touch no base span.

Fitting works on counts of vote patterns, of which there are at most SOURCES * 3 ** LABELERS * 2 ** SPAN_FEATURES, so that table is bounded
whatever the corpus, and is fetched.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veinloom.llm.storage import table, written

# The base patterns, in forms that find the same matches without backtracking.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# The wider patterns.
WORDED_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}+){1,4}+"
LOCAL_PHONE = r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
DIALLED_PHONE = r"(?<![0-9A-Za-z+.-])00[1-9][\x20().0-9-]{7,20}+(?<=[0-9])"
SECRET = r"(?i)(?<![A-Za-z0-9])(?:token|password|passwd|secret|api[_-]?key)\x20?[=:]\x20?\"?[A-Za-z0-9_/+-]{8,200}+\"?"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

CARD_NUMBER = r"(?<![0-9])(?:[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{13,19})(?![0-9])"

#: Sources of candidates: name, pattern, kind of the span, and a cheap test that any text with a match passes.
SOURCES = (
    ("email", EMAIL, "email", lambda t: t.contains("@")),
    ("ip", IP, "ip", lambda t: t.rlike(r"[0-9]\.[0-9]")),
    ("card", CARD, "card", lambda t: t.rlike("[0-9]")),
    ("phone", PHONE, "phone", lambda t: t.contains("+")),
    ("worded_email", WORDED_EMAIL, "email", lambda t: t.contains(" dot ") | t.contains("(dot)") | t.contains("[dot]")),
    ("local_phone", LOCAL_PHONE, "phone", lambda t: t.rlike(r"[0-9]{3}[\x20.-][0-9]{4}")),
    ("dialled_phone", DIALLED_PHONE, "phone", lambda t: t.rlike("00[1-9]")),
    ("secret", SECRET, "secret", lambda t: t.contains("=") | t.contains(":")),
    ("iban", IBAN, "iban", lambda t: t.rlike("[A-Z]{2}[0-9]{2}")),
    ("ssn", SSN, "ssn", lambda t: t.rlike("-[0-9]{2}-")),
    # Numbers of a card's length inside what the base rule takes as one and rejects, such as two cards side by side.
    ("card_number", CARD_NUMBER, "card", lambda t: t.rlike(r"[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}")),
)
BASE = ("email", "ip", "card", "phone")
KIND_ORDER = ("email", "ip", "card", "phone", "secret", "iban", "ssn")
# Gazetteers and words of the context.
TOP_DOMAINS = "com org net edu gov mil int info biz io co ai dev app de fr es it nl uk us ca au ch at be eu jp cn in br mx ru pl se no dk fi pt ie nz za kr".split()
FOR = {
    "email": "email|e-mail|mail|courriel|correo|contact|kontakt|write to|write|from|to",
    "ip": "ip|host|server|address|adresse|client|login",
    "card": "card|visa|mastercard|amex|credit|debit|carte|tarjeta|karte|kreditkarte|payment",
    "phone": "phone|tel|call|mobile|fax|cell|telefon|téléphone|teléfono|appelez|rufen|llame|ring",
    "secret": "token|password|passwd|secret|key|login|auth|bearer",
    "iban": "iban|account|konto|compte|cuenta|bank",
    "ssn": "ssn|social|security|taxpayer",
}
AGAINST = "version|section|chapter|figure|fig|page|isbn|doi|line|lines|release|build|pp|vol|ratio|score"
LABELERS = ("shape", "check", "gazetteer", "context", "border")
#: What the classifier sees of a span itself, beside the votes: yes or no each, so that patterns stay bounded.
SPAN_FEATURES = {
    "long": lambda t: F.length(t) >= 20,
    "mixed": lambda t: t.rlike("[0-9]") & t.rlike("[A-Za-z]"),
    "parted": lambda t: t.rlike(r"[\x20().-]"),
    "quoted": lambda t: t.rlike("[\"=:@]"),
}
#: A candidate beyond the base rules is a span if the classifier gives it this probability.
ACCEPT = 0.5


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    backward = F.transform(F.split(F.reverse(number), ""), lambda x: x.cast("int"))
    each = F.transform(backward, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d))
    return F.aggregate(each, F.lit(0), lambda s, d: s + d) % 10 == 0


def candidates(documents: DataFrame) -> DataFrame:
    """One row for each candidate span of each row, or one with a null source where there is none.

    A text's matches and what lies between them give the starts as running sums, in code points. The row's number stands
    for the row, so repeated ids are kept apart.
    """
    text = F.col("_text")
    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    none = F.array().cast("array<struct<source:string,i:int,text:string,gap:int,len:int,before:string,after:string>>")

    def of(name: str, pattern: str, test: Callable[[Column], Column]) -> Column:
        found, between = F.col(f"_f_{name}"), F.col(f"_b_{name}")
        item = lambda m, i: F.struct(F.lit(name).alias("source"), i.alias("i"), m.alias("text"), F.length(F.get(between, i)).alias("gap"), F.length(m).alias("len"), F.substring(F.get(between, i), -40, 40).alias("before"), F.substring(F.get(between, i + 1), 1, 12).alias("after"))
        return F.when(F.size(found) > 0, F.transform(found, item)).otherwise(none)

    for name, pattern, _, test in SOURCES:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        rows = rows.withColumn(f"_f_{name}", F.when(test(text), found))
    for name, pattern, _, test in SOURCES:
        rows = rows.withColumn(f"_b_{name}", F.when(F.size(f"_f_{name}") > 0, F.split(text, pattern, -1)))
    every = F.concat(*[of(name, pattern, test) for name, pattern, _, test in SOURCES])
    flat = rows.select("row", "doc_id", F.explode_outer(every).alias("c")).select("row", "doc_id", "c.*").repartition("row")
    upto = Window.partitionBy("row", "source").orderBy("i")
    start = F.sum(F.col("gap") + F.col("len")).over(upto) - F.col("len")
    return flat.withColumn("start", start).withColumn("end", start + F.col("len"))


def votes(spans: DataFrame) -> DataFrame:
    """Adds kind, base (accepted by the base rules) and a vote of -1, 0 or 1 of each labeler."""
    t, s = F.col("text"), F.col("source")
    d = digits(t)
    n = F.length(d)
    kind = F.coalesce(*[F.when(s == name, F.lit(k)) for name, _, k, _ in SOURCES])
    parts = F.transform(F.split(t, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3)
    ip_ok = F.forall(parts, lambda ok: ok) & F.forall(F.split(t, r"\."), lambda p: F.substring(F.regexp_replace(p, "^0+(?=.)", ""), 1, 4).cast("int") <= 255)
    card_ok = F.when(n.between(12, 19), luhn(d)).otherwise(F.lit(False))
    phone_ok = n.between(9, 15)
    base = F.when(s == "email", F.lit(True)).when(s == "ip", ip_ok).when(s == "card", card_ok).when(s == "phone", phone_ok).otherwise(F.lit(False))
    plus, minus, zero = F.lit(1), F.lit(-1), F.lit(0)
    vote = lambda good, bad=None: F.when(good, plus).when(F.lit(False) if bad is None else bad, minus).otherwise(zero)
    varied = F.size(F.array_distinct(F.split(d, ""))) > 2
    top = F.lower(F.element_at(F.split(t, r"[.\s\]\)]+"), -1))
    before = F.lower(F.col("before"))
    context = reduce(lambda c, k: c.when((kind == k) & before.rlike(rf"(?U)(?<!\w)(?:{FOR[k]})(?!\w)[^\n]{{0,25}}$"), plus), KIND_ORDER, F.when(before.rlike(rf"(?U)(?<!\w)(?:{AGAINST})\.?\s*$"), minus))
    shape = F.when(kind == "email", vote(t.rlike(r"^\S+@\S+\.[A-Za-z]{2,10}$") | t.rlike(r"(?i)dot\S*\s?[a-z]{2,10}$"), ~t.rlike("[A-Za-z]{2}"))).when(kind.isin("card", "phone", "ssn"), vote(varied, ~varied)).when(kind == "ip", vote(~t.rlike(r"(^|\.)0[0-9]"), t.rlike(r"^0\."))).when(kind == "secret", vote(t.rlike("[0-9]") & t.rlike("[=:].*[A-Za-z]"), ~t.rlike("[0-9]"))).otherwise(vote(varied))
    check = F.when(s == "email", plus).when(s == "ip", vote(ip_ok, ~ip_ok)).when(kind == "card", vote(card_ok, ~card_ok)).when(kind == "phone", vote(phone_ok, ~phone_ok)).when(kind == "secret", vote(F.length(t) >= 24, F.length(t) < 16)).when(kind == "iban", vote(F.length(F.regexp_replace(t, " ", "")).between(15, 34), F.length(F.regexp_replace(t, " ", "")) < 15)).when(kind == "ssn", vote(~t.rlike("^(000|666|9)") & ~t.rlike("-00-|0000$"), t.rlike("^(000|666|9)|-00-|0000$"))).otherwise(zero)
    gazetteer = F.when(kind == "email", vote(top.isin(*TOP_DOMAINS), top.rlike("^[0-9]+$"))).when(kind == "card", vote(d.rlike("^(4|5[1-5]|2[2-7]|3[47]|6)") & n.between(13, 19), ~n.between(12, 19))).when(kind == "phone", vote(d.rlike("^(00)?(1|33|34|44|49)") | (s == "local_phone"))).when(kind == "ip", vote(~t.rlike(r"^(0|255)\."), t.rlike(r"^(0|255)\."))).when(kind == "secret", vote(F.lower(t).rlike("^(token|password|api)"))).when(kind == "iban", vote(t.rlike("^(DE|FR|ES|IT|NL|BE|AT|CH|GB|PT|IE|PL)"))).otherwise(zero)
    border = F.when(F.col("before").rlike(r"(?U)[\w.]$") & ~kind.isin("email"), minus).when(F.col("after").rlike(r"(?U)^[\w@]"), minus).otherwise(plus)
    named = dict(zip(LABELERS, (shape, check, gazetteer, context.otherwise(zero), border)))
    seen = {f"f_{k}": F.coalesce(f(t), F.lit(False)) for k, f in SPAN_FEATURES.items()}
    return spans.withColumns({"kind": kind, "base": F.coalesce(base, F.lit(False))} | {f"v_{k}": F.coalesce(v, zero).cast("int") for k, v in named.items()} | seen)


def fit_labelers(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = 40) -> dict[tuple[str, tuple[int, ...]], float]:
    """Posterior of every vote pattern, by expectation-maximisation over what each labeler votes on true and false spans.

    patterns: (source, votes, count). Starts from the mean vote; each source has its own share of true spans, the labelers
    their reliabilities in common. One row of smoothing keeps all probabilities from 0."""
    posterior = {(s, v): 1 / (1 + math.exp(-1.5 * sum(v))) for s, v, _ in patterns}
    for _ in range(rounds):
        told = [[[1.0] * 3, [1.0] * 3] for _ in LABELERS]
        share: dict[str, list[float]] = defaultdict(lambda: [1.0, 1.0])
        for s, v, n in patterns:
            p = posterior[s, v]
            share[s][1] += p * n
            share[s][0] += (1 - p) * n
            for k, x in enumerate(v):
                told[k][1][x + 1] += p * n
                told[k][0][x + 1] += (1 - p) * n
        for s, v, _ in patterns:
            odds = math.log(share[s][1] / share[s][0])
            for k, x in enumerate(v):
                odds += math.log(told[k][1][x + 1] / sum(told[k][1])) - math.log(told[k][0][x + 1] / sum(told[k][0]))
            posterior[s, v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return posterior


def features(source: str, v: tuple[int, ...], f: tuple[bool, ...]) -> list[float]:
    return [1.0, *[float(x > 0) for x in v], *[float(x < 0) for x in v], *[float(x) for x in f], *[float(source == name) for name, *_ in SOURCES]]


def fit_classifier(patterns: list[tuple[str, tuple[int, ...], tuple[bool, ...], int]], posterior: dict, rounds: int = 400, rate: float = 0.3, penalty: float = 1e-3) -> list[float]:
    """Logistic regression of the posteriors on votes, span features and source. A pattern counts by the root of its
    number, each source the same in sum."""
    rows = [(features(s, v, f), posterior[s, v], math.sqrt(n), s) for s, v, f, n in patterns]
    width = len(features("", (0,) * len(LABELERS), (False,) * len(SPAN_FEATURES)))
    if not rows:
        return [0.0] * width
    total: dict[str, float] = defaultdict(float)
    for _, _, n, s in rows:
        total[s] += n
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    share = np.array([n / total[s] / len(total) for _, _, n, s in rows])
    w, memory = np.zeros(width), np.full(width, 1e-8)
    for _ in range(rounds):
        g = penalty * w + x.T @ ((1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) - y) * share)
        memory += g * g
        w -= rate * g / np.sqrt(memory)
    return w.tolist()


def probability(weights: list[float]) -> Column:
    """The classifier as one expression of votes, span features and source."""
    k, n = len(LABELERS), len(SPAN_FEATURES)
    z = F.lit(weights[0])
    for i, name in enumerate(LABELERS):
        z = z + F.when(F.col(f"v_{name}") > 0, F.lit(weights[1 + i])).when(F.col(f"v_{name}") < 0, F.lit(weights[1 + k + i])).otherwise(F.lit(0.0))
    for i, name in enumerate(SPAN_FEATURES):
        z = z + F.when(F.col(f"f_{name}"), F.lit(weights[1 + 2 * k + i])).otherwise(F.lit(0.0))
    for i, (name, *_) in enumerate(SOURCES):
        z = z + F.when(F.col("source") == name, F.lit(weights[1 + 2 * k + n + i])).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def find_spans(documents: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """row, doc_id, kind, start, end, base and probability of every span that stays, and one row with a null kind for each
    row of documents without any candidate.

    A null text is empty. A null id is kept. Repeated rows are searched each; other columns are not read; an empty table
    gives no rows. Shuffled once by row: candidates with 40 characters of context, not texts.
    """
    seen = [*[f"v_{k}" for k in LABELERS], *[f"f_{k}" for k in SPAN_FEATURES]]
    voted = written(votes(candidates(documents)).select("row", "doc_id", "source", "kind", "start", "end", "base", *seen), "spans")
    counted = voted.where("source is not null").groupBy("source", *seen).agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = sorted((r["source"], tuple(r[f"v_{k}"] for k in LABELERS), tuple(r[f"f_{k}"] for k in SPAN_FEATURES), r["n"]) for r in counted)
    votes_only: dict[tuple, int] = defaultdict(int)
    for s, v, _, n in patterns:
        votes_only[s, v] += n
    weights = fit_classifier(patterns, fit_labelers([(s, v, n) for (s, v), n in votes_only.items()]))
    scored = voted.withColumn("probability", F.when(F.col("source").isNotNull(), probability(weights)))
    by_row = Window.partitionBy("row").orderBy("start", "end", "source")
    # A number of a card's length that fails the Luhn check is no card, whatever the other labelers say.
    wide = (~F.col("source").isin(*BASE)) & (F.col("probability") >= accept) & ~((F.col("source") == "card_number") & (F.col("v_check") < 0))
    scored = scored.repartition("row")
    left = F.max(F.when(F.col("base"), F.col("end"))).over(by_row.rowsBetween(Window.unboundedPreceding, -1))
    right = F.min(F.when(F.col("base"), F.col("start"))).over(by_row.rowsBetween(1, Window.unboundedFollowing))
    touched = (F.coalesce(left, F.lit(-1)) > F.col("start")) | (F.coalesce(right, F.lit(1 << 60)) < F.col("end"))
    # Among wider spans that are left, one that begins inside an earlier one goes.
    kept = scored.withColumn("_keep", F.col("base") | (wide & ~touched))
    earlier = F.max(F.when(F.col("_keep") & ~F.col("base"), F.col("end"))).over(by_row.rowsBetween(Window.unboundedPreceding, -1))
    kept = kept.withColumn("_keep", F.col("_keep") & (F.col("base") | (F.coalesce(earlier, F.lit(-1)) <= F.col("start"))))
    on = F.coalesce(F.col("_keep"), F.lit(False))
    return kept.select("row", "doc_id", F.when(on, F.col("kind")).alias("kind"), "start", "end", F.coalesce("base", F.lit(False)).alias("base"), "probability")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of documents: counts of base spans by kind, all spans, and how many of them are secrets."""
    spans = find_spans(table(spark, sf_dir, "documents"))
    order = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(KIND_ORDER)])
    item = F.struct(F.col("start"), order.alias("o"), F.col("end"), F.col("kind"))
    listed = lambda c: F.array_join(F.transform(F.array_sort(c), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    is_base = F.col("base") & F.col("kind").isNotNull()
    counts = [F.count(F.when(is_base & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE]
    grouped = spans.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *counts, F.collect_list(F.when(is_base, item)).alias("_base"), F.collect_list(F.when(F.col("kind").isNotNull(), item)).alias("_all"))
    secrets = F.size(F.filter("_all", lambda x: x["kind"] == "secret")).cast("long")
    return grouped.select("doc_id", *[f"n_{k}" for k in BASE], F.sha2(listed("_base"), 256).alias("base_sha256"), listed("_all").alias("spans"), F.size("_all").cast("long").alias("n_spans"), secrets.alias("n_secret"))


QUERIES: dict[str, Callable] = {"op1_pii": op1_pii}
ORACLES: dict[str, str] = {}

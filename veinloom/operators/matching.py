"""Dictionary matching in free text, its scores, keyword categories and annotation clean-up."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from veinloom.functions import text as X
from veinloom.functions import values as V
from veinloom.functions.stem import stem


def term_dictionary(entities: DataFrame, key: str, name: str, synonyms: str, common_words: DataFrame) -> DataFrame:
    """key and term: name and synonyms, normalised, without short single words and without single words of the
    dictionary of common words (one column `word`)."""
    terms = entities.select(key, F.explode(F.array_union(F.array(F.col(name)), F.coalesce(synonyms, F.array().cast("array<string>")))).alias("_t"))
    terms = terms.select(key, X.normalize_term("_t").alias("term")).where(X.term_long_enough("term") & ~X.short_single_word("term")).distinct()
    return terms.join(common_words.select(F.col("word").alias("term")), "term", "left_anti").select(key, "term")


#: Characters of the terms that an automaton is made of, some 100 MB of it; a larger dictionary is searched for in blocks.
BLOCK_CHARS = 2_000_000


class TermFinder:
    """Counts all terms of a dictionary in one pass over a text.

    A term is in a text that contains it and has each of its words as a token. Terms without a blank are counted as tokens,
    others wherever they stand, without overlaps from the left. Names and terms are parallel; a term may have several names,
    and a name several terms, whose counts are added.
    """

    def __init__(self, names: list[int], terms: list[str]):
        import ahocorasick

        of: dict[str, list[int]] = {}
        for name, term in zip(names, terms):
            of.setdefault(term, []).append(name)
        self.words = re.compile(r"\w+")
        self.terms = [(term, own, self.words.findall(term)) for term, own in of.items()]
        self.automaton = ahocorasick.Automaton()
        for i, (term, _, words) in enumerate(self.terms):
            if words and (" " in term or words == [term]):  # a term without a blank is a token, or nowhere
                self.automaton.add_word(term, i)
        if len(self.automaton):
            self.automaton.make_automaton()

    def count(self, text: str) -> dict[int, int]:
        """Number of the name to its count; only names that occur."""
        if not len(self.automaton):
            return {}
        found: dict[int, list[int]] = {}  # number of the term: its count, the end of its last occurrence
        for last, i in self.automaton.iter(text):
            term = self.terms[i][0]
            start = last + 1 - len(term)
            if " " in term:
                seen = found.setdefault(i, [0, 0])
                if start >= seen[1]:
                    seen[0] += 1
                    seen[1] = last + 1
            elif not (start and _of_word(text[start - 1])) and not (last + 1 < len(text) and _of_word(text[last + 1])):
                found.setdefault(i, [0, 0])[0] += 1
        tokens, out = None, {}
        for i, (n, _) in found.items():
            term, names, words = self.terms[i]
            if " " in term:
                tokens = tokens or set(self.words.findall(text))
                if not tokens.issuperset(words):
                    continue
            for name in names:
                out[name] = out.get(name, 0) + n
        return out


def _of_word(c: str) -> bool:
    return c.isalnum() or c == "_"


#: The automaton that a worker made last, by the block it is of.
_FINDER: dict = {}


def _finder(sent) -> tuple[pa.Array, TermFinder]:
    if sent.id not in _FINDER:
        _FINDER.clear()
        names, of, terms = sent.value
        _FINDER[sent.id] = names, TermFinder(of, terms)
    return _FINDER[sent.id]


class _Sent:
    """A broadcast block of a dictionary, with a name that workers know it by."""

    def __init__(self, spark: SparkSession, block: tuple):
        self.id, self._sent = uuid.uuid4().hex, spark.sparkContext.broadcast(block)

    @property
    def value(self) -> tuple:
        return self._sent.value


def match_terms(texts: DataFrame, keys: list[str], text: str, terms: DataFrame, name: str, term: str) -> DataFrame:
    """keys, name and n: how often a name's terms occur in each text, in lower case on both sides; see TermFinder.

    Map-only: the dictionary is broadcast, in blocks of a bounded number of characters by a hash of the name, each of which
    is one more pass over the texts; a text is read once for all terms of a block. Null texts have no terms, null names and
    terms are left out. Rows of equal keys are texts of their own.
    """
    spark = texts.sparkSession
    low = texts.select(*keys, F.lower(F.col(text)).alias("_text"))
    dictionary = terms.where(F.col(name).isNotNull() & F.col(term).isNotNull()).select(F.col(name).alias("_name"), F.lower(F.col(term)).alias("_term")).distinct()
    blocks = 1 + (dictionary.agg(F.sum(F.length("_term") + F.length(F.col("_name").cast("string")))).first()[0] or 0) // BLOCK_CHARS
    kind = T.StructType([*low.drop("_text").schema.fields, T.StructField(name, dictionary.schema["_name"].dataType), T.StructField("n", T.LongType())])
    out = None
    for k in range(blocks):
        block = dictionary.where(F.pmod(F.xxhash64("_name"), F.lit(blocks)) == k).toArrow() if blocks > 1 else dictionary.toArrow()
        names = block.column(0).combine_chunks().dictionary_encode()
        sent = _Sent(spark, (names.dictionary, names.indices.to_pylist(), block.column(1).to_pylist()))
        found = low.mapInArrow(partial(_count_terms, sent=sent), kind)
        out = found if out is None else out.unionByName(found)
    return out


def _count_terms(batches: Iterator[pa.RecordBatch], sent: _Sent) -> Iterator[pa.RecordBatch]:
    names, finder = _finder(sent)
    for batch in batches:
        rows, of, n = [], [], []
        for row, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            for i, count in finder.count(text).items() if text else ():
                rows.append(row), of.append(i), n.append(count)
        at = pa.array(rows, pa.int64())
        columns = [c.take(at) for c in batch.columns[:-1]]
        yield pa.RecordBatch.from_arrays([*columns, names.take(pa.array(of, pa.int64())), pa.array(n, pa.int64())], names=[*batch.schema.names[:-1], "_name", "n"])


def last_contained(texts: DataFrame, key: str, text: str, names: DataFrame, order: str, name: str) -> DataFrame:
    """key and name: of the names that a text holds anywhere, in lower case, that of the largest order (ties: the greatest
    name). Texts without one, and null or empty names, are left out. Map-only but for a dictionary of several blocks."""
    import ahocorasick  # noqa: F401  (fails here rather than in tasks)

    spark = texts.sparkSession
    low = texts.select(key, F.lower(F.col(text)).alias("_text")).where("_text is not null")
    listed = names.where(F.col(order).isNotNull()).groupBy(F.lower(F.col(name)).alias("_name")).agg(F.max(order).alias("_order")).where("_name <> ''")
    blocks = 1 + (listed.agg(F.sum(F.length("_name"))).first()[0] or 0) // BLOCK_CHARS
    found = None
    for k in range(blocks):
        block = listed.where(F.pmod(F.xxhash64("_name"), F.lit(blocks)) == k).orderBy("_order", "_name").select("_name", "_order").toArrow()
        sent = _Sent(spark, (block.column(1).combine_chunks(), block.column(0).to_pylist()))
        kind = T.StructType([low.schema[key], T.StructField("_order", listed.schema["_order"].dataType), T.StructField("_name", T.StringType())])
        one = low.mapInArrow(partial(_last_of, sent=sent), kind)
        found = one if found is None else found.unionByName(one)
    if blocks > 1:
        found = found.groupBy(key).agg(F.max(F.struct("_order", "_name")).alias("_s")).select(key, "_s.*")
    return found.select(key, F.col("_name").alias(name))


def _last_of(batches: Iterator[pa.RecordBatch], sent: _Sent) -> Iterator[pa.RecordBatch]:
    import ahocorasick

    if sent.id not in _FINDER:
        _FINDER.clear()
        orders, names = sent.value
        automaton = ahocorasick.Automaton()
        for i, x in enumerate(names):
            automaton.add_word(x, i)
        if names:
            automaton.make_automaton()
        _FINDER[sent.id] = orders, pa.array(names, pa.string()), automaton
    orders, names, automaton = _FINDER[sent.id]
    for batch in batches:
        best = [max((i for _, i in automaton.iter(x)), default=-1) if len(names) else -1 for x in batch.column(1).to_pylist()]
        rows = pa.array([r for r, i in enumerate(best) if i >= 0], pa.int64())
        at = pa.array([i for i in best if i >= 0], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), orders.take(at), names.take(at)], names=[batch.schema.names[0], "_order", "_name"])


def stemmed(x: Column) -> Column:
    """In lower case, without punctuation, each word's stem."""
    return stem(F.regexp_replace(F.lower(x), r"(?U)[^\w\s]", ""))


def match_both(texts: DataFrame, keys: list[str], text: str, terms: DataFrame, name: str, term: str, stems: bool = True, orders: bool = False) -> DataFrame:
    """keys, name and n: counts of the terms as they are, to which those of stemmed terms in the stemmed text are added;
    with orders, terms of two words count in both orders. `keys` have to be unique."""
    of = lambda c: F.array_distinct(X.term_orders(c)) if orders else F.array(c)
    variants = lambda c: terms.select(F.col(name).alias("_of"), F.explode(of(c)).alias("_variant")).where("_variant <> ''").distinct()
    found = match_terms(texts, keys, text, variants(F.lower(F.col(term))), "_of", "_variant")
    if stems:
        by_stem = match_terms(texts.withColumn(text, stemmed(F.col(text))), keys, text, variants(stemmed(F.col(term))), "_of", "_variant")
        found = found.unionByName(by_stem).groupBy(*keys, "_of").agg(F.sum("n").alias("n"))
    return found.select(*keys, F.col("_of").alias(name), "n")


def without_contained(found: DataFrame, keys: list[str], name: str, always: bool = False) -> DataFrame:
    """Rows whose name is in no other name of the same keys that has at least their count; with always, whatever its count.
    What is compared are the few names that a text has."""
    own = F.struct(F.col(name).alias("name"), F.col("n").alias("n"))
    listed = found.groupBy(*keys).agg(F.collect_list(own).alias("_all"))
    inside = lambda x, y: (x["name"] != y["name"]) & y["name"].contains(x["name"]) & (F.lit(always) | (x["n"] <= y["n"]))
    kept = F.filter("_all", lambda x: ~F.exists("_all", lambda y: inside(x, y)))
    return listed.select(*keys, F.explode(kept).alias("_one")).select(*keys, F.col("_one.name").alias(name), F.col("_one.n").alias("n"))


# Weights of a text's first sentence, of those on goals, on the future and all others, and the factors of the
# sources.
ROLE_WEIGHTS = {"first": 5, "goal": 7, "future": 3, "present": 1}
SOURCE_FACTORS = {"title": 20, "statement": 2, "abstract": 1}


def match_cascade(texts: DataFrame, key: str, sources: list[str], terms: DataFrame, name: str, term: str, stems: bool = False) -> DataFrame:
    """key, name, n and source: matches in the first of the sources that has any, for each key.

    The first source is a title: names count once, terms of two words in both orders, and a name inside another one goes.
    The others are cut into the sentences of each role, joined; terms count as they are there, a name inside another goes if
    it has not the larger count, and what is left is weighted by the role and added up. With stems the counts of stemmed
    terms are added in each text. `key` has to be unique.
    """
    title = match_both(texts, [key], sources[0], terms, name, term, stems, orders=True)
    found = without_contained(title, [key], name, always=True).select(key, name, F.lit(1).cast("long").alias("n"), F.lit(0).alias("_rank"))
    roled = texts.select(key, *[_with_role(F.col(c)).alias(f"_roles_{k}") for k, c in enumerate(sources[1:], 1)])
    place = F.array(*[F.struct(F.lit(k).alias("_rank"), F.lit(w).alias("_weight"), _of_role(F.col(f"_roles_{k}"), r).alias("_text")) for k in range(1, len(sources)) for r, w in ROLE_WEIGHTS.items()])
    parts = roled.select(key, F.explode(place).alias("_p")).select(key, "_p.*").where("_text <> ''")
    several = without_contained(match_both(parts, [key, "_rank", "_weight"], "_text", terms, name, term, stems), [key, "_rank", "_weight"], name)
    summed = several.groupBy(key, "_rank", name).agg(F.sum(F.col("_weight") * F.col("n")).alias("n"))
    every = found.unionByName(summed.select(key, name, "n", "_rank"))
    of = F.element_at(F.array(*map(F.lit, sources)), F.col("_rank") + 1)
    return every.withColumn("_first", F.min("_rank").over(Window.partitionBy(key))).where("_rank = _first").select(key, name, "n", of.alias("source"))


def confidence_score(n: Column, source: Column) -> Column:
    """Title hits score 1; others by their halved weighted count, twice as much in the statement, on a logarithmic scale."""
    raw = F.when(source == "title", F.lit(SOURCE_FACTORS["title"])).when(source == "statement", V.halved_score(n, SOURCE_FACTORS["statement"])).otherwise(V.halved_score(n, SOURCE_FACTORS["abstract"]))
    return V.log_normalized(raw)


def rule_list(rules: list[tuple[str, list[str], list[str], list[str]]]) -> list[tuple[str, str, str, str]]:
    """(kind, text, category, confidence) in order of precedence, from (category, exact words, keywords, patterns).

    Category after category: exact words HIGH, keywords MEDIUM, patterns MEDIUM if they are about ids or ages and LOW
    otherwise; but an exact match of the category behind it outdoes a pattern."""
    out, patterns = [], []
    for name, exact, keywords, own in rules:
        out += [("exact", e.lower(), name, "HIGH") for e in exact]
        out += patterns
        out += [("keyword", k.lower(), name, "MEDIUM") for k in keywords]
        patterns = [("pattern", p, name, "MEDIUM" if "id" in p or "age" in p else "LOW") for p in own]
    return out + patterns


def categorize(label: Column, rules: list[tuple[str, list[str], list[str], list[str]]]) -> Column:
    """A struct of category, confidence and what matched of the first rule that takes the label; null if none does. An
    exact word has to be the label or one of its words, a keyword a part of it, a pattern is searched for in it."""
    low = F.trim(F.lower(label))
    words = F.split(low, r"\s+")
    named = ("kind", "text", "category", "confidence")
    every = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(named, rule)]) for rule in rule_list(rules)])
    takes = lambda r: F.when(r["kind"] == "exact", (low == r["text"]) | F.array_contains(words, r["text"])).when(r["kind"] == "keyword", low.contains(r["text"])).otherwise(F.regexp_like(low, r["text"]))
    return F.get(F.transform(F.filter(every, takes), lambda r: F.struct(r["category"].alias("category"), r["confidence"].alias("confidence"), r["text"].alias("match"))), F.lit(0))


# Words that stand in for a tagger: of negation, of the past, of goals and of the future.
_OUT = r"[^\p{L}\p{N}\p{M}\p{Pc}]"
NEGATED, PAST = rf"(^|{_OUT})(not|no|never|without|cannot)({_OUT}|$)|n't({_OUT}|$)", rf"(^|{_OUT})(was|were|had|did)({_OUT}|$)"
GOAL, FUTURE = "the goal of|aim", rf"(^|{_OUT})(will|shall|going to)({_OUT}|$)"


def _with_role(text: Column) -> Column:
    """The sentences as structs of role and x: first, goal, future or present; null for one that is negated or past."""
    low = F.lower
    role = lambda x, i: F.when(low(x).rlike(NEGATED) | low(x).rlike(PAST), None).when(i == 0, "first").when(low(x).rlike(GOAL), "goal").when(low(x).rlike(FUTURE), "future").otherwise("present")
    return F.transform(X.sentences(text), lambda x, i: F.struct(role(x, i).alias("role"), x.alias("x")))


def _of_role(sentences: Column, role: str) -> Column:
    return F.array_join(F.transform(F.filter(sentences, lambda s: s["role"] == role), lambda s: s["x"]), " ")


def sentence_roles(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, and the joined sentences of each role; an approximation by words, where a tagger would be better."""
    roled = texts.select(key, _with_role(F.col(text)).alias("_roles"))
    return roled.select(key, *[_of_role(F.col("_roles"), r).alias(r) for r in ROLE_WEIGHTS])


# Words of incidence and prevalence.
EPIDEMIOLOGY = r"(\b(?:prevalence|incidence|per (?:100,?000|million)|epidemiolog\w*)|[0-9][0-9.]* ?%|\bin [0-9]{1,3}(?:,[0-9]{3})+)"


def annotate(texts: DataFrame, text: str, score: Column | None = None, threshold: float = 0.5) -> DataFrame:
    """row, probability and snippet of texts that a classifier takes for epidemiology. A model's score may be handed in as
    a column; without one a rule on words stands in for it."""
    rule = F.least(F.lit(1.0), F.regexp_count(F.lower(F.col(text)), F.lit(EPIDEMIOLOGY)) * 0.5)
    scored = texts.withColumn("probability", rule if score is None else score).where(F.col("probability") >= threshold)
    return scored.select("row", "probability", F.regexp_extract(F.lower(F.col(text)), EPIDEMIOLOGY, 1).alias("snippet"))


def merge_annotations(rows: DataFrame, keys: list[str], place: str) -> DataFrame:
    """One row for each annotation with the sorted set of its places, Title first."""
    order = lambda p: F.concat(F.when(p == "Title", F.lit("0")).otherwise(F.lit("1")), p)
    return rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_set(order(F.col(place)))), lambda x: F.substring(x, F.lit(2), F.length(x))).alias(f"{place}s"))


def rank_targets(texts: DataFrame, key: str, text: str, first: DataFrame, second: DataFrame, also: DataFrame | None = None) -> DataFrame:
    """Pairs of entities that share a sentence, by the number of texts in which they do, and with `also` in how many of
    these a third entity is named anywhere.

    first, second and also are tables of (entity, alias); an alias is found as match_terms finds terms."""
    sentences = texts.select(key, F.posexplode(X.sentences(text)).alias("_s", "_sentence"))
    places = [key, "_s"]
    a = match_terms(sentences, places, "_sentence", first, *first.columns).toDF(*places, "a", "_na")
    b = match_terms(sentences, places, "_sentence", second, *second.columns).toDF(*places, "b", "_nb")
    pairs = a.join(b, places).select(key, "a", "b").distinct()
    if also is None:
        return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("texts")).orderBy(F.col("texts").desc(), "a", "b")
    named = match_terms(texts, [key], text, also, *also.columns).select(key).distinct().withColumn("_also", F.lit(1))
    counted = pairs.join(named, key, "left").groupBy("a", "b").agg(F.count(F.lit(1)).alias("texts"), F.count("_also").alias("with_also"))
    return counted.orderBy(F.col("texts").desc(), "a", "b")


def cluster_profiles(members: DataFrame, cluster: str, item: str, text: str, top: int) -> DataFrame:
    """cluster, size, text (its members' texts in order of the item, ties by the text) and terms: their `top` most frequent
    words, ties by the word. Words are counted by partial aggregation; for a text as rows, as long as it may be, see
    cluster_texts."""
    listed = F.array_sort(F.collect_list(F.struct(item, text)))
    sizes = members.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"), F.array_join(F.transform(listed, lambda x: x[text]), " ").alias("text"))
    words = members.select(cluster, F.explode(X.tokens(F.lower(text))).alias("_w")).groupBy(cluster, "_w").agg(F.count(F.lit(1)).alias("_n"))
    best = words.withColumn("_r", F.row_number().over(Window.partitionBy(cluster).orderBy(F.col("_n").desc(), "_w"))).where(F.col("_r") <= top)
    terms = best.groupBy(cluster).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "_w"))), lambda x: x["_w"]).alias("terms"))
    return sizes.join(terms, cluster, "left").select(cluster, "size", "text", "terms")


def cluster_texts(members: DataFrame, cluster: str, item: str, text: str) -> DataFrame:
    """cluster, place and text: a cluster's text as the rows of its members in order, as long as it may be."""
    return members.select(cluster, F.row_number().over(Window.partitionBy(cluster).orderBy(item, text)).alias("place"), text)


def map_names(rows: DataFrame, key: str, name: str, dictionary: DataFrame, entity: str, term: str) -> DataFrame:
    """key, entity, how (exact or span) and the matched term: entities whose term is the name, in lower case, else those
    of the longest terms inside it."""
    low = rows.select(key, F.lower(F.trim(name)).alias("_low"))
    exact = low.join(dictionary.select(F.col(entity), F.lower(term).alias("_low")).distinct(), "_low").select(key, entity, F.lit("exact").alias("how"), F.col("_low").alias("term"))
    left = low.join(exact.select(key).distinct(), key, "left_anti")
    every = dictionary.select(F.col(entity), F.lower(term).alias("_term")).distinct()
    inside = match_terms(left, [key], "_low", every.select("_term", F.col("_term").alias("_t")), "_term", "_t").select(key, "_term")
    longest = inside.withColumn("_m", F.max(F.length("_term")).over(Window.partitionBy(key))).where(F.length("_term") == F.col("_m"))
    spans = longest.join(every, "_term").select(key, entity, F.lit("span").alias("how"), F.col("_term").alias("term"))
    return exact.unionByName(spans)

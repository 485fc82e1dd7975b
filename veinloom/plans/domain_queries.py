"""The composite capabilities: dictionary matching, clean-up, mapping, alerts, and loads through files and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinloom.functions import text as X
from veinloom.functions.label_words import RULES
from veinloom.operators import joins as J
from veinloom.operators import matching as M
from veinloom.operators import windows as W
from veinloom.operators.lineage import shared_dir
from veinloom.pipelines import labels as L
from veinloom.plans.base import ORACLES, QUERIES, day, money, query
from veinloom.sources import readers as R
from veinloom.streaming import incremental as I

_WORDS = r"[\p{L}\p{N}\p{M}\p{Pc}]+"
#: Names of the dictionary: the first two words of each benchmark item, and its third if it is long enough.
_NAMES = f"SELECT w[1] || ' ' || w[2] AS term FROM (SELECT regexp_extract_all(lower(text), '{_WORDS}') AS w FROM benchmark) WHERE len(w) >= 2 UNION SELECT w[3] FROM (SELECT regexp_extract_all(lower(text), '{_WORDS}') AS w FROM benchmark) WHERE length(w[3]) > 4"
#: Documents with the first sentence as title, then the statement: the next 300 characters and on to the end of their
#: sentence, then the abstract. No cut goes through a sentence. The SQL marks sentence ends.
_ENDS = "regexp_replace(regexp_replace(regexp_replace(text, '([.?!])[\\s\\x0b]', '\\1' || chr(57344), 'g'), '([A-Z][a-z]\\.)' || chr(57344), '\\1 ', 'g'), '(\\w\\.\\w[.?!])' || chr(57344), '\\1 ', 'g')"
_TITLED = f"SELECT doc_id, split_part(x, chr(57344), 1) AS title, substring(x, length(split_part(x, chr(57344), 1)) + 2) AS rest FROM (SELECT doc_id, {_ENDS} AS x FROM documents)"
_PARTS = f"SELECT doc_id AS \"row\", title, CASE WHEN p = 0 THEN rest ELSE substring(rest, 1, 299 + p) END AS statement, CASE WHEN p = 0 THEN '' ELSE substring(rest, 301 + p) END AS abstract FROM (SELECT *, strpos(substring(rest, 301), chr(57344)) AS p FROM ({_TITLED}))"


def _terms(t) -> DataFrame:
    w = X.tokens(F.lower("text"))
    both = t("benchmark").where(F.size(w) >= 2).select(F.concat_ws(" ", w[0], w[1]).alias("term"))
    return both.unionByName(t("benchmark").select(F.get(w, F.lit(2)).alias("term")).where(F.length("term") > 4)).distinct()


def _parts(t) -> DataFrame:
    cut = lambda c, n: F.split(F.regexp_replace(c, rf"(?s)^(.{{{n}}}.*?){X.SENTENCE_END_BANG}", "$1\ue000"), "\ue000", 2)
    titled = t("documents").select(F.col("doc_id").alias("row"), cut("text", 0).alias("_t"))
    rest = titled.select("row", F.col("_t")[0].alias("title"), cut(F.coalesce(F.get("_t", F.lit(1)), F.lit("")), 300).alias("_s"))
    return rest.select("row", "title", F.col("_s")[0].alias("statement"), F.coalesce(F.get("_s", F.lit(1)), F.lit("")).alias("abstract"))


def _matches(texts: str, keys: str, variants: str) -> str:
    """Rows of texts (keys, s) that have a term: all its words as tokens, and itself; and how often."""
    hits = f"SELECT {keys}, term, CASE WHEN contains(v, ' ') THEN (length(x) - length(replace(x, v, ''))) // length(v) ELSE len(list_filter(tk, lambda w: w = v)) END AS n FROM (SELECT {keys}, lower(s) AS x, regexp_extract_all(lower(s), '{_WORDS}') AS tk FROM ({texts})), ({variants}) WHERE contains(x, v) AND len(list_filter(regexp_extract_all(v, '{_WORDS}'), lambda w: NOT list_contains(tk, w))) = 0"
    return f"SELECT {keys}, term, CAST(sum(n) AS BIGINT) AS n FROM ({hits}) WHERE n > 0 GROUP BY ALL"


_PLAIN = f"SELECT term, term AS v FROM ({_NAMES})"
_ORDERS = f"{_PLAIN} UNION SELECT term, split_part(term, ' ', 2) || ' ' || split_part(term, ' ', 1) FROM ({_NAMES}) WHERE contains(term, ' ')"


@query(_matches('SELECT doc_id AS "row", text AS s FROM documents', '"row"', _PLAIN), "join_theta_substring")
def dom_gazetteer_match(t):
    """Terms that a text contains and of which it has all words as tokens, with the number of occurrences."""
    return M.match_terms(t("documents").select(F.col("doc_id").alias("row"), "text"), ["row"], "text", _terms(t), "term", "term")


def _role(place: str) -> str:
    q = lambda p: p.replace("'", "''")
    return f"CASE WHEN regexp_matches(lower(s), '{q(M.NEGATED)}') OR regexp_matches(lower(s), '{q(M.PAST)}') THEN NULL WHEN {place} = 0 THEN 5 WHEN regexp_matches(lower(s), '{q(M.GOAL)}') THEN 7 WHEN regexp_matches(lower(s), '{q(M.FUTURE)}') THEN 3 ELSE 1 END"


_SENTENCES = " UNION ALL ".join(
    f"SELECT \"row\", {k} AS rank, '{c}' AS source, place, {_role('place')} AS weight, s FROM (SELECT \"row\", list_filter(string_split({c}, chr(57344)), lambda z: trim(z, ' ') <> '') AS l, unnest(range(len(l))) AS place, l[place + 1] AS s FROM ({_PARTS}))" for k, c in ((1, "statement"), (2, "abstract"))
)
_ROLED = f"SELECT \"row\", rank, source, weight, string_agg(s, ' ' ORDER BY place) AS s FROM ({_SENTENCES}) WHERE weight IS NOT NULL GROUP BY ALL"


def _maximal(hits: str, keys: list[str], always: bool = False) -> str:
    """Without names inside others of the same keys, whose count is at least theirs."""
    same = " AND ".join(f"b.{k} = a.{k}" for k in keys)
    return f"SELECT a.* FROM ({hits}) a WHERE NOT EXISTS (SELECT 1 FROM ({hits}) b WHERE {same} AND b.term <> a.term AND contains(b.term, a.term){'' if always else ' AND a.n <= b.n'})"


_IN_TITLES = f"SELECT \"row\", 0 AS rank, 'title' AS source, term, 1 AS n FROM ({_maximal('SELECT * FROM title_hits', ['"row"'], always=True)})"
_IN_ROLES = f"SELECT \"row\", rank, source, term, CAST(sum(weight * n) AS BIGINT) AS n FROM ({_maximal('SELECT * FROM role_hits', ['"row"', 'rank', 'weight'])}) GROUP BY ALL"
_HIT_TABLES = f"""title_hits AS MATERIALIZED ({_matches(f'SELECT "row", title AS s FROM ({_PARTS})', '"row"', _ORDERS)}), role_hits AS MATERIALIZED ({_matches(_ROLED, '"row", rank, source, weight', _PLAIN)})"""
_FIRST_HITS = f"WITH {_HIT_TABLES} SELECT \"row\", term, n, source FROM (SELECT *, min(rank) OVER (PARTITION BY \"row\") AS m FROM ({_IN_TITLES} UNION ALL {_IN_ROLES})) WHERE rank = m"
_SOURCES = ["title", "statement", "abstract"]


@query(_FIRST_HITS)
def dom_match_cascade(t):
    """Weighted matches in the first of title, statement and abstract that has any; names inside others go."""
    return M.match_cascade(_parts(t), "row", _SOURCES, _terms(t), "term", "term")


@query()
def dom_match_cascade_stems(t):
    """The same with the counts of stemmed terms added."""
    return M.match_cascade(_parts(t), "row", _SOURCES, _terms(t), "term", "term", stems=True)


@query(f"WITH hits AS MATERIALIZED ({_matches('SELECT doc_id AS "row", text AS s FROM documents', '"row"', _ORDERS)}) {_maximal('SELECT * FROM hits', ['"row"'])}")
def win_longest_match(t):
    """Terms of a whole text, those of two words in both orders, without those inside another one that is found at least as
    often."""
    hits = M.match_both(t("documents").select(F.col("doc_id").alias("row"), "text"), ["row"], "text", _terms(t), "term", "term", stems=False, orders=True)
    return M.without_contained(hits, ["row"], "term")


@query("SELECT DISTINCT p_partkey, term FROM (SELECT p_partkey, lower(p_name) AS term FROM part UNION SELECT p_partkey, lower(unnest(string_split(p_name, ' '))) FROM part) WHERE length(term) > 4 AND term NOT IN (SELECT lower(p_type) FROM part)")
def dom_term_dictionary(t):
    """Names and synonyms without short words and without single words of a word list."""
    parts = t("part").select("p_partkey", "p_name", F.split("p_name", " ").alias("synonyms"))
    common = t("part").select(F.lower("p_type").alias("word")).distinct()
    return M.term_dictionary(parts, "p_partkey", "p_name", "synonyms", common)


def _categories() -> str:
    test = {"exact": "x = '{0}' OR list_contains(ws, '{0}')", "keyword": "contains(x, '{0}')", "pattern": "regexp_matches(x, '{0}')"}
    return "CASE " + " ".join(f"WHEN {test[kind].format(text)} THEN '{name}:{confidence}'" for kind, text, name, confidence in M.rule_list(RULES)) + " END"


#: Labels: part names after words that labels are made of, so that all kinds of rules meet.
_LABEL_HEADS = ["age at", "Patient", "donor sex", "tissue", "stage_of", "cell line", "racetrack", "subgroup", "mouse", "daytime", "dose", "unknown"]
_LABELS_SQL = f"SELECT DISTINCT {_LABEL_HEADS}[p_partkey % {len(_LABEL_HEADS)} + 1] || ' ' || p_name AS label FROM part"


def _part_labels(t) -> DataFrame:
    heads = F.array(*[F.lit(x) for x in _LABEL_HEADS])
    return t("part").select(F.concat_ws(" ", F.get(heads, (F.col("p_partkey") % len(_LABEL_HEADS)).cast("int")), "p_name").alias("label")).distinct()


@query(f"SELECT label, split_part(c, ':', 1) AS category, split_part(c, ':', 2) AS confidence FROM (SELECT label, {_categories()} AS c FROM (SELECT label, lower(trim(label)) AS x, regexp_split_to_array(lower(trim(label)), '\\s+') AS ws FROM ({_LABELS_SQL}))) WHERE c IS NOT NULL")
def dom_keyword_categorize(t):
    """Labels that a category's words, keywords or patterns take, with the confidence."""
    found = _part_labels(t).select("label", M.categorize(F.col("label"), RULES).alias("c")).where("c is not null")
    return found.select("label", "c.category", "c.confidence")


_IN_ITEMS = f"SELECT DISTINCT item_id, w[1] || ' ' || w[2] AS disease FROM (SELECT item_id, regexp_extract_all(lower(text), '{_WORDS}') AS w FROM benchmark) WHERE len(w) >= 2 UNION SELECT item_id, w[2] FROM (SELECT item_id, regexp_extract_all(lower(text), '{_WORDS}') AS w FROM benchmark) WHERE length(w[2]) > 4"


@query(f"WITH n AS MATERIALIZED (SELECT disease, max(item_id) AS item_id FROM ({_IN_ITEMS}) GROUP BY 1) SELECT doc_id, arg_max(disease, (item_id, disease)) AS disease FROM documents JOIN n ON contains(lower(text), disease) GROUP BY 1")
def dom_orphan_drug_map(t):
    """For each text (a drug's designation) the last disease in the dictionary's order whose name stands in it anywhere."""
    w = X.tokens(F.lower("text"))
    names = F.array(F.when(F.size(w) >= 2, F.concat_ws(" ", F.get(w, F.lit(0)), F.get(w, F.lit(1)))), F.when(F.length(F.get(w, F.lit(1))) > 4, F.get(w, F.lit(1))))
    listed = t("benchmark").select("item_id", F.explode(names).alias("disease")).where("disease is not null")
    return M.last_contained(t("documents"), "doc_id", "text", listed, "item_id", "disease")


_PLACED = " UNION ALL ".join(f"SELECT \"row\", term, '{p}' AS place FROM ({_matches(f'SELECT "row", replace({c}, chr(57344), chr(32)) AS s FROM ({_PARTS})', '"row"', _PLAIN)})" for c, p in (("title", "Title"), ("abstract", "abstract")))


@query(f"SELECT \"row\", term, string_agg(place, ',' ORDER BY place) AS places FROM ({_PLACED}) GROUP BY 1, 2")
def dom_annotation_merge(t):
    of = lambda c, place: M.match_terms(_parts(t), ["row"], c, _terms(t), "term", "term").withColumn("place", F.lit(place))
    merged = M.merge_annotations(of("title", "Title").unionByName(of("abstract", "abstract")), ["row", "term"], "place")
    return merged.select("row", "term", F.array_join("places", ",").alias("places"))


@query("SELECT o, p, kinds FROM (SELECT l_orderkey AS o, l_partkey AS p, p_type || ';' || p_brand AS kinds, p_type, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber, l_suppkey) AS r FROM lineitem JOIN part ON p_partkey = l_partkey) WHERE r = 1 AND p_type IN ('ECONOMY', 'PROMO') AND p NOT IN (SELECT p_partkey FROM part WHERE p_size < 5)")
def dom_concept_cleanup(t):
    """First row of each (document, concept), kinds that are allowed, no concept of the exclusion list."""
    first = W.first_per_key(t("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"), ["l_orderkey", "l_partkey"], [F.col("l_linenumber"), F.col("l_suppkey")])
    kinds = first.join(t("part"), F.col("p_partkey") == F.col("l_partkey")).withColumn("kinds", F.array("p_type", "p_brand"))
    allowed = kinds.where(F.arrays_overlap("kinds", F.array(F.lit("ECONOMY"), F.lit("PROMO"))))
    general = t("part").where("p_size < 5").select(F.col("p_partkey").alias("l_partkey"))
    return allowed.join(general, "l_partkey", "left_anti").select(F.col("l_orderkey").alias("o"), F.col("l_partkey").alias("p"), F.array_join("kinds", ";").alias("kinds"))


@query("SELECT p_partkey, coalesce(s, 'See Also') AS sections FROM part LEFT JOIN (SELECT l_partkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS s FROM lineitem WHERE l_quantity > 48 GROUP BY 1) ON l_partkey = p_partkey")
def dom_omim_sections(t):
    """The sections that cite each reference, and a default for those that none does."""
    cited = t("lineitem").where("l_quantity > 48").groupBy("l_partkey").agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("s"))
    return t("part").join(cited, F.col("l_partkey") == F.col("p_partkey"), "left").select("p_partkey", F.coalesce("s", F.lit("See Also")).alias("sections"))


@query("SELECT p_partkey, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.09) AS flagged FROM part")
def dom_genereview_flag(t):
    ids = t("lineitem").where("l_discount > 0.09").select("l_partkey").distinct().withColumn("flag", F.lit(True))
    return t("part").join(ids, F.col("p_partkey") == F.col("l_partkey"), "left").select("p_partkey", F.coalesce("flag", F.lit(False)).alias("flagged"))


@query("SELECT DISTINCT o_custkey AS core FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)")
def dom_core_projects(t):
    return t("orders").join(t("lineitem").where("l_quantity > 49"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select(F.col("o_custkey").alias("core")).distinct()


@query("SELECT c_custkey, n_name AS institute, CAST(coalesce(CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END, 0) AS DOUBLE) AS cost, array_to_string(list_sort([trim(replace(x, '(contact)', '')) for x in string_split(c_name || '; ' || c_mktsegment || ' (contact);', ';') if trim(x) <> '']), '|') AS investigators FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey < 4")
def dom_project_cleanup(t):
    """Recodes by a lookup (unmapped gives null), investigators split and cleaned, cost with a fallback."""
    names = t("nation").where("n_regionkey < 4").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("institute"))
    text = F.concat("c_name", F.lit("; "), "c_mktsegment", F.lit(" (contact);"))
    people = F.filter(F.transform(F.split(text, ";"), lambda x: F.trim(F.replace(x, F.lit("(contact)"), F.lit("")))), lambda x: x != "")
    cost = F.coalesce(F.when(F.col("c_acctbal") > 0, money("c_acctbal")), F.lit(0).cast("decimal(18,2)")).cast("double")
    return t("customer").join(names, "c_nationkey", "left").select("c_custkey", "institute", cost.alias("cost"), F.array_join(F.array_sort(people), "|").alias("investigators"))


@query("SELECT o_orderkey, CAST(CASE WHEN year(o_orderdate) < 1995 AND price IS NOT NULL THEN price ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DOUBLE) AS price FROM orders LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def dom_funding_merge(t):
    """Early years take their amounts from the overlay, later ones pass through."""
    orders = t("orders").select("o_orderkey", F.year("o_orderdate").alias("y"), money("o_totalprice").cast("decimal(38,2)").alias("price"))
    news = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(money("l_extendedprice")).cast("decimal(38,2)").alias("price"))
    early = J.overwrite(orders.where("y < 1995"), news, ["o_orderkey"], ["price"])
    return early.unionByName(orders.where("y >= 1995")).select("o_orderkey", F.col("price").cast("double").alias("price"))


@query(f"SELECT \"row\" AS doc_id, CASE WHEN len(string_split(trim(regexp_replace(replace(statement, chr(57344), ' '), '\\s+', ' ', 'g')), ' ')) > 20 THEN 'PHR' WHEN abstract <> '' THEN 'ABSTRACT' ELSE 'TITLE' END AS source FROM ({_PARTS})")
def dom_source_select(t):
    """The statement if it has more than 20 words, else the abstract if there is one, else the title."""
    return _parts(t).select(F.col("row").alias("doc_id"), F.when(X.word_count("statement") > 20, "PHR").when(F.col("abstract") != "", "ABSTRACT").otherwise("TITLE").alias("source"))


_NOTED_ALL = f"SELECT doc_id, place, l[place + 1] AS s FROM (SELECT doc_id, l, unnest(range(len(l))) AS place FROM (SELECT doc_id, list_filter(string_split({_ENDS}, chr(57344)), lambda z: trim(z, ' ') <> '') AS l FROM documents))"


@query("SELECT d.doc_id, " + ", ".join(f"trim(regexp_replace(coalesce(string_agg(s, ' ' ORDER BY place) FILTER (WHERE weight = {w}), ''), '\\s+', ' ', 'g'), ' ') AS \"{r}\"" for r, w in M.ROLE_WEIGHTS.items()) + f" FROM documents d LEFT JOIN (SELECT doc_id, place, s, {_role('place')} AS weight FROM ({_NOTED_ALL})) USING (doc_id) GROUP BY 1")
def dom_sentence_roles(t):
    """The sentences of each role that are neither negated nor past, with single blanks."""
    roles = M.sentence_roles(t("documents"), "doc_id", "text")
    return roles.select("doc_id", *[F.trim(F.regexp_replace(c, r"\s+", " ")).alias(c) for c in roles.columns[1:]])


#: Aliases of three kinds of entities: the longer words of the benchmark, by their lengths.
_ALIASES = f"SELECT DISTINCT 'e' || CAST(length(w) % 4 AS VARCHAR) AS entity, w AS alias, length(w) % 3 AS kind FROM (SELECT unnest(regexp_extract_all(lower(text), '{_WORDS}')) AS w FROM benchmark) WHERE length(w) > 5"
_NOTED = f"SELECT doc_id, place, s FROM (SELECT doc_id, l, unnest(range(len(l))) AS place, l[place + 1] AS s FROM (SELECT doc_id, list_filter(string_split({_ENDS}, chr(57344)), lambda z: trim(z, ' ') <> '') AS l FROM documents))"


def _named(kind: int, keys: str, texts: str) -> str:
    return _matches(texts, keys, f"SELECT entity AS term, alias AS v FROM ({_ALIASES}) WHERE kind = {kind}")


@query(f"WITH p AS (SELECT DISTINCT a.doc_id, a.term AS a, b.term AS b FROM ({_named(0, 'doc_id, place', _NOTED)}) a JOIN ({_named(1, 'doc_id, place', _NOTED)}) b USING (doc_id, place)), g AS (SELECT DISTINCT doc_id, 1 AS g FROM ({_named(2, 'doc_id', 'SELECT doc_id, text AS s FROM documents')})) SELECT a, b, count(*) AS texts, count(g) AS with_also FROM p LEFT JOIN g USING (doc_id) GROUP BY 1, 2")
def dom_target_rank(t):
    """Pairs of entities of two kinds that share a sentence, with the number of texts, and of those that name a third."""
    words = t("benchmark").select(F.explode(X.tokens(F.lower("text"))).alias("w")).where(F.length("w") > 5).distinct()
    aliases = words.select(F.concat(F.lit("e"), F.length("w") % 4).alias("entity"), F.col("w").alias("alias"), (F.length("w") % 3).alias("kind"))
    of = lambda k: aliases.where(F.col("kind") == k).select("entity", "alias")
    return M.rank_targets(t("documents").select("doc_id", "text"), "doc_id", "text", of(0), of(1), of(2))


@query("SELECT o_orderkey, c_custkey FROM (SELECT o_orderkey, unnest(['Cond ' || o_custkey, '  COND-' || (o_custkey + 1)]) AS x FROM orders) JOIN customer ON trim(regexp_replace(lower(x), '[^\\p{L}\\p{N}\\p{M}\\p{Pc}]+', ' ', 'g')) = 'cond ' || c_custkey GROUP BY 1, 2")
def dom_condition_map(t):
    """Conditions of a trial, in any spelling, mapped to entities by their normalised names; each pair once."""
    listed = t("orders").select("o_orderkey", F.explode(F.array(F.concat(F.lit("Cond "), "o_custkey"), F.concat(F.lit("  COND-"), F.col("o_custkey") + 1))).alias("x"))
    names = t("customer").select("c_custkey", F.concat(F.lit("cond "), "c_custkey").alias("term"))
    return listed.select("o_orderkey", X.normalize_term("x").alias("term")).join(names, "term").select("o_orderkey", "c_custkey").distinct()


_MEMBERS = "SELECT p_size AS cluster, p_partkey, p_name FROM part"


@query(f"SELECT cluster, size, txt AS text, list_aggregate(terms, 'string_agg', ',') AS terms FROM (SELECT cluster, count(*) AS size, string_agg(p_name, ' ' ORDER BY p_partkey) AS txt FROM ({_MEMBERS}) GROUP BY 1) JOIN (SELECT cluster, list(w ORDER BY r) AS terms FROM (SELECT cluster, w, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, w) AS r FROM (SELECT cluster, unnest(string_split(lower(p_name), ' ')) AS w FROM ({_MEMBERS})) GROUP BY 1, 2) WHERE r <= 3 GROUP BY 1) USING (cluster)")
def dom_cluster_profile(t):
    """Size, text and most frequent words of each cluster."""
    found = M.cluster_profiles(t("part").select(F.col("p_size").alias("cluster"), "p_partkey", "p_name"), "cluster", "p_partkey", "p_name", 3)
    return found.withColumn("terms", F.array_join("terms", ","))


@query(f"SELECT cluster, CAST(row_number() OVER (PARTITION BY cluster ORDER BY p_partkey, p_name) AS INTEGER) AS place, p_name FROM ({_MEMBERS})")
def dom_cluster_texts(t):
    """Each cluster's text, as its members' in order."""
    return M.cluster_texts(t("part").select(F.col("p_size").alias("cluster"), "p_partkey", "p_name"), "cluster", "p_partkey", "p_name")


@query(f"SELECT doc_id AS \"row\", CAST(0.5 * least(2, n) AS DOUBLE) AS probability, snippet FROM (SELECT doc_id, len(regexp_extract_all(lower(text), '{M.EPIDEMIOLOGY}')) AS n, regexp_extract(lower(text), '{M.EPIDEMIOLOGY}', 1) AS snippet FROM documents) WHERE n > 0")
def dom_epi_annotation(t):
    """Texts on epidemiology by the rule on words, with the first of these."""
    return M.annotate(t("documents").select(F.col("doc_id").alias("row"), "text"), "text")


@query("SELECT doc_id AS \"row\", CAST(0.5 * least(2, n) AS DOUBLE) AS probability FROM (SELECT doc_id, len(regexp_extract_all(lower(text), '[0-9.]+ ?%')) AS n FROM documents) WHERE n > 0")
def dom_epi_annotation_scored(t):
    """The same by a classifier's score that is handed in as a column."""
    score = 0.5 * F.least(F.lit(2), F.regexp_count(F.lower("text"), F.lit("[0-9.]+ ?%")))
    return M.annotate(t("documents").select(F.col("doc_id").alias("row"), "text"), "text", score).select("row", "probability")


_DRUGS = "SELECT 'D' || min(p_partkey) AS drug, lower(p_name) AS v FROM part GROUP BY 2 UNION ALL SELECT 'W' || min(p_partkey), lower(split_part(p_name, ' ', 1)) FROM part GROUP BY 2"
_GIVEN = "SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name WHEN p_size > 12 THEN 'Oral ' || p_name || ' ' || p_type ELSE split_part(p_name, ' ', 1) || ' ' || p_brand END AS given FROM part"


@query(f"WITH d AS MATERIALIZED ({_DRUGS}), n AS MATERIALIZED (SELECT p_partkey, lower(given) AS x FROM ({_GIVEN})), e AS (SELECT DISTINCT p_partkey, drug, 'exact' AS how, v AS term FROM n JOIN d ON v = x), s AS (SELECT DISTINCT p_partkey, v FROM n JOIN (SELECT DISTINCT v FROM d) ON contains(x, v) AND len(list_filter(string_split(v, ' '), lambda w: NOT list_contains(string_split(x, ' '), w))) = 0 WHERE p_partkey NOT IN (SELECT p_partkey FROM e)), l AS (SELECT p_partkey, v FROM (SELECT *, max(length(v)) OVER (PARTITION BY p_partkey) AS m FROM s) WHERE length(v) = m) SELECT * FROM e UNION ALL SELECT DISTINCT p_partkey, drug, 'span', v FROM l JOIN d USING (v)")
def dom_drug_map(t):
    """By the exact name, else by the longest names inside it, with a flag that says which."""
    part = t("part")
    given = F.when(F.col("p_size") > 25, F.col("p_name")).when(F.col("p_size") > 12, F.concat(F.lit("Oral "), "p_name", F.lit(" "), "p_type")).otherwise(F.concat(F.split("p_name", " ")[0], F.lit(" "), F.col("p_brand")))
    named = lambda letter, v: part.groupBy(v.alias("v")).agg(F.concat(F.lit(letter), F.min("p_partkey")).alias("drug")).select("drug", "v")
    drugs = named("D", F.lower("p_name")).unionByName(named("W", F.lower(F.split("p_name", " ")[0])))
    return M.map_names(part.select("p_partkey", given.alias("given")), "p_partkey", "given", drugs, "drug", "v").distinct()


_NEWS = "SELECT o_custkey AS topic, 'orders' AS kind, CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT o_custkey, 'lines', CAST(l_shipdate AS DATE) FROM lineitem JOIN orders ON o_orderkey = l_orderkey"


@query(f"SELECT c_nationkey, topic, count(*) FILTER (WHERE kind = 'orders') AS orders, count(*) FILTER (WHERE kind = 'lines') AS lines, count(*) AS total FROM customer JOIN ({_NEWS}) ON topic = c_custkey WHERE d BETWEEN DATE '1997-01-01' AND DATE '1997-03-31' GROUP BY 1, 2")
def dom_alert_counts(t):
    subs = t("customer").select("c_nationkey", F.col("c_custkey").alias("topic"))
    orders = t("orders")
    news = orders.select(F.col("o_custkey").alias("topic"), F.lit("orders").alias("kind"), day("o_orderdate").alias("d"))
    lines = t("lineitem").join(orders, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("topic"), F.lit("lines").alias("kind"), day("l_shipdate").alias("d"))
    return I.alert_counts(subs, "c_nationkey", "topic", news.unionByName(lines), "kind", "d", "1997-01-01", "1997-03-31", ["orders", "lines"])


@query("SELECT s_suppkey FROM supplier WHERE date_diff('day', DATE '1998-08-02' - CAST(s_suppkey * 7 % 90 AS INTEGER), DATE '1998-08-02') > 20 + s_nationkey")
def dom_update_due(t):
    """Sources of a control table whose last update is longer ago than their own interval."""
    today = F.lit("1998-08-02").cast("date")
    control = t("supplier").select("s_suppkey", F.date_sub(today, (F.col("s_suppkey") * 7 % 90).cast("int")).alias("last"), (F.lit(20) + F.col("s_nationkey")).alias("interval"))
    return I.due(control, "s_suppkey", "last", "interval", "1998-08-02")


@query("SELECT s_suppkey, CAST(s_acctbal AS BIGINT) + 1 AS stamp FROM supplier WHERE s_suppkey % 10 = 0")
def dom_change_detect(t):
    """Dumps whose stamp is not the one kept; those without a kept stamp only set the baseline."""
    stamps = t("supplier").where("s_suppkey < 90 or s_suppkey % 10 = 0").select("s_suppkey", F.bround(F.col("s_acctbal"), 0).cast("long").alias("stamp"))
    seen = stamps.withColumn("stamp", F.when(F.col("s_suppkey") % 10 == 0, F.col("stamp") + 1).otherwise(F.col("stamp")))
    return I.changed(stamps, seen, "s_suppkey", "stamp")


ORACLES["dom_change_detect"] = ORACLES["dom_change_detect"].replace("CAST(s_acctbal AS BIGINT)", "CAST(round_even(s_acctbal, 0) AS BIGINT)")


_KNOWN_WORDS = "SELECT unnest(string_split(lower(p_name), ' ')) AS word FROM part WHERE p_partkey % 10 < 7 UNION SELECT unnest(string_split('age at patient donor sex tissue cell line mouse dose unknown', ' '))"
_FORMS = " UNION ALL ".join(["SELECT label, w, w AS form FROM parts", *[f"SELECT label, w, substring(w, 1, length(w) - {len(s)}) FROM parts WHERE w LIKE '%{s}' AND length(w) >= {len(s) + 3}" for s in L.SUFFIXES]])


@query(f"WITH known AS MATERIALIZED ({_KNOWN_WORDS}), counted AS MATERIALIZED (SELECT {_LABEL_HEADS}[p_partkey % {len(_LABEL_HEADS)} + 1] || ' ' || p_name AS label, count(*) AS n FROM part GROUP BY 1), parts AS MATERIALIZED (SELECT DISTINCT label, regexp_replace(unnest(regexp_split_to_array(lower(label), '[\\s\\-_/\\.]+')), '^[[:punct:]]+|[[:punct:]]+$', '', 'g') AS w FROM counted), good AS (SELECT label FROM (SELECT label, w, bool_or(form IN (SELECT word FROM known)) AS hit FROM ({_FORMS}) GROUP BY 1, 2) GROUP BY 1 HAVING bool_and(hit)) SELECT label, n, split_part(c, ':', 1) AS category, split_part(c, ':', 2) AS confidence FROM (SELECT label, n, {_categories()} AS c FROM (SELECT label, n, lower(trim(label)) AS x, regexp_split_to_array(lower(trim(label)), '\\s+') AS ws FROM counted JOIN good USING (label))) WHERE c IS NOT NULL")
def dom_label_pipeline(t):
    """Labels counted, kept by rules and by known words, and put into categories by keywords, step by step."""
    tables = {"occurrences": _part_labels_all(t), "words": _known_words(t)}
    for step in (L.count_labels, L.filter_by_rules, L.filter_by_words, L.categorize_by_keywords):
        tables |= step(tables)
    return tables["categorized"]


@query()
def dom_label_assign(t):
    """All six steps: what no keyword takes gets the category of the most alike term, and samples their properties."""
    values = t("part").select(F.col("p_brand").alias("sample"), "p_partkey", F.concat_ws(" ", F.get(F.array(*[F.lit(x) for x in _LABEL_HEADS]), (F.col("p_partkey") % len(_LABEL_HEADS)).cast("int")), "p_name").alias("label"), F.col("p_type").alias("value"), F.col("p_partkey").alias("place"))
    tables = {"occurrences": _part_labels_all(t), "words": _known_words(t), "values": values}
    for step in (L.count_labels, L.filter_by_rules, L.filter_by_words, L.categorize_by_keywords, L.assign_by_likeness, L.prepare_properties):
        tables |= step(tables)
    return tables["properties"]


def _part_labels_all(t) -> DataFrame:
    heads = F.array(*[F.lit(x) for x in _LABEL_HEADS])
    return t("part").select(F.concat_ws(" ", F.get(heads, (F.col("p_partkey") % len(_LABEL_HEADS)).cast("int")), "p_name").alias("label"))


def _known_words(t) -> DataFrame:
    words = t("part").where("p_partkey % 10 < 7").select(F.explode(F.split(F.lower("p_name"), " ")).alias("word"))
    heads = F.explode(F.array(*[F.lit(w) for w in "age at patient donor sex tissue cell line mouse dose unknown".split()]))
    return words.unionByName(t("part").sparkSession.range(1).select(heads.alias("word"))).distinct()


@query("SELECT c_custkey AS customer_custkey, c_name AS customer_name FROM customer")
def rename_substring(t):
    c = t("customer").select("c_custkey", "c_name")
    return c.toDF(*[x.replace("c_", "customer_") for x in c.columns])


# ---- through files and streams


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _files(name: str, sql: str, *more: str):
    """Registers a query of (spark, table reader)."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet"))

        run.__doc__ = f.__doc__
        for n in (name, *more):
            if n in QUERIES:
                raise ValueError(f"two queries are called {n}")
            QUERIES[n], ORACLES[n] = run, sql
        return f

    return add


@_files("scan_csv", "SELECT s_suppkey, s_name FROM supplier", "sink_csv")
def _csv(spark, t):
    path = _scratch(spark, "csv")
    R.write_delimited(t("supplier").select("s_suppkey", "s_name", "s_nationkey"), path)
    return R.read_delimited(spark, path, "s_suppkey long, s_name string, s_nationkey int").select("s_suppkey", "s_name")


@_files("scan_zip_json", "SELECT s_suppkey, s_name FROM supplier")
def _zip(spark, t):
    path = _scratch(spark, "zip")
    R.write_zipped_json(t("supplier").select("s_suppkey", "s_name"), path, "results")
    record = F.from_json("record", "s_suppkey bigint, s_name string").alias("r")
    return R.read_zipped_json(spark, path + "/*.zip", "results").select(record).select("r.*")


@_files("scan_csv_delim", "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey < 5", "sink_append")
def _pipes(spark, t):
    path, rows = _scratch(spark, "pipe"), t("supplier").select(F.col("s_suppkey").cast("string").alias("s_suppkey"), "s_name")
    R.write_delimited(rows, path, separator="pipe")
    R.write_delimited(rows.where("s_suppkey < 5"), path, append=True, separator="pipe")
    R.write_delimited(rows.limit(1).select(F.lit("no number").alias("s_suppkey"), "s_name"), path, append=True, separator="pipe")
    return R.read_delimited(spark, path, "s_suppkey long, s_name string", separator="pipe", drop_bad_lines=True).where("s_suppkey is not null")


@_files("sink_json_records", "SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2")
def _json(spark, t):
    edges = t("lineitem").groupBy("l_orderkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    path = _scratch(spark, "json")
    R.as_json_records(edges, ("l_orderkey", "l_partkey")).write.text(path)
    back = R.read_json(spark, path, "start struct<id: long>, end struct<id: long>, n long", multiline=False)
    return back.select(F.col("start.id").alias("l_orderkey"), F.col("end.id").alias("l_partkey"), "n")


@_files("stream_upsert", "SELECT user_id, arg_max(event_type, event_id) AS event_type, CAST(max(event_id) AS BIGINT) AS event_id FROM events GROUP BY 1", "stream_ingest")
def _stream(spark, t):
    """Events land in files and are upserted batch by batch; the final state is the latest row of every user."""
    base = _scratch(spark, "stream")
    events = t("events").select("user_id", "event_type", "event_id")
    for k in range(3):
        events.where(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(f"{base}/in")
    schema = "user_id long, event_type string, event_id long"
    return I.upsert_stream(spark, f"{base}/in", schema, f"{base}/table", f"{base}/checkpoint", "user_id", "event_id", policy="latest", per_batch=1)

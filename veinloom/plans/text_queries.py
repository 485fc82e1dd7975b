"""Text, value, array, date and JSON functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from veinloom.functions import text as X
from veinloom.functions import values as V
from veinloom.functions.stem import stem
from veinloom.operators import windows as W
from veinloom.operators.alike import alike_pairs
from veinloom.operators.nearest import cosines, nearest
from veinloom.pipelines.labels import SUFFIXES, word_forms
from veinloom.plans.base import day, query

# In DuckDB's regular expressions \w is ASCII; these classes are what Python's and Spark's Unicode \w and \W are here.
_W, _NW = r"[\p{L}\p{N}\p{M}\p{Pc}]", r"[^\p{L}\p{N}\p{M}\p{Pc}]"


def _docs(t):
    return t("documents").select("doc_id", F.col("text").alias("x"))


_D = "(SELECT doc_id, text AS x FROM documents)"


@query(f"SELECT doc_id, trim(regexp_replace(lower(x), '{_NW}+', ' ', 'g')) AS y FROM {_D}")
def str_normalize_term(t):
    return _docs(t).select("doc_id", X.normalize_term("x").alias("y"))


@query(f"SELECT doc_id, trim(regexp_replace(regexp_replace(lower(x), '[_-]', ' ', 'g'), '\\s+', ' ', 'g')) AS y FROM {_D}")
def str_normalize_label(t):
    return _docs(t).select("doc_id", X.normalize_label("x").alias("y"))


@query(f"SELECT doc_id, trim(regexp_replace(replace(translate(lower(x), 'àáâãäåāçćčèéêëēìíîïīñńòóôõöøōùúûüūýÿšśžźżł', 'aaaaaaaccceeeeeiiiiinnooooooouuuuuyysszzzl'), '''', ''), '{_NW}+', ' ', 'g')) AS y FROM {_D}")
def str_normalize_phrase(t):
    return _docs(t).select("doc_id", X.normalize_phrase("x").alias("y"))


@query(f"SELECT doc_id, trim(regexp_replace(regexp_replace(x, '[^\\x00-\\x7F]', '', 'g'), '\\W+', ' ', 'g')) AS y FROM {_D}")
def str_ascii_only(t):
    return _docs(t).select("doc_id", X.ascii_only("x").alias("y"))


@query(f"SELECT doc_id, regexp_replace(x, '[^A-Za-z0-9_\\s\\-/@.+]', '', 'g') AS y FROM {_D}")
def str_whitelist_chars(t):
    return _docs(t).select("doc_id", X.whitelist("x").alias("y"))


@query(f"SELECT doc_id, trim(regexp_replace(regexp_replace(x, '^[^A-Za-z0-9]+', ''), '[^A-Za-z0-9]+$', '')) AS y FROM {_D}", "str_trim_strip")
def str_trim_special(t):
    return _docs(t).select("doc_id", X.trim_special("x").alias("y"))


def _camel() -> str:
    sql = "regexp_replace(x, '([a-z])([A-Z])', '\\1 \\2', 'g')"
    for first, second in (p.split(" ") for p in X.COMPOUNDS.split("|")):
        sql = f"regexp_replace({sql}, '(?i){first}({second})', '{first} \\1', 'g')"
    return sql


#: Part names with each of the compounds in turn between their words, in three spellings.
_COMPOUND = f"[replace(c, ' ', '') FOR c IN string_split('{X.COMPOUNDS}', '|')][p_partkey % {len(X.COMPOUNDS.split('|'))} + 1]"


@query(f"SELECT p_partkey, {_camel()} AS y FROM (SELECT p_partkey, replace(p_name, ' ', CASE p_partkey % 3 WHEN 0 THEN upper({_COMPOUND}) WHEN 1 THEN {_COMPOUND} ELSE upper(substring({_COMPOUND}, 1, 1)) || substring({_COMPOUND}, 2) || 'X' END) AS x FROM part)")
def str_camel_split(t):
    words = [c.replace(" ", "") for c in X.COMPOUNDS.split("|")]
    word = F.get(F.array(*[F.lit(w) for w in words]), (F.col("p_partkey") % len(words)).cast("int"))
    spelt = F.when(F.col("p_partkey") % 3 == 0, F.upper(word)).when(F.col("p_partkey") % 3 == 1, word).otherwise(F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, 2, 100), F.lit("X")))
    return t("part").select("p_partkey", X.camel_split(F.replace("p_name", F.lit(" "), spelt)).alias("y"))


@query("SELECT p_partkey, array_to_string(string_split(lower(p_brand) || ' ' || upper(p_name), ' '), '|') AS y, upper(substring(p_name, 1, 1)) || substring(lower(p_name), 2, 3) AS z FROM part", "str_replace", "str_substring_slice")
def str_lower_upper_title(t):
    both = F.concat_ws(" ", F.lower("p_brand"), F.upper("p_name"))
    return t("part").select("p_partkey", F.replace(both, F.lit(" "), F.lit("|")).alias("y"), F.substring(F.initcap("p_name"), 1, 4).alias("z"))


_STRIPPED = "regexp_replace({0}, '^[[:punct:]]+|[[:punct:]]+$', '', 'g')"


@query(f"SELECT p_partkey, array_to_string(list_filter([{_STRIPPED.format('w')} for w in regexp_split_to_array('(naïve-it''s) ' || p_brand || '-' || replace(p_name, ' ', '_') || '/x.y;,', '[\\s\\-_/\\.]+')], lambda w: w <> ''), '|') AS y FROM part")
def str_split_multi(t):
    text = F.concat(F.lit("(naïve-it's) "), "p_brand", F.lit("-"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("/x.y;,"))
    return t("part").select("p_partkey", F.array_join(X.split_multi(text), "|").alias("y"))


@query(f"SELECT doc_id, CAST(len(regexp_extract_all(text, '{_W}+')) AS BIGINT) AS n_tokens, CAST(len(list_distinct(regexp_extract_all(text, '{_W}+'))) AS BIGINT) AS n_distinct FROM documents")
def str_word_tokens(t):
    return t("documents").select("doc_id", F.size(X.tokens("text")).cast("long").alias("n_tokens"), F.size(F.array_distinct(X.tokens("text"))).cast("long").alias("n_distinct"))


@query("SELECT doc_id, CAST(CASE WHEN trim(regexp_replace(text, '\\s+', ' ', 'g')) = '' THEN 0 ELSE len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) END AS BIGINT) AS n, len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) > 20 AS is_long FROM documents")
def str_word_count(t):
    return t("documents").select("doc_id", X.word_count("text").cast("long").alias("n"), (X.word_count("text") > 20).alias("is_long"))


@query("SELECT doc_id, CAST((length(text) - length(replace(text, 'the', ''))) / 3 AS BIGINT) AS n, contains(text, 'tion') AS has FROM documents", "str_contains")
def str_occurrence_count(t):
    return t("documents").select("doc_id", X.occurrences("text", "the").alias("n"), F.contains("text", F.lit("tion")).alias("has"))


#: Sentences in SQL, which has no look-behind: ends are marked, and the marks behind abbreviations taken back.
_MARKED = "regexp_replace(regexp_replace(regexp_replace(text, '([.?!])([\\s\\x0b])', '\\1' || chr(57344) || '\\2', 'g'), '([A-Z][a-z]\\.)' || chr(57344), '\\1', 'g'), '(\\w\\.\\w[.?!])' || chr(57344), '\\1', 'g')"
_SENT = f"(SELECT doc_id, list_filter(list_transform(string_split({_MARKED}, chr(57344)), lambda z, i: CASE WHEN i > 1 THEN substring(z, 2) ELSE z END), lambda z: trim(z, ' ') <> '') AS l FROM documents)"


@query(f"SELECT doc_id, CAST(len(l) AS BIGINT) AS n, l[1] AS first_sentence FROM {_SENT}")
def str_sentence_split(t):
    return t("documents").select("doc_id", F.size(X.sentences("text")).cast("long").alias("n"), F.get(X.sentences("text"), F.lit(0)).alias("first_sentence"))


@query(f"SELECT doc_id, array_to_string(list_filter(l, lambda z: contains(lower(z), 'the')), ' ') AS y FROM {_SENT}")
def str_sentence_with_word(t):
    return t("documents").select("doc_id", X.sentences_with("text", "the").alias("y"))


@query(f"SELECT doc_id, coalesce(array_to_string(l[list_position(list_transform(l, lambda z: contains(lower(z), 'tion')), true):], ' '), '') AS y FROM (SELECT doc_id, CASE WHEN len(list_filter(l, lambda z: contains(lower(z), 'tion'))) > 0 THEN l END AS l FROM {_SENT})")
def str_aim_extract(t):
    return t("documents").select("doc_id", X.from_sentence_with("text", "tion").alias("y"))


@query("SELECT p_partkey, array_to_string(CASE WHEN len(string_split(p_name, ' ')) = 2 THEN [p_name, string_split(p_name, ' ')[2] || ' ' || string_split(p_name, ' ')[1]] ELSE [p_name] END, '|') AS y FROM part")
def str_term_permutations(t):
    return t("part").select("p_partkey", F.array_join(X.term_orders("p_name"), "|").alias("y"))


@query("SELECT doc_id, array_to_string([w for w in regexp_split_to_array(lower(x), '\\s+') if w NOT IN ('the', 'of', 'and', 'le', 'de', 'die')], ' ') AS y FROM " + _D)
def str_stopword_removal(t):
    return _docs(t).select("doc_id", X.without_words("x", ["the", "of", "and", "le", "de", "die"]).alias("y"))


@query()
def str_stem(t):
    return t("part").select("p_name").distinct().select("p_name", stem(F.lower("p_name")).alias("y"))


@query()
def sink_escape(t):
    return _docs(t).select("doc_id", X.unicode_escape("x").alias("y"))


@query("SELECT doc_id, trim(regexp_replace(nfc_normalize(text), '[\\s\\x0B\\x1C-\\x1F\\x{85}\\p{Z}]+', ' ', 'g'), ' ') AS y FROM documents")
def str_nfc(t):
    return _docs(t).select("doc_id", X.nfc("x").alias("y"))


def _names(t):
    """Names of parts with their brands, as they are and with a part turned around."""
    c = F.concat_ws(" ", "p_name", F.lower("p_brand"))
    return t("part").select(F.when(F.col("p_partkey") % 3 == 0, F.concat_ws(" ", F.lower("p_brand"), "p_name")).otherwise(c).alias("name")).distinct()


@query()
def str_similarity_ratio(t):
    """All pairs of names whose ratio is 0.9 or more."""
    return alike_pairs(_names(t), "name", 0.9)


@query()
def str_token_sort_ratio(t):
    """The same with the words of each name put in order first; pairs are of names in that form."""
    return alike_pairs(_names(t).select(X.sorted_tokens("name").alias("name")), "name", 0.9)


@query("SELECT page_id, regexp_extract(url, '^([a-z]+)://([^/:?#]+)', 1) AS scheme, regexp_extract(url, '^([a-z]+)://([^/:?#]+)', 2) AS host FROM pages")
def str_regex_extract(t):
    p = r"^([a-z]+)://([^/:?#]+)"
    return t("pages").select("page_id", F.regexp_extract("url", p, 1).alias("scheme"), F.regexp_extract("url", p, 2).alias("host"))


@query("SELECT s_suppkey, 'SUP:' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS id, regexp_replace(lpad(CAST(s_suppkey AS VARCHAR), 7, '0'), '^0+', '') AS bare FROM supplier")
def str_id_format(t):
    padded = X.zero_padded("s_suppkey", "", 7)
    return t("supplier").select("s_suppkey", X.zero_padded("s_suppkey", "SUP:", 7).alias("id"), F.regexp_replace(padded, "^0+", "").alias("bare"))


@query("SELECT p_partkey, array_to_string([w || '[title]' for w in string_split(p_name, ' ')], ' AND ') AS q FROM part")
def str_query_build(t):
    return t("part").select("p_partkey", X.search_expression("p_name", "title").alias("q"))


_LABELS = f"SELECT DISTINCT unnest(regexp_extract_all(text, '{_W}+')) AS label FROM documents"


def _labels(t):
    return t("documents").select(F.explode(X.tokens("text")).alias("label")).distinct()


@query(f"SELECT label, length(label) > 4 OR label = 'sars' AS long_enough, length(label) < 5 AS is_short, regexp_matches(label, '^[A-Z][A-Z0-9\\-]{{1,7}}$') AS acronym FROM ({_LABELS})", "filter_acronym", "filter_len_term")
def filter_short_single(t):
    return _labels(t).select("label", X.term_long_enough("label").alias("long_enough"), X.short_single_word("label").alias("is_short"), X.acronym("label").alias("acronym"))


#: Labels as files have them: words of the texts, with signs around them by the word's length, and whole lines.
_RAW_LABELS = f"SELECT DISTINCT label FROM (SELECT CASE length(label) % 6 WHEN 0 THEN label || '(x' WHEN 1 THEN '-' || label WHEN 2 THEN label || '_12/a' WHEN 3 THEN translate(label, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') || '7' WHEN 4 THEN label || '%' ELSE ' ' || label || ' ' END AS label FROM ({_LABELS}) UNION ALL SELECT label FROM ({_LABELS}) UNION ALL SELECT unnest(string_split(text, chr(10))) FROM documents)"
_BAD_LABEL = (
    "length(x) < 2", "length(x) > 100", "length(replace(x, '(', '')) <> length(replace(x, ')', ''))", "length(replace(x, '[', '')) <> length(replace(x, ']', ''))", "regexp_matches(x, '^[0-9.\\-+\\s]+$')",
    "length(regexp_replace(x, '[a-zA-Z0-9\\s]', '', 'g')) * 2 > length(x)", "length(x) - length(replace(x, '/', '')) >= 2", "contains(lower(x), 'http') OR contains(lower(x), 'www.')",
    f"(regexp_matches(x, '^[^\\p{{L}}\\p{{N}}\\p{{M}}\\p{{Pc}}\\s]') OR regexp_matches(x, '[^\\p{{L}}\\p{{N}}\\p{{M}}\\p{{Pc}}\\s]$')) AND NOT regexp_matches(lower(x), '(%|{_W})$')", "regexp_matches(x, '^[A-Z]{1,5}[0-9]+\\s*\\(') OR contains(x, 'Tg(')",
    "length(x) > 5 AND x = upper(x) AND x <> lower(x) AND regexp_matches(x, '[0-9]')", "(length(x) - length(replace(x, '_', ''))) * 10 > length(x) * 3", "(length(x) - length(replace(x, '-', ''))) * 10 > length(x) * 3",
)


@query(f"SELECT label FROM (SELECT label, regexp_replace(regexp_replace(label, '^\\s+', ''), '\\s+$', '') AS x FROM ({_RAW_LABELS})) WHERE NOT ({' OR '.join(f'({b})' for b in _BAD_LABEL)})")
def filter_meaningful_label(t):
    """Words of the texts with signs around them, and whole lines, that are labels worth keeping."""
    n, x = F.length("label") % 6, F.col("label")
    signed = F.when(n == 0, F.concat(x, F.lit("(x"))).when(n == 1, F.concat(F.lit("-"), x)).when(n == 2, F.concat(x, F.lit("_12/a"))).when(n == 3, F.concat(F.translate(x, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.lit("7"))).when(n == 4, F.concat(x, F.lit("%"))).otherwise(F.concat(F.lit(" "), x, F.lit(" ")))
    lines = t("documents").select(F.explode(F.split("text", "\n")).alias("label"))
    every = _labels(t).select(F.explode(F.array(signed, x)).alias("label")).unionByName(lines).distinct()
    return every.where(X.meaningful_label("label"))


_FORMS = " OR ".join(["w IN (SELECT word FROM known)", *[f"w LIKE '%{e}' AND length(w) >= {len(e) + 3} AND substring(w, 1, length(w) - {len(e)}) IN (SELECT word FROM known)" for e in SUFFIXES]])


@query(f"WITH known AS MATERIALIZED (SELECT DISTINCT unnest(string_split(lower(p_name), ' ')) AS word FROM part UNION SELECT unnest(regexp_extract_all(lower(text), '{_W}+')) FROM benchmark) SELECT doc_id, bool_and({_FORMS}) AS known FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{_W}+')) AS w FROM documents) GROUP BY 1")
def filter_all_words_known(t):
    """Texts all of whose words, with or without an ending, are known."""
    known = t("part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("form")).unionByName(t("benchmark").select(F.explode(X.tokens(F.lower("text"))).alias("form"))).distinct().withColumn("hit", F.lit(True))
    words = t("documents").select("doc_id", F.explode(F.array_distinct(X.tokens(F.lower("text")))).alias("w"))
    different = words.select("w").distinct().select("w", F.explode(word_forms(F.col("w"))).alias("form")).join(known, "form").select("w", "hit").distinct()
    return words.join(different, "w", "left").groupBy("doc_id").agg(F.bool_and(F.coalesce("hit", F.lit(False))).alias("known"))


@query("SELECT term FROM (SELECT p_name AS term FROM part UNION SELECT unnest(string_split(p_name, ' ')) FROM part UNION SELECT lower(p_brand) FROM part) WHERE contains(term, ' ') OR term NOT IN (SELECT lower(p_type) FROM part)")
def filter_dictionary_word(t):
    """Terms without those that are a single word of the dictionary; a term of several words stays, whatever they are."""
    part = t("part")
    terms = part.select(F.col("p_name").alias("term")).unionByName(part.select(F.explode(F.split("p_name", " ")).alias("term"))).unionByName(part.select(F.lower("p_brand").alias("term"))).distinct()
    return terms.join(part.select(F.lower("p_type").alias("term")).distinct(), "term", "left_anti")


# ---- numbers, vectors, dates


@query("SELECT p_partkey, round(CASE WHEN p_size < 20 THEN ln(p_size) / ln(20) ELSE 1.0 END, 6) AS y, CAST(1 + floor(2 * p_size / 2) AS BIGINT) AS twice, CAST(1 + floor(CAST(p_size AS DOUBLE) / 2) AS BIGINT) AS once FROM part", "num_floor_div_score")
def num_log_normalize(t):
    s = F.col("p_size")
    return t("part").select("p_partkey", F.round(V.log_normalized(s), 6).alias("y"), V.halved_score(s, 2).cast("long").alias("twice"), V.halved_score(s, 1).cast("long").alias("once"))


@query("SELECT l_orderkey, l_linenumber, round(0.2 + 0.8 * l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey), 6) AS y FROM lineitem", "num_ratio_guard")
def num_rescale(t):
    total = t("lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("total"))
    return t("lineitem").join(total, "l_orderkey").select("l_orderkey", "l_linenumber", F.round(V.rescaled(F.col("l_quantity"), F.col("total"), 0.2, 1.0), 6).alias("y"))


@query("SELECT c_custkey, CAST(round_even(c_acctbal / 100, 0) AS BIGINT) AS even, TRY_CAST(c_name AS BIGINT) AS number FROM customer")
def num_round_cast(t):
    return t("customer").select("c_custkey", F.bround(F.col("c_acctbal") / 100, 0).cast("long").alias("even"), F.col("c_name").try_cast("long").alias("number"))


_COS = "SELECT a.vec_id, b.vec_id AS other, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id"
_NEAR = f"SELECT * FROM ({_COS} WHERE a.vec_id % 20 = 0) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, other) <= 10"


def _cosines(t):
    e = t("embeddings")
    return cosines(e, e, "vec_id", "embedding").withColumnRenamed("query", "vec_id")


@query(_COS)
def vec_cosine(t):
    """Cosines of every vector with every other one, in both orders."""
    return _cosines(t)


@query(_NEAR)
def vec_nearest(t):
    """The ten nearest of all other vectors for every twentieth one: queries against all rows."""
    e = t("embeddings")
    return nearest(e.where("vec_id % 20 = 0"), e, "vec_id", "embedding", 10).withColumnRenamed("query", "vec_id")


@query(f"SELECT vec_id, other, cosine > 0.1 AS alone, 0.5 * cosine > 0.1 AS product, (0.5 + cosine) / 2 > 0.3 AS mean FROM ({_COS})")
def vec_threshold(t):
    """Whether each of these cosines passes by itself, and by two rules that join it with a confidence."""
    c = F.col("cosine")
    return _cosines(t).select("vec_id", "other", (c > 0.1).alias("alone"), (0.5 * c > 0.1).alias("product"), ((0.5 + c) / 2 > 0.3).alias("mean"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%y') AS short, strftime(o_orderdate, '%Y%m%d') AS tight, CAST(year(o_orderdate) AS VARCHAR) AS year, strftime(o_orderdate, '%Y-%m-%d') AS parsed FROM orders", "date_year")
def date_parse_format(t):
    d = day("o_orderdate")
    return t("orders").select("o_orderkey", F.date_format(d, "MM/dd/yy").alias("short"), F.date_format(d, "yyyyMMdd").alias("tight"), F.year(d).cast("string").alias("year"), V.parse_date(F.date_format(d, "yyyy/MM/dd")).cast("string").alias("parsed"))


@query("SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-02') > 90 AS due, strftime(CAST(o_orderdate AS DATE) - INTERVAL 5 YEAR, '%Y-%m-%d') AS earlier FROM orders", "date_shift_years")
def date_diff_due(t):
    d = day("o_orderdate")
    return t("orders").select("o_orderkey", V.is_due(d, F.lit("1998-08-02").cast("date"), 90).alias("due"), V.years_back(d, 5).cast("string").alias("earlier"))


@query("SELECT o_custkey, strftime(unnest(generate_series(a, b, INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) - INTERVAL 9 DAY AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders GROUP BY 1)")
def date_daily_sequence(t):
    """The ten days up to each customer's last order, one by one."""
    last = t("orders").groupBy("o_custkey").agg(F.max(day("o_orderdate")).alias("b"))
    return last.select("o_custkey", F.explode(F.sequence(F.date_sub("b", 9), F.col("b"))).alias("day")).select("o_custkey", F.col("day").cast("string").alias("day"))


# ---- arrays and JSON


@query("SELECT p_partkey, w, n FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, unnest([1, 2]) AS n FROM part)", "arr_explode")
def arr_zip_lists(t):
    """Two parallel lists, element by element."""
    z = F.arrays_zip(F.split("p_name", " ").alias("w"), F.array(F.lit(1), F.lit(2)).alias("n"))
    return t("part").select("p_partkey", F.explode(z).alias("z")).select("p_partkey", F.col("z")["w"].alias("w"), F.col("z")["n"].alias("n"))


@query("SELECT l_orderkey, CASE WHEN count(*) = 1 THEN min(l_returnflag) ELSE string_agg(l_returnflag, ';' ORDER BY l_linenumber, l_returnflag) END AS flags, CAST(count(DISTINCT l_returnflag) AS INTEGER) AS n FROM lineitem GROUP BY 1", "arr_dedupe_order", "arr_size_range")
def arr_single_or_list(t):
    rows = t("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag"))).alias("x"))
    flags = F.col("x.l_returnflag")
    return rows.select("l_orderkey", V.single_or_list(flags).alias("flags"), F.size(F.array_distinct(flags)).alias("n"))


@query("SELECT l_orderkey, string_agg(CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' END, ';' ORDER BY l_linenumber, l_returnflag) AS names FROM lineitem GROUP BY 1")
def arr_map_lookup(t):
    rows = t("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag"))).alias("x"))
    names = F.create_map(*[F.lit(v) for kv in (("R", "returned"), ("A", "accepted"), ("N", "none")) for v in kv])
    return rows.select("l_orderkey", F.array_join(F.transform("x.l_returnflag", lambda c: F.element_at(names, c)), ";").alias("names"))


@query("SELECT p_partkey, string_agg(w, ' ' ORDER BY w) AS synonyms FROM (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) WHERE w NOT IN (SELECT split_part(p_name, ' ', 1) FROM part) GROUP BY 1")
def arr_remove_dups_across_rows(t):
    """Synonyms that are another entity's main name go."""
    words = t("part").select("p_partkey", F.explode(F.array_distinct(F.split("p_name", " "))).alias("w"))
    main = t("part").select(F.split("p_name", " ")[0].alias("w")).distinct()
    return words.join(main, "w", "left_anti").groupBy("p_partkey").agg(F.array_join(F.array_sort(F.collect_list("w")), " ").alias("synonyms"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_path(t):
    parsed = t("events").select("event_id", F.from_json("props", "k bigint").alias("p"))
    flat = V.flatten_struct(parsed)
    assert V.has_key(parsed.schema, "k")
    return flat.select("event_id", F.col("p_k").alias("k"))


@query("SELECT p_partkey, replace(p_name, ' ', '|') AS y, CAST(2 AS INTEGER) AS n FROM part")
def json_parse_list(t):
    """A list printed into text, inside noise, is found and parsed; what cannot be parsed gives an empty list."""
    text = F.concat(F.lit("note {"), F.to_json(F.split("p_name", " ")), F.lit("} end"))
    inner = F.regexp_extract(text, r"(?s)\{(.*)\}", 1)
    xs = F.coalesce(F.from_json(inner, "array<string>"), F.array().cast("array<string>"))
    return t("part").select("p_partkey", F.array_join(xs, "|").alias("y"), F.size(xs).alias("n"))


@query("SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING') THEN true WHEN c_mktsegment IN ('MACHINERY') THEN false END AS y FROM customer")
def parse_bool_words(t):
    word = F.when(F.col("c_mktsegment") == "BUILDING", " Yes").when(F.col("c_mktsegment") == "MACHINERY", "no").otherwise(F.col("c_mktsegment"))
    return t("customer").select("c_custkey", X.parse_bool(word).alias("y"))


@query("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, CAST(len(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS BIGINT) AS n_links, coalesce(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)[1], '') AS first_link, CAST(len(regexp_extract_all(html, '<p[ >]')) AS BIGINT) AS n_paragraphs FROM pages")
def scan_html(t):
    """Title, links and paragraphs of scraped pages."""
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    paragraphs = F.regexp_extract_all("html", F.lit("<p[ >]"), F.lit(0))
    return t("pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.size(links).cast("long").alias("n_links"), F.coalesce(F.get(links, F.lit(0)), F.lit("")).alias("first_link"), F.size(paragraphs).cast("long").alias("n_paragraphs"))


@query()
def join_theta_nearest(t):
    """For each name the most alike one of all other names, the earlier one on ties."""
    found = alike_pairs(t("part"), "p_name", 0.6).select(F.col("a").alias("p_name"), F.col("b").alias("reference"), "ratio")
    return W.first_per_key(found, ["p_name"], [F.col("ratio").desc(), F.col("reference")])

"""Queries whose operator is about files, graphs in files and nested JSON; each writes and reads what it is about."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veinloom.functions import addresses as A
from veinloom.functions import text as X
from veinloom.functions import values as V
from veinloom.operators import graph as G
from veinloom.operators import joins as J
from veinloom.operators import ranges
from veinloom.operators import windows as W
from veinloom.plans.base import query
from veinloom.plans.domain_queries import _files, _scratch
from veinloom.sources import readers as R
from veinloom.sources import tables as T

# ---- graphs in files


@_files("sink_node_batch", "SELECT CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / 500) AS BIGINT) AS batch, c_custkey, c_name FROM customer")
def _node_batches(spark, t):
    """Nodes are written in batches of 500 and read back."""
    path = _scratch(spark, "nodes")
    T.write_batches(t("customer").select("c_custkey", "c_name"), path, ["c_custkey"], 500)
    return T.read_batches(spark, path, "c_custkey long, c_name string")


@_files("resume_scan", "SELECT batch, c_custkey FROM (SELECT CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / 500) AS BIGINT) AS batch, c_custkey FROM customer) WHERE batch > 1")
def _resume(spark, t):
    """A load that stopped behind batch 1 goes on with the next; the place is kept in a file."""
    path, mark = _scratch(spark, "nodes"), _scratch(spark, "mark")
    T.write_batches(t("customer").select("c_custkey"), path, ["c_custkey"], 500)
    spark.createDataFrame([(1,)], "last long").write.json(mark)
    last = spark.read.schema("last long").json(mark).first()["last"]  # one row
    return T.read_batches(spark, path, "c_custkey long", after=last)


@_files("sink_edge_batch", "SELECT state, count(*) AS n FROM (SELECT CASE WHEN a AND b THEN 'loaded' WHEN a THEN 'no target' WHEN b THEN 'no source' ELSE 'no ends' END AS state FROM (SELECT l_suppkey % 7 <> 0 AS a, l_partkey % 5 <> 0 AS b FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem))) GROUP BY 1")
def _edge_batches(spark, t):
    """Edges are written and read back; those without one of their ends are told apart."""
    path = _scratch(spark, "edges")
    edges = G.merge_edges(t("lineitem").select("l_suppkey", "l_partkey"), "l_suppkey", "l_partkey")
    R.as_json_records(edges.select("l_suppkey", "l_partkey"), ("l_suppkey", "l_partkey")).write.text(path)
    back = R.read_json(spark, path, "start struct<id: long>, end struct<id: long>", multiline=False).select(F.col("start.id").alias("s"), F.col("end.id").alias("p"))
    suppliers, parts = t("supplier").where("s_suppkey % 7 <> 0").select("s_suppkey"), t("part").where("p_partkey % 5 <> 0").select("p_partkey")
    return T.edge_report(back, "s", suppliers, "p", parts).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


_KEPT_NAMES = "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN upper(s_name) ELSE s_name END AS s_name, CASE WHEN s_suppkey % 3 = 0 THEN 'new' ELSE 'old' END AS kind FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, upper(s_name), 'new' FROM supplier WHERE s_suppkey % 2 = 1 AND s_suppkey % 3 = 0"


@_files("sink_upsert", _KEPT_NAMES)
def _upsert(spark, t):
    """A stored table is upserted into a new version of it, which is then read."""
    old, new = _scratch(spark, "table"), _scratch(spark, "table")
    s = t("supplier")
    s.where("s_suppkey % 2 = 0").select("s_suppkey", "s_name", F.lit("old").alias("kind")).write.parquet(old)
    news = s.where("s_suppkey % 3 = 0").select("s_suppkey", F.upper("s_name").alias("s_name"), F.lit("new").alias("kind"))
    G.upsert(spark.read.parquet(old), news, "s_suppkey", "coalesce").write.parquet(new)
    return spark.read.parquet(new)


@_files("sink_set_props", "SELECT s_suppkey, s_name, CASE WHEN s_nationkey < 10 THEN n_name END AS nation FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def _set_props(spark, t):
    """A property of stored nodes is set by key from a file; other nodes and properties stay."""
    nodes, props, out = (_scratch(spark, x) for x in ("nodes", "props", "nodes"))
    t("supplier").select("s_suppkey", "s_name", F.lit(None).cast("string").alias("nation")).write.parquet(nodes)
    R.write_delimited(t("supplier").join(t("nation"), F.col("n_nationkey") == F.col("s_nationkey")).where("s_nationkey < 10").select("s_suppkey", F.col("n_name").alias("nation")), props)
    news = R.read_delimited(spark, props, "s_suppkey long, nation string")
    J.overwrite(spark.read.parquet(nodes), news, ["s_suppkey"], ["nation"]).write.parquet(out)
    return spark.read.parquet(out)


_HEADER = {"src": "TRIAL", "dst": "DISEASE", "term": "TERM"}


@_files("sink_mapping_file", "SELECT DISTINCT l_orderkey AS src, l_partkey AS dst, l_returnflag AS term FROM lineitem")
def _mapping(spark, t):
    """Edges are exported to a mapping file with its own header, and read back."""
    path = _scratch(spark, "mapping")
    edges = t("lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_returnflag").alias("term")).distinct()
    T.export_mapping(edges, path, _HEADER)
    return R.read_delimited(spark, path, "TRIAL long, DISEASE long, TERM string").select(F.col("TRIAL").alias("src"), F.col("DISEASE").alias("dst"), F.col("TERM").alias("term"))


@_files("load_mapping_file", "SELECT DISTINCT l_orderkey AS src, l_partkey AS dst, 'hand' AS term FROM lineitem WHERE l_returnflag = 'A' AND l_partkey % 5 <> 0 UNION ALL SELECT DISTINCT l_orderkey, l_partkey, l_returnflag FROM lineitem WHERE l_returnflag <> 'R'")
def _load_mapping(spark, t):
    """Edges of one kind are replaced by those of a mapping file whose ends exist."""
    path, l = _scratch(spark, "mapping"), t("lineitem")
    edges = l.select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_returnflag").alias("term")).distinct()
    T.export_mapping(edges.where("term = 'A'").withColumn("term", F.lit("hand")), path, _HEADER)
    return T.replace_from_mapping(edges, spark, path, "TRIAL long, DISEASE long, TERM string", _HEADER, F.col("term") == "R", t("orders").select("o_orderkey"), t("part").where("p_partkey % 5 <> 0").select("p_partkey"))


_LINKS = "SELECT DISTINCT c_custkey AS k, n_nationkey AS n FROM customer JOIN nation ON n_nationkey = c_nationkey"


@query(f"SELECT 'node' AS kind, k AS a, CAST(NULL AS BIGINT) AS b FROM (SELECT c_custkey AS k FROM customer UNION ALL SELECT 10000000 + n_nationkey FROM nation) WHERE k NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 9 = 0) AND k < 10000020 UNION ALL SELECT 'edge', k, 10000000 + n FROM ({_LINKS}) WHERE k % 9 <> 0 AND n < 20")
def delete_nodes(t):
    """Nodes go with all edges that end in them."""
    people = t("customer").select(F.col("c_custkey").cast("long").alias("k"))
    lands = t("nation").select((F.col("n_nationkey") + 10_000_000).cast("long").alias("k"))
    edges = t("customer").select(F.col("c_custkey").cast("long").alias("s"), (F.col("c_nationkey") + 10_000_000).cast("long").alias("d"))
    gone = ((F.col("k") < 10_000_000) & (F.col("k") % 9 == 0)) | (F.col("k") >= 10_000_020)
    nodes, left = G.detach_delete(people.unionByName(lands), edges, "k", "s", "d", gone)
    return nodes.select(F.lit("node").alias("kind"), F.col("k").alias("a"), F.lit(None).cast("long").alias("b")).unionByName(left.select(F.lit("edge").alias("kind"), F.col("s").alias("a"), F.col("d").alias("b")))


@query("SELECT DISTINCT l_orderkey AS src, l_partkey AS dst FROM lineitem EXCEPT SELECT l_orderkey, l_partkey FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size < 10")
def delete_edges(t):
    """Edges go by a property of one of their ends; nodes stay."""
    edges = t("lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst")).distinct()
    return edges.join(t("part").where("p_size < 10").select(F.col("p_partkey").alias("dst")), "dst", "left_anti").select("src", "dst")


@_files("scan_graph_csv", "SELECT '' || n_nationkey AS id, 'Nation' AS kind, n_name AS name FROM nation UNION ALL SELECT 'r' || r_regionkey, 'Region', r_name FROM region UNION ALL SELECT n_nationkey || '>r' || n_regionkey, 'IN', NULL FROM nation", "scan_graph")
def _graph(spark, t):
    """A graph in one table is read as nodes and edges."""
    path = _scratch(spark, "graph")
    nation = t("nation")
    nodes = nation.select(F.col("n_nationkey").cast("string").alias("_id"), F.lit("Nation").alias("_labels"), F.col("n_name").alias("name"))
    nodes = nodes.unionByName(t("region").select(F.concat(F.lit("r"), "r_regionkey").alias("_id"), F.lit("Region").alias("_labels"), F.col("r_name").alias("name")))
    edges = nation.select(F.col("n_nationkey").cast("string").alias("_start"), F.concat(F.lit("r"), "n_regionkey").alias("_end"), F.lit("IN").alias("_type"))
    T.write_graph(nodes, edges, path)
    nodes, edges = T.read_graph(spark, path, "name string")
    named = nodes.select(F.col("_id").alias("id"), F.col("_labels").alias("kind"), "name")
    return named.unionByName(edges.select(F.concat("_start", F.lit(">"), "_end").alias("id"), F.col("_type").alias("kind"), "name"))


@query("SELECT label, property, type, n FROM (SELECT 'nation' AS label, 'n_nationkey' AS property, 'int' AS type, count(n_nationkey) AS n FROM nation UNION ALL SELECT 'nation', 'n_name', 'string', count(n_name) FROM nation UNION ALL SELECT 'region', 'r_name', 'string', count(r_name) FROM region UNION ALL SELECT 'customer', 'name', 'string', count(*) FROM customer WHERE c_custkey % 3 = 0)")
def graph_schema_introspect(t):
    """Labels, their properties with types, and how many nodes have them."""
    people = t("customer").select(F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).alias("name"))
    return G.describe({"nation": t("nation").select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name"), "region": t("region").select("r_name"), "customer": people})


_TRADE = "SELECT c_nationkey AS a, s_nationkey AS b, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2"
_ARCS = f"SELECT a, b FROM ({_TRADE}) WHERE n >= (SELECT avg(n) + 1.2 * stddev_pop(n) FROM ({_TRADE}))"


@query(f"WITH RECURSIVE e AS MATERIALIZED ({_ARCS}), v AS (SELECT a AS x FROM e UNION SELECT b FROM e), r(x, y) AS (SELECT x, x FROM v UNION SELECT r.x, e.b FROM r JOIN e ON e.a = r.y) SELECT p.x AS node, min(p.y) AS component FROM r p JOIN r q ON q.x = p.y AND q.y = p.x GROUP BY 1")
def graph_scc(t):
    """Strongly connected components of the directed graph of which nation buys much from which."""
    bought = t("lineitem").join(t("orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).join(t("supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    trade = bought.groupBy(F.col("c_nationkey").alias("a"), F.col("s_nationkey").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    least = trade.agg((F.avg("n") + 1.2 * F.stddev_pop("n")).alias("least"))  # one row
    return G.strong_components(trade.crossJoin(F.broadcast(least)).where("n >= least").select("a", "b"))


# ---- files


@_files("scan_multi_file", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1")
def _years(spark, t):
    """Files with a year in their names are read as one, with the year as a column."""
    path = _scratch(spark, "years")
    named = t("orders").select("o_orderkey", F.year("o_orderdate").alias("PROJECTS_FY"))
    R.write_delimited(named.repartition("PROJECTS_FY"), path, by="PROJECTS_FY")
    return R.read_years(spark, f"{path}/PROJECTS_FY=*", "o_orderkey long").groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@_files("scan_csv_encoding", "SELECT doc_id, place, line FROM (SELECT doc_id, place - 1 AS place, trim(regexp_replace(regexp_replace(l[place], '\\s+', ' ', 'g'), '[^\\x00-\\xFF]', '?', 'g'), ' ') AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS place FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE lang = 'fr'))) WHERE line <> ''")
def _latin(spark, t):
    """All lines of French texts, through a file in Latin-1, where other letters become question marks."""
    path = _scratch(spark, "latin")
    lines = t("documents").where("lang = 'fr'").select("doc_id", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    rows = lines.select("doc_id", F.col("place").cast("long").alias("place"), F.trim(F.regexp_replace("line", r"\s+", " ")).alias("line")).where("line <> ''")
    rows.write.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').csv(path)
    return R.read_delimited(spark, path, "doc_id long, place long, line string", encoding="ISO-8859-1")


@_files("scan_csv_badlines", "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 4 > 1")
def _bad_lines(spark, t):
    """Lines with a column too many, or a word where a number belongs, are dropped."""
    path = _scratch(spark, "bad")
    line = F.when(F.col("s_suppkey") % 4 == 0, F.concat_ws("|", "s_suppkey", "s_name", F.lit("more"), F.lit("x"))).when(F.col("s_suppkey") % 4 == 1, F.concat_ws("|", F.lit("word"), "s_name")).otherwise(F.concat_ws("|", "s_suppkey", "s_name"))
    t("supplier").select(line.alias("value")).write.text(path)
    return R.read_delimited(spark, path, "s_suppkey long, s_name string", separator="pipe", header=False, drop_bad_lines=True)


# ---- JSON

def _part_json() -> Column:
    """A part as nested JSON text; one in three has a size."""
    return F.to_json(F.struct(F.col("p_partkey").alias("id"), F.struct(F.col("p_name").alias("name"), F.struct(F.col("p_brand").alias("brand"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_size")).alias("size")).alias("maker")).alias("about")))


@_files("scan_json", "SELECT p_partkey AS id, p_name AS name, p_brand AS brand FROM part")
def _json_files(spark, t):
    """Nested JSON files."""
    path = _scratch(spark, "json")
    t("part").select(_part_json().alias("value")).write.text(path)
    rows = R.read_json(spark, path, "id long, about struct<name: string, maker: struct<brand: string, size: int>>", multiline=False)
    return rows.select("id", "about.name", "about.maker.brand")


@query("SELECT p_partkey AS id, p_name AS about_name, p_brand AS about_maker_brand, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS INTEGER) END AS about_maker_size FROM part")
def json_flatten(t):
    """Structs in structs become columns with joined names."""
    parsed = t("part").select(F.from_json(_part_json(), "id bigint, about struct<name: string, maker: struct<brand: string, size: int>>").alias("p")).select("p.*")
    return V.flatten_struct(parsed)


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS INTEGER) ELSE -1 END AS size, 'none' AS colour FROM part")
def default_missing_json(t):
    """Keys that are missing from a JSON text get their defaults."""
    p = F.from_json(_part_json(), "about struct<maker: struct<size: int, colour: string>>")
    return t("part").select("p_partkey", F.coalesce(p["about"]["maker"]["size"], F.lit(-1)).alias("size"), F.coalesce(p["about"]["maker"]["colour"], F.lit("none")).alias("colour"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'about.maker.size' WHEN 1 THEN 'size' END AS path, CASE WHEN p_partkey % 3 < 2 THEN CAST(p_size AS VARCHAR) END AS value FROM part")
def json_find_key(t):
    """Where a key stands in each text, however deep, and its value; null if nowhere."""
    deep = F.concat(F.lit('{"id": 1, "about": {"name": "'), "p_name", F.lit('", "maker": {"size": '), "p_size", F.lit("}}}"))
    flat = F.concat(F.lit('{"size": '), "p_size", F.lit(', "about": {"name": "'), "p_name", F.lit('"}}'))
    text = F.when(F.col("p_partkey") % 3 == 0, deep).when(F.col("p_partkey") % 3 == 1, flat).otherwise(F.lit('{"about": []}'))
    found = V.find_key(text, "size").alias("f")
    return t("part").select("p_partkey", found).select("p_partkey", "f.path", "f.value")


@query("SELECT p_partkey, '{\"name\": \"' || p_name || '\"}' AS y FROM part")
def json_extract_braces(t):
    """What stands in braces inside other text, from the first to the last."""
    noise = F.concat(F.lit("Answer: ``` "), F.concat(F.lit('{"name": "'), "p_name", F.lit('"}')), F.lit(" ``` end"))
    return t("part").select("p_partkey", F.regexp_extract(noise, r"(?s)\{.*\}", 0).alias("y"))


@query("SELECT p_partkey, unnest(['brand', 'name']) AS k, unnest([p_brand, p_name]) AS v FROM part")
def json_pairs_regex(t):
    """Pairs of quoted words out of a text that is no valid JSON."""
    broken = F.concat(F.lit('{"brand": "'), "p_brand", F.lit('", "name" : "'), "p_name", F.lit('", broken'))
    pairs = F.regexp_extract_all(broken, F.lit(r'"[^"]+"\s*:\s*"[^"]*"'), F.lit(0))
    one = t("part").select("p_partkey", F.explode(pairs).alias("p"))
    return one.select("p_partkey", F.regexp_extract("p", r'^"([^"]+)"', 1).alias("k"), F.regexp_extract("p", r':\s*"([^"]*)"$', 1).alias("v"))


# ---- positions, windows, texts


@query("SELECT a.c_name AS name, b.s_name AS other FROM (SELECT c_name, row_number() OVER (ORDER BY c_custkey) AS i FROM customer) a JOIN (SELECT s_name, row_number() OVER (ORDER BY s_suppkey) AS i FROM supplier) b USING (i)")
def join_positional(t):
    """Two sorted lists, place by place, as long as the shorter one."""
    a = W.numbered(t("customer").select("c_custkey", F.col("c_name").alias("name")), ["c_custkey"], "_i")
    b = W.numbered(t("supplier").select("s_suppkey", F.col("s_name").alias("other")), ["s_suppkey"], "_i")
    return a.join(b, "_i").select("name", "other")


_YEARS = "SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n, row_number() OVER (ORDER BY year(o_orderdate)) AS i FROM orders GROUP BY year(o_orderdate)"


@query(f"WITH RECURSIVE y AS MATERIALIZED ({_YEARS}), lim AS MATERIALIZED (SELECT CAST(floor(sum(n) / 3) AS BIGINT) AS l FROM y), g(i, f, t, n, w) AS (SELECT i, y, y, n, 1 FROM y WHERE i = 1 UNION ALL SELECT y.i, CASE WHEN g.n + y.n <= l THEN g.f ELSE y.y END, y.y, CASE WHEN g.n + y.n <= l THEN g.n + y.n ELSE y.n END, CASE WHEN g.n + y.n <= l THEN g.w ELSE g.w + 1 END FROM g JOIN y ON y.i = g.i + 1, lim) SELECT from_year, to_year, n FROM (SELECT f AS from_year, t AS to_year, n, row_number() OVER (PARTITION BY w ORDER BY i DESC) AS r FROM g) WHERE r = 1")
def windowed_fetch(t):
    """Years joined into windows of at most a third of all orders."""
    orders = t("orders")
    limit = orders.count() // 3
    return ranges.fetch_windows(orders.withColumn("d", F.to_date("o_orderdate")), "d", limit)


@query("SELECT p_partkey, p_name || '|' || p_brand AS y FROM part")
def str_split_list(t):
    """A printed list inside a cell, with either kind of marks."""
    printed = F.concat(F.lit("['"), "p_name", F.lit("', \""), "p_brand", F.lit("\"]"))
    return t("part").select("p_partkey", F.array_join(X.parse_list(printed), "|").alias("y"))


_TOWN = "CASE c_custkey % 4 WHEN 0 THEN 'Dept. of ' || c_mktsegment || ', ' || c_name || ', ' || n_name || '. a.b@c.org' WHEN 1 THEN c_name || ', ' || r_name || ' 12345, USA.' WHEN 2 THEN c_name || '; ' || r_name ELSE 'Institute ' || c_mktsegment END"


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN lower(n_name) WHEN 1 THEN 'united states' WHEN 2 THEN 'united states' END AS country, CASE WHEN c_custkey % 4 IN (1, 2) THEN lower(r_name) END AS region, CASE WHEN c_custkey % 4 < 3 THEN lower(c_name) END AS city, CASE WHEN c_custkey % 4 = 1 OR c_custkey % 12 = 2 THEN lpad(CAST(c_custkey AS VARCHAR), 6, '0') WHEN c_custkey % 4 = 2 THEN upper(substring(r_name, 1, 2)) END AS code FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey")
def dom_researcher_address(t):
    """Country, region and city out of free-text affiliations in four forms, and the code of the place or else the region."""
    rows = t("customer").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(t("region"), F.col("r_regionkey") == F.col("n_regionkey")).select("c_custkey", F.expr(_TOWN).alias("affiliation"))
    countries = t("nation").select(F.col("n_name").alias("country")).unionByName(t("nation").sparkSession.createDataFrame([("United States",)], "country string")).distinct()
    regions = t("region").select(F.col("r_name").alias("region"), F.lit("united states").alias("country"))
    # Codes of places (two thirds of them are known) and of whole regions.
    places = t("customer").where("c_custkey % 4 = 1 or c_custkey % 12 = 2").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(t("region"), F.col("r_regionkey") == F.col("n_regionkey"))
    codes = places.select(F.col("r_name").alias("region"), F.col("c_name").alias("place"), F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("code"))
    codes = codes.unionByName(t("region").select(F.col("r_name").alias("region"), F.lit(None).cast("string").alias("place"), F.upper(F.substring("r_name", 1, 2)).alias("code")))
    located = A.locate(rows, "affiliation", countries, regions, "united states")
    return A.with_codes(located, codes).select("c_custkey", "country", "region", "city", "code")

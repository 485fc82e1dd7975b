"""Filters, joins, aggregates, windows, sets and graph upserts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from veinloom.functions import values as V
from veinloom.operators import aggregates as A
from veinloom.operators import graph as G
from veinloom.operators import joins as J
from veinloom.operators import windows as W
from veinloom.operators.lineage import checkpointed
from veinloom.plans.base import day, money, query

# ---- counts and aggregates


@query("SELECT p_partkey, count(DISTINCT o_orderkey) AS n_orders FROM part LEFT JOIN lineitem ON l_partkey = p_partkey LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY p_partkey", "agg_count_distinct", "join_multi_hop", "graph_degree")
def agg_count_zero_default(t):
    """Distinct orders of every part over two hops, 0 where there is none."""
    edges = t("lineitem").select("l_partkey", "l_orderkey").join(t("orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return G.neighbour_counts(t("part"), "p_partkey", edges, "l_partkey", "o_orderkey", "n_orders")


@query("SELECT o_custkey, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-06-30' GROUP BY o_custkey", "filter_date_list")
def agg_count(t):
    return t("orders").where(day("o_orderdate").between("1996-01-01", "1996-06-30")).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_brand, p_type, count(*) AS n FROM part WHERE p_brand IS NOT NULL AND p_type IS NOT NULL GROUP BY ALL")
def agg_group_size(t):
    return t("part").where("p_brand is not null and p_type is not null").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(DISTINCT p_name) AS n_names, count(DISTINCT p_brand) AS n_brands FROM part")
def agg_nunique(t):
    return t("part").agg(F.countDistinct("p_name").alias("n_names"), F.countDistinct("p_brand").alias("n_brands"))


@query("SELECT max(n) AS most, min(n) AS least, round(avg(n), 4) AS mean FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)")
def agg_min_max_mean(t):
    return t("lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.min("n").alias("least"), F.round(F.avg("n"), 4).alias("mean"))


@query("SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_suppkey)), ',') AS suppliers FROM lineitem GROUP BY 1", "map_group_to_dict", "graph_neighbour_sets")
def agg_collect_set_sorted(t):
    return t("lineitem").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("l_suppkey")).cast("array<string>"), ",").alias("suppliers"))


@query("SELECT p_brand, string_agg(CASE WHEN p_type = 'ECONOMY' THEN CAST(p_partkey AS VARCHAR) END, ',' ORDER BY p_partkey) AS economy, string_agg(CASE WHEN p_type = 'PROMO' THEN CAST(p_partkey AS VARCHAR) END, ',' ORDER BY p_partkey) AS promo FROM part GROUP BY 1")
def agg_collect_list(t):
    """Ids as lists per kind, in columns: a pivot to lists over fixed kinds."""
    of = lambda kind: F.array_join(F.array_sort(F.collect_list(F.when(F.col("p_type") == kind, F.col("p_partkey")))).cast("array<string>"), ",")
    return t("part").groupBy("p_brand").agg(*[F.when(F.count(F.when(F.col("p_type") == k, 1)) > 0, of(k)).alias(k.lower()) for k in ("ECONOMY", "PROMO")])


@query("SELECT p_brand, p_name, min(p_partkey) AS p_partkey, arg_min(p_size, p_partkey) AS p_size, arg_min(p_type, p_partkey) AS p_type FROM (SELECT p_brand, p_name, p_partkey, CASE WHEN p_size > 5 THEN p_size END AS p_size, p_type FROM part) GROUP BY 1, 2", "graph_entity_resolution")
def agg_first(t):
    """Parts of equal brand and name become one, with the first value of each property that is not null."""
    parts = t("part").select("p_brand", "p_name", "p_partkey", F.when(F.col("p_size") > 5, F.col("p_size")).alias("p_size"), "p_type")
    return G.resolve_entities(parts, ["p_brand", "p_name"], "p_partkey")[0]


@query("SELECT l_orderkey, l_suppkey, count(*) AS n FROM (SELECT l_orderkey, l_suppkey, m.k AS l_partkey FROM lineitem JOIN (SELECT p.p_partkey, s.k FROM part p JOIN (SELECT p_brand, p_name, min(p_partkey) AS k FROM part GROUP BY 1, 2) s USING (p_brand, p_name)) m ON m.p_partkey = l_partkey) GROUP BY 1, 2")
def graph_repoint_edges(t):
    """Edges of merged parts go to the survivor."""
    _, mapping = G.resolve_entities(t("part").select("p_brand", "p_name", "p_partkey"), ["p_brand", "p_name"], "p_partkey")
    edges = G.repoint(t("lineitem").select("l_orderkey", "l_suppkey", "l_partkey"), "l_partkey", mapping)
    return edges.groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_nationkey, string_agg(c_name, ', ' ORDER BY c_custkey) AS names FROM customer WHERE c_acctbal > 0 GROUP BY 1")
def agg_string_concat(t):
    rows = t("customer").where("c_acctbal > 0").groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))).alias("x"))
    return rows.select("c_nationkey", F.array_join("x.c_name", ", ").alias("names"))


@query("SELECT o_custkey, string_agg(o_orderpriority, ' | ' ORDER BY k) AS priorities FROM (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS k FROM orders GROUP BY 1, 2) GROUP BY 1")
def agg_dedup_join(t):
    """Different values in the order of their first row."""
    first = t("orders").groupBy("o_custkey", "o_orderpriority").agg(F.min("o_orderkey").alias("k"))
    rows = first.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("k", "o_orderpriority"))).alias("x"))
    return rows.select("o_custkey", F.array_join("x.o_orderpriority", " | ").alias("priorities"))


@query("SELECT k, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n_nationkey AS k, 1 AS n FROM nation UNION ALL SELECT c_nationkey, count(*) FROM customer GROUP BY 1 UNION ALL SELECT s_nationkey, count(*) FROM supplier GROUP BY 1) GROUP BY k", "set_union_all")
def agg_sum_dicts(t):
    parts = [t("nation").select(F.col("n_nationkey").alias("k"), F.lit(1).cast("long").alias("n")), t("customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n")), t("supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("k").agg(F.sum("n").cast("long").alias("n"))


@query("SELECT c_nationkey AS k, count(DISTINCT c_mktsegment) AS n FROM (SELECT c_nationkey, c_mktsegment FROM customer UNION SELECT s_nationkey, 'SUPPLIER' FROM supplier) GROUP BY 1")
def agg_merge_sets(t):
    both = t("customer").select(F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("v")).unionByName(t("supplier").select(F.col("s_nationkey").alias("k"), F.lit("SUPPLIER").alias("v"))).distinct()
    return both.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT k, CAST(max(rank_) AS INTEGER) AS source, arg_max(v, rank_) AS v FROM (SELECT n_nationkey AS k, n_name AS v, 1 AS rank_ FROM nation UNION ALL SELECT r_regionkey, r_name, 2 FROM region) GROUP BY k")
def set_dict_merge(t):
    """Two dictionaries, of which the later one's entries win."""
    rows = t("nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v"), F.lit(1).alias("source")).unionByName(t("region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("v"), F.lit(2).alias("source")))
    return W.first_per_key(rows, ["k"], [F.col("source").desc()])


@query("SELECT brand_key, count(*) AS n FROM (SELECT 'brand' AS brand_key FROM part UNION ALL SELECT 'type' FROM part UNION ALL SELECT 'size' FROM part WHERE p_size > 20) GROUP BY 1", "str_split_kv")
def agg_counter_keys(t):
    """How often each key occurs in text of the form `key: value; key: value`."""
    text = F.concat(F.lit("brand: "), "p_brand", F.lit("; type: "), "p_type", F.when(F.col("p_size") > 20, F.concat(F.lit("; size: "), F.col("p_size").cast("string"))).otherwise(""))
    pairs = t("part").select(F.explode(F.split(text, "; ")).alias("kv"))
    return pairs.groupBy(F.element_at(F.split("kv", ":", 2), 1).alias("brand_key")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM (SELECT DISTINCT o_custkey, o_orderkey, o_totalprice FROM orders JOIN lineitem ON l_orderkey = o_orderkey) GROUP BY 1")
def agg_running_total_on_create(t):
    """Costs count once for each new edge, however often it is asserted; null costs count nothing."""
    edges = t("lineitem").select("l_orderkey").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "o_orderkey", "o_totalprice").distinct()
    return edges.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).cast("double").alias("total"))


@query("SELECT user_id, CAST(sum(CASE event_type WHEN 'click' THEN 5 WHEN 'purchase' THEN 7 WHEN 'view' THEN 3 ELSE 1 END) AS BIGINT) AS score FROM events GROUP BY 1")
def agg_weighted_sum(t):
    weight = F.when(F.col("event_type") == "click", 5).when(F.col("event_type") == "purchase", 7).when(F.col("event_type") == "view", 3).otherwise(1)
    return t("events").groupBy("user_id").agg(F.sum(weight).cast("long").alias("score"))


_PAIRS = "SELECT x.l_suppkey AS a, y.l_suppkey AS b, count(*) AS weight FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) x JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) y ON x.l_orderkey = y.l_orderkey AND x.l_suppkey < y.l_suppkey GROUP BY 1, 2"


@query(f"SELECT a, b, weight % 1000 AS weight FROM ({_PAIRS})", "agg_edge_multiplicity", "graph_undirected_dedupe", "num_modulo")
def join_self_coparticipation(t):
    """Pairs of suppliers and the orders they share; each pair once, smaller key first."""
    return J.co_participation(t("lineitem"), "l_orderkey", "l_suppkey").withColumn("weight", F.col("weight") % 1000)


_SCORED = "SELECT quality, CASE WHEN n_chars >= 800 THEN 1 ELSE 0 END AS guess FROM labels JOIN documents USING (doc_id)"


@query(f"SELECT sum((quality = 1 AND guess = 1)::INT)::BIGINT AS tp, sum((quality = 0 AND guess = 1)::INT)::BIGINT AS fp, sum((quality = 1 AND guess = 0)::INT)::BIGINT AS fn, sum((quality = 0 AND guess = 0)::INT)::BIGINT AS tn, round(avg((quality = guess)::INT), 6) AS accuracy FROM ({_SCORED})")
def agg_confusion_matrix(t):
    rows = t("labels").join(t("documents").select("doc_id", "n_chars"), "doc_id").select(F.col("quality") == 1, F.col("n_chars") >= 800).toDF("y", "g")
    n = lambda c: F.sum(c.cast("long")).cast("long")
    y, g = F.col("y"), F.col("g")
    return rows.agg(n(y & g).alias("tp"), n(~y & g).alias("fp"), n(y & ~g).alias("fn"), n(~y & ~g).alias("tn"), F.round(F.avg((y == g).cast("int")), 6).alias("accuracy"))


_GRID = (0.125, 0.25, 0.5, 0.75)
_COMBINED = {"alone": "a", "product": "a * b", "mean": "(a + b) / 2"}
_SWEEP = ", ".join(f"struct_pack(combiner := '{k}', score := {v})" for k, v in _COMBINED.items())


@query(f"SELECT combiner, cutoff, round(avg(((score >= cutoff) = (quality = 1))::INT), 6) AS accuracy, count(*) FILTER (WHERE score >= cutoff) AS reached FROM (SELECT quality, unnest([{_SWEEP}], recursive := true) FROM (SELECT quality, least(n_chars, 4096) / 4096.0::DOUBLE AS a, CASE WHEN lang = 'en' THEN 1.0 ELSE 0.5 END::DOUBLE AS b FROM labels JOIN documents USING (doc_id))), (SELECT unnest({list(_GRID)}::DOUBLE[]) AS cutoff) GROUP BY 1, 2")
def agg_threshold_sweep(t):
    """Two scores combined in three ways, against a grid of cutoffs, in one scan."""
    docs = t("documents").select("doc_id", (F.least(F.col("n_chars"), F.lit(4096)) / 4096.0).alias("a"), F.when(F.col("lang") == "en", 1.0).otherwise(0.5).alias("b"))
    return A.threshold_sweep(t("labels").join(docs, "doc_id"), F.col("quality") == 1, {k: F.expr(v) for k, v in _COMBINED.items()}, list(_GRID))


@query("SELECT c AS cutoff, count(*) FILTER (WHERE n_chars >= c) AS labels, sum(CASE WHEN n_chars >= c THEN n_chars ELSE 0 END)::BIGINT AS occurrences, round(100.0 * count(*) FILTER (WHERE n_chars >= c) / count(*), 4) AS coverage FROM documents, (SELECT unnest([200, 500, 1000, 2000, 4000]) AS c) GROUP BY 1")
def agg_cutoff_coverage(t):
    rows = t("documents").select("n_chars", F.explode(F.array(*[F.lit(c) for c in (200, 500, 1000, 2000, 4000)])).alias("cutoff"))
    hit = F.col("n_chars") >= F.col("cutoff")
    return rows.groupBy("cutoff").agg(F.count(F.when(hit, 1)).alias("labels"), F.sum(F.when(hit, F.col("n_chars")).otherwise(0)).cast("long").alias("occurrences"), F.round(100.0 * F.count(F.when(hit, 1)) / F.count(F.lit(1)), 4).alias("coverage"))


@query("SELECT c AS cutoff, sum(quality)::BIGINT AS correct, count(quality) AS reviewed FROM labels JOIN documents USING (doc_id), (SELECT unnest([200, 1000, 4000]) AS c) WHERE n_chars >= c GROUP BY 1")
def agg_manual_accuracy(t):
    rows = t("labels").join(t("documents").select("doc_id", "n_chars"), "doc_id").withColumn("cutoff", F.explode(F.array(*[F.lit(c) for c in (200, 1000, 4000)]))).where("n_chars >= cutoff")
    return rows.groupBy("cutoff").agg(F.sum("quality").cast("long").alias("correct"), F.count("quality").alias("reviewed"))


@query(f"SELECT a AS supplier, count(*) AS n FROM (SELECT a, b FROM ({_PAIRS}) UNION ALL SELECT b, a FROM ({_PAIRS})) GROUP BY 1")
def agg_community_size(t):
    pairs = J.co_participation(t("lineitem"), "l_orderkey", "l_suppkey")
    return G.undirected_degree(pairs, "a", "b").select(F.col("node").alias("supplier"), F.col("degree").alias("n"))


@query("SELECT l_partkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_nationkey < 5 GROUP BY 1 HAVING count(DISTINCT s_nationkey) = (SELECT count(DISTINCT s_nationkey) FROM supplier WHERE s_nationkey < 5)", "set_intersect")
def agg_shared_intersection(t):
    """Parts that suppliers of all the chosen nations deliver."""
    chosen = t("supplier").where("s_nationkey < 5").select("s_suppkey", "s_nationkey")
    wanted = chosen.agg(F.countDistinct("s_nationkey").alias("n"))
    seen = t("lineitem").select("l_partkey", "l_suppkey").join(chosen, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("l_partkey").agg(F.countDistinct("s_nationkey").alias("c"))
    return seen.join(F.broadcast(wanted), F.col("c") == F.col("n"), "left_semi").select("l_partkey")


@query("SELECT count(*) FILTER (WHERE side = 'order') AS lines_without_order, count(*) FILTER (WHERE side = 'line') AS orders_without_line FROM (SELECT 'order' AS side FROM lineitem WHERE l_orderkey % 7 = 0 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'line' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))", "graph_orphan_drop")
def agg_orphan_count(t):
    """Edges without a node on one side; every seventh order is taken away so that some exist."""
    lines, orders = t("lineitem").select("l_orderkey"), t("orders").select("o_orderkey")
    gone = J.endpoints_missing(lines, "l_orderkey", orders.where("o_orderkey % 7 <> 0"), "o_orderkey").agg(F.count(F.lit(1)).alias("lines_without_order"))
    bare = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").agg(F.count(F.lit(1)).alias("orders_without_line"))
    return gone.crossJoin(bare)  # one row each


# ---- filters and joins


@query("SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)", "join_semi")
def filter_isin(t):
    return t("customer").join(t("nation").where("n_regionkey = 1"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_custkey", "c_name")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)", "join_anti", "filter_not_exists_edge", "set_except")
def filter_not_in(t):
    return t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') OR o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.08)")
def filter_or_masks(t):
    lines = t("lineitem")
    return J.referenced_by_any(t("orders").select("o_orderkey"), "o_orderkey", [lines.where("l_returnflag = 'R'").select("l_orderkey"), lines.where("l_discount > 0.08").select("l_orderkey")])


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL AND trim(c_mktsegment) <> ''", "filter_blank", "project_cols")
def filter_null(t):
    return t("customer").where(F.col("c_mktsegment").isNotNull() & (F.trim("c_mktsegment") != "")).select("c_custkey", "c_mktsegment")


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE CAST(o_orderdate AS DATE) >= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - INTERVAL 1 YEAR")
def filter_recent(t):
    """Not older than a year before the latest day."""
    orders = t("orders").select("o_orderkey", day("o_orderdate").alias("d"))
    today = orders.agg(F.max("d").alias("today"))
    return orders.join(F.broadcast(today), F.col("d") >= F.add_months("today", -12)).select("o_orderkey", F.col("d").cast("string").alias("day"))


@query("SELECT l_orderkey, count(*) AS n FROM (SELECT l_orderkey, list(l_returnflag) AS flags FROM lineitem GROUP BY 1) WHERE list_has_any(flags, ['R', 'A']) GROUP BY 1", "filter_any_pred")
def filter_any_overlap(t):
    sets = t("lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("flags"))
    return sets.where(F.arrays_overlap("flags", F.array(F.lit("R"), F.lit("A")))).select("l_orderkey", F.lit(1).cast("long").alias("n"))


@query("SELECT l_orderkey, array_to_string([x for x in list_sort(list(DISTINCT l_suppkey)) if x > 50], ',') AS high FROM lineitem GROUP BY 1")
def filter_list_elem(t):
    return t("lineitem").groupBy("l_orderkey").agg(F.array_join(F.filter(F.array_sort(F.collect_set("l_suppkey")), lambda x: x > 50).cast("array<string>"), ",").alias("high"))


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END AS side, coalesce(nullif(c_mktsegment, 'BUILDING'), c_name) AS filled, 'customer' AS kind FROM customer", "fill_null", "computed_const")
def case_conditional(t):
    filled = F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), "c_name")
    return t("customer").select("c_custkey", F.when(F.col("c_acctbal") < 0, "debt").otherwise("credit").alias("side"), filled.alias("filled"), F.lit("customer").alias("kind"))


@query("SELECT c_custkey, CASE WHEN c_acctbal >= 8000 THEN 'top' WHEN c_acctbal >= 4000 THEN 'middle' WHEN c_acctbal >= 0 THEN 'low' ELSE 'none' END AS band, CASE WHEN c_acctbal / 10000 >= 0.9 THEN 'HIGH' ELSE 'MEDIUM' END AS confidence, c_acctbal >= 8000 AS at_8000, c_acctbal >= 4000 AS at_4000 FROM customer", "confidence_bucket", "threshold_flags")
def score_band(t):
    rows = t("customer")
    flags = [(F.col("c_acctbal") >= c).alias(f"at_{c}") for c in (8000, 4000)]
    return rows.select("c_custkey", V.banded(F.col("c_acctbal"), [(8000, "top"), (4000, "middle"), (0, "low")], "none").alias("band"), V.confidence(F.col("c_acctbal") / 10000).alias("confidence"), *flags)


@query("SELECT o_orderkey, o_custkey, c_name, n_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey", "join_inner_equi")
def join_left_equi(t):
    named = t("orders").join(t("customer"), F.col("c_custkey") == F.col("o_custkey"), "left").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return named.select("o_orderkey", "o_custkey", "c_name", "n_name")


@query("SELECT coalesce(o.k, l.k) AS k, n, CASE WHEN o.k IS NULL THEN 'right_only' WHEN l.k IS NULL THEN 'left_only' ELSE 'both' END AS origin FROM (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 5 <> 0) o FULL JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) l ON o.k = l.k")
def join_outer_indicator(t):
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return J.outer_with_origin(t("orders").where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("k")), lines, ["k"])


_RECOMPUTED = "SELECT l_orderkey AS o_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price FROM lineitem GROUP BY 1"


@query(f"SELECT o_orderkey, CAST(CASE WHEN price IS NOT NULL THEN price ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DOUBLE) AS price FROM (SELECT o_orderkey, o_totalprice FROM orders) LEFT JOIN ({_RECOMPUTED}) USING (o_orderkey)")
def join_overwrite(t):
    orders = t("orders").select("o_orderkey", money("o_totalprice").cast("decimal(38,2)").alias("price"))
    news = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(money("l_extendedprice")).cast("decimal(38,2)").alias("price"))
    return J.overwrite(orders, news, ["o_orderkey"], ["price"]).withColumn("price", F.col("price").cast("double"))


@query("SELECT l_returnflag, l_linestatus, norm, count(*) AS n FROM (SELECT l_returnflag, l_linestatus, CASE WHEN l_quantity > 25 THEN 'big' END AS bucket FROM lineitem) f LEFT JOIN (VALUES ('R', 'O', 'big', 'open return'), ('R', 'F', NULL, 'late'), ('N', 'O', NULL, 'small open')) r(a, b, c, norm) ON l_returnflag IS NOT DISTINCT FROM a AND l_linestatus IS NOT DISTINCT FROM b AND bucket IS NOT DISTINCT FROM c GROUP BY 1, 2, 3", "dom_assay_normalize")
def join_null_safe(t):
    """Rules on three columns where a null is a value like others, and of two rules for one key the later one wins."""
    facts = t("lineitem").select("l_returnflag", "l_linestatus", F.when(F.col("l_quantity") > 25, "big").alias("bucket"))
    rules = facts.sparkSession.createDataFrame([("R", "O", "big", "old", 1), ("R", "O", "big", "open return", 2), ("R", "F", None, "late", 3), ("N", "O", None, "small open", 4)], "l_returnflag string, l_linestatus string, bucket string, norm string, at int")
    return J.apply_rules(facts, rules, ["l_returnflag", "l_linestatus", "bucket"], "at", ["norm"]).groupBy("l_returnflag", "l_linestatus", "norm").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, coalesce(f.v, g.v, '') AS v FROM customer LEFT JOIN (SELECT s_nationkey AS k, 'BUILDING' AS seg, min(s_name) AS v FROM supplier WHERE s_nationkey < 10 GROUP BY 1) f ON f.k = c_nationkey AND f.seg = c_mktsegment LEFT JOIN (SELECT n_nationkey AS k, n_name AS v FROM nation WHERE n_nationkey < 20) g ON g.k = c_nationkey", "join_composite")
def join_lookup_fallback(t):
    fine = t("supplier").where("s_nationkey < 10").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.min("s_name").alias("v")).withColumn("c_mktsegment", F.lit("BUILDING"))
    coarse = t("nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("v"))
    return J.lookup_with_fallback(t("customer"), fine, coarse, ["c_nationkey", "c_mktsegment"], ["c_nationkey"], "v").select("c_custkey", "v")


@query("SELECT p_partkey, n FROM part JOIN (SELECT upper(p_name) AS u, count(*) AS n FROM part GROUP BY 1) d ON lower(p_name) = lower(u)")
def join_case_insensitive(t):
    names = t("part").groupBy(F.upper("p_name").alias("u")).agg(F.count(F.lit(1)).alias("n"))
    return t("part").join(names, F.lower("p_name") == F.lower("u")).select("p_partkey", "n")


@query("SELECT r_name, c AS cutoff FROM region, (SELECT unnest([10, 20, 30]) AS c)")
def join_cross(t):
    """Every region with every cutoff of a literal list."""
    return t("region").select("r_name", F.explode(F.array(*[F.lit(c) for c in (10, 20, 30)])).alias("cutoff"))


@query("SELECT o_orderkey, o_custkey, l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3", "graph_merge_edge")
def join_graph_pattern(t):
    """Edges between nodes that exist, each once."""
    edges = t("lineitem").select("l_orderkey", "l_partkey").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", "o_custkey", "l_partkey")
    return J.with_both_ends(G.merge_edges(edges, "o_orderkey", "l_partkey", ["o_custkey"]), "o_custkey", t("customer").select("c_custkey"), "l_partkey", t("part").select("p_partkey")).select("o_orderkey", "o_custkey", "l_partkey")


# ---- windows, order, sets

_FIRST = "SELECT o_custkey, o_orderkey, position FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS position FROM orders)"


@query(f"SELECT o_custkey, o_orderkey FROM ({_FIRST}) WHERE position = 1", "set_group_keep_one")
def win_first_per_key(t):
    return W.first_per_key(t("orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query(f"SELECT o_custkey, count(*) FILTER (WHERE position = 1) AS kept, count(*) FILTER (WHERE position > 1) AS merged FROM ({_FIRST}) GROUP BY 1")
def win_head_tail(t):
    rows = W.position_in_key(t("orders").select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return rows.groupBy("o_custkey").agg(F.count(F.when(F.col("position") == 1, 1)).alias("kept"), F.count(F.when(F.col("position") > 1, 1)).alias("merged"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, 'PRJ-' || CASE WHEN n < 100000 THEN lpad(CAST(n AS VARCHAR), 5, '0') ELSE CAST(n AS VARCHAR) END AS key FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders)")
def win_surrogate_key(t):
    """Keys by number for whole rows."""
    return W.surrogate_keys(t("orders").select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey"], "PRJ-")


@query("SELECT o_orderkey, o_orderstatus, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 1000) AS BIGINT) AS batch FROM orders")
def batch_ids(t):
    return W.batches(t("orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], 1000)


@query("SELECT l_partkey, l_suppkey FROM (SELECT l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_suppkey, l_orderkey) AS r FROM lineitem) WHERE r = 1")
def win_argmax(t):
    """Best price; the least keys win ties."""
    return t("lineitem").groupBy("l_partkey").agg(F.max_by("l_suppkey", F.struct("l_extendedprice", -F.col("l_suppkey"), -F.col("l_orderkey"))).alias("l_suppkey"))


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk(t):
    return t("orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20).select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey")
def sort_single(t):
    return t("orders").orderBy("o_orderkey").select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_multi(t):
    return t("orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").select("o_orderkey", "o_custkey")


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS r FROM documents) WHERE r <= 5")
def sample_stratified(t):
    return W.stratified(t("documents").select("doc_id", "lang"), "lang", "doc_id", 5)


@query("SELECT DISTINCT p_brand, p_type FROM part")
def set_distinct(t):
    return t("part").select("p_brand", "p_type").distinct()


# ---- upserts

_OLD = "SELECT c_custkey AS k, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS name, c_mktsegment AS seg FROM customer WHERE c_custkey % 4 <> 0"
_NEW = "SELECT c_custkey AS k, CASE WHEN c_custkey % 5 <> 0 THEN upper(c_name) END AS name, 'NEW' AS seg FROM customer WHERE c_custkey % 2 = 0"


def _old_new(t):
    c = t("customer")
    old = c.where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("name"), F.col("c_mktsegment").alias("seg"))
    new = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 5 != 0, F.upper("c_name")).alias("name"), F.lit("NEW").alias("seg"))
    return old, new


@query(f"SELECT k, coalesce(n.name, o.name) AS name, coalesce(n.seg, o.seg) AS seg FROM ({_OLD}) o FULL JOIN ({_NEW}) n USING (k)")
def graph_upsert_coalesce(t):
    return G.upsert(*_old_new(t), "k", "coalesce")


@query(f"SELECT k, CASE WHEN n.seg IS NOT NULL THEN n.name ELSE o.name END AS name, CASE WHEN n.seg IS NOT NULL THEN n.seg ELSE o.seg END AS seg FROM ({_OLD}) o FULL JOIN ({_NEW}) n USING (k)")
def graph_upsert_overwrite(t):
    return G.upsert(*_old_new(t), "k", "overwrite")


@query(f"SELECT * FROM ({_OLD}) UNION ALL SELECT * FROM ({_NEW}) WHERE k NOT IN (SELECT k FROM ({_OLD}))")
def graph_merge_node(t):
    return G.merge_nodes(*_old_new(t), "k")


@query(f"SELECT k, CASE WHEN k IN (SELECT k FROM ({_OLD})) THEN 'update' ELSE 'create' END AS action FROM ({_NEW})")
def graph_update_new_flag(t):
    old, new = _old_new(t)
    return new.join(old.select("k", F.lit(True).alias("known")), "k", "left").select("k", F.when(F.col("known"), "update").otherwise("create").alias("action"))


@query("SELECT child, parent FROM (SELECT n_name AS child, r_name AS parent FROM nation JOIN region ON r_regionkey = n_regionkey UNION SELECT r_name, 'WORLD' FROM region)")
def graph_hierarchy(t):
    """Child to parent edges from rows of (node, parent, child)."""
    pairs = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = pairs.select(F.col("r_name").alias("node"), F.lit("WORLD").alias("parent"), F.col("n_name").alias("child"))
    return G.hierarchy(rows, "node", "parent", "child")


@query("SELECT DISTINCT l_orderkey AS src, l_partkey AS dst, l_returnflag AS kind FROM lineitem")
def graph_edge_property(t):
    """Edges whose key has a property: one for each value of it."""
    return G.merge_edges(t("lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_returnflag").alias("kind")), "src", "dst", ["kind"])


def _strong_pairs(t):
    """Pairs of suppliers over all orders whose weight is the mean and one and a half standard deviations or more.
    Suppliers without such a pair are no nodes of the graph."""
    pairs = J.co_participation(t("lineitem"), "l_orderkey", "l_suppkey")
    least = pairs.agg((F.avg("weight") + 1.5 * F.stddev_pop("weight")).alias("least"))
    return pairs.crossJoin(F.broadcast(least)).where("weight >= least").drop("least")


_ONCE = "SELECT DISTINCT l_orderkey AS o, l_suppkey AS s FROM lineitem WHERE l_orderkey IS NOT NULL AND l_suppkey IS NOT NULL"
_PAIRS = f"SELECT x.s AS a, y.s AS b, count(*) AS weight FROM ({_ONCE}) x JOIN ({_ONCE}) y ON x.o = y.o AND x.s < y.s GROUP BY 1, 2"
_STRONG = f"SELECT a, b FROM ({_PAIRS}) WHERE weight >= (SELECT avg(weight) + 1.5 * stddev_pop(weight) FROM ({_PAIRS}))"
_SPARSE = f"SELECT a, b FROM ({_STRONG}) UNION ALL SELECT b, a FROM ({_STRONG})"


@query(f"WITH RECURSIVE e AS ({_SPARSE}), r(node, other) AS (SELECT a, a FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.other) SELECT node, min(other) AS component FROM r GROUP BY 1")
def graph_components(t):
    """Connected components of an undirected graph."""
    return G.components(_strong_pairs(t).select("a", "b"))


@query()
def graph_louvain(t):
    """Communities of the supplier graph; a partition of its nodes."""
    return G.communities(_strong_pairs(t))


@query()
def graph_modularity(t):
    """Modularity of the communities and of single nodes."""
    pairs = checkpointed(_strong_pairs(t))
    parts = G.communities(pairs)
    single = parts.select("node", F.col("node").alias("community"))
    return G.modularity(pairs, parts).withColumn("kind", F.lit("communities")).unionByName(G.modularity(pairs, single).withColumn("kind", F.lit("single")))


@query("SELECT o_custkey, o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders")
def win_group_total(t):
    return t("orders").select("o_custkey", "o_orderkey", F.count(F.lit(1)).over(Window.partitionBy("o_custkey")).alias("n"))

"""Queries: filters, sorts, pages, facets, search, trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators import browse, search, tree
from lectern.operators.eav import flatten_fields
from lectern.plans.registry import query, table

BRANDS, SIZES = ["Brand#1", "brand#12", "Brand#7"], [1, 7, 11, 23, 42]
_PART_FILTER = "lower(p_brand) IN ('brand#1', 'brand#12', 'brand#7') AND p_size IN (1, 7, 11, 23, 42)"


def parts_eav(parts: DataFrame) -> DataFrame:
    return flatten_fields(parts, "p_partkey", ["p_brand", "p_type", "p_size"])


def filtered_parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    parts = table(spark, sf, "part")
    eav = parts_eav(parts)
    rows = browse.where_field(parts, eav, "p_partkey", "p_brand", BRANDS)
    return browse.where_field(rows, eav, "p_partkey", "p_size", [str(s) for s in SIZES], numeric=True), eav


@query(f"SELECT p_partkey, p_name, p_brand, p_size FROM part WHERE {_PART_FILTER}")
def browse_filter_or_and(spark, sf):
    return filtered_parts(spark, sf)[0].select("p_partkey", "p_name", "p_brand", "p_size")


@query(f"SELECT p_partkey, p_name FROM part WHERE {_PART_FILTER} ORDER BY lower(p_name), p_partkey LIMIT 10 OFFSET 10")
def browse_page_sorted(spark, sf):
    rows = filtered_parts(spark, sf)[0].select("p_partkey", "p_name")
    return browse.page(browse.sort_by_name(rows, "p_name", "p_partkey"), 2, 10)


@query(f"SELECT count(*)::BIGINT AS total FROM part WHERE {_PART_FILTER}")
def browse_total(spark, sf):
    return filtered_parts(spark, sf)[0].agg(F.count(F.lit(1)).alias("total"))


def order_flags(spark, sf) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return lines.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_returnflag", "l_linestatus", "l_linenumber")).alias("flags"))


@query("SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber IN (1, 2)")
def browse_same_element_pair(spark, sf):
    wanted = {"l_returnflag": ["r"], "l_linestatus": ["F"], "l_linenumber": [1, 2]}
    return order_flags(spark, sf).filter(browse.same_element(F.col("flags"), wanted)).select("l_orderkey")


@query("SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING bool_or(l_returnflag = 'R') AND bool_or(l_linestatus = 'F')")
def browse_cross_element(spark, sf):
    return order_flags(spark, sf).filter(browse.any_element(F.col("flags"), {"l_returnflag": ["R"], "l_linestatus": ["F"]})).select("l_orderkey")


@query("SELECT p_type AS value, count(DISTINCT p_partkey)::BIGINT AS n FROM part WHERE p_size IN (1, 7, 11, 23, 42) GROUP BY 1")
def facet_own_filter_excluded(spark, sf):
    parts = table(spark, sf, "part")
    eav = parts_eav(parts)
    others = browse.where_field(parts, eav, "p_partkey", "p_size", [str(s) for s in SIZES], numeric=True)
    return browse.facet(others, eav, "p_partkey", "p_type")


@query("SELECT CAST(p_size AS VARCHAR) AS value, count(*)::BIGINT AS n FROM part WHERE lower(p_brand) IN ('brand#1', 'brand#12', 'brand#7') GROUP BY 1")
def facet_numeric(spark, sf):
    parts = table(spark, sf, "part")
    eav = parts_eav(parts)
    return browse.facet(browse.where_field(parts, eav, "p_partkey", "p_brand", BRANDS), eav, "p_partkey", "p_size", numeric=True)


_ORDERS = "SELECT o.*, c_mktsegment, n_name FROM orders o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"


@query(f"""
WITH o AS ({_ORDERS}), f AS (SELECT *, o_orderstatus IN ('F', 'O') AS a, o_orderpriority IN ('1-URGENT', '2-HIGH') AS b, c_mktsegment = 'BUILDING' AS c FROM o)
SELECT 'status' AS facet, o_orderstatus AS value, count(*)::BIGINT AS n FROM f WHERE b AND c GROUP BY 2
UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM f WHERE a AND c GROUP BY 2
UNION ALL SELECT 'segment', c_mktsegment, count(*) FROM f WHERE a AND b GROUP BY 2
UNION ALL SELECT 'nation', n_name, count(*) FROM f WHERE a AND b AND c GROUP BY 2""")
def facet_all_bundle(spark, sf):
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows at any scale
    columns = {"status": "o_orderstatus", "priority": "o_orderpriority", "segment": "c_mktsegment", "nation": "n_name"}
    filters = {"status": F.col("o_orderstatus").isin("F", "O"), "priority": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "segment": F.col("c_mktsegment") == "BUILDING"}
    return browse.facet_bundle(rows, columns, filters)


@query("SELECT r_regionkey AS ord, r_name AS value, count(*)::BIGINT AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2 ORDER BY 1")
def facet_dimension_order(spark, sf):
    dims = F.broadcast(table(spark, sf, "region"))  # 5 rows at any scale
    nations = F.broadcast(table(spark, sf, "nation"))
    per_nation = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    rows = per_nation.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(dims, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy(F.col("r_regionkey").alias("ord"), F.col("r_name").alias("value")).agg(F.sum("n").alias("n")).orderBy("ord")


@query("SELECT l_suppkey AS source, coalesce(s_name, CAST(l_suppkey AS VARCHAR)) AS label, count(*)::BIGINT AS n FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON l_suppkey = s_suppkey GROUP BY 1, 2")
def facet_source_label(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))  # before the join
    labels = table(spark, sf, "supplier").filter("s_acctbal > 0").select("s_suppkey", "s_name")
    rows = counts.join(labels, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return rows.select(F.col("l_suppkey").alias("source"), F.coalesce("s_name", F.col("l_suppkey").cast("string")).alias("label"), "n")


@query("SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY 1")
def stats_by_type(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT p_partkey AS record_id, 'p_brand' AS key, p_brand AS text_value, CAST(NULL AS DOUBLE) AS num_value, 0 AS ord FROM part
UNION ALL SELECT p_partkey, 'p_type', p_type, NULL, 1 FROM part
UNION ALL SELECT p_partkey, 'p_size', NULL, p_size, 2 FROM part""")
def eav_flatten_scalars(spark, sf):
    return parts_eav(table(spark, sf, "part"))


@query("""
WITH e AS (SELECT l_orderkey AS record_id, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag, l_partkey, l_suppkey) - 1)::INT AS i, l_linenumber AS n, l_returnflag AS f FROM lineitem)
SELECT record_id, 'flags.flag' AS key, f AS text_value, CAST(NULL AS DOUBLE) AS num_value, 3 * i AS ord FROM e
UNION ALL SELECT record_id, 'flags.number', NULL, n::DOUBLE, 3 * i + 1 FROM e
UNION ALL SELECT record_id, 'flags', f || ' ' || n, NULL, 3 * i + 2 FROM e""")
def eav_flatten_combined(spark, sf):
    lines = table(spark, sf, "lineitem")
    each = F.struct("l_linenumber", "l_returnflag", "l_partkey", "l_suppkey")
    rows = lines.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(each)), lambda x: F.struct(x["l_linenumber"].alias("number"), x["l_returnflag"].alias("flag"))).alias("flags"))
    return flatten_fields(rows, "l_orderkey", ["flags"])


@query("SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_size END AS size FROM part ORDER BY size NULLS FIRST, p_partkey LIMIT 40")
def sort_by_eav_field_nulls(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 7 != 0, F.col("p_size")).alias("size"))
    return browse.page(browse.sort_by_field(parts, flatten_fields(parts, "p_partkey", ["size"]), "p_partkey", "size"), 1, 40)


@query("""
WITH t AS (SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS tok FROM part)
SELECT p_partkey FROM t GROUP BY 1 HAVING bool_or(starts_with(tok, 're')) AND bool_or(starts_with(tok, 'wi'))""")
def search_prefix_tokens(spark, sf):
    index = search.token_index(table(spark, sf, "part"), "p_partkey", F.col("p_name"))
    return search.prefix_hits(index, "p_partkey", search.query_words("re wi"))


_SEARCH = """
WITH r AS (SELECT DISTINCT p_name AS name, min(p_partkey) AS id, min(p_type) AS kind FROM part GROUP BY 1),
h AS (SELECT *, CASE WHEN EXISTS (SELECT 1 FROM (SELECT unnest(string_split(lower(name), ' ')) AS t) WHERE starts_with(t, 'in')) THEN 0 ELSE 1 END AS src FROM r WHERE contains(lower(name), 'in'))
SELECT * FROM h ORDER BY src, lower(name), id LIMIT 12"""


def _named_parts(spark, sf):
    return table(spark, sf, "part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("id"), F.min("p_type").alias("kind"))


@query(_SEARCH)
def search_substring_fallback(spark, sf):
    return search.search(_named_parts(spark, sf), "id", "name", "in", 12)


@query(f"SELECT kind, string_agg(name, '|' ORDER BY src, lower(name), id) AS names, count(*)::BIGINT AS n FROM ({_SEARCH}) GROUP BY 1")
def search_grouped(spark, sf):
    hits = search.search(_named_parts(spark, sf), "id", "name", "in", 12)
    return search.grouped(hits, "kind", "id", "name").withColumn("names", F.array_join("names", "|"))


@query(r"SELECT p_partkey FROM part WHERE p_name || '_100%' ILIKE '%G\_100\%' ESCAPE '\'")
def like_escaped(spark, sf):
    return table(spark, sf, "part").filter(F.expr(r"concat(p_name, '_100%') ILIKE '%G!_100!%' ESCAPE '!'")).select("p_partkey")


@query("""
SELECT r_name, n_name, c_mktsegment, count(*)::BIGINT AS n, min(c_custkey) AS first_id, grouping(n_name)::INT AS all_nations, grouping(c_mktsegment)::INT AS all_segments
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name, c_mktsegment)""")
def tree_rollup(spark, sf):
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf, "customer").join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows at any scale
    out = tree.rolled(rows, ["r_name", "n_name", "c_mktsegment"], "c_custkey")
    return out.select("r_name", "n_name", "c_mktsegment", "n", "first_id", F.col("all_n_name").alias("all_nations"), F.col("all_c_mktsegment").alias("all_segments"))


@query("""
SELECT p_type AS chapter, coalesce(CASE WHEN p_size > 5 THEN p_brand END, '(Unsectioned)') AS section, string_agg(p_name || '#' || p_partkey, '|' ORDER BY lower(p_name), p_partkey) AS items, min(p_size) AS first_page
FROM part GROUP BY 1, 2""")
def tree_sections(spark, sf):
    parts = table(spark, sf, "part").withColumn("section", F.when(F.col("p_size") > 5, F.col("p_brand")))
    return tree.sections(parts, "p_type", "section", "p_name", "p_partkey", "p_size").withColumn("items", F.array_join("items", "|"))


@query("SELECT l_suppkey, l_partkey, l_linenumber, p_name FROM (SELECT DISTINCT l_suppkey, l_partkey, l_linenumber FROM lineitem WHERE l_suppkey = 3) JOIN part ON l_partkey = p_partkey ORDER BY l_linenumber, p_name, l_partkey")
def spells_by_level(spark, sf):
    levels = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.collect_set(F.struct("l_suppkey", "l_linenumber")).alias("levels"))
    rows = table(spark, sf, "part").join(levels, F.col("p_partkey") == F.col("l_partkey"))
    return tree.by_level(rows, "levels", "l_suppkey", 3, "l_linenumber", "p_name").select("l_suppkey", "l_partkey", "l_linenumber", "p_name")


@query("""
SELECT o_custkey AS id, o_orderstatus AS key, string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS vals FROM orders GROUP BY 1, 2""")
def facet_values_per_item(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("key"), "o_orderkey")
    made = tree.values_by_key(rows, "id", "key", "o_orderkey", "o_orderkey")
    return made.select("id", F.explode("values").alias("key", "v")).select("id", "key", F.array_join(F.transform("v", lambda x: x.cast("string")), ",").alias("vals"))

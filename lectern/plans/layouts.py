"""Queries: page geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import cleanup, layout
from lectern.plans.registry import query, table

_LINES = "SELECT o_custkey AS page_id, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i, o_orderpriority AS a, o_orderstatus AS b FROM orders"


def line_words(spark, sf):
    """Each customer's orders as lines of two columns: even ones left, odd ones right, ten units apart."""
    from pyspark.sql.window import Window as W

    i = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("page_id"), i.alias("i"), F.split(F.concat_ws(" ", "o_orderkey", "o_orderpriority"), " ", -1).alias("w"))
    rows = rows.select("page_id", "i", F.posexplode("w").alias("pos", "text"))
    x0, y0 = (F.col("i") % 2) * 300.0 + F.col("pos") * 60.0, F.floor(F.col("i") / 2) * 12.0
    return rows.select("page_id", F.col("i").alias("block"), F.lit(0).alias("line"), "pos", x0.alias("x0"), y0.alias("y0"), (x0 + 50).alias("x1"), (y0 + 10).alias("y1"), "text")


@query(f"""
WITH l AS ({_LINES}), u AS (SELECT page_id, i % 2 AS col, string_agg(o_orderkey || ' ' || a, chr(10) ORDER BY i) AS text, count(*)::INT AS n_lines FROM l GROUP BY 1, 2)
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY col) - 1)::INT AS ord, 'prose' AS kind, text, n_lines FROM u""")
def layout_reading_order(spark, sf):
    pages = layout.pages_of_words(line_words(spark, sf))
    return layout.reading_order(pages).select("page_id", "ord", "kind", "text", "n_lines")


@query("""
WITH l AS (SELECT l_orderkey AS page_id, l_linenumber AS r, min(l_partkey) AS a, min(l_suppkey) AS b, min(l_returnflag) AS c FROM lineitem GROUP BY 1, 2)
SELECT page_id, 0 AS ord, 'table' AS kind, string_agg(a || chr(9) || b || chr(9) || c, chr(10) ORDER BY r) AS text, count(*)::INT AS n_lines FROM l GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT page_id, k, 'prose', CASE k WHEN 0 THEN max(a)::VARCHAR WHEN 1 THEN max(b)::VARCHAR ELSE max(c) END, 1 FROM l, (SELECT unnest([0, 1, 2]) AS k) GROUP BY 1, 2 HAVING count(*) = 1""")
def layout_table_groups(spark, sf):
    """Three blocks side by side make a table: its rows are the lines of equal height.  Blocks of one line stay columns."""
    rows = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("page_id"), F.col("l_linenumber").alias("line")).agg(F.min("l_partkey").alias("a"), F.min("l_suppkey").alias("b"), F.min("l_returnflag").alias("c"))
    cell = F.posexplode(F.array(F.col("a").cast("string"), F.col("b").cast("string"), "c")).alias("block", "text")
    each = rows.select("page_id", "line", cell)
    x0, y0 = F.col("block") * 100.0, F.col("line") * 12.0
    words = each.select("page_id", "block", "line", F.lit(0).alias("pos"), x0.alias("x0"), y0.alias("y0"), (x0 + 40).alias("x1"), (y0 + 10).alias("y1"), "text")
    return layout.reading_order(layout.pages_of_words(words)).select("page_id", "ord", "kind", "text", "n_lines")


@query("""
WITH w AS (SELECT l_orderkey AS page_id, l_linenumber AS k, l_quantity AS y, l_partkey AS p, l_suppkey AS s FROM lineitem)
SELECT l_orderkey AS page_id, l_linenumber AS k, l_partkey, l_suppkey, l_quantity >= 44 AND (l_quantity - l_discount * 100) >= 30 AND l_linenumber <= 9 AS is_number FROM lineitem""")
def page_number_lines(spark, sf):
    q = F.col("l_quantity")
    found = cleanup.display_number(F.col("l_linenumber").cast("string"), q, F.lit(50.0), q - F.col("l_discount") * 100, F.lit(30 / 1.8))
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("page_id"), F.col("l_linenumber").alias("k"), "l_partkey", "l_suppkey", found.alias("is_number"))


@query("""
WITH t AS (SELECT c_custkey AS page_id, c_custkey % 3 AS m, c_custkey AS c, c_nationkey AS n FROM customer)
SELECT page_id, 0 AS ord, CASE m WHEN 2 THEN 'prose' ELSE 'table' END AS kind, CASE m
 WHEN 0 THEN 'k' || c || chr(9) || 'one two three four five' || chr(10) || 'k' || n || chr(9) || 'one two three four five' || chr(10) || 'k0' || chr(9) || 'one two three four five'
 WHEN 1 THEN 'k' || c || chr(9) || 'one' || chr(9) || 'two' || chr(10) || 'k' || n || chr(9) || 'one' || chr(9) || 'two' || chr(10) || 'k0' || chr(9) || 'one' || chr(9) || 'two'
 ELSE 'k' || c || ' one' || chr(10) || 'k' || n || ' one' || chr(10) || 'k0 one' END AS text, 3 AS n_lines FROM t""")
def layout_single_blocks(spark, sf):
    """One block a page: a grid of labels and values, a table of short cells, or plain prose."""
    m = F.col("c_custkey") % 3
    gap = F.lit(40.0)
    cells = F.when(m == 0, F.array(*map(F.lit, "one two three four five".split()))).when(m == 1, F.array(F.lit("one"), F.lit("two"))).otherwise(F.array(F.lit("one")))
    keys = F.array(F.concat(F.lit("k"), "c_custkey"), F.concat(F.lit("k"), "c_nationkey"), F.lit("k0"))
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("page_id"), m.alias("m"), cells.alias("cells"), F.posexplode(keys).alias("line", "key"))
    words = rows.select("page_id", "m", "line", F.posexplode(F.concat(F.array("key"), "cells")).alias("pos", "text"))
    # the label is 50 wide; values follow after a wide gap, and are apart by a wide gap in tables
    x0 = F.when(F.col("pos") == 0, 0.0).otherwise(F.lit(50.0) + F.when(F.col("m") == 2, 3.0).otherwise(gap) + (F.col("pos") - 1) * F.when(F.col("m") == 1, 70.0).otherwise(33.0))
    y0 = F.col("line") * 12.0
    words = words.select("page_id", F.lit(0).alias("block"), F.when(F.col("m") == 1, F.col("line") * 10 + F.col("pos")).otherwise(F.col("line")).alias("line"), "pos", x0.alias("x0"), y0.alias("y0"), (x0 + F.when(F.col("pos") == 0, 50.0).otherwise(30.0)).alias("x1"), (y0 + 10).alias("y1"), "text")
    out = layout.reading_order(layout.pages_of_words(words))
    return out.select("page_id", "ord", "kind", "text", F.when(F.col("kind") == "table", F.size(F.split("text", "\n"))).otherwise(F.col("n_lines")).alias("n_lines"))

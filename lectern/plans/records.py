"""Queries: canonical records end to end, detail, lookups, scope."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import canon, resolve, segments, validate, workqueue
from lectern.operators.browse import same_element
from lectern.plans.registry import query, table
from lectern.sources import readers, stores


def part_records(spark, sf):
    """Parts as records: brands are books, sizes pages, names make slugs; two types, dated by price."""
    parts = table(spark, sf, "part")
    return parts.select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_type") == "ECONOMY", "feat").otherwise("spell").alias("type"),
        F.col("p_name").alias("name"),
        T.slugify(F.col("p_name")).alias("slug"),
        F.col("p_brand").alias("book_id"),
        F.when(F.col("p_partkey") % 9 != 0, F.format_string("%04d-%02d", (F.col("p_retailprice") % 30 + 1990).cast("int"), F.col("p_size") % 12 + 1)).alias("published"),
        F.when(F.col("p_type") == "PROMO", F.substring_index("p_name", " ", 1)).alias("topic"),
        F.col("p_size").alias("first_page"),
        F.col("p_size").alias("last_page"),
        F.lit(None).cast("bigint").alias("parent"),
    )


_RECORDS = """
r AS (SELECT p_partkey AS id, CASE WHEN p_type = 'ECONOMY' THEN 'feat' ELSE 'spell' END AS type, replace(p_name, ' ', '-') AS slug, p_brand AS book, CASE WHEN p_partkey % 9 <> 0 THEN printf('%04d-%02d', floor(p_retailprice % 30 + 1990)::INT, p_size % 12 + 1) END AS published, CASE WHEN p_type = 'PROMO' THEN split_part(p_name, ' ', 1) END AS topic FROM part),
a AS (SELECT *, min(CASE WHEN book = 'Brand#1' THEN id END) OVER (PARTITION BY topic) AS chief FROM r),
b AS (SELECT *, topic IS NOT NULL AND chief IS NOT NULL AND book <> 'Brand#1' AS beaten FROM a),
w AS (SELECT *, first_value(id) OVER (PARTITION BY type, slug ORDER BY published DESC NULLS LAST, book, id) AS win FROM b WHERE NOT beaten),
p AS (SELECT id, CASE WHEN win <> id THEN win END AS up FROM w UNION ALL SELECT id, chief FROM b WHERE beaten),
c AS (SELECT p.id, coalesce(q.up, p.up) AS variant_of FROM p LEFT JOIN p q ON p.up = q.id)"""


@query(f"WITH {_RECORDS} SELECT id, variant_of IS NULL AS canonical, variant_of FROM c")
def canonical_records(spark, sf):
    """Authority topics, latest wins and flattened chains over one set of records."""
    records = part_records(spark, sf).withColumns({"superseded_by": F.lit(None).cast("bigint"), "applied_overrides": F.array().cast("array<string>")})
    return canon.precedence(records, "Brand#1").select("id", "canonical", "variant_of")


@query("""
SELECT p_partkey AS id, CASE WHEN p_size % 4 = 0 THEN 'duplicate' WHEN p_size % 7 = 1 THEN 'override' WHEN p_size % 7 = 2 THEN 'index' WHEN p_size % 7 = 3 THEN 'excluded' WHEN p_size % 2 = 1 THEN 'in_scope' ELSE 'out_of_scope' END AS scope FROM part""")
def scope_status(spark, sf):
    n = F.col("p_size")
    kind = F.when(n % 7 == 1, "errata").when(n % 7 == 2, "index").when(n % 7 == 3, "excluded").otherwise("core")
    parts = table(spark, sf, "part")
    beaten = F.when(n == 1, F.array(F.lit("none"))).otherwise(F.array().cast("array<string>"))
    books = parts.select(F.col("p_partkey").cast("string").alias("book_id"), kind.alias("kind"), F.when(n % 2 == 1, "3.5").otherwise("3.0").alias("edition"), F.lit(None).cast("string").alias("applies_to"), beaten.alias("preferred_over"))
    # a collection that prefers itself over every book of a size divisible by four
    lists = parts.filter("p_size % 4 = 0").select(F.lit("0").alias("book_id"), F.lit("core").alias("kind"), F.lit("3.0").alias("edition"), F.lit(None).cast("string").alias("applies_to"), F.array(F.col("p_partkey").cast("string")).alias("preferred_over"))
    told = readers.scope(books.withColumn("own", F.lit(True)).union(lists.withColumn("own", F.lit(False))))
    return told.filter("own").select(F.col("book_id").cast("bigint").alias("id"), "scope")


@query("SELECT l_suppkey AS book, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS classes, count(DISTINCT l_returnflag)::BIGINT AS n FROM lineitem GROUP BY 1")
def distinct_lookup(spark, sf):
    each = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("book")).agg(F.collect_set("l_returnflag").alias("c"))  # three flags
    return each.select("book", F.array_join(F.array_sort("c"), ",").alias("classes"), F.size("c").cast("bigint").alias("n"))


@query("SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS after FROM orders")
def adjacent_ids(spark, sf):
    from pyspark.sql.window import Window as W

    w = W.partitionBy("o_custkey").orderBy("o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", F.lag("o_orderkey").over(w).alias("before"), F.lead("o_orderkey").over(w).alias("after"))


@query("SELECT doc_id, source, n FROM (SELECT doc_id, source, n_chars AS n, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r <= 3")
def head_per_book(spark, sf):
    from pyspark.sql.window import Window as W

    rank = F.row_number().over(W.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id"))
    return table(spark, sf, "documents").select("doc_id", "source", F.col("n_chars").alias("n"), rank.alias("r")).filter("r <= 3").drop("r")


@query("SELECT doc_id AS key, coalesce(quality, 9)::INT AS value FROM (SELECT doc_id, max(quality) AS quality FROM (SELECT doc_id, NULL AS quality FROM documents UNION ALL SELECT doc_id, quality FROM labels) GROUP BY 1)")
def page_map_merge(spark, sf):
    old = table(spark, sf, "documents").select(F.col("doc_id").alias("key"), F.lit(9).alias("value"))
    new = table(spark, sf, "labels").select(F.col("doc_id").alias("key"), F.col("quality").alias("value"))
    return stores.merge_map(old, new, "key", "value")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus IN ('P', 'O') THEN 'pending' ELSE 'done' END AS soft, 'pending' AS hard, 1 AS hard_tier FROM orders")
def queue_reset(spark, sf):
    from lectern.plans.queueing import queue

    rows = queue(spark, sf)
    soft = workqueue.reset(rows, hard=False).select(F.col("seg_id").alias("o_orderkey"), F.col("status").alias("soft"))
    hard = workqueue.reset(rows, hard=True).select(F.col("seg_id").alias("o_orderkey"), F.col("status").alias("hard"), F.col("tier").alias("hard_tier"))
    return soft.join(hard, "o_orderkey")


@query("""
WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS w FROM documents)
SELECT doc_id, count(*) FILTER (WHERE regexp_matches(w, '\\p{L}'))::BIGINT AS n_letter_words, count(*) FILTER (WHERE regexp_matches(w, '^[^\\p{L}]*\\p{Lu}'))::BIGINT AS n_capital FROM w GROUP BY 1""")
def capital_words(spark, sf):
    each = table(spark, sf, "documents").select("doc_id", F.explode(T.words(F.col("text"))).alias("w"))
    return each.groupBy("doc_id").agg(F.count_if(F.col("w").rlike(r"\p{L}")).alias("n_letter_words"), F.count_if(F.col("w").rlike(r"^[^\p{L}]*\p{Lu}")).alias("n_capital"))


@query("""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS level FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'attack cell is off' ELSE 'levels have a gap' END AS error FROM l WHERE o_orderkey % 5 = 0 OR (o_custkey % 3 = 0 AND level > 4)""")
def class_progression(spark, sf):
    """Level tables with planted errors: a wrong attack cell, or a gap after the fourth level."""
    from pyspark.sql.window import Window as W

    from lectern.functions.numbers import attack_cell

    level = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", level.alias("true_level"), F.lit("average").alias("kind"))
    shown = F.when(F.col("o_orderkey") % 5 == 0, "+99").otherwise(attack_cell(F.col("true_level"), F.col("kind")))
    gapped = F.when((F.col("o_custkey") % 3 == 0) & (F.col("true_level") > 4), F.col("true_level") + 1).otherwise(F.col("true_level"))
    bad = validate.progression(rows.withColumn("level", gapped).withColumn("attack", shown), ["o_custkey"], "level", "attack", "kind")
    return bad.select("o_orderkey", F.element_at("errors", -1).alias("error"))


@query("SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('A', 'N') AND l_linestatus = 'O' GROUP BY 1")
def element_filter_many_values(spark, sf):
    from lectern.plans.browsing import order_flags

    return order_flags(spark, sf).filter(same_element(F.col("flags"), {"l_returnflag": ["A", "N"], "l_linestatus": ["O"]})).select("l_orderkey")


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'page 7 is outside the segment' ELSE '' END AS outside, CASE WHEN page_id % 4 = 0 THEN 'name is not its target' ELSE '' END AS named FROM pages""")
def segment_page_checks(spark, sf):
    n = F.col("page_id")
    pages = F.when(n % 3 == 0, F.array(F.lit(1), F.lit(7))).otherwise(F.array(F.lit(1), F.lit(2)))
    name = F.when(n % 4 == 0, "Other").when(n % 4 == 1, "Light (p. 12)").otherwise("Light")
    return table(spark, sf, "pages").select("page_id", F.array_join(validate.pages_within(pages, F.array(F.lit(1), F.lit(2))), "; ").alias("outside"), F.array_join(validate.override_name(name, F.lit("Light"), F.lit(12)), "; ").alias("named"))


@query("SELECT doc_id, 'Chapter' AS title FROM documents WHERE n_chars % 12 BETWEEN 1 AND 12 AND n_chars % 5 = 0")
def contents_pages(spark, sf):
    body = F.when(F.col("n_chars") % 5 == 0, "One .... 1\nTwo .... 2\nThree .... 3").otherwise("One .... 1\nTwo .... 2")
    rows = table(spark, sf, "documents").select("doc_id", body.alias("t"), (F.col("n_chars") % 12).alias("page"))
    return rows.filter(segments.is_contents_page(F.col("t"), F.col("page"))).select("doc_id", F.lit("Chapter").alias("title"))


@query("SELECT p_name AS name, count(*)::BIGINT AS n, max(p_partkey) AS latest FROM part GROUP BY 1")
def record_variants(spark, sf):
    """Each name's canonical record (the latest id) and how many records share it."""
    out = resolve.latest_wins(table(spark, sf, "part").select("p_name", "p_partkey"), ["p_name"], [F.desc("p_partkey"), F.col("p_partkey")])
    return out.groupBy(F.col("p_name").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("canonical"), F.col("p_partkey"))).alias("latest"))

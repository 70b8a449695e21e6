"""Queries: interval, as-of, list, anti and fallback joins; canonical records; set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import cleanup, intervals, resolve, segments
from lectern.plans.registry import query, table


@query("""
WITH r AS (SELECT doc_id, source, n_chars, md5(text) AS k FROM documents),
w AS (SELECT doc_id, row_number() OVER (PARTITION BY k ORDER BY n_chars DESC, source, doc_id) AS n, first_value(doc_id) OVER (PARTITION BY k ORDER BY n_chars DESC, source, doc_id) AS f FROM r)
SELECT doc_id, n = 1 AS canonical, CASE WHEN n > 1 THEN f END AS variant_of FROM w""")
def latest_wins(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "n_chars", F.md5(F.col("text").cast("binary")).alias("k"))
    out = resolve.latest_wins(docs, ["k"], [F.desc_nulls_last("n_chars"), F.asc("source"), F.col("doc_id")])
    return out.select("doc_id", "canonical", "variant_of")


_TOPIC = "split_part(text, chr(10), 1)"


@query(f"""
WITH t AS (SELECT doc_id, source, {_TOPIC} AS topic FROM documents),
c AS (SELECT topic, min(doc_id) AS chief FROM t WHERE source = 'src0' GROUP BY 1)
SELECT doc_id, NOT (chief IS NOT NULL AND source <> 'src0') AS canonical, CASE WHEN chief IS NOT NULL AND source <> 'src0' THEN chief END AS variant_of FROM t LEFT JOIN c USING (topic)""")
def authority_topic_override(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", F.substring_index("text", "\n", 1).alias("topic"))
    return resolve.authority_wins(docs, "topic", "source", "src0", "doc_id").select("doc_id", "canonical", "variant_of")


def text_chain(spark, sf):
    """Each document points to the next (smaller) document with the same text."""
    docs = table(spark, sf, "documents").select("doc_id", F.xxhash64("text").alias("k"))
    from pyspark.sql.window import Window as W

    return docs.select("doc_id", F.lag("doc_id").over(W.partitionBy("k").orderBy("doc_id")).alias("variant_of"))


@query("SELECT doc_id AS id, min(doc_id) OVER (PARTITION BY text) AS root FROM documents")
def variant_flatten_roots(spark, sf):
    return resolve.flatten_pointers(text_chain(spark, sf), "doc_id", "variant_of")


@query("SELECT a.doc_id AS seed, b.doc_id AS id FROM documents a JOIN documents b ON a.text = b.text AND a.doc_id <> b.doc_id WHERE a.source IN ('src0', 'src1')")
def variant_closure(spark, sf):
    chain = text_chain(spark, sf).filter("variant_of IS NOT NULL").select(F.col("doc_id").alias("src"), F.col("variant_of").alias("dst"))
    seeds = table(spark, sf, "documents").filter("source IN ('src0', 'src1')").select(F.col("doc_id").alias("id"))
    return resolve.closure(chain, seeds)


@query("""
WITH e AS (SELECT item_id, split_part(text, '.', 1) AS name, length(text) AS page FROM benchmark),
t AS (SELECT doc_id, split_part(text, '.', 1) AS name, n_chars AS page FROM documents),
s1 AS (SELECT item_id, 1 AS stage, doc_id AS target FROM e JOIN t USING (name)),
s2 AS (SELECT item_id, 2 AS stage, doc_id FROM e JOIN t USING (page)),
s3 AS (SELECT item_id, 3 AS stage, doc_id FROM e JOIN t ON split_part(e.name, ' ', 1) = split_part(t.name, ' ', 1)),
u AS (SELECT DISTINCT * FROM s1 UNION SELECT * FROM s2 UNION SELECT * FROM s3),
f AS (SELECT item_id, stage, count(*) AS hits, row_number() OVER (PARTITION BY item_id ORDER BY stage) AS r FROM u GROUP BY 1, 2),
w AS (SELECT u.* FROM u JOIN f USING (item_id, stage) WHERE r = 1 AND (stage = 1 OR hits = 1))
SELECT item_id, stage, target FROM e LEFT JOIN w USING (item_id)""")
def override_fallback_match(spark, sf):
    name = F.substring_index("text", ".", 1)
    entries = table(spark, sf, "benchmark").select("item_id", name.alias("name"), F.length("text").cast("long").alias("page"))
    targets = table(spark, sf, "documents").select(F.col("doc_id").alias("target"), name.alias("name"), F.col("n_chars").alias("page"))
    word = lambda d: d.withColumn("word", F.substring_index("name", " ", 1)).drop("name", "page")
    stages = [entries.join(targets, "name"), entries.drop("name").join(targets.drop("name"), "page"), word(entries).join(word(targets), "word")]
    return resolve.first_stage_match(entries, "item_id", [s.select("item_id", "target") for s in stages])


@query("""
WITH p AS (SELECT o_custkey, o_orderkey, unnest([o_orderpriority, o_orderstatus]) AS v, unnest([1, 2]) AS i FROM orders),
f AS (SELECT o_custkey, v, min(o_orderkey * 10 + i) AS o FROM p GROUP BY 1, 2)
SELECT o_custkey, string_agg(v, ',' ORDER BY o) AS merged FROM f GROUP BY 1""")
def override_merge_ordered(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.array("o_orderpriority", "o_orderstatus").alias("vals"))
    return resolve.merge_lists(rows, "o_custkey", "o_orderkey", "vals").withColumn("merged", F.array_join("merged", ","))


@query("""
WITH l AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem)
SELECT l_orderkey, string_agg(coalesce(p_name, 'pending:' || l_partkey), ',' ORDER BY i) AS resolved FROM l LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON l_partkey = p_partkey GROUP BY 1""")
def ordered_list_resolve_pending(spark, sf):
    lines = table(spark, sf, "lineitem")
    lists = lines.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), lambda x: x["l_partkey"]).alias("ids"))
    things = table(spark, sf, "part").filter("p_size > 10")
    out = resolve.ordered_list(lists, "l_orderkey", "ids", things, "p_partkey", F.col("p_name"), F.concat(F.lit("pending:"), F.col("_ref").cast("string")))
    return out.withColumn("resolved", F.array_join("resolved", ","))


@query("SELECT l_orderkey, l_linenumber, l_partkey + l_linenumber * 300 AS parent FROM lineitem WHERE l_partkey + l_linenumber * 300 NOT IN (SELECT p_partkey FROM part)")
def dangling_parents(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") + F.col("l_linenumber") * 300).alias("parent"))
    return resolve.dangling(lines, "parent", table(spark, sf, "part"), "p_partkey").select("l_orderkey", "l_linenumber", "parent")


def calendar(spark):
    """Year, half-year and month spans as day numbers; some end where they start."""
    months = spark.range(0, 96).select((F.lit(1995) + F.floor(F.col("id") / 12)).cast("int").alias("y"), (F.col("id") % 12 + 1).cast("int").alias("m"))
    first = F.make_date("y", "m", F.lit(1))
    day = lambda d: F.datediff(d, F.lit("1970-01-01").cast("date"))
    spans = []
    for level, size in ((1, 12), (2, 6), (3, 1)):
        low, high = day(first), day(F.add_months(first, size)) - 1
        rows = months.filter((F.col("m") - 1) % size == 0).filter((F.lit(level) < 3) | (F.col("m") % 3 != 0))
        spans.append(rows.select(F.format_string("L%d-%d-%02d", F.lit(level), "y", "m").alias("title"), F.lit(level).alias("level"), low.alias("low"), F.when((F.lit(level) < 3) | (F.col("m") != 2), high).alias("high")))
    return spans[0].union(spans[1]).union(spans[2])


@query("""
WITH m AS (SELECT 1995 + i // 12 AS y, i % 12 + 1 AS m FROM range(96) t(i)),
d AS (SELECT y, m, make_date(y, m, 1) AS f, level, size FROM m, (VALUES (1, 12), (2, 6), (3, 1)) v(level, size) WHERE (m - 1) % size = 0 AND (level < 3 OR m % 3 <> 0)),
s AS (SELECT printf('L%d-%d-%02d', level, y, m) AS title, level, f AS low, CASE WHEN level < 3 OR m <> 2 THEN (f + to_months(size))::DATE - 1 ELSE f END AS high FROM d),
h AS (SELECT o_orderkey, title, level, row_number() OVER (PARTITION BY o_orderkey ORDER BY level DESC, low DESC, title) AS n FROM orders JOIN s ON o_orderdate::DATE BETWEEN low AND high)
SELECT o.o_orderkey, title, level FROM orders o LEFT JOIN (SELECT * FROM h WHERE n = 1) h USING (o_orderkey)""")
def interval_containment_deepest(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
    out = intervals.deepest_containing(orders, day, calendar(spark), "low", "high", [-F.col("level"), -F.col("low"), F.col("title")], 64, ["title", "level"])
    return out.select("o_orderkey", "title", "level")


@query("""
WITH s AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'signup'),
j AS (SELECT e.event_id, e.user_id, s.event_id AS last_signup, row_number() OVER (PARTITION BY e.event_id ORDER BY s.ts DESC, s.event_id DESC) AS n FROM events e LEFT JOIN s ON e.user_id = s.user_id AND s.ts <= e.ts)
SELECT event_id, user_id, last_signup FROM j WHERE n = 1""")
def asof_last_chapter(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    chapters = table(spark, sf, "events").filter("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("signup"))
    return intervals.as_of(events, chapters, ["user_id"], "ts", ["signup"], "signup", "last_signup").select("event_id", "user_id", "last_signup")


_TOC = "SELECT p_brand AS book, p_partkey AS start, CASE WHEN p_size % 5 = 0 THEN 1 ELSE 2 END AS level FROM part"


@query(f"""
WITH t AS ({_TOC}), e AS (SELECT book, start, level, (SELECT min(n.start) FROM t n WHERE n.book = t.book AND n.start > t.start AND n.level <= t.level) AS nxt FROM t)
SELECT book, start, level, greatest(coalesce(nxt - 1, 30000), start)::BIGINT AS span_end FROM e""")
def next_lower_level_end(spark, sf):
    toc = table(spark, sf, "part").select(F.col("p_brand").alias("book"), F.col("p_partkey").alias("start"), F.when(F.col("p_size") % 5 == 0, 1).otherwise(2).alias("level"))
    return intervals.level_ends(toc, ["book"], ["start", "level"], "start", "level", F.lit(30000).cast("long"))


@query("""
WITH s AS (SELECT o_custkey, min(o_orderkey) AS span_id, min(o_orderdate) AS lo, max(o_orderdate) AS hi, o_orderpriority AS p FROM orders WHERE o_totalprice > 300000 GROUP BY o_custkey, o_orderpriority),
h AS (SELECT o.o_orderkey, min(s.span_id) AS superseded_by FROM orders o JOIN s USING (o_custkey) WHERE o.o_orderdate >= s.lo AND o.o_orderdate <= s.hi AND o.o_totalprice < 100000 AND s.p <> o.o_orderpriority GROUP BY 1)
SELECT o_orderkey, superseded_by FROM orders LEFT JOIN h USING (o_orderkey)""")
def span_supersede(spark, sf):
    orders = table(spark, sf, "orders")
    spans = orders.filter("o_totalprice > 300000").groupBy("o_custkey", F.col("o_orderpriority").alias("p")).agg(F.min("o_orderkey").alias("span_id"), F.min("o_orderdate").alias("span_low"), F.max("o_orderdate").alias("span_high"))
    day = lambda c: F.unix_date(F.col(c).cast("date"))
    owns = (F.col("f.o_totalprice") < 100000) & (F.col("s.p") != F.col("f.o_orderpriority"))
    return intervals.superseded_by(orders, spans, "o_custkey", day("o_orderdate"), day("o_orderdate"), day("span_low"), day("span_high"), "o_orderkey", "span_id", owns, 256).select("o_orderkey", "superseded_by")


_PAGES = "SELECT l_suppkey AS book, l_linenumber AS printed, l_linenumber + l_partkey % 3 AS actual, l_orderkey * 10 + l_linenumber AS ord FROM lineitem"


@query(f"""
WITH p AS ({_PAGES}), m AS (SELECT book, actual - printed AS shift, count(*) AS n, min(ord) AS o FROM p GROUP BY 1, 2),
b AS (SELECT book, shift FROM (SELECT *, row_number() OVER (PARTITION BY book ORDER BY n DESC, o) AS r FROM m) WHERE r = 1),
w AS (SELECT book, printed, actual, row_number() OVER (PARTITION BY book, printed ORDER BY (actual - printed = shift) DESC, ord DESC, actual DESC) AS r FROM p JOIN b USING (book))
SELECT book, printed, actual::BIGINT AS page FROM w WHERE r = 1""")
def modal_offset_inverse(spark, sf):
    lines = table(spark, sf, "lineitem")
    pairs = lines.select(F.col("l_suppkey").alias("book"), F.col("l_linenumber").alias("printed"), (F.col("l_linenumber") + F.col("l_partkey") % 3).alias("actual"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    return cleanup.invert_pages(pairs, ["book"], "printed", "actual", "ord")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def coverage_gap(spark, sf):
    return segments.coverage_gap(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"])


@query("""
SELECT 'only_documents' AS side, doc_id FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
UNION ALL SELECT 'only_labels', doc_id FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)""")
def two_way_diff(spark, sf):
    # files on disk and manifest entries: one grouping finds both differences
    a = table(spark, sf, "documents").select("doc_id", F.lit(1).alias("s"))
    b = table(spark, sf, "labels").select("doc_id", F.lit(2).alias("s"))
    sides = a.union(b).groupBy("doc_id").agg(F.min("s").alias("lo"), F.max("s").alias("hi")).filter("lo = hi")
    return sides.select(F.when(F.col("lo") == 1, "only_documents").otherwise("only_labels").alias("side"), "doc_id")


@query("SELECT DISTINCT a.p_partkey AS a_id, b.b_id FROM part a JOIN (SELECT min(p_partkey) AS b_id, p_name AS n FROM part GROUP BY p_name) b ON a.p_name = b.n OR a.p_name || 's' = b.n OR a.p_name = b.n || 's'")
def fuzzy_title_join(spark, sf):
    from lectern.functions.text import singular, title_variants

    parts = table(spark, sf, "part")
    plural = F.when(F.col("p_partkey") % 2 == 0, F.concat("p_name", F.lit("s"))).otherwise(F.concat("p_name", F.lit(" (small)")))
    keys = lambda c: F.explode(F.array_distinct(F.transform(title_variants(c), singular)))
    left = parts.select(F.col("p_partkey").alias("a_id"), keys(plural).alias("k"))
    right = parts.groupBy("p_name").agg(F.min("p_partkey").alias("b_id")).select("b_id", keys(F.col("p_name")).alias("k"))
    return left.join(right, "k").select("a_id", "b_id").distinct()

"""Queries: tables of contents, record places, presence and score checks, ladders, audits, run counters, lists and trees.

Expected rows are worked out in SQL from the same columns, not written down.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import canon, contents, evals, search, tree, validate, workqueue
from lectern.plans.registry import query, table
from lectern.sources import readers

_ENTRIES = """SELECT p_brand AS book, p_partkey AS ord, CASE WHEN p_size = 7 THEN 'Table 1-' || p_size ELSE p_name || ' ' || p_partkey END AS title, p_partkey % 400 + 1 AS printed,
 CASE WHEN p_size % 5 = 0 THEN 1 ELSE 2 END AS level, CASE WHEN p_size % 5 = 0 THEN p_type WHEN p_size = 3 THEN p_brand END AS own FROM part"""
_MAP = "SELECT p_brand AS book, p_partkey % 400 + 1 AS printed, p_partkey % 400 + 6 + CASE WHEN p_partkey % 11 = 0 THEN 1 ELSE 0 END AS actual, p_partkey AS ord FROM part WHERE p_partkey % 3 <> 0"
_CONTENTS = f"""
e0 AS ({_ENTRIES}), n AS (SELECT book, count(*) FILTER (WHERE NOT title LIKE 'Table 1-%') AS found FROM e0 GROUP BY 1),
e AS (SELECT e0.* FROM e0 JOIN n USING (book) WHERE NOT title LIKE 'Table 1-%' AND found >= 5),
m AS ({_MAP}), o AS (SELECT book, actual - printed AS shift, count(*) AS n, min(ord) AS first FROM m GROUP BY 1, 2),
modal AS (SELECT book, arg_min(shift, (-n, first)) AS shift FROM o GROUP BY 1),
inv AS (SELECT book, printed, arg_max(actual, (CASE WHEN actual - printed = shift THEN 1 ELSE 0 END, ord)) AS page FROM m JOIN modal USING (book) GROUP BY 1, 2),
c AS (SELECT e.*, (SELECT arg_max((x.title, x.own), (x.printed, x.ord)) FROM e x WHERE x.book = e.book AND x.level = 1 AND x.printed <= e.printed) AS up FROM e),
s AS (SELECT c.*, coalesce(page, printed + shift) AS start FROM c LEFT JOIN modal USING (book) LEFT JOIN inv USING (book, printed)),
w AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY coalesce(start, printed), level, ord) AS nr FROM s),
toc AS (SELECT w.book, ord, title, level, start, CASE WHEN level = 1 THEN title ELSE up[1] END AS chapter, coalesce(own, CASE WHEN level = 2 THEN up[2] END, 'uncategorized') AS category, nr,
 greatest(coalesce(CASE WHEN level = 1 THEN min(CASE WHEN level = 1 THEN start END) OVER ahead ELSE min(start) OVER ahead END - 1, l.last, start), start) AS span_end
 FROM w LEFT JOIN (SELECT book, max(actual) + 5 AS last FROM m GROUP BY 1) l USING (book) WINDOW ahead AS (PARTITION BY w.book ORDER BY nr ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))"""
_CONTENTS = _CONTENTS.replace("up[1]", "up['a']").replace("up[2]", "up['b']").replace("arg_max((x.title, x.own)", "arg_max({'a': x.title, 'b': x.own}")


def toc(spark, sf):
    part, k = table(spark, sf, "part"), F.col("p_partkey")
    chapter = F.col("p_size") % 5 == 0
    entries = part.select(F.col("p_brand").alias("book"), k.alias("ord"), F.when(F.col("p_size") == 7, F.concat(F.lit("Table 1-"), "p_size")).otherwise(F.concat_ws(" ", "p_name", "p_partkey")).alias("title"), (k % 400 + 1).alias("printed"), F.when(chapter, 1).otherwise(2).alias("level"), F.when(chapter, F.col("p_type")).when(F.col("p_size") == 3, F.col("p_brand")).alias("own"))
    pages = part.filter(k % 3 != 0).select(F.col("p_brand").alias("book"), (k % 400 + 1).alias("printed"), (k % 400 + 6 + F.when(k % 11 == 0, 1).otherwise(0)).alias("actual"), k.alias("ord"))
    kept, _ = contents.usable(entries)
    return contents.contents(kept, pages, pages.groupBy("book").agg((F.max("actual") + 5).alias("last")), F.col("own"))


@query(f"WITH {_CONTENTS} SELECT book, ord, level, chapter, category, start::BIGINT AS start, span_end::BIGINT AS span_end, nr::INT AS nr FROM toc")
def book_contents(spark, sf):
    """Parts as printed entries of their brand's book; a third of the printed pages is not in the page map."""
    return toc(spark, sf).select("book", "ord", "level", "chapter", "category", "start", "span_end", "nr")


@query(f"SELECT book, count(*) FILTER (WHERE NOT t)::BIGINT AS found, count(*) FILTER (WHERE t)::BIGINT AS dropped FROM (SELECT o_custkey AS book, o_orderkey % 3 = 0 AS t FROM orders) GROUP BY 1 HAVING count(*) FILTER (WHERE NOT t) < 5")
def contents_failures(spark, sf):
    title = F.when(F.col("o_orderkey") % 3 == 0, "Index of Table 3–1").otherwise("Chapter")
    return contents.usable(table(spark, sf, "orders").select(F.col("o_custkey").alias("book"), title.alias("title")))[1]


@query(f"""WITH {_CONTENTS}, r AS (SELECT c_custkey AS id, 'Brand#' || (c_nationkey % 6 + 1) || (c_custkey % 5 + 1) AS book, c_custkey % 420 AS page, c_custkey % 9 = 0 AS bare FROM customer),
h AS (SELECT id, arg_min({{'t': title, 'l': level, 'c': chapter, 'k': category}}, (-level, -start, title)) AS b FROM r JOIN toc USING (book) WHERE NOT bare AND page BETWEEN start AND span_end GROUP BY 1)
SELECT r.id, CASE WHEN b IS NOT NULL THEN b['k'] WHEN NOT bare AND book IN (SELECT book FROM toc) THEN 'uncategorized' END AS toc_category, b['c'] AS toc_chapter, CASE WHEN b['l'] = 2 THEN b['t'] END AS toc_section FROM r LEFT JOIN h USING (id)""")
def record_places(spark, sf):
    k = F.col("c_custkey")
    book = F.concat(F.lit("Brand#"), F.col("c_nationkey") % 6 + 1, k % 5 + 1)
    pages = F.when(k % 9 == 0, F.array().cast("array<bigint>")).otherwise(F.array(k % 420 + 1, k % 420))
    records = table(spark, sf, "customer").select(k.alias("id"), book.alias("book"), pages.alias("pages"))
    out = contents.record_places(records, toc(spark, sf))
    # a section before any chapter has itself as its path
    return out.select("id", "toc_category", F.when((F.size("toc_path") == 1) & F.col("toc_section").isNotNull(), F.lit(None)).otherwise(F.col("toc_chapter")).alias("toc_chapter"), "toc_section")


@query("""SELECT o_orderkey, concat_ws('; ', CASE WHEN o_orderkey % 3 = 0 THEN 'levels must be a non-empty list' END, CASE WHEN trim(school) = '' THEN 'school must be a non-empty string' END) AS spell,
 CASE WHEN o_orderstatus = 'O' THEN 'benefit must be a non-empty string' ELSE '' END AS feat, CASE WHEN o_orderstatus = 'F' THEN 'fields is missing or not an object' ELSE '' END AS rules
FROM (SELECT *, CASE WHEN o_orderpriority LIKE '1%' THEN '  ' ELSE o_orderpriority END AS school FROM orders)""")
def presence_checks(spark, sf):
    k, n = F.col("o_orderkey"), F.col("o_orderkey") % 3
    levels = F.when(n == 0, F.array().cast("array<string>")).otherwise(F.array(F.col("o_orderpriority")))
    school = F.when(F.col("o_orderpriority").startswith("1"), "  ").otherwise(F.col("o_orderpriority"))
    spell = F.parse_json(F.to_json(F.struct(levels.alias("levels"), school.alias("school"))))
    feat = F.parse_json(F.when(F.col("o_orderstatus") == "O", F.concat(F.lit('{"benefit": '), k.cast("string"), F.lit("}"))).otherwise('{"benefit": "more"}'))
    rules = F.parse_json(F.when(F.col("o_orderstatus") == "F", "[1]").otherwise('{"topic": "t"}'))
    said = lambda kind, v: F.array_join(validate.present(kind, v), "; ")
    return table(spark, sf, "orders").select("o_orderkey", said("spell", spell).alias("spell"), said("feat", feat).alias("feat"), said("rules_section", rules).alias("rules"))


@query("""SELECT c_custkey, concat_ws('; ', CASE WHEN c_nationkey % 2 = 0 THEN 'saves.ref is missing or not an integer' END, CASE WHEN c_mktsegment = 'BUILDING' THEN 'abilities.dex is missing' END,
 CASE WHEN c_nationkey % 3 = 0 THEN 'abilities.wis is neither an integer nor null' END) AS errors,
 concat_ws('; ', CASE WHEN c_nationkey + 1 <> 5 THEN 'hit points differ from those printed' END, CASE WHEN c_custkey % 2 = 1 THEN 'die differs from the first one printed' END) AS printed,
 concat_ws('; ', CASE WHEN (c_nationkey > 4) <> (c_nationkey > 9) THEN 'group and variant label must be set together' END, CASE WHEN c_nationkey > 9 AND c_custkey % 3 = 0 THEN 'name is not group and variant label' END) AS naming FROM customer""")
def monster_scores(spark, sf):
    nation, k = F.col("c_nationkey"), F.col("c_custkey")
    ref = F.when(nation % 2 == 0, '"4"').otherwise("4")
    wis = F.when(nation % 3 == 0, "1.5").otherwise("null")
    dex = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise('"dex": 12,')
    fields = F.parse_json(F.concat(F.lit('{"saves": {"fort": 1, "ref": '), ref, F.lit(', "will": -1}, "abilities": {"str": 10, '), dex, F.lit('"con": null, "int": 3, "wis": '), wis, F.lit(', "cha": 1}}')))
    printed = validate.printed_hit_points(nation + 1, F.when(k % 2 == 1, 6).otherwise(8), F.lit("1d8+1 (5 hp)"))
    name = F.when(k % 3 == 0, "Other").otherwise("Angel, Planetar")
    naming = validate.group_name(name, F.when(nation > 4, "Angel"), F.when(nation > 9, "Planetar"))
    said = lambda e: F.array_join(e, "; ")
    return table(spark, sf, "customer").select("c_custkey", said(validate.scores(fields)).alias("errors"), said(printed).alias("printed"), said(naming).alias("naming"))


@query("""
WITH a AS (SELECT l_orderkey AS seg, l_suppkey % 3 + 1 AS tier, CASE l_returnflag WHEN 'N' THEN 'needs_context' WHEN 'R' THEN 'validation' ELSE 'malformed' END AS kind FROM lineitem),
t AS (SELECT seg, tier, count(*) FILTER (WHERE kind = 'needs_context') AS asks, count(*) FILTER (WHERE kind <> 'needs_context') AS fails FROM a GROUP BY 1, 2),
s AS (SELECT o_orderkey AS seg, o_custkey AS book, o_orderkey % 3 + 1 AS tier, o_orderstatus = 'F' AND o_orderpriority < '3' AS ok FROM orders)
SELECT book, r.tier::INT AS tier, count(*) FILTER (WHERE ok AND s.tier = r.tier)::BIGINT AS passed, count(*) FILTER (WHERE fails > 0 OR asks >= 2)::BIGINT AS escalated, coalesce(sum(asks), 0)::BIGINT AS retries
FROM s CROSS JOIN (VALUES (1), (2), (3)) r(tier) LEFT JOIN t ON t.seg = s.seg AND t.tier = r.tier GROUP BY 1, 2""")
def ladder_lines(spark, sf):
    kind = F.when(F.col("l_returnflag") == "N", "needs_context").when(F.col("l_returnflag") == "R", "validation").otherwise("malformed")
    attempts = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("seg_id")).agg(F.collect_list(F.struct((F.col("l_suppkey") % 3 + 1).cast("int").alias("tier"), kind.alias("kind"))).alias("attempts"))
    segments = table(spark, sf, "orders").select(F.col("o_orderkey").alias("seg_id"), F.col("o_custkey").alias("book"), (F.col("o_orderkey") % 3 + 1).cast("int").alias("tier"), F.when(F.col("o_orderstatus") == "F", "done").otherwise("pending").alias("status"), F.when(F.col("o_orderpriority") < "3", "validated").alias("outcome"))
    return workqueue.ladder_lines(segments.join(attempts, "seg_id", "left"))


@query("""
WITH q AS (SELECT o_orderkey AS seg_id, o_custkey AS book, o_orderkey % 3 + 1 AS tier, CASE o_orderstatus WHEN 'F' THEN 'pending' ELSE 'done' END AS status FROM orders),
l AS (SELECT book, min(tier) AS tier FROM q WHERE status = 'pending' GROUP BY 1),
c AS (SELECT seg_id FROM (SELECT seg_id, row_number() OVER (PARTITION BY book ORDER BY seg_id) AS n FROM q JOIN l USING (book, tier) WHERE status = 'pending') WHERE n <= 2)
SELECT seg_id, CASE WHEN c.seg_id IS NOT NULL THEN 'in_progress' ELSE status END AS status, CASE WHEN c.seg_id IS NOT NULL THEN '2001-02-03' END AS claimed FROM q LEFT JOIN c USING (seg_id)""")
def select_and_mark(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("seg_id"), F.col("o_custkey").alias("book"), (F.col("o_orderkey") % 3 + 1).alias("tier"), F.when(F.col("o_orderstatus") == "F", "pending").otherwise("done").alias("status"))
    out = workqueue.select_and_mark(rows, "seg_id", 2, F.lit("2001-02-03 04:05:06").cast("timestamp"))
    return out.select("seg_id", "status", F.date_format("claimed_at", "yyyy-MM-dd").alias("claimed"))


_SEGMENTS = """SELECT o_orderkey AS seg_id, o_custkey AS book, CASE WHEN o_orderstatus = 'F' THEN 'Knights' ELSE 'Ex-Scouts' END AS heading, o_orderpriority < '4' AS claims,
 first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS first, o_orderkey % 4 = 0 AS astray FROM orders"""


def segments(spark, sf):
    from pyspark.sql.window import Window as W

    rows, k = table(spark, sf, "orders"), F.col("o_orderkey")
    first = F.first(k).over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    by = F.when(k == first, None).when(k % 4 == 0, -k).otherwise(first)
    heading = F.when(k == first, "Knight").when(F.col("o_orderstatus") == "F", "Knights").otherwise("Ex-Scouts")
    name = lambda t: F.array(F.concat(F.lit(t), k.cast("string")))
    none = F.array().cast("array<string>")
    return rows.select(k.alias("seg_id"), F.col("o_custkey").alias("book"), heading.alias("heading"), F.lit("rules_section").alias("kind"), F.when(F.col("o_orderpriority") < "4", name("r")).otherwise(none).alias("records"), name("x").alias("released"), by.alias("superseded_by"))


@query(f"""WITH s AS ({_SEGMENTS}) SELECT seg_id, CASE WHEN astray OR heading <> 'Knights' THEN 'wrongly_superseded' ELSE 'superseded_claim' END AS trouble, CASE WHEN astray OR heading <> 'Knights' THEN 'x' ELSE 'r' END || seg_id AS paths
FROM s WHERE seg_id <> first AND (astray OR heading <> 'Knights' OR claims)""")
def audit_superseded(spark, sf):
    out = workqueue.audit_superseded(segments(spark, sf))
    return out.select("seg_id", "trouble", F.array_join("paths", ",").alias("paths"))


@query(f"""WITH s AS (SELECT *, seg_id <> first AND (astray OR heading <> 'Knights') AS wrong, seg_id <> first AND NOT astray AND heading = 'Knights' AND claims AS claim FROM ({_SEGMENTS}))
SELECT seg_id, CASE WHEN seg_id <> first AND NOT wrong THEN first END AS superseded_by, CASE WHEN claim THEN '' WHEN wrong AND claims THEN 'r' || seg_id || ',x' || seg_id WHEN wrong THEN 'x' || seg_id WHEN claims THEN 'r' || seg_id ELSE '' END AS records,
 CASE WHEN wrong THEN '' WHEN claim THEN 'x' || seg_id || ',r' || seg_id ELSE 'x' || seg_id END AS released FROM s""")
def restore_superseded(spark, sf):
    rows = segments(spark, sf)
    out = workqueue.restore(rows, workqueue.audit_superseded(rows))
    return out.select("seg_id", "superseded_by", F.array_join("records", ",").alias("records"), F.array_join("released", ",").alias("released"))


@query("""
WITH c AS (SELECT c_custkey AS id, c_name AS name, CASE WHEN c_nationkey < 20 THEN c_mktsegment END AS text FROM customer WHERE c_custkey % 10 <> 1),
g AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 13 = 0 THEN 'x' ELSE c_name END AS name, CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE c_mktsegment END AS text FROM customer WHERE c_custkey % 5 <> 2 UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 15 = 0),
n AS (SELECT id, count(*) AS k FROM g GROUP BY 1), one AS (SELECT g.* FROM g JOIN n USING (id) WHERE k = 1),
j AS (SELECT c.*, one.id IS NOT NULL AS found, one.name AS n2, one.text AS t2, (c.id % 3 <> 0)::INT + 1 AS good, 2 AS asked FROM c LEFT JOIN one ON one.id = c.id),
p AS (SELECT *, found AND trim(t2) <> '' AS there, found AND text IS NOT NULL AND t2 = text AS same, id % 17 = 0 AS err FROM j)
SELECT count(*)::BIGINT AS expected, (SELECT count(*) FROM g)::BIGINT AS submitted, count(*) FILTER (WHERE NOT found)::BIGINT AS missing,
 (SELECT sum(k) FROM n WHERE id NOT IN (SELECT id FROM c))::BIGINT AS extras, (SELECT sum(k - 1) FROM n WHERE id IN (SELECT id FROM c))::BIGINT AS duplicates,
 count(*) FILTER (WHERE found AND n2 = name AND good = 2 AND NOT err AND CASE WHEN text IS NULL THEN there ELSE same END)::BIGINT AS passed,
 count(*) FILTER (WHERE found AND good = 2)::BIGINT AS correct_fields, count(*) FILTER (WHERE found AND good = 2)::BIGINT AS fields_passed_cases, sum(asked)::BIGINT AS expected_field_assertions,
 sum(CASE WHEN found THEN good ELSE 0 END)::BIGINT AS correct_field_assertions, count(*) FILTER (WHERE found AND NOT err)::BIGINT AS valid_evidence, count(*) FILTER (WHERE there)::BIGINT AS text_present,
 count(*) FILTER (WHERE same)::BIGINT AS correct_text, count(*) FILTER (WHERE found AND text IS NULL)::BIGINT AS unscored_text, 0::BIGINT AS unreviewed, FALSE AS release_ready FROM p""")
def run_counters(spark, sf):
    rows, k = table(spark, sf, "customer"), F.col("c_custkey")
    kind = F.lit("spell").alias("type")
    cases = rows.filter(k % 10 != 1).select(k.alias("case_id"), F.col("c_name").alias("name"), kind, F.when(F.col("c_nationkey") < 20, F.col("c_mktsegment")).alias("text"))
    given = rows.filter(k % 5 != 2).select(k.alias("case_id"), F.when(k % 13 == 0, "x").otherwise(F.col("c_name")).alias("name"), kind, F.when(k % 7 == 0, " ").otherwise(F.col("c_mktsegment")).alias("text"))
    given = given.union(rows.filter(k % 15 == 0).select(k, "c_name", kind, "c_mktsegment"))
    asked = cases.select("case_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("i")).select("case_id", F.lit("/fields/a").alias("pointer"), F.lit(True).alias("is_field"), ((F.col("i") == 0) | (F.col("case_id") % 3 != 0)).alias("right"))
    return evals.counters(cases, given, asked, cases.filter("case_id % 17 = 0").select("case_id"), True)


@query("""SELECT DISTINCT * FROM (SELECT p_partkey AS id, unnest([CASE WHEN n > 1 THEN 'case_id repeats' END, CASE WHEN p_size % 4 = 0 THEN 'name is blank' END, CASE WHEN p_size % 3 = 0 THEN 'nothing is expected' WHEN p_size % 7 = 0 THEN 'a pointer does not start with a slash' END, CASE WHEN p_size > 40 THEN 'snapshot is unknown' END]) AS error
FROM (SELECT *, CASE WHEN p_partkey % 50 = 0 THEN 2 ELSE 1 END AS n FROM part)) WHERE error IS NOT NULL""")
def inventory_errors(spark, sf):
    part, size = table(spark, sf, "part"), F.col("p_size")
    part = part.unionByName(part.filter("p_partkey % 50 = 0"))
    pointers = F.when(size % 3 == 0, F.array().cast("array<string>")).when(size % 7 == 0, F.array(F.lit("/a"), F.lit("b"))).otherwise(F.array(F.lit("/a")))
    cases = part.select(F.col("p_partkey").cast("string").alias("case_id"), F.when(size % 4 == 0, " ").otherwise(F.col("p_name")).alias("name"), F.lit("spell").alias("type"), size.cast("string").alias("snapshot_id"), pointers.alias("expected"))
    snapshots = spark.range(0, 41).select(F.col("id").cast("string").alias("snapshot_id"))
    return evals.inventory_errors(cases, snapshots).select(F.col("case_id").cast("bigint").alias("id"), "error")


@query("""SELECT DISTINCT p_partkey AS id FROM (SELECT p_partkey, unnest(regexp_split_to_array(lower(p_name || ' ' || p_type || ' ' || p_brand), '[^a-z0-9]+')) AS t FROM part)
GROUP BY 1 HAVING count(*) FILTER (WHERE t LIKE 'st%') > 0 AND count(*) FILTER (WHERE t LIKE 'b%') > 0""")
def search_with_aliases(spark, sf):
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.array("p_type", "p_brand").alias("aliases"))
    index = search.token_index(rows, "id", search.names_and_aliases("name", "aliases"))
    return search.prefix_hits(index, "id", ["st", "b"])


@query("""
WITH f AS (SELECT p_partkey, unnest([{'g': 'b', 'o': 5, 'k': 'name', 'v': p_name}, {'g': CASE WHEN p_size > 25 THEN 'a' END, 'o': p_size % 7, 'k': 'type', 'v': CASE WHEN p_size % 2 = 0 THEN p_type END}, {'g': 'b', 'o': p_size % 11, 'k': 'brand', 'v': p_brand}]) AS x FROM part),
r AS (SELECT p_partkey, coalesce(x['g'], 'other') AS g, min(x['o']) AS o, string_agg(x['k'] || '=' || x['v'], ',' ORDER BY x['o'], x['k']) AS rows FROM f WHERE x['v'] IS NOT NULL GROUP BY 1, 2)
SELECT p_partkey, string_agg(g || ':' || rows, ';' ORDER BY o, g) AS groups FROM r GROUP BY 1""")
def field_groups(spark, sf):
    size = F.col("p_size")
    one = lambda g, o, k, v: F.struct(g.cast("string").alias("group"), o.cast("int").alias("order"), F.lit(k).alias("key"), F.lit(None).cast("string").alias("label"), v.alias("value"))
    fields = table(spark, sf, "part").select("p_partkey", F.inline(F.array(one(F.lit("b"), F.lit(5), "name", F.col("p_name")), one(F.when(size > 25, "a"), size % 7, "type", F.when(size % 2 == 0, F.col("p_type"))), one(F.lit("b"), size % 11, "brand", F.col("p_brand")))))
    shown = lambda g: F.concat(g["group"], F.lit(":"), F.array_join(F.transform(g["rows"], lambda r: F.concat(r["key"], F.lit("="), r["value"])), ","))
    return tree.field_groups(fields, "p_partkey").select("p_partkey", F.array_join(F.transform("groups", shown), ";").alias("groups"))


@query("SELECT n_name AS type, 'All ' || n_name AS label, count(*)::BIGINT AS n FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_mktsegment = 'BUILDING' GROUP BY 1")
def type_counts(spark, sf):
    nation = table(spark, sf, "nation")
    counts = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("type")).agg(F.count(F.lit(1)).alias("n"))
    return tree.type_counts(counts, nation.select(F.col("n_name").alias("type"), F.concat(F.lit("All "), "n_name").alias("label")))


@query("SELECT p_partkey AS id, p_brand AS type FROM part WHERE (p_brand = 'Brand#1' AND p_size < 10) OR p_brand IN ('Brand#2', 'Brand#3')")
def tree_merged(spark, sf):
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("type"), "p_size")
    return tree.merged(rows.filter("type = 'Brand#1' AND p_size < 10"), rows, ["Brand#2", "Brand#3"]).select("id", "type")


@query("""WITH b AS (SELECT s_suppkey AS id, CASE s_suppkey % 5 WHEN 0 THEN 'errata' WHEN 1 THEN 'index' WHEN 2 THEN 'excluded' ELSE 'core' END AS kind, CASE WHEN s_nationkey < 12 THEN '3.5' ELSE '3.0' END AS edition, s_suppkey % 10 = 3 AS beats FROM supplier),
s AS (SELECT kind, CASE WHEN id - 1 IN (SELECT id FROM b WHERE beats) THEN 'duplicate' WHEN kind = 'errata' THEN 'override' WHEN kind IN ('index', 'excluded') THEN kind WHEN edition = '3.5' THEN 'in_scope' ELSE 'out_of_scope' END AS scope FROM b)
SELECT 'kind' AS "of", kind AS value, count(*)::BIGINT AS n FROM s GROUP BY 2 UNION ALL SELECT 'scope', scope, count(*)::BIGINT FROM s GROUP BY 2""")
def manifest_counts(spark, sf):
    k = F.col("s_suppkey")
    kind = F.when(k % 5 == 0, "errata").when(k % 5 == 1, "index").when(k % 5 == 2, "excluded").otherwise("core")
    books = table(spark, sf, "supplier").select(k.cast("string").alias("book_id"), kind.alias("kind"), F.when(F.col("s_nationkey") < 12, "3.5").otherwise("3.0").alias("edition"), F.lit(None).cast("string").alias("applies_to"), F.when(k % 10 == 3, F.array((k + 1).cast("string"))).alias("preferred_over"))
    return readers.manifest_counts(books)


@query("""SELECT o_orderkey AS id, count(*)::BIGINT AS pages, max(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) AS caption FROM (SELECT *, unnest(range(o_orderkey, o_orderkey + o_orderkey % 4)) FROM orders) GROUP BY 1""")
def build_fan_out(spark, sf):
    k = F.col("o_orderkey")
    pages = F.when(k % 4 > 0, F.concat(F.sequence(k, k + k % 4 - 1), F.array(F.lit(None).cast("bigint"))))
    records = table(spark, sf, "orders").select(k.alias("id"), F.when(F.col("o_orderstatus") == "F", "table").otherwise("spell").alias("type"), F.col("o_custkey").alias("book_id"), pages.alias("pages"), F.col("o_orderpriority").alias("caption"), F.lit(None).cast("string").alias("columns"), F.lit(None).cast("string").alias("rows"), F.lit(None).cast("string").alias("parent"))
    made = canon.fan_out(records)
    return made["pages"].groupBy(F.col("record_id").alias("id")).agg(F.count(F.lit(1)).alias("pages")).join(made["tables"].select(F.col("record_id").alias("id"), "caption"), "id", "left")

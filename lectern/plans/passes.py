"""Queries: passes over whole books, checks against source text, and the queue's write-back.

Every order or customer is a small book whose paragraphs follow from its key, so that plain SQL
can say what must come out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import crosslinks, entries, evals, sourcetext, statblocks, workqueue
from lectern.plans.registry import query, table


def paragraphs(books, items):
    """Books (book, m) with the paragraphs ``items``: structs page, kind, text, lines, height."""
    return books.select("book", F.posexplode(F.array(*items)).alias("pos", "p")).select("book", "pos", "p.*")


def paragraph(page, kind, text, height=10.0):
    col = lambda x: F.lit(x) if isinstance(x, (str, int, float)) else x
    return F.struct(F.lit(page).alias("page"), col(kind).alias("kind"), col(text).alias("text"), F.lit(1).alias("lines"), F.lit(height).alias("height"))


@query("""
SELECT o_orderkey AS book, CASE m WHEN 5 THEN 1 ELSE 0 END AS pos, CASE m WHEN 0 THEN 'table' WHEN 1 THEN 'spell' WHEN 2 THEN 'feat' WHEN 6 THEN 'feat' ELSE 'stat_block' END AS trigger,
 CASE m WHEN 0 THEN 'Table 1-2: Rates' WHEN 5 THEN 'Hit Dice: 1d8' WHEN 6 THEN 'Swift Strike [General]' ELSE 'Swift Strike' END AS heading
FROM (SELECT o_orderkey, o_orderkey % 7 AS m FROM orders) WHERE m <> 4""")
def segment_anchors(spark, sf):
    m = F.col("m")
    books = table(spark, sf, "orders").select(F.col("o_orderkey").alias("book"), (F.col("o_orderkey") % 7).alias("m"))
    name = F.when(m == 0, "Table 1-2: Rates").when(m == 5, "plain words here in a row that make no name at all").otherwise("Swift Strike")
    cue = F.when(m == 0, "a\tb").when(m == 1, "Evocation [Fire]").when(m == 2, "So it goes. Benefit: yes, you do get it now.").when(m == 3, "Hit Dice: 2d8").when(m == 4, "just a sentence of many words that says nothing").when(m == 5, "Hit Dice: 1d8").otherwise("[General]")
    more = F.when(m == 6, "Benefit: it is there and you may have it.").otherwise("3 more of these and then some others for all")
    stream = paragraphs(books, [paragraph(1, "prose", name), paragraph(1, F.when(m == 0, "table").otherwise("prose"), cue), paragraph(1, "prose", more)])
    return entries.anchors(stream, F.lit(10.0)).select("book", "pos", "trigger", "heading")


@query("""
WITH b AS (SELECT o_custkey, o_orderkey, o_orderstatus, max(o_orderkey) OVER (PARTITION BY o_custkey) AS book_end FROM orders)
SELECT o_custkey AS book, printf('%d-%s-p%04d', o_custkey, CASE o_orderstatus WHEN 'F' THEN 'class' ELSE 'prestige_class' END, o_orderkey) AS seg_id, o_orderkey AS low, least(o_orderkey + 11, book_end) AS high
FROM b WHERE o_orderstatus <> 'P' AND EXISTS (SELECT 1 FROM orders p WHERE p.o_custkey = b.o_custkey AND p.o_orderkey BETWEEN b.o_orderkey AND least(b.o_orderkey + 10, b.book_end) AND p.o_orderkey % 3 = 0)""")
def class_spans(spark, sf):
    """Orders are pages of their customer; every third prints a hit die."""
    orders, k = table(spark, sf, "orders"), F.col("o_orderkey")
    category = F.when(F.col("o_orderstatus") == "F", "classes").when(F.col("o_orderstatus") == "O", "prestige-classes").otherwise("magic")
    toc = orders.select(F.col("o_custkey").alias("book"), k.alias("ord"), F.col("o_orderpriority").alias("title"), F.lit(2).alias("level"), category.alias("category"), k.alias("first"), (k + 10).alias("last"))
    text = F.when(k % 3 == 0, "Hit Die: d8.").when(k % 3 == 1, "Hit Die: d7.").otherwise("Nothing.")
    return entries.class_entries(toc, orders.select(F.col("o_custkey").alias("book"), k.alias("page"), text.alias("text"))).select("book", "seg_id", "low", "high")


@query("""
WITH b AS (SELECT o_orderkey AS book, o_orderkey % 4 AS m FROM orders)
SELECT book, printf('%d-monster-p0001-01', book) AS seg_id, 'GRUE' AS heading, 0 AS "start", 2 AS "end", 'Grue' AS titles, FALSE AS by_page FROM b
UNION ALL SELECT book, printf('%d-monster-p0002-01', book), 'ORCS', 2, 5, CASE m WHEN 0 THEN 'Orc' WHEN 1 THEN 'Orc,Small (orc)' WHEN 2 THEN 'Orc,Ghost' ELSE 'Orc,Ghost,Small (orc)' END, FALSE FROM b""")
def monster_spans(spark, sf):
    """Two printed monsters; a third title folds into the second, a fourth has no heading of its own."""
    m = F.col("m")
    books = table(spark, sf, "orders").select(F.col("o_orderkey").alias("book"), (F.col("o_orderkey") % 4).alias("m"))
    plain = "many plain words that go on in a line and are no heading"
    stream = paragraphs(books, [paragraph(1, "prose", "GRUE", 12.0), paragraph(1, "prose", "Hit Dice: 1d8"), paragraph(2, "prose", "ORCS", 12.0), paragraph(2, "prose", "Hit Dice: 2d8"), paragraph(3, "prose", plain)])
    pages = stream.filter("pos > 0").groupBy("book", "page").agg(F.array_join(F.collect_list("text"), "\n").alias("text"))
    entry = lambda o, t, p, when=F.lit(True): F.when(when, F.struct(F.lit(o).alias("ord"), F.lit(t).alias("title"), F.lit(p).alias("first"), F.lit(p).alias("last")))
    listed = F.array_compact(F.array(entry(0, "Grue", 1), entry(1, "Orc", 2), entry(2, "Small (orc)", 2, m % 2 == 1), entry(3, "Ghost", 2, m >= 2)))
    toc = books.select("book", F.inline(listed)).withColumns({"level": F.lit(2), "category": F.lit("monsters")})
    out = entries.monster_entries(toc, stream, pages, F.lit(10.0))
    return out.select("book", "seg_id", "heading", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), F.array_join("titles", ",").alias("titles"), "by_page")


@query("""
WITH s AS (SELECT o_custkey, o_orderkey AS lo, o_orderkey + 300 AS hi, printf('s%08d', o_orderkey) AS span FROM orders WHERE o_orderstatus = 'F'),
f AS (SELECT o_custkey, o_orderkey, o_orderkey % 5 AS m, CASE WHEN o_orderkey % 11 = 0 THEN 's' END AS old FROM orders),
w AS (SELECT o_orderkey, min(span) AS span FROM f JOIN s USING (o_custkey) WHERE old IS NULL AND m < 3 AND o_orderkey >= lo AND o_orderkey + 1 <= hi GROUP BY 1)
SELECT o_orderkey, coalesce(old, span) AS superseded_by, (span IS NULL)::INT AS held, (span IS NOT NULL)::INT AS freed FROM f LEFT JOIN w USING (o_orderkey)""")
def stamp_superseded(spark, sf):
    orders, k = table(spark, sf, "orders"), F.col("o_orderkey")
    spans = orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("book"), F.format_string("s%08d", k).alias("seg_id"), F.lit("Knight").alias("heading"), k.alias("low"), (k + 300).alias("high"))
    m = k % 5
    heading = F.when(m == 0, "Ex-Knights").when(m == 1, "CLASS FEATURES (Knight)").when(m == 2, "Any grid").when(m == 3, "The Knight's Mount").otherwise("Knight")
    kind = F.when(m == 2, "table").when(m == 4, "spell").otherwise("rules_section")
    fragments = orders.select(F.col("o_custkey").alias("book"), F.concat(F.lit("f"), k).alias("seg_id"), F.array(k, k + 1).alias("pages"), heading.alias("heading"), kind.alias("kind"), F.when(k % 11 == 0, "s").alias("superseded_by"), F.array(F.concat(F.lit("r"), k)).alias("records"))
    out = entries.stamp_superseded(fragments, spans)
    return out.select(F.substring("seg_id", 2, 20).cast("bigint").alias("o_orderkey"), "superseded_by", F.size("records").alias("held"), F.size("released").alias("freed"))


@query("""
SELECT c_custkey, concat_ws('; ', CASE WHEN m = 1 THEN 'heading is not printed' END, CASE WHEN m = 2 THEN 'ability is not printed: Purr' END, CASE WHEN m = 3 THEN 'described but not recorded: Trip (Ex)' END, CASE WHEN m = 4 THEN 'no dash for con' END) AS errors
FROM (SELECT c_custkey, c_custkey % 6 AS m FROM customer)""")
def monster_source_text(spark, sf):
    m = F.col("c_custkey") % 6
    text = F.concat(F.when(m == 1, "CAT. ").otherwise("GRIM  WOLF. "), F.lit("Con —, Int 2. Howl (Su): it howls. Trip (Ex): down you go."))
    text = F.when(m == 5, " ").when(m == 4, F.replace(text, F.lit("—"), F.lit("4"))).otherwise(text)
    abilities = F.when(m == 2, F.array(F.lit("Howl"), F.lit("Trip"), F.lit("Purr"))).when(m == 3, F.array(F.lit("Howl"))).otherwise(F.array(F.lit("Howl"), F.lit("Trip")))
    errors = sourcetext.monster_errors(F.lit("Grim Wolf"), F.lit(None).cast("string"), F.lit(None).cast("string"), abilities, F.array(F.lit("howl 2/day"), F.lit("Trip (Ex)")), F.array(F.lit("con")), text)
    return table(spark, sf, "customer").select("c_custkey", F.array_join(errors, "; ").alias("errors"))


@query("""
SELECT c_custkey AS id, CASE m WHEN 1 THEN 'feature is condensed: Rage (Ex)' WHEN 2 THEN 'heading is no feature: Fast Movement' WHEN 3 THEN 'section is not recorded: Ex-Knights' ELSE 'abilities are not recorded' END AS errors
FROM (SELECT c_custkey, c_custkey % 5 AS m FROM customer) WHERE m > 0""")
def class_source_text(spark, sf):
    m = F.col("id") % 5
    body = "GAME RULE INFORMATION\nAbilities: Strength.\nClass Features\nAll that. Rage (Ex): one two three four. Fast Movement: five six.\nNote: none.\nEx-Knights\nOdd Thing: not here."
    feature = lambda n, t: F.struct(F.lit(n).alias("name"), t.alias("text_md"))
    rage, fast = feature("Rages", F.when(m == 1, "one two").otherwise("one two three four")), feature("Fast Movement", F.lit("five six"))
    sections = F.array_compact(F.array(F.when(m != 3, "Ex-Knight"), F.when(m != 4, "Abilities")))
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("id")).withColumns({"name": F.lit("Knight"), "features": F.when(m == 2, F.array(rage)).otherwise(F.array(rage, fast)), "sections": sections, "text": F.lit(body)})
    return sourcetext.class_errors(rows).select("id", F.array_join("errors", "; ").alias("errors"))


@query("""
SELECT c_custkey, CASE m WHEN 0 THEN 'applies_to is empty' WHEN 1 THEN 'sections repeat' WHEN 2 THEN 'a modification has no text' WHEN 3 THEN 'modifications are empty' ELSE '' END AS errors FROM (SELECT c_custkey, c_custkey % 5 AS m FROM customer)""")
def template_checks(spark, sf):
    m = F.col("c_custkey") % 5
    one = lambda s, t: F.struct(s.alias("section"), t.alias("text_md"))
    changes = F.array(one(F.lit("Speed"), F.when(m == 2, " ").otherwise("as before")), one(F.when(m == 1, "Speeds (all)").otherwise("Attack"), F.lit("better")))
    changes = F.when(m == 3, F.slice(changes, 1, 0)).otherwise(changes)
    return table(spark, sf, "customer").select("c_custkey", F.array_join(sourcetext.template_errors(F.when(m != 0, "any beast"), changes), "; ").alias("errors"))


@query("""
WITH c AS (SELECT DISTINCT l_suppkey AS seg_id, l_partkey AS part FROM lineitem),
o AS (SELECT p_partkey AS part, p_size AS owner FROM part WHERE p_partkey % 4 = 0),
j AS (SELECT seg_id, c.part, CASE WHEN c.part % 5 = 0 THEN 'missing' WHEN owner <> seg_id THEN 'collision' ELSE 'claimed' END AS outcome FROM c LEFT JOIN o USING (part))
SELECT seg_id, CASE WHEN bool_and(outcome = 'claimed') THEN 'pending' ELSE 'failed' END AS status, count(*) FILTER (WHERE outcome = 'claimed')::INT AS moved, count(*) FILTER (WHERE outcome <> 'claimed')::INT AS refused FROM j GROUP BY 1""")
def staged_write_back(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("seg_id"), F.col("l_partkey").alias("part")).distinct()
    path = F.concat(F.lit("staging/"), F.col("part"))
    staged = lines.filter("part % 5 <> 0").select("seg_id", path.alias("path"), F.concat(F.lit("records/"), "part").alias("target"))
    replies = lines.groupBy("seg_id").agg(F.collect_list(path).alias("records"))
    held = table(spark, sf, "part").filter("p_partkey % 2 = 0").select(F.concat(F.lit("records/"), "p_partkey").alias("target"), F.col("p_size").cast("bigint").alias("owner"), (F.col("p_partkey") % 4 != 0).alias("superseded"))
    out = workqueue.write_back(workqueue.claim_files(replies, staged, held))
    return out.select("seg_id", "status", F.size("moves").alias("moved"), F.size("errors").alias("refused"))


@query("""
WITH s AS (SELECT o_orderkey AS k, o_orderkey % 4 AS m, o_orderkey % 3 AS p FROM orders)
SELECT k AS seg_id, CASE WHEN m = 3 THEN 'left_in_human' WHEN m = 2 THEN 'released' WHEN m = 1 THEN 'pruned' ELSE 'reset' END AS action, CASE m WHEN 0 THEN 'pending' WHEN 1 THEN 'pending' ELSE 'done' END AS status, CASE m WHEN 3 THEN 2 WHEN 2 THEN 0 ELSE 1 END AS n
FROM s WHERE m = 2 OR p > 0""")
def claims_fix(spark, sf):
    """Two claims a segment: the first is its own, the second its own, another's or missing."""
    k = F.col("o_orderkey")
    orders = table(spark, sf, "orders")
    path = lambda x: F.concat(F.lit(f"{x}/"), k)
    segments = orders.select(k.alias("seg_id"), (k % 4 == 3).alias("in_human"), (k % 4 == 2).alias("superseded"), F.when(k % 4 == 1, "pending").otherwise("done").alias("status"), F.array(path("a"), path("b")).alias("records"))
    owners = orders.select(path("a").alias("path"), k.alias("owner")).union(orders.filter("o_orderkey % 3 < 2").select(path("b"), k + k % 3))
    return workqueue.fix_claims(segments, owners).select("seg_id", "action", "status", F.size("records").alias("n"))


@query("""
WITH q AS (SELECT o_orderkey AS seg_id, o_orderkey % 3 + 1 AS tier, o_orderkey % 4 AS m FROM orders)
SELECT seg_id, CASE WHEN m IN (1, 3) AND tier < 3 THEN tier + 1 ELSE tier END::INT AS tier, CASE WHEN m IN (1, 3) AND tier = 3 THEN 'exhausted' ELSE 'pending' END AS status FROM q""")
def stuck_escalation(spark, sf):
    """Attempts by key: none, a failure here, one request for context here, two of them."""
    k = F.col("o_orderkey")
    tier, m = (k % 3 + 1).cast("int"), k % 4
    one = lambda t, kind: F.struct(t.cast("int").alias("tier"), F.lit(kind).alias("kind"))
    attempts = F.when(m == 1, F.array(one(tier, "validation"))).when(m == 2, F.array(one(tier, "needs_context"))).when(m == 3, F.array(one(tier, "needs_context"), one(tier, "needs_context"))).otherwise(F.array(one(tier + 1, "validation")))
    queue = table(spark, sf, "orders").select(k.alias("seg_id"), tier.alias("tier"), F.lit("pending").alias("status"), attempts.alias("attempts"))
    return workqueue.escalate_stuck(queue).select("seg_id", "tier", "status")


@query("""
SELECT c_custkey AS id, concat_ws('; ', CASE WHEN m = 1 THEN 'attack is off at level 2' END, CASE WHEN m = 5 THEN 'fort is off at level 3' END, CASE WHEN m = 0 THEN 'level table is not found' END, CASE WHEN m = 4 THEN 'levels have a gap' END,
 CASE WHEN m = 3 THEN 'no column of level 0 spells' END, CASE WHEN m = 2 THEN 'no feature for greater rage' END) AS errors FROM (SELECT c_custkey, c_custkey % 7 AS m FROM customer)""")
def class_level_tables(spark, sf):
    m = F.col("id") % 7
    ids = table(spark, sf, "customer").select(F.col("c_custkey").cast("bigint").alias("id"))
    feature = lambda n, k: F.struct(F.lit(n).alias("name"), F.lit(k).alias("level"), F.lit("what it does").alias("text_md"))
    saves = F.struct(F.lit("good").alias("fort"), F.lit("poor").alias("ref"), F.lit("poor").alias("will"))
    own = {"level_table": F.concat(F.lit("t"), "id"), "tables": F.array(F.concat(F.lit("t"), "id")), "max_level": F.lit(3), "attack": F.lit("good"), "saves": saves, "features": F.array(feature("Rage", 1), feature("Spells", None)), "caster": F.lit(True), "base": F.lit(True)}
    head = F.array(*map(F.lit, ["Level", "Base Attack Bonus", "Fort Save", "Ref Save", "Will Save", "Special"]), F.when(m == 3, "Spells per Day 1st").otherwise("Spells per Day 0"), F.lit("Spells per Day 5th"))
    row = lambda *cells: F.array(*(F.lit(c) if isinstance(c, str) else c for c in cells), F.lit("1"), F.lit("—"))
    rows = F.array(
        row("1st", "+1", "+2", "+0", "+0", "Rage 1/day"),
        row("2nd", F.when(m == 1, "+3").otherwise("+2"), "+3", "+0", "+0", F.when(m == 2, "Greater rage").otherwise("—")),
        row(F.when(m == 4, "4th").otherwise("3rd"), F.when(m == 4, "+4").otherwise("+3"), F.when(m == 4, "+4").when(m == 5, "+9").otherwise("+3"), "+1", "+1", "Rage 2/day"),
    )
    tables = ids.filter(m != 0).select(F.concat(F.lit("t"), "id").alias("id"), head.alias("columns"), rows.alias("rows"))
    out = statblocks.class_table_errors(ids.withColumns(own), tables)
    return out.select("id", F.array_join("errors", "; ").alias("errors"))


@query("""
SELECT c_custkey, concat_ws('; ', CASE WHEN m = 1 THEN 'size is unknown' END, CASE WHEN m = 2 THEN 'type is unknown' END, CASE WHEN m = 3 THEN 'subtype is unknown: Purple' END, CASE WHEN m = 4 THEN 'group and variant go together' END, CASE WHEN m = 5 THEN 'name is not group and variant' END) AS errors
FROM (SELECT c_custkey, c_custkey % 6 AS m FROM customer)""")
def monster_classification(spark, sf):
    m = F.col("c_custkey") % 6
    subtypes = F.array(F.lit("EVIL"), F.lit("Augmented Magical Beast"), F.when(m == 3, "Purple").otherwise("tanar'ri"))
    errors = F.concat(
        statblocks.classification_errors(F.when(m == 1, "small").otherwise("Small"), F.when(m != 2, "Outsider"), subtypes),
        statblocks.group_errors(F.when(m == 5, "Solar").otherwise("angel, Solar "), F.when(m != 4, "Angel"), F.lit("Solar")),
    )
    return table(spark, sf, "customer").select("c_custkey", F.array_join(errors, "; ").alias("errors"))


@query("SELECT p_partkey AS id, p_size < 25 AS bumped FROM part WHERE p_partkey % 3 = 0 OR p_size % 2 = 0")
def stale_records(spark, sf):
    """Versions by key: missing for every third, old for even sizes, current otherwise."""
    k, n = F.col("p_partkey"), F.col("p_size")
    version = F.when(k % 3 != 0, F.when(n % 2 == 0, 1).otherwise(2))
    errors = F.when(n < 25, F.array().cast("array<string>")).otherwise(F.array(F.lit("size is too large")))
    rows = table(spark, sf, "part").select(k.alias("id"), F.lit("spell").alias("type"), version.alias("schema_version"), errors.alias("errors_at_current"))
    types = spark.range(1).select(F.lit("spell").alias("type"), F.lit(2).alias("version"))
    return statblocks.stale(rows, types).select("id", "bumped")


@query("""
WITH s AS (SELECT event_id, event_type AS t, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id % 3 <> 0 AS passed FROM events)
SELECT event_id, n AS cases FROM s, (SELECT count(*)::BIGINT AS n FROM s) WHERE passed AND t = 'click' AND k = 7""")
def browse_evaluated(spark, sf):
    record = F.concat(F.lit('{"type": "'), "event_type", F.lit('", "fields": '), "props", F.lit("}"))
    scores = table(spark, sf, "events").select("event_id", F.parse_json(record).alias("candidate"), (F.col("event_id") % 3 != 0).alias("passed"))
    return evals.browse(scores, scores.agg(F.count(F.lit(1)).alias("cases")), "candidate", "click", "/fields/k", "7").select("event_id", "cases")


@query("""
SELECT c_custkey, CASE m WHEN 0 THEN 'Sorcerer,Wizard' WHEN 1 THEN 'Cleric' WHEN 2 THEN 'Death' ELSE 'Adept,Druid,Hexblade' END AS classes,
 CASE WHEN m = 3 THEN NULL ELSE 'records/b/spell/' || c_custkey || '.json' END AS target,
 'Cleric ' || c_nationkey || ', ' || c_mktsegment AS shown, CASE WHEN m = 1 THEN NULL ELSE c_nationkey END AS level
FROM (SELECT *, c_custkey % 4 AS m FROM customer)""")
def record_text_functions(spark, sf):
    """Class abbreviations, staged paths, values as shown, levels in combined values."""
    m, key = F.col("c_custkey") % 4, F.col("c_custkey").cast("string")
    token = F.when(m == 0, "Sor/Wiz").when(m == 1, " Clr").when(m == 2, "death").otherwise("Adp/Drd/hexblade")
    path = F.when(m == 0, F.concat(F.lit("stage/b/s/spell/"), key, F.lit(".json"))).when(m == 1, F.concat(F.lit("stage/b/./s/x/../spell/"), key, F.lit(".json"))).when(m == 2, F.concat(F.lit("stage//b/s/spell/"), key, F.lit(".json"))).otherwise(F.concat(F.lit("stage/b/s/../spell/"), key, F.lit(".json")))
    pair = lambda a, b: F.struct(a.cast("string").alias("class"), b.cast("string").alias("level"))
    objects = F.array(pair(F.lit("Cleric"), F.col("c_nationkey")), pair(F.lit(""), F.lit(None)), pair(F.col("c_mktsegment"), F.lit("")))
    values = F.array(F.when(m == 1, "Clerics 3").otherwise("Cleric x"), F.concat(F.when(m == 1, "Bard ").otherwise("Cleric "), F.col("c_nationkey").cast("string")))
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.array_join(T.expand_class(token), ",").alias("classes"),
        T.staged_target(path, F.lit("stage/b/s"), F.lit("b")).alias("target"),
        T.shown_objects(["class", "level"], objects).alias("shown"),
        T.level_of(values, F.lit("Cleric")).alias("level"),
    )


@query("SELECT a.c_custkey AS id, b.c_custkey AS target, 2::BIGINT AS n FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1")
def cross_links(spark, sf):
    """Customers whose texts name themselves and, twice, the next one."""
    name = F.concat(F.lit("Client No "), "c_custkey")
    following = F.concat(F.lit("Client No "), F.col("c_custkey") + 1)
    text = F.concat(F.lit("Ask "), following, F.lit(", not "), name, F.lit("; really: "), F.upper(following), F.lit("."))
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.lit("client").alias("type"), name.alias("name"), text.alias("text"))
    return crosslinks.cross_links(rows, {"client": "client"})

"""Passes over whole books, source text checks, queue write-back and layout, on small literal frames."""

import pytest
from pyspark.sql import functions as F

from lectern.operators import entries, layout, resolve, sourcetext, workqueue

STREAM = "book string, pos int, page int, kind string, text string, lines int, height double"


def stream(spark, *rows):
    return spark.createDataFrame([("b", i, *r) for i, r in enumerate(rows)], STREAM)


def test_anchors_inside_a_table_are_dropped_and_corrections_come_first(spark):
    rows = stream(spark, (1, "prose", "Fireball, page 12 Benefit: more.", 1, 10.0), (1, "prose", "Table 1–2: Rates", 1, 10.0), (1, "prose", "3 Wands, page 4", 1, 10.0), (1, "table", "a\tb", 1, 10.0), (2, "prose", "WOLF", 1, 12.0), (2, "prose", "Size/Type: Small", 1, 10.0))
    got = [(r.pos, r.trigger, r.heading, r.table_end) for r in entries.anchors(rows, F.lit(10.0), F.lit("errata_entry")).orderBy("pos").collect()]
    assert got == [(0, "errata_entry", "Fireball", None), (1, "table", "Table 1–2: Rates", 4), (4, "stat_block", "WOLF", None)]
    assert entries.anchors(rows.limit(0), F.lit(10.0)).count() == 0


def test_monster_without_hit_dice_in_its_paragraphs_takes_whole_pages(spark):
    plain = "plain words in a long line that is not a heading at all"
    rows = stream(spark, (1, "prose", "Hit Dice: 9d8 " + plain, 1, 10.0), (1, "prose", "CAT", 1, 12.0), (1, "prose", plain, 1, 10.0), (1, "prose", "DOG", 1, 12.0), (1, "prose", "Hit Dice: 1d8", 1, 10.0))
    pages = rows.groupBy("book", "page").agg(F.array_join(F.collect_list("text"), "\n").alias("text"))
    toc = spark.createDataFrame([("b", i, t, 2, "monsters", 1, 1) for i, t in enumerate(["Cat", "Dogs"])] + [("b", 2, "Eel", 1, "monsters", 1, 1), ("b", 3, "Fox", 2, "monsters", None, None)], "book string, ord int, title string, level int, category string, first int, last int")
    got = {r.heading: (r.start, r.end, r.by_page, r.titles) for r in entries.monster_entries(toc, rows, pages, F.lit(10.0)).collect()}
    assert got == {"CAT": (0, 3, False, ["Cat"]), "DOG": (2, 5, False, ["Dogs"])}
    later = rows.withColumn("text", F.when(F.col("pos") == 0, plain).otherwise(F.col("text")))
    got = {r.heading: (r.start, r.end, r.by_page) for r in entries.monster_entries(toc, later, pages, F.lit(10.0)).collect()}
    assert got == {"CAT": (0, 5, True), "DOG": (2, 5, False)}


@pytest.mark.parametrize(
    "heading, kind, title, owned",
    [("DRAGON SOCIETY", "rules_section", "Dragon, true", True), ("BATTLE", "rules_section", "Bat", False), ("ANGEL, SOLAR", "stat_block", "Angel", True), ("WORKER", "stat_block", "Formian worker", True), ("Combat", "rules_section", "Bat", True), ("Any grid", "table", "Bat", False), ("Bat sizes", "table", "Bat", True), ("Bat", "spell", "Bat", False), (None, "table", "Bat", False)],
)
def test_owned_by_monster(spark, heading, kind, title, owned):
    text = lambda t: F.lit(t).cast("string")
    assert spark.range(1).select(entries.owned_by_monster(text(heading), text(kind), text(title)).alias("x")).first().x is owned


def test_stamping_twice_changes_nothing(spark):
    spans = spark.createDataFrame([("b", "s2", "Knight", 1, 4), ("b", "s1", "Knight", 2, 4)], "book string, seg_id string, heading string, low int, high int")
    rows = [("b", "f1", [2, 3], "Knights", "rules_section", None, ["r1"]), ("b", "f2", [4, 5], "Knights", "rules_section", None, ["r2"]), ("b", "s1", [2], "Knight", "rules_section", None, []), ("b", "f3", [], "x", "table", None, [])]
    once = entries.stamp_superseded(spark.createDataFrame(rows, "book string, seg_id string, pages array<int>, heading string, kind string, superseded_by string, records array<string>"), spans)
    got = {r.seg_id: (r.superseded_by, r.records, r.released) for r in once.collect()}
    assert got == {"f1": ("s1", [], ["r1"]), "f2": (None, ["r2"], []), "s1": ("s2", [], []), "f3": (None, [], [])}
    again = entries.stamp_superseded(once.drop("released"), spans)
    assert {r.seg_id: (r.superseded_by, r.records) for r in again.collect()} == {k: v[:2] for k, v in got.items()}


def test_condensed_features_are_measured_past_a_column_break(spark):
    text = "Class Features\nSpells: one two three four five six seven eight nine ten one two three four five six seven eight at 1st-\nlevel things " + "more " * 25 + "end. Note: fine."
    rows = spark.createDataFrame([(1, "Bard", [("Spell", "word " * 19)], [], text), (2, "Bard", [("Spells", "word " * 40)], [], text), (3, "Bard", None, None, None)], "id int, name string, features array<struct<name:string,text_md:string>>, sections array<string>, text string")
    assert [(r.id, r.errors) for r in sourcetext.class_errors(rows).collect()] == [(1, ["feature is condensed: Spells"])]


def test_a_feature_does_not_describe_its_greater_form(spark):
    pair = lambda t, f: spark.range(1).select(sourcetext.described_by(F.lit(t), F.lit(f)).alias("x")).first().x
    assert pair("summon familiar", "familiar") and not pair("greater rage", "rage") and not pair("defeat", "feat") and not pair("", "rage")


def test_waves_end_when_nothing_is_left_to_ask(spark):
    queue = spark.createDataFrame([("a", 1, 1, "pending"), ("b", 1, 1, "pending"), ("c", 1, 3, "pending"), ("d", 2, 1, "done")], "seg_id string, book int, tier int, status string")
    replies = spark.createDataFrame([("a", 1, "validation", "x"), ("a", 2, "done", ""), ("c", 1, "malformed", "y")], "seg_id string, call int, kind string, error string")
    got = {r.seg_id: (r.tier, r.status, r.calls) for r in workqueue.waves(queue, replies, 1, resolve.cut_lineage).collect()}
    assert got == {"a": (2, "done", 2), "b": (1, "pending", 0), "c": (3, "exhausted", 1), "d": (1, "done", 0)}


def test_stamped_records_say_what_their_segment_says(spark):
    records = spark.createDataFrame([("r", "s", "wrong", [9], "t", "m")], "id string, seg_id string, book_id string, pages array<int>, tier string, model string")
    segments = spark.createDataFrame([("s", "right", [1, 2], "low", "small")], "seg_id string, book_id string, pages array<int>, tier string, model string")
    assert tuple(workqueue.stamp_records(records, segments).first()) == ("r", "s", "right", [1, 2], "low", "small")


def block(x, y, *lines, step=30.0):
    """Lines of words five wide a letter, three apart; a bar widens the gap."""
    out = []
    for i, line in enumerate(lines):
        words, at = [], x
        for t in line.split():
            if t == "|":
                at += step
                continue
            words.append({"x0": at, "x1": at + 5.0 * len(t), "y0": y + 12.0 * i, "y1": y + 12.0 * i + 10, "text": t})
            at += 5.0 * len(t) + 3
        out.append(layout.Line(words))
    return layout.Block(out)


def three():
    return [block(0, 0, "a1", "a2", "a3", "a4"), block(60, 0, "b1", "b2", "b3", "b4"), block(120, 0, "c1", "c2", "c3", "c4")]


def test_layout_takes_in_a_detached_column_but_not_half_of_another_table():
    [(kind, rows, _)] = layout.order_page([*three(), block(165, 0, "d1", "d2", "d3")])
    assert kind == "table" and rows == ["a1\tb1\tc1\td1", "a2\tb2\tc2\td2", "a3\tb3\tc3\td3", "a4\tb4\tc4"]
    grid, pool = layout.Grid(three()), [block(165, 0, "d1", "d2", "d3"), block(185, 0, "e1", "e2", "e3")]
    assert layout.with_column(grid, pool, True) is pool


def test_layout_joins_tables_and_takes_in_lone_cells():
    below = [block(0, 60, "e1", "e2"), block(60, 60, "f1", "f2"), block(120, 60, "g1", "g2")]
    assert [(k, len(r)) for k, r, _ in layout.order_page([*three(), *below])] == [("table", 6)]
    assert [(k, r[-1]) for k, r, _ in layout.order_page([*three(), block(60, 49, "x5")])] == [("table", "x5")]
    assert [k for k, _, _ in layout.order_page([*three(), block(60, 90, "x5")])] == ["table", "prose"]


def test_layout_of_single_blocks():
    grid = block(0, 0, "cat | a sharp pair of ears", "dog | a good nose for many tracks", "owl | eyes that see in the dark")
    assert layout.single_block_table(grid) == ["cat\ta sharp pair of ears", "dog\ta good nose for many tracks", "owl\teyes that see in the dark"]
    long_ = "so many words go here | and as many words go there | with yet some more of them"
    rows, parts = layout.single_block(block(0, 0, long_, long_, long_))
    assert rows is None and [len(p.lines) for p in parts] == [3, 3, 3] and parts[1].lines[0].text == "and as many words go there"
    assert layout.is_labelled(block(0, 0, "Range: far", "Speed: slow", "and so on"))


def test_layout_cuts_an_overwide_column_at_its_valley():
    left, right = block(0, 0, "aaaaaaaa"), block(52, 0, "bbbbbbbb")
    assert len(layout.columns([left, right])) == 1 and [len(c) for c in layout.columns([left, right], 50.0)] == [1, 1]
    assert len(layout.columns([left, block(45, 0, "bbbbbbbb")], 50.0)) == 1


def test_superseding_by_heading_parents_and_lists(spark):
    from lectern.operators import canon

    rows = [
        ("c", "class", "Druid", "druid", 10, 15, None, ["Wild Shape (Su)", "Alignment"], ["t1"]),
        ("f1", "rules_section", "Wild Shape", "wild-shape", 11, 12, None, None, None),
        ("f2", "rules_section", "Alignment", "alignment", 11, 11, None, None, None),
        ("f3", "rules_section", "The Druid's Companion", "the-druids-companion", 12, 12, None, None, None),
        ("f4", "spell", "Druid", "druid", 12, 12, None, None, None),
        ("t1", "table", "Listed", "listed", 12, 12, None, None, None),
        ("t2", "table", "Free", "free", 12, 12, None, None, None),
        ("t3", "table", "Companions", "companions", 12, 12, "f3", None, None),
        ("t4", "table", "Shapes", "shapes", 12, 12, "f1", None, None),
        ("t5", "table", "Late", "late", 15, 16, None, None, None),
    ]
    records = spark.createDataFrame(rows, "id string, type string, name string, slug string, first_page int, last_page int, parent string, headings array<string>, tables array<string>").withColumn("book_id", F.lit("b"))
    done = canon.supersede(records)
    assert {r.id for r in done.filter("superseded_by = 'c'").collect()} == {"f1", "t2", "t4"} and done.count() == len(rows)
    fixes = [("e1", "b", "Wild Shape", None), ("e2", "b", "Shape of Wild Shape", 12), ("e3", "b", "wild shape (Su)", None), ("e4", "b", "The Other", None), ("e5", "b", "Late", None)]
    fixed, missed = canon.apply_overrides(done, spark.createDataFrame(fixes, "id string, book_id string, target_name string, target_page int"))
    got = {r.id: r.applied_overrides for r in fixed.filter("size(applied_overrides) > 0").collect()}
    assert got == {"c": ["e1", "e3"], "t5": ["e5"]}
    told = {r.entry: r.candidates for r in missed.collect()}
    assert told["e4"] == ["f3"] and set(told) == {"e2", "e4"} and len(told["e2"]) == 5


def test_class_paragraphs(spark):
    plain = "plain words in a long line that is not a heading at all"
    rows = stream(
        spark,
        (1, "prose", "BARDS", 1, 12.0), (1, "prose", plain, 1, 10.0),
        (2, "prose", plain, 1, 10.0), (2, "prose", "MONK", 1, 12.0), (2, "prose", plain, 1, 10.0),
        (3, "prose", "EX-BARDS", 1, 12.0), (3, "prose", plain, 1, 10.0), (3, "prose", "Table 1-2: The Bard", 1, 10.0), (3, "table", "a\tb", 1, 10.0), (3, "prose", "OTHER", 1, 12.0),
    )
    spans = spark.createDataFrame([("b", "bard", "class", "Bard", 1, 3), ("b", "monk", "class", "Monk", 2, 3), ("b", "cook", "class", "Cook", 1, 1)], "book string, seg_id string, kind string, heading string, low int, high int")
    got = {}
    for r in entries.class_paragraphs(spans, rows, F.lit(10.0)).collect():
        got.setdefault((r.seg_id, r.part), []).append(r.pos)
    assert {k: sorted(v) for k, v in got.items()} == {("bard", "range"): [0, 1, 2], ("bard", "tail"): [5, 6], ("bard", "table"): [7, 8], ("monk", "range"): [3, 4, 5, 6, 7, 8, 9], ("cook", "pages"): [0, 1]}


def test_cross_links(spark):
    from lectern.operators import crosslinks

    rows = [
        ("g", "rules", "Grapple", "grapple", "See Improved Grapple. Grapple well, with the feat Light or Light, or the spell Light."),
        ("i", "feat", "Improved Grapple", "improved-grapple", "Better at grapples; not degrapple. A grapple!"),
        ("l1", "spell", "Light", "light", None), ("l2", "feat", "Light", "light", "the spell Light"),
    ]
    records = spark.createDataFrame(rows, "id string, type string, name string, slug string, text string")
    links = crosslinks.cross_links(records, {"spell": "spell", "feat": "feat"})
    assert {(r.id, r.target, r.n) for r in links.collect()} == {("g", "i", 1), ("g", "l2", 1), ("g", "l1", 1), ("i", "g", 1)}
    assert {r.target: [x.name for x in r.referenced_by] for r in crosslinks.referenced_by(links, records).collect()}["g"] == ["Improved Grapple"]
    with pytest.raises(ValueError):
        crosslinks.cross_links(records, {}, longest=1)


def test_cross_links_cut_only_lengths_of_names_and_broadcast_nothing(spark):
    from lectern.operators import crosslinks

    rows = [("l1", "spell", "Light", "Ask: the spell Light, not the feat Light."), ("l2", "feat", "Light", None), ("t", "rules", "Torch", "the spell Light; İ torch")]
    records = spark.createDataFrame(rows, "id string, type string, name string, text string").coalesce(1)
    links = crosslinks.cross_links(records, {"spell": "spell", "feat": "feat"}, longest=1)
    assert {(r.id, r.target, r.n) for r in links.collect()} == {("t", "l1", 1)}  # a lead may be longer than the longest name
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_monster_entries_broadcast_nothing(spark):
    """Small files can hold millions of books, which the driver cannot."""
    rows = stream(spark, (1, "prose", "CATS", 1, 12.0), (1, "prose", "Hit Dice: 1d8", 1, 10.0))
    pages = spark.createDataFrame([("b", 1, "Hit Dice: 1d8")], "book string, page int, text string")
    toc = spark.createDataFrame([("b", 0, "Cat", 2, "monsters", 1, 1)], "book string, ord int, title string, level int, category string, first int, last int")
    for made in (entries._printed(toc, pages, entries.HIT_DICE, 1), entries.monster_entries(toc, rows, pages, F.lit(10.0))):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert made.count() == 1 and "SortMergeJoin" in plan and "Broadcast" not in plan

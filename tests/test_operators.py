"""Operators on small literal frames: ties, cycles, gaps, errors, stores, sources, layout."""

import pytest
from pyspark.sql import functions as F

from lectern.functions import jsons, numbers
from lectern.functions import text as T
from lectern.operators import browse, cleanup, evals, intervals, layout, resolve, search, segments, validate, workqueue
from lectern.sources import readers, stores
from lectern.streaming import streams


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("name, slug", [("Bull's Strength", "bulls-strength"), ("Élan — Vital", "elan-vital"), ("ﬁre ½", "fire-12"), ("--", ""), ("Straße", "strae"), ("Ｆull", "full")])
def test_slugify(spark, name, slug):
    assert one(spark, T.slugify(F.lit(name))) == slug


@pytest.mark.parametrize("word, single", [("bodies", "body"), ("ties", "tie"), ("boxes", "box"), ("glass", "glass"), ("virus", "virus"), ("axis", "axis"), ("cats", "cat"), ("s", "s")])
def test_singular(spark, word, single):
    assert one(spark, T.singular(F.lit(word))) == single


def test_token_functions(spark):
    assert one(spark, T.special_token(F.lit("1st Evasions (Ex) 30 ft."))) == "evasion"
    assert one(spark, T.split_outside_parentheses(F.lit("a (b, c), —, d"))) == ["a (b, c)", "d"]
    assert one(spark, T.title_variants(F.lit("Golem, Iron (Big)"))) == ["golem, iron (big)", "golem, iron", "golem, iron big", "iron golem"]
    assert one(spark, T.group_name(F.lit("Iron (Golem)"))) == "Golem"
    assert one(spark, T.tokens_contain(T.heading_tokens(F.lit("The Iron Golem")), T.heading_tokens(F.lit("iron golem")))) is True
    assert one(spark, T.dehyphenate(F.array(F.lit("a spell-"), F.lit("caster and well-"), F.lit("known")), F.array(F.lit("spellcaster")))) == "a spellcaster and well-known"
    assert one(spark, T.is_heading(F.lit("[Evil]"), F.lit(20.0), F.lit(10.0), F.lit(1))) is False
    assert one(spark, T.is_heading(F.lit("LOUD ONE"), F.lit(10.0), F.lit(10.0), F.lit(1))) is True


def test_number_functions(spark):
    assert one(spark, numbers.attack_cell(F.lit(20), F.lit("good"))) == "+20/+15/+10/+5"
    assert one(spark, numbers.attack_cell(F.lit(1), F.lit("poor"))) == "+0"
    assert one(spark, numbers.save_cell(F.lit(1), F.lit("poor"))) == "+0"
    assert [tuple(t) for t in one(spark, numbers.dice_terms(F.lit("1/2 d3, 1/2d4 plus 3d8-2")))] == [(0.5, 4, 0), (3.0, 8, -2)]
    assert one(spark, numbers.upper_median(F.array(*map(F.lit, [4, 1, 3, 2])))) == 3
    assert one(spark, numbers.fraction(F.lit("x"))) is None


def test_json_functions(spark):
    v = lambda t: F.try_parse_json(F.lit(t))
    assert one(spark, jsons.strict(F.lit('{"a":1,"a":2}')).isNull()) and one(spark, jsons.strict(F.lit("[1]")).isNull())
    assert not one(spark, jsons.typed_equal(v("1"), v("true"))) and not one(spark, jsons.typed_equal(v("1"), v("1.5"))) and one(spark, jsons.typed_equal(v('{"b":1,"a":[2]}'), v('{"a":[2],"b":1}')))
    assert one(spark, F.to_json(jsons.resolve(v('{"a/b":[{"c":7}]}'), "/a~1b/0/c"))) == "7"
    with pytest.raises(ValueError):
        jsons.pointer_path("a")
    assert one(spark, jsons.canonical(F.lit('{"b": 1, "a": [1, 2]}'))) == '{"a":[1,2],"b":1}'


def test_query_parser():
    q = browse.parse_query([("school", "x"), ("school", "y"), ("sort", "-cr"), ("page", "2"), ("page_size", "999")], ["school"], ["cr"])
    assert q.filters == {"school": ["x", "y"]} and q.sort == "cr" and q.descending and q.page == 2 and q.page_size == 200
    for bad in ([("nope", "1")], [("page", "0")], [("page", "x")], [("sort", "hp")]):
        with pytest.raises(ValueError):
            browse.parse_query(bad, ["school"], ["cr"])
    with pytest.raises(ValueError):
        search.query_words(" a ")


def test_pointers_with_chains_cycles_and_dangling(spark):
    rows = [(1, None), (2, 1), (3, 2), (4, 3), (5, 6), (6, 5), (7, 5), (8, 99), (9, 9)]
    got = {r.id: r.root for r in resolve.flatten_pointers(spark.createDataFrame(rows, "id int, to int"), "id", "to").collect()}
    assert {k: got[k] for k in (1, 2, 3, 4, 8)} == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8}
    assert got[5] == 5 and got[6] == 6 and got[7] == 7 and got[9] == 9
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 5)], "src int, dst int")
    assert sorted((r.seed, r.id) for r in resolve.closure(edges, spark.createDataFrame([(1,), (4,)], "id int")).collect()) == [(1, 2), (1, 3), (4, 5)]


def test_first_stage_match_stops_at_ambiguity(spark):
    e = spark.createDataFrame([(1,), (2,), (3,), (4,)], "e int")
    s = lambda rows: spark.createDataFrame(rows, "e int, target int")
    got = sorted(((r.e, r.stage, r.target) for r in resolve.first_stage_match(e, "e", [s([(1, 10), (1, 11)]), s([(2, 20), (2, 21), (3, 30)]), s([(2, 40), (3, 50)])]).collect()), key=str)
    assert got == [(1, 1, 10), (1, 1, 11), (2, None, None), (3, 2, 30), (4, None, None)]


def test_deepest_span_and_ends(spark):
    spans = spark.createDataFrame([("book", 1, 1, 100), ("part", 2, 10, 20), ("open", 2, 15, None), ("same", 2, 10, 20)], "t string, level int, lo int, hi int")
    pts = spark.createDataFrame([(5,), (10,), (15,), (101,)], "p int")
    got = {r.p: r.t for r in intervals.deepest_containing(pts, F.col("p"), spans, "lo", "hi", [-F.col("level"), -F.col("lo"), F.col("t")], 8, ["t"]).collect()}
    assert got == {5: "book", 10: "part", 15: "open", 101: None}


def test_heights_and_offsets(spark):
    units = spark.createDataFrame([("b", 1.0), ("b", 2.0), ("b", 3.0), ("b", 4.0)], "book string, h double")
    assert cleanup.body_height(units, ["book"], "h").first().median == 3.0
    pairs = spark.createDataFrame([("b", 1, 3, 1), ("b", 2, 5, 2), ("b", 2, 4, 3), ("b", 3, 6, 4), ("b", 9, 1, 5), ("b", 9, 2, 6)], "book string, printed int, actual int, ord int")
    assert {r.printed: r.page for r in cleanup.invert_pages(pairs, ["book"], "printed", "actual", "ord").collect()} == {1: 3, 2: 4, 3: 6, 9: 2}


def test_segments(spark):
    assert [tuple(x) for x in one(spark, segments.contents_entries(F.lit("Magic ..... 12\nSpells . . . 7\nno 3")))] == [("Magic", 12), ("Spells", 7)]
    rows = spark.createDataFrame([(0, "x"), (1, "T"), (2, "y"), (3, "H"), (4, "z"), (5, "T"), (6, "T")], "pos int, t string").withColumn("b", F.lit(1))
    got = [r.segment for r in segments.cut_segments(rows, ["b"], "pos", F.col("t") == "T", F.col("t") == "H").orderBy("pos").collect()]
    assert got == [None, 1, 1, None, None, 2, 3]


def test_schema_errors(spark):
    schema = {"type": "object", "required": ["n"], "additionalProperties": False, "properties": {"n": {"type": ["integer", "null"], "minimum": 2}, "l": {"type": "array", "items": {"enum": ["a", "b"]}}}}
    say = lambda t: one(spark, validate.all_errors(validate.schema_errors(F.try_parse_json(F.lit(t)), schema)))
    assert say('{"n": 3}') == [] and say('{"n": null, "l": ["a"]}') == []
    assert say('{"n": 1}') == ["$.n: is less than 2"] and say("[]") == ["$: is not of type object"]
    assert say('{"l": ["a", "c"], "x": 1}') == ["$.l[1]: is not in [\"a\", \"b\"]", "$: has unknown x", "$: lacks n"]


@pytest.mark.parametrize("cell, source, found", [("", "x", True), ("—", "x", True), ("+2", "bonus +2 to", True), ("+3", "bonus +2 to", False), ("Sneak attack +1d6", "sneak x attack y +1d6", True), ("attack sneak", "sneak attack", False)])
def test_traceable(spark, cell, source, found):
    assert one(spark, validate.traceable(F.lit(cell), F.lit(source))) is found


def test_evidence_counts_code_points(spark):
    blocks = spark.createDataFrame([("b", "\U0001f600 ab")], "id string, text string")
    spans = spark.createDataFrame([("b", 2, 4, "ab"), ("b", 2, 4, "aB"), ("b", 3, 3, ""), ("c", 0, 1, "x"), ("b", 2, 9, "ab")], "block string, start int, end int, quote string")
    assert [r.valid for r in evals.evidence(spans, blocks, "id", "text").orderBy("block", "start", "end", F.desc("quote")).collect()].count(True) == 1


def test_ladder_stream_step_is_the_batch_rule(spark):
    rows = [(1, k, 0 if k % 4 else 1, kind, e) for k, (kind, e) in enumerate([("validation", "x"), ("validation", "x"), ("needs_context", ""), ("needs_context", ""), ("other", ""), ("validation", "y"), ("validation", "y"), ("other", "")])]
    got = workqueue.fold_attempts(spark.createDataFrame(rows, "u int, i int, tier int, kind string, error string"), "u", ["i"]).first()
    state = (1, "pending", 0, "", "", False, 0)
    for _, _, tier, kind, error in rows:
        state = streams.step(state, (tier, kind, error))
    assert (got.tier, got.status, got.logged) == (state[0], state[1], state[6])


def test_stores(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = lambda *r: spark.createDataFrame(list(r), "id int, body string")
    assert stores.append_once(spark, f"{root}/s", rows((1, "a"), (2, "b")), "id", "body") == 2
    assert stores.append_once(spark, f"{root}/s", rows((2, "b"), (3, "c")), "id", "body") == 1
    with pytest.raises(stores.Conflict):
        stores.append_once(spark, f"{root}/s", rows((3, "x")), "id", "body")
    stores.build(spark, f"{root}/b", {"t": rows((1, "a"))})
    with pytest.raises(Exception):
        stores.build(spark, f"{root}/b", {"t": rows((2, "b")).select(F.raise_error(F.lit("no")).alias("x"))})
    assert [r.id for r in stores.current(spark, f"{root}/b", "t").collect()] == [1]
    segs = spark.createDataFrame([("s1", "b1", "old")], "seg string, book string, v string")
    stores.write_new_segments(spark, f"{root}/g", segs, "seg", "book")
    stores.write_new_segments(spark, f"{root}/g", segs.union(segs.selectExpr("'s2'", "book", "'new'")).withColumn("v", F.lit("new")), "seg", "book")
    assert {r.seg: r.v for r in spark.read.parquet(f"{root}/g").collect()} == {"s1": "old", "s2": "new"}


def test_sources(spark, tmp_path):
    books = readers.manifest(spark, [{"book_id": "a", "kind": "core", "edition": "3.0", "preferred_over": ["b"]}, {"book_id": "b", "kind": "core", "edition": "3.5"}, {"book_id": "u", "kind": "update", "applies_to": "a"}, {"book_id": "e", "kind": "errata", "applies_to": "zz"}, {"book_id": "x", "kind": "excluded", "published": "2003-13"}])
    assert {(r.book_id, r.problem) for r in readers.manifest_problems(books).collect()} == {("e", "applies_to names no book"), ("x", "excluded without a reason"), ("x", "published is not YYYY-MM")}
    assert {r.book_id: r.scope for r in readers.scope(books).collect()} == {"a": "in_scope", "b": "duplicate", "u": "override", "e": "override", "x": "excluded"}
    with pytest.raises(readers.ManifestError):
        readers.manifest(spark, [{"book_id": "a", "wrong": 1}])
    folder = tmp_path / "records" / "bk" / "spell"
    folder.mkdir(parents=True)
    (folder / "one.json").write_text('{"id": "1"}')
    (folder / "two.json").write_text('{"id": "1", "id": "2"}')
    got = {r.path.rpartition("/")[2]: (r.book_id, r.type, r.error) for r in readers.records(spark, f"file://{tmp_path}/records").drop("record").collect()}
    assert got == {"one.json": ("bk", "spell", None), "two.json": ("bk", "spell", "not a JSON object")}
    html = '<doc><page width="1" height="2"><flow><block xMin="0"><line><word xMin="1.5" yMin="2" xMax="3" yMax="4">a&amp;b</word>\x01<word xMin="4" yMin="2" xMax="5" yMax="4">c</word></line></block></flow></page><page/></doc>'
    words = readers.geometry(spark.createDataFrame([(1, html)], "id int, t string"), "id", "t").orderBy("pos").collect()
    assert [(r.page, r.x0, r.text) for r in words] == [(0, 1.5, "a&b"), (0, 4.0, "c")]
    texts = spark.createDataFrame([(1, "a\n\nb"), (2, "c")], "page int, text string")
    side = spark.createDataFrame([(1, ["x", "y"]), (2, ["x", "y"]), (3, ["x"])], "page int, entries array<string>")
    assert sorted((r.page, r.missing, r.text or "") for r in readers.paragraphs(texts, side, ["page"]).collect()) == [(1, False, "a"), (1, False, "b"), (2, True, ""), (3, True, "")]


def block(x, y, *lines, w=10.0, gap=5.0):
    return layout.Block([layout.Line([{"x0": x + k * (w + gap), "x1": x + k * (w + gap) + w, "y0": y + i * 12.0, "y1": y + i * 12.0 + 10, "text": t} for k, t in enumerate(line.split())]) for i, line in enumerate(lines)])


def test_layout_orders_columns_and_tables():
    left, right = block(0, 100, "a b", "c d"), block(300, 100, "e f", "g h")
    title = block(0, 0, " ".join("t" for _ in range(24)))
    got = layout.order_page([right, left, title])
    assert [u[1] for u in got] == [[" ".join("t" for _ in range(24))], ["a b", "c d"], ["e f", "g h"]]
    cells = [block(100.0 * k, 50, *[f"{k}{i}" for i in range(4)]) for k in range(4)]
    assert layout.order_page(cells) == [("table", ["\t".join(f"{k}{i}" for k in range(4)) for i in range(4)], [10.0] * 16)]
    tall = layout.Block([layout.Line([{"x0": 0.0, "x1": 5.0, "y0": 0.0, "y1": 80.0, "text": "side"}])])
    assert layout.order_page([tall]) == [] and layout.order_page([]) == []
    assert layout.single_block_table(block(0, 0, "a b c d", "e f g h", "i j k l")) is None
    assert layout.single_block_table(block(0, 0, "one", "two", "three")) is None
    assert layout.cluster([1.0, 1.2, 5.0, 0.9], 0.5) == [[3, 0, 1], [2]]


def test_layout_does_not_depend_on_row_order(spark):
    from lectern.plans.layouts import line_words

    words = line_words(spark, "/root/testdata/sf0.001")
    a = {tuple(r) for r in layout.reading_order(layout.pages_of_words(words)).collect()}
    assert a == {tuple(r) for r in layout.reading_order(layout.pages_of_words(words.repartition(7))).collect()}


def test_canonicalisation_passes(spark):
    from lectern.operators import canon

    ddl = "id string, type string, name string, slug string, book_id string, published string, topic string, first_page int, last_page int, parent string"
    rows = [
        ("a1", "spell", "Light", "light", "a", "2000-08", None, 5, 5, None),
        ("b1", "spell", "Light", "light", "b", "2003-07", None, 9, 9, None),
        ("c1", "spell", "Light", "light", "c", None, None, 1, 1, None),
        ("a2", "class", "Bard", "bard", "a", "2000-08", None, 20, 25, None),
        ("a3", "table", "Bard Spells", "bard-spells", "a", "2000-08", None, 21, 21, None),
        ("a4", "table", "Other", "other", "a", "2000-08", None, 22, 22, "zz"),
        ("r1", "rules_section", "Cover", "cover", "rc", "2007-10", "cover", 1, 1, None),
        ("b2", "rules_section", "Cover", "cover", "b", "2009-01", "cover", 2, 2, None),
    ]
    fixes = spark.createDataFrame([("e1", "b", "Light", None), ("e2", "a", "Light", None), ("e3", "a", "Nothing", 99), ("e4", "a", "Bard (big)", None)], "id string, book_id string, target_name string, target_page int")
    out = canon.canonicalise(spark.createDataFrame(rows, ddl), fixes, "rc")
    got = {r.id: r for r in out["records"].collect()}
    assert got["b1"].canonical and got["a1"].variant_of == "b1" and got["c1"].variant_of == "b1"
    assert sorted(got["b1"].applied_overrides) == ["e1", "e2"] and got["a1"].applied_overrides == ["e2"]
    assert got["a3"].superseded_by == "a2" and not got["a3"].canonical and got["a2"].canonical
    assert got["r1"].canonical and got["b2"].variant_of == "r1"
    assert [r.entry for r in out["unmatched"].collect()] == ["e3"] and got["a2"].applied_overrides == ["e4"]
    assert [r.id for r in out["dangling"].collect()] == ["a4"]
    assert canon.detail(out["records"], "spell", "light").first().variants == ["c1", "a1"]
    told = {(r.counter, r.type): r.n for r in canon.counters(spark.createDataFrame([*rows, rows[0]], ddl), spark.createDataFrame(rows, ddl), out["records"], out["unmatched"], out["dangling"]).collect()}
    assert told == {("loaded", "spell"): 3, ("loaded", "class"): 1, ("loaded", "table"): 2, ("loaded", "rules_section"): 2, ("skipped", None): 1, ("superseded", None): sum(r.superseded_by is not None for r in got.values()), ("variants", None): 3, ("overrides", None): 3, ("unmatched", None): 1, ("dangling", None): 1}


def test_closure_of_a_long_chain(spark):
    """120 links, more than the rounds."""
    edges = spark.range(1, 121).selectExpr("id src", "id - 1 dst")
    got = resolve.closure(edges, spark.createDataFrame([(0,), (60,)], "id long")).collect()
    assert sorted((r.seed, r.id) for r in got) == [(s, i) for s in (0, 60) for i in range(121) if i != s]


def test_benchmark_items_glued_and_short(spark, tmp_path):
    from lectern.plans import checking

    long = "one two three four five six seven eight"
    spark.createDataFrame([(1, long), (2, "tiny item"), (3, "not there at all in any of them")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, f'said "{long}" twice'), (2, f"x {long} y"), (3, "a (tiny item)"), (4, "one two three")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = checking.cells_traceable(spark, str(tmp_path)).collect()
    assert sorted((r.item_id, r.doc_id) for r in got) == [(1, 1), (1, 2), (2, 3)]


def test_headings_normalised_after_forty_characters(spark, tmp_path):
    from lectern.plans import texts

    spark.createDataFrame([(1, "word " * 12 + "(note) End\nSecond: Line")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = texts.normalize_heading_lines(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r.pos, r.key, r.tokens) for r in got] == [(0, "word" * 12 + "end", "word " * 12 + "end"), (1, "secondline", "second line")]

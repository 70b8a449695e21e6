"""Nothing is lost silently: stores, pointers, streams, loads; what a build shows of its records."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lectern.operators import canon, eav, entries, intervals, resolve, workqueue
from lectern.service import Service
from lectern.sources import readers, stores
from lectern.streaming import streams

ROOT = Path(__file__).resolve().parent.parent


def test_conflicts_inside_a_batch(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(r, "id int, body string")
    path = f"file://{tmp_path}/s"
    with pytest.raises(stores.Conflict):
        stores.append_once(spark, path, rows((1, "a"), (1, "b")), "id", "body")
    assert stores.append_once(spark, path, rows((1, "a"), (1, "a"), (2, None)), "id", "body") == 2
    for clash in (rows((3, "x"), (3, "y")), rows((3, None), (3, "y"))):
        with pytest.raises(stores.Conflict):
            stores.append_once(spark, path, clash, "id", "body")
    assert spark.read.parquet(path).count() == 2


def test_texts_are_replaced_with_their_mode(spark, tmp_path):
    path = f"file://{tmp_path}/CURRENT"
    stores.write_text(spark, path, "one")
    os.chmod(tmp_path / "CURRENT", 0o640)
    stores.write_text(spark, path, "two\né")
    assert stores.read_text(spark, path) == "two\né"
    assert os.stat(tmp_path / "CURRENT").st_mode & 0o777 == 0o640 and os.listdir(tmp_path) == ["CURRENT"]


def test_segments_of_some_pages(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(r, "id string, page int, text string, book string")
    path = f"file://{tmp_path}/segments"
    stores.write_new_segments(spark, path, rows(("a1", 1, "old", "a"), ("a2", 5, "old", "a"), ("b1", 1, "old", "b")), "id", "book")
    stores.write_new_segments(spark, path, rows(("a1", 1, "new", "a"), ("a9", 6, "new", "a")), "id", "book", force=True, pages=(4, 9))
    assert {(r.id, r.text) for r in spark.read.parquet(path).collect()} == {("a1", "old"), ("a9", "new"), ("b1", "old")}


def test_long_chains_end_or_raise(spark):
    n = 700
    chain = spark.createDataFrame([(i, i + 1 if i < n else None) for i in range(n + 1)], "id int, nxt int")
    assert {r.root for r in resolve.flatten_pointers(chain, "id", "nxt").collect()} == {n}
    with pytest.raises(RuntimeError):
        resolve.flatten_pointers(chain, "id", "nxt", max_rounds=3)
    links = chain.select(F.col("id").alias("src"), F.col("nxt").alias("dst"))
    assert resolve.closure(links, spark.createDataFrame([(0,)], "id int")).count() == n
    with pytest.raises(RuntimeError):
        resolve.closure(links, spark.createDataFrame([(0,)], "id int"), max_rounds=2)


def test_waves_raise_when_work_is_left(spark):
    queue = spark.createDataFrame([(i, "b", 1, "pending") for i in range(3)], "seg_id int, book string, tier int, status string")
    replies = spark.createDataFrame([(i, 1, "done", "") for i in range(3)], "seg_id int, call int, kind string, error string")
    assert {r.status for r in workqueue.waves(queue, replies, 1, resolve.cut_lineage).collect()} == {"done"}
    with pytest.raises(RuntimeError):
        workqueue.waves(queue, replies, 1, resolve.cut_lineage, max_waves=2)


def test_records_without_ids_stay(spark):
    rows = spark.createDataFrame([(None, "p1", "s"), (None, "p2", "s"), ("a", "p3", "s"), ("a", "p4", "s")], "id string, path string, segment_id string")
    none = spark.createDataFrame([], "segment_id string")
    assert sorted(r.path for r in canon.load(rows, F.array().cast("array<string>"), none).collect()) == ["p1", "p2", "p3"]
    assert sorted(r.path for r in readers.first_of_each(rows, F.col("id")).collect()) == ["p1", "p2", "p3"]


def test_authority_without_topics(spark):
    rows = spark.createDataFrame([(1, "x", "a"), (2, "x", "b"), (3, None, "b"), (4, "y", "b"), (5, None, "a")], "id int, topic string, book string")
    got = {r.id: (r.canonical, r.variant_of) for r in resolve.authority_wins(rows, "topic", "book", "a", "id").collect()}
    assert got == {1: (True, None), 2: (False, 1), 3: (True, None), 4: (True, None), 5: (True, None)}


def test_points_keep_their_rows_through_a_shuffle(spark):
    points = spark.range(500).withColumn("p", F.col("id") % 50).repartition(7)
    spans = spark.createDataFrame([(k, k * 10, k * 10 + 9) for k in range(4)], "k long, lo long, hi long")
    got = intervals.deepest_containing(points, F.col("p"), spans, "lo", "hi", [F.col("k")], 16, ["k"]).collect()
    assert len(got) == 500 and all(r.k == (r.p // 10 if r.p < 40 else None) for r in got)


def test_batches_that_come_again_are_stored_once(spark, tmp_path):
    folder = f"{tmp_path}/in"
    for part in range(3):
        spark.range(part * 10, part * 10 + 10).coalesce(1).write.mode("append").parquet(f"file://{folder}")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"file://{folder}")
    out = streams.run_once(stream, "again", "append")
    batches = sorted({f.rpartition("/")[0] for f in out.inputFiles()})
    assert out.count() == 30 and len(batches) == 3


def test_number_entities(spark):
    words = "".join(f'<word xMin="1" yMin="2" xMax="3" yMax="4">{w}</word>' for w in ("caf&#233;", "&#x41;&#66;&amp;#67;", "&#xD800;x", "&#39;q&#8217;", "a&#b", "&lt;&#128512;"))
    page = f"<page><block><line>{words}</line></block></page>"
    got = readers.geometry(spark.createDataFrame([(1, page)], "id int, x string"), "id", "x").orderBy("pos").collect()
    assert [r.text for r in got] == ["café", "AB&#67;", "&#xD800;x", "'q’", "a&#b", "<\U0001f600"]


def test_pages_without_sidecars_are_named(spark):
    texts = spark.createDataFrame([("b", 1, "x\n\ny"), ("b", 2, "z"), ("c", 3, "q")], "book string, page int, text string")
    side = spark.createDataFrame([("b", 1, ["1", "2"]), ("b", 2, ["1", "2"])], "book string, page int, entries array<string>")
    with pytest.raises(readers.PagesMissing, match="2 pages.*b/2, c/3"):
        readers.checked_paragraphs(texts, side, ["book", "page"])
    assert readers.checked_paragraphs(texts.filter("page = 1"), side.filter("page = 1"), ["book", "page"]).count() == 2


def test_markers_cut_by_a_page(spark):
    toc = spark.createDataFrame([("b", 0, "Grue", 2, "monsters", 1, 1)], "book string, ord int, title string, level int, category string, first int, last int")
    stream = spark.createDataFrame([("b", 0, 1, "prose", "GRUE", 1, 12.0), ("b", 1, 1, "prose", "It has Hit", 1, 10.0), ("b", 2, 2, "prose", "Dice: 3d8", 1, 10.0)], "book string, pos int, page int, kind string, text string, lines int, height double")
    pages = spark.createDataFrame([("b", 1, "GRUE\nIt has Hit"), ("b", 2, "Dice: 3d8")], "book string, page int, text string")
    got = entries.monster_entries(toc, stream, pages, F.lit(10.0)).collect()
    assert [(r.heading, r.start, r.end, r.by_page) for r in got] == [("GRUE", 0, 3, False)]


def test_what_a_build_shows(spark, tmp_path):
    rows = spark.createDataFrame([("s1", "spell", "Light", "light", ["glow ball"], "a", ["t1", "t9"], ["o1"], "Magic"), ("t1", "table", "Rays", "rays", None, "a", None, None, None), ("o1", "update", "Light again", "light-again", None, "b", None, None, None)], "id string, type string, name string, slug string, aliases array<string>, book_id string, tables array<string>, applied_overrides array<string>, toc_chapter string")
    rows = rows.withColumns({"canonical": F.lit(True), "published": F.lit("2003-07"), "variant_of": F.lit(None).cast("string"), "first_page": F.lit(7), "toc_category": F.lit("magic"), "school": F.lit("Evocation")})
    books = spark.createDataFrame([("a", "The A Book", "A")], "book_id string, title string, short_title string")
    schemas = {"spell": {"title": "Spells", "properties": {"school": {"type": "string", "x-ui": {"filterable": True}}}}}
    root = f"file://{tmp_path}/store"
    from lectern.operators import search

    index = search.token_index(rows, "id", search.names_and_aliases("name", "aliases"))
    stores.build(spark, root, {"records": rows.drop("school"), "fields": eav.flatten_fields(rows.filter("type = 'spell'"), "id", ["school"]), "books": books, "tokens": index})
    service = Service(spark, root, schemas)
    hits = service.search("glow").collect()
    assert [(r.type, r.names, r.label) for r in hits] == [("spell", ["Light"], "Spells")]
    found = service.record("spell", "light")
    assert found.book_title == "The A Book" and found.toc.chapter == "Magic"
    assert [(t["_ref"], t["name"]) for t in found.tables] == [("t1", "Rays"), ("t9", None)] and [o["name"] for o in found.applied_overrides] == ["Light again"]
    item = service.items("spell").collect()[0]
    assert item.page == 7 and item.facets == {"school": ["Evocation"]}


def test_without_the_training_data_part(tmp_path):
    """A copy without both folders imports and keeps its other queries; so does one whose imports fail."""
    for at in ("lectern", "tests"):
        shutil.copytree(ROOT / at, tmp_path / at, ignore=shutil.ignore_patterns("__pycache__", "llm"))
    for at in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(ROOT / at, tmp_path / at)
    code = "import __spark_entry__ as e; q = e.queries(); s = e.oracle_sql(); assert len(q) > 100 and 'pipeline' not in q and not any(n[:2] == 'op' and n[2:3].isdigit() for n in [*q, *s])"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)
    (tmp_path / "corpus_pipeline.py").unlink()
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)
    subprocess.run([sys.executable, "-c", "import sys; sys.modules['xxhash'] = None; " + code], check=True, cwd=ROOT)

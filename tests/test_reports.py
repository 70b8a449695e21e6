"""The precedence report, unmatched corrections as files, and the lock of a book's queue."""

import json
import threading
from pathlib import Path

import pytest

from lectern.operators import canon
from lectern.sources import stores


def test_unmatched_corrections_by_book(spark, tmp_path):
    root = f"file://{tmp_path}/unmatched"
    rows = lambda *r: spark.createDataFrame(r, "book_id string, entry string, candidates array<string>")
    books = lambda *r: spark.createDataFrame([(b,) for b in r], "book_id string")
    shown = lambda folder: {(p.parent.name, json.loads(line)["entry"]) for p in Path(folder.removeprefix("file://")).rglob("*.json") for line in p.read_text().splitlines()}
    first = stores.write_unmatched(spark, root, rows(("a", "e1", ["x"]), ("a", "e2", []), ("b", "e3", None), ("c", "e4", [])), books("a", "b", "c"))
    assert shown(first) == {("book_id=a", "e1"), ("book_id=a", "e2"), ("book_id=b", "e3"), ("book_id=c", "e4")}
    second = stores.write_unmatched(spark, root, rows(("a", "e2", [])), books("a", "b"))
    assert shown(second) == {("book_id=a", "e2"), ("book_id=c", "e4")}


@pytest.mark.parametrize("missed", [[], [("e1", "a", None, "Light", []), ("e2", "a", 7, None, ["r1", "r2"])]])
def test_report_as_text(spark, tmp_path, missed):
    counts = spark.createDataFrame([("variants", None, 2), ("loaded", "spell", 5)], "counter string, type string, n bigint")
    unmatched = spark.createDataFrame(missed, "entry string, target_book string, target_page int, target_name string, candidates array<string>")
    stores.write_lines(canon.report_lines(counts, unmatched), f"file://{tmp_path}/report")
    head = ["# Precedence report", "", "## Summary", "", "- loaded spell: 5", "- variants: 2", "", "## Unmatched corrections", ""]
    table = ["| entry | target book | target page | target name | candidates |", "| --- | --- | --- | --- | --- |", "| e1 | a |  | Light | (none) |", "| e2 | a | 7 |  | r1; r2 |"]
    assert [line for p in (tmp_path / "report").glob("part-*") for line in p.read_text().splitlines()] == head + (table if missed else ["None."])


def test_one_writer_a_book(spark, tmp_path):
    root = f"file://{tmp_path}/queue"
    with stores.book_lock(spark, root, "a"):
        with pytest.raises(stores.LockTimeout):
            with stores.book_lock(spark, root, "a", timeout=0.2):
                pass
        with stores.book_lock(spark, root, "b", timeout=0.2):
            pass
    with pytest.raises(ZeroDivisionError):
        with stores.book_lock(spark, root, "a", timeout=0.2):
            1 / 0
    held, most = [], []

    def work():
        with stores.book_lock(spark, root, "a", timeout=30):
            held.append(1)
            most.append(len(held))
            held.pop()

    threads = [threading.Thread(target=work) for _ in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert most == [1] * 8 and not list((tmp_path / "queue").iterdir())

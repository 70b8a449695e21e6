"""Append-once stores and build directories that are swapped whole."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.resolve import cut_lineage


BAD_BODIES = 5  # ids named in an error


class Conflict(ValueError):
    """An id is stored with other contents."""


def append_outcome(stored: DataFrame, new: DataFrame, id_col: str, body: str) -> DataFrame:
    """Per new row: added, same (stored already) or conflict (stored otherwise)."""
    old = stored.select(F.col(id_col), F.col(body).alias("_old"))
    outcome = F.when(F.col("_old").isNull(), "added").when(F.col("_old") == F.col(body), "same").otherwise("conflict")
    return new.join(old, id_col, "left").withColumn("outcome", outcome).drop("_old")


def append_once(spark: SparkSession, path: str, new: DataFrame, id_col: str, body: str) -> int:
    """Add rows with new ids; equal rows are no change, other contents an error, in the batch as in the store.  Returns the number added."""
    bodies = new.groupBy(id_col).agg(F.min(body).alias("_low"), F.max(body).alias("_high"), F.count(body).alias("_told"), F.count(F.lit(1)).alias("_n"))
    differ = (F.col("_low") != F.col("_high")) | ((F.col("_told") > 0) & (F.col("_told") < F.col("_n")))
    clash = [r[id_col] for r in bodies.filter(differ).select(id_col).limit(BAD_BODIES).collect()]
    if clash:
        raise Conflict(f"given with several contents: {clash}")
    try:
        stored = spark.read.parquet(path)
    except Exception as e:  # the first append makes the store
        if "PATH_NOT_FOUND" not in str(e):
            raise
        new.dropDuplicates([id_col]).write.parquet(path)
        return spark.read.parquet(path).count()
    told = append_outcome(stored, new.dropDuplicates([id_col]), id_col, body)
    clash = [r[id_col] for r in told.filter("outcome = 'conflict'").select(id_col).limit(BAD_BODIES).collect()]
    if clash:
        raise Conflict(f"stored with other contents: {clash}")
    fresh = told.filter("outcome = 'added'").drop("outcome")
    before = stored.count()
    fresh.select(*stored.columns).write.mode("append").parquet(path)
    return spark.read.parquet(path).count() - before


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, written beside and renamed over the old one, whose mode it keeps: readers see either whole."""
    fs, p, jvm = _fs(spark, path)
    local = fs.getScheme() == "file"
    if local:  # renaming over a file is atomic in the raw file system; checksums beside it would be of the old one
        fs.delete(jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.crc"), False)
        fs = fs.getRawFileSystem()
    beside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if fs.exists(p):
            fs.setPermission(beside, fs.getFileStatus(p).getPermission())
        if local:
            if not fs.rename(beside, p):
                raise OSError(f"could not rename to {path}")
        else:
            rename = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
            how = spark.sparkContext._gateway.new_array(rename, 1)
            how[0] = rename.OVERWRITE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(beside, p, how)
    except Exception:
        fs.delete(beside, False)
        raise


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def build(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> str:
    """Write all tables into a new version and then point to it; a failure leaves the old one in place."""
    version = uuid.uuid4().hex
    try:
        for name, df in tables.items():
            df.write.parquet(f"{root}/{version}/{name}")
    except Exception:
        fs, p, _ = _fs(spark, f"{root}/{version}")
        fs.delete(p, True)
        raise
    write_text(spark, f"{root}/CURRENT", json.dumps({"version": version, "tables": sorted(tables)}))
    return version


def tables(spark: SparkSession, root: str) -> list[str]:
    """The names of the current version's tables."""
    return json.loads(read_text(spark, f"{root}/CURRENT"))["tables"]


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    version = json.loads(read_text(spark, f"{root}/CURRENT"))["version"]
    return spark.read.parquet(f"{root}/{version}/{name}")


def merge_map(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Two key-value tables, new values first; ordered by key."""
    both = old.select(key, value, F.lit(0).alias("_b")).unionByName(new.select(key, value, F.lit(1).alias("_b")))
    return both.groupBy(key).agg(F.max_by(value, "_b").alias(value)).orderBy(key)


def write_new_segments(spark: SparkSession, path: str, segments: DataFrame, id_col: str, book: str, force: bool = False, pages: tuple[int, int] | None = None, page: str = "page") -> None:
    """Segments by book; those stored stay unless ``force``, which replaces the books that occur.

    With ``pages`` (first and last) only what starts there is written and, by ``force``, replaced.
    """
    if pages:
        there = F.col(page).between(*pages)
        segments = segments.filter(there)
        if force:
            try:
                rest = spark.read.parquet(path)
                rest = rest.join(segments.select(book).distinct(), book, "left_semi").filter(~F.coalesce(there, F.lit(False)))
                segments = cut_lineage(segments.unionByName(rest.select(*segments.columns)))  # the books are read and replaced
            except AnalysisException as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
    if force:
        segments.write.option("partitionOverwriteMode", "dynamic").partitionBy(book).mode("overwrite").parquet(path)
        return
    try:
        stored = spark.read.parquet(path).select(id_col)
        segments = segments.join(stored, id_col, "left_anti")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    segments.write.partitionBy(book).mode("append").parquet(path)


def write_unmatched(spark: SparkSession, root: str, unmatched: DataFrame, source_books: DataFrame) -> str:
    """Unmatched corrections as JSON files by book, in a new version that readers see whole.

    Books in ``source_books`` show what is unmatched now, or nothing; those of other books stay as
    they were.  Returns the folder.
    """
    folder = f"{root}/{uuid.uuid4().hex}"
    try:
        stored = spark.read.schema(unmatched.schema).json(json.loads(read_text(spark, f"{root}/CURRENT"))["folder"])
        rows = unmatched.unionByName(stored.join(source_books.select("book_id").distinct(), "book_id", "left_anti"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = unmatched
    rows.write.partitionBy("book_id").json(folder)
    write_text(spark, f"{root}/CURRENT", json.dumps({"folder": folder}))
    return folder


def write_lines(lines: DataFrame, path: str) -> None:
    """A report's lines (part, key, line) as text, in order; one task sorts them, on disk if need be."""
    lines.repartition(1).sortWithinPartitions("part", "key", "line").select("line").write.mode("overwrite").text(path)


class LockTimeout(TimeoutError):
    """Another writer holds the book for too long."""


@contextmanager
def book_lock(spark: SparkSession, root: str, book: str, timeout: float = 30.0, poll: float = 0.05) -> Iterator[None]:
    """The only writer of a book's queue while the block runs; waits up to ``timeout`` seconds for it.

    A lock is a file that only one writer can make, in a local folder or on HDFS (object stores
    give no such promise).  A writer that dies leaves it behind; the error names the file.
    """
    fs, p, jvm = _fs(spark, f"{root}/.{book}.lock")
    fs.mkdirs(p.getParent())
    until = time.monotonic() + timeout
    while not _made_alone(fs, p):
        if time.monotonic() >= until:
            raise LockTimeout(f"{p} is held by another writer for over {timeout} s")
        time.sleep(poll)
    try:
        yield
    finally:
        fs.delete(p, False)


def _made_alone(fs, p) -> bool:
    if fs.getScheme() == "file":  # Hadoop's local file system looks first and makes then
        try:
            os.close(os.open(p.toUri().getPath(), os.O_CREAT | os.O_EXCL, 0o644))
        except FileExistsError:
            return False
        return True
    try:
        fs.create(p, False).close()
    except Exception as e:
        if "AlreadyExists" not in str(e) and "AlreadyBeingCreated" not in str(e):
            raise
        return False
    return True

"""What the training-data operators share: tables, written intermediate results, words."""

from __future__ import annotations

import json
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this subpackage travel to executors by value: they need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules["lectern.llm"])

#: A word, in a Java or Python pattern: a run of anything but space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: The same white space, as bytes.
SPACE_BYTES = b" \t\n\x0b\x0c\r"

_scratch: dict[str, str] = {}
#: Where :func:`recorded` notes the tables that are written.
_records: list[list[str]] = []
#: Keys that :func:`spread_join` splits, at most.
HOT_KEYS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; one of our own only in local mode, where it names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        _scratch[app] = "file://" + tempfile.mkdtemp(prefix="lectern-")
    return _scratch[app]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back.

    This cuts lineage: what reads the result survives lost executors, and values that are only
    fixed once made (row numbers) stay as they are.
    """
    path = f"{scratch_dir(df.sparkSession)}/lectern-{label}-{uuid.uuid4().hex}"
    for record in _records:
        record.append(path)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def forget(*written: DataFrame) -> None:
    """Delete tables that :func:`materialize` gave, when nothing lazy reads them any more."""
    for df in written:
        _delete(df.sparkSession, df._written_at)


def _delete(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of the tables that :func:`materialize` writes meanwhile."""
    made: list[str] = []
    _records.append(made)
    try:
        yield made
    finally:
        _records.pop(next(k for k, r in enumerate(_records) if r is made))


def drop_unread(spark: SparkSession, paths: list[str], reader: DataFrame) -> list[str]:
    """Delete the tables that ``reader`` does not read; those that stay."""
    read = {f.rpartition("/")[0].rpartition("/")[2] for f in reader.inputFiles()} if paths else set()
    stay = [p for p in paths if p.rpartition("/")[2] in read]
    for p in paths:
        if p not in stay:
            _delete(spark, p)
    return stay


def clean_scratch(spark: SparkSession, older_than_s: float = 0) -> int:
    """Delete this library's tables from the shared folder; how many.  Lazy results that read them must be done with."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    now = jvm.java.lang.System.currentTimeMillis()
    old = [s.getPath() for s in (fs.listStatus(top) if fs.exists(top) else []) if s.getPath().getName().startswith("lectern-") and now - s.getModificationTime() >= 1000 * older_than_s]
    return sum(fs.delete(p, True) for p in old)


def spread_join(rows: DataFrame, facts: DataFrame, key: str, count: str, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``facts``, which has one row a key and, as ``count``, the number of rows with it.

    A key with more than a ``HOT_KEYS``-th of all rows (and 1,000) is dealt to several groups: its
    fact is repeated for each.  There are at most ``HOT_KEYS`` such keys, whatever the data, so
    their table is broadcast.  Drops ``count``.
    """
    total = facts.agg(F.sum(count)).first()[0] or 0
    limit = max(1_000, -(-total // HOT_KEYS))
    parts = F.ceil(F.col(count) / limit).cast("int")
    hot = facts.filter(F.col(count) > limit).select(F.col(key).alias("_hot"), parts.alias("_parts"))  # at most HOT_KEYS rows
    if hot.isEmpty():
        return rows.join(facts.drop(count), key, how)
    dealt = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_part", F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(*rows.columns), F.col("_parts"))).otherwise(0).cast("int")).drop("_hot", "_parts")
    each = facts.withColumn("_part", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.when(F.col(count) > limit, parts).otherwise(1)) - 1))).drop(count)
    return dealt.join(each, [key, "_part"], how).drop("_part")


def local_table(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """A small table as an inline literal, without any RDD."""
    text = F.lit(json.dumps(rows))
    return spark.range(1).select(F.inline(F.from_json(text, f"array<struct<{ddl}>>")))


def shielded(docs: DataFrame, needed: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on ``docs`` with all columns but the needed ones under neutral names; then their own names again.

    Names are matched exactly and by position, so columns that clash with an operator's own, or
    with needed ones but for case, do no harm.  Columns that ``work`` adds are left out.
    """
    inner: list[str] = []
    for i, c in enumerate(docs.columns):
        inner.append(c if c in needed and c not in inner else f"_c{i}")
    return work(docs.toDF(*inner)).select(*inner).toDF(*docs.columns)


def pick(docs: DataFrame, *columns: str) -> DataFrame:
    """Only these columns, by exact name (the first of equal ones)."""
    wanted = list(dict.fromkeys(columns))
    inner: list[str] = []
    for i, c in enumerate(docs.columns):
        inner.append(c if c in wanted and c not in inner else f"_c{i}")
    return docs.toDF(*inner).select(*wanted)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n; a null id counts as remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0)).cast("int")

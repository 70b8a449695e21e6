"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors are turned by pseudo-rotations (three rounds of random signs and a fast Hadamard
transform) and hashed to the nearest signed axis of each of several cross-polytopes.  Every vector
is indexed in every table.  The first axis, or with very many vectors the first few, is its
bucket; a query probes the ``probes`` buckets (for each axis) nearest to it.  Inside a bucket only
vectors whose last axis is among the query's nearest are candidates.  How many axes these are
falls with the root of the rows in a bucket (see :func:`plan`), so that candidates grow slower than rows.
Candidates are reranked exactly, in double precision on the original vectors, where they lie:
only each query's best of a bucket leave it.

Equal vectors are one entry with its smallest ids, and equal query vectors one query, so copies
cost nothing and lose nothing.  Buckets that are large all the same are split (both sides) into
cells of at most about ``cell`` rows.

Defined results: rows whose id is null or whose vector is null, zero or has null or non-finite
components take no part, as queries or candidates; nor do vectors of another length than most
(the longer of ties).  Repeated rows count once.  Fewer candidates than ``k`` give fewer rows;
an empty table gives none.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lectern.llm.common import materialize, pick


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row, by butterflies."""
    n = x.shape[1]
    h = 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


class Hasher:
    """In each of ``tables``, the signed axes of ``axes`` polytopes that make a bucket, and of one more."""

    def __init__(self, dim: int, tables: int, axes: int, seed: int):
        self.width = 1 << max(1, int(dim - 1).bit_length())
        self.axes = axes
        rng = np.random.default_rng(seed)
        self.signs = rng.choice(np.array([-1.0, 1.0]), size=(tables, axes + 1, 3, self.width))

    def turned(self, x: np.ndarray) -> Iterator[list[np.ndarray]]:
        """For each table, the signed coordinates of rows on the axes of each polytope."""
        unit = x / np.linalg.norm(x / np.abs(x).max(axis=1, keepdims=True), axis=1, keepdims=True) / np.abs(x).max(axis=1, keepdims=True)
        padded = np.zeros((len(x), self.width))
        padded[:, : x.shape[1]] = unit
        for table in self.signs:
            out = []
            for rounds in table:
                y = padded
                for signs in rounds:
                    y = hadamard(y * signs)
                out.append(np.concatenate((y, -y), axis=1))
            yield out

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and last axis of each row, by table."""
        buckets, lasts = [], []
        for t, both in enumerate(self.turned(x)):
            at = np.full(len(x), t, dtype=np.int64)
            for y in both[:-1]:
                at = at * (2 * self.width) + np.argmax(y, axis=1)
            buckets.append(at)
            lasts.append(np.argmax(both[-1], axis=1))
        return np.stack(buckets, axis=1), np.stack(lasts, axis=1)

    def probed(self, x: np.ndarray, probes: int, last_axes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each table the buckets nearest to each row, by the squared distances lost on their axes, and the nearest last axes."""
        for t, both in enumerate(self.turned(x)):
            loss, at = np.zeros((len(x), 1)), np.full((len(x), 1), t, dtype=np.int64)
            for k, y in enumerate(both[:-1]):
                top = np.argsort(-y, axis=1, kind="stable")[:, : min(y.shape[1], 3 * probes if self.axes > 1 else probes)]
                value = np.take_along_axis(y, top, axis=1)
                sums = (loss[:, :, None] + (value[:, :1] - value)[:, None, :] ** 2).reshape(len(x), -1)
                keys = (at[:, :, None] * (2 * self.width) + top[:, None, :]).reshape(len(x), -1)
                best = np.argsort(sums, axis=1, kind="stable")[:, : probes**self.axes]
                loss, at = np.take_along_axis(sums, best, axis=1), np.take_along_axis(keys, best, axis=1)
            yield at, np.argsort(-both[-1], axis=1, kind="stable")[:, :last_axes]


def plan(rows: int, width: int, cell: int) -> tuple[int, int]:
    """(axes of a bucket, last axes looked up): buckets of ``cell`` rows at most on average; of their rows a share that falls with the root of their number."""
    axes = 1
    while rows > cell * (2 * width) ** axes:
        axes += 1
    inside = rows / (2 * width) ** (axes - 1)
    return axes, min(2 * width, max(8, int(np.ceil(2 * width * np.sqrt(32 * width / max(inside, 1))))))


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten()).astype(np.float64).reshape(-1, dim)


def valid(vector: Column) -> Column:
    """Not null, not zero, only finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def entries(rows: DataFrame, keep: int) -> DataFrame:
    """One row for each distinct vector: key, v, and its ``keep`` smallest ids."""
    keys = ["h1", "h2"]
    salted = W.partitionBy(*keys, F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    each = W.partitionBy(*keys).orderBy("id")
    few = rows.dropDuplicates(["id", *keys]).withColumn("_n", F.row_number().over(salted)).filter(F.col("_n") <= keep)
    few = few.withColumn("_n", F.row_number().over(each)).filter(F.col("_n") <= keep)
    return few.groupBy(*keys).agg(F.first("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids"))


def _search(nodes: DataFrame, asked: DataFrame, hasher: Hasher, dim: int, probes: int, last_axes: int, k: int, cell: int) -> DataFrame:
    """h1, h2, vec_id, score: the k + 1 nearest found of each distinct query vector, itself among them."""
    kind = nodes.schema["v"].dataType.simpleString()

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                bucket, last = hasher.nearest(matrix(part.column(1), dim))
                lists = [pa.array(list(x), pa.list_(t)) for x, t in ((bucket, pa.int64()), (last, pa.int32()))]
                yield pa.RecordBatch.from_arrays([*lists, *part.columns], ["buckets", "lasts", *part.schema.names])

    def probing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                for at_, lasts in hasher.probed(matrix(part.column(2), dim), probes, last_axes):
                    row = pa.array(np.repeat(np.arange(len(at_)), at_.shape[1]))
                    own = pa.array(list(lasts.astype(np.int32)), pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([pa.array(at_.ravel()), *(c.take(row) for c in (own, *part.columns))], ["bucket", "lasts", *part.schema.names])

    index = materialize(nodes.select("h2", "v", "ids").mapInArrow(indexed, f"buckets array<long>, lasts array<int>, h2 int, v {kind}, ids array<long>"), "ann-index")
    index = index.select(F.explode(F.arrays_zip("buckets", "lasts")).alias("b"), "h2", "v", "ids").select("b.buckets", "b.lasts", "h2", "v", "ids").toDF("bucket", "last", "h2", "v", "ids")
    asking = materialize(asked.mapInArrow(probing, f"bucket long, lasts array<int>, h1 long, h2 int, v {kind}"), "ann-probes")
    counts = index.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).join(asking.groupBy("bucket").agg(F.count(F.lit(1)).alias("q")), "bucket")
    hot = materialize(counts.filter((F.col("n") > cell) | (F.col("q") > cell)).select("bucket", F.ceil(F.col("n") / cell).cast("int").alias("rows"), F.ceil(F.col("q") / cell).cast("int").alias("cols")), "ann-cells")
    if hot.isEmpty():
        index, asking = (x.withColumns({"row": F.lit(0), "col": F.lit(0)}) for x in (index, asking))
    else:
        one = lambda c: F.coalesce(c, F.lit(1))
        all_of = lambda c: F.explode(F.sequence(F.lit(0), one(F.col(c)) - 1))
        index = index.join(hot, "bucket", "left").withColumn("row", F.pmod("h2", one(F.col("rows")))).withColumn("col", all_of("cols"))
        asking = asking.join(hot, "bucket", "left").withColumn("col", F.pmod("h2", one(F.col("cols")))).withColumn("row", all_of("rows"))

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        a, x = matrix(left["v"], dim), matrix(right["v"], dim)
        out = []
        if len(a) and len(x):
            na, nx = np.sqrt((a * a).sum(axis=1)), np.sqrt((x * x).sum(axis=1))
            unit, last = x / nx[:, None], np.asarray(right["last"])
            ids = right["ids"].to_pylist()
            least = np.array([i[0] for i in ids])
            lists = left["lasts"].combine_chunks()
            ends, wanted = np.asarray(lists.offsets), np.asarray(lists.values)
            h1, h2 = left["h1"].to_pylist(), left["h2"].to_pylist()
            for i in range(len(a)):
                there = np.zeros(2 * hasher.width, dtype=bool)
                there[wanted[ends[i] : ends[i + 1]]] = True
                near = np.flatnonzero(there[last])
                if len(near) > k + 1:
                    rough = unit[near] @ (a[i] / na[i])
                    near = near[rough >= np.partition(rough, -(k + 1))[-(k + 1)] - 1e-9]
                score = (x[near] * a[i]).sum(axis=1) / (na[i] * nx[near])
                for j in np.lexsort((least[near], -score))[: k + 1]:
                    out.append((h1[i], h2[i], float(score[j]), ids[near[j]]))
        cols = list(zip(*out)) or [[], [], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.float64(), pa.list_(pa.int64())))], ["h1", "h2", "score", "ids"])

    keys = ["bucket", "row", "col"]
    index = index.select(*keys, "last", "v", "ids")
    found = asking.select(*keys, "lasts", "h1", "h2", "v").groupBy(*keys).cogroup(index.groupBy(*keys)).applyInArrow(rerank, "h1 long, h2 int, score double, ids array<long>")
    found = found.select("h1", "h2", F.explode("ids").alias("vec_id"), "score").groupBy("h1", "h2", "vec_id").agg(F.max("score").alias("score"))
    best = W.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k + 1).drop("_n")


def nearest(vectors: DataFrame, queries: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, tables: int = 12, probes: int = 8, cell: int = 4096, seed: int = 42) -> DataFrame:
    """The ``k`` nearest rows found of each row that ``queries`` picks: a condition on the id and vector columns by name."""
    single = pick(vectors, vector_col).schema[vector_col].dataType.simpleString() == "array<float>"
    v = F.col(vector_col).cast("array<float>" if single else "array<double>")
    rows = pick(vectors, id_col, vector_col).select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & valid(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    spark = vectors.sparkSession
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = sizes[0]["dim"]
    rows = rows.filter(F.size("v") == dim).withColumns({"h1": F.xxhash64("v"), "h2": F.hash("v")})
    nodes = materialize(entries(rows, k + 1), "ann-vectors")
    asking = materialize(rows.filter("asks").select("id", "h1", "h2").distinct(), "ann-queries")
    asked = nodes.join(asking.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").select("h1", "h2", "v")
    axes, last_axes = plan(nodes.count(), 1 << max(1, int(dim - 1).bit_length()), cell)
    found = materialize(_search(nodes, asked, Hasher(dim, tables, axes, seed), dim, probes, last_axes, k, cell), "ann-found")
    # a query far from everything may miss: with fewer than k others, it probes every bucket of one table
    enough = found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > k).select("h1", "h2")
    short = materialize(asked.join(enough, ["h1", "h2"], "left_anti"), "ann-short")
    if not short.isEmpty():
        all_ = Hasher(dim, 1, 1, seed)
        more = _search(nodes, short, all_, dim, 2 * all_.width, 2 * all_.width, k, cell)
        found = found.join(short.select("h1", "h2"), ["h1", "h2"], "left_anti").unionByName(more)
    out = asking.join(found, ["h1", "h2"]).filter("vec_id != id")
    mine = W.partitionBy("id").orderBy(F.desc("score"), "vec_id")
    out = out.groupBy("id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(mine)).filter(F.col("rank") <= k)
    return out.select(F.col("id").alias("query_id"), "rank", "vec_id", "score")

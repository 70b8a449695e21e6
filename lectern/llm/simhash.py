"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has 64 bits; each is the majority of that bit over the hashes of its
shingles.  Fingerprints link at ``distance`` or fewer differing bits.  The fingerprint is cut into
``segments``, each with a table of its own: segment value to fingerprints.  Two linked fingerprints
differ by at most ``distance // segments`` bits in some segment, so the Hamming ball of that
radius around each segment value is enumerated, the tables are asked for its members, and
complete distances to what they hold are verified.  Of two values in each other's ball only the
smaller asks, so a pair meets once in a segment.  Buckets with answers to many are cut again: the
bits outside the segment make two tables in the same way, so that no bucket can hold more than
the fingerprints that share a segment and half of the rest.  A large bucket gives the links of a
spanning forest of its members instead of all pairs.

Equal fingerprints are one node, however many documents share them.  Components are found by
alternating large-star and small-star rounds over links between different fingerprints, each
round written to the shared folder; the joins of a round are plain equi-joins that Spark splits
where a hub is hot.  Nothing but round counters reaches the driver.

Defined results: null, empty and blank texts have fingerprint zero and link like any other; a
component's id is its smallest non-null document id (null if it has none); repeated rows share a
component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lectern.llm.common import materialize, pick, shielded, spread_join

#: Rows of a bucket up to which every verified pair is told; larger ones tell a spanning forest.
SMALL = 32


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """As a signed 64-bit integer."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        return int(np.array(xxhash.xxh64_intdigest(b" ".join(words), seed), dtype=np.uint64).view(np.int64))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist())), dtype=np.uint64, count=len(starts)))


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of a text's shingle hashes (unsigned), as a signed integer; zero without any."""
    votes = np.zeros(64, dtype=np.int64)
    h = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(h), 16384):
        votes += np.unpackbits(h[at : at + 16384], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, *, text_col: str = "text", keep: list[str], shingle: int = 3, seed: int = 42) -> DataFrame:
    """Columns ``keep`` of every row, and ``fp``."""
    rows = pick(docs, *keep, text_col).select(*keep, F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
            made = np.fromiter((fingerprint(t, shingle, seed) for t in texts), dtype=np.int64, count=len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made)], [*keep, "fp"])

    fields = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in keep)
    return rows.mapInArrow(run, f"{fields}fp long")


def layout(bits: int, segments: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment, as even as can be."""
    widths = [bits // segments + (k < bits % segments) for k in range(segments)]
    return [(sum(widths[:k]), w) for k, w in enumerate(widths)]


def ball(width: int, radius: int) -> np.ndarray:
    """The masks of at most ``radius`` of ``width`` bits, none first."""
    masks = [sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(range(width), r)]
    return np.array(masks, dtype=np.uint64)


def asked(values: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, value, asks) of the table entries of segment values: their own, and the larger ones in their ball, which they ask for."""
    near = values[:, None] ^ masks
    row, mask = np.nonzero(near >= values[:, None])
    return row, near[row, mask], mask > 0


def _tables(fps: DataFrame, segments: int, distance: int) -> DataFrame:
    """(key, asks, fp): a key is a segment's number and value."""
    parts = layout(64, segments)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(0))
            for at in range(0, len(x), 1000):
                part = x[at : at + 1000]
                for number, (shift, width) in enumerate(parts):
                    row, value, asks = asked(_bits(part.view(np.uint64), shift, width), ball(width, distance // segments))
                    yield pa.RecordBatch.from_arrays([pa.array(_key(number, value, parts).view(np.int64)), pa.array(asks), pa.array(part[row])], ["key", "asks", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, asks boolean, fp long")


def _bits(x: np.ndarray, shift: int, width: int) -> np.ndarray:
    return (x >> np.uint64(shift)) & np.uint64((1 << width) - 1)


def _key(number: int, value: np.ndarray, parts: list[tuple[int, int]]) -> np.ndarray:
    return value if len(parts) == 1 else value | np.uint64(number << parts[0][1])


def _hot(table: DataFrame, segments: int, distance: int, cell: int) -> DataFrame:
    """The keys whose buckets may hold more than ``cell`` rows beyond a like number from small values.

    All rows of a key come from the values in its ball; if no value there has more than
    ``cell`` / (size of the ball) fingerprints, the bucket is no larger than ``cell``.
    """
    parts = layout(64, segments)
    of = len(ball(parts[0][1], distance // segments))
    large = table.filter("NOT asks").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell // of)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n = np.asarray(batch.column(0)).view(np.uint64), np.asarray(batch.column(1))
            for number, (shift, width) in enumerate(parts):
                mine = (key >> np.uint64(parts[0][1])) == number if len(parts) > 1 else np.ones(len(key), dtype=bool)
                near = key[mine][:, None] ^ ball(width, distance // segments)
                yield pa.RecordBatch.from_arrays([pa.array(near.ravel().view(np.int64)), pa.array(np.repeat(n[mine], near.shape[1]))], ["key", "n"])

    return large.mapInArrow(spread, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") > cell).select("key", F.lit(True).alias("hot"))


def _cut_again(table: DataFrame, segments: int, distance: int) -> DataFrame:
    """(key, part, asks, fp) of rows (key, asks, fp, hot): hot buckets by two tables over the bits outside the segment."""
    parts = layout(64, segments)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "part", "asks", "fp"]
        for batch in batches:
            key, fp = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            hot = batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            cold = pa.array(~hot)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(cold), pa.array(np.full((~hot).sum(), -1)), batch.column(1).filter(cold), batch.column(2).filter(cold)], names)
            for number, (shift, width) in enumerate(parts):
                mine = np.flatnonzero(hot & (key.view(np.uint64) >> np.uint64(parts[0][1]) == number))
                x = fp[mine].view(np.uint64)
                rest = _bits(x, 0, shift) | (x >> np.uint64(shift + width) << np.uint64(shift) if shift + width < 64 else np.uint64(0))
                for half, (at, wide) in enumerate(layout(64 - width, 2)):
                    row, value, asks = asked(_bits(rest, at, wide), ball(wide, distance // 2))
                    yield pa.RecordBatch.from_arrays([pa.array(key[mine][row]), pa.array((value | np.uint64(half << 48)).view(np.int64)), pa.array(asks), pa.array(fp[mine][row])], names)

    return table.mapInArrow(run, "key long, part long, asks boolean, fp long")


def bucket_links(start: np.ndarray, asks: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of whole buckets, whose rows come together, those that ask last.

    ``start`` holds the row at which each bucket begins.
    """
    size = np.diff(np.append(start, len(fp)))
    a, b = [], []
    few = (size > 1) & (size <= SMALL)
    low = np.repeat(np.where(few, start, len(fp)), size)  # nothing lies before a row of other buckets
    live = np.arange(len(fp))
    for back in range(1, int(size[few].max(initial=1))):
        live = live[live - back >= low[live]]
        other = live - back
        near = ~asks[other] & (np.bitwise_count((fp[live] ^ fp[other]).view(np.uint64)) <= distance)
        a.append(fp[live[near]])
        b.append(fp[other[near]])
    for k in np.flatnonzero(size > SMALL).tolist():
        x = fp[start[k] : start[k] + size[k]]
        home = int((~asks[start[k] : start[k] + size[k]]).sum())
        tree = np.arange(len(x))  # of each row the number of its tree
        for i in range(home):
            near = np.flatnonzero(np.bitwise_count((x[i + 1 :] ^ x[i]).view(np.uint64)) <= distance) + i + 1
            _, first = np.unique(tree[near], return_index=True)
            fresh = near[first][tree[near[first]] != tree[i]]
            if len(fresh):
                a.append(x[fresh])
                b.append(np.full(len(fresh), x[i]))
                tree[np.isin(tree, tree[fresh])] = tree[i]
    a, b = (np.concatenate(c) if c else np.zeros(0, dtype=np.int64) for c in (a, b))
    real = a != b
    return np.maximum(a, b)[real], np.minimum(a, b)[real]


def links(fps: DataFrame, *, distance: int = 2, segments: int = 2, cell: int = 4096) -> DataFrame:
    """Links ``a`` > ``b`` between distinct fingerprints (column ``fp``), enough of them to have every component whole."""
    table = _tables(fps, segments, distance)
    hot = materialize(_hot(table, segments, distance, cell), "hot-segments") if segments > 1 else None
    if hot is None or hot.isEmpty():
        cut = table.select("key", F.lit(-1).cast("long").alias("part"), "asks", "fp")
    else:
        cut = _cut_again(table.join(hot, "key", "left").select("key", "asks", "fp", "hot"), segments, distance)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted; the last bucket waits for the next batch (one row is enough if it has none to ask)."""
        held = None
        for batch in batches:
            rows = [np.asarray(c) for c in batch.columns[:2]] + [batch.column(2).to_numpy(zero_copy_only=False), np.asarray(batch.column(3))]
            if not batch.num_rows:
                continue
            if held is not None:
                rows = [np.concatenate((h, c)) for h, c in zip(held, rows)]
            key, part, asks, fp = rows
            start = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1))
            last = start[-1]
            held = [c[last : last + 1] if asks[last] else c[last:] for c in rows]
            a, b = bucket_links(start[:-1], asks[:last], fp[:last], distance)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
        if held is not None:
            a, b = bucket_links(np.zeros(1, dtype=np.int64), held[2], held[3], distance)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    dealt = cut.repartition("key", "part").sortWithinPartitions("key", "part", "asks", "fp")
    return dealt.mapInArrow(verify, "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) of every node with a link that is not its component's smallest node, the root."""
    edges, mark = _written(edges)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).withColumn("m", F.least("u", "m"))
        # large star: larger neighbours move to the smallest neighbour
        large = both.filter("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: smaller neighbours and the node itself move to the smallest
        down = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        moved = large.join(down, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        edges, now = _written(moved.union(down.select("u", "m")).distinct())
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _written(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    seen = Observation()
    out = materialize(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")), "links")
    return out, (seen.get["n"], seen.get["x"])


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, shingle: int = 3, distance: int = 2, segments: int = 2) -> DataFrame:
    """Per row: ``keep`` columns, ``fp``, ``root`` (the component's smallest fingerprint), ``component_id``."""
    keep = keep or [id_col]
    rows = materialize(with_fingerprints(docs, text_col=text_col, keep=keep, shingle=shingle), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min(id_col).alias("_first"), F.count(F.lit(1)).alias("_n")), "nodes")
    roots = components(links(nodes, distance=distance, segments=segments))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "_n", "_first", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("_first").alias("component_id"))
    known = rooted.join(ids, "root").select("fp", "_n", "root", "component_id")
    return spread_join(rows, known, "fp", "_n").select(*keep, "fp", "root", "component_id")


def hex16(fp) -> object:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Rows of ``docs`` of which one for each component stays: its smallest id (ties: first row)."""
    return shielded(docs, [id_col, text_col], lambda d: _one_of_each(d, id_col, text_col, how))


def _one_of_each(docs: DataFrame, id_col: str, text_col: str, how: dict) -> DataFrame:
    numbered = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "simhash-docs")
    found = near_duplicates(numbered, id_col=id_col, text_col=text_col, keep=[id_col, "_row"], **how)
    order = F.struct(F.col(id_col).isNull(), id_col, "_row")
    best = found.groupBy("root").agg(F.min_by("_row", order).alias("_row"))
    return numbered.join(best.select("_row"), "_row", "left_semi").select(*docs.columns)

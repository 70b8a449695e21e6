"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source's documents are dealt by hash into blocks, which is a random permutation cut into
disjoint blocks.  A source gets a target of words: a number of whole passes over it plus a rest.
The rest takes blocks from the front of the permutation; of the block on the edge it takes single
documents, the last of them in part, so that the words taken are the target to within a word.
The block copies are exact integer quotas.  A splitting tree hands them to output shards: at each
node the quotas of all sources split between the left and the right half of the shards by one
multivariate-hypergeometric draw.  The tree works on (source, shard) counts only; documents find
their block and shard by hash and join, and are shuffled inside a shard by another hash.

Only DataFrame operations touch documents.  The driver holds one row per source (their number is
checked against ``max_sources``) and the shard quotas (at most ``MAX_QUOTAS`` integers).  Shards
grow in number with the words that the mix takes, as far as that bound lets them.

Defined results: a null or empty text has size 0 and takes 0 words; a null source is a source of
its own, after all others; rows that repeat are separate rows and may be taken each; a null id is
an id like any other; an empty table gives an empty mix; other columns are ignored by the plan
and kept by :func:`mixed_documents`.  The same rows and seed give the same mix.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lectern.llm.common import WORD, local_table, materialize, pick, word_count

#: Blocks of this many blocks are summed first, so that no prefix sum runs over a whole source.
SUPER = 1024
#: Words that a shard is to hold, the least number of shards, and the most (source, shard) quotas.
SHARD_WORDS, LEAST_SHARDS, MAX_QUOTAS = 20_000_000, 64, 400_000


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, cap: float) -> list[float]:
    """Split ``share`` of all sizes by weight; stop at ``cap`` sizes and share the excess anew."""
    goal = share * sum(sizes)
    out: list[float | None] = [None] * len(sizes)
    while open_ := [i for i, t in enumerate(out) if t is None]:
        left = goal - sum(t for t in out if t is not None)
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > cap * sizes[i]]
        for i in over or open_:
            out[i] = cap * sizes[i] if over else left * weights[i] / weight
    return [float(t) for t in out if t is not None]


def split_tree(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Integer quotas of shape (shards, sources): columns sum to ``quotas``, rows are level."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    todo = [(0, shards, np.asarray(quotas, dtype=np.int64))]
    while todo:
        low, high, counts = todo.pop()
        if high - low == 1:
            out[low] = counts
            continue
        mid = (low + high) // 2
        take = int(counts.sum()) * (mid - low) // (high - low)
        left = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(counts, take, method="marginals")
        todo += [(low, mid, left), (mid, high, counts - left)]
    return out


def mix_plan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    shards: int | None = None,
    block_docs: int = 256,
    seed: int = 42,
    max_sources: int = 100_000,
) -> DataFrame:
    """One row per document row: id, source, size, source_size, target, taken, placements.

    ``weights`` repeat over the sources in code point order.  ``placements`` lists where the
    document goes: shard, epoch and words (fewer than ``size`` for a source's last document only).
    """
    sized = materialize(
        pick(docs, id_col, text_col, source_col).select(
            F.col(id_col).alias("id"),
            F.col(source_col).cast("string").alias("src"),
            word_count(F.col(text_col)).alias("size"),
            F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(F.col(text_col))).alias("h"),
        ),
        "mix",
    )
    return _plan(sized, ["id"], weights, share, cap, shards, block_docs, seed, max_sources)[0].withColumnRenamed("id", id_col)


def _plan(sized: DataFrame, ids: list[str], weights, share, cap, shards, block_docs, seed, max_sources) -> tuple[DataFrame, int]:
    """The plan, and the number of shards."""
    spark = sized.sparkSession
    per_source = sized.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s")).limit(max_sources + 1).collect()
    if len(per_source) > max_sources:
        raise ValueError(f"more than {max_sources} sources; raise max_sources knowingly")
    per_source.sort(key=lambda r: (r.src is None, r.src or ""))
    sizes = [int(r.s) for r in per_source]
    goals = targets(sizes, [float(weights[i % len(weights)]) for i in range(len(sizes))], share, cap)
    table = []
    for i, (r, size, goal) in enumerate(zip(per_source, sizes, goals)):
        words = round(goal)
        full = words // size if size else 0
        table.append({"src": r.src, "ix": i, "source_size": size, "target": goal, "blocks": max(1, -(-r.n // block_docs)), "full": full, "rest": words - full * size})
    ddl = "src string, ix int, source_size bigint, target double, blocks bigint, full int, rest bigint"
    sources = F.broadcast(local_table(spark, table, ddl))  # at most max_sources rows

    d = sized.join(sources.withColumnRenamed("src", "src_"), F.col("src").eqNullSafe(F.col("src_")), "inner").drop("src_")
    d = d.withColumn("block", F.pmod("h", "blocks")).withColumn("super", F.expr(f"block div {SUPER}"))

    totals = materialize(d.groupBy("ix", "super", "block", "rest").agg(F.sum("size").alias("words")), "mix-blocks")
    before = lambda *keys: W.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(W.unboundedPreceding, -1)
    supers = totals.groupBy("ix", "super").agg(F.sum("words").alias("words"))
    supers = supers.select("ix", "super", F.coalesce(F.sum("words").over(before("ix", "super")), F.lit(0)).alias("base"))
    blocks = totals.join(supers, ["ix", "super"]).select(
        "ix", "block", "rest", (F.col("base") + F.coalesce(F.sum("words").over(before("ix", "super", "block")), F.lit(0))).alias("start")
    )
    edge = {r.ix: r.q for r in blocks.filter("start < rest").groupBy("ix").agg((F.max("block") + 1).alias("q")).collect()}
    quotas = [t["full"] * t["blocks"] + edge.get(t["ix"], 0) for t in table]
    if shards is None:
        shards = max(1, min(max(LEAST_SHARDS, round(sum(goals)) // SHARD_WORDS), MAX_QUOTAS // max(1, len(table))))
    bounds = np.cumsum(split_tree(quotas, shards, seed), axis=0) if table else np.zeros((shards, 0), dtype=np.int64)
    runs = []
    for t in table:
        highs = bounds[:, t["ix"]].tolist()
        runs += [{"ix": t["ix"], "all": t["blocks"], "shard": k, "low": low, "high": high} for k, (low, high) in enumerate(zip([0, *highs], highs)) if low < high]
    copies = local_table(spark, runs, "ix int, all bigint, shard int, low bigint, high bigint").select("ix", "all", "shard", F.explode(F.sequence("low", F.col("high") - 1)).alias("copy"))
    dealt = copies.groupBy("ix", F.pmod("copy", "all").alias("block")).agg(F.array_sort(F.collect_list(F.struct(F.expr("copy div all").alias("epoch"), "shard"))).alias("copies"))
    blocks = blocks.join(dealt, ["ix", "block"], "left").select("ix", "block", "start", F.transform("copies", lambda c: c["shard"]).alias("shard_of"))

    inside = W.partitionBy("ix", "block").orderBy(F.xxhash64(F.lit(seed + 1), "h"), *ids, "size").rowsBetween(W.unboundedPreceding, -1)
    # what has no words is not dealt: such rows may be alike in great number
    none = d.filter("size = 0").withColumns({"start": F.lit(0).cast("long"), "shard_of": F.array().cast("array<int>"), "at": F.lit(0).cast("long")})
    d = d.filter("size > 0").join(blocks, ["ix", "block"]).withColumn("at", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))).unionByName(none)
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - F.col("at")))
    words = lambda e: F.when(e < F.col("full"), F.col("size")).otherwise(F.col("part"))
    d = d.withColumn("part", part).withColumn("taken", F.col("full") * F.col("size") + F.col("part"))
    placed = F.transform(F.sequence(F.lit(0), F.col("full")), lambda e: F.struct(F.get("shard_of", e).alias("shard"), e.alias("epoch"), words(e).alias("words")))
    return d.select(*ids, F.col("src").alias("source"), "size", "source_size", "target", "taken", F.filter(placed, lambda p: p["words"] > 0).alias("placements")), shards


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 42, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, shards: int | None = None, block_docs: int = 256, max_sources: int = 100_000, shard_columns: bool = False) -> DataFrame:
    """The mix itself: a row of ``docs`` for every placement, in shards, each shuffled.

    A shard's rows are one partition, in the order of the shuffle, so that files written from the
    result are whole shards.  A document that is taken in part keeps its first
    words, with the white space before them; ``n_chars``, where there is one, follows.  With
    ``shard_columns``, ``_shard`` and ``_order`` come as the last two columns, whatever other
    columns are called.
    """
    needed = [id_col, text_col, source_col, "n_chars"]
    inner: list[str] = []
    for i, c in enumerate(docs.columns):
        inner.append(c if c in needed and c not in inner else f"_c{i}")
    out = _mixed(docs.toDF(*inner), id_col, text_col, source_col, seed, weights, share, cap, shards, block_docs, max_sources)
    return out.toDF(*docs.columns, "_shard", "_order") if shard_columns else out.select(*inner).toDF(*docs.columns)


def _mixed(docs: DataFrame, id_col, text_col, source_col, seed, weights, share, cap, shards, block_docs, max_sources) -> DataFrame:
    """Columns of ``docs``, then the shard and the place in its order."""
    docs_ = materialize(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "mix-docs")
    sized = docs_.select(
        F.col("_mix_row").alias("_row"),
        F.col(source_col).cast("string").alias("src"),
        word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(F.col(text_col))).alias("h"),
    )
    plan, shards = _plan(materialize(sized, "mix"), ["_row"], weights, share, cap, shards, block_docs, seed, max_sources)
    plan = plan.select(F.col("_row").alias("_mix_row"), F.col("size").alias("_mix_size"), F.inline("placements").alias("_mix_shard", "_mix_epoch", "_mix_words"))
    out = docs_.join(plan, "_mix_row")
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(text_col), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)), 1, F.col("_mix_words").cast("int")), "")
    partial = F.col("_mix_words") < F.col("_mix_size")
    changed = {text_col: F.when(partial, cut).otherwise(F.col(text_col))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(partial, F.length(cut)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    order = F.xxhash64(F.lit(seed + 2), F.col(id_col), F.xxhash64(F.col(text_col)), "_mix_epoch").alias("_mix_order")
    placed = out.withColumns(changed).select(*docs.columns, "_mix_shard", order)
    return placed.repartitionById(shards, F.col("_mix_shard")).sortWithinPartitions("_mix_shard", "_mix_order")

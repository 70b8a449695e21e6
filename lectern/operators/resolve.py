"""Which of several records counts: latest, authority, overrides, pointer chains."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster shares (spark.checkpoint.dir); a local one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not named and (not master.startswith("local") or master.startswith("local-cluster")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return named or "file://" + tempfile.gettempdir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write into the folder the cluster shares and read back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/lectern-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def latest_wins(records: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """Adds ``canonical`` and ``variant_of`` (the group's winner; null on the winner itself)."""
    id_col = order[-1]
    w = W.partitionBy(*group).orderBy(*order)
    first = F.first(id_col).over(w)
    rank = F.row_number().over(w)
    return records.withColumns({"canonical": rank == 1, "variant_of": F.when(rank > 1, first)})


def authority_wins(records: DataFrame, topic: str, book: str, authority: str, id_col: str) -> DataFrame:
    """Where the authority book has a topic, its lowest id demotes every other book's records.

    Records without a topic, and those of the authority itself, take no part in the join.
    """
    chiefs = records.filter((F.col(book) == authority) & F.col(topic).isNotNull()).groupBy(F.col(topic).alias("_topic")).agg(F.min(id_col).alias("_chief"))
    may_lose = F.col(topic).isNotNull() & ~F.col(book).eqNullSafe(F.lit(authority))
    told = lambda rows: rows.withColumns({"canonical": F.col("_chief").isNull(), "variant_of": F.col("_chief")}).drop("_chief", "_topic")
    others = records.filter(may_lose).join(chiefs, F.col(topic) == F.col("_topic"), "left")
    alone = records.filter(~may_lose).withColumn("_chief", F.lit(None).cast(records.schema[id_col].dataType))
    return told(others).unionByName(told(alone))


def flatten_pointers(records: DataFrame, id_col: str, pointer: str, max_rounds: int = 40) -> DataFrame:
    """(id, root): chains followed to their end by pointer doubling.

    A pointer to a missing record ends at its holder; the members of a cycle keep their own ids.
    Chains of up to 2**``max_rounds`` records end; longer ones are an error.
    """
    at = records.select(F.col(id_col).alias("id"), F.col(pointer).alias("to"))
    there = at.select(F.col("id").alias("t"))
    # only linked records take part in the rounds; the others are their own roots
    linked = at.filter("to IS NOT NULL").join(there, F.col("to") == F.col("t"), "left_semi")
    live, before = cut_lineage(linked.select("id", "to")), None
    for _ in range(max_rounds):
        ahead = live.select(F.col("id").alias("t"), F.col("to").alias("next"))
        step = cut_lineage(live.join(ahead, F.col("to") == F.col("t"), "left").select("id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")))
        moved = step.filter("moved").count()
        if moved == before:
            # doubling reaches the end of some chain in each round; what still moves is on a cycle or leads into one
            live = step.filter("NOT moved")
            break
        live, before = step.select("id", "to"), moved
        if not moved:
            break
    else:
        raise RuntimeError(f"pointer chains did not end in {max_rounds} rounds")
    return at.select("id").join(live, "id", "left").select("id", F.coalesce("to", "id").alias("root"))


def closure(edges: DataFrame, seeds: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(seed, id) of every record reachable from a seed over ``src``-``dst`` links, the seed excluded; safe on cycles.

    Links go both ways, so what a seed reaches is its component.  Components shrink to their
    smallest member in rounds that grow with the logarithm of their size (large star, small star).
    """
    edges = edges.filter("src IS NOT NULL AND dst IS NOT NULL AND src != dst")
    live, mark = _star_links(edges.select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).distinct())
    for _ in range(max_rounds):
        both = live.union(live.select("b", "a"))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        moved = large.join(down, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        live, now = _star_links(moved.union(down.select("u", "m")).distinct())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"closure did not settle in {max_rounds} rounds")
    members = live.select(F.col("a").alias("id"), F.col("b").alias("root")).union(live.select("b", "b").distinct())
    found = seeds.select(F.col("id").alias("seed")).distinct().join(members.select(F.col("id").alias("seed"), "root"), "seed")
    return found.join(members, "root").filter("seed != id").select("seed", "id")


def _star_links(links: DataFrame) -> tuple[DataFrame, tuple]:
    out = cut_lineage(links)
    return out, tuple(out.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def ordered_list(owners: DataFrame, owner_id: str, ids: str, things: DataFrame, thing_id: str, show: Column, pending: Column) -> DataFrame:
    """Ids resolved in list order; a missing one becomes ``pending`` (null drops it)."""
    each = owners.select(owner_id, F.posexplode_outer(ids).alias("_pos", "_ref"))
    found = each.join(things.select(F.col(thing_id).alias("_ref"), show.alias("_show")), "_ref", "left")
    found = found.withColumn("_show", F.coalesce("_show", pending))
    list_ = F.array_sort(F.collect_list(F.when(F.col("_show").isNotNull() & F.col("_pos").isNotNull(), F.struct("_pos", "_show"))))
    return found.groupBy(owner_id).agg(F.transform(list_, lambda x: x["_show"]).alias("resolved"))


def dangling(children: DataFrame, parent: str, parents: DataFrame, parent_id: str) -> DataFrame:
    """Children whose non-blank parent id is not there."""
    asked = children.filter(F.trim(F.col(parent).cast("string")) != "")
    return asked.join(parents.select(F.col(parent_id).alias(parent)).distinct(), parent, "left_anti")


def first_stage_match(entries: DataFrame, entry_id: str, stages: list[DataFrame]) -> DataFrame:
    """(entry, stage, target): each entry's targets in the first stage that has any.

    A stage is (entry_id, target).  A stage after the first counts only if it is unambiguous; an
    ambiguous one stops the chain, leaving the entry unmatched.
    """
    tagged = None
    for k, s in enumerate(stages):
        s = s.select(F.col(entry_id), F.lit(k + 1).alias("stage"), "target").distinct()
        tagged = s if tagged is None else tagged.union(s)
    per = tagged.groupBy(entry_id, "stage").agg(F.count(F.lit(1)).alias("hits"))
    first = per.groupBy(entry_id).agg(F.min_by(F.struct("stage", "hits"), "stage").alias("f"))
    won = first.filter((F.col("f.stage") == 1) | (F.col("f.hits") == 1)).select(entry_id, F.col("f.stage").alias("stage"))
    matched = tagged.join(won, [entry_id, "stage"])
    return entries.select(entry_id).join(matched, entry_id, "left")


def merge_lists(members: DataFrame, group: str, order: str, values: str) -> DataFrame:
    """Per group, the members' lists joined in order, later repeats dropped."""
    lists = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(values).alias("v")))), lambda x: x["v"])
    return members.groupBy(group).agg(F.array_distinct(F.flatten(lists)).alias("merged"))

"""Structured Streaming: windowed aggregates with watermarks, and the work queue's ladder as a keyed state machine."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lectern.operators.resolve import shared_folder
from lectern.operators.workqueue import TIERS


# The state machine travels to executors by value: it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/lectern-{label}-{uuid.uuid4().hex}"


def file_events(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stream over the files of one table; event times as timestamps."""
    schema = spark.read.parquet(f"{folder}/{name}").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name).option("maxFilesPerTrigger", 100).parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str, late: str, slide: str | None = None) -> DataFrame:
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    counts = events.withWatermark("ts", late).groupBy(window.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))
    return counts.select(F.col("w.start").alias("start"), "event_type", "n", "top")


def sessions(events: DataFrame, gap: str, late: str) -> DataFrame:
    made = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return made.select(F.col("s.start").alias("start"), F.col("s.end").alias("end"), "user_id", "n")


def run_once(stream: DataFrame, label: str, mode: str = "complete") -> DataFrame:
    """Run over all that is there, and give what the batches wrote: the last one, in complete mode.

    Every batch has a folder of its own, which a repeated batch overwrites.
    """
    spark = stream.sparkSession
    out, log = shared_path(spark, label), shared_path(spark, label + "-log")
    schema, last = stream.schema, {}

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch-{number:09d}")
        last["at"] = number

    q = stream.writeStream.outputMode(mode).option("checkpointLocation", log).foreachBatch(write).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(schema).parquet(f"{out}/batch-{last['at']:09d}" if mode == "complete" and last else f"{out}/batch-*")


STATE = "tier int, status string, last_tier int, last_kind string, last_error string, asked boolean, logged int"
OUT = "user_id bigint, tier int, status string, logged int"


def step(state: tuple, attempt: tuple) -> tuple:
    """The batch operator's rule for one attempt (tier, kind, error)."""
    tier, status, last_tier, last_kind, last_error, asked, logged = state
    wanted, kind, error = attempt
    at = wanted or tier
    if status == "exhausted" or (kind == "validation" and (last_tier, last_kind, last_error) == (at, kind, error)):
        return state
    done = (at, kind, error)
    if at != tier:
        return (tier, status, *done, asked, logged + 1)
    if kind == "needs_context" and not asked:
        return (tier, status, *done, True, logged + 1)
    return (min(tier + 1, TIERS), status if tier < TIERS else "exhausted", *done, False, logged + 1)


def ladder(attempts: DataFrame, forget_after_ms: int | None = None) -> DataFrame:
    """Each user's state after every batch with attempts of theirs.

    With ``forget_after_ms`` untouched states time out; such a stream never runs dry, so it is not
    for a run over what is there.
    """

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = state.get if state.exists else (1, "pending", 0, "", "", False, 0)
        rows = pd.concat(list(parts)).sort_values(["ts", "event_id"])
        for attempt in zip(rows["tier"], rows["kind"], rows["error"]):
            now = step(tuple(now), tuple(attempt))
        state.update(tuple(now))
        if forget_after_ms:
            state.setTimeoutDuration(forget_after_ms)
        yield pd.DataFrame([(key[0], now[0], now[1], now[6])], columns=["user_id", "tier", "status", "logged"])

    timeout = GroupStateTimeout.ProcessingTimeTimeout if forget_after_ms else GroupStateTimeout.NoTimeout
    return attempts.groupBy("user_id").applyInPandasWithState(run, OUT, STATE, "update", timeout)

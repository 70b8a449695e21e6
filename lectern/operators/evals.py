"""Scoring candidate records against an inventory of cases, with evidence spans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import jsons


def match_candidates(cases: DataFrame, candidates: DataFrame, case_id: str = "case_id") -> tuple[DataFrame, DataFrame]:
    """Each case with its candidate, if exactly one names it; and counts of extra and duplicate candidates.

    Missing and ambiguous cases stay in the result, without a candidate.
    """
    counted = candidates.groupBy(case_id).agg(F.count(F.lit(1)).alias("copies"))
    known = counted.join(cases.select(case_id, F.lit(True).alias("known")), case_id, "left")
    totals = known.agg(F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("copies"))), F.lit(0)).alias("extra"), F.coalesce(F.sum(F.when(F.col("known"), F.col("copies") - 1)), F.lit(0)).alias("duplicates"))
    single = candidates.join(counted.filter("copies = 1").select(case_id), case_id, "left_semi").withColumn("found", F.lit(True))
    return cases.join(single, case_id, "left").withColumn("found", F.coalesce("found", F.lit(False))), totals


def field_scores(matched: DataFrame, fields: dict[str, str], case_id: str = "case_id") -> DataFrame:
    """Per case: assertions, those right, and whether all are; ``fields`` maps expected to given columns."""
    right = [F.coalesce(F.col(a) == F.col(b), F.lit(False)).cast("int") for a, b in fields.items()]
    n = F.lit(len(fields))
    total = right[0]
    for r in right[1:]:
        total = total + r
    return matched.select(case_id, "found", n.alias("assertions"), total.alias("correct"), (total == n).alias("passed"))


def evidence(spans: DataFrame, blocks: DataFrame, block_id: str, text_col: str) -> DataFrame:
    """``valid``: the block is there, 0 <= start < end <= length, and the slice is the quote (code points)."""
    joined = spans.join(blocks.select(F.col(block_id).alias("block"), F.col(text_col).alias("_text")), "block", "left")
    ok = (F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.length("_text")) & (F.substring("_text", F.col("start") + 1, F.col("end") - F.col("start")) == F.col("quote"))
    return joined.withColumn("valid", F.coalesce(ok, F.lit(False))).drop("_text")


def summary(scores: DataFrame, totals: DataFrame, reviewed: bool) -> DataFrame:
    """One row of counters and the release gate; both inputs are reduced to one row first."""
    one = scores.agg(
        F.count(F.lit(1)).alias("cases"),
        F.count_if("found").alias("found"),
        F.count_if(~F.col("found")).alias("missing"),
        F.sum("assertions").alias("assertions"),
        F.sum("correct").alias("correct"),
        F.count_if("passed").alias("passed"),
        F.bool_and("passed").alias("_all"),
    )
    both = one.join(F.broadcast(totals))  # one row each
    return both.withColumn("release_ready", F.lit(reviewed) & F.coalesce("_all", F.lit(False)) & (F.col("extra") == 0) & (F.col("duplicates") == 0)).drop("_all")


def browse(scores: DataFrame, coverage: DataFrame, candidate: str, kind: str | None = None, pointer: str | None = None, equals: str | None = None) -> DataFrame:
    """Passing candidates (a variant) of a type whose value at ``pointer`` is ``equals`` (JSON text), with the run's coverage.

    ``pointer`` and ``equals`` come together; a pointer that leads nowhere keeps nothing.  The
    coverage is one row and is of the whole run, whatever is filtered.
    """
    if (pointer is None) != (equals is None):
        raise ValueError("pointer and equals come together")
    passed = scores.filter("passed")
    if kind is not None:
        passed = passed.filter(F.try_variant_get(candidate, "$.type", "string") == kind)
    if pointer is not None:
        value = jsons.resolve(F.col(candidate), pointer)
        passed = passed.filter(value.isNotNull() & jsons.typed_equal(value, F.parse_json(F.lit(equals))))
    return passed.join(F.broadcast(coverage))  # one row


def counters(cases: DataFrame, candidates: DataFrame, assertions: DataFrame, evidence_errors: DataFrame, reviewed: bool) -> DataFrame:
    """One row of all counters of a run and its release gate.

    ``cases``: case_id, name, type, and text (the expected one, null if it is not referenced).
    ``candidates``: case_id, name, type, text.  ``assertions``: case_id, pointer, is_field,
    right (null: the pointer leads nowhere), of cases with a candidate or without.
    ``evidence_errors``: case_id of every error.
    """
    matched, totals = match_candidates(cases, candidates.select("case_id", F.col("name").alias("_name"), F.col("type").alias("_type"), F.col("text").alias("_text")))
    per = assertions.groupBy("case_id").agg(F.count_if("is_field").alias("asked"), F.count_if(F.col("is_field") & F.coalesce("right", F.lit(False))).alias("right"), F.count_if(~F.coalesce("right", F.lit(False))).alias("wrong"))
    errors = evidence_errors.groupBy("case_id").agg(F.count(F.lit(1)).alias("errors"))
    rows = matched.join(per, "case_id", "left").join(errors, "case_id", "left").fillna(0, ["asked", "right", "wrong", "errors"])
    found = F.col("found")
    there = found & (F.trim(F.coalesce("_text", F.lit(""))) != "")
    referenced = F.col("text").isNotNull()
    same_text = found & referenced & F.col("_text").eqNullSafe(F.col("text"))
    text_ok = F.when(referenced, same_text).otherwise(there)
    passed = found & F.col("_name").eqNullSafe(F.col("name")) & F.col("_type").eqNullSafe(F.col("type")) & (F.col("wrong") == 0) & text_ok & (F.col("errors") == 0)
    one = rows.agg(
        F.count(F.lit(1)).alias("expected"),
        F.count_if(~found).alias("missing"),
        F.count_if(passed).alias("passed"),
        F.count_if(found & (F.col("wrong") == 0)).alias("correct_fields"),
        F.count_if(found & (F.col("wrong") == 0)).alias("fields_passed_cases"),
        F.coalesce(F.sum("asked"), F.lit(0)).alias("expected_field_assertions"),
        F.coalesce(F.sum(F.when(found, F.col("right"))), F.lit(0)).alias("correct_field_assertions"),
        F.count_if(found & (F.col("errors") == 0)).alias("valid_evidence"),
        F.count_if(there).alias("text_present"),
        F.count_if(same_text).alias("correct_text"),
        F.count_if(found & ~referenced).alias("unscored_text"),
        F.coalesce(F.bool_and(referenced), F.lit(True)).alias("_all_text"),
    )
    given = candidates.agg(F.count(F.lit(1)).alias("submitted"))
    both = one.join(F.broadcast(totals.select(F.col("extra").alias("extras"), "duplicates"))).join(F.broadcast(given))  # one row each
    gate = F.lit(reviewed) & F.col("_all_text") & (F.col("passed") == F.col("expected")) & (F.col("extras") == 0) & (F.col("duplicates") == 0)
    return both.withColumns({"unreviewed": F.lit(0).cast("long") if reviewed else F.col("expected"), "release_ready": gate}).drop("_all_text")


def inventory_errors(cases: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(case_id, error) of an inventory's faults: blank or repeated ids, blank names and types, nothing expected, unknown snapshots.

    ``cases``: case_id, name, type, snapshot_id, expected (a list of pointers); ``snapshots``: snapshot_id.
    """
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    known = snapshots.select("snapshot_id", F.lit(True).alias("_known")).distinct()
    times = cases.groupBy("case_id").agg(F.count(F.lit(1)).alias("_n"))
    rows = cases.join(known, "snapshot_id", "left").join(times, "case_id", "left")
    faults = [
        (blank("case_id"), "case_id is blank"),
        (F.col("_n") > 1, "case_id repeats"),
        (blank("name"), "name is blank"),
        (blank("type"), "type is blank"),
        (F.coalesce(F.size("expected"), F.lit(0)) <= 0, "nothing is expected"),
        (F.coalesce(F.exists("expected", lambda p: ~F.startswith(p, F.lit("/"))), F.lit(False)), "a pointer does not start with a slash"),
        (F.col("_known").isNull(), "snapshot is unknown"),
    ]
    return rows.select("case_id", F.explode(F.array_compact(F.array(*(F.when(c, F.lit(m)) for c, m in faults)))).alias("error")).distinct()

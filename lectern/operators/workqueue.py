"""The extraction work queue: tier ladder, selection, staleness, claims, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

TIERS = 3
STATE = "struct<tier:int,status:string,last_tier:int,last_kind:string,last_error:string,asked:boolean,logged:int>"


def start_state(tier: int = 1) -> Column:
    return F.struct(F.lit(tier).alias("tier"), F.lit("pending").alias("status"), F.lit(0).alias("last_tier"), F.lit("").alias("last_kind"), F.lit("").alias("last_error"), F.lit(False).alias("asked"), F.lit(0).alias("logged")).cast(STATE)


def advance(state: Column, attempt: Column) -> Column:
    """One failed attempt (tier, 0 for the current one; kind; error).

    Nothing moves once exhausted.  A validation failure equal to the last attempt is a repeat.  An
    attempt of another tier is only logged.  The first request for context at a tier retries it.
    Anything else goes up a tier, or is exhausted on the last.
    """
    at = F.when(attempt["tier"] == 0, state["tier"]).otherwise(attempt["tier"])
    repeat = (attempt["kind"] == "validation") & (state["last_tier"] == at) & (state["last_kind"] == "validation") & (state["last_error"] == attempt["error"])
    stale = at != state["tier"]
    retry = (attempt["kind"] == "needs_context") & ~state["asked"]
    logged = lambda tier, status, asked: F.struct(tier.alias("tier"), status.alias("status"), at.alias("last_tier"), attempt["kind"].alias("last_kind"), attempt["error"].alias("last_error"), asked.alias("asked"), (state["logged"] + 1).alias("logged")).cast(STATE)
    up = state["tier"] < TIERS
    return (
        F.when((state["status"] == "exhausted") | repeat, state)
        .when(stale, logged(state["tier"], state["status"], state["asked"]))
        .when(retry, logged(state["tier"], state["status"], F.lit(True)))
        .otherwise(logged(F.when(up, state["tier"] + 1).otherwise(state["tier"]), F.when(up, state["status"]).otherwise(F.lit("exhausted")), F.lit(False)))
    )


def fold_attempts(attempts: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Every key's state after its attempts in order; a fold over one array, inside the JVM."""
    one = F.struct(*order, "tier", "kind", "error")
    lists = attempts.groupBy(key).agg(F.array_sort(F.collect_list(one)).alias("a"))
    return lists.select(key, F.aggregate("a", start_state(), advance).alias("s")).select(key, "s.tier", "s.status", "s.logged")


def next_tier(queue: DataFrame) -> DataFrame:
    """Per book the lowest tier with pending work."""
    return queue.filter("status = 'pending'").groupBy("book").agg(F.min("tier").alias("tier"))


def select_work(queue: DataFrame, seg_id: str, n: int) -> DataFrame:
    """The first ``n`` pending segments of each book's lowest tier, by id."""
    open_ = queue.filter("status = 'pending'").join(next_tier(queue), ["book", "tier"], "left_semi")
    return open_.withColumn("_n", F.row_number().over(W.partitionBy("book").orderBy(seg_id))).filter(F.col("_n") <= n).drop("_n")


def is_stale(claimed_at: Column, now: Column, minutes: int = 60) -> Column:
    """Strictly longer ago than ``minutes``; what is no time is not stale."""
    return F.coalesce(F.try_to_timestamp(claimed_at) < now - F.expr(f"INTERVAL {minutes} MINUTES"), F.lit(False))


def reset_stale(queue: DataFrame, claimed_at: str, now: Column) -> DataFrame:
    free = (F.col("status") == "in_progress") & is_stale(F.col(claimed_at), now)
    return queue.withColumn("status", F.when(free, "pending").otherwise(F.col("status")))


def summary(queue: DataFrame) -> DataFrame:
    states = ["pending", "in_progress", "done", "exhausted"]
    tiers = [F.count_if(F.col("tier") == t).alias(f"tier_{t}") for t in range(1, TIERS + 1)]
    return queue.groupBy("book").agg(*(F.count_if(F.col("status") == s).alias(s) for s in states), *tiers)


def audit_claims(claims: DataFrame, owners: DataFrame, path: str, claimant: str) -> DataFrame:
    """Paths with trouble: claimed more than once, without an owner, or owned by another."""
    per = claims.groupBy(path).agg(F.countDistinct(claimant).alias("n_claims"), F.min(claimant).alias("first_claim"))
    joined = per.join(owners.select(F.col(path), F.col("owner")), path, "left")
    trouble = F.when(F.col("n_claims") > 1, "multiple").when(F.col("owner").isNull(), "missing").when(F.col("owner") != F.col("first_claim"), "other_owner")
    return joined.withColumn("trouble", trouble).filter("trouble IS NOT NULL")


def reply_outcome(reply: Column) -> Column:
    """What a reply asks for, by precedence: a new type, context, nothing, records."""
    has = lambda k, t: F.try_variant_get(reply, f"$.{k}", t)
    return (
        F.when(reply.isNull(), "invalid")
        .when(has("proposed_type", "string").isNotNull(), "proposed_type")
        .when(has("needs_context", "boolean"), "needs_context")
        .when(has("no_content", "boolean"), "no_content")
        .when(F.size(has("records", "array<variant>")) > 0, "records")
        .otherwise("invalid")
    )


def reset(queue: DataFrame, hard: bool) -> DataFrame:
    """Soft: exhausted and running work is pending again on its tier; hard: all starts anew."""
    redo = F.lit(True) if hard else F.col("status").isin("exhausted", "in_progress")
    return queue.withColumns({"status": F.when(redo, "pending").otherwise(F.col("status")), "tier": F.lit(1) if hard else F.col("tier")})


def escalate_stuck(queue: DataFrame) -> DataFrame:
    """Pending work whose last attempt failed on its own tier goes up, or is exhausted on the last tier.

    ``attempts`` holds structs of tier and kind, in order.  A first request for context is no
    failure yet.
    """
    here = F.filter("attempts", lambda a: a["tier"] == F.col("tier"))
    waits = (F.element_at(here, -1)["kind"] == "needs_context") & (F.size(here) < 2)
    stuck = F.coalesce((F.col("status") == "pending") & (F.size(here) > 0) & ~F.when(F.size(here) > 0, waits), F.lit(False))
    last = F.col("tier") >= TIERS
    return queue.withColumns({"tier": F.when(stuck & ~last, F.col("tier") + 1).otherwise(F.col("tier")), "status": F.when(stuck & last, "exhausted").otherwise(F.col("status"))})


def claim_files(replies: DataFrame, staged: DataFrame, owners: DataFrame) -> DataFrame:
    """Each path that a reply claims: seg_id, path, target, outcome, owner.

    ``replies``: seg_id, records (paths).  ``staged``: seg_id, path, target of files that lie in a
    segment's own staging folder.  ``owners``: target, owner and superseded, of files that live or
    written segments hold.  A path that is not staged by its own segment is missing; a target
    that another segment holds, unless that one is superseded, collides; others are claimed.
    """
    asked = replies.select("seg_id", F.explode(F.array_distinct("records")).alias("path"))
    held = owners.filter(~F.col("superseded")).groupBy("target").agg(F.collect_set("owner").alias("holders"))
    found = asked.join(staged.select("seg_id", "path", "target"), ["seg_id", "path"], "left").join(held, "target", "left")
    other = F.array_min(F.filter("holders", lambda h: h != F.col("seg_id")))
    outcome = F.when(F.col("target").isNull(), "missing").when(other.isNotNull(), "collision").otherwise("claimed")
    return found.select("seg_id", "path", "target", outcome.alias("outcome"), F.when(F.col("target").isNotNull(), other).alias("owner"))


def write_back(claims: DataFrame) -> DataFrame:
    """Per segment: status (pending, or failed with errors) and ``moves`` of its claimed files, as a manifest of actions."""
    move = F.when(F.col("outcome") == "claimed", F.struct(F.col("path").alias("source"), "target"))
    error = F.when(F.col("outcome") == "missing", F.concat(F.lit("missing_record_path: "), "path")).when(F.col("outcome") == "collision", F.concat(F.lit("record_path_collision: "), "target", F.lit(" is owned by segment "), F.col("owner").cast("string")))
    per = claims.groupBy("seg_id").agg(F.array_sort(F.collect_list(move)).alias("moves"), F.array_sort(F.collect_list(error)).alias("errors"))
    return per.withColumn("status", F.when(F.size("errors") > 0, "failed").otherwise("pending"))


def stamp_records(records: DataFrame, segments: DataFrame) -> DataFrame:
    """Claimed records with their segment's own book, pages, tier and model, whatever they said themselves."""
    own = segments.select("seg_id", F.col("book_id").alias("_b"), F.col("pages").alias("_p"), F.col("tier").alias("_t"), F.col("model").alias("_m"))
    given = {"book_id": "_b", "pages": "_p", "tier": "_t", "model": "_m"}
    out = records.join(own, "seg_id")
    return out.select(*[c for c in records.columns if c not in given], *(F.col(x).alias(c) for c, x in given.items()))


def fix_claims(segments: DataFrame, owners: DataFrame) -> DataFrame:
    """What recovery does with a segment's claims: action, pruned paths, and its new status and records.

    ``segments``: seg_id, in_human, superseded, status, records (paths); ``owners``: path, owner, of the files
    that are there.  A claim is bad if its file is missing or another's.  A superseded segment
    releases all claims; one in human hands is only reported; one that was done goes back to
    pending; others lose the bad paths.  Segments without trouble are left out.
    """
    claims = segments.select("seg_id", F.explode("records").alias("path")).join(owners, "path", "left")
    bad = claims.filter(F.coalesce(F.col("owner") != F.col("seg_id"), F.lit(True))).groupBy("seg_id").agg(F.collect_set("path").alias("_bad"))
    rows = segments.join(bad, "seg_id", "left").withColumn("_bad", F.coalesce("_bad", F.array().cast("array<string>")))
    freed = F.col("superseded") & (F.size("records") > 0)
    action = F.when((freed | (F.size("_bad") > 0)) & F.col("in_human"), "left_in_human").when(freed, "released").when(F.size("_bad") > 0, F.when(F.col("status") == "done", "reset").otherwise("pruned"))
    pruned = F.array_sort(F.when(freed, F.col("records")).otherwise(F.col("_bad")))
    rows = rows.withColumns({"action": action, "pruned": pruned}).filter("action IS NOT NULL")
    stays = F.col("action") == "left_in_human"
    return rows.select("seg_id", "action", "pruned", F.when(F.col("action") == "reset", "pending").otherwise(F.col("status")).alias("status"), F.when(stays, F.col("records")).otherwise(F.array_except("records", "pruned")).alias("records"))


def waves(queue: DataFrame, replies: DataFrame, n: int, cut, max_waves: int = 1000) -> DataFrame:
    """Work through the queue by scripted replies, ``n`` segments of a book at a time.

    ``replies``: seg_id, call (from 1), kind (done, or that of a failed attempt) and error.  A
    segment without a reply for its next call is left as it is and not asked again.  ``cut`` ends
    a wave's lineage.  Returns seg_id, book, tier, status and calls.
    """
    work = queue.select("seg_id", "book", F.lit(0).alias("calls"), F.struct(F.col("tier").cast("int").alias("tier"), "status", F.lit(0).alias("last_tier"), F.lit("").alias("last_kind"), F.lit("").alias("last_error"), F.lit(False).alias("asked"), F.lit(0).alias("logged")).cast(STATE).alias("s"), F.lit(False).alias("idle"))
    for _ in range(max_waves):
        open_ = work.filter("NOT idle").select("seg_id", "book", F.col("s.tier").alias("tier"), F.col("s.status").alias("status"))
        chosen = select_work(open_, "seg_id", n).select("seg_id", F.lit(True).alias("_now"))
        told = replies.select("seg_id", (F.col("call") - 1).cast("int").alias("calls"), F.struct(F.lit(0).alias("tier"), "kind", "error").alias("_reply"))
        step = work.join(chosen, "seg_id", "left").join(told, ["seg_id", "calls"], "left")
        here = F.coalesce("_now", F.lit(False))
        heard = here & F.col("_reply").isNotNull()
        done = F.col("s").withField("status", F.lit("done"))
        state = F.when(heard & (F.col("_reply.kind") == "done"), done).when(heard, advance(F.col("s"), F.col("_reply"))).otherwise(F.col("s"))
        work = cut(step.select("seg_id", "book", (F.col("calls") + heard.cast("int")).alias("calls"), state.cast(STATE).alias("s"), (F.col("idle") | (here & ~heard)).alias("idle")))
        if work.filter("NOT idle AND s.status = 'pending'").isEmpty():
            break
    else:
        raise RuntimeError(f"work is left after {max_waves} waves")
    return work.select("seg_id", "book", "s.tier", "s.status", "calls")


def ladder_lines(segments: DataFrame) -> DataFrame:
    """(book, tier, passed, escalated, retries): what the ladder's rungs came to.

    ``segments``: book, tier, status, outcome, attempts (structs of tier and kind).  A segment
    escalates from a tier by a validation or malformed attempt there, or a second request for
    context; every request for context is a retry.
    """
    rungs = segments.withColumn("rung", F.explode(F.sequence(F.lit(1), F.lit(TIERS))))
    here = F.filter(F.coalesce("attempts", F.array().cast(segments.schema["attempts"].dataType)), lambda a: a["tier"] == F.col("rung"))
    asks = F.size(F.filter(here, lambda a: a["kind"] == "needs_context"))
    up = F.exists(here, lambda a: a["kind"].isin("validation", "malformed")) | (asks >= 2)
    passed = (F.col("tier") == F.col("rung")) & (F.col("status") == "done") & (F.col("outcome") == "validated")
    return rungs.groupBy("book", F.col("rung").alias("tier")).agg(F.count_if(passed).alias("passed"), F.count_if(up).alias("escalated"), F.sum(asks).cast("long").alias("retries"))


def select_and_mark(queue: DataFrame, seg_id: str, n: int, now: Column) -> DataFrame:
    """The queue with the selected work in progress since ``now`` (column ``claimed_at``)."""
    chosen = select_work(queue, seg_id, n).select(seg_id, F.lit(True).alias("_chosen"))
    out = queue.drop("claimed_at") if "claimed_at" in queue.columns else queue
    before = queue.select(seg_id, F.col("claimed_at").cast("timestamp").alias("_before")) if "claimed_at" in queue.columns else queue.select(seg_id, F.lit(None).cast("timestamp").alias("_before"))
    out = out.join(before, seg_id).join(chosen, seg_id, "left")
    return out.withColumns({"status": F.when(F.col("_chosen"), "in_progress").otherwise(F.col("status")), "claimed_at": F.when(F.col("_chosen"), now).otherwise(F.col("_before"))}).drop("_chosen", "_before")


def audit_superseded(segments: DataFrame) -> DataFrame:
    """Superseded segments with trouble: (seg_id, superseded_by, trouble, paths).

    ``segments``: book, seg_id, heading, kind, records, released, superseded_by.  One whose class
    does not own it, or is not there, is ``wrongly_superseded`` (paths: what it released); another
    that still claims records is a ``superseded_claim`` (paths: its claims).
    """
    from lectern.operators.entries import owned_by_class

    classes = segments.select("book", F.col("seg_id").alias("superseded_by"), F.col("heading").alias("_title"))
    told = segments.filter("superseded_by IS NOT NULL").join(classes, ["book", "superseded_by"], "left")
    owns = F.coalesce(owned_by_class(F.col("heading"), F.col("kind"), F.col("_title")), F.lit(False))
    trouble = F.when(~owns, "wrongly_superseded").when(F.size("records") > 0, "superseded_claim")
    found = told.withColumn("trouble", trouble).filter("trouble IS NOT NULL")
    return found.select("seg_id", "superseded_by", "trouble", F.array_sort(F.array_distinct(F.when(~owns, F.col("released")).otherwise(F.col("records")))).alias("paths"))


def restore(segments: DataFrame, audit: DataFrame) -> DataFrame:
    """Segments after the audit's repairs: wrongly superseded ones get their stamp off and what they released back; others release their claims."""
    said = audit.select("seg_id", F.col("trouble").alias("_trouble"))
    out = segments.join(said, "seg_id", "left")
    wrong, claim = (F.coalesce(F.col("_trouble") == t, F.lit(False)) for t in ("wrongly_superseded", "superseded_claim"))
    none = F.array().cast(segments.schema["records"].dataType)
    back = F.array_distinct(F.concat("records", "released"))
    changed = {
        "superseded_by": F.when(~wrong, F.col("superseded_by")),
        "released": F.when(wrong, none).when(claim, F.array_distinct(F.concat("released", "records"))).otherwise(F.col("released")),
        "records": F.when(wrong, back).when(claim, none).otherwise(F.col("records")),
    }
    return out.select(*(changed.get(c, F.col(c)).alias(c) for c in segments.columns))

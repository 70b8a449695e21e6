"""Secret scans by corpus-wide ownership frequency.

Patterns give candidates.  Each candidate's value is hashed, and hashes are counted over the
whole corpus: in how many repositories and under how many owners a value occurs.  A value that
many owners share is a widely copied example; one that few owners have is owner-specific and
looks live.  Loose candidates (long mixed strings, kind ``blob``) are reported only if
owner-specific; candidates of the base kinds are always reported, with their verdict.

Only DataFrame operations: positions come from built-in string functions.  Values leave a
document as hashes only.

Defined results: a null text has no spans; a null owner is one owner; rows with equal repository
ids are one repository; repeated rows are scanned each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import materialize, pick, spread_join
from lectern.llm.spans import bound, clear_of, matches, written

KEYWORD = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
VALUE = r"[A-Za-z0-9+/_.=-]"
ASSIGN = KEYWORD + VALUE + "+"
ACCESS = "AKIA[A-Z0-9]{16,}+"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}+"
BLOB = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+(?![A-Za-z0-9+/_-])"
KINDS = ["assign", "access", "hex", "blob"]


def candidates(text: Column) -> Column:
    """Structs kind, rank, start, end, hash; the base kinds first."""
    found = matches(text, [("assign", ASSIGN, KEYWORD + VALUE + "{6}"), ("access", ACCESS, ACCESS), ("hex", HEX, HEX), ("blob", BLOB, BLOB)])
    assigned = F.transform(found, lambda s: s.withField("text", F.when(s["kind"] == "assign", F.regexp_replace(s["text"], "^" + KEYWORD, "")).otherwise(s["text"])))
    mixed = lambda t: t.rlike("[0-9]") & t.rlike("[a-z]") & t.rlike("[A-Z]")
    wanted = F.filter(assigned, lambda s: F.when(s["kind"] == "assign", F.length(s["text"]) >= 6).when(s["kind"] == "blob", mixed(s["text"])).otherwise(True))
    hashed = F.transform(wanted, lambda s: F.struct(s["kind"].alias("kind"), s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.sha2(s["text"], 256).alias("hash")))
    return bound(hashed, lambda x: bound(F.filter(x, lambda s: s["kind"] != "blob"), lambda base: F.concat(base, clear_of(F.filter(x, lambda s: s["kind"] == "blob"), base))))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", example_owners: int = 3) -> DataFrame:
    """One row per document row: the id and ``spans`` of kind, rank, start, end, hash, repos, owners, live.

    A value is live-looking if fewer than ``example_owners`` owners have it.
    """
    rows = pick(docs, id_col, text_col, repo_col, owner_col).select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.col(repo_col).cast("string").alias("_repo"), F.col(owner_col).cast("string").alias("_owner"), candidates(F.coalesce(F.col(text_col), F.lit(""))).alias("spans"))
    rows = materialize(rows, "secrets")
    each = rows.filter(F.size("spans") > 0).select("_row", "_repo", "_owner", F.inline("spans"))
    repos = each.groupBy("hash", "_owner", "_repo").agg(F.count(F.lit(1)).alias("times"))
    by_owner = repos.groupBy("hash", "_owner").agg(F.count(F.lit(1)).alias("n"), F.sum("times").alias("times"))
    # an owner's repositories are its own, so that repositories add up over owners
    spread = materialize(by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repos"), F.sum("times").alias("_times")), "secret-owners")
    judged = spread_join(each, spread, "hash", "_times").withColumn("live", F.col("owners") < example_owners).filter((F.col("kind") != "blob") | F.col("live"))
    told = judged.groupBy("_row").agg(F.collect_list(F.struct("kind", "rank", "start", "end", "hash", "repos", "owners", "live")).alias("spans"))
    none = F.array().cast(told.schema["spans"].dataType)
    return rows.select("_row", "_id").join(told, "_row", "left").select(F.col("_id").alias(id_col), F.coalesce("spans", none).alias("spans"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"] != "blob")
    number = lambda test: F.size(F.filter("spans", test)).cast("long")
    of_kind = lambda k: number(lambda s: s["kind"] == k).alias(f"n_{k}")
    return found.select(
        id_col,
        *map(of_kind, KINDS[:3]),
        F.sha2(written(base, "start", "rank"), 256).alias("base_sha256"),
        written(F.col("spans"), "start", "rank").alias("spans"),
        number(lambda s: s["live"]).alias("n_live"),
        number(lambda s: ~s["live"]).alias("n_example"),
    )

"""Links from record texts to the records that they name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word_list(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def cross_links(records: DataFrame, labels: dict[str, str], longest: int = 12) -> DataFrame:
    """``id``, ``target`` and ``n`` of the names that records' texts mention.

    ``records``: id, type, name, text.  At each place the longest name counts, from left to right,
    without overlap.  A name that several records share links only after "the <type label>".
    Mentions of a record's own name take their place but link nowhere.  Names have at most
    ``longest`` words (longer ones are an error).  Word runs and names meet in an equi-join.
    """
    named = records.select(F.col("id").alias("target"), "type", word_list(F.col("name")).alias("w")).filter("size(w) > 0")
    size = F.size("w")
    seen = named.agg(F.max(size).alias("n"), F.array_sort(F.collect_set(F.when(size <= longest, size))).alias("sizes")).first()
    if (seen.n or 0) > longest:
        raise ValueError(f"a name has {seen.n} words; raise longest knowingly")
    sizes = seen.sizes or [1]
    label = F.lit(None).cast("string")
    for kind, shown in labels.items():
        label = F.when(F.col("type") == kind, shown.lower()).otherwise(label)
    names = named.select("target", F.array_join("w", " ").alias("run"), F.concat(F.lit("the "), F.array_join(word_list(label), " ")).alias("lead"))
    shared = names.groupBy("run").agg(F.collect_list(F.struct("target", "lead")).alias("owners"))

    # few bytes become many runs, so texts are dealt to all tasks before they are cut
    dealt = records.select("id", "text").repartition(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")
    texts = dealt.select("id", word_list(F.col("text")).alias("w"))
    # a word carries its neighbours only, never the whole text
    reach = 1 + max((len(shown) + 1) // 2 for shown in ["", *map(str.lower, labels.values())])  # no label has more words
    near = lambda _, i: F.struct(i.alias("pos"), F.slice("w", i + 1, F.lit(sizes[-1])).alias("ahead"), F.slice("w", F.greatest(F.lit(1), i - reach + 1), F.least(i, F.lit(reach))).alias("back"))
    words = texts.select("id", F.explode(F.transform("w", near)).alias("x")).select("id", "x.*")
    # only lengths that some name has
    each = F.filter(F.array(*(F.when(F.size("ahead") >= n, F.struct(F.lit(n).alias("len"), F.array_join(F.slice("ahead", 1, n), " ").alias("run"))) for n in sizes)), lambda x: x.isNotNull())
    runs = words.select("id", "pos", F.concat(F.lit(" "), F.array_join("back", " ")).alias("before"), F.inline(each))
    # by merge: names are as many as records, which no driver can hold however few bytes their files have
    hits = runs.join(shared.hint("merge"), "run")
    typed = F.filter("owners", lambda o: F.endswith(F.col("before"), F.concat(F.lit(" "), o["lead"])))
    own = F.exists("owners", lambda o: o["target"] == F.col("id"))
    meant = F.when(own, F.col("id")).when(F.size("owners") == 1, F.get("owners", F.lit(0))["target"]).when(F.size(typed) == 1, F.get(typed, F.lit(0))["target"])
    hits = hits.select("id", "pos", "len", meant.alias("target")).filter("target IS NOT NULL")

    kind = records.schema["id"].dataType.simpleString()
    state = f"struct<upto:int,found:array<{kind}>>"
    order = F.array_sort(F.collect_list(F.struct("pos", (-F.col("len")).alias("shorter"), "target")))
    step = lambda acc, h: F.when(h["pos"] >= acc["upto"], F.struct((h["pos"] - h["shorter"]).alias("upto"), F.concat(acc["found"], F.array(h["target"])).alias("found")).cast(state)).otherwise(acc)
    start = F.struct(F.lit(0).alias("upto"), F.array().cast(f"array<{kind}>").alias("found")).cast(state)
    kept = hits.groupBy("id").agg(F.aggregate(order, start, step, lambda acc: acc["found"]).alias("found"))
    return kept.select("id", F.explode("found").alias("target")).filter("target <> id").groupBy("id", "target").agg(F.count(F.lit(1)).alias("n"))


def referenced_by(links: DataFrame, records: DataFrame) -> DataFrame:
    """Per target the records that link to it, by type, name and slug."""
    shown = records.select("id", F.struct("type", "name", "slug").alias("record"))
    return links.join(shown, "id").groupBy("target").agg(F.array_sort(F.collect_list("record")).alias("referenced_by"))

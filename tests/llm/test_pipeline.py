"""The pipeline's stages, each on its own input."""

import corpus_pipeline
from lectern.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_columns(spark):
    docs = table(spark, SF, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_dedup", "personal_data", "mix_sources", "pack"]
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        from lectern.llm.common import materialize

        docs = materialize(out, "stage")
        counts.append(docs.count())
        if name == "simhash_dedup":
            assert docs.select("doc_id").distinct().count() == counts[-1]
        if name == "personal_data":
            assert docs.filter(r"text RLIKE '@[a-z0-9]+\\.example\\.com'").isEmpty()
    assert 0 < counts[2] < counts[1] < counts[0] and counts[3] == counts[2] and counts[4] != counts[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert packed.groupBy("sequence_id").sum("length").filter("`sum(length)` > 2048").isEmpty()


def test_empty_corpus(spark, tmp_path):
    docs = table(spark, SF, "documents").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_clashing_and_null_columns(spark):
    docs = table(spark, SF, "documents").selectExpr("*", "1 kept", "2 fp", "3 spans", "4 _row", "CAST(NULL AS string) size", "'t' _text")
    nulls = docs.limit(1).selectExpr("CAST(NULL AS bigint) doc_id", "CAST(NULL AS string) text", "CAST(NULL AS string) lang", "CAST(NULL AS string) source", "CAST(NULL AS bigint) n_chars", "kept", "fp", "spans", "_row", "size", "_text")
    docs = docs.union(nulls).union(nulls).union(docs.limit(3))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() > 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_near_duplicates_by_shingles(spark):
    """Against all pairs; one changed word in a long text moves more than 2 bits of a fingerprint."""
    import random

    from lectern.llm import shingles

    rng = random.Random(3)
    draw = lambda n: [rng.choice("alpha beta gamma delta eta theta iota kappa zeta omega".split()) + str(rng.randint(0, 60)) for _ in range(n)]
    common = draw(20)
    texts = [None, "", " \n", "one two", "One  TWO", "one two three"]
    for k in range(25):
        base = draw(rng.randint(5, 150)) + (common if k % 2 else [])
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.randint(1, 4)):
                copy[rng.randrange(len(copy))] = draw(1)[0]
            texts.append(" ".join(copy))
    texts += ["long " * 30 + " ".join(common)] * 3
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    sets = {i: frozenset(shingles.shingle_set(None if t is None else t.encode()).tolist()) for i, t in zip(ids, texts)}
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.dedup_stage(spark, docs, SF).collect())
    assert got == sorted({top(i) for i in ids})
    assert len(got) < len(set(map(frozenset, sets.values())))


def test_packed_pieces_hold_their_ids(spark):
    import zlib

    import numpy as np

    from lectern.llm import packing

    placed = corpus_pipeline.pack_stage(spark, table(spark, SF, "documents").limit(40), SF)
    rows = placed.collect()
    assert rows and all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in rows)
    made = packing.sequences(placed).collect()
    assert sum(r.tokens for r in made) == sum(r.length for r in rows)


def test_a_pair_is_told_where_it_first_shares_a_shingle(spark, monkeypatch):
    from pyspark.sql import functions as F

    from lectern.llm import shingles

    keys = F.sequence(F.lit(100), F.lit(129))  # thirty shingles that twenty unlinked sets all have
    rows = spark.range(20).select(F.col("id").alias("node"), F.col("id").alias("root"), F.lit(200).alias("n"), *(F.lit(0).cast("long").alias(c) for c in shingles.SIGNATURE), F.posexplode(keys).alias("pos", "key"))
    rows = rows.withColumns({"key": F.col("key").cast("long"), **{c: F.when(F.col("pos") >= k, (F.col("key") - k).cast("long")).otherwise(F.col("node")) for k, c in enumerate(shingles.AHEAD, 1)}})
    expected = {(a, b) for a in range(20) for b in range(a)}
    made = shingles.open_pairs(rows, (4, 5))
    assert {(r.a, r.b) for r in made.collect()} == expected
    monkeypatch.setattr(type(rows), "distinct", lambda d: d)
    assert shingles.open_pairs(rows, (4, 5)).count() == len(expected)

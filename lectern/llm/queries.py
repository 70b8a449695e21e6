"""The thin queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import ann, bt_quality, langid, licenses, mixing, packing, pii, quality_rules, secrets, simhash
from lectern.llm.common import pick, table


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "placements")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text")
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.apply_rules(docs, model).drop("text")


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(table(spark, sf_dir, "documents"), keep=["doc_id"]))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def word_tokenizer() -> str:
    """The public tokenizer file that op8 names, as text: executors need no file."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer=word_tokenizer()).drop("ids")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bt_quality.classify(docs, bt_quality.fit(docs, table(spark, sf_dir, "labels")))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix": op1_mix,
        "op2_quality_rules": op2_quality_rules,
        "op3_ann": op3_ann,
        "op4_simhash": op4_simhash,
        "op5_secrets": op5_secrets,
        "op6_pii": op6_pii,
        "op7_licenses": op7_licenses,
        "op8_pack": op8_pack,
        "op9_quality": op9_quality,
        "op10_langid": op10_langid,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_licenses": licenses.oracle_sql()}

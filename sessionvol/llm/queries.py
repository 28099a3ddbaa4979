"""The registered query of each operator, over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionvol.llm import audit, benchmarks, chat, languages, lines, nearcopies, negatives, packing, pages, quality, repeats, toxicity, urls

HELD_OUT_FOLDS = 5


def held_out(id_col: str = "doc_id") -> Column:
    """Is crc32 of the id's text divisible by five? Documents without an id are held out."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % HELD_OUT_FOLDS == 0, F.lit(True))


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.train(docs.filter(~held_out()), _read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_read(spark, sf_dir, "documents"), keep_text=False)


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_read(spark, sf_dir, "documents"), keep_text=False)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], turns.schema)
    return chat.digests(chat.format_windows(turns.union(more)))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.linked_lines(_read(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    profiles = languages.learn(docs.filter(~held_out()))
    return languages.predict(docs, profiles).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op8_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(_read(spark, sf_dir, "pages"))


def op9_benchmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmarks.decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.near_copies(_read(spark, sf_dir, "documents")).select("doc_id", "class_id", "is_first", "n_links")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(_read(spark, sf_dir, "embeddings").withColumn("label", moved))


#: The rules of the query.
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages_table = _read(spark, sf_dir, "pages")
    return urls.judge(pages_table, pages_table, "html", URL_RULES)


def op13_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interaction(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_toxicity, op2_packing, op3_quality, op4_repeats, op5_chat, op6_lines, op7_language, op8_pages, op9_benchmarks, op10_near_copies,
            op11_hard_negatives, op12_urls, op13_interaction,
        )
    }

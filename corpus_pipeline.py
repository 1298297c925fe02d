"""A pipeline from raw documents to token ids, in five stages.

Each stage is written to the shared folder and read again by the next, so a lost executor costs no
more than the stage at hand. The columns of `documents` stay until the last stage; `n_chars`
follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmarts.llm import bpe, mixing, quality, repeats, simhash
from tripmarts.llm.common import stored, table, unused, words_of


def with_text(docs: DataFrame, text, columns: list[str]) -> DataFrame:
    """The given columns, with a new text and its length."""
    new = docs.withColumn("text", text)
    if "n_chars" in columns:
        new = new.withColumn("n_chars", F.length("text").cast("long"))
    return new.select(*[F.col(f"`{c}`") for c in columns])


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their bad lines."""
    name = unused("quality", docs.columns)
    judged = quality.only_kept(quality.line_first(docs, out=name), name)
    return with_text(judged, F.col(f"`{name}`.cleaned"), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest id, rows without one last."""
    return simhash.keep_one_row(docs, shingle=4, radius=4).select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 200 bytes that stand elsewhere too; those left without a word go."""
    cut = repeats.without_repeats(docs, as_text=True).filter(F.size(words_of(F.col("kept"))) > 0)
    rest = [c for c in docs.columns if c != "text"]
    whole = cut.select(F.col("kept").alias("text"), *[F.col("rest")[c].alias(c) for c in rest])
    return with_text(whole, F.col("text"), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes, in training order; the last copy of a source is cut."""
    slim = docs.select(
        "doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
    )
    copies = mixing.in_training_order(mixing.curriculum_plan(slim))
    text = F.when(
        F.col("copy.words") < F.col("size"), mixing.first_words(F.col("doc.text"), F.col("copy.words").cast("int"))
    ).otherwise(F.col("doc.text"))
    taken = copies.select(text.alias("__text"), "doc.*")
    return with_text(taken, F.col("__text"), docs.columns)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number of tokens of each copy, and digests of its ids and of what they decode to."""
    return bpe.digests(docs)


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", remove_repeated_passages),
    ("mixing", mix_sources),
    ("byte_bpe", encode_bytes),
]

# Neither XXH64 fingerprints nor BPE can be said in SQL: tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs

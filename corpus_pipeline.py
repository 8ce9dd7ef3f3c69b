"""The corpus pipeline: language, repeated lines, near-duplicates, mix, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs. All but the last return the columns of the docs they get, with their values and types; further columns, whatever
their names, pass through to the last. The first stage rejects texts without a letter (null and empty ones too)
and those whose cosine with every language is below ``langid.REJECT_BELOW``; null ids, ties and repeated rows are as each
stage says. An empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulbook.llm import bpe, langid, linededup, mixing, simhash
from haulbook.llm.common import fresh, ship, written

ORACLE_SQL = None  # language profiles, patience diff, SimHash, flow and BPE are beyond SQL; see tests/llm


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, which becomes their ``lang``. A tie goes to the first name; repeated rows are judged alike."""
    ship(spark)
    prototypes = langid.learn(docs, F.lit(True))
    names = {"lang_pred": fresh(docs, "lang_pred"), "score": fresh(docs, "score")}
    found = langid.accepted(langid.with_language(docs, prototypes, **names), **names)
    return found.withColumn("lang", F.col(names["lang_pred"])).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines they share with earlier ones; what has no text left goes. Rows that repeat a doc_id are not
    cut against each other; those with a null one stay as they are."""
    ship(spark)
    cut = linededup.without_repeated_lines(docs, n_chars="n_chars").select(*docs.columns)
    return cut.filter("text is null or trim(text) <> '' ")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest doc_id, null only if the group has no other, and one row of it."""
    ship(spark)
    return simhash.without_near_duplicates(docs).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: repeated rows share a hash and are taken alike, ties at the cut by that hash."""
    ship(spark)
    return mixing.repeated(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the ids of each text, their number, and the digest of the text they are decoded to."""
    ship(spark)
    found = bpe.with_tokens(docs.select("doc_id", "source", "text"), digest="decoded_sha256", keep_text=False)
    return found.select("doc_id", "source", F.size("token_ids").alias("n_tokens"), "token_ids", "decoded_sha256")


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

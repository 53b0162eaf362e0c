"""The corpus pipeline: stages over `documents`, each written as Parquet and read again for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.llm import langid, mixing, packing, sanitise, simhash
from sensorweave.llm.common import cut, documents
from sensorweave.llm.queries import tokenizer_path

#: A text is rejected if no language contains more than this (weighted) share of its n-grams.
LEAST_SHARE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go; a missing language is filled in."""
    found = langid.identify(docs, langid.fit(docs.select("text", "lang")), "__lang", "__share")
    kept = found.filter((F.col("__lang") != langid.UNKNOWN) & (F.col("__share") >= LEAST_SHARE))
    return kept.select(*[F.coalesce("lang", "__lang").alias("lang") if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_one(docs, 4, 4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced in the texts; ``n_chars`` follows."""
    clean = sanitise.sanitise(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.length("text").cast(kind))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return mixing.resample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path(), 2048)


STAGES = [("language", language), ("simhash", near_duplicates), ("personal_data", personal_data),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: Filters, fingerprints and tokenisation have no SQL form; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the last stage's rows."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs

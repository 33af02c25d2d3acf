"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. Every stage is written as Parquet in the shared folder and read back
before the next one starts, so a lost executor costs no more than a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import exact_dedup, language, mixing, near_copies, packing
from loomstat.llm.common import documents, free_name, saved

#: Texts of whose n-grams the language knows less than this share are rejected, with those of no language.
LEAST_SHARE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose text shows one of the languages; the model is trained on ``docs``."""
    model = language.train(docs)
    found = free_name(docs, "__lang")
    made = language.predicted(docs, model, name=found)
    return made.filter((F.col(f"{found}.lang_pred") != "und") & (F.col(f"{found}.share") >= LEAST_SHARE)).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the largest id of equal texts."""
    return exact_dedup.keep_distinct(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component of near copies (five-word Jaccard 0.8 or more)."""
    return near_copies.keep_one_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which their sources are mixed to target weights."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their place in sequences of at most 2048 tokens, which follow the mixture.

    Rows that were written and read again come in any order, so their slots are worked out anew;
    they depend on the rows only.
    """
    return packing.pack_in_order(mixing.mix(docs))


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The fingerprints (XXH64), the language filter and the tokenizer can't be put in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, in order."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, f"stage{k}")
    return docs

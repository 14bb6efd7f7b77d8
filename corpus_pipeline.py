"""From raw documents to packed sequences: quality, near-duplicates, repeated passages, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents, and each works on all that its predecessor kept. Extra columns are not carried, whatever
their names. An empty table goes through all stages and gives no sequences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.llm import gam, mixing, packing, simhash, suffix
from ledgerlark.llm.common import read
from ledgerlark.session import remove, shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go.

    A null text scores like an empty one. Rows that repeat an id are judged each by its own text, of
    any length; rows without an id teach nothing and are judged like all others.
    """
    return gam.keep_good(docs, gam.train(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id.

    Texts without words (null, empty, blank) are one group. Groups are of rows: rows that repeat an id
    but are not similar all stay; among rows of one id and group the text with the least hash stays,
    once. A null id is larger than any other. Very long texts are compared whole.
    """
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has are cut out; documents stay, if need be with an empty text.

    Null texts stay null. Rows of one id cut nothing from each other; rows without an id lose what any
    row with one has. Very long texts are searched whole.
    """
    return suffix.dedup_texts(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them, in its shards.

    Whole documents only, of any length. A null source is a source of its own. Texts without words stay
    once. Equal rows are drawn together, rows that only share an id each by itself.
    """
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, in the order of the mixture's shards.

    A null or empty text is its end id alone; a very long one fills as many sequences as it needs.
    Rows that repeat an id are packed each; a null id stays null.
    """
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources", mixture),
    ("packing", packed),
]
#: No SQL trains the model, finds suffixes or encodes tokens; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared checkpoint folder and read again.

    What a stage wrote is removed when the next one has written its own; the last one's rows stay for
    the result, which reads them when it runs.
    """
    at = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        out.write.parquet(f"{at}/{i}")
        docs = spark.read.parquet(f"{at}/{i}")
        if i:
            remove(f"{at}/{i - 1}")
    return docs

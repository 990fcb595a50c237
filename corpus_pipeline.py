"""Corpus pipeline: five of the training-data operators, one after the other.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``.  All but the
last return the columns of ``docs``.

* toxicity: documents that the learned lexicon rejects go;
* near_duplicates: of each SimHash component the smallest doc_id stays;
* decontamination: contaminated documents go, by the 13-word rule;
* secrets: reported spans are replaced by a mark, all documents stay;
* packing: the rest is packed into sequences of 2048 ids.

A stage on an empty table, or with nulls, ties and repeated rows, does what its operator
defines for them; rows without a doc_id are documents like others.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clickpath.llm import secrets, simhash
from clickpath.llm.common import table
from clickpath.llm.decontaminate import contamination
from clickpath.llm.packing import pack_documents
from clickpath.llm.queries import BYTE_TOKENIZER
from clickpath.llm.toxicity import toxicity as judged
from clickpath.storage import stored

#: Encoding ids and packing them is beyond SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return judged(docs, table(spark, sf_dir, "labels")).filter("predicted = 0").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints within 3 bits (3-word shingles)."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return contamination(docs, table(spark, sf_dir, "benchmark")).filter("not contaminated").select("doc.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark."""
    return secrets.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 ids."""
    return pack_documents(docs, public_tokenizers.path(BYTE_TOKENIZER))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_scan),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's output is stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: stages that each write a table, which the next reads as its documents.

Language ID drops documents whose language cannot be told, near-dedup leaves one of each group,
mixing takes documents as often as their rate says, and packing cuts what is left into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import langid, mixing, packing, simhash
from gridloom.llm.common import table, written

#: Bytes of met words that a worker keeps in packing: less than a query of its own would, as
#: workers here have served the stages before.
ROOM = 64 << 20

#: The first stage is a trained classifier, which SQL cannot express; the tests hold every stage
#: against a plain version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go: no letters, or no language that is likelier than all others."""
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest id."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate says: those found clean once or more, some poor and toxic ones not at all."""
    return mixing.resample(docs, mixing.mix(docs, mixing.domains(table(spark, sf_dir, "labels")), keep=("clean",)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 ids; a repeated document has pieces for each time."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, room=ROOM)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs

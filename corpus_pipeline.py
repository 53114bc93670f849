"""The corpus pipeline: five stages, each over all that its predecessor kept.

Language identification drops documents without a language, near-dedup keeps one document of each group,
substring dedup cuts repeated passages out of the texts, mixing repeats documents up to the target of their
source, and packing cuts the mix into sequences of tokens. Every stage but the last returns the columns of
documents. `run` writes each stage's rows and reads them again.

A stage gets rows that are written, so it begins by deleting the intermediate tables of the stage before.

A null text has no language, no words and no letters, so language identification drops it, as it drops empty texts;
later stages keep rows whose text became empty. Repeated rows of one doc_id are rows of their own up to near-dedup, which
keeps those of the smallest doc_id. Columns beyond those of documents travel along, whatever their names. An empty
table passes through all stages and gives no rows. Very long texts are treated whole.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dealgauge.llm import language_id, mixing, near_dedup, packing, substring_dedup
from dealgauge.llm.scratch import Scratch, tracked

TOKENIZER = "word_bpe_49k.json"
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a predicted language; the model learns from the labelled rows. Where no row is labelled,
    documents with letters."""
    model = language_id.fit(docs)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    # other columns get names that cannot clash with those of the prediction; each text goes along once
    told = language_id.identify(docs.toDF(*[c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]), model)
    return told.filter(told.lang_pred != language_id.UNKNOWN).drop("lang_pred", "score").toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_substrings(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(packing.cut_pieces(docs, public_tokenizers.path(TOKENIZER)))


#: Intermediate tables of the stage that ran last; its rows read them until they are written.
_LAST: list[Scratch] = []


def _with_own_scratch(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _LAST:
            _LAST.pop().remove()
        with tracked() as made:
            rows = stage(spark, docs, sf_dir)
        _LAST.extend(made)
        return rows

    return begun


STAGES = [
    (name, _with_own_scratch(stage)) for name, stage in (
        ("language_id", languages),
        ("near_dedup", near_duplicates),
        ("substring_dedup", substrings),
        ("mixing", mixture),
        ("packing", packed),
    )
]
#: No stage but the mixture can be said in SQL; the stages' operators are held against plain versions in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs

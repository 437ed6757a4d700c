"""The corpus pipeline: toxicity, exact dedup, near dedup, mixing, tokenisation.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; stages
are written as Parquet and read again.  All but the last return the columns of ``documents``,
extra ones included, whatever their names.  Every stage takes an empty table and gives one.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from docengine.llm.common import fresh, remove, shared_folder, table

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def _keyed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """Rows with 128 bits that name all their columns, and the names of the two new columns."""
    keys = fresh(docs, "_k1", "_k2")
    own: list[Column] = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema]
    return docs.withColumns({keys[0]: F.xxhash64(*own), keys[1]: F.xxhash64(F.lit(1), *reversed(own))}), keys


def _kept(docs: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that ``verdicts`` keeps; one of rows that are alike in all columns.  Both steps use one shuffle."""
    kept = verdicts.where("kept").select(*keys)
    return docs.join(kept, keys, "left_semi").dropDuplicates(keys).drop(*keys)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier does not reject.

    Null and empty texts are scored as texts without words; very long ones are scored whole.
    Repeated rows share a verdict.  Without labels of both kinds the score is constant.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.scorer(spark, model)("text") < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space: the longest, then the smallest doc_id (null last).

    Null counts as empty, and one row without text stays.  Ties are broken by the other columns'
    hash, so the choice does not depend on the partitioning; of identical rows one stays.
    """
    docs, keys = _keyed(docs)
    return _kept(docs, exact_dedup.exact_dedup(docs, carry=keys), keys)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies: the smallest doc_id (null last), ties as in drop_copies.

    Rows without words are linked with nothing and stay.
    """
    docs, keys = _keyed(docs)
    return _kept(docs, near_dedup.near_dedup(docs, carry=keys), keys)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as its source's target asks for.

    Null is a source of its own; a text without words has size 0 and is copied at its source's
    rate.  Rows that repeat a doc_id are copied alike.  A source without words goes.
    """
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text", "source")
    return mixing.emit(mixing.mix(rows)).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and token digests of every row of the mix; a null text is encoded as the empty one."""
    return bpe.digests(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, carry=["doc_id", "lang", "source"])


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("bpe", encode),
]

#: The classifier and the components have no SQL form; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    A stage's folder goes when its successor is written; the last one stays, as the result reads it.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus_pipeline-{uuid.uuid4().hex}"
    before = None
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{k}-{name}"
    return docs

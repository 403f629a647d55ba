"""A training corpus from raw documents, in five stages.

1. quality: documents that the classifier rejects go;
2. near_duplicates: one document of each group stays;
3. decontaminate: documents that hold a benchmark item go;
4. secrets: reported spans are masked;
5. tokens: the remaining texts become piece ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents; extra columns
stay. An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockout.llm import decontaminate as _decontaminate
from stockout.llm import minhash as _minhash
from stockout.llm import quality as _quality
from stockout.llm import secrets as _secrets
from stockout.llm import sentencepiece as _sentencepiece
from stockout.llm.common import free_name, read_table
from stockout.session import ensure_checkpoint_dir, ship_package
from stockout.stage import write_stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    ship_package(spark)
    model = _quality.fit_documents(docs, read_table(spark, sf_dir, "labels"))
    score = free_name("_quality_score", docs.columns)
    scored = _quality.score_documents(docs, model, score)
    return scored.where(F.col(score) >= _quality.THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship_package(spark)
    return _minhash.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship_package(spark)
    return _decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    ship_package(spark)
    return _secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and round_trip of every document."""
    ship_package(spark)
    return _sentencepiece.encode_documents(docs, _sentencepiece.load_pieces(_sentencepiece.default_model()))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("secrets", secrets), ("tokens", tokens)]

#: SQL can state neither the classifier nor the similarity or the tokens; tests/llm holds every
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages over all documents."""
    ensure_checkpoint_dir(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

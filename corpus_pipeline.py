"""From raw documents to packed training sequences, stage by stage.

Every stage reads what the one before it kept, as a written table, and all but the last return the columns of
documents. Quality rules drop documents they reject; the two deduplications keep one document of each group; personal
data is replaced by its kind; packing returns one row per piece of a sequence.

What a stage writes on the way stays until its result has been written: it goes when the next stage is called, or at the
end of `run`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import exact, neardup, packing, pii, quality
from palimpsest.storage import Scratch, session_scratch

_held: list[Scratch] = []  # Of the stage that was called last.


def _let_go() -> None:
    while _held:
        _held.pop().close()


def _stage_scratch(spark: SparkSession) -> Scratch:
    _let_go()
    _held.append(session_scratch(spark))
    return _held[-1]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality.judge_quality(docs, labels, _stage_scratch(spark), carry=True)
    return judged.where("kept").select("row.*")


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.dedup(docs, _stage_scratch(spark), carry=True).where("kept").select("row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(docs, _stage_scratch(spark), carry=True).where("kept").select("row.*")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    changed = {"text": F.col("masked")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("masked").cast(docs.schema["n_chars"].dataType)
    _let_go()
    scanned = pii.scan(docs, carry=True)
    return scanned.select(*[changed.get(name, F.col("row")[name]).alias(name) for name in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, _stage_scratch(spark)).withColumnRenamed("id", "doc_id")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None  # Language ratios, alignments and token ids are beyond SQL; see tests/llm/test_pipeline.py.


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = session_scratch(spark)
    before = []
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        _let_go()
        scratch.drop(*before)  # Nothing reads the stage before any more.
        before = [name]
    return docs

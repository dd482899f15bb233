"""A corpus pipeline of five operators: quality, near duplicates, benchmark, mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read back as the
next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dialogue_etl.llm import decontaminate, minhash_dedup, mixing, quality, token_output
from dialogue_etl.llm.common import materialize, remove, tables_made

_earlier: list[str] = []


def _clean_start(spark: SparkSession, docs: DataFrame) -> None:
    """Removes the scratch tables of earlier stages that docs doesn't read: their results have been written."""
    read = docs.inputFiles()
    for path in [p for p in _earlier if not any(p.rstrip("/").rpartition("/")[2] in f for f in read)]:
        remove(spark, path)
        _earlier.remove(path)


def _stage(spark: SparkSession, docs: DataFrame, work) -> DataFrame:
    _clean_start(spark, docs)
    known = set(tables_made())
    out = work()
    _earlier.extend(p for p in tables_made() if p not in known)
    return out


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. Null and empty texts are judged like any other, by the
    features of an empty text; rows that repeat an id are judged alike if they are equal; without labels all stay."""
    return _stage(spark, docs, lambda: quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words a shingle, similarity 0.8. The smallest id
    stays; rows without an id come last; of equal rows one stays; null and empty texts all stay."""
    return _stage(spark, docs, lambda: minhash_dedup.keep_one(docs))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of a benchmark go: 20 * n_hit >= n_words. Null and empty texts stay; every row is
    judged by itself, those that repeat an id and those without one too."""
    return _stage(spark, docs, lambda: decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def weighted_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. A null source is one of the sources; null and empty texts have no
    size and are taken as their hash says; rows that repeat an id are taken alike."""
    return _stage(spark, docs, lambda: mixing.mixed(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token ids in ORC files, and the index read back from them. Null and empty texts are the end id
    alone; rows that repeat an id all have places of their own; null ids come first."""
    return _stage(spark, docs, lambda: token_output.tokenize(docs, token_output.default_tokenizer()))


STAGES = [
    ("quality", good_quality),
    ("near_dedup", near_unique),
    ("decontaminate", benchmark_free),
    ("mix", weighted_mix),
    ("token_ids", token_ids),
]

#: The classifier, the sketches and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

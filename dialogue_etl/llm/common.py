"""Shared pieces of the training-data operators: shared scratch tables, components, runs of sorted Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one bucket that are compared in one task; larger buckets are dealt as pairs of blocks of this size.
BLOCK_ROWS = 1024

_made: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a local one only where the session has none and is local itself."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file:///tmp/dialogue_etl-{spark.sparkContext.applicationId}"
    return root.rstrip("/")


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Writes df into the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def free_name(df: DataFrame, name: str) -> str:
    """A column name like `name` that df doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def drop(df: DataFrame) -> None:
    """Removes a table that materialize() wrote, once nothing reads it any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    if path in _made:
        _made.remove(path)


def tables_made() -> list[str]:
    """Paths of the scratch tables that still exist in this process's account."""
    return list(_made)


def note_scratch(path: str) -> None:
    _made.append(path)


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(node, component) of an undirected graph given as long pairs (a, b); component is its smallest node.

    Alternating large-star and small-star rounds over DataFrames. The minimum of each neighbourhood is a
    map-side combined aggregate, and it is written before it is joined back, so that both join sides are
    plain shuffles which adaptive execution can split at a hot node.
    """

    def star(pairs: DataFrame, large: bool, tag: str) -> DataFrame:
        if large:
            sided = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
            low = sided.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        else:
            sided = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            low = sided.groupBy("u").agg(F.min("v").alias("m"))
        low = materialize(low, f"{name}-low")
        joined = sided.join(low, "u")
        if large:
            joined = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            joined = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        out = materialize(joined.filter("a <> b").distinct(), f"{name}-{tag}")
        drop(low)
        return out

    def mark(pairs: DataFrame) -> tuple:
        r = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    pairs = materialize(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-edges")
    before = mark(pairs)
    while before[0]:
        wide = star(pairs, True, "large")
        after = star(wide, False, "small")
        drop(wide)
        drop(pairs)
        pairs, now = after, mark(after)
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def local_roots(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 and undirected edges between them: the smallest node of each one's component."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        jumped = root[root]
        while not np.array_equal(jumped, root):
            root, jumped = jumped, jumped[jumped]
        apart = root[left] != root[right]
        left, right = left[apart], right[apart]
    return root


def block_rows(rows: DataFrame, sizes: DataFrame, keys: list[str], salt: str, block: int = BLOCK_ROWS) -> DataFrame:
    """Joins bucket rows with their bucket's size (column bucket_size) and deals large buckets as pairs of blocks.

    Adds blk_i <= blk_j (the pair of blocks that a task compares) and blk (the row's own block). A row of a
    bucket with b blocks goes to b block pairs, so every pair of rows meets in exactly one task.
    """
    n = F.ceil(F.col("bucket_size") / F.lit(block)).cast("int")
    out = rows.join(sizes, keys).withColumn("blk", F.pmod(F.xxhash64(salt), n).cast("int"))
    out = out.withColumn("blk_other", F.explode(F.sequence(F.lit(0), n - 1)))
    return out.withColumn("blk_i", F.least("blk", "blk_other")).withColumn("blk_j", F.greatest("blk", "blk_other")).drop("blk_other", "bucket_size")


def whole_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Regroups sorted batches so that no run of equal keys is cut between two of the yielded tables."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        first = tuple(c[0].as_py() for c in columns)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        tail = tuple(c[-1].as_py() for c in columns)
        if tail == first:
            held.append(batch)
        else:
            change = run_starts([c.to_numpy(zero_copy_only=False) for c in columns])[-1]
            yield pa.Table.from_batches([*held, batch.slice(0, change)])
            held = [batch.slice(change)]
        last = tail
    if held:
        yield pa.Table.from_batches(held)


def run_starts(columns: list[np.ndarray]) -> np.ndarray:
    """Positions at which any of the sorted key columns changes, 0 first."""
    change = np.zeros(len(columns[0]), bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)

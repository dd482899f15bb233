"""Embedding near-duplicates by randomised-rotation binary codes with stored correction factors.

A unit vector o is rotated at random; the signs of the rotated vector, scaled to unit length, are its code o'.
With the stored factor c = <o', o>, the value <o', q> / c estimates the inner product <o, q> without bias, and
bounds on it tell which pairs can reach the threshold: those, and only those, are computed again in double
precision from the vectors. Codes of further rotations are cut into bucket keys, so only vectors that agree on
a whole key in some table are compared; the number of tables follows from the recall asked for.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogue_etl.llm.common import block_rows, connected_components, drop, local_roots, materialize, run_starts, whole_runs

THRESHOLD = 0.95
#: A pair that is exactly at the threshold is missed with this probability, a closer one with less.
MISS = 1e-6
#: Standard deviations of the confidence bound.
SIGMAS = 5.0
SMALL_RUN = 24
PAIRS_AT_ONCE = 1 << 16


@lru_cache(maxsize=64)
def rotation(dim: int, k: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(1000 * dim + k).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def plan_tables(n: int, threshold: float, miss: float) -> tuple[int, int]:
    """(bits of a key, tables): keys grow with log n, so buckets stay small; tables keep the recall."""
    bits = min(60, max(12, math.ceil(math.log2(max(n, 2)))))
    agree = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-agree)))


def keys_of(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The bucket keys, one column a table."""
    n, dim = unit.shape
    turns = -(-bits * tables // dim)
    signs = np.concatenate([unit @ rotation(dim, k + 1).T >= 0 for k in range(turns)], axis=1)[:, : bits * tables]
    return signs.reshape(n, tables, bits) @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, dim, vec, digest, code, factor); all but the first two are null for vectors that can't link.

    vec holds the components in the input's own width; code is the packed signs of the rotated unit vector.
    """
    for batch in batches:
        width = "<f4" if pa.types.is_float32(batch.column(1).type.value_type) else "<f8"
        vectors = [np.asarray(x, np.float64) if x is not None and None not in x else None for x in batch.column(1).to_pylist()]
        good = np.array([x is not None and len(x) > 0 and bool(np.isfinite(x).all()) and bool(x.any()) and bool(np.isfinite(x @ x)) and bool(x @ x > 0) for x in vectors], bool)
        raw = [x.astype(width).tobytes() if g else None for x, g in zip(vectors, good)]
        dims = np.array([len(x) if g else 0 for x, g in zip(vectors, good)])
        code: list = [None] * len(raw)
        factor = np.full(len(raw), np.nan)
        for dim in np.unique(dims[good]):
            at = np.flatnonzero(good & (dims == dim))
            x = np.stack([vectors[k] for k in at])
            turned = x / np.linalg.norm(x, axis=1, keepdims=True) @ rotation(int(dim), 0).T
            factor[at] = np.abs(turned).sum(axis=1) / math.sqrt(dim)
            for k, bits in zip(at, np.packbits(turned >= 0, axis=1)):
                code[k] = bits.tobytes()
        digest = [hashlib.blake2b(x, digest_size=16).digest() if x else None for x in raw]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims, pa.int32()), pa.array(raw, pa.binary()), pa.array(digest, pa.binary()), pa.array(code, pa.binary()), pa.array(factor, mask=np.isnan(factor))], names=["id", "dim", "vec", "digest", "code", "factor"])


def _unit(column, dim: int) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    x = np.frombuffer(raw, "<f4" if len(raw) == 4 * dim * len(column) else "<f8").reshape(-1, dim).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _keyed(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                for part in _parts(batch.filter(pa.array(dims == dim)), 2000):
                    keys = keys_of(_unit(part.column("vec"), int(dim)), bits, tables)
                    n = len(keys)
                    ids = part.column("id").to_numpy()
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n * tables, dim), pa.int32()), pa.array(np.tile(np.arange(tables, dtype=np.int32), n)), pa.array(keys.reshape(-1)), pa.array(np.repeat(ids, tables))], names=["dim", "tab", "key", "id"])

    return run


def _parts(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def upper_bounds(code_dot: np.ndarray, factor: np.ndarray, dim: int) -> np.ndarray:
    """What <o, q> can be at most, given <o', q> and the factor of o: the unbiased estimate plus its
    confidence width, or the bound that always holds (o lies at a known angle from its code), if that is less."""
    spread = np.sqrt(np.maximum(1 - factor**2, 0)) / factor
    sure = code_dot * factor + np.sqrt(np.maximum(1 - code_dot**2, 0)) * np.sqrt(np.maximum(1 - factor**2, 0))
    beyond = np.arccos(np.clip(code_dot, -1, 1)) <= np.arccos(np.clip(factor, -1, 1))
    sure = np.where(beyond, 1.0, sure)
    return np.minimum(code_dot / factor + SIGMAS * spread / math.sqrt(max(dim - 1, 1)), sure)


def _compared(bits: int, tables: int, threshold: float):
    """Links inside every bucket: (id, links, root), links counting each pair in its first common table only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["dim", "tab", "key", "blk_i", "blk_j"]
        for table in whole_runs(batches, names):
            columns = [table.column(c).to_numpy() for c in names]
            ids, weight, blk, tab = (table.column(c).to_numpy() for c in ("id", "n", "blk", "tab"))
            split = columns[3] != columns[4]
            starts = run_starts(columns)
            ends = np.append(starts[1:], len(ids))
            found_i, found_j = [], []
            for dim in np.unique(columns[0]):
                own = np.flatnonzero(columns[0] == dim)
                part = table.slice(own[0], len(own))
                base, unit = own[0], _unit(part.column("vec"), int(dim))
                turned = unit @ rotation(int(dim), 0).T
                # Codes and factors as stored with the vectors.
                signs = np.unpackbits(np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(len(own), -1), axis=1, count=int(dim))
                code = (2.0 * signs - 1) / math.sqrt(dim)
                factor = part.column("factor").to_numpy()
                runs = [(a - base, z - base) for a, z in zip(starts, ends) if base <= a <= own[-1]]
                for i, j in _pairs(runs):
                    keep = ~split[i + base] | (blk[i + base] != blk[j + base])
                    i, j = i[keep], j[keep]
                    close = upper_bounds(np.einsum("ij,ij->i", code[i], turned[j]), factor[i], int(dim)) >= threshold - 1e-9
                    i, j = i[close], j[close]
                    exact = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
                    i, j = i[exact], j[exact]
                    if len(i):
                        involved = np.unique(np.concatenate([i, j]))
                        keys = keys_of(unit[involved], bits, tables)
                        a, b = keys[np.searchsorted(involved, i)], keys[np.searchsorted(involved, j)]
                        earliest = (a == b).argmax(axis=1) == tab[i + base]
                        found_i.append(i[earliest] + base)
                        found_j.append(j[earliest] + base)
            if not found_i:
                continue
            i, j = np.concatenate(found_i), np.concatenate(found_j)
            nodes, at = np.unique(ids[np.concatenate([i, j])], return_inverse=True)
            links = np.bincount(at, weights=np.concatenate([weight[j], weight[i]]), minlength=len(nodes)).astype(np.int64)
            root = nodes[local_roots(at[: len(i)], at[len(i) :], len(nodes))]
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(links), pa.array(root)], names=["id", "links", "root"])

    return run


def _pairs(runs: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of positions inside each run, in pieces of bounded size; short runs are taken together."""
    short = [(a, z) for a, z in runs if z - a <= SMALL_RUN]
    if short:
        at = np.concatenate([np.arange(a, z) for a, z in short])
        end = np.concatenate([np.full(z - a, z) for a, z in short])
        for step in range(1, SMALL_RUN):
            on = at + step < end
            at, end = at[on], end[on]
            if not len(at):
                break
            for k in range(0, len(at), PAIRS_AT_ONCE):
                yield at[k : k + PAIRS_AT_ONCE], at[k : k + PAIRS_AT_ONCE] + step
    for a, z in runs:
        if z - a > SMALL_RUN:
            rows = max(1, PAIRS_AT_ONCE // (z - a))
            for k in range(a, z - 1, rows):
                first = np.arange(k, min(k + rows, z - 1))
                i, j = np.meshgrid(first, np.arange(k + 1, z), indexing="ij")
                on = j > i
                yield i[on], j[on]


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """Returns (id, n_links, component_id, kept) for every row of vectors.

    Defined cases: a vector that is null, empty, zero or holds null or non-finite components links with
    nothing; so does a row with a null id (its component_id is null, kept is true); vectors of different
    lengths don't link; equal vectors under different ids link; rows that repeat an id and its vector count once.
    """
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    base = materialize(base.mapInArrow(_parsed, "id long, dim int, vec binary, digest binary, code binary, factor double"), "emb-base")
    usable = base.filter("id IS NOT NULL AND digest IS NOT NULL")
    # Equal vectors are one class with a weight, named by its smallest id.
    classes = usable.select("digest", "id").distinct().groupBy("digest").agg(F.min("id").alias("class_id"), F.count("*").alias("n"))
    classes = materialize(classes, "emb-classes")
    named = classes.select(F.col("digest").alias("d"), F.col("class_id").alias("c"), "n")
    reps = materialize(usable.join(named, (usable.digest == F.col("d")) & (usable.id == F.col("c"))).dropDuplicates(["id", "digest"]).select("id", "dim", "vec", "code", "factor", "n"), "emb-reps")
    bits, tables = plan_tables(reps.count(), threshold, miss)
    keyed = materialize(reps.select("id", "dim", "vec").mapInArrow(_keyed(bits, tables), "dim int, tab int, key long, id long"), "emb-keys")
    sizes = materialize(keyed.groupBy("dim", "tab", "key").agg(F.count("*").alias("bucket_size")).filter("bucket_size > 1"), "emb-sizes")
    rows = block_rows(keyed, sizes, ["dim", "tab", "key"], "id").join(reps.select("id", "vec", "code", "factor", "n"), "id")
    order = ["dim", "tab", "key", "blk_i", "blk_j"]
    rows = rows.repartition(*order).sortWithinPartitions(*order)
    links = materialize(rows.mapInArrow(_compared(bits, tables, threshold), "id long, links long, root long"), "emb-links")
    drop(keyed)
    comps = connected_components(links.select(F.col("id").alias("a"), F.col("root").alias("b")), "emb-cc")
    counted = links.groupBy("id").agg(F.sum("links").alias("links"))
    answer = classes.join(counted, F.col("class_id") == F.col("id"), "left").drop("id").join(comps, F.col("class_id") == F.col("node"), "left")
    answer = materialize(answer.select(F.col("digest").alias("d"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "class_id").alias("component")), "emb-answer")
    out = base.select("id", F.when(F.col("id").isNotNull(), F.col("digest")).alias("digest")).join(answer, F.col("digest") == F.col("d"), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op1_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """near_vectors() of all embeddings at cosine 0.95. Null, empty, zero and non-finite vectors link with nothing."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
ok AS (SELECT * FROM u WHERE n > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) >= 0.95 * a.n * b.n),
reach(id, r) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.a, reach.r FROM reach JOIN l ON l.b = reach.id),
c AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(k.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept FROM v JOIN c ON v.vec_id = c.id LEFT JOIN k ON v.vec_id = k.a
"""

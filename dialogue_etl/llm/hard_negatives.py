"""Hard negatives for each anchor and positive by a secondary sort.

Scores of (anchor, row) pairs become packed binary keys (anchor, descending score, positives before negatives, id)
whose byte order is the wanted order. Spark deals them by anchor and sorts them inside the partitions; an iterator
then reads the stream once: an anchor's first rows of its own label open a window of negative scores each, and every
row of another label is emitted into the windows that it lies in, until they are full. Nothing but the open windows
is held.

Scores are computed in blocks of anchors against blocks of rows. Of a block only rows that can be among the first of
a window go into the sort: the block's own first positives, and in a second pass, when the anchors' positives are
known, the block's own first negatives of each window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialogue_etl.llm.common import materialize, run_starts, whole_runs

#: Positives of an anchor, and negatives of a positive.
POSITIVES, NEGATIVES = 5, 10
#: Percent of the positive's score that a negative's score may have.
LOW, HIGH = 30, 90
#: Components are counted in this part of a unit.
SCALE = 256
#: Anchors and rows of one block, about.
BLOCK_ANCHORS, BLOCK_ROWS = 2048, 8192
#: Scores are whole numbers of 64 bits, 100 times over: a row whose own product with itself could pass this takes no part.
MOST = 1 << 56
#: Scores that are computed at once.
SCORES_AT_ONCE = 1 << 22
#: Doubles hold whole numbers up to this.
EXACT = 1 << 53

_TOP = np.uint64(1 << 63)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, dim, vec): whole components as 8-byte little-endian integers; rows that take no part are left out."""
    for batch in batches:
        lists = batch.column(2)
        vectors = [np.asarray(x, np.float64) if x is not None and None not in x else None for x in lists.to_pylist()]
        ok, raw = [], []
        for k, x in enumerate(vectors):
            if x is None or not np.isfinite(x).all():
                continue
            whole = np.floor(SCALE * x)
            if not len(x) or len(x) * float(np.abs(whole).max()) ** 2 < MOST:
                ok.append(k)
                raw.append(whole.astype("<i8").tobytes())
        at = pa.array(ok, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([len(x) // 8 for x in raw], pa.int32()), pa.array(raw, pa.binary())], names=["id", "label", "dim", "vec"])


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), dim)


def _products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact whole inner products: in doubles where they hold every partial sum, else in 64-bit integers."""
    if not anchors.shape[1]:
        return np.zeros((len(anchors), len(rows)), np.int64)
    most = float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0)) * anchors.shape[1]
    if most < EXACT:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return anchors @ rows.T


def _big_endian(x: np.ndarray) -> np.ndarray:
    """Eight bytes a number, in the numbers' order."""
    return (x.astype(np.int64).view(np.uint64) ^ _TOP).astype(">u8").view(np.uint8).reshape(-1, 8)


def packed(anchor: np.ndarray, anchor_row: np.ndarray, score: np.ndarray, other: np.ndarray, ids: np.ndarray, row: np.ndarray) -> list[bytes]:
    """Keys whose byte order is: anchor, its row, score from the highest, positives first, id, row."""
    out = np.empty((len(anchor), 41), np.uint8)
    out[:, :8], out[:, 8:16], out[:, 16:24] = _big_endian(anchor), _big_endian(anchor_row), _big_endian(-score)
    out[:, 24], out[:, 25:33], out[:, 33:] = other, _big_endian(ids), _big_endian(row)
    whole = out.tobytes()
    return [whole[k : k + 41] for k in range(0, len(whole), 41)]


def unpacked(keys: list[bytes]) -> tuple[np.ndarray, ...]:
    """(anchor, its row, score, 1 for a negative, id) of packed keys."""
    x = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 41)
    number = [(np.ascontiguousarray(x[:, a : a + 8]).view(">u8").reshape(-1).astype(np.uint64) ^ _TOP).view(np.int64) for a in (0, 8, 16, 25)]
    return number[0], number[1], -number[2], x[:, 24], number[3]


def _first(scores: np.ndarray, ok: np.ndarray, most: int) -> np.ndarray:
    """Positions of the `most` highest scores where ok, the earlier of equal ones first."""
    at = np.flatnonzero(ok)
    if len(at) > most:
        s = scores[at]
        at = at[s >= np.partition(s, len(s) - most)[len(s) - most]]
    return at[np.argsort(-scores[at], kind="stable")[:most]]


def _block(negatives: bool, positives: int, keep: int, low: int, high: int):
    """Of every block of anchors and rows, the packed keys of rows that can be among the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["dim", "own", "ab", "rb"]
        for table in whole_runs(batches, names):
            starts = run_starts([table.column(c).to_numpy() for c in names])
            for a, z in zip(starts, np.append(starts[1:], table.num_rows)):
                part = table.slice(a, z - a)
                is_anchor = part.column("anchor").to_numpy(zero_copy_only=False)
                n = int(is_anchor.sum())  # anchors come first, rows by id
                if n in (0, len(is_anchor)):
                    continue
                dim = int(part.column("dim")[0].as_py())
                id_, row, label = (part.column(c).to_numpy() for c in ("id", "row", "label"))
                left, right = _matrix(part.column("vec").slice(0, n), dim), _matrix(part.column("vec").slice(n), dim)
                floors = part.column("positive_scores").slice(0, n).to_pylist() if negatives else None
                size = max(1, SCORES_AT_ONCE // len(right))
                found: list[tuple[int, np.ndarray, np.ndarray]] = []
                for k in range(0, n, size):
                    for j, s in enumerate(_products(left[k : k + size], right), k):
                        if negatives:
                            apart, hundred = label[n:] != label[j], 100 * s
                            best = [_first(s, apart & (hundred >= low * p) & (hundred <= high * p), keep) for p in sorted(set(floors[j]))]
                            best = np.unique(np.concatenate(best))
                        else:
                            best = _first(s, row[n:] != row[j], positives)
                        if len(best):
                            found.append((j, best, s[best]))
                if not found:
                    continue
                j, best, score = np.repeat([f[0] for f in found], [len(f[1]) for f in found]), np.concatenate([f[1] for f in found]) + n, np.concatenate([f[2] for f in found])
                keys = packed(id_[j], row[j], score, np.full(len(j), int(negatives), np.uint8), id_[best], row[best])
                yield pa.RecordBatch.from_arrays([pa.array(id_[j]), pa.array(row[j]), pa.array(keys, pa.binary())], names=["anchor_id", "anchor_row", "key"])

    return run


def windows(keys: Iterator[list[bytes]], positives: int = POSITIVES, keep: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> Iterator[list[tuple]]:
    """Reads packed keys in order and yields, for each piece of the stream, the rows
    (anchor_id, anchor_row, positive_id, positive_nth, rank, negative_id, positive_score, negative_score).

    The first positives of an anchor open windows. A window's scores lie at or below its positive's, and of equal
    scores positives come first, so a window is open before its first negative arrives.
    """
    now, opened, seen = None, [], 0
    for piece in keys:
        out = []
        for anchor, row, score, other, id_ in zip(*(x.tolist() for x in unpacked(piece))):
            if (anchor, row) != now:
                now, opened, seen = (anchor, row), [], 0
            if not other:
                seen += 1
                if seen <= positives:
                    opened.append([id_, score, 0, seen])
                continue
            for w in opened:
                if w[2] < keep and low * w[1] <= 100 * score <= high * w[1]:
                    w[2] += 1
                    out.append((anchor, row, w[0], w[3], w[2], id_, w[1], score))
        yield out


_OUT = ["anchor_id", "anchor_row", "positive_id", "positive_nth", "rank", "negative_id", "positive_score", "negative_score"]
_OUT_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def _streamed(positives: int, keep: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in windows((b.column("key").to_pylist() for b in batches if b.num_rows), positives, keep, low, high):
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _OUT_TYPES)], names=_OUT)

    return run


def _positive_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The scores in the keys of every anchor's positives."""
    for batch in batches:
        lists = [unpacked(x)[2].tolist() for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int64()))], names=["anchor_id", "anchor_row", "positive_scores"])


def _blocks(anchors: DataFrame, rows: DataFrame, by_label: bool, block_anchors: int, block_rows: int) -> DataFrame:
    """Anchors and rows of one length, and of one label if asked, dealt into blocks that meet pairwise; sorted with
    the anchors of a block first. A large group has many blocks, so no group has to fit into one task."""
    keys = ["dim", "own"]
    own = F.col("label").cast("long") if by_label else F.lit(0).cast("long")
    anchors, rows = anchors.withColumn("own", own).withColumn("anchor", F.lit(True)), rows.withColumn("own", own).withColumn("anchor", F.lit(False))
    sizes = anchors.groupBy(*keys).agg(F.ceil(F.count("*") / block_anchors).cast("int").alias("n_ab"))
    sizes = materialize(sizes.join(rows.groupBy(*keys).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("n_rb")), keys), "neg-sizes")
    place = F.xxhash64("row")
    dealt = []
    for side, own_block, own_n, other, other_n in ((anchors, "ab", "n_ab", "rb", "n_rb"), (rows, "rb", "n_rb", "ab", "n_ab")):
        side = side.join(sizes, keys).withColumn(own_block, F.pmod(place, F.col(own_n)).cast("int"))
        dealt.append(side.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1))).drop("n_ab", "n_rb"))
    both = dealt[0].unionByName(dealt[1], allowMissingColumns=True)
    order = [*keys, "ab", "rb"]
    return both.repartition(*order).sortWithinPartitions(*order, F.desc("anchor"), "id", "row")


def hard_negatives(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", anchor=None, positives: int = POSITIVES, keep: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, block_anchors: int = BLOCK_ANCHORS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Returns (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where the
    condition `anchor` on (id, label) holds; every hundredth id without one.

    Scores are inner products of floor(256 * component). An anchor's positives are its first rows of the same label,
    a positive's negatives the first rows of other labels with low * positive <= 100 * negative <= high * positive;
    first are higher scores, of equal ones smaller ids.

    Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; nor do
    rows whose length times its largest squared component reaches 2**56, where scores could leave 64 bits. Only
    vectors of one length have a score; empty vectors have the score 0 with each other. Rows that repeat an id are
    rows of their own, as anchors too. An anchor without positives, or a positive without negatives, has no row.
    """
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("v")).filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    base = materialize(base.mapInArrow(_parsed, "id long, label long, dim int, vec binary").withColumn("row", F.monotonically_increasing_id()), "neg-base")
    anchors = base.filter(F.col("id") % 100 == 0 if anchor is None else anchor)
    key_type = "anchor_id long, anchor_row long, key binary"
    near = _blocks(anchors, base, True, block_anchors, block_rows).mapInArrow(_block(False, positives, keep, low, high), key_type)
    # The first positives over all blocks: the smallest keys, as the key's order is the rows' order.
    nth = F.row_number().over(Window.partitionBy("anchor_id", "anchor_row").orderBy("key"))
    near = near.withColumn("nth", nth).filter(F.col("nth") <= positives).groupBy("anchor_id", "anchor_row").agg(F.collect_list("key").alias("keys"))
    near = materialize(near, "neg-positives")
    scored = near.mapInArrow(_positive_scores, "anchor_id long, anchor_row long, positive_scores array<long>").withColumnsRenamed({"anchor_id": "id", "anchor_row": "row"})
    far = _blocks(anchors.join(scored, ["id", "row"]), base, False, block_anchors, block_rows).mapInArrow(_block(True, positives, keep, low, high), key_type)
    stream = near.select("anchor_id", "anchor_row", F.explode("keys").alias("key")).unionByName(far)
    stream = stream.repartition("anchor_id", "anchor_row").sortWithinPartitions("key")
    return stream.mapInArrow(_streamed(positives, keep, low, high), "anchor_id long, anchor_row long, positive_id long, positive_nth int, rank int, negative_id long, positive_score long, negative_score long")


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """hard_negatives() of all embeddings, anchors being every hundredth id, after the label of every seventh id has
    become the next one. Rows with a null id, label, vector or component, or a non-finite one, take no part."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives(rows).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
pos AS (SELECT * FROM (SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth FROM p WHERE label = anchor_label) WHERE nth <= 5),
neg AS (SELECT pos.anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score, row_number() OVER (PARTITION BY pos.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM pos JOIN p ON pos.anchor_id = p.anchor_id WHERE label <> anchor_label AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 10
"""

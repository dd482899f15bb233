"""Quality classifier by co-training.

Two logistic regressions see different sides of a document: its text (hashed byte trigrams, repeated words and
shares of characters) and its page metadata (language, source, size, number of lines). Over some rounds each
labels the documents it is sure of, among all without a label, for the other; then each view is calibrated on
held-out labels and the calibrated log-odds are combined by a last regression on the same held-out rows. All
documents are scored, whole, in one pass without a shuffle.

A fit is a few Newton steps. A step is one pass over the features, which are computed once: every task adds up
its rows' gradient and Hessian, and the sums are added again in about the square root of as many tasks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogue_etl.llm.common import drop, materialize
from dialogue_etl.llm.textkit import NOT_SPACE, slices, span_hashes, word_spans

GRAMS, LANGS, SOURCES = 128, 8, 32
#: The text view also has the shares of words that repeat the word one, two or three places before.
REPEATS = 3
TEXT_DIMS, META_DIMS = GRAMS + REPEATS + 6, 4 + LANGS + SOURCES
#: The classifier is fitted on about this many labelled documents; all unlabelled ones are the pool.
MAX_LABELLED = 20_000
ROUNDS, STEPS = 2, 8
#: A view labels a pool document for the other view if it is this sure.
SURE = 0.95
#: What all pseudo-labels of a fit weigh against all its labels.
POOL_WEIGHT = 0.5
REG = 1e-4


@dataclass
class Model:
    """Weights of both views, their calibration (slope, intercept) and the combination; None: no usable labels."""

    text: tuple[np.ndarray, float]
    meta: tuple[np.ndarray, float]
    calibrate_text: tuple[float, float]
    calibrate_meta: tuple[float, float]
    combine: tuple[float, float, float]


def _hot(values: list, dims: int) -> np.ndarray:
    known: dict = {}
    out = np.zeros((len(values), dims), np.float32)
    for k, v in enumerate(values):
        if v not in known:
            known[v] = zlib.crc32(str(v).encode("utf-8", "replace")) % dims
        out[k, known[v]] = v is not None
    return out


def features(text: pa.Array, lang: pa.Array, source: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, text view, metadata view) of pieces of a batch."""
    langs, sources = _hot(lang.to_pylist(), LANGS), _hot(source.to_pylist(), SOURCES)
    for a, z, data, ends in slices(text):
        n, size = z - a, np.diff(ends)
        owner = np.repeat(np.arange(n), size)
        view = np.zeros((n, GRAMS), np.float32)
        if len(data) > 2:
            wide = data.astype(np.uint32)
            gram = (wide[:-2] * np.uint32(2654435761) + wide[1:-1] * np.uint32(40503 * 65537) + wide[2:] * np.uint32(2246822519)) >> np.uint32(25)
            inside = owner[:-2] == owner[2:]
            counts = np.bincount(owner[:-2][inside] * GRAMS + gram[inside].astype(np.int64), minlength=n * GRAMS).reshape(n, GRAMS)
            view = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float32)
        starts, stops, first = word_spans(data, ends, NOT_SPACE)
        words = np.diff(first)
        h, doc = span_hashes(data, starts, stops), np.repeat(np.arange(n), words)
        again = [np.bincount(doc[k:][(h[k:] == h[:-k]) & (doc[k:] == doc[:-k])], minlength=n) / np.maximum(words, 1) for k in range(1, REPEATS + 1)]

        def count(mask: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(mask[data])])
            return total[ends[1:]] - total[ends[:-1]]

        shares = [count(m) / np.maximum(size, 1) for m in (_UPPER, _DIGIT, _PUNCT, _SPACE, _HIGH)]
        view = np.concatenate([view, np.sqrt(np.stack(again, axis=1)), np.stack([size / np.maximum(words, 1) / 10, *shares], axis=1)], axis=1).astype(np.float32)
        lines = count(_LINE) + 1
        shape = np.stack([np.log1p(size), np.log1p(lines), np.log1p(size / lines), size == 0], axis=1).astype(np.float32)
        yield a, z, view, np.concatenate([shape, langs[a:z], sources[a:z]], axis=1)


def _mask(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, z in ranges:
        out[a : z + 1] = True
    return out


_UPPER, _DIGIT, _LINE, _SPACE, _HIGH = _mask((65, 90)), _mask((48, 57)), _mask((10, 10)), _mask((32, 32)), _mask((128, 255))
_PUNCT = _mask((33, 47), (58, 64), (91, 96), (123, 126))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, z, *views in features(*(batch.column(c) for c in ("text", "lang", "source"))):
            raw = [pa.array([row.tobytes() for row in v.astype("<f4")], pa.binary()) for v in views]
            yield pa.RecordBatch.from_arrays([batch.column("y").slice(a, z - a), batch.column("fold").slice(a, z - a), *raw], names=["y", "fold", "text_view", "meta_view"])


VIEWS = (("text_view", TEXT_DIMS), ("meta_view", META_DIMS))


def _matrices(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Both views of a batch, with a column of ones."""
    views = [np.frombuffer(b"".join(batch.column(c).to_pylist()), "<f4").reshape(-1, d) for c, d in VIEWS]
    return [np.concatenate([v, np.ones((len(v), 1), np.float32)], axis=1).astype(np.float64) for v in views]


def _summed(rows: DataFrame, size: int, add) -> np.ndarray:
    """The sum over all batches of the vectors add(batch), each of `size` numbers, added up in two levels of tasks."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += add(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for raw in batch.column("total").to_pylist():
                total += np.frombuffer(raw)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    sums = rows.mapInArrow(partial, "total binary")
    tasks = max(1, math.isqrt(rows.rdd.getNumPartitions()))
    return np.sum([np.frombuffer(r[0]) for r in sums.repartition(tasks).mapInArrow(again, "total binary").collect()], axis=0)


def _step_sums(models: list[np.ndarray], scales: list[np.ndarray], teachers: list[np.ndarray] | None):
    """add() for _summed(): for both views the gradient, Hessian and number of rows, of labels and pseudo-labels apart."""
    odds = math.log(SURE / (1 - SURE))

    def add(batch: pa.RecordBatch) -> np.ndarray:
        raw = _matrices(batch)
        fold, y = batch.column("fold").to_numpy(), batch.column("y").to_numpy(zero_copy_only=False)
        out = []
        for k in (0, 1):
            # A view learns pseudo-labels from the other one.
            margin = raw[1 - k] @ teachers[1 - k] if teachers else np.zeros(len(fold))
            for taught in (False, True):
                on = (fold < 0) & (np.abs(margin) >= odds) if taught else fold > 0
                x, t = raw[k][on] / scales[k], (margin[on] > 0) if taught else y[on]
                p = _sigmoid(x @ models[k])
                out += [x.T @ (p - t), ((x.T * (p * (1 - p))) @ x).reshape(-1), [len(x)]]
        return np.concatenate(out)

    return add


def _fit(rows: DataFrame, scales: list[np.ndarray], models: list[np.ndarray], teachers: list[np.ndarray] | None) -> list[np.ndarray]:
    """Both views' weights on scaled features after Newton steps from `models`, fitted in the same passes."""
    sizes = [d + 1 for _, d in VIEWS]
    models = [m.copy() for m in models]
    for _ in range(STEPS):
        total, at, moved = _summed(rows, sum(2 * (d + d * d + 1) for d in sizes), _step_sums(models, scales, teachers)), 0, 0.0
        for k, d in enumerate(sizes):
            parts = []
            for _ in range(2):
                parts.append((total[at : at + d], total[at + d : at + d + d * d].reshape(d, d), total[at + d + d * d]))
                at += d + d * d + 1
            (g, h, n), (g_pool, h_pool, n_pool) = parts
            weight = POOL_WEIGHT * n / n_pool if n_pool else 0.0
            own = np.append(np.full(d - 1, REG), 0.0)
            rows_seen = n + weight * n_pool
            g, h = (g + weight * g_pool) / rows_seen + own * models[k], (h + weight * h_pool) / rows_seen + np.diag(own + 1e-9)
            step = np.linalg.solve(h, g)
            step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
            models[k] -= step
            moved = max(moved, float(np.abs(step).max()))
        if moved < 1e-3:
            break
    return models


def _logistic(x: np.ndarray, y: np.ndarray, reg: float = 1e-3) -> np.ndarray:
    """Weights and intercept of a regression on a few columns of held-out rows."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w, own = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, reg), 0.0)
    for _ in range(25):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x / len(x) + np.diag(own + 1e-9), x.T @ (p - y) / len(x) + own * w)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
    return w


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS) -> Model | None:
    """Fits the model; None if the labels don't hold both classes.

    Labelled rows with a null label or id don't count; an id that is labelled several times has its lowest label.
    About max_labelled labelled documents, chosen by the hash of the id, are fitted on or held out; a labelled
    document beyond them is in the pool like one without a label.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).filter("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.min("y").alias("y"))
    n_labelled = marks.count()
    if n_labelled > max_labelled:
        marks = marks.filter(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 20)) < int((1 << 20) * max_labelled / n_labelled))
    chosen = materialize(marks.withColumn("fold", F.pmod(F.xxhash64("id", F.lit(11)), F.lit(4)).cast("int")), "quality-labels")
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[(F.col(c) if c in docs.columns else F.lit(None)).cast("string").alias(c) for c in ("lang", "source")])
    # The chosen labels are few by max_labelled, so they meet the texts without a shuffle of texts.
    rows = base.join(F.broadcast(chosen), "id", "left").select("text", "lang", "source", "y", F.coalesce("fold", F.lit(-1)).alias("fold"))
    table = materialize(rows.mapInArrow(_featured, "y double, fold int, text_view binary, meta_view binary"), "quality-features")
    # Fitted on, and held out, at least once in each class.
    classes = {(r[0], r[1]) for r in table.filter("fold >= 0").select((F.col("fold") > 0).alias("f"), "y").distinct().collect()}
    if len(classes) < 4:
        drop(table)
        drop(chosen)
        return None
    known = materialize(table.filter("fold >= 0").coalesce(8), "quality-known")

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        on = batch.column("fold").to_numpy() > 0
        return np.concatenate([f(x[on]) for x in _matrices(batch) for f in (lambda v: v.sum(axis=0), lambda v: (v * v).sum(axis=0))])

    sizes = [d + 1 for _, d in VIEWS]
    parts = np.split(_summed(known, 2 * sum(sizes), moments), np.cumsum([sizes[0], sizes[0], sizes[1]]))
    scales = []
    for first, second in (parts[:2], parts[2:]):
        deviation = np.sqrt(np.maximum(second / first[-1] - (first / first[-1]) ** 2, 0))
        scales.append(np.where(deviation > 1e-6, deviation, 1.0))
    views = _fit(known, scales, [np.zeros(d) for d in sizes], None)
    for _ in range(rounds):
        views = _fit(table.filter("fold <> 0"), scales, views, [w / s for w, s in zip(views, scales)])
    raw = [w / s for w, s in zip(views, scales)]
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = [x @ w for x, w in zip(_matrices(batch), shared.value)]
                yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(m[0]), pa.array(m[1])], names=["y", "m_text", "m_meta"])

    # Held-out rows: a quarter of the chosen labels, three numbers each.
    held = known.filter("fold = 0").mapInArrow(margins, "y double, m_text double, m_meta double").toPandas()
    y = held["y"].to_numpy()
    slopes = [_logistic(held[[m]].to_numpy(), y) for m in ("m_text", "m_meta")]
    calibrated = np.stack([held[m].to_numpy() * w[0] + w[1] for m, w in zip(("m_text", "m_meta"), slopes)], axis=1)
    both = _logistic(calibrated, y)
    for used in (table, known, chosen):
        drop(used)
    return Model((raw[0][:-1], float(raw[0][-1])), (raw[1][:-1], float(raw[1][-1])), tuple(map(float, slopes[0])), tuple(map(float, slopes[1])), tuple(map(float, both)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def probabilities(model: Model | None, text: pa.Array, lang: pa.Array, source: pa.Array) -> np.ndarray:
    """Rows of (text view, metadata view, combined) probabilities that a document is good; all 1 without a model."""
    out = np.ones((len(text), 3))
    if model is None:
        return out
    for a, z, view, meta in features(text, lang, source):
        t = (view @ model.text[0] + model.text[1]) * model.calibrate_text[0] + model.calibrate_text[1]
        m = (meta @ model.meta[0] + model.meta[1]) * model.calibrate_meta[0] + model.calibrate_meta[1]
        out[a:z] = _sigmoid(np.stack([t, m, model.combine[0] * t + model.combine[1] * m + model.combine[2]], axis=1))
    return out


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(name).cast(pa.string()) if name in batch.schema.names else pa.nulls(batch.num_rows, pa.string())


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, **bounds) -> DataFrame:
    """Returns (id, p_text, p_meta, score, keep) for every row of docs.

    A null or empty text has the features of an empty one; null language and source have features of their
    own; null ids are scored too; equal rows score alike. Without labels of both classes every score is 1.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, **bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = probabilities(shared.value, batch.column("text"), batch.column("lang"), batch.column("source"))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(p[:, k]) for k in range(3)), pa.array(p[:, 2] >= threshold)], names=["id", "p_text", "p_meta", "score", "keep"])

    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[(F.col(c) if c in docs.columns else F.lit(None)).cast("string").alias(c) for c in ("lang", "source")])
    out = base.mapInArrow(run, f"id {dict(base.dtypes)['id']}, p_text double, p_meta double, score double, keep boolean")
    return out.withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, **bounds) -> DataFrame:
    """The rows of docs that the classifier doesn't reject, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, **bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = probabilities(shared.value, batch.column(text_col), _column(batch, "lang"), _column(batch, "source"))
            yield batch.filter(pa.array(p[:, 2] >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op7_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from the labels of some. Null and empty texts have the features of an
    empty one, null language and source none; null ids are scored too; equal rows score alike."""
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))

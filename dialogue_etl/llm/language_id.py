"""Language identification by nearest centroids of TF-IDF n-gram vectors.

Texts are lower-cased, everything ASCII that is no letter is a space, and byte n-grams of two and three bytes
are hashed into DIMS coordinates, weighted by square-root term frequency and inverse document frequency, and
scaled to unit length. Every language has several centroids by spherical k-means; the nearest by cosine
predicts, and a text farther from it than nearly all of its training texts is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogue_etl.llm.common import materialize

DIMS = 4096
CENTROIDS = 4
#: Centroids are fitted on about this many labelled texts a language; document frequencies use all of them.
MAX_PER_LANG = 800
#: The share of training texts that a centroid's rejection distance leaves out.
REJECT_SHARE = 0.005
UNKNOWN = "und"
TEXTS_AT_ONCE, BYTES_AT_ONCE = 200, 1 << 20

_LETTER = regex.compile(r"\p{L}")
_KEEP = np.full(256, 0x20, np.uint8)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def counts(texts: list[str]) -> np.ndarray:
    """Hashed n-gram counts, one row a text."""
    low = [f" {t.lower()} ".encode("utf-8", "replace") for t in texts]
    data = _KEEP[np.frombuffer(b"".join(low), np.uint8)].astype(np.uint32)
    owner = np.repeat(np.arange(len(low)), [len(x) for x in low])
    out = np.zeros(len(low) * DIMS)
    if len(data) > 2:
        blank = data == 0x20
        for width, gram in ((2, data[:-1] * np.uint32(40503) + data[1:]), (3, (data[:-2] * np.uint32(40503) + data[1:-1]) * np.uint32(40503) + data[2:] + np.uint32(977))):
            n = len(gram)
            bucket = (gram * np.uint32(2654435761)) >> np.uint32(20)
            on = (owner[:n] == owner[width - 1 :]) & ~(blank[:n] & blank[1 : n + 1])
            out += np.bincount(owner[:n][on] * DIMS + bucket[on].astype(np.int64), minlength=len(out))
    return out.reshape(len(low), DIMS)


def pieces(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Pieces of a batch of bounded size, whole texts each."""
    a = size = 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if k - a + 1 >= TEXTS_AT_ONCE or size >= BYTES_AT_ONCE:
            yield a, [x or "" for x in texts[a : k + 1]]
            a, size = k + 1, 0
    if a < len(texts):
        yield a, [x or "" for x in texts[a:]]


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts(texts)) * idf
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(DIMS + 1, np.int64), 0
    for batch in batches:
        for _, texts in pieces(batch.column("text").to_pylist()):
            total[:DIMS] += (counts(texts) > 0).sum(axis=0)
            n += len(texts)
    total[DIMS] = n
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1), pa.int32()), pa.array(total)], names=["dim", "n"])


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids, and each row's cosine to its own; starts far apart, so reruns agree."""
    chosen = [x.mean(axis=0)]
    near = x @ chosen[0]
    centres = []
    for _ in range(min(k, len(x))):
        centres.append(x[int(near.argmin())])
        near = np.maximum(near, x @ centres[-1]) if len(centres) > 1 else x @ centres[-1]
    c = np.stack(centres)
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        for j in range(len(c)):
            if (own == j).any():
                c[j] = x[own == j].sum(axis=0)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c, own


def fold_of(id_col: str) -> Column:
    """crc32 of the id as text, modulo 4; 2 is held out. A null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4))


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, max_per_lang: int = MAX_PER_LANG, k: int = CENTROIDS):
    """(idf, languages, centroids, least cosine by centroid) learned from the labelled texts that aren't held out."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter((fold_of("id") != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("lang") != UNKNOWN))
    got = rows.select("text").mapInArrow(_frequencies, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(DIMS + 1)
    total[got["dim"]] = got["n"]
    if not total[DIMS]:
        return np.ones(DIMS), [], np.zeros((0, DIMS), np.float32), np.zeros(0)
    idf = np.log((1 + total[DIMS]) / (1 + total[:DIMS])) + 0.1
    # The first texts of each language by a hash of id and text: twice as many as wanted by a threshold on the hash,
    # and the very first in any case, then the wanted number of these, however many rows share a hash.
    hashed = rows.withColumn("place", F.pmod(F.xxhash64("id", "text", F.lit(5)), F.lit(1 << 40)))
    by_lang = hashed.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("least")).select(F.col("lang").alias("l"), F.greatest("least", F.least(F.lit(1.0), F.lit(2.0 * max_per_lang) / F.col("n")) * (1 << 40)).alias("most"))
    near = hashed.join(materialize(by_lang, "lang-counts"), F.col("lang") == F.col("l")).filter(F.col("place") <= F.col("most"))
    sample = near.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("place", "text"))).filter(F.col("nth") <= max_per_lang)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("nth")
        x = np.concatenate([vectors(t, idf) for _, t in pieces(part["text"].tolist())])
        c, own = spherical_kmeans(x, k)
        near = np.einsum("ij,ij->i", x, c[own])
        least = [float(np.quantile(near[own == j], REJECT_SHARE)) if (own == j).any() else 1.0 for j in range(len(c))]
        return pd.DataFrame({"lang": part["lang"].iloc[0], "centre": [y.astype(np.float32).tobytes() for y in c], "least": least})

    # One row a centroid: as many as there are languages times k.
    fitted = sample.select("nth", "lang", "text").groupBy("lang").applyInPandas(fit, "lang string, centre binary, least double").orderBy("lang", "centre").toPandas()
    centres = np.stack([np.frombuffer(x, np.float32) for x in fitted["centre"]])
    return idf, fitted["lang"].tolist(), centres, fitted["least"].to_numpy()


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **bounds) -> DataFrame:
    """Returns (id, held_out, lang_pred, score, rejected) for every row of docs.

    A null text and one without any letter is `und` with score 0, and rejected. Otherwise the nearest
    centroid's language is given with its cosine; rejected says that it is farther than that centroid's
    training texts. Without any labelled text all is `und`. Rows are judged one by one, repeats alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, id_col, text_col, lang_col, **bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, langs, centres, least = shared.value
        for batch in batches:
            raw = batch.column("text").to_pylist()
            pred, score, far = [UNKNOWN] * len(raw), np.zeros(len(raw)), np.ones(len(raw), bool)
            for a, texts in pieces(raw) if langs else ():
                cosine = vectors(texts, idf) @ centres.T
                best = cosine.argmax(axis=1)
                for k, t in enumerate(texts):
                    if _LETTER.search(t):
                        c = float(min(max(cosine[k, best[k]], 0.0), 1.0))
                        pred[a + k], score[a + k], far[a + k] = langs[best[k]], c, c < least[best[k]]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(pred, pa.string()), pa.array(score), pa.array(far)], names=["id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (fold_of(id_col) == 2).alias("held_out"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, held_out boolean, lang_pred string, score double, rejected boolean").withColumnRenamed("id", id_col)


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those that aren't held out. A null text and one without a letter is
    `und` with score 0; rows that repeat an id are judged one by one; a null id counts as the empty text in the fold."""
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The alphabet is words. All windows of one length form a pattern set: a shift table over hashed blocks of two
words says how far a position can be skipped, a suffix bucket by the hash of the window's last block selects
test strings, and the words themselves are compared before an occurrence counts. Benchmarks larger than
MAX_WINDOWS are searched in blocks of items, one pass a block, so what is broadcast has a fixed bound.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogue_etl.llm.common import free_name, materialize
from dialogue_etl.llm.textkit import ALNUM, combine, slices, span_hashes, word_spans

WINDOW = 13
#: Windows searched for, and so broadcast, in one pass: about 300 bytes each.
MAX_WINDOWS = 500_000
#: Bits of the shift table's slots: by the number of blocks of two words, between these.
LEAST_BITS, MOST_BITS = 12, 24

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def item_words(text: str | None) -> list[bytes]:
    column = pa.array([text or ""])
    words: list[bytes] = []
    for _, _, data, ends in slices(column):
        starts, stops, _ = word_spans(data, ends, ALNUM)
        folded = _FOLD[data].tobytes()
        words += [folded[a:z] for a, z in zip(starts, stops)]
    return words


class Patterns:
    """The windows of one length: shift table, suffix buckets and the test strings."""

    def __init__(self, length: int, windows: dict[bytes, list[int]]):
        self.length, self.block = length, min(2, length)
        self.items = windows
        # Four slots for every block keep most of them empty, so positions are still skipped with many windows.
        blocks = max(1, len(windows)) * (length - self.block + 1)
        self.bits = min(MOST_BITS, max(LEAST_BITS, (4 * blocks).bit_length()))
        self.shift = np.full(1 << self.bits, length - self.block + 1, np.uint8 if length < 256 else np.int64)
        ends = []
        for text in windows:
            words = text.split(b" ")
            data = np.frombuffer(text, np.uint8)
            stops = np.cumsum([len(w) + 1 for w in words]) - 1
            h = span_hashes(data, np.concatenate([[0], stops[:-1] + 1]), stops)
            slot = self.slots(h)
            for k in range(len(slot)):
                self.shift[slot[k]] = min(self.shift[slot[k]], len(slot) - 1 - k)
            ends.append(combine(h[-1:], h[:1])[0])
        self.suffixes = np.unique(np.array(ends, np.uint64))

    def slots(self, h: np.ndarray) -> np.ndarray:
        """The table's slot of the block that starts at each word of a window."""
        x = combine(h[:-1], h[1:]) if self.block == 2 else h
        return (x >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Candidate start words of occurrences: every text (words first[k]..first[k + 1]) has a cursor that skips."""
        m, b = self.length, self.block
        n = np.diff(first)
        if len(h) < m:
            return np.zeros(0, np.int64)
        # Cursors stand on the last word of a window; long texts get one for every stretch of words.
        counts = np.maximum(n - m + 1, 0)
        pieces = -(-counts // 256)
        which = np.repeat(np.arange(len(n)), pieces)
        piece = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = first[:-1][which] + m - 1 + piece * 256
        limit = np.minimum(at + 256, first[1:][which])
        found = []
        while len(at):
            block = combine(h[at - 1], h[at]) if b == 2 else h[at]
            step = self.shift[(block >> np.uint64(64 - self.bits)).astype(np.int64)]
            hit = step == 0
            if hit.any():
                last = at[hit]
                near = combine(h[last], h[last - m + 1])
                spot = np.searchsorted(self.suffixes, near)
                spot[spot == len(self.suffixes)] = 0
                found.append(last[self.suffixes[spot] == near] - m + 1)
            at = at + np.maximum(step, 1).astype(np.int64)
            on = at < limit
            at, limit = at[on], limit[on]
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def build(rows: list[tuple[int, str]], window: int) -> list[Patterns]:
    by_length: dict[int, dict[bytes, list[int]]] = defaultdict(lambda: defaultdict(list))
    for item, text in rows:
        words = item_words(text)
        m = min(window, len(words))
        for k in range(len(words) - m + 1 if m else 0):
            by_length[m][b" ".join(words[k : k + m])].append(item)
    return [Patterns(m, {t: sorted(set(i)) for t, i in w.items()}) for m, w in sorted(by_length.items())]


def _scan(sets: list[Patterns], column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, dict, dict]]:
    """(first row, end row, words of each text, spans by row, items by row) of pieces of a batch."""
    for a, z, data, ends in slices(column):
        starts, stops, first = word_spans(data, ends, ALNUM)
        h = span_hashes(data, starts, stops)
        items: dict[int, set[int]] = defaultdict(set)
        spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for p in sets:
            for w in p.find(h, first).tolist():
                got = p.items.get(b" ".join(_FOLD[data[starts[k] : stops[k]]].tobytes() for k in range(w, w + p.length)))
                if got is not None:
                    doc = int(np.searchsorted(first, w, "right")) - 1
                    items[doc].update(got)
                    spans[doc].append((w - int(first[doc]), w - int(first[doc]) + p.length))
        yield a, z, np.diff(first), {k: _joined(v) for k, v in spans.items()}, items


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, z, words, spans, items in _scan(shared.value, batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, z - a),
                        pa.array(words, pa.int64()),
                        pa.array([spans.get(k, []) for k in range(z - a)], pa.list_(pa.int32())),
                        pa.array([sorted(items.get(k, ())) for k in range(z - a)], pa.list_(pa.int64())),
                    ],
                    names=["row_key", "n_words", "spans", "items"],
                )

    return run


def _clean_rows(shared, text_col: str):
    """Passes the rows on whose text isn't contaminated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for a, _, words, spans, _ in _scan(shared.value, batch.column(text_col)):
                for k, s in spans.items():
                    keep[a + k] = 20 * (sum(s[1::2]) - sum(s[0::2])) < words[k]
            yield batch.filter(pa.array(keep))

    return run


def _joined(spans: list[tuple[int, int]]) -> list[int]:
    """Overlapping spans as one flat list start, end, start, end of disjoint ones."""
    out: list[int] = []
    for a, z in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], z)
        else:
            out += [a, z]
    return out


def _merge_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat = batch.column("spans").to_pylist()
        hits = []
        for lists in flat:
            joined = _joined([(s[k], s[k + 1]) for s in lists for k in range(0, len(s), 2)])
            hits.append(sum(joined[1::2]) - sum(joined[0::2]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, pa.int64()), batch.column(3)], names=["row_key", "n_words", "n_hit", "items"])


def _pattern_blocks(benchmark: DataFrame, item_col: str, item_text: str, window: int, max_windows: int) -> tuple[int, Iterator]:
    """The number of blocks of items, and their broadcast pattern sets, each of at most about max_windows windows."""
    bench = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).alias("text")).filter("item IS NOT NULL AND text IS NOT NULL")
    # An item has at most as many windows as half its characters, rounded up.
    total = bench.agg(F.sum(F.ceil(F.length("text") / 2))).first()[0] or 0
    blocks = max(1, -(-int(total) // max_windows))

    def built() -> Iterator:
        for b in range(blocks):
            own = bench if blocks == 1 else bench.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
            yield bench.sparkSession.sparkContext.broadcast(build([(r[0], r[1]) for r in own.toLocalIterator()], window))

    return blocks, built()


def _searched(rows: DataFrame, sets: Iterator, blocks: int) -> DataFrame:
    """row_key, n_words, n_hit, items of every row of rows (row_key, text).

    With several blocks the rows must be stored and their keys unique: each block's spans are written before the
    next block is built, and merged by the key.
    """
    kind = dict(rows.dtypes)["row_key"]
    found = None
    for shared in sets:
        part = rows.select("row_key", "text").mapInArrow(_search(shared), f"row_key {kind}, n_words long, spans array<int>, items array<long>")
        if blocks > 1:
            # The first block writes every row, for its number of words; the others only add what they found.
            part = materialize(part if found is None else part.filter("size(spans) > 0"), "decon-spans")
            shared.unpersist()
        found = part if found is None else found.unionByName(part)
    if blocks > 1:
        found = found.groupBy("row_key").agg(F.max("n_words").alias("n_words"), F.collect_list("spans").alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    else:
        found = found.select("row_key", "n_words", F.array("spans").alias("spans"), "items")
    return found.select("row_key", "n_words", "spans", "items").mapInArrow(_merge_spans, f"row_key {kind}, n_words long, n_hit long, items array<long>")


def _row_by_row(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, window: int, max_windows: int) -> DataFrame:
    """occurrences() of every row, rows that repeat an id too."""
    texts = docs.select(F.col(id_col).alias("row_key"), F.col(text_col).alias("text"))
    blocks, sets = _pattern_blocks(benchmark, item_col, item_text, window, max_windows)
    if blocks == 1:
        return _searched(texts, sets, blocks)
    keyed = materialize(texts.select(F.struct(F.monotonically_increasing_id().alias("row"), F.col("row_key").alias("id")).alias("row_key"), "text"), "decon-rows")
    return _searched(keyed, sets, blocks).withColumn("row_key", F.col("row_key.id"))


def occurrences(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Returns for every row of docs: row_key (its id), n_words, n_hit, items (sorted array of item ids).

    Words are runs of ASCII letters and digits and of any other character beyond ASCII, A-Z folded. An item
    of fewer words than the window is one window; an item without words has none. Null texts have no words.
    Null item ids are left out. Every row has its answer, rows that repeat an id too, with any number of blocks.
    """
    return _row_by_row(docs, benchmark, id_col, text_col, item_col, item_text, window, max_windows)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Adds the digest and the verdict to the occurrences of every row: contaminated if n_hit > 0 and 20 * n_hit >= n_words."""
    found = _row_by_row(docs, benchmark, id_col, text_col, item_col, item_text, window, max_windows)
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        F.col("row_key").alias(id_col),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        _contaminated().alias("contaminated"),
    )


def _contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """docs without the contaminated documents, judged row by row, with all their columns."""
    blocks, sets = _pattern_blocks(benchmark, "item_id", "text", window, max_windows)
    if blocks == 1:
        return docs.mapInArrow(_clean_rows(next(sets), text_col), docs.schema)
    # A hit may be made up of several blocks' items, so the verdict needs all blocks' spans of a row.
    own = free_name(docs, "row")
    keyed = materialize(docs.withColumn(own, F.monotonically_increasing_id()), "decon-rows")
    found = _searched(keyed.select(F.col(own).alias("row_key"), F.col(text_col).alias("text")), sets, blocks)
    bad = materialize(found.filter(_contaminated()).select(F.col("row_key").alias(own)), "contaminated")
    return keyed.join(bad, own, "left_anti").select(*docs.columns)


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    """contamination() of all documents by the benchmark. Null and empty texts have no words and are clean; every
    row is judged by itself, those that repeat an id and those without one too."""
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bm AS (SELECT item_id, w, least(13, len(w)) AS m FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i : i + m - 1], ' ') AS t FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM bm)),
lens AS (SELECT DISTINCT m FROM win),
dw AS (SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS t FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m)),
occ AS (SELECT dw.doc_id, dw.i, dw.m, win.item_id FROM dw JOIN win ON dw.m = win.m AND dw.t = win.t),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM occ)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(hit.n_hit, 0) AS n_hit, coalesce(it.n_items, 0) AS n_items, sha256(coalesce(it.ids, '')) AS items_sha256,
       coalesce(hit.n_hit, 0) > 0 AND 20 * coalesce(hit.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""

"""Line dedup by a deletion-neighbourhood join over words.

Two lines are near copies if their word sequences differ by at most one inserted, deleted or replaced word.
The variants of a line are its word sequence and all sequences with one word deleted, as hashed keys:

* two lines that give the same variant by deleting a word at the same place differ by one replaced word, so all
  lines that share (variant, place) are near copies of each other, and the earliest of them is enough;
* a line whose whole sequence is another line's variant differs from it by one inserted word.

Every key is thus resolved by its earliest line (an aggregate), never by pairs, however many lines share it.
Only lines that share one half of their words with a different line can have a near copy, so only they emit
variants; which half keys occur twice is told to the tasks as a bit table of fixed size (its false alarms only
cost extra variants). Witnesses are verified by edit distance on the words themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogue_etl.llm.common import drop, free_name, materialize
from dialogue_etl.llm.textkit import NOT_SPACE, mix, powers, slices, span_hashes, word_spans

#: Lines of fewer words are only compared for equality: one word is much of what they say ("Chapter 1", "Chapter 2").
MIN_WORDS = 8
#: Bits of the table of half keys and of the table of suspected lines, by their number; 128 MB each at most.
LEAST_BITS, MOST_BITS = 16, 30
#: Bits set for a key: all of them must be set, so few lines without a shared half pass.
BITS_A_KEY = 4
FULL = -1
#: Words as the keys see them: between ASCII white space, other spaces are part of a word.
_LOWER = {c: c + 32 for c in range(65, 91)}
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Lines:
    """The lines of a piece of a batch: word hashes and, for every line, its words' range and sequence hash."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.data = data
        breaks = np.flatnonzero(data == 10)
        self.ends = np.unique(np.concatenate([ends, breaks + 1]))
        if len(data) == 0:
            self.ends = np.zeros(1, np.int64)
        self.starts, self.stops, self.first = word_spans(data, self.ends, NOT_SPACE)
        words = span_hashes(data, self.starts, self.stops)
        up, self.down = powers(len(words) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)], dtype=np.uint64)])
        self.text = np.searchsorted(ends, self.ends[:-1], "right") - 1
        head = np.searchsorted(self.text, np.arange(len(ends) - 1))
        self.number = np.arange(len(self.text)) - head[self.text] if len(self.text) else np.zeros(0, np.int64)
        self.a, self.z = self.first[:-1], self.first[1:]
        self.n = self.z - self.a
        self.key = self.span(self.a, self.z)

    def span(self, a: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Hash of the words a..z-1 and their number."""
        return mix((self.sums[z] - self.sums[a]) * self.down[a] + (z - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def halves(self) -> np.ndarray:
        """Three keys a line; near copies share one: a half of n words or, of a longer line, of n - 1."""
        m, n = self.n // 2, self.n
        lower = np.maximum((n - 1) // 2, 0)
        left, left_less = self.span(self.a, self.a + m), self.span(self.a, self.a + lower)
        right, right_less = self.span(self.a + m, self.z), self.span(np.minimum(self.z - (n - 1 - lower), self.z), self.z)
        even = n % 2 == 0
        tag = np.uint64(0x5851F42D4C957F2D)
        return np.stack([left, np.where(even, left_less, right_less ^ tag), right ^ tag], axis=1)

    def variants(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, deleted place, key) of all variants of the lines; place FULL is the line itself."""
        n = self.n[which]
        line = np.repeat(which, n)
        place = np.arange(len(line)) - np.repeat(np.cumsum(n) - n, n)
        at = self.a[line] + place
        a, z = self.a[line], self.z[line]
        left = (self.sums[at] - self.sums[a]) * self.down[a]
        right = (self.sums[z] - self.sums[at + 1]) * self.down[a + 1]
        key = mix(left + right + (z - a - 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return np.concatenate([which, line]), np.concatenate([np.full(len(which), FULL), place]), np.concatenate([self.key[which], key])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, _, data, ends in slices(batch.column("text")):
            lines = Lines(data, ends)
            on = np.flatnonzero(lines.n > 0)
            halves = lines.halves()[on].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(lines.text[on] + a)),
                    batch.column("row").take(pa.array(lines.text[on] + a)),
                    pa.array(lines.number[on], pa.int32()),
                    pa.array(lines.key[on].astype(np.int64)),
                    pa.array(lines.n[on], pa.int32()),
                    *(pa.array(halves[:, k]) for k in range(3)),
                ],
                names=["doc_id", "row", "line_no", "line", "n_words", "k0", "k1", "k2"],
            )


def bit_table(keys: DataFrame) -> tuple[int, np.ndarray]:
    """(bits, table): a table of 2**bits bits in words of 64, about 32 bits a key up to 2**MOST_BITS. The high bits of
    a key (column key) name its word, its low bits BITS_A_KEY places in it. A fuller table gives more false alarms,
    which cost variants and change nothing."""
    bits = min(MOST_BITS, max(LEAST_BITS, (32 * keys.count()).bit_length()))
    places = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned(key, {6 * k}) & 63 AS int))" for k in range(BITS_A_KEY))
    rows = keys.groupBy(F.shiftrightunsigned("key", 70 - bits).alias("word")).agg(F.bit_or(F.expr(places)).alias("bits"))
    out = np.zeros(1 << (bits - 6), np.uint64)
    table = rows.toArrow()
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy().astype(np.uint64)
    return bits, out


def _set_in(shared: tuple[int, np.ndarray], keys: np.ndarray) -> np.ndarray:
    bits, table = shared
    keys = keys.astype(np.uint64)
    places = np.zeros(len(keys), np.uint64)
    for k in range(BITS_A_KEY):
        places |= np.uint64(1) << (keys >> np.uint64(6 * k) & np.uint64(63))
    return table[(keys >> np.uint64(70 - bits)).astype(np.int64)] & places == places


def _varied(shared, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, ends in slices(batch.column("text")):
                lines = Lines(data, ends)
                on = np.flatnonzero((lines.n >= min_words) & _set_in(shared.value, lines.halves().reshape(-1)).reshape(-1, 3).any(axis=1))
                _, once = np.unique(lines.key[on], return_index=True)
                line, place, key = lines.variants(on[once])
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(place, pa.int32()), pa.array(lines.key[line].astype(np.int64))], names=["key", "place", "line"])

    return run


def _texts(shared):
    """The words of the lines whose key is in the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, ends in slices(batch.column("text")):
                lines = Lines(data, ends)
                on = np.flatnonzero((lines.n > 0) & _set_in(shared.value, lines.key))
                _, once = np.unique(lines.key[on], return_index=True)
                on = on[once]
                texts = [data[lines.ends[k] : lines.ends[k + 1]].tobytes().decode("utf-8", "replace").translate(_LOWER) for k in on]
                yield pa.RecordBatch.from_arrays([pa.array(lines.key[on].astype(np.int64)), pa.array(texts, pa.string())], names=["line", "text"])

    return run


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether the word sequences differ by at most one inserted, deleted or replaced word."""
    if abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [within_one(_WORD.findall(x), _WORD.findall(y)) for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("line").filter(pa.array(keep, pa.bool_()))], names=["line"])


def line_status(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, row_col: str | None = None) -> DataFrame:
    """(doc_id, row, line_no, dropped) of every line with a word, line_no counted from 0 in its row's text.

    Every row has a number of its own, so rows that repeat an id or have none don't mix up their lines: the column
    row_col, or else the place at which the rows are stored.
    """
    spark = docs.sparkSession
    row = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row.alias("row")).filter("text IS NOT NULL")
    # Written at once, so the numbers are fixed from here on.
    listed = materialize(texts.mapInArrow(_listed, "doc_id long, row long, line_no int, line long, n_words int, k0 long, k1 long, k2 long"), "line-list")
    # Equal lines are one; a null id comes after all others.
    order = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("d"), F.col("row").alias("r"), F.col("line_no").alias("l"))
    distinct = listed.groupBy("line").agg(F.min(order).alias("first"), F.first("n_words").alias("n_words"), *[F.first(k).alias(k) for k in ("k0", "k1", "k2")])
    distinct = materialize(distinct, "line-distinct")
    halves = distinct.filter(F.col("n_words") >= min_words).select(F.explode(F.array_distinct(F.array("k0", "k1", "k2"))).alias("key"))
    twice = materialize(halves.groupBy("key").count().filter("count > 1").select("key"), "line-halves")
    shared = spark.sparkContext.broadcast(bit_table(twice))
    drop(twice)
    variants = texts.select("text").mapInArrow(_varied(shared, min_words), "key long, place int, line long").distinct()
    variants = materialize(variants, "line-variants")
    shared_keys = materialize(variants.groupBy("key").count().filter("count > 1").select("key"), "line-keys")
    active = variants.join(shared_keys, "key").join(distinct.filter(F.col("n_words") >= min_words).select("line", "first"), "line")
    active = materialize(active, "line-active")
    drop(variants)
    lead = active.groupBy("key", "place").agg(F.min(F.struct("first", "line")).alias("lead"))
    whole = lead.filter(f"place = {FULL}").select("key", F.col("lead").alias("full"))
    part = lead.filter(f"place <> {FULL}").groupBy("key").agg(F.min("lead").alias("part"))
    lead = lead.filter(f"place <> {FULL}")
    # A replaced word: the earliest line of (key, place). An inserted one: the whole line, or its earliest extension.
    replaced = active.filter(f"place <> {FULL}").join(materialize(lead, "line-lead"), ["key", "place"]).select("line", "first", "lead")
    longer = active.filter(f"place <> {FULL}").join(materialize(whole, "line-whole"), "key").select("line", "first", F.col("full").alias("lead"))
    shorter = active.filter(f"place = {FULL}").join(materialize(part, "line-part"), "key").select("line", "first", F.col("part").alias("lead"))
    near = replaced.unionByName(longer).unionByName(shorter).filter((F.col("lead.first") < F.col("first")))
    pairs = materialize(near.groupBy("line").agg(F.min("lead.first").alias("f"), F.min_by("lead.line", "lead.first").alias("witness")), "line-pairs")
    wanted = pairs.select(F.col("line").alias("key")).unionByName(pairs.select(F.col("witness").alias("key")))
    found = spark.sparkContext.broadcast(bit_table(wanted))
    words = materialize(texts.select("text").mapInArrow(_texts(found), "line long, text string").groupBy("line").agg(F.first("text").alias("text")), "line-texts")
    checked = pairs.join(words.withColumnRenamed("text", "text_a"), "line").join(words.select(F.col("line").alias("witness"), F.col("text").alias("text_b")), "witness")
    gone = materialize(checked.select("line", "text_a", "text_b").mapInArrow(_verified, "line long").withColumn("near", F.lit(True)), "line-near")
    known = materialize(distinct.select("line", "first").join(gone, "line", "left"), "line-known")
    drop(active)
    return listed.select("doc_id", "row", "line_no", "line", order.alias("own")).join(known, "line").select("doc_id", "row", "line_no", (F.coalesce("near", F.lit(False)) | (F.col("own") != F.col("first"))).alias("dropped"))


def dedup_summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Returns per id of docs: n_lines (with a word), n_kept and dropped_lines (ascending, comma-joined).

    A line goes if an earlier line of the corpus, in the order of (id, row, line number), is equal to it or, both
    having at least min_words words, differs by one word; words are compared with A-Z folded. Lines end at a
    line feed; lines without a word stay and don't count. Null and empty texts have no lines. A null id comes last
    in the order. Rows that repeat an id, or have none, are told apart: a line that another row of the id repeats
    goes; they are summed into one row here, each line under its number in its own text.
    """
    status = line_status(docs, id_col, text_col, min_words)
    per_doc = status.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(~F.col("dropped")).alias("n_kept"), F.array_sort(F.collect_list(F.when(F.col("dropped"), F.col("line_no")))).alias("gone"))
    ids = docs.select(F.col(id_col).cast("long").alias("id")).distinct()
    out = ids.join(per_doc, F.col("id").eqNullSafe(F.col("doc_id")), "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("n_kept", F.lit(0)).alias("n_kept"), F.array_join(F.coalesce("gone", F.array().cast("array<int>")).cast("array<string>"), ",").alias("dropped_lines"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """docs with the dropped lines taken out of their texts; all rows and columns stay. Lines are taken out row by row."""
    own, gone_col = free_name(docs, "row"), free_name(docs, "gone")
    keyed = materialize(docs.withColumn(own, F.monotonically_increasing_id()), "line-rows")
    gone = line_status(keyed, id_col, text_col, min_words, own).filter("dropped").groupBy(F.col("row").alias(own)).agg(F.collect_set("line_no").alias(gone_col))
    out = keyed.join(materialize(gone, "line-gone"), own, "left")
    kept = F.filter(F.split(F.col(text_col), "\n"), lambda x, i: ~F.array_contains(F.col(gone_col), i))
    cleaned = F.when(F.col(gone_col).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    return out.select(*[cleaned.alias(text_col) if c == text_col else F.col(c) for c in docs.columns])


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """dedup_summary() of all documents. Null and empty texts have no lines; rows that repeat an id are one
    document; a null id comes last."""
    return dedup_summary(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
WITH a AS (SELECT doc_id, string_split(text, chr(10)) AS t FROM documents),
l AS (SELECT doc_id, i, regexp_extract_all(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM (SELECT doc_id, unnest(t) AS x, generate_subscripts(t, 1) - 1 AS i FROM a)),
k AS (SELECT doc_id, i, w, array_to_string(w, ' ') AS k FROM l WHERE len(w) > 0),
d AS (SELECT k, any_value(w) AS w, min((doc_id, i)) AS f FROM k GROUP BY k),
v AS (SELECT k, f, i, hash(array_to_string(list_concat(w[1 : i - 1], w[i + 1 : len(w)]), ' ')) AS h FROM (SELECT k, f, w, unnest(range(1, len(w) + 1)) AS i FROM d WHERE len(w) >= 8)),
g AS (SELECT k, f, hash(k) AS h FROM d WHERE len(w) >= 8),
near AS (SELECT b.k FROM v a JOIN v b ON a.h = b.h AND a.i = b.i WHERE a.f < b.f UNION SELECT v.k FROM v JOIN g ON v.h = g.h WHERE g.f < v.f UNION SELECT g.k FROM v JOIN g ON v.h = g.h WHERE v.f < g.f),
s AS (SELECT k.doc_id, k.i, (k.doc_id, k.i) <> d.f OR near.k IS NOT NULL AS gone FROM k JOIN d ON k.k = d.k LEFT JOIN near ON near.k = k.k)
SELECT a.doc_id, count(s.i) AS n_lines, count(s.i) FILTER (WHERE NOT gone) AS n_kept, coalesce(string_agg(CAST(CASE WHEN gone THEN s.i END AS VARCHAR), ',' ORDER BY s.i), '') AS dropped_lines
FROM (SELECT DISTINCT doc_id FROM documents) a LEFT JOIN s ON a.doc_id = s.doc_id GROUP BY a.doc_id
"""

"""Token ids in ORC: integer run-length encoding, row indexes and a Bloom filter on the document id.

Texts are dealt by ranges of the document id and sorted, so file k holds smaller ids than file k + 1, the
stripe statistics of doc_id are disjoint, and a lookup of an id prunes stripes by them, row groups by the row
index and the rest by the Bloom filter. Stripes are read in parallel; starts are running sums in each file
plus the sums of the files before it.
"""

from __future__ import annotations

import contextlib
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialogue_etl.llm.common import materialize, note_scratch, scratch_dir
from dialogue_etl.llm.textkit import raw, slices, span_hashes

END_ID = 0
#: Distinct words whose ids one worker keeps, about 60 bytes each; when it is full the more used half stays.
MAX_WORDS = 1 << 18
#: Rows that one Arrow batch holds while texts and ids pass to and from the tasks.
BATCH_ROWS = 1000
#: Bytes of text that are encoded at once; a longer text is encoded alone.
BYTES_AT_ONCE = 1 << 20
#: Texts that go to the tokenizer whole: with white space other than single spaces and line feeds between
#: words, or with the special token's string.
WHOLE = (
    "[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200f}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{2060}\\x{3000}\\x{feff}]"
    "|  |\\n\\n| \\n|\\n |^[ \\n]|[ \\n]$|<\\|endoftext\\|>"
)
#: Letters (w) with marks after them (m); the byte-level pattern always parts the two, and takes the marks as one.
WORD_AND_MARKS = "^(?P<w>[A-Za-z\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{24f}]+)(?P<m>[!\"#$%&()*+,\\-./:;<=>?@\\[\\\\\\]^_`{|}~]*)$"
#: Ids that a lookup passes to the scan as literals.
MAX_LITERALS = 1000
SCHEMA = "doc_id long, at long, tokens array<int>"
#: New words that are joined into one text for the tokenizer.
JOINED = 4000


def _gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The spans pool[start : start + size], one after the other."""
    before = np.cumsum(sizes) - sizes
    return pool[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


def _hashes(words: pa.Array) -> np.ndarray:
    data, ends = raw(words)
    return span_hashes(data, ends[:-1], ends[1:], fold=False)


class Encoder:
    """Ids of whole texts, each ended by END_ID. The byte-level pattern never joins what a single space or line
    feed parts, and gives the space to the word after it; words repeat far more often than texts, so each is
    encoded by the tokenizer once and looked up from then on."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        from tokenizers import Tokenizer

        # Spark's tasks are the parallelism; the library's own threads would compete with them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        #: By id: whether the token starts with the space (its stand-in in a byte-level vocabulary is U+0120).
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.max_words = max_words
        #: Words after a space, their ids in one pool, and how often they were asked for.
        self.words, self.pool = pa.array([], pa.string()), np.zeros(0, "<u4")
        self.starts, self.sizes, self.uses = (np.zeros(0, np.int64) for _ in range(3))
        #: The words' hashes in order, and the word of each.
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        #: First words of texts and lines, and marks after words.
        self.plain: dict[str, np.ndarray] = {}

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def plain_ids(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.plain) > self.max_words // 8:
            self.plain = {}
        new = list(set(texts).difference(self.plain))
        self.plain.update(zip(new, self.whole(new)))
        return [self.plain[x] for x in texts]

    def word_spans(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Starts and sizes in the pool of distinct words, each with a space before it."""
        if len(self.words) + len(words) > self.max_words:
            keep = np.sort(np.argsort(-self.uses, kind="stable")[: self.max_words // 2])
            self.words, self.pool = self.words.take(pa.array(keep)), _gather(self.pool, self.starts[keep], self.sizes[keep])
            self.sizes, self.uses = self.sizes[keep], self.uses[keep] // 2
            self.starts = np.cumsum(self.sizes) - self.sizes
            h = _hashes(self.words)
            self.place = np.argsort(h, kind="stable")
            self.keys = h[self.place]
        h = _hashes(words)
        spot = np.searchsorted(self.keys, h)
        at = np.append(self.place, -1)[spot]
        # The words themselves are compared, so that equal hashes don't decide.
        at[~pc.equal(self.words.take(pa.array(at, mask=at < 0)), words).fill_null(False).to_numpy(zero_copy_only=False)] = -1
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = words.take(pa.array(missing))
            parts = [new.slice(k, JOINED).to_pylist() for k in range(0, len(new), JOINED)]
            ids = np.concatenate([self.whole([" " + " ".join(part)])[0] for part in parts])
            # Each word has one space, at its start.
            starts = np.flatnonzero(self.spaced[ids])
            at[missing] = len(self.words) + np.arange(len(new))
            order = np.argsort(h[missing])
            where = np.searchsorted(self.keys, h[missing][order])
            self.keys, self.place = np.insert(self.keys, where, h[missing][order]), np.insert(self.place, where, at[missing][order])
            self.words = pa.concat_arrays([self.words, new])
            self.starts = np.concatenate([self.starts, len(self.pool) + starts])
            self.sizes = np.concatenate([self.sizes, np.diff(np.append(starts, len(ids)))])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
            self.pool = np.concatenate([self.pool, ids])
        self.uses[at] += 1
        return self.starts[at], self.sizes[at]

    def chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks one after the other, number of ids of each) of distinct chunks as __call__ marks them."""
        n = len(chunks)
        first = pc.utf8_slice_codeunits(chunks, 0, 1)
        plain = pc.is_in(first, value_set=pa.array(["\r", "\n", "\t"])).to_numpy(zero_copy_only=False)
        after = np.flatnonzero(~plain)
        spaced = chunks.take(pa.array(after))
        parted = pc.extract_regex(spaced, WORD_AND_MARKS)
        words = pc.coalesce(pc.struct_field(parted, "w"), spaced).dictionary_encode()
        starts, sizes = self.word_spans(words.dictionary)
        word = words.indices.to_numpy()
        marks = pc.coalesce(pc.struct_field(parted, "m"), "").dictionary_encode()
        extra = self.plain_ids(marks.dictionary.to_pylist())
        extra_sizes = np.array([len(x) for x in extra], np.int64)
        extra_starts = len(self.pool) + np.cumsum(extra_sizes) - extra_sizes
        mark = marks.indices.to_numpy()
        # First words: of a text after "\r", of a line after "\n", whose own ids come before them; "\t" is the end.
        marked = chunks.filter(pa.array(plain)).to_pylist()
        feed = self.plain_ids(["\n"])[0]
        own = [np.array([END_ID], "<u4") if x == "\t" else np.concatenate([feed, y]) if x[0] == "\n" else y for x, y in zip(marked, self.plain_ids([x[1:] for x in marked]))]
        own_sizes = np.array([len(x) for x in own], np.int64)
        pool = np.concatenate([self.pool, *extra, *own])
        spans = np.zeros((2, n, 2), np.int64)
        spans[:, after, 0] = starts[word], sizes[word]
        spans[:, after, 1] = extra_starts[mark], extra_sizes[mark]
        spans[:, np.flatnonzero(plain), 0] = len(self.pool) + extra_sizes.sum() + np.cumsum(own_sizes) - own_sizes, own_sizes
        return _gather(pool, spans[0].reshape(-1), spans[1].reshape(-1)), spans[1].sum(axis=1)

    def __call__(self, texts: pa.Array) -> pa.ListArray:
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, WHOLE).to_numpy(zero_copy_only=False)
        simple = texts.filter(pa.array(~odd))
        # Every chunk is a word after a space, or marked: the first of a text, the first of a line, the end.
        chunks = pc.split_pattern(pc.binary_join_element_wise("\r", pc.replace_substring(simple, "\n", " \n"), " \t", ""), " ")
        coded = chunks.flatten().dictionary_encode()
        pool, sizes = self.chunk_ids(coded.dictionary)
        which = coded.indices.to_numpy()
        counts = sizes[which]
        ids = _gather(pool, (np.cumsum(sizes) - sizes)[which], counts)
        ends = np.concatenate([[0], np.cumsum(counts)])[chunks.offsets.to_numpy()]
        if not odd.any():
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.view("<i4")))
        end = np.array([END_ID], "<u4")
        whole = [np.concatenate([x, end]) for x in self.whole(texts.filter(pa.array(odd)).to_pylist())]
        ends = np.concatenate([ends, ends[-1] + np.cumsum([len(x) for x in whole])])
        both = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([ids, *whole]).view("<i4")))
        return both.take(pa.array(np.where(odd, len(simple) + np.cumsum(odd) - 1, np.cumsum(~odd) - 1)))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder: it outlives a task, as this function is looked up in the module and not shipped."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _encoded(path: str):
    """(doc_id, at, tokens) of a partition's rows; at is the number of ids that its file holds before the row's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, before = encoder(path), 0
        for batch in batches:
            column = batch.column("text")
            for a, z, _, _ in slices(column, BYTES_AT_ONCE):
                tokens = encode(column.slice(a, z - a))
                ends = before + tokens.offsets.to_numpy().astype(np.int64)
                before = int(ends[-1])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, z - a), pa.array(ends[:-1]), tokens], names=["doc_id", "at", "tokens"])

    return run


@contextlib.contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of BATCH_ROWS rows for the writes inside; the session's own setting comes back after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Writes ORC files of (doc_id, at, tokens) in ascending order of the id, each document ended by id 0.

    A null text is an empty one; null ids come first; rows that repeat an id all stay, ordered by their text.
    Each task writes one file; at counts the ids before the row in it.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    out = rows.mapInArrow(_encoded(tokenizer), SCHEMA)
    with _small_batches(docs.sparkSession):
        out.write.option("compression", "zstd").option("maxRecordsPerFile", "0").option("orc.create.index", "true").option("orc.row.index.stride", "1000").option("orc.stripe.size", str(16 << 20)).option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path)
    return path


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = batch.column("tokens")
        ends = tokens.offsets.to_numpy()
        flat = tokens.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        crc = [zlib.crc32(flat[i:j].tobytes()) for i, j in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("chunk"), batch.column("at"), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "chunk", "at", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """The files' rows (doc_id, at, tokens); `wanted` (column doc_id) keeps those ids.

    Up to MAX_LITERALS wanted ids become a filter in the scan, which skips files and stripes by their statistics,
    row groups by the row index and the rest by the Bloom filter. More of them are a semi join behind the same
    pruning by their least and greatest id.
    """
    rows = spark.read.schema(SCHEMA).orc(path)
    if wanted is None:
        return rows
    ids = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    few = [r[0] for r in ids.limit(MAX_LITERALS + 1).collect()]
    if len(few) <= MAX_LITERALS:
        return rows.filter(F.col("doc_id").isin([i for i in few if i is not None]))
    low, high = ids.agg(F.min("doc_id"), F.max("doc_id")).first()
    return rows.filter(F.col("doc_id").between(low, high)).join(ids, "doc_id", "left_semi")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files.

    Files follow each other in the id's order; a row's place in its file stands in the file. The sums of the
    files are one short row a file.
    """
    rows = read_tokens(spark, path).withColumn("chunk", F.regexp_extract(F.input_file_name(), "part-(\\d+)", 1).cast("int"))
    with _small_batches(spark):
        rows = materialize(rows.select("doc_id", "chunk", "at", "tokens").mapInArrow(_checked, "doc_id long, chunk int, at long, n_tokens long, ids_crc32 long"), "token-index")
    sums = rows.groupBy("chunk").agg(F.sum("n_tokens").alias("n"))
    offsets = sums.select("chunk", F.coalesce(F.sum("n").over(Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    return rows.join(offsets, "chunk").select("doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def tokenize(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Writes the token files (to scratch without a path) and returns token_index() of them."""
    spark = docs.sparkSession
    if path is None:
        path = f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex[:12]}"
        note_scratch(path)
    return token_index(spark, write_tokens(docs, path, tokenizer))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_token_output(spark, sf_dir: str) -> DataFrame:
    """The index of all documents' token ids, read back from the files. Null and empty texts hold the end id
    alone; repeated rows all stay, each with a place of its own; other columns are ignored."""
    return tokenize(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer())

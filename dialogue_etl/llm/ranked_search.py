"""Ranked lexical search by presence-mask grouping.

Documents are read once into postings of the terms that the items ask for, beside their number of terms; the corpus
statistics are sums over all of them. Blocks of documents are then searched for every item: a bit for each of the
item's terms is OR-ed into the masks of the documents that hold the term, documents of one mask are a group, and a
group's maximum score is the sum of its terms' highest contributions. Groups are scored exactly by descending maximum
until it falls below the item's k-th best score; what is left can't be among the first k. Spark merges the blocks'
first k of each item.

Items are taken in blocks of a bounded number of terms, one scan of the documents a block, so what is broadcast has
a fixed bound whatever the number of items.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialogue_etl.llm.common import drop, materialize
from dialogue_etl.llm.decontaminate import item_words
from dialogue_etl.llm.textkit import ALNUM, Vocabulary, slices, word_spans

TOP = 50
#: Terms of the items of one block, repeats over items counted; and so of what is broadcast, about 100 bytes each.
MAX_TERMS = 400_000
#: Documents and postings that are searched at once.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 16, 1 << 22


def _postings(shared):
    """(id, n, terms, tfs) of every document that has a term at all; terms are numbers of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for a, z, data, ends in slices(batch.column(1)):
                starts, stops, first = word_spans(data, ends, ALNUM)
                at, term = vocabulary.find(data, starts, stops)
                doc = np.searchsorted(first, at, "right") - 1
                pair, tf = np.unique(doc * max(1, len(vocabulary)) + term, return_counts=True)
                doc, term = np.divmod(pair, max(1, len(vocabulary)))
                n = np.diff(first)
                offsets = pa.array(np.searchsorted(doc, np.arange(z - a + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (term, tf)]
                out = pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a), pa.array(n, pa.int64()), *lists], names=["id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))

    return run


class Items(NamedTuple):
    """A block of items with the statistics of their terms over all documents."""

    ids: list
    terms: list[np.ndarray]
    weights: np.ndarray
    n_docs: int
    n_terms: int


class Block:
    """Postings of a block of documents with their contributions to a score, by document and by term."""

    def __init__(self, table: pa.Table, items: Items):
        n = table.column("n").to_numpy()
        lists = [table.column(c).combine_chunks() for c in ("terms", "tfs")]
        lists = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in lists]
        term, tf = (x.flatten().to_numpy().astype(np.int64) for x in lists)
        length = lists[0].value_lengths().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(n)), length)
        m = 50 + 50 * n * items.n_docs // items.n_terms
        gain = items.weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
        use = gain > 0  # a term of weight 0 adds nothing
        self.term, self.gain, doc = term[use], gain[use], doc[use]
        self.by_doc = np.searchsorted(doc, np.arange(len(n) + 1))
        order = np.argsort(self.term, kind="stable")
        self.docs = doc[order]
        self.by_term = np.searchsorted(self.term[order], np.arange(len(items.weights) + 1))
        self.most = np.zeros(len(items.weights), np.int64)
        np.maximum.at(self.most, self.term, self.gain)
        ids = table.column("id").combine_chunks()
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        self.wanted = np.zeros(len(items.weights), bool)

    def groups(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents ordered by group, first of each group and the end, each group's maximum), by descending maximum."""
        words = max(1, -(-len(terms) // 64))
        masks = np.zeros((len(self.by_doc) - 1, words), np.uint64)
        for k, t in enumerate(terms.tolist()):
            masks[self.docs[self.by_term[t] : self.by_term[t + 1]], k // 64] |= np.uint64(1 << k % 64)
        docs = np.flatnonzero(masks.any(axis=1))
        masks = masks[docs]
        order = np.argsort(masks[:, 0], kind="stable") if words == 1 else np.lexsort(masks.T)
        masks = masks[order]
        new = np.ones(len(docs), bool)
        new[1:] = (masks[1:] != masks[:-1]).any(axis=1)
        first = np.flatnonzero(new)
        distinct, most = masks[first], np.zeros(len(first), np.int64)
        for k, t in enumerate(terms.tolist()):
            most += self.most[t] * (distinct[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)).astype(np.int64)
        best = np.argsort(-most, kind="stable")
        size = np.diff(np.append(first, len(docs)))[best]
        ends = np.cumsum(size)
        at = np.repeat(first[best] - (ends - size), size) + np.arange(len(docs))
        return docs[order][at], np.concatenate([[0], ends]), most[best]

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """Exact scores of documents by the wanted terms."""
        first = self.by_doc[docs]
        size = self.by_doc[docs + 1] - first
        ends = np.cumsum(size)
        at = np.repeat(first - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
        total = np.concatenate([[0], np.cumsum(np.where(self.wanted[self.term[at]], self.gain[at], 0))])
        return total[ends] - total[ends - size]

    def first(self, terms: np.ndarray, top: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, documents scored): the first `top` of the item, without those below `least`."""
        docs, start, most = self.groups(terms)
        self.wanted[terms] = True
        kept, kept_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, goal = 0, 2 * top
        while at < len(most) and most[at] >= max(1, least):
            end = max(at + 1, int(np.searchsorted(start, start[at] + goal, "right")) - 1)
            end = min(end, at + int(np.searchsorted(-most[at:], -max(1, least), "right")))
            own = docs[start[at] : start[end]]
            kept, kept_scores = np.concatenate([kept, own]), np.concatenate([kept_scores, self.scores(own)])
            order = np.lexsort((self.ids[kept], self.null[kept], -kept_scores))[:top]
            kept, kept_scores = kept[order], kept_scores[order]
            if len(kept) == top:
                least = max(least, int(kept_scores[-1]))
            at, goal = end, 2 * goal
        self.wanted[terms] = False
        good = kept_scores >= max(1, least)
        return kept[good], kept_scores[good], int(start[at])


def _ranked(shared, top: int, block_docs: int, block_postings: int):
    """(item, id, score): the first `top` of each item in every block of documents of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        #: Each item's k-th best score in the blocks so far: a lower one can't be among the first k.
        least = np.zeros(len(items.terms), np.int64)
        for table in _blocks(batches, block_docs, block_postings):
            block = Block(table, items)
            found = []
            for k, terms in enumerate(items.terms):
                docs, scores, _ = block.first(terms, top, int(least[k]))
                if len(docs) == top:
                    least[k] = scores[-1]
                if len(docs):
                    found.append((k, docs, scores))
            if found:
                docs = np.concatenate([f[1] for f in found])
                item = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
                ids = pa.array(block.ids[docs], mask=block.null[docs])
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), ids, pa.array(np.concatenate([f[2] for f in found]))], names=["item", "id", "score"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch], docs: int, postings: int) -> Iterator[pa.Table]:
    held, rows, size = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows, size = rows + batch.num_rows, size + len(batch.column("terms").flatten())
        if rows >= docs or size >= postings:
            yield pa.Table.from_batches(held)
            held, rows, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _statistics(postings: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, all their terms, and the number of documents of each of the block's terms."""
    total = postings.agg(F.count("*"), F.sum("n")).first()
    df = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return total[0], total[1] or 0, {r[0]: r[1] for r in df.toLocalIterator()}


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", top: int = TOP, max_terms: int = MAX_TERMS,
    block_docs: int = BLOCK_DOCS, block_postings: int = BLOCK_POSTINGS,
) -> DataFrame:
    """Returns (item_id, rank, doc_id, score): the first `top` documents of every item with a score above 0.

    Terms are runs of ASCII letters and digits and of any other character beyond ASCII, A-Z folded. Scores are whole
    numbers; equal ones are ranked by the smaller id.

    Defined cases: null and empty texts have no terms: such a document isn't counted and never found, such an item
    finds nothing. Every row is a document, and every row an item, for itself: rows that repeat an id are ranked each,
    and an item row that is repeated gives its list as often. A null id is an id that comes after all others.
    """
    spark = docs.sparkSession
    item_type = items.schema[item_col].dataType.simpleString()
    wanted = items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).filter("text <> ''")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # An item has at most as many terms as half its characters, rounded up.
    size = wanted.agg(F.sum(F.ceil(F.length("text") / 2))).first()[0] or 0
    blocks = max(1, -(-int(size) // max_terms))
    out = None
    for b in range(blocks):
        own = wanted if blocks == 1 else wanted.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        rows = [(r[0], sorted(set(item_words(r[1])))) for r in own.toLocalIterator()]
        vocabulary = Vocabulary({w for _, words in rows for w in words})
        words = spark.sparkContext.broadcast(vocabulary)
        postings = materialize(texts.mapInArrow(_postings(words), "id long, n long, terms array<int>, tfs array<int>"), "search-postings")
        n_docs, n_terms, df = _statistics(postings)
        held = np.array([df.get(k, 0) for k in range(len(vocabulary))], np.int64)
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * held + 1))).astype(np.int64)
        terms = [np.array(sorted(n for n in (vocabulary.number[w] for w in own_words) if held[n]), np.int64) for _, own_words in rows]
        shared = spark.sparkContext.broadcast(Items([i for i, _ in rows], terms, weights, max(1, n_docs), max(1, n_terms)))
        found = postings.mapInArrow(_ranked(shared, top, block_docs, block_postings), "item int, id long, score long")
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id")))
        found = found.withColumn("rank", rank).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(rows)], f"item int, item_id {item_type}")
        # One row an item of the block: as bounded as what is broadcast above.
        part = found.join(F.broadcast(names), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
        if blocks > 1:
            part = materialize(part, "search-found")
            drop(postings)
            words.unpersist()
            shared.unpersist()
        out = part if out is None else out.unionByName(part)
    return out


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    """search() of all documents for each benchmark item. Null and empty texts have no terms; every row is ranked for
    itself, those that repeat an id and those without one too."""
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = """
WITH dt AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
d AS (SELECT doc_id, len(w) AS n, w FROM dt WHERE len(w) > 0),
st AS (SELECT count(*) AS nd, sum(n) AS l FROM d),
it AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM it) GROUP BY doc_id, n, t),
df AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, st GROUP BY t),
g AS (SELECT doc_id, tf.t, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + CAST(50 * n * nd // l AS BIGINT)))) AS gain FROM tf JOIN df ON tf.t = df.t, st),
s AS (SELECT item_id, doc_id, CAST(sum(gain) AS BIGINT) AS score FROM it JOIN g ON it.t = g.t GROUP BY item_id, doc_id HAVING sum(gain) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
"""

"""Hard negatives, ranked search and license scans against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dialogue_etl.llm import hard_negatives as H
from dialogue_etl.llm import licenses as L
from dialogue_etl.llm import ranked_search as R
from tests.llm import brute

# --- hard negatives ---


def mined(rows, every=10, positives=5, keep=10):
    """(anchor, positive, rank, negative, scores) of rows (id, vector, label), every row by itself."""
    usable = []
    for k, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v is not None and None not in v and np.isfinite(v).all():
            usable.append((k, i, [math.floor(256 * x) for x in v], label))
    out = []
    for k, i, v, label in usable:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m, other) for m, j, w, other in usable if m != k and len(w) == len(v))
        for p, j, _, _ in [s for s in scored if s[3] == label][:positives]:
            window = [s for s in scored if s[3] != label and 30 * -p <= 100 * -s[0] <= 90 * -p]
            out += [(i, j, n + 1, s[1], -p, -s[0]) for n, s in enumerate(window[:keep])]
    return sorted(out)


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rank int, n_links int")


def answers(frame, **more):
    return sorted(tuple(r) for r in H.hard_negatives(frame, anchor=F.col("id") % 10 == 0, **more).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("blocks", [{}, {"block_anchors": 3, "block_rows": 16}])
def test_hard_negatives(spark, blocks):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((5, 8))
    rows = [(k, (base[k % 5] + rng.standard_normal(8) * 0.8).astype(np.float32).tolist(), int(rng.integers(0, 4))) for k in range(300)]
    # Ties: equal vectors with one label and with several; a label of its own; an empty group of negatives.
    rows += [(300 + k, [1.0] * 8, 1) for k in range(30)] + [(330 + k, [1.0] * 8, k % 3) for k in range(40)] + [(370, [0.5] * 8, 77), (380, [9.0] * 8, 1)]
    rng.shuffle(rows)
    want = mined(rows)
    assert len(want) > 1000 and answers(frame_of(spark, [(*r, 0, 0) for r in rows]), **blocks) == want


def test_hard_negative_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 1.0], 1), (10, [1.0, 0.5], 1), (10, [0.5, 0.5], 1), (10, [0.5, 0.5], 1), (None, [1.0, 1.0], 2), (3, None, 2), (4, [nan, 1.0], 2), (5, [inf, 1.0], 2), (6, [None, 1.0], 2), (7, [1.0, 1.0], None),
        (8, [0.5, 0.6], 2), (8, [0.5, 0.6], 2), (9, [0.1, 0.1], 2), (20, [-1.0, -1.0], 1), (30, [1.0], 1), (31, [0.8], 2), (32, [1.0], 1), (40, [], 5), (41, [], 5), (42, [], 6), (50, [0.0, 0.0], 1),
    ]
    got = answers(frame_of(spark, [(*r, 0, 0) for r in rows]))
    assert got == mined(rows) and {r[0] for r in got} == {0, 10, 30, 40, 50}
    empty = frame_of(spark, [])
    assert answers(empty) == []
    wide = spark.createDataFrame([(0, [70000.0], 1), (1, [2.0], 1), (2, [1.0], 2), (10, [2e30], 1), (20, [3.0], 1)], "vec_id long, embedding array<double>, label int")
    assert answers(wide) == mined([tuple(r) for r in wide.collect() if abs(r.embedding[0]) < 1e6])
    # Large whole numbers, beyond what doubles hold exactly.
    big = [(k, [1000.0 + k / 256] * 60 + [(-1.0) ** k * 900.5], k % 2) for k in range(40)]
    assert answers(spark.createDataFrame(big, "vec_id long, embedding array<double>, label int")) == mined(big)


def test_keys_sort_as_the_rows_do():
    rng = np.random.default_rng(5)
    rows = [tuple(int(x) for x in (rng.integers(-3, 3), rng.integers(0, 2), rng.integers(-5, 5) * 10**15, rng.integers(0, 2), rng.integers(-(1 << 62), 1 << 62), rng.integers(0, 3))) for _ in range(500)]
    columns = [np.array(c) for c in zip(*rows)]
    keys = H.packed(columns[0], columns[1], columns[2], columns[3].astype(np.uint8), columns[4], columns[5])
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0], rows[k][1], -rows[k][2], *rows[k][3:]))
    assert [keys[k] for k in order] == sorted(keys)
    assert [tuple(int(x) for x in r) for r in zip(*H.unpacked(keys))] == [r[:5] for r in rows]


def test_windows_hold_no_anchor():
    """The iterator answers piece by piece: rows come out before the stream has been read to its end."""
    n = 1000
    key = [H.packed(np.array([1]), np.array([0]), np.array([900]), np.array([0], np.uint8), np.array([5]), np.array([0]))]
    far = [H.packed(np.array([1]), np.array([0]), np.array([800 - k]), np.array([1], np.uint8), np.array([k]), np.array([k])) for k in range(n)]
    read = []

    def pieces():
        for k, piece in enumerate(key + far):
            read.append(k)
            yield piece

    stream = H.windows(pieces(), keep=3)
    assert next(stream) == [] and next(stream) == [(1, 0, 5, 1, 1, 0, 900, 800)] and len(read) == 2


# --- ranked search ---

WORDS = [f"t{k}" for k in range(60)] + ["é", "ß1", "x_y", "Über"]


def ranked(docs, items, top=50):
    rule = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"

    def terms(text):
        return re.findall(rule, (text or "").translate(brute.LOWER))

    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    total, count, df = sum(sum(c.values()) for _, c in held), len(held), Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * count // total
            s = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, n + 1, None if null else i, -s) for n, (s, null, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def texts_of(rng, n):
    weights = [1 / (k + 1) for k in range(len(WORDS))]
    return [" ".join(rng.choices(WORDS, weights, k=rng.randrange(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("more", [{}, {"max_terms": 300, "block_docs": 40, "block_postings": 300}])
def test_ranked_search(spark, more):
    rng = random.Random(8)
    docs = list(enumerate(texts_of(rng, 400)))
    docs += [(None, docs[0][1]), (None, "t1 t2"), (7, "t5 t5 t9"), (7, "t5 t5 t9"), (1000, None), (1001, ""), (1002, "...!"), (1003, "t3 " * 3000)] + [(2000 + k, "t40 T41, t42") for k in range(90)]
    # More than 64 terms, no terms, repeated rows, no id, words in no document.
    items = [(k, t) for k, t in enumerate(texts_of(rng, 12))] + [(50, " ".join(WORDS) + " " + " ".join(f"z{k}" for k in range(80))), (51, None), (52, ""), (53, "?"), (3, "t40 t41"), (3, "t40 t41"), (None, "T40"), (54, "nowhere")]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, item_id int, score int").repartition(3)
    bench = spark.createDataFrame([(*i, 9) for i in items], "item_id long, text string, rank int")
    got = sorted((tuple(r) for r in R.search(frame, bench, top=20, **more).select("item_id", "rank", "doc_id", "score").collect()), key=str)
    assert got == ranked(docs, items, 20)


def test_ranked_search_of_empty_tables(spark):
    frame, bench = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id string, text string")
    assert R.search(frame.limit(0), bench).collect() == [] and R.search(frame, bench.limit(0)).collect() == []
    # The only document holds the only term: its weight is floor(1000 * ln(4 / 3)).
    assert [tuple(r) for r in R.search(frame, bench).select("item_id", "rank", "doc_id", "score").collect()] == [("1", 1, 1, 287 * (1_000_000_000 // 3000))]


def test_groups_are_left_out_safely():
    """Most documents' masks are ruled out by their maximum score, and the first k are still the first k."""
    rng = np.random.default_rng(3)
    n, width = 4000, 40
    docs = [np.unique(rng.zipf(1.3, 30) % width) for _ in range(n)]
    terms = pa.array([d.tolist() for d in docs], pa.list_(pa.int32()))
    tfs = pa.array([[1] * len(d) for d in docs], pa.list_(pa.int32()))
    df = Counter(t for d in docs for t in d.tolist())
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in range(width)])
    items = R.Items([1], [np.array([0, 5, 9, 17, 30])], weights, n, 30 * n)
    table = pa.table({"id": pa.array(range(n), pa.int64()), "n": pa.array([30] * n, pa.int64()), "terms": terms, "tfs": tfs})
    block = R.Block(table, items)
    found, scores, scored = block.first(items.terms[0], 10, 0)
    block.wanted[items.terms[0]] = True
    every = block.scores(np.arange(n))
    assert found.tolist() == np.lexsort((np.arange(n), -every))[:10].tolist() and scores.tolist() == every[found].tolist()
    assert scored < (every > 0).sum() / 4


# --- license scans ---


def parsed(tokens):
    """Recursive descent over or, and, with: (freedom, names) of the tokens, which are one well-formed expression."""
    at = 0

    def atom():
        nonlocal at
        token = tokens[at]
        at += 1
        if token == "(":
            got = level(0)
            at += 1
            return got
        free, names = L.freedom(token.lower()), {token.lower()}
        return free, names

    def level(k):
        nonlocal at
        if k == 3:
            return atom()
        free, names = level(k + 1)
        while at < len(tokens) and tokens[at].lower() == ("or", "and", "with")[k]:
            at += 1
            other, more = level(k + 1)
            free, names = (max(free, other), names | more) if k == 0 else (min(free, other), names | more) if k == 1 else ((free + 1) / 2, names)
        return free, names

    return level(0)


def test_expressions_against_recursive_descent():
    rng = random.Random(6)
    names = ["MIT", "Apache-2.0", "GPL-3.0-only", "CC-BY-NC-4.0", "0BSD", "AGPL-3.0", "Odd-1"]

    def make(depth):
        roll = rng.random()
        if depth == 0 or roll < 0.3:
            return [rng.choice(names)] + (["WITH", "Classpath-exception-2.0"] if rng.random() < 0.2 else [])
        if roll < 0.5:
            return ["(", *make(depth - 1), ")"]
        return [*make(depth - 1), rng.choice(["or", "AND", "Or"]), *make(depth - 1)]

    for _ in range(400):
        tokens = make(5)
        value = L.evaluate(iter(tokens))
        assert (value.free, value.names) == parsed(tokens), tokens
    ends = {"MIT OR": ["mit"], "MIT or (": ["mit"], "( MIT": ["mit"], "MIT Apache-2.0": ["mit"], "MIT ) or BSD": ["mit"], "(MIT AND BSD) OR ISC": ["mit", "bsd", "and", "isc", "or"], "MIT or BSD and ISC": ["mit", "bsd", "isc", "and", "or"]}
    assert {k: L.evaluate(t for t, _ in L.tokens_of(k)).postfix for k in ends} == ends
    assert [L.evaluate(t for t, _ in L.tokens_of(x)) for x in ("", "OR MIT", "(", "()", ")", ", MIT")] == [None] * 6
    deep = L.evaluate(iter(["("] * 50_000 + ["MIT"] + [")"] * 50_000 + ["or", "BSD"] * 50_000))
    assert deep.names == {"mit", "bsd"} and deep.free == 0.9


def base_of(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(brute.LOWER))
    found = [(k, label) for phrase, label in L.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    starts = [k for k, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), sorted({label for _, label in found})


TEXTS = [
    ("Licensed under CC BY-NC 4.0.", ["cc-by", "cc-by-nc"], 0.2),
    ("This work is licensed under the GNU General Public License, version 3.", ["gpl"], 0.5),
    ("GNU Lesser General Public License", ["gpl", "lgpl"], 0.6),
    ("all\nrights -- RESERVED. all rights", ["reserved"], 0.0),
    ("// SPDX-License-Identifier: (MIT OR Apache-2.0) AND CC-BY-4.0 // end\nand GPL", ["apache-2.0", "cc-by", "cc-by-4.0", "mit"], 0.8),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", ["gpl-2.0-only"], 0.75),
    ("License-Expression = 'MIT'\nMIT License", ["mit"], 0.9),
    ("under the MIT License or, at your option, the Apache License", ["apache", "mit"], 0.9),
    ("the MIT License and the GNU General Public License", ["gpl", "mit"], 0.5),
    ("MIT License. It was a long time ago that this was said and done, then: all rights reserved", ["mit", "reserved"], 0.0),
    ("spdx license identifier without a colon; SPDX-License-Identifier:\nMIT", [], 0.0),
    ("cc by cc by", ["cc-by"], 0.8),
    ("SPDX-License-Identifier: MIT OR CC-BY-NC-4.0 – all rights reserved", ["cc-by", "cc-by-nc", "cc-by-nc-4.0", "mit", "reserved"], 0.0),
    ("éé SPDX-License-Identifier: MIT OR CC-BY-NC-4.0\nfile", ["cc-by", "cc-by-nc", "cc-by-nc-4.0", "mit"], 0.9),
    ("éall rights reserved allrights reserved", [], 0.0),
    ("public domain", ["public-domain"], 1.0),
    ("", [], 0.0),
    (None, [], 0.0),
    ("word " * 200_000 + "cc by " + "Ω " * 1000 + "MIT license", ["cc-by", "mit"], 0.8),
]


def test_license_scan(spark):
    rows = [(k if k != 3 else None, t, "x", 5) for k, (t, _, _) in enumerate(TEXTS)] + [(2, TEXTS[2][0], "x", 5), (2, "nothing", "x", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, labels string, n_words int")
    got = L.license_scan(frame).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id != 2}
    for k, (text, labels, score) in enumerate(TEXTS):
        if k == 2:
            continue
        r = by_id[k if k != 3 else None]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_of(text), text
        assert (r.labels, r.score) == (labels, score), text
    assert sorted((r.labels, r.score) for r in got if r.doc_id == 2) == [([], 0.0), (["gpl", "lgpl"], 0.6), (["gpl", "lgpl"], 0.6)]
    assert by_id[4].expressions == ["mit apache-2.0 or cc-by-4.0 and"] and [(p.word, p.n_words, p.label) for p in by_id[0].places] == [(2, 2, "cc-by"), (2, 3, "cc-by-nc")]
    assert L.license_scan(frame.limit(0)).collect() == []
    own = L.license_scan(frame, base={"nothing": "none"}, notices={}, tags=()).filter("n_base > 0").collect()
    assert [(r.base_labels, r.labels, r.score) for r in own] == [(["none"], ["none"], 0.5)]


def test_license_scan_of_whole_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = L.op13_license_scan(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        n, base, first, last, labels = base_of(docs[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (n, base, first, last, ",".join(labels))
        assert set(labels) <= set(r.labels.split(",")) and 0 <= r.score <= 1

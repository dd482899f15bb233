"""Near duplicates of texts and vectors, line dedup and components against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from dialogue_etl.llm import common, embedding_dedup, line_dedup, minhash_dedup
from tests.llm import brute

VOCABULARY = [f"w{k}" for k in range(400)]


def text_of(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def edited(rng, text, edits):
    w = text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = rng.choice(VOCABULARY)
    return " ".join(w)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    docs = []
    for group in range(12):
        base = text_of(rng, rng.randrange(20, 200))
        docs += [base] * rng.randrange(1, 4) + [edited(rng, base, rng.randrange(1, 1 + len(base.split()) // 12)) for _ in range(10)]
    docs += [text_of(rng, 60) for _ in range(40)] + ["", "one", "One", " one ", "a b", "A  B", None, None, "x y z"]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, texts, width):
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(frame, width=width).collect()}
    assert got == brute.near_duplicates(texts, width, 80)
    kept = {r.doc_id for r in minhash_dedup.keep_one(frame, width=width).collect()}
    assert kept == {i for i, (_, c) in got.items() if i == c}


def test_near_duplicate_edges(spark):
    long = " ".join(f"v{k}" for k in range(60_000))
    rows = [(5, "a b c", 1), (5, "a b c", 1), (7, "a b c", 2), (None, "a b c", 3), (None, None, 4), (9, long, 5), (8, long + " end", 6), (3, "", 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, component_id long")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in minhash_dedup.near_duplicates(frame, width=2).collect())
    assert got == sorted([("5", 2, "5", True)] * 2 + [("7", 2, "5", False), ("None", 2, "None", True), ("None", 0, "None", True), ("9", 59_999, "8", False), ("8", 60_000, "8", True), ("3", 0, "3", True)])
    assert sorted(map(str, (r.doc_id for r in minhash_dedup.keep_one(frame, width=2).collect()))) == ["3", "5", "8", "None"]
    empty = frame.limit(0)
    assert minhash_dedup.near_duplicates(empty).collect() == [] and minhash_dedup.keep_one(empty).columns == frame.columns


def test_repeated_ids_with_different_texts(spark):
    """Only the row whose own text is a near copy goes, and each text of an id keeps its links."""
    copy, clean, other = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40)), " ".join(f"c{k}" for k in range(40))
    rows = [(1, copy), (5, copy + " end"), (5, clean), (6, clean + " end"), (4, other), (4, copy + " last"), (9, other + " end"), (None, copy)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, ((r.doc_id, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(frame, width=2).collect())))
    assert got == sorted(map(str, [(1, 1, True), (5, 1, False), (5, 5, True), (6, 5, False), (4, 4, True), (4, 1, False), (9, 4, False), (None, None, True)]))
    kept = sorted(str(tuple(r)) for r in minhash_dedup.keep_one(frame, width=2).collect())
    assert kept == sorted(str(r) for r in [(1, copy), (5, clean), (4, other)])
    assert minhash_dedup.keep_one(frame.filter("doc_id IS NULL"), width=2).count() == 1


@pytest.mark.parametrize("block", [1024, 16])
def test_large_group_of_near_copies(spark, monkeypatch, block):
    """A group whose members are linked, nearly linked and unlinked to each other, in one block or in many."""
    monkeypatch.setattr(minhash_dedup, "BLOCK_ROWS", block)
    rng = random.Random(9)
    base, other = text_of(rng, 150), text_of(rng, 150)
    docs = [edited(rng, b, rng.randrange(0, 22)) for b in [base] * 300 + [other] * 100]
    # A chain from one group's edge to the other: only single pairs of members link the parts.
    step = base.split(" ")
    for k in range(0, 150, 6):
        step[k : k + 6] = other.split(" ")[k : k + 6]
        docs.append(" ".join(step))
    rng.shuffle(docs)
    rows = list(enumerate(docs))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(frame, width=2).collect()}
    assert got == brute.near_duplicates(rows, 2, 80)


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(3)
    shared, own = rng.integers(0, 1 << 63, 3000, dtype=np.uint64), rng.integers(0, 1 << 63, (40, 2, 375), dtype=np.uint64)
    sets = [np.unique(np.concatenate([shared, o])) for pair in own for o in pair]
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    marks = minhash_dedup.sketch(np.concatenate(sets), ends)
    assert (marks != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    shares = (marks[::2] == marks[1::2]).mean(axis=1)
    assert abs(shares.mean() - 0.8) < 0.03 and shares.std() < 0.05
    one = minhash_dedup.sketch(np.array([7], np.uint64), np.array([0, 1]))
    assert (one != np.uint64(0xFFFFFFFFFFFFFFFF)).all()


def vectors():
    rng = np.random.default_rng(11)
    base = rng.standard_normal((30, 64))
    rows = [b + rng.standard_normal(64) * s for b in base for s in (0, 0.05, 0.15, 0.25, 0.3, 0.33, 0.35)]
    rows += list(rng.standard_normal((60, 64))) + [base[0], base[0] * 2, base[1]]
    rows += [base[2] + rng.standard_normal(64) * 0.01 for _ in range(700)]
    return [x.astype(np.float32).tolist() for x in rows]


def test_near_vectors(spark):
    rows = vectors()
    frame = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>")
    x = np.array(rows, np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(frame, miss=1e-6).collect()}
    n = np.array([got[k].n_links for k in range(len(rows))])
    assert (n <= linked.sum(axis=1)).all() and n.sum() >= 0.999 * linked.sum()
    want = brute.components(range(len(rows)), zip(*np.nonzero(np.triu(linked))))
    assert {k: got[k].component_id for k in want} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_near_vector_edges(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [float("inf"), 1.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in embedding_dedup.near_vectors(frame).collect())
    alone = [(str(k), 0, str(k), True) for k in (3, 4, 5, 6, 7, 8, 9)]
    assert got == sorted([("1", 2, "1", True), ("2", 2, "1", False), ("2", 2, "1", False), ("10", 2, "1", False), ("None", 0, "None", True), *alone])
    assert embedding_dedup.near_vectors(frame.limit(0)).collect() == []


def test_vectors_beside_clashing_columns(spark):
    """Columns that are named like the operator's own change nothing."""
    rows = [(1, [1.0, 0.0]), (2, [0.99, 0.01]), (3, [0.0, 1.0]), (2, [0.99, 0.01])]
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    names = ("id", "n", "dim", "tab", "key", "digest", "code", "factor", "vec", "n_links", "component_id", "kept")
    clash = plain.selectExpr("*", *[f"'x' AS {c}" for c in names])

    def told(df):
        return sorted(map(tuple, embedding_dedup.near_vectors(df).collect()))

    assert told(clash) == told(plain) == [(1, 1, 1, True), (2, 1, 1, False), (2, 1, 1, False), (3, 0, 3, True)]


def test_bound_holds():
    rng = np.random.default_rng(2)
    for dim in (16, 64):
        o = rng.standard_normal((4000, dim))
        q = o + rng.standard_normal((4000, dim)) * rng.random((4000, 1))
        o, q = (x / np.linalg.norm(x, axis=1, keepdims=True) @ embedding_dedup.rotation(dim, 0).T for x in (o, q))
        code = np.sign(o) / np.sqrt(dim)
        factor, dot = (code * o).sum(axis=1), (code * q).sum(axis=1)
        exact = (o * q).sum(axis=1)
        assert (embedding_dedup.upper_bounds(dot, factor, dim) >= exact - 1e-9).mean() > 0.999
        assert abs((dot / factor - exact).mean()) < 0.02


def test_line_dedup(spark):
    rng = random.Random(4)
    lines = [text_of(rng, rng.randrange(1, 20)) for _ in range(60)]

    def changed(line):
        w = line.split(" ")
        k = rng.randrange(len(w))
        return " ".join({0: w[:k] + w[k + 1 :], 1: w[:k] + ["new"] + w[k:], 2: [*w[:k], "other", *w[k + 1 :]]}[rng.randrange(3)])

    docs = [(i, "\n".join(rng.choice([rng.choice(lines), changed(rng.choice(lines)), text_of(rng, 9), "", "  ", "SAME  line", "same line"]) for _ in range(rng.randrange(0, 12)))) for i in range(120)]
    docs += [(500, None), (501, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.dropped_lines for r in line_dedup.dedup_summary(frame).collect()}
    want = brute.dropped_lines(docs, line_dedup.MIN_WORDS)
    assert got == {i: ",".join(map(str, gone)) for i, gone in want.items()}
    cleaned = {r.doc_id: r.text for r in line_dedup.without_repeats(frame).collect()}
    for i, text in docs:
        assert cleaned[i] == (None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in want[i]))
    assert line_dedup.dedup_summary(frame.limit(0)).collect() == []


def test_words_with_other_spaces(spark):
    """A no-break or ideographic space is part of a word, so one changed word stays one edit."""
    pairs = [("Bonjour\u00a0!", "Salut\u00a0?"), ("日\u3000本", "中\u3000国"), ("x\u0085y", "v\u0085w")]
    docs = [(2 * k + n, f"k{k} " + " ".join(f"u{k}x{j}" for j in range(8)) + " " + word) for k, pair in enumerate(pairs) for n, word in enumerate(pair)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.dropped_lines for r in line_dedup.dedup_summary(frame).collect()} == {0: "", 1: "0", 2: "", 3: "0", 4: "", 5: "0"}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)] + [(1000, k) for k in range(1001, 1400)] + [(k, k + 1) for k in range(2000, 2100)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in common.connected_components(frame).collect()}
    want = brute.components({x for e in edges for x in e}, edges)
    assert got == {k: v for k, v in want.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_whole_runs():
    keys = sorted(random.Random(2).choices(range(9), k=200))
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[k : k + 7])], names=["k"]) for k in range(0, 200, 7)]
    tables = list(common.whole_runs(batches, ["k"]))
    seen = [set(t.column("k").to_pylist()) for t in tables]
    assert sum(t.num_rows for t in tables) == 200 and all(not a & b for k, a in enumerate(seen) for b in seen[:k])


def test_rows_of_one_id_keep_their_own_lines(spark):
    """Rows that share an id or have none lose only their own repeats; one of several equal rows stays whole."""
    long = "one two three four five six seven eight"
    rows = [(1, "shared line\nunique a"), (5, "shared line\nx"), (5, "precious first line\nshared line"), (None, "only in null row\ntail"), (None, "shared line\nend"), (7, "same\nrow"), (7, "same\nrow"), (8, long), (8, long + " nine"), (9, None), (9, "")]
    frame = spark.createDataFrame([(*r, k, k, k) for k, r in enumerate(rows)], "doc_id long, text string, row int, gone int, line_no int")
    want = ["shared line\nunique a", "x", "precious first line", "only in null row\ntail", "end", "same\nrow", "", long, "", None, ""]
    for parts in (1, 3):
        cleaned = line_dedup.without_repeats(frame.repartition(parts).sortWithinPartitions("gone") if parts > 1 else frame.coalesce(1))
        got = {r.gone: (r.doc_id, r.text, r.row, r.line_no) for r in cleaned.collect()}
        assert cleaned.columns == frame.columns and len(got) == len(rows)
        assert all(got[k] == (i, w, k, k) for k, ((i, _), w) in enumerate(zip(rows, want)) if i not in (7, 8))
        # Which of the equal or nearly equal rows of an id comes first is a matter of how they are stored.
        assert sorted(got[k][1] for k in (5, 6)) == ["", "same\nrow"] and sorted(got[k][1] == "" for k in (7, 8)) == [False, True]
    summary = {str(r.doc_id): (r.n_lines, r.n_kept) for r in line_dedup.dedup_summary(frame).collect()}
    kept = {}
    for i, text, _, _ in got.values():
        kept[str(i)] = kept.get(str(i), 0) + sum(bool(line.split()) for line in (text or "").split("\n"))
    assert {i: n for i, (_, n) in summary.items()} == kept and summary["5"] == (4, 2)


def counted_tables(monkeypatch, module, ending):
    """Rows of the scratch tables of that name, as they are written."""
    rows, real = [], module.materialize

    def noted(df, name, *args):
        out = real(df, name, *args)
        if name.endswith(ending):
            rows.append(out.count())
        return out

    monkeypatch.setattr(module, "materialize", noted)
    return rows


def test_repeated_rows_are_verified_once(spark, monkeypatch):
    """Thousands of rows without an id that share a text send one row of it to verification."""
    rng = random.Random(12)
    base = text_of(rng, 80)
    docs = [(None, base)] * 10_000 + [(k, edited(rng, base, 1)) for k in range(20)] + [(500, base)] * 3000
    verified = counted_tables(monkeypatch, minhash_dedup, "-links")
    kept = minhash_dedup.keep_one(spark.createDataFrame(docs, "doc_id long, text string"), width=2).collect()
    assert len(kept) == 1 and kept[0].doc_id == 0
    assert sum(verified) <= 60


def test_group_just_below_the_threshold(spark, monkeypatch):
    """Variants that share nearly four fifths with each other, none of them linked: few pairs are verified on texts."""
    rng = random.Random(3)
    base = [f"k{k}" for k in range(432)]
    docs = []
    for i in range(300):
        own = list(base)
        at = rng.randrange(0, 6)
        own[at * 60 : at * 60 + 49] = [f"d{i}x{j}" for j in range(49)]
        docs.append((i, " ".join(own)))
    want = brute.near_duplicates(docs[:60], 2, 80)
    verified = counted_tables(monkeypatch, minhash_dedup, "-links")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), width=2).collect()}
    assert {i: got[i] for i in want} == want and all(i == c for i, (_, c) in got.items())
    assert sum(verified) < 10 * len(docs)

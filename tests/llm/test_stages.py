"""Decontamination, mixing, quality, token output and the pipeline."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dialogue_etl.llm import decontaminate, mixing, quality, token_output
from tests.llm import brute

ITEMS = {1: "The quick brown fox jumps over the lazy dog and then it sleeps all day long", 2: "short one", 3: "", 4: None, 5: "a b c d e f g h i j k l m", 6: "été Zürich"}


def bench(spark, items=ITEMS):
    return spark.createDataFrame(list(items.items()), "item_id long, text string")


def documents(spark):
    rng = np.random.default_rng(8)
    filler = ["alpha", "beta", "gamma", "delta", "dog", "short", "a", "b", "été"]
    rows = [(i, " ".join(rng.choice(filler, rng.integers(0, 90))) + " " + (ITEMS[1] if i % 7 == 0 else "Short-ONE" if i % 7 == 1 else "a b c d e f g h i j k l m n a" if i % 7 == 2 else "")) for i in range(140)]
    rows += [(200, None), (201, ""), (202, ITEMS[1].upper()), (202, ITEMS[1].upper()), (203, "x" * 200_000 + " " + ITEMS[1]), (204, "ÉTÉ zürich été ZüRICH"), (None, "short one")]
    return spark.createDataFrame([(i, t, "m") for i, t in rows], "doc_id long, text string, n_words string"), rows


@pytest.mark.parametrize("most", [500_000, 20])
def test_occurrences(spark, most):
    frame, rows = documents(spark)
    got = sorted((str(r.row_key), r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.occurrences(frame, bench(spark), max_windows=most).collect())
    want = {(i, t): brute.hits(t, ITEMS) for i, t in rows}
    plain = [(str(i), want[i, t][0], want[i, t][1], tuple(sorted(want[i, t][2]))) for i, t in rows]
    assert got == sorted(plain)


def test_decontaminated_rows(spark):
    frame, rows = documents(spark)
    kept = decontaminate.decontaminate(frame, bench(spark))
    bad = [t for _, t in rows for n, h, _ in [brute.hits(t, ITEMS)] if h and 20 * h >= n]
    assert sorted(str(r.text) for r in kept.collect()) == sorted(str(t) for _, t in rows if t not in bad) and kept.columns == frame.columns
    assert decontaminate.decontaminate(frame, bench(spark).limit(0)).count() == len(rows)
    assert decontaminate.contamination(frame.limit(0), bench(spark)).collect() == []


@pytest.mark.parametrize("most", [500_000, 20])
def test_clashing_columns_stay(spark, most):
    frame = spark.createDataFrame([(1, "short one and", 7, 8), (2, "nothing else", 9, 10)], "doc_id long, text string, row int, _ROW int")
    assert [tuple(r) for r in decontaminate.decontaminate(frame, bench(spark), max_windows=most).collect()] == [(2, "nothing else", 9, 10)]


def test_blocks_judge_row_by_row(spark):
    """With several blocks too, rows that share an id or have none are judged on their own texts."""
    dirty, clean = "short one and", "nothing else here"
    rows = [(1, dirty), (1, clean), (1, clean), (2, dirty), (2, dirty), (None, dirty), (None, clean), (None, None), (3, "a b c d e f g h i j k l m"), (4, "short one a b c d e f g h i j k l m")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")

    def answers(most):
        return sorted(str(tuple(r)) for r in decontaminate.contamination(frame, bench(spark), max_windows=most).collect())

    assert len(answers(20)) == len(rows) and answers(20) == answers(500_000)
    bad = [t for _, t in rows for n, h, _ in [brute.hits(t, ITEMS)] if h and 20 * h >= n]
    for most in (20, 500_000):
        kept = decontaminate.decontaminate(frame, bench(spark), max_windows=most)
        assert sorted(map(str, kept.collect())) == sorted(str(r) for r in frame.collect() if r.text not in bad)


def test_mix_edges(spark):
    rows = [(i, "w " * (1 + i % 5), f"s{i % 4}" if i % 6 else None) for i in range(300)] + [(900, None, "s0"), (901, "", "s1"), (902, "", "empty"), (5, "w " * 1, "s1"), (None, "w w", "s2")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size")
    got = mixing.mix(frame)
    out = got.collect()
    total = sum(r.size for r in out)
    by_target = {}
    for r in out:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        by_target.setdefault((r.source_size, r.target), []).append(r.taken)
    assert len(out) == len(rows) and abs(sum(t for _, t in by_target) - 1.5 * total) < 1e-6
    assert all(abs(sum(v) - t) <= 6 and t <= 2 * s for (s, t), v in by_target.items())
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(frame).collect()))
    mixed = mixing.mixed(frame)
    assert mixed.columns == frame.columns and mixed.count() == sum(r.copies for r in out)
    assert mixing.mix(frame.limit(0)).collect() == [] and mixing.mixed(frame.limit(0)).collect() == []


def test_token_output(spark, tmp_path):
    texts = ["", None, "Hello  world", "it's\n\nfine ", "été 日本　x", "<|endoftext|> hi", "a\tb", "same text", "same text"] + [f"word{k} and, more. words\nnext line {k * 7}" for k in range(400)]
    rows = [((k * 37) % 1000 - 3, t, "x") for k, t in enumerate(texts)] + [(None, "null id", "x"), (4, "long " * 30_000, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, tokens string")
    tokenizer = Tokenizer.from_file(token_output.default_tokenizer())
    path = f"file://{tmp_path}/ids"
    token_output.write_tokens(frame, path, token_output.default_tokenizer())
    files = {(-(10**9) if r.doc_id is None else r.doc_id): list(r.tokens) for r in token_output.read_tokens(spark, path).collect()}
    got = sorted(token_output.token_index(spark, path).collect(), key=lambda r: r.start)
    start = 0
    for i, t in sorted(((-(10**9) if i is None else i), t) for i, t, _ in rows):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        r = got.pop(0)
        assert (r.doc_id if r.doc_id is not None else -(10**9), r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert files[i] == ids
        start += len(ids)
    assert spark.read.orc(path).filter("doc_id = 34").count() == 1
    assert token_output.tokenize(frame.limit(0), token_output.default_tokenizer()).collect() == []


def test_repeated_ids_keep_the_order_of_the_files(spark, tmp_path):
    texts = ["b", "a longer text, here", "", None, "b", "x y"]
    frame = spark.createDataFrame([(k // 6, t) for k, t in enumerate(texts * 20)], "doc_id long, text string")
    path = token_output.write_tokens(frame, f"file://{tmp_path}/ids", token_output.default_tokenizer())
    files = sorted((f.path for f in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path").collect()), key=lambda x: x.rpartition("/")[2])
    start, want = 0, []
    for f in files:
        for r in spark.read.schema(token_output.SCHEMA).orc(f).collect():
            want.append((r.doc_id, start, len(r.tokens), zlib.crc32(np.array(r.tokens, "<u4").tobytes())))
            start += len(r.tokens)
    assert sorted(tuple(r) for r in token_output.token_index(spark, path).collect()) == sorted(want) and len(want) == 120


def rows_of_scan(frame):
    """Rows that the frame's file scan gave out."""
    frame.write.format("noop").mode("overwrite").save()
    todo, found = [frame._jdf.queryExecution().executedPlan()], []
    frame.collect()
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif node.nodeName().startswith("Scan"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


def test_lookups_skip_rows(spark, tmp_path):
    frame = spark.range(20_000).selectExpr("id * 2 AS doc_id", "concat('text ', id) AS text")
    path = token_output.write_tokens(frame, f"file://{tmp_path}/ids", token_output.default_tokenizer())
    wanted = spark.createDataFrame([(10,), (20_010,), (20_011,), (None,)], "doc_id long")
    found = token_output.read_tokens(spark, path, wanted)
    assert {r.doc_id for r in found.collect()} == {10, 20_010}
    assert sum(rows_of_scan(found)) <= 2_000
    assert {r.doc_id for r in token_output.read_tokens(spark, path, spark.range(3000, 6000).toDF("doc_id")).collect()} == set(range(3000, 6000, 2))


@pytest.mark.parametrize("most", [60, 1 << 20])
def test_encoder_gives_the_tokenizers_ids(most):
    import pyarrow as pa

    rng = np.random.default_rng(6)
    parts = ["word", "Wörter", "it's", "x2", "12", "...", "end.", "wow!!", "l'été", "日本", "ß", "ª½", "a_b", "\n", " ", "\t", "\u00a0", "<|endoftext|>", "(", "é\u0301", "don't", "-", "Ⅷ", "\x00", "😀"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.integers(0, 12))) for _ in range(3000)]
    encode = token_output.Encoder(token_output.default_tokenizer(), max_words=most)
    tokenizer = Tokenizer.from_file(token_output.default_tokenizer())
    for k in range(0, len(texts), 250):
        got = encode(pa.array(texts[k : k + 250])).to_pylist()
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in texts[k : k + 250]]


def quality_tables(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(900):
        good = i % 4 != 0
        words = rng.choice(["the", "of", "reading", "river", "green", "and", "walks"], 60) if good else rng.choice(["BUY!!", "$$$", "###", "click***"], 60)
        rows.append((i, " ".join(words), "en", "good.example" if good else "spam.example", int(good)))
    docs = spark.createDataFrame([(i, t, a, s, "x") for i, t, a, s, _ in rows] + [(2000, None, None, None, "x"), (2001, "", "en", None, "x"), (None, "the river", None, "a", "x")], "doc_id long, text string, lang string, source string, score string")
    return docs, rows


def test_quality(spark):
    docs, rows = quality_tables(spark)
    labels = spark.createDataFrame([(i, q) for i, _, _, _, q in rows if i % 3] + [(5, 1), (None, 1), (7, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.score(docs, labels, max_labelled=400).collect()}
    held = [i for i, *_ in rows if i % 3 == 0]
    truth = {i: bool(q) for i, _, _, _, q in rows}
    assert np.mean([got[i].keep == truth[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 and 0 <= r.p_text <= 1 and 0 <= r.p_meta <= 1 for r in got.values()) and len(got) == len(rows) + 3
    kept = quality.keep_good(docs, labels, max_labelled=400)
    assert kept.columns == docs.columns and abs(kept.count() - sum(r.keep for r in got.values())) <= 3
    one_class = labels.filter("quality = 1")
    assert {r.score for r in quality.score(docs, one_class).collect()} == {1.0}
    assert quality.keep_good(docs, labels.limit(0)).count() == docs.count()
    assert quality.score(docs.limit(0), labels).collect() == []


def test_quality_of_repeated_and_very_long_rows(spark):
    """Equal rows are judged alike, whatever their number; a text of a million words is read whole."""
    docs, rows = quality_tables(spark)
    labels = spark.createDataFrame([(i, q) for i, _, _, _, q in rows], "doc_id long, quality int")
    one = docs.filter(f"doc_id = {rows[0][0]}")
    many = docs
    for _ in range(4):
        many = many.unionByName(one)
    long = one.withColumns({"doc_id": F.lit(10**6), "text": F.concat(F.repeat("text", 20_000), F.lit(" end"))})
    got = quality.score(many.unionByName(long), labels, max_labelled=400).collect()
    assert len({(round(r.score, 9), r.keep) for r in got if r.doc_id == rows[0][0]}) == 1 and sum(r.doc_id == rows[0][0] for r in got) == 5
    assert [0 <= r.score <= 1 for r in got if r.doc_id == 10**6] == [True]


def test_sizes_of_very_long_texts(spark):
    """A text of a million words counts them all and stays within twice its size."""
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "doc_id long, source string").withColumn("text", F.when(F.col("doc_id") == 1, F.repeat(F.lit("word "), 1_000_000)).otherwise("x y"))
    got = {r.doc_id: (r.size, r.taken) for r in mixing.mix(docs).collect()}
    assert got[1][0] == 1_000_000 and 0 <= got[1][1] <= 2_000_000 and got[2][0] == got[3][0] == 2


def test_quality_on_held_out_labels(spark):
    """Documents whose labels the classifier hasn't seen, and the share of views: no feature is in both."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    got = quality.score(docs, labels.filter(fold > 0)).join(labels.filter(fold == 0), "doc_id").select("score", "p_text", "p_meta", "quality").toPandas()
    good = got.loc[got.quality == 1]
    bad = got.loc[got.quality == 0]
    auc = {c: np.mean([(good[c].to_numpy()[:, None] > bad[c].to_numpy()).mean(), (good[c].to_numpy()[:, None] >= bad[c].to_numpy()).mean()]) for c in ("score", "p_text", "p_meta")}
    print(len(got), auc, ((got.score > 0.5) == (got.quality == 1)).mean())
    assert auc["score"] > 0.85 and auc["score"] >= max(auc["p_text"], auc["p_meta"]) - 0.03
    assert ((got.score > 0.5) == (got.quality == 1)).mean() > max(len(good), len(bad)) / len(got)


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "token_ids"]
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        after = stage(spark, docs, sf_dir)
        rows = spark.createDataFrame(after.collect(), after.schema)
        if name != "token_ids":
            assert rows.columns == columns
        now = {r.doc_id for r in rows.collect()}
        at = {c: k for k, c in enumerate(columns)}
        if name == "near_dedup":
            found = brute.near_duplicates([(r[at["doc_id"]], r[at["text"]]) for r in before], 5, 80)
            assert now == {i for i, (_, c) in found.items() if i == c}
        elif name == "decontaminate":
            judged = {r[at["doc_id"]]: brute.hits(r[at["text"]], items) for r in before}
            assert now == {i for i, (n, h, _) in judged.items() if not (h and 20 * h >= n)}
        elif name == "mix":
            assert sum(len(brute.words(r.text)) for r in rows.collect()) == pytest.approx(1.5 * sum(len(brute.words(r[at["text"]])) for r in before), rel=0.2)
        elif name == "token_ids":
            assert rows.count() == len(before)
        docs = rows

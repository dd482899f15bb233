"""The keyed table, the named-file sink and coverage counting: bounds, faults and repeated work."""

import os
import random

import pytest
from pyspark.sql import functions as F

from dialogue_etl.operators import coverage as V
from dialogue_etl.plans.shared import save, scratch
from dialogue_etl.sources import documents as D
from dialogue_etl.sources.keyed import KeyedTable
from dialogue_etl.streaming import ingest as J


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def stored(spark, table):
    return sorted(tuple(r) for r in table.rows(spark).select("url", "page_id", "html").collect())


def partitions_read(df) -> int:
    return df._jdf.queryExecution().sparkPlan().collectLeaves().head().selectedPartitions().partitionCount()


def test_batch_reads_and_writes_only_its_partitions(spark):
    table = KeyedTable(scratch(spark, "keyed"), J.PAGE_SCHEMA, "url", slots=16, filter_bits=1 << 15)
    for number in range(3):
        table.merge(pages(spark, [(k, f"u{k}", "x") for k in range(40 * number, 40 * number + 40)]), number)
    held = {(r[0], r[1]): r[2] for r in table.earlier(spark, list(range(16)), 9).select("slot", "batch", F.input_file_name()).collect()}
    slot = table.earlier(spark, list(range(16)), 9).filter("url = 'u5'").first().slot
    looked = table.earlier(spark, [slot], 2)
    assert 0 < partitions_read(looked) <= 2 < len(held)
    # A page that is new touches one partition; all others keep their files.
    table.merge(pages(spark, [(5, "u5", "again"), (900, "u900", "new")]), 3)
    after = {(r[0], r[1]): r[2] for r in table.earlier(spark, list(range(16)), 9).select("slot", "batch", F.input_file_name()).collect()}
    assert {k: v for k, v in after.items() if k[1] < 3} == held and sum(k[1] == 3 for k in after) == 1
    assert len(stored(spark, table)) == 121 and ("u5", 5, "x") in stored(spark, table)


def test_forced_pages_replace_and_batches_repeat(spark, monkeypatch):
    table = KeyedTable(scratch(spark, "keyed"), J.PAGE_SCHEMA, "url", slots=2, filter_bits=1 << 15)
    first, second = pages(spark, [(k, f"u{k}", "x") for k in range(6)] + [(9, None, "none")]), pages(spark, [(10, "u1", "y"), (11, "u7", "y")])
    table.merge(first, 0)
    for _ in range(2):
        table.merge(second, 1, force=True)
        want = sorted([(f"u{k}", k, "x") for k in range(6) if k != 1] + [("u1", 10, "y"), ("u7", 11, "y")])
        assert stored(spark, table) == want
    # All of a partition's rows are replaced: none of them stays.
    everything = pages(spark, [(k, f"u{k}", "z") for k in range(8)])
    # A crash after the new rows are published, before the old ones are gone: the repeated batch ends the work.
    monkeypatch.setattr(KeyedTable, "_publish", lambda self, rows: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.merge(everything, 2, force=True)
    assert stored(spark, table) == want
    monkeypatch.undo()
    table.merge(everything, 2, force=True)
    assert stored(spark, table) == sorted((f"u{k}", k, "z") for k in range(8))
    table.merge(first, 3)
    assert len(stored(spark, table)) == 8


def test_filter_lets_all_known_keys_through_and_few_others(spark):
    table = KeyedTable(scratch(spark, "keyed"), "url string", "url", slots=4, filter_bits=1 << 15)
    table.merge(spark.range(3000).select(F.concat(F.lit("u"), "id").alias("url")), 0)
    assert KeyedTable(table.path, "url string", "url", slots=9)._layout(spark) == (4, 1 << 15)
    keys = spark.range(6000).select(F.concat(F.lit("u"), "id").alias("url")).withColumn("slot", F.pmod(F.xxhash64("url"), F.lit(4)).cast("int"))
    maybe = {r.url for r in table._maybe(keys, 1).collect()}
    assert {f"u{k}" for k in range(3000)} <= maybe and len(maybe) < 3060
    assert table.known(keys, 1).count() == 3000 and table.known(keys, 0).count() == 0
    assert table.known(keys.limit(0), 1).count() == 0


def test_ingest_in_streams(spark):
    incoming, table = scratch(spark, "incoming"), J.pages_table(scratch(spark, "table"), 4)
    pages(spark, [(2, "http://a/x#1", "one"), (1, "http://a/x", "two"), (3, None, "no"), (None, "http://a/y", "y")]).coalesce(1).write.parquet(incoming)
    J.ingest(spark, incoming, table, scratch(spark, "log"))
    assert stored(spark, table) == [("http://a/x", 1, "two"), ("http://a/y", None, "y")]
    # Another stream into the same table starts after the numbers of the first one.
    other, log = scratch(spark, "incoming"), scratch(spark, "log")
    pages(spark, [(7, "http://a/x", "new"), (8, "http://a/z", "z")]).coalesce(1).write.parquet(other)
    J.ingest(spark, other, table, log)
    J.ingest(spark, other, table, log)
    assert stored(spark, table) == [("http://a/x", 1, "two"), ("http://a/y", None, "y"), ("http://a/z", 8, "z")]
    assert table.first_batch(spark, log) == 1
    J.ingest(spark, other, table, scratch(spark, "log"), force=True)
    assert stored(spark, table)[0] == ("http://a/x", 7, "new")


def test_documents_are_published_whole_or_not_at_all(spark):
    path = scratch(spark, "docs")
    local = path.removeprefix("file://")
    texts = spark.createDataFrame([("001_3.0_星 穹+é%", "a\nb"), ("sub/two", None), ("three", "")], "name string, text string")
    D.write_documents(texts, path, "name")
    want = [("001_3.0_星 穹+é%", "a\nb\n"), ("sub/two", "\n"), ("three", "\n")]
    assert sorted(map(tuple, D.read_documents(spark, path, "name").collect())) == want
    assert sorted(os.listdir(local)) == ["001_3.0_星 穹+é%.md", "sub", "three.md"]
    # One task fails after others have written: the old files stay, nothing else is left.
    bad = spark.range(200).select(F.concat(F.lit("n"), "id").alias("name"), F.when(F.col("id") == 150, F.raise_error(F.lit("broken"))).otherwise(F.lit("new")).alias("text"))
    for rows in (bad, spark.createDataFrame([("x", "1"), ("x", "2")], texts.schema), spark.createDataFrame([("../x", "1")], texts.schema), spark.createDataFrame([(None, "1")], texts.schema)):
        with pytest.raises(Exception):
            D.write_documents(rows, path, "name")
        assert sorted(map(tuple, D.read_documents(spark, path, "name").collect())) == want
    parent, base = os.path.split(local)
    assert [f for f in os.listdir(parent) if base in f and f != base] == []
    D.write_documents(texts.filter("name = 'three'"), path, "name", suffix=".txt")
    assert os.listdir(local) == ["three.txt"]
    D.write_documents(texts.limit(0), path, "name")
    assert os.listdir(local) == []


def test_small_documents_are_read_many_a_task(spark):
    """Tasks grow with files and bytes, not with Spark's cost of opening a file; every file is read once."""
    path = scratch(spark, "docs")
    texts = spark.range(2000).select(F.concat(F.when(F.col("id") % 2 == 0, "_").otherwise("sub/"), "id").alias("name"), F.repeat(F.lit("é"), F.col("id").cast("int")).alias("text"))
    D.write_documents(texts, path, "name")
    read = D.read_documents(spark, path, "name")
    assert read.rdd.getNumPartitions() == -(-2000 // D.TASK_FILES)
    assert sorted(map(tuple, read.collect())) == sorted((f"{'sub/' if k % 2 else '_'}{k}", "é" * k + "\n") for k in range(2000))
    D.write_documents(texts.limit(0), path, "name")
    assert D.read_documents(spark, path, "name").collect() == []


def test_counts_without_overlap():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 40)))
        keys = ["".join(rng.choice("ab") for _ in range(rng.randrange(0, 5))) for _ in range(8)]
        assert V.counts_in(keys, text) == [text.count(k) if k else 0 for k in keys]


def test_coverage_of_a_long_page(spark):
    """100,000 lines of one page, each a key of its own; settled and unsettled keys give the same rows."""
    lines = [("p", k, "text", f"line {k}", f"line{k:06d}x") for k in range(100_000)]
    items = save(spark.createDataFrame(lines, "page string, pos int, kind string, text string, key string"))
    target = items.filter("pos % 1000 <> 7")
    short = V.missing_items(items, V.joined_keys(target), None)
    assert [r.pos for r in short.orderBy("pos").collect()] == list(range(7, 100_000, 1000))
    again = V.missing_items(items, V.joined_keys(target), None, target)
    assert again.exceptAll(short).isEmpty() and again.count() == short.count()
    extra = V.extra_items(items, V.joined_keys(target), 10, target)
    assert sorted(r.text for r in extra.collect()) == sorted(f"line {k}" for k in range(7, 10_000, 1000))

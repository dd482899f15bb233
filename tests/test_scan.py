"""Segments of long documents, phases of versions and the queue of a closure against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from dialogue_etl.operators import evidence as E
from dialogue_etl.operators import graph as G
from dialogue_etl.operators import lines as L
from dialogue_etl.operators.scan import with_neighbours
from dialogue_etl.plans.shared import save, scratch


def told(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def lines(spark):
    """Documents of many, few and one line, with gaps in their numbers, and one without a name."""
    rng = random.Random(7)
    parts = ["", "  ", "a：b", "星", "丹恒", "hello", "所属版本 3.1", "所属版本 4", "剧情内容", "额外对话x", "任务描述 t", "- item", "same", "same", "# h"]
    rows = [(name, k, rng.choice(parts)) for name, n in (("long", 900), ("short", 12), ("one", 1), (None, 40)) for k in range(1, n + 1) if rng.random() < 0.9 or n == 1]
    return save(spark.createDataFrame(rows, "source string, line_no int, line string").repartition(3))


OPERATORS = {
    "duplicates": L.drop_consecutive_duplicates,
    "pairs": lambda df, segment=None: L.repair_speaker_pairs(df.withColumn("hinted", F.col("line").isin("星", "丹恒")), segment),
    "markdown": lambda df, segment=None: L.repair_markdown_pairs(df, ["星", "丹恒"], segment),
    "tidy": L.tidy_lines,
    "sections": lambda df, segment=None: L.build_sections(L.normalized_lines(df, None, segment), segment),
    "names": lambda df, segment=None: L.with_section_names(L.normalized_lines(df, None, segment), segment),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_segments_give_the_same_rows(spark, lines, name):
    whole = told(OPERATORS[name](lines))
    assert whole and all(told(OPERATORS[name](lines, segment=n)) == whole for n in (1, 7, 100))


def test_section_names_by_hand(spark):
    text = ["剧情内容", "x", "所属版本 3.1", "y", "过场动画", "剧情内容", "所属版本 3.2", "z", "额外对话x", "所属版本 3.3", "过场动画"]
    docs = save(spark.createDataFrame([("d", k + 1, x) for k, x in enumerate(text)], "source string, line_no int, line string"))
    for segment in (None, 2, 3):
        got = [(r.line_no, r.section_no, r.section_title, r.version) for r in L.with_section_names(L.normalized_lines(docs, None, segment), segment).orderBy("line_no").collect()]
        assert got == [(k, 1, "Prelude section 1", None) for k in (1, 2)] + [(k, 2, "过场动画", "3.1") for k in (3, 4, 5, 6)] + [(k, 3, "Version 3.2 section 3", "3.2") for k in (7, 8, 9)] + [(k, 4, "过场动画", "3.3") for k in (10, 11)]


def test_document_of_ten_million_lines(spark):
    """No task sees more of it than some segments, and the values are those of one whole window."""
    n = 10_000_000
    rows = spark.range(n).select(F.lit("d").alias("source"), (F.col("id") + 1).alias("line_no"), F.when(F.col("id") % 999_983 == 5, F.col("id")).alias("mark"))
    got = with_neighbours(rows, {"here": ("last_here", F.col("mark")), "next": ("first_after", F.col("mark")), "so_far": ("sum", F.col("mark").isNotNull().cast("long"))}, segment=100_000)
    k = F.col("line_no") - 1
    last = F.when(k >= 5, k - (k - 5) % 999_983)
    ahead = F.coalesce(last + 999_983, F.lit(5))
    wrong = ~F.col("here").eqNullSafe(last) | ~F.col("next").eqNullSafe(F.when(ahead < n, ahead)) | (F.col("so_far") != F.coalesce(F.floor((k - 5) / 999_983) + 1, F.lit(0)))
    counts = got.withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.count("*").alias("n"), F.count_if(wrong).alias("bad")).collect()
    assert sum(r.n for r in counts) == n and sum(r.bad for r in counts) == 0 and len(counts) > 4 and max(r.n for r in counts) < n / 2


def test_phases(spark):
    rng = random.Random(3)
    numbers = ["3", "3.0", "3.0.1", "3.2", "3.10", "3.9", "4", "10.1", "2.9.9", "3.2.0.0.0.0.0.1"]
    phases = [(f"p{k}", *rng.choices([None, *numbers], k=2)) for k in range(14)]
    versions = [*numbers, "x", "", None, "3.1", "0"]

    def key(v):
        return [int(x) for x in v.split(".")] + [0] * (8 - v.count(".")) if v and v != "x" else None

    want = []
    for v in versions:
        inside = [(name, k) for k, (name, low, high) in enumerate(phases) if key(v) and (low is None or key(low) <= key(v)) and (high is None or key(v) < key(high))]
        want += [(v, name, k) for name, k in inside or [(None, None)]]
    frame, table = spark.createDataFrame([(v,) for v in versions], "version string"), E.phase_table(spark, phases)
    tagged = E.with_phases(frame, table, save).select("version", "phase", "phase_rank")
    assert told(tagged) == sorted(f"Row(version={v!r}, phase={p!r}, phase_rank={k!r})" for v, p, k in want)
    assert {r.phase_rank for r in E.up_to_phase(tagged, table, "p4").collect()} == {k for _, _, k in want if k is not None and k <= 4}
    assert E.up_to_phase(tagged, table).count() == sum(k is not None for _, _, k in want)
    with pytest.raises(ValueError, match="no phase"):
        E.up_to_phase(tagged, table, "p99")
    assert E.with_phases(frame.limit(0), table, save).count() == 0 and E.with_phases(frame, table.limit(0), save).count() == len(versions)


def queue(seeds, links, status, known, most):
    waiting, seen, out, accepted = list(seeds), set(), [], 0
    while waiting and accepted < most:
        url = waiting.pop(0)
        if url in seen:
            continue
        seen.add(url)
        out.append(url)
        accepted += status.get(url) in ("in_range", "version_unknown")
        if status.get(url) == "in_range":
            waiting += [to for to in links.get(url, []) if to not in seen and to not in known]
    return out


@pytest.mark.parametrize("most", [1, 7, 40, 1000])
def test_capped_closure_is_a_queue(spark, most):
    rng = random.Random(most)
    names = [f"u{k}" for k in range(120)]
    status = {u: rng.choice(["in_range"] * 4 + ["version_unknown", "skipped_by_min_version"]) for u in names[:110]}
    links = {u: rng.choices(names, k=rng.randrange(0, 4)) for u in names}
    seeds, known = ["u3", "u90", "u7", "u3"], {"u11", "u50"}
    edges = save(spark.createDataFrame([(u, to, "next_task", k) for u in names for k, to in enumerate(links[u])] + [("u3", "u99", "series", 0)], "from string, to string, type string, pos int"))
    nodes = save(spark.createDataFrame(list(status.items()), "url string, version_status string"))
    first = spark.createDataFrame([(u, k) for k, u in enumerate(seeds)], "url string, pos int")
    folder = scratch(spark, "visited")
    got = G.link_closure(first, edges, nodes, ["next_task"], save, folder, max_pages=most, known=spark.createDataFrame([(u,) for u in known], "url string"))
    assert [r.url for r in got.orderBy("number").collect()] == queue(seeds, links, status, known, most)
    # Each page is written once.
    assert spark.read.parquet(folder).groupBy("url").count().filter("count > 1").isEmpty()


def test_bucketed_upsert(spark, monkeypatch):
    """Only the new side is shuffled; ties of one key don't occur, null fields don't overwrite, a crash loses nothing."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        old = spark.createDataFrame([(f"u{k}", k % 3, "old", k) for k in range(200)], "url string, kind int, title string, n int")
        new = spark.createDataFrame([(f"u{k}", k % 3, None if k % 2 else "new", None) for k in range(150, 250)], old.schema)
        G.create_table(old, "bucketed_pages", ["url", "kind"], 8)
        plan = G.latest_wins(spark.table("bucketed_pages"), new, ["url", "kind"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        monkeypatch.setattr(G, "finish", lambda *_: None)
        G.upsert_table(new, "bucketed_pages", ["url", "kind"], 8)  # ends before the new state is in place
        assert spark.table("bucketed_pages").count() == 200
        monkeypatch.undo()
        G.upsert_table(new, "bucketed_pages", ["url", "kind"], 8)
        got = {r.url: (r.title, r.n) for r in spark.table("bucketed_pages").collect()}
        want = {f"u{k}": ("new" if k >= 150 and k % 2 == 0 else "old" if k < 200 else None, k if k < 200 else None) for k in range(250)}
        assert got == want and not spark.catalog.tableExists("bucketed_pages__whole")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_pages", "bucketed_pages__next", "bucketed_pages__whole"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")

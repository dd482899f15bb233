"""Queries against their SQL on rows that the given tables have only where they are large."""

import random
import re
import time

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dialogue_etl import registry
from dialogue_etl.functions import text as T
from dialogue_etl.functions.pages import PIECE, in_pieces
from tests.test_queries import rows

QUERIES, SQL = registry.queries(), registry.oracle_sql()


def check(spark, folder, name):
    con = duckdb.connect()
    for path in folder.glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got, want = QUERIES[name](spark, str(folder)).toPandas(), con.sql(SQL[name]).df()
    assert len(got) and rows(got) == rows(want)


@pytest.fixture(scope="module")
def repeated(tmp_path_factory):
    """Conversations whose lines are said twice in a row, within a turn, across a blank line and across turns."""
    folder = tmp_path_factory.mktemp("repeated")
    texts = "(0, 'system', 'Be.'), (1, 'user', 'a' || chr(10) || 'a'), (3, 'user', 'b' || chr(10) || 'b'), (4, 'user', 'b' || chr(10) || ' ' || chr(10) || 'b' || chr(10) || 'c'), (5, 'user', 'c' || chr(10) || 'c'), (6, 'user', 'c')"
    duckdb.sql(f"COPY (SELECT conv_id, turn::BIGINT AS turn, role, text FROM range(3) c(conv_id), (VALUES {texts}) t(turn, role, text)) TO '{folder}/conversations.parquet'")
    return folder


@pytest.mark.parametrize("name", ["a6_dialogue_markdown", "a7_lines_to_text", "f2_dialogue_pipeline", "f3_kind_counts"])
def test_repeated_speech_stays(name, spark, repeated):
    check(spark, repeated, name)


@pytest.fixture(scope="module")
def cut(tmp_path_factory):
    """Pages whose titles end inside a character reference."""
    folder = tmp_path_factory.mktemp("cut")
    title = "'a &amp;' || x"
    page = f"'<html><head><title>' || {title} || '</title></head><body><article><h1>' || {title} || '</h1><p>b &amp; c &copy; d</p></article></body></html>'"
    duckdb.sql(f"COPY (SELECT page_id, 'https://w.example/' || page_id AS url, {page} AS html FROM range(9) p(page_id), (VALUES ('&amp'), ('&am'), ('&')) t(x) WHERE page_id // 3 = CASE x WHEN '&amp' THEN 0 WHEN '&am' THEN 1 ELSE 2 END) TO '{folder}/pages.parquet'")
    return folder


@pytest.mark.parametrize("name", ["b1_html_unescape", "b10_strip_tags", "b12_page_title", "c1_visible_text", "c2_main_content_text"])
def test_titles_cut_inside_a_reference(name, spark, cut):
    check(spark, cut, name)


def test_pages_leave_the_helper_in_pieces():
    """A batch of any size is taken in pieces; all rows stay, in order."""
    batch = pa.RecordBatch.from_pydict({"page": list(range(1000))})
    pieces = list(in_pieces(iter([batch, batch.slice(0, 3)])))
    assert max(p.num_rows for p in pieces) <= PIECE < batch.num_rows
    assert [x for p in pieces for x in p.column("page").to_pylist()] == [*range(1000), 0, 1, 2]


def test_cleaned_lines_are_those_of_the_plain_patterns(spark):
    """Lines made of the parts that cleaning knows, against the patterns tried on every line from every place."""
    parts = ["a", "星", "头像", "头像-2", ".png", ".PNG", "-", " ", "  ", "\t", "图标-位置.png", "短信-警告.webp", "剧情选项-图标-", "。"]
    rng = random.Random(3)
    lines = ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(3000)]

    def plain(line):
        line = line.strip()
        for pattern in (r"[\w\-一-鿿]+头像(?:-\d+)?\.(?:png|jpg|jpeg|gif|webp)", r"图标-位置\.(?:png|jpg|jpeg|gif|webp)", r"短信-警告\.(?:png|jpg|jpeg|gif|webp)"):
            line = re.sub(pattern, "", line, flags=re.I)
        m = re.match(r"^剧情选项-图标-([^.\s]+)\.png\s*(.*)$", line)
        if m:
            line = f"[choice:{m[1].strip()}] {m[2].strip()}" if m[2].strip() else f"[choice:{m[1].strip()}]"
        return re.sub(r"[ \t]+", " ", line).strip()

    got = spark.createDataFrame([(x,) for x in lines], "x string").select(T.clean_line(F.col("x"))).collect()
    assert [r[0] for r in got] == [plain(x) for x in lines]


def test_long_lines_take_time_in_proportion(spark):
    """Two lines of 200,000 letters without a gap, one of them with the mark of an image: seconds, not minutes."""
    frame = spark.createDataFrame([("字" * 200_000,), ("头像" + "字" * 200_000,)], "x string")
    start = time.monotonic()
    assert [r[0] for r in frame.select(F.length(T.clean_line(F.col("x")))).collect()] == [200_000, 200_002]
    assert time.monotonic() - start < 30

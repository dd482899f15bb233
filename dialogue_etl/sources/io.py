"""Sources and sinks: encoded text files, URL lists, manifests, and the dialogue, report and index outputs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from dialogue_etl.functions import text as T
from dialogue_etl.operators import coverage as V
from dialogue_etl.operators import lines as L

DIALOGUE_FIELDS = ["source", "source_title", "line_no", "speaker", "text", "section_title", "version"]


@pandas_udf(StringType())
def _decode_legacy(contents: pd.Series) -> pd.Series:
    def one(raw):
        if raw is None:
            return None
        try:
            return bytes(raw).decode("gb18030")
        except UnicodeDecodeError:
            return bytes(raw).decode("utf-8", "replace")

    return contents.map(one)


def decoded(content: Column) -> Column:
    """UTF-8 without byte-order mark; bytes that aren't UTF-8 are gb18030, else UTF-8 with replacements.

    Only contents that fail as UTF-8 go through the helper.
    """
    utf8 = F.try_validate_utf8(content.cast("string"))
    return F.coalesce(F.regexp_replace(utf8, "^﻿", ""), _decode_legacy(F.when(utf8.isNull(), content)))


def read_text_encoded(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of every file under path."""
    return spark.read.format("binaryFile").load(path).select("path", decoded(F.col("content")).alias("text"))


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    return url_list(spark.read.text(path).select(F.col("value").alias("line")))


def url_list(lines: DataFrame) -> DataFrame:
    return lines.select(T.strip(F.col("line")).alias("url")).filter("url <> '' AND NOT startswith(url, '#')")


def manifest_pages(manifest: DataFrame, files: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """(pos, url, title, version, local_path) of a manifest's pages that have a local path, in its order.

    manifest has the array column pages. files (path) keeps only pages whose file exists.
    """
    rows = manifest.select(F.posexplode("pages").alias("pos", "p")).select("pos", "p.*").filter("local_path IS NOT NULL AND local_path <> ''")
    if files is not None:
        rows = rows.join(files.select(F.col("path").alias("local_path")), "local_path", "left_semi")
    stem = F.regexp_replace(F.element_at(F.split("local_path", "/"), -1), "\\.[^.]*$", "")
    rows = rows.select("pos", "url", F.coalesce(F.nullif("title", F.lit("")), stem).alias("title"), F.coalesce("version", F.lit("")).alias("version"), "local_path")
    return rows if limit is None else rows.orderBy("pos").limit(limit)


def collect_inputs(parts: list[tuple[DataFrame, str]], max_pages: int | None = None) -> DataFrame:
    """(pos, value, kind) of inputs (pos, value) of several kinds; the first occurrence of a value stays."""
    rows = None
    for k, (frame, kind) in enumerate(parts):
        part = frame.select(F.struct(F.lit(k).alias("part"), F.col("pos").cast("long").alias("pos")).alias("pos"), "value", F.lit(kind).alias("kind"))
        rows = part if rows is None else rows.unionByName(part)
    first = rows.groupBy("value").agg(F.min(F.struct("pos", "kind")).alias("r")).select("r.pos", "value", "r.kind")
    return first if max_pages is None else first.orderBy("pos").limit(max_pages)


def write_dialogue_jsonl(dialogue: DataFrame, path: str, append: bool = False) -> None:
    dialogue.select(*DIALOGUE_FIELDS).write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def read_dialogue_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("source string, source_title string, line_no int, speaker string, text string, section_title string, version string").json(path)


def dialogue_markdown(dialogue: DataFrame) -> DataFrame:
    """(source, line_no, out_no, out) lines of a Markdown listing: a title and the source at each new source, a section
    heading at each new (version, section), then the spoken line; blank lines after headings."""
    w = Window.partitionBy("source").orderBy("line_no")
    rows = dialogue.withColumn("first", F.row_number().over(w) == 1).withColumn("before", F.lag(F.struct("version", "section_title")).over(w))
    new = F.col("first") | ~F.col("before").eqNullSafe(F.struct("version", "section_title"))
    section = F.concat(F.lit("### "), F.coalesce("section_title", F.lit("Untitled section")), F.when(F.col("version").isNotNull(), F.concat(F.lit(" ("), "version", F.lit(")"))).otherwise(F.lit("")))
    spoken = F.concat(F.lit("- L"), "line_no", F.lit(" **"), "speaker", F.lit("**: "), "text")
    none = F.array().cast("array<string>")
    top = F.when(F.col("first"), F.array(F.concat(F.lit("## "), "source_title"), F.lit(""), F.concat(F.lit("- Source: "), "source"), F.lit(""))).otherwise(none)
    out = F.concat(top, F.when(new, F.array(section, F.lit(""))).otherwise(none), F.array(spoken))
    return rows.select("source", "line_no", F.posexplode(out).alias("out_no", "out"))


LISTING = "# Dialogue Extract\n\n> Generated listing. Branch choices may need manual review.\n\n"
PARSED = "# Parsed Story Sources\n\n> Generated. Review before using as evidence.\n\n"


def dialogue_documents(dialogue: DataFrame) -> DataFrame:
    """(source, text): the Markdown listing of each source, ready for documents.write_documents()."""
    rows = dialogue_markdown(dialogue)
    packed = F.array_sort(F.collect_list(F.struct("line_no", "out_no", "out")))
    return rows.groupBy("source").agg(F.concat(F.lit(LISTING), F.array_join(F.transform(packed, lambda x: x["out"]), "\n")).alias("text"))


def document_text(lines: DataFrame) -> DataFrame:
    """(source, text) of typed lines rendered back."""
    return L.joined_text(lines, ["source"], "line_no", L.rendered(lines))


def parsed_documents(lines: DataFrame, sources: DataFrame, parsed_at: str | None = None) -> DataFrame:
    """(source, text): each document's typed lines under a header with title, source, kind, time and section count.

    sources has (source, title, kind); parsed_at is the time to state, the current one by default.
    """
    sections = L.with_sections(lines).groupBy("source").agg(F.countDistinct("section_no").alias("sections"))
    at = F.lit(parsed_at) if parsed_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    rows = document_text(lines).join(sections, "source").join(sources, "source")
    top = F.format_string("## %s\n\n- Source: %s\n- Source type: %s\n- Parsed: %s\n- Sections: %d\n\n", "title", "source", "kind", at, "sections")
    return rows.select("source", F.concat(F.lit(PARSED), top, "text").alias("text"))


def coverage_report_json(report: DataFrame, counts: list[str]) -> DataFrame:
    """(page, report) of coverage.page_reports(): status, counts, mismatches, missing and extra items as JSON."""
    pairs = [x for c in counts for x in (F.lit(c), F.col(c))]
    return report.select("page", F.to_json(F.struct("page", "status", "error", F.create_map(*pairs).alias("counts"), "mismatches", "missing", "extra")).alias("report"))


# Fixed values of the report's format.
NOTES = ["", "## 说明", "", "- 该报告使用空白无关匹配，因此换行、缩进、Markdown 标记不会造成误报。", "- `source_plot_frames` 是 HTML 中所有选项组数量，包含嵌套分支。", "- 缺失项为强信号；额外项可能来自解析器添加的结构化说明，需要人工判断。"]
SUMMARY_HEAD = ["# 剧情 Markdown 批量覆盖率汇总", "", "## 总览", ""]
TABLE_HEAD = ["", "## 页面明细", "", "| # | 版本 | 状态 | 标题 | 缺失 | 额外 | 选项异常 | 覆盖率报告 |", "| ---: | --- | --- | --- | ---: | ---: | ---: | --- |"]
ODD_HEAD = ["", "## 异常页", ""]
NOTHING_ODD = "- 未发现异常页。"


def _bullets(items: Column, line, none: str) -> Column:
    return F.when(F.size(items) == 0, F.array(F.lit(none))).otherwise(F.transform(items, line))


def coverage_report_markdown(report: DataFrame, counts: list[str], html: str = "html", markdown: str = "markdown") -> DataFrame:
    """(page, text) of coverage.page_reports() with the columns html and markdown that name both files."""

    def code(x) -> Column:
        return F.concat(F.lit("`"), x, F.lit("`"))

    def text(*xs) -> list[Column]:
        return [F.lit(x) for x in xs]

    top = [*text("# 剧情 Markdown 覆盖率报告", ""), F.concat(F.lit("- HTML: "), code(html)), F.concat(F.lit("- Markdown: "), code(markdown)), F.concat(F.lit("- 状态: "), code("status")), *text("", "## 计数", "", "| 项目 | 数量 |", "| --- | ---: |")]
    rows = [F.format_string(f"| `{c}` | %s |", F.coalesce(F.col(c).cast("string"), F.lit("-"))) for c in counts]
    parts = [
        F.array(*top, *rows, *text("", "## 选项结构异常", "")),
        _bullets(F.col("mismatches"), lambda f: F.concat(F.lit("- "), code(f["path"]), F.lit(": options="), f["options"], F.lit(", contents="), f["contents"]), "- 未发现 `plotOptions` 与 `content` 数量不一致的选项组。"),
        F.array(*text("", "## HTML 中有但 Markdown 中疑似缺失", "")),
        _bullets(F.col("missing"), lambda m: F.concat(F.lit("- "), code(m["kind"]), F.lit(" "), code(F.coalesce(m["path"], F.lit(""))), F.lit(" expected="), m["expected"], F.lit(", observed="), m["observed"], F.lit(": "), m["text"]), "- 未发现缺失文本组。"),
        F.array(*text("", "## Markdown 中有但 HTML 源清单中未匹配", "")),
        _bullets(F.col("extra"), lambda m: F.concat(F.lit("- "), code(m["kind"]), F.lit(" observed="), m["observed"], F.lit(", source="), m["source_count"], F.lit(": "), m["text"]), "- 未发现额外文本组。"),
        F.array(*text(*NOTES)),
    ]
    return report.select("page", F.array_join(F.concat(*parts), "\n").alias("text"))


def coverage_summary(report: DataFrame, by: str, link: str = "coverage") -> DataFrame:
    """(part, place, line) of a batch's summary: title and number of pages, a line a status, the table, and a line for
    every page that doesn't pass. report has the columns title, version and link, the report's path from the summary.

    Lines stay rows, as the table grows with the pages; write_summary() writes them in order.
    """
    long = F.lit(0).cast("long")

    def fixed(part: int, lines: list[str]) -> DataFrame:
        return report.sparkSession.createDataFrame([(part, k, line) for k, line in enumerate(lines)], "part int, place long, line string")

    def shown(c) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("-"))

    place = F.col(by).cast("long")
    pages = report.agg(F.lit(1).alias("part"), long.alias("place"), F.concat(F.lit("- 页面数："), F.count("*")).alias("line"))
    totals = V.status_totals(report).select(F.lit(2).alias("part"), F.row_number().over(Window.orderBy("status")).cast("long").alias("place"), F.concat(F.lit("- `"), "status", F.lit("`："), "n").alias("line"))
    title = F.replace("title", F.lit("|"), F.lit("\\|"))
    cells = [F.col(by).cast("string"), F.coalesce("version", F.lit("")), F.concat(F.lit("`"), "status", F.lit("`")), title, shown("missing_groups"), shown("extra_groups"), shown("plot_mismatches"), F.concat(F.lit("["), link, F.lit("]("), link, F.lit(")"))]
    table = report.select(F.lit(4).alias("part"), place.alias("place"), F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
    detail = F.coalesce("error", F.format_string("missing=%d, extra=%d, plot_mismatches=%d", "missing_groups", "extra_groups", "plot_mismatches"))
    odd = report.filter("status <> 'pass'").select(F.lit(6).alias("part"), place.alias("place"), F.format_string("- `%s` %03d %s：%s", "status", place, "title", detail).alias("line"))
    none = report.agg(F.lit(6).alias("part"), long.alias("place"), F.when(F.coalesce(F.max(F.col("status") != "pass"), F.lit(False)), F.lit(None)).otherwise(F.lit(NOTHING_ODD)).alias("line")).filter("line IS NOT NULL")
    out = fixed(0, SUMMARY_HEAD)
    for part in (pages, totals, fixed(3, TABLE_HEAD), table, fixed(5, ODD_HEAD), odd, none):
        out = out.unionByName(part)
    return out


def write_summary(summary: DataFrame, path: str) -> None:
    """Writes the lines of coverage_summary() in order: sorted by ranges, so the part files one after the other are
    the Markdown file; a summary of one range is one file."""
    lines = summary.orderBy("part", "place").select(F.col("line").alias("value"))
    lines.write.mode("overwrite").option("lineSep", "\n").text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of text files that are one document in the order of their names."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), F.split(F.regexp_replace("value", "\\n$", ""), "\n").alias("lines"))
    # One short row a file.
    before = files.select("name", F.coalesce(F.sum(F.size("lines")).over(Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return files.join(before, "name").select("before", F.posexplode("lines").alias("pos", "line")).select((F.col("before") + F.col("pos") + 1).alias("line_no"), "line")

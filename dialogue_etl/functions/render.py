"""Markdown of story pages: each block of a page's outline is a row, its lines are expressions, and speaker pairs
and blank lines are mended by the line operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogue_etl.functions.pages import STORY_HEADING, read_pages
from dialogue_etl.operators import lines as L

# Lines of the Markdown format.
NO_REPLY, NO_CONTENT, REPLY = "  - 回复：无额外文本", "  - 回复：未在 HTML 中找到对应 content 块", "  - 回复："
GENERATED = "> Generated from story HTML. Review branch choices before using as evidence."


def block_lines(b: Column) -> Column:
    """The lines of one block, blank ones included, without the indentation of its depth."""
    text, number, note, gap = b["text"], b["number"].cast("string"), b["note"], F.lit("")
    return (
        F.when(b["kind"] == "said", F.array(F.concat(F.lit("- **"), note, F.lit("**："), text)))
        .when(b["kind"] == "text", F.array(text, gap))
        .when(b["kind"] == "bullet", F.array(F.concat(F.lit("- "), text)))
        .when(b["kind"] == "heading", F.array(gap, F.concat(F.repeat(F.lit("#"), b["number"]), F.lit(" "), text), gap))
        .when(b["kind"] == "group", F.array(gap, F.concat(F.lit("> 选项组 "), number, F.lit("："), text, F.lit(" 个选项")), gap))
        .when(b["kind"] == "option", F.array(F.concat(F.lit("- 选项 "), number, F.lit("（"), note, F.lit("）："), text)))
        .when(b["kind"] == "reply", F.array(F.lit(REPLY)))
        .when(b["kind"] == "no_reply", F.array(F.lit(NO_REPLY)))
        .when(b["kind"] == "no_content", F.array(F.lit(NO_CONTENT)))
        .otherwise(F.array(gap))
    )


def outline_lines(blocks: Column) -> Column:
    """All lines of an outline; inside a branch lines are indented by its depth and blank ones go."""

    def lines(b: Column) -> Column:
        inside = F.transform(F.filter(block_lines(b), lambda x: x != ""), lambda x: F.concat(F.repeat(F.lit("    "), b["depth"]), x))
        return F.when(b["depth"] > 0, inside).otherwise(block_lines(b))

    return F.flatten(F.transform(blocks, lines))


def header(title: Column, source: Column, version: Column, *parts: str) -> Column:
    """The lines before a page's story; parts are the headings under the title."""
    stem = F.regexp_replace(F.element_at(F.split(source, "/"), -1), "\\.[^.]*$", "")
    named = F.coalesce(F.nullif(title, F.lit("")), stem, F.lit(""))
    top = [F.concat(F.lit("# "), named), F.lit(""), F.lit(GENERATED), F.lit(""), F.concat(F.lit("- Source: "), F.coalesce(source, F.lit(""))), F.concat(F.lit("- Version: "), F.coalesce(F.nullif(version, F.lit("")), F.lit("(unknown)"))), F.lit("")]
    return F.array(*top, *[F.lit(x) for p in parts for x in (p, "")])


def mended(pages: DataFrame) -> DataFrame:
    """(source, line_no, line, page) of rows (row, page, lines), row as source: speaker pairs joined, blank lines tidied;
    one shuffle by row."""
    rows = pages.select(F.col("row").alias("source"), "page", F.posexplode("lines").alias("pos", "line")).select("source", (F.col("pos") + 1).alias("line_no"), "line", "page")
    return L.tidy_lines(L.repair_markdown_pairs(rows))


def _packed(rows: DataFrame, row: str, order: str) -> DataFrame:
    """(row, page, lines): each row's lines in order."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct(order, "line"))), lambda x: x["line"])
    return rows.groupBy(F.col(row).alias("row")).agg(F.first("page").alias("page"), lines.alias("lines"))


def _of_pages(rows: DataFrame, parts: tuple[str, ...], suffix: str) -> DataFrame:
    """rendered() of rows (page, title, source, version, blocks, error), each a page of its own whatever its id.

    The lines of a row carry its id, counts and error through the one shuffle, so nothing is joined back by the id, and
    rows with and without an error come from one reading: a union of both would read every page twice.
    """
    spoken = F.size(F.filter("blocks", lambda b: (b["kind"] == "said") & (b["depth"] <= 1)))
    groups = F.size(F.filter("blocks", lambda b: (b["kind"] == "group") & (b["depth"] == 0)))
    raw = F.concat(header(F.concat("title", F.lit(suffix)), F.col("source"), F.col("version"), *parts), outline_lines(F.col("blocks")))
    # One line stands for a page with an error.
    shown = F.when(F.col("error").isNull(), raw).otherwise(F.array(F.lit("#")))
    own = F.struct("page", spoken.alias("dialogue_count"), groups.alias("choice_group_count"), "error")
    whole = _packed(mended(rows.select(F.monotonically_increasing_id().alias("row"), own.alias("page"), shown.alias("lines"))), "source", "line_no")
    return whole.select("page.page", F.when(F.col("page.error").isNull(), F.col("lines")).alias("lines"), "page.dialogue_count", "page.choice_group_count", "page.error")


def rendered(read: DataFrame, meta: DataFrame, parts: tuple[str, ...] = (f"## {STORY_HEADING}",), suffix: str = "") -> DataFrame:
    """(page, lines, dialogue_count, choice_group_count, error) of pages that read_pages() has read.

    meta has (page, title, source, version), one row a page. A page with an error has no lines. Lines inside a branch
    of a branch don't count as dialogue, and only groups outside any branch count, as readers of the counts expect.
    """
    return _of_pages(read.join(meta, "page"), parts, suffix)


def _read_with_meta(pages: DataFrame, meta: dict[str, Column], html_col: str, heading: str) -> DataFrame:
    """The outlines of read_pages() with the columns of meta, which travel with each page through the reading."""
    named = pages.select(F.struct(*[c.alias(name) for name, c in meta.items()]).alias("page"), F.col(html_col).alias("html"))
    return read_pages(named, "page", "html", heading, items=False)


def story_markdown(pages: DataFrame, id_col: str, html_col: str, title: str, source: str, version: str, heading: str = STORY_HEADING) -> DataFrame:
    """rendered() of raw pages, one row for every row of pages, those that repeat an id or have none too."""
    meta = {"page": F.col(id_col), "title": F.col(title), "source": F.col(source), "version": F.col(version)}
    read = _read_with_meta(pages, meta, html_col, heading)
    return _of_pages(read.select("page.page", "page.title", "page.source", "page.version", "blocks", "error"), (f"## {heading}",), "")


def profile_markdown(pages: DataFrame, id_col: str, html_col: str, title: str, source: str, version: str, heading: str = "大世界对话", part: str = "角色对话") -> DataFrame:
    """(page, lines, dialogue_count, choice_group_count, error) of one section of profile pages, a row for every row.

    Groups are numbered through the page, those inside branches too, and both counts are taken from the lines; the
    last line states them. A page without the heading has an error and no lines.
    """
    meta = {"page": F.col(id_col), "title": F.coalesce(F.nullif(F.col(title), F.lit("")), F.lit("角色资料")), "source": F.col(source), "version": F.col(version)}
    read = _read_with_meta(pages, meta, html_col, heading)
    own = F.struct("page.page", "page.title", "page.version").alias("page")
    done = _of_pages(read.select(own, "page.title", "page.source", "page.version", "blocks", "error"), (f"## {part}", f"### {heading}"), f" - {heading}")
    # An entry may hold line ends of its own.
    # The row's number is made before the lines are rows.
    keyed = done.select(F.monotonically_increasing_id().alias("row"), F.struct("page", "error").alias("page"), "lines")
    rows = keyed.select("row", "page", F.posexplode(F.split(F.coalesce(F.array_join("lines", "\n"), F.lit("#")), "\n")).alias("pos", "line"))
    group = "^(\\s*)> 选项组 \\d+："
    number = F.count_if(F.col("line").rlike(group)).over(Window.partitionBy("row").orderBy("pos"))
    renumbered = F.when(F.col("line").rlike(group), F.concat(F.regexp_extract("line", group, 1), F.lit("> 选项组 "), number, F.lit("："), F.regexp_replace("line", group, ""))).otherwise(F.col("line"))
    rows = rows.withColumn("line", renumbered)
    counts = {"dialogue_count": F.size(F.filter("lines", lambda x: x.rlike("^\\s*- \\*\\*[^*]+\\*\\*："))), "choice_group_count": F.size(F.filter("lines", lambda x: x.rlike(group)))}
    whole = _packed(rows, "row", "pos").select("page.page.*", "page.error", "lines").withColumns(counts)
    stats = F.format_string("<!-- parser_stats: title=%s; version=%s; dialogue_count=%d; choice_group_count=%d -->", "title", F.coalesce(F.nullif("version", F.lit("")), F.lit("(unknown)")), "dialogue_count", "choice_group_count")
    return whole.select("page", F.when(F.col("error").isNull(), F.concat("lines", F.array(F.lit(""), stats))).alias("lines"), *counts, "error")

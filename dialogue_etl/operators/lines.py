"""Ordered-line operators: windows partitioned by document and ordered by line number.

A lines table has the columns source, line_no, line; the operators on Markdown keep any other column that a line has. All
windows below share one partitioning and order, so Spark sorts a document's lines once. Operators that look at neighbours take `segment`: the line numbers that one task
sees of a document at a time (scan.py), None for whole documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogue_etl.functions import text as T
from dialogue_etl.operators.scan import with_neighbours


def numbered_lines(docs: DataFrame, source: str = "source", text: str = "text", unescape: bool = True) -> DataFrame:
    """One row a line, numbered from 1 in the raw text."""
    raw = F.when(F.col(text).contains("\r"), F.regexp_replace(F.col(text), "\\r\\n?", "\n")).otherwise(F.col(text))
    raw = T.plain_spaces(T.html_unescape(raw) if unescape else raw)
    return docs.select(F.col(source).alias("source"), F.posexplode(F.split(raw, "\n"))).select("source", (F.col("pos") + 1).alias("line_no"), F.col("col").alias("line"))


def kept_lines(lines: DataFrame) -> DataFrame:
    """Cleaned lines without blank, interface and image lines."""
    return lines.withColumn("line", T.clean_line(F.col("line"))).filter(~T.is_dropped(F.col("line")))


def drop_consecutive_duplicates(lines: DataFrame, segment: int | None = None) -> DataFrame:
    return with_neighbours(lines, {"before": ("before", F.col("line"))}, segment).filter("NOT line <=> before").drop("before")


def own_speakers(lines: DataFrame) -> DataFrame:
    """(source, name) of every speaker that a document names itself: its cast and who speaks in it."""
    cast = F.when(F.col("line").startswith("出场人物"), T.parse_cast(F.col("line"))).otherwise(F.array(T.speaker_name(F.col("line"))))
    return lines.select("source", F.explode(cast).alias("name")).filter("name IS NOT NULL").distinct()


def speaker_hints(lines: DataFrame, extra: list[str] | None = None, known: list[str] | None = None) -> DataFrame:
    """(source, name) of every name that counts as a speaker in a document: its own, those known everywhere and extra ones."""
    named = [x.strip() for x in extra or [] if x.strip()] + list(T.DEFAULT_SPEAKERS if known is None else known)
    rows = own_speakers(lines)
    if named:
        rows = rows.unionByName(lines.select("source").distinct().select("source", F.explode(F.array(*map(F.lit, named))).alias("name"))).distinct()
    return rows


def with_hint_flag(lines: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Adds hinted: whether the line is in speaker_hints(); names known everywhere are compared without a join."""
    names = own_speakers(lines).select("source", F.col("name").alias("line"), F.lit(True).alias("own"))
    known = F.col("line").isin([*T.DEFAULT_SPEAKERS, *(x.strip() for x in extra or [])])
    return lines.join(names, ["source", "line"], "left").select("source", "line_no", "line", (F.coalesce("own", F.lit(False)) | known).alias("hinted"))


def repair_speaker_pairs(lines: DataFrame, segment: int | None = None) -> DataFrame:
    """A lone speaker line and the payload after it become one line at the first one's number, marked as merged.

    A payload is never a lone speaker, so pairs don't overlap and neighbours decide.
    """
    alone = T.is_standalone_speaker(F.col("line"), F.col("hinted"))
    payload = T.is_dialogue_payload(F.col("line"), F.col("hinted"))
    flagged = lines.withColumns({"alone": alone, "payload": payload})
    flagged = with_neighbours(flagged, {"next_line": ("after", F.col("line")), "next_payload": ("after", F.col("payload")), "before_alone": ("before", F.col("alone"))}, segment)
    merged = F.col("alone") & F.coalesce("next_payload", F.lit(False))
    line = F.when(merged, F.concat("line", F.lit("："), "next_line")).otherwise(F.col("line"))
    return flagged.filter(~(F.col("payload") & F.coalesce("before_alone", F.lit(False)))).select("source", "line_no", line.alias("line"), merged.alias("merged"))


def classified(lines: DataFrame) -> DataFrame:
    """source, line_no, kind, text, speaker, choice_kind."""
    line, said = F.col("line"), F.col("said")
    rows = lines.select("source", "line_no", "line", T.spoken(line).alias("said"))
    return rows.select("source", "line_no", T.line_kind(line, said).alias("kind"), T.line_text(line, said).alias("text"), F.when(T.choice_kind(line).isNull(), said["name"]).alias("speaker"), T.choice_kind(line).alias("choice_kind"))


def normalized(docs: DataFrame, source: str = "source", text: str = "text", extra: list[str] | None = None, unescape: bool = True, segment: int | None = None) -> DataFrame:
    """Typed lines of whole documents: number, clean, drop, repair, classify."""
    return normalized_lines(numbered_lines(docs, source, text, unescape), extra, segment)


def normalized_lines(lines: DataFrame, extra: list[str] | None = None, segment: int | None = None) -> DataFrame:
    """Typed lines of a table of raw lines: clean, drop, repair, classify."""
    lines = drop_consecutive_duplicates(kept_lines(lines), segment)
    return classified(repair_speaker_pairs(with_hint_flag(lines, extra), segment))


def with_sections(lines: DataFrame, segment: int | None = None) -> DataFrame:
    """Adds section_no and marker version; a 所属版本 line starts a section, lines before the first form one too."""
    version = F.nullif(F.regexp_extract("text", "(?d)^所属版本(?U:\\s+)(.+)$", 1), F.lit(""))
    lines = lines.withColumn("marker", T.strip(version))
    marked = F.col("marker").isNotNull()
    lines = with_neighbours(lines, {"number": ("sum", marked.cast("int")), "prelude": ("first", ~marked)}, segment)
    return lines.withColumn("section_no", (F.col("number") + F.col("prelude").cast("int")).cast("int")).drop("number", "prelude")


def section_title(version: Column, friendly: Column, number: Column) -> Column:
    return F.when(version.isNull(), F.concat(F.lit("Prelude section "), number)).otherwise(F.coalesce(friendly, F.concat(F.lit("Version "), version, F.lit(" section "), number)))


def with_section_names(lines: DataFrame, segment: int | None = None) -> DataFrame:
    """Adds section_title and version of each line's section, over the lines' own partitioning: no join by section.

    The heading that names a section may stand before or after a line of it, so each line looks both ways for the
    nearest first heading of a section, and takes it if the section is its own.
    """
    heading = (F.col("kind") == "heading") & ~F.col("text").startswith(T.EXTRA_HEADING)
    rows = with_neighbours(with_sections(lines, segment), {"version": ("last_here", F.col("marker")), "named": ("last_before", F.when(heading, F.col("section_no")))}, segment)
    leads = heading & ~F.col("named").eqNullSafe(F.col("section_no"))
    name = F.when(leads, F.struct("section_no", "text"))
    rows = with_neighbours(rows, {"behind": ("last_here", name), "ahead": ("first_after", name)}, segment)
    own = F.col("section_no")
    friendly = F.when(F.col("behind.section_no") == own, F.col("behind.text")).when(F.col("ahead.section_no") == own, F.col("ahead.text"))
    return rows.withColumn("section_title", section_title(F.col("version"), friendly, own)).drop("marker", "named", "behind", "ahead")


def build_sections(lines: DataFrame, segment: int | None = None) -> DataFrame:
    """One row a section: source, section_no, title, start_line, version, description, cast."""
    rows = with_sections(lines, segment)
    title = F.col("kind") == "heading"
    friendly = F.min_by(F.when(title & ~F.col("text").startswith(T.EXTRA_HEADING), F.col("text")), F.when(title & ~F.col("text").startswith(T.EXTRA_HEADING), F.col("line_no")))
    described = F.col("marker").isNull() & F.col("text").startswith("任务描述")
    cast = F.col("marker").isNull() & ~described & F.col("text").startswith("出场人物")
    out = rows.groupBy("source", "section_no").agg(
        F.min("line_no").alias("start_line"),
        F.max("marker").alias("version"),
        friendly.alias("friendly"),
        F.max_by(F.when(described, T.strip(F.substring("text", 5, 1 << 30))), F.when(described, F.col("line_no"))).alias("description"),
        F.max_by(F.when(cast, T.parse_cast(F.col("text"))), F.when(cast, F.col("line_no"))).alias("cast"),
    )
    name = section_title(F.col("version"), F.col("friendly"), F.col("section_no"))
    return out.select("source", "section_no", name.alias("title"), "start_line", "version", "description", F.coalesce("cast", F.array().cast("array<string>")).alias("cast"))


def as_of(rows: DataFrame, points: DataFrame, by: list[str], at: str, value: str) -> DataFrame:
    """As-of join: the value of the latest point at or before each row, null before the first.

    One union and one window instead of a range join; points sort before rows of the same position.
    """
    payload = [c for c in rows.columns if c not in (*by, at)]
    left = rows.select(*by, at, F.lit(1).alias("side"), F.struct(*payload).alias("row"), F.lit(None).cast(points.schema[value].dataType).alias(value))
    right = points.select(*by, at, F.lit(0).alias("side"), F.lit(None).cast(left.schema["row"].dataType).alias("row"), value)
    w = Window.partitionBy(*by).orderBy(at, "side").rowsBetween(Window.unboundedPreceding, 0)
    filled = left.unionByName(right).withColumn(value, F.last(value, ignorenulls=True).over(w))
    return filled.filter("side = 1").select(*by, at, *[F.col(f"row.{c}").alias(c) for c in payload], value)


def repair_markdown_pairs(lines: DataFrame, names: list[str] | None = None, segment: int | None = None) -> DataFrame:
    """On rendered Markdown: a line that is a known speaker's name and the next non-blank line become one
    dialogue line; the blanks between vanish only then."""
    known = F.col("line").isin(names or T.DEFAULT_SPEAKERS)
    payload = (T.strip(F.col("line")) != "") & ~T.any_prefix(T.strip(F.col("line")), ["#", "-", ">", "<!--"]) & ~T.strip(F.col("line")).isin(names or T.DEFAULT_SPEAKERS)
    full = F.when(F.col("line") != "", F.struct("line", "known", "payload"))
    rows = with_neighbours(lines.withColumns({"known": known, "payload": payload}), {"after": ("first_after", full), "before": ("last_before", full)}, segment)
    starts = F.col("known") & F.coalesce("after.payload", F.lit(False))
    swallowed = F.col("before.known") & F.when(F.col("line") == "", F.coalesce("after.payload", F.lit(False))).otherwise(F.col("payload"))
    merged = F.when(starts, F.concat(F.lit("- **"), T.strip(F.col("line")), F.lit("**："), T.strip(F.col("after.line")))).otherwise(F.col("line"))
    return rows.filter(~F.coalesce(swallowed, F.lit(False))).select(*(merged.alias(c) if c == "line" else c for c in lines.columns))


def renumber(rows: DataFrame, by: list[str], order: list[str], name: str = "group_no") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def tidy_lines(lines: DataFrame, segment: int | None = None) -> DataFrame:
    """Runs of blank lines become one, ends are trimmed, blank lines at both ends of a document go."""
    line = F.regexp_replace("line", "(?U)\\s+$", "")
    told = F.when(line != "", F.col("line_no"))
    rows = with_neighbours(lines.withColumn("tidy", line), {"before": ("before", F.col("line") == ""), "a": ("least", told), "z": ("greatest", told)}, segment)
    return rows.filter("NOT (line = '' AND coalesce(before, false)) AND line_no BETWEEN a AND z").select(*(F.col("tidy").alias(c) if c == "line" else c for c in lines.columns))


def joined_text(rows: DataFrame, by: list[str], order: str, line: Column | str, name: str = "text") -> DataFrame:
    """Lines of each group back as one text, in order."""
    line = F.col(line) if isinstance(line, str) else line
    packed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l"))))
    return rows.groupBy(*by).agg(F.array_join(F.transform(packed, lambda x: x["l"]), "\n").alias(name))


def rendered(lines: DataFrame) -> Column:
    """A typed line as text again."""
    choice = F.rtrim(F.concat(F.lit("[choice:"), "choice_kind", F.lit("] "), "text"))
    return F.when((F.col("kind") == "dialogue") & F.col("speaker").isNotNull(), F.concat("speaker", F.lit("："), "text")).when(F.col("kind") == "choice", choice).otherwise(F.col("text"))

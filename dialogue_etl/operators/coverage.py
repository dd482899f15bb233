"""Coverage verification: what of a source's texts is missing in a target, and what the target has too much."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from dialogue_etl.functions import pages as P
from dialogue_etl.functions import text as T

MAX_ITEMS = 80


def counts_in(keys: list[str], text: str) -> list[int]:
    """Occurrences of each key in text, those of one key without overlap: one scan, whatever the number of keys."""
    number = {key: n for n, key in enumerate(dict.fromkeys(k for k in keys if k))}
    if not number or not text:
        return [0] * len(keys)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
    for key, n in number.items():
        automaton.add_word(key, (n, len(key)))
    automaton.make_automaton()
    found, free = [0] * len(number), [0] * len(number)
    for end, (n, size) in automaton.iter(text):
        if end - size >= free[n] - 1:
            found[n] += 1
            free[n] = end + 1
    return [found[number[k]] if k else 0 for k in keys]


def _occurrences(packed: DataFrame) -> DataFrame:
    """(page, keys, n) of packed (page, keys, target): how often each key stands in the text, a few pages at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in P.in_pieces(batches):
            found = [counts_in(k, t) for k, t in zip(batch.column("sought").to_pylist(), batch.column("target").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("page"), batch.column("keys"), pa.array(found, pa.list_(pa.int32()))], names=["page", "keys", "n"])

    rows = packed.select("page", "keys", F.transform("keys", lambda k: k["key"]).alias("sought"), F.coalesce("target", F.lit("")).alias("target"))
    return rows.mapInArrow(run, StructType([rows.schema["page"], rows.schema["keys"], StructField("n", ArrayType(IntegerType()))]))


def _unsettled(grouped: DataFrame, whole: DataFrame | None, wanted: str) -> DataFrame:
    """Groups (page, key, ...) of which `whole` (page, key), whose keys in a row are the text, has fewer than `wanted`.
    Lines of the text that equal a key are occurrences of it, so the others need no look at the text."""
    if whole is None:
        return grouped
    lines = whole.filter("key <> ''").groupBy("page", "key").agg(F.count("*").alias("__lines"))
    return grouped.join(lines, ["page", "key"], "left").filter(F.coalesce("__lines", F.lit(0)) < F.col(wanted)).drop("__lines")


def _counted(groups: DataFrame, texts: DataFrame, fields: list[str], name: str) -> DataFrame:
    """groups (page, key, fields) with the column `name`, the key's occurrences in the page's text (page, target).

    A page's keys are packed into one array before they meet its text, so each text exists once and is read once.
    """
    packed = groups.groupBy("page").agg(F.collect_list(F.struct("key", *fields)).alias("keys")).join(texts, "page", "left")
    rows = _occurrences(packed).select("page", F.explode(F.arrays_zip("keys", "n")).alias("k"))
    return rows.select("page", *[F.col(f"k.keys.{c}").alias(c) for c in ["key", *fields]], F.col("k.n").alias(name))


def group_items(items: DataFrame) -> DataFrame:
    """(page, key, expected, first_pos, occurrences[]) of items (page, pos, kind, text, key) with a key."""
    path = F.col("path") if "path" in items.columns else F.lit(None).cast("string")
    packed = F.array_sort(F.collect_list(F.struct("pos", "kind", "text", path.alias("path"))))
    return items.filter("key <> ''").groupBy("page", "key").agg(F.count("*").cast("int").alias("expected"), F.min("pos").alias("first_pos"), packed.alias("items"))


def missing_items(items: DataFrame, targets: DataFrame, max_items: int | None = MAX_ITEMS, whole: DataFrame | None = None) -> DataFrame:
    """(page, place, kind, text, path, pos, expected, observed) of every occurrence short in the target text.

    targets has (page, target), the target without white space; whole, if given, (page, key) of the lines that it
    consists of. The cap counts in order of first appearance of keys; None lifts it.
    """
    groups = _unsettled(group_items(items), whole, "expected")
    rows = _counted(groups, targets, ["first_pos", "expected", "items"], "observed").filter("observed < expected")
    rows = rows.select("page", "first_pos", "expected", "observed", F.posexplode(F.slice("items", F.col("observed") + 1, F.col("expected") - F.col("observed"))).alias("nth", "item"))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("page").orderBy("first_pos", "nth")))
    if max_items is not None:
        rows = rows.filter(F.col("place") <= max_items)
    return rows.select("page", "place", *[F.col(f"item.{c}").alias(c) for c in ("kind", "text", "path", "pos")], "expected", "observed")


def extra_items(items: DataFrame, sources: DataFrame, max_items: int | None = MAX_ITEMS, whole: DataFrame | None = None) -> DataFrame:
    """(page, place, kind, text, observed, source_count) where the target has an item more often than the source text.

    items are the target's (page, pos, kind, text, key); sources has (page, target): the source's joined text; whole,
    if given, (page, key) of the lines that it consists of.
    """
    groups = items.filter("key <> ''").groupBy("page", "kind", "key", "text").agg(F.count("*").cast("int").alias("observed"), F.min("pos").alias("first_pos"))
    rows = _counted(_unsettled(groups, whole, "observed"), sources, ["first_pos", "kind", "text", "observed"], "source_count").filter("source_count < observed")
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("page").orderBy("first_pos", "kind", "text")))
    if max_items is not None:
        rows = rows.filter(F.col("place") <= max_items)
    return rows.select("page", "place", "kind", "text", "observed", "source_count")


def status(missing: Column, mismatches: Column, extra: Column) -> Column:
    return F.when(missing > 0, "fail").when((mismatches > 0) | (extra > 0), "warn").otherwise("pass")


def status_totals(report: DataFrame) -> DataFrame:
    """(status, n): pages of each status."""
    return report.groupBy("status").agg(F.count("*").alias("n"))


def batch_failed(report: DataFrame) -> bool:
    """Whether a page of the batch failed or couldn't be read."""
    return not report.filter(F.col("status").isin("fail", "error")).isEmpty()


def multiset_diff(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of each side minus the other's, with multiplicity."""
    return left.exceptAll(right), right.exceptAll(left)


def frame_locator(frames: DataFrame) -> DataFrame:
    """frames (page, index, options, contents) with the number of the visible choice group: frames without options have none."""
    seen = F.sum((F.col("options") > 0).cast("int")).over(Window.partitionBy("page").orderBy("index"))
    return frames.withColumn("group_no", F.when(F.col("options") > 0, seen).cast("int"))


COUNTS = ["source_items", "source_dialogue_items", "source_message_dialogue", "source_plot_frames", "source_plot_options", "source_plot_contents", "markdown_dialogue_lines", "markdown_choice_groups", "markdown_option_lines", "missing_groups", "extra_groups", "plot_mismatches"]
LISTS = ["mismatches", "missing", "extra"]


def joined_keys(rows: DataFrame) -> DataFrame:
    """(page, target): the keys of rows (page, pos, key) in order as one text."""
    packed = F.array_sort(F.collect_list(F.struct("pos", "key")))
    return rows.groupBy("page").agg(F.array_join(F.transform(packed, lambda x: x["key"]), "").alias("target"))


def page_reports(read: DataFrame, markdown: DataFrame, max_items: int | None = MAX_ITEMS) -> DataFrame:
    """(page, status, error, the twelve counts, and the lists mismatches, missing and extra) of every page.

    read is what read_pages() gives, markdown what rendered() gives of it. A page that couldn't be read is a row of
    status error without counts; the other pages go on.
    """
    items = P.source_items(read).withColumn("key", T.match_key(F.col("text"), unescape=False))
    text = F.array_join("lines", "\n")
    plain = markdown.select("page", T.markdown_plain_text(text).alias("plain"))
    target = plain.select("page", T.match_key(F.col("plain"), unescape=False).alias("target"))
    plain_lines = plain.select("page", F.explode(F.split("plain", "\n")).alias("line")).select("page", T.match_key(F.col("line"), unescape=False).alias("key"))
    found = F.struct("place", "kind", "text", "path", "expected", "observed")
    missing = missing_items(items, target, max_items, plain_lines).groupBy("page").agg(F.count("*").alias("missing_groups"), F.array_sort(F.collect_list(found)).alias("missing"))
    lines = markdown.select("page", F.posexplode(F.split(text, "\n")).alias("pos", "line")).withColumn("line", T.strip(F.col("line"))).filter(~T.is_skipped_markdown(F.col("line")))
    targets = lines.select("page", "pos", T.markdown_item(F.col("line")).alias("i")).select("page", "pos", "i.kind", "i.text").withColumn("key", T.match_key(F.col("text"), unescape=False))
    surplus = F.struct("place", "kind", "text", "observed", "source_count")
    extra = extra_items(targets, joined_keys(items), max_items, items).groupBy("page").agg(F.count("*").alias("extra_groups"), F.array_sort(F.collect_list(surplus)).alias("extra"))
    patterns = {"markdown_dialogue_lines": "(?m)^-\\s+\\*\\*[^*]+\\*\\*[：:]", "markdown_choice_groups": "(?m)^\\s*>\\s+选项组\\s+\\d+", "markdown_option_lines": "(?m)^\\s*-\\s+选项\\s+\\d+（"}
    counted = markdown.select("page", *[F.regexp_count(text, F.lit(p)).alias(name) for name, p in patterns.items()])

    def total(column: str) -> Column:
        return F.aggregate("frames", F.lit(0), lambda s, f: s + f[column])

    def kinds(*names: str) -> Column:
        return F.size(F.filter("items", lambda i: i["kind"].isin(*names)))

    odd = F.filter("frames", lambda f: f["options"] != f["contents"])
    source = read.select(
        "page", "error", F.size("items").alias("source_items"), kinds("dialogue", "message_dialogue").alias("source_dialogue_items"), F.size("messages").alias("source_message_dialogue"),
        F.size("frames").alias("source_plot_frames"), total("options").alias("source_plot_options"), total("contents").alias("source_plot_contents"),
        F.size(odd).alias("plot_mismatches"), (odd if max_items is None else F.slice(odd, 1, max_items)).alias("mismatches"),
    )
    rows = source.join(counted, "page", "left").join(missing, "page", "left").join(extra, "page", "left").fillna(0, ["missing_groups", "extra_groups"])
    state = F.when(F.col("error").isNotNull(), "error").otherwise(status(F.col("missing_groups"), F.col("plot_mismatches"), F.col("extra_groups")))
    counts = [F.when(F.col("error").isNull(), F.col(c)).cast("long").alias(c) for c in COUNTS]
    lists = [F.coalesce(c, F.array().cast(rows.schema[c].dataType)).alias(c) for c in LISTS]
    return rows.select("page", state.alias("status"), "error", *counts, *lists)

"""Page manifest and task graph: keyed merges, link closure, integrity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialogue_etl.functions import text as T
from dialogue_etl.operators.scan import with_neighbours

#: Pages of a queue that one task counts at a time.
COUNTED = 1_000_000


def latest_wins(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert or update by key: fields of new that aren't null overwrite, keys only in old stay."""
    fields = [c for c in old.columns if c not in keys]
    a = old.select(*keys, F.struct(*fields).alias("o"))
    b = new.select(*keys, F.struct(*fields).alias("n"))
    return a.join(b, keys, "full").select(*keys, *[F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in fields])


def create_table(rows: DataFrame, table: str, keys: list[str], buckets: int) -> None:
    """Writes rows as a table bucketed and sorted by its keys, for upsert_table()."""
    rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def upsert_table(new: DataFrame, table: str, keys: list[str], buckets: int) -> None:
    """latest_wins() of a table of create_table() and new rows, written as the table's next state.

    The table's side of the join lies in its buckets already, so only the new rows are shuffled. The next state stands
    whole under a name of its own before it takes the table's place; what a crash leaves in between is ended by the
    next call.
    """
    spark = new.sparkSession
    finish(spark, table)
    create_table(latest_wins(spark.table(table), new, keys), f"{table}__next", keys, buckets)
    spark.sql(f"ALTER TABLE {table}__next RENAME TO {table}__whole")
    finish(spark, table)


def finish(spark: SparkSession, table: str) -> None:
    """Puts a next state that is whole in the table's place."""
    if spark.catalog.tableExists(f"{table}__whole"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"ALTER TABLE {table}__whole RENAME TO {table}")


def upsert_in_order(old: DataFrame, new: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """latest_wins() of rows with a position: keys that are there keep their place, new ones follow in their own order."""
    last = old.agg(F.max(pos)).first()[0]
    placed = new.withColumn(pos, F.col(pos) + F.lit(0 if last is None else last + 1))
    merged = latest_wins(old.drop(pos), new.drop(pos), keys)
    place = old.select(*keys, F.col(pos).alias("__old")).join(placed.select(*keys, F.col(pos).alias("__new")), keys, "full")
    return merged.join(place.select(*keys, F.coalesce("__old", "__new").alias(pos)), keys)


def next_page_index(manifest: DataFrame) -> int:
    """One more than the largest number before the first '_' of a local file's name; 1 without any."""
    number = F.regexp_extract(F.element_at(F.split("local_path", "/"), -1), "^(\\d+)_", 1).try_cast("long")
    return (manifest.agg(F.max(number)).first()[0] or 0) + 1


def first_by_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row a key: the one with the smallest order; partial sums before the shuffle."""
    fields = [c for c in rows.columns if c not in keys and c != order]
    picked = rows.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in fields]) if fields else F.lit(None), order).alias("r"), F.min(order).alias(order))
    return picked.select(*keys, *[F.col(f"r.{c}").alias(c) for c in fields], order)


def recover_unlisted(local: DataFrame, manifest: DataFrame, page_prefix: str, field: str, low: Column, high: Column) -> DataFrame:
    """Manifest rows of local pages (local_path, html) that no manifest row points at, read from the pages
    themselves; pages without a source URL are skipped."""
    page = F.col("html")
    rows = local.join(manifest.select("local_path"), "local_path", "left_anti")
    rows = rows.select("local_path", T.normalize_url(T.page_source_url(page, page_prefix)).alias("url"), T.page_title(page).alias("title"), T.infobox_field(page, field).alias("version"))
    return rows.filter("url IS NOT NULL").select("url", "title", "version", "local_path", F.lit("recovered").alias("status"), T.classify_version(F.col("version"), low, high).alias("version_status"))


def fetch_plan(candidates: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """Per candidate url: cached, fetched or skipped_by_version; and whether to store it."""
    known = manifest.select("url", "local_path").filter("local_path IS NOT NULL")
    skipped = F.col("version_status").startswith("skipped")
    cached = F.col("local_path").isNotNull() & F.lit(not force)
    action = F.when(skipped, "skipped_by_version").when(cached, "cached").otherwise("fetched")
    return candidates.join(known, "url", "left").select("url", "version_status", action.alias("action"), (~skipped).alias("store"))


def dense_numbers(rows: DataFrame, order: Column | str, save, start: int = 1, name: str = "number") -> DataFrame:
    """Consecutive numbers over a global order without one task that sees all rows.

    Rows are dealt by ranges of the order; each range is counted, and a range's first number is the sum of the
    counts before it (one short row a range). `save(df)` fixes which rows are in which range, as both the counts
    and the rows are read from it.
    """
    key = F.col(order) if isinstance(order, str) else order
    dealt = save(rows.repartitionByRange(key).withColumn("__part", F.spark_partition_id()))
    dealt = dealt.withColumn("__at", F.row_number().over(Window.partitionBy("__part").orderBy(key)))
    counts = dealt.groupBy("__part").agg(F.count("*").alias("__n"))
    before = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return dealt.join(before, "__part").withColumn(name, F.col("__at") + F.col("__before") + F.lit(start - 1)).drop("__part", "__at", "__before", "__n")


def link_closure(seeds: DataFrame, edges: DataFrame, nodes: DataFrame, types: list[str], save, folder: str, max_hops: int | None = None, max_pages: int | None = None, known: DataFrame | None = None) -> DataFrame:
    """(url, hop) of all pages reached from the seeds along edges of the types; only in-range pages are expanded.

    Breadth first; every hop is one join and one anti join by url. Its pages are written once, as a partition of
    `folder`, and never again. `save(df)` fixes other intermediate rows. A closure that isn't complete after max_hops,
    where that is given, raises an error. Links to pages of known (url) aren't followed.

    With max_pages the pages also have their number in a queue's order: seeds (by pos, if they have one), then links
    by their parent's number and their own place (the edges' pos). The queue ends with the page that is the
    max_pages-th accepted one, in range or of unknown version; later pages aren't given.
    """
    spark = seeds.sparkSession
    ordered = max_pages is not None
    place = F.col("pos").cast("long") if "pos" in edges.columns else F.lit(0).cast("long")
    expanded = nodes.filter("version_status = 'in_range'").select(F.col("url").alias("from"))
    live = save(edges.filter(F.col("type").isin(types)).join(expanded, "from", "left_semi").groupBy("from", "to").agg(F.min(place).alias("place")))
    start = F.col("pos").cast("long") if "pos" in seeds.columns else F.lit(0).cast("long")
    schema = "url string, number long, accepted int, hop int"

    def write(found: DataFrame, hop: int, before: int) -> DataFrame:
        """Writes a hop's pages (url, order) and reads them back."""
        if ordered:
            status = nodes.select("url", F.col("version_status").isin("in_range", "version_unknown").cast("int").alias("accepted"))
            found = dense_numbers(found, F.struct("order", "url"), save, before + 1).join(status, "url", "left").withColumn("accepted", F.coalesce("accepted", F.lit(0)))
        else:
            found = found.withColumns({"number": F.lit(0), "accepted": F.lit(0)})
        found.select("url", F.col("number").cast("long").alias("number"), "accepted").write.mode("overwrite").parquet(f"{folder}/hop={hop}")
        return spark.read.schema(schema).parquet(folder).filter(F.col("hop") == hop)

    total = accepted = hop = 0
    front = write(seeds.groupBy("url").agg(F.struct(F.min(start).alias("parent"), F.lit(0).cast("long").alias("place")).alias("order")), 0, 0)
    while True:
        pages, taken = front.agg(F.count("*"), F.coalesce(F.sum("accepted"), F.lit(0))).first()
        total, accepted, hop = total + pages, accepted + taken, hop + 1
        if not pages or ordered and accepted >= max_pages:
            break
        if max_hops is not None and hop > max_hops + 1:
            raise ValueError(f"pages beyond {max_hops} hops")
        links = front.join(live, front.url == live["from"]).groupBy(F.col("to").alias("url")).agg(F.min(F.struct(F.col("number").alias("parent"), "place")).alias("order"))
        visited = spark.read.schema(schema).parquet(folder).filter(F.col("hop") < hop).select("url")
        step = links.join(visited, "url", "left_anti")
        front = write(step if known is None else step.join(known.select("url"), "url", "left_anti"), hop, total)
    found = spark.read.schema(schema).parquet(folder).filter(F.col("hop") < hop)
    if not ordered:
        return found.select("url", "hop")
    counted = with_neighbours(found.select(F.lit(0).alias("source"), F.col("number").alias("line_no"), "url", "hop", "accepted"), {"so_far": ("sum", F.col("accepted"))}, segment=COUNTED)
    return counted.filter(F.col("so_far") - F.col("accepted") < max_pages).select("url", "hop", F.col("line_no").alias("number"))


def graph_checks(nodes: DataFrame, edges: DataFrame, manifest: DataFrame) -> DataFrame:
    """(check, url) of every violation: in-range page without a file, file without a node, expanded page out of
    range, and pages of unknown version for review."""

    def named(check: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(check).alias("check"), "url")

    files = manifest.filter("local_path IS NOT NULL").select("url")
    skipped = nodes.filter(F.col("version_status").startswith("skipped"))
    return (
        named("in_range_without_file", nodes.filter("version_status = 'in_range'").join(files, "url", "left_anti"))
        .unionByName(named("file_without_node", files.join(nodes.select("url"), "url", "left_anti")))
        .unionByName(named("expanded_out_of_range", skipped.join(edges.select(F.col("from").alias("url")), "url", "left_semi")))
        .unionByName(named("review_version", nodes.filter("version_status = 'version_unknown'")))
    )

"""Incremental page ingest: files are read once, merged by URL, and a crash repeats nothing that is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialogue_etl.functions import text as T
from dialogue_etl.sources.keyed import KeyedTable

PAGE_SCHEMA = "page_id long, url string, html string"


def pages_table(path: str, slots: int = 64) -> KeyedTable:
    return KeyedTable(path, PAGE_SCHEMA, "url", slots)


def urls_table(path: str, slots: int = 64) -> KeyedTable:
    return KeyedTable(path, "url string", "url", slots)


def ingest(spark: SparkSession, incoming: str, table: KeyedTable, checkpoint: str, files_per_trigger: int | None = 4, force: bool = False) -> None:
    """Merges all new page files into the table and stops; files_per_trigger is a batch's number of files, None for all.

    Of the pages of one normalised URL the smallest page_id counts; pages without a URL are left out. URLs that the
    table has already keep their row; with force the new page replaces it. No state grows in the stream: each batch
    reads only the table's partitions that its URLs fall into, and of these only what the filter of URLs lets through.
    """

    def merge(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("url", T.normalize_url(F.col("url")))
        first = F.row_number().over(Window.partitionBy("url").orderBy(F.asc_nulls_last("page_id"), F.asc_nulls_last("html")))
        table.merge(rows.withColumn("nth", first).filter("nth = 1").drop("nth"), base + number, force)

    base = table.first_batch(spark, checkpoint)
    stream = spark.readStream.schema(PAGE_SCHEMA)
    if files_per_trigger is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)
    stream.parquet(incoming).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def distinct_urls(spark: SparkSession, incoming: str, table: KeyedTable, checkpoint: str, files_per_trigger: int = 4) -> None:
    """Each normalised URL of the new files once into the table, over all runs; the stream itself keeps no URL."""

    def merge(batch: DataFrame, number: int) -> None:
        table.merge(batch.select(T.normalize_url(F.col("url")).alias("url")).distinct(), base + number)

    base = table.first_batch(spark, checkpoint)
    stream = spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(incoming)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

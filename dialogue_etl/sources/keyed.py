"""A table of one row a key that batches add to, and replace in, without reading or writing the rest of it.

Rows are dealt by the key's hash into slots, and within a slot into the batch that brought them:
`rows/slot=17/batch=5`. A batch looks only into the slots that its own keys fall into. Beside the rows stands a Bloom
filter of all keys, in bitmaps by slot: a key that lacks one of its bits is new and isn't looked up; the others are
checked against the keys themselves. A batch that is repeated after a crash writes the same partitions again.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of one bitmap, and the bits that a key sets.
BITMAP_BITS = 32_768
PROBES = 5


@dataclass(frozen=True)
class KeyedTable:
    """path: a folder that all executors share; columns: the rows' columns with their types, the key among them.

    slots and filter_bits (of a slot's filter) hold for the table's whole life: those of the first batch are kept with
    it. About filter_bits / 10 keys a slot keep the filter's errors at one in a hundred; with more, more is looked up.
    """

    path: str
    columns: str
    key: str = "url"
    slots: int = 64
    filter_bits: int = 1 << 20

    # --- reading ---

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows, in the table's columns."""
        return self._stored(spark).drop("slot", "batch")

    def known(self, keys: DataFrame, batch_id: int) -> DataFrame:
        """The keys of `keys` (key, slot) that earlier batches brought."""
        spark = keys.sparkSession
        maybe = self._maybe(keys, batch_id)
        slots = [r[0] for r in maybe.select("slot").distinct().collect()]  # at most as many as the table has slots
        return self.earlier(spark, slots, batch_id).select(self.key, "slot").join(maybe, [self.key, "slot"], "left_semi").select(self.key)

    def earlier(self, spark: SparkSession, slots: list[int], batch_id: int) -> DataFrame:
        """Rows of earlier batches in these slots, with their slot and batch; other partitions aren't read."""
        return self._stored(spark).filter(F.col("slot").isin(slots) & (F.col("batch") < batch_id))

    # --- writing ---

    def merge(self, batch: DataFrame, batch_id: int, force: bool = False) -> None:
        """Adds the rows of a batch (one row a key) whose key is new; with force all of them, replacing older rows.

        Batches come in ascending order of their ids; the last one may come again. Rows with a null key are left out.
        """
        spark = batch.sparkSession
        slots, _ = self._layout(spark)
        names = spark.createDataFrame([], self.columns).columns
        rows = batch.filter(F.col(self.key).isNotNull()).select(*names).withColumn("slot", F.pmod(F.xxhash64(self.key), F.lit(slots)).cast("int"))
        keys = rows.select(self.key, "slot")
        if force:
            self._replace(rows, keys, batch_id)
        else:
            fresh = rows.join(self.known(keys, batch_id), self.key, "left_anti")
            self._publish(fresh.withColumn("batch", F.lit(batch_id).cast("long")))
        self._extend_filter(spark, batch_id)

    def first_batch(self, spark: SparkSession, stream: str) -> int:
        """The number that batch 0 of a stream has in this table: streams that write into it one after the other don't
        share numbers. It is fixed when the stream first asks."""
        path = f"{self.path}/streams/{hashlib.md5(stream.encode()).hexdigest()}"
        if not _children(spark, path):
            last = self._stored(spark).agg(F.max("batch")).first()[0]
            _make(spark, f"{path}/{0 if last is None else last + 1}")
        return int(min(_children(spark, path), key=int))

    def _replace(self, rows: DataFrame, keys: DataFrame, batch_id: int) -> None:
        """Older partitions that hold a replaced key are written again without it, in one commit with the new rows.

        What is to be published stands whole in a folder of its own first: partitions are published one after the
        other, and if that breaks off, the repeated batch publishes the same folder again.
        """
        spark = rows.sparkSession
        touched = [r[0] for r in keys.select("slot").distinct().collect()]
        staged = f"{self.path}/staged/{batch_id}"
        if not _exists(spark, f"{staged}/_SUCCESS"):
            stale = self._stale(spark, touched, keys, batch_id)
            old = self.earlier(spark, sorted({s for s, _ in stale}), batch_id)
            # One short row a partition that is written again.
            held = old.join(F.broadcast(spark.createDataFrame(stale, "slot int, batch long")), ["slot", "batch"], "left_semi").join(keys.select(self.key), self.key, "left_anti")
            new = rows.withColumn("batch", F.lit(batch_id).cast("long"))
            new.unionByName(held).repartition("slot", "batch").write.mode("overwrite").parquet(staged)
        self._publish(spark.read.schema(f"{self.columns}, slot int, batch long").parquet(staged))
        # Partitions that still hold a replaced key held nothing else.
        for slot, batch in self._stale(spark, touched, keys, batch_id):
            _remove(spark, f"{self.path}/rows/slot={slot}/batch={batch}")
        _remove(spark, staged)

    def _stale(self, spark: SparkSession, slots: list[int], keys: DataFrame, batch_id: int) -> list[tuple[int, int]]:
        found = self.earlier(spark, slots, batch_id).join(keys, [self.key, "slot"], "left_semi")
        return [(r[0], r[1]) for r in found.select("slot", "batch").distinct().collect()]

    def _publish(self, rows: DataFrame) -> None:
        """Replaces the partitions that the rows belong to, and no others."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot", "batch").parquet(f"{self.path}/rows")

    # --- the filter ---

    def _maybe(self, keys: DataFrame, batch_id: int) -> DataFrame:
        """The keys (key, slot) that have all their bits set in the filter of the batches before."""
        before = self._filter_before(keys.sparkSession, batch_id)
        if before is None:
            return keys.limit(0)
        probes = keys.select(self.key, "slot", F.explode(self._bits(keys.sparkSession)).alias("p")).select(self.key, "slot", "p.bucket", "p.bit")
        byte = F.conv(F.hex(F.substring("bits", F.expr("bit div 8 + 1"), F.lit(1))), 16, 10).cast("int")
        hit = byte.bitwiseAND(F.expr("shiftleft(1, bit % 8)")) != 0
        met = probes.join(before, ["slot", "bucket"]).filter(hit)
        return met.groupBy(self.key, "slot").agg(F.count("*").alias("n")).filter(F.col("n") == PROBES).drop("n")

    def _bits(self, spark: SparkSession):
        """Places of a key's bits: array of (bucket, bit)."""
        _, bits = self._layout(spark)
        places = []
        for k in range(PROBES):
            at = F.pmod(F.xxhash64(self.key, F.lit(k)), F.lit(bits))
            places.append(F.struct((at / BITMAP_BITS).cast("int").alias("bucket"), (at % BITMAP_BITS).cast("int").alias("bit")))
        return F.array(*places)

    def _extend_filter(self, spark: SparkSession, batch_id: int) -> None:
        """Writes the filter with this batch's keys, then drops the one before the last."""
        new = self._stored(spark).filter(F.col("batch") == batch_id)
        bits = new.select("slot", F.explode(self._bits(spark)).alias("p")).groupBy("slot", "p.bucket").agg(F.bitmap_construct_agg("p.bit").alias("bits"))
        before = self._filter_before(spark, batch_id)
        if before is not None:
            bits = bits.unionByName(before).groupBy("slot", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        bits.write.mode("overwrite").parquet(f"{self.path}/filter/{batch_id:012d}")
        for number in sorted(n for n in self._filters(spark) if n < batch_id)[:-1]:
            _remove(spark, f"{self.path}/filter/{number:012d}")

    def _filters(self, spark: SparkSession) -> list[int]:
        return [int(n) for n in _children(spark, f"{self.path}/filter") if _exists(spark, f"{self.path}/filter/{n}/_SUCCESS")]

    def _filter_before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        numbers = [n for n in self._filters(spark) if n < batch_id]
        return spark.read.schema("slot int, bucket int, bits binary").parquet(f"{self.path}/filter/{max(numbers):012d}") if numbers else None

    # --- layout ---

    def _layout(self, spark: SparkSession) -> tuple[int, int]:
        """(slots, bits of a slot's filter) of the table, fixed by whoever first asks; kept in the name of a folder."""
        names = _children(spark, f"{self.path}/layout")
        if not names:
            bits = -(-self.filter_bits // BITMAP_BITS) * BITMAP_BITS
            names = [f"{self.slots}-{bits}"]
            _make(spark, f"{self.path}/layout/{names[0]}")
        slots, bits = min(names).split("-")
        return int(slots), int(bits)

    def _stored(self, spark: SparkSession) -> DataFrame:
        schema, path = f"{self.columns}, slot int, batch long", f"{self.path}/rows"
        return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def _make(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.mkdirs(p)


def _remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def _children(spark: SparkSession, path: str) -> list[str]:
    p, fs = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

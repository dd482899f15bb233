"""Mixing sources to target weights by hash-threshold histograms.

Every document has a hash that depends on its id alone. Words are summed by source and hash bucket; running
sums over a source's buckets show in which bucket the budget runs out; only that boundary bucket is summed
again by the next digits of the hash. The result is one hash threshold a source, so the mix is a filter:
nothing is sorted, and a larger budget's documents contain those of a smaller one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialogue_etl.llm.common import materialize

#: Hexadecimal digits of the hash that one level of histograms resolves, and the levels.
DIGITS, LEVELS = 3, 5
WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
WORD = "[^\\x20\\x09-\\x0D]+"


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    h = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), F.substring(h, 1, DIGITS * LEVELS).alias("h"))


def targets(by_source: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) by water filling; by_source has one row a source, so it is a small table.

    A source stops at `most` times its size; what is cut is shared by weight among the others. Sorted by
    size over weight the sources stop in that order, so running sums give the level in closed form.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    rows = by_source.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    rows = rows.withColumn("cut", F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("open", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    whole = Window.partitionBy()
    rows = rows.withColumn("budget", share * F.sum("source_size").over(whole))
    rows = rows.withColumn("level", (F.col("budget") - F.col("cut")) / F.col("open"))
    # The first source that doesn't stop sets the level of all later ones; before it all stop.
    rows = rows.withColumn("lasting", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level"))).over(whole))
    target = F.when(F.col("lasting").isNull() | (F.col("ratio") < F.col("lasting.ratio")), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("lasting.level")))
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def thresholds(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, whole, upto): every document counts `whole` times, and once more if its hash <= upto."""
    # What is left after whole copies of the source.
    state = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    state = state.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")).withColumn("prefix", F.lit("")).withColumn("upto", F.lit(None).cast("string"))
    state = materialize(state.select("source", "whole", "rest", "prefix"), "mix-state")
    for level in range(1, LEVELS + 1):
        boundary = state.filter("rest > 0").select(F.col("source").alias("s"), F.col("prefix").alias("p"), "rest")
        near = docs.join(boundary, docs.source.eqNullSafe(F.col("s")) & (F.substring("h", 1, DIGITS * (level - 1)) == F.col("p")))
        hist = near.groupBy("source", F.substring("h", 1, DIGITS * level).alias("bucket")).agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        hist = hist.withColumn("upto", upto)
        # The boundary bucket: the first whose running sum reaches the rest.
        edge = hist.filter("upto >= rest").groupBy("source").agg(F.min_by(F.struct("bucket", (F.col("rest") - F.col("upto") + F.col("words")).alias("left"), "words"), "bucket").alias("e"))
        edge = edge.select(F.col("source").alias("s"), F.col("e.bucket").alias("bucket"), F.col("e.left").alias("left"), F.col("e.words").alias("words"))
        joined = state.join(edge, state.source.eqNullSafe(F.col("s")), "left")
        if level < LEVELS:
            state = joined.select("source", "whole", F.coalesce("left", F.lit(0.0)).alias("rest"), F.coalesce("bucket", "prefix").alias("prefix"))
        else:  # the last bucket goes to the nearer side; '' is below every hash, so a source without a bucket takes none
            below = F.when(F.col("left") * 2 >= F.col("words"), F.concat("bucket", F.lit("~"))).otherwise(F.col("bucket"))
            state = joined.select("source", "whole", F.coalesce(below, F.when(F.col("rest") > 0, F.lit("~")).otherwise(F.col("prefix"))).alias("upto"))
        state = materialize(state, "mix-state")
    return state


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Returns (doc_id, size, source_size, target, taken) for every row of docs.

    size is the number of words between white space (a null text has none). Sources in code point order, null
    last, weigh `weights` in turn and share `share` times all words; a target stops at `most` times the
    source's size. taken is a multiple of size, so no document is cut. Rows that repeat an id have the same
    hash and are taken alike; null ids share one hash. A source of empty documents has target 0.
    """
    rows = materialize(sized(docs, id_col, text_col, source_col), "mix-sized")
    plan = materialize(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets")
    cut = thresholds(rows, plan).select(F.col("source").alias("s"), "whole", "upto")
    plan = plan.join(cut, plan.source.eqNullSafe(F.col("s"))).select(F.col("source").alias("s"), "source_size", "target", "whole", "upto")
    out = rows.join(materialize(plan, "mix-plan"), F.col("source").eqNullSafe(F.col("s")))
    times = F.col("whole") + F.when(F.col("h") < F.col("upto"), 1).otherwise(0)
    return out.select(F.col("doc_id").alias(id_col), "size", "source_size", "target", (times * F.col("size")).cast("long").alias("taken"), times.cast("int").alias("copies"))


def mixed(docs: DataFrame, id_col: str = "doc_id", **names) -> DataFrame:
    """The mix itself: every row of docs as often as it is taken. Empty documents are taken as their hash says.

    The threshold of a row's source decides on each row; rows that repeat an id have the same hash.
    """
    source = names.get("source_col", "source")
    # The same expressions on the same columns: the threshold of the row's source decides, no join by id.
    rows = materialize(sized(docs, id_col, names.get("text_col", "text"), source), "mix-sized")
    plan = materialize(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "mix-targets")
    cut = thresholds(rows, plan).select(F.col("source").alias("__s"), F.col("whole").alias("__whole"), F.col("upto").alias("__upto"))
    h = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, DIGITS * LEVELS)
    out = docs.join(cut, F.col(source).eqNullSafe(F.col("__s")))
    times = F.col("__whole") + F.when(h < F.col("__upto"), 1).otherwise(0)
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(0), times))).filter(F.col("__copy") > 0).select(*[docs[c] for c in docs.columns])


def op3_mix_sources(spark, sf_dir: str) -> DataFrame:
    """mix() of all documents. A null text has size 0; null sources are one source, the last; repeated ids are taken
    alike."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size, substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT source, source_size, 2.0 * source_size AS cap, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS weight, CAST(1.5 * sum(source_size) OVER () AS DOUBLE) AS budget FROM s),
o AS (SELECT *, CAST(cap AS DOUBLE) / CAST(weight AS DOUBLE) AS ratio FROM r),
l AS (SELECT *, (budget - CAST(coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)) / CAST(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM o),
f AS (SELECT arg_min(level, ratio) AS level, min(ratio) AS ratio FROM l WHERE ratio > level),
t AS (SELECT l.source, l.source_size, CASE WHEN f.ratio IS NULL OR l.ratio < f.ratio THEN CAST(l.cap AS DOUBLE) ELSE least(CAST(l.cap AS DOUBLE), CAST(l.weight AS DOUBLE) * f.level) END AS target FROM l, f),
w AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS INTEGER) ELSE 0 END AS whole FROM t),
g AS (SELECT source, h, sum(size) AS words FROM d GROUP BY source, h),
c AS (SELECT g.source, g.h, w.target - w.whole * w.source_size AS rest, sum(g.words) OVER (PARTITION BY g.source ORDER BY g.h) AS upto, g.words FROM g JOIN w ON g.source IS NOT DISTINCT FROM w.source),
k AS (SELECT source, h, CASE WHEN rest <= 0 THEN 0 WHEN upto < rest THEN 1 WHEN upto - words < rest AND (rest - upto + words) * 2 >= words THEN 1 ELSE 0 END AS more FROM c)
SELECT d.doc_id, d.size, w.source_size, w.target, CAST((w.whole + k.more) * d.size AS BIGINT) AS taken, CAST(w.whole + k.more AS INTEGER) AS copies
FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.h = k.h
"""

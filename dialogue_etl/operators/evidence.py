"""Evidence audit: citations of lines, their grades, and the story phase that evidence belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialogue_etl.functions import text as T
from dialogue_etl.operators.graph import dense_numbers
from dialogue_etl.operators.scan import with_neighbours

CITATION = "`([^`\\s]+?\\.md)(?::(\\d+))?`"
GRADES = ["verbatim", "artifact", "impression", "inference"]
#: Phase, first version, version after the last; ranks are in order. The bounds are parameters of this library.
#: Versions that one task of the sweep sees at a time.
SWEPT = 100_000
PHASES = [("early", "3.0", "3.2"), ("netherworld", "3.2", "3.3"), ("post_3.2", "3.3", "3.5"), ("late", "3.5", "4.2"), ("postscript", "4.2", "999")]


def citations(lines: DataFrame) -> DataFrame:
    """(source, line_no, path, target_line); target_line is null where only the file is cited."""
    paths, targets = (F.regexp_extract_all("line", F.lit(CITATION), k) for k in (1, 2))
    rows = lines.filter(F.col("line").contains("`")).select("source", "line_no", F.explode(F.arrays_zip(paths.alias("p"), targets.alias("t"))).alias("c"))
    return rows.select("source", "line_no", F.col("c.p").alias("path"), F.nullif(F.col("c.t"), F.lit("")).cast("int").alias("target_line"))


def unresolved(cited: DataFrame, files: DataFrame) -> DataFrame:
    """Citations of unknown files (reason file), of lines past a file's end (line) or by an absolute path (absolute).

    files has (path, n_lines), one short row a file.
    """
    joined = cited.join(files, "path", "left")
    reason = F.when(F.col("path").rlike("^(?:/|[A-Za-z]:[/\\\\])"), "absolute").when(F.col("n_lines").isNull(), "file").when(F.col("target_line").isNotNull() & ~F.col("target_line").between(1, F.col("n_lines")), "line")
    return joined.withColumn("reason", reason).filter("reason IS NOT NULL").select("source", "line_no", "path", "target_line", "reason")


def evidence_grades(lines: DataFrame) -> DataFrame:
    """(source, one count a grade) of grade words in backticks."""
    return lines.groupBy("source").agg(*[F.sum(F.regexp_count("line", F.lit(f"`{g}`"))).alias(g) for g in GRADES])


def phase_tagged(rows: DataFrame, version: str = "version", phases=PHASES) -> DataFrame:
    """Adds phase and phase_rank by the half-open interval that the version falls in; null outside all."""
    key = T.version_key(F.col(version))
    phase, rank = F.lit(None).cast("string"), F.lit(None).cast("int")
    for k, (name, low, high) in reversed(list(enumerate(phases))):
        inside = (key >= T.version_key(F.lit(low))) & (key < T.version_key(F.lit(high)))
        phase, rank = F.when(inside, F.lit(name)).otherwise(phase), F.when(inside, F.lit(k)).otherwise(rank)
    return rows.withColumns({"phase": phase, "phase_rank": rank})


def phase_table(spark: SparkSession, phases=PHASES) -> DataFrame:
    """(phase, phase_rank, low, high) of phases in order; a bound that is None is open."""
    return spark.createDataFrame([(name, k, low, high) for k, (name, low, high) in enumerate(phases)], "phase string, phase_rank int, low string, high string")


def with_phases(rows: DataFrame, phases: DataFrame, save, version: str = "version") -> DataFrame:
    """rows with phase and phase_rank, once for every phase with low <= version < high; phases may overlap.

    A sweep, no range join: the phases' bounds cut the versions into pieces, a phase is a run of pieces by their
    numbers, and a version lies in the piece of the last bound at or before it. Only distinct versions are swept; rows
    meet their phases by equality. Versions outside all phases, and null ones, are rows without a phase. `save(df)`
    fixes intermediate rows.
    """
    spans = phases.select("phase", "phase_rank", T.version_key(F.col("low")).alias("low"), T.version_key(F.col("high")).alias("high"))
    # Below everything stands an empty key, the bound of phases that are open there.
    spans = save(spans.withColumn("low", F.coalesce("low", F.array().cast("array<long>"))))
    bounds = save(dense_numbers(spans.select(F.explode(F.array("low", "high")).alias("bound")).filter("bound IS NOT NULL").distinct(), "bound", save, name="piece"))
    begins, ends = bounds.select(F.col("bound").alias("low"), F.col("piece").alias("first")), bounds.select(F.col("bound").alias("high"), F.col("piece").alias("stop"))
    runs = spans.join(begins, "low").join(ends, "high", "left").withColumn("stop", F.coalesce("stop", F.lit(bounds.count() + 1)))
    covered = runs.filter("first < stop").select("phase", "phase_rank", F.explode(F.sequence(F.col("first"), F.col("stop") - 1)).alias("piece"))
    keys = rows.select(T.version_key(F.col(version)).alias("key")).filter("key IS NOT NULL").distinct()
    none = F.lit(None).cast("long")
    points = keys.select("key", none.alias("piece")).unionByName(bounds.select(F.col("bound").alias("key"), F.col("piece").cast("long").alias("piece"))).groupBy("key").agg(F.max("piece").alias("piece"))
    points = dense_numbers(points, "key", save, name="line_no").withColumn("source", F.lit(0))
    placed = with_neighbours(points, {"at": ("last_here", F.col("piece"))}, segment=SWEPT).select("key", F.col("at").alias("piece")).join(covered, "piece").drop("piece")
    placed = placed.withColumnRenamed("key", "__key")
    return rows.join(placed, T.version_key(F.col(version)) == F.col("__key"), "left").drop("__key")


def up_to_phase(tagged: DataFrame, phases: DataFrame, asked: str | None = None) -> DataFrame:
    """Rows of phases up to the asked one, by default the latest; rows without a phase go."""
    ranks = phases.agg(F.max("phase_rank")) if asked is None else phases.filter(F.col("phase") == asked).select("phase_rank")
    rank = ranks.first()
    if rank is None:
        raise ValueError(f"no phase is named {asked!r}")
    return tagged.filter(F.col("phase_rank") <= rank[0])


def exclude_sources(rows: DataFrame, excluded: DataFrame, column: str = "source") -> DataFrame:
    return rows.join(excluded.select(column), column, "left_anti")


def labelled_catalog(names: DataFrame) -> DataFrame:
    """(label, text, name): of assets named 【label】text.wav the first by name for each label."""
    pattern = "^【([^】]+)】(.*)\\.wav$"
    rows = names.filter(F.col("name").rlike(pattern)).select("name", F.regexp_extract("name", pattern, 1).alias("label"), F.regexp_extract("name", pattern, 2).alias("text"))
    return rows.groupBy("label").agg(F.min_by(F.struct("text", "name"), "name").alias("r")).select("label", "r.text", "r.name")


def ranked(rows: DataFrame, by: list[str], order: list, name: str = "place") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))

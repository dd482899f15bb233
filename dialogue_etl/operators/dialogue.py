"""Dialogue rows from typed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogue_etl.operators import lines as L


def extract_dialogue(lines: DataFrame, speakers: list[str] | None = None) -> DataFrame:
    """source, line_no, speaker, text, section_title, version of the dialogue lines; no speakers given: all."""
    rows = L.with_section_names(lines).filter("kind = 'dialogue' AND speaker IS NOT NULL")
    if speakers:
        rows = rows.filter(F.col("speaker").isin(speakers))
    return rows.select("source", "line_no", "speaker", "text", "section_title", "version")


def kind_counts(lines: DataFrame, by: str = "source") -> DataFrame:
    kinds = ["dialogue", "choice", "meta", "heading", "text"]
    return lines.groupBy(by).agg(*[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds])


def bind_metadata(dialogue: DataFrame, tasks: DataFrame) -> DataFrame:
    """Task title and version by source; dialogue of unknown sources stays."""
    return dialogue.join(tasks.select("source", "task_title", "task_version"), "source", "left")

"""Vocabulary source: a concept table and a label table.

``concept(id, name, parent_id)``: one row per concept, ``parent_id`` null at a
root. ``label(concept_id, label)``: further spellings of a concept, and with a column
``language`` in which language.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from seqprep.sources.tables import read_table

CONCEPT_COLUMNS = ("id", "name", "parent_id")
LABEL_COLUMNS = ("concept_id", "label")


@dataclass(frozen=True)
class Vocabulary:
    concepts: DataFrame
    labels: DataFrame | None = None

    def __post_init__(self) -> None:
        _require(self.concepts, CONCEPT_COLUMNS, "concept")
        if self.labels is not None:
            _require(self.labels, LABEL_COLUMNS, "label")


def read_vocabulary(
    spark: SparkSession, concept_table: str, label_table: str | None = None
) -> Vocabulary:
    """A vocabulary from catalog tables or views."""
    labels = None if label_table is None else read_table(spark, label_table)
    return Vocabulary(read_table(spark, concept_table), labels)


def _require(df: DataFrame, columns: tuple[str, ...], what: str) -> None:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"{what} table lacks {', '.join(missing)}")

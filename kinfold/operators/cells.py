"""Records unpivoted to cells, and the map from records to reference ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.sources.readers import CELLS, RESERVED


def data_columns(records: DataFrame) -> list[str]:
    return [c for c in records.columns if c not in RESERVED]


def flatten(records: DataFrame, skip_leading_columns: int = 0) -> DataFrame:
    """Rows (record_id, source, col_index, value) of the cells that hold something.

    Empty cells are filtered inside the row, before it is exploded.  col_index counts from the first column kept.
    """
    if CELLS in records.columns:
        kept = F.slice(F.coalesce(CELLS, F.array().cast("array<string>")), skip_leading_columns + 1, F.greatest(F.size(CELLS), F.lit(1))) if skip_leading_columns else F.col(CELLS)
        cells = F.transform(kept, lambda v, i: F.struct(i.cast("int").alias("col_index"), v.alias("value")))
    else:
        columns = data_columns(records)[skip_leading_columns:]
        if not columns:
            raise ValueError(f"skipping {skip_leading_columns} columns leaves none")
        cells = F.array(*(F.struct(F.lit(i).alias("col_index"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(columns)))
    full = F.filter(cells, lambda c: F.length(c["value"]) > 0)
    return records.select("record_id", "source", F.inline(full))


def reference_ids(records: DataFrame, column_index: int = 0) -> DataFrame:
    """Rows (record_id, ref_id): the data column of that index, where it holds something."""
    if CELLS in records.columns:
        value = F.get(CELLS, F.lit(column_index))
    else:
        columns = data_columns(records)
        if not 0 <= column_index < len(columns):
            raise ValueError(f"reference column {column_index} is not among {len(columns)} columns")
        value = F.col(f"`{columns[column_index]}`").cast("string")
    return records.select("record_id", value.alias("ref_id")).where(F.length("ref_id") > 0)

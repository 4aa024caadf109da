"""Reference-sheet load.

A worksheet (header row, every cell a string) becomes a typed table. The remote
spreadsheet API itself is not used (no network); a CSV export, or any table of
string cells, is the input. Header names select the columns of the schema; a
column missing from the sheet is NULL, cells are trimmed, an empty one is NULL.
A cell that its column's type cannot hold is not lost and stops nothing: its row
goes to the reject table with every such cell named.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """The string cells of a CSV export, with its header's names trimmed."""
    raw = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', multiLine=True)
    return raw.toDF(*[c.strip() for c in raw.columns])


def parse_cells(cells: DataFrame, schema: StructType | str, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejects): rows whose cells all fit ``schema``, and one reject per cell that does not.

    Rejects are ``(row, column, value)``; ``row`` names the column with the
    row's number or key, NULL without one. One projection, no shuffle.
    """
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    typed, wrong = [], []
    for f in st.fields:
        if f.name not in cells.columns:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = F.nullif(F.trim(F.col(f"`{f.name}`")), F.lit(""))
        value = text.try_cast(f.dataType)
        typed.append(value.alias(f.name))
        wrong.append(F.when(text.isNotNull() & value.isNull(), F.struct(F.lit(f.name).alias("column"), text.alias("value"))))
    bad = F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<struct<column:string,value:string>>")
    key = F.col(f"`{row}`") if row else F.lit(None).cast("long")
    fits = cells.filter(F.size(bad) == 0).select(*typed)
    rejects = cells.select(key.alias("row"), F.inline(bad))
    return fits, rejects


def load_sheet_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The typed rows of a CSV export; a cell of the wrong type fails the load (see ``parse_cells`` for rejects)."""
    rows, rejects = parse_cells(read_cells(spark, path), schema)
    first = rejects.first()
    if first is not None:
        raise ValueError(f"column {first['column']!r} of {path} holds {first['value']!r}")
    return rows

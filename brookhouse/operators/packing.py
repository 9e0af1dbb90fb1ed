"""Columns that a shuffle or a state only carries, as one text.

A column costs a row eight bytes and padding besides its content, in shuffles and in the state of a stream alike. A join of
wide rows therefore carries them packed, and takes them apart behind it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PACKED = "_packed"
BETWEEN, MARK = "\x1f", "\x1e"
NONE = f"{MARK}N"


def _part(c: str) -> Column:
    """A column as text without the mark between columns; NULL has a text of its own."""
    text = F.replace(F.replace(F.col(c).cast("string"), F.lit(MARK), F.lit(f"{MARK}A")), F.lit(BETWEEN), F.lit(f"{MARK}B"))
    return F.coalesce(text, F.lit(NONE))


def packable(rows: DataFrame, names) -> list[str]:
    """Which of some columns are text or whole numbers, whose text says everything."""
    return [c for c in names if isinstance(rows.schema[c].dataType, (T.StringType, T.IntegralType))]


def packed(rows: DataFrame, names: list[str]) -> DataFrame:
    """Rows with these columns as one; rows that are packed already get them behind the others."""
    before = [F.col(PACKED)] if PACKED in rows.columns else []
    return rows.withColumn(PACKED, F.concat_ws(BETWEEN, *before, *map(_part, names))).drop(*names)


def unpacked(rows: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """Rows with their columns again: the fields of those that were packed, in that order."""
    def field(n: int, f: T.StructField) -> Column:
        text = F.nullif(F.split_part(PACKED, F.lit(BETWEEN), F.lit(n)), F.lit(NONE))
        text = F.replace(F.replace(text, F.lit(f"{MARK}B"), F.lit(BETWEEN)), F.lit(f"{MARK}A"), F.lit(MARK))
        return text.cast(f.dataType)

    return rows.withColumns({f.name: field(n, f) for n, f in enumerate(fields, 1)}).drop(PACKED)

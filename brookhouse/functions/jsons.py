"""JSON text <-> typed columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def parse_objects(raw: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Replace the text column by the fields of its JSON object; rows that are not one whole object are dropped.

    Other columns of `raw` (a bus offset, say) are kept. A field of the wrong type becomes NULL, the rest of the
    record stays. The parser itself would ignore what follows the first object, so the text is parsed as the only
    element of an array: two objects on a line, or one with other text around it, are not. That is one parse; the
    generators keep the parsed records out of reach of filter push-down, which would otherwise repeat it. Only text with
    something around its braces is trimmed, as that looks at each character.
    """
    bare = F.col(value).startswith("{") & F.col(value).endswith("}")
    text = F.when(bare, F.col(value)).otherwise(F.btrim(value, F.lit(" \t\r\n")))
    rest = [F.col(c) for c in raw.columns if c != value]
    parsed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(schema))
    return (
        raw.filter(text.startswith("{") & text.endswith("}"))
        .select(*rest, F.explode(F.array(parsed)).alias("_objects"))
        .filter(F.size("_objects") == 1)
        .select(*rest, F.inline("_objects"))
    )


def to_line(*columns) -> Column:
    """One JSON object per row; NULL fields are left out."""
    return F.to_json(F.struct(*columns))


def exact_amounts(raw_value: Column, *names: str, precision: int = 20, scale: int = 2) -> Column:
    """Money fields of a change record as decimals.

    The text map renders 2899.00 as "2899.0" and large values in exponent form; reading them with a decimal type
    keeps every digit.
    """
    amounts = T.StructType([T.StructField(n, T.DecimalType(precision, scale)) for n in names])
    return F.from_json(raw_value, T.StructType([T.StructField("data", amounts)]))["data"]

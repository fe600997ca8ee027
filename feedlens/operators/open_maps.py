"""Raw messages with open parts (S2, P1): numbers, text, booleans, lists and nested values
of ``metrics``, ``entities`` and ``metadata`` keep their types from the wire to the wire.

``streaming.jobs.parse_raw`` reads ``metrics`` as a map of numbers, which is what rollups
need. Here the value is parsed once into a VARIANT; the plain fields are taken out with
their types and the open ones stay VARIANT columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.schemas import RAW_FIELDS

OPEN_FIELDS = ["metrics", "entities", "metadata"]


def parse_open(df: DataFrame, value_col: str = "value") -> DataFrame:
    """S2 with open fields: RAW_FIELDS, of which OPEN_FIELDS are VARIANT, and the value
    itself in ``_corrupt_record`` if it is no JSON object. A field that is missing is NULL,
    a plain field that is a list or an object is its JSON text; unknown fields are ignored;
    rows without a value are left out. Runs on streams."""
    v = F.col("_v")
    parsed = df.where(F.col(value_col).isNotNull()).select(F.col(value_col).alias("_value"), F.try_parse_json(value_col).alias("_v"))
    whole = v.isNotNull() & F.schema_of_variant(v).startswith("OBJECT")
    plain = [F.try_variant_get(v, f"$.{c}", "string").alias(c) if c not in OPEN_FIELDS
             else F.try_variant_get(v, f"$.{c}", "variant").alias(c) for c in RAW_FIELDS]
    return parsed.select(*plain, F.when(~F.coalesce(whole, F.lit(False)), F.col("_value")).alias("_corrupt_record"))


def number(col, name: str) -> Column:
    """One entry of an open map as a number: booleans are 1 and 0, text that is no number
    and a missing entry are NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.try_variant_get(c, f"$.{name}", "double"),
                      F.try_variant_get(c, f"$.{name}", "boolean").cast("int").cast("double"))


def text(col, name: str) -> Column:
    """One entry of an open map as text; lists and objects as JSON."""
    c = F.col(col) if isinstance(col, str) else col
    entry = F.try_variant_get(c, f"$.{name}", "variant")
    return F.coalesce(F.try_variant_get(c, f"$.{name}", "string"), F.to_json(entry))


def open_wire(df: DataFrame) -> DataFrame:
    """S6 of open rows: (key, value) with the open fields as they came."""
    fields = [c for c in RAW_FIELDS if c in df.columns]
    return df.select(F.col("id").alias("key"), F.to_json(F.struct(*[F.col(c) for c in fields])).alias("value"))

"""Table schemas, built from the fixed column lists."""

from __future__ import annotations

from pyspark.sql import types as T

from touchline import fixed_values as fv


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(3,1)": T.DecimalType(3, 1),
    "decimal(6,2)": T.DecimalType(6, 2),
}


def _struct(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


def all_strings(schema: T.StructType) -> T.StructType:
    """The same columns with every type text, as the CSV files hold them."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


MATCH = _struct(fv.MATCH_COLUMNS)
LOG = _struct(fv.LOG_COLUMNS)
RETRY_LOG = _struct(fv.LOG_COLUMNS + fv.RETRY_COLUMNS)
LINKS = _struct([("url", "string")])
LEAGUE = _struct(
    [("key", "string"), ("prefix", "string"), ("base_slug", "string"),
     ("archive_url", "string"), ("results_url", "string")]
)
PAGES = _struct([("url", "string"), ("tab", "string"), ("html", "string")])

# Statistics in label order, each one a home and away pair on the page.
STATS = list(dict.fromkeys(stat for _, stat in fv.STAT_LABELS))

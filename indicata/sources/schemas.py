"""Table schemas, generated from the column rules in ``fixed_values``."""

from __future__ import annotations

from pyspark.sql import types as T

from indicata.functions import fixed_values as V

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType()}

# every observation table is: these columns, its dimensions, then the measure block
_BEFORE = {"REF_DATE": "string", "GEO": "string", "DGUID": "string"}
_AFTER = {
    "UOM": "string",
    "UOM_ID": "int",
    "SCALAR_FACTOR": "string",
    "SCALAR_ID": "int",
    "VECTOR": "string",
    "COORDINATE": "string",
    "VALUE": "double",
    "STATUS": "string",
    "SYMBOL": "string",
    "TERMINATED": "string",
    "DECIMALS": "int",
}


def struct(columns: dict[str, str]) -> T.StructType:
    """A nullable struct type from ``{column name: type name}``."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


def observation_schema(table_id: str) -> T.StructType:
    """The schema of one observation table."""
    _, dimensions, overrides = V.OBSERVATION_TABLES[table_id]
    return struct({**_BEFORE, **dict.fromkeys(dimensions, "string"), **_AFTER, **overrides})


def table_id(subject: str) -> str:
    """The table id of a subject name such as ``gdp``."""
    for identifier, (name, _, _) in V.OBSERVATION_TABLES.items():
        if name == subject:
            return identifier
    raise KeyError(subject)


def series_schema(value_column: str = "VALUE") -> T.StructType:
    """One (DATE, value) series."""
    return struct({"DATE": "string", value_column: "double"})


STOCK_SCHEMA = struct({"REF_DATE": "string", **dict.fromkeys(V.STOCK_COLUMNS, "double")})

MACRO_SCHEMA = struct(
    {
        **dict.fromkeys(V.MACRO_TEXT_COLUMNS, "string"),
        **dict.fromkeys(V.MACRO_YEARS, "double"),
        "Estimates Start After": "int",
    }
)

DEVELOPMENT_SCHEMA = struct(
    {
        "ifs": "int",
        "code": "string",
        "country": "string",
        "imf_region": "string",
        "imf_income": "string",
        "year": "int",
        **dict.fromkeys(V.DEVELOPMENT_INDICES, "double"),
    }
)

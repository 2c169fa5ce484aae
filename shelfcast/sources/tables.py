"""The five raw tables: reading, index columns, narrow types, names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of the raw files, their types, and the file names.
TABLE_TYPES = {
    "shop_list": {"shop_name": "string", "shop_id": "int"},
    "item_list": {"item_name": "string", "item_id": "int", "item_category_id": "int"},
    "category_list": {"item_category_name": "string", "item_category_id": "int"},
    "transaction": {"date": "string", "shop": "int", "item": "int", "price": "double", "amount": "double"},
    "test": {"shop": "int", "item": "int"},
}
FILE_NAMES = {name: f"{name}.csv" for name in TABLE_TYPES}
KEY_NAMES = {"shop": "shop_id", "item": "item_id"}


# Quotes inside a field are doubled, blanks at its ends belong to it.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def scan_csv(spark: SparkSession, path: str, types: Mapping[str, str], optional: Sequence[str] = ()) -> DataFrame:
    """A headered CSV with declared types, taken by name; a saved index column is left out.

    Only the header is read ahead; there is no pass to guess types. A declared
    column that the file lacks is an error, unless it is among ``optional``. An
    empty field is null, quoted or not.
    """
    raw = drop_index_columns(spark.read.options(**CSV_OPTIONS).csv(path))
    missing = [c for c in types if c not in raw.columns and c not in optional]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(raw.columns)}")
    return raw.select(*[F.col(c).cast(t).alias(c) for c, t in types.items() if c in raw.columns])


def drop_index_columns(df: DataFrame) -> DataFrame:
    """Drop the nameless row-number column which a saved frame carries along."""
    return df.drop(*[c for c in df.columns if "unnamed: 0" in c.lower() or c == "_c0"])


def narrow_numeric_types(df: DataFrame) -> DataFrame:
    """64-bit numbers to 32 bits. An integer out of range raises instead of wrapping around."""
    narrow = {T.LongType(): "int", T.DoubleType(): "float"}
    return df.select(
        *[F.col(f.name).cast(narrow[f.dataType]).alias(f.name) if f.dataType in narrow else F.col(f.name) for f in df.schema]
    )


def fix_schema(df: DataFrame) -> DataFrame:
    """Key names of the transaction and request files to those of the dimensions."""
    return df.withColumnsRenamed(KEY_NAMES)


def request_schema(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({v: k for k, v in KEY_NAMES.items()})


def load_tables(spark: SparkSession, root: str, files: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """All five tables below ``root``, read lazily; the transactions get the dimension key names."""
    files = {**FILE_NAMES, **(files or {})}
    tables = {name: scan_csv(spark, f"{root}/{files[name]}", types) for name, types in TABLE_TYPES.items()}
    tables["transaction"] = fix_schema(tables["transaction"])
    return tables

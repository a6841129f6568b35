"""2.A readers: untyped extract scan, header handling, column resolution by presence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingColumnsError(ValueError):
    pass


BROKEN = "_broken_line"


def _csv(spark: SparkSession, path: str, header_names: list[str] | None, multi_line: bool) -> DataFrame:
    reader = spark.read.option("header", True).option("escape", '"')
    if multi_line:
        reader = reader.option("multiLine", True)
    names = header_names if header_names is not None else reader.option("inferSchema", False).csv(path).columns  # reads the header only
    schema = T.StructType([T.StructField(h, T.StringType()) for h in names])
    if multi_line:
        return reader.schema(schema).csv(path)
    # a line whose cells do not fit the header is kept aside as it came; with an odd number of quotes it is part of a longer row
    marked = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    df = reader.option("columnNameOfCorruptRecord", BROKEN).option("columnPruning", False).schema(marked).csv(path)
    quotes = F.length(BROKEN) - F.length(F.replace(BROKEN, F.lit('"'), F.lit("")))
    message = F.concat(F.lit("a line break within quotes, read the extract with multi_line=True: "), F.substring(BROKEN, 1, 200))
    whole = F.when(F.col(BROKEN).isNotNull() & (quotes % 2 == 1), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return df.where(whole).drop(BROKEN)


def read_extract(spark: SparkSession, path: str, fmt: str = "csv", header_names: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """A1-A3: scan an extract with every cell as text, strip header whitespace, drop fully empty rows.

    CSV is read in splits, with an all-string schema (no inference pass), so one large file is many tasks. A cell that holds a line break
    is an error then, never a wrong row; ``multi_line`` reads such files, each as one task. Rows shorter than the header
    end in NULLs. Parquet keeps its own types (the cleaning rules accept typed cells too).
    """
    if fmt == "csv":
        df = _csv(spark, path, header_names, multi_line)
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported extract format {fmt!r}")
    return strip_headers(df).na.drop(how="all")


def strip_headers(df: DataFrame) -> DataFrame:
    """A2."""
    return df.toDF(*[c.strip() for c in df.columns])


def require_columns(df: DataFrame, required: dict[str, tuple[str, ...]], filename: str) -> None:
    """A4: each logical column needs one of its accepted headers; report all missing at once (plan time)."""
    present = set(df.columns)
    missing = [
        f"{logical} ({' or '.join(repr(h) for h in headers)})"
        for logical, headers in required.items()
        if not any(h in present for h in headers)
    ]
    if missing:
        raise MissingColumnsError(f"{filename} is missing required columns: " + ", ".join(missing))


def pick_column(df: DataFrame, *names: str) -> Column:
    """A5: the first header that is *present* (not the first non-null value); NULL when none is."""
    for name in names:
        if name in df.columns:
            return F.col(f"`{name}`")
    return F.lit(None).cast("string")


def column_type(df: DataFrame, *names: str) -> T.DataType | None:
    for name in names:
        if name in df.columns:
            return df.schema[name].dataType
    return None

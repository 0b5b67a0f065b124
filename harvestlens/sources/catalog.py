"""Named datasets and typed scans.

A ``Catalog`` maps dataset names to a path template, a format, an explicit
schema or cast map, and optional daily rules (columns to average and to sum).
Reading an unknown name raises ``ValueError``; a per-region dataset needs its
``region`` argument.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestlens.functions.columns import cast_columns
from harvestlens.functions.nulls import nan_to_null


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


@dataclass
class Dataset:
    path: str                               # may contain {region}
    fmt: str = "parquet"
    schema: T.StructType | str | None = None
    casts: dict[str, str] = field(default_factory=dict)
    options: dict[str, str] = field(default_factory=dict)
    date_col: str | None = None             # parsed to DATE when present
    per_region: bool = False
    # hourly data read as a daily panel: (columns averaged, columns summed)
    daily: tuple[list[str], list[str]] | None = None
    region_col: str = "dept_id"
    time_col: str = "datetime"


class Catalog:
    def __init__(self, spark: SparkSession, datasets: dict[str, Dataset]):
        self.spark, self.datasets = spark, dict(datasets)

    def names(self) -> list[str]:
        return list(self.datasets)

    def read(self, name: str, region: str | None = None) -> DataFrame:
        if name not in self.datasets:
            raise ValueError(f"unknown source {name!r}; available: {self.names()}")
        ds = self.datasets[name]
        path = ds.path
        if ds.per_region:
            if region is None:
                raise ValueError(f"source {name!r} needs a region argument")
            path = path.format(region=region)
        df = typed_scan(self.spark, path, ds.fmt, ds.schema, ds.casts, ds.options, ds.date_col)
        if ds.daily is None:
            return df
        from harvestlens.sources.stations import daily_from_hourly
        return daily_from_hourly(df, *ds.daily, region=ds.region_col, time_col=ds.time_col)


def typed_scan(spark: SparkSession, path: str | list[str], fmt: str = "parquet",
               schema: T.StructType | str | None = None, casts: dict[str, str] | None = None,
               options: dict[str, str] | None = None, date_col: str | None = None) -> DataFrame:
    """Read with an explicit schema when given (no inference), cast the listed
    columns that exist, turn NaN into NULL, and parse ``date_col`` to DATE."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if casts:
        df = cast_columns(df, casts)
    df = nan_to_null(df)
    if date_col and date_col in df.columns:
        df = df.withColumn(date_col, F.to_date(F.col(date_col)))
    return df


def filter_numeric(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose ``col`` is a finite number in digits (drops repeated header lines,
    'NaN', and suffixed literals such as '12d' that a cast would accept)."""
    text = F.trim(F.col(col).cast("string"))
    return df.filter(text.rlike(NUMBER))


def id_from_path(pattern: str = r"dept_(\w+)\.csv", group: int = 1,
                 path_col: str = "_metadata.file_path"):
    """Column with the id captured from each row's source file name; a name without one
    raises."""
    found = F.regexp_extract(F.col(path_col), pattern, group)
    return F.when(found != "", found).otherwise(
        F.raise_error(F.concat(F.lit("no id in file name "), F.col(path_col))).cast("string"))


def promote_header(df: DataFrame, header_index: int, order_col: str = "__row_id") -> DataFrame:
    """Headerless sheet export: row ``header_index`` (0-based, in file order)
    holds the column names; earlier rows are dropped, later rows are data.

    File order is the order of partitions and of rows in them, which
    ``monotonically_increasing_id`` numbers; it is the same each time a file scan runs (store
    a ``df`` that is not repeatable first). Only the first ``header_index + 1`` rows are read
    to find the header; the rest is a filter on the row's number.
    """
    with_id = df.withColumn(order_col, F.monotonically_increasing_id())
    head = with_id.limit(header_index + 1).collect()  # the first rows, in order
    if len(head) <= header_index:
        raise ValueError("sheet has fewer rows than the header position")
    header_row = head[header_index]
    names = [str(header_row[c]) for c in df.columns]
    body = with_id.filter(F.col(order_col) > F.lit(header_row[order_col]))
    return body.select(*[F.col(c).alias(n) for c, n in zip(df.columns, names)])

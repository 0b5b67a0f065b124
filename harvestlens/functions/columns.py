"""Column-list helpers: tolerant projections, renames, casts, rounding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keep_columns(df: DataFrame, keep: list[str]) -> DataFrame:
    """Keep the listed columns that exist, in the frame's own order."""
    wanted = set(keep)
    return df.select(*[c for c in df.columns if c in wanted])


def drop_columns(df: DataFrame, cols: list[str], strict: bool = False) -> DataFrame:
    """Drop columns; missing ones are ignored unless ``strict``."""
    if strict:
        missing = [c for c in cols if c not in df.columns]
        if missing:
            raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by map; names that are absent are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def cast_columns(df: DataFrame, types: dict[str, str], strict: bool = True) -> DataFrame:
    """Cast the listed columns that exist. A value that can't be cast raises, or becomes
    NULL with ``strict=False``."""
    out = {}
    for c, t in types.items():
        if c in df.columns:
            value = F.col(c).try_cast(t)
            bad = F.raise_error(F.concat(F.lit(f"{c}: not a {t}: "), F.col(c).cast("string"))).cast(t)
            out[c] = F.when(F.col(c).isNotNull() & value.isNull(), bad).otherwise(value) if strict else value
    return df.withColumns(out) if out else df


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def columns_with_suffix(df: DataFrame, suffixes: list[str]) -> list[str]:
    return [c for c in df.columns if any(c.endswith(s) for s in suffixes)]


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def round_doubles(df: DataFrame, ndigits: int = 6) -> DataFrame:
    """Round every double/float column (comparison helper)."""
    targets = [f.name for f in df.schema.fields
               if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not targets:
        return df
    return df.withColumns({c: F.round(F.col(c), ndigits) for c in targets})

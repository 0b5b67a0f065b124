"""Calendar columns: crop stage, harvest year, date parts, cyclic encoding.

All functions return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage code generation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must match the reference): crop-stage labels of soft winter
# wheat, in stage order, and their calendar cut-offs (inclusive month/day).
#   semis          : September, October, November
#   vernalisation  : December, January, February
#   tallage        : March 1 .. April 15
#   montaison      : April 16 .. May 15
#   floraison      : May 16 .. June 15
#   remplissage    : June 16 .. August 31
STAGES = ["semis", "vernalisation", "tallage", "montaison", "floraison", "remplissage"]
HARVEST_START_MONTH = 9


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def crop_stage(ts: str | Column) -> Column:
    """Crop stage of a date or timestamp (one CASE, no lookup table)."""
    d = _c(ts)
    m, day = F.month(d), F.dayofmonth(d)
    return (
        F.when(m.isin(9, 10, 11), F.lit("semis"))
        .when(m.isin(12, 1, 2), F.lit("vernalisation"))
        .when((m == 3) | ((m == 4) & (day <= 15)), F.lit("tallage"))
        .when(((m == 4) & (day > 15)) | ((m == 5) & (day <= 15)), F.lit("montaison"))
        .when(((m == 5) & (day > 15)) | ((m == 6) & (day <= 15)), F.lit("floraison"))
        .when(((m == 6) & (day > 15)) | m.isin(7, 8), F.lit("remplissage"))
    )


def stage_index(stage: str | Column) -> Column:
    """Position of a stage label in ``STAGES`` (0..5), null when unknown."""
    s = _c(stage)
    expr = None
    for i, name in enumerate(STAGES):
        expr = (F.when(s == name, F.lit(i)) if expr is None
                else expr.when(s == name, F.lit(i)))
    return expr


def harvest_year(ts: str | Column) -> Column:
    """Harvest year: calendar year, plus one from September on."""
    d = _c(ts)
    return (F.year(d) + (F.month(d) >= HARVEST_START_MONTH).cast("int")).cast("int")


def date_parts(ts: str | Column) -> dict[str, Column]:
    """Hour, day of month, month and year of a timestamp, as int columns."""
    d = _c(ts)
    return {
        "heure": F.hour(d).cast("int"),
        "jour": F.dayofmonth(d).cast("int"),
        "mois": F.month(d).cast("int"),
        "annee": F.year(d).cast("int"),
    }


def cyclic(x: str | Column, period: float) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*x/period, in double precision."""
    angle = F.lit(2.0 * math.pi) * _c(x).cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def parse_hour_stamp(stamp: str | Column) -> Column:
    """yyyyMMddHH (int or string) to a timestamp."""
    return F.to_timestamp(_c(stamp).cast("string"), "yyyyMMddHH")


def pad_code(code: str | Column, width: int = 2) -> Column:
    """Integer or string region code as a zero-padded string ("1" -> "01"). Longer codes
    stay as they are ("974")."""
    text = _c(code).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def cyclic_encode(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """sin/cos of hour/24, day/31, month/12 and stage index/6 (replaces the
    hour, day, month and stage columns when present)."""
    parts = date_parts(time_col)
    out = {}
    for name, src, period in (("heure", parts["heure"], 24), ("jour", parts["jour"], 31),
                              ("mois", parts["mois"], 12)):
        s, c = cyclic(src, period)
        out[f"{name}_sin"], out[f"{name}_cos"] = s, c
    s, c = cyclic(stage_index(crop_stage(time_col)), 6)
    out["saison_sin"], out["saison_cos"] = s, c
    return df.withColumns(out).drop("heure", "jour", "mois", "saison")

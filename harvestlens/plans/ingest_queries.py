"""Registered queries of the ingestion chain: region files in two deliveries -> panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestlens.functions.columns import round_doubles
from harvestlens.plans import catalog_queries as cq
from harvestlens.plans import catalog_sql as cs
from harvestlens.plans import testbed_tables as tt
from harvestlens.plans.sql_oracle import rounded
from harvestlens.session import scratch
from harvestlens.sources.ingest import StationIngest

LATE_YEAR = "1998"


def _write_deliveries(spark, sf, root: str) -> list[str]:
    """Station readings as region files, header lines repeated inside. The first delivery has
    the regions' files without the late years; the second has those of odd regions again and
    the late years of all."""
    rows = tt.station_readings(spark, sf)
    columns = [c for c in rows.columns if c != "region"]
    late = F.substring("AAAAMMJJHH", 1, 4) >= LATE_YEAR
    odd = F.conv(F.substring("region", 2, 1), 10, 10).cast("int") % 2 == 1
    text = rows.select(*[F.col(c).cast("string").alias(c) for c in columns],
                       F.concat(F.lit("dept_"), "region", F.when(late, F.lit("_late")).otherwise(F.lit("")), F.lit(".csv")).alias("file"),
                       late.alias("late"), odd.alias("odd"))
    headers = text.select("file", "late", "odd").distinct().select(*[F.lit(c).alias(c) for c in columns], "file", "late", "odd")
    whole = text.unionByName(headers)
    paths = [f"{root}/first", f"{root}/second"]
    for path, part in zip(paths, (whole.filter(~F.col("late")), whole.filter(F.col("late") | F.col("odd")))):
        (part.drop("late", "odd").repartition("file").write.partitionBy("file").option("header", "true").csv(path))
    return paths


def _ingested(spark, sf) -> StationIngest:
    root = scratch(spark, "ingest")
    ingest = StationIngest(spark, f"{root}/state")
    for path in _write_deliveries(spark, sf, root):
        ingest.deliver(path)
    return ingest


def _q_ingest_hourly(spark, sf):
    return round_doubles(_ingested(spark, sf).hourly().select(*cq._STATION_H_COLS))


def _q_ingest_daily(spark, sf):
    return round_doubles(_ingested(spark, sf).daily().select(*cq._STATION_D_COLS))


def register(q: dict, sql: dict) -> None:
    q["ingest_hourly"], q["ingest_daily"] = _q_ingest_hourly, _q_ingest_daily
    # the same panels as from one delivery of everything
    sql["ingest_hourly"] = rounded(cs.station_hourly_sql(), cq._STATION_H_COLS[2:], cq._STATION_H_COLS, 6)
    sql["ingest_daily"] = rounded(cs.station_daily_sql(), cq._STATION_D_COLS[2:], cq._STATION_D_COLS, 6)

"""Station files in deliveries -> region panels, each file counted once.

A delivery is a folder of region files (their name holds the region). What a file brings is
kept as partial sums and counts per (region, hour), so panels come from adding up partials
and no raw file is read twice. A manifest names the files that count, each by name and a
fingerprint of its lines: a file that comes again changes nothing, a late file adds its
readings to regions and hours already there, and a corrected file (same name, other lines)
takes the place of its earlier self. Repeated header lines inside a file are dropped.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestlens.functions.calendar import parse_hour_stamp
from harvestlens.functions.columns import keep_columns, rename_columns
from harvestlens.sources.catalog import filter_numeric, id_from_path
from harvestlens.sources.stations import (STATION_ID_COLS, STATION_KEEP, STATION_RENAME,
                                          daily_from_hourly)
from harvestlens.sources.versions import Manifest

FILE_PATTERN = r"(dept_\w+\.csv)"
REGION_PATTERN = r"dept_([0-9A-Za-z]+)"


class StationIngest:
    """Deliveries below ``root``, a shared folder."""

    def __init__(self, spark: SparkSession, root: str, file_pattern: str = FILE_PATTERN,
                 region_pattern: str = REGION_PATTERN, keep: list[str] = STATION_KEEP,
                 rename: dict[str, str] = STATION_RENAME, stamp_col: str = "AAAAMMJJHH",
                 check_col: str = "ALTI"):
        self.spark, self.root = spark, root.rstrip("/")
        self.file_pattern, self.region_pattern = file_pattern, region_pattern
        self.keep, self.rename, self.stamp_col, self.check_col = list(keep), dict(rename), stamp_col, check_col
        self.manifest = Manifest(spark, f"{self.root}/manifest")

    # ---------------------------------------------------------- deliveries

    def _delivered(self, path: str) -> dict[str, tuple[str, list[str]]]:
        """{file name: (lines and sum of their hashes, paths)} of a delivery; one row per file."""
        lines = self.spark.read.option("recursiveFileLookup", "true").text(path)
        name = id_from_path(self.file_pattern)
        found = lines.select(name.alias("file"), F.input_file_name().alias("path"),
                             F.xxhash64("value").cast("decimal(20,0)").alias("h")).groupBy("file", "path").agg(
            F.count(F.lit(1)).alias("n"), F.sum("h").alias("h")).groupBy("file").agg(
            F.sum("n").alias("n"), F.sum("h").alias("h"), F.sort_array(F.collect_list("path")).alias("paths"))
        return {r["file"]: (f"{r['n']}:{r['h']}", [unquote(p) for p in r["paths"]]) for r in found.collect()}

    def fingerprints(self, path: str) -> dict[str, str]:
        """{file name: lines and sum of their hashes} of a delivery."""
        return {f: mark for f, (mark, _) in self._delivered(path).items()}

    def _readings(self, paths: list[str], files: list[str]) -> DataFrame:
        """Raw rows of some of a delivery's files, typed and renamed, with file and region;
        only these files are read."""
        raw = (self.spark.read.option("header", "true").option("recursiveFileLookup", "true")
               .option("enforceSchema", "false").csv(paths)
               .select("*", id_from_path(self.file_pattern).alias("__file"), id_from_path(self.region_pattern).alias("__region"))
               .filter(F.col("__file").isin(files)))
        df = filter_numeric(raw, self.check_col)
        df = keep_columns(df, self.keep + ["__file", "__region"])
        df = df.withColumn("DATE", parse_hour_stamp(self.stamp_col)).drop(self.stamp_col)
        return rename_columns(df, self.rename).filter(F.col("datetime").isNotNull())

    def deliver(self, path: str) -> list[str]:
        """Take up a delivery; returns the files that were new or changed. A file delivered by
        someone else meanwhile is not counted twice: the manifest decides."""
        delivered = self._delivered(path)
        seen = {f: mark for f, (mark, _) in delivered.items()}
        known = self.manifest.current()[1].get("files", {})
        new = sorted(f for f, mark in seen.items() if known.get(f, {}).get("mark") != mark)
        if not new:
            return []
        rows = self._readings([p for f in new for p in delivered[f][1]], new)
        measures = [c for c in rows.columns if c not in STATION_ID_COLS and not c.startswith("__")]
        value = {c: F.nanvl(F.col(c).try_cast("double"), F.lit(None)) for c in measures}
        delivery = uuid.uuid4().hex
        (rows.groupBy(F.col("__file").alias("file"), F.col("__region").alias("dept_id"), "datetime")
         .agg(*[x for c in measures for x in (F.sum(value[c]).alias(f"{c}__sum"), F.count(value[c]).alias(f"{c}__n"))])
         .withColumn("delivery", F.lit(delivery)).write.parquet(f"{self.root}/partials/{delivery}"))
        taken: list[str] = []

        def add(content: dict) -> dict | None:
            files = dict(content.get("files", {}))
            taken[:] = [f for f in new if files.get(f, {}).get("mark") != seen[f]]
            if not taken:
                return None
            files.update({f: {"mark": seen[f], "delivery": delivery} for f in taken})
            return {"files": files}

        self.manifest.update(add)
        return taken

    # ---------------------------------------------------------- panels

    def files(self) -> dict[str, str]:
        """{file that counts: its delivery}."""
        return {f: x["delivery"] for f, x in self.manifest.current()[1].get("files", {}).items()}

    def partials(self) -> DataFrame:
        """Sums and counts per (file, region, hour) of the files that count."""
        files = self.files()
        if not files:
            raise LookupError("nothing has been delivered")
        # one row per file
        counting = self.spark.createDataFrame(sorted(files.items()), "file string, delivery string")
        found = self.spark.read.parquet(*[f"{self.root}/partials/{d}" for d in sorted(set(files.values()))])
        return found.join(counting, ["file", "delivery"], "left_semi")

    def hourly(self) -> DataFrame:
        """Region hourly panel: the mean over all stations, wherever their rows came from."""
        parts = self.partials()
        measures = [c[:-5] for c in parts.columns if c.endswith("__sum")]
        n = {c: F.sum(f"{c}__n") for c in measures}
        return parts.groupBy("dept_id", "datetime").agg(*[
            F.when(n[c] > 0, F.sum(f"{c}__sum") / n[c]).alias(c) for c in measures])

    def daily(self) -> DataFrame:
        """Region daily panel by the daily rules."""
        return daily_from_hourly(self.hourly())

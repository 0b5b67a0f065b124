"""Shared helpers of the training-data operators.

Row identity. Operators that come back to a document later (joins of per-document
findings with the texts) identify it by ``(_d, _t)``: the doc_id (0 where null) and a
64-bit hash of doc_id nullness and text. Rows that repeat both doc_id and text are one
document and get the same result; rows sharing only the doc_id stay apart.
"""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from harvestlens.session import scratch

# Word rule of the contracts: a word is a run of digits, lower-case ASCII letters and
# non-ASCII characters, after A-Z were lower-cased.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

KEY = ["_d", "_t"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_key(doc_id="doc_id", text="text") -> list[Column]:
    """The two identity columns (see the module text)."""
    d, t = F.col(doc_id), F.col(text)
    return [F.coalesce(d.cast("long"), F.lit(0).cast("long")).alias("_d"),
            F.xxhash64(d.isNull(), t.isNull(), t).alias("_t")]


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """``_d, _t`` and the named columns only: extra columns can't clash."""
    return docs.select(*doc_key(), *columns)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of the text's words; null text has none."""
    parts = F.split(F.concat(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(" ")), NOT_WORD)
    # a text that starts with a separator yields one leading empty part, and the
    # appended blank always yields a trailing one
    return F.when(F.element_at(parts, 1) == "", F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0)))) \
        .otherwise(F.slice(parts, 1, F.size(parts) - 1))


# Spark removes a write's shuffle files as soon as the write has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, conf: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage is cut, a lost
    executor's part is read again instead of being computed again, and the shuffles below
    it are freed. Meant for tables used more than once or at the end of a long step.
    ``conf`` holds while it is written."""
    spark = df.sparkSession
    path = scratch(spark, "llm")
    conf = {_CLEANUP: "true"} | (conf or {})
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors (Spark distributes the archive), so that Python
    workers can import it wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    files = sorted(root.rglob("*.py"))
    mark = hashlib.sha1(b"".join(f.read_bytes() for f in files)).hexdigest()[:12]
    archive = Path(tempfile.mkdtemp()) / f"{root.name}-{mark}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in files:
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def map_texts(docs: DataFrame, start, fields: list[tuple[str, str]], returned: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` as struct ``doc`` (of all columns, or those ``returned``) beside
    the columns ``fields`` (name, type) of what ``start()`` makes of each text.

    ``start`` runs once a task and returns a function from a text (or None) to a tuple. Each
    text goes to Python once, in slices of few rows, so that results of long texts do not
    pile up."""
    names = returned if returned is not None else docs.columns
    send = docs if returned is None else docs.select(*names, *[c for c in ["text"] if c not in names])
    at = send.columns.index("text")
    schema = T.StructType([T.StructField("doc", T.StructType([send.schema[n] for n in names])),
                           *[T.StructField(n, T._parse_datatype_string(t)) for n, t in fields]])
    types = [to_arrow_type(f.dataType) for f in schema.fields[1:]]

    def run(batches):
        of = start()
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows = [of(t.as_py()) for t in part.column(at)]
                doc = pa.StructArray.from_arrays([part.column(i) for i in range(len(names))], names)
                yield pa.RecordBatch.from_arrays(
                    [doc, *[pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]],
                    ["doc", *[n for n, _ in fields]])

    return map_arrow(send, run, schema)

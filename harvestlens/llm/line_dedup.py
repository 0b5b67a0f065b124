"""Operator 1: line dedup by overlapping three-line windows.

Every run of three consecutive lines is hashed; a window that occurs more than once in
the corpus keeps its first occurrence (lowest doc_id, then lowest line) and loses the
later ones. The lines covered by lost windows are merged per document and cut out.

Only built-in columns are used. What is shuffled per window is two hashes and a position;
texts move once, to meet the covered positions of their document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KEY, doc_key, read_table

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _windows(lines: Column, size: int) -> Column:
    """(h1, h2, pos) of every window that holds something besides white space."""
    def one(i: Column) -> Column:
        part = [F.get(lines, i + k) for k in range(size)]
        return F.struct(F.xxhash64(*part).alias("h1"),
                        F.xxhash64(F.lit(size), *reversed(part)).alias("h2"),
                        i.cast("int").alias("pos"),
                        (F.trim(F.concat_ws("", *part)) == "").alias("blank"))
    every = F.transform(F.sequence(F.lit(0), F.size(lines) - size), one)
    return F.when(F.size(lines) >= size, F.filter(every, lambda w: ~w["blank"]))


def repeated_windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(_d, _t, pos) of every window occurrence that is not its window's first."""
    found = (docs.filter(F.col("text").contains("\n"))
             .select(*doc_key(), F.col("doc_id").isNull().alias("_n"), _lines(F.col("text")).alias("_l"))
             .select(*KEY, "_n", F.inline(_windows(F.col("_l"), size))).drop("blank"))
    place = F.struct("_n", *KEY, "pos")
    # min and count combine in the map tasks, so a window in a third of all documents is
    # a few rows by the time it is shuffled
    firsts = (found.groupBy("h1", "h2").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_c"))
              .filter("_c > 1").select("h1", "h2", "_first"))
    return (found.join(firsts, ["h1", "h2"]).filter(place != F.col("_first"))
            .select(*KEY, "pos"))


def _kept_lines(lines: Column, starts: Column, size: int) -> Column:
    """The lines outside the merged runs [start, start + size): between one start and the
    next lies a gap or none, so the work is linear in the number of lines."""
    n = F.size(starts)

    def gap(i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0)).otherwise(F.get(starts, i - 1) + size)
        end = F.when(i == n, F.size(lines)).otherwise(F.get(starts, i))
        return F.slice(lines, begin + 1, F.greatest(end - begin, F.lit(0)))

    return F.flatten(F.transform(F.sequence(F.lit(0), n), gap))


def line_dedup(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Remove later occurrences of repeated windows of ``size`` lines.

    Returns the columns of ``docs`` with ``text`` replaced, inside one struct column
    ``doc`` (so extra columns can't clash), and n_lines, n_removed (int).

    Lines are split at newline only and compared exactly. Windows of blank lines count as
    no window. Documents of fewer than ``size`` lines and the empty text stay as they are;
    null text stays null with 0 lines. A document all of whose lines go gets the empty
    text. Rows that repeat doc_id and text are one document and fare alike; documents with null
    doc_id come last in order. Occurrences overlap freely, in one document too. A very
    long text is one row, its windows many; an empty table stays empty.
    """
    hits = (repeated_windows(docs, size).groupBy(*KEY)
            .agg(F.sort_array(F.collect_set("pos")).alias("_starts")))
    rows = docs.select(*doc_key(), F.struct("*").alias("doc")).join(hits, KEY, "left")
    lines, starts = _lines(F.col("doc.text")), F.col("_starts")
    kept = rows.withColumn("_kept", F.when(starts.isNotNull(), _kept_lines(lines, starts, size)))
    text = F.when(F.col("_kept").isNull(), F.col("doc.text")).otherwise(F.array_join("_kept", "\n"))
    n_lines = F.when(F.col("doc.text").isNull(), 0).otherwise(F.size(lines))
    return kept.select(
        F.col("doc").withField("text", text).alias("doc"), n_lines.alias("n_lines"),
        F.when(F.col("_kept").isNull(), 0).otherwise(n_lines - F.size("_kept")).alias("n_removed"))


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, text (what is left) for every document."""
    out = line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc.doc_id", "n_lines", "n_removed", "doc.text")


# {docs} must have doc_id, text
LINE_DEDUP_SQL = """
lines as (select doc_id, string_split(text, chr(10)) as l from {docs} where text is not null),
windows as (
  select doc_id, i as pos, [l[i + 1], l[i + 2], l[i + 3]] as w
  from (select doc_id, l, unnest(range(len(l) - 2)) as i from lines where len(l) >= 3)
  where trim(concat(l[i + 1], l[i + 2], l[i + 3]), ' ') <> ''),
later as (
  select doc_id, pos from (
    select doc_id, pos, row_number() over (partition by w order by doc_id, pos) as k from windows)
  where k > 1),
covered as (select distinct doc_id, pos + k as line from later, (values (0), (1), (2)) o(k)),
left_over as (
  select x.doc_id, string_agg(x.line, chr(10) order by x.i) as text, count(*) as n
  from (select doc_id, generate_subscripts(l, 1) - 1 as i, unnest(l) as line from lines) x
  left join covered c on c.doc_id = x.doc_id and c.line = x.i
  where c.doc_id is null group by x.doc_id)"""

ORACLE = "with " + LINE_DEDUP_SQL.format(docs="documents") + """
select d.doc_id, coalesce(len(l.l), 0)::int as n_lines,
       (coalesce(len(l.l), 0) - coalesce(o.n, 0))::int as n_removed,
       case when d.text is null then null else coalesce(o.text, '') end as text
from documents d left join lines l using (doc_id) left join left_over o using (doc_id)"""

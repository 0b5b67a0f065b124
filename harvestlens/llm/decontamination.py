"""Operator 7: benchmark decontamination with a positional inverted index.

1. Count the benchmark's terms in the training texts (one pass, combined in the map tasks).
2. Of every window of ``size`` consecutive item words take the two rarest terms; store the
   training postings (term, document, position) of those terms as the index.
3. Shift each posting by its term's place in the item: two postings with the same
   (document, item, shift) lie as they do in the item. Windows whose two rarest terms meet
   on a shift are candidates; terms that meet on shifts at most ``slop`` apart are
   proximity matches.
4. Compare the candidates' words exactly and merge the covered positions per document.

Only built-in columns are used. Benchmark-sided tables are broadcast only after their rows
have been counted; larger ones go through ordinary joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY, doc_key, materialize, read_table, words

SIZE = 10
SLOP = 3
BROADCAST_ROWS = 200_000
NEAR = "struct<start:int,words:int,item_id:string,item:long>"


def _bounded(df: DataFrame) -> DataFrame:
    """Hint a broadcast if the (materialized) table is small; else leave the join to Spark."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def item_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(item, item_id, s, win) for every window of every item; item tells rows apart."""
    items = (benchmark.select(F.xxhash64("item_id", "text").alias("item"),
                              F.col("item_id").cast("string").alias("item_id"),
                              words(F.col("text")).alias("w"))
             .filter(F.size("w") > 0).dropDuplicates(["item"]))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    return (items.select("item", "item_id", "w", F.explode(starts).alias("s"))
            .select("item", "item_id", "s", F.slice("w", F.col("s") + 1, size).alias("win")))


def _postings(docs: DataFrame, terms: DataFrame, *keys) -> DataFrame:
    """Places of the given terms in the documents, found where the documents lie."""
    places = docs.select(*keys, F.posexplode(words(F.col("text"))).alias("pos", "term"))
    return places.join(terms, "term")


def rarest_terms(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``windows`` that can occur, with the offsets of their two rarest terms (``a1``,
    and ``a2`` unless the window has one word)."""
    tokens = windows.select("item", "s", F.posexplode("win").alias("o", "term"))
    terms = materialize(tokens.select("term").distinct())
    seen = _postings(docs, _bounded(terms)).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    ranked = (tokens.join(seen, "term").groupBy("item", "s")
              .agg(F.sort_array(F.collect_list(F.struct("n", "o"))).alias("r")))
    return (windows.join(ranked, ["item", "s"]).filter(F.size("r") == F.size("win"))
            .select("item", "item_id", "s", "win", F.col("r")[0]["o"].alias("a1"),
                    F.get("r", F.lit(1))["o"].alias("a2")))


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, slop: int = SLOP
                      ) -> DataFrame:
    """Per document with any: ``_d, _t``, candidates (array of start, win, item_id) to be
    compared with its words, and near (array of start, words, item_id, item: the proximity
    matches)."""
    windows = materialize(rarest_terms(docs, materialize(item_windows(benchmark, size))))
    win = _bounded(windows)
    names = materialize(windows.select("item", "item_id").distinct())
    places = materialize(
        windows.select("item", F.explode(F.array_compact(F.array("a1", "a2"))).alias("o"), "s", "win")
        .select("item", (F.col("s") + F.col("o")).alias("j"), F.get("win", F.col("o")).alias("term"))
        .distinct())
    anchors = _bounded(materialize(places.select("term").distinct()))
    index = materialize(_postings(docs, anchors, *doc_key()))
    shifted = index.join(_bounded(places), "term").select(
        *KEY, "item", (F.col("pos") - F.col("j")).alias("shift"), "j")
    # one exchange by (document, item) serves the grouping and the neighbourhoods
    aligned = (shifted.repartition(*KEY, "item").groupBy(*KEY, "item", "shift")
               .agg(F.sort_array(F.collect_set("j")).alias("js")))
    # all places of the item met on this shift and the next ``slop``: at most the item's
    # places for each shift, however long the document
    order = Window.partitionBy(*KEY, "item").orderBy("shift").rangeBetween(0, slop)
    aligned = aligned.withColumn("close", F.collect_list(F.struct("shift", "js")).over(order))

    def matches(j):
        """Spans from the posting of place j to those of other places of a window; the
        same word of the document is no second posting."""
        here = F.col("shift") + j
        return F.flatten(F.transform("close", lambda r: F.transform(
            F.filter(r["js"], lambda k: (k != j) & (F.abs(k - j) < size) & (r["shift"] + k != here)
                     & ((r["shift"] > F.col("shift")) | (k > j))),
            lambda k: F.struct(F.least(here, r["shift"] + k).cast("int").alias("start"),
                               (F.abs(r["shift"] + k - here) + 1).cast("int").alias("words")))))

    several = (F.size("close") > 1) | (F.size("js") > 1)
    pairs = F.when(several, F.array_distinct(F.flatten(F.transform("js", matches))))
    aligned = aligned.withColumn("pairs", pairs).drop("close")

    def met(offset: str):
        return F.array_contains("js", F.col("s") + F.col(offset))

    found = (aligned.join(win, "item").filter(met("a1") & (F.col("a2").isNull() | met("a2")))
             .select(*KEY, F.struct((F.col("shift") + F.col("s")).alias("start"), "win", "item_id").alias("c"),
                     F.lit(None).cast(NEAR).alias("near")))
    near = (aligned.filter(F.size("pairs") > 0).join(_bounded(names), "item")
            .select(*KEY, F.explode("pairs").alias("p"), "item", "item_id")
            .select(*KEY, F.lit(None).cast(found.schema["c"].dataType).alias("c"),
                    F.struct("p.start", "p.words", "item_id", "item").alias("near")))
    return (found.union(near).groupBy(*KEY)
            .agg(F.collect_list("c").alias("candidates"), F.collect_set("near").alias("near")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, slop: int = SLOP) -> DataFrame:
    """Find the item windows that occur in each document.

    Returns struct ``doc`` (the columns of ``docs``), n_words, n_hit (words inside an
    occurrence), items (ids with occurring windows, as strings, sorted), spans (array of
    start, words, item_id: the exact phrase matches), n_near (items with a proximity match:
    two rare terms of one window in place to within ``slop`` words) and near_spans (array
    of start, words, item_id: from the one term to the other of every such match).

    Null and empty texts have no words; items without words have no window, an item of
    fewer than ``size`` words is one window. An item with null id takes part but has no
    id to list. Repeated benchmark rows count once; repeated documents fare alike. With
    an empty benchmark nothing is hit. Very long texts are one row whose words are exploded;
    an empty table stays empty.
    """
    matches = benchmark_matches(docs, benchmark, size, slop)
    rows = docs.select(*doc_key(), F.struct("*").alias("doc")).join(matches, KEY, "left")
    rows = rows.withColumn("w", words(F.col("doc.text")))
    exact = F.filter("candidates", lambda c: (c["start"] >= 0) & (
        F.slice("w", F.greatest(c["start"], F.lit(0)) + 1, F.size(c["win"])) == c["win"]))
    rows = rows.withColumn("spans", F.coalesce(F.sort_array(F.transform(exact, lambda c: F.struct(
        c["start"].cast("int").alias("start"), F.size(c["win"]).alias("words"),
        c["item_id"].alias("item_id")))), F.array().cast("array<struct<start:int,words:int,item_id:string>>")))

    def merge(acc, s):  # spans come sorted by start
        until = s["start"] + s["words"]
        new = F.greatest(until - F.greatest(s["start"], acc["until"]), F.lit(0))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(until, acc["until"]).alias("until"))

    hit = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("until")), merge)["n"]
    ids = F.array_sort(F.array_compact(F.array_distinct(F.col("spans.item_id"))))
    return rows.select("doc", F.size("w").cast("long").alias("n_words"), hit.cast("long").alias("n_hit"),
                       ids.alias("items"), "spans",
                       F.when(F.col("near").isNull(), 0).otherwise(F.size(F.array_distinct(F.col("near.item"))))
                       .cast("long").alias("n_near"),
                       F.coalesce(F.array_sort(F.transform("near", lambda s: F.struct(
                           s["start"].alias("start"), s["words"].alias("words"), s["item_id"].alias("item_id")))),
                           F.array().cast("array<struct<start:int,words:int,item_id:string>>")).alias("near_spans"))


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return out.select("doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


# {docs} must have doc_id, text
MATCH_SQL = """
bench_words as (select item_id::varchar as item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
bench_windows as (
  select distinct item_id, w[s + 1:s + 10] as win
  from (select item_id, w, unnest(range(greatest(len(w) - 9, 1))) as s from bench_words where len(w) > 0)),
doc_words as (select doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) as w from {docs}),
sizes as (select distinct len(win) as n from bench_windows),
doc_windows as (
  select doc_id, p, n, w[p + 1:p + n] as win
  from (select doc_id, w, n, unnest(range(len(w) - n + 1)) as p from doc_words, sizes where len(w) >= n)),
hits as (select d.doc_id, d.p, d.n, b.item_id from doc_windows d join bench_windows b on d.win = b.win),
hit_words as (select doc_id, count(distinct p + k) as n_hit
  from (select doc_id, p, unnest(range(n)) as k from hits) group by doc_id),
hit_items as (select doc_id, count(distinct item_id) as n_items,
  string_agg(distinct item_id, ',' order by item_id) as ids from hits group by doc_id)"""

ORACLE = "with " + MATCH_SQL.format(docs="documents") + """
select d.doc_id, len(d.w)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit,
       coalesce(i.n_items, 0)::bigint as n_items, sha256(coalesce(i.ids, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 as contaminated
from doc_words d left join hit_words h using (doc_id) left join hit_items i using (doc_id)"""

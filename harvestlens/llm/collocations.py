"""Operator 13: collocations of two to five words, counted in quotient filters.

Words that occur often enough get ids, so that an n-gram packs into a few machine words.
Each task counts its n-grams into counting quotient filters (``quotient_filter``), one per
shard of the permuted key space; the filters of a shard are then merged. The permutation
spreads any n-grams evenly over the shards, and a task sends each distinct n-gram once, so
a very frequent one weighs no more than others.

A phrase can only reach the least count if its words and parts do. An n-gram is therefore
counted only where both its parts of one word less may be frequent, as a bitmap of a fixed
number of slots says: slots shared by chance cost some counting, never a result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import quotient_filter as qf
from .common import map_arrow, materialize, read_table, ship
from .ranks import rank_in_cells

LEAST, LONGEST, TOP = 100, 5, 2000
# The dictionary sent to all tasks holds at most so many words; others get ids by a join.
SENT_WORDS = 200_000
SLOT_BITS = 26          # of the membership bitmap (8 MB)
PER_SHARD = 1 << 19     # occurrences that a shard stands for
AT_ONCE = 1 << 18       # n-grams permuted at once
IN_TASK = 1 << 19       # distinct n-grams that a task holds before it sends its filters
FLUSH_WORDS, FLUSH_BYTES = 100_000, 24_000_000
UNKNOWN_LANG = "und"

# A-Z to lower case, the piece separators to line feeds, tab to blank
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t",
                         b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" ")


def tokens(text: str | None) -> list[bytes]:
    """Words as UTF-8, with line feeds where a piece ends."""
    if not text:
        return []
    return [w for w in text.encode().translate(_BYTES).replace(b"\n", b" \n ").split(b" ") if w]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
                       F.col("text").cast("string").alias("text"))


def word_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, word, c): words that occur ``least`` times in their language, and under a null
    word the number of all words of the language."""

    def count(batches):
        counts, size = {}, 0

        def out():
            rows = [(lang, w, c) for (lang, w), c in counts.items()]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()),
                 pa.array([None if r[1] is None else r[1].decode() for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.int64())], ["lang", "word", "c"])

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang, found = lang.as_py(), tokens(text.as_py())
                total = 0
                for w in found:
                    if w == b"\n":
                        continue
                    total += 1
                    key = lang, w
                    n = counts.get(key)
                    if n is None:
                        size += len(w)
                        counts[key] = 1
                    else:
                        counts[key] = n + 1
                if total:
                    counts[lang, None] = counts.get((lang, None), 0) + total
                if len(counts) > FLUSH_WORDS or size > FLUSH_BYTES:
                    yield out()
                    counts, size = {}, 0
        yield out()

    return (map_arrow(_texts(docs), count, "lang string, word string, c long")
            .groupBy("lang", "word").agg(F.sum("c").alias("c")).filter((F.col("c") >= least) | F.col("word").isNull()))


def vocabulary(counts: DataFrame) -> DataFrame:
    """(lang, word, c, id): ids from 1 without gaps."""
    cells = 64
    words = counts.filter("word is not null").withColumn("_cell", F.pmod(F.xxhash64("lang", "word"), F.lit(cells)).cast("int"))
    ranked, sizes = rank_in_cells(words, "_cell", [F.col("lang"), F.col("word")])
    n = {r["_cell"]: r["_n"] for r in sizes.collect()}  # one row per cell
    before = F.array(*[F.lit(sum(n.get(c, 0) for c in range(k))).cast("long") for k in range(cells)])
    return ranked.select("lang", "word", "c", (before[F.col("_cell")] + F.col("_rank") + 1).alias("id"))


def _sent(vocab: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The most frequent words, at most ``most``, and the rest. The cut is a count, found
    from a histogram of counts to two digits (a few hundred rows)."""
    step = F.pow(F.lit(10.0), F.greatest(F.floor(F.log10("c")) - 1, F.lit(0))).cast("long")
    grouped = vocab.withColumn("_g", (F.col("c") / step).cast("long") * step)
    cut, total = 0, 0
    for r in sorted(grouped.groupBy("_g").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["_g"]):
        total += r["n"]
        if total > most:
            cut = r["_g"] + 1  # this group and those below it stay behind
            break
    top = grouped.filter(F.col("_g") >= cut).drop("_g")
    return top, grouped.filter(F.col("_g") < cut).drop("_g")


def encode(docs: DataFrame, vocab: DataFrame, sent_words: int = SENT_WORDS) -> DataFrame:
    """(ids): one array per text, 0 where a piece ends or a word is not in ``vocab``."""
    top, rest = _sent(vocab, sent_words)
    spark = docs.sparkSession
    words: dict[str, dict[bytes, int]] = {}
    for r in top.select("lang", "word", "id").collect():  # at most sent_words rows
        words.setdefault(r["lang"], {})[r["word"].encode()] = r["id"]
    ship(spark)
    known = spark.sparkContext.broadcast(words)
    some_rest = len(rest.take(1)) > 0

    def run(batches):
        for batch in batches:
            langs, ids, places, missing = [], [], [], []
            for lang, text in zip(batch.column(0), batch.column(1)):
                found, own = tokens(text.as_py()), known.value.get(lang.as_py(), {})
                langs.append(lang.as_py())
                ids.append(np.array([own.get(w, 0) for w in found] + [0], np.int32))
                at = [i for i, (w, n) in enumerate(zip(found, ids[-1])) if not n and w != b"\n"] if some_rest else []
                places.append(at)
                missing.append([found[i].decode() for i in at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(ids, pa.list_(pa.int32())), pa.array(places, pa.list_(pa.int32())),
                 pa.array(missing, pa.list_(pa.string()))], ["lang", "ids", "places", "missing"])

    coded = map_arrow(_texts(docs.filter("text is not null")), run,
                      "lang string, ids array<int>, places array<int>, missing array<string>")
    if not some_rest:
        return coded.select("ids")
    coded = materialize(coded.withColumn("_row", F.monotonically_increasing_id()))
    found = (coded.select("_row", "lang", F.explode(F.arrays_zip("places", "missing")).alias("m"))
             .select("_row", "lang", F.col("m.places").alias("at"), F.col("m.missing").alias("word"))
             .join(rest.select("lang", "word", "id"), ["lang", "word"])
             .groupBy("_row").agg(F.collect_list(F.struct("at", F.col("id").cast("int").alias("id"))).alias("more")))

    def patch(batches):
        for batch in batches:
            out = []
            for ids, more in zip(batch.column(0), batch.column(1)):
                ids = np.array(ids.values, np.int32)
                for m in more.as_py() or []:
                    ids[m["at"]] = m["id"]
                out.append(ids)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int32()))], ["ids"])

    return map_arrow(coded.join(found, "_row", "left").select("ids", "more"), patch, "ids array<int>")


def _grams(v: np.ndarray, size: int) -> list[np.ndarray]:
    n = len(v) - size + 1
    return [v[k:n + k] for k in range(size)]


def frequent_grams(coded: DataFrame, size: int, bits: int, shard_bits: int, likely: bytes | None,
                   least: int = LEAST) -> DataFrame:
    """(ids, slot, f) of the n-grams of ``size`` ids that occur ``least`` times.

    likely: bitmap of the frequent n-grams of one word less (None: any)."""
    w = qf.widths(size, bits)
    shard_bits = min(shard_bits, w[0])
    ship(coded.sparkSession)
    shared = coded.sparkSession.sparkContext.broadcast(likely)

    def starts(v):
        ok = np.logical_and.reduce([x != 0 for x in _grams(v, size)])
        if shared.value is not None:
            part = _grams(v, size - 1)
            at = np.flatnonzero(np.logical_and.reduce([x != 0 for x in part]))
            slot = qf.slots(qf.permute([x[at] for x in part], bits), SLOT_BITS)
            bitmap = np.frombuffer(shared.value, np.uint8)
            maybe = np.zeros(len(part[0]), bool)
            maybe[at] = (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1
            ok &= maybe[:-1] & maybe[1:]
        return np.flatnonzero(ok)

    def filters(lanes, counts):
        shard = (lanes[0] >> np.uint64(w[0] - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(counts), np.int64)
        edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
        ends = np.append(edges[1:], len(shard))
        blobs = [qf.encode([x[a:b] for x in lanes], counts[a:b], w, shard_bits) for a, b in zip(edges, ends)]
        return pa.RecordBatch.from_arrays([pa.array(shard[edges], pa.int64()), pa.array(blobs, pa.binary())], ["shard", "filter"])

    def count(batches):
        held, n = [], 0

        def add_up():
            lanes = [np.concatenate([h[0][i] for h in held]) for i in range(len(w))]
            return qf.summed(lanes, np.concatenate([h[1] for h in held]), w)

        for batch in batches:
            col = batch.column(0)
            v = np.asarray(col.flatten())
            for a in range(0, max(len(v) - size + 1, 0), AT_ONCE):  # every text ends in a 0
                part = v[a:a + AT_ONCE + size - 1]
                at = starts(part)
                lanes, counts = qf.summed(qf.permute([x[at] for x in _grams(part, size)], bits), None, w)
                held.append((lanes, counts))
                n += len(counts)
                if n > IN_TASK:
                    held = [add_up()]
                    n = len(held[0][1])
                    if n > IN_TASK // 2:
                        yield filters(*held[0])
                        held, n = [], 0
        if n:
            yield filters(*add_up())

    def merge(key, table):
        shard = key[0].as_py()
        lanes, f = qf.merged(table.column("filter").to_pylist(), w, shard, shard_bits)
        often = f >= least
        lanes, f = [x[often] for x in lanes], f[often]
        ids = np.stack([x.astype(np.int32) for x in qf.unpermute(lanes, size, bits)], axis=1).reshape(-1)
        return pa.table([pa.ListArray.from_arrays(pa.array(np.arange(0, len(ids) + 1, size, dtype=np.int32)), pa.array(ids)),
                         pa.array(qf.slots(lanes, SLOT_BITS)), pa.array(f, pa.int64())], names=["ids", "slot", "f"])

    return (map_arrow(coded, count, "shard long, filter binary").groupBy("shard")
            .applyInArrow(merge, "ids array<int>, slot long, f long"))


def slot_bitmap(grams: DataFrame) -> bytes:
    """2^SLOT_BITS bits, those of the n-grams' slots set: a fixed size, whatever the table."""
    at = F.col("slot") + 1  # Spark's bitmaps count from 1
    pieces = grams.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    size = 4096  # bytes of one of Spark's bitmaps
    out = bytearray(max(1 << (SLOT_BITS - 3), size))
    for r in pieces:
        out[(r["b"] - 1) * size:r["b"] * size] = r["bits"]
    return bytes(out)


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, sent_words: int = SENT_WORDS,
            per_shard: int = PER_SHARD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts, vocabulary, n-grams): all words and phrases of at most ``longest`` words with
    at least ``least`` occurrences; n-grams as (ids, f), single words included."""
    spark = docs.sparkSession
    counts = materialize(word_counts(docs, least))
    vocab = materialize(vocabulary(counts))
    size, total = vocab.count(), counts.filter("word is null").agg(F.sum("c")).first()[0] or 0
    bits = max(1, size.bit_length())
    if bits > 32:
        raise ValueError("ids of more than 32 bits do not fit the lanes; raise the least count")
    one = vocab.select(F.array(F.col("id").cast("int")).alias("ids"), F.col("c").alias("f"))
    if size == 0:
        return counts, vocab, one
    shard_bits = max(0, (total // per_shard).bit_length())
    coded = materialize(encode(docs, vocab, sent_words))
    tables, likely = [one], None
    for n in range(2, longest + 1):
        grams = materialize(frequent_grams(coded, n, bits, shard_bits, likely, least))
        tables.append(grams.select("ids", "f"))
        if n < longest:
            likely = slot_bitmap(grams)
    return counts, vocab, materialize(reduce(DataFrame.union, tables))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 sent_words: int = SENT_WORDS, per_shard: int = PER_SHARD) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score, as the
    contract has them. Null text has no words, null lang is ``und``; very long texts are
    read whole (four bytes a word once encoded); repeated rows count again; without
    documents there is no row. Ties in rank are settled by the phrase."""
    spark = docs.sparkSession
    counts, vocab, grams = phrases(docs, least, longest, sent_words, per_shard)
    size = F.size("ids")
    candidates = grams.filter(size >= 2)
    # inside a longer candidate that is as frequent
    inner = F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), size - 1),
        lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.slice("ids", i, m)))))
    longer = candidates.filter(size >= 3).select(inner.alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("_longer"))
    kept = candidates.join(longer, "ids", "left").filter("_longer is null or 100 * _longer < 100 * f").select("ids", F.col("f").alias("a"))
    cuts = kept.select("ids", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("ids", F.lit(1), F.col("k")).alias("_l"),
                       F.slice("ids", F.col("k") + 1, size - F.col("k")).alias("_r"))
    left = grams.select(F.col("ids").alias("_l"), F.col("f").alias("l"))
    right = grams.select(F.col("ids").alias("_r"), F.col("f").alias("r"))
    # the language is that of the first word; a language's n goes with it
    n = counts.filter("word is null").select("lang", F.col("c").alias("n"))
    first = vocab.join(n, "lang").select(F.col("id").cast("int").alias("_first"), "lang", "n")
    big = "cast({} as decimal(19,0))".format
    score = F.expr(f"(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div ({big('l')} * {big('r')})")
    scored = (cuts.join(left, "_l").join(right, "_r").withColumn("_first", F.col("ids")[0]).join(first, "_first")
              .withColumn("score", score)
              .groupBy("ids", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
              .select("ids", "lang", "a", "n", "best.l", "best.r", "best.score"))
    # the few that can be listed, ties at the end included, get their words
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = materialize(scored.withColumn("_k", F.rank().over(by_score)).filter(F.col("_k") <= top).drop("_k"))
    named = (near.select("ids", F.posexplode("ids").alias("_p", "id")).join(vocab.select("id", "word"), "id")
             .groupBy("ids").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_p", "word"))),
                                                          lambda x: x["word"]), " ").alias("phrase")))
    by_rank = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (near.join(named, "ids").withColumn("rank", F.row_number().over(by_rank).cast("long"))
            .filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\x09]+'), lambda x: x <> '') AS words FROM p),
n AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(words) - m + 2), lambda i: words[i:i + m - 1])) AS ids
  FROM w, range(1, {LONGEST + 1}) t(m)),
f AS (SELECT lang, m, ids, count(*) AS f FROM g GROUP BY lang, m, ids HAVING count(*) >= {LEAST}),
inner_ AS (SELECT f.lang, f.ids[i:i + k - 1] AS ids, max(f.f) AS longer
  FROM f, range(2, {LONGEST}) a(k), range(1, {LONGEST + 1}) b(i) WHERE k < f.m AND i + k - 1 <= f.m GROUP BY 1, 2),
kept AS (SELECT f.lang, f.m, f.ids, f.f AS a FROM f LEFT JOIN inner_ i USING (lang, ids)
  WHERE f.m >= 2 AND (i.longer IS NULL OR 100 * i.longer < 100 * f.f)),
cut AS (SELECT k.lang, k.ids, k.a, c.k, l.f AS l, r.f AS r, n.n,
    (1000::HUGEINT * k.a * n.n // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM kept k JOIN range(1, {LONGEST}) c(k) ON c.k < k.m JOIN n USING (lang)
  JOIN f l ON l.lang = k.lang AND l.ids = k.ids[1:c.k] JOIN f r ON r.lang = k.lang AND r.ids = k.ids[c.k + 1:k.m]),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, ids ORDER BY score, k) AS o FROM cut),
ranked AS (SELECT lang, array_to_string(ids, ' ') AS phrase, a, l, r, n, score FROM best WHERE o = 1)
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score FROM ranked) WHERE rank <= {TOP}
"""

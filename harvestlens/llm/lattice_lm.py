"""Operator 6: document log-probability under a unigram model over subword lattices.

The pieces of an existing vocabulary are the edges of a lattice over each word (marked by
its leading word sign), a character without a piece going by its bytes. A document's
probability is the sum over all segmentations of the product of the pieces' probabilities,
and the end mark's. No piece reaches over white space, so the sum factors into words, and
the forward recursion is run once per distinct word of the corpus.

1. Count every word of the training documents (combined per batch, then by key).
2. Probabilities: how often each piece occurs when the vocabulary's own tokenizer segments
   those words, add-one smoothed, the end mark among them.
3. Lattice probability of every distinct word, held-out words too.
4. Documents add up their words: the most frequent words (a bounded table) where the
   texts lie, the others through a join by word. So no word is too frequent for the join
   and no table that grows with the corpus is broadcast.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, materialize, read_table
from .language_id import held_out

HOT_WORDS = 150_000
WORD_SIGN = "▁"


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def tokens(text: str | None) -> list[bytes]:
    """Words between runs of ASCII white space (bytes.split's), A-Z lower-cased."""
    return (text or "").encode().lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(token, c): every word of all documents, with its count in the training ones (column
    ``train``); 0 for words of held-out documents only."""
    def run(batches):
        for batch in batches:
            seen: Counter = Counter()
            for text, train in zip(batch.column(0), batch.column(1).to_pylist()):
                words = tokens(text.as_py())
                seen.update(words if train else dict.fromkeys(words, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["token", "c"])

    found = map_arrow(docs.select("text", "train"), run, "token binary, c long")
    return found.groupBy("token").agg(F.sum("c").alias("c"))


def piece_counts(words: DataFrame, vocabulary: str | None = None) -> dict[int, int]:
    """How often each piece id occurs in the counted words, segmented by the tokenizer; a
    table bounded by the vocabulary."""
    def run(batches):
        sp = _tokenizer(vocabulary or vocabulary_path())
        total = np.zeros(sp.get_piece_size(), dtype=np.int64)
        for batch in batches:
            texts = [b.decode() for b in batch.column(0).to_pylist()]
            ids = sp.encode(texts, num_threads=1)
            times = np.repeat(batch.column(1).to_numpy(), [len(x) for x in ids])
            flat = np.fromiter((i for x in ids for i in x), dtype=np.int64, count=len(times))
            np.add.at(total, flat, times)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["piece", "n"])

    found = map_arrow(words.filter("c > 0").select("token", "c"), run, "piece long, n long")
    return {r["piece"]: r["n"] for r in found.groupBy("piece").agg(F.sum("n").alias("n")).collect()}


class Lattice:
    """Piece probabilities and the forward recursion over a word's characters."""

    def __init__(self, counts: dict[int, int], n_ends: int, vocabulary: str):
        sp = _tokenizer(vocabulary)
        normal, byte = [], []
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                byte.append(i)
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                normal.append(i)
        total = sum(counts.get(i, 0) for i in normal + byte) + n_ends + len(normal) + len(byte) + 1
        self.piece = {sp.id_to_piece(i): (counts.get(i, 0) + 1) / total for i in normal}
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): (counts.get(i, 0) + 1) / total for i in byte}
        self.longest = max(map(len, self.piece), default=1)
        self.log10_end = math.log10((n_ends + 1) / total)

    def _by_bytes(self, char: str) -> float:
        p = 1.0
        for b in char.encode():
            p *= self.byte.get(b, 1e-9)
        return p

    def log10(self, word: str) -> float:
        """log10 of the summed probability of all segmentations of the word.

        The forward values are kept relative to a running log scale, so words of any
        length neither underflow nor overflow."""
        s = WORD_SIGN + word
        piece, longest = self.piece, self.longest
        ahead, scale = [1.0], 0.0
        for j in range(1, len(s) + 1):
            low = max(0, j - longest)
            base = j - len(ahead)   # place of ahead[0]
            total = 0.0
            for i in range(max(low, base), j):
                p = piece.get(s[i:j])
                if p is not None:
                    total += ahead[i - base] * p
            if s[j - 1] not in piece:
                total += ahead[-1] * self._by_bytes(s[j - 1])
            ahead.append(total)
            if len(ahead) > longest:
                ahead = ahead[-longest:]
            if total < 1e-100:
                ahead = [a / total for a in ahead]
                scale += math.log10(total)
        return math.log10(ahead[-1]) + scale


def score(docs: DataFrame, hot_words: int = HOT_WORDS, vocabulary: str | None = None) -> DataFrame:
    """Score all documents (columns doc_id, text, train), learning from those with train.

    Returns doc_id, n_tokens (words and the end), n_known (tokens counted in training),
    train_tokens, base_score (add-one unigram over whole words) and score (lattice), both
    log10 sums. Null and empty texts are the end alone. Repeated rows are each counted
    and each scored; without training documents all counts are 0. Very long texts are read
    whole, word by word; an empty table stays empty.
    """
    vocabulary = vocabulary or vocabulary_path()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "train")
    words = materialize(word_counts(docs))
    ends = docs.filter("train").count()
    stats = words.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    n = (stats["n"] or 0) + ends
    v = stats["v"] + (ends > 0)
    bottom = n + 1 * (v + 1)

    counts = piece_counts(words, vocabulary)
    lattice_args = (counts, ends, vocabulary)

    def lattices(batches):
        lattice = Lattice(*lattice_args)
        for batch in batches:
            value = [lattice.log10(b.decode()) for b in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(value, pa.float64())],
                                             ["token", "c", "lattice"])

    # per word: known, base term, lattice term
    scored = materialize(map_arrow(words, lattices, "token binary, c long, lattice double").select(
        "token", "c", F.log10((F.col("c") + 1) / F.lit(float(bottom))).alias("base"), "lattice"))

    # the highest count threshold that at most hot_words words pass, from a bounded histogram
    level = F.floor(F.log2(F.col("c") + 1) * 16).cast("int").alias("level")
    passed, lowest = 0, None
    for r in sorted(scored.groupBy(level).count().collect(), reverse=True):
        passed += r["count"]
        if passed > hot_words:
            break
        lowest = r["level"]
    is_hot = F.lit(False) if lowest is None else (level >= lowest)
    hot = {bytes(r["token"]): (int(r["c"] > 0), r["base"], r["lattice"])
           for r in scored.filter(is_hot).select("token", "c", "base", "lattice").collect()}
    table = docs.sparkSession.sparkContext.broadcast(hot)  # at most hot_words entries
    end = (int(ends > 0), math.log10((ends + 1) / bottom), Lattice(*lattice_args).log10_end)

    def add_up(batches):
        known_words = table.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            out = []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen = Counter(tokens(text.as_py()))
                known, base, lattice = end
                rest, times, size = [], [], 1
                for w, k in seen.items():
                    size += k
                    got = known_words.get(w)
                    if got is None:
                        rest.append(w)
                        times.append(k)
                    else:
                        known += k * got[0]
                        base += k * got[1]
                        lattice += k * got[2]
                out.append((row, d, size, known, base, lattice, rest, times))
                row += 1
            types = [pa.int64()] * 4 + [pa.float64()] * 2 + [pa.list_(pa.binary()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(types)],
                ["row", "doc_id", "n_tokens", "known", "b", "l", "rest", "times"])

    # row numbers are made once and read back with the table
    part = materialize(map_arrow(docs, add_up, "row long, doc_id long, n_tokens long, known long, b double, "
                                 "l double, rest array<binary>, times array<long>"))
    tail = part.select("row", F.inline(F.arrays_zip("rest", "times"))).select("row", F.col("rest").alias("token"), "times")
    more = (tail.join(scored.filter(~is_hot), "token").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known2"),
        F.sum(F.col("times") * F.col("base")).alias("b2"), F.sum(F.col("times") * F.col("lattice")).alias("l2")))
    zero = F.lit(0)
    return part.drop("rest", "times").join(more, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("known2", zero)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("b") + F.coalesce("b2", zero)).alias("base_score"),
        (F.col("l") + F.coalesce("l2", zero)).alias("score"))


def op6_lattice_lm(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = F.col("doc_id")
    scored = score(docs.withColumn("train", ~held_out(out, 7, 2)))
    return scored.select("doc_id", held_out(out, 7, 2).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")

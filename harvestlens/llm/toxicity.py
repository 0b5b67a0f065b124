"""Operator 11: toxicity of texts, read through their disguise.

A character model is counted over the whole corpus. Tokens that hold signs, long runs of
one letter or letters written apart are restored by it (``deobfuscate``), others stay. The
restored words are scored by what labelled texts say of them, of how they begin and of how
they end: a word's evidence is the best of these, and a text's score rests on its strongest
words.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import deobfuscate as de
from .common import map_arrow, map_texts, materialize, read_table, ship
from .language_id import held_out

# Bounds of the fit: labelled texts of each class (chosen by a hash of the id), features.
TOXIC_TEXTS, CLEAN_TEXTS, MOST_FEATURES = 4_000, 8_000, 50_000
LEAST_TOXIC = 4         # toxic texts that a feature must occur in
AFFIXES = (4, 5, 6)
STRONG = 2.0            # evidence from which a word counts as a hit
CUT = 0.7
_CACHED = 400_000       # tokens remembered by a worker


def character_model(docs: DataFrame) -> bytes:
    """Log probabilities of the corpus' character four-grams (a table of fixed size)."""

    def count(batches):
        total = np.zeros(de.CELLS, np.int64)
        held, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append(text.as_py() or "")
                size += len(held[-1])
                if size > 500_000:  # a line feed ends a word, so texts can be counted together
                    total += np.bincount(de.gram_cells("\n".join(held)), minlength=de.CELLS)
                    held, size = [], 0
        total += np.bincount(de.gram_cells("\n".join(held)), minlength=de.CELLS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["cell", "n"])

    cells = (map_arrow(docs.select(F.col("text").cast("string").alias("text")), count, "cell int, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())  # at most CELLS rows
    return de.log_probabilities(cells["cell"].to_numpy(), cells["n"].to_numpy().astype(float))


def text_words(text: str, restorer: de.Restorer, cache: dict, of) -> dict:
    """What ``of`` says (word, value pairs) of the distinct words of the restored text, in
    lower case. ``cache`` keeps what it said of a token."""
    low, found = text.lower(), {}
    runs = de.APART_LETTERS.findall(low)
    if runs:
        for run in set(runs):
            found.update(of(de.words_in(restorer.apart(run))))
        low = de.APART_LETTERS.sub(" ", low)
    for token in set(low.split()):
        said = cache.get(token)
        if said is None:
            if len(cache) >= _CACHED:
                cache.clear()
            said = cache[token] = of(restorer.words(token)) or _NOTHING
        if said is not _NOTHING:
            found.update(said)
    return found


_NOTHING: tuple = ()


def features(word: str) -> list[str]:
    """The word, its beginnings and its ends."""
    return [f"^{word}$", *[f"^{word[:k]}" for k in AFFIXES if len(word) > k],
            *[f"{word[-k:]}$" for k in AFFIXES if len(word) > k]]


def evidence(toxic: float, clean: float, toxic_texts: int, clean_texts: int) -> float:
    """Log ratio of the shares of toxic and clean texts with a feature, less one standard
    error: what rests on few texts counts little."""
    ratio = math.log((toxic + 0.5) / (toxic_texts + 1)) - math.log((clean + 0.5) / (clean_texts + 1))
    return ratio - math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def summary(strengths: list[float]) -> tuple[float, float, float]:
    """What a text is judged by: its strongest and second strongest word (none: 0) and the
    log of the number of strong ones."""
    top = sorted((s for s in strengths if s > 0), reverse=True)
    return (top[0] if top else 0.0, top[1] if len(top) > 1 else 0.0,
            math.log1p(sum(s >= STRONG for s in top)))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, text) of at most TOXIC_TEXTS and CLEAN_TEXTS labelled rows with a text; an id
    that several texts share stands for the one of the lowest hash."""
    by_class = labels.filter("doc_id is not null and toxic in (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    most = F.when(F.col("toxic") == 1, TOXIC_TEXTS).otherwise(CLEAN_TEXTS)
    counts = by_class.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()  # two rows
    n = F.create_map(*[F.lit(x) for r in counts for x in (r["toxic"], float(r["n"]))]) if counts else F.lit(None)
    h = F.xxhash64("doc_id")
    share = F.expr("shiftrightunsigned(_h, 11)") / F.lit(2.0 ** 53)
    near = by_class.withColumn("_h", h)
    if counts:  # rows that can't be among the lowest hashes of their class go before the ranking
        near = near.filter(share * n[F.col("toxic")] < 1.2 * most + 100)
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy("_h", "doc_id"))
    chosen = near.withColumn("_k", rank).filter(F.col("_k") <= most).select("doc_id", "toxic")
    texts = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # at most TOXIC_TEXTS + CLEAN_TEXTS ids
    return (texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic")
            .agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("toxic", "text"))


def fit(docs: DataFrame, labels: DataFrame, characters: bytes) -> dict:
    """Evidence of features and weights of the texts' summaries, from labelled rows.

    A text's summary in the fit leaves its own label out of every count. Without toxic or
    clean texts nothing is learned and every score is 0."""
    sample = materialize(labelled_sample(docs, labels))
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic_texts, clean_texts = n.get(1, 0), n.get(0, 0)
    if not toxic_texts or not clean_texts:
        return {"counts": {}, "texts": (toxic_texts, clean_texts), "weights": None}
    shared = docs.sparkSession.sparkContext.broadcast(characters)

    def count(batches):
        restorer, cache, found = de.Restorer(shared.value), {}, {}

        def out():
            rows = [(f, *c) for f, c in found.items()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.string(), pa.int64(), pa.int64()))], ["feature", "toxic", "clean"])

        for batch in batches:
            for toxic, text in zip(batch.column(0), batch.column(1)):
                seen = {f for w in text_words(text.as_py(), restorer, cache, lambda ws: tuple((w, None) for w in ws))
                        for f in features(w)}
                at = 0 if toxic.as_py() else 1
                for f in seen:
                    found.setdefault(f, [0, 0])[at] += 1
                if len(found) > _CACHED:
                    yield out()
                    found.clear()
        yield out()

    counted = (map_arrow(sample, count, "feature string, toxic long, clean long").groupBy("feature")
               .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
               .filter((F.col("toxic") >= LEAST_TOXIC) &
                       (F.col("toxic") / toxic_texts > F.col("clean") / clean_texts)))
    gap = F.col("toxic") / toxic_texts - F.col("clean") / clean_texts
    kept = counted.orderBy(gap.desc(), "feature").limit(MOST_FEATURES)
    counts = {r["feature"]: (r["toxic"], r["clean"]) for r in kept.collect()}  # at most MOST_FEATURES
    known = docs.sparkSession.sparkContext.broadcast(counts)

    def counts_of(words):
        hits = [(w, [known.value[f] for f in features(w) if f in known.value]) for w in words]
        return tuple(h for h in hits if h[1])

    def summaries(batches):
        restorer, cache = de.Restorer(shared.value), {}
        for batch in batches:
            rows = []
            for toxic, text in zip(batch.column(0), batch.column(1)):
                own = (1, 0) if toxic.as_py() else (0, 1)
                size = toxic_texts - own[0], clean_texts - own[1]
                best = []
                for hits in text_words(text.as_py(), restorer, cache, counts_of).values():
                    best.append(max(evidence(max(a - own[0], 0), max(b - own[1], 0), *size) for a, b in hits))
                rows.append((toxic.as_py(), *summary(best)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int32()] + [pa.float64()] * 3)],
                ["toxic", "first", "second", "hits"])

    x = map_arrow(sample, summaries, "toxic int, first double, second double, hits double").toArrow()  # the sample's rows
    x = np.column_stack([x[c].to_numpy() for c in ("first", "second", "hits", "toxic")]).astype(float)
    return {"counts": counts, "texts": (toxic_texts, clean_texts), "weights": logistic(x[:, :3], x[:, 3])}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> list[float]:
    """Weights (the constant first) of a logistic model, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def toxicity(docs: DataFrame, model: dict, characters: bytes, returned: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` as struct ``doc`` (of all columns, or those ``returned``) with
    score, predicted and strongest, the strongest word of restored text if it is a hit.

    Only the text is looked at. Null and empty texts have no words and get the score of a
    text without evidence; very long texts are read whole; repeated rows fare alike; an
    empty table stays empty. predicted is 1 from a score of 0.7 on."""
    ship(docs.sparkSession)
    strength = {f: s for f, c in model["counts"].items() if (s := evidence(*c, *model["texts"])) > 0}
    shared = docs.sparkSession.sparkContext.broadcast((strength, model["weights"], characters))

    def start():
        strength, weights, characters = shared.value
        restorer, cache = de.Restorer(characters), {}

        # features of a word begin with its first letters or end with its last
        heads = {f[1:-1 if f[-1] == "$" else None][:AFFIXES[0]] for f in strength if f[0] == "^"}
        tails = {f[:-1][-AFFIXES[0]:] for f in strength if f[0] != "^"}

        def strengths(words):
            return tuple((w, s) for w in words if (w[:AFFIXES[0]] in heads or w[-AFFIXES[0]:] in tails)
                         and (s := max((strength[f] for f in features(w) if f in strength), default=0.0)) > 0)

        def score(text):
            if not weights:
                return 0.0, None
            found = text_words(text or "", restorer, cache, strengths)
            z = sum(a * b for a, b in zip(weights, (1.0, *summary(list(found.values())))))
            # of several words as strong, the greatest
            top = max(((s, w) for w, s in found.items() if s >= STRONG), default=(0, None))
            return 1 / (1 + math.exp(-min(max(z, -700.0), 700.0))), top[1]

        return score

    out = map_texts(docs, start, [("score", "double"), ("strongest", "string")], returned)
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def op11_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    characters = character_model(docs)
    model = fit(docs.filter(~held_out(F.col("doc_id"))), read_table(spark, sf_dir, "labels"), characters)
    out = toxicity(docs, model, characters, ["doc_id"])
    return out.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "score", "predicted", "strongest")

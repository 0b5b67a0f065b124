"""Operator 9: licence scan by a positional index of rare words.

1. Document frequencies of all template words over the whole corpus give their IDF.
2. A template counts only where its mandatory key phrases stand, so the index holds the
   positions of the rarest words of each key phrase. A phrase with a word that no document
   holds stands nowhere, and its template is left out. Every index word of a file is looked
   up; file position minus template position is where the template would begin, and words
   that agree on it make a candidate.
3. A candidate counts once its template's key phrases stand where the alignment puts them.
   Only then is the text compared. Phrases of the base list are counted wherever they stand.

Templates, index and frequencies are bounded by the template list; each file is scanned
where it lies, so nothing but one narrow row per file leaves a task.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, read_table
from .licence_templates import BASE_PHRASES, TEMPLATES

RARE_PER_PHRASE = 2     # index words of a key phrase
SLACK = 8               # words by which a key phrase may be off its place

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """Words of the text as bytes; bytes.lower() changes A-Z only."""
    return _WORD.findall((text or "").encode().lower())


class Index:
    """The template side, the same in every task: built from the templates and the IDF."""

    def __init__(self, frequencies: dict[bytes, int], n_docs: int, templates=TEMPLATES,
                 phrases=BASE_PHRASES, rare: int = RARE_PER_PHRASE):
        self.idf = lambda w: math.log((n_docs + 1) / (frequencies.get(w, 0) + 1))
        # (label, words, [(key phrase, its place)])
        self.templates = []
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.indexed = []
        for label, text, keys in templates:
            ws, t = words_of(text), len(self.templates)
            placed = [(k, _place(ws, k)) for k in map(words_of, keys)]
            self.templates.append((label, ws, placed))
            places = set()
            if all(frequencies.get(w) for k, _ in placed for w in k):
                for k, at in placed:
                    best = sorted(set(k), key=lambda w: (-self.idf(w), w))[:rare]
                    places.update(at + j for j, w in enumerate(k) if w in best)
            self.indexed.append(len(places))
            for at in sorted(places):
                self.postings[ws[at]].append((t, at))
        self.phrases = [(words_of(p), label) for p, label in phrases.items()]
        self.heads = {p[0] for p, _ in self.phrases}
        self.look = frozenset(self.heads) | frozenset(self.postings)


def _place(ws: list[bytes], phrase: list[bytes]) -> int:
    """First place of a key phrase in its template."""
    k = len(phrase)
    return next(i for i in range(len(ws) - k + 1) if ws[i:i + k] == phrase)


def _stands(ws: list[bytes], phrase: list[bytes], near: int, slack: int) -> bool:
    k = len(phrase)
    return any(ws[i:i + k] == phrase for i in range(max(0, near - slack), min(len(ws) - k, near + slack) + 1))


def scan(ws: list[bytes], index: Index, slack: int = SLACK) -> tuple:
    """(n_base, first_word, last_word, base labels, all labels, score) of one file."""
    held = index.look.intersection(ws)
    if not held:
        return 0, None, None, "", "", 0.0
    places = defaultdict(list)
    for i, w in enumerate(ws):
        if w in held:
            places[w].append(i)
    base = [(i, label) for p, label in index.phrases for i in places.get(p[0], ())
            if ws[i:i + len(p)] == p]
    labels = {label for _, label in base}
    votes: Counter = Counter()
    for w in places:
        for t, at in index.postings.get(w, ()):
            for i in places[w]:
                votes[t, i - at] += 1
    score = 0.5 if base else 0.0
    more = set()
    for (t, start), n in votes.items():
        label, tw, keys = index.templates[t]
        if n < min(2, index.indexed[t]):
            continue
        if all(_stands(ws, k, start + at, slack + len(tw) // 4) for k, at in keys):
            more.add(label)
            inside = sum(0 <= start + j < len(ws) and ws[start + j] == w for j, w in enumerate(tw))
            score = max(score, 0.5 + 0.5 * inside / len(tw))
    at = [i for i, _ in base]
    return (len(base), min(at, default=None), max(at, default=None),
            ",".join(sorted(labels)), ",".join(sorted(labels | more)), score)


def template_words(templates=TEMPLATES) -> frozenset[bytes]:
    return frozenset(w for _, text, _ in templates for w in words_of(text))


def corpus_frequencies(docs: DataFrame, templates=TEMPLATES) -> tuple[dict[bytes, int], int]:
    """Over all documents: how many hold each template word, and how many there are."""
    wanted = template_words(templates)

    def count(batches):
        n, seen = 0, Counter()
        for batch in batches:
            n += batch.num_rows
            for t in batch.column(0):
                seen.update(wanted.intersection(words_of(t.as_py())))
        yield pa.RecordBatch.from_arrays(
            [pa.array([*seen, b""], pa.binary()), pa.array([*seen.values(), n], pa.int64())], ["word", "n"])

    total = map_arrow(docs.select("text"), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {bytes(r["word"]): r["n"] for r in total.collect()}  # one row per template word
    return found, found.pop(b"", 0)


@lru_cache(maxsize=2)
def _index(frequencies: tuple, n_docs: int) -> Index:
    return Index(dict(frequencies), n_docs)


RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double")


def licence_scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base (places of base phrases), first_word
    and last_word (their smallest and largest start, else null), base_labels, labels (with
    those of verified templates), score (0 nothing, 0.5 a base phrase, up to 1 with the
    share of an aligned template that the file repeats).

    Null and empty texts have no words, no labels and score 0; very long texts are read
    whole. Rows are independent of each other but for the IDF; repeated rows fare alike, an
    empty table stays empty.
    """
    frequencies, n_docs = corpus_frequencies(docs)
    key = tuple(sorted(frequencies.items()))

    def run(batches):
        index = _index(key, n_docs)
        for batch in batches:
            rows = []
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                ws = words_of(t.as_py())
                rows.append((d, len(ws), *scan(ws, index)))
            types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
            names = [c.split()[0] for c in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, RESULT)


def op9_licence_scan(spark, sf_dir: str) -> DataFrame:
    return licence_scan(read_table(spark, sf_dir, "documents"))

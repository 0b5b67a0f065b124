"""Operator 5: language identification by compression.

For every learned language a zstandard compressor carries a raw-content dictionary cut
from a bounded sample of labelled texts. A text is encoded with each of them, whole, in
chunks that keep the dictionary in reach; the language of the smallest encoding wins, and
a text whose best two encodings are too close is marked as rejected.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, read_table

# Bounds of the fit, per language: documents sampled, characters taken from each, bytes
# of the dictionary.
SAMPLE_DOCS, SAMPLE_CHARS, DICT_BYTES = 300, 512, 32_768
LEVEL, CHUNK = 13, 2048
# Texts of fewer bytes than SHORT often fit no match worth its cost and come out alike in
# every language. They are encoded behind sample text of each of these lengths, and what
# they add to its encoding is summed.
SHORT, CARRIERS = 256, (0, 256, 512)
MIN_MARGIN = 0.005  # of the second-smallest encoding's size
UNDETERMINED = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def held_out(doc_id: Column, modulus: int = 3, fold: int = 1) -> Column:
    """True where crc32 of the id as text falls into the fold; false for a null id."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % modulus == fold, F.lit(False))


def normalise(text: str) -> bytes:
    """Lower-case letters and blanks: case and punctuation say little of the language."""
    return _NOT_LETTERS.sub(" ", text.lower()).encode()


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
        dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """Sample text per value of ``lang``, from rows with text and lang: ``dict_bytes`` for
    the dictionary and some more for the carriers.

    The sample is a fixed one: the ``sample_docs`` rows of the language with the lowest
    hash. Rows that can't be among them by their language's count are left out before the
    ranking, so a language with any share of the rows is a small group there.
    """
    rows = labelled.filter("lang is not null and text is not null").select(
        "lang", F.xxhash64("text", "doc_id").alias("h"),
        F.substring("text", 1, sample_chars).alias("text"))
    counts = labelled.filter("lang is not null and text is not null").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"))
    share = F.expr("shiftrightunsigned(h, 11)") / F.lit(2.0 ** 53)
    # one row per language, as the model has; so the filter runs before any shuffle
    near = rows.join(F.broadcast(counts), "lang").filter(share * F.col("n") < 4 * sample_docs + 20)
    by_hash = Window.partitionBy("lang").orderBy("h", "text")
    sample = near.withColumn("k", F.row_number().over(by_hash)).filter(F.col("k") <= sample_docs)
    texts: dict[str, list[bytes]] = {}
    for r in sample.orderBy("lang", "k").select("lang", "text").collect():  # bounded: see above
        texts.setdefault(r["lang"], []).append(normalise(r["text"]))
    size = dict_bytes + sum(CARRIERS)
    return {lang: b" ".join(parts)[:size] for lang, parts in texts.items()}


class Coder:
    """The encoder of one language."""

    def __init__(self, lang: str, content: bytes, level: int, dict_bytes: int = DICT_BYTES):
        import zstandard as z
        self.lang = lang
        options = z.ZstdCompressionParameters.from_level(
            level, min_match=3, write_content_size=False, write_checksum=False, write_dict_id=False)
        kind = {}
        if len(content) >= 8:  # the library takes no shorter dictionary
            d = z.ZstdCompressionDict(content[:dict_bytes], dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=options)
            kind["dict_data"] = d
        self.z = z.ZstdCompressor(compression_params=options, **kind)
        rest = content[dict_bytes:]
        ends = [sum(CARRIERS[:i + 1]) for i in range(len(CARRIERS))]
        self.carriers = [rest[end - n:end] for n, end in zip(CARRIERS, ends)]
        self.empty = sum(len(self.z.compress(c)) for c in self.carriers)

    def size(self, letters: bytes, chunk: int) -> int:
        if len(letters) < SHORT:
            return sum(len(self.z.compress(c + letters)) for c in self.carriers) - self.empty
        return sum(len(self.z.compress(letters[i:i + chunk])) for i in range(0, len(letters), chunk))


@lru_cache(maxsize=2)
def _coders(model: tuple, level: int) -> list[Coder]:
    return [Coder(lang, content, level) for lang, content in model]


def predict(text: str | None, coders: list[Coder], chunk: int = CHUNK) -> tuple[str, float, float]:
    """(language, score, margin) of one text."""
    letters = normalise(text) if text else b""
    if not coders or not any(c.isalpha() for c in letters.decode()):
        return UNDETERMINED, 0.0, 0.0
    sizes = sorted((c.size(letters, chunk), c.lang) for c in coders)
    best = sizes[0][0]
    second = sizes[1][0] if len(sizes) > 1 else 2 * max(best, 1)
    score = 1 / sum(2.0 ** max(best - s, -1000) for s, _ in sizes)
    return sizes[0][1], score, (second - best) / max(second, 1)


def identify(docs: DataFrame, model: dict[str, bytes], min_margin: float = MIN_MARGIN,
             level: int = LEVEL, chunk: int = CHUNK, returned: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` as struct ``doc`` (of all columns, or those ``returned``) with
    lang_pred, score, margin and rejected.

    lang_pred is the language of the smallest encoding (ties: the first by name), or
    ``und`` where the text is null or has no letter or no language was learned. score is
    2^-best over the sum of 2^-size in bytes. rejected: undetermined, or the margin
    between the two smallest encodings is under ``min_margin``. Rows are independent;
    repeated rows fare alike and an empty table stays empty. Very long texts are encoded
    whole, chunk by chunk.
    """
    learned = tuple(sorted(model.items()))

    def start():
        coders = _coders(learned, level)
        return lambda text: predict(text, coders, chunk)

    out = map_texts(docs, start, [("lang_pred", "string"), ("score", "double"), ("margin", "double")], returned)
    return out.withColumn("rejected", (F.col("lang_pred") == UNDETERMINED) | (F.col("margin") < min_margin))


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    # only doc_id and text go to the prediction; doc_id just labels the result
    out = identify(docs.select("doc_id", "text"), model, returned=["doc_id"])
    return out.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"),
                      "lang_pred", "score", "margin", "rejected")

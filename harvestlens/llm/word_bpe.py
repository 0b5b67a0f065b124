"""Token ids of whole texts under a word-level BPE vocabulary, word by word.

The vocabulary's pre-tokenizer cuts at white space and inside it into words, and merges
never cross them. So ids are computed once per distinct word, kept per distinct run of
non-blank characters, and looked up afterwards: a text costs a split and a lookup per run
instead of a full encoding. Texts with characters for which Python's and the tokenizer's
Unicode tables or normal forms could differ are encoded whole by the tokenizer itself.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from functools import lru_cache

CACHE_RUNS = 800_000  # bound of each of the two per-process tables of runs and words (150 MB)

# Printable ASCII, tab, newlines and the Latin letters to U+024F: composed already under
# NFC, and stable across Unicode versions. A text counts as plain if its lower-cased form,
# from which words are cut, is: some capitals have small letters beyond.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ]*")


def _classes() -> tuple[str, str]:
    of = {"L": [], "N": []}
    for c in map(chr, range(0x21, 0x250)):
        kind = unicodedata.category(c)[0]
        if kind in of:
            of[kind].append(c)
    return "".join(of["L"]), "".join(of["N"])


_L, _N = _classes()
# Fixed value: the vocabulary's own split pattern, its classes spelled out for _PLAIN
# (letters come first here: no other alternative begins with one).
_WORD = re.compile(f"[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_N}]|[^\\s{_L}{_N}]+")


def _byte_chars() -> dict[int, int]:
    """The byte-level alphabet: bytes without a printable Latin-1 character of their own
    stand as the characters from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in own)
    return {b: 0x100 + i for i, b in enumerate(rest)}


class WordBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # strings in a text that the tokenizer takes for special tokens
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        # runs of non-blank characters and words: a word is cut from itself whole, so one
        # table serves both. A full one becomes the older one, from which what still occurs
        # is taken over.
        self.runs: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

        self.model = self.tokenizer.model
        self.byte_chars = str.maketrans(_byte_chars())

    def _encode_word(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.byte_chars)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _encode_text(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        low = text.lower()
        if _PLAIN.fullmatch(low) is None or _PLAIN.fullmatch(text) is None or self.special.search(low):
            return self._encode_text(text)
        runs = low.split()
        known = self.runs
        new = set(runs).difference(known)
        if new:
            if len(known) + len(new) > CACHE_RUNS:
                self.older, self.runs = known, {}
                known, new = self.runs, set(runs)
            older = self.older
            known.update([(r, older[r]) for r in new if r in older])
            self._learn(new.difference(known))
        return b"".join(map(known.__getitem__, runs))

    def _learn(self, runs: set[str]) -> None:
        known, older, encode = self.runs, self.older, self._encode_word
        cut = {r: _WORD.findall(r) for r in runs if not r.isalpha()}
        # runs of letters are words already
        new = {w for ws in cut.values() for w in ws if w not in known}.union(runs.difference(cut))
        known.update([(w, older.get(w) or encode(w)) for w in new])
        for r, ws in cut.items():
            known[r] = b"".join([known[w] for w in ws])


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    return WordBpe(path)

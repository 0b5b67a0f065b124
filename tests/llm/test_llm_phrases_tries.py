"""Toxicity, the conversation trie and phrase mining against plain restatements."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestlens.llm import collocations, conversation_trie, deobfuscate, toxicity
from harvestlens.llm import quotient_filter as qf
from harvestlens.llm.language_id import held_out

# ---- conversation trie

TURNS = "conv_id long, turn long, role string, text string"


def trie_by_hand(convs):
    """convs: {conv_id: [(role, text)]} of whole conversations."""
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = collections.defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    def below(node):
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        parts = [below(k) for k in kids[node]]
        return sum(p[0] for p in parts) if parts else 1, own + sum(p[1] for p in parts)

    out = []
    for node, who in members.items():
        ends = sorted(c for c in who if len(convs[c]) == len(node))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids[node]),
                    *below(node), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def rebuilt_by_hand(rows):
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in turns.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    return out


def conversation_rows(seed, n=40, ids=260, longest=11):
    rng = random.Random(seed)
    rows = [(None, 0, "user", "no conversation"), (0, None, "user", "null turn"), (3, 50, None, None)]
    for c in rng.sample(range(ids), n):
        say = rng.choices(["a", "bb", "é", "", "漢字"], k=rng.randint(0, longest))
        # the same few turns again and again: shared prefixes, equal conversations
        rows += [(c, t, "user" if t % 2 else "assistant", x) for t, x in enumerate(say)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,band,block", [(1, 8, 1024), (2, 2, 3), (3, 3, 1)])
def test_trie(spark, seed, band, block):
    rows = conversation_rows(seed)
    # one conversation is much longer than the others, and one that equals it
    for c in (7, 207):
        rows += [(c, 100 + t, "user", f"t{t % 5}") for t in range(45)]
    table = spark.createDataFrame(rows, TURNS).repartition(5)
    clash = table.select("*", *[F.lit(1).alias(n) for n in ("pos", "depth", "k1", "_part", "t1", "chars", "h")])
    want = trie_by_hand(rebuilt_by_hand(rows))
    for t in (table, clash):
        turns, ids = conversation_trie.rebuilt_turns(conversation_trie.ordered_turns(t))
        got = conversation_trie.trie(turns, ids, band, block).collect()
        assert sorted((tuple(r) for r in got), key=lambda r: r[:2]) == want


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversation_trie.trie(*conversation_trie.rebuilt_turns(conversation_trie.ordered_turns(empty))).count() == 0


def test_equal_turn_numbers_have_one_order(spark):
    rows = [(1, 5, "user", x) for x in "abcabc"] + [(2, 5, "user", x) for x in "bcacba"]
    orders = []
    for parts in (1, 4):
        got = conversation_trie.ordered_turns(spark.createDataFrame(rows, TURNS).repartition(parts)).collect()
        by = collections.defaultdict(list)
        for r in sorted(got, key=lambda r: r.pos):
            by[r.conv_id].append(r.t1)
        assert [sorted(r.pos for r in got if r.conv_id == c) for c in (1, 2)] == [list(range(1, 7))] * 2
        assert by[1] == by[2]
        orders.append(by[1])
    assert orders[0] == orders[1]


def test_end_lists_in_pieces(spark):
    ids = random.Random(5).sample(range(10 ** 6), 500) + [-4, 0, 10 ** 12]
    ends = spark.createDataFrame([(1, 2, 3, c) for c in ids], "depth long, k1 long, k2 long, conv_id long")
    for per in (1, 1000, 10 ** 15):
        got = conversation_trie.end_digests(ends.repartition(7), per).collect()
        assert [r.ends_sha256 for r in got] == [hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()]


# ---- phrase mining

def test_filters_keep_keys_and_counts():
    rng = np.random.default_rng(4)
    for size, bits in itertools.product((2, 3, 4, 5), (1, 5, 16, 21, 32)):
        ids = [rng.integers(0, 1 << bits, 3000) for _ in range(size)]
        lanes, w = qf.permute(ids, bits), qf.widths(size, bits)
        assert all((a == b).all() for a, b in zip(ids, qf.unpermute(lanes, size, bits)))
        want = collections.Counter(zip(*(x.tolist() for x in ids)))
        keys, counts = qf.summed(lanes, None, w)
        counts = counts * 200  # above and below one byte
        s = min(3, w[0])
        shard = (keys[0] >> np.uint64(w[0] - s)).astype(int)
        got = {}
        for b in np.unique(shard).tolist():
            mine = shard == b
            blob = qf.encode([k[mine] for k in keys], counts[mine], w, s)
            k, c = qf.merged([blob, blob], w, b, s)
            got |= dict(zip(zip(*(x.tolist() for x in qf.unpermute(k, size, bits))), c.tolist()))
        assert got == {k: 400 * n for k, n in want.items()}


def phrases_by_hand(rows, least, longest, top):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    often = {k: c for k, c in f.items() if c >= least and len(k) > 2}
    out = []
    for (lang, *w), a in often.items():
        w = tuple(w)
        if any(k[0] == lang and len(k) > len(w) + 1 and c >= a and any(k[i:i + len(w)] == w for i in range(1, len(k)))
               for k, c in often.items()):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, f[lang, *w[:k]], f[lang, *w[k:]], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    return [(lang, i + 1, *r[1:]) for lang, g in itertools.groupby(out, key=lambda r: r[0]) for i, r in enumerate(g) if i < top]


def phrase_rows(seed):
    rng = random.Random(seed)
    words = ["der", "Die", "das", "ß", "漢", "x\x1cy", "a'b", "\xa0"] + [f"w{i}" for i in range(30)]
    rows = [("en", None), (None, "the end, the end! THE\tend"), ("en", ""), ("", "no lang  no lang"), ("und", "the end"),
            ("de", "das " * 5000), ("de", " ".join(rng.choices(words, k=20_000)))]
    fixed = ["der die das", "w1 w2 w3 w4 w5", "w1 w2 w3 w4 w5 w6"]
    for _ in range(150):
        parts = rng.choices(words, k=rng.randint(1, 30)) + rng.choices(fixed, k=3)
        rng.shuffle(parts)
        rows.append((rng.choice(["en", "de", "de", None]), "".join(p + rng.choice([" ", " ", " ", "\t", ". ", "\n", "  "]) for p in parts)))
    return rows + rows[:20]


# dictionary of all words or of few (the rest by a join), few and many shards
@pytest.mark.parametrize("sent,per_shard", [(200_000, 1 << 19), (7, 100), (0, 1000)])
def test_collocations(spark, monkeypatch, sent, per_shard):
    rows = phrase_rows(1)
    table = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    clash = table.select("*", *[F.lit(1).alias(n) for n in ("word", "c", "id", "ids", "f", "n", "score", "_row")])
    for t, top in ((table, 2000), (clash, 5)):
        got = collocations.collocations(t, 8, top=top, sent_words=sent, per_shard=per_shard).collect()
        assert sorted(map(tuple, got)) == sorted(phrases_by_hand(rows, 8, 5, top))
    assert len(got) > 10


def test_collocations_of_nothing(spark):
    for rows in ([], [("en", None), ("en", "...")]):
        assert collocations.collocations(spark.createDataFrame(rows, "lang string, text string")).count() == 0


def test_shared_slots_lose_nothing(spark, monkeypatch):
    """A bitmap of few slots lets everything pass."""
    rows = phrase_rows(2)
    table = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations, "SLOT_BITS", 4)
    got = collocations.collocations(table, 8).collect()
    assert sorted(map(tuple, got)) == sorted(phrases_by_hand(rows, 8, 5, 2000))


# ---- toxicity

CLEAN_WORDS = "house river morning garden letter window friend table little under story people water summer".split()
RUDE = ["idiot", "moron", "loser", "worthless"]


def toxic_rows(n=240):
    rng = random.Random(8)
    rows, labels = [], []
    for d in range(n):
        words = rng.choices(CLEAN_WORDS, k=rng.randint(5, 40))
        toxic = d % 3 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(RUDE))
        rows.append((d, " ".join(words).capitalize() + ".", "en", "a"))
        labels.append((d, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def toxic_model(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (10 ** 9, 0, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    characters = toxicity.character_model(docs)
    return toxicity.fit(docs.filter(~held_out(F.col("doc_id"))), lab, characters), characters


def cells_by_hand(text):
    out = collections.Counter()
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        s = [0, 0, 0, *[deobfuscate.symbol(c) for c in w], 0]
        for i in range(len(s) - 3):
            out[((s[i] * 28 + s[i + 1]) * 28 + s[i + 2]) * 28 + s[i + 3]] += 1
    return out


def test_character_grams():
    for text in ("", "a", "It's 3 o'clock_now", "ÉTÉ ß 漢字 ñ", "a1b  c", "\n\n", "𝔸b"):
        assert collections.Counter(deobfuscate.gram_cells(text).tolist()) == cells_by_hand(text)


def test_probabilities_sum_to_one():
    cells = np.array(sorted(cells_by_hand("some words and some more words")))
    p = np.exp(np.frombuffer(deobfuscate.log_probabilities(cells, np.ones(len(cells))), "<f4").reshape(-1, 28))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)


def test_restoring_takes_the_best_path(toxic_model):
    r = deobfuscate.Restorer(toxic_model[1])

    def all_paths(lattice):
        def score(arcs):
            s, ctx = 0.0, (0, 0, 0)
            for text, cost in [*arcs, (" ", 0.0)]:
                s += cost
                for ch in text:
                    x = deobfuscate.symbol(ch)
                    if x or ctx[2]:
                        s += r.logp[((ctx[0] * 28 + ctx[1]) * 28 + ctx[2]) * 28 + x]
                        ctx = (*ctx[1:], x) if x else (0, 0, 0)
            return s
        return max(itertools.product(*lattice), key=score)

    for token in ("1d10t", "m0r0n", "l-o-s-e-r", "w4t3r", "riiiver", "a1*b", "$ummer"):
        lattice = deobfuscate._lattice(token)
        assert r.best(lattice) == "".join(t for t, _ in all_paths(lattice)).strip()


def test_disguised_words(toxic_model):
    r = deobfuscate.Restorer(toxic_model[1])
    for seen, meant in {"1d10t": "idiot", "m0r0n": "moron", "l.o.s.e.r": "loser", "w0rthle$$": "worthless", "wooorthless": "worthless",
                        "id!ot": "idiot", "mooooron!!!": "moron", "idi0t%%%": "idiot", "w4ter": "water"}.items():
        assert r.token(seen) == meant
    for same in ("house", "2024", "...", "été", "", "§§"):
        assert r.token(same) == same
    assert r.apart("i d i o t") == "idiot" and r.apart("1 d 1 0 t") == "idiot"


def test_toxicity(spark, toxic_model):
    model, characters = toxic_model
    rows, labels = toxic_rows()
    long = " ".join(random.Random(1).choices(CLEAN_WORDS, k=200_000))
    extra = [(1000, None, 0), (1001, "", 0), (1002, "house m o r o n river", 1), (1003, "you 1d10000t, story", 1), (1004, long, 0),
             (1005, long + " l0ser", 1), (1005, "house", 0), (None, "idiot", 1), (1006, "a a a a a a", 0), (1007, "x" * 100_000, 0)]
    want = {(d, t): int(lab[2]) for (d, t, *_), lab in zip(rows, labels)} | {(d, t): x for d, t, x in extra}
    docs = spark.createDataFrame([(d, t) for d, t in want], "doc_id long, text string").repartition(3)
    docs = docs.select("*", *[F.lit(1).alias(n) for n in ("score", "predicted", "doc", "strongest")])
    got = toxicity.toxicity(docs, model, characters).collect()
    assert len(got) == len(want) and all(0 <= r.score <= 1 for r in got)
    assert {(r.doc.doc_id, r.doc.text): r.predicted for r in got} == want
    again = toxicity.toxicity(docs, model, characters, ["doc_id"])
    assert again.schema["doc"].dataType.names == ["doc_id"]
    assert toxicity.toxicity(docs.limit(0), model, characters).count() == 0


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "idiot"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 1)]):
        lab = spark.createDataFrame(labels, "doc_id long, toxic int")
        characters = toxicity.character_model(docs)
        out = toxicity.toxicity(docs, toxicity.fit(docs, lab, characters), characters).collect()
        assert [(r.score, r.predicted) for r in out] == [(0.0, 0)] * 2


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in toxicity.op11_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    right = collections.Counter((labels[r.doc_id], r.predicted) for r in got)
    assert right[1, 1] >= 0.75 * (right[1, 1] + right[1, 0]) and right[0, 0] >= 0.97 * (right[0, 0] + right[0, 1])


# ---- segments of long texts

def test_word_hashes_of_long_texts(monkeypatch):
    """Cut between words anywhere, a text has the same words; one word may be longer than a
    segment."""
    from harvestlens.llm import textnum
    rng = random.Random(4)
    text = b" ".join(bytes(rng.choices(b"abcz0\xc3\xa9", k=rng.randint(1, 9))) for _ in range(3000))
    texts = [b"one", text, b"", text + b" " + b"x" * 5000 + b" end", b"  ", text[:700]]
    whole = textnum.word_hashes(texts)
    for segment in (64, 1000, 4096):
        monkeypatch.setattr(textnum, "SEGMENT", segment)
        hashes, owner = textnum.word_hashes(texts)
        assert (hashes == whole[0]).all() and (owner == whole[1]).all()
    assert np.bincount(whole[1], minlength=6).tolist() == [len(re.findall(rb"[0-9a-z\x80-\xff]+", t)) for t in texts]


def test_signatures_do_not_depend_on_how_many_run_together():
    from harvestlens.llm import probminhash_dedup as pm
    rng = np.random.default_rng(2)
    element = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    owner = np.sort(rng.integers(0, 5, 4000))
    weight = rng.random(4000) + 0.1
    want = pm.signatures(element, owner, weight, 5, 64)
    for at_once in (1, 37, 1000):
        assert (pm.signatures(element, owner, weight, 5, 64, at_once) == want).all()

"""op12 against brute force: counts of every length, activation over shards, collisions of slots."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from loopcount.llm import collocations as dic

LOWER = {i: i + 32 for i in range(65, 91)}


def brute_counts(rows, longest):
    out = [Counter() for _ in range(longest)]
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                out[k - 1].update((lang or "und", " ".join(w[i:i + k])) for i in range(len(w) - k + 1))
    return out


def brute(rows, longest, at_least, first, share):
    counts = brute_counts(rows, longest)
    everything = {key: c for size in counts for key, c in size.items()}
    n = Counter()
    for (lang, _), c in counts[0].items():
        n[lang] += c
    candidates = {key: c for size in counts[1:] for key, c in size.items() if c >= at_least}
    longer = Counter()
    for (lang, phrase), c in candidates.items():
        w = phrase.split(" ")
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                key = (lang, " ".join(w[i:i + k]))
                longer[key] = max(longer[key], c)
    found = {}
    for (lang, phrase), a in candidates.items():
        if (lang, phrase) in longer and 100 * longer[lang, phrase] >= share * a:
            continue
        w = phrase.split(" ")
        cuts = []
        for k in range(1, len(w)):
            l, r = everything[lang, " ".join(w[:k])], everything[lang, " ".join(w[k:])]  # noqa: E741
            cuts.append((10**6 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)  # noqa: E741
        found.setdefault(lang, []).append((-score, -a, phrase.encode(), l, r))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, x in found.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:first], 1))


def corpus(seed, n=150):
    rnd = random.Random(seed)
    vocabulary = ["a", "b", "C", "d", "É", "中文", "x-y", "'s", "b"] + ["w%d" % i for i in range(60)]
    rows = []
    for i in range(n):
        lang = rnd.choice(["en", "de", None, "und"])
        words = [rnd.choice(vocabulary[:9] if rnd.random() < 0.7 else vocabulary) + rnd.choice(["", "", "", "", ",", ".", "\n", "\x0b", "?!"]) for _ in range(rnd.choice((0, 1, 2, 3, 40, 80)))]
        rows.append((i, rnd.choice((" ", "  ", "\t")).join(words), lang))
    return rows + [(n, None, "en"), (n + 1, "", "de"), (n + 2, " . ,, \n", None), (n + 3, "b b b b b b b b b b b b", "fr"), (None, "b b b", "fr"), (5, "again and again and again", "fr")]


def plain(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize("seed,longest,shards,slots", [(1, 3, 4, 1 << 16), (2, 3, 1, 1 << 16), (3, 4, 3, 1 << 16), (4, 3, 4, 64), (5, 2, 2, 1 << 16)])
def test_equals_brute_force(docs, monkeypatch, seed, longest, shards, slots):
    """With 64 slots nearly all phrases share one with a frequent phrase."""
    monkeypatch.setattr(dic, "LEAST_SLOTS", slots)
    monkeypatch.setattr(dic, "MOST_SLOTS", max(64, slots))
    rows = corpus(seed)
    assert plain(dic.collocations(docs(rows), longest, 10, 20, 50, shards)) == brute(rows, longest, 10, 20, 50)


def test_all_counts_are_exact(docs):
    rows = corpus(7)
    for got, expected in zip(dic.phrase_counts(docs(rows), 3, 10, 4), brute_counts(rows, 3)):
        got = {(r["lang"], r["phrase"]): r["c"] for r in got.collect()}
        assert {k: v for k, v in got.items() if v >= 10} == {k: v for k, v in expected.items() if v >= 10}


def test_a_phrase_seen_late_still_counts_a_full_cycle(docs):
    """Rare words in the first shards, the phrase in all of them."""
    rows = [(i, "one two three", "en") for i in range(12)]
    got = {r["phrase"]: (r["a"], r["l"], r["r"], r["n"], r["score"]) for r in dic.collocations(docs(rows), 3, 10, 10, 50, 4).collect()}
    assert got == {"one two three": (12, 12, 12, 36, 10**6)}


def test_steps_and_activation():
    """A phrase isn't counted before both its parts have reached the threshold, then for one cycle."""
    words = dic.Words(pa.array(["en"]), pa.array(["p q P q"]))
    spelled = dict(zip(words.keys.view(np.int64).tolist(), words.text.to_pylist()))
    key = {t: np.array([k], np.int64).view(np.uint64) for k, t in spelled.items()}
    assert words.counted().to_pylist() == [{"lang": "en", "phrase": "p", "c": 2}, {"lang": "en", "phrase": "q", "c": 2}]
    first, second = np.full(1 << 16, dic.NEVER, np.uint8), np.full(1 << 16, dic.NEVER, np.uint8)
    slot = lambda k: (k & np.uint64((1 << 16) - 1)).astype(int)

    def found(step):
        rows = [r for b in dic.count_active(words, [first, second], step, 4) for r in b.to_pylist()]
        return {(" ".join(spelled[r[f"k{i}"]] for i in range(1, r["size"] + 1)), r["since"], r["c"]) for r in rows}

    assert found(0) == set()
    first[slot(key["p"])] = 0
    assert found(1) == set()
    first[slot(key["q"])] = 1
    assert found(2) == {("p q", 1, 2), ("q p", 1, 1)}
    second[slot(dic._longer(key["p"], key["q"]))] = 2
    second[slot(dic._longer(key["q"], key["p"]))] = 3
    assert found(4) == {("p q", 1, 2), ("q p", 1, 1), ("p q p", 3, 1), ("q p q", 3, 1)}
    assert found(6) == {("p q p", 3, 1), ("q p q", 3, 1)} and found(8) == set()
    # A slot that another phrase wrote before the words were reached starts no earlier than these.
    second[:] = 0
    assert found(2) == {("p q", 1, 2), ("q p", 1, 1), ("p q p", 1, 1), ("q p q", 1, 1)}


def test_words_of_one_key_are_counted_again_with_other_keys(docs, monkeypatch):
    salts, usual = [], dic._cycle

    def cycle(documents, longest, at_least, shards, salt):
        salts.append(salt)
        if salt < 2:
            raise dic.SameKey
        return usual(documents, longest, at_least, shards, salt)

    rows = corpus(3)
    monkeypatch.setattr(dic, "_cycle", cycle)
    assert plain(dic.collocations(docs(rows), 3, 10, 20, 50, 2)) == brute(rows, 3, 10, 20, 50) and salts == [0, 1, 2]
    lang, word = pa.array(["en"] * 3), pa.array(["a", "b", "c"])
    assert len({int(k) for salt in range(4) for k in dic._keys(lang, word, salt)}) == 12
    crossed = dic._keys(pa.array(["de", "es"]), pa.array(["es", "de"]), 0)
    assert crossed[0] != crossed[1]


def test_a_shared_key_is_noticed(spark, monkeypatch):
    """All words get one key: the words' table shows it."""
    rows = spark.createDataFrame([("en", "one two " * 12, 0)], "lang string, text string, shard int")
    monkeypatch.setattr(dic, "_with_keys", lambda words, salt: words.selectExpr("*", "7L as k1"))
    with pytest.raises(dic.SameKey):
        dic._cycle(rows, 2, 10, 1, 0)


def test_empty_table_long_text_and_big_numbers(docs, spark):
    assert dic.collocations(docs([])).count() == 0
    assert dic.collocations(docs([(1, None), (2, "")])).count() == 0
    long = "north wind " * 400_000
    assert plain(dic.collocations(docs([(1, long, "en"), (2, "calm", "en")]))) == brute([(1, long, "en"), (2, "calm", "en")], 3, 10, 2000, 50)
    # Products beyond 64 bits stay exact.
    big = spark.sql("SELECT (1000000 * cast(a as decimal(38, 0)) * a) div (cast(l as decimal(38, 0)) * r) s FROM VALUES (4000000000000L, 4000000000001L, 5000000000003L) t(a, l, r)")
    assert big.first()["s"] == 10**6 * 4000000000000**2 // (4000000000001 * 5000000000003)

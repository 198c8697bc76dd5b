"""op11 against brute force: registers, estimates, components."""

import random

import numpy as np
import pytest

from loopcount.llm import hyperminhash as hmh
from tests.llm.test_jaccard import brute, texts


def found(df):
    out = {}
    for r in df.collect():
        assert r["kept"] == (r["doc_id"] == r["component_id"])
        out[r["doc_id"]] = (r["n_shingles"], r["component_id"])
    return out


def sets_of(similarity, n, seed):
    rnd = np.random.default_rng(seed)
    shared = round(n * similarity)
    x = rnd.integers(0, 2**64, size=n, dtype=np.uint64)
    half = shared + (n - shared) // 2
    return np.sort(x[:half]), np.sort(np.concatenate([x[:shared], x[half:]])), shared / n


def plain_register(values):
    """Leading zeros and mantissa of the smallest of 56-bit integers, by text."""
    bits = format(min(values) >> 3, "053b")
    zeros = len(bits) - len(bits.lstrip("0"))
    return (zeros << hmh.MANTISSA) + int((bits[zeros + 1:] + "0" * hmh.MANTISSA)[:hmh.MANTISSA], 2)


@pytest.mark.parametrize("n", [1, 3, 40, 700, 20000])
def test_registers_equal_a_plain_version(n):
    x = np.sort(np.random.default_rng(n).integers(0, 2**64, size=n, dtype=np.uint64))
    if n == 3:
        x[0] = 5 << 56  # a value of zero bits only
    buckets = {}
    for v in x.tolist():
        buckets.setdefault(v >> 56, []).append(v & (1 << 56) - 1)
    got = hmh.registers(np.sort(x))
    own = {b: plain_register(v) for b, v in buckets.items()}
    for b in range(hmh.BUCKETS):
        donor = b if b in own else next(int(i) for i in hmh._BORROW[b] if int(i) in own)
        assert got[b] == own[donor], b


@pytest.mark.parametrize("n", [5, 10, 60, 300, 5000])
def test_no_pair_of_the_wanted_similarity_is_filtered(n):
    """2,000 pairs just at 0.8: all share a band, are estimated above 0.6 and differ in few bits."""
    errors = []
    for seed in range(2000 if n < 1000 else 200):
        a, b, similarity = sets_of(0.8, n, seed)
        ra, rb = hmh.registers(a), hmh.registers(b)
        same = (ra == rb)[:hmh.BANDS * hmh.ROWS].reshape(hmh.BANDS, hmh.ROWS).all(axis=1)
        guess = hmh.estimate(np.array([len(a)]), ra[None], np.array([len(b)]), rb[None])[0]
        errors.append(guess - similarity)
        assert same.any() and guess >= 0.8 - hmh.SLACK
        assert int(np.bitwise_count((hmh.short_bits(ra) ^ hmh.short_bits(rb)).view(np.uint64)).sum()) <= hmh.FAR
    assert abs(np.mean(errors)) < 0.01


def test_chance_is_what_different_sets_share():
    rnd, agree = np.random.default_rng(3), []
    for _ in range(400):
        a, b = (np.sort(rnd.integers(0, 2**64, size=2000, dtype=np.uint64)) for _ in range(2))
        agree.append((hmh.registers(a) == hmh.registers(b)).mean())
    expected = hmh.by_chance(np.array([2000]), np.array([2000]))[0]
    assert abs(np.mean(agree) - expected) < 5 * np.sqrt(expected / (400 * hmh.BUCKETS))


@pytest.mark.parametrize("words,percent,seed", [(4, 80, 1), (4, 80, 2), (5, 85, 3), (2, 95, 4)])
def test_components_equal_brute_force(docs, words, percent, seed):
    rows = list(enumerate(texts(seed)))
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "One two"), (904, "one  TWO"), (905, "one two three")]
    df = hmh.near_duplicates(docs(rows), words, percent)
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert found(df) == brute(rows, words, percent)


@pytest.mark.parametrize("hot,block", [(2048, 512), (10, 4)])
def test_copies_chains_and_a_common_passage(docs, monkeypatch, hot, block):
    monkeypatch.setattr(hmh, "HOT_COPIES", hot)
    monkeypatch.setattr(hmh, "BLOCK", block)
    monkeypatch.setattr(hmh, "TASK_ROWS", 8 * block)
    rnd = random.Random(9)
    base = ["x%d" % i for i in range(200)]
    rows = [(i, " ".join(base)) for i in range(50, 90)]
    rows += [(i, " ".join(base[:i] + ["new%d" % i] + base[i + 1:])) for i in range(100, 140)]
    rows += [(200 + i, " ".join(base[i:] + ["tail%d" % j for j in range(i)])) for i in range(0, 100, 5)]
    # Documents that share most of their words without being near copies of each other.
    rows += [(400 + i, " ".join(base[:120] + ["own%d" % rnd.randrange(10**9) for _ in range(60)])) for i in range(60)]
    assert found(hmh.near_duplicates(docs(rows), 4, 80)) == brute(rows, 4, 80)


def test_pairs_of_a_list_lose_no_link():
    """Members of sizes around a power of two, so that bitmaps of two lengths meet."""
    rnd = np.random.default_rng(4)
    base = rnd.integers(0, 2**64, size=66, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rnd.random(66) > 0.1], rnd.integers(0, 2**64, size=rnd.integers(1, 9), dtype=np.uint64)])) for _ in range(60)]
    sets = [np.sort(x) for x in sets]
    n = np.array([len(x) for x in sets])
    assert n.min() < 64 <= n.max()
    regs = np.array([hmh.registers(x) for x in sets])
    rep = rnd.permutation(60)
    shares = lambda i, j, band: (regs[i] == regs[j])[band * hmh.ROWS:(band + 1) * hmh.ROWS].all()
    for block, band in ((np.zeros(60, int), 0), (np.arange(60) % 2, 0), (np.zeros(60, int), 3)):
        a, b = hmh.pairs_of_list(rep, n, rep, regs, [hmh.bitmap(x) for x in sets], block, band, 80)
        got = set(zip(a.tolist(), b.tolist()))
        assert len(got) == len(a)
        for i in range(60):
            for j in range(60):
                shared = len(np.intersect1d(sets[i], sets[j]))
                if any(shares(i, j, k) for k in range(band)):
                    assert (rep[i], rep[j]) not in got or i == j
                elif rep[i] < rep[j] and (block.max() == 0 or block[i] != block[j]) and 100 * shared >= 80 * (n[i] + n[j] - shared):
                    assert (rep[i], rep[j]) in got
        assert len(got) < 60 * 59 / 2


def test_two_components_in_one_list(docs):
    """The smallest member of a list is a copy of some members only; the others still meet."""
    base = ["x%d" % i for i in range(100)]
    rows = [(1, " ".join(base + ["a%d" % i for i in range(60)]))]
    rows += [(10 + i, " ".join(base + ["b%d" % j for j in range(60)] + ["t%d" % i])) for i in range(8)]
    got = found(hmh.near_duplicates(docs(rows), 4, 80))
    assert got == brute(rows, 4, 80) and {v[1] for k, v in got.items() if k >= 10} == {10}


def test_null_ids_repeated_rows_empty_tables_and_long_texts(docs):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (3, "q w e r t y"), (3, "a b c d e f")]
    got = sorted(map(tuple, hmh.near_duplicates(docs(rows), 4, 80).collect()), key=str)
    assert got == sorted([(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (3, 3, 1, False), (None, 3, None, None)], key=str)
    assert hmh.near_duplicates(docs([]), 4, 80).count() == 0
    assert hmh.near_duplicates(docs([(1, None), (2, "")]), 4, 80).filter("component_id = doc_id and kept and n_shingles = 0").count() == 2
    long = " ".join(str(i) for i in range(300_000))
    assert found(hmh.near_duplicates(docs([(1, long), (2, long + " end"), (3, "short one")]), 4, 80)) == {1: (299_997, 1), 2: (299_998, 1), 3: (1, 3)}


def test_low_similarities_are_refused(docs):
    with pytest.raises(ValueError, match="80 percent"):
        hmh.near_duplicates(docs([]), 4, 50)

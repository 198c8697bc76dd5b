"""op10 against a naive Kneser-Ney, in scripts of two cases, over several passes."""

import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from loopcount.llm import language


def held(i):
    return crc32(str(i).encode()) % 5 == 0


class Naive:
    """Interpolated Kneser-Ney of four symbols over dictionaries."""

    def __init__(self, texts):
        self.counts = {4: Counter()}
        for t in texts:
            s = self.symbols(t)
            self.counts[4].update(tuple(([0, 0, 0] + s)[i:i + 4]) for i in range(len(s)))
        for k in (3, 2, 1):
            self.counts[k] = Counter(w[1:] for w in self.counts[k + 1])
        self.discount = {k: language.discount(sum(n == 1 for n in c.values()), sum(n == 2 for n in c.values())) for k, c in self.counts.items()}
        self.total, self.kinds = Counter(), Counter()
        for k, c in self.counts.items():
            for w, n in c.items():
                self.total[k, w[:-1]] += n
                self.kinds[k, w[:-1]] += 1

    @staticmethod
    def symbols(text):
        out, gap = [], False
        for ch in text or "":
            if ch.isalpha():
                out.append(ord(ch.lower()[0]))
                gap = False
            elif out and not gap:
                out.append(0)
                gap = True
        return out

    def p(self, w):
        k = len(w)
        if k == 0:
            return 1 / max(language.FLAT, len(self.counts[1]) + 1)
        total = self.total[k, w[:-1]]
        if not total:
            return self.p(w[1:])
        d = self.discount[k]
        return max(self.counts[k][w] - d, 0) / total + d * self.kinds[k, w[:-1]] / total * self.p(w[1:])

    def entropy(self, text):
        s = self.symbols(text)
        return sum(-math.log(self.p(tuple(([0, 0, 0] + s)[i:i + 4]))) for i in range(len(s))) / len(s)


WORDS = {"en": "The of and to in is was that for With house water Straße".split(), "ru": "и в не на что он с как это Ёлка весь который мы быть привет дом".split(),
         "bg": "и в не на че той с как това къща ще който ние бъде здравей дом".split(), "zh": "我 的 是 不了 在人 有这 中国 大学".split(), "el": "και το να του η της με Που την από".split()}


def corpus(seed, n, langs=tuple(WORDS)):
    rnd = random.Random(seed)
    return [(i, rnd.choice([" ", ", ", " - "]).join(rnd.choice(WORDS[x]) for _ in range(rnd.randint(4, 30))) + rnd.choice(["", ".", " 12"]), x)
            for i, x in enumerate(rnd.choice(langs) for _ in range(n))]


def results(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("model_rows", [1 << 22, 450, 40])
def test_equals_a_naive_model(docs, monkeypatch, model_rows):
    """In one pass, in passes of some languages, and in pieces of a language."""
    monkeypatch.setattr(language, "MODEL_ROWS", model_rows)
    rows = corpus(1, 200) + [(900, "zzz qqq ё", None), (901, "Дом house 中", None), (902, None, "en"), (903, "...", "ru"), (904, "", None)]
    naive = {x: Naive([t for i, t, lang in rows if lang == x and not held(i) and t]) for x in WORDS}
    trained = language.train(language._training_rows(docs(rows)), language._training())
    assert (len(trained.passes()) == 1) == (model_rows > 450) and (max(trained.pieces.values()) > 1) == (model_rows == 40)
    got = results(language.languages_of(docs(rows)))
    assert len(got) == len(rows)
    for i, text, _ in rows:
        if not Naive.symbols(text):
            assert (got[i]["lang_pred"], got[i]["score"], got[i]["accepted"]) == ("und", 0.0, False)
            continue
        entropy = {x: m.entropy(text) for x, m in naive.items()}
        best = min(entropy, key=lambda x: (round(entropy[x], 9), x))
        assert got[i]["lang_pred"] == best and got[i]["cross_entropy"] == pytest.approx(entropy[best], abs=1e-9)


def test_probabilities_sum_to_one():
    rows, at, has = language.windows(["the water is in the house", "", None, "über ÜBER"])
    rows, n = language._distinct(rows)
    ends = np.unique(rows[-1])
    levels = language.Levels([0.5, 0.6, 0.4, 0.7], ends.astype(np.int64), np.array([len(np.unique(rows[2][rows[3] == d])) for d in ends]))
    model = language.Model(levels, rows, n)
    flat = max(language.FLAT, len(ends) + 1)
    for k in range(rows.shape[1]):
        each = np.repeat(rows[:, k:k + 1], len(ends), axis=1)
        each[-1] = ends
        # The symbols that were never seen share the rest evenly.
        unseen = np.exp(-model.losses(np.append(rows[:3, k], np.uint64(0x4E2D)).reshape(4, 1)))[0]
        assert np.exp(-model.losses(each)).sum() + unseen * (flat - len(ends)) == pytest.approx(1)
    assert at.tolist()[1:3] == at.tolist()[2:4] and has.tolist() == [True, False, False, True]


def test_windows_do_not_cross_texts():
    alone = [language.windows([t])[0].T.tolist() for t in ("abc d!", "été", "  x", "ПРИВЕТ дом")]
    together, at, _ = language.windows(["abc d!", "été", "  x", "ПРИВЕТ дом"])
    assert [together[:, a:b].T.tolist() for a, b in zip(at, at[1:])] == alone
    assert alone[3] == language.windows(["привет ДОМ"])[0].T.tolist()


def test_two_cyrillic_languages_in_both_cases(docs):
    rnd = random.Random(8)
    rows = corpus(3, 400, ("ru", "bg"))
    shout = [(1000 + i, " ".join(rnd.choice(WORDS[x]) for _ in range(20)).upper(), None) for i, x in enumerate(["ru", "bg"] * 20)]
    got = results(language.languages_of(docs(rows + shout)))
    assert sum(got[i]["lang_pred"] == x for i, _, x in rows) >= 0.99 * len(rows)
    assert all(got[1000 + i]["lang_pred"] == x and got[1000 + i]["accepted"] for i, x in enumerate(["ru", "bg"] * 20))
    kept = {r["doc_id"] for r in language.keep_known(docs(rows + shout + [(2000, "qwx zkj vbn " * 20, None), (2001, None, None)])).collect()}
    assert kept == {i for i, *_ in rows + shout}


def test_many_languages_add_little_to_the_driver(docs, monkeypatch):
    """The driver sees a pass of windows at a time, however many languages there are."""
    monkeypatch.setattr(language, "MODEL_ROWS", 100)
    rnd = random.Random(2)
    rows = []
    for k in range(12):
        letters = [chr(0x3B1 + (k * 7 + j) % 24) for j in range(8)]
        rows += [(100 * k + j, " ".join("".join(rnd.choice(letters) for _ in range(3)) for _ in range(12)), f"l{k:02d}") for j in range(12)]
    trained = language.train(language._training_rows(docs(rows)), language._training())
    passes = trained.passes()
    largest = max(sum(len(n) for *_, n in language._pass(trained, p).pieces) for p in passes)
    assert len(passes) >= 12 and largest <= 4 * 100 and sum(trained.rows.values()) > 1200


def test_a_very_long_text_repeated_rows_and_columns(docs):
    long = " ".join(random.Random(1).choice(WORDS["en"]) for _ in range(700_000))
    rows = corpus(5, 60, ("en", "ru")) + [(500, long, None), (501, "house", None), (501, "house", None), (None, "дом", None)]
    got = language.languages_of(docs(rows)).collect()
    assert len(got) == len(rows) and {r["lang_pred"] for r in got if r["doc_id"] in (500, 501)} == {"en"}
    assert {(r["lang_pred"], r["held_out"]) for r in got if r["doc_id"] is None} == {("ru", False)}
    df = docs(rows)
    kept = language.keep_known(df)
    assert kept.columns == df.columns and kept.filter("doc_id = 501").count() == 2

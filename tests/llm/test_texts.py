"""op3, op5, op7, op9 and op10: against brute force, the tokenizers library or held-out rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from loopcount.llm import bpe, language, licenses, packing, quality
from loopcount.llm.common import held_out

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "x"), (5, "Ünï çode ½² 日本 \U0001F600 é ́ ΟΔΟΣ İ \x85\xa0\x1c"), (None, "no id"), (6, "same"), (6, "same"),
       (7, "<|endoftext|>a<|startoftext|> b"), (8, "it's they'll WE'RE 'd 1234 !!??"), (9, "lorem ipsum " * 60_000), (10, "a" * 30_000)]


def crc_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


# --- BPE --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(WORD_BPE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


def test_encode_and_decode_equal_the_library(docs, library):
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.encode_texts(docs(ODD), WORD_BPE).collect()}
    want = set()
    for i, text in ODD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.add((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == want
    assert bpe.encode_texts(docs([]), WORD_BPE).count() == 0


def test_texts_are_encoded_and_decoded_part_by_part(library, monkeypatch):
    encoder = bpe.Encoder(WORD_BPE)
    monkeypatch.setattr(bpe, "SLICE_BYTES", 100)
    monkeypatch.setattr(bpe, "RUN", 50)
    for text in ["Ünï çode <|endoftext|> it's " * 200, "a" * 20_000 + " b " + "ha" * 5000, "x"]:
        parts, decoder = [p for stream in encoder.streams([text]) for p in stream], bpe.Decoder(encoder.merges)
        ids = [i for part, _ in parts for i in part]
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert "".join(decoder.feed(part) for part, _ in parts) + decoder.finish() == library.decode(ids, skip_special_tokens=False)
        assert len(text) < 100 or len(parts) > 10


def test_the_query_decodes_its_ids(docs, monkeypatch):
    monkeypatch.setattr(bpe.Decoder, "feed", lambda self, ids: "".join(f"{i}," for i in ids))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["lorem ipsum"]})
    monkeypatch.setattr(type(docs([])), "mapInArrow", lambda self, run, ddl: list(run([batch])))
    row, = bpe.encode_texts(docs([]), WORD_BPE)[0].to_pylist()
    ids = [i for w in ("lorem", "ipsum") for i in bpe.Encoder(WORD_BPE).ids(w)]
    assert row["decoded_sha256"] == hashlib.sha256("".join(f"{i}," for i in ids).encode()).hexdigest()


def test_random_texts(encoder, library):
    rnd = random.Random(1)
    alphabet = "abcdefghijklmnopqrstuvwxyzABC 'éßÉ \n\t1²!?<|>́İΣσ　日한ª"
    for _ in range(800):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))
        got = [i for w in encoder.words(text) for i in encoder.ids(w)]
        assert got == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_tokens_are_stable_in_the_smallest_window(encoder, library):
    rnd = random.Random(2)
    for text in ["a" * 9000, "ha" * 5000, "!" * 7000] + ["".join(rnd.choice("aeinrsth") for _ in range(6000)) for _ in range(5)]:
        parts = list(encoder.merges.stable_tokens(text, window=1))
        assert len(parts) > 1
        assert [int(i) for p in parts for i in p] == library.encode(text, add_special_tokens=False).ids


def test_decoder_emits_bytes_as_text_once_complete(encoder, library):
    ids = library.encode("naïve 日本 text", add_special_tokens=False).ids
    decoder = bpe.Decoder(encoder.merges, plain=False)
    assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == "naïve 日本 text "
    plain = bpe.Decoder(encoder.merges)
    assert "".join(plain.feed([i]) for i in ids) + plain.finish() == library.decode(ids, skip_special_tokens=False)


# --- packing ----------------------------------------------------------------------------


def test_pieces_cover_every_id_once_in_gapless_sequences(docs, monkeypatch):
    monkeypatch.setattr(packing, "WINDOW_IDS", 4000)
    rnd = random.Random(3)
    rows = ODD + [(100 + i, "word " * rnd.randint(0, 900)) for i in range(60)]
    pieces = packing.pack(docs(rows).coalesce(2), BYTE_BPE).collect()
    library = Tokenizer.from_file(BYTE_BPE)
    want = {}
    for i, text in rows:
        want.setdefault(i, []).append(np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4"))
    by_doc, by_sequence = {}, {}
    for p in pieces:
        ids = want[p["doc_id"]][0]
        assert p["doc_tokens"] == len(ids)
        assert p["ids_crc32"] == zlib.crc32(ids[p["start"]:p["start"] + p["length"]].tobytes())
        by_doc.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"], p["tier"]))
    for i, copies in want.items():
        covered = np.zeros(len(copies[0]), int)
        for start, length in by_doc[i]:
            covered[start:start + length] += 1
        assert (covered == len(copies)).all()
    for parts in by_sequence.values():
        at = 0
        for offset, length, tier in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == parts[0][2] <= 1024 and at & (at - 1) == 0
    assert packing.pack(docs([]), BYTE_BPE).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_each_tier_is_packed_into_sequences_of_its_own_length(seed):
    rnd = random.Random(seed)
    rests = [(min(1023, int(rnd.paretovariate(0.7) * 20)), i, 0) for i in range(rnd.choice((0, 1, 5, 400)))]
    full, left = packing.pack_rests(list(rests), 1024, packing.TIERS)
    tier_of = lambda n: min(t for t in packing.TIERS if n <= t)
    pieces = sorted((doc, start, n) for s in [*full, left] for n, doc, start in s)
    for n, doc, _ in rests:
        mine = [(start, k) for d, start, k in pieces if d == doc]
        assert mine[0][0] == 0 and all(a + k == b for (a, k), (b, _) in zip(mine, mine[1:])) and sum(k for _, k in mine) == n
    for s in full:
        length = sum(p[0] for p in s)
        assert length in packing.TIERS and tier_of(s[0][0]) == length and all(p[0] <= length for p in s)
    for t in packing.TIERS:
        waiting = [p[0] for p in left if tier_of(p[0]) <= t]
        assert sum(waiting) < t or not any(tier_of(n) == t for n in waiting)
    if len(rests) == 400:
        assert {sum(p[0] for p in s) for s in full} >= {1024, 128}
        # Most pieces of long windows are whole rests; gaps are filled from shorter tiers.
        assert any(tier_of(p[0]) < 1024 for s in full if sum(q[0] for q in s) == 1024 for p in s[1:])


def test_fast_tokens_equal_the_library():
    fast, library = packing.Tokens(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    for text in [t or "" for _, t in ODD] + [" " * 300_000, "\n \t" * 1000 + "x", "a  b   c"]:
        assert fast(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_step_groups_are_full_and_balanced():
    rnd = random.Random(4)
    sequences = [[(n, 0, 0), (1024 - n, 1, 0)] for n in (rnd.randint(1, 1023) for _ in range(64))]
    groups = packing.step_groups(sequences, 8)
    load = [sum(sum(p[0] ** 2 for p in s) for s, g in zip(sequences, groups) if g == k) for k in range(8)]
    assert sorted(groups) == sorted(list(range(8)) * 8) and max(load) < 1.15 * min(load)


# --- languages --------------------------------------------------------------------------


def sentences(seed, n):
    rnd = random.Random(seed)
    words = {"en": "the of and to in is was that for with house water".split(), "de": "der die und das nicht über für straße mit schön".split(),
             "fr": "le la les des est été à où français garçon avec".split()}
    return [(i, " ".join(rnd.choice(words[lang]) for _ in range(rnd.randint(3, 30))), lang) for i, lang in enumerate(rnd.choice(sorted(words)) for _ in range(n))]


def test_languages_of_held_out_rows(docs):
    rows = sentences(5, 300) + [(1000, None, "en"), (1001, "", "en"), (1002, "123 !?", "de"), (1003, "the house", None), (None, "und das", "de"), (1004, "the of", "xx-no-text")]
    rows += [(1005, "xqzv " * 300, None)]
    got = {r["doc_id"]: r for r in language.languages_of(docs(rows)).collect()}
    assert len(got) == len(rows)
    held = [(i, lang) for i, _, lang in rows[:300] if crc_held_out(i)]
    assert all(got[i]["held_out"] == crc_held_out(i) for i, *_ in rows)
    assert sum(got[i]["lang_pred"] == lang for i, lang in held) >= 0.97 * len(held)
    for i in (1000, 1001, 1002):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["accepted"]) == ("und", 0.0, False)
    assert got[1003]["lang_pred"] == "en" and got[None]["lang_pred"] == "de"
    assert not got[1005]["accepted"] and sum(not got[i]["accepted"] for i in range(300)) == 0
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_held_out_rows_teach_nothing(docs):
    held = next(i for i in range(100) if crc_held_out(i))
    rows = [(held, "uno dos tres", "es")] + [(i, "one two three", "en") for i in range(100) if not crc_held_out(i)]
    assert {r["lang_pred"] for r in language.languages_of(docs(rows)).collect()} == {"en"}


def test_no_training_rows_and_empty_table(docs):
    got = language.languages_of(docs([(1, "some text", None), (2, None, None)])).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    assert language.languages_of(docs([])).count() == 0
    assert language.keep_known(docs([])).count() == 0


# --- quality ----------------------------------------------------------------------------


def test_quality_of_held_out_rows(docs, spark):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("aeinrsth") for _ in range(rnd.randint(2, 8)))
    rows, marks = [], []
    for i in range(400):
        good = rnd.random() < 0.7
        w = [word() for _ in range(rnd.randint(5, 80))]
        rows.append((i, " ".join(w) + "." if good else " ".join(x + "***" for x in w)))
        marks.append((i, int(good), 0))
    rows += [(1000, None), (1001, ""), (None, "no id"), (1002, "long " * 200_000)]
    marks += [(0, None, 0), (5, 7, 0), (None, 1, 1), (3, marks[3][1], 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.quality_of(docs(rows), labels).collect()}
    assert len(got) == len(rows)
    held = [(i, q) for i, q, _ in marks[:400] if crc_held_out(i)]
    assert sum(got[i]["predicted"] == q for i, q in held) >= 0.95 * len(held)
    assert all(r["held_out"] == crc_held_out(i) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for i, r in got.items())
    assert got[1000]["score"] == got[1001]["score"]
    kept = {r["doc_id"] for r in quality.keep_good(docs(rows), labels).collect()}
    assert kept == {i for i, r in got.items() if r["predicted"]}


def test_quality_without_labels_or_rows(docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in quality.quality_of(docs([(1, "a")]), none).collect()] == [0.5]
    assert quality.quality_of(docs([]), none).count() == 0
    one = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert quality.quality_of(docs([(i, "a b") for i in range(20)]), one).first()["score"] > 0.9


def test_a_pair_table_learns_an_interaction():
    rng = np.random.default_rng(7)
    x = rng.uniform(-1, 1, (3000, 3))
    y = ((x[:, 0] > 0) != (x[:, 1] > 0)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in model.pairs and ((model.score(x) > 0.5) == (y == 1)).mean() > 0.9


def test_features_of_texts_do_not_depend_on_the_slice():
    texts = ["One two.\nTWO two", "", None, "ÀB 12!*", "a a a\na a a\n"]
    together = quality.features(pa.array(texts, pa.string()))
    assert np.allclose(together, np.concatenate([quality.features(pa.array([t], pa.string())) for t in texts]))
    distinct = quality.FEATURES.index("distinct_words")
    assert np.allclose(together[:, distinct], [1.0, 0, 0, 1, 1 / 6]) 


# --- licenses ---------------------------------------------------------------------------

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute_base(text):
    w = PLAIN.findall((text or "").translate(LOWER))
    found = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    return len(w), sorted(found)


def edits(pattern, text):
    before = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        row = [i]
        for j, b in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
        before = row
    return min(before)


def test_base_places_equal_brute_force(docs):
    rnd = random.Random(8)
    bits = ["cc ", "by", "CC", "general ", "public", "license", " ", "All-Rights", "reserved", "é", "1", "\n", "all", "rights", "."]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))) for i in range(2000)] + [(9000, None), (None, "cc by"), (9001, "CC BY, cc/by " * 20_000)]
    for r in licenses.scan(docs(rows)).collect():
        n, found = brute_base(dict(rows)[r["doc_id"]])
        at = [p for p, _ in found]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (n, len(found), min(at, default=None), max(at, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in found})) and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1) >= bool(found)
    assert licenses.scan(docs([])).count() == 0


def test_notices_are_found_up_to_their_number_of_edits():
    rnd = random.Random(9)
    searcher = licenses.Notices()
    for _ in range(400):
        notice, _, most = rnd.choice(searcher.notices)
        s = list(notice)
        for _ in range(rnd.randint(0, 5)):
            i, kind = rnd.randrange(len(s)), rnd.random()
            s[i:i + (kind < 0.7)] = [] if kind < 0.35 else [rnd.choice("abcxyz")]
        text = "Foo bar " + "".join(s) + " baz.\nQux"
        best = edits(notice, text.translate(licenses._PLAIN))
        found = [f for f in searcher.find(text) if f.notice == notice]
        rivals = [f for f in searcher.find(text) if f.notice != notice]
        assert (best <= most) == bool(found) or rivals
        assert not found or min(f.edits for f in found) == best


def test_spans_and_labels():
    found = licenses.Notices().find("x\nReleased under\tthe M1T License. Licensed under CC BY-NC 4.0. All rights reserved; all rights reservd")
    assert [f.label for f in found] == ["mit", "cc-by-nc", "reserved", "reserved"] and [f.edits for f in found] == [1, 0, 0, 1]
    assert (found[0].begin, found[0].end) == (2, 32)


def test_held_out_is_false_for_null(spark):
    df = spark.createDataFrame([(None,), (1,)], "doc_id long")
    assert {r[0] for r in df.select(held_out(df["doc_id"])).collect()} <= {True, False}

"""Packing: an exact round trip, windows within capacity, and little padding."""

import random
import zlib

import numpy as np
import pytest

from cantiga.llm import packing
from cantiga.llm.queries import packing_tokenizer

tokenizers = pytest.importorskip("tokenizers")
SCHEMA = "doc_id bigint, text string, start int, sequence_id string, row string, group int"
TEXTS = [
    None, "", " \n\t", "Hello, World! it's THE end.", "x'S don't 'tis 12,345.67 #hash*** a|b||c", "<|endoftext|> a <|ENDOFTEXT|>b<|startoftext|>",
    "Élan naïve Straße ΣΊΣΥΦΟΣ ΟΔΟΣ. İstanbul", "é ́x a b c\x1cd\u0085e", "日本語テキスト 한국어 한", "Å KK ſ ﬁn", "a‍b 👩‍💻🏽 ...!!!",
    "word. word, word; word's word's. (word) [a1b2] --- 'quoted' \"x\"", "٣٤٥ ½ x² ǅ",
]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", "r", 2) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def reference():
    return tokenizers.Tokenizer.from_file(packing_tokenizer())


def whole(reference, text):
    return np.array([*reference.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def test_word_ids_equal_whole_texts(reference):
    rng = random.Random(4)
    alphabet = "aAbZéÉßΣς'.,!1²٣ \n\t ́日한ſİ|*<>"
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(1500)]
    words = packing.WordTokenizer(packing_tokenizer(), memory=300)
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        got = words.ids([t.encode() for t in some])
        for text, ids in zip(some, got, strict=True):
            assert ids == whole(reference, text)[:-1].tobytes(), repr(text)


def test_every_id_is_packed_once(spark, reference):
    rng = random.Random(9)
    vocabulary = ["the", "Of", "walking,", "überall", "x9", "naïve.", "re-use", "###"]
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    rows += [(100 + i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 900)))) for i in range(250)]
    rows += [(7, "again and again"), (7, "again and again"), (None, "no id"), (900, "long " * 9000), (901, "a" * 30_000)]
    out = [r.asDict() for r in packing.pack(table(spark, rows), packing_tokenizer(), group=128).collect()]
    want = sorted(
        ((d, start, length, zlib.crc32(ids[start : start + length].tobytes()), len(ids)) for d, t in rows for ids in [whole(reference, t)] for start, length in packing.cut(len(ids))),
        key=repr,
    )
    assert sorted(((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in out), key=repr) == want
    windows = {}
    for r in out:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    tokens = sum(r["length"] for r in out)
    assert len(windows) * packing.CAPACITY <= 1.05 * tokens


def test_empty_table(spark):
    assert packing.pack(table(spark, []), packing_tokenizer()).collect() == []


def test_differencing_is_near_equal_and_complete():
    rng = random.Random(1)
    for count, windows in ((1, 1), (3, 5), (200, 7), (400, 90)):
        sizes = [rng.randint(1, 500) for _ in range(count)]
        out = packing.difference(sizes, windows)
        assert sorted(i for items in out for i in items) == list(range(count)) and len(out) == windows
        sums = [sum(sizes[i] for i in items) for items in out]
        assert max(sums) - min(sums) <= max(sizes)
    # The known outcome of the differencing method, which is two from the best split.
    assert sorted(sum([4, 5, 6, 7, 8][i] for i in items) for items in packing.difference([4, 5, 6, 7, 8], 2)) == [14, 16]


def test_windows_rise_when_the_capacity_is_exceeded():
    # Three pieces of 60 fit two windows of 100 by their sum, but not whole.
    out = packing.pack_group([60, 60, 60], capacity=100)
    assert sorted(map(len, out)) == [1, 1, 1]
    assert packing.pack_group([], capacity=100) == []


def test_cut_covers_every_id():
    for tokens in (1, 511, 512, 513, 2047, 2048, 2049, 4096, 5000):
        at = 0
        for start, length in packing.cut(tokens):
            assert start == at and 0 < length <= 2048
            at += length
        assert at == tokens


def test_words_cut_into_pretokens_give_the_same_ids():
    words = packing.WordTokenizer(packing_tokenizer(), memory=50)
    assert words.cuts
    settled = [chr(c) for c in range(0x2028) if packing._SETTLED.fullmatch(chr(c))] + ["€", "İ", "K", "á", "́", "日"]
    texts = [f"{c} a{c}b{c}{c} {c}1 {c}s '{c}s {c}'S x{c}'re9{c}{c.upper()}a!'s" for c in settled]
    texts += ["deadBEEF0123 9f3a-77b2/x_y=z==", "don't we'll 'twas''s !'d", "a\x1cb\x1f\x85c\xa0d e", "l'été №5 ½ ² ǅ ß ŉ"]
    raw = [t.encode() for t in texts]
    for _ in range(2):  # from what was remembered, too
        for at in range(0, len(raw), 40):
            got = words.ids(raw[at : at + 40])
            assert [t for t, x in zip(texts[at : at + 40], got, strict=True) if x != words.whole(t)] == []

"""Tokenizer alignment against a plain version over small texts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cantiga.llm import align
from cantiga.llm.queries import aligned_tokenizers

SCHEMA = "doc_id bigint, text string, row string, id int, same string, digest int"
TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "The quick brown fox jumps over the lazy dog.", None, "", " ", "  two  spaces\n\n\ttabs ",
    "Ärger über Öl, été à l'été, año ñandú", "<|endoftext|> and <s> and </s> <unk> <0x41>", "日本語のテキスト と 한국어", "12345678901234567890 3.14159",
    "x▁y", "emoji 👩‍👩‍👧 ok", "a" * 3000, "ab" * 2000 + "é" * 500, "deadbeef0123456789abcdef" * 20, "don't we'll THEY'RE", "\x00\x01\x7f", "ﬁ ligature ½ Ⅷ", "“quoted” – dash… €5",
]


@pytest.fixture(scope="module")
def tokenizers():
    paths = aligned_tokenizers()
    return paths, align.ByteTokenizer(paths[0]), align.PieceTokenizer(paths[1])


def brute(texts, a, b):
    """Per text the groups as lists of ids, by the slow tokenizer; none where bytes differ."""
    out = []
    for text in texts:
        groups = []
        if text:
            whole = (" " + text).encode()
            ids_a = a.slow.encode(" " + text, add_special_tokens=False).ids
            ids_b = b.model.encode(text)
            if b"".join(a.bytes[i] for i in ids_a) == whole == b"".join(b.bytes[i] for i in ids_b):
                i = j = at_a = at_b = 0
                left, right = [], []
                while i < len(ids_a) or j < len(ids_b):
                    if at_a <= at_b:
                        left.append(ids_a[i])
                        at_a += len(a.bytes[ids_a[i]])
                        i += 1
                    else:
                        right.append(ids_b[j])
                        at_b += len(b.bytes[ids_b[j]])
                        j += 1
                    if at_a == at_b and left and right:
                        groups.append((left, right))
                        left, right = [], []
                assert not left and not right
        out.append(groups)
    return out


def counted(cut):
    documents = Counter(p for groups in cut for p in {(x, y) for left, right in groups for x in left for y in right})
    most = defaultdict(int)
    for (x, _), n in documents.items():
        most[x] = max(most[x], n)
    return documents, most


def rows_of(ids, cut):
    documents, most = counted(cut)
    for doc, groups in zip(ids, cut, strict=True):
        links = [(x, y) for left, right in groups for x in left for y in right]
        written = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        yield (
            doc, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
            sum(documents[p] == most[p[0]] for p in links), sum(documents[p] for p in links),
            hashlib.sha256(written.encode()).hexdigest() if groups else "",
        )


@pytest.mark.parametrize("limits", [None, "small"])
def test_alignment_equals_brute_force(spark, tokenizers, monkeypatch, limits):
    paths, a, b = tokenizers
    if limits:
        monkeypatch.setattr(align, "BROADCAST_PAIRS", 0)
    ids = [None if i == 3 else 7 if i in (4, 5) else i for i in range(len(TEXTS))]
    docs = spark.createDataFrame([(d, t, "r", 1, "s", 2) for d, t in zip(ids, TEXTS, strict=True)], SCHEMA)
    pairs, per_text = align.align(docs.repartition(3), *paths)
    cut = brute(TEXTS, a, b)
    assert sum(map(bool, cut)) >= 12 and not cut[TEXTS.index("x▁y")]
    assert sorted(map(repr, map(tuple, per_text.collect()))) == sorted(map(repr, rows_of(ids, cut)))
    documents, most = counted(cut)
    found = {(r["a"], r["b"]): (r["documents"], r["best"]) for r in pairs.collect()}
    assert found == {p: (n, n == most[p[0]]) for p, n in documents.items()}


def test_small_pieces_of_work_give_the_same(tokenizers, monkeypatch):
    paths, a, b = tokenizers
    cut = align._Cut(a, b)
    raw = [None if t is None else t.encode() for t in TEXTS]
    whole = cut.cut(raw)
    monkeypatch.setattr(align, "PAIRS_AT_ONCE", 5)
    again = cut.cut(raw)
    for name in ("same", "pairs"):
        assert all(np.array_equal(x, y) for x, y in zip(whole[name], again[name], strict=True))


def test_a_long_run_without_a_common_end_is_one_group(tokenizers):
    """Ids of a group are counted before they are crossed, so a long group stays small."""
    _, a, b = tokenizers
    cut = align._Cut(a, b)
    ids = [np.array([300] * 5000), np.array([400] * 5001)]
    group = [np.zeros(5000, dtype=np.int64), np.zeros(5001, dtype=np.int64)]
    found = list(cut._crossed(ids, group, np.array([True]), np.array([0])))
    assert [[x.tolist() for x in f] for f in found] == [[[0], [300], [400], [5000 * 5001]]]


def test_empty_table(spark, tokenizers):
    pairs, per_text = align.align(spark.createDataFrame([], SCHEMA), *tokenizers[0])
    assert pairs.collect() == [] and per_text.collect() == []


def test_the_fast_tokenizer_gives_the_same_ids(tokenizers):
    _, a, _ = tokenizers
    assert a.fast is not None
    settled = [chr(c) for c in range(0x2028) if not align._SETTLED.search(chr(c))] + ["€"]
    assert len(settled) > 590
    texts = [t for c in settled for t in (f" {c}", f" a{c}b{c}{c} {c}1 {c}{c}\n{c}", f" '{c}s  {c}", f" {c} " + c * 40)]
    slow = [e.ids for e in a.slow.encode_batch_fast(texts, add_special_tokens=False)]
    fast = [a.fast.encode_ordinary(t) for t in texts]
    assert [t for t, x, y in zip(texts, slow, fast, strict=True) if x != y] == []


def test_identity_map_prefers_pieces_to_bytes(tokenizers):
    _, a, b = tokenizers
    same = align.identity_map(a.bytes, b.bytes, b.order)
    letter = a.bytes.index(b"e")
    assert b.bytes[same[letter]] == b"e" and not b.model.is_byte(int(same[letter]))
    assert (same >= 0).sum() > 10_000

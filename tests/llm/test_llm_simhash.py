"""SimHash fingerprints, and their links against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from cantiga.llm import simhash
from cantiga.llm.links import CHUNK

SCHEMA = "doc_id bigint, text string, fp string, id string, first int"


def table(spark, rows):
    return spark.createDataFrame([(d, t, "f", None, 1) for d, t in rows], SCHEMA)


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(count, linked):
    root = list(range(count))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(count):
        for b in range(a):
            if linked(a, b):
                root[max(top(a), top(b))] = min(top(a), top(b))
    return [top(i) for i in range(count)]


TEXTS = ["", " \t\r\n", "One", "one two", "A b  c", "a\u00a0b c d", "ÀÉ x Y z", "x " * 50, "Straße İI ſ K\u212a end", None]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_is_as_defined(text):
    assert simhash.fingerprint(text.encode() if text else None) == plain_fingerprint(text)


def test_spark_hash_agrees(spark):
    from pyspark.sql import functions as F

    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_long_texts_are_read_whole():
    words = [f"w{i}" for i in range(70_000)]
    text = " ".join(words)
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_links_of_fingerprints_equal_brute_force(spark):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for fp in list(fps):
        for _ in range(3):
            fp ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
            fps.add(fp)
    # A grid point with more fingerprints than fit a chunk: all with two bits set.
    fps |= {(1 << a) | (1 << b) for a in range(36) for b in range(a)}
    assert sum(1 for a in range(36) for b in range(a)) > CHUNK
    signed = [x - 2**64 if x >= 2**63 else x for x in sorted(fps)]
    values = np.array(signed, dtype=np.int64).view(np.uint64)
    expected = roots(len(values), lambda a, b: int(values[a] ^ values[b]).bit_count() <= 2)
    found = dict(simhash.link_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp bigint")).collect())
    groups = {}
    for i, r in enumerate(expected):
        groups.setdefault(r, []).append(signed[i])
    want = {x: min(g) for g in groups.values() if len(g) > 1 for x in g}
    assert found == want


def test_documents_with_nulls_copies_and_ties(spark):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(9, base), (4, base), (4, base), (7, base.replace("word9 ", "other ")), (None, base), (2, None), (8, ""), (1, "a b c"), (None, "lone text here")]
    got = sorted(map(tuple, simhash.near_duplicate_texts(table(spark, rows)).collect()), key=repr)
    fps = [plain_fingerprint(t) for _, t in rows]
    group = roots(len(rows), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    least = {}
    for (d, _), g in zip(rows, group, strict=True):
        least[g] = min([x for x in (least.get(g), d) if x is not None], default=None)
    assert got == sorted(((d, f"{f:016x}", least[g]) for (d, _), f, g in zip(rows, fps, group, strict=True)), key=repr)


def test_empty_tables(spark):
    assert simhash.near_duplicate_texts(table(spark, [])).collect() == []

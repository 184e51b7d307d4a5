"""Vector codes against a plain version with whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from cantiga.llm import codes

SCHEMA = "vec_id bigint, embedding array<double>, label int, code string, id string, v int"


def table(spark, rows):
    """Rows of ``(vec_id, embedding, label)`` with extra columns of clashing names."""
    return spark.createDataFrame([(*r, "x", "y", 7) for r in rows], SCHEMA)


def brute(rows, parts, entries, rounds, scale=256):
    good = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    first = min((r for r in good if r[0] is not None and len(r[1]) % parts == 0), key=lambda r: (r[0], r[1]), default=None)
    if first is None:
        return [], []
    width = len(first[1]) // parts
    good = [r for r in good if len(r[1]) == len(first[1])]
    cut = [[tuple(math.floor(scale * x) for x in r[1][p * width : (p + 1) * width]) for p in range(parts)] for r in good]
    order = sorted((i for i, r in enumerate(good) if r[0] is not None), key=lambda i: (good[i][0], good[i][1]))[:entries]
    books = [[cut[i][p] for i in order] for p in range(parts)]

    def near(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, entry, strict=True)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for c in cut:
                held.setdefault(near(c[p], books[p])[1], []).append(c[p])
            for e, found in held.items():
                books[p][e] = tuple(sum(x) // len(found) for x in zip(*found, strict=True))
    out = []
    for r, c in zip(good, cut, strict=True):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((r[0], r[2], "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    return out, books


def check(spark, rows, parts=4, entries=8, rounds=2):
    coded, books = codes.compress(table(spark, rows), parts, entries, rounds)
    expected, expected_books = brute(rows, parts, entries, rounds)
    assert sorted(map(repr, map(tuple, coded.collect()))) == sorted(map(repr, expected))
    assert [[tuple(map(int, e)) for e in b] for b in books] == expected_books
    labels = {}
    for r in expected:
        labels[r[1]] = labels.get(r[1], 0) + r[3]
    found = codes.label_errors(coded).select("label", "label_error").distinct().collect()
    assert {r["label"]: r["label_error"] for r in found} == labels
    written = ",".join(str(x) for b in expected_books for e in b for x in e)
    assert codes.digest(books) == hashlib.sha256(written.encode()).hexdigest()
    return coded, books


def test_codes_equal_brute_force_with_a_hot_vector_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    hot = [float(x) for x in rng.normal(size=16)]
    rows = [(int(i) * 7 % 1000, hot if i % 3 == 0 else [float(x) for x in rng.normal(size=16)], int(i % 4) if i % 5 else None) for i in range(300)]
    rows += [(5, None, 1), (6, [], 1), (7, [1.0, None] * 8, 1), (8, [float("nan")] * 16, 1), (9, [float("inf")] * 16, 1)]
    # Other lengths, a null id, repeated rows and repeated ids.
    rows += [(2000, [1.0] * 8, 1), (2001, [1.0] * 15, 1), (None, [0.5] * 16, None), rows[4], rows[4], (rows[4][0], [0.25] * 16, 2)]
    coded, books = check(spark, rows)
    one = coded.where("vec_id = 21").first()
    assert len(codes.rebuild(one["code"], books)) == 16


def test_ties_go_to_the_lower_entry_and_unused_entries_stay(spark):
    rows = [(i, [float(i % 2)] * 4, 1) for i in range(6)]
    coded, books = check(spark, rows, parts=2, entries=6, rounds=2)
    assert {r["code"] for r in coded.collect()} == {"0000", "0101"}
    assert [tuple(e) for e in books[0]] == [(0, 0), (256, 256)] * 3


def test_large_numbers_are_exact(spark):
    rows = [(i, [x * 1e12, -x * 3e12], 1) for i, x in enumerate((1.0, 1.5, -2.25, 7.0, 1.0000001))]
    expected, books = brute(rows, 1, 2, 2)
    coded, found = codes.compress(table(spark, rows), 1, 2, 2)
    assert [[tuple(map(int, e)) for e in b] for b in found] == books
    got = {r["vec_id"]: (r["code"], r["error"]) for r in coded.collect()}
    assert got == {r[0]: (r[2], min(r[3], 2**63 - 1)) for r in expected}


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (2, [], None)], [(1, [1.0, 2.0, 3.0], 1)]])
def test_without_usable_rows_the_result_is_empty(spark, rows):
    coded, books = codes.compress(table(spark, rows), 2)
    assert coded.collect() == [] and books == []
    assert codes.label_errors(coded).collect() == []


def test_blocks_of_any_size_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 1) for i in range(60)]
    whole = sorted(map(tuple, codes.compress(table(spark, rows), 2, 4)[0].collect()))
    monkeypatch.setattr(codes, "BLOCK_NUMBERS", 40)
    assert sorted(map(tuple, codes.compress(table(spark, rows), 2, 4)[0].collect())) == whole


def test_a_table_of_squared_differences_serves_all_rows():
    matrix = np.array([[3, -2], [3, 5], [-4, 5]])
    values, code = codes.value_dictionaries(matrix)
    assert [v.tolist() for v in values] == [[-4, 3], [-2, 5]]
    entries = np.array([[0, 0], [3, 5]])
    assert codes.squared_differences(values, entries)[0].tolist() == [[16, 49], [9, 0]]
    index, distance = codes.nearest(values, code, entries)
    assert index.tolist() == [0, 1, 0 if 16 + 25 < 49 else 1] and distance.tolist() == [13, 0, 41]

"""Benchmark passages in documents against a plain version."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from cantiga.llm import leaks

SCHEMA = "doc_id bigint, text string, leak string, row int, digest string, spans int, at int"
ITEMS = "item_id bigint, text string, digest string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def brute(docs, items, window=10):
    grams = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1) if n else []:
            grams.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found |= {str(x) for x in grams[tuple(w[i : i + n])] if x is not None}
        out.append((doc, len(w), hit, sorted(found)))
    return out


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(*d, "x", 1, "d", 2, 3) for d in docs], SCHEMA),
        spark.createDataFrame([(*i, "d") for i in items], ITEMS),
    )


def some_words(start, count):
    return " ".join(f"w{i}" for i in range(start, start + count))


ITEM_ROWS = [
    (1, some_words(0, 14)), (2, "Three SHORT words"), (10, some_words(5, 10)), (3, None), (4, ""), (5, "?!, ."),
    (6, "Ärger über Öl: été à l'été où 9 x 7 = 63 noël"), (7, some_words(0, 14)), (None, some_words(40, 10)), (8, some_words(300, 9)),
]
DOC_ROWS = [
    (1, f"Before it. {some_words(0, 14).upper()}! After; it."),
    (2, "nothing here"), (3, None), (4, ""), (5, "\x00\x7f ,,, "),
    (6, "three short, words - and THREE\nSHORT\twords"), (7, "three short word"),
    (8, f"{some_words(3, 10)} {some_words(5, 9)}"), (8, f"{some_words(3, 10)} {some_words(5, 9)}"),
    (None, f"x {some_words(40, 10)} y"), (9, some_words(41, 9)),
    (10, "ärger über Öl été à l été où 9 x 7 63 noël; ÄRGER"), (11, "Ärger über Öl: été à l'été où 9 x 7 = 63 noël"),
    (12, " ".join([some_words(0, 12), "gap"] * 400)), (13, some_words(300, 9)), (13, some_words(300, 8)),
]


def expected_rows(docs, items, window=10):
    return sorted(repr((d, n, len(hit), found)) for d, n, hit, found in brute(docs, items, window))


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("window", [10, 2])
def test_hits_equal_brute_force(spark, monkeypatch, broadcast, window):
    if not broadcast:
        for name in ("BROADCAST_WINDOWS", "BROADCAST_TEXTS"):
            monkeypatch.setattr(leaks, name, 0)
    docs, items = tables(spark, DOC_ROWS, ITEM_ROWS)
    found = leaks.leak_report(docs, items, window=window)
    assert found.columns == ["doc_id", "n_words", "n_hit", "items", "spans"]
    got = sorted(repr((r["doc_id"], r["n_words"], r["n_hit"], r["items"])) for r in found.collect())
    assert got == expected_rows(DOC_ROWS, ITEM_ROWS, window)


def test_spans_are_removed_and_other_columns_stay(spark):
    docs, items = tables(spark, DOC_ROWS, ITEM_ROWS)
    cleaned = leaks.decontaminate(docs, items)
    assert cleaned.columns == [*docs.columns, "_leak"]
    rows = cleaned.collect()
    assert len(rows) == len(DOC_ROWS)
    assert {(r["leak"], r["row"], r["digest"], r["spans"], r["at"]) for r in rows} == {("x", 1, "d", 2, 3)}
    kept = {r["doc_id"]: r["text"] for r in rows}
    assert kept[1] == "Before it. ! After; it."
    assert kept[2] == "nothing here" and kept[3] is None and kept[4] == "" and kept[5] == "\x00\x7f ,,, "
    assert kept[6] == " - and " and kept[7] == "three short word"
    assert words(kept[12]) == ["gap"] * 400
    for (_, text), (_, _, hit, _) in zip(DOC_ROWS, brute(DOC_ROWS, ITEM_ROWS), strict=True):
        left = [w for i, w in enumerate(words(text)) if i not in hit]
        assert left in [words(r["text"]) for r in rows]


def test_documents_are_removed_or_left(spark):
    docs, items = tables(spark, DOC_ROWS, ITEM_ROWS)
    clean = sorted(repr(d) for d, _, hit, _ in brute(DOC_ROWS, ITEM_ROWS) if not hit)
    gone = leaks.decontaminate(docs, items, remove="documents").select("doc_id", "text").collect()
    assert sorted(repr(r[0]) for r in gone) == clean
    assert leaks.decontaminate(docs, items, remove="nothing").select("text").exceptAll(docs.select("text")).count() == 0
    with pytest.raises(ValueError):
        leaks.decontaminate(docs, items, remove="words")


def test_empty_tables(spark):
    docs, items = tables(spark, DOC_ROWS, ITEM_ROWS)
    assert leaks.leak_report(docs.limit(0), items).collect() == []
    assert leaks.leak_report(docs, items.limit(0)).where("n_hit > 0 or size(items) > 0").collect() == []
    assert leaks.decontaminate(docs, items.limit(0)).count() == len(DOC_ROWS)


def test_equal_hashes_are_compared_word_by_word(spark, monkeypatch):
    """With a hash that is the same for all windows only the words decide."""
    monkeypatch.setattr(leaks.F, "xxhash64", lambda *cols: F.lit(1).cast("bigint"))
    docs, items = tables(spark, DOC_ROWS[:11], ITEM_ROWS)
    got = sorted(repr((r["doc_id"], r["n_words"], r["n_hit"], r["items"])) for r in leaks.leak_report(docs, items).collect())
    assert got == expected_rows(DOC_ROWS[:11], ITEM_ROWS)


def test_the_query_digests_items(spark, tmp_path):
    from cantiga.llm.queries import op12_decontamination

    docs, items = tables(spark, DOC_ROWS, ITEM_ROWS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: r for r in op12_decontamination(spark, str(tmp_path)).collect()}
    assert got[1]["items_sha256"] == hashlib.sha256(b"1,7").hexdigest() and got[1]["n_items"] == 2
    assert got[2]["items_sha256"] == hashlib.sha256(b"").hexdigest() and not got[2]["contaminated"]
    assert got[None]["n_hit"] == 10 and got[None]["n_items"] == 0 and got[None]["contaminated"]


def test_no_python_on_the_main_path(spark):
    docs, items = tables(spark, DOC_ROWS, ITEM_ROWS)
    plan = leaks.leak_report(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_only_words_are_lower_cased(spark):
    """Lower-casing every whole text that is not plain ASCII, character by character, took much of the time."""
    texts = ["A É bÇ-Z_9 Ünï İ", "PLAIN only", "", None, "\x00A\x7fB Æ𝐀B"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = df.select("i", leaks.words(F.col("t")).alias("w"), F.size(leaks.runs(F.col("t"))).alias("n")).orderBy("i").collect()
    assert [r["w"] for r in found] == [["a", "É", "bÇ", "z", "9", "Ünï", "İ"], ["plain", "only"], [], [], ["a", "b", "Æ𝐀b"]]
    assert [r["n"] for r in found] == [len(r["w"]) for r in found]
    # All characters of ASCII, and some at the ends of the ranges beyond.
    every = "".join(chr(c) + "m" * (c % 2) for c in [*range(1, 0x101), 0x7FF, 0x800, 0xD7FF, 0xE000, 0xFFFF, 0x10000, 0x10FFFF])
    one = spark.createDataFrame([(every, )], "t string").select(leaks.words(F.col("t"))).first()[0]
    assert one == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in every))
    plan = df.select(F.size(leaks.runs(F.col("t"))))._jdf.queryExecution().optimizedPlan().toString()
    assert "lower" not in plan and "translate" not in plan

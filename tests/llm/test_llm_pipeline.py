"""The pipeline stage by stage, the registered queries, and their SQL."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from cantiga.llm import packing, simhash
from cantiga.llm.expected import EXPECTED
from cantiga.llm.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
needs_data = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not there")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_every_operator_is_registered():
    names = entry_point.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(EXPECTED) <= set(QUERIES)


@needs_data
@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("embeddings", "documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    expected = connection.execute(EXPECTED[name])
    columns = [c[0] for c in expected.description]
    got = QUERIES[name](spark, str(DATA)).select(columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected.fetchall(), key=repr)


@needs_data
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(EXPECTED)))
def test_query_covers_its_table(spark, name):
    table, key = ("pages", "page_id") if name.startswith("op5") else ("documents", "doc_id")
    ids = {r[0] for r in spark.read.parquet(f"{DATA}/{table}.parquet").select(key).collect()}
    out = QUERIES[name](spark, str(DATA)).select(key).collect()
    assert {r[0] for r in out} == ids and (name.startswith("op6") or len(out) == len(ids))


@needs_data
def test_stages_on_their_own_input(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    tables = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(DATA)).write.parquet(f"{tmp_path}/{name}")
        docs = tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "pack":
            assert docs.columns == corpus_pipeline.COLUMNS
    texts = {n: {r["doc_id"]: r["text"] for r in t.collect()} for n, t in tables.items() if n != "pack"}

    known = [d for d in texts["documents"] if d in labels]
    wrong = [d for d in known if (d in texts["quality"]) != (labels[d] == 1)]
    assert len(wrong) <= 0.05 * len(known)

    assert set(texts["line_dedup"]) <= set(texts["quality"])
    for d, text in texts["line_dedup"].items():
        rest = iter(texts["quality"][d].split("\n"))
        assert all(line in rest for line in text.split("\n")) if text else True

    kept = {d: t.encode() for d, t in texts["near_dedup"].items()}
    prints = {d: simhash.fingerprint(t.encode()) for d, t in texts["line_dedup"].items()}
    near = lambda d, e: d != e and (prints[d] ^ prints[e]).bit_count() <= 2
    for d in set(prints) - set(kept):
        assert any(near(d, e) for e in prints)
    assert not any(near(d, e) for d in kept for e in kept)

    assert set(texts["mix"]) <= set(kept) and all(texts["mix"][d].encode() == kept[d] for d in texts["mix"])
    words = lambda t: len(t.encode().split())
    copies = tables["mix"].groupBy("doc_id").count().collect()
    assert max(r["count"] for r in copies) <= 3
    mixed = sum(words(texts["mix"][r["doc_id"]]) * r["count"] for r in copies)
    assert abs(mixed - sum(map(words, texts["near_dedup"].values()))) <= 25 * max(map(words, texts["near_dedup"].values()))

    pieces = tables["pack"].collect()
    rows = tables["mix"].groupBy("doc_id").count().collect()
    tokens = {p["doc_id"]: p["doc_tokens"] for p in pieces}
    assert sum(p["length"] for p in pieces) == sum(tokens[r["doc_id"]] * r["count"] for r in rows)
    assert all(p["offset"] + p["length"] <= packing.CAPACITY for p in pieces)


def test_stages_on_odd_rows(spark, tmp_path):
    rows = [
        (1, None, None, None, None), (None, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "one line\nand one more line of it", "en", "a", 3),
        (3, "one line\nand one more line of it", "en", "a", 3), (4, "one line\nand one more line of it", "fr", None, 3), (5, "x " * 50_000, "en", "b", 9),
        (None, "a text without a number", None, "b", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    spark.createDataFrame([(3, 1, 0), (None, 0, 0), (5, None, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    counts = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        counts[name] = docs.count()
    assert counts["quality"] == 8  # one class of labels rejects nothing
    assert counts["line_dedup"] == 7  # the copy of document 4 goes; equal rows stay equal
    assert counts["near_dedup"] == 4  # 1 for the texts without words, 3, 5, and the one without an id
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == counts["pack"]


def test_stages_on_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_dedup_keeps_a_row_of_each_group(spark):
    words = lambda p, n=40: " ".join(f"{p}{i}" for i in range(n))
    rows = [
        (None, words("a"), "en", "s", 1), (None, words("b"), "en", "s", 1), (None, words("B"), "en", "s", 1), (7, words("c"), "en", "s", 1),
        (7, words("d"), "en", "s", 1), (None, words("e"), "en", "s", 1), (9, words("E"), "en", "s", 1), (8, words("f"), "en", "s", 1),
        (8, words("f"), "en", "s", 1), (8, words("f"), "en", "t", 1), (8, words("F"), "en", "s", 1),
    ]
    out = corpus_pipeline.dedup_near(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    groups = sorted(r["text"][0].lower() for r in out)
    assert groups == list("abcdef") and {r["doc_id"] for r in out if r["text"][0] in "eE"} == {9}


CLASHING = [
    "mark", "_copy", "copies", "_id", "_row", "_n", "_mark", "n_lines", "n_deleted", "_runs", "score", "predicted", "_stats", "doc", "row",
    "n", "runs", "stats", "root", "fp", "copy", "size",
]


@pytest.mark.parametrize("turn", range(4))
def test_columns_of_any_name_pass_through(spark, tmp_path, turn):
    rows = [(i, f"some text number {i} of these\nand a line of five words", "en", f"s{i % 2}", 9, *[f"{i}{c}" for c in CLASHING]) for i in range(6)]
    docs = spark.createDataFrame(rows, SCHEMA + "".join(f", {c} string" for c in CLASHING))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.STAGES[turn][1](spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    found = out.collect()
    assert found and all(r[c] == f"{r['doc_id']}{c}" for r in found for c in CLASHING)

"""Line dedup against a plain search for the longest earlier copies."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cantiga.llm import lines

SCHEMA = "doc_id bigint, text string, n_lines string, mark int, pos string, n_deleted int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "n", 1, "p", 2) for r in rows], SCHEMA)


def plain(rows, min_words=5):
    """Texts without later copies, for rows in their order."""
    docs = [t.split("\n") if t is not None else [] for _, t in rows]
    where = defaultdict(list)
    for d, own in enumerate(docs):
        for p, line in enumerate(own):
            where[line].append((d, p))
    out = []
    for d, own in enumerate(docs):
        runs = []
        for p, line in enumerate(own):
            longest = 0
            for e, q in where[line]:
                if (e, q) >= (d, p):
                    break
                n = 0
                while p + n < len(own) and q + n < len(docs[e]) and own[p + n] == docs[e][q + n]:
                    n += 1
                longest = max(longest, n)
            if longest and runs and p < runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], p + longest)
            elif longest:
                runs.append([p, p + longest])
        gone = {i for a, b in runs if sum(len(x.encode().split()) for x in own[a:b]) >= min_words for i in range(a, b)}
        out.append(("\n".join(x for i, x in enumerate(own) if i not in gone) if rows[d][1] is not None else None, len(own), len(gone)))
    return out


def check(spark, rows, min_words=5):
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_deleted"]) for r in lines.dedup_lines(table(spark, rows), min_words=min_words).collect()}
    assert got == {d: want for (d, _), want in zip(rows, plain(rows, min_words), strict=True)}


def test_random_runs_over_few_lines(spark):
    rng = random.Random(6)
    vocabulary = ["", "a b c", "one two three four five six", "x", "x ", "tail of a line", "é è", "p q r s t u v", "end"]
    rows = []
    for d in range(60):
        own = [rng.choice(vocabulary) if rng.random() < 0.6 else f"unique line number {rng.randrange(10**9)}" for _ in range(rng.randint(1, 25))]
        if d > 10 and rng.random() < 0.5:
            other = rows[rng.randrange(d)][1].split("\n")
            at = rng.randrange(len(other))
            own[rng.randrange(len(own)) : 1] = other[at : at + rng.randint(1, 20)]
        rows.append((d, "\n".join(own)))
    check(spark, rows)
    check(spark, rows, min_words=1)


def test_long_copies_and_repeats_inside_a_text(spark):
    long = "\n".join(f"line {i} of the long text" for i in range(700))
    block = "\n".join(["alpha beta gamma"] * 90)
    check(spark, [(1, long), (2, long), (3, "new first line\n" + long + "\nnew last line here now"), (4, block), (5, block + "\n" + block), (6, "\n\n\n"), (7, "\n\n\n")])


def test_nulls_empty_texts_and_repeated_rows(spark):
    text = "a b c d e f\nsecond line that is long enough"
    rows = [(3, None), (4, ""), (5, text), (5, text), (6, text), (None, text), (None, None), (7, "A b c d e f")]
    got = sorted(((r["doc_id"], r["text"], r["n_deleted"]) for r in lines.dedup_lines(table(spark, rows)).collect()), key=repr)
    # A row without an id comes first, and equal rows are treated alike.
    want = [(3, None, 0), (4, "", 0), (5, "", 2), (5, "", 2), (6, "", 2), (None, text, 0), (None, None, 0), (7, "A b c d e f", 0)]
    assert got == sorted(want, key=repr)


def test_empty_table_and_kept_columns(spark):
    out = lines.dedup_lines(table(spark, []))
    assert out.collect() == [] and out.columns == ["doc_id", "text", "mark", "pos", "n_lines", "n_deleted"]


@pytest.mark.parametrize("bucket_rows", [lines.BUCKET_ROWS, 2])
def test_ranks_are_a_suffix_array(spark, bucket_rows):
    rng = random.Random(2)
    rows = [(d, "\n".join(rng.choice("abc") for _ in range(12))) for d in range(8)]
    marked = table(spark, rows).select("doc_id", lines.text_mark(F.col("doc_id"), F.col("text")).alias("mark"), "text")
    ranks = {(r["doc_id"], r["pos"]): r["r"] for r in lines.suffix_ranks(lines._lines(marked), bucket_rows).collect()}
    names = {r["h1"]: r["line"] for r in spark.sql("SELECT line, xxhash64(line) AS h1 FROM VALUES ('a'), ('b'), ('c') AS t(line)").collect()}
    order = {line: i for i, (_, line) in enumerate(sorted(names.items(), key=lambda x: x[0] % 2**64))}
    suffixes = {(d, p): [order[x] for x in t.split("\n")[p:]] for d, t in rows for p in range(12)}
    for at, suffix in suffixes.items():
        assert ranks[at] == 1 + sum(other < suffix for other in suffixes.values())

"""Quality rules, context trees and the secret scan against plain definitions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cantiga.llm import ctw, quality, secrets

SCHEMA = "doc_id bigint, text string, score string, held_out string, label int, n string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "s", "h", 1, "n") for r in rows], SCHEMA)


# Quality.


def corpus(count, seed=1):
    rng = random.Random(seed)
    words = ["river", "stone", "Light", "over", "the", "and", "walks,", "home."]
    rows, labels = [], []
    for i in range(count):
        text = " ".join(rng.choices(words, k=rng.randint(5, 80)) + [f"w{rng.randrange(999)}" for _ in range(20)])
        bad = i % 4 == 0
        if bad:
            text = [text.upper() + "!!", re.sub(r" ", "### ", text), "spam " * 40, " | ".join(text.split())][i // 4 % 4]
        rows.append((i, text))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_quality_on_held_out_rows(spark):
    rows, labels = corpus(800)
    extra = [(None, 1, 0), (5, None, 0), (10_000, 1, 0), (3, 7, 1)]
    named = spark.createDataFrame(labels + extra, "doc_id bigint, quality int, toxic int")
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    ensemble = quality.learn(table(spark, rows), named, ~quality.held_out(F.col("id"), 5, 0))
    out = quality.score_quality(table(spark, rows + [(None, None), (7001, ""), (7002, "x " * 200_000)]), ensemble).collect()
    assert len(out) == len(rows) + 3 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    wrong = [r for r in out if r["doc_id"] in held and r["predicted"] != int(r["doc_id"] % 4 != 0)]
    assert len(held) > 100 and len(wrong) <= 0.03 * len(held)
    # The compiled column is the ensemble as written.
    for r in out[:50]:
        stats = dict(zip(quality.STATISTICS, quality.statistics((r["text"] or "").encode()), strict=True))
        total = ensemble.intercept + sum(x.weight for x in ensemble.rules if all((stats[n] > limit) == above for n, above, limit in x.conditions))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)))


def test_quality_without_labels_or_rows(spark):
    rows, labels = corpus(60)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    same = spark.createDataFrame([(i, 1) for i, _, _ in labels], "doc_id bigint, quality int")
    assert quality.learn(table(spark, rows), none).rules == ()
    ensemble = quality.learn(table(spark, rows), same)
    assert ensemble.rules == () and quality.score_quality(table(spark, rows), ensemble).where("predicted = 1").count() == 60
    assert quality.score_quality(table(spark, []), ensemble).collect() == []


def test_statistics_of_whole_texts():
    assert quality.statistics(None) == quality.statistics(b" \n") == (0.0,) * len(quality.STATISTICS)
    stats = dict(zip(quality.STATISTICS, quality.statistics("AB cd! cd! é9 | #".encode()), strict=True))
    assert stats["repeated_words"] == 1 / 6 and stats["distinct_words"] == 5 / 6 and stats["bars"] == 1 / 6
    assert stats["symbols"] == 1 / 6 and stats["exclaims"] == 2 / 6 and stats["upper"] == 2 / 8 and stats["digits"] == 1 / 13
    long = b"a" * (3 << 20) + b" A"
    assert quality.statistics(long)[5] == 1 / ((3 << 20) + 1)


# Context trees.


def plain_model(streams, depth):
    """Counts of bytes after contexts of every length, as nested dictionaries."""
    counts = Counter()
    for s in streams:
        padded = b"\n" * depth + s
        for i in range(len(s)):
            for d in range(depth + 1):
                counts[padded[i + depth - d : i + depth], padded[i + depth]] += 1
    return counts


def plain_bit(counts, contexts, depth, context, prefix, bit):
    """Probability of a bit after a prefix of bits in a context, by the definition."""

    def tally(c):
        zeros = ones = 0
        for byte, n in contexts.get(c, {}).items():
            bits = f"{byte:08b}"
            if bits.startswith(prefix):
                if bits[len(prefix)] == "1":
                    ones += n
                else:
                    zeros += n
        return zeros, ones

    def log_kt(zeros, ones):
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.log(math.pi) - math.lgamma(zeros + ones + 1)

    def log_pw(c):
        own = log_kt(*tally(c))
        if len(c) == depth:
            return own
        longer = sum(log_pw(x) for x in contexts if len(x) == len(c) + 1 and x.endswith(c))
        return np.logaddexp(own, longer) - math.log(2)

    mixed, rest = 0.0, 1.0
    for d in range(depth + 1):
        c = context[depth - d :]
        zeros, ones = tally(c)
        weight = 1.0 if d == depth else math.exp(log_kt(zeros, ones) - math.log(2) - log_pw(c))
        one = (ones + 0.5) / (zeros + ones + 1)
        mixed += rest * weight * (one if bit else 1 - one)
        rest *= 1 - weight
    return mixed


def test_gram_probabilities_follow_the_definition(spark):
    texts = [b"abab aba", b"abc", b"\xc3\xa9 ab"]
    counts = plain_model([ctw.stream(t)[1] for t in texts], 3)
    contexts = {}
    for (c, byte), n in counts.items():
        contexts.setdefault(c, {})[byte] = n
    # Every byte after two seen contexts and an unseen one: zero counts are requests.
    asked = {(c, b) for c in (b"aba", b"\n\n\n", b"zzb") for b in range(256)} | {k for k in counts if len(k[0]) == 3}
    rows = [(int.from_bytes(c + bytes([b]), "big"), counts.get((c, b), 0)) for c, b in asked]
    got = {r["gram"]: r["log_p"] for r in ctw.gram_probabilities(spark.createDataFrame(rows, "gram bigint, n bigint"), 3).collect()}
    for c in (b"aba", b"\n\n\n", b"zzb"):
        assert sum(math.exp(got[int.from_bytes(c + bytes([b]), "big")]) for b in range(256)) == pytest.approx(1)
    for c, byte in [(b"aba", 98), (b"aba", 10), (b"\n\n\n", 97), (b"zzb", 97), (b"zzb", 200), (b" ab", 97)]:
        if (c, byte) in asked:
            bits = f"{byte:08b}"
            want = sum(math.log(plain_bit(counts, contexts, 3, c, bits[:i], bits[i] == "1")) for i in range(8))
            assert got[int.from_bytes(c + bytes([byte]), "big")] == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("depth", [3, 5])
def test_large_groups_of_contexts_are_cut(spark, depth):
    rng = random.Random(4)
    codes, _ = ctw.grams([ctw.stream("".join(rng.choices("abc ", k=3000)).encode())[1]], depth)
    counts = spark.createDataFrame(sorted(Counter(codes.tolist()).items()), "gram bigint, n bigint")
    whole, cut = ({r["gram"]: r["log_p"] for r in ctw.gram_probabilities(counts, depth, size).collect()} for size in (10**6, 10))
    assert whole.keys() == cut.keys() and len(whole) > 200
    assert all(cut[g] == pytest.approx(whole[g], rel=1e-9) for g in whole)


def test_gram_table_finds_all_and_only_its_own():
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 1 << 48, 5000))
    table = ctw.GramTable(codes, codes.astype(float))
    asked = rng.choice(codes, 20_000)
    assert (table.find(asked) == asked).all() and table.find(codes[:0]).tolist() == []
    with pytest.raises(ValueError, match="without a probability"):
        table.find(np.append(asked, codes.max() + 1))


def test_scores_do_not_depend_on_how_rows_arrive(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(50)]
    docs = table(spark, [(i, " ".join(rng.choices(words, k=rng.randint(0, 20)))) for i in range(300)])
    held = quality.held_out(F.col("doc_id"), 7, 2)
    scores = [
        sorted(map(tuple, ctw.score_texts(d, held, depth=3, block_bytes=200).collect()))
        for d in (docs, docs.repartition(7), docs.orderBy(F.desc("text")))
    ]
    for other in scores[1:]:
        assert [r[:5] for r in other] == [r[:5] for r in scores[0]]
        assert [r[5:] for r in other] == [pytest.approx(r[5:]) for r in scores[0]]


def test_scores_and_base(spark):
    rng = random.Random(3)
    words = ["alpha", "Beta", "gamma,", "delta", "é"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(120)]
    rows += [(200, None), (201, ""), (None, "alpha  beta\tnew"), (202, "unseenword alpha"), (202, "unseenword alpha"), (203, "gamma " * 20_000)]
    held = quality.held_out(F.col("doc_id"), 7, 2)
    small = dict(depth=3, block_bytes=700)
    runs = [ctw.score_texts(table(spark, rows), held, **small, broadcast_grams=b).collect() for b in (10**6, 3)]
    for a, b in zip(*(sorted(r, key=repr) for r in runs), strict=True):
        assert a["score"] == pytest.approx(b["score"]) and a[:6] == b[:6]
    is_held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    tokens = [[*(t or "").lower().encode().split(), b""] for _, t in rows]
    counts = Counter(w for (d, _), ws in zip(rows, tokens, strict=True) if not is_held[d] for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    want = sorted(((d, is_held[d], len(ws), sum(counts[w] > 0 for w in ws), total, sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in ws)) for (d, _), ws in zip(rows, tokens, strict=True)), key=repr)
    got = sorted((tuple(r)[:6] for r in runs[0]), key=repr)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    assert ctw.score_texts(table(spark, []), held).collect() == []


def test_context_trees_learn(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["stone", "river", "window", "garden"], k=40))) for i in range(200)]
    out = ctw.score_texts(table(spark, rows + [(999, "qzx jkv wpf " * 10)]), quality.held_out(F.col("doc_id"), 7, 2)).collect()
    bits = {r["doc_id"]: r["bits_per_byte"] for r in out if r["held_out"] or r["doc_id"] == 999}
    assert zlib.crc32(b"999") % 7 == 2 or 999 in bits
    assert all(b < 0.8 for d, b in bits.items() if d != 999)


# Secrets.

PATTERNS = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
}
TEXTS = [
    None, "", "é password = \"abcdefgh1\" x", "PASSWORD:'short' Token=abc_DEF-123", "toKen=abcdefgh paſsword=abcdefgh1", "AKIA" * 9,
    "AKIAABCDEFGHIJK AKIAABCDEFGHIJKL", "0123456789abcdef" * 3 + "X" + "0" * 31, "api_key==abcdefghij apikey:  12345678 api__key=12345678",
    "token=secret=abcdefgh", "日本 secret=" + "a1" * 20 + " 終", "password=password=12345678", "x" * 100_000 + " passwd: 0123456789",
]


def plain_spans(text):
    found = []
    for kind, (pattern, ok) in PATTERNS.items():
        flags = re.IGNORECASE | re.ASCII if kind == "assign" else 0
        found += [(m.start(), m.end(), kind) for m in re.finditer(pattern, text or "", flags) if ok(m)]
    return sorted(found, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


def test_base_findings(spark):
    rows = list(enumerate(TEXTS)) + [(2, TEXTS[2]), (None, TEXTS[3])]
    out = {r["doc_id"]: r for r in secrets.scan(table(spark, rows), secrets.SecretModel()).collect()}
    for i, text in rows:
        spans = plain_spans(text)
        told = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        row = out[i]
        assert row["base_sha256"] == hashlib.sha256(told.encode()).hexdigest() and row["spans"] == told, text
        assert [row[f"n_{k}"] for k in PATTERNS] == [sum(s[2] == k for s in spans) for k in PATTERNS]
    assert secrets.scan(table(spark, []), secrets.learn(table(spark, []))).collect() == []


def test_candidates_are_in_code_points():
    text = "é abcdef123456 12 日本 zzzzzzzzzzzzzz x.y-z_1/2+3=4"
    assert [text[a:b] for a, b in secrets.candidates(text, text.encode())] == ["abcdef123456", "x.y-z_1/2+3=4"]
    assert secrets.candidates("", b"") == [] and secrets.candidates("no digits at all here", b"no digits at all here") == []


def test_network_learns_what_secrets_look_like(spark):
    rng = random.Random(7)
    hexes = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    rows = []
    for i in range(1500):
        plain = [f"192.168.{rng.randrange(256)}.{rng.randrange(256)}", f"user{rng.randrange(99)}@mail.example.com", f"2024-{rng.randint(10, 12)}-{rng.randint(10, 28)}T10", "order-number-1"][i % 4]
        rows.append((i, f"some words {plain} and " + (f"password={hexes(20)}" if i % 3 == 0 else f'token = "{hexes(40)}"' if i % 3 == 1 else "nothing") + " more"))
    model = secrets.learn(table(spark, rows))
    assert model.network is not None and model.recall >= 0.95 and model.precision >= 0.95
    probe = [(1, f"the access code reads {hexes(24)} here"), (2, "call 192.168.17.23 or user17@mail.example.com"), (3, rows[0][1])]
    out = {r["doc_id"]: r["spans"] for r in secrets.scan(table(spark, probe), model).collect()}
    assert out[1].startswith("network:22:46") and out[2] == "" and out[3].count("assign:") == 1 and "network" not in out[3]


def test_the_network_reads_many_texts_at_once(monkeypatch):
    """A call for each text took most of the scan; what is found does not depend on the texts beside it."""
    rng = np.random.default_rng(3)
    network = secrets.CharacterNetwork(rng)
    windows = rng.integers(0, 96, (200, secrets.WINDOW)).astype(np.uint8)
    plain = network._features(network._responses(windows)) @ network.out
    together = network.logits(windows)
    assert np.allclose(together, plain, atol=1e-4)
    assert (np.concatenate([network.logits(windows[i : i + 3]) for i in range(0, 200, 3)]) == together).all()
    model = secrets.SecretModel(network, threshold=float(np.median(secrets._sigmoid(together))))
    words = ["".join(map(chr, rng.integers(97, 123, rng.integers(1, 60)))) for _ in range(300)]
    texts = ["", "é", *(" é ".join(words[i : i + 7]) for i in range(0, 300, 7)), "token=abcdef123456 " + words[0] * 3]
    texts = [(text, text.encode()) for text in texts]
    one_by_one = [secrets.scan_text(*text, model) for text in texts]
    assert any(kind == "network" for found in one_by_one for *_, kind in found)
    calls = []
    read = secrets.CharacterNetwork.logits
    monkeypatch.setattr(secrets.CharacterNetwork, "logits", lambda self, w: calls.append(len(w)) or read(self, w))
    assert list(secrets._scan_parts(texts, model)) == one_by_one and len(calls) == 1
    monkeypatch.setattr(secrets, "SCAN_BYTES", 100)
    assert list(secrets._scan_parts(texts, model)) == one_by_one and len(calls) > 10


class LooksForX(secrets.CharacterNetwork):
    """Stands for a trained network: a window with an X inside the candidate is a secret."""

    def __init__(self):
        pass

    def logits(self, windows):
        inside = windows[:, secrets.BEFORE : secrets.BEFORE + secrets.INSIDE]
        return np.where((inside == ord("X") - 30).any(axis=1), 9.0, -9.0)


def test_candidates_are_read_whole_and_short_ones_too():
    model = secrets.SecretModel(LooksForX(), threshold=0.5)
    for text in ("see /" + "a/z1" * 30 + "X" + "z" * 50 + " here", "é see " + "z1" * 60 + "X", "got passXphrase there", "got a1Xb2c3d"):
        spans = secrets.scan_text(text, text.encode(), model)
        assert [text[a:b] for a, b, _ in spans] == [w for w in text.split() if "X" in w], text
    assert secrets.scan_text("too sXhort", b"too sXhort", model) == []
    parts = secrets.pieces(5, 306)
    assert parts[0][0] == 5 and parts[-1][1] == 306 and all(b - a == secrets.INSIDE for a, b in parts)
    assert all(c <= b - 20 for (_, b), (c, _) in zip(parts, parts[1:], strict=False))


def test_threshold_keeps_the_asked_recall():
    # Labels that nothing in the window tells: no threshold at 0.5 keeps the recall, and the precision is low.
    rng = np.random.default_rng(3)
    windows = rng.integers(2, 96, (600, secrets.WINDOW)).astype(np.uint8)
    model = secrets.fit(windows, (rng.random(600) < 0.5).astype(float), recall=0.97)
    assert model.network is not None and model.recall >= 0.97 and model.precision < 0.9
    assert secrets.fit(windows[:20], np.zeros(20)).network is None and secrets.fit(windows[:0], np.zeros(0)).network is None


def test_one_finding_is_enough_for_a_network():
    text = "the token=a8f3b27c91de4405 was left behind in " + " ".join(f"chapter{i} ordinary-word{i}" for i in range(40))
    found = secrets.labelled(text, text.encode())
    windows = np.array([np.frombuffer(w, dtype=np.uint8) for w, _ in found])
    label = np.array([float(kind) for _, kind in found])
    assert label.sum() == 1
    model = secrets.fit(windows, label)
    assert model.network is not None and model.recall >= 0.97
    # Kinds left out are no secrets and nothing else.
    assert not any(kind for _, kind in secrets.labelled(text, text.encode(), ("assign",)))
    assert len(secrets.labelled(text, text.encode(), ("assign",))) == len(found) - 1


def test_no_value_is_on_both_sides():
    rng = np.random.default_rng(4)
    windows = rng.integers(2, 5, (400, secrets.WINDOW)).astype(np.uint8)
    windows[:, secrets.BEFORE + 3 : secrets.BEFORE + secrets.INSIDE] = 2
    inside = slice(secrets.BEFORE, secrets.BEFORE + secrets.INSIDE)
    trained, out = ({w[inside].tobytes() for w in part} for part in secrets.split_by_value(windows, rng))
    assert len(trained | out) == 27 and not trained & out and len(out) == 5


def test_gradients_are_those_of_every_character():
    rng = np.random.default_rng(6)
    network = secrets.CharacterNetwork(rng)
    x = rng.integers(0, 96, (30, secrets.WINDOW)).astype(np.uint8)
    x[:, 40:60] = 0
    label, share, n = (rng.random(30) < 0.5).astype(float), np.full(30, 1 / 30), network.FILTERS
    responses = network._responses(x)
    features = network._features(responses)
    error = ((secrets._sigmoid(features @ network.out) - label) * share).astype(np.float32)
    grown = np.zeros_like(responses)
    for i, (a, b) in enumerate(network.PARTS):
        best, mean = (error[:, None] * network.out[None, k * n : (k + 1) * n] for k in (i, i + len(network.PARTS)))
        np.put_along_axis(grown, responses[:, a:b].argmax(axis=1)[:, None] + a, best[:, None], axis=1)
        grown[:, a:b] += mean[:, None] / (b - a)
    grown *= responses > 0
    filters, padded = np.zeros_like(network.filters), np.pad(x, ((0, 0), (2, 2)))
    for i in range(network.WIDTH):
        np.add.at(filters[i], padded[:, i : i + secrets.WINDOW].ravel(), grown.reshape(-1, n))
    for told, plain in zip(network._gradients(x, label, share), (filters, grown.sum(axis=(0, 1)), features.T @ error), strict=True):
        assert np.allclose(told, plain, atol=1e-6)


def kept_in(shards) -> dict[tuple[int, int], list[bytes]]:
    kept = {}
    for r in shards.collect():
        w = zlib.decompress(r["windows"])
        parts = [w[at : at + secrets.WINDOW] for at in range(0, len(w), secrets.WINDOW)]
        assert len(parts) == r["n"] <= secrets.ROW
        kept.setdefault((r["shard"], r["label"]), []).extend(parts)
    return kept


def test_learning_reads_every_window(spark, monkeypatch):
    """4,000 windows of each class at most were learned from, of 20,000 documents."""
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghij", k=12)) for _ in range(5000)]
    texts = [" ".join(words[:2500]), " ".join(words[2500:]), "the token=a8f3b27c91de4405 was left", None, "", " ".join(words[:2500])]
    wanted = {x for text in texts for x in secrets.labelled(text or "", (text or "").encode())}
    given = []
    monkeypatch.setattr(secrets, "fit", lambda w, y: given.append((w, y)))
    secrets.learn(table(spark, list(enumerate(texts))))
    [(windows, label)] = given
    assert len(windows) == len(wanted) > 5000
    assert {(w.tobytes(), int(y)) for w, y in zip(windows, label, strict=True)} == wanted


def test_many_shards_learn_from_every_window_whatever_the_partitions(spark, monkeypatch):
    rng = random.Random(8)
    hexes = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    rows = [(i, f"some words user{i % 97}@mail.example.com order-number-{i % 50} and " + (f'token = "{hexes(28)}"' if i % 8 == 0 else "nothing at present") + " more") for i in range(1600)]
    rows += [(None, None), *rows[:40]]
    wanted = {x for _, text in rows for x in secrets.labelled(text or "", (text or "").encode())}
    seen = []
    dealt = secrets.window_shards
    monkeypatch.setattr(secrets, "SHARD_BYTES", 50_000)
    monkeypatch.setattr(secrets, "window_shards", lambda *args: seen.append(dealt(*args)) or seen[-1])
    one, two = secrets.learn(table(spark, rows).repartition(3)), secrets.learn(table(spark, rows[::-1]).coalesce(1))
    kept = kept_in(seen[0])
    others = [w for (_, label), own in kept.items() if not label for w in own]
    assert len({shard for shard, _ in kept}) == 3 and kept == kept_in(seen[1])
    assert sorted(others) == sorted(w for w, kind in wanted if not kind)
    found = {label: own for (shard, label), own in kept.items() if shard == 0}[1]
    assert {w for (_, label), own in kept.items() if label for w in own} == {w for w, kind in wanted if kind}
    assert len(found) == len(set(found))
    assert np.allclose(one.network.filters, two.network.filters, atol=1e-5) and abs(one.threshold - two.threshold) < 1e-6
    assert one.recall >= 0.97 and one.precision >= 0.95
    probe = f"the access code reads {hexes(28)} here"
    assert [k for *_, k in secrets.scan_text(probe, probe.encode(), one)] == ["network"]
    assert secrets.scan_text(rows[1][1], rows[1][1].encode(), one) == []


def test_one_secret_is_in_every_shard(spark, monkeypatch):
    monkeypatch.setattr(secrets, "SHARD_BYTES", 3_000)
    rows = [(i, f"chapter{i} holds ordinary-word{i % 300} and sentence-{i} of text") for i in range(300)] + [(300, "the token=a8f3b27c91de4405 was left")]
    seen = []
    dealt = secrets.window_shards
    monkeypatch.setattr(secrets, "window_shards", lambda *args: seen.append(dealt(*args)) or seen[-1])
    monkeypatch.setattr(secrets, "train_shards", lambda windows, splits: splits)
    monkeypatch.setattr(secrets, "judge_shards", lambda windows, splits, network: splits)
    splits = secrets.learn(table(spark, rows))
    kept = kept_in(seen[0])
    assert len(kept) > 8 and all(len(own) == 1 for (_, label), own in kept.items() if label)
    assert {shard for shard, label in kept if label} == {shard for shard, label in kept if not label}
    assert splits[1].single and splits[0].fifth


def test_values_are_split_however_few():
    windows = np.zeros((6, secrets.WINDOW), np.uint8)
    windows[:, secrets.BEFORE] = [5, 5, 6, 7, 7, 7]
    v = secrets._values(windows)
    assert len(set(v.tolist())) == 3
    for some in (windows[:2], windows[:3], windows):
        v = secrets._values(some)
        out = int((v % 5 == 0).sum())
        split = secrets._value_split({"n": len(v), "fifth": out, "least": int(v.min()), "most": int(v.max())})
        trained, kept_out = split.sides(some)
        assert len(trained) and len(kept_out)
        both = {w.tobytes() for w in trained} & {w.tobytes() for w in kept_out}
        assert bool(both) == (len(set(v.tolist())) == 1) and (split.single or len(trained) + len(kept_out) == len(some))

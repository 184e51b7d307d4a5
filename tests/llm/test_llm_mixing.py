"""Mixing and URL filter against plain Python."""

import math
import re
from collections import Counter, defaultdict

import pytest

from cantiga.llm import mixing, urls
from cantiga.llm.queries import URL_RULES

SCHEMA = "doc_id bigint, text string, source string, size string, p int, part int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, 2) for r in rows], SCHEMA)


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3.0 * sizes[s] for s in over}


def test_mix_meets_targets_and_repeats(spark):
    rows = [(i, "w " * (1 + i * 37 % 90), ["big", "b", "z", None, "é"][min(4, i % 11)] if i % 3 else "big") for i in range(1500)]
    rows += [(5000, None, "b"), (5001, "", "z"), (5002, " \t", None), (None, "x y", "b"), (5003, "long " * 30_000, "big")]
    rows += [(1, "w w w", "b")] * 5 + [(7000, None, "empty"), (7001, "only one", "tiny")]
    df = table(spark, rows)
    out = [r.asDict() for r in mixing.mix(df).collect()]
    assert len(out) == len(rows)
    size = Counter()
    for _, t, s in rows:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = plain_targets(dict(size))
    by = defaultdict(list)
    for r in out:
        by[r["target"], r["source_size"]].append(r)
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
    assert [x for t in sorted(by) for x in t] == pytest.approx([x for t in sorted((want[s], size[s]) for s in size) for x in t])
    for (target, _), part in by.items():
        # The miss is half of one document.
        assert abs(sum(r["taken"] for r in part) - target) <= max(r["size"] for r in part) / 2 + 1e-6
        whole = math.floor(target / part[0]["source_size"] + 1e-9) if part[0]["source_size"] else 0
        assert {r["copies"] for r in part if r["size"]} <= {whole, whole + 1}
    again = [r.asDict() for r in mixing.mix(df.repartition(3)).collect()]
    key = lambda r: repr(sorted(r.items()))
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_mix_of_nothing(spark):
    assert mixing.mix(table(spark, [])).collect() == []
    rows = mixing.mix(table(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in rows] == [(0, 0.0, 0)] * 2


def test_rounding_keeps_probabilities(spark):
    units = [("a", i, i * 7919, 1 + i % 5, 0.3) for i in range(2000)]
    df = spark.createDataFrame(units, "part string, doc_id bigint, mark bigint, size bigint, p double")
    taken = mixing.pivotal_round(df).collect()
    assert len(taken) == 2000 and abs(sum(r["taken"] * r["size"] for r in taken) - 0.3 * 6000) <= 5
    for size in range(1, 6):  # the share taken does not depend on the size
        part = [r["taken"] for r in taken if r["size"] == size]
        assert abs(sum(part) / len(part) - 0.3) < 0.1


URLS = [
    "http://example.com/en/1", "https://www.Example.com/en/x?q#f", "http://blog.example.com/en/", "http://a.net/es/1", "http://a.net/de/1",
    "http://net/fr/", "http://xnet/fr/", "http://com", "com/en/", None, "", "://", "http://a.com#/en/", "x://h.org/p://q", "http://www.example.com/EN/",
    "HTTP://ÀB.ORG/é?z", "http://a.com?x=/en/", "http://example.com/english/", "a\nb://h.com/\np",
]


def plain_judge(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name), default=None)


def plain_text(url):
    """The whole URL with its host lower-cased."""
    if url is None or "://" not in url:
        return url or ""
    front, rest = url.split("://", 1)
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return front + "://" + re.sub("[A-Z]", lambda m: m[0].lower(), host) + rest[len(host) :]


def pages(spark, items):
    return spark.createDataFrame([(i, u, "t", "s", None) for i, u in items], "page_id bigint, url string, text string, score string, key int")


def test_hosts_paths_and_rules(spark):
    out = {r["page_id"]: r for r in urls.filter_urls(pages(spark, list(enumerate(URLS))), URL_RULES).collect()}
    assert len(out) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule = plain_judge(url)
        row = out[i]
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule and rule.name), url
        assert row["verdict"] == (rule.verdict if rule else row["verdict"]) and row["verdict"] in ("allow", "block")
        assert (row["score"] is None) == (rule is not None)


@pytest.mark.parametrize("hot_rows", [1_000_000, 1])
def test_scores_equal_plain_models(spark, monkeypatch, hot_rows):
    items = [f"http://{h}.com/{p}" for h in ("alpha", "beta", "gam") for p in ("x", "yy", "zzz/1", "q-2", "r")]
    items += [f"http://{h}.net/{lang}/{n}" for h in ("spam", "pills") for lang in ("es", "fr") for n in range(6)]
    items += ["http://alpha.org/x", "http://spam.org/es/3", "http://ünï.org/", "http://alpha.org/x", "nothing"]
    items += ["http://Alpha.org/x?Page=1", "https://alpha.org/x#Part", "ünï, nothing else", None, "", "http://beta.com/x?q=1"]
    monkeypatch.setattr(urls, "HOT_ROWS", hot_rows)
    out = {r["page_id"]: r for r in urls.filter_urls(pages(spark, list(enumerate(items))), URL_RULES, order=3).collect()}
    decided = {}
    for url in items:
        rule = plain_judge(url)[2]
        decided[plain_text(url)] = rule and rule.verdict == "allow"
    held = spark.createDataFrame([(t,) for t in decided], "text string").selectExpr("text", "pmod(xxhash64(text), 5) = 0 AS held").collect()
    held = {r["text"] for r in held if r["held"]}

    def events(text):
        padded = "\u0001" * 3 + text + "\u0002"
        return [(padded[i : i + 3], padded[i + 3]) for i in range(len(text) + 1)]

    counts = {True: Counter(), False: Counter()}
    for text, allow in decided.items():
        if allow is not None and text not in held:
            for context, sym in events(text):
                counts[allow].update((context[3 - k :], sym) for k in range(4))

    def chance(kind, context, sym):
        p = 1 / 256
        for k in range(4):
            c = context[3 - k :]
            follow = {s: n for (x, s), n in counts[kind].items() if x == c}
            kinds = len(follow) + (k == 0)
            if sum(follow.values()) + kinds:
                p = (follow.get(sym, 0) + kinds * p) / (sum(follow.values()) + kinds)
        return p

    for i, url in enumerate(items):
        if plain_judge(url)[2] is None:
            all_ = [math.log(chance(True, *e) / chance(False, *e)) for e in events(plain_text(url))]
            assert out[i]["score"] == pytest.approx(sum(all_) / len(all_), abs=1e-8), url
    assert len(out) == len(items)
    # What differs behind the path alone is told apart.
    at = {url: i for i, url in enumerate(items)}
    assert out[at["nothing"]]["score"] != out[at[""]]["score"] == out[at[None]]["score"]
    assert out[at["http://alpha.org/x"]]["score"] != out[at["http://Alpha.org/x?Page=1"]]["score"]


def test_urls_without_rows_or_training(spark):
    assert urls.filter_urls(pages(spark, []), URL_RULES).collect() == []
    row = urls.filter_urls(pages(spark, [(1, "http://a.org/x")]), URL_RULES).first()
    assert row["rule"] is None and row["score"] == 0 and row["verdict"] == "allow"

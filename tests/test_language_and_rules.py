import re

import pytest
from pyspark.sql import functions as F

from cantiga.operators import language, rules
from cantiga.schemas import RULES
from cantiga.sources.rules import read_keywords, read_rules_yaml

SAMPLES = [
    ("pt", "o coração canta uma canção de amor e paz na manhã"),
    ("pt", "eu não sei se você vem mas o meu coração espera"),
    ("en", "the heart sings a song of love and peace in the morning"),
    ("en", "i do not know if you will come but my heart is waiting"),
    ("es", "el corazón canta una canción de amor y paz en la mañana"),
    ("es", "yo no sé si vienes pero mi corazón te espera"),
]
LANGS = ["en", "es", "pt"]


@pytest.fixture(scope="module")
def profile(spark):
    samples = spark.createDataFrame(SAMPLES, "lang string, text string")
    return language.lang_profile(samples).cache()


@pytest.fixture(scope="module")
def verses(spark):
    rows = [
        (1, "Uma canção do meu coração, não sei se você espera!"),
        (2, "a song of the heart 123 in the morning"),
        (3, "una canción del corazón, yo no sé"),
        (4, " 99 !! "),
        (5, ""),
        (6, "ab"),
        (7, None),
        (8, "жжжжж"),
    ]
    return spark.createDataFrame(rows, "id int, t string")


def test_trigrams_overlap(spark):
    row = spark.range(1).select(
        language.trigrams(F.lit("AbCd")), language.trigrams(F.lit("ab")), language.trigrams(F.lit("𝐀bc𝐀"))
    ).first()
    assert list(row) == [[" ab", "abc", "bcd", "cd "], [" ab", "ab "], [" 𝐀b", "𝐀bc", "bc𝐀", "c𝐀 "]]
    short = spark.range(1).select(*[language.trigrams(F.lit(t)) for t in ("x", "", " ", "   ")]).first()
    assert list(short) == [[" x "], [], [], []]


def test_profile_is_smoothed_counts(profile):
    rows = profile.collect()
    vocabulary = len({r["gram"] for r in rows})
    totals = {}
    for r in rows:
        totals[r["lang"]] = totals.get(r["lang"], 0) + r["n"]
    import math

    for r in rows:
        size = totals[r["lang"]] + vocabulary
        assert r["logp"] == round(math.log((r["n"] + 1) / size) * 1e6)
        assert r["default_logp"] == round(math.log(1 / size) * 1e6)


def test_detects_language_and_skips_empty_texts(profile, verses):
    found = language.detect_language(verses, profile, LANGS, "id", "t")
    langs = {r["id"]: r["lang"] for r in found.collect()}
    assert {k: langs[k] for k in (1, 2, 3)} == {1: "pt", 2: "en", 3: "es"}
    assert set(langs) == {1, 2, 3, 6, 8}


def test_filter_keeps_the_target_only(profile, verses):
    kept = language.filter_language(verses, profile, LANGS, "pt", "id", "t")
    assert 1 in {r["id"] for r in kept.collect()} and kept.where("id in (2, 3, 4, 5, 7)").isEmpty()


def test_large_profile_gives_the_same_scores(profile, verses):
    def scores(limit):
        df = language.lang_scores(verses, profile, LANGS, "id", "t", broadcast_rows=limit)
        return sorted(tuple(r) for r in df.collect())

    assert scores(0) == scores(10**6)


def test_no_row_is_made_of_a_trigram(spark, profile, verses):
    """A row per trigram took most of the time of every query that detects languages."""
    for df in (
        language.lang_profile(verses.select(F.lit("pt").alias("lang"), F.col("t").alias("text"))),
        language.detect_language(verses, profile, LANGS, "id", "t"),
    ):
        assert "Generate" not in df._jdf.queryExecution().executedPlan().toString()
    found = language.lang_scores(verses, profile, LANGS, "id", "t")
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block", [1, 50, 1 << 20])
def test_arrays_of_trigrams_equal_rows_of_them(spark, monkeypatch, block):
    monkeypatch.setattr(language, "BLOCK_BYTES", block)
    rows = [
        ("pt", "Ação 𝐀𝐁 x"), (None, "sem língua"), ("en", ""), ("en", None), ("en", "a"), ("pt", "  "), ("es", "12 !"),
        ("en", "a" * 5000), ("pt", "Ação 𝐀𝐁 x"), ("es", "İ ß ſ"),
    ]
    df = spark.createDataFrame([(i % 7, *r) for i, r in enumerate(rows)], "k int, lang string, text string").coalesce(1)
    cut = df.select("lang", F.explode(language.trigrams(language.clean_for_detection(F.col("text")))).alias("gram"))
    plain = {tuple(r) for r in cut.where("lang IS NOT NULL").groupBy("lang", "gram").count().collect()}
    found = language.lang_profile(df)
    assert {(r["lang"], r["gram"], r["n"]) for r in found.collect()} == plain
    known = found.where("gram <> ' a '")

    def scores(limit):
        return sorted(tuple(r) for r in language.lang_scores(df, known, ["en", "es", "pt"], "k", "text", limit).collect())

    assert scores(0) == scores(10**6) != []
    nothing = known.where("false").unionByName(known.where("lang = 'es'"))
    assert language.lang_scores(df.where("text = ''"), nothing, ["es"], "k", "text").isEmpty()


def test_candidates_limit_the_answer(profile, verses):
    found = language.detect_language(verses, profile, ["en", "es"], "id", "t")
    assert {r["lang"] for r in found.collect()} <= {"en", "es"}


WORDS = ["Maré", "Sol  de Junho", "feira", "a", "jazz'n soul"]
TITLES = [
    "maré music", "MARÉ", "mare", "amaré", "marés", "sol de\njunho", "sol, de junho", "sol de junhos",
    "Feira das 10", "defeirao", "é a hora", "jazz n soul", "jazz n souls", "", None, "sol de",
]


def brute_force(titles, words):
    def form(text):
        return " " + re.sub(r"[\W]+", " ", text.lower()).strip() + " "

    return [
        i for i, t in enumerate(titles)
        if t is None or not any(form(w) in form(t) for w in words)
    ]


@pytest.mark.parametrize("pattern_keywords", [100, 0])
def test_whole_word_exclusion(spark, pattern_keywords):
    rows = [("titles", w) for w in WORDS] + [("artists", "hora"), ("titles", "!")]
    table = spark.createDataFrame(rows, RULES)
    df = spark.createDataFrame(list(enumerate(TITLES)), "i int, t string")
    kept = rules.exclude_keywords(df, table, "titles", "i", "t", pattern_keywords)
    assert sorted(r["i"] for r in kept.collect()) == brute_force(TITLES, WORDS)


@pytest.mark.parametrize("limit", [1000, 0])
def test_long_lists_look_at_rare_words_only(spark, monkeypatch, limit):
    keywords = [f"the very rare{i}" for i in range(40)] + ["the", "lone wolf wolf", "of the of"]
    texts = ["the VERY, rare7!", "very rare7", "a lone wolf", "Lone wolf. Wolf", "of a of", "x of the of y", "rare3 the very rare3", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    listed = spark.createDataFrame([("titles", k) for k in keywords if k != "the"], RULES)
    monkeypatch.setattr(rules, "BROADCAST_ROWS", limit)
    words = rules.keywords_of(listed, "titles")
    found = rules.matching_ids(df, "i", "t", words, limit)
    assert sorted(r["i"] for r in found.collect()) == [0, 3, 5, 6]
    anchors = {r["keyword"]: (r["word"], r["at"]) for r in rules.keyword_anchors(df, "i", "t", words).collect()}
    assert anchors["the very rare9"] == ("rare9", 2) and anchors["lone wolf wolf"] == ("lone", 0)


@pytest.mark.parametrize("block", [1, 40, 1 << 20])
def test_only_runs_that_are_keywords_move(spark, monkeypatch, block):
    """A row for each keyword of a common word, at each of its places, made the shuffle quadratic."""
    monkeypatch.setattr(rules, "BLOCK_BYTES", block)
    texts = [
        "the a the b", "the", "b the", "the a", "É the 𝐀 c d e", "é THE 𝐀; c d", "c d e", "x", "a a a a", "", None, "the a the b",
        *(" ".join(["the"] * 50 + [f"w{i}"]) for i in range(20)),
    ]
    listed = ["a the b", "é the 𝐀 c d", "the b the", "d e f", "a a a", "the the w7", "e x", "x", *(f"the the v{i}" for i in range(30))]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    words = rules.keywords_of(spark.createDataFrame([("titles", k) for k in listed], RULES), "titles")
    moved = sorted(tuple(r) for r in rules._listed_runs(df, "i", "t", words).collect())
    assert moved == sorted(
        [(0, "a the b"), (11, "a the b"), (4, "é the 𝐀 c d"), (5, "é the 𝐀 c d"), (7, "x"), (8, "a a a"), (19, "the the w7")]
    )
    for limit in (0, 100):
        found = rules.matching_ids(df, "i", "t", words, limit)
        assert sorted(r["i"] for r in found.collect()) == sorted({i for i, _ in moved})
    assert rules.matching_ids(df, "i", "t", words.limit(0)).isEmpty()


def test_no_keywords_keep_all(spark):
    df = spark.createDataFrame([(1, "x")], "i int, t string")
    assert rules.exclude_keywords(df, spark.createDataFrame([], RULES), "titles", "i", "t").count() == 1


def test_length_bounds_are_inclusive_and_in_characters(texts):
    df = texts("é" * 99, "é" * 100, "é" * 4000, "é" * 4001)
    assert [r["i"] for r in df.where(rules.within_length(F.col("t"))).orderBy("i").collect()] == [1, 2]


def test_rules_from_files(spark, tmp_path):
    (tmp_path / "rules.yaml").write_text(
        "filters:\n  artists:\n    exclude_keywords: [Um, Dois]\n"
        "  lyrics:\n    language: es\n    min_length: 5\n"
        "    content_filters:\n      exclude_terms:\n        - três\n",
        encoding="utf-8",
    )
    found = read_rules_yaml(spark, str(tmp_path / "rules.yaml"))
    assert (found.language, found.min_length, found.max_length) == ("es", 5, 4000)
    assert sorted(tuple(r) for r in found.keywords.collect()) == [
        ("artists", "Dois"), ("artists", "Um"), ("lyrics", "três"),
    ]
    (tmp_path / "rules.json").write_text('{"scope": "titles", "keyword": "x"}\n')
    assert read_keywords(spark, str(tmp_path / "rules.json")).first()["keyword"] == "x"

"""Keyword rules as a table of scope and keyword."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cantiga.operators.rules import MAX_LYRIC_CHARS, MIN_LYRIC_CHARS
from cantiga.schemas import RULES

# Fixed value: the language kept when the rules name none.
TARGET_LANGUAGE = "pt"


@dataclass(frozen=True)
class LyricRules:
    """Keywords by scope (``artists``, ``titles``, ``lyrics``) and the lyric bounds."""

    keywords: DataFrame
    language: str = TARGET_LANGUAGE
    min_length: int = MIN_LYRIC_CHARS
    max_length: int = MAX_LYRIC_CHARS


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    """Keywords from JSON lines ``{"scope": ..., "keyword": ...}``."""
    return spark.read.schema(RULES).json(path)


def read_rules_yaml(spark: SparkSession, path: str) -> LyricRules:
    """Rules from one YAML settings file, read on the driver.

    The file holds ``filters`` with ``artists.exclude_keywords``,
    ``titles.exclude_keywords`` and ``lyrics`` (``language``, ``min_length``,
    ``max_length``, ``content_filters.exclude_terms``), all of them optional.
    """
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("reading YAML rules needs the yaml package") from missing
    with open(path, encoding="utf-8") as file:
        filters = (yaml.safe_load(file) or {}).get("filters") or {}
    lyrics = filters.get("lyrics") or {}
    listed = {
        "artists": (filters.get("artists") or {}).get("exclude_keywords"),
        "titles": (filters.get("titles") or {}).get("exclude_keywords"),
        "lyrics": (lyrics.get("content_filters") or {}).get("exclude_terms"),
    }
    rows = [(scope, str(word)) for scope, words in listed.items() for word in words or []]
    return LyricRules(
        keywords=spark.createDataFrame(rows, RULES),
        language=lyrics.get("language", TARGET_LANGUAGE),
        min_length=lyrics.get("min_length", MIN_LYRIC_CHARS),
        max_length=lyrics.get("max_length", MAX_LYRIC_CHARS),
    )

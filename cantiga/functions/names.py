"""Paths, slugs, letter buckets and export names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FILE_NAME_BYTES = 255


def strip_slashes(col: Column) -> Column:
    return F.btrim(col, F.lit("/"))


def last_segment(href: Column) -> Column:
    """Last path segment of a link, with the outer slashes gone."""
    return F.element_at(F.split(strip_slashes(href), "/"), -1)


def is_single_segment(slug: Column) -> Column:
    return (slug != "") & ~slug.contains("/")


def artist_path(slug: Column) -> Column:
    return F.concat(F.lit("/"), slug, F.lit("/"))


def song_path(artist_slug: Column, song_slug: Column) -> Column:
    return F.concat(artist_path(artist_slug), song_slug)


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, "^[A-Za-z]+://([^/?#]+)", 1)


def url_path(url: Column) -> Column:
    """Path of a URL, without query and fragment."""
    return F.regexp_extract(url, "^[A-Za-z]+://[^/?#]+([^?#]*)", 1)


def letter_bucket(name: Column) -> Column:
    """``#`` for a leading digit, the capital for A to Z, else ``Other``."""
    first = F.upper(F.substring(name, 1, 1))
    return (
        F.when(first.rlike(r"^\p{Nd}$"), F.lit("#"))
        .when(first.rlike("^[A-Z]$"), first)
        .otherwise(F.lit("Other"))
    )


def export_name(artist: Column, song: Column) -> Column:
    """``artist - song.txt`` with slashes replaced, whole."""
    return F.replace(F.concat(artist, F.lit(" - "), song, F.lit(".txt")), F.lit("/"), F.lit("_"))


def file_name(name: Column) -> Column:
    """An export name as a file system takes it.

    A name that is too long is cut and ends in a digest of the whole name, so two long
    names stay apart.
    """
    # 50 characters take 200 bytes at most.
    cut = F.concat(F.substring(name, 1, 50), F.lit("~"), F.md5(name), F.lit(".txt"))
    return F.when(F.octet_length(name) > _FILE_NAME_BYTES, cut).otherwise(name)


def export_body(artist: Column, song: Column, content: Column) -> Column:
    return F.concat(song, F.lit("\n"), artist, F.lit("\n\n"), content)

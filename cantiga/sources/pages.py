"""The page source: fetched pages as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantiga.functions.text import utf8_text
from cantiga.schemas import PAGES
from cantiga.session import spread


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages with text bodies, from Parquet."""
    return spread(spark.read.schema(PAGES).parquet(path), "page_id")


def decode_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """Pages with binary bodies to ``page_id, url, html``; invalid bytes are dropped."""
    return pages.select("page_id", "url", utf8_text(F.col(body)).alias("html"))

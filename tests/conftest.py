import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cantiga.schemas import PAGES  # noqa: E402
from cantiga.session import build_session  # noqa: E402

DAY_1 = datetime(2024, 3, 1, 8, 30)
DAY_2 = datetime(2024, 3, 8, 8, 30)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def pages(spark):
    """Build a page table from ``(url, html)`` pairs or HTML texts."""

    def build(*items):
        rows = [(i, *(x if isinstance(x, tuple) else ("", x))) for i, x in enumerate(items)]
        return spark.createDataFrame(rows, PAGES)

    return build


@pytest.fixture
def texts(spark):
    """One-column table of texts, in order."""

    def build(*values):
        schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("t", T.StringType())])
        return spark.createDataFrame(list(enumerate(values)), schema)

    return build


def column(df, col):
    return [row[0] for row in df.orderBy("i").select(col).collect()]

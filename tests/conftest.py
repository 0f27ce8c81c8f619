import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from helpers import schema, ts  # noqa: E402

from qlens.config import CATEGORIES, CHATS, KEYWORDS  # noqa: E402
from qlens.functions.fixed_values import CATEGORY_NAMES  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_chats(spark):
    def make(*rows):
        """(text, time) pairs, keys numbered from 1."""
        return spark.createDataFrame([(i, t, ts(at)) for i, (t, at) in enumerate(rows, 1)], schema(CHATS))

    return make


@pytest.fixture(scope="session")
def make_keywords(spark):
    def make(*rows):
        """(text, keyword, category, count, day[, loaded]) tuples."""
        full = [
            (t, k, c, n, ts(d), ts(rest[0]) if rest else ts("2025-06-20T01:00:00")) for t, k, c, n, d, *rest in rows
        ]
        return spark.createDataFrame(full, schema(KEYWORDS))

    return make


@pytest.fixture(scope="session")
def categories(spark):
    return spark.createDataFrame(list(enumerate(CATEGORY_NAMES, 1)), schema(CATEGORIES))

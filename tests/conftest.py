import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]").appName("rankforge-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def articles(spark):
    from articles import ARTICLE_TYPE, ARTICLES

    return spark.createDataFrame(ARTICLES, ARTICLE_TYPE)


@pytest.fixture(scope="session")
def index(spark, articles, tmp_path_factory):
    from rankforge import HashingEncoder, build_index

    path = str(tmp_path_factory.mktemp("index") / "articles")
    return build_index(articles, path, encoder=HashingEncoder(dim=32), n_cells=3, buckets=4)


@pytest.fixture(scope="session")
def asked(spark):
    rows = [(1, "cache_lines"), (2, "disk_quota_exceeded"), (3, "shortlist cost"),
            (4, "the garden"), (5, "zzz unknown")]
    return spark.createDataFrame(rows, "query_id bigint, query string")

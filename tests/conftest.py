from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import scratch_path, scratch_run, with_recommended_conf  # noqa: E402
from tidemark.sources.catalog import create_database, drop_database  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    session = with_recommended_conf(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def nothing_left(request):
    """Temporary views live as long as the session, staged data longer: none is left by a test."""
    if "spark" not in request.fixturenames:
        yield
        return
    session = request.getfixturevalue("spark")
    with scratch_run(session):
        yield
        for view in session.catalog.listTables():
            if view.isTemporary:
                session.catalog.dropTempView(view.name)


@pytest.fixture
def database(spark):
    name = f"test_{uuid.uuid4().hex}"
    create_database(spark, name, scratch_path(spark, "test-warehouse"))
    yield name
    drop_database(spark, name)


@pytest.fixture
def path(spark):
    """Makes new paths in the scratch folder."""
    return lambda label="test": scratch_path(spark, label)

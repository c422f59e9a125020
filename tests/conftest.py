import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from phrasegrove.plans.ship import ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    ship_package(session)
    session.sparkContext.addPyFile(str(ROOT / "tests" / "clients.py"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def mixture(spark):
    """200 vectors of 32 dims around 5 topics."""
    from phrasegrove.sources.synthetic import synthetic_mixture

    rows = synthetic_mixture(spark, 200, 32, 5, 42, partitions=4).cache()
    rows.count()
    return rows

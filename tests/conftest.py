import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("siltbed-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        # A stage that outgrows generated code must fail here, not slow down quietly.
        .config("spark.sql.codegen.fallback", "false")
        .config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def log_of(spark):
    """Build log rows of topic ``t`` from (partition, offset, value) triples."""
    from siltbed.schema import LOG_SCHEMA

    def build(rows, topic="t"):
        return spark.createDataFrame([(topic, p, o, f"k{o}", v) for p, o, v in rows], LOG_SCHEMA)

    return build

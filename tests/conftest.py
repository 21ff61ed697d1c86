import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="sakuin-tests-")
    session = (
        SparkSession.builder.master("local[4]").appName("sakuin-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{shared}/checkpoint").config("spark.sql.warehouse.dir", f"{shared}/warehouse").config("spark.driver.memory", "3g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

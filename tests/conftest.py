import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from listwright.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a Column built from text inputs."""
    def run(build, *inputs):
        from pyspark.sql import functions as F

        names = [f"c{i}" for i in range(len(inputs))]
        df = spark.createDataFrame([tuple(inputs)], ", ".join(f"{n} string" for n in names))
        return df.select(build(*map(F.col, names)).alias("v")).first()["v"]

    return run

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from citylake import session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.build(
        "local[8]",
        "citylake-tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield spark
    spark.stop()


@pytest.fixture
def evaluate(spark):
    """Evaluate one expression over one row built from keyword literals."""

    def run(build, schema, *rows):
        df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
        return [r[0] for r in df.coalesce(1).select(build).collect()]

    return run

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rosterforge.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "6g", "tests")


@pytest.fixture
def column(spark):
    """Value of one column expression over one row of named texts."""

    def evaluate(expression, **values):
        from pyspark.sql import functions as F

        row = spark.range(1).select(*[F.lit(v).cast(t).alias(k) for k, (v, t) in values.items()])
        return row.select(expression.alias("out")).first()["out"]

    return evaluate

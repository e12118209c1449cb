import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from segrisk.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, app="segrisk-tests", **{"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "2", "spark.sql.maxMetadataStringLength": "1000"})


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_DIR).exists():
        pytest.skip("no test data")
    return SF_DIR


@pytest.fixture(scope="session")
def frame(spark):
    """DataFrame from rows and a DDL schema."""

    def build(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build


@pytest.fixture(scope="session")
def value(spark):
    """The single value of an expression over one row of named inputs."""

    def evaluate(expression, schema="x double", *row):
        df = spark.createDataFrame([row], schema)
        return df.select(expression.alias("v")).first()[0]

    return evaluate

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from tally.session import get_spark
    ckpt = tempfile.mkdtemp(prefix="tally-test-ckpt-")
    s = get_spark("tally-tests", master="local[4]", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": ckpt,
                         "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tally-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def df(spark):
    """Build a DataFrame from rows and a DDL schema."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)
    return make

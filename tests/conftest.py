import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from gatetally.session import local_session  # noqa: E402

TABLES = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("tests", 4, "6g", spark_sql_shuffle_partitions="4", spark_checkpoint_dir=shared)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return str(TABLES / "sf0.001")


@pytest.fixture
def clicks(spark):
    """Curated click rows from dicts; columns not named are null."""
    from gatetally import schemas as S

    def make(*rows):
        names = S.CLICK_CURATED.fieldNames()
        base = {"student_id": "t1", "dt": "2024-01-01"}
        return spark.createDataFrame([tuple((base | r).get(n) for n in names) for r in rows], S.CLICK_CURATED)

    return make


@pytest.fixture
def raw(spark):
    """Raw rows of a text contract from dicts."""

    def make(schema, *rows):
        return spark.createDataFrame([tuple(r.get(n) for n in schema.fieldNames()) for r in rows], schema)

    return make


def dicts(df):
    return [r.asDict() for r in df.collect()]

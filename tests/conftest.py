import pytest

from spindrift.session import local_session
from spindrift.sources.tables import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        8, app="tests", **{"spark.checkpoint.dir": str(shared), "spark.sql.warehouse.dir": str(shared / "warehouse")}
    )
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SF)

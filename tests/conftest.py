import pytest

from tests.compare import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = session()
    if not made.sparkContext.getCheckpointDir():
        made.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield made
    made.stop()


@pytest.fixture(autouse=True)
def no_leftover_cache(spark):
    yield
    spark.catalog.clearCache()

import pytest
from compare import duck, local_session

from cohortloom import Settings

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def connection():
    return duck(SMALL)


@pytest.fixture(scope="session")
def settings():
    return Settings()


@pytest.fixture(scope="session")
def entities(spark):
    return spark.range(0, 2000).withColumnRenamed("id", "indice")

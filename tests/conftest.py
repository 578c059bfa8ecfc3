import pytest

from salesmart import session


@pytest.fixture(scope="session")
def spark():
    spark = session.build("tests")
    yield spark
    session.clear_staging(spark)
    spark.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"

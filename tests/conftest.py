import pytest

from proofmark.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "proofmark-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()

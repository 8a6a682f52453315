import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.compare import oracle_connection, session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session("4", str(tmp_path_factory.mktemp("checkpoints")))
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def duck():
    return oracle_connection(SF_DIR)


@pytest.fixture
def many_partitions(spark):
    """Keep shuffle partitions apart, so that small data crosses partition borders."""
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)

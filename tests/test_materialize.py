from types import SimpleNamespace

import pytest

from quizlens.operators.materialize import scratch_folder


def session(master, **settings):
    conf = {"spark.sql.warehouse.dir": "file:/data/warehouse", **settings}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)),
                           sparkContext=SimpleNamespace(master=master, applicationId="app"))


def test_scratch_lies_where_executors_reach():
    shared = {"spark.checkpoint.dir": "hdfs://store/shared/"}
    assert scratch_folder(session("yarn", **shared)).startswith("hdfs://store/shared/quizlens-app/")
    assert scratch_folder(session("local[4]")).startswith("file:/data/warehouse/_scratch/")
    warehouse = {"spark.sql.warehouse.dir": "s3a://bucket/warehouse"}
    assert scratch_folder(session("yarn", **warehouse)).startswith("s3a://bucket/warehouse/_scratch/")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="checkpoint"):
            scratch_folder(session(master))

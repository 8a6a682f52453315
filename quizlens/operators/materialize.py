"""Writing an intermediate result once, to the shared folder the cluster names."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_run: ContextVar[str] = ContextVar("run", default="queries")


def scratch_folder(spark: SparkSession) -> str:
    """``<spark.checkpoint.dir>/quizlens-<application>/<run>``.

    Where the setting is missing, a folder in the warehouse stands in: in a local session, or if the warehouse lies in a store
    that executors share. A warehouse on the driver's own disk is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
        scheme = root.partition(":")[0] if ":" in root else "file"
        if scheme == "file" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/quizlens-{spark.sparkContext.applicationId}/{_run.get()}"


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as parquet and read it back: cut lineage, columnar, safe when executors are lost."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Remove what :func:`materialize` wrote in the current run, once the results that read it are written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for what is materialized inside, removed at the end."""
    token = _run.set(uuid.uuid4().hex)
    try:
        yield scratch_folder(spark)
        drop_scratch(spark)
    finally:
        _run.reset(token)

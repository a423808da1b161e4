"""Writing an intermediate table once, in the folder the cluster shares for checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

LARGE_ROWS = {
    "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
    "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1", "parquet.block.size": str(8 << 20),
}


def staging_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only where it is unset, as in tests."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def stage(df: DataFrame, large_rows: bool = False) -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    For tables that several jobs read again (training rows, above all): the lineage ends here, lost
    executors cost only a re-read, and later jobs still prune columns.

    ``large_rows``: rows of megabytes. Parquet looks at sizes every 100 rows only, so a task would hold all its rows in one
    page and one row group, when it writes and when it reads; sizes are then checked after every row.
    """
    return _written(df, _new_path(df.sparkSession), LARGE_ROWS if large_rows else {})


def _new_path(spark: SparkSession) -> str:
    return f"{staging_dir(spark).rstrip('/')}/riskspark-{uuid.uuid4().hex}"


def _written(df: DataFrame, path: str, options: dict[str, str] | None = None) -> DataFrame:
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """``stage`` for a table that nothing lazy outlives: its files go when the block ends."""
    spark = df.sparkSession
    path = _new_path(spark)
    try:
        yield _written(df, path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

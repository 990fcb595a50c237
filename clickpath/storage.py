"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clickpath.session import checkpoint_dir
from clickpath.sources.layer import remove


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's intermediate files, in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/clickpath-run-{spark.sparkContext.applicationId}"


def remove_run(spark: SparkSession) -> None:
    """Remove all intermediate files of this application: call it when no result of a query is
    still to be read.  Files of an application that has died are below its own folder."""
    remove(spark, run_folder(spark))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the run's folder in ``spark.checkpoint.dir`` and read it back.

    What is read several times is then computed once, and a lost executor costs a re-read."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/clickpath-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstored(df: DataFrame) -> None:
    """Remove the files of a table of :func:`stored` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if folder.rsplit("/", 1)[1].startswith("clickpath-"):
            remove(spark, folder)

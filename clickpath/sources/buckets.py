"""Event tables bucketed by a key: grouping by it afterwards moves no rows.

A bucket is one task, so rows that would crowd one lie apart: those with a NULL in the key,
and those of keys that hold more than a bucket's share of all rows.  There are fewer such keys
than buckets, whatever the data.  A table is

    <dest>/spec-<n>.json                  columns, key and folder; the highest number counts
    <dest>/tag=<t>/bucketed/*.parquet     one sorted file a bucket
    <dest>/tag=<t>/apart/*.parquet        the other rows, in no order

and a spec is committed by one rename, so readers see the old table or the new one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpath.sources import layer
from clickpath.storage import stored


@dataclass
class Bucketed:
    by: list[str]
    #: Rows in buckets, and the rows apart; no key is in both.
    rows: DataFrame
    apart: DataFrame


def write_bucketed(events: DataFrame, dest: str, by: list[str], buckets: int) -> None:
    """Write ``events`` in ``buckets`` buckets of the columns ``by``; ``events`` is read several times."""
    spark, cols = events.sparkSession, events.columns
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by])
    keyed = events.where(whole)
    # More than 1 / buckets of the rows each, so fewer keys than buckets.
    heavy = F.broadcast(stored(keyed.groupBy(*by).count().where(F.col("count") * buckets > events.count()).select(*by), "heavy-keys"))
    folder, table = f"tag={uuid.uuid4().hex}", f"clickpath_{uuid.uuid4().hex}"
    rest = keyed.join(heavy, by, "left_anti").select(*cols)
    apart = events.where(~whole).unionByName(keyed.join(heavy, by, "left_semi").select(*cols))
    apart.write.option("compression", "zstd").parquet(f"{dest}/{folder}/apart")
    (rest.repartition(buckets, *by).write.format("parquet").bucketBy(buckets, *by).sortBy(*by)
         .option("compression", "zstd").option("path", f"{dest}/{folder}/bucketed").saveAsTable(table))
    spec = {"by": by, "buckets": buckets, "folder": folder, "table": table, "schema": events.schema.json()}
    layer.commit_text(spark, f"{dest}/spec-{len(layer.folders(spark, dest, 'spec-')):010d}.json", json.dumps(spec))


def read_bucketed(spark: SparkSession, dest: str) -> Bucketed:
    """The table as its last spec names it, with its buckets known to Spark (also in a new session)."""
    spec = json.loads(layer.read_text(spark, f"{dest}/{layer.folders(spark, dest, 'spec-')[-1]}"))
    folder, keys = f"{dest}/{spec['folder']}", ", ".join(f"`{c}`" for c in spec["by"])
    if not spark.catalog.tableExists(spec["table"]):
        columns = spark.sparkContext._jvm.org.apache.spark.sql.types.DataType.fromJson(spec["schema"]).toDDL()
        spark.sql(f"CREATE TABLE {spec['table']} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                  f"INTO {spec['buckets']} BUCKETS LOCATION '{folder}/bucketed'")
    schema = T.StructType.fromJson(json.loads(spec["schema"]))
    return Bucketed(spec["by"], spark.table(spec["table"]), spark.read.schema(schema).parquet(f"{folder}/apart"))

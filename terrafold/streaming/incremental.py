"""Our own extension, beyond batch parity: the same upsert fed by a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from terrafold.functions.keys import keep_latest
from terrafold.operators.merge import upsert
from terrafold.sources.tables import Tables


def stream_upsert(spark: SparkSession, folder: str, schema: StructType, tables: Tables, name: str, key: str, newest: str, checksum: str, checkpoint: str) -> StreamingQuery:
    """New Parquet files of a folder merged into a table, which alternates between two versions: name_0 and name_1."""

    def merge(batch: DataFrame, epoch: int) -> None:
        old = tables.read(f"{name}_{(epoch + 1) % 2}", schema)
        latest = keep_latest(batch, [key], [batch[newest], batch[checksum]])
        tables.overwrite(upsert(old, latest, [key], checksum), f"{name}_{epoch % 2}")

    return spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

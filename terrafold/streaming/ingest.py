"""Files taken in by batches, each once, with a log of what became of each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terrafold.sources import embedded
from terrafold.sources.embedded import Format
from terrafold.sources.tables import Tables

#: Fixed value: files of one batch.
BATCH_FILES = 30


def ingest_embedded(spark: SparkSession, folder: str, tables: Tables, names: tuple[str, str, str], checkpoint: str, pattern: str = "*.csv", form: Format = embedded.POST_COMMENTS, batch_files: int = BATCH_FILES) -> StreamingQuery:
    """New embedded files of a folder into tables of posts, comments and a log; names are those three tables'.

    The stream's own log of files, below checkpoint, tells which were taken: a run reads what came since the last one,
    batch_files at a time, and stops. A batch writes posts, comments and log rows of its own partition (batch), over
    what an attempt of it that failed may have left; so the first write of a batch overwrites, and batches add up.
    A file that cannot be parsed is a log row with status failed and the reason; it stops no other. Rows of log:
    source_file, its size, status, records (1 for the post, and its comments), error_message.
    """
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    files = reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).option("maxFilesPerTrigger", batch_files).load(folder)

    def take(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()  # parsed once for the three tables
        for df, name in zip((embedded.posts(batch, form), embedded.split_comments(embedded.comments(batch, form))[0], log(batch)), names, strict=True):
            tables.overwrite_partitions(df.withColumn("batch", F.lit(epoch)), name, ["batch"])
        batch.unpersist()

    def log(batch: DataFrame) -> DataFrame:
        failed = F.col("reason").isNotNull()
        return batch.select(
            "source_file", "source_file_size_bytes", F.when(failed, "failed").otherwise("success").alias("status"),
            F.when(failed, 0).otherwise(1 + F.size("rows")).alias("records"), F.col("reason").alias("error_message"),
        )

    return embedded.parsed(files, form).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

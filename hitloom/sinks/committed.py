"""A table of batches of which readers see whole ones only."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Folder of the list of commits, one empty file named ``<batch>.<attempt>`` for each; Spark's readers skip it.
COMMITS = "_commits"


class CommittedBatches:
    """Writes batches below `output` and keeps the list of those that are complete.

    An attempt writes to ``batch_id=N/attempt=X`` and is then named in the list by creating one file, which a
    file system does at once or not at all.  Whatever fails before that leaves a folder that is not in the list.
    One writer at a time works on a batch, as a stream's driver does.
    """

    def __init__(self, spark: SparkSession, output: str):
        self.spark, self.output = spark, output.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._commits = self._path(f"{self.output}/{COMMITS}")
        self._files = self._commits.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def listed(self) -> dict[int, str]:
        """The attempt that counts of each complete batch."""
        if not self._files.exists(self._commits):
            return {}
        names = [status.getPath().getName() for status in self._files.listStatus(self._commits)]
        return {int(number): attempt for number, attempt in (n.split(".", 1) for n in names)}

    def has(self, batch_id: int) -> bool:
        return batch_id in self.listed()

    def write(self, df: DataFrame, batch_id: int) -> None:
        attempt = "a" + uuid.uuid4().hex  # a name, never read as a number
        df.write.parquet(self.folder(batch_id, attempt))
        self._files.mkdirs(self._commits)
        if not self._files.createNewFile(self._path(f"{self.output}/{COMMITS}/{batch_id}.{attempt}")):
            raise FileExistsError(f"batch {batch_id} is in the list already")

    def folder(self, batch_id: int, attempt: str) -> str:
        return f"{self.output}/batch_id={batch_id}/attempt={attempt}"


def read_committed(spark: SparkSession, output: str) -> DataFrame:
    """The complete batches below `output`, with their ``batch_id``, as of now."""
    batches = CommittedBatches(spark, output)
    folders = [batches.folder(number, attempt) for number, attempt in sorted(batches.listed().items())]
    if not folders:
        raise FileNotFoundError(f"no batch of {output} is complete yet")
    found = spark.read.option("basePath", batches.output).parquet(*folders)
    return found.drop("attempt").withColumn("batch_id", found["batch_id"].cast("long"))

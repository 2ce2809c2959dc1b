"""State tables of streaming jobs, kept in parts beside a query's checkpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from eventfares.settings import remove
from eventfares.sources.sinks import folders

MERGE_EVERY = 20


class Parts:
    """A table by `keys`, of what each batch adds to it and merged tables of all up to a batch.

    `measures` say how rows of a key become one. A batch reads what earlier ones left and writes
    under its own number, so it may run again.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], **measures: Column):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, keys
        self.measures = [column.alias(name) for name, column in measures.items()]

    def one(self, rows: DataFrame) -> DataFrame:
        """Rows of a key as one row."""
        return rows.groupBy(*self.keys).agg(*self.measures) if self.measures else rows.select(*self.keys).distinct()

    def before(self, batch_id: int) -> DataFrame:
        """The table as all batches before `batch_id` left it."""
        merged = max((b for b in self._written("merged") if b < batch_id), default=None)
        from_batch = -1 if merged is None else merged
        paths = [f"{self.path}/added/batch={b}" for b in self._written("added") if from_batch < b < batch_id]
        if merged is not None:
            paths.append(f"{self.path}/merged/batch={merged}")
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.one(self.spark.read.schema(self.schema).parquet(*paths))

    def add(self, rows: DataFrame, batch_id: int, merge: bool) -> DataFrame:
        """Write what a batch adds, and read it back."""
        path = f"{self.path}/added/batch={batch_id}"
        empty = self.spark.createDataFrame([], self.schema)
        rows.select(*empty.columns).to(empty.schema).write.mode("overwrite").parquet(path)
        if merge:
            self._merge(batch_id)
        return self.spark.read.schema(self.schema).parquet(path)

    def _merge(self, batch_id: int) -> None:
        """Merge all up to `batch_id`. Older parts go, but for those that its replay would read."""
        earlier = max((b for b in self._written("merged") if b < batch_id), default=-1)
        self.before(batch_id + 1).write.mode("overwrite").parquet(f"{self.path}/merged/batch={batch_id}")
        for kind in ("added", "merged"):
            for b in self._written(kind):
                if b < earlier or kind == "added" and b == earlier:
                    remove(self.spark, f"{self.path}/{kind}/batch={b}")

    def _written(self, kind: str) -> list[int]:
        return folders(self.spark, f"{self.path}/{kind}", "batch")

"""Runs that go on where they broke off.

Each stage of a run is a table in the run's folder, named by the stage and by the state of the run's input. Spark
marks a table that was written to its end; a stage with such a mark is read, any other is computed (again). When the
result is stored, the folder goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Stages:
    """The stage tables of one run. `state` names its input: other input, other tables."""

    def __init__(self, spark: SparkSession, folder: str, *state: object):
        self.spark = spark
        self.folder = folder
        self.state = hashlib.sha256(repr(state).encode()).hexdigest()[:16]
        self.reused: list[str] = []

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def done(self, name: str) -> bool:
        mark = self._path(f"{self.folder}/{name}-{self.state}/_SUCCESS")
        return self._files(mark).exists(mark)

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        """The stage's rows, from its table where that is complete, else computed and written."""
        path = f"{self.folder}/{name}-{self.state}"
        if self.done(name):
            self.reused.append(name)
        else:
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def finish(self, store: Callable[[], object]) -> object:
        """Store the result, then remove all stage tables, those of other states, too."""
        found = store()
        folder = self._path(self.folder)
        self._files(folder).delete(folder, True)
        return found

"""Values that a job's tasks share, readable by workers that have no copy of this package."""

from __future__ import annotations

import pickle

from pyspark import cloudpickle
from pyspark.sql import SparkSession


class Shared:
    """A broadcast of `value` as bytes that carry the classes of this package with them.

    Spark pickles a broadcast value by reference, which a worker without the package cannot read. Each task
    unpacks its own copy, so a task may keep what it learns in it.
    """

    def __init__(self, spark: SparkSession, value) -> None:
        self._packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self._packed.value)

"""One live object per Python worker."""

from __future__ import annotations

import pickle
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def shared(spark: SparkSession, value) -> Callable:
    """A function that gives tasks `value`, of bounded size, broadcast once.

    It is unpickled once per worker, so what an object caches outlives a task; classes travel by value.
    """
    held = spark.sparkContext.broadcast({"pickled": cloudpickle.dumps(value)})

    def get():
        box = held.value
        if "live" not in box:
            box["live"] = pickle.loads(box["pickled"])
        return box["live"]

    return get

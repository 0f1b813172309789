"""What each step of the partition costs over a table of features: five runs, each with one step more."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame

from tessellar.functions import grid
from tessellar.operators import keys
from tessellar.sources import sinks
from tessellar.tables import shared_dir


def ladder(features: DataFrame) -> dict[str, float]:
    """Seconds to count the rows, read all columns, compute cells, explode to coarse cells, and write them by cell."""
    cells = keys.celled(features)
    coarse = keys.coarse_cells(cells).withColumn("coarse_key", keys_of())
    drain = lambda df: df.write.format("noop").mode("overwrite").save()
    steps = {
        "a_count": features.count,
        "b_read": lambda: drain(features),
        "c_cells": lambda: drain(cells),
        "d_explode": lambda: drain(coarse),
        "e_partition": lambda: sinks.write_partitioned(coarse, shared_dir(features.sparkSession), "coarse_key"),
    }
    took = {}
    for name, step in steps.items():
        began = time.perf_counter()
        step()
        took[name] = round(time.perf_counter() - began, 3)
    return took


def keys_of():
    """Coarse cells folded to bands of longitude, so that a small table doesn't write thousands of folders."""
    return grid.coarse("coarse_lon")

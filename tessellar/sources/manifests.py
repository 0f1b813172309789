"""Manifests, ledgers and state as JSON arrays or Parquet tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TILE_RECORD = "theme string, z int, x int, y int, bbox array<double>, size_bytes long, feature_count long"
TILE_LEDGER = "z int, x int, y int, status string, feature_count long, size_bytes long, sha256 string, at string"
TILE_ENTRY = "z int, x int, y int, status string, size_bytes long, feature_count long, theme_counts map<string,long>, oversize boolean, bbox array<double>, at string"
FILE_LEDGER = "file_key string, local_path string, size_bytes long, sha256 string, status string, at string"
FILE_EXTENT = "intermediate string, rows long, lon_lo_min int, lon_hi_max int, lat_lo_min int, lat_hi_max int, bytes long"
STATE = "cycle int, completed_peels_in_cycle array<int>, last_completed_at string, started_at string, release string"

# Fixed names of a tile's or file's states.
STATUSES = ("done", "empty", "failed", "in_progress")


def read_json(spark: SparkSession, path: str | list[str], schema: str, missing_ok: bool = True, lines: bool = False) -> DataFrame:
    """Rows of JSON arrays or objects, or of ``lines`` with an object each; text that isn't JSON gives none, and so does a missing file unless
    ``missing_ok`` is false."""
    try:
        df = spark.read.schema(schema).option("multiLine", not lines).option("mode", "PERMISSIVE").json(path)
        # what can't be parsed comes as a row of nulls
        return df.filter(reduce(or_, [F.col(c).isNotNull() for c in df.columns]))
    except Exception as e:
        if not missing_ok or "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def write_json(df: DataFrame, path: str, order: tuple[str, ...] = ("z", "x", "y"), only_done: bool = True) -> None:
    """One file of JSON lines in a fixed order of fields and rows. A manifest has a row for a tile, so this is
    for the outlets that need a single file; tables stay Parquet."""
    if only_done and "status" in df.columns:
        df = df.filter("status = 'done'")
    (df.orderBy(*order) if order else df).coalesce(1).write.mode("overwrite").json(path)


def as_json(df: DataFrame, *fields: str):
    """A row for each row: its fields as JSON, in the order given."""
    return df.select(F.to_json(F.struct(*fields)).alias("json"))


def fold_extents(files: DataFrame) -> DataFrame:
    """Totals over the manifests of files that have rows; without any, the whole grid."""
    f = files.filter("coalesce(rows, 0) > 0 and intermediate is not null")
    whole = {"lon_lo_min": (F.min, 0), "lon_hi_max": (F.max, 3599), "lat_lo_min": (F.min, 0), "lat_hi_max": (F.max, 1799)}
    return f.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"), *[F.coalesce(g(c), F.lit(v)).alias(c) for c, (g, v) in whole.items()])

"""Writers. Spark's committer makes each write whole or absent, and overwriting by key makes it repeatable."""

from __future__ import annotations

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar.tables import materialize

CODECS = {"gzip": {"compression": "gzip"}, "zstd": {"compression": "zstd", "parquet.compression.codec.zstd.level": "3"}}


def write_table(df: DataFrame, path: str, codec: str = "zstd", mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CODECS[codec]).parquet(path)


def write_single(df: DataFrame, path: str, codec: str = "zstd") -> None:
    """One file in a folder: for tables that fit a task."""
    write_table(df.coalesce(1), path, codec)


def write_partitioned(df: DataFrame, path: str, *keys: str, codec: str = "zstd", salt: int = 1) -> None:
    """key=value folders. Rows meet by key first, so that a task opens a few files at a time; ``salt`` spreads the rows of
    each key over that many tasks, for keys that hold a great part of all rows. It comes from the rows, so that a task
    that runs again deals them alike."""
    by = [F.col(k) for k in keys]
    if salt > 1:
        # maps have no hash
        by.append(F.pmod(F.xxhash64(*[F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in df.schema]), F.lit(salt)))
    df.repartition(*by).write.mode("overwrite").options(**CODECS[codec]).partitionBy(*keys).parquet(path)


def write_sorted(df: DataFrame, path: str, *keys: str, codec: str = "gzip") -> None:
    """Ranges of rows in order, for narrow statistics of row groups."""
    write_table(df.repartitionByRange(*keys).sortWithinPartitions(*keys), path, codec)


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return pafs.FileSystem.from_uri("/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path)


def write_tiles(df: DataFrame, path: str, codec: str = "zstd", flat: bool = False) -> DataFrame:
    """One file for each (z, x, y), as ``z/x/y.parquet``, or as ``z_x_y.parquet.gz`` if ``flat``. Spark writes a folder for each
    tile; tasks then move the files to their places, each over what was there in one step, and a task that runs again finds its files
    moved. Returns z, x, y and measured size_bytes."""
    spark = df.sparkSession
    stage = f"{path.rstrip('/')}/_stage"
    codec = "gzip" if flat else codec
    df.repartition("z", "x", "y").write.mode("overwrite").options(**CODECS[codec]).partitionBy("z", "x", "y").parquet(stage)
    sizes = materialize(tile_sizes(spark, stage))

    def move(batches):
        fs, base = open_fs(path)
        for b in batches:
            for r in b.to_pylist():
                to = f"{base}/{r['z']}_{r['x']}_{r['y']}.parquet.gz" if flat else f"{base}/{r['z']}/{r['x']}/{r['y']}.parquet"
                fs.create_dir(to.rpartition("/")[0], recursive=True)
                try:
                    fs.move(open_fs(r["path"])[1], to)
                except FileNotFoundError:
                    if fs.get_file_info(to).type != pafs.FileType.File:
                        raise
            yield b.drop_columns(["path"])

    moved = materialize(sizes.mapInArrow(move, "z int, x int, y int, size_bytes long"))
    fs, base = open_fs(stage)
    fs.delete_dir(base)
    return moved


def delete_tiles(tiles: DataFrame, path: str) -> None:
    """Deletes the files of tiles (z, x, y) below a path, in tasks."""

    def drop(rows):
        fs, base = open_fs(path)
        for r in rows:
            at = f"{base}/{r['z']}/{r['x']}/{r['y']}.parquet"
            if fs.get_file_info(at).type == pafs.FileType.File:
                fs.delete_file(at)

    tiles.select("z", "x", "y").foreachPartition(drop)


def tile_sizes(spark: SparkSession, path: str) -> DataFrame:
    """z, x, y, path and bytes of each tile's file in key=value folders."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    key = {k: F.regexp_extract("path", rf"/{k}=(\d+)/", 1).cast("int") for k in "zxy"}
    return files.select(F.col("path"), F.col("length").alias("size_bytes")).withColumns(key).select("z", "x", "y", "path", "size_bytes")


def measured(spark: SparkSession, path: str) -> DataFrame:
    """Bytes of each file that a Parquet table has rows in, and its rows."""
    return spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.first("_metadata.file_size").alias("size_bytes"), F.count(F.lit(1)).alias("rows"))

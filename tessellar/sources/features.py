"""Feature tables: id, theme, geometry (opaque WKB), bbox (xmin, ymin, xmax, ymax), and what else a theme has."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed names of the themes.
THEMES = ("buildings", "infrastructure", "land", "land_use", "segments", "water")

BBOX = T.StructType([T.StructField(c, T.DoubleType()) for c in ("xmin", "ymin", "xmax", "ymax")])
FEATURE = T.StructType([T.StructField("id", T.StringType()), T.StructField("theme", T.StringType()), T.StructField("geometry", T.BinaryType()), T.StructField("bbox", BBOX)])
#: What a directory layout of keys adds to a table that is read back; no tile holds it.
LAYOUT_COLUMNS = ("mercator_x", "mercator_y", "coarse_lon", "coarse_lat")


def check_themes(themes) -> list[str]:
    unknown = sorted(set(themes) - set(THEMES))
    if unknown:
        raise ValueError(f"unknown themes: {unknown}")
    return list(themes)


def read_features(spark: SparkSession, paths: str | list[str], theme: str | None = None, hive: bool | None = None, anonymous: bool = False, **options) -> DataFrame:
    """One or many Parquet files or folders, merged by column name.

    ``hive``: True keeps columns of key=value folders, False doesn't look for them, None drops those of the layouts
    written here. ``theme`` replaces any theme column. ``anonymous``: object store without credentials.
    """
    r = spark.read.option("mergeSchema", True)
    if hive is False:
        r = r.option("recursiveFileLookup", True)
    if anonymous:
        r = r.option("fs.s3a.aws.credentials.provider", "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider")
    df = r.options(**options).parquet(*([paths] if isinstance(paths, str) else paths))
    if hive is None:
        df = df.drop(*LAYOUT_COLUMNS)
    return df if theme is None else df.withColumn("theme", F.lit(check_themes([theme])[0]))


def union_themes(*tables: DataFrame) -> DataFrame:
    """All rows of all tables by column name, nested fields too; what a table lacks is null. Nothing is
    made distinct."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def with_bbox(df: DataFrame) -> DataFrame:
    """Pack xmin..ymax into ``bbox``; a row without coordinates has none."""
    box = F.struct(*[F.col(c).cast("double").alias(c) for c in BBOX.names])
    return df.withColumn("bbox", F.when(F.coalesce(*[F.col(c) for c in BBOX.names]).isNotNull(), box)).drop(*BBOX.names)


def has_box() -> Column:
    return F.col("bbox").isNotNull()


def overlaps(west, south, east, north, bbox: str = "bbox") -> Column:
    """Strict overlap: a box that only touches an edge, or has no width on it, is out. Plain comparisons of nested
    fields, which Parquet scans take over."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    c = lambda f: F.col(f"{bbox}.{f}")
    return (c("xmin") < lit(east)) & (c("xmax") > lit(west)) & (c("ymin") < lit(north)) & (c("ymax") > lit(south))


def lng_band(lo, hi, bbox: str = "bbox") -> Column:
    """Overlap with a band of longitudes; bands side by side share the rows that cross their border."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return (F.col(f"{bbox}.xmin") < lit(hi)) & (F.col(f"{bbox}.xmax") > lit(lo))


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """path and size of all files below a folder, in order; none if the folder is missing."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
        return files.select("path", F.col("length").alias("size_bytes")).orderBy("path")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "path string, size_bytes long")


def file_hashes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))


def partition_keys(df: DataFrame, *keys: str) -> DataFrame:
    """The keys that a partitioned table has rows for."""
    return df.select(*keys).distinct()


def keys_in_names(df: DataFrame) -> DataFrame:
    """x and y in the names of the files that a table was read from."""
    from tessellar.functions.values import bucket_of_name

    return df.select(F.input_file_name().alias("_f")).distinct().withColumns(bucket_of_name(F.col("_f"))).select("x", "y").distinct()

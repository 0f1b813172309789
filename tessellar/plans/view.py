"""A feature table made of the ``events`` test table. The text runs in Spark and in DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar.sources.features import with_bbox

FEATURES = """
with p as (
  select event_id as id,
    case event_type when 'view' then 'water' when 'signup' then 'land'
      when 'error' then 'segments' when 'click' then 'buildings'
      when 'purchase' then (case when event_id % 2 = 0 then 'land_use' else 'infrastructure' end)
    end as theme,
    case when event_id % 3 = 0
      then cast(12000 + (event_id * 37) % 1000 as double) / cast(1000 as double)
      else cast((event_id * 7919 + user_id * 104729) % 36000 as double) / cast(100 as double) - cast(180 as double)
    end as cx,
    case when event_id % 3 = 0
      then cast(55000 + (event_id * 53) % 1000 as double) / cast(1000 as double)
      else cast((event_id * 6007 + user_id * 15485863) % 17800 as double) / cast(100 as double) - cast(89 as double)
    end as cy,
    case when event_id % 101 = 0 then cast(12.5 as double)
      else cast(cast(floor(value) as bigint) % 40 as double) / cast(400 as double) end as hw
  from {events})
select id, theme,
  case when id % 997 = 0 then null when id % 211 = 0 then cast(179.5 as double) else cx - hw end as xmin,
  case when id % 997 = 0 then null else cy - hw end as ymin,
  case when id % 997 = 0 then null when id % 211 = 0 then cast(-179.5 as double) else cx + hw end as xmax,
  case when id % 997 = 0 then null else cy + hw end as ymax
from p
"""


def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FEATURES, events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, theme, geometry and bbox."""
    return with_bbox(plain(spark, sf_dir)).withColumn("geometry", F.encode(F.col("id").cast("string"), "utf-8"))

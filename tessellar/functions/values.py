"""Keys, names, byte sizes, digests and argument checks."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns of the arguments that runs take.
RELEASE = r"^\d{4}-\d{2}-\d{2}(\.\d+)?$"
OBJECT_KEY = r"^s3a?://[A-Za-z0-9._\-]+/[A-Za-z0-9._\-/=]+\.parquet$"
MEMORY = r"^\d+(\.\d+)?\s*(KB|MB|GB|TB)$"


def tile_key(z="z", x="x", y="y") -> Column:
    return F.concat_ws(":", *(F.col(c).cast("string") for c in (z, x, y)))


def flat_name(z="z", x="x", y="y") -> Column:
    return F.concat(F.concat_ws("_", *(F.col(c).cast("string") for c in (z, x, y))), F.lit(".parquet.gz"))


def bucket_of_name(name: Column) -> dict[str, Column]:
    """x and y of names such as ``z6_33_20.parquet``."""
    return {k: F.regexp_extract(name, r"z6_(\d+)_(\d+)", i + 1).cast("int") for i, k in enumerate("xy")}


def peel_name(i: Column) -> Column:
    return F.concat(F.lit("peel_"), F.lpad(i.cast("string"), 2, "0"))


def format_bytes(n: Column) -> Column:
    unit = lambda size, digits, name: F.concat(F.format_string(f"%.{digits}f", F.bround(n / size, digits)), F.lit(f" {name}"))
    return F.when(n >= 1e12, unit(1e12, 1, "TB")).when(n >= 1e9, unit(1e9, 1, "GB")).when(n >= 1e6, unit(1e6, 0, "MB")).otherwise(unit(1e3, 0, "KB"))


def short_digest(c: Column) -> Column:
    return F.substring(F.sha1(c), 1, 12)


def utc_now() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def check(pattern: str, value: str) -> str:
    if not re.match(pattern, value):
        raise ValueError(f"not allowed: {value!r}")
    return value


def is_release(c: Column) -> Column:
    return c.rlike(RELEASE)

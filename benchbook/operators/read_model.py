"""A kept view: its rows lie by a bucket of their id, and a refresh writes anew only the buckets that changed ids fall into.

A manifest names the version in which each bucket was last written. It appears whole after the rows, so readers see a refresh
either not at all or entirely, and one that was killed leaves the view as it was. There is one writer at a time.
"""

from __future__ import annotations

import json

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from benchbook.sources.landing import written
from benchbook.sources.shared_files import names, opened, put_json

#: What a refresh of one id writes anew is a bucket, so their number is to grow with the view; the manifest has a value for each.
BUCKETS = 64


def _bucket(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def manifest(folder: str) -> dict:
    """version, key, buckets, schema, and of: bucket to the version that holds it."""
    last = names(f"{folder}/manifest")[-1]
    with opened(folder)[0].open_input_stream(last) as f:
        return json.loads(f.read())


def _write(rows: DataFrame, folder: str, told: dict) -> list[str]:
    """Writes rows as a version of the manifest to be; the buckets that have any. A bucket lies over several tasks if it's large."""
    target = f"{folder}/rows/version={told['version']}"
    placed = rows.withColumn("bucket", _bucket(F.col(told["key"]), told["buckets"])).repartitionByRange("bucket", told["key"])
    placed.sortWithinPartitions("bucket", told["key"]).write.mode("overwrite").partitionBy("bucket").parquet(target)
    files, path = opened(target)
    return [f.base_name.removeprefix("bucket=") for f in files.get_file_info(fs.FileSelector(path)) if f.base_name.startswith("bucket=")]


def _publish(folder: str, told: dict) -> None:
    put_json(f"{folder}/manifest", f"{told['version']:09d}.json", told)


def build(view: DataFrame, folder: str, key: str = "case_id", buckets: int = BUCKETS) -> None:
    """Writes a view whole, as the first version of a new folder. A view without rows is kept, too."""
    told = {"version": 1, "key": key, "buckets": buckets, "schema": view.schema.json()}
    _publish(folder, {**told, "of": {b: 1 for b in _write(view, folder, told)}})


def refresh(changed: DataFrame, folder: str, gone: DataFrame | None = None) -> int:
    """changed: the view's rows, as they are now, of ids that are new or changed; gone: ids (under the key's name) that the view loses.

    Returns the number of buckets that were written. Applied twice it changes nothing more.
    """
    spark, old = changed.sparkSession, manifest(folder)
    key, told = old["key"], {**old, "version": old["version"] + 1}
    rows = written(changed.select(*StructType.fromJson(json.loads(old["schema"])).names))
    ids = rows.select(key) if gone is None else rows.select(key).union(gone.select(key))
    ids = written(ids.distinct())
    # At most as many rows as there are buckets.
    touched = [str(r[0]) for r in ids.select(_bucket(F.col(key), old["buckets"])).distinct().collect()]
    if not touched:
        return 0
    before = read(spark, folder, touched).withColumnRenamed(key, "__old")
    kept = before.join(ids, F.col("__old").eqNullSafe(F.col(key)), "left_anti").withColumnRenamed("__old", key)
    full = set(_write(kept.unionByName(rows), folder, told))
    of = {b: v for b, v in old["of"].items() if b not in touched}
    _publish(folder, {**told, "of": of | {b: told["version"] for b in touched if b in full}})
    return len(touched)


def read(spark: SparkSession, folder: str, buckets: list[str] | None = None) -> DataFrame:
    """The view as the last manifest has it; with buckets, their rows only."""
    told = manifest(folder)
    schema = StructType.fromJson(json.loads(told["schema"]))
    paths = [f"{folder}/rows/version={v}/bucket={b}" for b, v in told["of"].items() if buckets is None or b in buckets]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def lookup(spark: SparkSession, folder: str, ids: list) -> DataFrame:
    """Rows of a page's ids; only the buckets of these are opened, and the filter reaches their scan."""
    told = manifest(folder)
    kind = StructType.fromJson(json.loads(told["schema"]))[told["key"]].dataType
    wanted = spark.createDataFrame([(i,) for i in ids], StructType().add("id", kind))
    buckets = [str(r[0]) for r in wanted.select(_bucket(F.col("id"), told["buckets"])).distinct().collect()]
    return read(spark, folder, buckets).where(F.col(told["key"]).isin(list(ids)))

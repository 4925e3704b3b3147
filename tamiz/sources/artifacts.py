"""Readers and writers of the pipeline's files: JSON documents, and tables that stand for the history."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def _files(spark: SparkSession, path: str):
    """The file system of a path, and a maker of its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _present(spark: SparkSession, path: str) -> str | None:
    """The table's path, or that of its predecessor where a swap was broken off between its two renames."""
    fs, make = _files(spark, path)
    return next((p for p in (path, f"{path}.before") if fs.exists(make(p))), None)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A table that ``replace_table`` wrote, or None where there is none."""
    found = _present(spark, path)
    return spark.read.parquet(found) if found else None


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """(key, status), or None where there is no readable snapshot: a first run, or a broken file, which counts as one."""
    found = _present(spark, path)
    if found is None:
        return None
    try:
        df = spark.read.schema("key string, status string").parquet(found)
        df.count()  # a snapshot has a row for each case
        return df
    except (PySparkException, Py4JJavaError):
        return None


def _stage(df: DataFrame, path: str) -> None:
    staged = f"{path}.staged"
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(staged)


def _publish(spark: SparkSession, path: str) -> None:
    """Renames the staged file over the old one, in one step where the file system has such a step."""
    jvm = spark._jvm
    fs, make = _files(spark, path)
    part = next(s.getPath() for s in fs.listStatus(make(f"{path}.staged")) if s.getPath().getName().startswith("part-"))
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    target = fs.makeQualified(make(path))
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(part), target, over)
    fs.delete(make(f"{path}.staged"), True)


def write_document(df: DataFrame, path: str) -> None:
    """One row as one JSON file, renamed over the old one: readers see the old or the new file, never a part or none."""
    _stage(df, path)
    _publish(df.sparkSession, path)


def write_site(publications: DataFrame, edition: DataFrame, publications_path: str, edition_path: str) -> None:
    """Both documents: written beside the old ones first, then put in place, the edition before the publications."""
    _stage(publications, publications_path)
    _stage(edition, edition_path)
    _publish(publications.sparkSession, edition_path)
    _publish(publications.sparkSession, publications_path)


#: Buckets of a history: a run rewrites only those that its documents fall into.
BUCKETS = 64


def bucket(key: str = "id", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def touched(changed: DataFrame, buckets: int = BUCKETS, key: str = "id") -> list[int]:
    """The buckets of the changed keys: at most ``buckets`` numbers."""
    return sorted(r.b for r in changed.select(bucket(key, buckets).alias("b")).distinct().collect())


def read_buckets(spark: SparkSession, path: str, numbers: list[int] | None = None) -> DataFrame | None:
    """A bucketed history, or those of its buckets; what a broken-off ``replace_buckets`` staged takes no part."""
    fs, make = _files(spark, path)
    if not fs.exists(make(path)):
        return None
    df = spark.read.parquet(path)
    return (df if numbers is None else df.filter(F.col("bucket").isin(numbers))).drop("bucket")


def replace_buckets(df: DataFrame, changed: DataFrame, path: str, buckets: int = BUCKETS, key: str = "id") -> None:
    """Writes the rows of the buckets that the ``changed`` keys fall into over the old ones; files of other buckets are neither
    read nor written. ``df`` holds at least all rows of these buckets and may be made from the table: it is staged beside it first."""
    spark = df.sparkSession
    fs, make = _files(spark, path)
    numbers = touched(changed, buckets, key)
    staged = f"{path}.staged"
    rows = df.withColumn("bucket", bucket(key, buckets)).filter(F.col("bucket").isin(numbers))
    rows.repartition("bucket").write.mode("overwrite").parquet(staged)
    spark.read.schema(rows.schema).parquet(staged).repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    fs.delete(make(staged), True)


def replace_table(df: DataFrame, path: str) -> None:
    """Writes beside the table, then swaps by two renames. The old table may be read while the new one is made from it, and stays
    until the new one is in place; ``read_table`` finds it if the swap is broken off between them."""
    fs, make = _files(df.sparkSession, path)
    staged, before = make(f"{path}.staged"), make(f"{path}.before")
    df.write.mode("overwrite").parquet(f"{path}.staged")
    if fs.exists(make(path)):
        fs.delete(before, True)
        fs.rename(make(path), before)
    fs.rename(staged, make(path))
    fs.delete(before, True)

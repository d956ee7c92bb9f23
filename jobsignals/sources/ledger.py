"""Page ledger: the paging facts of every page a run has read, kept by merge.

A version is a folder `v<number>` below the ledger; it counts once Spark has committed it
(`_SUCCESS`). A merge reads the newest committed version, adds the new facts, reduces them to one
row per (page_key, page_no) and writes the next number; readers switch to it only when its commit
marker stands, so a run that dies while merging leaves the ledger as it was. All but the two
newest versions are removed after a merge, so the folder stays small however many runs there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "page_key string, page_no int, has_more boolean, link_no int, first_run long"
KEEP_VERSIONS = 2


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def numbered(spark: SparkSession, path: str, prefix: str) -> list[tuple[int, bool]]:
    """(number, committed) of every folder `<prefix><number>` below path, oldest first."""
    where, fs = _fs(spark, path)
    if not fs.exists(where) or not fs.getFileStatus(where).isDirectory():
        return []
    out = []
    for status in fs.listStatus(where):
        name = status.getPath().getName()
        rest = name[len(prefix):]
        if status.isDirectory() and name.startswith(prefix) and rest.isdigit():
            done = fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
            out.append((int(rest), bool(done)))
    return sorted(out)


def remove(spark: SparkSession, path: str) -> None:
    where, fs = _fs(spark, path)
    fs.delete(where, True)


def _versions(spark: SparkSession, path: str) -> list[tuple[int, bool]]:
    return numbered(spark, path, "v")


def _folder(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/v{number:08d}"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version; none yet, no rows."""
    done = [n for n, ok in _versions(spark, path) if ok]
    if not done:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(_folder(path, done[-1]))


def merge_ledger(spark: SparkSession, path: str, facts: DataFrame) -> DataFrame:
    """Add facts (page_key, page_no, has_more, link_no) of this run; returns the new version.

    A page seen more than once has more if any copy links on; its link number is the largest.
    """
    versions = _versions(spark, path)
    run = (versions[-1][0] + 1) if versions else 1
    new = facts.select("page_key", F.col("page_no").cast("int"), "has_more",
                       F.col("link_no").cast("int"), F.lit(run).cast("long").alias("first_run"))
    merged = (read_ledger(spark, path).unionByName(new)
              .groupBy("page_key", "page_no")
              .agg(F.bool_or("has_more").alias("has_more"), F.max("link_no").alias("link_no"),
                   F.min("first_run").alias("first_run")))
    merged.write.parquet(_folder(path, run))
    for number, _ in _versions(spark, path)[:-KEEP_VERSIONS]:
        remove(spark, _folder(path, number))
    return read_ledger(spark, path)

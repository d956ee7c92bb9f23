"""Post tables on parquet: per thread, merged, structured."""

from __future__ import annotations

import json
import warnings
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsignals.functions.text import month_key
from jobsignals.operators.dedupe import keep_first
from jobsignals.schemas import COMMENTS, STRUCTURED
from jobsignals.sources.ledger import numbered, remove

#: Compacted versions kept; readers take the newest committed one.
KEEP_COMPACTED = 2


def _replace_partitions(df: DataFrame, path: str, *by: str, order: str | None = None) -> None:
    """Overwrite only the partitions present in `df`; an empty frame is a no-op.

    Rebalancing gives one file per small partition value and lets the adaptive
    planner cut a value that holds much of the data into several tasks. Rows are
    sorted by `order` inside files only.
    """
    (df.hint("rebalance", *by).sortWithinPartitions(*by, *([order] if order else []))
     .write.partitionBy(*by).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def write_thread_comments(comments: DataFrame, path: str) -> None:
    """Comments with a `thread_id`; rewriting a thread replaces its partition."""
    _replace_partitions(comments.withColumn("id", F.col("id").cast("string")), path, "thread_id")


def write_batch_comments(comments: DataFrame, stream_id: str, batch_id: int, path: str) -> None:
    """One partition per stream and micro-batch, so a replayed batch rewrites itself only."""
    _replace_partitions(comments.withColumns({"stream_id": F.lit(stream_id),
                                              "batch_id": F.lit(batch_id)}),
                        path, "stream_id", "batch_id")


class SkippedFile(UserWarning):
    """A file that is no readable table has been left out."""


def _footers(parts):
    """(path, schema) of each file, from its parquet footer alone; schema null if unreadable."""
    import pandas as pd
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    for part in parts:
        out = []
        for path in part["path"]:
            try:
                fs, where = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(where) as f:
                    schema = pq.read_schema(f)
                own = sorted((n, str(t)) for n, t in zip(schema.names, schema.types))
                out.append((path, json.dumps(own)))
            except Exception:  # any file that is no parquet, or cannot be opened
                out.append((path, None))
        yield pd.DataFrame(out, columns=["path", "schema"])


def schema_census(spark: SparkSession, path: str) -> DataFrame:
    """path and schema (JSON of sorted name, type pairs) of every file below path.

    Files are listed as binary files without their content; tasks read the footers.
    """
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
              .select("path").where(~F.element_at(F.split("path", "/"), -1).rlike("^[._]")))
    return listed.repartition(max(1, spark.sparkContext.defaultParallelism), "path").mapInPandas(
        _footers, "path string, schema string")


def read_typed(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """`columns` as strings from parquet files that may store them in different types.

    Where all files agree, that is one read. Otherwise files are grouped by their own
    schema, each group is read as it is stored, cast, and united by name; the footers are
    read by tasks (`schema_census`), the driver only groups the paths. A column a file
    lacks is null there. A file that is no parquet is left out with a warning.
    """
    def cast(df: DataFrame) -> DataFrame:
        parts = [c for c in ("thread_id", "stream_id", "batch_id") if c in df.columns]
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c)
                           for c in dict.fromkeys([*columns, *parts])])

    try:
        return cast(spark.read.option("mergeSchema", True).parquet(path))
    except (PySparkException, Py4JJavaError) as e:
        if isinstance(e, AnalysisException) and e.getCondition() == "PATH_NOT_FOUND":
            raise
    groups: dict[str, list[str]] = {}
    for r in schema_census(spark, path).collect():  # one short row per file
        if r.schema is None:
            warnings.warn(f"left out, not readable as parquet: {r.path}", SkippedFile,
                          stacklevel=2)
        else:
            groups.setdefault(r.schema, []).append(r.path)
    frames = [cast(spark.read.option("basePath", path).parquet(*files))
              for _, files in sorted(groups.items())]
    if not frames:
        return cast(spark.createDataFrame([], "id string"))
    every = frames[0]
    for more in frames[1:]:
        every = every.unionByName(more, allowMissingColumns=True)
    return every


def read_comments(spark: SparkSession, path: str) -> DataFrame:
    """All threads or batches as one table, columns by name, first row per id.

    The first is the one with the least date, then the earliest batch, so that an
    edited copy of a page that lands later changes nothing; then by text, user and url.
    Partition columns stay, for pruning. Unreadable files are left out with a warning.
    """
    rows = read_typed(spark, path, COMMENTS.names)
    landing = [F.col(c).cast(t) for c, t in (("batch_id", "long"), ("stream_id", "string"))
               if c in rows.columns]
    order = [F.col("thread_date"), *landing, *map(F.col, ("raw_text", "user", "url"))]
    return keep_first(rows, [F.col("id")], order)


def compact_comments(spark: SparkSession, store: str, compacted: str) -> int:
    """Rewrite the store, first row per id, as one folder per month; returns the version.

    The version is a new folder `c<number>` that counts once Spark has committed it
    (`_SUCCESS`), so a compaction that dies on the way leaves readers on the version before.
    Compacting again gives the same rows. Only the newest KEEP_COMPACTED committed versions
    stay; folders that a crash left uncommitted go with the next compaction.
    """
    versions = numbered(spark, compacted, "c")
    number = (versions[-1][0] + 1) if versions else 1
    rows = read_comments(spark, store).select(*COMMENTS.names)
    (rows.withColumn("month", F.coalesce(month_key(F.to_date("thread_date")), F.lit("none")))
     .hint("rebalance", "month").sortWithinPartitions("month", "thread_date", "id")
     .write.partitionBy("month").parquet(f"{compacted}/c{number:08d}"))
    done = [n for n, ok in numbered(spark, compacted, "c") if ok]
    for n, ok in numbered(spark, compacted, "c"):
        if n < number and (not ok or n not in done[-KEEP_COMPACTED:]):
            remove(spark, f"{compacted}/c{n:08d}")
    return number


def read_compacted(spark: SparkSession, compacted: str) -> DataFrame:
    """The newest committed compaction, as it stands: no grouping at read time."""
    done = [n for n, ok in numbered(spark, compacted, "c") if ok]
    if not done:
        return spark.createDataFrame([], COMMENTS)
    return (spark.read.schema(T.StructType([*COMMENTS.fields,
                                            T.StructField("month", T.StringType())]))
            .parquet(f"{compacted}/c{done[-1]:08d}"))


def write_raw(posts: DataFrame, path: str, range_path: str | None = None) -> None:
    """Merged raw posts, one folder per month, sorted by date inside files.

    Months present in `posts` are replaced; no posts, no change. Posts without a
    readable date share the null month. The first and last date of the table go to
    `range_path`, so no reader depends on a file name that encodes them. They are
    read back from the one stored column.
    """
    typed = posts.withColumns({"id": F.col("id").cast("string"),
                               "month": month_key(F.col("thread_date").try_cast("date"))})
    _replace_partitions(typed, path, "month", order="thread_date")
    if range_path:
        stored = posts.sparkSession.read.schema("thread_date string, month string").parquet(path)
        date_range(stored).write.mode("overwrite").json(range_path)


def merge_comments(spark: SparkSession, store: str, path: str,
                   range_path: str | None = None) -> None:
    """All stored threads or batches, first row per id, as the merged raw table.

    Without a store, or with an empty one, there is nothing to merge and no change.
    """
    try:
        rows = read_comments(spark, store)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return
    if not rows.isEmpty():
        write_raw(rows.select(*COMMENTS.names), path, range_path)


def date_range(posts: DataFrame, date: str = "thread_date") -> DataFrame:
    return posts.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw posts in whatever columns they have; a missing path is named clearly."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"input not found: {path}") from e
        raise


def write_structured(posts: DataFrame, path: str) -> None:
    """Structured posts, one folder per month, ready for month pruning.

    Posts without dates, row by row or as a whole, are in the null month.
    """
    month = month_key(F.col("date")) if "date" in posts.columns else F.lit(None).cast("string")
    (posts.withColumn("month", month).hint("rebalance", "month")
     .write.partitionBy("month").mode("overwrite").parquet(path))


def read_structured(spark: SparkSession, path: str) -> DataFrame:
    """The 26 columns in order, plus `month`, the partition column."""
    schema = T.StructType([*STRUCTURED.fields, T.StructField("month", T.StringType())])
    return spark.read.schema(schema).parquet(path)

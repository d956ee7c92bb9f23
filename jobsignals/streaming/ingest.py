"""Landed pages to the comment table: resumable batch, and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jobsignals.fixed_values import BASE_URL, THREADS_FROM
from jobsignals.operators.pages import complete_from_facts, page_facts, parse_comments
from jobsignals.schemas import PAGES
from jobsignals.session import temporary
from jobsignals.sources.ledger import merge_ledger
from jobsignals.sources.state import mark_processed, pending_threads, read_processed
from jobsignals.sources.tables import write_batch_comments, write_thread_comments

#: Files of one micro-batch; every file is read, in as many batches as it takes.
FILES_PER_BATCH = 1000


def ingest_batch(spark: SparkSession, threads: DataFrame, pages: DataFrame, store: str,
                 processed: str, since: str = THREADS_FROM, base_url: str = BASE_URL,
                 reopen_newest: bool = False, first_page: int | None = None,
                 ledger: str | None = None) -> int:
    """Parse the pages of all pending threads, store them, then mark the complete ones.

    A thread is marked once all its pages have landed, also if no comment stands
    on them. Until then it stays pending, and each run rewrites what has landed of it.
    Which threads are complete is settled before any page is parsed, so pages that land
    meanwhile are never taken for read. Data is committed before the mark: a run
    that dies in between is repeated and rewrites the same partitions.

    Pages are numbered as the landing numbers them; the first page of a thread is taken from
    the data (`first_pages`), unless `first_page` is given. Only pages of pending threads are
    read: when the landing is partitioned by page_key, the join with the pending threads
    prunes the scan to their folders at run time, so a run without pending threads reads no
    html. With a `ledger`, the paging facts of every page read are merged into it, and
    completeness is judged on all facts seen so far. Returns the number of pending threads.
    """
    pending = pending_threads(threads, read_processed(spark, processed), since, reopen_newest)
    # The thread list alone decides about `since`: a page's own date may be blank or another.
    keys = pending.select(F.col("id").alias("page_key"))
    wanted = pages.join(keys, "page_key", "left_semi")
    with temporary(spark, "complete") as path:
        facts = page_facts(wanted)
        if ledger is not None:
            known = merge_ledger(spark, ledger, facts)
            facts = known.join(keys, "page_key", "left_semi")
        complete_from_facts(facts, first_page).write.parquet(path)
        write_thread_comments(parse_comments(wanted, base_url, keep_page=True), store)
        mark_processed(spark.read.schema("id string").parquet(path), processed)
    return keys.count()


def ingest_stream(spark: SparkSession, landing: str, store: str, checkpoint: str,
                  base_url: str = BASE_URL, max_files: int = FILES_PER_BATCH) -> StreamingQuery:
    """Parse whatever has landed since the last run, then stop.

    The backlog is read in batches of `max_files`, so a failure repeats one of them.
    The query checkpoint is the processed set. The sink is one partition per stream
    and batch: a batch that is replayed after a failure replaces its own output, and
    a thread whose pages arrive in two batches keeps both parts. A stream is named by
    the id in its checkpoint, so another stream, or one that starts anew after its
    checkpoint was lost, never replaces what is stored. Read the result with
    `read_comments`, which keeps the first row per id.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        meta = batch.sparkSession.read.schema("id string").json(f"{checkpoint}/metadata")
        write_batch_comments(parse_comments(batch, base_url), meta.first()["id"], batch_id, store)

    source = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", max_files)
    return (source.parquet(landing).writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())

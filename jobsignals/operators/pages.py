"""Landed forum pages to rows.

Tokenizing markup is the one step that needs Python: it runs in Arrow batches
inside the scan stage, over pages that pass a native substring test. Title
matching, dates, links and paging facts are column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignals.fixed_values import BASE_URL, THREAD_TITLE, UNKNOWN_USER
from jobsignals.functions.text import strip
from jobsignals.sources import forum_html

# The helper travels with the task, so executors need no installed package.
register_pickle_by_value(forum_html)

OUT_ROWS = 5000             # rows per Arrow batch handed back, at most,
OUT_CHARS = 4 << 20         # and about so many characters


def _flat_map(pages: DataFrame, read, columns: list[str]) -> DataFrame:
    """Apply `read(html) -> rows` to each page, keeping page_key and thread_date.

    A worker holds the Arrow batch it was handed (Spark bounds its bytes), one page as a
    string, and one bounded batch of rows.
    """
    names = ["page_key", "thread_date", *columns]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.string()) for c in zip(*rows)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, chars = [], 0
        for batch in batches:
            for page in zip(*batch.columns):
                key, date, html = (v.as_py() for v in page)
                for r in read(html):
                    rows.append((key, date, *r))
                    chars += sum(len(v) for v in r if v)
                    if len(rows) >= OUT_ROWS or chars >= OUT_CHARS:
                        yield batch_of(rows)
                        rows, chars = [], 0
        if rows:
            yield batch_of(rows)

    schema = ", ".join(f"`{n}` string" for n in names)
    return (pages.filter(F.col("html").contains("athing"))
            .select(*(F.col(c).cast("string").alias(c)
                      for c in ("page_key", "thread_date", "html"))).mapInArrow(run, schema))


def parse_comments(pages: DataFrame, base_url: str = BASE_URL,
                   keep_page: bool = False) -> DataFrame:
    """Top-level comments: id, thread_date, raw_text, user, url.

    A row whose markup has no id cannot be keyed and is left out. With
    `keep_page`, the page's key comes along as `thread_id`.
    """
    html_rows, user = forum_html.comment_rows, UNKNOWN_USER
    rows = _flat_map(pages, lambda html: html_rows(html, base_url, user),
                     ["id", "raw_text", "user", "url"])
    page = [F.col("page_key").alias("thread_id")] if keep_page else []
    return rows.select("id", "thread_date", "raw_text", "user", "url", *page)


def parse_threads(pages: DataFrame, base_url: str = BASE_URL) -> DataFrame:
    """Hiring threads listed on index pages: id, title, thread_date, url."""
    rows = _flat_map(pages, forum_html.index_rows, ["id", "title"])
    date = title_to_date(F.col("title"))
    return (rows.withColumn("thread_date", date).filter(F.col("thread_date").isNotNull())
            .select("id", "title", "thread_date", permalink(F.col("id"), base_url).alias("url")))


def title_to_date(title: Column) -> Column:
    """'... (March 2021)' -> '2021-03-01'; null for other titles and bad months."""
    pattern = "(?U)" + THREAD_TITLE
    month_year = F.concat_ws(" ", F.lit("1"), F.regexp_extract(title, pattern, 1),
                             F.regexp_extract(title, pattern, 2))
    return F.date_format(F.try_to_timestamp(month_year, F.lit("d MMMM yyyy")), "yyyy-MM-dd")


def permalink(id: Column, base_url: str = BASE_URL) -> Column:
    return F.concat(F.lit(f"{base_url}/item?id="), id)


def more_link(html: Column) -> Column:
    """The opening tag of the page's 'more' link, '' when there is none."""
    return F.regexp_extract(
        html, r"(?is)<a\b[^>]*\bclass\s*=\s*(?:\"[^\"]*\bmorelink\b|'[^']*\bmorelink\b|morelink\b)[^>]*>", 0)


def next_href(html: Column) -> Column:
    """Target of the 'more' link with character references resolved, or null."""
    value = F.regexp_extract(more_link(html), r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]*)", 1)
    for entity, char in [("&quot;", '"'), ("&#x27;", "'"), ("&lt;", "<"), ("&gt;", ">"),
                         ("&amp;", "&")]:
        value = F.replace(value, F.lit(entity), F.lit(char))
    return F.when(value != "", strip(value))


def page_navigation(pages: DataFrame) -> DataFrame:
    """Paging facts per page; `has_more` needs the link, not its target."""
    html = F.col("html")
    return pages.select(
        "page_key", "page_no",
        F.when(html.contains("morelink"), next_href(html)).alias("next_href"),
        (html.contains("morelink") & (more_link(html) != "")).alias("has_more"))


def page_facts(pages: DataFrame) -> DataFrame:
    """page_key, page_no, has_more, link_no: the page number its 'more' link asks for, if any."""
    nav = page_navigation(pages)
    link = F.regexp_extract(F.coalesce(F.col("next_href"), F.lit("")), r"[?&]p=([0-9]{1,9})\b", 1)
    return nav.select("page_key", "page_no", "has_more",
                      F.when(link != "", link.cast("int")).alias("link_no"))


def first_pages(facts: DataFrame, first_page: int | None = None) -> DataFrame:
    """page_key and the number its first page has in the landing.

    Forum addresses count pages from 1, and a page's 'more' link asks for the address number
    after its own; so a page numbered n in the landing whose link asks for p is page p - 1 of
    the forum, and the landing's first page of that thread is n + 2 - p. A thread without such
    a link takes the number that the other threads show, and where no page shows one, the
    given `first_page` (0 when none is given). A given `first_page` holds for every thread.
    """
    keys = facts.select("page_key").distinct()
    if first_page is not None:
        return keys.withColumn("first", F.lit(first_page))
    shown = (facts.where(F.col("link_no").isNotNull())
             .groupBy("page_key").agg(F.min(F.col("page_no") + 2 - F.col("link_no")).alias("own")))
    overall = shown.agg(F.min("own").alias("m")).first().m  # one number
    fallback = 0 if overall is None else int(overall)
    return keys.join(shown, "page_key", "left").select(
        "page_key", F.coalesce("own", F.lit(fallback)).alias("first"))


def complete_from_facts(facts: DataFrame, first_page: int | None = None) -> DataFrame:
    """id of the threads whose pages have all landed, from their paging facts.

    Page numbers run from the thread's first page (see `first_pages`) without a gap, and no
    copy of the last page links to more. A thread without a landed page is not complete.
    """
    per = facts.groupBy("page_key", "page_no").agg(F.bool_or("has_more").alias("has_more"),
                                                   F.max("link_no").alias("link_no"))
    return (per.groupBy("page_key").agg(
        F.count("*").alias("n"), F.count("page_no").alias("numbered"),
        F.min("page_no").alias("low"), F.max("page_no").alias("high"),
        F.max_by("has_more", "page_no").alias("more"))
        .join(first_pages(per, first_page), "page_key")
        .filter((F.col("n") == F.col("numbered")) & (F.col("low") == F.col("first"))
                & (F.col("high") - F.col("low") + 1 == F.col("n")) & ~F.col("more"))
        .select(F.col("page_key").alias("id")))


def complete_threads(pages: DataFrame, first_page: int | None = None) -> DataFrame:
    """id of the threads whose pages have all landed; the first page as in `first_pages`."""
    return complete_from_facts(page_facts(pages), first_page)

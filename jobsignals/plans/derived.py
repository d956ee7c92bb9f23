"""Job postings and forum pages derived from the given `orders` table.

The given tables hold hardly any job vocabulary, so each order is turned into a
posting by fixed arithmetic on its key. Spark and plain SQL build the same rows,
and the volume grows with `orders`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TITLES = ["Senior Backend Engineer", "Junior Web Developer", "Machine Learning Engineer",
          "Site Reliability Engineer", "iOS Developer", "Engineering Manager",
          "Full-Stack Developer", "Founding Architect, Staff level",
          "Principal Lead, Head of Data, Director or VP"]
PLACES = ["Remote", "Remote (Global)", "San Francisco", "London", "Berlin", "ONSITE Austin",
          "Remote EU", "NYC", "Tokyo", "Anywhere", "Denver"]
PAY = ["$120k - $150k", "100-140k", "$100,000 - $140,000", "$80k+", "from $95k", "$6k - $8k",
       "£55,000 - £75,000", "$45-60/hr", "", "$150k", "€70k+", "2020-2025", "90k - 110k",
       "10k-12k", "$900,000", "from 00500", "00-10 $90k"]
STACKS = ["Python, AWS", "Golang, Docker", "Rust, web3", "React, TypeScript", "Java, SQL",
          "Python, PyTorch", "cpp, dotnet", "", "Vue.js, PHP, Redis", "AngularJS, Azure",
          "Ruby on Rails, GCP, Git", "Kubernetes, Terraform, Linux",
          "deep learning, data science", "Hadoop, Kafka", "Kotlin, Flutter, React Native, Swift",
          "Rust, solana, Python, LLM"]
EXTRAS = ["YC S21", "Series B, equity", "visa sponsorship", "3+ years", "10 years",
          "35+ years in trade", "40 years"]

STOP_WORDS = ["the", "and", "of", "to", "in", "der", "die", "und", "la", "de", "que", "et"]

FORUM = "http://forum.example.com"
BLOCK = 8000        # order keys per page block; bounds the posts of one page


def _pick(values: list[str], key: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), (key % len(values)).cast("int"))


def postings(spark: SparkSession, sf_dir: str, extra: bool = False) -> DataFrame:
    """id, thread_date, raw_text; with `extra` also user, url and the order key.

    Repeated ids and repeated texts come from exploding each order into its one
    to three rows, so `orders` is scanned once.
    """
    k = F.col("o_orderkey")
    body = F.concat_ws(
        " | ", F.concat(F.lit("Company "), F.col("o_custkey") % 97),
        *[_pick(v, k) for v in (TITLES, PLACES, PAY, STACKS, EXTRAS)])
    text = (F.when(k % 50 == 7, F.concat(F.lit("> quoted reply about "), body))
            .when(k % 41 == 3, "Short").otherwise(body))
    id = k.cast("string")
    # explode drops nothing here; the null entries are filtered right after.
    ids = F.array(id, F.when(k % 30 == 0, id), F.when(k % 25 == 0, F.concat(F.lit("d"), id)))
    df = (spark.read.parquet(f"{sf_dir}/orders.parquet")
          .select("o_orderkey", "o_custkey",
                  F.date_format("o_orderdate", "yyyy-MM-01").alias("thread_date"),
                  text.alias("raw_text"), F.explode(ids).alias("id"))
          .filter(F.col("id").isNotNull()))
    more = [F.concat(F.lit("u"), F.col("o_custkey")).alias("user"),
            F.concat(F.lit(f"{FORUM}/item?id="), F.col("id")).alias("url"),
            F.col("o_orderkey").alias("k")] if extra else []
    return df.select("id", "thread_date", "raw_text", *more)


def escape(text: Column) -> Column:
    for char, entity in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")]:
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def _row(id: Column, body: Column, user: Column | None, width: int = 0) -> Column:
    """One comment in forum markup; `body` is ready-made markup."""
    name = [F.lit('<a class="hnuser">'), user, F.lit("</a>")] if user is not None else []
    return F.concat(
        F.lit('<tr class="athing comtr" id="'), id,
        F.lit(f'"><td class="ind"><img width="{width}"></td>\n<td>'), *name,
        F.lit('<span class="age"><a href="item?id='), id,
        F.lit('">1 day ago</a></span>\n'), body, F.lit("</td></tr>\n"))


def _body(markup: Column) -> Column:
    return F.concat(F.lit('<div class="commtext">'), markup, F.lit("</div>"))


def forum_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_key, page_no, thread_date, html: one page per month and key block.

    Besides its posts, every page holds a nested reply (to be dropped), a row
    without text, a row without user and a text with a paragraph inside. All but
    the last page of a month have a 'more' link. A page gathers at most BLOCK order
    keys, so no group of texts grows with the data; pages are numbered by their keys.
    """
    posts = postings(spark, sf_dir, extra=True)
    block = ((F.col("k") - F.col("k") % BLOCK) / BLOCK).cast("int").alias("block")
    key = thread_key(F.col("thread_date")).alias("page_key")
    rows = posts.select(
        key, block, "thread_date", "id",
        _row(F.col("id"), _body(escape(F.col("raw_text"))), F.col("user")).alias("row"))
    month = Window.partitionBy("page_key")
    numbers = posts.select(key, block).distinct().select(
        "page_key", "block",
        (F.row_number().over(month.orderBy("block")) - 1).alias("page_no"),
        F.count("*").over(month).alias("n_pages"))
    grouped = rows.groupBy("page_key", "block", "thread_date").agg(
        F.array_sort(F.collect_list(F.struct("id", "row"))).alias("rows")).join(
        numbers, ["page_key", "block"])
    page = F.concat_ws("-", "page_key", "page_no")
    odd = [_row(F.concat(F.lit("n-"), page), _body(F.lit("nested")), F.lit("n"), width=40),
           _row(F.concat(F.lit("e-"), page), F.lit(""), F.lit("e")),
           _row(F.concat(F.lit("u-"), page), _body(F.lit("no user")), None),
           _row(F.concat(F.lit("p-"), page), _body(F.lit("one<p>two &amp; three")), F.lit("p"))]
    more = F.when(F.col("page_no") + 1 < F.col("n_pages"), F.concat(
        F.lit('<a href="item?id='), F.col("page_key"), F.lit("&amp;p="),
        F.col("page_no") + 2, F.lit('" class="morelink" rel="next">More</a>')))
    html = F.concat(F.lit("<html><body><table>\n"), F.array_join("rows.row", ""), *odd,
                    F.lit("</table>\n"), F.coalesce(more, F.lit("")), F.lit("</body></html>"))
    return grouped.select("page_key", "page_no", "thread_date", html.alias("html"))


def thread_key(thread_date: Column) -> Column:
    return F.concat(F.lit("t"), F.replace(F.substring(thread_date, 1, 7), F.lit("-"), F.lit("")))


def month_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct months of `orders` as dates."""
    return (spark.read.parquet(f"{sf_dir}/orders.parquet")
            .select(F.trunc("o_orderdate", "month").alias("month_start")).distinct())


def thread_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hiring thread per month, and one thread of another kind."""
    day = F.col("month_start")
    when = F.date_format(day, "MMMM yyyy")
    both = F.array(F.concat(F.lit("Ask HN: Who is hiring? ("), when, F.lit(")")),
                   F.concat(F.lit("Ask HN: Who wants to be hired? ("), when, F.lit(")")))
    key = thread_key(F.date_format(day, "yyyy-MM-dd"))
    return (month_starts(spark, sf_dir)
            .select(key.alias("key"), F.posexplode(both).alias("n", "title"))
            .select(F.when(F.col("n") == 0, F.col("key"))
                    .otherwise(F.concat("key", F.lit("w"))).alias("id"), "title"))


def index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thread-index pages, one per year of month threads, in both link layouts."""
    titles = thread_titles(spark, sf_dir)
    modern = F.concat(F.lit('<span class="titleline"><a href="x">'), escape(F.col("title")),
                      F.lit("</a></span>"))
    old = F.concat(F.lit('<a class="titlelink" href="x">'), escape(F.col("title")), F.lit("</a>"))
    row = F.concat(F.lit('<tr class="athing" id="'), F.col("id"), F.lit('"><td>'),
                   F.when(F.substring("id", 6, 2) < "07", modern).otherwise(old),
                   F.lit("</td></tr>"))
    return (titles.groupBy(F.substring("id", 2, 4).alias("page_key"))
            .agg(F.array_sort(F.collect_list(row)).alias("rows"))
            .select("page_key", F.lit(0).alias("page_no"), F.lit("").alias("thread_date"),
                    F.concat(F.lit("<table>"), F.array_join("rows", "\n"), F.lit("</table>"))
                    .alias("html")))


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thread list in its stored shape, one row per month."""
    day = F.date_format("month_start", "yyyy-MM-dd")
    key = thread_key(day)
    return month_starts(spark, sf_dir).select(
        key.alias("id"),
        F.concat(F.lit("Ask HN: Who is hiring? ("), F.date_format("month_start", "MMMM yyyy"),
                 F.lit(")")).alias("title"),
        day.alias("thread_date"),
        F.concat(F.lit(f"{FORUM}/item?id="), key).alias("url"))

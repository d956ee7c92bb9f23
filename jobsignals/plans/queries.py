"""Registered queries: one per operator, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.fixed_values import (
    COMBO_FLAGS, FLAG_GROUPS, ROLE_TERMS, ROLE_TOKEN, SALARY_TERMS, SALARY_TOKEN,
)
from jobsignals.functions import posts
from jobsignals.operators import (
    cleaning, features, metrics, pages, pay, profile, sanitize, trends,
)
from jobsignals.operators.dedupe import keep_first
from jobsignals.operators.structure import prepared, salaries
from jobsignals.plans import derived, training
from jobsignals.plans.market import transform
from jobsignals.schemas import COMMENTS, PAGES
from jobsignals.session import until_exit
from jobsignals.sources import state
from jobsignals.sources.state import pending_threads, read_threads, write_threads
from jobsignals.sources.tables import (
    compact_comments, date_range, merge_comments, read_comments, read_compacted, read_raw,
    read_structured, write_structured, write_thread_comments,
)
from jobsignals.streaming.ingest import ingest_batch, ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Every sixth month of the derived thread list counts as processed.
PROCESSED_SQL = "month(to_date(thread_date)) % 6 = 0"
THREADS_SINCE = "1996-01-01"
FLAGS = [f for names in FLAG_GROUPS.values() for f in names] + COMBO_FLAGS["Interactions"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitize.normalise(derived.postings(spark, sf_dir))


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitize.sanitize(raw(spark, sf_dir))


def structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(derived.postings(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cap_years(cleaning.clean_salaries(structured(spark, sf_dir)))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- sanitation --------------------------------------------------------------

@query
def sanitize_posts(spark, sf_dir):
    return kept(spark, sf_dir)


@query
def dedupe_documents_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    keys = [F.xxhash64("text"), F.col("lang"), F.col("text")]
    return keep_first(docs, keys, [F.col("doc_id")]).select("doc_id", "lang", "n_chars")


@query
def long_documents(spark, sf_dir):
    text = F.col("text")
    return (table(spark, sf_dir, "documents")
            .filter(sanitize.long_enough(text) & ~sanitize.is_quote(text))
            .select("doc_id", F.length("text").alias("chars")))


@query
def row_audit(spark, sf_dir):
    return sanitize.row_audit(raw(spark, sf_dir))


@query
def row_audit_undated(spark, sf_dir):
    return sanitize.row_audit(sanitize.normalise(
        derived.postings(spark, sf_dir).drop("thread_date")))


@query
def sample_head(spark, sf_dir):
    return profile.head(kept(spark, sf_dir), 100).select("id", "date")


# --- extractors --------------------------------------------------------------

@query
def structured_posts(spark, sf_dir):
    return structured(spark, sf_dir).withColumn("tech_stack", F.array_join("tech_stack", ","))


def _tier(name: str) -> Query:
    def run(spark, sf_dir):
        return (salaries(kept(spark, sf_dir)).filter(F.col("pay_tier") == name)
                .select("id", "salary_min", "salary_max", "currency"))
    run.__name__ = f"salary_{name}"
    return query(run)


for _name in ("range", "starting_at", "single"):
    _tier(_name)


@query
def salary_waterfall(spark, sf_dir):
    return salaries(kept(spark, sf_dir))


@query
def skills(spark, sf_dir):
    return structured(spark, sf_dir).select(
        "id", F.array_join("tech_stack", ",").alias("skills"), F.size("tech_stack").alias("n"))


@query
def role_category(spark, sf_dir):
    return structured(spark, sf_dir).select("id", "job_category")


@query
def company_and_title(spark, sf_dir):
    return structured(spark, sf_dir).select("id", "company_name", "role_title")


def _flag_query(name: str, *columns: str) -> Query:
    def run(spark, sf_dir):
        return structured(spark, sf_dir).select("id", *columns)
    run.__name__ = name
    return query(run)


_flag_query("experience_flags", *FLAG_GROUPS["Seniority"], "years_experience", "is_remote")
_flag_query("location_flags", *FLAG_GROUPS["Location Tiers"])
_flag_query("stage_flags", *FLAG_GROUPS["Company Stage"])
_flag_query("comp_flags", *FLAG_GROUPS["Compensation"])
_flag_query("combo_flags", *COMBO_FLAGS["Interactions"])


@query
def document_signals(spark, sf_dir):
    """Signals per document: the substring and role rules on long free text."""
    docs = prepared(table(spark, sf_dir, "documents"), "text")
    return docs.select("doc_id", posts.role("low").alias("job_category"),
                       *[e.alias(n) for n, e in posts.flags("low").items()])


# --- cleaning and statistics -------------------------------------------------

@query
def salary_cleaned(spark, sf_dir):
    return cleaned(spark, sf_dir).select("id", "salary_avg", "years_experience")


@query
def cleaning_audit(spark, sf_dir):
    return cleaning.cleaning_audit(structured(spark, sf_dir))


@query
def numeric_summary(spark, sf_dir):
    before = profile.numeric_summary(structured(spark, sf_dir), "salary_avg")
    done = cleaned(spark, sf_dir)
    after = profile.numeric_summary(done, "salary_avg").withColumn("column", F.lit("salary_clean"))
    years = profile.numeric_summary(done, "years_experience")
    return rounded(before.unionByName(after).unionByName(years), "mean", "std")


@query
def feature_prevalence(spark, sf_dir):
    return trends.ranked_prevalence(cleaned(spark, sf_dir))


@query
def value_counts_nulls(spark, sf_dir):
    return profile.value_counts(structured(spark, sf_dir), "currency")


@query
def event_value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "events"), "event_type")


@query
def currency_top(spark, sf_dir):
    return profile.top_values(structured(spark, sf_dir), "currency", 5)


@query
def top_tech_vocabulary(spark, sf_dir):
    exploded = trends.explode_tech(structured(spark, sf_dir).select("tech_stack"))
    return profile.top_values(exploded, "tech", 50)


@query
def years_histogram(spark, sf_dir):
    return profile.integer_histogram(cleaned(spark, sf_dir), "years_experience")


@query
def salary_histogram(spark, sf_dir):
    return profile.equal_width_histogram(cleaned(spark, sf_dir), "salary_avg", 0, 500000, 25)


@query
def dataset_profile(spark, sf_dir):
    return profile.non_null_counts(structured(spark, sf_dir))


@query
def sample_flag_listing(spark, sf_dir):
    five = profile.sample_rows(structured(spark, sf_dir), 5)
    return (profile.flag_listing(five, FLAGS)
            .withColumn("flags", F.array_join("flags", ",")))


@query
def post_date_range(spark, sf_dir):
    return date_range(derived.postings(spark, sf_dir))


# --- trends and pay ----------------------------------------------------------

@query
def tech_trend(spark, sf_dir):
    return trends.tech_trend(cleaned(spark, sf_dir))


@query
def tech_trend_competitors(spark, sf_dir):
    return trends.competitor_trend(cleaned(spark, sf_dir))


@query
def tech_trend_joined(spark, sf_dir):
    done = cleaned(spark, sf_dir)
    mentions = trends.mentions_per_month(trends.explode_tech(done.select("id", "date", "tech_stack")))
    return trends.merge_share(mentions, trends.posts_per_month(done))


@query
def remote_share(spark, sf_dir):
    return trends.remote_share(cleaned(spark, sf_dir))


@query
def top_tech(spark, sf_dir):
    return pay.top_tech(cleaned(spark, sf_dir))


@query
def top_tech_posts(spark, sf_dir):
    """Salaried (post, tech) rows whose tech is in the top list."""
    done = cleaned(spark, sf_dir)
    exploded = trends.explode_tech(done.filter(F.col("salary_avg").isNotNull())
                                   .select("id", "salary_avg", "tech_stack"))
    return pay.keep_top(exploded, pay.top_tech(done)).select("id", "tech", "salary_avg")


@query
def median_salary_by_tech(spark, sf_dir):
    return pay.median_salary_by_tech(cleaned(spark, sf_dir))


@query
def box_stats_by_tech(spark, sf_dir):
    return pay.box_stats_by_tech(cleaned(spark, sf_dir))


# --- threads, pages, ingest --------------------------------------------------

@query
def threads_pending(spark, sf_dir):
    threads = derived.threads(spark, sf_dir)
    done = threads.filter(F.expr(PROCESSED_SQL))
    return pending_threads(threads, done, THREADS_SINCE)


@query
def stored_threads(spark, sf_dir):
    path = until_exit(spark, "threads")
    write_threads(derived.threads(spark, sf_dir), path)
    return read_threads(spark, path)


@query
def known_ids(spark, sf_dir):
    """Ids stored as numbers and as strings in one parquet folder, and as CSV."""
    root = until_exit(spark, "ids")
    posts = derived.postings(spark, sf_dir).select("id")
    table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")).write.parquet(
        f"{root}/parquet")
    posts.filter("id LIKE 'd%'").write.mode("append").parquet(f"{root}/parquet")
    posts.filter("id NOT LIKE 'd%'").write.option("header", True).csv(f"{root}/csv")
    return state.known_ids(spark, [f"{root}/parquet"], [f"{root}/csv"])


@query
def title_to_month(spark, sf_dir):
    return derived.thread_titles(spark, sf_dir).select(
        "id", "title", pages.title_to_date(F.col("title")).alias("thread_date"))


@query
def parse_comment_pages(spark, sf_dir):
    return pages.parse_comments(derived.forum_pages(spark, sf_dir), derived.FORUM)


@query
def parse_thread_pages(spark, sf_dir):
    return pages.parse_threads(derived.index_pages(spark, sf_dir), derived.FORUM)


@query
def page_navigation(spark, sf_dir):
    return pages.page_navigation(derived.forum_pages(spark, sf_dir))


@query
def foreign_page_comments(spark, sf_dir):
    """The given web pages are no forum pages: no comment may come out."""
    web = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("page_key"), F.lit("").alias("thread_date"), "html")
    return pages.parse_comments(web).agg(F.count("*").alias("n"))


def _drops(landed: DataFrame) -> list[DataFrame]:
    """The pages, built once, in two parts that split the threads with more than one page."""
    path = until_exit(landed.sparkSession, "pages")
    landed.write.parquet(path)
    landed = landed.sparkSession.read.schema(landed.schema).parquet(path)
    return [landed.filter(F.col("page_no") % 2 == part) for part in (0, 1)]


@query
def incremental_ingest(spark, sf_dir):
    """Pages land in two drops; each is followed by a run of the stream."""
    root = until_exit(spark, "ingest")
    for drop in _drops(derived.forum_pages(spark, sf_dir)):
        drop.write.mode("append").parquet(f"{root}/landing")
        run = ingest_stream(spark, f"{root}/landing", f"{root}/comments", f"{root}/state",
                            derived.FORUM)
        run.awaitTermination()
    return read_comments(spark, f"{root}/comments").select(*COMMENTS.names)


@query
def compacted_comments(spark, sf_dir):
    """The stream store of incremental_ingest, compacted twice into months and read back."""
    root = until_exit(spark, "compact")
    for drop in _drops(derived.forum_pages(spark, sf_dir)):
        drop.write.mode("append").parquet(f"{root}/landing")
        ingest_stream(spark, f"{root}/landing", f"{root}/comments", f"{root}/state",
                      derived.FORUM).awaitTermination()
        compact_comments(spark, f"{root}/comments", f"{root}/compacted")
    return read_compacted(spark, f"{root}/compacted").select(*COMMENTS.names)


@query
def two_streams_ingest(spark, sf_dir):
    """Two streams, each with its own pages, share one store."""
    root = until_exit(spark, "streams")
    for n, drop in enumerate(_drops(derived.forum_pages(spark, sf_dir))):
        drop.write.parquet(f"{root}/landing{n}")
        run = ingest_stream(spark, f"{root}/landing{n}", f"{root}/comments", f"{root}/state{n}",
                            derived.FORUM)
        run.awaitTermination()
    return read_comments(spark, f"{root}/comments").select(*COMMENTS.names)


def _batch_runs(spark, sf_dir, name, shift):
    """Pages land in two drops into folders by page_key; a run follows each drop and a third
    run finds nothing pending. `shift` is added to every page number (1: numbered from 1, as
    the forum's addresses are)."""
    root = until_exit(spark, name)
    threads = derived.threads(spark, sf_dir)
    landed = derived.forum_pages(spark, sf_dir).withColumn(
        "page_no", (F.col("page_no") + shift).cast("int"))
    for drop in [*_drops(landed), None]:
        if drop is not None:
            drop.write.mode("append").partitionBy("page_key").parquet(f"{root}/landing")
        ingest_batch(spark, threads, spark.read.schema(PAGES).parquet(f"{root}/landing"),
                     f"{root}/comments", f"{root}/processed", THREADS_SINCE, derived.FORUM,
                     ledger=f"{root}/ledger")
    return read_comments(spark, f"{root}/comments").select(*COMMENTS.names)


@query
def batch_ingest(spark, sf_dir):
    """Pages land in two drops; threads stay pending until their last page has landed."""
    return _batch_runs(spark, sf_dir, "batch", 0)


@query
def batch_ingest_pages_from_one(spark, sf_dir):
    """As batch_ingest, with pages numbered from 1 as the forum numbers them."""
    return _batch_runs(spark, sf_dir, "batch-one", 1)


@query
def merged_raw(spark, sf_dir):
    """The per-thread store merged into one table by month."""
    root = until_exit(spark, "merge")
    found = pages.parse_comments(derived.forum_pages(spark, sf_dir), derived.FORUM, keep_page=True)
    write_thread_comments(found, f"{root}/comments")
    merge_comments(spark, f"{root}/comments", f"{root}/raw")
    return read_raw(spark, f"{root}/raw")


# --- features and models -----------------------------------------------------

@query
def paybanding_flags(spark, sf_dir):
    return features.pay_band_flags(kept(spark, sf_dir)).drop("date", "raw_text")


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The structured table as training reads it."""
    path = until_exit(spark, "structured")
    write_structured(structured(spark, sf_dir), path)
    return read_structured(spark, path)


@query
def stored_months(spark, sf_dir):
    return stored(spark, sf_dir).groupBy("month").agg(
        F.count("*").alias("n"), F.min("date").alias("first_date"),
        F.max("salary_avg").alias("top_salary"))


@query
def tech_multihot(spark, sf_dir):
    done = stored(spark, sf_dir)
    flags = features.tech_flags(features.top_techs(done))
    return done.select("id", *[e.alias(n) for n, e in flags.items()])


@query
def ml_features(spark, sf_dir):
    done = stored(spark, sf_dir)
    rows = features.salary_features(done, features.top_techs(done))
    return rounded(rows.select("id", "log_salary", *features.numeric_columns(rows)), "log_salary")


@query
def train_split(spark, sf_dir):
    return structured(spark, sf_dir).select(
        "id", features.in_training(F.col("id")).alias("in_training"))


@query
def category_one_hot(spark, sf_dir):
    done = stored(spark, sf_dir).select("id", "job_category")
    names, steps = training.category_steps()
    for step in steps:
        done = step.fit(done).transform(done)
    labels = done.schema[names[0]].metadata["ml_attr"]["vals"]
    hot = vector_to_array(names[1])
    return done.select("id", *[hot[i].cast("int").alias(f"is_{c}") for i, c in enumerate(labels)
                               if c != "__unknown"])


@query
def tfidf_top_terms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for step in features.tokenizers("text", "tokens", SALARY_TOKEN, derived.STOP_WORDS):
        docs = step.transform(docs)
    return rounded(features.top_terms(docs.select("tokens"), "tokens", SALARY_TERMS), "idf")


def _weights(spark: SparkSession, sf_dir: str, terms: int, token: str) -> DataFrame:
    """Every non-zero weight of every document's vector, by term; sparse all the way."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cells = features.tfidf_cells(docs, "doc_id", "text", terms, token, derived.STOP_WORDS)
    return rounded(cells, "weight")


@query
def tfidf_weights(spark, sf_dir):
    return _weights(spark, sf_dir, SALARY_TERMS, SALARY_TOKEN)


@query
def tfidf_weights_roles(spark, sf_dir):
    return _weights(spark, sf_dir, ROLE_TERMS, ROLE_TOKEN)


@query
def label_confusion(spark, sf_dir):
    return metrics.confusion_matrix(table(spark, sf_dir, "labels"), "quality", "toxic", ["0", "1"])


@query
def label_report(spark, sf_dir):
    report = metrics.class_report(table(spark, sf_dir, "labels"), "quality", "toxic")
    return rounded(report, "precision", "recall", "f1")


@query
def label_report_averages(spark, sf_dir):
    report = metrics.class_report(table(spark, sf_dir, "labels"), "quality", "toxic")
    averages = metrics.report_averages(report)
    return rounded(averages, *[c for c in averages.columns if c != "support"])


@query
def pay_spread_metrics(spark, sf_dir):
    """Regression metrics of the lower pay bound taken as a guess of the upper."""
    pairs = structured(spark, sf_dir).filter("salary_max IS NOT NULL")
    return rounded(metrics.regression_metrics(pairs, "salary_max", "salary_min"), "mae", "r2",
                   digits=4)


# Both models are fitted whole: all boosting rounds, all trees, all training rows.
_fits: dict[tuple, training.Fitted] = {}


def _fit(train, params, spark, sf_dir) -> training.Fitted:
    key = (train.__name__, spark.sparkContext.applicationId, sf_dir)
    if key not in _fits:
        _fits[key] = train(stored(spark, sf_dir), **params)
    return _fits[key]


@query
def salary_model_metrics(spark, sf_dir):
    return training.salary_metrics(_fit(training.train_salary, {}, spark, sf_dir))


@query
def salary_importances(spark, sf_dir):
    return _fit(training.train_salary, {}, spark, sf_dir).importances()


@query
def salary_residuals(spark, sf_dir):
    found = _fit(training.train_salary, {}, spark, sf_dir).predictions
    return profile.equal_width_histogram(found, "residual", -200000, 200000, 40)


@query
def role_model_metrics(spark, sf_dir):
    return training.role_metrics(_fit(training.train_roles, {}, spark, sf_dir))


@query
def role_confusion(spark, sf_dir):
    fitted = _fit(training.train_roles, {}, spark, sf_dir)
    return metrics.confusion(fitted.predictions, "job_category", "predicted")

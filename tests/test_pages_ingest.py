"""Page jobs, state, tables and incremental ingest."""

import json

import pytest
from pyspark.sql import functions as F

from jobsignals.fixed_values import BASE_URL
from jobsignals.operators import pages
from jobsignals.plans import derived
from jobsignals.sources import state, tables
from jobsignals.streaming.ingest import ingest_batch, ingest_stream


@pytest.fixture
def parse(spark):
    def run(html):
        df = spark.createDataFrame([("t", 1, "2023-01-01", html)],
                                   "page_key string, page_no int, thread_date string, html string")
        return [tuple(r) for r in pages.parse_comments(df, "http://x").collect()]
    return run


def comment(id, inner, cls="athing comtr"):
    return f'<tr class="{cls}" id="{id}">{inner}</tr>'


def test_nested_table_markup(parse):
    html = comment("1", '''<td><table border='0'><tr><td class='ind' indent='0'><img src="s.gif"
        height="1" width="0"></td><td class="default"><span class="comhead"><a href="user?id=bo"
        class="hnuser">bo</a> <span class="age" title="x"><a href="item?id=1">1 day</a></span></span>
        <br><div class="comment"><div class="commtext c00">Acme &amp; Co | <i>Dev</i><p>Second &#x27;par'
        <p>Third</div><div class='reply'><p>reply</p></div></div></td></tr></table></td>''')
    assert parse(f"<html><table>{html}</table></html>") == [
        ("1", "2023-01-01", "Acme & Co | \nDev\nSecond 'par'\n        \nThird", "bo",
         "http://x/item?id=1")]


def test_indentation_rule(parse):
    body = '<div class="commtext">t</div>'
    html = "".join([
        comment("top", f'<td class="ind"><img width="0"></td>{body}'),
        comment("reply", f'<td class="ind"><img width="40"></td>{body}'),
        comment("no-width", f'<td class="ind"><img></td>{body}'),
        comment("no-img", f'<td class="ind"></td>{body}'),
        comment("no-cell", f'{body}<td><img width="40"></td>'),
        comment("late-img", f'<td class="ind">x</td><td><img width="40"></td>{body}'),
        comment("not-a-comment", body, cls="athing"),
    ])
    assert [r[0] for r in parse(html)] == ["top", "no-img", "no-cell", "late-img"]


def test_missing_parts(parse):
    html = comment("1", "") + comment("2", '<a class="hnuser"></a><span class="age"><a>x</a></span>')
    assert parse(html) == [("1", "2023-01-01", "", "unknown", ""),
                           ("2", "2023-01-01", "", "", "http://x/None")]
    assert parse('<tr class="athing comtr"><td></td></tr>') == []
    assert parse("") == [] and parse("<p>athing") == []


def test_text_nodes(parse):
    def text(markup):
        return parse(comment("1", f'<div class="commtext">{markup}</div>'))[0][2]
    assert text("a<!-- c -->b") == "a\nb"
    assert text("a<br>b<br/>c") == "a\nb\nc"
    assert text("a<script>x()</script>b") == "a\nb"
    assert text("a<p>  \n </p>b") == "a\n\n\nb"
    assert text("a<b>   </b>b") == "a\n \nb"
    assert text("<p>x</b></p> y") == "x\n y"
    assert text("1 < 2 & 3 &gt; 2") == "1 < 2 & 3 > 2"
    first = comment("1", '<div class="commtext">one</div><div class="commtext">two</div>')
    assert parse(first)[0][2] == "one"


def test_unclosed_rows_nest(parse):
    html = ('<tr class="athing comtr" id="1"><div class="commtext">a</div>'
            '<tr class="athing comtr" id="2"><div class="commtext">b</div></tr></tr>')
    assert [(r[0], r[2]) for r in parse(html)] == [("1", "a"), ("2", "b")]


def test_round_trip(spark, sf_dir):
    got = pages.parse_comments(derived.forum_pages(spark, sf_dir), derived.FORUM)
    own = got.filter(~F.col("id").rlike("^[eup]-"))
    source = derived.postings(spark, sf_dir, extra=True).select(
        "id", "thread_date", "raw_text", "user", "url")
    assert own.exceptAll(source).isEmpty() and source.exceptAll(own).isEmpty()


def test_page_filter_runs_before_python(spark, sf_dir):
    web = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        F.col("page_id").cast("string").alias("page_key"), F.lit("").alias("thread_date"), "html")
    df = pages.parse_comments(web)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "StringContains(html,athing)" in plan
    assert df.isEmpty()


def test_thread_index(spark):
    html = ('<tr class="athing" id="7"><td><span class="titleline"><a href="i">Ask HN: Who is hiring?'
            ' (March 2021)</a></span></td></tr>'
            '<tr class="athing" id="8"><td><a class="titlelink">Ask HN: Who is hiring? (may 2014)</a></td></tr>'
            '<tr class="athing" id="9"><span class="titleline"><a>Ask HN: Who is hiring? (Smarch 2014)</a></span></tr>'
            '<tr class="athing" id="10"><span class="titleline"><a>Ask HN: Who wants to be hired? (May 2014)</a></span></tr>'
            '<tr class="athing" id="11"><td>no link</td></tr>'
            "<a href='submitted?id=x&amp;n=31' class='morelink' rel='next'>More</a>")
    df = spark.createDataFrame([("p", 1, "", html)],
                               "page_key string, page_no int, thread_date string, html string")
    assert sorted(map(tuple, pages.parse_threads(df).collect())) == [
        ("7", "Ask HN: Who is hiring? (March 2021)", "2021-03-01", f"{BASE_URL}/item?id=7"),
        ("8", "Ask HN: Who is hiring? (may 2014)", "2014-05-01", f"{BASE_URL}/item?id=8")]
    nav = pages.page_navigation(df).first()
    assert (nav.next_href, nav.has_more) == ("submitted?id=x&n=31", True)


@pytest.mark.parametrize("html, href, more", [
    ('<a class="morelink" href="news?p=2">', "news?p=2", True),
    ('<a class="x morelink y">', None, True),
    ("<a class=morelink href=next>", "next", True),
    ('<a class="nomorelink" href="a">', None, False),
    ("<p>morelink</p>", None, False), ("", None, False),
])
def test_navigation(spark, html, href, more):
    df = spark.createDataFrame([("p", 1, html)], "page_key string, page_no int, html string")
    row = pages.page_navigation(df).first()
    assert (row.next_href, row.has_more) == (href, more)


# --- state -------------------------------------------------------------------

def test_state_files(spark, tmp_path):
    threads = [{"id": str(i), "title": f"t{i}", "thread_date": f"20{i:02}-01-01", "url": "u"}
               for i in range(18, 25)]
    (tmp_path / "threads.json").write_text(json.dumps(threads))
    (tmp_path / "pretty.json").write_text(json.dumps(threads, indent=1))
    (tmp_path / "done.json").write_text(json.dumps({"processed_threads": ["18", "21", "21"]}))
    (tmp_path / "broken.json").write_text('{"processed_thr')
    read = state.read_threads(spark, str(tmp_path / "threads.json"))
    assert read.count() == 7
    assert state.read_threads(spark, str(tmp_path / "pretty.json"), multi_line=True).count() == 7
    assert state.read_threads(spark, str(tmp_path / "none.json")).isEmpty()
    state.write_threads(read, str(tmp_path / "copy"))
    assert state.read_threads(spark, str(tmp_path / "copy")).exceptAll(read).isEmpty()
    done = state.read_processed(spark, str(tmp_path / "done.json"))
    assert sorted(r.id for r in done.collect()) == ["18", "21"]
    assert state.read_processed(spark, str(tmp_path / "broken.json")).isEmpty()
    assert state.read_processed(spark, str(tmp_path / "none.json")).isEmpty()
    pending = state.pending_threads(read, done)
    assert sorted(r.id for r in pending.collect()) == ["20", "22", "23", "24"]
    done = done.unionByName(spark.createDataFrame([("24",)], "id string"))
    again = state.pending_threads(read, done, reopen_newest=True)
    assert sorted(r.id for r in again.collect()) == ["20", "22", "23", "24"]
    table = str(tmp_path / "table")
    for ids in (["1", "2"], ["2", "3"]):
        state.mark_processed(spark.createDataFrame([(i,) for i in ids], "id string"), table)
    assert sorted(r.id for r in state.read_processed(spark, table).collect()) == ["1", "2", "3"]


def test_known_ids(spark, tmp_path):
    spark.createDataFrame([(1, "x"), (2, "y")], "id int, z string").write.parquet(str(tmp_path / "p"))
    (tmp_path / "c.csv").write_text("z,id\nq,2\nr,30\n")
    ids = state.known_ids(spark, [str(tmp_path / "p")], [str(tmp_path / "c.csv")])
    assert sorted(r.id for r in ids.collect()) == ["1", "2", "30"]
    assert state.known_ids(spark).isEmpty()
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:int>" in plan and "ReadSchema: struct<id:string>" in plan


def test_raw_table(spark, sf_dir, tmp_path):
    posts = derived.postings(spark, sf_dir)
    tables.write_raw(posts, str(tmp_path / "raw"), str(tmp_path / "range"))
    stored = tables.read_raw(spark, str(tmp_path / "raw"))
    assert stored.drop("month").exceptAll(posts).isEmpty() and stored.count() == posts.count()
    assert spark.read.json(str(tmp_path / "range")).first() == tables.date_range(posts).select(
        "first_date", "last_date").first()
    # No posts, no change; one month, that month is replaced.
    tables.write_raw(posts.limit(0), str(tmp_path / "raw"))
    assert tables.read_raw(spark, str(tmp_path / "raw")).count() == posts.count()
    month = posts.filter("thread_date = '1996-03-01'")
    tables.write_raw(month.limit(1), str(tmp_path / "raw"))
    assert tables.read_raw(spark, str(tmp_path / "raw")).count() == (
        posts.count() - month.count() + 1)


def test_merge_keeps_the_first_row_per_id(spark, tmp_path):
    rows = [("1", "2023-02-01", "b", "u", ""), ("1", "2023-01-01", "c", "u", ""),
            ("1", "2023-01-01", "a", "u", ""), ("2", "2023-02-01", "x", "u", "")]
    schema = "id string, thread_date string, raw_text string, user string, url string"
    for n, row in enumerate(rows):
        one = spark.createDataFrame([row], schema)
        tables.write_thread_comments(one.withColumn("thread_id", F.lit(f"t{n}")),
                                     str(tmp_path / "store"))
    (tmp_path / "store" / "thread_id=bad").mkdir()
    (tmp_path / "store" / "thread_id=bad" / "x.parquet").write_bytes(b"not parquet")
    tables.merge_comments(spark, str(tmp_path / "store"), str(tmp_path / "raw"))
    merged = tables.read_raw(spark, str(tmp_path / "raw")).select("id", "raw_text")
    assert sorted(map(tuple, merged.collect())) == [("1", "a"), ("2", "x")]


# --- ingest ------------------------------------------------------------------

def as_set(df):
    return {tuple(r) for r in df.select("id", "thread_date", "raw_text", "user", "url").collect()}


def test_batch_ingest_resumes(spark, sf_dir, tmp_path):
    store, done = str(tmp_path / "store"), str(tmp_path / "done")
    threads, landed = derived.threads(spark, sf_dir), derived.forum_pages(spark, sf_dir)
    ingest_batch(spark, threads, landed, store, done, since="2000-01-01", base_url=derived.FORUM)
    first = tables.read_comments(spark, store)
    assert {r.y for r in first.select(F.substring("thread_date", 1, 4).alias("y")).collect()} == {
        "2000", "2001"}
    files = sorted(p.name for p in (tmp_path / "store").rglob("*.parquet"))
    ingest_batch(spark, threads, landed, store, done, since="2000-01-01", base_url=derived.FORUM)
    assert files == sorted(p.name for p in (tmp_path / "store").rglob("*.parquet"))
    ingest_batch(spark, threads, landed, store, done, since="1990-01-01", base_url=derived.FORUM)
    everything = pages.parse_comments(landed, derived.FORUM)
    assert as_set(tables.read_comments(spark, store)) == as_set(everything)


def test_lost_mark_repeats_without_doubling(spark, sf_dir, tmp_path):
    store = str(tmp_path / "store")
    threads, landed = derived.threads(spark, sf_dir), derived.forum_pages(spark, sf_dir)
    for n in range(2):      # the second run knows nothing of the first
        ingest_batch(spark, threads, landed, store, str(tmp_path / f"done{n}"),
                     base_url=derived.FORUM, since="2000-01-01")
    rows = spark.read.parquet(store)
    wanted = pages.parse_comments(landed.filter("thread_date >= '2000-01-01'"), derived.FORUM)
    assert rows.count() == wanted.count()


THREADS = "id string, title string, thread_date string, url string"
PAGES = "page_key string, page_no int, thread_date string, html string"
MORE = '<a class="morelink" href="x">More</a>'


def page(key, no, *ids, more=False, date="2023-01-01"):
    rows = "".join(f'<tr class="athing comtr" id="{i}"><td class="ind"><img width="0"></td><td>'
                   f'<div class="commtext">text of {i}</div></td></tr>' for i in ids)
    return (key, no, date, f"<table>{rows}</table>" + (MORE if more else ""))


def test_threads_stay_pending_until_all_pages_landed(spark, tmp_path):
    store, done = str(tmp_path / "s"), str(tmp_path / "d")
    threads = spark.createDataFrame([(t, "x", "2023-01-01", "u") for t in
                                     ("none", "first", "late", "gap", "empty", "whole")], THREADS)
    landed = [page("first", 0, "a1", more=True), page("late", 0, "b1", more=True),
              page("gap", 1, "c2"), page("empty", 0), page("whole", 0, "e1", more=True),
              page("whole", 1, "e2")]

    def run():
        ingest_batch(spark, threads, spark.createDataFrame(landed, PAGES), store, done)
        marked = {r.id for r in state.read_processed(spark, done).collect()}
        return marked, {r.id for r in tables.read_comments(spark, store).collect()}

    assert run() == ({"empty", "whole"}, {"a1", "b1", "c2", "e1", "e2"})
    landed.append(page("late", 1, "b2"))
    assert run() == ({"empty", "whole", "late"}, {"a1", "b1", "b2", "c2", "e1", "e2"})
    # A later copy of the last page links on: nothing is complete before that has landed.
    landed += [page("gap", 0, "c1", more=True), page("gap", 1, "c2", more=True)]
    assert run()[0] == {"empty", "whole", "late"}
    landed.append(page("gap", 2, "c3"))
    marked, ids = run()
    assert marked == {"empty", "whole", "late", "gap"} and {"c1", "c2", "c3"} <= ids


def test_the_thread_list_alone_decides_about_since(spark, tmp_path):
    """Pages of a recent thread count whatever date they carry; those of an old one never do."""
    store, done = str(tmp_path / "s"), str(tmp_path / "d")
    threads = spark.createDataFrame([("new", "x", "2023-01-01", "u"), ("old", "x", "2019-01-01", "u")],
                                    THREADS)
    landed = [page("new", no, f"n{no}", more=no < 4, date=date)
              for no, date in enumerate(["2023-01-01", "", None, "1 Jan 2023", "2019-12-31"])]
    landed += [page("old", 0, "o0", date="2023-01-01"), page("old", 1, "o1", date="")]
    ingest_batch(spark, threads, spark.createDataFrame(landed, PAGES), store, done)
    assert {r.id for r in tables.read_comments(spark, store).collect()} == {"n0", "n1", "n2", "n3", "n4"}
    assert {r.id for r in state.read_processed(spark, done).collect()} == {"new"}


def test_old_pages_are_left_out_by_the_scan(spark, tmp_path):
    spark.createDataFrame([page("t", 0, "a")], PAGES).write.parquet(str(tmp_path / "landing"))
    landed = spark.read.schema(PAGES).parquet(str(tmp_path / "landing"))
    recent = landed.filter((F.col("thread_date") >= "2022-01-01") | F.col("thread_date").isNull())
    plan = pages.complete_threads(recent)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(thread_date,2022-01-01)" in plan


def stream(spark, root, landing, checkpoint):
    ingest_stream(spark, f"{root}/{landing}", f"{root}/store", f"{root}/{checkpoint}", "b",
                  max_files=1).awaitTermination()
    return tables.read_comments(spark, f"{root}/store")


def test_streams_do_not_replace_each_other(spark, tmp_path):
    for n, ids in enumerate((["a", "b"], ["c"])):
        spark.createDataFrame([page(f"t{n}", 0, *ids)], PAGES).write.parquet(f"{tmp_path}/land{n}")
    assert stream(spark, tmp_path, "land0", "cp0").count() == 2
    assert {r.id for r in stream(spark, tmp_path, "land1", "cp1").collect()} == {"a", "b", "c"}
    # A lost checkpoint: the pages are read again, under a name of their own.
    assert {r.id for r in stream(spark, tmp_path, "land0", "cp2").collect()} == {"a", "b", "c"}
    assert "batch_id" in stream(spark, tmp_path, "land0", "cp2").columns


def test_an_edited_page_changes_nothing(spark, tmp_path):
    def land(text):
        key, no, date, html = page("t", 0, "a")
        spark.createDataFrame([(key, no, date, html.replace("text of a", text))], PAGES).write.mode(
            "append").parquet(f"{tmp_path}/land")
        return stream(spark, tmp_path, "land", "cp").first().raw_text

    assert land("bbb first") == "bbb first" and land("aaa edited") == "bbb first"


def test_types_are_mixed_and_nothing_vanishes(spark, tmp_path):
    store = str(tmp_path / "store")
    numbers = spark.createDataFrame([(1, "2023-01-01", "x"), (2, "2023-01-01", "y")],
                                    "id int, thread_date string, raw_text string")
    numbers.write.parquet(f"{store}/thread_id=n")
    numbers.withColumn("id", F.concat("id", F.lit("s"))).write.parquet(f"{store}/thread_id=s")
    numbers.withColumn("id", F.col("id") + 10.5).write.parquet(f"{store}/thread_id=d")
    (tmp_path / "store" / "thread_id=bad").mkdir()
    (tmp_path / "store" / "thread_id=bad" / "x.parquet").write_bytes(b"not parquet")
    with pytest.warns(tables.SkippedFile, match="bad/x.parquet"):
        got = tables.read_comments(spark, store)
    assert sorted((r.id, r.thread_id) for r in got.collect()) == [
        ("1", "n"), ("11.5", "d"), ("12.5", "d"), ("1s", "s"), ("2", "n"), ("2s", "s")]
    ids = state.known_ids(spark, [store + "/thread_id=n", store + "/thread_id=s"])
    assert sorted(r.id for r in ids.collect()) == ["1", "1s", "2", "2s"]


def test_bad_dates_do_not_stop_the_merge(spark, tmp_path):
    rows = [("1", "2023-01-05", "a"), ("2", "", "b"), ("3", "soon", "c"), ("4", None, "d")]
    posts = spark.createDataFrame(rows, "id string, thread_date string, raw_text string")
    tables.write_thread_comments(posts.withColumn("thread_id", F.lit("t")), f"{tmp_path}/store")
    tables.merge_comments(spark, f"{tmp_path}/store", f"{tmp_path}/raw")
    got = tables.read_raw(spark, f"{tmp_path}/raw").select("id", "month").collect()
    assert sorted(map(tuple, got)) == [("1", "2023-01"), ("2", None), ("3", None), ("4", None)]


def test_nothing_to_merge(spark, tmp_path):
    tables.merge_comments(spark, f"{tmp_path}/none", f"{tmp_path}/raw")
    assert not (tmp_path / "raw").exists()


def test_stream_equals_batch_and_survives_replay(spark, sf_dir, tmp_path):
    landing, store = str(tmp_path / "landing"), str(tmp_path / "store")
    landed = derived.forum_pages(spark, sf_dir)
    for part in (0, 1):     # both drops hold pages of the same threads
        half = landed.filter(F.crc32(F.concat("page_key", F.col("page_no"))) % 2 == part)
        half.write.mode("append").parquet(landing)
        ingest_stream(spark, landing, store, str(tmp_path / "cp"), derived.FORUM).awaitTermination()
    want = as_set(pages.parse_comments(landed, derived.FORUM))
    assert as_set(tables.read_comments(spark, store)) == want
    n_rows = spark.read.parquet(store).count()
    # Nothing new: nothing happens.
    ingest_stream(spark, landing, store, str(tmp_path / "cp"), derived.FORUM).awaitTermination()
    assert spark.read.parquet(store).count() == n_rows
    # The commit of the last batch gets lost: it is replayed into its own partition.
    commits = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (tmp_path / "cp" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    ingest_stream(spark, landing, store, str(tmp_path / "cp"), derived.FORUM).awaitTermination()
    assert spark.read.parquet(store).count() == n_rows
    assert as_set(tables.read_comments(spark, store)) == want


# --- ledger, first page, pruning ----------------------------------------------

def linked(key, no, *ids, to=None, date="2023-01-01"):
    """A page whose 'more' link asks for the forum address `to`, as the forum writes it."""
    _, _, _, html = page(key, no, *ids, date=date)
    more = f'<a href="item?id={key}&amp;p={to}" class="morelink" rel="next">More</a>' if to else ""
    return (key, no, date, html + more)


@pytest.mark.parametrize("shift", [0, 1])
def test_first_page_comes_from_the_links(spark, tmp_path, shift):
    """Pages numbered from 0 or from 1 complete alike; a thread without its first page waits."""
    store, done, ledger = (str(tmp_path / n) for n in ("s", "d", "l"))
    threads = spark.createDataFrame([(t, "x", "2023-01-01", "u") for t in ("a", "b", "c")],
                                    THREADS)
    landed = [linked("a", shift, "a1", to=2), linked("a", shift + 1, "a2"),
              linked("b", shift + 1, "b2", to=3), linked("b", shift + 2, "b3"),
              linked("c", shift, "c1")]

    def run():
        ingest_batch(spark, threads, spark.createDataFrame(landed, PAGES), store, done,
                     ledger=ledger)
        return {r.id for r in state.read_processed(spark, done).collect()}

    assert run() == {"a", "c"}
    landed.append(linked("b", shift, "b1", to=2))
    assert run() == {"a", "b", "c"}


def test_a_given_first_page_holds(spark, tmp_path):
    facts = spark.createDataFrame([("a", 1, False, None), ("b", 0, False, None)],
                                  "page_key string, page_no int, has_more boolean, link_no int")
    assert {r.id for r in pages.complete_from_facts(facts, 1).collect()} == {"a"}
    assert {r.id for r in pages.complete_from_facts(facts).collect()} == {"b"}


def test_ledger_keeps_few_versions_and_ignores_unfinished_ones(spark, tmp_path):
    from jobsignals.sources import ledger

    path = str(tmp_path / "ledger")
    schema = "page_key string, page_no int, has_more boolean, link_no int"
    for n in range(5):
        ledger.merge_ledger(spark, path, spark.createDataFrame(
            [("t", n, n < 4, n + 2 if n < 4 else None)], schema))
    folders = sorted(p.name for p in (tmp_path / "ledger").iterdir())
    assert len(folders) == ledger.KEEP_VERSIONS
    (tmp_path / "ledger" / "v99999999").mkdir()  # a merge that died before its commit
    got = ledger.read_ledger(spark, path).collect()
    assert sorted((r.page_no, r.has_more, r.first_run) for r in got) == [
        (0, True, 1), (1, True, 2), (2, True, 3), (3, True, 4), (4, False, 5)]
    ledger.merge_ledger(spark, path, spark.createDataFrame([("t", 4, True, 6)], schema))
    assert ledger.read_ledger(spark, path).where("page_no = 4").first().has_more


def test_scan_is_pruned_to_pending_threads(spark, tmp_path):
    rows = [linked(f"t{i}", 0, f"x{i}") for i in range(6)]
    spark.createDataFrame(rows, PAGES).write.partitionBy("page_key").parquet(str(tmp_path / "land"))
    threads = spark.createDataFrame([(f"t{i}", "x", "2023-01-01", "u") for i in range(6)], THREADS)
    landed = spark.read.schema(PAGES).parquet(str(tmp_path / "land"))
    pending = state.pending_threads(threads, spark.createDataFrame([("t0",)], "id string"))
    wanted = landed.join(pending.select(F.col("id").alias("page_key")), "page_key", "left_semi")
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    store, done = str(tmp_path / "s"), str(tmp_path / "d")
    counts = [ingest_batch(spark, threads, landed, store, done, ledger=str(tmp_path / "l"))
              for _ in range(2)]
    assert counts == [6, 0]
    assert {r.id for r in tables.read_comments(spark, store).collect()} == {
        f"x{i}" for i in range(6)}


def test_processed_store_stays_small_and_survives_a_crash(spark, tmp_path):
    store = str(tmp_path / "done")
    for run in range(50):
        state.mark_processed(spark.createDataFrame([(str(run),), (str(run % 7),)], "id string"),
                             store)
    files = [p for p in (tmp_path / "done").rglob("*") if p.is_file()]
    assert len(files) < 4 * (state.COMPACT_EVERY + 2)
    assert {r.id for r in state.read_processed(spark, store).collect()} == {
        str(i) for i in range(50)}
    # A snapshot and a log that died before their commit markers are not read.
    (tmp_path / "done" / "snap-99999999").mkdir()
    (tmp_path / "done" / "snap-99999999" / "part-0.json").write_text(
        json.dumps({"processed_threads": ["ghost"]}))
    (tmp_path / "done" / "log" / "99999998").mkdir()
    assert "ghost" not in {r.id for r in state.read_processed(spark, store).collect()}
    state.mark_processed(spark.createDataFrame([("new",)], "id string"), store)
    assert {r.id for r in state.read_processed(spark, store).collect()} == {
        str(i) for i in range(50)} | {"new"}


def test_schema_census_reads_footers_in_tasks(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id long, x string").coalesce(1).write.parquet(
        str(tmp_path / "t/a"))
    spark.createDataFrame([("2",)], "id string").coalesce(1).write.parquet(str(tmp_path / "t/b"))
    (tmp_path / "t" / "junk.parquet").write_text("no parquet")
    rows = tables.schema_census(spark, str(tmp_path / "t")).collect()
    kinds = sorted(r.schema or "-" for r in rows)
    assert len(rows) == 3 and kinds[0] == "-" and len(set(kinds)) == 3


def test_compaction_survives_a_crash_and_repeats_alike(spark, tmp_path):
    store, out = str(tmp_path / "store"), str(tmp_path / "compacted")
    spark.createDataFrame([page("t1", 0, "a", "b")], PAGES).write.parquet(f"{tmp_path}/land")
    stream(spark, tmp_path, "land", "cp")
    spark.createDataFrame([page("t2", 0, "a", "c", date="2023-02-01")], PAGES).write.parquet(
        f"{tmp_path}/land2")
    stream(spark, tmp_path, "land2", "cp2")
    first = tables.compact_comments(spark, store, out)
    rows = sorted(map(tuple, tables.read_compacted(spark, out).collect()))
    assert sorted(r[0] for r in rows) == ["a", "b", "c"]
    # A compaction that died before its commit: readers stay on the version before.
    (tmp_path / "compacted" / "c99999999" / "month=2023-01").mkdir(parents=True)
    spark.createDataFrame([page("t9", 0, "ghost")], PAGES).write.parquet(
        str(tmp_path / "compacted" / "c99999999" / "month=2023-01" / "x"))
    assert sorted(map(tuple, tables.read_compacted(spark, out).collect())) == rows
    again = tables.compact_comments(spark, store, out)
    assert again > first and sorted(map(tuple, tables.read_compacted(spark, out).collect())) == rows
    tables.compact_comments(spark, store, out)
    assert len(list((tmp_path / "compacted").iterdir())) <= tables.KEEP_COMPACTED


def test_long_rows_leave_a_worker_in_small_batches(spark):
    import pandas as pd
    import pyarrow as pa

    from jobsignals.operators import pages

    class Plan:
        def filter(self, *_):
            return self

        select = filter

        def mapInArrow(self, run, schema):
            return lambda rows: run(iter([pa.RecordBatch.from_pylist(rows)]))

        def mapInPandas(self, run, schema):
            return lambda rows: run(iter([pd.DataFrame(rows)]))

    def read(html):
        done.append(html)
        return [(html, "x" * 1_000_000)]

    done = []
    rows = [{"page_key": None, "thread_date": "d", "html": str(i)} for i in range(40)]
    out = pages._flat_map(Plan(), read, ["id", "raw_text"])(rows)
    next(out)
    assert len(done) <= 6
    assert sum(len(b) for b in out) + len(done[:5]) == 40 and len(done) == 40


def test_drops_build_the_pages_once(spark, sf_dir):
    from jobsignals.plans import derived, queries

    landed = derived.forum_pages(spark, sf_dir)
    drops = queries._drops(landed)
    assert all("Aggregate" not in d._jdf.queryExecution().toString() for d in drops)
    both = drops[0].unionByName(drops[1])
    assert both.dtypes == landed.dtypes and both.exceptAll(landed).isEmpty()
    assert both.count() == landed.count()

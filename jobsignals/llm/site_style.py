"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: a node is a place in the markup, named by the path of
elements and classes that lead to it. A container's presentation importance is the entropy of the
child styles it shows across pages, a block's content importance falls with the share of pages
that repeat its texts: one minus the mean, over its distinct texts, of log(pages with the text) to
the base of the pages with the node. Blocks of low composite importance (advert slots, notices,
link lists) are removed from each page, as is what its markup declares to be no article. Classes
and ids only hint at it (see `settle_hints`): a part of one lowers the importance in the tree, a
whole one takes a branch that has no more than half of the text. No page with text is emptied by that.

The tree is counted in Spark: one row per page, node and text, combined before it moves, so a host
that holds a third of all pages is as good as any. Identical pages count once. Verdicts reach the
pages by two ways with the same result. Low nodes on a hundredth of a host's pages or more come as one
list per host, bounded by a hundred times the blocks of a page. All rarer ones are joined to the
nodes that each page shows, and come as one list per page.

Defined cases: null html gives the empty text. A null url or one without a host shares the host
''. Repeated rows are extracted each. An empty table gives no rows. Nothing is cut off.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignals.llm.common import save, ship
from jobsignals.llm.page_blocks import blocks, main_blocks

HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)"
#: Share of a block's composite importance that its own content has.
CONTENT = 0.9
LOW = 0.5
#: What a hint in a class or id takes off a block's importance.
HINTED = 0.25
MIN_PAGES = 5
#: Share of a host's pages from which on a low node is in the host's list; it decides no result.
LISTED = 0.01


def page_rows(pages: DataFrame) -> DataFrame:
    ship(pages.sparkSession)
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), HOST, 1)
                ).alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    ).withColumn("page", F.xxhash64("html"))


def observations(rows: DataFrame) -> DataFrame:
    """host, node, above, kind ('page', 'text', 'style'), value, page: what a page shows.

    The value of a node on a page is 1 if a class or id hints that all its blocks are no article.
    """
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        def number(text: str) -> int:
            return xxh3_64_intdigest(text) - (1 << 63)

        names = ["host", "node", "above", "kind", "value", "page"]
        for b in parts:
            out = []
            for host, page, key in zip(b.column("host").to_pylist(), b.column("html"),
                                       b.column("page").to_pylist()):
                found, children = blocks(page.as_py())
                mine = {(0, 0, "page", 0)}
                hinted: dict[tuple[int, int], int] = {}
                for x in found:
                    if not x.noise:
                        at = x.node, x.parent
                        hinted[at] = min(hinted.get(at, 1), int(x.hint > 0))
                        mine.add((*at, "text", number(x.text)))
                # Text outside every block is at node 0, which has its row.
                mine.update((*at, "page", h) for at, h in hinted.items() if at[0])
                for node, labels in children.items():
                    mine.add((node, node, "style", number(" ".join(sorted(labels)))))
                out += [(host, *m, key) for m in mine]
            for k in range(0, len(out), 50_000):
                columns = list(zip(*out[k:k + 50_000]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string() if n in ("host", "kind") else pa.int64())
                     for n, c in zip(names, columns)], names)

    return rows.select("host", "html", "page").mapInArrow(
        run, "host string, node long, above long, kind string, value long, page long")


def low_nodes(rows: DataFrame) -> DataFrame:
    """host, node and listed of the blocks of low importance: whether many of its pages show it."""
    counts = (observations(rows).distinct()
              .groupBy("host", "node", "kind", "value")
              .agg(F.min("above").alias("above"), F.count("*").alias("c")))
    page, text, style = (F.col("kind") == k for k in ("page", "text", "style"))
    nodes = save(counts.groupBy("host", "node").agg(
        F.sum(F.when(page, F.col("c"))).alias("pages"),
        F.sum(F.when(page & (F.col("value") == 1), F.col("c"))).alias("hinted"),
        F.min(F.when(page, F.col("above"))).alias("above"),
        F.avg(F.when(text, F.log("c"))).alias("repeat"),
        F.sum(F.when(style, F.col("c"))).alias("shown"),
        F.sum(F.when(style, F.col("c") * F.log("c"))).alias("weighted")), "nodes")
    hosts = nodes.where("node = 0").select("host", F.col("pages").alias("host_pages"))
    spread = nodes.where("shown IS NOT NULL").select(
        "host", F.col("node").alias("above"), "shown",
        F.when(F.col("shown") > 1, (F.log("shown") - F.col("weighted") / F.col("shown"))
               / F.log("shown")).otherwise(1.0).alias("presentation"))
    leaves = nodes.where(f"repeat IS NOT NULL AND pages >= {MIN_PAGES}").drop("shown")
    judged = leaves.join(hosts, "host").join(spread, ["host", "above"], "left").withColumn(
        "importance", CONTENT * (1 - F.col("repeat") / F.log("pages"))
        + (1 - CONTENT) * F.coalesce("presentation", F.lit(1.0))
        - HINTED * F.coalesce("hinted", F.lit(0)) / F.col("pages"))
    return judged.where(F.col("importance") < LOW).select(
        "host", "node", (F.col("pages") >= LISTED * F.col("host_pages")).alias("listed"))


def shown_nodes(rows: DataFrame) -> DataFrame:
    """host, page, node: the nodes of every page that hold text."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            nodes = [sorted({x.node for x in blocks(page.as_py())[0] if not x.noise})
                     for page in b.column("html")]
            yield pa.RecordBatch.from_arrays(
                [b.column("host"), b.column("page"), pa.array(nodes, pa.list_(pa.int64()))],
                ["host", "page", "nodes"])

    return rows.select("host", "page", "html").mapInArrow(
        run, "host string, page long, nodes array<long>").select(
            "host", "page", F.explode("nodes").alias("node"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = page_rows(pages)
    low = save(low_nodes(rows), "low")
    # Saved, so that their measured sizes decide whether the joins move the pages.
    listed = save(low.where("listed").groupBy("host").agg(F.collect_set("node").alias("low")),
                  "listed").withColumnRenamed("host", "of_host")
    joined = rows.join(listed, rows["host"] == listed["of_host"], "left")
    rare = low.where("NOT listed").select("host", "node")
    if rare.isEmpty():
        joined = joined.withColumn("own", F.lit(None).cast("array<long>"))
    else:
        own = save(shown_nodes(rows).join(rare, ["host", "node"]).groupBy("host", "page").agg(
            F.collect_set("node").alias("own")), "own").withColumnsRenamed(
                {"host": "own_host", "page": "own_page"})
        joined = joined.join(own, (F.col("host") == own["own_host"])
                             & (F.col("page") == own["own_page"]), "left")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            texts = ["\n\n".join(x.text for x in main_blocks(
                         page.as_py(), frozenset(low or ()).union(own or ())))
                     for page, low, own in zip(b.column("html"), b.column("low").to_pylist(),
                                               b.column("own").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "low", "own").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")

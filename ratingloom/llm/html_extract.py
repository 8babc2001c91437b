"""Main-text extraction by consensus paths of a host.

Each page scores its containers and names the path (tags with classes, without numbers) of the best one. In
Spark, pages vote per host; the paths with most votes are then applied to all its pages, so a page whose own
best guess is a sidebar or a long comment is read as its siblings are.

Scale: votes are one row per (host, path) and task before the shuffle, so a large host costs no more than its
templates. Pages are read twice and not shuffled, as long as Spark finds the table of winning paths small.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratingloom.llm.html_blocks import Page, path_key, read_page, score_containers, text_inside
from ratingloom.llm.registry import load, query
from ratingloom.session import durable

WINNERS = 3  # paths that a host's pages are read by
LEAST_VOTES = 0.05  # of a host's pages, for all winners but the first


def host_of(url) -> F.Column:
    """Host of an address in lower case without user and port; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(host)


def page_votes(pages: DataFrame) -> DataFrame:
    """(host, path, score): the best container of each page; pages without text have no vote."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, scores = [], [], []
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = read_page(source)
                best = score_containers(page)
                if best >= 0:
                    hosts.append(host)
                    paths.append(page.containers[best].path)
                    scores.append(page.containers[best].score)
            yield pa.RecordBatch.from_pydict(
                {"host": pa.array(hosts, pa.string()), "path": pa.array(paths, pa.string()), "score": pa.array(scores, pa.float64())}
            )

    return pages.select("host", "html").mapInArrow(vote, "host string, path string, score double")


def winning_paths(votes: DataFrame, winners: int = WINNERS) -> DataFrame:
    """(host, paths): a host's paths by falling number of votes, then text, then name. But for the first, a path needs
    the votes of two pages and of LEAST_VOTES of all."""
    counted = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum(F.floor("score")).alias("score"))
    order = Window.partitionBy("host").orderBy(F.desc("votes"), F.desc("score"), "path")
    all_votes = votes.groupBy("host").agg(F.count(F.lit(1)).alias("all"))
    ranked = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= winners).join(all_votes, "host")
    backed = (F.col("rank") == 1) | ((F.col("votes") > 1) & (F.col("votes") >= LEAST_VOTES * F.col("all")))
    kept = ranked.where(backed).groupBy("host").agg(F.array_sort(F.collect_list(F.struct("rank", "path")))["path"].alias("paths"))
    return kept


def main_text(page: Page, paths: list[str]) -> str:
    """Text inside the page's own best container if that is of a winning path, else inside the winning path that the
    page scores best; on a page that has none of them, inside its own best."""
    best = score_containers(page)
    if best < 0:
        return ""
    keys = [c.key for c in page.containers]
    scores = {path_key(path): 0.0 for path in paths}
    if keys[best] not in scores:
        for key, container in zip(keys, page.containers):
            if key in scores:
                scores[key] += container.score
        path, score = max(scores.items(), key=lambda s: s[1], default=(b"", 0.0))
        if score > 0:
            return text_inside(page, {i for i, key in enumerate(keys) if key == path})
        return text_inside(page, {best})
    return text_inside(page, {i for i, key in enumerate(keys) if key == keys[best]})


def extract(pages: DataFrame, winners: int = WINNERS) -> DataFrame:
    """page_id, url, text, n_chars, host, path_votes per row of `pages` (page_id, url, html).

    A null or empty page, or one without text outside menus and the like, gives an empty text. Pages without a
    host form one group. Repeated rows vote and come back each on their own.
    """
    known = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host")
    )
    winning = durable(winning_paths(page_votes(known), winners))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (3, 4)]
            texts = [main_text(read_page(source), paths or []) for source, paths in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(texts, pa.string())], names=["page_id", "url", "host", "text"]
            )

    joined = known.join(winning, "host", "left").select("page_id", "url", "host", "html", "paths")
    id_type = dict(pages.dtypes)["page_id"]
    texts = joined.mapInArrow(read, f"page_id {id_type}, url string, host string, text string")
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "host")


@query("op5_extract_html")
def op5_extract_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return extract(load(spark, folder, "pages", "page_id", "url", "html")).drop("host")

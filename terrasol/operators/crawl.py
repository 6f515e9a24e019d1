"""Following links over already-fetched pages: paged listings and one-hop links.

Every listing chain grows in rounds: only the pages that the last round found are
joined with the links (semi-naive), pages a chain has seen are dropped by an anti
join, so a cycle ends, and each round is written to the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasol.operators.joins import by_shuffle
from terrasol.session import checkpoint_dir


def follow(start: DataFrame, links: DataFrame, hops: int | None = None) -> DataFrame:
    """``origin, url, hop``: all pages that each start url reaches over links(url, next_url).

    ``hop`` is the least number of links from the origin (0: the origin itself);
    ``hops`` bounds it.  Null urls lead nowhere; repeated starts and links count once.
    """
    spark = start.sparkSession
    root = f"{checkpoint_dir(spark).rstrip('/')}/terrasol-crawl-{uuid.uuid4().hex}"
    edges = links.select("url", "next_url").where("url is not null and next_url is not null").distinct()
    edges.write.parquet(f"{root}/links")
    edges = spark.read.parquet(f"{root}/links")
    new = start.where("url is not null").select(F.col("url").alias("origin"), "url").distinct().withColumn("hop", F.lit(0))
    schema = new.schema
    k = 0
    while True:
        new.write.parquet(f"{root}/pages/round={k}")
        frontier = spark.read.schema(schema).parquet(f"{root}/pages/round={k}")
        seen = spark.read.schema(schema).parquet(*(f"{root}/pages/round={r}" for r in range(k + 1)))
        if frontier.isEmpty() or k == hops:
            return seen
        k += 1
        found = frontier.join(by_shuffle(edges), "url").select("origin", F.col("next_url").alias("url")).distinct()
        new = found.join(by_shuffle(seen.select("origin", "url")), ["origin", "url"], "left_anti").select("origin", "url", F.lit(k).alias("hop"))


def next_links(tree: DataFrame, condition, base: str = "url") -> DataFrame:
    """``url, next_url``: the first link of each page that meets the condition, resolved."""
    from terrasol.functions import harvest as hv
    first = tree.where((F.col("tag") == "a") & F.col("href").isNotNull() & condition).groupBy("page_id", base).agg(F.min_by("href", "pos").alias("_href"))
    return first.select(F.col(base).alias("url"), hv.resolve_url(F.col(base), F.col("_href")).alias("next_url"))

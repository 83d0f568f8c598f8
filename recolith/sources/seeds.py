"""Configured seeds beside live pages: fallbacks, and unions that prefer the seed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import name_key
from ..functions.url import without_www
from ..operators.windows import first_per_key


class Forbidden(Exception):
    """A source refuses (HTTP 403)."""


def live_or_seed(live: Callable[[], DataFrame], seed: DataFrame) -> DataFrame:
    """The live rows; where the source refuses, the seed. ``from_seed`` tells; other errors are raised."""
    try:
        return live().withColumn("from_seed", F.lit(False))
    except Forbidden:
        return seed.withColumn("from_seed", F.lit(True))


def seeded(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """name and url of the seeds, and of links (name, url, pos) of which neither the url nor the name is there yet; the first of each."""
    rows = links.withColumn("u", without_www(F.col("url"))).withColumn("n", name_key(F.col("name")))
    known = seeds.select(without_www(F.col("url")).alias("u"), name_key(F.col("name")).alias("n"))
    new = rows.join(known.select("u"), "u", "left_anti").join(known.select("n"), "n", "left_anti")
    new = first_per_key(first_per_key(new, ["u"], F.col("pos")), ["n"], F.col("pos"))
    return seeds.select("name", "url", F.lit(True).alias("from_seed")).unionByName(new.select("name", "url", F.lit(False).alias("from_seed")))


def on_pages(seeds: DataFrame, pages: DataFrame, facts: DataFrame, id_col: str) -> DataFrame:
    """Seeds (name, url) with what their pages say (``html.page_facts``); without a page, nulls."""
    found = pages.select(id_col, "url").join(facts, id_col)
    return seeds.join(found, "url", "left").drop(id_col)

"""Links between ids, followed to their end: components of a graph and chains of replacements, in rounds whose number is logarithmic in their length.

Each round is a few joins and a written table. No neighbourhood or component is collected anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..stages import materialise


def _content(df: DataFrame) -> tuple:
    hashes = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
    return tuple(df.agg(F.count("*"), hashes).first())


def components(edges: DataFrame) -> DataFrame:
    """id and component, the smallest id that it is linked with, of all ends of ``edges`` (a, b). Edges in a null don't link.

    Stars in turn: every node's larger neighbours are tied to its smallest one, then every node and its smaller neighbours
    to the smallest of these, until nothing changes and each component is one star.
    """
    ends = edges.select(F.explode(F.array("a", "b")).alias("id")).where("id IS NOT NULL").distinct()
    pairs = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    now, before = _content(pairs), None
    while now != before:
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        pairs = materialise(small, "links")
        now, before = _content(pairs), now
    return ends.join(pairs.withColumnRenamed("a", "id"), "id", "left").select("id", F.coalesce("b", "id").alias("component"))


def ends(steps: DataFrame) -> DataFrame:
    """id and end of ``steps`` (id, to, at): where one arrives who follows ``to`` from id on, as long as each step is later (``at``) than the
    one before. An id has one step; a null ``to`` ends the way nowhere.

    Pointers double: a round replaces every open pointer by that of its end, so a chain of n steps takes log n rounds.
    """
    later = steps.select(F.col("id").alias("to"), F.col("at").alias("__at"))
    now = steps.join(later, "to", "left").select("id", F.col("to").alias("end"), F.coalesce(F.col("__at") > F.col("at"), F.lit(False)).alias("open"))
    now = materialise(now, "ends")
    while not now.where("open").isEmpty():
        ahead = now.select(F.col("id").alias("end"), F.col("end").alias("__end"), F.col("open").alias("__open"))
        moved = now.where("open").join(ahead, "end").select("id", F.col("__end").alias("end"), F.col("__open").alias("open"))
        now = materialise(now.where("NOT open").unionByName(moved), "ends")
    return now.select("id", "end")

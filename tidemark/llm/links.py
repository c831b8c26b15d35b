"""Groups of linked rows: candidate buckets, exact links between groups, connected components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.operators.skew import split_join


def _all_stars(edges: DataFrame) -> bool:
    """Whether every edge (``a`` > ``b``) leads to a centre: nothing leaves a ``b``, one edge leaves each ``a``."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    degree = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return degree.where("out > 1 or (out > 0 and into > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``comp``, the smallest id reachable, for every id in ``edges`` (``a``, ``b``).

    Alternating large-star and small-star steps, each one aggregation and one join whose hot
    nodes AQE can split; each round is written out, so lineage stays short. Stops when all edges form
    stars, after a number of rounds that grows with the logarithm of the longest path; edges that
    are stars already cost no round. Loops, repeated and reversed edges do no harm; an empty table
    gives an empty one.
    """
    given = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    now = given.where("a <> b")
    while not _all_stars(now):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = split_join(both.where("b > a"), least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Every edge now points from a greater to a smaller id.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = split_join(large, least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        now = stored(small.where("a <> b").distinct(), "round")
    nodes = given.select(F.col("a").alias("id")).union(given.select(F.col("b").alias("id"))).distinct()
    return nodes.join(now.select(F.col("a").alias("id"), F.col("b").alias("root")), "id", "left").select(
        "id", F.coalesce("root", "id").alias("comp"))


def linked_groups(
    members: DataFrame, verify: Callable[[DataFrame], DataFrame], traits: DataFrame, near: Callable[[Column, Column], Column],
) -> DataFrame:
    """``id``, ``comp`` of every id with a verified link, from buckets, without the pairs within a group.

    ``members`` has ``key``, ``id`` (a long) and two roles as booleans: ``home`` and ``full``. Two ids
    are candidates where they share a key, one of them is home and one is full. ``verify`` keeps of
    pairs (``a`` < ``b``, distinct) those that are links. ``traits`` has a small value ``trait`` of each ``id`` once; ``near`` tells
    from two of them, in either order, whether a link is possible at all, before pairs are made or shuffled.

    First each bucket's members are held against its smallest id only. What these links join needs
    no further look; then all candidates from different groups are verified. So a bucket of
    copies costs one pair per member, and no link between groups is lost. ``members`` is computed once, need not be
    stored, and streams through the task of its bucket: no bucket is held in memory.
    """
    test = near(F.col("trait_x"), F.col("trait_y"))
    # An id may repeat in a bucket: at worst a few more candidates, all verified. Count and join read one and the same shuffle,
    # so members of no bucket with others, nearly all of them, are written out once and no more.
    members = members.select("key", "id", "home", "full").where("key is not null and id is not null").repartition("key")
    size = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("centre"), F.max("home").alias("h"), F.max("full").alias("f"))
    busy = members.hint("merge").join(size.where("n > 1 and h and f").drop("h", "f"), "key")
    busy = stored(busy.join(traits.select("id", "trait"), "id"), "busy")
    star = busy.where("id <> centre").select("key", F.col("centre").alias("a"), F.col("id").alias("b"), F.col("trait").alias("trait_y"))
    star = split_join(star, busy.where("id = centre").select("key", F.col("trait").alias("trait_x")), ["key"])
    star = star.where(test).select("a", "b").distinct()
    first = stored(components(verify(star)), "first")
    # In a bucket of two the star has seen the only pair.
    grouped = split_join(busy.where("n > 2").select("id", "key", "home", "full", "trait"), first, ["id"], "left").select(
        "key", "id", "home", "full", "trait", F.coalesce("comp", "id").alias("comp"))
    several = grouped.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
    apart = stored(split_join(grouped, several, ["key"], "left_semi"), "apart")
    # A group of one in its bucket is tested by its trait, so that strangers in a large bucket never become rows.
    groups = apart.groupBy("key", "comp").agg(
        F.max("home").alias("home"), F.max("full").alias("full"), F.when(F.min("id") == F.max("id"), F.first("trait")).alias("trait"))
    x, y = (groups.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("comp", "home", "full", "trait")]) for s in "xy")
    across = x.join(y, "key").where("comp_x < comp_y and (home_x or home_y) and (full_x or full_y)").where(F.coalesce(test, F.lit(True)))
    across = across.select("key", "comp_x", "comp_y", F.col("trait_y").alias("trait_of_y"))
    x, y = (apart.select("key", F.col("comp").alias(f"comp_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in ("id", "home", "full", "trait")]) for s in "xy")
    pairs = across.join(x, ["key", "comp_x"]).where(F.coalesce(near(F.col("trait_x"), F.col("trait_of_y")), F.lit(True))).join(y, ["key", "comp_y"]).where("(home_x or home_y) and (full_x or full_y)").where(test)
    pairs = pairs.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()
    links = first.select(F.col("id").alias("a"), F.col("comp").alias("b")).union(verify(pairs.join(star, ["a", "b"], "left_anti")))
    return components(links)

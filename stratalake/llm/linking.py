"""Connected groups of nodes that share buckets, without ever listing all pairs of a bucket.

Candidates meet in buckets. Each member of a bucket is first compared with the bucket's smallest member
(its centre). Once the links found have made components, only members that are in another component
than their centre are compared with the rest of the bucket, for a pair within one component cannot change
the result. So a bucket of n copies costs n comparisons, while no link between different components is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import discard, store

#: Comparisons with a further centre, among members apart from the first, before the rest are compared in full.
CENTRE_ROUNDS = 2


def components(edges: DataFrame) -> DataFrame:
    """Columns node, component (the smallest node reachable) for all ends of ``edges`` (a, b).

    Alternates large-star and small-star steps: every node hands its larger, then its smaller, neighbours
    to its smallest neighbour, until each component is a star. A step is a minimum per node, which is
    combined before the shuffle, and a join that Spark can split; the neighbours of a node never meet in
    one row or task. Null ends and loops are ignored; no edges give no rows.
    """
    stars = store(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .where(F.col("hi") > F.col("lo"))
        .distinct(),
        "edges",
    )
    if stars.isEmpty():
        return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    while True:
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(stars.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
            .distinct()
        )
        floor = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        small = large.join(floor, F.col("hi") == F.col("u")).select(
            F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("m").alias("lo")
        )
        after = store(small.distinct(), "stars")
        # each component is a star when no node is both below another and above one, and no node hangs on two
        centres = after.select(F.col("lo").alias("hi")).distinct()
        forked = after.groupBy("hi").count().where("count > 1").select("hi")
        deep = after.join(centres, "hi", "left_semi").select("hi")
        stars = after
        if forked.union(deep).isEmpty():
            break
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        stars.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )


def _labelled(live: DataFrame, labels: DataFrame) -> DataFrame:
    """The component of each member and of its centre; a node without links is its own component."""
    of = labels.select("node", F.col("component").alias("own"))
    to = labels.select(F.col("node").alias("centre"), F.col("component").alias("its"))
    return (
        live.join(of, "node", "left")
        .join(to, "centre", "left")
        .select("bucket", "node", "centre", F.coalesce("own", "node").alias("own"), F.coalesce("its", "centre").alias("its"))
    )


def _joined(labels: DataFrame, found: DataFrame) -> DataFrame:
    """The components after more links; those so far are stars already."""
    if found.isEmpty():
        return labels
    stars = labels.select(F.col("component").alias("a"), F.col("node").alias("b"))
    return components(stars.union(found.select("a", "b")))


def meeting(members: DataFrame, once: bool = False) -> DataFrame:
    """The rows of ``members`` (bucket, node) whose bucket holds another node, with the bucket's centre, and whether it has more than
    two rows; stored.

    Rows with a null bucket or node take no part. With ``once`` the members are worked out and shuffled a single time, for the
    count of a bucket and for its rows; this is for members that are costly and mostly alone. A bucket then is read by one task,
    which holds none of its rows. Otherwise Spark may split large buckets.
    """
    members = members.select("bucket", "node").where("node is not null")
    if once:
        members = members.where("bucket is not null").repartition("bucket")
    shared = (
        members.groupBy("bucket")
        .agg(F.min("node").alias("centre"), F.max("node").alias("top"), (F.count("node") > 2).alias("several"))
        .where("centre < top")
        .select("bucket", "centre", "several")
    )
    # a row per bucket at most: a hash table of these holds less than the aggregate did
    shared = shared.hint("shuffle_hash") if once else shared
    return store(members.join(shared, "bucket").select("bucket", "node", "centre", "several"), "members")


def link(
    live: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    traits: DataFrame,
    possible: Callable[[Column, Column], Column],
    known: DataFrame | None = None,
    pairs_a_row: int = 0,
) -> DataFrame:
    """Columns node, component for the nodes that have a link; ``live`` comes from ``meeting``
    and is removed in the end.

    If no more than ``pairs_a_row`` pairs for each row of ``live`` are left to compare after the first centres, they are compared at once.
    Otherwise further centres come first. This changes the work, not the result.

    ``verify`` takes distinct pairs (a, b) with a < b and returns those that are links. A pair is judged only if
    it shares a bucket. ``possible`` tells from the ``traits`` (node, trait) of two nodes whether they can be a link at all;
    it must never refuse a link, and spares ``verify`` the rest. ``known`` (a, b) are links without a test.
    Repeated rows count once.
    """
    pairs = live.where("centre < node").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    links = verify(pairs).select("a", "b")
    links = store(links if known is None else links.union(known.select("a", "b")), "links")
    labels = components(links)
    # two rows are compared by now
    wide = live.where("several").drop("several")
    rest, read, marked = wide, [live], None
    if pairs_a_row:
        marked = store(_labelled(wide, labels), "marked")
        sizes = marked.groupBy("bucket").agg(F.count("*").alias("rows"), F.count_if(F.col("own") != F.col("its")).alias("apart"))
        few = sizes.agg(F.sum(F.col("rows").cast("double") * F.col("apart")) <= pairs_a_row * F.sum("rows")).first()[0]
        if few is False:
            discard(marked)
            marked = None
    for _ in range(CENTRE_ROUNDS if marked is None else 0):
        # members apart from their centre: the smallest of them in each bucket becomes their next centre
        apart = _labelled(rest, labels).where("own <> its").select("bucket", "node")
        next_centre = (
            apart.groupBy("bucket")
            .agg(F.min("node").alias("centre"), F.max("node").alias("top"))
            .where("centre < top")
            .select("bucket", "centre")
        )
        rest = store(apart.join(next_centre, "bucket"), "members")
        read.append(rest)
        if rest.isEmpty():
            break
        pairs = rest.where("centre < node").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
        found = store(verify(pairs).select("a", "b"), "links")
        labels = _joined(labels, found)
    # what is still apart is compared with every member of another component
    if marked is None:
        marked = store(_labelled(wide, labels), "marked")
    for members in read:
        discard(members)
    left = marked.where("own <> its").select("bucket", F.col("node").alias("x"), F.col("own").alias("x_own"))
    right = (
        marked.where("node <> centre")
        .join(left.select("bucket").distinct(), "bucket", "left_semi")
        .select("bucket", F.col("node").alias("y"), F.col("own").alias("y_own"), "its")
    )
    left = left.join(traits.select(F.col("node").alias("x"), F.col("trait").alias("x_trait")), "x")
    right = right.join(traits.select(F.col("node").alias("y"), F.col("trait").alias("y_trait")), "y")
    cross = (
        left.join(
            right,
            (left["bucket"] == right["bucket"])
            & (F.col("x_own") != F.col("y_own"))
            & ((F.col("y_own") == F.col("its")) | (F.col("x") < F.col("y")))
            & possible(F.col("x_trait"), F.col("y_trait")),
        )
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )
    found = store(verify(cross).select("a", "b"), "links")
    return _joined(labels, found)

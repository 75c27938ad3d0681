"""Merkle manifest of a dataset: interval-labelled nodes, membership proofs, tamper checks.

A leaf is the digest of one row's fields. The leaves of one tree, in the order of their key,
have ranks 0, 1, 2, ...; every 8 consecutive nodes of a level become one node of the next,
until one is left, the tree's subroot. The subroots, by the name of their tree, are the
leaves of a last tree of the same kind, which ends in the root.

A node carries the interval ``[lo, hi)`` of leaf ranks that it covers. An ancestor is found
by containment: nodes of one level are bucketed by the width of the next, so a node meets
the one parent that can contain it in an equi-join. What is left of the parent's interval
without the node's own, before it and after it, names its siblings. Paths are handed down
from the root one level at a time, and leaves only meet the node right above them, in rows
of eight, so a tree is never in one task.

Ranks are given over a range partitioning, by counts of each partition; a tree with a third
of all rows, or one key that repeats, spreads over many of them.

Defined results: a NULL field is ``-`` in its leaf, a NULL tree is a tree of its own and the
first, a NULL key comes first in its tree. Rows with one key are ordered by their leaf;
equal rows are leaves each, whose proofs differ as their places do. A tree of one leaf has
it as its subroot, and a manifest of one subroot has it as its root. Texts are hashed whole.
Without rows there are no nodes, no proofs and no root. Other columns play no part, unless
``carry`` names them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlake.llm.native import table

ARITY = 8
STEPS = "array<struct<before: string, after: string>>"
PLACE_BITS = 33


def hashed(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts after one another."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field_text(value: Column) -> Column:
    """``-`` for NULL, otherwise the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    """Digest of a row's fields."""
    return hashed(*(field_text(f) for f in fields))


@dataclass
class Manifest:
    """``levels[k]`` holds the nodes of level ``k + 1`` of all trees: ``tree, n, lo, hi,
    hash, kids``. ``subroots`` has ``tree, subroot, path``; a path is a list of the siblings
    ``before`` and ``after`` at each level, upwards."""

    levels: list[DataFrame]
    subroots: DataFrame
    root: str | None

    def nodes(self) -> DataFrame:
        """All nodes above the leaves with the interval of leaf ranks they cover."""
        parts = [
            nodes.select(F.substring("tree", 2, 2**31 - 1).alias("tree"), F.lit(k).alias("level"), "lo", "hi", "hash")
            for k, nodes in enumerate(self.levels, 1)
        ]
        every = parts[0]
        for more in parts[1:]:
            every = every.unionByName(more)
        return every


def tree_name(tree: Column) -> Column:
    """Text that orders trees bytewise with NULL first, and is never NULL."""
    return F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit("-"))


def _ranked(leaves: DataFrame, *order: str) -> DataFrame:
    """Add ``lo``, the rank of a row in its tree, and ``n``, the rows of the tree.

    Rows are range-partitioned and sorted once; a partition's part of a tree is counted, and
    running sums of these counts say where it begins. A tree has at most as many such counts
    as there are partitions.
    """
    numbered = leaves.withColumn("_row", F.monotonically_increasing_id())
    by = ("tree", *order, "_row")
    placed = numbered.repartitionByRange(*by).sortWithinPartitions(*by).drop("_row")
    placed = table(placed.withColumn("_place", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumns(
        {
            "_part": F.shiftright("_place", PLACE_BITS),
            "_nth": F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)),
        }
    )
    runs = placed.groupBy("tree", "_part").agg(F.count("*").alias("size"), F.min("_nth").alias("low"))
    whole = Window.partitionBy("tree")
    starts = runs.select(
        "tree",
        "_part",
        (F.sum("size").over(whole.orderBy("_part")) - F.col("size") - F.col("low")).alias("_shift"),
        F.sum("size").over(whole).alias("n"),
    )
    starts = table(starts, "starts")
    ranked = placed.join(starts, ["tree", "_part"]).withColumn("lo", F.col("_nth") + F.col("_shift"))
    return ranked.drop("_place", "_part", "_nth", "_shift")


def _bucket(width: int) -> Column:
    return F.floor(F.col("lo") / F.lit(width)).cast("bigint")


def _parents(children: DataFrame, width: int, carry: Sequence[str] = ()) -> DataFrame:
    """Nodes of ``width`` leaves over the nodes below them, at most eight each."""
    kid = F.struct("lo", "hi", "hash", *carry)
    parents = children.groupBy("tree", "n", _bucket(width).alias("_bucket")).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
    both = hashed(F.array_join(F.transform("kids", lambda k: k["hash"]), ""))
    # a lone leaf is no run
    return parents.select(
        "tree",
        "n",
        (F.col("_bucket") * width).alias("lo"),
        F.least((F.col("_bucket") + 1) * width, "n").alias("hi"),
        F.when(F.col("n") == 1, F.col("kids")[0]["hash"]).otherwise(both).alias("hash"),
        "kids",
    )


def _grow(ranked: DataFrame, carry: Sequence[str]) -> list[DataFrame]:
    """Every level above ranked leaves, each written once; a level has an eighth of the rows
    of the one below."""
    leaves = ranked.withColumn("hi", F.col("lo") + 1)
    levels = [table(_parents(leaves, ARITY, carry), "manifest-1")]
    most = levels[0].agg(F.max("n")).first()[0]
    if most is None:
        return []
    width = ARITY
    while width < most:
        below, width = levels[-1].filter(F.col("n") > width), width * ARITY
        levels.append(table(_parents(below, width), f"manifest-{len(levels) + 1}"))
    return levels


def _tops(levels: Sequence[DataFrame]) -> DataFrame:
    """``tree, hash`` of the node of each tree that covers all of it."""
    tops = [nodes.filter((F.col("lo") == 0) & (F.col("hi") == F.col("n"))).select("tree", "hash") for nodes in levels]
    every = tops[0]
    for more in tops[1:]:
        every = every.unionByName(more)
    return every


def _step(kids: Column, lo: Column, hi: Column) -> Column:
    """Siblings of the node ``[lo, hi)``: the rest of its parent's interval on both sides."""
    said = lambda part: F.array_join(F.transform(part, lambda k: k["hash"]), "")
    before, after = F.filter(kids, lambda k: k["hi"] <= lo), F.filter(kids, lambda k: k["lo"] >= hi)
    return F.struct(said(before).alias("before"), said(after).alias("after"))


def _handed_down(levels: Sequence[DataFrame], tops: DataFrame | None) -> DataFrame:
    """The lowest level with ``path`` and the columns of ``tops``, one row a tree with the
    path of its subroot; without them paths begin at the tops of the trees."""
    given = [c for c in tops.columns if c not in ("tree", "path")] if tops else []
    above = None
    for k in range(len(levels), 0, -1):
        nodes = levels[k - 1]
        covers = (F.col("lo") == 0) & (F.col("hi") == F.col("n"))
        ends = nodes.filter(covers)
        with_path = ends.join(tops, "tree") if tops else ends.withColumn("path", F.array().cast(STEPS))
        if above is not None:
            parent = above.select(
                F.col("tree").alias("p_tree"),
                F.col("lo").alias("p_lo"),
                F.col("hi").alias("p_hi"),
                F.col("kids").alias("p_kids"),
                F.col("path").alias("p_path"),
                _bucket(ARITY ** (k + 1)).alias("p_bucket"),
                *given,
            )
            contained = (
                (F.col("tree") == F.col("p_tree"))
                & (_bucket(ARITY ** (k + 1)) == F.col("p_bucket"))
                & (F.col("p_lo") <= F.col("lo"))
                & (F.col("hi") <= F.col("p_hi"))
            )
            joined = nodes.filter(~covers).join(parent, contained)
            path = F.concat(F.array(_step(F.col("p_kids"), F.col("lo"), F.col("hi"))), "p_path")
            with_path = with_path.unionByName(joined.withColumn("path", path).select(*nodes.columns, "path", *given))
        above = with_path
    return above


def _leaf_paths(lowest: DataFrame, carry: Sequence[str], given: Sequence[str]) -> DataFrame:
    """Leaves of the lowest level: their place, hash, path and what they carry."""
    each = lowest.select("tree", "n", "kids", "path", *given, F.explode("kids").alias("kid"))
    own = F.array(_step(F.col("kids"), F.col("kid.lo"), F.col("kid.hi")))
    # a lone leaf is its tree's subroot, so its path begins above the tree
    steps = F.concat(F.when(F.col("n") == 1, F.array().cast(STEPS)).otherwise(own), "path")
    return each.select(
        "tree", F.col("kid.lo").alias("rank"), F.col("kid.hash").alias("leaf"), *[F.col(f"kid.{c}").alias(c) for c in carry],
        *given, steps.alias("path"),
    )


def build(leaves: DataFrame, *, key: str = "key", carry: Sequence[str] = ()) -> Manifest:
    """Trees over rows of ``tree, key, leaf`` and the columns that leaves ``carry``.

    ``leaves`` is written before it is ranked, so that no text is hashed twice.
    """
    named = leaves.select(tree_name(F.col("tree")).alias("tree"), F.col(key).alias("_key"), F.col("leaf").alias("hash"), *carry)
    ranked = _ranked(table(named, "leaves"), "_key", "hash")
    levels = _grow(ranked, carry)
    schema = f"tree string, subroot string, path {STEPS}"
    if not levels:
        return Manifest([], leaves.sparkSession.createDataFrame([], schema), None)
    own = table(_tops(levels).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash"), "subroots")
    over = _grow(_ranked(own, "name"), ("name",))
    root = _tops(over).first()["hash"]
    subroots = _leaf_paths(_handed_down(over, None), ("name",), ()).select(
        F.col("name").alias("tree"), F.col("leaf").alias("subroot"), "path"
    )
    return Manifest(levels, table(subroots, "subroot-paths"), root)


def proofs(manifest: Manifest, carry: Sequence[str] = ()) -> DataFrame:
    """``tree, rank, leaf, subroot, path`` of every leaf, and what leaves carry."""
    lowest = _handed_down(manifest.levels, manifest.subroots)
    return _leaf_paths(lowest, carry, ("subroot",))


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level and from left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to by its path."""
    return F.aggregate(path, leaf, lambda node, s: hashed(s["before"], node, s["after"]))

"""Merkle manifest of a dataset: one persistent tree per group, its proofs, and a version for every tampered leaf.

Rows become leaves (a digest of their fields), ordered within their group; every ``FAN`` consecutive nodes of a
level become the digest of their digests until one is left, the group's subroot. The subroots, in the order of
their groups, are the leaves of the top tree, whose last node is the root.

How it runs: a group's leaves are numbered by a range-partitioned sort and the sizes of the partitions before, and
cut into aligned blocks of ``2 ** height``. A block is a tree of its own that one task builds; its top is a leaf of
the tier above, which is cut into blocks in turn, until every group has one node. No task ever sees more than one
block, however large a group is. Downwards, every tier gives its blocks the way from their top to the root.

Versions are made by path copying: a tampered leaf adds to its block's tree the new leaf and copies of its
ancestors, and the version's top refers to them; every other node is the one of the untampered tree and is shared.
The version goes on in the tiers above along the same way, copying one node a level.

Defined results: nulls are fields like any other (``-``); null groups are one group, before all others; null keys
come first. Rows with equal keys are leaves of their own, ordered by their digests. Equal rows have equal leaves but
different places; each row gets the proof of one of them. An empty table returns no rows. Other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import staged

#: Nodes that become one node of the next level.
FAN = 2
#: Levels of a block: 1,024 leaves, 130 kB of digests.
HEIGHT = 10

NODES = "grp string, pos bigint, digest string, n bigint"
PATHS = "grp string, pos bigint, siblings array<string>, sides string, subroot string"
PROOFS = ("grp string, pos bigint, key string, leaf string, subroot string, siblings array<string>, sides string, "
          "new_leaf string, copies array<string>, folded string")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(*cols: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in cols]), 256)


class PersistentTree:
    """A tree over a run of digests. Nodes are never changed: a version adds nodes and shares all others.

    ``height``: levels above the leaves; None for as many as it takes to reach one node.
    """

    def __init__(self, leaves: list[str], height: int | None = None):
        self.digests = list(leaves)
        self.levels = [list(range(len(leaves)))]  # node numbers by level, of the first version
        while len(self.levels[-1]) > 1 if height is None else len(self.levels) <= height:
            last = self.levels[-1]
            self.levels.append([self._add(digest(*[self.digests[i] for i in last[at:at + FAN]])) for at in range(0, len(last), FAN)])

    def _add(self, value: str) -> int:
        self.digests.append(value)
        return len(self.digests) - 1

    @property
    def top(self) -> str:
        return self.digests[self.levels[-1][0]]

    def way(self, pos: int) -> tuple[list[str], str]:
        """The siblings of a leaf and its ancestors, level by level; sides: ``l``/``r``, one for each sibling, ``/`` after a level."""
        siblings, sides = [], []
        for level in self.levels[:-1]:
            start = pos - pos % FAN
            for i in range(start, min(start + FAN, len(level))):
                if i != pos:
                    siblings.append(self.digests[level[i]])
                    sides.append("l" if i < pos else "r")
            sides.append("/")
            pos //= FAN
        return siblings, "".join(sides)

    def version(self, pos: int, value: str) -> list[int]:
        """The nodes of a new version that differ from the first one: the new leaf and the copies of its ancestors."""
        copies = [self._add(value)]
        for level in self.levels[:-1]:
            start = pos - pos % FAN
            parts = [self.digests[copies[-1] if i == pos else level[i]] for i in range(start, min(start + FAN, len(level)))]
            copies.append(self._add(digest(*parts)))
            pos //= FAN
        return copies


def climb(value: str, siblings: list[str], sides: str) -> list[str]:
    """The digests of a node's ancestors, from the siblings on its way: what a version copies above its block."""
    out, at = [], 0
    for level in sides.split("/")[:-1]:
        here = siblings[at:at + len(level)]
        at += len(level)
        left = level.count("l")
        value = digest(*here[:left], value, *here[left:])
        out.append(value)
    return out


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``pos`` (from 0, within the group, by ``order``) and ``n`` (rows of the group).

    A group is spread over as many partitions as it needs; only partition sizes are summed up in a window.
    """
    spark = rows.sparkSession
    cols = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    sorted_rows = (rows.repartitionByRange(parts, *cols).sortWithinPartitions(*cols)
                   .withColumn("_at", F.monotonically_increasing_id()))
    rows = staged(sorted_rows, "merkle-sorted").withColumn("_part", F.shiftright("_at", 33))
    sizes = rows.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_size"))
    sizes = staged(sizes, "merkle-sizes")  # a row for each partition, and one more for each group
    before = (f"coalesce(sum(_size) over (partition by `{group}` order by _part rows between unbounded preceding and 1 preceding), 0)")
    sizes = sizes.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), "_first", F.expr(before).alias("_before"),
                         F.expr(f"sum(_size) over (partition by `{group}`)").alias("n"))
    on = (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g"))
    return (rows.join(sizes, on).withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before"))
            .drop("_at", "_part", "_g", "_p", "_first", "_before"))


def _tree(nodes: pd.DataFrame, height: int) -> PersistentTree:
    """The tree of one block: of more than one block, every one climbs all of the height."""
    return PersistentTree(nodes["digest"].tolist(), height if nodes["n"].iloc[0] > 1 << height else None)


def _build(part: pd.DataFrame, height: int) -> pd.DataFrame:
    part = part.sort_values("pos")
    top = (part["grp"].iloc[0], int(part["pos"].iloc[0]) >> height, _tree(part, height).top, -(-int(part["n"].iloc[0]) >> height))
    return pd.DataFrame([top], columns=["grp", "pos", "digest", "n"])


def tiers(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The given nodes, then the tops of their blocks, and so on until each group has one node."""
    out = [nodes]
    while out[-1].agg(F.max("n")).first()[0] > 1:
        blocks = out[-1].withColumn("_b", F.shiftright("pos", height)).groupBy("grp", "_b")
        out.append(staged(blocks.applyInPandas(lambda part: _build(part, height), NODES), f"merkle-tier{len(out)}"))
    return out


def _with_ways(nodes: pd.DataFrame, above: pd.DataFrame, height: int):
    """A block's tree and, for each of its nodes, (row, siblings, sides, subroot), by position."""
    nodes = nodes.sort_values("pos")
    tree = _tree(nodes, height)
    rest, turns, subroot = list(above["siblings"].iloc[0]), above["sides"].iloc[0], above["subroot"].iloc[0]

    def ways():
        for i, row in enumerate(nodes.itertuples(index=False)):
            siblings, sides = tree.way(i)
            yield row, siblings + rest, sides + turns, subroot

    return tree, rest, turns, ways()


def _ways(nodes: pd.DataFrame, above: pd.DataFrame, height: int) -> pd.DataFrame:
    *_, ways = _with_ways(nodes, above, height)
    return pd.DataFrame([(r.grp, r.pos, siblings, sides, subroot) for r, siblings, sides, subroot in ways],
                        columns=["grp", "pos", "siblings", "sides", "subroot"])


def _proofs(nodes: pd.DataFrame, above: pd.DataFrame, height: int) -> pd.DataFrame:
    """Proofs of a block's leaves; a leaf with a ``new_leaf`` also gets the copies of its version."""
    tree, rest, turns, ways = _with_ways(nodes, above, height)
    out = []
    for i, (r, siblings, sides, subroot) in enumerate(ways):
        copies = None
        if r.new_leaf is None:
            folded = [r.digest, *climb(r.digest, siblings, sides)][-1]
        else:
            copied = [tree.digests[c] for c in tree.version(i, r.new_leaf)]
            copies = [*copied, *climb(copied[-1], rest, turns)][1:]
            folded = copies[-1] if copies else r.new_leaf
        out.append((r.grp, r.pos, r.key, r.digest, subroot, siblings, sides, r.new_leaf, copies, folded))
    return pd.DataFrame(out, columns=["grp", "pos", "key", "leaf", "subroot", "siblings", "sides", "new_leaf", "copies", "folded"])


def _down(nodes: DataFrame, above: DataFrame, f: Callable, schema: str, height: int) -> DataFrame:
    """Gives every block of a tier the way of its top."""
    above = above.withColumnRenamed("pos", "_b").groupBy("grp", "_b")
    return (nodes.withColumn("_b", F.shiftright("pos", height)).groupBy("grp", "_b").cogroup(above)
            .applyInPandas(lambda block, top: f(block, top, height), schema))


@dataclass
class Manifest:
    """``proofs`` (grp, pos, key, leaf, subroot, siblings, sides, new_leaf, copies, folded), one row per leaf: the
    siblings from the leaf's level to the root's and their sides; for a tampered leaf its version's ancestors, which
    end with the version's root; folded: the root that the (tampered) leaf and its siblings give. ``root`` is the
    root; ``subroots`` (grp, digest) has a row for each group; ``tiers`` are the tops of the blocks, tier by tier."""

    root: str | None
    subroots: DataFrame
    proofs: DataFrame
    tiers: list[DataFrame]


def manifest(rows: DataFrame, group: str, key: str, leaf: Column, new_leaf: Column, height: int = HEIGHT) -> Manifest:
    """The manifest of a table; ``new_leaf`` is null where a row is not tampered with. An empty table has no root."""
    spark = rows.sparkSession
    leaves = staged(rows.select(F.col(f"`{group}`").cast("string").alias("grp"), F.col(f"`{key}`").cast("bigint").alias("key"),
                                leaf.alias("digest"), new_leaf.alias("new_leaf")), "merkle-leaves")
    if leaves.isEmpty():
        return Manifest(None, spark.createDataFrame([], "grp string, digest string"), spark.createDataFrame([], PROOFS), [])
    placed = staged(numbered(leaves, "grp", ["key", "digest"]).withColumn("key", F.col("key").cast("string")), "merkle-placed")
    up = tiers(placed, height)
    subroots = up[-1].select("grp", "digest")
    # The top tree: the subroots are one group, in the order of their own groups.
    top = numbered(subroots.select(F.lit("").alias("all"), "grp", "digest"), "all", ["grp"])
    top = staged(top.select(F.col("all").alias("grp"), "pos", "digest", "n", F.col("grp").alias("name")), "merkle-top")
    over = tiers(top, height)
    ways = over[-1].select("grp", "pos", F.array().cast("array<string>").alias("siblings"), F.lit("").alias("sides"),
                           F.lit(None).cast("string").alias("subroot"))
    for tier in reversed(over[:-1]):
        ways = staged(_down(tier, ways, _ways, PATHS, height), "merkle-ways")
    ways = (top.join(ways.drop("grp", "subroot"), "pos")
            .select(F.col("name").alias("grp"), F.lit(0).cast("bigint").alias("pos"), "siblings", "sides", F.col("digest").alias("subroot")))
    for tier in reversed(up[1:-1]):
        ways = staged(_down(tier, ways, _ways, PATHS, height), "merkle-ways")
    return Manifest(over[-1].first()["digest"], subroots, _down(placed, ways, _proofs, PROOFS, height), up[1:])

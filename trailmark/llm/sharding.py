"""Sharding by a hierarchical weighted hash tree (region, rack, shard).

Each level draws among the children of the chosen node: child ``c`` of weight ``w``
gets ``-ln(u) / w`` with ``u`` a uniform hash of (key, child label), and the smallest
draw wins, so a child is chosen with probability ``w / sum of weights``.  A draw
depends only on the key, the child and its weight.  Changing one weight therefore
moves rows only into or out of the subtree whose weight changed; the relative
order of all other children stays.

Law kept by ``op2``: ``key``.  The key and the tree alone decide.  ``grown`` hangs a
new shard under a region of its own, so no other node's weight changes and one
more shard takes rows only into itself.  Everything is a DataFrame expression; the
plan is linear in the number of nodes.

Defined cases: a null key is hashed like any other value (all null keys share a
shard); a null text has size 1 and the CRC of no bytes; repeated rows go to the
same shard and get slots of their own; an empty table gives no rows; extra columns
are not carried.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import number_within, stored, table


class Leaf(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


#: Production layout: 2 regions of 2 racks of 2 shards, equal weights.
SHARDS_8 = tuple(Leaf(s // 4, s // 2, s) for s in range(8))
_GRID = 1 << 52


def grown(tree: tuple[Leaf, ...], weight: float = 1.0) -> tuple[Leaf, ...]:
    """The tree with one more shard, as the only shard of a new region and rack."""
    return (*tree, Leaf(max(x.region for x in tree) + 1, max(x.rack for x in tree) + 1,
                        max(x.shard for x in tree) + 1, weight))


def _draw(key: Column, level: str, child: int, weight: float) -> Column:
    u = (F.pmod(F.xxhash64(F.lit(f"{level}/{child}"), key), F.lit(_GRID)) + F.lit(0.5)) / F.lit(float(_GRID))
    return F.struct((-F.log(u) / F.lit(float(weight))).alias("draw"), F.lit(child).alias("child"))


def _choose(key: Column, level: str, weights: dict[int, float]) -> Column:
    draws = [_draw(key, level, c, w) for c, w in sorted(weights.items()) if w > 0]
    return F.least(*draws)["child"] if len(draws) > 1 else draws[0]["child"]


def _descend(key: Column, tree: tuple[Leaf, ...], levels: tuple[str, ...] = ("region", "rack", "shard")) -> Column:
    level, rest = levels[0], levels[1:]
    weights: dict[int, float] = {}
    for leaf in tree:
        weights[getattr(leaf, level)] = weights.get(getattr(leaf, level), 0.0) + leaf.weight
    chosen = _choose(key, level, weights)
    if not rest:
        return chosen
    out: Column | None = None
    for child in sorted(c for c, w in weights.items() if w > 0):
        below = _descend(key, tuple(x for x in tree if getattr(x, level) == child), rest)
        out = F.when(chosen == child, below) if out is None else out.when(chosen == child, below)
    return out


def shard_of(key: Column, tree: tuple[Leaf, ...] = SHARDS_8) -> Column:
    """The shard of ``key``: one draw per level, no shuffle."""
    if not any(x.weight > 0 for x in tree):
        raise ValueError("the tree needs a shard of positive weight")
    return _descend(key, tree)


def shard_documents(docs: DataFrame, tree: tuple[Leaf, ...] = SHARDS_8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``."""
    placed = stored(
        docs.select(
            F.col("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
            F.lit("key").alias("law"),
            shard_of(F.col("doc_id"), tree).cast("int").alias("shard"),
            shard_of(F.col("doc_id"), grown(tree)).cast("int").alias("grown_shard"),
        ),
        "shards",
    )
    return number_within(placed, ["shard"], "slot")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")

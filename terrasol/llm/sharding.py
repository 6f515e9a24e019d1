"""Shards by a hierarchical weighted hash tree.

A tree has regions, racks and shards.  A key descends from level to level: every
child makes a hash draw -ln(u) / weight from the key and its own name, and the least
draw wins, so a child is chosen in proportion to its weight.  Draws do not depend on
siblings: where the weight of a subtree changes, keys move into it or out of it only.

A shard added later keeps its own generation at every level above it.  A child's
generations draw side by side, and a key that follows a generation descends only
among what came with it, so the new shard takes keys into itself and nothing else
moves, wherever in the tree it stands.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrasol.llm.common import Scratch

LAW = "key"
SHARDS = 8
#: Stored rows of one file that are numbered together.
BLOCK = 20_000


class Shard(NamedTuple):
    """A leaf of the tree: where it stands, what it weighs and the generation that brought it."""

    shard: int
    region: str
    rack: str
    weight: float = 1.0
    generation: int = 0


def even_tree(shards: int = SHARDS, per_rack: int = 2, per_region: int = 4) -> list[Shard]:
    """Shards of equal weight, filled rack by rack and region by region."""
    return [Shard(s, f"region{s // per_region}", f"rack{s // per_rack}") for s in range(shards)]


def grown(tree: list[Shard], region: str, rack: str, weight: float = 1.0) -> list[Shard]:
    """The tree with one more shard, numbered and dated after all others."""
    last = max((s.shard for s in tree), default=-1), max((s.generation for s in tree), default=-1)
    return [*tree, Shard(last[0] + 1, region, rack, weight, last[1] + 1)]


def draw(key: Column, name: Column, weight: Column) -> Column:
    """Exponential draw of a child for a key: the least of them falls on a child in proportion to its weight."""
    u = (F.shiftrightunsigned(F.xxhash64(key, name), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(u) / weight


def levels(tree: list[Shard]) -> list[dict[str, list[tuple[str, float]]]]:
    """Per level the children of every node: name and weight of what the generation holds below it.

    A node's name is its path with the generation that a key follows.
    """
    out: list[dict[str, dict[str, float]]] = [{}, {}, {}]
    for s in tree:
        if not s.weight > 0:
            continue  # a shard without weight takes nothing
        path = ["", f"{s.generation}|{s.region}", f"{s.generation}|{s.region}|{s.rack}", f"{s.generation}|{s.region}|{s.rack}|{s.shard}"]
        for k in range(3):
            below = out[k].setdefault(path[k], {})
            below[path[k + 1]] = below.get(path[k + 1], 0.0) + s.weight
    return [{parent: sorted(below.items()) for parent, below in level.items()} for level in out]


def with_shard(rows: DataFrame, key: Column, tree: list[Shard], name: str = "shard") -> DataFrame:
    """All columns of rows and the shard of a key column (null without a shard of positive weight).

    The tree is a parameter of the job and travels in the plan; a row draws only among
    the children of the nodes that it passes.  A column called ``name`` is replaced.
    """
    node = "_node"
    while node in rows.columns:
        node += "_"
    out = rows.withColumn(node, F.lit(""))
    for level in levels(tree):  # one column after the other, so that no draw is made twice
        choice = F.lit(None).cast("string")
        for parent, below in sorted(level.items(), reverse=True):
            children = F.array(*(F.struct(F.lit(child).alias("name"), F.lit(float(weight)).alias("weight")) for child, weight in below))
            least = F.array_min(F.transform(children, lambda c: F.struct(draw(key, c["name"], c["weight"]), c["name"].alias("name"))))["name"]
            choice = F.when(F.col(node) == parent, least).otherwise(choice)
        out = out.withColumn(node, choice)
    return out.withColumn(name, F.element_at(F.split(node, r"\|"), -1).cast("int")).drop(node)


def shard_documents(docs: DataFrame, tree: list[Shard] | None = None, more: list[Shard] | None = None, key: str = "doc_id") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    The text of the key column alone decides the shard, so rows with a null key share one
    shard, as rows that repeat a key do.  ``size`` is the text's UTF-8 bytes plus 1
    (null text: 1; its checksum is that of the empty text).  ``slot`` numbers a shard's
    rows without gaps from 0 in the order of the stored rows: rows alike in everything
    have slots of their own and no group is ranked as a whole.  An empty table gives an
    empty result; other columns are not read.
    """
    tree = tree or even_tree()
    raw = F.coalesce("text", F.lit("")).cast("binary")
    keyed = docs.select("doc_id", F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"),
                        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    out = with_shard(keyed, F.col("_key"), tree)
    out = with_shard(out, F.col("_key"), more, "grown_shard") if more else out.withColumn("grown_shard", F.lit(None).cast("int"))
    out = out.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "grown_shard")
    # a stored row has a place of its own: its file and its number there
    stored = Scratch(docs.sparkSession, "sharding").save(out, "rows")
    rows = stored.select("*", F.xxhash64(F.col("_metadata.file_path")).alias("_file"), F.col("_metadata.row_index").alias("_row"))
    rows = rows.withColumn("_block", F.floor(F.col("_row") / BLOCK))
    blocks = ["_file", "_block"]
    counts = rows.groupBy("shard", *blocks).agg(F.count(F.lit(1)).alias("_n"))
    ahead = F.sum("_n").over(Window.partitionBy("shard").orderBy(*blocks).rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("shard", *blocks, F.coalesce(ahead, F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("shard", *blocks).orderBy("_row")) - 1
    ranked = rows.withColumn("_own", own).join(starts, ["shard", *blocks])
    return ranked.select("doc_id", "size", "text_crc32", "law", "shard", (F.col("_start") + F.col("_own")).cast("long").alias("slot"), "grown_shard")

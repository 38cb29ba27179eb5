"""Merkle manifest of a table: digests, proofs and their verification, by nested intervals.

Every node of a tree is labelled by the interval of leaf ranks that it covers: a leaf ``[r, r+1)``,
a node of level h ``[i * 2^h, min((i+1) * 2^h, n))``. Containment of intervals is ancestry, and what a
parent's interval holds besides a node's own is the node's sibling, so no pointers are kept.

Levels are handled in bands of ``BAND``. The nodes of a band that share an interval of ``2^BAND``
nodes form a block, a row of bounded size, so a tree of n leaves takes ``log2(n) / BAND`` shuffles,
each a ``2^BAND``-th of the one before. Going up, a block gives the node over it. Going down, a
block's ancestors come by a join on (tree, interval of the band above), and each node of the block
gets its siblings inside the block, found by interval difference, and those of its ancestors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from callsift.session import written

BAND = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = "*"  # the tree over the subroots; other trees are "-" (null) or "=" and the value


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def ranked(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds ``rank`` (from 0) and ``n`` of each group; a group of any size is spread over tasks.

    Rows are sorted by ranges; rows of a group in earlier ranges are counted, not shuffled again.
    Rows that are alike in ``order`` are told apart by their place in the input, so that many
    copies do not meet in one task.
    """
    placed = rows.withColumn("_at", F.monotonically_increasing_id())
    by = [group, *order, "_at"]
    ordered = placed.repartitionByRange(*by).sortWithinPartitions(*by).drop("_at")
    ordered = written(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    counts = ordered.groupBy(group, part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_c")
    )  # a row for each range and group in it
    whole = Window.partitionBy(group)
    before = F.sum("_c").over(whole.orderBy("_part")) - F.col("_c")
    counts = counts.select(group, "_part", "_first", before.alias("_before"), F.sum("_c").over(whole).alias("n"))
    return (
        ordered.withColumn("_part", part)
        .join(counts, [group, "_part"])
        .withColumn("rank", F.col("_before") + F.col("_at") - F.col("_first"))
        .drop("_part", "_first", "_before", "_at")
    )


def _interval(at: int, size: int, n: int) -> tuple[int, int]:
    low = at // size * size
    return low, min(low + size, n)


class Block:
    """The nodes of one block: ``nodes[level][interval]`` is a digest."""

    def __init__(self, low: int, n: int, digests: list[str]) -> None:
        self.low, self.n = low, n
        self.nodes = [{(low + i, low + i + 1): d for i, d in enumerate(digests)}]
        row, whole = digests, n <= 1 << BAND
        while len(row) > 1 if whole else len(self.nodes) <= BAND:
            row = [digest(*row[i : i + 2]) for i in range(0, len(row), 2)]
            size = 1 << len(self.nodes)
            self.nodes.append({_interval(low + i * size, size, n): d for i, d in enumerate(row)})
        self.top = row[0]

    def path(self, rank: int) -> tuple[str, str]:
        """A node's siblings level by level, and on which side each stands: ``<``, ``>``, or ``.`` for
        none. A sibling's interval is what the parent's has besides the node's own."""
        digests, sides = [], []
        for height in range(len(self.nodes) - 1):
            low, high = _interval(rank, 1 << height, self.n)
            over_low, over_high = _interval(rank, 2 << height, self.n)
            if over_low < low:
                sides.append("<")
                digests.append(self.nodes[height][over_low, low])
            elif high < over_high:
                sides.append(">")
                digests.append(self.nodes[height][high, over_high])
            else:
                sides.append(".")
        return "".join(digests), "".join(sides)


def fold(digest_: str, siblings: str, sides: str) -> str:
    """The root that a leaf and its siblings give."""
    at = 0
    for side in sides:
        if side == ".":
            digest_ = digest(digest_)
        else:
            other = siblings[at : at + 64]
            at += 64
            digest_ = digest(other, digest_) if side == "<" else digest(digest_, other)
    return digest_


def _blocks(nodes: DataFrame, members: Sequence[str]) -> DataFrame:
    """``(tree, low, high, n, members)``: blocks of a band; ``low``, ``high`` and ``n`` count its nodes.
    A block's number follows from its nodes' ranks, and it has ``2^BAND`` of them at most."""
    low = F.shiftleft(F.shiftright("rank", BAND), BAND)
    return (
        nodes.groupBy("tree", low.alias("low"))
        .agg(
            F.first("n").alias("n"),
            F.sort_array(F.collect_list(F.struct("rank", "digest", *members))).alias("members"),
        )
        .withColumn("high", F.col("low") + F.size("members"))
    )


def _mapped(rows: DataFrame, give: Callable[[dict], list[tuple]], schema: StructType) -> DataFrame:
    """Each block to the rows that ``give`` makes of it."""
    types, names = [to_arrow_type(f.dataType) for f in schema], schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                columns = zip(*give(batch.slice(k, 1).to_pylist()[0]), strict=True)
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(run, schema)



def _tops(blocks: DataFrame) -> DataFrame:
    """The node over each block, ``(tree, rank, n, digest)`` in the band above; ``n`` counts its nodes."""

    def give(r: dict) -> list[tuple]:
        return [(r["tree"], r["low"] >> BAND, -(-r["n"] >> BAND), Block(r["low"], r["n"], r["digests"]).top)]

    schema = StructType.fromDDL("tree string, rank long, n long, digest string")
    return _mapped(blocks.select("tree", "low", "n", _digests().alias("digests")), give, schema)


def _digests() -> Column:
    return F.transform("members", lambda m: m["digest"])


def _up(leaves: DataFrame, members: Sequence[str] = ()) -> tuple[list[DataFrame], list[DataFrame]]:
    """The blocks of every band, the lowest first, until each tree is one block; and, by band, the
    roots ``(tree, digest)`` of the trees that end there."""
    bands, roots, nodes = [], [], leaves
    while True:
        bands.append(written(_blocks(nodes, members if not bands else ()), "blocks"))
        over = written(_tops(bands[-1]), "nodes")
        alone = F.col("n") == 1
        roots.append(over.where(alone).select("tree", "digest"))
        nodes = over.where(~alone)
        if nodes.isEmpty():
            return bands, roots


_PATH = "siblings string, sides string, subroot string, root string"


def _under(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks with the path of the node over them: its interval is the block's, so the two meet by
    tree and by the interval's number in the band above."""
    over = above.select("tree", F.col("rank").alias("_over"), "siblings", "sides", "subroot", "root")
    return blocks.withColumn("_over", F.shiftright("low", BAND)).join(over, ["tree", "_over"]).drop("_over")


def _paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """``(tree, rank, path)`` of every node in a band from the paths of the nodes over its blocks."""

    def give(r: dict) -> list[tuple]:
        block, out = Block(r["low"], r["n"], r["digests"]), []
        for rank in range(r["low"], r["high"]):
            siblings, sides = block.path(rank)
            out.append((r["tree"], rank, siblings + r["siblings"], sides + r["sides"], r["subroot"], r["root"]))
        return out

    rows = _under(blocks.select("tree", "low", "high", "n", _digests().alias("digests")), above)
    return _mapped(rows, give, StructType.fromDDL(f"tree string, rank long, {_PATH}"))


def _down(bands: list[DataFrame], ends: list[DataFrame]) -> DataFrame:
    """Paths of the nodes over the blocks of the lowest band; ``ends`` has, by band, the paths above
    the roots of the trees that end there."""
    above = ends[-1]
    for blocks, end in zip(bands[:0:-1], ends[-2::-1], strict=True):
        above = written(_paths(blocks, above), "paths").unionByName(end)
    return above


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "lang",
    fields: Sequence[str] = FIELDS,
    claimed: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Every row's leaf digest, its proof, and whether a claimed version of it folds to the root.

    Returns ``(key, leaf, siblings, sides, subroot, root, folded_root, verified)``. A leaf is the
    digest of the row's ``fields``, null as ``-``, so null and empty differ. The leaves of a
    ``group`` (null is one too) form a tree by ascending key, null first; repeated keys go by leaf,
    and rows alike in both may stand in either order. Two neighbours make a node, the last may be
    alone; a lone leaf is its own subroot. Subroots, by group bytewise with null first, form the
    tree above. ``siblings`` joins the digests that a proof needs from the leaf up, ``sides`` tells
    where each stands. ``claimed`` gives columns that a reader claims to hold instead: the leaf is
    made of them, folded with the original siblings, and verified if that gives the root. An empty
    table gives no rows. Other columns are not read. Memory: a block of ``2^BAND`` nodes per task.
    """
    value = {c: F.col(c) for c in fields}
    own, other = leaf(list(value.values())), leaf(list((value | dict(claimed or {})).values()))
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    rows = docs.select(tree.alias("tree"), F.col(key).alias("key"), own.alias("digest"), other.alias("claimed"))
    rows = rows.withColumn("claimed", F.nullif("claimed", "digest"))
    bands, roots = _up(ranked(rows, "tree", ["key", "digest"]), ["key", "claimed"])

    subroots = written(reduce(DataFrame.unionByName, roots), "subroots")
    tops = ranked(subroots.select(F.lit(TOP).alias("tree"), "digest", F.col("tree").alias("key")), "tree", ["key"])
    top_bands, top_roots = _up(tops, ["key"])
    root = reduce(DataFrame.unionByName, top_roots).select(
        "tree", F.lit(0).cast("long").alias("rank"), F.lit("").alias("siblings"), F.lit("").alias("sides"),
        F.lit("").alias("subroot"), F.col("digest").alias("root"),
    )
    nothing = root.where(F.lit(False))
    above = _down(top_bands, [nothing] * (len(top_bands) - 1) + [root])

    def lead(r: dict) -> list[tuple]:
        block, out = Block(r["low"], r["n"], [m["digest"] for m in r["members"]]), []
        for m in r["members"]:
            siblings, sides = block.path(m["rank"])
            out.append((m["key"], 0, siblings + r["siblings"], sides + r["sides"], m["digest"], r["root"]))
        return out

    over_trees = written(
        _mapped(
            _under(top_bands[0], above).select("low", "n", "members", "siblings", "sides", "root"),
            lead,
            StructType.fromDDL(f"tree string, rank long, {_PATH}"),
        ),
        "over-trees",
    )
    ends = [over_trees.join(r.select("tree"), "tree", "left_semi") for r in roots]
    above = _down(bands, ends)

    def prove(r: dict) -> list[tuple]:
        block, out = Block(r["low"], r["n"], [m["digest"] for m in r["members"]]), []
        for m in r["members"]:
            siblings, sides = block.path(m["rank"])
            siblings, sides = siblings + r["siblings"], sides + r["sides"]
            folded = fold(m["claimed"] or m["digest"], siblings, sides)
            out.append(
                (m["key"], m["digest"], siblings, sides, r["subroot"], r["root"], folded, folded == r["root"])
            )
        return out

    result = StructType.fromDDL(f"leaf string, {_PATH}, folded_root string, verified boolean")
    schema = StructType([StructField(key, docs.schema[key].dataType), *result])
    return _mapped(
        _under(bands[0], above).select("low", "n", "members", "siblings", "sides", "subroot", "root"), prove, schema
    )

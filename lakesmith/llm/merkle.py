"""Merkle dataset manifest: a hash tree of 8 children a node over each group's rows, and one over the groups.

A leaf is the hash of a row's fields. Rows are range partitioned by (group, id), so that a row's place in its
group is the slice's offset plus its number there. Of each level, windows over blocks of whole runs give
every node fixed-offset lag and lead columns: those that its slot in its run and the run's length allow are its
siblings, and the first child of a run hashes the parent. A level has an eighth of the rows of the
one below. The way back is a join a level on (group, parent's place): a node's path is its own siblings
and its parent's path, so that each row ends with what its proof needs and folds it up.

Digests are 32 bytes inside; a hash takes them as lowercase hex text, as the leaves' fields are text.

Defined results: a null field counts as ``-``, any other as its UTF-8 byte count, ``:`` and the value. Null groups are a
group of their own, the first; null ids come before all others of their group. Rows with equal ids are ordered by
leaf, so repeated rows are neighbours and exchangeable. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lowered, staged
from .ranges import dealt, numbered, slice_count

#: Fixed value: children of a node.
ARITY = 8
#: Nodes of a window group, a multiple of ARITY: whole runs, so that no sibling is outside.
BLOCK = ARITY**4
#: The fields of a leaf of ``documents``, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before: binary, after: binary>>"


def counted(value: Column) -> Column:
    """A leaf's field: byte count, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def row_hash(fields: Sequence[Column]) -> Column:
    """The leaf of a row, as bytes."""
    return F.unhex(F.sha2(F.concat(*[counted(c) for c in fields]), 256))


def as_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def node_hash(digests: Column) -> Column:
    """The hash of concatenated digests, which it takes as hex text."""
    return F.unhex(F.sha2(as_text(digests), 256))


def with_siblings(nodes: DataFrame, group: str) -> DataFrame:
    """``nodes`` (group, n, pos, digest) with the digests of their runs' others, ``before`` and ``after`` them."""
    run = Window.partitionBy(group, F.floor(F.col("pos") / BLOCK)).orderBy("pos")
    slot = F.col("pos") % ARITY
    length = F.least(F.lit(ARITY), F.col("n") - F.col("pos") + slot)
    none = F.lit(b"")
    before = [F.when(slot >= k, F.lag("digest", k).over(run)).otherwise(none) for k in range(ARITY - 1, 0, -1)]
    after = [F.when(slot + k < length, F.lead("digest", k).over(run)).otherwise(none) for k in range(1, ARITY)]
    return nodes.select("*", F.concat(*before).alias("before"), F.concat(*after).alias("after"))


def parents(nodes: DataFrame, group: str) -> DataFrame:
    """The next level: first children hash their run. A tree that is down to one node keeps it."""
    digest = F.when(F.col("n") > 1, node_hash(F.concat("digest", "after"))).otherwise(F.col("digest"))
    up = nodes.where(F.col("pos") % ARITY == 0)
    return up.select(group, F.ceil(F.col("n") / ARITY).alias("n"), F.floor(F.col("pos") / ARITY).alias("pos"), digest.alias("digest"))


def levels(nodes: DataFrame, group: str, largest: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Every level's nodes with their siblings, written, lowest first; then the roots. ``largest``: rows of the largest tree."""
    found = []
    while largest > 1:
        found.append(staged(with_siblings(nodes, group), f"{name}-{len(found)}"))
        nodes, largest = parents(found[-1], group), -(-largest // ARITY)
    return found, nodes


def with_paths(found: list[DataFrame], tops: DataFrame, group: str, keep: Sequence[str]) -> DataFrame:
    """The lowest level's nodes with the ``path`` of each to the top; ``tops`` has the roots' own paths and ``keep``."""
    above = tops
    for nodes in reversed(found):
        own = F.array(F.struct("before", "after")).cast(PATH)
        above = above.select(F.col(group).alias("__group"), F.col("pos").alias("__pos"), F.col("path").alias("__path"), *keep)
        met = nodes.join(above, (F.col(group) == F.col("__group")) & (F.floor(F.col("pos") / ARITY) == F.col("__pos")))
        above = met.withColumn("path", F.when(F.col("n") > 1, F.concat(own, "__path")).otherwise(F.col("__path"))).drop("__group", "__pos", "__path", "before", "after")
    return above


def manifest(docs: DataFrame, claims: Sequence[Column] | None = None, fields: Sequence[str] = FIELDS, id_column: str = "doc_id", group_column: str = "lang") -> DataFrame:
    """Of every row: its id, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``claims`` are the fields as somebody gives them now, null where the row's own are meant: their leaf is folded with the row's
    original siblings to ``folded_root``, and ``verified`` says whether that is the root.
    """
    leaf = row_hash([F.col(c) for c in fields])
    claim = leaf if claims is None else F.coalesce(row_hash(claims), leaf)
    rows = docs.select(F.col(id_column).alias("id"), F.col(group_column).alias("group"), leaf.alias("digest"), claim.alias("claim"))
    rows = staged(rows, "merkle-rows")  # the range partitioning reads its input twice: the texts are hashed once
    rows = dealt(rows, [F.col("group"), F.col("id"), F.col("digest")], slice_count(docs, 0.25), "merkle-leaves")

    # one row for each slice and group that meet; a group's slices are neighbours
    bounds = staged(rows.groupBy("part", "group").agg(F.min("at").alias("first"), F.count("*").alias("rows")), "merkle-bounds")
    groups = bounds.groupBy("group").agg(F.sum("rows").alias("n"))
    groups = staged(numbered(groups, [F.col("group")], slice_count(groups), "merkle-groups").withColumnRenamed("pos", "tree"), "merkle-trees")
    size = groups.agg(F.max("n"), F.count("*")).first()
    earlier = F.coalesce(F.sum("rows").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bounds = bounds.withColumnRenamed("group", "of").join(groups, F.col("of").eqNullSafe(F.col("group"))).select(F.col("part").alias("in"), "of", "tree", "n", (earlier - F.col("first")).alias("shift"))
    leaves = rows.join(bounds, (F.col("part") == F.col("in")) & F.col("group").eqNullSafe(F.col("of")))
    leaves = leaves.select("tree", "n", (F.col("at") + F.col("shift")).alias("pos"), "digest", "claim", "id")

    found, tops = levels(leaves, "tree", size[0] or 0, "merkle-level")
    tops = staged(tops.select("tree", "digest"), "merkle-subroots")
    forest = tops.select(F.lit(0).alias("forest"), F.lit(size[1]).cast("long").alias("n"), F.col("tree").alias("pos"), "digest")
    over, root = levels(forest, "forest", size[1], "merkle-over")
    root = root.select("forest", "pos", F.lit(None).cast(PATH).alias("path"), F.col("digest").alias("root")).withColumn("path", F.array().cast(PATH))
    subroots = forest.join(root.drop("pos"), "forest") if not over else with_paths(over, root, "forest", ["root"])
    subroots = subroots.select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"), "root")
    if found:
        proved = with_paths(found, subroots, "tree", ["subroot", "root"])
    else:
        proved = leaves.join(subroots.drop("pos"), "tree")

    folded = F.aggregate("path", F.col("claim"), lambda own, level: node_hash(F.concat(level["before"], own, level["after"])))
    proof = F.sha2(F.array_join(F.transform("path", lambda level: as_text(F.concat(level["before"], level["after"]))), ""), 256)
    hexed = [as_text(F.col(c)).alias(name) for c, name in (("digest", "leaf"), ("subroot", "subroot"), ("root", "root"))]
    out = proved.select(F.col("id").alias(id_column), *hexed, proof.alias("proof_sha256"), as_text(folded).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered_claims(docs: DataFrame, id_column: str = "doc_id", fields: Sequence[str] = FIELDS, text_column: str = "text", one_in: int = 3) -> list[Column]:
    """Claims that lower-case A-Z of the texts where ``one_in`` divides the crc32 of the id as text; elsewhere the row's own."""
    chosen = F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % one_in == 0, F.lit(False))
    return [F.when(chosen, ascii_lowered(F.col(c))).otherwise(F.col(c)) if c == text_column else F.col(c) for c in fields]

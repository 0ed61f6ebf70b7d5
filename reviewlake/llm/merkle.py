"""A manifest of a dataset as a persistent Merkle tree, and the versions that changed records make of it.

Each record is a leaf; leaves of one group (``lang``) form a tree in which every ``FAN`` consecutive nodes have
one parent, and the roots of the groups form one more tree in the same way. The tree is kept in aligned blocks of
``FAN ** LEVELS`` nodes: a task builds one block from its lowest nodes, the blocks' roots are the lowest nodes of
the next round, and so on, so no task ever holds more than one block. The way from a block up to the root is
computed from the top down, a block at a time, and is one short row per block.

A changed leaf makes a version of the tree. It copies the node of each level above the leaf and shares all others:
first inside its block, then along the block's way upwards, which every version of the block shares.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from reviewlake.llm.texts import ship_package, small_join
from reviewlake.operators.placement import shuffle_width, stage

# Fixed values of the manifest's format: children of a node, and levels of a block.
FAN, LEVELS = 8, 3
BLOCK = FAN**LEVELS
#: Fields of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Hex SHA-256 of the fields: ``-`` for NULL, else the UTF-8 length, a colon and the value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        length = F.octet_length(value).cast("string")
        parts.append(F.when(field.isNull(), F.lit("-")).otherwise(F.concat(length, F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def parent(children: Sequence[bytes]) -> bytes:
    """Digest of a node from its children's, which enter as hex text."""
    return sha256("".join(c.hex() for c in children).encode()).digest()


def grown(nodes: list[bytes], width: int) -> list[list[bytes]]:
    """Levels of a block over its lowest nodes, in a level of ``width`` nodes: up to ``LEVELS`` more, fewer at the top."""
    levels = [nodes]
    while width > 1 and len(levels) <= LEVELS:
        below = levels[-1]
        levels.append([parent(below[i : i + FAN]) for i in range(0, len(below), FAN)])
        width = -(-width // FAN)
    return levels


def width_above(width: int) -> int:
    """Nodes of a level that is one block higher."""
    for _ in range(LEVELS):
        width = -(-width // FAN)
    return width


def siblings(levels: list[list[bytes]], at: int) -> list[tuple[list[bytes], list[bytes]]]:
    """For each level of a block, the nodes left and right of the one over place ``at`` that share its parent."""
    found = []
    for level in levels[:-1]:
        start = at - at % FAN
        found.append((level[start:at], level[at + 1 : start + FAN]))
        at //= FAN
    return found


def pack(way: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    """A way upwards as bytes: per level both counts, then the digests."""
    return b"".join(bytes((len(left), len(right))) + b"".join(left) + b"".join(right) for left, right in way)


def unpack(packed: bytes) -> list[tuple[list[bytes], list[bytes]]]:
    way, at = [], 0
    while at < len(packed):
        left, right = packed[at], packed[at + 1]
        at += 2
        nodes = [packed[at + 32 * i : at + 32 * i + 32] for i in range(left + right)]
        way.append((nodes[:left], nodes[left:]))
        at += 32 * (left + right)
    return way


def copied(digest: bytes, way: list[tuple[list[bytes], list[bytes]]]) -> list[bytes]:
    """The nodes that a version with this leaf copies, from the leaf's parent to the root."""
    path = []
    for left, right in way:
        digest = parent([*left, digest, *right])
        path.append(digest)
    return path


@dataclass(frozen=True)
class Manifest:
    """``leaves`` and their ``ways`` (tree, block, way, subroot), and the ``root`` (None without records).

    ``nodes``: one staged table per round and kind, (tree, pos, digest, width), from the leaves to the top.
    """

    leaves: DataFrame
    ways: DataFrame
    nodes: list[DataFrame]
    root: str | None


def place(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``pos``, the place of a row in its ``tree`` by ``order``, and ``width``, the rows of the tree. Staged.

    Rows are sorted by ranges of (tree, order), so a dominant tree spreads over many tasks; rows that are equal in
    all of these are parted by their place in the input. What is left to add is one count per tree and range.
    """
    keys = ["tree", *order, "_salt"]
    salted = stage(rows.withColumn("_salt", F.monotonically_increasing_id()), "merkle_rows")
    ranged = salted.repartitionByRange(shuffle_width(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    ranged = stage(ranged.withColumn("_at", F.monotonically_increasing_id()), "merkle_ranges")
    part = F.shiftright("_at", 33)
    counted = ranged.groupBy("tree", part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    counted = stage(counted, "merkle_counts")
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counted.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
    shift = stage(shift.withColumn("width", F.sum("_n").over(Window.partitionBy("tree"))).drop("_n", "_first"), "merkle_shifts")
    placed = small_join(ranged.withColumn("_part", part), shift, ["tree", "_part"], "inner")
    return stage(placed.withColumn("pos", F.col("_at") + F.col("_before")).drop("_salt", "_at", "_part", "_before"), "merkle_leaves")


def _block() -> Column:
    return F.floor(F.col("pos") / BLOCK).cast("long").alias("block")


def _roots_of_blocks(nodes: DataFrame) -> DataFrame:
    """(tree, pos, digest, width) one block higher."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("pos")
        width = int(frame["width"].iloc[0])
        top = grown(frame["digest"].tolist(), width)[-1][0]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "digest": [top], "width": [width_above(width)]})

    lowest = nodes.select("tree", "pos", "digest", "width")
    return lowest.groupBy("tree", _block()).applyInPandas(run, "tree string, pos long, digest binary, width long")


def _rise(nodes: DataFrame) -> list[DataFrame]:
    """The lowest nodes of each round; the last table has the root of each tree."""
    tables = [nodes]
    width = nodes.agg(F.max("width")).first()[0]
    while width > 1:
        tables.append(stage(_roots_of_blocks(tables[-1]), "merkle_nodes"))
        width = width_above(width)
    return tables


def _descend(nodes: DataFrame, ways: DataFrame) -> DataFrame:
    """Ways (tree, block, way, subroot) of the blocks over which ``nodes`` lie, from the ways of the next round's blocks."""

    def run(key: tuple, frame: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("pos")
        levels = grown(frame["digest"].tolist(), int(frame["width"].iloc[0]))
        end, subroot = above["way"].iloc[0], above["subroot"].iloc[0]
        made = [pack(siblings(levels, at)) + end for at in range(len(frame))]
        return pd.DataFrame({"tree": key[0], "block": frame["pos"].to_numpy(), "way": made, "subroot": subroot})

    lowest = nodes.select("tree", "pos", "digest", "width")
    cells = lowest.groupBy("tree", _block()).cogroup(ways.groupBy("tree", "block"))
    return stage(cells.applyInPandas(run, "tree string, block long, way binary, subroot binary"), "merkle_ways")


def _ways_down(tables: list[DataFrame], top: DataFrame) -> DataFrame:
    """Ways of the blocks of the lowest round, from ``top``: the ways (tree, block = 0, ...) above the trees' roots."""
    for nodes in reversed(tables[1:]):
        top = _descend(nodes, top)
    return top


def build_manifest(
    documents: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id",
    changed: Mapping[str, Column] | None = None, where: Column | None = None,
) -> Manifest:
    """The tree over all rows: per ``group`` in the order of ``order``, groups by their UTF-8 bytes, NULL first in both.

    ``changed``: new values of fields in the rows that ``where`` holds for; their leaves then carry the digest of
    the changed record, too. Rows of one ``order`` value lie by their digest, so repeated rows are leaves of their
    own and any input order gives the same tree. Empty and very long values are digested whole. Other columns take
    no part, whatever their names. An empty table has no root.
    """
    ship_package(documents.sparkSession)
    digest = F.unhex(leaf_digest([F.col(f) for f in fields]))
    if changed is None:
        other = F.lit(None).cast("binary")
    else:
        new = F.unhex(leaf_digest([changed.get(f, F.col(f)) for f in fields]))
        other = F.when(F.lit(True) if where is None else where, new)
    tree = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    rows = documents.select(
        F.col(order).alias(order), digest.alias("digest"), other.alias("changed"), tree.alias("tree")
    )
    leaves = place(rows, [order, "digest", "changed"])
    if leaves.isEmpty():
        return Manifest(leaves, leaves.sparkSession.createDataFrame([], "tree string, block long, way binary, subroot binary"), [leaves], None)
    trees = _rise(leaves)
    subroots = trees[-1].select(F.col("tree").alias("name"), "digest", F.lit("").alias("tree"))
    tops = place(subroots, ["name"])
    upper = _rise(tops)
    root = bytes(upper[-1].first()["digest"])
    empty_way = upper[-1].select("tree", F.lit(0).cast("long").alias("block"), F.lit(b"").alias("way"), F.lit(b"").alias("subroot"))
    ways = _ways_down(upper, empty_way)
    ways = _leaves_of(tops, ways)
    return Manifest(leaves, _ways_down(trees, ways), [*trees, *upper], root.hex())


def _leaves_of(tops: DataFrame, ways: DataFrame) -> DataFrame:
    """Ways above the root of each group's tree, from the ways of the blocks in which these roots lie."""

    def run(key: tuple, frame: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("pos")
        levels = grown(frame["digest"].tolist(), int(frame["width"].iloc[0]))
        made = [pack(siblings(levels, at)) + above["way"].iloc[0] for at in range(len(frame))]
        return pd.DataFrame({"tree": frame["name"], "block": 0, "way": made, "subroot": frame["digest"]})

    cells = tops.groupBy("tree", _block()).cogroup(ways.groupBy("tree", "block"))
    return stage(cells.applyInPandas(run, "tree string, block long, way binary, subroot binary"), "merkle_ways")


def prove(manifest: Manifest, order: str = "doc_id") -> DataFrame:
    """Per leaf: (order, leaf, subroot, proof, changed, copies) in hex; the proof is all siblings up to the root as one text.

    ``copies`` are the nodes that the leaf's version copies, the new root last; an unchanged leaf's version gives
    the old nodes again. A tree of one record copies nothing.
    """
    kind = manifest.leaves.schema[order].dataType.simpleString()

    def run(key: tuple, frame: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("pos")
        nodes = frame["digest"].tolist()
        levels = grown(nodes, int(frame["width"].iloc[0]))
        way = unpack(above["way"].iloc[0])
        subroot = above["subroot"].iloc[0].hex()
        shared = "".join(x.hex() for left, right in way for x in (*left, *right))
        proofs, copies = [], []
        for at, (leaf, other) in enumerate(zip(nodes, frame["changed"])):
            inside = siblings(levels, at)
            proofs.append("".join(x.hex() for left, right in inside for x in (*left, *right)) + shared)
            copies.append([x.hex() for x in copied(leaf if other is None else other, [*inside, *way])])
        return pd.DataFrame(
            {
                order: frame[order],
                "leaf": [x.hex() for x in nodes],
                "subroot": subroot,
                "proof": proofs,
                "changed": [None if x is None else x.hex() for x in frame["changed"]],
                "copies": copies,
            }
        )

    leaves = manifest.leaves.select("tree", "pos", "digest", "width", order, "changed")
    cells = leaves.groupBy("tree", _block()).cogroup(manifest.ways.groupBy("tree", "block"))
    return cells.applyInPandas(
        run, f"`{order}` {kind}, leaf string, subroot string, proof string, changed string, copies array<string>"
    )


def digest_manifest(documents: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row, with a third of the texts lower-cased.

    ``folded_root`` is the root of the version that the row's changed leaf makes. A change that leaves the text as it
    was still verifies. A row without doc_id is a leaf like others and is not changed.
    """
    spark: SparkSession = documents.sparkSession
    typed = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(c) for c in ("source", "lang")),
        F.col("n_chars").cast("long").alias("n_chars"), F.col("text").cast("string").alias("text"),
    )
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    manifest = build_manifest(typed, changed={"text": low}, where=third)
    if manifest.root is None:
        return spark.createDataFrame(
            [], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        )
    folded = F.when(F.size("copies") > 0, F.element_at("copies", -1)).otherwise(F.coalesce("changed", "leaf"))
    return prove(manifest).select(
        "doc_id", "leaf", "subroot", F.lit(manifest.root).alias("root"),
        F.sha2(F.col("proof"), 256).alias("proof_sha256"), folded.alias("folded_root"), (folded == manifest.root).alias("verified"),
    )


def _sql_field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SQL_LEAF = " || ".join(_sql_field(f) for f in FIELDS)
_SQL_CHANGED = _SQL_LEAF.replace("text::", f"translate(text, '{_UPPER}', '{_LOWER}')::")
#: crc32 bit by bit over the digits of doc_id.
_SQL_CRC = """
xor(list_reduce([ascii(c) for c in string_split(doc_id::VARCHAR, '')], lambda crc, byte:
  list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda r, i: xor(r >> 1, 3988292384 * (r & 1)), xor(crc, byte)::BIGINT), 4294967295::BIGINT), 4294967295)
"""

#: All levels by recursion, siblings by a join on the parent, each version folded level by level.
SQL = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, lang, sha256({_SQL_LEAF}) AS leaf,
    CASE WHEN {_SQL_CRC} % 3 = 0 THEN sha256({_SQL_CHANGED}) END AS changed
  FROM documents
), placed AS MATERIALIZED (
  SELECT row_number() OVER () AS r, *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n
  FROM leaf
), nodes(lang, level, pos, n, digest) AS (
  SELECT lang, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 8, (max(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 8
), tops AS MATERIALIZED (
  SELECT lang, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, digest FROM nodes WHERE n = 1
), upper_nodes(level, pos, n, digest) AS (
  SELECT 0, pos, n, digest FROM tops
  UNION ALL
  SELECT level + 1, pos // 8, (max(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 8
), steps AS MATERIALIZED (
  SELECT p.r, x.level, x.pos, x.digest, x.pos = p.pos // (8 ** x.level)::BIGINT AS own
  FROM placed p JOIN nodes x ON x.lang IS NOT DISTINCT FROM p.lang AND x.n > 1
    AND x.pos // 8 = p.pos // (8 ** (x.level + 1))::BIGINT
  UNION ALL
  SELECT p.r, t.height + x.level, x.pos, x.digest, x.pos = t.pos // (8 ** x.level)::BIGINT
  FROM placed p JOIN tops t ON t.lang IS NOT DISTINCT FROM p.lang
  JOIN upper_nodes x ON x.n > 1 AND x.pos // 8 = t.pos // (8 ** (x.level + 1))::BIGINT
), proofs AS (
  SELECT r, string_agg(digest, '' ORDER BY level, pos) AS proof FROM steps WHERE NOT own GROUP BY r
), folds(r, level, digest) AS (
  SELECT r, 0, coalesce(changed, leaf) FROM placed
  UNION ALL
  SELECT f.r, f.level + 1, sha256(string_agg(CASE WHEN s.own THEN f.digest ELSE s.digest END, '' ORDER BY s.pos))
  FROM folds f JOIN steps s ON s.r = f.r AND s.level = f.level GROUP BY f.r, f.level
), folded AS (SELECT r, arg_max(digest, level) AS digest FROM folds GROUP BY r)
SELECT p.doc_id, p.leaf, t.digest AS subroot, u.digest AS root, sha256(coalesce(q.proof, '')) AS proof_sha256,
  f.digest AS folded_root, f.digest = u.digest AS verified
FROM placed p JOIN tops t ON t.lang IS NOT DISTINCT FROM p.lang JOIN folded f USING (r) LEFT JOIN proofs q USING (r)
CROSS JOIN (SELECT digest FROM upper_nodes WHERE n = 1) u
"""

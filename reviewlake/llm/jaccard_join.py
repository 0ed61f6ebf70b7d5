"""Exact self-join of documents on the Jaccard similarity of word n-gram sets, with set-relation skipping.

Two ideas carry the join. Lists of an inverted index are cut into blocks of one set size and ordered by
the position of the shingle in its set, so that the size bound skips whole blocks and the position bound
skips the rest of a block. And sets that are equal or highly similar to one already answered get
their answer from it: equal sets are one class; in a long list every class is first compared with the few
most central ones. What these connect is a group, whose sets are kept as differences to one leader: two sets
share as much as their differences tell, so all links of a group are counted in cells of bounded size
without a row per pair. Sets of different groups are compared unless their overlaps with a common leader
prove that they cannot be similar. Links and their numbers are those of the whole join.

Order of shingles, the same in all sets: shingles of a fixed low part of the hash space by hash,
frequent ones of that part behind them, then all others by hash. Every shingle that can reach a prefix is
counted over all documents, so long lists are known beforehand.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from reviewlake.llm.components import components
from reviewlake.llm.texts import long_column, shingle_sets, ship_package, slices, small_join, text_column
from reviewlake.operators.placement import stage

#: Part of the hash space whose shingles are counted and come first.
LOW_PART = 0.25
#: Lists of as many classes are long; at most so many frequent shingles are told to every task.
LONG_LIST, MOST_FREQUENT = 32, 500_000
#: Sets that each long list is compared with first.
LEADERS = 2
#: Classes of a long list that one cell of it takes at most, about; a cell meets every other one of its list.
CELL = 256
#: Sets of a group, and shingles of their differences, that one part of it holds at most, about; a cell compares two parts.
GROUP_PART, GROUP_SHINGLES = 512, 1 << 20
#: Different shingles whose columns a cell multiplies at once.
COLUMNS = 2048
#: Classes a task remembers in order not to send a copy's shingles again.
REMEMBERED = 500_000


def least_overlap(size: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set of ``size`` shares at least with any set similar to it."""
    return -(-percent * size // 100)


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    return size - least_overlap(size, percent) + 1


def _bound(low_part: float) -> np.uint64:
    return np.uint64(min(int(low_part * 2**64), 2**64 - 1))


def _fingerprint(n: int, percent: int, low_part: float):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("cls", pa.int64()), ("shingles", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text", 8 << 20):
            sizes, classes, kept = [], [], []
            for doc_id, found in zip(text_column(batch, "doc_id"), shingle_sets(text_column(batch, "text"), n)):
                cls = xxhash.xxh3_64_intdigest(found.tobytes()) if len(found) else 0
                sizes.append(len(found))
                classes.append(cls)
                if cls in seen or not len(found) or doc_id is None:
                    kept.append(None)
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(cls)
                count = max(int(np.searchsorted(found, _bound(low_part), side="right")), int(prefix_length(len(found), percent)))
                kept.append(found[:count].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.array(classes, np.uint64).view(np.int64)),
                    pa.array(kept, pa.list_(pa.int64())),
                ],
                schema=schema,
            )

    return run


def _prefixes(percent: int, low_part: float, frequent):
    """Entries (shingle, cls, size, pos, frequent) of each set's prefix in the common order."""
    schema = pa.schema(
        [("shingle", pa.int64()), ("cls", pa.int64()), ("size", pa.int32()), ("pos", pa.int32()), ("frequent", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight = frequent.value
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("shingles"))
            if isinstance(lists, pa.ChunkedArray):
                lists = lists.combine_chunks()
            counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            shingles = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(shingles):
                continue
            size, cls = long_column(batch, "n_shingles"), long_column(batch, "cls")
            row = np.repeat(np.arange(len(counts)), counts)
            at = np.minimum(np.searchsorted(known, shingles), max(len(known) - 1, 0))
            often = known[at] == shingles if len(known) else np.zeros(len(shingles), bool)
            rank = np.where(often, weight[at], 0) if len(known) else np.zeros(len(shingles), np.int64)
            low = shingles <= _bound(low_part)
            # inside a row the shingles are sorted by hash already, low ones first: a stable sort keeps that
            order = np.argsort(row * 128 + np.where(low, rank, 127), kind="stable")
            pos = np.arange(len(shingles)) - np.repeat(np.cumsum(counts) - counts, counts)
            take = pos < prefix_length(size, percent)[row]
            order, row, pos = order[take], row[take], pos[take]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shingles[order].view(np.int64)),
                    pa.array(cls[row]),
                    pa.array(size[row].astype(np.int32)),
                    pa.array(pos.astype(np.int32)),
                    pa.array(often[order]),
                ],
                schema=schema,
            )

    return run


PAIRS = "a_cls long, a_size int, b_cls long, b_size int"
_PAIRS = pa.schema([("a_cls", pa.int64()), ("a_size", pa.int32()), ("b_cls", pa.int64()), ("b_size", pa.int32())])


def _list_pairs(cls, size, pos, percent, side=None, group=None):
    """Index pairs of one list (sorted by size, then position) that size and position allow.

    A block holds the entries of one size in order of position. For an entry, blocks beyond the size
    bound are skipped whole, and inside a block all behind the last position that still allows the
    overlap. ``side``: parts of a cell; pairs inside one are left out, unless it is negative. ``group``: pairs
    inside one are left out.
    """
    left, right = [], []
    starts = np.flatnonzero(np.r_[True, size[1:] != size[:-1]])
    stops = np.r_[starts[1:], len(size)]
    for own in range(len(starts)):
        n = int(size[starts[own]])
        mine = np.arange(starts[own], stops[own])
        for block in range(own, len(starts)):
            m = int(size[starts[block]])
            if 100 * n < percent * m:
                break
            need = -(-percent * (n + m) // (100 + percent))
            fit = mine[n - pos[mine] >= need]
            stop = starts[block] + int(np.searchsorted(pos[starts[block] : stops[block]], m - need, side="right"))
            if not len(fit) or stop == starts[block]:
                continue
            for i in fit:
                js = np.arange(max(starts[block], i + 1) if block == own else starts[block], stop)
                js = js[cls[js] != cls[i]]
                if side is not None:
                    js = js[((side[js] != side[i]) | (side[js] < 0)) & (group[js] != group[i])]
                left.append(np.full(len(js), i))
                right.append(js)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _short_pairs(data, percent, in_cells):
    """The same pairs for many short lists at once: entry i meets the entries behind it, step by step.

    Entries are sorted by list, size, position, so an entry stops at its list's end or its size bound.
    """
    shingle, cls, size, pos = data[:4]
    left, right = [], []
    at, step = np.arange(len(shingle)), 0
    while len(at):
        step += 1
        at = at[at + step < len(shingle)]
        other = at + step
        near = (shingle[at] == shingle[other]) & (100 * size[at].astype(np.int64) >= percent * size[other].astype(np.int64))
        at, other = at[near], other[near]
        n, m = size[at].astype(np.int64), size[other].astype(np.int64)
        need = -(-percent * (n + m) // (100 + percent))
        good = (n - pos[at] >= need) & (m - pos[other] >= need) & (cls[at] != cls[other])
        if in_cells:
            side, group = data[4:]
            good &= ((side[at] != side[other]) | (side[at] < 0)) & (group[at] != group[other])
        left.append(at[good])
        right.append(other[good])
    return (np.concatenate(left), np.concatenate(right)) if left else (at, at)


def _pair_batch(cls, size, left, right) -> pa.RecordBatch:
    swap = cls[left] > cls[right]
    left, right = np.where(swap, right, left), np.where(swap, left, right)
    return pa.RecordBatch.from_arrays(
        [pa.array(cls[left]), pa.array(size[left]), pa.array(cls[right]), pa.array(size[right])], schema=_PAIRS
    )


def _pairs_of_lists(percent: int, in_cells: bool):
    """Kernel over entries sorted by shingle, size, position: the pairs of each list; one open list is carried over."""
    names = ["shingle", "cls", "size", "pos", *(["side", "component"] if in_cells else [])]

    def emit(data):
        bounds = np.flatnonzero(np.r_[True, data[0][1:] != data[0][:-1], True])
        lengths = np.diff(bounds)
        short = np.repeat((lengths > 1) & (lengths <= LONG_LIST), lengths)
        left, right = _short_pairs([x[short] for x in data], percent, in_cells)
        cls, size = data[1][short], data[2][short]
        if len(left):
            yield _pair_batch(cls, size, left, right)
        for k in np.flatnonzero(lengths > LONG_LIST):
            part = [x[bounds[k] : bounds[k + 1]] for x in data]
            fresh = np.r_[True, (part[1][1:] != part[1][:-1]) | (part[2][1:] != part[2][:-1])]
            part = [x[fresh] for x in part]
            left, right = _list_pairs(*part[1:4], percent, *part[4:])
            if len(left):
                yield _pair_batch(part[1], part[2], left, right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            data = [long_column(batch, name) for name in names]
            if rest is not None:
                data = [np.concatenate(pair) for pair in zip(rest, data)]
            cut = int(np.argmax(data[0] == data[0][-1]))
            rest = [x[cut:] for x in data]
            if cut:
                yield from emit([x[:cut] for x in data])
        if rest is not None:
            yield from emit(rest)

    return run


def _sets(n: int):
    schema = pa.schema([("cls", pa.int64()), ("size", pa.int32()), ("members", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            found = shingle_sets(text_column(batch, "text"), n)
            classes = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in found], np.uint64).view(np.int64)
            sizes = np.array([len(x) for x in found], np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes), pa.array(sizes), pa.array([x.tobytes() for x in found], pa.binary())], schema=schema
            )

    return run


def _shared(left: bytes, right: bytes) -> int:
    both = np.concatenate((np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _PAIRS.append(pa.field("overlap", pa.int32()))
    for batch in batches:
        pairs = zip(
            batch.column(batch.schema.get_field_index("a_members")).to_pylist(),
            batch.column(batch.schema.get_field_index("b_members")).to_pylist(),
        )
        shared = [_shared(left, right) for left, right in pairs]
        columns = [batch.column(batch.schema.get_field_index(name)) for name in _PAIRS.names]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(shared, pa.int32())], schema=schema)


def _verify(pairs: DataFrame, classes: DataFrame, documents: DataFrame, n: int, label: str) -> DataFrame:
    """Exact overlap of each pair, from the whole texts of one document per class."""
    sides = pairs.select(F.col("a_cls").alias("cls"), F.col("a_size").alias("size")).unionByName(
        pairs.select(F.col("b_cls").alias("cls"), F.col("b_size").alias("size"))
    )
    wanted = stage(classes.join(sides.distinct(), ["cls", "size"], "left_semi").select("cls", "size", "rep"), f"{label}_wanted")
    ids = wanted.select(F.col("rep").alias("doc_id")).distinct()
    texts = small_join(documents, ids, ["doc_id"], "left_semi")
    sets = texts.select("text").mapInArrow(_sets(n), "cls long, size int, members binary")
    sets = stage(sets, f"{label}_sets")
    if sets.count() > wanted.count():  # repeated ids
        sets = stage(sets.dropDuplicates(["cls", "size"]), f"{label}_single_sets")
    a, b = (sets.select(*(F.col(c).alias(f"{side}_{c}") for c in ("cls", "size", "members"))) for side in "ab")
    both = pairs.join(a, ["a_cls", "a_size"]).join(b, ["b_cls", "b_size"])
    columns = [*_PAIRS.names, "a_members", "b_members"]
    return stage(both.select(*columns).mapInArrow(_overlaps, PAIRS + ", overlap int"), f"{label}_overlaps")


def _frequent(entries: DataFrame, label: str):
    """The most frequent shingles with the log of their count, sorted, as numpy; never more than ``MOST_FREQUENT``.

    Counts are exact, over all documents. The count from which a shingle is frequent rises until the
    table fits its bound; order and results stay right with any such table.
    """
    counted = stage(
        entries.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n")).where(f"n >= {LONG_LIST}"),
        f"{label}_frequent",
    )
    level = F.floor(F.log2("n")).cast("int")
    levels = counted.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()
    least, total = 64, 0
    for row in levels:
        total += row["n"]
        if total > MOST_FREQUENT:
            break
        least = row["level"]
    table = counted.where(level >= least).select("shingle", level.cast("long").alias("level")).toArrow()
    shingles = table.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return entries.sparkSession.sparkContext.broadcast((shingles[order], table.column("level").to_numpy()[order]))


def _fingerprints(texts: DataFrame, percent: int, n: int, low_part: float, label: str) -> DataFrame:
    schema = "doc_id long, n_shingles long, cls long, shingles array<long>"
    return stage(texts.mapInArrow(_fingerprint(n, percent, low_part), schema), label)


def _entries(made: DataFrame, percent: int, low_part: float, label: str) -> tuple[DataFrame, DataFrame]:
    """Index entries of all prefixes: those of short lists, and those of long lists, staged."""
    indexed = made.where("shingles IS NOT NULL AND doc_id IS NOT NULL").select("n_shingles", "cls", "shingles")
    frequent = _frequent(indexed, label)
    schema = "shingle long, cls long, size int, pos int, frequent boolean"
    entries = indexed.mapInArrow(_prefixes(percent, low_part, frequent), schema)
    long_lists = stage(entries.where("frequent").drop("frequent").distinct(), f"{label}_long_lists")
    return entries.where("NOT frequent").drop("frequent"), long_lists


def _cells(long_lists: DataFrame) -> DataFrame:
    """Long lists as cells of bounded size, one for each two parts of a list: (shingle, cls, size, pos, side, component).

    ``shingle`` names the cell; ``side`` is the part, or -1 where a part meets itself. Each two classes of
    a list meet in exactly one cell, so that no task gets all pairs of one list.
    """
    parts = long_lists.groupBy("shingle").agg(F.ceil(F.count("*") / F.lit(CELL)).cast("int").alias("parts"))
    dealt = small_join(long_lists, stage(parts, "list_parts"), ["shingle"], "inner")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("cls", "size"), F.col("parts")).cast("int"))
    met = dealt.withColumn("with", F.explode(F.expr("sequence(0, parts - 1)")))
    cell = F.xxhash64("shingle", F.least("part", "with"), F.greatest("part", "with"))
    side = F.when(F.col("part") == F.col("with"), -1).otherwise(F.col("part"))
    return met.select(cell.alias("shingle"), "cls", "size", "pos", side.alias("side"), "component")


def _pairs_in_lists(entries: DataFrame, percent: int, in_cells: bool) -> DataFrame:
    columns = ["shingle", "cls", "size", "pos", *(["side", "component"] if in_cells else [])]
    sorted_lists = entries.select(*columns).repartition("shingle").sortWithinPartitions("shingle", "size", "pos", "cls")
    return sorted_lists.mapInArrow(_pairs_of_lists(percent, in_cells), PAIRS)


class Joined(NamedTuple):
    """The join of classes of equal sets; a class is known by 64 bits of its set's hash and the set's size.

    ``found``: (doc_id, n_shingles, cls), one row per document. ``classes``: (cls, size, rep, copies), one row per
    distinct set. ``grouped``: (cls, size, component) of the classes that links reach, component being the
    smallest id of all. ``others``: (cls, size, others), how many documents of other classes a class is
    similar to, or nothing if that was not asked for. Documents of one class are similar without a link.
    """

    found: DataFrame
    classes: DataFrame
    grouped: DataFrame
    others: DataFrame | None


def join_classes(documents: DataFrame, percent: int = 85, n: int = 4, count: bool = True) -> Joined:
    """The join itself. ``documents`` has doc_id and text; rows without doc_id or words take no part.

    First pass: all sets, short lists. A similar pair whose first common shingle has a long list has both
    its sets among the few that enter long lists. Second pass: these sets alone, with all their
    shingles counted, so that what a set has for itself comes first and its place in a long list tells
    how far it is from the others. Long lists then meet their most central sets. All that is connected so far
    is a group: its links are counted from differences, and long lists give pairs of different groups only.
    """
    ship_package(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = _fingerprints(texts, percent, n, LOW_PART, "fingerprints")
    classes = stage(
        made.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("cls", F.col("n_shingles").cast("int").alias("size"))
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")),
        "classes",
    )
    found = made.select("doc_id", "n_shingles", "cls")
    several = _several_texts(found, classes)
    similar = F.expr(f"100 * overlap >= {percent} * (a_size + b_size - overlap)")
    short, long_lists = _entries(made, percent, LOW_PART, "all")
    near = stage(_pairs_in_lists(short, percent, False).distinct(), "candidates")
    first = _verify(near, classes, texts, n, "first")
    links = first.where(similar)
    if long_lists.isEmpty():
        grouped = _class_components(links, classes, several)
        return Joined(found, classes, grouped, _summed(_partners(links, classes)) if count else None)

    members = long_lists.select("cls", "size").distinct()
    ids = stage(classes.join(members, ["cls", "size"], "left_semi").select(F.col("rep").alias("doc_id")).distinct(), "frequented")
    again = _fingerprints(small_join(texts, ids, ["doc_id"], "left_semi"), percent, n, 1.0, "again")
    short, long_lists = _entries(again, percent, 1.0, "again")
    stars = _stars(long_lists, percent)
    fresh = _pairs_in_lists(short, percent, False).unionByName(stars).distinct().join(first, _PAIRS.names, "left_anti")
    second = _verify(stage(fresh, "star_candidates"), classes, texts, n, "stars")
    links = links.unionByName(second.where(similar))
    grouped = _class_components(links, classes, several)

    tried = first.unionByName(second)
    rest = _pairs_of_groups(long_lists, grouped, stars, tried, percent)
    across = stage(_verify(rest, classes, texts, n, "rest").where(similar), "across")
    others = None
    if count:
        members = stage(long_lists.select("cls", "size").distinct(), "members")
        known = _partners(_not_inside(links, members), classes).unionByName(_partners(across, classes))
        inside = _group_links(again, small_join(members, grouped, ["cls", "size"], "inner"), classes, links, percent)
        others = _summed(known.unionByName(inside))
    return Joined(found, classes, _merged(grouped, across, classes), others)


def _stars(long_lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of each class of a long list with the list's most central ones, staged."""
    central = [F.min(F.struct("pos", F.xxhash64("cls", F.lit(k)).alias("h"), "cls", "size")).alias(f"l{k}") for k in range(LEADERS)]
    leaders = stage(long_lists.groupBy("shingle").agg(*central), "leaders")
    stars = small_join(long_lists, leaders, ["shingle"], "inner").select(
        "cls", "size", F.explode(F.array(*(F.col(f"l{k}") for k in range(LEADERS)))).alias("leader")
    )
    fits = F.least("size", "leader.size") * 100 >= F.greatest("size", "leader.size") * percent
    stars = stars.where(fits & (F.col("cls") != F.col("leader.cls"))).select(
        F.col("leader.cls").alias("a_cls"), F.col("leader.size").alias("a_size"), F.col("cls").alias("b_cls"), F.col("size").alias("b_size")
    )
    return stage(_ordered(stars).distinct(), "stars")


def _pairs_of_groups(long_lists: DataFrame, grouped: DataFrame, stars: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """Pairs from long lists whose classes are in different groups, without those tried or proven not similar."""
    marked = small_join(long_lists, grouped, ["cls", "size"], "left")
    marked = marked.withColumn("component", F.coalesce("component", F.xxhash64("cls", "size")))
    split = marked.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    open_lists = small_join(marked, stage(split.select("shingle"), "open_lists"), ["shingle"], "left_semi")
    rest = _pairs_in_lists(_cells(open_lists), percent, True).distinct()
    rest = stage(rest.join(tried, _PAIRS.names, "left_anti"), "rest_candidates")
    both_ways = tried.unionByName(tried.selectExpr("b_cls AS a_cls", "b_size AS a_size", "a_cls AS b_cls", "a_size AS b_size", "overlap"))
    either_way = stars.unionByName(stars.selectExpr("b_cls AS a_cls", "b_size AS a_size", "a_cls AS b_cls", "a_size AS b_size"))
    return _skip_by_leader(rest, both_ways.join(either_way, _PAIRS.names, "left_semi"), percent)


def _partners(links: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, size, others) for both ends of each link; others: documents at the other end."""
    ends = [
        links.select(F.col(f"{x}_cls").alias("own"), F.col(f"{x}_size").alias("own_size"), F.col(f"{y}_cls").alias("cls"), F.col(f"{y}_size").alias("size"))
        for x, y in ("ab", "ba")
    ]
    met = small_join(ends[0].unionByName(ends[1]), classes.select("cls", "size", "copies"), ["cls", "size"], "inner")
    return met.select(F.col("own").alias("cls"), F.col("own_size").alias("size"), F.col("copies").alias("others"))


def _summed(partners: DataFrame) -> DataFrame:
    return stage(partners.groupBy("cls", "size").agg(F.sum("others").alias("others")), "others")


def _not_inside(links: DataFrame, members: DataFrame) -> DataFrame:
    """Links without those between two of ``members``, which are counted in their group."""
    a, b = (members.select(F.col("cls").alias(f"{x}_cls"), F.col("size").alias(f"{x}_size"), F.lit(True).alias(f"{x}_in")) for x in "ab")
    flagged = small_join(small_join(links, a, ["a_cls", "a_size"], "left"), b, ["b_cls", "b_size"], "left")
    return flagged.where("a_in IS NULL OR b_in IS NULL").select(*links.columns)


def _group_links(again: DataFrame, members: DataFrame, classes: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """(cls, size, others) per cell, over the similar pairs among the ``members`` (cls, size, component) of each group.

    A set is kept as its symmetric difference D to the leader of its group, the member with most known
    links. Any two sets then share (|x| + |y| - |Dx| - |Dy|) / 2 + |Dx and Dy| shingles, whoever leads. Groups are
    dealt into parts by hash, and each two parts meet in one cell, so a task holds two parts and not a group.
    """
    ends = [links.select(F.col(f"{x}_cls").alias("cls"), F.col(f"{x}_size").alias("size")) for x in "ab"]
    degree = ends[0].unionByName(ends[1]).groupBy("cls", "size").agg(F.count("*").alias("degree"))
    ranked = stage(members.join(degree, ["cls", "size"], "left").join(classes.select("cls", "size", "copies"), ["cls", "size"]), "group_members")
    lead = F.max(F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), "cls", "size")).alias("lead")
    groups = ranked.groupBy("component").agg(lead, F.count("*").alias("n")).where("n > 1")
    groups = stage(groups.select("component", F.col("lead.cls").alias("l_cls"), F.col("lead.size").alias("l_size")), "group_leaders")
    ranked = small_join(ranked.drop("degree"), groups.select("component"), ["component"], "left_semi")

    sets = again.where("shingles IS NOT NULL AND doc_id IS NOT NULL").select("cls", F.col("n_shingles").cast("int").alias("size"), "shingles")
    sets = stage(sets.join(ranked, ["cls", "size"]), "group_sets")
    if sets.count() > ranked.count():  # repeated ids, or one class met by several tasks
        sets = stage(sets.dropDuplicates(["cls", "size"]), "single_group_sets")
    leaders = sets.join(groups, F.expr("cls = l_cls AND size = l_size AND l_cls IS NOT NULL"), "left_semi")
    leaders = stage(leaders.select("component", F.col("shingles").alias("led")), "leader_sets")
    apart = F.concat(F.array_except("shingles", "led"), F.array_except("led", "shingles"))
    differences = stage(small_join(sets, leaders, ["component"], "inner").select("component", "cls", "size", "copies", apart.alias("apart")), "differences")

    most = F.greatest(F.count("*") / F.lit(GROUP_PART), F.sum(F.size("apart")) / F.lit(GROUP_SHINGLES))
    parts = stage(differences.groupBy("component").agg(F.ceil(most).cast("int").alias("parts")), "group_parts")
    dealt = small_join(differences, parts, ["component"], "inner").withColumn("part", F.pmod(F.xxhash64("cls", "size"), F.col("parts")).cast("int"))
    met = dealt.withColumn("with", F.explode(F.expr("sequence(0, parts - 1)")))
    cells = met.select(
        "component", F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high"), "part", "cls", "size", "copies", "apart"
    )
    return cells.groupBy("component", "low", "high").applyInArrow(_cell_links(percent), "cls long, size int, others long")


def _shared_columns(left: np.ndarray, right: np.ndarray, a_row: np.ndarray, b_row: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """How many of their values two rows share, for each row of ``left`` and of ``right``, some columns at a time."""
    both = np.intersect1d(left, right)
    shared = np.zeros(shape, np.float32)
    sides = []
    for values, row in ((left, a_row), (right, b_row)):
        at = np.minimum(np.searchsorted(both, values), max(len(both) - 1, 0))
        held = both[at] == values if len(both) else np.zeros(len(values), bool)
        at, row = at[held], row[held]
        order = np.argsort(at, kind="stable")
        sides.append((at[order], row[order]))
    for start in range(0, len(both), COLUMNS):
        tables = []
        for (at, row), count in zip(sides, shape):
            lo, hi = np.searchsorted(at, [start, start + COLUMNS])
            table = np.zeros((count, min(COLUMNS, len(both) - start)), np.float32)
            table[row[lo:hi], at[lo:hi] - start] = 1
            tables.append(table)
        shared += tables[0] @ tables[1].T
    return shared.astype(np.int64)


def _cell_links(percent: int):
    """Kernel of one cell: for each set the documents of similar sets in the other part, or in its own if there is one only."""
    schema = pa.schema([("cls", pa.int64()), ("size", pa.int32()), ("others", pa.int64())])

    def run(cell: pa.Table) -> pa.Table:
        low, high = cell.column("low")[0].as_py(), cell.column("high")[0].as_py()
        cls, size, copies, part = (cell.column(c).to_numpy().astype(np.int64) for c in ("cls", "size", "copies", "part"))
        apart = cell.column("apart").combine_chunks()
        lengths = apart.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        values = apart.flatten().to_numpy(zero_copy_only=False)
        of_value = np.repeat(np.arange(len(cls)), lengths)
        sides, tables = [], []
        for side in (low, high):
            rows = np.flatnonzero(part == side)
            place = np.full(len(cls), -1)
            place[rows] = np.arange(len(rows))
            held = place[of_value] >= 0
            sides.append(rows)
            tables.append((values[held], place[of_value[held]]))
        a, b = sides
        shared = _shared_columns(tables[0][0], tables[1][0], tables[0][1], tables[1][1], (len(a), len(b)))
        total = size[a][:, None] + size[b][None, :]
        overlap = (total - lengths[a][:, None] - lengths[b][None, :]) // 2 + shared
        similar = 100 * overlap >= percent * (total - overlap)
        if low == high:
            np.fill_diagonal(similar, False)
            rows, others = a, similar @ copies[a]
        else:
            rows, others = np.r_[a, b], np.r_[similar @ copies[b], similar.T @ copies[a]]
        rows, others = rows[others > 0], others[others > 0]
        return pa.table([pa.array(cls[rows]), pa.array(size[rows].astype(np.int32)), pa.array(others.astype(np.int64))], schema=schema)

    return run


def _merged(grouped: DataFrame, across: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, size, component) with groups that links ``across`` them connect as one."""
    if across.isEmpty():
        return grouped
    named = classes.select("cls", "size", "rep").join(grouped, ["cls", "size"], "left")
    named = named.select("cls", "size", F.coalesce("component", "rep").alias("component"))
    a, b = (named.select(F.col("cls").alias(f"{x}_cls"), F.col("size").alias(f"{x}_size"), F.col("component").alias(x)) for x in "ab")
    joined = components(across.join(a, ["a_cls", "a_size"]).join(b, ["b_cls", "b_size"]).select("a", "b"))
    joined = stage(joined.select(F.col("node").alias("component"), F.col("component").alias("merged")), "merged")
    moved = small_join(named, joined, ["component"], "left").where("merged IS NOT NULL").select("cls", "size", "merged")
    all_of = grouped.join(moved, ["cls", "size"], "full_outer")
    return stage(all_of.select("cls", "size", F.coalesce("merged", "component").alias("component")), "merged_components")


def _ordered(pairs: DataFrame) -> DataFrame:
    """Pairs of classes with the smaller class first, as lists give them."""
    swap = F.col("a_cls") > F.col("b_cls")
    ends = [(f"{x}_{c}", f"{y}_{c}") for x, y in ("ab", "ba") for c in ("cls", "size")]
    return pairs.select(*(F.when(swap, F.col(other)).otherwise(F.col(own)).alias(own) for own, other in ends))


def _class_components(links: DataFrame, classes: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """(cls, size, component) of the classes that have links; ``more``: further links (a, b) between ids."""
    reps = classes.select("cls", "size", "rep")
    a = reps.select(F.col("cls").alias("a_cls"), F.col("size").alias("a_size"), F.col("rep").alias("a"))
    b = reps.select(F.col("cls").alias("b_cls"), F.col("size").alias("b_size"), F.col("rep").alias("b"))
    named = links.join(a, ["a_cls", "a_size"]).join(b, ["b_cls", "b_size"]).select("a", "b")
    if more is not None:
        named = named.unionByName(more)
    return stage(reps.join(components(named).withColumnRenamed("node", "rep"), "rep").drop("rep"), "class_components")


def _skip_by_leader(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Leave out pairs (y, z) whose overlaps with a common leader x prove that they are not similar.

    Shingles of y and z together lie in x, at most min(o_y, o_z), or outside, at most
    min(|y| - o_y, |z| - o_z). One leader per class is enough for a proof, so the bound uses the class's
    partner with the largest overlap; without a common one a pair stays.
    """
    best = known.groupBy(F.col("b_cls").alias("cls"), F.col("b_size").alias("size")).agg(
        F.max_by(F.struct(F.col("a_cls").alias("leader"), "overlap"), F.struct("overlap", "a_cls")).alias("best")
    )
    best = stage(best.select("cls", "size", "best.leader", "best.overlap"), "best_leader")
    y, z = (best.select(*(F.col(c).alias(f"{side}_{c}") for c in best.columns)) for side in "ab")
    both = small_join(small_join(pairs, y, ["a_cls", "a_size"], "left"), z, ["b_cls", "b_size"], "left")
    most = F.least("a_overlap", "b_overlap") + F.least(F.expr("a_size - a_overlap"), F.expr("b_size - b_overlap"))
    hopeless = (F.col("a_leader") == F.col("b_leader")) & (most * (100 + percent) < (F.col("a_size") + F.col("b_size")) * percent)
    return stage(both.where(~F.coalesce(hopeless, F.lit(False))).select(*_PAIRS.names), "kept_candidates")


def _several_texts(found: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): each doc_id that occurs with several sets, and the representatives of these."""
    rows = found.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "cls", F.col("n_shingles").cast("int").alias("size"))
    key = F.struct("cls", "size")
    several = rows.groupBy("doc_id").agg(F.min(key).alias("x"), F.max(key).alias("y")).where("x <> y").select("doc_id")
    several = stage(several, "several_texts")
    return small_join(rows, several, ["doc_id"], "left_semi").join(classes, ["cls", "size"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))


def _per_document(joined: Joined) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links), the last one only if links were counted."""
    marked = joined.classes.join(joined.grouped, ["cls", "size"], "left")
    links = F.lit(0).cast("long")
    if joined.others is not None:
        marked, links = marked.join(joined.others, ["cls", "size"], "left"), F.coalesce("others", F.lit(0))
    moved = marked.select(
        "cls", F.col("size").cast("long").alias("n_shingles"), F.coalesce("component", "rep").alias("component"), "rep", (links + F.col("copies") - 1).alias("n")
    )
    moved = stage(moved.where("n > 0 OR component <> rep"), "moved")
    row = small_join(joined.found, moved.drop("rep"), ["cls", "n_shingles"], "left")
    known = F.col("doc_id").isNotNull()
    return row.select(
        "doc_id", "n_shingles",
        F.when(known, F.coalesce("component", "doc_id")).alias("component_id"),
        F.coalesce(F.when(known, F.col("n")), F.lit(0)).alias("n_links"),
    )


def jaccard_join(documents: DataFrame, percent: int = 85, n: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of the whole join.

    component_id is the smallest doc_id that links reach, n_links the number of other rows that the row is
    similar to, copies included. One row per row of ``documents``; other columns are ignored. Empty or NULL
    text: no shingles, a component alone. NULL doc_id: component NULL, linked with nothing. A doc_id that
    occurs with several texts is one node with the links of them all. An empty table gives no rows.
    """
    return _per_document(join_classes(documents, percent, n))


def jaccard_components(documents: DataFrame, percent: int = 85, n: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id) as in ``jaccard_join``; links inside groups are not counted."""
    return _per_document(join_classes(documents, percent, n, count=False)).drop("n_links")


def link_counts(documents: DataFrame, percent: int = 85, n: int = 4) -> DataFrame:
    """(doc_id, n_shingles, n_links) as in ``jaccard_join``."""
    return jaccard_join(documents, percent, n).drop("component_id")


def keep_one_per_component(documents: DataFrame, percent: int = 85, n: int = 4) -> DataFrame:
    """One row of each group of similar texts: that with the smallest doc_id, equal ones by the text's hash.

    Texts decide, not ids: different texts under one doc_id stay unless they are similar to others, and copies go
    whether they have a doc_id or not; a row without one is kept only where the group has no other. Rows without
    words are similar to nothing and stay. All columns stay as they are; an empty table gives no rows. If a doc_id
    is NULL or repeated, the rows are written once with numbers of their own.
    """
    if documents.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        found = jaccard_components(documents, percent, n)
        gone = stage(found.where("doc_id <> component_id").select("doc_id"), "gone")
        return small_join(documents, gone, ["doc_id"], "left_anti")

    row = F.struct(*(F.col(f"`{c}`") for c in documents.columns))
    numbered = stage(documents.select(row.alias("row"), F.monotonically_increasing_id().alias("at")), "numbered")
    found = jaccard_components(numbered.select(F.col("at").alias("doc_id"), "row.text"), percent, n)
    moved = found.where("doc_id <> component_id").select(F.col("doc_id").alias("at"), F.col("component_id").alias("grp"))
    moved = stage(moved, "moved_rows")
    groups = stage(moved.unionByName(moved.select(F.col("grp").alias("at"), "grp").distinct()), "groups")
    members = small_join(numbered, groups, ["at"], "inner")
    first = F.struct(F.col("row.doc_id").isNull().alias("none"), "row.doc_id", F.xxhash64("row.text").alias("h"), "at")
    heads = members.groupBy("grp").agg(F.min(first).alias("first")).select("first.at")
    gone = stage(groups.join(heads, "at", "left_anti").select("at"), "gone")
    return small_join(numbered, gone, ["at"], "left_anti").select("row.*")

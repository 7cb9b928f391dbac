"""Exact set-similarity join of documents over word n-grams, by groups and their token unions.

1. *Sets.* Texts with equal shingle sets become one node, so copies cost nothing further.
2. *Matrix rows.* A set's shingles are dealt into parts by hash; the shingles of a part together
   make one entry (an atom). Two sets that qualify differ in at most ``d`` shingles, hence in at
   most ``d`` atoms, and every set has more atoms than that: no qualifying pair is missed.
   A set must share more atoms than it has to spare (``a - d - 1`` of its ``a``), or it has no partner.
3. *Groups.* Every set that does is compared with the set that is central to most of its shared atoms; linked
   sets form groups, held in chunks of bounded size. Members of one group need no more comparing.
4. *Common atoms.* A set with ``a`` atoms shares at least ``a - d`` of them with any partner. So it can
   leave out ``a - d - 1`` of those that occur in several classes, the most common ones: by one
   global order (rarest first) it still shares another one with each partner. Passages and lines
   that many documents hold, and families of texts that are alike but not enough, thus make few
   candidates.
   A set also carries the parity of its shingles in 128 cells: two sets differ in at least as many shingles
   as their parities do in cells, so pairs that must differ too much never leave that join.
5. *Bound, then open.* For a set and a group of another class that share such an atom, the set's
   overlap with the group's atoms, then with the union of the group's shingles, bounds its overlap
   with each member. Only groups that reach both bounds are opened, and their members compared one
   by one, exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortloom.llm.components import components
from cohortloom.llm.stored import quoted, stored
from cohortloom.llm.words import U, find_words, lists, mixed, n_grams, slices, text_bytes

GROUP_MEMBERS = 32  # mean size of a group's chunk
CELLS = 2  # 64-bit words of a set's parity
QUERY_BLOCK = 10_000


class Atoms:
    """First atoms of a shingle set for "100 * overlap >= percent * union"."""

    def __init__(self, percent: int, fewest_parts: int = 10) -> None:
        self.percent, self.fewest = percent, fewest_parts

    def differing(self, n: int) -> int:
        """Most shingles in which a set of ``n`` and a qualifying partner can differ."""
        return n * (100 - self.percent) // self.percent

    def parts(self, size_class: int) -> int:
        top = 2 << size_class
        return max(-(-5 * self.differing(top) // 4), self.differing(top) + self.fewest)

    def of(self, shingles: np.ndarray) -> list[np.ndarray] | None:
        """Atoms of a sorted set, under its own size class and, if a partner may be of the next one, under
        that; ``None`` if too few parts are filled for the guarantee."""
        n = len(shingles)
        d = self.differing(n)
        if d == 0:  # only an equal set qualifies
            return []
        own = n.bit_length() - 1
        reaches_next = n * 100 // self.percent >= 2 << own
        values, out = mixed(shingles ^ U(0x9E3779B97F4A7C15)), []
        for size_class in (own, own + 1) if reaches_next else (own,):
            part = ((shingles >> U(32)) * U(self.parts(size_class))) >> U(32)
            start = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1])
            if len(start) <= d:
                return None
            out.append(mixed(np.add.reduceat(values, start) + U(size_class + 1)))
        return out


def shingle_sets(part: pa.RecordBatch, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of ``part``."""
    runs, first = n_grams(find_words(*text_bytes(part.column("text"))), words, short_whole=True)
    return [np.unique(runs[first[i]:first[i + 1]]) for i in range(part.num_rows)]


def parity(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles fall into each of ``64 * CELLS`` cells, as ``CELLS`` words."""
    cells = ((shingles >> U(40)) % U(64 * CELLS)).astype(np.int64)
    odd = np.bincount(cells, minlength=64 * CELLS).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def _index(words: int, atoms: Atoms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part, words)
                found = [atoms.of(s) for s in sets]
                columns = []
                for k in (0, 1):
                    held = [x[k] if x and len(x) > k else np.zeros(0, np.uint64) for x in found]
                    first = np.concatenate([[0], np.cumsum([len(x) for x in held])])
                    columns.append(lists(np.concatenate([*held, np.zeros(0, np.uint64)]).view(np.int64), first, pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    *columns, pa.array([x is None for x in found], pa.bool_()),
                    lists(np.concatenate([*map(parity, sets), np.zeros(0, np.int64)]), np.arange(len(sets) + 1) * CELLS,
                          pa.int64()),
                ], ["doc_id", "n_shingles", "set_key", "own_atoms", "next_atoms", "loose", "parity"])
    return run


def _sets_of(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part, words)
                first = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64),
                                                  first, pa.int64())], ["node", "shingles"])
    return run


def _compare_with(block: list, words: int, percent: int):
    """Links between the sets of ``block`` and every text."""
    asked = [(row["node"], np.sort(np.array(row["shingles"], dtype=np.int64).view(np.uint64))) for row in block]
    sizes = [len(s) for _, s in asked]
    low, high = min(sizes) * percent // 100, max(sizes) * 100 // percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = []
                for node, s in zip(part.column("doc_id").to_pylist(), shingle_sets(part, words)):
                    if low <= len(s) <= high:
                        for other, t in asked:
                            if 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)):
                                same = len(np.intersect1d(s, t, assume_unique=True))
                                if 100 * same >= percent * (len(s) + len(t) - same):
                                    found.append((node, other))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()),
                                                  pa.array([x[1] for x in found], pa.int64())], ["a", "b"])
    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) whose sets qualify, by exact overlap of the two arrays."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    same = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").where(
        100 * F.least(F.size("x"), F.size("y")) >= percent * F.greatest(F.size("x"), F.size("y"))
    ).where(100 * same >= percent * (F.size("x") + F.size("y") - same)).select("a", "b").distinct()


def _differing(size: str, other: str, percent: int) -> str:
    """Most shingles in which two sets of these sizes can differ and qualify."""
    return f"({size} + {other}) * {100 - percent} div {100 + percent}"


def _parities_allow(own: str, other: str, differing: str) -> str:
    """Unknown parities allow everything."""
    apart = " + ".join(f"bit_count({own}[{k}] ^ {other}[{k}])" for k in range(CELLS))
    return f"coalesce({apart} <= {differing}, true)"


def _across_groups(listed: DataFrame, parities: DataFrame, classes: DataFrame, sets: DataFrame,
                   percent: int) -> DataFrame:
    """Links between sets of different classes that share an atom."""
    placed = listed.join(classes, "node", "left").select(
        "atom", "node", "spare", "size", "least", F.coalesce("component", "node").alias("component"))
    held_by = placed.select("atom", "component").distinct().groupBy("atom").agg(F.count("*").alias("classes"))
    matrix = stored(placed.join(held_by.where("classes > 1"), "atom"), "matrix")
    own = Window.partitionBy("node")  # the atoms of one set
    placed = stored(matrix.withColumns({
        "n": F.count("*").over(own), "place": F.row_number().over(own.orderBy("classes", "atom"))
    }).where("place <= n - spare").join(parities, "node").select(
        "atom", "node", "component", "size", "least", "parity", (F.col("n") - F.col("place")).alias("after"),
        F.expr(f"spare + 1 + least * {100 - percent} div {percent}").alias("atoms")), "placed")
    members = placed.groupBy("component", "node").agg(
        F.first("parity").alias("parity"), F.max("size").alias("size"), F.min("least").alias("least"))
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / GROUP_MEMBERS).alias("chunks"))
    members = stored(members.join(sizes, "component").select(
        "node", "component", "parity", "size", "least", F.expr("pmod(xxhash64(node), chunks)").alias("chunk")), "members")

    rows = placed.join(members.select("node", "chunk"), "node")
    groups = rows.groupBy("atom", F.col("component").alias("group"), "chunk").agg(
        F.max("after").alias("g_after"), F.min("atoms").alias("g_atoms"), F.max("size").alias("g_size"),
        F.min("least").alias("g_least"),
        F.when(F.min("node") == F.max("node"), F.first("parity")).alias("g_parity"))  # of a lone member
    # Two sets of given sizes differ in so many shingles at most; at their first common atom, what
    # follows in both lists must suffice for the rest of the atoms that they share.
    differing = _differing("size", "g_size", percent)
    asked = stored(placed.join(groups, "atom").where("component > `group`").where(
        f"100 * least(size, g_size) >= {percent} * greatest(least, g_least)").where(
        f"1 + least(after, g_after) >= greatest(atoms, g_atoms) - {differing}").where(
        _parities_allow("parity", "g_parity", differing)).select("node", "group", "chunk").distinct(), "asked")
    entry = F.col("atom").alias("entry")
    of_node = matrix.groupBy("node").agg(F.collect_set(entry).alias("own"), F.min("spare").alias("spare"))
    of_group = matrix.join(members.select("node", "chunk"), "node").groupBy(
        F.col("component").alias("group"), "chunk").agg(F.collect_set(entry).alias("theirs"))
    asked = stored(asked.join(of_node, "node").join(of_group, ["group", "chunk"]).where(
        F.size(F.array_intersect("own", "theirs")) > F.col("spare")).select("node", "group", "chunk"), "asked")
    wanted = asked.select(F.col("group").alias("component"), "chunk").distinct()
    unions = members.join(wanted, ["component", "chunk"]).join(sets, "node").groupBy("component", "chunk").agg(
        F.array_distinct(F.flatten(F.collect_list("shingles"))).alias("held"))  # GROUP_MEMBERS sets or so
    opened = asked.join(sets, "node").join(
        unions.withColumnRenamed("component", "group"), ["group", "chunk"]
    ).where(100 * F.size(F.array_intersect("shingles", "held")) >= percent * F.size("shingles"))
    asking = members.select(F.col("node").alias("a"), F.col("parity").alias("a_parity"), F.col("size").alias("a_size"),
                            F.col("least").alias("a_least"))
    pairs = opened.select(F.col("node").alias("a"), F.col("group").alias("component"), "chunk").join(asking, "a").join(
        members, ["component", "chunk"]).where(
        f"100 * least(a_size, size) >= {percent} * greatest(a_least, least)").where(
        _parities_allow("a_parity", "parity", _differing("a_size", "size", percent))).select(
        "a", F.col("node").alias("b")).distinct()
    return _verified(pairs, sets, percent)


def jaccard_classes(docs: DataFrame, *, words: int = 4, percent: int = 85, text: str = "text",
                    doc_id: str = "doc_id", fewest_parts: int = 10) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for every row of ``docs``.

    Words are lower-cased (A-Z) and split at ASCII white space; a text of fewer than ``words`` words
    is one shingle. Null, empty and blank texts have no shingles and link with nothing: their
    ``component_id`` is their own ``doc_id``. Rows that share a ``doc_id`` count as one document for
    links. A row with a null ``doc_id`` gets the class of an equal set that has one, else null.
    Other columns are not read; an empty table gives an empty result. ``doc_id`` is cast to long.
    """
    plain = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    index = stored(plain.mapInArrow(
        _index(words, Atoms(percent, fewest_parts)),
        "doc_id long, n_shingles long, set_key binary, own_atoms array<long>, next_atoms array<long>, loose boolean, "
        "parity array<long>"), "sets")
    filled = index.where("n_shingles > 0 and doc_id is not null")
    nodes = stored(filled.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.count("*").alias("rows")), "nodes")
    # An id with several texts is one document: all its sets are listed under it, and it links their nodes.
    several = stored(filled.groupBy("doc_id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")).where(
        "low < high").select("doc_id"), "several")
    own_links = filled.select("doc_id", "set_key").join(several, "doc_id").join(nodes, "set_key").where(
        "doc_id != node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    copies = stored(filled.select("doc_id", "set_key").join(nodes.where("rows > 1"), "set_key").where("doc_id != node").join(
        several, "doc_id", "left_anti").select("doc_id").distinct(), "copies")
    single = filled.join(copies, "doc_id", "left_anti")

    sizes = F.array(F.size("own_atoms"), F.when(F.size("next_atoms") > 0, F.size("next_atoms")))
    spare = F.array_min(sizes) - F.expr(f"n_shingles * {100 - percent} div {percent} + 1")
    postings = single.select(F.explode(F.concat("own_atoms", "next_atoms")).alias("atom"), F.col("doc_id").alias("node"))
    shared = stored(postings.groupBy("atom").agg(F.count("*").alias("nodes")).where("nodes > 1").select("atom"), "shared")
    held = stored(postings.join(shared, "atom"), "held")
    enough = held.groupBy("node").agg(F.count("*").alias("n")).join(
        single.select(F.col("doc_id").alias("node"), spare.cast("int").alias("spare"), F.col("n_shingles").alias("size"),
                      "set_key", "parity"),
        "node").where("n > spare").groupBy("node").agg(  # sets that share an id count with their loosest bounds
        F.min("spare").alias("spare"), F.max("size").alias("size"), F.min("size").alias("least"),
        F.when(F.min("set_key") == F.max("set_key"), F.first("parity")).alias("parity"))
    enough = stored(enough, "enough")
    listed = stored(held.join(enough.drop("parity"), "node"), "listed")
    loose = single.where("loose").select(F.col("doc_id").alias("node"))
    wanted = stored(listed.select("node").distinct(), "wanted")
    sets = stored(plain.join(wanted.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi").mapInArrow(
        _sets_of(words), "node long, shingles array<long>").dropDuplicates(["node", "shingles"]), "shingles")

    central = listed.groupBy("node").agg(F.count("*").alias("score"))
    pivots = listed.join(central, "node").groupBy("atom").agg(
        F.max(F.struct("score", (-F.col("node")).alias("key"))).alias("top")).select("atom", (-F.col("top.key")).alias("pivot"))
    stars = listed.join(pivots, "atom").where("node != pivot").groupBy("node", "pivot").agg(F.count("*").alias("n")).groupBy(
        F.col("node").alias("a")).agg(F.max(F.struct("n", "pivot")).alias("top")).select("a", F.col("top.pivot").alias("b"))
    links = stored(_verified(stars, sets, percent), "links").unionByName(own_links)
    links = links.unionByName(_across_groups(listed, enough.select("node", "parity"), components(links), sets, percent))
    for block in _blocks(plain.join(loose.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi").mapInArrow(
            _sets_of(words), "node long, shingles array<long>"), loose):
        links = links.unionByName(plain.where("doc_id is not null").mapInArrow(
            _compare_with(block, words, percent), "a long, b long"))
    classes = components(links)
    named = nodes.join(classes, "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("component_id"))
    return index.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _blocks(asked: DataFrame, any_of: DataFrame) -> Iterator[list]:
    """The few sets whose atoms give no guarantee (about one of 100,000 small texts), in blocks.
    They are a stated set of queries that every text is compared with, a block at a time."""
    if any_of.isEmpty():
        return
    block = []
    for row in asked.toLocalIterator():
        block.append(row)
        if len(block) == QUERY_BLOCK:
            yield block
            block = []
    if block:
        yield block


def one_of_each_class(docs: DataFrame, classes: DataFrame, *, doc_id: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose document is the smallest of its class.

    Of rows that repeat a ``doc_id`` the smallest stays; rows without ``doc_id`` all stay, since no
    class can name them.
    """
    key = quoted(doc_id).cast("long")
    dropped = stored(classes.where("doc_id != component_id").select(F.col("doc_id").alias("_gone")).distinct(), "dropped")
    repeated = stored(classes.where("doc_id = component_id").groupBy(F.col("doc_id").alias("_again"))
                      .agg(F.count("*").alias("rows")).where("rows > 1").select("_again"), "repeated")
    left = docs.join(dropped, key == F.col("_gone"), "left_anti")
    if repeated.isEmpty():
        return left
    once = left.join(repeated, key == F.col("_again"), "left_semi").groupBy(key.alias("_key")).agg(
        F.min(F.struct(*[quoted(c) for c in docs.columns])).alias("doc"))
    return left.join(repeated, key == F.col("_again"), "left_anti").unionByName(
        once.select(*[F.col("doc")[c].alias(c) for c in docs.columns]))

"""Jaccard join of documents on word shingles: a MinHash LSH forest, then exact verification.

1. Documents with equal shingle sets form a class; everything below works on classes.
2. A tree of the forest labels a class with `DEEPEST` MinHash values of its set; the sorted labels of all classes are a
   trie, whose nodes are the classes that share a prefix. Classes of one node are candidates. From the deepest level the
   matched prefix is shortened until pairs at the threshold meet in some tree with the target recall. Under that level it
   is shortened further, node by node, as long as a node holds no more than `FEW` classes: where the corpus is sparse, prefixes
   of `SHORTEST` values are matched, which only adds candidates; where it is dense, the level of the target stays.
3. Classes of one node are compared in cells of bounded size: a large node is cut into blocks, and pairs of
   blocks become cells. A pair belongs to the first tree whose nodes agree, so it is verified once.
4. A cell verifies its pairs by exact intersection of their shingle sets and returns, per class, the number of linked
   documents and one neighbour of a spanning star; pairs themselves are never written.

The result has one row per document: `class_id`, the smallest `doc_id` of its connected component, and `n_links`, the other
documents that it links to, equal sets included. Words are runs of non-blank characters; a text of fewer words than a shingle
is one shingle. Null texts and texts without words link with nothing and are their own class. Rows may repeat: each
counts as a document. Rows with a null `doc_id` link as others do, and give a class their id only where no other row has one.
Sets are compared as 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.components import components
from tokenloom.llm.groups import whole_groups
from tokenloom.llm.storage import written
from tokenloom.llm.words import Words, find_words, mix, slices, window_hashes

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
DEEPEST = 8
TARGET_RECALL = 0.9995
# The shortest prefix that is matched, and the classes that a node of less than the target's depth may hold.
SHORTEST = 2
FEW = 4
# Classes of one prefix that a cell takes from either of its blocks.
BLOCK = 256
# Shingles whose hash values are held at a time, and entries of an intersection's incidence matrix.
HASH_RUN = 1 << 15
MATRIX = 1 << 22


def matched_depth(threshold: float = THRESHOLD, trees: int = TREES, target: float = TARGET_RECALL) -> int:
    """The longest prefix with which a pair at the threshold agrees in some tree with the target probability."""
    depth = DEEPEST
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def shingle_sets(words: Words, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    windows = window_hashes(words.hash, width)
    sets = []
    for row in range(len(words.first) - 1):
        part = words.of(row)
        count = part.stop - part.start
        if count >= width:
            sets.append(np.unique(windows[part.start : part.stop - width + 1]))
        elif count:
            sets.append(window_hashes(words.hash[part], count))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def labels(sets: list[np.ndarray], trees: int, depth: int) -> np.ndarray:
    """Keys per set, tree and level: the hashes of the first `SHORTEST` to `depth` MinHash values of the tree's label."""
    levels = max(depth - SHORTEST + 1, 1)
    out = np.zeros((len(sets), trees, levels), np.uint64)
    filled = [i for i, s in enumerate(sets) if len(s)]
    at = 0
    while at < len(filled):
        run, size = [], 0
        while at < len(filled) and (not run or size + len(sets[filled[at]]) <= HASH_RUN):
            run.append(filled[at])
            size += len(sets[filled[at]])
            at += 1
        values = np.concatenate([sets[i] for i in run])
        first = np.cumsum([0, *(len(sets[i]) for i in run[:-1])])
        for tree in range(trees):
            label = np.full(len(run), tree, np.uint64)
            for level in range(depth):
                seed = mix(np.array([tree * 1000 + level * 2 + 1, tree * 1000 + level * 2 + 2], np.uint64))
                least = np.minimum.reduceat((values ^ seed[0]) * (seed[1] | np.uint64(1)), first)
                label = mix(label * np.uint64(31) ^ least)
                if level + 1 >= min(SHORTEST, depth):
                    out[run, tree, level + 1 - min(SHORTEST, depth)] = label
    return out


def _labelled(width: int, trees: int, depth: int):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3):
                sets = shingle_sets(find_words(part.column(3)), width)
                keys = labels(sets, trees, depth).view(np.int64)
                digests = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                flat = pa.array(keys.reshape(-1))
                each = trees * keys.shape[2]
                lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, each, dtype=np.int32), flat)
                columns = [*part.columns[:3], pa.array(digests, pa.binary()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_1", "row_2", "set", "labels"])

    return label


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Two hashes that name an id with its text; repeated rows share them, whatever the integer type of the id."""
    doc_id = doc_id.cast("long")
    return [F.xxhash64(doc_id, text).alias("row_1"), F.xxhash64(text, F.lit(7), doc_id).alias("row_2")]


def _with_row_key(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), *row_key(docs[doc_id], docs[text]), docs[text].alias("text"))


class Join:
    """The written tables of one join: `rows` (a row per document) and `found` (a row per linked or repeated class)."""

    def __init__(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD, width: int = SHINGLE, trees: int = TREES):
        self.threshold, self.width, self.trees = threshold, width, trees
        self.depth = matched_depth(threshold, trees)
        keyed = _with_row_key(docs, text, doc_id)
        label = _labelled(width, trees, self.depth)
        self.rows = written(
            keyed.mapInArrow(label, "doc_id long, row_1 long, row_2 long, `set` binary, labels array<long>"), "labels"
        )
        first = F.min(F.struct(F.isnull("doc_id"), "doc_id", "row_1", "row_2"))
        self.classes = written(
            self.rows.where("`set` is not null")
            .groupBy("set")
            .agg(F.count(F.lit(1)).alias("members"), first.alias("first"), F.any_value("labels").alias("labels")),
            "classes",
        )
        self.links = written(self._verified(keyed, self._cells()), "links")
        self.found = self._summed()

    def _nodes(self) -> DataFrame:
        """(`set`, `tree`, `node`, `depth`, `n`): the node of every class in every tree in which it is not alone."""
        levels = max(self.depth - SHORTEST + 1, 1)
        trees = F.sequence(F.lit(0), F.lit(self.trees - 1))
        left = self.classes.select("set", "labels", F.explode(trees).alias("tree")).select(
            "set", "tree", F.slice("labels", F.col("tree") * levels + 1, levels).alias("label")
        )
        found = []
        for level in range(levels):
            # Labels in order share a prefix exactly where they share its hash: a node is a group.
            keyed = left.withColumn("node", F.get("label", F.lit(level)))
            sizes = written(keyed.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "nodes")
            met = written(keyed.join(sizes.hint("merge"), ["tree", "node"]), "met")
            depth = F.lit(self.depth - levels + level + 1).alias("depth")
            done = met if level == levels - 1 else met.where(F.col("n") <= FEW)
            found.append(done.select("set", "tree", "node", depth, "n"))
            left = met.where(F.col("n") > FEW).select("set", "tree", "label")
        return written(reduce(DataFrame.unionAll, found), "forest")

    def _cells(self) -> DataFrame:
        """Candidates by cell: one row for every class in every cell that holds one of its pairs."""
        self.nodes = self._nodes()
        # A class's nodes by tree; a number of its own where it is alone in a tree.
        met = F.map_from_entries(F.collect_list(F.struct("tree", "node")))
        own = F.transform(
            F.sequence(F.lit(0), F.lit(self.trees - 1)),
            lambda t: F.coalesce(F.try_element_at("met", t), F.xxhash64("set", t)),
        )
        placed_in = written(self.nodes.groupBy("set").agg(met.alias("met")).select("set", own.alias("prefixes")), "placed")
        blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        block = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
        placed = (
            self.nodes.withColumn("blocks", blocks)
            .withColumn("block", block)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("low", F.least("block", "other"))
            .withColumn("high", F.greatest("block", "other"))
            .select("set", "tree", "block", "low", "high", F.xxhash64("tree", "node", "low", "high").alias("cell"))
        )
        # Both sides grow with the corpus: merged at every size, never held in an executor's memory.
        slim = self.classes.select("set", "members", "first.row_1", "first.row_2").join(placed_in.hint("merge"), "set")
        pairs = placed.join(slim.select("set", "members", "prefixes", "row_1", "row_2").hint("merge"), "set").repartition("cell").sortWithinPartitions("cell")
        return pairs.mapInArrow(_needed, pairs.schema)

    def _verified(self, keyed: DataFrame, cells: DataFrame) -> DataFrame:
        """(`set`, `links`, `peer`) of every class with a verified pair, per cell."""
        cells = written(cells, "cells")
        # The wanted rows grow with the corpus: merged by key at every size, never sent to every task.
        wanted = cells.select("row_1", "row_2").distinct().hint("merge")
        texts = keyed.select("row_1", "row_2", "text").join(wanted, ["row_1", "row_2"], "left_semi")
        joined = cells.join(texts.dropDuplicates(["row_1", "row_2"]), ["row_1", "row_2"]).drop("row_1", "row_2")
        sorted_cells = joined.repartition("cell").sortWithinPartitions("cell")
        return sorted_cells.mapInArrow(_verifier(self.threshold, self.width), "`set` binary, links long, peer binary")

    def _summed(self) -> DataFrame:
        """(`set`, `first`, `root`, `members`, `links`) of every class; `root` is the component's smallest class."""
        # Written, as are the small sides below: joins on a hot class or component then read two plain shuffles, which Spark splits.
        counted = self.links.groupBy("set").agg(F.sum("links").alias("links"))
        roots = components(self.links.select("set", "peer").distinct(), "set", "peer").withColumnRenamed("vertex", "set")
        found = (
            self.classes.select("set", "first", "members")
            .join(counted, "set", "left")
            .join(roots, "set", "left")
            .select("set", "first", "members", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "set").alias("root"))
        )
        return written(found, "found")

    def first_rows(self) -> DataFrame:
        """(`root`, `first`): the row that stands for a component, by smallest id and then row key."""
        return self.found.groupBy("root").agg(F.min("first").alias("first"))

    def documents(self) -> DataFrame:
        """(`doc_id`, `class_id`, `n_links`) of every row."""
        ids = written(self.first_rows().select("root", F.col("first.doc_id").alias("class_id")), "components")
        n_links = (F.col("links") + F.col("members") - 1).alias("n_links")
        per_set = written(self.found.join(ids, "root").select("set", "class_id", n_links), "per-class")
        linked = self.rows.select("doc_id", "set").where("`set` is not null").join(per_set, "set")
        alone = self.rows.where("`set` is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
        return linked.select("doc_id", "class_id", "n_links").unionAll(alone)


def jaccard_join(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: `doc_id`, `class_id` and `n_links`."""
    return Join(docs, text, doc_id, threshold).documents()


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """One row of every component stays, the one with the smallest id; rows without words all stay.

    Rows that repeat id and text count as one: of those that differ otherwise, the one with the least hash of its row stays.
    """
    join = Join(docs, text, doc_id, threshold)
    kept = join.first_rows().select("first.row_1", "first.row_2")
    alone = join.rows.where("`set` is null").select("row_1", "row_2").distinct()
    keyed = docs.select(F.struct("*").alias("row"), *row_key(docs[doc_id], docs[text]))
    same = keyed.join(kept, ["row_1", "row_2"], "left_semi").groupBy("row_1", "row_2")
    one = same.agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    rest = keyed.join(alone, ["row_1", "row_2"], "left_semi")
    return one.select("row.*").unionAll(rest.select("row.*"))


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of cells that have a pair of their own: one whose first agreeing tree is the cell's."""
    for table, borders in whole_groups(batches, "cell"):
        view = _CellView(table)
        keep = np.zeros(table.num_rows, bool)
        for begin, end in zip(borders[:-1], borders[1:]):
            keep[begin:end] = view.own_pairs(begin, end).any(axis=0)
        if keep.any():
            yield from table.filter(pa.array(keep)).to_batches()


class _CellView:
    def __init__(self, table: pa.Table):
        self.tree, self.block, self.low, self.high = (table.column(c).to_numpy() for c in ("tree", "block", "low", "high"))
        prefixes = table.column("prefixes").combine_chunks()
        self.prefixes = prefixes.flatten().to_numpy().reshape(table.num_rows, -1)

    def own_pairs(self, begin: int, end: int) -> np.ndarray:
        """Symmetric matrix of the pairs that the cell answers for."""
        part, tree = slice(begin, end), self.tree[begin]
        keys, block = self.prefixes[part], self.block[part]
        pairs = keys[:, None, tree] == keys[None, :, tree]
        if tree:
            pairs &= ~(keys[:, None, :tree] == keys[None, :, :tree]).any(axis=2)
        low, high = self.low[begin], self.high[begin]
        if low != high:
            pairs &= block[:, None] != block[None, :]
        np.fill_diagonal(pairs, False)
        return pairs


def _verifier(threshold: float, width: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, borders in whole_groups(batches, "cell", 512):
            view, members = _CellView(table), table.column("members").to_numpy()
            names = table.column("set").to_pylist()
            sets = shingle_sets(find_words(table.column("text").combine_chunks()), width)
            out: list[tuple[bytes, int, bytes]] = []
            for begin, end in zip(borders[:-1], borders[1:]):
                linked = view.own_pairs(begin, end) & similar(sets[begin:end], threshold)
                counts = linked @ members[begin:end]
                roots = star_roots(linked, names[begin:end])
                out += [(names[begin + i], int(counts[i]), roots[i]) for i in np.flatnonzero(counts)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.binary()))], ["set", "links", "peer"]
                )

    return verify


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Exact test of all pairs: shared shingles from products of incidence matrices."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    opens = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(opens) - 1
    # Shingles of one set only add nothing to any intersection.
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    common = np.zeros((len(sets), len(sets)))
    step = max(1, MATRIX // len(sets))
    at = 0
    while at < len(column):
        end = int(np.searchsorted(column, column[at] + step, "left"))
        used, place = np.unique(column[at:end], return_inverse=True)
        matrix = np.zeros((len(sets), len(used)), np.float32)
        matrix[owner[at:end], place] = 1
        common += matrix @ matrix.T
        at = end
    return common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9


def star_roots(linked: np.ndarray, names: list[bytes]) -> list[bytes]:
    """The smallest name in the component of every member."""
    order = sorted(range(len(names)), key=names.__getitem__)
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    label = rank.copy()
    while True:
        near = np.where(linked, label[None, :], len(names)).min(axis=1)
        now = np.minimum(label, near)
        if (now == label).all():
            return [names[order[i]] for i in label]
        label = now

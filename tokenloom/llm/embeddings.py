"""Embedding near-duplicates: exact pairs of a label above a cosine, by cover trees.

1. Equal vectors of a label form a class; below, a class is one vector with a number of members.
2. The upper levels of the tree: a large label is divided among centres, each vector goes to its nearest one, and
   pairs of cells are left out by their covering radii. Radii halve from level to level: a cell of more than `SPLIT` blocks
   that is wider than a level's radius is divided among centres of its own, its vectors descend, and of the near pairs of
   cells only the near pairs of their children are followed. Each level's vectors, cells and pairs are written tables, and the
   levels end where a radius falls below half the distance sought, whatever the size of the data.
3. A cell, or a block of a large one, is a task's tree; the dual traversal of two trees finds the exact pairs.
   A task returns per class the number of its links and one neighbour of a spanning star, never the pairs.
4. Components of the stars give `component_id`.

Vectors that are null, empty, zero or hold null or non-finite values, and rows with a null label, link with nothing and are their
own component. Vectors of one label but different lengths never link. Repeated rows are vectors like
others. Rows with a null id link as others do and name a component only if it has no other id; where no id
is known `component_id` is null. Tables may be empty; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tokenloom.llm.components import components
from tokenloom.llm.covertree import WIDEST, build, distances, near_cells, near_pairs, reach
from tokenloom.llm.groups import whole_groups
from tokenloom.llm.storage import written

COSINE = 0.98
# Vectors of a cell, or of a block of one, that a task takes from either side.
BLOCK = 2048
# Most centres of the first level, of all labels together; they go to every task.
CENTRES = 512
# Blocks of a cell beyond which it is divided, and the most children of a cell.
SPLIT = 8
FAN = 16
# Vectors of a cell that descend in one task, on average.
PIECE = 8192
# Stands for the child of a vector that has none yet, after those of all centres.
VECTOR = (1 << 31) - 1
# Vectors per centre, on average, among which the centres of a label are chosen.
CHOICES = 8

# The label keeps its own type.
CELL_TYPE = "`class` binary, label {label}, size int, vector binary, cell long, away double, members long"
PAIR_TYPE = "label {label}, size int, low long, high long, low_blocks int, high_blocks int"
CELL = ["label", "size", "cell"]
UNIT_TYPE = "id long, label {label}, vector binary, size int, `class` binary"


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors as bytes of doubles; null where a vector or its label links with nothing."""
    for batch in batches:
        labels, listed = batch.column(1), batch.column(2)
        vectors, sizes, classes = [], [], []
        for label, vector in zip(labels, listed):
            unit = None
            if label.is_valid and vector.is_valid and len(vector) and not vector.values.null_count:
                values = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                largest = np.abs(values).max()
                if np.isfinite(largest) and largest > 0:
                    scaled = values / largest + 0.0
                    unit = scaled / np.sqrt(scaled @ scaled)
            vectors.append(unit.tobytes() if unit is not None else None)
            sizes.append(len(unit) if unit is not None else None)
            # Equal vectors, not only equal directions: rounding must not decide about a class.
            name = None if unit is None else blake2b(b"%r:" % (label.as_py(),) + values.tobytes(), digest_size=16).digest()
            classes.append(name)
        columns = [batch.column(0), labels, pa.array(vectors, pa.binary()), pa.array(sizes, pa.int32()), pa.array(classes, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "label", "vector", "size", "class"])


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(v.as_buffer(), np.float64) for v in column])


def label_type(table: DataFrame) -> str:
    return table.schema["label"].dataType.simpleString()


class Cells:
    """Centres of the large labels, and which pairs of their cells may hold near vectors."""

    def __init__(self, classes: DataFrame, cosine: float):
        sizes = classes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n"))
        total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
        self.block = BLOCK
        # Vectors a centre of the first level stands for: at most CENTRES groups have more.
        share = max(BLOCK, -(-total // CENTRES))
        large = sizes.where(F.col("n") > share)
        wanted = F.ceil(F.col("n") / share).cast("int")
        # 53 bits of the hash, against the share of a label's classes that are choices: a filter, nothing is shuffled or ranked.
        draw = F.shiftrightunsigned(F.xxhash64("class"), 11) / F.lit(2.0**53)
        choices = (
            classes.join(F.broadcast(large.withColumn("wanted", wanted)), ["label", "size"])
            .where(draw < CHOICES * F.col("wanted") / F.col("n"))
            .orderBy("label", "size", F.xxhash64("class"), "class")
            .select("label", "size", "wanted", "vector")
            .collect()
        )
        self.centres: dict[tuple, np.ndarray] = {}
        for key in dict.fromkeys((r["label"], r["size"]) for r in choices):
            own = [r for r in choices if (r["label"], r["size"]) == key]
            self.centres[key] = _spread(np.stack([np.frombuffer(r["vector"]) for r in own]), own[0]["wanted"])
        label = label_type(classes)
        self.placed = written(classes.mapInArrow(_placer(self.centres), CELL_TYPE.format(label=label)), "cells")
        rows = [Row(label=k[0], size=k[1], cell=i, centre=c.tobytes()) for k, cs in self.centres.items() for i, c in enumerate(cs)]
        named = classes.sparkSession.createDataFrame(rows, f"label {label}, size int, cell long, centre binary")
        counted = self.placed.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"))
        # At most CENTRES rows on the right. A cell without a centre is a whole label.
        self.cells = written(counted.join(F.broadcast(named), CELL, "left"), "cell-sizes")
        self.pairs = self._near(cosine)
        level = WIDEST / 2
        while level >= reach(cosine) / 2:
            self._descend(level, cosine)
            level /= 2

    def _blocks(self) -> Column:
        return F.ceil(F.col("n") / self.block).cast("int")

    def _near(self, cosine: float) -> DataFrame:
        """(`label`, `size`, `low`, `high`, `low_blocks`, `high_blocks`) of the cell pairs; a small label is one cell."""
        blocks = self._blocks().alias("blocks")
        known = self.cells.where("cell >= 0").select(*CELL, blocks, "radius").collect()
        rows = []
        for key, centres in self.centres.items():
            own = {r["cell"]: r for r in known if (r["label"], r["size"]) == key}
            names = sorted(own)
            for i, j in near_cells(centres[names], np.array([own[c]["radius"] for c in names]), cosine):
                a, b = own[names[i]], own[names[j]]
                rows.append(Row(label=key[0], size=key[1], low=a["cell"], high=b["cell"], low_blocks=a["blocks"], high_blocks=b["blocks"]))
        listed = self.placed.sparkSession.createDataFrame(rows, PAIR_TYPE.format(label=label_type(self.placed)))
        small = self.cells.where("cell < 0").select(
            "label", "size", F.col("cell").alias("low"), F.col("cell").alias("high"), blocks.alias("low_blocks"), blocks.alias("high_blocks")
        )
        return written(listed.unionAll(small), "cell-pairs")

    def _descend(self, level: float, cosine: float) -> None:
        """Divides the large cells that are wider than `level`; afterwards the pairs are those of the new cells."""
        large = self.cells.where((F.col("n") > SPLIT * self.block) & (F.col("radius") > level))
        if large.isEmpty():
            return
        wanted = F.least(F.lit(FAN), self._blocks()).alias("wanted")
        large = written(large.select(*CELL, "n", wanted, F.ceil(F.col("n") / PIECE).cast("int").alias("pieces")), "large-cells")
        inside = self.placed.join(large, CELL)
        draw = F.shiftrightunsigned(F.xxhash64("class", F.lit(level)), 11) / F.lit(2.0**53)
        choices = inside.where(draw < CHOICES * F.col("wanted") / F.col("n")).select(*CELL, "wanted", "class", "vector")
        grouped = choices.withColumn("task", F.xxhash64(*CELL)).repartition("task").sortWithinPartitions("task", "class")
        label = label_type(self.placed)
        centres = written(grouped.mapInArrow(_centres, f"label {label}, size int, cell long, child int, centre binary"), "centres")
        # A task's centres come before its vectors.
        sent = centres.join(large, CELL).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        task = F.xxhash64(*CELL, "piece").alias("task")
        first = sent.select(task, "child", F.lit(b"").alias("class"), "label", "size", F.col("centre").alias("vector"), "cell", F.lit(0.0).alias("away"), F.lit(0).cast("long").alias("members"))
        falling = inside.withColumn("piece", F.pmod(F.xxhash64("class"), F.col("pieces")).cast("int"))
        rest = falling.select(task, F.lit(VECTOR).alias("child"), "class", "label", "size", "vector", "cell", "away", "members")
        tasks = first.unionAll(rest).repartition("task").sortWithinPartitions("task", "child")
        moved = written(tasks.mapInArrow(_fallen, f"{CELL_TYPE.format(label=label)}, child int"), "fallen")
        name = F.when(F.col("child") < 0, F.col("cell")).otherwise(F.xxhash64(*CELL, "child"))
        fallen = moved.withColumn("parent", F.col("cell")).withColumn("cell", name)
        kept = self.placed.join(large, CELL, "left_anti")
        self.placed = written(fallen.select(*kept.columns).unionAll(kept), "cells")
        sizes = fallen.groupBy(*CELL, "parent").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"))
        named = centres.select("label", "size", F.xxhash64(*CELL, "child").alias("cell"), "centre")
        born = sizes.join(named, CELL, "left").select(*CELL, "n", "radius", "centre", "parent")
        whole = self.cells.join(large, CELL, "left_anti").select(*CELL, "n", "radius", "centre", F.col("cell").alias("parent"))
        family = written(born.unionAll(whole), "cell-sizes")
        self.pairs = self._followed(family, cosine)
        self.cells = family.drop("parent")

    def _followed(self, family: DataFrame, cosine: float) -> DataFrame:
        """The near pairs of the children of near cells: of the lower cell's with the higher cell, then with its children."""
        ends = [F.col("cell"), self._blocks().alias("blocks"), "radius", "centre"]
        label = label_type(self.placed)
        old = self.cells.select("label", "size", F.col("cell").alias("high"), F.struct(*ends).alias("b"))
        child = family.select("label", "size", F.col("parent"), F.struct(*ends).alias("end"))
        low = child.withColumnsRenamed({"parent": "low", "end": "a"})
        high = child.withColumnsRenamed({"parent": "high", "end": "b"})
        slim = self.pairs.select("label", "size", "low", "high")
        near = _near_ends(reach(cosine))
        half = slim.join(low, ["label", "size", "low"]).join(old, ["label", "size", "high"])
        half = written(half.mapInArrow(near, half.schema), "half-pairs").drop("b")
        both = half.join(high, ["label", "size", "high"]).where((F.col("low") != F.col("high")) | (F.col("a.cell") <= F.col("b.cell")))
        found = both.mapInArrow(near, both.schema)
        return written(
            found.select("label", "size", *[F.col(c).alias(n) for c, n in (("a.cell", "low"), ("b.cell", "high"), ("a.blocks", "low_blocks"), ("b.blocks", "high_blocks"))]),
            "cell-pairs",
        )


def _near_ends(within: float):
    """Keeps the rows whose cells `a` and `b` may hold a pair; a cell without a centre may hold one with any."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            radii = a.field("radius").to_numpy() + b.field("radius").to_numpy() + within
            keep = [
                not u.is_valid or not v.is_valid or float(distances(_row(u), _row(v))[0, 0]) <= radius
                for u, v, radius in zip(a.field("centre"), b.field("centre"), radii)
            ]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return near


def _row(vector: pa.Scalar) -> np.ndarray:
    return np.frombuffer(vector.as_buffer(), np.float64)[None, :]


def _centres(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Centres of every cell, far from each other, out of its choices."""
    for table, borders in whole_groups(batches, "task"):
        for begin, end in zip(borders[:-1], borders[1:]):
            own = table.slice(begin, end - begin).combine_chunks()
            picked = _spread(_matrix(own.column("vector")), own.column("wanted")[0].as_py())
            same = own.slice(0, 1).take(pa.array([0] * len(picked)))
            columns = [*[same.column(c).combine_chunks() for c in CELL], pa.array(range(len(picked)), pa.int32()), pa.array([c.tobytes() for c in picked], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*CELL, "child", "centre"])


def _fallen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every vector with the nearest of its task's centres and the distance; -1 where the cell has none."""
    for table, borders in whole_groups(batches, "task"):
        for begin, end in zip(borders[:-1], borders[1:]):
            own = table.slice(begin, end - begin)
            centres = int((own.column("child").to_numpy() < VECTOR).sum())
            rows = own.slice(centres).combine_chunks()
            if not rows.num_rows:
                continue
            child, away = np.full(rows.num_rows, -1, np.int32), rows.column("away").to_numpy()
            if centres:
                far = distances(_matrix(rows.column("vector")), _matrix(own.slice(0, centres).column("vector")))
                child, away = far.argmin(axis=1).astype(np.int32), far.min(axis=1)
            names = ["class", "label", "size", "vector", "cell"]
            columns = [*[rows.column(n).combine_chunks() for n in names], pa.array(away), rows.column("members").combine_chunks(), pa.array(child)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "away", "members", "child"])


def _spread(choices: np.ndarray, wanted: int) -> np.ndarray:
    """Centres far from each other: each next one is the choice farthest from those before."""
    picked = [0]
    away = distances(choices[:1], choices)[0]
    while len(picked) < min(wanted, len(choices)):
        picked.append(int(away.argmax()))
        away = np.minimum(away, distances(choices[picked[-1:]], choices)[0])
    return choices[picked]


def _placer(centres: dict[tuple[int, int], np.ndarray]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(batch.column("label").to_pylist(), batch.column("size").to_pylist()))
            cell, away = np.full(len(keys), -1, np.int64), np.full(len(keys), WIDEST)
            for key in set(keys) & centres.keys():
                rows = np.array([i for i, k in enumerate(keys) if k == key])
                far = distances(_matrix(batch.column("vector").take(pa.array(rows))), centres[key])
                cell[rows], away[rows] = far.argmin(axis=1), far.min(axis=1)
            names = ["class", "label", "size", "vector"]
            columns = [batch.column(n) for n in names] + [pa.array(cell), pa.array(away), batch.column("members")]
            yield pa.RecordBatch.from_arrays(columns, [*names, "cell", "away", "members"])

    return place


def _joined(cosine: float):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, borders in whole_groups(batches, "task"):
            for begin, end in zip(borders[:-1], borders[1:]):
                yield from _links(table.slice(begin, end - begin).combine_chunks(), cosine)

    return join


def _links(task: pa.Table, cosine: float) -> Iterator[pa.RecordBatch]:
    vectors, side = _matrix(task.column("vector")), task.column("side").to_numpy()
    members, names = task.column("members").to_numpy(), task.column("class").to_pylist()
    left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
    itself = bool((side == 0).all())
    if not len(left) or not len(right):
        return
    tree = build(vectors[left])
    other = tree if itself else build(vectors[right])
    order = np.argsort(np.array(names, dtype="S16"), kind="stable")
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    counts = np.zeros(len(names), np.int64)
    root = np.arange(len(names))
    # Folded as they come: the pairs of two dense blocks are never held together.
    for i, j in near_pairs(vectors[left], tree, vectors[right], other, cosine, itself):
        i, j = left[i], right[j]
        np.add.at(counts, i, members[j])
        np.add.at(counts, j, members[i])
        root = _united(root, rank[i], rank[j])
    if not counts.any():
        return
    linked = np.flatnonzero(counts)
    columns = [
        pa.array([names[x] for x in linked], pa.binary()),
        pa.array(counts[linked]),
        pa.array([names[order[root[rank[x]]]] for x in linked], pa.binary()),
    ]
    yield pa.RecordBatch.from_arrays(columns, ["class", "links", "peer"])


def _united(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """`root`, where every entry names the smallest of its component, after the links of `i` with `j`."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not ((up := root[root]) == root).all():
            root = up


def near_vectors(
    table: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """One row per vector: `vec_id`, `n_links`, `component_id` and `kept`."""
    slim = table.select(table[vec_id].cast("long").alias("id"), table[label].alias("label"), table[embedding].alias("v"))
    rows = written(slim.mapInArrow(_units, UNIT_TYPE.format(label=label_type(slim))), "units")
    classes = rows.where("`class` is not null").groupBy("class").agg(
        F.any_value("label").alias("label"), F.any_value("size").alias("size"), F.any_value("vector").alias("vector"), F.count(F.lit(1)).alias("members")
    )
    cells = Cells(written(classes, "classes"), cosine)
    block_of = lambda n: F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
    placed, pairs = cells.placed, cells.pairs

    def taken(own: str, other: str, side: int) -> DataFrame:
        # A block of one cell meets every block of the other; of its own cell, only those from itself on.
        joined = placed.join(pairs.withColumn("cell", F.col(own)), ["label", "size", "cell"])
        spread = joined.withColumn("mine", block_of(f"{own}_blocks")).withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
        low, high = ("mine", "theirs") if side == 1 else ("theirs", "mine")
        return (
            spread.where((F.col("low") != F.col("high")) | (F.col(low) <= F.col(high)))
            .withColumn("alone", (F.col("low") == F.col("high")) & (F.col(low) == F.col(high)))
            .withColumn("side", F.when(F.col("alone"), F.lit(0)).otherwise(F.lit(side)).cast("int"))
            .withColumn("task", F.xxhash64("label", "size", "low", "high", low, high))
            .where(~F.col("alone") | F.lit(side == 1))
            .select("task", "side", "class", "vector", "members")
        )

    tasks = taken("low", "high", 1).unionAll(taken("high", "low", 2)).repartition("task").sortWithinPartitions("task")
    links = written(tasks.mapInArrow(_joined(cosine), "`class` binary, links long, peer binary"), "links")
    counted = links.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(links.select("class", "peer").distinct(), "class", "peer").withColumnRenamed("vertex", "class")
    firsts = rows.where("`class` is not null").groupBy("class").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("members"))
    found = firsts.join(counted, "class", "left").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    # Written, as the classes below: joins on a hot component or class then read two plain shuffles, which Spark splits.
    found = written(found, "found")
    ids = written(found.groupBy("root").agg(F.min("first").alias("component_id")), "components")
    per_class = found.join(ids, "root").select("class", "component_id", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"))
    linked = rows.where("`class` is not null").select("id", "class").join(written(per_class, "per-class"), "class").select("id", "n_links", "component_id")
    alone = rows.where("`class` is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionAll(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )

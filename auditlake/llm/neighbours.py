"""Near-duplicates of embeddings by product quantisation, without a lost link.

Vectors are scaled to length one; a cosine of at least the threshold is then a distance of
at most ``t``. Equal vectors of a label are one class, of which one takes part. Coarse
centroids and, on the residuals to them, a codebook for each subspace are fitted in numpy on
a sample of about ``SAMPLE`` classes drawn by hash. Every class then gets its inverted list,
the codes of its residual and the length of what the codes leave.

A class visits the lists whose border with its own is at most t/2 away. Of two linked
vectors in different lists at least one lies so near to the border between these lists, so
the probes suffice, and no link is missed. Visitors meet the members of a list by an
asymmetric distance, looked up in tables of the visitor's products with the codebooks; a
member stays a candidate unless that distance exceeds t by more than the length its codes
leave, and each candidate is confirmed by its exact cosine in double precision. Members
within t/2 of their centroid are all linked with one another and are counted, not compared.

Lists are put in an order in which like ones are close and are cut into groups by the number
of rows of a label; a group too large for one task is cut into blocks by hash, which the
group's own members visit too. A task holds one block and streams the visitors through it.
It sends on one count for each class and one edge to its component, never the pairs.

NULL, empty and zero vectors, and those with a NULL or not finite component or without a
label, link with nothing; neither do vectors of unlike length. A row without an id links
with nothing and is kept. Rows that share an id are one node of a component, also with
unlike vectors, and have the links of their own vector. Repeated rows link with each other.
An empty table gives an empty one. Columns other than the three named play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.llm.components import components
from auditlake.llm.native import joined_by_key, table

THRESHOLD = 0.93
SAMPLE, MOST_LISTS, SUBSPACES, CODES, TURNS = 20_000, 1_024, 8, 64, 8
BLOCK, SLICE, PAIRS_AT_ONCE = 4_096, 1_024, 100_000
SLACK = 1e-6


@dataclass
class Model:
    """Centroids, their order as ``rank``, and a codebook for each subspace."""

    t: float
    centroids: np.ndarray
    rank: np.ndarray
    codebooks: np.ndarray

    @property
    def width(self) -> int:
        return self.centroids.shape[1]

    def to_centroids(self, units: np.ndarray) -> np.ndarray:
        """Squared distances."""
        return _squared(units, self.centroids)

    def groups_of(self, lists: np.ndarray, level: int) -> np.ndarray:
        return (self.rank[lists].astype(np.int64) << level) // len(self.rank)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(1)[:, None] - 2 * (a @ b.T) + (b**2).sum(1)[None, :], 0)


def _units(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of length one, filled up with zeros to a common width."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(offsets)
    out = np.zeros((len(column), width))
    if len(sizes) and (sizes == sizes[0]).all():
        out[:, : sizes[0]] = flat[offsets[0] : offsets[-1]].reshape(len(sizes), -1)
    else:
        for i, (low, size) in enumerate(zip(offsets, sizes, strict=False)):
            out[i, :size] = flat[low : low + size]
    # scaled by the largest component first, so that no square leaves the range of doubles
    out /= np.abs(out).max(1, keepdims=True, initial=0)
    return out / np.sqrt((out**2).sum(1, keepdims=True))


def _means(points: np.ndarray, wanted: int, turns: int = TURNS) -> np.ndarray:
    """Plain k-means from the first distinct points."""
    centres = np.unique(points[: 2 * wanted], axis=0)
    centres = centres[np.random.default_rng(5).permutation(len(centres))[:wanted]]
    for _ in range(turns):
        own = _squared(points, centres).argmin(1)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        used = counts > 0
        centres[used] = sums[used] / counts[used][:, None]
    return centres


def _apart(centres: np.ndarray, least: float) -> np.ndarray:
    """Centres of which none is nearer than ``least`` to one before it."""
    near = _squared(centres, centres) < least**2
    kept: list[int] = []
    for i in range(len(centres)):
        if not near[i, kept].any():
            kept.append(i)
    return centres[kept]


def _ordered(centres: np.ndarray) -> np.ndarray:
    """Ranks in which like centres are close, by halving along the widest direction."""
    rank, pending, place = np.empty(len(centres), np.int64), [np.arange(len(centres))], 0
    while pending:
        rows = pending.pop()
        if len(rows) == 1:
            rank[rows[0]] = place
            place += 1
            continue
        own = centres[rows] - centres[rows].mean(0)
        along = own @ np.linalg.svd(own, full_matrices=False)[2][0]
        order = rows[np.argsort(along, kind="stable")]
        pending += [order[len(order) // 2 :], order[: len(order) // 2]]
    return rank


def fit(units: np.ndarray, rows: int, threshold: float = THRESHOLD) -> Model:
    """Model for so many rows from a sample of unit vectors."""
    t = float(np.sqrt(2 - 2 * threshold)) + 1e-9
    lists = int(min(MOST_LISTS, len(units), max(1, round(np.sqrt(rows)))))
    # two centroids in one cluster of linked vectors would only tear it apart
    centroids = _apart(_means(units, lists), t)
    residuals = units - centroids[_squared(units, centroids).argmin(1)]
    parts = np.split(residuals, SUBSPACES, axis=1)
    codebooks = np.zeros((SUBSPACES, CODES, parts[0].shape[1]))
    for k, part in enumerate(parts):
        found = _means(part, CODES)
        codebooks[k] = found[np.arange(CODES) % len(found)]
    return Model(t, centroids, _ordered(centroids), codebooks)


def encode(model: Model, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Home list, codes, what the codes leave, and the lists to reach, of unit vectors.

    The home list is reached by those that are not sure to be linked with all near its
    centroid.
    """
    away = model.to_centroids(units)
    home = away.argmin(1)
    every = np.arange(len(units))
    nearest = away[every, home]
    between = np.sqrt(_squared(model.centroids, model.centroids))
    reach = away - nearest[:, None] <= model.t * between[home] + SLACK
    reach[every, home] = nearest > (model.t / 2 - SLACK) ** 2
    residuals = units - model.centroids[home]
    codes = np.empty((len(units), SUBSPACES), np.uint8)
    left = np.zeros(len(units))
    for k, part in enumerate(np.split(residuals, SUBSPACES, axis=1)):
        apart = _squared(part, model.codebooks[k])
        codes[:, k] = apart.argmin(1)
        left += ((part - model.codebooks[k][codes[:, k]]) ** 2).sum(1)
    return home, codes, np.sqrt(left), reach


def _usable(vector: Column) -> Column:
    value = lambda x: x.cast("double")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(value(x)) & (F.abs(value(x)) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: value(x) != 0), F.lit(False))


CODED = "home int, core boolean, code binary, rest double, reach binary, own int, groups array<int>"


def _coded(classes: DataFrame, model: Model) -> DataFrame:
    """Classes with their list and codes, their own group and the groups they reach."""
    shared = classes.sparkSession.sparkContext.broadcast(model)
    names = classes.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for low in range(0, whole.num_rows, SLICE):
                batch = whole.slice(low, SLICE)
                home, codes, rest, reach = encode(m, _units(batch.column("vector"), m.width))
                levels = batch.column("level").to_numpy()
                own = np.empty(len(home), np.int64)
                groups: list = [None] * len(home)
                for level in np.unique(levels):
                    at = np.flatnonzero(levels == level)
                    group_of = m.groups_of(np.arange(len(m.rank)), int(level))
                    own[at] = group_of[home[at]]
                    touched = np.zeros((len(at), 1 << int(level)), bool)
                    i, lists = np.nonzero(reach[at])
                    touched[i, group_of[lists]] = True
                    for i, row in zip(at, touched, strict=True):
                        groups[i] = np.flatnonzero(row)
                added = [
                    pa.array(home, pa.int32()),
                    pa.array(~reach[np.arange(len(home)), home]),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(rest),
                    pa.array([r.tobytes() for r in np.packbits(reach, axis=1)], pa.binary()),
                    pa.array(own, pa.int32()),
                    pa.array(groups, pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*names, *(x.split()[0] for x in CODED.split(", "))])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    return classes.mapInArrow(work, f"{kinds}, {CODED}")


class _Rows:
    """What the comparison needs of some coded rows."""

    def __init__(self, model: Model, batch: pa.RecordBatch):
        n = batch.num_rows
        self.batch = batch
        self.units = _units(batch.column("vector"), model.width)
        self.home = batch.column("home").to_numpy()
        self.codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, SUBSPACES)
        self.rest = batch.column("rest").to_numpy()
        bits = np.frombuffer(b"".join(batch.column("reach").to_pylist()), np.uint8).reshape(n, -1)
        self.reach = np.unpackbits(bits, axis=1, count=len(model.rank)).astype(bool)
        self.weight = batch.column("weight").to_numpy()
        self.order = batch.column("own").to_numpy().astype(np.int64) << 32 | batch.column("own_block").to_numpy()
        self.links = np.zeros(n, np.int64)

    def said(self) -> pa.RecordBatch | None:
        at = np.flatnonzero(self.links)
        if not len(at):
            return None
        classes = self.batch.column("cls").take(pa.array(at))
        none = pa.nulls(len(at), self.batch.column("node").type)
        return pa.RecordBatch.from_arrays([classes, pa.array(self.links[at]), none, none], ["cls", "links", "a", "b"])


def _least_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of the component of each of ``n`` nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(model: Model, held: _Rows, guests: _Rows, threshold: float, numbers: np.ndarray | None = None):
    """Count the links between guests and held rows, each pair once, and yield them.

    A pair is compared where one reaches the list of the other. Where each reaches the
    other's, it is where the held row's place comes first; ``numbers`` are the places of the
    guests among the held rows, where they are some of them.
    """
    own = np.arange(len(held.home)) if numbers is not None else held.order
    at = numbers if numbers is not None else guests.order
    to_lists = model.to_centroids(guests.units)
    products = np.stack(
        [part @ book.T for part, book in zip(np.split(guests.units, SUBSPACES, axis=1), model.codebooks, strict=True)], axis=1
    ).astype(np.float32)
    order = np.argsort(held.home, kind="stable")
    for members in np.split(order, np.flatnonzero(np.diff(held.home[order])) + 1):
        home = int(held.home[members[0]])
        visitors = np.flatnonzero(guests.reach[:, home])
        if not len(visitors):
            continue
        back = held.reach[members][:, guests.home[visitors]].T
        asked = ~back | (own[members][None, :] < at[visitors][:, None])
        codes = held.codes[members]
        looked_up = np.zeros((len(visitors), len(members)), np.float32)
        constant = np.zeros(len(members))
        for k in range(SUBSPACES):
            looked_up += products[visitors, k][:, codes[:, k]]
            entries = model.codebooks[k][codes[:, k]]
            centre = np.split(model.centroids[home], SUBSPACES)[k]
            constant += (entries**2).sum(1) + 2 * (entries @ centre)
        apart = to_lists[visitors, home][:, None] + constant[None, :] - 2 * looked_up
        asked &= apart <= ((model.t + held.rest[members]) ** 2 + 1e-4)[None, :]
        v, h = np.nonzero(asked)
        if not len(v):
            continue
        if len(v) * 8 > asked.size:
            hit = (guests.units[visitors] @ held.units[members].T)[v, h] >= threshold
        else:
            hit = np.concatenate(
                [
                    np.einsum("ij,ij->i", guests.units[visitors[v[low : low + PAIRS_AT_ONCE]]], held.units[members[h[low : low + PAIRS_AT_ONCE]]])
                    for low in range(0, len(v), PAIRS_AT_ONCE)
                ]
            ) >= threshold
        v, h = visitors[v[hit]], members[h[hit]]
        if len(v):
            guests.links += np.bincount(v, weights=held.weight[h], minlength=len(guests.home)).astype(np.int64)
            held.links += np.bincount(h, weights=guests.weight[v], minlength=len(held.home)).astype(np.int64)
            yield v, h


def _meet(model: Model, held: _Rows, guests: _Rows, threshold: float, numbers: np.ndarray | None = None) -> pa.RecordBatch | None:
    """Compare, and give one edge to its component for each linked row."""
    pairs = list(_compare(model, held, guests, threshold, numbers))
    if not pairs:
        return None
    v, h = (np.concatenate(x) for x in zip(*pairs, strict=True))
    # held rows come first in the numbering
    label = _least_linked(len(held.home) + len(guests.home), h, v + len(held.home))
    moved = np.flatnonzero(label != np.arange(len(label)))
    nodes = pa.concat_arrays([held.batch.column("node"), guests.batch.column("node")])
    none = pa.nulls(len(moved), held.batch.column("cls").type)
    edges = [nodes.take(pa.array(moved)), nodes.take(pa.array(label[moved]))]
    return pa.RecordBatch.from_arrays([none, pa.nulls(len(moved), pa.int64()), *edges], ["cls", "links", "a", "b"])


def _swept(model: Model, batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Counts and edges of cells that come one after another, held rows before guests."""
    cell, waiting, held = None, [], None

    def settle() -> Iterator[pa.RecordBatch]:
        """Compare the held rows of a cell with each other."""
        nonlocal held, waiting
        whole = pa.Table.from_batches(waiting).combine_chunks().to_batches()
        waiting = []
        if not whole:
            return
        held = _Rows(model, whole[0])
        for low in range(0, whole[0].num_rows, SLICE):
            guests = _Rows(model, whole[0].slice(low, SLICE))
            found = _meet(model, held, guests, threshold, np.arange(low, low + len(guests.home)))
            if found is not None:
                yield found
                held.links[low : low + len(guests.home)] += guests.links

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal held
        if waiting:
            yield from settle()
        if held is not None and (said := held.said()) is not None:
            yield said
        held = None

    for batch in batches:
        cells, visiting = batch.column("cell"), batch.column("visitor").to_numpy()
        changed = pc.not_equal(cells.slice(1), cells.slice(0, max(len(cells) - 1, 0))).to_numpy(zero_copy_only=False).astype(bool)
        cuts = np.flatnonzero(changed | (np.diff(visiting) != 0)) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if low == high:
                continue
            if cells[low].as_py() != cell:
                yield from close()
                cell = cells[low].as_py()
            own = batch.slice(low, high - low)
            if not visiting[low]:
                waiting.append(own)
                continue
            if waiting:
                yield from settle()
            # a group may have guests and no rows of its own
            for start in range(0, own.num_rows if held is not None else 0, SLICE):
                guests = _Rows(model, own.slice(start, SLICE))
                found = _meet(model, held, guests, threshold)
                if found is not None:
                    yield found
                    if (said := guests.said()) is not None:
                        yield said
    yield from close()


def _cells(coded: DataFrame) -> DataFrame:
    """Held rows and guests with the cell they go to."""
    place = ["label", "size"]
    sizes = coded.groupBy(*place, F.col("own").alias("group")).agg(F.count("*").alias("n"))
    # groups cut into blocks have at least twice as many rows as a block, so they are few
    cut = sizes.filter(F.col("n") > 2 * BLOCK).select(*place, "group", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    cut = F.broadcast(table(cut, "cut-groups"))

    def blocked(rows: DataFrame, group: str) -> DataFrame:
        wide = rows.withColumn("group", F.col(group)).join(cut, [*place, "group"], "left")
        return wide.withColumn("blocks", F.coalesce("blocks", F.lit(1)))

    placed = blocked(coded, "own").withColumn("own_block", F.pmod(F.col("cls.h2"), F.col("blocks")).cast("int")).drop("group", "blocks")
    held = placed.withColumns({"group": F.col("own"), "block": F.col("own_block"), "visitor": F.lit(0)})
    sent = blocked(placed.withColumn("to", F.explode("groups")), "to")
    sent = sent.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = sent.filter((F.col("group") != F.col("own")) | (F.col("block") != F.col("own_block")))
    both = held.unionByName(sent.withColumn("visitor", F.lit(1)).drop("to", "blocks"))
    cell = F.to_json(F.struct("label", "size", "group", "block"))
    return both.select(
        cell.alias("cell"), "visitor", "cls", "node", "weight", "vector", "home", "code", "rest", "reach", "own", "own_block"
    )


def links(classes: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """``(cls, links)`` and ``(a, b)`` of rows of ``label, size, cls, node, weight, vector``.

    ``links`` is the weight of the other classes that a class is linked with, in parts to be
    added up; the edges between nodes connect what links connect.
    """
    spark = classes.sparkSession
    n, widest = classes.agg(F.count("*"), F.max("size")).first()
    node = classes.schema["node"].dataType.simpleString()
    if not n:
        kinds = classes.schema["cls"].dataType.simpleString()
        return spark.createDataFrame([], f"cls {kinds}, links bigint"), spark.createDataFrame([], f"a {node}, b {node}")
    width = -(-widest // SUBSPACES) * SUBSPACES
    # a bounded sample, the same on every run
    drawn = classes.filter(F.pmod(F.col("cls.h1"), F.lit(1 << 20)) * F.lit(n) < F.lit(SAMPLE << 20))
    drawn = drawn.select("cls.h1", "vector").toArrow().sort_by("h1")
    if not drawn.num_rows:
        drawn = classes.orderBy("cls").limit(1).select("vector").toArrow()
    vectors = drawn.column("vector").combine_chunks()
    model = fit(_units(vectors, width), n, threshold)

    # labels of more than a block are few
    large = classes.groupBy("label", "size").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK)
    most = int(np.floor(np.log2(len(model.rank))))
    level = F.least(F.ceil(F.log2(F.col("n") / BLOCK)), F.lit(most)).cast("int")
    large = F.broadcast(table(large.select("label", "size", level.alias("level")), "large-labels"))
    levelled = classes.join(large, ["label", "size"], "left").withColumn("level", F.coalesce("level", F.lit(0)))
    coded = table(_coded(levelled, model), "coded")

    cells = _cells(coded).repartition(-(-n // BLOCK), "cell").sortWithinPartitions("cell", "visitor")
    shared = spark.sparkContext.broadcast(model)
    kinds = f"cls {classes.schema['cls'].dataType.simpleString()}, links bigint, a {node}, b {node}"
    met = table(cells.mapInArrow(lambda batches: _swept(shared.value, batches, threshold), kinds), "met")

    # all near one centroid are linked with one another
    core = coded.filter("core").select(F.to_json(F.struct("label", "size", "home")).alias("list"), "cls", "node", "weight")
    core = table(core, "core")
    sums = core.groupBy("list").agg(F.sum("weight").alias("whole"), F.min("node").alias("least"), F.count("*").alias("n"))
    sums = table(sums, "core-lists")
    core = joined_by_key(core, sums, "list", "n")
    counts = met.filter("cls IS NOT NULL").select("cls", "links")
    counts = counts.unionByName(core.select("cls", (F.col("whole") - F.col("weight")).alias("links")).filter("links > 0"))
    edges = met.filter("a IS NOT NULL").select("a", "b")
    return counts, edges.unionByName(core.select(F.col("node").alias("a"), F.col("least").alias("b")).filter("a <> b"))


def near_duplicates(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """``key, n_links, component_id, kept`` of every row."""
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("vector"))
    hashes = [F.xxhash64(F.lit(seed), "label", "vector").alias(name) for seed, name in ((1, "h1"), (2, "h2"))]
    rows = rows.withColumn("cls", F.when(usable, F.struct(*hashes)))
    classes = rows.filter("cls IS NOT NULL").groupBy("cls").agg(
        F.min("id").alias("node"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("vector").alias("vector")
    )
    classes = table(classes.withColumn("size", F.size("vector")), "classes")
    counts, edges = links(classes, threshold)
    total = counts.groupBy("cls").agg(F.sum("links").alias("links"))
    told = classes.select("cls", "node", "weight").join(total, "cls", "left")
    told = told.select("cls", "node", "weight", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    told = table(told, "class-links")
    named = joined_by_key(table(rows.filter("cls IS NOT NULL").select("id", "cls"), "members"), told, "cls", "weight")
    named = table(named.select("id", "node", "n_links"), "named")
    # what holds different vectors under one id is one node
    shared = named.groupBy("id").agg(F.min("node").alias("b"), F.max("node").alias("top")).filter("b <> top")
    shared = named.join(shared, "id").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()
    found = components(edges.unionByName(shared))
    sizes = named.groupBy("node").agg(F.count("*").alias("n"))
    placed = sizes.join(found, "node", "left").select("node", "n", F.coalesce("component", "node").alias("component_id"))
    linked = joined_by_key(named, table(placed, "placed"), "node", "n")
    alone = rows.filter("cls IS NULL").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    every = linked.select("id", "n_links", "component_id").unionByName(alone)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return every.select(F.col("id").alias(key), F.col("n_links").cast("bigint"), "component_id", kept.alias("kept"))

"""Embedding near-duplicates by PCA-ordered tiles.

Equal vectors collapse to one before anything is compared. The distinct ones
are turned into the axes of their second moments, largest first, sorted by the
first axis and cut into tiles of `TILE` rows. A turn keeps all products, and
two unit vectors of cosine t lie sqrt(2 - 2t) apart at most, so two tiles meet
only if their boxes on the leading axes are no farther apart.

Two tiles that meet are compared in strips. The product over the leading axes
plus the product of the norms of what is left bounds the cosine from above: a
pair whose bound is below the threshold is done. The pairs left over gain the
next axes, with a smaller rest, until the last. A decision within rounding
of the threshold is made again from the vectors as they came, so a pair
links if and only if its cosine in double precision reaches it.

No pair leaves a task: a pair of tiles returns, for each of its rows, the number
of linked rows and the smallest row of its own component of that pair, so its
output is no longer than the two tiles. Those stars are joined to components.

Vectors that are null, empty, zero or hold null or non-finite entries link with
nothing and are components of their own. Shorter vectors count as filled up
with zeros. Repeated rows link with each other, null ids take part but name a
component only if it has no other id (then it is null). An empty table gives
an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from orderloom.llm.common import written
from orderloom.llm.simhash import components
from orderloom.llm.vectors import padded, units
from orderloom.operators.joins import hot_keys, salted_join

COSINE = 0.95

# Rows of a tile and of a strip of it; tiles met by one task of a tile.
TILE = 4096
STRIP = 512
MEETINGS = 32

# Leading axes of each step, and axes of the boxes by which tiles meet.
STEPS = (16, 32)
BOX = 8

# Entries of vectors picked at a time.
PICKED = 1 << 21

# More than what rounding to single precision or turning can change, and than what rounding to double can.
COARSE, FINE = 1e-4, 1e-9


def _usable(vector: str):
    entry_ok = F.forall(vector, lambda e: e.isNotNull() & (F.abs(e) < float("inf")))
    return F.coalesce(entry_ok & F.exists(vector, lambda e: e != 0), F.lit(False))


def _moments(width: int):
    """Second moments of the unit vectors of each batch, as one array a row."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            unit = units(padded(batch, "embedding", width))
            total += unit.T @ unit
        at = np.arange(width * width)
        yield pa.record_batch([pa.array(at), pa.array(total.ravel())], names=["at", "part"])

    return of


def principal_axes(distinct: DataFrame, width: int) -> np.ndarray:
    """Orthonormal axes as columns, by falling second moment; only width * width sums reach the driver."""
    parts = distinct.select("embedding").mapInArrow(_moments(width), "at long, part double")
    total = np.zeros(width * width)
    for r in parts.groupBy("at").agg(F.sum("part").alias("part")).collect():
        total[r.at] = r.part
    return np.linalg.eigh(total.reshape(width, width))[1][:, ::-1]


def _turned(axes: np.ndarray, width: int, box: int):
    """Adds the coordinates on the leading axes."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead = units(padded(batch, "embedding", width)) @ axes[:, :box]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(lead) + 1, dtype=np.int32) * box), pa.array(lead.ravel()))
            yield pa.record_batch([*batch.columns, lists], names=[*batch.schema.names, "lead"])

    return of


def tiles(distinct: DataFrame, axes: np.ndarray, tile: int) -> DataFrame:
    """`distinct` with `tile`, a run of `tile` rows in the order of the first axis, and `lead`; written."""
    width, box = len(axes), min(BOX, len(axes))
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema)
    turned = distinct.mapInArrow(_turned(axes, width, box), f"{kind}, lead array<double>")
    ordered = written(turned.repartitionByRange(F.col("lead")[0], "id").sortWithinPartitions(F.col("lead")[0], "id").withColumn("_at", F.monotonically_increasing_id()), "ordered")
    # One row per written partition: where its rows begin in the whole order.
    part = F.shiftright("_at", 33)
    counts = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    begun = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(counts.select("part", begun.alias("start")))
    place = F.col("start") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return ordered.withColumn("part", part).join(starts, "part").withColumn("tile", F.floor(place / tile)).drop("part", "start", "_at")


def meetings(tiled: DataFrame, threshold: float, box: int) -> DataFrame:
    """Pairs (a, b), b <= a, of tiles whose boxes are near enough to hold a linked pair.

    Tiles are hashed by stretches of the first axis as long as the distance of
    linked vectors; two boxes that near share a stretch or lie in adjacent ones.
    """
    reach = float(np.sqrt(2 - 2 * threshold)) + FINE
    edges = [f(F.col("lead")[k]).alias(f"{name}{k}") for k in range(box) for name, f in (("lo", F.min), ("hi", F.max))]
    boxes = written(tiled.groupBy("tile").agg(*edges), "boxes")
    stretch = lambda c: F.floor(F.col(c) / reach)
    a = boxes.select([F.col(c).alias(f"a_{c}") for c in boxes.columns] + [F.explode(F.sequence(stretch("lo0"), stretch("hi0"))).alias("at")])
    b = boxes.select("*", F.explode(F.sequence(stretch("lo0") - 1, stretch("hi0") + 1)).alias("at"))
    gap = lambda k: F.greatest(F.lit(0.0), F.col(f"lo{k}") - F.col(f"a_hi{k}"), F.col(f"a_lo{k}") - F.col(f"hi{k}"))
    apart = sum((gap(k) * gap(k) for k in range(1, box)), gap(0) * gap(0))
    met = a.join(b, "at").filter((F.col("tile") <= F.col("a_tile")) & (apart <= reach * reach))
    # Dealt to either tile, so that the work is even.
    swap = (F.col("a_tile") + F.col("tile")) % 2 == 1
    return met.select(F.when(swap, F.col("tile")).otherwise(F.col("a_tile")).alias("a"), F.when(swap, F.col("a_tile")).otherwise(F.col("tile")).alias("b")).distinct()


def _bounded(turned: np.ndarray, steps: tuple[int, ...]) -> list[np.ndarray]:
    """Per step the leading coordinates and, as one more, the norm of the rest."""
    return [np.column_stack([turned[:, :k], np.sqrt(np.einsum("ij,ij->i", turned[:, k:], turned[:, k:]))]).astype(np.float32) for k in steps]


class Tile:
    """Rows of a tile: ids, weights, unit vectors as they came and turned, and their bounds by step."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, vectors: np.ndarray, axes: np.ndarray):
        self.ids, self.weights, self.raw = ids, weights, vectors
        self.turned = units(vectors) @ axes
        self.bounds = _bounded(self.turned, tuple(k for k in STEPS if k < len(axes)))


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision, from the vectors as they came, scaled by a power of two against overflow."""
    a, b = (x * np.exp2(-np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) for x in (a, b))
    dot = lambda x, y: np.einsum("ij,ij->i", x, y)
    return dot(a, b) / np.sqrt(dot(a, a) * dot(b, b))


def linked(a: Tile, rows: slice, b: Tile, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of the linked pairs of some rows of `a` and all of `b`."""
    first, few = rows.start, PICKED // a.raw.shape[1]
    i = j = None
    for k, (mine, theirs) in enumerate(zip(a.bounds, b.bounds)):
        if i is None:
            i, j = np.nonzero(mine[rows] @ theirs.T >= threshold - COARSE)
            i += first
        elif len(i) <= few:
            near = np.einsum("ij,ij->i", mine[i], theirs[j]) >= threshold - COARSE
            i, j = i[near], j[near]
    if i is None or len(i) > few:
        # Many pairs are near: whole products are cheaper than picked ones.
        cosines = a.turned[rows] @ b.turned.T
        i, j = np.nonzero(cosines >= threshold - FINE)
        found = cosines[i, j]
        i += first
    else:
        found = np.einsum("ij,ij->i", a.turned[i], b.turned[j])
        near = found >= threshold - FINE
        i, j, found = i[near], j[near], found[near]
    doubtful = np.flatnonzero(found < threshold + FINE)
    kept = np.ones(len(i), bool)
    for at in range(0, len(doubtful), few):
        some = doubtful[at : at + few]
        kept[some] = _exact(a.raw[i[some]], b.raw[j[some]]) >= threshold
    return i[kept], j[kept]


def _joined(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give linked positions the same, smallest label; `labels` point to roots."""
    while True:
        lower, upper = np.minimum(labels[i], labels[j]), np.maximum(labels[i], labels[j])
        apart = lower < upper
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(labels, upper[apart], lower[apart])
        while True:
            roots = labels[labels]
            if np.array_equal(roots, labels):
                break
            labels[:] = roots


def compared(a: Tile, b: Tile | None, threshold: float) -> pa.RecordBatch | None:
    """(id, links, root) of the rows of two tiles that link, or of one with itself; None without links."""
    other = a if b is None else b
    counts = np.zeros(len(a.ids), np.int64), np.zeros(len(other.ids), np.int64)
    labels = np.arange(len(a.ids) + (0 if b is None else len(b.ids)))
    shift = 0 if b is None else len(a.ids)
    for at in range(0, len(a.ids), STRIP):
        i, j = linked(a, slice(at, min(at + STRIP, len(a.ids))), other, threshold)
        if b is None:
            i, j = i[i != j], j[i != j]
        np.add.at(counts[0], i, other.weights[j])
        if b is not None:
            np.add.at(counts[1], j, a.weights[i])
        _joined(labels, i, j + shift)
    ids = a.ids if b is None else np.concatenate([a.ids, b.ids])
    links = counts[0] if b is None else np.concatenate(counts)
    some = links > 0
    if not some.any():
        return None
    return pa.record_batch([pa.array(ids[some]), pa.array(links[some]), pa.array(ids[labels[some]])], names=["id", "links", "root"])


def _compare(axes: np.ndarray, threshold: float):
    """Streams rows sorted by (a, part, b): the rows of tile `a` itself come first, b being -1."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], Tile]]:
        held: list[pa.RecordBatch] = []
        key = None

        def tile() -> Tile:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return Tile(whole.column("id").to_numpy(), whole.column("n").to_numpy(), padded(whole, "embedding", len(axes)), axes)

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("a", "part", "b")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if start == end:
                    continue
                here = tuple(keys[start].tolist())
                if key is not None and here != key:
                    yield key, tile()
                    held = []
                key = here
                held.append(batch.slice(start, end - start))
        if held:
            yield key, tile()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for (_, _, b), tile in runs(batches):
            if b < 0:
                own = tile
                continue
            found = compared(own, None if tile.ids[0] == own.ids[0] else tile, threshold)
            if found is not None:
                yield found

    return of


def links(distinct: DataFrame, threshold: float = COSINE, tile: int = TILE) -> DataFrame:
    """(id, links, root) for linked rows of `distinct` (id, n, embedding): summed weights of the linked rows of a pair of tiles, and a row of the same component."""
    width = distinct.agg(F.max(F.size("embedding"))).first()[0]
    spark = distinct.sparkSession
    if width is None:
        return spark.createDataFrame([], "id long, links long, root long")
    axes = principal_axes(distinct, width)
    tiled = written(tiles(distinct, axes, tile), "tiles")
    met = meetings(tiled, threshold, min(BOX, width))
    rank = F.row_number().over(Window.partitionBy("a").orderBy("b")) - 1
    met = written(met.withColumn("part", F.floor(rank / MEETINGS)), "meetings")
    rows = tiled.select("tile", "id", "n", "embedding")
    own = met.select("a", "part").distinct().join(rows, F.col("a") == F.col("tile")).select("a", "part", F.lit(-1).cast("long").alias("b"), "id", "n", "embedding")
    others = met.join(rows, F.col("b") == F.col("tile")).select("a", "part", "b", "id", "n", "embedding")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A number keeps adaptive execution from merging the tiles into a few tasks.
    dealt = own.unionByName(others).repartition(tasks, "a", "part").sortWithinPartitions("a", "part", "b", "id")
    return dealt.mapInArrow(_compare(axes, threshold), "id long, links long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = COSINE, tile: int = TILE) -> DataFrame:
    """Every row's vec_id, number of linked rows, component and whether it names the component."""
    rows = vectors.select("vec_id", "embedding").withColumn("_vector", F.when(_usable("embedding"), F.col("embedding"))).drop("embedding")
    there = rows.filter(F.col("_vector").isNotNull())
    distinct = there.groupBy(F.col("_vector").alias("embedding")).agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
    distinct = written(distinct.withColumn("id", F.monotonically_increasing_id()), "distinct_vectors")
    found = written(links(distinct.select("id", "n", "embedding"), threshold, tile), "links")
    counted = found.groupBy("id").agg(F.sum("links").alias("links"))
    stars = found.filter("id <> root").select(F.greatest("id", "root").alias("a"), F.least("id", "root").alias("b")).distinct()
    roots = written(components(stars), "vector_roots")
    rooted = distinct.join(roots, F.col("id") == F.col("node"), "left").join(counted, "id", "left")
    rooted = written(rooted.select("embedding", "n", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "id").alias("root")), "rooted_vectors")
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(names, "root").select(F.col("embedding").alias("_vector"), (F.col("links") + F.col("n") - 1).alias("n_links"), F.struct("component_id").alias("_component"))
    joined = salted_join(rows, classes, ["_vector"], hot=hot_keys(there, "_vector"))
    named = joined.withColumn("component_id", F.when(F.col("_component").isNull(), F.col("vec_id")).otherwise(F.col("_component.component_id")))
    return named.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


NEAR_DUPLICATES_SQL = """
WITH RECURSIVE usable AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
    AND len([x FOR x IN embedding IF x <> 0]) > 0
),
near AS (
  SELECT a.id AS a, b.id AS b FROM usable a JOIN usable b ON a.id <> b.id AND list_cosine_similarity(a.v, b.v) >= 0.95
),
reached(id, other) AS (
  SELECT id, id FROM usable
  UNION
  SELECT r.id, n.b FROM reached r JOIN near n ON r.other = n.a
),
component AS (
  SELECT r.id, MIN(u.vec_id) AS component_id FROM reached r JOIN usable u ON r.other = u.id GROUP BY r.id
)
SELECT u.vec_id, (SELECT COUNT(*) FROM near WHERE near.a = u.id) AS n_links, c.component_id, u.vec_id = c.component_id AS kept
FROM usable u JOIN component c ON u.id = c.id
UNION ALL
SELECT vec_id, 0, vec_id, true FROM embeddings e
WHERE NOT EXISTS (SELECT 1 FROM usable u WHERE u.vec_id = e.vec_id)"""

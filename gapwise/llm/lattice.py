"""Near-duplicate vectors by E8 lattice hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.llm.blocks import chunk, dealt, every, whole_blocks
from gapwise.llm.components import components
from gapwise.llm.tables import broadcast_if_small, parts
from gapwise.llm.words import mixed
from gapwise.scratch import materialize

THRESHOLD = 0.93
TABLES = 12
PROBES = 12
SCALE = 1.1  # of the projections; the lattice's nearest points are sqrt(2) apart
BLOCK = 512  # vectors of a cell that one comparison takes on each side
SEED = 8

_HOME, _PROBE = 1, 0


@cache
def _neighbours() -> np.ndarray:
    """The 240 shortest vectors of the lattice."""
    whole = []
    for i, j in combinations(range(8), 2):
        for signs in product((1.0, -1.0), repeat=2):
            vector = np.zeros(8)
            vector[[i, j]] = signs
            whole.append(vector)
    halves = [v for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(whole + halves)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: where the sum is odd, the coordinate that was
    rounded furthest goes to its other neighbour."""
    point = np.rint(x)
    error = x - point
    odd = np.flatnonzero(point.sum(axis=1) % 2)
    worst = np.abs(error[odd]).argmax(axis=1)
    point[odd, worst] += np.where(error[odd, worst] >= 0, 1.0, -1.0)
    return point


def nearest_points(x: np.ndarray) -> np.ndarray:
    """The nearest E8 lattice point of every row: the better of the nearest even-sum integer point
    and the nearest such point shifted by one half."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


@cache
def _projection(dim: int, tables: int, scale: float) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).normal(size=(dim, 8 * tables)) * scale


def sketches(unit: np.ndarray, tables: int, probes: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Per vector and table a number for its home, the nearest lattice point of its projection, and
    which ``probes`` of the 240 points around that are nearest to it."""
    projected = unit @ _projection(unit.shape[1], tables, scale)
    near = _neighbours()
    homes = np.empty((len(unit), tables), np.uint64)
    closest = np.empty((len(unit), tables, probes), np.uint8)
    for t in range(tables):
        x = projected[:, 8 * t : 8 * t + 8]
        home = nearest_points(x)
        closest[:, t] = np.argsort(-((x - home) @ near.T), axis=1, kind="stable")[:, :probes]
        homes[:, t] = _numbers(home)
    return homes, closest


def _numbers(points: np.ndarray) -> np.ndarray:
    """A number per lattice point; that of a sum is the sum of the numbers."""
    factors = np.random.default_rng(SEED).integers(0, 2**63, 8, dtype=np.uint64) | np.uint64(1)
    return (np.rint(points * 2).astype(np.int64).view(np.uint64) * factors).sum(axis=-1, dtype=np.uint64)


@cache
def _moves() -> np.ndarray:
    return _numbers(_neighbours())


def sketched_cells(homes: np.ndarray, closest: np.ndarray, salt: np.ndarray, table: int) -> np.ndarray:
    """Hashes of the cells in one table: the home of each vector, then its neighbours."""
    home = homes[:, table]
    found = np.concatenate([home[:, None], home[:, None] + _moves()[closest[:, table]]], axis=1)
    return mixed(mixed(found + np.uint64(table)) + salt[:, None])


def cells(unit: np.ndarray, salt: np.ndarray, tables: int, probes: int, scale: float) -> np.ndarray:
    """Cell hashes of unit vectors: per vector and table its home and its ``probes`` nearest
    neighbouring cells. ``salt`` keeps groups apart."""
    homes, closest = sketches(unit, tables, probes, scale)
    return np.stack([sketched_cells(homes, closest, salt, t) for t in range(tables)], axis=1)


def _units(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    # Scaled by a power of two, which is exact, so that squares stay finite.
    peak = np.abs(x).max(axis=1, keepdims=True)
    x = np.ldexp(x, -np.frexp(peak)[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vectors(kind: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The vectors that can be linked, as bytes: no null or non-finite component, some not zero."""
        for batch in batches:
            ids, labels, vectors = batch.columns
            lengths = pc.list_value_length(vectors).to_numpy().astype(np.int64)
            flat = vectors.flatten()
            known = flat.is_valid().to_numpy(zero_copy_only=False)
            x = flat.fill_null(0).to_numpy().astype(kind) + np.array(0, kind)  # no negative zero
            ends = np.concatenate([[0], np.cumsum(lengths)])

            def rows_with(mask: np.ndarray) -> np.ndarray:
                before = np.concatenate([[0], np.cumsum(mask)])
                return before[ends[1:]] > before[ends[:-1]]

            good = pa.array(rows_with(x != 0) & ~rows_with(~known | ~np.isfinite(x)))
            size = np.dtype(kind).itemsize
            raw = pa.Array.from_buffers(
                pa.large_binary(), len(ends) - 1, [None, pa.py_buffer((ends * size).tobytes()), pa.py_buffer(x.tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [ids.filter(good), labels.filter(good), raw.filter(good).cast(pa.binary())], names=["vec_id", "label", "vector"]
            )

    return of


def _sketched(kind: str, tables: int, probes: int, scale: float):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Vectors with their salt, which tells labels and lengths apart, and their sketch."""
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                raw = part.column("vector").to_pylist()
                labels = np.array(part.column("salt").to_numpy(), np.int64).view(np.uint64)
                lengths = np.array([len(r) for r in raw])
                salt = mixed(labels + lengths.astype(np.uint64))
                homes, closest = np.empty((len(raw), tables), np.uint64), np.empty((len(raw), tables, probes), np.uint8)
                for length in np.unique(lengths):
                    at = np.flatnonzero(lengths == length)
                    homes[at], closest[at] = sketches(_units([raw[i] for i in at], kind), tables, probes, scale)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("copies"),
                        part.column("vector"),
                        pa.array(salt.view(np.int64)),
                        pa.array([h.tobytes() for h in homes], pa.binary()),
                        pa.array([c.tobytes() for c in closest], pa.binary()),
                    ],
                    names=["id", "copies", "vector", "salt", "homes", "closest"],
                )

    return of


def _stacked(block: pa.RecordBatch | pa.Table, tables: int, probes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    homes, closest = (b"".join(block.column(c).to_pylist()) for c in ("homes", "closest"))
    return (
        np.frombuffer(homes, np.uint64).reshape(-1, tables),
        np.frombuffer(closest, np.uint8).reshape(-1, tables, probes),
        np.array(block.column("salt").to_numpy(), np.int64).view(np.uint64),
    )


def _hashed(tables: int, probes: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                sketch = _stacked(part, tables, probes)
                found = np.stack([sketched_cells(*sketch, t) for t in range(tables)], axis=1)
                role = np.full(found.shape, _PROBE, np.int8)
                role[:, :, 0] = _HOME
                owner = np.repeat(part.column("id").to_numpy(), tables * (1 + probes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.ravel().view(np.int64)), pa.array(owner), pa.array(role.ravel())],
                    names=["cell", "id", "role"],
                )

    return of


class _Side:
    """Vectors on one side of a block: the homes of its cell, or all that look into it."""

    def __init__(self, at: np.ndarray, sketch: tuple[np.ndarray, np.ndarray, np.ndarray]):
        self.sketch = tuple(part[at] for part in sketch)

    def cells(self, table: int) -> np.ndarray:
        return sketched_cells(*self.sketch, table)


def _sees_home(seer: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Which rows of ``seer`` have the home of which rows of ``seen`` among their cells."""
    homes, of = np.unique(seen[:, 0], return_inverse=True)
    place = np.minimum(np.searchsorted(homes, seer), len(homes) - 1)
    rows, columns = np.nonzero(homes[place] == seer)
    sees = np.zeros((len(seer), len(homes)), bool)
    sees[rows, place[rows, columns]] = True
    return sees[:, of]


def _first_meetings(cell: int, left: _Side, right: _Side, near: np.ndarray, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the links in a block those that no earlier table, and no lower cell of this table, has as
    well; and which rows on the right have the cell as their home."""
    now = np.uint64(cell & (2**64 - 1))
    first = _Side(np.array([0]), left.sketch)
    table = next(t for t in range(tables) if first.cells(t)[0, 0] == now)
    near = near.copy()
    for t in range(table):
        if not near.any():
            break
        a, b = left.cells(t), right.cells(t)
        near &= ~(_sees_home(a, b) | _sees_home(b, a).T)
    a, b = left.cells(table), right.cells(table)
    at_home = b[:, 0] == now
    # The home of the right one is another meeting place, if the left one looks into it.
    near &= ~(_sees_home(a, b) & (b[:, 0] < now))
    return near, at_home


def _linked(threshold: float, kind: str, tables: int, probes: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per block and vector with links: the lowest vector that the block's links lead to, and
        how many vectors the links lead to that no other block counts."""
        for block in whole_blocks(batches):
            side = block.column("side").to_numpy()
            if side.min() == side.max():
                continue
            ids, copies = (block.column(c).to_numpy() for c in ("id", "copies"))
            unit = _units(block.column("vector").to_pylist(), kind)
            left, right = np.flatnonzero(side == _HOME), np.flatnonzero(side == _PROBE)
            near = (unit[left] @ unit[right].T >= threshold) & (ids[left][:, None] != ids[right])
            if not near.any():
                continue
            low = ids.copy()
            while True:
                before = low.copy()
                for a, b, link in ((left, right, near), (right, left, near.T)):
                    low[a] = np.minimum(low[a], np.where(link, low[b], np.iinfo(np.int64).max).min(axis=1))
                if (low == before).all():
                    break
            sketch = _stacked(block, tables, probes)
            once, at_home = _first_meetings(
                int(block.column("cell")[0].as_py()), _Side(left, sketch), _Side(right, sketch), near, tables
            )
            # Two homes of the cell meet twice, each time on other sides: the left one is counted.
            n = np.zeros(len(ids), np.int64)
            n[left] = once @ copies[right]
            n[right] += np.where(at_home, 0, copies[left] @ once)
            linked = np.zeros(len(ids), bool)
            linked[left], linked[right] = near.any(axis=1), near.any(axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[linked]), pa.array(low[linked]), pa.array(n[linked])], names=["id", "low", "n"]
            )

    return of


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    probes: int = PROBES,
    scale: float = SCALE,
    block: int = BLOCK,
) -> DataFrame:
    """Every vector with ``n_links``, ``component_id`` and ``kept``.

    Two vectors are linked when they have one label, one length and a cosine of at least
    ``threshold``, computed in double precision. Null labels and identifiers, null, empty or zero
    vectors and those with a null or non-finite component have no links. Rows with one identifier
    and vector are copies like any others. Other columns are ignored.

    Copies of a vector are one vector that counts for all of them. Each table projects the vectors
    at random to eight dimensions and decodes them to lattice points; a vector looks into its own
    cell and the nearest ones around it. All vectors that meet in a cell are compared, those of a
    full cell in blocks that many tasks share. A pair is counted in the first table that brings it
    together, there in the lower of two cells; blocks hand on a count and the lowest linked
    identifier per vector, never pairs. A pair that no table brings together is missed: with the
    default figures about one in a thousand at the threshold, far fewer above it.
    """
    given = vectors.select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vector")
    )
    usable = given.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    single = isinstance(vectors.schema[vector].dataType.elementType, T.FloatType)
    kind = "float32" if single else "float64"
    wide = usable if single else usable.withColumn("vector", F.col("vector").cast("array<double>"))
    raw = wide.mapInArrow(_vectors(kind), "vec_id long, label string, vector binary")
    raw = materialize(raw.withColumn("print", F.xxhash64("label", F.md5("vector"))), "vectors")
    heads = raw.groupBy("print").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    heads = materialize(heads, "heads")
    firsts = heads.select(F.col("print").alias("_print"), F.col("id"), "copies")
    first_rows = (
        raw.join(firsts, (F.col("vec_id") == F.col("id")) & (F.col("print") == F.col("_print")))
        .dropDuplicates(["id"])
        .select("id", "copies", F.xxhash64("label").alias("salt"), "vector")
    )
    sketch = "id long, copies long, vector binary, salt long, homes binary, closest binary"
    distinct = materialize(first_rows.mapInArrow(_sketched(kind, tables, probes, scale), sketch), "distinct")
    met = distinct.select("id", "salt", "homes", "closest").mapInArrow(
        _hashed(tables, probes), "cell long, id long, role byte"
    )
    met = materialize(met, "cells")
    full = (
        met.groupBy(F.col("cell").alias("_cell"))
        .agg(F.sum("role").alias("homes"), F.count("*").alias("rows"))
        .where("homes > 0 AND rows > 1")
        .select(
            "_cell",
            F.ceil(F.col("homes") / block).cast("int").alias("_i"),
            F.ceil(F.col("rows") / block).cast("int").alias("_j"),
        )
    )
    full = materialize(full, "full")
    # A home meets all rows of its cell: it is on the left of one row of blocks, on the right of
    # one column of them.
    seen = met.join(full, F.col("cell") == F.col("_cell"))
    left = seen.where(F.col("role") == _HOME).select(
        "cell", "id", F.lit(_HOME).alias("side"), chunk("i", "id", F.col("_i")).alias("i"), every(F.col("_j")).alias("j")
    )
    right = seen.select(
        "cell", "id", F.lit(_PROBE).alias("side"), every(F.col("_i")).alias("i"), chunk("j", "id", F.col("_j")).alias("j")
    )
    sketched = ("copies", "salt", "vector", "homes", "closest")
    placed = left.unionByName(right).join(
        distinct.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id")
    )
    blocks = dealt(placed.select("cell", "i", "j", "id", "side", *sketched), "cell", parts(vectors))
    found = materialize(
        blocks.mapInArrow(_linked(threshold, kind, tables, probes), "id long, low long, n long"), "links"
    )
    counted = found.groupBy(F.col("id").alias("_linked")).agg(F.sum("n").alias("linked"))
    labels = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")).distinct())
    result = (
        heads.join(counted, F.col("id") == F.col("_linked"), "left")
        .join(labels, F.col("id") == F.col("node"), "left")
        .select(
            F.col("print").alias("_print"),
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("label", "id").alias("component_id"),
        )
        .where("n_links > 0")
    )
    linked = materialize(
        raw.join(broadcast_if_small(materialize(result, "result"), 32), F.col("print") == F.col("_print")).select(
            F.col("vec_id").alias("_vec"), "n_links", "component_id"
        ),
        "linked",
    ).distinct()
    return given.join(broadcast_if_small(linked, 32), F.col("vec_id") == F.col("_vec"), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("_vec").isNull() | (F.col("vec_id") == F.col("component_id")),
    ).toDF("vec_id", "n_links", "component_id", "kept")

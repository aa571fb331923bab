"""Embedding whitening by a tiled covariance.

Entries become whole numbers x = floor(64 c) + 1,000,000, so that sums, means and deviations are exact.
The covariance of the distinct vectors is put together from tiles: the vectors are cut into blocks of
rows and of columns, a shuffle brings the two column blocks of a tile and a row block together, and a
product is made of each. Products of a tile are summed in rounds of a fixed fan-in, so neither a task
nor the driver ever holds more than a few tiles or one row block. The driver gets the finished matrix,
whose size follows from the dimensions alone, and takes its eigenvectors.

Null vectors, and vectors with a null or non-finite entry, are left out. A vector shorter than the
longest counts as if zeros followed. Entries beyond 2^46 in size count as 2^46, far from anything that an
embedding holds. Repeated rows, keys and null keys all stay; an empty table gives an empty result. A
component without variance (fewer distinct vectors than dimensions) has null in ``whitened``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quern.llm.storage import discard, materialize

COMPONENTS = 16
#: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries of 64 c are held within this, so that x stays a whole number in double precision.
LARGEST = float(1 << 52)
#: Column blocks of a covariance at most; each is sent once for each of them.
STRIPES = 4
#: Dimensions of a column block at least.
NARROWEST = 16
#: Bytes of a row block's doubles in one column block, at most.
BLOCK_BYTES = 8 << 20
#: Rows of a row block at most.
BLOCK_ROWS = 4096
#: Products or sums of a tile that one task adds at a time.
FAN_IN = 32
#: Share of the largest eigenvalue below which a component has no variance.
FLAT = 1e-12


@dataclass
class Whitening:
    """What the distinct vectors tell: ``n``, exact column sums of x, eigenvalues by size, unit
    eigenvectors as rows, the trace, and how far the whitened covariance is from the identity."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = field(default=0.0)

    @property
    def scales(self) -> np.ndarray:
        """What a projection is multiplied with; NaN for a component without variance."""
        top = self.values[0] if len(self.values) else 0.0
        alive = self.values > max(top, 0.0) * FLAT
        return np.where(alive, 1.0 / np.sqrt(np.where(alive, self.values, 1.0)), np.nan)


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    return vector.isNotNull() & fine


def whole_numbers(df: DataFrame, vector: str = "embedding", name: str = "x") -> DataFrame:
    """``df`` without unusable vectors, with ``name`` array<long> in place of ``vector``."""
    kept = df.filter(_usable(F.col(vector)))
    width = kept.agg(F.max(F.size(vector)).alias("most"), F.min(F.size(vector)).alias("least")).first()
    most, least = width["most"] or 0, width["least"] or 0
    entry = lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))).cast("long") + SHIFT
    x = F.transform(vector, entry)
    if least < most:
        x = F.concat(x, F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(most) - F.size(vector)))
    return kept.withColumn(name, x)


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    """Rows of equal length as one matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), len(flat) // max(len(column), 1))


def _slices(width: int) -> list[slice]:
    step = max(NARROWEST, math.ceil(width / STRIPES))
    return [slice(at, min(at + step, width)) for at in range(0, width, step)]


def _small(part: np.ndarray) -> np.ndarray:
    """Whole numbers in the narrowest type that holds them; doubles as they are."""
    if part.dtype.kind == "f" or not part.size:
        return part
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= part.min() and part.max() <= np.iinfo(kind).max:
            return part.astype(kind)
    return part


BLOCKS = "block long, stripe int, kind string, rows int, data binary"


def column_blocks(vectors: DataFrame, column: str, width: int, shift: int = 0) -> DataFrame:
    """Row blocks of ``column`` (arrays of ``width``) cut into column blocks. Rows keep their order
    in all column blocks of a row block; ``shift`` is taken off whole numbers first."""
    cuts = _slices(width)
    rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(c.stop - c.start for c in cuts))))
    kind = np.int64 if shift else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen, held, n = TaskContext.get().partitionId(), 0, [], 0

        def cut(many: list[np.ndarray]) -> pa.RecordBatch:
            whole = np.concatenate(many) - (shift or 0.0)
            parts = [np.ascontiguousarray(_small(whole[:, c])) for c in cuts]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + seen] * len(cuts), pa.int64()), pa.array(range(len(cuts)), pa.int32()), pa.array([p.dtype.str for p in parts]),
                    pa.array([len(whole)] * len(cuts), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary()),
                ],
                names=["block", "stripe", "kind", "rows", "data"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                held.append(_matrix(batch.column(0).slice(at, rows), kind))
                n += len(held[-1])
                if n >= rows:
                    yield cut(held)
                    seen, held, n = seen + 1, [], 0
        if held:
            yield cut(held)

    return vectors.select(column).mapInArrow(run, BLOCKS)


def column_sums(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """Rows and exact sums of each dimension of ``x``. Tasks add whole numbers in Python, whose
    integers have no limit, and send one row for each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * width, 0
        for batch in batches:
            whole = _matrix(batch.column(0), np.int64)
            n += len(whole)
            # halves of 32 bits can't overflow a sum of a batch
            high, low = (whole >> 32).sum(axis=0), (whole & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(v) for t, h, v in zip(total, high, low)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([str(t) for t in total]), pa.array([n] * width, pa.int64())], names=["dim", "total", "n"])

    parts = vectors.select("x").mapInArrow(run, "dim int, total string, n long")
    rows = parts.groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()
    by_dim = {r["dim"]: r for r in rows}
    return (rows[0]["n"] if rows else 0), [int(by_dim[d]["total"]) for d in range(width)] if rows else []


TILES = "left int, right int, block long, data binary"


def tile_products(blocks: DataFrame, centre: np.ndarray) -> DataFrame:
    """One row for each tile (pair of column blocks) and row block: the product of the two, each
    less its part of ``centre``, as bytes of doubles."""
    cuts = _slices(len(centre))
    pairs = [[(min(k, j), max(k, j)) for j in range(len(cuts))] for k in range(len(cuts))]
    keys = F.array(*[F.array(*[F.struct(F.lit(a).alias("left"), F.lit(b).alias("right")) for a, b in row]) for row in pairs])
    dealt = blocks.select("*", F.explode(F.element_at(keys, F.col("stripe") + 1)).alias("tile")).select("tile.*", *blocks.columns)

    def multiply(table: pa.Table) -> pa.Table:
        left, right, block = (table.column(c)[0].as_py() for c in ("left", "right", "block"))
        found = {}
        for row in table.select(["stripe", "kind", "rows", "data"]).to_pylist():
            part = np.frombuffer(row["data"], dtype=np.dtype(row["kind"])).reshape(row["rows"], -1)
            found[row["stripe"]] = part.astype(np.float64) - centre[cuts[row["stripe"]]]
        return pa.table({"left": pa.array([left], pa.int32()), "right": pa.array([right], pa.int32()), "block": pa.array([block], pa.int64()), "data": pa.array([(found[left].T @ found[right]).tobytes()], pa.binary())})

    return dealt.groupBy("left", "right", "block").applyInArrow(multiply, TILES)


def _added(tiles: DataFrame, groups: int) -> DataFrame:
    """Sums of a tile's matrices by the block's hash, ``groups`` of each tile."""

    def add(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        total = np.sum([np.frombuffer(r["data"]) for r in rows], axis=0)
        return pa.table({"left": pa.array([rows[0]["left"]], pa.int32()), "right": pa.array([rows[0]["right"]], pa.int32()), "block": pa.array([rows[0]["group"]], pa.int64()), "data": pa.array([total.tobytes()], pa.binary())})

    return tiles.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups))).groupBy("left", "right", "group").applyInArrow(add, TILES)


def covariance(vectors: DataFrame, column: str, n: int, centre: np.ndarray, shift: int = 0) -> np.ndarray:
    """Covariance (divisor ``n``) of ``column`` around ``centre``, which is given less ``shift``."""
    width = len(centre)
    tiles = materialize(tile_products(column_blocks(vectors, column, width, shift), centre), "tiles")
    groups = tiles.filter("left = 0 and right = 0").count() // FAN_IN
    summed = tiles
    while groups > 1:
        summed, groups = _added(summed, groups), groups // FAN_IN
    whole, cuts = np.zeros((width, width)), _slices(width)
    for row in _added(summed, 1).collect():
        part = np.frombuffer(row["data"]).reshape(cuts[row["left"]].stop - cuts[row["left"]].start, -1)
        whole[cuts[row["left"]], cuts[row["right"]]] = part
        whole[cuts[row["right"]], cuts[row["left"]]] = part.T
    discard(tiles)
    return whole / n


def _centre(n: int, sums: list[int]) -> np.ndarray:
    """The mean of x - SHIFT, each correctly rounded from whole numbers."""
    return np.array([(s - SHIFT * n) / n for s in sums])


def learn(whole: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors of ``x``; None where there are none."""
    fit = materialize(whole.select("x").distinct(), "distinct-vectors")
    one = fit.select(F.size("x").alias("w")).first()
    if one is None:
        discard(fit)
        return None
    n, sums = column_sums(fit, one["w"])
    centre = _centre(n, sums)
    spread = covariance(fit, "x", n, centre, SHIFT) if one["w"] else np.zeros((0, 0))
    values, vectors = np.linalg.eigh(spread)
    order = np.argsort(-values, kind="stable")[: min(components, one["w"])]
    model = Whitening(n, sums, np.maximum(values[order], 0.0), vectors[:, order].T.copy(), float(np.trace(spread)))
    alive = int(np.isfinite(model.scales).sum())
    if alive:
        white = project(fit, model).select(F.slice("whitened", 1, alive).alias("w"))
        model.identity_error = float(np.abs(covariance(white, "w", n, np.zeros(alive)) - np.eye(alive)).max())
    discard(fit)
    return model


def project(whole: DataFrame, model: Whitening) -> DataFrame:
    """``whole`` with ``deviation`` (null beyond the range of a long) and ``whitened`` array<double>."""
    n, width = model.n, len(model.sums)
    centre, turn = _centre(n, model.sums), model.vectors.T * model.scales
    rest = [s - SHIFT * n for s in model.sums]
    fits = all(abs(r) < 1 << 62 for r in rest)
    kept = [c for c in whole.columns if c not in ("x", "deviation", "whitened")]
    types = {f.name: f for f in whole.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch.column(batch.schema.get_field_index("x")), np.int64).reshape(batch.num_rows, width) - SHIFT
            largest = max(abs(int(y.min())), abs(int(y.max()))) if y.size else 0
            bound = n * largest + max(map(abs, rest), default=0)
            if fits and bound * bound * max(width, 1) < 1 << 62:
                deviation = ((n * y - np.array(rest, dtype=np.int64)) ** 2).sum(axis=1).tolist()
            else:
                deviation = [sum((n * int(v) - r) ** 2 for v, r in zip(row, rest)) for row in y.tolist()]
            white = (y - centre) @ turn
            flat = white.ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, max(turn.shape[1], 1), dtype=np.int32) if turn.shape[1] else np.zeros(batch.num_rows + 1, dtype=np.int32)), pa.array(flat, pa.float64(), mask=~np.isfinite(flat)))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([d if d < 1 << 63 else None for d in deviation], pa.int64()), lists], names=[*kept, "deviation", "whitened"])

    out = T.StructType([*[types[c] for c in kept], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return whole.mapInArrow(run, out)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """(``key``, ``deviation``, ``whitened``) for each usable row, and the model behind it. Columns
    other than ``key`` and ``vector`` are not carried, so no name can clash."""
    slim = df.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    whole = whole_numbers(slim, "vector").select("key", "x")
    model = learn(whole, components)
    if model is None:
        return whole.select(F.col("key").alias(key), F.lit(None).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")), None
    return project(whole, model).withColumnRenamed("key", key), model


def by_component(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component: ``key``, ``component``, ``n``, ``deviation``,
    ``whitened``, ``explained``, ``identity_error``."""
    white, model = whiten(df, key, vector, components)
    shares = [float(v / model.trace) if model.trace > 0 else 0.0 for v in model.values] if model else []
    explained = F.array(*[F.lit(s) for s in shares]).cast("array<double>")
    return white.select(F.col(key), F.posexplode("whitened").alias("place", "whitened"), "deviation").select(
        key, (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("place")).alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )

"""Near-duplicate embeddings by E8 lattice hashing.

Unit vectors are projected onto random directions, eight at a time, and each
eight coordinates are decoded to the nearest point of the E8 lattice. The
points of a few such blocks together are a cell. Every vector is filed under
its own cell in several tables and asks for its own cell and for those next to
it, in which one block moves to the second nearest point. Vectors that meet are
verified by their exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityframe.llm.graph import components
from entityframe.llm.store import stage
from entityframe.llm.text import mix

COSINE = 0.95
TABLES = 8
BLOCKS = 3
# Lattice units per unit of distance: at cosine 0.95 the projections of a pair into one block
# lie about 0.28 of the lattice's smallest distance apart, and about 0.95 of such pairs meet.
SCALE = 1.25
SEED = 20


def _d8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest and second nearest point of D8, integer points with an even sum."""
    near = np.rint(x)
    error = x - near
    size = np.abs(error)
    step = np.where(error >= 0, 1.0, -1.0)
    rows = np.arange(len(x))
    ranked = np.argsort(-size, axis=1)
    worst, next_worst = ranked[:, 0], ranked[:, 1]
    odd = (near.sum(axis=1).astype(np.int64) & 1).astype(bool)
    one = near.copy()
    one[rows[odd], worst[odd]] += step[rows[odd], worst[odd]]
    two = near.copy()
    two[rows, next_worst] += step[rows, next_worst]
    even = rows[~odd]
    two[even, worst[even]] += step[even, worst[even]]
    return one, two


def decode_e8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest and second nearest E8 point of each row, doubled so that both are whole numbers.

    E8 is D8 together with D8 moved by one half in every coordinate.
    """
    whole = _d8(x)
    half = tuple(p + 0.5 for p in _d8(x - 0.5))
    points = np.stack([*whole, *half])
    far = ((points - x) ** 2).sum(axis=2)
    ranked = np.argsort(far, axis=0, kind="stable")
    rows = np.arange(len(x))
    return tuple((2 * points[ranked[k], rows]).astype(np.int64) for k in (0, 1))


def directions(size: int, table: int, blocks: int = BLOCKS) -> np.ndarray:
    """Orthonormal directions of one table (as far as the dimension allows)."""
    rng = np.random.default_rng([SEED, size, table])
    wide = rng.standard_normal((size, 8 * blocks))
    for at in range(0, 8 * blocks, size):  # groups of at most ``size`` orthogonal directions
        part = wide[:, at : at + size]
        wide[:, at : at + size] = np.linalg.qr(part)[0][:, : part.shape[1]]
    return wide * np.sqrt(size / 64)


def cells(vectors: np.ndarray, tables: int, blocks: int, scale: float):
    """(table, own cell, probed cells) of unit vectors; cells are 64-bit keys."""
    size = vectors.shape[1]
    for table in range(tables):
        x = vectors @ directions(size, table, blocks) * (scale * np.sqrt(8))
        x += np.random.default_rng([SEED, table]).random(8 * blocks)  # a random place for the lattice
        decoded = [decode_e8(x[:, 8 * b : 8 * b + 8]) for b in range(blocks)]
        first = [_block_key(d[0], table, b) for b, d in enumerate(decoded)]
        second = [_block_key(d[1], table, b) for b, d in enumerate(decoded)]
        own = _join_keys(first, size)
        probes = [
            _join_keys([second[k] if k == b else first[k] for k in range(blocks)], size)
            for b in range(blocks)
        ]
        yield table, own, probes


def _block_key(points: np.ndarray, table: int, block: int) -> np.ndarray:
    key = np.full(len(points), 1 + 1000 * table + block, np.uint64)
    for k in range(points.shape[1]):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + points[:, k].astype(np.uint64))
    return key


def _join_keys(parts: list[np.ndarray], size: int) -> np.ndarray:
    key = np.full(len(parts[0]), size, np.uint64)
    for part in parts:
        key = mix(key ^ part)
    return key.view(np.int64)


def _matrix(column) -> np.ndarray:
    """Rows of equally long lists without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _by_size(batch: pa.RecordBatch, name: str) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    sizes = np.diff(batch.column(name).offsets.to_numpy())
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, batch.take(pa.array(rows))


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def link_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    tables: int = TABLES,
    blocks: int = BLOCKS,
    scale: float = SCALE,
) -> DataFrame:
    """``id, n_links, component_id, kept`` per row of ``vectors``.

    Pairs found with a cosine, in double precision, of at least ``cosine`` are
    links; no other pair is. ``n_links`` counts a vector's direct links,
    ``component_id`` is the smallest id reachable by links, itself included, and
    ``kept`` says whether that is its own.

    A vector that is null, empty, zero, or holds a null, NaN or infinity links
    nothing; vectors of different lengths do not link. Equal vectors are
    searched for once and link with each other. Repeated rows count once as a
    vector, and each is returned; a row without an id links nothing. An empty
    table gives an empty result. Other columns play no part.

    Candidates are found by hashing, so a pair may be missed; the tests hold
    recall against all pairs. All candidates of a cell are verified, so a cell
    of n distinct vectors costs n * n / 2 comparisons, as many as there are
    links if they are all near each other.
    """
    vid, vec = F.col(id_col), F.col(vector_col)
    finite = ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (
        vid.isNotNull() & vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0)
    )
    plain = F.transform(vec, lambda x: (x + F.lit(0.0)).cast("double"))  # -0.0 and 0.0 are one
    good = vectors.where(F.coalesce(usable, F.lit(False))).select(vid.alias("id"), plain.alias("v")).distinct()
    copies = stage(good.withColumn("key", F.sha2(F.to_json(F.struct("v")), 256)), "vectors")
    same = copies.groupBy("key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    reps = stage(
        copies.join(same, "key").where("id = rep").dropDuplicates(["key"]).select("id", "v"), "reps"
    )
    kind = reps.schema["id"].dataType.simpleString()

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in _by_size(batch, "v"):
                unit = _unit(_matrix(part.column("v")))
                for _, own, probes in cells(unit, tables, blocks, scale):
                    for k, cell in enumerate([own, *probes]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(cell), part.column("id"), pa.array(np.full(len(cell), k == 0))],
                            names=["cell", "id", "own"],
                        )

    filed = stage(reps.mapInArrow(file, f"cell bigint, id {kind}, own boolean"), "cells")
    here, asks = filed.where("own").alias("h"), filed.alias("q")
    pairs = (
        here.join(asks, (F.col("h.cell") == F.col("q.cell")) & (F.col("h.id") != F.col("q.id")))
        .select(F.least("h.id", "q.id").alias("a"), F.greatest("h.id", "q.id").alias("b"))
        .distinct()
    )
    one = reps.select(F.col("id").alias("a"), F.col("v").alias("va"))
    two = reps.select(F.col("id").alias("b"), F.col("v").alias("vb"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in _by_size(batch, "va"):
                x, y = _unit(_matrix(part.column("va"))), _unit(_matrix(part.column("vb")))
                yield part.select(["a", "b"]).filter(pa.array((x * y).sum(axis=1) >= cosine))

    links = stage(
        pairs.join(one, "a")
        .join(two, "b")
        .where(F.size("va") == F.size("vb"))
        .mapInArrow(near, f"a {kind}, b {kind}"),
        "near",
    )
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = same.select(F.col("rep").alias("b"), "n")
    other = both.join(sizes, "b").groupBy("a").agg(F.sum("n").alias("m")).withColumnRenamed("a", "rep")
    found = (
        same.join(other, "rep", "left")
        .join(components(links).withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "key",
            (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    linked = copies.select("id", "key").join(found, "key").drop("key").groupBy("id").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")
    )
    return (
        vectors.select(vid.alias("id"))
        .join(linked, "id", "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
    )


def op10_lattice_dedup(spark, sf_dir: str) -> DataFrame:
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))

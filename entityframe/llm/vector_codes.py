"""Vectors compressed to one codebook index per part, in exact integer arithmetic.

A part's nearest entry is looked for among those that can be nearest anywhere in
the part's cell of a coarse grid. These are remembered per cell: an entry is
left out where another one's largest distance over the cell's box lies below its
smallest. Only what is left is evaluated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityframe.functions.numbering import column
from entityframe.llm.store import stage

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
CELL_BITS = 10  # a cell is 1024 wide, a quarter of the unit
CACHED_CELLS = 200_000
LABEL_SALTS = 32
FAST = 1 << 27  # up to here squared distances of up to 128 components fit 64 bits
FAST_PART = 128
LARGEST = (1 << 63) - 1
SATURATED = 1 << 62


def to_integers(values: np.ndarray) -> np.ndarray:
    """floor(4096 x) of finite doubles, as 64-bit integers; beyond 2**62 it stays there."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(SCALE))
    return np.clip(scaled, -float(SATURATED), float(SATURATED)).astype(np.int64)


def _squared(difference: np.ndarray) -> np.ndarray:
    return (difference * difference).sum(axis=1)


class Book:
    """The entries of one part position, with what is known of each grid cell met so far."""

    def __init__(self, entries: np.ndarray, bits: int = CELL_BITS):
        self.entries, self.bits = entries, bits
        self.fast = entries.shape[1] <= FAST_PART and (not entries.size or np.abs(entries).max() < FAST)
        self.cells: dict[bytes, int] = {}
        self.evaluated = 0

    def _candidates(self, cells: np.ndarray) -> np.ndarray:
        """Bit sets of the entries not dominated across each cell's box."""
        low = cells << self.bits
        high = low + (1 << self.bits) - 1
        nearest = np.empty((len(cells), len(self.entries)), np.int64)
        farthest = nearest.copy()
        for k, entry in enumerate(self.entries):
            nearest[:, k] = _squared(np.maximum(np.maximum(low - entry, entry - high), 0))
            farthest[:, k] = _squared(np.maximum(np.abs(low - entry), np.abs(high - entry)))
        kept = nearest <= farthest.min(axis=1, keepdims=True)
        return kept @ (1 << np.arange(len(self.entries), dtype=np.int64))

    def _masks(self, parts: np.ndarray) -> np.ndarray:
        cells = np.ascontiguousarray(parts >> self.bits)
        rows = cells.view(np.dtype((np.void, cells.shape[1] * 8))).reshape(-1)
        unique, where, inverse = np.unique(rows, return_index=True, return_inverse=True)
        keys = [row.tobytes() for row in unique]
        if len(self.cells) > CACHED_CELLS:
            self.cells.clear()
        get = self.cells.get
        masks = np.fromiter((get(k, 0) for k in keys), np.int64, len(keys))
        new = np.flatnonzero(masks == 0)
        if len(new):
            masks[new] = self._candidates(cells[where[new]])
            self.cells.update(zip((keys[i] for i in new.tolist()), masks[new].tolist()))
        return masks[inverse]

    def assign(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, the lower one of equals, and the squared distance."""
        fast = self.fast and (not parts.size or np.abs(parts).max() < FAST)
        if fast:
            masks, best, kind = self._masks(parts), np.full(len(parts), LARGEST), np.int64
        else:  # whole numbers of any size
            parts, kind = parts.astype(object), object
            masks, best = np.full(len(parts), -1), np.full(len(parts), 1 << 200, object)
        code = np.zeros(len(parts), np.int64)
        for k, entry in enumerate(self.entries):
            rows = np.flatnonzero((masks >> k) & 1)
            self.evaluated += len(rows)
            distance = _squared(parts[rows] - entry.astype(kind))
            closer = distance < best[rows]
            code[rows[closer]] = k
            best[rows[closer]] = distance[closer]
        return code, best


def _vectors(batch: pa.RecordBatch, at: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of whole finite vectors; which of them are ``width`` long; integers of these, padded to whole parts."""
    lists = batch.column(at)
    size = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten()
    lacking = values.is_null().to_numpy(zero_copy_only=False)
    flat = values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.concatenate([[0], np.cumsum(lacking | ~np.isfinite(flat))])
    edge = np.concatenate([[0], np.cumsum(size)])
    kept = np.flatnonzero((size > 0) & (bad[edge[1:]] == bad[edge[:-1]]))
    fit = size[kept] == width
    rows = edge[kept[fit]][:, None] + np.arange(width)
    whole = np.zeros((int(fit.sum()), -(-width // PARTS) * PARTS), np.int64)
    whole[:, :width] = to_integers(flat[rows])
    return kept, fit, whole


def first_codebooks(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[list[np.ndarray], int]:
    """The parts of the 16 smallest ids, and the width of the vector that comes first."""
    value = F.transform(column(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(column(id_col).alias("id"), value.alias("v")).where(
        (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    )
    order = [F.asc_nulls_last("id"), F.asc("v")]
    first = rows.orderBy(*order).limit(1).select(F.size("v").alias("n")).first()
    if first is None:
        return [], 0
    width = first["n"]
    smallest = [r["v"] for r in rows.where(F.size("v") == width).orderBy(*order).limit(ENTRIES).collect()]
    whole = np.zeros((len(smallest), -(-width // PARTS) * PARTS), np.int64)
    whole[:, :width] = to_integers(np.array(smallest, np.float64))
    return np.split(whole, PARTS, axis=1), width


def next_codebooks(vectors: DataFrame, vector_col: str, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """One round: every part to its nearest entry, entries to the floored means of their parts.

    A task adds up its own rows; what reaches the driver is one row per
    component of the codebooks, whatever the number of vectors.
    """
    entries, part = books[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = [Book(b) for b in books]
        count = np.zeros(PARTS * entries, object)
        total = np.zeros((PARTS * entries, part), object)
        for batch in batches:
            _, _, whole = _vectors(batch, 0, width)
            for p, own in enumerate(np.split(whole, PARTS, axis=1)):
                code, _ = searched[p].assign(own)
                for k in np.unique(code).tolist():
                    rows = own[code == k]
                    wide = object if np.abs(rows).max() >= FAST else np.int64
                    count[p * entries + k] += len(rows)
                    total[p * entries + k] += rows.astype(wide).sum(axis=0)
        used = np.flatnonzero(count)
        slots = (used[:, None] * part + np.arange(part)).reshape(-1)
        arrays = [
            pa.array(slots, pa.int32()),
            pa.array(np.repeat(count[used], part).tolist(), pa.int64()),
            pa.array([int(v) for v in total[used].reshape(-1)], pa.decimal128(38, 0)),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["slot", "n", "total"])

    sums = vectors.select(column(vector_col)).mapInArrow(run, "slot int, n bigint, total decimal(38,0)")
    rows = sums.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    out = [b.copy() for b in books]
    for r in rows:
        entry, at = divmod(r["slot"], part)
        p, k = divmod(entry, entries)
        out[p][k, at] = int(r["total"]) // r["n"]
    return out


def train_codebooks(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", rounds: int = ROUNDS) -> tuple[list[np.ndarray], int]:
    """The codebook of each part position after ``rounds`` passes over all vectors, and their width."""
    books, width = first_codebooks(vectors, id_col, vector_col)
    for _ in range(rounds if books else 0):
        books = next_codebooks(vectors, vector_col, books, width)
    return books, width


def codebooks_digest(books: list[np.ndarray]) -> str:
    text = ",".join(str(v) for book in books for v in book.reshape(-1).tolist())
    return hashlib.sha256(text.encode()).hexdigest()


def encode_vectors(
    vectors: DataFrame,
    books: list[np.ndarray],
    width: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``vec_id, label, code, error`` of every whole finite vector; no shuffle."""
    kinds = vectors.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = [Book(b) for b in books]
        for batch in batches:
            kept, fit, whole = _vectors(batch, 2, width)
            digits, error = np.zeros((len(whole), PARTS), np.int64), np.zeros(len(whole), object)
            for p, own in enumerate(np.split(whole, PARTS, axis=1)):
                digits[:, p], distance = searched[p].assign(own)
                error += distance.astype(object)
            codes, errors = np.full(len(kept), None, object), np.full(len(kept), None, object)
            codes[fit] = [bytes(row).hex() for row in digits.astype(np.uint8)]
            errors[fit] = [min(int(e), LARGEST) for e in error]
            columns = [batch.column(0).take(pa.array(kept)), batch.column(1).take(pa.array(kept))]
            columns += [pa.array(codes.tolist(), pa.string()), pa.array(errors.tolist(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    schema = f"vec_id {kinds[id_col].dataType.simpleString()}, label {kinds[label_col].dataType.simpleString()}"
    narrow = vectors.select(
        column(id_col).alias("vec_id"), column(label_col).alias("label"), column(vector_col).alias("vector")
    )
    return narrow.mapInArrow(run, f"{schema}, code string, error bigint")


def with_label_errors(encoded: DataFrame) -> DataFrame:
    """``encoded`` with ``label_error``, the error summed over rows of its label, nulls being one label.

    Labels are added up before the shuffle and joined back over salts, so that a
    label of a third of all rows is spread over tasks.
    """
    largest = F.lit(LARGEST).cast("decimal(38,0)")
    sums = encoded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    sums = sums.select(
        F.col("label").alias("_label"),
        F.when(F.col("total") < largest, F.col("total")).when(F.col("total").isNotNull(), largest).cast("bigint").alias("label_error"),
        F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))).alias("_salt"),
    )
    salted = encoded.withColumn("_own", F.pmod(F.xxhash64("vec_id", "code"), F.lit(LABEL_SALTS)).cast("int"))
    same = F.col("label").eqNullSafe(F.col("_label")) & (F.col("_own") == F.col("_salt"))
    return salted.join(sums, same).drop("_own", "_label", "_salt")


def compress_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every whole finite vector.

    Null and empty vectors and those with null or non-finite components are left
    out. All have the width of the one with the smallest id (null ids last, equal ids by
    their components); one of another width gets a null code and error and moves no codebook. A
    width that eight does not divide is filled up with zeros. Fewer than 16
    vectors make a shorter codebook. Repeated rows count once each. Components
    beyond 2**62 / 4096 stay there, sums beyond 64 bits at the largest long. Other columns play no part.
    """
    books, width = train_codebooks(vectors, id_col, vector_col)
    if not books:
        books, width = [np.zeros((1, 1), np.int64)] * PARTS, PARTS
    encoded = stage(encode_vectors(vectors, books, width, id_col, vector_col, label_col), "codes")
    return with_label_errors(encoded).withColumn("codebooks_sha256", F.lit(codebooks_digest(books)))


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    return compress_vectors(vectors).drop("label")


def _sql() -> str:
    """The same rounds unrolled as common table expressions."""
    assign = """
assigned{r} as materialized (
  select rid, pos, min(struct_pack(
      d := list_sum(list_transform(list_zip(w, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint, entry := entry)) as best
  from parts join book{r} using (pos) group by rid, pos)"""
    update = """
means{n} as materialized (
  select pos, entry, list((s - ((s % n) + n) % n) // n order by i)::bigint[] as e
  from (select p.pos, best.entry as entry, i, sum(p.w[i])::hugeint as s, count(*)::hugeint as n
        from parts p join assigned{r} a using (rid, pos), range(1, 1 + (select part from shape)) t(i)
        group by all)
  group by pos, entry),
book{n} as materialized (
  select b.pos, b.entry, coalesce(m.e, b.e) as e from book{r} b left join means{n} m using (pos, entry))"""
    steps = []
    for r in range(ROUNDS):
        steps += [assign.format(r=r), update.format(r=r, n=r + 1)]
    steps.append(assign.format(r=ROUNDS))
    return f"""with kept as materialized (
  select row_number() over (order by vec_id nulls last, embedding) as rid, vec_id, label,
         list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
  from embeddings
  where len(embedding) > 0 and not list_bool_or(list_transform(embedding, lambda x: x is null or not isfinite(x)))),
shape as materialized (select len(v) // {PARTS} as part from kept where rid = 1),
parts as materialized (
  select rid, pos, v[pos * part + 1 : (pos + 1) * part] as w from kept, shape, range({PARTS}) t(pos)),
book0 as materialized (select pos, rid - 1 as entry, w as e from parts where rid <= {ENTRIES}),
{",".join(steps)},
errors as materialized (
  select rid, string_agg(printf('%02x', best.entry), '' order by pos) as code, sum(best.d)::bigint as error
  from assigned{ROUNDS} group by rid),
digest as (
  select sha256(string_agg(c::varchar, ',' order by pos, entry, i)) as codebooks_sha256
  from (select pos, entry, i, e[i] as c from book{ROUNDS}, range(1, 1 + (select part from shape)) t(i)))
select k.vec_id, x.code, x.error,
       (sum(x.error) over (partition by k.label))::bigint as label_error, d.codebooks_sha256
from kept k join errors x using (rid), digest d"""


OP12_SQL = _sql()

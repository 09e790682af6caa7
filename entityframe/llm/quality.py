"""Document quality by co-training.

Two classifiers see different views of a document: its words and marks, and its
metadata (language, source, length, layout). They start from the same labels;
in every round each adds the unlabelled documents it is surest of, with its own
verdict, to the other's training rows. Their calibrated log odds are added up
with fitted weights, and the sum scores every document.

Fitting uses a bounded sample of the labelled documents (``MAX_LABELLED``),
chosen by a hash of the id. Each round scores all unlabelled documents in one
pass and takes the surest, so only the rows taught are bounded
(``MAX_UNLABELLED``). Scoring is one pass over all documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityframe.llm.store import stage
from entityframe.llm.text import Words, byte_table, byte_view, chunks

MAX_LABELLED = 8000
MAX_UNLABELLED = 2000
ROUNDS = 3
TAUGHT_PER_ROUND = 100
SURE = 0.98
WORD_BITS = 18
SOURCE_SLOTS = 64
LANG_SLOTS = 16
KEEP_FROM = 0.5
# A word speaks for or against a class if so many standard errors set it apart.
WORD_Z = 3.5
WORD_ROWS = 5
SCORES = "quality_score double, text_score double, metadata_score double"


def _marks() -> np.ndarray:
    """A byte table whose words are runs of ASCII marks."""
    code = np.arange(256)
    ok = (code > 32) & (code < 127) & (byte_table("alnum") == 0)
    return np.where(ok, code + 1, 0).astype(np.uint16)


def _slot(value: str | None, slots: int) -> int:
    return xxhash.xxh64_intdigest((value or "").encode("utf-8", "replace")) % slots


def text_features(buf: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Of each text, the sorted distinct slots of its words and marks."""
    tables = (byte_table("alnum"), _marks())
    found = [Words(buf, off, table) for table in tables]
    out = []
    for i in range(len(off) - 1):
        own = [
            (w.hash[w.first[i] : w.first[i + 1]] ^ np.uint64(k)) & np.uint64((1 << WORD_BITS) - 1)
            for k, w in enumerate(found)
        ]
        out.append(np.unique(np.concatenate(own)).astype(np.int64))
    return out


def _shares(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Layout of each text: shares of kinds of bytes, word and line lengths, double marks."""
    code = np.arange(256)
    upper, lower = (code >= 65) & (code <= 90), (code >= 97) & (code <= 122)
    digit, space, wide = (code >= 48) & (code <= 57), (code == 32), code >= 128
    line = code == 10
    mark = (code > 32) & (code < 127) & ~(upper | lower | digit)
    size = np.maximum(np.diff(off), 1)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[off])

    is_mark = mark[buf]
    twice = np.zeros(len(buf), bool)
    twice[1:] = is_mark[1:] & is_mark[:-1]
    counts = [per_text(kind[buf]) for kind in (upper, lower, digit, space, wide, line, mark)]
    lines, gaps = counts[5] + 1, counts[3] + counts[5] + 1
    return np.stack(
        [
            *(c / size for c in counts),
            per_text(twice) / size,
            np.log1p(size / gaps),
            np.log1p(size / lines),
            np.log1p(lines),
            counts[0] / np.maximum(1, counts[0] + counts[1]),
        ],
        axis=1,
    )


def metadata_features(shares, langs, sources, n_chars) -> np.ndarray:
    rows = np.arange(len(langs))
    lang, source = np.zeros((len(rows), LANG_SLOTS)), np.zeros((len(rows), SOURCE_SLOTS))
    lang[rows, [_slot(v, LANG_SLOTS) for v in langs]] = 1
    source[rows, [_slot(v, SOURCE_SLOTS) for v in sources]] = 1
    size = np.log1p(np.array([max(0, v or 0) for v in n_chars], float))[:, None]
    return np.concatenate([shares, shares**2, size, lang, source], axis=1)


def _views(table) -> Iterator[tuple[slice, list[np.ndarray], np.ndarray]]:
    """(rows, text features, metadata features) by parts of a batch with text, lang, source, n_chars."""
    buf, off = byte_view(table.column("text"))
    langs, sources = table.column("lang").to_pylist(), table.column("source").to_pylist()
    n_chars = table.column("n_chars").to_pylist()
    for a, b in chunks(off):
        part, ends = buf[off[a] : off[b]], off[a : b + 1] - off[a]
        meta = metadata_features(_shares(part, ends), langs[a:b], sources[a:b], n_chars[a:b])
        yield slice(a, b), text_features(part, ends), meta


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _descend(forward, backward, size: int, y: np.ndarray, rate=0.3, steps=150, keep=1e-3) -> np.ndarray:
    """Logistic regression by Adam on all rows; the last weight is the constant."""
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        error = (_sigmoid(forward(w[:-1]) + w[-1]) - y) / max(1, len(y))
        grad = np.append(backward(error) + keep * w[:-1], error.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


class TextClassifier:
    """Logistic regression on the words that tell the classes apart."""

    def __init__(self, rows: list[np.ndarray], y: np.ndarray):
        size = 1 << WORD_BITS
        at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        slots = np.concatenate([np.zeros(0, np.int64), *rows])
        n = np.bincount(slots, minlength=size)
        good = np.bincount(slots, weights=y[at], minlength=size)
        base = y.mean()
        z = np.abs(good - n * base) / np.sqrt(np.maximum(1e-9, n * base * (1 - base)))
        kept = np.flatnonzero((n >= WORD_ROWS) & (z >= WORD_Z))
        number = np.full(size, -1)
        number[kept] = np.arange(len(kept))
        use = number[slots] >= 0
        at, column = at[use], number[slots[use]]
        w = _descend(
            lambda w: np.bincount(at, weights=w[column], minlength=len(rows)),
            lambda e: np.bincount(column, weights=e[at], minlength=len(kept)),
            len(kept),
            y,
        )
        self.weights = np.zeros(size, np.float32)
        self.weights[kept] = w[:-1]
        self.constant = w[-1]

    def logit(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[r].sum(dtype=float) for r in rows]) + self.constant


class MetadataClassifier:
    """Logistic regression on standardised metadata."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = (x - self.mean) / self.spread
        self.weights = _descend(lambda w: z @ w, lambda e: e @ z, x.shape[1], y, keep=1e-3)

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return z @ self.weights[:-1] + self.weights[-1]


def _calibrate(logits: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and a constant that turn columns of log odds into calibrated ones."""
    x = np.clip(logits, -20, 20)
    return _descend(lambda w: x @ w, lambda e: e @ x, x.shape[1], y, rate=0.1, steps=300, keep=1e-4)


@dataclass
class CoTrained:
    text: TextClassifier
    metadata: MetadataClassifier
    views: list[np.ndarray]  # calibration of each view
    both: np.ndarray  # calibration of the pair of calibrated views

    def scores(self, rows: list[np.ndarray], x: np.ndarray) -> np.ndarray:
        """Columns: combined, text, metadata; each the probability of a good document."""
        views = self._calibrated(rows, x)
        total = np.clip(views, -20, 20) @ self.both[:-1] + self.both[-1]
        return _sigmoid(np.column_stack([total, views]))

    def _calibrated(self, rows, x):
        raw = [self.text.logit(rows), self.metadata.logit(x)]
        return np.column_stack(
            [np.clip(r, -20, 20) * c[0] + c[1] for r, c in zip(raw, self.views)]
        )


def co_train(text: list, meta: np.ndarray, y: np.ndarray, surest: Callable, rounds: int = ROUNDS):
    """Every fifth labelled row is left out of training and calibrates.

    ``surest`` takes both classifiers and what each view was taught, and gives
    (view, key, label, text, metadata) of the unlabelled rows that each view is surest of.
    """
    held = np.arange(len(y)) % 5 == 4
    train = np.flatnonzero(~held)
    taught: list[dict] = [{}, {}]  # pseudo-labelled rows given to the text and metadata views
    for turn in range(rounds + 1):
        extra = [[lesson[key] for key in sorted(lesson)] for lesson in taught]
        labels = [np.concatenate([y[train], [label for label, _, _ in rows]]) for rows in extra]
        t = TextClassifier([text[i] for i in train] + [words for _, words, _ in extra[0]], labels[0])
        m = MetadataClassifier(np.stack([*meta[train], *(x for _, _, x in extra[1])]), labels[1])
        if turn == rounds:
            break
        found = surest(t, m, taught)
        if not found:
            break
        for view, key, *row in found:
            taught[1 - view][key] = tuple(row)
    own = [text[i] for i in np.flatnonzero(held)]
    raw = np.column_stack([t.logit(own), m.logit(meta[held])])
    views = [_calibrate(raw[:, k : k + 1], y[held]) for k in (0, 1)]
    calibrated = np.column_stack([np.clip(raw[:, k], -20, 20) * views[k][0] + views[k][1] for k in (0, 1)])
    return CoTrained(t, m, views, _calibrate(calibrated, y[held]))


FEATURES = "doc_id {id}, mark bigint, label double, words array<bigint>, metadata array<double>"


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = MAX_LABELLED,
    max_unlabelled: int = MAX_UNLABELLED,
) -> CoTrained | None:
    """A model from ``labels`` (doc_id, label 0/1), or None unless both classes are there.

    Conflicting labels of one id count as bad. The labelled rows are those with
    the smallest hashes of their ids, at most ``max_labelled``. The others are
    chosen among all unlabelled documents with an id: each round is a pass that
    scores them all and takes the surest of each view and class; the rounds
    together teach at most ``max_unlabelled``.
    """
    known = (
        labels.where("doc_id is not null and label is not null")
        .groupBy("doc_id")
        .agg(F.min("label").cast("double").alias("label"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    inputs = _inputs(docs)
    # Tells the rows of one id apart where they differ.
    marked = inputs.withColumn("mark", F.xxhash64(*inputs.columns))
    # One row of each id, combined before it is shuffled: however often an id is repeated, no more reach the driver.
    rows = marked.join(F.broadcast(chosen), "doc_id")
    once = rows.groupBy("doc_id").agg(F.min_by(F.struct(*rows.columns), "mark").alias("row")).select("row.*")
    _, y, words, meta = _taken(once)
    if len(y) < 10 or len(set(y[::5])) < 2 or len(set(y[4::5])) < 2:
        return None
    per_round = min(TAUGHT_PER_ROUND, max_unlabelled // (4 * ROUNDS))

    def surest(t: TextClassifier, m: MetadataClassifier, taught: list[dict]) -> list[tuple]:
        return _surest(marked, known.select("doc_id"), t, m, taught, per_round)

    return co_train(words, meta, y, surest)


def _surest(marked, known, t, m, taught, per_round) -> list[tuple]:
    """(view, key, label, text, metadata) of the unlabelled documents each view is surest of, not yet taught."""
    if not per_round:
        return []
    kind = marked.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, words, meta in _views(batch):
                p = _sigmoid(np.column_stack([t.logit(words), m.logit(meta)]))
                part = batch.slice(rows.start, rows.stop - rows.start)
                columns = [part.column("doc_id"), part.column("mark"), pa.array(p[:, 0]), pa.array(p[:, 1])]
                sure = (np.maximum(p, 1 - p) >= SURE).any(axis=1)
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "p0", "p1"]).filter(pa.array(sure))

    # Only ids and two numbers are shuffled.
    scored = marked.where("doc_id is not null").mapInArrow(score, f"doc_id {kind}, mark bigint, p0 double, p1 double")
    open_rows = stage(scored.join(known, "doc_id", "left_anti").distinct(), "sure")
    best = None
    for view in (0, 1):
        for label in (1.0, 0.0):
            sure = F.col(f"p{view}") if label else 1 - F.col(f"p{view}")
            top = (
                open_rows.select(F.lit(view).alias("view"), F.lit(label).alias("label"), "doc_id", "mark", sure.alias("sure"))
                .where(F.col("sure") >= SURE)
                .orderBy(F.desc("sure"), F.xxhash64("doc_id", F.lit(1)), "doc_id", "mark")
                .limit(per_round + len(taught[1 - view]))
            )
            best = top if best is None else best.unionByName(top)
    picked: dict[tuple, list] = {}
    for r in sorted(best.collect(), key=lambda r: -r.sure):  # stable: equal ones stay in order
        group, key = picked.setdefault((r.view, r.label), []), (r.doc_id, r.mark)
        if key not in taught[1 - r.view] and len(group) < per_round:
            group.append(key)
    keys = sorted({key for group in picked.values() for key in group})
    if not keys:
        return []
    fields = [marked.schema["doc_id"], marked.schema["mark"]]
    wanted = marked.sparkSession.createDataFrame(keys, T.StructType([T.StructField(f.name, f.dataType) for f in fields]))
    wanted = wanted.withColumn("label", F.lit(None).cast("double"))
    alike = marked.join(F.broadcast(wanted), ["doc_id", "mark"])
    ids, _, words, meta = _taken(alike.dropDuplicates(["doc_id", "mark"]))
    at = {key: i for i, key in enumerate(ids)}
    return [
        (view, key, label, words[at[key]], meta[at[key]]) for (view, label), group in picked.items() for key in group
    ]


def _taken(rows: DataFrame) -> tuple[list[tuple], np.ndarray, list[np.ndarray], np.ndarray]:
    """(id, mark) in order, label, text and metadata features of rows few enough for the driver."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part_rows, words, meta in _views(batch):
                part = batch.slice(part_rows.start, part_rows.stop - part_rows.start)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(name) for name in ("doc_id", "mark", "label")),
                        pa.array(words, pa.list_(pa.int64())),
                        pa.array(list(meta), pa.list_(pa.float64())),
                    ],
                    names=["doc_id", "mark", "label", "words", "metadata"],
                )

    taken = rows.mapInArrow(run, FEATURES.format(id=kind)).toArrow()
    taken = taken.sort_by([("doc_id", "ascending"), ("mark", "ascending")])
    ids = list(zip(taken.column("doc_id").to_pylist(), taken.column("mark").to_pylist()))
    meta = _lists(taken.column("metadata"))
    return (
        ids,
        taken.column("label").to_numpy(),
        _lists(taken.column("words")),
        np.stack(meta) if meta else np.zeros((0, 0)),
    )


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The arrays of a list column, as views."""
    lists = column.combine_chunks()
    values, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return [values[a:b] for a, b in zip(at[:-1], at[1:])]


def _inputs(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        "lang",
        "source",
        F.coalesce("n_chars", F.length("text"), F.lit(0)).cast("bigint").alias("n_chars"),
    )


def score_quality(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """``docs`` with ``quality_score``, ``text_score``, ``metadata_score`` and ``keep``.

    ``docs`` has doc_id, text, lang, source and n_chars; ``labels`` doc_id and
    label (1 good, 0 bad). Scores are probabilities of a good document; a
    document is kept from 0.5 on. Null texts and metadata count as empty.
    Repeated rows score alike; further columns stay, and columns so named are
    replaced. If the labelled documents do not have both classes, nothing can
    be learned: scores are null and every document is kept.
    """
    docs = docs.drop("quality_score", "text_score", "metadata_score", "keep")
    model = fit(docs, labels, **bounds)
    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(SCORES).fields])
    if model is None:
        scored = docs.withColumns(
            {f.name: F.lit(None).cast("double") for f in T._parse_datatype_string(SCORES).fields}
        )
        return scored.withColumn("keep", F.lit(True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.fill_null(batch.column("n_chars").cast(pa.int64()), -1).to_pylist()
            texts = batch.column("text")
            lengths = pa.compute.fill_null(pa.compute.utf8_length(texts), 0).to_pylist()
            sizes = [n if s < 0 else s for s, n in zip(sizes, lengths)]
            view = {"text": texts, "lang": batch.column("lang"), "source": batch.column("source")}
            view = pa.table(view | {"n_chars": pa.array(sizes, pa.int64())})
            for rows, words, meta in _views(view):  # about a megabyte of text each
                scores = model.scores(words, meta)
                part = batch.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(scores[:, k]) for k in range(3))], names=schema.names
                )

    return docs.mapInArrow(run, schema).withColumn("keep", F.col("quality_score") >= KEEP_FROM)


def good_labels(labels: DataFrame) -> DataFrame:
    """1 for documents of good quality that are not toxic."""
    return labels.select(
        "doc_id", ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int").alias("label")
    )


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(docs, good_labels(labels)).drop("text")

"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are counted in one vectorised pass per batch (shares of capitals,
symbols, digits and punctuation; word and line statistics; repetition).  Each feature
is cut into at most ``BINS`` quantile bins.  Training goes round the features in turn:
each time one shallow tree on that feature's bins is fitted to the gradient and added
to the feature's lookup table, scaled by a learning rate.  The pairs of features that
still explain most of the residual then get two-dimensional tables the same way.  A
score is the logistic of the sum of one table entry per feature and pair.

The fit uses at most ``max_rows`` labelled rows: those with the smallest hash of the
id, a documented bound; their bins (a byte a feature) are all that reaches the driver,
and the tables (some thousand numbers) are all that is sent out.  Scoring is a narrow
transformation over every whole text.

Labels are used for fitting only; ids decide which labels are held out and nothing
else; language, source and ids are never features.

Edge cases: a null text counts as empty and is scored like any other; rows with a null
or repeated id are scored one by one; labels that are null, not 0 or 1, or of unknown
documents are ignored, an id labelled twice counts once per label; with no usable
labels, or of one class only, the score is the smoothed share of label 1 (0.5 with
none); an empty table stays empty; columns beside the id and the text are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows the model is fitted on at most.
MAX_ROWS = 20_000
#: Bins of a feature and, coarser, of a feature in a pair.
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS, RATE, LEAST = 120, 60, 8, 0.1, 20
#: Score from which a document is predicted to be good.
THRESHOLD = 0.7

FEATURES = (
    "log_bytes", "log_words", "mean_word", "long_words", "capital_share", "capital_words", "letter_share",
    "digit_share", "symbol_share", "mark_share", "space_share", "wide_share", "symbol_words", "no_letter_words",
    "distinct_words", "short_distinct", "log_lines", "mean_line", "distinct_lines", "stop_lines", "repeat_words", "bang_share",
)

_CLASS = np.zeros(256, np.uint8)  # 1 lower, 2 upper, 3 digit, 4 space, 5 sentence mark, 6 other ASCII mark, 7 beyond ASCII
_CLASS[128:] = 7
for _c in range(128):
    _s = chr(_c)
    _CLASS[_c] = (1 if _s.islower() else 2 if _s.isupper() else 3 if _s.isdigit() else 4 if _s in " \t\n\x0b\x0c\r"
                  else 5 if _s in ".,;:'\"()-?" else 6)


def text_features(text: str | None) -> list[float]:
    """The ``FEATURES`` of one text."""
    raw = (text or "").encode()
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [float(np.log1p(size))] + [0.0] * (len(FEATURES) - 1)
    kinds = _CLASS[np.frombuffer(raw, np.uint8)]
    share = np.bincount(kinds, minlength=8) / size
    # per word: which classes of characters it has
    gaps = kinds == 4
    inside = ~gaps
    starts = np.flatnonzero(inside & np.append(True, gaps[:-1]))
    def has(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat((mask & inside).astype(np.int32), starts)
    upper, lower, odd, wide = has(kinds == 2), has(kinds == 1), has(kinds == 6), has(kinds == 7)
    sizes = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    distinct = len(set(words))
    pairs = set(zip(words, words[1:], strict=False))
    # short_distinct: distinct words of each stretch of 100, so that long texts do not look repetitive
    return [
        np.log1p(size), np.log1p(n), sizes.mean(), (sizes > 12).mean(), share[2], ((upper > 1) & (lower == 0)).mean(),
        share[1], share[3], share[6], share[5], share[4], share[7], (odd > 0).mean(), ((upper + lower + wide) == 0).mean(),
        distinct / n, sum(len(set(words[k:k + 100])) for k in range(0, n, 100)) / n, np.log1p(len(lines)), np.log1p(size / len(lines)),
        len(set(lines)) / len(lines), np.mean([x.rstrip().endswith((b".", b"?")) for x in lines]),
        1 - len(pairs) / max(1, n - 1), raw.count(b"!") / n,
    ]


@dataclass
class Model:
    base: float
    edges: list[np.ndarray] = field(default_factory=list)  # per feature: the cuts between bins
    tables: list[np.ndarray] = field(default_factory=list)  # per feature: a number per bin
    coarse: list[np.ndarray] = field(default_factory=list)  # per feature: fine bin -> bin in a pair
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Bin numbers of a matrix of features."""
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], 1).astype(np.uint8)

    def score(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.base)
        for j, t in enumerate(self.tables):
            total += t[bins[:, j]]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[self.coarse[i][bins[:, i]], self.coarse[j][bins[:, j]]]
        return 1 / (1 + np.exp(-total))


def _leaves(g: np.ndarray, h: np.ndarray, c: np.ndarray, depth: int) -> np.ndarray:
    """A shallow tree over ordered bins with gradient, curvature and row sums: the value of each bin."""
    out = np.full(len(g), g.sum() / (h.sum() + 1.0))
    if depth == 0 or len(g) < 2:
        return out
    gl, hl, cl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(c)[:-1]
    gain = gl ** 2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - g.sum() ** 2 / (h.sum() + 1)
    gain[(cl < LEAST) | (c.sum() - cl < LEAST)] = -np.inf
    k = int(np.argmax(gain))
    if not gain[k] > 1e-9:
        return out
    return np.concatenate([_leaves(g[:k + 1], h[:k + 1], c[:k + 1], depth - 1),
                           _leaves(g[k + 1:], h[k + 1:], c[k + 1:], depth - 1)])


def _plane(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree of two cuts, the second in each half along the other axis; and its gain."""
    best, value = -np.inf, None
    for axis in (0, 1):
        gs, hs, cs = (np.moveaxis(a, axis, 0) for a in (g, h, c))
        for k in range(1, len(gs)):
            parts, gain = [], 0.0
            for half in (slice(0, k), slice(k, None)):
                a, b, n = gs[half].sum(0), hs[half].sum(0), cs[half].sum(0)
                v = _leaves(a, b, n, 1)
                for leaf in np.unique(v):
                    gain += a[v == leaf].sum() ** 2 / (b[v == leaf].sum() + 1)
                parts.append(np.broadcast_to(v, gs[half].shape))
            if gain > best:
                best, value = gain, np.moveaxis(np.concatenate(parts), 0, axis)
    return value, best - g.sum() ** 2 / (h.sum() + 1)


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting on a bounded matrix of features and 0/1 labels."""
    p = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(p / (1 - p))))
    model.edges = [np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS)) if len(x) else np.empty(0)
                   for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.coarse = [(np.arange(len(e) + 1) * PAIR_BINS // (len(e) + 1)).astype(np.int64) for e in model.edges]
    if y.min(initial=1) == y.max(initial=0):
        return model
    bins = model.bins(x).astype(np.int64)
    total = np.full(len(y), model.base)

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-total))
        return y - q, np.maximum(q * (1 - q), 1e-6)

    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            g, h = gradient()
            sums = (np.bincount(bins[:, j], w, len(table)) for w in (g, h, np.ones(len(y))))
            step = RATE * np.clip(_leaves(*sums, depth=2), -4, 4)
            table += step
            total += step[bins[:, j]]

    coarse = np.stack([model.coarse[j][bins[:, j]] for j in range(bins.shape[1])], 1)

    def plane(i: int, j: int) -> tuple[np.ndarray, float]:
        g, h = gradient()
        cell = coarse[:, i] * PAIR_BINS + coarse[:, j]
        return _plane(*(np.bincount(cell, w, PAIR_BINS ** 2).reshape(PAIR_BINS, PAIR_BINS) for w in (g, h, np.ones(len(y)))))

    d = bins.shape[1]
    ranked = sorted(((-plane(i, j)[1], i, j) for i in range(d) for j in range(i + 1, d)
                     if len(model.edges[i]) and len(model.edges[j])))
    model.pairs = [(i, j) for _, i, j in ranked[:PAIRS]]
    model.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            step = RATE * np.clip(plane(i, j)[0], -4, 4)
            table += step
            total += step[coarse[:, i], coarse[:, j]]
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows, some at a time, so that few texts are Python strings at once."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def _feature_rows(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return np.array([text_features(t) for t in batch.column(column).to_pylist()], np.float64).reshape(-1, len(FEATURES))


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """Fit on the labelled rows that are not held out, at most ``max_rows`` of them."""
    usable = (labels.where(~held_out(id_col) & F.col(label_col).isin(0, 1))
                    .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropna())
    chosen = usable.orderBy(F.xxhash64("id"), "id", "y").limit(max_rows)
    rows = (df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
              .join(F.broadcast(chosen), "id").select("id", "y", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            x = _feature_rows(batch, 2)
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), values], names=["id", "y", "x"])

    kind = rows.schema["id"].dataType.simpleString()
    # rows that repeat an id could exceed the bound: the limit holds for them too
    found = (rows.mapInArrow(run, f"id {kind}, y int, x array<double>")
                 .orderBy(F.xxhash64("id"), "id", "y", "x").limit(max_rows).collect())
    x = np.array([r["x"] for r in found], np.float64).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["y"] for r in found], np.float64))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """Columns: the id, ``held_out``, ``score``, ``predicted``; for all rows of ``df``."""
    source = df.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            s = model.score(model.bins(_feature_rows(batch, 2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=["id", "held_out", "score", "predicted"])

    kind = source.schema["id"].dataType.simpleString()
    return (source.mapInArrow(run, f"id {kind}, held_out boolean, score double, predicted int")
                  .withColumnRenamed("id", id_col))


def filter_good(df: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of the rows that are predicted to be good."""
    names = [f"c{k}" for k in range(len(df.columns))]
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            good = model.score(model.bins(_feature_rows(batch, at))) >= threshold
            yield batch.filter(pa.array(good))

    return df.toDF(*names).mapInArrow(run, df.toDF(*names).schema).toDF(*df.columns)

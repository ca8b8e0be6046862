"""Document quality by regularised quadratic discriminant analysis.

Every whole text is turned into a short vector of transformed statistics (lengths,
shares of character classes, repetition, entropy, compressibility). Each class has
a Gaussian whose covariance is shrunk towards the pooled one and towards its own
mean variance. The score is the logistic of the tempered difference of the two
Mahalanobis log densities, trusted less the fewer words a text has, plus the log prior, computed with cached Cholesky factors.

Scale. Texts are read once; the vectors stand in a narrow table in shared storage,
from which training and scoring read. Training needs class counts, sums and cross
products only: each task sends one small matrix per class, whatever its rows. The
labels learnt from are all up to ``LEARN``, a hashed sample of about so many beyond it,
so they can be broadcast. Nothing else moves.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineloom.storage import cut

FEATURES = ("log_words", "word_len", "upper", "digit", "symbol", "space", "newline", "high_byte", "distinct_words", "top_word", "distinct_lines", "symbol_words", "upper_words", "entropy", "packed", "line_len")
POOLED, RIDGE, TEMPER, WORDS, CUT, LEARN = 0.2, 0.02, 3.0, 12, 0.3, 1_000_000

_KIND = np.zeros((256, 6))
_KIND[65:91, 0] = 1
_KIND[48:58, 1] = 1
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()], 2] = 1
_KIND[[9, 11, 12, 13, 32], 3] = 1
_KIND[10, 4] = 1
_KIND[128:, 5] = 1


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one text; all defined for an empty one."""
    raw = (text or "").encode()
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts / n
    upper, digit, symbol, space, newline, high = (share @ _KIND).tolist()
    present = share[share > 0]
    words = raw.split()
    w = max(1, len(words))
    seen = Counter(words)
    lines = raw.splitlines()
    odd = sum(k for x, k in seen.items() if not x.rstrip(b".,;:!?\"')").isalnum() and x[-1] < 128)
    loud = sum(k for x, k in seen.items() if len(x) > 1 and x.isupper())
    root = math.sqrt
    return [
        math.log1p(len(words)), math.log((n + 1) / w), root(upper), root(digit), root(symbol), root(space), root(newline), root(high),
        math.log(len(seen) + 1) / math.log(w + 1) if words else 0.0, root(max(seen.values(), default=0) / w), len(set(lines)) / max(1, len(lines)),
        root(odd / w), root(loud / w), float(-(present * np.log2(present)).sum()) / 8, len(zlib.compress(raw, 1)) / (n + 16), math.log1p(n / max(1, len(lines))),
    ]


def vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, x)`` of every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t.as_py()) for t in b.column(1)], np.float64).reshape(b.num_rows, len(FEATURES))
            offsets = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], names=["id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, x array<double>")


def _matrix(b: pa.RecordBatch, column: int) -> np.ndarray:
    return b.column(column).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)


@dataclass
class Discriminant:
    """Standardisation, and per class the mean, inverse Cholesky factor, log determinant and log prior."""

    centre: np.ndarray
    scale: np.ndarray
    classes: list[tuple[np.ndarray, np.ndarray, float, float]]
    only: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.only is not None:
            return np.full(len(x), self.only)
        z = (x - self.centre) / self.scale
        logs = []
        for mean, factor, log_det, _ in self.classes:  # the factor's inverse, computed once
            y = factor @ (z - mean).T
            logs.append(-0.5 * ((y * y).sum(axis=0) + log_det))
        trust = -np.expm1(-np.expm1(x[:, 0]) / WORDS)  # a few words say little about a document
        odds = trust * (logs[1] - logs[0]) / TEMPER + self.classes[1][3] - self.classes[0][3]
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def fit(rows: DataFrame, pooled: float = POOLED, ridge: float = RIDGE) -> Discriminant:
    """Fits on all ``(x, y)`` rows with y 0 or 1; a class without rows makes the score constant."""
    d = len(FEATURES)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, d + 1, d + 1))
        for b in batches:
            x = np.hstack([np.ones((b.num_rows, 1)), _matrix(b, 0)]) if b.num_rows else np.zeros((0, d + 1))
            y = b.column(1).to_numpy(zero_copy_only=False)
            for c in (0, 1):
                total[c] += x[y == c].T @ x[y == c]
        cell = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.ravel())], names=["cell", "s"])

    total = np.zeros(2 * (d + 1) ** 2)
    for r in rows.mapInArrow(moments, "cell int, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect():  # as many rows as a matrix has cells
        total[r.cell] = r.s
    m = total.reshape(2, d + 1, d + 1)
    n = m[:, 0, 0]
    if n.min() < 1:
        return Discriminant(np.zeros(d), np.ones(d), [], float((n[1] + 0.5) / (n.sum() + 1)))
    centre = m[:, 0, 1:].sum(0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(m[:, 1:, 1:].sum(0)) / n.sum() - centre**2, 1e-8))
    means = [(m[c, 0, 1:] / n[c] - centre) / scale for c in (0, 1)]
    own = [(m[c, 1:, 1:] / n[c] - np.outer(m[c, 0, 1:], m[c, 0, 1:]) / n[c] ** 2) / np.outer(scale, scale) for c in (0, 1)]
    shared = (n[0] * own[0] + n[1] * own[1]) / n.sum()
    classes = []
    for c in (0, 1):
        s = (1 - pooled) * own[c] + pooled * shared
        s = (1 - ridge) * s + ridge * max(np.trace(s) / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(s)
        classes.append((means[c], np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum(), math.log(n[c] / n.sum())))
    return Discriminant(centre, scale, classes)


def held_out(id_col: Column) -> Column:
    """Whether the id belongs to the fold that is never learnt from; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def lessons(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", most: int = LEARN) -> DataFrame:
    """``(id, y)`` of the distinct labels 0 and 1 outside the held-out fold; of more than ``most`` about so many, chosen by a hash."""
    truth = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)").distinct().where(F.col("id").isNotNull() & ~held_out(F.col("id")))
    n = truth.count()
    return truth if n <= most else truth.where(F.pmod(F.xxhash64(F.lit("lesson"), "id"), F.lit(1 << 30)) < int(most / n * (1 << 30)))


def train(table: DataFrame, truth: DataFrame) -> Discriminant:
    """Fits on the rows of a vector table that :func:`lessons` has."""
    return fit(table.join(F.broadcast(truth), "id").select("x", "y"))  # about LEARN rows at most


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = CUT) -> DataFrame:
    """The rows of ``docs`` that :func:`classify` would predict 1 for, all columns kept and no text moved.

    Statistics are computed once for the rows learnt from and once for all rows that
    are scored. Null and empty texts, null ids and repeated rows are scored like any
    other; columns of any name are kept.
    """
    truth = cut(lessons(labels, id_col, label_col), "lessons")
    known = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(truth.select("id").distinct()), "id", "left_semi")
    model = train(cut(vectors(known, "id", "text"), "vectors"), truth)

    @F.pandas_udf("boolean")
    def good(text: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in text], np.float64).reshape(len(text), len(FEATURES))
        return pd.Series(model.score(x) >= threshold)

    return docs.where(good(F.col(text_col).cast("string")))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = CUT) -> DataFrame:
    """``(id_col, held_out, score, predicted)`` for every row of ``docs``.

    Learns from the label rows whose id is not held out and is found in ``docs``, all
    of them up to ``LEARN``; labels other than 0 and 1, null labels and null ids are
    ignored, repeated equal labels count once, and of conflicting ones each is learnt.
    Repeated rows are learnt from and scored each for itself. Whole texts are read. Empty and null texts have the all-zero vector. With one class
    only the score is its smoothed share, without labels 0.5. Only the id and the
    text are read, so other columns and their names don't matter.
    """
    table = cut(vectors(docs, id_col, text_col), "vectors")
    model = train(table, lessons(labels, id_col, label_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_matrix(b, 1)) if b.num_rows else np.zeros(0))], names=["id", "score"])

    scored = table.mapInArrow(run, "id long, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

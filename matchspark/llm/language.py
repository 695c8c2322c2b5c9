"""Language identification (operator 7): sparse multinomial logistic regression
on TF-IDF character n-grams, trained with follow-the-regularised-leader.

Features are the 1- to 3-grams of the lower-cased text (every character that
is no letter counts as a blank), hashed to ``DIM`` columns; the weight of a
column is ``log(1 + count) * idf``, rows have length 1.  Document frequencies
are counted over all documents that may be learnt from.  The model is fitted
on a bounded sample of labelled rows, at most ``PER_LABEL`` per language (those
with the smallest hash of doc_id), with per-coordinate FTRL-proximal steps and
an elastic-net penalty, which leaves most weights at exactly 0; a temperature
is then fitted on a fifth of the sample that took no part in training.

Defined results: a null text, or one without a letter, is ``und`` with score
0; with nothing to learn from every document is ``und``; texts of any length
are read whole; repeated doc_ids give one row each; an empty table gives an
empty result; equal scores go to the language that sorts first; other input
columns are never read.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchspark.llm.common import COUNTERS, counter_rows, record_batch, sum_counters
from matchspark.llm.words import mix, slices

DIM = 1 << 15
PER_LABEL = 800
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 1e-4
UNKNOWN = "und"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTER[0]


def _columns(codes: np.ndarray) -> list[np.ndarray]:
    """Hashed columns of the 1-, 2- and 3-grams that start at each character."""
    c = codes.astype(np.uint64)
    key, out = c, []
    for n in (1, 2, 3):
        if n > 1:
            key = key[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[n - 1:]
        out.append((mix(key + np.uint64(n)) >> np.uint64(64 - 15)).astype(np.int64))
    return out


def features(texts: list[str | None]):
    """For each text: (columns, counts), or None without a letter."""
    letter = _letters()
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = letter[codes]
    codes = np.where(letters, codes, 32)
    grams = _columns(codes) if len(codes) else [codes] * 3
    at = 0
    for t in lowered:
        n = len(t)
        if n and letters[at:at + n].any():
            counts = sum(np.bincount(g[at:max(at, at + n - k)], minlength=DIM) for k, g in enumerate(grams))
            used = np.flatnonzero(counts)
            yield used, counts[used]
        else:
            yield None
        at += n


class Model:
    def __init__(self, labels: list[str], idf: np.ndarray):
        self.labels, self.idf = labels, idf.astype(np.float32)
        self.weights = np.zeros((DIM, len(labels)), np.float32)
        self.bias = np.zeros(len(labels), np.float32)
        self.temperature = 1.0

    def row(self, columns: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts.astype(np.float32)) * self.idf[columns]
        return x / max(1e-12, float(np.sqrt((x * x).sum())))

    def margin(self, columns: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.row(columns, counts) @ self.weights[columns] + self.bias

    def fit(self, rows: list[tuple], labels: np.ndarray, seed: int = 17) -> Model:
        """``rows``: (columns, counts); a fifth is kept for the temperature."""
        k = len(self.labels)
        rng = np.random.default_rng(seed)
        held = rng.random(len(rows)) < 0.2
        held &= len(rows) > 10 * k
        x = [self.row(*r) for r in rows]
        z, n = np.zeros((DIM + 1, k)), np.zeros((DIM + 1, k))
        target = np.eye(k)
        train = np.flatnonzero(~held)
        for _ in range(EPOCHS):
            for i in rng.permutation(train):
                at = np.append(rows[i][0], DIM)            # the last column is the bias
                v = np.append(x[i], 0.1)[:, None]
                zi, ni = z[at], n[at]
                root = np.sqrt(ni)
                w = np.where(np.abs(zi) > L1, -(zi - np.sign(zi) * L1) / ((BETA + root) / ALPHA + L2), 0)
                s = (v * w).sum(0)
                p = np.exp(s - s.max())
                g = (p / p.sum() - target[labels[i]]) * v
                z[at] = zi + g - (np.sqrt(ni + g * g) - root) / ALPHA * w
                n[at] = ni + g * g
        w = np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0)
        self.weights, self.bias = w[:DIM].astype(np.float32), (0.1 * w[DIM]).astype(np.float32)
        if held.any():
            s = np.array([self.margin(*rows[i]) for i in np.flatnonzero(held)], np.float64)
            y = labels[held]
            loss = []
            grid = np.geomspace(0.05, 5, 60)
            for t in grid:
                q = s / t - (s / t).max(1, keepdims=True)
                loss.append(-(q[np.arange(len(y)), y] - np.log(np.exp(q).sum(1))).mean())
            self.temperature = float(grid[int(np.argmin(loss))])
        return self

    def predict(self, columns: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        s = self.margin(columns, counts).astype(np.float64) / self.temperature
        p = np.exp(s - s.max())
        best = int(p.argmax())
        return self.labels[best], float(p[best] / p.sum())


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """How many of the texts (column ``text``) have each feature column, and how many have any."""
    size = DIM + (1 << 14)

    def run(batches):
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for lo, hi, _, _ in slices(batch.column(0), 1 << 20):
                for f in features(batch.column(0).slice(lo, hi - lo).to_pylist()):
                    if f:
                        counts[f[0]] += 1
                        counts[DIM] += 1
        yield counter_rows(counts)
    total = sum_counters(docs.select("text").mapInArrow(run, COUNTERS), size)
    return total[:DIM], int(total[DIM])


def train(docs: DataFrame, learn: Column, text_col: str = "text", label_col: str = "lang",
          id_col: str = "doc_id", per_label: int = PER_LABEL) -> Model:
    """Fits the model on rows where ``learn`` holds and the label is not null."""
    rows = docs.filter(learn & F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
        F.col(label_col).cast("string").alias("label"))
    df, n = document_frequencies(rows)
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    # about per_label rows of each label, by the hash of the id
    key = F.shiftrightunsigned(F.xxhash64("id"), 11) / F.lit(float(1 << 53))
    keep = F.lit(False)
    for label, size in sizes.items():
        keep = keep | ((F.col("label") == label) & (F.col("key") < min(1.0, 1.25 * per_label / size)))
    schema = pa.schema([("key", pa.float64()), ("label", pa.string()),
                        ("columns", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            found = list(features(batch.column(2).to_pylist()))
            some = [i for i, f in enumerate(found) if f]
            at = pa.array(some, pa.int64())
            yield record_batch(schema, key=batch.column(0).take(at), label=batch.column(1).cast(pa.string()).take(at),
                               columns=[found[i][0] for i in some], counts=[found[i][1] for i in some])
    sample = (rows.withColumn("key", key).filter(keep).select("key", "label", "text")
              .mapInArrow(run, "key double, label string, columns array<int>, counts array<int>").toArrow()
              .sort_by([("label", "ascending"), ("key", "ascending")]))
    labels = sorted(set(sample.column("label").to_pylist()))
    taken, chosen = dict.fromkeys(labels, 0), []
    for i, label in enumerate(sample.column("label").to_pylist()):
        if taken[label] < per_label:
            taken[label] += 1
            chosen.append((label, i))
    data = [(np.array(sample.column("columns")[i].as_py(), np.int64), np.array(sample.column("counts")[i].as_py()))
            for _, i in chosen]
    model = Model(labels, np.log((1 + n) / (1 + df)) + 1)
    if labels:
        model.fit(data, np.array([labels.index(x) for x, _ in chosen]))
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches):
        m = shared.value
        for batch in batches:
            for lo, hi, _, _ in slices(batch.column(1), 1 << 20):
                got = [m.predict(*f) if f and m.labels else (UNKNOWN, 0.0)
                       for f in features(batch.column(1).slice(lo, hi - lo).to_pylist())]
                yield record_batch(schema, doc_id=batch.column(0).slice(lo, hi - lo).cast(pa.int64()),
                                   lang_pred=[g[0] for g in got], score=[g[1] for g in got])
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, lang_pred string, score double"))


def in_known_language(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows whose text has a best language with at least that score; columns
    unchanged.  The scan's rows pass through the predicting task, nothing is joined."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    order = [text_col, *(c for c in docs.columns if c != text_col)]
    rows = docs.select(order)

    def run(batches):
        m = shared.value
        for batch in batches:
            for lo, hi, _, _ in slices(batch.column(0), 1 << 20):
                part = batch.slice(lo, hi - lo)
                keep = [bool(f and m.labels and m.predict(*f)[1] >= least)
                        for f in features(part.column(0).to_pylist())]
                yield part.filter(pa.array(keep, pa.bool_()))
    return rows.mapInArrow(run, rows.schema).select(*docs.columns)

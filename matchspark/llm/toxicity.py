"""Toxicity severity by cumulative-link ordinal regression (operator 6).

One weight vector over sparse word features is shared by ordered thresholds:
``P(grade <= k) = sigmoid(threshold_k - w.x)``.  Features are the words of the
whole text (letters and digits, A-Z in lower case), ``log(1 + count)`` each;
those of the training sample that occur in ``MIN_DOCS`` of its documents and differ
clearly between the labels have weights, fitted by per-coordinate adaptive steps
with an L1 penalty.

Grades: labels only say toxic or not, so the training grade of a toxic
document follows from how dense its marker words are (words whose smoothed
log-odds for toxic exceed ``MARKER``): 1 up to ``GRADE_CUTS[0]`` of its words,
2 up to ``GRADE_CUTS[1]``, 3 above; 0 is not toxic.  The sample is bounded:
about ``PER_LABEL`` documents of either label, picked by the hash of doc_id,
equal texts once.

Defined results: a null or empty text has no features and the grade of the
thresholds alone; without labels of both kinds every document has severity 0;
conflicting labels of one doc_id count as toxic; repeated doc_ids give one row
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspark.llm.common import record_batch, uniform
from matchspark.llm.words import NON_ALNUM, batch_words

PER_LABEL = 4000
MIN_DOCS = 3
MARKER = 3.0
GRADE_CUTS = (0.01, 0.03)
GRADES = 4
CLEAR = 2.2
EPOCHS, RATE, L1 = 10, 0.3, 5e-5
DECISION = 0.3
FILTER_BITS = 20


def _counts(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(h, return_counts=True)


class Model:
    def __init__(self):
        self.keys = np.empty(0, np.uint64)
        self.weights = np.empty(0, np.float64)
        # no labels: everything is certainly grade 0
        self.thresholds = np.full(GRADES - 1, 50.0)

    def fit(self, docs: list[np.ndarray], toxic: np.ndarray, seed: int = 23) -> Model:
        """``docs``: word hashes of each document; ``toxic``: 0 or 1."""
        counts = [_counts(h) for h in docs]
        keys, df = np.unique(np.concatenate([c[0] for c in counts]), return_counts=True)
        self.keys = keys = keys[df >= MIN_DOCS]
        rows = []
        for k, n in counts:
            at = np.searchsorted(keys, k)
            ok = at < len(keys)
            ok[ok] = keys[at[ok]] == k[ok]
            rows.append((at[ok], n[ok]))
        hits = np.zeros((2, len(keys)))
        for (at, _), y in zip(rows, toxic):
            hits[y, at] += 1
        size = np.array([(toxic == 0).sum(), (toxic == 1).sum()])
        rate = (hits + 0.5) / (size[:, None] + 1)
        odds = np.log(rate[1] / (1 - rate[1])) - np.log(rate[0] / (1 - rate[0]))
        error = np.sqrt((1 / (rate * (1 - rate)) / (size[:, None] + 1)).sum(0))
        marker = odds > MARKER
        # only words that clearly differ between the labels have weights
        clear = np.abs(odds) > CLEAR * error
        share = np.array([n[marker[at]].sum() / max(1, len(h)) for (at, n), h in zip(rows, docs)])
        grade = np.where(toxic == 1, 1 + np.digitize(share, GRADE_CUTS), 0)
        rows = [(at[clear[at]], n[clear[at]]) for at, n in rows]
        x = [np.log1p(n.astype(np.float64)) for _, n in rows]
        w, g2 = np.zeros(len(keys)), np.full(len(keys), 1e-3)
        t, t2 = np.array([0.0, 1.0, 2.0]), np.full(GRADES - 1, 1e-3)
        rng = np.random.default_rng(seed)
        sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        for _ in range(EPOCHS):
            for i in rng.permutation(len(rows)):
                at, y = rows[i][0], grade[i]
                z = t - float(x[i] @ w[at])
                # cumulative probabilities on both sides of the grade
                hi = sig(z[y]) if y < GRADES - 1 else 1.0
                lo = sig(z[y - 1]) if y else 0.0
                p = max(hi - lo, 1e-9)
                dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p
                gw = (dhi - dlo) * x[i]
                gt = np.zeros(GRADES - 1)
                if y < GRADES - 1:
                    gt[y] -= dhi
                if y:
                    gt[y - 1] += dlo
                g2[at] += gw * gw
                step = RATE / np.sqrt(g2[at])
                v = w[at] - step * gw
                w[at] = np.sign(v) * np.maximum(np.abs(v) - step * L1 * np.sqrt(len(rows)), 0)
                t2 += gt * gt
                t = np.maximum.accumulate(t - RATE / np.sqrt(t2) * gt)
        used = w != 0
        self.keys, self.weights, self.thresholds = keys[used], w[used], t
        return self

    def distribution(self, scores: np.ndarray) -> np.ndarray:
        """Probability of every grade for linear scores."""
        upto = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - scores[:, None], -500, 500)))
        return np.diff(np.concatenate((np.zeros((len(scores), 1)), upto, np.ones((len(scores), 1))), 1), axis=1)

    def scores(self, h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """Linear score of ``n`` documents from word hashes and their document numbers."""
        out = np.zeros(n)
        if not len(self.keys):
            return out
        if not hasattr(self, "filter"):
            self.filter = np.zeros(1 << FILTER_BITS, bool)
            self.filter[self.keys >> np.uint64(64 - FILTER_BITS)] = True
        some = self.filter[h >> np.uint64(64 - FILTER_BITS)]
        h, doc = h[some], doc[some]
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        known = self.keys[at] == h
        pair, count = np.unique(doc[known] * len(self.keys) + at[known], return_counts=True)
        np.add.at(out, pair // len(self.keys), np.log1p(count) * self.weights[pair % len(self.keys)])
        return out


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> Model:
    marks = (labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id"))
             .agg(F.max(F.col(label_col).cast("int")).alias("label")))
    sizes = {r.label: r["count"] for r in marks.groupBy("label").count().collect()}
    keep = F.lit(False)
    for label in (0, 1):
        keep = keep | ((F.col("label") == label) & (uniform("id") < min(1.0, per_label / max(1, sizes.get(label, 1)))))
    # about two times per_label rows of two numbers
    picked = marks.filter(keep)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(picked), "id").select("id", "label", "text")
    schema = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("words", pa.binary())])

    def run(batches):
        for batch in batches:
            for lo, hi, w in batch_words(batch.column(2), NON_ALNUM, True):
                yield record_batch(schema, id=batch.column(0).slice(lo, hi - lo), label=batch.column(1).slice(lo, hi - lo),
                                   words=[w.hash[w.first[i]:w.first[i + 1]].tobytes() for i in range(hi - lo)])
    found = rows.mapInArrow(run, "id long, label int, words binary").dropDuplicates(["words", "label"]).collect()
    found = sorted((r.id, r.label, r.words) for r in found)
    toxic = np.array([r[1] for r in found], np.int64)
    if len(set(toxic.tolist())) < 2:
        return Model()
    return Model().fit([np.frombuffer(r[2], np.uint64) for r in found], toxic)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            decision: float = DECISION) -> DataFrame:
    """``doc_id, expected_severity`` (0 to 3), ``grade`` (the likeliest), ``p_toxic``
    (probability of a grade above 0) and ``toxic``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("expected_severity", pa.float64()), ("grade", pa.int32()),
                        ("p_toxic", pa.float64()), ("toxic", pa.bool_())])

    def run(batches):
        m = shared.value
        for batch in batches:
            for lo, hi, w in batch_words(batch.column(1), NON_ALNUM, True):
                p = m.distribution(m.scores(w.hash, w.doc_of_word(), hi - lo))
                yield record_batch(schema, doc_id=batch.column(0).slice(lo, hi - lo), expected_severity=p @ np.arange(GRADES),
                                   grade=p.argmax(1).astype(np.int32), p_toxic=1 - p[:, 0], toxic=1 - p[:, 0] >= decision)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, expected_severity double, grade int, p_toxic double, toxic boolean"))

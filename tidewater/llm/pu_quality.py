"""Quality classifier: positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are labelled good documents; everything else that the model
learns from is unlabelled web text.  With class prior pi the risk is

    pi R+(positives) + max(0, R-(unlabelled) - pi R-(positives))

The second term estimates the risk on unseen negatives and would go below zero
when a model over-fits; then a step goes up that term instead (non-negative
correction).  The prior is the share of good rows in the audited label sample.

A text becomes counts of three-signs-in-a-row over ten classes of bytes (lower
case, upper case, digits, space, line ends, ...; square roots of shares) and a
few shares of repeated words, lines and three-word windows; whole texts,
in array operations.  A linear model scores them.

Learning reads at most ``POSITIVES`` + ``UNLABELLED`` documents and ``AUDIT``
labels (lowest hash of the id first); only their feature rows come to the
driver.  Applying is a narrow map.

Defined results: a null text is an empty one and is scored like any other;
without positives every score is the prior (0.5 without labels); labels that
are null or contradict each other for one id are left out; repeated rows get
equal scores.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.hashing import word_hashes

POSITIVES, UNLABELLED, AUDIT = 4_000, 6_000, 20_000
_CLASS = np.full(256, 8, np.uint8)              # other signs
_CLASS[list(range(97, 123))] = 0
_CLASS[list(range(65, 91))] = 1
_CLASS[list(range(48, 58))] = 2
_CLASS[[9, 11, 12, 13, 32]] = 3
_CLASS[10] = 4
_CLASS[[44, 46, 39, 45]] = 5                    # , . ' -
_CLASS[list(b"!?:;\"()")] = 6
_CLASS[list(b"#*$%&|<>")] = 7
_CLASS[128:] = 9
SIGNS = 10
DIM = SIGNS ** 3 + 8


def features(text: str) -> np.ndarray:
    raw = text.encode()
    out = np.zeros(DIM, np.float32)
    c = _CLASS[np.frombuffer(raw, np.uint8)].astype(np.int16)
    if len(c) > 2:
        n = np.bincount(c[:-2] * 100 + c[1:-1] * 10 + c[2:], minlength=SIGNS ** 3)
        out[:SIGNS ** 3] = np.sqrt(n / n.sum())
    w = word_hashes(raw)
    if len(w):
        runs = w[:-2] * np.uint64(0x9E3779B97F4A7C15) + w[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + w[2:] if len(w) > 2 else w[:0]
        same = len(runs) and 1 - len(np.unique(runs)) / len(runs)
        lines = [x for x in raw.split(b"\n") if x.strip()]
        out[SIGNS ** 3:] = (
            len(np.unique(w)) / len(w), same, 1 - len(set(lines)) / len(lines), min(1.0, float((w >> np.uint64(32)).mean()) / 12),
            np.log1p(len(w)) / 12, len(w) < 20, same > 0.2, same > 0.5)
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray | None
    bias: float
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def fit(pos: np.ndarray, unl: np.ndarray, prior: float, epochs: int = 60, batch: int = 500, rate: float = 0.02, decay: float = 1e-4, seed: int = 2) -> Model:
    """Minimise the non-negative PU risk (sigmoid loss) by Adam over mini-batches."""
    if not len(pos) or not len(unl):
        return Model(None, 0.0, prior)
    rng = np.random.default_rng(seed)
    w, m, v, t = np.zeros(DIM + 1), np.zeros(DIM + 1), np.zeros(DIM + 1), 0
    p1, u1 = (np.c_[x, np.ones(len(x), np.float32)].astype(np.float64) for x in (pos, unl))
    steps = max(1, len(u1) // batch)
    for epoch in range(epochs):
        po, uo = rng.permutation(len(p1)), rng.permutation(len(u1))
        for s in range(steps):
            xp, xu = p1[po[s::steps]], u1[uo[s::steps]]
            if not len(xp) or not len(xu):
                continue
            sp, su = 1 / (1 + np.exp(-np.clip(xp @ w, -30, 30))), 1 / (1 + np.exp(-np.clip(xu @ w, -30, 30)))
            # sigmoid loss: 1 - s for positives, s for negatives; its slope is s (1 - s)
            dp, du = (sp * (1 - sp)) @ xp / len(xp), (su * (1 - su)) @ xu / len(xu)
            negative = su.mean() - prior * sp.mean()
            grad = -prior * dp + du - prior * dp if negative >= 0 else -(du - prior * dp)
            grad = grad + decay * np.r_[w[:-1], 0]
            t += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
            w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Model(w[:-1].astype(np.float32), float(w[-1]), prior)


def _featurised(df: DataFrame) -> DataFrame:
    """(good, x) of (good, text): features as packed 32-bit floats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t.as_py() or "").tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("good"), pa.array(x, pa.binary())], ["good", "x"])
    return df.select("good", "text").mapInArrow(run, "good boolean, x binary")


def _least(df: DataFrame, size: int, total: int) -> DataFrame:
    """The ``size`` rows of least id hash; a threshold keeps the rows that meet to about twice that."""
    order = F.pmod(F.xxhash64(F.lit(2), F.col("id")), F.lit(1 << 30))
    return df.where(order <= int(min(1.0, (2 * size + 50) / max(1, total)) * (1 << 30))).orderBy(order, "id").limit(size)


def learn(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          positives: int = POSITIVES, unlabelled: int = UNLABELLED, audit: int = AUDIT) -> Model:
    """Learn from documents and the labels given; rows to hold out must be left out of both."""
    known = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
             .agg(F.min("quality").alias("lo"), F.max("quality").alias("hi")).where("lo = hi").select("id", (F.col("lo") == 1).alias("good")))
    n = known.agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("p")).first()
    if not n["p"]:
        return Model(None, 0.0, 0.5)
    share = _least(known, audit, n["n"]).agg(F.avg(F.col("good").cast("double")).alias("s")).first()["s"]
    docs = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    # the label side is bounded by ``positives``
    pos = docs.join(F.broadcast(_least(known.where("good"), positives, n["p"])), "id")
    unl = docs.join(F.broadcast(_least(docs.select("id").where("id IS NOT NULL").distinct(), unlabelled, docs.count())), "id").withColumn("good", F.lit(False))
    # one row of each id, so that repeated ids keep the bound
    one = pos.select("good", "id", "text").unionByName(unl.select("good", "id", "text")).groupBy("good", "id").agg(
        F.min(F.struct(F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "text")).alias("row")).select("good", "row.text")
    rows = _featurised(one).collect()
    of = lambda good: np.array([np.frombuffer(r["x"], np.float32) for r in rows if r["good"] == good], np.float32).reshape(-1, DIM)
    order = lambda x: x[np.lexsort(x[:, :40].T)] if len(x) else x  # noqa: E731  the same order whatever the task order was
    return fit(order(of(True)), order(of(False)), float(min(max(share, 0.01), 0.99)))


def score(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1, higher: better) for each row's whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{c}` {dict(df.dtypes)[c]}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for first in range(0, len(b), 256):
                part = b.slice(first, 256)
                x = np.array([features(t.as_py() or "") for t in part.column("__text")])
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(m.scores(x).astype(float))], [*keep, "score"])

    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, f"{schema}, score double")

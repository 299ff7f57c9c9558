"""Language ID: blended-spectrum string kernel, Nystroem landmarks, kernel ridge regression.

A text is the set of its byte n-grams of 1 to 3 (lower-cased, white space runs
as one space), hashed to ``DIM`` positions.  The kernel of two texts is the
number of shared n-grams over the root of the product of their counts.  Against
``LANDMARKS`` learned texts that kernel gives a Nystroem feature map, on which
one ridge regression per language (one versus rest) is solved in closed form.
Landmark kernel, whitening and regression fold into two matrices, so a block
of texts is scored by two matrix products.

Learning reads at most ``SAMPLE`` labelled documents (lowest hash of the id
first, the same number for each language as far as there are); applying is a
narrow map over whole texts.

Defined results: a null text, or one without any letter, is ``und`` with score
0; without labelled rows every text is ``und``; ties go to the language that
sorts first; repeated rows get equal predictions.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

SAMPLE, LANDMARKS, DIM, RIDGE = 2_000, 160, 1 << 13, 1e-2
BATCH = 64
UNKNOWN = "und"
#: Letters and some numbers that are no digits; ``str.isalpha`` tells them apart.
_WORDLIKE = re.compile(r"[^\W\d_]")
_TO_SPACE = np.arange(256, dtype=np.uint8)
_TO_SPACE[[9, 10, 11, 12, 13]] = 32


def has_letter(text: str) -> bool:
    """Whether a character of a Unicode letter category occurs."""
    return any(m.group().isalpha() for m in _WORDLIKE.finditer(text))


def positions(text: str) -> np.ndarray:
    """Hashed positions of the text's n-grams, each once."""
    b = np.frombuffer(text.lower().encode(), np.uint8)
    b = _TO_SPACE[b]
    if len(b) > 1:
        b = b[np.r_[True, (b[1:] != 32) | (b[:-1] != 32)]]
    x = b.astype(np.uint32)
    seen = np.zeros(DIM, bool)
    shift = np.uint32(32 - DIM.bit_length() + 1)
    for n in (1, 2, 3):
        if len(x) >= n:
            key = x[:len(x) - n + 1].copy()
            for i in range(1, n):
                key = key << np.uint32(8) | x[i:len(x) - n + 1 + i]
            seen[(key * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35) >> shift] = True
    return np.flatnonzero(seen)


def presence(texts: list[str]) -> np.ndarray:
    """A row per text: 1 / sqrt(n-grams) at its positions, so that products are kernel values."""
    out = np.zeros((len(texts), DIM), np.float32)
    for row, t in zip(out, texts):
        at = positions(t)
        if len(at):
            row[at] = 1 / np.sqrt(len(at))
    return out


@dataclass(frozen=True)
class Model:
    langs: list[str]
    landmarks: np.ndarray       # DIM x landmarks
    weights: np.ndarray         # (landmarks + 1) x languages

    def scores(self, texts: list[str]) -> np.ndarray:
        k = presence(texts) @ self.landmarks
        return np.c_[k, np.ones(len(texts), np.float32)] @ self.weights


def _shares(s: np.ndarray) -> np.ndarray:
    """Probabilities from the regressions' outputs (about 1 for the own language, 0 for others)."""
    e = np.exp(8 * (s - s.max(axis=1, keepdims=True)))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], langs: list[str], seed: int = 8) -> Model | None:
    names = sorted(set(langs))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    x = presence(texts)
    y = np.array([names.index(g) for g in langs])
    per = max(1, LANDMARKS // len(names))
    pick = np.concatenate([rng.permutation(np.flatnonzero(y == c))[:per] for c in range(len(names))])
    marks = x[pick].T.copy()
    values, vectors = np.linalg.eigh((marks.T @ marks).astype(np.float64))
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    z = np.c_[(x @ marks) @ whiten, np.ones(len(x))]
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, 0.0)
    # each language weighs the same
    weight = (1 / np.bincount(y, minlength=len(names)))[y][:, None]
    solved = np.linalg.solve((z * weight).T @ z + RIDGE * np.eye(z.shape[1]), (z * weight).T @ target)
    return Model(names, marks, np.r_[whiten @ solved[:-1], solved[-1:]].astype(np.float32))


def sample(df: DataFrame, doc_id: str, text: str, lang: str, size: int) -> list[tuple[str, str]]:
    """At most ``size`` (text, lang) of rows with a language and a letter; whole texts."""
    rows = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    per = max(1, size // len(counts))
    order = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    # a threshold on the hash first: about twice the wanted rows per language meet in the window
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(min(1.0, 2 * per / n + 50 / n) * (1 << 30)))])
    rows = rows.withColumn("o", order).where(F.col("o") <= F.try_element_at(share, "lang"))
    rows = rows.withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("o", "id"))).where(F.col("n") <= per)
    return sorted(((r["text"], r["lang"]) for r in rows.select("text", "lang").toLocalIterator()), key=lambda r: (r[1], r[0]))


def predict(df: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` for each row's whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{c}` {dict(df.dtypes)[c]}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            names, scores = [UNKNOWN] * len(b), np.zeros(len(b))
            texts, at = [], []

            def score_held():
                p = _shares(m.scores(texts))
                best = p.argmax(axis=1)
                for i, c, v in zip(at, best, p[np.arange(len(p)), best]):
                    names[i], scores[i] = m.langs[c], v
                texts.clear()
                at.clear()

            for i, t in enumerate(b.column("__text")):
                t = t.as_py()
                if m is not None and t and has_letter(t):
                    texts.append(t)
                    at.append(i)
                    if len(texts) == BATCH:
                        score_held()
            if texts:
                score_held()
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(names), pa.array(np.clip(scores, 0, 1))],
                                             [*keep, "lang_pred", "score"])

    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, f"{schema}, lang_pred string, score double")


def identify(df: DataFrame, learn_from: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             keep: tuple[str, ...] = ("doc_id",), sample_rows: int = SAMPLE) -> DataFrame:
    """Learn on a bounded sample of ``learn_from`` and predict every row of ``df``."""
    rows = sample(learn_from, doc_id, text, lang, sample_rows)
    return predict(df, fit([t for t, _ in rows], [g for _, g in rows]), text, keep)

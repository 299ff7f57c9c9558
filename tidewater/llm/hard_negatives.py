"""Hard negatives by exact integer scores from Kronecker-packed products.

Components become integers (floor of ``SCALE`` times the value).  Of a block of candidates, every component is biased
to be non-negative and put into a field of its own of one wide integer per dimension.  An anchor multiplies each of
these integers once, by its own component; the sum holds all candidates' inner products side by side, and an offset in
every field keeps them from borrowing.  Unpacking takes off offset and bias.  The field width follows from the block's
and the anchors' ranges, so scores are exact whatever they are.

Anchors meet candidates block by block: anchor blocks (at most about ``ANCHORS`` rows) and candidate blocks (at most
``BLOCK``) are rows of two tables, joined on anchor block and a salt.  Each task keeps a running best of its pairs, so
it passes on a few rows per anchor; a window per anchor takes the best of those.  First the positives, then, with
their scores known, the negatives in each positive's band.

Defined results: rows with a null id, label or vector, or a null or non-finite component, take no part; a vector that
is shorter than others is zero beyond its end; rows that repeat an id are rows of their own, but not another row to an
anchor of that id; equal anchor rows are answered once; an anchor without positives, or a positive without a negative
in its band, has no rows; an empty table gives none; other columns are not read.  Scores of 2^55 and more in size,
which the products with the band's percentages would not hold, raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import staged

SCALE, ANCHORS, BLOCK = 256, 512, 8192
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
_LIMIT = 1 << 55
_BLOCK = "ids binary, labels binary, dims int, cells binary"


def usable(df: DataFrame, vec_id: str, vector: str, label: Column) -> DataFrame:
    """(id, label, vector) of the rows that take part."""
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (df.select(F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
            .where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(finite))


def _block(ids: np.ndarray, labels: np.ndarray, vectors: pa.Array) -> tuple[bytes, bytes, int, bytes]:
    """A block's columns, in order of id; components as 64-bit integers."""
    n = np.diff(np.asarray(vectors.offsets))
    dims = int(n.max(initial=0))
    scaled = np.floor(SCALE * np.asarray(vectors.flatten(), np.float64))
    if len(scaled) and np.abs(scaled).max() >= 2.0 ** 62:
        raise ValueError("a component is too large for exact 64-bit scores")
    cells = np.zeros((len(ids), dims), np.int64)
    cells[np.arange(dims) < n[:, None]] = scaled.astype(np.int64)
    order = np.argsort(ids, kind="stable")
    return ids[order].tobytes(), labels[order].tobytes(), dims, cells[order].tobytes()


def _columns(b) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    vectors = b.column("vector")
    return (np.asarray(b.column("id"), np.int64), np.asarray(b.column("label"), np.int64),
            vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors)


def candidate_blocks(rows: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, size):
                ids, labels, dims, cells = _block(*_columns(b.slice(lo, size)))
                yield pa.RecordBatch.from_arrays([pa.array([ids]), pa.array([labels]), pa.array([dims], pa.int32()), pa.array([cells])],
                                                 ["ids", "labels", "dims", "cells"])
    return rows.mapInArrow(run, _BLOCK)


def anchor_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    def run(t: pa.Table) -> pa.Table:
        ids, labels, dims, cells = _block(*_columns(t))
        return pa.table({"anchors": t.column("anchors").slice(0, 1), "ids": [ids], "labels": [labels], "dims": pa.array([dims], pa.int32()), "cells": [cells]})
    return (rows.distinct().withColumn("anchors", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("long"))
            .groupBy("anchors").applyInArrow(run, "anchors bigint, " + _BLOCK))


class Packed:
    """Candidates' components, a wide integer per dimension."""

    def __init__(self, cells: np.ndarray, largest: int):
        self.n, self.dims = cells.shape
        low, high = (int(cells.min()), int(cells.max())) if cells.size else (0, 0)
        self.bias = max(0, -low)
        bound = max(1, self.dims * largest * (high + self.bias))         # of a biased score's size
        if self.dims * largest * max(high, -low) >= _LIMIT:
            raise ValueError("scores would not fit in 55 bits")
        self.offset = bound
        self.words = -(-(2 * bound + 1).bit_length() // 32)              # of 32 bits for a field
        biased = (cells.T + self.bias).astype(np.uint64)
        fields = np.zeros((self.dims, self.n, self.words), "<u4")
        fields[:, :, 0] = biased & np.uint64(0xFFFFFFFF)
        if self.words > 1:
            fields[:, :, 1] = biased >> np.uint64(32)
        self.wide = [int.from_bytes(f.tobytes(), "little") for f in fields]
        ones = np.zeros((self.n, self.words), "<u4")
        ones[:, 0] = 1
        self.offsets = self.offset * int.from_bytes(ones.tobytes(), "little")

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """All candidates' inner products with the anchor."""
        own = anchor[:self.dims].tolist()
        total = self.offsets
        for a, wide in zip(own, self.wide):
            if a:
                total += a * wide
        fields = np.frombuffer(total.to_bytes(4 * self.n * self.words, "little"), "<u4").reshape(self.n, self.words)
        value = fields[:, 0].astype(np.uint64)
        if self.words > 1:                                               # modulo 2^64; the score itself has 55 bits
            value |= fields[:, 1].astype(np.uint64) << np.uint64(32)
        return (value - np.uint64((self.offset + self.bias * sum(own)) % (1 << 64))).view(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` highest scores, ties by smaller id."""
    if len(score) > 4 * most:
        keep = score >= np.partition(score, len(score) - most)[len(score) - most]
        score, ids = score[keep], ids[keep]
    order = np.lexsort((ids, -score))[:most]
    return score[order], ids[order]


def _wanted_positives(i, anchor_id, label, positives, ids, of_label, labels, score):
    mine = of_label.get(label, ())
    mine = mine[ids[mine] != anchor_id] if len(mine) else np.empty(0, np.int64)
    yield (0, 0, 0), score[mine], ids[mine], POSITIVES


def _wanted_negatives(i, anchor_id, label, positives, ids, of_label, labels, score):
    other = labels != label
    for rank, pid, s in positives.get(i, ()):
        hit = np.flatnonzero(other & (100 * score >= LOW * s) & (100 * score <= HIGH * s))
        yield (rank, pid, s), score[hit], ids[hit], NEGATIVES


def _pairs(wanted):
    """Running best of each anchor (and positive) over the block pairs of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        now = None

        def out() -> pa.RecordBatch:
            rows = [(now, i, a, *key, int(s), int(d)) for (i, a, key), (ss, dd) in best.items() for s, d in zip(ss, dd)]
            kinds = [pa.int64()] * 8
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds)],
                                              ["anchors", "i", "anchor_id", "nth", "positive_id", "positive_score", "score", "id"])

        for b in batches:
            for r in (row for k in range(b.num_rows) for row in b.slice(k, 1).to_pylist()):
                if r["anchors"] != now:
                    if best:
                        yield out()
                    now, best = r["anchors"], {}
                    a_ids, a_labels = np.frombuffer(r["a_ids"], np.int64), np.frombuffer(r["a_labels"], np.int64)
                    a_cells = np.frombuffer(r["a_cells"], np.int64).reshape(len(a_ids), r["a_dims"])
                    positives: dict = {}
                    for p in r.get("positives") or ():
                        positives.setdefault(p["i"], []).append((p["nth"], p["positive_id"], p["positive_score"]))
                ids, labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
                dims = min(r["dims"], r["a_dims"])
                cells = np.frombuffer(r["cells"], np.int64).reshape(len(ids), r["dims"])[:, :dims]
                packed = Packed(cells, int(np.abs(a_cells[:, :dims]).max(initial=0)))
                of_label = {int(x): np.flatnonzero(labels == x) for x in np.unique(labels)}
                for i in range(len(a_ids)):
                    score = packed.scores(a_cells[i, :dims])
                    for key, s, d, most in wanted(i, int(a_ids[i]), int(a_labels[i]), positives, ids, of_label, labels, score):
                        if len(s):
                            have = best.get((i, int(a_ids[i]), key))
                            if have is not None:
                                s, d = np.r_[have[0], s], np.r_[have[1], d]
                            best[i, int(a_ids[i]), key] = _best(s, d, most)
        if best:
            yield out()
    return run


_FOUND = "anchors bigint, i bigint, anchor_id bigint, nth bigint, positive_id bigint, positive_score bigint, score bigint, id bigint"


def mine(df: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: Column | None = None,
         anchors_a_block: int = ANCHORS, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` says which rows are anchors, in terms of the column ``id``; ``label`` is the label to use.
    """
    spark = df.sparkSession
    rows = usable(df, vec_id, vector, F.col("label") if label is None else label)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    candidates = staged(candidate_blocks(rows, block), "candidate-blocks")
    chosen = rows.where(anchor)
    blocks = max(1, -(-chosen.count() // anchors_a_block))
    anchors = staged(anchor_blocks(chosen, blocks), "anchor-blocks").select(
        "anchors", *[F.col(c).alias(f"a_{c}") for c in ("ids", "labels", "dims", "cells")])
    salts = -(-parts // blocks)
    grid = (candidates.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(salts)))
            .withColumn("anchors", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>"))).repartition(parts, "anchors", "salt"))

    def meet(left: DataFrame, wanted) -> DataFrame:
        salted = left.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
        return grid.join(salted, ["anchors", "salt"]).sortWithinPartitions("anchors").mapInArrow(_pairs(wanted), _FOUND)

    def first(found: DataFrame, keys: list[str], most: int) -> DataFrame:
        order = W.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    positives = first(meet(anchors, _wanted_positives), ["anchors", "i"], POSITIVES)
    per_block = positives.groupBy("anchors").agg(F.collect_list(F.struct(
        "i", F.col("rank").cast("long").alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))).alias("positives"))
    negatives = first(meet(anchors.join(staged(per_block, "positives"), "anchors"), _wanted_negatives), ["anchors", "i", "nth"], NEGATIVES)
    return negatives.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ORACLE = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES})
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score
QUALIFY rank <= {NEGATIVES}
"""

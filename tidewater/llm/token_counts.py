"""Token counts: an exact histogram of encoded lengths, and what its suffix sums answer.

Documents are reduced to (length, documents) in one map-side combined
aggregate.  Suffix sums over the histogram then answer, for every context
limit, how many documents reach it, how many tokens they hold, and what is
left when every document is cut at the limit; totals and exact quantiles come
from the same rows.  Only counts per length are ever gathered.

Defined results: a null or empty text has length 0; repeated rows count as
often as they occur; an empty table gives an empty histogram; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import running_total, staged
from tidewater.llm.tokens import blocks, default_path, encoder

#: Lengths per block of the two-level prefix sum.
BLOCK = 1 << 10


def lengths(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``n_tokens`` per row."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in blocks(b.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(encoder(path).block(texts, False)[1], pa.int64())], ["n_tokens"])

    return df.select(F.col(text)).mapInArrow(run, "n_tokens bigint")


def histogram(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """Per length: documents, and prefix and suffix sums of documents and tokens.

    ``docs_below``/``tokens_below`` are of shorter documents, ``docs_at_least``/
    ``tokens_at_least`` of this length and more; ``truncated_tokens`` is the
    total when each document is cut at this length, ``truncated_docs`` how many
    lose tokens, ``quantile`` the share of documents of at most this length.
    """
    hist = staged(lengths(df, text, path).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs")), "histogram")
    hist = hist.withColumn("tokens", F.col("n_tokens") * F.col("docs"))
    total = hist.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("d"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first()
    hist = running_total(hist, [], "n_tokens", "docs", "docs_below", BLOCK)
    hist = running_total(hist, [], "n_tokens", "tokens", "tokens_below", BLOCK)
    docs, tokens = F.lit(total["d"]), F.lit(total["t"])
    return (hist.withColumn("docs_at_least", docs - F.col("docs_below"))
            .withColumn("tokens_at_least", tokens - F.col("tokens_below"))
            .withColumn("truncated_tokens", F.col("tokens_below") + F.col("n_tokens") * F.col("docs_at_least"))
            .withColumn("truncated_docs", F.col("docs_at_least") - F.col("docs"))
            .withColumn("quantile", (F.col("docs_below") + F.col("docs")) / docs))


def truncated_total(hist: DataFrame, limit: int) -> Column:
    """Scalar subquery: tokens left when every document is cut at ``limit``, any integer."""
    row = hist.agg(F.coalesce(F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("docs")), F.lit(0)).alias("t"))
    return row.scalar()


def quantile(hist: DataFrame, share: float) -> Column:
    """Scalar subquery: the least length that at least ``share`` of the documents do not exceed."""
    return hist.where(F.col("quantile") >= share).agg(F.min("n_tokens")).scalar()

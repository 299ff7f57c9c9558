"""Sharding: proportional stratified interleaving.

Rows are shuffled by a seeded digest inside each source, and the row of rank
r among the n of its source gets the fraction (2r + 1) / 2n.  Sorted by that
fraction the sources interleave in proportion, so equal cuts of the sorted
order give shards that all match the mixture; shard counts differ by at most
one row.

Ranks are found without a window over a whole source: rows are counted per
(source, digest bucket) and per fraction bucket, offsets come from a two-level
prefix sum over those counts, and a window only numbers the rows inside one
bucket.  A source with a third of all rows spreads over ``BUCKETS`` buckets.

Defined results: a null source is a source of its own; ties (repeated rows)
are broken by the digest of the text and are interchangeable beyond that; a
null id or text hashes like an empty one; an empty table has no shards.  The
frame's columns pass through; ``shard`` and ``slot`` win a clash of names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import running_total, staged

#: Digest and fraction buckets.  A bucket is one sort in one task: about N / 65,536 rows.
BUCKETS = 1 << 16
BLOCK = 1 << 8


def shuffle_digest(seed: int, *parts: Column) -> Column:
    """Hex digest that orders rows at random but repeatably."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def digest_bucket(digest: Column) -> Column:
    """The digest's first 16 bits: 0 to ``BUCKETS`` - 1, in digest order."""
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("long")


def _numbered(df: DataFrame, key: list[str], bucket: str, order: list, out: str) -> DataFrame:
    """Add ``out``: 0-based number of the row in (bucket, order) within the key."""
    counts = df.groupBy(*key, bucket).agg(F.count(F.lit(1)).alias("__n"))
    offsets = running_total(counts, key, bucket, "__n", "__before", BLOCK).drop("__n")
    offsets = offsets.select(*[F.col(k).alias(f"__o{i}") for i, k in enumerate(key)], F.col(bucket).alias("__ob"), "__before")
    cond = F.col(bucket) == F.col("__ob")
    for i, k in enumerate(key):
        cond = cond & F.col(k).eqNullSafe(F.col(f"__o{i}"))
    inside = F.row_number().over(W.partitionBy(*key, bucket).orderBy(*order)) - 1
    return (df.withColumn("__inside", inside).join(offsets, cond, "inner")
            .withColumn(out, F.col("__before") + F.col("__inside"))
            .select(*[F.col(f"`{c}`") for c in df.columns], out))


def shard_rows(df: DataFrame, shards: int, source: str = "source", doc_id: str = "doc_id",
               text_digest: Column | None = None, seed: int = 9) -> DataFrame:
    """Add ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``text_digest`` breaks ties of the id; by default it is that of the column ``text``, if there is one.
    """
    if text_digest is None:
        text_digest = F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))) if "text" in df.columns else F.lit("")
    keep = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    df = df.select(*[F.col(f"`{c}`") for c in keep],
                   F.col(source).alias("__src"),
                   shuffle_digest(seed, F.col(doc_id)).alias("__dig"),
                   text_digest.alias("__txt"))
    df = df.withColumn("__bkt", digest_bucket(F.col("__dig")))
    sizes = df.groupBy("__src").agg(F.count(F.lit(1)).alias("__size"))
    sizes = staged(sizes, "sizes")          # a row per source
    total = sizes.agg(F.coalesce(F.sum("__size"), F.lit(0)).alias("n")).first()["n"]
    ranked = _numbered(df, ["__src"], "__bkt", ["__dig", "__txt"], "__rank")
    ranked = (ranked.join(sizes.withColumnRenamed("__src", "__src2"), F.col("__src").eqNullSafe(F.col("__src2")), "inner")
              .withColumn("__frac", (2 * F.col("__rank") + 1) / (2 * F.col("__size")).cast("double"))
              .withColumn("__fb", F.floor(F.col("__frac") * BUCKETS)))
    placed = _numbered(ranked, [], "__fb", ["__frac", F.col("__src").asc_nulls_first()], "__pos")
    n, k = max(1, total), shards
    shard = F.expr(f"(__pos * {k}L) div {n}L")
    start = F.expr(f"(shard * {n}L + {k - 1}L) div {k}L")
    return (placed.withColumn("shard", shard.cast("int"))
            .withColumn("slot", (F.col("__pos") - start).cast("long"))
            .select(*[F.col(f"`{c}`") for c in keep], "shard", "slot"))

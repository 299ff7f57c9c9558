"""Benchmark decontamination by spaced-seed hashing.

A mask picks some positions of a run of ten words and ignores the others, so
the hash of the picked words survives substitutions at ignored positions.
Hashes of every run of every benchmark item are joined with those of every
run of every whole document.  Around each hit the item's words are laid over
the document's on the hit's diagonal, as far as both go, and the hit counts
when some stretch there that contains the run is at least ``IDENTITY`` equal
and spans ``OVERLAP`` words or the whole item.  Equal words score 1 and others
-``PENALTY``, so such a stretch is one of score 0 or more; the best of each
least length on either side is found in one pass.

The document side does not shuffle while the benchmark's seeds number at most
``BROADCAST_SEEDS``: runs are hashed inside the row and probed, a block of them
at a time, against the seeds, which are broadcast with the items' words (fewer
still).  Beyond that bound only (text key, run, seed) is shuffled to the seeds,
and the words next to the hits to the items.  Only verified overlaps are
grouped.  Items shorter than a run add masks of their lengths; all runs come
from one scan.

Defined results: words are lower-cased runs of anything but ASCII white space;
null and blank texts match nothing; an item of fewer than ten words must occur
whole and unchanged; repeated rows of one id and text are one document; equal
items each match.  Other columns pass through (``decontaminate``) or are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import SPACE, let, staged

#: Fixed masks of one span: 1 is compared, 0 ignored.  The third leaves out two residues modulo 5, the first and the last
#: position; together they ignore every position, so an item of ten words is found whichever one of them is replaced.
MASKS = ("1101100101", "1010011011", "0111001110", "0101111010")
SPAN = len(MASKS[0])
OVERLAP, IDENTITY = 13, 0.8
#: Equal words that make up for a different one.
PENALTY = round(IDENTITY / (1 - IDENTITY))
#: A stretch as one number: score * ONE + words.  The numbers of adjoining stretches add up.
ONE = 1 << 32
#: Bound of the broadcast: about 100 bytes a seed.
BROADCAST_SEEDS = 200_000
#: Runs of a document that are probed at once.  Spark holds all rows that a joined row makes until they are read, so what is
#: held are the hits of so many runs, each with the words next to it, and not those of a document, each with all its words.
BLOCK = 1 << 10


def _hashes(text: Column) -> Column:
    """64-bit hashes of the text's words."""
    w = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), "")
    return F.transform(w, lambda x: F.xxhash64(x))


def _seeds(w: Column, mask: str) -> Column:
    """The mask's hash at every start where it fits."""
    at = [i for i, c in enumerate(mask) if c == "1"]
    return F.when(F.size(w) >= len(mask), F.transform(
        F.sequence(F.lit(0), F.size(w) - len(mask)),
        lambda i: F.xxhash64(F.lit(mask), *[F.get(w, i + k) for k in at]))).otherwise(F.array().cast("array<bigint>"))


def item_words(bench: DataFrame) -> DataFrame:
    """(item, item_id, words, n_item): a row per item; ``item`` numbers the rows."""
    items = bench.select(F.monotonically_increasing_id().alias("item"), "item_id", _hashes(F.col("text")).alias("words"))
    return items.withColumn("n_item", F.size("words"))


def item_seeds(items: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """(seed, item, n_item, at): a row per run of an item, which starts at word ``at``."""
    out = None
    for m in masks:
        # runs shorter than the common span stand for items of just that many words
        own = items.where(F.col("n_item") >= SPAN if len(m) == SPAN else F.col("n_item") == len(m))
        own = own.select("item", "n_item", F.posexplode(_seeds(F.col("words"), m)).alias("at", "seed")).select("seed", "item", "n_item", "at")
        out = own if out is None else out.unionByName(own)
    return out


def _scored(mine: Column, theirs: Column) -> Column:
    """The words of two runs of one length compared: ONE + 1 or 1 - PENALTY * ONE each."""
    return F.zip_with(mine, theirs, lambda a, b: F.when(a == b, F.lit(ONE + 1)).otherwise(F.lit(1 - PENALTY * ONE)))


def _best_from(scored: Column) -> Column:
    """Array: at t the best stretch from the start of at least t words, t up to OVERLAP - SPAN; null if there is none."""
    least = range(1, OVERLAP - SPAN + 1)
    start = F.struct(F.lit(0).cast("long").alias("c"), F.lit(0).cast("long").alias("b0"), *[F.lit(None).cast("long").alias(f"b{t}") for t in least])

    def step(s: Column, x: Column) -> Column:
        c = s["c"] + x
        return F.struct(c.alias("c"), F.greatest(s["b0"], c).alias("b0"),
                        *[F.greatest(s[f"b{t}"], F.when(_length(c) >= t, c)).alias(f"b{t}") for t in least])

    return F.aggregate(scored, start, step, lambda s: F.array(s["b0"], *[s[f"b{t}"] for t in least]))


def _length(stretch: Column) -> Column:
    return stretch.bitwiseAND(F.lit(ONE - 1))


def _place(run: Column, n: Column, masks: tuple[str, ...]) -> tuple[Column, Column]:
    """Where a run starts and how many words it spans, from its place among the runs of all masks."""
    if len(masks) == len(MASKS):
        return run % (n - (SPAN - 1)), F.lit(SPAN)
    at, span, before = F.lit(0), F.lit(0), F.lit(0)
    ends = []
    for m in masks:
        size = F.greatest(n - (len(m) - 1), F.lit(0))
        ends.append((before, before + size, len(m)))
        before = before + size
    for lo, hi, length in reversed(ends):
        at, span = F.when(run < hi, run - lo).otherwise(at), F.when(run < hi, F.lit(length)).otherwise(span)
    return at, span


def _reach(at: Column, span: Column) -> tuple[Column, Column]:
    """Words that document and item both have before and after the run."""
    return F.least(at, F.col("off")), F.least(F.col("n") - at, F.col("n_item") - F.col("off")) - span


def _near(hit: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """The hits with ``at``, ``span``, ``left`` and ``right``; of the document's words only ``near``, those that lie beside the item's."""
    at, span = _place(F.col("run"), F.col("n"), masks)
    left, right = _reach(at, span)
    return hit.select("doc_id", "k1", "k2", "item", "n_item", "off", at.alias("at"), span.alias("span"), left.alias("left"), right.alias("right"),
                      F.slice("w", at - left + 1, left + span + right).alias("near"))


def _laid(hit: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, item_id, n_item, at, span, v): the compared words before, in and after the run."""
    left, span, right = F.col("left"), F.col("span"), F.col("right")
    both = lambda start, n: _scored(F.slice("near", left + start + 1, n), F.slice("words", F.col("off") + start + 1, n))
    laid = F.struct(F.reverse(both(-left, left)).alias("before"), both(F.lit(0), span).alias("run"), both(span, right).alias("after"))
    return hit.select("doc_id", "k1", "k2", "item_id", "n_item", "at", "span", F.explode(F.array(laid)).alias("v"))


def _near_apart(docs: DataFrame, texts: DataFrame, seeds: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """The hits and the words next to them where the seeds are too many to broadcast.

    Only (text key, run, seed) meets the seeds; hits are collected per text,
    texts with hits are fetched once, and of each only the words next to a hit,
    at most as many as the item has, travel to the item.
    """
    hits = staged(docs.select("k1", "k2", "n", "run", "seed").distinct().join(seeds, "seed")
                  .select("k1", "k2", "n", "run", "item", "n_item", F.col("at").alias("off")), "hits")
    per_text = hits.groupBy("k1", "k2").agg(F.collect_list(F.struct("n", "run", "item", "n_item", "off")).alias("hits"))
    fetched = (texts.join(per_text, ["k1", "k2"]).select("doc_id", "k1", "k2", F.explode(F.array(F.struct(_hashes(F.col("text")).alias("w"), "hits"))).alias("d"))
               .select("doc_id", "k1", "k2", F.col("d.w").alias("w"), F.explode("d.hits").alias("h")).select("doc_id", "k1", "k2", "w", "h.*"))
    return _near(fetched, masks)


def _in_blocks(seeds: Column) -> Column:
    """The seeds of a document cut into blocks of ``BLOCK`` runs: (first, seeds)."""
    return F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(seeds) - 1, F.lit(0)) / BLOCK).cast("int")),
                       lambda i: F.struct((i * BLOCK).alias("first"), F.slice(seeds, i * BLOCK + 1, F.lit(BLOCK)).alias("seeds")))


def overlaps(df: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Verified overlaps: (doc_id, k1, k2, item_id, first_word, end_word, hits, matched, compared).

    ``k1``, ``k2`` are hashes of the text; ``first_word`` to ``end_word`` spans
    all verified stretches of the item in the document; ``matched`` of
    ``compared`` words were equal in the best of them (most equal words, then shortest).
    """
    bench = bench.select("item_id", "text").where("text IS NOT NULL")
    short = bench.select(F.size(_hashes(F.col("text"))).alias("n")).where(f"n > 0 AND n < {SPAN}").distinct().collect()     # at most nine lengths
    masks = MASKS + tuple("1" * r["n"] for r in sorted(short))
    items = staged(item_words(bench), "items")
    seeds = staged(item_seeds(items, masks), "seeds")
    items = items.select("item", "item_id", "words")
    texts = df.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("k1"), F.crc32(F.coalesce(text, F.lit(""))).alias("k2"),
                      F.col(text).alias("text"))
    row = let(_hashes(F.col("text")), lambda w: F.struct(w.alias("w"), F.concat(*[_seeds(w, m) for m in masks]).alias("seeds")))
    # one-row explode: the arrays are made once, before the runs are unrolled
    docs = (texts.select("doc_id", "k1", "k2", F.explode(F.array(row)).alias("d"))
            .select("doc_id", "k1", "k2", F.col("d.w").alias("w"), F.size("d.w").alias("n"), F.explode(_in_blocks(F.col("d.seeds"))).alias("b"))
            .select("doc_id", "k1", "k2", "w", "n", F.col("b.first").alias("first"), F.posexplode("b.seeds").alias("run", "seed"))
            .withColumn("run", F.col("first") + F.col("run")))
    if seeds.count() <= BROADCAST_SEEDS:
        near = _near(docs.join(F.broadcast(seeds), "seed").withColumnRenamed("at", "off"), masks)
        items = F.broadcast(items.join(seeds.select("item").distinct(), "item", "left_semi"))
    else:
        near = _near_apart(docs, texts, seeds, masks)
    hit = _laid(near.join(items, "item"))
    # again a one-row explode: the comparison must not move into the join, where each probe would carry the document's words
    run = F.aggregate("v.run", F.lit(0).cast("long"), lambda s, x: s + x)
    hit = hit.select("doc_id", "k1", "k2", "item_id", "at", (F.least("n_item", F.lit(OVERLAP)) - F.col("span")).alias("more"),
                     F.explode(F.array(F.struct(_best_from(F.col("v.before")).alias("before"), run.alias("run"), _best_from(F.col("v.after")).alias("after")))).alias("v"))
    sides = [(F.get("v.before", F.lit(t)), F.get("v.after", F.col("more") - t)) for t in range(OVERLAP - SPAN + 1)]
    best = F.array_max(F.array(*[F.struct((b + F.col("v.run") + a).alias("all"), b.alias("before")) for b, a in sides]))
    hit = hit.select("doc_id", "k1", "k2", "item_id", "at", F.explode(F.array(best)).alias("v")).where("v.all >= 0")
    words = _length(F.col("v.all"))
    found = hit.select("doc_id", "k1", "k2", "item_id", (F.col("at") - _length(F.col("v.before"))).alias("start"), words.alias("compared"),
                       F.expr(f"(shiftright(v.all, 32) + {PENALTY} * (v.all & {ONE - 1}L)) div {PENALTY + 1}").alias("matched"))
    return (found.groupBy("doc_id", "k1", "k2", "item_id")
            .agg(F.min("start").cast("long").alias("first_word"), F.max(F.col("start") + F.col("compared")).cast("long").alias("end_word"),
                 F.count(F.lit(1)).alias("hits"), F.max(F.struct("matched", (-F.col("compared")).alias("short"), "compared")).alias("best"))
            .select("doc_id", "k1", "k2", "item_id", "first_word", "end_word", "hits",
                    F.col("best.matched").cast("long").alias("matched"), F.col("best.compared").cast("long").alias("compared")))


def decontaminate(df: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The frame's rows whose text overlaps no benchmark item."""
    hit = staged(overlaps(df, bench, doc_id, text).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")).distinct(), "hit")
    rows = df.select("*", F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__t1"), F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("__t2"))
    return rows.join(hit, (F.col("__t1") == F.col("__k1")) & (F.col("__t2") == F.col("__k2")), "left_anti").drop("__t1", "__t2")

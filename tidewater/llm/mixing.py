"""Mixing sources to target weights: hierarchical budgeting.

The token budget runs down a tree of domain, language and source.  At each
node the children share the node's budget in proportion to their weights;
a child whose subtree cannot supply its share gives what it has, and the
shortage is shared again among its siblings.  A node's capacity is the sum of
its children's, so a shortage only reaches the level above when all siblings
are used up: siblings come before ancestors.

A leaf of T tokens that was given A tokens repeats whole epochs A div T times
and takes the rest as a prefix: its documents in the seeded order of the next
epoch while their running token count stays within A mod T.  Each epoch has
its own order.

Documents are counted per (leaf, digest bucket); the prefix's end is looked
for among 256 coarse and then 256 fine buckets, and only the documents of the
one bucket that holds it are sorted, so a leaf with a third of all rows costs
no large window.  All arithmetic is on integers.

Defined results: a null language or source is a leaf of its own; a null text
has no tokens; documents without tokens go along where their place in the order
puts them, and a leaf without any token gives no rows; repeated rows are drawn as rows of their own, ordered
by the digest of id and text; a budget above all capacity gives the capacity;
an empty table gives no rows.  Weights that a node lacks are 1.  Other columns
pass through; the added columns win a clash of names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import staged
from tidewater.llm.sharding import shuffle_digest

LEVELS = ("domain", "lang", "source")
BIG = "decimal(38,0)"


def token_count(text: Column) -> Column:
    """Words of the text (runs of anything but ASCII white space)."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def share_out(nodes: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Split each parent's ``given`` among its children: ``w`` and ``cap`` per child, result in ``got``.

    Children in rising order of cap / w are filled first.  Child k is used up
    when cap_k * W_k <= w_k * R_k, R_k being what is left after the children
    before it and W_k the weights from it on; the first that is not fixes the
    rate for itself and all after it (rounded down).
    """
    by = W.partitionBy(*parent).orderBy((F.col("cap").cast("double") / F.col("w")), F.col(child).asc_nulls_first())
    before, after = by.rowsBetween(W.unboundedPreceding, -1), by.rowsBetween(0, W.unboundedFollowing)
    n = (nodes.withColumn("left", F.col("given").cast(BIG) - F.coalesce(F.sum(F.col("cap").cast(BIG)).over(before), F.lit(0).cast(BIG)))
         .withColumn("ws", F.sum(F.col("w").cast(BIG)).over(after))
         .withColumn("full", F.col("cap").cast(BIG) * F.col("ws") <= F.col("w").cast(BIG) * F.col("left")))
    some = by.rowsBetween(W.unboundedPreceding, 0)
    n = (n.withColumn("open", F.max((~F.col("full")).cast("int")).over(some))
         .withColumn("at_left", F.first(F.when(~F.col("full"), F.col("left")), ignorenulls=True).over(some))
         .withColumn("at_ws", F.first(F.when(~F.col("full"), F.col("ws")), ignorenulls=True).over(some)))
    return (n.withColumn("got", F.when(F.col("open") == 0, F.col("cap"))
                         .otherwise(F.expr(f"(CAST(w AS {BIG}) * at_left) div at_ws")).cast("long"))
            .drop("left", "ws", "full", "open", "at_left", "at_ws"))


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    own = weights.get(level, {})
    if not own:
        return F.lit(1).cast("long")
    pairs = F.create_map(*[F.lit(x) for kv in own.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, F.col(level)), F.lit(1)).cast("long")


def budgets(leaves: DataFrame, budget: Column, weights: dict[str, dict[str, int]], max_epochs: int) -> DataFrame:
    """Leaves (domain, lang, source, tokens) with ``got``: the tokens each may give to the mixture."""
    tree = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    given = budget.cast("long")
    for depth, level in enumerate(LEVELS):
        path, parent = list(LEVELS[:depth + 1]), list(LEVELS[:depth])
        nodes = tree.groupBy(*path).agg(F.sum("cap").alias("cap")).withColumn("w", _weight(level, weights))
        if depth:
            up = above.select(*[F.col(p).alias(f"__{p}") for p in parent], F.col("got").alias("given"))
            cond = F.lit(True)
            for p in parent:
                cond = cond & F.col(p).eqNullSafe(F.col(f"__{p}"))
            nodes = nodes.join(up, cond).drop(*[f"__{p}" for p in parent])
        else:
            nodes = nodes.withColumn("given", given)
        above = share_out(nodes, parent, level)
    got = above.select(*[F.col(p).alias(f"__{p}") for p in LEVELS], "got")
    cond = F.lit(True)
    for p in LEVELS:
        cond = cond & F.col(p).eqNullSafe(F.col(f"__{p}"))
    return leaves.join(got, cond).drop(*[f"__{p}" for p in LEVELS])


def mix(df: DataFrame, domain: Column, weights: dict[str, dict[str, int]], budget_pct: int = 60, max_epochs: int = 4,
        doc_id: str = "doc_id", lang: str = "lang", source: str = "source", tokens: Column | None = None,
        digest: Column | None = None, seed: int = 6) -> DataFrame:
    """One row per drawn (document, epoch): the frame's columns, ``domain``, ``n_tokens`` and ``epoch``.

    The budget is ``budget_pct`` percent of all tokens.  ``tokens`` and ``digest``
    are a row's token count and what orders rows of one id (default: from ``text``).
    """
    tokens = token_count(F.col("text")) if tokens is None else tokens
    digest = F.md5(F.coalesce(F.col("text"), F.lit(""))) if digest is None else digest
    keep = [c for c in df.columns if c.lower() not in ("domain", "n_tokens", "epoch")]
    # the order of epoch e is the digest of (seed, e, id, text); only the last, partial epoch needs it
    rows = df.select(*[F.col(f"`{c}`") for c in keep], domain.alias("__d"), F.col(lang).alias("__l"), F.col(source).alias("__s"),
                     tokens.alias("n_tokens"), digest.alias("__t"))
    leaf = ["__d", "__l", "__s"]
    # what counting needs, once: no texts
    slim = staged(rows.select(*leaf, "n_tokens", F.col(doc_id).alias("__id"), "__t"), "slim")
    leaves = slim.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens"))
    leaves = staged(leaves.select(F.col("__d").alias("domain"), F.col("__l").alias("lang"), F.col("__s").alias("source"), "tokens"), "leaves")
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"]
    given = budgets(leaves, F.lit(total * budget_pct // 100), weights, max_epochs)
    plan = given.select(*[F.col(a).alias(f"__p{i}") for i, a in enumerate(LEVELS)],
                        F.expr("IF(tokens > 0, got div tokens, 0)").alias("whole"),
                        F.expr("IF(tokens > 0, got % tokens, 0)").alias("rest"))
    plan = staged(plan, "plan")             # a row per leaf

    def at_leaf(left: DataFrame, right: DataFrame, prefix: str) -> DataFrame:
        cond = F.lit(True)
        for i, c in enumerate(leaf):
            cond = cond & F.col(c).eqNullSafe(F.col(f"{prefix}{i}"))
        return left.join(right, cond)

    def in_order(r: DataFrame, ident: str) -> DataFrame:
        r = at_leaf(r, plan, "__p").drop("__p0", "__p1", "__p2")
        return (r.withColumn("__o", shuffle_digest(seed, F.col("whole"), F.col(ident), F.col("__t")))
                .withColumn("__c", F.conv(F.substring("__o", 1, 2), 16, 10).cast("int"))
                .withColumn("__f", F.conv(F.substring("__o", 3, 2), 16, 10).cast("int")))

    fine = staged(in_order(slim, "__id").groupBy(*leaf, "rest", "__c", "__f").agg(F.sum("n_tokens").alias("t")), "fine")

    def cut(buckets: DataFrame, key: str) -> DataFrame:
        """Per leaf the first bucket whose running total passes the rest, and the tokens before it."""
        by = W.partitionBy(*leaf).orderBy(key)
        run = buckets.withColumn("upto", F.sum("t").over(by.rowsBetween(W.unboundedPreceding, 0)))
        hit = run.where("start + upto > rest").groupBy(*leaf).agg(F.min(F.struct(F.col(key).alias("k"), (F.col("start") + F.col("upto") - F.col("t")).alias("before"))).alias("m"))
        return hit.select(*[F.col(c).alias(f"__h{i}") for i, c in enumerate(leaf)], F.col("m.k").alias("cut"), F.col("m.before").alias("start"))

    coarse = fine.groupBy(*leaf, "rest", "__c").agg(F.sum("t").alias("t")).withColumn("start", F.lit(0).cast("long"))
    coarse = cut(coarse, "__c").withColumnRenamed("cut", "cut_c")
    # a row per document or bucket, in files that look far smaller: never broadcast
    inner = at_leaf(fine.hint("merge"), coarse, "__h").where("__c = cut_c")
    ends = cut(inner.drop("__h0", "__h1", "__h2"), "__f").withColumnRenamed("cut", "cut_f")
    ends = at_leaf(ends.select(*[F.col(f"__h{i}").alias(c) for i, c in enumerate(leaf)], "cut_f", "start"),
                   coarse.select("__h0", "__h1", "__h2", "cut_c"), "__h").drop("__h0", "__h1", "__h2")
    ends = staged(ends.select(*[F.col(c).alias(f"__e{i}") for i, c in enumerate(leaf)], "cut_c", "cut_f", "start"), "ends")
    rows = at_leaf(in_order(rows, doc_id), ends, "__e")       # every leaf ends in one bucket: the rest is below its total
    place = F.col("__c") * 256 + F.col("__f")
    end = F.col("cut_c") * 256 + F.col("cut_f")
    run = F.sum("n_tokens").over(W.partitionBy(*leaf).orderBy("__o").rowsBetween(W.unboundedPreceding, 0))
    some = F.col("rest") > 0
    last = rows.where(place == end).withColumn("__part", some & (F.col("start") + run <= F.col("rest"))).where("whole > 0 OR __part")
    clear = rows.where(place != end).withColumn("__part", some & (place < end)).where("whole > 0 OR __part")
    drawn = last.unionByName(clear)
    epochs = F.sequence(F.lit(0), F.col("whole").cast("int") - 1 + F.col("__part").cast("int"))
    return (drawn.withColumn("epoch", F.explode(epochs))
            .select(*[F.col(f"`{c}`") for c in keep], F.col("__d").alias("domain"), "n_tokens", "epoch"))


def oracle(domain: str, weights: dict[str, dict[str, int]], budget_pct: int, max_epochs: int, seed: int = 6) -> str:
    """SQL for the drawn rows of ``documents``: (doc_id, lang, source, domain, n_tokens, epoch)."""
    parts = [f"""r AS (SELECT doc_id, lang, source, {domain} AS domain, md5(coalesce(text, '')) AS digest,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents)""",
             "leaf AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM r GROUP BY ALL)"]
    for depth, level in enumerate(LEVELS):
        path, parent = ", ".join(LEVELS[:depth + 1]), LEVELS[:depth]
        own = " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.get(level, {}).items())
        weight = f"CASE {level} {own} ELSE 1 END" if own else "1"
        given = (f"JOIN g{depth - 1} ON " + " AND ".join(f"g{depth - 1}.{p} IS NOT DISTINCT FROM n.{p}" for p in parent)) if depth else ""
        budget = f"g{depth - 1}.got" if depth else f"(SELECT sum(tokens) * {budget_pct} // 100 FROM leaf)"
        by = (f"PARTITION BY {', '.join(parent)} " if parent else "") + f"ORDER BY CAST(cap AS DOUBLE) / w, {level} NULLS FIRST"
        parts += [f"""n{depth} AS (SELECT n.*, {budget} AS given FROM (SELECT {path}, sum(tokens) * {max_epochs} AS cap, {weight} AS w FROM leaf GROUP BY {path}) n {given})""",
                  f"""l{depth} AS (SELECT *, given - coalesce(sum(cap) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
  sum(w) OVER (b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM n{depth} WINDOW b AS ({by}))""",
                  f"""o{depth} AS (SELECT *, first_value(CASE WHEN cap * ws > w * room THEN room END IGNORE NULLS) OVER u AS at_room,
  first_value(CASE WHEN cap * ws > w * room THEN ws END IGNORE NULLS) OVER u AS at_ws FROM l{depth} WINDOW u AS ({by} ROWS UNBOUNDED PRECEDING))""",
                  f"g{depth} AS (SELECT {path}, CASE WHEN at_ws IS NULL THEN cap ELSE w * at_room // at_ws END AS got FROM o{depth})"]
    same = " AND ".join(f"{{0}}.{c} IS NOT DISTINCT FROM leaf.{c}" for c in LEVELS)
    return "WITH " + ",\n".join([*parts, f"""plan AS (SELECT leaf.*, CASE WHEN tokens > 0 THEN got // tokens ELSE 0 END AS whole, CASE WHEN tokens > 0 THEN got % tokens ELSE 0 END AS rest
  FROM leaf JOIN g2 ON {same.format('g2')})""", f"""placed AS (
  SELECT r.*, whole, rest, sum(n_tokens) OVER (PARTITION BY r.domain, r.lang, r.source
    ORDER BY md5(concat_ws(':', '{seed}', CAST(whole AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), ''), digest)) ROWS UNBOUNDED PRECEDING) AS upto
  FROM r JOIN plan leaf ON {same.format('r')})"""]) + """
SELECT doc_id, lang, source, domain, n_tokens, CAST(unnest(range(0, CAST(whole + CAST(rest > 0 AND upto <= rest AS INT) AS BIGINT))) AS INTEGER) AS epoch
FROM placed"""

"""MinHash near-dedup: Order MinHash over word k-mers, verified by banded alignment.

A text is lower-cased and cut into words; its k-mers are runs of two words,
each labelled with how often it occurred before.  A sketch takes the ``PICKED``
labelled k-mers of least hash under one of ``SKETCHES`` hash functions and
hashes them *in text order*, so two texts agree on a sketch only if they share
k-mers in the same order: the chance of agreeing follows edit similarity, not
just shared content.  Few runs of a short text outlive an edit, so texts below
``SHORT`` words get ``SHORT_SKETCHES`` sketches of single words instead, and
those a little longer both kinds: similar texts always have one kind in common.
Texts that agree on any sketch, and whose word counts can reach the threshold,
are candidates; a banded bit-parallel alignment decides: similarity =
1 - edit distance / words of the longer text >= 0.8.  Proposing is by chance:
an isolated pair at 0.8 exactly is missed about once in thirty times, at 0.85
and above hardly ever (README: recall by length and similarity).
Classes are the connected components of the verified links.

Large groups.  Equal texts are one node (a digest), so copies are never
compared.  Candidates are drawn in turns.  In each, a bucket (sketch value,
length bin) proposes its pivot with one member of every other class in it, and
of the pairs between two classes one is compared; then classes are formed
anew.  The first turns draw from few sketches only (``WAVES``), so near copies
of one text fall into few classes at about a pair a text, and later sketches
only propose what these have left apart.  Turns go on while at least one pair
in a hundred is a link.  What then still lies in one bucket, of any sketch, but
in two classes is compared in full, so no candidate is dropped.  The links
returned connect each class; further links inside a class are not drawn.  That last join emits only pairs
that can reach the threshold, by a bound that loses none: a text's words, each
labelled with how often it occurred before, are hashed to ``PARITIES`` bits that
tell whether an odd number of them fell there; two texts differ in at most
2 d - (difference of their lengths) bits, d being their edit distance; the bits
folded to ``FOLDED`` are tested first, and on the turns' pairs too.  Members
of a bucket's largest class do not meet each other; in a bucket of m singletons
the bound is still tested m^2 / 2 times.  Buckets join by salted key; what holds
a row per salt, class, text or pair is shuffled, never broadcast.

Defined results: a null text is a text of no words; texts without words are
copies of each other only if equal.  The class id is the least non-null id in the class (null
only if all ids in it are null).  Rows that repeat id and text are copies.
Other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import count
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import staged
from tidewater.llm.hashing import word_hashes

K, SKETCHES, PICKED, SIMILARITY = 2, 40, 3, 0.8
#: Texts of fewer words are sketched by single words; those of fewer than SHORT / SIMILARITY, which can be similar to them, by both.
SHORT, SHORT_SKETCHES = 24, 24
#: Ratio of neighbouring length bins, a little above 1 / SIMILARITY: word counts of similar texts lie in one bin or in adjacent ones.
BIN = 1.26
SALTS = 16
#: Parity bits that a text carries, in words of 64.
PARITIES = 4096
#: The same folded to fewer bits, for the first test of a pair.
FOLDED = 1024
#: Members of a bucket for each salt of the last comparison, up to ``SALTS`` salts.
PER_SALT = 256
#: Sketches of each kind that the turns draw from; the last number holds for all further turns.
WAVES = (2, 8, SKETCHES)
#: Turns go on while at least this share of the compared pairs are links.
LEAST_YIELD = 0.01
_SEEDS = np.random.default_rng(7).integers(1, 1 << 63, size=(SKETCHES + SHORT_SKETCHES, 2), dtype=np.uint64) | np.uint64(1)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def labelled(h: np.ndarray) -> np.ndarray:
    """The hashes, each one that occurred before mixed with how often it did."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.r_[True, s[1:] != s[:-1]]
    if first.all():
        return h
    at = np.arange(len(h))
    label = np.empty(len(h), np.uint64)
    label[order] = (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64)
    return np.where(label > 0, _mix(h + label * _GOLD), h)


def kmer_hashes(w: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the runs of ``k`` words, each mixed with how often the run occurred before."""
    if len(w) == 0:
        return w
    k = min(k, len(w))
    n = len(w) - k + 1
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = _mix(h * _GOLD + w[i:i + n])
    return labelled(h)


def sketches(h: np.ndarray, all_seeds: np.ndarray = _SEEDS[:SKETCHES]) -> np.ndarray:
    """One value per sketch: the hash of its least k-mers in text order."""
    out = np.zeros(len(all_seeds), np.uint64)
    if len(h) == 0:
        return out
    step = max(1, (1 << 18) // len(h))      # sketches at a time, by memory
    for j in range(0, len(all_seeds), step):
        seeds = all_seeds[j:j + step]
        if len(h) > PICKED:
            v = (((h ^ seeds[:, :1]) * seeds[:, 1:]) >> np.uint64(32)).astype(np.uint32)
            at = np.empty((len(seeds), PICKED), np.int64)
            for c in range(PICKED):
                at[:, c] = v.argmin(axis=1)
                v[np.arange(len(seeds)), at[:, c]] = 0xFFFFFFFF
            at.sort(axis=1)
        else:
            at = np.tile(np.arange(len(h)), (len(seeds), 1))
        picked = h[at]
        acc = seeds[:, 0].copy()
        for c in range(picked.shape[1]):
            acc = _mix((acc ^ picked[:, c]) * _GOLD)
        out[j:j + step] = acc
    return out


def text_sketches(w: np.ndarray) -> np.ndarray:
    """The sketch values of a text's words, of the kinds that its length asks for."""
    long = sketches(kmer_hashes(w)) if len(w) >= SHORT else np.empty(0, np.uint64)
    if len(w) * SIMILARITY >= SHORT:
        return long
    return np.r_[long, sketches(kmer_hashes(w, 1), _SEEDS[SKETCHES:])]


def parities(w: np.ndarray) -> np.ndarray:
    """Bit h: whether an odd number of the text's words, labelled by occurrence, has hash h."""
    if len(w) == 0:
        return np.zeros(PARITIES // 64, np.int64)
    at = (_mix(labelled(w) * _GOLD) >> np.uint64(32)).astype(np.int64) % PARITIES
    return np.packbits(np.bincount(at, minlength=PARITIES) & 1).view(np.int64)


def folded(odd: np.ndarray) -> np.ndarray:
    """The parities over fewer bits: hashes that agree modulo ``FOLDED`` fall together."""
    return np.bitwise_xor.reduce(odd.reshape(-1, FOLDED // 64), axis=0)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    np.seterr(over="ignore")
    for b in batches:
        digests, counts, values, odds, folds = [], [], [], [], []
        for t in b.column("text"):
            raw = (t.as_py() or "")
            digests.append(hashlib.md5(raw.encode()).digest())
            w = word_hashes(raw.lower().encode())
            counts.append(len(w))
            values.append(text_sketches(w).view(np.int64))
            odds.append(parities(w))
            folds.append(folded(odds[-1]))
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), _lists(values), _lists(odds), _lists(folds)],
            ["id", "node", "n_words", "sketch", "odd", "fold"])


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)], dtype=np.int32)), pa.array(flat))


def banded_distance(a: list, b: list, band: int) -> int:
    """Edit distance of two sequences if it is at most ``band``, else some number above it.

    Bit-parallel alignment inside the diagonals -band to band: an integer of
    2 band + 1 bits slides down one row per element of ``b``; bit t of it is
    row j - band + t.  Linear in the length, memory of the band only.
    """
    if len(a) < len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if n - m > band:
        return n - m
    if not m:
        return n
    width = 2 * band + 1
    mask, top = (1 << width) - 1, width - 1
    final = n - m + band            # the diagonal that ends in the last cell
    rows: dict = {}                 # element -> (its rows in the window, shift they were stored at)
    for i in range(min(n, band)):   # rows 1 to band, seen from column 0
        bits, at = rows.get(a[i], (0, 0))
        rows[a[i]] = (bits | 1 << (band + 1 + i), 0)
    vp, vn, score = mask >> band << band, 0, n - m
    for j in range(1, m + 1):
        if j + band <= n:           # the row that enters the window
            x = a[j + band - 1]
            bits, at = rows.get(x, (0, j))
            rows[x] = (bits >> (j - at) | 1 << top, j)
        bits, at = rows.get(b[j - 1], (0, j))
        x = bits >> (j - at) | vn
        d0 = ((((x & vp) + vp) ^ vp) | x) & mask
        hp = (vn | ~(d0 | vp)) & mask
        hn = d0 & vp
        score += 1 - (d0 >> final & 1)
        d0 >>= 1
        vp = (hn | ~(d0 | hp)) & mask
        vn = d0 & hp
    return score


def similar(a: list, b: list) -> float:
    """Edit similarity of two word lists if it is 0.8 or more, else 0."""
    longest = max(len(a), len(b))
    if a == b:
        return 1.0
    limit = int(longest * (1 - SIMILARITY) + 1e-9)
    if abs(len(a) - len(b)) > limit:
        return 0.0
    common = sum((Counter(a) & Counter(b)).values())
    if longest - common > limit:    # the distance is at least what one lacks of the other
        return 0.0
    band = min(limit, max(32, abs(len(a) - len(b))))
    while (d := banded_distance(a, b, band)) > band and band < limit:
        band = min(limit, 4 * band)
    return 1 - d / longest if d <= limit else 0.0


def _split(text: pa.StringScalar) -> list[bytes]:
    """The words that are sketched: bytes split at ASCII white space alone."""
    return text.as_py().lower().encode().split()


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        left, right, sims = [], [], []
        last, last_words = None, []
        for x, y, tx, ty in zip(b.column("a"), b.column("b"), b.column("text_a"), b.column("text_b")):
            if x != last:
                last, last_words = x, _split(tx)
            s = similar(last_words, _split(ty))
            if s:
                left.append(x.as_py())
                right.append(y.as_py())
                sims.append(s)
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary()), pa.array(sims, pa.float64())], ["a", "b", "similarity"])


def _shuffled(side: DataFrame) -> DataFrame:
    """A side that grows with the documents and whose rows may be far larger than its files tell: never broadcast."""
    return side.hint("merge")


def _salted(side: DataFrame) -> DataFrame:
    """The smaller side of a join by a key that may be hot: a copy per salt, which the planner's sizes leave out."""
    return _shuffled(side.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)]))))


def _salt(*cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(SALTS)).cast("int").alias("salt")


def _node_texts(texts: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """One text for each node that is in a pair."""
    needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    reps = nodes.join(needed, "node").select("node", F.col("id").alias("rep"))
    own = texts.select(F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("node"), F.col("id"), F.coalesce("text", F.lit("")).alias("text"))
    found = own.join(reps, (own["node"] == reps["node"]) & own["id"].eqNullSafe(reps["rep"])).select(own["node"], own["text"])
    # a row per node unless rows repeat id and text
    return staged(found.groupBy("node").agg(F.max("text").alias("text")), "texts")


def _verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    t = _node_texts(texts, nodes, pairs)
    # aligning costs far more than a pair's bytes tell: deal pairs out evenly, also where their files are few
    dealt = pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "b")
    both = (dealt.join(_shuffled(t.select(F.col("node").alias("a"), F.col("text").alias("text_a"))), "a")
            .join(_shuffled(t.select(F.col("node").alias("b"), F.col("text").alias("text_b"))), "b"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify_batches, "a binary, b binary, similarity double")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): least node of the connected component, for every node of a link.

    Every round each node steps to its least neighbour and on to that one's least
    neighbour; then the links are drawn between the nodes stepped to, so those
    inside what has merged are gone and later rounds see only the rest.
    """
    edges = staged(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    label = None
    for _ in range(max_rounds):
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        step = staged(both.groupBy("node").agg(F.min("other").alias("near")).select("node", F.least("node", "near").alias("up")), "step")
        hop = staged(step.join(_shuffled(step.toDF("up", "top")), "up").select("node", "top"), "hop")
        if label is None:
            label = hop.toDF("node", "root")
        else:
            label = staged(label.join(_shuffled(hop.toDF("root", "top")), "root", "left").select("node", F.coalesce("top", "root").alias("root")), "label")
        edges = staged(edges.join(_shuffled(hop.toDF("a", "ta")), "a").join(_shuffled(hop.toDF("b", "tb")), "b").where("ta <> tb")
                       .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return label
    raise RuntimeError("components did not settle")


def _low() -> Column:
    """The lower length bin of a text."""
    return F.floor(F.log(BIN, F.greatest(F.col("n_words"), F.lit(1)).cast("double")))


def _buckets(nodes: DataFrame) -> DataFrame:
    """(key of a sketch value and a length bin, node, wave: the sketch's place in its kind): a node lies in its length bin and the next one.

    A value is one of its sketch's seed, so that values of different sketches differ.

    Texts whose word counts differ by at most the factor 1 / 0.8 share a bin.
    """
    # bin b: counts from BIN^b to BIN^(b + 2); every pair within the factor BIN shares one
    return (nodes.where("n_words > 0")
            .select("node", F.posexplode("sketch").alias("wave", "value"), _low().alias("low"))
            .select("node", (F.col("wave") % SKETCHES).alias("wave"), F.explode(F.array(F.col("low"), F.col("low") - 1)).alias("bin"), "value")
            .select(F.xxhash64("value", "bin").alias("key"), "node", "wave"))


def _to_pivots(members: DataFrame, root: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) to verify: of each bucket its pivot with one member of each other class, one pair for two classes."""
    drawn = members.where(F.col("wave") < WAVES[min(turn, len(WAVES) - 1)]).select("key", "node")
    first = lambda name: F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("o"), F.col("node").alias("node"))).alias(name)
    per_class = staged(drawn.join(_shuffled(root), "node").groupBy("key", "root").agg(first("own")), "per-class")
    pivots = (per_class.groupBy("key").agg(F.min(F.struct("own", "root")).alias("p"), F.count(F.lit(1)).alias("classes")).where("classes > 1")
              .select("key", F.col("p.own.node").alias("pivot"), F.col("p.root").alias("pivot_root")))
    pairs = per_class.join(_shuffled(staged(pivots, "pivots")), "key").where("root <> pivot_root").select(
        F.least("root", "pivot_root").alias("ra"), F.greatest("root", "pivot_root").alias("rb"),
        F.least("own.node", "pivot").alias("a"), F.greatest("own.node", "pivot").alias("b"))
    chosen = F.min(F.struct(F.xxhash64(F.lit(turn), "a", "b").alias("o"), "a", "b")).alias("p")
    return pairs.groupBy("ra", "rb").agg(chosen).select("p.a", "p.b").distinct()


def _reach(na: str, nb: str, fa: str, fb: str) -> tuple[Column, Column]:
    """Whether the folded parities let a pair reach the threshold, and the most parities it may differ in."""
    most = F.floor(F.greatest(na, nb) * (1 - SIMILARITY) + 1e-9)
    apart = F.abs(F.col(na) - F.col(nb))
    differ = reduce(add, [F.bit_count(F.get(fa, F.lit(i)).bitwiseXOR(F.get(fb, F.lit(i)))) for i in range(FOLDED // 64)])
    return (apart <= most) & (differ <= 2 * most - apart), 2 * most - apart


def _reachable(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose folded parities can belong to similar texts."""
    a = nodes.select(F.col("node").alias("a"), F.col("n_words").alias("na"), F.col("fold").alias("fa"))
    b = nodes.select(F.col("node").alias("b"), F.col("n_words").alias("nb"), F.col("fold").alias("fb"))
    return pairs.join(a, "a").join(b, "b").where(_reach("na", "nb", "fa", "fb")[0]).select("a", "b")


def _rest(members: DataFrame, nodes: DataFrame, root: DataFrame) -> DataFrame:
    """Every pair (a, b) of one bucket and two classes that can be similar."""
    placed = staged(members.select("key", "node").join(_shuffled(root), "node"), "placed")
    per_class = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    open_keys = per_class.groupBy("key").agg(F.max(F.struct("n", "root")).alias("top"), F.count(F.lit(1)).alias("classes"), F.sum("n").alias("size")).where("classes > 1")
    salts = F.least(F.lit(SALTS), F.ceil(F.col("size") / PER_SALT)).cast("int").alias("salts")
    left = staged(placed.withColumn("salt", _salt("node")).join(_salted(open_keys.select("key", F.col("top.root").alias("largest"), salts)), ["key", "salt"])
                  .select("key", "node", "root", "salts", (F.col("root") != F.col("largest")).alias("minor"))
                  .join(nodes.select("node", "n_words", "odd", "fold", "sketch", _low().alias("low")), "node"), "rest")
    # one side is without the bucket's largest class, so that its members do not meet each other
    a = left.select("key", F.pmod(F.xxhash64("node"), "salts").cast("int").alias("salt"), F.col("node").alias("a"), F.col("root").alias("ra"), F.col("n_words").alias("na"), F.col("odd").alias("oa"), F.col("fold").alias("fa"), F.col("sketch").alias("sa"), F.col("low").alias("la"), "minor")
    b = left.where("minor").select("key", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("node").alias("b"), F.col("root").alias("rb"), F.col("n_words").alias("nb"), F.col("odd").alias("ob"), F.col("fold").alias("fb"), F.col("sketch").alias("sb"), F.col("low").alias("lb"))
    near, most = _reach("na", "nb", "fa", "fb")
    differ = F.aggregate(F.zip_with("oa", "ob", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x)
    # a pair lies in every bucket that both texts share: it comes out of that of their least common sketch value
    once = F.col("key") == F.xxhash64(F.array_min(F.array_intersect("sa", "sb")), F.least("la", "lb"))
    # merged, so that a hot bucket is dealt out by salt however small its rows are
    return (a.join(b.hint("merge"), ["key", "salt"]).where((~F.col("minor") | (F.col("a") < F.col("b"))) & (F.col("ra") != F.col("rb")) & near & (differ <= most) & once)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _joined(root: DataFrame, links: DataFrame) -> DataFrame:
    """The classes after ``links``: components of the links between the present roots."""
    a, b = root.toDF("a", "ra"), root.toDF("b", "rb")
    between = links.select("a", "b").join(_shuffled(a), "a").join(_shuffled(b), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")).where("a <> b")
    up = components(between).toDF("root", "top")
    return staged(root.join(_shuffled(up), "root", "left").select("node", F.coalesce("top", "root").alias("root")), "root")


def _turn(pairs: DataFrame, tested: DataFrame | None, texts: DataFrame, nodes: DataFrame, root: DataFrame, bound: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The pairs not tested before, the classes after their links, and these links; ``bound``: test their parities first."""
    pairs = staged(pairs if tested is None else pairs.join(_shuffled(tested), ["a", "b"], "left_anti"), "pairs")
    # staged, as texts are looked up for both ends of each pair
    new = staged(_verified(staged(_reachable(pairs, nodes), "reachable") if bound else pairs, texts, nodes), "links")
    return pairs, root if new.isEmpty() else _joined(root, new), new


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Classes (id, node, n_copies, class_id, class_size, similarity links) of the frame's rows.

    Returns (classes, links): classes has a row per distinct (id, text) with
    ``node`` (digest of the text), ``class_id``, ``class_size`` (distinct texts),
    ``class_links`` (links drawn in it, which connect it) and ``is_first`` (it
    is the class's one row to stay); links are verified pairs of different
    texts with their similarity, a set that connects every class.
    """
    texts = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    docs = staged(texts.mapInArrow(_sketch_batches, f"id {dict(texts.dtypes)['id']}, node binary, n_words bigint, sketch array<bigint>, odd array<bigint>, fold array<bigint>"), "sketches")
    nodes = staged(docs.groupBy("node").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.max("n_words").alias("n_words"),
                                            F.max("sketch").alias("sketch"), F.max("odd").alias("odd"), F.max("fold").alias("fold")), "nodes")
    buckets = _buckets(nodes)
    shared = staged(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key"), "shared")
    members = staged(buckets.withColumn("salt", _salt("node")).join(_salted(shared), ["key", "salt"]).select("key", "node", "wave"), "members")
    root, links, tested = nodes.select("node", F.col("node").alias("root")), None, None
    for turn in count():
        pairs, root, new = _turn(_to_pivots(members, root, turn), tested, texts, nodes, root)
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = new if links is None else links.unionByName(new)
        if turn >= len(WAVES) - 1 and new.count() <= LEAST_YIELD * pairs.count():
            break
    _, root, new = _turn(_rest(members, nodes, root), tested, texts, nodes, root, bound=False)
    links = links.unionByName(new)

    named = nodes.join(_shuffled(root), "node")
    drawn = links.join(_shuffled(root.withColumnRenamed("node", "a")), "a").groupBy("root").agg(F.count(F.lit(1)).alias("class_links"))
    heads = named.groupBy("root").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"), F.sum("copies").alias("class_rows"),
                                      F.min(F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("i"), F.col("node").alias("d"))).alias("first"))
    # both sides shuffled for the join alone, so that a class with a third of all texts is split
    heads = staged(heads.join(_shuffled(drawn), "root", "left").withColumn("class_links", F.coalesce("class_links", F.lit(0))), "heads")
    named = staged(named.select("node", "root", "copies").join(_shuffled(heads), "root")
                   .select("node", "copies", "class_id", "class_size", "class_rows", "class_links", F.col("first.d").alias("first_node"), F.col("first.i").alias("first_id")), "named")
    # documents find their node by salted join where the text has copies; others are alone with it
    single = docs.select("id", "node").withColumn("salt", _salt("id"))
    classes = (single.join(_salted(named), ["node", "salt"])
               .withColumn("is_first", (F.col("node") == F.col("first_node")) & F.col("id").eqNullSafe(F.col("first_id")))
               .select("id", "node", "copies", "class_id", "class_size", "class_rows", "class_links", "is_first"))
    return classes, links


def keep_first(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The frame's rows that stay: one of each class (its least id, nulls last)."""
    classes, _ = near_duplicates(df, doc_id, text)
    first = classes.where("is_first").groupBy(F.col("id").alias("__id"), F.col("node").alias("__node")).agg(F.count(F.lit(1)).alias("__rows"))
    rows = df.withColumn("__text_node", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))))
    kept = rows.join(first, (F.col("__text_node") == F.col("__node")) & F.col(doc_id).eqNullSafe(F.col("__id")))
    columns = [F.col(f"`{c}`") for c in df.columns]
    once = kept.where("__rows = 1").select(*columns)
    again = kept.where("__rows > 1").dropDuplicates(["__node", "__id"]).select(*columns)
    return once.unionByName(again)

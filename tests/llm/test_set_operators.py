"""Dedup, decontamination, mixing, sharding, chat and the pipeline against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewater.llm import chat, decontam, mixing, order_minhash as omh, queries, sharding
from tidewater.llm.common import running_total

SF = "/root/testdata/sf0.001"


def distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_banded_alignment_equals_full():
    rng = random.Random(1)
    for _ in range(1500):
        a = [rng.choice("abcd") for _ in range(rng.randint(0, 14))]
        b = [x for x in a if rng.random() > 0.1] + [rng.choice("abcd")] * rng.randint(0, 3) if rng.random() < 0.5 else [rng.choice("abcd") for _ in range(rng.randint(0, 14))]
        d = distance(a, b)
        for band in (1, 2, 4, 20):
            got = omh.banded_distance(a, b, band)
            assert got == d if d <= band else got > band
        n = max(len(a), len(b))
        assert omh.similar(a, b) == pytest.approx(1 - d / n if n and d <= 0.2 * n else 1.0 if a == b else 0.0)


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def test_classes_equal_brute_force(spark, docs):
    rng, texts = random.Random(5), []
    for _ in range(12):
        base = words(rng, rng.randint(60, 120))
        texts.append(base)
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(len(copy) // 40):
                copy[rng.randrange(len(copy))] = rng.choice(["new", "other"])
            if rng.random() < 0.5:
                del copy[rng.randrange(len(copy))]
            texts.append(copy)
    shared = words(rng, 40)             # a passage in many unrelated texts
    texts += [words(rng, 45) + shared + words(rng, 45) for _ in range(25)]
    rows = [(i, " ".join(t), "en", "s") for i, t in enumerate(texts)]
    rows += [(1000 + i, rows[0][1], "en", "s") for i in range(40)]     # exact copies
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            if distance(texts[i], texts[j]) <= 0.2 * max(len(texts[i]), len(texts[j])):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i in range(len(texts)):
        least[find(i)].append(i)
    want = {i: min(m) for m in least.values() for i in m} | {1000 + i: 0 for i in range(40)}
    df = docs(rows)
    classes, links = omh.near_duplicates(df)
    got = {r["id"]: r["class_id"] for r in classes.collect()}
    assert got == want
    assert all(r["similarity"] >= 0.8 for r in links.collect())
    assert sorted(r["doc_id"] for r in omh.keep_first(df).collect()) == sorted(set(want.values()))


def test_parities_bound_the_distance():
    """Two texts differ in at most 2 d minus the difference of their lengths."""
    rng = random.Random(3)
    for _ in range(400):
        a = words(rng, rng.randint(0, 60))
        b = [rng.choice(a + ["x"]) if rng.random() < 0.2 else w for w in a if rng.random() > 0.1] + words(rng, rng.randint(0, 4))
        bits = [np.unpackbits(omh.parities(omh.word_hashes(" ".join(t).encode())).view(np.uint8)) for t in (a, b)]
        assert (bits[0] != bits[1]).sum() <= 2 * distance(a, b) - abs(len(a) - len(b))


def test_no_candidate_is_dropped(spark, docs):
    """Pairs of near copies among many texts that share a long passage: classes as those of all pairs of each bucket."""
    rng = random.Random(11)
    passage, rows = words(rng, 80), []
    for i in range(150):
        own = words(rng, 50)
        rows.append(own + passage)
        if i % 10 == 0:
            near = own + passage
            for at in range(3, len(near), 9):
                near[at] = "changed"
            rows.append(near)
    df = docs([(i, " ".join(t), "en", "s") for i, t in enumerate(rows)])
    values = [set(enumerate(omh.sketches(omh.kmer_hashes(omh.word_hashes(" ".join(t).encode()))).tolist())) for t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if values[i] & values[j] and omh.similar(rows[i], rows[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    classes, _ = omh.near_duplicates(df)
    assert {r["id"]: r["class_id"] for r in classes.collect()} == {i: find(i) for i in range(len(rows))}


def test_isolated_pairs_are_proposed():
    """Pairs without a third copy: recall down to the threshold, by length and similarity."""
    rng = np.random.default_rng(13)
    for n in (7, 10, 12, 15, 20, 24, 26, 30, 60, 100, 300):
        for similarity in (0.9, 0.85, 0.8):
            edits = int(n * (1 - similarity) + 1e-9)
            found = 0
            for _ in range(100):
                a = rng.integers(0, 1 << 62, n).astype(np.uint64)
                b = a.copy()
                at = rng.choice(n, edits, replace=False)
                b[at] = rng.integers(0, 1 << 62, edits).astype(np.uint64)
                if rng.random() < 0.5:
                    b = np.delete(a, at)
                found += bool(set(omh.text_sketches(a).tolist()) & set(omh.text_sketches(b).tolist()))
            assert found >= (90 if similarity == 0.8 else 97), (n, similarity, found)


def test_isolated_pairs_are_linked(spark, docs):
    """One word changed in short texts, every fifth or so in longer ones."""
    rng, rows = random.Random(17), []
    for n in (7, 8, 10, 12, 15, 20, 24, 28, 30, 60, 120):
        for _ in range(6):
            a = [f"{w}{rng.randrange(10**6)}" for w in words(rng, n)]
            b = list(a)
            for at in [n // 2] if n < 30 else rng.sample(range(n), int(0.17 * n)):
                b[at] = "changed"
            rows += [a, b]
    classes, _ = omh.near_duplicates(docs([(i, " ".join(t), "en", "s") for i, t in enumerate(rows)]))
    assert {r["id"]: r["class_id"] for r in classes.collect()} == {i: i - i % 2 for i in range(len(rows))}


def test_folded_parities_bound_the_distance():
    rng = random.Random(4)
    for _ in range(300):
        a = words(rng, rng.randint(0, 60))
        b = [rng.choice(a + ["x"]) if rng.random() < 0.2 else w for w in a if rng.random() > 0.1] + words(rng, rng.randint(0, 4))
        bits = [np.unpackbits(omh.folded(omh.parities(omh.word_hashes(" ".join(t).encode()))).view(np.uint8)) for t in (a, b)]
        assert (bits[0] != bits[1]).sum() <= 2 * distance(a, b) - abs(len(a) - len(b))


def test_dedup_odd_rows(spark, odd):
    kept = omh.keep_first(odd).collect()
    assert len(kept) == len({r["text"] for r in odd.collect()} - {None}) and omh.keep_first(odd.limit(0)).count() == 0
    assert [r["doc_id"] for r in kept if r["text"] == "one"] == [4]
    classes, _ = omh.near_duplicates(odd)
    assert classes.count() == odd.count()


def test_decontamination_finds_substituted_passages(spark, docs, odd):
    rng = random.Random(7)
    items = [words(rng, rng.randint(15, 60)) for _ in range(20)] + [words(rng, 6)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(99, None), (98, "")], "item_id long, text string")
    rows, want = [], set()
    for i in range(120):
        body = words(rng, rng.randint(0, 80))
        if i % 3 == 0:
            k = rng.randrange(len(items))
            copy = list(items[k])
            if len(copy) >= 15:
                for at in range(rng.randrange(9), len(copy), 9 + i % 4):
                    copy[at] = "changed"
                if i % 6 == 0 and len(copy) > 40:
                    copy = copy[10:35]
            at = rng.randint(0, len(body))
            body[at:at] = copy
            want.add((i, k))
        elif i % 3 == 1:
            k = rng.randrange(len(items))
            body += [w if j % 2 else "x" for j, w in enumerate(items[k])]       # half of it: no overlap
        rows.append((i, " ".join(body).title() if i % 2 else "\n".join(body), "en", "s"))
    df = docs(rows)
    got = decontam.overlaps(df, bench)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    kept = {r["doc_id"] for r in decontam.decontaminate(df, bench).collect()}
    assert kept == set(range(120)) - {i for i, _ in want}
    assert decontam.decontaminate(odd, bench).count() == odd.count()
    assert decontam.overlaps(df, bench.limit(0)).count() == 0 and decontam.overlaps(df.limit(0), bench).count() == 0


def test_excerpts_are_found_at_every_position(spark, docs):
    """Exact excerpts of 13, 14 and 15 words of an item inside unrelated text; substituted ones against all stretches."""
    rng = random.Random(23)
    item = [f"item{i}" for i in range(40)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows, want = [], {}
    for n in (10, 13, 14, 15):      # 10 of the 13 words around them are not enough
        for at in range(len(item) - n + 1):
            rows.append([*words(rng, 30), *item[at:at + n], *words(rng, 30)])
            want[len(rows) - 1] = (30, 30 + n, n, n) if n >= 13 else None
    got = {r["doc_id"]: r for r in decontam.overlaps(docs([(i, " ".join(t), "en", "s") for i, t in enumerate(rows)]), bench).collect()}
    assert set(got) == {i for i, w in want.items() if w}
    # a run whose mask ignores its first or last word may begin or end one word outside
    assert all(want[i][0] - 1 <= r["first_word"] <= want[i][0] and want[i][1] <= r["end_word"] <= want[i][1] + 1 for i, r in got.items())
    assert all((r["matched"], r["compared"]) == want[i][2:] for i, r in got.items())

    # substituted: found if and only if a seed lies in a stretch of 13 words or more that is 80 % equal
    rows = []
    for _ in range(200):
        n = rng.randint(13, 24)
        at = rng.randint(0, len(item) - n)
        body = item[at:at + n]
        for k in rng.sample(range(n), rng.randint(1, 5)):
            body[k] = "changed"
        rows.append((["other"] * 45 + body + ["other"] * 45, 45 - at))
    want = set()
    for i, (t, shift) in enumerate(rows):
        same = [a == b for a, b in zip(item, t[shift:])]
        seeded = [p for m in decontam.MASKS for p in range(31) if all(same[p + k] for k, c in enumerate(m) if c == "1")]
        if any(a <= p and p + 10 <= b and b - a >= 13 and 5 * sum(same[a:b]) >= 4 * (b - a) for p in seeded for a in range(p + 1) for b in range(p + 10, 41)):
            want.add(i)
    got = {r["doc_id"] for r in decontam.overlaps(docs([(i, " ".join(t), "en", "s") for i, (t, _) in enumerate(rows)]), bench).collect()}
    assert got == want and 20 < len(want) < 200


def test_masks_leave_no_gap(spark, docs):
    """Every fifth word replaced, at all offsets; items of 10 to 12 words with any one word replaced."""
    rng = random.Random(29)
    items = [[f"i{k}w{i}" for i in range(n)] for k, n in enumerate((10, 11, 12, 15, 20, 40, 63))]
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    rows, want = [], set()
    for k, item in enumerate(items):
        gone = [range(o, len(item), 5) for o in range(5)] if len(item) >= 15 else [[o] for o in range(len(item))]
        for g in gone:
            body = ["changed" if i in g else w for i, w in enumerate(item)]
            rows.append(words(rng, 20) + body + words(rng, 20))
            if 5 * len(g) <= len(item):
                want.add((len(rows) - 1, k))
    got = {(r["doc_id"], r["item_id"]) for r in decontam.overlaps(docs([(i, " ".join(t), "en", "s") for i, t in enumerate(rows)]), bench).collect()}
    assert want <= got and len(want) == 33 + 17


def test_whole_items_are_found_on_driver_rows(spark):
    df, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = {r["doc_id"]: " ".join((r["text"] or "").lower().split()) for r in df.collect()}
    want = {(d, b["item_id"]) for b in bench.collect() for d, t in texts.items() if f" {' '.join(b['text'].lower().split())} " in f" {t} "}
    got = {(r["doc_id"], r["item_id"]) for r in decontam.overlaps(df, bench).collect()}
    assert want <= got and want


def test_running_total(spark):
    df = spark.createDataFrame([("a", 5, 1), ("a", 0, 2), ("a", 300, 3), (None, 7, 4), (None, 600, 5)], "k string, o long, v long")
    got = {(r["k"], r["o"]): r["t"] for r in running_total(df, ["k"], "o", "v", "t", 256).collect()}
    assert got == {("a", 0): 0, ("a", 5): 2, ("a", 300): 3, (None, 7): 0, (None, 600): 4}


def test_shards_interleave_sources(spark, docs, odd):
    rows = [(i, f"t{i}", "en", "hot" if i % 3 else f"s{i % 7}") for i in range(1000)]
    got = sharding.shard_rows(docs(rows).withColumn("slot", F.lit("clash")), 24).collect()
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert set(by) == set(range(24)) and {len(v) for v in by.values()} <= {41, 42}
    for v in by.values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))
        assert abs(sum(r["source"] == "hot" for r in v) - len(v) * 666 / 1000) <= 8
    # the same by hand
    key = lambda i: (hashlib.md5(f"9:{i}".encode()).hexdigest(), i)
    order = []
    for s in {r[3] for r in rows}:
        own = sorted((r[0] for r in rows if r[3] == s), key=key)
        order += [((2 * k + 1) / (2 * len(own)), s, i) for k, i in enumerate(own)]
    place = {i: k for k, (_, _, i) in enumerate(sorted(order))}
    assert all(r["shard"] == place[r["doc_id"]] * 24 // 1000 for r in got)
    out = sharding.shard_rows(odd, 4).collect()
    assert len(out) == odd.count() and max(Counter(r["shard"] for r in out).values()) == 3
    assert sharding.shard_rows(odd.limit(0), 4).count() == 0


def test_shards_do_not_depend_on_row_order(spark, docs):
    """Rows that repeat an id, or have none, are told apart by their texts."""
    df = docs([(i % 3 or None, f"text {i}", "en", f"s{i % 2}") for i in range(90)])
    got = [{r["text"]: (r["shard"], r["slot"]) for r in sharding.shard_rows(d, 4).collect()}
           for d in (df.coalesce(1).sortWithinPartitions("text"), df.coalesce(1).sortWithinPartitions(F.desc("text")))]
    assert got[0] == got[1] and len(set(got[0].values())) == 90


def water(children, given):
    """children: {name: (weight, capacity)} -> shares, by repeated filling."""
    got, open_ = {}, dict(children)
    while open_:
        ws = sum(w for w, _ in open_.values())
        full = {k for k, (w, c) in open_.items() if c * ws <= w * given}
        if not full:
            return got | {k: w * given // ws for k, (w, _) in open_.items()}
        for k in full:
            got[k] = open_.pop(k)[1]
            given -= got[k]
    return got


def test_budgets_share_among_siblings_first(spark):
    rng = random.Random(4)
    leaves = [(d, g, s, rng.choice([0, 3, 50, 1000, 10**6])) for d in ("web", "news", None) for g in ("en", "fr", None) for s in ("a", "b", None)]
    weights = {"domain": {"web": 5, "news": 2}, "lang": {"en": 7}, "source": {"a": 3}}
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    for budget in (0, 17, 5000, 10**6, 10**9):
        got = {(r[0], r[1], r[2]): r["got"] for r in mixing.budgets(df, F.lit(budget), weights, 2).collect()}
        cap = lambda *p: sum(2 * t for *path, t in leaves if tuple(path[:len(p)]) == p)
        w = lambda level, v: weights[level].get(v, 1)
        want = {}
        for d, given in water({d: (w("domain", d), cap(d)) for d in ("web", "news", None)}, budget).items():
            for g, below in water({g: (w("lang", g), cap(d, g)) for g in ("en", "fr", None)}, given).items():
                for s, x in water({s: (w("source", s), cap(d, g, s)) for s in ("a", "b", None)}, below).items():
                    want[d, g, s] = x
        assert got == want


def test_prefixes_of_seeded_epochs(spark, docs, odd):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(0, 20)), rng.choice(["en", "en", "fr"]), rng.choice(["src0", "src1", "src4"])) for i in range(500)]
    df = docs(rows)
    got = queries.mixed(df).collect()
    n, text = {r[0]: len(r[1].split()) for r in rows}, {r[0]: r[1] for r in rows}
    leaves = defaultdict(list)
    for i, _, g, s in rows:
        leaves[(queries.DOMAINS[int(s[3:]) % 4], g, s)].append(i)
    budget = sum(n.values()) * queries.BUDGET_PCT // 100
    shares = {(r[0], r[1], r[2]): r["got"] for r in mixing.budgets(
        spark.createDataFrame([(*k, sum(n[i] for i in v)) for k, v in leaves.items()], "domain string, lang string, source string, tokens long"),
        F.lit(budget), queries.WEIGHTS, queries.MAX_EPOCHS).collect()}
    want = Counter()
    for k, ids in leaves.items():
        total = sum(n[i] for i in ids)
        whole, rest = divmod(shares[k], total)
        for i in ids:
            want.update((i, e) for e in range(whole))
        order = sorted(ids, key=lambda i: hashlib.md5(f"6:{whole}:{i}:{hashlib.md5(text[i].encode()).hexdigest()}".encode()).hexdigest())
        run = 0
        for i in order:
            run += n[i]
            if run > rest or not rest:
                break
            want[i, whole] += 1
    assert Counter((r["doc_id"], r["epoch"]) for r in got) == want
    assert sum(r["n_tokens"] for r in got) <= budget
    assert queries.mixed(odd).columns[:5] == odd.columns and queries.mixed(odd.limit(0)).count() == 0


def test_snapshots_collapse(spark):
    rows = []
    for c, n in ((1, 3), (2, 5), (3, 5), (4, 2)):
        rows += [(c, k, "user" if k % 2 else "assistant", f"turn {k}") for k in range(n)]
    rows += [(5, 0, "assistant", "turn 0"), (5, 1, "user", "another"), (6, 0, None, None), (6, 0, None, None), (None, 0, "user", "turn 0"), (7, None, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.collapse_and_render(df).collect()}
    assert set(got) == {2, 5, 6, 7} and got[2]["copies"] == 2 and got[2]["n_turns"] == 5
    assert got[5]["text"] == "<|im_start|>assistant\nturn 0<|im_end|>\n<|im_start|>user\nanother<|im_end|>\n"
    assert got[6]["text"] == "<|im_start|>unknown\n<|im_end|>\n" and chat.collapse_and_render(df.limit(0)).count() == 0


def test_pipeline_chains_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes, now = [docs.count()], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, SF).collect(), docs.schema)
        assert now.columns == docs.columns
        sizes.append(now.count())
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > 0
    end = corpus_pipeline.run(spark, SF).collect()
    assert len(end) == sizes[-1] and {r["shard"] for r in end} == set(range(24))


def test_near_dedup_keeps_odd_column_names(docs):
    rng = random.Random(31)
    text = " ".join(words(rng, 40))
    df = docs([(1, text, "en", "s"), (2, text, "en", "s"), (3, " ".join(words(rng, 40)), "en", "s")]).withColumn("a.b", F.lit(7)).withColumn("node", F.lit("x"))
    assert sorted((r["doc_id"], r["a.b"], r["node"]) for r in omh.keep_first(df).collect()) == [(1, 7, "x"), (3, 7, "x")]


def exchanged(df):
    """Names of the columns that shuffles carry."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            found.append({node.output().apply(i).name() for i in range(node.output().size())})
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_many_seeds_shuffle_no_word_lists(spark, docs, monkeypatch):
    """Beyond the broadcast's bound: the same overlaps, and no document's words in an exchange."""
    rng = random.Random(37)
    items = [words(rng, n) for n in (3, 5, 9, 10, 12, 25, 60, 60)] + [["short", "item"]]
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)] + [(99, None), (98, "")], "item_id long, text string")
    rows = []
    for i in range(150):
        t = list(rng.choice(items))
        for _ in range(rng.randint(0, max(0, len(t) // 6))):
            t[rng.randrange(len(t))] = "changed"
        rows.append((i, " ".join(words(rng, rng.randint(0, 30)) + t + words(rng, rng.randint(0, 30))) if i % 10 else None, "en", "s"))
    rows += [(i + 1000, t, g, s) for i, t, g, s in rows[:20]] + [(None, " ".join(items[5]), "en", "s"), (5000, "short item", "en", "s")]
    whole = sorted(map(str, decontam.overlaps(docs(rows), bench).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_SEEDS", 0)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = decontam.overlaps(docs(rows), bench)
        assert all("w" not in names and "d" not in names for names in exchanged(out)) and len(exchanged(out)) > 2
        assert sorted(map(str, out.collect())) == whole and len(whole) > 80
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def nodes_of(plan):
    """The plan's nodes, each with those above it; the final plan where it is adaptive."""
    todo = [(plan, ())]
    while todo:
        node, above = todo.pop()
        yield node, above
        todo += [(node.children().apply(i), (*above, node)) for i in range(node.children().size())]


def test_hits_carry_no_word_lists(spark, docs, monkeypatch):
    """Rows made by the join with the seeds are held in memory, of a repeated item as many as the text has runs: of the text they carry only the words next to the hit."""
    rng = random.Random(41)
    items = [words(rng, n) for n in (4, 10, 14, 33)]
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    rows = [(0, None, "en", "s"), (1, "", "en", "s")]
    for i in range(2, 30):
        t = [w for _ in range(rng.randint(1, 12)) for w in rng.choice(items) + words(rng, rng.randint(0, 2))]
        rows.append((i, " ".join(t), "en", "s"))
    found = []
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for block in (1 << 30, decontam.BLOCK, 7):
            monkeypatch.setattr(decontam, "BLOCK", block)
            out = decontam.overlaps(docs(rows), bench)
            above, = [above for node, above in nodes_of(out._jdf.queryExecution().executedPlan()) if node.nodeName() == "BroadcastHashJoin" and "seed" in node.simpleString(100)]
            carried = {n.output().apply(i).name() for n in above if n.nodeName() in ("Generate", "BroadcastHashJoin") for i in range(n.output().size())}
            assert "near" in carried and "w" not in carried
            found.append(sorted(map(str, out.collect())))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(found[0]) > 40 and found[0] == found[1] == found[2]


def test_near_dedup_broadcasts_no_copies_per_salt(spark, docs, monkeypatch):
    """The planner's sizes leave out the copies that an explode makes and what files compress: tables this small would be broadcast"""
    rng = random.Random(43)
    base = words(rng, 60)
    near = lambda: " ".join(w if rng.random() > 0.03 else "changed" for w in base)
    rows = [(i, near() if i % 3 else " ".join(words(rng, rng.randint(3, 70))), "en", "s") for i in range(60)]
    plans, staged = {}, omh.staged

    def noted(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan())
        return staged(df, name)

    monkeypatch.setattr(omh, "staged", noted)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        classes, links = omh.near_duplicates(docs(rows))
        plans["classes"] = [classes._jdf.queryExecution().executedPlan()]
        sizes = Counter(r["class_id"] for r in classes.collect())
        assert sizes[1] == 40 and links.count() >= 39
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    joins = {name: [n.nodeName() for p in found for n, _ in nodes_of(p) if n.nodeName().endswith("Join")] for name, found in plans.items()}
    for name in ("members", "per-class", "root", "named", "classes"):
        assert set(joins[name]) == {"SortMergeJoin"}, name
    assert "BroadcastHashJoin" not in joins["edges"] + joins["hop"] + joins["label"] + joins["heads"]
    texts = [n.output().toString() for p in plans["links"] for n, _ in nodes_of(p) if n.nodeName() == "BroadcastExchange"]
    assert not any("text" in t for t in texts)


def test_mixing_broadcasts_no_buckets(spark, docs, monkeypatch):
    """The table of digest buckets grows with the documents, and its files look small: this one would be broadcast"""
    rng = random.Random(47)
    df = docs([(i, " ".join(words(rng, rng.randint(0, 30))), rng.choice(["en", "fr", None]), rng.choice(["src1", "src2", None])) for i in range(200)])
    plans, staged = {}, mixing.staged

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan()
        return staged(df, name)

    monkeypatch.setattr(mixing, "staged", noted)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert mixing.mix(df, queries.domain_of(), queries.WEIGHTS).count() > 50
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sent = [n.output().toString() for n, _ in nodes_of(plans["ends"]) if n.nodeName() == "BroadcastExchange"]
    assert not any("__f#" in s for s in sent)
    assert any(n.nodeName() == "SortMergeJoin" and "cut_c" in n.simpleString(100) for n, _ in nodes_of(plans["ends"]))

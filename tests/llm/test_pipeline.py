"""The pipeline row by row against plain Python, odd and empty tables through it, and the queries' contracts."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_set_operators import distance, water, words
from test_text_operators import WORD, reference_ids, stats

import corpus_pipeline
from tidewater.llm import decontam, quality_rules, queries, tokens

SF = "/root/testdata/sf0.001"


def tables(spark, folder, docs_df, labels, items):
    docs_df.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


# ---- the five stages by hand; a row is (doc_id, text, lang, source) -------------------------------------------

def ratios(text):
    n_words, chars, symbols, dup, repeat = stats(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    part = lambda a, b: a / b if b else 0.0
    return {"word_len": part(chars, n_words), "symbols_per_word": part(symbols, n_words), "dup_line_share": part(dup, len(lines)),
            "repeat_share": part(repeat, n_words), "distinct_share": part(len(set(WORD.findall(text))), n_words),
            "upper_share": part(sum(c.isupper() for c in text), chars)}


def plain_quality(rows, rules):
    def kept(text):
        text = text or ""
        n_words, _, _, _, repeat = stats(text)
        if n_words < 50 or 100 * repeat > 50 * n_words:
            return False
        q = ratios(text)
        return not any(all((q[t.stat] >= t.cut) == t.at_least for t in rule) for rule in rules)
    return [r for r in rows if kept(r[1])]


def plain_dedup(rows):
    texts = sorted({r[1] for r in rows})
    split, group = [t.lower().split() for t in texts], list(range(len(texts)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            longest = max(len(split[i]), len(split[j]))
            if abs(len(split[i]) - len(split[j])) <= 0.2 * longest and len(set(split[i]) & set(split[j])) > longest / 3 and distance(split[i], split[j]) <= 0.2 * longest:
                group[find(i)] = find(j)
    least = {}
    for r in rows:
        c = find(texts.index(r[1]))
        least[c] = min(least.get(c, r[0]), r[0])
    return [r for r in rows if least[find(texts.index(r[1]))] == r[0]]


def plain_decontaminate(rows, items):
    def overlaps(text, item):
        t, n = text.lower().split(), len(item)
        for shift in range(-n + 10, len(t) - 9):
            same = [0 <= shift + k < len(t) and t[shift + k] == item[k] for k in range(n)]
            seeds = [p for m in decontam.MASKS for p in range(n - 9) if all(same[p + k] for k, c in enumerate(m) if c == "1")]
            lo, hi = max(0, -shift), min(n, len(t) - shift)
            for p in seeds:
                for a in range(lo, p + 1):
                    for b in range(max(p + 10, a + min(13, n)), hi + 1):
                        if 5 * sum(same[a:b]) >= 4 * (b - a):
                            return True
        return False
    return [r for r in rows if not any(overlaps(r[1], item) for item in items)]


def plain_mixture(rows):
    size = lambda r: len(WORD.findall(r[1]))
    leaves = defaultdict(list)
    for r in rows:
        leaves[queries.DOMAINS[int(r[3][3:]) % 4], r[2], r[3]].append(r)
    budget = sum(map(size, rows)) * queries.BUDGET_PCT // 100
    cap = lambda *p: sum(queries.MAX_EPOCHS * size(r) for k, v in leaves.items() if k[:len(p)] == p for r in v)
    weight = lambda level, v: queries.WEIGHTS.get(level, {}).get(v, 1)
    children = lambda *p: {k[len(p)] for k in leaves if k[:len(p)] == p}
    out = []
    for d, g1 in water({d: (weight("domain", d), cap(d)) for d in children()}, budget).items():
        for g, g2 in water({g: (weight("lang", g), cap(d, g)) for g in children(d)}, g1).items():
            for s, got in water({s: (weight("source", s), cap(d, g, s)) for s in children(d, g)}, g2).items():
                own = leaves[d, g, s]
                whole, rest = divmod(got, sum(map(size, own)))
                out += own * whole
                run = 0
                for r in sorted(own, key=lambda r: hashlib.md5(f"6:{whole}:{r[0]}:{hashlib.md5(r[1].encode()).hexdigest()}".encode()).hexdigest()):
                    run += size(r)
                    if run > rest:
                        break
                    out.append(r)
    return out


def plain_shards(rows, shards):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append(r)
    order = []
    for s, own in by_source.items():
        own.sort(key=lambda r: (hashlib.md5(f"9:{r[0]}".encode()).hexdigest(), hashlib.md5(r[1].encode()).hexdigest()))
        order += [((2 * k + 1) / (2 * len(own)), s, r) for k, r in enumerate(own)]
    n, out = len(order), Counter()
    for pos, (_, _, r) in enumerate(sorted(order, key=lambda x: x[:2])):
        shard = pos * shards // n
        out[r[0], r[1], shard, pos - (shard * n + shards - 1) // shards] += 1
    return out


def corpus(rng):
    items = [words(rng, n) for n in (14, 25, 40)]
    rows, labels = [], []
    for i in range(170):
        body = words(rng, rng.randint(60, 90))
        if i % 9 == 0:
            body = [w + "##*" for w in body]                       # junk that the rules learn
        elif i % 17 == 1:
            body = body[:30]                                        # too short
        elif i % 19 == 2:
            body[20:20] = items[i % 3]                              # a benchmark passage
        elif i % 23 == 3:
            body = (body[:5] * 20)[:80]                             # repeats itself
        rows.append((i, " ".join(body), rng.choice(["en", "en", "fr", "de"]), f"src{rng.choice([0, 0, 0, 1, 2, 3, 5])}"))
        labels.append((i, 0 if i % 9 == 0 else 1, 0))
    for k, i in enumerate((4, 5, 6, 7, 8, 10, 11)):                 # copies and near copies
        near = rows[i][1].split()
        for at in rng.sample(range(len(near)), k):
            near[at] = "changed"
        rows += [(300 + 2 * k, " ".join(near), "en", "src1"), (301 + 2 * k, rows[i][1], rows[i][2], rows[i][3])]
    return rows, labels, items


def test_pipeline_row_by_row(spark, docs, tmp_path):
    rows, labels, items = corpus(random.Random(41))
    folder = tables(spark, tmp_path, docs(rows).repartition(5), labels, [(k, " ".join(t)) for k, t in enumerate(items)])
    df = spark.read.parquet(f"{folder}/documents.parquet")
    rules = quality_rules.learn(df, spark.read.parquet(f"{folder}/labels.parquet"))
    assert rules
    now, sizes = rows, [len(rows)]
    for stage in (lambda r: plain_quality(r, rules), plain_dedup, lambda r: plain_decontaminate(r, items), plain_mixture):
        now = stage(now)
        sizes.append(len(now))
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > 60 and len(set(now)) < len(now)
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in got) == plain_shards(now, queries.SHARDS)


def test_odd_and_empty_tables_through_the_pipeline(spark, docs, odd, tmp_path):
    rng = random.Random(43)
    more = docs([(100 + i, " ".join(words(rng, 70)), "en", f"src{i % 3}") for i in range(40)] + [(None, " ".join(words(rng, 60)), None, None)])
    df = odd.unionByName(more).withColumn("a.b", F.col("doc_id")).withColumn("node", F.lit("x")).withColumn("shard", F.lit(-1))
    folder = tables(spark, tmp_path / "odd", df, [(None, None, None), (100, 1, None), (101, 0, 0)], [(None, None), (1, ""), (2, "one")])
    now = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, folder).collect(), df.schema)
        assert now.columns == df.columns
    end = corpus_pipeline.run(spark, folder)
    assert end.columns == [c for c in df.columns if c != "shard"] + ["shard", "slot"] and end.count() == now.count() > 10
    assert end.where("`a.b` IS DISTINCT FROM doc_id OR node <> 'x' OR shard < 0 OR text IS NULL").count() == 0
    folder = tables(spark, tmp_path / "empty", odd.limit(0), [], [])
    assert corpus_pipeline.run(spark, folder).collect() == []
    for name in ("op1_quality_rules", "op2_quality_classifier", "op5_decontamination", "op8_language_id", "op9_sharding", "op13_suffix_dedup"):
        assert queries.QUERIES[name](spark, folder).collect() == []


# ---- contracts of the registered queries, over the whole table ------------------------------------------------

@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def run(spark, name, **kinds):
    out = queries.QUERIES[name](spark, SF)
    have = dict(out.dtypes)
    assert {k: have.get(k) for k in kinds} == kinds
    return out.collect()


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_contract_of_quality_rules(spark, texts):
    rows = run(spark, "op1_quality_rules", doc_id="bigint", n_words="bigint", word_chars="bigint", n_symbols="bigint", n_dup_lines="bigint",
               n_repeat_words="bigint", base_failed="boolean", kept="boolean")
    assert {r["doc_id"]: tuple(r[c] for c in quality_rules.COUNTS) for r in rows} == {i: stats(r["text"]) for i, r in texts.items()}
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["base_failed"] and r["kept"]) for r in rows)


def test_contract_of_scores(spark, texts):
    rows = run(spark, "op2_quality_classifier", doc_id="bigint", held_out="boolean", score="double", predicted="int")
    assert len(rows) == len(texts) and all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    rows = run(spark, "op8_language_id", doc_id="bigint", held_out="boolean", lang_pred="string", score="double")
    assert len(rows) == len(texts) and all(r["held_out"] == (crc(r["doc_id"]) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    letters = {i: any(c.isalpha() for c in r["text"] or "") for i, r in texts.items()}
    assert all((r["lang_pred"] == "und") == (not letters[r["doc_id"]]) for r in rows)


def test_contract_of_shards(spark, texts):
    rows = run(spark, "op9_sharding", doc_id="bigint", size="bigint", text_crc32="bigint", law="string", shard="int", slot="bigint", grown_shard="int")
    want = {i: (len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for i, r in texts.items()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == want and {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_contract_of_token_files(spark, texts):
    rows = run(spark, "op10_token_files", doc_id="bigint", start="bigint", n_tokens="bigint", ids_crc32="bigint")
    got, start = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows}, 0
    ids = sorted(texts)
    for i, own in zip(ids, reference_ids([texts[i]["text"] for i in ids])):
        raw = b"".join(int(x).to_bytes(4, "little") for x in [*own, tokens.END])
        assert got[i] == (start, len(raw) // 4, zlib.crc32(raw))
        start += len(raw) // 4
    assert len(rows) == len(texts)


def test_contract_of_the_others(spark, texts):
    rows = run(spark, "op7_order_minhash", doc_id="bigint", class_id="bigint", class_size="bigint", class_links="bigint", is_first="boolean")
    assert {r["doc_id"] for r in rows} == set(texts)
    by = defaultdict(list)
    for r in rows:
        by[r["class_id"]].append(r)
    assert all(min(r["doc_id"] for r in v) == c and sum(r["is_first"] for r in v) == 1 and v[0]["class_links"] >= v[0]["class_size"] - 1 for c, v in by.items())
    assert {r["item_id"] for r in run(spark, "op5_decontamination", doc_id="bigint", item_id="bigint", matched="bigint", compared="bigint")}
    assert sum(r["n_tokens"] for r in run(spark, "op6_mixing", doc_id="bigint", n_tokens="bigint", epoch="int")) > 0
    assert sum(r["docs"] for r in run(spark, "op3_token_counts", n_tokens="bigint", docs="bigint")) == len(texts)

"""Quality rules, classifiers, counts and token files against brute force."""

import random
import tempfile
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import langid, pu_quality, quality_rules, token_counts, token_files, tokens

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def stats(text):
    text = text or ""
    w = WORD.findall(text)
    runs = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if n[r] > 1 for k in range(3)}
    lines, seen, dup = [x for x in text.split("\n") if WORD.search(x)], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_rule_statistics_match_brute_force(spark, docs, odd):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice(["a ", "b ", "c ", "d\n", "e\t", "é", "#", " ", "\x0b", " ", "\n"]) for _ in range(rng.randint(0, 90))), "en", "s") for i in range(300)]
    for df in (docs(rows), odd):
        got = quality_rules.apply_rules(df, []).collect()
        for r in got:
            want = stats(r["text"])
            assert tuple(r[c] for c in quality_rules.COUNTS) == want
            assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert r["kept"] == (not r["base_failed"])


def test_rules_learn_planted_junk_and_keep_clean(spark, docs):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    rows, labels = [], []
    for i in range(400):
        w = [word() for _ in range(80)]
        bad = i % 5 == 0
        if bad:
            w = [x + "###" for x in w] if i % 2 else [x.upper() for x in w]
        rows.append((i, " ".join(w), "en", "s"))
        labels.append((i, 0 if bad else 1, 0))
    df, lab = docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rules = quality_rules.learn(df, lab, min_cover=3)
    assert {t.stat for r in rules for t in r} <= set(quality_rules.RATIOS) and len(rules) >= 2
    got = {r["doc_id"]: r["kept"] for r in quality_rules.apply_rules(df, rules).collect()}
    assert got == {i: i % 5 != 0 for i in range(400)}
    assert quality_rules.learn(df, lab.limit(0)) == []
    clash = df.withColumn("n_words", F.lit("x")).withColumn("kept", F.lit(1))
    assert dict(quality_rules.apply_rules(clash, rules).dtypes)["kept"] == "boolean"
    assert quality_rules.apply_rules(df.limit(0), rules).count() == 0


def test_language_held_out(spark, odd):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    got = langid.identify(df, df.where(~held), keep=("doc_id", "lang")).withColumn("h", held).where("h").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
    pred = {(r["doc_id"], r["score"]): r["lang_pred"] for r in langid.identify(odd, df).collect()}
    assert pred[(None, 0.0)] == pred[(1, 0.0)] == pred[(2, 0.0)] == pred[(3, 0.0)] == "und"
    assert {r["lang_pred"] for r in langid.identify(df, df.limit(0)).collect()} == {"und"}
    assert langid.identify(df.limit(0), df).count() == 0


def test_kernel_is_shared_ngrams():
    a, b = "abcab", "abd"
    grams = lambda t: {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    k = (langid.presence([a]) @ langid.presence([b]).T)[0, 0]
    assert k == pytest.approx(len(grams(a) & grams(b)) / (len(grams(a)) * len(grams(b))) ** 0.5)


def test_pu_classifier_held_out(spark, odd):
    sf = "/root/testdata/sf0.01"
    df, lab = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = pu_quality.learn(df.where(~held), lab.where(~held))
    got = pu_quality.score(df, model).join(lab, "doc_id").where(held).collect()
    good = [r["score"] for r in got if r["quality"] == 1]
    bad = [r["score"] for r in got if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([g >= 0.3 for g in good]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in pu_quality.score(odd, model).collect())
    assert {r["score"] for r in pu_quality.score(odd, pu_quality.learn(df, lab.limit(0))).collect()} == {0.5}


def test_risk_correction_learns_from_unlabelled_mixture():
    rng = np.random.default_rng(0)
    make = lambda n, c: np.c_[rng.normal(c, 1, (n, 2)), np.zeros((n, pu_quality.DIM - 2))].astype(np.float32)
    pos, neg = make(400, 2), make(300, -2)
    m = pu_quality.fit(pos[:200], np.r_[pos[200:], neg], prior=0.4)
    assert (m.scores(make(200, 2)) > 0.5).mean() > 0.9 and (m.scores(make(200, -2)) < 0.5).mean() > 0.9


def reference_ids(texts):
    full = tokens.Encoder(tokens.default_path()).full
    return [np.array(full.encode(t or "", add_special_tokens=False).ids, np.uint32) for t in texts]


def test_encoder_equals_library():
    rng = random.Random(0)
    signs = "aB'sStT .!é ÉßİΣ1²_\n\t<|>́日\xa0\x1c ŉǅ"
    texts = ["", " ", "Don't WE'LL x''t", "<|endoftext|> a <|startoftext|>b", "x²³¹ ¼½ 12ab3", "_a_b __ª º", "a​b À̖"]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    want = reference_ids(texts)
    enc = tokens.Encoder(tokens.default_path())
    ids, n = enc.block([t.encode() for t in texts])
    assert (ids == np.concatenate(want)).all() and n.tolist() == [len(x) for x in want]
    assert [len(enc.encode(t)) for t in texts] == n.tolist()


def test_encoder_with_tiny_tables(monkeypatch):
    monkeypatch.setattr(tokens, "CHUNKS", 64)
    monkeypatch.setattr(tokens, "BLOCK", 100)
    text = " ".join(f"Word{i} x'll" for i in range(300))
    assert (tokens.Encoder(tokens.default_path()).encode(text) == reference_ids([text])[0]).all()


def test_codec_round_trip():
    rng = random.Random(3)
    for n in [0, 1, 3, 4, 5, 40, 41]:
        v = np.array([rng.choice([0, 5, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1]) for _ in range(n)], np.uint32)
        control, data = token_files.pack(v)
        assert len(control) == -(-n // 4) and (token_files.unpack(control, data, n) == v).all()


def test_token_files_round_trip(spark, odd):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = sorted(df.collect(), key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode())))
    start, want = 0, []
    for r, ids in zip(rows, reference_ids([r[1] for r in rows])):
        raw = np.append(ids, tokens.END).astype("<u4").tobytes()
        want.append((r[0], start, len(raw) // 4, zlib.crc32(raw)))
        start += len(raw) // 4
    got = token_files.checksums(token_files.round_trip(df)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_files.round_trip(df.limit(0)).count() == 0


def test_histogram_answers_every_limit(spark, odd):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("text").unionByName(odd.select("text"))
    n = sorted(len(x) for x in reference_ids([r[0] for r in df.collect()]))
    hist = token_counts.histogram(df)
    got = {r["n_tokens"]: r for r in hist.collect()}
    assert set(got) == set(n)
    for k, r in got.items():
        assert (r["docs"], r["docs_at_least"], r["docs_below"]) == (n.count(k), sum(x >= k for x in n), sum(x < k for x in n))
        assert r["truncated_tokens"] == sum(min(x, k) for x in n) and r["truncated_docs"] == sum(x > k for x in n)
        assert r["tokens_at_least"] == sum(x for x in n if x >= k)
    for limit in (0, 1, 100, 513, 10**6):
        assert spark.range(1).select(token_counts.truncated_total(hist, limit)).first()[0] == sum(min(x, limit) for x in n)
    for q in (0.01, 0.5, 0.99, 1.0):
        assert spark.range(1).select(token_counts.quantile(hist, q)).first()[0] == n[int(np.ceil(q * len(n))) - 1]
    assert token_counts.histogram(df.limit(0)).count() == 0


def test_token_files_of_one_id_keep_the_order(spark, docs):
    """One id, and none, over several files: start follows (id, digest), the same on every run."""
    rng = random.Random(12)
    rows = [(5, f"five {i} " * rng.randint(0, 3)) for i in range(900)] + [(None, f"none {i}") for i in range(700)] + [(i, f"id {i}") for i in range(6, 250)]
    rng.shuffle(rows)
    df = docs([(i, t, "en", "s") for i, t in rows]).repartition(5)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(r[1].encode())))
    start, want = 0, []
    for (i, _), ids in zip(ordered, reference_ids([t for _, t in ordered])):
        raw = np.append(ids, tokens.END).astype("<u4").tobytes()
        want.append((i, start, len(raw) // 4, zlib.crc32(raw)))
        start += len(raw) // 4
    for _ in range(2):
        out = tempfile.mkdtemp(prefix="tw-ids-") + "/files"
        manifest, table = token_files.write(df, out, files=8)
        assert manifest.count() >= 7 and "doc_ids" not in manifest.columns
        got = token_files.checksums(token_files.read(manifest, out, table)).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_language_needs_a_letter(spark, docs):
    learn = docs([(i, w, g, "s") for i, (w, g) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr")] * 5)])
    texts = ["½ ²", "½ a", "123 _ ٣", "日", "ª", "!?", "Ⅷ"]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs([(i, t, None, "s") for i, t in enumerate(texts)]), learn).collect()}
    assert [got[i] != "und" for i in range(7)] == [False, True, False, True, True, False, False]


def test_classifier_reads_one_row_of_a_repeated_id(spark, docs, monkeypatch):
    sizes = []
    fit = pu_quality.fit
    monkeypatch.setattr(pu_quality, "fit", lambda pos, unl, prior: sizes.append((len(pos), len(unl))) or fit(pos, unl, prior, epochs=1))
    df = docs([(1, f"text {i}", "en", "s") for i in range(500)] + [(i, f"good text {i}.", "en", "s") for i in range(2, 40)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 40)], "doc_id long, quality int, toxic int")
    pu_quality.learn(df, labels)
    assert sizes == [(20, 39)]


def test_rule_learning_reads_in_all_tasks(spark, docs, monkeypatch):
    seen = []
    staged = quality_rules.staged
    monkeypatch.setattr(quality_rules, "staged", lambda df, name: seen.append(df._jdf.queryExecution().toString()) or staged(df, name))
    quality_rules.learn(docs([(i, "a b c " * 30, "en", "s") for i in range(40)]), spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int"))
    assert seen and "Coalesce" not in seen[0] and "Repartition 4, true" in seen[0]

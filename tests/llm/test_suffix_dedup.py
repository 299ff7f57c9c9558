"""Suffix-array dedup against plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import queries, suffix_dedup, suffix_sort


def plain(rows, width):
    """(doc_id, n_bytes, n_removed, n_spans, sha) by a table of all strings."""
    least = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        if i is not None:
            for p in range(len(b) - width + 1):
                least[b[p:p + width]] = min(i, least.get(b[p:p + width], i))
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for p in range(len(b) - width + 1) if i is not None else ():
            if least[b[p:p + width]] < i:
                gone[p:p + width] = [True] * width
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return Counter(out)


def test_suffix_sort():
    rng = np.random.default_rng(5)
    for _ in range(80):
        parts = [bytes(rng.integers(1, rng.integers(2, 6) + 1, rng.integers(0, 90)).astype(np.uint8)) for _ in range(rng.integers(1, 10))]
        parts += parts[:2]
        raw = b"".join(p + b"\0" for p in parts)
        t, depth = np.frombuffer(raw, np.uint8), int(rng.integers(1, 60))
        order = suffix_sort.sort(t, depth)
        assert sorted(order.tolist()) == list(range(len(t)))
        heads = [raw[i:raw.index(b"\0", i)][:depth] for i in order]
        assert heads == sorted(heads)
        small = suffix_sort.smaller_than_successor(t)
        assert all(small[i] == (raw[i:] < raw[i + 1:]) for i in range(len(raw)))
        full = order[suffix_sort.ends(t)[order] >= depth]
        found = suffix_sort.common_prefixes(full, suffix_sort.eights(t), depth)
        for a, b, n in zip(full[:-1], full[1:], found[1:]):
            assert n == next((k for k in range(depth) if raw[a + k] != raw[b + k]), depth)


def corpus(seed, n=120):
    rng = random.Random(seed)
    line = lambda k: "".join(rng.choice("abcdé ü\n") for _ in range(k))
    shared = [line(rng.randint(5, 150)) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.5 else line(rng.randint(0, 60)) for _ in range(rng.randint(0, 6))]
        rows.append((rng.choice([i, i, i, i // 2, None]), "".join(parts)))
    rows += [(3, "x" * 300), (7, "y" + "x" * 200 + "z"), (9, "ab" * 100), (11, "ba" * 100), (500, rows[5][1]), (500, rows[5][1])]
    return rows + [(rng.randint(0, 200), rows[rng.randrange(n)][1]) for _ in range(20)]


@pytest.mark.parametrize("width,unit,hot", [(50, 1 << 22, 4096), (50, 2000, 2), (9, 700, 3), (20, 1500, 10 ** 9)])
def test_against_all_strings(docs, width, unit, hot):
    rows = corpus(width + unit)
    df = docs([(i, t, "en", "s") for i, t in rows]).repartition(3)
    out = suffix_dedup.dedup_substrings(df, width=width, unit=unit, hot=hot)
    assert Counter(map(tuple, suffix_dedup.digest(out).collect())) == plain(rows, width)
    for r in out.where("size(spans) > 1").limit(20).collect():
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_hot_line_in_many_contexts(docs):
    rng = random.Random(2)
    line = "the same line stands in every one of these documents"
    rows = [(i, f"{rng.random()} {line} {rng.random()}") for i in range(300)]
    out = suffix_dedup.digest(suffix_dedup.dedup_substrings(docs([(i, t, "en", "s") for i, t in rows]).repartition(4), unit=1000, hot=3))
    assert Counter(map(tuple, out.collect())) == plain(rows, 50)


def test_odd_rows_and_clashing_names(odd, docs):
    from pyspark.sql import functions as F
    df = odd.withColumn("unit", F.lit(1)).withColumn("a.b", F.lit(2)).withColumn("bucket", F.lit(None))
    got = suffix_dedup.digest(suffix_dedup.dedup_substrings(df)).collect()
    assert Counter(map(tuple, got)) == plain([(r.doc_id, r.text) for r in odd.collect()], 50)
    assert suffix_dedup.dedup_substrings(docs([])).collect() == []


def test_registered_query(spark, tmp_path, docs):
    rows = corpus(1)
    docs([(i, t, "en", "s") for i, t in rows]).write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.QUERIES["op13_suffix_dedup"](spark, str(tmp_path))
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string")]
    assert Counter(map(tuple, out.collect())) == plain(rows, 50)

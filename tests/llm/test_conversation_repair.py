"""Conversation repair against plain Python: exhaustive edits of short conversations, a forward table for long ones."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from tidewater.llm import conversation_repair as cr
from tidewater.llm import queries

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
WORD = re.compile(r"[^\x20\x09-\x0D]")


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        marks = WORD.findall(text)
        out.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def apply(rows, audit):
    out, i, last = [], 0, ""
    for c in audit:
        role = "assistant" if last == "u" else "user"
        if c == "I":
            out.append((role, ""))
        else:
            out += [rows[i]] if c == "K" else [(role, rows[i][1])] if c == "R" else []
            i += 1
        if c != "D":
            last = out[-1][0][:1]
    return out


def cost_of(rows, faults, audit):
    cost, i = 0, 0
    for c in audit:
        if c == "I":
            cost += 3
            continue
        if c != "D" and faults[i] in ("blank", "duplicate"):
            return None
        cost += {"K": 0, "R": 3, "D": 4}[c] + (3 if c != "D" and faults[i] == "truncated" else 0)
        i += 1
    return cost


def exhaustive(rows, most_inserts):
    """Cheapest, then ASCII-least audit, of all strings of edits."""
    faults, best = faults_of(rows), None
    for own in itertools.product("DKR", repeat=len(rows)):
        for gaps in itertools.product(range(most_inserts + 1), repeat=len(rows) + 1):
            audit = "".join("I" * g + c for g, c in zip(gaps, [*own, ""]))
            cost = cost_of(rows, faults, audit)
            if cost is not None and re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] for r, _ in apply(rows, audit))):
                best = min(best or (cost, audit), (cost, audit))
    return best


def forward(rows):
    """The same by a table over rows and states, for conversations of any length."""
    faults, nxt = faults_of(rows), {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserted(table):
        for _ in range(4):
            for q, (c, a) in list(table.items()):
                new = (c + 3, a + "I")
                table[nxt[q]] = min(table.get(nxt[q], new), new)
        return table

    table = inserted({"": (0, "")})
    for (role, _), fault in zip(rows, faults):
        new = {}

        def put(q, w):
            new[q] = min(new.get(q, w), w)

        extra = 3 if fault == "truncated" else 0
        for q, (c, a) in table.items():
            put(q, (c + 4, a + "D"))
            if fault not in ("blank", "duplicate"):
                x = role[:1]
                if (x == "s" and q == "") or (x == nxt[q]):
                    put(x, (c + extra, a + "K"))
                put(nxt[q], (c + 3 + extra, a + "R"))
        table = inserted(new)
    return min(table[q] for q in ("", "a") if q in table)


def expected(raw):
    """The query's rows, from (conv_id, turn, role, text)."""
    convs, ids = defaultdict(list), set()
    for conv, turn, role, text in raw:
        ids.add(conv)
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            row = (turn is not None, turn or 0, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            convs[conv] += [row] * (2 if kind == 3 else 1)
    out = Counter()
    for conv in ids:
        rows = sorted(convs[conv])
        turns = [t for known, t, _, _ in rows if known]
        pairs = [(r, t) for _, _, r, t in rows]
        found = Counter(faults_of(pairs))
        cost, audit = forward(pairs)
        illegal = sum(x[:1] + y[:1] not in ("su", "ua", "au") for (x, _), (y, _) in zip(pairs, pairs[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in apply(pairs, audit))
        out[conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found["blank"], found["duplicate"], found["truncated"],
            illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def conversations(seed, n=150, longest=14):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Well then!", "", " \t", "and so on", "Why?", "...", "é.", "same. ", None, "line\nline.", "x" * 5000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "ü", "unknown"]
    return [(rng.choice([c, c, c, None]) if rng.random() < 0.05 else c, rng.choice([t, t, t, t, None, t // 2, t + 3]), rng.choice(roles), rng.choice(texts))
            for c in range(n) for t in range(rng.randint(1, longest))]


def test_agenda_against_all_edits():
    rng = random.Random(3)
    for _ in range(120):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", " ", "c!", "d"])) for _ in range(rng.randint(0, 4))]
        want = exhaustive(rows, 2)
        assert forward(rows) == want
        codes = [(r[:1], {"": cr.FINE, "truncated": cr.CUT}.get(f, cr.GONE)) for (r, _), f in zip(rows, faults_of(rows))]
        cost, n, audit = cr.whole_conversation(codes)
        assert (cost, audit) == want and n == len(rows)
        for cut in range(len(rows) + 1):                   # two stretches joined
            cost, n, audit = cr.goal_of(cr.join_items(cr.stretch_items(codes[:cut]), cr.stretch_items(codes[cut:])))
            assert (cost, audit) == want and n == len(rows)
    assert cr.stretch_items([], "bsua", 5) == cr.stretch_items([("u", cr.GONE)] * 5)


@pytest.mark.parametrize("stretch", [2, 256])
def test_query_against_plain_python(spark, stretch):
    raw = conversations(stretch)
    out = cr.damage_and_repair(spark.createDataFrame(raw, SCHEMA).repartition(5), stretch)
    assert Counter(map(tuple, out.collect())) == expected(raw)


def test_long_conversation_and_many_copies(spark):
    rng = random.Random(8)
    raw = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "c!", f"{t}.", f"{t}"])) for t in range(3000)]
    raw += [(2, 5, "user", "again.")] * 700 + [(2, 6, "assistant", "yes.")] * 3 + [(3, t, "user", "q.") for t in range(40)]
    out = cr.damage_and_repair(spark.createDataFrame(raw, SCHEMA).repartition(6), 16)
    assert Counter(map(tuple, out.collect())) == expected(raw)


def test_repaired_turns(spark):
    raw = [r for r in conversations(11, 40) if r[0] is not None]
    report, turns = cr.repair(cr.damage(spark.createDataFrame(raw, SCHEMA)))
    got = defaultdict(list)
    for r in sorted(turns.collect(), key=lambda r: (r.conv_id, r.pos)):
        got[r.conv_id].append(r.role)
    assert all(re.fullmatch(r"(s?(ua)+)?", "".join(x[:1] for x in roles)) for roles in got.values())
    assert {r.conv_id for r in report.collect()} >= set(got)


def test_empty_table_and_clashing_names(spark):
    from pyspark.sql import functions as F
    assert cr.damage_and_repair(spark.createDataFrame([], SCHEMA)).collect() == []
    raw = conversations(5, 30)
    df = spark.createDataFrame(raw, SCHEMA).withColumn("at", F.lit(1)).withColumn("a.b", F.lit("x")).withColumn("audit", F.lit("K"))
    assert Counter(map(tuple, cr.damage_and_repair(df).collect())) == expected(raw)


def test_registered_query(spark, tmp_path):
    raw = conversations(21, 60)
    spark.createDataFrame(raw, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    out = queries.QUERIES["op11_conversation_repair"](spark, str(tmp_path))
    assert out.dtypes == [("conv_id", "bigint"), ("gaps", "bigint"), ("blank", "bigint"), ("duplicate", "bigint"), ("truncated", "bigint"),
                          ("illegal", "bigint"), ("cost", "bigint"), ("audit", "string"), ("repaired_sha256", "string")]
    assert Counter(map(tuple, out.collect())) == expected(raw)

"""Conversation repair: the cheapest edits that make a conversation alternate, by Knuth's lightest-derivation agenda.

An item says that the first j rows can be edited so that a conversation in state p (nothing yet, after system, after
user, after assistant) gets to state q.  Its weight is (cost, rows, audit): the edits' cost, how many rows they cover,
and their initials in order.  Deductions extend an item by one edit, or join the items of two neighbouring stretches
of rows; both add costs and append audits.  Weights of one item agree in the rows they cover, so they are ordered by
(cost, audit), and of two audits of one cost neither begins the other (only inserts could follow, at a cost); hence
appending keeps the order (monotone), and a conclusion is never lighter than a premise (superior: with equal cost it
covers more rows, or one premise is empty).  So the agenda finalises items in order of weight, and the first popped
goal is the lightest.

Edits, with their initials and costs: Keep 0, Rerole to user or assistant 3, Delete 4, Insert an empty user or
assistant turn 3; a truncated row that stays adds 3; blank and duplicate rows must be deleted.  The result's roles
must read ``(s?(ua)+)?`` by initials; the state tells which role an R or I takes, so the audit fixes the result.

Rows are ordered over the whole table by a range shuffle, equal rows counted first, so a conversation of any length
spreads over tasks: each stretch of ``STRETCH`` rows becomes a table of at most 16 items, and neighbouring tables are
joined pairwise.  The audit is applied to the texts in one streaming pass per conversation, as a digest of a
conversation's whole text must be; no task holds a conversation's texts.

Defined results: null conversation ids form one conversation; a null role or text is one space; rows are ordered by
(turn with nulls first, role, text); equal rows stand side by side, all but the first duplicates (or blank); an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import staged

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
STRETCH = 256
#: States: b nothing yet, s after system, u after user, a after assistant.  What a kept initial, and a turn made to fit, lead to.
KEPT = {"b": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
MADE = {"b": "u", "s": "u", "u": "a", "a": "u"}
ROLE = {"u": "user", "a": "assistant"}
ACCEPTED = "ba"
GOAL = ("goal",)
#: Faults of a row: none, truncated, to be deleted.
FINE, CUT, GONE = 0, 1, 2
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_SPACES = r"\x20\x09-\x0D"
Weight = tuple[int, int, str]


# ---- the agenda -----------------------------------------------------------------------------------------------

def lightest(axioms: Iterable[tuple], deduce: Callable[..., Iterator[tuple]], goal=None) -> dict:
    """Final weights of the items deducible from the axioms, up to the goal if one is given.

    ``deduce(item, weight, final)`` yields (conclusion, weight) for the deductions whose last premise to become
    final is ``item``.
    """
    agenda = [(w, item) for item, w in axioms]
    heapq.heapify(agenda)
    final: dict = {}
    while agenda:
        w, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = w
        if item == goal:
            break
        for conclusion, weight in deduce(item, w, final):
            if conclusion not in final:
                heapq.heappush(agenda, (weight, conclusion))
    return final


def _edits(rows: list[tuple[str, int]], first: int, last: bool):
    """Deductions by one edit; items (rows so far, state).  ``first`` is the number of rows the axiom covers."""
    n = first + len(rows)

    def deduce(item, w, final):
        j, state = item
        cost, _, audit = w
        to = MADE[state]
        yield (j, to), (cost + INSERT, j, audit + "I")
        if j < n:
            initial, fault = rows[j - first]
            yield (j + 1, state), (cost + DELETE, j + 1, audit + "D")
            if fault != GONE:
                extra = TRUNCATED if fault == CUT else 0
                if initial in KEPT[state]:
                    yield (j + 1, KEPT[state][initial]), (cost + KEEP + extra, j + 1, audit + "K")
                yield (j + 1, to), (cost + REROLE + extra, j + 1, audit + "R")
        elif last and state in ACCEPTED:
            yield GOAL, w
    return deduce


def stretch_items(rows: list[tuple[str, int]], starts: str = "bsua", deleted: int = 0) -> dict[tuple[str, str], Weight]:
    """(from state, to state) -> weight over ``deleted`` rows that must go and then ``rows``."""
    out = {}
    for p in starts:
        final = lightest([((deleted, p), (DELETE * deleted, deleted, "D" * deleted))], _edits(rows, deleted, False))
        out |= {(p, q): w for (j, q), w in final.items() if j == deleted + len(rows)}
    return out


def whole_conversation(rows: list[tuple[str, int]]) -> Weight:
    """The goal's weight for a conversation held in one stretch."""
    return lightest([((0, "b"), (0, 0, ""))], _edits(rows, 0, True), GOAL)[GOAL]


def join_items(left: dict, right: dict) -> dict:
    """Items over two neighbouring stretches."""
    def deduce(item, w, final):
        side, p, q = item
        if side == "left":
            pairs = (((p, y), w, final.get(("right", q, y))) for y in "bsua")
        elif side == "right":
            pairs = (((x, q), final.get(("left", x, p)), w) for x in "bsua")
        else:
            return
        for (x, y), v1, v2 in pairs:
            if v1 is not None and v2 is not None:
                yield ("both", x, y), (v1[0] + v2[0], v1[1] + v2[1], v1[2] + v2[2])

    axioms = [(("left", p, q), w) for (p, q), w in left.items()] + [(("right", p, q), w) for (p, q), w in right.items()]
    return {(p, q): w for (side, p, q), w in lightest(axioms, deduce).items() if side == "both"}


def goal_of(items: dict) -> Weight:
    return min(w for (p, q), w in items.items() if p == "b" and q in ACCEPTED)


# ---- rows in order, with their faults -------------------------------------------------------------------------

def ordered(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n, at): distinct rows with their number, ``at`` rising over the whole table."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = (df.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
            .groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")))
    return staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "turns")


def with_faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, at, n, initial, blank, later, cut): ``later`` if an equal row comes earlier, ``cut`` if truncated."""
    key = F.md5(F.concat(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("~")), F.lit("\0"),
                         F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    slim = rows.select("conv_id", "turn", "at", "n", F.substring("role", 1, 1).alias("initial"), key.alias("key"),
                       (~F.col("text").rlike(f"[^{_SPACES}]")).alias("blank"), (~F.col("text").rlike(rf"[.!?][{_SPACES}]*\z")).alias("cut"))
    again = staged(slim.groupBy("key").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").select("key", "first"), "repeated")
    return (slim.join(again, "key", "left").withColumn("later", F.coalesce(F.col("at") > F.col("first"), F.lit(False)))
            .select("conv_id", "turn", "at", "n", "initial", "blank", "later", "cut"))


def fault_counts(faults: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated) per conversation that has rows."""
    n = F.col("n")
    return faults.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("later"), n).otherwise(n - 1)).alias("duplicate"),
        F.sum((~F.col("blank") & ~F.col("later") & F.col("cut")).cast("long")).alias("truncated"))


# ---- audits ---------------------------------------------------------------------------------------------------

def _table(items: dict) -> list[dict]:
    return [{"p": p, "q": q, "cost": w[0], "rows": w[1], "audit": w[2]} for (p, q), w in items.items()]


_ITEMS = "array<struct<p:string,q:string,cost:bigint,rows:bigint,audit:string>>"


def _stretches(kind, stretch: int):
    """Per stretch of a task's piece of a conversation: its items, its first and last initial, its illegal pairs."""
    names = ["conv_id", "at", "items", "head", "tail", "illegal"]
    schema = pa.schema([("conv_id", kind), ("at", pa.int64()), ("items", pa.list_(pa.struct([
        ("p", pa.string()), ("q", pa.string()), ("cost", pa.int64()), ("rows", pa.int64()), ("audit", pa.string())]))),
        ("head", pa.string()), ("tail", pa.string()), ("illegal", pa.int64())])

    def legal(x, y):
        return x + y in ("su", "ua", "au")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        rows: list[tuple[str, int]] = []
        state = {"conv": None, "begun": False, "pieces": 0, "opened": False, "at": 0}

        def close(deleted: int = 0, initial: str = "", ends: bool = False):
            """One stretch: the rows held, or ``deleted`` copies that must go."""
            if not rows and not deleted:
                return
            if deleted:
                items, head, tail, bad = stretch_items([], "bsua", deleted), initial, initial, deleted - 1
            else:
                initials = [x for x, _ in rows]
                head, tail, bad = initials[0], initials[-1], sum(not legal(x, y) for x, y in zip(initials, initials[1:]))
                if ends and state["opened"] and not state["pieces"]:        # all of its rows are here
                    items = {("b", "a"): whole_conversation(rows)}
                else:
                    items = stretch_items(rows, "b" if state["opened"] and not state["pieces"] else "bsua")
            out.append((state["conv"], state["at"], _table(items), head, tail, bad))
            state["pieces"] += 1
            rows.clear()

        def batch():
            b = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], names)
            out.clear()
            return b

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("conv_id", "at", "n", "initial", "blank", "later", "cut")]
            for conv, at, n, initial, blank, later, cut in zip(*cols):
                if not state["begun"] or conv != state["conv"]:
                    close(ends=True)
                    state |= {"conv": conv, "opened": state["begun"], "begun": True, "pieces": 0}
                fault = GONE if blank or later else CUT if cut else FINE
                if not rows:
                    state["at"] = at
                rows.append((initial, fault))
                if n - 1 > stretch:
                    close()
                    state["at"] = at                       # after the first copy's stretch, which has the same or a smaller place
                    close(n - 1, initial)
                else:
                    rows.extend([(initial, GONE)] * (n - 1))
                if len(rows) >= stretch:
                    close()
            if len(out) >= 2000:
                yield batch()
        close()
        if out:
            yield batch()
    return run, schema


def _fold(kind):
    schema = pa.schema([("conv_id", kind), ("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[int, dict]] = []                 # (stretches, items), sizes falling: joins are balanced
        now, begun, tail, illegal = None, False, "", 0
        out: list[tuple] = []

        def close():
            while len(stack) > 1:
                n, items = stack.pop()
                m, before = stack.pop()
                stack.append((n + m, join_items(before, items)))
            cost, _, audit = goal_of(stack.pop()[1])
            out.append((now, cost, audit, illegal))

        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                if not begun or r["conv_id"] != now:
                    if begun:
                        close()
                    now, begun, tail, illegal = r["conv_id"], True, None, 0
                illegal += r["illegal"] + (tail is not None and tail + r["head"] not in ("su", "ua", "au"))
                tail = r["tail"]
                stack.append((1, {(x["p"], x["q"]): (x["cost"], x["rows"], x["audit"]) for x in r["items"]}))
                while len(stack) > 1 and stack[-1][0] == stack[-2][0]:
                    n, items = stack.pop()
                    m, before = stack.pop()
                    stack.append((n + m, join_items(before, items)))
            if len(out) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema.names)
                out.clear()
        if begun:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema.names)
    return run


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[column].dataType)


def audits(faults: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(conv_id, cost, audit, illegal): the lightest repair of each conversation that has rows."""
    kind, name = _arrow(faults, "conv_id"), dict(faults.dtypes)["conv_id"]
    pieces, _ = _stretches(kind, stretch)
    slim = faults.select("conv_id", "at", "n", "initial", "blank", "later", "cut").repartitionByRange("at").sortWithinPartitions("at")
    items = slim.mapInArrow(pieces, f"conv_id {name}, at bigint, items {_ITEMS}, head string, tail string, illegal bigint")
    # a stretch of further copies has its first copy's place and comes after it: its rows are more or its head the same
    numbered = items.withColumn("nth", F.monotonically_increasing_id())
    return (numbered.repartition("conv_id").sortWithinPartitions("conv_id", "at", "nth").drop("nth")
            .mapInArrow(_fold(kind), f"conv_id {name}, cost bigint, audit string, illegal bigint"))


def repaired(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text) of the repaired conversations, each in order within one partition."""
    kind, name = _arrow(rows, "conv_id"), dict(rows.dtypes)["conv_id"]
    schema = pa.schema([("conv_id", kind), ("pos", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, letters, i, state, pos = None, "", 0, "b", 0
        out: list[tuple] = []

        def put(role, text):
            nonlocal pos
            out.append((now, pos, role, text))
            pos += 1

        def inserts():
            nonlocal i, state
            while i < len(letters) and letters[i] == "I":
                state = MADE[state]
                put(ROLE[state], "")
                i += 1

        def batch():
            b = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema.names)
            out.clear()
            return b

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text", "n")]
            for conv, audit_, role, text, n in zip(*cols):
                if audit_ is not None:                     # the first row of each conversation
                    inserts()
                    now, letters, i, state, pos = conv, audit_, 0, "b", 0
                    continue
                for _ in range(n):
                    inserts()
                    letter, i = letters[i], i + 1
                    if letter == "K":
                        state = KEPT[state][role[:1]]
                        put(role, text)
                    elif letter == "R":
                        state = MADE[state]
                        put(ROLE[state], text)
                if len(out) >= 1000:
                    yield batch()
        inserts()
        if out:
            yield batch()

    both = (rows.select("conv_id", "at", F.lit(None).cast("string").alias("audit"), "role", "text", "n")
            .unionByName(audit.select("conv_id", F.lit(-1).cast("long").alias("at"), "audit"), allowMissingColumns=True))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(run, f"conv_id {name}, pos bigint, role string, text string")


def text_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of turns as ``repaired`` returns them: ``role:text`` joined by newlines."""
    kind, name = _arrow(turns, "conv_id"), dict(turns.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for b in batches:
            out = []
            for conv, pos, role, text in zip(*[b.column(c).to_pylist() for c in ("conv_id", "pos", "role", "text")]):
                if pos == 0:
                    if digest:
                        out.append((now, digest.hexdigest()))
                    now, digest = conv, hashlib.sha256()
                digest.update(f"{chr(10) if pos else ''}{role}:{text}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], kind), pa.array([h for _, h in out])], ["conv_id", "repaired_sha256"])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])
    return turns.mapInArrow(run, f"conv_id {name}, repaired_sha256 string")


def repair(df: DataFrame, stretch: int = STRETCH) -> tuple[DataFrame, DataFrame]:
    """Of conversations (conv_id, turn, role, text): a report per conversation, and the repaired turns.

    The report has (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit).
    """
    rows = ordered(df)
    faults = staged(with_faults(rows), "faults")
    audit = staged(audits(faults, stretch), "audits")
    report = fault_counts(faults).unionByName(audit, allowMissingColumns=True)
    return (report.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")]),
            repaired(rows, audit))


# ---- the query's damage ---------------------------------------------------------------------------------------

def damage(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): rows dropped, emptied, unstopped, repeated or given to the user by the hash of their place."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return (df.withColumn("kind__", kind).where("kind__ <> 0")
            .select("conv_id", "turn", F.when(F.col("kind__") == 4, "user").otherwise(role).alias("role"),
                    F.when(F.col("kind__") == 1, "").when(F.col("kind__") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                    F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind__") == 3, 2).otherwise(1))).alias("copy__")).drop("copy__"))


def damage_and_repair(df: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """A row for every conversation id of ``df``: its report after damage, and its repaired text's digest."""
    report, turns = repair(damage(df), stretch)
    every = (df.select("conv_id").distinct().unionByName(report, allowMissingColumns=True).unionByName(text_digests(turns), allowMissingColumns=True)
             .groupBy("conv_id"))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.agg(*[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
                     F.coalesce(F.max("repaired_sha256"), F.lit(EMPTY_SHA)).alias("repaired_sha256"))

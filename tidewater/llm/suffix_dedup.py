"""Suffix-array dedup: bytes covered by a string of ``WIDTH`` bytes that also starts in a document with a smaller id.

1. ``units`` packs documents into rows of about ``UNIT`` bytes, in a table bucketed by unit: all later joins by unit
   leave the texts where they are.
2. Every string of ``WIDTH`` bytes is put under its minimizer, the least hash of its k-mers, so equal strings have
   equal keys.  A run of strings with one minimizer is a piece of text.  Each unit sends its distinct keys (6 bytes
   each) to the keys' buckets, and gets back a bit each: does another unit, or another place of this one, have it?
3. Pieces under such keys go, distinct within the unit and with the least id that holds them, to the pieces' buckets.
   There the distinct pieces are suffix sorted in two stages (``suffix_sort``), and adjacent suffixes with a common
   prefix of ``WIDTH`` form the groups of equal strings.  Each string's least id goes back to the units.
4. A unit marks the bytes under strings with an id smaller than the document's.

A key held by ``HOT`` units or more (a line that a third of the documents contain) sends its strings one by one under
the hash of the whole string, so what meets in one bucket is one string, not one line in all its contexts; a unit sends
each distinct string once however often it holds it.  Nothing is dropped: sending more only costs time.

Defined results: null text is an empty one; a text shorter than ``WIDTH`` loses nothing; a null id is neither smaller
nor larger than another, so such a row loses nothing and takes nothing from others; rows that repeat an id are compared
with smaller ids only, not with each other; an empty table gives no rows; other columns are not read.
Ids must be integers; texts are valid UTF-8 (which has no byte 255).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import suffix_sort
from tidewater.llm.common import stage_path, staged

WIDTH, KMER = 50, 20
UNIT, SLICE = 4 << 20, 1 << 18
#: Bytes of text for each bucket of keys and of pieces, and the units from which a key counts as hot.
KEY_SHARE, PIECE_SHARE, HOT = 64 << 20, 8 << 20, 4096

_BASE = 0x9E3779B97F4A7C15
_NONE = np.iinfo(np.int64).max
_UNIT = "unit bigint, doc_ids array<bigint>, lens array<bigint>, n_bytes bigint, blob binary"


# ---- texts as units -------------------------------------------------------------------------------------------

def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column, and the length of each value; nulls are empty."""
    texts = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], np.diff(offsets)


def _pack(unit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = pa.Codec("zstd")
        for b in batches:
            if not b.num_rows:
                continue
            data, lens = _bytes(b.column("text"))
            stop = np.cumsum(lens)
            cut = np.flatnonzero(np.diff((stop - lens) // unit, prepend=-1))
            for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), b.num_rows]):
                raw = data[stop[lo] - lens[lo]:stop[hi - 1]]
                ids = b.column("doc_id").slice(lo, hi - lo).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().int >> 66]), pa.array([ids], pa.list_(pa.int64())), pa.array([lens[lo:hi].tolist()], pa.list_(pa.int64())),
                     pa.array([len(raw)], pa.int64()), pa.array([zstd.compress(raw.tobytes(), asbytes=True)], pa.binary())],
                    ["unit", "doc_ids", "lens", "n_bytes", "blob"])
    return run


def units(df: DataFrame, doc_id: str, text: str, unit: int) -> DataFrame:
    """The documents as a table of compressed units, bucketed by unit."""
    spark = df.sparkSession
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_pack(unit), _UNIT)
    name = f"llm_units_{uuid.uuid4().hex}"
    rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "unit").option("path", stage_path(spark, "units")).saveAsTable(name)
    return spark.table(name)


# ---- strings under their minimizers ---------------------------------------------------------------------------

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def _kmers(a: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k-mer, from those of the powers of two that make up ``k``."""
    part, size, out, have = a.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        if k & size:
            out = part if out is None else out[:len(part) - have] * _power(size) + part[have:]
            have += size
        if 2 * size > k:
            return _mix(out)
        part = part[:-size] * _power(size) + part[size:]
        size *= 2


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """Least of each ``w`` neighbours."""
    size = 1
    while 2 * size <= w:
        h, size = np.minimum(h[:-size], h[size:]), 2 * size
    return np.minimum(h[:len(h) - (w - size)], h[w - size:]) if size < w else h


def runs(a: np.ndarray, lens: np.ndarray, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, strings, key, document) of the runs of strings with one minimizer, at most width - k + 1 strings each."""
    stop, w = np.cumsum(lens), width - k + 1
    inside = np.zeros(len(a) + 1, np.int8)
    long = lens >= width
    inside[(stop - lens)[long]] = 1
    inside[(stop - width + 1)[long]] -= 1
    inside = np.cumsum(inside, dtype=np.int8) > 0          # where a string of one document starts
    starts, counts, keys = [], [], []
    for lo in range(0, len(a) - width + 1, SLICE):
        hi = min(lo + SLICE, len(a) - width + 1)
        least, ok = _least(_kmers(a[lo:hi + width - 1], k), w), inside[lo:hi]
        at = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (ok[1:] != ok[:-1])])
        n = np.diff(np.r_[at, hi - lo])
        at, n = at[ok[at]], n[ok[at]]
        parts = -(-n // w)                                 # more than w strings only where a text repeats itself
        which = np.repeat(np.arange(len(at)), parts)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
        starts.append(lo + at[which] + nth * w)
        counts.append(np.minimum(w, n[which] - nth * w))
        keys.append(least[at[which]])
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    start = np.concatenate(starts)
    return start, np.concatenate(counts), _mix(np.concatenate(keys)), np.searchsorted(stop, start, "right")


def _bucket(key: np.ndarray, bits: int) -> np.ndarray:
    return (key >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)


def _by_bucket(sorted_keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted keys."""
    b = _bucket(sorted_keys, bits)
    cut = np.flatnonzero(np.diff(b, prepend=-1)).tolist()
    for lo, hi in zip(cut, [*cut[1:], len(b)]):
        yield int(b[lo]), lo, hi


class _Unit:
    """A unit's documents with their runs."""

    def __init__(self, row: dict, width: int, k: int):
        self.lens = np.array(row["lens"], np.int64)
        raw = pa.Codec("zstd").decompress(row["blob"], decompressed_size=row["n_bytes"], asbytes=True) if row["n_bytes"] else b""
        self.a, self.width = np.frombuffer(raw, np.uint8), width
        self.known = np.array([d is not None for d in row["doc_ids"]], bool)
        self.ids = np.array([0 if d is None else d for d in row["doc_ids"]], np.int64)
        self.start, self.count, self.key, self.doc = runs(self.a, self.lens, width, k)
        mine = self.known[self.doc]
        self.start, self.count, self.key, self.doc = (x[mine] for x in (self.start, self.count, self.key, self.doc))
        self.keys, self.of, self.times = np.unique(self.key, return_inverse=True, return_counts=True)

    def pieces(self, flags: list[dict], bits: int):
        """(start, strings, document, piece) of the runs under repeated keys, and the distinct pieces: key, length, bytes."""
        repeated, hot = self.times > 1, np.zeros(len(self.keys), bool)
        seen = {f["bucket"]: f for f in flags}
        for b, lo, hi in _by_bucket(self.keys, bits):
            repeated[lo:hi] |= np.unpackbits(np.frombuffer(seen[b]["repeated"], np.uint8), count=hi - lo).astype(bool)
            hot[lo:hi] = np.unpackbits(np.frombuffer(seen[b]["hot"], np.uint8), count=hi - lo).astype(bool)
        cool, warm = (repeated & ~hot)[self.of], hot[self.of]
        start, count, key, doc = (x[cool] for x in (self.start, self.count, self.key, self.doc))
        if warm.any():                                     # one string each, under its own hash
            n = self.count[warm]
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            one = np.repeat(self.start[warm], n) + nth
            start, count, doc = np.r_[start, one], np.r_[count, np.ones(len(one), np.int64)], np.r_[doc, np.repeat(self.doc[warm], n)]
            own = np.zeros(len(one), np.uint64)
            for i in range(self.width):
                own = own * np.uint64(_BASE) + self.a[one + i] + np.uint64(1)
            key = np.r_[key, _mix(own)]
        size = count + self.width - 1
        most = int(size.max(initial=0))
        cell = np.zeros((len(start), 9 + most), np.uint8)
        cell[:, :8] = key.astype(">u8").view(np.uint8).reshape(-1, 8)
        cell[:, 8] = size
        for i in range(most):
            have = np.flatnonzero(size > i) if i >= self.width else slice(None)
            cell[have, 9 + i] = self.a[start[have] + i]
        _, first, piece = np.unique(cell.view(f"S{9 + most}").reshape(-1), return_index=True, return_inverse=True)
        return start, count, doc, piece, key[first], size[first], cell[first, 9:]


# ---- the passes -----------------------------------------------------------------------------------------------

def _per_unit(make, width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                out = make(row, _Unit(row, width, k))
                if out is not None:
                    yield out
    return run


def _send_keys(bits: int):
    def make(row, u):
        if not len(u.keys):
            return None
        cells = (u.keys << np.uint64(bits) >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        cut = list(_by_bucket(u.keys, bits))
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _, _ in cut], pa.int64()), pa.array([row["unit"]] * len(cut), pa.int64()),
             pa.array([cells[lo:hi].tobytes() for _, lo, hi in cut], pa.binary())], ["bucket", "unit", "keys"])
    return make


def _compare_keys(hot: int):
    def run(t: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint8).reshape(-1, 6) for x in t.column("keys").to_pylist()]
        cells = np.zeros((sum(map(len, parts)), 8), np.uint8)
        cells[:, :6] = np.concatenate(parts)
        _, of, times = np.unique(cells.view("<u8").reshape(-1), return_inverse=True, return_counts=True)
        cut = np.cumsum([0, *map(len, parts)])
        flags = [[np.packbits(f[lo:hi]).tobytes() for lo, hi in zip(cut, cut[1:])] for f in ((times > 1)[of], (times >= hot)[of])]
        return pa.table({"unit": t.column("unit"), "bucket": t.column("bucket"),
                         "repeated": pa.array(flags[0], pa.binary()), "hot": pa.array(flags[1], pa.binary())})
    return run


def _send_pieces(key_bits: int, bits: int):
    def make(row, u):
        if not len(u.keys):
            return None
        _, _, doc, piece, key, size, cells = u.pieces(row["flags"] or [], key_bits)
        if not len(key):
            return None
        least = np.full(len(key), _NONE)
        np.minimum.at(least, piece, u.ids[doc])
        have = np.arange(cells.shape[1]) < size[:, None]
        cut = list(_by_bucket(key, bits))
        part = lambda x: pa.array([x[lo:hi].tobytes() for _, lo, hi in cut], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _, _ in cut], pa.int64()), pa.array([row["unit"]] * len(cut), pa.int64()), part(size.astype(np.uint8)), part(least),
             pa.array([cells[lo:hi][have[lo:hi]].tobytes() for _, lo, hi in cut], pa.binary())], ["bucket", "unit", "sizes", "least", "text"])
    return make


def least_ids(sizes: np.ndarray, least: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of pieces with their least ids: per distinct piece the runs of strings with one least id.

    Returns each piece's distinct one, the number of runs of each distinct one, and all runs' lengths and ids.
    """
    most = int(sizes.max())
    have = np.arange(most) < sizes[:, None]
    cell = np.zeros((len(sizes), 1 + most), np.uint8)
    cell[:, 0] = sizes
    cell[:, 1:][have] = text
    _, first, piece = np.unique(cell.view(f"S{1 + most}").reshape(-1), return_index=True, return_inverse=True)
    size, low = sizes[first].astype(np.int64), np.full(len(first), _NONE)
    np.minimum.at(low, piece, least)
    body = np.zeros((len(first), most + 1), np.uint8)
    body[:, :most] = cell[first, 1:] + have[first]         # shifted by one: 0 ends a piece
    t = body[np.arange(most + 1) <= size[:, None]]
    x, left = suffix_sort.eights(t), suffix_sort.ends(t)
    order = suffix_sort.sort(t, width, x, left)
    order = order[left[order] >= width]
    of = np.repeat(np.arange(len(first)), size + 1)
    heads = np.flatnonzero(suffix_sort.common_prefixes(order, x, width) < width)
    found = np.zeros(len(t), np.int64)
    found[order] = np.repeat(np.minimum.reduceat(low[of[order]], heads), np.diff(np.r_[heads, len(order)]))
    at = np.flatnonzero(left >= width)
    new = np.r_[True, (of[at[1:]] != of[at[:-1]]) | (found[at[1:]] != found[at[:-1]])]
    head = np.flatnonzero(new)
    return piece, np.bincount(of[at[head]], minlength=len(first)), np.diff(np.r_[head, len(at)]), found[at[head]]


def _spread(counts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Positions of the items of the groups ``which``, of groups of ``counts`` items laid end to end."""
    n, begin = counts[which], (np.cumsum(counts) - counts)[which]
    return np.arange(n.sum()) + np.repeat(begin - (np.cumsum(n) - n), n)


def _sort_pieces(width: int):
    def run(t: pa.Table) -> pa.Table:
        column = lambda name, kind: [np.frombuffer(x, kind) for x in t.column(name).to_pylist()]
        sizes = column("sizes", np.uint8)
        piece, n, length, low = least_ids(np.concatenate(sizes), np.concatenate(column("least", "<i8")), np.concatenate(column("text", np.uint8)), width)
        cut = np.cumsum([0, *map(len, sizes)])
        out = []
        for lo, hi in zip(cut, cut[1:]):
            at = _spread(n, piece[lo:hi])
            out.append((n[piece[lo:hi]].astype(np.uint8).tobytes(), length[at].astype(np.uint8).tobytes(), low[at].tobytes()))
        return pa.table({"unit": t.column("unit"), "bucket": t.column("bucket")} | {
            name: pa.array([x[i] for x in out], pa.binary()) for i, name in enumerate(("runs", "lengths", "least"))})
    return run


def _cut(key_bits: int):
    def make(row, u):
        width, a = u.width, u.a
        edge = np.zeros(len(a) + 1, np.int32)
        if len(u.keys):
            start, _, doc, piece, _, _, _ = u.pieces(row["flags"] or [], key_bits)
            parts = sorted(row["found"] or [], key=lambda f: f["bucket"])
            if parts:
                n, length, low = (np.frombuffer(b"".join(f[c] for f in parts), kind).astype(np.int64)
                                  for c, kind in (("runs", np.uint8), ("lengths", np.uint8), ("least", "<i8")))
                at, times = _spread(n, piece), n[piece]
                size = length[at]
                total = np.cumsum(size) - size             # strings before each run, counted from the piece's first
                begin = np.repeat(start, times) + total - np.repeat(total[np.cumsum(times) - times], times)
                gone = low[at] < u.ids[np.repeat(doc, times)]
                np.add.at(edge, begin[gone], 1)
                np.add.at(edge, (begin + size - 1 + width)[gone], -1)
        gone = np.cumsum(edge[:-1]) > 0
        stop = np.cumsum(u.lens)
        limit = np.zeros(len(a) + 1, bool)
        limit[stop - u.lens] = limit[stop] = True
        first = np.flatnonzero(gone & (np.r_[True, ~gone[:-1]][:len(a)] | limit[:-1]))
        last = np.flatnonzero(gone & (np.r_[~gone[1:], True][:len(a)] | limit[1:])) + 1
        whose = np.searchsorted(stop, first, "right")
        base = (stop - u.lens)[whose]
        lost = np.bincount(whose, last - first, len(stop)).astype(np.int64)
        spans = pa.StructArray.from_arrays([pa.array(first - base), pa.array(last - base)], ["start", "stop"])
        offsets = lambda x: pa.array(np.r_[0, np.cumsum(x)].astype(np.int32))
        kept = pa.Array.from_buffers(pa.binary(), len(stop), [None, offsets(u.lens - lost).buffers()[1], pa.py_buffer(a[~gone].tobytes())])
        return pa.RecordBatch.from_arrays(
            [pa.array(row["doc_ids"], pa.int64()), pa.array(u.lens), pa.ListArray.from_arrays(offsets(np.bincount(whose, minlength=len(stop))), spans), kept],
            ["doc_id", "n_bytes", "spans", "kept"])
    return make


def _bits(total: int, share: int, least: int) -> int:
    return max(0, max(-(-total // share), least) - 1).bit_length()


def dedup_substrings(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, k: int | None = None,
                     unit: int = UNIT, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, spans array<(start, stop)>, kept binary) per row: removed byte ranges and what is left."""
    k = k or min(KMER, -(-width // 2))
    if not 1 <= k <= width or 2 * width - k > 255:
        raise ValueError("k-mers must fit the strings, and a piece one length byte")
    spark = df.sparkSession
    table = units(df, doc_id, text, unit)
    total, parts = table.agg(F.sum("n_bytes")).first()[0] or 0, int(spark.conf.get("spark.sql.shuffle.partitions"))
    key_bits, piece_bits = _bits(total, KEY_SHARE, parts), _bits(total, PIECE_SHARE, parts)

    keys = table.select("unit", "doc_ids", "lens", "n_bytes", "blob").mapInArrow(
        _per_unit(_send_keys(key_bits), width, k), "bucket bigint, unit bigint, keys binary")
    flags = staged(keys.groupBy("bucket").applyInArrow(_compare_keys(hot), "unit bigint, bucket bigint, repeated binary, hot binary")
                   .groupBy("unit").agg(F.collect_list(F.struct("bucket", "repeated", "hot")).alias("flags")), "flags")
    marked = table.join(flags.hint("shuffle_hash"), "unit", "left")
    pieces = marked.mapInArrow(_per_unit(_send_pieces(key_bits, piece_bits), width, k), "bucket bigint, unit bigint, sizes binary, least binary, text binary")
    found = (pieces.groupBy("bucket").applyInArrow(_sort_pieces(width), "unit bigint, bucket bigint, runs binary, lengths binary, least binary")
             .groupBy("unit").agg(F.collect_list(F.struct("bucket", "runs", "lengths", "least")).alias("found")))
    return marked.join(found.hint("shuffle_hash"), "unit", "left").mapInArrow(
        _per_unit(_cut(key_bits), width, k), "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary")


def digest(result: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of ``dedup_substrings``."""
    return result.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                         F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: The digest's rows in SQL: all strings of a document as hexadecimal digits.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
string AS (SELECT r, doc_id, p, substr(h, CAST(2 * p + 1 AS BIGINT), {2 * WIDTH}) AS s
           FROM (SELECT *, unnest(range(0, greatest(length(h) // 2 - {WIDTH - 1}, 0))) AS p FROM d WHERE doc_id IS NOT NULL) x),
least_id AS (SELECT s, min(doc_id) AS m FROM string GROUP BY s),
hit AS (SELECT r, p, coalesce(p > {WIDTH} + lag(p) OVER (PARTITION BY r ORDER BY p), true) AS apart
        FROM string JOIN least_id USING (s) WHERE doc_id > m),
span AS (SELECT r, min(p) AS a, max(p) + {WIDTH} AS b
         FROM (SELECT r, p, sum(CAST(apart AS INT)) OVER (PARTITION BY r ORDER BY p) AS k FROM hit) x GROUP BY r, k),
piece AS (SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS x, a AS y FROM span
          UNION ALL SELECT r, max(b), 1000000000000 FROM span GROUP BY r),
kept AS (SELECT r, string_agg(substr(h, CAST(2 * x + 1 AS BIGINT), CAST(2 * least(y - x, length(h)) AS BIGINT)), '' ORDER BY x) AS h FROM piece JOIN d USING (r) GROUP BY r),
lost AS (SELECT r, count(*) AS n, sum(b - a) AS bytes FROM span GROUP BY r)
SELECT doc_id, length(d.h) // 2 AS n_bytes, CAST(coalesce(bytes, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
       sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN lost USING (r)
"""

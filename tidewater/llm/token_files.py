"""Token-ID output: frequency-ranked ids in byte-aligned variable-length code.

File format (little-endian), one file per range of ids:

    magic    8 bytes  b"TWRANK02"
    blocks   control bytes, then data bytes, of about BLOCK ids each
    names    the document ids, as an Arrow stream of one column
    index    uint64 per document: length in ids; uint64 per block: documents,
             ids, control bytes, data bytes, offset in the file
    footer   uint64 documents, blocks, offsets of names and index; the magic again

An id is stored as its rank by falling frequency in the corpus (ties by id),
so frequent ids take one byte.  A control byte holds four 2-bit lengths less
one; the data bytes of the four values follow in the data part.  The rank
table is kept once per data set.

Decoding looks four lengths up per control byte in a table, turns them into
offsets by one cumulative sum, and gathers the bytes: no loop over ids.

Documents are laid out in ascending (id, digest of the text), null ids first:
a range shuffle of already encoded ids, sorted inside each range, so files are
ordered by the number of their range also where one id fills several.  Tasks
write under a name of their own attempt and return it, so a task that ran twice
leaves an orphan that no manifest names.  The manifest has a small row per
file; document ids are read back from the files.

Defined results: null text is encoded as an empty one (it has the end id
only); repeated rows are documents of their own; an empty table gives no files
and no rows; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import stage_path, staged
from tidewater.llm.tokens import END, blocks, default_path, encoder

MAGIC = b"TWRANK02"
BLOCK = 1 << 18
#: Lengths of the four values of each control byte.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, "<u4")
    size = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    codes = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    codes[:len(v)] = size - 1
    quads = codes.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) < size[:, None]
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values, by table lookup."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.zeros(n, np.int64)
    np.cumsum(size[:-1], out=at[1:])
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        if len(more):
            out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _filesystem(uri: str):
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def encode_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(id, digest, width, ids) per row: ids with the end id, ``width`` bytes each (2, or 4 if one needs it)."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in blocks(b.column("text")):
                ids, n = encoder(path).block(texts)
                ends = np.cumsum(n)
                full = np.insert(ids, ends, END)            # the end id closes each document
                width = 2 if full.max() <= 0xFFFF else 4
                flat = full.astype(f"<u{width}").tobytes()
                stop = (ends + np.arange(1, len(n) + 1)) * width
                rows = [flat[s:e] for s, e in zip([0, *stop[:-1].tolist()], stop.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(first, len(n)), b.column("digest").slice(first, len(n)),
                     pa.array([width] * len(n), pa.int32()), pa.array(rows, pa.binary())], ["id", "digest", "width", "ids"])

    rows = df.select(F.col(doc_id).alias("id"), F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("digest"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, digest bigint, width int, ids binary")


def _ids(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for width, x in zip(batch.column("width").to_pylist(), batch.column("ids")):
        yield np.frombuffer(x.as_buffer(), f"<u{width}")


def frequencies(encoded: DataFrame) -> DataFrame:
    """(token, n) of all ids: one array of counts per task, then one small aggregate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for b in batches:
            for x in _ids(b):
                n = np.bincount(x)
                if len(n) > len(total):
                    total = np.r_[total, np.zeros(2 * len(n) - len(total), np.int64)]
                total[:len(n)] += n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], ["token", "n"])

    return encoded.select("width", "ids").mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def _write_task(out: str, table: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.frombuffer(table, "<u4")
        fs = stream = name = None
        docs, blocks, first, waiting, held = [], [], None, [], 0
        at = 0

        def flush():
            nonlocal waiting, held, at
            control, data = pack(np.concatenate([rank[x] for x in waiting]))
            blocks.append((sum(1 for _ in waiting), held, len(control), len(data), at))
            stream.write(control)
            stream.write(data)
            at += len(control) + len(data)
            waiting, held = [], 0

        for b in batches:
            for i, ids in zip(b.column("id"), _ids(b)):
                if stream is None:
                    fs, root = _filesystem(out)
                    name = f"ids-{uuid.uuid4().hex}.bin"
                    stream = fs.open_output_stream(f"{root}/{name}")
                    stream.write(MAGIC)
                    at, first = len(MAGIC), i.as_py()
                docs.append((i.as_py(), len(ids)))
                waiting.append(ids)
                held += len(ids)
                if held >= BLOCK:
                    flush()
        if stream is None:
            return
        if waiting:
            flush()
        names_at = at
        column = pa.array([d for d, _ in docs], b.schema.field("id").type)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("doc_id", column.type)])) as names:
            names.write_batch(pa.RecordBatch.from_arrays([column], ["doc_id"]))
        names = sink.getvalue()
        stream.write(names)
        at += len(names)
        stream.write(np.array([n for _, n in docs], "<u8").tobytes())
        stream.write(np.array(blocks, "<u8").tobytes())
        stream.write(np.array([len(docs), len(blocks), names_at, at], "<u8").tobytes() + MAGIC)
        stream.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([first], column.type),
             pa.array([len(docs)], pa.int64()), pa.array([sum(n for _, n in docs)], pa.int64())],
            ["file", "part", "first", "docs", "ids"])
    return run


def write(df: DataFrame, out: str, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
          files: int | None = None) -> tuple[DataFrame, bytes]:
    """Write the frame's ids under ``out`` (a folder that all executors share).

    Returns the manifest (file, part: its place, first id, docs, ids; a row per file)
    and the table rank -> token id as little-endian 32-bit integers.  ``files``
    is the number of ranges (default: the session's shuffle partitions).
    """
    spark = df.sparkSession
    encoded = staged(encode_documents(df, doc_id, text, path), "encoded")
    # at most one count per id of the vocabulary
    counts = sorted(((-r["n"], r["token"]) for r in frequencies(encoded).collect()))
    tokens = np.array([t for _, t in counts], "<u4")
    rank = np.zeros(int(tokens.max()) + 1 if len(tokens) else 1, "<u4")
    rank[tokens] = np.arange(len(tokens))
    fs, root = _filesystem(out)
    fs.create_dir(root, recursive=True)
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(encoded.dtypes)["id"]
    manifest = staged(
        encoded.repartitionByRange(files, F.col("id").asc_nulls_first(), F.col("digest"))
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "digest").select("id", "width", "ids")
        .mapInArrow(_write_task(out, rank.tobytes()), f"file string, part int, first {kind}, docs bigint, ids bigint"),
        "manifest")
    return manifest, tokens.tobytes()


def read(manifest: DataFrame, out: str, table: bytes) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document back from the files, ids as 32-bit binary."""
    spark = manifest.sparkSession
    kind = dict(manifest.dtypes)["first"]
    # a row per file: the ids in all files before it
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    placed = (manifest.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
              .repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = np.frombuffer(table, "<u4")
        fs, root = _filesystem(out)
        for b in batches:
            for name, start in zip(b.column("file"), b.column("start")):
                with fs.open_input_file(f"{root}/{name.as_py()}") as f:
                    size = f.size()
                    foot = f.read_at(32 + len(MAGIC), size - 32 - len(MAGIC))
                    if foot[32:] != MAGIC or f.read_at(len(MAGIC), 0) != MAGIC:
                        raise ValueError(f"{name} is not a whole token file")
                    n, m, names_at, at = np.frombuffer(foot[:32], "<u8").tolist()
                    doc_ids = pa.ipc.open_stream(f.read_at(at - names_at, names_at)).read_all().column(0).combine_chunks()
                    lengths = np.frombuffer(f.read_at(8 * n, at), "<u8").astype(np.int64)
                    blocks = np.frombuffer(f.read_at(40 * m, at + 8 * n), "<u8").reshape(-1, 5).tolist()
                    done, before = 0, start.as_py()
                    for docs, ids, control, data, offset in blocks:
                        raw = f.read_at(control + data, offset)
                        values = tokens[unpack(raw[:control], raw[control:], ids)]
                        own = lengths[done:done + docs]
                        ends = np.cumsum(own)
                        chunks = [values[e - k:e].tobytes() for e, k in zip(ends.tolist(), own.tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [doc_ids.slice(done, docs), pa.array(before + ends - own, pa.int64()), pa.array(own, pa.int64()), pa.array(chunks, pa.binary())],
                            ["doc_id", "start", "n_tokens", "ids"])
                        done, before = done + docs, before + ids

    return placed.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary")


def checksums(documents: DataFrame) -> DataFrame:
    """Replace the ids by their unsigned crc32."""
    return documents.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def round_trip(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Write the frame's ids to files in the shared folder and read them back."""
    out = stage_path(df.sparkSession, "token-files")
    manifest, table = write(df, out, doc_id, text, path)
    return read(manifest, out, table)

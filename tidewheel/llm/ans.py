"""Token ids in files coded by a static range asymmetric numeral system.

Files: ``<path>/model`` holds the one frequency table shared by all blocks, ``<path>/blocks`` one row
per block. Documents lie in ascending ``doc_id`` order (then by a hash of the text), whole documents
to a block, and blocks are independent: any of them decodes with the table alone.

A block codes its ids in interleaved lanes: id ``t * lanes + k`` belongs to lane ``k``. Each lane has
a 64-bit state, 32-bit words move between states and the word stream. ``checkpoints`` hold all
states and the place in the word stream at every ``CHECK_STEPS`` steps, so parts of one block can be
decoded side by side. A CRC-32 over the ids and one over the coded bytes guard each block; a block
that fails either stops the read.

Defined results: NULL is the empty text and gives its end id alone. NULL ``doc_id`` comes first.
Repeated ids and rows are kept, equal ids ordered by text hash. An empty table gives files without
blocks, which read back as no rows. Extra columns are not stored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.tokens import shared_encoder, slices
from tidewheel.llm.words import has_column
from tidewheel.sources.sinks import materialised

SCALE = 20
LOW = np.uint64(1 << 31)
LANES = 1024
BLOCK_IDS = 1 << 18
CHECK_STEPS = 128
HEAD = "<4sHHQQI"
HEAD_BYTES = struct.calcsize(HEAD)
MAGIC, VERSION = b"tRAN", 1

BLOCKS = "part int, block int, start long, n_ids long, docs array<struct<doc_id:bigint,n:bigint>>, ids_crc long, coded_crc long, coded binary"
_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("n", pa.int64())]))
_BLOCK_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), _DOCS, pa.int64(), pa.int64(), pa.binary()]


class Corrupt(ValueError):
    """A block whose bytes or ids do not match their checksum."""


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of ``2 ** SCALE``; every id that occurs keeps at least one slot."""
    counts = counts.astype(np.float64)
    if not counts.sum():
        return np.zeros(len(counts), np.uint64)
    if (counts > 0).sum() > 1 << SCALE:
        raise ValueError("more ids in use than slots in the table")
    f = np.where(counts > 0, np.maximum(1, np.floor(counts * ((1 << SCALE) / counts.sum()))), 0).astype(np.int64)
    spare = (1 << SCALE) - int(f.sum())
    while spare:  # to or from the most frequent id, at most half of it at a time
        top = int(np.argmax(f))
        move = spare if spare > 0 else -min(-spare, max(1, int(f[top]) // 2))
        f[top] += move
        spare -= move
    return f.astype(np.uint64)


class Coder:
    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64) if len(freq) else self.freq
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), self.freq.astype(np.int64))

    def encode(self, ids: np.ndarray) -> bytes:
        n = len(ids)
        lanes = int(min(LANES, max(1, n // 64)))
        steps = -(-n // lanes)
        state = np.full(lanes, LOW)
        scale, half = np.uint64(SCALE), np.uint64(32)
        ids = ids.astype(np.intp)  # once a block; take() is given indices that it need not convert
        freq, cum = self.freq.take(ids), self.cum.take(ids)
        full = freq << np.uint64(63 - SCALE)
        words: list[np.ndarray] = []
        marks: list[np.ndarray] = []
        for t in range(steps - 1, -1, -1):
            row = slice(t * lanes, min(n, (t + 1) * lanes))
            x = state[: row.stop - row.start]
            out = np.flatnonzero(x >= full[row])
            high = x.take(out)
            words.append(high.astype(np.uint32))
            x[out] = high >> half
            q, r = np.divmod(x, freq[row])
            q <<= scale
            q += r
            np.add(q, cum[row], out=x)
            if t and t % CHECK_STEPS == 0:
                marks.append(state.copy())
        words.reverse()
        marks.reverse()
        sizes = np.cumsum([0] + [len(w) for w in words])
        body = [struct.pack(HEAD, MAGIC, VERSION, lanes, n, int(sizes[-1]), len(marks)), state.astype("<u8").tobytes()]
        for k, mark in enumerate(marks):
            body += [struct.pack("<Q", int(sizes[(k + 1) * CHECK_STEPS])), mark.astype("<u8").tobytes()]
        body += [w.astype("<u4").tobytes() for w in words]
        return b"".join(body)

    def decode(self, coded: bytes, checkpoint: int = 0, until: int | None = None) -> np.ndarray:
        """Ids from a checkpoint (0: the start) up to another one (None: the end)."""
        magic, version, lanes, n, n_words, n_marks = struct.unpack_from(HEAD, coded)
        if magic != MAGIC or version != VERSION:
            raise Corrupt("not a block of this format")
        at = HEAD_BYTES + 8 * lanes
        mark = at + (checkpoint - 1) * (8 + 8 * lanes)
        state = np.frombuffer(coded, "<u8", lanes, HEAD_BYTES if not checkpoint else mark + 8).copy()
        pos = 0 if not checkpoint else struct.unpack_from("<Q", coded, mark)[0]
        words = np.frombuffer(coded, "<u4", n_words, at + n_marks * (8 + 8 * lanes)).astype(np.uint64)
        steps = -(-n // lanes)
        first = checkpoint * CHECK_STEPS
        last = steps if until is None else min(steps, until * CHECK_STEPS)
        ids = np.empty(max(0, min(n, last * lanes) - first * lanes), np.uint32)
        mask, scale, word = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
        for t in range(first, last):
            m = min(lanes, n - t * lanes)
            x = state[:m]
            slot = x & mask
            s = self.symbol.take(slot.view(np.int64))
            ids[(t - first) * lanes : (t - first) * lanes + m] = s
            s = s.astype(np.intp)
            x >>= scale
            x *= self.freq.take(s)
            slot -= self.cum.take(s)
            x += slot
            low = np.flatnonzero(x < LOW)
            if pos + len(low) > n_words:
                raise Corrupt("the words end before the ids")
            x[low] = (x.take(low) << word) | words[pos : pos + len(low)]
            pos += len(low)
        if until is None and (np.any(state != LOW) or pos != n_words):
            raise Corrupt("the states do not end where they began")
        return ids


def write_encoded(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode all of ``docs`` and write the files.

    Texts move into order once and become blocks of plain ids, packed and written to the shared
    folder. Counting reads these: at most one row per id and task, and the table it gives is as long
    as the vocabulary, whatever the input. Then every block is coded by itself.
    """
    has_column(docs, "doc_id", "text")
    spark = docs.sparkSession
    end = int(end_id).to_bytes(4, "little")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def blocks(batches):
        encoder, part = shared_encoder(tokenizer), TaskContext.get().partitionId()
        held: list[tuple] = []
        size, start, number = 0, 0, 0

        def close():
            raw = b"".join(ids for _, ids in held)
            docs = [{"doc_id": d, "n": len(i) // 4} for d, i in held]
            return _row(part, number, start, size, docs, zlib.crc32(raw), 0, _squeezed(raw))

        for batch in slices(batches):
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True):
                held.append((doc, ids + end))
                size += len(ids) // 4 + 1
                if size >= BLOCK_IDS:
                    yield close()
                    held, start, size, number = [], start + size, 0, number + 1
        if held:
            yield close()

    order = ["doc_id", "_hash", "_place"]
    plain = (
        texts.withColumns({"_hash": F.xxhash64("text"), "_place": F.monotonically_increasing_id()})
        .repartitionByRange(*order)  # the place splits even copies of one row
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(blocks, BLOCKS)
    )
    plain = materialised(plain, "ids")

    def count(batches):
        seen = np.zeros(0, np.int64)
        for batch in batches:
            for body in batch.column(0).to_pylist():
                found = np.bincount(np.frombuffer(_spread(body), "<u4"), minlength=len(seen))
                found[: len(seen)] += seen
                seen = found
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(seen[used], pa.int64())], names=["id", "n"])

    counted = plain.select("coded").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    table = np.zeros(max([r["id"] for r in counted], default=-1) + 1, np.int64)
    for r in counted:
        table[r["id"]] = r["n"]
    freq = frequencies(table)
    spark.createDataFrame([(SCALE, freq.astype("<u4").tobytes())], "scale int, freq binary").coalesce(1).write.parquet(f"{path}/model")

    def code(batches):
        coder = Coder(freq)
        for batch in batches:
            for part, number, start, size, docs, crc, _, body in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                coded = coder.encode(np.frombuffer(_spread(body), "<u4"))
                yield _row(part, number, start, size, docs, crc, zlib.crc32(coded), coded)

    plain.mapInArrow(code, BLOCKS).write.parquet(f"{path}/blocks")


def _row(*values) -> pa.RecordBatch:
    names = ["part", "block", "start", "n_ids", "docs", "ids_crc", "coded_crc", "coded"]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _BLOCK_TYPES, strict=True)], names=names)


def _squeezed(raw: bytes) -> bytes:
    """Ids with their byte planes apart, compressed."""
    planes = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _spread(body: bytes) -> bytes:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).tobytes()


def read_encoded(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``doc_id, start, n_ids, ids`` decoded from the files; blocks are read side by side."""
    model = spark.read.parquet(f"{path}/model").first()
    if model["scale"] != SCALE:
        raise Corrupt("another table scale")
    freq = np.frombuffer(model["freq"], "<u4").astype(np.uint64)
    stored = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    parts = stored.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row for each file
    before = F.expr("coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0)")
    placed = stored.join(parts.select("part", before.alias("_before")), "part").select(
        (F.col("_before") + F.col("start")).alias("start"), "n_ids", "docs", "ids_crc", "coded_crc", "coded"
    )

    def decode(batches) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            for start, n, docs, ids_crc, coded_crc, coded in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if zlib.crc32(coded) != coded_crc:
                    raise Corrupt("coded bytes do not match their checksum")
                raw = coder.decode(coded).astype("<u4").tobytes()
                if zlib.crc32(raw) != ids_crc or len(raw) != 4 * n:
                    raise Corrupt("ids do not match their checksum")
                out, at = [], 0
                for d in docs:
                    out.append((d["doc_id"], start + at, d["n"], raw[4 * at : 4 * (at + d["n"])]))
                    at += d["n"]
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    names=["doc_id", "start", "n_ids", "ids"],
                )

    return placed.mapInArrow(decode, "doc_id long, start long, n_ids long, ids binary")

"""Token ids as binary files: canonical Huffman codes of limited length.

The counts of all ids give one code for the whole data set (package-merge finds the best code
whose words have at most ``LIMIT`` bits; canonical code words follow from the lengths alone, so
the lengths are all that is kept). Ids are written in ascending order of documents, in blocks
that are decoded on their own. A block has checkpoints: the bit offset of every 256th id. A
decoder reads ``LIMIT`` bits at a place, looks up id and length in one table, and moves on; the
runs between checkpoints are decoded side by side.

A block is, in little-endian order: the magic ``MWHB``, the number of documents, ids,
checkpoints and payload bytes (unsigned 32-bit each); per document its id (signed 64-bit), its
number of ids (unsigned 32-bit) and a byte that is one for a null id; the checkpoints (unsigned
64-bit); the payload; a zero byte. A file is a sequence of blocks; files in order of the numbers in
their names (``part-00012-...``) hold the documents in order.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millwright.llm.common import map_batches, texts_of
from millwright.llm.rawfiles import read_raw, write_raw
from millwright.llm.token_words import DROPPED_SPACE, encoder, in_slices, tokenizer_path
from millwright.sources.staging import stage

END_ID = 2
LIMIT = 16
CHECKPOINT_IDS = 256
BLOCK_IDS = 1 << 18
# Ids per file, so that a file can be read as one value.
FILE_IDS = 1 << 23
MAGIC = b"MWHB"
_HEAD = struct.Struct("<4sIIII")
SLICE_CHARS = 2_000_000


# --- the code -------------------------------------------------------------------------------


def code_lengths(counts: dict[int, int], limit: int = LIMIT) -> dict[int, int]:
    """Bits of each id's code word, at most ``limit``, with the least total (package-merge)."""
    ids = sorted(counts, key=lambda i: (counts[i], i))
    if len(ids) > 1 << limit:
        raise ValueError(f"{len(ids)} ids need code words of more than {limit} bits")
    if len(ids) <= 2:
        return dict.fromkeys(ids, 1)
    weights = np.array([counts[i] for i in ids], np.int64)
    # Per level, the order in which ids and packages of the level below come by weight.
    levels: list[np.ndarray] = []
    packages = np.zeros(0, np.int64)
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(order < len(ids))
        ranked = merged[order]
        pairs = len(ranked) // 2
        packages = ranked[: 2 * pairs].reshape(-1, 2).sum(1)
    lengths = np.zeros(len(ids), np.int64)
    take = 2 * len(ids) - 2
    for is_id in reversed(levels):
        own = int(is_id[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    return dict(zip(ids, lengths.tolist(), strict=True))


class Code:
    """Canonical code words by id, and the decoder's table."""

    def __init__(self, lengths: dict[int, int], limit: int = LIMIT):
        self.limit = limit
        size = max(lengths, default=0) + 1
        self.bits, self.words = np.zeros(size, np.int64), np.zeros(size, np.uint64)
        ordered = sorted(lengths, key=lambda i: (lengths[i], i))
        table_ids, fills, word, before = [], [], 0, 0
        for i in ordered:
            word <<= lengths[i] - before
            before = lengths[i]
            self.bits[i], self.words[i] = before, word
            table_ids.append(i)
            fills.append(1 << (limit - before))
            word += 1
        self.table = np.zeros(1 << limit, np.int64)
        self.table[: sum(fills)] = np.repeat(np.array(table_ids, np.int64), fills)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Payload and checkpoints of a run of ids; most significant bit first."""
        bits = self.bits[ids]
        ends = np.cumsum(bits)
        starts = ends - bits
        total = int(ends[-1]) if len(ends) else 0
        n_words = total // 32 + 2
        # A code word lies in at most two 32-bit words; sums of disjoint bits are exact.
        shifted = self.words[ids] << (64 - bits - (starts & 31)).astype(np.uint64)
        at = starts >> 5
        high = np.bincount(at, (shifted >> np.uint64(32)).astype(np.float64), n_words)
        low = np.bincount(at + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), n_words)
        packed = (high + low).astype(np.uint64).astype(">u4").tobytes()
        return packed[: -(-total // 8)], starts[::CHECKPOINT_IDS].astype("<u8")

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The ids again, all runs between checkpoints at once."""
        if not n:
            return np.zeros(0, np.int64)
        data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint64)
        out = np.zeros((len(checkpoints), CHECKPOINT_IDS), np.int64)
        at = checkpoints.astype(np.int64)
        last = n - (len(checkpoints) - 1) * CHECKPOINT_IDS
        # 32 bits from every byte on, so that a place needs one look.
        wide = (data[:-3] << np.uint64(24)) | (data[1:-2] << np.uint64(16))
        wide |= (data[2:-1] << np.uint64(8)) | data[3:]
        mask, shift = np.uint64((1 << self.limit) - 1), 32 - self.limit
        for k in range(CHECKPOINT_IDS if len(checkpoints) > 1 else last):
            if k == last:
                at = at[:-1]
            look = (wide[at >> 3] >> (shift - (at & 7)).astype(np.uint64)) & mask
            found = self.table[look]
            out[: len(at), k] = found
            at = at + self.bits[found]
        return out.reshape(-1)[:n]


# --- blocks ---------------------------------------------------------------------------------


def pack_block(docs: list[tuple[int | None, bytes]], code: Code) -> bytes:
    """A block of documents, given with their ids as unsigned 32-bit bytes."""
    ids = np.frombuffer(b"".join(d for _, d in docs), "<u4").astype(np.int64)
    payload, checkpoints = code.encode(ids)
    head = _HEAD.pack(MAGIC, len(docs), len(ids), len(checkpoints), len(payload))
    names = np.array([i or 0 for i, _ in docs], "<i8")
    sizes = np.array([len(d) // 4 for _, d in docs], "<u4")
    nulls = bytes(i is None for i, _ in docs)
    parts = [head, names.tobytes(), sizes.tobytes(), nulls, checkpoints.tobytes(), payload, b"\0"]
    return b"".join(parts)


def unpack_blocks(content: bytes, code: Code):
    """``(doc_id, ids)`` of every document of a file, in order."""
    at = 0
    while at < len(content):
        magic, n_docs, n_ids, n_marks, n_bytes = _HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no block at byte {at}")
        at += _HEAD.size
        names = np.frombuffer(content, "<i8", n_docs, at)
        sizes = np.frombuffer(content, "<u4", n_docs, at + 8 * n_docs)
        nulls = content[at + 12 * n_docs : at + 13 * n_docs]
        at += 13 * n_docs
        marks = np.frombuffer(content, "<u8", n_marks, at)
        at += 8 * n_marks
        ids = code.decode(content[at : at + n_bytes], marks, n_ids)
        at += n_bytes + 1
        ends = np.cumsum(sizes.astype(np.int64))
        listed = zip(names.tolist(), nulls, ends.tolist(), sizes.tolist(), strict=True)
        for name, null, end, size in listed:
            yield (None if null else name), ids[end - size : end]
    if at != len(content):
        raise ValueError("the last block is cut off")


# --- Spark ----------------------------------------------------------------------------------


def tokenized(documents: DataFrame, *, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """``doc_id, n_tokens, ids, counts``: ids as unsigned 32-bit bytes with the end id, compressed.

    Some rows have ``counts``: the ids of the rows up to the next such row, and how often each
    occurs, so that counting all ids need not read them.
    """

    def made(batches):
        words = encoder(tokenizer or tokenizer_path("word_bpe_49k.json"), DROPPED_SPACE)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for low, high in in_slices(texts, SLICE_CHARS):
                ids = [i + end for i in words.encode(texts[low:high])]
                counts = [_counted(b"".join(ids))] + [None] * (len(ids) - 1)
                # Half the bytes where the vocabulary allows it.
                narrow = [_narrow(i) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array(narrow, pa.binary()),
                        pa.array(counts[: len(ids)], pa.binary()),
                    ],
                    ["doc_id", "n_tokens", "ids", "counts"],
                )

    schema = "doc_id bigint, n_tokens bigint, ids binary, counts binary"
    return map_batches(documents, ["doc_id", "text"], made, schema)


def _counted(ids: bytes) -> bytes:
    """The ids that occur and how often: unsigned 32-bit, all ids first."""
    total = np.bincount(np.frombuffer(ids, "<u4"))
    used = np.flatnonzero(total)
    return np.concatenate([used, total[used]]).astype("<u4").tobytes()


def _narrow(ids: bytes) -> bytes:
    """A zero byte and 16-bit ids if all fit, else a one and the 32-bit ids."""
    wide = np.frombuffer(ids, "<u4")
    if wide.max(initial=0) < 1 << 16:
        return b"\0" + wide.astype("<u2").tobytes()
    return b"\1" + ids


def _wide(ids: bytes) -> bytes:
    return ids[1:] if ids[0] else np.frombuffer(ids, "<u2", -1, 1).astype("<u4").tobytes()


def id_counts(tokens: DataFrame) -> dict[int, int]:
    """How often each id occurs in the whole data set; at most one entry per vocabulary id.

    ``tokens`` must be whole, because a row's ids may be counted in another one.
    """

    def counted(batches):
        total = np.zeros(1, np.int64)
        for batch in batches:
            for packed in batch.column("counts").to_pylist():
                used, n = np.frombuffer(packed, "<u4").reshape(2, -1)
                if used.max(initial=0) >= len(total):
                    total = np.pad(total, (0, int(used.max()) + 1 - len(total)))
                total[used] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"]
        )

    known = tokens.filter("counts IS NOT NULL")
    partial = map_batches(known, ["counts"], counted, "id bigint, n bigint")
    rows = partial.groupBy("id").agg(F.sum("n").alias("n")).collect()
    return {r["id"]: r["n"] for r in rows}


def write_ids(tokens: DataFrame, folder: str, *, limit: int = LIMIT) -> dict[int, int]:
    """Write tokenized documents (staged) in ascending order; returns the code's lengths."""
    counts = id_counts(tokens)
    lengths = code_lengths(counts, limit)
    shared = tokens.sparkSession.sparkContext.broadcast(lengths)
    files = max(1, -(-sum(counts.values()) // FILE_IDS))

    def blocks(batches):
        code, held, n = Code(shared.value, limit), [], 0
        for batch in batches:
            columns = (batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist())
            for doc_id, ids in zip(*columns, strict=True):
                held.append((doc_id, _wide(ids)))
                n += len(held[-1][1]) // 4
                if n >= BLOCK_IDS:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([pack_block(held, code)], pa.binary())], ["block"]
                    )
                    held, n = [], 0
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([pack_block(held, code)], pa.binary())], ["block"]
            )

    order = ["doc_id", F.xxhash64("ids")]
    ordered = tokens.repartitionByRange(files, *order).sortWithinPartitions(*order)
    write_raw(map_batches(ordered, ["doc_id", "ids"], blocks, "block binary"), "block", folder)
    return lengths


def read_ids(spark: SparkSession, folder: str, lengths: dict[int, int], *, limit: int = LIMIT) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files.

    ``start`` is the number of ids of all documents before it.
    """
    shared = spark.sparkContext.broadcast(lengths)

    def decoded(batches):
        code = Code(shared.value, limit)
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                names, starts, sizes, sums, start = [], [], [], [], 0
                for name, ids in unpack_blocks(content.as_py(), code):
                    names.append(name)
                    starts.append(start)
                    sizes.append(len(ids))
                    sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path.as_py()] * len(names), pa.string()),
                        pa.array(names, pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["path", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    schema = "path string, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    files = read_raw(spark, folder)
    documents = stage(map_batches(files, ["path", "content"], decoded, schema))
    # One row per file: the number of ids in the files before it. Names are padded to five digits
    # only, so they are ordered by the number.
    number = F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("bigint")
    earlier = Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    sizes = documents.groupBy("path").agg(F.sum("n_tokens").alias("_ids"))
    bases = sizes.select("path", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_base"))
    return documents.join(bases, "path").select(
        "doc_id", (F.col("_base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )

"""Packing of tokenized documents into sequences of fixed length: best-fit decreasing.

Documents longer than a sequence are first cut into full windows, which need no search. What
remains of each document (less than a window) is placed in order of falling length into the
open window with the least room that still holds it. A segment tree over the remaining room
(one leaf per possible room, set if some open window has just that room) finds that window in
the time of the tree's height, whatever the number of open windows.

Every Spark partition packs the documents it reads, and closes the windows that are full but for
a few tokens. What lies in its other windows is packed once more together with that of other
partitions: pieces (not texts) are dealt out by window, adaptive execution makes few tasks of
little data, and every task takes its pieces in falling order of length, holding open windows
only. So padding does not depend on how finely the input is split.
"""

from __future__ import annotations

import zlib
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import map_batches, texts_of
from millwright.llm.token_words import LEADING_SPACE, encoder, in_slices, tokenizer_path
from millwright.sources.staging import stage

SEQUENCE_TOKENS = 1024
END_ID = 0
# Pieces that one group of windows is chosen from; about 100 bytes each are held meanwhile.
GROUP_PIECES = 200_000
SLICE_CHARS = 16_000_000
# Windows with at most this share of room left are closed by the partition that packs them.
CLOSED_ROOM = 1 / 128
# sequence_id keeps the partition above, the number of the sequence below this bit.
_PARTITION_BIT = 40
_SECOND_PASS = 1 << 62

PIECE_SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


class RoomTree:
    """Open windows by remaining room; finds the tightest one that holds a piece."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        node = self.leaves + room
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def _clear(self, room: int) -> None:
        node = self.leaves + room
        self.any[node] = 0
        while node > 1 and not self.any[node ^ 1]:
            node >>= 1
            self.any[node] = 0

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return ``(room, window)`` of the least room >= need, if there is one."""
        node = self.leaves + need
        if need >= len(self.windows):
            return None
        while not self.any[node]:
            while node & 1:  # a right child: nothing larger below this parent
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.leaves
        window = self.windows[room].pop()
        if not self.windows[room]:
            self._clear(room)
        return room, window


def best_fit(lengths: Iterable[int], capacity: int) -> Iterator[tuple[int, int]]:
    """``(window, offset)`` of each piece, placed in the given order."""
    tree, opened = RoomTree(capacity), 0
    for length in lengths:
        found = tree.take(length)
        room, window = found if found else (capacity, opened)
        opened += found is None
        yield window, capacity - room
        if room > length:
            tree.add(room - length, window)


def best_fit_decreasing(lengths: Iterable[int], capacity: int) -> list[tuple[int, int]]:
    """``(window, offset)`` of each piece; equal lengths are placed in the given order."""
    lengths = list(lengths)
    order = sorted(range(len(lengths)), key=lambda k: -lengths[k])
    places: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i, place in zip(order, best_fit([lengths[i] for i in order], capacity), strict=True):
        places[i] = place
    return places


def _pack_again(pieces: DataFrame, sequence_tokens: int) -> DataFrame:
    """Pack the pieces of windows that stayed open, those of many partitions together."""
    columns = pieces.columns

    def packed(batches):
        context = TaskContext.get()
        first = _SECOND_PASS | (context.partitionId() if context else 0) << _PARTITION_BIT
        taken = deque()

        def lengths():
            for batch in batches:
                taken.append(batch)
                yield from batch.column("length").to_pylist()

        places = best_fit(lengths(), sequence_tokens)
        while ahead := next(places, None):
            batch = taken.popleft()
            own = [ahead, *islice(places, batch.num_rows - 1)]
            windows = pa.array([first + w for w, _ in own], pa.int64())
            offsets = pa.array([o for _, o in own], pa.int64())
            arrays = {n: batch.column(n) for n in columns}
            arrays |= {"sequence_id": windows, "offset": offsets}
            yield pa.RecordBatch.from_arrays(list(arrays.values()), columns)

    falling = [F.desc("length"), "doc_id", "start", "ids_crc32"]
    dealt = pieces.repartition("sequence_id").sortWithinPartitions(*falling)
    return map_batches(dealt, columns, packed, pieces.schema.simpleString()[7:-1])


def pack(
    documents: DataFrame,
    *,
    tokenizer: str | None = None,
    sequence_tokens: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = False,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece of a document, with its place in a sequence.

    ``tokenizer`` is the path of a byte-level tokenizer file. Null and empty texts are one end
    id. With ``with_ids`` the ids of the piece follow (unsigned 32-bit, little-endian). Rows
    with equal or null ``doc_id`` are documents of their own; an empty table gives no rows. The
    pieces of the first pass are staged, so that texts are tokenized once.
    """
    closed_at = sequence_tokens - int(sequence_tokens * CLOSED_ROOM)

    def packed(batches):
        words = encoder(tokenizer or tokenizer_path("byte_bpe_50k.json"), LEADING_SPACE)
        end = end_id.to_bytes(4, "little")
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << _PARTITION_BIT
        whole: list[tuple] = []
        rest: list[tuple] = []

        def flushed():
            nonlocal sequence
            rows = []
            for piece in whole:
                rows.append((*piece, sequence, 0, False))
                sequence += 1
            places = best_fit_decreasing([p[2] for p in rest], sequence_tokens)
            used = Counter()
            for piece, (window, _) in zip(rest, places, strict=True):
                used[window] += piece[2]
            rows += [
                (*p, sequence + w, o, used[w] < closed_at)
                for p, (w, o) in zip(rest, places, strict=True)
            ]
            sequence += 1 + max((w for w, _ in places), default=-1)
            whole.clear()
            rest.clear()
            for i in range(0, len(rows), 10_000):
                yield as_batch(rows[i : i + 10_000])

        def as_batch(rows):
            columns = list(zip(*rows, strict=True))
            ids, still_open = columns.pop(5), columns.pop()
            arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array(still_open)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            names.append("open")
            if with_ids:
                arrays.append(pa.array(ids, pa.binary()))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            ids_of, texts = batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))
            for low, high in in_slices(texts, SLICE_CHARS):
                for doc, encoded in zip(ids_of[low:high], words.encode(texts[low:high]), strict=True):
                    encoded += end
                    n = len(encoded) // 4
                    for start in range(0, n, sequence_tokens):
                        own = encoded[4 * start : 4 * (start + sequence_tokens)]
                        length = len(own) // 4
                        piece = (doc, start, length, zlib.crc32(own), n, own if with_ids else None)
                        (whole if length == sequence_tokens else rest).append(piece)
                if len(whole) + len(rest) >= group_pieces:
                    yield from flushed()
        if whole or rest:
            yield from flushed()

    schema = PIECE_SCHEMA + ", open boolean" + (", ids binary" if with_ids else "")
    pieces = stage(map_batches(documents, ["doc_id", "text"], packed, schema))
    again = _pack_again(pieces.filter("open").drop("open"), sequence_tokens)
    return pieces.filter("NOT open").drop("open").unionByName(again)


def sequence_lengths(pieces: DataFrame, *, sequence_tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """Used and padding tokens of every sequence; none are added at a power of two."""
    used = F.sum("length").alias("used")
    padded = F.when(F.expr("bit_count(used)") == 1, F.col("used")).otherwise(sequence_tokens)
    return (
        pieces.groupBy("sequence_id")
        .agg(used, F.count(F.lit(1)).alias("pieces"))
        .withColumn("padding", padded - F.col("used"))
    )

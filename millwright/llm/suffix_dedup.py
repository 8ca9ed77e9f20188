"""Exact removal of long repeats, by parsing the texts with rolling-hash triggers.

A repeat is a string of ``length`` (200) bytes that starts at two or more places of the corpus,
within documents. What any such string covers is removed, every occurrence included.

* **Phrases.** A rolling hash runs over all strings of ``TRIGGER_BYTES``. The trigger of a
  start is the least hash among those inside its 200 bytes, so it depends on these bytes alone,
  and equal strings have equal triggers at equal distance. Neighbouring starts mostly share
  their trigger; a maximal run of them is a phrase, some 70 starts on average. All that the
  starts of a phrase can see lies in its *context*, the bytes around the trigger.
* **Parse.** Each block of documents lists its distinct (trigger, context) pairs, which are the
  dictionary. A trigger that occurs once in the corpus has no repeats. If all occurrences of a
  repeated trigger have one context, or if a context occurs twice, all its starts are repeats.
  In repetitive text this settles nearly all starts without looking at single strings.
* **Dictionary suffixes.** What is left are contexts that occur once, of triggers with several
  contexts: the edges of repeats. Each of these contexts, and one copy of each repeated
  context that shares the trigger, goes through its starts: the suffixes of the block's
  dictionary are sorted by their first 200 bytes (a suffix array to that depth), equal
  neighbours fall together, and one entry per class is compared with other blocks.

Both comparisons shuffle one row per distinct value and block, so a value that a third of all
documents hold costs one row per block. Documents are grouped into blocks of two megabytes as
they are read; blocks are written once, bucketed by their number, and later passes join answers
to them without shuffling texts. Longer documents are gone through in windows.

Values are compared by 64-bit hashes (trigger and context together by 126 bits).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from millwright.llm.common import ByteHashes, map_batches, utf8
from millwright.sources.staging import scratch_table, stage

LENGTH = 200
TRIGGER_BYTES = 56
BLOCK_BYTES = 2_000_000
# Spark allows up to 100,000 buckets; beyond, a bucket just holds more blocks.
MAX_BUCKETS = 50_000
# Starts looked at together; must stay below 2**24 with its margins.
WINDOW_STARTS = 250_000
_POSITION_BITS = 24
_LOW = np.uint64((1 << _POSITION_BITS) - 1)
_CODE = np.uint64(3)
_DUPLICATE, _DUPLICATE_AND_TELLS, _OPEN = 1, 2, 3


# --- one block ------------------------------------------------------------------------------


class Phrases:
    """Phrases of a stretch of starts: trigger and context hashes, first and last start."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, low: int, high: int, length: int):
        """``ends`` are where documents end in ``data``; phrases that begin in [low, high)."""
        span = length - TRIGGER_BYTES + 1  # triggers inside a string
        self.length = length
        self.base = base = max(0, low - 2 * length)
        top = min(len(data), high + 4 * length)
        own = data[base:top]
        self.hashes = ByteHashes(own)
        none = np.zeros(0, np.int64)
        self.first, self.last, self.trigger, self.context = none, none, none, none
        if len(own) < length:
            return
        grams = self.hashes.rolling(TRIGGER_BYTES)
        # The position takes the low bits: of equal hashes the rightmost is the least.
        places = _LOW - np.arange(len(grams), dtype=np.uint64)
        keys = ((grams >> np.uint64(_POSITION_BITS)) << np.uint64(_POSITION_BITS)) | places
        rows = -(-len(keys) // span)
        grid = np.full(rows * span, np.iinfo(np.uint64).max, np.uint64)
        grid[: len(keys)] = keys
        grid = grid.reshape(rows, span)
        onward = np.minimum.accumulate(grid, axis=1).ravel()
        back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        n_starts = len(own) - length + 1
        least = np.minimum(back[:n_starts], onward[span - 1 : span - 1 + n_starts])
        triggers = (_LOW - (least & _LOW)).astype(np.int64)
        # A start counts if its document goes on for the whole length.
        inside = np.ones(n_starts, bool)
        for end in ends[(ends > base) & (ends < base + n_starts + length)].tolist():
            inside[max(0, end - base - length + 1) : max(0, end - base)] = False
        starts = np.flatnonzero(inside)
        if not len(starts):
            return
        own_trigger = triggers[starts]
        fresh = np.r_[True, (own_trigger[1:] != own_trigger[:-1]) | (np.diff(starts) != 1)]
        at = np.flatnonzero(fresh)
        first, last = starts[at], starts[np.r_[at[1:], len(starts)] - 1]
        keep = (first + base >= low) & (first + base < high)
        first, last, place = first[keep], last[keep], own_trigger[at[keep]]
        # Context: from the farthest start that can have this trigger to the end of the last
        # string, within the document; how much is missing on the left is part of it.
        document = np.searchsorted(ends, place + base, "right")
        begins = np.r_[0, ends][document] - base
        left = np.maximum(np.maximum(begins, place - span + 1), 0)
        right = np.minimum(np.minimum(ends[document] - base, place + length), len(own))
        context = self.hashes.of(left, right) + (place - left).astype(np.uint64) * np.uint64(
            0xC2B2AE3D27D4EB4F
        )
        self.first, self.last = first + base, last + base
        self.trigger = grams[place]
        self.context = context & ~_CODE

    def starts_of(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All starts of the chosen phrases, and the hashes of their strings."""
        first, last = self.first[chosen], self.last[chosen]
        sizes = last - first + 1
        offsets = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        starts = np.repeat(first, sizes) + offsets
        own = starts - self.base
        return starts, self.hashes.of(own, own + self.length)


def windows(data: np.ndarray, ends: np.ndarray, length: int) -> Iterator[Phrases]:
    for low in range(0, len(data), WINDOW_STARTS):
        yield Phrases(data, ends, low, min(len(data), low + WINDOW_STARTS), length)


def order_and_ties(
    data: np.ndarray, starts: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """:func:`dictionary_order`, and whether each entry's bytes equal those of the one before.

    Sorts by eight bytes at a time, as big-endian numbers; only ties are looked at further.
    """
    order = np.arange(len(starts))
    equal = np.zeros(len(starts), bool)
    padded = np.r_[data, np.zeros(8, np.uint8)]
    wide = np.ndarray((len(data) + 1,), ">u8", padded, strides=(1,))
    # Places of ``order`` that hold tied starts, and the tie of each; ties lie side by side.
    places, tie = order.copy(), np.zeros(len(starts), np.int64)
    for depth in range(0, length, 8):
        if not len(places):
            break
        tied = order[places]
        word = wide[starts[tied] + depth].astype(np.uint64)
        word >>= np.uint64(8 * max(0, depth + 8 - length))
        ranked = np.argsort(word, kind="stable") if not depth else np.lexsort((word, tie))
        order[places], word = tied[ranked], word[ranked]
        same = np.r_[False, (word[1:] == word[:-1]) & (tie[1:] == tie[:-1])]
        equal[places] = same
        still = same | np.r_[same[1:], False]
        places, tie = places[still], np.cumsum(~same)[still]
    return order, equal


def dictionary_order(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The starts in the order of the ``length`` bytes that follow each of them."""
    return order_and_ties(data, starts, length)[0]


def classes(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """One start of each class of equal strings, and the size of the class.

    Neighbours in the dictionary's suffix order fall together if they agree to full depth.
    """
    if not len(starts):
        return starts, starts
    order, equal = order_and_ties(data, starts, length)
    at = np.flatnonzero(~equal)
    return starts[order[at]], np.diff(np.r_[at, len(order)])


# --- blocks in Spark ------------------------------------------------------------------------


def write_blocks(
    documents: DataFrame, *, block_bytes: int = BLOCK_BYTES, carry: Sequence[str] = ()
) -> DataFrame:
    """Documents grouped as they are read: ``block, doc_ids, sizes, data``, bucketed by block.

    A table of its own in the shared folder; a document is never split. The columns of ``carry``
    are kept beside the ids, as ``carried``.
    """
    carry = list(carry)
    fields = documents.select(*carry).schema
    spark = documents.sparkSession
    parts = max(1, documents.select("doc_id").rdd.getNumPartitions())

    def blocks(batches):
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 24
        ids, texts, more, held = [], [], [], 0
        struct = pa.struct(list(to_arrow_schema(fields)))

        def closed():
            row = [number], [ids], [[len(t) for t in texts]], [b"".join(texts)], [more]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            kinds.append(pa.list_(struct))
            names = ["block", "doc_ids", "sizes", "data", "carried"][: 5 if carry else 4]
            arrays = [pa.array(v, k) for v, k, _ in zip(row, kinds, names)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            columns = [batch.column("doc_id").to_pylist(), batch.column("text")]
            carried = batch.select(carry).to_pylist() if carry else [None] * batch.num_rows
            for doc_id, text, extra in zip(*columns, carried, strict=True):
                raw = utf8(text.as_py() or "")
                if ids and held + len(raw) > block_bytes:
                    yield closed()
                    number, ids, texts, more, held = number + 1, [], [], [], 0
                ids.append(doc_id)
                texts.append(raw)
                more.append(extra)
                held += len(raw)
        if ids:
            yield closed()

    schema = "block bigint, doc_ids array<bigint>, sizes array<bigint>, data binary"
    if carry:
        schema += f", carried array<{fields.simpleString()}>"
    made = map_batches(documents, ["doc_id", "text", *carry], blocks, schema)
    name, folder = scratch_table(spark, "text_blocks")
    writer = made.write.bucketBy(min(parts, MAX_BUCKETS), "block").format("parquet")
    writer.options(compression="zstd", path=folder).saveAsTable(name)
    return spark.table(name)


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    columns = batch.column("block"), batch.column("sizes"), batch.column("data")
    for block, sizes, data in zip(*columns, strict=True):
        ends = np.cumsum(np.array(sizes.as_py(), np.int64))
        yield block.as_py(), ends, np.frombuffer(data.as_buffer(), np.uint8)


def _hash_rows(block: int, names: list[str], columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    n = len(columns[0])
    for low in range(0, n, 100_000):
        own = [pa.array(c[low : low + 100_000]) for c in columns]
        numbers = pa.array(np.full(len(own[0]), block, np.int64))
        yield pa.RecordBatch.from_arrays([numbers, *own], ["block", *names])


def dictionary(blocks: DataFrame, length: int = LENGTH) -> DataFrame:
    """Distinct phrases of every block: ``block, trigger, context, again`` (twice in the block)."""

    def listed(batches):
        for batch in batches:
            for block, ends, data in _opened(batch):
                found = [(p.trigger, p.context) for p in windows(data, ends, length)]
                if not found:
                    continue
                trigger, context = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.lexsort((context, trigger))
                trigger, context = trigger[order], context[order]
                fresh = np.ones(len(order), bool)
                fresh[1:] = (trigger[1:] != trigger[:-1]) | (context[1:] != context[:-1])
                at = np.flatnonzero(fresh)
                again = np.diff(np.r_[at, len(order)]) > 1
                columns = [trigger[at].view(np.int64), context[at].view(np.int64), again]
                yield from _hash_rows(block, ["trigger", "context", "again"], columns)

    schema = "block bigint, trigger bigint, context bigint, again boolean"
    return map_batches(blocks, ["block", "sizes", "data"], listed, schema)


def _packed(rows: DataFrame, value: str) -> DataFrame:
    """The values of each block as sorted 64-bit numbers in one binary: ``block, <value>``."""

    def packed(batches):
        block, held = None, []

        def closed():
            values = np.sort(np.concatenate(held))
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([values.tobytes()], pa.binary())],
                ["block", value],
            )

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            values = batch.column(value).to_numpy()
            cuts = np.r_[0, np.flatnonzero(np.diff(blocks)) + 1, len(blocks)]
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if low == high:
                    continue
                if held and blocks[low] != block:
                    yield closed()
                    held = []
                block = int(blocks[low])
                held.append(values[low:high])
        if held:
            yield closed()

    own = rows.select("block", value).repartition("block").sortWithinPartitions("block")
    return map_batches(own, ["block", value], packed, f"block bigint, {value} binary")


def _unpacked(packed: pa.Scalar) -> np.ndarray:
    raw = packed.as_py()
    return np.frombuffer(raw, np.int64) if raw else np.zeros(0, np.int64)


def settle_phrases(phrases: DataFrame) -> DataFrame:
    """``block, answers``: what is known of the repeated phrases of each block.

    An answer is the context with a code in its two lowest bits.
    """
    seen = phrases.groupBy("trigger").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("again").alias("twice"),
        (F.min("context") != F.max("context")).alias("several"),
    )
    repeated = seen.filter("n > 1 OR twice").select("trigger", "several")
    own = phrases.join(repeated, "trigger")
    # Rows of a context are at most the blocks.
    same = Window.partitionBy("trigger", "context")
    copies = (F.count(F.lit(1)).over(same) > 1) | F.max("again").over(same)
    tells = F.min("block").over(same) == F.col("block")
    code = (
        F.when(~F.col("several"), _DUPLICATE)
        .when(~copies, _OPEN)
        .when(tells, _DUPLICATE_AND_TELLS)
        .otherwise(_DUPLICATE)
    )
    return _packed(own.withColumn("answers", F.col("context").bitwiseOR(code.cast("bigint"))), "answers")


def _codes(contexts: np.ndarray, answers: np.ndarray) -> np.ndarray:
    """The code of each context, 0 if there is no answer; answers are sorted."""
    if not len(answers):
        return np.zeros(len(contexts), np.int64)
    signed = contexts.view(np.int64)
    at = np.minimum(np.searchsorted(answers, signed), len(answers) - 1)
    return np.where((answers[at] & ~3) == signed, answers[at] & 3, 0)


def open_strings(blocks: DataFrame, length: int = LENGTH) -> DataFrame:
    """Classes of strings to be compared between blocks: ``block, string, again``."""

    def listed(batches):
        for batch in batches:
            packed = batch.column("answers")
            for (block, ends, data), own in zip(_opened(batch), packed, strict=True):
                answers = _unpacked(own)
                starts = []
                told = np.zeros(0, np.uint64)
                for p in windows(data, ends, length):
                    codes = _codes(p.context, answers)
                    chosen = np.flatnonzero((codes == _OPEN) | (codes == _DUPLICATE_AND_TELLS))
                    # A repeated context is gone through once.
                    _, once = np.unique(p.context[chosen], return_index=True)
                    once = chosen[np.sort(once)]
                    once = once[~np.isin(p.context[once], told)]
                    told = np.union1d(told, p.context[once])
                    starts.append(p.starts_of(once)[0])
                if not starts:
                    continue
                first, sizes = classes(data, np.concatenate(starts), length)
                hashes = np.zeros(len(first), np.int64)
                for low in range(0, len(data), WINDOW_STARTS):
                    here = np.flatnonzero((first >= low) & (first < low + WINDOW_STARTS))
                    if len(here):
                        hashed = ByteHashes(data[low : low + WINDOW_STARTS + length])
                        at = first[here] - low
                        hashes[here] = hashed.of(at, at + length).view(np.int64)
                yield from _hash_rows(block, ["string", "again"], [hashes, sizes > 1])

    schema = "block bigint, string bigint, again boolean"
    return map_batches(blocks, ["block", "sizes", "data", "answers"], listed, schema)


def settle_strings(strings: DataFrame) -> DataFrame:
    """``block, repeats``: the strings of each block that occur at two or more places."""
    same = Window.partitionBy("string")
    copies = (F.count(F.lit(1)).over(same) > 1) | F.max("again").over(same)
    found = strings.withColumn("copies", copies).filter("copies")
    return _packed(found.withColumnRenamed("string", "repeats"), "repeats")


def covered(
    data: np.ndarray, ends: np.ndarray, answers: np.ndarray, repeats: np.ndarray, length: int
) -> np.ndarray:
    """Whether each byte is covered by a repeat."""
    edges = np.zeros(len(data) + 1, np.int32)
    for p in windows(data, ends, length):
        codes = _codes(p.context, answers)
        whole = (codes == _DUPLICATE) | (codes == _DUPLICATE_AND_TELLS)
        np.add.at(edges, p.first[whole], 1)
        np.add.at(edges, p.last[whole] + length, -1)
        starts, hashes = p.starts_of(np.flatnonzero(codes == _OPEN))
        if len(starts) and len(repeats):
            signed = hashes.view(np.int64)
            at = np.minimum(np.searchsorted(repeats, signed), len(repeats) - 1)
            hit = starts[repeats[at] == signed]
            np.add.at(edges, hit, 1)
            np.add.at(edges, hit + length, -1)
    return np.cumsum(edges[:-1]) > 0


def _spans(cover: np.ndarray) -> list[tuple[int, int]]:
    steps = np.diff(np.r_[0, cover.astype(np.int8), 0])
    return list(zip(np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist()))


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the spans; characters that a span covers in part stay."""
    kept, at = [], 0
    for start, end in spans:
        while start < end and start < len(raw) and raw[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        kept.append(raw[at:start])
        at = end
    kept.append(raw[at:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


def remove_repeats(
    documents: DataFrame,
    *,
    length: int = LENGTH,
    block_bytes: int = BLOCK_BYTES,
    with_text: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, one row per document.

    Null text is empty. Repeated rows are documents of their own, so their long texts are
    repeats. With ``with_text`` also ``spans`` (start and end in bytes) and ``kept_text``: the
    remaining text, where characters that a span's edge cuts through are kept whole. The columns
    named by ``carry`` follow, in a struct ``carried``.
    """
    if length <= TRIGGER_BYTES:
        raise ValueError(f"repeats must be longer than {TRIGGER_BYTES} bytes")
    blocks = write_blocks(documents, block_bytes=block_bytes, carry=carry)
    phrases = stage(dictionary(blocks, length))
    answers = stage(settle_phrases(phrases))
    asked = blocks.join(answers.hint("shuffle_hash"), "block")
    repeats = settle_strings(open_strings(asked, length))
    # Staged, so that the join below has no other partitioning than that of the blocks.
    known = stage(answers.join(repeats, "block", "left"))
    told = blocks.join(known.hint("shuffle_hash"), "block", "left")

    def cut(batches):
        for batch in batches:
            more = batch.column("answers"), batch.column("repeats"), batch.column("doc_ids")
            for row_number, ((_, ends, data), own, found, ids) in enumerate(
                zip(_opened(batch), *more, strict=True)
            ):
                cover = covered(data, ends, _unpacked(own), _unpacked(found), length)
                rows = [[] for _ in range(7)]
                begin = 0
                for doc_id, end in zip(ids.as_py(), ends.tolist(), strict=True):
                    mine, raw = cover[begin:end], data[begin:end]
                    spans = _spans(mine) if mine.any() else []
                    kept = raw[~mine].tobytes() if spans else raw.tobytes()
                    row = (doc_id, end - begin, end - begin - len(kept), len(spans))
                    row += (hashlib.sha256(kept).hexdigest(),)
                    if with_text:
                        text = whole_characters(raw.tobytes(), spans)
                        row += ([{"start": s, "end": e} for s, e in spans], text)
                    for column, value in zip(rows, row):
                        column.append(value)
                    begin = end
                kinds = [pa.int64()] * 4 + [pa.string()]
                rows = rows[: len(names) - bool(carry)]
                if with_text:
                    pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
                    kinds += [pa.list_(pair), pa.string()]
                arrays = [pa.array(c, k) for c, k in zip(rows, kinds)]
                if carry:
                    arrays.append(batch.column("carried")[row_number].values)
                yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    if with_text:
        names += ["spans", "kept_text"]
        schema += ", spans array<struct<start: bigint, end: bigint>>, kept_text string"
    columns = ["block", "doc_ids", "sizes", "data", "answers", "repeats"]
    if carry:
        names.append("carried")
        columns.append("carried")
        schema += f", carried {documents.select(*carry).schema.simpleString()}"
    return map_batches(told, columns, cut, schema)

"""Byte-level BPE of whole texts, long ones in overlapping chunks on many tasks, and decoding.

A text longer than a chunk is cut into chunks that overlap. The chunks are dealt out and each is
split into pre-tokens on its own, from its first character on, which may lie inside a pre-token. In
the overlap of two chunks the later one falls into step with the earlier one: there the pre-tokens
of both begin at a common place, a *seam*, where the text is cut for good. The pieces between the
seams are dealt out again and encoded, and the ids of a text are those of its pieces in order. Where
an overlap has no seam (a word longer than it), the pieces on both sides stay one. Text between two
seams is tokenized as it would be inside the whole text, because a pre-token depends on nothing
before it and a seam lies only between a word and the white space after it, which the pattern never
joins. A text of one chunk is one piece.

Copies of a long text are encoded once: chunks are known by the digest of their text, and the ids
are joined back to the rows, whose number per digest does not matter (adaptive execution splits a
digest with many rows).

Decoding joins the bytes of the ids; it needs no text and no seams.

A null text is empty and has no ids. Special strings inside a text are ordinary text. Repeated and
null ids, equal rows and further columns change nothing; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.common import Batches, map_batches, sliced, texts_of
from millwright.llm.token_words import tokenizer_path

RANKS = "byte_bpe_multi_50k.tiktoken"
# Characters a chunk starts after the one before it, and by which it reaches into the next one.
CHUNK = 1 << 16
OVERLAP = 1 << 10


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@cache
def _encoding(path: str):
    """The library's encoder for a file of ranks, made once per worker."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(path), special_tokens={}
    )


@cache
def _pattern():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


@cache
def _white_space() -> frozenset[str]:
    """The characters that the pattern takes for white space."""
    import regex

    return frozenset(regex.findall(r"\s", "".join(map(chr, range(0x3001)))))


@cache
def _bytes_of(path: str) -> list[bytes]:
    """Bytes by id; ids the file leaves out have none."""
    ranks = _ranks(path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for raw, number in ranks.items():
        table[number] = raw
    return table


def _encode_texts(path: str):
    """Ids of the texts in the last column, in its place; the other columns stay."""

    def encode(batches: Batches) -> Batches:
        encoding = _encoding(path)
        for batch in sliced(batches):
            ids = [
                np.asarray(encoding.encode_ordinary(t), "<u4").tobytes()
                for t in texts_of(batch.column(batch.num_columns - 1))
            ]
            others = [batch.column(i) for i in range(batch.num_columns - 1)]
            names = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*others, pa.array(ids, pa.binary())], [*names, "ids"])

    return encode


def _cut(chunk: int, overlap: int):
    """Overlapping chunks of the texts ``(digest, text)``."""

    def cut(batches: Batches) -> Batches:
        for batch in sliced(batches, 1):
            text = batch.column(1)[0].as_py()
            starts = range(0, len(text), chunk)
            columns = [
                pa.array([batch.column(0)[0].as_py()] * len(starts), pa.binary()),
                pa.array(range(len(starts)), pa.int64()),
                pa.array([text[s : s + chunk + overlap] for s in starts], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "n", "text"])

    return cut


def seams(text: str, low: int, high: int) -> list[int]:
    """Where a pre-token of white space begins after a word, from ``low`` up to ``high``.

    The text is split from its first character on, so the first pre-token may begin too late.
    """
    found, space = [], _white_space()
    for match in _pattern().finditer(text):
        at = match.start()
        if at >= high:
            break
        if at >= max(low, 1) and text[at] in space and text[at - 1] not in space:
            found.append(at)
    return found


def _split_chunks(chunk: int, overlap: int):
    """Seams of each chunk in the overlaps at its head and tail, counted from the overlap's start."""

    def split(batches: Batches) -> Batches:
        for batch in sliced(batches, 16):
            texts = texts_of(batch.column(2))
            head = [seams(t, 0, overlap) for t in texts]
            tail = [[s - chunk for s in seams(t, chunk, chunk + overlap)] for t in texts]
            places = [pa.array(x, pa.list_(pa.int32())) for x in (head, tail)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *places], ["digest", "n", "text", "head", "tail"]
            )

    return split


def pieces_of_long_texts(texts: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``digest``, ``piece`` (ascending) and ``text`` of the pieces of distinct long texts."""
    chunks = map_batches(texts, ["digest", "text"], _cut(chunk, overlap), "digest binary, n bigint, text string")
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.repartition(partitions, "digest", "n").dropDuplicates(["digest", "n"])
    split = map_batches(
        dealt,
        ["digest", "n", "text"],
        _split_chunks(chunk, overlap),
        "digest binary, n bigint, text string, head array<int>, tail array<int>",
    )
    # The chunks of one text are one window: together they are no longer than the row was.
    in_text = Window.partitionBy("digest").orderBy("n")
    before = F.lag("tail").over(in_text)
    seam = F.when(F.col("n") == 0, 0).otherwise(F.array_min(F.array_intersect(before, F.col("head"))))
    cut = split.withColumn("seam", seam)
    last = F.lead("n").over(in_text).isNull()
    end = F.when(last, F.length("text")).otherwise(F.lit(chunk) + F.coalesce(F.lead("seam").over(in_text), F.lit(0)))
    piece = F.count("seam").over(in_text)
    own = F.coalesce("seam", F.lit(0))
    parts = cut.select(
        "digest", "n", piece.alias("piece"), F.substring("text", own + 1, end - own).alias("part")
    )
    joined = F.array_sort(F.collect_list(F.struct("n", "part")))
    return parts.groupBy("digest", "piece").agg(joined.alias("parts")).select(
        "digest", "piece", F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("text")
    )


def _joined(rows: Batches) -> Batches:
    """Ids of each text from those of its pieces, which come one after the other, in order."""
    digest, held = None, []

    def whole():
        return pa.RecordBatch.from_arrays(
            [pa.array([digest], pa.binary()), pa.array([b"".join(held)], pa.binary())], ["digest", "ids"]
        )

    for batch in rows:
        for own, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if own != digest:
                if digest is not None:
                    yield whole()
                digest, held = own, []
            held.append(ids)
    if digest is not None:
        yield whole()


def encode(docs: DataFrame, *, ranks: str = RANKS, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id`` and ``ids`` of every text: unsigned 32-bit numbers, little-endian."""
    path = tokenizer_path(ranks)
    length = F.coalesce(F.length("text"), F.lit(0))
    short = map_batches(
        docs.filter(length <= chunk), ["doc_id", "text"], _encode_texts(path), "doc_id bigint, ids binary"
    )
    long = docs.filter(length > chunk).select(
        "doc_id", F.unhex(F.sha2(F.col("text"), 256)).alias("digest"), "text"
    )
    pieces = pieces_of_long_texts(long, chunk, overlap)
    encoded = map_batches(
        pieces, ["digest", "piece", "text"], _encode_texts(path), "digest binary, piece bigint, ids binary"
    )
    ordered = encoded.repartition("digest").sortWithinPartitions("digest", "piece")
    whole = map_batches(ordered, ["digest", "ids"], _joined, "digest binary, ids binary")
    return short.unionByName(long.select("doc_id", "digest").join(whole, "digest").select("doc_id", "ids"))


def decode(encoded: DataFrame, *, ranks: str = RANKS) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded``: the bytes of the ids, one after the other."""
    path = tokenizer_path(ranks)

    def joined(batches: Batches) -> Batches:
        table = _bytes_of(path)
        for batch in sliced(batches):
            decoded = [
                b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist()))
                for ids in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"]
            )

    return map_batches(encoded, ["doc_id", "ids"], joined, "doc_id bigint, ids binary, decoded binary")

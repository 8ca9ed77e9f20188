"""Benchmark items inside documents: size-partitioned MinHash containment search.

An item is contained in a document if the document has at least ``threshold`` of the item's
distinct five-word shingles; one of fewer words, if the document has all of them in a row. Items are partitioned by their number of shingles (doubling
sizes). The MinHash sketch of an item is its shingles of least hash, as many as its partition
needs: a document that holds the share ``t`` of ``n`` shingles misses at most ``n - ceil(t n)``
of them, so among one more than that at least one is found. The sketch size is set for the
largest size of the partition, so no contained item is missed, however long the document; no
signature of the document is needed, which for a short item in a long document would say
nothing. Documents that meet a sketch are candidates, and are verified by counting the item's
shingles among their own, as text.

The items are the stated query set: they are sent to all executors in blocks of bounded size,
one pass over the documents per block. Documents are never shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import ByteHashes, map_batches, sliced, texts_of, utf8

SHINGLE_WORDS = 5
THRESHOLD = 0.8
# Bytes of item texts that one pass searches for.
BLOCK_BYTES = 8_000_000
_WORDS = re.compile(r"[^\W_]+")
# Thai, Lao, Myanmar, Khmer, kana and Han.
_UNSPACED = (
    "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf"
    "\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
_ANY_UNSPACED = re.compile(f"[{_UNSPACED}]")
_WORDS_AND_CHARACTERS = re.compile(rf"(?![{_UNSPACED}])[^\W_](?:(?![{_UNSPACED}])[^\W_])*|[^\W_]")
_SLICE_CHARS = 2_000_000


def words_of(text: str, by_character: bool = False) -> list[str]:
    """Runs of letters and digits, in lower case; characters of unspaced scripts one by one if asked."""
    text = text.lower()
    if by_character and _ANY_UNSPACED.search(text):
        return _WORDS_AND_CHARACTERS.findall(text)
    return _WORDS.findall(text)


def shingle_bounds(words: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the shingles start and end in the words joined by single spaces."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    if len(words) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return (ends - lengths)[: len(words) - size + 1], ends[size - 1 :]


def shingles_of(text: str, size: int, by_character: bool = False) -> list[bytes]:
    """Distinct shingles in order of first appearance."""
    words = [utf8(w) for w in words_of(text, by_character)]
    joined = b" ".join(words)
    starts, ends = shingle_bounds(words, size)
    return list(dict.fromkeys(joined[s:e] for s, e in zip(starts.tolist(), ends.tolist())))


def partition_of(n_shingles: int) -> int:
    """Items of 1, 2-3, 4-7, 8-15, ... shingles."""
    return n_shingles.bit_length() - 1


def sketch_size(partition: int, threshold: float) -> int:
    """Least hashes to keep so that every contained item of the partition is met.

    The number a single item needs does not fall as items grow, so that of the largest item
    serves the whole partition.
    """
    largest = (2 << partition) - 1
    return largest - math.ceil(threshold * largest - 1e-9) + 1


class Sketches:
    """The sketches of a block of items, by shingle hash."""

    def __init__(
        self, items: list[tuple[int, str]], size: int, threshold: float, by_character: bool = False
    ):
        self.size, self.threshold, self.by_character = size, threshold, by_character
        self.items = []
        holders: dict[int, list[int]] = {}
        for item_id, text in items:
            shingles = shingles_of(text, size, by_character)
            if not shingles:
                continue
            data = np.frombuffer(b"".join(shingles), np.uint8)
            ends = np.cumsum([len(s) for s in shingles])
            hashes = ByteHashes(data).of(np.r_[0, ends[:-1]], ends)
            keep = sketch_size(partition_of(len(shingles)), threshold)
            for h in np.sort(hashes)[:keep].tolist():
                holders.setdefault(h, []).append(len(self.items))
            self.items.append((item_id, shingles))
        self.hashes = np.array(sorted(holders), np.uint64)
        self.holders = [holders[h] for h in self.hashes.tolist()]
        # A bit per hash prefix, so that most shingles of documents need no search.
        self.bits = max(16, 4 + len(self.hashes).bit_length())
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[self.hashes >> np.uint64(64 - self.bits)] = True

    def met(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` that are in a sketch, and which hash of the sketches it is."""
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - self.bits)])
        place = np.searchsorted(self.hashes, hashes[at])
        place[place == len(self.hashes)] = 0
        same = self.hashes[place] == hashes[at] if len(self.hashes) else np.zeros(0, bool)
        return at[same], place[same]

    def contained(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """``(text, item, shingles of the item, shared)`` of all contained items."""
        words, counts = [], []
        for text in texts:
            own = words_of(text, self.by_character)
            counts.append(len(own))
            words += own
        encoded = "\n".join(words).encode("utf-8", "surrogatepass").replace(b"\n", b" ")
        data = np.frombuffer(encoded, np.uint8)
        if not len(self.items) or not words:
            return []
        # Words hold no white space, so the spaces between them are the only ones.
        spaces = np.flatnonzero(data == 32)
        starts, ends = np.r_[0, spaces + 1], np.r_[spaces, len(data)]
        last_word = np.cumsum(counts)
        text_of = np.repeat(np.arange(len(texts)), counts)
        first = np.arange(len(starts) - self.size + 1)
        first = first[first + self.size <= last_word[text_of[first]]]
        hashes = ByteHashes(data).of(starts[first], ends[first + self.size - 1])
        at, place = self.met(hashes)
        candidates = {
            (text, item)
            for text, p in set(zip(text_of[first[at]].tolist(), place.tolist(), strict=True))
            for item in self.holders[p]
        }
        found, known = [], {}
        for text, item in sorted(candidates):
            if text not in known:
                known.clear()
                known[text] = set(shingles_of(texts[text], self.size, self.by_character))
            item_id, shingles = self.items[item]
            shared = sum(s in known[text] for s in shingles)
            if shared >= math.ceil(self.threshold * len(shingles) - 1e-9):
                found.append((text, item_id, len(shingles), shared))
        return found

    def contained_in_slices(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """:meth:`contained` over slices of bounded size."""
        found, low = [], 0
        while low < len(texts):
            high, held = low, 0
            while high < len(texts) and (high == low or held < _SLICE_CHARS):
                held += len(texts[high])
                high += 1
            found += [(low + text, *rest) for text, *rest in self.contained(texts[low:high])]
            low = high
        return found


def sketches_of(
    items: list[tuple[int, str]], size: int, threshold: float, every_item: bool
) -> list[Sketches]:
    """The sketches of a block of items; with ``every_item``, of each width of its shorter items too."""
    if not every_item:
        return [Sketches(items, size, threshold)]
    by_width: dict[int, list[tuple[int, str]]] = {}
    for item_id, text in items:
        width = min(size, len(words_of(text, True)))
        if width:
            by_width.setdefault(width, []).append((item_id, text))
    return [Sketches(own, width, threshold, True) for width, own in sorted(by_width.items())]


def _item_blocks(items: DataFrame, block_bytes: int) -> Iterator[Broadcast]:
    """The items in blocks of about so many bytes, each sent to all executors."""
    own = items.filter(F.col("text").isNotNull()).select("item_id", "text").distinct()
    size = own.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for k in range(blocks):
        texts = [(r.item_id, r.text) for r in own.filter(block == k).collect()]
        yield items.sparkSession.sparkContext.broadcast(texts)


_PAIRS = "item_id bigint, doc_id bigint, n_shingles bigint, n_shared bigint"


def contained_items(
    documents: DataFrame,
    items: DataFrame,
    *,
    shingle_words: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
    every_item: bool = False,
) -> DataFrame:
    """Pairs of an item and a document that contains it: ``item_id, doc_id, n_shingles, n_shared``.

    Words are runs of letters and digits in lower case. With ``every_item``, characters of scripts
    without spaces are words of their own, and all words of an item with fewer than a shingle's are
    its one shingle; otherwise such items match nothing. Items without words, null texts and empty
    tables match nothing. Repeated items count once; documents with equal
    or null ids are rows of their own, so that a pair can occur more than once.
    """
    found = []
    for shared in _item_blocks(items, block_bytes):

        def searched(batches, shared=shared):
            searches = sketches_of(shared.value, shingle_words, threshold, every_item)
            for batch in sliced(batches):
                ids, texts = batch.column("doc_id"), texts_of(batch.column("text"))
                rows = [
                    (item, ids[text].as_py(), n, shared_n)
                    for sketches in searches
                    for text, item, n, shared_n in sketches.contained_in_slices(texts)
                ]
                columns = list(zip(*rows, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    ["item_id", "doc_id", "n_shingles", "n_shared"],
                )

        found.append(map_batches(documents, ["doc_id", "text"], searched, _PAIRS))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def without_items(
    documents: DataFrame,
    items: DataFrame,
    *,
    shingle_words: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
    every_item: bool = False,
) -> DataFrame:
    """The documents that contain no item, with all their columns; nothing is shuffled."""
    for shared in _item_blocks(items, block_bytes):

        def clean(batches, shared=shared):
            searches = sketches_of(shared.value, shingle_words, threshold, every_item)
            for batch in sliced(batches):
                texts = texts_of(batch.column("text"))
                keep = np.ones(len(texts), bool)
                for sketches in searches:
                    keep[[text for text, *_ in sketches.contained_in_slices(texts)]] = False
                yield batch.filter(pa.array(keep))

        documents = documents.mapInArrow(clean, documents.schema)
    return documents

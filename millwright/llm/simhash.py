"""Near-duplicates by SimHash, found through a byte-position inverted index.

Two 64-bit fingerprints that differ in at most four bits differ in at most four of their eight
bytes, so they share at least four bytes at the same positions. The index posts every distinct
fingerprint under triples of its positional bytes; twenty triples are enough for any four
shared positions to hold one of them. Within a posting list the shared positional bytes of each
pair are tallied, pairs with fewer than the guaranteed four are dropped, and what remains is
verified bit by bit.

Pairs never leave the task that finds them: each posting list puts out the links of a spanning
forest, which has fewer rows than the list has fingerprints. A list that is too long to compare
as a whole is posted again under longer keys (a further byte, and triples of half bytes of the
rest), which by the same counting still brings every linked pair together. Equal fingerprints
are one entry throughout, so a large group of copies costs one entry.

Components are found by repeatedly linking each fingerprint to the smallest one in reach; every
round is written to the shared folder.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import map_batches, sliced, texts_of, utf8
from millwright.sources.staging import stage

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# Posting lists up to this length are compared at once; longer ones are posted again.
LIST_LENGTH = 8192
_BLOCK = 1024
_SIGN = -(1 << 63)


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text; zero if it has no words."""
    import xxhash

    # On bytes, lower() and split() know ASCII letters and the six ASCII white spaces only.
    words = utf8(text).lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(words) > shingle_words:
        starts, ends = starts[: 1 - shingle_words], ends[shingle_words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts.tolist(), ends.tolist(), strict=True)
    hashes = np.array([digest(joined[s:e], SEED) for s, e in pairs], np.uint64)
    bits = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 65_536):  # very long texts in parts
        own = hashes[low : low + 65_536].astype("<u8").view(np.uint8)
        bits += np.unpackbits(own.reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    set_bits = np.packbits(2 * bits > len(hashes), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(documents: DataFrame, *, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed bigint. Null text has no words."""

    def made(batches):
        for batch in sliced(batches):
            own = [fingerprint(t, shingle_words) for t in texts_of(batch.column("text"))]
            fps = np.array(own, np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"]
            )

    return map_batches(documents, ["doc_id", "text"], made, "doc_id bigint, fp bigint")


# --- the index ------------------------------------------------------------------------------


def covering_triples(n: int = 8) -> list[tuple[int, int, int]]:
    """Triples of ``n`` positions such that any four positions hold one of them.

    The positions are dealt to three classes in a ring. A triple is taken if it lies in one
    class, or has two positions in a class and one in the next: of any four positions, some
    three are of that kind.
    """
    ring = [i % 3 for i in range(n)]
    taken = []
    for triple in combinations(range(n), 3):
        classes = [ring[i] for i in triple]
        counts = [classes.count(c) for c in range(3)]
        in_one = 3 in counts
        two_and_next = any(counts[c] == 2 and counts[(c + 1) % 3] == 1 for c in range(3))
        if in_one or two_and_next:
            taken.append(triple)
    return taken


def _spread(values: np.ndarray, positions, width: int) -> np.ndarray:
    """The parts of ``width`` bits at the given positions, side by side."""
    out = np.zeros(len(values), np.uint64)
    for p in positions:
        part = (values >> np.uint64(width * p)) & np.uint64((1 << width) - 1)
        out = (out << np.uint64(width)) | part
    return out


def short_keys(values: np.ndarray) -> list[np.ndarray]:
    """Twenty keys per fingerprint: a triple's number above its three bytes."""
    return [
        _spread(values, triple, 8) | np.uint64(number << 24)
        for number, triple in enumerate(covering_triples())
    ]


def long_keys(values: np.ndarray, key: int) -> list[np.ndarray]:
    """Keys for the fingerprints of one long list, whose three bytes of the key are equal.

    Linked pairs share a fourth byte too, and of the eight half bytes of the other four bytes
    at least four, hence one of the triples of half bytes.
    """
    shared = covering_triples()[key >> 24]
    others = [p for p in range(8) if p not in shared]
    keys = []
    for a, fourth in enumerate(others):
        rest = [p for p in others if p != fourth]
        halves = [2 * p + h for p in rest for h in (0, 1)]
        for b, triple in enumerate(covering_triples()):
            parts = _spread(values, [fourth], 8) << np.uint64(12)
            parts |= _spread(values, [halves[i] for i in triple], 4)
            keys.append(parts | np.uint64((a * 32 + b) << 20) | np.uint64(key << 32))
    return keys


def _popcount(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values)


def forest(values: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints at most ``max_bits`` apart.

    Compares a block of fingerprints with all that follow. Those already joined to the same
    tree need no further link.
    """
    n = len(values)
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    least_shared = 8 - max_bits
    for low in range(0, n, _BLOCK):
        own = values[low : low + _BLOCK]
        for other in range(low, n, _BLOCK):
            apart = own[:, None] ^ values[None, other : other + _BLOCK]
            bits = _popcount(apart)
            close = np.argwhere(bits <= max_bits)
            if not len(close):
                continue
            left, right = close[:, 0] + low, close[:, 1] + other
            later = left < right
            left, right = left[later], right[later]
            # The tally: bytes that are equal at their position.
            differing = (values[left] ^ values[right]).astype("<u8").view(np.uint8)
            tally = (differing.reshape(-1, 8) == 0).sum(1)
            for i, j in zip(left[tally >= least_shared].tolist(), right[tally >= least_shared].tolist()):
                a, b = root(i), root(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    links.append((i, j))
    return links


_LINK_SCHEMA = "a bigint, b bigint"


def _postings(distinct: DataFrame) -> DataFrame:
    def posted(batches):
        for batch in batches:
            values = batch.column("fp").to_numpy().astype(np.int64)
            keys = np.concatenate(short_keys(values.view(np.uint64))).astype(np.int64)
            fps = np.tile(values, len(keys) // max(1, len(values)))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps)], ["key", "fp"])

    return map_batches(distinct, ["fp"], posted, "key bigint, fp bigint")


def _longer_postings(rows: DataFrame) -> DataFrame:
    def posted(batches):
        for batch in batches:
            keys, fps = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
            for key in np.unique(keys):
                values = fps[keys == key]
                longer = np.concatenate(long_keys(values.view(np.uint64), int(key)))
                again = np.tile(values, len(longer) // len(values))
                for low in range(0, len(longer), 100_000):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(longer[low : low + 100_000].astype(np.int64)),
                            pa.array(again[low : low + 100_000]),
                        ],
                        ["key", "fp"],
                    )

    return map_batches(rows, ["key", "fp"], posted, "key bigint, fp bigint")


def _links_of_lists(postings: DataFrame, max_bits: int) -> DataFrame:
    """Forest links of every posting list, several lists at a time."""

    def linked(batches):
        held_keys, held_fps = [], []

        def close(whole: bool):
            """Links of the complete lists held; the last one may go on in the next batch."""
            keys, fps = np.concatenate(held_keys), np.concatenate(held_fps)
            held_keys.clear()
            held_fps.clear()
            end = len(keys) if whole else int(np.searchsorted(keys, keys[-1]))
            if end < len(keys):
                held_keys.append(keys[end:])
                held_fps.append(fps[end:])
            keys, fps = keys[:end], fps[:end]
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if end else []
            ends = np.r_[starts[1:], end] if end else []
            a, b = [], []
            for s, e in zip(starts, ends, strict=True):
                if e - s > 1:
                    own = fps[s:e]
                    for i, j in forest(own.view(np.uint64), max_bits):
                        a.append(own[i])
                        b.append(own[j])
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
            )

        for batch in batches:
            if batch.num_rows:
                held_keys.append(batch.column("key").to_numpy())
                held_fps.append(batch.column("fp").to_numpy())
                yield close(False)
        if held_keys:
            yield close(True)

    grouped = postings.repartition("key").sortWithinPartitions("key", "fp")
    return map_batches(grouped, ["key", "fp"], linked, _LINK_SCHEMA)


def links(distinct: DataFrame, *, max_bits: int = MAX_BITS, list_length: int = LIST_LENGTH) -> DataFrame:
    """Links that connect what pairs at most ``max_bits`` apart connect; ``fp`` is distinct."""
    if max_bits > 4:
        raise ValueError("the index guarantees pairs of at most four differing bits")
    postings = _postings(distinct)
    lengths = postings.groupBy("key").count()
    long_lists = stage(lengths.filter(F.col("count") > list_length).select("key"))
    short = postings.join(long_lists, "key", "left_anti")
    found = _links_of_lists(short, max_bits)
    if long_lists.isEmpty():
        return found.distinct()
    again = _longer_postings(postings.join(long_lists, "key", "left_semi"))
    return found.unionByName(_links_of_lists(again, max_bits)).distinct()


# --- components -----------------------------------------------------------------------------


def components(edges: DataFrame, *, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node in reach) of every node on an edge.

    Alternates two steps: each node's larger neighbours are linked to its smallest one, then
    its smaller ones are. Both keep the components; together they flatten them to stars, in
    rounds that grow with the logarithm of the size. A node with very many neighbours is a
    star's centre and needs only the minimum over them, which is combined before the shuffle.
    """
    edges = stage(
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .filter("hi <> lo")
        .distinct()
    )
    while True:
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("m")).select(
            "node", F.least("node", "m").alias("m")
        )
        # Large step: larger neighbours to the smallest one.
        large = (
            edges.join(least, edges["lo"] == least["node"])
            .select(F.col("hi"), F.col("m").alias("lo"))
            .filter("hi <> lo")
            .distinct()
        )
        # Small step: a node and its smaller neighbours to the smallest of these.
        smallest = large.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("m"))
        small = (
            large.join(smallest, large["hi"] == smallest["node"])
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .filter("hi <> lo")
            .unionByName(smallest.select(F.col("node").alias("hi"), F.col("m").alias("lo")))
            .distinct()
        )
        after = stage(small)
        changed = not (
            after.exceptAll(edges).isEmpty() and after.count() == edges.count()
        )
        edges = after
        if not changed:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def near_duplicates(
    documents: DataFrame,
    *,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    list_length: int = LIST_LENGTH,
) -> DataFrame:
    """``doc_id, fingerprint, component_id, fp_doc_id``, one row per document.

    ``component_id`` is the smallest ``doc_id`` in reach over links of at most ``max_bits``
    differing bits, ``fp_doc_id`` the smallest with the very same fingerprint. Documents without
    words have fingerprint zero and are linked like any other. Equal ids are documents of their
    own; null ids take part in linking but never name a component, unless all in it are null.
    """
    prints = stage(fingerprints(documents, shingle_words=shingle_words))
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("fp_doc_id")))
    roots = components(links(distinct, max_bits=max_bits, list_length=list_length))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "fp_doc_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("fp_doc_id").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "fp_doc_id", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp_doc_id"
    )

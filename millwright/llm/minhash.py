"""Groups of near-duplicates: SimHash, then MinHash bands, verified by Jaccard similarity.

Texts are compared as sets of five-word shingles (words as in ``simhash``; a shorter text is one
shingle). Candidates come in two steps. First ``simhash`` connects the fingerprints of five-word
shingles that differ in at most four bits, by its index of positional bytes. Most pairs of a
similarity near 0.8 differ in more bits, so bands of MinHash values bring together what those
links leave apart: two texts of similarity ``s`` meet in one of ``BANDS`` bands of ``ROWS`` values
but for a chance of ``(1 - s ** ROWS) ** BANDS``, which is 1 in 14,000 at 0.8 and 1 in 1,000,000
at 0.85. Candidates of both steps are verified by the similarity of their whole shingle sets, so
every link is a pair of at least the threshold.

Texts of equal sets are one entry throughout. Bands that hold the same entries are compared once,
and not at all if the links of the first step connect them.
Pairs never leave the task that finds them: it puts out the links of a spanning forest. A long
list is dealt to blocks and compared in two rounds. First every block is compared with itself and
with the first block, which connects a large group of near copies by twice as many rows as it has
entries. Then only entries outside the list's largest tree are still compared with all others, a
block of them with a block of the list at a time. Nothing is left out: pairs within one tree need
no further link. (A long list whose entries are mostly *not* similar stays quadratic in its rows.)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm import simhash
from millwright.llm.common import ByteHashes, free_kept, map_batches, sliced, texts_of, utf8
from millwright.llm.simhash import components
from millwright.sources.staging import stage

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
# Entries of a list that one task compares with as many others.
BLOCK_ENTRIES = 1024
_SHINGLES = 4096
_RANDOM = np.random.default_rng(20240608)
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2)


def shingle_set(text: str, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; empty if it has no words."""
    words = utf8(text).lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    size = min(size, len(words))
    data = np.frombuffer(b" ".join(words), np.uint8)
    return np.unique(ByteHashes(data).of(starts[: len(words) - size + 1], ends[size - 1 :]))


def set_name(shingles: np.ndarray) -> str:
    """A name that only equal sets have."""
    import xxhash

    return xxhash.xxh3_128_hexdigest(shingles.tobytes())


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """A key per band from the least values of its hash functions."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(shingles), _SHINGLES):
        values = shingles[low : low + _SHINGLES] * _FACTORS[:, None] + _SHIFTS[:, None]
        np.minimum(least, values.min(1), out=least)
    ends = np.arange(1, BANDS + 1) * ROWS * 8
    return ByteHashes(least.view(np.uint8)).of(ends - ROWS * 8, ends) + np.arange(BANDS, dtype=np.uint64)


def named(documents: DataFrame, columns: list[str]) -> DataFrame:
    """The columns and ``set_name``, the name of the text's shingle set."""

    def made(batches):
        free_kept()
        for batch in sliced(batches):
            names = [set_name(shingle_set(t)) for t in texts_of(batch.column("text"))]
            yield batch.append_column("set_name", pa.array(names, pa.string()))

    rows = documents.select(*columns)
    return rows.mapInArrow(made, rows.withColumn("set_name", F.lit("")).schema)


def _postings(entries: DataFrame) -> DataFrame:
    """Band keys with the first half of the name; other sets of that half are compared for nothing."""

    def posted(batches):
        for batch in sliced(batches, 2048):
            keys, names = [], []
            for text, name in zip(
                texts_of(batch.column("text")), batch.column("set_name").to_pylist(), strict=True
            ):
                shingles = shingle_set(text)
                if len(shingles):
                    keys.append(band_keys(shingles))
                    names += [int(name[:16], 16)] * BANDS
            if keys:
                own = pa.array(np.concatenate(keys).view(np.int64))
                starts = pa.array(np.array(names, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([own, starts], ["key", "start"])

    return map_batches(entries, ["set_name", "text"], posted, "key bigint, start bigint")


def forest(
    sets: list[np.ndarray], threshold: float, trees: list | None = None
) -> list[tuple[int, int]]:
    """Links of a spanning forest of the sets of at least ``threshold`` similarity.

    Sets with equal ``trees`` are connected already.
    """
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    known, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    tree = np.arange(n) if trees is None else np.unique(trees, return_inverse=True)[1]
    links = []
    for i in range(n - 1):
        later = np.flatnonzero(tree[i + 1 :] != tree[i]) + i + 1
        small, large = np.minimum(sizes[later], sizes[i]), np.maximum(sizes[later], sizes[i])
        later = later[small >= threshold * large - 1e-9]
        if not len(later):
            continue
        mark = np.zeros(len(known), bool)
        mark[codes[starts[i] : starts[i] + sizes[i]]] = True
        if len(later) == n - 1:
            held = mark[codes[starts[1] :]]
        else:
            held = mark[np.concatenate([codes[starts[j] : starts[j] + sizes[j]] for j in later])]
        shared = np.add.reduceat(held, np.r_[0, np.cumsum(sizes[later])[:-1]], dtype=np.int64)
        close = later[shared >= threshold * (sizes[i] + sizes[later] - shared) - 1e-9]
        for j in close.tolist():
            if tree[i] != tree[j]:
                tree[tree == tree[j]] = tree[i]
                links.append((i, j))
    return links


def _start() -> Column:
    return F.conv(F.left("set_name", F.lit(16)), 16, -10).cast("bigint").alias("start")


def _block(blocks: str, seed: int = 0) -> Column:
    return F.pmod(F.xxhash64("start", F.lit(seed)), F.col(blocks)).cast("int")


def _each(blocks: str) -> Column:
    return F.sequence(F.lit(0), F.col(blocks) - 1)


def _links_of_tasks(entries: DataFrame, met: DataFrame, threshold: float) -> DataFrame:
    """Forest links of the entries that ``met`` (``start, at, tree``) sends to the same ``at``.

    ``at`` is a struct of ``key, i, j``; entries of a ``tree`` are connected, null is none.
    """
    rows = entries.select("set_name", "text", _start()).join(met, "start").select(
        F.xxhash64("at").alias("task"), F.col("at.key").alias("key"), "at.i", "at.j", "set_name", "text", "tree"
    )
    dealt = rows.repartition("task").sortWithinPartitions("key", "i", "j", "set_name")

    def linked(batches):
        at, names, sets, trees = None, [], [], []

        def close():
            known = None if None in trees else trees
            found = forest(sets, threshold, known) if len(sets) > 1 else []
            a, b = [names[i] for i, _ in found], [names[j] for _, j in found]
            return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["a", "b"])

        for batch in sliced(batches):
            columns = [batch.column(c).to_pylist() for c in ("key", "i", "j", "set_name", "text", "tree")]
            for key, i, j, name, text, tree in zip(*columns, strict=True):
                if (key, i, j) != at:
                    if len(sets) > 1:
                        yield close()
                    at, names, sets, trees = (key, i, j), [], [], []
                names.append(name)
                sets.append(shingle_set(text or ""))
                trees.append(tree)
        yield close()

    columns = ["key", "i", "j", "set_name", "text", "tree"]
    return map_batches(dealt, columns, linked, "a string, b string").distinct()


def _trees(entries: DataFrame, found: DataFrame) -> DataFrame:
    """``start, tree`` of every entry: entries that the links connect have equal trees."""
    roots = components(found)
    nodes = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    named = entries.select("set_name", _start())
    return named.join(nodes, F.col("set_name") == F.col("node"), "left").select(
        "start", F.coalesce("root", "set_name").alias("tree")
    )


def _left_open(postings: DataFrame, long_lists: DataFrame, trees: DataFrame, block_entries: int) -> DataFrame:
    """What is still to be compared in long lists, as ``met`` of :func:`_links_of_tasks`.

    The entries outside a list's largest tree, in blocks ``i``, meet all its entries, in blocks ``j``.
    """
    held = stage(postings.join(long_lists, "key").join(trees, "start"))
    sizes = held.groupBy("key", "tree").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("key").agg(
        F.max(F.struct("size", "tree"))["tree"].alias("largest"),
        (F.sum("size") - F.max("size")).alias("others"),
    )
    parts = F.ceil(F.col("others") / block_entries).cast("int")
    open_lists = largest.filter("others > 0").select("key", "largest", parts.alias("parts"))
    rest = held.join(open_lists, "key")

    def meeting(i: Column, j: Column) -> Column:
        return F.struct("key", i.alias("i"), j.alias("j")).alias("at")

    others = rest.filter("tree <> largest").withColumn("j", F.explode(_each("blocks")))
    own = rest.withColumn("i", F.explode(_each("parts")))
    met = others.select("start", "tree", meeting(_block("parts", 1), F.col("j")))
    return met.unionByName(own.select("start", "tree", meeting(F.col("i"), _block("blocks")))).distinct()


def _fingerprint_lists(entries: DataFrame) -> DataFrame:
    """``key, start``: entries whose fingerprints ``simhash`` connects have equal keys."""
    # Texts without words are one entry, and near no other.
    worded = entries.filter(F.col("set_name") != set_name(shingle_set("")))
    texts = worded.select(_start().alias("doc_id"), "text")
    prints = stage(simhash.fingerprints(texts, shingle_words=SHINGLE_WORDS))
    roots = components(simhash.links(stage(prints.select("fp").distinct())))
    return prints.join(roots, F.col("fp") == F.col("node"), "left").select(
        F.coalesce("root", "fp").alias("key"), F.col("doc_id").alias("start")
    )


def _lists(postings: DataFrame, block_entries: int) -> DataFrame:
    """``key, blocks`` of the lists of several entries, once where lists have the same entries."""
    lists = postings.groupBy("key").agg(
        F.count("*").alias("n"), F.min("start").alias("first"), F.bit_xor("start").alias("all")
    )
    lists = lists.filter("n > 1").groupBy("n", "first", "all").agg(F.min("key").alias("key"))
    return lists.select("key", F.ceil(F.col("n") / block_entries).cast("int").alias("blocks"))


def _first_round(held: DataFrame) -> DataFrame:
    """What meets first of ``key, start, blocks, tree``, as ``met`` of :func:`_links_of_tasks`."""
    # The first block meets all blocks, any other one itself.
    own = _block("blocks")
    return held.withColumn("j", F.explode(F.when(own == 0, _each("blocks")).otherwise(F.array(own)))).select(
        "start", F.struct("key", F.lit(0).alias("i"), "j").alias("at"), "tree"
    )


def fingerprint_links(
    entries: DataFrame, *, threshold: float = THRESHOLD, block_entries: int = BLOCK_ENTRIES
) -> DataFrame:
    """Verified links ``a, b`` among entries whose fingerprints ``simhash`` connects."""
    postings = stage(_fingerprint_lists(entries))
    held = postings.join(_lists(postings, block_entries), "key")
    # Long lists have no second round here: whatever is similar still meets in a band.
    met = _first_round(held.withColumn("tree", F.lit(None).cast("string")))
    return _links_of_tasks(entries, met, threshold)


def links(entries: DataFrame, *, threshold: float = THRESHOLD, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Links ``a, b`` that connect what pairs of at least ``threshold`` connect.

    ``entries`` have a ``set_name``, each once, and a ``text``.
    """
    near = stage(fingerprint_links(entries, threshold=threshold, block_entries=block_entries))
    postings = stage(_postings(entries))
    held = postings.join(_lists(postings, block_entries), "key")
    held = stage(held.join(_trees(entries, near), "start"))
    # Nothing is left to find in a list whose entries are connected already.
    apart = F.min("tree") != F.max("tree")
    lists = held.groupBy("key", "blocks").agg(apart.alias("apart")).filter("apart")
    lists = stage(lists.select("key", "blocks"))
    met = _first_round(held.join(lists.select("key"), "key"))
    found = near.unionByName(_links_of_tasks(entries, met, threshold)).distinct()
    long_lists = lists.filter("blocks > 1")
    if long_lists.isEmpty():
        return found
    found = stage(found)
    left = _left_open(postings, long_lists, _trees(entries, found), block_entries)
    return found.unionByName(_links_of_tasks(entries, left, threshold))


def first_of_groups(documents: DataFrame, columns: list[str], *, threshold: float = THRESHOLD) -> DataFrame:
    """The first row, by id and then the name of its shingle set, of each group of near-duplicates.

    Groups are what links of at least ``threshold`` connect. Texts without words are one group.
    Of rows with the same set, the first by id and then text stays. Null ids come last. Rows are told apart by their text alone, whatever their ids.
    """
    # Nulls come first in Spark's order of structs.
    rest = [c for c in columns if c not in ("doc_id", "text")]
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text", *rest)
    of_set = named(documents, columns).groupBy("set_name").agg(F.min(order).alias("row"))
    entries = stage(of_set.select("set_name", "row.*"))
    roots = components(links(entries, threshold=threshold))
    nodes = roots.select("node", "root").unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct()
    )
    # Only names and ids are compared within groups; texts are moved once more, to drop the rest.
    grouped = entries.select("set_name", "no_id", "doc_id").join(nodes, F.col("set_name") == F.col("node"))
    place = F.struct("no_id", "doc_id", "set_name")
    first = grouped.groupBy("root").agg(F.min(place)["set_name"].alias("set_name"))
    others = grouped.select("set_name").join(first.select("set_name"), "set_name", "left_anti")
    return entries.join(others, "set_name", "left_anti").select(*columns)

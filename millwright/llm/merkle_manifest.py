"""A hash tree over a corpus, and for every document the proof that it is in it.

Each row is a leaf: the hash of its fields. Per source, leaves in order of their ids are the lowest
level of a tree; every 16 neighbours have one parent, up to a single subroot. The subroots, in order
of their sources, are the lowest level of a tree of their own, whose top is the root.

Building goes up level by level: numbering the leaves of each source (range-sorted chunks, so a
source with a third of all rows is many tasks'), then one aggregation of at most 16 rows a group
per level, each written before the next. What is stored are *nodes linked to their parents*: an
id, the digests left and right of the node among its siblings, and the id of the parent.

Proving is a recursive query that climbs from the leaves. A row of the recursion
is the leaves of one run (at most 16), because they meet the same siblings from their parent up; it
appends these siblings once and folds the presented hash of each leaf with them. Every step is a
join with the stored nodes on the id. All leaves of a large source meet at its upper nodes, so a node
with many runs below it is stored in copies, one for each ``RUNS_PER_COPY`` of them, and a run goes
to one copy by its hash: no key is one task's.

Rows with equal source and id are ordered by their leaf hash, so the result does not depend on how
rows are laid out; equal rows have equal leaves and so the same place either way. A null source is
a source of its own, a null id comes first, further columns are not read, an empty table has no
rows and no root. Texts of any length are hashed in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.operators.ordered import number_rows, running_sum
from millwright.sources.staging import stage

# Children of a node, bytes of a digest, fields of a leaf in order.
FANOUT = 16
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# Runs below a node that share one stored copy of it.
RUNS_PER_COPY = 64
# Tree of the subroots; trees of sources are named "-" (null) or "=" and the source.
TOP = "*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Manifest(NamedTuple):
    """A built tree, all written: runs of leaves, linked nodes (none if a run is all there is),
    and the root with its id (none of an empty table)."""

    runs: DataFrame
    nodes: DataFrame | None
    root: bytes | None
    root_id: str


def hash_of(digests: Column) -> Column:
    """Hash of digests laid one after the other, taken as their hexadecimal text."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)), 256))


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Hash of a row: ``-`` for a null field, else its length in bytes, ``:`` and its text."""

    def entry(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(entry, fields)), 256))


def leaves_of(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``leaf`` and ``shown``: the hash presented when it is checked.

    Where 5 divides the CRC of the decimal id, the text is presented with its ASCII capitals in
    lower case; a null id has no CRC.
    """
    fields = {name: F.col(name) for name in FIELDS}
    changed = fields | {"text": F.translate(F.col("text"), UPPER, LOWER)}
    drawn = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    leaf = leaf_hash(list(fields.values()))
    return docs.select(
        "doc_id",
        "source",
        leaf.alias("leaf"),
        F.when(drawn, leaf_hash(list(changed.values()))).otherwise(leaf).alias("shown"),
    )


def _node_id(tree: Column, level: int, at: Column) -> Column:
    return F.concat_ws("/", F.lit(level), at.cast("string"), tree)


def _copies(runs: Column) -> Column:
    return F.ceil(runs / F.lit(RUNS_PER_COPY)).cast("bigint")


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda a, d: F.concat(a, d))


def _part(digests: Column, start: Column, length: Column) -> Column:
    return F.substring(digests, start, length)


def _numbered(leaves: DataFrame) -> DataFrame:
    """Leaves with their tree, their place in it from 0 and the number of its leaves."""
    source = F.col("source").cast("string")
    tree = F.when(source.isNull(), "-").otherwise(F.concat(F.lit("="), source))
    named = leaves.select("doc_id", "leaf", "shown", tree.alias("tree"), F.lit(1).alias("one"))
    order = [F.col("doc_id").asc_nulls_first(), "leaf"]
    counted = running_sum(named, "one", order, partition_by=["tree"], out="place", total="size")
    return counted.withColumn("at", F.col("place") - 1)


def _runs(leaves: DataFrame) -> DataFrame:
    """Runs of up to 16 leaves, each the lowest node that its leaves share.

    The only leaf of a source is that source's subroot and not hashed again.
    """
    member = F.struct("at", "doc_id", "leaf", "shown")
    grouped = _numbered(leaves).groupBy("tree", F.expr(f"at div {FANOUT}").alias("run")).agg(
        F.max("size").alias("leaves"), F.array_sort(F.collect_list(member)).alias("members")
    )
    digests = _joined(F.transform("members", lambda m: m["leaf"]))
    lone = F.col("leaves") == 1
    return grouped.select(
        "tree",
        F.col("run").alias("at"),
        F.ceil(F.col("leaves") / F.lit(FANOUT)).cast("bigint").alias("size"),
        F.when(lone, digests).otherwise(hash_of(digests)).alias("digest"),
        F.when(lone, _node_id(F.col("tree"), 0, F.col("run")))
        .otherwise(_node_id(F.col("tree"), 1, F.col("run")))
        .alias("node"),
        lone.alias("lone"),
        digests.alias("leaf_digests"),
        "members",
    )


def _linked(level: DataFrame, number: int, size: int) -> tuple[list[DataFrame], DataFrame]:
    """Linked nodes of trees from a level up, and the top node of each tree.

    A level has ``tree``, ``at`` (from 0), ``size`` (nodes of the tree on it), ``node`` (id),
    ``digest``, ``runs`` below the node and ``subroot``; ``size`` is that of the largest tree.
    """
    links, tops = [], [level.filter("size = 1")]
    while size > 1:
        size, number = -(-size // FANOUT), number + 1
        child = F.struct("at", "node", "digest", "runs", "subroot")
        grouped = level.filter("size > 1").groupBy("tree", F.expr(f"at div {FANOUT}").alias("up")).agg(
            F.max("size").alias("size"),
            F.sum("runs").alias("runs"),
            F.array_sort(F.collect_list(child)).alias("children"),
        )
        above = stage(
            grouped.select(
                "*",
                _joined(F.transform("children", lambda c: c["digest"])).alias("digests"),
                _node_id(F.col("tree"), number, F.col("up")).alias("node"),
            )
        )
        here = F.col("i") * DIGEST
        links.append(
            above.select("node", "digests", "runs", F.posexplode("children").alias("i", "child")).select(
                F.col("child.node").alias("node"),
                _part(F.col("digests"), F.lit(1), here).alias("before"),
                _part(F.col("digests"), here + DIGEST + 1, F.lit(FANOUT * DIGEST)).alias("after"),
                F.col("node").alias("parent"),
                _copies(F.col("child.runs")).alias("copies"),
                _copies(F.col("runs")).alias("parent_copies"),
                F.col("child.subroot").alias("subroot"),
            )
        )
        level = above.select(
            "tree",
            F.col("up").alias("at"),
            F.ceil(F.col("size") / F.lit(FANOUT)).cast("bigint").alias("size"),
            "node",
            hash_of(F.col("digests")).alias("digest"),
            "runs",
            F.lit(None).cast("binary").alias("subroot"),
        )
        tops.append(level.filter("size = 1"))
    return links, reduce(DataFrame.unionByName, tops)


def build(leaves: DataFrame) -> Manifest:
    """The tree over leaves ``(doc_id, source, leaf, shown)``, written level by level."""
    runs = stage(_runs(leaves))
    largest = runs.agg(F.max("size")).first()[0]
    if largest is None:
        return Manifest(runs, None, None, "")
    lowest = runs.select(
        "tree", "at", "size", "node", "digest",
        F.lit(1).cast("bigint").alias("runs"), F.lit(None).cast("binary").alias("subroot"),
    )
    links, tops = _linked(lowest, 1, largest)
    subroots = stage(number_rows(tops, ["tree"], out="place"))
    sources = subroots.count()
    upper = subroots.select(
        F.lit(TOP).alias("tree"),
        (F.col("place") - 1).alias("at"),
        F.lit(sources).cast("bigint").alias("size"),
        "node",
        "digest",
        "runs",
        F.col("digest").alias("subroot"),
    )
    more, top = _linked(upper, 0, sources)
    root = top.select("digest", "node").first()
    links += more
    nodes = stage(reduce(DataFrame.unionByName, links)) if links else None
    return Manifest(runs, nodes, bytes(root["digest"]), root["node"])


# A run of leaves climbs to the root; LIMIT ALL lifts Spark's limit on a recursion's rows.
_CLIMB = """
    WITH RECURSIVE climb AS (
        SELECT node, copy, seed, members, leaf_digests, proof, subroot FROM {runs}
        UNION ALL
        SELECT n.parent, pmod(c.seed, n.parent_copies), c.seed,
            transform(c.members, m -> named_struct('doc_id', m.doc_id, 'leaf', m.leaf, 'folded',
                unhex(sha2(lower(hex(concat(n.before, m.folded, n.after))), 256)))),
            c.leaf_digests, concat(c.proof, n.before, n.after), coalesce(c.subroot, n.subroot)
        FROM climb c JOIN {nodes} n ON n.node = c.node AND n.copy = c.copy)
    SELECT * FROM climb LIMIT ALL
"""


def prove(manifest: Manifest) -> DataFrame:
    """Per leaf ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof``, ``folded_root``, all binary.

    ``proof`` is the siblings' digests from the leaf's own run up to the root, each level from
    left to right; ``folded_root`` is what the presented hash and the proof come to.
    """
    runs = manifest.runs
    spark = runs.sparkSession
    around = f"""concat(substring(leaf_digests, 1, {DIGEST} * i), m.shown,
        substring(leaf_digests, {DIGEST} * (i + 1) + 1))"""
    # The first step needs no join: a run holds the leaves' siblings.
    shown = f"""transform(members, (m, i) -> named_struct('doc_id', m.doc_id, 'leaf', m.leaf,
        'folded', if(lone, m.shown, unhex(sha2(lower(hex({around})), 256)))))"""
    start = runs.select(
        "node",
        F.lit(0).cast("bigint").alias("copy"),
        F.xxhash64("node").alias("seed"),
        F.expr(shown).alias("members"),
        "leaf_digests",
        F.lit(b"").alias("proof"),
        F.lit(None).cast("binary").alias("subroot"),
    )
    if manifest.nodes is None:
        climbed = start
    else:
        each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1))
        copies = manifest.nodes.select(
            "node", each.alias("copy"), "before", "after", "parent", "parent_copies", "subroot"
        )
        climbed = spark.sql(_CLIMB, runs=start, nodes=copies)
    root = F.lit(bytearray(manifest.root or b""))
    here = F.col("i") * DIGEST
    return (
        climbed.filter(F.col("node") == manifest.root_id)
        .select("proof", "subroot", "leaf_digests", F.posexplode("members").alias("i", "member"))
        .select(
            "member.doc_id",
            "member.leaf",
            F.coalesce("subroot", root).alias("subroot"),
            root.alias("root"),
            F.concat(
                _part(F.col("leaf_digests"), F.lit(1), here),
                _part(F.col("leaf_digests"), here + DIGEST + 1, F.lit(FANOUT * DIGEST)),
                F.col("proof"),
            ).alias("proof"),
            F.col("member.folded").alias("folded_root"),
        )
    )


def proof_digests(proofs: DataFrame) -> DataFrame:
    """Digests as lower-case hexadecimal text, and whether each leaf leads to the root."""

    def text(name: str) -> Column:
        return F.lower(F.hex(name))

    return proofs.select(
        "doc_id",
        *[text(c).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(text("proof"), 256).alias("proof_sha256"),
        text("folded_root").alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )

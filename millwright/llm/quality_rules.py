"""Quality rules as a bitmask ledger, with built-in Spark expressions only.

Every rule is evaluated once. The ledger keeps, per document, what was measured and one bit per
failed rule. A policy is a version and the set of rules it enforces, so applying a policy, or
asking what leaving out one of its rules would change, is arithmetic on the bits: the texts are
not read again, and an ablation over all rules and policies is one bitwise aggregation.

Words are maximal runs of characters other than the six ASCII white-space characters. Null
texts have no words. Repeated windows are found by a 64-bit hash of five words, compared
within one document.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that part words, as characters and as a pattern.
WHITE_SPACE = " \t\n\x0b\f\r"
_WHITE = r"[\x20\x09-\x0D]"
_NOT_WHITE = r"[^\x20\x09-\x0D]"
_NOT_SYMBOL = r"[^#*$%&|<>]+"
WINDOW = 5

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
)


@dataclass(frozen=True)
class Rule:
    """A named condition over the measures (SQL); a document fails the rule where it holds."""

    name: str
    fails: str


# The position of a rule is its bit; rules are only ever added at the end.
RULES = (
    Rule("too_few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
)
BASE_RULES = ("too_few_words", "repeated_words")

# Policies by version. A published version is never changed; a new one is added.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE_RULES,
    "v1": (*BASE_RULES, "symbols"),
    "v2": tuple(r.name for r in RULES),
}
CURRENT = "v2"


def mask_of(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    """The bits of the named rules."""
    known = {rule.name: bit for bit, rule in enumerate(rules)}
    return sum(1 << known[name] for name in names)


def _equal_neighbours(ranked: str, k: Column) -> Column:
    """Whether entry ``k`` of a sorted array of (hash, start) has the hash of a neighbour."""
    entries = F.col(ranked)
    own = F.get(entries, k)["h"]
    before, after = F.get(entries, k - 1)["h"], F.get(entries, k + 1)["h"]
    return F.coalesce(own == before, F.lit(False)) | F.coalesce(own == after, F.lit(False))


def measure(documents: DataFrame, *, text: str = "text") -> DataFrame:
    """The measures of every document, next to its ``doc_id``."""
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(body, F.lit(WHITE_SPACE))
    no_words = F.array().cast("array<string>")
    words = F.when(trimmed == "", no_words).otherwise(F.split(trimmed, _WHITE + "+"))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(_NOT_WHITE))
    read = documents.select(
        "doc_id",
        words.alias("_words"),
        lines.alias("_lines"),
        (F.length(body) - F.length(F.regexp_replace(body, _NOT_WHITE + "+", ""))).alias("_chars"),
        F.length(F.regexp_replace(body, _NOT_SYMBOL, "")).alias("_symbols"),
    )
    n_windows = F.size("_words") - (WINDOW - 1)
    hashed = F.transform("_words", lambda w: F.xxhash64(w))
    counted = read.select(
        "doc_id",
        F.size("_words").cast("bigint").alias("n_words"),
        F.col("_chars").cast("bigint").alias("word_chars"),
        F.col("_symbols").cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.when(n_windows > 1, hashed).alias("_hashes"),
    )
    window_hash = F.transform(
        F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("_hashes"), i + k) for k in range(WINDOW)]),
    )
    windows = counted.withColumn("_windows", F.when(F.col("_hashes").isNotNull(), window_hash))
    # Sorting is needed only where some window occurs twice, which is seldom.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    entries = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("start")))
    ranked = windows.withColumn("_ranked", F.when(repeats, F.sort_array(entries))).drop(
        "_hashes", "_windows"
    )
    repeated = F.filter(
        F.sequence(F.lit(0), F.size("_ranked") - 1), lambda k: _equal_neighbours("_ranked", k)
    )
    starts = F.transform(repeated, lambda k: F.get(F.col("_ranked"), k)["start"])
    found = ranked.withColumn(
        "_starts", F.when(F.col("_ranked").isNotNull(), F.sort_array(starts))
    ).drop("_ranked")
    # A repeated window covers five words, or up to where the next repeated window starts.
    steps = F.zip_with(
        F.slice("_starts", 2, F.size("_starts") - 1),
        F.slice("_starts", 1, F.size("_starts") - 1),
        lambda later, earlier: F.least(later - earlier, F.lit(WINDOW)),
    )
    covered = F.aggregate(steps, F.lit(WINDOW).cast("bigint"), lambda total, s: total + s)
    n_repeat = F.when(F.col("_starts").isNotNull(), covered).otherwise(F.lit(0))
    return found.withColumn("n_repeat_words", n_repeat.cast("bigint")).select("doc_id", *MEASURES)


def ledger(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the measures, and ``failed``: one bit per failed rule.

    One row per input row, also for equal or null ids; extra columns are left out.
    """
    bits = [
        F.when(F.expr(rule.fails), F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint")
        for bit, rule in enumerate(rules)
    ]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(documents).withColumn("failed", failed)


def passes(version: str, failed: Column | None = None) -> Column:
    """Whether a ledger row passes a policy."""
    failed = F.col("failed") if failed is None else failed
    return failed.bitwiseAND(F.lit(mask_of(POLICIES[version])).cast("bigint")) == 0


def apply_policy(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a policy version.

    ``kept`` is false wherever a base rule fails, whether or not the policy names it.
    """
    base = ~passes("base")
    return rows.withColumn("base_failed", base).withColumn("kept", ~base & passes(version))


def ablations(
    rows: DataFrame,
    policies: Mapping[str, tuple[str, ...]] = POLICIES,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Per policy and rule: documents failing the rule, and kept only if it were left out.

    One aggregation over distinct bit patterns, of which there are few however many documents
    there are.
    """
    patterns = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("documents"))
    asked = F.array(
        *[
            F.struct(
                F.lit(version).alias("version"),
                F.lit(rules[bit].name).alias("rule"),
                F.lit(mask_of(names, rules)).cast("bigint").alias("mask"),
                F.lit(1 << bit).cast("bigint").alias("bit"),
            )
            for version, names in policies.items()
            for bit in range(len(rules))
            if rules[bit].name in names
        ]
    )
    each = patterns.select("failed", "documents", F.explode(asked).alias("q")).select(
        "*", F.col("failed").bitwiseAND(F.col("q.mask")).alias("hit")
    )

    def documents_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("documents")).otherwise(F.lit(0)))

    return each.groupBy("q.version", "q.rule").agg(
        documents_where(F.col("hit").bitwiseAND(F.col("q.bit")) != 0).alias("failing"),
        documents_where(F.col("hit") == F.col("q.bit")).alias("kept_without"),
    )

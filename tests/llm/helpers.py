"""Small corpora with every awkward case, and brute-force counterparts."""

import random
import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHING = ("fp", "block", "key", "n_tokens", "length", "failed", "path", "n", "value", "kept_text")


def documents(spark, texts, *, partitions=3):
    """Documents with ids from 0, and further columns named like the operators' own."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"
    ).repartition(partitions)
    return df.withColumns({c: F.lit("x") for c in CLASHING})


def awkward_texts(seed=1, n=60):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma,", "d", "été", "日本", "#x", "a|b", "10", "it's", "\U0001f600"]
    texts = [None, "", " ", "\n\n", "one", "a b c", "word " * 40, "x" * 3000, "tab\tand\x0bfeed\r\n"]
    for _ in range(n):
        count = rng.randrange(1, 80)
        texts.append(rng.choice([" ", "\n", "  "]).join(rng.choice(words) for _ in range(count)))
    texts += [texts[12], texts[12], texts[13] + " more", " ".join(rng.choice(words) for _ in range(9000))]
    return texts


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

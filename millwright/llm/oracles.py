"""SQL for DuckDB with the same rows as the queries, where SQL can express them.

Written from the contracts: strings are compared as such and windows are counted one by one.
Language models, XXH64, tokenizers and page extraction have no counterpart in SQL.
"""

WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"


def crc32(text: str) -> str:
    """CRC of ASCII text, unsigned: bit by bit, with the usual reflected polynomial."""
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda d: CAST(unicode(d) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {byte}), 4294967295)"


def leaf_hash(text: str) -> str:
    def entry(value: str) -> str:
        return f"coalesce(octet_length(encode({value})) || ':' || {value}, '-')"

    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return f"sha256({' || '.join(map(entry, fields))})"


def merkle_levels(name: str, leaves: str, levels: int) -> str:
    """CTEs of a tree per ``t`` over ``leaves`` (t, pos, h, size), level by level, and its tops."""
    parts = [f"{name}0 AS ({leaves})"]
    for k in range(levels):
        parts.append(
            f"{name}runs{k} AS (SELECT t, pos // 16 AS up, string_agg(h, '' ORDER BY pos) AS r, "
            f"any_value(size) AS size FROM {name}{k} GROUP BY t, pos // 16)"
        )
        parts.append(
            f"{name}{k + 1} AS (SELECT t, up AS pos, CASE WHEN size = 1 THEN r ELSE sha256(r) END "
            f"AS h, CAST(ceil(size / 16) AS BIGINT) AS size FROM {name}runs{k})"
        )
    return ", ".join(parts)


def merkle_climb(name: str, start: str, levels: int) -> str:
    """CTEs that take (rid, t, pos, x, proof) of ``start`` up the levels of a tree."""
    parts, last = [], start
    for k in range(levels):
        before, after = "left(r, 64 * (pos % 16))", "substring(r, 64 * (pos % 16) + 65)"
        parts.append(
            f"{name}up{k} AS (SELECT rid, c.t, pos // 16 AS pos, CASE WHEN size = 1 THEN x ELSE "
            f"sha256({before} || x || {after}) END AS x, proof || {before} || {after} AS proof "
            f"FROM {last} c JOIN {name}runs{k} n ON n.t = c.t AND up = pos // 16)"
        )
        last = f"{name}up{k}"
    return ", ".join(parts)


# Levels of the trees: up to 16**5 documents a source and 16**4 sources.
SOURCE_LEVELS, TOP_LEVELS = 5, 4
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# Words of letters and digits; characters of scripts without spaces are words of their own.
UNSPACED = (
    r"\x{0e00}-\x{0eff}\x{1000}-\x{109f}\x{1780}-\x{17ff}\x{3005}-\x{3007}\x{3040}-\x{30ff}"
    r"\x{31f0}-\x{31ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{ff66}-\x{ff9f}"
    r"\x{20000}-\x{3ffff}"
)
SPACED = (
    f"regexp_extract_all(regexp_replace(lower(text), '([{UNSPACED}])', ' \\1 ', 'g'), "
    r"'[\p{L}\p{N}]+')"
)

ORACLES: dict[str, str] = {
    "op1_suffix_dedup": """
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h,
                octet_length(encode(coalesce(text, ''))) AS n
            FROM documents),
        starts AS (
            SELECT rid, h, unnest(generate_series(0, n - 200)) AS i FROM d WHERE n >= 200),
        strings AS (SELECT rid, i, md5(substring(h, 2 * i + 1, 400)) AS s FROM starts),
        repeated AS (
            SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY s) AS c FROM strings)
            WHERE c > 1),
        marked AS (
            SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY rid ORDER BY i) <= 200
                THEN 0 ELSE 1 END AS fresh
            FROM repeated),
        numbered AS (
            SELECT *, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS run FROM marked),
        spans AS (
            SELECT rid, run, min(i) AS b, max(i) + 200 AS e FROM numbered GROUP BY rid, run),
        gaps AS (
            SELECT rid, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY b), 0) AS a, b AS z
            FROM spans
            UNION ALL SELECT d.rid, coalesce(max(e), 0), any_value(n)
            FROM d LEFT JOIN spans ON spans.rid = d.rid GROUP BY d.rid),
        kept AS (
            SELECT d.rid, string_agg(substring(h, 2 * a + 1, 2 * (z - a)), '' ORDER BY a) AS h
            FROM gaps JOIN d ON d.rid = gaps.rid GROUP BY d.rid),
        cut AS (SELECT rid, count(*) AS n_spans, sum(e - b) AS removed FROM spans GROUP BY rid)
        SELECT doc_id, CAST(n AS BIGINT) AS n_bytes,
            CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
            CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
            sha256(unhex(kept.h)) AS kept_sha256
        FROM d JOIN kept ON kept.rid = d.rid LEFT JOIN cut ON cut.rid = d.rid
    """,
    "op4_quality_rules": f"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
                {WORDS.format("coalesce(text, '')")} AS w,
                list_filter(string_split(coalesce(text, ''), chr(10)),
                    lambda line: regexp_matches(line, '[^\\x20\\x09-\\x0D]')) AS lines
            FROM documents),
        starts AS (
            SELECT rid, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5),
        windows AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS s FROM starts),
        found AS (
            SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, s) AS c FROM windows)
            WHERE c > 1),
        places AS (SELECT DISTINCT rid, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS k FROM found),
        repeats AS (SELECT rid, count(*) AS n FROM places GROUP BY rid),
        m AS (
            SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
                coalesce(n, 0) AS n_repeat_words
            FROM d LEFT JOIN repeats ON repeats.rid = d.rid),
        ledger AS (
            SELECT *, CASE WHEN n_words < 10 THEN 1 ELSE 0 END
                + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
                + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END
                + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
                + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
                + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END AS failed
            FROM m)
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
            CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
            CAST(n_repeat_words AS BIGINT) AS n_repeat_words, failed & 3 <> 0 AS base_failed,
            failed = 0 AS kept, CAST(failed AS BIGINT) AS failed
        FROM ledger
    """,
    "op9_decontamination": rf"""
        WITH iw AS (
            SELECT *, least(5, len(w)) AS width
            FROM (SELECT DISTINCT item_id, text, {SPACED} AS w FROM benchmark WHERE text IS NOT NULL)
            WHERE len(w) > 0),
        items AS (
            SELECT DISTINCT item_id, text, width, unnest(list_transform(
                generate_series(1, len(w) - width + 1),
                lambda k: array_to_string(w[k:k + width - 1], ' '))) AS s
            FROM iw),
        sizes AS (SELECT item_id, text, count(*) AS n FROM items GROUP BY item_id, text),
        dw AS (SELECT row_number() OVER () AS rid, doc_id, {SPACED} AS w FROM documents),
        docs AS (
            SELECT DISTINCT rid, doc_id, width, unnest(list_transform(
                generate_series(1, len(w) - width + 1),
                lambda k: array_to_string(w[k:k + width - 1], ' '))) AS s
            FROM dw JOIN (SELECT DISTINCT width FROM iw) ON len(w) >= width),
        shared AS (
            SELECT item_id, text, rid, doc_id, count(*) AS c
            FROM items JOIN docs ON docs.s = items.s AND docs.width = items.width
            GROUP BY item_id, text, rid, doc_id)
        SELECT shared.item_id, doc_id, n AS n_shingles, c AS n_shared
        FROM shared JOIN sizes ON sizes.item_id IS NOT DISTINCT FROM shared.item_id
            AND sizes.text = shared.text
        WHERE 5 * c >= 4 * n
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n,
                sha256(coalesce(html, '')) AS h
            FROM pages),
        firsts AS (SELECT h, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY h)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.h AS payload_digest,
            CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END
                AS record_type,
            CASE WHEN first <> page_id THEN first END AS refers_to
        FROM p LEFT JOIN firsts ON firsts.h = p.h
    """,
    "op12_merkle_manifest": f"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, leaf, x, pos, size,
                CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS t
            FROM (SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY source) AS size
                FROM (SELECT doc_id, source, {leaf_hash("text")} AS leaf,
                    CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0
                        THEN {leaf_hash(LOWERED)} ELSE {leaf_hash("text")} END AS x
                    FROM documents)
                WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf))),
        {merkle_levels("low", "SELECT t, pos, leaf AS h, size FROM d", SOURCE_LEVELS)},
        sources AS (
            SELECT t AS source_t, h AS subroot, row_number() OVER (ORDER BY t) - 1 AS source_at
            FROM low{SOURCE_LEVELS}),
        {merkle_levels("top", "SELECT '*' AS t, source_at AS pos, subroot AS h, "
                       "count(*) OVER () AS size FROM sources", TOP_LEVELS)},
        leaves AS (SELECT rid, t, pos, x, '' AS proof FROM d),
        {merkle_climb("low", "leaves", SOURCE_LEVELS)},
        folded AS (
            SELECT rid, '*' AS t, source_at AS pos, x, proof, subroot
            FROM lowup{SOURCE_LEVELS - 1} JOIN sources ON source_t = t),
        {merkle_climb("top", "folded", TOP_LEVELS)}
        SELECT doc_id, leaf, subroot, top{TOP_LEVELS}.h AS root, sha256(c.proof) AS proof_sha256,
            c.x AS folded_root, c.x = top{TOP_LEVELS}.h AS verified
        FROM topup{TOP_LEVELS - 1} c JOIN d ON d.rid = c.rid JOIN folded ON folded.rid = c.rid
            CROSS JOIN top{TOP_LEVELS}
    """,
}

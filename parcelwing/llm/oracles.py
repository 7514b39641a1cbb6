"""SQL for DuckDB whose rows the registered queries must equal, where SQL can express them."""

from __future__ import annotations

LEVELS = 6      # of a source's tree: up to 16**6 rows; the tree over the sources has as many

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
_LOWER = "'abcdefghijklmnopqrstuvwxyz'"


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string, a byte at a time, by its reversed polynomial."""
    byte = ("list_reduce([xor(c, x)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], "
            "lambda v, bit: xor(v >> 1, 3988292384 * (v & 1)))")
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(({text})[i])::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, x: {byte}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _levels(name: str) -> str:
    """Nodes of each level, and those of every run of 16 as a list."""
    out = []
    for level in range(LEVELS):
        here, above = f"{name}{level}", f"{name}{level + 1}"
        out.append(f"{here}_runs AS MATERIALIZED (SELECT k, r // 16 AS r, n, list(h ORDER BY r) AS hs FROM {here} "
                   f"GROUP BY k, r // 16, n)")
        out.append(f"{above} AS MATERIALIZED (SELECT k, r, (n + 15) // 16 AS n, "
                   f"CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {here}_runs)")
    return ", ".join(out)


def _fold(name: str, runs: str, first: str, keep: str) -> str:
    """From level to level: the digest of a row's path, and its siblings."""
    out, last = [], first
    for level in range(LEVELS):
        at = f"{name}{level}"
        side = "array_to_string(hs[1:p.r % 16], '')", "array_to_string(hs[p.r % 16 + 2:], '')"
        out.append(f"{at} AS (SELECT {keep}, p.k, p.r // 16 AS r, "
                   f"CASE WHEN n > 1 THEN sha256({side[0]} || p.cur || {side[1]}) ELSE p.cur END AS cur, "
                   f"CASE WHEN n > 1 THEN p.sibs || {side[0]} || {side[1]} ELSE p.sibs END AS sibs "
                   f"FROM {last} p JOIN {runs}{level}_runs x ON x.k = p.k AND x.r = p.r // 16)")
        last = at
    return ", ".join(out)


def merkle() -> str:
    fields = [_field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = " || ".join([*fields, _field("text")])
    changed = " || ".join([*fields, _field(f"translate(text, {_UPPER}, {_LOWER})")])
    last = LEVELS - 1
    return f"""
    WITH rows_ AS MATERIALIZED (
        SELECT doc_id, coalesce('1' || source, '0') AS k, sha256({leaf}) AS leaf,
               CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN sha256({changed}) END AS changed
        FROM documents),
    placed AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
               count(*) OVER (PARTITION BY k) AS n FROM rows_),
    a0 AS (SELECT k, r, n, leaf AS h FROM placed),
    {_levels("a")},
    subroots AS MATERIALIZED (
        SELECT k AS source_key, h, row_number() OVER (ORDER BY k) - 1 AS r, count(*) OVER () AS n FROM a{LEVELS}),
    b0 AS (SELECT 0 AS k, r, n, h FROM subroots),
    {_levels("b")},
    p AS (SELECT doc_id, leaf, k, r, coalesce(changed, leaf) AS cur, '' AS sibs FROM placed),
    {_fold("p", "a", "p", "p.doc_id, p.leaf")},
    q AS (SELECT x.doc_id, x.leaf, s.h AS subroot, 0 AS k, s.r, x.cur, x.sibs
          FROM p{last} x JOIN subroots s ON s.source_key = x.k),
    {_fold("q", "b", "q", "p.doc_id, p.leaf, p.subroot")}
    SELECT x.doc_id, x.leaf, x.subroot, root.h AS root, sha256(x.sibs) AS proof_sha256, x.cur AS folded_root,
           x.cur = root.h AS verified
    FROM q{last} x CROSS JOIN b{LEVELS} AS root"""


def collocations(longest: int = 5, least: int = 100, top: int = 2000) -> str:
    words = "list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '')"
    return f"""
    WITH texts AS (
        SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), {_UPPER}, {_LOWER}) AS text FROM documents),
    pieces AS (
        SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\n\\x0B\\x0C\\r]')) AS piece FROM texts),
    runs AS MATERIALIZED (SELECT lang, {words} AS words FROM pieces),
    totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM runs GROUP BY lang),
    places AS (
        SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS place
        FROM runs CROSS JOIN range(1, {longest + 1}) AS sizes(size) WHERE len(words) >= size),
    found AS MATERIALIZED (
        SELECT lang, words[place:place + size - 1] AS words, any_value(size) AS size, count(*) AS f
        FROM places GROUP BY lang, words[place:place + size - 1] HAVING count(*) >= {least}),
    candidates AS MATERIALIZED (SELECT * FROM found WHERE size > 1),
    cuts AS (SELECT lang, words, f, size, unnest(range(1, size)) AS k FROM candidates),
    scored AS (
        SELECT c.lang, c.words, c.f AS a, c.k, x.f AS l, y.f AS r, t.n,
               (1000::HUGEINT * c.f * t.n // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM cuts c JOIN found x ON x.lang = c.lang AND x.words = c.words[1:c.k]
        JOIN found y ON y.lang = c.lang AND y.words = c.words[c.k + 1:] JOIN totals t ON t.lang = c.lang),
    weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
    lengths AS (SELECT lang, words, f, size, unnest(range(2, size)) AS k FROM candidates WHERE size > 2),
    inner_ AS (SELECT lang, words, f, k, unnest(range(1, size - k + 2)) AS place FROM lengths),
    around AS (SELECT lang, words[place:place + k - 1] AS words, max(f) AS f FROM inner_ GROUP BY ALL),
    kept AS (
        SELECT w.*, array_to_string(w.words, ' ') AS phrase FROM weakest w
        LEFT JOIN around o ON o.lang = w.lang AND o.words = w.words WHERE o.f IS NULL OR 100 * o.f < 100 * w.a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM kept QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {top}"""

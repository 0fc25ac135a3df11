"""The corpus queries that SQL can express, for DuckDB."""

from __future__ import annotations

# Kinds of secrets, how they are written, the group that counts and its fewest characters; the first three
# make up the base.
_KINDS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
    ("private_key", "-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----", 0, 27),
    ("bearer", "gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
)
_BASE = ("assign", "access", "hex")


def _spans(place: int, kind: str, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    value = f"length(regexp_extract(piece, '{pattern}', {group}))"
    return f"""
    SELECT b.text, '{kind}' AS kind, {place} AS place, sum(length(piece)) OVER (PARTITION BY b.text ORDER BY n) AS stop,
           length(regexp_extract(piece, '{pattern}')) AS matched, {value} >= {least} AS fits
    FROM (SELECT text, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS n
          FROM (SELECT text, regexp_extract_all(text, '(?s).*?(?:{pattern})') AS pieces FROM blobs)) AS b"""


def secret_scan_sql() -> str:
    spans = "\n    UNION ALL".join(_spans(place, *kind) for place, kind in enumerate(_KINDS))
    listed = "string_agg(kind || ':' || (stop - matched)::BIGINT || ':' || stop::BIGINT, ',' ORDER BY stop - matched, place)"
    counts = ", ".join(
        f"coalesce(n_{kind}, 0)::BIGINT AS n_{kind}" for kind in _BASE
    )
    per_kind = ", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in _BASE)
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
blobs AS (SELECT DISTINCT text FROM docs),
spans AS ({spans}),
per_blob AS (
    SELECT text, {per_kind}, count(*) AS n_spans,
           {listed} FILTER (place < {len(_BASE)}) AS base,
           {listed} AS spans
    FROM spans WHERE fits GROUP BY text)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_spans, 0)::BIGINT AS n_spans
FROM docs LEFT JOIN per_blob USING (text)"""


WARC_SQL = """
WITH raw AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (SELECT html, min(page_id) AS first, sha1(html) AS h, octet_length(encode(html)) AS n FROM raw GROUP BY html),
words AS (
    SELECT html, first, n, list_aggregate(
        list_transform(range(0, 8), lambda k: list_aggregate(
            list_transform([15, 10, 5, 0], lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(h, (5 * k + 1)::BIGINT, 5))::BIGINT >> b) & 31)::BIGINT + 1, 1)), 'string_agg', '')),
        'string_agg', '') AS digest
    FROM firsts)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM raw JOIN words USING (html)"""

FILTER_AUDIT_SQL = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM docs GROUP BY text),
marks AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
failing AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails
    FROM docs JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
cells AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
prefixes(prefix, letter, earlier) AS (
    SELECT '', '', ''
    UNION ALL
    SELECT prefix || l.letter, l.letter, prefix FROM prefixes JOIN letters AS l ON NOT contains(prefix, l.letter)),
steps AS (
    SELECT part, prefix, p.letter,
           coalesce(sum(n) FILTER (NOT touched AND NOT contains(fails, p.letter)), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (NOT touched AND contains(fails, p.letter)), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (touched AND contains(fails, p.letter)), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (fails = p.letter), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (NOT touched AND contains(fails, p.letter)), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (NOT touched AND contains(fails, p.letter)), 0)::BIGINT AS toxic_lost
    FROM (SELECT c.*, p.*, translate(fails, earlier, '') <> fails AS touched
          FROM cells AS c, prefixes AS p WHERE p.letter <> '') AS p
    GROUP BY part, prefix, p.letter)
SELECT part, o.prefix AS filter_order, length(s.prefix)::INTEGER AS step, letter, kept, removed, redundant, unique_fails,
       good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
FROM (SELECT prefix FROM prefixes WHERE length(prefix) = 5) AS o JOIN steps AS s ON starts_with(o.prefix, s.prefix)"""

HARD_NEGATIVES_SQL = """
WITH fine AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, list_dot_product(a.v, r.v)::BIGINT AS score
    FROM fine AS a JOIN fine AS r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER best::INTEGER AS rank, vec_id AS negative_id, positive_score,
       score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 10"""


SUBSTRING_DEDUP_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
words AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs),
starts AS (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM docs),
repeated AS (
    SELECT r, i FROM (SELECT r, i, array_to_string(words[i : i + 34], ' ') AS w FROM starts)
    QUALIFY count(*) OVER (PARTITION BY w) > 1),
covered AS (
    SELECT r, i, word, bool_or(d.i IS NOT NULL) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
    FROM words LEFT JOIN repeated AS d USING (r, i)),
kept AS (
    SELECT r, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text
    FROM covered GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)"""

# Windows of 2 to 4 words, the most frequent one's share of the characters; windows of 5 to 10, all repeats'.
_TOP = {2: 0.20, 3: 0.18, 4: 0.16}
_REPEATED = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}


def _covered(n: int, which: str, value: str, name: str) -> str:
    """Per text the sum of ``value`` over the words that windows of n words cover."""
    return f"""
{name} AS (
    SELECT r, sum({value}) FILTER (inside) AS n FROM (
        SELECT r, len, bool_or(coalesce({which}, false)) OVER (
            PARTITION BY r ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS inside
        FROM words LEFT JOIN (SELECT * FROM counted WHERE n = {n}) USING (r, i))
    GROUP BY r)"""


def quality_rules_sql() -> str:
    sizes = ", ".join(map(str, [*_TOP, *_REPEATED]))
    covered = ",".join(_covered(n, "nth > 1", "len", f"repeated_{n}") for n in _REPEATED)
    joins = " ".join(f"LEFT JOIN repeated_{n} USING (r)" for n in _REPEATED)
    tops = ", ".join(
        f"coalesce(max(CASE WHEN n = {n} AND best > 1999999999 THEN"
        f" least(1.0, ((best // 1000000000) * (best % 1000000000))::DOUBLE / word_chars) END), 0.0)::DOUBLE AS top_{n}"
        for n in _TOP
    )
    shares = ", ".join(f"coalesce(repeated_{n}.n::DOUBLE / word_chars, 0.0) AS repeated_{n}" for n in _REPEATED)
    limits = " AND ".join(
        [f"top_{n} <= {limit}::DOUBLE" for n, limit in _TOP.items()]
        + [f"repeated_{n} <= {limit}::DOUBLE" for n, limit in _REPEATED.items()]
    )
    names = ", ".join([f"top_{n}" for n in _TOP] + [f"repeated_{n}" for n in _REPEATED])
    return rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
words AS (
    SELECT r, i, length(word) AS len FROM (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs)),
sizes AS (SELECT r, sum(len)::BIGINT AS word_chars FROM words GROUP BY r),
windows AS (
    SELECT r, n, i, array_to_string(words[i : i + n - 1], ' ') AS w
    FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM docs, (SELECT unnest([{sizes}]) AS n))),
counted AS (
    SELECT r, n, i, length(w) - n + 1 AS chars, count(*) OVER (PARTITION BY r, n, w) AS times,
           row_number() OVER (PARTITION BY r, n, w ORDER BY i) AS nth
    FROM windows),
best AS (SELECT r, n, max(times * 1000000000 + chars) AS best FROM counted WHERE n <= {max(_TOP)} GROUP BY r, n),
tops AS (SELECT r, {tops} FROM best JOIN sizes USING (r) GROUP BY r),
lines AS (
    SELECT r, line, row_number() OVER (PARTITION BY r, line) AS nth,
           length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)),
doubled AS (
    SELECT r, count(*) AS n_dup_lines, sum(chars) AS dup_chars FROM lines WHERE nth > 1 AND chars > 0 GROUP BY r),
{covered},
{_covered(8, "times > 1", "1", "repeat_words")},
shares AS (
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(word_chars, 0) AS word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(repeat_words.n, 0)::BIGINT AS n_repeat_words,
           {", ".join(f"coalesce(top_{n}, 0.0) AS top_{n}" for n in _TOP)}, {shares},
           coalesce(dup_chars::DOUBLE / word_chars, 0.0) AS repeated_lines
    FROM docs LEFT JOIN sizes USING (r) LEFT JOIN tops USING (r) LEFT JOIN doubled USING (r)
         LEFT JOIN repeat_words USING (r) {joins})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {names}, repeated_lines,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND {limits} AND repeated_lines <= 0.20::DOUBLE AS kept
FROM shares"""

ORACLE_SQL = {"op8_quality_rules": quality_rules_sql(), "op4_secret_scan": secret_scan_sql(), "op7_warc": WARC_SQL, "op11_hard_negatives": HARD_NEGATIVES_SQL, "op12_filter_audit": FILTER_AUDIT_SQL, "op13_substring_dedup": SUBSTRING_DEDUP_SQL}

"""SQL twins of the operators' queries, in the dialect of the checking database; operators without one have brute-force tests."""

from __future__ import annotations

from clickmart.llm.queries import LISTED_WORDS, URL_RULES

WORD = r"[^\x20\x09-\x0D]+"


def spans(kind: str, place: int, pattern: str, keep: str, group: int = 0, of_group: bool = False) -> str:
    """Rows (doc_id, kind, place, s, e) of the matches of a pattern; ``keep`` is a condition on ``m`` and on the group ``v``.

    Positions are the lengths of what lies before: the pieces between the matches, and the matches. With ``of_group``
    the span is that of the group, which ends the match.
    """
    p = pattern.replace("'", "''")
    begin = "e - length(v)" if of_group else "e - length(m)"
    return f"""
        SELECT doc_id, '{kind}' AS kind, {place} AS place, {begin} AS s, e FROM (
            SELECT doc_id, found[i] AS m, v[i] AS v,
                   list_sum(list_transform(gaps[1:i], lambda x: length(x)))::BIGINT
                   + list_sum(list_transform(found[1:i], lambda x: length(x)))::BIGINT AS e
            FROM (
                SELECT doc_id, gaps, found, v, unnest(range(1, len(found) + 1)) AS i FROM (
                    SELECT doc_id, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}') AS found,
                           regexp_extract_all(t, '{p}', {group}) AS v
                    FROM texts))) WHERE {keep}"""


def digest(parts: list[str], base: list[str]) -> str:
    """One row per document from rows of ``spans``; documents are told apart by their row."""
    counts = ", ".join(f"coalesce(count(*) FILTER (kind = '{k}'), 0) AS n_{k}" for k in base)
    names = ", ".join(f"'{k}'" for k in base)
    written = "concat_ws(':', kind, s, e)"
    return f"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        spans AS ({" UNION ALL ".join(parts)}),
        per_doc AS (
            SELECT doc_id, {counts},
                   coalesce(string_agg({written}, ',' ORDER BY s, place) FILTER (kind IN ({names})), '') AS base,
                   string_agg({written}, ',' ORDER BY s, place) AS spans
            FROM spans GROUP BY doc_id)
        SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in base)},
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM documents LEFT JOIN per_doc USING (doc_id)"""


def any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


KEYWORDS = "|".join(any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + any_case("api") + "_?" + any_case("key")
OP1 = digest(
    [
        spans("assign", 1, rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "length(v) >= 12", 2),
        spans("access", 2, "AKIA[A-Z0-9]+", "length(m) >= 18"),
        spans("hex", 3, "[0-9a-f]+", "length(m) >= 16"),
        spans("private_key", 4, "-----BEGIN [A-Z ]*PRIVATE KEY-----", "true"),
        spans("web_token", 5, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "true"),
    ],
    ["assign", "access", "hex"],
)

ONLY_DIGITS = "string_split(regexp_replace(m, '[^0-9]', '', 'g'), '')"
LUHN = f"""list_sum(list_transform(range(1, len({ONLY_DIGITS}) + 1), lambda i:
    CASE WHEN (len({ONLY_DIGITS}) - i) % 2 = 0 THEN CAST({ONLY_DIGITS}[i] AS INT)
         WHEN CAST({ONLY_DIGITS}[i] AS INT) > 4 THEN CAST({ONLY_DIGITS}[i] AS INT) * 2 - 9
         ELSE CAST({ONLY_DIGITS}[i] AS INT) * 2 END)) % 10 = 0"""
CHECK_97 = """list_reduce(list_transform(string_split(substr(v, 5) || substr(v, 1, 4), ''),
        lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END),
        lambda a, x: (CASE WHEN x > 9 THEN a * 100 + x ELSE a * 10 + x END) % 97) = 1"""
OP7 = digest(
    [
        spans("email", 1, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
        spans(
            "ip", 2, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "list_bool_and(list_transform(string_split(m, '.'), lambda x: length(ltrim(x, '0')) < 4 AND TRY_CAST(x AS HUGEINT) <= 255))",
        ),
        spans("card", 3, r"[0-9]([\x20-]?[0-9])+", f"length(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 14 AND 19 AND {LUHN}"),
        spans("phone", 4, r"\+[0-9][\x20().0-9-]+[0-9]", "length(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 10 AND 15"),
        spans("login", 5, r"[A-Za-z][A-Za-z0-9+.-]*://[^\x20\x09-\x0D/?#@:]+:[^\x20\x09-\x0D/?#@]+@", "true"),
        spans(
            "account", 6, "(iban|IBAN|Iban)[ :#.]*([A-Z0-9]+)",
            rf"length(v) BETWEEN 15 AND 34 AND regexp_matches(v, '^[A-Z]{{2}}[0-9]{{2}}') AND {CHECK_97}", 2, True,
        ),
    ],
    ["email", "ip", "card", "phone"],
)

RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
CANONICAL = r"""CASE WHEN url LIKE '%://%' THEN
    concat_ws('?',
        regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', ''),
        CASE WHEN len(kept) > 0 THEN array_to_string(list_sort(kept), '&') END) END"""
OP3 = rf"""
    WITH rules(host, path, verdict) AS (VALUES {RULE_ROWS}),
    parted AS (
        SELECT page_id, url,
               coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
               list_filter(string_split(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
                   lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_|ref=)')) AS kept
        FROM pages),
    named AS (SELECT *, {CANONICAL} AS canonical FROM parted),
    listed AS (SELECT DISTINCT canonical FROM named WHERE list_has_any(string_split_regex(host, '[.-]'), {LISTED_WORDS})),
    fitting AS (
        SELECT p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
               arg_max(r.verdict, length(r.host || r.path)) AS verdict
        FROM named p JOIN rules r
          ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
        GROUP BY p.page_id)
    SELECT p.page_id, p.host, p.path, f.rule,
           coalesce(f.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
           l.canonical IS NOT NULL AS is_listed
    FROM named p LEFT JOIN fitting f USING (page_id) LEFT JOIN listed l ON l.canonical = p.canonical"""

OP5 = rf"""
    WITH sized AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
               md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o
        FROM documents),
    sources AS (
        SELECT source, source_size, [3, 1, 2][1 + place % 3] AS w FROM (
            SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
            FROM sized GROUP BY source)),
    total AS (SELECT 1.5::DOUBLE * sum(source_size) AS budget, sum(w) AS weight FROM sources),
    filled AS (
        SELECT *, 2.0::DOUBLE * source_size AS cap,
               coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0) AS cap_before,
               coalesce(sum(w) OVER before, 0) AS w_before
        FROM sources WINDOW before AS (
            ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    clamped AS (
        SELECT f.*, w * (budget - cap_before) > cap * (weight - w_before) AS above FROM filled f, total),
    level AS (
        SELECT (SELECT budget FROM total) - coalesce(sum(cap) FILTER (above), 0) AS rest,
               (SELECT weight FROM total) - coalesce(sum(w) FILTER (above), 0) AS weight
        FROM clamped),
    targets AS (
        SELECT source, source_size,
               CASE WHEN above THEN cap ELSE w::DOUBLE * rest::DOUBLE / level.weight::DOUBLE END AS target
        FROM clamped, level),
    shares AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets),
    placed AS (
        SELECT d.doc_id, d.source, d.size, s.source_size, s.target, s.whole,
               round(s.target - s.whole * s.source_size)::BIGINT AS rest,
               coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.doc_id, d.size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
        FROM sized d JOIN shares s ON s.source IS NOT DISTINCT FROM d.source)
    SELECT doc_id, size, source_size, target, source,
           (whole * size + greatest(0, least(size, rest - before)))::BIGINT AS taken
    FROM placed"""

BITS = "array_to_string(list_transform(string_split(sha1(h), ''), lambda c: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', c)]), '')"
BASE32 = f"""array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
    16 * CAST(substr({BITS}, 5 * i + 1, 1) AS INT) + 8 * CAST(substr({BITS}, 5 * i + 2, 1) AS INT)
    + 4 * CAST(substr({BITS}, 5 * i + 3, 1) AS INT) + 2 * CAST(substr({BITS}, 5 * i + 4, 1) AS INT)
    + CAST(substr({BITS}, 5 * i + 5, 1) AS INT), 1)), '')"""
OP6 = f"""
    WITH held AS (
        SELECT page_id, h, max(page_id) OVER (PARTITION BY h) AS holder FROM (
            SELECT page_id, coalesce(html, '') AS h FROM pages))
    SELECT page_id, strlen(h)::BIGINT AS payload_bytes, {BASE32} AS payload_digest,
           CASE WHEN page_id IS NOT DISTINCT FROM holder THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM holder THEN holder END AS refers_to
    FROM held"""

OP8 = rf"""
    WITH RECURSIVE low AS (
        SELECT doc_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
        FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, unnest(
            CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                 ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
        FROM low WHERE w IS NOT NULL),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
    reach(doc_id, seen) AS (
        SELECT a, a FROM links UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.seen)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least(c.least, d.doc_id), d.doc_id) AS component_id
    FROM documents d LEFT JOIN sizes USING (doc_id)
    LEFT JOIN (SELECT doc_id, min(seen) AS least FROM reach GROUP BY doc_id) c USING (doc_id)"""


# CRC-32 of hexadecimal bytes: its table of 256 remainders, one step for each bit, and one step a byte through it.
CRC_TABLE = """list_transform(range(0, 256), lambda i: list_reduce(list_prepend(i::BIGINT, range(0, 8)),
        lambda c, bit: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"""


def crc32(text: str, table: str = "remainders") -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of ``text``, given the column with the table."""
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295, {codes}),
        lambda c, b: xor(c >> 8, {table}[1 + (xor(c, b) & 255)])))"""


OP12 = rf"""
    WITH crc AS (SELECT {CRC_TABLE} AS remainders),
    numbered AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS p, k, w FROM (
            SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
                   len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS w
            FROM conversations WHERE conv_id IS NOT NULL)),
    ids AS (
        SELECT conv_id, {crc32("conv_id::VARCHAR")} % 4 AS h, conv_id - conv_id % 20 AS base
        FROM (SELECT DISTINCT conv_id FROM numbered), crc),
    turns AS (
        SELECT i.conv_id, p AS place, k, w FROM ids i JOIN numbered n ON n.conv_id = i.base AND p <= h
        UNION ALL SELECT i.conv_id, p + 10, k, w FROM ids i JOIN numbered n ON n.conv_id = i.conv_id AND p > h),
    members AS (
        SELECT conv_id, row_number() OVER o AS depth, w, string_agg(k, '') OVER o AS prefix
        FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY place)
        UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
    nodes AS (SELECT prefix, depth, min(conv_id) AS least, count(*) AS n, max(w) AS w FROM members GROUP BY ALL),
    children AS (
        SELECT left(prefix, 32 * (depth - 1)) AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
    full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (prefix)),
    owned AS (
        SELECT conv_id, prefix, depth,
               sum(CASE WHEN conv_id = least AND n_children = 0 THEN 1 ELSE 0 END) OVER o AS leaves,
               sum(CASE WHEN conv_id = least THEN (n - 1) * f.w ELSE 0 END) OVER o AS saved,
               depth = max(depth) OVER (PARTITION BY conv_id) AS ends
        FROM members JOIN full_nodes f USING (prefix, depth) WINDOW o AS (PARTITION BY conv_id ORDER BY depth DESC)),
    sums AS (
        SELECT prefix, sum(leaves)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
        FROM owned GROUP BY prefix)
    SELECT f.least AS conv_id, f.depth::BIGINT AS depth, above.least AS parent_conv_id, f.n AS n_convs, f.n_children, n_leaves, saved_tokens, ends_sha256
    FROM full_nodes f JOIN sums USING (prefix)
    LEFT JOIN full_nodes above ON f.depth > 0 AND above.depth = f.depth - 1 AND above.prefix = left(f.prefix, 32 * (f.depth - 1))"""

OP13 = f"""
    WITH crc AS (SELECT {CRC_TABLE} AS remainders),
    texts AS (
        SELECT coalesce(text, '') AS t, count(*) AS copies FROM documents GROUP BY ALL),
    sums AS (SELECT t, {crc32("t")} AS text_crc32 FROM texts, crc),
    sized AS (
        SELECT doc_id, text_crc32, strlen(t)::BIGINT + 16 AS size, md5(t) AS k, coalesce(md5(CAST(doc_id AS VARCHAR)), '') AS w
        FROM documents JOIN sums ON t = coalesce(text, '')),
    placed AS (
        SELECT *, row_number() OVER o AS place,
               coalesce(sum(size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
               sum(size) OVER (PARTITION BY k)::BIGINT AS held, sum(size) OVER ()::BIGINT AS total
        FROM sized WINDOW o AS (ORDER BY k, w)),
    units AS (SELECT *, min(before) OVER (PARTITION BY k) AS start FROM placed),
    numbered AS (
        SELECT *, least(39, floor(
            (CASE WHEN held <= 0.05::DOUBLE * total / 40 THEN start + held / 2 ELSE before + size / 2 END) * 40 / total))::INT AS shard
        FROM units)
    SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
           place - min(place) OVER (PARTITION BY shard) AS slot, NULL::INT AS grown_shard
    FROM numbered"""


def oracle() -> dict[str, str]:
    return {
        "op1_secret_scan": OP1,
        "op3_url_filter": OP3,
        "op5_mixing": OP5,
        "op6_warc": OP6,
        "op7_pii": OP7,
        "op8_ngram_jaccard": OP8,
        "op12_prefix_trie": OP12,
        "op13_sharding": OP13,
    }

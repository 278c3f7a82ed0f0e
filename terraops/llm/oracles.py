"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from terraops.llm import personal_data as pd_
from terraops.llm.filter_audit import FILTERS

# --- op11: each pattern's matches and the gaps between them are unnested side by side; positions are windows over their lengths


def _rows(source: str, pattern: str) -> str:
    """(r, m, a, last, first) of the matches in source (r, o, t, l0, f0)."""
    return f"""SELECT r, m, o + sum(length(gb) + length(m)) OVER (PARTITION BY r, o ORDER BY i) - length(m) AS a,
        right(CASE WHEN i = 1 THEN l0 ELSE '' END || right(gb, {pd_.BEFORE}), {pd_.BEFORE}) AS last, left(left(ga, {pd_.AFTER}) || CASE WHEN i = n THEN f0 ELSE '' END, {pd_.AFTER}) AS first
        FROM (SELECT r, o, l0, f0, n, generate_subscripts(found, 1) AS i, unnest(found) AS m, unnest(g[1:n]) AS gb, unnest(g[2:n + 1]) AS ga
            FROM (SELECT *, len(found) AS n FROM (SELECT *, regexp_extract_all(t, '{pattern}') AS found, string_split_regex(t, '{pattern}') AS g FROM {source})) WHERE n > 0)"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda k: CASE WHEN k % 2 = 1 THEN CAST(substr(reverse({_DIGITS}), k, 1) AS INT)
    ELSE CAST(substr(reverse({_DIGITS}), k, 1) AS INT) * 2 - CASE WHEN CAST(substr(reverse({_DIGITS}), k, 1) AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""
_APART = "NOT regexp_matches(last, '[0-9]$') AND NOT regexp_matches(first, '^[0-9]')"
_OCTET = "0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": pd_.PHONE.pattern,
    "iban": pd_.IBAN.pattern,
    "ssn": pd_.SSN.pattern,
}


def _score(rule: pd_.Rule) -> str:
    near = lambda words: f"regexp_matches(lower(last || chr(10) || first), '(^|[^a-z])({words})([^a-z]|$)')"
    against = f" - CASE WHEN {near(rule.against)} THEN {pd_.AGAINST} ELSE 0 END" if rule.against else ""
    return f"greatest(0, least(100, {rule.score} + CASE WHEN {near(rule.words)} THEN {pd_.FOR} ELSE 0 END{against}))"


def _spans(rule: pd_.Rule, source: str, base: bool) -> str:
    return f"SELECT r, '{rule.kind}' AS kind, {pd_.KINDS.index(rule.kind)} AS rank, a, a + length(m) AS b, {base} AS base, {_score(rule)} AS score FROM {source}"


_LENGTHS = "MAP {" + ", ".join(f"'{k}': {v}" for k, v in pd_.IBAN_LENGTHS.items()) + "}"
_CODE = "replace(m, ' ', '')"
_PARTS = [
    ("email_ok", "SELECT * FROM email", pd_.EMAIL, True),
    ("ip_ok", f"SELECT * FROM ip WHERE regexp_full_match(m, '{_OCTET}\\.{_OCTET}\\.{_OCTET}\\.{_OCTET}')", pd_.IP, True),
    ("card_ok", "SELECT * FROM card WHERE ok", pd_.CARD, True),
    ("phone_ok", "SELECT * FROM phone WHERE ok", pd_.PHONE, True),
    ("iban_ok", f"""SELECT r, a, last, first, m FROM (SELECT r, a, last, first, m AS whole, regexp_extract(m, '^([A-Z0-9]\\x20?){{' || CAST(n - 1 AS VARCHAR) || '}}[A-Z0-9]') AS m FROM (SELECT *, {_LENGTHS}[left(m, 2)] AS n FROM iban) WHERE n IS NOT NULL)
        WHERE m <> '' AND NOT regexp_matches(last, '[A-Za-z0-9]$') AND NOT regexp_matches(substr(whole, length(m) + 1) || first, '^[A-Za-z0-9]')
        AND list_reduce(list_prepend(0::BIGINT, list_transform(string_split(substr({_CODE}, 5) || left({_CODE}, 4), ''), lambda ch: CASE WHEN ch BETWEEN '0' AND '9' THEN ascii(ch) - 48 ELSE ascii(ch) - 55 END)), lambda s, v: (s * CASE WHEN v < 10 THEN 10 ELSE 100 END + v) % 97) = 1""", pd_.IBAN, False),
    ("ssn_ok", "SELECT * FROM ssn WHERE NOT regexp_matches(last, '[0-9-]$') AND NOT regexp_matches(first, '^[0-9-]') AND NOT regexp_matches(m, '^(000|666|9)|-00-|-0000$')", pd_.SSN, False),
    ("card_in", f"SELECT * FROM ({_rows('(SELECT r, a AS o, m AS t, last AS l0, first AS f0 FROM card WHERE NOT ok AND length(m) >= 13)', pd_.CARD_WITHIN.pattern)}) WHERE {_APART} AND length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}", pd_.CARD_WITHIN, False),
    ("phone_in", f"""SELECT * FROM (SELECT r, m, a, last, left(left(substr(whole, length(m) + 1), {pd_.AFTER}) || first, {pd_.AFTER}) AS first FROM (SELECT r, a, last, first, m AS whole, regexp_extract(m, '{pd_.PHONE_WITHIN.pattern}') AS m FROM phone WHERE NOT ok AND length(m) >= 10) WHERE m <> '')
        WHERE {_APART} AND length({_DIGITS}) BETWEEN 10 AND 15""", pd_.PHONE_WITHIN, False),
]
_OK = {"card": f"CASE WHEN length({_DIGITS}) BETWEEN 14 AND 19 THEN {_LUHN} ELSE false END", "phone": f"length({_DIGITS}) BETWEEN 10 AND 15"}
_TEXTS = "SELECT row_number() OVER () AS r, doc_id, 0::BIGINT AS o, coalesce(text, '') AS t, '' AS l0, '' AS f0 FROM documents"
_TABLES = [f"doc AS MATERIALIZED ({_TEXTS})"]
_TABLES += [f"{kind} AS ({_rows('doc', pattern)})" if kind not in _OK else f"{kind} AS (SELECT *, {_OK[kind]} AS ok FROM ({_rows('doc', pattern)}))" for kind, pattern in _PLAIN.items()]
_TABLES += [f"{name} AS ({body})" for name, body, _, _ in _PARTS]
_UNION = " UNION ALL ".join(f"SELECT * FROM ({_spans(rule, name, base)})" + ("" if base else f" WHERE score >= {pd_.ACCEPTED}") for name, _, rule, base in _PARTS)
_JOINED = "string_agg(kind || ':' || CAST(a AS VARCHAR) || ':' || CAST(b AS VARCHAR), ',' ORDER BY a, rank, b)"
PERSONAL_DATA = f"""WITH {", ".join(_TABLES)}, span AS ({_UNION}),
found AS (SELECT r, {", ".join(f"count(*) FILTER (base AND kind = '{k}') AS n_{k}" for k in pd_.KINDS[:4])}, {_JOINED} FILTER (base) AS bases, {_JOINED} AS spans, string_agg(CAST(score AS VARCHAR), ',' ORDER BY a, rank, b) AS scores FROM span GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in pd_.KINDS[:4])}, sha256(coalesce(bases, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores FROM doc LEFT JOIN found USING (r)"""

# --- op12: a row for each order and step, its filter's bit and the bits of the filters before it
_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
_LETTERS = ", ".join(f"('{f}', {1 << k})" for k, f in enumerate(FILTERS))
_NAMES = [f"f{k}" for k in range(len(FILTERS))]
_OTHERS = " AND ".join(f"{a}.f <> {b}.f" for k, a in enumerate(_NAMES) for b in _NAMES[:k])
_STEPS = " UNION ALL ".join(f"SELECT filter_order, {k + 1} AS step, b{k} AS b, {' + '.join(['0', *[f'b{j}' for j in range(k)]])} AS before FROM orders" for k in range(len(FILTERS)))
FILTER_AUDIT = f"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS} AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
m AS (SELECT doc_id, part, CASE WHEN len(words) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
s AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
letter AS (SELECT * FROM (VALUES {_LETTERS}) v(f, b)),
orders AS (SELECT {" || ".join(f"{n}.f" for n in _NAMES)} AS filter_order, {", ".join(f"f{k}.b AS b{k}" for k in range(len(FILTERS)))} FROM {", ".join(f"letter {n}" for n in _NAMES)} WHERE {_OTHERS}),
steps AS ({_STEPS}),
r AS (SELECT part, filter_order, step, b, sum(CASE WHEN mask & (before | b) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & before = 0 AND mask & b <> 0 THEN n ELSE 0 END) AS removed, sum(CASE WHEN mask & before <> 0 AND mask & b <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = b THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN mask & before = 0 AND mask & b <> 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & before = 0 AND mask & b <> 0 THEN toxic ELSE 0 END) AS toxic_lost FROM s, steps GROUP BY part, filter_order, step, b)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))}, CAST(sum(removed) OVER (PARTITION BY part, b) AS BIGINT) AS shapley FROM r"""

# --- op13: the rounds one by one
_FAR = "CAST(list_sum(list_transform(range(1, 65), lambda i: (v.c[i] - k.c[i]) * (v.c[i] - k.c[i]))) AS BIGINT)"
_ROUND = """a{n} AS MATERIALIZED (SELECT vec_id, c, cluster, distance FROM (SELECT v.vec_id, v.c, k.cluster, {far} AS distance FROM v, c{n} k) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)"""
_MEANS = """c{m} AS MATERIALIZED (SELECT k.cluster, coalesce(new.c, k.c) AS c FROM c{n} k LEFT JOIN (SELECT cluster, list(mean ORDER BY i) AS c FROM (SELECT cluster, i, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS mean
    FROM (SELECT cluster, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM a{n}) GROUP BY cluster, i) GROUP BY cluster) new USING (cluster))"""
_ROUNDS = ", ".join(_ROUND.format(n=n, far=_FAR) + ("" if n == 3 else ", " + _MEANS.format(n=n, m=n + 1)) for n in range(4))
CLUSTERS = f"""WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS c FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, c FROM (SELECT *, sha256('1:' || CAST(vec_id AS VARCHAR)) AS h FROM v ORDER BY h LIMIT 16)), {_ROUNDS}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.c, ',')) AS centroid_sha256 FROM a3 JOIN c3 k USING (cluster)"""

ORACLE_SQL = {"op11_checked_personal_data": PERSONAL_DATA, "op12_filter_order_diagrams": FILTER_AUDIT, "op13_bit_plane_clusters": CLUSTERS}

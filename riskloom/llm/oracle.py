"""DuckDB SQL for the registered operators that SQL can express.

The others (tokenizers, suffix arrays, archives, shard plans and MinHash
keys) are held against brute force in ``tests/llm``.
"""

from __future__ import annotations

_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""


def _matches(kinds: dict[str, tuple[str, str, str]]) -> str:
    """CTE ``s``: (doc_id, rank, kind, b, e) of the matches of each pattern that hold.

    Positions come from the lengths of the matches and of the text between
    them.  ``kinds``: kind -> (pattern, condition on m and g, group for g).
    """
    parts = []
    for rank, (kind, (pattern, holds, group)) in enumerate(kinds.items()):
        p = pattern.replace("'", "''")
        parts.append(f"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, found[i] AS m, inside[i] AS g,
    CAST(list_sum(list_transform(parts[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS b
  FROM (SELECT doc_id, found, parts, inside, unnest(range(1, len(found) + 1)) AS i FROM (
    SELECT doc_id, regexp_extract_all(t, '{p}') AS found, string_split_regex(t, '{p}') AS parts, regexp_extract_all(t, '{p}', {group}) AS inside FROM d))
  WHERE {holds.replace("{m}", "found[i]").replace("{g}", "inside[i]")}""")
    return "s AS (SELECT doc_id, rank, kind, b, b + length(m) AS e FROM (" + "\n  UNION ALL".join(parts) + "))"


_SECRETS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "length({g}) >= 6", "1"),
    "access": (r"AKIA[A-Z0-9]+", "length({m}) >= 20", "0"),
    "hex": (r"[0-9a-f]+", "length({m}) >= 24", "0"),
    "pem": (r"-----BEGIN (?:RSA |EC |OPENSSH |DSA )?PRIVATE KEY-----", "true", "0"),
    "hosted": (r"\bgh[pousr]_[A-Za-z0-9]{36,}", "true", "0"),
}

_D = "replace(replace({m}, ' ', ''), '-', '')"
_V = f"CAST(substr({_D}, length({_D}) - j + 1, 1) AS INTEGER) * (1 + (j - 1) % 2)"
_LUHN = f"list_sum(list_transform(range(1, length({_D}) + 1), lambda j: ({_V}) // 10 + ({_V}) % 10)) % 10 = 0"
_I = "replace({m}, ' ', '')"
_MOD97 = (
    f"CASE WHEN length({_I}) BETWEEN 15 AND 34 THEN list_reduce(list_transform(string_split(substr({_I}, 5) || substr({_I}, 1, 4), ''), "
    "lambda x: CASE WHEN x BETWEEN '0' AND '9' THEN ascii(x) - 48 ELSE ascii(x) - 55 END), "
    "lambda a, v: (CASE WHEN v > 9 THEN a * 100 ELSE a * 10 END + v) % 97) = 1 ELSE false END"
)
_PERSONAL = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", "0"),
    "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "list_bool_and(list_transform(string_split({m}, '.'), lambda x: coalesce(TRY_CAST(x AS HUGEINT) <= 255, false)))", "0"),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", f"CASE WHEN length({_D}) BETWEEN 16 AND 19 THEN {_LUHN} ELSE false END", "0"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "length(regexp_replace({m}, '[^0-9]', '', 'g')) BETWEEN 8 AND 15", "0"),
    "iban": (r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b", _MOD97, "0"),
    "ssn": (r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "substr({m}, 1, 3) NOT IN ('000', '666') AND substr({m}, 1, 1) <> '9'", "0"),
}
# kind -> score, added near a context word, the words
_SCORES = {
    "email": ("0.8", "0.2", "mail|contact|write"),
    "ip": ("0.5", "0.4", "ip|server|host|address"),
    "card": ("0.8", "0.2", "card|visa|credit|pay"),
    "phone": ("0.6", "0.3", "phone|call|tel|mobile|fax"),
    "iban": ("0.9", "0.1", "iban|bank|account"),
    "ssn": ("0.3", "0.5", "ssn|social security|social insurance"),
}
_NEAR = "lower(substr(t, greatest(b - 39, 1), least(b, 40) + e - b + 40))"
_SCORE = "CASE kind " + " ".join(f"WHEN '{k}' THEN {a} + CASE WHEN regexp_matches({_NEAR}, '{w}') THEN {m} ELSE 0 END" for k, (a, m, w) in _SCORES.items()) + " END"

_JOINED = "string_agg(concat(kind, ':', b, ':', e), ',' ORDER BY {order}){where}"

ORACLE: dict[str, str] = {
    "op2_minhash": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sh AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n, list_sort(s) AS s FROM sh),
x AS (SELECT doc_id, unnest(s) AS g FROM n),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * common >= 80 * (p.n + q.n - common)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS node, a AS seen FROM both_ways UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.seen),
low AS (SELECT node, min(seen) AS low FROM reach GROUP BY node)
SELECT doc_id, n AS n_shingles, coalesce(low, doc_id) AS component_id, coalesce(low, doc_id) = doc_id AS kept
FROM n LEFT JOIN low ON node = doc_id""",
    "op3_pii": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{_matches(_PERSONAL)},
c AS (SELECT s.*, CAST({_SCORE} AS DOUBLE) AS score FROM s JOIN d ON d.doc_id = s.doc_id),
a AS (SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in ("email", "ip", "card", "phone"))},
    {_JOINED.format(order="rank, b", where=" FILTER (WHERE rank < 4)")} AS base, {_JOINED.format(order="rank, b", where="")} AS spans,
    list(score ORDER BY rank, b) AS scores
  FROM c WHERE rank < 4 OR score >= 0.6 GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in ("email", "ip", "card", "phone"))},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, []) AS scores
FROM d LEFT JOIN a ON a.doc_id = d.doc_id""",
    "op8_secrets": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{_matches(_SECRETS)},
a AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex, {_JOINED.format(order="b, rank", where=" FILTER (WHERE rank < 3)")} AS base,
    {_JOINED.format(order="b, rank", where="")} AS spans
  FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON a.doc_id = d.doc_id""",
    "op9_decontamination": r"""
WITH i AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
it AS (SELECT item_id, len(w) AS n, least(len(w), 5) AS k, list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda j: array_to_string(w[j:j + least(len(w), 5) - 1], ' ')) AS s FROM i WHERE len(w) > 0),
d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
ds AS (SELECT doc_id, len(w) AS words, unnest(range(1, len(w) - 3)) AS p, w FROM d WHERE len(w) >= 5),
hit AS (SELECT DISTINCT doc_id, words, item_id, n, greatest(0, least(p - place, words - n)) AS start
  FROM (SELECT doc_id, words, p, array_to_string(w[p:p + 4], ' ') AS g FROM ds)
  JOIN (SELECT item_id, n, unnest(s) AS g, unnest(range(1, len(s) + 1)) AS place FROM it WHERE k = 5) USING (g)),
win AS (SELECT h.doc_id, h.item_id, h.start, unnest(range(h.start + 1, least(h.start + h.n, h.words) - 3)) AS p FROM hit h),
wc AS (SELECT win.doc_id, item_id, start, array_to_string(w[p:p + 4], ' ') AS g, count(*) AS c FROM win JOIN d ON d.doc_id = win.doc_id GROUP BY ALL),
nw AS (SELECT doc_id, item_id, start, sum(c) AS nw FROM wc GROUP BY ALL),
ic AS (SELECT item_id, g, count(*) AS c FROM (SELECT item_id, unnest(s) AS g FROM it) GROUP BY ALL),
ni AS (SELECT item_id, sum(c) AS ni FROM ic GROUP BY ALL),
both_ AS (SELECT wc.doc_id, wc.item_id, wc.start, sum(least(wc.c, ic.c)) AS b FROM wc JOIN ic ON ic.item_id = wc.item_id AND ic.g = wc.g GROUP BY ALL),
sim AS (SELECT doc_id, item_id, max(CAST(b AS DOUBLE) / CAST(nw + ni - b AS DOUBLE)) AS s FROM both_ JOIN nw USING (doc_id, item_id, start) JOIN ni USING (item_id) GROUP BY ALL),
a AS (SELECT doc_id, count(*) AS n, list_sort(list(item_id)) AS ids, max(s) AS best FROM sim WHERE s >= 0.8 GROUP BY doc_id)
SELECT documents.doc_id, n IS NOT NULL AS leaked, coalesce(n, 0) AS n_items, coalesce(ids, []) AS item_ids, best AS similarity
FROM documents LEFT JOIN a ON a.doc_id = documents.doc_id""",
    "op11_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT row, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT row) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
groups AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c
  FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN (SELECT lang, source, term, count(*) AS c FROM t GROUP BY ALL) x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
gp AS (SELECT cells.lang, source, term, c, 1 + CAST(1000000000 AS HUGEINT) * (c + 2) // (sum(c) OVER (PARTITION BY cells.lang, source) + 2 * v) AS p FROM cells JOIN v ON v.lang = cells.lang),
lp AS (SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (c + 2) // (sum(c) OVER (PARTITION BY lang) + 2 * v) AS q
  FROM (SELECT cells.lang, term, sum(c) AS c, any_value(v) AS v FROM cells JOIN v ON v.lang = cells.lang GROUP BY ALL)),
pairs AS (SELECT a.lang, a.source, b.source AS item FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM gp a JOIN gp b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
parts AS (
  SELECT pairs.lang, pairs.source, 'pair' AS part, pairs.item, coalesce(value, 0) AS value
  FROM pairs LEFT JOIN sums ON sums.lang = pairs.lang AND sums.source = pairs.source AND sums.item = pairs.item
  UNION ALL
  SELECT gp.lang, source, 'term', gp.term, (p - q) * (p - q) // (p + q) FROM gp JOIN lp ON lp.lang = gp.lang AND lp.term = gp.term WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts) WHERE part = 'pair' OR rank <= 10""",
    "op12_resampling": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
x AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word FROM w), bw AS (SELECT unnest(w) AS word FROM x),
tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END)) AS tab),
words AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
crc AS (SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), CAST(4294967295 AS BIGINT)) % 10000 AS bucket FROM words, tab),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN crc ON crc.word = dw.word GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN crc ON crc.word = bw.word GROUP BY 1),
g AS (SELECT s.bucket, CAST(floor(CAST(1000 AS DOUBLE) * ln((CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST((SELECT sum(s) FROM s) + 10000 AS DOUBLE))
    / (CAST(s + 1 AS DOUBLE) * CAST(coalesce((SELECT sum(t) FROM t), 0) + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM s LEFT JOIN t ON t.bucket = s.bucket),
f AS (SELECT doc_id, count(*) AS n, sum(gain) AS weight FROM dw JOIN crc ON crc.word = dw.word JOIN g ON g.bucket = crc.bucket GROUP BY 1),
r AS (SELECT documents.doc_id, coalesce(n, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(floor(CAST(-1000 AS DOUBLE) * ln(-ln((CAST('0x' || substr(sha256('2024:' || documents.doc_id), 1, 8) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS noise
  FROM documents LEFT JOIN f ON f.doc_id = documents.doc_id),
o AS (SELECT doc_id, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS place, count(*) OVER () AS n FROM r WHERE n_features >= 20)
SELECT r.doc_id, n_features, weight, weight + noise AS score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM r LEFT JOIN o ON o.doc_id = r.doc_id""",
    "op13_chat": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(regexp_replace(regexp_replace(role, '<(~*/?s>)', '<~\1', 'g'), '\[(~*(?:/?INST|IMG|AUDIO|DOC)\])', '[~\1', 'g'))
    + length(regexp_replace(regexp_replace(text, '<(~*/?s>)', '<~\1', 'g'), '\[(~*(?:/?INST|IMG|AUDIO|DOC)\])', '[~\1', 'g')) + 17 AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) + 3 AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
}

"""SQL for DuckDB with the rows of those queries that SQL can express."""

from __future__ import annotations

import math

from quire.llm import chat_format, quality_rules, substring_dedup, url_filter

_WORDS = r"list_filter(string_split_regex(coalesce({}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


DECONTAMINATE = f"""WITH dw AS (SELECT doc_id, {_WORDS.format(_LOWER.format('text'))} AS ws FROM documents), iw AS (SELECT item_id, {_WORDS.format(_LOWER.format('text'))} AS ws FROM benchmark),
ds AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_transform(range(1, greatest(2, len(ws) - 3)), lambda i: array_to_string(list_slice(ws, i, i + 4), ' ')) END AS hs FROM dw),
it AS (SELECT item_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_transform(range(1, greatest(2, len(ws) - 3)), lambda i: array_to_string(list_slice(ws, i, i + 4), ' ')) END AS item FROM iw),
p AS (SELECT doc_id, unnest(hs) AS h, generate_subscripts(hs, 1) - 1 AS pos, len(hs) AS size FROM ds), k AS (SELECT item_id, unnest(list_distinct(item)) AS h, len(item) AS n FROM it),
s AS (SELECT DISTINCT doc_id, item_id, n, greatest(0, least(pos, size - n)) AS start FROM p JOIN k USING (h)),
w AS (SELECT s.doc_id, s.item_id, start, list_slice(hs, start + 1, start + n) AS win, item FROM s JOIN ds ON ds.doc_id = s.doc_id JOIN it ON it.item_id = s.item_id),
c AS (SELECT doc_id, item_id, start, coalesce(list_sum(list_transform(list_distinct(list_intersect(win, item)), lambda x: least(len(list_filter(win, lambda y: y = x)), len(list_filter(item, lambda z: z = x))))), 0) AS shared, len(win) + len(item) AS total FROM w),
e AS (SELECT doc_id, item_id, start, CAST(shared AS DOUBLE) / CAST(total - shared AS DOUBLE) AS similarity FROM c)
SELECT doc_id, item_id, max(similarity) AS similarity, arg_max(-start, similarity * 1e9 - start) * -1 AS first_shingle FROM e WHERE similarity >= 0.8 GROUP BY ALL"""


def _limits() -> str:
    out = []
    for ratio, floor in quality_rules.FLOORS.items():
        out.append(f"max(q3 + {quality_rules.SPREAD} * greatest(q3 - q1, {floor})) FILTER (WHERE ratio = '{ratio}') AS most_{ratio}")
    length = quality_rules.FLOORS["length"]
    return ", ".join([*out, f"max(q1 - {quality_rules.SPREAD} * greatest(q3 - q1, {length})) FILTER (WHERE ratio = 'length') AS least_length"])


_P = f"(1::BIGINT << greatest(0, length(bin(v)) - {quality_rules.DIGITS}))"
QUALITY_RULES = rf"""WITH w AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text, {_WORDS.format('text')} AS ws FROM documents),
ln AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w), lc AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
u AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w), t AS (SELECT r, i, word || ' ' || lead(word) OVER (PARTITION BY r ORDER BY i) || ' ' || lead(word, 2) OVER (PARTITION BY r ORDER BY i) AS tri FROM u),
d AS (SELECT r, i, count(*) OVER (PARTITION BY r, tri) AS n FROM t WHERE tri IS NOT NULL), rc AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM d, (VALUES (0), (1), (2)) v(k) WHERE n > 1 GROUP BY 1),
m AS (SELECT w.r, doc_id, lang, source, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines FROM w LEFT JOIN lc USING (r) LEFT JOIN rc USING (r)),
b AS (SELECT *, n_symbols * 1000 // greatest(1, n_words) AS symbols, n_repeat_words * 1000 // greatest(1, n_words) AS repeats, n_dup_lines * 1000 // greatest(1, n_lines) AS lines, word_chars * 100 // greatest(1, n_words) AS length FROM m),
s AS (SELECT lang, source, ratio, v // {_P} * {_P} AS bin, count(*) AS n FROM (SELECT lang, source, unnest(['symbols', 'repeats', 'lines', 'length']) AS ratio, unnest([symbols, repeats, lines, length]) AS v FROM b WHERE n_words > 0) GROUP BY ALL),
o AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, ratio ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY lang, source, ratio) AS total FROM s),
q AS (SELECT lang, source, ratio, min(bin) FILTER (WHERE upto * 4 >= total) AS q1, min(bin) FILTER (WHERE upto * 4 >= total * 3) AS q3 FROM o GROUP BY ALL), l AS (SELECT lang, source, {_limits()} FROM q GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
NOT (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words) AND coalesce(symbols <= most_symbols AND repeats <= most_repeats AND lines <= most_lines AND length <= most_length AND length >= least_length, true) AS kept, b.lang, b.source, n_lines
FROM b LEFT JOIN l ON l.lang IS NOT DISTINCT FROM b.lang AND l.source IS NOT DISTINCT FROM b.source"""

CHAT_FORMAT = f"""WITH t AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place FROM conversations),
c AS (SELECT conv_id, list(struct_pack(r := role, x := text) ORDER BY place) AS ts, count(*) AS n FROM t GROUP BY 1),
k AS (SELECT min(conv_id) AS conv_id, any_value(n) AS n_turns, count(*) AS n_copies, ts FROM c GROUP BY ts),
s AS (SELECT * FROM k WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.n > k.n_turns AND list_slice(c.ts, 1, k.n_turns) = k.ts))
SELECT t.conv_id, dense_rank() OVER (PARTITION BY t.conv_id ORDER BY turn // {chat_format.SEGMENT}) - 1 AS segment, n_turns, n_copies, string_agg('{chat_format.BEGIN}' || coalesce(role, '') || chr(10) || coalesce(text, '') || '{chat_format.END}' || chr(10), '' ORDER BY place) AS text FROM t JOIN s ON s.conv_id IS NOT DISTINCT FROM t.conv_id GROUP BY t.conv_id, turn // {chat_format.SEGMENT}, n_turns, n_copies"""

_HOST = r"coalesce(" + _LOWER.format(r"regexp_extract(regexp_extract({0}, '(?s)^.*?://([^?#]*)', 1), '(?s)^([^/]*)', 1)") + ", '')"
_PATH = r"coalesce(regexp_extract(regexp_extract({0}, '(?s)^.*?://([^?#]*)', 1), '(?s)^[^/]*(.*)$', 1), '')"


def _rule(result: int) -> str:
    out = "CASE"
    for what, text in sorted(url_filter.RULES, key=lambda r: -len(r[1])):
        domain, slash, rest = text.partition("/")
        out += f" WHEN (host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{slash + rest}') THEN '{(text, what)[result]}'"
    return out + " END"


#: Rounds after which no host gets as much as the tolerance.
_ROUNDS = math.ceil(math.log(url_filter.TOLERANCE) / math.log(url_filter.DAMPING))


def _ranks(name: str, seed: str, src: str, dst: str) -> str:
    """The rounds of a personalised rank, each a common table expression."""
    out = [f"{name}0 AS (SELECT host, 1.0::DOUBLE AS x FROM h WHERE {seed} * 2 > n)"]
    for k in range(_ROUNDS):
        out.append(f"{name}{k + 1} AS (SELECT {dst} AS host, sum(x * w) * {url_filter.DAMPING} AS x FROM {name}{k} JOIN links ON {src} = host GROUP BY 1)")
    every = " UNION ALL ".join(f"SELECT * FROM {name}{k}" for k in range(_ROUNDS + 1))
    return ", ".join([*out, f"{name} AS (SELECT host, sum(x) AS x FROM ({every}) GROUP BY 1)"])


_HREFS = url_filter.HREF.replace("'", "''")
URL_FILTER = rf"""WITH p AS (SELECT page_id, html, {_HOST.format('url')} AS host, {_PATH.format('url')} AS path FROM pages), j AS (SELECT page_id, host, path, {_rule(0)} AS rule, {_rule(1)} AS v FROM p),
h AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE v = 'allow') AS good, count(*) FILTER (WHERE v = 'block') AS bad FROM j WHERE host <> '' GROUP BY 1),
hrefs AS (SELECT src, CASE WHEN href LIKE '//%' THEN 'any:' || href ELSE href END AS href FROM (SELECT host AS src, unnest(regexp_extract_all(html, '{_HREFS}', 1)) AS href FROM p)), edges AS (SELECT src, {_HOST.format('href')} AS dst, count(*) AS n FROM hrefs GROUP BY ALL HAVING src <> dst AND src <> '' AND dst <> ''),
links AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS w FROM edges), {_ranks('g', 'good', 'src', 'dst')}, {_ranks('b', 'bad', 'dst', 'src')},
z AS (SELECT b.host FROM b LEFT JOIN g USING (host) WHERE b.x > {url_filter.FLOOR} AND b.x > {url_filter.MARGIN} * (coalesce(g.x, 0) + b.x))
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN host IN (SELECT host FROM z) THEN 'block' END, 'allow') AS verdict FROM j"""

_N = substring_dedup.WINDOW
SUBSTRING_DEDUP = rf"""WITH w AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format('text')} AS ws FROM documents), u AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
s AS (SELECT r, unnest(range(1, greatest(1, len(ws) - {_N - 2}))) AS i, ws FROM w), h AS (SELECT r, i, hash(array_to_string(list_slice(ws, i, i + {_N - 1}), ' ')) AS h FROM s), d AS (SELECT r, i, count(*) OVER (PARTITION BY h) > 1 AS hit FROM h),
c AS (SELECT u.r, u.i, word, coalesce(max(CASE WHEN hit THEN 1 ELSE 0 END) OVER (PARTITION BY u.r ORDER BY u.i ROWS BETWEEN {_N - 1} PRECEDING AND CURRENT ROW), 0) = 1 AS gone FROM u LEFT JOIN d ON d.r = u.r AND d.i = u.i),
k AS (SELECT r, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept FROM c GROUP BY 1)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept, sha256('')) AS kept_sha256 FROM w LEFT JOIN k USING (r)"""

ORACLES = {"op3_substring_dedup": SUBSTRING_DEDUP, "op4_decontaminate": DECONTAMINATE, "op5_quality_rules": QUALITY_RULES, "op7_chat_format": CHAT_FORMAT, "op8_url_filter": URL_FILTER}

"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from . import mixing, urlfilter
from .common import WORD

WORDS = f"regexp_extract_all(coalesce(text, ''), '{WORD}')"
UPPER, LOWER = urlfilter.UPPER, urlfilter.LOWER

_GROUP = "('0x' || substr(hex, {0} + 1, 5))::BIGINT"
_CHARS = " || ".join("substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({v} >> {s}) & 31)::INT + 1, 1)".format(v=_GROUP.format(5 * i), s=s) for i in range(8) for s in (15, 10, 5, 0))
OP1 = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
t AS (SELECT hex, max(page_id) AS top FROM p GROUP BY hex)
SELECT page_id, payload_bytes, {_CHARS} AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM p JOIN t USING (hex)"""

OP3 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT x AS doc_id, least(x, min(y)) AS component_id FROM r GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)"""

OP4 = f"""
WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents),
i AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM w),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM i),
m AS (SELECT g, min(doc_id) AS least FROM g GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + k AS j FROM g JOIN m USING (g), range(13) t(k) WHERE least < doc_id),
v AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS word FROM w),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n FROM v ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)"""

_WEIGHTS = "[" + ", ".join(f"{float(w)}::DOUBLE" for w in mixing.WEIGHTS) + "]"
OP9 = f"""
WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size, length(text) - length(translate(text, '#*$%&|<>', '')) AS marks, length(text) AS chars,
    ('0x' || substr(md5(concat_ws(':', '{mixing.SEED}', doc_id, '0')), 1, 13))::BIGINT AS drawn FROM documents),
k AS (SELECT doc_id, source, size, -ln((drawn + 0.5::DOUBLE) / {float(1 << 52)!r}::DOUBLE)
    / coalesce(greatest(0.05::DOUBLE, 1 - 5.0::DOUBLE * marks / greatest(chars, 1)), 1.0::DOUBLE) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
r AS (SELECT *, ({_WEIGHTS})[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS w, {float(mixing.MOST)}::DOUBLE * source_size AS cap FROM s),
f AS (SELECT *, ({mixing.SHARE}::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
    FROM r WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, coalesce(least(cap, w * max(CASE WHEN cap / w > level THEN level END) OVER ()), cap) AS target FROM f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
o AS (SELECT k.*, source_size, target, epochs, floor(target)::BIGINT - epochs * source_size AS rem,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rem - before)))::BIGINT AS taken FROM o"""


def _op10(least_rows: int = 5, threshold: float = 0.5, strength: float = 10.0, z: float = 2.58) -> str:
    ending = r"\.[A-Za-z][A-Za-z0-9]{0,4}$"
    shape = rf"""CASE WHEN seg = '' THEN '' WHEN regexp_matches(regexp_replace(seg, '{ending}', ''), '^[0-9]+$') THEN '{{n}}'
    WHEN regexp_matches(regexp_replace(seg, '{ending}', ''), '^[0-9A-Fa-f-]{{8,}}$') THEN '{{x}}' ELSE '{{w}}' END || lower(regexp_extract(seg, '({ending})', 1))"""
    rule, verdict = "NULL", "NULL"
    for kind, own, start in sorted(urlfilter.RULES, key=lambda r: len(r[1] + r[2])):
        fits = f"(host = '{own}' OR ends_with(host, '.{own}')) AND starts_with(path, '{start}')"
        rule, verdict = f"CASE WHEN {fits} THEN '{own + start}' ELSE {rule} END", f"CASE WHEN {fits} THEN '{kind}' ELSE {verdict} END"
    return f"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
known AS (SELECT doc_id AS page_id, min(quality = 1 AND toxic = 0) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id),
p AS (SELECT host, path, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (NOT good) AS b FROM h LEFT JOIN known USING (page_id) GROUP BY host, path),
l AS (SELECT *, string_split(regexp_replace(path, '^/', ''), '/') AS segs FROM p),
s AS (SELECT host, path, n, unnest(segs) AS seg, unnest(range(len(segs))) AS depth FROM l),
o AS (SELECT host, depth, seg, true AS often FROM s GROUP BY host, depth, seg HAVING sum(n) >= {least_rows}),
t AS (SELECT host, path, list(CASE WHEN often THEN seg ELSE {shape} END ORDER BY depth) AS parts FROM s LEFT JOIN o USING (host, depth, seg) GROUP BY host, path),
c AS (SELECT host, parts, sum(g) AS g, sum(b) AS b FROM t JOIN p USING (host, path) GROUP BY host, parts),
x AS (SELECT *, unnest(range(len(parts) + 1)) AS depth FROM c),
k AS (SELECT host, parts[:depth] AS pre, sum(g) AS g, sum(b) AS b FROM x GROUP BY host, pre),
q AS (SELECT host, pre, (g + 0.5::DOUBLE) / (g + b + 1) AS share FROM k),
d AS (SELECT k.host, k.pre, true AS differs FROM k JOIN q ON k.host = q.host AND len(k.pre) > 0 AND q.pre = k.pre[:len(k.pre) - 1]
  WHERE g + b > 0 AND abs(g / greatest(g + b, 1) - share) > {z}::DOUBLE * sqrt(share * (1 - share) / greatest(g + b, 1))),
br AS (SELECT x.host, parts, max(x.depth) AS depth FROM x LEFT JOIN d ON x.host = d.host AND d.pre = parts[:depth] WHERE differs OR x.depth = 0 GROUP BY x.host, parts),
prior AS (SELECT (sum(g) + 1) / (sum(g) + sum(b) + 2)::DOUBLE AS p FROM c),
hosts AS (SELECT host, (sum(g) + {strength}::DOUBLE * any_value(p)) / (sum(g) + sum(b) + {strength}::DOUBLE) AS hp FROM c, prior GROUP BY host),
m AS (SELECT host, parts[:depth] AS branch, (sum(g) + {strength}::DOUBLE * any_value(hp)) / (sum(g) + sum(b) + {strength}::DOUBLE) AS purity
  FROM c JOIN br USING (host, parts) JOIN hosts USING (host) GROUP BY host, branch),
v AS (SELECT br.host, parts, CASE WHEN purity < {threshold}::DOUBLE THEN 'block' ELSE 'allow' END AS verdict FROM br JOIN m ON br.host = m.host AND m.branch = parts[:depth])
SELECT page_id, host, path, {rule} AS rule, coalesce({verdict}, verdict) AS verdict, '/' || array_to_string(parts, '/') AS template
FROM h JOIN t USING (host, path) JOIN v USING (host, parts)"""


ORACLES = {"op1_warc": OP1, "op3_minhash": OP3, "op4_recompress": OP4, "op9_mix": OP9, "op10_url_filter": _op10()}

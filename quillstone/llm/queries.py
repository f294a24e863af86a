"""The registered queries of the llm operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, embed_dedup, imatch, licenses, mixing, packing, pii, simhash, substring, toxicity
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.text_parts(rows)).drop("n_attachments", "attachment_tokens")


SQL2 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(16 + length(role) + length(text) + length(regexp_replace(role || text, '[^\\<>]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(licenses.document_paths(table(spark, sf_dir, "documents")))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def licenses_sql() -> str:
    """The licence scan in SQL, with the operator's templates and patterns as literals."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"  # noqa: E731
    templates = ", ".join(f"({i}, {quoted(name)}, {quoted(text)})" for i, (name, text) in enumerate(licenses.TEMPLATES))
    part = lambda c: f"coalesce(replace({c}, '/', '_'), 'none')"  # noqa: E731
    words = lambda c: f"regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}]+')"  # noqa: E731
    return rf"""
WITH p AS (SELECT doc_id, coalesce(text, '') AS text, {part('source')} || '/' || {part('lang')} AS top, {part('source')} || '/' || {part('lang')} || '/' || CAST(floor(coalesce(doc_id, 0) / 640) AS BIGINT) AS deep FROM documents),
f AS (SELECT doc_id, text, CASE WHEN doc_id % 256 = 0 THEN top || '/LICENSE-' || doc_id WHEN doc_id % 64 = 0 THEN deep || '/LICENSE-' || doc_id ELSE deep || '/' || coalesce(doc_id, -1) || '.txt' END AS path FROM p),
t0 AS (SELECT * FROM (VALUES {templates}) AS x(template, license, body)),
t AS (SELECT template, license, term, count(*) AS tf FROM (SELECT template, license, unnest({words('body')}) AS term FROM t0) GROUP BY ALL),
n AS (SELECT count(*) AS n FROM f),
df AS (SELECT term, count(DISTINCT path) AS df FROM (SELECT path, unnest(list_distinct({words('text')})) AS term FROM f) WHERE term IN (SELECT term FROM t) GROUP BY term),
idf AS (SELECT term, ln(least((1 + n) / (1 + coalesce(df, 0)), {licenses.RARE})) + 1 AS idf FROM (SELECT DISTINCT term FROM t) LEFT JOIN df USING (term), n),
w AS (SELECT license, template, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS weight FROM t JOIN idf USING (term)),
u0 AS (SELECT path, unnest(list_distinct(list_concat(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{licenses.ANCHORS}')), CASE WHEN regexp_matches(regexp_extract(path, '([^/]*)$', 1), '{licenses.LICENCE_FILE}') THEN [text] ELSE [] END))) AS line FROM f),
u AS (SELECT path, line, term, count(*) AS tf FROM (SELECT path, line, unnest({words('line')}) AS term FROM u0) GROUP BY ALL),
c AS (SELECT path, line, term, tf * coalesce(idf, ln(least(n + 1.0, {licenses.RARE})) + 1) AS w FROM u LEFT JOIN idf USING (term), n),
len AS (SELECT path, line, sqrt(sum(w * w)) AS length FROM c GROUP BY ALL),
s AS (SELECT path, license, round(sum(w * weight) / min(length), 9) AS score FROM c JOIN w USING (term) JOIN len USING (path, line) GROUP BY path, line, template, license),
d AS (SELECT path, license, score FROM s WHERE score >= {licenses.LEAST_COSINE} QUALIFY row_number() OVER (PARTITION BY path ORDER BY score DESC, license) = 1),
g AS (SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS up, min(path) AS inherited_from, arg_min(license, path) AS inherited FROM d WHERE regexp_matches(regexp_extract(path, '([^/]*)$', 1), '{licenses.LICENCE_FILE}') GROUP BY 1),
dirs AS (SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM f),
ups AS (SELECT dir, k AS distance, array_to_string(string_split(dir, '/')[1:len(string_split(dir, '/')) - k], '/') AS up FROM dirs, (SELECT unnest(range(0, 8)) AS k) WHERE k < len(string_split(dir, '/'))),
near AS (SELECT dir, inherited, inherited_from, distance FROM ups JOIN g USING (up) QUALIFY row_number() OVER (PARTITION BY dir ORDER BY distance) = 1)
SELECT doc_id, path, d.license, score, inherited, inherited_from, distance FROM f LEFT JOIN d USING (path) LEFT JOIN near ON dir = regexp_extract(path, '^(.*)/[^/]*$', 1)
"""


SQL4 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS id, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON r.id = l.a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = vec_id) AS n_links, (SELECT min(c) FROM r WHERE r.id = vec_id) AS component_id,
  (SELECT min(c) FROM r WHERE r.id = vec_id) = vec_id AS kept FROM embeddings
"""


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))


SQL5 = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS o FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
s1 AS (SELECT *, CAST(place % 3 + 1 AS DOUBLE) AS w, CASE WHEN place % 2 = 1 THEN 0.5::DOUBLE ELSE -0.5::DOUBLE END AS tilt, source_size * 3.0::DOUBLE AS cap FROM s0),
s2 AS (SELECT *, cap / w AS full_at, CAST(sum(source_size) OVER () AS DOUBLE) AS total, sum(w) OVER () AS all_w FROM s1),
s3 AS (SELECT *, (total - coalesce(sum(cap) OVER b, 0)) / (all_w - coalesce(sum(w) OVER b, 0)) AS try_at FROM s2 WINDOW b AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (SELECT *, least(cap, max(CASE WHEN try_at <= full_at THEN try_at END) OVER () * w) AS target FROM s3),
r AS (SELECT d.doc_id, d.size, s.*, sum(d.size) OVER (PARTITION BY d.source ORDER BY o, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS start
    FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
c0 AS (SELECT *, floor(coalesce(target / nullif(source_size, 0), 0)) AS whole FROM r),
c AS (SELECT *, CAST(least(whole + CASE WHEN start + size / 2 < target - whole * source_size THEN 1 ELSE 0 END, 3) AS BIGINT) AS copies FROM c0),
-- the words taken before a document's first copy are the start; at time t the schedule has asked for target * (share of its area up to t) words
t AS (SELECT *, CASE WHEN copies = 0 THEN NULL WHEN start = 0 THEN 0 WHEN start >= target THEN 1
    ELSE (sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * start / target) - (1 - tilt)) / (2 * tilt) END AS t FROM c)
SELECT doc_id, size, source_size, target, copies * size AS taken, round(t, 9) AS position FROM t
"""


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(table(spark, sf_dir, "documents")).drop("removed")


SQL6 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 11, 1))) AS i FROM w),
g AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 12], ' ')) AS h FROM p),
lo AS (SELECT h, min(doc_id) AS least FROM g GROUP BY h),
hit AS (SELECT g.doc_id, unnest(range(i, i + 13)) AS k FROM g JOIN lo USING (h) WHERE g.doc_id > lo.least),
gone AS (SELECT doc_id, list(DISTINCT k) AS ks FROM hit GROUP BY doc_id),
k AS (SELECT w.doc_id, words, coalesce(ks, []) AS ks FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, len(words) AS n_words, CAST(len(ks) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(words, lambda x, i: NOT list_contains(ks, i)), ' ')) AS kept_sha256
FROM k
"""


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


SQL7 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
k AS (SELECT * FROM (VALUES (0, 'email'), (1, 'ip'), (2, 'card'), (3, 'phone')) AS v(ord, kind)),
m AS (SELECT doc_id, kind, regexp_extract_all(text, p) AS ms, regexp_split_to_array(text, p) AS gaps FROM d, (VALUES
  ('email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'), ('ip', '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+'),
  ('card', '[0-9](?:[\x20-]?[0-9])+'), ('phone', '\+[0-9][\x20().0-9-]+[0-9]'), ('term', '[\p{{L}}\p{{M}}]{{3,}}')) AS v(kind, p) WHERE regexp_matches(text, p)),
u AS (SELECT doc_id, kind, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS value, unnest(gaps[1:len(ms)]) AS gap FROM m),
a AS (SELECT doc_id, kind, i, value, CAST(sum(length(gap) + length(value)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS stop, regexp_replace(value, '[^0-9]', '', 'g') AS digits FROM u),
b AS (SELECT doc_id, kind, ord, stop - length(value) AS start, stop, kind || ':' || CASE WHEN ord < 2 THEN lower(value) ELSE digits END AS entity FROM a JOIN k USING (kind) WHERE CASE kind
  WHEN 'ip' THEN len(list_filter(string_split(value, '.'), lambda x: length(ltrim(x, '0')) > 3 OR CAST(right(x, 4) AS INT) > 255)) = 0
  WHEN 'card' THEN length(digits) BETWEEN 13 AND 19
    AND list_sum(list_transform(range(length(digits)), lambda j: CAST(digits[length(digits) - j] AS INT) * (1 + j % 2) - CASE WHEN CAST(digits[length(digits) - j] AS INT) * (1 + j % 2) > 9 THEN 9 ELSE 0 END)) % 10 = 0
  WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15 ELSE true END),
w AS (SELECT doc_id, i, lower(value) AS term, stop - length(value) AS start, stop FROM a WHERE kind = 'term'),
free AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.doc_id = w.doc_id AND b.start < w.stop AND w.start < b.stop)),
near AS (SELECT b.doc_id, b.entity, (SELECT count(*) FROM w WHERE w.doc_id = b.doc_id AND w.stop <= b.start) AS upto, (SELECT count(*) FROM w WHERE w.doc_id = b.doc_id AND w.start < b.stop) AS beyond FROM b),
pairs AS (SELECT entity, term, count(DISTINCT doc_id) AS n_both FROM near JOIN free USING (doc_id) WHERE (i > upto - {pii.NEAR_WORDS} AND i <= upto) OR (i > beyond AND i <= beyond + {pii.NEAR_WORDS}) GROUP BY ALL),
e AS (SELECT entity, count(DISTINCT doc_id) AS n_entity FROM b GROUP BY entity), t AS (SELECT term, count(DISTINCT doc_id) AS n_term FROM w GROUP BY term), n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM d),
rules AS (SELECT DISTINCT term FROM (SELECT term, coalesce(ln((n_both + {pii.PRIOR_DOCS} * n_entity / n) / (greatest(n_term, n_both) + {pii.PRIOR_DOCS}) / (n_entity / n)) / nullif(ln(n / n_entity), 0), 0) AS disclosure
  FROM pairs JOIN e USING (entity) JOIN t USING (term), n) WHERE disclosure >= {pii.GENERALISE}),
bs AS (SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{x}') AS n_{x}" for x in pii.KINDS)}, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY ord, start) AS base FROM b GROUP BY doc_id),
ts AS (SELECT doc_id, count(*) AS n_terms, string_agg('term:' || start || ':' || stop, ',' ORDER BY start) AS terms FROM free JOIN rules USING (term) GROUP BY doc_id)
SELECT doc_id, {', '.join(f"coalesce(n_{x}, 0) AS n_{x}" for x in pii.KINDS)}, sha256(coalesce(base, '')) AS base_sha256, concat_ws(',', base, terms) AS spans, coalesce(n_terms, 0) AS n_terms
FROM d LEFT JOIN bs USING (doc_id) LEFT JOIN ts USING (doc_id)
"""


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


def simhash_sql() -> str:
    """SimHash in SQL, XXH64 written out in 128-bit arithmetic, links by comparing all distinct fingerprints."""
    p1, p2, p3, p4, p5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
    wrap = lambda x: f"(({x}) % 18446744073709551616::UHUGEINT)"  # noqa: E731
    mul = lambda x, p: wrap(f"{x} * {p}::UHUGEINT")  # noqa: E731
    rotl = lambda x, r: f"({wrap(f'{x} * {1 << r}::UHUGEINT')} + {x} // {1 << (64 - r)}::UHUGEINT)"  # noqa: E731
    lane = lambda at, n: f"CAST('0x' || {' || '.join(f'substr(x, 2 * ({at}) + {2 * i + 1}, 2)' for i in reversed(range(n)))} AS UBIGINT)::UHUGEINT"  # noqa: E731
    each = lambda f: f"list_transform(ls, lambda l: {f})"  # noqa: E731
    start = {1: (42 + p1 + p2) % 2**64, 2: (42 + p2) % 2**64, 3: 42, 4: (42 - p1) % 2**64}
    # lanes of whole stripes by accumulator, each lane already times the second prime
    stripe = lambda k: f"list_reduce(list_transform(range(0, n // 32), lambda j: {mul(lane(f'32 * j + {8 * (k - 1)}', 8), p2)}), lambda a, l: {mul(rotl(wrap('a + l'), 31), p1)}, {start[k]}::UHUGEINT)"  # noqa: E731
    merged = lambda k: f"{wrap(mul(f'xor(h, {mul(rotl(mul(f'v{k}', p2), 31), p1)})', p1) + f' + {p4}::UHUGEINT')} AS h"  # noqa: E731
    bits = ", ".join(f"sum(c * ((h >> {b}) & 1)) AS b{b}" for b in range(64))
    packed = " + ".join(f"CASE WHEN 2 * b{b} > n THEN {1 << b}::UHUGEINT ELSE 0 END" for b in range(64))
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-]+') AS ws FROM documents),
s AS (SELECT doc_id, shingle, count(*) AS c FROM (SELECT doc_id, array_to_string(ws[i:i + 2], ' ') AS shingle FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)) GROUP BY ALL),
x0 AS (SELECT shingle, hex(encode(shingle)) AS x, length(hex(encode(shingle))) // 2 AS n FROM (SELECT DISTINCT shingle FROM s)),
x1 AS (SELECT *, {', '.join(f"CASE WHEN n >= 32 THEN {stripe(k)} END AS v{k}" for k in (1, 2, 3, 4))} FROM x0),
x2 AS (SELECT *, CASE WHEN n >= 32 THEN {wrap(' + '.join(rotl(f'v{k}', r) for k, r in ((1, 1), (2, 7), (3, 12), (4, 18))))} END AS h FROM x1),
x3 AS (SELECT * REPLACE ({merged(1)}) FROM x2), x4 AS (SELECT * REPLACE ({merged(2)}) FROM x3), x5 AS (SELECT * REPLACE ({merged(3)}) FROM x4), x6 AS (SELECT * REPLACE ({merged(4)}) FROM x5),
y0 AS (SELECT shingle, x, n, {wrap(f'coalesce(h, {(42 + p5) % 2**64}::UHUGEINT) + CAST(n AS UHUGEINT)')} AS h, list_transform(range(n // 32 * 32, n - 7, 8), lambda j: {mul(lane('j', 8), p2)}) AS ls FROM x6),
y1 AS (SELECT * REPLACE ({each(mul(rotl('l', 31), p1))} AS ls) FROM y0),
y2 AS (SELECT * REPLACE (list_reduce(ls, lambda a, l: {wrap(mul(rotl('xor(a, l)', 27), p1) + f' + {p4}::UHUGEINT')}, h) AS h) FROM y1),
y3 AS (SELECT * REPLACE (CASE WHEN n % 8 >= 4 THEN xor(h, {mul(lane('n // 8 * 8', 4), p1)}) ELSE h END AS h) FROM y2),
y4 AS (SELECT * REPLACE (CASE WHEN n % 8 >= 4 THEN {wrap(mul(rotl('h', 23), p2) + f' + {p3}::UHUGEINT')} ELSE h END AS h) FROM y3),
y5 AS (SELECT * REPLACE (list_reduce(list_transform(range(n // 4 * 4, n), lambda j: {mul(lane('j', 1), p5)}), lambda a, l: {mul(rotl('xor(a, l)', 11), p1)}, h) AS h) FROM y4),
z0 AS (SELECT shingle, {mul('xor(h, h // 8589934592::UHUGEINT)', p2)} AS h FROM y5), z1 AS (SELECT shingle, {mul('xor(h, h // 536870912::UHUGEINT)', p3)} AS h FROM z0),
z AS (SELECT shingle, CAST(xor(h, h // 4294967296::UHUGEINT) AS UBIGINT) AS h FROM z1),
b AS (SELECT doc_id, sum(c) AS n, {bits} FROM s JOIN z USING (shingle) GROUP BY doc_id),
f AS (SELECT doc_id, coalesce(fp, 0::UBIGINT) AS fp FROM w LEFT JOIN (SELECT doc_id, CAST({packed} AS UBIGINT) AS fp FROM b) USING (doc_id)),
d AS (SELECT fp, min(doc_id) AS least FROM f GROUP BY fp),
l AS (SELECT a.fp AS a, b.fp AS b FROM d AS a JOIN d AS b ON a.fp <> b.fp AND bit_count(xor(a.fp, b.fp)) <= {simhash.RADIUS}),
r AS (SELECT fp, least AS c FROM d UNION SELECT l.b, r.c FROM r JOIN l ON r.fp = l.a)
SELECT doc_id, lpad(lower(to_hex(fp)), 16, '0') AS fingerprint, c AS component_id FROM f JOIN (SELECT fp, min(c) AS c FROM r GROUP BY fp) USING (fp)
"""


def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare_edits(table(spark, sf_dir, "documents"))


def imatch_sql() -> str:
    """I-Match in SQL, with the operator's parameters as literals."""
    rates = ", ".join(f"({i}, '{format(256 >> (bits - 4), '02x') if bits > 4 else 'g'}')" for i, bits in enumerate(imatch.RATES))
    words = lambda c: rf"list_distinct(list_filter(regexp_split_to_array(lower({c}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> ''))"  # noqa: E731
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
x AS (SELECT doc_id, text, n, coalesce(lead(text) OVER w, first_value(text) OVER w) AS after, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id FROM d WINDOW w AS (ORDER BY doc_id DESC)),
e AS (SELECT *, substr(text, 1, n - n // 3) || substr(after, 1, n // 3) AS edited FROM x),
b AS (SELECT doc_id, 0 AS which, md5(text) AS digest, {words('text')} AS terms FROM e UNION ALL SELECT doc_id, 1, md5(edited), {words('edited')} FROM e),
lex AS (SELECT term FROM (SELECT unnest(terms) AS term FROM b WHERE which = 0) GROUP BY term
  HAVING count(*) >= {imatch.LEAST_SHARE!r}::DOUBLE * (SELECT count(*) FROM d) AND count(*) <= greatest({imatch.MOST_SHARE!r}::DOUBLE * (SELECT count(*) FROM d), 1.0)),
m AS (SELECT doc_id, which, term, md5(term) AS num FROM (SELECT doc_id, which, unnest(terms) AS term FROM b) JOIN lex USING (term)),
r AS (SELECT * FROM (VALUES {rates}) AS v(rate, upto)),
s AS (SELECT doc_id, which, rate, CAST('0x' || num[3 * rate + 3] AS BIGINT) AS k, substr(md5(string_agg(term, ' ' ORDER BY term)), 1, {imatch.DIGITS}) AS h FROM m, r WHERE num[3 * rate + 1:3 * rate + 2] < upto GROUP BY ALL),
g AS (SELECT doc_id, which, digest, rate, k, rate * {imatch.SAME_RATE} + k AS i FROM b, r, (SELECT unnest(range({imatch.SAME_RATE})) AS k)),
f AS (SELECT g.doc_id, g.which, i, CASE WHEN own.doc_id IS NULL THEN substr(md5((i + 1) || ':' || digest), 1, {imatch.DIGITS}) ELSE coalesce(h, '{imatch.NONE}') END AS h
  FROM g LEFT JOIN s USING (doc_id, which, rate, k) LEFT JOIN (SELECT DISTINCT doc_id, which FROM m) AS own ON own.doc_id = g.doc_id AND own.which = g.which),
p AS (SELECT doc_id, which, string_agg(h, '' ORDER BY i) AS print, list(h ORDER BY i) AS hs FROM f GROUP BY ALL),
z AS (SELECT e.doc_id, e.n, sha256(e.edited) AS edited_sha256, p0.print AS fingerprint, p1.print AS edited_fingerprint, list_zip(p0.hs, p1.hs) AS own, list_zip(p0.hs, p2.hs) AS nxt
  FROM e JOIN p AS p0 ON p0.doc_id = e.doc_id AND p0.which = 0 JOIN p AS p1 ON p1.doc_id = e.doc_id AND p1.which = 1 JOIN p AS p2 ON p2.doc_id = e.next_id AND p2.which = 0)
SELECT doc_id, n AS n_chars, edited_sha256, fingerprint, edited_fingerprint,
  {', '.join(f"coalesce(len(list_filter({c}, lambda x: x[1] = x[2] AND x[1] <> '{imatch.NONE}')) / nullif(len(list_filter({c}, lambda x: x[1] <> '{imatch.NONE}' OR x[2] <> '{imatch.NONE}')), 0), 0) AS {name}" for c, name in (('own', 'near_edited'), ('nxt', 'near_next')))}
FROM z
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_chat_formatting, op3_license_scan, op4_embedding_dedup, op5_source_mixing,
        op6_substring_dedup, op7_pii, op8_best_fit_packing, op9_simhash, op10_imatch,
    )
}  # fmt: skip
ORACLE_SQL = {"op2_chat_formatting": SQL2, "op3_license_scan": licenses_sql(), "op4_embedding_dedup": SQL4, "op5_source_mixing": SQL5, "op6_substring_dedup": SQL6, "op7_pii": SQL7, "op9_simhash": simhash_sql(), "op10_imatch": imatch_sql()}

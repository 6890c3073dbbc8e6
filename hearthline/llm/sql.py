"""SQL that gives the rows of those queries that SQL can express."""

from __future__ import annotations

from hearthline.llm.mixing import BLOCK_WORDS, MAX_EPOCHS, WEIGHTS
from hearthline.llm.url_rules import LOWER, UPPER

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
SEED = 4

# Water-filling: sources in the order of size / weight fill up until the level fits.
MIX = rf"""
WITH sized AS (
    SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS mix_key,
           len({WORDS})::BIGINT AS size,
           substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 3) AS part
    FROM documents
), sources AS (
    SELECT mix_key, any_value(source) AS source, sum(size)::BIGINT AS n,
           row_number() OVER (ORDER BY any_value(source) IS NULL, encode(any_value(source))) AS place
    FROM sized GROUP BY mix_key
), weighed AS (
    SELECT *, [{", ".join(map(str, WEIGHTS))}][(place - 1) % {len(WEIGHTS)} + 1] AS w, sum(n) OVER () AS total FROM sources
), levels AS (
    SELECT *, {MAX_EPOCHS} * n / w AS fills,
           coalesce(sum({MAX_EPOCHS} * n) OVER before, 0) AS capped, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS w_left
    FROM weighed WINDOW before AS (ORDER BY {MAX_EPOCHS} * n / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT arg_min((total - capped)::DOUBLE / w_left, fills) AS level
    FROM levels WHERE (total - capped)::DOUBLE / w_left <= fills
), targets AS (
    SELECT mix_key, place, n, total, CASE WHEN w * level > {MAX_EPOCHS} * n THEN ({MAX_EPOCHS} * n)::DOUBLE ELSE w * level END AS target,
           (n + {BLOCK_WORDS - 1}) // {BLOCK_WORDS} AS blocks
    FROM weighed, level
), quotients AS (
    SELECT mix_key, place, unnest(generate_series(1, {MAX_EPOCHS} * blocks)) AS k, target, total FROM targets
), ranked AS (
    SELECT mix_key, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, place, k) AS rank,
           (total + {BLOCK_WORDS // 2}) // {BLOCK_WORDS} AS seats FROM quotients
), seats AS (
    SELECT t.*, (SELECT count(*) FROM ranked r WHERE r.mix_key = t.mix_key AND rank <= seats) AS got FROM targets t
), runs AS (
    SELECT *, got // blocks AS epochs, got % blocks AS rest,
           ('0x' || substr(md5('{SEED}:' || mix_key), 1, 8))::BIGINT % blocks AS start
    FROM seats WHERE blocks > 0
), placed AS (
    SELECT *, sum(size) OVER (PARTITION BY mix_key ORDER BY part, doc_id, size ROWS UNBOUNDED PRECEDING) AS till FROM sized
)
SELECT doc_id, size, n AS source_size, target, (epochs * size
    + greatest(0, least(till, least((start + rest) * {BLOCK_WORDS}, n)) - greatest(till - size, start * {BLOCK_WORDS}))
    + greatest(0, least(till, greatest(0, start + rest - blocks) * {BLOCK_WORDS}) - (till - size)))::BIGINT AS taken
FROM placed JOIN runs USING (mix_key)"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(h, {1 + 5 * i}, 5))::INTEGER >> {s}) % 32 + 1, 1)"
    for i in range(8)
    for s in (15, 10, 5, 0)
)
WARC = f"""
WITH hashed AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), first AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS kept FROM hashed)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM first"""

JOIN = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE
        list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(1, len(w) - 4) + 1)]) END AS s
    FROM worded
), singles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), rows AS (SELECT * FROM singles SEMI JOIN (SELECT shingle FROM singles GROUP BY 1 HAVING count(*) > 1) USING (shingle)
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM rows a JOIN rows b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
    SELECT doc_id, doc_id AS other FROM sets
    UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM sets JOIN least USING (doc_id)"""

COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY 1
), sized AS (SELECT lang, w, unnest([1, 2, 3]) AS size FROM worded
), grams AS (SELECT lang, size, unnest([array_to_string(w[i:i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase FROM sized
), counts AS (SELECT lang, phrase, any_value(size) AS size, count(*) AS f FROM grams GROUP BY 1, 2 HAVING count(*) >= 10
), phrases AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1
), cuts AS (SELECT *, unnest(range(1, size)) AS k FROM phrases
), scored AS (
    SELECT c.*, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:k], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
    SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM phrases WHERE size = 3
), covered AS (SELECT lang, phrase, max(a) AS most FROM longer GROUP BY 1, 2)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase))::INTEGER AS rank, phrase, a, l, r, n, score
FROM best LEFT JOIN covered USING (lang, phrase) JOIN totals USING (lang)
WHERE coalesce(100 * most < 50 * a, TRUE) QUALIFY rank <= 2000"""

TOP_K = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score,
       row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id)::INTEGER AS rank
FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0 QUALIFY rank <= 20"""

ORACLES = {"op12_collocations": COLLOCATIONS, "op13_top_k": TOP_K, "op4_mix_sources": MIX, "op7_warc": WARC, "op9_ngram_join": JOIN}

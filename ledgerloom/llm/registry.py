"""The corpus queries, by name, and the DuckDB SQL of those that SQL can express.

The others train, tokenise, or use hashes that SQL engines do not share; their
tests compare them with brute force.
"""

from __future__ import annotations

from .decontaminate import op8_decontamination
from .fingerprints import op12_fingerprints
from .lines import EDITS, MIN_CHARS, op7_lines
from .ngrams import op4_lm
from .packing import op6_packing
from .pages import op3_html
from .private import op9_pii
from .resample import BUCKETS, MIN_WORDS, PERCENT, op11_resample
from .resample import SEED as RESAMPLE_SEED
from .search import TOP, op13_search
from .simhash import op10_simhash
from .substrings import WINDOW, op5_substring
from .toxicity import op1_toxicity
from .vectors import COSINE, op2_embedding

QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_embedding, op3_html, op4_lm, op5_substring, op6_packing, op7_lines, op8_decontamination, op9_pii, op10_simhash,
        op11_resample, op12_fingerprints, op13_search,
    )
}

_VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach AS (SELECT vec_id, vec_id AS other FROM v UNION SELECT reach.vec_id, link.b FROM reach JOIN link ON reach.other = link.a)
SELECT v.vec_id, (SELECT count(*) FROM link WHERE a = v.vec_id) AS n_links, min(other) AS component_id, v.vec_id = min(other) AS kept
FROM v JOIN reach USING (vec_id) GROUP BY v.vec_id
"""

_SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS k FROM d, unnest(range(1, len(w) - {WINDOW - 2})) AS t(i)),
f AS (SELECT k, min(doc_id) AS first FROM x GROUP BY k),
c AS (SELECT DISTINCT doc_id, i + o AS p FROM x JOIN f USING (k), unnest(range(0, {WINDOW})) AS u(o) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
r AS (SELECT words.doc_id, count(c.p) AS n_removed, string_agg(CASE WHEN c.p IS NULL THEN word END, ' ' ORDER BY words.p) AS kept
      FROM words LEFT JOIN c USING (doc_id, p) GROUP BY words.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN r USING (doc_id)
"""

# Lines one edit apart share their first or their last half.
_LINES = f"""
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents),
l AS (SELECT doc_id, generate_subscripts(s, 1) AS p, unnest(s) AS line FROM s),
k AS (SELECT *, lower(trim(line)) AS k FROM l),
f AS (SELECT k, min({{'d': doc_id, 'p': p}}) AS first FROM k WHERE length(k) >= {MIN_CHARS} GROUP BY k),
n AS (SELECT k, first, unnest([length(k) // 2, (length(k) - 1) // 2]) AS n FROM f),
h AS (SELECT DISTINCT * FROM (SELECT k, first, 0 AS side, left(k, n) AS half FROM n UNION ALL SELECT k, first, 1, right(k, n) FROM n)),
near AS (SELECT DISTINCT b.k FROM h a JOIN h b ON a.side = b.side AND a.half = b.half AND a.first < b.first
         WHERE abs(length(a.k) - length(b.k)) <= {EDITS} AND levenshtein(a.k, b.k) <= {EDITS}),
gone AS (SELECT k.doc_id, k.p FROM k JOIN f USING (k) LEFT JOIN near ON near.k = k.k WHERE near.k IS NOT NULL OR first <> {{'d': k.doc_id, 'p': k.p}})
SELECT l.doc_id, count(*) AS n_lines, count(gone.p) AS n_removed,
       sha256(coalesce(string_agg(CASE WHEN gone.p IS NULL THEN line END, chr(10) ORDER BY l.p), '')) AS kept_sha256
FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.p = l.p GROUP BY l.doc_id
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# CRC-32 byte by byte, over its usual table of 256 steps.
_RESAMPLE = f"""
WITH crc AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
word AS (SELECT doc_id, unnest(w) AS w FROM d),
known AS (SELECT DISTINCT w FROM word UNION SELECT DISTINCT w FROM b),
coded AS (SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, CAST(strlen(w) AS BIGINT)), lambda i: CAST('0x' || substr(hex(w), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))), lambda a, x: xor(a >> 8, t[CAST((xor(a, x) & 255) + 1 AS BIGINT)]))) % {BUCKETS} AS k FROM known, crc),
s AS (SELECT k, count(*) AS s FROM word JOIN coded USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM b JOIN coded USING (w) GROUP BY k),
sums AS (SELECT (SELECT count(*) FROM word)::DOUBLE AS s_all, (SELECT count(*) FROM b)::DOUBLE AS t_all),
gain AS (SELECT k, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (s_all + {BUCKETS}) / ((coalesce(s, 0) + 1.0::DOUBLE) * (t_all + {BUCKETS})))) AS BIGINT) AS g FROM s FULL JOIN t USING (k), sums),
sum_of AS (SELECT doc_id, count(*) AS n, sum(g) AS g FROM word JOIN coded USING (w) JOIN gain USING (k) GROUP BY doc_id),
h AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(floor(CAST(g AS DOUBLE) / n), 0) AS BIGINT) AS weight,
      (CAST('0x' || left(sha256('{RESAMPLE_SEED}:' || doc_id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296 AS u FROM d LEFT JOIN sum_of USING (doc_id)),
scored AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln(u))) AS BIGINT) AS score FROM h),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () * {PERCENT} // 100 AS take FROM scored WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN r <= take THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""

_SEARCH = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
sums AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_all FROM d WHERE len(w) > 0),
word AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS w FROM d),
tf AS (SELECT doc_id, n, w, count(*) AS tf FROM word WHERE w IN (SELECT w FROM q) GROUP BY doc_id, n, w),
df AS (SELECT w, count(*) AS df FROM tf GROUP BY w),
qf AS (SELECT item_id, w, count(*) AS qf FROM q GROUP BY item_id, w),
x AS (SELECT doc_id, w, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_all))) AS x FROM tf JOIN df USING (w), sums),
s AS (SELECT item_id, doc_id, CAST(sum(qf * x) AS BIGINT) AS score FROM x JOIN qf USING (w) GROUP BY item_id, doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {TOP}
"""

ORACLE: dict[str, str] = {
    "op2_embedding": _VECTORS, "op5_substring": _SUBSTRINGS, "op7_lines": _LINES, "op11_resample": _RESAMPLE, "op13_search": _SEARCH,
}

"""DuckDB SQL for the results of the queries that SQL can express (tables pre-registered as views)."""

from __future__ import annotations

from .quality_rules import STOP_WORDS, THRESHOLDS
from .url_filter import HOST_RULES

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def lower(x: str) -> str:
    return LOWER.format(x)


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({x}, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


def dedup_ctes(src: str, min_docs: int = 10) -> str:
    """CTEs up to ``ld_kept(doc_id, n_lines, n_dropped, kept)`` over ``src(doc_id, text)``."""
    return f"""
ld_docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {src}),
ld_lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM ld_docs),
ld_keyed AS (SELECT doc_id, line, pos, {lower(f"trim(line, {_WS})")} AS k FROM ld_lines),
ld_often AS (SELECT k FROM ld_keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= {min_docs}),
ld_marked AS (SELECT l.*, o.k IS NOT NULL AS gone FROM ld_keyed l LEFT JOIN ld_often o ON l.k = o.k),
ld_kept AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept FROM ld_marked GROUP BY doc_id)"""


OP1 = f"""WITH {dedup_ctes("documents")}
SELECT doc_id, n_lines::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(kept) AS kept_sha256 FROM ld_kept"""


def quality_ctes(src: str) -> str:
    """CTEs up to ``q_out`` over ``src(doc_id, text)``: the metrics and ``base_failed``, ``kept``."""
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    rules = " AND ".join(f"{m} {op} {b!r}" for m, op, b in THRESHOLDS)

    def ratio(a: str, b: str) -> str:
        return f"CASE WHEN {b} > 0 THEN {a}::DOUBLE / {b} ELSE 0.0 END"

    return f"""
q_docs AS (SELECT doc_id, coalesce(text, '') AS text, {words("text")} AS ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM {src}),
q_grams AS (SELECT doc_id, i, list_slice(ws, i, i + 4) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM q_docs WHERE len(ws) >= 5)),
q_twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM q_grams)
  WHERE n >= 2),
q_rep AS (SELECT doc_id, count(DISTINCT w) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS w FROM q_twice) GROUP BY doc_id),
q_counts AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words,
  coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls)::BIGINT AS n_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
  len(list_filter(ws, lambda w: lower(w) IN ({stop})))::BIGINT AS n_stop_words,
  length(regexp_replace(text, '[^A-Z]+', '', 'g'))::BIGINT AS n_upper
  FROM q_docs d LEFT JOIN q_rep USING (doc_id)),
q_ratios AS (SELECT *, {ratio("n_repeat_words", "n_words")} AS repeat_ratio,
  {ratio("word_chars", "n_words")} AS mean_word_chars, {ratio("n_symbols", "n_words")} AS symbol_ratio,
  (n_stop_words + 1) / (n_words + 1) AS stop_word_ratio, {ratio("n_upper", "word_chars")} AS upper_ratio,
  {ratio("n_dup_lines", "n_lines")} AS dup_line_ratio,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM q_counts),
q_out AS (SELECT *, NOT base_failed AND ({rules}) AS kept FROM q_ratios)"""


OP3 = f"""WITH {quality_ctes("documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM q_out"""


def _op4() -> str:
    rules = ", ".join(
        f"('{a}', '{t.partition('/')[0]}', '/{t.partition('/')[2]}', '{t}')" for a, t in HOST_RULES
    )
    patterns = [
        r"(?:[^a-z0-9_.%-]|$)utm_source=feed(?:[^a-z0-9_.%-]|$)",
        r"(?:[^a-z0-9_.%-]|$)utm_medium=.*(?:[^a-z0-9_.%-]|$)utm_campaign=",
        r"(?:[^a-z0-9_.%-]|$)(?:sessionid|phpsessid)=",
        r"/wp-login\.php|/cgi-bin/.*\.exe|-casino-|/porn/|/warez/",
        r"://(?:[^/?#]*\.)?(?:ads\..*/banner/|adserver\.)",
        r"(?:\.casino|/viagra|(?:[^a-z0-9_.%-]|$)xxx)(?:[^a-z0-9_.%-]|$)",
    ]
    hit = " OR ".join(f"regexp_matches(low, '{p}')" for p in patterns)
    return f"""WITH rules(action, rhost, rpath, rule) AS (VALUES {rules}),
cut AS (SELECT page_id, {lower("url")} AS low, CASE WHEN strpos(url, '://') > 0
  THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, low, {lower("regexp_extract(rest, '^[^/?#]*')")} AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
  FROM parts, rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id)
SELECT p.page_id, p.host, p.path, f.rule,
  CASE WHEN f.action IS NOT NULL THEN f.action
  WHEN (host <> '' OR path <> '') AND ({hit}) THEN 'block' ELSE 'allow' END AS verdict
FROM parts p LEFT JOIN fits f USING (page_id)"""


OP4 = _op4()

def near_ctes(src: str, num: int = 85, den: int = 100) -> str:
    """Recursive CTEs up to ``nd_out(doc_id, n_shingles, component_id)`` over ``src(doc_id, text)``."""
    return f"""
nd_docs AS (SELECT doc_id, {words(lower("text"))} AS ws FROM {src}),
nd_sh AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') || ' '
    ELSE array_to_string(list_slice(ws, i, i + 4), ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM nd_docs WHERE len(ws) > 0)),
nd_n AS (SELECT doc_id, count(*) AS n FROM nd_sh GROUP BY doc_id),
nd_common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM nd_sh x JOIN nd_sh y
  ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
nd_edge AS (SELECT a, b FROM nd_common JOIN nd_n p ON a = p.doc_id JOIN nd_n q ON b = q.doc_id
  WHERE {den} * c >= {num} * (p.n + q.n - c)),
nd_reach(a, b) AS (SELECT doc_id, doc_id FROM nd_docs
  UNION SELECT r.a, e.b FROM nd_reach r JOIN nd_edge e ON r.b = e.a),
nd_out AS (SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id FROM nd_docs d
  LEFT JOIN nd_n n USING (doc_id)
  JOIN (SELECT a AS doc_id, min(b) AS component_id FROM nd_reach GROUP BY a) m USING (doc_id))"""


OP5 = f"""WITH RECURSIVE {near_ctes("documents")}
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM nd_out"""

OP8 = """WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to FROM g"""

_FINITE = "len(list_filter({0}, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def lloyd_ctes(rounds: int, width: int) -> str:
    """CTEs ``a0 .. a{rounds}`` (id, p, m = distance * 256 + entry) and the codebooks ``b0 .. b{rounds}`` (p, e, v, n),
    from ``x(vec_id, p, v, n)`` and ``b0``; ``n`` is a vector's squared length."""
    out = []
    for i in range(rounds + 1):
        out.append(
            f"a{i} AS MATERIALIZED (SELECT x.vec_id, x.p, "
            f"min((x.n + b.n - 2 * list_inner_product(x.v, b.v))::BIGINT * 256 + b.e) AS m "
            f"FROM x JOIN b{i} b ON x.p = b.p GROUP BY ALL)"
        )
        if i < rounds:
            out.append(
                f"s{i} AS MATERIALIZED (SELECT p, e, list(c ORDER BY j) AS v FROM (SELECT x.p, a.m % 256 AS e, j, "
                f"floor(sum(x.v[j]) / count(*)) AS c FROM a{i} a JOIN x USING (vec_id, p), range(1, {width} + 1) r(j) "
                f"GROUP BY ALL) GROUP BY p, e)"
            )
            out.append(
                f"b{i + 1} AS MATERIALIZED (SELECT p, e, v, list_inner_product(v, v) AS n FROM "
                f"(SELECT b.p, b.e, coalesce(s.v, b.v) AS v FROM b{i} b LEFT JOIN s{i} s ON b.p = s.p AND b.e = s.e))"
            )
    return ",\n".join(out)


OP11 = f"""WITH kept AS MATERIALIZED (SELECT vec_id, label,
  list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings WHERE {_FINITE.format("embedding")}),
x AS MATERIALIZED (SELECT *, list_inner_product(v, v) AS n FROM
  (SELECT vec_id, label, p, v[1 + 16 * p : 16 * (p + 1)] AS v FROM kept, range(4) r(p))),
b0 AS MATERIALIZED (SELECT p, e, v, n FROM x
  JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 256) USING (vec_id)),
{lloyd_ctes(4, 16)},
r AS (SELECT vec_id, string_agg(printf('%02x', m % 256), '' ORDER BY p) AS code, sum(m // 256)::BIGINT AS error
  FROM a4 GROUP BY vec_id),
d AS (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda c: c::BIGINT), ','), ',' ORDER BY p, e)) AS h FROM b4)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM r JOIN kept USING (vec_id), d"""

OP12 = f"""WITH x AS MATERIALIZED (SELECT *, list_inner_product(v, v) AS n FROM (SELECT vec_id, 0 AS p,
  list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND {_FINITE.format("embedding")})),
b0 AS MATERIALIZED (SELECT p, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS e, v, n FROM x QUALIFY e < 16),
{lloyd_ctes(3, 64)}
SELECT vec_id, (m % 256)::INTEGER AS cluster, m // 256 AS distance,
  (sum(m // 256) OVER (PARTITION BY m % 256))::BIGINT AS cluster_inertia, (sum(m // 256) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(b.v, lambda c: c::BIGINT), ',')) AS centroid_sha256
FROM a3 JOIN b3 b ON b.e = m % 256"""

ORACLE_SQL = {
    "op11_vector_codes": OP11,
    "op12_centroids": OP12,
    "op8_warc_round_trip": OP8,
    "op1_line_dedup": OP1,
    "op3_quality_rules": OP3,
    "op4_url_filter": OP4,
    "op5_minhash_dedup": OP5,
}

"""The corpus operators as queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import documents
from .filter_audit import audit
from .line_dedup import line_dedup
from .mixing import mixed
from .near_dedup import near_dedup
from .nearest import nearest
from .packing import best_fit_packing
from .quality_model import quality_scores
from .quality_rules import quality_rules
from .set_join import set_join
from .sharding import kd_shards
from .spelling import spelling_variants
from .substring_dedup import substring_dedup
from .url_filters import UrlRule, url_filters

URL_RULES = [
    UrlRule("com", "/en/", allow=False),
    UrlRule("example.com", "/en/7", allow=True),
    UrlRule("net", "/de/", allow=True),
    UrlRule("example.net", "/de/8", allow=False),
    UrlRule("org", "/es/", allow=False),
]


def op1_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(documents(spark, sf_dir), shards=8)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir), width=50, with_text=False)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir), min_docs=10, min_chars=1, with_text=False)


def op4_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(documents(spark, sf_dir)).drop("_id", "_th")


def op5_posting_list_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(documents(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", 10)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(documents(spark, sf_dir))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir), width=3, percent=85)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters(documents(spark, sf_dir, "pages"), URL_RULES)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir), damage=97)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join(documents(spark, sf_dir), width=4, percent=85)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_kd_sharding, op2_substring_dedup, op3_line_dedup, op4_pfair_mixing, op5_posting_list_search, op6_quality_rules, op7_quality_classifier, op8_best_fit_packing, op9_near_dedup, op10_url_filters, op11_spelling_variants, op12_filter_audit, op13_ngram_join)
}

_SPACE = r"[\x20\x09-\x0D]"
_EACH_WORD = rf"""
ws AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> '') AS w FROM documents)"""

def _components_sql(width: int, percent: int, kept: str) -> str:
    """Components of documents whose word shingles have at least that similarity, through all pairs that share one."""
    return rf"""
WITH RECURSIVE ws AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + {width - 1}], ' ') AS s FROM (SELECT doc_id, w, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [1] ELSE range(1, len(w) - {width - 2}) END) AS i FROM ws)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT x, b FROM reach JOIN both_ways ON y = a)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c AS component_id{kept}
FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS c FROM reach GROUP BY x) USING (doc_id)"""


SQL = {
    "op2_substring_dedup": f"""
WITH {_EACH_WORD},
win AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM ws)),
firsts AS (SELECT k, min(doc_id) AS d FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM win JOIN firsts USING (k) WHERE doc_id > d),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM ws),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM ws LEFT JOIN kept USING (doc_id)""",
    "op3_line_dedup": r"""
WITH line AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (SELECT *, translate(regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM line),
common AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
j AS (SELECT keyed.*, common.k IS NOT NULL AS d FROM keyed LEFT JOIN common ON keyed.k = common.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE d) AS n_dropped, sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (WHERE NOT d), '')) AS kept_sha256
FROM j GROUP BY doc_id""",
    "op6_quality_rules": rf"""
WITH {_EACH_WORD},
tri AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i : i + 2], ' ')) AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM ws)),
rep AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM tri WHERE c > 1) GROUP BY doc_id),
ls AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x FROM documents) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT doc_id, coalesce(text, '') AS text, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM documents JOIN ws USING (doc_id) LEFT JOIN ls USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 30 * n_words OR (n_lines > 4 AND 100 * n_dup_lines > 60 * n_lines) OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 100 * len(regexp_extract_all(text, '!!')) > 30 * n_words OR 2 * length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) > word_chars) AS kept
FROM b""",
    "op9_near_dedup": _components_sql(3, 85, ", doc_id = c AS kept"),
    "op13_ngram_join": _components_sql(4, 85, ""),
    # exact neighbours: what the lists give while a query's ratio and LEAST take in all of them, as in tables up to sf0.1
    "op5_posting_list_search": r"""
WITH v AS (SELECT vec_id, min(CAST(embedding AS DOUBLE[])) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0 GROUP BY vec_id),
fine AS (SELECT * FROM v WHERE len(x) = (SELECT len(x) FROM v GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)),
near AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) AS score FROM fine q JOIN fine c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM near QUALIFY rank <= 10""",
    # the rules of URL_RULES, then the same rounds over the link graph with the same end
    "op10_url_filters": r"""
WITH RECURSIVE rules(h, p, a) AS (VALUES ('com', '/en/', false), ('example.com', '/en/7', true), ('net', '/de/', true), ('example.net', '/de/8', false), ('org', '/es/', false)),
page AS (SELECT page_id, html, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
fit AS (SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(a, length(h || p)) AS allowed FROM (SELECT DISTINCT host, path FROM page) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path),
judged AS (SELECT page.*, rule, allowed FROM page LEFT JOIN fit USING (host, path)),
seed AS (SELECT host, avg(CASE WHEN allowed THEN 1 ELSE 0 END) AS good, avg(CASE WHEN NOT allowed THEN 1 ELSE 0 END) AS bad FROM judged WHERE host <> '' GROUP BY host),
ref AS (SELECT host AS src, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?((?:https?:)?//[^"''\s>]+)', 1)) AS x FROM page),
link AS (SELECT src, dst, count(*) AS n FROM (SELECT src, translate(regexp_extract(x, '//([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM ref) WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY src, dst),
share AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS w FROM link),
own AS (SELECT host, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad FROM (SELECT host FROM seed UNION SELECT src FROM link UNION SELECT dst FROM link) LEFT JOIN seed USING (host)),
step AS (SELECT host, good AS trust, bad AS distrust, 1.0::DOUBLE AS moved, 0 AS k FROM own
  UNION ALL
  SELECT host, t, d, greatest(abs(t - trust), abs(d - distrust)), k + 1
  FROM (SELECT own.host, s.k, s.trust, s.distrust, max(s.moved) OVER () AS most,
      own.good + 0.85 * coalesce(f.t, 0) AS t, own.bad + (1 - own.bad) * 0.85 * coalesce(b.d, 0) AS d
    FROM own JOIN step s ON s.host = own.host
    LEFT JOIN (SELECT dst AS host, sum(w * trust) AS t FROM share JOIN step ON step.host = src GROUP BY dst) f ON f.host = own.host
    LEFT JOIN (SELECT src AS host, sum(w * distrust) AS d FROM share JOIN step ON step.host = dst GROUP BY src) b ON b.host = own.host)
  WHERE most > 1e-3),
held AS (SELECT host, trust, distrust FROM step WHERE k = (SELECT max(k) FROM step))
SELECT page_id, host, path, rule, CASE WHEN coalesce(allowed, NOT coalesce(distrust > trust AND distrust >= 0.75 - 1e-9, false)) THEN 'allow' ELSE 'block' END AS verdict
FROM judged LEFT JOIN held USING (host)""",
    # the checksum of an occurrence bit by bit: each byte is mixed in, then eight shifts (-1) follow
    "op11_spelling_variants": r"""
WITH RECURSIVE run AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, r, count(*) AS c FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM documents) GROUP BY ALL),
bits AS (SELECT *, hex(encode(d || ':' || r)) AS x FROM run),
steps AS (SELECT d, r, c, list_prepend(4294967295, flatten(list_transform(range(1, length(x), 2), lambda i: [CAST('0x' || substr(x, i, 2) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))) AS s FROM bits),
summed AS (SELECT d, r, c, xor(list_reduce(s, lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) AS h FROM steps),
seen AS (SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, c FROM summed),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM seen WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
del AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS k FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS m FROM del a JOIN del b ON a.k = b.k AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM del a JOIN v b ON a.k = b.word UNION SELECT b.word, b.n, a.word, a.n FROM del a JOIN v b ON a.k = b.word),
best AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY m DESC, other) = 1),
known AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * v.n THEN other END AS form, CASE WHEN m >= 2 * v.n THEN m END AS form_n FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS last FROM known UNION ALL SELECT walk.word, form FROM walk JOIN known ON known.word = last WHERE form IS NOT NULL)
SELECT known.word, form, last AS root, n, n_near, form_n FROM known JOIN walk ON walk.word = known.word WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.word = last AND k.form IS NOT NULL)""",
    "op12_filter_audit": rf"""
WITH RECURSIVE {_EACH_WORD},
fact AS (SELECT d.doc_id, coalesce(source, '') AS part, len(w) < 50 AS fa, 100 * len(list_distinct(w)) < 65 * len(w) AS fb, 100 * length(regexp_replace(coalesce(text, ''), '[^A-Z]+', '', 'g')) > 5 * length(coalesce(text, '')) AS fc,
    regexp_matches(coalesce(text, ''), '[#$%&*|]') AS fd, d.doc_id > min(d.doc_id) OVER (PARTITION BY coalesce(text, '')) AS fe, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad
  FROM documents d JOIN ws USING (doc_id) LEFT JOIN labels l ON l.doc_id = d.doc_id),
mask AS (SELECT part, good, bad, fa::INT + 2 * fb::INT + 4 * fc::INT + 8 * fd::INT + 16 * fe::INT AS m, count(*) AS n FROM fact GROUP BY ALL),
perm AS (SELECT '' AS o UNION ALL SELECT o || c FROM perm, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(c) WHERE NOT contains(o, c)),
step AS (SELECT o, s, 1 << (ord(o[s]) - 65) AS bit, coalesce(list_sum(list_transform(range(1, s), lambda i: 1 << (ord(o[i]) - 65))), 0)::INT AS early FROM perm, range(1, 6) r(s) WHERE length(o) = 5)
SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, coalesce(CAST(sum(n) FILTER (WHERE m & (early | bit) = 0) AS BIGINT), 0) AS kept, coalesce(CAST(sum(n) FILTER (WHERE m & bit > 0 AND m & early = 0) AS BIGINT), 0) AS removed,
  coalesce(CAST(sum(n) FILTER (WHERE m & bit > 0 AND m & early > 0) AS BIGINT), 0) AS redundant, coalesce(CAST(sum(n) FILTER (WHERE m = bit) AS BIGINT), 0) AS unique_fails,
  coalesce(CAST(sum(n) FILTER (WHERE good AND m & bit > 0 AND m & early = 0) AS BIGINT), 0) AS good_lost, coalesce(CAST(sum(n) FILTER (WHERE bad AND m & bit > 0 AND m & early = 0) AS BIGINT), 0) AS toxic_lost,
  coalesce(CAST(sum(n * 120 // greatest(bit_count(m), 1)) FILTER (WHERE m & bit > 0) AS BIGINT), 0) AS shapley
FROM mask, step GROUP BY part, o, s""",
}

"""The library's queries over the test tables, each with SQL for another engine where SQL can express it.

Person rows are made from documents: names are a text's first words, other columns are built from keys, so that every
rule has rows that it catches and rows that it does not."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import compare, status, text
from ..operators import content, linkage, merge, quality, repair
from .ratio_sql import compared
from .scratch import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_TIPO = "CASE WHEN doc_id % 11 < 5 THEN 'ingresado' WHEN doc_id % 11 < 8 THEN 'desaparecido' WHEN doc_id % 11 < 10 THEN 'dado_de_alta' ELSE 'fallecido' END"
_PEOPLE = {
    "id": "doc_id",
    "cedula": "CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN concat('V-', CAST(10000000 + doc_id % 300 AS STRING)) WHEN doc_id % 7 = 2 THEN '1111111' WHEN doc_id % 7 = 3 THEN '2345678' WHEN doc_id % 7 = 4 THEN CAST(doc_id % 100 AS STRING) ELSE CAST(7000000 + doc_id * 37 % 500 AS STRING) END",
    "edad": "CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 9 = 1 THEN '20-25' WHEN doc_id % 9 = 2 THEN ' 42 ' WHEN doc_id % 9 = 3 THEN '4.7' ELSE CAST(n_chars % 140 AS STRING) END",
    "sexo": "CASE WHEN doc_id % 5 = 0 THEN 'M' WHEN doc_id % 5 = 1 THEN 'Femenino' WHEN doc_id % 5 = 2 THEN 'otro' WHEN doc_id % 5 = 3 THEN ' masculino ' ELSE NULL END",
    "tipo_reporte": _TIPO,
    "estado": "CASE WHEN doc_id % 6 = 0 THEN 'Fue localizada hoy' WHEN doc_id % 6 = 1 THEN 'no localizado' WHEN doc_id % 6 = 2 THEN 'hospitalizado en UCI' WHEN doc_id % 6 = 3 THEN 'Fallecida' WHEN doc_id % 6 = 4 THEN 'sigue desaparecida' ELSE NULL END",
    "hospital": "CASE WHEN CAST(floor(doc_id / 20) AS BIGINT) % 4 = 0 THEN concat('Hosp. ', source) WHEN CAST(floor(doc_id / 20) AS BIGINT) % 4 = 1 THEN concat('hosp ', source) WHEN CAST(floor(doc_id / 20) AS BIGINT) % 4 = 2 THEN concat('HOSP  ', source, '.') ELSE NULL END",
    "ciudad": "lang",
    "telefono_familiar": "CASE WHEN doc_id % 3 = 0 THEN concat('+58 ', CAST(4120000000 + doc_id AS STRING)) WHEN doc_id % 3 = 1 THEN CAST(doc_id AS STRING) ELSE '' END",
    "foto_url": "CASE WHEN doc_id % 2 = 0 THEN concat('http://fotos/', CAST(doc_id % 40 AS STRING)) ELSE 'data:image/png;base64,AAAA' END",
    "notas": "CASE WHEN doc_id % 8 = 0 THEN 'JosÃ© &amp; familia' WHEN doc_id % 8 = 1 THEN 'sin novedad' ELSE NULL END",
}
#: A name: the first words of a text; of some texts all of the first line.
_NAME, _LINE = r"^[^ \n]+( [^ \n]+)?( [^ \n]+)?", r"^[^\n]+"
_WHO = "CASE WHEN doc_id % 13 = 0 THEN concat(regexp_extract(coalesce(text, ''), '{name}', 0), ' 7') WHEN doc_id % 17 = 0 THEN 'Persona sin datos' WHEN doc_id % 19 = 0 THEN regexp_extract(coalesce(text, ''), '{line}', 0) WHEN doc_id % 23 = 0 THEN lang WHEN doc_id % 29 = 0 THEN 'N/A' ELSE regexp_extract(coalesce(text, ''), '{name}', 0) END"


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    who = _WHO.format(name=_NAME.replace("\\n", "\\\\n"), line=_LINE.replace("\\n", "\\\\n"))
    return docs.select(F.expr(who).alias("nombre"), *(F.expr(e).alias(c) for c, e in _PEOPLE.items()))


_P = "WITH people AS (SELECT " + _WHO.format(name=_NAME, line=_LINE) + " AS nombre, " + ", ".join(f"{e.replace('AS STRING', 'AS VARCHAR')} AS {c}" for c, e in _PEOPLE.items()) + " FROM documents)"
_NORM = "upper(trim(regexp_replace(strip_accents({}), '[^a-zA-Z]+', ' ', 'g')))"
_PLACE = r"trim(regexp_replace(regexp_replace(upper(coalesce({}, '')), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _sound(x: str) -> str:
    x = f"regexp_replace(replace(replace(replace(lower({x}), 'v', 'b'), 'll', 'y'), 'z', 's'), 'c([ei])', 's\\1', 'g')"
    x = f"regexp_replace(regexp_replace(replace(replace(replace({x}, 'qu', 'k'), 'c', 'k'), 'h', ''), 'g([ei])', 'j\\1', 'g'), 'y$', 'i')"
    for letter in "abcdefghijklmnopqrstuvwxyz":
        x = f"regexp_replace({x}, '{letter}{letter}+', '{letter}', 'g')"
    return x


_TOKENS = "list_filter(string_split(norm, ' '), lambda t: t <> '')"
_N = f"{_P}, norms AS (SELECT *, {_NORM.format('nombre')} AS norm FROM people WHERE coalesce(nombre, '') <> ''), toks AS (SELECT *, {_TOKENS} AS tk FROM norms)"
_CODES = f"{_N}, coded AS (SELECT *, list_transform(tk, lambda t: {_sound('t')}) AS cs FROM toks)"
_BLOCKS = f"{_CODES}, freqs AS (SELECT *, cs[1] AS code, count(*) OVER (PARTITION BY cs[1]) AS freq FROM coded WHERE coalesce(cs[1], '') <> ''), blocks AS (SELECT *, CASE WHEN freq <= {{split}} THEN code ELSE concat(code, ':', CASE WHEN coalesce(cs[2], '') = '' THEN '(sin_segundo)' ELSE substr(cs[2], 1, 3) END) END AS block_key FROM freqs)"
_BLOCKS_60 = _BLOCKS.replace("{split}", "60")


@query("WITH o AS (SELECT doc_id, sha256(coalesce(text, '')) AS checksum, row_number() OVER (PARTITION BY sha256(coalesce(text, '')) ORDER BY doc_id) = 1 AS is_new FROM documents) SELECT * FROM o")
def content_new_vs_seen(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("body"))
    return content.new_or_seen(docs, ["doc_id"]).select("doc_id", "checksum", "is_new")


@query("SELECT sha256(coalesce(text, '')) AS checksum, min(doc_id) AS first_seen, count(*) AS copies FROM documents GROUP BY 1")
def checksum_registry(spark, sf_dir):
    return content.registry(table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("body")), "doc_id")


@query("SELECT l_returnflag, count(*) AS n FROM (SELECT l_orderkey, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1) WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1")
def append_new_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey")
    known = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return content.append_new(known, rows.groupBy("l_orderkey").agg(F.min("l_returnflag").alias("l_returnflag")), ["l_orderkey"]).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, concat('src:', substr(md5(concat('src:', c_name, ':', c_mktsegment)), 1, 12)) AS id, concat('cust:', substr(sha256(concat(c_name, '|', c_mktsegment)), 1, 16)) AS hashed FROM customer")
def stable_ids(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.stable_id(F.lit("src"), F.col("c_name"), F.col("c_mktsegment")).alias("id"), text.hashed_id("cust", F.col("c_name"), F.col("c_mktsegment")).alias("hashed"))


@query("SELECT event_id, nullif(trim(json_extract_string(props, '$.k')), '') AS k FROM events")
def json_field_projection(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.blank_to_null(F.get_json_object("props", "$.k")).alias("k"))


@query(r"SELECT page_id, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS title, len(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS n_links, array_to_string(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1), ' ') AS links FROM pages")
def html_extract(spark, sf_dir):
    links = F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<h1>([^<]*)</h1>", 1).alias("title"), F.size(links).cast("long").alias("n_links"), F.array_join(links, " ").alias("links"))


@query(r"SELECT page_id, md5(replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&nbsp;', ' '), '&quot;', chr(34)), '&#39;', ''''), '&apos;', ''''), '&lt;', '<'), '&gt;', '>'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&')) AS plain_md5 FROM pages")
def html_to_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text.decode_entities(text.strip_tags(F.col("html"))).cast("binary")).alias("plain_md5"))


@query(r"SELECT page_id, coalesce(try_cast(nullif(regexp_extract(url, '[?&]page=(\d+)(?:[&#]|$)', 1), '') AS BIGINT), 0) AS page FROM pages")
def url_query_param(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.query_number(F.col("url"), "page").alias("page"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'fallecido' WHEN 'O' THEN 'ingresado' ELSE 'desaparecido' END AS tipo, CASE o_orderstatus WHEN 'F' THEN 'Fallecido' WHEN 'O' THEN 'Ingresado' ELSE 'Desaparecido' END AS estado FROM orders")
def status_map(spark, sf_dir):
    raw = F.when(F.col("o_orderstatus") == "F", "Muerto").when(F.col("o_orderstatus") == "O", "EN TRATAMIENTO").otherwise("xyz")
    tipo = status.map_status(raw)
    return table(spark, sf_dir, "orders").select("o_orderkey", tipo.alias("tipo"), status.default_state_text(F.lit(None).cast("string"), tipo).alias("estado"))


@query(f"{_P} SELECT id, CASE WHEN estado = 'no localizado' THEN 'desaparecido' WHEN estado = 'Fue localizada hoy' THEN 'dado_de_alta' WHEN estado = 'Fallecida' THEN 'fallecido' WHEN estado = 'sigue desaparecida' THEN 'desaparecido' WHEN estado IS NOT NULL THEN 'ingresado' END AS suggested, CASE WHEN lower(sexo) = 'm' THEN 'Masculino' ELSE sexo END AS sexo, CASE WHEN foto_url NOT LIKE 'data:%' THEN foto_url END AS foto FROM people")
def status_keywords(spark, sf_dir):
    return people(spark, sf_dir).select("id", status.suggested_status(F.col("estado")).alias("suggested"), status.map_sex(F.col("sexo")).alias("sexo"), status.drop_inline_photo(F.col("foto_url")).alias("foto"))


@query(f"{_N} SELECT id, norm, {_PLACE.format('hospital')} AS place FROM norms")
def normalize_names(spark, sf_dir):
    return people(spark, sf_dir).filter("nombre <> ''").select("id", text.normalize_name(F.col("nombre")).alias("norm"), text.normalize_place(F.col("hospital")).alias("place"))


@query(f"{_CODES} SELECT id, array_to_string(cs, ' ') AS codes, len(list_distinct(cs)) AS n_codes FROM coded")
def phonetic_codes(spark, sf_dir):
    rows = linkage.prepared(people(spark, sf_dir))
    return rows.select("id", F.array_join(F.transform(text.name_tokens(F.col("norm")), text.phonetic_code), " ").alias("codes"), F.size("codes").cast("long").alias("n_codes"))


@query(f"{_BLOCKS_60} SELECT id, block_key, freq FROM blocks")
def block_keys(spark, sf_dir):
    return linkage.blocked(people(spark, sf_dir), scratch=Scratch(spark, "blocks")).select("id", "block_key", "freq")


@query(f"{_BLOCKS_60} SELECT block_key, count(*) AS n, CAST(count(*) * (count(*) - 1) // 2 AS BIGINT) AS pairs FROM blocks GROUP BY 1")
def pair_estimate(spark, sf_dir):
    return linkage.block_stats(linkage.blocked(people(spark, sf_dir), scratch=Scratch(spark, "blocks")))


@query(f"{_CODES}, s AS (SELECT cs[1] AS code, count(*) AS n FROM coded WHERE coalesce(cs[1], '') <> '' GROUP BY 1) SELECT CASE WHEN n = 1 THEN '1' WHEN n <= 60 THEN '2-60' ELSE '>60' END AS size_class, count(*) AS blocks, CAST(sum(n) AS BIGINT) AS people FROM s GROUP BY 1")
def block_histogram(spark, sf_dir):
    return linkage.block_histogram(people(spark, sf_dir))


_SIZES = f"{_CODES}, s AS (SELECT cs[1] AS code, count(*) AS n FROM coded WHERE coalesce(cs[1], '') <> '' GROUP BY 1)"


@query(f"{_SIZES} SELECT code, n FROM s WHERE n > 60 ORDER BY n DESC, code LIMIT 15")
def largest_blocks(spark, sf_dir):
    return linkage.largest_blocks(people(spark, sf_dir))


@query(f"{_SIZES} SELECT count(*) AS blocks, count(*) FILTER (WHERE n BETWEEN 2 AND 60) AS comparable, count(*) FILTER (WHERE n BETWEEN 2 AND 60) <= 500 AS covered, greatest(count(*) FILTER (WHERE n BETWEEN 2 AND 60) - 500, 0) AS left_out FROM s")
def block_coverage(spark, sf_dir):
    return linkage.block_coverage(people(spark, sf_dir))


_PAIRS = f"""{_BLOCKS_60}, r AS (SELECT *, list_distinct(cs) AS cd, {_PLACE.format('hospital')} AS place, CASE WHEN regexp_matches(edad, '^\\s*[+-]?\\d+\\s*$') THEN try_cast(trim(edad) AS INTEGER) END AS age FROM blocks),
near AS (SELECT a.id AS id_a, b.id AS id_b, CAST(len(list_intersect(a.cd, b.cd)) AS DOUBLE) / least(len(a.cd), len(b.cd)) AS c FROM r a JOIN r b ON a.block_key = b.block_key AND a.id < b.id AND lower(trim(a.nombre)) <> lower(trim(b.nombre)) AND a.place = b.place AND (a.age IS NULL OR b.age IS NULL OR abs(a.age - b.age) <= 2))"""


@query(f"{_PAIRS} SELECT id_a, id_b, round(c, 3) AS score FROM near WHERE round(c, 3) >= 0.82")
def containment_pairs(spark, sf_dir):
    scratch = Scratch(spark, "blocks")
    return linkage.containment_pairs(linkage.blocked(people(spark, sf_dir), scratch=scratch), scratch=scratch)


_ID = "CASE WHEN length(regexp_replace({x}, '[^0-9]', '', 'g')) BETWEEN 6 AND 9 THEN regexp_replace({x}, '[^0-9]', '', 'g') END"
_FUZZY = f"""{_PAIRS.replace("WITH people", "WITH RECURSIVE people")}, met AS (SELECT id_a, id_b, c, a.norm AS a, b.norm AS b, a.nombre AS nombre_a, b.nombre AS nombre_b, {_ID.format(x="a.cedula")} = {_ID.format(x="b.cedula")} AS same_id, a.age = b.age AS same_age FROM near JOIN r a ON a.id = id_a JOIN r b ON b.id = id_b),
{compared("SELECT a, b FROM met WHERE c >= 0.82 OR 2.0 * least(length(a), length(b)) >= 0.82 * (length(a) + length(b))", _sound)},
fuzzy AS (SELECT id_a, id_b, nombre_a, nombre_b, score, CASE WHEN same_id THEN 'ALTA' WHEN score = 1.0 AND same_age THEN 'MEDIA' ELSE 'BAJA' END AS tier FROM met JOIN cmp USING (a, b) WHERE category = 'fonetica')"""


@query(f"{_FUZZY} SELECT * FROM fuzzy")
def fuzzy_candidates(spark, sf_dir):
    scratch = Scratch(spark, "blocks")
    return linkage.candidates(linkage.blocked(people(spark, sf_dir), scratch=scratch), scratch)


@query(f"{_PAIRS}, g AS (SELECT id_a AS a, id_b AS b FROM near WHERE round(c, 3) >= 0.82 UNION SELECT id_b, id_a FROM near WHERE round(c, 3) >= 0.82), reach AS (SELECT a AS x, a AS y FROM g UNION SELECT x, b FROM reach JOIN g ON y = a) SELECT x AS id, min(y) AS component FROM reach GROUP BY 1".replace("WITH people", "WITH RECURSIVE people"))
def duplicate_components(spark, sf_dir):
    scratch = Scratch(spark, "clusters")
    rows = linkage.compared_rows(linkage.blocked(people(spark, sf_dir), scratch=scratch), scratch)
    return linkage.clusters(linkage.links(linkage.contained_names(rows, scratch), rows, scratch), scratch, ("",))


_GRAPHS = "g AS (SELECT id_a AS x, id_b AS y, t AS graph FROM fuzzy JOIN (VALUES ('ALTA'), ('ALTA+MEDIA')) v(t) ON contains(t, tier)), h AS (SELECT x, y, graph FROM g UNION SELECT y, x, graph FROM g), reach AS (SELECT x, x AS y, graph FROM h UNION SELECT reach.x, h.y, graph FROM reach JOIN h USING (graph) WHERE reach.y = h.x), comp AS (SELECT graph, x, min(y) AS component FROM reach GROUP BY 1, 2), n AS (SELECT t AS graph, count(DISTINCT component) AS clusters, count(x) AS inside FROM (VALUES ('ALTA'), ('ALTA+MEDIA')) v(t) LEFT JOIN comp ON graph = t GROUP BY 1)"


@query(f"{_FUZZY}, {_GRAPHS} SELECT graph, clusters, (SELECT count(*) FROM people) - inside AS outside, clusters + (SELECT count(*) FROM people) - inside AS estimate FROM n")
def unique_persons(spark, sf_dir):
    scratch = Scratch(spark, "unique")
    everyone = people(spark, sf_dir)
    rows = linkage.compared_rows(linkage.blocked(everyone, scratch=scratch), scratch)
    alike = linkage.alike_names(rows, scratch)
    pairs = linkage.links(alike, rows, scratch, "ALTA").unionByName(linkage.links(alike, rows, scratch, "MEDIA"))
    n = everyone.count()
    return linkage.unique_estimate(n, linkage.clusters(pairs, scratch, ("ALTA",))).withColumn("graph", F.lit("ALTA")).unionByName(linkage.unique_estimate(n, linkage.clusters(pairs, scratch, ("ALTA", "MEDIA"))).withColumn("graph", F.lit("ALTA+MEDIA")))


@query(f"{_FUZZY} SELECT * FROM fuzzy ORDER BY score DESC, id_a, id_b LIMIT 40")
def top_candidates(spark, sf_dir):
    return linkage.top_pairs(fuzzy_candidates(spark, sf_dir))


@query("SELECT o_orderkey, c_name, c_name IS NULL AS missing FROM orders LEFT JOIN customer ON o_custkey + 100 = c_custkey")
def registry_left_lookup(spark, sf_dir):
    known = table(spark, sf_dir, "customer").select((F.col("c_custkey") - 100).alias("o_custkey"), "c_name")
    found = repair.lookup(table(spark, sf_dir, "orders").select("o_custkey").distinct(), known, key="o_custkey")
    return table(spark, sf_dir, "orders").join(found, "o_custkey").select("o_orderkey", "c_name", (~F.col("found")).alias("missing"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def resume_anti(spark, sf_dir):
    return merge.resume(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT o_orderstatus, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def run_files_join(spark, sf_dir):
    runs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("checksum"), "o_orderstatus")
    return content.files_of(runs, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("checksum"))).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def _split_people(spark, sf_dir):
    rows = people(spark, sf_dir)
    new = rows.filter("id % 3 = 0").select(F.col("id").alias("row_id"), F.when(F.col("id") % 2 == 0, F.col("id") + 1).alias("id"), "cedula", "nombre", "hospital", "tipo_reporte")
    return new, rows.filter("id % 3 <> 0")


@query(f"""{_P}, new AS (SELECT id AS row_id, CASE WHEN id % 2 = 0 THEN id + 1 END AS id, cedula, nombre, hospital FROM people WHERE id % 3 = 0), known AS (SELECT * FROM people WHERE id % 3 <> 0),
m AS (SELECT row_id, (SELECT min(k.id) FROM known k WHERE k.id = n.id) AS m1, (SELECT min(k.id) FROM known k WHERE k.cedula = n.cedula AND trim(k.cedula) <> '') AS m2,
  (SELECT min(k.id) FROM known k WHERE lower(trim(k.nombre)) = lower(trim(n.nombre)) AND lower(trim(k.hospital)) = lower(trim(n.hospital)) AND k.nombre <> '' AND k.hospital <> '') AS m3 FROM new n)
SELECT row_id, coalesce(m1, m2, m3) AS match_id, CASE WHEN m1 IS NOT NULL THEN 'id' WHEN m2 IS NOT NULL THEN 'cedula' WHEN m3 IS NOT NULL THEN 'nombre_hospital' END AS matched_by FROM m""")
def cascade_match(spark, sf_dir):
    return merge.cascade(*_split_people(spark, sf_dir))


@query("""WITH r AS (SELECT o_custkey, o_totalprice, o_orderdate, o_orderkey, CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_orderkey % 10 = 0 THEN 'fallecido' ELSE 'ingresado' END WHEN 'O' THEN 'desaparecido' ELSE 'dado_de_alta' END AS kind FROM orders),
w AS (SELECT *, coalesce(max(CAST(kind = 'fallecido' AS INT)) OVER p, 0) = 0 AND (kind <> 'desaparecido' OR coalesce(max(CAST(kind <> 'desaparecido' AS INT)) OVER p, 0) = 0) AS ok FROM r WINDOW p AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT o_custkey, arg_max(kind, (o_orderdate, o_orderkey)) FILTER (WHERE ok) AS state, arg_max(o_totalprice, (o_orderdate, o_orderkey)) FILTER (WHERE ok) AS o_totalprice, count(*) FILTER (WHERE ok) AS n_accepted, count(*) AS n_reports FROM w GROUP BY 1""")
def status_fold(spark, sf_dir):
    kind = F.expr("CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_orderkey % 10 = 0 THEN 'fallecido' ELSE 'ingresado' END WHEN 'O' THEN 'desaparecido' ELSE 'dado_de_alta' END")
    return merge.folded(table(spark, sf_dir, "orders").withColumn("kind", kind), "o_custkey", "kind", ["o_orderdate", "o_orderkey"], ["o_totalprice"])


@query("SELECT coalesce(c_custkey, s_suppkey) AS k, coalesce(nullif(CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_name END, ''), s_name) AS name FROM customer FULL JOIN supplier ON c_custkey = s_suppkey")
def patch_merge(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.col("c_name")).alias("name"))
    return merge.patched(old, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")), "k", ["name"])


@query("SELECT c_custkey AS k, c_name AS name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier) UNION ALL SELECT s_suppkey, s_name FROM supplier")
def replace_merge(spark, sf_dir):
    return merge.replaced(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")), table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")), "k")


@query("WITH n AS (SELECT DISTINCT p_name AS name, lower(trim(p_name)) AS k FROM part), h AS (SELECT name, row_number() OVER (PARTITION BY name ORDER BY p_partkey) AS rank, p_partkey AS id FROM n JOIN part ON lower(trim(p_name)) = k) SELECT * FROM h WHERE rank <= 5")
def conflict_preview(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return merge.conflict_preview(part.select(F.col("p_name").alias("name")), part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("nombre")))


_MAY = "(k.tipo_reporte IS NULL OR k.tipo_reporte = 'desaparecido' OR (k.tipo_reporte <> 'fallecido' AND n.tipo_reporte <> 'desaparecido'))"


_IMPORT = f"""{_P}, n AS (SELECT id AS row_id, trim(nombre) AS nombre, coalesce(trim(hospital), '') AS hospital, coalesce(trim(cedula), '') AS cedula, tipo_reporte, concat('nota ', id) AS notas FROM people WHERE id % 3 = 0 AND trim(coalesce(nombre, '')) <> ''), k AS (SELECT * FROM people WHERE id % 3 <> 0),
a AS (SELECT cedula, min(id) AS id FROM k WHERE cedula <> '' GROUP BY 1), b AS (SELECT lower(nombre) AS x, lower(hospital) AS y, min(id) AS id FROM k WHERE hospital <> '' GROUP BY 1, 2),
h AS (SELECT n.*, a.id AS m1, b.id AS m2 FROM n LEFT JOIN a ON a.cedula = n.cedula LEFT JOIN b ON b.x = lower(n.nombre) AND b.y = lower(n.hospital))"""
_PLAN = f"""SELECT row_id, k.id, CASE WHEN m1 IS NOT NULL THEN 'cedula' ELSE 'nombre_hospital' END AS matched_by, n.notas FROM h n JOIN k ON k.id = coalesce(m1, m2) WHERE {_MAY}
UNION ALL SELECT row_id, k.id, 'nombre', concat(CASE WHEN k.tipo_reporte = n.tipo_reporte THEN '' ELSE concat('[Estado anterior: ', k.tipo_reporte, '] ') END, n.notas, CASE WHEN coalesce(k.notas, '') <> '' THEN concat(' | ', k.notas) ELSE '' END) FROM h n JOIN k ON lower(k.nombre) = lower(n.nombre) WHERE coalesce(m1, m2) IS NULL AND {_MAY}
UNION ALL SELECT row_id, NULL, 'insert', n.notas FROM h n WHERE coalesce(m1, m2) IS NULL AND lower(n.nombre) NOT IN (SELECT lower(nombre) FROM k WHERE nombre IS NOT NULL)"""


@query(f"{_IMPORT}\n{_PLAN}")
def import_plan(spark, sf_dir):
    rows = people(spark, sf_dir)
    new = rows.filter("id % 3 = 0").select(F.col("id").alias("row_id"), "cedula", "nombre", "hospital", "tipo_reporte", F.concat(F.lit("nota "), F.col("id").cast("string")).alias("notas"))
    return merge.import_plan(new, rows.filter("id % 3 <> 0"))


_IMPORTED = f"""{_IMPORT}, plan(row_id, id, matched_by, notas) AS ({_PLAN}), p AS (SELECT plan.row_id, plan.id, plan.notas, x.nombre, x.cedula, x.hospital, x.tipo_reporte FROM plan JOIN people x ON x.id = row_id),
f AS (SELECT *, min(CASE WHEN tipo_reporte = 'fallecido' THEN row_id END) OVER w AS dead, min(CASE WHEN tipo_reporte <> 'desaparecido' THEN row_id END) OVER w AS better FROM p WHERE id IS NOT NULL WINDOW w AS (PARTITION BY id)),
l AS (SELECT * FROM f WHERE row_id <= coalesce(dead, row_id) AND (tipo_reporte <> 'desaparecido' OR row_id < coalesce(better, row_id + 1)) QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_id DESC) = 1)
SELECT k.id, coalesce(l.nombre, k.nombre) AS nombre, coalesce(l.cedula, k.cedula) AS cedula, coalesce(l.hospital, k.hospital) AS hospital, coalesce(l.tipo_reporte, k.tipo_reporte) AS tipo_reporte, coalesce(l.notas, k.notas) AS notas, 0 AS created, CASE WHEN l.id IS NULL THEN 0 ELSE 1 END AS updated FROM k LEFT JOIN l ON l.id = k.id
UNION ALL SELECT row_id + 5000000, nombre, cedula, hospital, tipo_reporte, notas, 1, 1 FROM p WHERE id IS NULL QUALIFY row_number() OVER (PARTITION BY lower(trim(nombre)) ORDER BY row_id) = 1"""


@query(_IMPORTED)
def import_applied(spark, sf_dir):
    """The table after the import that import_plan plans."""
    rows = people(spark, sf_dir)
    new = rows.filter("id % 3 = 0").select(F.col("id").alias("row_id"), "cedula", "nombre", "hospital", "tipo_reporte", F.concat(F.lit("nota "), F.col("id").cast("string")).alias("notas"))
    known = rows.filter("id % 3 <> 0").select("id", "nombre", "cedula", "hospital", "tipo_reporte", "notas", F.lit(0).alias("created_at"), F.lit(0).alias("updated_at"))
    out = merge.imported(new, known, F.col("row_id") + 5000000, F.lit(1))
    return out.select("id", "nombre", "cedula", "hospital", "tipo_reporte", "notas", F.col("created_at").alias("created"), F.col("updated_at").alias("updated"))


_RUNS = "WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS files FROM events GROUP BY 1, 2), r AS (SELECT *, CASE WHEN extract(day FROM day) % 5 = 0 THEN 'failed' ELSE 'success' END AS status FROM d)"


@query(f"{_RUNS}, w AS (SELECT event_type, day, files, last_value(CASE WHEN status = 'success' THEN files END IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM r) SELECT event_type, CAST(day AS VARCHAR) AS day, files, previous, coalesce(previous > 0 AND files < 0.5 * previous, false) AS alert FROM w")
def volume_alert(spark, sf_dir):
    runs = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("files")).withColumn("status", F.when(F.dayofmonth("day") % 5 == 0, "failed").otherwise("success"))
    return content.volume_alert(runs, "event_type", "day", "status", "files").select("event_type", F.col("day").cast("string").alias("day"), "files", "previous", "alert")


@query("SELECT event_id, last_value(CASE WHEN event_id % 4 = 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM events")
def forward_fill(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("v", F.when(F.col("event_id") % 4 == 0, F.col("value")))
    return rows.select("event_id", content.forward_fill(rows, "v", ["user_id"], ["ts", "event_id"]).alias("carried"))


@query("SELECT role, count(*) AS files, CAST(coalesce(sum(CASE WHEN turn % 3 <> 0 THEN length(text) % 7 END), 0) AS BIGINT) AS records, count(*) FILTER (WHERE turn % 3 = 0) AS errors, count(*) FILTER (WHERE turn % 3 <> 0 AND length(text) % 7 = 0) AS empty FROM conversations GROUP BY 1")
def run_stats(spark, sf_dir):
    bad = F.col("turn") % 3 == 0
    files = table(spark, sf_dir, "conversations").select("role", F.when(~bad, F.length("text") % 7).alias("records"), F.when(bad, "broken").alias("error"))
    return content.parser_stats(files, "role", "records", "error")


def _rule(name: str, predicate, sql: str) -> None:
    def run(spark, sf_dir):
        rows = people(spark, sf_dir)
        return rows.filter(predicate(rows)).select("id", "nombre")

    QUERIES[name], SQL[name] = run, f"{_P} SELECT id, nombre FROM people WHERE {sql}"


_rule("quality_consonant_runs", lambda r: quality.consonant_runs(F.col("nombre")), "regexp_matches(lower(nombre), '[bcdfghjklmnpqrstvwxyzñ]{4,}')")
#: Of every 10th row all context is empty, of every 10th but one all but the condition.
_CONTEXT = {c: f"CASE WHEN id % 10 = 0 THEN {'NULL' if k % 2 else repr('')} WHEN id % 10 = 1 THEN {repr('grave') if c == 'condicion' else 'NULL'} ELSE {c if c in _PEOPLE else repr('x')} END" for k, c in enumerate(quality.CONTEXT)}


@query(f"{_P} SELECT id, nombre FROM (SELECT id, nombre, {', '.join(f'{e} AS {c}' for c, e in _CONTEXT.items())} FROM people) WHERE {' AND '.join(chr(40) + f'{c} IS NULL OR {c} = ' + repr('') + chr(41) for c in _CONTEXT)}")
def quality_no_context(spark, sf_dir):
    rows = people(spark, sf_dir).select("id", "nombre", *(F.expr(e).alias(c) for c, e in _CONTEXT.items()))
    return rows.filter(quality.no_context(rows)).select("id", "nombre")

_rule("quality_digits", lambda r: quality.has_digits(F.col("nombre")), "regexp_matches(nombre, '[0-9]')")
_rule("quality_long_names", lambda r: quality.too_long(F.col("nombre")), "length(nombre) > 100")
_rule("quality_placeholders", lambda r: quality.placeholder(F.col("nombre")), r"regexp_matches(lower(nombre), '\bdesconocid[oa]\b|\bsin\s+apellido\b|\bn/?a\b|\btest\b|\bprueba\b|\bxxx\b|\bsin\s+nombre\b|\bsin\s+datos\b|\beliminad[oa]\b')")
_rule("quality_same_as_place", lambda r: quality.in_wrong_column(F.col("nombre"), F.col("hospital"), F.col("ciudad")), "coalesce(upper(trim(nombre)) = upper(trim(hospital)) AND trim(hospital) <> '', false) OR coalesce(upper(trim(nombre)) = upper(trim(ciudad)) AND trim(ciudad) <> '', false)")
_rule("integrity_age", lambda r: quality.invalid_age(F.col("edad")), r"trim(edad) <> '' AND NOT (regexp_matches(trim(edad), '^[+-]?\d+$') AND coalesce(try_cast(trim(edad) AS BIGINT) BETWEEN 0 AND 120, false))")


@query(f"{_P}, e AS (SELECT hospital, count(*) AS n FROM people WHERE coalesce(hospital, '') <> '' GROUP BY 1), g AS (SELECT {_PLACE.format('hospital')} AS place_key, string_agg(hospital, '|' ORDER BY n DESC, hospital) AS spellings, count(*) AS n_spellings, CAST(sum(n) AS BIGINT) AS n_rows FROM e GROUP BY 1) SELECT * FROM g WHERE n_spellings > 1")
def quality_place_spellings(spark, sf_dir):
    return quality.place_spellings(people(spark, sf_dir))


@query(f"{_P} SELECT sexo, count(*) AS n FROM people WHERE coalesce(sexo, '') <> '' AND lower(trim(sexo)) NOT IN ('masculino', 'femenino') GROUP BY 1")
def integrity_sex(spark, sf_dir):
    return quality.invalid_sexes(people(spark, sf_dir))


@query(f"{_P}, d AS (SELECT id, regexp_replace(coalesce(cedula, ''), '[^0-9]', '', 'g') AS d FROM people) SELECT id, concat_ws(', ', CASE WHEN replace(d, d[1], '') = '' THEN 'repeated digit' END, CASE WHEN contains('01234567890123456789', d) OR contains('01234567890123456789', reverse(d)) THEN 'sequential' END, CASE WHEN length(d) NOT BETWEEN 6 AND 9 THEN concat('length ', length(d)) END) AS reasons FROM d WHERE d <> ''")
def integrity_ids(spark, sf_dir):
    return people(spark, sf_dir).select("id", quality.id_reasons(F.col("cedula")).alias("reasons")).filter("reasons is not null")


@query(f"{_P}, d AS (SELECT DISTINCT regexp_replace(cedula, '[^0-9]', '', 'g') AS id_digits, nombre FROM people WHERE coalesce(cedula, '') <> '' AND nombre IS NOT NULL), c AS (SELECT id_digits, count(*) AS n_names FROM d GROUP BY 1 HAVING count(*) > 1) SELECT id_digits, nombre, n_names FROM d JOIN c USING (id_digits)")
def shared_id_names(spark, sf_dir):
    return quality.shared_names(people(spark, sf_dir))


@query(f"""{_P.replace("WITH people", "WITH RECURSIVE people")}, d AS (SELECT DISTINCT regexp_replace(cedula, '[^0-9]', '', 'g') AS id_digits, nombre FROM people WHERE coalesce(cedula, '') <> '' AND nombre IS NOT NULL),
shared AS (SELECT id_digits, count(*) AS n_names, {_NORM.format("min(nombre)")} AS a, {_NORM.format("max(nombre)")} AS b FROM d GROUP BY 1 HAVING count(*) > 1), {compared("SELECT a, b FROM shared WHERE n_names = 2", _sound)}
SELECT id_digits, nombre, n_names FROM d JOIN shared USING (id_digits) LEFT JOIN cmp USING (a, b) WHERE n_names > 2 OR category = 'no_coincide'""")
def integrity_shared_ids(spark, sf_dir):
    return quality.shared_ids(people(spark, sf_dir))


@query(f"{_P}, u AS (SELECT id, 'telefono_familiar' AS field, telefono_familiar AS value FROM people UNION ALL SELECT id, 'cedula', cedula FROM people) SELECT id, field, value FROM u WHERE coalesce(value, '') <> '' AND length(regexp_replace(value, '[^0-9]', '', 'g')) NOT BETWEEN 7 AND 15")
def unpivot_phone_check(spark, sf_dir):
    return quality.invalid_phones(people(spark, sf_dir), ["telefono_familiar", "cedula"])


@query(f"{_P} SELECT foto_url, count(DISTINCT nombre) AS n_names, count(*) AS n_rows FROM people WHERE coalesce(foto_url, '') <> '' GROUP BY 1 HAVING count(DISTINCT nombre) >= 3")
def integrity_photos(spark, sf_dir):
    return quality.reused_photos(people(spark, sf_dir))


@query(f"{_P}, s AS (SELECT id, tipo_reporte, CASE WHEN estado IN ('no localizado', 'sigue desaparecida') THEN 'desaparecido' WHEN estado = 'Fue localizada hoy' THEN 'dado_de_alta' WHEN estado = 'Fallecida' THEN 'fallecido' WHEN estado IS NOT NULL THEN 'ingresado' END AS suggested FROM people) SELECT * FROM s WHERE suggested <> tipo_reporte")
def integrity_state(spark, sf_dir):
    return quality.state_mismatch(people(spark, sf_dir)).select("id", "tipo_reporte", "suggested")


@query(f"{_P} SELECT id, 'notas' AS field, notas AS value FROM people WHERE regexp_matches(notas, 'Ã[©±³¡¨º¤§¦¥¢]|&[a-zA-Z]+;')")
def mojibake_scan(spark, sf_dir):
    return quality.mojibake(people(spark, sf_dir), ["notas", "estado"])


_ALIKE = "nombre, cedula, edad, sexo, hospital, ciudad, condicion, tipo_reporte"
_TWICE = "SELECT id, {a}, CAST(NULL AS STRING) AS condicion FROM people UNION ALL SELECT id + 1000000, {a}, CASE WHEN id % 2 = 0 THEN 'grave' END FROM people WHERE id % 7 = 0".replace("{a}", _ALIKE.replace(" condicion,", ""))


@query(f"{_P}, p AS ({_TWICE.replace('AS STRING', 'AS VARCHAR')}), g AS (SELECT id, min(id) OVER w AS first_id, count(*) OVER w AS n FROM p WINDOW w AS (PARTITION BY {_ALIKE})) SELECT * FROM g WHERE n > 1")
def literal_duplicates(spark, sf_dir):
    """Every 7th row is there twice, every other one of these with another condition."""
    rows = spark.sql(_TWICE.replace("FROM people", "FROM {people}"), people=people(spark, sf_dir))
    return quality.literal_duplicates(rows, _ALIKE.split(", "))


@query(f"{_P} SELECT count(*) AS n_rows, count(*) FILTER (WHERE length(regexp_replace(coalesce(cedula, ''), '[^0-9]', '', 'g')) BETWEEN 6 AND 9) AS with_id, round(count(*) FILTER (WHERE length(regexp_replace(coalesce(cedula, ''), '[^0-9]', '', 'g')) BETWEEN 6 AND 9) * 100.0 / count(*), 6) AS percent FROM people")
def id_coverage(spark, sf_dir):
    return quality.id_coverage(people(spark, sf_dir)).withColumn("percent", F.col("percent").cast("double"))


@query(f"{_P}, c AS (SELECT id, CASE WHEN tipo_reporte = 'ingresado' AND regexp_matches(lower(estado), 'alta|egresado|localizado|encontrado|aparecido|reunited|discharged') THEN 'dado_de_alta' ELSE tipo_reporte END AS tipo_reporte, CASE WHEN NOT (regexp_matches(nombre, '^[0-9]+$') OR regexp_matches(nombre, '^[^\\p{{L}}\\p{{N}}\\s]+$') OR length(trim(nombre)) < 2) THEN nombre END AS nombre, CASE WHEN regexp_matches(cedula, '^\\d{{6,9}}$') THEN cedula END AS cedula FROM people) SELECT * FROM c WHERE trim(coalesce(nombre, '')) <> '' OR trim(coalesce(cedula, '')) <> ''")
def migrations_clean(spark, sf_dir):
    return quality.cleaned(people(spark, sf_dir)).select("id", "tipo_reporte", "nombre", "cedula")


@query(f"{_P} SELECT id, CASE WHEN tipo_reporte = 'dado_de_alta' THEN 'ingresado' ELSE tipo_reporte END AS tipo_reporte FROM people")
def migrations_restored(spark, sf_dir):
    return quality.restored(people(spark, sf_dir)).select("id", "tipo_reporte")


_VARIANTS = "SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN concat('R / ', p_name) WHEN p_partkey % 5 = 1 THEN concat(p_name, ' / <b>x</b>') WHEN p_partkey % 5 = 2 THEN concat('[3/4, 10:15] ', p_name, ' / x') WHEN p_partkey % 5 = 3 THEN concat(p_name, ' / C.I. registrada') ELSE concat(p_name, ' / ', p_brand, '/') END AS nombre FROM part"


def _variants(spark, sf_dir):
    return spark.sql(_VARIANTS.replace("FROM part", "FROM {part}"), part=table(spark, sf_dir, "part")).withColumn("notas", F.lit("n"))


@query(f"WITH v AS ({_VARIANTS}), s AS (SELECT *, trim(string_split(nombre, '/')[1]) AS f, length(trim(string_split(nombre, '/')[2])) AS l FROM v) SELECT id, nombre, CASE id % 5 WHEN 1 THEN 'posible_inyeccion' WHEN 2 THEN 'mensaje_multiple' WHEN 3 THEN 'notas_administrativas' ELSE CASE WHEN length(regexp_replace(f, '[^A-Za-zÀ-ÿ]', '', 'g')) <= 2 OR length(f) * 10 < l * 4 OR contains(lower(f), 'ilegible') THEN 'canonico_sospechoso' ELSE 'variantes_ocr' END END AS class FROM s")
def variant_classes(spark, sf_dir):
    return repair.variant_classes(_variants(spark, sf_dir))


@query(f"WITH v AS ({_VARIANTS}), s AS (SELECT *, trim(string_split(nombre, '/')[1]) AS f, trim(string_split(nombre, '/')[2]) AS g FROM v WHERE id % 5 = 4), t AS (SELECT * FROM s WHERE length(regexp_replace(f, '[^A-Za-zÀ-ÿ]', '', 'g')) > 2 AND length(f) * 10 >= length(g) * 4) SELECT id, 'nombre' AS field, nombre AS old_value, f AS new_value, 'W1' AS rule_id FROM t UNION ALL SELECT id, 'notas', 'n', concat('[Variantes de nombre detectadas: ', g, '] n'), 'W1' FROM t")
def variant_repairs(spark, sf_dir):
    return repair.variant_repairs(_variants(spark, sf_dir))


@query("SELECT c_custkey AS id, c_name AS nombre, c_mktsegment AS hospital, CASE WHEN c_custkey % 2 = 0 THEN 'http://fotos/1' END AS foto_url FROM customer")
def multipart_extract(spark, sf_dir):
    """Every other body has a photo's address, the rest an uploaded file, which is no field."""
    end = "\r\n----------------1\r\n"
    head = F.lit('Content-Disposition: attachment; name="nombre"\r\n\r\n')
    photo = F.when(F.col("c_custkey") % 2 == 0, 'name="foto"\n\nhttp://fotos/1').otherwise('name="foto"; filename="a.png"\r\nContent-Type: image/png\r\n\r\nbytes')
    blob = F.concat(head, "c_name", F.lit(end + 'Content-Disposition: form-data; name="pv_lugar"\r\n\r\n'), "c_mktsegment", F.lit(end), photo, F.lit(end + 'name="edad"\r\n\r\n' + end))
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), blob.alias("nombre"), F.lit("").alias("hospital"), F.lit(None).cast("string").alias("edad"), F.lit(None).cast("string").alias("foto_url"))
    return repair.apply_changes(rows, repair.multipart_repairs(rows)[0]).select("id", "nombre", "hospital", "foto_url")


_CHECKED = f"""{_P.replace("WITH people", "WITH RECURSIVE people")}, listed AS (SELECT regexp_replace(cedula, '[^0-9]', '', 'g') AS d, min(nombre) AS official FROM people WHERE id % 2 = 0 GROUP BY 1 HAVING coalesce(d, '') <> '' AND min(nombre) <> ''),
asked AS (SELECT id, official, {_NORM.format("coalesce(nombre, '')")} AS a, {_NORM.format("coalesce(official, '')")} AS b FROM people LEFT JOIN listed ON d = regexp_replace(cedula, '[^0-9]', '', 'g') WHERE coalesce(cedula, '') <> ''),
{compared("SELECT a, b FROM asked WHERE official IS NOT NULL", _sound)},
checked AS (SELECT id, CASE WHEN official IS NULL THEN 'sin_registro' ELSE category END AS category, official, CASE WHEN official IS NOT NULL THEN score END AS score FROM asked LEFT JOIN cmp USING (a, b))"""


@query(f"{_CHECKED} SELECT * FROM checked")
def registry_validation(spark, sf_dir):
    rows = people(spark, sf_dir)
    known = rows.filter("id % 2 = 0").groupBy(text.digits(F.col("cedula")).alias("cedula")).agg(F.min("nombre").alias("nombre")).filter("cedula <> ''")
    return repair.validated(rows, known)


@query(f"{_CHECKED} SELECT people.id, coalesce(category, 'antes') AS cedula_validacion, CASE WHEN category IS NULL THEN 'nombre' ELSE official END AS cedula_nombre_oficial, score AS cedula_similitud FROM people LEFT JOIN checked USING (id)")
def registry_writeback(spark, sf_dir):
    """Rows that were not checked keep what they had."""
    rows = people(spark, sf_dir).withColumns({"cedula_validacion": F.lit("antes"), "cedula_nombre_oficial": F.lit("nombre")})
    return repair.with_validation(rows, registry_validation(spark, sf_dir)).select("id", "cedula_validacion", "cedula_nombre_oficial", "cedula_similitud")


@query(f"{_CHECKED} SELECT kind AS category, count(id) AS n FROM (VALUES ('exacta'), ('exacta_reordenada'), ('fonetica'), ('no_coincide'), ('sin_registro')) v(kind) LEFT JOIN checked ON category = kind GROUP BY 1")
def registry_validation_stats(spark, sf_dir):
    return repair.validation_stats(registry_validation(spark, sf_dir))


@query(f"""{_P.replace("WITH people", "WITH RECURSIVE people")}, named AS (SELECT id, {_NORM.format("coalesce(nombre, '')")} AS a, {_NORM.format("coalesce(ciudad, '')")} AS b FROM people), {compared("SELECT a, b FROM named", _sound)}
SELECT id, category, score FROM named JOIN cmp USING (a, b)""")
def name_comparison(spark, sf_dir):
    rows = people(spark, sf_dir)
    return compare.compare_names(rows.select("id", "nombre", F.col("ciudad").alias("otro")), "nombre", "otro").select("id", "category", "score")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of probable duplicates with their sizes and pairs."""
    return pair_estimate(spark, sf_dir)


from . import source_queries as _sources  # noqa: E402, F401  registers its queries
from . import table_queries as _tables  # noqa: E402, F401

"""Queries over the test tables, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from entityspark.functions import contact, geo, text, values, web
from entityspark.operators import golden, identity, ordered, resolve
from entityspark.streaming import state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


#: Observations of companies, derived from customers by expressions that Spark and DuckDB read alike.
OBS = {
    "row_idx": "c_custkey",
    "observation_id": "concat('obs_', CAST(c_custkey AS STRING))",
    "source": "CASE c_custkey % 4 WHEN 0 THEN 'OSM' WHEN 1 THEN 'VK' WHEN 2 THEN 'Я.Карты' ELSE 'Crawler' END",
    "source_id": "CAST(c_custkey % 700 AS STRING)",
    "name": "CASE WHEN c_custkey % 31 = 0 THEN '' ELSE concat('Фирма № ', CAST(c_custkey % 120 AS STRING)) END",
    "city": "CASE c_nationkey % 5 WHEN 0 THEN 'г. Ялта' WHEN 1 THEN 'Симферополь' WHEN 2 THEN 'Крым' WHEN 3 THEN 'пгт Форос' ELSE '' END",
    "client_type": "CASE c_custkey % 5 WHEN 0 THEN 'avto' WHEN 1 THEN 'medicina' WHEN 2 THEN 'прочее' ELSE 'turizm' END",
    "phone": "CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat('8 (978) ', lpad(CAST(c_custkey % 300 AS STRING), 7, '0')) END",
    "email": "CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('office', CAST(c_custkey % 200 AS STRING), '@firm', CAST(c_custkey % 450 AS STRING), '.ru') END",
    "website": "CASE WHEN c_custkey % 5 < 2 THEN '' ELSE concat('https://WWW.firm', CAST(c_custkey % 50 AS STRING), '.ru/page') END",
    "address": "concat('Улица Ленина, ', CAST(c_custkey % 700 AS STRING))",
    "latitude": "CAST(44.4 AS DOUBLE) + CAST(c_custkey % 90 AS DOUBLE) / 100",
    "longitude": "CAST(33.4 AS DOUBLE) + CAST(c_custkey % 130 AS DOUBLE) / 100",
    "quality_flags": "CASE c_custkey % 6 WHEN 0 THEN 'vk_noise_primary|Manual_Review' WHEN 1 THEN ' low | low' ELSE '' END",
    "confidence": "CAST(50 + c_custkey % 50 AS DOUBLE) / 100",
    "first_seen": "concat('2026-08-', lpad(CAST(1 + c_custkey % 27 AS STRING), 2, '0'))",
    "last_seen": "concat('2026-09-', lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0'))",
    "cluster": "c_custkey % 400",
}
WITH_OBS = "WITH obs AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in OBS.items()) + " FROM customer)"
NORMAL = r"trim(regexp_replace(translate(lower({0}), 'ё', 'е'), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"
HOST = r"regexp_replace(lower(regexp_extract(regexp_replace({0}, '^[A-Za-z][A-Za-z0-9+.\-]*://', ''), '^([^/?#:]*)', 1)), '^www\.', '')"
DIGITS = "regexp_replace({0}, '[^0-9]', '', 'g')"


def obs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").selectExpr(*[f"{e} AS {n}" for n, e in OBS.items()])


# --- projections of text ---------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, {NORMAL.format('text')} AS normal FROM documents")
def q_text_normalize(spark, d):
    """Names in one form."""
    return table(spark, d, "documents").select("doc_id", text.normal_text(F.col("text")).alias("normal"))


@query(WITH_OBS + f""" SELECT row_idx, regexp_replace({NORMAL.format('city')}, '^(?:г|город|пгт|поселок|село) ', '') AS city,
  regexp_replace({NORMAL.format('address')}, '^улица', 'ул') AS address, regexp_extract({NORMAL.format('address')}, '([0-9]+)$', 1) AS house FROM obs""")  # fmt: skip
def q_city_address(spark, d):
    """Cities without their kind, addresses with short words, house numbers."""
    a = text.normal_address(F.col("address"))
    return obs(spark, d).select("row_idx", text.normal_city(F.col("city")).alias("city"), a.alias("address"), text.house_number(a).alias("house"))


@query(WITH_OBS + f""", p AS (SELECT row_idx, phone, {DIGITS.format('phone')} AS dg FROM obs)
SELECT row_idx, CASE WHEN length(dg) = 11 AND dg[1] = '8' THEN '7' || dg[2:] WHEN length(dg) = 10 THEN '7' || dg WHEN length(dg) BETWEEN 10 AND 15 THEN dg ELSE '' END AS digits,
  CASE WHEN length(dg) = 11 THEN '+7 (' || dg[2:4] || ') ' || dg[5:7] || '-' || dg[8:9] || '-' || dg[10:11] ELSE trim(phone) END AS shown FROM p""")  # fmt: skip
def q_phone_format(spark, d):
    """Comparable digits and the written form."""
    return obs(spark, d).select("row_idx", contact.phone_digits(F.col("phone")).alias("digits"), contact.phone_text(F.col("phone")).alias("shown"))


PHONES = r"(\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4})"


@query(rf"SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '{PHONES}', 1))) AS phone FROM documents")
def q_phone_extract(spark, d):
    """Distinct phones of a text."""
    return table(spark, d, "documents").select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(PHONES), F.lit(1)))).alias("phone"))


@query(rf"SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '({contact.EMAIL})', 1), lambda x: lower(x)), '|') AS emails FROM documents WHERE contains(text, '@')")
def q_email_extract(spark, d):
    """Addresses of a text in order."""
    e = F.transform(F.regexp_extract_all("text", F.lit(f"({contact.EMAIL})"), F.lit(1)), lambda x: F.lower(x))
    return table(spark, d, "documents").filter(F.col("text").contains("@")).select("doc_id", F.array_join(e, "|").alias("emails"))


@query(f"SELECT page_id, {HOST.format('url')} AS host, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS origin FROM pages")
def q_host_of(spark, d):
    """Hosts and origins."""
    return table(spark, d, "pages").select("page_id", web.host_of(F.col("url")).alias("host"), web.origin(F.col("url")).alias("origin"))


@query(r"""SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="([^"#]+)', 1))) AS link FROM pages""")
def q_links(spark, d):
    """Distinct link targets of a page."""
    return table(spark, d, "pages").select("page_id", F.explode(web.links(F.col("html"))).alias("link"))


@query(r"""WITH t AS (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS h,
  trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM pages)
SELECT page_id, CASE WHEN length(h) BETWEEN 3 AND 200 THEN h WHEN length(t) BETWEEN 3 AND 200 THEN t ELSE '' END AS title FROM t""")
def q_title(spark, d):
    """The name of a page."""
    return table(spark, d, "pages").select("page_id", web.title(F.col("html")).alias("title"))


OLD_SQL = web.OLD.replace("'", "''")
YEARS_SQL = web.YEARS.replace("'", "''")


@query(f"""WITH s AS (SELECT page_id, CASE WHEN NOT regexp_matches(html, '(?i)<meta[^>]+name=["'']?viewport') THEN ['no_mobile'] ELSE [] END
  || CASE WHEN page_id % 2 = 0 AND NOT regexp_matches(html, '{web.BOOKING}') THEN ['no_online_booking'] ELSE [] END || CASE WHEN regexp_matches(html, '{web.BUILDERS}') THEN ['site_builder'] ELSE [] END
  || CASE WHEN coalesce(list_max(list_transform(regexp_extract_all(html, '{YEARS_SQL}', 1), lambda y: y::INT)) <= 2023, false) OR regexp_matches(html, '{OLD_SQL}') THEN ['outdated'] ELSE [] END AS s FROM pages)
SELECT page_id, array_to_string(s, '|') AS signals, CASE WHEN list_contains(s, 'no_mobile') THEN 'Адаптив/редизайн' WHEN list_contains(s, 'no_online_booking') THEN 'Онлайн-запись / бот'
  WHEN list_contains(s, 'site_builder') THEN 'Собственная разработка' WHEN list_contains(s, 'outdated') THEN 'Редизайн' ELSE 'Автоматизация/боты/CRM' END AS pitch FROM s""")  # fmt: skip
def q_signals(spark, d):
    """What a page lacks and the pitch that follows."""
    s = web.signals(F.col("html"), F.col("page_id") % 2 == 0, 2026)
    return table(spark, d, "pages").select("page_id", s.alias("s")).select("page_id", F.array_join("s", "|").alias("signals"), web.pitch(F.col("s")).alias("pitch"))


@query("SELECT p_partkey, CASE WHEN regexp_matches(ltrim(c), '^[=+\\-@]') THEN '''' || c ELSE c END AS cell FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '=' || p_name WHEN 1 THEN ' +' || p_name ELSE p_name END AS c FROM part)")
def q_formula_neutralize(spark, d):
    """Cells that a spreadsheet would run; undone on reading."""
    c = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("="), "p_name")).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit(" +"), "p_name")).otherwise(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", text.safe_cell(c).alias("cell"))


# --- taxonomy, geography, identity -------------------------------------------------------------------------------------



@query(WITH_OBS + " SELECT row_idx, coalesce(" + ", ".join(f"CASE WHEN latitude BETWEEN {a}::DOUBLE AND {b}::DOUBLE AND longitude BETWEEN {c}::DOUBLE AND {e}::DOUBLE THEN '{n}' END" for n, a, b, c, e in values.CITY_BOXES) + ", '') AS city FROM obs")
def q_bbox_city(spark, d):
    """The first box that holds a point."""
    return obs(spark, d).select("row_idx", geo.city_of(F.col("latitude"), F.col("longitude")).alias("city"))


@query(WITH_OBS + """ SELECT a.row_idx AS l, b.row_idx AS r, round(12742.0176::DOUBLE * asin(least(1.0::DOUBLE, sqrt(pow(sin(radians(b.latitude - a.latitude) / 2), 2)
  + cos(radians(a.latitude)) * cos(radians(b.latitude)) * pow(sin(radians(b.longitude - a.longitude) / 2), 2)))), 6) AS km FROM obs a JOIN obs b ON a.cluster = b.cluster AND a.row_idx < b.row_idx""")
def q_haversine_pairs(spark, d):
    """Distances within a cluster."""
    return distances(obs(spark, d).select("cluster", "row_idx", "latitude", "longitude"))


#: So many rows of one place are kept as one list, and so many tasks share a cluster.
BLOCK, DEAL = 256, 8


def distances(rows: DataFrame) -> DataFrame:
    """(l, r, km) of all pairs of a cluster, l < r. Lists of rows of one place meet, so each distance is computed once for all of
    their pairs, and these are made as they are read."""
    place = ["cluster", "latitude", "longitude"]
    numbered = rows.withColumn("block", F.floor((F.row_number().over(W.partitionBy(*place).orderBy("row_idx")) - 1) / BLOCK))
    lists = numbered.groupBy(*place, "block").agg(F.collect_list("row_idx").alias("rows")).withColumn("id", F.struct("latitude", "longitude", "block"))
    side = lambda s, deal: lists.select(deal.alias(f"{s}_deal"), *[F.col(c).alias(f"{s}_{c}") for c in ("cluster", "latitude", "longitude", "id", "rows")])
    a, b = side("a", F.pmod(F.xxhash64("latitude", "longitude", "block"), F.lit(DEAL)).cast("int")), side("b", F.explode(F.sequence(F.lit(0), F.lit(DEAL - 1))))
    # Either place may hold the earlier row: the distance is the same both ways.
    km = F.round(geo.haversine(F.col("a_latitude"), F.col("a_longitude"), F.col("b_latitude"), F.col("b_longitude")), 6)
    met = a.join(b, (F.col("a_cluster") == F.col("b_cluster")) & (F.col("a_deal") == F.col("b_deal")) & (F.col("a_id") <= F.col("b_id")))
    # A distance in a list of one is computed before the loops over rows, not within.
    once = met.select(F.explode(F.array(km)).alias("km"), (F.col("a_id") == F.col("b_id")).alias("same"), "a_rows", "b_rows")
    pairs = once.select("km", "same", "b_rows", F.explode("a_rows").alias("x")).select("km", "same", "x", F.explode("b_rows").alias("y"))
    return pairs.filter((F.col("x") < F.col("y")) | (~F.col("same") & (F.col("x") > F.col("y")))).select(F.least("x", "y").alias("l"), F.greatest("x", "y").alias("r"), "km")


# --- entity resolution -------------------------------------------------------------------------------------------------

N_NAME, N_CITY, N_ADDRESS = NORMAL.format("name"), f"regexp_replace({NORMAL.format('city')}, '^(?:г|город|пгт|поселок|село) ', '')", f"regexp_replace({NORMAL.format('address')}, '^улица', 'ул')"
KEYS_SQL = f"""{WITH_OBS}, k AS (
  SELECT row_idx, 'source-id:' || lower(source) || ':' || source_id AS key FROM obs UNION SELECT row_idx, 'phone:' || '7' || {DIGITS.format('phone')}[2:] FROM obs WHERE phone <> ''
  UNION SELECT row_idx, 'domain:' || {HOST.format('website')} FROM obs WHERE website <> '' UNION SELECT row_idx, 'name-city:' || {N_NAME} || ':' || {N_CITY} FROM obs WHERE {N_NAME} <> '' AND {N_CITY} <> ''
  UNION SELECT row_idx, 'address:' || {N_ADDRESS} FROM obs
  UNION SELECT row_idx, 'geo:' || (floor(latitude * 100)::BIGINT + i) || ':' || (floor(longitude * 100)::BIGINT + j) FROM obs, (SELECT unnest([-1, 0, 1]) AS i), (SELECT unnest([-1, 0, 1]) AS j))"""


@query(KEYS_SQL + " SELECT row_idx, key FROM k")
def q_blocking_keys(spark, d):
    """The keys of each row."""
    return resolve.prepared(obs(spark, d)).select("row_idx", F.explode(resolve.blocking_keys()).alias("key"))


@query(KEYS_SQL + " SELECT DISTINCT a.row_idx AS l, b.row_idx AS r FROM k a JOIN k b ON a.key = b.key AND a.row_idx < b.row_idx")
def q_blocking_pairs(spark, d):
    """Distinct pairs that share any key."""
    return resolve.candidate_pairs(resolve.prepared(obs(spark, d)))


KM_SQL = """12742.0176::DOUBLE * asin(least(1.0::DOUBLE, sqrt(pow(sin(radians(y.latitude - x.latitude) / 2), 2) + cos(radians(x.latitude)) * cos(radians(y.latitude)) * pow(sin(radians(y.longitude - x.longitude) / 2), 2))))"""
# Similarity of names: the longest common part, then the same left and right of it. All observations have points and houses,
# so addresses that are not equal are branches or lie within the radius; their similarity decides nothing here.
MATCHES_SQL = f"""{KEYS_SQL.replace("WITH obs", "WITH RECURSIVE obs", 1)},
p AS (SELECT *, {N_NAME} AS nm, {N_CITY} AS ct, {N_ADDRESS} AS ad, {DIGITS.format('phone')} AS ph, {HOST.format('website')} AS dm, lower(source) || ':' || source_id AS id, count(*) OVER (PARTITION BY lower(source), source_id) > 1 AS common FROM obs),
f AS (SELECT *, min(row_idx) OVER (PARTITION BY nm, ct, ad, ph, dm, latitude, longitude, CASE WHEN common THEN id END, CASE WHEN nm = '' AND NOT common THEN row_idx END) AS profile FROM p),
u AS (SELECT * FROM f WHERE row_idx = profile),
c AS (SELECT DISTINCT a.row_idx AS l, b.row_idx AS r FROM k a JOIN k b ON a.key = b.key AND a.row_idx < b.row_idx WHERE a.row_idx IN (SELECT row_idx FROM u) AND b.row_idx IN (SELECT row_idx FROM u)),
n AS (SELECT DISTINCT x.nm AS a, y.nm AS b FROM c JOIN u x ON x.row_idx = l JOIN u y ON y.row_idx = r WHERE x.nm <> '' AND y.nm <> ''),
w AS (SELECT a, b, a AS s, b AS t, 0::BIGINT AS got FROM n
  UNION ALL
  SELECT a, b, unnest([s[1:h.at - 1], s[h.at + h.len:]]) AS s, unnest([t[1:strpos(t, s[h.at:h.at + h.len - 1]) - 1], t[strpos(t, s[h.at:h.at + h.len - 1]) + h.len:]]) AS t, unnest([h.len, 0])::BIGINT AS got
  FROM (SELECT a, b, s, t, list_transform([list_max(list_filter(flatten(list_transform(range(1, len(s) + 1), lambda i: list_transform(range(1, len(s) - i + 2), lambda n: {{'len': n, 'at': -i}}))), lambda q: contains(t, s[-q.at:-q.at + q.len - 1])))], lambda q: {{'len': q.len, 'at': -q.at}})[1] AS h FROM w WHERE s <> '' AND t <> '')
  WHERE h.len IS NOT NULL),
sim AS (SELECT a, b, 2.0::DOUBLE * sum(got) / (len(a) + len(b)) AS s FROM w GROUP BY a, b),
m AS (SELECT l, r, s, x.ad = y.ad AS one_address, {KM_SQL} AS km, x.ph <> '' AND x.ph = y.ph AS one_phone, x.dm <> '' AND x.dm = y.dm AND (x.ct = '' OR y.ct = '' OR 'крым' IN (x.ct, y.ct) OR x.ct = y.ct) AS one_site,
  regexp_extract(x.ad, '([0-9]+)$', 1) <> regexp_extract(y.ad, '([0-9]+)$', 1) AS houses FROM c JOIN u x ON x.row_idx = l JOIN u y ON y.row_idx = r JOIN sim ON a = x.nm AND b = y.nm)
SELECT 'row' AS kind, profile AS l, row_idx AS r FROM f UNION ALL
SELECT 'id', first, row_idx FROM (SELECT row_idx, min(row_idx) OVER (PARTITION BY id) AS first FROM u WHERE common) WHERE row_idx <> first UNION ALL
SELECT 'pair', l, r FROM m WHERE one_address AND s >= 0.72 OR km <= 0.35 AND s >= 0.68 OR NOT houses AND km <= 1 AND (one_phone AND s >= 0.72 OR one_site AND s >= 0.82)"""


@query(MATCHES_SQL)
def q_match_pairs(spark, d):
    """Profiles with their rows, ids that rows share, and pairs of profiles that are one entity by content."""
    return resolve.linked_rows(resolve.prepared(obs(spark, d)))


@query(WITH_OBS + f""" SELECT a.row_idx AS l, b.row_idx AS r FROM obs a JOIN obs b ON a.cluster = b.cluster AND a.row_idx < b.row_idx
WHERE 12742.0176::DOUBLE * asin(least(1.0::DOUBLE, sqrt(pow(sin(radians(b.latitude - a.latitude) / 2), 2) + cos(radians(a.latitude)) * cos(radians(b.latitude)) * pow(sin(radians(b.longitude - a.longitude) / 2), 2)))) > 1
  OR regexp_extract(a.address, '([0-9]+)$', 1) <> regexp_extract(b.address, '([0-9]+)$', 1)""")
def q_branch_conflict(spark, d):
    """D3: pairs of one cluster that are separate branches."""
    o = resolve.prepared(obs(spark, d)).join(obs(spark, d).select("row_idx", "cluster"), "row_idx")
    side = lambda s: o.select(*[F.col(c).alias(f"{s}_{c}") for c in o.columns])
    return side("l").join(side("r"), F.col("l_cluster") == F.col("r_cluster")).filter("l_row_idx < r_row_idx").filter(resolve.branch_conflict()).select(F.col("l_row_idx").alias("l"), F.col("r_row_idx").alias("r"))


@query("""WITH RECURSIVE e AS (SELECT c_custkey AS a, c_custkey + 7 AS b FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT c_custkey AS id FROM customer),
u AS (SELECT a, b FROM e WHERE b IN (SELECT id FROM n) UNION SELECT b, a FROM e WHERE b IN (SELECT id FROM n)), r(id, root) AS (SELECT id, id FROM n UNION SELECT u.b, r.root FROM r JOIN u ON u.a = r.id)
SELECT id AS row_idx, min(root) AS component FROM r GROUP BY id""")
def q_components(spark, d):
    """Components without a veto."""
    nodes = table(spark, d, "customer").select(F.col("c_custkey").alias("row_idx"))
    edges = nodes.filter("row_idx % 3 <> 0").select(F.col("row_idx").alias("l"), (F.col("row_idx") + 7).alias("r")).join(nodes.withColumnRenamed("row_idx", "r"), "r", "left_semi").select("l", "r")
    return resolve.components(nodes, edges)


@query()
def q_clusters(spark, d):
    """Clusters with the branch veto."""
    return resolve.resolved(resolve.prepared(obs(spark, d)))


#: Companies of twelve rows with one phone: two spellings of a name and another name, two houses or none, points up to 1.2 km
#: apart or none. Rows without a place are bridges between branches.
CHAIN = {
    "row_idx": "c_custkey", "source": "'OSM'", "source_id": "CAST(c_custkey AS STRING)", "company": "CAST(floor(c_custkey / 12) AS BIGINT)", "kind": "c_custkey * 13 % 97 % 5", "city": "'Ялта'", "website": "''",
    "house": "CASE c_custkey * 31 % 101 % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE '' END", "spot": "c_custkey * 17 % 103 % 6",
}
CHAIN_MORE = {
    "name": "CASE WHEN kind = 4 THEN concat('жжжжжжжжжж', CAST(company AS STRING)) WHEN kind = 3 THEN concat('k', md5(CAST(company AS STRING)), ' плюс') ELSE concat('k', md5(CAST(company AS STRING))) END",
    "address": "CASE WHEN house = '' THEN '' ELSE concat('Улица ', md5(CAST(company AS STRING)), ', ', house) END", "phone": "concat('8 978 ', lpad(CAST(company AS STRING), 7, '0'))",
    "latitude": "CASE WHEN spot < 3 THEN NULL ELSE CAST(company % 100 AS DOUBLE) / 20 + CASE spot WHEN 3 THEN CAST(44 AS DOUBLE) WHEN 4 THEN CAST(44.006 AS DOUBLE) ELSE CAST(44.011 AS DOUBLE) END END",
    "longitude": "CASE WHEN spot < 3 THEN NULL ELSE CAST(33 AS DOUBLE) + floor(company / 100) / 16 END",
}


@query("WITH RECURSIVE a AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in CHAIN.items()) + " FROM customer), b AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in CHAIN_MORE.items()) + f""" FROM a),
n AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY row_idx) AS pos FROM b),
pairs AS (SELECT x.company, x.pos AS i, y.pos AS j, (x.kind = 4) = (y.kind = 4) AS alike, x.latitude IS NOT NULL AND y.latitude IS NOT NULL AND {KM_SQL} > 1 OR x.house <> '' AND y.house <> '' AND x.house <> y.house AS bad FROM n x JOIN n y ON x.company = y.company AND x.pos < y.pos),
e AS (SELECT company, i, j, row_number() OVER (PARTITION BY company ORDER BY j, i) AS k FROM pairs WHERE alike AND NOT bad),
m AS (SELECT company, list(i * 100 + j) AS bad FROM pairs WHERE bad GROUP BY company),
s AS (SELECT company, 0::BIGINT AS k, list(pos ORDER BY pos) AS lab FROM n GROUP BY company
  UNION ALL
  SELECT s.company, e.k, CASE WHEN lab[i] = lab[j] OR len(list_filter(coalesce(m.bad, []), lambda p: lab[p // 100] = lab[i] AND lab[p % 100] = lab[j] OR lab[p // 100] = lab[j] AND lab[p % 100] = lab[i])) > 0 THEN lab
    ELSE list_transform(lab, lambda q: CASE WHEN q = greatest(lab[i], lab[j]) THEN least(lab[i], lab[j]) ELSE q END) END
  FROM s JOIN e ON e.company = s.company AND e.k = s.k + 1 LEFT JOIN m ON m.company = s.company),
z AS (SELECT company, arg_max(lab, k) AS lab FROM s GROUP BY company)
SELECT n.row_idx, f.row_idx AS cluster FROM n JOIN z USING (company) JOIN n f ON f.company = n.company AND f.pos = lab[n.pos]""")  # fmt: skip
def q_chain_clusters(spark, d):
    """Chains with branches and bridges between them, united in the order of rows."""
    rows = table(spark, d, "customer").selectExpr(*[f"{e} AS {n}" for n, e in CHAIN.items()]).selectExpr("*", *[f"{e} AS {n}" for n, e in CHAIN_MORE.items()]).drop("house")
    return resolve.resolved(resolve.prepared(rows))


ANCHOR_SQL = "NOT (source = 'VK' AND contains(quality_flags, 'vk_noise_primary'))"


@query(WITH_OBS + f""" SELECT cluster, bool_or({ANCHOR_SQL}) AS anchored, count(*) AS n_rows, string_agg(DISTINCT source, '|' ORDER BY source) AS sources,
  printf('%.2f', coalesce(max(CASE WHEN {ANCHOR_SQL} THEN confidence END), 0)) AS confidence, min(first_seen) AS first_seen, max(last_seen) AS last_seen,
  'ent_' || sha256(string_agg('source-id|' || lower(source) || '|' || source_id, '|' ORDER BY 'source-id|' || lower(source) || '|' || source_id))[1:24] AS entity_id FROM obs GROUP BY cluster""")
def q_golden(spark, d):
    """Golden records, their sources, confidence, sightings and ids."""
    return golden.golden(obs(spark, d)).select("cluster", "anchored", "n_rows", "sources", "confidence", "first_seen", "last_seen", "entity_id")


PRIO_SQL = "CASE source WHEN 'Я.Карты' THEN 50 WHEN 'OSM' THEN 40 WHEN 'VK' THEN 30 ELSE 20 END"


@query(WITH_OBS + f""", r AS (SELECT cluster, email, row_number() OVER (PARTITION BY cluster ORDER BY split_part(email, '@', 2) = {HOST.format('website')} DESC, {PRIO_SQL} DESC, last_seen DESC, length(email) DESC, row_idx) AS n FROM obs WHERE email <> '')
SELECT c.cluster, coalesce(email, '') AS email FROM (SELECT DISTINCT cluster FROM obs) c LEFT JOIN r ON r.cluster = c.cluster AND n = 1""")
def q_best_value(spark, d):
    """The best address of a cluster."""
    return obs(spark, d).groupBy("cluster").agg(golden.best("email"))


@query(WITH_OBS + f""", f AS (SELECT cluster, '7' || {DIGITS.format('phone')}[2:] AS id, min({{'i': row_idx, 'v': phone}}) AS x FROM obs WHERE phone <> '' GROUP BY 1, 2)
SELECT c.cluster, coalesce(string_agg(x.v, ' | ' ORDER BY x.i), '') AS all_phones FROM (SELECT DISTINCT cluster FROM obs) c LEFT JOIN f USING (cluster) GROUP BY c.cluster""")
def q_contact_union(spark, d):
    """E5: distinct phones in order, the first spelling kept."""
    return identity.complete(obs(spark, d)).groupBy("cluster").agg(golden.united("phone").alias("all_phones"))


@query(WITH_OBS + """, f AS (SELECT cluster, trim(unnest(string_split(lower(quality_flags), '|'))) AS f FROM obs)
SELECT c.cluster, coalesce(string_agg(DISTINCT f, '|' ORDER BY f), '') AS flags FROM (SELECT DISTINCT cluster FROM obs) c LEFT JOIN (SELECT * FROM f WHERE f <> '') f USING (cluster) GROUP BY c.cluster""")
def q_flag_union(spark, d):
    """Sorted union of flags."""
    f = obs(spark, d).groupBy("cluster").agg(F.collect_list(text.flags(F.col("quality_flags"))).alias("f"))
    return f.select("cluster", F.array_join(F.array_sort(F.array_distinct(F.flatten("f"))), "|").alias("flags"))


@query(WITH_OBS + " SELECT DISTINCT cluster, observation_id, source, field, value FROM (SELECT cluster, observation_id, source, unnest(['name', 'city', 'phone', 'email', 'website', 'address']) AS field, unnest([name, city, phone, email, website, address]) AS value FROM obs) WHERE value <> ''")
def q_provenance(spark, d):
    """Who gave which value."""
    return golden.provenance(obs(spark, d))


@query(WITH_OBS + f""", a AS (SELECT cluster, bool_or({ANCHOR_SQL}) AS anchored FROM obs GROUP BY cluster) SELECT o.row_idx, {ANCHOR_SQL} AS is_anchor, CASE WHEN anchored THEN 'master' ELSE 'quarantine' END AS tier FROM obs o JOIN a USING (cluster)""")
def q_anchor_gate(spark, d):
    """Anchors, and what happens to clusters without one."""
    o = obs(spark, d).withColumn("is_anchor", golden.anchor())
    return o.select("row_idx", "is_anchor", F.when(F.max("is_anchor").over(W.partitionBy("cluster")), "master").otherwise("quarantine").alias("tier"))


@query(WITH_OBS + f""", g AS (SELECT cluster, first(phone ORDER BY CASE WHEN phone <> '' THEN 0 ELSE 1 END, {PRIO_SQL} DESC, last_seen DESC, length(phone) DESC, row_idx) AS best FROM obs WHERE {ANCHOR_SQL} GROUP BY cluster)
SELECT row_idx, CASE WHEN phone <> '' THEN phone ELSE coalesce(best, '') END AS phone, phone = '' AND coalesce(best, '') <> '' AS filled FROM obs LEFT JOIN g USING (cluster)""")
def q_cross_source_fill(spark, d):
    """Empty phones are filled from the cluster's anchors."""
    o = obs(spark, d)
    g = o.filter(golden.anchor()).groupBy("cluster").agg(golden.best("phone").alias("best"))
    j = o.join(g, "cluster", "left").withColumn("best", text.blank(F.col("best")))
    return j.select("row_idx", F.when(F.col("phone") != "", F.col("phone")).otherwise(F.col("best")).alias("phone"), ((F.col("phone") == "") & (F.col("best") != "")).alias("filled"))


@query("SELECT o_custkey, arg_max(o_orderpriority, {'d': o_orderdate, 'k': o_orderkey}) AS latest, count(*) AS n FROM orders GROUP BY o_custkey")
def q_refresh_latest_wins(spark, d):
    """Fields of the latest sighting win."""
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("latest"), F.count("*").alias("n"))


# --- work selection, state, windows ------------------------------------------------------------------------------------


@query("SELECT 'u' || user_id AS observation_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen, count(*)::BIGINT AS seen_count FROM events GROUP BY user_id")
def q_state_upsert(spark, d):
    """K1, F8: two runs of sightings merged into one state."""
    e = table(spark, d, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("observation_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen_at"), "event_id")
    first = state.sightings(e.filter("event_id % 2 = 0"))
    return state.upsert(first, e.filter("event_id % 2 <> 0"))


#: Rows of an earlier run, and lookups of which some give no source.
PROBES = {"row_idx": "row_idx + 0", "name": "name", "city": "city", "source": "CASE WHEN row_idx % 3 = 0 THEN '' ELSE source END", "source_id": "CASE WHEN row_idx % 3 = 0 THEN '' ELSE CAST(row_idx % 1100 AS STRING) END"}


@query(WITH_OBS + f""", k AS (SELECT lower(source) || '|' || source_id AS id, {N_NAME} AS n, {N_CITY} AS c FROM obs WHERE row_idx % 4 = 1), p AS (SELECT {", ".join(f"{e} AS {n}" for n, e in PROBES.items())} FROM obs)
SELECT row_idx, CASE WHEN source = '' THEN ({N_NAME}, {N_CITY}) IN (SELECT (n, c) FROM k) ELSE lower(source) || '|' || source_id IN (SELECT id FROM k) END AS seen FROM p""")  # fmt: skip
def q_novelty(spark, d):
    """K2: whether an earlier run has seen an observation, by its id or, without a source, by name and city."""
    o = obs(spark, d)
    return state.novel(o.selectExpr(*[f"{e} AS {n}" for n, e in PROBES.items()]), state.named(o.filter("row_idx % 4 = 1").drop("observation_id"))).select("row_idx", "seen")


@query("""WITH m AS (SELECT max(ts) AS now FROM events) SELECT event_id FROM events, m WHERE ts > now - CASE WHEN event_type = 'error' THEN INTERVAL 2 DAY WHEN event_type = 'view' THEN INTERVAL 9 DAY ELSE INTERVAL 5 DAY END""")
def q_ttl_fresh(spark, d):
    """Entries that are young enough for their status."""
    e = table(spark, d, "events")
    good = F.when(F.col("event_type") == "error", 2).when(F.col("event_type") == "view", 9).otherwise(5)
    now = e.agg(F.max("ts").alias("now"))
    return e.crossJoin(F.broadcast(now)).filter(F.col("ts") > F.col("now") - F.make_dt_interval(good)).select("event_id")  # one row


@query("SELECT event_id, n FROM (SELECT event_id, row_number() OVER (ORDER BY (event_type = 'error') DESC, ts, event_id) AS n FROM events) WHERE n <= 100")
def q_budget_topk(spark, d):
    """The first of an ordered queue; the limit comes before the numbers."""
    q = table(spark, d, "events").orderBy((F.col("event_type") == "error").desc(), "ts", "event_id").limit(100)
    return q.select("event_id", F.row_number().over(W.orderBy((F.col("event_type") == "error").desc(), "ts", "event_id")).cast("long").alias("n"))


@query("SELECT event_id FROM (SELECT event_id, user_id, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS used FROM events) WHERE used <= 5")
def q_budget_cumulative(spark, d):
    """A budget for each user; failures are not charged."""
    used = F.sum(F.when(F.col("event_type") == "error", 0).otherwise(1)).over(W.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, d, "events").withColumn("used", used).filter("used <= 5").select("event_id")


@query("""WITH e AS (SELECT event_id, ts, event_type = 'error' AS bad, event_id % 3000 AS card FROM events), f AS (SELECT *, row_number() OVER (PARTITION BY card ORDER BY ts, event_id) = 1 AS first FROM e),
c AS (SELECT *, sum((first AND NOT bad)::INT) OVER (ORDER BY ts, event_id) - (first AND NOT bad)::INT AS spent FROM f), a AS (SELECT *, spent < 500 AS free FROM c)
SELECT event_id, bool_or(first AND free) OVER (PARTITION BY card) AS allowed, first AND free AND NOT bad AS charged FROM a""")
def q_budget_refund(spark, d):
    """One budget over all lookups in order; failures are refunded, what is known already is free."""
    e = table(spark, d, "events").select("event_id", "ts", "event_type", (F.col("event_id") % 3000).alias("card"))
    return ordered.budgeted(e, ["ts", "event_id"], 500, F.col("event_type") == "error", "card").select("event_id", "allowed", "charged")


@query("""WITH e AS (SELECT user_id, event_id, event_type = 'error' AS bad, sum((event_type <> 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events)
SELECT user_id, max(n)::BIGINT AS longest FROM (SELECT user_id, island, sum(bad::INT) AS n FROM e GROUP BY user_id, island) GROUP BY user_id""")
def q_consecutive_run(spark, d):
    """the longest run of failures."""
    bad = (F.col("event_type") == "error").cast("int")
    island = F.sum(1 - bad).over(W.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, d, "events").select("user_id", bad.alias("bad"), island.alias("island")).groupBy("user_id", "island").agg(F.sum("bad").alias("n")).groupBy("user_id").agg(F.max("n").alias("longest"))


@query(f"""WITH p AS (SELECT page_id, {HOST.format('url')} AS host, contains(url, '/de/') AS hit FROM pages) SELECT host, page_id, r FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY hit DESC, page_id) AS r FROM p) WHERE r <= 3""")
def q_page_rank_cap(spark, d):
    """A few pages of each host, interesting ones first."""
    p = table(spark, d, "pages").select("page_id", web.host_of(F.col("url")).alias("host"), F.col("url").contains("/de/").alias("hit"))
    return p.withColumn("r", F.row_number().over(W.partitionBy("host").orderBy(F.col("hit").desc(), "page_id")).cast("long")).filter("r <= 3").select("host", "page_id", "r")


@query(f"SELECT {HOST.format('url')} AS host, count(*) AS pages, bool_or(contains(html, '&amp;')) AS trigger, min(page_id) AS first_page FROM pages GROUP BY 1")
def q_host_targets(spark, d):
    """One row for a host."""
    return table(spark, d, "pages").groupBy(web.host_of(F.col("url")).alias("host")).agg(F.count("*").alias("pages"), F.max(F.col("html").contains("&amp;")).alias("trigger"), F.min("page_id").alias("first_page"))


@query(rf"WITH d AS (SELECT doc_id, unnest(list_distinct(list_transform(regexp_extract_all(text, '@([a-z0-9.\-]+)', 1), lambda x: lower(x)))) AS domain FROM documents) SELECT domain, count(*) AS n FROM d GROUP BY domain HAVING count(*) <= 50")
def q_domain_frequency(spark, d):
    """Domains in few rows."""
    doc = table(spark, d, "documents").select(F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(r"@([a-z0-9.\-]+)"), F.lit(1)), lambda x: F.lower(x)))).alias("domain"))
    return doc.groupBy("domain").agg(F.count("*").alias("n")).filter("n <= 50")


@query(WITH_OBS + f", x AS (SELECT 'office' || (s_suppkey % 200) || '@firm' || (s_suppkey % 450) || '.ru' AS email FROM supplier), h AS (SELECT 'firm' || (n_nationkey * 7) || '.ru' AS host FROM nation) SELECT row_idx FROM obs WHERE email NOT IN (SELECT email FROM x) AND {HOST.format('website')} NOT IN (SELECT host FROM h)")
def q_cross_base_anti(spark, d):
    """Rows that another base has by address or domain go."""
    o = obs(spark, d).withColumn("host", web.host_of(F.col("website")))
    x = table(spark, d, "supplier").selectExpr("concat('office', s_suppkey % 200, '@firm', s_suppkey % 450, '.ru') AS email").distinct()
    h = table(spark, d, "nation").selectExpr("concat('firm', n_nationkey * 7, '.ru') AS host")
    return o.join(x, "email", "left_anti").join(h, "host", "left_anti").select("row_idx")


# --- reports and sets --------------------------------------------------------------------------------------------------


@query(WITH_OBS + " SELECT source, city, count(*) AS n, count_if(phone <> '') AS with_phone, floor(100 * count_if(email <> '') / count(*))::BIGINT AS email_percent FROM obs GROUP BY source, city")
def q_summary_rollup(spark, d):
    """Counts by source and city."""
    return obs(spark, d).groupBy("source", "city").agg(F.count("*").alias("n"), F.count_if(F.col("phone") != "").alias("with_phone"), F.floor(100 * F.count_if(F.col("email") != "") / F.count("*")).alias("email_percent"))


@query(WITH_OBS + ", n AS (SELECT *, count(*) OVER (PARTITION BY cluster % 37) AS size FROM obs) SELECT row_idx, CASE WHEN size >= 41 THEN 'sheet ' || (cluster % 37) ELSE 'others' END AS sheet FROM n")
def q_sheet_split(spark, d):
    """Large groups get a sheet of their own; sizes come from a small aggregate."""
    o = obs(spark, d).withColumn("g", F.col("cluster") % 37)
    n = o.groupBy("g").agg(F.count("*").alias("size"))
    return o.join(n, "g").select("row_idx", F.when(F.col("size") >= 41, text.sheet_name(F.concat(F.lit("sheet "), F.col("g").cast("string")))).otherwise("others").alias("sheet"))


@query(WITH_OBS + " SELECT row_idx, (phone <> '')::INT + (email <> '')::INT + (website <> '')::INT AS n FROM obs ORDER BY n DESC, row_idx LIMIT 10")
def q_preview(spark, d):
    """The ten fullest rows."""
    n = text.completeness(F.col("phone"), F.col("email"), F.col("website"))
    return obs(spark, d).select("row_idx", n.alias("n")).orderBy(F.col("n").desc(), "row_idx").limit(10)


@query("SELECT s_nationkey AS k, 'supplier' AS source FROM supplier UNION ALL SELECT c_nationkey, 'customer' FROM customer")
def q_source_union(spark, d):
    """H1: all sources as one."""
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"), F.lit("supplier").alias("source"))
    return s.unionByName(table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.lit("customer").alias("source")))


@query("SELECT n_nationkey AS k, n_nationkey IN (SELECT s_nationkey FROM supplier) AS has_supplier, n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900) AS not_rich FROM nation")
def q_except_intersect(spark, d):
    """H3, H4: what two sets share, and what one lacks."""
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")).distinct().withColumn("a", F.lit(True))
    c = table(spark, d, "customer").filter("c_acctbal > 9900").select(F.col("c_nationkey").alias("k")).distinct().withColumn("b", F.lit(True))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"))
    return n.join(s, "k", "left").join(c, "k", "left").select("k", F.col("a").isNotNull().alias("has_supplier"), F.col("b").isNull().alias("not_rich"))


@query(f"""SELECT {HOST.format('url')} AS host, count(*) AS pages, sum(len(list_distinct(regexp_extract_all(html, 'href="([^"#]+)', 1))))::BIGINT AS links, max(regexp_extract(html, '<title>([^<]*)', 1)) AS title FROM pages GROUP BY 1""")
def q_site_overview(spark, d):
    """The flagship: hosts with their pages, links and a title in one scan and one shuffle."""
    return table(spark, d, "pages").groupBy(web.host_of(F.col("url")).alias("host")).agg(F.count("*").alias("pages"), F.sum(F.size(web.links(F.col("html")))).alias("links"), F.max(F.regexp_extract("html", "<title>([^<]*)", 1)).alias("title"))

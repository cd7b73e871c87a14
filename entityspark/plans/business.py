"""Queries over companies: taxonomy, the e-mail gate, identity, golden records, outreach, sites and sources. Each SQL twin
computes its answer from the same tables by DuckDB's own functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from entityspark.functions import contact, geo, taxonomy, text, values, web
from entityspark.operators import crawl, enrich, golden, identity, master, outreach, signals
from entityspark.plans.catalogue import ORACLES, QUERIES, query, table  # noqa: F401 (the queries of both modules)
from entityspark.sources import readers, sinks


def pick(key: str, options: list[str], step: int = 1) -> str:
    """An SQL expression: one of the options, by a key."""
    return f"CASE CAST(floor({key} / {step}) AS BIGINT) % {len(options)} " + " ".join(f"WHEN {k} THEN '{o}'" for k, o in enumerate(options)) + " END"


NAMES = (
    "Мебель на заказ Уют;СберЛизинг;Автосервис Мотор;Кафе Бриз;ГАУЗРК Больница;Салон красоты Лотос;Магнит косметик;Школа № 5;Пудра;Юрист и партнёры;Ремонт обуви и одежды;Суд;"
    "Строительство и ремонт;веб-студия Код;Городская поликлиника 3;Отель Ялта;Фитнес Йога;Почта России;Турагентство Южный берег;нечто;ДШИ Гармония;Яхт-клуб;Барбершоп; "
).split(";")
EMAILS = (
    "info@mail.ru;a@gmial.com;x@sub.vk.com;no at sign;user@firm.ru;logo@2x.png;q@best-slots.ru;b@corp.mail.ru;ivan@mail.ru;c@mydomain.example.com;0123456789abcdef0123456789abcdef@firm.ru;"
    "%20Zakaz@Firm.ru;graqre@gx-xvg.pbz;vasb@svez.eh;<sales@firm.ru>;a@ozon.ru;z@facebook.com;best@casino-firm.ru;office@firm.msk.ru;(boss@other.org),;a@b@c.ru;-x@firm.ru;x@-firm.ru;tel@yandex.com"
).split(";")
HOSTS = ["", "firm.ru", "shop.firm.ru", "tk-kit.com", "casino-firm.ru", "vk.com/club1", "https://www.Firm.ru/page"]
#: Observations with every kind of name, address and site.
BIZ = {
    "row_idx": "c_custkey", "source": pick("c_custkey", ["OSM", "VK", "Я.Карты", "Crawler"]), "source_id": "CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(c_custkey % 900 AS STRING) END",
    "source_url": "CASE WHEN c_custkey % 6 = 0 THEN concat(' HTTPS://Vk.com/club', CAST(c_custkey % 500 AS STRING)) ELSE '' END", "social": "CASE WHEN c_custkey % 9 = 3 THEN concat('https://vk.com/g', CAST(c_custkey % 70 AS STRING)) ELSE '' END",
    "name": pick("c_custkey", NAMES), "raw_category": pick("c_custkey", ["", "кафе", "магазин", "администрация", "доставка грузов"], 2), "category": pick("c_custkey", ["avto", "Мебель", "ОСАГО", "х"]),
    "client_type": pick("c_custkey", ["avto", "medicina", "it_svyaz", "", "turizm", "mebel"]), "city": pick("c_custkey", [" г. Севастополь", "Ялта", "Малореречен.", "Крым", ""]),
    "address": "CASE WHEN c_custkey % 4 = 3 THEN '' ELSE concat('Улица Ленина, ', CAST(c_custkey % 40 AS STRING)) END", "phone": "CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat('8 (978) ', lpad(CAST(c_custkey % 300 AS STRING), 7, '0')) END",
    "email": pick("c_custkey", EMAILS), "all_emails": f"concat({pick('c_custkey', EMAILS, 5)}, ' | ', {pick('c_custkey', EMAILS, 3)})", "website": pick("c_custkey", HOSTS, 2),
    "latitude": "CASE WHEN c_custkey % 5 = 4 THEN '' ELSE CAST(CAST(44 + c_custkey % 3 AS STRING) || '.' || CAST(10 + c_custkey % 90 AS STRING) AS STRING) END",
    "longitude": "CASE WHEN c_custkey % 5 = 4 THEN '' ELSE CAST(CAST(32 + c_custkey % 4 AS STRING) || '.' || CAST(10 + c_custkey % 87 AS STRING) AS STRING) END",
    "quality_flags": pick("c_custkey", ["", "vk_noise_primary|Manual_Review", " low | low", "manual_review", "vk_weak_contact_donor", "excluded_gov", "vk_no_own_website"]),
    "confidence": pick("c_custkey", ["0.95", "0.8", "0.5", "x", "1.7", "", "-1"], 3), "first_seen": "concat('2026-08-', lpad(CAST(1 + c_custkey % 27 AS STRING), 2, '0'))",
    "last_seen": "concat('2026-09-', lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0'))", "cluster": "c_custkey % 400",
}
WITH_BIZ = "WITH biz AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in BIZ.items()) + " FROM customer)"


def biz(spark, d):
    return table(spark, d, "customer").selectExpr(*[f"{e} AS {n}" for n, e in BIZ.items()])


# --- SQL macros --------------------------------------------------------------------------------------------------------

LETTER = r"[\p{L}\p{N}_]"
EDGE_L, EDGE_R = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
FOLD = r"trim(regexp_replace(replace(lower({0}), 'ё', 'е'), '\s+', ' ', 'g'))"
NORMAL = r"trim(regexp_replace(replace(lower({0}), 'ё', 'е'), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"
HOST = r"regexp_replace(regexp_replace(lower(regexp_extract(regexp_replace(trim({0}), '^[A-Za-z][A-Za-z0-9+.\-]*://', ''), '^([^/?#:]*)', 1)), '\.+$', ''), '^www\.', '')"
listed = lambda xs: ", ".join("'" + x + "'" for x in xs)
below = lambda host, hosts: f"len(list_filter([{listed(hosts)}], lambda one: {host} = one OR ends_with({host}, '.' || one))) > 0"
SLD = f"CASE WHEN len(string_split({{0}}, '.')) >= 3 AND string_split({{0}}, '.')[-2] IN ({listed(values.SECOND_LEVELS)}) THEN string_split({{0}}, '.')[-3] WHEN len(string_split({{0}}, '.')) >= 2 THEN string_split({{0}}, '.')[-2] ELSE {{0}} END"
DOMAIN = "split_part({0}, '@', -1)"
FOREIGN_SITE = lambda u: f"({HOST.format(u)} <> '' AND {below(HOST.format(u), values.SOCIAL_HOSTS + values.PLATFORM_HOSTS)})"


def related_sql(a: str, b: str) -> str:
    x, y = SLD.format(a), SLD.format(b)
    return f"({a} <> '' AND {b} <> '' AND ({a} = {b} OR ends_with({a}, '.' || {b}) OR ends_with({b}, '.' || {a}) OR ({x}) = ({y}) OR (least(length({x}), length({y})) >= 5 AND (contains({x}, {y}) OR contains({y}, {x})))))"


def syntax_sql(e: str) -> str:
    dom = DOMAIN.format(e)
    return (f"(length({e}) - length(replace({e}, '@', '')) = 1 AND length({e}) <= 254 AND regexp_full_match(split_part({e}, '@', 1), '[\\p{{L}}\\p{{N}}_.+%''-]{{1,64}}') AND contains({dom}, '.') "
        f"AND len(list_filter(string_split({dom}, '.'), lambda l: NOT regexp_full_match(l, '[\\p{{L}}\\p{{N}}]([\\p{{L}}\\p{{N}}-]{{0,61}}[\\p{{L}}\\p{{N}}])?'))) = 0)")  # fmt: skip


ALPHA, MOVED = "abcdefghijklmnopqrstuvwxyz", "nopqrstuvwxyzabcdefghijklm"


def gate_ctes(source: str, name: str) -> str:
    """CTEs from ``source`` (key, raw, host) to ``name`` (key, raw, host, email, note)."""
    bad = f"[{listed(contact.NOT_THE_COMPANYS)}]"
    return rf"""
{name}1 AS (SELECT key, raw, host, lower(regexp_replace(trim(raw), '^[<>"'']+|[<>"'']+$', '', 'g')) AS was FROM {source}),
{name}2 AS (SELECT *, lower(regexp_replace(regexp_replace(trim(url_decode(was)), '^[<>"''()\[\]{{}};, ]+|[<>"''()\[\]{{}};, ]+$', '', 'g'), '^[._%+ -]+', '')) AS e FROM {name}1),
{name}3 AS (SELECT *, split_part(e, '.', -1) AS tld, translate(e, '{ALPHA}', '{MOVED}') AS moved FROM {name}2),
{name}4 AS (SELECT *, {syntax_sql('e')} AS fine, {syntax_sql('moved')} AND split_part(moved, '.', -1) IN ({listed(values.COMMON_ENDINGS)}) AND tld NOT IN ({listed(values.COMMON_ENDINGS)}) AND NOT starts_with(tld, 'xn--')
  AND (tld IN ({listed(values.MOVED_ENDINGS)}) OR {related_sql(DOMAIN.format('moved'), 'host')}) AS back FROM {name}3),
{name}5 AS (SELECT *, CASE WHEN NOT fine THEN 'invalid_syntax' WHEN tld IN ({listed(values.FILE_ENDINGS)}) OR NOT regexp_full_match(tld, '\p{{L}}{{2,24}}') THEN 'invalid_tld' END AS why0, CASE WHEN back THEN moved ELSE e END AS x,
  CASE WHEN back THEN 'rot13_decoded' WHEN e = was THEN '' ELSE 'repaired' END AS note0 FROM {name}4),
{name}6 AS (SELECT *, split_part(x, '@', 1) AS local, {DOMAIN.format('x')} AS dom FROM {name}5),
{name}7 AS (SELECT *, {related_sql('dom', 'host')} AS kin, dom IN ({listed(values.FREE_MAIL_HOSTS)}) AS free FROM {name}6),
{name}8 AS (SELECT *, CASE WHEN why0 IS NOT NULL THEN why0 WHEN len(list_filter({bad}, lambda h: dom = h OR ends_with(dom, '.' || h))) > 0 THEN 'platform_or_authority' WHEN regexp_full_match(local, '[0-9a-f]{{32}}') THEN 'hex_token'
  WHEN local IN ({listed(values.PLACEHOLDER_LOCALS)}) OR ({SLD.format('dom')}) IN ({listed(values.PLACEHOLDER_NAMES)}) THEN 'placeholder' WHEN NOT kin AND regexp_matches(dom, '{values.SPAM_DOMAINS}') THEN 'spam_domain'
  WHEN len(list_filter([{listed(values.FREE_MAIL_HOSTS)}], lambda h: ends_with(dom, '.' || h))) > 0 THEN 'provider_subdomain' WHEN free AND local IN ({listed(values.SERVICE_LOCALS)}) THEN 'provider_service_address'
  WHEN NOT free AND NOT kin AND len(list_filter([{listed(values.TYPO_PROVIDERS)}], lambda p: damerau_levenshtein(dom, p) = 1)) > 0 THEN 'provider_typo' END AS why FROM {name}7),
{name} AS (SELECT key, raw, host, CASE WHEN why IS NULL THEN x END AS email, coalesce(why, note0) AS note FROM {name}8)"""


RELATION = f"CASE WHEN {DOMAIN.format('{e}')} IN ({listed(values.FREE_MAIL_HOSTS)}) THEN 'free' WHEN {{h}} = '' THEN 'unknown' WHEN {related_sql(DOMAIN.format('{e}'), '{h}')} THEN 'same' ELSE 'foreign' END"


def exclusions_sql(name: str, whole: str) -> str:
    brands = "|".join(b.replace(".", r"\.") for b in taxonomy.BRANDS)
    own = lambda p: p.replace(r"\w", LETTER)
    return (f"list_filter([CASE WHEN regexp_matches({name}, '{EDGE_L}(?:{brands}){EDGE_R}|{EDGE_L}(?:{'|'.join(taxonomy.BRAND_BEGINNINGS)})') THEN 'excluded_chain' END, "
        f"CASE WHEN regexp_matches({whole}, '{EDGE_L}(?:{own(taxonomy.PUBLIC_WORDS)}){EDGE_R}|{EDGE_L}(?:{own(taxonomy.PUBLIC_BEGINNINGS)})') THEN 'excluded_gov' END, "
        f"CASE WHEN regexp_matches({whole}, '{EDGE_L}(?:{own(taxonomy.OTHER_BASES)}){EDGE_R}') THEN 'excluded_other_base_type' END], lambda f: f IS NOT NULL)")  # fmt: skip


def segment_sql(t: str) -> str:
    exact = " ".join(f"WHEN {t} = '{n}' THEN '{k}'" for n, k in taxonomy.exact_names().items())
    inner = " ".join(f"WHEN contains({t}, '{a}') THEN '{k}'" for a, k in taxonomy.longest_first())
    return f"CASE {exact} {inner} ELSE '{taxonomy.DEFAULT_SEGMENT}' END"


SURE = "greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(TRY_CAST(confidence AS DOUBLE), 0.0::DOUBLE)))"
FLAGS = "list_sort(list_distinct(list_filter(list_transform(string_split(lower({0}), '|'), lambda f: trim(f)), lambda f: f <> '')))"

# --- taxonomy and gates ------------------------------------------------------------------------------------------------


@query(WITH_BIZ + f", f AS (SELECT row_idx, {FOLD.format('name')} AS n, {FOLD.format('category')} AS c FROM biz) SELECT row_idx, {segment_sql('n')} AS by_name, {segment_sql('c')} AS by_category FROM f")
def q_segment_of(spark, d):
    """Exact names, then the longest alias."""
    return biz(spark, d).select("row_idx", taxonomy.segment_of(F.col("name")).alias("by_name"), taxonomy.segment_of(F.col("category")).alias("by_category"))


@query(WITH_BIZ + f", f AS (SELECT row_idx, {FOLD.format('name')} AS n, trim({FOLD.format('name')} || ' ' || {FOLD.format('raw_category')}) AS w FROM biz) SELECT row_idx, array_to_string({exclusions_sql('n', 'w')}, '|') AS flags FROM f")
def q_exclusions(spark, d):
    """Brands, public bodies, other bases, by the full lists."""
    return biz(spark, d).select("row_idx", F.array_join(taxonomy.exclusion_flags(F.col("name"), F.col("raw_category")), "|").alias("flags"))


TAGGED = [kv for kv, _ in taxonomy.listed(taxonomy.TAGS, " ")]


@query("WITH t AS (SELECT c_custkey, " + pick("c_custkey", TAGGED) + " AS a, " + pick("c_custkey", TAGGED, 7) + " AS b FROM customer), k(kv, segment, n) AS (VALUES " + ", ".join(f"('{kv}', '{k}', {i})" for i, (kv, k) in enumerate(taxonomy.listed(taxonomy.TAGS, " ")))
    + "), m AS (SELECT c_custkey, min({'n': n, 's': segment, 'kv': kv}) AS x FROM t JOIN k ON kv = b OR (kv = a AND split_part(a, '=', 1) <> split_part(b, '=', 1)) GROUP BY c_custkey) SELECT t.c_custkey, coalesce(x.s, 'прочее') AS segment, coalesce(x.kv, '') AS tag FROM t LEFT JOIN m USING (c_custkey)")
def q_tag_segment(spark, d):
    """The first tag of the taxonomy that a place has."""
    t = table(spark, d, "customer").selectExpr("c_custkey", pick("c_custkey", TAGGED) + " AS a", pick("c_custkey", TAGGED, 7) + " AS b")
    key, value = (lambda c: F.substring_index(c, "=", 1)), (lambda c: F.substring_index(c, "=", -1))
    tags = F.when(key("a") == key("b"), F.create_map(key("b"), value("b"))).otherwise(F.create_map(key("a"), value("a"), key("b"), value("b")))
    return t.select("c_custkey", taxonomy.tag_segment(tags).alias("x")).select("c_custkey", "x.segment", "x.tag")


@query(WITH_BIZ + f", s AS (SELECT row_idx AS key, email AS raw, {HOST.format('website')} AS host FROM biz), {gate_ctes('s', 'g')} SELECT key AS row_idx, email, note, CASE WHEN email IS NOT NULL THEN {RELATION.format(e='email', h='host')} END AS relation FROM g")
def q_email_repair(spark, d):
    """Each address repaired or rejected by the whole gate, and how it relates to the row's site."""
    host = web.host_of(F.col("website"))
    x = biz(spark, d).select("row_idx", host.alias("host"), contact.cleaned_email(F.col("email"), host).alias("x")).select("row_idx", "host", "x.*")
    return x.select("row_idx", "email", "note", F.when(F.col("email").isNotNull(), contact.email_relation(F.col("email"), F.col("host"))).alias("relation"))


ALL_RAW = "list_filter(list_concat([email], list_transform(string_split(all_emails, '|'), lambda e: trim(e))), lambda e: trim(e) <> '')"
PASSED = f"""s AS (SELECT row_idx * 100 + i AS key, r AS raw, host FROM (SELECT row_idx, host, unnest(raws) AS r, generate_subscripts(raws, 1) AS i FROM (SELECT row_idx, {HOST.format('website')} AS host, {ALL_RAW} AS raws FROM biz))), {gate_ctes('s', 'g')},
u AS (SELECT key // 100 AS row_idx, email, min(key) AS place, any_value(host) AS host FROM g WHERE email IS NOT NULL GROUP BY 1, 2)"""


@query(WITH_BIZ + f", {PASSED} SELECT biz.row_idx, coalesce(arg_min(u.email, place), '') AS email, coalesce(string_agg(u.email, ' | ' ORDER BY place), '') AS all_emails FROM biz LEFT JOIN u USING (row_idx) GROUP BY biz.row_idx")
def q_email_row(spark, d):
    """I32: a row's addresses after the gate, each once, the first as the main one."""
    return biz(spark, d).select("row_idx", contact.cleaned_row(F.col("email"), F.col("all_emails"), web.host_of(F.col("website"))).alias("x")).select("row_idx", "x.*")


prefix_sql = lambda local, prefixes: "CASE " + " ".join(f"WHEN {local} = '{p}' OR starts_with({local}, '{p}.') THEN {50 - k}" for k, p in enumerate(prefixes)) + " ELSE 0 END"


@query(WITH_BIZ + f""", e AS (SELECT row_idx, lower(email) AS e, {HOST.format('website')} AS h FROM biz), p AS (SELECT *, split_part(e, '@', 1) AS l, {DOMAIN.format('e')} AS dom FROM e)
SELECT row_idx, CASE WHEN {' OR '.join(f"contains(e, '{b}')" for b in values.EMAIL_BLOCKS)} THEN -1 ELSE CASE WHEN h <> '' AND (dom = h OR ends_with(dom, '.' || h) OR ends_with(h, '.' || dom)) THEN 100 ELSE 0 END + {prefix_sql('l', values.SITE_PREFIXES)} END AS score FROM p""")  # fmt: skip
def q_email_score(spark, d):
    """How likely an address is a company's main one."""
    return biz(spark, d).select("row_idx", contact.email_score(F.col("email"), web.host_of(F.col("website"))).alias("score"))


EDGES = list(zip(values.CONTOUR, values.CONTOUR[1:] + values.CONTOUR[:1], strict=True))
LAT, LON = "TRY_CAST(nullif(latitude, '') AS DOUBLE)", "TRY_CAST(nullif(longitude, '') AS DOUBLE)"


@query(WITH_BIZ + f", p AS (SELECT row_idx, {LAT} AS y, {LON} AS x FROM biz) SELECT row_idx, coalesce((y BETWEEN 44.38::DOUBLE AND 44.78::DOUBLE AND x BETWEEN 33.35::DOUBLE AND 33.83::DOUBLE) OR ("
    + " + ".join(f"(({a}::DOUBLE > y) <> ({c}::DOUBLE > y) AND x < {e - b!r}::DOUBLE * (y - {a}::DOUBLE) / {c - a!r}::DOUBLE + {b}::DOUBLE)::INT" for (a, b), (c, e) in EDGES if a != c) + ") % 2 = 1, false) AS inside FROM p")
def q_in_contour(spark, d):
    """The peninsula's contour by the even-odd rule, and the box that closes its gap."""
    return biz(spark, d).select("row_idx", geo.in_contour(geo.coordinate(F.col("latitude"), 90), geo.coordinate(F.col("longitude"), 180)).alias("inside"))


@query(WITH_BIZ + f", c AS (SELECT row_idx, trim(regexp_replace(city, '\\s+', ' ', 'g')) AS c FROM biz) SELECT row_idx, CASE lower(c) {' '.join(f'''WHEN '{a}' THEN '{b}' ''' for a, b in values.CITY_ALIASES.items())} ELSE c END AS city FROM c")
def q_city_name(spark, d):
    """Known spellings of a city as one."""
    return biz(spark, d).select("row_idx", geo.city_name(F.col("city")).alias("city"))


SITES = ["https://m.vk.com/x", "shop.wildberries.ru", "notvk.com/a", "mail.ru", "HTTPS://WWW.t.co/", "firm.ru", "http://a.b.avito.ru:80/q", ""]


@query(f"WITH s AS (SELECT page_id, {pick('page_id', SITES)} AS u FROM pages), h AS (SELECT page_id, {HOST.format('u')} AS h FROM s) SELECT page_id, h <> '' AND {below('h', values.SOCIAL_HOSTS + values.PLATFORM_HOSTS)} AS no_site, {below('h', values.SOCIAL_HOSTS + values.PLATFORM_HOSTS + values.FREE_MAIL_HOSTS)} AS shared FROM h")
def q_shared_sites(spark, d):
    """Hosts that many companies share."""
    s = table(spark, d, "pages").selectExpr("page_id", f"{pick('page_id', SITES)} AS u")
    return s.select("page_id", web.is_foreign_site(F.col("u")).alias("no_site"), web.is_shared_host(web.host_of(F.col("u"))).alias("shared"))


N_CITY = f"regexp_replace({NORMAL.format('city')}, '^(?:г|город|пгт|поселок|село) ', '')"
N_ADDR = f"regexp_replace({NORMAL.format('address')}, '^улица', 'ул')"


@query(WITH_BIZ + f""", m AS (SELECT row_idx, lower(source) AS s, trim(source_id) AS i, lower(trim(coalesce(nullif(source_url, ''), social))) AS u, {NORMAL.format('name')} AS n, {N_CITY} AS c, {N_ADDR} AS a, {LAT} AS y, {LON} AS x,
  {HOST.format('website')} AS h, CASE WHEN phone <> '' THEN '7' || regexp_replace(phone, '[^0-9]', '', 'g')[2:] ELSE '' END AS p, {NORMAL.format('category')} AS k FROM biz)
SELECT row_idx, 'obs_' || sha256(CASE WHEN i <> '' THEN 'source-id|' || s || '|' || i WHEN u <> '' THEN 'source-url|' || s || '|' || u WHEN a <> '' THEN concat_ws('|', 'address', s, n, c, a)
  WHEN x IS NOT NULL AND y IS NOT NULL THEN concat_ws('|', 'coords', s, n, c, printf('%.5f', y) || ',' || printf('%.5f', x)) WHEN h <> '' THEN concat_ws('|', 'domain', s, n, c, h) WHEN p <> '' THEN concat_ws('|', 'phone', s, n, c, p)
  ELSE concat_ws('|', 'minimal', s, n, c, k) END)[1:24] AS id FROM m""")  # fmt: skip
def q_identity(spark, d):
    """The identity of a sighting by the first thing that tells it."""
    return identity.complete(biz(spark, d)).select("row_idx", identity.observation_id().alias("id"))


# --- golden records ----------------------------------------------------------------------------------------------------

WEAK = f"(source = 'VK' AND list_has_any({FLAGS.format('quality_flags')}, [{listed(values.QUARANTINE_FLAGS)}]))"
PRIO = "CASE source WHEN 'Я.Карты' THEN 50 WHEN 'OSM' THEN 40 WHEN 'VK' THEN 30 ELSE 20 END"
Q_EMAIL = f"CASE WHEN regexp_full_match(email, '[^@\\s]+@[^@\\s]+\\.[^@\\s]+') THEN 80 ELSE -40 END + CASE WHEN contains(email, '@') AND lower({DOMAIN.format('email')}) <> '' AND lower({DOMAIN.format('email')}) = {HOST.format('website')} THEN 20 ELSE 0 END"
Q_PHONE = "CASE WHEN phone <> '' THEN 90 ELSE -40 END"


def best_sql(field: str, quality: str, where: str) -> str:
    return f"(SELECT cluster, arg_max({field}, {{'q': {quality}, 'p': {PRIO}, 't': last_seen, 'l': length(trim({field})), 'r': -row_idx}}) AS v FROM w WHERE {field} <> '' AND {where} GROUP BY cluster)"


@query(WITH_BIZ + f""", w AS (SELECT *, {WEAK} AS weak FROM biz), c AS (SELECT cluster, bool_or(NOT weak) AS anchored, count(*) FILTER (WHERE weak) AS n_weak, min(first_seen) AS first_seen, max(last_seen) AS last_seen FROM w GROUP BY cluster),
x AS (SELECT c.*, coalesce(ea.v, '') AS ea, coalesce(ew.v, '') AS ew, coalesce(pa.v, '') AS pa, coalesce(pw.v, '') AS pw FROM c LEFT JOIN {best_sql('email', Q_EMAIL, 'NOT weak')} ea USING (cluster) LEFT JOIN {best_sql('email', Q_EMAIL, 'weak')} ew USING (cluster)
  LEFT JOIN {best_sql('phone', Q_PHONE, 'NOT weak')} pa USING (cluster) LEFT JOIN {best_sql('phone', Q_PHONE, 'weak')} pw USING (cluster)),
r AS (SELECT cluster, source, source_id, row_number() OVER (PARTITION BY cluster ORDER BY weak, {PRIO} DESC, last_seen DESC, (phone <> '')::INT + (email <> '')::INT + (website <> '')::INT + (address <> '')::INT + (social <> '')::INT DESC, row_idx) AS k FROM w),
g AS (SELECT cluster, latitude, longitude, row_number() OVER (PARTITION BY cluster ORDER BY weak, {PRIO} DESC, last_seen DESC, row_idx) AS k FROM w WHERE latitude <> '' AND longitude <> '' AND (NOT weak OR cluster IN (SELECT cluster FROM c WHERE NOT anchored)))
SELECT x.cluster, anchored, CASE WHEN ea <> '' OR ew = '' THEN ea ELSE ew END AS email, CASE WHEN pa <> '' OR pw = '' THEN pa ELSE pw END AS phone, r.source, r.source_id, coalesce(g.latitude, '') AS latitude, coalesce(g.longitude, '') AS longitude, first_seen, last_seen,
  anchored AND n_weak > 0 AS linked, anchored AND ea = '' AND ew <> '' AS email_donor FROM x JOIN r ON r.cluster = x.cluster AND r.k = 1 LEFT JOIN g ON g.cluster = x.cluster AND g.k = 1""")  # fmt: skip
def q_golden_record(spark, d):
    """Best values, the pair of coordinates, the representative, weak donors and their flags."""
    flags = F.split("quality_flags", r"\|")
    g = golden.golden(biz(spark, d))
    return g.select("cluster", "anchored", "email", "phone", "source", "source_id", "latitude", "longitude", "first_seen", "last_seen", F.array_contains(flags, "vk_weak_observation_linked").alias("linked"), F.array_contains(flags, "vk_weak_email_donor").alias("email_donor"))


@query(WITH_BIZ + """, m AS (SELECT cluster, CASE WHEN trim(source_id) <> '' THEN 'source-id|' || lower(source) || '|' || trim(source_id) END AS m FROM biz)
SELECT cluster, 'ent_' || sha256(string_agg(m, '|' ORDER BY m))[1:24] AS entity_id FROM m WHERE m IS NOT NULL GROUP BY cluster""")  # fmt: skip
def q_entity_id(spark, d):
    """The id of an entity by the source ids of its observations."""
    return golden.golden(biz(spark, d).filter("source_id <> ''")).select("cluster", "entity_id")


@query(f"""WITH i AS ({ORACLES['q_identity']}), b AS ({WITH_BIZ} SELECT row_idx, source, trim(source_id) AS s FROM biz), m AS (SELECT row_idx % 750 AS cluster, CASE WHEN s <> '' THEN 'source-id|' || lower(source) || '|' || s END AS m, id FROM b JOIN i USING (row_idx))
SELECT cluster, 'ent_' || sha256(coalesce(string_agg(m, '|' ORDER BY m), string_agg(id, '|' ORDER BY id)))[1:24] AS entity_id FROM m GROUP BY cluster""")  # fmt: skip
def q_entity_ids(spark, d):
    """Ids of all entities; those whose observations have no source id are known by their observations."""
    return golden.golden(biz(spark, d).withColumn("cluster", F.col("row_idx") % 750)).select("cluster", "entity_id")


@query(WITH_BIZ + f""", v AS (SELECT cluster, row_idx, 0 AS k, trim(email) AS v FROM biz UNION ALL SELECT cluster, row_idx, i, trim(p) FROM (SELECT cluster, row_idx, unnest(string_split(all_emails, '|')) AS p, generate_subscripts(string_split(all_emails, '|'), 1) AS i FROM biz)),
f AS (SELECT cluster, lower(v) AS id, min({{'r': row_idx, 'k': k, 'v': v}}) AS x FROM v WHERE v <> '' GROUP BY 1, 2) SELECT cluster, string_agg(x.v, ' | ' ORDER BY x.r, x.k) AS all_emails FROM f GROUP BY cluster""")  # fmt: skip
def q_contact_lists(spark, d):
    """All addresses of a cluster, main ones and lists, each once in order."""
    return biz(spark, d).groupBy("cluster").agg(golden.united("email").alias("all_emails"))


@query(WITH_BIZ + f""", o AS (SELECT *, row_idx % 1000 AS obs FROM biz), l AS (SELECT *, row_number() OVER (PARTITION BY obs ORDER BY last_seen DESC, row_idx) AS n FROM o)
SELECT 'o' || obs AS observation_id, max(quality_flags) FILTER (WHERE n = 1) AS quality_flags, coalesce(arg_min(confidence, n) FILTER (WHERE confidence <> ''), '') AS confidence, coalesce(arg_min(client_type, n) FILTER (WHERE client_type <> ''), '') AS client_type,
  min(first_seen) AS first_seen, max(last_seen) AS last_seen FROM l GROUP BY obs""")  # fmt: skip
def q_refresh_fold(spark, d):
    """Sightings of one observation as one; flags of the latest even where it has none."""
    rows = biz(spark, d).withColumn("observation_id", F.concat(F.lit("o"), (F.col("row_idx") % 1000).cast("string")))
    return golden.refreshed(rows).select("observation_id", "quality_flags", "confidence", "client_type", "first_seen", "last_seen")


# --- outreach ----------------------------------------------------------------------------------------------------------

OUT = f"""site AS (SELECT row_idx, CASE WHEN {FOREIGN_SITE('website')} THEN '' ELSE {HOST.format('website')} END AS host, regexp_extract_all(email || ' | ' || all_emails, '(?i)([a-z0-9._%+\\-]+@[a-z0-9.\\-]+\\.[a-z]{{2,}})', 1) AS raws FROM biz),
s AS (SELECT row_idx * 100 + i AS key, r AS raw, host FROM (SELECT row_idx, host, unnest(raws) AS r, generate_subscripts(raws, 1) AS i FROM site)), {gate_ctes('s', 'g')},
c AS (SELECT DISTINCT key // 100 AS row_idx, email, host FROM g WHERE email IS NOT NULL AND NOT regexp_matches(email, '{values.OUTREACH_BLOCKS}') AND NOT {below(DOMAIN.format('email'), taxonomy.BRAND_MAIL_DOMAINS)}),
sc AS (SELECT *, CASE {RELATION.format(e='email', h='host')} WHEN 'same' THEN 100 WHEN 'free' THEN 10 ELSE 0 END + {prefix_sql("split_part(email, '@', 1)", values.OUTREACH_PREFIXES)} AS score FROM c),
cand AS (SELECT row_idx, string_agg(email, ' | ' ORDER BY score DESC, email) AS candidates, first(email ORDER BY score DESC, email) AS best FROM sc GROUP BY row_idx),
ex AS (SELECT row_idx, {FLAGS.format('quality_flags')} AS fl, {exclusions_sql(FOLD.format('name'), f"trim({FOLD.format('name')} || ' ' || trim({FOLD.format('category')} || ' ' || {FOLD.format('raw_category')}))")} AS now FROM biz),
r AS (SELECT biz.*, candidates, best, CASE WHEN trim(name) = '' THEN 'missing_name' WHEN len(list_concat(list_intersect(fl, [{listed(values.EXCLUDED_FLAGS)}]), now)) > 0 THEN list_sort(list_concat(list_intersect(fl, [{listed(values.EXCLUDED_FLAGS)}]), now))[1]
  WHEN client_type NOT IN ({listed(taxonomy.TITLES)}) THEN 'no_segment' WHEN client_type = 'it_svyaz' THEN 'competitor_segment' WHEN best IS NULL THEN 'missing_or_invalid_email' WHEN list_has_any(fl, [{listed(values.HARD_REJECT_FLAGS)}]) THEN 'hard_quality_flag'
  WHEN list_contains(fl, 'vk_weak_contact_donor') THEN 'weak_vk_contact_donor' WHEN {SURE} < 0.7 THEN 'low_confidence' WHEN list_contains(fl, 'manual_review') AND {SURE} < 0.85 THEN 'manual_review' ELSE '' END AS reason
  FROM biz JOIN ex USING (row_idx) LEFT JOIN cand USING (row_idx)),
j AS (SELECT *, CASE WHEN reason = '' AND row_number() OVER (PARTITION BY reason, best ORDER BY {SURE} DESC, (phone <> '')::INT + (website <> '')::INT + (social <> '')::INT + (address <> '')::INT DESC, row_idx) > 1 THEN 'duplicate_email' ELSE reason END AS review_reason FROM r)"""


@query(WITH_BIZ + f", {OUT} SELECT row_idx, coalesce(candidates, '') AS candidates, review_reason FROM j")
def q_outreach_review(spark, d):
    """Candidates of every row, and why it is held back."""
    return outreach.reviewed(biz(spark, d)).select("row_idx", F.array_join("candidates", " | ").alias("candidates"), "review_reason")


CACHE_SQL = "SELECT DISTINCT CASE p_partkey % 5 WHEN 0 THEN 'firm.ru' WHEN 1 THEN 'shop.firm.ru' WHEN 2 THEN 'tk-kit.com' ELSE 'x' || p_partkey || '.ru' END AS host FROM part"
SIGNALS_OF = {"firm.ru": ("outdated,no_mobile", "ok"), "shop.firm.ru": ("", "blocked"), "tk-kit.com": ("site_dead", "")}


def cache_of(spark, d):
    host = F.when(F.col("p_partkey") % 5 == 0, "firm.ru").when(F.col("p_partkey") % 5 == 1, "shop.firm.ru").when(F.col("p_partkey") % 5 == 2, "tk-kit.com").otherwise(F.concat(F.lit("x"), F.col("p_partkey").cast("string"), F.lit(".ru")))
    c = table(spark, d, "part").select(host.alias("host")).distinct()
    known = lambda k: F.coalesce(*[F.when(F.col("host") == h, F.lit(v[k])) for h, v in SIGNALS_OF.items()], F.lit("" if k == 0 else "ok"))
    return c.select("host", F.filter(F.split(known(0), ","), lambda x: x != "").alias("signals"), F.lit("2026-10-01T00:00:00+00:00").alias("checked_at"), known(1).alias("status"))


NO_SITE = f"(trim(website) = '' OR {FOREIGN_SITE('website')})"
ROW_SIGNALS = f"CASE WHEN {NO_SITE} THEN 'no_website' WHEN {HOST.format('website')} = 'firm.ru' THEN 'no_mobile; outdated' WHEN {HOST.format('website')} = 'tk-kit.com' THEN 'site_dead' ELSE 'not_checked' END"
TITLE = "CASE client_type " + " ".join(f"WHEN '{k}' THEN '{t}'" for k, t in taxonomy.TITLES.items()) + " ELSE 'Прочее' END"


@query(WITH_BIZ + f""", {OUT} SELECT best AS "Email", name AS "Название", {TITLE} AS "Сегмент", city AS "Город", phone AS "Телефон", website AS "Сайт", {ROW_SIGNALS} AS "Сигналы", printf('%.2f', {SURE}) AS "Доверие", candidates AS "Все email",
  array_to_string(list_concat(list_filter([quality_flags], lambda f: f <> ''), CASE WHEN {RELATION.format(e='best', h=f"CASE WHEN {FOREIGN_SITE('website')} THEN '' ELSE {HOST.format('website')} END")} = 'foreign' THEN ['email_foreign_domain'] ELSE [] END), '|') AS "Флаги качества" FROM j WHERE review_reason = ''""")  # fmt: skip
def q_outreach_ready(spark, d):
    """The sheet that is reviewed."""
    ready, _ = outreach.outreach(biz(spark, d), cache_of(spark, d))
    return ready.select("Email", "Название", "Сегмент", "Город", "Телефон", "Сайт", "Сигналы", "Доверие", "Все email", "Флаги качества")


@query(WITH_BIZ + f", {OUT}, z AS (SELECT client_type, string_split({ROW_SIGNALS}, '; ') AS sg FROM j WHERE review_reason = ''), k AS (SELECT 'segment' AS kind, client_type AS key FROM z UNION ALL SELECT 'signal', unnest(sg) FROM z) SELECT kind, key, count(*) AS n FROM k GROUP BY 1, 2")
def q_outreach_counts(spark, d):
    """Ready rows by segment and by signal."""
    judged = outreach.reviewed(biz(spark, d)).filter("review_reason = ''")
    return outreach.counts(signals.row_signals(judged, cache_of(spark, d)))


OTHER = "SELECT s_suppkey, 'a' || (s_suppkey % 30) || '@hotel' || (s_suppkey % 7) || '.ru' AS email, 'https://hotel' || (s_suppkey % 7) || '.ru' || CASE WHEN s_suppkey % 2 = 0 THEN ' | booking.com/x' ELSE ', site' || s_suppkey || '.ru' END AS website FROM supplier"


@query(f"""WITH o AS ({OTHER}), p AS (SELECT DISTINCT s_suppkey, {HOST.format('u')} AS h FROM (SELECT s_suppkey, unnest(regexp_split_to_array(website, '[|,\\s]+')) AS u FROM o)), dom AS (SELECT h FROM p WHERE h <> '' AND NOT {below('h', values.SOCIAL_HOSTS + values.PLATFORM_HOSTS + values.FREE_MAIL_HOSTS)} GROUP BY h HAVING count(*) <= 5),
r AS (SELECT c_custkey, 'a' || (c_custkey % 40) || '@hotel' || (c_custkey % 9) || '.ru' AS email, CASE WHEN c_custkey % 3 = 0 THEN 'site' || (c_custkey % 50) || '.ru' ELSE 'mail.ru' END AS website FROM customer)
SELECT c_custkey AS row_idx FROM r WHERE email IN (SELECT email FROM o) OR website IN (SELECT h FROM dom) OR split_part(email, '@', 2) IN (SELECT h FROM dom)""")  # fmt: skip
def q_other_base(spark, d):
    """Rows that another base has, by an address or by a domain that few of its rows share."""
    other = table(spark, d, "supplier").selectExpr("concat('a', s_suppkey % 30, '@hotel', s_suppkey % 7, '.ru') AS email", "concat('https://hotel', s_suppkey % 7, '.ru', CASE WHEN s_suppkey % 2 = 0 THEN ' | booking.com/x' ELSE concat(', site', s_suppkey, '.ru') END) AS website")
    rows = table(spark, d, "customer").selectExpr("c_custkey AS row_idx", "concat('a', c_custkey % 40, '@hotel', c_custkey % 9, '.ru') AS email", "CASE WHEN c_custkey % 3 = 0 THEN concat('site', c_custkey % 50, '.ru') ELSE 'mail.ru' END AS website")
    return outreach.in_other_base(rows, *outreach.bases(other))


# --- sites -------------------------------------------------------------------------------------------------------------


@query(WITH_BIZ + f", h AS (SELECT {HOST.format('website')} AS host, client_type, email || all_emails AS e, list_transform(string_split(quality_flags, '|'), lambda f: trim(f)) AS fl FROM biz WHERE NOT {NO_SITE}) SELECT host, bool_or(client_type IN ({listed(taxonomy.BOOKING_SEGMENTS)})) AS booking, bool_or(client_type IN ({listed(taxonomy.TITLES)}) AND contains(e, '@') AND NOT list_has_any(fl, [{listed(values.EXCLUDED_FLAGS)}])) AS eligible FROM h WHERE host <> '' GROUP BY host")
def q_signal_targets(spark, d):
    """One row a site, with what its companies need."""
    return signals.targets(biz(spark, d))


SITE_CACHE = "SELECT s_suppkey AS k, 'site' || s_suppkey || '.ru' AS host, CASE s_suppkey % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'dead' WHEN 2 THEN '' ELSE 'blocked' END AS status, CASE WHEN s_suppkey % 8 = 2 THEN ['site_dead'] ELSE ['outdated'] END AS signals, '2026-10-' || lpad(CAST(1 + s_suppkey % 28 AS STRING), 2, '0') || ' 00:00:00' AS checked_at FROM supplier"


@query(f"""WITH c AS ({SITE_CACHE}), t AS (SELECT 'site' || p_partkey || '.ru' AS host, p_partkey % 2 = 0 AS eligible FROM part),
a AS (SELECT t.*, c.host IS NOT NULL AS cached, coalesce(checked_at, '') AS checked_at, coalesce(nullif(status, ''), CASE WHEN list_contains(signals, 'site_dead') THEN 'dead' ELSE 'ok' END) AS st FROM t LEFT JOIN c USING (host))
SELECT host, row_number() OVER (ORDER BY eligible DESC, cached, checked_at, host) AS place FROM a WHERE NOT cached OR checked_at::TIMESTAMP <= TIMESTAMP '2026-10-29 00:00:00' - CASE WHEN st = 'ok' THEN INTERVAL 30 DAY ELSE INTERVAL 7 DAY END QUALIFY place <= 400""")  # fmt: skip
def q_signal_queue(spark, d):
    """Sites whose verdict is too old, in the order in which they are checked."""
    from pyspark.sql.window import Window as W

    cache = table(spark, d, "supplier").selectExpr("concat('site', s_suppkey, '.ru') AS host", "CASE WHEN s_suppkey % 8 = 2 THEN array('site_dead') ELSE array('outdated') END AS signals", "concat('2026-10-', lpad(CAST(1 + s_suppkey % 28 AS STRING), 2, '0'), ' 00:00:00') AS checked_at", "CASE s_suppkey % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'dead' WHEN 2 THEN '' ELSE 'blocked' END AS status")
    sites = table(spark, d, "part").selectExpr("concat('site', p_partkey, '.ru') AS host", "false AS booking", "p_partkey % 2 = 0 AS eligible")
    first = signals.batch(signals.stale(sites, cache, "2026-10-29 00:00:00"))
    return first.select("host", F.row_number().over(W.orderBy(F.col("eligible").desc(), "cached", "checked_at", "host")).cast("long").alias("place"))  # 400 rows


KINDS = ["ok", "unreachable", "blocked", "unstable", "unknown", "error"]
YEAR_SQL, OLD_SQL, PARKED_SQL = (p.replace("'", "''").replace("(?iu)", "(?i)") for p in (web.YEARS, web.OLD, web.PARKED))
FAILED = "IN ('unreachable', 'error', 'unstable')"


@query(f"""WITH a AS (SELECT page_id, {pick('page_id', KINDS)} AS s, {pick('page_id', KINDS, 4)} AS p, html || CASE WHEN page_id % 11 = 0 THEN ' this domain is for sale' WHEN page_id % 5 = 0 THEN ' &copy; 2010–2026' WHEN page_id % 7 = 0 THEN ' © 2001 tilda.ws' ELSE '' END AS html FROM pages),
v AS (SELECT *, CASE WHEN s = 'blocked' THEN 'blocked' WHEN s = 'ok' THEN 'ok' WHEN p = 'ok' THEN 'ok' WHEN p = 'blocked' THEN 'blocked' WHEN s {FAILED} AND p {FAILED} THEN 'dead' ELSE 'unknown' END AS st FROM a),
w AS (SELECT *, CASE WHEN st = 'ok' AND regexp_matches(html, '{PARKED_SQL}') THEN 'dead' ELSE st END AS status, list_transform(list_concat(regexp_extract_all(html, '{YEAR_SQL}', 1), list_filter(regexp_extract_all(html, '{YEAR_SQL}', 2), lambda y: y <> '')), lambda y: y::INT) AS years FROM v)
SELECT page_id, status, CASE status WHEN 'dead' THEN 'site_dead' WHEN 'ok' THEN array_to_string(list_filter([CASE WHEN s <> 'ok' AND s {FAILED} THEN 'no_https' END, CASE WHEN NOT regexp_matches(html, '(?i)<meta[^>]+name=["'']?viewport') THEN 'no_mobile' END,
  CASE WHEN page_id % 2 = 0 AND NOT regexp_matches(html, '{web.BOOKING}') THEN 'no_online_booking' END, CASE WHEN regexp_matches(html, '{web.BUILDERS}') THEN 'site_builder' END,
  CASE WHEN coalesce(list_max(years) <= 2023, false) OR regexp_matches(html, '{OLD_SQL}') THEN 'outdated' END], lambda x: x IS NOT NULL), '|') ELSE '' END AS signals FROM w""")  # fmt: skip
def q_site_probe(spark, d):
    """The verdict on a site from both schemes and its page."""
    more = F.when(F.col("page_id") % 11 == 0, " this domain is for sale").when(F.col("page_id") % 5 == 0, " &copy; 2010–2026").when(F.col("page_id") % 7 == 0, " © 2001 tilda.ws").otherwise("")
    page = F.concat("html", more)
    a = table(spark, d, "pages").select(F.col("page_id").cast("string").alias("host"), (F.col("page_id") % 2 == 0).alias("booking"), F.expr(pick("page_id", KINDS)).alias("https"), F.expr(pick("page_id", KINDS, 4)).alias("http"), page.alias("https_html"), page.alias("http_html"))
    return signals.probed(a, 2026, "now").select(F.col("host").cast("long").alias("page_id"), "status", F.array_join("signals", "|").alias("signals"))


@query(f"""WITH e AS (SELECT user_id % 40 AS batch, event_id, CASE WHEN (user_id % 40) % 3 = 0 AND event_id % 10 <> 0 THEN 'dead' ELSE 'ok' END AS status FROM events), b AS (SELECT batch, count(*) AS n, avg((status = 'dead')::INT) AS dead FROM e GROUP BY batch)
SELECT event_id, status FROM e JOIN b USING (batch) WHERE NOT (n >= 10 AND dead >= 0.8 AND status = 'dead')""")  # fmt: skip
def q_outage(spark, d):
    """The dead of a batch that is nearly all dead are no verdicts."""
    e = table(spark, d, "events").selectExpr("user_id % 40 AS batch", "event_id", "CASE WHEN (user_id % 40) % 3 = 0 AND event_id % 10 <> 0 THEN 'dead' ELSE 'ok' END AS status")
    return signals.without_outage(e, ["batch"]).select("event_id", "status")


STATUSES = ["ok", "empty", "timeout", "ok", "markup_error", "navigation_error", "search_timeout", "empty"]
STATUS = f"CASE WHEN event_id % 400 = 399 THEN 'captcha' WHEN (user_id % 20) % 4 = 0 THEN 'ok' ELSE {pick('event_id', STATUSES, 3)} END"
WINDOW = "PARTITION BY run ORDER BY ts, event_id"


@query(f"""WITH e AS (SELECT user_id % 20 AS run, ts, event_id, {STATUS} AS st FROM events), a AS (SELECT *, row_number() OVER ({WINDOW}) AS seq, sum((st IN ('ok', 'empty', 'search_no_results'))::INT) OVER ({WINDOW}) AS island FROM e),
b AS (SELECT *, sum((st IN ({listed(signals.WALLS)}))::INT) OVER ({WINDOW}) AS walls, sum((st IN ({listed(signals.FAILURES)}))::INT) OVER (PARTITION BY run, island ORDER BY ts, event_id) AS row_, count(*) OVER w AS n, sum((st IN ({listed(signals.FAILURES)}))::INT) OVER w AS f,
  sum((st IN ({listed(signals.DETAILS)}))::INT) OVER w AS dn, sum((st = 'empty')::INT) OVER w AS em FROM a WINDOW w AS ({WINDOW} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
r AS (SELECT run, seq, CASE WHEN walls >= 1 THEN 'yandex_' || st WHEN row_ >= 6 THEN 'consecutive_detail_failures' WHEN n >= 10 AND f >= 0.5 * n THEN 'high_detail_failure_ratio' WHEN dn >= 10 AND em >= 0.8 * dn THEN 'high_empty_detail_ratio' END AS reason FROM b)
SELECT run, min(seq) AS seq, arg_min(reason, seq) AS reason FROM r WHERE reason IS NOT NULL GROUP BY run""")  # fmt: skip
def q_breaker(spark, d):
    """F2, K7: where a source goes off, for good, and why."""
    e = table(spark, d, "events").selectExpr("user_id % 20 AS run", "ts", "event_id", f"{STATUS} AS status")
    return signals.breaker(e, ["run"], ["ts", "event_id"])


# --- enrichment --------------------------------------------------------------------------------------------------------

MEMORY = "SELECT 'firm' || s_suppkey || '.ru' AS host, CASE s_suppkey % 3 WHEN 0 THEN 'found' WHEN 1 THEN 'none' ELSE 'dead' END AS status, '2026-' || CASE WHEN s_suppkey % 2 = 0 THEN '10' ELSE '08' END || '-' || lpad(CAST(1 + s_suppkey % 28 AS STRING), 2, '0') || ' 00:00:00' AS checked_at, 'office@firm' || s_suppkey || '.ru' AS email, '8 978 000-00-' || lpad(CAST(s_suppkey % 100 AS STRING), 2, '0') AS phone FROM supplier"
SITE_ROWS = "SELECT c_custkey AS row_idx, CASE WHEN c_custkey % 10 = 0 THEN '' ELSE 'https://www.firm' || (c_custkey % 700) || '.ru/' END AS website, CASE WHEN c_custkey % 4 = 0 THEN 'x@firm' || (c_custkey % 700) || '.ru' ELSE '' END AS email, CASE WHEN c_custkey % 3 = 0 THEN '8 (978) 111-22-33' ELSE '' END AS phone FROM customer"
SPARK_ROWS = SITE_ROWS.replace("'https://www.firm' || (c_custkey % 700) || '.ru/'", "concat('https://www.firm', c_custkey % 700, '.ru/')").replace("'x@firm' || (c_custkey % 700) || '.ru'", "concat('x@firm', c_custkey % 700, '.ru')")


def site_rows(spark, d):
    table(spark, d, "customer").createOrReplaceTempView("customer")
    rows = spark.sql(SPARK_ROWS)
    return rows.withColumns({c: F.lit("") for c in ("address", "social", "all_emails", "all_phones", "all_socials")})


@query(f"""WITH m AS ({MEMORY}), r AS (SELECT *, {HOST.format('website')} AS h FROM ({SITE_ROWS})), f AS (SELECT * FROM m WHERE checked_at::TIMESTAMP > TIMESTAMP '2026-10-20 00:00:00' - CASE status WHEN 'found' THEN INTERVAL 60 DAY WHEN 'none' THEN INTERVAL 14 DAY ELSE INTERVAL 7 DAY END),
j AS (SELECT r.*, f.status, f.email AS fe, f.phone AS fp FROM r LEFT JOIN f ON f.host = r.h AND r.h <> '')
SELECT row_idx, CASE WHEN status = 'found' AND email = '' THEN fe ELSE email END AS email, CASE WHEN status = 'found' AND phone = '' THEN fp ELSE phone END AS phone, status IS NULL AS pending FROM j""")  # fmt: skip
def q_enrich_memory(spark, d):
    """What earlier visits found, as long as it is good."""
    s = table(spark, d, "supplier")
    memory = s.selectExpr("concat('firm', s_suppkey, '.ru') AS host", "CASE s_suppkey % 3 WHEN 0 THEN 'found' WHEN 1 THEN 'none' ELSE 'dead' END AS status", "concat('2026-', CASE WHEN s_suppkey % 2 = 0 THEN '10' ELSE '08' END, '-', lpad(CAST(1 + s_suppkey % 28 AS STRING), 2, '0'), ' 00:00:00') AS checked_at",
        "concat('office@firm', s_suppkey, '.ru') AS email", "concat('8 978 000-00-', lpad(CAST(s_suppkey % 100 AS STRING), 2, '0')) AS phone", "'' AS address", "'' AS social", "'' AS all_emails", "'' AS all_phones", "'' AS all_socials")
    return enrich.apply_memory(site_rows(spark, d), memory, "2026-10-20 00:00:00").select("row_idx", "email", "phone", "pending")


@query(f"WITH r AS (SELECT *, {HOST.format('website')} AS h FROM ({SITE_ROWS})), v AS (SELECT 'firm' || s_suppkey || '.ru' AS host, s_suppkey % 2 = 0 AS found, 'info@firm' || s_suppkey || '.ru' AS e FROM supplier) SELECT row_idx, CASE WHEN email = '' AND found THEN e ELSE email END AS email, CASE WHEN found THEN CASE WHEN email IN ('', e) THEN e ELSE email || ' | ' || e END ELSE '' END AS all_emails FROM r LEFT JOIN v ON host = h")
def q_visit_fanout(spark, d):
    """One visit of a host serves all its rows."""
    v = table(spark, d, "supplier").select(F.concat(F.lit("firm"), F.col("s_suppkey").cast("string"), F.lit(".ru")).alias("host"), F.when(F.col("s_suppkey") % 2 == 0, F.array(F.concat(F.lit("info@firm"), F.col("s_suppkey").cast("string"), F.lit(".ru")))).otherwise(F.array().cast("array<string>")).alias("emails"), F.array().cast("array<string>").alias("phones"))
    return enrich.apply_visits(site_rows(spark, d), v).select("row_idx", "email", "all_emails")


@query(f"WITH r AS ({SITE_ROWS}) SELECT row_idx, CASE WHEN website = '' THEN 2 WHEN email = '' THEN 0 ELSE 1 END AS place FROM r")
def q_visit_order(spark, d):
    """Rows to work on, those without an address first, those without a site last."""
    return enrich.visit_order(site_rows(spark, d), email_only=False, site_finder=True)


@query("""WITH p AS (SELECT page_id, html, split_part(split_part(url, '://', 2), '/', 1) AS loc, url FROM pages), l AS (SELECT page_id, loc, unnest(regexp_extract_all(html, '(?i)<a\\b[^>]*?href=["'']([^"''#][^"'']*)["''][^>]*>', 1)) AS u FROM p)
SELECT page_id, count(DISTINCT u) AS n FROM l WHERE regexp_matches(u, '^https?://') AND regexp_replace(lower(regexp_extract(u, '^https?://([^/?#]*)', 1)), '^www\\.', '') IN ('vk.com', 't.me', 'ok.ru') GROUP BY page_id""")  # fmt: skip
def q_profile_links(spark, d):
    """Links of a page to profiles on three networks."""
    own = F.filter(F.regexp_extract_all("html", F.lit("(?i)<a\\b[^>]*?href=[\"']([^\"'#][^\"']*)[\"'][^>]*>"), F.lit(1)), lambda u: u.rlike("^https?://") & web.net_location(u).isin("vk.com", "t.me", "ok.ru"))
    return table(spark, d, "pages").select("page_id", F.size(F.array_distinct(own)).cast("long").alias("n")).filter("n > 0")


# --- sources -----------------------------------------------------------------------------------------------------------

GROUP_NAMES = ["Барбершоп №1", "Подслушано Ялта", "Магазин одежды Стиль", "Клуб", "Ремонт квартир"]
ACTIVITIES = ["Новости", "Автосервис", "", "Мебель на заказ"]
DESCRIPTIONS = ["Экскурсии по Крыму", "пишите a@firm.ru", ""]
ASKED = ["маникюр", "барбершоп", "экскурсии"]
SITE_OF = ["firm.ru/x?y", "vk.com/a", ""]


@query(f"""WITH g AS (SELECT c_custkey AS id, {pick('c_custkey', GROUP_NAMES)} AS n, {pick('c_custkey', ACTIVITIES)} AS a, {pick('c_custkey', DESCRIPTIONS)} AS de, {pick('c_custkey', SITE_OF, 2)} AS si FROM customer),
s AS (SELECT *, {segment_sql(FOLD.format('n'))} AS sn, {segment_sql(FOLD.format('a'))} AS sa, {segment_sql(FOLD.format('de'))} AS sd, regexp_matches(lower(n || ' ' || a), '{EDGE_L}(?:{taxonomy.NOISE.replace(chr(92) + 'w', LETTER)}){EDGE_R}') AS noise,
  (contains(lower(n || ' ' || a || ' ' || de), 'барбершоп'))::INT + (contains(lower(n || ' ' || a || ' ' || de), 'маникюр'))::INT + (contains(lower(n || ' ' || a || ' ' || de), 'экскурсии'))::INT AS hits FROM g),
c AS (SELECT *, (sn <> 'прочее' OR sa <> 'прочее') AS prim, least(0.35::DOUBLE + CASE WHEN sn <> 'прочее' OR sa <> 'прочее' THEN 0.35::DOUBLE ELSE 0 END + CASE WHEN sd <> 'прочее' THEN 0.10::DOUBLE ELSE 0 END + least(0.15::DOUBLE, 0.05::DOUBLE * hits), CASE WHEN noise THEN 0.25::DOUBLE ELSE 1 END, CASE WHEN sn <> 'прочее' OR sa <> 'прочее' THEN 1 ELSE 0.60::DOUBLE END) AS score FROM s)
SELECT id, printf('%.2f', score::DOUBLE) AS confidence, array_to_string(list_filter([CASE WHEN NOT prim THEN 'vk_no_primary_segment_signal' END, CASE WHEN noise THEN 'vk_noise_primary' END, CASE WHEN si <> 'firm.ru/x?y' THEN 'vk_no_own_website' END, CASE WHEN score < 0.5 THEN 'manual_review' END], lambda x: x IS NOT NULL), '|') AS quality_flags,
  CASE WHEN sa <> 'прочее' THEN sa WHEN sn <> 'прочее' THEN sn ELSE 'krasota' END AS category, CASE WHEN si = 'firm.ru/x?y' THEN 'https://firm.ru/x' WHEN si = '' THEN '' ELSE 'https://vk.com/a' END AS website, CASE WHEN contains(de, '@') THEN 'a@firm.ru' ELSE '' END AS email FROM c""")  # fmt: skip
def q_group_rows(spark, d):
    """Groups of a social network as observations."""
    g = table(spark, d, "customer").selectExpr("CAST(c_custkey AS BIGINT) AS id", f"{pick('c_custkey', GROUP_NAMES)} AS name", f"{pick('c_custkey', ACTIVITIES)} AS activity", f"{pick('c_custkey', DESCRIPTIONS)} AS description", "'' AS status", f"{pick('c_custkey', SITE_OF, 2)} AS site", "'' AS screen_name",
        "CAST(NULL AS struct<title: string>) AS city", "CAST(NULL AS array<struct<email: string, phone: string>>) AS contacts", "CAST(NULL AS array<struct<city: struct<title: string, name: string>, address: string, title: string>>) AS addresses")
    found = g.select("id", F.lit("Ялта").alias("city"), F.array(*map(F.lit, ASKED)).alias("queries"))
    return readers.group_rows(g, found).select(F.col("source_id").cast("long").alias("id"), "confidence", "quality_flags", "category", "website", "email")


@query("SELECT o_custkey AS id, arg_min(o_orderpriority, o_orderkey) AS city, string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus) AS queries FROM orders WHERE o_custkey <> 0 GROUP BY o_custkey")
def q_found_groups(spark, d):
    """Groups of all searches, the first city and every query."""
    r = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("city"), F.col("o_orderstatus").alias("query"), F.col("o_orderkey").alias("place"))
    return readers.found_groups(r).select("id", "city", F.array_join("queries", "|").alias("queries"))


OSM_NAME, OSM_TOWN = ["Лотос", "", "Мотор"], ["", "Большая Ялта", "Джанкой", "Малореречен."]
OSM_SQL = f"""WITH e AS (SELECT c_custkey AS id, {pick('c_custkey', OSM_NAME)} AS n, {pick('c_custkey', ['', 'Оператор'], 3)} AS op, {pick('c_custkey', OSM_TOWN)} AS town, 44.0::DOUBLE + (c_custkey % 200)::DOUBLE / 100 AS y, 33.0::DOUBLE + (c_custkey % 350)::DOUBLE / 100 AS x,
  '8 978 ' || lpad(CAST(c_custkey % 1000 AS STRING), 7, '0') AS ph FROM customer), p AS (SELECT *, CASE WHEN n <> '' THEN n ELSE op END AS name, coalesce((y BETWEEN 44.38::DOUBLE AND 44.78::DOUBLE AND x BETWEEN 33.35::DOUBLE AND 33.83::DOUBLE) OR ({' + '.join(f"(({a}::DOUBLE > y) <> ({c}::DOUBLE > y) AND x < {e - b!r}::DOUBLE * (y - {a}::DOUBLE) / {c - a!r}::DOUBLE + {b}::DOUBLE)::INT" for (a, b), (c, e) in EDGES if a != c)}) % 2 = 1, false) AS inside FROM e)
SELECT id, name, CASE town WHEN 'Большая Ялта' THEN 'Ялта' WHEN 'Джанкой' THEN 'Джанкой' WHEN 'Малореречен.' THEN 'Малореченское' ELSE coalesce({', '.join(f"CASE WHEN y BETWEEN {a}::DOUBLE AND {b}::DOUBLE AND x BETWEEN {c}::DOUBLE AND {e}::DOUBLE THEN '{n}' END" for n, a, b, c, e in values.CITY_BOXES)}, 'Крым') END AS city,
  CASE WHEN town <> '' THEN 'г. ' || town || ', ' ELSE '' END || 'ул. Мира, ' || (id % 9) AS address, '+7 (978) ' || ph[7:9] || '-' || ph[10:11] || '-' || ph[12:13] || ' | x' AS all_phones, 'avto' AS category, 'shop=car' AS raw_category FROM p WHERE name <> '' AND inside"""


@query(OSM_SQL)
def q_osm_rows(spark, d):
    """Places of a map as observations."""
    e = table(spark, d, "customer").selectExpr("CAST(c_custkey AS BIGINT) AS id", "'node' AS type", "CAST(44.0 AS DOUBLE) + CAST(c_custkey % 200 AS DOUBLE) / 100 AS lat", "CAST(33.0 AS DOUBLE) + CAST(c_custkey % 350 AS DOUBLE) / 100 AS lon", "CAST(NULL AS struct<lat: double, lon: double>) AS center",
        f"map('name', {pick('c_custkey', OSM_NAME)}, 'operator', {pick('c_custkey', ['', 'Оператор'], 3)}, 'addr:city', {pick('c_custkey', OSM_TOWN)}, 'addr:street', 'Мира', 'addr:housenumber', CAST(c_custkey % 9 AS STRING), 'phone', concat('8 978 ', lpad(CAST(c_custkey % 1000 AS STRING), 7, '0'), '; x;X'), 'shop', 'car') AS tags")
    return readers.osm_rows(e).select(F.substring_index("source_id", ":", -1).cast("long").alias("id"), "name", "city", "address", "all_phones", "category", "raw_category")


@query(WITH_BIZ + f", f AS (SELECT row_idx, {FLAGS.format('quality_flags')} AS fl, {WEAK} AS weak FROM biz) SELECT row_idx, NOT weak AND NOT list_has_any(fl, [{listed(values.QUARANTINE_FLAGS)}, 'vk_weak_website_donor']) AS may_seed FROM f")
def q_crawl_seeds(spark, d):
    """Rows whose site may be visited."""
    return biz(spark, d).select("row_idx", golden.may_seed().alias("may_seed"))


@query(WITH_BIZ + ", n AS (SELECT *, coalesce(nullif(trim(city), ''), 'Без города') AS c FROM biz), k AS (SELECT c, count(*) AS n FROM n GROUP BY c) SELECT row_idx, CASE WHEN k.n >= 5 THEN left(trim(regexp_replace(c, '[\\[\\]:*?/\\\\]', ' ', 'g')), 31) ELSE 'Остальные' END AS sheet FROM n JOIN k USING (c)")
def q_city_sheets(spark, d):
    """A sheet for each larger city."""
    return sinks.city_sheets(biz(spark, d)).select("row_idx", "sheet")


CELLS = ["<b>A &amp; B</b>  C", "x&nbsp;y&#64;z", "a&lt;b", "line\nbreak\ttab", "plain"]


@query(f"""WITH c AS (SELECT p_partkey, {pick('p_partkey', CELLS)} AS c FROM part) SELECT p_partkey, trim(regexp_replace(translate(replace(replace(replace(replace(regexp_replace(c, '<[^>]+>', ' ', 'g'), '&nbsp;', chr(160)), '&#64;', '@'), '&lt;', '<'), '&amp;', '&'), chr(13) || chr(10) || chr(9) || chr(160), '    '), '\\s{{2,}}', ' ', 'g')) AS cell FROM c""")
def q_clean_cells(spark, d):
    """Cells without tags and references."""
    return table(spark, d, "part").selectExpr("p_partkey", f"{pick('p_partkey', CELLS)} AS c").select("p_partkey", identity.clean_cell(F.col("c")).alias("cell"))


COMPANY = "CAST(c_custkey % 1500 AS STRING)"
BRANCHES = {
    "row_idx": "c_custkey", "source": pick("c_custkey", ["OSM", "VK", "Crawler"]), "source_id": "CAST(c_custkey AS STRING)", "name": f"md5({COMPANY})", "city": "'Ялта'",
    "address": f"CASE WHEN c_custkey % 1500 % 3 = 0 THEN '' ELSE concat('Улица ', md5({COMPANY}), ', ', CAST(CAST(floor(c_custkey / 1500) AS BIGINT) % 2 AS STRING)) END", "phone": f"concat('8 978 ', lpad({COMPANY}, 7, '1'))",
    "website": "''", "latitude": "''", "longitude": "''",
}


@query(f"""WITH b AS (SELECT c_custkey, c_custkey % 1500 AS company, CASE WHEN c_custkey % 1500 % 3 = 0 THEN -1 ELSE CAST(floor(c_custkey / 1500) AS BIGINT) % 2 END AS house FROM customer)
SELECT c_custkey AS row_idx, min(c_custkey) OVER (PARTITION BY company, house) AS cluster FROM b""")  # fmt: skip
def q_branch_clusters(spark, d):
    """Rows of one phone and name are one company, but for its branches at other houses."""
    return master.clustered(table(spark, d, "customer").selectExpr(*[f"{e} AS {n}" for n, e in BRANCHES.items()])).select("row_idx", "cluster")


#: Ten sites whose pages link to each other; every fourth page has an interesting path.
SITE = "concat('https://site', CAST(page_id % 10 AS STRING), '.ru')"
PATH = "CASE WHEN {0} = 0 THEN '/' WHEN {0} % 4 = 1 THEN concat('/about/', CAST({0} AS STRING)) ELSE concat('/p/', CAST({0} AS STRING)) END"


@query()
def q_crawl(spark, d):
    """The pages that a crawl of ten sites visits, by site in order; a queue has no SQL twin."""
    k = "CAST(floor(page_id / 10) AS BIGINT)"
    anchors = [f"""concat('<a href="', {PATH.format(f'({target})')}, '">x</a>')""" for target in (f"{k} * 2 + 1", f"{k} * 2 + 2", f"{k} * 3 + 1", f"({k} + 7) % 25")]
    pages = table(spark, d, "pages").selectExpr(f"{SITE} AS origin", f"concat({SITE}, {PATH.format(k)}) AS url", f"concat(html, {', '.join(anchors)}) AS html")
    return crawl.crawl(crawl.first_queues(pages), crawl.captured(pages)).select("origin", "place", "url", F.col("html").isNotNull().alias("found"))

"""Queries over what pages, sitemaps and cards say, each with its SQL twin. Texts are the tables' own, with derived parts
that the rules are about."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.functions import contact, text, web
from entityspark.operators import crawl, details
from entityspark.plans.business import pick
from entityspark.plans.catalogue import HOST, query, table


def derived(spark, d, name: str, key: str, **columns: str) -> DataFrame:
    """A key of a table, and columns of it by expressions that Spark and DuckDB read alike."""
    return table(spark, d, name).selectExpr(key, *[f"{e} AS {n}" for n, e in columns.items()])


def derived_sql(name: str, key: str, **columns: str) -> str:
    return f"SELECT {key}, " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM {name}"


def listed(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


#: Mail addresses of a page in its own words: blocked, foreign, the site's own, with and without a beginning of companies.
MAILS = {"host": "concat('firm', CAST(page_id % 30 AS STRING), '.ru')", "body": "concat(html, ' Zakaz.new@firm', CAST(page_id % 20 AS STRING), '.ru noreply@firm1.ru info@mail.ru, ivan', CAST(page_id % 9 AS STRING), '@shop.firm', CAST(page_id % 30 AS STRING), '.ru; Info@mail.ru; info@firm', CAST(page_id % 7 AS STRING), '.ru')"}
SCORE = f"""CASE WHEN len(list_filter({listed(contact.EMAIL_BLOCKS)}, lambda b: contains(lower(e), b))) > 0 THEN -1 ELSE
  CASE WHEN host <> '' AND (split_part(lower(e), '@', 2) = host OR ends_with(split_part(lower(e), '@', 2), '.' || host) OR ends_with(host, '.' || split_part(lower(e), '@', 2))) THEN 100 ELSE 0 END
  + coalesce(50 - list_position(list_transform({listed(contact.SITE_PREFIXES)}, lambda p: split_part(lower(e), '@', 1) = p OR starts_with(split_part(lower(e), '@', 1), p || '.')), true) + 1, 0) END"""


@query(f"""WITH p AS ({derived_sql('pages', 'page_id', **MAILS)}), m AS (SELECT page_id, host, unnest(list_distinct(regexp_extract_all(body, '{contact.EMAIL}'))) AS e FROM p),
s AS (SELECT page_id, e, {SCORE} AS s FROM m) SELECT p.page_id, coalesce(string_agg(e, ' ' ORDER BY s DESC, lower(e), e), '') AS emails FROM p LEFT JOIN s ON s.page_id = p.page_id AND s >= 0 GROUP BY p.page_id""")
def q_ranked_emails(spark, d):
    """The addresses of a page, the best first."""
    p = derived(spark, d, "pages", "page_id", **MAILS)
    return p.select("page_id", F.array_join(contact.ranked_emails(F.col("body"), F.col("host")), " ").alias("emails"))


CALLS = {"body": "concat(text, ' 8 (978) ', lpad(CAST(doc_id % 900 AS STRING), 3, '1'), '-22-33; +7978', lpad(CAST(doc_id % 900 AS STRING), 3, '1'), '2233, 8-365-200-10-', lpad(CAST(doc_id % 90 AS STRING), 2, '0'), ' 12-34')"}


@query(f"""WITH p AS ({derived_sql('documents', 'doc_id', **CALLS)}), m AS (SELECT doc_id, list_transform(regexp_extract_all(body, '{contact.PHONE}'), lambda x: regexp_replace(x, '[^0-9]', '', 'g')[2:]) AS a FROM p),
u AS (SELECT doc_id, list_transform(list_filter(a, lambda x, i: list_position(a, x) = i), lambda x: '+7 (' || x[1:3] || ') ' || x[4:6] || '-' || x[7:8] || '-' || x[9:10]) AS a FROM m) SELECT doc_id, array_to_string(a, '|') AS phones FROM u WHERE len(a) > 0""")
def q_found_phones(spark, d):
    """The phones of a text in their written form, each once, in order."""
    found = derived(spark, d, "documents", "doc_id", **CALLS).select("doc_id", F.array_join(contact.found_phones(F.col("body")), "|").alias("phones"))
    return found.filter("phones <> ''")


SPELLED = ["Пишите: sales [at] firm [dot] ru", "office(собака)firm(точка)com сегодня", "a.b+c [ @ ] shop . ru", "info [AT] sub.firm [Dot] org, x [at] y [dot] zz", "нет адреса", "x[at]firm.ru"]


@query(rf"""WITH p AS (SELECT page_id, {pick('page_id', SPELLED)} AS t FROM pages), f AS (SELECT page_id, regexp_extract(t, '(?i)([a-z0-9._%+\-]+\s*[\[(]\s*(?:at|собака|@)\s*[\])]\s*[a-z0-9.\-]+\s*[\[(]\s*(?:dot|точка|\.)\s*[\])]\s*[a-z]{{2,}})', 1) AS m FROM p)
SELECT page_id, regexp_replace(regexp_replace(m, '(?i)\s*[\[(]\s*(?:at|собака|@)\s*[\])]\s*', '@'), '(?i)\s*[\[(]\s*(?:dot|точка|\.)\s*[\])]\s*', '.') AS email FROM f""")
def q_spelled_email(spark, d):
    """Addresses written with words in brackets."""
    return table(spark, d, "pages").selectExpr("page_id", f"{pick('page_id', SPELLED)} AS t").select("page_id", contact.spelled_email(F.col("t")).alias("email"))


CODES = {"code": "substring(md5(CAST(page_id AS STRING)), 1, CAST(page_id % 12 AS INT) * 2)"}


@query("""WITH p AS (SELECT page_id, substring(md5(CAST(page_id AS STRING)), 1, CAST(page_id % 12 AS INT) * 2) AS code FROM pages)
SELECT page_id, array_to_string(list_transform(range(3, len(code), 2), lambda k: CAST(xor(CAST('0x' || code[k:k + 1] AS INTEGER), CAST('0x' || code[1:2] AS INTEGER)) AS VARCHAR)), ',') AS bytes FROM p""")
def q_hidden_email(spark, d):
    """The characters that hidden addresses stand for."""
    shown = contact.hidden_email(F.col("code"))
    return derived(spark, d, "pages", "page_id", **CODES).select("page_id", F.when(F.length("code") < 4, "").otherwise(F.array_join(F.transform(F.split(shown, ""), lambda c: F.ascii(c).cast("string")), ",")).alias("bytes"))


CARDS = ["https://yandex.ru/maps/org/kafe/{k}/reviews", "/org/{k}?x=1", "/maps/org/12345/", "https://y.ru/{k}9#top", "no id", "/a/b{k}/"]
CARD_PHONES = ["8 978 111-22-33", "12-34-56", "123-45-67", "+7(365)2001122", "телефон", ""]


@query(f"WITH p AS (SELECT p_partkey, replace({pick('p_partkey', CARDS)}, '{{k}}', CAST(100000 + p_partkey AS STRING)) AS u, {pick('p_partkey', CARD_PHONES)} AS t FROM part), " + """g AS (SELECT *, regexp_replace(t, '[^0-9]', '', 'g') AS dg FROM p)
SELECT p_partkey, regexp_extract(u, '/([0-9]{6,})(?:[/?#]|$)', 1) AS org_id, CASE WHEN length(dg) < 7 THEN '' WHEN length(dg) = 11 THEN '+7 (' || dg[2:4] || ') ' || dg[5:7] || '-' || dg[8:9] || '-' || dg[10:11] ELSE trim(t) END AS phone FROM g""")
def q_card_fields(spark, d):
    """The id and phone of map cards."""
    c = table(spark, d, "part").selectExpr("p_partkey", f"replace({pick('p_partkey', CARDS)}, '{{k}}', CAST(100000 + p_partkey AS STRING)) AS u", f"{pick('p_partkey', CARD_PHONES)} AS t")
    return c.select("p_partkey", web.org_id(F.col("u")).alias("org_id"), contact.card_phone(F.col("t")).alias("phone"))


MAPS = ["https://a.ru/contacts", "https://a.ru/x", "https://a.ru/about?a=1&amp;b=2", "https://a.ru/Kontakty/", "https://a.ru/price", "https://a.ru/feedback", "https://a.ru/o/obratnaya-svyaz"]
SITEMAP = "concat('<urlset>', " + ", ".join(f"'<url><{p}loc> ', {pick(f'(page_id + {k})', MAPS, s)}, ' </{p}loc></url>'" for k, (p, s) in enumerate([("", 1), ("ns:", 2), ("", 3), ("", 5), ("", 7), ("", 11), ("", 13)])) + ", '</urlset>')"


@query(f"""WITH p AS (SELECT page_id, {SITEMAP} AS xml FROM pages), m AS (SELECT page_id, list_transform(regexp_extract_all(xml, '(?is)<(?:\\w+:)?loc>\\s*(.*?)\\s*</(?:\\w+:)?loc>', 1), lambda u: replace(u, '&amp;', '&')) AS u FROM p)
SELECT page_id, array_to_string(list_filter(u, lambda x: len(list_filter({listed(web.SITEMAP_HINTS)}, lambda h: contains(lower(x), h))) > 0)[1:5], ' ') AS links FROM m""")
def q_sitemap_links(spark, d):
    """The addresses of a sitemap that tell of contacts, five at most."""
    return derived(spark, d, "pages", "page_id", xml=SITEMAP).select("page_id", F.array_join(web.sitemap_links(F.col("xml")), " ").alias("links"))


SOCIAL = ["https://vk.com/firm?w=1", "https://VK.com/firm/", "http://t.me/firm", "https://vk.com/share.php?u=1", "https://firm.ru/vk", "https://www.ok.ru/group/5", "https://www.facebook.com/sharer/x", "https://wa.me/79780000000"]
ANCHORS = "concat(html, " + ", ".join(f"""'<a class="s" href="', {pick(f'(page_id + {k})', SOCIAL, s)}, '">x</a>'""" for k, s in ((0, 1), (3, 2), (5, 3), (1, 5))) + ")"


@query(f"""WITH p AS (SELECT page_id, {ANCHORS} AS html FROM pages), l AS (SELECT page_id, list_transform(list_filter(regexp_extract_all(html, '<a\\b[^>]*?href=["''](http[^"'']*)["'']', 1),
  lambda u: len(list_filter({listed(web.PROFILE_HOSTS)}, lambda h: contains(regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1)), '^www\\.', ''), h))) > 0 AND len(list_filter({listed(web.SHARE_PARTS)}, lambda s: contains(lower(u), s))) = 0), lambda u: split_part(u, '?', 1)) AS u FROM p),
k AS (SELECT page_id, u, list_transform(u, lambda x: regexp_replace(lower(x), '/+$', '')) AS k FROM l)
SELECT page_id, array_to_string(list_filter(u, lambda x, i: list_position(k, k[i]) = i), ' ') AS profiles FROM k""")
def q_profiles(spark, d):
    """The profiles on social networks that a page links to, each once."""
    return derived(spark, d, "pages", "page_id", html=ANCHORS).select("page_id", F.array_join(web.profiles(F.col("html")), " ").alias("profiles"))


PATHS = ["https://firm.ru/contacts", "https://firm.ru/shop?next=/contact", "http://user@firm.ru/about", "https://localhost/price", "https://10.0.0.1/uslugi", "ftp://firm.ru/contact", "https://firm.ru/Прайс-лист", "https://firm.ru/a b", "https://x.localhost/", "HTTPS://Firm.ru/Location#x", ""]


@query(f"WITH p AS (SELECT page_id, {pick('page_id', PATHS)} AS u FROM pages), " + r"""h AS (SELECT page_id, u, lower(regexp_replace(regexp_extract(u, '^https?://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)', 1), '\.+$', '')) AS h FROM p)
SELECT page_id, regexp_matches(regexp_extract(u, '^[^:]+://[^/?#]*([^?#]*)', 1), '(?i)/(contacts?|about|partner|filial|location|services?|uslugi|price|objects?|услуги|прайс|контакт|о-нас|о_нас|о-компании|объект|филиал)') AS interesting,
  regexp_matches(u, '^(?i)https?://') AND NOT regexp_matches(u, '[\x00-\x20\x7f]') AND NOT regexp_matches(u, '^[^:]+://[^/?#]*@') AND h <> '' AND NOT regexp_matches(h, '^(?:0x[0-9a-f]+|[0-9]+)(?:\.(?:0x[0-9a-f]+|[0-9]+))*$') AND NOT starts_with(h, '[')
  AND h NOT IN ('localhost', 'localhost.localdomain', 'ip6-localhost') AND NOT ends_with(h, '.localhost') AS safe FROM h""")
def q_page_paths(spark, d):
    """Paths that come first, and addresses that may be visited."""
    p = table(spark, d, "pages").selectExpr("page_id", f"{pick('page_id', PATHS)} AS u")
    return p.select("page_id", crawl.is_interesting(F.col("u")).alias("interesting"), crawl.is_safe(F.col("u")).alias("safe"))


TITLES = ["Салон «Лотос»", "Контакты", "www.firm.ru", "firm.ru", "Бар", "о нас", "firm-2.com", "Мотор  Сервис", ""]


@query(f"""WITH p AS (SELECT page_id, {pick('page_id', TITLES)} AS t, {HOST.format('url')} AS host FROM pages), n AS (SELECT page_id, host, trim(regexp_replace(translate(lower(t), 'ё', 'е'), '\\s+', ' ', 'g')) AS n FROM p)
SELECT page_id, length(n) >= 4 AND n NOT IN ('главная', 'контакты', 'о нас', 'о компании', 'услуги', 'цены', 'прайс', 'home', 'contacts', 'about', 'index') AND regexp_replace(n, '^www\\.', '') <> host AND NOT regexp_matches(n, '^[a-z0-9-]+(?:\\.[a-z0-9-]+)+$') AS named FROM n""")
def q_real_names(spark, d):
    """Titles that name something."""
    p = table(spark, d, "pages").selectExpr("page_id", "url", f"{pick('page_id', TITLES)} AS t")
    return p.select("page_id", crawl.is_real_name(F.col("t"), web.host_of(F.col("url"))).alias("named"))


CELLS = {"cell": "CASE p_partkey % 6 WHEN 0 THEN concat('''=', p_name) WHEN 1 THEN concat(''' +', p_name) WHEN 2 THEN concat('''', p_name) WHEN 3 THEN concat('=', p_name) WHEN 4 THEN '' ELSE p_name END"}


@query("WITH p AS (" + derived_sql("part", "p_partkey", **CELLS) + r") SELECT p_partkey, CASE WHEN regexp_matches(cell, '^''\s*[=+\-@]') THEN cell[2:] ELSE cell END AS restored, CASE WHEN length(cell) > 12 THEN cell[1:11] || '…' ELSE cell END AS short FROM p")
def q_restored_cells(spark, d):
    """Cells as they were before an export made them safe, and shortened ones."""
    p = derived(spark, d, "part", "p_partkey", **CELLS)
    return p.select("p_partkey", text.restored_cell(F.col("cell")).alias("restored"), text.shortened(F.col("cell"), 12).alias("short"))


ANSWERS = ["ok", "ok", "empty", "ok", "timeout", "ok", "ok", "ok", "markup_error", "ok", "strange", "ok", "blocked at last"]


@query(f"""WITH c AS (SELECT event_id, event_id % 4000 AS org_id, ts FROM events), f AS (SELECT org_id, row_number() OVER (ORDER BY min(ts), min(event_id)) AS seq FROM (SELECT *, row_number() OVER (PARTITION BY org_id ORDER BY ts, event_id) AS n FROM c) WHERE n = 1 GROUP BY org_id),
a AS (SELECT org_id, seq, CASE WHEN t IN ('ok', 'empty', 'timeout', 'markup_error') THEN t ELSE 'navigation_error' END AS t FROM (SELECT *, {pick('org_id', ANSWERS)} AS t FROM f)),
s AS (SELECT event_id, CASE WHEN seq <= 700 THEN t WHEN seq = 701 AND row_number() OVER (PARTITION BY org_id ORDER BY ts, event_id) = 1 THEN 'detail_budget_exhausted' ELSE 'circuit_open' END AS status FROM c JOIN a USING (org_id))
SELECT event_id, status, CASE status WHEN 'ok' THEN '0.95' WHEN 'empty' THEN '0.85' WHEN 'timeout' THEN '0.65' WHEN 'navigation_error' THEN '0.60' WHEN 'markup_error' THEN '0.55' ELSE '0.50' END AS confidence,
  CASE status WHEN 'ok' THEN '' WHEN 'empty' THEN 'no_public_contacts' WHEN 'timeout' THEN 'detail_timeout|contact_unverified' WHEN 'navigation_error' THEN 'detail_navigation_error|contact_unverified' WHEN 'markup_error' THEN 'detail_markup_error|manual_review' ELSE 'contact_unverified|manual_review' END AS flags
FROM s""")
def q_card_details(spark, d):
    """Details of cards under a budget of 700 requests, with what their status is worth."""
    cards = table(spark, d, "events").select("event_id", (F.col("event_id") % 4000).alias("org_id"), "ts")
    answers = cards.select("org_id").distinct().selectExpr("org_id", f"{pick('org_id', ANSWERS)} AS status", "'' AS phone", "'' AS email", "'' AS website")
    return details.detailed(cards, answers, ["ts", "event_id"], 700).select("event_id", "status", "confidence", "flags")

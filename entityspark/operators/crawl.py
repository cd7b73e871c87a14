"""Crawling as sets: which pages come next, and what a visited page says about a company."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from entityspark.functions import contact, taxonomy, text, web
from entityspark.operators import golden
from entityspark.operators.lineage import cut

#: Fixed value: paths that are visited first.
INTERESTING = r"(?iu)/(contacts?|about|partner|filial|location|services?|uslugi|price|objects?|услуги|прайс|контакт|о-нас|о_нас|о-компании|объект|филиал)"
PAGES_A_DOMAIN, PAGES_IN_ALL = 15, 4000


def is_interesting(url: Column) -> Column:
    return F.regexp_extract(url, "^[^:]+://[^/?#]*([^?#]*)", 1).rlike(INTERESTING)


def is_safe(url: Column) -> Column:
    """A web address without credentials and control characters whose host is a public name, not a local one or a number."""
    u = text.blank(url)
    host = F.lower(F.regexp_replace(F.regexp_extract(u, r"^https?://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1), r"\.+$", ""))
    number = host.rlike(r"^(?:0x[0-9a-f]+|[0-9]+)(?:\.(?:0x[0-9a-f]+|[0-9]+))*$") | host.startswith("[")
    local = host.isin("localhost", "localhost.localdomain", "ip6-localhost") | host.endswith(".localhost")
    return u.rlike("(?i)^https?://") & ~u.rlike(r"[\x00-\x20\x7f]") & ~u.rlike("^[^:]+://[^/?#]*@") & (host != "") & ~number & ~local


def seeds(rows: DataFrame) -> DataFrame:
    """(origin) of the rows whose site may be visited: trusted ones, no social networks and platforms, safe addresses."""
    site = F.trim(text.blank(F.col("website")))
    start = web.origin(site)
    return rows.filter(golden.may_seed() & (start != "") & ~web.is_foreign_site(site) & is_safe(start)).select(start.alias("origin")).distinct()


def next_pages(visited: DataFrame, most: int = PAGES_A_DOMAIN, in_all: int = PAGES_IN_ALL) -> DataFrame:
    """(origin, url, place): the links of visited pages (origin, url, html) that come next. They stay on their site, interesting
    paths first, at most ``most`` pages a site with those visited, and ``in_all`` in all."""
    found = visited.select("origin", F.col("url").alias("page"), F.explode(web.links(F.col("html"))).alias("href")).select("origin", web.absolute(F.col("page"), F.col("href")).alias("url"))
    same = found.filter(is_safe(F.col("url")) & (web.net_location(F.col("url")) == web.net_location(F.col("origin")))).distinct()
    new = same.join(visited.select("url"), "url", "left_anti")
    seen = visited.groupBy("origin").agg(F.count("*").alias("seen"))
    order = W.partitionBy("origin").orderBy(is_interesting(F.col("url")).desc(), "url")
    ranked = new.join(seen, "origin").withColumn("place", F.row_number().over(order)).filter(F.col("place") + F.col("seen") <= most)
    return ranked.select("origin", "url", "place").orderBy("place", "origin", "url").limit(in_all)


def first_queues(origins: DataFrame, sitemaps: DataFrame | None = None) -> DataFrame:
    """(origin, queue): each site's start page and the pages of its sitemap (origin, urls), interesting ones first."""
    known = origins.select("origin").distinct()
    if sitemaps is None:
        urls = F.array().cast("array<string>")
    else:
        listed = sitemaps.groupBy("origin").agg(F.flatten(F.collect_list("urls")).alias("urls"))
        known, urls = known.join(listed, "origin", "left"), F.coalesce(F.filter("urls", lambda u: web.origin(u) == F.col("origin")), F.array().cast("array<string>"))
    all_ = F.concat(F.array(F.concat("origin", F.lit("/"))), urls)
    return known.select("origin", F.concat(F.filter(all_, is_interesting), F.filter(all_, lambda u: ~is_interesting(u))).alias("queue"))


def site_links(origin: Column, html: Column) -> Column:
    """The distinct links of a page that stay on its site, in order."""
    targets = F.filter(F.transform(web.links(html), lambda h: F.trim(h)), lambda h: ~h.rlike("(?i)^(?:javascript:|mailto:|tel:|#)") & (h != ""))
    whole = F.transform(targets, lambda h: F.substring_index(web.absolute(F.concat(origin, F.lit("/")), h), "#", 1))
    return F.array_distinct(F.filter(whole, lambda u: is_safe(u) & (web.origin(u) == origin)))


def crawl(queues: DataFrame, fetch: Callable[[DataFrame], DataFrame], most: int = PAGES_A_DOMAIN, in_all: int = PAGES_IN_ALL) -> DataFrame:
    """(origin, place, url, html) of the pages that a crawl visits, in the order of its visits; html is null where there is none.

    ``queues``: origin, queue (``first_queues``). ``fetch`` gets (origin, url) and returns them with html. Every round visits
    the next page of each site that has one, all sites at once, and adds its links: interesting ones to the front of the
    queue, others to its end while it is shorter than twice ``most``. A site ends after ``most`` pages or with its queue;
    the crawl ends with the last site or after ``in_all`` pages, where the last round takes the first sites by name. Each
    round is written before the next, so that no page is fetched twice. What a site holds is its queue and ``most`` pages.
    """
    state = cut(queues.select("origin", "queue", F.array().cast("array<string>").alias("visited")))
    rounds: list[DataFrame] = []
    total = 0
    for place in range(1, most + 1):
        fresh = F.filter("queue", lambda u: ~F.array_contains("visited", u))
        head = state.withColumn("url", F.get(fresh, F.lit(0))).filter("url IS NOT NULL")
        # Only what stands before the visited page leaves the queue with it.
        head = head.withColumn("queue", F.slice("queue", F.array_position("queue", F.col("url")).cast("int") + 1, F.greatest(F.size("queue"), F.lit(1))))
        head = cut(head.orderBy("origin").limit(in_all - total)) if in_all else cut(head)
        n = head.count()
        if not n:
            break
        total += n
        pages = cut(fetch(head.select("origin", "url")).select("origin", "url", "html"))
        rounds.append(pages.select("origin", F.lit(place).alias("place"), "url", "html"))
        if (in_all and total >= in_all) or place == most:
            break
        seen = F.array_append("visited", F.col("url"))
        joined = head.join(pages.select("origin", "html"), "origin").withColumn("visited", seen).withColumn("new", site_links(F.col("origin"), F.col("html")))

        def add(queue: Column, link: Column) -> Column:
            known = F.array_contains(queue, link) | F.array_contains(F.col("visited"), link)
            return F.when(known, queue).when(is_interesting(link), F.array_prepend(queue, link)).when(F.size(queue) < 2 * most, F.array_append(queue, link)).otherwise(queue)

        state = cut(joined.select("origin", F.aggregate(F.coalesce("new", F.array().cast("array<string>")), F.col("queue"), add).alias("queue"), "visited"))
    empty = queues.select("origin", F.lit(0).alias("place"), F.lit("").alias("url"), F.lit("").alias("html")).limit(0)
    return reduce(DataFrame.unionByName, rounds, empty)


def captured(pages: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A ``fetch`` from captured pages (url, html); of several captures of a page the greatest html counts."""
    known = pages.groupBy("url").agg(F.max("html").alias("html"))
    return lambda asked: asked.join(known, "url", "left").select("origin", "url", "html")


def is_real_name(name: Column, host: Column) -> Column:
    """A page's title that names something: four characters or more, no menu word, not the host itself."""
    n = text.fold(name)
    menu = ["главная", "контакты", "о нас", "о компании", "услуги", "цены", "прайс", "home", "contacts", "about", "index"]
    return (F.length(n) >= 4) & ~n.isin(menu) & (F.regexp_replace(n, r"^www\.", "") != host) & ~n.rlike(r"^[a-z0-9-]+(?:\.[a-z0-9-]+)+$")


def companies(visited: DataFrame) -> DataFrame:
    """Observations from visited pages (origin, url, html) that tell of a segment: name, contacts, address, segment."""
    host = web.host_of(F.col("origin"))
    plain = web.plain_text(F.col("html"))
    name = web.title(F.col("html"))
    rows = visited.withColumns({"name": name, "host": host}).filter(taxonomy.mentions_alias(plain) & is_real_name(F.col("name"), F.col("host")))
    mails, phones = contact.ranked_emails(F.col("html"), F.col("host")), contact.found_phones(F.col("html"))
    address = F.coalesce(F.nullif(web.linked_address(F.col("html")), F.lit("")), web.text_address(plain))
    first = lambda a: F.coalesce(F.get(a, F.lit(0)), F.lit(""))
    return rows.select(
        F.lit("Crawler").alias("source"), F.col("url").alias("source_url"), "name", first(mails).alias("email"), F.array_join(mails, " | ").alias("all_emails"), first(phones).alias("phone"), F.array_join(phones, " | ").alias("all_phones"),
        F.col("origin").alias("website"), address.alias("address"), taxonomy.segment_of(F.concat_ws(" ", "name", plain)).alias("category"),
    )


def result_links(html: Column) -> Column:
    """The targets of a search's result page, in order: shown addresses, then all links."""
    shown = F.transform(F.regexp_extract_all(text.blank(html), F.lit(r"(?is)class=[\"'][^\"']*result__url[^\"']*[\"'][^>]*>\s*([^<\s]+)"), F.lit(1)), lambda u: F.when(u.startswith("http"), u).otherwise(F.concat(F.lit("https://"), u)))
    return F.transform(F.concat(shown, F.regexp_extract_all(text.blank(html), F.lit(r"href=[\"'](https://[^\"']+)[\"']"), F.lit(1))), web.unescaped)


def found_site(html: Column, own: str = "duckduckgo.com") -> Column:
    """The first safe result that is a company's own site; empty for none."""
    fits = lambda u: is_safe(u) & ~web.is_foreign_site(u) & ~web.in_hosts(web.host_of(u), [own])
    return F.coalesce(F.get(F.filter(result_links(html), fits), F.lit(0)), F.lit(""))

"""A crawl against one queue a site."""

import re
from urllib.parse import urljoin

import pytest

from entityspark.operators import crawl
from entityspark.plans import business

HOT = re.compile(crawl.INTERESTING.replace("(?iu)", "(?i)"))


def queue_crawl(origins, pages, sitemaps, most, in_all):
    """All sites a page at a time, in the order of their names."""
    state = {o: (sorted([o + "/", *[u for u in sitemaps.get(o, []) if u.startswith(o + "/")]], key=lambda u: not HOT.search(u)), []) for o in sorted(origins)}
    visits, total = [], 0
    for place in range(1, most + 1):
        for o, (queue, seen) in state.items():
            while queue and queue[0] in seen:
                queue.pop(0)
            if not queue or in_all and total >= in_all:
                continue
            url = queue.pop(0)
            seen.append(url)
            total += 1
            html = pages.get(url)
            visits.append((o, place, url, html))
            for href in dict.fromkeys(re.findall('href="([^"#]+)', html or "")):
                link = urljoin(o + "/", href)
                if not link.startswith(o + "/") or link in seen or link in queue:
                    continue
                if HOT.search(link):
                    queue.insert(0, link)
                elif len(queue) < 2 * most:
                    queue.append(link)
    return visits


def site(n):
    o = f"https://s{n}.ru"
    page = lambda k: o + ("/" if k == 0 else f"/contact/{k}" if k % 5 == 0 else f"/p/{k}")
    links = lambda k: [page(k * 2 + 1), f"/p/{k + 3}", page(k + n), f"/contact/{k * 5 + 5}", "https://other.ru/x", "mailto:a@b.ru", page(k)]
    return o, {page(k): "".join(f'<a href="{u}">x</a>' for u in links(k)) for k in range(12 * n)}


@pytest.mark.parametrize("most,in_all", [(6, 0), (5, 13), (3, 2)])
def test_crawl_visits_in_the_order_of_a_queue(spark, most, in_all):
    sites = dict(site(n) for n in (1, 2, 3, 4))
    sites["https://none.ru"] = {}
    pages = {u: h for own in sites.values() for u, h in own.items()}
    sitemaps = {"https://s2.ru": ["https://s2.ru/p/9", "https://s2.ru/services", "https://x.ru/", "https://s2.ru/"]}
    queues = crawl.first_queues(spark.createDataFrame([(o,) for o in sites], "origin string"), spark.createDataFrame(list(sitemaps.items()), "origin string, urls array<string>"))
    found = crawl.crawl(queues, crawl.captured(spark.createDataFrame(list(pages.items()), "url string, html string")), most, in_all)
    assert sorted(tuple(r) for r in found.collect() if r["html"] is not None or True) == sorted(queue_crawl(sites, pages, sitemaps, most, in_all), key=lambda v: v[:3])


def test_crawl_of_nothing(spark):
    none = spark.createDataFrame([], "origin string")
    assert crawl.crawl(crawl.first_queues(none), crawl.captured(spark.createDataFrame([], "url string, html string"))).collect() == []


def test_crawl_of_the_pages_table(spark):
    rows = business.q_crawl(spark, "/root/testdata/sf0.001").collect()
    assert {r["place"] for r in rows if r["origin"] == "https://site0.ru"} == set(range(1, len([r for r in rows if r["origin"] == "https://site0.ru"]) + 1)) and len(rows) > 30

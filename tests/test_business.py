"""Rules of companies on small tables, against expected values and brute-force versions."""

import csv
import json
import zipfile
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from entityspark.functions import contact, taxonomy, web
from entityspark.operators import enrich, golden, identity, master, outreach, resolve, signals
from entityspark.sources import readers, sinks


def one(spark, of, values):
    rows = [(k, *(v if isinstance(v, tuple) else (v,))) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k int, " + ", ".join(f"c{i} string" for i in range(len(rows[0]) - 1)))
    return [r["x"] for r in df.select("k", of(*[F.col(f"c{i}") for i in range(len(rows[0]) - 1)]).alias("x")).orderBy("k").collect()]


CASES = [
    ("%20zakaz@firm.ru", "firm.ru", "zakaz@firm.ru", "repaired"), ("a@ozon.ru", "", None, "platform_or_authority"), ("a@best-slots.ru", "", None, "spam_domain"), ("graqre@gx-xvg.pbz", "", "tender@tk-kit.com", "rot13_decoded"),
    ("vasb@svezn.eh", "firma.ru", "info@firma.ru", "rot13_decoded"), ("info@firma.com.tr", "firma.com.tr", "info@firma.com.tr", ""), ("<Info@Firm.RU>", "firm.ru", "info@firm.ru", ""), ("info@mail.ru", "", None, "provider_service_address"),
    ("ivan@maail.ru", "", None, "provider_typo"), ("a@maail.ru", "maail.ru", "a@maail.ru", ""), ("x@corp.mail.ru", "", None, "provider_subdomain"), ("a" * 65 + "@firm.ru", "", None, "invalid_syntax"), ("a@-firm.ru", "", None, "invalid_syntax"),
    ("logo@2x.png", "", None, "invalid_tld"), ("a@firm.x1", "", None, "invalid_tld"), ("0123456789abcdef0123456789abcdef@firm.ru", "", None, "hex_token"), ("a@my.example.ru", "", None, "placeholder"), ("q@casino-x.ru", "casino-x.ru", "q@casino-x.ru", ""),
    ("инфо@сайт.рф", "xn--80aswg.xn--p1ai", "инфо@сайт.рф", ""), ("a+b@firm.ru", "", "a+b@firm.ru", ""), ("100%@firm.ru", "", "100%@firm.ru", ""), (None, "", None, "invalid_syntax"),
]


def test_every_gate(spark):
    found = one(spark, contact.cleaned_email, [(raw, host) for raw, host, *_ in CASES])
    assert [(x["email"], x["note"]) for x in found] == [(e, n) for *_, e, n in CASES]


def test_hosts_in_punycode(spark):
    hosts = ["xn--80aswg.xn--p1ai", "www.Xn--80adxhks.RU.", "xn--mnchen-3ya.de", "xn--!!.ru", "xn--fiqs8s", "a.ru", "", None]
    assert one(spark, web.unicode_host, hosts) == ["сайт.рф", "москва.ru", "münchen.de", "xn--!!.ru", "中国", "a.ru", "", ""]
    names = ["ёлка", "пример", "bücher", "日本語", "ελλάδα", "a-б-c"]
    labels = ["xn--" + n.encode("punycode").decode() for n in names]
    assert one(spark, web.unicode_host, labels) == names


def test_second_levels_and_kin(spark):
    assert one(spark, contact.second_level, ["firm.msk.ru", "a.firm.ru", "firm.ru", "firm"]) == ["firm", "firm", "firm", "firm"]
    assert one(spark, contact.related, [("shop.firm.ru", "firm.ru"), ("firm.com", "firm.ru"), ("lotossalon.ru", "lotos.ru"), ("abc.ru", "xyz.ru"), ("", "firm.ru")]) == [True, True, True, False, False]


PAGE = """<html><a href="/Kontakty.html#x">К</a><a href='../about/'>o</a><a href="https://other.ru/contact">x</a><a href="mailto:a@b.ru">m</a><a href="p?x=1">Как нас найти</a><a href="/shop">s</a>
<script type="application/ld+json">{"@type":"Organization","email":"q@firm.ru","telephone":"8 978 123-45-67","address":{"@type":"PostalAddress","streetAddress":"ул. Ленина, 5","addressLocality":"Ялта"}}</script>
<a href="https://vk.com/firm?w=1">vk</a><a href="https://vk.com/share.php?u=1">s</a><a href="http://t.me/firm/">t</a><a href="http://t.me/firm">t</a> sales [at] firm [dot] ru +7 (978) 111-22-33, 8-978-111-22-33
<span data-cfemail="%s"></span> noreply@firm.ru info&#64;firm.ru""" % ("5a" + "".join(f"{ord(c) ^ 0x5A:02x}" for c in "boss@firm.ru"))


def test_pages(spark):
    u = "https://www.firm.ru/dir/page.html"
    links = one(spark, web.contact_links, [(PAGE, u)])[0]
    assert links == ["https://www.firm.ru/Kontakty.html", "https://www.firm.ru/about/", "https://www.firm.ru/dir/p?x=1"]
    assert one(spark, lambda h: web.linked_value(h, "email"), [PAGE, "<p>"]) == ["q@firm.ru", ""] and one(spark, web.linked_address, [PAGE]) == ["Ялта, ул. Ленина, 5"]
    assert one(spark, web.profiles, [PAGE]) == [["https://vk.com/firm", "http://t.me/firm/"]]
    c = one(spark, enrich.page_contacts, [(PAGE, "firm.ru"), ("", "firm.ru"), (None, "")])
    assert c[0]["phones"] == ["+7 (978) 123-45-67", "+7 (978) 111-22-33"] and c[0]["emails"][0] == "info@firm.ru" and set(c[0]["emails"]) == {"info@firm.ru", "sales@firm.ru", "q@firm.ru", "boss@firm.ru", "a@b.ru"} and c[1]["emails"] == [] == c[2]["emails"]
    assert one(spark, web.text_address, ["офис: г. Ялта, ул. Морская, 5, этаж 2", "нет"]) == ["г. Ялта, ул. Морская, 5, этаж 2", ""]
    assert one(spark, web.sitemap_links, ["<urlset><url><loc>https://a.ru/contacts</loc></url><url><loc>https://a.ru/x</loc></url><url><loc> https://a.ru/about?a=1&amp;b </loc></url></urlset>"]) == [["https://a.ru/contacts", "https://a.ru/about?a=1&b"]]
    assert one(spark, web.is_parked, ["Домен продаётся", "this domain is for sale", "shop", None]) == [True, True, False, False]


def test_absolute_links_match_the_library(spark):
    from urllib.parse import urljoin

    base = "https://a.ru/x/y/z.html?q=1"
    hrefs = ["p", "/p", "../p", "../../p", "./p", "//b.ru/p", "https://c.ru/", "?w=2", "a/b/../c", "p#f", "", "/../p"]
    assert one(spark, web.absolute, [(base, h) for h in hrefs]) == [urljoin(base, h).split("#")[0] for h in hrefs]


def test_exclusions_and_segments(spark):
    names = ["СберЛизинг", "Пудра", "Магнит косметик", "Кафе Уют", "ГАУЗРК Больница", "Школа № 5", "Школа танцев", "МБОУ", "Судак", "Суд", "Отель", "Барбершоп", None]
    gov, chain, other = ["excluded_gov"], ["excluded_chain"], ["excluded_other_base_type"]
    assert one(spark, lambda n: taxonomy.exclusion_flags(n, F.lit("")), names) == [chain, [], chain, other, gov, gov, [], gov, [], gov, other, [], []]
    assert one(spark, taxonomy.segment_of, ["avto", "Строительство и ремонт", "Ремонт обуви", "Дизайн интерьеров", "?", None]) == ["avto", "stroitelstvo", "klining_uslugi", "mebel", "прочее", "прочее"]
    assert len(taxonomy.TITLES) == 20 and len(taxonomy.listed(taxonomy.ALIASES)) == 152 and 'nwr["craft"' in taxonomy.map_query("1,2,3,4")


def plain_clusters(rows):
    """Union-find over all pairs in order, each union checked against all members."""
    def norm(v):
        return " ".join("".join(c if c.isalnum() or c == "_" else " " for c in (v or "").lower()).split())

    def house(a):
        return next((w for w in reversed(a.split()) if w.isdigit()), "")

    def conflict(x, y):
        a, b = norm(x["address"]), norm(y["address"])
        return bool(a and b and a != b and house(a) and house(b) and house(a) != house(b))

    def same(x, y):
        s = SequenceMatcher(None, norm(x["name"]), norm(y["name"])).ratio()
        a, b = norm(x["address"]), norm(y["address"])
        if s < 0.62:
            return False
        like = 1.0 if a and a == b else SequenceMatcher(None, a, b).ratio() if a and b else 0.0
        if like == 1.0 and s >= 0.72:
            return True
        if conflict(x, y):
            return False
        return (like >= 0.88 and s >= 0.72) or bool(x["phone"] and x["phone"] == y["phone"] and s >= 0.72)

    groups = {r["row_idx"]: [r] for r in rows}
    for k, y in enumerate(rows):
        for x in rows[:k]:
            # only rows that share a key meet
            keys = lambda r: {("p", r["phone"]), ("a", norm(r["address"])), ("n", norm(r["name"]) + norm(r["city"]))} - {("p", ""), ("a", "")}
            if keys(x) & keys(y) and same(x, y):
                g, h = groups[x["row_idx"]], groups[y["row_idx"]]
                if g is not h and not any(conflict(m, n) for m in g for n in h):
                    g += h
                    for m in h:
                        groups[m["row_idx"]] = g
    return {k: min(m["row_idx"] for m in g) for k, g in groups.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_match_brute_force(spark, seed):
    import random

    rnd = random.Random(seed)
    names = ["салон лотос", "салон лотос плюс", "мотор сервис", "мотор", "юрист"]
    rows = [{"row_idx": k, "source": "OSM", "source_id": str(k), "name": rnd.choice(names), "city": "ялта", "address": rnd.choice(["", "", "мира 1", "мира 2", "мира 1 к", "ленина 7"]), "phone": rnd.choice(["", "79780000001", "79780000002"]), "website": "", "latitude": None, "longitude": None} for k in range(60)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "row_idx long, source string, source_id string, name string, city string, address string, phone string, website string, latitude string, longitude string")
    ready = resolve.prepared(df)
    found = {r["row_idx"]: r["cluster"] for r in resolve.clusters(ready, resolve.matches(ready, resolve.candidate_pairs(ready))).collect()}
    assert found == plain_clusters(rows)


def test_master_from_result_files(spark, tmp_path):
    header = ["source", "source_id", "name", "city", "address", "phone", "email", "website", "client_type", "quality_flags", "confidence", "parsed_at"]
    first = [["OSM", "1", "Салон Лотос", "Ялта", "ул. Мира, 1", "89781112233", "", "lotos.ru", "krasota", "", "0.95", "2026-01-01"], ["VK", "7", "Салон Лотос", "Ялта", "", "89781112233", "%20Info@lotos.ru", "", "krasota", "vk_no_own_website", "0.4", "2026-01-02"]]
    second = [["OSM", "1", "'=Салон Лотос", "Ялта", "ул. Мира, 1", "89781112233", "", "lotos.ru", "krasota", "", "0.90", "2026-02-01"], ["VK", "9", "Другие", "Ялта", "", "", "", "", "", "vk_noise_primary", "0.3", "2026-02-01"]]
    for name, rows in (("result_a.csv", first), ("result_b.csv", second), ("result_c.csv", [first[0]]), ("result_c_enriched.csv", second)):
        with open(tmp_path / name, "w", newline="", encoding="utf-8-sig") as f:
            csv.writer(f, delimiter=";", quoting=csv.QUOTE_ALL).writerows([header, *rows])
    assert [n.rsplit("/", 1)[-1] for n in readers.selected_files([("x/result_c.csv", 3.0), ("x/result_b.csv", 2.0), ("x/result_a.csv", 1.0), ("x/result_c_enriched.csv", 4.0)])] == ["result_a.csv", "result_b.csv", "result_c_enriched.csv"]
    files = readers.result_files(spark, str(tmp_path))
    whole, held = master.build(files)
    row, = whole.collect()
    assert row["name"] in ("Салон Лотос", "=Салон Лотос") and row["email"] == "info@lotos.ru" and row["all_emails"] == "info@lotos.ru" and row["confidence"] == "0.90" and row["first_seen"] == "2026-01-01" and row["last_seen"] == "2026-02-01"
    assert row["quality_flags"] == "manual_review|vk_weak_contact_donor|vk_weak_email_donor|vk_weak_observation_linked" and row["source_id"] == "1" and row["sources"] == "OSM|VK"
    told = json.loads(row["provenance"])
    assert len(told["observations"]) == 2 and {e["value"] for e in told["fields"]["phone"]} == {"89781112233"} and list(told) == sorted(told)
    assert [r["name"] for r in held.collect()] == ["Другие"]
    # A row that carries provenance is no new witness of what others gave.
    again = whole.withColumn("row_idx", F.lit(0)).withColumn("cluster", F.lit(0))
    gave = golden.evidence(again).filter("field = 'email'").collect()
    assert [(e["value"], e["source_id"]) for e in gave] == [("info@lotos.ru", "7")]


def test_outreach_and_sinks(spark, tmp_path):
    fields = ["row_idx", "name", "client_type", "city", "email", "all_emails", "website", "phone", "confidence", "quality_flags", "provenance", "entity_id", "source"]
    rows = [
        (0, "Лотос", "krasota", "Ялта", "zakaz@other.ru", "info@lotos.ru", "lotos.ru", "1", "0.9", "", '{"fields":{"client_type":[{"value":"medicina"}]}}', "e0", "OSM"),
        (1, "Мотор", "avto", "Саки", "ivan@mail.ru", "", "https://vk.com/x", "", "0.9", "manual_review", "", "e1", "OSM"), (2, "Мотор 2", "avto", "Саки", "ivan@mail.ru", "", "", "", "0.95", "", "", "e2", "OSM"),
        (3, "Код", "it_svyaz", "", "a@kod.ru", "", "", "", "0.9", "", "", "", ""), (4, "Сбербанк", "finansy", "", "a@x.ru", "", "", "", "0.9", "", "", "", ""), (5, "=Тур", "turizm", "Ялта", "b@tur.ru", "", "", "", "0.5", "", "", "", ""),
    ]
    m = spark.createDataFrame(rows, ", ".join(f"{f} {'long' if f == 'row_idx' else 'string'}" for f in fields))
    cache = spark.createDataFrame([("lotos.ru", ["outdated", "no_mobile"], "2026-10-01", "ok")], signals.CACHE)
    ready, review = outreach.outreach(m, cache)
    out = [r.asDict() for r in ready.collect()]
    assert [(r["Email"], r["Сигналы"], r["Повод для КП"], r["Все сегменты"]) for r in out] == [("ivan@mail.ru", "no_website", "Сайт с нуля", "Авто: СТО, автосалоны, запчасти"), ("info@lotos.ru", "no_mobile; outdated", "Адаптив/редизайн", "Красота: салоны, барбершопы; Медицина, стоматология")]
    assert {r["row_idx"]: r["review_reason"] for r in review.collect()} == {1: "duplicate_email", 3: "competitor_segment", 4: "excluded_chain", 5: "low_confidence"}
    other = outreach.bases(spark.createDataFrame([("x@lotos.ru", "https://lotos.ru")], "email string, website string"))
    assert {r["review_reason"] for r in outreach.outreach(m, cache, other)[1].filter("row_idx = 0").collect()} == {"already_in_other_base"}
    book, ready_csv, review_csv = (str(tmp_path / n) for n in ("r.xlsx", "outreach_ready.csv", "outreach_review.csv"))
    sinks.outreach_book(ready, book, outreach.WIDTHS, {"run_id": "1", "approved_for_send": False})
    with zipfile.ZipFile(book) as z:
        assert "info@lotos.ru" in z.read("xl/worksheets/sheet1.xml").decode() and 'name="Метаданные"' in z.read("xl/workbook.xml").decode()
    sinks.publish({ready_csv: ready, review_csv: review.select("row_idx", "name")})
    raw = open(review_csv, "rb").read()
    assert raw.startswith(b"\xef\xbb\xbf") and b"'=" in raw and sinks.count_rows(ready_csv) == 2
    with pytest.raises(OSError):  # the second file can't take its place: the first is as it was
        (tmp_path / "folder" / "x").mkdir(parents=True)
        sinks.publish({ready_csv: ready.limit(1), str(tmp_path / "folder"): ready})
    assert sinks.count_rows(ready_csv) == 2 and not list(tmp_path.glob("*.new")) and not list(tmp_path.glob("*.rollback"))
    sinks.result_csv(ready, ready_csv, append=True)
    assert sinks.count_rows(ready_csv) == 4
    told = sinks.handoff(str(tmp_path / "h"), "run 1/x", ready_csv, ready.columns, "2026-10-01", outreach={"ready_rows": 2, "ready_csv": ready_csv}, quarantine=review_csv)
    assert told["state"] == "ready_for_review" and told["run_id"] == "run-1-x" and told["row_count"] == 4 and told["outreach"]["ready_csv_sha256"] == told["sha256"] and told["quarantine"]["row_count"] == 4
    sinks.result_csv(ready, ready_csv)
    with pytest.raises(RuntimeError):
        sinks.handoff(str(tmp_path / "h"), "run 1/x", ready_csv, ready.columns, "2026-10-01")
    sinks.master_book(identity.complete(m).withColumn("row_idx", F.lit(1)), str(tmp_path / "m.xlsx"), ["name", "city"], m.groupBy("city").count())


def test_signals_queue_and_cache(spark):
    cache = spark.createDataFrame([("a.ru", ["outdated"], "2026-10-01 00:00:00", "ok"), ("b.ru", ["site_dead"], "2026-10-01 00:00:00", ""), ("c.ru", [], "bad", "ok")], signals.CACHE)
    sites = spark.createDataFrame([("a.ru", True, True), ("b.ru", False, False), ("c.ru", False, True), ("d.ru", False, True)], "host string, booking boolean, eligible boolean")
    old = signals.stale(sites, cache, "2026-10-20 00:00:00")
    assert [r["host"] for r in signals.batch(old, 2).collect()] == ["d.ru", "c.ru"] and {r["host"] for r in old.collect()} == {"b.ru", "c.ru", "d.ru"}
    assert tuple(signals.refresh_stats(sites, cache, "2026-10-20 00:00:00", 2).first()) == (4, 1, 2, 1)
    pages = spark.createDataFrame([("d.ru", True, "unreachable", "", "ok", "<meta name=viewport>"), ("b.ru", False, "error", "", "unstable", ""), ("e.ru", False, "ok", "parked domain", None, None), ("f.ru", False, "blocked", "", "ok", "x")], "host string, booking boolean, https string, https_html string, http string, http_html string")
    found = {r["host"]: (r["signals"], r["status"]) for r in signals.upserted(cache, signals.probed(pages, 2026, "now")).collect()}
    assert found["d.ru"] == (["no_https", "no_online_booking"], "ok") and found["b.ru"] == (["site_dead"], "dead") == found["e.ru"] and found["f.ru"] == ([], "blocked") and found["a.ru"][1] == "ok" and len(found) == 6
    dead = spark.createDataFrame([(f"h{k}", ["site_dead"], "", "dead" if k < 8 else "ok") for k in range(10)], signals.CACHE)
    assert signals.without_outage(dead).count() == 2 and signals.without_outage(dead.limit(9)).count() == 9


def test_enrichment(spark):
    rows = spark.createDataFrame([(0, "https://a.ru", "", "", "", ""), (1, "http://www.a.ru/x", "own@a.ru", "1", "", ""), (2, "vk.com/a", "", "", "", ""), (3, "", "", "", "", "https://vk.com/g")], "row_idx long, website string, email string, phone string, address string, social string")
    rows = rows.withColumns({c: F.lit("") for c in ("all_emails", "all_phones", "all_socials")})
    pages = spark.createDataFrame([("a.ru", 0, "ok", "<p>"), ("a.ru", 1, "ok", "info@a.ru +7 978 111-22-33"), ("a.ru", 2, "ok", "zzz@a.ru"), ("b.ru", 0, "unreachable", ""), ("c.ru", 0, "unstable", ""), ("d.ru", 0, "blocked", "")], "host string, page_no int, kind string, html string")
    visits = enrich.visited(pages)
    seen = {r["host"]: (r["kind"], r["emails"]) for r in visits.collect()}
    assert seen == {"a.ru": ("ok", ["info@a.ru"]), "b.ru": ("dead", []), "c.ru": ("unknown", []), "d.ru": ("blocked", [])}
    out = {r["row_idx"]: (r["email"], r["all_emails"], r["phone"]) for r in enrich.apply_visits(rows, visits).collect()}
    assert out == {0: ("info@a.ru", "info@a.ru", "+7 (978) 111-22-33"), 1: ("own@a.ru", "own@a.ru | info@a.ru", "1"), 2: ("", "", ""), 3: ("", "", "")}
    memory = enrich.remembered(spark.createDataFrame([], enrich.MEMORY), visits, "2026-10-01 00:00:00")
    assert {r["host"]: r["status"] for r in memory.collect()} == {"a.ru": "found", "b.ru": "dead"}
    later = {r["row_idx"]: (r["email"], r["pending"]) for r in enrich.apply_memory(rows, memory, "2026-10-20 00:00:00").collect()}
    assert later == {0: ("info@a.ru", False), 1: ("own@a.ru", False), 2: ("", True), 3: ("", True)}
    assert {r["row_idx"]: r["pending"] for r in enrich.apply_memory(rows, memory, "2027-01-20 00:00:00").collect()} == dict.fromkeys(range(4), True)
    assert {r["row_idx"]: r["place"] for r in enrich.visit_order(rows, email_only=False, site_finder=True).collect()} == {0: 0, 1: 1, 3: 2}
    social = spark.createDataFrame([("https://vk.com/g", "<script>x@y.ru</script> support@vk.com boss@firm.ru")], "social string, html string")
    assert enrich.apply_social(rows, social).filter("row_idx = 3").first()["email"] == "boss@firm.ru"
    found = spark.createDataFrame([("a.ru", "new@a.ru", "2", "Ялта", "s", "new@a.ru | x@a.ru", "", "s | t")], "host string, email string, phone string, address string, social string, all_emails string, all_phones string, all_socials string")
    b = enrich.apply_browser(rows, found).filter("row_idx = 1").first()
    assert (b["email"], b["address"], b["all_emails"], b["all_socials"]) == ("own@a.ru", "Ялта", "own@a.ru | new@a.ru | x@a.ru", "s | t")


def test_fresh_sightings(spark):
    items = spark.createDataFrame([("<b>Лотос</b> &amp; Ко", "OSM", "1", "89781112233", "A@firm.ru", "firm.ru", "Мебель", "44.5", None), ("", "OSM", "2", "", "", "", "", "", None), ("Сбербанк", "VK", "3", "", "", "", "финансовые услуги", "", "x|y")], "name string, source string, source_id string, phone string, email string, website string, category string, lat string, quality_flags string")
    a, b = identity.prepared(items).orderBy("source_id").collect()
    assert (a["name"], a["phone"], a["email"], a["all_phones"], a["client_type"], a["latitude"], a["sources"]) == ("Лотос & Ко", "+7 (978) 111-22-33", "a@firm.ru", "89781112233", "mebel", "44.5", "OSM")
    assert (b["client_type"], b["quality_flags"]) == ("finansy", "x|y|excluded_chain")


def test_groups(spark):
    s = spark.createDataFrame([(1, None), (2, 9), (3, 9), (4, None), (5, 9), (6, 9), (7, 9), (8, None)], "seq int, error_code int")
    assert [r["seq"] for r in readers.usable(s).orderBy("seq").collect()] == [1, 4]
    assert [r["seq"] for r in readers.usable(s.withColumn("error_code", F.when(F.col("seq") == 2, 5))).collect()] == [1]
    assert readers.search_matrix(spark).count() == 15 * len(taxonomy.group_queries()) and len(readers.map_queries(["Ялта", "Саки"], city_from=1, query_n=2)) == 2
    assert readers.steady_rounds(spark.createDataFrame([(k, n) for k, n in enumerate([5, 9, 9, 9, 9, 12])], "snapshot int, n int")).first()[0] == 4
    assert readers.run_result(3, 1) == (3, {}) and readers.run_result({"added": 2}, 1)[0] == 2 and readers.run_result(None, 7) == (7, {})


def test_run_control(tmp_path):
    from entityspark.plans import run

    env = tmp_path / ".env"
    env.write_text("# x\nexport A='1 # not a comment'\nB=2 # comment\nVK_TOKEN=secret-token\n", encoding="utf-8-sig")
    s = run.Settings(run.layered({"B": "9"}, str(env), str(tmp_path / "none"), {"A": "z", "C": "on", "MIN_RECORDS": "osm=3, vk=x"}))
    assert s.values["A"] == "1 # not a comment" and s.values["B"] == "9" and s.flag("C") and not s.flag("D") and s.number("B", 1) == 9 and s.minimums() == {"osm": 3}
    assert run.redacted("at secret-token!", s) == "at <redacted>!"
    tries = iter([OSError(), OSError(), b"x"])

    def fetch():
        if isinstance(x := next(tries), OSError):
            raise x
        return x

    waits = []
    assert run.retried(fetch, sleep=waits.append) == b"x" and waits == [1, 3]
    assert run.first_mirror(["a", "b"], lambda m, t: b"ok" if m == "b" else (_ for _ in ()).throw(OSError("down"))) == b"ok"
    with pytest.raises(RuntimeError):
        run.first_mirror(["a"], lambda m, t: (_ for _ in ()).throw(OSError("down")))
    p, rows = run.Progress(str(tmp_path / "progress.json")), []
    p.start()
    sources = [("osm", lambda limits: rows.extend([1, 2])), ("vk", lambda limits: {"added": 5}), ("crawler", lambda limits: 1 / 0)]
    failures = run.run_sources(sources, s, p, lambda: len(rows))
    assert len(failures) == 2 and "minimum for osm is 3" in failures[0] and p.read()["completed_sources"] == ["vk"] and p.open_sources(["osm", "vk"], True) == ["osm"]
    with run.one_run(str(tmp_path / "run.lock")), pytest.raises(BlockingIOError), run.one_run(str(tmp_path / "run.lock")):
        pass
    assert run.preflight(s, str(tmp_path / "new" / "out"), ["osm", "x"], ["osm", "vk"], 1) == (["unknown source: x"], [])
    assert run.summary_text(3, {"email": 1}, {"OSM": 2, "VK": 1}, {"Ялта": 2, "Саки": 1}).splitlines() == ["3 rows", "email: 1 (33 %)", "by source: OSM 2, VK 1", "cities: Ялта 2, Саки 1"]
    assert run.exit_code([]) == 0 and run.exit_code(["x"]) == 1 and run.exit_code([], True) == 75
    p.reset()
    assert p.read() == {}


def test_crawl(spark):
    from entityspark.operators import crawl

    urls = ["https://firm.ru/x", "http://127.0.0.1/", "http://0x7f000001/", "https://user@firm.ru/", "http://localhost:80/", "http://[::1]/", "ftp://firm.ru", "https://a b.ru", "https://2130706433/", "https://1c.ru/"]
    assert one(spark, crawl.is_safe, urls) == [True, *[False] * 8, True]
    rows = spark.createDataFrame([("https://firm.ru/a", "OSM", ""), ("https://vk.com/x", "OSM", ""), ("https://b.ru/", "VK", "vk_noise_primary"), ("https://c.ru/", "OSM", "vk_weak_website_donor")], "website string, source string, quality_flags string")
    assert [r["origin"] for r in crawl.seeds(rows).collect()] == ["https://firm.ru"]
    html = "<title>Мебель на заказ Уют</title><h1>Салон мебели Уют</h1><a href='/z'>z</a><a href='/contacts'>c</a><a href='https://other.ru/'>o</a><a href='/'>home</a> info@firm.ru"
    v = spark.createDataFrame([("https://firm.ru", "https://firm.ru/", html)], "origin string, url string, html string")
    assert [r["url"] for r in crawl.next_pages(v).orderBy("place").collect()] == ["https://firm.ru/contacts", "https://firm.ru/z"] and crawl.next_pages(v, most=2).count() == 1
    c = crawl.companies(v).first()
    assert (c["name"], c["email"], c["category"]) == ("Салон мебели Уют", "info@firm.ru", "mebel")
    assert one(spark, crawl.is_real_name, [("Главная", "a.ru"), ("firm.ru", "firm.ru"), ("Уют", "x"), ("Салон Уют", "x")]) == [False, False, False, True]
    page = "<a class='result__url' href='x'> vk.com/firm </a><a class=\"result__url\">firm.ru/about</a><a href='https://later.ru/'>"
    assert one(spark, crawl.found_site, [page, "<a href='https://duckduckgo.com/y'><a href='https://later.ru/?a=1&amp;b'>", ""]) == ["https://firm.ru/about", "https://later.ru/?a=1&b", ""]

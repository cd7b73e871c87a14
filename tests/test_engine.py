"""Small tables for the record-linkage engine; expected values are written out."""

import pytest
from pyspark.sql import functions as F

from entityspark.functions import contact, geo, text, web
from entityspark.operators import golden, resolve
from entityspark.plans import catalogue
from entityspark.sources import readers
from entityspark.streaming import state


def one(spark, of, values, *more):
    """Apply a column function to each value; further columns are given as tuples."""
    rows = [(k, *(v if isinstance(v, tuple) else (v,))) for k, v in enumerate(values)]
    n = len(rows[0]) - 1
    df = spark.createDataFrame(rows, "k int, " + ", ".join(f"c{i} string" for i in range(n)))
    return [r["x"] for r in df.select("k", of(*[F.col(f"c{i}") for i in range(n)], *more).alias("x")).orderBy("k").collect()]


def test_text(spark):
    assert one(spark, text.normal_text, ["  Кафе «Ёлка», №1 ", "a_b-c", None, " x y"]) == ["кафе елка 1", "a_b c", "", "x y"]
    assert one(spark, text.normal_city, ["г. Ялта", "пгт Форос", "Городок"]) == ["ялта", "форос", "городок"]
    assert one(spark, text.normal_address, ["Улица Ленина, д. 5а", "проспект Мира 3"]) == ["ул ленина д 5а", "пр мира 3"]
    assert one(spark, text.house_number, ["ул ленина 5а", "ул 1 мая 7", "нет", "ленина 5 7", "5 7 9", None]) == ["5а", "7", "", "5", "9", ""]
    assert one(spark, text.flags, ["B | a|b", None, ""]) == [["a", "b"], [], []]
    assert one(spark, text.safe_cell, ["=1+1", " -2", "@x", "ok", None]) == ["'=1+1", "' -2", "'@x", "ok", ""]
    assert one(spark, text.restored_cell, ["'=1+1", "'ok", "+7"]) == ["=1+1", "'ok", "+7"]
    assert one(spark, text.sheet_name, ["a/b:c", "x" * 40]) == ["a b c", "x" * 31]


def test_phones(spark):
    assert one(spark, contact.phone_digits, ["8 (978) 123-45-67", "978 1234567", "+49 30 123456789", "123", None]) == ["79781234567", "79781234567", "4930123456789", "", ""]
    assert one(spark, contact.phone_text, ["89781234567", "9781234567", " +49 30 1 "]) == ["+7 (978) 123-45-67", "+7 (978) 123-45-67", "+49 30 1"]


@pytest.mark.parametrize("email,verdict", [
    ("ivan@mail.ru", ""), ("info@mail.ru", "provider_service_address"), ("x@gmial.com", "provider_typo"), ("x@gmai.com", "provider_typo"), ("no at", "invalid_syntax"), ("a@b.png", "invalid_tld"),
    ("a@sub.vk.com", "platform_or_authority"), ("user@firm.ru", "placeholder"), ("a@poker-x.ru", "spam_domain"), ("a@corp.mail.ru", "provider_subdomain"), ("zakaz@firm.ru", ""),
])
def test_email_gate(spark, email, verdict):
    assert one(spark, contact.email_verdict, [(email, "firm.ru")]) == [verdict]


def test_email_helpers(spark):
    assert one(spark, contact.email_relation, [("a@mail.ru", "x.ru"), ("a@firm.ru", "shop.firm.ru"), ("a@other.ru", "firm.ru"), ("a@other.ru", "")]) == ["free", "same", "foreign", "unknown"]
    assert one(spark, contact.rot13, ["vasb@svezn.pbz"]) == ["info@firma.com"]
    hidden = "5a" + "".join(f"{ord(c) ^ 0x5A:02x}" for c in "info@firm.ru")
    assert one(spark, contact.hidden_email, [hidden, "5"]) == ["info@firm.ru", ""] or one(spark, contact.hidden_email, [hidden]) == ["info@firm.ru"]


def test_web(spark):
    assert one(spark, web.host_of, ["https://WWW.Firm.ru:80/x?y", "firm.ru.", "user@host.org/a", "", None]) == ["firm.ru", "firm.ru", "host.org", "", ""]
    assert one(spark, web.is_foreign_site, ["m.vk.com/x", "https://shop.ozon.ru", "notvk.com", ""]) == [True, True, False, False]
    assert one(spark, web.org_id, ["https://maps/org/name/123456789/", "/org/12345/"]) == ["123456789", ""]
    assert one(spark, web.clean_site, ["firm.ru/?utm=1", "http://a.ru/b/ extra", "nosite", "", None]) == ["https://firm.ru", "http://a.ru/b", "https://nosite", "", ""]
    assert one(spark, web.title, ["<h1>A <b>B</b>  C</h1>", "<title>Page name</title>", "<h1>x</h1>"]) == ["A B C", "Page name", ""]
    page = "<meta name='viewport'> tilda.ws © 2019-2020 <b>"
    assert one(spark, lambda c: web.signals(c, F.lit(True), 2026), [page, "<meta name=viewport> запись онлайн © 2026"]) == [["no_online_booking", "site_builder", "outdated"], []]
    assert one(spark, lambda c: web.pitch(F.split(c, ",")), ["outdated,no_mobile", "none"]) == ["Адаптив/редизайн", "Автоматизация/боты/CRM"]
    found = one(spark, web.probe_verdict, [("ok", None), ("error", "ok"), ("blocked", "error"), ("unknown", "error"), ("unstable", "unreachable"), ("unknown", "ok"), ("error", "blocked")])
    assert [(x["status"], x["no_https"]) for x in found] == [("ok", False), ("ok", True), ("blocked", False), ("unknown", False), ("dead", False), ("ok", False), ("blocked", False)]
    years = ["© 2010–2026", "&copy; 2001 - 2022", "copyright 2024", "© 2010"]
    assert one(spark, lambda c: F.array_contains(web.signals(c, F.lit(False), 2026), "outdated"), years) == [False, True, False, True]


def test_geo(spark):
    rows = spark.createDataFrame([(44.495, 34.166), (44.95, 34.1), (50.0, 30.0)], "lat double, lon double")
    assert [r[0] for r in rows.select(geo.city_of(F.col("lat"), F.col("lon"))).collect()] == ["Ливадия", "Симферополь", ""]
    km = rows.limit(1).select(geo.haversine(F.lit(44.95), F.lit(34.1), F.lit(44.5), F.lit(34.17))).first()[0]
    assert 50 < km < 51
    square = [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0)]
    inside = spark.createDataFrame([(1.0, 1.0), (3.0, 1.0)], "a double, b double").select(geo.inside(F.col("a"), F.col("b"), square))
    assert [r[0] for r in inside.collect()] == [True, False]


OBS = "row_idx long, source string, source_id string, name string, city string, address string, phone string, website string, latitude string, longitude string"


def test_branches_stay_apart_behind_a_bridge(spark):
    rows = resolve.prepared(spark.createDataFrame([
        (0, "OSM", "1", "Салон Лотос", "Ялта", "ул Ленина 1", "89781112233", "lotos.ru", None, None), (1, "VK", "2", "Салон Лотос", "Ялта", "", "89781112233", "lotos.ru", None, None),
        (2, "Я.Карты", "3", "Салон Лотос", "Ялта", "ул Ленина 90", "89781112233", "lotos.ru", None, None), (3, "OSM", "9", "Другое имя", "Ялта", "", "", "", None, None), (4, "OSM", "9", "Совсем иное", "", "", "", "", None, None),
    ], OBS))
    edges = resolve.matches(rows, resolve.candidate_pairs(rows))
    assert {(r["l"], r["r"]) for r in edges.collect()} == {(0, 1), (1, 2), (3, 4)}
    found = {r["row_idx"]: r["cluster"] for r in resolve.clusters(rows, edges).collect()}
    assert found == {0: 0, 1: 0, 2: 2, 3: 3, 4: 3}


def test_name_and_city_are_not_enough(spark):
    rows = resolve.prepared(spark.createDataFrame([(0, "OSM", "1", "Лотос", "Ялта", "", "", "", None, None), (1, "VK", "2", "Лотос", "Ялта", "", "", "", None, None)], OBS))
    assert resolve.matches(rows, resolve.candidate_pairs(rows)).isEmpty()


def test_rows_at_one_point_meet(spark, tmp_path):
    rows = resolve.prepared(spark.createDataFrame([
        (0, "OSM", "1", "Салон Лотос", "Ялта", "ул Ленина 1", "", "", "44.5", "34.1", None, None), (1, "VK", "2", "Салон Лотос плюс", "Форос", "пр Мира 7", "", "", "44.501", "34.1", None, None),
        (2, "OSM", "3", "Один", "", "", "", "", None, None, "e1", None), (3, "VK", "4", "Два", "", "", "", "", None, None, "e1", None), (4, "VK", "5", "Три", "", "", "", "", None, None, None, "https://VK.com/a"), (5, "VK", "6", "Четыре", "", "", "", "", None, None, None, "https://vk.com/A"),
    ], OBS + ", entity_id string, source_url string"))
    assert {(r["l"], r["r"]) for r in resolve.matches(rows, resolve.candidate_pairs(rows)).collect()} == {(0, 1), (2, 3), (4, 5)}
    # customers 1 and 1171 stand at one point and share no identifier, phone, domain, address or city
    customers = [(1, 0), (1171, 1)]
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    assert [(r["l"], r["r"]) for r in catalogue.q_match_pairs(spark, str(tmp_path)).filter("kind = 'pair'").collect()] == [(1, 1171)]


GOLDEN = "cluster int, row_idx long, observation_id string, source string, name string, city string, phone string, email string, website string, address string, quality_flags string, confidence string, first_seen string, last_seen string"


def test_weak_rows_fill_and_are_flagged(spark):
    rows = spark.createDataFrame([
        (1, 0, "a", "OSM", "Лотос", "Крым", "", "", "", "ул Ленина 5", "", "0.95", "2026-01-02", "2026-02-01"), (1, 1, "b", "VK", "Лотос плюс", "Ялта", "89781112233", "x@lotos.ru", "", "", "vk_no_own_website", "0.4", "2026-01-01", "2026-03-01"),
        (2, 2, "c", "VK", "Один", "Ялта", "1", "", "", "", "vk_noise_primary", "0.3", "", "2026-03-01"),
    ], GOLDEN)
    one_, two = golden.golden(rows).orderBy("cluster").collect()
    assert (one_["name"], one_["city"], one_["phone"], one_["email"], one_["confidence"], one_["sources"]) == ("Лотос", "Крым", "89781112233", "x@lotos.ru", "0.95", "OSM|VK")
    assert one_["quality_flags"] == "manual_review|vk_weak_contact_donor|vk_weak_email_donor|vk_weak_observation_linked|vk_weak_phone_donor" and one_["anchored"] and not two["anchored"] and two["name"] == "Один"
    assert golden.provenance(rows).filter("cluster = 1 and field = 'name'").count() == 2


def test_state_and_stream(spark, tmp_path):
    runs = [[("a", "2026-01-01"), ("b", "2026-01-02")], [("a", "2026-01-03"), ("a", "2026-01-04")]]
    frames = [spark.createDataFrame(r, "observation_id string, seen_at string") for r in runs]
    after = state.upsert(state.sightings(frames[0]), frames[1])
    expected = [("a", "2026-01-01", "2026-01-04", 3), ("b", "2026-01-02", "2026-01-02", 1)]
    assert sorted(map(tuple, after.collect())) == expected
    for k, f in enumerate(frames):
        f.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        updates = state.run_updates(spark.readStream.schema(f.schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/changes", f"{tmp_path}/updates")
        updates.awaitTermination(120)
    assert sorted(map(tuple, state.current(spark, f"{tmp_path}/updates").collect())) == expected and spark.read.parquet(f"{tmp_path}/changes/batch=1").count() == 1


def test_sources(spark, tmp_path):
    (tmp_path / "osm.json").write_text('{"elements": [{"type": "node", "id": 1, "lat": 44.5, "lon": 34.1, "tags": {"name": "A", "phone": "1"}}, {"type": "way", "id": 2, "center": {"lat": 1.0, "lon": 2.0}, "tags": {"operator": "B"}}, {"type": "node", "id": 3, "lat": 1.0, "lon": 1.0, "tags": {}}]}')
    assert [(r["source_id"], r["name"]) for r in readers.osm(spark, str(tmp_path / "osm.json")).orderBy("source_id").collect()] == [("node:1", "A")]  # the other lies off the peninsula
    rows = spark.createDataFrame([("=x", 'say "hi"\nthere'), ("", "b;c")], "a string, b string")
    readers.write_result_csv(rows, str(tmp_path / "csv"))
    assert sorted(map(tuple, readers.result_csv(spark, str(tmp_path / "csv")).collect())) == [("", "b;c"), ("=x", 'say "hi"\nthere')]
    assert readers.united(rows, rows.select("a")).filter("b = ''").count() == 2


def test_entry_imports_without_the_subpackage():
    import __spark_entry__ as entry

    assert entry.optional("entityspark.no_such.module") is None and entry.optional("no_such_module") is None
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_distances_are_computed_once_for_the_rows_of_two_places(spark, monkeypatch):
    plan = catalogue.q_haversine_pairs(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().upper()
    assert "ASIN" not in plan.split("GENERATE EXPLODE")[0]
    monkeypatch.setattr(catalogue, "BLOCK", 3)
    rows = spark.range(120).selectExpr("id % 2 AS cluster", "CASE WHEN id = 7 THEN 9 ELSE id END AS row_idx", "44.4D + CASE WHEN id < 40 THEN 0 ELSE id * 7 % 5 END / 100D AS latitude", "CASE WHEN id > 115 THEN NULL ELSE 33.4D + CASE WHEN id < 40 THEN 0 ELSE id * 11 % 3 END / 100D END AS longitude")
    a, b = (rows.selectExpr("cluster", *[f"{c} AS {s}_{c}" for c in ("row_idx", "latitude", "longitude")]) for s in "ab")
    km = F.round(geo.haversine(F.col("a_latitude"), F.col("a_longitude"), F.col("b_latitude"), F.col("b_longitude")), 6)
    plain = a.join(b, "cluster").filter("a_row_idx < b_row_idx").select("a_row_idx", "b_row_idx", km)
    told = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert told(catalogue.distances(rows)) == told(plain) and plain.filter("a_row_idx = 9").count() == 110

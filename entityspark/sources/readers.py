"""Landed inputs as DataFrames, and the registry that new sources join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entityspark.functions import contact, geo, taxonomy, text, values, web
from entityspark.operators import ordered
from entityspark.sources import places
from entityspark.sources.sinks import safe

OSM = "elements array<struct<type: string, id: bigint, lat: double, lon: double, center: struct<lat: double, lon: double>, tags: map<string, string>>>"
ADDRESSES = "addresses array<struct<city: struct<title: string, name: string>, address: string, title: string>>"
GROUP = f"id bigint, name string, activity string, description string, status string, site string, screen_name string, city struct<title: string>, contacts array<struct<email: string, phone: string>>, {ADDRESSES}"
CARD = "name string, address string, hrefs array<string>, snapshot int, idx int"


def result_csv(spark: SparkSession, path: str | list[str], sep: str = ";") -> DataFrame:
    """Quoted result files; a byte order mark is passed over, empty and missing are '' and formula escapes are undone."""
    rows = spark.read.option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", True).option("header", True).csv(path)
    return rows.select(*[text.restored_cell(F.col(f"`{c}`")).alias(c.lstrip("\ufeff")) for c in rows.columns])


def sniffed_csv(spark: SparkSession, path: str) -> DataFrame:
    """A result file of either separator: the one that its header has more of, the semicolon where they tie."""
    header = spark.read.text(path).select("value").first()
    line = header["value"] if header else ""
    return result_csv(spark, path, ";" if line.count(";") >= line.count(",") else ",")


def selected_files(names: list[tuple[str, float]]) -> list[str]:
    """Of result files (name, time of change): raw ones that no enriched file replaces, then enriched ones, each by time."""
    base = lambda n: n.rsplit("/", 1)[-1]
    by_time = [n for n, _ in sorted(names, key=lambda x: x[1])]
    enriched = [n for n in by_time if "enriched" in base(n) and n.endswith(".csv")]
    replaced = {base(n).replace("_enriched", "") for n in enriched}
    raw = [n for n in by_time if base(n).startswith("result_") and n.endswith(".csv") and "enriched" not in base(n)]
    return [n for n in raw if base(n) not in replaced] + enriched


def result_files(spark: SparkSession, folder: str) -> DataFrame:
    """All selected result files of a folder as one table in reading order, with row_idx."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    names = selected_files([(str(f.getPath().toString()), float(f.getModificationTime())) for f in found])
    if not names:
        return spark.createDataFrame([], "row_idx long, name string")
    # Files are few; each keeps its place, and rows their order in it.
    parts = [sniffed_csv(spark, n).withColumn("__file", F.lit(k)).withColumn("__row", F.monotonically_increasing_id()) for k, n in enumerate(names)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    return whole.withColumn("row_idx", (F.col("__file").cast("long") * F.lit(1 << 52)) + F.col("__row")).drop("__file", "__row")


def write_result_csv(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Result rows as a folder of quoted files; appending adds files."""
    safe(rows).write.mode(mode).option("sep", ";").option("quoteAll", True).option("escape", '"').option("header", True).csv(path)


def tag_values(tags: Column, *keys: str) -> Column:
    """Distinct values of several tags in order; a tag may hold some, parted by semicolons."""
    parts = F.flatten(F.array(*[F.transform(F.split(F.coalesce(F.try_element_at(tags, F.lit(k)), F.lit("")), ";"), lambda v: F.trim(v)) for k in keys]))
    return contact.distinct_by(parts, lambda v: F.lower(v))


def osm(spark: SparkSession, path: str) -> DataFrame:
    """Named elements on the peninsula, at a point or a shape's centre, as observations."""
    e = spark.read.schema(OSM).option("multiLine", True).json(path).select(F.explode("elements").alias("e")).select("e.*")
    return osm_rows(e)


def captured(spark: SparkSession, path: str) -> DataFrame:
    """As ``osm``, from a folder of captured answers. The box of the peninsula reaches the reader, so that files off it stay shut."""
    (south, north), (west, east) = ((min(*own, *box), max(*own, *box)) for own, box in zip(zip(*values.CONTOUR, strict=True), (values.CONTOUR_BOX[:2], values.CONTOUR_BOX[2:]), strict=True))
    e = places.places(spark, path).filter(F.col("lat").between(south, north) & F.col("lon").between(west, east))
    return osm_rows(e.withColumn("center", F.lit(None).cast("struct<lat:double,lon:double>")))


def osm_rows(elements: DataFrame) -> DataFrame:
    tag = lambda k: F.nullif(F.try_element_at("tags", F.lit(k)), F.lit(""))
    blank, first = text.blank, lambda a: F.coalesce(F.get(a, F.lit(0)), F.lit(""))
    rows = elements.withColumns({"name": F.coalesce(tag("name"), tag("name:ru"), tag("operator")), "lat": F.coalesce("lat", "center.lat"), "lon": F.coalesce("lon", "center.lon"), "kind": F.coalesce(F.nullif("type", F.lit("")), F.lit("node"))})
    rows = rows.filter(F.col("name").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()).filter(geo.in_contour(F.col("lat"), F.col("lon")))
    town = F.coalesce(tag("addr:city"), tag("addr:town"), tag("addr:village"), tag("addr:hamlet"))
    full = F.coalesce(tag("addr:full"), tag("address"), F.lit(""))
    place = F.nullif(geo.city_of(F.col("lat"), F.col("lon")), F.lit(""))
    city = F.when(town.isNotNull(), geo.city_name(F.coalesce(geo.hinted_city(town), town))).otherwise(F.coalesce(geo.hinted_city(full, False), place, F.lit("Крым")))
    street = F.concat(F.lit("ул. "), tag("addr:street"), F.coalesce(F.concat(F.lit(", "), tag("addr:housenumber")), F.lit("")))
    built = F.concat_ws(", ", F.concat(F.lit("г. "), F.coalesce(tag("addr:city"), tag("addr:town"), tag("addr:village"))), street, tag("addr:postcode"))
    phones = F.transform(tag_values(F.col("tags"), "phone", "contact:phone", "phone:mobile", "contact:mobile"), contact.phone_text)
    mails, sites = tag_values(F.col("tags"), "email", "contact:email"), F.transform(tag_values(F.col("tags"), "website", "contact:website", "url"), lambda u: F.when(u.rlike("^https?://"), u).otherwise(F.concat(F.lit("https://"), u)))
    ref = F.col("id").cast("string")
    out = rows.withColumns({"phones": phones, "mails": mails, "sites": sites, "segment": taxonomy.tag_segment(F.col("tags"))})
    return out.select(
        F.lit("OSM").alias("source"), F.coalesce(F.concat_ws(":", "kind", F.when(ref.isNotNull(), ref)), F.lit("")).alias("source_id"), blank(F.concat(F.lit("https://www.openstreetmap.org/"), F.col("kind"), F.lit("/"), ref)).alias("source_url"), "name", city.alias("city"),
        F.coalesce(F.nullif(built, F.lit("")), full).alias("address"), first(F.col("phones")).alias("phone"), first(F.col("mails")).alias("email"), first(F.col("sites")).alias("website"), F.array_join("phones", " | ").alias("all_phones"),
        F.array_join("mails", " | ").alias("all_emails"), F.array_join("sites", " | ").alias("all_websites"), F.col("segment.segment").alias("category"), F.col("segment.tag").alias("raw_category"), F.col("lat").cast("string").alias("latitude"),
        F.col("lon").cast("string").alias("longitude"), F.lit("0.95").alias("confidence"), F.lit("").alias("quality_flags"),
    )


ENTRY = "checked_at string, status string, via string, signals array<string>, contacts map<string,string>"


def cache_file(spark: SparkSession, path: str, statuses: list[str] | None = None) -> DataFrame:
    """(host, checked_at, status, via, signals, contacts) of cache files, each one object from hosts to entries. A missing or
    unreadable file is an empty cache; entries that are no objects, or whose status is none of ``statuses``, are left out."""
    try:
        files = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"host string, {ENTRY}")
    # Entries are read one by one, so that one of another shape spoils no other.
    raw = files.select(F.explode(F.from_json("value", "map<string,string>")).alias("host", "entry")).filter(F.col("entry").startswith("{"))
    rows = raw.select("host", F.from_json("entry", ENTRY).alias("e")).select("host", "e.*")
    return rows if statuses is None else rows.filter(F.col("status").isin(statuses))


def search_matrix(spark: SparkSession, max_cities: int = 0, max_queries: int = 0) -> DataFrame:
    """(city_id, city, query, place): the searches of the social network, city by city."""
    cities, queries = list(values.GROUP_CITIES.items())[: max_cities or None], list(taxonomy.group_queries())[: max_queries or None]
    return spark.createDataFrame([(i, c, q, a * len(queries) + b) for a, (i, c) in enumerate(cities) for b, q in enumerate(queries)], "city_id long, city string, query string, place int")


def map_queries(cities: list[str], templates: list[tuple[str, str]] | None = None, city_from: int = 0, city_n: int = 0, query_from: int = 0, query_n: int = 0) -> list[tuple[str, str]]:
    """(query, segment) of a batch of a map's searches: a rectangle of cities and templates."""
    known = templates or [(q + " {city}", key) for q, key in taxonomy.listed(taxonomy.MAP_QUERIES)]
    chosen = cities[city_from:][: city_n or None]
    return [(q.format(city=c), key) for c in chosen for q, key in known[query_from:][: query_n or None]]


def found_groups(results: DataFrame) -> DataFrame:
    """(id, city, queries): groups of all searches, with the first city that gave them and all queries. Columns: id, city, query, place."""
    known = results.filter("id is not null and id <> 0")
    return known.groupBy("id").agg(F.min_by("city", "place").alias("city"), F.array_sort(F.collect_set("query")).alias("queries"))


def usable(envelopes: DataFrame) -> DataFrame:
    """Answers of the social network up to the end of its patience: nothing from an invalid token on, nor from the third answer
    in a row on that tells of a flood. Columns: seq, error_code (null for none)."""
    known = ordered.running(ordered.numbered(envelopes, ["seq"]), {"place": F.lit(1)})
    dead = known.filter(F.col("error_code").isin(values.DEAD_TOKEN_CODES)).select("place")
    flood = ordered.in_a_row(known.filter(F.col("error_code") == values.FLOOD_CODE).select("place"), 3)
    return ordered.before_first(known, dead.unionByName(flood), "place").filter("error_code is null").drop("place", "__id")


def relevance(queries: Column) -> Column:
    """(score, flags) of a group: whether its name or activity tells of a segment, its description, its hits, noise, a site."""
    b, other = text.blank, F.lit(taxonomy.DEFAULT_SEGMENT)
    primary = (taxonomy.segment_of(F.col("name")) != other) | (taxonomy.segment_of(F.col("activity")) != other)
    corpus = F.lower(F.concat_ws(" ", b(F.col("name")), b(F.col("activity")), b(F.col("description")), b(F.col("status"))))
    hits = F.size(F.filter(queries, lambda q: corpus.contains(F.lower(q))))
    noise = F.concat_ws(" ", b(F.col("name")), b(F.col("activity"))).rlike(rf"(?iuU)\b(?:{taxonomy.NOISE})\b")
    site = web.clean_site(F.col("site"))
    homeless = (site == "") | web.is_foreign_site(site)

    def judged(x: Column) -> Column:
        score = F.lit(0.35) + F.when(x["primary"], 0.35).otherwise(0.0) + F.when(x["told"], 0.10).otherwise(0.0) + F.least(F.lit(0.15), x["hits"] * 0.05)
        capped = F.least(score, F.when(x["noise"], 0.25).otherwise(1.0), F.when(x["primary"], 1.0).otherwise(0.60))
        flags = [(~x["primary"], "vk_no_primary_segment_signal"), (x["noise"], "vk_noise_primary"), (x["homeless"], "vk_no_own_website"), (capped < 0.5, "manual_review")]
        return F.struct(capped.alias("score"), F.array_compact(F.array(*[F.when(t, F.lit(f)) for t, f in flags])).alias("flags"))

    return text.let(F.struct(primary.alias("primary"), (taxonomy.segment_of(F.col("description")) != other).alias("told"), hits.alias("hits"), noise.alias("noise"), homeless.alias("homeless")), judged)


def group_email(contacts: Column, description: Column, domain: Column) -> tuple[Column, Column]:
    """(best, all) addresses of a group: those of its contacts, then those of its description."""
    listed = F.concat(F.coalesce(F.transform(contacts, lambda c: F.trim(text.blank(c["email"]))), F.array().cast("array<string>")), F.regexp_extract_all(text.blank(description), F.lit(f"({contact.EMAIL})"), F.lit(1)))
    open_ = F.filter(listed, lambda e: e.contains("@") & ~F.exists(F.array(*map(F.lit, values.GROUP_EMAIL_BLOCKS)), lambda x: F.lower(e).contains(x)))

    def rank(e: Column, i: Column) -> Column:
        host = contact.domain_part(F.lower(e))
        own = (domain != "") & ((host == domain) | host.endswith(F.concat(F.lit("."), domain)))
        return F.struct((-(F.when(own, 100).otherwise(0) + contact.prefix_score(contact.local_part(F.lower(e)), values.GROUP_PREFIXES))).alias("s"), i.alias("i"), e.alias("e"))

    best = F.get(F.array_sort(F.transform(open_, rank)), F.lit(0))["e"]
    return F.coalesce(best, F.lit("")), contact.distinct_by(open_, lambda e: F.lower(e))


def group_address() -> Column:
    """City and street of a group's first address that has any."""
    parts = F.transform("addresses", lambda a: F.array_join(F.array_distinct(F.array_compact(F.array(F.nullif(F.coalesce(a["city"]["title"], a["city"]["name"]), F.lit("")), F.coalesce(F.nullif(a["address"], F.lit("")), F.nullif(a["title"], F.lit("")))))), ", "))
    return F.coalesce(F.get(F.filter(parts, lambda x: x != ""), F.lit(0)), F.lit(""))


def group_category(queries: Column) -> Column:
    """The segment of activity or name, else of the first query that has one."""
    names, other = F.create_map(*[F.lit(x) for kv in taxonomy.group_queries().items() for x in kv]), F.lit(taxonomy.DEFAULT_SEGMENT)
    by_text = [F.nullif(taxonomy.segment_of(F.col(c)), other) for c in ("activity", "name")]
    asked = F.filter(F.transform(queries, lambda q: F.try_element_at(names, q)), lambda k: k.isNotNull())
    return F.coalesce(*by_text, F.get(asked, F.lit(0)), other)


def group_rows(details: DataFrame, found: DataFrame) -> DataFrame:
    """Groups with their details and the searches that found them, as observations; what is hardly relevant goes."""
    b = text.blank
    g = details.join(found.select("id", F.col("city").alias("asked_city"), "queries"), "id", "left").withColumn("queries", F.coalesce("queries", F.array().cast("array<string>"))).filter(F.trim(b(F.col("name"))) != "")
    g = g.withColumn("r", relevance(F.col("queries"))).withColumn("website", web.clean_site(F.col("site"))).filter("r.score > 0.05")
    domain = web.net_location(F.col("website"))
    best, every = group_email(F.col("contacts"), F.col("description"), domain)
    phones = F.filter(F.transform(F.coalesce("contacts", F.array().cast("array<struct<email: string, phone: string>>")), lambda c: contact.phone_text(c["phone"])), lambda p: p != "")
    page = F.concat(F.lit("https://vk.com/"), F.coalesce(F.nullif("screen_name", F.lit("")), F.concat(F.lit("club"), F.col("id").cast("string"))))
    return g.select(
        F.lit("VK").alias("source"), F.col("id").cast("string").alias("source_id"), page.alias("source_url"), F.trim("name").alias("name"), geo.city_name(F.coalesce(F.nullif("city.title", F.lit("")), F.nullif("asked_city", F.lit("")), F.lit("Крым"))).alias("city"),
        group_address().alias("address"), F.coalesce(F.get(phones, F.lit(0)), F.lit("")).alias("phone"), best.alias("email"), "website", page.alias("social"), F.array_join(contact.distinct_by(phones, lambda p: F.regexp_replace(p, "[^0-9]", "")), " | ").alias("all_phones"),
        F.array_join(every, " | ").alias("all_emails"), F.col("website").alias("all_websites"), page.alias("all_socials"), group_category(F.col("queries")).alias("category"), b(F.col("activity")).alias("raw_category"), F.array_join("queries", " | ").alias("matched_query"),
        F.call_function("format_string", F.lit("%.2f"), F.col("r.score")).alias("confidence"), F.array_join("r.flags", "|").alias("quality_flags"),
    )


def vk(spark: SparkSession, path: str, found: DataFrame | None = None) -> DataFrame:
    """Captured details of groups, with the searches that found them where those are given."""
    none = spark.createDataFrame([], "id long, city string, queries array<string>")
    return group_rows(spark.read.schema(GROUP).option("multiLine", True).json(path), none if found is None else found)


def cards(spark: SparkSession, path: str, limit: int) -> DataFrame:
    """Map cards: the first sighting of each organisation, then the first ``limit`` in order."""
    return card_rows(spark.read.schema(CARD).json(path), limit)


def card_rows(c: DataFrame, limit: int) -> DataFrame:
    own = F.get(F.filter("hrefs", lambda h: web.org_id(h) != ""), F.lit(0))
    rows = c.select(text.one_space(F.col("name")).alias("name"), text.one_space(F.col("address")).alias("address"), web.org_id(own).alias("org_id"), F.regexp_replace(own, "[?#].*$", "").alias("source_url"), "snapshot", "idx").filter("name <> '' and org_id is not null")
    order = F.struct("snapshot", "idx", "name", "address", "source_url")
    return rows.groupBy("org_id").agg(F.min(order).alias("x")).select("org_id", "x.*").orderBy("snapshot", "idx").limit(limit)


def steady_rounds(counts: DataFrame, rounds: int = 3) -> DataFrame:
    """(snapshot): the first round of a scrolled list after which ``rounds`` rounds brought nothing new. Columns: snapshot, n."""
    known = ordered.running(ordered.numbered(counts, ["snapshot"]), {"place": F.lit(1)}).select("snapshot", "n", "place")
    before = known.select((F.col("place") + 1).alias("place"), F.col("n").alias("before"))
    quiet = known.join(before, "place").filter("n <= before").select("place")
    return known.join(ordered.in_a_row(quiet, rounds), "place", "left_semi").agg(F.min("snapshot").alias("snapshot"))


def run_result(value: object, observed: int) -> tuple[int, dict]:
    """What a source's run gave: a count, a report with one, or nothing, in which case the rows seen are counted."""
    if isinstance(value, dict):
        return int(value.get("added", value.get("count", observed)) or 0), dict(value)
    return (int(value), {}) if isinstance(value, int) and not isinstance(value, bool) else (observed, {})


#: A source is a name and a reader of (session, path).
SOURCES: dict[str, Callable[..., DataFrame]] = {"osm": osm, "places": captured, "vk": vk, "cards": cards, "csv": result_csv}


def united(*frames: DataFrame) -> DataFrame:
    """All observations; columns that a source lacks are empty."""
    first, *rest = frames
    for f in rest:
        first = first.unionByName(f, allowMissingColumns=True)
    return first.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in first.columns])

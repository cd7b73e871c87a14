"""Golden records: one row for a cluster, each field with the best value; contacts and flags united; trust tiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityspark.functions import contact, geo, text, web
from entityspark.functions.values import QUARANTINE_FLAGS, SOURCE_PRIORITY
from entityspark.operators.identity import complete, observation_id

CONTACTS = ("phone", "email", "website", "address", "social")
#: Lists of all contacts by the field that holds the best one.
LISTS = {"phone": "all_phones", "email": "all_emails", "website": "all_websites", "social": "all_socials"}
VALUES = ("name", "city", "client_type", "category", "raw_category", "address", "phone", "email", "website", "social", "comment")
EVIDENCE = (
    "name", "city", "client_type", "category", "address", "phone", "email", "website", "social", "comment", "latitude", "longitude", "raw_category", "matched_query", "confidence",
    "quality_flags", "all_phones", "all_emails", "all_websites", "all_socials",
)
PROVENANCE = (
    "observations array<struct<first_seen: string, last_seen: string, observation_id: string, source: string, source_id: string, source_url: string>>, "
    "fields map<string, array<struct<observation_id: string, source: string, source_id: string, value: string>>>"
)


def priority(source: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for kv in SOURCE_PRIORITY.items() for x in kv])
    return F.coalesce(F.try_element_at(ranks, text.one_space(source)), F.lit(0))


def seen() -> Column:
    return F.col("last_seen")


def quality(field: str, value: Column) -> Column:
    """How good a value of a field is by its form; an address in the domain of the row's own site is better."""
    if field == "phone":
        return F.when(contact.phone_digits(value) != "", 90).otherwise(-40)
    if field == "email":
        domain = F.lower(contact.domain_part(value))
        return F.when(value.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), 80).otherwise(-40) + F.when(value.contains("@") & (domain != "") & (domain == web.host_of(F.col("website"))), 20).otherwise(0)
    if field == "website":
        return F.when(web.host_of(value) != "", 70).otherwise(-40)
    if field == "address":
        return 10 + F.least(F.length(text.normal_address(value)), F.lit(50)) + F.when(text.house_number(text.normal_address(value)) != "", 20).otherwise(0)
    if field == "city":
        return F.when(text.normal_city(value) == "крым", 10).otherwise(40)
    if field in ("category", "client_type"):
        return F.when(text.normal_text(value) == "прочее", 10).otherwise(40)
    if field == "name":
        return 10 + F.least(F.length(text.normal_text(value)), F.lit(40))
    return F.lit(10)


def best(field: str, when: Column | None = None) -> Column:
    """The best value by (quality, source, last_seen, length); of equals the first row's. Needs source, last_seen, row_idx,
    and website for addresses."""
    value = F.col(field)
    rank = F.struct(quality(field, value), priority(F.col("source")), text.blank(seen()), F.length(F.trim(value)), -F.col("row_idx"))
    usable = (text.blank(value) != "") & (F.lit(True) if when is None else when)
    return F.coalesce(F.max_by(F.when(usable, value), F.when(usable, rank)), F.lit("")).alias(field)


def identity_of(field: str, value: Column) -> Column:
    if field == "phone":
        return contact.phone_identity(value)
    return F.lower(value) if field == "email" else F.regexp_replace(F.lower(value), "/+$", "")


def united(field: str, when: Column | None = None) -> Column:
    """All values of a contact and of its list, distinct by identity, in row order, the first spelling kept."""
    more = contact.listed_values(F.col(LISTS[field])) if field in LISTS else F.array().cast("array<string>")
    own = F.struct("row_idx", F.concat(F.array(F.trim(text.blank(F.col(field)))), more).alias("v"))
    rows = F.array_sort(F.collect_list(own if when is None else F.when(when, own)))
    return F.array_join(contact.distinct_by(F.flatten(F.transform(rows, lambda x: x["v"])), lambda v: identity_of(field, v)), " | ")


def weak() -> Column:
    """A row of a broad source that lacks what a company shows: it may give contacts, but stands for no entity."""
    return F.lower(text.one_space(F.col("source"))).startswith("vk") & F.arrays_overlap(text.flags(F.col("quality_flags")), F.array(*map(F.lit, QUARANTINE_FLAGS)))


def anchor() -> Column:
    return ~weak()


def may_seed() -> Column:
    """Whether a row's site may be visited: an anchor without doubtful flags whose site no weak row gave."""
    doubts = F.array(*map(F.lit, [*QUARANTINE_FLAGS, "vk_weak_website_donor"]))
    return anchor() & ~F.arrays_overlap(text.flags(F.col("quality_flags")), doubts)


def sorted_set(values: Column) -> Column:
    """Sorted distinct parts of lists with bars, over the rows of a group."""
    parts = F.transform(F.split(text.blank(values), r"\|"), lambda x: F.trim(x))
    return F.array_sort(F.array_distinct(F.filter(F.flatten(F.collect_set(parts)), lambda x: x != "")))


def entity_id() -> Column:
    """The least id that rows have, else one by their source ids, else by their observations."""
    source = F.lower(text.one_space(F.col("source")))
    by_source = F.when((source != "") & (F.trim("source_id") != ""), F.concat_ws("|", F.lit("source-id"), source, F.trim("source_id")))
    digest = lambda ids: F.concat(F.lit("ent_"), F.substring(F.sha2(F.array_join(F.array_sort(ids), "|"), 256), 1, 24))
    return F.coalesce(F.min(F.nullif(F.trim("entity_id"), F.lit(""))), F.when(F.count(by_source) > 0, digest(F.collect_list(by_source))), digest(F.collect_list("observation_id")))


def golden(rows: DataFrame, by: str = "cluster") -> DataFrame:
    """One row a cluster in one shuffle. Anchors alone give values, coordinates (as a pair) and the representative; weak rows
    fill contacts that stay empty, and leave flags. A cluster without an anchor is quarantined. Columns: ``by``, row_idx and
    those of an observation."""
    marked = complete(rows).withColumn("observation_id", observation_id()).withColumn("is_anchor", anchor())
    yes, no = F.col("is_anchor"), ~F.col("is_anchor")
    has_point = geo.coordinate(F.col("latitude"), 90).isNotNull() & geo.coordinate(F.col("longitude"), 180).isNotNull()
    rank = F.struct(priority(F.col("source")), text.blank(seen()), text.completeness(*map(F.col, CONTACTS)), -F.col("row_idx"))
    place_rank = F.struct(priority(F.col("source")), text.blank(seen()), -F.col("row_idx"))
    face = F.struct("observation_id", text.one_space(F.col("source")).alias("source"), "source_id", "source_url")
    place = F.struct("latitude", "longitude")
    sure = lambda when: F.max(F.when(when, F.col("confidence").try_cast("double")))
    both = lambda name, of: [of(yes).alias(name), of(no).alias(f"weak_{name}")]
    table = marked.groupBy(by).agg(
        *[c for f in VALUES for c in both(f, lambda w, f=f: best(f, w))], *[c for f, many in LISTS.items() for c in both(many, lambda w, f=f: united(f, w))],
        *both("face", lambda w: F.max_by(F.when(w, face), F.when(w, rank))), *both("place", lambda w: F.max_by(F.when(w & has_point, place), F.when(w & has_point, place_rank))), *both("sure", sure),
        F.max("is_anchor").alias("anchored"), F.count("*").alias("n_rows"), F.count_if(no).alias("n_weak"), sorted_set(F.coalesce(F.nullif(F.col("sources"), F.lit("")), F.col("source"))).alias("sources"),
        sorted_set(F.when(yes, F.col("quality_flags"))).alias("flags"), sorted_set(F.when(no, F.col("quality_flags"))).alias("weak_flags"), sorted_set(F.col("matched_query")).alias("queries"),
        F.coalesce(F.min(F.nullif(F.col("first_seen"), F.lit(""))), F.lit("")).alias("first_seen"), F.coalesce(F.max(F.nullif(F.col("last_seen"), F.lit(""))), F.lit("")).alias("last_seen"), entity_id().alias("entity_id"),
    )
    gave = {f: F.col("anchored") & (F.col(f) == "") & (F.col(f"weak_{f}") != "") for f in CONTACTS}
    donors = F.array_compact(F.array(*[F.when(test, F.lit(f"vk_weak_{f}_donor")) for f, test in gave.items()]))
    linked = F.concat(F.transform("flags", lambda x: F.lower(x)), F.array(F.lit("vk_weak_observation_linked")), donors, F.when(F.size(donors) > 0, F.array(F.lit("vk_weak_contact_donor"), F.lit("manual_review"))).otherwise(F.array().cast("array<string>")))
    all_flags = F.when(~F.col("anchored"), F.col("weak_flags")).when(F.col("n_weak") == 0, F.col("flags")).otherwise(F.array_sort(F.array_distinct(linked)))
    pick = lambda name: F.when(F.col("anchored"), F.col(name)).otherwise(F.col(f"weak_{name}"))
    value = lambda f: F.when(gave[f], F.col(f"weak_{f}")).otherwise(pick(f)) if f in CONTACTS else pick(f)
    many = lambda f, name: F.when(gave[f], F.coalesce(F.nullif(F.col(f"weak_{name}"), F.lit("")), F.col(f"weak_{f}"))).otherwise(pick(name))
    chosen, at = pick("face"), pick("place")
    return table.select(
        by, "entity_id", *[chosen[c].alias(c) for c in ("observation_id", "source", "source_id", "source_url")], *[value(f).alias(f) for f in VALUES], *[many(f, n).alias(n) for f, n in LISTS.items()],
        text.blank(at["latitude"]).alias("latitude"), text.blank(at["longitude"]).alias("longitude"), "anchored", "n_rows", F.array_join("sources", "|").alias("sources"), F.array_join(all_flags, "|").alias("quality_flags"),
        F.array_join("queries", " | ").alias("matched_query"), F.coalesce(F.call_function("format_string", F.lit("%.2f"), pick("sure")), F.lit("")).alias("confidence"), "first_seen", "last_seen",
    )


def refreshed(rows: DataFrame) -> DataFrame:
    """One row an observation from all its sightings, in the order of row_idx: the best values; flags, confidence and kinds of
    the latest sighting (flags even where it has none); first and last sighting."""
    blank = text.blank
    known = complete(rows)
    latest = F.struct(blank(seen()), -F.col("row_idx"))
    newest = lambda f: F.coalesce(F.max_by(F.when(F.col(f) != "", F.col(f)), F.when(F.col(f) != "", latest)), F.lit("")).alias(f)
    moved = ("confidence", "raw_category", "category", "client_type", "source", "source_id", "source_url")
    has_point = geo.coordinate(F.col("latitude"), 90).isNotNull() & geo.coordinate(F.col("longitude"), 180).isNotNull()
    place = F.max_by(F.when(has_point, F.struct("latitude", "longitude")), F.when(has_point, F.struct(priority(F.col("source")), blank(seen()), -F.col("row_idx"))))
    table = known.groupBy("observation_id").agg(
        F.min("row_idx").alias("row_idx"), *[best(f) for f in VALUES if f not in moved], *[newest(f) for f in moved], *[united(f).alias(n) for f, n in LISTS.items()], F.max_by("quality_flags", latest).alias("quality_flags"),
        place.alias("place"), F.array_join(sorted_set(F.coalesce(F.nullif(F.col("sources"), F.lit("")), F.col("source"))), "|").alias("sources"), F.array_join(sorted_set(F.col("matched_query")), " | ").alias("matched_query"),
        F.coalesce(F.min(F.nullif(F.col("first_seen"), F.lit(""))), F.lit("")).alias("first_seen"), F.coalesce(F.max(F.nullif(F.col("last_seen"), F.lit(""))), F.lit("")).alias("last_seen"),
        F.coalesce(F.min(F.nullif(F.col("entity_id"), F.lit(""))), F.lit("")).alias("entity_id"),
    )
    return table.withColumns({"latitude": blank(F.col("place.latitude")), "longitude": blank(F.col("place.longitude"))}).drop("place")


def evidence(rows: DataFrame, by: str = "cluster", fields: tuple[str, ...] = EVIDENCE) -> DataFrame:
    """(by, field, value, observation_id, source, source_id): which observation gave which value of which field.

    What a row's provenance has already stays with those who gave it: the row is no further witness of such a value.
    """
    known = complete(rows).withColumn("observation_id", observation_id()).withColumn("was", F.from_json("provenance", PROVENANCE))
    before = known.select(by, F.explode("was.fields").alias("field", "e")).select(by, "field", F.explode("e").alias("e")).select(by, "field", "e.value", "e.observation_id", "e.source", "e.source_id")
    told = lambda f: F.exists(F.coalesce(F.try_element_at(F.col("was.fields"), F.lit(f)), F.array().cast("array<struct<observation_id: string, source: string, source_id: string, value: string>>")), lambda e: e["value"] == F.col(f))
    own = F.array_compact(F.array(*[F.when((F.col(f) != "") & ~F.coalesce(told(f), F.lit(False)), F.struct(F.lit(f).alias("field"), F.col(f).alias("value"))) for f in fields]))
    now = known.select(by, "observation_id", text.one_space(F.col("source")).alias("source"), "source_id", F.explode(own).alias("p")).select(by, "p.field", "p.value", "observation_id", "source", "source_id")
    return before.unionByName(now).groupBy(by, "field", "value", "observation_id").agg(F.min("source").alias("source"), F.min("source_id").alias("source_id"))


def provenance(rows: DataFrame, fields: tuple[str, ...] = ("name", "city", "phone", "email", "website", "address")) -> DataFrame:
    """Long form of the evidence."""
    return evidence(rows, fields=fields).select("cluster", "observation_id", "source", "field", "value")


def provenance_json(rows: DataFrame, by: str = "cluster") -> DataFrame:
    """(by, provenance): observations and evidence of a cluster as one text, keys in order."""
    known = complete(rows).withColumn("observation_id", observation_id()).withColumn("was", F.from_json("provenance", PROVENANCE))
    now = known.select(by, "first_seen", "last_seen", "observation_id", text.one_space(F.col("source")).alias("source"), "source_id", "source_url")
    all_seen = known.select(by, F.explode("was.observations").alias("o")).select(by, "o.*").unionByName(now)
    filled = [F.coalesce(F.max(F.nullif(F.col(c), F.lit(""))), F.lit("")).alias(c) for c in ("last_seen", "source", "source_id", "source_url")]
    one = all_seen.groupBy(by, "observation_id").agg(F.coalesce(F.min(F.nullif(F.col("first_seen"), F.lit(""))), F.lit("")).alias("first_seen"), *filled)
    seen_ = one.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("observation_id", "first_seen", "last_seen", "source", "source_id", "source_url"))).alias("o"))
    lists = evidence(rows, by).groupBy(by, "field").agg(F.array_sort(F.collect_list(F.struct("observation_id", "source", "source_id", "value"))).alias("e"))
    fields = lists.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "e")))).alias("fields"))
    shaped = F.transform("o", lambda x: F.struct(*[x[c].alias(c) for c in ("first_seen", "last_seen", "observation_id", "source", "source_id", "source_url")]))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<struct<observation_id: string, source: string, source_id: string, value: string>>>"))
    return seen_.join(fields, by, "left").select(by, F.to_json(F.struct(F.coalesce("fields", empty).alias("fields"), shaped.alias("observations"))).alias("provenance"))


def filled(rows: DataFrame, by: str = "cluster", fields: tuple[str, ...] = ("phone", "email", "website", "address", "social")) -> DataFrame:
    """Every row with its empty contacts filled from the best anchors of its cluster, and the flag cross_source_<field> for each."""
    marked = complete(rows)
    given = marked.filter(anchor()).groupBy(by).agg(*[best(f).alias(f"best_{f}") for f in fields])
    joined = marked.join(given, by, "left")
    gets = {f: (F.col(f) == "") & (text.blank(F.col(f"best_{f}")) != "") for f in fields}
    flags = text.union_flags(text.flags(F.col("quality_flags")), F.array_compact(F.array(*[F.when(t, F.lit(f"cross_source_{f}")) for f, t in gets.items()])))
    return joined.withColumns({"quality_flags": F.when(reduce(lambda a, b: a | b, gets.values()), flags).otherwise(F.col("quality_flags"))} | {f: F.when(t, F.col(f"best_{f}")).otherwise(F.col(f)) for f, t in gets.items()}).drop(*[f"best_{f}" for f in fields])

"""Observations: their columns, their identity, and the normal form in which they are loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityspark.functions import contact, geo, taxonomy, text, web

#: The columns of an observation; all are texts.
FIELDS = (
    "observation_id entity_id source source_id source_url sources name city client_type category raw_category address phone email website social comment latitude longitude "
    "matched_query confidence quality_flags all_phones all_emails all_websites all_socials first_seen last_seen parsed_at provenance"
).split()


def complete(rows: DataFrame) -> DataFrame:
    """All fields as texts, empty where there is none; further columns stay."""
    known = [text.blank(F.col(f"`{f}`").cast("string")).alias(f) if f in rows.columns else F.lit("").alias(f) for f in FIELDS]
    return rows.select(*known, *[F.col(f"`{c}`") for c in rows.columns if c not in FIELDS])


def point(c: Column, digits: int = 5) -> Column:
    return F.call_function("format_string", F.lit(f"%.{digits}f"), c)


def material() -> Column:
    """What a sighting is recognised by: its source's id, else its page, address, place, site or phone, else little."""
    blank = text.blank
    source = F.coalesce(F.nullif(F.lower(text.one_space(F.col("source"))), F.lit("")), F.lit("unknown"))
    own, url = F.trim(blank(F.col("source_id"))), F.lower(F.trim(F.coalesce(F.nullif(F.col("source_url"), F.lit("")), F.nullif(F.col("social"), F.lit("")), F.lit(""))))
    name, city, address = text.normal_text(F.col("name")), text.normal_city(F.col("city")), text.normal_address(F.col("address"))
    lat, lon = geo.coordinate(F.col("latitude"), 90), geo.coordinate(F.col("longitude"), 180)
    domain, phone = web.host_of(F.col("website")), contact.phone_digits(F.col("phone"))
    of = lambda kind, *more: F.concat_ws("|", F.lit(kind), source, *more)
    return (
        F.when(own != "", of("source-id", own)).when(url != "", of("source-url", url)).when(address != "", of("address", name, city, address))
        .when(lat.isNotNull() & lon.isNotNull(), of("coords", name, city, F.concat_ws(",", point(lat), point(lon)))).when(domain != "", of("domain", name, city, domain))
        .when(phone != "", of("phone", name, city, phone)).otherwise(of("minimal", name, city, text.normal_text(F.col("category"))))
    )


def observation_id() -> Column:
    """The id that a row has, else one by its material."""
    given = F.trim(text.blank(F.col("observation_id")))
    return F.when(given != "", given).otherwise(F.concat(F.lit("obs_"), F.substring(F.sha2(material(), 256), 1, 24)))


def loaded(rows: DataFrame) -> DataFrame:
    """Rows of result files as observations: cells restored, addresses cleaned, ids, sources and sightings filled in."""
    plain = complete(rows)
    plain = plain.select(*[text.restored_cell(F.col(f)).alias(f) if f in FIELDS else F.col(f"`{f}`") for f in plain.columns])
    mails = contact.cleaned_row(F.col("email"), F.col("all_emails"), web.host_of(F.col("website")))
    seen = lambda f: F.coalesce(F.nullif(F.col(f), F.lit("")), F.col("parsed_at"))
    clean = plain.withColumn("__mails", mails).withColumns({"email": F.col("__mails.email"), "all_emails": F.col("__mails.all_emails")}).drop("__mails")
    return clean.withColumns({"observation_id": observation_id(), "sources": F.coalesce(F.nullif(F.col("sources"), F.lit("")), F.col("source")), "first_seen": seen("first_seen"), "last_seen": seen("last_seen")})


def clean_cell(c: Column) -> Column:
    """Text without tags and references, on one line with single spaces."""
    return F.trim(F.regexp_replace(F.translate(web.unescaped(F.regexp_replace(text.blank(c), "<[^>]+>", " ")), "\r\n\t\u00a0", "    "), r"\s{2,}", " "))


def prepared(items: DataFrame) -> DataFrame:
    """Fresh sightings as they are stored: nameless ones left out, old names of coordinates taken over, lists begun with the
    main contact, cells and addresses cleaned, segment and exclusion flags added."""
    for old, new in (("lat", "latitude"), ("lon", "longitude")):
        if old in items.columns:
            given = F.col(new).cast("string") if new in items.columns else F.lit("")
            items = items.withColumn(new, F.coalesce(F.nullif(given, F.lit("")), F.col(old).cast("string")))
    rows = complete(items).filter("name <> ''")
    rows = rows.withColumns({"observation_id": observation_id(), "sources": F.coalesce(F.nullif(F.col("sources"), F.lit("")), F.col("source"))} | {m: F.coalesce(F.nullif(F.col(m), F.lit("")), F.col(f)) for m, f in (("all_phones", "phone"), ("all_emails", "email"), ("all_websites", "website"), ("all_socials", "social"))})
    rows = rows.select(*[clean_cell(F.col(c)).alias(c) if c in FIELDS and c != "provenance" else F.col(f"`{c}`") for c in rows.columns])
    mails = contact.cleaned_row(F.col("email"), F.col("all_emails"), web.host_of(F.col("website")))
    excluded = taxonomy.exclusion_flags(F.col("name"), F.concat_ws(" ", "category", "raw_category"))
    had = F.filter(F.split("quality_flags", r"\|"), lambda x: x != "")
    flags = F.when(F.size(excluded) > 0, F.array_join(F.array_distinct(F.concat(had, excluded)), "|")).otherwise(F.col("quality_flags"))
    kind = F.coalesce(F.nullif(F.col("client_type"), F.lit("")), taxonomy.segment_of(F.col("category")))
    clean = rows.withColumns({"__mails": mails, "phone": F.when(F.col("phone") != "", contact.phone_text(F.col("phone"))).otherwise(""), "client_type": kind, "quality_flags": flags})
    return clean.withColumns({"email": F.col("__mails.email"), "all_emails": F.col("__mails.all_emails")}).drop("__mails")

"""Outreach: why a row is held back, one row an address, and the sheet that is reviewed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from entityspark.functions import contact, taxonomy, text, web
from entityspark.functions.values import EXCLUDED_FLAGS, HARD_REJECT_FLAGS, OUTREACH_BLOCKS, OUTREACH_PREFIXES
from entityspark.operators import golden, signals
from entityspark.operators.identity import complete

#: The sheet's columns, in order, and their widths.
HEADERS = "Email;Название;Сегмент;Все сегменты;Город;Телефон;Сайт;Соцсеть;Адрес;Повод для КП;Сигналы;Источник;ID объекта;Доверие;Флаги качества;Все email;Все телефоны".split(";")
WIDTHS = [30, 36, 26, 34, 16, 22, 34, 30, 40, 26, 34, 18, 30, 10, 30, 44, 44]


def site_domain() -> Column:
    """The host of a company's own site; empty for a social network or platform."""
    return F.when(web.is_foreign_site(F.col("website")), "").otherwise(web.host_of(F.col("website")))


def email_candidates(host: Column) -> Column:
    """The addresses of a row that may be written to, the best first: the site's own domain, then mail providers, and the
    beginnings that companies use; of equal ones by letter."""
    raw = F.regexp_extract_all(F.concat_ws(" | ", text.blank(F.col("email")), text.blank(F.col("all_emails"))), F.lit(r"(?i)([a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,})"), F.lit(1))
    passed = F.array_distinct(F.array_compact(F.transform(raw, lambda e: contact.cleaned_email(e, host)["email"])))
    open_ = F.filter(passed, lambda e: ~e.rlike(OUTREACH_BLOCKS) & ~web.in_hosts(contact.domain_part(e), taxonomy.BRAND_MAIL_DOMAINS))

    def scored(e: Column) -> Column:
        relation = contact.email_relation(e, host)
        return F.when(relation == "same", 100).when(relation == "free", 10).otherwise(0) + contact.prefix_score(contact.local_part(e), OUTREACH_PREFIXES)

    return F.transform(F.array_sort(F.transform(open_, lambda e: F.struct((-scored(e)).alias("s"), e.alias("e")))), lambda x: x["e"])


def provenance_values(field: str) -> Column:
    """The values of a field in a row's provenance, in order."""
    lists = F.from_json("provenance", golden.PROVENANCE)["fields"]
    return F.coalesce(F.transform(F.try_element_at(lists, F.lit(field)), lambda e: e["value"]), F.array().cast("array<string>"))


def current_exclusions() -> Column:
    """Exclusion flags by the rules of today, over all names that a row has had."""
    names = F.array_distinct(F.concat(F.array(text.blank(F.col("name"))), provenance_values("name")))
    kind = F.concat_ws(" ", text.blank(F.col("category")), text.blank(F.col("raw_category")))
    return F.array_distinct(F.flatten(F.transform(names, lambda n: taxonomy.exclusion_flags(n, kind))))


def all_segments() -> Column:
    keys = F.filter(F.array_distinct(F.concat(F.array(text.blank(F.col("client_type"))), provenance_values("client_type"))), lambda k: k.isin(list(taxonomy.TITLES)))
    return F.array_join(F.transform(keys, taxonomy.title_of), "; ")


def confidence() -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.col("confidence").try_cast("double"), F.lit(0.0))))


def bases(rows: DataFrame, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """(emails, domains) of other bases: their addresses, and the domains that at most ``most`` of their rows have; a host of
    more rows is a platform. Columns: email, all_emails, website, all_websites."""
    known = complete(rows)
    mails = F.regexp_extract_all(F.lower(F.concat_ws(" ", "email", "all_emails")), F.lit(r"([a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,})"), F.lit(1))
    counted = known.select(F.explode(F.array_distinct(site_domains())).alias("domain")).groupBy("domain").agg(F.count("*").alias("n"))
    return known.select(F.explode(mails).alias("email")).distinct(), counted.filter(F.col("n") <= most).select("domain")


def site_domains() -> Column:
    """The company domains among a row's sites."""
    parts = F.split(F.concat_ws(" ", text.blank(F.col("website")), text.blank(F.col("all_websites"))), r"[|,\s]+")
    return F.filter(F.transform(parts, web.host_of), lambda h: (h != "") & ~web.is_shared_host(h))


def in_other_base(rows: DataFrame, emails: DataFrame, domains: DataFrame, key: str = "row_idx") -> DataFrame:
    """(key) of the rows that another base has, by an address or a domain of a site or address."""
    known = complete(rows)
    own = F.array_distinct(F.regexp_extract_all(F.lower(F.concat_ws(" ", "email", "all_emails")), F.lit(r"([a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,})"), F.lit(1)))
    hosts = F.concat(site_domains(), F.filter(F.transform(own, contact.domain_part), lambda h: ~web.is_shared_host(h)))
    by_mail = known.select(key, F.explode(own).alias("email")).join(emails, "email", "left_semi").select(key)
    by_host = known.select(key, F.explode(F.array_distinct(hosts)).alias("domain")).join(domains, "domain", "left_semi").select(key)
    return by_mail.unionByName(by_host).distinct()


def review_reason(least: float = 0.7, competitors: bool = False) -> Column:
    """The first reason that holds a row back; empty for none. Needs ``candidates`` and ``elsewhere``."""
    flags = text.flags(F.col("quality_flags"))
    excluded = F.array_sort(F.array_distinct(F.concat(F.array_intersect(flags, F.array(*map(F.lit, EXCLUDED_FLAGS))), current_exclusions())))
    has = lambda f: F.array_contains(flags, f)
    segment = F.trim(text.blank(F.col("client_type")))
    return (
        F.when(F.trim(text.blank(F.col("name"))) == "", "missing_name").when(F.size(excluded) > 0, F.get(excluded, F.lit(0))).when(~segment.isin(list(taxonomy.TITLES)), "no_segment")
        .when(segment.isin(taxonomy.COMPETITOR_SEGMENTS) & F.lit(not competitors), "competitor_segment").when(F.size("candidates") == 0, "missing_or_invalid_email")
        .when(F.arrays_overlap(flags, F.array(*map(F.lit, HARD_REJECT_FLAGS))), "hard_quality_flag").when(has("vk_weak_contact_donor"), "weak_vk_contact_donor").when(confidence() < least, "low_confidence")
        .when(has("manual_review") & (confidence() < max(least, 0.85)), "manual_review").when(F.col("elsewhere"), "already_in_other_base").otherwise("")
    )


def reviewed(master: DataFrame, other: tuple[DataFrame, DataFrame] | None = None, least: float = 0.7, competitors: bool = False) -> DataFrame:
    """The rows with candidates and review_reason; of rows with one address all but the surest and fullest are duplicate_email."""
    rows = complete(master)
    rows = rows.withColumn("candidates", email_candidates(site_domain()))
    if other:
        found = in_other_base(rows, *other).withColumn("elsewhere", F.lit(True))
        rows = rows.join(found, "row_idx", "left").withColumn("elsewhere", F.coalesce("elsewhere", F.lit(False)))
    else:
        rows = rows.withColumn("elsewhere", F.lit(False))
    judged = rows.withColumn("review_reason", review_reason(least, competitors)).withColumn("to", F.when(F.col("review_reason") == "", F.get("candidates", F.lit(0)))).drop("elsewhere")
    # Rows that are held back have no address to share: spread by row, they don't gather under one key.
    group = F.coalesce("to", F.concat(F.lit("row "), F.col("row_idx").cast("string")))
    order = W.partitionBy(group).orderBy(confidence().desc(), text.completeness(*[F.col(c) for c in ("phone", "website", "social", "address")]).desc(), "row_idx")
    return judged.withColumn("review_reason", F.when(F.col("to").isNotNull() & (F.row_number().over(order) > 1), "duplicate_email").otherwise(F.col("review_reason"))).drop("to")


def sheet(rows: DataFrame) -> DataFrame:
    """The sheet's columns of rows with candidates, signals and pitch, in the order of city, name and address."""
    to = F.get("candidates", F.lit(0))
    parts = F.filter(F.split(text.blank(F.col("quality_flags")), r"\|"), lambda x: x != "")
    foreign = F.when(contact.email_relation(to, site_domain()) == "foreign", F.array(F.lit("email_foreign_domain"))).otherwise(F.array().cast("array<string>"))
    cells = [
        to, F.col("name"), taxonomy.title_of(F.col("client_type")), all_segments(), F.col("city"), F.col("phone"), F.col("website"), F.col("social"), F.col("address"), F.col("pitch"), F.array_join("signals", "; "),
        F.coalesce(F.nullif(F.col("sources"), F.lit("")), F.col("source")), F.col("entity_id"), F.call_function("format_string", F.lit("%.2f"), confidence()), F.array_join(F.array_distinct(F.concat(parts, foreign)), "|"),
        F.array_join("candidates", " | "), F.coalesce(F.nullif(F.col("all_phones"), F.lit("")), F.col("phone")),
    ]
    named = rows.select(*[c.alias(h) for c, h in zip(cells, HEADERS, strict=True)])
    return named.orderBy("Город", "Название", "Email")


def outreach(master: DataFrame, cache: DataFrame, other: tuple[DataFrame, DataFrame] | None = None, least: float = 0.7, competitors: bool = False) -> tuple[DataFrame, DataFrame]:
    """(ready, review): the sheet, and the rows that are held back with their reason."""
    judged = reviewed(master, other, least, competitors)
    return sheet(signals.row_signals(judged.filter("review_reason = ''"), cache)), judged.filter("review_reason <> ''").drop("candidates")


def counts(ready: DataFrame) -> DataFrame:
    """(kind, key, n): ready rows by segment and by signal; of rows with client_type and signals."""
    by_segment = ready.select(F.lit("segment").alias("kind"), F.col("client_type").alias("key"))
    by_signal = ready.select(F.lit("signal").alias("kind"), F.explode("signals").alias("key"))
    return by_segment.unionByName(by_signal).groupBy("kind", "key").agg(F.count("*").alias("n"))

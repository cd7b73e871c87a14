"""Contacts from sites: what a page gives, what a visit gives a row, and the memory of visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityspark.functions import contact, text, web

NEEDS = ("email", "phone", "address", "social")
LISTS = {"all_emails": "email", "all_phones": "phone", "all_socials": "social"}
#: Days that the memory of a visit is good for, by what it gave.
GOOD_DAYS = {"found": 60, "none": 14, "dead": 7}
MEMORY = "host string, status string, checked_at string, " + ", ".join(f"{c} string" for c in (*NEEDS, *LISTS))
MOST_EMAILS = 8


def page_text(html: Column) -> Column:
    """A page with references and escapes read, and the addresses that it hides at its end."""
    hidden = F.concat(*[F.transform(F.regexp_extract_all(html, F.lit(p), F.lit(1)), lambda x: contact.hidden_email(x)) for p in (r"data-cfemail=[\"']([0-9a-fA-F]{6,})[\"']", r"/cdn-cgi/l/email-protection#([0-9a-fA-F]{6,})")])
    plain = text.let(web.unescaped(html), lambda t: F.when(t.contains("%40"), contact.percent_decoded(t)).otherwise(t))
    return F.concat(plain, F.lit("\n"), F.array_join(F.filter(hidden, lambda x: x != ""), "\n"))


def page_contacts(html: Column, host: Column) -> Column:
    """(emails, phones) of a page. Addresses pass the gate; own domain and usual beginnings come first, an address that names
    the branch which the host names is better still, and of equal ones the first on the page; eight at most."""

    def found(t: Column) -> Column:
        spelled = F.filter(F.array(contact.spelled_email(t)), lambda e: e != "")
        raw = F.concat(contact.ranked_emails(t, host), spelled)
        labels = F.split(host, r"\.")
        branch = F.when((F.size(labels) > 2) & (F.length(F.get(labels, F.lit(0))) >= 4), F.get(labels, F.lit(0))).otherwise("")

        def known(e: Column) -> Column:
            at = F.call_function("locate", e, t)
            return F.struct(contact.cleaned_email(e, host)["email"].alias("e"), F.when(at > 0, at).otherwise(F.length(t) + 1).alias("at"))

        def ranked(x: Column) -> Column:
            bonus = F.when((branch != "") & contact.local_part(x["e"]).contains(branch), 60).otherwise(0)
            return F.struct((-(contact.email_score(x["e"], host) + bonus)).alias("s"), x["at"].alias("at"), x["e"].alias("e"))

        passed = F.filter(F.transform(raw, known), lambda x: x["e"].isNotNull())
        ordered = F.transform(F.array_sort(F.transform(passed, ranked)), lambda x: x["e"])
        return F.struct(F.slice(F.array_distinct(ordered), 1, MOST_EMAILS).alias("emails"), contact.found_phones(t).alias("phones"))

    return text.let(page_text(text.blank(html)), found)


def merged(old: Column, new: Column, phones: bool = False) -> Column:
    """Two lists as one, each contact once."""
    identity = (lambda v: F.regexp_replace(v, "[^0-9]", "")) if phones else (lambda v: F.regexp_replace(F.lower(v), "/+$", ""))
    return F.array_join(contact.distinct_by(contact.listed_values(old, new), identity), " | ")


def wants(email_only: bool = True) -> Column:
    """Whether a row lacks what a visit may give."""
    lacks = [text.blank(F.col(f)) == "" for f in (NEEDS[:1] if email_only else NEEDS)]
    return lacks[0] if email_only else lacks[0] | lacks[1] | lacks[2] | lacks[3]


def needs_browser(kind: Column, email_only: bool = True) -> Column:
    """Rows that still lack something, but for those whose site is dead."""
    return wants(email_only) & ~F.coalesce(kind == "dead", F.lit(False))


def is_complete(need: list[str] | None, email: Column, phone: Column, address: Column) -> Column:
    """Whether a visit may end: all that is needed was found; without a list all three."""
    found = {"email": email, "phone": phone, "address": address}
    tests = [text.blank(found[n]) != "" for n in (["email", "phone", "address"] if need is None else need) if n in found]
    result = F.lit(True)
    for t in tests:
        result = result & t
    return result


def visit_order(rows: DataFrame, email_only: bool = True, site_finder: bool = False) -> DataFrame:
    """(row_idx, place) of the rows to work on: those without an address first, then the rest; those without a site last, and only
    where sites are looked for. Social networks and platforms are no sites."""
    site = F.trim(text.blank(F.col("website")))
    work = rows.filter(wants(email_only) & (((site != "") & ~web.is_foreign_site(site)) | ((site == "") & F.lit(site_finder))))
    return work.select("row_idx", F.when(site == "", 2).when(text.blank(F.col("email")) == "", 0).otherwise(1).alias("place"))


def hosts(rows: DataFrame) -> DataFrame:
    """(host, website) to visit: one visit a host, by its first row's address."""
    known = rows.withColumn("host", web.host_of(F.col("website"))).filter((F.col("host") != "") & ~web.is_foreign_site(F.col("website")))
    return known.groupBy("host").agg(F.min_by("website", "row_idx").alias("website"))


def visited(pages: DataFrame) -> DataFrame:
    """(host, kind, emails, phones, n_pages) from the pages of a visit: host, page_no, kind, html. The first page with addresses
    gives them, the first with phones those; without any page the kinds tell whether a host is blocked, dead or unknown."""
    ok = F.col("kind") == "ok"
    c = page_contacts(F.col("html"), F.col("host"))
    rows = pages.withColumn("c", F.when(ok, c)).withColumn("dead", F.col("kind").isin("unreachable", "error"))
    first = lambda f: F.min_by(F.when(F.size(F.col("c")[f]) > 0, F.col("c")[f]), F.when(F.size(F.col("c")[f]) > 0, F.col("page_no")))
    none = F.array().cast("array<string>")
    table = rows.groupBy("host").agg(F.max(ok).alias("ok"), F.max(F.col("kind") == "blocked").alias("blocked"), F.min("dead").alias("dead"), F.count_if(ok).alias("n_pages"), first("emails").alias("emails"), first("phones").alias("phones"))
    kind = F.when(F.col("ok"), "ok").when(F.col("blocked"), "blocked").when(F.col("dead"), "dead").otherwise("unknown")
    return table.select("host", kind.alias("kind"), F.coalesce("emails", none).alias("emails"), F.slice(F.coalesce("phones", none), 1, 3).alias("phones"), "n_pages")


def no_outage(visits: DataFrame, least: int = 10, share: float = 0.8) -> DataFrame:
    """Visits with dead hosts as unknown ones where nearly all are dead."""
    total = visits.agg(((F.count("*") >= least) & (F.avg((F.col("kind") == "dead").cast("int")) >= share)).alias("outage"))
    return visits.crossJoin(F.broadcast(total)).withColumn("kind", F.when(F.col("outage") & (F.col("kind") == "dead"), "unknown").otherwise(F.col("kind"))).drop("outage")  # one row


def apply_visits(rows: DataFrame, visits: DataFrame) -> DataFrame:
    """All rows of a host get what its one visit gave: the first address and phone where they have none, all in their lists."""
    found = visits.select(F.col("host").alias("__host"), "emails", "phones")
    joined = rows.withColumn("__site", web.host_of(F.col("website"))).join(found, F.col("__site") == F.col("__host"), "left")
    none, b = F.array().cast("array<string>"), text.blank
    emails, phones = F.coalesce("emails", none), F.coalesce("phones", none)
    fill = lambda f, new: F.coalesce(F.nullif(b(F.col(f)), F.lit("")), F.get(new, F.lit(0)), F.lit(""))
    union = lambda many, f, new, phones_: F.when(F.size(new) > 0, merged(F.coalesce(F.nullif(b(F.col(many)), F.lit("")), fill(f, new)), F.array_join(new, " | "), phones_)).otherwise(b(F.col(many)))
    return joined.withColumns({"email": fill("email", emails), "phone": fill("phone", phones), "all_emails": union("all_emails", "email", emails, False), "all_phones": union("all_phones", "phone", phones, True)}).drop("__site", "__host", "emails", "phones")


def fresh(memory: DataFrame, now: str) -> DataFrame:
    """Entries that are young enough for what they hold."""
    good = F.when(F.col("status") == "found", GOOD_DAYS["found"]).when(F.col("status") == "none", GOOD_DAYS["none"]).when(F.col("status") == "dead", GOOD_DAYS["dead"])
    return memory.filter(F.coalesce(F.try_to_timestamp("checked_at") > F.to_timestamp(F.lit(now)) - F.make_dt_interval(good), F.lit(False)))


def apply_memory(rows: DataFrame, memory: DataFrame, now: str) -> DataFrame:
    """The rows with what earlier visits found, and ``pending``: whether they are still to be worked on. Addresses pass today's gate."""
    b = text.blank
    known = fresh(memory, now).select(F.col("host").alias("__host"), F.col("status").alias("__status"), *[b(F.col(c)).alias(f"__{c}") for c in (*NEEDS, *LISTS)])
    joined = rows.withColumn("__site", web.host_of(F.col("website"))).join(known, (F.col("__site") == F.col("__host")) & (F.col("__site") != ""), "left")
    hit = F.coalesce(F.col("__status") == "found", F.lit(False))
    fill = lambda f: F.when(hit & (b(F.col(f)) == ""), F.col(f"__{f}")).otherwise(b(F.col(f)))
    lists = {m: F.when(hit & (F.col(f"__{m}") != ""), merged(F.coalesce(F.nullif(b(F.col(m)), F.lit("")), fill(f)), F.col(f"__{m}"), m == "all_phones")).otherwise(b(F.col(m))) for m, f in LISTS.items()}
    given = joined.withColumns({f: fill(f) for f in NEEDS} | lists)
    mails = contact.cleaned_row(F.col("email"), F.col("all_emails"), F.col("__site"))
    clean = given.withColumn("__m", F.when(hit, mails)).withColumns({"email": F.when(hit, F.col("__m.email")).otherwise(F.col("email")), "all_emails": F.when(hit, F.col("__m.all_emails")).otherwise(F.col("all_emails"))})
    pending = F.col("__status").isNull() | (hit & (F.col("email") == ""))
    return clean.withColumn("pending", pending).drop(*[c for c in clean.columns if c.startswith("__")])


def apply_browser(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows with what a browser found on their host: needed fields that were empty, lists united. ``found``: host and the seven contacts."""
    b = text.blank
    known = found.select(F.col("host").alias("__host"), *[b(F.col(c)).alias(f"__{c}") for c in (*NEEDS, *LISTS)])
    joined = rows.withColumn("__site", web.host_of(F.col("website"))).join(known, (F.col("__site") == F.col("__host")) & (F.col("__site") != ""), "left")
    mails = contact.cleaned_row(F.col("__email"), F.col("__all_emails"), F.col("__site"))
    joined = joined.withColumn("__m", F.when(F.col("__host").isNotNull(), mails)).withColumns({"__email": b(F.col("__m.email")), "__all_emails": b(F.col("__m.all_emails"))})
    fill = lambda f: F.coalesce(F.nullif(b(F.col(f)), F.lit("")), F.col(f"__{f}"), F.lit(""))
    lists = {m: F.when(b(F.col(f"__{m}")) != "", merged(F.coalesce(F.nullif(b(F.col(m)), F.lit("")), fill(f)), F.col(f"__{m}"), m == "all_phones")).otherwise(b(F.col(m))) for m, f in LISTS.items()}
    out = joined.withColumns({f: fill(f) for f in NEEDS} | lists)
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def remembered(memory: DataFrame, visits: DataFrame, now: str) -> DataFrame:
    """The memory after static visits: what was found, and hosts that are dead; other outcomes leave it as it is."""
    status = F.when(F.size("emails") > 0, "found").when(F.col("kind") == "dead", "dead")
    first = lambda a: F.coalesce(F.get(F.col(a), F.lit(0)), F.lit(""))
    gave = {"email": first("emails"), "all_emails": F.array_join("emails", " | "), "phone": first("phones"), "all_phones": F.array_join("phones", " | ")}
    found = F.col("status") == "found"
    new = visits.withColumn("status", status).filter("status is not null").select("host", "status", F.lit(now).alias("checked_at"), *[F.when(found, gave[c]).otherwise("").alias(c) if c in gave else F.lit("").alias(c) for c in (*NEEDS, *LISTS)])
    return memory.join(new, "host", "left_anti").unionByName(new)


def page_email(html: Column) -> Column:
    """The first address of a social page that stands outside scripts and styles and is not the network's own."""
    bare = F.regexp_replace(text.blank(html), r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    found = F.regexp_extract_all(bare, F.lit(r"([a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z]{2,})"), F.lit(1))
    theirs = lambda e: F.lower(contact.domain_part(e)).rlike(r"vk\.com|vkontakte\.ru|noreply")
    return F.coalesce(F.get(F.filter(found, lambda e: ~theirs(e)), F.lit(0)), F.lit(""))


def apply_social(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows that still lack an address get the one of their page on the social network. ``pages``: social, html."""
    found = pages.filter(F.col("social").contains("vk.com")).groupBy("social").agg(F.min(page_email(F.col("html"))).alias("__found"))
    joined = rows.join(found, "social", "left")
    mail = contact.cleaned_email(F.col("__found"), web.host_of(F.col("website")))["email"]
    gets = (text.blank(F.col("email")) == "") & F.col("__mail").isNotNull()
    with_mail = joined.withColumn("__mail", F.when(text.blank(F.col("__found")) != "", mail))
    return with_mail.withColumns({"all_emails": F.when(gets, merged(F.col("all_emails"), F.col("__mail"))).otherwise(text.blank(F.col("all_emails"))), "email": F.when(gets, F.col("__mail")).otherwise(text.blank(F.col("email")))}).drop("__found", "__mail")

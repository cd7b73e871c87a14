"""What sites show: which to probe, verdicts of a probe, the cache of them, and the signals of a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from entityspark.functions import taxonomy, text, web
from entityspark.functions.values import EXCLUDED_FLAGS

#: Days that a verdict is good for: of a working site, and of any other.
GOOD_DAYS, RECHECK_DAYS = 30, 7
#: Of so many sites at least, this share dead tells of our own network.
OUTAGE_SITES, OUTAGE_SHARE = 10, 0.8
CACHE = "host string, signals array<string>, checked_at string, status string"


def eligible() -> Column:
    """Whether a row can reach outreach: a known segment, an address, no exclusion."""
    known = F.col("client_type").isin(list(taxonomy.TITLES))
    flags = F.transform(F.split(text.blank(F.col("quality_flags")), r"\|"), lambda x: F.trim(x))
    return known & F.concat(text.blank(F.col("email")), text.blank(F.col("all_emails"))).contains("@") & ~F.arrays_overlap(flags, F.array(*map(F.lit, EXCLUDED_FLAGS)))


def targets(master: DataFrame) -> DataFrame:
    """(host, booking, eligible): one row a site, over its companies."""
    rows = master.withColumn("host", web.host_of(F.col("website"))).filter((F.col("host") != "") & ~web.is_foreign_site(F.col("website")))
    booking = F.coalesce(F.col("client_type").isin(taxonomy.BOOKING_SEGMENTS), F.lit(False))
    return rows.groupBy("host").agg(F.max(booking).alias("booking"), F.max(F.coalesce(eligible(), F.lit(False))).alias("eligible"))


def status_of() -> Column:
    """Of a cache entry: its own, or told by its signals where older entries have none."""
    dead = F.coalesce(F.array_contains("signals", "site_dead"), F.lit(False))
    return F.coalesce(F.nullif(F.col("status"), F.lit("")), F.when(dead, "dead").otherwise("ok"))


def is_fresh(now: str, days: int = GOOD_DAYS) -> Column:
    good = F.when(status_of() == "ok", days).otherwise(min(days, RECHECK_DAYS))
    checked = F.try_to_timestamp(F.col("checked_at"))
    return F.coalesce(checked > F.to_timestamp(F.lit(now)) - F.make_dt_interval(good), F.lit(False))


def stale(sites: DataFrame, cache: DataFrame, now: str, days: int = GOOD_DAYS) -> DataFrame:
    """Targets without a fresh verdict, with checked_at of the old one."""
    known = cache.select("host", is_fresh(now, days).alias("fresh"), "checked_at", F.lit(True).alias("cached"))
    return sites.join(known, "host", "left").filter(~F.coalesce("fresh", F.lit(False))).select("host", "booking", "eligible", F.coalesce("cached", F.lit(False)).alias("cached"), text.blank(F.col("checked_at")).alias("checked_at"))


def batch(queue: DataFrame, most: int = 400) -> DataFrame:
    """The first of the queue: what can reach outreach, then what was never checked, then the oldest; 0 takes all."""
    order = [F.col("eligible").desc(), "cached", "checked_at", "host"]
    return queue.orderBy(*order).limit(most) if most else queue


def probed(attempts: DataFrame, year: int, checked_at: str) -> DataFrame:
    """Cache entries from attempts: host, booking, https, https_html, http, http_html."""
    verdict = web.probe_verdict(F.col("https"), F.col("http"))
    rows = attempts.withColumn("v", verdict).withColumn("html", F.when(F.col("https") == "ok", F.col("https_html")).otherwise(F.col("http_html")))
    parked = F.col("v.has_page") & web.is_parked(F.col("html"))
    status = F.when(parked, "dead").otherwise(F.col("v.status"))
    found = F.concat(F.when(F.col("v.no_https"), F.array(F.lit("no_https"))).otherwise(F.array().cast("array<string>")), web.signals(F.col("html"), F.col("booking"), year))
    listed = F.when(status == "dead", F.array(F.lit("site_dead"))).when(status == "ok", web.ordered_signals(found)).otherwise(F.array().cast("array<string>"))
    return rows.select("host", listed.alias("signals"), F.lit(checked_at).alias("checked_at"), status.alias("status"))


def without_outage(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The results of a batch; where nearly all sites of it are dead, the dead ones are left out."""
    keys = by or []
    share = results.groupBy(*keys).agg(F.count("*").alias("n"), F.avg((F.col("status") == "dead").cast("int")).alias("dead"))
    outage = share.select(*keys, ((F.col("n") >= OUTAGE_SITES) & (F.col("dead") >= OUTAGE_SHARE)).alias("outage"))
    joined = results.join(outage, keys) if keys else results.crossJoin(F.broadcast(outage))  # one row
    return joined.filter(~(F.col("outage") & (F.col("status") == "dead"))).drop("outage")


def upserted(cache: DataFrame, results: DataFrame) -> DataFrame:
    """The cache with new entries in place of old ones."""
    return cache.join(results, "host", "left_anti").unionByName(results)


def row_signals(rows: DataFrame, cache: DataFrame) -> DataFrame:
    """The rows with ``signals`` and ``pitch``: no_website, what the cache knows, or not_checked."""
    known = cache.select(F.col("host").alias("__host"), status_of().alias("__status"), F.col("signals").alias("__signals"))
    joined = rows.withColumn("__site", web.host_of(F.col("website"))).join(known, F.col("__site") == F.col("__host"), "left")
    none = (F.trim(text.blank(F.col("website"))) == "") | web.is_foreign_site(F.col("website"))
    open_ = F.col("__host").isNull() | F.col("__status").isin("blocked", "unknown")
    found = F.when(none, F.array(F.lit("no_website"))).when(open_, F.array(F.lit("not_checked"))).otherwise(web.ordered_signals(F.coalesce("__signals", F.array().cast("array<string>"))))
    return joined.withColumn("signals", found).withColumn("pitch", web.pitch(F.col("signals"))).drop("__site", "__host", "__status", "__signals")


def refresh_stats(sites: DataFrame, cache: DataFrame, now: str, most: int = 400) -> DataFrame:
    """One row: sites, fresh, checked and pending of a run."""
    n, old = sites.agg(F.count("*").alias("sites")), stale(sites, cache, now).agg(F.count("*").alias("stale"))
    checked = F.least("stale", F.lit(most)) if most else F.col("stale")
    return n.crossJoin(F.broadcast(old)).select("sites", (F.col("sites") - F.col("stale")).alias("fresh"), checked.cast("long").alias("checked"), (F.col("stale") - checked).cast("long").alias("pending"))  # one row


#: Outcomes of a map's requests that count as failures, those of its details, and walls against robots.
FAILURES = "timeout navigation_error markup_error blocked captcha search_timeout search_navigation_error search_markup_error search_blocked search_captcha".split()
DETAILS = "ok empty timeout navigation_error markup_error blocked captcha".split()
WALLS = "captcha blocked search_captcha search_blocked".split()


def breaker(attempts: DataFrame, by: list[str], order: list[str], last: int = 20, failed: float = 0.5, empty: float = 0.8, walls: int = 1, in_a_row: int = 6) -> DataFrame:
    """(by, seq, reason): the first attempt after which a source stays off, and why. Column: status.

    It is off after so many walls, so many failures in a row, or where of the last ``last`` attempts (ten at least) too many
    failed, or too many of the details among them were empty.
    """
    s = F.col("status")
    w = W.partitionBy(*by).orderBy(*order)
    recent = w.rowsBetween(1 - last, 0)
    count = lambda test, over: F.sum(F.coalesce(test, F.lit(False)).cast("int")).over(over)
    seq = attempts.withColumn("seq", F.row_number().over(w).cast("long")).withColumn("island", count(s.isin("ok", "empty", "search_no_results"), w))
    run = W.partitionBy(*by, "island").orderBy(*order)
    least, n = min(10, last), F.count("*").over(recent)
    details = count(s.isin(DETAILS), recent)
    reason = (
        F.when(count(s.isin(WALLS), w) >= walls, F.concat(F.lit("yandex_"), s)).when(count(s.isin(FAILURES), run) >= in_a_row, "consecutive_detail_failures")
        .when((n >= least) & (count(s.isin(FAILURES), recent) >= failed * n), "high_detail_failure_ratio").when((details >= least) & (count(s == "empty", recent) >= empty * details), "high_empty_detail_ratio")
    )
    off = seq.withColumn("reason", reason).filter("reason is not null")
    return off.groupBy(*by).agg(F.min(F.struct("seq", "reason")).alias("x")).select(*by, "x.*")

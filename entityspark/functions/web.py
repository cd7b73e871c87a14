"""URLs, hosts and what stands in pages."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityspark.functions.text import blank, let, one_space
from entityspark.functions.values import CONTACT_HINTS, DEFAULT_PITCH, FREE_MAIL_HOSTS, PITCHES, PLATFORM_HOSTS, PROFILE_HOSTS, SHARE_PARTS, SIGNAL_ORDER, SITEMAP_HINTS, SOCIAL_HOSTS

#: What a page shows of its builder, its bookings, its age, and of a domain without a site.
BUILDERS = r"(?i)tildacdn\.com|tilda\.ws|data-tilda|wixstatic\.com|wix\.com|\.ucoz\.|ucoz\.ru|narod\.ru|nethouse\.ru|ukit\.com|flexbe\.|craftum\."
BOOKING = r"(?i)yclients|dikidi|sonline|записаться|запись онлайн|онлайн[- ]запись|appointment"
OLD = r"(?i)jquery[-.]?1\.[0-9]|\.swf\b|shockwave-flash|<table[^>]+width=[\"']?[0-9]{3,4}"
YEARS = r"(?i)(?:©|&copy;|copyright)[^<]{0,40}?((?:19|20)[0-9]{2})(?:\s*[-–—]\s*((?:19|20)[0-9]{2}))?"
PARKED = r"(?iu)домен\s+(?:продается|продаётся|припаркован|зарегистрирован)|this domain (?:is for sale|may be for sale)|parked (?:free|domain)|hosting account (?:has been )?suspended"
ADDRESS = (
    r"\b(?iu:(?:г\.|город|пгт\.|посёлок|поселок|с\.|село|д\.|деревня))\s+[А-ЯЁ][А-Яа-яЁё\-]{2,}[^\n\r]{0,40}?"
    r"(?iu:(?:ул\.|улица|пр-т|проспект|пр\.|пер\.|переулок|ш\.|шоссе|пл\.|площадь|наб\.|набережная|просп\.|бульвар|б-р))[^\n\r]{3,100}"
)


def host_of(url: Column) -> Column:
    """Lower-case host without www, port and trailing dots; the scheme may be missing."""
    whole = F.trim(blank(url))
    rest = F.regexp_replace(whole, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(rest, r"^(?:[^/?#@]*@)?([^/?#:]*)", 1), r"\.+$", ""))
    return F.regexp_replace(host, r"^www\.", "")


def punycode(label: Column) -> Column:
    """A label behind ``xn--`` as it reads (RFC 3492); null where it is none. The state of the decoder runs over the letters."""
    cut = F.length(label) - F.length(F.substring_index(label, "-", -1))
    basic = F.when(cut > 0, F.substring(label, F.lit(1), cut - 1)).otherwise("")
    chars = F.split(F.substring(label, cut + 1, F.lit(64)), "(?<=.)(?=.)")
    state = lambda out, n, i, bias, old, w, k, bad: F.struct(out.alias("out"), n.cast("long").alias("n"), i.cast("long").alias("i"), bias.cast("long").alias("bias"), old.cast("long").alias("old"), w.cast("long").alias("w"), k.cast("long").alias("k"), bad.alias("bad"))

    def adapted(delta: Column, size: Column, first: Column) -> Column:
        start = F.floor(delta / F.when(first, 700).otherwise(2))
        sized = start + F.floor(start / size)

        def shrunk(d: Column) -> Column:
            steps = sum((d > 455 * 35**k).cast("long") for k in range(4))
            left = F.floor(d / F.pow(F.lit(35), steps))
            return F.floor(36 * left / (left + 38)) + 36 * steps

        return let(sized, shrunk)

    def step(a: Column, c: Column) -> Column:
        digit = F.when(c.rlike("[a-z]"), F.ascii(c) - 97).when(c.rlike("[0-9]"), F.ascii(c) - 22)
        t = F.when(a["k"] <= a["bias"], 1).when(a["k"] >= a["bias"] + 26, 26).otherwise(a["k"] - a["bias"])

        def moved(x: Column) -> Column:
            size = F.length(a["out"]) + 1
            n, at = a["n"] + F.floor(x["i"] / size), F.pmod(x["i"], size)
            grown = F.concat(F.substring(a["out"], F.lit(1), at.cast("int")), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"), F.substring(a["out"], at.cast("int") + 1, F.lit(64)))
            done = state(grown, n, at + 1, adapted(x["i"] - a["old"], size, a["old"] == 0), at + 1, F.lit(1), F.lit(36), a["bad"] | (n > 0x10FFFF))
            more = state(a["out"], a["n"], x["i"], a["bias"], a["old"], a["w"] * (36 - x["t"]), a["k"] + 36, a["bad"])
            return F.when(x["digit"] < x["t"], done).otherwise(more)

        known = let(F.struct(digit.alias("digit"), t.alias("t"), (a["i"] + digit * a["w"]).alias("i")), moved)
        return F.when(a["bad"] | digit.isNull() | (a["w"] > 1 << 40), state(a["out"], a["n"], a["i"], a["bias"], a["old"], a["w"], a["k"], F.lit(True))).otherwise(known)

    zero = F.lit(0)
    end = F.aggregate(chars, state(basic, F.lit(128), zero, F.lit(72), zero, F.lit(1), F.lit(36), F.lit(False)), step)
    return let(end, lambda a: F.when(~a["bad"] & (a["k"] == 36), a["out"]))


def unicode_host(host: Column) -> Column:
    """A host in lower case without www and trailing dots, punycode as it reads; as it was where it can't be read."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(F.trim(blank(host))), r"\.+$", ""), r"^www\.", "")

    def read(h: Column) -> Column:
        labels = F.transform(F.split(h, r"\."), lambda x: F.when(x.startswith("xn--"), punycode(F.substring(x, 5, 64))).otherwise(x))
        return let(labels, lambda parts: F.when(F.exists(parts, lambda x: x.isNull()), h).otherwise(F.array_join(parts, ".")))

    return let(bare, lambda h: F.when(h.contains("xn--"), read(h)).otherwise(h))


def in_hosts(host: Column, hosts: list[str]) -> Column:
    """The host is one of these or below one: its endings are looked up, however long the list is."""
    known = F.array(*[F.lit(h) for h in hosts])
    parts = F.split(host, r"\.")
    endings = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))
    return F.arrays_overlap(endings, known)


def is_foreign_site(url: Column) -> Column:
    """A social network or platform stands where a company's site should."""
    return (host_of(url) != "") & in_hosts(host_of(url), SOCIAL_HOSTS + PLATFORM_HOSTS)


def clean_site(c: Column) -> Column:
    """The first word as an address with a scheme, without query, fragment and slashes at its end; empty where it names no host."""
    first = F.regexp_extract(F.trim(blank(c)), r"^(\S+)", 1)
    whole = F.when(first == "", "").when(first.startswith("http"), first).otherwise(F.concat(F.lit("https://"), first))
    return F.regexp_replace(F.regexp_extract(whole, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+[^?#]*)", 1), "/+$", "")


def origin(url: Column) -> Column:
    return F.regexp_extract(blank(url), r"^(https?://[^/?#]+)", 1)


def org_id(url: Column) -> Column:
    return F.regexp_extract(blank(url), r"/([0-9]{6,})(?:[/?#]|$)", 1)


def links(html: Column) -> Column:
    """Distinct targets without fragments, in order."""
    raw = F.regexp_extract_all(blank(html), F.lit("href=[\"']([^\"'#]+)"), F.lit(1))
    return F.array_distinct(raw)


def absolute(base: Column, link: Column) -> Column:
    """A link as seen from a page, without its fragment."""
    link = F.regexp_replace(F.trim(blank(link)), "#.*$", "")
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_replace(F.when(path == "", "/").otherwise(path), "[^/]*$", "")
    # Each . and .. of the path takes its place in turn; what climbs above the site stays on it.
    flat = lambda p: F.aggregate(F.split(p, "/", -1), F.array().cast("array<string>"), lambda a, x: F.when(x == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(1)))).when(x == ".", a).otherwise(F.concat(a, F.array(x))), lambda a: F.array_join(a, "/"))
    parts = lambda p: F.concat(flat(F.regexp_replace(F.regexp_extract(p, r"^([^?]*)", 1), r"/\.{1,2}$", "$0/")), F.regexp_extract(p, r"(\?.*)?$", 0))
    return (
        F.when(link == "", F.regexp_replace(base, "#.*$", "")).when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link).when(link.startswith("//"), F.concat(F.regexp_extract(base, "^([^:]+:)", 1), link))
        .when(link.startswith("/"), F.concat(site, parts(link))).when(link.startswith("?"), F.concat(site, path, link)).otherwise(F.concat(site, parts(F.concat(folder, link))))
    )


def net_location(url: Column) -> Column:
    """Host and port without www, lower case."""
    return F.regexp_replace(F.lower(F.regexp_extract(blank(url), "^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)", 1)), r"^www\.", "")


def contact_links(html: Column, page: Column, most: int = 4) -> Column:
    """The first links of the same site whose path or text tells of contacts."""
    anchor = r"(?is)<a\b[^>]*?href=[\"']([^\"'#][^\"']*)[\"'][^>]*>(.*?)</a>"
    hrefs, labels = (F.regexp_extract_all(blank(html), F.lit(anchor), F.lit(k)) for k in (1, 2))
    pairs = F.arrays_zip(hrefs.alias("href"), labels.alias("label"))
    known = F.transform(pairs, lambda x: F.struct(x["href"].alias("href"), absolute(page, x["href"]).alias("url"), F.lower(F.regexp_replace(x["label"], "<[^>]+>", " ")).alias("label")))

    def fits(x: Column) -> Column:
        about = F.concat(F.lower(F.regexp_extract(x["url"], "^[^:]+://[^/?#]*([^?#]*)", 1)), F.lit(" "), x["label"])
        hints = F.exists(F.array(*map(F.lit, CONTACT_HINTS)), lambda h: about.contains(h))
        return ~x["href"].rlike("^(?:mailto:|tel:|javascript:)") & x["url"].rlike("^https?://") & (net_location(x["url"]) == net_location(page)) & hints

    return F.slice(F.array_distinct(F.transform(F.filter(known, fits), lambda x: x["url"])), 1, most)


def sitemap_links(xml: Column, most: int = 5) -> Column:
    """The first addresses of a sitemap that tell of contacts."""
    found = F.transform(F.regexp_extract_all(blank(xml), F.lit(r"(?is)<(?:\w+:)?loc>\s*(.*?)\s*</(?:\w+:)?loc>"), F.lit(1)), unescaped)
    return F.slice(F.filter(found, lambda u: F.exists(F.array(*map(F.lit, SITEMAP_HINTS)), lambda h: F.lower(u).contains(h))), 1, most)


def profiles(html: Column) -> Column:
    """Distinct links to profiles on social networks, without their queries; links that share are passed over."""
    links_ = F.filter(F.regexp_extract_all(blank(html), F.lit("<a\\b[^>]*?href=[\"'](http[^\"']*)[\"']"), F.lit(1)), lambda u: F.exists(F.array(*map(F.lit, PROFILE_HOSTS)), lambda h: net_location(u).contains(h)))
    own = F.filter(links_, lambda u: ~F.exists(F.array(*map(F.lit, SHARE_PARTS)), lambda p: F.lower(u).contains(p)))
    bare = F.transform(own, lambda u: F.substring_index(u, "?", 1))
    ids = F.transform(bare, lambda u: F.regexp_replace(F.lower(u), "/+$", ""))
    return let(F.struct(bare.alias("u"), ids.alias("k")), lambda x: F.filter(x["u"], lambda u, i: F.array_position(x["k"], F.get(x["k"], i)) == i + 1))


ENTITIES = {"quot": '"', "apos": "'", "lt": "<", "gt": ">", "nbsp": "\u00a0", "copy": "©", "laquo": "«", "raquo": "»", "mdash": "—", "ndash": "–", "commat": "@", "period": "."}


def unescaped(c: Column) -> Column:
    """Named and numbered character references as the characters they stand for."""
    char = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    parts = F.split(c, r"(?=&#[xX]?[0-9a-fA-F]{1,6};)|(?<=&#[xX]?[0-9a-fA-F]{1,6};)", -1)

    def read(x: Column) -> Column:
        number = F.when(x.rlike("^&#[xX][0-9a-fA-F]{1,6};$"), F.conv(F.regexp_extract(x, "([0-9a-fA-F]+);$", 1), 16, 10).cast("long")).when(x.rlike("^&#[0-9]{1,6};$"), F.regexp_extract(x, "([0-9]+)", 1).cast("long"))
        return let(number, lambda n: F.when((n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF), char(n)).otherwise(x))

    found = F.when(c.contains("&#"), F.array_join(F.transform(parts, read), "")).otherwise(c)
    for name, char_ in ENTITIES.items():
        found = F.replace(found, F.lit(f"&{name};"), F.lit(char_))
    return F.replace(found, F.lit("&amp;"), F.lit("&"))


def is_parked(html: Column) -> Column:
    return blank(html).rlike(PARKED)


def text_address(text: Column) -> Column:
    """The first postal address of a text: a place, a street and what follows, up to 200 characters."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.regexp_extract(blank(text), f"({ADDRESS})", 1), r"\s{2,}", " "), r"^[ ,.;]+|[ ,.;]+$", ""), 1, 200)


def linked_data(html: Column) -> Column:
    """The blocks of linked data of a page."""
    return F.regexp_extract_all(blank(html), F.lit("(?is)<script[^>]+type=[\"']application/ld\\+json[\"'][^>]*>(.*?)</script>"), F.lit(1))


#: How deep blocks of linked data are read by the functions below.
PLACES = ["$", "$.address", "$[0]", "$[0].address", "$.@graph[0]", "$.@graph[0].address", "$.@graph[1]", "$.@graph[1].address", "$.location.address", "$.mainEntity", "$.mainEntity.address", "$.publisher", "$.publisher.address", "$.contactPoint", "$.contactPoint[0]"]


def linked_value(html: Column, key: str) -> Column:
    """The first text under a key, at the places where pages put it."""
    found = F.transform(linked_data(html), lambda x: F.coalesce(*[F.nullif(F.trim(F.get_json_object(x, f"{p}.{key}")), F.lit("")) for p in PLACES], F.lit("")))
    return F.coalesce(F.get(F.filter(found, lambda v: (v != "") & ~v.rlike(r"^[\[{]")), F.lit(0)), F.lit(""))


def linked_address(html: Column) -> Column:
    """Locality and street of the first postal address in a page's linked data, or the address that is a text."""
    def of(block: Column) -> Column:
        def place(p: str) -> Column:
            at = lambda k: F.trim(blank(F.get_json_object(block, f"{p}.{k}")))
            town = F.coalesce(F.nullif(at("addressLocality"), F.lit("")), F.nullif(at("addressRegion"), F.lit("")))
            kind = blank(F.get_json_object(block, f"{p}['@type']"))
            postal = F.when(kind.contains("PostalAddress") | at("type").contains("PostalAddress"), F.concat_ws(", ", town, F.nullif(at("streetAddress"), F.lit(""))))
            plain = F.when((F.length(at("address")) > 8) & ~at("address").rlike(r"^[\[{]"), at("address"))
            return F.coalesce(F.nullif(postal, F.lit("")), plain)

        return F.coalesce(*[place(p) for p in PLACES])

    found = F.get(F.filter(F.transform(linked_data(html), of), lambda v: v.isNotNull()), F.lit(0))
    return F.substring(F.regexp_replace(F.regexp_replace(blank(found), r"\s{2,}", " "), r"^[ ,.;]+|[ ,.;]+$", ""), 1, 200)


def title(html: Column) -> Column:
    """The first heading, else the title, of 3 to 200 characters."""
    tags = lambda c: one_space(F.regexp_replace(c, "<[^>]+>", " "))
    fits = lambda c: F.when(F.length(c).between(3, 200), c)
    return F.coalesce(fits(tags(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1))), fits(tags(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))), F.lit(""))


def plain_text(html: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(blank(html), r"(?is)<script[^>]*>.*?</script>", " "), r"(?is)<style[^>]*>.*?</style>", " ")
    return one_space(F.regexp_replace(bare, "<[^>]+>", " "))


def signals(html: Column, booking: Column, year: int) -> Column:
    """What a page lacks, in the order of the checks."""
    years = F.concat(*[F.transform(F.regexp_extract_all(blank(html), F.lit(YEARS), F.lit(k)), lambda y: y.try_cast("int")) for k in (1, 2)])
    old = F.coalesce(F.array_max(years) <= year - 3, F.lit(False)) | blank(html).rlike(OLD)
    checks = [(~blank(html).rlike("(?i)<meta[^>]+name=[\"']?viewport"), "no_mobile"), (booking & ~blank(html).rlike(BOOKING), "no_online_booking"), (blank(html).rlike(BUILDERS), "site_builder"), (old, "outdated")]
    return F.filter(F.array(*[F.when(c, F.lit(n)) for c, n in checks]), lambda x: x.isNotNull())


def ordered_signals(found: Column) -> Column:
    return F.filter(F.array(*map(F.lit, SIGNAL_ORDER)), lambda s: F.array_contains(found, s))


def pitch(found: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in PITCHES.items() for x in kv])
    return F.coalesce(F.try_element_at(names, F.get(ordered_signals(found), F.lit(0))), F.lit(DEFAULT_PITCH))


DEAD_KINDS = ("unreachable", "error", "unstable")


def probe_verdict(https: Column, http: Column) -> Column:
    """(status, has_page, no_https) of a site from the outcomes of both schemes; http is looked at only where https gave
    neither a page nor a wall against robots."""
    kind = lambda c: F.coalesce(c, F.lit("unknown"))
    failed = kind(https).isin(*DEAD_KINDS)
    status = (
        F.when(kind(https) == "blocked", "blocked").when(kind(https) == "ok", "ok").when(kind(http) == "ok", "ok").when(kind(http) == "blocked", "blocked")
        .when(failed & kind(http).isin(*DEAD_KINDS), "dead").otherwise("unknown")
    )
    return F.struct(status.alias("status"), (status == "ok").alias("has_page"), ((status == "ok") & (kind(https) != "ok") & failed).alias("no_https"))


def is_shared_host(host: Column) -> Column:
    """Social networks, platforms and mail providers: their name tells no company."""
    return in_hosts(host, SOCIAL_HOSTS + PLATFORM_HOSTS + FREE_MAIL_HOSTS)

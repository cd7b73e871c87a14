"""Phones and e-mail addresses: normal forms, the gate that addresses pass, and their ranking."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityspark.functions.text import blank, let, normal_text
from entityspark.functions.values import (
    BLOCKED_HOSTS, COMMON_ENDINGS, EMAIL_BLOCKS, FILE_ENDINGS, FREE_MAIL_HOSTS, MOVED_ENDINGS, PLACEHOLDER_LOCALS, PLACEHOLDER_NAMES, PLATFORM_HOSTS, SECOND_LEVELS,
    SERVICE_LOCALS, SITE_PREFIXES, SOCIAL_HOSTS, SPAM_DOMAINS, TYPO_PROVIDERS,
)
from entityspark.functions.web import in_hosts, unicode_host

EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
PHONE = r"(?:\+7|8)[\s\-]?\(?[0-9]{3}\)?[\s\-]?[0-9]{3}[\s\-]?[0-9]{2}[\s\-]?[0-9]{2}"
#: Hosts whose addresses stand on a company's pages without being its own; mail providers are not among them.
NOT_THE_COMPANYS = BLOCKED_HOSTS + sorted(set(SOCIAL_HOSTS + PLATFORM_HOSTS) - set(FREE_MAIL_HOSTS))
WORD = r"[\p{L}\p{N}_]"


def any_of(tests) -> Column:
    return reduce(lambda a, b: a | b, tests)


def phone_digits(c: Column) -> Column:
    """Comparable digits: 8 and ten-digit numbers count as 7; empty unless there are 10 to 15."""
    d = F.regexp_replace(blank(c), "[^0-9]", "")
    full = F.when((F.length(d) == 11) & d.startswith("8"), F.concat(F.lit("7"), F.substring(d, 2, 20))).when(F.length(d) == 10, F.concat(F.lit("7"), d)).otherwise(d)
    return F.when(F.length(full).between(10, 15), full).otherwise("")


def phone_identity(c: Column) -> Column:
    """By what phones in lists are one: their digits, or what is written where these make no number."""
    return F.coalesce(F.nullif(phone_digits(c), F.lit("")), normal_text(c))


def phone_text(c: Column) -> Column:
    """+7 (ddd) ddd-dd-dd for Russian numbers, else as it was."""
    d = F.regexp_replace(blank(c), "[^0-9]", "")
    ten = F.when((F.length(d) == 11) & d.rlike("^[78]"), F.substring(d, 2, 10)).when(F.length(d) == 10, d)
    part = lambda a, n: F.substring(ten, a, n)
    shaped = F.concat(F.lit("+7 ("), part(1, 3), F.lit(") "), part(4, 3), F.lit("-"), part(7, 2), F.lit("-"), part(9, 2))
    return F.when(ten.isNotNull(), shaped).otherwise(F.trim(blank(c)))


def card_phone(c: Column) -> Column:
    """The phone of a map card: seven digits at least."""
    return F.when(F.length(F.regexp_replace(blank(c), "[^0-9]", "")) >= 7, phone_text(c)).otherwise("")


def distinct_by(values: Column, identity) -> Column:
    """The values with a new identity, in order, the first spelling kept; values without one go. Sorted, not compared in pairs."""
    known = F.filter(F.transform(values, lambda v, i: F.struct(identity(v).alias("id"), i.alias("i"), v.alias("v"))), lambda x: blank(x["id"]) != "")
    first = let(F.array_sort(known), lambda a: F.filter(a, lambda x, i: (i == 0) | (F.get(a, F.greatest(i - 1, F.lit(0)))["id"] != x["id"])))
    return F.transform(F.array_sort(F.transform(first, lambda x: F.struct(x["i"].alias("i"), x["v"].alias("v")))), lambda x: x["v"])


def found_phones(text: Column) -> Column:
    """Distinct phones of a text in their written form, in order."""
    return distinct_by(F.transform(F.regexp_extract_all(blank(text), F.lit(f"({PHONE})"), F.lit(1)), phone_text), lambda p: F.regexp_replace(p, "[^0-9]", ""))


def found_emails(text: Column) -> Column:
    """Distinct addresses of a text as they are written, in order."""
    return F.array_distinct(F.regexp_extract_all(blank(text), F.lit(f"({EMAIL})"), F.lit(1)))


def local_part(email: Column) -> Column:
    return F.substring_index(email, "@", 1)


def domain_part(email: Column) -> Column:
    return F.substring_index(email, "@", -1)


def second_level(host: Column) -> Column:
    """The label that names a host's owner."""
    parts = F.split(host, r"\.")
    at = lambda k: F.try_element_at(parts, F.lit(k))
    between = F.coalesce(at(-2).isin(SECOND_LEVELS), F.lit(False))
    return F.when((F.size(parts) >= 3) & between, at(-3)).when(F.size(parts) >= 2, at(-2)).otherwise(at(1))


def related(domain: Column, host: Column) -> Column:
    """Same, one below the other, same second level, or one name of five letters and more within the other. Hosts may be
    written in punycode."""

    def kin(x: Column) -> Column:
        left, right = x["l"], x["r"]
        short = F.when(F.length(x["a"]) <= F.length(x["b"]), x["a"]).otherwise(x["b"])
        long = F.when(F.length(x["a"]) <= F.length(x["b"]), x["b"]).otherwise(x["a"])
        below = left.endswith(F.concat(F.lit("."), right)) | right.endswith(F.concat(F.lit("."), left))
        return (left != "") & (right != "") & ((left == right) | below | (x["a"] == x["b"]) | ((F.length(short) >= 5) & long.contains(short)))

    hosts = F.struct(unicode_host(domain).alias("l"), unicode_host(host).alias("r"))
    return let(hosts, lambda h: let(F.struct(h["l"].alias("l"), h["r"].alias("r"), second_level(h["l"]).alias("a"), second_level(h["r"]).alias("b")), kin))


def one_edit(a: Column, b: str) -> Column:
    """One insertion, deletion or replacement, or two neighbours swapped."""
    right = F.lit(b)
    swaps = any_of(a == F.lit(b[:k] + b[k + 1] + b[k] + b[k + 2 :]) for k in range(len(b) - 1))
    return (F.levenshtein(a, right) == 1) | (swaps & (a != right))


def rot13(c: Column) -> Column:
    low = "abcdefghijklmnopqrstuvwxyz"
    return F.translate(c, low + low.upper(), low[13:] + low[:13] + (low[13:] + low[:13]).upper())


def percent_decoded(c: Column) -> Column:
    """Percent escapes as the characters they stand for; a plus and a lone percent sign stay."""
    return F.when(~c.contains("%"), c).otherwise(F.url_decode(F.replace(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))))


def is_address(e: Column) -> Column:
    """One local part of up to 64 characters, and labels without marks at their ends."""
    labels = F.split(domain_part(e), r"\.", -1)
    fine = F.forall(labels, lambda x: x.rlike(r"^(?!-)[\p{L}\p{N}-]{1,63}(?<!-)$"))
    return (F.length(F.regexp_replace(e, "[^@]", "")) == 1) & (F.length(e) <= 254) & local_part(e).rlike(r"^[\p{L}\p{N}_.+%'-]{1,64}$") & (F.size(labels) > 1) & fine


def ending(e: Column) -> Column:
    return F.substring_index(e, ".", -1)


def plausible_ending(tld: Column) -> Column:
    return F.when(tld.startswith("xn--"), F.length(tld) > 4).otherwise(tld.rlike(r"^\p{L}{2,24}$"))


def cleaned_email(raw: Column, host: Column) -> Column:
    """(email, note) of an address on the pages of ``host``: email is null where the gate rejects it, and note tells why; else
    note is empty, repaired or rot13_decoded."""

    def repaired(original: Column) -> Column:
        text = F.regexp_replace(F.regexp_replace(F.trim(percent_decoded(original)), r"^[<>\"'()\[\]{};, ]+|[<>\"'()\[\]{};, ]+$", ""), r"^[._\-%+ ]+", "")
        return F.struct(original.alias("was"), F.lower(text).alias("e"))

    def unmoved(x: Column) -> Column:
        """Addresses whose letters were moved by 13 read as they were meant."""
        note, tld, moved = F.when(x["e"] == x["was"], "").otherwise("repaired"), ending(x["e"]), rot13(x["e"])
        told = tld.isin(MOVED_ENDINGS) | related(domain_part(moved), blank(host))
        known = tld.isin(COMMON_ENDINGS) | tld.startswith("xn--")
        back = ~known & is_address(moved) & ending(moved).isin(COMMON_ENDINGS) & told
        verdict = F.when(~is_address(x["e"]), "invalid_syntax").when(tld.isin(FILE_ENDINGS) | ~plausible_ending(tld), "invalid_tld")
        return F.when(back & verdict.isNull(), F.struct(moved.alias("e"), F.lit("rot13_decoded").alias("note"), verdict.alias("why"))).otherwise(F.struct(x["e"].alias("e"), note.alias("note"), verdict.alias("why")))

    def parted(x: Column) -> Column:
        domain = domain_part(x["e"])
        return F.struct(x["e"].alias("e"), x["note"].alias("note"), x["why"].alias("why"), local_part(x["e"]).alias("local"), domain.alias("domain"), related(domain, blank(host)).alias("kin"))

    def judged(x: Column) -> Column:
        domain, local, free = x["domain"], x["local"], x["domain"].isin(FREE_MAIL_HOSTS)
        why = (
            F.when(x["why"].isNotNull(), x["why"]).when(in_hosts(domain, NOT_THE_COMPANYS), "platform_or_authority").when(local.rlike("^[0-9a-f]{32}$"), "hex_token")
            .when(local.isin(PLACEHOLDER_LOCALS) | second_level(domain).isin(PLACEHOLDER_NAMES), "placeholder").when(~x["kin"] & domain.rlike(f"(?i){SPAM_DOMAINS}"), "spam_domain")
            .when(~free & in_hosts(domain, FREE_MAIL_HOSTS), "provider_subdomain").when(free & domain.isin(FREE_MAIL_HOSTS) & any_of(domain.endswith("." + h) for h in FREE_MAIL_HOSTS), "provider_subdomain")
            .when(free & local.isin(SERVICE_LOCALS), "provider_service_address").when(~free & ~x["kin"] & any_of(one_edit(domain, p) for p in TYPO_PROVIDERS), "provider_typo")
        )
        return F.struct(F.when(why.isNull(), x["e"]).alias("email"), F.coalesce(why, x["note"]).alias("note"))

    original = F.lower(F.regexp_replace(F.trim(blank(raw)), r"^[<>\"']+|[<>\"']+$", ""))
    return let(let(let(let(original, repaired), unmoved), parted), judged)


def email_verdict(raw: Column, host: Column) -> Column:
    """Why an address is rejected, or '' where it passes, repaired or not."""
    return let(cleaned_email(raw, host), lambda x: F.when(x["email"].isNull(), x["note"]).otherwise(""))


def listed_values(*cells: Column) -> Column:
    """The parts of cells whose values are parted by bars."""
    return F.filter(F.flatten(F.array(*[F.transform(F.split(blank(c), r"\|"), lambda x: F.trim(x)) for c in cells])), lambda x: x != "")


def cleaned_row(email: Column, all_emails: Column, host: Column) -> Column:
    """(email, all_emails) of a row: the addresses that pass the gate, each once, the first as the main one."""
    passed = F.filter(F.transform(F.concat(F.array(blank(email)), listed_values(all_emails)), lambda e: cleaned_email(e, host)["email"]), lambda e: e.isNotNull())
    return let(F.array_distinct(passed), lambda a: F.struct(F.coalesce(F.get(a, F.lit(0)), F.lit("")).alias("email"), F.array_join(a, " | ").alias("all_emails")))


def email_relation(email: Column, host: Column) -> Column:
    domain = F.lower(domain_part(email))
    return F.when(domain.isin(FREE_MAIL_HOSTS), "free").when(blank(host) == "", "unknown").when(related(domain, host), "same").otherwise("foreign")


def prefix_score(local: Column, prefixes: list[str]) -> Column:
    """50 for the first prefix, one less for each further one; 0 for none."""
    return F.coalesce(*[F.when((local == p) | local.startswith(p + "."), F.lit(50 - k)) for k, p in enumerate(prefixes)], F.lit(0))


def email_score(email: Column, host: Column) -> Column:
    """How likely an address is a company's main one: -1 for addresses that are none, 100 for the site's own domain, and
    more for the beginnings that companies use."""
    e = F.lower(email)
    domain = domain_part(e)
    own = (blank(host) != "") & ((domain == host) | domain.endswith(F.concat(F.lit("."), host)) | host.endswith(F.concat(F.lit("."), domain)))
    return F.when(any_of(e.contains(b) for b in EMAIL_BLOCKS), -1).otherwise(F.when(own, 100).otherwise(0) + prefix_score(local_part(e), SITE_PREFIXES))


def ranked_emails(text: Column, host: Column) -> Column:
    """The plausible addresses of a text, the best first, of equal ones by letter."""
    scored = F.transform(found_emails(text), lambda e: F.struct((-email_score(e, host)).alias("s"), F.lower(e).alias("k"), e.alias("e")))
    return F.transform(F.array_sort(F.filter(scored, lambda x: x["s"] <= 0)), lambda x: x["e"])


def spelled_email(text: Column) -> Column:
    """The first address that is written with "at" and "dot" in brackets."""
    at, dot = r"\s*[\[(]\s*(?:at|собака|@)\s*[\])]\s*", r"\s*[\[(]\s*(?:dot|точка|\.)\s*[\])]\s*"
    found = F.regexp_extract(blank(text), rf"(?iu)([a-z0-9._%+\-]+{at}[a-z0-9.\-]+{dot}[a-z]{{2,}})", 1)
    return F.regexp_replace(F.regexp_replace(found, f"(?iu){at}", "@"), f"(?iu){dot}", ".")


def hidden_email(digits: Column) -> Column:
    """Addresses that pages hide: hexadecimal bytes, each combined with the first by exclusive or."""
    byte = lambda k: F.conv(F.substring(digits, k, F.lit(2)), 16, 10).cast("int")
    places = F.when(F.length(digits) >= 4, F.sequence(F.lit(3), F.length(digits) - 1, F.lit(2)))
    return F.array_join(F.transform(places, lambda k: F.char(byte(k).bitwiseXOR(byte(F.lit(1))))), "")

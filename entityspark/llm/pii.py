"""Surrogates for personal data, in DataFrame operations only.

Entities are found by one regular expression. Each gets a replacement that a secret key and the entity's normal form
decide, so that the same entity has the same surrogate everywhere, written in the way of each mention. A surrogate is
of the same type: digits stand for digits and letters for letters, card numbers keep brand, length and whether their
check digit is right, account numbers get right check digits, phone numbers keep their country code, mail addresses come
to lie below example.com, and names keep gender and script. A family name has one surrogate, with a given name, behind a
title or both, so that a short mention still goes with the long one; given names are drawn for the whole name.

Replacements are drawn by hash, so two entities could draw the same, or one that is another entity of the corpus. All
distinct entities are checked against each other, and those that clash draw again until none does; names, mail addresses
and phone numbers grow with their draws, so that there is room for any number of them. Only these few, and names whose
titles tell another gender than their given name does, reach the texts by a join; all other surrogates are computed in
place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityspark.llm.common import columns, discard, materialize

#: Titles and the gender of who bears them.
TITLES = {
    "male": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "господин", "г-н"],
    "female": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа", "г-жа"],
    "any": ["Dr", "Prof"],
}
#: Given names by script and gender: found in texts, and drawn for surrogates.
GIVEN = {
    ("latin", "male"): "James John Robert Michael William David Thomas Daniel Peter Paul Hans Klaus Jürgen Pierre Jean Luis Carlos Miguel Richard Joseph Charles Mark Steven Andrew George Kevin Brian Jonas Felix Stefan Andreas Wolfgang Louis Antoine Jacques Juan José Pedro Javier Ivan Sergei Dmitri Hiroshi Kenji Ahmed Mohammed Omar Giovanni Marco Luca Rajesh Wei".split(),
    ("latin", "female"): "Mary Anna Linda Susan Laura Emma Julia Maria Sophie Claire Ingrid Petra Ursula Marie Carmen Lucía Elena Isabel Patricia Jennifer Elizabeth Barbara Sarah Karen Nancy Sandra Ashley Emily Katharina Sabine Monika Heike Camille Chloé Nathalie Sofía Ana Olga Natalia Tatiana Yuki Sakura Fatima Aisha Giulia Chiara Francesca Priya Mei".split(),
    ("cyrillic", "male"): "Иван Пётр Сергей Алексей Дмитрий Николай Михаил Андрей Александр Владимир Евгений Павел Максим Олег Игорь Юрий".split(),
    ("cyrillic", "female"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Людмила Юлия Галина Вера Дарья Оксана Надежда".split(),
}
SYLLABLES = {"latin": "bar den fel gor hal kim lor men nor pas ril sol tam ver wen zor".split(), "cyrillic": "бар ден фел гор хал ким лор мен нор пас рил сол там вер вен зор".split()}

#: Country codes of two digits; 1 and 7 have one, all others three.
TWO_DIGITS = "^(?:2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"

_all = [n for names in GIVEN.values() for n in names]



def alternatives(words: list[str]) -> str:
    """A pattern for any of the words, grouped by their first letters: at most places one look decides."""
    groups: dict[str, list[str]] = {}
    for w in sorted(set(words), key=lambda w: (-len(w), w)):
        groups.setdefault(w[0], []).append(w[1:])
    return "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in groups.items())


_titles, _given = alternatives([t for ts in TITLES.values() for t in ts]), alternatives(_all)
#: Type and pattern, the first that matches a text's place wins.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,125}\.[A-Za-z]{2,}",
    "key": r"\bAKIA[0-9A-Z]{16}\b",
    "secret": r"(?<![^\s=:\"'(\[,;>])(?=[0-9]*+[a-f])[0-9a-f]{16,}+(?![^\s\"')\],.;<])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)",
    "card": r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "name": rf"(?<!\p{{L}})(?:(?:{_titles})\.? \p{{Lu}}[\p{{Ll}}]+(?: \p{{Lu}}[\p{{Ll}}]+)?|(?:{_given}) \p{{Lu}}[\p{{Ll}}]+)(?!\p{{L}})",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Texts without any of these hold no entity.
HINT = rf"[0-9@]|(?<!\p{{L}})(?:{_titles}|{_given})\.? \p{{Lu}}|[a-f]{{16}}"


def either(choices: list[tuple[Column, Column]], otherwise: Column) -> Column:
    return reduce(lambda c, x: c.when(*x), choices[1:], F.when(*choices[0])).otherwise(otherwise)


def let(value: Column, of) -> Column:
    """``of(value)``, with the value computed once however often it occurs there."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def kind_of(e: Column) -> Column:
    return either([(e.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items() if k not in ("secret", "ip", "ssn", "card", "phone", "email")] + [
        (e.contains("@"), F.lit("email")), (e.rlike(r"^[0-9a-f]{16,}$") & e.rlike("[a-f]"), F.lit("secret")), (e.rlike(r"^\d+(\.\d+){3}$"), F.lit("ip")), (e.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.lit("ssn")), (e.rlike(r"^[+(]"), F.lit("phone"))], F.lit("card"))


def bare_name(e: Column) -> Column:
    return F.regexp_replace(e, rf"^(?:{_titles})\.? ", "")


def normal(kind: Column, e: Column) -> Column:
    """What mentions of one entity have in common. Phone numbers that start with an area in brackets are US numbers."""
    return either([(kind == "email", F.lower(e)), ((kind == "phone") & e.startswith("("), F.concat(F.lit("1"), F.regexp_replace(e, r"\D", ""))), (kind.isin("phone", "card", "ssn"), F.regexp_replace(e, r"\D", "")), (kind == "iban", F.replace(e, F.lit(" "), F.lit(""))), (kind == "name", F.lower(bare_name(e)))], e)


def draws(secret: str, kind: Column, form: Column, attempt: Column) -> Column:
    """512 hex digits that only the secret's holder can draw."""
    return F.concat(*[F.sha2(F.concat_ws("|", F.lit(secret), kind, form, attempt.cast("string"), F.lit(str(k))), 256) for k in range(8)])


def number(hexes: Column, k: Column, below: int) -> Column:
    """The k-th draw, below ``below``."""
    at = F.pmod(k, F.lit(128)) * 4 + 1
    return F.pmod(F.conv(F.substring(hexes, at, F.lit(4)), 16, 10).cast("int"), F.lit(below))


def letter(n: Column, alphabet: str) -> Column:
    return F.substring(F.lit(alphabet), n + 1, F.lit(1))


def same_format(e: Column, hexes: Column, keep: int = 0) -> Column:
    """Another character of its class for each behind the first ``keep``. Marks stay and take no draw, so that mentions in
    different formats get the same letters and digits."""
    low = "abcdefghijklmnopqrstuvwxyz"

    def other(c: Column, k: Column) -> Column:
        return either([(k < keep, c), (c.rlike("[0-9]"), letter(number(hexes, k, 10), "0123456789")), (c.rlike("[a-z]"), letter(number(hexes, k, 26), low)), (c.rlike("[A-Z]"), letter(number(hexes, k, 26), low.upper()))], c)

    return spread(e, other)


def hex_stream(e: Column, hexes: Column) -> Column:
    """As many hexadecimal digits as a secret has, however long it is."""
    blocks = F.sequence(F.lit(1), F.ceil(F.length(e) / 64).cast("int"))
    return F.substring(F.array_join(F.transform(blocks, lambda k: F.sha2(F.concat_ws("|", F.substring(hexes, 1, 128), k.cast("string")), 256)), ""), F.lit(1), F.length(e))


def iban(e: Column, form: Column, hexes: Column) -> Column:
    """Keeps the country; the account is drawn from the normal form, and the check digits are right for it."""

    def checked(drawn: Column) -> Column:
        digits = F.split(F.concat(F.substring(drawn, F.lit(5), F.lit(40)), F.substring(drawn, F.lit(1), F.lit(2)), F.lit("00")), "(?<=.)(?=.)")
        value = lambda c: F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
        rest = F.aggregate(digits, F.lit(0), lambda a, c: F.pmod(a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c), F.lit(97)))
        return F.concat(F.substring(drawn, F.lit(1), F.lit(2)), F.lpad((F.lit(98) - rest).cast("string"), 2, "0"), F.substring(drawn, F.lit(5), F.lit(40)))

    return let(let(same_format(form, hexes, keep=2), checked), lambda whole: spread(e, lambda c, k: F.substring(whole, k + 1, F.lit(1))))


def spread(e: Column, of) -> Column:
    """Apply ``of`` to each letter or digit and its rank among these; other characters stay."""
    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("k"))

    def step(a: Column, c: Column) -> Column:
        counts = c.rlike("[0-9A-Za-z]")
        return F.struct(F.concat(a["s"], F.when(counts, of(c, a["k"])).otherwise(c)).alias("s"), (a["k"] + counts.cast("int")).alias("k"))

    def piece(a: Column, part: Column) -> Column:
        own = F.aggregate(F.split(part, "(?<=.)(?=.)"), F.struct(F.lit("").alias("s"), a["k"].alias("k")), step)
        return let(own, lambda o: F.struct(F.concat(a["s"], o["s"]).alias("s"), o["k"].alias("k")))

    # In pieces of 256, since a string that grows by single characters is copied for each.
    return F.aggregate(F.regexp_extract_all(e, F.lit("(?s).{1,256}"), F.lit(0)), start, piece, lambda a: a["s"])


def luhn(digits: Column) -> Column:
    """The check sum of a string of digits; 0 where its last digit is right."""
    value = lambda d: F.coalesce(d.try_cast("int"), F.lit(0))
    each = F.transform(F.reverse(F.split(digits, "(?<=.)(?=.)")), lambda d, k: F.when(k % 2 == 0, value(d)).otherwise(value(d) * 2 - F.when(value(d) > 4, 9).otherwise(0)))
    return F.pmod(F.aggregate(each, F.lit(0), lambda a, x: a + x), F.lit(10))


def card(e: Column, hexes: Column) -> Column:
    """Keeps the first digit, and the check sum by the last one."""

    def drawn(digits: Column) -> Column:
        n = F.length(digits)
        free = spread(digits, lambda c, k: F.when(k == 0, c).otherwise(letter(number(hexes, k, 10), "0123456789")))
        return let(F.substring(free, F.lit(1), n - 1), lambda open_: F.concat(open_, F.pmod(luhn(digits) - luhn(F.concat(open_, F.lit("0"))) + 10, F.lit(10)).cast("string")))

    return let(let(F.regexp_replace(e, r"\D", ""), drawn), lambda whole: spread(e, lambda c, k: F.substring(whole, k + 1, F.lit(1))))


def more(hexes: Column, n: Column, of) -> Column:
    """``n`` further pieces, by which a redrawn surrogate is longer."""
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: of(number(hexes, k + 59, 1 << 15))), "")).otherwise("")


def phone(e: Column, form: Column, hexes: Column, attempt: Column) -> Column:
    """Keeps the country code and 555; an area or a number never starts with 0 or 1. Drawn from the normal form, then laid
    into the mention's format."""
    code = F.when(form.rlike("^[17]"), 1).when(form.rlike(TWO_DIGITS), 2).otherwise(3)
    fiction = F.when(form.rlike("^1\\d{3}555\\d{4}$"), 4).otherwise(F.lit(-9))

    def drawn(x: Column) -> Column:
        return spread(form, lambda c, k: either([(k < x["code"], c), ((k >= x["fiction"]) & (k < x["fiction"] + 3), c), (k == x["code"], letter(number(hexes, k, 8), "23456789"))], letter(number(hexes, k, 10), "0123456789")))

    skipped = F.when(e.startswith("("), 1).otherwise(0)
    laid = let(F.struct(let(F.struct(code.alias("code"), fiction.alias("fiction")), drawn).alias("whole"), skipped.alias("skipped")), lambda x: spread(e, lambda c, k: F.substring(x["whole"], k + 1 + x["skipped"], F.lit(1))))
    return F.concat(laid, more(hexes, attempt - 2, lambda n: letter(F.pmod(n, F.lit(10)), "0123456789")))


def email(e: Column, hexes: Column, attempt: Column, secret: str) -> Column:
    """The local part in its format; of the domain, the part before a public suffix, the same for all addresses in it."""
    local, domain = F.substring_index(e, "@", 1), F.lower(F.substring_index(e, "@", -1))
    host = F.regexp_replace(F.regexp_replace(domain, r"\.(example\.)?[a-z]+$", ""), r"\.", "-")
    moved = let(draws(secret, F.lit("domain"), domain, F.lit(0)), lambda own: F.concat(same_format(host, own), letter_run(own)))
    longer = more(hexes, attempt - 2, lambda n: letter(F.pmod(n, F.lit(26)), "abcdefghijklmnopqrstuvwxyz"))
    return F.concat(same_format(local, hexes), longer, F.lit("@"), moved, F.lit(".example.com"))


def letter_run(hexes: Column) -> Column:
    """Four letters that tell domains with equal formats apart."""
    return F.concat(*[letter(number(hexes, F.lit(100 + k), 26), "abcdefghijklmnopqrstuvwxyz") for k in range(4)])


def title_gender(e: Column) -> Column:
    """1 for a female title, -1 for a male one, else 0."""
    bears = lambda g: e.rlike(rf"^(?:{'|'.join(TITLES[g])})\.? ")
    return F.when(bears("female"), 1).when(bears("male"), -1).otherwise(0)


def given_female(form: Column) -> Column:
    """Whether a name's normal form starts with a female given name."""
    return F.substring_index(form, " ", 1).isin([n.lower() for (_, g), names in GIVEN.items() if g == "female" for n in names])


def family_of(form: Column) -> Column:
    return F.substring_index(form, " ", -1)


def script_of(form: Column) -> Column:
    return F.when(form.rlike("\\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def syllable(script: Column, n: Column) -> Column:
    latin, cyrillic = (F.get(F.array(*map(F.lit, SYLLABLES[s])), F.pmod(n, F.lit(16))) for s in ("latin", "cyrillic"))
    return F.when(script == "cyrillic", cyrillic).otherwise(latin)


def family_name(form: Column, hexes: Column, attempt: Column) -> Column:
    """Four syllables in the script of the name, and one more for each further draw."""
    s = script_of(form)
    return F.initcap(F.concat(*[syllable(s, number(hexes, F.lit(k), 16)) for k in range(1, 5)], more(hexes, attempt, lambda n: syllable(s, n))))


def given_name(form: Column, hexes: Column, attempt: Column, female: Column) -> Column:
    """A given name of the same gender and script; further draws add syllables to it."""
    s, female = script_of(form), F.coalesce(female, given_female(form))
    of = lambda key: F.get(F.array(*map(F.lit, GIVEN[key])), number(hexes, F.lit(0), len(GIVEN[key])))
    drawn = either([((s == script) & (female == (g == "female")), of((script, g))) for script, g in GIVEN], of(("latin", "male")))
    return F.concat(drawn, F.when(attempt > 0, F.concat(F.lit("-"), F.initcap(more(hexes, attempt, lambda n: syllable(s, n))))).otherwise(""))


def ip(hexes: Column) -> Column:
    return F.concat_ws(".", *[(number(hexes, F.lit(k), 223 if k == 0 else 254) + 1).cast("string") for k in range(4)])


def surrogate(kind: Column, e: Column, form: Column, attempt: Column, secret: str) -> Column:
    """Of any entity but a name."""

    def drawn(hexes: Column) -> Column:
        return either([(kind == "email", email(e, hexes, attempt, secret)), (kind == "phone", phone(e, form, hexes, attempt)), (kind == "card", card(e, hexes)), (kind == "ip", ip(hexes)),
            (kind == "key", same_format(e, hexes, keep=4)), (kind == "secret", hex_stream(e, hexes)), (kind == "iban", iban(e, form, hexes))], same_format(e, hexes))

    return let(draws(secret, kind, form, attempt), drawn)


def named(e: Column, form: Column, family_attempt: Column, attempt: Column, female: Column, secret: str) -> Column:
    """Of a name: its title, the given name drawn for the whole name, the family name drawn for the family."""
    family = let(draws(secret, F.lit("family"), family_of(form), family_attempt), lambda h: family_name(family_of(form), h, family_attempt))
    given = let(draws(secret, F.lit("name"), form, attempt), lambda h: given_name(form, h, attempt, female))
    return F.concat(F.regexp_extract(e, rf"^(?:{_titles})\.? ", 0), F.when(form.contains(" "), F.concat(given, F.lit(" "))).otherwise(""), family)


def claimed(kind: Column, e: Column, form: Column, attempt: Column, female: Column, secret: str) -> Column:
    """What a draw takes from others: of a given name, that name within the family."""
    hexes = draws(secret, kind, form, attempt)
    return (
        F.when(kind == "family", F.lower(let(hexes, lambda h: family_name(form, h, attempt))))
        .when(kind == "name", F.concat(F.lower(let(hexes, lambda h: given_name(form, h, attempt, female))), F.lit(" "), family_of(form)))
        .otherwise(let(surrogate(kind, e, form, attempt, secret), lambda s: normal(kind, s)))
    )


def entities(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(row_id, doc_id, parts, found): the text around the entities, and the entities with kind and normal form."""
    body = F.col(f"`{text}`")
    with_any = F.coalesce(body.rlike(HINT), F.lit(False))
    parts = F.when(body.isNull(), F.lit(None)).when(with_any, F.split(body, ENTITY, -1)).otherwise(F.array(body))
    raw = F.when(with_any, F.regexp_extract_all(body, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    typed = F.transform(raw, lambda e: let(kind_of(e), lambda kind: F.struct(e.alias("e"), kind.alias("kind"), normal(kind, e).alias("form"))))
    return columns(docs, doc_id, text).select(F.monotonically_increasing_id().alias("row_id"), F.col(f"`{doc_id}`").alias("doc_id"), parts.alias("parts"), typed.alias("found"))


def clashing(known: DataFrame, secret: str, rounds: int = 200) -> DataFrame:
    """(kind, form, attempt, female) of the entities that can't have their first draw, or whose titles tell the gender.
    ``known``: kind, form, e, female, one row an entity."""
    spark, assigned = known.sparkSession, materialize(known.withColumn("attempt", F.lit(0)), "draws")
    taken = known.select("kind", F.col("form").alias("out"), F.lit(True).alias("real"))
    for _ in range(rounds):
        drawn = assigned.withColumn("out", claimed(F.col("kind"), F.col("e"), F.col("form"), F.col("attempt"), F.col("female"), secret))
        # Of equal draws the entity with the fewest draws and the least form keeps it, and none keeps a real entity.
        first = drawn.groupBy("kind", "out").agg(F.min(F.struct(-F.col("attempt"), F.col("form"))).alias("least"), F.count("*").alias("n"))
        held = first.join(taken, ["kind", "out"], "left").filter("n > 1 or real").select("kind", "out", "least", F.coalesce("real", F.lit(False)).alias("real"))
        again = drawn.join(held, ["kind", "out"]).filter(F.col("real") | (F.struct(-F.col("attempt"), F.col("form")) != F.col("least"))).select("kind", "form", F.lit(True).alias("again"))
        again = materialize(again, "clashes")
        if again.isEmpty():
            return assigned.filter("attempt > 0 or female is not null").select("kind", "form", "attempt", "female")
        after = materialize(assigned.join(again, ["kind", "form"], "left").select("kind", "form", "e", "female", (F.col("attempt") + F.coalesce("again", F.lit(False)).cast("int")).alias("attempt")), "draws")
        discard(assigned)
        assigned = after
    raise RuntimeError(f"entities still clash after {rounds} draws: the formats leave too little room")


def replace(docs: DataFrame, secret: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_entities, text) of each row, with surrogates for all entities.

    A null text stays null. Rows with one doc_id, or none, are texts of their own. An empty table gives an empty result;
    further columns are ignored.
    """
    rows = materialize(entities(docs, text, doc_id), "entities")
    # A name counts as its family, and with a given name as the whole name too.
    one = lambda x, kind, form: F.struct(kind.alias("kind"), form.alias("form"), x["e"].alias("e"))
    roles = lambda x: F.when(x["kind"] != "name", F.array(one(x, x["kind"], x["form"]))).when(x["form"].contains(" "), F.array(one(x, F.lit("family"), family_of(x["form"])), one(x, F.lit("name"), x["form"]))).otherwise(F.array(one(x, F.lit("family"), x["form"])))
    mentions = rows.select("row_id", F.explode(F.flatten(F.transform("found", roles))).alias("x")).select("row_id", "x.*")
    # Most of a name's titles decide its gender in all its mentions.
    titles = F.sum(F.when(F.col("kind") == "name", title_gender(F.col("e"))).otherwise(0))
    known = mentions.groupBy("kind", "form").agg(F.min("e").alias("e"), titles.alias("titles"))
    known = known.select("kind", "form", "e", F.when((F.col("titles") != 0) & (F.col("kind") == "name") & ((F.col("titles") > 0) != given_female(F.col("form"))), F.col("titles") > 0).alias("female"))
    redrawn = clashing(materialize(known, "known"), secret)
    key = lambda k, f: F.concat_ws(":", k, f)
    # Few rows: the entities that drew again or have another gender, in the documents that mention them.
    tries = mentions.join(redrawn, ["kind", "form"]).select("row_id", key("kind", "form").alias("k"), F.struct("attempt", "female").alias("x")).distinct().groupBy("row_id").agg(F.map_from_entries(F.collect_list(F.struct("k", "x"))).alias("tries"))
    joined = rows.join(tries, "row_id", "left")
    found = lambda k, f: F.when(F.col("tries").isNotNull(), F.get(F.map_values(F.map_filter("tries", lambda x, v: x == key(k, f))), F.lit(0)))
    attempt = lambda o: F.coalesce(o["attempt"], F.lit(0))

    def place(x: Column) -> Column:
        as_name = let(F.struct(found(F.lit("family"), family_of(x["form"])).alias("f"), found(F.lit("name"), x["form"]).alias("n")), lambda o: named(x["e"], x["form"], attempt(o["f"]), attempt(o["n"]), o["n"]["female"], secret))
        return F.when(x["kind"] == "name", as_name).otherwise(let(found(x["kind"], x["form"]), lambda o: surrogate(x["kind"], x["e"], x["form"], attempt(o), secret)))

    whole = F.array_join(F.flatten(F.transform(F.arrays_zip(F.col("parts").alias("p"), F.concat("written", F.array(F.lit(""))).alias("s")), lambda x: F.array(x["p"], x["s"]))), "")
    return joined.withColumn("written", F.transform("found", place)).select("doc_id", F.size("found").alias("n_entities"), F.when(F.col("parts").isNotNull(), whole).alias("text"))

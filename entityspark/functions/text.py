"""Normalisers of names, cities and addresses, flags, and cells for exports. All map columns to columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityspark.functions.values import ADDRESS_WORDS


def blank(c: Column) -> Column:
    """Null and empty are one."""
    return F.coalesce(c, F.lit(""))


def let(value: Column, of) -> Column:
    """``of(value)``, with the value computed once however often it occurs there."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def one_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(blank(c), r"[\s\x{00A0}]+", " "))


def fold(c: Column) -> Column:
    """Lower case, ё as е, single spaces; marks stay."""
    return one_space(F.translate(F.lower(blank(c)), "ё", "е"))


def normal_text(c: Column) -> Column:
    """As fold, with a space for whatever is no letter, number or underscore."""
    return F.trim(F.regexp_replace(F.translate(F.lower(blank(c)), "ё", "е"), r"[^\p{L}\p{N}_]+", " "))


def normal_city(c: Column) -> Column:
    return F.regexp_replace(normal_text(c), "^(?:г|город|пгт|поселок|село) ", "")


def normal_address(c: Column) -> Column:
    words = F.split(normal_text(c), " ")
    short = F.create_map(*[F.lit(x) for kv in ADDRESS_WORDS.items() for x in kv])
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(short, w), w)), " ")


def house_number(address: Column) -> Column:
    """The last number of a normal address, with a letter or not; empty where there is none. A number right behind
    another belongs to that one (a flat, a building), so of a run of numbers every second is passed over."""
    start = F.struct(F.lit("").alias("house"), F.lit(True).alias("free"))

    def step(found: Column, word: Column) -> Column:
        is_house = word.rlike("^[0-9]+[a-zа-я]?$") & found["free"]
        return F.struct(F.when(is_house, word).otherwise(found["house"]).alias("house"), (~is_house).alias("free"))

    return F.aggregate(F.split(blank(address), " "), start, step, lambda found: found["house"])


def flags(c: Column) -> Column:
    """Sorted distinct flags of a list with bars."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.lower(blank(c)), r"\|"), lambda x: F.trim(x)), lambda x: x != "")))


def union_flags(*lists: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.concat(*lists))), "|")


def safe_cell(c: Column) -> Column:
    """A cell that a spreadsheet would run as a formula gets an apostrophe."""
    return F.when(blank(c).rlike(r"^(?U)\s*[=+\-@]"), F.concat(F.lit("'"), c)).otherwise(blank(c))


def restored_cell(c: Column) -> Column:
    """A cell as it was before ``safe_cell``."""
    return F.when(blank(c).rlike(r"^'(?U)\s*[=+\-@]"), F.substring(c, 2, 1 << 30)).otherwise(blank(c))


def shortened(c: Column, most: int) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 1), F.lit("…"))).otherwise(c)


def sheet_name(c: Column) -> Column:
    return F.substring(F.trim(F.regexp_replace(blank(c), r"[\[\]:*?/\\]", " ")), 1, 31)


def completeness(*contacts: Column) -> Column:
    return sum((blank(c) != "").cast("int") for c in contacts)

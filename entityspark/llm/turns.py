"""Conversation structure repair by a fold of Spark SQL's higher-order functions.

A conversation is right when the initials of its roles read ``(s?(ua)+)?``. Rows may be kept (K, free), given the role user
or assistant (R, 1) or deleted (D, 2: blank rows and repeats must be), empty user and assistant rows may be inserted (I, 5),
and a truncated row that stays adds 5. The cheapest edits win, ties go to the least audit.

Equal rows are counted first, so copies are one row with a number. Faults come from a window over the equal rows of a
conversation. The rows, sorted over all conversations, are numbered once; a conversation's rows of 256 numbers are a block,
their structs are collected in order and ``aggregate()`` carries four (cost, audit) structs, one for each state: nothing yet
(0), after a system row (1), a user row (2), an assistant row (3). Each block is folded from all four states, a second fold
chains the blocks of a conversation: there a path has one letter a block, so a conversation of any length is spread over
many tasks, and what one task holds of it is a 256th.

Why four structs suffice: from a given state an audit tells the state it leads to, so two paths into different states differ
before either ends, and appending the same edits keeps their order. Inserting is only tried right before a row that stays,
or at the end: D sorts before I, so an insertion moves behind deleted rows. Two insertions in a row never pay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from entityspark.llm.common import NOT_SPACE, materialize

DELETE, REROLE, INSERT, CUT = 2, 1, 5, 5
#: The cost of what can't be.
NEVER = 10**15
#: Rows of a block: 2 to this power.
BLOCK_BITS = 8
LEGAL = ("su", "ua", "au")
STATES = range(4)


class Repaired(NamedTuple):
    """``report``: a row for each conversation with rows. ``turns``: the rows after the repair, ordered by (at, part)."""

    report: DataFrame
    turns: DataFrame


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with known damage: by crc32 of "conv_id:turn" modulo 20 a row is dropped (0), loses its text (1) or its
    sentence ends (2), is repeated (3), or turns into a user's (4). Nulls in role and text become a space, as nulls do in the
    hashed string; a null conv_id or turn stays null. Returns conv_id, turn, role and text."""
    word = lambda n: F.coalesce(F.col(f"`{n}`").cast("string"), F.lit(" "))
    rows = rows.select(F.col("conv_id"), F.col("turn"), word("role").alias("role"), word("text").alias("text"), (F.crc32(F.concat_ws(":", word("conv_id"), word("turn"))) % 20).alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.filter("fate <> 0").select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("fate") == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("times", F.explode(F.array_repeat(F.lit(1), F.col("times")))).drop("times")


def faults(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text) with ``n``, how often each occurs, and the first fault of the first of them:
    blank, duplicate, truncated or none. The later ones of equal rows are blank as well, or else duplicates."""
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    again = F.row_number().over(W.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    last = F.regexp_extract("text", f"({NOT_SPACE})[\\x20\\x09-\\x0D]*\\z", 1)
    fault = F.when(~F.col("text").rlike(NOT_SPACE), "blank").when(again, "duplicate").when(~last.isin(".", "!", "?"), "truncated").otherwise("none")
    return rows.withColumn("fault", fault)


def edits() -> Column:
    """What may happen to a row: (cost, token) of deleting it, and of its staying as system, user or assistant row. A token
    ends with a comma; those of copies follow that of the first."""
    forced, stay = F.col("fault").isin("blank", "duplicate"), F.when(F.col("fault") == "truncated", CUT).otherwise(0)
    copies, cost = F.concat(F.repeat(F.lit("D"), (F.col("n") - 1).cast("int")), F.lit(",")), (F.col("n") - 1) * DELETE
    option = lambda c, op: F.struct(c.cast("long").alias("cost"), F.concat(F.lit(op) if isinstance(op, str) else op, copies).alias("audit"))
    as_is = lambda initial: (F.col("initial") == initial) & ~forced
    role = lambda initial: option(F.when(forced, NEVER).otherwise(cost + stay + F.when(as_is(initial), 0).otherwise(REROLE)), F.when(as_is(initial), "K").otherwise("R"))
    return F.struct(option(cost + DELETE, "D").alias("d"), option(F.when(as_is("s"), cost + stay).otherwise(NEVER), "K").alias("s"), role("u").alias("u"), role("a").alias("a"))


def plus(path: Column, edit: Column, insert: bool = False) -> Column:
    """A path with one more edit."""
    cost, token = path["cost"] + edit["cost"], edit["audit"]
    if insert:
        cost, token = cost + INSERT, F.concat(F.lit("I"), token)
    return F.struct(cost.alias("cost"), F.concat(path["audit"], token).alias("audit"))


def step(paths: Column, row: Column) -> Column:
    """The four cheapest paths after one more row."""
    d, s, u, a = (row["edits"][n] for n in "dsua")
    none, system, user, assistant = (paths[k] for k in STATES)
    open_ = F.least(none, system, assistant)  # a user row may follow
    return F.array(
        plus(none, d), F.least(plus(system, d), plus(none, s)), F.least(plus(user, d), plus(open_, u), plus(user, u, True)), F.least(plus(assistant, d), plus(user, a), plus(open_, a, True)),
    )


def start(state: int) -> Column:
    return F.array(*[F.struct(F.lit(0 if k == state else NEVER).cast("long").alias("cost"), F.lit("").alias("audit")) for k in STATES])


def pairs_illegal(initials: Column) -> Column:
    """Neighbours that may not follow each other."""
    return F.size(F.filter(F.transform(F.sequence(F.lit(1), F.size(initials)), lambda k: F.concat(F.get(initials, k - 1), F.get(initials, k))), lambda p: ~p.isin(*LEGAL))).cast("long")


def blocks(numbered: DataFrame) -> DataFrame:
    """The rows of each block in order, folded from every state. ``paths[i][j]``: the cheapest from state i to state j."""
    rows = numbered.withColumn("initial", F.substring("role", 1, 1)).withColumn("edits", edits())
    rows = rows.groupBy("conv_id", F.shiftright("id", BLOCK_BITS).alias("b")).agg(F.array_sort(F.collect_list(F.struct("id", "initial", "n", "edits"))).alias("rows"))
    initials = F.transform("rows", lambda r: r["initial"])
    within = F.aggregate("rows", F.lit(0).cast("long"), lambda acc, r: acc + F.when(F.concat(r["initial"], r["initial"]).isin(*LEGAL), 0).otherwise(r["n"] - 1))
    paths = F.array(*[F.aggregate("rows", start(k), step) for k in STATES])
    return rows.select(
        "conv_id", F.get("rows", F.lit(0))["id"].alias("block"), F.transform("rows", lambda r: r["id"]).alias("ids"), paths.alias("paths"), (within + pairs_illegal(initials)).alias("illegal"),
        F.get(initials, F.lit(0)).alias("first"), F.element_at(initials, -1).alias("last"),
    )


def links() -> Column:
    """``paths`` for the second fold: the costs, and one letter for each way, in the order of the audits from one state."""
    ways = lambda row: F.transform(row, lambda p, j: F.struct(F.least(p["cost"], F.lit(NEVER)).alias("cost"), F.chr(65 + 4 * F.size(F.filter(row, lambda o: o["audit"] < p["audit"])) + j).alias("audit")))
    return F.transform("paths", ways)


def chain(paths: Column, block: Column) -> Column:
    """The four cheapest paths after one more block."""
    to = lambda j: F.least(*[F.struct(F.least(paths[i]["cost"] + block["links"][i][j]["cost"], F.lit(NEVER)).alias("cost"), F.concat(paths[i]["audit"], block["links"][i][j]["audit"]).alias("audit")) for i in STATES])
    return F.array(*[to(j) for j in STATES])


def repair(rows: DataFrame) -> Repaired:
    """The cheapest repair of every conversation. Columns: conv_id, turn, role, text; further ones are left out.

    Rows are ordered by turn (nulls first), then role and text. A null conv_id is a conversation of its own; null roles and
    texts count as empty. An empty table gives empty results. Equal rows of one turn are one row and its duplicates.
    ``report``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. ``turns``: conv_id, at, part, role, text
    and edit (K, R or I); conversations that lose all rows have none.
    """
    word = lambda n: F.coalesce(F.col(f"`{n}`").cast("string"), F.lit(""))
    found = faults(rows.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text")))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    # Ids follow the order of rows. They are written before any use, so that every use sees the same ones.
    numbered = materialize(found.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id()), "turns")
    folded = materialize(blocks(numbered), "turn-blocks")

    ends = lambda paths: F.least(paths[0], paths[3], F.struct((paths[2]["cost"] + INSERT).alias("cost"), F.concat(paths[2]["audit"], F.lit("!")).alias("audit")))
    chains = folded.select("conv_id", "block", links().alias("links"), "illegal", "first", "last").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "links", "illegal", "first", "last"))).alias("blocks"))
    across = F.transform(F.sequence(F.lit(1), F.size("blocks")), lambda k: F.concat(F.get("blocks", k - 1)["last"], F.get("blocks", k)["first"]))
    chains = chains.select(
        "conv_id", F.transform("blocks", lambda b: b["block"]).alias("at"), ends(F.aggregate("blocks", start(0), chain)).alias("way"),
        (F.aggregate("blocks", F.lit(0).cast("long"), lambda acc, b: acc + b["illegal"]) + F.size(F.filter(across, lambda p: ~p.isin(*LEGAL)))).alias("illegal"),
    )
    chains = materialize(chains, "turn-chains")
    state = lambda k: (F.ascii(F.substr(F.col("way")["audit"], k, F.lit(1))) - 65) % 4
    choice = lambda b, k: F.struct(b.alias("block"), F.when(k == 0, 0).otherwise(state(k)).alias("i"), state(k + 1).alias("j"), ((k == F.size("at") - 1) & F.col("way")["audit"].endswith("!")).alias("more"))
    chosen = chains.select(F.inline(F.transform("at", choice)))
    picked = folded.join(chosen, "block").select("conv_id", "block", "ids", "i", "more", F.get(F.get("paths", F.col("i")), F.col("j"))["audit"].alias("audit"))
    picked = materialize(picked, "turn-edits")

    counted = numbered.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"), F.sum(F.when(F.col("fault") == "blank", F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == "blank", 0).when(F.col("fault") == "duplicate", F.col("n")).otherwise(F.col("n") - 1)).alias("duplicate"), F.count_if(F.col("fault") == "truncated").alias("truncated"),
    )
    whole = F.concat(F.translate("audit", ",", ""), F.when(F.col("more"), "I").otherwise(""))
    audits = picked.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", whole.alias("a")))).alias("parts")).select("conv_id", F.array_join(F.transform("parts", lambda p: p["a"]), "").alias("audit"))
    same = lambda x, y: x["conv_id"].eqNullSafe(y["conv_id"])
    report = counted.join(chains, same(counted, chains)).join(audits, same(counted, audits)).select(counted["conv_id"], "gaps", "blank", "duplicate", "truncated", "illegal", F.col("way")["cost"].alias("cost"), "audit")
    return Repaired(report, repaired_turns(numbered, picked))


def repaired_turns(numbered: DataFrame, picked: DataFrame) -> DataFrame:
    """The rows after the edits, with the roles that the states along the way give them."""
    tokens = F.split(F.expr("substring(audit, 1, length(audit) - 1)"), ",")
    rows = picked.withColumn("tokens", tokens).select("conv_id", "block", "i", "more", F.element_at("ids", -1).alias("last_id"), F.explode(F.arrays_zip("ids", "tokens")).alias("x"))
    rows = rows.select("conv_id", "block", "i", (F.col("more") & (F.col("x")["ids"] == F.col("last_id"))).alias("more"), F.col("x")["ids"].alias("id"), F.col("x")["tokens"].alias("token"))
    rows = rows.join(numbered.select("id", "role", "text"), "id")
    # What stays before a row within its block decides its state: their number, and whether a system row leads.
    way = W.partitionBy("block").orderBy("id")
    stays = F.length(F.translate("token", "D", ""))
    system = (F.col("i") == 0) & F.col("token").startswith("K") & (F.substring("role", 1, 1) == "s")
    before = F.coalesce(F.sum(stays).over(way.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    led = F.coalesce(F.max(system).over(way.rowsBetween(W.unboundedPreceding, -1)), F.lit(False))
    rows = rows.withColumn("before", before).withColumn("led", led).withColumn("system", system)
    state = F.when(F.col("before") == 0, F.col("i")).otherwise(F.when((F.col("before") + F.when(F.col("i") == 2, 1).otherwise(0) - F.when(F.col("led"), 1).otherwise(0)) % 2 == 1, 2).otherwise(F.when(F.col("led") & (F.col("before") == 1), 1).otherwise(3)))
    rows = rows.withColumn("state", state)
    name = lambda s: F.when(s == 2, "assistant").otherwise("user")
    inserted, kept, turned = F.col("token").startswith("I"), F.col("token").rlike("^I?K"), F.col("token").rlike("^I?R")
    after_insert = F.when(inserted, F.when(F.col("state") == 2, 3).otherwise(2)).otherwise(F.col("state"))
    none = lambda: F.lit(None).cast("string")
    part = lambda k, test, role, text, edit: F.struct(F.lit(k).alias("part"), F.when(test, role).otherwise(none()).alias("role"), text.alias("text"), F.lit(edit).alias("edit") if isinstance(edit, str) else edit.alias("edit"))
    own = F.when(kept, F.col("role")).otherwise(name(after_insert))
    parts = F.array(part(0, inserted, name(F.col("state")), F.lit(""), "I"), part(1, kept | turned, own, F.col("text"), F.when(kept, "K").otherwise("R")), part(2, F.col("more"), F.lit("assistant"), F.lit(""), "I"))
    return rows.select("conv_id", F.col("id").alias("at"), F.inline(F.filter(parts, lambda p: p["role"].isNotNull())))


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): each conversation's repaired rows as ``role:text``, joined by newlines. A hash reads its
    input in order, so a conversation passes one task, row by row; nothing of it is held there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, conv, seen = hashlib.sha256(), None, False
        for batch in batches:
            done = []
            for key, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if seen and key == conv:
                    state.update(b"\n")
                else:
                    if seen:
                        done.append((conv, state.hexdigest()))
                    state, conv, seen = hashlib.sha256(), key, True
                state.update(line.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], batch.column("conv_id").type), pa.array([h for _, h in done], pa.string())], names=["conv_id", "repaired_sha256"])
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([conv], batch.column("conv_id").type), pa.array([state.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"])

    lines = turns.select("conv_id", "at", "part", F.concat("role", F.lit(":"), "text").alias("line")).repartition("conv_id").sortWithinPartitions("conv_id", "at", "part")
    kind = turns.schema["conv_id"].dataType.simpleString()
    return lines.select("conv_id", "line").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")

"""Conversations mended at the least cost: one integer per edit plan, whose minimum is the plan to take.

A plan is read row by row: keep, give another role, delete, or insert a turn
before the row. Its weight is one whole number. The high digits hold the cost; the
low ones, of a fixed number for the conversation, hold the letters of the plan
from the left, 1 to 4 in the order of the alphabet, and zeros behind its end. So
the ordinary minimum of two numbers is the cheaper plan, and of two plans of one
cost the one that comes first as a text, a plan before its continuations.

The nodes of the graph are (row, what the last role was), worked out from the
last row back. An edge adds its cost, moves the letters behind it one place down
and puts its own in front.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costflow.llm.common import SPACES, map_batches

# Fixed values of the contract.
KEEP_COST, ROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 3, 4, 3, 3
STOPS = ".!?"
LEGAL_PAIRS = {"su", "ua", "au"}
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"

#: Letters by their digit; zero is the end.
LETTERS = "\0DIKR"
DIGIT_BITS = 3
#: A turn more than this between two rows would come back to a role it left.
INSERTS = 2

#: What stands last: nothing yet, a system, user or assistant turn. A conversation may end at the first or the last.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: The role that may be inserted or given, and what then stands last.
FOLLOWING = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: The initials that may be kept, and what then stands last.
KEPT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}


def faults(rows: list[tuple[str, str]]) -> list[str | None]:
    """The first fault of each (role, text), if any."""
    seen: set[tuple[str, str]] = set()
    out: list[str | None] = []
    for row in rows:
        said = row[1].rstrip(SPACES)
        if not said:
            out.append(BLANK)
        elif row in seen:
            out.append(DUPLICATE)
        else:
            out.append(None if said[-1] in STOPS else TRUNCATED)
        seen.add(row)
    return out


def cheapest(rows: list[tuple[str, str]], found: list[str | None]) -> tuple[int, str]:
    """Cost and letters of the cheapest plan that leaves roles `(s?(ua)+)?`, the first of equal ones as a text."""
    places = len(rows) + INSERTS * (len(rows) + 1)
    above = DIGIT_BITS * places
    front = above - DIGIT_BITS
    mask = (1 << above) - 1
    never = 1 << (above + 64)

    def edge(cost: int, letter: int) -> int:
        return (cost << above) + (letter << front)

    def before(step: int, rest: int) -> int:
        letters = rest & mask
        return step + rest - letters + (letters >> DIGIT_BITS)

    delete, insert = edge(DELETE_COST, 1), edge(INSERT_COST, 2)

    def with_inserts(best: list[int]) -> list[int]:
        more = best
        for _ in range(INSERTS):
            more = [min(best[s], before(insert, more[FOLLOWING[s][1]])) for s in range(4)]
        return more

    best = with_inserts([0 if s in ENDS else never for s in range(4)])
    for (role, _), fault in zip(reversed(rows), reversed(found), strict=True):
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        keep, rerole = edge(KEEP_COST + extra, 3), edge(ROLE_COST + extra, 4)
        here = []
        for s in range(4):
            least = before(delete, best[s])
            if fault not in (BLANK, DUPLICATE):
                least = min(least, before(rerole, best[FOLLOWING[s][1]]))
                kept = KEPT[s].get(role[:1])
                if kept is not None:
                    least = min(least, before(keep, best[kept]))
            here.append(least)
        best = with_inserts(here)
    weight = best[START]
    letters = []
    for place in range(front, -1, -DIGIT_BITS):
        digit = weight >> place & (1 << DIGIT_BITS) - 1
        if not digit:
            break
        letters.append(LETTERS[digit])
    return weight >> above, "".join(letters)


def applied(rows: list[tuple[str, str]], plan: str) -> list[tuple[str, str]]:
    """The rows after the edits of a plan."""
    out, last, left = [], START, iter(rows)
    for letter in plan:
        role, text = (None, "") if letter == "I" else next(left)
        if letter == "D":
            continue
        if letter == "K":
            last = KEPT[last][role[:1]]
        else:
            role, last = FOLLOWING[last]
        out.append((role, text))
    return out


def mended(turns: list[tuple[int | None, str, str]]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired) of one conversation's (turn, role, text)."""
    numbers = {t for t, _, _ in turns if t is not None}
    rows = [(role, text) for _, role, text in turns]
    found = faults(rows)
    initials = [role[:1] for role, _ in rows]
    illegal = sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))
    cost, plan = cheapest(rows, found)
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    return gaps, *(found.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)), illegal, cost, plan, applied(rows, plan)


# -- on Spark ------------------------------------------------------------------

NUMBERS = ("gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost")
_REPAIRED = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_KINDS = [pa.int64()] * (1 + len(NUMBERS)) + [pa.string(), _REPAIRED]
_NAMES = ["conv_id", *NUMBERS, "audit", "repaired"]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batch(out: list[tuple]) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*out, strict=True)]
    columns[-1] = [[{"role": r, "text": t} for r, t in rows] for rows in columns[-1]]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES)


def _repair_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    size = 0
    for conv_id, rows in groupby(_rows(iter(batches)), key=lambda r: r[0]):
        turns = [(turn, role, text) for _, turn, role, text, gone in rows if not gone]
        out.append((conv_id, *mended(turns)))
        size += sum(len(text) for _, _, text in turns)
        if size > 1 << 22 or len(out) >= 2000:
            yield _batch(out)
            out, size = [], 0
    if out:
        yield _batch(out)


def repair(turns: DataFrame, gone: str | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired) for `turns` (conv_id, turn, role, text).

    One row per conversation, its turns by (turn, role, text), null turns first.
    `gaps` are whole numbers between the least and the largest turn that no row
    has. Each row has one fault at most: blank text; role and text of an earlier
    row; a last character that is no `.`, `!` or `?`. `illegal` counts neighbours
    whose initials are none of su, ua, au. `audit` is the cheapest plan of edits
    (see `cheapest`), `repaired` an array of (role, text) after it.

    Null roles and texts are empty, null conv_ids are one conversation, without
    any turn number there are no gaps. Repeated rows stay, and are duplicates.
    Where the column `gone` is true, a row says no more than that there is such a
    conversation; one of nothing else has zeros, an empty audit and no rows. Other
    columns are not read. An empty table gives an empty one.

    A task streams over sorted turns and holds one conversation, which is also
    one row of the result; the time for one grows with the square of its turns, at
    24 bytes of letters for each 64 of them.
    """
    narrow = turns.select(
        turns["conv_id"].cast("long").alias("conv_id"),
        turns["turn"].cast("long").alias("turn"),
        F.coalesce(turns["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(turns["text"].cast("string"), F.lit("")).alias("text"),
        (F.lit(False) if gone is None else F.coalesce(turns[gone], F.lit(False))).alias("gone"),
    )
    dealt = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = f"conv_id long, {', '.join(f'{c} long' for c in NUMBERS)}, audit string, repaired array<struct<role:string,text:string>>"
    return map_batches(dealt, _repair_task, schema)


def repaired_text(repaired: Column) -> Column:
    """`role:text` of each row, joined by newlines."""
    return F.array_join(F.transform(repaired, lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")


#: What `damaged` does to a row, by its number.
DROP, EMPTY, NO_STOPS, REPEAT, MAKE_USER = range(5)
KINDS_OF_DAMAGE = 20


def damaged(turns: DataFrame) -> DataFrame:
    """`turns` (conv_id, turn, role, text) with planted faults, and `gone` for rows that were dropped.

    By crc32(`conv_id:turn`) mod 20: 0 drops the row, 1 empties its text, 2 takes
    `.`, `!` and `?` out of it, 3 repeats it, 4 makes its role user. Nulls become
    one space, in this number as in role and text; ids and turns stay null.
    """
    some = lambda c: F.coalesce(turns[c].cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(some("conv_id"), F.lit(":"), some("turn")).cast("binary")) % KINDS_OF_DAMAGE
    rows = turns.select(
        turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"), some("role").alias("role"), some("text").alias("text"), kind.alias("kind")
    )
    text = F.when(F.col("kind") == EMPTY, "").when(F.col("kind") == NO_STOPS, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    changed = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == MAKE_USER, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("kind") == DROP).alias("gone"),
        F.when(F.col("kind") == REPEAT, 2).otherwise(1).alias("times"),
    )
    return changed.withColumn("time", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "time")

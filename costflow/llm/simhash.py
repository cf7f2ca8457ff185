"""SimHash near-duplicates: fingerprints, links by a general pigeonhole, components.

Steps, each on Spark partitions:

1. `fingerprints`: one 64-bit SimHash per text.
2. `distinct_prints`: exact copies fall together before any pair is looked at.
3. `plan_probes`: correlated bits share a part; a dynamic programme hands each
   part its own radius by estimated numbers of candidates.
4. `links`: probe, verify; crowded buckets are first tied to a few of their own
   members and then only compared across what is still apart.
5. `components`: smallest id within reach.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costflow.llm.common import first_per, map_batches, text_of, written
from costflow.llm.components import components

SHINGLE_WORDS = 4
HASH_SEED = 42
BITS = 64


def fingerprint(text: str) -> int:
    """SimHash of the word shingles as an unsigned number; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(line, HASH_SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends + 1 - sizes
    hashed = xxhash.xxh64_intdigest
    n = len(words) - SHINGLE_WORDS + 1
    values = np.fromiter(
        (
            hashed(line[a:b], HASH_SEED)
            for a, b in zip(starts[:n].tolist(), ends[SHINGLE_WORDS - 1 :].tolist(), strict=True)
        ),
        np.uint64,
        n,
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 65536):  # keeps the unpacked bits of a long text small
        block = values[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprint_batches(batches):
    for batch in batches:
        ids, texts = batch.columns
        prints = np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([ids, pa.array(prints.view(np.int64))], ["doc_id", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print): the fingerprint as a signed long."""
    return map_batches(
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text")),
        _fingerprint_batches,
        "doc_id long, print long",
    )


def distinct_prints(prints: DataFrame) -> DataFrame:
    """One row per print: exact copies, however many, meet in a partial aggregate."""
    return prints.groupBy("print").agg(F.min("doc_id").alias("doc_id"))


# -- the plan ------------------------------------------------------------------


@dataclass(frozen=True)
class Part:
    """Some of the bits, as a signed mask, and how far a probe reaches in them."""

    mask: int
    radius: int

    def flips(self) -> list[int]:
        bits = [1 << i for i in range(BITS) if self.mask >> i & 1]
        chosen = (c for r in range(self.radius + 1) for c in combinations(bits, r))
        return [signed(sum(c)) for c in chosen]


def signed(value: int) -> int:
    value &= (1 << BITS) - 1
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _bit_counts(batches):
    """How often two bits are set together: 64 x 64 numbers per task."""
    total, n = np.zeros((BITS, BITS), np.int64), 0
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(values), 65536):
            bits = (values[at : at + 65536, None] >> np.arange(BITS, dtype=np.uint64) & np.uint64(1)).astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
        n += len(values)
    cells = np.append(total.ravel(), n)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "n"])


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of prints, share of ones per bit, and correlation of the bits.

    All prints are counted; 4097 sums reach the driver, whatever their number.
    """
    rows = map_batches(prints.select("print"), _bit_counts, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1)
    for row in rows:
        cells[row["cell"]] = row["n"]
    n = int(cells[-1])
    together = cells[:-1].reshape(BITS, BITS) / max(n, 1)
    share = together.diagonal().copy()
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    return n, share, np.abs(together - np.outer(share, share)) / np.outer(spread, spread)


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of nearly equal width; each takes the bits most correlated with its own."""
    left = set(range(BITS))
    groups = []
    for k in range(parts):
        width = len(left) // (parts - k)
        inside = correlation[np.ix_(sorted(left), sorted(left))].sum(axis=1)
        group = [sorted(left)[int(inside.argmax())]]
        left -= set(group)
        while len(group) < width:
            rest = sorted(left)
            group.append(rest[int(correlation[np.ix_(rest, group)].sum(axis=1).argmax())])
            left.remove(group[-1])
        groups.append(group)
    return groups


def within(share: np.ndarray, bits: list[int], radius: int) -> float:
    """Share of pairs expected to differ in at most `radius` of the bits."""
    differ = np.zeros(radius + 2)
    differ[0] = 1.0
    for p in 2 * share[bits] * (1 - share[bits]):
        differ[1:] = differ[1:] * (1 - p) + differ[:-1] * p
        differ[0] *= 1 - p
        differ[-1] = 0.0
    return float(differ[: radius + 1].sum())


def allocate(costs: list[list[float]], units: int) -> list[int]:
    """Radius per part, -1 for a part that is not probed.

    `costs[p][u]` is the cost of radius u - 1 in part p. Two prints that differ
    in at most d bits agree within the radius of some part whenever the radii
    plus one sum to d + 1 (`units`); the dynamic programme takes the cheapest
    such split.
    """
    best = [(0.0, [])] + [(float("inf"), [])] * units
    for cost in costs:
        best = [
            min(((best[u - k][0] + cost[k], [*best[u - k][1], k - 1]) for k in range(u + 1)), key=lambda x: x[0])
            for u in range(units + 1)
        ]
    return best[units][1]


def _number_of_parts(n: int, share: np.ndarray, correlation: np.ndarray, units: int) -> int:
    def cost(parts: int) -> float:
        groups = group_bits(correlation, parts)
        costs = [[0.0] + [n * _reach(len(g), r) + n * n * within(share, g, r) for r in range(units)] for g in groups]
        return sum(c[r + 1] for c, r in zip(costs, allocate(costs, units), strict=True))

    return min(range(2, units + 1), key=cost)


def _reach(width: int, radius: int) -> int:
    return sum(comb(width, i) for i in range(radius + 1))


def plan_probes(prints: DataFrame, distance: int) -> list[Part]:
    """Parts and radii for `distance`, from statistics over all prints.

    Candidates of a part at radius 0 are counted (sum of squared bucket sizes);
    larger radii scale that count by the expected distances of its bits.
    """
    units = distance + 1
    n, share, correlation = bit_statistics(prints)
    n = max(n, 1)  # an empty table plans like one print, not for nothing
    groups = group_bits(correlation, _number_of_parts(n, share, correlation, units))
    masks = [signed(sum(1 << b for b in g)) for g in groups]
    buckets = prints.select(F.explode(F.array(*(_bucket(p, m) for p, m in enumerate(masks)))).alias("at"))
    pairs = dict.fromkeys(range(len(groups)), 0.0)
    pairs |= {
        row["part"]: float(row["pairs"])
        for row in buckets.groupBy("at").count().groupBy("at.part").agg(F.sum(F.col("count").cast("double") * F.col("count")).alias("pairs")).collect()
    }
    costs = [
        [0.0] + [n * _reach(len(g), r) + pairs[p] * within(share, g, r) / max(within(share, g, 0), 1e-30) for r in range(units)]
        for p, g in enumerate(groups)
    ]
    return [Part(m, r) for m, r in zip(masks, allocate(costs, units), strict=True) if r >= 0]


# -- probe and verify ----------------------------------------------------------


def _bucket(part: int, mask: int) -> Column:
    return F.struct(F.lit(part).alias("part"), F.col("print").bitwiseAND(F.lit(mask)).alias("value"))


def _members(prints: DataFrame, plan: list[Part]) -> DataFrame:
    """(part, value, ...): every print in its bucket of every part."""
    at = F.explode(F.array(*(_bucket(p, x.mask) for p, x in enumerate(plan)))).alias("at")
    return prints.select("*", at).select(*prints.columns, "at.part", "at.value")


def _probes(prints: DataFrame, plan: list[Part]) -> DataFrame:
    """(part, value, ...): every bucket within the radius of a print, its own and those of a smaller value.

    Of two prints with different values in a part, the one with the larger value
    finds the other; the way back would find the same pair again.
    """
    def around(part: int, x: Part) -> Column:
        own = F.col("print").bitwiseAND(F.lit(x.mask))
        near = F.filter(F.transform(F.lit(x.flips()), lambda f: own.bitwiseXOR(f.cast("long"))), lambda v: v <= own)
        return F.transform(near, lambda v: F.struct(F.lit(part).alias("part"), v.alias("value")))

    at = F.explode(F.concat(*(around(p, x) for p, x in enumerate(plan)))).alias("at")
    return prints.select("*", at).select(*prints.columns, "at.part", "at.value")


def _close(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def link_components(prints: DataFrame, distance: int) -> DataFrame:
    """(print, root) over distinct prints: root is the smallest print in reach.

    Not all pairs of a crowded bucket are looked at. First each member is held
    against one anchor of its bucket, which ties dense groups together; then
    probes leave out buckets that hold nothing but their own tied group, and
    pairs within one group. Every pair at most `distance` apart is either in one
    group or found by a probe.
    """
    plan = plan_probes(prints, distance)
    members = _members(prints, plan)
    anchors = members.groupBy("part", "value").agg(F.min("print").alias("anchor"))
    ties = (
        members.join(anchors, ["part", "value"])
        .where(F.col("print") != F.col("anchor"))
        .where(_close("print", "anchor", distance))
        .select(F.col("print").alias("a"), F.col("anchor").alias("b"))
    )
    tied = components(ties).select(F.col("node").alias("print"), F.col("root").alias("tie"))
    grouped = written(
        prints.select("print").join(tied, "print", "left").select("print", F.coalesce("tie", "print").alias("tie")),
        "prints",
    )

    members = _members(grouped, plan)
    kinds = members.groupBy("part", "value").agg(F.min("tie").alias("low"), F.max("tie").alias("high"))
    probes = (
        _probes(grouped, plan)
        .join(kinds, ["part", "value"])
        .where("low <> high or low <> tie")
        .select("part", "value", F.col("print").alias("asked"), F.col("tie").alias("asked_tie"))
    )
    found = (
        probes.join(members, ["part", "value"])
        .where(F.col("tie") != F.col("asked_tie"))
        .where(_close("print", "asked", distance))
        .select(F.col("tie").alias("a"), F.col("asked_tie").alias("b"))
    )
    merged = components(found).select(F.col("node").alias("tie"), "root")
    return grouped.join(merged, "tie", "left").select("print", F.coalesce("root", "tie").alias("root"))


def near_duplicates(docs: DataFrame, distance: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of `docs` (doc_id, text).

    Words `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z, shingles of four words
    with repeats (fewer words: the whole sequence), XXH64 with seed 42; a bit is
    set if it is set in over half of the hashes. Prints link at `distance` or
    fewer differing bits; `component_id` is the smallest doc_id in reach.

    Null and blank texts have print 0, which links like any other. Repeated rows
    are kept and share a component. Rows with a null doc_id stay; they lend no
    id, so a component of such rows alone has a null one. Other columns are not
    read. An empty table gives an empty one.
    """
    rows = written(fingerprints(docs), "fingerprints")
    prints = written(distinct_prints(rows), "prints")
    roots = link_components(prints.select("print"), distance)
    roots = written(roots, "roots").join(prints, "print")
    least = roots.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    least = written(roots.join(least, "root").select("print", "component_id"), "components")
    return rows.join(least, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, distance: int = 4) -> DataFrame:
    """`docs` with one row per group of near copies: that of the smallest doc_id.

    Groups are those of `near_duplicates`: shingles of four words, `distance` or fewer differing bits.

    Rows that repeat this doc_id leave one of them. Rows without a doc_id cannot
    be told apart and all stay. Columns and their order stay, whatever their names.
    """
    named = docs.where(docs["doc_id"].isNotNull())
    chosen = written(
        near_duplicates(named, distance).where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")),
        "chosen",
    )
    repeated = written(chosen.where("n > 1").select("doc_id"), "repeated")
    # Joined alike at every size: a few ids would be broadcast, many not. A merge can spill.
    once = named.join(chosen.where("n = 1").select("doc_id").hint("merge"), "doc_id", "left_semi")
    first = first_per(named.join(repeated, "doc_id", "left_semi"), "doc_id")
    unnamed = docs.where(docs["doc_id"].isNull())
    return once.select(*docs.columns).unionByName(first.select(*docs.columns)).unionByName(unnamed)

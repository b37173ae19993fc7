"""Mixing sources to target weights by Pfair scheduling.

Time is cut into slots of one block. A source with weight w, an exact fraction of the
whole, must have its block i in the window [floor(i / w), ceil((i + 1) / w)): release
time and deadline. Earliest deadline first over released blocks keeps every window as
the weights add up to one, so after any number of slots each source is less than one
block from its target. The schedule repeats after as many slots as the weights' common
denominator. The driver works it out for so many slots, or up to the last slot that a
block of the corpus needs if that comes first; blocks find their slots by a join.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_DOCUMENTS = 16
TEMPERATURE = 0.5
SEED = 17
ROWS_PER_BUCKET = 2_000


def exact_weights(weights: Mapping[str, float | str | Fraction]) -> dict[str, Fraction]:
    """Each weight's exact share of their sum; a float counts as the decimal it is written as."""
    exact = {n: Fraction(str(w)) for n, w in weights.items()}
    if not exact or min(exact.values()) <= 0:
        raise ValueError("weights must be positive")
    total = sum(exact.values())
    return {n: w / total for n, w in exact.items()}


def period_of(shares: Mapping[str, Fraction]) -> int:
    """Slots after which the schedule repeats."""
    return math.lcm(*(w.denominator for w in shares.values()))


def schedule(shares: Mapping[str, Fraction], length: int) -> list[str]:
    """The source of each slot: earliest deadline first among released blocks."""
    parts = {n: (w.numerator, w.denominator) for n, w in shares.items()}
    waiting = [(0, n, 0) for n in sorted(shares)]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    order = []
    for now in range(length):
        while waiting and waiting[0][0] <= now:
            _, n, i = heapq.heappop(waiting)
            up, down = parts[n]
            heapq.heappush(ready, (-(-(i + 1) * down // up), n, i))
        _, n, i = heapq.heappop(ready)
        order.append(n)
        up, down = parts[n]
        heapq.heappush(waiting, ((i + 1) * down // up, n, i + 1))
    return order


def mix(
    docs: DataFrame,
    weights: Mapping[str, float | str | Fraction] | None = None,
    block_documents: int = BLOCK_DOCUMENTS,
    temperature: float = TEMPERATURE,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """docs with block, slot, place and on_target; training order is (slot, place).

    Weights are met exactly as given (0.7 is seven tenths), up to a common factor, and
    must be above 0. Without weights a source's weight is its number of documents to the
    power `temperature`, rounded up to a whole number. Within a source the order is that of a hash of id and text, cut
    into blocks of `block_documents`. No row is dropped: a source's slots stay
    empty once it has run out, and on_target tells the rows before the first such
    slot, where the weights hold exactly. A null source is the source without a
    name; weights must name every source. Null ids and repeated rows stay rows of
    their own; columns called block, slot, place or on_target are replaced.
    """
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c not in ("block", "slot", "place", "on_target")]
    source = F.coalesce("source", F.lit(""))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id", "text"), 12)
    rows = docs.select(
        *[F.struct(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(columns)],
        source.alias("_source"),
        draw.alias("_draw"),
        F.col("doc_id").alias("_id"),
    )
    # One row per source: weights are a setting per source, so the driver holds no more.
    sizes = {
        r["s"]: r["n"] for r in docs.groupBy(source.alias("s")).agg(F.count("*").alias("n")).collect()
    }
    if not sizes:
        sizes = {"": 0}
    if weights is None:
        weights = {s: math.ceil(max(n, 1) ** temperature) for s, n in sizes.items()}
    elif missing := sorted(set(sizes) - set(weights)):
        raise ValueError(f"no weight for {missing}")
    shares = exact_weights(weights)
    blocks = {s: -(-sizes.get(s, 0) // block_documents) for s in shares}
    # The deadline of the block after a source's last is beyond its first empty slot.
    needed = max(math.ceil((blocks[s] + 1) / w) for s, w in shares.items())
    total = period_of(shares)
    order = schedule(shares, min(total, needed))
    placed: dict[str, list[int]] = {s: [] for s in shares}
    for at, s in enumerate(order):
        placed[s].append(at)
    # Blocks of a source per period; one that is cut short before its end is never gone through.
    slots = {s: int(w * total) if total <= needed else blocks[s] + 1 for s, w in shares.items()}

    def first_empty(s: str) -> int:
        cycle, turn = divmod(blocks[s], slots[s])
        return cycle * total + placed[s][turn]

    horizon = min(first_empty(s) for s in shares)
    turns = [(s, turn, at) for s, ats in placed.items() for turn, at in enumerate(ats)]
    slots_of = spark.createDataFrame(turns, "_source string, _turn bigint, _at bigint")
    parts = spark.createDataFrame(
        [(s, -(-n // rows_per_bucket) or 1, slots[s]) for s, n in sizes.items()],
        "_source string, _buckets bigint, _slots bigint",
    )
    # A bucket is a range of the draw, so the order does not depend on how many there are.
    bucketed = rows.join(F.broadcast(parts), "_source").withColumn(
        "_bucket", F.floor(F.col("_draw") / float(1 << 52) * F.col("_buckets")).cast("long")
    )
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        bucketed.groupBy("_source", "_bucket")
        .agg(F.count("*").alias("_n"))
        .select(
            "_source", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
        )
    )
    within = Window.partitionBy("_source", "_bucket").orderBy("_draw", "_id")
    ranked = (
        bucketed.withColumn("_rank", F.row_number().over(within) - 1)
        .join(offsets, ["_source", "_bucket"])
        .withColumn("_rank", F.col("_rank") + F.col("_offset"))
    )
    block = F.floor(F.col("_rank") / block_documents).cast("long")
    return (
        ranked.withColumn("_block", block)
        .withColumn("_turn", F.col("_block") % F.col("_slots"))
        .join(slots_of, ["_source", "_turn"])
        .withColumn(
            "_slot",
            F.floor(F.col("_block") / F.col("_slots")).cast("long") * total + F.col("_at"),
        )
        .select(
            *[F.col(f"_{i}").getField(c).alias(c) for i, c in enumerate(columns)],
            F.col("_block").alias("block"),
            F.col("_slot").alias("slot"),
            (F.col("_rank") % block_documents).cast("long").alias("place"),
            (F.col("_slot") < horizon).alias("on_target"),
        )
    )


def mix_report(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "source", "text")).select(
        "doc_id", "source", "block", "slot", "place", "on_target"
    )

"""Shards of near equal bytes by histogram sort, with DataFrame operations only.

Every row gets a sort key of 63 bits: 31 bits of its text's hash, then 32 bits
of a hash of its identity, so equal texts stand together and yet a text held
by a third of all rows can be cut anywhere.  The exact bytes below candidate
boundaries are counted over all partitions; each round splits the interval of
every unsettled splitter by further probes, until the count below each one
meets the tolerance or its interval can't be cut.  Then rows are exchanged once,
by fine ranges (``FINE`` per shard), and numbered inside them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.sources.store import materialize

KEY_BITS = 63
#: Key bits that the first and each later round of probes resolve.
FIRST_BITS, MORE_BITS = 14, 6
#: Ranges that one shard is sorted in.
FINE = 25
#: A splitter is settled when the bytes below it are this part of a shard's share from its target.
TOLERANCE = 0.001


def _histogram(keyed: DataFrame, shift: int, within: list[int] | None, bits: int) -> dict[int, int]:
    """Bytes of each interval of keys that agree down to bit ``shift``; of the given wider intervals only."""
    if within is not None:
        keyed = keyed.where(F.shiftright("key", shift + bits).isin(within))
    return {r[0]: r[1] for r in keyed.groupBy(F.shiftright("key", shift).alias("b")).agg(F.sum("size")).collect()}


def splitters(keyed: DataFrame, n: int, tolerance: float) -> list[int]:
    """n - 1 ascending keys that cut ``keyed`` (key, size) into n ranges of near equal bytes.

    The driver holds at most 2^FIRST_BITS, or n * 2^MORE_BITS, counts of a round.
    """
    shift, bits = KEY_BITS - FIRST_BITS, FIRST_BITS
    found = _histogram(keyed, shift, None, bits)
    total = sum(found.values())
    targets = [total * i / n for i in range(1, n)]
    cut: dict[int, int] = {}
    # interval (its leading bits, bytes below it) -> indexes of the targets inside; at first the whole range of keys
    open_at: dict[tuple[int, int], list[int]] = {(0, 0): list(range(n - 1))} if total else {}
    while open_at:
        bins: dict[int, list[int]] = {}
        for b in sorted(found):
            bins.setdefault(b >> bits, []).append(b)
        left: dict[tuple[int, int], list[int]] = {}
        for (prefix, below), wanted in open_at.items():
            inside, at = iter(bins[prefix]), below
            b = next(inside)
            for i in wanted:
                while at + found[b] < targets[i] and (following := next(inside, None)) is not None:
                    at += found[b]
                    b = following
                low, high = targets[i] - at, at + found[b] - targets[i]
                if min(low, high) <= tolerance or shift == 0:
                    cut[i] = (b if low <= high else b + 1) << shift
                else:
                    left.setdefault((b, at), []).append(i)
        open_at = left
        if open_at:
            bits = min(MORE_BITS, shift)
            shift -= bits
            found = _histogram(keyed, shift, sorted({b for b, _ in open_at}), bits)
    largest = (1 << KEY_BITS) - 1
    return [min(cut.get(i, largest), largest) for i in range(n - 1)]


def histogram_sort(docs: DataFrame, shards: int, carry: list[str] | None = None, overhead: int = 16) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, all by default), size, shard and slot of every row of ``docs``.

    ``size`` is the UTF-8 length of text, none for null, plus ``overhead``.
    Shards 0 to ``shards`` - 1 hold near equal bytes (a single row is never
    cut); ``slot`` numbers a shard's rows from 0 without gaps, in key order.
    Null and empty texts are texts of no bytes; null ids and repeated rows get
    slots of their own; an empty table gives an empty result.
    """
    whole = F.struct(*(docs[c] for c in (docs.columns if carry is None else carry)))
    text = F.coalesce(F.col("text"), F.lit(""))
    given = docs.select(
        whole.alias("row"),
        (F.octet_length(text).cast("long") + overhead).alias("size"),
        F.shiftrightunsigned(F.xxhash64(text), 33).alias("high"),
        F.col("doc_id").cast("string").alias("id"),
        F.monotonically_increasing_id().alias("at"),
    )
    key = F.shiftleft("high", 32) + F.shiftrightunsigned(F.xxhash64("id", "at"), 32)
    keyed = materialize(given.select("row", "size", key.alias("key")), "sharding/keyed")
    total = keyed.agg(F.sum("size")).first()[0] or 0
    cut = splitters(keyed, shards * FINE, TOLERANCE * total / shards)
    steps = 1 << len(cut).bit_length()
    literal = ",".join(f"{c}L" for c in cut + [(1 << KEY_BITS) - 1] * (steps - 1 - len(cut)))
    halves = ",".join(str(steps >> i) for i in range(1, steps.bit_length()))
    search = f"aggregate(array({halves}), 0, (lo, s) -> if(array({literal})[lo + s - 1] <= key, lo + s, lo))"
    ranged = keyed.withColumn("fine", F.least(F.expr(search), F.lit(shards * FINE - 1)))
    counts = ranged.groupBy("fine").agg(F.count("*").alias("n")).withColumn("shard", F.expr(f"CAST(fine DIV {FINE} AS INT)"))
    before = Window.partitionBy("shard").orderBy("fine").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("fine", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    slots = ranged.withColumn("nth", F.row_number().over(Window.partitionBy("fine").orderBy("key")))
    # offsets has at most shards * FINE rows
    placed = slots.join(F.broadcast(offsets), "fine")
    return placed.select("row", "size", "shard", (F.col("offset") + F.col("nth") - 1).alias("slot"))

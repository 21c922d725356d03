"""Hard negatives of anchors by exact inner products, filtered by rotated one-bit codes.

Vectors become integers (floor(``SCALE`` x)) and are rotated by a fixed random
rotation.  A code is the signs of a rotated vector; its alignment, the inner
product of vector and code over the dimension, is stored with it, so that
vector = alignment * code + rest.  The rest is rotated again and has a code of
its own, and so on ``CODES`` times; the length of what is left is stored,
rounded up.

An anchor's rotated vectors are cut into bit planes, so their inner product with
a code is a sum of popcounts.  The estimate is the sum of alignments times these.
What it misses is the rest's inner product with the anchor and that of the codes
with the planes' rounding: by Cauchy-Schwarz at most the product of the lengths,
so each pair has an interval that surely holds its score.  Pairs whose interval
can't matter are passed over: first by ``COARSE`` codes for all pairs, then by
all codes for what is left.  What survives is scored in integers.

Rows with the same label and vector are one class, named by its few smallest
ids: a vector that a third of all rows share is searched once, as one row and as
one anchor.  Anchors go through all rows in blocks of ``BLOCK``: a block is the
only thing that the driver holds and broadcasts, whatever the table.  Each task
keeps the best classes per anchor and hands on only these.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.words import U64
from daybook.sources.store import materialize

SCALE = 256
#: Codes of a vector; those that all pairs are tried with; bits of an anchor's component.
CODES, COARSE, PLANES = 8, 4, 8
#: Anchors of a block (of at most 4 bytes a component), and anchors and rows compared at once.
BLOCK, ANCHORS, ROWS = 32_768, 256, 4096
#: Survivors scored at once.
SCORED = 1 << 15

SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def rotations(dim: int) -> np.ndarray:
    """A fixed random rotation for each code."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((CODES, dim, dim)))
    return q * np.sign(np.diagonal(r, axis1=1, axis2=2))[:, None]


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    words = -(-bits.shape[-1] // 64)
    out = np.zeros((*bits.shape[:-1], words * 8), np.uint8)
    raw = np.packbits(bits, axis=-1, bitorder="little")
    out[..., : raw.shape[-1]] = raw
    return out.view(U64)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes [n, CODES, words], alignments [n, CODES], lengths of what is left, lengths) of integer vectors."""
    n, dim = vectors.shape
    rest = vectors.astype(np.float64)
    length = np.sqrt((rest**2).sum(1))
    codes = np.zeros((n, CODES, -(-dim // 64)), U64)
    alignment = np.zeros((n, CODES), np.float32)
    for level, turn in enumerate(rotations(dim)):
        rest = rest @ turn.T
        signs = rest >= 0
        codes[:, level] = _packed(signs)
        code = np.where(signs, 1.0, -1.0)
        alignment[:, level] = (rest * code).sum(1) / dim
        rest -= alignment[:, level, None].astype(np.float64) * code  # what the stored alignment leaves
    left = np.sqrt((rest**2).sum(1))
    return codes, alignment, np.nextafter(left.astype(np.float32), np.float32(np.inf)), length


class Planes:
    """Anchors as bit planes of their rotated vectors, for each code."""

    def __init__(self, vectors: np.ndarray) -> None:
        n, self.dim = vectors.shape
        self.whole = vectors.astype(np.int64)
        turned = vectors.astype(np.float64)
        self.length = np.sqrt((turned**2).sum(1))
        self.low, self.step, self.missed = (np.zeros((n, CODES)) for _ in range(3))
        self.total = np.zeros((n, CODES), np.int64)
        self.planes = np.zeros((n, CODES, PLANES, -(-self.dim // 64)), U64)
        for k, turn in enumerate(rotations(self.dim)):
            turned = turned @ turn.T
            low = turned.min(1)
            step = (turned.max(1) - low) / (2**PLANES - 1)
            step = np.where(step > 0, step, 1.0)
            level = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
            for p in range(PLANES):
                self.planes[:, k, p] = _packed((level >> p & 1).astype(bool))
            self.low[:, k], self.step[:, k], self.total[:, k] = low, step, level.sum(1)
            self.missed[:, k] = np.sqrt(((turned - low[:, None] - step[:, None] * level) ** 2).sum(1))


class Rows:
    """Coded rows."""

    def __init__(self, vectors: np.ndarray, codes: np.ndarray, alignment: np.ndarray, left: np.ndarray, length: np.ndarray) -> None:
        self.whole, self.codes = vectors, codes
        self.alignment, self.left, self.length = alignment.astype(np.float64), left.astype(np.float64), length
        self.coded = math.sqrt(vectors.shape[1]) * np.abs(self.alignment)  # lengths of alignment * code
        # What the first codes leave; a rest is square to its code, but for the rounding of the alignment.
        self.coarse_left = np.sqrt(self.left**2 + (self.coded[:, COARSE:] ** 2).sum(1)) * (1 + 1e-6)
        self.ones = np.bitwise_count(codes).sum(2, dtype=np.int64)  # ones of each code

    def __len__(self) -> int:
        return len(self.whole)


def _products(q: Planes, a, r: Rows, b, level: int, dense: bool) -> np.ndarray:
    """Inner products of the anchors' planes with one code: of all pairs (dense), or of a and b side by side."""
    code = r.codes[b, level]
    total = 0
    for p in range(PLANES):
        plane = q.planes[a, level, p]
        both = plane[:, None] & code[None] if dense else plane & code
        total = total + (np.bitwise_count(both).sum(-1, dtype=np.int32) << p)
    side = (lambda x: x[:, None]) if dense else (lambda x: x)
    ones = r.ones[b, level]
    # The sum over components of (low + step * level) * (1 or -1).
    return side(q.low[a, level]) * (2 * ones - q.dim) + side(q.step[a, level]) * (2.0 * total - side(q.total[a, level]))


def coarse(q: Planes, a: slice, r: Rows, b: slice) -> tuple[np.ndarray, np.ndarray]:
    """(estimate, half width) of the scores of all pairs, by the first codes."""
    estimate = sum(r.alignment[b, level] * _products(q, a, r, b, level, True) for level in range(COARSE))
    lost = q.missed[a, :COARSE] @ r.coded[b, :COARSE].T
    return estimate, _width(q.length[a, None], r.length[b], r.coarse_left[b], lost)


def fine(q: Planes, a: np.ndarray, r: Rows, b: np.ndarray, estimate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimate, half width) of the scores of some pairs, by all codes."""
    for level in range(COARSE, CODES):
        estimate = estimate + r.alignment[b, level] * _products(q, a, r, b, level, False)
    return estimate, _width(q.length[a], r.length[b], r.left[b], (q.missed[a] * r.coded[b]).sum(1))


def _width(anchor, row, left, lost):
    """Cauchy-Schwarz for the rest, what the planes' rounding loses, and room for the rounding of floats."""
    return anchor * left + lost + 1e-9 * anchor * row + 1


def scores(q: Planes, a: np.ndarray, r: Rows, b: np.ndarray) -> np.ndarray:
    """Integer scores of some pairs."""
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), SCORED):
        out[i : i + SCORED] = np.einsum("ij,ij->i", q.whole[a[i : i + SCORED]], r.whole[b[i : i + SCORED]])
    return out


class Best:
    """The first ``keep`` classes of each key: higher scores first, then smaller first ids."""

    def __init__(self, keys: int, keep: int, width: int) -> None:
        self.keep = keep
        self.key, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros((0, width), np.int64)
        self.count = np.zeros(0, np.int64)
        self.worst = np.full(keys, -np.inf)  # of a key with all its classes

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        if not len(key):
            return
        touched = np.zeros(len(self.worst), bool)
        touched[key] = True
        old = touched[self.key]
        key, score = np.concatenate([self.key[old], key]), np.concatenate([self.score[old], score])
        ids, count = np.concatenate([self.ids[old], ids]), np.concatenate([self.count[old], count])
        order = np.lexsort((ids[:, 0], -score, key))
        key = key[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        place = np.arange(len(key)) - np.flatnonzero(first)[np.cumsum(first) - 1]
        kept = order[place < self.keep]
        full = place == self.keep - 1
        self.worst[key[full]] = score[order[full]]
        sorted_key = key[place < self.keep]
        self.key, self.score = np.concatenate([self.key[~old], sorted_key]), np.concatenate([self.score[~old], score[kept]])
        self.ids, self.count = np.concatenate([self.ids[~old], ids[kept]]), np.concatenate([self.count[~old], count[kept]])


def _survivors(q: Planes, a: slice, r: Rows, b: slice, least: np.ndarray, most: np.ndarray, other: np.ndarray | None, keep: int):
    """Pairs of a tile (anchor, row) whose interval reaches from ``least`` on and begins by ``most``, both by anchor.

    Where an anchor has no least score yet (-inf), the ``keep``-th best lower end of the tile is one.
    ``other``: pairs that may take part.
    """
    estimate, width = coarse(q, a, r, b)
    if (unset := np.isneginf(least)).any() and estimate.shape[1] > keep:
        lower = (estimate - width)[unset]
        least = least.copy()
        least[unset] = np.partition(lower, lower.shape[1] - keep, axis=1)[:, -keep]
    may = (estimate + width >= least[:, None]) & (estimate - width <= most[:, None])
    if other is not None:
        may &= other
    x, y = np.nonzero(may)
    if not len(x):
        return x, y
    middle, half = fine(q, x + a.start, r, y + b.start, estimate[x, y])
    still = (middle + half >= least[x]) & (middle - half <= most[x])
    return x[still] + a.start, y[still] + b.start


def _tiles(n: int, size: int) -> Iterator[slice]:
    return (slice(i, min(i + size, n)) for i in range(0, n, size))


def nearest_of_label(q: Planes, label: np.ndarray, r: Rows, row_label: np.ndarray, ids: np.ndarray, count: np.ndarray, best: Best) -> None:
    """Adds to ``best`` (by anchor) the rows of each anchor's label.  Anchors are in order of their labels."""
    order = np.argsort(row_label, kind="stable")
    start = np.searchsorted(row_label[order], label_values := np.unique(label))
    stop = np.searchsorted(row_label[order], label_values, "right")
    for value, i, j in zip(label_values, start.tolist(), stop.tolist(), strict=True):
        if i == j:
            continue
        members = order[i:j]
        part = Rows(r.whole[members], r.codes[members], r.alignment[members], r.left[members], r.length[members])
        first, last = np.searchsorted(label, value), np.searchsorted(label, value, "right")
        for b in _tiles(len(part), ROWS):
            for a in _tiles(last - first, ANCHORS):
                a = slice(a.start + first, a.stop + first)
                x, y = _survivors(q, a, part, b, best.worst[a], np.full(a.stop - a.start, np.inf), None, best.keep)
                best.add(x, scores(q, x, part, y), ids[members[y]], count[members[y]])


def negatives_below(q: Planes, label: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray, r: Rows, row_label: np.ndarray, ids: np.ndarray, count: np.ndarray, best: Best) -> None:
    """Adds to ``best`` (by band) the rows of other labels whose score is in a band of their anchor.

    ``wanted[i]:wanted[i + 1]`` are anchor i's bands, ``low`` and ``high`` their ends.
    """
    for b in _tiles(len(r), ROWS):
        for a in _tiles(len(label), ANCHORS):
            bands = slice(wanted[a.start], wanted[a.stop])
            if bands.start == bands.stop:
                continue
            owner = np.repeat(np.arange(a.stop - a.start), np.diff(wanted[a.start : a.stop + 1]))
            least, most = np.full(a.stop - a.start, np.inf), np.full(a.stop - a.start, -np.inf)
            np.minimum.at(least, owner, np.maximum(low[bands], best.worst[bands]))
            np.maximum.at(most, owner, high[bands].astype(np.float64))
            x, y = _survivors(q, a, r, b, least, most, label[a, None] != row_label[None, b], best.keep)
            score = scores(q, x, r, y)
            for k in range(int(np.diff(wanted[a.start : a.stop + 1]).max())):
                band = wanted[x] + k
                there = band < wanted[x + 1]
                band, z = band[there], np.flatnonzero(there)
                inside = (score[z] >= low[band]) & (score[z] <= high[band]) & (score[z] >= best.worst[band])
                band, z = band[inside], z[inside]
                best.add(band, score[z], ids[y[z]], count[y[z]])


# -- Spark ---------------------------------------------------------------------


def _ints(column: pa.Array, dim: int) -> np.ndarray:
    """A column of packed integer vectors as an array."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.int32).reshape(-1, dim).astype(np.int64)


def _quantising(dim: int):
    most = math.isqrt((1 << 62) // max(1, dim))  # so that no score leaves 64 bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("embedding").cast(pa.large_list(pa.float64())).flatten(), np.float64).reshape(-1, dim)
            whole = np.floor(SCALE * x)
            fits = (np.abs(whole) <= min(most, 2**31 - 1)).all(1)
            raw = whole[fits].astype(np.int32).tobytes()
            packed = pa.array([raw[i : i + 4 * dim] for i in range(0, len(raw), 4 * dim)], pa.binary())
            kept = batch.filter(pa.array(fits))
            yield pa.RecordBatch.from_arrays([kept.column("vec_id"), kept.column("label"), kept.column("anchor"), packed], ["vec_id", "label", "anchor", "vector"])

    return run


def _coding(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, alignment, left, length = encode(_ints(batch.column("vector"), dim))
            names = batch.schema.names
            raw = [pa.array([x.tobytes() for x in part], pa.binary()) for part in (codes, alignment)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *raw, pa.array(left), pa.array(length)], [*names, "codes", "alignment", "rest", "length"])

    return run


def _rows(batch: pa.RecordBatch, dim: int, width: int) -> tuple[Rows, np.ndarray, np.ndarray, np.ndarray]:
    vectors = _ints(batch.column("vector"), dim)
    n = len(vectors)
    codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), U64).reshape(n, CODES, -1)
    alignment = np.frombuffer(b"".join(batch.column("alignment").to_pylist()), np.float32).reshape(n, CODES)
    listed = batch.column("ids")
    count = np.array(listed.value_lengths(), np.int64)
    ids = np.zeros((n, width), np.int64)
    ids[np.arange(width) < count[:, None]] = np.array(listed.flatten(), np.int64)
    rows = Rows(vectors, codes, alignment, np.array(batch.column("rest")), np.array(batch.column("length")))
    return rows, np.array(batch.column("label"), np.int64), ids, count


def _found(best: Best, key: np.ndarray, q: np.ndarray, limit: np.ndarray) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum(best.count)]).astype(np.int32)
    flat = best.ids[np.arange(best.ids.shape[1]) < best.count[:, None]]
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(q[key]), pa.array(limit[best.key]), pa.array(best.score), lists], ["q", "limit", "score", "ids"])


def _positives(block, dim: int, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, label, raw, _ = block.value
        anchors = Planes(np.frombuffer(raw, np.int32).reshape(-1, dim))
        best = Best(len(q), keep, keep)
        for batch in batches:
            nearest_of_label(anchors, label, *_rows(batch, dim, keep), best)
        yield _found(best, best.key, q, np.zeros(len(q), np.int64))

    return run


def _negatives(block, dim: int, keep: int, width: int, least: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, label, raw, limits = block.value
        anchors = Planes(np.frombuffer(raw, np.int32).reshape(-1, dim))
        wanted = np.concatenate([[0], np.cumsum([len(x) for x in limits])])
        limit = np.array([s for x in limits for s in x], np.int64)
        low = limit // 100 * least - -(limit % 100 * least) // 100  # rounded up
        high = limit // 100 * most + limit % 100 * most // 100
        owner = np.repeat(np.arange(len(q)), np.diff(wanted))
        best = Best(len(limit), keep, width)
        for batch in batches:
            negatives_below(anchors, label, wanted, low, high, *_rows(batch, dim, width), best)
        yield _found(best, owner[best.key], q, limit)

    return run


def _searched(classes: DataFrame, anchors: DataFrame, limits: DataFrame | None, make, name: str) -> DataFrame:
    """All classes searched for the anchors, block by block: (q, limit, score, ids) of the best of each task."""
    spark = classes.sparkSession
    found = None
    for (block,) in sorted(anchors.select("block").distinct().collect()):
        table = anchors.where(F.col("block") == block)
        if limits is not None:
            table = table.join(limits, "q")
        rows = table.orderBy("label", "q").collect()
        if not rows:
            continue
        packed = (
            np.array([r["q"] for r in rows], np.int64),
            np.array([r["label"] for r in rows], np.int64),
            b"".join(bytes(r["vector"]) for r in rows),
            [sorted(r["limits"]) for r in rows] if limits is not None else None,
        )
        shared = spark.sparkContext.broadcast(packed)
        part = materialize(classes.mapInArrow(make(shared), "q long, limit long, score long, ids array<long>"), name)
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], "q long, limit long, score long, ids array<long>")


def _first_rows(found: DataFrame, keep: int) -> DataFrame:
    """(q, limit, score, id): the first ``keep`` rows of each q and limit, from the classes that the tasks kept."""
    by_class = Window.partitionBy("q", "limit").orderBy(F.desc("score"), F.col("ids")[0])
    some = found.withColumn("n", F.row_number().over(by_class)).where(F.col("n") <= keep)
    rows = some.select("q", "limit", "score", F.explode("ids").alias("id"))
    by_row = Window.partitionBy("q", "limit").orderBy(F.desc("score"), "id")
    return rows.withColumn("n", F.row_number().over(by_row)).where(F.col("n") <= keep)


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100) -> DataFrame:
    """Hard negatives for every row of ``vectors`` (vec_id, embedding, label) for which ``anchor`` holds.

    A component x counts as floor(256 x), a pair's score is the integer inner
    product; higher scores come first, then smaller ids.  An anchor's positives
    are its first ``positives`` other rows of the same label.  For each of them
    the first ``negatives`` rows of other labels whose score is between
    ``least`` and ``most`` percent of the positive's are returned: anchor_id,
    positive_id, rank (from 1), negative_id, positive_score, negative_score.
    An anchor or positive without any has no row.

    Rows with a null id, label or vector, an empty vector, a null or non-finite
    component, or one so large that scores would leave 64 bits take no part.
    Rows equal in id, label and vector count once, and rows with the anchor's
    id are not its positives.  Vectors of different length are an error; an
    empty table gives an empty result.  Further columns are ignored.
    """
    spark = vectors.sparkSession
    spread = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    sound = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND size(embedding) > 0").where(spread)
    sizes = sound.agg(F.min(F.size("embedding")).alias("least"), F.max(F.size("embedding")).alias("most")).first()
    if sizes["least"] is None:
        return spark.createDataFrame([], SCHEMA)
    if (dim := sizes["least"]) != sizes["most"]:
        raise ValueError(f"vectors have from {dim} to {sizes['most']} components")
    given = sound.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), "embedding")
    whole = given.mapInArrow(_quantising(dim), "vec_id long, label long, anchor boolean, vector binary")
    whole = materialize(whole.groupBy("vec_id", "label", "vector").agg(F.max("anchor").alias("anchor")), "negatives/rows")

    keep = positives + 1  # one of them may be the anchor
    width = max(keep, negatives)
    smallest = Window.partitionBy("label", "vector").orderBy("vec_id")
    classes = whole.withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= width)
    classes = classes.groupBy("label", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    coded = "label long, vector binary, ids array<long>, codes binary, alignment binary, rest float, length double"
    classes = materialize(classes.mapInArrow(_coding(dim), coded), "negatives/classes")

    anchors = whole.where("anchor").select(F.col("vec_id").alias("anchor_id"), "label", "vector")
    kinds = materialize(anchors.select("label", "vector").distinct().withColumn("q", F.monotonically_increasing_id()), "negatives/anchors")
    blocks = -(-kinds.count() // BLOCK) or 1
    kinds = kinds.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks)))
    anchors = materialize(anchors.join(kinds, ["label", "vector"]).select("anchor_id", "q"), "negatives/asking")

    near = _searched(classes, kinds, None, lambda block: _positives(block, dim, keep), "negatives/near")
    near = _first_rows(near, keep).select("q", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    nth = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    pairs = anchors.join(near, "q").where("positive_id <> anchor_id").withColumn("n", F.row_number().over(nth)).where(F.col("n") <= positives).drop("n")
    pairs = materialize(pairs, "negatives/positives")

    limits = pairs.groupBy("q").agg(F.collect_set("positive_score").alias("limits"))
    far = _searched(classes, kinds, limits, lambda block: _negatives(block, dim, negatives, width, least, most), "negatives/far")
    far = _first_rows(far, negatives).select("q", F.col("limit").alias("positive_score"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), F.col("n").alias("rank"))
    return pairs.join(far, ["q", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

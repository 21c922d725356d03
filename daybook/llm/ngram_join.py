"""Exact n-gram Jaccard join by universe partitioning and the pigeonhole principle.

Two shingle sets r and s of Jaccard similarity t or more differ in at most
``H = floor((1-t)/(1+t) * (|r|+|s|))`` shingles.  Sets are put into size
bands; in each band the universe of shingles is hashed into m segments, so a
set falls apart into m subsets.  A probe gives each segment i an allowance
v_i of -1 (not looked at), 0 (equal subsets) or 1 (equal up to one deletion).
If the sum of (v_i + 1) exceeds H, some segment's subsets differ by v_i or
less, whatever the other set is; so looking up those subsets, and the
one-deletion neighbourhoods where v_i = 1, misses no link.

* **Index.**  Every set puts the subsets of all segments of its band under
  their hash, and the one-deletion neighbours of a few flexible segments.
* **Cost-based allocation.**  A probe spends H + 1 units.  The expected list
  behind a subset shrinks with its size, an empty subset's list being as long
  as the band is populous; so units go to the fullest segments first, then to
  a second unit on flexible segments (their deletions are looked up too), and
  to empty subsets only when nothing else is left.  Segments are a few more
  than H + 1, so nearly every probe can leave its empty ones alone.
* **Hot lists.**  Lists aren't expanded into pairs.  A list is first checked
  as a star around one member; members that are linked, directly or through
  others, need no further check within it.  What remains are pairs across the
  components of a list: its members outside the largest component against all
  others, compared by their bitmaps in tiles of bounded size.  A tile doesn't
  write these pairs: members that candidates join to each other make a group,
  one row each, and equal groups of several lists are one.  The texts of a
  group meet in one place, which finds the links that join its components.
* **Verification.**  A parity bitmap of each set (its weight of difference
  never exceeds the true difference) drops most false candidates; the rest is
  decided on the shingle sets of the texts themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.arrow import by_bytes
from daybook.llm.components import connected_components
from daybook.llm.words import U64, mix, shingle_sets
from daybook.session import scratch_path
from daybook.sources.store import delete_path, materialize

PROBE, INDEX = 1, 2
#: What is left open is compared in tiles if that is at most so many comparisons of bitmaps for each listed row; else another star comes first.
COMPARED_PER_ROW = 256
MAX_STARS = 4
#: Bits (of pages of PAGE bits) that tell which texts verification wants: 2 MB to broadcast, however many they are.
WANTED_BITS, PAGE = 1 << 24, 1 << 15
#: Members of a list, and their shingles, that are about a tile; two tiles are compared in one group.
TILE, TILE_SHINGLES = 4096, 1 << 20


class Bands:
    """Size bands and their segments for a threshold of ``percent``/100.  Band b holds the sizes in (top[b-1], top[b]]."""

    def __init__(self, percent: int) -> None:
        if not 0 < percent <= 100:
            raise ValueError("the threshold is a percentage from 1 to 100")
        self.percent = percent
        self.top = [1]

    def partner(self, n: int) -> int:
        """The largest size that can link with a set of n shingles."""
        return n * 100 // self.percent

    def differing(self, a: int, b: int) -> int:
        """The most shingles by which linked sets of sizes a and b differ."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def of(self, n: int) -> int:
        while self.top[-1] < n:
            last = self.top[-1]
            self.top.append(max(last + 1, self.partner(self.partner(last))))
        return int(np.searchsorted(self.top, n))

    def segments(self, b: int) -> tuple[int, int]:
        """(segments, flexible ones among them, which come first)"""
        most = self.differing(self.top[b], self.partner(self.top[b]))
        m = most + 1 + (1 + most // 16 if most else 0)
        return m, min(m, max(1, m // 32))


def _subsets(shingles: np.ndarray, band: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segment of each shingle, its share of the subset hash, and the hash and size of each segment's subset."""
    spread = mix(shingles ^ U64((band + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    segment = ((spread >> U64(32)) * U64(m) >> U64(32)).astype(np.int64)
    share = mix(spread ^ U64(0x5851F42D4C957F2D))
    total = mix(np.arange(m, dtype=U64) + U64(band << 32))  # a segment's empty subset
    np.add.at(total, segment, share)
    return segment, share, total, np.bincount(segment, minlength=m)


def allocate(sizes: np.ndarray, flexible: int, units: int) -> tuple[np.ndarray, np.ndarray]:
    """The cheapest allowances worth ``units``: (segments looked up, those of them looked up with deletions)."""
    by_cost = np.argsort(-sizes, kind="stable")
    full = int(np.count_nonzero(sizes))
    if units <= full:
        return by_cost[:units], by_cost[:0]
    twice = np.flatnonzero(sizes[:flexible] > 0)
    twice = twice[np.argsort(-sizes[twice], kind="stable")][: units - full]
    empty = max(0, units - full - len(twice))
    return by_cost[: full + empty], twice


def signatures(shingles: np.ndarray, bands: Bands) -> tuple[np.ndarray, int, int]:
    """Keys of one set: first those both indexed and probed, then those indexed only, then those probed only."""
    n = len(shingles)
    both, index, probe = [], [], []
    own = bands.of(n)
    for b in (own, own - 1):
        if b < 0 or (b < own and n > bands.partner(bands.top[b])):
            continue
        m, flexible = bands.segments(b)
        units = bands.differing(n, min(n, bands.top[b])) + 1
        if units == 1 and m == 1:
            continue  # only equal sets could link, and those are one class already
        segment, share, total, sizes = _subsets(shingles, b, m)
        looked, twice = allocate(sizes, flexible, units)
        chosen = np.zeros(m, bool)
        chosen[looked] = True
        bend = np.flatnonzero(segment < flexible)
        deletions, in_twice = total[segment[bend]] - share[bend], np.isin(segment[bend], twice)
        if b == own:
            both += [total[chosen], deletions[in_twice]]
            index += [total[~chosen], deletions[~in_twice]]
        else:
            probe += [total[chosen], deletions[in_twice]]
    keys = [np.concatenate(x) if x else np.zeros(0, U64) for x in (both, index, probe)]
    return np.concatenate(keys), len(keys[0]), len(keys[0]) + len(keys[1])


def parity(shingles: np.ndarray) -> bytes:
    """Bitmap of shingle parities, one or two bits for each shingle (a power of two), so that few differences meet."""
    bits = max(64, 1 << max(0, int(len(shingles) - 1)).bit_length())
    return np.packbits(_parities(shingles, bits)).tobytes()


def _parities(shingles: np.ndarray, bits: int) -> np.ndarray:
    at = np.bincount((mix(shingles ^ U64(0x2545F4914F6CDD1D)) >> U64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return at.astype(np.uint8)


def _describe(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, last = Bands(percent), None
        for whole, batch in ((whole, part) for whole in batches for part in by_bytes(whole)):
            node, size, bitmap, keys, both, index = [], [], [], [], [], []
            if whole is not last:
                seen: set[int] = set()
                last = whole
            for x in shingle_sets(batch.column("text"), k):
                if not len(x):
                    node.append(None), size.append(0), bitmap.append(None), keys.append(None), both.append(0), index.append(0)
                    continue
                own = int(mix(np.array([np.add.reduce(mix(x)) ^ U64(len(x))], U64)).view(np.int64)[0])
                node.append(own), size.append(len(x))
                if own in seen:  # an equal set of this batch already has its keys
                    bitmap.append(None), keys.append(None), both.append(0), index.append(0)
                    continue
                seen.add(own)
                s, a, b = signatures(x, bands)
                bitmap.append(parity(x)), keys.append(s.view(np.int64)), both.append(a), index.append(b)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(node, pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(bitmap, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(both, pa.int32()),
                    pa.array(index, pa.int32()),
                ],
                ["doc_id", "text_hash", "node", "n_shingles", "bitmap", "keys", "n_both", "n_index"],
            )

    return run


_STAR = "key long, center long, center_size long, center_role int, node long, size long, role int"


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, node) to a row (center, member) for each further node of a key; the center is its first node.

    A key's rows may run over batches: its center is all that is carried.
    """
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, node, size, role = (batch.column(c).to_numpy() for c in ("key", "node", "size", "role"))
        if last is not None:
            key, node, size, role = (np.concatenate([[a], b]) for a, b in zip(last, (key, node, size, role), strict=True))
        starts = np.concatenate([[True], key[1:] != key[:-1]])
        center = np.maximum.accumulate(np.where(starts, np.arange(len(key)), 0))
        at = np.flatnonzero(node != node[center])
        c = center[at]
        last = tuple(x[center[-1]] for x in (key, node, size, role))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (key[at], node[c], size[c], role[c].astype(np.int32), node[at], size[at], role[at].astype(np.int32))],
            ["key", "center", "center_size", "center_role", "node", "size", "role"],
        )


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (len(x) + len(y) - shared) and shared > 0


def _close(percent: int, k: int):
    """Whether the texts of each row have similar shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(shingle_sets(batch.column("a_text"), k), shingle_sets(batch.column("b_text"), k), strict=True):
                good.append(_linked(x, y, percent))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return run


def _folded(bitmap: bytes, width: int) -> np.ndarray:
    """A bitmap of a smaller width: parities at positions that become the same add up."""
    return np.bitwise_xor.reduce(np.frombuffer(bitmap, np.uint8).reshape(-1, width), axis=0)


def _near(percent: int):
    """Pairs whose bitmaps differ in no more places than linked sets of their sizes can."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            good = []
            for n, x, m, y in zip(*(batch.column(c).to_pylist() for c in ("an", "am", "bn", "bm")), strict=True):
                width = min(len(x), len(y))
                apart = int(np.bitwise_count(_folded(x, width) ^ _folded(y, width)).sum())
                good.append(apart <= bands.differing(n, m))
            yield batch.filter(pa.array(good, pa.bool_())).drop_columns(["an", "am", "bn", "bm"])

    return run


class _Tables:
    """The working tables of one join, written below one folder that goes at its end."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.root, self.n = spark, scratch_path(spark, f"daybook/jaccard/{uuid.uuid4().hex}"), 0

    def write(self, rows: DataFrame, name: str) -> DataFrame:
        self.n += 1
        return materialize(rows, name, f"{self.root}/{self.n:03d}_{name}")

    def drop(self, name: str) -> None:
        for n in range(1, self.n + 1):
            delete_path(self.spark, f"{self.root}/{n:03d}_{name}")

    def drop_all(self) -> None:
        delete_path(self.spark, self.root)


def _marked(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``docs`` without most of the rows that ``wanted`` (d, h) doesn't name, so that few texts are exchanged for the join.

    The wanted rows' hashes are marked in a bitmap of fixed size.  It is only a
    filter: a row that is wanted is marked, and the join drops what else is.
    """
    place = f"pmod(xxhash64({{}}, {{}}), {WANTED_BITS}L)"
    marks = wanted.selectExpr(f"{place.format('d', 'h')} AS place").selectExpr(f"place DIV {PAGE} AS page", f"place % {PAGE} AS bit")
    pages = marks.repartition("page").groupBy("page").agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))
    placed = docs.withColumn("place", F.expr(place.format("doc_id", "text_hash"))).withColumn("page", F.expr(f"place DIV {PAGE}"))
    byte = f"CAST(conv(hex(substring(bits, CAST(place % {PAGE} DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    found = placed.join(F.broadcast(pages), "page").where(f"getbit({byte}, CAST(place % 8 AS INT)) = 1")
    return found.select("doc_id", "text_hash", "text")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) for the rows of ``wanted`` (node, d, h)."""
    some = _marked(docs, wanted)
    texts = some.join(wanted, some["doc_id"].eqNullSafe(wanted["d"]) & (some["text_hash"] == wanted["h"])).select("node", "text")
    return texts.dropDuplicates(["node"])


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, k: int, tables: _Tables) -> DataFrame:
    """The pairs (a, b), each of nodes with their sizes, that truly link."""
    sized = pairs.where(f"100 * least(a_size, b_size) >= {percent} * greatest(a_size, b_size)")
    # Written, so that the planner knows their size: few pairs are broadcast, and the bitmaps stay where they are.
    sized = tables.write(sized.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").where("a <> b").distinct(), "pairs")
    side = [
        nodes.selectExpr(f"node AS {s}", f"n_shingles AS {s}n", f"bitmap AS {s}m", f"rep.doc_id AS {s}_doc", f"rep.text_hash AS {s}_hash")
        for s in "ab"
    ]
    ends = "a long, b long, a_doc long, a_hash long, b_doc long, b_hash long"
    near = sized.join(side[0], "a").join(side[1], "b").select("a", "b", "an", "am", "bn", "bm", "a_doc", "a_hash", "b_doc", "b_hash")
    near = tables.write(near.mapInArrow(_near(percent), ends), "near")
    wanted = near.selectExpr("a AS node", "a_doc AS d", "a_hash AS h").union(near.select("b", "b_doc", "b_hash")).distinct()
    texts = tables.write(_texts(docs, wanted), "texts")
    both = near.join(texts.toDF("a", "a_text"), "a").join(texts.toDF("b", "b_text"), "b")
    links = both.select("a", "b", "a_text", "b_text").mapInArrow(_close(percent, k), "a long, b long")
    links = tables.write(links, "links")
    tables.drop("texts")
    return links


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    name = {"center": "center_size", "node": "size"}
    return rows.selectExpr(f"{a} AS a", f"{name[a]} AS a_size", f"{b} AS b", f"{name[b]} AS b_size")


def _across(members: DataFrame, roots: DataFrame, tables: _Tables) -> DataFrame:
    """Members of lists that still hold several components, with their component (root); big: it is the list's largest.

    Lists without a probe, and those of two members, which their star has settled, are left out.
    """
    named = tables.write(members.join(roots.select("node", "root"), "node"), "named")  # read twice
    counts = named.groupBy("key", "root").agg(F.count("*").alias("n"), F.max(F.expr(f"role & {PROBE}")).alias("p"), F.sum("size").alias("weight"))
    lists = counts.groupBy("key").agg(
        F.max(F.struct("n", "root")).alias("top"),
        F.sum("n").alias("all"),
        F.sum("weight").alias("weight"),
        F.count("*").alias("roots"),
        F.max("p").alias("p"),
    )
    open_lists = lists.where("roots > 1 AND all > 2 AND p > 0").selectExpr("key", "top.root AS top", "all", "weight")
    left = tables.write(named.join(open_lists, "key").withColumn("big", F.expr("root = top")), "open")
    tables.drop("named")
    return left


def _tiles(left: DataFrame, nodes: DataFrame) -> DataFrame:
    """Open lists cut into tiles; each two tiles of a list meet in one group of rows (key, ta, tb)."""
    tiles = f"CAST(greatest(all DIV {TILE}, weight DIV {TILE_SHINGLES}) AS INT) + 1"
    own = left.withColumn("tiles", F.expr(tiles)).withColumn("tile", F.expr("pmod(xxhash64(node, 7), tiles)"))
    met = own.withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    met = met.selectExpr("key", "least(tile, other) AS ta", "greatest(tile, other) AS tb", "node", "root", "size", "role", "big")
    met = met.join(nodes.select("node", "bitmap"), "node")
    return met.repartition("key", "ta", "tb").sortWithinPartitions("key", "ta", "tb")


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups out of rows sorted by ``by``; the group that a batch leaves open is carried to the next."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        values = [table.column(c).to_numpy() for c in by]
        change = np.flatnonzero(np.logical_or.reduce([v[1:] != v[:-1] for v in values]))
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
    if rest is not None:
        yield rest


def _candidate_groups(percent: int):
    """Members of each tile group that may link across components, by group of those that candidate pairs join (group, node, root).

    A candidate pair has roles and sizes that fit and folded bitmaps that allow a link.  A group is
    named by its members; should two names meet, they are verified as one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["key", "ta", "tb"]):
            key, ta, tb, node, root, size, role, big = (
                table.column(c).to_numpy() for c in ("key", "ta", "tb", "node", "root", "size", "role", "big")
            )
            bitmaps = table.column("bitmap").to_pylist()
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (ta[1:] != ta[:-1]) | (tb[1:] != tb[:-1])]))
            name, chosen = [], []
            for x, y in zip(new, [*new[1:], len(key)], strict=True):
                width = min(len(b) for b in bitmaps[x:y])
                bits = np.stack([_folded(b, width) for b in bitmaps[x:y]])
                r, s, q = root[x:y], size[x:y], role[x:y]
                group = np.arange(y - x)
                for i in np.flatnonzero(~big[x:y]):
                    roles = ((q[i] & PROBE) * (q & INDEX)) | ((q[i] & INDEX) * (q & PROBE))
                    fit = (r != r[i]) & (roles > 0) & (100 * np.minimum(s, s[i]) >= percent * np.maximum(s, s[i]))
                    at = np.flatnonzero(fit)
                    apart = np.bitwise_count(bits[at] ^ bits[i]).sum(axis=1, dtype=np.int64)
                    at = at[apart <= (100 - percent) * (s[at] + s[i]) // (100 + percent)]
                    joined = np.zeros(y - x, bool)
                    joined[group[at]] = joined[group[i]] = True
                    group[joined[group]] = group[i]
                at = np.flatnonzero(np.bincount(group, minlength=y - x)[group] > 1)
                total = np.zeros(y - x, U64)
                np.add.at(total, group[at], mix(node[x:y][at].view(U64)))
                name.append(total[group[at]].view(np.int64))
                chosen.append(x + at)
            at = np.concatenate(chosen)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(name)), pa.array(node[at]), pa.array(root[at])], ["group", "node", "root"])

    return run


def _joining(sets: list[np.ndarray], root: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Roots of links between the sets, enough of them to join all components that links join."""
    values, own = np.unique(root, return_inverse=True)
    order = np.argsort(own == np.bincount(own).argmax(), kind="stable")  # the largest component comes last
    sets, root, own = [sets[i] for i in order], root[order], own[order]
    label, n = own.copy(), np.array([len(x) for x in sets])
    width = max(64, 8 << int(n.max() - 1).bit_length())
    bits = np.stack([np.packbits(_parities(x, width)) for x in sets])
    found = []
    for i in np.flatnonzero(own != own[-1]):
        fit = (label[i + 1 :] != label[i]) & (100 * np.minimum(n[i + 1 :], n[i]) >= percent * np.maximum(n[i + 1 :], n[i]))
        at = i + 1 + np.flatnonzero(fit)
        apart = np.bitwise_count(bits[at] ^ bits[i]).sum(axis=1, dtype=np.int64)
        for j in at[apart <= (100 - percent) * (n[at] + n[i]) // (100 + percent)]:
            if label[j] != label[i] and _linked(sets[i], sets[j], percent):
                found.append((int(root[i]), int(root[j])))
                label[label == label[j]] = label[i]
    return found


def _join_groups(percent: int, k: int):
    """Links (a, b) of roots that join the components of each group of texts (rows sorted by group)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["group"]):
            group, root = table.column("group").to_numpy(), table.column("root").to_numpy()
            sets = [x for chunk in table.column("text").chunks for x in shingle_sets(chunk, k)]
            new = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            found = {link for x, y in zip(new, [*new[1:], len(group)], strict=True) for link in _joining(sets[x:y], root[x:y], percent)}
            columns = list(zip(*found, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return run


def _verified_groups(left: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, k: int, tables: _Tables) -> DataFrame:
    """Links (a, b) between roots that join the components of the open lists."""
    groups = _tiles(left, nodes).mapInArrow(_candidate_groups(percent), "group long, node long, root long")
    groups = tables.write(groups.distinct(), "groups")
    named = groups.join(nodes.selectExpr("node", "rep.doc_id AS d", "rep.text_hash AS h"), "node")
    texts = tables.write(_texts(docs, named.select("node", "d", "h").distinct()), "texts")
    met = groups.join(texts, "node").select("group", "root", "text").repartition("group").sortWithinPartitions("group")
    links = tables.write(met.mapInArrow(_join_groups(percent, k), "a long, b long"), "links")
    tables.drop("texts")
    return links


def jaccard_classes(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    ``docs`` has columns doc_id and text; any others are ignored.  Two rows
    link when their sets of distinct k-word shingles have a Jaccard similarity
    of ``percent``/100 or more; component_id is the smallest doc_id that links
    reach.  A text of fewer than k words counts as one shingle.  A null or
    empty text, or one without words, has n_shingles 0 and is a component of
    its own.  A repeated row is a copy like any other; a null doc_id takes
    part, and names a component only if it holds no other id.
    """
    tables = _Tables(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_hash", F.xxhash64("text"))
    sets = "doc_id long, text_hash long, node long, n_shingles long, bitmap binary, keys array<long>, n_both int, n_index int"
    described = tables.write(docs.mapInArrow(_describe(k, percent), sets), "sets")
    first = described.where("node IS NOT NULL").groupBy("node", "n_shingles")
    rep = F.min(F.when(F.col("bitmap").isNotNull(), F.struct("doc_id", "text_hash"))).alias("rep")
    nodes = tables.write(first.agg(rep, F.max("bitmap").alias("bitmap"), F.min("doc_id").alias("least_id")), "nodes")
    keys = described.where("size(keys) > 0").select("node", "n_shingles", "n_both", "n_index", F.posexplode("keys").alias("at", "key"))
    role = f"CASE WHEN at < n_both THEN {PROBE | INDEX} WHEN at < n_index THEN {INDEX} ELSE {PROBE} END"
    listed = keys.selectExpr("key", "node", "n_shingles AS size", f"{role} AS role").repartition("key").sortWithinPartitions("key", "node")
    stars = tables.write(listed.mapInArrow(_stars, _STAR), "stars")
    known = tables.write(described.select("doc_id", "node", "n_shingles"), "known")
    tables.drop("sets")  # the keys are most of what has been written

    links = connected_components(_verified(_pairs(stars, "center", "node"), nodes, docs, percent, k, tables))
    roots = nodes.select("node", "least_id").join(links, "node", "left").select("node", "least_id", F.coalesce("root", "node").alias("root"))
    roots = tables.write(roots, "roots")
    members = (
        stars.select("key", "node", "size", "role")
        .union(stars.select("key", "center", "center_size", "center_role"))
        .groupBy("key", "node", "size")
        .agg(F.bit_or("role").alias("role"))
    )
    listed_rows, before = stars.count(), None
    for turn in range(MAX_STARS + 1):
        left = _across(members, roots, tables)
        members = left.select("key", "node", "size", "role")  # a list that is settled stays so
        few, compared = left.where("NOT big").agg(F.count("*"), F.sum("all")).first()
        if not few:
            break
        last = turn == MAX_STARS or compared <= COMPARED_PER_ROW * listed_rows or before is not None and few > 0.8 * before
        before = few
        if last:
            links = _verified_groups(left, nodes, docs, percent, k, tables)
        else:  # another member of the largest component as the center
            center = left.where("big").groupBy("key").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "size")).alias("c"))
            pairs = left.where("NOT big").join(center, "key").selectExpr("c.node AS a", "c.size AS a_size", "node AS b", "size AS b_size")
            links = _verified(pairs, nodes, docs, percent, k, tables)
            for end in "ab":
                links = links.join(roots.selectExpr(f"node AS {end}", f"root AS {end}_root"), end)
            links = links.selectExpr("a_root AS a", "b_root AS b")
        # Only the roots of components are joined: what is linked already isn't gone through again.
        joined = connected_components(links).toDF("root", "now")
        roots = roots.join(joined, "root", "left").select("node", "least_id", F.coalesce("now", "root").alias("root"))
        if last:
            break
        roots = tables.write(roots, "roots")
    # A component's least id, by its nodes (each with the least id of its copies).
    least = roots.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = roots.join(least, "root").select("node", "component_id")
    classes = known.join(named, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    classes = materialize(classes, "jaccard/classes")
    tables.drop_all()
    return classes

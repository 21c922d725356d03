"""Benchmark passages in documents, found by latent semantic retrieval.

1. Words hash to ``BUCKETS`` terms; document frequencies over all documents
   give their weights.  Very common terms weigh nothing in the retrieval.
2. All documents are cut into passages of ``PASSAGE`` words.  Their TF-IDF
   matrix A, over the terms of the benchmark, gets a randomised SVD: two
   distributed passes each add up A'AX for a thin X (terms by RANK + OVER),
   with small orthogonal steps between them on the driver.
3. Windows of every document that share enough weight with the benchmark are
   projected, and the cosine with each item gives candidates.  So does every
   run of ``RUN`` words that a document shares with an item (all words of a
   shorter item), whatever its words weigh: no exact copy depends on weights.
   Items whose weight is mostly in common terms (an item that many documents
   hold makes its own words common) are also looked for by the count of their
   words in every place, a bound of the common subsequence.
4. A candidate counts if the longest common subsequence of words holds most of
   the item, or a good part of it and most of its answer (its last sentence).

The benchmark is taken in blocks of about ``BLOCK_ITEMS`` items; a task holds
the tables of a block, whose size doesn't grow with the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.arrow import text_column, with_text
from daybook.llm.words import U64, Words, blocks, mix, scan_words, string_buffers
from daybook.sources.store import materialize

BUCKETS, PASSAGE, RANK, OVER = 1 << 16, 64, 48, 8
#: Terms in more than this part of the documents are common and weigh nothing in the retrieval.
COMMON = 0.1
#: Items with at least this part of their weight in common terms are looked for without weights.
HOT = 0.5
#: Words of a run that makes a candidate by itself; bits of the table that most other runs don't pass.
RUN, SIEVE = 8, 22
#: An item's words are marked by so many leading bits of their hashes.
MARKS = 12
#: Least part of a window's weight in the benchmark's terms, and least cosine of a candidate.
GATE, COSINE = 0.35, 0.4
#: Least part of an item in the common subsequence; the same for a paraphrase whose answer is there; least part of the answer.
WHOLE, PART, ANSWER = 0.65, 0.5, 0.75
LENGTHS = (8, 16, 32, 64, 128, 256, 512, 1024)
BLOCK_ITEMS = 5000
_HIT = "array<struct<item_id:long,lcs_share:double,answer_share:double,cosine:double,start_word:long,end_word:long>>"


def _terms(words: Words) -> np.ndarray:
    return (words.hash >> U64(48)).astype(np.int64)


def _scanned(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Words]]:
    data, offsets = string_buffers(text_column(batch))
    with np.errstate(over="ignore"):
        for i, j, raw, off in blocks(data, offsets):
            yield i, j, scan_words(raw, off)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, words in _scanned(batch):
            each = words.text * BUCKETS + _terms(words)
            if len(words.first) * BUCKETS < 1 << 31:
                each = each.astype(np.int32)  # sorted faster
            n += np.bincount(np.unique(each) % BUCKETS, minlength=BUCKETS)
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["term", "n"])


def term_weights(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Inverse document frequency (smooth, 1 or more) of every term over all of ``docs``, and whether it is common."""
    counted = docs.select("text").mapInArrow(_frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(BUCKETS)
    df[counted.column("term").to_numpy()] = counted.column("n").to_numpy()
    total = docs.count()
    weight = np.log((total + 1) / (df + 1)) + 1
    return weight, (df > COMMON * total) & (df > 20)


@dataclass
class Item:
    item_id: int
    words: np.ndarray  # hashes
    answer: np.ndarray


def items(rows: list) -> list[Item]:
    """Items with words; the answer is the last sentence of three words or more, or else the last eight words."""
    found = []
    for r in rows:
        with np.errstate(over="ignore"):
            data, offsets = string_buffers(pa.array([r.text], pa.string()))
            w = scan_words(data, offsets).hash
            if not len(w):
                continue
            ends = [s for s in re.split(r"(?<=[.!?])\s+", r.text.strip()) if len(s.split()) >= 3]
            n = len(scan_words(*string_buffers(pa.array([ends[-1]], pa.string()))).hash) if len(ends) > 1 else 8
        found.append(Item(r.item_id, w, w[-n:]))
    return found


def _passages(held):
    """Each passage's terms of the benchmark and their TF-IDF weights, of unit length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, weight = held.value
        for batch in batches:
            for _, _, words in _scanned(batch):
                index = np.arange(len(words.text)) - words.first[words.text]
                begins = index % PASSAGE == 0
                passage = np.cumsum(begins) - 1
                term = _terms(words)
                use = (place[term] >= 0) & (weight[term] > 0)
                key, tf = np.unique(passage[use] * BUCKETS + term[use], return_counts=True)
                owner, term = key // BUCKETS, key % BUCKETS
                value = tf * weight[term]
                norm = np.sqrt(np.bincount(owner, value * value))
                value = value / norm[owner] if len(owner) else value
                cut = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1, [len(owner)]]) if len(owner) else np.zeros(1, np.int64)
                offsets = pa.array(cut.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(offsets, pa.array(place[term].astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(value.astype(np.float32))),
                    ],
                    ["terms", "weights"],
                )

    return run


def _times(held, width: int):
    """This task's part of A'AX, a row per term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = held.value
        y = np.zeros_like(x)
        for batch in batches:
            terms, weights = batch.column("terms"), batch.column("weights")
            t, w = terms.flatten().to_numpy(), weights.flatten().to_numpy().astype(float)
            sizes = np.diff(terms.offsets.to_numpy())
            owner = np.repeat(np.arange(len(sizes)), sizes)
            for a in range(0, len(t), 1 << 16):  # a passage cut in two here counts as two
                s = slice(a, a + (1 << 16))
                o = owner[s] - owner[a]
                z = np.zeros((o[-1] + 1, width))
                begins = np.concatenate([[0], np.flatnonzero(np.diff(o)) + 1])
                z[o[begins]] = np.add.reduceat(x[t[s]] * w[s, None], begins, 0)
                order = np.argsort(t[s], kind="stable")
                sorted_t = t[s][order]
                first = np.concatenate([[0], np.flatnonzero(np.diff(sorted_t)) + 1])
                y[sorted_t[first]] += np.add.reduceat((z[o] * w[s, None])[order], first, 0)
        at = np.flatnonzero(y.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(y[at, j]) for j in range(width))], ["term", *(f"c{j}" for j in range(width))])

    return run


def _gram_times(passages: DataFrame, x: np.ndarray) -> np.ndarray:
    held = passages.sparkSession.sparkContext.broadcast(x)
    columns = [f"c{j}" for j in range(x.shape[1])]
    parts = passages.mapInArrow(_times(held, len(columns)), "term long, " + ", ".join(f"{c} double" for c in columns))
    summed = parts.groupBy("term").agg(*(F.sum(c).alias(c) for c in columns)).toArrow()
    y = np.zeros_like(x)
    y[summed.column("term").to_numpy()] = np.stack([summed.column(c).to_numpy() for c in columns], 1)
    return y


def latent_space(passages: DataFrame, n_terms: int, seed: int = 11) -> np.ndarray:
    """Term vectors (n_terms by at most RANK): the leading right singular vectors of the passages' matrix."""
    start = np.random.default_rng(seed).normal(size=(n_terms, min(RANK + OVER, n_terms)))
    q, _ = np.linalg.qr(_gram_times(passages, start))
    small = q.T @ _gram_times(passages, q)
    value, vector = np.linalg.eigh((small + small.T) / 2)
    return q @ vector[:, np.argsort(-value)[:RANK]]


def positions(words: np.ndarray) -> dict[int, int]:
    """The places of each word, as bits."""
    masks: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def common_subsequence(masks: dict[int, int], n: int, b: list[int]) -> int:
    """Length of the longest common subsequence of n words (their ``positions``) and others, by bit-parallel rows."""
    full = (1 << n) - 1
    row = full
    for w in b:
        if w in masks:
            u = row & masks[w]
            row = (row + u | row - u) & full
    return n - row.bit_count()


def _run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n successive words."""
    out = np.zeros(max(0, len(words) - n + 1), U64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = mix(out + words[i : i + len(out)])
    return out


@dataclass
class Runs:
    """The runs of n words of some items: sorted hashes, with the item and the place in it of each."""

    n: int
    hash: np.ndarray
    item: np.ndarray
    place: np.ndarray
    sieve: np.ndarray
    step: np.ndarray  # of each item

    def found(self, words: Words) -> Iterator[tuple[int, int, int]]:
        """(text, item index, start) for the runs in some texts; starts of an item are taken a quarter of it apart."""
        here = _run_hashes(words.hash, self.n)
        at = np.flatnonzero(self.sieve[(here >> U64(64 - SIEVE)).astype(np.int64)])
        at = at[words.text[at] == words.text[at + self.n - 1]]
        low, high = np.searchsorted(self.hash, here[at]), np.searchsorted(self.hash, here[at], "right")
        at, low, size = at[high > low], low[high > low], (high - low)[high > low]
        if not len(at):
            return
        match = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        at, item = np.repeat(at, size), self.item[match]
        text, step = words.text[at], self.step[item]
        start = (at - words.first[text] - self.place[match]) // step * step
        for t, i, s in np.unique(np.stack([text, item, start], 1), axis=0).tolist():
            yield t, i, s


def runs(wanted: list[Item]) -> list[Runs]:
    """The runs of all items, by their length: ``RUN`` words, or all of a shorter item's."""
    step = np.array([max(1, len(i.words) // 4) for i in wanted], np.int64)
    out = []
    for n in sorted({min(RUN, len(i.words)) for i in wanted}):
        found = [(j, _run_hashes(i.words, n)) for j, i in enumerate(wanted) if min(RUN, len(i.words)) == n]
        hashes = np.concatenate([h for _, h in found])
        order = np.argsort(hashes, kind="stable")
        item = np.concatenate([np.full(len(h), j) for j, h in found])
        place = np.concatenate([np.arange(len(h)) for _, h in found])
        sieve = np.zeros(1 << SIEVE, bool)
        sieve[(hashes >> U64(64 - SIEVE)).astype(np.int64)] = True
        out.append(Runs(n, hashes[order], item[order], place[order], sieve, step))
    return out


def _places(words: Words, hot: list[tuple[int, np.ndarray, int]]) -> Iterator[tuple[int, int, int]]:
    """(text, item index, start) where twice an item's length holds enough of its words; starts are a quarter of it apart."""
    index = np.arange(len(words.hash)) - words.first[words.text]
    for item, own, n in hot:
        there = np.concatenate([[0], np.cumsum(np.isin(words.hash, own))])
        at = np.flatnonzero(index % max(1, n // 4) == 0)
        low, high = words.first[words.text[at]], words.first[words.text[at] + 1]
        part = there[np.minimum(high, at + n + n // 2)] - there[np.maximum(low, at - n // 2)]
        for a in at[part >= PART * n].tolist():
            yield int(words.text[a]), item, a


def _enough(words: Words, start: np.ndarray, item: np.ndarray, marks: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the words around each start that are marked as the item's suffice for a common subsequence of ``PART`` of it.

    A mark is shared by words of the same leading hash bits, so the number can only be too large.
    """
    n, text = size[item], words.text[start]
    a, b = np.maximum(words.first[text], start - n // 2), np.minimum(words.first[text + 1], start + n + n // 2)
    slot = (words.hash >> U64(64 - MARKS)).astype(np.int64)
    enough = np.zeros(len(start), bool)
    for i in range(0, len(start), 8192):
        low, long, which = a[i : i + 8192], (b - a)[i : i + 8192], item[i : i + 8192]
        first = np.cumsum(long) - long
        at = np.arange(long.sum()) + np.repeat(low - first, long)
        there = np.add.reduceat(marks[np.repeat(which, long), slot[at]], first, dtype=np.int64)
        enough[i : i + 8192] = there >= PART * n[i : i + 8192]
    return enough


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _searching(held):
    def candidates(words: Words, tables) -> Iterator[tuple[int, int, int, float]]:
        """(text, item index, window start, cosine)."""
        place, weight, latent, vectors, by_length, marks, size = tables
        term = _terms(words)
        w = weight[term]
        known = np.where(place[term] >= 0, w, 0.0)
        total, shared = np.concatenate([[0], np.cumsum(w)]), np.concatenate([[0], np.cumsum(known)])
        index = np.arange(len(term)) - words.first[words.text]
        last = words.first[words.text + 1]
        at, sums = np.flatnonzero(known > 0), None
        for length, some in by_length.items():
            start = np.flatnonzero(index % max(1, length // 4) == 0)
            end = np.minimum(start + length, last[start])
            mass = shared[end] - shared[start]
            open_ = (mass > 0) & (mass >= GATE * (total[end] - total[start]))
            start, end = start[open_], end[open_]
            if sums is None and len(start):  # of the words so far, for windows of every length
                sums = np.zeros((len(at) + 1, latent.shape[1]))
                np.cumsum(latent[place[term[at]]] * known[at, None], 0, out=sums[1:])
            for a in range(0, len(start), 8192):
                s, e = start[a : a + 8192], end[a : a + 8192]
                v = sums[np.searchsorted(at, e)] - sums[np.searchsorted(at, s)]
                cosine = _unit(v).astype(np.float32) @ vectors[some].T.astype(np.float32)
                i, j = np.nonzero(cosine >= COSINE)
                may = _enough(words, s[i], some[j], marks, size)
                for i, j in zip(i[may].tolist(), j[may].tolist(), strict=True):
                    yield int(words.text[s[i]]), int(some[j]), int(s[i]), float(cosine[i, j])

    def alike(words: Words, tables, item: int, start: int, end: int) -> float:
        """The cosine of an item with the words from start to end."""
        place, weight, latent, vectors, *_ = tables
        term = _terms(words)[max(start, 0) : end]
        term = term[place[term] >= 0]
        return float(_unit((latent[place[term]] * weight[term, None]).sum(0)[None])[0] @ vectors[item])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, by_run, hot, *tables = held.value
        masks = [(positions(i.words), positions(i.answer)) for i in wanted]
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("lcs_share", pa.float64()), ("answer_share", pa.float64()), ("cosine", pa.float64()), ("start_word", pa.int64()), ("end_word", pa.int64())]))
        for batch in batches:
            hits: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for first, _, words in _scanned(batch):
                best: dict[tuple[int, int], dict] = {}
                shared = chain(((t, i, int(words.first[t]) + s) for r in by_run for t, i, s in r.found(words)), _places(words, hot))
                shared = ((*found, None) for found in shared)
                for text, item, start, cosine in chain(candidates(words, tables), shared):
                    if cosine is None and best.get((text, item), {}).get("lcs_share") == 1:
                        continue
                    it, low, high = wanted[item], words.first[text], words.first[text + 1]
                    n = len(it.words)
                    a, b = max(low, start - n // 2), min(high, start + n + n // 2)
                    part = words.hash[a:b].tolist()
                    whole, end = masks[item]
                    there = set(part)
                    if sum(m.bit_count() for w, m in whole.items() if w in there) < PART * n:
                        continue  # more words than these can't be in a common subsequence
                    share = common_subsequence(whole, n, part) / n
                    if share < PART:
                        continue
                    answer = common_subsequence(end, len(it.answer), part) / len(it.answer)
                    if share < WHOLE and answer < ANSWER:
                        continue
                    if (old := best.get((text, item))) is None or share > old["lcs_share"]:
                        if cosine is None:
                            cosine = alike(words, tables, item, start, min(start + n, high))
                        best[text, item] = {"item_id": it.item_id, "lcs_share": share, "answer_share": answer, "cosine": cosine, "start_word": int(a - low), "end_word": int(b - low)}
                for (text, _), hit in sorted(best.items()):
                    hits[first + text].append(hit)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(hits, kind)], ["row", "hits"])

    return run


def _block(docs: DataFrame, given: DataFrame, weights: tuple[np.ndarray, np.ndarray], wanted: list[Item]) -> DataFrame:
    smooth, common = weights
    weight = np.where(common, 0, smooth)
    hot = []
    for j, item in enumerate(wanted):
        t = (item.words >> U64(48)).astype(np.int64)
        if smooth[t][common[t]].sum() >= HOT * smooth[t].sum():
            hot.append((j, np.unique(item.words), len(item.words)))
    context = docs.sparkSession.sparkContext
    terms = np.unique(np.concatenate([(i.words >> U64(48)).astype(np.int64) for i in wanted]))
    place = np.full(BUCKETS, -1, np.int64)
    place[terms] = np.arange(len(terms))
    passages = docs.select("text").mapInArrow(_passages(context.broadcast((place, weight))), "terms array<int>, weights array<float>")
    latent = latent_space(materialize(passages, "decontamination/passages"), len(terms))
    vectors = np.zeros((len(wanted), latent.shape[1]))
    by_length: dict[int, list[int]] = {}
    for i, item in enumerate(wanted):
        t = (item.words >> U64(48)).astype(np.int64)
        vectors[i] = (latent[place[t]] * weight[t, None]).sum(0)
        by_length.setdefault(max((x for x in LENGTHS if x <= len(item.words)), default=LENGTHS[0]), []).append(i)
    marks = np.zeros((len(wanted), 1 << MARKS), bool)
    for i, item in enumerate(wanted):
        marks[i, (item.words >> U64(64 - MARKS)).astype(np.int64)] = True
    size = np.array([len(i.words) for i in wanted], np.int64)
    tables = (wanted, runs(wanted), hot, place, weight, latent, _unit(vectors), {n: np.array(x) for n, x in by_length.items()}, marks, size)
    return given.mapInArrow(_searching(context.broadcast(tables)), f"row {given.schema['row'].dataType.simpleString()}, hits {_HIT}")


def find_benchmark(docs: DataFrame, benchmark: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, all by default) and hits of every row of ``docs``.

    A hit is a benchmark item (item_id, text) that a text holds or
    paraphrases: shares of the item and of its answer in the longest common
    subsequence, the cosine, and the words it was found in.  Null and empty
    texts have no hits, null and empty items are never found, repeated rows are
    searched each time; without items nothing is found.
    """
    given = with_text(docs, carry)
    beside = [c for c in given.columns if c == "text"]
    asked = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    n = max(1, -(-asked.count() // BLOCK_ITEMS))
    weights = None
    # the texts stay with the hits of the blocks so far
    found = given.withColumn("hits", F.expr(f"CAST(array() AS {_HIT})"))
    for b in range(n):
        wanted = items(asked.where(F.expr(f"pmod(xxhash64(item_id, text), {n}) = {b}")).orderBy("item_id", "text").collect())
        if wanted:
            weights = term_weights(docs) if weights is None else weights
            searched = _block(docs, found.select(F.struct("row", *beside, "hits").alias("row")), weights, wanted)
            found = searched.select("row.row", *(F.col("row")[c].alias(c) for c in beside), F.concat("row.hits", "hits").alias("hits"))
    return found.select("row", "hits")

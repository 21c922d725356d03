"""Byte-level BPE encoding and decoding over a rank file, in two tiers.

* **Whole pre-tokens.**  A minimal perfect hash over the vocabulary (hash and
  displace: keys fall into small buckets, each bucket, largest first, gets a
  displacement that sends its keys to free slots; as many slots as tokens)
  resolves every pre-token that is itself a token, in three array lookups and
  a comparison of the bytes.  Such a pre-token's id is its token: the encoder
  by ranks takes a whole-token match first.
* **Misses.**  Bytes form a linked list; a heap holds the rank of every
  adjacent pair that is a token.  The lowest rank, leftmost first, is merged,
  its neighbours' pairs are pushed, and stale entries are skipped, so a run of
  n bytes takes O(n log n).

Tasks hold the tables as a broadcast of fixed size (the vocabulary), a bounded
memo of the pre-tokens met, and the pre-tokens of one small group of texts.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from daybook.llm.arrow import by_bytes, text_column, with_text

#: Pre-tokens that a worker remembers; the memo is emptied when full.
MEMO = 300_000
#: Displacements tried at once.
TRIES = 64
#: Texts are encoded and handed on in groups of about this many bytes: cut into pre-tokens, a byte takes some fifty.
ENCODED_BYTES = 1 << 18
#: Texts are decoded and handed on in batches of about this many ids.
DECODED_IDS = 1 << 17


class PerfectHash:
    """A minimal perfect hash from each of ``keys`` (distinct byte strings) to its slot."""

    def __init__(self, keys: list[bytes]) -> None:
        self.n = max(1, len(keys))
        self.buckets = max(1, -(-self.n // 4))
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
        bucket, a, b = self._parts(h)
        self.displace = np.zeros(self.buckets, np.int64)
        taken = np.zeros(self.n, bool)
        order = np.argsort(bucket, kind="stable")
        filled = np.bincount(bucket, minlength=self.buckets)
        first = np.concatenate([[0], np.cumsum(filled)])
        self.slot_key = np.full(self.n, -1, np.int64)
        free: list[int] = []
        for k in np.argsort(-filled, kind="stable"):
            members = order[first[k] : first[k + 1]]
            if len(members) == 1:  # any free slot will do; it is written down as such
                free = free or np.flatnonzero(~taken).tolist()
                slot = free.pop()
                self.displace[k] = -1 - slot
                slots = np.array([slot])
            elif len(members):
                d, slots = self._displaced(a[members], b[members], taken)
                self.displace[k] = d
            else:
                break
            taken[slots] = True
            self.slot_key[slots] = members

    def _displaced(self, a: np.ndarray, b: np.ndarray, taken: np.ndarray) -> tuple[int, np.ndarray]:
        """The first displacement that sends a bucket's keys to free and distinct slots."""
        for first in count(0, TRIES):
            slots = self._slots(a, b, np.arange(first, first + TRIES)[:, None])
            for i in np.flatnonzero(~taken[slots].any(1)):
                if len(set(slots[i].tolist())) == len(a):
                    return first + int(i), slots[i]
        raise AssertionError

    def _slots(self, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
        return (a + d // self.n * b + d % self.n) % self.n  # every shift of the slots, then a further step apart

    def _parts(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low, high = (h & np.uint64(0xFFFFFFFF)).astype(np.int64), (h >> np.uint64(32)).astype(np.int64)
        return high % self.buckets, low % self.n, (low >> 7 ^ high >> 3) % max(1, self.n - 1) + 1

    def keys(self, h: np.ndarray) -> np.ndarray:
        """The index of the only key that each hash can belong to; -1: none (no keys)."""
        bucket, a, b = self._parts(h)
        d = self.displace[bucket]
        return self.slot_key[np.where(d < 0, -1 - d, self._slots(a, b, np.maximum(d, 0)))]


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a piece by repeated merging of its lowest-ranked adjacent pair."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts here; 0: merged away
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
            heappush(heap, (r, p, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class Encoder:
    """A rank file (base64 token and rank per line) and the pattern that cuts texts into pre-tokens."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = pattern
        self.tokens = sorted(self.ranks, key=self.ranks.get)
        self.hash = PerfectHash(self.tokens)
        self.token_ids = np.array([self.ranks[t] for t in self.tokens], np.int32)
        self.place = np.full(int(self.token_ids.max(initial=0)) + 2, -1, np.int64)  # of an id among the tokens
        self.place[self.token_ids] = np.arange(len(self.tokens))
        self.bytes = pa.array(self.tokens, pa.large_binary())
        self._forget()

    def _forget(self) -> None:
        """Empties the memo: pre-tokens by number, and the ids of each number."""
        self.memo: dict[str, int] = {}
        self.pool, self.pool_end = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def learn(self, new: list[str]) -> None:
        """Adds some distinct pre-tokens to the memo: whole tokens by the perfect hash, all others by merging."""
        raw = [u.encode() for u in new]
        key = self.hash.keys(np.fromiter(map(xxhash.xxh3_64_intdigest, raw), np.uint64, len(raw)))
        ids: list[int] = []
        size = []
        for k, b in zip(key.tolist(), raw, strict=True):
            if k >= 0 and self.tokens[k] == b:
                ids.append(int(self.token_ids[k]))
                size.append(1)
            else:
                ids += (merged := merge_bytes(b, self.ranks))
                size.append(len(merged))
        self.memo.update(zip(new, range(len(self.memo), len(self.memo) + len(new)), strict=True))
        self.pool = np.concatenate([self.pool, np.array(ids, np.int32)])
        self.pool_end = np.concatenate([self.pool_end, self.pool_end[-1] + np.cumsum(size)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's)."""
        if len(self.memo) > MEMO or len(self.pool) > 16 * MEMO:
            self._forget()
        cut = regex.compile(self.pattern).findall
        parts: list[str] = []
        last = [0]
        for t in texts:
            parts += cut(t)
            last.append(len(parts))
        which = np.fromiter(map(self.memo.get, parts, repeat(-1)), np.int64, len(parts))
        if len(missed := np.flatnonzero(which < 0)):
            again = [parts[i] for i in missed.tolist()]
            self.learn(list(dict.fromkeys(again)))
            which[missed] = np.fromiter(map(self.memo.__getitem__, again), np.int64, len(again))
        start = self.pool_end[which]
        size = self.pool_end[which + 1] - start
        stop = np.concatenate([[0], np.cumsum(size)])
        return self.pool[np.repeat(start - stop[:-1], size) + np.arange(stop[-1])], stop[last]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
        """(offsets of each id's bytes, the bytes); an unknown id is an error."""
        if not len(ids):
            return np.zeros(1, np.int64), b""
        if not (0 <= ids.min() and ids.max() < len(self.place) and (place := self.place[ids]).min() >= 0):
            raise KeyError("an id that is not in the vocabulary")
        taken = self.bytes.take(pa.array(place))
        _, offsets, data = taken.buffers()
        return np.frombuffer(offsets, np.int64)[taken.offset : taken.offset + len(ids) + 1], data


def _encoding(coder):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, ENCODED_BYTES):
                ids, offsets = coder.value.encode([t or "" for t in text_column(batch).to_pylist()])
                column = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column("row"), column], ["row", "ids"])

    return run


def _decoding(coder):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lists = whole.column("ids").fill_null([]).cast(pa.large_list(pa.int32()))
            bound = lists.offsets.to_numpy()
            first = 0
            while first < whole.num_rows:
                last = max(first + 1, int(np.searchsorted(bound, bound[first] + DECODED_IDS, "right")) - 1)
                part, own = whole.slice(first, last - first), bound[first : last + 1]
                at, data = coder.value.decode(lists.values.to_numpy(zero_copy_only=False)[own[0] : own[-1]])
                size = at[own - own[0]]
                decoded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(size.tobytes()), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("ids"), decoded.cast(pa.binary())], ["row", "ids", "decoded"])
                first = last

    return run


def encode(docs: DataFrame, path: str, pattern: str, carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, all by default) and ``ids`` (array<int>) of every whole text.

    Each match of ``pattern`` is encoded by itself and without special tokens;
    a null text counts as empty and has no ids.  Repeated rows are encoded
    each time.
    """
    given = with_text(docs, carry)
    coder = docs.sparkSession.sparkContext.broadcast(Encoder(path, pattern))
    return given.mapInArrow(_encoding(coder), f"row {given.schema['row'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` (row, ids) with the bytes that each row's ids stand for, as ``decoded``; an unknown id is an error."""
    coder = encoded.sparkSession.sparkContext.broadcast(Encoder(path, pattern))
    schema = f"row {encoded.schema['row'].dataType.simpleString()}, ids array<int>, decoded binary"
    return encoded.select("row", "ids").mapInArrow(_decoding(coder), schema)

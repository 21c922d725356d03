"""SentencePiece encoding and decoding for merge-type (BPE) models, by a score-ordered agenda.

A text's symbols (its characters, white space as U+2581) form a linked list.
The agenda holds every adjacent pair whose concatenation is a piece, best
score first and leftmost among equals; the first pair is joined, its symbol's
new pairs with both neighbours enter, and pairs that no longer stand as they
entered are passed over.  What can't be joined further is a piece, or else the
bytes of its UTF-8 form (byte fallback), or the unknown piece.

Two neighbouring characters that are neighbours in no piece can never be
joined, so a text falls apart there into spans that are handled one by one
with the same result.  Spaces are such places in front of words, so most spans
are words.  A worker remembers the ids of spans; those of a batch that are new
and short have their agendas side by side as the rows of one array, in which
each step joins every row's first pair.  Longer ones have a heap each.

The model file is read as it is (pieces, scores, kinds, normaliser flags).
Models that normalise by a character map have their texts normalised by the
library; everything else is done here.  With ``check`` every Arrow batch is
also encoded (whole texts, or the spans that are new) and decoded by the
sentencepiece library, and a difference is an error.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Kinds of a piece in a model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGES = 2  # the model type with merges
#: What is held against the library.
TEXTS, SPANS = "texts", "spans"
#: A worker's memo is emptied at so many spans, or 16 times as many ids.
MEMO = 300_000
#: Agendas of up to so many symbols are rows of an array (of one of these widths), longer ones heaps.
WIDTHS = (4, 8, 12, 16, 24, 32)
#: Texts of an Arrow batch are handled in groups of about this many bytes.
GROUP_BYTES = 4 << 20


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a serialised message; nested messages and strings stay bytes."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            size, at = (4, at) if key & 7 == 5 else (8, at) if key & 7 == 1 else varint(at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class PairTable:
    """From two symbols (numbers below ``n``) to the place of their pair, for many pairs at once; -1: no such pair.

    Open addressing in an array four to eight times as long as the pairs.
    """

    def __init__(self, left: np.ndarray, right: np.ndarray, n: int) -> None:
        self.n = n
        self.bits = max(4, int(len(left) * 4).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.place = np.full(1 << self.bits, -1, np.int32)
        key = left.astype(np.int64) * n + right
        todo, at = np.arange(len(key)), self._slot(key)
        while len(todo):
            free = self.key[at] < 0
            self.key[at[free]], self.place[at[free]] = key[todo[free]], todo[free]  # of several, one stays
            lost = self.place[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & (len(self.key) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.n + right
        at = self._slot(key)
        place = np.full(len(key), -1, np.int32)
        todo = np.arange(len(key))
        while len(todo):
            there = self.key[at]
            hit = there == key[todo]
            place[todo[hit]] = self.place[at[hit]]
            on = ~hit & (there >= 0)
            todo, at = todo[on], (at[on] + 1) & (len(self.key) - 1)
        return place


class Model:
    """What the agenda needs of a model file; refuses models of another type than merges."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            data = f.read()
        self.text: list[str] = []
        self.kind: list[int] = []
        self.score: list[float] = []
        trainer: dict[int, int | bytes] = {}
        normaliser: dict[int, int | bytes] = {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.text.append(piece.get(1, b"").decode())
                self.score.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kind.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        if trainer.get(3, 1) != MERGES or trainer.get(24, 0):
            raise ValueError(f"{path} is not a merge-type model with white space in front of words")
        if not normaliser.get(5, 1):
            raise ValueError(f"{path} does not escape white space")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.mapped = bool(normaliser.get(2, b"")) or bool(normaliser.get(4, 1))
        self.prefix = bool(normaliser.get(3, 1))
        self.trims = bool(normaliser.get(4, 1))
        self.unknown = self.kind.index(UNKNOWN)
        self.unknown_text = trainer.get(44, " ⁇ ".encode())
        self.ends = self.library.eos_id()
        self.byte = [i for i, k in enumerate(self.kind) if k == BYTE] if trainer.get(35, 0) else []
        self.own = {t: i for i, (t, k) in enumerate(zip(self.text, self.kind, strict=True)) if k in (NORMAL, USER_DEFINED, UNUSED)}
        self.whole = sorted((t for t, i in self.own.items() if self.kind[i] == USER_DEFINED), key=len, reverse=True)
        self.unused = {t for t, i in self.own.items() if self.kind[i] == UNUSED}
        # Scores by order, best first; equal scores are equal.
        ranks = {score: i for i, score in enumerate(sorted({self.score[i] for i in self.own.values()}, reverse=True))}
        self.order = {t: ranks[self.score[i]] for t, i in self.own.items()}
        joins = {p[i : i + 2] for p in self.own for i in range(len(p) - 1)}
        self.joins = joins
        # How an unused piece came about is kept by text, and pieces of the user's own may hold any neighbours.
        self.parted = not self.whole and not self.unused
        self.spaced = self.parted and not any(a != SPACE and b == SPACE for a, b in joins)
        self._numbering()
        self._decoding()

    def _numbering(self) -> None:
        """Symbols by number: pieces by id, then every character that is no piece, by its code point."""
        n = len(self.text)
        self.other = n + 0x110000
        self.number_of = np.arange(n, self.other, dtype=np.int32)
        for p, k in self.own.items():
            if len(p) == 1:
                self.number_of[ord(p)] = k
        number = lambda p: self.own.get(p, n + ord(p) if len(p) == 1 else -1)
        parts = [(a, b, self.order[p], k) for p, k in self.own.items() for i in range(1, len(p)) if (a := number(p[:i])) >= 0 and (b := number(p[i:])) >= 0]
        left, right, order, whole = np.array(parts, np.int64).reshape(-1, 4).T
        self.pairs = PairTable(left, right, self.other + 1)
        self.pair_order = np.append(order, n).astype(np.int32)  # place -1: worse than any
        self.pair_whole = whole.astype(np.int32)
        self._forget()

    def _forget(self) -> None:
        """Empties the memo: spans by number, and the ids of the span of each number."""
        self.memo: dict[str | None, int] = {None: 0}  # None: the end of a text
        self.pool, self.pool_end = np.array([self.ends], np.int32), np.array([0, 1])

    # -- encoding ---------------------------------------------------------

    def normalised(self, text: str) -> str:
        if self.mapped:
            return self.library.normalize(text)
        text = text.replace(" ", SPACE)
        return SPACE + text if self.prefix and text else text

    def _symbols(self, text: str) -> tuple[list[str], list[bool]]:
        """A span's characters; pieces that the user defined stay whole and are never joined."""
        if not self.whole:
            return list(text), [False] * len(text)
        parts = regex.split("(" + "|".join(map(regex.escape, self.whole)) + ")", text)
        symbols, fixed = [], []
        for k, part in enumerate(parts):
            symbols += [part] if k % 2 else list(part)
            fixed += [True] if k % 2 else [False] * len(part)
        return symbols, fixed

    def agenda(self, text: str) -> list[int]:
        """The ids of one span, by joining its adjacent pairs in order of their score."""
        symbols, fixed = self._symbols(text)
        n, order = len(symbols), self.order.get
        # The order of the pair that starts at each symbol; negative: none, or no longer that pair.
        pair = [order(a + b, -1) for a, b in zip(symbols, symbols[1:], strict=False)]
        pair.append(-1)
        if any(fixed):
            pair = [-1 if f or i + 1 < n and fixed[i + 1] else p for i, (p, f) in enumerate(zip(pair, fixed, strict=True))]
        agenda = [p * n + i for i, p in enumerate(pair) if p >= 0]  # best first, then leftmost
        made = {symbols[i] + symbols[i + 1]: (symbols[i], symbols[i + 1]) for i, p in enumerate(pair) if p >= 0} if self.unused else {}
        heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            best, left = divmod(heappop(agenda), n)
            if pair[left] != best:
                continue
            right = after[left]
            symbols[left] = joined = symbols[left] + symbols[right]
            symbols[right], pair[left], pair[right] = "", -1, -1
            after[left] = following = after[right]
            if following < n:
                before[following] = left
                if not (fixed[left] or fixed[following]) and (p := order(both := joined + symbols[following], -1)) >= 0:
                    pair[left] = p
                    heappush(agenda, p * n + left)
                    if both in self.unused:
                        made[both] = joined, symbols[following]
            if (previous := before[left]) >= 0:
                pair[previous] = -1
                if not (fixed[previous] or fixed[left]) and (p := order(both := symbols[previous] + joined, -1)) >= 0:
                    pair[previous] = p
                    heappush(agenda, p * n + previous)
                    if both in self.unused:
                        made[both] = symbols[previous], joined
        ids: list[int] = []
        own, i = self.own.get, 0
        while i < n:
            if (k := own(symbols[i])) is not None and not made:
                ids.append(k)
            else:
                self._emit(symbols[i], made, ids)
            i = after[i]
        return ids

    def short_agendas(self, spans: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number by span) of many spans of up to ``width`` characters.

        Their agendas are the rows of one array, and each step joins the first pair of every row.
        """
        size = np.fromiter(map(len, spans), np.int64, len(spans))
        symbol = np.full((len(spans), width + 1), self.other, np.int32)
        symbol[np.arange(width + 1) < size[:, None]] = self.number_of[np.frombuffer("".join(spans).encode("utf-32-le"), np.uint32)]
        none = self.pair_order[-1]
        agenda = np.full((len(spans), width), none, np.int32)
        inside = np.arange(width) < size[:, None] - 1
        agenda[inside] = self.pair_order[self.pairs(symbol[:, :-1][inside], symbol[:, 1:][inside])]
        column, rows = np.arange(width), np.arange(len(spans))
        while len(rows):
            best = agenda[rows].argmin(1)  # of equals the leftmost
            still = agenda[rows, best] < none
            rows, best = rows[still], best[still]
            joined = self.pair_whole[self.pairs(symbol[rows, best], symbol[rows, best + 1])]
            after = column > best[:, None]
            symbol[rows, :width] = np.where(after, symbol[rows, 1:], symbol[rows, :width])
            symbol[rows, best] = joined
            agenda[rows, :-1] = np.where(after[:, :-1], agenda[rows, 1:], agenda[rows, :-1])
            agenda[rows, -1] = none
            size[rows] -= 1
            agenda[rows, best] = self.pair_order[self.pairs(joined, symbol[rows, best + 1])]  # the filling is in no pair
            at, row = best[best > 0] - 1, rows[best > 0]
            agenda[row, at] = self.pair_order[self.pairs(symbol[row, at], joined[best > 0])]
        return self._without_characters(symbol[np.arange(width + 1) < size[:, None]], size)

    def _without_characters(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece as the ids of their bytes, or as the unknown piece."""
        odd = ids >= len(self.text)
        if not odd.any():
            return ids, size
        if not self.byte:
            return np.where(odd, self.unknown, ids), size
        characters = list(map(chr, (ids[odd] - len(self.text)).tolist()))
        more = np.ones(len(ids), np.int64)
        more[odd] = [len(c.encode()) for c in characters]
        span = np.repeat(np.arange(len(size)), size)
        ids, odd = np.repeat(ids, more), np.repeat(odd, more)
        ids[odd] = np.array(self.byte, np.int32)[np.frombuffer("".join(characters).encode(), np.uint8)]
        return ids, np.bincount(span, weights=more, minlength=len(size)).astype(np.int64)

    def learn(self, new: list[str]) -> None:
        """Adds the ids of some different spans to the memo."""
        ids, sizes, low = [self.pool], [], 0
        for width in WIDTHS if self.parted else ():
            if some := [s for s in new if low < len(s) <= width]:
                flat, size = self.short_agendas(some, width)
                self.memo.update(zip(some, range(len(self.memo), len(self.memo) + len(some)), strict=True))
                ids.append(flat)
                sizes.append(size)
            low = width
        for s in new:
            if len(s) > low:
                one = np.array(self.span(s), np.int32)
                self.memo[s] = len(self.memo)
                ids.append(one)
                sizes.append([len(one)])
        self.pool = np.concatenate(ids)
        self.pool_end = np.concatenate([self.pool_end, self.pool_end[-1] + np.cumsum(np.concatenate(sizes))])

    def _emit(self, symbol: str, made: dict[str, tuple[str, str]], ids: list[int]) -> None:
        todo = [symbol]
        while todo:
            part = todo.pop()
            if part in self.unused and part in made:  # a step of the merges, but no piece to return
                todo += reversed(made[part])
            elif (k := self.own.get(part)) is not None:
                ids.append(k)
            elif self.byte:
                ids += [self.byte[b] for b in part.encode()]
            else:
                ids.append(self.unknown)

    def span(self, text: str) -> list[int]:
        """The ids of a stretch of normalised text that nothing around it can join."""
        if not self.parted:
            return self.agenda(text)
        cuts = [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in self.joins]
        return list(chain.from_iterable(self.agenda(text[a:b]) for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)))

    def _spans(self, text: str) -> list[str]:
        text = self.normalised(text)
        if not self.spaced:
            return [text] if text else []
        if SPACE * 2 in text:
            return _WORDS.findall(text)
        first, *words = text.split(SPACE)  # a prefix space leaves an empty first part
        spans = [SPACE + w for w in words]
        return [first, *spans] if first else spans

    def encode(self, texts: list[str], end: bool, check: str = "") -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's); ``check`` as in ``encode`` of the module."""
        if len(self.memo) > MEMO or len(self.pool) > 16 * MEMO:
            self._forget()
        spans: list[str | None] = []
        last = []
        for text in texts:
            spans += self._spans(text)
            if end:
                spans.append(None)
            last.append(len(spans))
        which = np.fromiter(map(self.memo.get, spans, repeat(-1)), np.int64, len(spans))
        if len(missed := np.flatnonzero(which < 0)):
            again = [spans[i] for i in missed.tolist()]
            self.learn(new := list(dict.fromkeys(again)))
            which[missed] = np.fromiter(map(self.memo.__getitem__, again), np.int64, len(again))
            if check == SPANS:
                self._check_spans(new)
        start = self.pool_end[which]
        size = self.pool_end[which + 1] - start
        stop = np.cumsum(size)
        ids = self.pool[np.repeat(start - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)]
        offsets = np.concatenate([[0], stop])[[0, *last]]
        if not self.byte:  # neighbouring unknown pieces are one
            apart = np.ones(len(ids) + 1, bool)
            apart[1:-1] = (ids[1:] != self.unknown) | (ids[:-1] != self.unknown)
            apart[offsets] = True
            ids, offsets = ids[apart[:-1]], np.concatenate([[0], np.cumsum(apart[:-1])])[offsets]
        if check == TEXTS:
            theirs = self.library.encode(texts, num_threads=1, add_eos=end)
            for k, (a, b) in enumerate(zip(offsets, offsets[1:], strict=False)):
                if theirs[k] != ids[a:b].tolist():
                    raise AssertionError(f"ids differ from the library's in {texts[k][:200]!r}")
        return ids, offsets

    def _check_spans(self, new: list[str]) -> None:
        """Holds spans against the library, which puts the prefix space that they have in front of each by itself."""
        if self.mapped or not (self.prefix and self.spaced and self.byte):
            raise ValueError("spans of this model are no texts of their own: check whole texts")
        spans = [s for s in new if len(s) > 1]
        theirs = self.library.encode([s[1:] for s in spans], num_threads=1)
        for s, other in zip(spans, theirs, strict=True):
            k = self.memo[s]
            if self.pool[self.pool_end[k] : self.pool_end[k + 1]].tolist() != other:
                raise AssertionError(f"ids differ from the library's in {s[:200]!r}")

    # -- decoding ---------------------------------------------------------

    def _decoding(self) -> None:
        surface = []
        for i, (t, k) in enumerate(zip(self.text, self.kind, strict=True)):
            if k == CONTROL:
                surface.append(b"")
            elif k == BYTE:
                surface.append(bytes([int(t[3:5], 16)]))
            elif i == self.unknown:
                surface.append(self.unknown_text)
            else:
                surface.append(t.replace(SPACE, " ").encode())
        self.surface = pa.array(surface, pa.large_binary())
        self.is_byte = np.array([k == BYTE for k in self.kind])
        self.is_silent = np.array([k == CONTROL for k in self.kind])
        self.opens = np.array([t.startswith(SPACE) and k not in (CONTROL, UNKNOWN, BYTE) for t, k in zip(self.text, self.kind, strict=True)])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each of some id lists; an id outside the model is an error."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.text):
            raise IndexError("an id that the model does not have")
        parts = self.surface.take(pa.array(ids))
        _, bounds, data = parts.buffers()
        at = np.frombuffer(bounds, np.int64)[parts.offset : parts.offset + len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        raw = bytes(data) if data is not None else b""
        cut, texts = offsets.tolist(), []
        # A control id in front or inside parts bytes and moves the opening: such lists are read id by id.
        inside = self.is_silent[ids]
        inside[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = False
        slow = self.trims | (np.diff(np.concatenate([[0], np.cumsum(inside)])[offsets]) > 0)
        for a, b, x, y, apart in zip(cut, cut[1:], at[offsets[:-1]].tolist(), at[offsets[1:]].tolist(), slow.tolist(), strict=False):
            try:
                if apart:
                    raise UnicodeError
                text = raw[x:y].decode()
                texts.append(text[1:] if self.prefix and a < b and self.opens[ids[a]] else text)
            except UnicodeError:
                texts.append(self._decode_slowly(ids[a:b].tolist()))
        return texts

    def _decode_slowly(self, ids: list[int]) -> str:
        out, run, opening, eaten = [], bytearray(), True, False

        def flush() -> None:
            while run:
                try:
                    out.append(run.decode())
                    run.clear()
                except UnicodeDecodeError as e:
                    out.append(run[: e.start].decode() + "�")
                    del run[: e.start + 1]

        for i in ids:
            if self.kind[i] == BYTE:
                run += self.surface[i].as_py()
                continue
            flush()
            if eaten or any(out):
                opening = False
            part, eaten = self.surface[i].as_py().decode(), False
            if opening and (self.prefix or self.trims) and self.opens[i]:
                part, eaten = part[1:], not self.trims  # trimming goes on at the next piece
            out.append(part)
        flush()
        return "".join(out)


#: Spaces and what follows them up to the next ones.
_WORDS = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def _groups(batch: pa.RecordBatch, size) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``GROUP_BYTES`` by ``size`` (bytes of each row)."""
    first, held = 0, 0
    for i, n in enumerate(size):
        held += n
        if held >= GROUP_BYTES or i == batch.num_rows - 1:
            yield batch.slice(first, i + 1 - first)
            first, held = i + 1, 0


def _encoding(model, end: bool, check: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for whole in batches:
            for batch in _groups(whole, (len(s) if (s := t.as_buffer()) else 0 for t in whole.column("text"))):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                ids, offsets = m.encode(texts, end, check)
                column = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("row"), column], ["row", "ids"])

    return run


def _decoder(model, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for whole in batches:
            lists = whole.column("ids")
            for batch in _groups(whole, (4 * (n or 0) for n in lists.value_lengths().to_pylist())):
                ids = batch.column("ids").fill_null([]).cast(pa.large_list(pa.int32()))
                offsets = ids.offsets.to_numpy()
                flat = ids.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
                texts = m.decode(flat, offsets - offsets[0])
                if check and texts != (theirs := m.library.decode([x.tolist() for x in np.split(flat, (offsets - offsets[0])[1:-1])])):
                    k = next(k for k, (a, b) in enumerate(zip(texts, theirs, strict=True)) if a != b)
                    raise AssertionError(f"the text differs from the library's: {theirs[k][:200]!r}")
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("ids"), pa.array(texts, pa.string())], ["row", "ids", "decoded"])

    return run


def encode(docs: DataFrame, path: str, carry: list[str] | None = None, end: bool = True, check: str = TEXTS) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, by default all but ``text``) and ``ids`` (array<int>) of every whole text.

    ``end`` adds the model's end id; nothing is sampled.  A null or empty text
    has no ids but the end.  ``check`` compares each Arrow batch with the
    library and fails on a difference: its whole ``texts``, its ``spans`` that
    the worker hasn't met (for models whose words are texts of their own), or
    nothing (an empty string).  Equal rows get equal ids, each by
    itself; an empty table gives an empty one.
    """
    whole = F.struct(*(docs[c] for c in (carry if carry is not None else [c for c in docs.columns if c.lower() != "text"])))
    given = docs.select(whole.alias("row"), "text")
    model = docs.sparkSession.sparkContext.broadcast(Model(path))
    return given.mapInArrow(_encoding(model, end, check), f"row {given.schema['row'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, check: bool = True) -> DataFrame:
    """``encoded`` (row, ids) with the text of each row's ids as ``decoded``.

    Ids need not come from ``encode``: control ids are silent, bytes that are
    no UTF-8 become U+FFFD.  Null ids are read as none; an id that the model
    doesn't have is an error.
    """
    model = encoded.sparkSession.sparkContext.broadcast(Model(path))
    schema = f"row {encoded.schema['row'].dataType.simpleString()}, ids array<int>, decoded string"
    return encoded.select("row", "ids").mapInArrow(_decoder(model, check), schema)

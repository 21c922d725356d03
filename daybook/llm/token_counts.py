"""Token counts by a compiled finite-state tokenizer.

Two deterministic transducers whose transitions carry counts of emitted
tokens, with deltas of the tokens known so far:

* **Splitter.**  Eleven states over eleven classes of code points say where
  pre-tokens start (letters, digits, other signs, white space, contractions),
  with the one or two places of delay that white space and contractions need.
  A block of texts is cut into chunks; each chunk's map from entry state to
  exit state is computed for all chunks at once, one column at a time, and the
  maps are composed by a parallel prefix scan, which gives each chunk's true
  entry state.  A second sweep emits the starts.
* **Merger.**  Over the bytes of one pre-token.  The last token of a prefix's
  encoding is the one token that ends there and is compatible with the last
  token before it (the pair encodes to itself); so a state is the longest
  suffix that can still begin a token, with the last tokens and counts at its
  positions, and a transition's annotation is the change in the count.  States
  are compiled as they are met.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.words import BLOCK_BYTES

#: Positions of one chunk; compiled states and counted pre-tokens that a worker holds before it starts afresh.
CHUNK = 64
MOST_STATES = 200_000
MOST_COUNTS = 400_000

# Classes of code points and states of the splitter.
LETTER, SUFFIX, R_OR_V, ELL, E, NUMBER, SPACE, WHITE, QUOTE, OTHER, END = range(11)
FRESH, IN_LETTERS, IN_NUMBER, IN_OTHER, ONE_SPACE, ONE_WHITE, SPACES, WHITES, QUOTED, QUOTED_RV, QUOTED_L = range(11)
HERE, BEFORE = 1, 2  # a pre-token starts at this position; at the one before


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emitted starts for each (state, class)."""
    step, emit = np.zeros((11, 11), np.uint8), np.zeros((11, 11), np.uint8)
    run_of = {NUMBER: IN_NUMBER, OTHER: IN_OTHER, QUOTE: IN_OTHER} | dict.fromkeys((LETTER, SUFFIX, R_OR_V, ELL, E), IN_LETTERS)
    for state in range(11):
        for c in range(11):
            out, to = 0, FRESH
            s = state
            if s == QUOTED_RV and c == E or s == QUOTED_L and c == ELL:
                continue  # the contraction is complete; nothing new starts
            if s in (QUOTED_RV, QUOTED_L):  # no contraction: the quote stood alone and a word began after it
                out, s = BEFORE, IN_LETTERS
            if c == END:
                out, to = out | HERE, FRESH
            elif c in (SPACE, WHITE):
                if s in (ONE_SPACE, ONE_WHITE, SPACES, WHITES):
                    to = SPACES if c == SPACE else WHITES
                else:
                    out, to = out | HERE, ONE_SPACE if c == SPACE else ONE_WHITE
            elif s == QUOTED and c == SUFFIX:
                to = FRESH
            elif s == QUOTED and c in (R_OR_V, ELL):
                to = QUOTED_RV if c == R_OR_V else QUOTED_L
            else:
                to = run_of[c]
                if s in (SPACES, WHITES):
                    out |= BEFORE
                if s in (ONE_SPACE, SPACES):
                    pass  # the space begins this pre-token
                elif s == QUOTED and to == IN_OTHER or s == to:
                    pass  # the run goes on
                else:
                    out |= HERE
                    if c == QUOTE:
                        to = QUOTED
            step[state, c], emit[state, c] = to, out
    return step, emit


_STEP, _EMIT = _splitter()


def class_table() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    for name, c in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", WHITE)):
        every = "".join(chr(i) if not 0xD800 <= i < 0xE000 else "!" for i in range(0x110000))
        for m in regex.finditer(name, every):
            table[m.start() : m.end()] = c
    for chars, c in (("stmd", SUFFIX), ("rv", R_OR_V), ("l", ELL), ("e", E), (" ", SPACE), ("'", QUOTE)):
        table[[ord(x) for x in chars]] = c
    return table


def chunk_maps(classes: np.ndarray) -> np.ndarray:
    """Exit state of each chunk (row of ``classes``) for each entry state."""
    maps = np.repeat(np.arange(11, dtype=np.intp)[:, None], classes.shape[0], axis=1)
    flat = _STEP.ravel().astype(np.intp)
    for column in np.ascontiguousarray(classes.T).astype(np.intp):
        maps = flat[maps * 11 + column]
    return maps.T


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """Row i becomes the composition of rows 0 to i, by doubling strides."""
    maps, stride = maps.copy(), 1
    while stride < len(maps):
        maps[stride:] = np.take_along_axis(maps[stride:], maps[:-stride], axis=1)
        stride *= 2
    return maps


def starts(classes: np.ndarray) -> np.ndarray:
    """Positions at which pre-tokens (and END marks) start."""
    n = len(classes)
    padded = np.full(-(-max(n, 1) // CHUNK) * CHUNK, END, np.uint8)
    padded[:n] = classes
    grid = padded.reshape(-1, CHUNK)
    entry = np.concatenate([[FRESH], prefix_scan(chunk_maps(grid))[:-1, FRESH]]).astype(np.intp)
    step, emit = _STEP.ravel().astype(np.intp), _EMIT.ravel()
    out = np.empty(grid.T.shape, np.uint8)
    for j, column in enumerate(np.ascontiguousarray(grid.T).astype(np.intp)):
        at = entry * 11 + column
        out[j] = emit[at]
        entry = step[at]
    emitted = out.T.ravel()
    here = (emitted & HERE).astype(bool)
    here[:-1] |= (emitted[1:] & BEFORE).astype(bool)
    return np.flatnonzero(here[:n])


class Merger:
    """Counts the tokens of one pre-token, by a transducer over its bytes that is compiled as it is used."""

    def __init__(self, vocabulary: list[bytes], ranks: dict[bytes, int]) -> None:
        self.ranks = ranks  # of a merge, by the bytes of its result
        self.tokens = set(vocabulary)
        self.prefixes = {t[:i] for t in vocabulary for i in range(1, len(t))}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self._clear()

    def _clear(self) -> None:
        self.states: list[tuple] = [(b"", (None,), (0,))]
        self.ids: dict[tuple, int] = {self.states[0]: 0}
        self.moves: dict[int, tuple[int, int]] = {}

    def _compatible(self, a: bytes, b: bytes) -> bool:
        if (known := self.pairs.get((a, b))) is None:
            if len(self.pairs) > MOST_STATES:
                self.pairs = {}
            known = self.pairs[a, b] = self._merged(a + b) == [a, b]
        return known

    def _merged(self, text: bytes) -> list[bytes]:
        parts = [text[i : i + 1] for i in range(len(text))]
        while True:
            found = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                return parts
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        """(next state, change in the count).  A state: pending bytes; last token and relative count at each of their positions."""
        pending, last, count = self.states[state]
        text = pending + bytes([byte])
        for length in range(len(text), 0, -1):
            token, at = text[-length:], len(text) - length
            if token in self.tokens and (last[at] is None or self._compatible(last[at], token)):
                break
        change = count[at] + 1  # counts are relative to the newest position
        last, count = (*last, token), (*(c - change for c in count), 0)
        drop = 0
        while drop < len(text) and text[drop:] not in self.prefixes:
            drop += 1
        new = (text[drop:], last[drop:], count[drop:])
        if (to := self.ids.get(new)) is None:
            to = self.ids[new] = len(self.states)
            self.states.append(new)
        return to, change

    def count(self, piece: bytes) -> int:
        if len(self.states) > MOST_STATES:
            self._clear()
        moves, state, total = self.moves, 0, 0
        for byte in piece:
            key = state << 8 | byte
            if (move := moves.get(key)) is None:
                move = moves[key] = self._move(state, byte)
            state = move[0]
            total += move[1]
        return total


def _byte_of() -> dict[str, int]:
    """The byte that each printable stand-in of a byte-level vocabulary means."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter:
    """The compiled form of a byte-level BPE tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("only byte-level BPE without a normalizer or prefix space is compiled")
        byte = _byte_of()
        raw = lambda s: bytes(byte[c] for c in s)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        ranks = {}
        for i, (a, b) in enumerate(pairs):
            ranks.setdefault(raw(a) + raw(b), i)
        special = {t["content"] for t in spec["added_tokens"]}
        vocabulary = [raw(t) for t in spec["model"]["vocab"] if t not in special]
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.merger = Merger(vocabulary, ranks)
        self.classes = class_table()
        self.known: dict[str, int] = {}

    def _one(self, piece: str) -> int:
        n = self.merger.count(piece.encode())
        if len(piece) <= 64:
            self.known[piece] = n
        return n

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        owner, parts, extra = [], [], np.zeros(len(texts), np.int64)
        marks = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        for i, t in enumerate(texts):
            cut = marks.split(t) if marks and marks.search(t) else [t]
            extra[i] = len(cut) - 1
            parts += cut
            owner += [i] * len(cut)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        whole = "\n".join(parts) + "\n"  # the separator's class is replaced
        ends = np.cumsum(lengths + 1) - 1
        classes = self.classes[np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)]
        classes[ends] = END
        at = starts(classes)
        real = classes[at] != END
        until = np.append(at[1:], len(whole))
        known, one = self.known, self._one
        if len(known) > MOST_COUNTS:
            known.clear()
        pieces = [whole[a:b] for a, b in zip(at[real].tolist(), until[real].tolist(), strict=True)]
        n = np.fromiter((known.get(p) or one(p) for p in pieces), np.int64, len(pieces))
        part = np.searchsorted(ends, at[real])
        return extra + np.bincount(np.array(owner, np.int64)[part], n, len(texts)).astype(np.int64)


def _counting(counter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found, i = [], 0
            while i < len(texts):
                j, held = i, 0
                while j < len(texts) and (j == i or held < BLOCK_BYTES):
                    held += len(texts[j])
                    j += 1
                found.append(counter.value.counts(texts[i:j]))
                i = j
            n = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(n, pa.int64())], ["row", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, all by default) and ``n_tokens`` of every whole text.

    Counts are those of the byte-level BPE file at ``path``: no tokens are
    added, and a special token's string inside a text counts as that token.  A
    null or empty text has none.  Repeated rows are counted each time.
    """
    whole = F.struct(*(docs[c] for c in (docs.columns if carry is None else carry)))
    given = docs.select(whole.alias("row"), "text")
    counter = docs.sparkSession.sparkContext.broadcast(Counter(path))
    return given.mapInArrow(_counting(counter), f"row {given.schema['row'].dataType.simpleString()}, n_tokens long")

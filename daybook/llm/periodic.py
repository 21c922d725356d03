"""Periodic runs of words by an online sparse diagonal DP.

A run of period q is a stretch of consecutive words in which words q apart are
equal, that no neighbour extends, whose smallest period is q and whose length
is at least ``LEAST`` words and three periods.  Word i and an earlier
occurrence of it at i - q are a match on the diagonal of lag q; a run of
length n is a diagonal's stretch of n - q matches.

Words are taken in order.  Each one's earlier occurrences lengthen the matches
of their lags, and a lag that a word doesn't continue has ended: if its match
is long enough, its run is emitted there and then.  What is active is a handful
of lags, never a table over all pairs of words.

The DP is kept sparse, exactly, by context: an earlier occurrence counts only
if the ``w`` words up to it are the same too, it is the nearest such one, and
its lag is at most ``w`` (and over w / 2, but for the first w).  ``w`` is
16, 32, 64, ...  This loses no run: its match is as long as the w of its lag
(at least 2q and 24 - q words), and inside a run of smallest period q <= w no
copy of w words is nearer than q, since two periods of such a stretch would
have a common divisor as a period.  For the same reason a lag whose run has a
smaller period is never the nearest.  So every word has at most one occurrence
for each w, and a text of n words takes O(n log n) however often a word comes.

A first pass over hashes of 16 words leaves out texts in which no 16 words
repeat (equal words have equal hashes, so it can only keep too many); the rest
is decided on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.words import Hasher, Words, blocks, gram_hashes, scan_words, string_buffers

#: Fewest words of a run; fewest periods.
LEAST, PERIODS = 24, 3
#: Words of the shortest context: no run matches fewer (the least of max(24 - q, 2q) over q).
CONTEXT = min(max(LEAST - q, (PERIODS - 1) * q) for q in range(1, LEAST))

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def occurrences(word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, lag, context) of every earlier occurrence that can be part of a run, in order of the words.

    ``word`` numbers equal words equally.
    """
    n, w, found = len(word), 1, []
    same = np.unique(word, return_inverse=True)[1].astype(np.int64)  # numbers of the w words that end at w - 1, w, ...
    while len(same):
        if w >= CONTEXT:
            order = np.argsort(same, kind="stable")
            again = same[order[1:]] == same[order[:-1]]
            if not again.any():
                break
            at, lag = order[1:][again], (order[1:] - order[:-1])[again]
            near = (lag <= w) & ((lag > w // 2) if w > CONTEXT else True)
            found.append((at[near] + w - 1, lag[near], np.full(near.sum(), w)))
        if w > n:
            break
        pair = same[:-w] * (int(same.max()) + 1) + same[w:]
        same, w = np.unique(pair, return_inverse=True)[1].astype(np.int64), 2 * w
    if not found:
        return (np.zeros(0, np.int64),) * 3
    at, lag, context = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(at, kind="stable")
    return at[order], lag[order], context[order]


def diagonal_runs(word: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    runs: list[tuple[int, int, int]] = []
    active: dict[int, int] = {}  # lag -> words matched up to the word before
    now: dict[int, int] = {}
    before = -1

    def end(word: int, lags) -> None:
        for q in lags:
            length = active[q] + q
            if length >= max(LEAST, PERIODS * q):
                runs.append((word - length + 1, length, q))

    at, lag, context = (x.tolist() for x in occurrences(word))
    for i, q, w in zip(at, lag, context, strict=True):
        if i != before:
            end(before - 1, active.keys() - now.keys())
            active, now = now, {}
            if i != before + 1:
                end(before, active)
                active = {}
            before = i
        now[q] = active[q] + 1 if q in active else w
    end(before - 1, active.keys() - now.keys())
    active = now
    end(before, active)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _suspects(words: Words) -> Iterator[int]:
    """Texts in which some ``CONTEXT`` words come twice."""
    grams, at = gram_hashes(words, CONTEXT)
    cut = np.searchsorted(at, words.first)
    for t in np.flatnonzero(np.diff(cut) > 1).tolist():
        x = np.sort(grams[cut[t] : cut[t + 1]])
        if (x[1:] == x[:-1]).any():
            yield t


def _numbered(raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    number: dict[bytes, int] = {}
    return np.fromiter((number.setdefault(raw[a:b], len(number)) for a, b in zip(start.tolist(), end.tolist(), strict=True)), np.int64, len(start))


def _joined(data: np.ndarray, words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    start, end, text = words.start[kept], words.end[kept], words.text[kept]
    spaced = np.zeros(len(start), bool)
    spaced[:-1] = text[:-1] == text[1:]  # another kept word follows, so the byte after this one is white
    stop = end + spaced
    edge = np.zeros(len(data) + 1, np.int8)
    edge[start] += 1
    edge[stop] -= 1
    out = data.copy()
    out[end[spaced]] = 0x20
    out = out[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)]
    n = len(words.first) - 1
    size = np.bincount(text, weights=stop - start, minlength=n).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)])
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(out)).cast(pa.string())


def _finding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            data, offsets = string_buffers(batch.column("text"))
            for i, j, raw, off in blocks(data, offsets):
                words = scan_words(raw, off, lower=False, hasher=Hasher(raw))
                kept = np.ones(len(words.start), bool)
                runs: list[list[tuple[int, int, int]]] = [[] for _ in range(j - i)]
                for t in _suspects(words):
                    a, b = words.first[t], words.first[t + 1]
                    runs[t] = diagonal_runs(_numbered(raw[off[t] : off[t + 1]].tobytes(), words.start[a:b] - off[t], words.end[a:b] - off[t]))
                    for start, length, q in runs[t]:
                        kept[a + start + q : a + start + length] = False
                flat = np.array([r for x in runs for r in x], np.int64).reshape(-1, 3)
                cut = np.concatenate([[0], np.cumsum([len(x) for x in runs])]).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(cut), pa.StructArray.from_arrays([pa.array(c) for c in flat.T.copy()], fields=list(RUN)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(i, j - i), pa.array(np.diff(words.first).astype(np.int64)), found, _joined(raw, words, kept)],
                    ["row", "n_words", "runs", "collapsed"],
                )


def periodic_runs(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The periodic runs of the words ``[^\\x20\\x09-\\x0D]+`` of every whole text.

    Returns ``row`` (a struct of the ``carry`` columns, by default all but
    ``text``), ``n_words``, ``runs`` (array of start, length, period in words
    from 0, by start, then period) and ``collapsed`` (the words joined by one
    space, without those that a run repeats after its first period).

    A null or empty text has no words, no runs and an empty ``collapsed``.
    Runs may overlap; each is reported, and a word goes if any of them repeats
    it.  Every row is judged by itself: equal rows get equal results, and an
    empty table an empty one.  There is no exchange, and no bound on a text
    but memory for a few numbers a word.
    """
    whole = F.struct(*(docs[c] for c in (carry if carry is not None else [c for c in docs.columns if c.lower() != "text"])))
    given = docs.select(whole.alias("row"), "text")
    schema = f"row {given.schema['row'].dataType.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return given.mapInArrow(_finding, schema)

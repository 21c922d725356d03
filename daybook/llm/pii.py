"""Personal data by patterns and a skip-chain conditional random field.

Patterns find the base spans.  The field's nodes are those spans and all other
places of a document that look a little like one (runs of digits and signs,
four small numbers, words with an at sign or its spelling).  Neighbours in the
text share a chain potential.  Places that are equal but for their spelling
(same trailing nine digits, same four numbers, same address without signs) or
only similar (same trailing seven digits, same name before the at sign) share
one of two skip potentials, each with its next occurrence and with the first
base span of each kind of its form, so edges grow with the text and evidence
reaches any number of repeats.  Base spans are observed.  Loopy sum-product
over all documents of a batch at once gives every other node's label; entity
labels add spans.

All potentials are learned together, by the pseudo-likelihood of the hidden
nodes, in numpy, on a bounded sample.  The patterns can't label what they
don't find, so training texts get further mentions of their base spans in
other spellings, whose labels are known, and altered ones, which are nothing.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.arrow import by_bytes, text_column
from daybook.llm.arrow import with_text as rows_with_text

KINDS = ["email", "ip", "card", "phone"]
OTHER = len(KINDS)
#: Bounds of the training sample: distinct texts of smallest hash among those with a digit or an at sign, and bytes of each.
SAMPLE, SAMPLE_BYTES = 2000, 1 << 14
#: PULL towards what holds before anything is learned weighs as much at every sample size, so few nodes move little.
EPOCHS, RATE, PULL = 300, 1.0, 1.0
#: Altered copies of a sample text, and further mentions in each.
NOISED, MENTIONS = 2, 3
DAMPING, LEAST = 0.3, 0.5
#: Messages rest when none changes by more than this.  After PATIENCE passes steps shrink by a hundredth each pass, so all come to rest.
REST, PATIENCE = 1e-4, 200
#: Kinds of skip edges, and what agreement on an entity label across them is worth before anything is learned.
EQUAL, SIMILAR = 0, 1
PRIOR = (6.0, 2.0)

_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[^0-9]+")
_NUMBERS = re.compile(r"(?<![0-9])\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+")
_FOUR = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:[\x20,_.-]|\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])")
_ADDRESSES = re.compile(r"(?<!\S)[^\s@(\[]+ ?(?:@|\(at\)|\[at\]) ?[^\s@]+(?: ?(?:\(dot\)|\[dot\]) ?[^\s@]+)*", re.IGNORECASE)
#: Spelled out with bare words; the word before the name may belong to it.
_SPELLED = re.compile(r"(?<!\S)(?:([^\s@]+) )?((?:[^\s@]+ dot )*+[^\s@]+) at ([^\s@]+(?: dot [^\s@]+)+)", re.IGNORECASE)
_AT = re.compile(r" ?[(\[]at[)\]] ?| at ", re.IGNORECASE)
_DOT = re.compile(r" ?[(\[]dot[)\]] ?| dot ", re.IGNORECASE)
_SIGNS = re.compile(r"[^a-z0-9]+")


def luhn(digits: str) -> bool:
    double = str.maketrans("0123456789", "0246813579")
    return (sum(map(int, digits[-1::-2])) + sum(map(int, digits[-2::-2].translate(double)))) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, sorted; the e-mail scan and all patterns take time linear in the text."""
    found = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _spelled(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Addresses in bare words; two words are the name if a base address has them, else one is."""
    if " at " not in (low := text.lower()) or " dot " not in low:
        return
    known = {w for s, k, e in base if k == 0 for w in forms(text[s:e])[EQUAL]}
    for m in _SPELLED.finditer(text):
        one, two = (known.isdisjoint(forms(text[at : m.end()])[EQUAL]) for at in (m.start(2), m.start()))
        yield m.start() if one and not two else m.start(2), OTHER, m.end()


def places(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, label, end) of all nodes of a text: base spans, and with label OTHER what else looks like one."""
    nodes, at, reached = [], 0, 0
    other = [(m.start(), OTHER, m.end()) for p in (_NUMBERS, _FOUR, _ADDRESSES) for m in p.finditer(text)]
    other += _spelled(text, base)
    for s, k, e in sorted(other, key=lambda x: (x[0], -x[2])):
        while at < len(base) and base[at][0] < s:
            reached = max(reached, base[at][2])
            at += 1
        if s >= reached and (at == len(base) or base[at][0] >= e):
            nodes.append((s, k, e))
            reached = e
    return sorted(base + nodes)


def forms(part: str) -> tuple[list[str], list[str]]:
    """The forms of a place by which it is EQUAL and by which it is only SIMILAR to another."""
    plain = _DOT.sub(".", _AT.sub("@", part.lower()))
    if "@" in plain:
        name, _, domain = plain.strip(".,;:!?<>\"'() ").partition("@")
        name = _SIGNS.sub("", name)
        return [f"{name}@{_SIGNS.sub('.', domain)}"], [f"{name}@"] if len(name) > 3 else []
    groups = _DIGITS.sub(" ", part).split()
    digits = "".join(groups)
    equal = [digits[-9:]] if len(digits) >= 9 else []
    if len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups):
        equal.append(".".join(str(int(g)) for g in groups))
    return equal, [f"{digits[-7:]}#"] if len(digits) >= 7 else []


def features(part: str) -> list[float]:
    digits = _DIGITS.sub("", part)
    n = len(digits)
    low = part.lower()
    return [
        1, n < 7, 7 <= n < 9, 9 <= n < 12, 12 <= n < 16, n == 16, 16 < n < 20, n >= 20, "+" in part, "(" in part, part.count(".") == 3,
        "@" in part, "at)" in low or "at]" in low or " at " in low, "-" in part, " " in part, n >= 12 and luhn(digits),
    ]


@dataclass
class Field:
    weights: np.ndarray = field(default_factory=lambda: np.zeros((16, OTHER + 1)))
    chain: np.ndarray = field(default_factory=lambda: np.zeros((OTHER + 1, OTHER + 1)))
    #: What agreement on each label is worth across an EQUAL and across a SIMILAR edge.
    skip: np.ndarray = field(default_factory=lambda: np.outer(PRIOR, np.arange(OTHER + 1) != OTHER))


@dataclass
class Graph:
    """Nodes and edges of some documents."""

    node: list[tuple[int, int, int, int]]  # document, start, label, end
    x: np.ndarray
    label: np.ndarray
    chain: np.ndarray  # pairs of neighbouring nodes
    skip: np.ndarray  # pairs of similar nodes: successive ones, and a further one with the first base span of its form and kind
    like: np.ndarray  # EQUAL or SIMILAR, of each of those pairs


def graph(texts: list[str], found: list[list[tuple[int, int, int]]]) -> Graph:
    node, x, chain, skip = [], [], [], {}
    for d, (text, base) in enumerate(zip(texts, found, strict=True)):
        here, first = places(text, base), len(node)
        if not here:
            continue
        shared = [forms(text[s:e]) for s, _, e in here]
        for like in (EQUAL, SIMILAR):
            last: dict[str, int] = {}
            heads: dict[str, dict[int, int]] = {}
            for i, ((_, k, _), named) in enumerate(zip(here, shared, strict=True), first):
                for form in named[like]:
                    if form in last and last[form] != i:
                        skip.setdefault((last[form], i), like)
                    last[form] = i
                    if k != OTHER:
                        heads.setdefault(form, {}).setdefault(k, i)
            for i, ((_, k, _), named) in enumerate(zip(here, shared, strict=True), first):
                if k == OTHER:
                    for h in (h for form in named[like] for h in heads.get(form, {}).values()):
                        skip.setdefault((min(h, i), max(h, i)), like)
        node += [(d, s, k, e) for s, k, e in here]
        x += [features(text[s:e]) for s, _, e in here]
        chain += [(i - 1, i) for i in range(first + 1, len(node))]
    pairs = lambda p: np.array(p, np.int64).reshape(-1, 2)
    label = np.array([k for _, _, k, _ in node], np.int64)
    return Graph(node, np.array(x, float).reshape(-1, 16), label, pairs(chain), pairs(list(skip)), np.array(list(skip.values()), np.int64))


def respelled(kind: int, part: str, draw: random.Random) -> str:
    """A further mention of a base span as people may write it."""
    if kind == 0:
        name, _, domain = part.partition("@")
        say = draw.choice(["{} (at) {}", "{} [at] {}", "{} at {}"])
        dot = " dot " if " at " in say else draw.choice([".", " (dot) ", " [dot] "])
        if draw.random() < 0.2:
            domain = domain.rpartition(".")[0] + ".net"
        out = say.format(name, domain.replace(".", dot))
        return out.upper() if draw.random() < 0.2 else out
    digits = _DIGITS.sub("", part)
    if kind == 1:
        return draw.choice([" ", "-", ",", "_", "[.]"]).join(part.split("."))
    if kind == 2:
        return draw.choice([".", " ", ""]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    cut = [c for c in (digits[:-10], digits[-10:-7], digits[-7:-4], digits[-4:]) if c]
    return draw.choice([" ", ".", "-", ""]).join(draw.choice([cut, cut[-3:], cut[-2:]]))


def altered(part: str, draw: random.Random) -> str:
    """Something that looks like a place and is another one: digits drawn anew, or names turned round."""
    out = re.sub("[0-9]", lambda _: draw.choice("0123456789"), part)
    return out if out != part else part[::-1]


def _noised(texts: list[str], draw: random.Random) -> tuple[Graph, np.ndarray]:
    """The graph of texts with further mentions, and the true labels of its nodes (-1: unknown, a place that was there and is similar to a base span)."""
    changed, marks = [], []
    for text in texts:
        base = base_spans(text)
        held = [0] * (len(text) + 1)
        for s, _, e in places(text, base):
            held[s:e] = [1] * (e - s)
        gaps = [i for i, c in enumerate(text) if c == " " and not held[i]] or [len(text)]
        inserts = []
        for s, k, e in draw.choices(base, k=MENTIONS) if base else ():
            part = respelled(k, text[s:e], draw)
            inserts.append((draw.choice(gaps), k, part) if draw.random() < 0.7 else (draw.choice(gaps), OTHER, altered(part, draw)))
        out, at, mark = [], 0, []
        for i, k, part in sorted(inserts):
            out += [text[at:i], " ; ", part, " ;"]
            start = sum(map(len, out)) - len(part) - 2
            mark.append((start, k, start + len(part)))
            at = i
        changed.append("".join([*out, text[at:]]))
        marks.append(mark)
    g = graph(changed, [base_spans(t) for t in changed])
    label, tied = g.label.copy(), reached(g)
    for i, (d, s, k, e) in enumerate(g.node):
        if k == OTHER:
            label[i] = next((m for a, m, b in marks[d] if s < b and a < e), -1 if tied[i] else OTHER)
    return g, label


def train(texts: list[str], seed: int = 0) -> Field:
    """All potentials, by gradient descent on the pseudo-likelihood of the nodes that aren't base spans."""
    out, before, draw = Field(), Field(), random.Random(seed)
    g, truth = _noised([t for t in texts for _ in range(NOISED)], draw)
    hidden = (g.label == OTHER) & (truth >= 0)
    if not hidden.any():
        return out
    one = np.eye(OTHER + 1)[truth]
    sure = [(truth[e] >= 0).all(1) for e in (g.chain, g.skip)]
    (a, b), (p, q), like = g.chain[sure[0]].T, g.skip[sure[1]].T, g.like[sure[1]]
    # A skip edge tells each end the label of the other.
    to, said, like = np.concatenate([p, q]), truth[np.concatenate([q, p])], np.concatenate([like, like])
    n, ones = int(hidden.sum()), np.eye(2 * (OTHER + 1)).reshape(2, OTHER + 1, -1)[like, said]
    pull = min(0.5, PULL / n)
    for _ in range(EPOCHS):
        z = g.x @ out.weights
        np.add.at(z, b, out.chain[truth[a]])
        np.add.at(z, a, out.chain[:, truth[b]].T)
        np.add.at(z, (to, said), out.skip[like, said])
        off = np.exp(z - z.max(1, keepdims=True))
        off = (off / off.sum(1, keepdims=True) - one) * hidden[:, None]
        chain = np.zeros_like(out.chain)
        np.add.at(chain, truth[a], off[b])
        np.add.at(chain.T, truth[b], off[a])
        skip = (off[to, said] @ ones).reshape(out.skip.shape)
        out.weights -= RATE * (g.x.T @ off / n + pull * out.weights)
        out.chain -= RATE * (chain / n + pull * out.chain)
        out.skip -= RATE * (skip / n + pull * (out.skip - before.skip))
    return out


def fit(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """Train on at most ``sample`` distinct texts of ``docs`` of SAMPLE_BYTES or less, those of smallest hash; hashes alone are compared to choose them."""
    rows = docs.select("text").where(f"text RLIKE '[0-9@]' AND octet_length(text) <= {SAMPLE_BYTES}").withColumn("h", F.xxhash64("text"))
    chosen = [r.h for r in rows.select("h").distinct().orderBy("h").limit(sample).collect()]
    texts = rows.where(F.col("h").isin(chosen)).groupBy("h").agg(F.min("text").alias("text")).orderBy("h")
    return train([r.text for r in texts.collect()])


def marginals(g: Graph, f: Field) -> np.ndarray:
    """Label probabilities of every node after loopy sum-product passes; base spans are observed."""
    unary = g.x @ f.weights
    seen = g.label != OTHER
    unary[seen] = -1e3
    unary[seen, g.label[seen]] = 0
    owner = np.array([d for d, *_ in g.node], np.int64)
    edge = np.concatenate([g.chain, g.skip])
    agree = np.stack([np.diag(w) for w in f.skip])
    pair = np.concatenate([np.repeat(f.chain[None], len(g.chain), 0), agree[g.like]])
    source, target = np.concatenate([edge[:, 0], edge[:, 1]]), np.concatenate([edge[:, 1], edge[:, 0]])
    pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
    back = np.roll(np.arange(len(source)), len(edge))
    message = np.zeros((len(source), OTHER + 1))
    # what is told to an observed node changes nothing, and what it says is known at once
    live, passes, step = np.flatnonzero(~seen[target]), 0, 1 - DAMPING
    while len(live):
        belief = unary.copy()
        np.add.at(belief, target, message)
        z = (belief[source[live]] - message[back[live]])[:, :, None] + pair[live]
        top = z.max(1, keepdims=True)
        new = np.log(np.exp(z - top).sum(1)) + top[:, 0]
        new -= new.max(1, keepdims=True)
        new = (1 - step) * message[live] + step * new
        change = np.zeros(owner.max() + 1)  # a document's messages rest together, whatever others do
        np.maximum.at(change, owner[source[live]], np.abs(new - message[live]).max(1))
        message[live] = new
        live = live[change[owner[source[live]]] > REST]
        passes += 1
        step *= 0.99 if passes > PATIENCE else 1
    np.add.at(unary, target, message)
    p = np.exp(unary - unary.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def reached(g: Graph) -> np.ndarray:
    """Whether skip edges lead from each node to a base span."""
    tied, (a, b), n = g.label != OTHER, g.skip.T, -1
    while n != (n := int(tied.sum())):
        either = tied[a] | tied[b]
        np.logical_or.at(tied, a, either)
        np.logical_or.at(tied, b, either)
    return tied


def spans(texts: list[str], f: Field) -> list[list[dict]]:
    """The spans of each text, by start, then kind: base spans, and those that the field adds.

    A place is added only if skip edges lead from it to a base span of its
    document: a number that is similar to none, and fails its check, stays.
    """
    found = [base_spans(t) for t in texts]
    g = graph(texts, found)
    out = [[(s, k, e, True, 1.0) for s, k, e in base] for base in found]
    if len(g.node):
        for (d, s, k, e), q, tied in zip(g.node, marginals(g, f), reached(g), strict=True):
            best = int(q.argmax())
            if tied and k == OTHER and best != OTHER and q[best] > LEAST:
                out[d].append((s, best, e, False, float(q[best])))
    return [[{"kind": KINDS[k], "start": s, "end": e, "base": b, "score": q} for s, k, e, b, q in sorted(o)] for o in out]


def redacted(text: str, here: list[dict]) -> str:
    """The text with a mark of its kind for every span; overlapping spans get the first one's mark."""
    parts, at = [], 0
    for s in here:
        if s["start"] >= at:
            parts += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join([*parts, text[at:]])


_SPAN = "array<struct<kind:string,start:long,end:long,base:boolean,score:double>>"


def _finding(held, with_text: bool):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole):
                texts = text_column(batch).to_pylist()
                found = spans([t or "" for t in texts], held.value)
                columns = [batch.column("row"), pa.array(found, kind)]
                if with_text:
                    columns.append(pa.array([t if t is None else redacted(t, s) for t, s in zip(texts, found, strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["row", "spans", "redacted"][: len(columns)])

    return run


def find_pii(docs: DataFrame, f: Field, carry: list[str] | None = None, with_text: bool = False) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, all by default), spans and, if asked for, the redacted text.

    Places count code points, ends are exclusive.  A null or empty text has no
    spans (a null stays null when redacted); repeated rows are searched each
    time.
    """
    given = rows_with_text(docs, carry)
    held = docs.sparkSession.sparkContext.broadcast(f)
    schema = f"row {given.schema['row'].dataType.simpleString()}, spans {_SPAN}" + ", redacted string" * with_text
    return given.mapInArrow(_finding(held, with_text), schema)

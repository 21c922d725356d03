"""The personal-data field: base spans by brute force, planted mentions in other spellings, and labels a lookup can't give."""

import itertools
import math
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from daybook.llm import pii

SPELLINGS = {
    "email": [lambda a: a.replace("@", " (at) "), lambda a: a.replace("@", " at ").replace(".", " dot ") if a.count("@") == 1 else a, lambda a: a.upper().replace("@", "[at]")],
    "ip": [lambda a: a.replace(".", " "), lambda a: a.replace(".", "-"), lambda a: a.replace(".", "[.]")],
    "phone": [lambda a: re.sub("[^0-9]+", " ", a).strip(), lambda a: re.sub("[^0-9]+", "", a)[-10:], lambda a: re.sub("[^0-9]+", "", a)[-7:-4] + "-" + re.sub("[^0-9]+", "", a)[-4:]],
    "card": [lambda a: ".".join(re.findall(".{1,4}", re.sub("[^0-9]+", "", a)))],
}


def texts(part):
    found = sorted({t for t in pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].to_pylist() if t and re.search("[0-9@]", t)})
    random.Random(3).shuffle(found)
    return found[part::2]


@pytest.fixture(scope="module")
def field():
    return pii.train([t for t in texts(0) if len(t) <= pii.SAMPLE_BYTES])


def plain_base(text):
    """The contract's base spans by its own patterns."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for kind, pattern, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 12, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
            if low <= len(digits) <= high and (kind == 3 or total % 10 == 0):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_by_brute_force(documents, field):
    rows = list(enumerate([t for t in texts(1) if len(t) < 20_000][:150] + ["1.2.3.4.5.6.7.8", "a@b.c@d.e", "+1 2 3 4 5 6 7 8 9 +0", "4111-1111 11111111", None, ""]))
    got = pii.find_pii(documents(rows), field).select("row.text", "spans").collect()
    assert len(got) == len(rows)
    for r in got:
        assert [(s.start, pii.KINDS.index(s.kind), s.end) for s in r.spans if s.base] == plain_base(r.text or "")


def test_planted_mentions_are_found_and_other_numbers_left(field):
    draw, planted, caught, wrong = random.Random(5), {k: 0 for k in pii.KINDS}, {k: 0 for k in pii.KINDS}, 0
    for text in texts(1):
        for s, k, e in pii.base_spans(text)[:3]:
            kind = pii.KINDS[k]
            mention = draw.choice(SPELLINGS[kind])(text[s:e])
            stranger = re.sub("[0-9]", lambda _: draw.choice("0123456789"), mention) if k else "someone (at) example.net"
            whole = f"{text} ; {mention} ; {stranger} ;"
            start = len(text) + 3
            if any(a < start + len(mention) and start < b for a, _, b in pii.base_spans(whole)):
                continue  # the patterns see this one
            added = [(x["kind"], x["start"]) for x in pii.spans([whole], field)[0] if not x["base"]]
            planted[kind] += 1
            caught[kind] += any(c == kind and start <= at < start + len(mention) for c, at in added)
            wrong += any(at > start + len(mention) for _, at in added)
    assert all(planted[k] > 20 for k in ("email", "ip", "phone")) and planted["card"] > 5
    assert all(caught[k] >= 0.9 * planted[k] for k in pii.KINDS), (caught, planted)
    assert wrong <= 0.02 * sum(planted.values())


@pytest.mark.parametrize("text, added", [
    ("mail jane.doe@x.org or jane.doe (at) x.com", [("email", "jane.doe (at) x.com")]),
    ("write jane.doe@x.org. Yes JANE DOE at x dot org", [("email", "JANE DOE at x dot org")]),
    ("host 10.0.0.1 says 10 0 0 1 and 10.0.0.256", [("ip", "10 0 0 1")]),
    ("+1 (743) 555-3824 then 555 3824", [("phone", "555 3824")]),
    ("we meet at noon dot com at 743 555 3824 or 743.555.3824", []),
    ("card 4111 1111 1111 1111 order 4111111111111112", []),
])
def test_similar_places(field, text, added):
    assert [(s["kind"], text[s["start"] : s["end"]]) for s in pii.spans([text], field)[0] if not s["base"]] == added


def test_evidence_passes_places_that_equal_no_base_span(field):
    """No form of the last place is a base span's: it is reached through another place only, which a lookup can't do."""
    text = "call +44 743 555 3824 , also 555 3824 , and 9 555 3824"
    base = {w for s, _, e in pii.base_spans(text) for w in pii.forms(text[s:e])[pii.EQUAL]}
    hidden = [text[s:e] for s, k, e in pii.places(text, pii.base_spans(text)) if k == pii.OTHER]
    assert len(hidden) == 2 and all(base.isdisjoint(pii.forms(h)[pii.EQUAL]) for h in hidden)
    assert [text[s["start"] : s["end"]] for s in pii.spans([text], field)[0] if not s["base"]] == hidden
    # one similar base span of another kind does not outvote the rest of the document
    g = pii.graph([text], [pii.base_spans(text)])
    without = pii.Field(field.weights, field.chain, 0 * field.skip)
    assert (pii.marginals(g, without).argmax(1)[g.label == pii.OTHER] == pii.OTHER).all()


def test_messages_rest_and_agree_with_enumeration(field):
    text = "a.b@x.org 10.0.0.1 ; 10 0 0 1 ; a.b (at) x.org ; 743 555 3824 ; 743.555.3824 ;"
    g = pii.graph([text], [pii.base_spans(text)])
    n, labels = len(g.node), pii.OTHER + 1
    exact = np.zeros((n, labels))
    free = [i for i in range(n) if g.label[i] == pii.OTHER]
    for said in itertools.product(range(labels), repeat=len(free)):
        y = g.label.copy()
        y[free] = said
        score = sum(float(g.x[i] @ field.weights[:, y[i]]) for i in free) + sum(field.chain[y[a], y[b]] for a, b in g.chain)
        score += sum(field.skip[k, y[a]] for (a, b), k in zip(g.skip, g.like, strict=True) if y[a] == y[b])
        exact[range(n), y] += math.exp(score)
    exact /= exact.sum(1, keepdims=True)
    assert abs(pii.marginals(g, field) - exact).max() < 0.05


def test_fit_takes_bounded_texts(documents, monkeypatch):
    taken = []
    monkeypatch.setattr(pii, "train", taken.extend)
    pii.fit(documents([(1, "short 1"), (2, "9" * (pii.SAMPLE_BYTES + 1)), (3, None), (4, "")]))
    assert taken == ["short 1"] and pii.train([]) is None
    monkeypatch.undo()
    assert pii.spans(["", "1.2.3.4"], pii.train([]))[1][0]["kind"] == "ip"

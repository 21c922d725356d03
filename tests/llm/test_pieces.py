"""SentencePiece encoding and decoding against the library, on the public model and on small ones written here."""

import random
import struct
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from daybook.llm import pieces

PUBLIC = public_tokenizers.path("piece_bpe_32k.model")
BITS = [
    " ", "  ", "   ", "\n", "\t", "\r", "a", "b", "ab", "abc", "the", "ing", "é", "日", "本", "語", "▁", "<0x0A>", "<s>", "</s>", "<unk>",
    "\0", "😀", "ﬁ", "x" * 30, "‍", "ا", "1", "23", ".", "();\r", "�", "é", " ",
]


def texts(n, seed=1):
    draw = random.Random(seed)
    made = ["".join(draw.choice(BITS) for _ in range(draw.randrange(0, 40))) for _ in range(n)]
    return [*made, "", "z" * 5000, "日本" * 3000, " " * 3000, "word " * 4000]


def _varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(number, value):
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def small_model(path, byte_fallback=True, kinds=(), trims=0, prefix=1):
    """A merge-type model of a few pieces; ``kinds`` are (piece, kind) besides the usual."""
    rows = [("<unk>", 0.0, pieces.UNKNOWN), ("<s>", 0.0, pieces.CONTROL), ("</s>", 0.0, pieces.CONTROL)]
    rows += [(f"<0x{b:02X}>", 0.0, pieces.BYTE) for b in range(256)] if byte_fallback else []
    special = dict(kinds)
    words = ["▁a", "ab", "bc", "abc", "▁ab", "th", "the", "▁the", "in", "ing", "▁▁", "aa", "aaaa", "▁", "a", "b", "c", "t", "h", "e", "i", "n", "g", "x", "1"]
    rows += [(w, -float(i % 9), special.pop(w, pieces.NORMAL)) for i, w in enumerate(words)]
    rows += [(w, 0.0, k) for w, k in special.items()]
    data = b"".join(_field(1, _field(1, w.encode()) + _field(2, s) + _field(3, k)) for w, s, k in rows)
    data += _field(2, _field(3, 2) + _field(4, len(rows)) + _field(35, int(byte_fallback)) + _field(40, 0) + _field(41, 1) + _field(42, 2))
    data += _field(3, _field(1, b"identity") + _field(3, prefix) + _field(4, trims) + _field(5, 1))
    path.write_bytes(data)
    return str(path)


SMALL = {
    "bytes": {},
    "unknown": {"byte_fallback": False},
    "unused": {"kinds": [("abc", pieces.UNUSED), ("ing", pieces.UNUSED), ("ab", pieces.UNUSED)]},
    "own": {"kinds": [("<s1>", pieces.USER_DEFINED), ("bca", pieces.USER_DEFINED), ("bc", pieces.USER_DEFINED)]},
    "trimmed": {"trims": 1},
    "bare": {"prefix": 0},
}


@pytest.mark.parametrize("kind", [None, *SMALL])
def test_ids_and_texts_equal_the_library(kind, tmp_path):
    model = pieces.Model(PUBLIC if kind is None else small_model(tmp_path / "m.model", **SMALL[kind]))
    given = texts(4000) + ([] if kind is None else ["aaaa aa abcabc bca<s1>the  thing", "abc" * 50])
    for end in (True, False):
        ids, offsets = model.encode(given, end)
        theirs = model.library.encode(given, add_eos=end)
        for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            assert ids[a:b].tolist() == theirs[k], given[k][:80]
        again, _ = model.encode(given[::-1], end)  # from the memo
        assert again.tolist() == [k for x in theirs[::-1] for k in x]
        assert model.decode(ids, offsets) == model.library.decode(theirs)


@pytest.mark.parametrize("kind", [None, *SMALL])
def test_any_ids_decode_as_the_library_does(kind, tmp_path):
    model = pieces.Model(PUBLIC if kind is None else small_model(tmp_path / "m.model", **SMALL[kind]))
    draw, n = random.Random(2), len(model.text)
    pick = lambda: draw.choice([draw.randrange(n), draw.randrange(min(n, 259)), draw.randrange(3), model.own["▁"], model.own["▁▁"]])
    lists = [[pick() for _ in range(draw.randrange(0, 12))] for _ in range(15_000)]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    assert model.decode(np.array([k for x in lists for k in x], np.int32), offsets) == model.library.decode(lists)


def test_an_unknown_id_and_another_type_are_refused(tmp_path):
    model = pieces.Model(PUBLIC)
    for bad in (-1, len(model.text)):
        with pytest.raises(IndexError):
            model.decode(np.array([bad], np.int32), np.array([0, 1]))
    other = tmp_path / "unigram.model"
    other.write_bytes(_field(1, _field(1, b"<unk>") + _field(3, pieces.UNKNOWN)) + _field(2, _field(3, 1)))
    with pytest.raises(ValueError, match="merge-type"):
        pieces.Model(str(other))


def test_operator_edges_and_round_trip(documents):
    given = texts(300, seed=4)
    rows = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, " naïve  日本 \n"), (4, "lorem ipsum " * 50_000), *((10 + i, t) for i, t in enumerate(given))]
    encoded = pieces.encode(documents(rows), PUBLIC)
    got = pieces.decode(encoded, PUBLIC).selectExpr("row.doc_id", "row.ids", "row.row", "ids AS out", "decoded").collect()
    assert len(got) == len(rows) and all(r.ids == "x" and r.row == "r" for r in got)
    by = {r.doc_id: (r.out, r.decoded) for r in got}
    library = pieces.Model(PUBLIC).library
    assert by[1] == by[2] == ([library.eos_id()], "")
    for i, t in rows:
        assert by[i] == (library.encode(t or "", add_eos=True), (t or "").replace("▁", " "))
    assert pieces.encode(documents([]), PUBLIC).count() == 0
    assert pieces.decode(encoded.selectExpr("row", "CAST(NULL AS array<int>) AS ids").limit(2), PUBLIC).collect()[0].decoded == ""


def test_short_agendas_equal_the_heap():
    model = pieces.Model(PUBLIC)
    spans = list(dict.fromkeys(s for t in texts(2000, seed=9) for s in model._spans(t) if 0 < len(s) <= 32))
    flat, size = model.short_agendas(spans, 32)
    assert [x.tolist() for x in np.split(flat, np.cumsum(size)[:-1])] == [model.agenda(s) for s in spans]


def test_a_difference_from_the_library_is_an_error():
    batch = pa.RecordBatch.from_pydict({"row": [{"doc_id": 1}], "text": ["of the thing"]})
    for check in ("", pieces.SPANS, pieces.TEXTS):
        model = pieces.Model(PUBLIC)
        model.pair_whole[model.pair_whole == model.own["▁the"]] = model.own["▁a"]
        run = lambda: list(pieces._encoding(SimpleNamespace(value=model), True, check)([batch]))  # noqa: B023, E731
        if check:
            with pytest.raises(AssertionError, match="differ from the library"):
                run()
        else:
            assert run()[0].num_rows == 1


def test_spans_can_only_be_checked_where_they_are_texts(tmp_path):
    model = pieces.Model(small_model(tmp_path / "m.model", prefix=0))
    with pytest.raises(ValueError, match="whole texts"):
        model.encode(["the thing"], True, pieces.SPANS)

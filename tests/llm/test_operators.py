"""Each operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, and against brute force."""

import base64
import hashlib
import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from daybook.llm import bpe, decontamination, language, licenses, ngram_join, pii, quality, sharding, token_counts, warc

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "s", "ic", "al"]) for _ in range(n))


LONG = prose(1, 30_000)
EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "x"), (5, "naïve 日本語 don't  stop\n\n 12'S"), (6, LONG), (7, prose(2, 80)), (7, prose(2, 80)), (None, prose(3, 60))]


def test_jaccard_edges(documents):
    rows = [*EDGES, (8, prose(2, 80)), (9, prose(2, 79)), (10, "a b"), (11, "A b")]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(documents(rows)).collect()}
    roots = {i: c for i, _, c in got}
    assert {roots[i] for i in (7, 8, 9)} == {7} and {roots[i] for i in (10, 11)} == {10}
    assert [roots[i] for i in (1, 2, 3, 4)] == [1, 2, 3, 4] and roots[None] is None
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4)} <= got
    assert ngram_join.jaccard_classes(documents([])).count() == 0


def test_token_counts_equal_the_library(documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [*EDGES, (12, "a<|endoftext|>b  'll 'x  \n"), (13, "z" * 3000)]
    got = token_counts.token_counts(documents(rows), public_tokenizers.path("byte_bpe_50k.json")).select("row.text", "n_tokens").collect()
    assert len(got) == len(rows)
    assert all(r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False).ids) for r in got)
    assert token_counts.token_counts(documents([]), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_bpe_equals_the_library_and_returns(documents):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [*EDGES, (12, "z" * 3000), (13, "<|endoftext|>")]
    encoded = bpe.encode(documents(rows), path, public_tokenizers.PATTERN)
    got = bpe.decode(encoded, path, public_tokenizers.PATTERN).select("row.text", "ids", "decoded").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode(documents([]), path, public_tokenizers.PATTERN).count() == 0


def test_bpe_takes_a_large_batch_in_small_groups():
    coder = SimpleNamespace(value=bpe.Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))
    texts = [prose(i % 3, 400) for i in range(1500)]
    batch = pa.RecordBatch.from_pylist([{"row": {"doc_id": i}, "text": t} for i, t in enumerate(texts)])
    encoded = pa.Table.from_batches(bpe._encoding(coder)([batch])).combine_chunks().to_batches()
    for run, given in ((bpe._encoding(coder), [batch]), (bpe._decoding(coder), encoded)):
        tracemalloc.start()
        rows = sum(b.num_rows for b in run(given))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == len(texts) and most < 16_000_000
    decoded = [t for b in bpe._decoding(coder)(encoded) for t in b.column("decoded").to_pylist()]
    assert decoded == [t.encode() for t in texts]


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_perfect_hash_is_minimal(n):
    table = bpe.PerfectHash(keys := [b"k%d" % i for i in range(n)])
    assert sorted(k for k in table.slot_key.tolist() if k >= 0) == list(range(len(keys)))


def test_quality_edges(documents):
    rows = [*EDGES, (20, "spam spam spam " * 40), (21, prose(4, 200))]
    got = {r.doc_id: r for r in quality.quality_rules(documents(rows)).select("row.doc_id", "n_words", "base_failed", "kept").collect()}
    assert got[1].n_words == got[2].n_words == got[3].n_words == 0 and not got[1].kept
    assert got[20].base_failed and got[21].kept and got[6].n_words == 30_000
    assert quality.quality_rules(documents([])).count() == 0


def test_shards_are_whole_and_near_equal(documents):
    rows = [*EDGES[:5], *((i, "same text") for i in range(100, 400)), *((i, prose(i, 30)) for i in range(400, 1000)), (1, None)]
    got = sharding.histogram_sort(documents(rows), 8).select("row.doc_id", "row.text", "size", "shard", "slot").collect()
    assert len(got) == len(rows) and all(r.size == 16 + len((r.text or "").encode()) for r in got)
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 4 * max(r.size for r in got)
    assert sharding.histogram_sort(documents([]), 8).count() == 0


def test_licenses(documents):
    rows = [
        *EDGES, (30, "Licensed under the MIT License, cc-by-nc CC BY NC!"), (31, "under the the mit license"),
        (32, "released under the terms of the GNU General Public License version 3.0"), (33, "Apache License, Version 2.0. " * 500), (34, "unlimited summit"),
    ]
    got = {r.doc_id: r for r in licenses.detect_licenses(documents(rows)).select("row.doc_id", "n_words", "base", "detections", "labels", "score").collect()}
    assert [(b.label, b.word) for b in got[30].base] == [("mit", 1), ("cc-by-nc", 5), ("cc-by-nc", 8)]
    assert got[31].base == [] or [b.word for b in got[31].base] == []
    assert got[32].labels == ["gpl-3.0"] and got[32].score == 0.85 and len(got[32].detections) == 1
    assert len(got[33].base) == 500 and got[33].base[1].word == 5 and "apache-2" in got[33].labels
    assert got[34].labels == [] and got[34].score == 0 and got[1].n_words == got[3].n_words == 0
    assert len(licenses.rules()) > 200 and licenses.detect_licenses(documents([])).count() == 0


def test_language(documents):
    texts = [(i, prose(i, 40) if i % 2 else " ".join("über straße mädchen schön grün weiß".split()[(i * j) % 6] for j in range(40))) for i in range(200)]
    model = language.train([t for _, t in texts], ["en" if i % 2 else "de" for i, _ in texts])
    got = language.predict(documents([*EDGES, (50, "123 !"), *((1000 + i, t) for i, t in texts)]), model).select("row.doc_id", "row.text", "lang_pred", "score").collect()
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3, 50))
    assert np.mean([r.lang_pred == ("en" if r.doc_id % 2 else "de") for r in got if r.doc_id is not None and r.doc_id >= 1000]) > 0.95
    assert {r.lang_pred for r in language.predict(documents(EDGES), language.train([], [])).collect()} == {"und"}


def test_warc_round_trip(spark, tmp_path):
    body = "<p>" + prose(5, 60)
    pages = [(3, "http://a/ b\r\n", body), (1, None, body), (2, "u", body), (4, "u", None), (5, "u", "tiny"), (6, "u", "tiny"), (None, "u", body), (7, "u", LONG + "ü\r\n\r\n")]
    table = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, payload string")
    got = {r.page_id: r for r in warc.read_archives(spark, warc.write_archives(table, str(tmp_path / "w"))).collect()}
    assert len(got) == len(pages)
    for i, _, html in pages:
        raw = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert got[i].record_type == "revisit" or bytes(got[i].payload) == raw
    assert [got[i].refers_to for i in (1, 2, 3, None, 4, 5, 6, 7)] == [None, 1, 1, 1, None, None, None, None]
    assert warc.read_archives(spark, warc.write_archives(table.limit(0), str(tmp_path / "e"))).count() == 0


def test_pii(documents):
    text = "Call +1 (743) 555-3824 or 1 743 555 3824; mail a.b@x.org, a.b (at) x.org from 10.0.0.1 not 10.0.0.256 card 4111 1111 1111 1111 order 4111111111111112"
    field = pii.train([text] * 3)
    got = {r.doc_id: r for r in pii.find_pii(documents([*EDGES, (60, text), (61, "@" * 5000 + "9" * 5000)]), field, with_text=True).select("row.doc_id", "spans", "redacted").collect()}
    base = [(s.kind, text[s.start : s.end]) for s in got[60].spans if s.base]
    assert base == [("phone", "+1 (743) 555-3824"), ("email", "a.b@x.org"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111")]
    assert ("phone", "1 743 555 3824") in [(s.kind, text[s.start : s.end]) for s in got[60].spans if not s.base]
    assert "555" not in got[60].redacted and "4111111111111112" in got[60].redacted
    assert got[1].spans == [] and got[1].redacted is None and got[2].redacted == "" and got[6].redacted == LONG
    assert pii.find_pii(documents([]), pii.fit(documents([]))).count() == 0


def test_pii_of_many_repeats(spark, documents):
    field = pii.train(["Call +1 743 555 3824 or 1 743 555 3824; mail a.b@x.org, a.b (at) x.org"] * 3)
    text = "+1 743 555 3824 a.b@x.org" + " and 1 743 555 3824 or" * 100 + " a.b (at) x.org ." * 100
    found = pii.spans([text, "1 743 555 3824 " * 100], field)
    assert sum(s["kind"] == "phone" for s in found[0]) == 101 and sum(s["kind"] == "email" for s in found[0]) == 101 and found[1] == []


def test_pii_sample_counts_copies_once(documents, monkeypatch):
    taken = []
    monkeypatch.setattr(pii, "train", taken.extend)
    pii.fit(documents([(i, "same 1") for i in range(100)] + [(200 + i, f"text {i}") for i in range(5)]), 6)
    assert sorted(taken) == ["same 1", *(f"text {i}" for i in range(5))]


def test_language_sample_has_every_language(spark, monkeypatch):
    rows = [(f"same {c}", "en") for c in "abc" for _ in range(100)] + [(f"word{chr(97 + i)}", "de") for i in range(26)] + [("rare", "fi"), ("1", "sv"), ("x", None)]
    taken = []
    monkeypatch.setattr(language, "train", lambda texts, langs: taken.extend(zip(langs, texts, strict=True)))
    language.fit(spark.createDataFrame(rows, "text string, lang string"), 10)
    assert len(taken) == len(set(taken)) <= 10 and {x for x, _ in taken} == {"en", "de", "fi"}
    monkeypatch.undo()
    for seed in range(5):
        model = language.train(["xyzzy plugh"] + [f"one {prose(i, 9)}" for i in range(30)], ["fi"] + ["en"] * 30, seed)
        assert model.languages[int(model.logits([" xyzzy plugh "]).argmax())] == "fi"


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the GPL", ["gpl"]), ("released under the GPL v3", ["gpl-3.0"]), ("distributed under GNU LGPL version 2 or later", ["lgpl-2.0"]),
    ("It is GPLv2.", ["gpl-2.0"]), ("LGPLv2.1", ["lgpl-2.1"]), ("SPDX-License-Identifier: MPL", ["mpl"]), ("licensed under Apache 2", ["apache-2.0"]), ("licensed under the gpl 2.5", ["gpl"]),
])
def test_license_versions(documents, text, labels):
    assert licenses.detect_licenses(documents([(1, text)])).first().labels == labels


def test_decontamination(spark, documents):
    item = prose(70, 30) + ". " + prose(71, 8) + "."
    benchmark = spark.createDataFrame([(0, item), (1, None), (2, ""), (3, prose(72, 40))], "item_id long, text string")
    words = item.split()
    near = " ".join(w for i, w in enumerate(words) if i % 9)
    rows = [*EDGES, *((i, prose(i, 150)) for i in range(100, 140)), (80, prose(81, 200) + " " + item.upper() + " " + prose(82, 200)), (83, near)]
    found = decontamination.find_benchmark(documents(rows), benchmark).select("row.doc_id", "hits").collect()
    hits = {r.doc_id: [h.item_id for h in r.hits] for r in found if r.hits}
    assert len(found) == len(rows) and hits == {80: [0], 83: [0]}
    assert decontamination.find_benchmark(documents([]), benchmark).count() == 0
    assert decontamination.find_benchmark(documents(EDGES), benchmark.limit(0)).where("size(hits) > 0").count() == 0


def test_decontamination_of_a_hot_item(spark, documents):
    items = [" ".join(f"q{i}w{j}" for j in range(40)) + "." for i in range(4)]
    items += ["it is what it is and that is all that it is to us", "so be it now"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    filler = lambda i: " ".join(f"f{i}x{j}" for j in range(60)) + " it is so that be now to us what and all"
    rows = [(i, f"{filler(i)} {items[0] if i % 3 == 0 else ''} {filler(i + 1000)}") for i in range(150)]
    near = " ".join(w for j, w in enumerate(items[0].split()) if j % 5)
    rows += [(200 + i, f"{filler(200 + i)} {t} {filler(1200 + i)}") for i, t in enumerate([*items[1:], near])]
    found = decontamination.find_benchmark(documents(rows), benchmark).select("row.doc_id", "hits").collect()
    hits = {r.doc_id: [h.item_id for h in r.hits] for r in found}
    assert all((0 in hits[i]) == (i % 3 == 0) for i in range(150))
    assert all(1 + i in hits[200 + i] for i in range(5)) and 0 in hits[205]


def test_subsequence_by_table():
    draw = np.random.default_rng(1)
    for _ in range(50):
        a, b = draw.integers(0, 6, 20), draw.integers(0, 6, 30)
        table = np.zeros((21, 31), int)
        for i in range(20):
            for j in range(30):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert decontamination.common_subsequence(decontamination.positions(a), 20, b.tolist()) == table[-1, -1]

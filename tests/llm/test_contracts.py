"""The registered corpus queries over whole tables against plain Python."""

import base64
import os
import re
import sys
import zlib

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import corpus_pipeline  # noqa: E402
from daybook.llm import pii, queries  # noqa: E402
from daybook.llm.oracle import ORACLES  # noqa: E402
from oracle_compare import digest, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def rows(name, *columns):
    return pq.read_table(f"{SF}/{name}.parquet", columns=list(columns)).to_pylist()


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_duckdb(spark, name):
    df = queries.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = duck(SF).execute(ORACLES[name])
    names, expected = [c[0] for c in cur.description], cur.fetchall()
    assert sorted(df.columns) == sorted(names) and digest(df.columns, got) == digest(names, expected)


def test_sharding(spark):
    got = queries.op6_sharding(spark, SF).collect()
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in rows("documents", "doc_id", "text")}
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all((r.size, r.text_crc32) == (len(docs[r.doc_id]) + 16, zlib.crc32(docs[r.doc_id])) for r in got)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None} and {r.shard for r in got} <= set(range(40))
    for s in range(40):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    total, most = sum(r.size for r in got), max(r.size for r in got)
    for s in range(40):  # a boundary lies no further from its place than the row that it would cut
        assert abs(sum(r.size for r in got if r.shard <= s) - total * (s + 1) / 40) <= most + total / 40


def test_license_base_columns(spark):
    got = {r.doc_id: r for r in queries.op7_license_scans(spark, SF).collect()}
    docs = rows("documents", "doc_id", "text")
    assert len(got) == len(docs)
    for d in docs:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(d["text"]))
        hits = [(i, label) for label, phrase in PHRASES.items() for i in range(len(words)) if words[i : i + len(p := phrase.split())] == p]
        r = got[d["doc_id"]]
        assert (r.n_words, r.n_base) == (len(words), len(hits))
        assert (r.first_word, r.last_word) == ((min(hits)[0], max(hits)[0]) if hits else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in hits}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_language(spark):
    docs = {r["doc_id"]: r for r in rows("documents", "doc_id", "text", "lang")}
    got = queries.op8_language_id(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") >= (not any(c.isalpha() for c in docs[r.doc_id]["text"] or ""))
    known = [r for r in got if r.held_out and docs[r.doc_id]["lang"] and r.lang_pred != "und"]
    assert sum(r.lang_pred == docs[r.doc_id]["lang"] for r in known) >= 0.95 * len(known)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def runs(text, n=8):
    words = re.findall(r"\w+", lower(text))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def test_pipeline_by_brute_force(spark):
    """Each stage done again in plain Python on what the stage before it kept."""
    docs = {r["doc_id"]: r for r in rows("documents", "doc_id", "text", "lang", "source", "n_chars")}
    con = duck(SF)
    kept = {i for i, k in con.execute(f"SELECT doc_id, kept FROM ({ORACLES['op10_quality_rules']})").fetchall() if k}

    sets, root = {i: shingles(docs[i]["text"]) for i in sorted(kept)}, {i: i for i in kept}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(kept)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    single = {i for i in ids if find(i) == i}

    items = [runs(r["text"]) for r in rows("benchmark", "text")]
    clean = {i for i in single if not any(runs(docs[i]["text"]) & item for item in items)}

    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == clean
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    marks = re.compile(r"\[(?:EMAIL|IP|CARD|PHONE)\]")
    for i, r in got.items():
        text = docs[i]["text"]
        assert (r.lang, r.source, r.n_chars) == (docs[i]["lang"], docs[i]["source"], len(r.text))
        assert r.ids == library.encode_ordinary(r.text) and r.n_tokens == len(r.ids)
        assert not pii.base_spans(r.text)
        parts = marks.split(r.text)  # what is between the marks stood in the text, in this order
        assert re.fullmatch("(?s:.+)".join(map(re.escape, parts)), text)
        assert len(parts) > 1 or not pii.base_spans(text)

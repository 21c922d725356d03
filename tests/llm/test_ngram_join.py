"""What verification exchanges: texts that candidate pairs name, bitmaps of bounded size, and a row for each member of open lists."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm import ngram_join


@pytest.fixture
def docs(spark):
    texts = [(None if i % 500 == 0 else i, f"text {i} of some words") for i in range(3000)]
    rows = spark.createDataFrame([*texts, (7, None), (7, "")], "doc_id long, text string")
    return rows.withColumn("text_hash", F.xxhash64("text"))


def test_texts_that_no_pair_names_stay_where_they_are(docs):
    named = docs.where("doc_id IN (3, 4, 2999) OR doc_id IS NULL").select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
    wanted = {tuple(r) for r in named.collect()}
    got = [(r.doc_id, r.text_hash, r.text) for r in ngram_join._marked(docs, named).collect()]
    assert len(wanted) == 9 and wanted <= {(i, h) for i, h, _ in got}
    assert len(got) <= 15  # 2**24 places: hardly any other row shares one
    assert {(t, i) for i, _, t in got if (i, t) in {(3, "text 3 of some words"), (4, "text 4 of some words")}} == {
        ("text 3 of some words", 3), ("text 4 of some words", 4),
    }


def test_every_wanted_row_is_marked_and_none_of_an_empty_table(docs):
    all_rows = docs.selectExpr("doc_id AS d", "text_hash AS h")
    assert ngram_join._marked(docs, all_rows.distinct()).count() == docs.count()
    assert ngram_join._marked(docs, all_rows.where("false")).count() == 0


@pytest.mark.parametrize("n", [1, 33, 64, 200, 1000, 5000])
def test_bitmaps_have_two_bits_a_shingle_at_most(n):
    shingles = np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64)
    assert len(ngram_join.parity(shingles)) * 8 <= max(64, 2 * n)


def _open_list(sets, roots):
    """Rows of one open list, all of them probed and indexed and none of its largest component."""
    n, zero = len(sets), pa.array([0] * len(sets), pa.int32())
    columns = {
        "key": pa.array([5] * n), "ta": zero, "tb": zero, "node": pa.array(range(n), pa.int64()), "root": pa.array(roots, pa.int64()),
        "size": pa.array([len(x) for x in sets]), "role": pa.array([3] * n, pa.int32()), "big": pa.array([False] * n),
        "bitmap": pa.array([ngram_join.parity(x) for x in sets], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _near_sets(n, seed):
    """Sets of 100 shingles that share 90 or so, in three families."""
    draw = np.random.default_rng(seed)
    bases = draw.integers(0, 1 << 63, (3, 100)).astype(np.uint64)
    sets = []
    for i in range(n):
        x = bases[i % 3].copy()
        x[draw.choice(100, 6, replace=False)] = draw.integers(0, 1 << 63, 6).astype(np.uint64)
        sets.append(np.unique(x))
    return sets


def test_a_list_of_near_sets_gives_a_row_for_each_member_not_for_each_pair():
    sets = [*_near_sets(300, 1), *(np.random.default_rng(i).integers(0, 1 << 63, 100).astype(np.uint64) for i in range(2, 5))]
    rows = pa.Table.from_batches(list(ngram_join._candidate_groups(80)([_open_list(sets, range(len(sets)))])))
    assert rows.num_rows == 300 and len(set(rows["node"].to_pylist())) == 300
    by_group = {}
    for group, node in zip(rows["group"].to_pylist(), rows["node"].to_pylist(), strict=True):
        by_group.setdefault(group, set()).add(node)
    assert sorted(map(min, by_group.values())) == [0, 1, 2] and all({i % 3 for i in v} == {min(v)} for v in by_group.values())


def test_members_of_one_component_are_no_candidates():
    assert sum(b.num_rows for b in ngram_join._candidate_groups(80)([_open_list(_near_sets(30, 1), [i % 3 for i in range(30)])])) == 0


@pytest.mark.parametrize("seed", range(6))
def test_links_of_a_group_join_what_all_its_links_join(seed):
    draw, sets = random.Random(seed), _near_sets(40, seed)
    own = [draw.choice([i, i % 3 + 100 * (i % 7)]) for i in range(len(sets))]
    everything = [(own[i], own[j]) for i in range(40) for j in range(i) if ngram_join._linked(sets[i], sets[j], 85)]

    def classes(links):
        root = {i: i for i in own}
        for _ in own:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        return root

    links = ngram_join._joining(sets, np.array(own), 85)
    assert set(links) <= {(a, b) for x, y in everything for a, b in ((x, y), (y, x))} and len(links) < len(set(own))
    assert classes(links) == classes(everything)


def test_open_lists_in_many_tiles_have_the_components_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 4)
    draw = random.Random(3)
    rows = []
    for i in range(120):  # neighbours in a chain link, its ends don't
        base = random.Random(i // 40)
        words = [f"w{base.randrange(10**6)}" for _ in range(60 + 40 * 6)]
        text = words[(i % 40) * 6 // 4 : (i % 40) * 6 // 4 + 60]
        text[draw.randrange(60)] = "other"
        rows.append((i, " ".join(text)))
    sets = list(ngram_join.shingle_sets(pa.array([t for _, t in rows]), 2))
    root = list(range(120))
    for _ in rows:
        for i in range(120):
            for j in range(max(0, i - 40), i):
                if root[i] != root[j] and ngram_join._linked(sets[i], sets[j], 80):
                    root[i] = root[j] = min(root[i], root[j])
        if (now := [root[root[i]] for i in range(120)]) == root:
            break
        root = now
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()}
    assert [got[i] for i in range(120)] == root

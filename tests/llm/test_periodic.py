"""Periodic runs against a brute force over all lags, and the edges of the operator."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from daybook.llm import periodic, queries


def brute_runs(words):
    """Every maximal stretch of every lag, its smallest period tried out."""
    n, runs = len(words), []
    for q in range(1, n // 3 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(24, 3 * q) and not any(all(words[x] == words[x - p] for x in range(start + p, start + length)) for p in range(1, q)):
                runs.append((start, length, q))
            i = j + 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def planted(draw):
    n, kinds = draw.randrange(0, 200), draw.choice([1, 2, 2, 3, 5, 20])
    words = [f"w{draw.randrange(kinds)}" for _ in range(n)]
    for _ in range(draw.randrange(4)):
        if n > 30:
            a, p = draw.randrange(n), draw.randrange(1, 30)
            for i in range(a, min(n, a + draw.randrange(10, 150))):
                words[i] = words[a + (i - a) % p]
    if words and draw.random() < 0.3:
        words[draw.randrange(n)] = "odd"
    return words


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_equal_brute_force():
    draw, found = random.Random(11), 0
    for _ in range(1500):
        words = planted(draw)
        numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
        got = periodic.diagonal_runs(np.array([numbers[w] for w in words], np.int64))
        assert got == brute_runs(words)
        found += len(got)
    assert found > 400


def test_a_nested_period_and_a_long_one():
    inner = ["a", "b"] * 15 + ["c"]
    words = ["x", *(inner * 4), "y"]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    got = periodic.diagonal_runs(np.array([numbers[w] for w in words]))
    assert got == brute_runs(words) and (1, 124, 31) in got and {r[2] for r in got} == {2, 31}
    wide = np.concatenate([np.arange(50_000)] * 3 + [np.zeros(30, np.int64)])
    assert periodic.diagonal_runs(wide)[:1] == [(0, 150_001, 50_000)]  # the zeros go on with the first word


def test_a_long_text_of_one_word_stays_cheap():
    assert periodic.diagonal_runs(np.zeros(400_000, np.int64)) == [(0, 400_000, 1)]


def test_operator_edges(documents):
    draw = random.Random(3)
    many = [planted(draw) for _ in range(300)]
    white = ["\t", " ", "\n\n", " \r ", "\x0b"]
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "x"), (5, "spam " * 23), (6, " spam\n" * 24), (7, "A a " * 12), (7, "A a " * 12), (None, "ü 日本 " * 40),
        (8, "la " * 200_000), (9, "a\x00b\u00a0c " * 30),
        *((100 + i, "".join(w + draw.choice(white) for w in words)) for i, words in enumerate(many)),
    ]
    found = periodic.periodic_runs(documents(rows))
    assert found.columns == ["row", "n_words", "runs", "collapsed"] and "text" not in found.schema["row"].dataType.names
    got = found.selectExpr("row.doc_id", "row.hits", "n_words", "runs", "collapsed").collect()
    assert len(got) == len(rows) and all(r.hits == "h" for r in got)
    by = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got}
    assert by[1] == by[2] == by[3] == (0, [], "") and by[4] == (1, [], "x")
    assert by[5][1] == [] and by[6] == (24, [(0, 24, 1)], "spam")
    assert by[7] == (24, [(0, 24, 2)], "A a") and sum(r.doc_id == 7 for r in got) == 2
    assert by[None] == (80, [(0, 80, 2)], "ü 日本") and by[8] == (200_000, [(0, 200_000, 1)], "la") and by[9] == (30, [(0, 30, 1)], "a\x00b\u00a0c")
    for i, words in enumerate(many):
        runs = brute_runs(words)
        assert by[100 + i] == (len(words), runs, collapsed(words, runs))
    assert periodic.periodic_runs(documents([])).count() == 0


def op13_row(doc_id, text):
    """The query's row of one document in plain Python."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 == 0 and n > 0:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    start, length, q = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return doc_id, len(runs), start, length, q, length and 1000 * length // q, sha(listed), sha(collapsed(words, runs))


def test_query_takes_texts_without_words(spark, tmp_path):
    draw = random.Random(5)
    texts = ["", " ", "\n\t \x0b\x0c\r", None, "x", "one two", " spam" * 30, *("  ".join(planted(draw)) for _ in range(3))]
    data = [(i, t) for i, t in enumerate(texts * 30)] + [(None, ""), (None, None), (None, "la " * 24), (7, ""), (7, "")]
    changed = {t for i, t in data if i is not None and zlib.crc32(str(i).encode()) % 10 == 0}
    assert changed == set(texts)
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted((op13_row(*r) for r in data), key=repr)

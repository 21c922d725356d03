"""Adaptive fences by brute force, and verdicts that don't jump when a group passes a size."""

from collections import Counter

from pyspark.sql import functions as F

from daybook.llm import quality

W = quality.PRIOR_TEXTS


def bucket(x):
    return x if x < 64 else x - x % (1 << (x.bit_length() - 6))


def share(counts, b):
    return sum(n for x, n in counts.items() if x <= b) / sum(counts.values())


def brute(rows):
    """{(lang, source): (low, high)} of word_length."""
    every = Counter(bucket(x) for *_, x in rows)
    out = {}
    for lang, source in {(a, b) for a, b, _ in rows}:
        mine = Counter(bucket(x) for a, b, x in rows if (a, b) == (lang, source))
        tongue = Counter(bucket(x) for a, _, x in rows if a == lang)
        blend = {}
        for b in sorted(every):
            above = (share(tongue, b) * sum(tongue.values()) + W * share(every, b)) / (sum(tongue.values()) + W)
            blend[b] = (share(mine, b) * sum(mine.values()) + W * above) / (sum(mine.values()) + W)
        q1, q3 = (min(b for b in blend if blend[b] >= q - 1e-12) for q in (0.25, 0.75))
        beyond = max(quality.RANGES * (q3 - q1), quality.MARGINS["word_length"])
        out[lang, source] = (q1 - beyond, q3 + beyond)
    return out


def fences(spark, rows):
    table = spark.createDataFrame(rows, "lang string, source string, x long")
    sketch = table.withColumn("bucket", F.expr(quality.bucket("x"))).groupBy("lang", "source", "bucket").agg(F.count("*").alias("n"))
    got = quality.fences(sketch.withColumn("ratio", F.lit("word_length"))).collect()
    return {(r.lang, r.source): (r.low_word_length, r.high_word_length) for r in got}


def test_fences_by_brute_force(spark):
    rows = [("en", "a", 400 + 7 * i) for i in range(90)] + [("en", None, 3000 + i) for i in range(11)] + [(None, "a", 40 + i) for i in range(30)] + [("fi", "b", 9000)]
    assert fences(spark, rows) == brute(rows)
    assert fences(spark, rows[:0]) == {}


def test_fences_move_smoothly(spark):
    """Around the prior's weight one more text moves a fence by no more than a bucket or two."""
    rest = [("en", "a", 400 + i % 50) for i in range(2000)]
    sizes = [fences(spark, rest + [("en", "b", 1500 + i % 400) for i in range(n)])["en", "b"][1] for n in (1, W - 1, W, W + 1, 20 * W)]
    alone = fences(spark, [("en", "b", 1500 + i % 400) for i in range(20 * W)])["en", "b"][1]
    assert sizes[0] < 1000 and abs(sizes[4] - alone) <= (quality.RANGES + 1) * 64
    assert max(abs(sizes[2] - sizes[1]), abs(sizes[3] - sizes[2])) <= (quality.RANGES + 1) * 64


def test_a_text_beyond_its_fence_goes(spark):
    words = lambda n, size: " ".join(f"{i:0{size}d}" for i in range(n))
    rows = [("x", "s", words(100, 4 + i % 3)) for i in range(60)] + [("x", "s", words(100, 90)), ("x", "s", None), ("x", "s", "")]
    got = quality.quality_rules(spark.createDataFrame(rows, "lang string, source string, text string")).collect()
    assert sorted((r.kept, r.base_failed, r.word_chars) for r in got if not r.kept) == [(False, False, 9000), (False, True, 0), (False, True, 0)]

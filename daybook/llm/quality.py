"""Quality rules with thresholds that adapt to each language and source.

Every text is measured whole.  A few ratios of the measures go into mergeable
quantile sketches, one per (lang, source): counts per bucket, where a bucket
holds the integers that agree in their six leading bits, so that any quantile
is off by at most one part in 32 and sketches merge by adding counts, in any
order, with the same result.  Upper and lower fences follow from each sketch's
quartiles.  A sketch is read together with that of its parent, which weighs
as PRIOR_TEXTS texts at every size: a (lang, source) of few texts stays close
to its language, a language of few texts close to all texts, and both move
away smoothly as texts are added.  The fences, one row per (lang, source), are
joined back and decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.arrow import text_column, with_text
from daybook.llm.words import U64, Hasher, blocks, gram_hashes, mix, scan_words, string_buffers
from daybook.sources.store import materialize

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
#: Ratios that are judged, as integers; texts without words have none.
RATIOS = {
    "symbols": "n_symbols * 1000 DIV n_words",
    "dup_lines": "n_dup_lines * 1000 DIV n_lines",
    "repeats": "n_repeat_words * 1000 DIV n_words",
    "word_length": "word_chars * 100 DIV n_words",
}
#: A fence lies this many interquartile ranges beyond the quartile, and at least the ratio's margin.
RANGES = 4
MARGINS = {"symbols": 400, "dup_lines": 300, "repeats": 250, "word_length": 400}
#: Only word_length has a lower fence.
LOWER = ("word_length",)
#: Texts that the parent of a sketch counts for.
PRIOR_TEXTS = 200

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return np.diff(total[offsets])


def measure(col: pa.Array) -> dict[str, np.ndarray]:
    """The MEASURES of each text of a column."""
    out: dict[str, list[np.ndarray]] = {m: [] for m in MEASURES}
    data, offsets = string_buffers(col)
    with np.errstate(over="ignore"):
        for i, j, raw, off in blocks(data, offsets):
            n = j - i
            hasher = Hasher(raw)
            words = scan_words(raw, off, hasher=hasher)
            solid = np.zeros(len(raw) + 1, np.int8)
            np.add.at(solid, words.start, 1)
            np.add.at(solid, words.end, -1)
            out["n_words"].append(np.diff(words.first))
            out["word_chars"].append(_per_text(np.cumsum(solid[:-1]).astype(bool) & ((raw & 0xC0) != 0x80), off))
            out["n_symbols"].append(_per_text(_SYMBOL[raw], off))

            breaks = np.flatnonzero(raw == 10)
            start = np.unique(np.concatenate([off[:-1][off[:-1] < off[1:]], breaks + 1]))
            start = start[start < len(raw)]
            text = np.searchsorted(off, start, "right") - 1
            to = np.concatenate([start[1:], [len(raw)]])
            end = np.where((to > start) & (raw[np.maximum(to, 1) - 1] == 10), to - 1, to) if len(start) else to[:0]
            full = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
            text, start, end = text[full], start[full], end[full]
            lines = mix(hasher.ranges(start, end) + text.astype(U64) * U64(0xC2B2AE3D27D4EB4F))
            _, once = np.unique(lines, return_index=True)
            count = np.bincount(text, minlength=n)
            out["n_lines"].append(count)
            out["n_dup_lines"].append(count - np.bincount(text[once], minlength=n))

            grams, at = gram_hashes(words, 3)
            key = mix(grams + words.text[at].astype(U64) * U64(0xC2B2AE3D27D4EB4F))
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
            twice = np.zeros(len(key), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            hit = np.zeros(len(words.start), bool)
            for shift in range(3):
                hit[at[twice] + shift] = True
            out["n_repeat_words"].append(np.bincount(words.text[hit], minlength=n))
    return {m: np.concatenate(x) if x else np.zeros(0, np.int64) for m, x in out.items()}


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = measure(text_column(batch))
        arrays = [pa.array(found[m].astype(np.int64)) for m in MEASURES]
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + arrays, kept + MEASURES)


def bucket(x: str) -> str:
    """SQL for the sketch bucket of a non-negative integer: its six leading bits, the rest zero."""
    return f"CASE WHEN {x} < 64 THEN {x} ELSE {x} - {x} % shiftleft(1L, length(bin({x})) - 6) END"


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, ratio, bucket, n): one mergeable sketch per language, source and ratio."""
    ratios = ", ".join(f"'{r}', {e}" for r, e in RATIOS.items())
    long = measured.where("n_words > 0").selectExpr("lang", "source", f"stack({len(RATIOS)}, {ratios}) AS (ratio, x)")
    return long.groupBy("lang", "source", "ratio", F.expr(bucket("x")).alias("bucket")).agg(F.count("*").alias("n"))


def _shares(sketch: DataFrame, by: list[str], parent: DataFrame | None, above: list[str]) -> DataFrame:
    """(by, ratio, bucket, share): the share of texts up to each bucket of the parent, whose own share weighs as PRIOR_TEXTS texts."""
    counts = sketch.groupBy(*by, "ratio", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "ratio")
    if parent is None:
        return counts.select("ratio", "bucket", (F.sum("n").over(group.orderBy("bucket")) / F.sum("n").over(group)).alias("share"))
    groups = counts.groupBy(*by, "ratio").agg(F.sum("n").alias("texts"))
    same = lambda names: " AND ".join(f"a.{c} <=> b.{c}" for c in names)
    points = groups.alias("a").join(parent.alias("b"), F.expr(same([*above, "ratio"]))).selectExpr("a.*", "b.bucket", "b.share")
    points = points.alias("a").join(counts.alias("b"), F.expr(same([*by, "ratio", "bucket"])), "left").selectExpr("a.*", "coalesce(b.n, 0) AS n")
    upto = points.withColumn("upto", F.sum("n").over(group.orderBy("bucket")))
    return upto.select(*by, "ratio", "bucket", F.expr(f"(upto + {PRIOR_TEXTS} * share) / (texts + {PRIOR_TEXTS})").alias("share"))


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, low_<ratio>, high_<ratio>...): one row per (lang, source) of the sketches.

    A group has a row for each bucket in use anywhere (2,000 are the most that
    there can be), whatever the number of its texts.
    """
    everything = _shares(sketch, [], None, [])
    own = _shares(sketch, ["lang", "source"], _shares(sketch, ["lang"], everything, []), ["lang"])
    first = lambda x: F.min(F.when(F.col("share") >= x, F.col("bucket")))
    best = own.groupBy("lang", "source", "ratio").agg(first(0.25).alias("q1"), first(0.75).alias("q3"))
    margin = "CASE ratio " + " ".join(f"WHEN '{r}' THEN {m}" for r, m in MARGINS.items()) + " END"
    best = best.selectExpr("lang", "source", "ratio", f"greatest({RANGES} * (q3 - q1), {margin}) AS beyond", "q1", "q3")
    columns = []
    for r in RATIOS:
        columns.append(F.max(F.expr(f"CASE WHEN ratio = '{r}' THEN q3 + beyond END")).alias(f"high_{r}"))
        if r in LOWER:
            columns.append(F.max(F.expr(f"CASE WHEN ratio = '{r}' THEN q1 - beyond END")).alias(f"low_{r}"))
    return best.groupBy("lang", "source").agg(*columns)


def quality_rules(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Measures and verdict of every row of ``docs`` (columns text, lang, source).

    Returns ``row`` (a struct of the ``carry`` columns, all by default, so
    that no name clashes), the MEASURES, base_failed (fewer than 50 words, or
    more than half the words in repeated 3-word windows) and kept (not
    base_failed, and no ratio beyond its fence).  A null or empty text has
    zero words and fails; null languages and sources are groups of their own;
    a repeated row counts and is judged each time.
    """
    given = with_text(docs, carry, lang=docs["lang"].cast("string"), source=docs["source"].cast("string"))
    schema = f"row {given.schema['row'].dataType.simpleString()}, lang string, source string, " + ", ".join(f"{m} long" for m in MEASURES)
    measured = materialize(given.mapInArrow(_measured, schema), "quality/measured")
    limits = materialize(fences(sketches(measured)), "quality/fences")
    beyond = " OR ".join(
        [f"{e} > high_{r}" for r, e in RATIOS.items()] + [f"{RATIOS[r]} < low_{r}" for r in LOWER]
    )
    a, b = measured.alias("a"), limits.alias("b")
    judged = a.join(b, F.expr("a.lang <=> b.lang AND a.source <=> b.source"), "left").withColumn(
        "base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    )
    judged = judged.withColumn("kept", F.expr(f"NOT base_failed AND NOT CASE WHEN n_words > 0 THEN coalesce({beyond}, false) ELSE false END"))
    return judged.select("row", *MEASURES, "base_failed", "kept")

"""Quality rules whose thresholds come from the data: quantile sketches per language and source.

Each document gives four whole-number measures. A sketch of a measure is its counts
in buckets a thirty-second of a power of two wide, so sketches merge by adding
counts, in any order, to the same result: map-side per task, then per (lang,
source), and those again per language and over all. A group of too few documents
takes its language's thresholds, a small language all documents'.

A threshold is the nearer of two, both read off sketches. The outer quantile of the
group, one bucket further on, so that rounding rejects nothing and a source whose
documents are all alike is left alone: it finds documents that stick out of their
own source. And the break: the widest empty stretch of the sketch among the group's
outer documents, if what lies beyond it is REACH times as far from the quartile as
what lies before it. It finds junk that is more than the quantile leaves out. A
group in which junk is more than the outer documents has no such break; those of its
language and of all documents hold for it too, if the group's own quartile is within.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsetide.llm import words as w
from pulsetide.session import shared_folder, store

LEAST_WORDS = 20
MOST_REPEATED = 30
REPEAT_WINDOW = 8
#: Documents a group needs for thresholds of its own.
LEAST_GROUP = 200
#: Percent of a group's documents on each side among which a break is looked for.
TAIL = 5
#: Times as far from the quartile as what lies before a break that its other side must be.
REACH = 2.0

#: Percent of a group's documents beyond each outer quantile.
OUTER = 1
#: Columns of quantiles, in percent.
PLACES = {"low": 25, "high": 75, "least": OUTER, "most": 100 - OUTER}

#: Whole numbers per mille; word_length has a floor as well.
MEASURES = ("word_length", "symbol_rate", "dup_line_rate", "repeat_rate")
FLOORED = ("word_length",)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_LINE = np.ones(256, bool)
_LINE[10] = False
COUNTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def _per_doc(mask: np.ndarray, texts: w.Texts) -> np.ndarray:
    return w.per_document(mask, texts.offsets)


def _own(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Fingerprints that differ between documents."""
    return w.mix(hashes + w.mix(doc.astype(np.uint64) + np.uint64(1)))


def counts_of(texts: w.Texts) -> list[np.ndarray]:
    """The columns of COUNTS."""
    words = w.words_of(texts)
    hashes = w.word_hashes(words)
    chars = w.SPACED[texts.data] & ((texts.data & 0xC0) != 0x80)
    lines = w.words_of(texts, _LINE)
    solid = np.concatenate(([0], np.cumsum(w.SPACED[texts.data])))
    full = solid[lines.end] > solid[lines.start]
    line_doc = lines.doc()[full]
    keys = _own(w.span_hashes(texts.data, lines.start[full], lines.end[full]), line_doc)
    _, one = np.unique(keys, return_index=True)
    n_lines = np.bincount(line_doc, minlength=len(texts))
    distinct = np.bincount(line_doc[one], minlength=len(texts))
    at = w.window_starts(words.first, REPEAT_WINDOW)
    doc = np.searchsorted(words.first, at, "right") - 1
    _, back, times = np.unique(_own(w.window_hashes(hashes, at, REPEAT_WINDOW), doc), return_inverse=True, return_counts=True)
    repeated = w.covered(len(hashes), at[times[back] > 1], REPEAT_WINDOW)
    return [
        words.counts,
        _per_doc(chars, texts),
        _per_doc(_SYMBOL[texts.data], texts),
        n_lines,
        n_lines - distinct,
        w.per_document(repeated, words.first),
    ]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed and the measures of every row."""
    names = [c.split()[0] for c in COUNTS.split(", ")]
    rows = docs.select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text")
    )
    kept = ["doc_id", "lang", "source"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in kept)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in w.batches(batches):
            new = [pa.array(c, pa.int64()) for c in counts_of(texts)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *new], names=[*kept, *names])

    return rows.mapInArrow(count, f"{fields}, {COUNTS}").selectExpr(
        "*",
        f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed",
        "1000 * word_chars div greatest(n_words, 1) AS word_length",
        "1000 * n_symbols div greatest(n_words, 1) AS symbol_rate",
        "1000 * n_dup_lines div greatest(n_lines, 1) AS dup_line_rate",
        "1000 * n_repeat_words div greatest(n_words, 1) AS repeat_rate",
    )


def width(value: Column) -> Column:
    """Of the value's bucket."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(value)) - 6, F.lit(0)))


def bucket(value: Column) -> Column:
    """The value with all but its six leading binary digits set to zero."""
    drop = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(rows: DataFrame, measures=MEASURES) -> DataFrame:
    """lang, source, measure, bucket, n: the mergeable sketch of each measure and group."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in measures]))
    return rows.select("lang", "source", each.alias("e")).groupBy("lang", "source", "e.measure", "e.bucket").agg(F.count("*").alias("n"))


def quartiles(sketch: DataFrame, by: list[str], reach: float = REACH) -> DataFrame:
    """by, measure, size, low, high, least, most, under, over: documents, quartiles, outer quantiles and breaks of each group, from its merged sketch.

    over is the last value before the upper break, under the first after the lower one; null where there is none.
    """
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    line = group.orderBy("bucket")
    ranked = merged.select(
        *by, "measure", "bucket", (F.sum("n").over(line) - F.col("n")).alias("before"), F.sum("n").over(line).alias("upto"),
        F.sum("n").over(group).alias("size"), F.lag("bucket").over(line).alias("last"), F.lead("bucket").over(line).alias("next"),
    )

    def at(percent: int) -> Column:
        return F.min(F.when(100 * F.col("upto") >= percent * F.col("size"), F.col("bucket")))

    # A stretch goes from the end of one bucket to the start of the next that holds a document.
    end, last_end = F.col("bucket") + width(F.col("bucket")), F.col("last") + width(F.col("last"))
    above = (100 * F.col("upto") >= (100 - TAIL) * F.col("size")) & (F.col("next") > end)
    below = (100 * F.col("before") <= TAIL * F.col("size")) & (F.col("bucket") > last_end)
    found = ranked.groupBy(*by, "measure").agg(
        F.max("size").alias("size"),
        *[at(p).alias(name) for name, p in PLACES.items()],
        F.max(F.when(above, F.struct((F.col("next") - end).alias("gap"), end.alias("near"), F.col("next").alias("far")))).alias("up"),
        F.max(F.when(below, F.struct((F.col("bucket") - last_end).alias("gap"), F.col("bucket").alias("near"), last_end.alias("far")))).alias("down"),
    )
    over = F.col("up.far") - F.col("high") >= reach * (F.col("up.near") - F.col("high"))
    under = F.col("low") - F.col("down.far") >= reach * (F.col("low") - F.col("down.near"))
    return found.withColumns({"over": F.when(over, F.col("up.near") - 1), "under": F.when(under, F.col("down.near"))}).drop("up", "down")


def thresholds(sketch: DataFrame, least_group: int = LEAST_GROUP, reach: float = REACH) -> DataFrame:
    """lang, source, measure, floor, ceiling: of the group, its language or all documents, the first that is large enough."""
    names = [*PLACES, "under", "over"]
    own = quartiles(sketch, ["lang", "source"], reach)
    lang = quartiles(sketch, ["lang"], reach).selectExpr("lang AS l", "measure AS m", "size AS lang_size", *[f"{c} AS lang_{c}" for c in names])
    whole = quartiles(sketch, [], reach).selectExpr("measure AS w", *[f"{c} AS all_{c}" for c in names])
    rows = own.join(lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("measure") == F.col("m"))).join(whole, F.col("measure") == F.col("w"))
    large, lang_large = F.col("size") >= least_group, F.col("lang_size") >= least_group

    def chosen(name: str) -> Column:
        return F.when(large, F.col(name)).when(lang_large, F.col(f"lang_{name}")).otherwise(F.col(f"all_{name}"))

    def shared(name: str, inside) -> list[Column]:
        """The breaks of the language and of all documents, for groups that are not of another kind as a whole."""
        return [F.when(fits & inside(F.col(c)), F.col(c)) for c, fits in ((f"lang_{name}", large), (f"all_{name}", large | lang_large))]

    over = shared("over", lambda limit: chosen("high") <= limit)
    under = shared("under", lambda limit: chosen("low") >= limit)
    floor = F.greatest(chosen("least") - width(chosen("least")), chosen("under"), *under)
    ceiling = F.least(chosen("most") + 2 * width(chosen("most")) - 1, chosen("over"), *over)
    return rows.select("lang", "source", "measure", F.when(F.col("measure").isin(*FLOORED), floor).alias("floor"), ceiling.alias("ceiling"))


def judge(docs: DataFrame, least_group: int = LEAST_GROUP, reach: float = REACH, folder: str | None = None) -> DataFrame:
    """Per row of the documents: doc_id, lang, source, the counts, base_failed, kept.

    Words are split at white space. base_failed: fewer than 20 words, or more than
    30 % of them in 8-word windows found twice or more in the text; so a null or
    empty text fails. Others are kept if all their measures are within their
    group's thresholds, which are taken from those others. Null languages and sources are groups of their own; repeated
    rows count each; an empty table gives none. Other columns are not read.
    """
    rows = store(measured(docs), f"{folder or shared_folder(docs.sparkSession, 'quality')}/measured")
    fences = thresholds(sketches(rows.where("NOT base_failed")), least_group, reach)
    wide = fences.groupBy(F.col("lang").alias("l"), F.col("source").alias("s")).agg(
        *[F.min(F.when(F.col("measure") == m, F.col(c))).alias(f"{m}_{c}") for m in MEASURES for c in ("floor", "ceiling")]
    )
    joined = rows.join(wide, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left").drop("l", "s")
    fine = reduce(
        lambda a, b: a & b,
        [
            (F.col(m) <= F.coalesce(f"{m}_ceiling", m)) & (F.col(m) >= F.coalesce(f"{m}_floor", m))
            for m in MEASURES
        ],
    )
    names = [c.split()[0] for c in COUNTS.split(", ")]
    return joined.select("doc_id", "lang", "source", *names, "base_failed", (~F.col("base_failed") & fine).alias("kept"))

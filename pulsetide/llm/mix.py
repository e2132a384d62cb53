"""Mixing sources to target weights, exact to the word and the same on every run.

Each document gets a hash-random key. Within its source, documents are sorted by
that key in ranges of equal width; the ranges' word counts are summed, their
prefix sums give each range its base, and a running sum inside each range gives
each document its place. The source's budget is cut at that place: whole epochs
first, then the documents before the cut, and of the one across it the words up
to it. No task holds a whole source, whatever its share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pulsetide.session import shared_folder, store

WORD = r"[^\\x20\\x09-\\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
#: Documents in one range of keys, in the mean.
RANGE_ROWS = 4_000


def sized(docs: DataFrame, folder: str) -> DataFrame:
    """One row per row of the documents: doc_id, source, size in words, hash-random key and its first 32 bits."""
    doc_id = F.col("doc_id").cast("string")
    rows = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), F.expr(f"coalesce(regexp_count(text, '{WORD}'), 0L)").cast("long").alias("size")
    )
    keyed = rows.withColumn("key", F.md5(F.coalesce(doc_id, F.lit(""))))
    # Repeated ids share a key; the row's hash orders those that differ otherwise.
    return store(keyed.withColumn("place", F.conv(F.substring("key", 1, 8), 16, 10).cast("long")), folder)


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Per source: source_size, rows, target.

    Sources in code point order, null last, take the weights in turn. A target is
    the source's share of the mix, at most `epochs` times its size: sources fill
    up in the order of epochs * size / weight, and the level that the others share
    is found from two running sums. One row per source is all that is ordered.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight.cast("long")).withColumn("most", epochs * F.col("source_size"))
    full = Window.orderBy(F.col("most") / F.col("w"), F.col("source").isNull(), "source")
    below = full.rowsBetween(Window.unboundedPreceding, -1)
    above = full.rowsBetween(0, Window.unboundedFollowing)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = share * F.sum("source_size").over(every.orderBy(F.lit(0)))
    level = (budget - F.coalesce(F.sum("most").over(below), F.lit(0))) / F.sum("w").over(above)
    per = per.withColumn("level", level)
    # The level at the first source that it doesn't fill; later ones are not filled either.
    first = F.min(F.when(F.col("level") * F.col("w") <= F.col("most"), F.struct(F.col("most") / F.col("w"), F.col("source").isNull(), "source", F.col("level").alias("at")))).over(every.orderBy(F.lit(0)))
    target = F.least(F.col("most").cast("double"), F.coalesce(first["at"] * F.col("w"), F.col("most").cast("double")))
    return per.select("source", "source_size", "n_rows", target.alias("target"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, range_rows: int = RANGE_ROWS, folder: str | None = None) -> DataFrame:
    """Per row of the documents: doc_id, source, size, source_size, target, taken.

    Sizes count words; a null or empty text has none and is never taken. A null
    source is a source of its own, a null doc_id an id like others. Rows that
    repeat an id are ordered by their size; equal ones are alike, so which of them
    comes first changes nothing but is settled by the sort. An empty table gives none.
    """
    folder = folder or shared_folder(docs.sparkSession, "mix")
    sizes = sized(docs, f"{folder}/sizes")
    plan = store(targets(sizes, weights, share, epochs), f"{folder}/targets")
    at = plan.withColumnRenamed("source", "s")
    rows = sizes.join(F.broadcast(at) if plan.count() <= 10_000 else at, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    width = F.ceil(F.lit(1 << 32) / F.ceil(F.col("n_rows") / range_rows)).cast("long")
    rows = rows.withColumn("r", F.expr("place") / width).withColumn("r", F.floor("r"))
    ranges = rows.groupBy("source", "r").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranges.select(F.col("source").alias("s"), F.col("r").alias("q"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    bases = store(bases, f"{folder}/bases")
    inside = Window.partitionBy("source", "r").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("run", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(bases, F.col("source").eqNullSafe(F.col("s")) & (F.col("r") == F.col("q")))
    words = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as long) div source_size")).otherwise(F.lit(0))
    rest = words - whole * F.col("source_size") - F.col("base") - F.col("run")
    taken = F.col("size") * whole + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The documents of the mix: one row per time that a document is taken whole, and the cut one with its first words.

    A cut text is its first words joined by one space. Documents that the mix
    takes no word of go. n_chars follows a cut text. Rows of one id and size are
    taken alike.
    """
    part = mix(docs, **params).select("doc_id", "source", "size", "taken")
    part = part.where("taken > 0").groupBy("doc_id", "source", "size").agg(F.sum("taken").alias("taken"), F.count("*").alias("n"))
    names = docs.columns
    left = docs.withColumnsRenamed({c: f"_own_{c}" for c in names})
    text = F.col("_own_text")
    left = left.withColumn("_size", F.expr(f"coalesce(regexp_count(_own_text, '{WORD}'), 0L)").cast("long"))
    same = F.col("_own_doc_id").eqNullSafe(F.col("doc_id")) & F.col("_own_source").eqNullSafe(F.col("source")) & (F.col("_size") == F.col("size"))
    rows = left.join(part, same).withColumn("_each", F.expr("cast(taken div n as long)"))
    times = F.expr("transform(sequence(1L, cast(ceil(_each / size) as long)), i -> least(size, _each - (i - 1) * size))")
    rows = rows.withColumn("_take", F.explode(times))
    cut = F.expr(f"array_join(slice(regexp_extract_all(_own_text, '{WORD}', 0), 1, cast(_take as int)), ' ')")
    rows = rows.withColumn("_text", F.when(F.col("_take") < F.col("size"), cut).otherwise(text))
    out = {"text": F.col("_text"), "n_chars": F.when(F.col("_take") < F.col("size"), F.length("_text").cast("long")).otherwise(F.col("_own_n_chars")) if "n_chars" in names else None}
    return rows.select(*[(out[c] if out.get(c) is not None else F.col(f"_own_{c}")).alias(c) for c in names])

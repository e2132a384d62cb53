"""Near duplicates by a chosen-path similarity join.

Every distinct shingle set gets a signature of minwise tokens. A tree starts with
all sets in one node. A node picks one or two of the signature's coordinates by
its own random choice (1 / similarity in the mean), and each of its sets goes to
one child per coordinate, named by its minwise token there. So two sets of
similarity s meet again in s / similarity children in the mean: similar ones stay
together, others part. Nodes of at most `leaf` sets are compared exhaustively.
Independent trees are repeated until the chance to miss a link at the threshold
is negligible (see `miss`).

A larger node offers its sets against one pivot and branches on; once its sets
are all in one component it has nothing more to tell and is dropped, however
large it is. Sets of nodes that still join several components at the last level are
finished by a prefix join on rare shingles: in any one order of all shingles, rarest
first, two similar sets share a shingle that is among the first 14 % of the shorter set
(its index prefix) and the first 25 % of the longer one (its probe prefix). A family
whose sets are less alike than the threshold differs in more than 14 % of each set, its
own and rare shingles, so what the family shares is in no index prefix and makes no pairs.

Candidates pass two estimates, 128 bits that travel with each row and then the whole
signature (each 4.5 standard deviations below the threshold), and are confirmed on
the full shingle sets of the texts: of each set first one pair, then all those that
still part two components. Equal sets
are one class before any of this, so thousands of copies are one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pulsetide.llm import words as w
from pulsetide.llm.decontaminate import free_name
from pulsetide.session import shared_folder, store

SHINGLE = 5
PERCENT = 75
COORDINATES = 128
#: As many as keep a miss at DEPTH below 2e-5.
TREES = 28
LEAF = 8
#: Levels between two looks at the components, and levels in all.
STRIDE, DEPTH = 3, 6
NODES = "node long, rep long, bits long, more long"
#: Rows of two or three numbers that may be broadcast (13 MB), and sets per file of a stored table.
BROADCAST_ROWS, FILE_SETS = 400_000, 20_000
#: Members compared with one center in one run of rows.
RUN = 64
#: Counters that order shingles by how often they are left at the last level.
COUNTERS = 1 << 18
#: Standard deviations below the threshold at which an estimate rules a pair out, and the same of what is left.
SIGMAS, SIGMAS_LEFT = 4.5, 6.0
#: Bytes of whole texts whose shingles are made at once.
SLICE = 1 << 20

_rng = np.random.default_rng(7)
_FACTOR = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def miss(level: int, percent: int = PERCENT, trees: int = TREES, coordinates: int = COORDINATES) -> float:
    """Chance that two sets of exactly the threshold's similarity share no node of a level.

    All trees choose from one signature, so it is the mean over the number of its coordinates in which the two agree.
    """
    s, second = percent / 100, 100 / percent - 1
    total = 0.0
    for same in range(coordinates + 1):
        lost = 0.0
        for _ in range(level):
            gone = 1 - same / coordinates * (1 - lost)
            lost = (1 - second) * gone + second * gone**2
        total += comb(coordinates, same) * s**same * (1 - s) ** (coordinates - same) * lost**trees
    return total


def shingle_sets(texts: w.Texts, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Per document its distinct shingles' fingerprints, sorted; a shorter text is one shingle."""
    words = w.words_of(texts, w.SPACED, lower=True)
    hashes = w.word_hashes(words)
    at = w.window_starts(words.first, size)
    grams = w.window_hashes(hashes, at, size)
    ends = np.concatenate(([0], np.cumsum(np.maximum(words.counts - size + 1, 0))))
    for i, n in enumerate(words.counts):
        if n >= size:
            yield np.unique(grams[ends[i] : ends[i + 1]])
        elif n:
            yield w.window_hashes(hashes[words.first[i] : words.first[i + 1]], np.zeros(1, np.int64), int(n))
        else:
            yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    out = np.empty(COORDINATES, np.uint32)
    for lo in range(0, COORDINATES, 8):
        mixed = (shingles[None, :] ^ _SHIFT[lo : lo + 8, None]) * _FACTOR[lo : lo + 8, None]
        out[lo : lo + 8] = mixed.min(axis=1) >> np.uint64(32)
    return out


def _bits(sig: np.ndarray) -> np.ndarray:
    """One bit of each coordinate, as two numbers: two sets are alike in (1 + similarity) / 2 of the bits."""
    bit = ((w.mix(sig.astype(np.uint64)) >> np.uint64(17)) & np.uint64(1)).reshape(len(sig), 2, 64)
    return np.bitwise_or.reduce(bit << np.arange(64, dtype=np.uint64), axis=2).view(np.int64)


def _sign(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    w.keep_only()
    for batch, texts in w.batches(rows, most=SLICE):
        counts, keys, signs = [], [], []
        bits = []
        for s in shingle_sets(texts):
            counts.append(len(s))
            keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            sig = signature(s) if len(s) else None
            signs.append(sig.tobytes() if len(s) else None)
            bits.append(_bits(sig[None, :])[0].tolist() if len(s) else (None, None))
        columns = [pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())]
        columns += [pa.array([b[i] for b in bits], pa.int64()) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_shingles", "set_key", "sig", "bits", "more"])


def _matrix(signs: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(signs.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _children(node: np.ndarray, sig: np.ndarray, level: int, second: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) for each row that holds a set and the node it is in."""
    seed = w.mix(node + np.uint64(level))
    one = (seed % np.uint64(COORDINATES)).astype(np.int64)
    rest = w.mix(seed)
    two = (one + 1 + (rest % np.uint64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
    more = np.flatnonzero((rest >> np.uint64(40)).astype(float) < second * (1 << 24))
    row = np.concatenate((np.arange(len(node)), more))
    at = np.concatenate((one, two[more]))
    child = w.mix(w.mix(seed[row] + at.astype(np.uint64)) ^ sig[row, at].astype(np.uint64))
    return row, child


def _plant(trees: int, second: float):
    def plant(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w.keep_only()
        for batch in rows:
            if batch.num_rows:
                sig, reps = _matrix(batch.column("sig")), batch.column("rep").to_numpy()
                bits, more = batch.column("bits").to_numpy(), batch.column("more").to_numpy()
                for tree in range(trees):
                    root = np.full(len(reps), w.mix(np.array([tree + 1], np.uint64))[0], np.uint64)
                    row, child = _children(root, sig, 0, second)
                    yield _nodes(child, reps[row], bits[row], more[row])

    return plant


def _branch(level: int, second: float):
    def branch(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if batch.num_rows:
                sig, reps = _matrix(batch.column("sig")), batch.column("rep").to_numpy()
                bits, more = batch.column("bits").to_numpy(), batch.column("more").to_numpy()
                row, child = _children(batch.column("node").to_numpy().view(np.uint64), sig, level, second)
                yield _nodes(child, reps[row], bits[row], more[row])

    return branch


def _nodes(child: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), *map(pa.array, columns)], names=["node", "rep", "bits", "more"])


def _agree(percent: int, sigmas: float = SIGMAS):
    least = percent / 100 - sigmas * (percent / 100 * (1 - percent / 100) / COORDINATES) ** 0.5

    def agree(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if batch.num_rows:
                same = (_matrix(batch.column("sig_a")) == _matrix(batch.column("sig_b"))).mean(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), pa.array(same >= percent / 100)], names=["a", "b", "likely"]
                ).filter(pa.array(same >= least))

    return agree


def _confirm(percent: int):
    """Rows sorted by run, each run's center first: the linked (a, b)."""

    def confirm(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w.keep_only()
        center, mine = None, np.zeros(0, np.uint64)
        for batch, texts in w.batches(rows, most=SLICE):
            left, right = [], []
            runs = zip(batch.column("a").to_pylist(), batch.column("salt").to_pylist(), batch.column("b").to_pylist())
            for (a, salt, b), other in zip(runs, shingle_sets(texts)):
                if b is None:
                    # A document number that stands for several texts links with what any of them links with.
                    mine = [*mine, other] if center == (a, salt) else [other]
                    center = (a, salt)
                    continue
                for own in mine if center == (a, salt) else ():
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    if both and 100 * both >= percent * (len(own) + len(other) - both):
                        left.append(a)
                        right.append(b)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return confirm


class _Join:
    """One run of the join over a table's distinct sets."""

    def __init__(self, docs: DataFrame, percent: int, trees: int, leaf: int, folder: str):
        self.docs, self.percent, self.trees, self.leaf, self.folder = docs, percent, trees, leaf, folder
        self.second = 100 / percent - 1
        self.made = 0
        self.texts: list[DataFrame] = []
        self.files = 0
        self.spark = docs.sparkSession

    def keep(self, rows: DataFrame) -> DataFrame:
        """Store a table of few columns, in as many files as the number of sets calls for."""
        self.made += 1
        return store(rows.coalesce(self.files) if self.files else rows, f"{self.folder}/{self.made}")

    def small(self, rows: DataFrame) -> DataFrame:
        """Stored narrow rows, to be broadcast if they are few; else Spark joins as it sees fit."""
        return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows

    def sized(self, nodes: DataFrame) -> DataFrame:
        """Nodes of two sets or more. Counts are written first, so a large node's rows can be split in the join."""
        nodes = self.keep(nodes)
        return nodes.join(self.keep(nodes.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")), "node")

    def near(self, pairs: DataFrame, sigmas: float = SIGMAS) -> DataFrame:
        """Candidate pairs that the signatures don't rule out: a, b, likely; their texts are made ready."""
        a = self.reps.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a"))
        b = self.reps.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"))
        pairs = self.small(self.keep(pairs))
        near = self.keep(pairs.join(a, "a").join(b, "b").mapInArrow(_agree(self.percent, sigmas), "a long, b long, likely boolean"))
        self.fetch(near.select(F.col("a").alias("doc_id")).union(near.select(F.col("b").alias("doc_id"))))
        return near

    def fetch(self, ids: DataFrame) -> None:
        """Make these documents' texts ready, those that aren't yet."""
        ids = ids.distinct()
        for known in self.texts:
            ids = ids.join(known.select("doc_id").distinct(), "doc_id", "left_anti")
        # A few texts are fetched without moving all documents.
        ids = self.keep(ids)
        if not ids.isEmpty():
            ids = self.small(ids)
            self.texts.append(self.keep(self.docs.select("doc_id", "text").join(ids, "doc_id", "left_semi").select("doc_id", "text")))

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose full shingle sets are similar; a center's pairs are cut into runs."""
        counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / RUN).alias("runs"))
        dealt = pairs.join(counts, "a").select("a", F.pmod(F.xxhash64("b"), "runs").cast("int").alias("salt"), "b")
        members = dealt.withColumn("doc_id", F.col("b"))
        centers = dealt.select("a", "salt").distinct().select("a", "salt", F.lit(None).cast("long").alias("b"), F.col("a").alias("doc_id"))
        needs = self.small(self.keep(members.unionByName(centers)))
        if not self.texts:
            return pairs.select("a", "b")
        texts = reduce(DataFrame.union, self.texts)
        rows = needs.join(texts, "doc_id").select("a", "salt", "b", "text")
        runs = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
        return runs.mapInArrow(_confirm(self.percent), "a long, b long").distinct()


def alike(x: str, y: str, percent: int) -> str:
    """SQL: the bits of two sets don't rule out that they are similar."""
    s, n = (1 + percent / 100) / 2, COORDINATES
    return f"bit_count({x}bits ^ {y}bits) + bit_count({x}more ^ {y}more) <= {n * (1 - s) + 4.5 * (n * s * (1 - s)) ** 0.5}"


def pairs_of_leaves(leaves: DataFrame, percent: int) -> DataFrame:
    """All pairs (a < b) of nodes of bounded size."""
    lists = leaves.groupBy("node").agg(F.array_sort(F.collect_set(F.struct("rep", "bits", "more"))).alias("m")).where("size(m) > 1")
    one = lists.selectExpr("posexplode(m) AS (i, x)", "m")
    two = one.selectExpr("x", "explode(slice(m, i + 2, size(m))) AS y").where("x.rep <> y.rep AND " + alike("x.", "y.", percent))
    return two.selectExpr("x.rep AS a", "y.rep AS b")


def pairs_with_pivot(big: DataFrame, level: int, percent: int) -> DataFrame:
    """Each set of a large node with the node's pivot: the least set, and deeper down another choice that nodes share."""
    order = F.col("rep") if level <= STRIDE else F.xxhash64("rep", F.lit(level // STRIDE))
    pivots = big.groupBy("node").agg(*[F.min_by(c, order).alias(f"p{c}") for c in ("rep", "bits", "more")])
    pairs = big.join(pivots, "node").withColumnRenamed("prep", "p").where("p <> rep AND " + alike("p", "", percent))
    return pairs.select(F.least("p", "rep").alias("a"), F.greatest("p", "rep").alias("b"))


def components(links: DataFrame, keep) -> DataFrame:
    """(rep, comp) of all linked nodes; comp is the least node reachable.

    Labels fall to the least neighbour's label, then jump to their label's label,
    until none falls. Sums are combined before shuffles, so a hub is one row per task.
    """
    both = keep(links.select("a", "b").union(links.select("b", "a")).toDF("u", "v").where("u <> v").distinct())
    labels = keep(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("rep"), F.least("u", "m").alias("comp")))
    while True:
        near = both.join(labels.withColumnRenamed("rep", "v"), "v").groupBy("u").agg(F.min("comp").alias("m"))
        fell = labels.join(near.withColumnRenamed("u", "rep"), "rep").select("rep", F.least("comp", "m").alias("to"), "comp")
        fell = keep(fell)
        jump = fell.select(F.col("rep").alias("to"), F.col("to").alias("next"))
        new = keep(fell.join(jump, "to", "left").select("rep", F.coalesce("next", "to").alias("comp"), F.col("comp").alias("old")))
        labels = new.select("rep", "comp")
        if new.where("comp <> old").isEmpty():
            return labels


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, trees: int = TREES, leaf: int = LEAF, depth: int = DEPTH, folder: str | None = None
) -> DataFrame:
    """Per row of the documents: doc_id, n_shingles, component_id, kept.

    Words are split at white space, A-Z lower-cased; a set holds the distinct
    5-word shingles, or the whole text where it is shorter. Documents are linked
    where 100 * intersection >= percent * union; component_id is the least doc_id
    reachable. A null text or one without words has no shingles, is linked with
    nothing and kept. Rows of one doc_id are one document with several texts; a
    row without doc_id is linked with nothing, has a null component_id and is
    kept. An empty table gives none. Other columns are not looked at.
    """
    spark = docs.sparkSession
    join = _Join(docs, percent, trees, leaf, folder or shared_folder(spark, "near-dup"))
    signed = join.keep(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
            _sign, "doc_id long, n_shingles long, set_key binary, sig binary, bits long, more long"
        )
    )
    classes = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    classes = join.keep(classes)
    held = signed.join(classes, "set_key").where("doc_id = rep")
    join.files = max(4, classes.count() // FILE_SETS)
    join.reps = join.keep(held.dropDuplicates(["rep", "set_key"]).select("rep", "sig", "bits", "more"))

    links, comp = _links(join, depth)
    # A document number with several texts ties their classes together.
    known = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").withColumn("k", F.xxhash64("set_key"))
    many = known.groupBy("doc_id").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).where("lo <> hi").select("doc_id")
    ties = known.join(many, "doc_id").join(classes, "set_key").where("doc_id <> rep")
    ties = ties.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    ties = join.keep(ties)
    if not ties.isEmpty():
        comp = components(links.union(ties), join.keep)
    return (
        signed.select("doc_id", "n_shingles", "set_key")
        .join(classes, "set_key", "left")
        .join(comp, "rep", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("comp", "rep", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _links(join: _Join, depth: int) -> tuple[DataFrame, DataFrame]:
    """Confirmed links that span all components, and the components."""
    nodes = join.reps.mapInArrow(_plant(join.trees, join.second), NODES)
    links, comp, level = [], None, 0
    while True:
        found = []
        for _ in range(STRIDE):
            level += 1
            sized = join.sized(nodes)
            small = sized.where(F.col("n") <= join.leaf)
            big = join.keep(sized.where(F.col("n") > join.leaf).drop("n"))
            found += [pairs_of_leaves(small, join.percent), pairs_with_pivot(big, level, join.percent)]
            done = big.isEmpty()
            if done or level % STRIDE == 0:
                break
            nodes = _next(join, big, level)
        pairs = reduce(DataFrame.union, found).distinct()
        if links:
            pairs = _across(pairs, comp)
        comp = _confirmed(join, pairs, links)
        if done:
            break
        held = join.keep(big.join(comp, "rep", "left").withColumn("comp", F.coalesce("comp", "rep")))
        open_ = held.groupBy("node").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("node")
        held = join.keep(held.join(join.keep(open_), "node"))
        if held.isEmpty():
            break
        if level >= depth:
            comp = _confirmed(join, _remaining(join, held), links, SIGMAS_LEFT)
            break
        nodes = _next(join, held, level)
    return reduce(DataFrame.union, links).distinct(), comp


def _next(join: _Join, big: DataFrame, level: int) -> DataFrame:
    rows = join.small(join.keep(big.select("node", "rep"))).join(join.reps, "rep").select("node", "rep", "sig", "bits", "more")
    return rows.mapInArrow(_branch(level, join.second), NODES)


def _confirmed(join: _Join, pairs: DataFrame, links: list[DataFrame], sigmas: float = SIGMAS) -> DataFrame:
    """Add the pairs' links, as many as tell the components; returns these.

    First each set's likely pair with the least other set, then the pairs that
    still part two components.
    """
    near = join.near(pairs, sigmas)
    first = near.where("likely").groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links.append(join.keep(join.linked(first)))
    comp = components(reduce(DataFrame.union, links), join.keep)
    rest = join.keep(_across(near.select("a", "b").join(first, ["a", "b"], "left_anti"), comp))
    if not rest.isEmpty():
        links.append(join.keep(join.linked(rest)))
        comp = components(reduce(DataFrame.union, links), join.keep)
    return comp


def _across(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component yet."""
    a = comp.select(F.col("rep").alias("a"), F.col("comp").alias("x"))
    b = comp.select(F.col("rep").alias("b"), F.col("comp").alias("y"))
    joined = pairs.join(a, "a", "left").join(b, "b", "left")
    return joined.where(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b")


def _remaining(join: _Join, held: DataFrame) -> DataFrame:
    """Pairs that may be links, of different components, among sets of nodes that are still open at the last level.

    The order of shingles comes from a bounded table of counters, by hash; any
    order gives all links, and this one keeps hot shingles out of the prefixes.
    In a shingle's rows the most common component is not joined with itself.
    """
    rows = join.keep(held.select("rep", "comp").distinct())
    join.fetch(rows.select(F.col("rep").alias("doc_id")))
    texts = reduce(DataFrame.union, join.texts)
    texts = join.keep(texts.join(join.small(rows), texts["doc_id"] == rows["rep"]).select("rep", "comp", "text"))
    counted = texts.select("text").mapInArrow(_count_shingles, "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    counts = np.zeros(COUNTERS, np.int64)
    for counter, n in counted.collect():
        counts[counter] = n
    order = join.spark.sparkContext.broadcast(counts)
    first = join.keep(texts.mapInArrow(_prefixes(join.percent, order), "token long, rep long, comp long, n long, rest long, indexed boolean"))
    per = first.groupBy("token", "comp").agg(F.count("*").alias("n"), F.count_if("indexed").alias("index_rows"))
    tops = per.groupBy("token").agg(
        F.max_by("comp", F.struct("n", "comp")).alias("top"), F.count("*").alias("comps"), F.sum("index_rows").alias("index_rows")
    ).where("comps > 1 AND index_rows > 0")
    shared = join.keep(first.join(join.small(join.keep(tops.select("token", "top"))), "token"))
    # The shorter set, or of two alike the one of the lesser number, by its index prefix; the other by its probe prefix.
    one = shared.where("indexed").selectExpr("token", "rep AS a", "comp AS x", "n AS na", "rest AS ra", "top")
    two = shared.selectExpr("token", "rep AS b", "comp AS y", "n AS nb", "rest AS rb", "top AS common")
    fits = f"x <> y AND (na < nb OR na = nb AND a < b) AND {100 + join.percent} * least(ra, rb) >= {join.percent} * (na + nb)"
    rare = one.where("x <> top").join(two, "token").where(fits).select("a", "b")
    most = one.where("x = top").join(two.where("y <> common"), "token").where(fits).select("a", "b")
    return rare.union(most).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (w.mix(shingles) & np.uint64(COUNTERS - 1)).astype(np.int64)


def _count_shingles(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(COUNTERS, np.int64)
    for _, texts in w.batches(rows, most=SLICE):
        for shingles in shingle_sets(texts):
            np.add.at(counts, _counter(shingles), 1)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at])], names=["counter", "n"])


def _prefixes(percent: int, order):
    """Per set its probe prefix: token, rep, comp, shingles of the set, those from this one on, and whether it is in the index prefix.

    The overlap with any similar set is at least that with a subset of the threshold's size;
    with one that is no shorter, at least 2 * percent / (100 + percent) of this set.
    """

    def prefixes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = order.value
        for batch, texts in w.batches(rows, most=SLICE):
            which, tokens, sizes, rests, indexed = [], [], [], [], []
            for i, shingles in enumerate(shingle_sets(texts)):
                n = len(shingles)
                first = n - -(-percent * n // 100) + 1 if n else 0
                index = n - -(-2 * percent * n // (100 + percent)) + 1
                tokens.append(shingles[np.lexsort((shingles, counts[_counter(shingles)]))[:first]].view(np.int64))
                which += [i] * first
                sizes += [n] * first
                rests += range(n, n - first, -1)
                indexed += [place < index for place in range(first)]
            at = pa.array(which, pa.int64())
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat), batch.column("rep").take(at), batch.column("comp").take(at), pa.array(sizes, pa.int64()), pa.array(rests, pa.int64()), pa.array(indexed, pa.bool_())],
                names=["token", "rep", "comp", "n", "rest", "indexed"],
            )

    return prefixes


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """The documents whose doc_id names their component, with their own columns; of repeated rows one stays.

    Rows without doc_id stay.
    """
    ids = near_duplicates(docs, **params).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(ids, "doc_id", "left_semi").select(*docs.columns)
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]))
    at = free_name(docs.columns, "at")
    one = named.withColumn(at, F.row_number().over(order)).where(F.col(at) == 1).drop(at)
    return one.union(docs.where("doc_id IS NULL"))

"""Benchmark decontamination: n-grams of test items, found in training documents.

The n-grams of all items go to every task as one hash set. Their number is
counted before; more than one set may hold are dealt into as many rounds as it takes,
one after the other, so the result is the same for any benchmark. Hits by fingerprint are verified on the bytes of the words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulsetide.llm import words as w
from pulsetide.session import shared_folder, store

GRAM = 13
#: Contaminated: at least this share of the words, as 1 in SHARE.
SHARE = 20
#: Windows that one broadcast set may hold (about 100 bytes each).
BROADCAST_WORDS = 500_000

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().translate(bytes(w.LOWER)))


def grams_of(items: list[tuple[str, str]], gram: int) -> dict[int, dict[bytes, set[str]]]:
    """By length in words: window, its words joined by one space, and the items that hold it."""
    found: dict[int, dict[bytes, set[str]]] = {}
    for item, text in items:
        got = item_words(text)
        size = min(gram, len(got))
        for i in range(len(got) - size + 1 if size else 0):
            found.setdefault(size, {}).setdefault(b" ".join(got[i : i + size]), set()).add(item)
    return found


def _fingerprints(grams: dict[bytes, set[str]], size: int) -> np.ndarray:
    keys = list(grams)
    words = w.words_of(w.texts_of(pa.array(keys, pa.binary()).cast(pa.large_binary())), w.ALNUM)
    return np.unique(w.window_hashes(w.word_hashes(words), np.arange(len(keys)) * size, size))


def _mark(texts: w.Texts, sets: list) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    """Words, hit words and items per document."""
    words = w.words_of(texts, w.ALNUM, lower=True)
    hashes = w.word_hashes(words)
    n, docs = len(words.start), len(texts)
    hit, items = np.zeros(n, bool), [set() for _ in range(docs)]
    for size, keys, grams in sets:
        at = w.window_starts(words.first, size)
        found = at[_member(w.window_hashes(hashes, at, size), keys)]
        doc = np.searchsorted(words.first, found, "right") - 1
        real: list[int] = []
        for p, d in zip(found.tolist(), doc.tolist()):
            window = b" ".join(
                [words.data[s:e].tobytes() for s, e in zip(words.start[p : p + size], words.end[p : p + size])]
            )
            if window in grams:
                real.append(p)
                items[d] |= grams[window]
        hit |= w.covered(n, np.array(real, np.int64), size)
    return words, hit, items


def _member(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which values are among the sorted keys; most are not, and a table of bits tells so at once."""
    table = np.zeros(1 << 20, bool)
    table[(keys >> np.uint64(44)).astype(np.int64)] = True
    maybe = np.flatnonzero(table[(values >> np.uint64(44)).astype(np.int64)])
    place = np.minimum(np.searchsorted(keys, values[maybe]), len(keys) - 1)
    out = np.zeros(len(values), bool)
    out[maybe[keys[place] == values[maybe]]] = True
    return out


def _windows(gram: int):
    def windows(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                # Only the window's words: an item's text, however long, never travels whole.
                found = [(size, window) for size, held in grams_of([(item, text)], gram).items() for window in held]
                if found:
                    sizes, grams = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(found), pa.string()), pa.array(sizes, pa.int32()), pa.array(grams, pa.binary())],
                        names=["item", "size", "gram"],
                    )

    return windows


def benchmark_windows(benchmark: DataFrame, gram: int, folder: str) -> DataFrame:
    """Stored: the distinct windows of all items (item, size in words, gram). An item without id has a null one."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return store(items.mapInArrow(_windows(gram), "item string, size int, gram binary").distinct(), folder)


def contamination(
    docs: DataFrame, benchmark: DataFrame, gram: int = GRAM, share: int = SHARE, most: int = BROADCAST_WORDS, folder: str | None = None
) -> DataFrame:
    """The documents' columns with n_words, n_hit, n_items, items_sha256, contaminated.

    A window is `gram` consecutive words of an item, or a shorter item whole. A
    document word within any occurrence of a window is hit. A null or empty text
    has no words; an item without words has no window, one without id has windows that hit
    but no name; an empty benchmark hits nothing. Repeated rows each get their own result.
    Columns of the documents that bear the names above are replaced; any other names are free.
    """
    added = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    kept = docs.drop(*added)
    folder = folder or shared_folder(docs.sparkSession, "decontaminate")
    spans, items, words, hit = (free_name(kept.columns, name) for name in ("spans", "items", "words", "hit"))
    windows = benchmark_windows(benchmark, gram, f"{folder}/windows")
    # Windows are dealt by what they say, about `most` a round; a round's windows are on the driver while they are sent out.
    lots = max(1, -(-windows.count() // most))
    dealt = windows.withColumn("lot", F.pmod(F.xxhash64("gram"), F.lit(lots)))
    found = kept.withColumn(spans, F.lit(None).cast("array<long>")).withColumn(items, F.lit(None).cast("array<string>"))
    found = found.withColumn(words, F.lit(0).cast("long")).withColumn(hit, F.lit(0).cast("long"))
    for lot in range(lots):
        sent = docs.sparkSession.sparkContext.broadcast(_sets(dealt.where(F.col("lot") == lot).select("item", "size", "gram").toArrow()))
        found = _scan(found, sent, spans, items, words, hit)
        if lot < lots - 1:
            found = store(found, f"{folder}/round-{lot}")
            sent.unpersist()
    names = F.array_sort(items)
    return found.select(
        *kept.columns,
        F.col(words).alias("n_words"),
        F.col(hit).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        ((F.col(hit) > 0) & (share * F.col(hit) >= F.col(words))).alias("contaminated"),
    )


def free_name(columns: list[str], name: str) -> str:
    """A name that none of the columns has, in any case of letters."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name = f"_{name}"
    return name


def _sets(windows: pa.Table) -> list:
    grams: dict[int, dict[bytes, set[str]]] = {}
    for item, size, gram in zip(*(windows[c].to_pylist() for c in ("item", "size", "gram"))):
        names = grams.setdefault(size, {}).setdefault(gram, set())
        if item is not None:
            names.add(item)
    return [(size, _fingerprints(found, size), found) for size, found in sorted(grams.items())]


def _scan(found: DataFrame, sets, spans_name: str, items_name: str, words_name: str, hit_name: str) -> DataFrame:
    """Add the hits of one lot to the spans (hit words, as positions) and items found so far."""

    def mark(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w.keep_only()
        for batch, texts in w.batches(rows):
            words, hit, items = _mark(texts, sets.value)
            spans, names = [], []
            for i, (old, had) in enumerate(zip(batch.column(spans_name).to_pylist(), batch.column(items_name).to_pylist())):
                lo, hi = words.first[i], words.first[i + 1]
                here = hit[lo:hi]
                if old:
                    here = here.copy()
                    here[np.array(old)] = True
                    hit[lo:hi] = here
                spans.append(np.flatnonzero(here).tolist() if here.any() else None)
                names.append(sorted(items[i] | set(had or ())))
            new = {
                spans_name: pa.array(spans, pa.list_(pa.int64())),
                items_name: pa.array(names, pa.list_(pa.string())),
                words_name: pa.array(words.counts, pa.int64()),
                hit_name: pa.array(w.per_document(hit, words.first), pa.int64()),
            }
            yield pa.RecordBatch.from_arrays(
                [new.get(n, c) for n, c in zip(batch.schema.names, batch.columns)], names=batch.schema.names
            )

    return found.mapInArrow(mark, found.schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    marked = docs.withColumnsRenamed({c: f"_own_{c}" for c in docs.columns if c not in ("text",)})
    found = contamination(marked, benchmark, **params).where("NOT contaminated")
    return found.select(*[F.col("text") if c == "text" else F.col(f"_own_{c}").alias(c) for c in docs.columns])


"""Language identification by a byte convolutional network, trained and applied in numpy.

Bytes fall into 128 classes (ASCII case folded). Filters of several widths slide
over a window of fixed length; each filter's largest response is kept, and a
softmax over those gives the window's language. A filter on one-hot classes is a
table per position, so a response is a sum of table rows; for a trained network the
tables of neighbouring positions are added up to one table per pair of classes,
and a response of width 4 takes two look-ups. The backward pass touches only the
positions that won the pooling.

A text is cut into windows end to end, all of it; the text's distribution is the
mean of its windows', weighted by their letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from pulsetide.llm import words as w

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EPOCHS = 12
#: Windows worked on at once: their responses stay in the processor's cache.
LOT = 24
#: Bytes of whole texts whose windows are made at once.
SLICE = 1 << 20
#: Labelled documents used for training, per language at most.
PER_LANGUAGE = 1_500
HELD_OUT = 2

CLASSES = 128
#: Class 0 pads a window; 1 white space, 2 digits, 3 other ASCII; letters; the bytes of other characters.
CLASS = np.full(256, 3, np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = 1
CLASS[48:58] = 2
CLASS[97:123] = CLASS[65:91] = np.arange(4, 30)
CLASS[128:192] = np.arange(30, 94)
CLASS[192:256] = 94 + np.minimum(np.arange(64), CLASSES - 95)
_LETTERISH = (CLASS >= 4).astype(np.int32)


@dataclass
class Network:
    """tables[k][j]: responses (class, filter) of width k's position j; out: weights of the pooled responses."""

    languages: list[str]
    tables: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pairs(self) -> list[list[tuple[int, np.ndarray]]]:
        """Per width: (position, table over pairs of classes) whose sum is the response."""
        made = []
        for table in self.tables:
            even = np.concatenate((table, np.zeros((len(table) % 2, *table.shape[1:]), np.float32)))
            parts = [(j, even[j][:, None, :] + even[j + 1][None, :, :]) for j in range(0, len(even), 2)]
            made.append([(j, t.reshape(CLASSES**2, -1)) for j, t in parts])
        return made

    def predict(self, windows: np.ndarray, pairs) -> np.ndarray:
        """Probabilities (window, language) of windows of classes, padded by max(WIDTHS) zeros."""
        n, length = windows.shape
        pair = windows[:, :-1].astype(np.int32) * CLASSES + windows[:, 1:]
        span = length - max(WIDTHS)
        pooled = []
        for parts in pairs:
            total = None
            for j, table in parts:
                got = np.take(table, pair[:, j : j + span].ravel(), axis=0)
                total = got if total is None else np.add(total, got, out=total)
            pooled.append(total.reshape(n, span, -1).max(axis=1))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        return _softmax(hidden @ self.out + self.out_bias)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(texts: w.Texts, length: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows of classes, document of each, letters in each); an empty text has none."""
    size = np.diff(texts.offsets)
    n = -(-size // length)
    doc = np.repeat(np.arange(len(texts)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = texts.offsets[doc] + k * length
    stop = np.minimum(start + length, texts.offsets[doc + 1])
    at = start[:, None] + np.arange(length)
    classes = np.concatenate((CLASS[texts.data], np.zeros(length, np.uint8)))
    out = np.zeros((len(doc), length + max(WIDTHS)), np.uint8)
    out[:, :length] = np.where(at < stop[:, None], classes[at], 0)
    return out, doc, (out >= 4).sum(axis=1)


def train(samples: list[tuple[bytes, str]], epochs: int = EPOCHS, seed: int = 11) -> Network:
    """A network from labelled pieces of text; the same for the same samples in the same order."""
    rng = np.random.default_rng(seed)
    languages = sorted({lang for _, lang in samples})
    label = np.array([languages.index(lang) for _, lang in samples])
    widest = max(WIDTHS)
    rows = np.zeros((len(samples), WINDOW + widest), np.uint8)
    for i, (text, _) in enumerate(samples):
        piece = CLASS[np.frombuffer(text[:WINDOW], np.uint8)]
        rows[i, : len(piece)] = piece
    net = Network(
        languages,
        [rng.normal(0, 0.3, (k, CLASSES, FILTERS)).astype(np.float32) for k in WIDTHS],
        np.zeros(FILTERS * len(WIDTHS), np.float32),
        rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    params = [*net.tables, net.bias, net.out, net.out_bias]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step, batch = 0, 64
    # Every language weighs alike, however many samples it has.
    weight = (len(label) / (len(languages) * np.bincount(label, minlength=len(languages))))[label].astype(np.float32)
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        for lo in range(0, len(rows), batch):
            at = rng.integers(0, len(rows), min(batch, len(rows)))
            x = rows[at].copy()
            # Shorter pieces too: half of the batch is cut at a random length.
            for i in range(0, len(at), 2):
                x[i, rng.integers(8, WINDOW) :] = 0
            grads = _gradients(net, x, label[at], weight[at])
            step += 1
            for p, g, m, v in zip(params, grads, mean, square):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _gradients(net: Network, x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    n, widest = len(x), max(WIDTHS)
    span = x.shape[1] - widest
    best, pooled = [], []
    for table in net.tables:
        total = sum(table[j][x[:, j : j + span]] for j in range(len(table)))
        best.append(total.argmax(axis=1))
        pooled.append(np.take_along_axis(total, best[-1][:, None, :], axis=1)[:, 0, :])
    raw = np.concatenate(pooled, axis=1) + net.bias
    hidden = np.maximum(raw, 0)
    p = _softmax(hidden @ net.out + net.out_bias)
    p[np.arange(n), label] -= 1
    p *= weight[:, None] / n
    back = (p @ net.out.T) * (raw > 0)
    grads = []
    for k, table in enumerate(net.tables):
        g, mine = np.zeros_like(table), back[:, k * FILTERS : (k + 1) * FILTERS]
        for j in range(len(table)):
            won = np.take_along_axis(x, best[k] + j, axis=1)
            np.add.at(g[j], (won, np.arange(FILTERS)[None, :]), mine)
        grads.append(g)
    return [*grads, back.sum(axis=0), hidden.T @ p, p.sum(axis=0)]


def labelled(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from: text and lang known, and not held out."""
    return docs.where("text IS NOT NULL AND lang IS NOT NULL AND length(text) > 0").where(
        F.crc32(F.col("doc_id").cast("string")) % 4 != HELD_OUT
    )


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Of each language at most `per_language` pieces (all, where there are fewer): lang, key, piece.

    Distinct texts are chosen by a hash of theirs before any row is moved, so a text is one
    piece however often it occurs. One count per language comes to the driver; what is ordered
    per language is about as much as is asked for.
    """
    rows = labelled(docs).select("text", F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("key"))
    # A fifth more than asked for, since a hash hits about that many, and the count is an estimate too.
    texts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("key", 0.02).alias("n")).collect()}
    if not texts:
        return rows.select("lang", "key", F.col("text").alias("piece"))
    shares = F.create_map(*[x for lang, n in sorted(texts.items()) for x in (F.lit(lang), F.lit(min(1.0, 1.2 * per_language / max(n, 1))))])
    chosen = rows.where(F.pmod("key", F.lit(1 << 30)) < shares[F.col("lang")] * (1 << 30))
    start = F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.length("text") - WINDOW + 1, F.lit(1))).cast("int")
    pieces = chosen.select("lang", "key", F.col("text").substr(start + 1, F.lit(WINDOW)).alias("piece"))
    one = pieces.groupBy("lang", "key").agg(F.min("piece").alias("piece"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("key", F.lit(1 << 30)), "key"))
    return one.withColumn("place", place).where(F.col("place") <= per_language).drop("place")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, epochs: int = EPOCHS) -> Network | None:
    """Train on a bounded sample. None if no row can be learned from."""
    got = sample(docs, per_language).collect()
    samples = [(r["piece"].encode(), r["lang"]) for r in sorted(got, key=lambda r: (r["key"], r["lang"]))]
    return train(samples, epochs) if samples else None


def _has_letter(texts: w.Texts) -> np.ndarray:
    """Whether each document has a letter of any script."""
    letters = np.concatenate(([0], np.cumsum(_LETTERISH[texts.data])))
    ascii_letters = np.concatenate(([0], np.cumsum((CLASS[texts.data] >= 4) & (CLASS[texts.data] < 30))))
    lo, hi = texts.offsets[:-1], texts.offsets[1:]
    sure = ascii_letters[hi] > ascii_letters[lo]
    for i in np.flatnonzero(~sure & (letters[hi] > letters[lo])):
        sure[i] = any(c.isalpha() for c in texts.bytes(i).decode("utf-8", "replace"))
    return sure


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """The documents' columns with lang_pred and score.

    A null text or one without a letter is `und` with score 0; so is every text
    where nothing could be learned. Columns of these names are replaced.
    """
    rows = docs.drop("lang_pred", "score")
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w.keep_only()
        net = shared.value
        pairs = net.pairs() if net else None
        for batch, texts in w.batches(batches, most=SLICE):
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if net:
                total = np.zeros((len(texts), len(net.languages)))
                x, doc, letters = windows_of(texts)
                for lo in range(0, len(x), LOT):
                    p = net.predict(x[lo : lo + LOT], pairs) * np.maximum(letters[lo : lo + LOT], 1e-3)[:, None]
                    np.add.at(total, doc[lo : lo + LOT], p)
                known = _has_letter(texts)
                best = total.argmax(axis=1)
                scores = np.where(known, total.max(axis=1) / np.maximum(total.sum(axis=1), 1e-12), 0.0)
                names = [net.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    return rows.mapInArrow(label, schema)


def identify(docs: DataFrame, **params) -> DataFrame:
    """Train on the documents' labelled rows and predict every row: doc_id, held_out, lang_pred, score.

    held_out tells the rows that nothing was learned from by rule; a row without
    doc_id is never learned from and not held out.
    """
    net = fit(docs, **params)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT, F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), F.col("text").cast("string").alias("text"))
    return predict(rows, net).drop("text")


def known_documents(docs: DataFrame, least: float = 0.0, **params) -> DataFrame:
    """The documents whose language is known with a score of `least` or more, with their own columns."""
    net = fit(docs, **params)
    renamed = docs.withColumnsRenamed({c: f"_own_{c}" for c in docs.columns if c != "text"})
    found = predict(renamed, net).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.select(*[F.col("text") if c == "text" else F.col(f"_own_{c}").alias(c) for c in docs.columns])

"""Fill-in-middle: documents cut in three, their middle moved to the end.

Cuts are drawn in code points from a hash of the document's id, and made in bytes:
the sparse index of `chars` turns one into the other for all documents of a slice
at once, so ASCII text is cut by arithmetic and no text is walked character by
character. The draws, the markers and the rates are parameters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pulsetide.llm import words as w
from pulsetide.llm.chars import Exceptions

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents so many are transformed, and of 100 of these so many put the suffix first.
RATE, SUFFIX_FIRST = 90, 20
SEED = 1

OUT = "doc_id {id}, n long, form string, prefix_chars long, middle_chars long, output string"


def cuts_of(texts: w.Texts, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of each document, its two cuts in code points, and the cuts as places in the data."""
    index = Exceptions(texts.data)
    border = index.chars(texts.offsets)
    start, n = border[:-1], np.diff(border)
    a, b = one % (n + 1), two % (n + 1)
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    return n, lo, hi, index.bytes(start + lo), index.bytes(start + hi)


def fill_in_middle(
    docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED, markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)
) -> DataFrame:
    """Per row of the documents: doc_id, n, form, prefix_chars, middle_chars, output.

    n counts code points. The first four groups of eight digits of the hex sha256 of
    'SEED:doc_id' choose the two cuts, whether the document is transformed, and the
    order: psm is prefix, suffix, middle, each behind its marker; spm is suffix, prefix,
    middle. A document is plain, its output the text, where the draw says so and
    where the text is empty or holds a marker, so an output is read back without
    doubt. A null text is empty; a null doc_id counts as no digits; rows of one
    doc_id are cut alike where their texts are. Either cut may be at an end, so
    parts may be empty. An empty table gives none. Other columns are not read.
    """
    first, second, third = (m.encode() for m in markers)

    def transform(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in w.batches(rows):
            draw = [batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4)]
            n, lo, hi, lo_at, hi_at = cuts_of(texts, draw[0], draw[1])
            whole = texts.data.tobytes()
            marked = any(m in whole for m in (first, second, third))
            plain = (n == 0) | (draw[2] % 100 >= rate)
            spm = draw[3] % 100 < suffix_first
            out, forms = [], []
            for i, (s, x, y, e) in enumerate(zip(texts.offsets[:-1].tolist(), lo_at.tolist(), hi_at.tolist(), texts.offsets[1:].tolist())):
                if plain[i] or marked and any(whole.find(m, s, e) >= 0 for m in (first, second, third)):
                    plain[i] = True
                    forms.append("plain")
                    out.append(whole[s:e])
                elif spm[i]:
                    forms.append("spm")
                    out.append(b"".join((second, whole[y:e], first, whole[s:x], third, whole[x:y])))
                else:
                    forms.append("psm")
                    out.append(b"".join((first, whole[s:x], second, whole[y:e], third, whole[x:y])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n),
                    pa.array(forms, pa.string()),
                    pa.array(lo, mask=plain),
                    pa.array(hi - lo, mask=plain),
                    pa.array(out, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), *draws)
    return rows.mapInArrow(transform, OUT.format(id=docs.schema["doc_id"].dataType.simpleString()))


def restored(output: Column, form: Column, markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that an output was made of, from the output and its form alone."""
    parts = F.split(output, "|".join(map(re.escape, markers)), -1)
    second, third, fourth = (F.get(parts, i) for i in (1, 2, 3))
    return F.when(form == "psm", F.concat(second, fourth, third)).when(form == "spm", F.concat(third, fourth, second)).otherwise(output)

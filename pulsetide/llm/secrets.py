"""Secret scans: known forms, and random strings by their token efficiency.

A byte-pair vocabulary was learned on language and code, so words cost few tokens
and random strings many: a stretch of key characters with few characters per token is
taken for a secret. Known digests and identifiers are cut out of a run first:
hexadecimal strings of a digest's length, UUIDs, and strings of digits and signs. What
is left is weighed token by token, so a secret is found behind a path of words too, and
words joined by case, dash or slash are spared by what they cost. Each step is linear
in the run's length.

All patterns consist of ASCII bytes, so a slice is screened as bytes for runs long
enough and for key words; only texts that pass are searched by pattern.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulsetide.llm import words as w

KINDS = ("assign", "access", "hex", "random")
# Fixed values of the base forms.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
LEAST_RUN = 20
#: Fewer characters per token than this are random. Prose has about four, random base64 about 1.4, random lower case 1.7.
MOST_PER_TOKEN = 2.4
DIGESTS = (32, 40, 48, 56, 64, 96, 128)
_DIGEST = "|".join(f"[0-9a-fA-F]{{{n}}}" for n in sorted(DIGESTS, reverse=True))
#: Known forms with no letter or digit beside them. Fixed lengths, begun at a border only: nothing is tried twice.
KNOWN = re.compile(rf"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{{8}}(?:-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}|{_DIGEST})(?![0-9A-Za-z])")
SIGNS = "+/_=-"
_LETTERS = re.compile("[A-Za-z]")
#: Characters that are turned into tokens at once; longer runs are, piece by piece.
PIECE = 256
KEY_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

_RUN_BYTE = np.zeros(256, bool)
_RUN_BYTE[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True

SCHEMA = "n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"

_vocabularies: dict[str, object] = w.worker_cache()


def vocabulary(path: str):
    """The byte-pair vocabulary of a rank file, read once per worker."""
    if path not in _vocabularies:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        _vocabularies[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _vocabularies[path]


def _weights(text: str, tokens, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Where each token of a text of key characters ends, and by how much it is shorter than `most` characters."""
    sizes: list[int] = []
    for at in range(0, len(text), PIECE):
        sizes += [len(t) for t in tokens.decode_tokens_bytes(tokens.encode_ordinary(text[at : at + PIECE]))]
    lengths = np.array(sizes)
    return np.cumsum(lengths), most - lengths


def _dense(text: str, tokens, most: float) -> Iterator[tuple[int, int]]:
    """Stretches of at least LEAST_RUN characters that cost more than one token per `most` characters."""
    ends, weights = _weights(text, tokens, most)
    found, total, best, first, last = [], 0.0, 0.0, 0, -1
    for i, weight in enumerate(weights.tolist()):
        total += weight
        if total > best:
            best, last = total, i
        if total <= 0:
            # Nothing before here can help a later stretch.
            found.append((first, last))
            total, best, first, last = 0.0, 0.0, i + 1, -1
    found.append((first, last))
    spans = [(int(ends[lo - 1]) if lo else 0, int(ends[hi])) for lo, hi in found if hi >= lo]
    long = [(lo, hi) for lo, hi in spans if hi - lo >= LEAST_RUN]
    # Short dense stretches may make the whole dense.
    return iter(long or ([(0, len(text))] if len(text) >= LEAST_RUN and weights.sum() > 0 else []))


def random_spans(run: str, tokens, most: float = MOST_PER_TOKEN) -> list[tuple[int, int]]:
    """(start, end) of the random strings in a run of key characters."""
    out, at = [], 0
    for known in [*KNOWN.finditer(run), None]:
        part = run[at : known.start() if known else len(run)]
        core = part.strip(SIGNS)
        if len(core) >= LEAST_RUN and _LETTERS.search(core):
            skip = at + len(part) - len(part.lstrip(SIGNS))
            for lo, hi in _dense(core, tokens, most):
                lo, hi = lo + len(core[lo:hi]) - len(core[lo:hi].lstrip(SIGNS)), hi - len(core[lo:hi]) + len(core[lo:hi].rstrip(SIGNS))
                if hi - lo >= LEAST_RUN and _LETTERS.search(core, lo, hi):
                    out.append((skip + lo, skip + hi))
        at = known.end() if known else at
    return out


def spans_of(text: str, tokens, most: float = MOST_PER_TOKEN) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans in order; a random string within a base span is that span."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= LEAST_HEX]
    base = sorted(found)
    reach, at, extra = -1, 0, []
    for m in RUN.finditer(text):
        if len(m[0]) >= LEAST_RUN:
            for start, end in random_spans(m[0], tokens, most):
                while at < len(base) and base[at][0] <= m.start() + start:
                    reach = max(reach, base[at][2])
                    at += 1
                if reach < m.start() + end:
                    extra.append((m.start() + start, 3, m.start() + end))
    return sorted(base + extra)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _suspects(texts: w.Texts) -> np.ndarray:
    """Documents with a long run of key characters or a key word."""
    runs = w.words_of(texts, _RUN_BYTE)
    doc = runs.doc()[runs.end - runs.start >= LEAST_RUN]
    out = np.zeros(len(texts), bool)
    out[doc] = True
    low = w.LOWER[texts.data].tobytes()
    for word in KEY_WORDS:
        at = low.find(word)
        while at >= 0:
            # Of a document that is in already, the rest need not be searched.
            doc = int(np.searchsorted(texts.offsets, at, "right")) - 1
            out[doc] = True
            at = low.find(word, int(texts.offsets[doc + 1]) - len(word) + 1 if texts.offsets[doc + 1] - at > len(word) else at + 1)
    return out


def find_secrets(docs: DataFrame, ranks: str, most: float = MOST_PER_TOKEN) -> DataFrame:
    """The documents' columns with n_assign, n_access, n_hex, n_random, base_sha256, spans.

    `ranks` is the vocabulary's path on every executor. Spans are kind:start:end in
    code points, by start and then kind; spans of different kinds may overlap. A null or
    empty text has none (the digest is that of nothing); a text is searched whole, at a
    cost in proportion to its length whatever it holds; repeated rows each get theirs;
    columns of these names are replaced.
    """
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    rows = docs.drop(*names)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary(ranks)
        for batch, texts in w.batches(batches):
            found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
            for i in np.flatnonzero(_suspects(texts)):
                found[i] = spans_of(texts.bytes(i).decode("utf-8", "replace"), tokens, most)
            counts = [pa.array([sum(s[1] == k for s in f) for f in found], pa.int64()) for k in range(len(KINDS))]
            base = [hashlib.sha256(listed([s for s in f if s[1] < 3]).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *counts, pa.array(base, pa.string()), pa.array([listed(f) for f in found], pa.string())],
                names=[*batch.schema.names, *names],
            )

    return rows.mapInArrow(scan, f"{fields}, {SCHEMA}")

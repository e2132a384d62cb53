"""Byte-level substring dedup over a sparse suffix array, merged with known common prefixes.

Which suffixes: every 200-byte window is known by its anchor, the 40-byte gram in it
of least fingerprint. Equal windows have their anchor at the same place, so only
suffixes at anchors are sorted, about one in eighty bytes. A first exchange of the
anchors' grams leaves out those that occur once.

Sort: a run sorts its anchors' suffixes (as far as any window reaches) with the text
to their left, equal ones once, stores their places in that order, and sends each
part a front-coded stretch: per suffix the length it shares with the one before, and
the rest. A part merges the stretches with a loser tree whose nodes hold the prefix
shared with the last winner: two suffixes of different shared length are ordered by
that alone, others are compared from there on. The merge yields the order and its
common prefixes (LCP).

Verdict: a window that starts d bytes before its anchor is repeated if some other
suffix shares 200 - d bytes to the right and d to the left. Within a stretch of the
order that shares a gram, suffixes seen twice in whole are repeated in all their
windows; for the others the common lengths of both sides give the d. A first few
bytes that would fill more than a part are hot: whole grams lie in them, so their
suffixes are left out of the order, and their windows are exchanged one by one as
fingerprints of 96 bits, which any number of parts can share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulsetide.llm import files, runs as r, words as w
from pulsetide.session import batches_of, shared_folder, store

LENGTH = 200
GRAM = 40
FILTER_BITS = 40
#: Text whose windows are looked at at once (some ten numbers a byte).
ANCHOR_BYTES = 1 << 18
#: Documents that a task which packs them gets at once, and runs that a task of a pass takes.
BATCH_ROWS = 1_000
RUNS_A_TASK = 4
#: Suffixes that one part merges.
PART_SUFFIXES = 100_000
#: Distinct contexts up to which a group is compared pair by pair; larger ones by classes per distance.
PAIRWISE = 16


def anchors_of(texts: w.Texts, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window, gram's fingerprint) of all windows, in text order."""
    span = length - gram + 1
    out: list[tuple] = []
    for first, _, part in w.slices(texts, ANCHOR_BYTES):
        size = len(part.data)
        if size < length:
            continue
        grams = w.span_hashes(part.data, np.arange(size - gram + 1), np.arange(gram, size + 1))
        # The place in the low bits settles ties: the leftmost of equal grams wins.
        bits = np.uint64(max(int(size).bit_length(), 1))
        low = (np.uint64(1) << bits) - np.uint64(1)
        keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        best = _sliding_min(keys, span)
        start = np.arange(len(best))
        doc = np.repeat(np.arange(len(part)), np.diff(part.offsets))[: len(best)]
        inside = start + length <= part.offsets[doc + 1]
        p, a, d = start[inside], (best[inside] & low).astype(np.int64), doc[inside]
        if not len(p):
            continue
        new = np.ones(len(p), bool)
        new[1:] = (a[1:] != a[:-1]) | (d[1:] != d[:-1])
        at = np.flatnonzero(new)
        ends = np.append(at[1:], len(p)) - 1
        base = texts.offsets[first]
        out.append((a[at] + base, p[at] + base, p[ends] + base, grams[a[at]]))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    a, b, c, d = (np.concatenate(x) for x in zip(*out))
    return a, b, c, d


def _sliding_min(keys: np.ndarray, span: int) -> np.ndarray:
    """Least of each `span` neighbours, from running minima of blocks in both directions."""
    n = len(keys)
    if n < span:
        return np.zeros(0, keys.dtype)
    rows = -(-n // span)
    blocks = np.full(rows * span, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = keys
    blocks = blocks.reshape(rows, span)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - span + 1], left[span - 1 : n])


def contexts(data: bytes, anchor, first, last, length: int = LENGTH) -> list[tuple[bytes, bytes]]:
    """Per anchor its suffix as far as a window reaches, and the text before it, reversed, from the first window on."""
    return [(data[a : q + length], data[p:a][::-1]) for a, p, q in zip(anchor.tolist(), first.tolist(), last.tolist())]


def shared(x: bytes, y: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be at least `start`."""
    n = min(len(x), len(y))
    if x[start:n] == y[start:n]:
        return n
    differ = int.from_bytes(x[start:n], "big") ^ int.from_bytes(y[start:n], "big")
    return n - (differ.bit_length() + 7) // 8


def front_code(rows: list[tuple[bytes, bytes]], many: list[bool]) -> bytes:
    """Sorted (suffix, left) as lengths shared with the row before, and the rest."""
    heads, rest, before = np.zeros((len(rows), 4), np.uint16), [], (b"", b"")
    for i, (x, y) in enumerate(rows):
        a, b = shared(before[0], x), shared(before[1], y)
        heads[i] = a, len(x), b, len(y)
        rest += [x[a:], y[b:]]
        before = (x, y)
    body = heads.T.tobytes() + np.packbits(many).tobytes() + b"".join(rest)
    return np.array([len(rows), len(body)], "<i8").tobytes() + pa.compress(body, "zstd", asbytes=True)


def front_decode(raw: bytes) -> tuple[list[tuple[bytes, bytes]], list[int], list[bool]]:
    """(rows, length each suffix shares with the one before, seen more than once)."""
    n, size = np.frombuffer(raw[:16], "<i8").tolist()
    body = pa.decompress(raw[16:], size, "zstd", asbytes=True)
    a, lx, b, ly = np.frombuffer(body[: 8 * n], np.uint16).reshape(4, n).tolist()
    at = 8 * n + (n + 7) // 8
    many = np.unpackbits(np.frombuffer(body[8 * n : at], np.uint8), count=n).astype(bool).tolist()
    rows, x, y = [], b"", b""
    for i in range(n):
        end = at + lx[i] - a[i]
        x = x[: a[i]] + body[at:end]
        at = end + ly[i] - b[i]
        y = y[: b[i]] + body[end:at]
        rows.append((x, y))
    return rows, a, many


def merge(stretches: list[tuple[list[tuple[bytes, bytes]], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """(stretch, row, length shared with the suffix before) in suffix order, by a loser tree.

    Every waiting suffix knows how much it shares with the last winner. The one
    that shares more is the lesser; on equal lengths the bytes from there on decide,
    and the loser then knows what it shares with the new winner.
    """
    k = 1
    while k < len(stretches):
        k *= 2
    rows = [s[0] for s in stretches]
    lcps = [s[1] for s in stretches]
    place = [0] * len(stretches)
    # A node holds the loser: its suffix (None: run out), what it shares with the winner that passed it, its stretch.
    loser: list[tuple[bytes | None, int, int]] = [(None, -1, -1)] * k

    def play(one, two):
        """(winner, loser)."""
        if one[0] is None:
            return two, one
        if two[0] is None or one[1] > two[1]:
            return one, two
        if two[1] > one[1]:
            return two, one
        h = shared(one[0], two[0], one[1])
        if one[0][h:] <= two[0][h:]:
            return one, (two[0], h, two[2])
        return two, (one[0], h, one[2])

    def begin(node: int):
        if node >= k:
            i = node - k
            return (rows[i][0][0], 0, i) if i < len(rows) and rows[i] else (None, -1, -1)
        winner, loser[node] = play(begin(2 * node), begin(2 * node + 1))
        return winner

    winner = begin(1) if k > 1 else begin(k)
    while winner[0] is not None:
        i = winner[2]
        yield i, place[i], winner[1]
        place[i] += 1
        at = place[i]
        now = (rows[i][at][0], lcps[i][at], i) if at < len(rows[i]) else (None, -1, -1)
        node = (k + i) // 2
        while node:
            now, loser[node] = play(now, loser[node])
            node //= 2
        winner = now


Intervals = list[tuple[int, int]]


def judge(order: list[tuple[bytes, bytes]], lcp: list[int], many: list[bool], length: int = LENGTH, gram: int = GRAM) -> list[Intervals]:
    """For each suffix in order, the distances d (low, high) whose windows are repeated."""
    out: list[Intervals] = [[] for _ in order]
    lo, n = 0, len(order)
    while lo < n:
        hi = lo + 1
        while hi < n and lcp[hi] >= gram:
            hi += 1
        if hi - lo > 1 or many[lo]:
            _judge_group(order, lcp, many, lo, hi, out, length)
        lo = hi
    return out


def _reach(row: tuple[bytes, bytes], length: int) -> tuple[int, int]:
    return length - len(row[0]), len(row[1])


def _judge_group(order, lcp, many, lo: int, hi: int, out: list[Intervals], length: int) -> None:
    places: dict[tuple[bytes, bytes], list[int]] = {}
    for i in range(lo, hi):
        places.setdefault(order[i], []).append(i)
    rows = list(places)
    once = []
    for j, row in enumerate(rows):
        at = places[row]
        if len(at) > 1 or many[at[0]]:
            full = [_reach(row, length)]
            for i in at:
                out[i] = full
        else:
            once.append(j)
    if not once or len(rows) == 1:
        return
    # Equal suffixes are neighbours in the order, so what two rows share is the least length between them.
    steps = [0] + [min(lcp[places[rows[j - 1]][-1] + 1 : places[rows[j]][0] + 1], default=0) for j in range(1, len(rows))]
    steps = [0] + [shared(rows[j - 1][0], rows[j][0], min(steps[j], len(rows[j][0]), len(rows[j - 1][0]))) for j in range(1, len(rows))]
    if len(rows) <= PAIRWISE:
        for j in once:
            found = []
            low, high = _reach(rows[j], length)
            for step, among in ((-1, range(j - 1, -1, -1)), (1, range(j + 1, len(rows)))):
                right = length
                for k in among:
                    right = min(right, steps[k + 1 if step < 0 else k])
                    a, b = max(low, length - right), min(high, shared(rows[j][1], rows[k][1]))
                    if a <= b:
                        found.append((a, b))
            out[places[rows[j]][0]] = joined(found)
        return
    by_left = sorted(range(len(rows)), key=lambda j: rows[j][1])
    left = [0] + [shared(rows[a][1], rows[b][1]) for a, b in zip(by_left, by_left[1:])]
    steps_, left_, rank = np.array(steps), np.array(left), np.empty(len(rows), np.int64)
    rank[by_left] = np.arange(len(rows))
    low, high = np.array([_reach(x, length) for x in rows]).T
    hit = np.zeros((len(rows), length + 1), bool)
    for d in range(int(low.min()), int(high.max()) + 1):
        able = np.flatnonzero((low <= d) & (high >= d))
        right_class, left_class = np.cumsum(steps_ < length - d)[able], np.cumsum(left_ < d)[rank[able]]
        _, back, n = np.unique(right_class * (len(rows) + 1) + left_class, return_inverse=True, return_counts=True)
        hit[able[n[back] > 1], d] = True
    for j in once:
        edge = np.flatnonzero(np.diff(np.concatenate(([False], hit[j], [False])).astype(np.int8)))
        out[places[rows[j]][0]] = [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2])]


def joined(found: Intervals) -> Intervals:
    """Intervals of whole numbers, merged where they meet."""
    out: Intervals = []
    for a, b in sorted(found):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _merge_part(length: int):
    def merged(table: pa.Table) -> pa.Table:
        w.keep_only()
        got = [front_decode(x) for x in table["payload"].to_pylist()]
        order, lcp, many, where = [], [], [], []
        for i, at, h in merge([(rows, shares) for rows, shares, _ in got]):
            order.append(got[i][0][at])
            lcp.append(h)
            many.append(got[i][2][at])
            where.append((i, at))
        verdicts = [[[] for _ in rows] for rows, _, _ in got]
        for (i, at), found in zip(where, judge(order, lcp, many, length)):
            verdicts[i][at] = found
        answers = []
        for mine in verdicts:
            n = np.array([len(x) for x in mine], "<u2")
            flat = np.array([v for x in mine for pair in x for v in pair], "<u2")
            answers.append(n.tobytes() + flat.tobytes())
        part = table["part"][0].as_py()
        return pa.table(
            {
                "run": table["run"].cast(pa.int64()),
                "part": pa.array([part] * len(got), pa.int64()),
                "n": pa.array([len(x) for x in verdicts], pa.int64()),
                "payload": pa.array(answers, pa.binary()),
            }
        )

    return merged


def _prefix(row: tuple[bytes, bytes]) -> int:
    """The suffix's first six bytes as a number of the same order; percentiles are exact on so many bits."""
    return int.from_bytes(row[0][:6], "big")


def repeated_bytes(docs: DataFrame, length: int = LENGTH, folder: str | None = None) -> DataFrame:
    """Per row of the documents: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept, the bytes that stay.

    A byte of the UTF-8 text goes if a string of `length` bytes that covers it also
    starts anywhere else, in the same document or another, as the texts came in.
    Null and empty texts and texts shorter than that lose nothing; rows that
    repeat a text repeat its strings. An empty table gives none; other columns
    are not read. `length` is at least 2 * GRAM.
    """
    folder = folder or shared_folder(docs.sparkSession, "suffixes")
    with batches_of(docs.sparkSession, BATCH_ROWS):
        packed = r.pack_files(docs, folder)
    for name in ("anchors", "sorted"):
        files.make_folder(f"{folder}/{name}")
    total, n_runs = packed.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)), F.count("*")).first()
    packed = packed.repartition(max(1, -(-int(n_runs) // RUNS_A_TASK)))
    parts = max(1, -(-int(total) // (40 * r.PART_VALUES)))
    r.exchange(packed.mapInArrow(_send_grams(folder, parts, length), r.SENT), f"{folder}/grams")
    # Bounds of the parts: quantiles of a sample's first bytes, merged from sketches.
    sampled = store(packed.mapInArrow(_sort_run(folder, length), "run long, n long, prefixes array<long>"), f"{folder}/prefixes")
    count = sampled.agg(F.sum("n")).first()[0] or 0
    hot: list[int] = []
    if count:
        parts = max(1, -(-int(count) // PART_SUFFIXES))
        at = [i / parts for i in range(1, parts)]
        cuts: list[int] = []
        if at:
            each = sampled.select(F.explode("prefixes").alias("p"))
            cuts = each.agg(F.percentile_approx("p", at, 20 * parts + 100)).first()[0]
        bounds = sorted(set(cuts))
        hot = [p for p in bounds if cuts.count(p) > 1]
        r.exchange(packed.mapInArrow(_send_sorted(folder, bounds, hot, length), r.SENT), f"{folder}/verdicts", _merge_part(length))
        if hot:
            files.make_folder(f"{folder}/hot")
            rows = sum(cuts.count(p) + 1 for p in hot) * PART_SUFFIXES
            several = max(1, -(-rows * (length - GRAM + 1) // r.PART_VALUES))
            r.exchange(packed.mapInArrow(_send_windows(folder, hot, several, length), r.SENT), f"{folder}/windows")
    return packed.mapInArrow(
        _remover(folder, length, bool(hot)), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def _send_grams(folder: str, parts: int, length: int):
    def send(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w.keep_only()
        for run, _, texts in r.opened_files(rows):
            anchor, first, last, grams = anchors_of(texts, length)
            # An anchor's fingerprint is the least of many: mixed again, the parts, cut by range, get as much each.
            values, back, n = np.unique(w.mix(grams) >> np.uint64(64 - FILTER_BITS), return_inverse=True, return_counts=True)
            r.save(f"{folder}/anchors/{run}", anchor=anchor, first=first, last=last, back=back.astype(np.uint32), n=np.array([len(values)]))
            yield r.send_values(run, values, None, n > 1, FILTER_BITS, parts)

    return send


def _sort_run(folder: str, length: int):
    def sort(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w.keep_only()
        for run, _, texts in r.opened_files(rows):
            got = r.load(f"{folder}/anchors/{run}")
            twice = np.flatnonzero(r.answered(f"{folder}/grams", run, int(got["n"][0]))[got["back"]])
            anchor, first, last = got["anchor"][twice], got["first"][twice], got["last"][twice]
            keys = contexts(texts.data.tobytes(), anchor, first, last, length)
            order = sorted(set(keys))
            index = {key: i for i, key in enumerate(order)}
            back = np.array([index[key] for key in keys], np.int64)
            del keys, index
            # Of each suffix in order one anchor that has it; its bytes stay in the text.
            one = np.empty(len(order), np.int64)
            one[back] = np.arange(len(back))
            r.save(
                f"{folder}/sorted/{run}",
                anchor=anchor,
                back=back.astype(np.uint32),
                one=one.astype(np.uint32),
                left=(anchor - first)[one].astype(np.int32),
                right=(last - anchor)[one].astype(np.int32),
                many=np.packbits(np.bincount(back, minlength=len(order)) > 1),
                n=np.array([len(order)]),
            )
            some = [_prefix(x) for x in order[:: max(1, len(order) // 200)]]
            yield pa.RecordBatch.from_pydict({"run": [run], "n": [len(order)], "prefixes": [some]}, schema=_SAMPLE)

    return sort


_SAMPLE = pa.schema([("run", pa.int64()), ("n", pa.int64()), ("prefixes", pa.list_(pa.int64()))])
_SENT = pa.schema([("part", pa.int64()), ("run", pa.int64()), ("payload", pa.binary())])


def _sorted(folder: str, run: int, texts: w.Texts, length: int) -> tuple[list[tuple[bytes, bytes]], list[bool]]:
    """A run's (suffix, left) in order, and which are there more than once."""
    got = r.load(f"{folder}/sorted/{run}")
    at = got["anchor"][got["one"]]
    order = contexts(texts.data.tobytes(), at, at - got["left"], at + got["right"], length)
    return order, np.unpackbits(got["many"], count=len(order)).astype(bool).tolist()


def _send_sorted(folder: str, bounds: list[int], hot: list[int], length: int):
    def send(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w.keep_only()
        for run, _, texts in r.opened_files(rows):
            order, many = _sorted(folder, run, texts, length)
            if not order:
                continue
            if hot:
                cold = [i for i, x in enumerate(order) if _prefix(x) not in hot]
                order, many = [order[i] for i in cold], [many[i] for i in cold]
            part = np.searchsorted(bounds, [_prefix(x) for x in order], "right") if bounds else np.zeros(len(order), np.int64)
            cut = np.searchsorted(part, np.arange(len(bounds) + 2))
            out: dict[str, list] = {"part": [], "run": [], "payload": []}
            for p, (lo, hi) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
                if lo < hi:
                    out["part"].append(p)
                    out["run"].append(run)
                    out["payload"].append(front_code(order[lo:hi], many[lo:hi]))
            yield pa.RecordBatch.from_pydict(out, schema=_SENT)

    return send


def window_values(rows: list[tuple[bytes, bytes]], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints (64 and 32 bits) of all windows of each (suffix, left), in text order."""
    values, checks = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
    for lo in range(0, len(rows), 4_000):
        texts = [left[::-1] + suffix for suffix, left in rows[lo : lo + 4_000]]
        data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
        at = np.concatenate([np.arange(e - len(t), e - length + 1) for t, e in zip(texts, ends.tolist())])
        values.append(w.span_hashes(data, at, at + length))
        # Other values of the same bytes make it another polynomial.
        checks.append((w.span_hashes(data ^ np.uint8(0xA5), at, at + length) >> np.uint64(32)).astype(np.uint32))
    return np.concatenate(values), np.concatenate(checks)


def _send_windows(folder: str, hot: list[int], parts: int, length: int):
    def send(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w.keep_only()
        for run, _, texts in r.opened_files(rows):
            order, many = _sorted(folder, run, texts, length)
            if not order:
                continue
            mine = np.array([i for i, x in enumerate(order) if _prefix(x) in hot], np.int64)
            some = [order[i] for i in mine.tolist()]
            values, checks = window_values(some, length)
            size = np.array([len(x) + len(y) - length + 1 for x, y in some], np.int64)
            sorting = np.lexsort((checks, values))
            v, c = values[sorting], checks[sorting]
            new = np.ones(len(v), bool)
            new[1:] = (v[1:] != v[:-1]) | (c[1:] != c[:-1])
            back = np.empty(len(v), np.uint32)
            back[sorting] = np.cumsum(new) - 1
            twice = np.bincount(back, minlength=int(new.sum())) > 1
            twice[back[np.repeat(np.array([many[i] for i in mine.tolist()], bool), size)]] = True
            left = np.array([len(y) for _, y in some], np.int64)
            r.save(f"{folder}/hot/{run}", row=mine, size=size, left=left, back=back, n=np.array([len(twice)]))
            yield r.send_values(run, v[new], c[new], twice, 64, parts)

    return send


def _hot_verdicts(folder: str, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row in the run's order, number of intervals, intervals of distances) of a run's hot suffixes."""
    got = r.load(f"{folder}/hot/{run}")
    found = r.answered(f"{folder}/windows", run, int(got["n"][0]))[got["back"]]
    row = np.repeat(np.arange(len(got["row"])), got["size"])
    edge = np.ones(len(row) + 1, bool)
    edge[1:-1] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    at = np.flatnonzero(edge)
    lo, hi = at[:-1], at[1:] - 1
    lo, hi = lo[found[lo]], hi[found[lo]]
    first = np.cumsum(got["size"]) - got["size"]
    distance = (got["left"] + first)[row[lo]]
    return got["row"], np.bincount(row[lo], minlength=len(got["row"])), np.stack((distance - hi, distance - lo), axis=1)


def _covered(folder: str, run: int, n: int, length: int, some_hot: bool) -> np.ndarray:
    """Which bytes of a run go."""
    got = r.load(f"{folder}/sorted/{run}")
    if not int(got["n"][0]):
        return np.zeros(n, bool)
    # Hot suffixes first, then those of the order.
    hot, count, pair = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
    if some_hot:
        hot, count, pair = _hot_verdicts(folder, run)
    counts, pairs, at = [count], [pair], 0
    if len(hot) < int(got["n"][0]):
        verdicts = r.load(f"{folder}/verdicts/{run}")
        raw = verdicts["payload"].tobytes()
        for k, size in zip(verdicts["n"].tolist(), verdicts["size"].tolist()):
            counts.append(np.frombuffer(raw[at : at + 2 * k], "<u2"))
            pairs.append(np.frombuffer(raw[at + 2 * k : at + size], "<u2").reshape(-1, 2))
            at += size
    each, pair = np.concatenate(counts).astype(np.int64), np.concatenate(pairs).astype(np.int64)
    place = np.concatenate((hot, np.delete(np.arange(int(got["n"][0])), hot)))
    count, start = np.empty(len(each), np.int64), np.empty(len(each), np.int64)
    count[place], start[place] = each, np.cumsum(each) - each
    mine = count[got["back"]]
    which = np.repeat(start[got["back"]] - (np.cumsum(mine) - mine), mine) + np.arange(int(mine.sum()))
    anchor = np.repeat(got["anchor"], mine)
    return _marked(n, anchor - pair[which, 1], anchor - pair[which, 0] + length)


def _marked(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which of n bytes lie in a stretch lo[i]:hi[i], none of them empty."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    # Stretches that meet are one: a byte begins or ends one at most, so that a byte of memory counts for it.
    new = np.ones(len(lo) + 1, bool)
    new[1:-1] = lo[1:] > hi[:-1]
    edge = np.zeros(n + 1, np.int8)
    edge[lo[new[:-1]]] = 1
    edge[hi[new[1:]]] = -1
    return np.cumsum(edge[:n], dtype=np.int8).view(bool)


def _remover(folder: str, length: int, some_hot: bool):
    def remove(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w.keep_only()
        for run, ids, texts in r.opened_files(rows):
            gone = _covered(folder, run, len(texts.data), length, some_hot)
            for lo, hi, part in w.slices(texts):
                base = texts.offsets[lo]
                here = gone[base : base + len(part.data)]
                begins = here.copy()
                begins[1:] &= ~here[:-1]
                inner = part.offsets[(part.offsets > 0) & (part.offsets < len(here))]
                begins[inner] = here[inner]
                kept = [part.data[a:b][~here[a:b]].tobytes() for a, b in zip(part.offsets[:-1], part.offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo),
                        pa.array(np.diff(part.offsets), pa.int64()),
                        pa.array(w.per_document(here, part.offsets), pa.int64()),
                        pa.array(w.per_document(begins, part.offsets), pa.int64()),
                        pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                        pa.array(kept, pa.binary()),
                    ],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
                )

    return remove

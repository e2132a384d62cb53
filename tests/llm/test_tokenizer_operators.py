"""Alignment, fill-in-middle and packing against plain versions, on small tables full of edge cases."""

import hashlib
import random
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F, types as T
from tokenizers import Tokenizer

from pulsetide.llm import align, chars, middle, packing, queries, segments, words as w

A, B = public_tokenizers.path(queries.BYTE_LEVEL), public_tokenizers.path(queries.PIECES)
DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("n", "form", "ids", "row", "groups", "h1", "part")]
)
PARTS = [*"abcXY é漢字\U0001F600 　  \t\n  '.s0123<>|▁ß\u0085\x1c", "<|endoftext|>", " the", " don't", "  ", "<s>", "한국", "привет ", "<P>"]


def strange_texts(n, seed=3, most=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(1, most))) for _ in range(n)]


def prose(rng, n, names=("river", "stone", "garden", "cloud", "été", "straße")):
    return " ".join(rng.choice(names) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    copy = prose(rng, 90)
    long = prose(rng, 9_000)
    return [None, "", " ", "  ", "a", "▁", "a▁ b", copy, copy, long, "x" * 5_000, "漢" * 3_000, *strange_texts(150), *(prose(rng, rng.randrange(5, 700)) for _ in range(60))]


def table(spark, texts, start=0):
    rows = [(start + i, t, *["clash"] * 7) for i, t in enumerate(texts)]
    rows += [(None, "no id at all", *["clash"] * 7), (None, None, *["clash"] * 7), (start + 7, texts[7], *["clash"] * 7)] if texts else []
    return spark.createDataFrame(rows, DOCS).repartition(4)


@pytest.fixture(scope="module")
def docs(spark, texts):
    return table(spark, texts).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def same(got, expected):
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


# Characters and segments


@pytest.mark.parametrize("text", ["", "plain", "é", "a漢b\U0001F600", "漢字\U0001F600é" * 30 + "tail"])
def test_exceptions_turn_places_both_ways(text):
    raw = text.encode()
    index = chars.Exceptions(np.frombuffer(raw, np.uint8))
    ends = np.cumsum([0] + [len(c.encode()) for c in text])
    assert index.bytes(np.arange(len(text) + 1)).tolist() == ends.tolist()
    assert index.chars(ends).tolist() == list(range(len(text) + 1))
    assert len(index.byte) == sum(ord(c) > 127 for c in text)


def test_segments_are_encoded_like_the_whole(texts):
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    found = w.texts_of(pa.array(texts, pa.string()))
    start, stop, first = segments.segments_of(found)
    raw = found.data.tobytes()
    for i, text in enumerate(texts):
        parts = [raw[s:e].decode() for s, e in zip(start[first[i] : first[i + 1]], stop[first[i] : first[i + 1]])]
        assert "".join(parts) == (text or "")
        ids = [t for p in parts for t in tokenizer.encode(p, add_special_tokens=False).ids]
        assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids


# Alignment


def plain_alignment(rows):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    alphabet = align.byte_alphabet()
    per, counts = [], Counter()
    for doc, text in rows:
        raw = (" " + (text or "")).encode()
        ia, ib = a.encode(raw.decode(), add_special_tokens=False).ids, b.encode(text or "")
        xa = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ia]
        xb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ib for p in [b.id_to_piece(i)]]
        if not text or b"".join(xa) != raw or b"".join(xb) != raw:
            per.append((doc, None))
            continue
        owner_a, owner_b = (np.repeat(np.arange(len(x)), [len(v) for v in x]) for x in (xa, xb))
        links = [(ia[i], ib[j]) for i, j in sorted(set(zip(owner_a.tolist(), owner_b.tolist())))]
        ends_a, ends_b = (np.cumsum([len(v) for v in x]).tolist() for x in (xa, xb))
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, low = [], 0
        for cut in cuts:
            one, two = (ids[bisect_right(ends, low) : bisect_right(ends, cut)] for ids, ends in ((ia, ends_a), (ib, ends_b)))
            groups.append(",".join(map(str, one)) + "|" + ",".join(map(str, two)))
            low = cut
        counts.update(links)
        per.append((doc, (len(ia), len(ib), len(groups), links, ";".join(groups))))
    highest = Counter()
    for (_, j), n in counts.items():
        highest[j] = max(highest[j], n)
    for doc, found in per:
        if found is None:
            yield doc, 0, 0, 0, 0, 0, 0, ""
        else:
            n_a, n_b, n_groups, links, groups = found
            yield doc, n_a, n_b, n_groups, len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), groups


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def test_alignment_equals_the_plain_one(docs, tmp_path):
    rows = align.align(docs, A, B, str(tmp_path))
    same([tuple(r) for r in rows.select(*COLUMNS).collect()], plain_alignment(rows_of(docs)))


def test_counts_in_many_files(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(align, "FILE_PAIRS", 30)
    whole = align.align(docs, A, B, str(tmp_path / "files"))
    assert len(list((tmp_path / "files" / "counts").glob("*.codes"))) > 5, spark.read.parquet(str(tmp_path / "files" / "pairs")).count()
    same([tuple(r) for r in whole.select(*COLUMNS).collect()], plain_alignment(rows_of(docs)))


def test_whole_texts_where_segments_do_not_hold(texts):
    found = w.texts_of(pa.array(texts, pa.string()))
    tool = align.Aligner(A, B)
    per, groups, links = tool.align(found)
    tool = align.Aligner(A, B)
    tool.apart = False
    per_whole, groups_whole, links_whole = tool.align(found)
    assert (per == per_whole).all() and groups == groups_whole and (links == links_whole).all()


def test_groups_are_shown_as_bytes():
    """a string for each group cost as much as a tokenizer."""
    rng = np.random.default_rng(5)
    tool = align.Aligner(A, B)
    a, b = rng.integers(0, 10 ** rng.integers(1, 5, 900)), rng.integers(0, 10 ** rng.integers(1, 5, 700))
    last_a, last_b = (np.append(np.sort(rng.choice(np.arange(1, n), 399, replace=False)), n) for n in (900, 700))
    shown, at = tool._shown(a, b, last_a, last_b)
    lists = [[x.tolist() for x in np.split(ids, last[:-1])] for ids, last in ((a, last_a), (b, last_b))]
    plain = [(",".join(map(str, x)) + "|" + ",".join(map(str, y)) + ";").encode() for x, y in zip(*lists)]
    assert [shown[lo:hi] for lo, hi in zip(at[:-1], at[1:])] == plain


def test_learned_segments_leave_room_for_the_next(texts):
    """each slice copied all that was known."""
    tool = align.Aligner(A, B)
    tool.align(w.texts_of(pa.array(texts, pa.string())))
    links, counts = tool.links, tool.counts
    tool.align(w.texts_of(pa.array(["Qzv unseen wordxq"], pa.string())))
    assert tool.links is links and tool.counts is counts


def test_a_span_that_shares_a_character_is_refined():
    # Three tokens of one character of three bytes, between two tokens whose spans are their own.
    first, last, sizes = np.array([0, 1, 1, 1, 4]), np.array([1, 4, 4, 4, 6]), np.array([1, 1, 1, 1, 2])
    assert align.refined_ends(first, last, sizes).tolist() == [1, 2, 3, 4, 6]


def test_alignment_of_nothing(empty, tmp_path):
    rows = align.align(empty, A, B, str(tmp_path))
    assert sorted(rows.columns) == sorted(COLUMNS) and rows.count() == 0


def test_query_of_alignment(spark, sf):
    docs = queries.table(spark, sf, "documents")
    rows = queries.op11_alignment(spark, sf).collect()
    wanted = [(d, *n, hashlib.sha256(g.encode()).hexdigest() if g else "") for d, *n, g in plain_alignment(rows_of(docs))]
    same([tuple(r[c] for c in (*COLUMNS[:-1], "groups_sha256")) for r in rows], wanted)


def test_codes_of_large_vocabularies(docs, tmp_path, monkeypatch):
    """64-bit codes give the same as 32-bit ones."""

    def wide(*paths):
        tool = align.Aligner(*paths)
        tool.narrow = False
        tool.known._clear()
        return tool

    got = {}
    texts = w.texts_of(pa.array([t for _, t in rows_of(docs)], pa.string()))
    for name, make in (("narrow", align.Aligner), ("wide", wide)):
        per, groups, flat = make(A, B).align(texts)
        got[name] = per.tolist(), groups, align._wide(flat).tolist()
    assert got["narrow"] == got["wide"]


# Fill-in-middle


def plain_middle(doc, text):
    text = text or ""
    digits = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc, n, "plain", None, None, text
    parts = text[:lo], text[lo:hi], text[hi:]
    if h4 % 100 < 20:
        return doc, n, "spm", lo, hi - lo, f"<S>{parts[2]}<P>{parts[0]}<M>{parts[1]}"
    return doc, n, "psm", lo, hi - lo, f"<P>{parts[0]}<S>{parts[2]}<M>{parts[1]}"


def test_middle_equals_the_plain_one(docs):
    rows = middle.fill_in_middle(docs).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    same([tuple(r) for r in rows.collect()], [plain_middle(*r) for r in rows_of(docs)])


def test_outputs_give_back_the_texts(docs):
    rows = middle.fill_in_middle(docs).select("doc_id", "form", middle.restored(F.col("output"), F.col("form")).alias("text")).collect()
    same([(r["doc_id"], r["text"]) for r in rows], [(d, t or "") for d, t in rows_of(docs)])
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}


def test_other_markers_and_rates(docs):
    marks = ("(|p.", "[s]", "$m")
    rows = middle.fill_in_middle(docs, rate=100, suffix_first=50, seed=9, markers=marks)
    back = rows.select("doc_id", "form", middle.restored(F.col("output"), F.col("form"), marks).alias("text")).collect()
    same([(r["doc_id"], r["text"]) for r in back], [(d, t or "") for d, t in rows_of(docs)])
    assert sum(r["form"] == "plain" for r in back) == sum(not t or any(m in t for m in marks) for _, t in rows_of(docs))


def test_middle_of_nothing(empty):
    assert middle.fill_in_middle(empty).count() == 0


# Packing


def test_packing_holds_every_id_once(docs, tmp_path):
    tokenizer = Tokenizer.from_file(A)
    sequences = packing.pack(docs, A, folder=str(tmp_path))
    pieces = [tuple(r) for r in packing.pieces_of(sequences).select("sequence_id", "offset", "doc_id", "start", "length", "doc_tokens", "ids").collect()]
    filled = Counter()
    for sequence, offset, _, _, length, *_ in sorted(pieces, key=lambda p: p[:2]):
        assert offset == filled[sequence]
        filled[sequence] += length
    assert sorted(filled) == list(range(len(filled)))
    assert all(n <= 2048 and n & (n - 1) == 0 for n in filled.values())
    # Rows of one id, and those of none, are told apart by their length.
    built, wanted = {}, Counter()
    for doc, text in rows_of(docs):
        wanted[doc, tuple([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])] += 1
    for p in pieces:
        own = np.frombuffer(p[6], "<u4").tolist()
        assert len(own) == p[4]
        built.setdefault((p[2], p[5]), []).append((p[3], own))
    for (doc, size), found in built.items():
        ids = [k[1] for k in wanted if k[0] == doc and len(k[1]) == size]
        assert len(ids) == 1
        covered = Counter(i for start, own in found for i in range(start, start + len(own)))
        assert covered == Counter({i: wanted[doc, ids[0]] for i in range(size)})
        assert all(tuple(own) == ids[0][start : start + len(own)] for start, own in found)
    assert len(built) == len({(d, len(i)) for d, i in wanted})


def test_words_are_encoded_many_in_one_string(texts):
    """a string for each distinct word costs more than its encoding."""
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyzäñé") for _ in range(9)) for _ in range(6_000)})
    encoder = packing.Encoder(A)
    plain, calls = encoder.tokenizer, []

    class Counting:
        def encode_batch_fast(self, found, **how):
            calls.append(len(found))
            return plain.encode_batch_fast(found, **how)

    encoder.tokenizer = Counting()
    found = [" ".join(words), *strange_texts(300), *(t for t in texts if t), " ".join(words[::-1])]
    got = encoder.encode(w.texts_of(pa.array([" ".join(words)])), 1) + encoder.encode(w.texts_of(pa.array(found)), 1)
    assert [x.tolist() for x in got] == [plain.encode(t, add_special_tokens=False).ids + [1] for t in found[:1] + found]
    assert calls[0] < len(words) / 20


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 500])
def test_neighbours_come_by_falling_score(n):
    """all documents of a shard were sorted for each seed, of which a window takes a few."""
    scores = np.random.default_rng(n).integers(0, 40, n) / 8
    assert list(packing._best_first(scores)) == np.argsort(-scores, kind="stable").tolist()


def test_telling_ids_of_short_documents():
    row, term, times = packing._terms(np.array([7, 7, 9, 3, 5, 5, 8], np.uint16), np.array([3, 1, 3]))
    assert [x.tolist() for x in packing.telling(row, term, times)] == [[7, 3, 5], [9, 3, 8]]


def test_query_of_packing(spark, sf):
    rows = queries.op13_packing(spark, sf).collect()
    tokenizer = Tokenizer.from_file(A)
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, sf, "documents").collect()}
    ids = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for d, t in texts.items()}
    assert {r["doc_id"] for r in rows} == set(ids)
    for r in rows:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["doc_tokens"] == len(ids[r["doc_id"]]) and r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))


def plain_scores(docs, seed, idf, mean):
    seed_terms = set(docs[seed].tolist())
    out = []
    for ids in docs:
        tf = Counter(ids.tolist())
        out.append(sum(idf[t] * tf[t] * (packing.K1 + 1) / (tf[t] + packing.K1 * (1 - packing.B + packing.B * len(ids) / mean)) for t in seed_terms if t in tf))
    return out


def test_index_scores_are_bm25():
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 30, rng.integers(1, 40)).astype(np.uint32) for _ in range(25)]
    idf = rng.random(30)
    index = packing.Index(docs, idf, 17.0)
    for seed in range(25):
        assert np.allclose(index.scores(seed), plain_scores(docs, seed, idf, 17.0))


def test_frequencies_are_those_of_all_documents(docs, tmp_path):
    stored = packing.encoded(docs, A, f"{tmp_path}/ids", 2048)
    idf, mean, rests = packing.statistics(stored, 2048)
    tokenizer = Tokenizer.from_file(A)
    ids = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows_of(docs)]
    df = Counter(i for x in ids for i in set(x))
    n, left = len(ids), [len(x) % 2048 for x in ids if len(x) % 2048]
    assert (rests, mean) == (len(left), sum(left) / len(left))
    assert all(np.isclose(idf[i], np.log(1 + (n - k + 0.5) / (k + 0.5))) for i, k in df.items())


def test_neighbours_are_lexically_close(spark, tmp_path):
    """Documents of many topics, shuffled: most pieces of a sequence are of one topic."""
    rng = random.Random(8)
    topics = [[f"{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}{x}{k}zq" for x in "abcdefghij"] for k in range(12)]
    topic = [rng.randrange(12) for _ in range(400)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(topics[t]) for _ in range(60))) for i, t in enumerate(topic)], "doc_id long, text string")
    pieces = packing.pieces_of(packing.pack(docs, A, folder=str(tmp_path))).select("sequence_id", "doc_id").collect()
    held = {}
    for r in pieces:
        held.setdefault(r["sequence_id"], []).append(topic[r["doc_id"]])
    most = sum(Counter(x).most_common(1)[0][1] for x in held.values())
    assert most / len(pieces) > 0.7


@pytest.mark.parametrize("n", [1, 3, 1000, 2047, 2049, 5000])
def test_what_is_left_is_cut_at_powers_of_two(n):
    packer = packing._Packer(2048, np.ones(10), 5.0)
    packer.shard([(1, np.arange(n, dtype=np.uint32) % 7, 0, n)])
    packer.finish()
    sizes = [len(raw) // 4 for raw, _ in packer.done]
    assert sum(sizes) == n and all(s & (s - 1) == 0 for s in sizes)
    assert [p["start"] for _, pieces in packer.done for p in pieces] == [sum(sizes[:i]) for i in range(len(sizes))]


def test_packing_of_nothing(empty, tmp_path):
    assert packing.pieces_of(packing.pack(empty, A, folder=str(tmp_path))).count() == 0


def test_a_worker_drops_what_other_operators_left():
    mine, other = w.worker_cache(), w.worker_cache()
    mine["a"], other["b"] = 1, 2
    w.powers(w.BASE, 3 * w.SLICE_BYTES // 2)
    w.keep_only(mine)
    assert mine == {"a": 1} and other == {} and int(w.BASE) not in w._powers
    assert len(w.powers(w.BASE, 10)) == 10

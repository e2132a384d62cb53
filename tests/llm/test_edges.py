"""Secrets, archives and benchmarks at their edges: long runs, long headers, items without id, clashing names."""

import hashlib
import random
import string
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from pulsetide.llm import decontaminate, langid, near_dup, queries, secrets, warc, words as w
from tests.llm.test_operators import brute_components

RANKS = public_tokenizers.path(queries.RANKS)
LETTERS = string.ascii_letters


def found(text):
    return secrets.spans_of(text, secrets.vocabulary(RANKS))


def plain_base(text):
    """The three base forms, character by character."""
    out = []
    key = set(string.ascii_letters + string.digits + "+/_.=-")

    def assigned(i):
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if text[i : i + len(word)].translate(LOWER) == word:
                j = i + len(word)
                j += text[j : j + 1] in ("'", '"')
                while text[j : j + 1] == " ":
                    j += 1
                if text[j : j + 1] not in (":", "="):
                    continue
                # One sign of assignment; a second one may be the value's first character.
                j += 1
                while text[j : j + 1] == " ":
                    j += 1
                j += text[j : j + 1] in ("'", '"') and text[j : j + 1] != ""
                end = j
                while end < len(text) and text[end] in key:
                    end += 1
                if end > j:
                    return j, end
        return None

    i = 0
    while i < len(text):
        hit = assigned(i)
        if hit:
            if hit[1] - hit[0] >= 6:
                out.append((i, 0, hit[1]))
            i = hit[1]
        else:
            i += 1
    for kind, prefix, allowed, least in ((1, "AKIA", string.ascii_uppercase + string.digits, 20), (2, "", "0123456789abcdef", 24)):
        i = 0
        while i < len(text):
            end = i + len(prefix)
            while text.startswith(prefix, i) and end < len(text) and text[end] in allowed:
                end += 1
            if end > i + len(prefix):
                if end - i >= least:
                    out.append((i, kind, end))
                i = end
            else:
                i += 1
    return sorted(out)


LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def test_base_forms_on_whole_texts(spark, sf):
    rng = random.Random(2)
    parts = ["password", "API_KEY", "apikey", "Token", "secret", " ", "  ", ":", "=", '"', "'", "AKIA", "AKIAAKIA", "0123456789abcdef", "deadbeef" * 3, "X9" * 9, "é", "\n", "a-b/c", "漢"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(1500)]
    for text in texts:
        assert [s for s in found(text) if s[1] < 3] == plain_base(text), text
    docs = queries.table(spark, sf, "documents")
    rows = {r["doc_id"]: r for r in queries.op1_secrets(spark, sf).collect()}
    for doc, text in docs.select("doc_id", "text").collect():
        base = plain_base(text or "")
        row = rows[doc]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(s[1] == k for s in base) for k in range(3))
        assert row.base_sha256 == hashlib.sha256(secrets.listed(base).encode()).hexdigest()
        assert set(secrets.listed(base).split(",")) - {""} <= set(row.spans.split(","))


@pytest.mark.parametrize("alphabet", [LETTERS, string.ascii_lowercase, LETTERS + string.digits, string.ascii_lowercase + string.digits])
def test_random_strings_are_found_alone_and_behind_words(alphabet):
    rng = random.Random(11)
    hits = {"alone": 0, "path": 0}
    for _ in range(200):
        key = "".join(rng.choice(alphabet) for _ in range(32))
        for name, text in (("alone", f"see {key} there"), ("path", f"/api/v2/organizations/projects/webhooks/incoming/{key}")):
            at = text.index(key)
            covered = sum(max(0, min(e, at + 32) - max(s, at)) for s, k, e in found(text) if k == 3)
            hits[name] += covered >= 24
    assert min(hits.values()) >= 190, hits


def test_known_forms_and_words_are_left_alone():
    digest = hashlib.sha1(b"x").hexdigest()
    for text in (
        digest.upper(), f"/commit/{digest.upper()}/files", "123e4567-E89B-12d3-a456-426614174000", "2024-01-31T00-00-00-000000000000",
        "getResponseHeaderValuesForRequestHandlerFactory", "this_is_a_long_variable_name_for_the_request", "/usr/local/share/applications/settings",
        "=" * 200, "-_" * 300, "0123456789" * 30,
    ):
        assert [s for s in found(text) if s[1] == 3] == [], text


@pytest.mark.parametrize(
    "text",
    ["a" * 1_000_000, "lorem/ipsum-dolor_" * 60_000, "".join(random.Random(1).choice(LETTERS) for _ in range(10_000)), "abc" * 16 + "=b", "f" * 500_000, "/".join(["ordinary", "words"] * 50_000) + "/x=A1"],
)
def test_long_runs_take_linear_time(text):
    secrets.vocabulary(RANKS)
    start = time.perf_counter()
    found(text)
    assert time.perf_counter() - start < 5


PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize("length", [100, 40_000, 1_200_000, 3_000_000])
def test_headers_of_any_length_lose_no_record(spark, tmp_path, length):
    rows = [(i, "http://x/" + "u" * (length if i == 2 else 3), f"<p>{i}</p>" * 200) for i in range(1, 5)]
    pages = spark.createDataFrame(rows, PAGES).coalesce(1)
    archives = warc.write_archives(pages, str(tmp_path))
    out = {r["page_id"]: (r["url"], r["payload"]) for r in warc.read_archives(archives, str(tmp_path), stretch=2_500).collect()}
    assert out == {i: (url, html.encode()) for i, url, html in rows}


def test_a_broken_chain_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "x" * 500) for i in range(20)], PAGES).coalesce(1)
    archives = warc.write_archives(pages, str(tmp_path))
    path = archives.first()["path"].removeprefix("file:")
    with open(path, "r+b") as file:
        raw = file.read()
        at = raw.index(b"Content-Length: ", len(raw) // 2)
        file.seek(at)
        file.write(b"Content-Length: 9")
    with pytest.raises(ValueError, match="unbroken chain"):
        warc.read_archives(archives, str(tmp_path)).count()


WORDS = [f"w{i}" for i in range(40)]


def test_items_without_id_hit_but_have_no_name(spark):
    bench = spark.createDataFrame([(None, " ".join(WORDS[:20])), ("b", " ".join(WORDS[5:19])), (None, "one two"), ("c", None)], "item_id string, text string")
    docs = spark.createDataFrame([(1, " ".join(WORDS)), (2, "say one two three"), (3, "nothing here")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.contamination(docs, bench).collect()}
    assert [(got[i].n_hit, got[i].n_items, got[i].contaminated) for i in (1, 2, 3)] == [(20, 1, True), (2, 0, True), (0, 0, False)]
    assert got[1].items_sha256 == hashlib.sha256(b"b").hexdigest() and got[2].items_sha256 == hashlib.sha256(b"").hexdigest()


def test_columns_of_any_name_stay(spark):
    bench = spark.createDataFrame([("a", " ".join(WORDS[:13]))], "item_id string, text string")
    names = ["_hit", "_items", "_spans", "_words", "hit", "items", "spans", "words", "_Words"]
    docs = spark.createDataFrame([(1, " ".join(WORDS), *names[:-1])], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names[:-1]))
    for most in (500_000, 1):
        row = decontaminate.contamination(docs, bench, most=most).first()
        assert row.n_hit == 13 and [row[n] for n in names[:-1]] == names[:-1]
    assert decontaminate.clean_documents(docs, bench).columns == docs.columns


def test_rounds_are_stored_and_bounded(spark, tmp_path, monkeypatch):
    """A long item's windows go over many rounds, none with many more than it may hold."""
    sizes = []
    real = decontaminate._sets

    def counted(windows):
        sizes.append(windows.num_rows)
        return real(windows)

    monkeypatch.setattr(decontaminate, "_sets", counted)
    words = [f"v{i}" for i in range(2_000)]
    bench = spark.createDataFrame([("long", " ".join(words))], "item_id string, text string")
    docs = spark.createDataFrame([(1, " ".join(words[100:900])), (2, "other " * 30)], "doc_id long, text string")
    got = sorted(map(tuple, decontaminate.contamination(docs, bench, most=300, folder=str(tmp_path)).select("doc_id", "n_hit", "n_items").collect()))
    assert got == [(1, 800, 1), (2, 0, 0)]
    assert len(sizes) == 7 and sum(sizes) == 1_988 and max(sizes) < 450
    assert len(list(tmp_path.glob("round-*"))) == 6


# Language: the network in plain steps, and its sample


def plain_forward(net, x):
    """Softmax over the largest response of each filter, position by position."""
    widest, pooled = max(langid.WIDTHS), []
    for table in net.tables:
        responses = [sum(table[j][x[:, i + j]] for j in range(len(table))) for i in range(x.shape[1] - widest)]
        pooled.append(np.max(responses, axis=0))
    raw = np.maximum(np.concatenate(pooled, axis=1) + net.bias, 0) @ net.out + net.out_bias
    e = np.exp(raw - raw.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def small_network(seed=0):
    rng = np.random.default_rng(seed)
    kinds = len(langid.WIDTHS) * langid.FILTERS
    tables = [rng.normal(0, 0.3, (k, langid.CLASSES, langid.FILTERS)).astype(np.float64) for k in langid.WIDTHS]
    return langid.Network(["a", "b", "c"], tables, rng.normal(0, 0.1, kinds), rng.normal(0, 0.3, (kinds, 3)), rng.normal(0, 0.1, 3))


def some_windows(n=6, length=langid.WINDOW):
    rng = np.random.default_rng(1)
    x = np.zeros((n, length + max(langid.WIDTHS)), np.uint8)
    x[:, :length] = rng.integers(1, langid.CLASSES, (n, length))
    x[1, 20:] = 0
    return x


def test_look_ups_equal_the_plain_forward_pass():
    net, x = small_network(), some_windows()
    assert np.allclose(net.predict(x, net.pairs()), plain_forward(net, x), atol=1e-5)


def test_gradients_are_those_of_the_loss():
    net, x = small_network(2), some_windows(4, 40)
    label, weight = np.array([0, 1, 2, 1]), np.array([1.0, 0.5, 2.0, 1.0])

    def loss():
        return -(weight * np.log(plain_forward(net, x)[np.arange(4), label])).sum() / 4

    rng = np.random.default_rng(3)
    for values, grads in zip([*net.tables, net.bias, net.out, net.out_bias], langid._gradients(net, x, label, weight)):
        moved = np.argwhere(np.abs(grads) > 1e-6)
        for at in map(tuple, moved[rng.permutation(len(moved))[:6]]):
            old, step = values[at], 1e-6
            values[at] = old + step
            high = loss()
            values[at] = old - step
            low = loss()
            values[at] = old
            assert np.isclose((high - low) / (2 * step), grads[at], rtol=1e-3, atol=1e-6)


def test_copies_are_one_piece_and_crowd_out_nothing(spark):
    ids = [i for i in range(4_000) if zlib.crc32(str(i).encode()) % 4 != langid.HELD_OUT]
    rows = [(i, "copied text " * 3 if n % 4 else f"text number {n} of the language", "aa") for n, i in enumerate(ids)]
    rows += [(i, f"autre texte {i} " * 100, "bb") for i in range(5_000, 5_020)] + [(None, "x", "bb"), (9_000, None, "bb"), (9_001, "", "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.sample(docs, per_language=50).collect()
    per = Counter(r["lang"] for r in got)
    assert per["aa"] == 50 and 10 <= per["bb"] <= 20
    assert max(Counter(r["piece"] for r in got).values()) == 1
    assert all(len(r["piece"]) <= langid.WINDOW for r in got)


def test_very_long_and_repeated_texts_are_judged_whole(spark):
    words = {"aa": "nabu teko rila moso".split(), "bb": "grück schtal pfend zwirk".split()}
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(40)), lang) for i in range(300) for lang in [("aa", "bb")[i % 2]]]
    long = " ".join(rng.choice(words["aa"]) for _ in range(300_000))
    rows += [(1_000, long, None), (1_001, "grück " * 10 + long, None), (1_001, "grück " * 10 + long, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [(r["doc_id"], r["lang_pred"]) for r in langid.identify(docs, per_language=100, epochs=6).collect()]
    assert sorted(x for x in got if x[0] >= 1_000) == [(1_000, "aa"), (1_001, "aa"), (1_001, "aa")]


# Near duplicates: families below the threshold


def family(rng, n, similarity, size=400):
    """Texts whose shingle sets are about as similar to each other as asked for: a common core, and words of their own."""
    own = round(size * (1 - similarity) / (1 + similarity))
    core = [f"c{rng.randrange(10**9)}" for _ in range(size + 4 - own)]
    return [" ".join([*core, *(f"o{rng.randrange(10**9)}" for _ in range(own))]) for _ in range(n)]


@pytest.mark.parametrize("similarity", [0.60, 0.70, 0.73])
def test_families_below_the_threshold_make_no_pairs(similarity):
    """Joined rows of the prefixes, for two sizes of a family: none of what the family shares is in an index prefix."""
    for n in (50, 200):
        texts = w.texts_of(pa.array(family(random.Random(n), n, similarity)))
        sets = list(near_dup.shingle_sets(texts))
        both = np.intersect1d(sets[0], sets[1]).size
        assert abs(both / (2 * len(sets[0]) - both) - similarity) < 0.02
        counts = np.zeros(near_dup.COUNTERS, np.int64)
        for s in sets:
            np.add.at(counts, near_dup._counter(s), 1)
        order = type("Order", (), {"value": counts})
        batch = pa.RecordBatch.from_pydict({"rep": list(range(n)), "comp": list(range(n)), "text": [texts.bytes(i).decode() for i in range(n)]})
        rows = pa.Table.from_batches(list(near_dup._prefixes(75, order)(iter([batch])))).to_pandas()
        joined = rows[rows.indexed].merge(rows, on="token")
        joined = joined[joined.rep_x != joined.rep_y]
        # A few meet where a common shingle shares its counter with none and an own one with many.
        assert len(joined) <= 4 * n


@pytest.mark.parametrize("similarity", [0.70, 0.74, 0.76])
def test_families_around_the_threshold_equal_brute_force(spark, tmp_path, similarity):
    rng = random.Random(int(similarity * 100))
    texts = family(rng, 60, similarity, 120)
    texts += [t + " one more word" for t in texts[:5]] + [" ".join(t.split()[:60]) for t in texts[:5]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = near_dup.near_duplicates(docs, trees=8, depth=3, leaf=2, folder=str(tmp_path))
    assert sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr) == brute_components(texts, list(range(len(texts))))


def test_one_of_each_group_whatever_its_columns(spark, tmp_path):
    rows = [(i, "the same words in the same order again and again", *["x"] * 3) for i in range(4)] + [(None, "no id", *["x"] * 3), (2, "the same words in the same order again and again", *["y"] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _at string, at string, kept string")
    kept = near_dup.keep_one(docs, folder=str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["_at"]) for r in kept.where("doc_id IS NOT NULL").collect()) == [(0, "x")] and kept.count() == 2

"""The operators against brute force, on a fixture with nulls, empty and
long texts, ties, repeated rows, and columns whose names clash."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dimspark.llm import (
    chat,
    components,
    decontaminate,
    huffman,
    lm_score,
    near_dedup,
    packing,
    quality,
    sharding,
    substring_dedup,
    text,
    token_output,
    tokens,
    toxicity,
)
from dimspark.session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
EDGE = [
    None, "", " \t\n", "one", "One", "two words", "Ünï côdé 😀 x", "a b\x0bc\x0cd\re", "#$% | <a>\n#$% | <a>\n\n",
    "same " * 60, "x y " * 40, "<|endoftext|> <|ENDOFTEXT|> it's IT'S", "q" * 5000, " ́ é ẛ̣",
]


def corpus() -> list[tuple]:
    rng = random.Random(7)
    words = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("a", "e", "io", "u", "ar", "en")]

    def prose(n):
        return " ".join(rng.choice(words).title() if rng.random() < 0.1 else rng.choice(words) + rng.choice(["", ".", ","]) for _ in range(n))

    passage, base = prose(70), prose(150)
    rows = list(EDGE) + [prose(rng.randint(5, 120)) for _ in range(40)]
    rows += [prose(30) + " " + passage + "\n" + prose(k) for k in (3, 20, 33)]
    for k in range(30):  # near copies at all distances
        w = base.split()
        for _ in range(k):
            w[rng.randrange(len(w))] = rng.choice(words) + "x"
        rows.append(" ".join(w))
    rows += [base] * 25 + [prose(6000)]
    ids = list(range(100, 100 + len(rows)))
    rng.shuffle(ids)
    out = [(i, t, "c", 1, True, "u") for i, t in zip(ids, rows)]
    return out + out[40:43]  # repeated rows


SCHEMA = "doc_id long, text string, chunk string, n_words int, kept boolean, label string"


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def unique(rows):
    return {r[0]: r[1] or "" for r in rows}


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# -- words ------------------------------------------------------------------


def test_scan_equals_regex():
    for kind, pattern, lower in (
        (text.SPACED, WORD, False), (text.SPACED_LOWER, WORD, True),
        (text.ALNUM_LOWER, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True),
    ):
        w = text.scan(pa.array(EDGE), kind)
        want = [re.findall(pattern, (t or "").translate(ASCII_LOWER) if lower else t or "") for t in EDGE]
        got = [
            [text.word_bytes(w, i).decode().translate(ASCII_LOWER if lower else {}) for i in range(a, b)]
            for a, b in zip(w.first[:-1], w.first[1:])
        ]
        assert got == want
        by_word = {}
        for h, x in zip(w.hash.tolist(), sum(want, [])):
            assert by_word.setdefault(x, h) == h
        assert len(set(by_word.values())) == len(by_word)


def test_hashes_do_not_depend_on_place_or_batch():
    t = ["a bb ccc " * 400_000, "ccc"]
    w = text.scan(pa.array(t))
    assert len(set(w.hash.tolist())) == 3
    assert w.hash[-1] == text.scan(pa.array(["ccc"])).hash[0]


# -- 1: substring dedup -----------------------------------------------------


def test_windows_have_equal_prints_iff_equal_words():
    rng = np.random.default_rng(1)
    seq = rng.integers(1, 4, 3000).astype(np.uint64)  # few symbols: many repeats and runs
    seq[500:900] = 2
    start = np.arange(len(seq) - 20)
    at, key, prints = substring_dedup.recompress(text.mix(seq), start, 20, True)
    assert ((at >= start) & (at < start + 20)).all()
    seen, named = {}, {}
    for s in start.tolist():
        w = tuple(seq[s : s + 20].tolist())
        assert seen.setdefault(w, prints[s]) == prints[s]
        assert named.setdefault(w, key[s]) == key[s]  # equal windows elect the same symbol
    assert len(set(seen.values())) == len(seen)


def brute_removed(pairs, window):
    seen, out = set(), {}
    for i, t in sorted(pairs, key=lambda p: p[0]):
        w = re.findall(WORD, t or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if key in seen:
                gone[k : k + window] = [True] * window
            seen.add(key)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def test_substring_dedup(spark, unique):
    one = spark.createDataFrame([(i, t, 5) for i, t in unique.items()], "doc_id long, text string, n_words int").repartition(4)
    cut, stored = substring_dedup.remove_repeats(one, window=20, join_all=True)
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in cut.collect()}
    stored.drop()
    assert got == brute_removed(unique.items(), 20)
    assert cut.columns == ["doc_id", "text", "n_words", "n_removed"]


def test_substring_dedup_keeps_rows_and_untouched_texts(docs, rows, nothing):
    cut, stored = substring_dedup.remove_repeats(docs, window=50)
    got = cut.collect()
    stored.drop()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows)
    before = {r[0]: r[1] for r in rows}
    assert all(r.text == before[r.doc_id] for r in got if not r.n_removed)
    copies = [r for r in got if collections.Counter(x[0] for x in rows)[r.doc_id] == 2 and r.n_words >= 50]
    assert all(sorted(r.n_removed for r in copies if r.doc_id == i)[-1] > 0 for i in {r.doc_id for r in copies})
    empty, stored = substring_dedup.remove_repeats(nothing)
    assert empty.count() == 0
    stored.drop()


# -- 2: quality ---------------------------------------------------------------


def test_quality_rules(spark, docs, rows, nothing):
    labels = spark.createDataFrame([(r[0], k % 2) for k, r in enumerate(rows)] + [(1, None), (2, 1)], "doc_id long, quality int")
    got = quality.judge(docs, quality.train(docs, labels)).collect()
    assert len(got) == len(rows)
    before = {r[0]: r[1] or "" for r in rows}
    for r in got:
        t = before[r.doc_id]
        w, lines = re.findall(WORD, t), [x for x in t.split("\n") if re.search(WORD, x)]
        n = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        hit = {j for i in range(len(w) - 7) if n[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(hit))
        assert r.base_failed == (len(w) < 20 or 100 * len(hit) > 30 * len(w))
        assert r.kept == (not r.base_failed and r.quality >= quality.KEEP)
    assert quality.judge(nothing, quality.train(nothing, labels)).count() == 0
    alone = quality.judge(docs, quality.train(docs, labels.where("quality = 1")))
    assert alone.select("quality").distinct().count() == 1  # one class: its smoothed share


def test_quality_learns(spark):
    rng = random.Random(3)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(60)) for _ in range(60)]
    junk = [" ".join(rng.choice(["alpha", "beta", "gamma"]) + rng.choice(["***", "###"]) for _ in range(60)) for _ in range(60)]
    rows = [(i, t, int(i < 60)) for i, t in enumerate(good + junk)]
    d = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    got = quality.judge(d.select("doc_id", "text"), quality.train(d, d)).collect()
    assert sum((r.quality >= 0.5) == (r.doc_id < 60) for r in got) >= 118


# -- 3: near duplicates ---------------------------------------------------------


def shingles(t, k):
    w = re.findall(WORD, (t or "").translate(ASCII_LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(sets, percent):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("shingle,percent,block", [(3, 85, 256), (5, 80, 4)])
def test_near_duplicates(docs, rows, unique, shingle, percent, block):
    got = near_dedup.near_duplicates(docs, shingle=shingle, percent=percent, bands=32, rows=4, block=block).collect()
    sets = {i: shingles(t, shingle) for i, t in unique.items()}
    want = brute_components(sets, percent)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_keep_one(spark, docs, unique, nothing):
    more = docs.unionByName(spark.createDataFrame([(None, "no id", "c", 1, True, "u")], SCHEMA))
    got = [r.doc_id for r in near_dedup.keep_one(more).select("doc_id").collect()]
    want = brute_components({i: shingles(t, 5) for i, t in unique.items()}, 80)
    assert sorted(got, key=str) == sorted([None, *(i for i in want if want[i] == i)], key=str)
    assert near_dedup.keep_one(nothing).count() == 0


def test_keep_one_keeps_unlike_texts_of_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    texts = [(7, a), (7, b), (7, a), (8, a + " tail"), (5, b + " tail"), (7, c), (9, None), (9, ""), (9, None), (10, "")]
    more = spark.createDataFrame([(i, t, "c", 1, True, "u") for i, t in texts], SCHEMA).repartition(3)
    got = near_dedup.keep_one(more)
    assert got.columns == more.columns
    want = [(5, b + " tail"), (7, a), (7, c), (9, None), (9, ""), (10, "")]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    sets = [np.sort(a[:2000]), np.sort(a[500:2500]), np.sort(a[:10]), np.sort(a[2:12])]
    sig = near_dedup.superminhash(sets, 200)
    assert (sig < np.iinfo(np.uint64).max).all()
    assert abs((sig[0] == sig[1]).mean() - 1500 / 2500) < 0.1
    assert abs((sig[2] == sig[3]).mean() - 8 / 12) < 0.1
    alone = near_dedup.superminhash(sets[2:3], 200)
    assert (alone[0] == sig[2]).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(60)] + [(500, 400), (400, 450)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(1, 60)}, 100: 100, 400: 400, 450: 400, 500: 400}


# -- 4: token output -------------------------------------------------------------


def encoded(t, end):
    return tokens.encoder(tokens.default_path()).tokenizer.encode(t or "", add_special_tokens=False).ids + [end]


def test_word_cache_equals_tokenizer(rows):
    enc = tokens.WordEncoder(tokens.default_path())
    for _ in range(2):
        ids, off = enc.encode(pa.array([r[1] for r in rows]), 2)
        assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == [encoded(r[1], 2) for r in rows]


def test_token_store_round_trip(spark, docs, rows, nothing):
    path = scratch_dir(spark, "store")
    token_output.write(docs, path)
    got = {}
    for r in token_output.read(spark, path).collect():
        assert got.setdefault(r.doc_id, r.ids) == r.ids == encoded(dict((x[0], x[1]) for x in rows)[r.doc_id], 2)
    at = 0
    for r in sorted(token_output.read(spark, path, digest=True).collect(), key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(got[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(got[r.doc_id], "<u4").tobytes())
        at += r.n_tokens
    order = [r.doc_id for r in sorted(token_output.read(spark, path, digest=True).collect(), key=lambda r: r.start)]
    assert order == sorted(r[0] for r in rows)
    path = scratch_dir(spark, "store")
    token_output.write(nothing, path)
    assert token_output.read(spark, path).count() == 0


def test_huffman_codes():
    rng = np.random.default_rng(0)
    for n, k in ((0, 4), (1, 4), (64, 4), (65, 300), (5000, 40_000), (100_000, 50)):
        ids = np.minimum(rng.zipf(1.2, n), k) - 1
        length = huffman.code_lengths(np.bincount(ids, minlength=k))
        code = huffman.canonical(length)
        assert (huffman.decode(huffman.encode(ids, code), code) == ids).all()
    steep = np.array([2**i for i in range(40)])
    length = huffman.code_lengths(steep)
    assert length.max() == huffman.LIMIT and sum(2.0 ** -int(x) for x in length) <= 1
    assert huffman.code_lengths(np.array([5, 1, 1, 2])).tolist() == [1, 3, 3, 2]


# -- 5: LM scores -----------------------------------------------------------------


def test_lm_scores(docs, rows, nothing):
    lists = [re.findall(WORD, (r[1] or "").translate(ASCII_LOWER)) for r in rows]
    n = [collections.Counter(tuple(w[i : i + k]) for w in lists for i in range(len(w) - k + 1)) for k in (1, 2, 3)]
    words = sum(n[0].values())

    def score(w):
        total = 0.0
        for i in range(len(w)):
            penalty = 0.0
            for k in range(min(i, 2), -1, -1):
                c = n[k][tuple(w[i - k : i + 1])]
                if k == 0 or c >= 1:
                    total += penalty + np.log(c / (n[k - 1][tuple(w[i - k : i])] if k else words))
                    break
                penalty += np.log(0.4)
        return total

    want = {r[0]: (len(w), score(w)) for r, w in zip(rows, lists)}
    got = lm_score.lm_scores(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_words == want[r.doc_id][0] and abs(r.log_score - want[r.doc_id][1]) < 1e-6
        assert (r.mean_log_score is None) == (r.n_words == 0)
    assert lm_score.lm_scores(nothing).count() == 0


@pytest.mark.parametrize("floor", [2, 3])
def test_lm_scores_with_another_floor(docs, rows, floor):
    lists = [re.findall(WORD, (r[1] or "").translate(ASCII_LOWER)) for r in rows]
    n = [collections.Counter(tuple(w[i : i + k]) for w in lists for i in range(len(w) - k + 1)) for k in (1, 2, 3)]
    want = {}
    for r, w in zip(rows, lists):
        total = 0.0
        for i in range(len(w)):
            most = min(i, 2)
            k = next(k for k in range(most, -1, -1) if not k or n[k][tuple(w[i - k : i + 1])] >= floor)
            base = n[k - 1][tuple(w[i - k : i])] if k else sum(n[0].values())
            total += np.log(n[k][tuple(w[i - k : i + 1])] / base) + (most - k) * np.log(0.4)
        want[r[0]] = total
    got = lm_score.lm_scores(docs, min_count=floor).collect()
    assert len(got) == len(rows) and all(abs(r.log_score - want[r.doc_id]) < 1e-6 for r in got)


# -- 6: toxicity --------------------------------------------------------------------


@pytest.fixture(scope="module")
def toxic(spark):
    rng = random.Random(5)
    words = ["banter", "lorem", "dolor", "sitam", "consec", "tetur", "adipi", "scing", "elitsed", "eiusmod"]

    def sentence():
        return " ".join(rng.choice(words) for _ in range(rng.randint(4, 10)))

    rows = []
    for i in range(240):
        s = [sentence() for _ in range(rng.randint(2, 5))]
        if i % 3 == 0:
            s[rng.randrange(len(s))] += " you " + rng.choice(["zounkwit", "grizplap"])
        rows.append((i, ". ".join(s) + ".", int(i % 3 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_learns_and_tolerates_gaps(spark, toxic):
    model = toxicity.train(toxic, toxic.where(~toxicity.held_out()))
    got = toxicity.score(toxic, model).where(toxicity.held_out()).collect()
    assert got and sum((r.toxicity >= 0.5) == bool(r.toxic) for r in got) >= 0.95 * len(got)
    tricky = ["you zo-un*kwit", "you z o u n k w i t", "ZOUNKWIT!", "lorem dolor sitam", "", None, "lorem zounnkwit", "zounxkwit"]
    scores = model.score(model.features(pa.array(tricky), {}))
    assert (scores[:3] > 0.5).all() and (scores[3:6] < 0.5).all()
    assert (scores[6:] > 0.5).all()  # an inserted letter is a gap


def test_kernel_against_brute_force():
    """All triples of characters at gaps, word by word."""
    import itertools

    def weights(word):
        c = bytes([2]) + toxicity.plain(word) + bytes([3])
        out = collections.Counter()
        for i, j, k in itertools.combinations(range(len(c)), 3):
            if k - i < toxicity.SPAN:
                out[c[i], c[j], c[k]] += toxicity.DECAY ** (k - i - 2)
        return out

    def like(a, b):
        x, y = weights(a), weights(b)
        dot = sum(v * y[t] for t, v in x.items())
        value = (dot / max(np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values())), 1e-9)) ** toxicity.POWER
        return value if value > toxicity.LEAST else 0.0

    words = [b"idiot", b"idxiot", b"i-d-iot", b"stupid", b"stuupid", b"a", b"", "é".encode(), b"Moron!", b"moronic", b"norom"]
    marks = toxicity.Landmarks([w for w in words if len(toxicity.plain(w)) >= 3])
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    start = end - [len(w) for w in words]
    table = np.zeros((len(words), len(marks.words)))
    word, mark, value = marks.kernel(data, start, end)
    table[word, mark] = value
    want = np.array([[like(w, m) for m in marks.words] for w in words])
    assert np.allclose(table, want, atol=1e-5)
    alpha = np.arange(len(marks.words)) - 2.5
    assert np.allclose(marks.scores(data, start, end, alpha), want @ alpha, atol=1e-4)


def _made_words(n):
    rng = random.Random(4)
    words = ["".join(rng.choice("abdeiklmnorstuwz") for _ in range(rng.randint(4, 14))).encode() for _ in range(n)]
    end = np.cumsum([len(w) for w in words])
    return words, np.frombuffer(b"".join(words), np.uint8), end - [len(w) for w in words], end


def test_a_word_scores_the_same_beside_any_others():
    words, data, start, end = _made_words(3000)
    marks = toxicity.Landmarks(sorted(set(words[:200])))
    alpha = np.linspace(-1, 1, len(marks.words))
    got = marks.scores(data, start, end, alpha)
    back = marks.scores(data, start[::-1], end[::-1], alpha)[::-1]
    alone = np.concatenate([marks.scores(data, start[i : i + 1], end[i : i + 1], alpha) for i in range(0, 3000, 7)])
    assert (got == back).all() and (got[::7] == alone).all()


def test_only_cells_that_may_count_are_raised_to_the_power(monkeypatch):
    cells = []

    class Power:
        __array_ufunc__ = None

        def __rpow__(self, x):
            cells.append(np.size(x))
            return x**3

        def __rtruediv__(self, x):
            return x / 3

    words, data, start, end = _made_words(2000)
    marks = toxicity.Landmarks(sorted(set(words[:200])))
    want = marks.kernel(data, start, end)
    monkeypatch.setattr(toxicity, "POWER", Power())
    got = marks.kernel(data, start, end)
    assert all((a == b).all() for a, b in zip(got, want))
    assert len(want[0]) <= sum(cells) < 0.1 * len(words) * len(marks.words)


def test_kernel_memory_does_not_grow_with_the_words():
    import tracemalloc

    words, data, start, end = _made_words(60_000)
    marks = toxicity.Landmarks(sorted(set(words[:300])))
    peaks = []
    for n in (20_000, 60_000):
        tracemalloc.start()
        marks.scores(data, start[:n], end[:n], np.ones(len(marks.words)))
        peaks.append(tracemalloc.get_traced_memory()[1] / 1e6)
        tracemalloc.stop()
    assert peaks[1] < 25 and peaks[1] < 1.2 * peaks[0] + 2


def test_a_letter_is_put_into_long_words_only():
    assert toxicity.altered(None) == "" and toxicity.altered("a ab 1234 _____") == "a ab 1234 _____"
    text = "Some wörds, abcd; und längere"
    out = toxicity.altered(text)
    assert out == toxicity.altered(text)
    for a, b in zip(re.findall(r"\w+", text), re.findall(r"\w+", out)):
        assert len(b) == len(a) + (len(a) >= 3) and a[0] == b[0] and a[-1] == b[-1]
        assert any(b[:i] + b[i + 1 :] == a for i in range(len(b))) or a == b


def test_toxicity_edges(spark, docs, rows, nothing, toxic):
    model = toxicity.train(toxic, toxic)
    got = toxicity.score(docs, model)
    assert got.columns == [*docs.columns, "toxicity"]
    assert sum(0 <= r.toxicity <= 1 for r in got.collect()) == len(rows)
    none = toxicity.train(toxic, toxic.where("toxic = 0"))
    assert toxicity.score(toxic, none).select("toxicity").distinct().count() == 1
    assert toxicity.score(nothing, toxicity.train(nothing, toxic)).count() == 0


def test_training_chains_no_python_steps(spark, toxic, monkeypatch):
    """Two in one stage are two Python workers a task, and both stay."""
    plans, real = {}, toxicity.store

    def store(spark, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(spark, df, name)

    monkeypatch.setattr(toxicity, "store", store)
    toxicity.train(toxic, toxic, rounds=1)
    assert plans and {k: p.count("MapInArrow") for k, p in plans.items()} == dict.fromkeys(plans, 1)


def test_sentences_do_not_depend_on_the_batch(rows):
    texts = [r[1] for r in rows]
    s = toxicity.sentences(pa.array(texts, pa.string()))
    for i in (6, 9, 11, 30, len(texts) - 1):
        one = toxicity.sentences(pa.array([texts[i]], pa.string()))
        assert (s.text == i).sum() == len(one.text)
        assert np.isin(s.sentence, np.flatnonzero(s.text == i)).sum() == len(one.word)


def test_spaced_words_do_not_take_scores_of_earlier_slices():
    model = toxicity.Model(toxicity.Landmarks([b"idiot", b"zounkwit"]), np.array([2.0, 3.0]), -0.5, np.array([1.0, 0, 0, 0]))
    slices = [["a b c", "1 2 3. x y z"], ["i d i o t", "lorem. you z o u n k w i t", "q r s"], ["d e f", "i d i o t"]]
    memory = {}
    for texts in slices:
        got = model.features(pa.array(texts), memory)
        alone = np.concatenate([model.features(pa.array([t]), {}) for t in texts])
        assert (got == alone).all()
    assert got[1, 0] > 0 > got[0, 0]


# -- 7: sharding ---------------------------------------------------------------------


def test_minimax_capacity_is_least():
    rng = random.Random(2)
    for _ in range(60):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(1, 12))]
        k = rng.randint(1, 5)
        best = {0: 0}  # least capacity for a prefix, shard by shard
        table = [[0] + [10**9] * len(sizes)]
        for _ in range(k):
            table.append([min(max(table[-1][j], sum(sizes[j:i])) for j in range(i + 1)) for i in range(len(sizes) + 1)])
        assert sharding.smallest_capacity(sizes, k) == table[-1][-1], best
        cut = [0, *sharding.cuts(sizes, k), len(sizes)]
        assert cut == sorted(cut) and len(cut) == k + 1
        assert max(sum(sizes[a:b]) for a, b in zip(cut, cut[1:])) <= table[-1][-1]


@pytest.mark.parametrize("bits, most", [(4, 3), (4, 10**6), (8, 20), (16, 10**6)])
def test_capacity_is_that_of_all_groups(spark, monkeypatch, bits, most):
    """The search over few prefixes gives the capacity over all groups; one
    group holds a third of all bytes, one digest prefix most groups."""
    monkeypatch.setattr(sharding, "BITS", bits)
    monkeypatch.setattr(sharding, "MOST_GROUPS", most)
    rng = random.Random(bits + most)
    for hot in (0, 4000):
        digests = {hashlib.md5(str(i).encode()).hexdigest() for i in range(400)} | {f"ab{i:030x}" for i in range(80)}
        sizes = {d: rng.randint(8, 60) for d in digests} | {"7" * 32: 8 + hot}
        groups = spark.createDataFrame(list(sizes.items()), "digest string, size long")
        every = [sizes[d] for d in sorted(sizes)]
        for shards in (1, 2, 7, 24):
            capacity, starts = sharding.plan(groups, shards)
            assert capacity == sharding.smallest_capacity(every, shards)
            filled = collections.Counter()
            for d, n in sizes.items():
                filled[sum(d >= s for s in starts)] += n
            assert max(filled.values()) <= capacity and starts == sorted(starts) and len(starts) == shards - 1


def test_copies_are_numbered_over_salts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 10)
    docs = spark.createDataFrame([(i, "copy" if i % 3 else f"text {i}") for i in range(300)], "doc_id long, text string")
    slots = collections.defaultdict(list)
    for r in sharding.shard(docs, shards=4).collect():
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == 300 and all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_sharding(docs, rows, nothing):
    got = sharding.shard(docs, shards=6).collect()
    before = {r[0]: r[1] or "" for r in rows}
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows)
    slots, homes, sizes = collections.defaultdict(list), {}, collections.Counter()
    for r in got:
        raw = before[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        assert homes.setdefault(before[r.doc_id], r.shard) == r.shard
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) <= set(range(6))
    group = collections.Counter()
    for r in got:
        group[before[r.doc_id]] += r.size
    assert max(sizes.values()) <= sum(sizes.values()) / 6 + max(group.values())
    assert sharding.shard(nothing).count() == 0


# -- 8: decontamination ----------------------------------------------------------------


def test_items_that_share_a_passage(spark, monkeypatch):
    """Hundreds of items on one passage: equal windows are one, and places
    are spelled out in small lots, with the same result."""
    rng = random.Random(3)
    passage = " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))
    items = [(f"q{i}", f"{passage} question {i} number {i * i}") for i in range(300)]
    texts = [f"before {passage} after", passage, "nothing here " * 9, passage[40:] + " x", f"{passage} question 7 number 49"]
    block = decontaminate.make_block(*map(list, zip(*items)), 10)
    assert len(block.length) < 31 + 300 * 10 and len(block.item) == sum(len(t.split()) - 9 for _, t in items)
    seen = []
    for most in (1, 5000, 1 << 20):
        monkeypatch.setattr(decontaminate, "AT_ONCE", most)
        _, _, text, word, number = decontaminate.find(pa.array(texts), block)
        seen.append(sorted(zip(*(x.tolist() for x in decontaminate.longest(text, word, number, block)))))
    assert seen[0] == seen[1] == seen[2]
    docs = [(i, t) for i, t in enumerate(texts)]
    want = brute_hits(docs, items, 10)
    got = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"))
    for r in got.collect():
        n_words, n_hit, ids = want[r.doc_id]
        assert (r.n_words, r.n_hit, sorted({m.item_id for m in r.matches})) == (n_words, n_hit, sorted(ids))


def test_removal_block_by_block(spark, docs, nothing):
    items = spark.createDataFrame([(i, r[1]) for i, r in enumerate(corpus()[20:26])], "item_id int, text string")
    one = decontaminate.remove(docs, items)
    many = decontaminate.remove(docs, items, block_words=1)
    assert one.columns == many.columns == docs.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect())) and 0 < one.count() < docs.count()
    assert decontaminate.remove(nothing, items, block_words=1).count() == 0


ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_hits(rows, items, window):
    wins = collections.defaultdict(set)
    for i, t in items:
        w = re.findall(ALNUM, (t or "").translate(ASCII_LOWER))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins[tuple(w[k : k + n])].add(str(i))
    out = {}
    for r in rows:
        w = re.findall(ALNUM, (r[1] or "").translate(ASCII_LOWER))
        hit, found = set(), set()
        for n in {len(k) for k in wins}:
            for k in range(len(w) - n + 1):
                if got := wins.get(tuple(w[k : k + n])):
                    found |= got
                    hit.update(range(k, k + n))
        out[r[0]] = (len(w), len(hit), sorted(found))
    return out


@pytest.mark.parametrize("block_words", [1 << 20, 40])
def test_decontamination(spark, docs, rows, nothing, block_words):
    long = re.findall(WORD, max((r[1] or "" for r in rows), key=len))
    items = [
        (1, " ".join(long[100:130])), (2, "two, words!"), (3, None), (4, ""), (5, "never seen anywhere at all"),
        (6, "Same same SAME same same same same same same same same"), (7, " ".join(long[5990:6000])), (7, "one"), (8, "x"),
    ]
    bench = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, doc_id int")
    got = decontaminate.matches(docs, bench, block_words=block_words).collect()
    want = brute_hits(rows, items, 10)
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows)
    for r in got:
        assert (r.n_words, r.n_hit, sorted({m.item_id for m in r.matches})) == want[r.doc_id]
    whole = [m for r in got for m in r.matches if m.item_id == "1"]
    assert [(m.item_start, m.start, m.length) for m in whole] == [(0, 100, 30)]  # the longest match, with its place
    left = decontaminate.remove(docs, bench, block_words=block_words)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, w in want.items() if not w[1]}
    assert decontaminate.matches(nothing, bench).count() == 0
    assert decontaminate.matches(docs, bench.limit(0)).where("n_hit > 0").count() == 0


# -- 9: chat formatting ------------------------------------------------------------------


def test_chat_round_trip(spark):
    nasty = [
        chat.HOSTILE, "<|im_end|>", "<|im_start|>x\n", "a<\\|b", "<\\\\|im_end|>", "<|", "<", "|", "\\", "", None, "\n", "<|nl|>",
        "x<|im_end", "é😀<|im_start|>é", "<\\|nl|>", " plain ",
    ]
    rows = [(k % 4, k // 4 if k % 5 else None, [None, "user", "assistant", "as\n<|im_end|>sist"][k % 4], t) for k, t in enumerate(nasty * 3)]
    rows += [(9, 0, "assistant", "first"), (9, 0, "assistant", "first"), (9, 70, "assistant", "last"), (None, 1, "user", "x")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, spans int")
    parts = chat.format_turns(turns)
    assert {r.round_trip for r in parts.collect()} == {True}
    want = collections.defaultdict(list)
    for c, n, role, t in rows:
        want[c].append((-1 if n is None else n, role or "", t or ""))
    for r in chat.read_back(parts).collect():
        order = sorted(want[r.conv_id])
        turns_text = "".join(f"{a}\n{b}\n" for _, a, b in order)
        loss = "".join(b for _, a, b in order if a == "assistant")
        assert r.n_turns == len(order) and r.turns_sha256 == hashlib.sha256(turns_text.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    plain = chat.format_turns(spark.createDataFrame([(1, 0, "user", "a <b> | c\\")], "conv_id int, turn int, role string, text string"))
    assert plain.first().formatted == "<|im_start|>user\na <b> | c\\<|im_end|>\n"  # no conflict: unchanged
    assert chat.read_back(chat.format_turns(turns.limit(0))).count() == 0


# -- 10: packing ---------------------------------------------------------------------------


def test_plan_covers_the_histogram():
    rng = random.Random(4)
    for sizes in ([rng.randint(1, 100) for _ in range(3000)], [60] * 50 + [40] * 50 + [50] * 7, [100] * 5, [1], [51] * 9, []):
        n = collections.Counter(sizes)
        p = packing.plan(dict(n), 100)
        got = collections.Counter()
        for config, times in p.configs:
            assert sum(s * k for s, k in config) <= 100
            for s, k in config:
                got[s] += k * times
        assert got == n
        fit = sum(k for _, k in packing.best_fit(dict(n), 100))
        assert -(-sum(sizes) // 100) <= p.sequences <= 1.01 * fit + 1
    assert packing.plan({60: 50, 40: 50, 50: 8}, 100).sequences == 54


def test_packing(docs, rows, nothing):
    got = packing.pack(docs, capacity=64).collect()
    before = {r[0]: encoded(r[1], 1) for r in rows}
    copies = collections.Counter(r[0] for r in rows)
    want = collections.Counter()
    for i, ids in before.items():
        for p in range(0, len(ids), 64):
            cut = ids[p : p + 64]
            want[(i, p // 64, p, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()))] += copies[i]
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = collections.defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for x in places.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 64
    fit = sum(k for _, k in packing.best_fit(dict(collections.Counter(r.length for r in got)), 64))
    assert -(-sum(r.length for r in got) // 64) <= len(places) <= 1.01 * fit + 1
    assert packing.pack(nothing).count() == 0

"""Periodic runs and byte-level BPE against brute force."""

from __future__ import annotations

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dimspark.llm import byte_bpe, periodic_runs

WORD = r"[^\x20\x09-\x0D]+"
EDGE = [
    None, "", " \t\n", "one", "same " * 60, "x y " * 40, "Ünï côdé 😀 x", "a b\x0bc\x0cd\re", "it's 'LL we'll",
    "q" * 5000, "a  b\n\n c d 　 e\x85f", " lead and trail  ", "՘ new ࢏ letters", "\x00\x1c \x1d x",
]
SCHEMA = "doc_id long, text string, runs string, ids int, __chunk long, n_tokens string"


def _texts(seed: int) -> list:
    rng = random.Random(seed)
    words = ["ab", "ba", "abba", "né", "x1", "12", "…", "'s"]
    out = list(EDGE)
    for _ in range(60):
        n = rng.choice([5, 40, 200])
        w = [rng.choice(words) for _ in range(n)]
        a, p = rng.randrange(n), rng.randint(1, 40)
        for i in range(a + p, min(n, a + rng.randint(2, 6) * p)):
            w[i] = w[i - p]
        out.append(rng.choice([" ", "\n", "  "]).join(w))
    return out + out[20:24]


@pytest.fixture(scope="module")
def rows():
    return [(i - 3 if i < len(_texts(5)) - 2 else 7, t, "r", 1, 5, "t") for i, t in enumerate(_texts(5))]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def brute_runs(w: list, least: int = 12) -> list[tuple[int, int, int]]:
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(w)):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_digest(doc_id, text) -> tuple:
    w = re.findall(WORD, text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    kept = hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()
    return doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest, kept


@pytest.mark.parametrize("patience", [0, 1, 24])
def test_runs_of_random_sequences(monkeypatch, patience):
    monkeypatch.setattr(periodic_runs, "_PATIENCE", patience)
    rng = random.Random(patience)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(0, 4)):
            n, k = rng.choice([0, 1, 30, 200]), rng.choice([1, 2, 8, 100])
            w = [rng.randrange(k) for _ in range(n)]
            for _ in range(rng.randint(0, 3) if n > 4 else 0):
                a, p = rng.randrange(n), rng.randint(1, n // 2)
                for i in range(a + p, min(n, a + rng.randint(p, 6 * p + 20))):
                    w[i] = w[i - p]
            texts.append(w)
        first = np.cumsum([0] + [len(w) for w in texts])
        codes = np.array([c for w in texts for c in w], np.uint64)
        got = list(zip(*(x.tolist() for x in periodic_runs.runs_of(codes, first))))
        assert got == [(int(first[d]) + s, n, q) for d, w in enumerate(texts) for s, n, q in brute_runs(w)]


def test_splitting_is_stable():
    rng = random.Random(3)
    w = np.array([rng.randrange(900) for _ in range(4000)] + list(range(50)) * 3, np.uint64)
    start, end = periodic_runs.split(w, np.array([0, len(w)]))
    for s, e in zip(start.tolist(), end.tolist()):
        assert e - s >= 12 and min(collections.Counter(w[s:e].tolist()).values()) >= 2
    assert any(s <= 4000 and e >= 4150 for s, e in zip(start.tolist(), end.tolist()))


def test_a_text_of_a_million_words():
    """One run over all, and a long period, in one text."""
    tail = np.random.default_rng(1).integers(10, 1 << 60, 150_000).astype(np.uint64)
    w = np.concatenate([np.full(300_000, 7, np.uint64), np.tile(tail, 4), tail[:999]])
    got = list(zip(*(x.tolist() for x in periodic_runs.runs_of(w, np.array([0, len(w)])))))
    assert got == [(0, 300_000, 1), (300_000, 600_999, 150_000)]


def test_find_runs_keeps_columns(docs, rows):
    found = periodic_runs.find_runs(docs.withColumnRenamed("n_tokens", "kept"))
    assert found.columns == ["doc_id", "text", "ids", "__chunk", "kept", "n_words", "runs", "collapsed"]
    want = collections.Counter()
    for r in rows:
        w = re.findall(WORD, r[1] or "")
        runs = brute_runs(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want[r[0], r[1], len(w), tuple(runs), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    got = collections.Counter(
        (r.doc_id, r.text, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in found.collect()
    )
    assert got == want
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


def test_op11_query(spark, rows, tmp_path):
    more = rows + [(i, r[1], "r", 1, 5, "t") for i, r in enumerate(rows * 4, 1000)] + [(None, "a b " * 20, "", 1, 1, "")]
    spark.createDataFrame(more, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic_runs.query(spark, str(tmp_path))
    assert dict(got.dtypes) == {
        "doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
        "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string",
    }
    want = collections.Counter(brute_digest(r[0], r[1]) for r in more)
    assert collections.Counter(tuple(r) for r in got.collect()) == want


# -- byte-level BPE ----------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    with open(byte_bpe.default_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_queue_pops_by_rank_then_position():
    rng = random.Random(1)
    queue, held = byte_bpe.RankQueue(50_000), []
    ranks = np.array([rng.choice([3, 64, 4096, 49_999, byte_bpe.NONE]) for _ in range(300)], np.int64)
    queue.fill(ranks)
    held = [(int(r), i) for i, r in enumerate(ranks) if r != byte_bpe.NONE]
    for turn in range(2000):
        if held and rng.random() < 0.6:
            assert queue.pop() == min(held)
            held.remove(min(held))
        elif turn < 1000:
            entry = rng.choice([3, 64, 70, 5000, 49_999]), rng.randrange(1000)
            queue.add(*entry)
            held.append(entry)
    while held:
        assert queue.pop() == min(held)
        held.remove(min(held))
    assert queue.pop() == (byte_bpe.NONE, -1) and queue.top == 0 and not any(queue.low) and not any(queue.mid)


def test_encoding_matches_the_library(monkeypatch, library):
    rng = random.Random(4)
    kinds = ["ab", "a b c  ", "áéñ'st's 12", "\n\t \x1c\x85  　x", "中文字абв१२    ", "'re'll", "😀‍́..", "՘ ࢏"]
    texts = list(EDGE)
    for i in range(1500):
        n = rng.choice([1, 5, 30, 200, 600])
        texts.append("".join(rng.choice(rng.choice(kinds)) for _ in range(n)))
        points = (rng.randrange(0x110000) for _ in range(20))
        texts.append("".join(chr(c) for c in points if not 0xD800 <= c < 0xE000))
    for long, block in ((40, 50), (byte_bpe.LONG, byte_bpe.BLOCK)):
        monkeypatch.setattr(byte_bpe, "LONG", long)
        monkeypatch.setattr(byte_bpe, "BLOCK", block)
        bpe = byte_bpe.ByteBpe(byte_bpe.default_path(), byte_bpe.default_pattern())
        for at in range(0, len(texts), 500):  # later batches go on with the memory
            part = texts[at : at + 500]
            ids, off = bpe.encode_all(pa.array(part, pa.string()))
            raw, ends = bpe.decode_all(ids)
            for i, x in enumerate(part):
                assert ids[off[i] : off[i + 1]].tolist() == library.encode_ordinary(x or "")
                assert raw[ends[off[i]] : ends[off[i + 1]]].tobytes() == (x or "").encode()


def test_a_pre_token_of_a_million_bytes(library):
    bpe = byte_bpe.coder(byte_bpe.default_path(), byte_bpe.default_pattern())
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh") for _ in range(1_000_000))
    ids, off = bpe.encode_all(pa.array([text]))
    raw, _ = bpe.decode_all(ids)
    assert raw.tobytes() == text.encode()
    assert bpe.merge(text[:30_000].encode()) == library.encode_ordinary(text[:30_000])


def test_memory_starts_anew(library):
    bpe = byte_bpe.ByteBpe(byte_bpe.default_path(), byte_bpe.default_pattern())
    bpe.spans.max_bytes = 1
    for _ in range(3):
        ids, _ = bpe.encode_all(pa.array(["some words here", None, "words here"]))
        assert ids.tolist() == library.encode_ordinary("some words here") + library.encode_ordinary("words here")


def test_op13_and_round_trip(spark, docs, rows, library, tmp_path):
    coded = byte_bpe.encode(docs)
    assert coded.columns == ["doc_id", "text", "runs", "__chunk", "n_tokens", "ids"]
    back = byte_bpe.decode(coded)
    assert back.where(F.col("decoded") != F.coalesce("text", F.lit("")).cast("binary")).count() == 0
    assert byte_bpe.decode(byte_bpe.encode(docs.limit(0))).count() == 0
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = byte_bpe.query(spark, str(tmp_path))
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    want = collections.Counter()
    for r in rows:
        ids = library.encode_ordinary(r[1] or "")
        raw = np.array(ids, "<u4").tobytes()
        want[r[0], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()] += 1
    assert collections.Counter(tuple(r) for r in got.collect()) == want

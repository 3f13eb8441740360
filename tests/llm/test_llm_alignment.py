"""Cross-tokenizer alignment against brute force over whole texts."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from dimspark.llm import alignment

KINDS = [
    "ab", "a b c  ", "áéñ'st's 12", "\n\t \x1c\x85  　x", "中文字абв१२    ", "'re'll", "😀‍́..",
    "<s> </s><0x0A> <|endoftext|>", "the of and is not", "\x00",
]
SCHEMA = "doc_id long, text string, shard string, keys int, n_a string"


def _rows() -> list[tuple]:
    rng = random.Random(1)
    texts = [None, "", " ", "  ", "▁x", "a▁ b", "word ", "\n", "<|endoftext|> a<|endoftext|>", "x" * 3000]
    for _ in range(250):
        texts.append("".join(rng.choice(rng.choice(KINDS)) for _ in range(rng.choice([1, 5, 30, 200, 600]))))
        texts.append(" ".join(rng.choice(["the", "<s>", "  hello", "world.", "x\ny", "unaligned"]) for _ in range(40)))
    texts += ["the same words here " * 4] * 60  # a group of copies
    return [(i if i % 50 else 7, t, "s", 1, "a") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return _rows()


def brute(rows) -> tuple[list[tuple], collections.Counter, dict]:
    """Whole texts through both libraries; every pair of occurrences tried by
    its end; counts over all rows."""
    known = alignment.aligner(*alignment.default_paths())
    found = []
    for r in rows:
        text = r[1] or ""
        a = known.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = known.b.encode(text) if text else []
        whole = (" " + text).encode()
        if b"".join(known.bytes_a.get(i, b"") for i in a) != whole or b"".join(known.bytes_b[i] for i in b) != whole:
            found.append((r[0], 0, 0, [], ""))
            continue
        end_a = list(itertools.accumulate(len(known.bytes_a[i]) for i in a))
        end_b = list(itertools.accumulate(len(known.bytes_b[i]) for i in b))
        cuts = sorted(set(end_a) & set(end_b))
        links = [(a[end_a.index(c)], b[end_b.index(c)]) for c in cuts]
        groups = []
        for lo, hi in zip([0, *cuts], cuts):
            one = [str(x) for x, e in zip(a, end_a) if lo < e <= hi]
            two = [str(x) for x, e in zip(b, end_b) if lo < e <= hi]
            groups.append(",".join(one) + "|" + ",".join(two))
        found.append((r[0], len(a), len(b), links, ";".join(groups)))
    count = collections.Counter(link for f in found for link in f[3])
    docs = collections.Counter(link for f in found for link in set(f[3]))
    most: dict = collections.defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for i, n_a, n_b, links, groups in found:
        best = sum(count[x] == most[x[1]] for x in links)
        out.append((i, n_a, n_b, len(links), len(links), best, sum(count[x] for x in links), groups))
    pairs = {x: (docs[x], n, n == most[x[1]]) for x, n in count.items()}
    return out, count, pairs


@pytest.mark.parametrize("entries", [alignment.ENTRIES, 300])
def test_alignment_against_brute_force(spark, rows, monkeypatch, entries):
    monkeypatch.setattr(alignment, "SALT_BYTES", 200)  # many salts
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = alignment.align(docs, shard_entries=entries)
    want, _, pairs = brute(rows)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert got.documents.columns == names
    assert collections.Counter(tuple(r) for r in got.documents.collect()) == collections.Counter(want)
    assert {(r.a, r.b): (r.n_docs, r.n_links, r.best) for r in got.pairs.collect()} == pairs
    assert sum(w[1] > 0 for w in want) > 300 and sum(w[1] == 0 for w in want) >= 4


def test_shards_and_planes(monkeypatch):
    monkeypatch.setattr(alignment, "BUCKETS", 3)
    rng = np.random.default_rng(2)
    shard, want = alignment._Shard(), collections.Counter()
    for _ in range(5):
        links = rng.choice([5, 1 << 33, (9 << 32) + 7, 70], 400, p=[0.85, 0.1, 0.04, 0.01]).astype(np.uint64)
        slot = np.sort(rng.integers(shard.n, shard.n + 20, 400))
        shard.add(links[:150], slot[:150])  # a document may come in two calls
        shard.add(links[150:], slot[150:])
        shard.n += 20
        want.update(zip(links.tolist(), slot.tolist()))
    got = collections.Counter()
    for number, bucket, n, raw, docs, planes in shard.rows(4):
        keys = alignment.unpack_keys(raw)
        assert number == 4 and n == 100 and (alignment.bucket_of(keys) == bucket).all()
        for weight, bitmaps in [(1, docs), *((1 << k, p) for k, p in enumerate(planes))]:
            key, slot = alignment.unpack_bitmaps(bitmaps, len(keys), n)
            for k, s in zip(keys[key].tolist(), slot.tolist()):
                got[k, s] += weight
        n_docs, links = alignment._count_row(n, keys, docs, planes)
        for k, d, m in zip(keys.tolist(), n_docs.tolist(), links.tolist()):
            assert d == sum(x == k for x, _ in want) and m == sum(c for (x, _), c in want.items() if x == k)
    assert got == want


def test_bitmaps_round_trip():
    rng = random.Random(3)
    for _ in range(200):
        n_keys, n_slots = rng.randint(1, 20), rng.choice([1, 7, 8, 100, 1000])
        entries = sorted({(rng.choice([0, rng.randrange(n_keys)]), rng.randrange(n_slots)) for _ in range(rng.randint(0, 600))})
        key, slot = (np.array([e[k] for e in entries], np.int64) for k in (0, 1))
        raw = alignment.pack_bitmaps(key, slot, n_keys, n_slots)
        assert sorted(zip(*(x.tolist() for x in alignment.unpack_bitmaps(raw, n_keys, n_slots)))) == entries
        assert alignment.popcounts(raw, n_keys, n_slots).tolist() == np.bincount(key, minlength=n_keys).tolist()


def test_long_text_in_blocks(monkeypatch, rows):
    """A text of many spans gives the same in one block and in many."""
    long = [" ".join(r[1] for r in rows if r[1] and "▁" not in r[1]), None, "some words", ""] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(long, pa.string())], names=["id", "text"])
    known, seen = alignment.aligner(*alignment.default_paths()), []
    for block in (1 << 19, 50):
        monkeypatch.setattr(alignment, "BLOCK", block)
        shard = alignment._Shard()
        for digest in (True, False):
            seen.append((digest, alignment._documents(known, batch, shard, 3, digest), shard.rows(3)))
    assert [x[1:] for x in seen[:2]] == [x[1:] for x in seen[2:]]
    assert seen[0][1].column("groups").to_pylist()[:2] == [
        hashlib.sha256(seen[1][1].column("groups")[0].as_py().encode()).hexdigest(), ""
    ]


def test_empty_table(spark):
    got = alignment.align(spark.createDataFrame([], SCHEMA))
    assert got.documents.count() == 0 and got.pairs.count() == 0


def test_op12_query(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = alignment.query(spark, str(tmp_path))
    kinds = dict.fromkeys(["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"], "bigint")
    assert dict(got.dtypes) == kinds | {"groups_sha256": "string"}
    want = collections.Counter(
        (*w[:7], hashlib.sha256(w[7].encode()).hexdigest() if w[1] else "") for w in brute(rows)[0]
    )
    assert collections.Counter(tuple(r) for r in got.collect()) == want

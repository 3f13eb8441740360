"""What keeps the exchanges between chunks bounded and exact at any size."""

from __future__ import annotations

import collections
import os
import random
import re

import numpy as np
import pytest

from dimspark.llm import chunks, lm_score, near_dedup, substring_dedup
from dimspark.session import checkpoint_root

WORD = r"[^\x20\x09-\x0D]+"


def test_bounds_hold_for_a_hundred_terabytes(spark, monkeypatch):
    df = spark.range(10).selectExpr("id", "'a b' AS text")
    for size in (10**6, 10**9, 10**12, 10**14, 10**16):
        monkeypatch.setattr(chunks, "estimate", lambda df, size=size: size)
        chunk = chunks.chunk_size(size)
        table = chunks.Chunks(spark, "t", "p", min(chunks.width(spark, df), chunks.TABLE_BUCKETS), chunk)
        assert table.buckets < 100_000 and chunk <= chunks.MOST_CHUNK_BYTES
        assert chunk / chunks.KEY_BYTES / table.hash_buckets(4) >= chunks.ROW_KEYS
    stored = chunks.write_chunks(spark, df, "text")  # by the last, largest estimate
    assert stored.buckets == chunks.TABLE_BUCKETS and stored.df.count() == 10
    files, root = ([re.sub("^file:/+", "/", f) for f in names] for names in (stored.df.inputFiles(), [checkpoint_root(spark)]))
    assert files and all(f.startswith(root[0]) for f in files)
    stored.drop()
    assert not os.path.exists(os.path.dirname(files[0]))
    assert chunks.chunk_size(None) == chunks.CHUNK_BYTES


def test_unlike_windows_with_one_half_print_are_told_apart():
    import pyarrow as pa

    def ask(chunk, prints, second, ids):
        planes = [np.array(x, t).view(np.uint8).reshape(-1, 8).T.tobytes() for x, t in ((ids, np.int64), (second, np.uint64))]
        return 0, chunk, 1, chunks.pack_keys(np.array(prints, np.uint64)), b"".join(planes)

    rows = [ask(5, [3, 3, 9], [1, 2, 7], [10, 10, 10]), ask(6, [3, 9], [2, 7], [4, 30])]
    said = substring_dedup._first((pa.scalar(0),), chunks.table_of(rows, chunks.ASK))
    got = {c: substring_dedup._bits([a]).tolist() for c, a in zip(said["chunk"].to_pylist(), said["answer"].to_pylist())}
    # (3, 1) is chunk 5's own, (3, 2) starts earlier in chunk 6, (9, 7) in chunk 5
    assert got == {5: [True, False, True], 6: [True, False]}


@pytest.mark.parametrize("leave_out", [False, True])
def test_lm_scores_without_a_text_s_own_words(spark, leave_out):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefgh") + rng.choice("xy") for _ in range(rng.choice([0, 1, 2, 30]))) for _ in range(40)]
    texts += [None, "only here", "ax " * 40]
    lists = [re.findall(WORD, t or "") for t in texts]
    grams = [[collections.Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) for w in lists] for k in (1, 2, 3)]
    n = [sum(g, collections.Counter()) for g in grams]
    words = sum(n[0].values())
    want = {}
    for d, w in enumerate(lists):
        own = [g[d] if leave_out else collections.Counter() for g in grams]
        total = 0.0
        for i in range(len(w)):
            for k in range(min(i, 2), -1, -1):
                gram = tuple(w[i - k : i + 1])
                c = n[k][gram] - own[k][gram]
                if k == 0:
                    total += np.log(max(c, 1) / (words - (len(w) if leave_out else 0)))
                elif c >= 1:
                    total += np.log(c / (n[k - 1][gram[:-1]] - own[k - 1][gram[:-1]]))
                    break
                else:
                    total += np.log(0.4)
        want[d] = total
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.log_score for r in lm_score.lm_scores(docs, leave_out=leave_out).collect()}
    assert got.keys() == want.keys() and all(abs(got[d] - want[d]) < 1e-6 for d in want)


def test_signatures_do_not_depend_on_the_pieces(monkeypatch):
    """Long sets cut into pieces, alone and among short ones, sign as whole
    ones; the values are the least offers of all elements."""
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64)) for n in (1, 3, 700, 0, 5000, 40, 2500, 2)]
    seen = []
    for elements in (1 << 16, 64, 1000):
        monkeypatch.setattr(near_dedup, "ELEMENTS", elements)
        seen.append(near_dedup.superminhash(sets, 20))
    assert (seen[0] == seen[1]).all() and (seen[0] == seen[2]).all()
    alone = np.concatenate([near_dedup.superminhash([s], 20) for s in sets])
    assert (alone == seen[0]).all()


def test_signing_a_text_of_millions_of_shingles_is_bounded():
    import tracemalloc

    big = np.arange(3_000_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    tracemalloc.start()
    near_dedup.superminhash([big], 125)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20  # 375 MB of permutations at once before

"""Language-model scores by stupid backoff over the corpus's own counts.

The score of a word after its two predecessors is its trigram's count over
its history's, if the trigram occurs at least ``min_count`` times in the
corpus; else ``BACKOFF`` times the same with bigrams, else ``BACKOFF``
again times its share of all words. With a ``min_count`` of 1, as in the
registered query and its SQL, every n-gram counts.

Count tables are partitioned by n-gram hash, one order after the other.
Each chunk of documents explodes to its different n-grams with their
counts, one packed row per hash partition (:mod:`dimspark.llm.chunks`);
the partition adds the counts of all chunks up and is joined back to the
chunks that asked; scores are summed per document. An n-gram with a part
that occurs once in the corpus occurs once itself: its count is known and
it is not exchanged. (With a ``min_count`` above 1 an n-gram with a part
that is too rare is too rare itself, and not exchanged either.) What is
exchanged grows with the corpus, and a word that is in every document is
one entry per chunk.

A text is scored with counts that hold its own n-grams. ``leave_out`` takes
them away first, so that only what other texts hold speaks for it: an
n-gram is then seen if another text has it, and a word that no other text
has counts as occurring once.

Words are runs of other than ASCII white space, with A-Z lower-cased.

Defined results: a null or empty text has no words, a log_score of 0 and a
null mean; repeated rows are counted and scored each; an empty table gives
an empty table; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimspark.llm import chunks as C
from dimspark.llm.text import SPACED_LOWER, U64, mix, pair_hash, scan

ORDER, BACKOFF = 3, 0.4
BUCKETS_PER_PART = 4


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(np.int64)


class _Grams:
    """A chunk's n-grams: per order a hash for the word each ends at."""

    def __init__(self, table: pa.Table, text_col: str, min_count: int):
        self.min_count = min_count
        w = scan(table[text_col], SPACED_LOWER)
        self.count, self.doc = w.count, w.doc
        self.within = np.arange(len(w.hash)) - w.first[:-1][self.doc]
        self.gram = [w.hash]
        for k in range(1, ORDER):
            longer = np.zeros(len(w.hash), np.uint64)
            longer[1:] = pair_hash(self.gram[-1][:-1], w.hash[1:])
            self.gram.append(longer)

    def wanted(self, k: int, counts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """N-grams of order k + 1 whose counts must be asked for: their words'
        ends, the different keys, the key of each end, and its times in the
        chunk. One with a part that occurs once occurs once itself."""
        end = np.flatnonzero(self.within >= k)
        if k:
            least = max(self.min_count, 2)
            end = end[(counts[-1][end] >= least) & (counts[-1][end - 1] >= least)]
        return end, *np.unique(mix(self.gram[k][end] ^ U64(k * 0x1234567)), return_inverse=True, return_counts=True)

    def counts(self, said: pa.Table, orders: int) -> list[np.ndarray]:
        """Corpus counts of the n-grams that end at each word, by order."""
        out: list[np.ndarray] = []
        for k in range(orders):
            end, _, key_of, _ = self.wanted(k, out)
            got = C.answers(said, k)
            c = (self.within >= k).astype(np.int64)  # not asked for: once (or too rare, by min_count)
            if got:
                c[end] = np.concatenate([_unplanes(x) for x in got])[key_of]
            out.append(c)
        return out

    def own(self, k: int) -> np.ndarray:
        """How often its text itself holds the n-gram that ends at each word."""
        end = np.flatnonzero(self.within >= k)
        _, back, times = np.unique(
            np.stack([self.doc[end].astype(np.uint64), self.gram[k][end]]), axis=1, return_inverse=True, return_counts=True
        )
        out = np.zeros(len(self.doc), np.int64)
        out[end] = times[back.ravel()]
        return out


def _add_up(key, table):
    """Counts of a hash partition, sent back to every chunk that asked."""
    rows = table.select(["chunk", "bucket", "kind", "keys", "extra"]).to_pylist()
    keys = [C.unpack_keys(r["keys"]) for r in rows]
    _, back = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(back, np.concatenate([_unplanes(r["extra"]) for r in rows])).astype(np.int64)
    parts = np.split(total[back], np.cumsum([len(k) for k in keys])[:-1])
    return C.table_of([(r["chunk"], r["bucket"], r["kind"], _planes(n)) for r, n in zip(rows, parts)], C.ANSWER)


def lm_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = 1, leave_out: bool = False
) -> DataFrame:
    """id, n_words, log_score (sum of natural logarithms) and mean_log_score.
    Bigrams and trigrams that occur less than min_count (>= 1) times are
    backed off from; with leave_out a text's own n-grams do not count."""
    if min_count < 1:
        raise ValueError("min_count is at least 1")
    spark = docs.sparkSession
    stored = C.write_chunks(spark, docs.select(id_col, text_col), text_col)
    n = stored.hash_buckets(BUCKETS_PER_PART)

    def asking(k: int):
        def ask(key, table, said):
            g = _Grams(table, text_col, min_count)
            _, keys, _, times = g.wanted(k, g.counts(said, k))
            cut, rows = C.bucket_cuts(keys, n), []
            for b in np.flatnonzero(np.diff(cut)):
                part = slice(cut[b], cut[b + 1])
                rows.append((int(b), key[0].as_py(), k, C.pack_keys(keys[part]), _planes(times[part])))
            return C.table_of(rows, C.ASK)

        return ask

    def add(key, table, said):
        g = _Grams(table, text_col, min_count)
        words, counts = len(g.doc), g.counts(said, ORDER)
        if leave_out:
            counts = [c - g.own(k) for k, c in enumerate(counts)]
        score = np.log(np.maximum(counts[0], 1))
        shares = np.ones(words, np.int64)  # scores that still lack the division by all words
        tries = np.minimum(g.within, ORDER - 1)
        score += tries * np.log(BACKOFF)
        for k in range(1, ORDER):
            seen = np.flatnonzero((counts[k] >= min_count) & (g.within >= k))
            score[seen] = np.log(counts[k][seen] / counts[k - 1][seen - 1]) + (tries[seen] - k) * np.log(BACKOFF)
            shares[seen] = 0
        total = np.bincount(g.doc, score, len(g.count))
        return pa.table(
            [table[id_col], pa.array(g.count.astype(np.int64)), pa.array(total), pa.array(np.bincount(g.doc, shares, len(g.count)))],
            names=[id_col, "n_words", "part", "shares"],
        )

    by_chunk = stored.df.groupBy(C.CHUNK)
    kind = docs.schema[id_col].dataType.simpleString()
    said = spark.createDataFrame([], C.ANSWER)
    tables = []
    for k in range(ORDER):
        asked = by_chunk.cogroup(said.groupBy("chunk")).applyInArrow(asking(k), C.ASK)
        tables.append(C.store(spark, asked.groupBy("bucket").applyInArrow(_add_up, C.ANSWER), "counts"))
        said = tables[0] if not k else said.unionByName(tables[-1])
    scored = by_chunk.cogroup(said.groupBy("chunk")).applyInArrow(
        add, f"`{id_col}` {kind}, n_words long, part double, shares double"
    )
    scored = C.store(spark, scored, "lm-scores")
    stored.drop()
    C.discard(*tables)
    words = scored.agg(F.sum("n_words")).first()[0] or 1
    total = F.lit(float(words)) - F.col("n_words") if leave_out else F.lit(float(words))
    score = F.col("part") - F.col("shares") * F.log(F.greatest(total, F.lit(1.0)))
    return scored.select(
        id_col,
        "n_words",
        score.alias("log_score"),
        F.when(F.col("n_words") > 0, score / F.col("n_words")).alias("mean_log_score"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op5: scores of every document under the corpus's own trigram model."""
    found = lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score")
    )


SQL = r"""
WITH lists AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents),
words AS (SELECT r, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM lists),
grams AS (SELECT r, i, a, lag(a, 1) OVER o AS b, lag(a, 2) OVER o AS c FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
n AS (SELECT count(*) AS n FROM words),
c1 AS (SELECT a, count(*) AS n FROM grams GROUP BY a),
c2 AS (SELECT b, a, count(*) AS n FROM grams WHERE b IS NOT NULL GROUP BY b, a),
c3 AS (SELECT c, b, a, count(*) AS n FROM grams WHERE c IS NOT NULL GROUP BY c, b, a),
scored AS (
  SELECT g.r, CASE
      WHEN t.n >= 1 THEN ln(t.n / h.n)
      WHEN p.n >= 1 THEN ln(p.n / q.n) + (least(g.i, 3) - 2) * ln(0.4)
      ELSE ln(u.n / (SELECT n FROM n)) + (least(g.i, 3) - 1) * ln(0.4) END AS s
  FROM grams g JOIN c1 u ON u.a = g.a
  LEFT JOIN c1 q ON q.a = g.b
  LEFT JOIN c2 p ON p.a = g.a AND p.b = g.b
  LEFT JOIN c2 h ON h.a = g.b AND h.b = g.c
  LEFT JOIN c3 t ON t.a = g.a AND t.b = g.b AND t.c = g.c),
sums AS (SELECT r, sum(s) AS s FROM scored GROUP BY r)
SELECT doc_id, len(w) AS n_words, round(coalesce(s, 0), 4) AS log_score,
       CASE WHEN len(w) > 0 THEN round(s / len(w), 6) END AS mean_log_score
FROM lists LEFT JOIN sums USING (r)
"""

"""Document quality: fixed rules, and a calibrated n-gram classifier.

*Features.* A document is the relative frequencies of its character
four-grams (bytes, as written) and of its words and word pairs, hashed
into two tables of ``2 ** BITS`` weights. Its margin is the mean weight of
its character grams plus that of its word grams, so scoring is one look-up
per gram and nothing is sorted or counted.

*Training.* Logistic regression on labelled documents: partitions run
AdaGrad steps, their weights are averaged, round after round. Labelled rows
are read up to ``max_docs`` of them (by a hash of the id), the only bound.

*Calibration.* A quarter of those rows is not trained on; Platt's curve is
fitted there and turns margins into probabilities. A document is kept if
it passes the rules and its probability of good quality is at least
``KEEP``.

Defined results: null and empty texts have no words, so the rules reject
them; labels that are null or whose document is missing are not used; with
no labelled row of either class the probability is the class share, 1/2
if there is none at all; repeated rows are judged alike; an empty table
gives an empty table; further columns are kept as they are, but for names
that this operator writes, which it replaces.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.llm.labels import fit_curve, labelled_texts, sample_labels
from dimspark.llm.text import SPACED, U64, Words, mix, pair_hash, scan, slices, span_hashes

BITS, GRAM = 17, 4
KEEP = 0.5
SLICES = 64  # in which the weights are averaged
SCALE = 20.0  # of the relative frequencies, so that weights stay small
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_BYTES = mix(np.arange(1, 257, dtype=np.uint64)) | U64(1)

RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS, REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _dup_lines(w: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    n_texts = len(w.offsets) - 1
    cut = np.flatnonzero(w.data == 10)
    bounds = np.unique(np.concatenate([w.offsets, cut, cut + 1]))
    start, end = bounds[:-1], bounds[1:]
    line = ~((end - start == 1) & (w.data[np.minimum(start, max(len(w.data) - 1, 0))] == 10)) if len(start) else np.zeros(0, bool)
    start, end = start[line], end[line]
    with_word = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end = start[with_word], end[with_word]
    doc = np.searchsorted(w.offsets, start, "right") - 1
    hashes = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + (1 << 20), "right")))
        at = start[i]
        hashes[i:j] = span_hashes(_BYTES[w.data[at : end[j - 1]]], start[i:j] - at, end[i:j] - at)
        i = j
    _, first = np.unique(pair_hash(hashes, doc.astype(np.uint64)), return_index=True)
    return np.bincount(doc, minlength=n_texts) - np.bincount(doc[first], minlength=n_texts)


def repeat_words(w: Words, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Words in windows that their text holds twice or more."""
    n_texts, doc = len(w.offsets) - 1, w.doc
    n = max(len(w.hash) - window + 1, 0)
    h = w.hash[:n]
    for k in range(1, window):
        h = pair_hash(h, w.hash[k : n + k])
    at = np.flatnonzero(doc[:n] == doc[window - 1 :]) if n else np.zeros(0, np.int64)
    key = pair_hash(h[at], doc[at].astype(np.uint64))
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    at = at[times[back] > 1] if len(at) else at
    change = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + window, -1)
    return np.bincount(doc[np.cumsum(change[:-1]) > 0], minlength=n_texts)


def rules(w: Words) -> dict[str, np.ndarray]:
    letters = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    chars = np.concatenate([[0], np.cumsum(letters[w.end] - letters[w.start])])
    return {
        "n_words": w.count.astype(np.int64),
        "word_chars": chars[w.first[1:]] - chars[w.first[:-1]],
        "n_symbols": _per_text(SYMBOLS[w.data], w.offsets),
        "n_dup_lines": _dup_lines(w),
        "n_repeat_words": repeat_words(w),
    }


def base_failed(r: dict[str, np.ndarray]) -> np.ndarray:
    return (r["n_words"] < MIN_WORDS) | (100 * r["n_repeat_words"] > REPEAT_PERCENT * r["n_words"])


def char_grams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(weight number, text) of every character gram."""
    n = max(len(w.data) - GRAM + 1, 0)
    h = np.zeros(n, np.uint32)
    for k in range(GRAM):
        h = (h << np.uint32(8)) | w.data[k : n + k]
    h = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    doc = np.repeat(np.arange(len(w.offsets) - 1), np.diff(w.offsets))
    inside = doc[:n] == doc[GRAM - 1 :] if n else np.zeros(0, bool)
    return h[inside].astype(np.int64), doc[:n][inside]


def word_grams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    doc = w.doc
    pair = doc[:-1] == doc[1:]
    h = np.concatenate([w.hash, pair_hash(w.hash[:-1], w.hash[1:])[pair]])
    return (mix(h) >> U64(64 - BITS)).astype(np.int64) + (1 << BITS), np.concatenate([doc, doc[:-1][pair]])


@dataclass
class Model:
    weight: np.ndarray
    bias: float
    curve: np.ndarray
    prior: float | None = None

    def margins(self, w: Words) -> np.ndarray:
        n = len(w.offsets) - 1
        out = np.full(n, self.bias)
        for gram, doc in (char_grams(w), word_grams(w)):
            total = np.bincount(doc, self.weight[gram], n)
            out += SCALE * total / np.maximum(np.bincount(doc, minlength=n), 1)
        return out

    def score(self, margin: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(margin), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * margin + self.curve[1], -30, 30)))


def _rows(texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text as (weight numbers, values)."""
    w = scan(texts, SPACED)
    n = len(w.offsets) - 1
    out = [([], []) for _ in range(n)]
    for gram, doc in (char_grams(w), word_grams(w)):
        order = np.argsort(doc, kind="stable")
        cuts = np.searchsorted(doc[order], np.arange(n + 1))
        for i in range(n):
            g, times = np.unique(gram[order[cuts[i] : cuts[i + 1]]], return_counts=True)
            out[i][0].append(g)
            out[i][1].append(SCALE * times / max(times.sum(), 1))
    return [(np.concatenate(a), np.concatenate(b)) for a, b in out]


def _steps(shared, seed: int):
    def steps(batches):
        weight, bias, balance = shared.value
        weight = weight.astype(np.float64)
        rows, label = [], []
        for b in slices(batches, "text", 1 << 20):  # max_docs / partitions documents at most
            rows += _rows(b.column("text"))
            label += b.column("label").to_pylist()
        if not rows:
            return
        rng, scale, bias_scale = np.random.default_rng(seed), np.full(len(weight), 1e-2), 1e-2
        for _ in range(3):
            for i in rng.permutation(len(rows)).tolist():
                g, v = rows[i]
                p = 1 / (1 + np.exp(-np.clip(weight[g] @ v + bias, -30, 30)))
                slope = (p - label[i]) * (balance if not label[i] else 1.0)
                step = slope * v + 1e-6 * weight[g]
                scale[g] += step * step
                weight[g] -= 0.2 * step / np.sqrt(scale[g])
                bias_scale += slope * slope
                bias -= 0.1 * slope / np.sqrt(bias_scale)
        parts = [p.astype("<f4").tobytes() for p in weight.reshape(SLICES, -1)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(SLICES), pa.int32()), pa.array([len(rows)] * SLICES, pa.int64()),
                pa.array([float(bias)] * SLICES), pa.array(parts, pa.binary()),
            ],
            names=["slice", "n", "bias", "weight"],
        )

    return steps


def _average(key, table):
    """The mean of the partitions' weights, for one slice of them."""
    n = table["n"].to_numpy()
    mean = sum(np.frombuffer(w, "<f4") * np.float32(k / n.sum()) for w, k in zip(table["weight"].to_pylist(), n))
    return pa.table(
        [pa.array([key[0].as_py()], pa.int32()), pa.array([float(table["bias"].to_numpy() @ n / n.sum())]), pa.array([mean.tobytes()], pa.binary())],
        names=["slice", "bias", "weight"],
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_docs: int = 8_000,
    rounds: int = 3,
) -> Model:
    spark = docs.sparkSession
    sample = labelled_texts(docs, sample_labels(labels, id_col, label_col, max_docs), id_col, text_col)
    n = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    yes, no = n.get(1, 0), n.get(0, 0)
    weight, bias = np.zeros(2 << BITS, np.float32), 0.0
    if not yes or not no:
        return Model(weight, 0.0, np.zeros(2), (yes + 0.5) / (yes + no + 1))
    parts = 6  # weights of so many partitions are averaged
    fold = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4))
    fit, held = sample.where(fold > 0).repartition(parts, "id"), sample.where(fold == 0)
    for seed in range(rounds):
        state = spark.sparkContext.broadcast((weight, bias, min(10.0, yes / no)))
        steps = fit.mapInArrow(_steps(state, seed), "slice int, n long, bias double, weight binary")
        mean = steps.groupBy("slice").applyInArrow(_average, "slice int, bias double, weight binary")
        got = sorted(mean.collect(), key=lambda r: r.slice)  # one set of weights, however many partitions
        weight, bias = np.concatenate([np.frombuffer(r.weight, "<f4") for r in got]), got[0].bias
        state.destroy()
    model = Model(weight, bias, np.array([1.0, 0.0]))
    shared = spark.sparkContext.broadcast(model)

    def margins(batches):
        for b in slices(batches, "text", 1 << 20):
            m = shared.value.margins(scan(b.column("text"), SPACED))
            yield pa.RecordBatch.from_arrays([pa.array(m), b.column("label")], names=["margin", "label"])

    found = np.array(held.mapInArrow(margins, "margin double, label int").collect(), float)  # bounded by max_docs
    if len(found) and 0 < found[:, 1].sum() < len(found):
        model.curve = fit_curve(found[:, :1], found[:, 1])
    return model


def judge(docs: DataFrame, model: Model, text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """docs with the rules' figures, base_failed, quality (the probability)
    and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    new = [*(T.StructField(n, T.LongType()) for n in RULES)]
    new += [T.StructField("base_failed", T.BooleanType()), T.StructField("quality", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    old = [f for f in docs.schema.fields if f.name not in {n.name for n in new}]

    def run(batches):
        for b in slices(batches, text_col, 1 << 20):
            w = scan(b.column(text_col), SPACED)
            r = rules(w)
            failed, p = base_failed(r), shared.value.score(shared.value.margins(w))
            added = [*(r[n].astype(np.int64) for n in RULES), failed, p, ~failed & (p >= keep)]
            columns = [b.column(b.schema.get_field_index(f.name)) for f in old]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, added)], names=[f.name for f in old + new])

    return docs.mapInArrow(run, T.StructType(old + new))


def query(spark, sf_dir: str) -> DataFrame:
    """op2: rules and verdict for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
    return judge(docs, model).drop("text")

"""Toxicity by a subsequence-kernel support vector machine.

*Kernel.* Two words are as alike as the three-character subsequences they
share. A subsequence may leave characters out; each one left out costs a
factor ``DECAY``, and a subsequence spans at most ``SPAN`` characters. The
kernel is normalised and raised to ``POWER``, which keeps it a kernel and
makes it answer to like words only. Words are lower-cased and stripped of
everything but letters and digits (``i-d-i*o-t`` is ``idiot``), three or
more single letters in a row are read as one word (``i d i o t``), and
inserted letters cost a gap (``idxiot``). A sentence is the sum of its
different words.

*Nystrom.* Landmarks are training words: those most associated with the
toxic class by a likelihood ratio, and words of other documents that
look most like those. A sentence's kernel values to the landmarks, times the inverse square root
of the landmarks' own kernel matrix, are its features.

*Training.* A linear SVM (squared hinge loss) is trained on the sentences of
labelled documents, each sentence under its document's label, and of each
also a copy with a letter put into every longer word, so that the machine
learns words with a gap, harmless ones too; after the first round a marked
document stands for its worst sentences only.
Partitions run stochastic gradient steps and their weights are averaged,
round after round. Since the machine is linear in the landmarks, a word has a fixed
score and a sentence the sum of them. A logistic curve, fitted to labelled
documents not used for the SVM, turns a document's two worst sentences, its
share of bad ones and how many bad words it has into a probability.

Labelled rows are read up to ``max_docs`` of them (by a hash of the id),
the only bound; every document is scored, on its whole text.

Defined results: null and empty texts are scored as texts without words;
labels that are null or whose document is missing are not used; with no
labelled row of either class the score is the class share, 1/2 if there is
none at all; repeated rows are scored alike; an empty table gives an empty
table; columns other than id and text are never read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimspark.llm.chunks import cleaning, store
from dimspark.llm.labels import fit_curve, labelled_texts, sample_labels
from dimspark.llm.text import SPACED_LOWER, scan, slices, text_bytes, word_bytes

DECAY, SPAN, POWER = 0.6, 5, 3
LONGEST = 24  # words of a sentence
LEAST = 0.03  # kernel values below are taken for zero
FEATURES = 5  # of a document
MAX_WORDS = 400_000  # remembered words of a worker; the memory starts anew beyond
WORDS_AT_ONCE, BYTES_AT_ONCE = 1024, 16384  # a block of words that the kernel is found for
SHAPES = [(j, k, DECAY ** (k - 2)) for k in range(2, SPAN) for j in range(1, k)]  # offsets of the 2nd and 3rd character


def plain(word: bytes) -> bytes:
    """Letters and digits of a word, lower-cased (also Latin-1 letters)."""
    out = bytearray()
    for c in word:
        if 0x41 <= c <= 0x5A:
            c += 32
        if 0x61 <= c <= 0x7A or 0x30 <= c <= 0x39 or c >= 0x80:
            if out and out[-1] == 0xC3 and 0x80 <= c <= 0x9E and c != 0x97:
                c += 32
            out.append(c)
    return bytes(out)


_KEEP = np.array([i >= 0x80 or chr(i).isalnum() for i in range(256)])
_LOWER = np.array([i + 32 if 0x41 <= i <= 0x5A else i for i in range(256)], np.uint8)


def _plain_all(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """plain() of many byte spans, each between a begin and an end mark:
    (characters, word of each)."""
    size = end - start
    word = np.repeat(np.arange(len(start)), size)
    c = _LOWER[data[np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)]]
    keep = _KEEP[c]
    c, word = c[keep].copy(), word[keep]
    accent = (c >= 0x80) & (c <= 0x9E) & (c != 0x97)
    accent[1:] &= (c[:-1] == 0xC3) & (word[1:] == word[:-1])
    accent[:1] = False
    c[accent] += 32
    n = np.bincount(word, minlength=len(start))
    out = np.empty(len(c) + 2 * len(start), np.uint8)
    first = np.cumsum(n + 2) - (n + 2)
    out[first], out[first + n + 1] = 2, 3
    out[np.arange(len(c)) + 2 * word + 1] = c
    return out, np.repeat(np.arange(len(start)), n + 2)


def subsequences(chars: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, weight), sorted by the first two, each once."""
    keys, weights = [], []
    c = chars.astype(np.int64)
    for j, k, w in SHAPES:
        n = max(len(c) - k, 0)
        i = np.flatnonzero(word[:n] == word[k:]) if n else np.zeros(0, np.int64)
        keys.append((word[i] << 24) | (c[i] << 16) | (c[i + j] << 8) | c[i + k])
        weights.append(np.full(len(i), w, np.float32))
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key)
    key, weight = key[order], weight[order]
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    heads = np.flatnonzero(head)
    weight = np.add.reduceat(weight, heads) if len(heads) else weight
    return key[heads] >> 24, key[heads] & 0xFFFFFF, weight


class Landmarks:
    """Words with their subsequences, indexed by subsequence."""

    def __init__(self, words: list[bytes]):
        self.words = words
        data = np.frombuffer(b"".join(words), np.uint8)
        end = np.cumsum([len(w) for w in words]).astype(np.int64)
        start = np.concatenate([[0], end[:-1]]).astype(np.int64) if len(words) else end
        mark, sub, weight = subsequences(*_plain_all(data, start, end))
        norm = np.sqrt(np.bincount(mark, weight.astype(np.float64) ** 2, len(words)))
        order = np.argsort(sub, kind="stable")
        self.mark, self.value = mark[order], (weight / np.maximum(norm, 1e-9)[mark])[order]
        self.sub, self.first = np.unique(sub[order], return_index=True)
        self.first = np.append(self.first, len(sub))
        # a subsequence's place in self.sub plus one, by its characters' numbers among
        # those of the landmarks; 0: not there
        used = np.unique(np.concatenate([self.sub >> 16, self.sub >> 8 & 255, self.sub & 255]))
        self.n_chars = len(used) + 1
        self.number = np.zeros(256, np.int64)
        self.number[used] = np.arange(1, self.n_chars)
        self.place = np.zeros(self.n_chars**3, np.int32)
        self.place[self._cells(self.sub)] = np.arange(1, len(self.sub) + 1)

    def _cells(self, sub: np.ndarray) -> np.ndarray:
        a, b, c = (self.number[sub >> k & 255] for k in (16, 8, 0))
        return (a * self.n_chars + b) * self.n_chars + c

    def kernel(self, data, start, end) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, landmark, value) of the words data[start:end], where the
        value is not negligible, by word."""
        out = [(word + at, mark, value) for at, word, mark, value in self._blocks(data, start, end)]
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return tuple(np.concatenate(x) for x in zip(*out))

    def scores(self, data, start, end, alpha: np.ndarray) -> np.ndarray:
        """The words' kernel values times alpha."""
        out = np.zeros(len(start))
        for at, word, mark, value in self._blocks(data, start, end):
            part = np.bincount(word, value * alpha[mark])
            out[at : at + len(part)] = part
        return out

    def _blocks(self, data, start, end):
        """(first word, word counted from it, landmark, value) of a block of
        words at a time: what is held follows from the block, not from the
        number of words."""
        m = len(self.words)
        size, at = np.concatenate([[0], np.cumsum(end - start)]), 0
        while at < len(start) and m:
            stop = int(np.searchsorted(size, size[at] + BYTES_AT_ONCE, "right")) - 1
            stop = min(max(stop, at + 1), at + WORDS_AT_ONCE, len(start))
            rows = stop - at
            word, sub, weight = subsequences(*_plain_all(data, start[at:stop], end[at:stop]))
            norm = np.maximum(np.sqrt(np.bincount(word, weight.astype(np.float64) ** 2, rows)), 1e-9)
            i = self.place[self._cells(sub)] - 1
            known = np.flatnonzero(i >= 0)
            i, word, weight = i[known], word[known], weight[known]
            n = self.first[i + 1] - self.first[i]
            entry = np.arange(n.sum()) + np.repeat(self.first[i] - (np.cumsum(n) - n), n)
            cell = np.repeat(word * m, n) + self.mark[entry]
            total = np.bincount(cell, np.repeat(weight, n) * self.value[entry], rows * m)
            # only cells that may be above LEAST are worked out
            cell = np.flatnonzero(total.reshape(rows, m) > 0.99 * LEAST ** (1 / POWER) * norm[:, None])
            word, mark = cell // m, cell % m
            value = (total[cell] / norm[word]) ** POWER
            good = value > LEAST
            yield at, word[good], mark[good], value[good]
            at = stop


@dataclass
class Sentences:
    """Different words of a text column and the sentences they stand in."""

    data: np.ndarray  # bytes of the different words
    start: np.ndarray
    end: np.ndarray
    key: np.ndarray  # their hashes; words joined of single letters come last and have none
    word: np.ndarray  # pairs of a word and a sentence it stands in,
    sentence: np.ndarray  # by sentence; each pair once
    text: np.ndarray  # of each sentence


def sentences(texts) -> Sentences:
    w = scan(texts, SPACED_LOWER)
    doc = w.doc
    line = np.concatenate([[0], np.cumsum(w.data == 10)])
    stop = np.isin(w.data[w.end - 1], np.frombuffer(b".!?", np.uint8)) if len(w.end) else np.zeros(0, bool)
    new = np.ones(len(w.hash), bool)
    new[1:] = (doc[1:] != doc[:-1]) | stop[:-1] | (line[w.start[1:]] != line[w.end[:-1]])
    begin = np.flatnonzero(new)
    within = np.arange(len(new)) - np.repeat(begin, np.diff(np.append(begin, len(new))))
    new |= within % LONGEST == 0  # text without stops is cut
    sentence = np.cumsum(new) - 1
    # single letters in a row are read as one word too
    one = (w.end - w.start == 1) & _KEEP[w.data[w.start]] if len(w.hash) else np.zeros(0, bool)
    change = np.flatnonzero(np.diff(np.concatenate([[0], (one & True).astype(np.int8), [0]])))
    extra, extra_at = [], []
    for a, b in zip(change[::2].tolist(), change[1::2].tolist()):
        if b - a >= 3:
            for i, j in zip(*_cut_by(doc, a, b)):
                if j - i >= 3:
                    extra.append(w.data[w.start[i:j]].tobytes())
                    extra_at.append(sentence[i])
    order = np.argsort(w.hash)
    key = w.hash[order]
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    first = order[head]  # any place of the word
    back = np.empty(len(key), np.int64)
    back[order] = np.cumsum(head) - 1
    key = key[head]
    data, start, end = w.data, w.start[first], w.end[first]
    if extra:
        at = len(data) + np.cumsum([0] + [len(x) for x in extra])
        data = np.concatenate([data, np.frombuffer(b"".join(extra), np.uint8)])
        start, end = np.concatenate([start, at[:-1]]), np.concatenate([end, at[1:]])
        back = np.concatenate([back, len(key) + np.arange(len(extra))])
        sentence_of = np.concatenate([sentence, extra_at])
    else:
        sentence_of = sentence
    # a word counts once in a sentence, however often it is repeated there
    n = max(len(start), 1)
    pair = np.sort(sentence_of * n + back)
    pair = pair[np.concatenate([[True], pair[1:] != pair[:-1]])] if len(pair) else pair
    return Sentences(data, start, end, key, pair % n, pair // n, doc[new])


def _cut_by(doc: np.ndarray, a: int, b: int) -> tuple[list[int], list[int]]:
    cuts = [a, *(a + 1 + np.flatnonzero(np.diff(doc[a:b]))).tolist(), b]
    return cuts[:-1], cuts[1:]


@dataclass
class Model:
    landmarks: Landmarks
    alpha: np.ndarray  # score of a word: kernel values @ alpha
    bias: float
    curve: np.ndarray  # logistic weights of a document's features, last the constant
    prior: float | None = None  # the score of everything, without two classes

    def word_scores(self, s: Sentences, memory: dict[str, np.ndarray]) -> np.ndarray:
        """Scores of the different words. ``memory`` holds those met before, as
        sorted word hashes and their scores (16 bytes a word); words without
        a hash are scored anew each time."""
        keys, scores = memory.get("keys", np.zeros(0, np.uint64)), memory.get("scores", np.zeros(0))
        if len(keys) > MAX_WORDS:
            keys, scores = keys[:0], scores[:0]
        at = np.searchsorted(keys, s.key)
        known = np.zeros(len(s.key), bool)
        inside = at < len(keys)
        known[inside] = keys[at[inside]] == s.key[inside]
        new = np.flatnonzero(~known)
        scored = np.concatenate([new, np.arange(len(s.key), len(s.start))])
        found = self.landmarks.scores(s.data, s.start[scored], s.end[scored], self.alpha)
        out = np.empty(len(s.start))
        out[: len(s.key)][known] = scores[at[known]]
        out[scored] = found
        memory["keys"] = np.insert(keys, at[new], s.key[new])
        memory["scores"] = np.insert(scores, at[new], found[: len(new)])
        return out

    def features(self, texts, memory: dict[str, np.ndarray]) -> np.ndarray:
        """Of each text: its worst and second worst sentence's margin (the
        bias, if there is none), the share of bad sentences, and how much bad
        words there are, by number (as a logarithm) and by share."""
        s = sentences(texts)
        n = len(texts)
        out = np.full((n, FEATURES), self.bias)
        out[:, 2:] = 0
        if len(s.word):
            score = self.word_scores(s, memory)[s.word]
            margin = np.bincount(s.sentence, score, len(s.text)) + self.bias
            worse = np.bincount(s.text[s.sentence], np.clip(score, 0, 1), n)
            out[:, 3] = np.log1p(worse)
            out[:, 4] = 10 * worse / np.maximum(np.bincount(s.text[s.sentence], minlength=n), 1)
            order = np.lexsort((-margin, s.text))
            first = np.searchsorted(s.text[order], np.arange(n + 1))
            some, two = np.diff(first) > 0, np.diff(first) > 1
            out[some, 0] = margin[order][first[:-1][some]]
            out[two, 1] = margin[order][first[:-1][two] + 1]
            bad = np.bincount(s.text, margin > 0, n)
            out[:, 2] = bad / np.maximum(np.diff(first), 1)
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(features), self.prior)
        return 1 / (1 + np.exp(-np.clip(features @ self.curve[:-1] + self.curve[-1], -30, 30)))


def _word_counts(batches):
    """Of labelled texts: in how many toxic and other texts a word occurs."""
    for b in slices(batches, "text", 2 << 20):
        w = scan(b.column("text"), SPACED_LOWER)
        toxic = np.asarray(b.column("label").to_numpy(zero_copy_only=False), bool)
        _, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
        pair = np.unique(back * len(toxic) + w.doc) if len(back) else np.zeros(0, np.int64)
        word, doc = pair // max(len(toxic), 1), pair % max(len(toxic), 1)
        yes = np.bincount(word, toxic[doc], len(first)).astype(np.int64)
        total = np.bincount(word, minlength=len(first))
        words = [plain(word_bytes(w, int(i))) for i in first]
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array(yes), pa.array(total - yes)], names=["word", "yes", "no"]
        )


def _likeness(shared):
    """How like its nearest landmark a word is."""

    def likeness(batches):
        marks = shared.value
        for b in batches:
            data, off = text_bytes(b.column("word").cast(pa.binary()))
            word, _, value = marks.kernel(data, off[:-1], off[1:])
            best = np.zeros(b.num_rows)
            np.maximum.at(best, word, value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(best)], names=[*b.schema.names, "like"])

    return likeness


def choose_landmarks(sample: DataFrame, n_yes: int, n_no: int, toxic: int, other: int) -> list[bytes]:
    """The words most associated with the class, and of the others the
    frequent ones that look most like them."""
    spark = sample.sparkSession
    counts = sample.mapInArrow(_word_counts, "word binary, yes long, no long")
    counts = counts.where("length(word) between 3 and 40").groupBy("word").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    counts = store(spark, counts.where("yes + no > 1"), "toxic-words")

    def part(k, n):
        return F.when(k > 0, k * F.log(k / n)).otherwise(0.0)

    n = F.col("yes") + F.col("no")
    share = n_yes / (n_yes + n_no)
    ratio = part(F.col("yes"), n * share) + part(F.col("no"), n * (1 - share))
    top = counts.where(F.col("yes") > n * share).orderBy(ratio.desc(), "word").limit(toxic).select("word")
    found = {bytes(r[0]) for r in top.collect()}
    marks = spark.sparkContext.broadcast(Landmarks(sorted(found)))
    rest = counts.where(F.col("yes") <= 2 * n * share).mapInArrow(_likeness(marks), "word binary, yes long, no long, like double")
    rest = rest.orderBy((F.col("like") * F.log1p("no")).desc(), "word").limit(other).select("word")
    return sorted(found | {bytes(r[0]) for r in rest.collect()})


def altered(text: str | None) -> str:
    """The text with a letter put into every word of three letters or more:
    place and letter follow from the word."""

    def insert(m: re.Match) -> str:
        word = m[0]
        h = zlib.crc32(word.encode())
        at = 1 + h % (len(word) - 1)
        return word[:at] + "abcdefghijklmnopqrstuvwxyz"[h // 64 % 26] + word[at:]

    return re.sub(r"[^\W\d_]{3,}", insert, text or "")


def _with_altered(batches):
    """Labelled texts, each also with a letter put into its words: the
    machine then learns what a word with a gap is like, of both classes.
    Called within the steps that use them: a step of its own would take
    another Python worker beside each of theirs."""
    for b in slices(batches, "text", 1 << 20):
        yield b
        texts = pa.array([altered(t) for t in b.column("text").to_pylist()], pa.string())
        ids = pa.array([f"{i}~" for i in b.column("id").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([ids, texts, b.column("label")], names=["id", "text", "label"])


def _svm_rows(shared):
    """Sentences as landmark kernel values, with their text's label, of
    labelled texts and their altered copies."""

    def rows(batches):
        marks = shared.value
        for b in slices(_with_altered(batches), "text", 1 << 20):
            s = sentences(b.column("text"))
            label = np.asarray(b.column("label").to_numpy(zero_copy_only=False), bool)
            word, mark, value = marks.kernel(s.data, s.start, s.end)
            first = np.searchsorted(word, np.arange(len(s.start) + 1))
            lo = first[s.word]
            n = first[s.word + 1] - lo
            at = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
            ends = np.searchsorted(np.repeat(s.sentence, n), np.arange(len(s.text) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("id").take(pa.array(s.text)),
                    pa.array(label[s.text].astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(mark[at].astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(value[at].astype(np.float32))),
                ],
                names=["id", "y", "mark", "value"],
            )

    return rows


def _svm_steps(shared, seed: int):
    """Stochastic gradient steps over a partition's sentences. Every
    sentence of an unmarked document is a negative one. Of a marked
    document the sentences that the weights so far find bad are positive,
    its worst one in any case; the rest say nothing and are left out (in
    the first round, without weights, all are positive)."""

    def steps(batches):
        whiten, weight, bias, balance = shared.value
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        t = pa.Table.from_batches(batches).combine_chunks()  # max_docs / partitions documents at most
        del batches
        y = t["y"].to_numpy() * 2.0 - 1
        doc = t["id"].chunk(0).dictionary_encode().indices.to_numpy()
        lists = t["mark"].chunk(0)
        mark, value = lists.flatten().to_numpy(), t["value"].chunk(0).flatten().to_numpy()
        first = lists.offsets.to_numpy() - lists.offsets.to_numpy()[0]

        def rows(k):
            n = first[k + 1] - first[k]
            at = np.arange(n.sum()) + np.repeat(first[k] - (np.cumsum(n) - n), n)
            z = np.zeros((len(k), len(whiten)), np.float32)
            z[np.repeat(np.arange(len(k)), n), mark[at]] = value[at]
            return z @ whiten

        use = np.ones(len(y), bool)
        if seed:
            alpha = whiten @ weight
            margin = np.full(len(y), float(bias))
            for i in range(0, len(y), 8192):
                n = np.diff(first[i : i + 8193])
                at = slice(first[i], first[i] + n.sum())
                margin[i : i + 8192] += np.bincount(np.repeat(np.arange(len(n)), n), value[at] * alpha[mark[at]], len(n))
            worst = np.full(doc.max() + 1, -np.inf)
            np.maximum.at(worst, doc, margin)
            use = (y < 0) | (margin > 0) | (margin == worst[doc])
        used = np.flatnonzero(use)
        weight, rng = weight.copy(), np.random.default_rng(seed)
        balance = min(balance, (y[used] < 0).sum() / max((y[used] > 0).sum(), 1))
        scale, bias_scale = np.full(len(weight), 1e-3), 1e-3  # AdaGrad
        mean, mean_bias, n = np.zeros(len(weight)), 0.0, 0
        for epoch in range(2):
            order = rng.permutation(used)
            for block in (order[i : i + 1024] for i in range(0, len(order), 1024)):
                features = rows(block)
                for i in range(0, len(block), 64):
                    x, k = features[i : i + 64], block[i : i + 64]
                    short = np.maximum(1 - y[k] * (x @ weight + bias), 0) * np.where(y[k] > 0, balance, 1.0) * y[k]
                    step = 1e-4 * weight - (short @ x) / len(k)
                    scale += step * step
                    weight = weight - 0.1 * step / np.sqrt(scale)
                    step = -short.mean()
                    bias_scale += step * step
                    bias -= 0.1 * step / np.sqrt(bias_scale)
                    if epoch:
                        mean, mean_bias, n = mean + weight, mean_bias + bias, n + 1
        weight, bias = mean / n, mean_bias / n
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int64()), pa.array([float(bias)]), pa.array([weight.tolist()], pa.list_(pa.float64()))],
            names=["n", "bias", "weight"],
        )

    return steps


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_docs: int = 10_000,
    toxic_words: int = 320,
    other_words: int = 192,
    rounds: int = 5,
) -> Model:
    spark = docs.sparkSession
    sample = labelled_texts(docs, sample_labels(labels, id_col, label_col, max_docs), id_col, text_col)
    n = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    n_yes, n_no = n.get(1, 0), n.get(0, 0)
    if not n_yes or not n_no:
        return Model(Landmarks([]), np.zeros(0), 0.0, np.zeros(FEATURES + 1), (n_yes + 0.5) / (n_yes + n_no + 1))
    parts = 6
    fold = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4))  # a quarter of the rows is for the curve
    fit, curve = sample.where(fold > 0), sample.where(fold == 0)
    marks = Landmarks(choose_landmarks(fit, n_yes, n_no, toxic_words, other_words))
    if not marks.words:
        return Model(marks, np.zeros(0), 0.0, np.zeros(FEATURES + 1), n_yes / (n_yes + n_no))
    m = len(marks.words)
    data = np.frombuffer(b"".join(marks.words), np.uint8)
    end = np.cumsum([len(w) for w in marks.words])
    word, mark, value = marks.kernel(data, np.concatenate([[0], end[:-1]]), end)
    gram = np.zeros((m, m))
    gram[word, mark] = value
    gram = (gram + gram.T) / 2
    root, vectors = np.linalg.eigh(gram)
    good = root > 1e-2
    whiten = (vectors[:, good] / np.sqrt(root[good])).astype(np.float32)
    shared_marks = spark.sparkContext.broadcast(marks)
    fit, curve = (x.select(F.col("id").cast("string"), "text", "label") for x in (fit, curve))
    rows = fit.mapInArrow(_svm_rows(shared_marks), "id string, y int, mark array<int>, value array<float>")
    rows = store(spark, rows, "toxic-sentences").repartition(parts, "id")
    share = rows.agg(F.avg("y")).first()[0] or 0.5
    weight, bias = np.zeros(whiten.shape[1]), -0.5
    for seed in range(rounds):
        state = spark.sparkContext.broadcast((whiten, weight, bias, min(10.0, (1 - share) / max(share, 1e-6))))
        with cleaning(spark):  # each round deals the sentences anew
            got = rows.mapInArrow(_svm_steps(state, seed), "n long, bias double, weight array<double>").where("n > 0").collect()
        total = sum(r.n for r in got)
        weight = sum(np.array(r.weight) * r.n for r in got) / total
        bias = sum(r.bias * r.n for r in got) / total
        state.destroy()
    model = Model(marks, whiten @ weight, float(bias), np.array([1.0] + [0.0] * FEATURES))
    shared = spark.sparkContext.broadcast(model)

    def features(batches):
        for b in slices(_with_altered(batches), "text", 1 << 20):
            x = shared.value.features(b.column("text"), {})
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), b.column("label")], names=[*names, "label"])

    names = [f"f{k}" for k in range(FEATURES)]
    found = curve.mapInArrow(features, ", ".join(f"{k} double" for k in names) + ", label int").collect()  # 2 max_docs rows
    if found:
        found = np.array(found, float)
        if 0 < found[:, -1].sum() < len(found):
            model.curve = fit_curve(found[:, :-1], found[:, -1])
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "toxicity") -> DataFrame:
    """docs with a column ``score_col``, the probability of the class (a
    column of that name is replaced)."""
    from pyspark.sql import types as T

    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f.name for f in docs.schema.fields if f.name != score_col]
    schema = T.StructType([f for f in docs.schema.fields if f.name in names] + [T.StructField(score_col, T.DoubleType())])

    def run(batches):
        m = shared.value
        memory = m.__dict__.setdefault("memory", {})  # later tasks of the worker go on with it
        for b in slices(batches, text_col, 1 << 20):
            p = m.score(m.features(b.column(text_col), memory))
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(p)], names=[*names, score_col])

    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Rows no label is learned from."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def query(spark, sf_dir: str) -> DataFrame:
    """op6: a toxicity score for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = train(docs, labels.where(~held_out()))
    return score(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )

"""Byte-level BPE with rank files: encoding and decoding.

A text is cut by a pattern into pre-tokens; each pre-token's bytes are
merged pair by pair, the pair of least rank first and among equals the
leftmost, until no pair of neighbours is a known token (a pre-token that is
itself a token is that token).

Pairs wait in a queue by rank. Each rank has a bucket of list positions:
the symbols of the pre-token are a linked list, named by their first byte.
A bitmap in three levels of 64-bit words says which buckets hold anything,
so the next rank is found by three find-first-set steps whatever the
length. An entry whose pair has changed since is stale and skipped. A
pre-token of n bytes costs about n log n, so one of millions of bytes is
encoded like any other; its first pairs are ranked and sorted by numpy.

Texts are cut into spans that no pre-token crosses (:mod:`dimspark.llm.spans`),
and a worker process remembers the ids of the spans and pre-tokens it has
met, so that most of a corpus is looked up. Long spans are matched in blocks
that end where a pre-token must end. The pattern must be one that, as
tiktoken's, joins no more than leading spaces to a word.

Defined results: a null or empty text has no ids and decodes to no bytes;
repeated rows are encoded each; an empty table gives an empty table;
further columns are kept (a column named as an output column is replaced).
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.llm.spans import SpanMemory, cut, gather
from dimspark.llm.text import slices, text_bytes

NONE = (1 << 31) - 1  # the rank of a pair that is no token
LONG = 2048  # bytes from which numpy ranks a pre-token's first pairs
MAX_PIECES = 200_000  # remembered pre-tokens, beside the remembered spans
BLOCK = 1 << 20  # characters matched at a time


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class RankQueue:
    """Positions by rank. The least rank comes first, in a rank the least
    position."""

    def __init__(self, n_ranks: int):
        self.low = [0] * (n_ranks // 64 + 1)  # one bit per rank
        self.mid = [0] * (n_ranks // 4096 + 1)  # one bit per word of low
        self.top = 0  # one bit per word of mid
        self.bucket: dict[int, list[int]] = {}
        self.first: dict[int, np.ndarray] = {}  # sorted positions not yet taken into a bucket

    def _mark(self, rank: int) -> None:
        w = rank >> 6
        self.low[w] |= 1 << (rank & 63)
        self.mid[w >> 6] |= 1 << (w & 63)
        self.top |= 1 << (w >> 6)

    def add(self, rank: int, position: int) -> None:
        held = self.bucket.get(rank)
        if held is not None:
            heappush(held, position)
            return
        self.bucket[rank] = [position]
        self._mark(rank)

    def fill(self, ranks: np.ndarray) -> None:
        """All positions at once; ranks of NONE are left out."""
        order = np.argsort(ranks, kind="stable")
        order = order[: np.searchsorted(ranks[order], NONE)]
        found, start = np.unique(ranks[order], return_index=True)
        for r, part in zip(found.tolist(), np.split(order.astype(np.int64), start[1:])):
            self.first[r] = part
            self._mark(r)

    def pop(self) -> tuple[int, int]:
        """(rank, position) of the first entry; (NONE, -1) if there is none."""
        top = self.top
        if not top:
            return NONE, -1
        i = (top & -top).bit_length() - 1
        word = self.mid[i]
        w = i << 6 | (word & -word).bit_length() - 1
        word = self.low[w]
        rank = w << 6 | (word & -word).bit_length() - 1
        if rank in self.first:
            held = self.first.pop(rank).tolist() + self.bucket.get(rank, [])
            heapify(held)
            self.bucket[rank] = held
        held = self.bucket[rank]
        if len(held) > 1:
            return rank, heappop(held)
        del self.bucket[rank]
        word &= word - 1
        self.low[w] = word
        if not word:
            word = self.mid[i] & ~(1 << (w & 63))
            self.mid[i] = word
            if not word:
                self.top = top & (top - 1)
        return rank, held[0]


class ByteBpe:
    """Encoder and decoder for one rank file (lines of base64 token, rank)."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        missing = [i for i in range(256) if bytes([i]) not in self.ranks]
        if missing:
            raise ValueError(f"{path} lacks {len(missing)} single bytes")
        self.queue = RankQueue(max(self.ranks.values()) + 1)  # empty between pre-tokens
        by_rank = sorted(self.ranks.items(), key=lambda x: x[1])
        self.token = np.frombuffer(b"".join(t for t, _ in by_rank), np.uint8)
        size = np.array([len(t) for t, _ in by_rank], np.int64)
        ranks = np.array([r for _, r in by_rank])
        self.token_size = np.full(ranks[-1] + 1, -1, np.int64)  # of a rank; -1: no token has it
        self.token_start = np.zeros(ranks[-1] + 1, np.int64)
        self.token_size[ranks], self.token_start[ranks] = size, np.cumsum(size) - size
        self.find = regex.compile(pattern).findall
        self.cut = regex.compile(r"\S (?=\S)").search  # a block of a text may end before such a space
        self.pieces: dict[str, list[int]] = {}
        self.spans = SpanMemory({"ids": np.uint32}, self._learn)
        self._pairs: np.ndarray | None = None
        self._odd = None

    def _first_ranks(self, piece: bytes) -> np.ndarray:
        if self._pairs is None:
            self._pairs = np.full(1 << 16, NONE, np.int64)
            for t, r in self.ranks.items():
                if len(t) == 2:
                    self._pairs[t[0] << 8 | t[1]] = r
        b = np.frombuffer(piece, np.uint8).astype(np.int64)
        return self._pairs[b[:-1] << 8 | b[1:]]

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        n, queue = len(piece), self.queue
        pop, add = queue.pop, queue.add
        if n >= LONG:
            pair = self._first_ranks(piece)
            queue.fill(pair)
            rank_at = array("q", pair.tobytes())
            rank_at.append(NONE)
            after, before = array("q", range(1, n + 2)), array("q", range(-1, n))
        else:
            rank_at = [rank_of(piece[i : i + 2], NONE) for i in range(n)]
            rank_at[-1] = NONE
            for i, r in enumerate(rank_at):
                if r != NONE:
                    add(r, i)
            # places of the next and the last symbol; n ends the list
            after, before = list(range(1, n + 2)), list(range(-1, n))
        while True:
            r, p = pop()
            if r == NONE:
                break
            if rank_at[p] != r:
                continue  # stale: this pair has changed
            q = after[p]  # joins p
            z = after[q]
            after[p] = z
            before[z] = p
            rank_at[q] = NONE
            new = rank_of(piece[p : after[z]], NONE) if z < n else NONE
            rank_at[p] = new
            if new != NONE:
                add(new, p)
            o = before[p]
            if o >= 0:
                new = rank_of(piece[o:z], NONE)
                if new != rank_at[o]:
                    rank_at[o] = new
                    if new != NONE:
                        add(new, o)
        out, i = [], 0
        while i < n:
            j = after[i]
            out.append(self.ranks[piece[i:j]])
            i = j
        return out

    def _stand_ins(self, text: str) -> str:
        """The text with stand-ins of equal class for characters that the
        two pattern libraries class differently (assigned since)."""
        if self._odd is None:
            self._odd = _differing()
        return text.translate(self._odd)

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text."""
        if text.isascii() or max(text) <= _SETTLED or (alike := self._stand_ins(text)) == text:
            return self.find(text)
        ends = np.cumsum([len(x) for x in self.find(alike)]).tolist()
        return [text[i:j] for i, j in zip([0, *ends], ends)]

    def blocks(self, text: str) -> Iterator[str]:
        """A long text in blocks of about BLOCK characters; no pre-token lies
        across two."""
        at = 0
        while len(text) - at > BLOCK:
            m = self.cut(text, at + BLOCK)
            if m is None:
                break
            yield text[at : m.start() + 1]
            at = m.start() + 1
        yield text[at:] if at else text

    def encode(self, text: str) -> list[int]:
        """The ids of a text."""
        out = []
        for block in self.blocks(text):
            for piece in self.split(block):
                ids = self.pieces.get(piece)
                if ids is None:
                    ids = self.merge(piece.encode())
                    if len(piece) <= 64:
                        if len(self.pieces) >= MAX_PIECES:
                            self.pieces.clear()
                        self.pieces[piece] = ids
                out += ids
        return out

    def _learn(self, spans: list[bytes]) -> dict[str, list]:
        return {"ids": [self.encode(x.decode()) for x in spans]}

    def encode_all(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of a column of texts joined, offsets by text)."""
        data, off = text_bytes(texts)
        start, end, first = cut(data, off)
        ids, ends = self.spans.gather("ids", self.spans.slots(data, start, end))
        return ids, ends[first]

    def decode_all(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes that the ids stand for joined, offsets by id)."""
        if len(ids) and (int(ids.max()) >= len(self.token_size) or int(self.token_size[ids].min()) < 0):
            raise ValueError("an id that no token has")
        return gather(self.token, self.token_start[ids], self.token_size[ids])


_SETTLED = "\u024f"  # up to here every code point has long been assigned


def _differing() -> dict[int, str]:
    """Characters whose class in the tiktoken library is not that of the
    regex module, each with a character that both class as tiktoken does."""
    import regex
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    out: dict[int, str] = {}
    gone: set[str] = set()
    for name, stand_in in ((r"\p{L}", "\xe9"), (r"\p{N}", "7"), (r"\s", "\u2003")):
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks=single, special_tokens={})
        theirs, ours = set(probe.decode(probe.encode_ordinary(every))), set(regex.findall(name, every))
        out |= {ord(c): stand_in for c in theirs - ours}
        gone |= ours - theirs
    return {ord(c): "\ue000" for c in gone} | out  # U+E000 is in none of the classes


_CODERS: dict[tuple[str, str], ByteBpe] = {}


def coder(path: str, pattern: str) -> ByteBpe:
    """This worker process's coder: later tasks go on with its memory."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = ByteBpe(path, pattern)
    return _CODERS[path, pattern]


def _binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Byte strings values[offsets[i]:offsets[i + 1]] of one slice of texts."""
    at = pa.array(offsets.astype(np.int64))
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, at.buffers()[1], pa.py_buffer(values)]
    ).cast(pa.binary())


def _add_columns(df: DataFrame, source: str, fields: list[T.StructField], make: Callable) -> DataFrame:
    """df with columns that ``make`` gives for a slice of ``source``."""
    names = [f.name for f in fields]
    if source in names:
        raise ValueError(f"the column {source} would be replaced")
    kept = [f for f in df.schema.fields if f.name not in names]

    def run(batches):
        for b in slices(batches, source):
            columns = make(b.column(b.schema.get_field_index(source)))
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], names=[*b.schema.names, *names])

    return df.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, T.StructType(kept + fields))


def encode(
    docs: DataFrame, text_col: str = "text", path: str | None = None, pattern: str | None = None, decoded: bool = False
) -> DataFrame:
    """docs with n_tokens and ids (little-endian unsigned 32-bit numbers);
    with ``decoded`` also the bytes that the ids decode to, in the same pass."""
    path, pattern = path or default_path(), pattern or default_pattern()

    def make(texts):
        bpe = coder(path, pattern)
        ids, offsets = bpe.encode_all(texts)
        out = [pa.array(np.diff(offsets)), _binary(ids.astype("<u4").view(np.uint8), 4 * offsets)]
        if decoded:
            data, ends = bpe.decode_all(ids)
            out.append(_binary(data, ends[offsets]))
        return out

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    return _add_columns(docs, text_col, fields + [T.StructField("decoded", T.BinaryType())] * decoded, make)


def decode(coded: DataFrame, path: str | None = None, pattern: str | None = None, ids_col: str = "ids") -> DataFrame:
    """coded with decoded, the bytes that the ids stand for."""
    path, pattern = path or default_path(), pattern or default_pattern()

    def make(column):
        raw, offsets = text_bytes(column)
        data, ends = coder(path, pattern).decode_all(raw.view("<u4"))
        return (_binary(data, ends[offsets // 4]),)

    return _add_columns(coded, ids_col, [T.StructField("decoded", T.BinaryType())], make)


def query(spark, sf_dir: str) -> DataFrame:
    """op13: digests of every document's ids and of the bytes they decode to."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

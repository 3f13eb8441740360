"""Canonical, length-limited Huffman codes over token ids.

Lengths come from package-merge, so no code is longer than ``LIMIT`` bits
and one table of 2 ** LIMIT entries decodes any code in one look. A block
is independent: it starts on a byte, and for every ``STEP`` ids it notes
how many bits they take. From these checkpoints all groups of STEP ids
are decoded side by side, one id of each group per step.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

LIMIT, STEP = 16, 64
MAGIC = b"HUF1"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Code length of each id (0: never occurs), by package-merge."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError("more ids than codes of the limited length")
    if len(used) < 2:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.float64)
    packages, is_package = np.zeros(0), []
    for _ in range(limit):
        both = np.concatenate([leaf, packages])
        at = np.argsort(both, kind="stable")
        is_package.append(at >= len(leaf))
        both = both[at]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * len(leaf) - 2
    length = np.zeros(len(leaf), np.int64)
    for flags in reversed(is_package):
        inside = int(flags[:take].sum())
        length[: take - inside] += 1  # the leaves taken are the rarest ones
        take = 2 * inside
    out[order] = length
    return out


@dataclass
class Code:
    lengths: np.ndarray  # by id
    codes: np.ndarray  # by id
    symbol: np.ndarray  # by the next LIMIT bits
    size: np.ndarray


def canonical(lengths: np.ndarray) -> Code:
    """Codes in order of (length, id): the lengths alone define them."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    width = lengths[order].astype(np.int64)
    share = np.int64(1) << (LIMIT - width)  # table entries of each code
    first = np.cumsum(share) - share
    codes = np.zeros(len(lengths), np.uint64)
    codes[order] = (first >> (LIMIT - width)).astype(np.uint64)
    symbol, size = np.zeros(1 << LIMIT, np.uint32), np.zeros(1 << LIMIT, np.uint8)
    symbol[: share.sum()] = np.repeat(order, share)
    size[: share.sum()] = np.repeat(width, share)
    return Code(lengths.astype(np.uint8), codes, symbol, size)


def encode(ids: np.ndarray, code: Code) -> bytes:
    """One block: header, bits per group of STEP ids, bits."""
    size = code.lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ids) else 0
    start = ends - size
    groups = np.add.reduceat(size, np.arange(0, len(ids), STEP)) if len(ids) else np.zeros(0, np.int64)
    words = np.zeros(total // 64 + 2, np.uint64)
    if len(ids):
        value, word, bit = code.codes[ids], start >> 6, start & 63
        over = bit + size - 64  # bits that go on in the next word
        part = np.where(
            over > 0, value >> np.maximum(over, 0).astype(np.uint64), value << np.maximum(-over, 0).astype(np.uint64)
        )
        heads = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[heads]] = np.bitwise_or.reduceat(part, heads)
        spill = np.flatnonzero(over > 0)
        words[word[spill] + 1] |= value[spill] << (64 - over[spill]).astype(np.uint64)
    bits = words.astype(">u8").tobytes()[: -(-total // 8)]
    return MAGIC + struct.pack("<QI", len(ids), len(groups)) + groups.astype("<u2").tobytes() + bits


def decode(block: bytes, code: Code) -> np.ndarray:
    if block[:4] != MAGIC:
        raise ValueError("not a block")
    n, n_groups = struct.unpack_from("<QI", block, 4)
    groups = np.frombuffer(block, "<u2", n_groups, 16).astype(np.int64)
    raw = np.frombuffer(block, np.uint8, offset=16 + 2 * n_groups)
    b = np.concatenate([raw, np.zeros(4, np.uint8)]).astype(np.uint32)
    three = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    at = np.cumsum(groups) - groups
    out = np.zeros((n_groups, STEP), np.uint32)
    last = n - STEP * (n_groups - 1) if n_groups else 0  # ids of the last group
    for k in range(STEP):
        if k == last:
            at = at[:-1]
        if not len(at):
            break
        look = (three[at >> 3] >> (8 - (at & 7)).astype(np.uint32)) & np.uint32(0xFFFF)
        out[: len(at), k] = code.symbol[look]
        at = at + code.size[look]
    return out.reshape(-1)[:n]

"""Byte-level BPE: merges found by a segment tree over the bytes of a piece.

A leaf stands for the byte where a token begins and holds the rank of that token with the next one;
an inner node holds the least rank below it. The leftmost least pair is found by going down
from the root, and a merge changes three leaves: those of the token before, of the merged token and
of the one that went. Short pieces are worked on together, one row of a matrix each; long pieces one
by one. Both walk the same tree.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import give_back, text_or_empty

#: No pair. Larger than any rank.
NONE = np.int64(2**31 - 1)
#: Pieces up to so many bytes are merged together.
SHORT = 64
#: So many encoded pieces are remembered by a task, so many characters are cut to pieces and bytes are merged at once.
REMEMBERED, CUT, MERGED = 200_000, 500_000, 1 << 18

# Fixed value: the White_Space property, which \s stands for in the pattern of the tokenizer.
WHITE = r"\t-\r \x85\xa0  -     　"


def piece_pattern(pattern: str):
    """The pattern that cuts a text into pieces, with white space as the tokenizer's library has it."""
    inside = pattern.replace(r"[^\s", f"[^{WHITE}")
    return regex.compile(inside.replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]"))


# Fixed value: the pattern of the tokenizer that the plain pieces stand for.
PLAIN_FOR = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Fixed value: Latin letters, the only ones in most texts.
LATIN = "A-Za-zªµºÀ-ÖØ-öø-ɏ"


def plain_pieces():
    """For texts of Latin letters and ASCII: whether a text is one, and its pieces.

    The same alternatives as the pattern of byte_bpe_50k with its character classes spelled out.
    """
    pieces = rf" ?[{LATIN}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\s{LATIN}0-9]+|\s+(?!\S)|\s+"
    return re.compile(rf"[\t-\r -~{LATIN}]*").fullmatch, re.compile(pieces).findall


class Vocabulary:
    """Ranks of tokens, and the rank of every pair of tokens that join to one."""

    def __init__(self, lines: list[bytes]):
        pairs = (line.split() for line in lines if line.strip())
        self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ids.items()}
        self.base = max(self.tokens) + 1
        joined = {}
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    joined[a * self.base + b] = rank
        self.joined = joined
        self.bytes = np.array([self.ids.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
        # the same pairs as arrays, an open hash table
        slots = 1 << (8 * len(joined) + 1).bit_length()
        self.shift = np.uint64(64 - (slots.bit_length() - 1))
        self.keys, self.ranks = np.full(slots + 64, -1, np.int64), np.full(slots + 64, NONE, np.int64)
        keys, ranks = np.array(list(joined), np.int64), np.array(list(joined.values()), np.int64)
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several keys for a slot the last one gets it
            own = self.keys[at] == keys
            self.ranks[at[own]] = ranks[own]
            keys, ranks, at = keys[~own], ranks[~own], at[~own] + 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where a token is missing (-1) or the two don't join."""
        key = a * self.base + b
        at = self._slot(key)
        found = np.take(self.keys, at)
        out = np.where(found == key, np.take(self.ranks, at), NONE)
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            at[open_] += 1
            found = self.keys[at[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        out[(a < 0) | (b < 0)] = NONE
        return out


def merge_long(piece: bytes, words: Vocabulary) -> list[int]:
    """Ids of one piece."""
    n, leaves = len(piece), 1
    while leaves < len(piece):
        leaves *= 2
    joined, base, none = words.joined, words.base, int(NONE)
    ids = words.bytes[np.frombuffer(piece, np.uint8)].tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [none] * (2 * leaves)
    for i in range(n - 1):
        tree[leaves + i] = joined.get(ids[i] * base + ids[i + 1], none)
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, rank: int) -> None:
        node = leaves + i
        tree[node] = rank
        while node > 1:
            node //= 2
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                break
            tree[node] = least

    while (least := tree[1]) != none:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] != least:
                node += 1
        i = node - leaves
        gone = after[i]
        ids[i], ids[gone] = least, -1
        after[i] = right = after[gone]
        put(gone, none)
        if right < n:
            before[right] = i
        put(i, joined.get(least * base + ids[right], none) if right < n else none)
        if (left := before[i]) >= 0:
            put(left, joined.get(ids[left] * base + least, none))
    return [x for x in ids if x >= 0]


def merge_short(pieces: list[bytes], leaves: int, words: Vocabulary) -> list[list[int]]:
    """Ids of each of many pieces of at most ``leaves`` bytes: the same steps, for all rows at once."""
    rows, width, wide = len(pieces), leaves + 1, 2 * leaves
    raw = np.frombuffer(b"".join([p.ljust(leaves, b"\0") for p in pieces]), np.uint8).reshape(rows, leaves)
    n = np.array([len(p) for p in pieces])[:, None]
    ids = np.full((rows, width), -1, np.int64)  # the last column stands for the end of a piece
    ids[:, :leaves] = np.where(np.arange(leaves) < n, words.bytes[raw], -1)
    after = np.minimum(np.arange(1, width + 1), n)
    after[after >= n] = leaves
    before = np.tile(np.arange(-1, leaves), (rows, 1))
    tree = np.full((rows, wide), NONE, np.int64)
    tree[:, leaves:-1] = words.rank(ids[:, : leaves - 1].ravel(), ids[:, 1:leaves].ravel()).reshape(rows, leaves - 1)
    level = leaves
    while level > 1:
        pairs = tree[:, level : 2 * level]
        tree[:, level // 2 : level] = np.minimum(pairs[:, ::2], pairs[:, 1::2])
        level //= 2
    ids, after, before, tree = ids.ravel(), after.ravel(), before.ravel(), tree.ravel()
    depth = leaves.bit_length() - 1

    def put(row: np.ndarray, i: np.ndarray, rank: np.ndarray) -> None:
        root, node = row * wide, i + leaves
        tree[root + node] = rank
        for _ in range(depth):
            node >>= 1
            child = root + 2 * node
            tree[root + node] = np.minimum(np.take(tree, child), np.take(tree, child + 1))

    live = np.flatnonzero(tree[1::wide] != NONE)
    while len(live):
        root, row = live * wide, live * width
        least = np.take(tree, root + 1)
        node = np.ones(len(live), np.int64)
        for _ in range(depth):
            node *= 2
            node += np.take(tree, root + node) != least
        i = node - leaves
        gone = np.take(after, row + i)
        right = np.take(after, row + gone)
        ids[row + i], ids[row + gone], after[row + i], before[row + right] = least, -1, right, i
        put(live, gone, NONE)
        put(live, i, words.rank(least, np.take(ids, row + right)))
        left = np.take(before, row + i)
        has = np.flatnonzero(left >= 0)
        if len(has):
            put(live[has], left[has], words.rank(np.take(ids, row[has] + left[has]), least[has]))
        live = live[np.take(tree, root + 1) != NONE]
    ids = ids.reshape(rows, width)
    used = ids >= 0
    flat, ends = ids[used].tolist(), np.cumsum(used.sum(axis=1)).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Codec:
    """Encodes and decodes texts with the ranks of a file and the pattern of its tokenizer."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.words = Vocabulary(f.read().splitlines())
        plain, plainly = plain_pieces() if pattern == PLAIN_FOR else (lambda text: False, None)
        exactly = piece_pattern(pattern).findall
        self.pieces = lambda text: plainly(text) if plain(text) else exactly(text)
        self.known: dict[str, str] = {}
        self.names = {i: str(i) for i in self.words.tokens}
        self.spelled = {str(i): token for i, token in self.words.tokens.items()}

    def _learn(self, pieces: set[str]) -> None:
        """Remembers the ids of pieces, as text."""
        groups: dict[int, list[str]] = {}
        names = self.names
        for piece in pieces:
            raw = piece.encode()
            whole = self.words.ids.get(raw)
            if whole is not None:
                self.known[piece] = str(whole)
            elif len(raw) > SHORT:
                self.known[piece] = " ".join(map(str, merge_long(raw, self.words)))
            else:
                groups.setdefault(max(2, 1 << (len(raw) - 1).bit_length()), []).append(piece)
        for leaves, group in groups.items():
            step = MERGED // leaves
            for k in range(0, len(group), step):
                part = group[k : k + step]
                for piece, ids in zip(part, merge_short([p.encode() for p in part], leaves, self.words), strict=True):
                    self.known[piece] = " ".join([names[i] for i in ids])

    def encode(self, texts: list[str]) -> Iterator[str]:
        """The ids of each text, in decimal, joined by one space."""
        start = 0
        while start < len(texts):
            cut, size = [], 0
            while start + len(cut) < len(texts) and (not cut or size < CUT):
                size += len(texts[start + len(cut)])
                cut.append(self.pieces(texts[start + len(cut)]))
            start += len(cut)
            new = set().union(*cut)
            if len(self.known) + len(new) > REMEMBERED:
                self.known = {}
            new.difference_update(self.known)
            self._learn(new)
            known = self.known
            for pieces in cut:
                yield " ".join([known[p] for p in pieces])

    def decode(self, ids: str) -> bytes:
        spelled = self.spelled
        return b"".join([spelled[i] for i in ids.split()])


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def coded(
    docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False
) -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, ids_sha256, decoded_sha256; with ``ids`` also token_ids.

    ``ranks`` is a file of ranks that the driver can read; Spark sends it to the executors. A null text
    is empty and an empty text has no tokens. The hashes are of the decimal ids joined by one space, and
    of the bytes that decoding the ids gives back. Texts are taken whole; nothing is shuffled.
    """
    docs.sparkSession.sparkContext.addFile(ranks)
    name = ranks.rsplit("/", 1)[-1]
    columns = ["n_tokens", "ids_sha256", "decoded_sha256", "token_ids"][: 4 if ids else 3]

    def code(batches):
        own = codec(SparkFiles.get(name), pattern)
        for batch in batches:
            rows = []
            for joined in own.encode(batch.tolist()):
                row = (
                    joined.count(" ") + 1 if joined else 0,
                    hashlib.sha256(joined.encode()).hexdigest(),
                    hashlib.sha256(own.decode(joined)).hexdigest(),
                )
                rows.append((*row, [int(i) for i in joined.split()]) if ids else row)
            yield pd.DataFrame(rows, columns=columns)
            batch = rows = None
        own.known = {}
        give_back()

    code.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    kinds = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", token_ids array<int>" if ids else "")
    coded_text = F.pandas_udf(code, kinds)(text_or_empty(text_col))
    return docs.select(F.col(id_col).alias("id"), coded_text.alias("coded")).select("id", "coded.*")

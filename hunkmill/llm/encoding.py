"""Encoding a corpus with a public byte-level BPE vocabulary, by speculation and verification.

Per distinct word of a batch: greedy longest match proposes tokens.  A token sequence is the BPE
encoding exactly if every adjacent pair of it is compatible, i.e. if BPE of the two tokens' bytes gives
the two tokens; all adjacent pairs of all proposals are tested at once with array operations.  Words
with a failing pair undergo exact merging, with a heap, in n log n steps whatever their length.

The vocabulary is read once on the driver and broadcast; it has a fixed size (about 2 MB for 50,000
tokens).  Documents are never shuffled.

Defined results: null and empty texts give an empty list; strings that look like special tokens are
ordinary text; texts are encoded in full; repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from hunkmill import workspace

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary splits text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words remembered between batches of a task.
REMEMBERED = 400_000


def read_ranks(path: str) -> list[bytes]:
    """Token bytes in order of rank, which is also their id."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in pairs)
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    return [token for _, token in ranked]


class Vocabulary:
    """Ranked tokens with the pair each was merged from."""

    def __init__(self, tokens: list[bytes], splits: tuple[np.ndarray, np.ndarray] | None = None):
        self.tokens = tokens
        self.ids = {t: i for i, t in enumerate(tokens)}
        reach: dict[bytes, int] = {}
        for t in tokens:
            reach[t[:2]] = max(reach.get(t[:2], 0), len(t))
        self.reach = reach
        self.left, self.right = splits or self._splits()
        merged = np.flatnonzero(self.left != np.arange(len(tokens)))
        keys = self.left[merged].astype(np.int64) * len(tokens) + self.right[merged]
        order = np.argsort(keys)
        self.pair_keys, self.pair_ids = keys[order], merged[order].astype(np.int64)

    def _splits(self) -> tuple[np.ndarray, np.ndarray]:
        """The two tokens that BPE joins last on the way to each token; itself for single bytes."""
        left = np.arange(len(self.tokens), dtype=np.int32)
        right = left.copy()
        for i, token in enumerate(self.tokens):
            if len(token) > 1:
                parts = self.merge(token, below=i)
                if len(parts) != 2:
                    raise ValueError(f"token {i} can't be built from earlier ones")
                left[i], right[i] = parts
        return left, right

    def merge(self, word: bytes, below: int | None = None) -> list[int]:
        """Exact BPE: always join the adjacent pair of lowest rank, the leftmost of equals."""
        ids, tokens = self.ids, self.tokens
        limit = len(tokens) if below is None else below
        parts: list[int] = [ids[word[k : k + 1]] for k in range(len(word))]
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]

        def joined(k: int) -> int:
            n = after[k]
            m = ids.get(tokens[parts[k]] + tokens[parts[n]], limit) if n >= 0 else limit
            return m if m < limit else -1

        heap = [(m, k) for k in range(len(parts)) if (m := joined(k)) >= 0]
        heapq.heapify(heap)
        while heap:
            m, k = heapq.heappop(heap)
            if parts[k] < 0 or joined(k) != m:
                continue
            gone = after[k]
            parts[k], parts[gone] = m, -1
            after[k] = after[gone]
            if after[gone] >= 0:
                before[after[gone]] = k
            for near in (before[k], k):
                if near >= 0 and (again := joined(near)) >= 0:
                    heapq.heappush(heap, (again, near))
        return [p for p in parts if p >= 0]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        out, at, n, ids, reach = [], 0, len(word), self.ids, self.reach
        while at < n:
            for length in range(min(n - at, reach.get(word[at : at + 2], 1)), 0, -1):
                found = ids.get(word[at : at + length])
                if found is not None:
                    out.append(found)
                    at += length
                    break
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of adjacent tokens whether BPE of their bytes keeps the boundary.

        The pair is taken apart again, the token that was made last first.  If at any moment the two
        pieces at the boundary could have been merged before the piece just taken apart was made, BPE
        would have merged them.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        size, good = len(self.tokens), np.ones(len(a), bool)
        limit = np.full(len(a), np.iinfo(np.int64).max)
        live = np.arange(len(a))
        while len(live):
            x, y, most = a[live], b[live], limit[live]
            key = x * size + y
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            made = np.where(self.pair_keys[at] == key, self.pair_ids[at], size)
            bad = (made < size) & (made < most)
            good[live[bad]] = False
            nx, ny = self.right[x].astype(np.int64), self.left[y].astype(np.int64)
            can_x, can_y = nx != x, ny != y
            take_x = np.where(x > y, can_x, can_x & ~can_y)
            take_y = ~take_x & can_y
            a[live] = np.where(take_x, nx, x)
            b[live] = np.where(take_y, ny, y)
            limit[live] = np.where(take_x, x, y + 1)
            live = live[~bad & (take_x | take_y)]
        return good

    def encode(self, words: list[str]) -> tuple[list[list[int]], int]:
        """Token ids of each word, and how many words needed exact merging."""
        raw = [w.encode() for w in words]
        out = [[i] if (i := self.ids.get(w)) is not None else self.propose(w) for w in raw]
        lengths = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.fromiter(chain.from_iterable(out), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(out)), lengths)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        # the same pair of tokens comes again and again
        pairs, back = np.unique(flat[inside] * len(self.tokens) + flat[inside + 1], return_inverse=True)
        good = self.compatible(pairs // len(self.tokens), pairs % len(self.tokens))[back]
        failed = np.unique(owner[inside[~good]])
        for k in failed:
            out[k] = self.merge(raw[k])
        return out, len(failed)


def _encoded(batches: Iterator[pa.RecordBatch], shared, id_column: str) -> Iterator[pa.RecordBatch]:
    tokens, splits = shared.value
    vocabulary, find = Vocabulary(tokens, splits), regex.compile(PATTERN).findall
    known: dict[str, list[int]] = {}
    for batch in batches:
        words = [find(t) if t else [] for t in batch.column("text").to_pylist()]
        new = list(set(chain.from_iterable(words)).difference(known))
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(set(chain.from_iterable(words)))
        known.update(zip(new, vocabulary.encode(new)[0], strict=True))
        ids = [list(chain.from_iterable(map(known.__getitem__, ws))) for ws in words]
        yield pa.RecordBatch.from_arrays(
            [batch.column(id_column), pa.array(ids, pa.list_(pa.int32()))], names=[id_column, "ids"]
        )


@cache
def _made(path: str) -> tuple[list[bytes], tuple[np.ndarray, np.ndarray]]:
    """The tokens of a vocabulary file and the pairs they were merged from, made once in a driver."""
    tokens = read_ranks(path)
    made = Vocabulary(tokens)
    return tokens, (made.left, made.right)


def encode_texts(documents: DataFrame, vocabulary: str = VOCABULARY, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(ident, ids) of every document."""
    sc = documents.sparkSession.sparkContext
    shared = sc.broadcast(_made(vocabulary))
    kind = documents.schema[ident].dataType.simpleString()
    slim = documents.select(ident, documents[text].alias("text"))
    return slim.mapInArrow(lambda it: _encoded(it, shared, ident), f"`{ident}` {kind}, ids array<int>")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of every document by byte_bpe_50k."""
    return encode_texts(workspace.load(spark, sf_dir, "documents"))

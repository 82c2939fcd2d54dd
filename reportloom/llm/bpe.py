"""Problem 6: the whole corpus as token ids of a public byte-level BPE vocabulary.

Two tiers.  A minimal perfect hash over the vocabulary resolves every pre-token that is
one token as a whole; the rest is merged by rank with a heap over linked bytes.
Null and empty texts have the empty list.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REMEMBERED = 300_000  # distinct pre-tokens a worker keeps
REMEMBERED_LENGTH = 64


class PerfectHash:
    """Minimal perfect hash by displacement: key -> slot in 0..n-1, checked against the key."""

    def __init__(self, keys: list[bytes], values: list[int]):
        n = self.n = len(keys)
        self.r = max(1, n // 2)
        seed = 0
        while not self._place(keys, values, seed):
            seed += 1
        self.seed = seed

    def _place(self, keys: list[bytes], values: list[int], seed: int) -> bool:
        n = self.n
        h = np.fromiter((xxhash.xxh64_intdigest(k, seed) for k in keys), np.uint64, n)
        bucket, base, step = self._parts(h)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(self.r + 1))
        sizes = np.diff(bounds)
        self.shift = np.zeros(self.r, np.int64)
        used = bytearray(n)
        slot_of = np.empty(n, np.int64)
        by_size = np.argsort(-sizes, kind="stable")
        several = by_size[: np.count_nonzero(sizes > 1)]
        bases, steps = base.tolist(), step.tolist()
        for b in several.tolist():
            own = order[bounds[b] : bounds[b + 1]].tolist()
            for d in range(1 << 16):
                slots = {(bases[k] + d * steps[k]) % n for k in own}
                if len(slots) == len(own) and not any(used[s] for s in slots):
                    break
            else:
                return False
            for k in own:
                slot_of[k] = s = (bases[k] + d * steps[k]) % n
                used[s] = 1
            self.shift[b] = d
        taken = np.frombuffer(used, np.uint8)
        # buckets of one key take any free slot, written as a negative number
        single = by_size[len(several) : np.count_nonzero(sizes > 0)]
        free = np.flatnonzero(taken == 0)[: len(single)]
        self.shift[single] = -free - 1
        slot_of[order[bounds[single]]] = free
        self.keys = [b""] * n
        self.values = np.zeros(n, np.int32)
        for k, v, s in zip(keys, values, slot_of.tolist(), strict=True):
            self.keys[s] = k
            self.values[s] = v
        return True

    def _parts(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bucket = ((h >> np.uint64(40)) % np.uint64(self.r)).astype(np.int64)
        base = ((h & np.uint64(0xFFFFF)) % np.uint64(self.n)).astype(np.int64)
        step = (((h >> np.uint64(20)) & np.uint64(0xFFFFF)) % np.uint64(self.n)).astype(np.int64) | 1
        return bucket, base, step

    def lookup(self, keys: list[bytes]) -> list[int]:
        """The value of each key, -1 where it is not in the table."""
        h = np.fromiter((xxhash.xxh64_intdigest(k, self.seed) for k in keys), np.uint64, len(keys))
        bucket, base, step = self._parts(h)
        d = self.shift[bucket]
        slot = np.where(d < 0, -d - 1, (base + d * step) % self.n)
        own, values = self.keys, self.values[slot].tolist()
        return [v if own[s] == k else -1 for k, s, v in zip(keys, slot.tolist(), values, strict=True)]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merges of one pre-token: always the pair of least rank, leftmost first."""
    n = len(piece)
    end = list(range(1, n + 1))  # a live symbol at i spans piece[i:end[i]]; its successor is end[i]
    before = list(range(-1, n - 1))
    live = bytearray(b"\1") * n
    heap = []
    for i in range(n - 1):
        if (r := ranks.get(piece[i : i + 2])) is not None:
            heap.append((r, i, i + 1, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if not live[i] or end[i] != j or j >= n or not live[j] or end[j] != k:
            continue  # one side has changed since
        live[j] = 0
        end[i] = k
        if k < n:
            before[k] = i
            if (r := ranks.get(piece[i : end[k]])) is not None:
                heapq.heappush(heap, (r, i, k, end[k]))
        if (p := before[i]) >= 0 and (r := ranks.get(piece[p:k])) is not None:
            heapq.heappush(heap, (r, p, i, k))
    return [ranks[piece[i : end[i]]] for i in range(n) if live[i]]


class Encoder:
    """Texts to ids; keeps a bounded number of distinct pre-tokens."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.whole = PerfectHash(list(self.ranks), list(self.ranks.values()))
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def _learn(self, pieces: list[str]) -> dict[str, tuple[int, ...]]:
        raw = [p.encode("utf-8") for p in pieces]
        return {
            p: (v,) if v >= 0 else tuple(merge(b, self.ranks))
            for p, b, v in zip(pieces, raw, self.whole.lookup(raw), strict=True)
        }

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets) of a batch."""
        parts = [self.split(t) if t else [] for t in texts]
        distinct = set().union(*parts)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        table = self.known
        new = self._learn(list(distinct.difference(table)))
        if len(new) > REMEMBERED or any(len(p) > REMEMBERED_LENGTH for p in new):
            # not all of these are worth keeping: this batch gets a table of its own
            table = {p: table[p] for p in distinct.intersection(table)} | new
        else:
            table.update(new)
        ids = [list(chain.from_iterable(map(table.__getitem__, p))) for p in parts]
        offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
        return np.fromiter(chain.from_iterable(ids), np.int32, int(offsets[-1])), offsets


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str = VOCABULARY) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def token_ids(df: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids): one row per row of ``df``, without special tokens.

    A null and an empty text both have the empty list; text that spells a special token is
    ordinary text; a null id and repeated rows are kept as they are.  One pass without an
    exchange; ``vocabulary`` must be readable on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            flat, offsets = enc.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"])

    return df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id bigint, ids array<int>")


def token_counts(df: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, n_documents, n_tokens): tokens by any column, combined before the exchange."""
    src = df.select(F.col(key).alias("key_"), F.col(text).alias("text_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            _, offsets = enc.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets).astype(np.int64))], names=["key_", "n"])

    kind = src.schema["key_"].dataType.simpleString()
    counted = src.mapInArrow(run, f"key_ {kind}, n bigint")
    return counted.groupBy(F.col("key_").alias(key)).agg(F.count(F.lit(1)).alias("n_documents"), F.sum("n").alias("n_tokens"))

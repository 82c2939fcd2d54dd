"""Problem 7: passages of held-out items inside a training corpus.

Spaced-seed hashing: fixed masks over the word sequence ignore selected positions, so one
substituted word does not hide a passage.  Seeds of corpus and items are joined by hash;
around every hit the two word sequences are compared directly, tolerating substitutions.
What is compared equal is paired word by word, each word of either side at most once, and
the paired share of the item decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.llm.lookalike import in_parts, unmarked

#: 1: the word counts, 0: any word may stand there.  All have weight 4.
MASKS = ("1111", "110011", "1010101", "11000101", "100110001")
MIN_SHARE = 1 / 3
MIN_WORDS = 10
#: A piece is an aligned stretch; shorter stretches are set phrases, not quotations.
MIN_PIECE = 9
DROP = 4  # an alignment ends where its score falls this far below its best
MISMATCH = 2
#: Characters of items in one index.  Larger item sets are searched in blocks of this size, each by
#: a pass over the corpus; no item is left out.
BLOCK_CHARS = 4_000_000

_MASK_AT = [[k for k, c in enumerate(m) if c == "1"] for m in MASKS]
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CONTROL = "[\x01-\x08\x0b\x0c\x0e-\x1f\x7f]|\\x00"
_NO_WORD = r"[^\p{L}\p{N}]+"
FOUND_SCHEMA = "doc_id bigint, item_id bigint, words int, item_words int, share double, pieces int"
_FOUND_TYPES = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32())


def tokenized(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(lower-case words of all texts, offset of each text): one consistent form, letters and digits
    only.  Plain texts take no step in Python; a null text has no word."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = pc.fill_null(texts, "")
    odd = np.flatnonzero(pc.or_(pc.invert(pc.string_is_ascii(texts)), pc.match_substring_regex(texts, _CONTROL)).to_numpy(zero_copy_only=False))
    if len(odd):
        on = np.zeros(len(texts), bool)
        on[odd] = True
        texts = pc.replace_with_mask(texts, pa.array(on), pa.array(in_parts(texts.take(pa.array(odd)).to_pylist(), unmarked), texts.type))
    parts = pc.split_pattern_regex(pc.utf8_lower(texts), _NO_WORD)
    flat = parts.flatten()
    some = pc.not_equal(flat, "")
    ends = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    return flat.filter(some).dictionary_encode(), ends[parts.offsets.to_numpy()]


def _keys(v: np.ndarray, at: list[int], starts: np.ndarray, which: int) -> np.ndarray:
    """The seed hash of one mask at the given positions of a word sequence."""
    out = np.full(len(starts), which + 1, np.uint64) * _MIX
    for a in at:
        out = (out ^ v[starts + a]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _starts(v: np.ndarray, offsets: np.ndarray, at: list[int]) -> np.ndarray:
    """Where a mask fits: all its words are known and of the same text."""
    n = len(v) - at[-1]
    if n <= 0:
        return np.empty(0, np.int64)
    on = v[:n] > 0
    for a in at[1:]:
        on &= v[a : a + n] > 0
    starts = np.flatnonzero(on)
    text = np.searchsorted(offsets, starts, "right")
    return starts[starts + at[-1] < offsets[np.minimum(text, len(offsets) - 1)]]


class ItemIndex:
    """Seeds of a block of items.  Words are numbered by the items' own vocabulary, from 1; words that
    no item has are 0 and match nothing."""

    def __init__(self, ids: list[int], texts: list[str]):
        words, offsets = tokenized(pa.array(texts, pa.string()))
        self.ids, self.offsets = ids, offsets.astype(np.int64)
        self.number = {w: k + 1 for k, w in enumerate(words.dictionary.to_pylist())}
        v = (words.indices.to_numpy() + 1).astype(np.uint64)
        self.words = [v[a:b].astype(np.int64).tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        key, at_word = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for m, at in enumerate(_MASK_AT):
            s = _starts(v, self.offsets, at)
            key.append(_keys(v, at, s, m))
            at_word.append(s)
        key, at_word = np.concatenate(key), np.concatenate(at_word)
        owner = np.searchsorted(self.offsets, at_word, "right") - 1
        order = np.lexsort((at_word, owner, key))
        key, owner = key[order], owner[order]
        place = at_word[order] - self.offsets[owner]
        # groups: the places of one seed in one item
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        begin = np.flatnonzero(first)
        self.pos = [p.tolist() for p in np.split(place, begin[1:])] if len(key) else []
        self.group_owner, group_key = owner[begin], key[begin]
        self.seed, self.seed_begin = np.unique(group_key, return_index=True)
        self.seed_begin = np.append(self.seed_begin, len(group_key))

    def numbered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of all texts, offsets)."""
        words, offsets = tokenized(texts)
        number = np.fromiter((self.number.get(w, 0) for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
        return number[words.indices.to_numpy()] if len(words) else np.empty(0, np.uint64), offsets.astype(np.int64)

    def hits(self, v: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(corpus position, group) of all equal seeds."""
        at_corpus, slot = [], []
        for m, at in enumerate(_MASK_AT):
            s = _starts(v, offsets, at)
            if not len(s) or not len(self.seed):
                continue
            k = _keys(v, at, s, m)
            i = np.minimum(np.searchsorted(self.seed, k), len(self.seed) - 1)
            same = self.seed[i] == k
            at_corpus.append(s[same])
            slot.append(i[same])
        if not at_corpus:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at_corpus, slot = np.concatenate(at_corpus), np.concatenate(slot)
        n = self.seed_begin[slot + 1] - self.seed_begin[slot]
        group = np.repeat(self.seed_begin[slot], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at_corpus, n), group


def _reach(doc: list[int], item: list[int], d: int, start: int, step: int) -> int:
    """How far from ``start`` the best-scoring stretch goes in one direction, substitutions allowed."""
    score = best = 0
    end, i = start, start
    while 0 <= i < len(item) and 0 <= i + d < len(doc):
        score += 1 if item[i] == doc[i + d] else -MISMATCH
        if score > best:
            best, end = score, i
        elif score <= best - DROP:
            break
        i += step
    return end


class Alignment:
    """The pieces between one document and one item, and the greatest number of their words that can be
    paired, each at most once.

    Pieces are taken in the order of the document and pair whatever words of theirs are free.  If
    that leaves words of pieces unpaired on both sides, pairs are exchanged along augmenting
    paths until no more can be had, so a text that repeats itself neither counts a quotation
    twice nor misses a copy.  The work goes with the hits between the two texts; it ends as soon
    as one of them is paired to its last word.
    """

    def __init__(self, doc: list[int], item: list[int]):
        self.doc, self.item = doc, item
        self.of_item: dict[int, int] = {}  # item word -> document word
        self.of_doc: dict[int, int] = {}
        self.looked: dict[int, int] = {}  # diagonal -> last item word compared
        self.pieces: list[tuple[int, int, int]] = []  # diagonal, first and last item word
        self.used = 0

    def _look(self, d: int, i: int) -> None:
        """Compares around a hit on a diagonal."""
        a, b = _reach(self.doc, self.item, d, i, -1), _reach(self.doc, self.item, d, i, 1)
        self.looked[d] = b
        if b - a + 1 < MIN_PIECE:
            return
        self.pieces.append((d, a, b))
        new = [i for i in range(a, b + 1) if i not in self.of_item and i + d not in self.of_doc]
        for i in new:
            self.of_item[i], self.of_doc[i + d] = i + d, i
        self.used += bool(new)

    def add(self, hits: list[tuple[int, list[int]]]) -> None:
        """``hits``: (document position, item positions of the same seed), by document position, so each
        diagonal is gone along once from its beginning."""
        looked = self.looked
        for j, at in hits:
            for i in at:
                if i > looked.get(j - i, -1):
                    self._look(j - i, i)
                    if len(self.of_item) == len(self.item) or len(self.of_doc) == len(self.doc):
                        return  # no more can be had
        if self.pieces:
            self._exchange()

    def _exchange(self) -> None:
        items, docs = (set().union(*(range(a + s * d, b + s * d + 1) for d, a, b in self.pieces)) for s in (0, 1))
        if len(self.of_item) == min(len(items), len(docs)):
            return
        near: dict[int, set[int]] = {}
        for d, a, b in self.pieces:
            for i in range(a, b + 1):
                near.setdefault(i, set()).add(i + d)
        for root in sorted(items - self.of_item.keys()):
            came: dict[int, int] = {}  # document word -> item word it was reached from
            queue, free = [root], None
            for i in queue:
                for j in near[i]:
                    if j not in came:
                        came[j] = i
                        if j not in self.of_doc:
                            free = j
                            break
                        queue.append(self.of_doc[j])
                if free is not None:
                    break
            while free is not None:
                i = came[free]
                self.of_doc[free] = i
                self.of_item[i], free = free, self.of_item.get(i)


def leaked(index: ItemIndex, v: np.ndarray, offsets: np.ndarray, min_share: float, min_words: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(text number, item number, paired words, item words, pieces) of a batch of numbered texts."""
    at, group = index.hits(v, offsets)
    if not len(at):
        return
    text, owner = np.searchsorted(offsets, at, "right") - 1, index.group_owner[group]
    order = np.lexsort((at, owner, text))
    at, group, text, owner = at[order], group[order], text[order], owner[order]
    bounds = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (owner[1:] != owner[:-1]), [True]]))
    last, doc = -1, []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        t, k = int(text[lo]), int(owner[lo])
        if t != last:
            last, doc = t, v[offsets[t] : offsets[t + 1]].astype(np.int64).tolist()
        both = Alignment(doc, index.words[k])
        both.add([(j, index.pos[g]) for j, g in zip((at[lo:hi] - offsets[t]).tolist(), group[lo:hi].tolist(), strict=True)])
        n, of = len(both.of_item), len(index.words[k])
        if n >= min_words and n >= min_share * of:
            yield t, k, n, of, both.used


_INDEXES: dict[int, ItemIndex] = {}


def _index(items: list[tuple[int, str]]) -> ItemIndex:
    """One index per worker process and block of items."""
    key = xxhash.xxh64_intdigest("\0".join(f"{i}\1{t}" for i, t in items))
    if key not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[key] = ItemIndex([i for i, _ in items], [t for _, t in items])
    return _INDEXES[key]


def _verify(bound, min_share: float, min_words: int):
    """mapInArrow function: seeds of a batch are searched at once, hits then by document and item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(bound.value)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [(ids[t], index.ids[k], n, of, n / of, pieces) for t, k, n, of, pieces in leaked(index, *index.numbered(batch.column(1)), min_share, min_words)]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(_FOUND_TYPES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _FOUND_TYPES, strict=True)], names=["doc_id", "item_id", "words", "item_words", "share", "pieces"])

    return run


def _blocks(items: DataFrame, chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``chars`` characters, one block in memory at a time."""
    block, size = [], 0
    for r in items.toLocalIterator():
        block.append((r.item_id, r.item_text))
        size += len(r.item_text)
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def leaked_items(docs: DataFrame, items: DataFrame, min_share: float = MIN_SHARE, min_words: int = MIN_WORDS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, words, item_words, share, pieces) of every document holding at least
    ``min_share`` of an item's words, and at least ``min_words`` of them, in aligned pieces.

    ``words`` counts pairs of one item word and one document word, so a phrase that an item
    repeats and a document has once counts once.  The items are the query set: each block of at
    most ``block_chars`` characters (and one item) is broadcast as an index and the corpus is
    read once for it, without an exchange of texts.
    Null and empty texts match nothing; a null id is left out; repeated ids with the same
    text give one row.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).where("doc_id is not null and text is not null")
    e = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string").alias("item_text")).where("item_id is not null and item_text is not null")
    found = [d.mapInArrow(_verify(spark.sparkContext.broadcast(b), min_share, min_words), FOUND_SCHEMA) for b in _blocks(e, block_chars)]
    if not found:
        return spark.createDataFrame([], FOUND_SCHEMA)
    return reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(*(F.max(c).alias(c) for c in ("words", "item_words", "share", "pieces")))

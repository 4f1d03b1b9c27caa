"""Byte-level BPE of whole texts by a pair occurrence index.

The words (pattern matches) of a batch that weren't met before are laid out as one array of symbols. An index maps each pair
of neighbours that has a merge to all its positions; merges are applied in ascending rank, each at all its positions at once,
and the lists of the pairs that appear beside them are extended. A merge makes only pairs of higher rank, so every rank is
dealt with once. Texts are then looked up word by word.

Defined cases: null and empty texts give an empty list; strings that look like special tokens are ordinary text; texts of any
length are encoded whole.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame, SparkSession

#: The vocabulary file where the session's setting VOCABULARY_SETTING names none.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
VOCABULARY_SETTING = "spark.trajecta.vocabulary"
#: Fixed value: the public pattern that splits texts before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words a worker remembers; beyond, it starts anew. Results don't depend on it.
REMEMBERED = 400_000
SHIFT = 20


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file: itself where printable, else the next one from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def read_vocabulary(path: str = VOCABULARY) -> tuple[list[int], dict[int, tuple[int, int]]]:
    """Ids of the 256 bytes; of each pair of ids (left << SHIFT | right) its rank and the id it becomes."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    ids = [0] * 256
    for letter, b in byte_letters().items():
        ids[b] = vocab[letter]
    merges = {}
    for rank, m in enumerate(model["merges"]):
        left, right = m.split(" ") if isinstance(m, str) else m
        merges.setdefault(vocab[left] << SHIFT | vocab[right], (rank, vocab[left + right]))
    return ids, merges


def encode_words(words: list[str], byte_ids: list[int], merges: dict[int, tuple[int, int]]) -> list[list[int]]:
    """Token ids of each word."""
    sym: list[int] = []
    starts = []
    for w in words:
        starts.append(len(sym))
        sym.extend([byte_ids[b] for b in w.encode("utf-8")])
    n = len(sym)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    for s in starts:
        before[s] = -1
        if s:
            after[s - 1] = -1
    if n:
        after[n - 1] = -1
    index: dict[int, list[int]] = {}
    for i in range(n - 1):
        if after[i] != -1:
            pair = sym[i] << SHIFT | sym[i + 1]
            if pair in merges:
                index.setdefault(pair, []).append(i)
    heap = [(merges[p][0], p) for p in index]
    heapq.heapify(heap)
    mask = (1 << SHIFT) - 1
    while heap:
        _, pair = heapq.heappop(heap)
        left, right, becomes = pair >> SHIFT, pair & mask, merges[pair][1]
        places = index.pop(pair)
        if left == right:
            places.sort()  # of overlapping ones the first wins
        for i in places:
            if sym[i] != left:
                continue
            j = after[i]
            if j == -1 or sym[j] != right:
                continue
            k, h = after[j], before[i]
            sym[i], sym[j], after[i] = becomes, -1, k
            if k != -1:
                before[k] = i
                new = becomes << SHIFT | sym[k]
                if new in merges:
                    if new in index:
                        index[new].append(i)
                    else:
                        index[new] = [i]
                        heapq.heappush(heap, (merges[new][0], new))
            if h != -1:
                new = sym[h] << SHIFT | becomes
                if new in merges:
                    if new in index:
                        index[new].append(h)
                    else:
                        index[new] = [h]
                        heapq.heappush(heap, (merges[new][0], new))
    ends = [*starts[1:], n]
    return [[x for x in sym[a:b] if x != -1] for a, b in zip(starts, ends)]


class Encoder:
    """Encodes batches of texts, remembering words."""

    def __init__(self, byte_ids: list[int], merges: dict[int, tuple[int, int]]):
        import regex

        self.byte_ids, self.merges, self.known = byte_ids, merges, {}
        self.split = regex.compile(PATTERN).findall

    def encode(self, texts: list[str | None]) -> Iterator[list[int]]:
        """Ids of each text in turn; the words of a text are looked at together."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        words = [self.split(t) if t else [] for t in texts]
        new = {w for ws in words for w in ws if w not in self.known}
        if new:
            new = list(new)
            self.known.update(zip(new, encode_words(new, self.byte_ids, self.merges)))
        get = self.known.__getitem__
        for ws in words:
            yield list(chain.from_iterable(map(get, ws)))

    def counts(self, texts: list[str | None]) -> list[int]:
        return [len(x) for x in self.encode(texts)]


#: Characters of text that are encoded together, so that a batch of very long texts stays small.
TOGETHER = 2_000_000


def portions(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Bounds of stretches of texts of about TOGETHER characters."""
    start, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= TOGETHER:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def shared_vocabulary(spark: SparkSession, path: str | None = None):
    """The vocabulary of the file (read by the driver alone) as a broadcast variable: some 50,000 entries, whatever the data."""
    return spark.sparkContext.broadcast(read_vocabulary(path or spark.conf.get(VOCABULARY_SETTING, VOCABULARY)))


def token_ids(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array<int>) of each row."""
    vocabulary = shared_vocabulary(documents.sparkSession, path)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encoder = Encoder(*vocabulary.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in portions(texts):
                ids = [np.array(x, "i4") for x in encoder.encode(texts[a:b])]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype("i4")
                flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, "i4"))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets), flat)], names=["doc_id", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")

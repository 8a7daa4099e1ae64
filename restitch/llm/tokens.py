"""Problem 8: the corpus as token ids of a public byte-level BPE vocabulary.

Two passes over the texts.  The first counts words (the pieces of the tokenizer's
splitting pattern): each task counts locally and emits its distinct words, a groupBy
adds them up.  The most frequent words, at most LEXICON_WORDS of them, are encoded once
on the driver and compiled into a minimal acyclic transducer (lexicon.py), which the
workers map from the cluster's shared folder.  The second pass looks words up in it, in
batches, and merges the others exactly by rank, so the result does not depend on the
size of the lexicon.

Defined results: null and empty texts give an empty list of ids; the strings of special
tokens are ordinary text; a lone surrogate cannot occur in a Spark string.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restitch.llm.lexicon import Lexicon, compile_words, publish, to_bytes
from restitch.session import shared_dir, spread

TOKENIZER_DIR = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k"
#: Bound of the lexicon that is built on the driver and mapped by the workers (about 3 MB).
LEXICON_WORDS = 65_536
#: Distinct words a counting task holds before it emits them.
FLUSH_WORDS = 200_000
#: Words a worker remembers.
CACHE_WORDS = 300_000
# The public splitting pattern of the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def load_ranks(directory: str = TOKENIZER_DIR, vocabulary: str = VOCABULARY) -> dict[bytes, int]:
    with open(f"{directory}/{vocabulary}.tiktoken", "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def merge_by_rank(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Exact byte-pair merging: always the adjacent pair of lowest rank, leftmost first."""
    if word in ranks:
        return [ranks[word]]
    parts = [word[i : i + 1] for i in range(len(word))]
    if len(parts) > 64:
        return _merge_long(parts, ranks)
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def _merge_long(parts: list[bytes], ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap over a linked list, so that very long words stay n log n."""
    import heapq

    n = len(parts)
    piece: list[bytes | None] = list(parts)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, bytes, bytes]] = []

    def offer(i: int) -> None:
        j = nxt[i]
        if i >= 0 and j < n:
            r = ranks.get(piece[i] + piece[j])
            if r is not None:
                heapq.heappush(heap, (r, i, piece[i], piece[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = nxt[i] if piece[i] is not None else n
        if piece[i] != a or j >= n or piece[j] != b:
            continue
        piece[i], piece[j] = a + b, None
        nxt[i] = nxt[j]
        if nxt[j] < n:
            prv[nxt[j]] = i
        offer(i)
        if prv[i] >= 0:
            offer(prv[i])
    return [ranks[p] for p in piece if p is not None]


class Encoder:
    """Per-worker encoder: remembered words, then the lexicon, then exact merging."""

    def __init__(self, lexicon: Lexicon | None, directory: str, vocabulary: str) -> None:
        import regex

        self.split = regex.compile(PATTERN).findall
        self.ranks = load_ranks(directory, vocabulary)
        self.lexicon = lexicon
        self.cache: dict[str, list[int]] = {}

    def learn(self, words: set[str]) -> None:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        new = [w for w in words if w not in self.cache]
        raw = [w.encode() for w in new]
        at = self.lexicon.positions(raw) if self.lexicon is not None else [-1] * len(new)
        for w, b, p in zip(new, raw, at, strict=True):
            self.cache[w] = self.lexicon.ids_at(p) if p >= 0 else merge_by_rank(b, self.ranks)

    def encode_all(self, texts: list[str | None]) -> list[list[int]]:
        pieces = [self.split(t) if t else [] for t in texts]
        words: set[str] = set()
        for p in pieces:
            words.update(p)
        self.learn(words)
        cache = self.cache
        return [[i for w in p for i in cache[w]] for p in pieces]


_encoders: dict[tuple, Encoder] = {}


def _encoder(source: str | bytes, directory: str, vocabulary: str) -> Encoder:
    key = (source if isinstance(source, str) else hash(source), directory, vocabulary)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Lexicon(source), directory, vocabulary)
    return _encoders[key]


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over the whole column ``text``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import regex

        split = regex.compile(PATTERN).findall
        c: Counter[str] = Counter()
        for pdf in batches:
            for t in pdf["text"]:
                if t:
                    c.update(split(t))
            if len(c) > FLUSH_WORDS:
                yield pd.DataFrame({"word": list(c), "n": list(c.values())})
                c.clear()
        if c:
            yield pd.DataFrame({"word": list(c), "n": list(c.values())})

    return texts.select("text").mapInPandas(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(texts: DataFrame, directory: str, vocabulary: str, size: int) -> bytes:
    top = word_counts(texts).orderBy(F.desc("n"), "word").limit(size).select("word").collect()
    ranks = load_ranks(directory, vocabulary)
    words = [r["word"].encode() for r in top]
    return to_bytes(compile_words({w: merge_by_rank(w, ranks) for w in words}))


def encode(
    documents: DataFrame,
    key: str = "doc_id",
    directory: str = TOKENIZER_DIR,
    vocabulary: str = VOCABULARY,
    lexicon_words: int = LEXICON_WORDS,
    counts_only: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(key, *keep, ids), or n_tokens in place of ids with ``counts_only``, one row per row of ``documents``."""
    spark = documents.sparkSession
    rows = spread(documents.select(key, *keep, "text"), key)
    data = build_lexicon(rows, directory, vocabulary, lexicon_words)
    path = publish(data, shared_dir(spark))
    held = None if path else spark.sparkContext.broadcast(data)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoder(path or held.value, directory, vocabulary)
        for pdf in batches:
            ids = enc.encode_all([None if t is None or t != t else t for t in pdf["text"]])
            out = pdf.drop(columns="text")
            if counts_only:
                yield out.assign(n_tokens=[len(x) for x in ids])
            else:
                yield out.assign(ids=ids)

    kinds = ", ".join(f"{c} {documents.schema[c].dataType.simpleString()}" for c in (key, *keep))
    return rows.mapInPandas(run, f"{kinds}, " + ("n_tokens bigint" if counts_only else "ids array<int>"))

"""Byte-level BPE encoding of a corpus by a public tokenizer's own merges.

The merge loop is a rank queue: a bucket for each merge rank holds positions in a linked list of symbols, and a three-level bitmap over
the ranks gives the lowest occupied one by find-first-set, in constant time. A merge only pushes the two pairs that it makes; entries
that a merge has made stale are skipped when they come up. The work is linear in the length of a pre-token, so that very long ones (rules,
numbers, words without spaces) cost no more a byte than short ones.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoneda.plans.runtime import ship_file, shipped

#: Where the vocabulary files of public tokenizers lie, unless a caller says otherwise.
TOKENIZERS = "/opt/tokenizers"

#: Fixed value: the pattern by which byte-level BPE cuts text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pre-tokens up to so many bytes are remembered by a worker, up to so many of them. It changes no result.
KEPT_BYTES, KEPT = 64, 400_000


def byte_letters() -> dict[int, str]:
    """The letter that stands for a byte in byte-level vocabularies: printable ones for themselves, the others from U+0100 on."""
    out, spare = {}, 0x100
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


class RankQueue:
    """Positions by rank; ranks come out lowest first, a rank's positions leftmost first."""

    def __init__(self, ranks: int) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0

    def push(self, rank: int, at: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(at)
            return
        self.buckets[rank] = [at]
        i = rank >> 6
        if not self.low[i]:
            j = i >> 6
            if not self.mid[j]:
                self.top |= 1 << j
            self.mid[j] |= 1 << (i & 63)
        self.low[i] |= 1 << (rank & 63)

    def pop(self) -> tuple[int, list[int]] | None:
        top = self.top
        if not top:
            return None
        j = (top & -top).bit_length() - 1
        mid = self.mid[j]
        i = (j << 6) | ((mid & -mid).bit_length() - 1)
        low = self.low[i]
        bit = low & -low
        rank = (i << 6) | (bit.bit_length() - 1)
        low ^= bit
        self.low[i] = low
        if not low:
            mid &= mid - 1
            self.mid[j] = mid
            if not mid:
                self.top = top & (top - 1)
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


class ByteBpe:
    """Encoder from a tokenizer's JSON file. Special tokens' strings in a text are ordinary text."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        letters = byte_letters()
        self.byte_id = [vocab[letters[b]] for b in range(256)]
        self.vocab = vocab
        pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for r, (a, b) in enumerate(pairs):
            self.rank.setdefault(vocab[a] << 20 | vocab[b], r)
            self.made.append(vocab[a + b])
        self.queue = RankQueue(len(pairs))
        self.cut = regex.compile(PATTERN)
        self.seen: dict[str, tuple[int, ...]] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        ids = [self.byte_id[b] for b in data]
        n = len(ids)
        if n < 2:
            return ids
        rank, made, queue = self.rank, self.made, self.queue
        push = queue.push
        for i in range(n - 1):
            r = rank.get(ids[i] << 20 | ids[i + 1])
            if r is not None:
                push(r, i)
        after = list(range(1, n + 1))
        before = list(range(-1, n))
        while (item := queue.pop()) is not None:
            r, bucket = item
            new = made[r]
            for at in bucket:
                mine = ids[at]
                nxt = after[at]
                if mine < 0 or nxt >= n or rank.get(mine << 20 | ids[nxt]) != r:
                    continue  # stale: a merge has taken one of the two since
                ids[at] = new
                ids[nxt] = -1
                far = after[nxt]
                after[at] = far
                before[far] = at
                if far < n and (k := rank.get(new << 20 | ids[far])) is not None:
                    push(k, at)
                prev = before[at]
                if prev >= 0 and (k := rank.get(ids[prev] << 20 | new)) is not None:
                    push(k, prev)
        return [x for x in ids if x >= 0]

    def pretoken(self, word: str) -> tuple[int, ...]:
        out = tuple(self.merge(word.encode("utf-8", "replace")))
        if len(word) <= KEPT_BYTES:
            if len(self.seen) >= KEPT:
                self.seen.clear()
            self.seen[word] = out
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; the empty list for an empty or null one."""
        out: list[int] = []
        if text:
            seen = self.seen
            for word in self.cut.findall(text):
                got = seen.get(word)
                out += self.pretoken(word) if got is None else got
        return out


@lru_cache(4)
def encoder(path: str) -> ByteBpe:
    """One a worker process."""
    return ByteBpe(path)


def encode_corpus(docs: DataFrame, key: str, text: str, path: str = f"{TOKENIZERS}/byte_bpe_50k.json", also: dict[str, Column] | None = None) -> DataFrame:
    """(doc, ids) and the columns of ``also``: every row's token ids.

    Null and empty texts give the empty list; repeated rows are encoded each; an empty table gives no rows. No shuffle: the rows are
    encoded where they are read, in Arrow batches, and a worker remembers the pre-tokens it has met. The vocabulary is a file of the driver's
    machine; executors get it through the shared folder.
    """
    also = also or {}
    name = ship_file(docs.sparkSession, path)
    read = docs.select(F.col(key).alias("doc"), *[e.alias(n) for n, e in also.items()], F.col(text).cast("string").alias("__text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shipped(name)).encode
        for b in batches:
            texts = b.column(b.schema.get_field_index("__text"))
            for at in range(0, len(texts), 1000):  # smaller batches out than in: a token is four bytes
                part = b.slice(at, 1000)
                flat: list[int] = []
                ends = [0]
                for t in texts.slice(at, 1000).to_pylist():
                    flat += encode(t)
                    ends.append(len(flat))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids], [*part.schema.names[:-1], "ids"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-1])
    return read.mapInArrow(run, f"{kept}, ids array<int>")

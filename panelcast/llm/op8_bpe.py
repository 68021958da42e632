"""Byte-level BPE encoding and decoding by two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves a pre-token that is
itself an entry. Tier two: a miss is merged from its bytes, lowest rank first and
leftmost among equals, with a heap over a linked list of the parts.

Defined results: a null or empty text has no tokens and decodes to empty bytes;
special tokens do not exist, their strings are ordinary text; repeated rows are
encoded each; an empty table gives no rows. Rows are independent: no shuffle, one
Arrow pass, and only the vocabulary (a file of fixed size) is broadcast.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import islice
from struct import pack

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import text_frame

#: Resolved pre-tokens that a worker keeps in its younger memo; a full one becomes the older and replaces that.
MEMO = 400_000
#: Characters of a text that is split at once; pre-tokens of a longer one that are handled at a time.
BLOCK = 1 << 17


class PerfectHash:
    """Minimal perfect hash of n distinct keys onto 0..n-1: buckets of keys, one displacement seed per bucket.

    A bucket of one key has the negated number of its slot (less one) instead of a seed.
    """

    def __init__(self, keys: list[bytes], load: int = 4):
        self.size = n = len(keys)
        self.seeds = np.zeros(max(1, -(-n // load)), np.int32)
        buckets: list[list[bytes]] = [[] for _ in self.seeds]
        for k in keys:
            buckets[xxhash.xxh3_64_intdigest(k) % len(self.seeds)].append(k)
        free = bytearray(b"\x01") * n
        order = sorted(range(len(buckets)), key=lambda b: -len(buckets[b]))
        several = sum(len(b) > 1 for b in buckets)
        for b in order[:several]:
            seed = 1
            while True:
                at = [xxhash.xxh3_64_intdigest(k, seed) % n for k in buckets[b]]
                if all(free[x] for x in at) and len(set(at)) == len(at):
                    break
                seed += 1
            for x in at:
                free[x] = 0
            self.seeds[b] = seed
        ones = [b for b in order[several:] if buckets[b]]
        for b, x in zip(ones, (x for x in range(n) if free[x])):
            self.seeds[b] = -x - 1
        self.seeds = self.seeds.tolist()

    def __call__(self, key: bytes) -> int:
        seed = self.seeds[xxhash.xxh3_64_intdigest(key) % len(self.seeds)]
        return xxhash.xxh3_64_intdigest(key, seed) % self.size if seed >= 0 else -seed - 1


def read_vocabulary(path: str) -> list[bytes]:
    """Token bytes by id, from a file of ``base64 id`` lines whose ids are 0..n-1."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


class Codec:
    """Encoder and decoder of one vocabulary; what ``tables`` holds is all that is broadcast."""

    def __init__(self, vocabulary: list[bytes], pattern: str, seeds: PerfectHash | None = None):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.hash = seeds or PerfectHash(vocabulary)
        self.slots: list[int] = [0] * len(vocabulary)
        self.ranks = {t: i for i, t in enumerate(vocabulary)}
        for i, t in enumerate(vocabulary):
            self.slots[self.hash(t)] = i
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __getstate__(self):
        return self.vocabulary, self.pattern.pattern, self.hash

    def __setstate__(self, state):
        self.__init__(*state)

    def whole(self, piece: bytes) -> int:
        """Id of a pre-token that is an entry, -1 for a miss."""
        i = self.slots[self.hash(piece)]
        return i if self.vocabulary[i] == piece else -1

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a miss: merges popped from a heap over the linked parts."""
        n, rank = len(piece), self.ranks.get
        end = list(range(1, n + 1))  # of the part that starts here; 0 once the part is gone
        before = list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, a, stop = heappop(heap)
            b = end[a]
            if not b or b >= n or end[b] != stop:
                continue  # a part of this pair has been merged since
            end[a], end[b] = stop, 0
            if stop < n:
                before[stop] = a
                if (r := rank(piece[a : end[stop]])) is not None:
                    heappush(heap, (r, a, end[stop]))
            p = before[a]
            if p >= 0 and (r := rank(piece[p:stop])) is not None:
                heappush(heap, (r, p, stop))
        out, a, ids = [], 0, self.ranks
        while a < n:
            out.append(ids[piece[a : end[a]]])
            a = end[a]
        return out

    def resolve(self, token: str) -> bytes:
        if (packed := self.older.get(token)) is not None:
            self.memo[token] = packed
            return packed
        piece = token.encode("utf-8")
        i = self.whole(piece)
        ids = [i] if i >= 0 else self.merged(piece)
        packed = pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self.memo) >= MEMO:
                self.older, self.memo = self.memo, {}
            self.memo[token] = packed
        return packed

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids as little-endian unsigned 32-bit integers, in blocks."""
        resolve = self.resolve
        for tokens in self.pre_tokens(text):
            memo = self.memo.get
            yield b"".join([memo(t) or resolve(t) for t in tokens])

    def pre_tokens(self, text: str) -> Iterator[list[str]]:
        if len(text) <= BLOCK:
            yield self.pattern.findall(text)
            return
        found = self.pattern.finditer(text)
        while block := [m[0] for m in islice(found, BLOCK)]:
            yield block

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(vocab_path: str | None = None, pattern: str | None = None) -> Codec:
    import public_tokenizers as P

    return Codec(read_vocabulary(vocab_path or P.path("byte_bpe_50k.tiktoken")), pattern or P.PATTERN)


def encode(df: DataFrame, codec_: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids``: the token ids of the text as an array of integers."""
    shared = df.sparkSession.sparkContext.broadcast(codec_)

    def run(batches):
        c = shared.value
        for batch in batches:
            ids = [b"".join(c.encode(x.as_py())) for x in batch.column("text")]
            at = np.cumsum([0, *(len(x) // 4 for x in ids)])
            made = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), made], ["doc_id", "ids"])

    return text_frame(df, id_col, text_col).mapInArrow(run, _schema(df, id_col, "ids array<int>"))


def decode(encoded: DataFrame, codec_: Codec) -> DataFrame:
    """``doc_id`` and ``decoded``: the bytes that ``ids`` stand for (a null array: none)."""
    shared = encoded.sparkSession.sparkContext.broadcast(codec_)

    def run(batches):
        c = shared.value
        for batch in batches:
            out = [c.decode(x.values.to_numpy().astype("<u4").tobytes()) if x.is_valid else b"" for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, _schema(encoded, "doc_id", "decoded binary"))


def round_trip(df: DataFrame, codec_: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode the ids, in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    shared = df.sparkSession.sparkContext.broadcast(codec_)

    def one(c: Codec, text: str):
        n, a, b = 0, hashlib.sha256(), hashlib.sha256()
        for ids in c.encode(text):
            n += len(ids) // 4
            a.update(ids)
            b.update(c.decode(ids))
        return n, a.hexdigest(), b.hexdigest()

    def run(batches):
        c = shared.value
        for batch in batches:
            rows = [one(c, x.as_py()) for x in batch.column("text")]
            n, a, b = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return text_frame(df, id_col, text_col).mapInArrow(run, _schema(df, id_col, "n_tokens long, ids_sha256 string, decoded_sha256 string"))


def _schema(df: DataFrame, id_col: str, more: str) -> str:
    return f"doc_id {df.schema[id_col].dataType.simpleString()}, {more}"

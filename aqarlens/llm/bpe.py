"""Byte-level BPE encoding and decoding with a two-tier lookup.

A pre-token that is a vocabulary entry is resolved by a minimal perfect hash
(hash and displace: one displacement per bucket, one slot per entry); any
other pre-token is merged by a heap over a linked list of its bytes, in
O(n log n).  The vocabulary file is read once on the driver; tables and hash
(about 50,000 entries) are broadcast.  Each worker remembers the pieces it has
met, up to a bound, so frequent words are looked up once.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Iterator
from itertools import pairwise
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aqarlens.llm.common import row_slices, worker_state

MEMO = 200_000
#: Words of a bucket: displacement search stays short and the table small.
BUCKET = 4
PRIME = (1 << 31) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class PerfectHash:
    """A minimal perfect hash of byte strings to their values.

    Keys fall into buckets by one part of a 64-bit hash; the largest buckets
    come first, each taking the smallest displacement that puts all its keys
    into free slots; a bucket of one key names its slot.  A lookup compares
    the slot's key, so strings outside the set give None.
    """

    def __init__(self, values: dict[bytes, int]):
        self.n = n = max(1, len(values))
        self.buckets = -(-n // BUCKET)
        self.keys: list[bytes | None] = [None] * n
        self.values = [0] * n
        self.shift = [0] * self.buckets
        groups: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for key in values:
            groups[xxhash.xxh3_64_intdigest(key) % self.buckets].append(key)
        free = np.ones(n, bool)
        singles = []
        for b in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            if len(groups[b]) > 1:
                slots = self._displace(b, groups[b], free)
                for slot, key in zip(slots, groups[b], strict=True):
                    self.keys[slot], self.values[slot] = key, values[key]
            elif groups[b]:
                singles.append(b)
        for b, slot in zip(singles, np.flatnonzero(free).tolist(), strict=False):
            self.keys[slot], self.values[slot] = groups[b][0], values[groups[b][0]]
            self.shift[b] = -slot - 1

    @staticmethod
    def _steps(hashed: int) -> tuple[int, int]:
        return (hashed >> 33) % PRIME, 1 + (hashed >> 8) % (PRIME - 1)

    def _displace(self, bucket: int, keys: list[bytes], free: np.ndarray) -> list[int]:
        start, step = np.array([self._steps(xxhash.xxh3_64_intdigest(k)) for k in keys], np.int64).T[:, :, None]
        for low in range(0, 1 << 24, 1024):
            slots = (start + np.arange(low, low + 1024) * step) % PRIME % self.n
            fits = free[slots].all(0)
            for at in np.flatnonzero(fits):
                own = slots[:, at].tolist()
                if len(set(own)) == len(own):
                    self.shift[bucket] = low + int(at)
                    free[own] = False
                    return own
        raise ValueError("no displacement fits; the set holds keys of equal hash")

    def get(self, key: bytes) -> int | None:
        hashed = xxhash.xxh3_64_intdigest(key)
        shift = self.shift[hashed % self.buckets]
        if shift < 0:
            slot = -shift - 1
        else:
            start, step = self._steps(hashed)
            slot = (start + shift * step) % PRIME % self.n
        return self.values[slot] if self.keys[slot] == key else None


#: Ids that are decoded by one gather.
GATHER = 1 << 18
#: Stands for "this pair is no vocabulary entry" among ranks.
NO_RANK = 1 << 31


def pair_ranks(tier: PerfectHash) -> dict[int, int]:
    """The rank of what each mergeable pair of parts makes, by the parts' ids; one entry per split of a vocabulary entry."""
    ids = dict(zip(tier.keys, tier.values, strict=True))
    ranks = {}
    for piece, rank in ids.items():
        for at in range(1, len(piece)):
            left, right = ids.get(piece[:at]), ids.get(piece[at:])
            if left is not None and right is not None:
                ranks[left << 32 | right] = rank
    return ranks


def merge_parts(ids: list[int], ranks: dict[int, int]) -> list[int]:
    """Merge the lowest-ranked, leftmost pair of parts until none is in the vocabulary.

    Parts form a linked list, named by their first position; the heap holds
    ``rank << 32 | position``.  ``pair`` has the present rank of each
    position's pair, so entries that no longer hold are passed over.
    """
    n, rank_of = len(ids), ranks.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pair = [rank_of(a << 32 | b, NO_RANK) for a, b in pairwise(ids)]
    pair.append(NO_RANK)
    heap = [rank << 32 | at for at, rank in enumerate(pair) if rank != NO_RANK]
    heapq.heapify(heap)
    while heap:
        top = heapq.heappop(heap)
        rank, at = top >> 32, top & 0xFFFFFFFF
        if pair[at] != rank:
            continue
        gone = after[at]
        right = after[at] = after[gone]
        ids[at], ids[gone], pair[gone] = rank, -1, NO_RANK
        if right < n:
            before[right] = at
            new = pair[at] = rank_of(rank << 32 | ids[right], NO_RANK)
            if new != NO_RANK:
                heapq.heappush(heap, new << 32 | at)
        else:
            pair[at] = NO_RANK
        left = before[at]
        if left >= 0:
            new = pair[left] = rank_of(ids[left] << 32 | rank, NO_RANK)
            if new != NO_RANK:
                heapq.heappush(heap, new << 32 | left)
    return [x for x in ids if x >= 0]


class Encoder:
    """Texts to ids; remembers the pre-tokens it has resolved in two generations of ``MEMO`` entries."""

    def __init__(self, tier: PerfectHash, pattern: str):
        self.tier, self.ranks, self.split = tier, pair_ranks(tier), regex.compile(pattern).findall
        self.byte = [tier.get(bytes([b])) for b in range(256)]
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def resolve(self, token: str) -> bytes:
        """The ids of a pre-token as 32-bit integers."""
        piece = token.encode()
        whole = self.tier.get(piece)
        if whole is not None:
            return pack("<i", whole)
        parts = merge_parts([self.byte[b] for b in piece], self.ranks)
        return pack(f"<{len(parts)}i", *parts)

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; a pre-token is asked for once, however often the texts hold it."""
        split = list(map(self.split, texts))
        here = {}
        for token in set().union(*split):
            ids = self.new.get(token) or self.old.get(token)
            here[token] = self.resolve(token) if ids is None else ids
        if len(self.new) + len(here) > MEMO:
            self.old, self.new = self.new, {}
        self.new.update((token, ids) for token, ids in here.items() if len(token) <= 64)
        return [b"".join(map(here.__getitem__, tokens)) for tokens in split]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed([text])[0], "<i4").tolist()


class Decoder:
    """Ids to the bytes they stand for, by gathers from the vocabulary's bytes."""

    def __init__(self, tier: PerfectHash):
        pieces = sorted(zip(tier.values, tier.keys, strict=True)) if tier.keys[0] is not None else []
        self.size = np.zeros(pieces[-1][0] + 1 if pieces else 1, np.int64)
        self.size[[rank for rank, _ in pieces]] = [len(piece) for _, piece in pieces]
        self.begin = np.cumsum(self.size) - self.size
        self.pieces = np.frombuffer(b"".join(piece for _, piece in pieces), np.uint8)

    def _joined(self, ids: np.ndarray) -> bytes:
        n = self.size[ids]
        shift = self.begin[ids] - (np.cumsum(n) - n)
        return self.pieces[np.repeat(shift, n) + np.arange(n.sum())].tobytes()

    def texts(self, lists: pa.ListArray) -> list[bytes]:
        """The bytes of each list of ids; null lists as empty."""
        n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        flat = lists.flatten().to_numpy()
        far = np.concatenate([[0], np.cumsum(self.size[flat])])[np.concatenate([[0], np.cumsum(n)])]
        whole = b"".join(self._joined(flat[low : low + GATHER]) for low in range(0, len(flat), GATHER))
        return [whole[a:b] for a, b in pairwise(far.tolist())]


def _id_lists(encoder: Encoder, texts: pa.Array) -> pa.ListArray:
    lists = encoder.packed([text or "" for text in texts.to_pylist()])
    ends = np.cumsum([0, *(len(x) // 4 for x in lists)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(lists), "<i4")))


def encode(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """(id, ids array<int>) per document, each match of ``pattern`` encoded separately.

    Null text counts as empty and gives an empty array.  Every row gives a
    row, repeated ids included; other columns are not read.  ``decoded`` adds a
    binary column of that name, the ids decoded again in the same task.
    """
    name = uuid.uuid4().hex
    tables = docs.sparkSession.sparkContext.broadcast((PerfectHash(read_ranks(vocabulary)), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = worker_state(name, lambda: (Encoder(*tables.value), Decoder(tables.value[0])))
        for whole in batches:
            for batch in row_slices(whole):
                out = {"id": batch.column(0), "ids": _id_lists(encoder, batch.column(1))}
                if decoded:
                    out["decoded"] = pa.array(decoder.texts(out["ids"]), pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, ids array<int>" + ", decoded binary" * decoded
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, vocabulary: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``tokens`` with the bytes its ids stand for, as binary column ``out_col``; null ids as empty."""
    table = tokens.sparkSession.sparkContext.broadcast(PerfectHash(read_ranks(vocabulary)))
    at = tokens.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(table.value)
        for whole in batches:
            for batch in row_slices(whole):
                arrays = [*batch.columns, pa.array(decoder.texts(batch.column(at)), pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, out_col])

    return tokens.mapInArrow(run, f"{tokens._jdf.schema().toDDL()}, {out_col} binary")


def token_digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Per document: n_tokens and digests of its ids and of the bytes they decode to."""
    ids = encode(docs, vocabulary, pattern, decoded=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return ids.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return token_digests(docs, path, public_tokenizers.PATTERN)

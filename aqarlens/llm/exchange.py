"""Look up keys of chunks of documents in a table that the whole corpus makes.

Documents are dealt into chunks of bounded size.  Each chunk sends its
distinct 64-bit keys, packed in binary rows, to shards by key; a shard merges
what the chunks sent and answers each of them.  A key that occurs in every
document costs one entry per chunk, so no key makes a group that grows with
its rows; a shard's size is bounded by the number of shards, which grows with
the input.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqarlens.llm.common import stage

PACKED = "shard int, chunk int, keys binary, data binary"
EMPTY = pa.table(
    {
        "shard": pa.array([], pa.int32()),
        "chunk": pa.array([], pa.int32()),
        "keys": pa.array([], pa.binary()),
        "data": pa.array([], pa.binary()),
    }
)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys % np.uint64(shards)).astype(np.int64)


def key_bytes(total_bytes: int) -> int:
    """Bytes of a key that tell apart the strings of so many bytes of text, by 2^16 to one and more."""
    return min(8, -(-(max(2, total_bytes).bit_length() + 16) // 8))


def shorten(keys: np.ndarray, width: int) -> np.ndarray:
    """The keys' upper ``width`` bytes."""
    return keys >> np.uint64(64 - 8 * width)


def _to_bytes(keys: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _from_bytes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def pack(chunk: int, keys: np.ndarray, data: np.ndarray, shards: int, width: int = 8) -> pa.Table:
    """A row per shard with its keys, ascending, and their records of ``data`` (one row each)."""
    part = shard_of(keys, shards)
    order = np.lexsort((keys, part))
    keys, data, part = keys[order], data[order], part[order]
    rows = [[], [], [], []]
    for s, low in zip(*np.unique(part, return_index=True), strict=True):
        high = np.searchsorted(part, s, side="right")
        for column, value in zip(rows, (int(s), chunk, _to_bytes(keys[low:high], width), data[low:high].tobytes()), strict=True):
            column.append(value)
    types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    names = ("shard", "chunk", "keys", "data")
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, rows, types, strict=True)})


def unpack(table: pa.Table, dtype, width: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chunk, key, record) of all entries of packed rows."""
    rows = list(zip(*(table.column(c).to_pylist() for c in ("chunk", "keys", "data")), strict=True))
    sizes = [len(k) // width for _, k, _ in rows]
    chunk = np.repeat(np.array([c for c, _, _ in rows], np.int32), sizes)
    keys = _from_bytes(b"".join(k for _, k, _ in rows), width)
    return chunk, keys, np.frombuffer(b"".join(d for _, _, d in rows), dtype)


def by_chunk(chunk: np.ndarray, keys: np.ndarray, data: np.ndarray, shard: int, width: int = 8) -> pa.Table:
    """A packed row per chunk with the answers for it."""
    order = np.argsort(chunk, kind="stable")
    chunk, keys, data = chunk[order], keys[order], data[order]
    rows = [[], [], [], []]
    for c, low in zip(*np.unique(chunk, return_index=True), strict=True):
        high = np.searchsorted(chunk, c, side="right")
        for column, value in zip(rows, (shard, int(c), _to_bytes(keys[low:high], width), data[low:high].tobytes()), strict=True):
            column.append(value)
    types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    names = ("shard", "chunk", "keys", "data")
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, rows, types, strict=True)})


def merged(packed: DataFrame, shards: int, dtype, answer: Callable, width: int = 8) -> DataFrame:
    """Packed answers of all shards: ``answer(chunk, keys, data)`` gives the same three, filtered or changed."""

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        return by_chunk(*answer(*unpack(table, dtype, width)), shard, width)

    return packed.repartition(shards, "shard").groupBy("shard").applyInArrow(run, PACKED)


def answers_of(table: pa.Table, dtype, width: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Answered keys, ascending, and their records, of one chunk."""
    _, keys, data = unpack(table, dtype, width)
    order = np.argsort(keys, kind="stable")
    return keys[order], data[order]


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, position) of each wanted key among ascending ``keys``."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return (keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)), at


#: In place of a shard's number: the row names a text that stands for its copies.
CHOSEN = -1


def distinct_texts(docs: DataFrame, id_col: str, text_col: str, chunks: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(keys, dealt, chosen) for work on different texts.

    ``keys`` has (id, digest) of every row, null text counting as empty.
    ``dealt`` has all rows (id, digest, text) by ``chunk``, in the one shuffle
    that moves texts; copies of a text are spread by their ids.  ``chosen`` has
    a packed row per different text, which names the row with the smallest id
    and the number of copies; ``pick`` takes these rows out of a chunk.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    keys = stage(rows.select("id", "digest"), "text-keys")
    chunk = F.pmod(F.xxhash64("id", "digest"), F.lit(chunks)).cast("int")
    first = keys.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    number = F.unhex(F.lpad(F.hex("copies"), 16, "0"))
    name = F.coalesce(F.unhex(F.lpad(F.hex("id"), 16, "0")), F.lit(b""))
    chosen = first.select(
        F.lit(CHOSEN).alias("shard"), chunk.alias("chunk"), F.col("digest").alias("keys"), F.concat(number, name).alias("data")
    )
    dealt = rows.select("id", "digest", "text", chunk.alias("chunk")).repartition(chunks, "chunk")
    return keys, dealt, chosen.repartition(chunks, "chunk")


def pick(rows: pa.Table, side: pa.Table) -> tuple[pa.Table, pa.Table]:
    """(rows that stand for their texts, once each, with ``copies``; the side's other rows)."""
    mark = side.column("shard").to_numpy() == CHOSEN
    named = side.filter(pa.array(mark))
    copies = {}
    for digest, data in zip(named.column("keys").to_pylist(), named.column("data").to_pylist(), strict=True):
        own = int.from_bytes(data[8:], "big", signed=True) if len(data) > 8 else None
        copies[own, digest] = int.from_bytes(data[:8], "big")
    at, number = [], []
    if rows.num_rows:
        names = zip(rows.column("id").to_pylist(), rows.column("digest").to_pylist(), strict=True)
        for k, name in enumerate(names):
            n = copies.pop(name, None)
            if n is not None:
                at.append(k)
                number.append(n)
        rows = rows.take(pa.array(at, pa.int64()))
    else:
        rows = pa.table({"id": pa.array([], pa.int64()), "digest": pa.array([], pa.binary()), "text": pa.array([], pa.string())})
    return rows.append_column("copies", pa.array(number, pa.int64())), side.filter(pa.array(~mark))

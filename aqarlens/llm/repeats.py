"""Removal of repeated substrings with suffix arrays of text contexts.

Every start of a ``length``-byte string (a window) belongs to an anchor inside
it: the leftmost position, within ``length // 2`` bytes of the start, whose
16-byte hash is smallest.  The choice depends on the window's bytes alone, so
equal windows lie alike around equal anchors, and the bytes that all windows
of an anchor hold after it make its key.

1. Equal texts are collapsed; a text of at least ``length`` bytes with a copy
   goes whole, and one of them stands for it against other texts.
2. Chunks send their anchors' keys to shards, which answer with those that
   occur twice or more.  All other windows are unique.
3. For these, chunks send their different contexts: the text around the anchor
   that its windows cover.  A shard sorts the parts after the anchor with the
   Lyndon-group suffix array (over ranks of 16-byte blocks); equal windows are
   those with equal bytes before the anchor whose suffixes share an interval
   of the longest-common-prefix array.
4. Keys with very many occurrences are not gathered: their windows travel one
   by one as 128-bit fingerprints, spread over all shards, and are counted.
5. Chunks mark the bytes that the repeated windows cover, judged on the input.

Text moves through one shuffle by chunk, which the three passes share.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqarlens.llm import exchange, kernels
from aqarlens.llm.common import chunk_count, stage, text_bytes
from aqarlens.llm.exchange import distinct_texts, pick
from aqarlens.llm.suffix_groups import suffix_array

U64 = np.uint64
GRAM = 16
BLOCK = 16
#: Keys that occur more often take the window-by-window way.
HOT = 512

RESULT = "id long, digest binary, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def windows_by_anchor(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first start, last start) of each run of windows with one anchor; windows stay within texts."""
    n, reach = len(data), length // 2
    gram = min(GRAM, length - reach)
    starts = np.ones(n, np.int32)
    sizes = np.diff(ends)
    blocked = np.zeros(n + 1, np.int32)
    np.add.at(blocked, np.maximum(ends[:-1], ends[1:] - length + 1), 1)
    np.add.at(blocked, ends[1:], -1)
    valid = np.flatnonzero(starts * (np.cumsum(blocked[:-1]) == 0)) if sizes.size else np.zeros(0, np.int64)
    if not len(valid):
        return (np.zeros(0, np.int64),) * 3
    prefix = kernels.prefix_hashes(data)
    at = np.arange(n - gram + 1)
    value = kernels.span_hashes(prefix, at, at + gram) & U64(0xFFFFFFFF00000000) | at.astype(U64)
    # Smallest value over reach + 1 positions, by doubling; its low half is the leftmost position.
    low, width = value, 1
    while width * 2 <= reach + 1:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = reach + 1 - width
    low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
    anchor = (low[valid] & U64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(valid), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(valid)) - 1
    return anchor[first], valid[first], valid[last]


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] of them), then the same from start[1], and so on."""
    offset = np.repeat(np.cumsum(count) - count, count)
    return np.arange(count.sum()) - offset + np.repeat(start, count)


def context_type(length: int) -> np.dtype:
    """A context: its hash, occurrences (2 for more), bytes before the anchor, last window's offset, text."""
    reach = length // 2
    fields = [("ctx", "u8"), ("n", "u1"), ("left", "u4"), ("stay", "u4"), ("text", "u1", (reach + length,))]
    return np.dtype(fields)


WINDOW = np.dtype([("check", "u8"), ("anchor", "u8"), ("n", "u1")])


def mask_type(length: int) -> np.dtype:
    return np.dtype([("ctx", "u8"), ("mask", "u1", (length // 2 // 8 + 1,))])


def sorted_contexts(rights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): rows of zero-padded bytes in order, and each one's common bytes with the one before.

    The order is that of the suffix array of all rows, cut into blocks, set
    one after another with a separator; blocks count by rank, so symbols
    compare as their bytes do.
    """
    rows, width = rights.shape
    padded = np.zeros((rows, -(-width // BLOCK) * BLOCK), np.uint8)
    padded[:, :width] = rights
    words = padded.reshape(rows, -1, 8).view(">u8")[..., 0].astype(U64)
    _, rank = np.unique(words, return_inverse=True)
    pairs = rank.reshape(rows, -1, 2)
    _, rank = np.unique(pairs[..., 0] * (rank.max() + 1) + pairs[..., 1], return_inverse=True)
    symbols = np.zeros((rows, padded.shape[1] // BLOCK + 1), np.int64)
    symbols[:, :-1] = rank.reshape(rows, -1) + 1
    found = np.asarray(suffix_array(symbols.reshape(-1)))
    order = found[found % symbols.shape[1] == 0] // symbols.shape[1]
    inorder = rights[order]
    differ = np.zeros((rows, width + 1), bool)
    differ[:, width] = True
    differ[1:, :width] = inorder[1:] != inorder[:-1]
    common = differ.argmax(1)
    common[0] = 0
    return order, common


def distinct_rows(rights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one row of each content, each row's place among these); they come in no order of their bytes.

    A hash only brings equal rows together; contents are compared in full.
    """
    rows, width = rights.shape
    padded = np.zeros((rows, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rights
    code = np.zeros(rows, U64)
    for word in padded.view(U64).T:
        code = kernels.mix(code * U64(kernels.BASE) + word)
    order = np.argsort(code, kind="stable")
    new = np.ones(rows, bool)
    new[1:] = (rights[order[1:]] != rights[order[:-1]]).any(1)
    place = np.empty(rows, np.int64)
    place[order] = np.cumsum(new) - 1
    return order[new], place


def repeated_masks(keys: np.ndarray, ctx: np.ndarray, length: int) -> np.ndarray:
    """Per context of ``context_type``, which of its windows (by distance to the anchor) occur twice."""
    reach = length // 2
    mask = np.zeros((len(keys), reach + 1), bool)
    _, key_id = np.unique(keys, return_inverse=True)
    several = np.bincount(key_id)[key_id] > 1
    alone = np.flatnonzero(~several & (ctx["n"] > 1))
    distance = np.arange(reach + 1)
    mask[alone] = (distance >= ctx["stay"][alone, None]) & (distance <= ctx["left"][alone, None])
    rows = np.flatnonzero(several)
    if not len(rows):
        return mask
    own = ctx[rows]
    column = np.arange(length)
    take = np.minimum(own["left"][:, None].astype(np.int64) + column, reach + length - 1)
    size = length - own["stay"].astype(np.int64)
    rights = np.where(column < size[:, None], np.take_along_axis(own["text"], take, 1), 0).astype(np.uint8)
    one, inverse = distinct_rows(rights)
    order, common = sorted_contexts(rights[one])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    place = place[inverse]
    before = np.zeros(len(rows), U64)
    weight = own["n"].astype(np.int64)
    for d in range(reach + 1):
        live = np.flatnonzero((own["stay"] <= d) & (d <= own["left"]))
        interval = np.cumsum(common < length - d)[place[live]].astype(U64)
        same = kernels.mix(before[live] + kernels.mix(interval + kernels.mix(keys[rows[live]])))
        _, group = np.unique(same, return_inverse=True)
        mask[rows[live], d] = np.bincount(group, weight[live])[group] > 1
        # One byte more before the anchor, for the next distance.
        further = np.flatnonzero(own["left"] > d)
        byte = own["text"][further, own["left"][further].astype(np.int64) - d - 1]
        before[further] = kernels.mix(before[further] * U64(kernels.BASE) + kernels.BYTE_VALUE[byte])
    return mask


def _context_hash(prefix, anchor, first, last, length):
    return kernels.mix(kernels.span_hashes(prefix, first, last + length) + (anchor - first).astype(U64))


def _window_prints(prefix, start, length):
    """Two 64-bit hashes of each window; the second from its halves."""
    half = length // 2
    whole = kernels.span_hashes(prefix, start, start + length)
    front = kernels.span_hashes(prefix, start, start + half)
    back = kernels.span_hashes(prefix, start + half, start + length)
    return whole, kernels.mix(front * U64(0xD6E8FEB86659FD93) + kernels.mix(back))


def _anchored(table: pa.Table, length: int):
    """(first row, end row, data, ends, prefix, anchor, first start, last start, key) of runs of texts."""
    for first, last, data, ends in kernels.batches(table.column("text").to_pylist()):
        anchor, low, high = windows_by_anchor(data, ends, length)
        prefix = kernels.prefix_hashes(data)
        key = kernels.span_hashes(prefix, anchor, anchor + length - length // 2)
        yield first, last, data, ends, prefix, anchor, low, high, key


def repeated_spans(
    dealt: DataFrame, chosen: DataFrame, chunks: int, length: int = 200, hot: int = HOT
) -> DataFrame:
    """Per different text of ``distinct_texts``: its byte spans to remove, and the bytes kept."""
    context, masks = context_type(length), mask_type(length)

    def send_keys(rows: pa.Table, side: pa.Table) -> pa.Table:
        found = [key for *_, key in _anchored(pick(rows, side)[0], length)]
        if not found:
            return exchange.EMPTY
        keys, counts = np.unique(np.concatenate(found), return_counts=True)
        counts = np.minimum(counts, 65535).astype(np.uint16)
        return exchange.pack(side.column("chunk")[0].as_py(), keys, counts, chunks)

    def repeated_keys(chunk, keys, counts):
        _, inverse = np.unique(keys, return_inverse=True)
        total = np.bincount(inverse, weights=counts)[inverse]
        several = total > 1
        return chunk[several], keys[several], np.where(total[several] > hot, 2, 1).astype(np.uint8)

    def send_contexts(rows: pa.Table, side: pa.Table) -> pa.Table:
        texts, answers = pick(rows, side)
        known, kind = exchange.answers_of(answers, np.uint8)
        cold, single = [], []
        for _, _, data, _, prefix, anchor, low, high, key in _anchored(texts, length):
            hit, at = exchange.find(known, key)
            many = hit.copy()
            many[hit] = kind[at[hit]] == 2
            few = np.flatnonzero(hit & ~many)
            ctx = _context_hash(prefix, anchor[few], low[few], high[few], length)
            record = np.zeros(len(few), context)
            record["ctx"], record["n"] = ctx, 1
            record["left"], record["stay"] = anchor[few] - low[few], anchor[few] - high[few]
            count = high[few] - low[few] + length
            row = np.repeat(np.arange(len(few)), count)
            record["text"][row, _ranges(np.zeros(len(few), np.int64), count)] = data[_ranges(low[few], count)]
            cold.append((key[few], record))
            many = np.flatnonzero(many)
            count = high[many] - low[many] + 1
            start = _ranges(low[many], count)
            whole, check = _window_prints(prefix, start, length)
            record = np.zeros(len(start), WINDOW)
            record["check"], record["anchor"], record["n"] = check, np.repeat(key[many], count), 1
            single.append((whole, record))
        parts = []
        number = side.column("chunk")[0].as_py() if side.num_rows else -1
        for found, field, base in ((cold, "ctx", 0), (single, "check", chunks)):
            if not found:
                continue
            keys, record = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((record[field], keys))
            keys, record = keys[order], record[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (record[field][1:] != record[field][:-1])
            record = record.copy()
            first = np.flatnonzero(new)
            record["n"][first] = np.minimum(np.diff(np.append(first, len(keys))), 2)
            part = exchange.pack(number, keys[new], record[new], chunks)
            moved = pa.array(part.column("shard").to_numpy() + base, pa.int32())
            parts.append(part.set_column(0, "shard", moved))
        return pa.concat_tables(parts) if parts else exchange.EMPTY

    def find_repeats(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        if shard < chunks:
            chunk, keys, record = exchange.unpack(table, context)
            both = np.lexsort((record["ctx"], keys))
            chunk, keys, record = chunk[both], keys[both], record[both]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (record["ctx"][1:] != record["ctx"][:-1])
            one = np.flatnonzero(new)
            different = record[one]
            different["n"] = np.minimum(np.add.reduceat(record["n"].astype(np.int64), one), 2)
            mask = repeated_masks(keys[one], different, length)
            which = np.cumsum(new) - 1
            any_ = mask.any(1)[which]
            out = np.zeros(int(any_.sum()), masks)
            out["ctx"] = record["ctx"][any_]
            out["mask"] = np.packbits(mask, axis=1, bitorder="little")[which[any_]]
            return exchange.by_chunk(chunk[any_], keys[any_], out, shard)
        chunk, keys, record = exchange.unpack(table, WINDOW)
        both = np.lexsort((record["check"], keys))
        chunk, keys, record = chunk[both], keys[both], record[both]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (record["check"][1:] != record["check"][:-1])
        total = np.add.reduceat(record["n"].astype(np.int64), np.flatnonzero(new))[np.cumsum(new) - 1]
        return exchange.by_chunk(chunk[total > 1], keys[total > 1], record[total > 1], shard)

    def remove(rows: pa.Table, side: pa.Table) -> pa.Table:
        texts, answers = pick(rows, side)
        kind = answers.column("shard").to_numpy() < chunks
        known, found = exchange.answers_of(answers.filter(pa.array(kind)), masks)
        twin, single = exchange.answers_of(answers.filter(pa.array(~kind)), WINDOW)
        # Contexts of one key are told apart by their hash: both are looked up as one.
        joint = kernels.mix(known + kernels.mix(found["ctx"]))
        order = np.argsort(joint)
        joint, bits = joint[order], np.unpackbits(found["mask"][order], axis=1, bitorder="little").astype(bool)
        hot_anchors = np.unique(single["anchor"])
        pair = np.sort(kernels.mix(twin + kernels.mix(single["check"])))
        columns = {"id": [], "digest": [], "n_bytes": [], "spans": [], "kept": []}
        copies = texts.column("copies").to_pylist()
        for first, last, data, ends, prefix, anchor, low, high, key in _anchored(texts, length):
            ctx = _context_hash(prefix, anchor, low, high, length)
            hit, at = exchange.find(joint, kernels.mix(key + kernels.mix(ctx)))
            run, distance = np.nonzero(bits[at[hit], : length // 2 + 1]) if hit.any() else (np.zeros(0, int),) * 2
            starts = anchor[hit][run] - distance
            many = np.flatnonzero(exchange.find(hot_anchors, key)[0])
            if len(many):
                every = _ranges(low[many], high[many] - low[many] + 1)
                whole, check = _window_prints(prefix, every, length)
                again = exchange.find(pair, kernels.mix(whole + kernels.mix(check)))[0]
                starts = np.concatenate([starts, every[again]])
            step = np.bincount(starts, minlength=len(data) + 1)[: len(data) + 1].astype(np.int64)
            step -= np.bincount(starts + length, minlength=len(data) + 1)[: len(data) + 1]
            covered = np.cumsum(step)[:-1] > 0
            for k in range(last - first):
                begin, end = int(ends[k]), int(ends[k + 1])
                gone = covered[begin:end]
                if copies[first + k] > 1 and end - begin >= length:
                    gone = np.ones(end - begin, bool)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                columns["n_bytes"].append(end - begin)
                columns["spans"].append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
                columns["kept"].append(data[begin:end][~gone].tobytes())
        columns["id"], columns["digest"] = texts.column("id"), texts.column("digest")
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types = (pa.int64(), pa.binary(), pa.int64(), span, pa.binary())
        return pa.table(
            {n: c if isinstance(c, pa.ChunkedArray) else pa.array(c, t) for (n, c), t in zip(columns.items(), types, strict=True)}
        )

    by_chunk = dealt.groupBy("chunk")

    def side(answers: DataFrame):
        return chosen.union(answers).repartition(chunks, "chunk").groupBy("chunk")

    packed = by_chunk.cogroup(chosen.groupBy("chunk")).applyInArrow(send_keys, exchange.PACKED)
    repeated = exchange.merged(packed, chunks, np.uint16, repeated_keys)
    contexts = by_chunk.cogroup(side(repeated)).applyInArrow(send_contexts, exchange.PACKED)
    shards = contexts.repartition(2 * chunks, "shard").groupBy("shard").applyInArrow(find_repeats, exchange.PACKED)
    return by_chunk.cogroup(side(shards)).applyInArrow(remove, RESULT)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """(id, n_bytes, spans, kept) per row: the bytes to remove as [start, end), and the rest joined.

    A byte goes if a ``length``-byte string that also starts anywhere else, in
    any document, covers it.  Null text counts as empty.  Rows that repeat are
    documents like any others, so their texts go if long enough.  Rows without
    an id take part and keep their null id.  Other columns are not read; an
    empty table gives an empty result.
    """
    keys, found = _found(docs, id_col, text_col, length)
    return keys.join(found.drop("id"), "digest").drop("digest").withColumnRenamed("id", id_col)


def _found(docs: DataFrame, id_col: str, text_col: str, length: int) -> tuple[DataFrame, DataFrame]:
    chunks = chunk_count(text_bytes(docs, text_col))
    keys, dealt, chosen = distinct_texts(docs, id_col, text_col, chunks)
    return keys, repeated_spans(dealt, chosen, chunks, length)


def op2_suffix_dedup(spark, sf_dir):
    """The digest columns are taken before equal texts get their rows back, so kept bytes are not joined."""
    keys, found = _found(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text", 200)
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    found = found.select(
        "digest",
        "n_bytes",
        size.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    found = stage(found, "repeats")
    return keys.withColumnRenamed("id", "doc_id").join(found, "digest").drop("digest")

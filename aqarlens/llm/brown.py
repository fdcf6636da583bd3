"""Language-model scores from a class-based trigram model.

1. Words of the training documents are counted.  The most frequent ones
   (``head``, a parameter) are clustered by the exchange algorithm on all their
   adjoining pairs in the corpus: a word moves to the class that raises the
   class-bigram likelihood most, until no word moves.
2. Every other word takes the class that best predicts the classes around its
   occurrences; chunks of documents vote, weighted by the occurrences that have
   a placed word beside them.  In the batch exchange rounds after that
   (``rounds``), all words outside the head may move at once: the votes are
   taken again with the classes that the round before gave the whole
   vocabulary.  Words seen once, and words never seen, form the rare class;
   words seen more often that never stand beside a placed one form the loose
   class; the end of a text is a class of its own.
3. Each document becomes its sequence of classes; transitions between classes
   are counted over all training documents.
4. A token's probability is that of its class after the two classes before
   it, backing off to one, to none, times its share of its class.

Words are 64-bit hashes.  Counts of words come back to chunks of documents
through shards, so neither a frequent word nor the vocabulary ever meets in
one task or on the driver; the driver holds head pairs (``head`` squared at
most) and class transitions (their number of classes cubed at most).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aqarlens.llm import exchange, kernels
from aqarlens.llm.common import chunk_count, in_chunks, stage, text_bytes

U64 = np.uint64
#: The end of a text, as a word (no word hashes to this value but by chance).
END = U64(0xE0D0F7E87A5C0DE5)
HEAD = 1024
CLASSES = 40
#: Weight of the shorter history in smoothing.
BACKOFF = 12.0
#: Rounds in which the whole vocabulary outside the head is placed anew.
ROUNDS = 1

COUNT = np.dtype([("n", "u8"), ("vote", "u1"), ("votes", "u4")])
SEQUENCE = "id long, held_out boolean, n_tokens long, n_known long, base double, log_counts double, classes binary"


def held_out_of(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def tokens(texts: list[str | None]):
    """(first row, end row, word hashes with an END after each text, row of each token) of runs of texts."""
    for first, last, data, ends in kernels.batches(texts):
        hashes, doc = kernels.words(data, ends)
        at = np.searchsorted(doc, np.arange(last - first), side="right")
        word = np.insert(hashes, at, END)
        yield first, last, word, np.insert(doc, at, np.arange(last - first))


def word_totals(docs: DataFrame, head: int) -> tuple[np.ndarray, int, int]:
    """(the most frequent words, number of tokens, number of distinct tokens) of training rows."""

    def counted_of(held):
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["word", "n"])

    def count(batches):
        held, size = [], 0
        for batch in batches:
            for _, _, word, _ in tokens(batch.column(0).to_pylist()):
                held.append(word)
                size += len(word)
                if size >= 1 << 22:
                    yield counted_of(held)
                    held, size = [], 0
        if held:
            yield counted_of(held)

    counted = docs.where("not held_out").select("text").mapInArrow(count, "word long, n long")
    counted = stage(counted.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    total, distinct = counted.agg(F.sum("n"), F.count("*")).first()
    top = counted.where(F.col("word") != int(END.astype(np.int64))).orderBy(F.desc("n"), "word").limit(head)
    return np.array([r["word"] for r in top.toLocalIterator()], np.int64).view(U64), total or 0, distinct or 0


def head_pairs(docs: DataFrame, head: np.ndarray) -> np.ndarray:
    """Counts of adjoining head words (and text ends, as the last index) in training rows."""
    known = np.sort(np.append(head, END))
    size = len(known)

    def count(batches):
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for _, _, word, _ in tokens(batch.column(0).to_pylist()):
                # Each text begins after an end, the first of a batch too.
                hit, at = exchange.find(known, np.append(END, word))
                both = hit[1:] & hit[:-1]
                total += np.bincount(at[:-1][both] * size + at[1:][both], minlength=size * size)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(total[code])], names=["code", "n"])

    counted = docs.where("not held_out").select("text").mapInArrow(count, "code long, n long")
    counted = counted.groupBy("code").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    pairs = np.zeros(size * size)
    pairs[table.column("code").to_numpy()] = table.column("n").to_numpy()
    return pairs.reshape(size, size)


def exchange_classes(pairs: np.ndarray, classes: int, fixed: int) -> np.ndarray:
    """Class of each word by the exchange algorithm; ``fixed`` is alone in the last class, number ``classes``.

    Words start in classes by rank of frequency.  In each round every word, the
    most frequent first, is taken out and put where the sum of
    n(c, d) log n(c, d) - n(c) log n(c) - n(d) log n(d) is largest, until no
    word moves; each move raises the likelihood, so this ends.
    """
    size = len(pairs)
    order = np.argsort(-(pairs.sum(0) + pairs.sum(1)), kind="stable")
    order = order[order != fixed]
    cls = np.full(size, classes)
    cls[order] = np.arange(len(order)) % classes
    k = classes + 1
    member = np.zeros((size, k))
    member[np.arange(size), cls] = 1
    both = member.T @ pairs @ member

    def xlogx(x):
        return x * np.log(np.maximum(x, 1e-300))

    moved = size
    while moved:
        moved = 0
        for w in order:
            old = cls[w]
            own = pairs[w, w]
            right = np.bincount(cls, pairs[w], k)
            left = np.bincount(cls, pairs[:, w], k)
            right[old] -= own
            left[old] -= own
            both[old] -= right
            both[:, old] -= left
            both[old, old] -= own
            row, column = both.sum(1), both.sum(0)
            base_row, base_column = xlogx(both + right), xlogx(both + left[:, None])
            plain = xlogx(both)
            gain = (base_row - plain).sum(1) + (base_column - plain).sum(0)
            at = np.arange(k)
            diagonal = both[at, at]
            # The diagonal cell takes both sides and the word's own pairs.
            gain += xlogx(diagonal + right + left + own) - xlogx(diagonal + right) - xlogx(diagonal + left)
            gain += plain[at, at]
            # A class's sums hold its pairs with the word wherever the word is.
            row, column = row + left, column + right
            gain -= xlogx(row + right.sum() + own) - xlogx(row) + xlogx(column + left.sum() + own) - xlogx(column)
            gain[classes] = -np.inf
            new = int(np.argmax(gain)) if gain.max() > gain[old] + 1e-9 else old
            both[new] += right
            both[:, new] += left
            both[new, new] += own
            moved += new != old
            cls[w] = new
    return cls


class Model:
    """What is broadcast: head words with classes, and class affinities for votes."""

    def __init__(self, words: np.ndarray, cls: np.ndarray, pairs: np.ndarray, classes: int):
        order = np.argsort(words)
        self.words, self.cls, self.classes = words[order], cls[order].astype(np.int64), classes
        member = np.zeros((len(words), classes + 1))
        member[np.arange(len(words)), cls] = 1
        both = member.T @ pairs @ member + 0.5
        # Log probability of a neighbour's class given the word's: rows by neighbour; the last row, no known one.
        self.before = np.vstack([np.log(both / both.sum(0)), np.zeros(classes + 1)])
        self.after = np.vstack([np.log(both / both.sum(1, keepdims=True)).T, np.zeros(classes + 1)])


def _head_classes(model: Model, word: np.ndarray) -> np.ndarray:
    """Each token's class where it is a head word (the end is one), else the number of no known class."""
    hit, at = exchange.find(model.words, word)
    return np.where(hit, model.cls[at] if len(model.words) else 0, model.classes + 1)


def _votes(model: Model, word: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, ...]:
    """(distinct words, occurrences, best class, votes for it) of a run of tokens with classes.

    Head words keep their class.  Occurrences beside a placed token vote; words without any are loose.
    """
    # Texts' ends part them, as the end has a class.
    left, right = np.append(model.classes, cls[:-1]), np.append(cls[1:], model.classes + 1)
    keys, inverse, n = np.unique(word, return_inverse=True, return_counts=True)
    order = np.argsort(inverse, kind="stable")
    score = np.zeros((len(keys), model.classes))
    ends = np.cumsum(n)
    for low in range(0, len(keys), 4096):
        high = min(len(keys), low + 4096)
        token = order[ends[low] - n[low] : ends[high - 1]]
        parts = model.before[left[token], :-1] + model.after[right[token], :-1]
        score[low:high] = np.add.reduceat(parts, ends[low:high] - n[low:high] - (ends[low] - n[low]), axis=0)
    votes = np.bincount(inverse, (left <= model.classes) | (right <= model.classes), len(keys)).astype(np.int64)
    best = np.where(votes > 0, score.argmax(1), model.classes)
    hit, at = exchange.find(model.words, keys)
    best[hit] = model.cls[at[hit]]
    return keys, n, best, votes


def class_sequences(
    docs: DataFrame, chunks: int, model: Model, total: int, distinct: int, rounds: int = ROUNDS
) -> DataFrame:
    """Per row: token counts, base score, sum of log counts, and the class of each token, as ``SEQUENCE``."""
    dealt = in_chunks(docs, chunks)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    loose, rare, end = range(model.classes, model.classes + 3)

    def ask(table: pa.Table, class_of) -> pa.Table:
        fitted = shared.value
        train = pa.array(~table.column("held_out").to_numpy())
        found = [(np.zeros(0, U64), np.zeros(0, COUNT))]
        for _, _, word, _ in tokens(table.filter(train).column("text").to_pylist()):
            keys, *counted = _votes(fitted, word, class_of(word))
            record = np.zeros(len(keys), COUNT)
            record["n"], record["vote"], record["votes"] = counted
            found.append((keys, record))
        # Held-out rows ask for their words and tell nothing about them.
        for _, _, word, _ in tokens(table.filter(pc.invert(train)).column("text").to_pylist()):
            keys = np.unique(word)
            record = np.zeros(len(keys), COUNT)
            record["vote"] = loose
            found.append((keys, record))
        keys, record = (np.concatenate(x) for x in zip(*found, strict=True))
        return exchange.pack(table.column("chunk")[0].as_py(), *_voted(keys, record)[:2], chunks)

    def send(table: pa.Table) -> pa.Table:
        return ask(table, lambda word: _head_classes(shared.value, word))

    def send_again(rows: pa.Table, answers: pa.Table) -> pa.Table:
        known, record = exchange.answers_of(answers, COUNT)
        # Rare and loose words tell nothing about their neighbours.
        placed = np.where((record["n"] > 1) & (record["vote"] < loose), record["vote"], loose + 1)
        placed[known == END] = loose
        return ask(rows, lambda word: placed[exchange.find(known, word)[1]]) if rows.num_rows else exchange.EMPTY

    def answer(chunk, keys, record):
        one, merged, which = _voted(keys, record)
        return chunk, keys, merged[which]

    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        known, record = exchange.answers_of(answers, COUNT)
        out = [[] for _ in range(7)]
        held = rows.column("held_out").to_pylist() if rows.num_rows else []
        for first, last, word, doc in tokens(rows.column("text").to_pylist()) if rows.num_rows else ():
            at = exchange.find(known, word)[1]
            n = record["n"][at].astype(np.int64)
            cls = np.where(n > 1, record["vote"][at], rare).astype(np.uint8)
            cls[word == END] = end
            ends = np.searchsorted(doc, np.arange(last - first), side="right")
            begins = np.append(0, ends[:-1])
            base = np.add.reduceat(np.log10((n + 1) / (total + 1 * (distinct + 1))), begins)
            # The rare class spreads evenly; its members add no count of their own.
            own = np.add.reduceat(np.where(cls == rare, 0.0, np.log10(np.maximum(n, 1))), begins)
            known_n = np.add.reduceat((n > 0).astype(np.int64), begins)
            for k in range(last - first):
                values = (None, held[first + k], int(ends[k] - begins[k]), int(known_n[k]), float(base[k]))
                for column, value in zip(out, (*values, float(own[k]), cls[begins[k] : ends[k]].tobytes()), strict=True):
                    column.append(value)
        types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
        names = ("id", "held_out", "n_tokens", "n_known", "base", "log_counts", "classes")
        table = pa.table({n: pa.array(c, t) for n, c, t in zip(names, out, types, strict=True)})
        return table.set_column(0, "id", rows.column("id")) if rows.num_rows else table

    packed = dealt.groupBy("chunk").applyInArrow(send, exchange.PACKED)
    for _ in range(rounds):
        answers = exchange.merged(packed, chunks, COUNT, answer).repartition(chunks, "chunk")
        packed = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(send_again, exchange.PACKED)
    answers = exchange.merged(packed, chunks, COUNT, answer).repartition(chunks, "chunk")
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, SEQUENCE)


def _voted(keys: np.ndarray, record: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, merged records, index of each key): counts summed, the class with most votes (then lowest)."""
    order = np.lexsort((record["vote"], keys))
    k, r = keys[order], record[order]
    part = np.ones(len(k), bool)
    part[1:] = (k[1:] != k[:-1]) | (r["vote"][1:] != r["vote"][:-1])
    at = np.flatnonzero(part)
    votes = np.add.reduceat(r["votes"].astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    n = np.add.reduceat(r["n"].astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    one, first, which = np.unique(k[at], return_index=True, return_inverse=True)
    merged = np.zeros(len(one), COUNT)
    merged["n"] = np.bincount(which, n, len(one)).astype(np.int64)
    best = np.lexsort((-r["vote"][at].astype(np.int64), votes, which))
    last = np.append(first[1:], len(at)) - 1
    merged["vote"] = r["vote"][at][best][last]
    merged["votes"] = np.minimum(votes[best][last], 2**32 - 1)
    return one, merged, np.searchsorted(one, keys)


def transitions(sequences: DataFrame, states: int) -> np.ndarray:
    """Counts of three classes in a row over training rows; texts begin after two ends."""

    def count(batches):
        total = np.zeros(states**3, np.int64)
        for batch in batches:
            lists = batch.column(0).to_pylist()
            flat = np.frombuffer(b"".join(bytes([states - 1, states - 1]) + x for x in lists), np.uint8).astype(np.int64)
            if not len(flat):
                continue
            code = (flat[:-2] * states + flat[1:-1]) * states + flat[2:]
            # Positions that begin in one text and end in another are no transition.
            ends = np.cumsum([len(x) + 2 for x in lists])[:-1]
            keep = np.ones(len(code), bool)
            keep[ends - 2] = keep[ends - 1] = False
            total += np.bincount(code[keep], minlength=states**3)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(total[code])], names=["code", "n"])

    counted = sequences.where("not held_out").select("classes").mapInArrow(count, "code long, n long")
    table = counted.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(states**3)
    out[table.column("code").to_numpy()] = table.column("n").to_numpy()
    return out.reshape(states, states, states)


def log_probabilities(counts: np.ndarray, backoff: float = BACKOFF) -> np.ndarray:
    """log10 of P(class | two classes before) / count of the class, with back-off at each level."""
    states = len(counts)
    single = counts.sum((0, 1))
    one = (single + 1) / (single.sum() + states)
    pair = counts.sum(0)
    two = (pair + backoff * one) / (pair.sum(1, keepdims=True) + backoff)
    three = (counts + backoff * two[None]) / (counts.sum(2, keepdims=True) + backoff)
    # A member of the rare class is one of its words or the unseen one; others share by their counts.
    sizes = np.maximum(single, 1.0)
    sizes[states - 2] = single[states - 2] + 1
    return np.log10(three) - np.log10(sizes)


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    head: int = HEAD,
    classes: int = CLASSES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per document: held_out, n_tokens, n_known, train_tokens, base_score, score (log10), perplexity.

    Null and empty texts have one token, the end.  Rows without an id are
    training rows.  Rows that repeat count as often as they occur and score
    alike.  Other columns are not read.  Without training rows every word is
    unseen; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.withColumn("held_out", held_out_of(F.col("id")))
    words, total, distinct = word_totals(rows, head)
    pairs = head_pairs(rows, words)
    known = np.sort(np.append(words, END))
    cls = exchange_classes(pairs, classes, int(np.searchsorted(known, END)))
    model = Model(known, cls, pairs, classes)
    chunks = chunk_count(text_bytes(docs, text_col))
    sequences = stage(class_sequences(rows, chunks, model, total, distinct, rounds), "class-sequences")
    states = classes + 3
    table = docs.sparkSession.sparkContext.broadcast(log_probabilities(transitions(sequences, states)))
    start = bytes([states - 1, states - 1])

    def score(batches):
        for batch in batches:
            lists = batch.column(1).to_pylist()
            scores = []
            for x in lists:
                c = np.frombuffer(start + x, np.uint8)
                scores.append(float(table.value[c[:-2], c[1:-1], c[2:]].sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:1], *batch.columns[2:], pa.array(scores)], names=names)

    names = ["id", "held_out", "n_tokens", "n_known", "base", "log_counts", "transitions"]
    fields = sequences.select("id", "classes", "held_out", "n_tokens", "n_known", "base", "log_counts")
    scored = fields.mapInArrow(
        score,
        "id long, held_out boolean, n_tokens long, n_known long, base double, log_counts double, transitions double",
    )
    total_score = F.col("transitions") + F.col("log_counts")
    return scored.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        total_score.alias("score"),
        F.pow(F.lit(10.0), -total_score / F.col("n_tokens")).alias("perplexity"),
    )


def op9_lm_scoring(spark, sf_dir):
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))

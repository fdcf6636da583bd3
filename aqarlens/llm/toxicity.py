"""Toxicity by a learned lexicon, Levenshtein automata and context windows.

1. Lexicon: among the training labels, words and word beginnings that mark
   toxic documents far beyond chance (a bound on the binomial tail, corrected
   for the number of candidates), whole words or stems, and that occur in
   several families of near copies.  Every term of two toxic training rows is a
   candidate; counts, tests, families and the choice among beginnings of one
   word are Spark tables over all training rows.
2. The lexicon's trie is intersected with Levenshtein automata of distance one:
   the product is made into a deterministic automaton as words need it, so a
   word costs one step per character and most words fail after a few.
3. Misspelt forms whose share of toxic documents, among the training documents
   that use them, is below that of lexicon terms are ordinary words and leave
   the matches.
4. A match inside quotation marks or next to words of reporting counts as
   quoted, others as abuse; both are summed over the document.
5. A logistic regression on these sums, fitted on about ``FIT_ROWS`` labelled
   training rows, gives the score.

Scores come from texts alone; no label, language, source or id enters them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqarlens.llm import kernels
from aqarlens.llm.common import components, free_names, row_slices, stage, worker_state

FIT_ROWS = 20_000
#: Lengths of the beginnings of words that can be lexicon terms (longer words are terms as
#: wholes only), and the shortest term that may be misspelt.
SHORTEST, LONGEST, FUZZY = 4, 16, 5
#: A lexicon term's share of toxic documents among those that have it.
PRECISION = 0.9
CHANCE = 0.1
#: Words on either side of a match that are looked at.
WINDOW = 4

_SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = ".,;:!?()[]{}<>\"'`*_~|«»„“”‚‘’…-"
_OPENING, _CLOSING = frozenset("\"'«„“‚‘`"), frozenset("\"'»“”‘’`")
#: Words of reporting in the corpus languages (fixed values).
REPORTING = frozenset(
    "said says wrote writes called calls quoted quotes quote term word called "
    "sagte schrieb nannte zitat wort dit écrit appelé citation mot dijo escribió llamó cita palabra".split()
)


def words_of(text: str) -> list[str]:
    """Words as written, split at ASCII white space."""
    return _SPLIT.findall(text)


def plain(word: str) -> str:
    """A word in lower case without punctuation at its ends."""
    return word.strip(_EDGES).lower()


class FuzzyTrie:
    """The terms' trie times the automata of edit distance one, determinised on demand.

    A state is the set of (trie node, edits) pairs that an input's beginning
    can be in.  A term matches every word that begins with it.  A term that is
    a word (true in ``terms``) and has ``FUZZY`` characters or more also
    matches whole words one edit away; terms that are only beginnings of words
    would reach too many others.  ``match`` gives 0 for no match, 1 for a
    misspelt and 2 for an exact one.
    """

    def __init__(self, terms: dict[str, bool]):
        self.next: list[dict[str, int]] = [{}]
        self.term: list[bool] = [False]
        #: Nodes on the way to a term that may be misspelt, and the ends of such terms.
        self.long: list[bool] = [False]
        self.word: list[bool] = [False]
        for term, is_word in sorted(terms.items()):
            path = [0]
            for character in term:
                node = self.next[path[-1]].get(character)
                if node is None:
                    node = self.next[path[-1]][character] = len(self.next)
                    self.next.append({})
                    for flags in (self.term, self.long, self.word):
                        flags.append(False)
                path.append(node)
            self.term[path[-1]] = True
            if is_word and len(term) >= FUZZY:
                self.word[path[-1]] = True
                for node in path:
                    self.long[node] = True
        first = self._closed({(0, 0)})
        self.states = {first: 0}
        self.sets = [first]
        self.steps: list[dict[str, int]] = [{}]
        self.marks = [self._mark(first)]

    def _closed(self, pairs: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        """Adds what a left-out character of the term reaches; of a node, only the fewest edits stay."""
        out = dict.fromkeys((n for n, e in pairs if e == 0), 0)
        for node, edits in pairs:
            if edits == 0 and self.long[node]:
                for child in self.next[node].values():
                    if self.long[child]:
                        out.setdefault(child, 1)
            out.setdefault(node, edits)
        return frozenset(out.items())

    def _mark(self, pairs) -> tuple[bool, bool]:
        """(a term has been read without an edit, what has been read is a word with one edit at most)."""
        exact = any(self.term[node] and edits == 0 for node, edits in pairs)
        return exact, any(self.word[node] for node, _ in pairs)

    def _step(self, state: int, character: str) -> int:
        reached: set[tuple[int, int]] = set()
        for node, edits in self.sets[state]:
            child = self.next[node].get(character)
            if child is not None:
                reached.add((child, edits))
            if edits == 0 and self.long[node]:
                reached.add((node, 1))
                for other in self.next[node].values():
                    if self.long[other]:
                        reached.add((other, 1))
        closed = self._closed(reached)
        if not closed:
            return -1
        if closed not in self.states:
            self.states[closed] = len(self.sets)
            self.sets.append(closed)
            self.steps.append({})
            self.marks.append(self._mark(closed))
        return self.states[closed]

    def match(self, word: str) -> int:
        state = 0
        for character in word:
            to = self.steps[state].get(character)
            if to is None:
                to = self._step(state, character)
                if len(self.steps[state]) < 4096:
                    self.steps[state][character] = to
            if to < 0:
                return 0
            state = to
            if self.marks[state][0]:
                return 2
        return int(self.marks[state][1])


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(text, toxic, h) of the training rows: labelled, and outside the held-out fold; h orders them by chance."""
    marks = labels.where("toxic is not null").groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.join(marks.hint("shuffle_hash"), rows["id"] == marks["__id"]).where(~held_out_of(F.col("id")))
    return rows.select("text", F.col("toxic").cast("int").alias("toxic"), F.xxhash64(F.lit(7), "id").alias("h"))


def _sampled(rows: DataFrame, total: int, wanted: int) -> DataFrame:
    """About ``wanted`` of ``total`` rows, by their chance number; rows stay where they are."""
    if total <= wanted:
        return rows
    return rows.where(F.pmod("h", F.lit(1_000_003)) < int(1_000_003 * wanted / total))


def held_out_of(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


#: Ends a term that is a whole word of the text, beside the same one as a beginning.
WHOLE = "\0"


def _terms(text: str) -> set[str]:
    found = set()
    for word in {plain(w) for w in words_of(text)}:
        found.update(word[:k] for k in range(SHORTEST, min(len(word), LONGEST) + 1))
        if len(word) > LONGEST:
            found.add(word)
        if len(word) >= SHORTEST:
            found.add(word + WHOLE)
    return found


def _counted(rows: DataFrame, whole: bool) -> DataFrame:
    """(term, n) over the texts: documents with the term; whole words beside beginnings if asked for."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        held = 0

        def flush():
            out = pa.RecordBatch.from_pydict({"term": list(total), "n": pa.array(total.values(), pa.int64())})
            total.clear()
            return out

        worker_state("toxicity", dict)
        for batch in chain.from_iterable(map(row_slices, batches)):
            for text in batch.column(0).to_pylist():
                found = _terms(text)
                total.update(found if whole else (t for t in found if not t.endswith(WHOLE)))
                held += sum(map(len, found))
                if len(total) > 500_000 or held > 128 << 20:
                    yield flush()
                    held = 0
        if total:
            yield flush()

    return rows.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def learn_lexicon(train: DataFrame) -> dict[str, bool]:
    """Word beginnings that mark toxic rows, the longest ones of equal reach.

    The value tells whether the term is mostly a whole word there.
    """
    n = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return {}
    in_toxic = stage(_counted(train.where("toxic = 1"), True).where("n > 1"), "toxic-terms")
    is_whole = F.col("term").endswith(WHOLE)
    begins = in_toxic.where(~is_whole).withColumnRenamed("n", "hits")
    words = in_toxic.where(is_whole).select(F.expr("left(term, char_length(term) - 1)").alias("term"), F.col("n").alias("whole"))
    share = toxic / (toxic + clean)
    needed = math.log(max(1, begins.where("hits > 2").count()) / CHANCE)
    # Terms with too few hits fail even if no clean row has them.
    begins = begins.where(F.col("hits") * -math.log(share) > needed)
    other = _counted(train.where("toxic = 0"), False).withColumnRenamed("n", "other")
    counted = begins.join(other, "term", "left").withColumn("total", F.col("hits") + F.coalesce("other", F.lit(0)))
    counted = counted.withColumn("rate", F.col("hits") / F.col("total")).where(F.col("rate") >= max(PRECISION, share))
    # Chernoff's bound on drawing so many toxic documents by chance.
    rest = F.when(F.col("rate") < 1, (1 - F.col("rate")) * F.log((1 - F.col("rate")) / (1 - share))).otherwise(0.0)
    surprise = F.col("total") * (F.col("rate") * F.log(F.col("rate") / share) + rest)
    passed = counted.where(surprise > needed).join(words, "term", "left")
    passed = passed.select("term", F.coalesce(2 * F.col("whole") > F.col("hits"), F.lit(False)).alias("mostly"))
    passed = stage(passed, "passed-terms")
    rows = train.where("toxic = 1").select(F.xxhash64("text").alias("doc"), "text")
    # Equal texts have one number, so copies count once; the planner broadcasts the terms if their table is small.
    found = stage(_document_terms(rows).join(passed, "term").distinct(), "toxic-documents")
    family = F.coalesce("component", "doc")
    reach = found.join(_families(rows), F.col("doc") == F.col("id"), "left").groupBy("term", "mostly")
    reach = reach.agg(F.count_distinct(family).alias("n")).where(F.col("n") >= math.ceil(needed / -math.log(share)))
    return {r["term"]: r["mostly"] for r in _longest(stage(reach, "lexicon-reach")).toLocalIterator()}


def _longest(reach: DataFrame) -> DataFrame:
    """(term, mostly): of each shortest term and those that begin with it and have nearly its reach, the longest.

    ``reach`` has term, mostly and n.  Beginnings end at ``LONGEST``
    characters, so a longer word is looked up by these and as a whole.
    """
    length = F.char_length("term")
    cuts = F.concat(F.sequence(F.lit(SHORTEST), F.least(length, F.lit(LONGEST))), F.array(length))
    begins = reach.withColumn("cut", F.explode(F.array_distinct(cuts)))
    begins = begins.select("term", "mostly", "n", F.expr("left(term, cut)").alias("root"))
    known = reach.select(F.col("term").alias("root"), F.col("n").alias("most"))
    shortest = F.min(F.struct(F.char_length("root").alias("length"), "root", "most"))
    own = begins.join(known, "root").groupBy("term", "mostly", "n").agg(shortest.alias("r"))
    same = own.where(F.col("n") >= 0.95 * F.col("r.most")).groupBy("r.root")
    return same.agg(F.max(F.struct(length.alias("length"), "term", "mostly")).alias("t")).select("t.term", "t.mostly")


def _document_terms(rows: DataFrame) -> DataFrame:
    """(doc, term) of each (doc, text): every beginning and long word, a few rows of texts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("toxicity", dict)
        for batch in chain.from_iterable(row_slices(b, 50) for b in batches):
            found = [[t for t in _terms(text) if not t.endswith(WHOLE)] for text in batch.column(1).to_pylist()]
            docs = np.repeat(batch.column(0).to_numpy(), [len(x) for x in found])
            terms = pa.array(list(chain.from_iterable(found)), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), terms], names=["doc", "term"])

    return rows.mapInArrow(run, "doc long, term string")


#: Keys of a text, each of several minima over its word triples.  Texts that share 0.8 of their
#: triples share a key with probability 0.985; among 10^9 unlike texts hardly two do.
KEYS, MINIMA = 8, 4


def _families(rows: DataFrame) -> DataFrame:
    """(id, component) of the (doc, text) rows that are near copies of others.

    A toxic text's other words, repeated by its copies, are no evidence of
    their own, so a family of near copies counts once.
    """
    seeds = kernels.mix(np.arange(1, KEYS * MINIMA + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("toxicity", dict)
        for batch in chain.from_iterable(map(row_slices, batches)):
            docs = batch.column(0).to_numpy()
            for first, last, data, ends in kernels.batches(batch.column(1).to_pylist()):
                value, owner = kernels.shingles(*kernels.words(data, ends), last - first, 3)
                count = np.bincount(owner, minlength=last - first)
                full = np.flatnonzero(count)
                if not len(full):
                    continue
                starts = (np.cumsum(count) - count)[full]
                out = []
                for at in range(0, len(seeds), MINIMA):
                    key = np.full(len(full), at, np.uint64)
                    for seed in seeds[at : at + MINIMA]:
                        low = np.minimum.reduceat(kernels.mix(value ^ seed), starts)
                        key = kernels.mix(key * np.uint64(kernels.BASE) + low)
                    out.append(key)
                columns = [pa.array(np.tile(docs[first + full], KEYS)), pa.array(np.concatenate(out).view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "key"])

    keys = stage(rows.mapInArrow(run, "doc long, key long").distinct(), "toxic-keys")
    low = keys.groupBy("key").agg(F.min("doc").alias("a"), F.count("*").alias("c")).where("c > 1")
    return components(keys.join(low, "key").select("a", F.col("doc").alias("b")), "toxic-families")


def _hits(text: str, trie: FuzzyTrie, memo: dict[str, int], ordinary: frozenset[str]) -> list[tuple[int, str, int]]:
    """(position, plain word, kind) of each match in the text, and its words."""
    found = []
    words = words_of(text)
    for at, word in enumerate(words):
        kind = memo.get(word)
        if kind is None:
            kind = trie.match(plain(word))
            if len(memo) > 300_000:
                memo.clear()
            memo[word] = kind
        if kind and not (kind == 1 and plain(word) in ordinary):
            found.append((at, plain(word), kind))
    return found


def quoted(words: list[str], at: int, window: int = WINDOW) -> bool:
    """Whether a word is quoted: marks open before and close after it, or a word of reporting stands near."""
    before, after = words[max(0, at - window) : at], words[at + 1 : at + 1 + window]
    opened = words[at][:1] in _OPENING or any(w[:1] in _OPENING for w in before)
    closed = any(c in _CLOSING for c in words[at][-2:]) or any(w.rstrip(".,;:!?")[-1:] in _CLOSING for w in after)
    return (opened and closed) or any(plain(w) in REPORTING for w in before + after)


def text_features(text: str, trie: FuzzyTrie, memo: dict[str, int], ordinary: frozenset[str]) -> list[float]:
    """log1p of the weighed matches, of the misspelt and of the quoted ones, and abuse per word.

    A misspelt match weighs a third of an exact one, a quoted match a quarter;
    the other features let the training rows correct that.
    """
    found = _hits(text, trie, memo, ordinary)
    if not found:
        return [0.0, 0.0, 0.0, 0.0]
    words = words_of(text)
    exact = fuzzy = quotes = 0
    for at, _, kind in found:
        if quoted(words, at):
            quotes += 1
        elif kind == 2:
            exact += 1
        else:
            fuzzy += 1
    weighed = exact + fuzzy / 3 + quotes / 4
    return [math.log1p(weighed), math.log1p(fuzzy), math.log1p(quotes), (exact + fuzzy) / len(words)]


def _ordinary(train: DataFrame, model) -> frozenset[str]:
    """Misspelt forms whose share of toxic training rows is below that of terms.

    Their number is bounded by the lexicon's one-edit forms.  Forms without a
    training row are not among them.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("toxicity", dict)
        trie, memo, toxic, rows = FuzzyTrie(model.value), {}, Counter(), Counter()
        for batch in chain.from_iterable(map(row_slices, batches)):
            for mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                forms = {word for _, word, kind in _hits(text, trie, memo, frozenset()) if kind == 1}
                rows.update(forms)
                if mark == 1:
                    toxic.update(forms)
        counts = [pa.array([x[w] for w in rows], pa.int64()) for x in (toxic, rows)]
        yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.string()), *counts], names=["word", "toxic", "n"])

    found = train.select("toxic", "text").mapInArrow(find, "word string, toxic long, n long")
    found = found.groupBy("word").agg((F.sum("toxic") / F.sum("n")).alias("rate"))
    base = train.agg(F.avg("toxic")).first()[0]
    return frozenset(r["word"] for r in found.where(F.col("rate") < max(PRECISION, base)).toLocalIterator())


def _features(rows: DataFrame, model, ordinary, keep: str) -> DataFrame:
    """Column ``keep`` and the features of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("toxicity", dict)
        trie, memo = FuzzyTrie(model.value), {}
        for batch in chain.from_iterable(map(row_slices, batches)):
            x = [text_features(t or "", trie, memo, ordinary.value) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=[keep, "features"]
            )

    kind = dict(rows.dtypes)[keep]
    return rows.select(keep, "text").mapInArrow(run, f"{keep} {kind}, features array<double>")


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, steps: int = 50) -> np.ndarray:
    """Weights (the last one the intercept) by Newton steps with a ridge penalty."""
    a = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([penalty] * x.shape[1] + [1e-6])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - y) + ridge @ w
        hessian = (a * (p * (1 - p))[:, None]).T @ a + ridge + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row.

    Null and empty texts score as texts without a match.  A document with
    several labels is toxic if one of them says so; null labels are left out.
    Without labels of both kinds every score is 0.  Rows that repeat score
    alike.  Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    train = stage(_labelled(docs, labels, id_col, text_col), "toxicity-train")
    lexicon = learn_lexicon(train)
    model = spark.sparkContext.broadcast(lexicon)
    ordinary = spark.sparkContext.broadcast(_ordinary(train, model) if lexicon else frozenset())
    weights = None
    if lexicon:
        rows = _features(_sampled(train, train.count(), fit_rows), model, ordinary, "toxic").toLocalIterator()
        y, x = zip(*((r["toxic"], r["features"]) for r in rows), strict=True)
        weights = fit_logistic(np.array(x), np.array(y, float))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = _features(rows, model, ordinary, "id")
    score = F.lit(0.0)
    if weights is not None:
        line = sum((F.col("features")[k] * float(w) for k, w in enumerate(weights[:-1])), F.lit(float(weights[-1])))
        score = 1 / (1 + F.exp(-line))
    found = found.withColumn("score", score)
    return found.select(
        F.col("id").alias(id_col),
        held_out_of(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose documents score below one half, with all their columns."""
    scored = score_toxicity(docs, labels, id_col, text_col)
    (key,) = free_names(docs, "__id")
    toxic = stage(scored.where("predicted = 1").select(F.col(id_col).alias(key)).distinct(), "toxic-ids")
    return docs.join(toxic, F.col(id_col).eqNullSafe(F.col(key)), "left_anti")


def op10_toxicity(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))

"""Token counts of whole texts; huge documents as overlapping chunks, spliced where chunks agree.

Texts of up to ``step + overlap`` characters are encoded as they are.  A longer
one is cut into chunks that start every ``step`` characters and run ``overlap``
characters into the next; chunks are rows of their own, so one document is
encoded by many tasks.  Each chunk reports where pre-tokens begin in the zones
it shares with its neighbours, from the offsets of its tokens, and how many
tokens lie before each such place.

Why a splice is right: the library finds special strings and pre-tokens from
left to right, no pattern looks behind, and no merge crosses a pre-token.  So
what follows a pre-token's beginning depends on the text from there on only,
and two scans that begin a pre-token at one place agree from there.  The first
chunk scans truly; a true chunk's beginnings hold in the whole text unless they
lie within ``margin`` characters of its cut end, the farthest that a pattern or
a special string reaches past them.  The first stable beginning that both
chunks of a joint report makes the next chunk true from there.  Where a joint
has none (a run longer than the overlap), the document is cut again with
overlaps ``widen`` times as wide, at last as a whole.

``provable`` names the tokenizer files this reasoning covers; documents are
encoded whole with any other.

The same reasoning serves short texts: where white space follows something
else, a pre-token begins whatever stands around.  A text is the sum of the
segments between such places, and a worker encodes each segment it has not met
once, many of them joined into one text and told apart by offsets.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aqarlens.llm.common import stage, worker_state

STEP = 32_768
OVERLAP = 256
WIDEN = 8
LIMIT = 1_024
#: Characters of texts that are encoded in one call of the library.
CALL = 1 << 20
#: Segments that a worker remembers, in each of two generations; longer ones than KEPT characters it does not.
MEMO = 200_000
KEPT = 64
#: Segments that are joined into one text.
JOINED = 512
#: Python's white space holds the library's, so both see something else before these four and white space after.
BLANKS = frozenset(" \t\n\r")
SEGMENTS = re.compile(r"(?<=\S)(?=[ \t\n\r])").split
#: The longest look-ahead of the pattern beyond a pre-token's first character: a three-letter contraction.
REACH = 3


def _overlaps(one: str, other: str) -> bool:
    """Whether a proper end of ``one`` begins ``other``."""
    return any(other.startswith(one[at:]) for at in range(1, len(one)))


def provable(source: str) -> int | None:
    """The margin in characters within which a cut end can change pre-tokens; None where no proof holds.

    Asked of a tokenizer file's text: byte-level BPE with its own pattern, no
    normalisation, prefix space, dropout or post-processing, and special strings
    that are taken as they stand and cannot overlap each other.
    """
    held = json.loads(source)
    model, cut = held["model"], held.get("pre_tokenizer") or {}
    added = held.get("added_tokens") or []
    plain = (
        model.get("type") == "BPE"
        and not model.get("dropout")
        and cut.get("type") == "ByteLevel"
        and cut.get("use_regex", True)
        and not cut.get("add_prefix_space")
        and not held.get("normalizer")
        and not held.get("post_processor")
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
    )
    special = [t["content"] for t in added]
    if not plain or any(_overlaps(a, b) for a in special for b in special):
        return None
    return REACH + max([1, *map(len, special)])


def _loaded(source: str):
    """The library's tokenizer of a file's text, in one thread, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(source)
    made.no_truncation()
    made.no_padding()
    return made


def _calls(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about ``CALL`` characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= CALL:
            yield held
            held, size = [], 0
    if held:
        yield held


class SegmentCounts:
    """Token counts of texts from those of their segments, of which the last met are remembered."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.new: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def _counted(self, segments: list[str]) -> list[int]:
        """Tokens of segments; those that begin with white space keep their pre-tokens when joined."""
        counts = []
        for at in range(0, len(segments), JOINED):
            part = segments[at : at + JOINED]
            encoded = self.tokenizer.encode("".join(part), add_special_tokens=False)
            places = np.array([place for place, _ in encoded.offsets], np.int64)
            ends = np.cumsum([0, *map(len, part)])
            counts += np.diff(np.searchsorted(places, ends)).tolist()
        return counts

    def __call__(self, texts: list[str]) -> list[int]:
        split = list(map(SEGMENTS, texts))
        here = {}
        for segment in set().union(*split):
            known = self.new.get(segment)
            here[segment] = self.old.get(segment) if known is None else known
        missing = [s for s, n in here.items() if n is None]
        joined = [s for s in missing if s[:1] in BLANKS]
        here.update(zip(joined, self._counted(joined), strict=True))
        first = [s for s in missing if s[:1] not in BLANKS]
        alone = self.tokenizer.encode_batch_fast(first, add_special_tokens=False)
        here.update(zip(first, map(len, alone), strict=True))
        if len(self.new) + len(here) > MEMO:
            self.old, self.new = self.new, {}
        self.new.update((s, n) for s, n in here.items() if len(s) <= KEPT)
        return [sum(map(here.__getitem__, segments)) for segments in split]


def _whole(docs: DataFrame, name: str, source, segments: bool) -> DataFrame:
    """(id, n_bytes, n_tokens) of texts that are not cut, by their segments if these are proven to add up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_segment = worker_state(name, lambda: SegmentCounts(_loaded(source.value)))
        tokenizer = by_segment.tokenizer
        for batch in batches:
            counts = []
            for texts in _calls(batch.column(2).to_pylist()):
                if segments:
                    counts += by_segment(texts)
                else:
                    counts += map(len, tokenizer.encode_batch_fast(texts, add_special_tokens=False))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"]
            )

    return docs.mapInArrow(run, "id long, n_bytes long, n_tokens long")


def cut(texts: DataFrame, step: int, overlap: int) -> DataFrame:
    """(digest, k, last, piece) of (digest, text): chunk k starts at character ``k * step``; equal texts are cut once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                n = max(1, -(-(len(text) - overlap) // step))
                for low in range(0, n, 64):
                    ks = range(low, min(low + 64, n))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "digest": [digest] * len(ks),
                            "k": pa.array(ks, pa.int32()),
                            "last": [k == n - 1 for k in ks],
                            "piece": [text[k * step : (k + 1) * step + overlap] for k in ks],
                        }
                    )

    return texts.mapInArrow(run, "digest string, k int, last boolean, piece string").dropDuplicates(["digest", "k"])


def _zones(chunks: DataFrame, name: str, source, step: int, overlap: int, margin: int) -> DataFrame:
    """Per chunk its tokens, and place and tokens before it of the pre-tokens that begin in its two zones.

    Places count from the beginning of the zone: that of chunk k's tail is
    the head of chunk k + 1.
    """

    def starts(encoded, low: int, high: int) -> tuple[list[int], list[int]]:
        words = np.array(encoded.word_ids, np.int64)
        first = np.flatnonzero(np.diff(words, prepend=-1))
        places = np.array([at for at, _ in encoded.offsets], np.int64)[first]
        inside = (places >= low) & (places < high)
        return (places[inside] - low).tolist(), first[inside].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_state(name, lambda: SegmentCounts(_loaded(source.value))).tokenizer.encode_batch
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                part = batch.slice(at, 16)
                pieces = part.column(3).to_pylist()
                done = encode(pieces, add_special_tokens=False)
                heads = [starts(e, 0, overlap) for e in done]
                tails = [starts(e, step, len(p) - margin + 1) for e, p in zip(done, pieces, strict=True)]
                lists = [[places for places, _ in heads], [n for _, n in heads], [places for places, _ in tails], [n for _, n in tails]]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(map(len, done), pa.int64()), *[pa.array(x, pa.list_(pa.int64())) for x in lists]],
                    names=["digest", "k", "last", "total", "head", "head_n", "tail", "tail_n"],
                )

    ints = "array<long>"
    schema = f"digest string, k int, last boolean, total long, head {ints}, head_n {ints}, tail {ints}, tail_n {ints}"
    return chunks.mapInArrow(run, schema)


def splice(zones: DataFrame) -> DataFrame:
    """(digest, n_tokens) from chunks' zones; n_tokens null where a joint has no common stable beginning.

    A text's tokens are the last chunk's, plus for every joint the tokens of
    its left chunk before the common place less those of its right chunk.
    """
    left = zones.where("not last").select("digest", (F.col("k") + 1).alias("k"), F.col("tail").alias("ends"), F.col("tail_n").alias("ends_n"))
    joint = zones.join(left, ["digest", "k"], "left")
    joint = joint.withColumn("at", F.array_min(F.array_intersect("head", "ends")))
    before = F.expr("ends_n[cast(array_position(ends, at) as int) - 1]") - F.expr("head_n[cast(array_position(head, at) as int) - 1]")
    joint = joint.select(
        "digest",
        F.when(F.col("last"), F.col("total")).alias("total"),
        F.when(F.col("at").isNotNull(), before).alias("moved"),
        ((F.col("k") > 0) & F.col("at").isNull()).alias("open"),
    )
    found = joint.groupBy("digest").agg(
        F.max("total").alias("total"), F.sum("moved").alias("moved"), F.max("open").alias("open")
    )
    tokens = F.when(~F.col("open"), F.col("total") + F.coalesce("moved", F.lit(0)))
    return found.select("digest", tokens.alias("n_tokens"))


def huge_counts(texts: DataFrame, name: str, source, margin: int, step: int, overlap: int, widen: int) -> DataFrame:
    """(digest, n_tokens) of each different one of the huge texts (digest, text)."""
    done = None
    while True:
        zones = stage(_zones(cut(texts, step, overlap), name, source, step, overlap, margin), "chunk-zones")
        counts = stage(splice(zones), "spliced")
        solved = counts.where("n_tokens is not null")
        done = solved if done is None else done.unionByName(solved)
        unsolved = counts.where("n_tokens is null").select("digest")
        if unsolved.isEmpty():
            return done
        texts = texts.join(unsolved, "digest", "left_semi")
        overlap *= widen


def token_counts(
    docs: DataFrame,
    vocabulary: str,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
    step: int = STEP,
    overlap: int = OVERLAP,
    widen: int = WIDEN,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row, as the library counts for the tokenizer file ``vocabulary``.

    Null text counts as empty: no bytes, no tokens.  Special strings inside
    texts count as the library's default has it.  Every row gives a row, null
    and repeated ids included; equal huge texts are encoded once.  Other
    columns are not read; an empty table gives an empty result.
    """
    with open(vocabulary, encoding="utf-8") as file:
        text = file.read()
    margin = provable(text)
    source = docs.sparkSession.sparkContext.broadcast(text)
    name = uuid.uuid4().hex
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.octet_length(body).cast("long").alias("n_bytes"), body.alias("body"))
    if margin is None:
        counted = _whole(rows, name, source, False)
    else:
        huge = F.char_length("body") > step + overlap
        texts = rows.where(huge).select(F.sha2("body", 256).alias("digest"), "body")
        counts = huge_counts(texts, name, source, margin, step, overlap, widen)
        long = rows.where(huge).select("id", "n_bytes", F.sha2("body", 256).alias("digest")).join(counts, "digest")
        counted = _whole(rows.where(~huge), name, source, True).unionByName(long.select("id", "n_bytes", "n_tokens"))
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op12_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts(docs, vocabulary or public_tokenizers.path("byte_bpe_50k.json"))

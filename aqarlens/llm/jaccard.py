"""N-gram Jaccard join: grouped prefixes, stars first, then what stars leave open.

Documents become sets of distinct word shingles (64-bit fingerprints).  Two
documents link when ``100 * |x ∩ y| >= percent * |x ∪ y|``.

1. Equal texts are collapsed to one representative by digest.  Texts move in
   one shuffle, by chunk, which the steps share.
2. Chunks of documents send their distinct shingles to shards, which answer
   with those that occur in two documents or more.  A shingle of one document
   cannot link anything, so only shared ones are kept, in order of rising
   document frequency.  A document whose prefix has no shared shingle is done.
3. Documents with the same size and the same shared prefix form one group, and
   an inverted index holds groups, not documents.
4. Stars: in every index entry each group is compared with the entry's least
   edited group, in every group each member with the first one.  Verified links
   give components; a large family of near copies is joined this way with a
   number of comparisons in proportion to its members.  Entries that stay open
   get further stars around other sets while that shortens the next step.
5. The rest: groups that share an index entry but lie in different components
   are paired, pairs that fail the size or position filter go, and all members
   of the others are compared.  Pairs within a component cannot change it.

Only components are made, so no step lists the pairs of a group.  Hot index
entries and hot representatives are skewed join keys, which AQE splits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aqarlens.llm import exchange, kernels
from aqarlens.llm.common import chunk_count, components, free_names, stage, text_bytes
from aqarlens.llm.exchange import distinct_texts, pick

#: Further stars around each open index entry, in each round.
STARS = 3

SHARED = "digest binary, id long, n long, unique_n long, reach int, shared array<long>"


def _sets(texts: pa.Table, size: int):
    """(first row, end row, shingle, row number) of runs of rows."""
    for first, last, data, ends in kernels.batches(texts.column("text").to_pylist()):
        hashes, doc = kernels.words(data, ends)
        yield first, last, *kernels.shingles(hashes, doc, last - first, size)


def shared_shingles(
    dealt: DataFrame, chosen: DataFrame, chunks: int, width: int = 8, percent: int = 80, size: int = 5
) -> DataFrame:
    """Per different text: set size, shared shingles by rising frequency, and how many begin its prefix.

    Shingles travel to shards by their first ``width`` bytes; two that agree
    in these pass for shared, which costs comparisons and no link.
    """

    def send(rows: pa.Table, side: pa.Table) -> pa.Table:
        number = side.column("chunk")[0].as_py() if side.num_rows else -1
        parts = [exchange.shorten(value, width) for _, _, value, _ in _sets(pick(rows, side)[0], size)]
        if not parts:
            return exchange.EMPTY
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        return exchange.pack(number, keys, np.minimum(counts, 65535).astype(np.uint16), chunks, width)

    def answer(chunk, keys, counts):
        _, inverse = np.unique(keys, return_inverse=True)
        total = np.bincount(inverse, weights=counts)[inverse]
        common = total > 1
        return chunk[common], keys[common], total[common].astype(np.uint32)

    def order(rows: pa.Table, side: pa.Table) -> pa.Table:
        texts, answers = pick(rows, side)
        known, frequency = exchange.answers_of(answers, np.uint32, width)
        n, unique_n, reach, shared = [], [], [], []
        for first, last, value, owner in _sets(texts, size):
            hit, at = exchange.find(known, exchange.shorten(value, width))
            sizes = np.bincount(owner, minlength=last - first)
            value, owner, rank = value[hit], owner[hit], frequency[at[hit]]
            by = np.lexsort((value, rank, owner))
            value = value[by].view(np.int64)
            kept = np.bincount(owner, minlength=last - first)
            end = np.cumsum(kept)
            alone = sizes - kept
            begin = np.clip(np.where(sizes > 0, sizes - -(-percent * sizes // 100) + 1 - alone, 0), 0, kept)
            n.append(sizes)
            unique_n.append(alone)
            reach.append(begin)
            # Sets without a shared shingle in their prefix can't link: nothing of them is sent on.
            shared += [value[end[k] - kept[k] : end[k]] if begin[k] else value[:0] for k in range(last - first)]
        flat = pa.array(np.concatenate(shared) if shared else np.zeros(0, np.int64), pa.int64())
        ends = pa.array(np.cumsum([0, *map(len, shared)], dtype=np.int32))
        n, unique_n, reach = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (n, unique_n, reach))
        return pa.table(
            {
                "digest": texts.column("digest"),
                "id": texts.column("id"),
                "n": pa.array(n, pa.int64()),
                "unique_n": pa.array(unique_n, pa.int64()),
                "reach": pa.array(reach.astype(np.int32)),
                "shared": pa.ListArray.from_arrays(ends, flat),
            }
        )

    by_chunk = dealt.groupBy("chunk")
    packed = by_chunk.cogroup(chosen.groupBy("chunk")).applyInArrow(send, exchange.PACKED)
    answers = exchange.merged(packed, chunks, np.uint16, answer, width)
    side = chosen.union(answers).repartition(chunks, "chunk").groupBy("chunk")
    return by_chunk.cogroup(side).applyInArrow(order, SHARED)


def _similar_sizes(a: str, b: str, percent: int) -> Column:
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ids whose sets are similar enough, by exact intersection."""
    x = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("s_a"))
    y = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("s_b"))
    both = pairs.join(x, "a").join(y, "b").withColumn("common", F.size(F.array_intersect("s_a", "s_b")))
    return both.where(f"100 * common >= {percent} * (n_a + n_b - common)").select("a", "b")


def similar_components(texts: DataFrame, percent: int = 80) -> DataFrame:
    """(id, component) of the texts of ``shared_shingles`` that link with another."""
    sets = texts.where("id is not null and reach > 0")
    # A group: one size, one prefix. Its first member stands for it in the index.
    prefixes = sets.select("id", "n", "unique_n", F.slice("shared", F.lit(1), F.col("reach")).alias("prefix"))
    groups = prefixes.groupBy("n", "unique_n", "prefix").agg(F.min("id").alias("unit"))
    members = stage(prefixes.join(groups, ["n", "unique_n", "prefix"]), "groups")

    # Stars within groups, and within each index entry's size band around its least edited set.
    index = _index(members, percent)
    first = index.groupBy("token", "band").agg(F.min(F.struct("unique_n", "unit", "n", "left")).alias("f"), F.count("*").alias("c"))
    star = index.join(first.where("c > 1"), ["token", "band"]).where("unit <> f.unit")
    star = star.where(_position("n", "left", "f.n", "f.left", percent))
    star = star.select(F.col("unit").alias("a"), F.col("f.unit").alias("b"))
    inner = members.where("id <> unit").select(F.col("id").alias("a"), F.col("unit").alias("b"))
    links = stage(_verified(star.union(inner).distinct(), sets, percent), "star-links")

    # Members not linked with their group's first one stand for themselves from here on.
    loose = inner.join(links, ["a", "b"], "left_anti").select(F.col("a").alias("id"))
    own = members.join(loose.withColumn("alone", F.lit(True)), "id", "left")
    own = own.withColumn("unit", F.when(F.col("alone"), F.col("id")).otherwise(F.col("unit"))).drop("alone")
    own = stage(own, "units")
    index = _index(own, percent)
    parts, before, round_ = components(links, "star-components"), None, 0
    while True:
        rows = stage(_open_entries(index, parts), "open-entries")
        sizes = rows.groupBy("token", "band").agg(F.count_if(F.col("part") != F.col("major")).alias("m"), F.count("*").alias("c"))
        entries, pairs = sizes.agg(F.sum("c"), F.sum(F.expr("m * c"))).first()
        # More stars as long as pairing what is open costs much more than they do, and they help.
        if not entries or pairs <= 4 * entries or (before is not None and pairs > 0.75 * before):
            break
        before, round_ = pairs, round_ + 1
        more = stage(_verified(_star_pairs(rows, round_, percent), sets, percent), "more-links")
        links = links.union(more)
        parts = components(links, "star-components")
    # Entries with several components: all units outside the largest one against all units.
    minor = rows.where("part <> major").select(
        "token",
        F.explode(F.array(*(F.col("band") + k for k in (-1, 0, 1)))).alias("band"),
        F.col("unit").alias("u"),
        F.col("part").alias("u_part"),
        F.col("n").alias("u_n"),
        F.col("left").alias("u_left"),
    )
    pairs = minor.join(rows, ["token", "band"]).where("part <> u_part")
    # Of two units outside the largest component, one order is enough.
    pairs = pairs.where("part = major or u < unit").where(_position("n", "left", "u_n", "u_left", percent))
    pairs = pairs.select("u", F.col("unit").alias("v")).distinct()
    of = own.select(F.col("unit").alias("u"), F.col("id").alias("a"))
    pairs = pairs.join(of, "u").join(of.select(F.col("u").alias("v"), F.col("a").alias("b")), "v")
    late = stage(_verified(pairs.select("a", "b").distinct(), sets, percent), "late-links")
    return components(links.union(late))


def _index(members: DataFrame, percent: int) -> DataFrame:
    """(token, band, unit, n, unique_n, left): a row per unit and shingle of its shared prefix.

    Sets of one link lie in one size band or in adjoining ones.
    """
    band = F.floor(F.log("n") / np.log(100 / percent)).cast("int")
    rows = members.where("id = unit").select("unit", "n", "unique_n", band.alias("band"), F.posexplode("prefix").alias("at", "token"))
    left = F.col("n") - F.col("unique_n") - F.col("at")
    return rows.select("token", "band", "unit", "n", "unique_n", left.alias("left"))


def _open_entries(index: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows of entries that hold several components, with ``part`` and the entry's largest, ``major``."""
    rows = index.join(parts.withColumnRenamed("id", "unit"), "unit", "left")
    rows = rows.withColumn("part", F.coalesce("component", "unit")).drop("component")
    shares = rows.groupBy("token", "part").count()
    several = shares.groupBy("token").agg(
        F.max(F.struct("count", "part")).getField("part").alias("major"), F.count("*").alias("parts")
    )
    return rows.join(several.where("parts > 1").drop("parts"), "token")


def _star_pairs(rows: DataFrame, round_: int, percent: int) -> DataFrame:
    """Open units with a few others of their entry.

    Units outside the entry's largest component meet its least edited one and
    ``STARS`` more inside it, wherever the entry stands in their prefixes, and
    every unit meets the least edited one outside.
    """

    def centre(order, inside):
        named = F.struct(order.alias("o"), F.col("unit").alias("u"), F.col("part").alias("p"), F.col("n").alias("m"), F.col("left").alias("l"))
        return F.min(F.when((F.col("part") == F.col("major")) == inside, named))

    chance = [centre(F.xxhash64(F.lit(f"{round_}/{k}"), F.col("unit")), True) for k in range(STARS)]
    centres = rows.groupBy("token", "band").agg(
        F.array_compact(F.array(centre(F.col("unique_n"), True), *chance)).alias("inside"),
        centre(F.col("unique_n"), False).alias("c"),
    )
    inner = rows.where("part <> major").join(centres.select("token", "band", F.inline("inside")), ["token", "band"])
    outer = rows.join(centres.select("token", "band", "c.*"), ["token", "band"])
    outer = outer.where("part <> p").where(_position("n", "left", "m", "l", percent))
    pairs = inner.where(_similar_sizes("n", "m", percent)).unionByName(outer)
    return pairs.select(F.col("unit").alias("a"), F.col("u").alias("b")).distinct()


def _position(n: str, left: str, m: str, m_left: str, percent: int) -> Column:
    """Sizes agree, and the shared shingles from this one on can still make a link.

    ``left`` counts a set's shared shingles from this one to its last.  Holds
    for a pair's first common shingle if the pair links.
    """
    reach = F.expr(f"least({left}, {m_left})")
    return _similar_sizes(n, m, percent) & (reach * (100 + percent) >= percent * (F.expr(f"{n} + {m}")))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, size: int = 5
) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row, by links of Jaccard similarity.

    Null and empty texts have an empty set and link with nothing.  Rows
    without an id get their set size and a null component and link nothing.
    Rows that repeat an id and text give equal results.  If an id occurs with
    several texts, all its rows get the component of its linked texts.  Other
    columns, whatever their names, are not read.  An empty table gives an
    empty result.
    """
    total = text_bytes(docs, text_col)
    chunks = chunk_count(total)
    keys, dealt, chosen = distinct_texts(docs, id_col, text_col, chunks)
    sets = stage(shared_shingles(dealt, chosen, chunks, exchange.key_bytes(total), percent, size), "shingles")
    parts = similar_components(sets, percent)
    # Equal texts link with each other unless they are empty.
    first = sets.where("id is not null").join(parts, "id", "left")
    first = first.select("digest", "n", F.coalesce("component", "id").alias("component")).unionByName(
        sets.where("id is null").select("digest", "n", F.lit(None).cast("long").alias("component"))
    )
    own = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component"))
    return keys.join(first, "digest", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), own).alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, with all their columns; rows without id stay."""
    found = near_duplicates(docs, id_col, text_col, percent)
    gone = found.where(F.col(id_col) != F.col("component_id"))
    (key,) = free_names(docs, "__id")
    gone = gone.select(F.col(id_col).alias(key)).distinct()
    return docs.join(gone, F.col(id_col) == F.col(key), "left_anti")


def op7_ngram_jaccard(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))

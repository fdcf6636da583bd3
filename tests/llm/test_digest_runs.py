from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from aqarlens.llm.digest_runs import KEY, digest_rows, drop_copies, exact_groups, in_order, merge_runs
from pyspark.sql import functions as F

from brute import SPACE


def test_groups_match_brute_force(docs):
    rows = [(r.doc_id, re.sub(SPACE, " ", r.text or "")) for r in docs.collect()]
    ids = defaultdict(list)
    for k, t in rows:
        ids[t].append(k)
    want = []
    for k, t in rows:
        known = [i for i in ids[t] if i is not None]
        keep = min(known) if known else None
        want.append((k, keep, len(ids[t]), k == keep, hashlib.sha256(t.encode()).hexdigest()))
    for bits in (1, 3):
        got = [tuple(r) for r in exact_groups(docs, bits=bits).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_one_row_of_each_text_stays(docs):
    left = drop_copies(docs)
    assert left.columns == docs.columns
    texts = [re.sub(SPACE, " ", r.text or "") for r in left.collect()]
    assert sorted(texts) == sorted({re.sub(SPACE, " ", r.text or "") for r in docs.collect()})
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == [1, 4, 5, 7, 8, 9, 10, 11, 12, 13, 14, 15]


def test_empty(no_docs):
    assert exact_groups(no_docs).count() == 0 and drop_copies(no_docs).count() == 0


def test_runs_are_in_order(docs):
    """Each part of a run holds its keys in ascending order and no other run's rows stand between them."""
    runs = digest_rows(docs).withColumn("keep_id", F.col("id")).withColumn("run", F.col("run") % 2)
    placed = in_order(runs, 6).withColumn("task", F.spark_partition_id()).collect()
    parts = defaultdict(list)
    for r in placed:
        assert r.part == int.from_bytes(r.digest[:3]) * 6 >> 24
        parts[r.run, r.part].append((r.task, bytes(r.digest), r.keep_id is None, r.keep_id or 0))
    assert len(placed) == docs.count() and len(parts) > 6
    for rows in parts.values():
        assert len({task for task, *_ in rows}) == 1 and rows == sorted(rows)


def test_merges_follow_the_order(docs):
    """Above the first runs a merge is a window over sorted parts: no further shuffle, sort or grouping."""
    rows = digest_rows(docs.repartition(20))
    plan = merge_runs(rows, bits=1)._jdf.queryExecution().sparkPlan().toString()
    rounds = plan.count("RepartitionByExpression") or plan.count("REPARTITION_BY_COL")
    assert rounds == 5 and plan.count("Window ") == 5 and plan.count("HashAggregate") <= 2
    got = {bytes(r.digest): (r.keep_id, r.group_size) for r in merge_runs(rows, bits=1).collect()}
    want = rows.groupBy(*KEY).agg(F.min("id").alias("k"), F.count("*").alias("n")).collect()
    assert got == {bytes(r.digest): (r.k, r.n) for r in want}


def test_native(docs):
    plan = exact_groups(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)

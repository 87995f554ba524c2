import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from prosemill.llm.exact_dedup import dedup_report, exact_groups, without_copies
from tests.conftest import rows
from tests.llm.common import AWKWARD, awkward, empty


def brute(pairs):
    groups = defaultdict(list)
    for doc_id, text in pairs:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), digest) for i in ids]
    return sorted(out, key=str)


def test_awkward_rows(spark):
    got = rows(dedup_report(awkward(spark)), "doc_id", "keep_id", "group_size", "text_sha256")
    assert sorted(got, key=str) == brute(AWKWARD)
    kept = dedup_report(awkward(spark)).where("kept")
    assert kept.count() == len({t or "" for _, t in AWKWARD}) and kept.where("doc_id = keep_id OR keep_id IS NULL").count() == kept.count()
    stay = without_copies(awkward(spark))
    assert stay.columns == awkward(spark).columns and stay.count() == kept.count()
    assert dedup_report(empty(spark)).count() == 0


@pytest.mark.parametrize("weak", [lambda t: F.lit(b"same"), lambda t: F.substring(t, 1, 1).cast("binary")])
def test_digests_that_collide_are_told_apart_by_bytes(spark, weak):
    pairs = [(i, f"{'ab'[i % 2]}{i % 7}") for i in range(60)] + [(99, None), (98, "")]
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    _, groups = exact_groups(df, weak)
    got = rows(groups, "doc_id", "keeper.doc_id", "group_size")
    assert sorted(map(tuple, got)) == sorted(r[:3] for r in brute(pairs))


def test_a_hot_text(spark):
    pairs = [(i, "hot" if i % 3 == 0 else f"text {i}") for i in range(6000)]
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(5)
    assert dedup_report(df).where("kept").count() == 4001
    assert rows(dedup_report(df).where("text_sha256 = sha2('hot', 256)").select("keep_id", "group_size").distinct()) == [(5997, 2000)]

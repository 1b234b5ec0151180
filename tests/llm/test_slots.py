import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from caprank.llm import slots
from caprank.llm.common import prepare, written
from helpers import TEXTS, docs, empty, with_nulls

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def s(spark):
    prepare(spark)
    return spark


def gapless(rows):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    return all(sorted(x) == list(range(len(x))) for x in by.values())


def test_table_is_whole_balanced_and_agrees_on_reruns(s):
    got = slots.op12_virtual_slots(s, SF).collect()
    rows = duckdb.sql(f"select doc_id, text from read_parquet('{SF}/documents.parquet')").fetchall()
    want = sorted((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert gapless(got) and {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    total = np.bincount([r["shard"] for r in got], weights=[r["size"] for r in got], minlength=24)
    assert len(total) == 24 and total.max() - total.min() <= 0.01 * total.mean()
    again = slots.op12_virtual_slots(s, SF).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    # a record's shard is that of its slot, nothing else
    assert len({(r["virtual_slot"], r["shard"]) for r in got}) == len({r["virtual_slot"] for r in got})


def test_result_does_not_follow_the_order_of_the_input(s):
    d = s.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    a, _ = slots.sharded(d)
    b, _ = slots.sharded(d.orderBy(F.desc("doc_id")).repartition(5))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_awkward_rows(s):
    frame = with_nulls(s)
    plan, _ = slots.sharded(frame, slots=64, shards=3)
    got = plan.collect()
    assert len(got) == len(TEXTS) + 4 and gapless(got)
    assert sum(r["doc_id"] is None for r in got) == 2
    assert [(r["size"], r["text_crc32"]) for r in got if r["doc_id"] == 2] == [(8, 0)]
    assert slots.sharded(empty(s))[0].count() == 0


def test_a_row_that_most_rows_repeat_is_spread(s):
    frame = docs(s, [(1, "copy " * 20, "en", "a")] * 3000 + [(i, "x" * (i % 97), "en", "b") for i in range(2, 1000)])
    recs = slots.records(frame, slots=128, copies=100)
    assert recs.count() == 3998 and recs.select("row_sha", "copy").distinct().count() == 3998
    plan, _ = slots.sharded(frame, slots=128, shards=8)
    total = np.zeros(8)
    for r in plan.collect():
        total[r["shard"]] += r["size"]
    assert total.max() - total.min() <= 0.02 * total.mean()


def test_map_versions_edits_and_growth(s):
    rng = np.random.default_rng(4)
    size = rng.integers(0, 5000, 4096)
    size[17] = 3 * size.sum() // 24  # one record larger than a fair share
    m = slots.SlotMap(4096, 24)
    assert m.version == 0 and (m.at() == np.arange(4096) % 24).all()
    assert m.rebalance(size) == 1
    total = np.bincount(m.at(), weights=size, minlength=24)
    rest = np.delete(total, m.at()[17])
    assert rest.max() - rest.min() <= 0.01 * rest.mean()
    assert m.rebalance(size) == 1 or m.version == 2  # nothing, or a little, is left to do
    before, v = m.at().copy(), m.version
    m.grow(size)
    moved = m.at() != before
    assert moved.any() and (m.at()[moved] == 24).all() and m.shards() == 25
    share = size.sum() / 25
    assert 0.9 * share <= size[m.at() == 24].sum() <= share
    assert (m.at(v) == before).all() and (m.at(0) == np.arange(4096) % 24).all()
    back = slots.SlotMap.load(s, m.save(s))
    assert back.edits == m.edits and (back.at() == m.at()).all() and back.version == m.version
    with pytest.raises(Exception, match="(?i)exist"):
        m.save(s, m.save(s))


def test_written_shards_hold_every_row_in_slot_order(s):
    frame = with_nulls(s).select("doc_id", "text", "lang")
    plan, _ = slots.sharded(frame, slots=64, shards=3)
    path = written(frame, "shards").inputFiles()[0].rsplit("/", 1)[0] + "-out"
    slots.write_shards(frame, written(plan, "plan"), path)
    got = s.read.parquet(path)
    assert got.select("doc_id", "text", "lang").exceptAll(frame).isEmpty() and got.count() == frame.count()
    assert gapless(got.collect())

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import oracle
from caprank.llm import merkle
from caprank.llm.common import prepare
from caprank.llm.positions import numbered
from helpers import TEXTS, docs, empty, with_nulls

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def s(spark):
    prepare(spark)
    return spark


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def low(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(leaves, fan=16):
    """(root, steps of each leaf) of one list of nodes."""
    at, steps, nodes = list(range(len(leaves))), [[] for _ in leaves], leaves
    while len(nodes) > 1:
        for i, p in enumerate(at):
            lo = p // fan * fan
            steps[i].append((p - lo, [x for k, x in enumerate(nodes[lo:lo + fan]) if k != p - lo]))
        nodes = [h("".join(nodes[lo:lo + fan])) for lo in range(0, len(nodes), fan)]
        at = [p // fan for p in at]
    return nodes[0], steps


def brute(rows, fan=16):
    """Sorted rows of the query from plain (doc_id, text, lang, source, n_chars)."""
    by: dict = {}
    for i, t, lang, source, n in rows:
        leaf = frame([i, source, lang, n, t])
        bad = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        by.setdefault(source, []).append((i is not None, i or 0, leaf, frame([i, source, lang, n, low(t)]) if bad else leaf))
    names = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    subs, within = [], {}
    for name in names:
        by[name].sort(key=lambda r: r[:3])
        sub, within[name] = tree([r[2] for r in by[name]], fan)
        subs.append(sub)
    root, above = tree(subs, fan) if subs else (None, [])
    out = []
    for k, name in enumerate(names):
        for (known, i, leaf, found), steps in zip(by[name], within[name], strict=True):
            steps = steps + above[k]
            node = found
            for at, sib in steps:
                node = h("".join(sib[:at]) + node + "".join(sib[at:]))
            out.append((i if known else None, leaf, subs[k], root, h("".join("".join(x) for _, x in steps)), node, node == root))
    return sorted(out, key=str)


def made(frame, **kw):
    bad = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.manifest(frame, bad, {"text": F.translate("text", merkle.UPPER, merkle.LOWER)}, **kw)


def result(frame, **kw):
    got = made(frame, **kw).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(map(tuple, got.collect()), key=str)


def test_table_matches_plain_python_and_sql(s):
    rows = duckdb.sql(f"select doc_id, text, lang, source, n_chars from read_parquet('{SF}/documents.parquet')").fetchall()
    got = merkle.op11_merkle_manifest(s, SF)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    ok, msg = oracle.compare(got, oracle.duck(SF), merkle.ORACLE_SQL)
    assert ok, msg


def test_awkward_rows(s):
    frame = with_nulls(s)
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in frame.collect()]
    assert result(frame) == brute(rows)
    assert result(empty(s)) == []
    one = [TEXTS[0]]
    got = result(docs(s, one))
    assert got == brute([(i, t, lang, src, len(t)) for i, t, lang, src in one])
    assert got[0][4] == h("")  # no siblings


@pytest.mark.parametrize("n, fan, levels", [(1, 2, 1), (2, 2, 1), (17, 16, 2), (256, 16, 2), (257, 16, 2), (300, 2, 2), (40, 3, 1)])
def test_many_stages_and_lone_nodes(s, n, fan, levels):
    rows = [(i, f"Text {i}", "en", "a" if i % 3 else f"own{i % 7}", i) for i in range(n)]
    frame = docs(s, [(i, t, lang, src) for i, t, lang, src, _ in rows]).withColumn("n_chars", F.col("doc_id"))
    assert result(frame, fan=fan, levels=levels, rows_per_part=20) == brute(rows, fan)


def test_one_source_and_key_with_most_rows(s):
    rows = [(7, "same", "en", "hot")] * 500 + [(i, f"t{i}", "en", None) for i in range(60)]
    frame = docs(s, rows)
    want = brute([(i, t, lang, src, len(t)) for i, t, lang, src in rows])
    assert result(frame, rows_per_part=50) == want


def test_paths_prove_rows_and_find_the_changed_one(s):
    frame = docs(s)
    out = merkle.manifest(frame, paths=True).collect()
    assert all(r["verified"] for r in out)
    for r in out:
        assert merkle.fold(r["leaf"], merkle.read_path(r["path"])) == r["root"]
        assert merkle.proof_digest(merkle.read_path(r["path"])) == r["proof_sha256"]
    other = merkle.manifest(frame.withColumn("text", F.when(F.col("doc_id") == 8, "altered").otherwise(F.col("text")))).collect()
    assert {r["root"] for r in other} != {r["root"] for r in out}
    assert {r["leaf"] for r in other} ^ {r["leaf"] for r in out} and len({r["leaf"] for r in other} - {r["leaf"] for r in out}) == 1


def test_positions_are_gapless_in_every_group(s):
    rows = s.createDataFrame([("a" if i % 3 else None, i % 11, i) for i in range(1000)], "g string, k long, v long")
    got = numbered(rows, ["g"], ["k"], rows_per_part=30).collect()
    for g in (None, "a"):
        own = sorted((r["pos"], r["k"], r["total"]) for r in got if r["g"] == g)
        assert [p for p, _, _ in own] == list(range(len(own))) and {t for _, _, t in own} == {len(own)}
        assert [k for _, k, _ in own] == sorted(k for _, k, _ in own)

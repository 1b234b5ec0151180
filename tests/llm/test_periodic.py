import hashlib
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from caprank.llm import periodic
from caprank.llm.common import prepare
from helpers import TEXTS, docs, empty, with_nulls

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def s(spark):
    prepare(spark)
    return spark


def brute_runs(words):
    """Runs by trying every period at every place."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i < len(words) - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            if i + q - a >= max(24, 3 * q):
                found.setdefault((a, i + q - a), q)  # periods ascend: the smallest stays
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def rewritten(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_row(doc_id, words):
    runs = brute_runs(words)
    keep = [not any(a + q <= i < a + n for a, n, q in runs) for i in range(len(words))]
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    a, n, q = top or (None, None, None)
    return (doc_id, len(runs), a, n, q, 1000 * n // q if top else None,
            hashlib.sha256("".join(f"{x},{y},{z}\n" for x, y, z in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for w, k in zip(words, keep, strict=True) if k)).hexdigest())


def texts_of(rnd, letters):
    words = []
    while len(words) < rnd.choice([10, 60, 200, 400]):
        unit = [b"%d" % rnd.randrange(letters) for _ in range(rnd.randrange(1, 25))]
        if rnd.random() < 0.6:
            unit = unit * rnd.randrange(1, 7)
            unit = unit[:len(unit) - rnd.randrange(0, max(1, len(unit) // 4))]
        if words and rnd.random() < 0.3:
            words = words[-70:] * rnd.randrange(2, 5)  # runs of runs
        words += unit
    return words[:600]


@pytest.mark.parametrize("seed", range(6))
def test_runs_match_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(25):
        lists = [texts_of(rnd, rnd.choice([1, 2, 2, 3, 40])) for _ in range(rnd.randrange(1, 10))] + [[], [b"a"] * 23, [b"a"] * 24]
        for words, got in zip(lists, periodic.find_runs(lists), strict=True):
            assert got == brute_runs(words)


def test_fibonacci_and_block_borders():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 1500:
        a, b = b, b + a
    lists = [b]
    for q in (1, 2, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 100):
        for extra in (0, 1):
            n = max(24, 3 * q) - 1 + extra
            unit = [b"u%d" % i for i in range(q)]
            for shift in (0, 1, 5, 13):
                lists.append([b"p%d" % i for i in range(shift)] + (unit * (n // q + 1))[:n] + [b"end"])
    for words, got in zip(lists, periodic.find_runs(lists), strict=True):
        assert got == brute_runs(words)


def test_range_successor():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 64, 100):
        values = rng.permutation(n)
        tree = periodic.WaveletTree(values)
        lo = rng.integers(0, n + 1, 200)
        hi = np.minimum(n, lo + rng.integers(0, n + 1, 200))
        x = rng.integers(0, n + 1, 200)
        for a, b, y, got in zip(lo, hi, x, tree.successor(lo, hi, x), strict=True):
            assert got == min([v for v in values[a:b] if v >= y], default=n)


def test_table_matches_brute_force(s):
    rows = duckdb.sql(f"select doc_id, text from read_parquet('{SF}/documents.parquet')").fetchall()
    got = {r["doc_id"]: tuple(r) for r in periodic.op13_periodic_runs(s, SF).collect()}
    assert len(got) == len(rows)
    with_run = 0
    for i, t in rows:
        words = rewritten(i, (t or "").encode().split())
        if len(words) <= 2000:  # the plain version takes the square of the words
            assert got[i] == brute_row(i, words)
            with_run += got[i][1] > 0
    assert with_run > 20


def test_awkward_rows(s):
    frame = with_nulls(s)
    got = periodic.run_digests(frame, periodic.planted).collect()
    short = [(r["doc_id"], r["text"]) for r in frame.collect() if r["doc_id"] != 14]
    assert sorted(map(str, map(tuple, (r for r in got if r["doc_id"] != 14)))) == sorted(
        str(brute_row(i, rewritten(i, (t or "").encode().split()))) for i, t in short)
    assert len(got) == len(TEXTS) + 4
    assert periodic.run_digests(empty(s)).count() == 0 and periodic.periodic_runs(empty(s)).count() == 0


def test_long_and_many_tiny_texts(s):
    unit = " ".join(f"w{i}" for i in range(4000))
    rows = [(1, unit + " " + unit + " " + unit, "en", "a"), (2, "z " * 200_000, "en", "a")]
    rows += [(i, "", "en", "a") for i in range(3, 20_000)]
    got = {r["doc_id"]: r for r in periodic.periodic_runs(docs(s, rows)).where("size(runs) > 0").collect()}
    assert {i: [tuple(x) for x in r["runs"]] for i, r in got.items()} == {1: [(0, 12_000, 4000)], 2: [(0, 200_000, 1)]}
    assert got[1]["collapsed"] == unit.encode() and got[2]["collapsed"] == b"z"

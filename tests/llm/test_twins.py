"""Plain Python versions of operators that SQL cannot express."""

import math
import re
import struct

import numpy as np
import pytest
import xxhash

import duckdb
from caprank.llm import language, licenses, quality
from caprank.llm.common import prepare
from helpers import TEXTS, docs, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def s(spark):
    prepare(spark)
    return spark


# language: every trigram by itself -------------------------------------------

def plain_bundle(text, dim, seed):
    """Sum of the bound vectors of the letter trigrams, one after another."""
    symbols = []
    for c in (text or "").lower():
        if c.isalpha():
            symbols.append(c)
        elif symbols and symbols[-1] != " ":
            symbols.append(" ")
    v = {c: language.letter_vector(ord(c), dim, seed).astype(int) for c in set(symbols)}
    out = np.zeros(dim, dtype=int)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        out += np.roll(v[a], 2) * np.roll(v[b], 1) * v[c]
    return out


@pytest.mark.parametrize("dim", [16, 256])
def test_bundles_are_sums_of_bound_trigrams(dim):
    texts = [t or "" for _, t, *_ in TEXTS if not t or len(t) < 6000] + ["a", "ab", "abc", "a b c", "Übung macht den Meister", "x--y--z", "..abc"]
    got, letters, trigrams = language.bundles(texts, dim, 7)
    for t, row, n, k in zip(texts, got, letters, trigrams, strict=True):
        assert n == sum(c.isalpha() for c in t.lower())
        want = plain_bundle(t, dim, 7)
        if not t or t[0].isalpha():
            assert (row == want).all()
        assert k >= 0 and (np.abs(row) <= k).all()


def test_predictions_are_the_largest_cosines(s):
    rows = duckdb.sql(f"select doc_id, text, lang from read_parquet('{SF}/documents.parquet')").fetchall()
    frame = docs(s, [(i, t, lang, None) for i, t, lang in rows])
    langs, protos = language.prototypes(frame, dim=64)
    sums = {}
    vec = {i: language.bundles([t or ""], 64, language.SEED)[0][0].astype(float) for i, t, _ in rows}
    for i, t, lang in rows:
        if t and lang and any(c.isalpha() for c in t):
            sums[lang] = sums.get(lang, 0) + vec[i]
    assert langs == sorted(sums)
    unit = np.stack([sums[x] / np.linalg.norm(sums[x]) for x in langs])
    assert protos == pytest.approx(unit)
    for r in language.identify(frame, langs, protos).collect():
        cos = unit @ vec[r["doc_id"]] / max(np.linalg.norm(vec[r["doc_id"]]), 1e-300)
        if any(c.isalpha() for c in (dict((i, t) for i, t, _ in rows)[r["doc_id"]] or "")):
            assert r["score"] == pytest.approx(max(0.0, cos.max()), abs=1e-6)
            assert cos[langs.index(r["lang_pred"])] == pytest.approx(cos.max(), abs=1e-6)


# quality: the ratio by counting in dictionaries --------------------------------

def x64(raw, seed=42):
    return xxhash.xxh64(raw, seed=seed & (2**64 - 1)).intdigest()


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def plain_grams(text, buckets):
    # words of letters and digits, and runs of other characters than white space
    tokens, run, kind = [], "", None
    for c in text or "":
        k = "space" if c in " \t\n\x0b\x0c\r" else "word" if c.isalpha() or c.isnumeric() else "other"
        if k != kind and run:
            tokens.append(run)
            run = ""
        run, kind = run + c if k != "space" else "", k
    if run:
        tokens.append(run)
    h = [signed(x64(t.encode())) for t in tokens]
    pairs = [signed(x64(struct.pack("<q", b), seed=x64(struct.pack("<q", a)))) for a, b in zip(h, h[1:])]
    return [g % buckets for g in h + pairs]


@pytest.mark.parametrize("buckets", [50, 10_000])
def test_scores_are_mean_log_ratios(s, buckets):
    rows = [(i, t) for i, t, *_ in TEXTS if t is None or re.fullmatch(r"[\x00-\x7f]*", t)]
    good = {1, 5, 6, 15, 19}
    frame = docs(s, [(i, t, None, None) for i, t in rows])
    got = {r["doc_id"]: r for r in quality.judged(frame, s.createDataFrame([(i,) for i in good], "doc_id long"), buckets=buckets).collect()}
    raw, trusted = np.zeros(buckets), np.zeros(buckets)
    for i, t in rows:
        for g in plain_grams(t, buckets):
            raw[g] += 1
            trusted[g] += i in good
    ratio = np.log((trusted + 1) / (trusted.sum() + buckets)) - np.log((raw + 1) / (raw.sum() + buckets))
    for i, t in rows:
        g = plain_grams(t, buckets)
        want = float(np.mean(ratio[g])) if g else 0.0
        assert got[i]["score"] == pytest.approx(want, rel=1e-9, abs=1e-12)
        assert got[i]["kept"] == (not got[i]["base_failed"] and want >= quality.THRESHOLD or False)


# licences: each template at each place ------------------------------------------

def plain_found(text, template):
    """Places (first and last word) where a template stands word for word."""
    clean = lambda x: re.findall(r"[a-z0-9]+", x.lower())
    t, w = clean(template), clean(text)
    return [k for k in range(len(w) - len(t) + 1) if w[k:k + len(t)] == t]


def test_every_whole_notice_is_found_wherever_it_stands(s):
    rng = np.random.default_rng(6)
    rows, want = [], []
    filler = [w for t in TEXTS[:1] for w in words(t[1])]
    for i in range(60):
        a, b, t = licenses.TEMPLATES[int(rng.integers(len(licenses.TEMPLATES)))]
        before, after = (" ".join(rng.choice(filler, int(rng.integers(0, 60)))) for _ in range(2))
        rows.append((i, f"{before}\n{t}\n{after}", None, None))
        want.append((a, b, t))
    got = {}
    for r in licenses.scan(docs(s, rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for (i, text, *_), (a, b, t) in zip(rows, want, strict=True):
        mine = [r for r in got.get(i, []) if r["license"] == a and r["coverage"] == 1]
        assert len(mine) >= len(plain_found(text, t)) >= 1
        for r in mine:
            assert 0 <= r["start"] < r["stop"] <= len(text)
    assert math.isfinite(sum(r["coverage"] for rs in got.values() for r in rs))


def test_tables_of_a_scope_are_deleted_but_for_the_kept(s):
    from caprank.llm.common import temporary, written

    df = s.range(5)
    with temporary(s):
        a, kept = written(df, "a"), written(df, "b", keep=True)
        with temporary(s):
            inner, up = written(df, "c"), written(df, "d", keep=True)
            assert inner.count() == 5
        assert up.count() == 5 and a.count() == 5
        with pytest.raises(Exception, match="(?i)not exist"):
            inner.count()
    assert kept.count() == 5
    for gone in (a, up):
        with pytest.raises(Exception, match="(?i)not exist"):
            gone.count()

"""The pipeline against plain Python versions of its stages."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caprank.llm import bpe, curriculum
from caprank.llm.common import prepare
from helpers import TEXTS, brute_groups, brute_repeats, docs, kept_bytes, words

SF = "/root/testdata/sf0.001"


def mixed(rows):
    """doc_id -> whole copies taken, by the contract's arithmetic."""
    size = {i: len(words(t)) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    names = sorted({s for s in source.values() if s is not None}) + [None] * (None in source.values())
    weight = {s: curriculum.WEIGHTS[k % 3] for k, s in enumerate(names)}
    total = {s: sum(size[i] for i in size if source[i] == s) for s in names}
    target, free, left = {}, list(names), 1.5 * sum(total.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = [s for s in free if weight[s] * level > 2 * total[s]]
        for s in full or free:
            target[s] = 2.0 * total[s] if full else weight[s] * level
            left -= target[s] if full else 0
        free = [s for s in free if s not in full] if full else []
    taken = dict.fromkeys(size, 0)
    for s in names:
        at = 0
        for e in (0, 1):
            for i in sorted((i for i in size if source[i] == s), key=lambda i: hashlib.md5(f"17:{e}:{i}".encode()).hexdigest()):
                taken[i] += size[i] > 0 and at + size[i] / 2 < target[s]
                at += size[i]
    return taken


def brute(rows):
    """doc_id -> (copies, digest of the text) of the last stage."""
    rows = [(i, t, s) for i, t, s in rows if t and any(c.isalpha() for c in t)]
    groups = brute_groups([(i, t) for i, t, _ in rows])
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    cut = brute_repeats([(i, t) for i, t, _ in rows])
    texts = {i: kept_bytes(*cut[i]).decode("utf-8", "ignore") for i, _, _ in rows}
    rows = [(i, texts[i], s) for i, _, s in rows if not sum(cut[i][1]) or texts[i].strip()]
    taken = mixed(rows)
    return {i: (taken[i], hashlib.sha256(t.encode()).hexdigest()) for i, t, _ in rows if taken[i]}


@pytest.fixture(scope="module")
def s(spark):
    prepare(spark)
    return spark


def through(spark, frame):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = frame.columns
        frame = stage(spark, frame, SF)
        assert frame.columns == before
        frame = frame.cache()
    return corpus_pipeline.STAGES[-1][1](spark, frame, SF)


def counted(rows):
    out = {}
    for r in rows:
        n, h = out.get(r["doc_id"], (0, r["decoded_sha256"]))
        assert h == r["decoded_sha256"]
        out[r["doc_id"]] = (n + 1, h)
    return out


def test_pipeline_matches_plain_python(s):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in s.read.parquet(f"{SF}/documents.parquet").collect()]
    out = corpus_pipeline.run(s, SF).collect()
    assert counted(out) == brute(rows)
    ranks = bpe.rank_file()
    _, table = bpe.loaded(ranks)
    assert all(r["n_tokens"] > 0 for r in out) and np.all(table.lens[:table.n] > 0)


def test_pipeline_on_awkward_rows(s):
    assert counted(through(s, docs(s)).collect()) == brute([(i, t, src) for i, t, _, src in TEXTS])
    assert through(s, docs(s, [])).count() == 0


def test_stages_keep_rows_without_an_id_and_other_texts_of_one(s):
    rows = [*TEXTS, (None, "text without an id, rather long so that it has words", "en", "a"), (5, "another text under a used id", "en", "a"),
            (None, "1234", "en", "a"), (1, TEXTS[0][1], "en", "a")]
    frame = docs(s, rows).withColumns({c: F.lit("clash") for c in ("kept_text", "_id", "_copy", "_gone", "text_digest", "plan_id", "cut_id")})
    for name, stage in corpus_pipeline.STAGES[:-2]:
        before = frame.columns
        frame = stage(s, frame, SF).cache()
        assert frame.columns == before
    left = [(r["doc_id"], r["text"]) for r in frame.collect()]
    assert (None, rows[20][1]) in left and (5, rows[21][1]) in left and (None, "1234") not in left
    assert sum(i == 1 for i, _ in left) == 1  # equal rows are one document
    ids = {i for i, _ in left}
    plain = brute_ids([(i, t) for i, t, *_ in TEXTS])
    assert ids - {None} == plain
    out = corpus_pipeline.STAGES[-1][1](s, corpus_pipeline.STAGES[-2][1](s, frame, SF), SF).collect()
    assert {r["doc_id"] for r in out} <= ids and len(out) > 5


def brute_ids(rows):
    """Ids that language, near duplicates and repeated passages keep."""
    rows = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    groups = brute_groups(rows)
    rows = [(i, t) for i, t in rows if groups[i][1] == i]
    cut = brute_repeats(rows)
    return {i for i, _ in rows if kept_bytes(*cut[i]).strip()}

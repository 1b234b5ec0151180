import hashlib
import math
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from caprank.llm import bpe, curriculum, jaccard, language, licenses, quality, repeats, scoring, token_files
from caprank.llm.common import exact_copies, packed, prepare, unpacked, written
from helpers import (LONG, NEAR, PASSAGE, TEXTS, brute_groups, brute_repeats, counts, docs, empty, kept_bytes, n_spans, with_nulls,
                     words)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def s(spark):
    prepare(spark)
    return spark


def sf_rows():
    return duckdb.sql(f"select doc_id, text from read_parquet('{SF}/documents.parquet')").fetchall()


def pairs(rows):
    return [(i, t) for i, t, *_ in rows]


# 1 ---------------------------------------------------------------------------

def tiktoken_encoding(ranks):
    import base64

    import public_tokenizers as p
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=table, special_tokens={})


def test_bpe_matches_the_library_and_round_trips(s):
    ranks = bpe.rank_file()
    want = tiktoken_encoding(ranks)
    rows = {r["doc_id"]: r for r in bpe.decode(bpe.encode(docs(s), ranks), ranks).collect()}
    assert len(rows) == len(TEXTS)
    for i, t, *_ in TEXTS:
        assert rows[i]["ids"] == want.encode_ordinary(t or "")
        assert bytes(rows[i]["decoded"]) == (t or "").encode()


def test_bpe_random_pieces(s):
    import random

    ranks = bpe.rank_file()
    want = tiktoken_encoding(ranks)
    _, table = bpe.loaded(ranks)
    rnd = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "'", "'s", "'ll", "'re", "l", "s", "é", "1", "٣", "!", "漢字", "😀", "\r\n", "\x1c", " ", "a" * 300]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 30))) for _ in range(2000)]
    ids, offsets = bpe.encode_batch(table, texts)
    for t, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
        assert ids[a:b].tolist() == want.encode_ordinary(t)


def colliding_words(n):
    """Two words of n letters whose plain polynomial hashes agree modulo 2 ** 64
    for every base: the parity of the bits of each place, and its complement."""
    parity = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[p] for p in parity), "".join("ba"[p] for p in parity)


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_of_one_hash_keep_their_own_ids(s, monkeypatch, n):
    from tokenizers import Tokenizer

    import public_tokenizers as p
    from caprank.llm import common, pieces

    one, two = colliding_words(n)
    rows = [(1, one, "en", "a"), (2, two, "en", "a"), (3, f"{one} {two} {one}", "en", "a"), (4, "a plain text", "en", "a")]
    ranks = bpe.rank_file()
    want = tiktoken_encoding(ranks)
    for r in bpe.decode(bpe.encode(docs(s, rows), ranks), ranks).collect():
        text = rows[r["doc_id"] - 1][1]
        assert r["ids"] == want.encode_ordinary(text) and bytes(r["decoded"]) == text.encode()
    t = Tokenizer.from_file(p.path("byte_bpe_50k.json"))
    shards = written(token_files.write_shards(docs(s, rows), token_files.tokenizer_file()), "t")
    for r in token_files.read_shards(shards).collect():
        assert r["ids"] == [*t.encode(rows[r["doc_id"] - 1][1], add_special_tokens=False).ids, 2]
    h = common.span_hashes(*(lambda c, o, _: (c, o[:-1], o[1:]))(*common.code_points([one, two])))
    assert h[0] != h[1]
    # even if all words of a length had one hash
    monkeypatch.setattr(pieces, "span_hashes", lambda v, a, b: (b - a).astype(np.uint64))
    _, table = bpe.loaded(ranks)
    table._reset()
    rng = np.random.default_rng(1)
    for _ in range(3):
        texts = [" ".join("".join(rng.choice(list("abcé"), rng.integers(1, 6))) for _ in range(200)), one, two]
        ids, offsets = bpe.encode_batch(table, texts)
        for t, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
            assert ids[a:b].tolist() == want.encode_ordinary(t)
    table._reset()


def test_bpe_awkward_rows(s):
    ranks = bpe.rank_file()
    assert bpe.digests(empty(s), ranks).count() == 0
    out = bpe.digests(with_nulls(s), ranks).collect()
    assert len(out) == len(TEXTS) + 4 and sum(r["doc_id"] is None for r in out) == 2
    want = tiktoken_encoding(ranks)
    made = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out}
    assert made == {(r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r["text"] or "").encode()).hexdigest())
                    for r in with_nulls(s).collect() for ids in [want.encode_ordinary(r["text"] or "")]}
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(s.createDataFrame([(1, [10_000_000])], "doc_id long, ids array<int>"), ranks).collect()


# 2 ---------------------------------------------------------------------------

def removed(s, frame):
    copies = written(exact_copies(frame), "t")
    spans = written(repeats.removed_spans(frame, copies), "t")
    return repeats.kept_texts(frame.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), spans)


def test_repeats_match_brute_force(s):
    first = {}
    for i, t in pairs(TEXTS):
        first.setdefault(t or "", i)
    want = brute_repeats(pairs(TEXTS))
    got = {r["doc_id"]: r for r in removed(s, docs(s)).collect()}
    for i, t in pairs(TEXTS):
        raw, flags = want[i]
        if first[t or ""] != i:
            assert sum(flags) in (0, len(raw))  # whole copies are not cut but dropped
        elif sum(flags):
            assert (got[i]["n_removed"], got[i]["n_spans"], bytes(got[i]["kept"])) == (sum(flags), n_spans(flags), kept_bytes(raw, flags))
        else:
            assert i not in got
    assert sum(want[6][1]) >= len(PASSAGE)


def test_repeats_on_a_table(s):
    out = {r["doc_id"]: r for r in repeats.op2_suffix_dedup(s, SF).collect()}
    for i, (raw, flags) in brute_repeats(sf_rows()).items():
        r = out[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(raw), sum(flags), n_spans(flags))
        assert r["kept_sha256"] == hashlib.sha256(kept_bytes(raw, flags)).hexdigest()


def test_repeats_awkward_rows(s):
    assert removed(s, empty(s)).count() == 0
    assert removed(s, with_nulls(s)).where("doc_id is null").count() == 0


def chosen_texts(frame):
    """doc_id -> its text with the smallest digest."""
    out = {}
    for r in frame.select("doc_id", "text").collect():
        if r["doc_id"] is not None:
            t = r["text"] or ""
            out[r["doc_id"]] = min(out.get(r["doc_id"], t), t, key=lambda x: hashlib.sha256(x.encode()).hexdigest())
    return out


def test_repeats_take_one_text_of_an_id_and_leave_the_others(s):
    rows = [*TEXTS, (2, PASSAGE + " a second text of two", "en", "a"), (6, "short text of six", "en", "b"), (6, "short text of six", "en", "b"),
            (None, PASSAGE, "en", "a"), (30, "Here again: " + PASSAGE, "en", "a")]
    frame = docs(s, rows).withColumns({"kept_text": F.lit("clash"), "cut_id": F.lit("clash")})
    own = chosen_texts(frame)
    want = brute_repeats(list(own.items()))
    first = {}
    for i, t in sorted(own.items()):
        first.setdefault(t, i)
    got = {r["doc_id"]: bytes(r["kept"]) for r in repeats.cut_texts(frame, written(exact_copies(frame), "t")).collect()}
    assert got == {i: kept_bytes(*want[i]) for i, t in own.items() if sum(want[i][1]) and first[t] == i}
    stage = repeats.without_repeats(s, frame, SF)
    assert stage.columns == frame.columns
    left = []
    for i, t, *_ in rows:
        cut = i is not None and (t or "") == own[i]
        text = kept_bytes(*want[i]).decode("utf-8", "ignore") if cut and sum(want[i][1]) else t
        if text is t or text.strip():
            left.append((i, text))
    assert sorted(map(str, left)) == sorted(str(tuple(r)) for r in stage.select("doc_id", "text").collect())


def test_repeats_of_hot_anchors_and_in_slices(s, monkeypatch):
    line = "this very common line of seventy-odd bytes stands in most documents of all."
    rows = [(i, f"start {i * 7919} {'x' * (i % 13)} {line} {'y' * (i % 7)} end {i * 104729}", "en", "a") for i in range(60)]
    frame = docs(s, rows + TEXTS[60:])
    want = brute_repeats([(i, t) for i, t, *_ in rows])
    for hot, chunk, at_once in ((5, 1_000_000, 250_000), (10**9, 2000, 50), (20, 500, 1)):
        monkeypatch.setattr(repeats, "HOT_CONTEXTS", hot)
        monkeypatch.setattr(repeats, "CHUNK", chunk)
        monkeypatch.setattr(repeats, "OCCURRENCES", at_once)
        got = {r["doc_id"]: (r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in removed(s, frame).collect()}
        assert got == {i: (sum(f), n_spans(f), kept_bytes(raw, f)) for i, (raw, f) in want.items() if sum(f)}


def test_spans_that_touch_are_joined():
    import pandas as pd

    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(0, 6)) - 3, int(a), int(a + rng.integers(1, 9))) for a in rng.integers(0, 80, 120)]
    got = {tuple(r) for r in repeats.merged(pd.DataFrame(rows, columns=["doc_id", "start", "stop"])).itertuples(index=False)}
    want = set()
    for d in {r[0] for r in rows}:
        flags = [any(i == d and a <= p < b for i, a, b in rows) for p in range(100)]
        touch = {b for i, _, b in rows if i == d} & {a for i, a, _ in rows if i == d}
        p = 0
        while p < 100:
            if flags[p]:
                q = p
                while flags[q] or q in touch and flags[q]:
                    q += 1
                want.add((d, p, q))
                p = q
            p += 1
    assert got == want


def test_occurrences_are_those_of_the_interval_tree():
    rng = np.random.default_rng(8)
    ctx = [bytes(rng.integers(97, 99, 30).astype(np.uint8)) for _ in range(12)]
    pdf = __import__("pandas").DataFrame({"h": 1, "doc_id": np.arange(12), "start": 100 * np.arange(12), "bytes": ctx})
    chunk = repeats.Chunk(pdf, 8)
    rows = [tuple(r) for f in chunk.repeats() for r in f.itertuples(index=False)]
    assert rows and len(rows) == sum(hi - lo + 1 for lo, hi, _ in chunk.intervals.tolist())
    for d, a, n, first in rows:
        sub = ctx[d][a - 100 * d:a - 100 * d + n]
        assert len(sub) == n and first == min(i for i, c in enumerate(ctx) if sub in c)


def test_anchors_of_long_texts_are_chosen_in_small_parts():
    rng = np.random.default_rng(11)
    texts = ["".join(rng.choice(list("ab \u00e9"), n)) for n in (200_000, 0, 300, 70_000)]
    sizes, windows = [], []
    for rows, shift, data, offsets in repeats._parts([5, 6, 7, 8], texts, 50):
        sizes.append(len(data))
        _, _, first, last, doc = repeats.anchors(data, offsets, 50, 20)
        for a, b, k in zip(first.tolist(), last.tolist(), doc.tolist(), strict=True):
            windows += [(int(rows[k]), w - int(offsets[k]) + int(shift[k])) for w in range(a, b + 1)]
    assert max(sizes) <= repeats.PART
    assert sorted(windows) == [(i, w) for i, t in enumerate(texts) for w in range(len(t.encode()) - 49)]


def test_suffix_arrays_hold_anchors_of_several_documents_only():
    import pandas as pd

    rng = np.random.default_rng(12)
    base = bytes(rng.integers(97, 100, 70).astype(np.uint8))
    ctx = [base, b"-" + base, base[:60], base[5:], b"+" + base, base]
    pdf = pd.DataFrame({"h": [1, 1, 2, 3, 3, 3], "doc_id": [4, 9, 4, 7, 7, 7], "start": 100 * np.arange(6), "bytes": ctx})
    some = repeats.of_several(pdf)
    assert some["h"].tolist() == [1, 1]
    spans = [[tuple(r) for f in repeats.Chunk(x, 50).covered() for r in f.itertuples(index=False)] for x in (pdf, some)]
    assert spans[0] == spans[1] == [(9, 101, 171)]
    assert list(repeats.Chunk(repeats.of_several(pdf[2:]), 50).covered()) == []


def test_suffix_array_against_a_plain_sort():
    rng = np.random.default_rng(13)
    for low, high in ((97, 99), (0, 2)):  # zero bytes look like the end of a suffix
        texts = [bytes(rng.integers(low, high, n).astype(np.uint8)) for n in rng.integers(1, 60, 30)]
        texts += [texts[0], texts[1] + b"\0", texts[2] + b"\0" * 9]
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        base = np.cumsum([0, *map(len, texts)])
        starts = np.concatenate([np.arange(a, b) for a, b in zip(base[:-1], base[1:], strict=True)])
        owner = np.repeat(np.arange(len(texts)), np.diff(base))
        stops, raw = base[1:][owner], data.tobytes()
        suffix = [raw[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
        for factor in (1, 1 << 50):  # groups too large for one integer with the words
            group = (owner % 3) * factor
            order, lcp = repeats.suffix_array(data, starts, stops, group)
            assert order.tolist() == sorted(range(len(suffix)), key=lambda i: (group[i], suffix[i]))
            for k, (a, b) in enumerate(zip(order[:-1].tolist(), order[1:].tolist(), strict=True), 1):
                n = 0
                while group[a] == group[b] and suffix[a][n:n + 1] == suffix[b][n:n + 1] != b"":
                    n += 1
                assert lcp[k] == n


def test_interval_tree_against_all_substrings():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 99, 40).astype(np.uint8)) for _ in range(6)]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    base = np.arange(6) * 40
    starts = np.concatenate([b + np.arange(40) for b in base])
    stops = np.repeat(base + 40, 40)
    order, lcp = repeats.suffix_array(data, starts, stops, np.zeros(len(starts), dtype=np.int64))
    left = np.where(starts % 40 > 0, data[np.maximum(starts - 1, 0)].astype(np.int64), -1)
    got = {}
    for lo, hi, depth in repeats.maximal_repeats(lcp, left[order], 6):
        places = frozenset(starts[order[lo:hi + 1]].tolist())
        got[bytes(data[starts[order[lo]]:starts[order[lo]] + depth])] = places
    want = {}
    for t, b in zip(texts, base, strict=True):
        for p in range(40):
            for q in range(p + 6, 41):
                want.setdefault(t[p:q], set()).add(int(b) + p)

    def maximal(sub, at):
        before = {bytes(data[a - 1:a]) if a % 40 else None for a in at}
        after = {bytes(data[a + len(sub):a + len(sub) + 1]) if a % 40 + len(sub) < 40 else None for a in at}
        return len(at) > 1 and (len(before) > 1 or None in before) and (len(after) > 1 or None in after)

    assert got == {k: frozenset(v) for k, v in want.items() if maximal(k, v)}


# 3 ---------------------------------------------------------------------------

def test_jaccard_matches_all_pairs(s):
    rows = [*pairs(TEXTS)]
    for k in range(12):  # a chain: each links with the next, the ends do not
        rows.append((100 + k, " ".join(f"chain{j}" for j in range(k * 8, k * 8 + 80))))
    for k in range(30):  # near copies around one text
        rows.append((200 + k, NEAR.replace(f"beta{k} ", f"other{k} ")))
    frame = docs(s, [(i, t, None, None) for i, t in rows])
    want = brute_groups(rows)
    for match in (1, 4):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
               for r in jaccard.similar_groups(frame, max_match=match, verify_cost=1000.0, sketch_size=256)[0].collect()}
        assert got == want


def test_jaccard_on_a_table(s):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.op3_jaccard_join(s, SF).collect()}
    assert got == brute_groups(sf_rows())


def test_jaccard_awkward_rows(s):
    assert jaccard.similar_groups(empty(s))[0].count() == 0
    frame = with_nulls(s)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_groups(frame)[0].collect()}
    assert got == brute_groups(chosen_texts(frame).items())


def test_near_duplicate_stage_keeps_other_texts_of_an_id(s):
    rows = [*TEXTS, (9, "an unlike text under the id of a near copy", "en", "a"), (1, TEXTS[0][1], "en", "a"), (None, NEAR, "en", "a"),
            (None, None, None, None)]
    frame = docs(s, rows).withColumns({"text_digest": F.lit("clash"), "row_number": F.lit("clash")})
    own = chosen_texts(frame)
    groups = brute_groups(own.items())
    want, seen = [], set()
    for i, t, *_ in rows:
        if i is not None and (t or "") == own[i]:
            if groups[i][1] != i or i in seen:
                continue
            seen.add(i)
        want.append((i, t))
    stage = jaccard.keep_one_of_each_group(s, frame, SF)
    assert stage.columns == frame.columns
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in stage.select("doc_id", "text").collect())


# 4 ---------------------------------------------------------------------------

def test_language_held_out_accuracy(s):
    d = "/root/testdata/sf0.01"
    out = language.op4_language_id(s, d).join(s.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = out.where("held_out").collect()
    assert len(held) > 300
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in held)
    assert {r["doc_id"] for r in held} == {i for i in range(1000) if zlib.crc32(str(i).encode()) % 3 == 1}


def test_language_awkward_rows(s):
    langs, protos = language.prototypes(docs(s))
    assert langs == ["de", "en"]  # "xx" has no letter to learn from
    out = {r["doc_id"]: r for r in language.identify(with_nulls(s), langs, protos).collect()}
    assert {i for i, r in out.items() if r["lang_pred"] == "und"} >= {2, 3, 4, 11}
    assert out[12]["lang_pred"] == "de" and out[2]["score"] == 0.0
    none, nothing = language.prototypes(empty(s))
    assert none == [] and language.identify(docs(s), none, nothing).where("lang_pred <> 'und'").count() == 0
    assert language.identify(empty(s), langs, protos).count() == 0
    kept = language.keep_identified(s, docs(s), SF)
    assert kept.columns == docs(s).columns
    assert {i for i, *_ in TEXTS} - {r["doc_id"] for r in kept.collect()} == {2, 3, 4, 11}


def test_language_stage_judges_each_row_by_its_text(s):
    bad = [(1, "1234 5678", "en", "a"), (None, "99999", "en", "a"), (None, None, "de", "a"), (5, "", None, "a")]
    good = [r for r in TEXTS if r[1] and any(c.isalpha() for c in r[1])] + [(None, "a clean text without an id", "en", "a")]
    frame = docs(s, [*bad, *good]).withColumns({"language": F.array(F.lit("clash")), "m": F.create_map(F.lit(1), F.lit("x"))})
    kept = language.keep_identified(s, frame, SF)
    assert kept.columns == frame.columns and kept.schema["m"].dataType.simpleString() == "map<int,string>"
    assert sorted(str((i, t)) for i, t, *_ in good) == sorted(str(tuple(r)) for r in kept.select("doc_id", "text").collect())


def test_language_of_very_many_short_texts(s):
    import tracemalloc

    import pandas as pd

    texts = ["ein Wort", "", "two words", "x"] * 25_000
    proto = np.random.default_rng(0).normal(size=(2, language.DIM))
    tracemalloc.start()
    n = 0
    from caprank.llm.common import text_batches
    for ids, some in text_batches([pd.DataFrame({"i": range(len(texts)), "t": texts})], language.BUNDLE_CHARS, language.BUNDLE_ROWS):
        pred, score, _ = language.predictions(some, ["a", "b"], proto, 1)
        n += len(pred)
    assert n == 100_000 and tracemalloc.get_traced_memory()[1] < 120e6
    tracemalloc.stop()


def test_language_stage_rejects_letter_noise(s):
    import base64
    import random

    rng = random.Random(5)
    own = duckdb.sql("select text, lang from read_parquet('/root/testdata/sf0.01/documents.parquet') where text is not null").fetchall()
    own += [(t[k:k + n], lang) for t, lang in own[:200] for k, n in ((0, 30), (40, 60), (120, 120)) if len(t) > k + n]
    clean = ["Hi.", "Yes, of course.", "The weather is nice today.", "La maison est grande et belle.", "Das Haus ist sehr alt und klein.",
             "Released under the MIT License."]
    noise = []
    for n in (60, 300, 2000, 20000):
        noise += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)), base64.b64encode(rng.randbytes(n)).decode(),
                  " ".join("".join(rng.choice("asdfghjkl") for _ in range(rng.randint(3, 9))) for _ in range(n // 6)), "漢字仮名交" * (n // 5)]
    rows = [*own, *((t, None) for t in clean), *((t, "en" if i % 4 == 0 else None) for i, t in enumerate(noise))]
    kept = language.keep_identified(s, docs(s, [(i, t, lang, "a") for i, (t, lang) in enumerate(rows)]), SF)
    gone = set(range(len(rows))) - {r["doc_id"] for r in kept.select("doc_id").collect()}
    first = len(own) + len(clean)
    assert gone - {i for i, (t, _) in enumerate(own) if not any(c.isalpha() for c in t)} == set(range(first, len(rows)))


# 5 ---------------------------------------------------------------------------

class PlainAutomaton:
    """The same automaton as dictionaries of arcs, read word by word."""

    def __init__(self, rows, train):
        self.uni, self.pair, self.texts = counts(rows, train)
        triple = {}
        for i, t in rows:
            if train(i):
                w = ["<s>", *words(t), ""]
                for j in range(len(w) - 2):
                    triple[tuple(w[j:j + 3])] = triple.get(tuple(w[j:j + 3]), 0) + 1
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        L2, L3 = scoring.WORD_WEIGHT, scoring.PAIR_WEIGHT
        left = lambda u: self.texts if u == "<s>" else self.uni[u]
        self.states = {(), *((w,) for w in self.uni), *self.pair} | ({("<s>",)} if self.texts else set())
        p2 = {(u, w): L2 * c / left(u) + (1 - L2) * self.p(w) for (u, w), c in self.pair.items()}
        self.arcs = {((u,), w): p for (u, w), p in p2.items()}
        self.arcs |= {((u, x), w): L3 * c / self.pair[u, x] + (1 - L3) * p2[x, w] for (u, x, w), c in triple.items()}
        self.failure = {s: (1 - L3 if len(s) == 2 else 1 - L2) for s in self.states if s}

    def p(self, w):
        return (self.uni[w] + 1) / (self.n + self.v + 1)

    def score(self, text):
        state, total = ("<s>",) if ("<s>",) in self.states else (), 0.0
        for w in words(text) + [""]:
            while state and (state, w) not in self.arcs:
                total += math.log10(self.failure[state])
                state = state[1:]
            total += math.log10(self.arcs[state, w] if state else self.p(w))
            state = next(s for s in ((*state, w)[-2:], (w,), ()) if s in self.states)
        return total


def check_scores(got, rows, train):
    plain = PlainAutomaton(rows, train)
    for i, t in rows:
        tokens = words(t) + [""]
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(plain.uni[x] > 0 for x in tokens), plain.n)
        assert r["base_score"] == pytest.approx(sum(math.log10(plain.p(x)) for x in tokens), rel=1e-9, abs=1e-9)
        assert r["score"] == pytest.approx(plain.score(t), rel=1e-9, abs=1e-9)


def test_scores_match_plain_counts(s, monkeypatch):
    monkeypatch.setattr(scoring, "RANGE_CHARS", 50_000)
    more = [(100 + i, " ".join("abcde"[(i * j * j + j // 3) % 5] for j in range(5 + 40 * i)), "en", "a") for i in range(16)]
    rows = [*TEXTS, *more, (200, "", "en", "a"), (201, "a", "en", "a"), (202, "z z z unknown a b", "en", "a")]
    got = {r["doc_id"]: r for r in scoring.scored(docs(s, rows), F.col("doc_id") % 3 != 0).collect()}
    check_scores(got, pairs(rows), lambda i: i % 3 != 0)


def test_probabilities_of_every_state_add_up_to_one():
    rows = [(i, t) for i, t in enumerate(["a b a b c", "b a c", "", "c c c a b", "a"])]
    plain = PlainAutomaton(rows, lambda i: True)
    alphabet = [*plain.uni, "unseen"]
    for state in plain.states:
        total = 0.0
        for w in alphabet:
            s, p = state, 1.0
            while s and (s, w) not in plain.arcs:
                p, s = p * plain.failure[s], s[1:]
            total += p * (plain.arcs[s, w] if s else plain.p(w))
        assert total <= 1 + 1e-12 and (total > 0.99 or state)


def test_stretches_carry_the_state():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("abcdef"), n)) for n in (1, 2, 3, 255, 256, 257, 700, 2000)]
    rows = list(enumerate(texts))
    plain = PlainAutomaton(rows, lambda i: i % 2 == 0)
    h, before, doc = scoring.tokens_of(texts)
    first = scoring.first_tokens(doc)
    number, found = [], []
    teaches = (np.arange(len(texts)) % 2 == 0)[doc]
    for keys, _ in scoring.keys_of(h, before, first, 0):
        uniq, inv = np.unique(keys, return_inverse=True)
        number.append(inv)
        found.append(np.bincount(inv, weights=teaches, minlength=len(uniq)))
    bw, bp = (np.concatenate(([-1], x[:-1])) for x in number[:2])
    bw[first] = bp[first] = -1
    a = scoring.Automaton(*number, found, bw, bp, 4, plain.n, plain.v)
    for stretch in (1, 2, 3, 256, 10_000):
        got = a.traverse(number[0], np.append(first, len(h)), stretch)
        assert got == pytest.approx([plain.score(t) for t in texts], rel=1e-9)


def test_scores_on_a_table(s):
    got = {r["doc_id"]: r for r in scoring.op5_backoff_score(s, SF).collect()}
    check_scores(got, sf_rows(), lambda i: zlib.crc32(str(i).encode()) % 7 != 2)
    held = [r for r in got.values() if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scores_awkward_rows(s):
    assert scoring.scored(empty(s), F.lit(True)).count() == 0
    out = scoring.scored(with_nulls(s), F.lit(False)).collect()
    assert len(out) == len(TEXTS) + 4 and all(r["score"] == 0 == r["base_score"] and r["n_known"] == 0 for r in out)


# 6 ---------------------------------------------------------------------------

def test_token_shards_round_trip_and_checks():
    rng = np.random.default_rng(1)
    for ids in (rng.zipf(1.4, 30_000) % 50_257, np.full(5000, 7), np.array([3]), rng.integers(0, 50_000, 3000)):
        ids = ids.astype(np.int32)
        raw = token_files.write_shard(np.array([4, 9]), np.array([1, len(ids) - 1]), ids, block=8192, lanes=64, every=16)
        d, n, back = token_files.read_shard(raw)
        assert d.tolist() == [4, 9] and n.tolist() == [1, len(ids) - 1] and np.array_equal(back, ids)
    broken = bytearray(raw)
    broken[-5] ^= 1
    with pytest.raises(ValueError):
        token_files.read_shard(bytes(broken))


def test_token_blocks_decode_from_checkpoints():
    rng = np.random.default_rng(2)
    sym = rng.integers(0, 300, 10_000)
    freq = token_files.quantized(np.bincount(sym, minlength=300) + 1, 16).astype(np.uint64)
    cum = np.cumsum(freq) - freq
    states, out, marks = token_files.encode_block(sym, freq, cum, 16, 32, 50)
    slots = np.repeat(np.arange(300), freq.astype(np.int64))
    assert len(marks) >= 5
    for step, at, st in marks:
        got = token_files.decode_block(len(sym), st, out.astype(np.uint64), slots, freq, cum, 16, 32, step, at)
        assert np.array_equal(got, sym[step * 32:])


def test_token_files_match_the_library(s, monkeypatch):
    import public_tokenizers as p
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(p.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rows = [*TEXTS, (21, "<|endoftext|> inside", None, None)]
    monkeypatch.setattr(token_files, "SHARD_TOKENS", 20_000)
    shards = written(token_files.write_shards(docs(s, rows), token_files.tokenizer_file()), "t")
    got = {r["doc_id"]: r for r in token_files.doc_index(shards).collect()}
    ids = {r["doc_id"]: r["ids"] for r in token_files.read_shards(shards).collect()}
    start = 0
    for i, text, *_ in rows:
        want = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        assert ids[i] == want
        crc = zlib.crc32(np.array(want, dtype="<u4").tobytes())
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(want), crc)
        start += len(want)


def test_words_encoded_together_are_those_encoded_alone():
    import random

    import public_tokenizers as p
    from tokenizers import Tokenizer

    from caprank.llm import common, pieces

    t = Tokenizer.from_file(p.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    encode = lambda texts: [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]
    rnd = random.Random(2)
    parts = [" ", "  ", "\n", "\t", "\r\n", "'", "'s", "'ll", "a", "Ab", "é", "1", "٣", "!", "漢字", "😀", "\x85", "\xa0", "\u2028", "\x1c", "\u200b",
             "<|endoftext|>", "\x00", "x" * 300]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(1, 40))) for _ in range(3000)]
    cps, offsets, joined = common.code_points(texts)
    starts, ends = pieces.piece_spans(cps, offsets)
    words = sorted({joined[a:b] for a, b in zip(starts, ends)}) + ["\n", "\n\n", " ", "\n \n"]
    for at_once in (1, 7, 256):
        flat, offs, lens = token_files.joined_encoder(encode, at_once)(words)
        assert [flat[a:a + n].tolist() for a, n in zip(offs.tolist(), lens.tolist(), strict=True)] == encode(words)


def test_token_files_awkward_rows(s):
    assert token_files.doc_index(written(token_files.write_shards(empty(s), token_files.tokenizer_file()), "t")).count() == 0
    out = token_files.doc_index(written(token_files.write_shards(with_nulls(s), token_files.tokenizer_file()), "t")).orderBy("start").collect()
    assert len(out) == len(TEXTS) + 4 and [r["doc_id"] for r in out[:2]] == [None, None]


# 7 ---------------------------------------------------------------------------

def test_licenses_found_where_planted(s):
    apache = dict((t[:2], t[2]) for t in licenses.TEMPLATES)["Apache-2.0", "notice"]
    rows = [(1, "Before. Released under the MIT License. After", None, None), (2, apache.replace("compliance", "agreement"), None, None),
            (3, "licensed UNDER cc by-nc 4.0! and again: Licensed under CC BY-NC 4.0", None, None),
            (4, "the license of the library under which one may read", None, None), (5, LONG + " Released under the MIT License.", None, None),
            (6, None, None, None), (7, "", None, None)]
    got = licenses.scan(docs(s, rows)).orderBy("doc_id", "start").collect()
    assert [(r["doc_id"], r["license"]) for r in got] == [(1, "MIT"), (2, "Apache-2.0"), (3, "CC-BY-NC-4.0"), (3, "CC-BY-NC-4.0"), (5, "MIT")]
    assert rows[0][1][got[0]["start"]:got[0]["stop"]] == "Released under the MIT License"
    assert got[1]["template"] == "notice" and 0.9 < got[1]["coverage"] < 1
    assert got[4]["start"] == len(LONG) + 1
    assert licenses.scan(empty(s)).count() == 0
    assert licenses.scan(with_nulls(s)).count() == 0


def test_licenses_on_a_table(s):
    lines = {a: t for a, b, t in licenses.TEMPLATES if b == "line"}
    got = {(r["doc_id"], r["license"]) for r in licenses.op7_license_scan(s, SF).collect()}
    assert got == {(i, a) for i, t in sf_rows() for a, x in lines.items() if x in (t or "")}


def test_licenses_back_to_back(s):
    mit, rng = "Released under the MIT License.", np.random.default_rng(3)
    notice = dict((t[:2], t[2]) for t in licenses.TEMPLATES)["MIT", "permission"]
    texts = ["\n".join([mit] * 4), (mit + " yes ") * 5, (mit + " ") * 3000, (notice + "\n") * 6,
             " ".join(mit + " w" * int(k) for k in rng.integers(0, 9, 200)),
             "Released under the MIT licence. Released under that MIT License. " + mit]
    got = licenses.scan(docs(s, [(i, t, None, None) for i, t in enumerate(texts)])).orderBy("doc_id", "start").collect()
    for i, t in enumerate(texts[:5]):
        part = notice[:-1] if i == 3 else mit[:-1]
        want = [(k, k + len(part)) for k in range(len(t)) if t.startswith(part, k)]
        assert [(r["start"], r["stop"]) for r in got if r["doc_id"] == i and r["coverage"] == 1] == want
    assert [r["matched"] for r in got if r["doc_id"] == 5] == [4, 4, 5]


def test_licenses_whole_notices_and_names(s):
    rows = [(i, f"Copyright 2020 Some Body\n{t}\nint main() {{}}", a, b) for i, (a, b, t) in enumerate(licenses.TEMPLATES)]
    got = licenses.scan(docs(s, [(i, t, None, None) for i, t, *_ in rows])).collect()
    assert sorted((r["doc_id"], r["license"], r["template"], r["coverage"]) for r in got) == [(i, a, b, 1) for i, _, a, b in rows]
    for r in got:
        assert rows[r["doc_id"]][1][r["start"]:r["stop"]] == licenses.TEMPLATES[r["doc_id"]][2].rstrip("./>")
    near = ["Released under the BSD License.", "Licensed under the Apache License, Version 1.1.", "Licensed under CC BY-NC 3.0.",
            "This work is licensed under the GNU General Public License, version 1.", "Licensed under CC BY-SA 4.0.",
            "Distributed and licensed under the GNU General Public License, version 2.", "Licensed under the GNU Affero General Public License v3.0"]
    got = licenses.scan(docs(s, [(i, t, None, None) for i, t in enumerate(near)])).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["license"]) for r in got] == [(4, "CC-BY-SA-4.0"), (5, "GPL-2.0"), (6, "AGPL-3.0")]


# 8 ---------------------------------------------------------------------------

def base_counts(text):
    w = words(text, lower=False)
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i:i + 8]), []).append(i)
    again = {j for v in windows.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(again))


def test_quality_base_counts(s):
    rows = [*TEXTS, (30, "a b c d e f g h " * 5, None, None), (31, "a b c d e f g h i " + "x y " * 12 + "a b c d e f g h", None, None),
            (32, "#*$ %&|<> a\n\na\na \na", None, None)]
    got = {r["doc_id"]: r for r in quality.judged(docs(s, rows), None).collect()}
    for i, t, *_ in rows:
        r = got[i]
        want = base_counts(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["kept"] and r["base_failed"])
    assert quality.judged(empty(s), None).count() == 0
    assert quality.judged(with_nulls(s), None).count() == len(TEXTS) + 4


def test_quality_verdicts_follow_the_labels(s):
    d = "/root/testdata/sf0.01"
    out = quality.op8_quality_rules(s, d).join(s.read.parquet(f"{d}/labels.parquet"), "doc_id").where("not base_failed").collect()
    good, bad = [r["kept"] for r in out if r["quality"] == 1], [r["kept"] for r in out if r["quality"] == 0]
    assert all(good) and sum(bad) <= 0.2 * len(bad)


def test_quality_plan_is_native(s):
    plan = quality.op8_quality_rules(s, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# 9 ---------------------------------------------------------------------------

def test_mix_matches_the_sql(s):
    frame = docs(s, extra=False)
    table = frame.toPandas()
    con = duckdb.connect()
    con.register("documents", table)
    want = {r[0]: r[1:] for r in con.execute(curriculum.ORACLE_SQL).fetchall()}
    at = F.transform("copies", lambda c: c["position"])
    got = {r["doc_id"]: tuple(r)[1:] for r in curriculum.mixed(docs(s)).select(
        "doc_id", "size", "source_size", "target", "taken", F.array_min(at), F.array_max(at)).collect()}
    assert got == want


def test_mix_targets_and_positions(s):
    d = "/root/testdata/sf0.01"
    rows = curriculum.mixed(s.read.parquet(f"{d}/documents.parquet")).collect()
    by = {}
    for r in rows:
        assert r["taken"] <= 2 * r["size"]
        x = by.setdefault(r["source"], [0, r["target"], r["source_size"], []])
        x[0] += r["taken"]
        x[3] += [(c["position"], c["taken"]) for c in r["copies"]]
    assert abs(sum(x[1] for x in by.values()) - 1.5 * sum(x[2] for x in by.values())) < 1
    for i, name in enumerate(sorted(by)):
        took, target, size, at = by[name]
        assert abs(took - target) <= 1 and target <= 2 * size
        # the words up to each quarter of time are the integral of the schedule
        knots = curriculum.SCHEDULES[i % 3]
        for t in (0.25, 0.5, 0.75):
            grid = np.linspace(0, 1, 20_001)
            v = np.interp(grid, *zip(*knots, strict=True))
            share = v[grid <= t].sum() / v.sum()
            assert abs(sum(n for p, n in at if p <= t) / target - share) < 0.2
    again = {(r["doc_id"], r["taken"]) for r in curriculum.op9_curriculum_mix(s, d).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in rows}


def test_mix_whole_copies_and_awkward_rows(s):
    assert curriculum.mixed(empty(s)).count() == 0
    out = curriculum.mixed(with_nulls(s), whole=True).collect()
    assert len(out) == len(TEXTS) + 4 and all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in out)
    frame = docs(s).withColumns({"plan_id": F.lit("clash"), "plan_copy": F.lit("clash"), "_id": F.lit("clash")})
    order = curriculum.training_order(s, frame, SF)
    assert order.columns == frame.columns

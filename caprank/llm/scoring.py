"""Language-model scores from a weighted backoff automaton.

The states are the n-grams of training up to two words: the root (no word), one for
each word, one for each pair of words.  A state has an arc for every word that
followed it in training; a failure arc leads to the state of its last word, or to the
root, which has an arc for every training word and one for all others.  Weights are
those of smoothed n-grams:

    root arc      w:    (c(w) + 1) / (N + V + 1)
    arc           v w:  L2 * c(v w) / c(v) + (1 - L2) * p(w)
    arc         u v w:  L3 * c(u v w) / c(u v) + (1 - L3) * p(w | v)
    failure arc of a word: 1 - L2, of a pair: 1 - L3

with N training tokens of V types, the end of a text being a token, and the start of a
text a word that only states have.  An arc leads to the longest state that the words
so far end in.  A text is read once from left to right: in each state it takes the
word's arc, or failure arcs until one is found, carries the state on, and adds up
the logarithms.

Nothing of the corpus' vocabulary is broadcast or collected.  A scan is cut into
blocks.  Each block sends its distinct n-grams, as sorted hashes packed per hash
range, with their training counts; the range adds the counts up and returns, in the
same order, the corpus counts.  From them the block builds the part of the automaton
that its texts can touch, and traverses its texts with it: many texts at a time, long
ones in stretches, each of which starts in the state that the two words before it
lead to (which is the state that a traversal from the start arrives in).  A word that
is in every document reaches its range once per block.  A block sends at most one row
for each range that it has n-grams in, so rows grow with blocks times ranges only
until a range holds one n-gram of a block, and then with the text.

Words are told apart by 64-bit hashes, pairs and triples by 48 bits besides their
range.

Defined results: null and empty texts have the end token alone; without training
documents every token has probability 1 (an empty vocabulary); repeated rows are
documents of their own; null ids train nothing; very long texts are scored whole; an
empty table has no rows; other columns are ignored.  ``docs`` must be a deterministic
frame (such as a scan), because both passes cut it into the same blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caprank.llm.common import (NO_ID, claim, code_points, crc_mod, documents, lower_ascii, mix64, null_id, packed, span_hashes, trim,
                                unpacked, word_spans, written)

#: Weights of a word state's and a pair state's own counts against the shorter state.
WORD_WEIGHT, PAIR_WEIGHT = 0.4, 0.3
BLOCK_CHARS = 4_000_000
#: Characters of the corpus for each hash range.
RANGE_CHARS = 16_000_000
#: Tokens of a text that one lane of a traversal reads.
STRETCH = 256
#: Hash bits that tell words and pairs of one range apart.
WORD_BITS, PAIR_BITS = 64, 48
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)

REQUEST = "kind int, part long, block long, n long, keys binary, counts binary"
ANSWER = "kind int, part long, block long, counts binary, tokens long, types long"
SCORES = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def first_tokens(doc: np.ndarray) -> np.ndarray:
    """Places of the first token of each text."""
    return np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))


def _cut(batches):
    """Rows with the block they belong to: about ``BLOCK_CHARS`` characters of
    one scan partition, by rows alone."""
    first = TaskContext.get().partitionId() << 24
    n = 0
    for pdf in batches:
        size = pdf["text"].str.len().to_numpy().astype(np.int64)
        upto = n + np.cumsum(size) - size
        n += int(size.sum())
        yield pdf.assign(block=first + upto // BLOCK_CHARS)


def _whole_blocks(batches):
    held: list[pd.DataFrame] = []
    for pdf in _cut(batches):
        for b, own in pdf.groupby("block", sort=True):
            if held and held[0]["block"].iloc[0] != b:
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(own)
    if held:
        yield pd.concat(held, ignore_index=True)


def tokens_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes (each text's words, then its end), the hash of the token
    before each, and the text's index."""
    hashes, docs = [], []
    for lo in range(0, len(texts), 64):
        some = texts[lo:lo + 64]
        cps, offsets, _ = code_points(some)
        starts, ends, doc = word_spans(cps, offsets)
        h = span_hashes(lower_ascii(cps), starts, ends)
        at = np.searchsorted(doc, np.arange(len(some)), side="right")
        hashes.append(np.insert(h, at, END))
        docs.append(np.insert(doc, at, np.arange(len(some))) + lo)
    h, d = np.concatenate(hashes), np.concatenate(docs)
    before = np.empty_like(h)
    before[0] = START
    before[1:] = np.where(d[1:] == d[:-1], h[:-1], START)
    return h, before, d


def keys_of(h: np.ndarray, before: np.ndarray, first: np.ndarray, range_bits: int) -> list[tuple[np.ndarray, int]]:
    """(keys, bits below the range) of the words, pairs and triples that end at each
    token; a text's first token has no triple (key 0, as all of them)."""
    pairs = mix64(before * np.uint64(0x9E3779B97F4A7C15) + h)
    triples = np.zeros_like(pairs)
    triples[1:] = mix64(pairs[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[1:])
    triples[first] = 0
    keep = min(64, PAIR_BITS + range_bits)
    cut = np.uint64(64 - keep)
    return [(h, WORD_BITS - range_bits), (pairs >> cut, keep - range_bits), (triples >> cut, keep - range_bits)]


class Automaton:
    """The part of the automaton that the n-grams of a block can touch.

    ``words``, ``pairs``, ``triples``: for each token of the block, the number of its
    word, of the pair and of the triple that end at it (in order of first use of the
    distinct ones); ``counts``: corpus counts of the distinct ones."""

    def __init__(self, words, pairs, triples, counts, before_words, before_pairs, texts: int, n: int, v: int):
        c1, c2, c3 = counts
        n_words, n_pairs = len(c1), len(c2)
        self.n_words = n_words
        # one token stands for each distinct pair and triple
        of_pair, of_triple = np.zeros(n_pairs, dtype=np.int64), np.zeros(len(c3), dtype=np.int64)
        at = np.arange(len(words))
        of_pair[pairs], of_triple[triples] = at, at
        # states: 0 the root, then the start of a text, words and pairs seen in training
        self.word_state = np.where(c1 > 0, 2 + np.arange(n_words), 0)
        self.start = 1 if texts else 0
        self.pair_state = np.where(c2 > 0, 2 + n_words + np.arange(n_pairs), self.word_state[words[of_pair]])
        self.root = np.log10((c1 + 1) / (n + v + 1))
        self.failure = np.zeros(2 + n_words + n_pairs)
        self.failure[1:2 + n_words] = math.log10(1 - WORD_WEIGHT)
        self.failure[2 + n_words:] = math.log10(1 - PAIR_WEIGHT)
        self.shorter = np.zeros(2 + n_words + n_pairs, dtype=np.int64)
        self.shorter[2 + n_words:] = self.word_state[words[of_pair]]
        # arcs of word states (and of the start): the pairs seen
        p1 = 10.0 ** self.root
        some = np.flatnonzero(c2 > 0)
        w, u = words[of_pair[some]], before_words[of_pair[some]]
        left = np.where(u >= 0, c1[np.maximum(u, 0)], texts)
        p2 = np.zeros(n_pairs)
        p2[some] = WORD_WEIGHT * c2[some] / left + (1 - WORD_WEIGHT) * p1[w]
        below = np.where(c2 > 0, p2, np.where(self._left(before_words[of_pair], c1, texts) > 0, 1 - WORD_WEIGHT, 1.0) * p1[words[of_pair]])
        from_word = np.where(u >= 0, self.word_state[np.maximum(u, 0)], self.start)
        # arcs of pair states: the triples seen
        many = np.flatnonzero(c3 > 0)
        x = of_triple[many]
        known = before_pairs[x] >= 0  # a text's first token has no pair before it
        many, x = many[known], x[known]
        p3 = PAIR_WEIGHT * c3[many] / c2[before_pairs[x]] + (1 - PAIR_WEIGHT) * below[pairs[x]]
        from_pair = self.pair_state[before_pairs[x]]
        keys = np.concatenate((from_word * n_words + w, from_pair * n_words + words[x]))
        del from_word, from_pair, below, left
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.weight = np.log10(np.minimum(np.concatenate((p2[some], p3)), 1.0))[order]
        self.next = np.concatenate((self.pair_state[some], self.pair_state[pairs[x]]))[order].astype(np.int32)

    @staticmethod
    def _left(before_words, c1, texts):
        return np.where(before_words >= 0, c1[np.maximum(before_words, 0)], texts)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next state, logarithm) of one word in each of many states."""
        total, out = np.zeros(len(state)), np.zeros(len(state), dtype=np.int64)
        todo, now = np.arange(len(state)), state.copy()
        while len(todo):
            root = now == 0
            if root.any():
                i = todo[root]
                total[i] += self.root[word[i]]
                out[i] = self.word_state[word[i]]
                todo, now = todo[~root], now[~root]
                if not len(todo):
                    break
            key = now * self.n_words + word[todo]
            at = np.searchsorted(self.keys, key)
            hit = at < len(self.keys)
            hit[hit] = self.keys[at[hit]] == key[hit]
            i = todo[hit]
            total[i] += self.weight[at[hit]]
            out[i] = self.next[at[hit]]
            todo, now = todo[~hit], now[~hit]
            total[todo] += self.failure[now]
            now = self.shorter[now]
        return out, total

    def traverse(self, words: np.ndarray, offsets: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
        """Sum of the logarithms of each text (``offsets`` cut ``words`` into texts)."""
        sizes = np.diff(offsets)
        lanes = -(-sizes // stretch)
        text = np.repeat(np.arange(len(sizes)), lanes)
        first = offsets[:-1][text] + stretch * (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        stop = np.minimum(first + stretch, offsets[1:][text])
        at = np.maximum(first - 2, offsets[:-1][text])  # the state follows from two words
        state = np.where(at == offsets[:-1][text], self.start, 0)
        sums = np.zeros(len(text))
        live = np.arange(len(text))
        while len(live):
            state[live], gained = self.step(state[live], words[at[live]])
            sums[live] += np.where(at[live] >= first[live], gained, 0.0)
            at[live] += 1
            live = live[at[live] < stop[live]]
        return np.bincount(text, weights=sums, minlength=len(sizes))


def requests(rows: DataFrame, range_bits: int) -> DataFrame:
    """Packed distinct words and pairs of each block, by hash range."""

    def part(batches):
        claim("scoring")
        for block in _whole_blocks(batches):
            h, before, doc = tokens_of(block["text"].tolist())
            teaches = block["train"].to_numpy().astype(np.float64)[doc]
            out = []
            for kind, (keys, low) in enumerate(keys_of(h, before, first_tokens(doc), range_bits)):
                uniq, inv = np.unique(keys, return_inverse=True)
                counts = np.bincount(inv, weights=teaches, minlength=len(uniq)).astype(np.uint64)
                ranges = (uniq >> np.uint64(low)).astype(np.int64) if low < 64 else np.zeros(len(uniq), dtype=np.int64)
                cut = np.flatnonzero(np.diff(ranges)) + 1
                for own, c, r in zip(np.split(uniq, cut), np.split(counts, cut), ranges[np.concatenate(([0], cut))].tolist(),
                                     strict=True):
                    out.append((kind, r, int(block["block"].iloc[0]), len(own),
                                packed(np.concatenate((own[:1], np.diff(own)))), packed(c)))
            yield pd.DataFrame(out, columns=["kind", "part", "block", "n", "keys", "counts"])
        trim()

    return rows.mapInPandas(part, REQUEST)


def answers(asked: DataFrame) -> DataFrame:
    """Corpus counts for every request, in its order; a row without a block
    holds tokens and types of its range."""

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.cumsum(unpacked(k)) for k in pdf["keys"]])
        uniq, inv = np.unique(keys, return_inverse=True)
        total = np.zeros(len(uniq), dtype=np.int64)
        np.add.at(total, inv, np.concatenate([unpacked(c) for c in pdf["counts"]]).astype(np.int64))
        found = np.split(total[inv], np.cumsum(pdf["n"].to_numpy())[:-1])
        kind, r = pdf["kind"].iloc[0], pdf["part"].iloc[0]
        out = pd.DataFrame({"kind": kind, "part": r, "block": pdf["block"].astype("Int64"),
                            "counts": [packed(x.astype(np.uint64)) for x in found], "tokens": 0, "types": 0})
        sums = pd.DataFrame({"kind": [kind], "part": [r], "block": pd.array([None], dtype="Int64"), "counts": [None],
                             "tokens": [int(total.sum())], "types": [int((total > 0).sum())]})
        return pd.concat([out, sums], ignore_index=True)

    return asked.groupBy("kind", "part").applyInPandas(part, ANSWER)


def scored(docs: DataFrame, train: Column) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of (doc_id,
    text); ``train`` says which documents teach.  base_score is the sum of the
    root arcs alone."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(train, F.lit(False)).cast("int").alias("train"))
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"),
                    F.coalesce(F.sum("train"), F.lit(0)).alias("texts")).first()
    range_bits = max(0, (size["chars"] // RANGE_CHARS).bit_length())
    texts = size["texts"]
    found = written(answers(requests(rows.select("text", "train"), range_bits)), "counts")
    sums = found.where("kind = 0 and block is null").agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"),
                                                         F.coalesce(F.sum("types"), F.lit(0)).alias("v")).first()
    n, v = sums["n"], sums["v"]

    def cut(batches):
        for pdf in _cut(batches):
            yield pdf[["block", "doc_id", "text"]]

    def traverse(own: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        claim("scoring")
        m = len(own)
        h, before, doc = tokens_of(own["text"].tolist())
        first = first_tokens(doc)
        counts = counts.sort_values(["kind", "part"], kind="stable")
        corpus, number = [], []
        for kind, (keys, _) in enumerate(keys_of(h, before, first, range_bits)):
            number.append(np.unique(keys, return_inverse=True)[1].astype(np.int32))
            corpus.append(np.concatenate([unpacked(x) for x in counts.loc[counts["kind"] == kind, "counts"]]).astype(np.float64))
        del h, before, keys
        words, pairs, triples = number
        before_words, before_pairs = np.full(len(words), -1, dtype=np.int32), np.full(len(words), -1, dtype=np.int32)
        before_words[1:], before_pairs[1:] = words[:-1], pairs[:-1]
        before_words[first] = before_pairs[first] = -1
        automaton = Automaton(words, pairs, triples, corpus, before_words, before_pairs, texts, n, v)
        c = corpus[0][words]
        return pd.DataFrame({
            "doc_id": own["doc_id"].to_numpy(), "n_tokens": np.bincount(doc, minlength=m),
            "n_known": np.bincount(doc, weights=c > 0, minlength=m).astype(np.int64), "train_tokens": n,
            "base_score": np.bincount(doc, weights=automaton.root[words], minlength=m),
            "score": automaton.traverse(words, np.append(first, len(words)))})

    blocks = rows.select("doc_id", "text").mapInPandas(cut, "block long, doc_id long, text string")
    own = found.where("block is not null").select("block", "kind", "part", "counts")
    return (blocks.groupBy("block").cogroup(own.groupBy("block")).applyInPandas(traverse, SCORES)
            .withColumn("doc_id", null_id()))


def op5_backoff_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of those whose crc32(doc_id) mod 7 is
    not 2 (held_out: it is 2)."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held = F.coalesce(crc_mod("doc_id", 7), F.lit(0)) == 2
    return scored(docs, crc_mod("doc_id", 7) != 2).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct words of a block of the corpus are laid out as one array of byte
tokens.  An inverted index maps each possible merge (the rank of the joined
token) to the positions of its left element; merges are applied in rank order to
all their positions, and only the two touched neighbours get new index entries.
Texts are cut by the public pattern first, so no merge crosses a piece.

Everything is local to a task: no shuffle, the vocabulary (a file of bounded
size) travels with the function, and a worker keeps a bounded table of words, each
compared letter by letter when it is met again.

Defined results: a null or empty text has no ids; an id that is not in the
vocabulary raises; repeated rows are encoded each; very long texts and words are
encoded whole; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

from caprank.llm.common import BATCH_ROWS, CACHES, claim, documents, slices, span_positions, trim, whole_text
from caprank.llm.pieces import WordIds, as_arrays, encode_batch

RANK_FILE = "byte_bpe_multi_50k.tiktoken"

BATCH_CHARS = 250_000


def rank_file(path: str | None = None) -> bytes:
    """Content of a rank file: one line ``base64(token) rank`` per token."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(RANK_FILE)
    with open(path, "rb") as f:
        return f.read()


class MergeReplay:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: bytes):
        self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.token = {r: t for t, r in self.rank.items()}
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int64)
        self.pair = np.full(65536, -1, dtype=np.int64)
        for a in range(256):
            for b in range(256):
                r = self.rank.get(bytes((a, b)))
                if r is not None:
                    self.pair[a * 256 + b] = r
        #: a << 32 | b -> rank of a followed by b, for every way to cut a token into
        #: two tokens: bounded by the vocabulary, unlike a cache of pairs met
        self.joined = {}
        for token, r in self.rank.items():
            for cut in range(1, len(token)):
                a, b = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if a is not None and b is not None:
                    self.joined[a << 32 | b] = r

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word.  A word that is a token itself is that token."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        out = [[r] if (r := self.rank.get(w)) is not None else None for w in raw]
        todo = [i for i, x in enumerate(out) if x is None]
        if todo:
            for i, ids in zip(todo, self.replay([raw[i] for i in todo]), strict=True):
                out[i] = ids
        return out

    def replay(self, words: list[bytes]) -> list[list[int]]:
        data = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        n = len(data)
        ends = np.cumsum([len(w) for w in words])
        starts = ends - [len(w) for w in words]
        right = np.full(n, -1, dtype=np.int64)
        right[:-1] = self.pair[data[:-1] * 256 + data[1:]]
        right[ends - 1] = -1
        after = np.arange(1, n + 1, dtype=np.int64)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1, dtype=np.int64)
        before[starts] = -1
        # inverted index: rank of the pair -> ascending positions
        order = np.argsort(right, kind="stable")
        order = order[np.searchsorted(right[order], 0):]
        ranks, first = np.unique(right[order], return_index=True)
        index = {r: p.tolist() for r, p in zip(ranks.tolist(), np.split(order, first[1:]), strict=True)} if len(order) else {}
        heap = ranks.tolist()
        tok, nxt, prv, pr = self.byte[data].tolist(), after.tolist(), before.tolist(), right.tolist()
        known, push = self.joined.get, heapq.heappush
        while heap:
            r = heapq.heappop(heap)
            places = index.pop(r, None)
            if places is None:
                continue
            places.sort()
            for k, p in enumerate(places):
                if pr[p] != r:
                    continue
                q = nxt[p]
                m = nxt[q]
                tok[p], tok[q], pr[q], nxt[p] = r, -1, -1, m
                lower = False
                if m >= 0:
                    prv[m] = p
                    t = tok[m]
                    x = pr[p] = known(r << 32 | t, -1)
                    if x >= 0:
                        lower = x < r
                        if x in index:
                            index[x].append(p)
                        else:
                            index[x] = [p]
                            push(heap, x)
                else:
                    pr[p] = -1
                o = prv[p]
                if o >= 0:
                    t = tok[o]
                    x = pr[o] = known(t << 32 | r, -1)
                    if x >= 0:
                        lower = lower or x < r
                        if x in index:
                            index[x].append(o)
                        else:
                            index[x] = [o]
                            push(heap, x)
                if lower and k + 1 < len(places):
                    # a merge of a lower rank arose: it goes first, the rest of this rank waits
                    index[r] = places[k + 1:]
                    push(heap, r)
                    break
        flat = np.array(tok, dtype=np.int64)
        live = flat >= 0
        upto = np.concatenate(([0], np.cumsum(live)))
        ids = flat[live].tolist()
        return [ids[a:b] for a, b in zip(upto[starts].tolist(), upto[ends].tolist(), strict=True)]


_LOADED: dict[bytes, tuple[MergeReplay, WordIds]] = {}
CACHES["bpe"] = _LOADED.clear


def loaded(ranks: bytes) -> tuple[MergeReplay, WordIds]:
    """Encoder and word table of this worker for a rank file (one at a time)."""
    claim("bpe")
    key = hashlib.sha256(ranks).digest()
    if key not in _LOADED:
        _LOADED.clear()
        replay = MergeReplay(ranks)
        _LOADED[key] = (replay, WordIds(lambda words: as_arrays(replay.encode_words(words))))
    return _LOADED[key]


def arrow_batches(batches, chars: int):
    """(ids, texts) lists of about ``chars`` characters from Arrow batches."""
    for rb in batches:
        texts = rb.column(1).to_pylist()
        for lo, hi in slices([len(t) for t in texts], chars, BATCH_ROWS):
            yield rb.column(0).slice(lo, hi - lo), texts[lo:hi]
    trim()


def encode(docs: DataFrame, ranks: bytes) -> DataFrame:
    """(doc_id, ids array<int>) of (doc_id, text); null texts as empty."""

    def part(batches):
        _, table = loaded(ranks)
        for doc_ids, texts in arrow_batches(batches, BATCH_CHARS):
            ids, offsets = encode_batch(table, texts)
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))], ["doc_id", "ids"])

    return whole_text(docs).mapInArrow(part, "doc_id long, ids array<int>")


class Decoder:
    """Bytes of token ids by one gather from all tokens laid end to end."""

    def __init__(self, token: dict[int, bytes]):
        self.top = max(token) + 1
        self.lens = np.array([len(token.get(i, b"")) for i in range(self.top)], dtype=np.int64)
        self.offs = np.cumsum(self.lens) - self.lens
        self.store = np.frombuffer(b"".join(token.get(i, b"") for i in range(self.top)), dtype=np.uint8)

    def texts(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Bytes of each text; ``offsets`` (one more than texts) cut ``ids``."""
        ids = ids.astype(np.int64)
        if len(ids) and not ((ids >= 0) & (ids < self.top) & (self.lens[np.clip(ids, 0, self.top - 1)] > 0)).all():
            raise ValueError("an id is not in the vocabulary")
        size = self.lens[ids]
        raw = self.store[span_positions(self.offs[ids], size)].tobytes()
        bounds = np.concatenate(([0], np.cumsum(size)))[offsets]
        return [raw[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """(doc_id, ids, decoded binary): the bytes that the ids stand for; null
    ids give null."""

    def part(batches):
        decoder = Decoder(loaded(ranks)[0].token)
        for rb in batches:
            for lo in range(0, rb.num_rows, 512):
                some = rb.column(1).slice(lo, 512)
                sizes = [0 if c is None else c for c in pa.compute.list_value_length(some).to_pylist()]
                flat = some.flatten().to_numpy(zero_copy_only=False)
                texts = decoder.texts(flat, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64))
                out = [t if v else None for t, v in zip(texts, some.is_valid().to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([rb.column(0).slice(lo, 512), some, pa.array(out, type=pa.binary())],
                                                 ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(part, "doc_id long, ids array<int>, decoded binary")


def digests(docs: DataFrame, ranks: bytes) -> DataFrame:
    """Number of ids and the digests of a round trip for each row of (doc_id,
    text): ``encode`` and ``decode`` in one Python process a task, which keeps the
    ids there."""

    def part(batches):
        replay, table = loaded(ranks)
        decoder = Decoder(replay.token)
        decimal = [b"%d" % i for i in range(decoder.top)]
        for doc_ids, texts in arrow_batches(batches, BATCH_CHARS):
            ids, offsets = encode_batch(table, texts)
            cuts = list(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(np.diff(offsets)),
                 pa.array([hashlib.sha256(b",".join([decimal[i] for i in ids[a:b].tolist()])).hexdigest() for a, b in cuts], pa.string()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in decoder.texts(ids, offsets)], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return whole_text(docs).mapInArrow(part, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, decode the ids, return the digests of both."""
    return digests(documents(spark, sf_dir), rank_file())


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: ids of every row and the digests of the round trip."""
    return digests(docs, rank_file())

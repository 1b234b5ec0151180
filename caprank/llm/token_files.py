"""Token-ID files: range asymmetric numeral coding with static tables.

Documents are range-partitioned and sorted by doc_id.  Each task writes shards of
about ``SHARD_TOKENS`` ids that end at a document.  A shard is one binary value:

    magic, sections (each with its length): numbers, doc ids, ids per document,
    symbols and their frequencies (the table that all blocks of the shard
    share), then the blocks

Blocks of ``BLOCK_TOKENS`` ids are coded on their own: ``LANES`` interleaved states of
63 bits emit 32-bit words.  A block holds its initial states, checkpoints (states
and word offset every ``CHECK_STEPS`` steps, from which decoding can start as well)
and the CRC-32 of its ids, so blocks and their parts decode in parallel and each
is verified.  The shards are rows of a Parquet table, so that Spark's writers and
readers place them in any store and commit them once.

Memory in a task is one shard (or one document, if that is longer).  The order
of the whole is file number, then shard, then document.

Defined results: a null or empty text holds the end id alone; a null doc_id sorts
first; rows that repeat a doc_id follow each other by text; very long texts and words
are encoded whole; an empty table gives no shard; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caprank.llm.common import CACHES, NO_ID, claim, documents, packed, small_side, text_batches, unpacked, with_id, written
from caprank.llm.pieces import WordIds, as_arrays, encode_batch

TOKENIZER_FILE = "byte_bpe_50k.json"
END_ID = 2
MAGIC = b"TOKRANS1"
SHARD_TOKENS, BLOCK_TOKENS, LANES, CHECK_STEPS = 2_000_000, 1 << 20, 4096, 128
PARTITION_CHARS = 16_000_000
#: Characters encoded at once.
BATCH_CHARS = 250_000
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)

SHARDS = "file long, shard int, n_tokens long, data binary"


def quantized(counts: np.ndarray, bits: int) -> np.ndarray:
    """Frequencies of at least 1 that add up to ``2**bits``, near the counts."""
    total = 1 << bits
    f = np.maximum(1, counts.astype(np.float64) * total // counts.sum()).astype(np.int64)
    rest = total - int(f.sum())
    order = np.argsort(-f, kind="stable")
    if rest > 0:
        f[order[0]] += rest
    i = 0
    while rest < 0:
        take = min(-rest, int(f[order[i]]) - max(1, int(f[order[i]]) // 2))
        f[order[i]] -= take
        rest += take
        i = (i + 1) % len(order)
    return f


def encode_block(sym: np.ndarray, freq: np.ndarray, cum: np.ndarray, bits: int, lanes: int, every: int):
    """(initial states, words, checkpoints) of table indexes ``sym``."""
    n = len(sym)
    steps = (n + lanes - 1) // lanes
    x = np.full(lanes, LOW, dtype=np.uint64)
    room = np.uint64(63 - bits)  # a state below freq << (63 - bits) stays below 2**63
    parts: list[np.ndarray] = []
    emitted = 0
    marks = []
    shift = np.uint64(bits)
    for s in range(steps - 1, -1, -1):
        if (s + 1) % every == 0 and s + 1 < steps:
            marks.append((s + 1, emitted, x.copy()))
        at = sym[s * lanes:(s + 1) * lanes]
        f, c = freq[at], cum[at]
        own = x[:len(f)]
        full = own >= (f << room)
        if full.any():
            parts.append((own[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            emitted += len(parts[-1])
            own = np.where(full, own >> WORD, own)
        q = own // f
        x[:len(f)] = (q << shift) + (own - q * f) + c
    words = np.concatenate(parts[::-1]) if parts else np.empty(0, dtype="<u4")
    return x, words, [(s, emitted - e, st) for s, e, st in reversed(marks)]


def decode_block(n: int, states: np.ndarray, words: np.ndarray, slots: np.ndarray, freq: np.ndarray, cum: np.ndarray,
                 bits: int, lanes: int, first_step: int = 0, at: int = 0) -> np.ndarray:
    """Table indexes from ``first_step`` on, given the states there and the
    offset of the next word."""
    out = np.empty(n - first_step * lanes, dtype=np.int64)
    x = states.copy()
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    for s in range(first_step, (n + lanes - 1) // lanes):
        k = min(lanes, n - s * lanes)
        own = x[:k]
        slot = own & mask
        sym = slots[slot]
        own = freq[sym] * (own >> shift) + slot - cum[sym]
        need = own < LOW
        m = int(need.sum())
        if m:
            own[need] = own[need] << WORD | words[at:at + m]
            at += m
        x[:k] = own
        out[(s - first_step) * lanes:(s - first_step) * lanes + k] = sym
    if (x != LOW).any() or at != len(words):
        raise ValueError("a block does not end in its initial state")
    return out


def _section(raw: bytes) -> bytes:
    return struct.pack("<Q", len(raw)) + raw


def write_shard(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, block: int = BLOCK_TOKENS, lanes: int = LANES,
                every: int = CHECK_STEPS) -> bytes:
    """Documents (ids and number of tokens each) and all their tokens."""
    counts = np.bincount(ids) if len(ids) else np.empty(0, dtype=np.int64)
    symbols = np.flatnonzero(counts)
    place = np.zeros(len(counts), dtype=np.int32)
    place[symbols] = np.arange(len(symbols))
    index, counts = place[ids], counts[symbols]
    bits = max(16, int(len(symbols)).bit_length() + 4)
    freq = quantized(counts, bits) if len(symbols) else np.empty(0, dtype=np.int64)
    f = freq.astype(np.uint64)
    cum = np.cumsum(f) - f
    blocks = range(0, len(ids), block)
    out = [MAGIC, _section(struct.pack("<6Q", len(doc_ids), len(ids), bits, lanes, block, len(blocks))),
           _section(zlib.compress(doc_ids.astype("<i8").tobytes(), 1)), _section(packed(lengths)),
           _section(packed(np.concatenate((symbols[:1], np.diff(symbols))).astype(np.int64))), _section(packed(freq))]
    for lo in blocks:
        own = index[lo:lo + block]
        states, words, marks = encode_block(own, f, cum, bits, lanes, every)
        out.append(_section(struct.pack("<3Q", len(own), zlib.crc32(ids[lo:lo + block].astype("<u4").tobytes()), len(marks))
                            + states.astype("<u8").tobytes()
                            + b"".join(struct.pack("<2Q", s, w) + st.astype("<u8").tobytes() for s, w, st in marks)
                            + words.tobytes()))
    return b"".join(out)


def read_shard(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc ids, tokens of each, all tokens); raises on a checksum that fails."""
    if raw[:8] != MAGIC:
        raise ValueError("not a token shard")
    at = 8
    sections = []
    while at < len(raw):
        n = struct.unpack_from("<Q", raw, at)[0]
        sections.append(memoryview(raw)[at + 8:at + 8 + n])
        at += 8 + n
    n_docs, n_ids, bits, lanes, block, n_blocks = struct.unpack("<6Q", sections[0])
    doc_ids = np.frombuffer(zlib.decompress(sections[1]), dtype="<i8")
    lengths = unpacked(bytes(sections[2])).astype(np.int64)
    symbols = np.cumsum(unpacked(bytes(sections[3])))
    freq = unpacked(bytes(sections[4]))
    cum = np.cumsum(freq) - freq
    slots = np.repeat(np.arange(len(freq)), freq.astype(np.int64))
    ids = np.empty(n_ids, dtype="<u4")
    for b, body in enumerate(sections[5:5 + n_blocks]):
        n, crc, marks = struct.unpack_from("<3Q", body, 0)
        states = np.frombuffer(body, dtype="<u8", count=lanes, offset=24)
        words = np.frombuffer(body, dtype="<u4", offset=24 + 8 * lanes + marks * (16 + 8 * lanes)).astype(np.uint64)
        own = symbols[decode_block(n, states, words, slots, freq, cum, bits, lanes)].astype("<u4")
        if zlib.crc32(own.tobytes()) != crc:
            raise ValueError("a block fails its checksum")
        ids[b * block:b * block + n] = own
    return doc_ids, lengths, ids


_TABLES: dict[bytes, WordIds] = {}
CACHES["tokens"] = _TABLES.clear


def _table(tokenizer: str) -> WordIds:
    """Word table of this worker for a tokenizer (content of its json file)."""
    key = hashlib.sha256(tokenizer.encode()).digest()
    if key not in _TABLES:
        _TABLES.clear()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(tokenizer)
        t.encode_special_tokens = True
        _TABLES[key] = WordIds(joined_encoder(lambda texts: [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]))
    return _TABLES[key]


def joined_encoder(encode, at_once: int = 256):
    """Encoder of words (pieces of the pre-tokenizer) that hands the library many of
    them as one text, which costs it far less than a text for each.

    Words are joined by line feeds.  A line feed before a letter, a number or another
    character is a piece of its own, and so it is before a blank that belongs to a
    word; a word with such a character holds no line feed.  So the line feed's id, which
    stands for nothing else, cuts the ids into words again; where their number does not
    come out, and for words of white space alone, each word is encoded by itself."""
    feed = encode(["\n"])[0]

    def words_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        offs, lens = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        parts, used = [], 0
        plain = [i for i, w in enumerate(words) if len(feed) == 1 and not w.isspace() and "\n" not in w]
        groups = [plain[k:k + at_once] for k in range(0, len(plain), at_once)]
        for group, found in zip(groups, encode(["\n" + "\n".join([words[i] for i in g]) for g in groups]), strict=True):
            ids = np.array(found, dtype=np.int32)
            cuts = np.flatnonzero(ids == feed[0])
            if len(cuts) == len(group) and cuts[0] == 0:
                offs[group], lens[group] = used + cuts + 1, np.diff(np.append(cuts, len(ids))) - 1
                parts.append(ids)
                used += len(ids)
        rest = np.flatnonzero(lens == 0).tolist()
        if rest:
            flat, o, n = as_arrays(encode([words[i] for i in rest]))
            offs[rest], lens[rest] = used + o, n
            parts.append(flat)
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.int32), offs, lens

    return words_of


def tokenizer_file(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER_FILE)
    with open(path, encoding="utf-8") as f:
        return f.read()


def write_shards(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Shards (file, shard, n_tokens, data) of (doc_id, text)."""
    rows = with_id(docs)
    chars = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    ordered = (rows.repartitionByRange(max(1, -(-chars // PARTITION_CHARS)), "doc_id").sortWithinPartitions("doc_id", "text"))

    def part(batches):
        file, shard = TaskContext.get().partitionId(), 0
        table = _table(tokenizer)
        doc_ids, lengths, tokens = [], [], []

        def out():
            ids = np.concatenate(tokens)
            return pd.DataFrame({"file": [file], "shard": [shard], "n_tokens": [len(ids)],
                                 "data": [write_shard(np.array(doc_ids, dtype=np.int64), np.array(lengths, dtype=np.int64), ids)]})

        held = 0
        for some, texts in text_batches(batches, BATCH_CHARS, owner="tokens"):
            ids, offsets = encode_batch(table, texts)
            tokens.append(np.insert(ids, offsets[1:], end_id))
            doc_ids += some
            lengths += (np.diff(offsets) + 1).tolist()
            held += len(tokens[-1])
            if held >= SHARD_TOKENS:
                yield out()
                shard, held = shard + 1, 0
                doc_ids, lengths, tokens = [], [], []
        if doc_ids:
            yield out()

    return ordered.mapInPandas(part, SHARDS)


def read_shards(shards: DataFrame) -> DataFrame:
    """(file, shard, doc_id, at, n_tokens, ids array<int>): documents of the
    shards, ``at`` counting the ids before it in its shard."""

    def part(batches):
        claim("token reader")
        for pdf in batches:
            for f, s, raw in zip(pdf["file"], pdf["shard"], pdf["data"], strict=True):
                doc_ids, lengths, ids = read_shard(raw)
                first = np.cumsum(lengths) - lengths
                for lo in range(0, len(doc_ids), 2000):
                    a, b = first[lo:lo + 2000], lengths[lo:lo + 2000]
                    d = doc_ids[lo:lo + 2000]
                    yield pd.DataFrame({"file": f, "shard": s, "doc_id": pd.Series(d).astype("Int64").mask(d == NO_ID), "at": a,
                                        "n_tokens": b, "ids": [ids[x:x + y].view("<i4") for x, y in zip(a.tolist(), b.tolist(), strict=True)]})

    return shards.select("file", "shard", "data").mapInPandas(
        part, "file long, shard int, doc_id long, at long, n_tokens long, ids array<int>")


def doc_index(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the shards alone: the ids of a
    document never leave the task that decodes them."""

    def part(batches):
        claim("token reader")
        for pdf in batches:
            for f, s, raw in zip(pdf["file"], pdf["shard"], pdf["data"], strict=True):
                doc_ids, lengths, ids = read_shard(raw)
                first = np.cumsum(lengths) - lengths
                view = memoryview(ids.tobytes())
                yield pd.DataFrame({"file": f, "shard": s, "doc_id": pd.Series(doc_ids).astype("Int64").mask(doc_ids == NO_ID),
                                    "at": first, "n_tokens": lengths,
                                    "ids_crc32": [zlib.crc32(view[4 * x:4 * (x + y)]) for x, y in
                                                  zip(first.tolist(), lengths.tolist(), strict=True)]})

    docs = shards.select("file", "shard", "data").mapInPandas(
        part, "file long, shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    earlier = Window.unboundedPreceding, -1
    sizes = shards.select("file", "shard", "n_tokens")
    files = sizes.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    files = files.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(*earlier)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file").orderBy("shard").rowsBetween(*earlier)
    starts = (sizes.withColumn("b", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(files, "file")
              .select(F.col("file").alias("f"), F.col("shard").alias("s"), (F.col("before") + F.col("b")).alias("b")))
    starts = small_side(written(starts, "starts"))
    return docs.join(starts, (F.col("file") == F.col("f")) & (F.col("shard") == F.col("s"))).select(
        "doc_id", (F.col("b") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of all documents as shards, read them back, and return
    place, length and checksum of every document."""
    return doc_index(written(write_shards(documents(spark, sf_dir), tokenizer_file()), "token-shards"))

"""Helpers shared by the corpus operators: shared-folder tables, size-checked
broadcasts, exact-copy collapsing and numpy views of text batches.

Conventions of every operator here: ``doc_id`` identifies a document, a null
text counts as the empty text, other columns are ignored (each operator selects
what it needs first, so clashing names of extra columns cannot disturb it), and
an empty table gives an empty result.  Null ids travel through Python as
``NO_ID``, because a column of integers with nulls would arrive as floats.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caprank.session import ensure_checkpoint_dir, ship_package

#: Largest id set that is broadcast (16 bytes an id in the hash relation);
#: beyond it the same join runs as a shuffle join.
BROADCAST_IDS = 2_000_000

#: Target size of one in-memory text batch inside a task, in characters.
BATCH_CHARS = 250_000

#: Most texts of one in-memory batch, however short they are.
BATCH_ROWS = 4096

#: Word separators of every contract: space and U+0009 to U+000D.
WORD_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


#: What operators keep in a Python worker between tasks: name -> function that
#: frees it.  Workers outlive a stage, so the next operator frees the others' tables.
CACHES: dict[str, Callable[[], None]] = {}


_OWNER = ""
#: Memory blocks from this size on are mapped on their own, so that freeing them gives
#: them back (by default the bound grows, and freed arrays stay with the process).
MAPPED = 1 << 20
#: A larger bound for operators that need little memory: mapping costs them time.
MAPPED_BY = {"tokens": 1 << 23, "bpe": 1 << 23}


def _libc():
    """The C library, or None where it has other names for these calls."""
    with contextlib.suppress(OSError, AttributeError):
        lib = ctypes.CDLL(None)
        if lib.malloc_trim and lib.mallopt:
            return lib
    return None


def trim() -> None:
    """Give freed memory back to the system: idle Python workers stay alive beside
    those of the next stage."""
    lib = _libc()
    if lib is not None:
        lib.malloc_trim(0)


def claim(owner: str) -> None:
    """Called in a task before work: if another operator worked in this process
    before, its tables are freed and the freed memory goes back to the system."""
    global _OWNER
    if owner == _OWNER:
        return
    lib = _libc()
    if lib is not None:
        lib.mallopt(-3, MAPPED_BY.get(owner, MAPPED))  # M_MMAP_THRESHOLD
    _OWNER = owner
    for name, free in CACHES.items():
        if name != owner:
            free()
    gc.collect()
    trim()


#: Arrow batches between the JVM and Python hold at most this many bytes.
ARROW_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Ship the package to the workers, and keep Arrow batches of whole texts
    small (the default, 64 MB, is several times that as Python objects)."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) == "67108864b":
        spark.conf.set(key, str(ARROW_BYTES))


def release(spark: SparkSession) -> None:
    """Let go of finished work: shuffle files are removed once neither Python nor the
    driver's JVM refers to their plans, and both collect rarely on their own."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Scopes that are open: paths of the tables written in each.
_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def temporary(spark: SparkSession):
    """Tables written inside are deleted at the end, but for those written with
    ``keep``: only these may be read by what leaves the scope (a scope around it
    deletes them in turn)."""
    _SCOPES.append([])
    try:
        yield
    finally:
        hadoop = spark._jvm.org.apache.hadoop.fs
        for path in _SCOPES.pop():
            p = hadoop.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: cuts the lineage at a place every executor can read again."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    scopes = _SCOPES[:-1] if keep else _SCOPES  # what one scope keeps, the one around it may drop
    if scopes:
        scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = BROADCAST_IDS) -> DataFrame:
    """Broadcast hint for a materialised frame only if it has at most
    ``max_rows`` rows; otherwise the join stays a shuffle join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def whole_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with null texts as empty ones."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


#: Stands for a null doc_id inside Python code.
NO_ID = -(1 << 63)


def with_id(docs: DataFrame) -> DataFrame:
    """(doc_id, text) for Python code: no nulls in either."""
    return whole_text(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))


def null_id() -> Column:
    """doc_id with ``NO_ID`` turned into null again."""
    return F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id")


def crc_mod(col: str, mod: int) -> Column:
    """crc32 of the id as decimal text, modulo ``mod``; null ids give null."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % mod


def text_batches(batches, chars: int = BATCH_CHARS, rows: int = BATCH_ROWS, owner: str = "texts"):
    """Regroup Arrow/pandas batches (first column id, second text) into lists
    (ids, texts) of about ``chars`` characters and at most ``rows`` texts; one
    longer text is one batch.  Tables that other operators than ``owner`` left in
    this worker are freed."""
    claim(owner)
    ids: list = []
    texts: list = []
    n = 0
    for pdf in batches:
        for i, t in zip(pdf.iloc[:, 0].tolist(), pdf.iloc[:, 1].tolist(), strict=True):
            t = "" if t is None else t
            if ids and (n + len(t) > chars or len(ids) >= rows):
                yield ids, texts
                ids, texts, n = [], [], 0
            ids.append(i)
            texts.append(t)
            n += len(t)
    if ids:
        yield ids, texts
        ids = texts = []
    trim()


def slices(sizes: list[int], chars: int, rows: int):
    """Bounds (lo, hi) of consecutive items, at most ``rows`` of them and about
    ``chars`` in all."""
    lo = n = 0
    for i, size in enumerate(sizes):
        if i > lo and (n + size > chars or i - lo >= rows):
            yield lo, i
            lo, n = i, 0
        n += size
    if lo < len(sizes):
        yield lo, len(sizes)


def unused(frame: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``frame`` has in any case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, str]:
    """Code points of the concatenation, document offsets (len + 1) and the
    concatenated string."""
    joined = "".join(texts)
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return cps, offsets, joined


def utf8_bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the concatenation and document offsets (len + 1)."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return np.frombuffer(b"".join(parts), dtype=np.uint8), offsets


def mix64(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift multiply), element-wise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_POWERS = np.ones(1, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 64), _BASE, dtype=np.uint64)
        steps[0] = 1
        _POWERS = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def span_positions(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """All places of the spans of ``lens`` from ``starts`` on, one after another."""
    first = np.cumsum(lens) - lens
    return np.repeat(starts - first, lens) + np.arange(int(lens.sum()), dtype=np.int64)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each span [start, end) of ``values``; the spans are
    sorted, disjoint and not empty.  Equal spans have equal hashes.  Each value is
    mixed with its place before the sum, which a plain polynomial does not do: its
    sums collide for whole families of words whatever the base."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    total = int(lens.sum())
    at = np.arange(total, dtype=np.int64) - np.repeat(first, lens)
    inside = values[np.repeat(starts, lens) + at] if total != len(values) else values
    terms = (inside.astype(np.uint64) + np.uint64(1)) * _powers(int(lens.max()))[at]
    terms ^= terms >> np.uint64(29)
    terms *= np.uint64(0xBF58476D1CE4E5B9)
    terms ^= terms >> np.uint64(32)
    sums = np.add.reduceat(terms, first)
    return mix64(sums ^ (lens.astype(np.uint64) << np.uint64(40)))


_SPACE = np.zeros(0x110000, dtype=bool)
_SPACE[list(WORD_SPACE)] = True


def word_spans(cps: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document index of the maximal runs of characters other
    than space and U+0009-U+000D; no word crosses a document border."""
    n = len(cps)
    if not n:
        e = np.empty(0, dtype=np.int64)
        return e, e, e
    word = ~_SPACE[cps]
    border = np.zeros(n + 1, dtype=bool)
    border[offsets] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = word[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | border[:-1]))
    ends = np.flatnonzero(word & (~after | border[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def lower_ascii(cps: np.ndarray) -> np.ndarray:
    """A-Z to a-z, everything else unchanged."""
    out = cps.copy()
    out[(cps >= 65) & (cps <= 90)] += 32
    return out


def packed(x: np.ndarray) -> bytes:
    """Unsigned integers with as many bytes each as the largest needs."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zlib.compress(planes.tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw[1:]), dtype=np.uint8).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :raw[0]] = planes.T
    return out.reshape(-1).view("<u8").astype(np.uint64)


def text_sha() -> Column:
    """Digest of a row's text (null: that of the empty text)."""
    return F.sha2(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8"), 256)


def exact_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, sha, n_rows, rep), one row for each doc_id that is not
    null: ``rep`` is the smallest doc_id with the same text, ``n_rows`` the number of
    rows with this doc_id.  Of several texts under one doc_id the one with the
    smallest digest counts.  Only ids and digests are shuffled; the group of copies
    is reduced by a combining aggregate, so a text that a third of all rows carry is
    no hot task."""
    d = whole_text(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), text_sha().alias("sha"))
    d = (d.where("doc_id is not null").groupBy("doc_id")
         .agg(F.min(F.struct("sha", "n_bytes")).alias("x"), F.count("*").alias("n_rows"))
         .select("doc_id", "x.n_bytes", "x.sha", "n_rows"))
    d = written(d, "digests")
    firsts = d.groupBy(F.col("sha").alias("s")).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    firsts = written(firsts.where("n > 1").select("s", "rep"), "copies")
    return (d.join(small_side(firsts, BROADCAST_IDS // 4), d.sha == firsts.s, "left")
            .select("doc_id", "n_bytes", "sha", "n_rows", F.coalesce("rep", "doc_id").alias("rep")))


def repeated_ids(copies: DataFrame) -> DataFrame | None:
    """(doc_id, sha) of the ids that several rows have, or None if all differ."""
    some = copies.where("n_rows > 1").select("doc_id", "sha")
    return None if some.isEmpty() else some


def counted_texts(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """(doc_id, text), one row for each doc_id: the text that ``exact_copies``
    chose.  Only rows of ids that repeat are looked at twice."""
    d = whole_text(docs).where("doc_id is not null")
    several = repeated_ids(copies)
    if several is None:
        return d
    several = small_side(several)
    own = (d.withColumn("sha", text_sha()).join(several, ["doc_id", "sha"], "left_semi").dropDuplicates(["doc_id"])
           .select("doc_id", "text"))
    return d.join(several, "doc_id", "left_anti").unionByName(own)


def first_copies(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents that are their own representative;
    null ids are left out."""
    later = copies.where("doc_id <> rep").select("doc_id")
    return counted_texts(docs, copies).join(small_side(later), "doc_id", "left_anti")

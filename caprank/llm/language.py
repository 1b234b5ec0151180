"""Language identification with hyperdimensional profiles.

Each letter owns a random vector of +1/-1.  A letter trigram ``abc`` is bound as
``rot2(A) * rot1(B) * C``; a text is the bundle (sum) of its trigram vectors, and
a language prototype is the bundle of all its training texts.  A text gets the
language whose prototype has the largest cosine with its own bundle.

Letter vectors are a pure function of the code point, so nothing is shipped
but the prototypes: one vector of ``dim`` doubles for each language.  Training
is one pass whose tasks each emit one partial bundle per language.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
with no training text at all everything is ``und``; equal cosines go to the
smaller language code.  Very long texts are bundled whole (counts of distinct
trigrams, never a prefix).  Rows that repeat an id, or have none, are each judged by
their own text; an empty table has no rows; other columns are ignored by the
operator and kept by the stage.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caprank.llm.common import (BROADCAST_IDS, CACHES, code_points, crc_mod, documents, null_id, small_side, temporary, text_batches,
                                text_sha, unused, with_id, written)

DIM = 1024
SEED = 20_231
UNKNOWN = "und"
#: Of the median score of labelled texts of a size, how many of them it takes, and
#: the fewest trigrams at which clean texts and letter noise differ.
LEVEL, LEVEL_TEXTS, LEVEL_TRIGRAMS = 0.22, 20, 32

_LETTER: np.ndarray | None = None
_VECTORS: dict[int, np.ndarray] = {}
CACHES["language"] = _VECTORS.clear
#: Letter vectors that a worker keeps (4 kB each), and most texts bundled at once.
VECTORS, BUNDLE_ROWS, BUNDLE_CHARS = 4096, 512, 1_000_000


def letter_table() -> np.ndarray:
    """True for each code point that is a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER


def letter_vector(cp: int, dim: int, seed: int) -> np.ndarray:
    key = cp * 65_536 + dim
    v = _VECTORS.get(key)
    if v is None:
        if len(_VECTORS) >= VECTORS:
            _VECTORS.clear()
        rng = np.random.Generator(np.random.PCG64([seed, cp]))
        v = _VECTORS[key] = (rng.integers(0, 2, dim, dtype=np.int8) * 2 - 1).astype(np.float32)
    return v


def bundles(texts: list[str], dim: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bundle of each text (n x dim), its number of letters and of trigrams."""
    n = len(texts)
    cps, offsets, _ = code_points([t.lower() for t in texts])
    letters, trigrams = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    out = np.zeros((n, dim), dtype=np.float32)
    if not len(cps):
        return out, letters, trigrams
    isl = letter_table()[cps]
    run = np.concatenate(([0], np.cumsum(isl)))
    letters[:] = run[offsets[1:]] - run[offsets[:-1]]
    # one space for each run of other characters and around each document
    doc = np.repeat(np.arange(n), np.diff(offsets))
    keep = isl.copy()
    keep[1:] |= ~isl[1:] & isl[:-1]
    sym = np.where(isl, cps, 32)[keep]
    doc = doc[keep]
    alphabet, ids = np.unique(sym, return_inverse=True)
    if len(sym) < 3:
        return out, letters, trigrams
    k = len(alphabet)
    code = (ids[:-2].astype(np.int64) * k + ids[1:-1]) * k + ids[2:]
    same = doc[:-2] == doc[2:]
    code, doc = code[same], doc[:-2][same]
    grams, at = np.unique(code, return_inverse=True)
    if not len(grams):
        return out, letters, trigrams
    base = np.stack([letter_vector(int(c), dim, seed) for c in alphabet])
    bounds = np.searchsorted(doc, np.arange(n + 1))
    trigrams = np.diff(bounds)
    step = 4096
    for lo in range(0, len(grams), step):
        g = grams[lo:lo + step]
        vec = (np.roll(base, 2, axis=1)[g // (k * k)] * np.roll(base, 1, axis=1)[g // k % k] * base[g % k])
        inside = (at >= lo) & (at < lo + step)
        counts = np.zeros((n, len(g)), dtype=np.float32)
        for d in range(n):
            a = at[bounds[d]:bounds[d + 1]][inside[bounds[d]:bounds[d + 1]]]
            if len(a):
                counts[d] = np.bincount(a - lo, minlength=len(g))
        out += counts @ vec
    return out, letters, trigrams


def prototypes(train: DataFrame, dim: int = DIM, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their bundles from (text, lang) rows; rows with a
    null text or language teach nothing.  One ``dim`` vector per language
    reaches the driver; the number of languages is that of the label set."""

    def part(batches):
        sums: dict[str, np.ndarray] = {}
        for langs, texts in text_batches(batches, BUNDLE_CHARS, BUNDLE_ROWS, "language"):
            vecs, letters, _ = bundles(texts, dim, seed)
            for i, lang in enumerate(langs):
                if letters[i]:
                    sums[lang] = sums.get(lang, 0) + vecs[i].astype(np.float64)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "v": [x.tolist() for x in sums.values()]})

    rows = (train.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
            .select(F.col("lang").cast("string").alias("lang"), "text")
            .mapInPandas(part, "lang string, v array<double>"))
    summed = (rows.select("lang", F.posexplode("v").alias("i", "x"))
              .groupBy("lang", "i").agg(F.sum("x").alias("x"))
              .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))
              .select("lang", F.col("v.x").alias("v")).orderBy("lang").collect())
    langs = [r["lang"] for r in summed]
    protos = np.array([r["v"] for r in summed], dtype=np.float64).reshape(len(langs), dim)
    norms = np.linalg.norm(protos, axis=1, keepdims=True)
    return langs, protos / np.where(norms > 0, norms, 1)


def predictions(texts: list[str], langs: list[str], protos: np.ndarray, seed: int):
    """(language, score, trigrams) of each text."""
    if not langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
    vecs, letters, trigrams = bundles(texts, protos.shape[1], seed)
    v = vecs.astype(np.float64)
    norms = np.linalg.norm(v, axis=1)
    cos = (v @ protos.T) / np.where(norms > 0, norms, 1)[:, None]
    best = cos.argmax(axis=1)
    score = np.clip(cos[np.arange(len(texts)), best], 0.0, 1.0)
    pred = [langs[b] if n else UNKNOWN for b, n in zip(best, letters, strict=True)]
    return pred, np.where(letters > 0, score, 0.0), trigrams


def identify(docs: DataFrame, langs: list[str], protos: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, lang_pred, score, trigrams): score is the cosine with the best
    prototype, negative values as 0."""

    def part(batches):
        for ids, texts in text_batches(batches, BUNDLE_CHARS, BUNDLE_ROWS, "language"):
            pred, score, trigrams = predictions(texts, langs, protos, seed)
            yield pd.DataFrame({"doc_id": ids, "lang_pred": pred, "score": score, "trigrams": trigrams})

    return (with_id(docs).mapInPandas(part, "doc_id long, lang_pred string, score double, trigrams long")
            .select(null_id(), "lang_pred", "score", "trigrams"))


def judged_texts(docs: DataFrame, langs: list[str], protos: np.ndarray, seed: int = SEED) -> DataFrame:
    """(sha, labelled, lang, score, trigrams) of each row of (text, lang): a text is
    known by its digest, so rows that share an id, or have none, stay apart, and
    the texts themselves go no further."""

    def part(batches):
        for labelled, texts in text_batches(batches, BUNDLE_CHARS, BUNDLE_ROWS, "language"):
            pred, score, trigrams = predictions(texts, langs, protos, seed)
            yield pd.DataFrame({"sha": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts],
                                "labelled": labelled, "lang": pred, "score": score, "trigrams": trigrams})

    return (docs.select(F.col("lang").isNotNull().alias("labelled"), F.coalesce("text", F.lit("")).alias("text"))
            .mapInPandas(part, "sha string, labelled boolean, lang string, score double, trigrams long"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those whose crc32(doc_id) mod 3
    is not 1 (held_out: it is 1)."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    train = docs.where(crc_mod("doc_id", 3) != 1)
    langs, protos = prototypes(train)
    return identify(docs, langs, protos).select(
        "doc_id", (F.coalesce(crc_mod("doc_id", 3), F.lit(0)) == 1).alias("held_out"), "lang_pred", "score")


def levels(scores: DataFrame) -> list[tuple[int, float]]:
    """(smallest number of trigrams, lowest score that stays), ascending, from the
    (score, trigrams) of labelled texts: ``LEVEL`` of the median score of each power
    of two of trigrams.  One with fewer than ``LEVEL_TEXTS`` texts takes the level
    of the next shorter one, or rejects nothing, as do texts of fewer than
    ``LEVEL_TRIGRAMS``: short clean ones score as low as noise."""
    size = F.floor(F.log2("trigrams"))
    rows = (scores.where(F.col("trigrams") >= LEVEL_TRIGRAMS).groupBy(size.alias("size"))
            .agg(F.count("*").alias("n"), F.percentile_approx("score", 0.5).alias("middle")).collect())
    return sorted((2 ** int(r["size"]), LEVEL * r["middle"]) for r in rows if r["n"] >= LEVEL_TEXTS)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: drop the documents that have no language: null text, no
    letter, or a score under the level of their number of trigrams (letter noise).
    Prototypes and levels are learnt from the labelled texts of the stage's own
    input; without one, only texts without a letter go.  Each row is judged on its
    own text, whatever its id."""
    langs, protos = prototypes(docs.select("text", "lang"))
    if not langs:
        return docs.where(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    name = unused(docs, "text_digest")
    with temporary(spark):
        judged = written(judged_texts(docs, langs, protos), "judged")
        level = F.lit(0.0)
        for least, lowest in levels(judged.where("labelled").select("score", "trigrams")):
            level = F.when(F.col("trigrams") >= least, F.lit(lowest)).otherwise(level)
        gone = judged.where((F.col("lang") == UNKNOWN) | (F.col("score") < level)).select(F.col("sha").alias(name)).distinct()
        gone = small_side(written(gone, "rejected", keep=True), BROADCAST_IDS // 4)
    return docs.withColumn(name, text_sha()).join(gone, name, "left_anti").select(docs.columns)

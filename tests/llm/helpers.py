"""Small documents with every awkward case, and plain Python versions."""

import collections
import re

PASSAGE = "the quick brown fox jumps over the lazy dog while seventeen patient herons watch from the reeds near the old mill"
LONG = " ".join(f"word{i % 977} item{i % 1013}" for i in range(30_000))
NEAR = " ".join(f"alpha{i} beta{i} gamma{i}" for i in range(40))

TEXTS = [
    (1, "Hello world, this is a first small text about nothing in particular.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, "   \n\t ", "de", None),
    (5, PASSAGE + " and so on", "en", "a"),
    (6, "Some other start. " + PASSAGE, "en", "b"),
    (7, PASSAGE + " and so on", "en", "a"),
    (8, NEAR, "en", "a"),
    (9, NEAR.replace("alpha3 ", "delta3 "), "en", "c"),
    (10, NEAR.upper(), "en", "c"),
    (11, "123 456 !!! ---", "xx", "c"),
    (12, "größe schön straße müde", "de", "a"),
    (13, "größe schön straße müde", "de", "a"),
    (14, LONG, "en", "a"),
    (15, "one two three", "en", "b"),
    (16, "one two three", "en", "b"),
    (17, "漢字 and 😀 emoji é é", None, ""),
    (18, "x" * 5000, "en", "a"),
    (19, "same line\nsame line\n\nother line\nsame line", "en", "a"),
    (20, "don't I'll we've 'tis it's  two  spaces\n\n\n three's", "en", "b"),
]


def docs(spark, rows=None, extra=True):
    """documents with extra columns whose names the operators use inside."""
    rows = TEXTS if rows is None else rows
    d = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows],
                              "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        from pyspark.sql import functions as F

        for name in ("h", "n", "block", "rep", "word", "c", "start", "size", "component", "score", "words", "copies", "g"):
            d = d.withColumn(name, F.lit("clash"))
    return d


def empty(spark):
    return docs(spark, [])


def with_nulls(spark):
    """Some null ids, a repeated row and a repeated id with another text."""
    return docs(spark, [*TEXTS, (None, "text without an id, rather long so that it has words", "en", "a"), (None, None, None, None),
                        TEXTS[0], (5, "another text under a used id", "en", "a")])


def words(text, lower=True):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text):
    w = words(text)
    if len(w) >= 5:
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    return frozenset([tuple(w)]) if w else frozenset()


def brute_groups(rows):
    """doc_id -> (set size, smallest linked doc_id) from all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def brute_repeats(rows, length=50):
    """doc_id -> (bytes, covered flags) by the rule on 50-byte strings."""
    first, out = {}, {}
    for i, t in sorted(rows):
        raw = (t or "").encode()
        flags = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if first.setdefault(raw[p:p + length], i) < i:
                flags[p:p + length] = b"\1" * length
        out[i] = (raw, flags)
    return out


def kept_bytes(raw, flags):
    return bytes(b for b, f in zip(raw, flags, strict=True) if not f)


def n_spans(flags):
    return sum(1 for k, f in enumerate(flags) if f and (k == 0 or not flags[k - 1]))


def counts(rows, train):
    uni, pair, texts = collections.Counter(), collections.Counter(), 0
    for i, t in rows:
        if train(i):
            texts += 1
            tokens = words(t) + [""]
            uni.update(tokens)
            pair.update(zip(["<s>", *tokens], tokens, strict=False))
    return uni, pair, texts

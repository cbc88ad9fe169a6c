"""Spelling variants: words one edit apart, grouped under their most frequent form, by PartEnum signatures.

A word's letter multiset is a binary vector with one dimension for each copy of a letter (e1, e2, t1 ...). One inserted,
deleted or replaced code point changes at most two of these, so near words have vectors at Hamming distance at most 2.
PartEnum finds all such pairs exactly: the dimensions are partitioned into ``PIECES`` pieces; two differing dimensions
touch at most two pieces, so of all ways to leave two pieces out one leaves equal projections. Each word enumerates its
projections as signatures, signatures are equi-joined, and a pair is kept if its edit distance is 1.

Letter multisets alone leave many anagrams in a group. Words of at least ``2 * END`` code points that are one edit apart
also share their first or their last ``END`` code points, so each signature is made twice, once with either end: that
loses no pair. A pair is taken in the first signature it shares only, a test on columns, so no distinct is needed.

Counting words runs in tasks over blocks of texts; all else is joins and aggregates. The join reads a group's words
side by side and never writes its pairs; only verified links leave it. The joins are merge joins at every size, as a
compressed table of words is many times as large in the memory of a driver that would broadcast it.

Defined results: NULL and empty texts have no words. A NULL doc_id reads as the empty string. Rows with the same doc_id
and repeated rows all count. Ties between forms go to the smaller word in code-point order. Extra columns are ignored. An empty
table gives no rows. ``spelling_report`` runs jobs when called: it writes words, links and roots to the shared folder.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import bounded_batches, rewritten

MIN_CHARS, MIN_COUNT = 6, 5
#: A form occurs at least so many times as often as its variant.
RATIO = 5
#: The contract's simulated misspelling: one occurrence group (document, word) in so many loses a code point.
SLIP = 199
PIECES, END = 4, 3
#: Distinct words that a task holds before it hands their counts on.
HELD = 200_000

#: Latin-1 bytes: A-Z to a-z, letters a-z and 0xC0-0xFF as they are, all else a space.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """The text's runs of letters, A-Z lower-cased, in Latin-1 (one byte a code point)."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def slipped(words: list[bytes], doc_id: str, every: int) -> list[tuple[bytes, bytes]]:
    """(word, word less a code point) of the words that the hash of id and word selects."""
    start = zlib.crc32(f"{doc_id}:".encode())
    out = []
    for w in set(words):
        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
        if not h % every:
            at = h % len(w)
            out.append((w, w[:at] + w[at + 1:]))
    return out


def word_counts(docs: DataFrame, slip: int = 0, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) over all whole texts; with ``slip``, after the simulated misspelling."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            kept = {w.decode("latin-1"): n for w, n in counts.items() if n and len(w) >= min_chars}
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(kept.keys(), pa.string()), pa.array(kept.values(), pa.int64())],
                                              names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                words = words_of(text.as_py() or "")
                counts.update(words)
                for w, short in slipped(words, doc_id.as_py() or "", slip) if slip else ():
                    n = words.count(w)
                    counts[w] -= n
                    counts[short] += n
                if len(counts) >= HELD:
                    yield out()
        if counts:
            yield out()

    each = docs.select(F.col("doc_id").cast("string"), F.col("text")).mapInArrow(run, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- signatures -----------------------------------------------------------

def pieces(word: str, n: int = PIECES) -> list[int]:
    """Hash of the word's multiset in each piece: the copies of a letter are dealt to the pieces by letter and number."""
    held: list[list[str]] = [[] for _ in range(n)]
    seen: Counter = Counter()
    for letter in sorted(word):
        seen[letter] += 1
        held[(7 * ord(letter) + seen[letter]) % n].append(letter)
    return [zlib.crc32(f"{i}{''.join(h)}".encode()) for i, h in enumerate(held)]


def signatures(words: DataFrame, n: int = PIECES) -> DataFrame:
    """(sig, first, a, b, word, n, pieces): a row for each end and each pair (a, b) of pieces kept; ``first`` is 1 where the
    end is the word's beginning."""
    kept = list(combinations(range(n), n - 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in ("sig", "first", "kept", "word", "n", "pieces")}
            for word, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                p = pieces(word, n)
                for first, end in ((1, word[:END]), (0, word[-END:])):
                    for k, keep in enumerate(kept):
                        rows["sig"].append(f"{first}{k}{end}{','.join(str(p[i]) for i in keep)}")
                        rows["first"].append(first)
                        rows["kept"].append(keep)
                        rows["word"].append(word)
                        rows["n"].append(count)
                        rows["pieces"].append(p)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["sig"], pa.string()), pa.array(rows["first"], pa.int32()),
                 pa.array(rows["kept"], pa.list_(pa.int32())), pa.array(rows["word"], pa.string()),
                 pa.array(rows["n"], pa.int64()), pa.array(rows["pieces"], pa.list_(pa.int64()))], names=list(rows))

    made = words.mapInArrow(run, "sig string, first int, kept array<int>, word string, n long, pieces array<long>")
    return made.withColumn("sig", F.xxhash64("sig"))


def links(words: DataFrame, n: int = PIECES) -> DataFrame:
    """(u, nu, v, nv): every pair of words u < v at edit distance 1, once."""
    s = signatures(words, n)
    a = s.select("sig", "first", "kept", F.col("word").alias("u"), F.col("n").alias("nu"), F.col("pieces").alias("pu"))
    b = s.select("sig", F.col("word").alias("v"), F.col("n").alias("nv"), F.col("pieces").alias("pv"))
    earlier = F.col("first") == 1
    same_start = F.left("u", F.lit(END)) == F.left("v", F.lit(END))
    # the kept pieces are the first n - 2 equal ones: no other piece before the last kept one is equal
    spare = F.forall(F.sequence(F.lit(0), F.element_at("kept", -1)), lambda i: F.array_contains("kept", i)
                     | (F.get("pu", i) != F.get("pv", i)))
    # a merge join by name: from the file size of the words a table of signatures looks small enough to broadcast
    return a.join(b.hint("merge"), (a["sig"] == b["sig"]) & (F.col("u") < F.col("v")) & (earlier | ~same_start)
                  & (F.levenshtein("u", "v", 1) == 1) & spare).select("u", "nu", "v", "nv")


# ---- forms and roots ------------------------------------------------------

def forms(words: DataFrame, near: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word."""
    ends = F.array(F.struct(F.col("u").alias("word"), F.col("v").alias("other"), F.col("nv").alias("m")),
                   F.struct(F.col("v").alias("word"), F.col("u").alias("other"), F.col("nu").alias("m")))
    both = near.select(F.explode(ends).alias("e")).select("e.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("top"))
    ok = -F.col("top.m") >= ratio * F.col("n")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(ok, F.col("top.other")).alias("form"), F.when(ok, -F.col("top.m")).alias("form_n"))


def roots(pairs: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: forms followed to the last by doubling, until nothing moves. Counts grow
    ``RATIO`` times a step, so there is no circle."""
    at = rewritten(pairs.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = rewritten(at.join(step.hint("merge"), "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table (word, n) of distinct words of at least ``2 * END`` code points."""
    words = rewritten(words, "spelling-words")
    out = rewritten(forms(words, links(words), ratio), "spelling-forms")
    end = roots(out.where(F.col("form").isNotNull()).select("word", "form"))
    return out.join(end.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                                                "form_n")


def spelling_report(docs: DataFrame) -> DataFrame:
    """Contract rows of op13."""
    return spelling_variants(word_counts(docs, SLIP))

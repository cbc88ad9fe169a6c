"""Toxicity from a learned lexicon, matched with Levenshtein automata, and context windows.

Lexicon: words and word stems (``stem*``) that labelled toxic documents have
and clean ones do not, in both halves of a bounded sample of labelled rows.
They form a trie. A word of a text is run through the intersection of that trie
with the Levenshtein automata of its entries: a state is the set of (trie node,
edits so far), and states met are remembered, so a word costs one table step
per letter and most die after a few. Short entries match exactly, longer ones
with one edit, long ones with two.

Score: each hit weighs the log odds with which its entry, at that number of
edits, marks toxic documents of the sample. A window of words around the hit
tells quotation from abuse: hits within quotation marks or next to a word that
reports speech count for less. A logistic model, fitted on the sample with a prior
that holds these relations where the labels are silent, turns the strongest
hits and their number into a probability.

Defined results: NULL is the empty text; texts without a hit get the score of
no evidence. Without labelled rows (or none of one label) the lexicon is empty and
every score is 0. A doc_id with several labels counts as toxic if one says so; NULL labels are left
out. NULL and repeated ids, ties, extra columns: each row is scored by itself.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.common import bounded_batches, bounded_sample, id_bucket, packed, quoted, rewritten, strings, table, unpacked

FOLDS, HELD_OUT = 5, 0
#: Labelled rows from which the lexicon and the weights are learned, at most.
LABELLED_ROWS = 8_000
#: Entries of the lexicon, at most, and the length of stems.
MAX_ENTRIES, STEMS = 400, (4, 5, 6, 7)
#: Toxic documents an entry must be in: so many in both halves, and in each half at least this share.
LEAST_DOCS, LEAST_SHARE = 4, 0.01
#: An entry's share of clean documents counts so many times against its share of toxic ones.
CLEAN_COST = 20.0
#: Words on either side that are searched for quotation marks and reporting words.
WINDOW = 8
#: What a hit within quotation marks, or near a reporting word, counts for.
QUOTED, REPORTED = 0.25, 0.5
QUOTES = "\"'“”„«»‘’‚‹›`"
REPORTING = frozenset("said says quote quoted quotes wrote called term word sagte zitat wort dit citation mot dijo cita "
                      "palabra".split())
#: Words and automaton states that a task remembers; beyond it the memory starts anew.
HELD_WORDS, HELD_STATES = 100_000, 20_000
_WORD = re.compile(r"\w+")


# ---- matching -------------------------------------------------------------

class LexiconAutomaton:
    """Trie of the entries, intersected with Levenshtein automata, determinised state by state."""

    def __init__(self, entries: list[str]):
        self.entries = entries
        self._child: list[dict[str, int]] = [{}]
        self._word: list[int] = [-1]
        self._stem: list[int] = [-1]
        self._edits: list[int] = [0]  # most edits of any entry below
        self.limit = []
        for i, entry in enumerate(entries):
            stem, body = entry.endswith("*"), entry.rstrip("*")
            limit = (len(body) >= 7) if stem else (len(body) >= 5) + (len(body) >= 8)
            self.limit.append(int(limit))
            node = 0
            self._edits[0] = max(self._edits[0], limit)
            for c in body:
                if c not in self._child[node]:
                    self._child[node][c] = len(self._child)
                    self._child.append({})
                    self._word.append(-1)
                    self._stem.append(-1)
                    self._edits.append(0)
                node = self._child[node][c]
                self._edits[node] = max(self._edits[node], limit)
            (self._stem if stem else self._word)[node] = i
        self._states: dict[tuple, int] = {}
        self._sets: list[tuple] = []
        self._step: list[dict[str, int]] = []
        self._known: dict[str, tuple[int, int] | None] = {}
        self._start = self._state({0: 0}, None)

    def _state(self, nodes: dict[int, int], stem: tuple[int, int] | None) -> int:
        """A state from nodes with their edits: letters of an entry may be missing, so children join at one more."""
        todo = list(nodes.items())
        while todo:
            node, e = todo.pop()
            for child in self._child[node].values():
                if e < self._edits[child] and nodes.get(child, 99) > e + 1:
                    nodes[child] = e + 1
                    todo.append((child, e + 1))
        for node, e in nodes.items():
            i = self._stem[node]
            if i >= 0 and e <= self.limit[i] and (stem is None or (e, i) < stem):
                stem = (e, i)
        key = (frozenset(nodes.items()), stem)
        if key not in self._states:
            self._states[key] = len(self._sets)
            self._sets.append(key)
            self._step.append({})
        return self._states[key]

    def _next(self, state: int, c: str) -> int:
        nodes, stem = self._sets[state]
        after: dict[int, int] = {}

        def reach(node: int, e: int) -> None:
            if e <= self._edits[node] and e < after.get(node, 99):
                after[node] = e

        for node, e in nodes:
            reach(node, e + 1)  # a letter too many
            for letter, child in self._child[node].items():
                reach(child, e if letter == c else e + 1)
        return self._state(after, stem)

    def match(self, word: str) -> tuple[int, int] | None:
        """(entry, edits) of the nearest entry, None if there is none."""
        if word in self._known:
            return self._known[word]
        if len(self._sets) > HELD_STATES:
            self._states, self._sets, self._step = {}, [], []
            self._start = self._state({0: 0}, None)
        state = self._start
        for c in word:
            step = self._step[state]
            if c not in step:
                step[c] = self._next(state, c)
            state = step[c]
            if not self._sets[state][0]:
                break
        nodes, best = self._sets[state]
        for node, e in nodes:
            i = self._word[node]
            if i >= 0 and e <= self.limit[i] and (best is None or (e, i) < best):
                best = (e, i)
        out = None if best is None else (best[1], best[0])
        if len(self._known) >= HELD_WORDS:
            self._known.clear()
        self._known[word] = out
        return out

    def hits(self, text: str) -> list[tuple[int, int, float]]:
        """(entry, edits, context score) of every word of a text that matches."""
        low = text.lower()
        known, match = self._known, self.match
        found = {w: m for w in set(_WORD.findall(low)) if (m := known[w] if w in known else match(w)) is not None}
        if not found:
            return []
        words = [(m.group(), m.start(), m.end()) for m in _WORD.finditer(low)]
        return [(*found[w], context_score(low, words, i)) for i, (w, _, _) in enumerate(words) if w in found]


def context_score(text: str, words: list[tuple[str, int, int]], i: int) -> float:
    """What a hit counts for, by the words around it: 1 for plain use."""
    first, last = max(0, i - WINDOW), min(len(words) - 1, i + WINDOW)
    before = text[words[first][1]:words[i][1]].rpartition("\n")[2]
    after = text[words[i][2]:words[last][2]].partition("\n")[0]
    # quotation marks open after a space and close after a letter; an apostrophe does neither alone
    opened = any(c in QUOTES and (k == 0 or not before[k - 1].isalnum()) and k + 1 <= len(before)
                 for k, c in enumerate(before))
    closed = any(c in QUOTES and (k + 1 == len(after) or not after[k + 1].isalnum()) for k, c in enumerate(after))
    if opened and closed:
        return QUOTED
    near = {w for w, _, _ in words[max(0, i - WINDOW // 2):i + WINDOW // 2 + 1]}
    return REPORTED if near & REPORTING else 1.0


# ---- learning -------------------------------------------------------------

def _entries(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS) -> DataFrame:
    """(doc_id, text, toxic, half) of a bounded number of labelled rows outside the held-out fold, written once."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id") \
        .agg(F.max("toxic").cast("int").alias("toxic")).where(id_bucket(F.col("doc_id"), FOLDS) != HELD_OUT)
    few = bounded_sample(known.withColumn("text", F.lit("")), limit).select("doc_id", "toxic")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(few), "doc_id")
    # halves by the word of lowest hash: near-copies share it, so a copied phrase does not vouch for itself in the other
    lowest = F.array_min(F.transform(F.split(F.lower("text"), r"\s+"), lambda w: F.xxhash64(w)))
    return rewritten(rows.withColumn("half", (lowest % 2 == 0).cast("int")), "toxic-sample")


def learn_lexicon(sample: DataFrame, max_entries: int = MAX_ENTRIES) -> list[str]:
    """Entries that mark toxic documents in both halves of the sample, best first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [Counter() for _ in range(4)]
        for batch in batches:
            for text, toxic, half in zip(strings(batch.column(0)), strings(batch.column(1)), strings(batch.column(2))):
                seen[2 * toxic + half].update(_entries(text))
        for group, found in enumerate(seen):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array([group] * len(found), pa.int32()),
                 pa.array(list(found.values()), pa.int64())], names=["entry", "g", "n"])

    n = [0] * 4
    for r in sample.groupBy("toxic", "half").count().collect():
        n[2 * r["toxic"] + r["half"]] = r["count"]
    if not all(n):
        return []
    found = sample.select("text", "toxic", "half").mapInArrow(count, "entry string, g int, n long")
    by = found.groupBy("entry").agg(*[F.sum(F.when(F.col("g") == g, F.col("n")).otherwise(0)).alias(f"n{g}")
                                      for g in range(4)])
    good = F.col("n2") + F.col("n3") >= LEAST_DOCS
    for half in (0, 1):
        least = math.ceil(LEAST_SHARE * n[2 + half])
        good &= (F.col(f"n{2 + half}") >= least) & (
            F.col(f"n{2 + half}") / n[2 + half] > CLEAN_COST * F.col(f"n{half}") / n[half])
    net = (F.col("n2") + F.col("n3")) / (n[2] + n[3]) - CLEAN_COST * (F.col("n0") + F.col("n1")) / (n[0] + n[1])
    # among entries that begin alike the first is kept; a few times the bound suffice for that choice
    top = by.where(good).select("entry", net.alias("net")) \
        .orderBy(F.desc(F.round("net", 9)), F.desc(F.length(F.rtrim("entry", F.lit("*")))), "entry").limit(10 * max_entries).collect()
    kept: list[str] = []
    for r in top:
        body = r["entry"].rstrip("*")
        if not any(body.startswith(k.rstrip("*")) and k.endswith("*") or
                   r["entry"].endswith("*") and k.startswith(body) for k in kept):
            kept.append(r["entry"])
        if len(kept) == max_entries:
            break
    return kept


class ToxicityModel:
    """Lexicon, weights of hits by entry and edits, and the logistic model over them."""

    #: Prior means of bias, strongest plain hit, logarithm of the number of hits, strongest quoted hit.
    PRIOR = np.array([-4.0, 1.0, 0.5, 0.25])

    def __init__(self, entries: list[str]):
        self.entries, self.weight, self.theta = entries, {}, None

    def evidence(self, entry: int, edits: int) -> float:
        if (entry, edits) in self.weight:
            return self.weight[entry, edits]
        # not seen in the sample: half of the exact entry's for each edit
        return self.weight.get((entry, 0), 0.0) * 0.5**edits

    def features(self, hits: list[tuple[int, int, float]]) -> np.ndarray:
        plain = quoted_ = total = 0.0
        for entry, edits, context in hits:
            e = self.evidence(entry, edits)
            if e > 0:
                total += context
                if context <= QUOTED:
                    quoted_ = max(quoted_, e)
                else:
                    plain = max(plain, e * context)
        return np.array([1.0, plain, math.log1p(total), quoted_])

    def fit(self, hits: list[list[tuple[int, int, float]]], toxic: np.ndarray) -> None:
        with_hit = Counter((int(t), *k) for h, t in zip(hits, toxic) for k in {(e, d) for e, d, _ in h})
        n1, n0 = float(toxic.sum()), float((1 - toxic).sum())
        for _, entry, edits in {(0, e, d) for _, e, d in with_hit}:
            odds = (with_hit[1, entry, edits] + 0.5) / (n1 + 1) / ((with_hit[0, entry, edits] + 0.5) / (n0 + 1))
            self.weight[entry, edits] = float(np.clip(math.log(odds), 0.0, 6.0))
        x = np.array([self.features(h) for h in hits])
        theta = self.PRIOR.copy()
        for _ in range(50):  # Newton steps on the penalised likelihood, which is concave
            p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
            gradient = x.T @ (toxic - p) - (theta - self.PRIOR)
            hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(theta))
            step = np.linalg.solve(hessian, gradient)
            theta = theta + step
            if np.abs(step).max() < 1e-9:
                break
        self.theta = theta

    def score(self, hits: list[tuple[int, int, float]]) -> float:
        return 0.0 if self.theta is None else float(1 / (1 + np.exp(-np.clip(self.features(hits) @ self.theta, -30, 30))))


def learn(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    bounded_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels)
    model = ToxicityModel(learn_lexicon(sample))
    if not model.entries:
        return model
    entries = model.entries

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = LexiconAutomaton(entries)
        for batch in batches:
            hits = [automaton.hits(t) for t in strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[h[0] for h in x] for x in hits], pa.list_(pa.int32())),
                 pa.array([[h[1] for h in x] for x in hits], pa.list_(pa.int32())),
                 pa.array([[h[2] for h in x] for x in hits], pa.list_(pa.float64()))],
                names=["toxic", "entry", "edits", "context"])

    rows = sample.select("toxic", "text").mapInArrow(
        find, "toxic int, entry array<int>, edits array<int>, context array<double>").collect()
    rows.sort(key=lambda r: (r["toxic"], r["entry"], r["edits"], r["context"]))
    model.fit([list(zip(r["entry"], r["edits"], r["context"])) for r in rows],
              np.array([float(r["toxic"]) for r in rows]))
    return model


def scored(docs: DataFrame, model: ToxicityModel, text_col: str = "text", name: str = "_toxicity") -> DataFrame:
    """``docs`` with the score of each whole text; map only."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c != name]
    rows = docs.select(*[quoted(c) for c in columns])
    at = columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        automaton = LexiconAutomaton(model.entries)
        for batch in batches:
            score = [model.score(automaton.hits(t or "")) for t in strings(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], names=[*columns, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField(name, T.DoubleType())]))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract columns of op4."""
    model = learn(docs, labels)
    rows = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return rows.select("doc_id", (id_bucket(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                       F.col("_toxicity").alias("score"), (F.col("_toxicity") >= 0.5).cast("int").alias("predicted"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that are not predicted toxic."""
    model = learn(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    rows = scored(docs.select(packed(docs), quoted("text").alias("text")), model)
    return unpacked(rows.where(F.col("_toxicity") < 0.5), docs.columns)

"""Language identification with interpolated Kneser-Ney character models.

Per language, a character n-gram model over the words of its training texts
(lower case, with a mark before and after each word). The counts are gathered
from every training text: tasks count distinct words, turn them into n-grams,
and one shuffle adds them up. Continuation counts, discounts and the terms of
the probabilities are aggregates and joins over the table of counts, which has
no bound; a row a language is all that is collected.

The terms become sorted hash arrays: entries (hash of the n-gram, language, own
share, weight as a context) are dealt to ranges of the hash of about
``RANGE_ENTRIES`` entries, and each range is sorted and written by a task as one
Arrow file to the shared folder. Tasks that score texts map these files, so the
pages they touch are shared by all workers of a machine and the model may be
larger than a task's memory. A task scores each distinct word it meets once, by
binary search of its n-grams, and adds up words to texts.

A text's score for a language is its cross-entropy per character; the lowest
wins. Rejection is calibrated on all training texts: a text whose cross-entropy
is beyond what ``ACCEPTED`` of its language's training texts have is marked
``rejected`` (op2 must name a language, so it keeps the column apart).

Defined results: NULL texts and texts without a letter give ``und`` and score 0.
Rows with NULL lang teach nothing. Without training rows every text gives
``und``. NULL and repeated ids: each row is scored by itself. Extra columns are
ignored. Ties go to the language first by code point. ``identify`` runs jobs when
called: it writes counts, terms, arrays and scores to the shared folder.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import bounded_batches, id_bucket, rewritten, strings
from strandline.session import scratch_dir

ORDER = 4
FOLDS, HELD_OUT = 4, 2
#: Share of a language's training texts to accept.
ACCEPTED = 0.995
UNKNOWN = "und"
#: Words whose n-grams a task counts at once, or whose scores it keeps; beyond it the memory starts anew.
HELD_WORDS, HELD_BYTES = 200_000, 64 << 20
#: Words scored at once, and characters of texts taken up at once, about.
PART_WORDS, PART_CHARS = 20_000, 1 << 20
#: Entries of one file of the model, about.
RANGE_ENTRIES = 1_000_000
#: A word is a run without white space; longer runs are cut into pieces of so many characters.
PIECE = 64
#: The mark before and after a word, which no word holds.
MARK = " "


def pieces(text: str) -> list[str]:
    """Words of a text in lower case, very long ones in pieces."""
    out = text.lower().split()
    if len(text) > PIECE and max(map(len, out), default=0) > PIECE:
        out = [w[i:i + PIECE] for w in out for i in range(0, len(w), PIECE)]
    return out


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mixed(acc: np.ndarray, k: int) -> np.ndarray:
    h = acc + np.uint64(k)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Windows:
    """All n-grams of a list of words that end in a character or in the mark after a word, by their last position."""

    def __init__(self, words: list[str]):
        self.text = MARK + MARK.join(words) + MARK
        self.codes = np.frombuffer(self.text.encode("utf-32-le", errors="surrogatepass"), dtype="<u4").astype(np.uint64)
        self.mark = self.codes == ord(MARK)
        # the mark after a word belongs to it
        self.owner = np.cumsum(self.mark) - 1 - self.mark
        self._inner = np.concatenate([[0], np.cumsum(self.mark)])

    def ends(self, k: int) -> np.ndarray:
        """Positions at which an n-gram of length k ends: no mark inside, and not the leading mark alone."""
        at = np.arange(max(1, k - 1), len(self.codes))
        return at[self._inner[at] == self._inner[at - k + 2]] if k > 2 else at

    def hashes(self, k: int, ends: np.ndarray) -> np.ndarray:
        acc = np.zeros(len(ends), dtype=np.uint64)
        for j in range(k - 1, -1, -1):
            acc = (acc ^ self.codes[ends - j]) * _PRIME
        return _mixed(acc, k)


def gram_hashes(grams: list[str]) -> np.ndarray:
    """The hashes that ``Windows`` gives to these n-grams."""
    out = np.zeros(len(grams), dtype=np.uint64)
    sizes = np.array([len(g) for g in grams])
    for k in np.unique(sizes):
        at = np.nonzero(sizes == k)[0]
        codes = np.frombuffer("".join(grams[i] for i in at).encode("utf-32-le", errors="surrogatepass"),
                              dtype="<u4").astype(np.uint64).reshape(-1, k)
        acc = np.zeros(len(at), dtype=np.uint64)
        for j in range(k):
            acc = (acc ^ codes[:, j]) * _PRIME
        out[at] = _mixed(acc, int(k))
    return out


def ngrams(words: dict[str, int], order: int = ORDER) -> tuple[list[str], np.ndarray]:
    """The n-grams of the words for all orders up to ``order``, with their counts."""
    w = Windows(list(words))
    weight = np.fromiter(words.values(), dtype=np.int64, count=len(words))
    grams: list[str] = []
    counts = []
    for k in range(1, order + 1):
        ends = w.ends(k)
        _, first, group = np.unique(w.hashes(k, ends), return_index=True, return_inverse=True)
        counts.append(np.bincount(group, weights=weight[w.owner[ends]], minlength=len(first)).astype(np.int64))
        grams += [w.text[e - k + 1:e + 1] for e in ends[first].tolist()]
    return grams, np.concatenate(counts)


def count_ngrams(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) over all rows (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, held in words.items():
                if held:
                    grams, n = ngrams(held, order)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()),
                                                      pa.array(grams, pa.string()), pa.array(n)],
                                                     names=["lang", "gram", "n"])
            words.clear()

        for batch in batches:
            for lang, text in zip(strings(batch.column(0)), strings(batch.column(1))):
                words.setdefault(lang, Counter()).update(pieces(text))
                if sum(map(len, words.values())) > HELD_WORDS:
                    yield from flush()
        yield from flush()

    found = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text") \
        .mapInArrow(count, "lang string, gram string, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def model_tables(counts: DataFrame, order: int = ORDER) -> tuple[DataFrame, list[str], np.ndarray] | None:
    """Kneser-Ney terms (lang, gram, own, weight) of all n-grams, the languages, and what a character that a language
    never showed gets there; None without counts.

    The probability of a gram is ``own`` (its discounted share of its context) plus the ``weight`` of its context
    times the probability of the gram without its first character; a gram that is not there has own 0 and weight 1.
    """
    size = F.length("gram")
    # lower orders count the distinct characters before a gram; a word's first grams have none, and keep their plain
    # counts
    follow = counts.where(size > 1).groupBy("lang", F.expr("substring(gram, 2)").alias("gram")) \
        .agg(F.count(F.lit(1)).alias("before"))
    value = F.when((size < order) & ~F.col("gram").startswith(MARK), F.col("before"))
    used = rewritten(counts.join(follow, ["lang", "gram"], "left").select(
        "lang", "gram", size.alias("k"), F.coalesce(value, F.col("n")).alias("v"),
        F.expr("substring(gram, 1, length(gram) - 1)").alias("context")), "langid-used")
    ones, twos = F.count_if(F.col("v") == 1), F.count_if(F.col("v") == 2)
    # a row per language and order
    discounts = F.broadcast(used.groupBy("lang", "k").agg(
        F.when((ones > 0) & (twos > 0), ones / (ones + 2 * twos)).otherwise(F.lit(0.5)).alias("discount")))
    contexts = used.groupBy("lang", "context", "k").agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("kinds")) \
        .join(discounts, ["lang", "k"])
    weights = contexts.select("lang", F.col("context").alias("gram"),
                              (F.col("discount") * F.col("kinds") / F.col("total")).alias("weight"))
    grams = rewritten(
        used.join(contexts.drop("k", "kinds"), ["lang", "context"])
        .select("lang", "gram", ((F.col("v") - F.col("discount")) / F.col("total")).alias("own"))
        .join(weights, ["lang", "gram"], "left").withColumn("weight", F.coalesce("weight", F.lit(1.0))), "langid-model")
    empty = weights.where(F.col("gram") == "").orderBy("lang").collect()  # a row a language
    if not empty:
        return None
    letters = grams.where(size == 1).select("gram").distinct().count()
    return grams, [r["lang"] for r in empty], np.array([r["weight"] / (letters + 1.0) for r in empty])


def _file(path: str, part: int) -> tuple[pafs.FileSystem, str]:
    """The shared folder's file system, and the name there of a range's file."""
    path = re.sub(r"^file:/*", "/", path)
    system, folder = (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)
    return system, f"{folder}/range-{part:06}.arrow"


class HashArrays:
    """The model's files, and scores of words by them. Only names and a row a language travel with it; a worker maps the
    files at its first lookup."""

    def __init__(self, path: str, bits: int, langs: list[str], unseen: np.ndarray, order: int = ORDER):
        self.path, self.bits, self.langs, self.unseen, self.order = path, bits, langs, unseen, order
        self._open: dict[int, tuple[np.ndarray, ...]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_open": {}}

    def parts(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), dtype=np.int64)

    def write(self, part: int, hashes: np.ndarray, lang: np.ndarray, own: np.ndarray, weight: np.ndarray) -> None:
        """One range as a file, sorted by hash and language; a repeated task writes the same file."""
        by = np.lexsort((lang, hashes))
        table = pa.table({"hash": hashes[by], "lang": lang[by].astype(np.int32), "own": own[by].astype(np.float32),
                          "weight": weight[by].astype(np.float32)})
        system, name = _file(self.path, part)
        system.create_dir(name.rpartition("/")[0], recursive=True)
        started = f"{name}.{uuid.uuid4().hex}"
        with system.open_output_stream(started) as out, pa.ipc.new_file(out, table.schema) as writer:
            writer.write_table(table.combine_chunks())
        if system.get_file_info(name).type == pafs.FileType.NotFound:
            system.move(started, name)
        else:
            system.delete_file(started)

    def entries(self, part: int) -> tuple[np.ndarray, ...]:
        """Hashes, ascending, languages, own shares and weights of a range; no copies of a local file."""
        if part not in self._open:
            system, name = _file(self.path, part)
            if system.get_file_info(name).type == pafs.FileType.NotFound:  # no n-gram falls into this range
                found = (np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(0, np.float32))
            else:
                local = isinstance(system, pafs.LocalFileSystem)
                source = pa.memory_map(name) if local else pa.BufferReader(system.open_input_file(name).read_buffer())
                table = pa.ipc.open_file(source).read_all()
                found = tuple(table.column(c).chunk(0).to_numpy() if table.num_rows else np.zeros(0)
                              for c in ("hash", "lang", "own", "weight"))
            self._open[part] = found
        return self._open[part]

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own shares and weights of n-grams by language, with a last row for those that are not there."""
        own = np.zeros((len(hashes) + 1, len(self.langs)), dtype=np.float32)
        weight = np.ones((len(hashes) + 1, len(self.langs)), dtype=np.float32)
        part = self.parts(hashes)
        for p in np.unique(part).tolist():
            keys, lang, shares, weights = self.entries(p)
            mine = np.flatnonzero(part == p)
            first, stop = (np.searchsorted(keys, hashes[mine], side) for side in ("left", "right"))
            count = stop - first
            row = np.repeat(mine, count)
            at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            own[row, lang[at]], weight[row, lang[at]] = shares[at], weights[at]
        return own, weight

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Bits of each word in each language, its end included: array (words, languages)."""
        step = max(200, PART_WORDS // max(1, len(self.langs) // 8))
        parts = [self._scores(words[i:i + step]) for i in range(0, len(words), step)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.langs)))

    def _scores(self, words: list[str]) -> np.ndarray:
        w = Windows(words)
        ends = [w.ends(k) for k in range(1, self.order + 1)]
        ends[0] = np.concatenate([[0], ends[0]])  # the leading mark is a context of the first letters
        hashed = [w.hashes(k, e) for k, e in enumerate(ends, 1)]
        keys, place = np.unique(np.concatenate(hashed), return_inverse=True)
        own, weight = self.lookup(keys)
        found = np.full((self.order, len(w.codes)), len(keys))
        start = 0
        for k, e in enumerate(ends):
            found[k, e] = place[start:start + len(e)]
            start += len(e)
        p = own[found[0]] + self.unseen
        for k in range(1, self.order):
            e = ends[k]
            p[e] = own[found[k, e]] + weight[found[k - 1, e - 1]] * p[e]
        bits = -np.log2(p)
        return np.stack([np.bincount(w.owner[1:], weights=bits[1:, c], minlength=len(words))
                         for c in range(len(self.langs))], axis=1)


def hash_arrays(model: tuple[DataFrame, list[str], np.ndarray], order: int = ORDER) -> HashArrays:
    """The model as files of the shared folder, one for each range of hashes."""
    grams, langs, unseen = model
    ranges = max(1, -(-grams.count() // RANGE_ENTRIES))
    arrays = HashArrays(scratch_dir(grams.sparkSession, "langid-arrays"), (ranges - 1).bit_length(), langs, unseen, order)
    numbers = {x: i for i, x in enumerate(langs)}

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = gram_hashes(batch.column(1).to_pylist())
            lang = pa.array([numbers[x] for x in batch.column(0).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(arrays.parts(hashes)), pa.array(hashes.view(np.int64)), lang,
                                              batch.column(2), batch.column(3)], names=["part", "hash", "lang", "own", "weight"])

    def write(key: tuple, table: pa.Table) -> pa.Table:
        arrays.write(key[0].as_py(), table.column("hash").to_numpy().view(np.uint64),
                     *(table.column(c).to_numpy() for c in ("lang", "own", "weight")))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([table.num_rows], pa.int64())})

    numbered = grams.select("lang", "gram", "own", "weight").mapInArrow(
        number, "part long, hash long, lang int, own double, weight double")
    written = numbered.groupBy("part").applyInArrow(write, "part long, n long")
    rewritten(written, "langid-ranges")
    return arrays


def segments(text: str, most: int = PART_CHARS) -> Iterator[str]:
    """The text in parts of about ``most`` characters that end at white space."""
    at = 0
    while len(text) - at > most:
        cut = _SPACE.search(text, at + most)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:]


_SPACE = re.compile(r"\s")


def entropies(docs: DataFrame, arrays: HashArrays) -> DataFrame:
    """(doc_id, held_out, lang, letter, entropy) of every row: bits per character in each language, written once."""
    width = len(arrays.langs)
    most = min(HELD_WORDS, HELD_BYTES // (8 * width))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[str, int] = {}
        known = np.zeros((0, width))
        for batch in batches:
            ids, held, langs, texts = batch.columns
            total, letter = np.zeros((batch.num_rows, width)), np.zeros(batch.num_rows, dtype=bool)
            size = np.zeros(batch.num_rows, dtype=np.int64)
            held_parts: list[tuple[int, list[str]]] = []
            waiting = 0

            def add_up() -> None:
                nonlocal known, waiting
                fresh = list({w for _, words in held_parts for w in words if w not in place})
                if len(place) + len(fresh) > most and place:
                    place.clear()
                    known, fresh = np.zeros((0, width)), list({w for _, words in held_parts for w in words})
                place.update(zip(fresh, range(len(place), len(place) + len(fresh))))
                known = np.concatenate([known, arrays.word_scores(fresh)]) if fresh else known
                for row, words in held_parts:
                    at = np.fromiter(map(place.__getitem__, words), dtype=np.int64, count=len(words))
                    total[row] += known[at].sum(axis=0)
                held_parts.clear()
                waiting = 0

            for row, text in enumerate(strings(texts)):
                letter[row] = has_letter(text or "")
                for part in segments(text or ""):
                    words = pieces(part)
                    if words:
                        size[row] += sum(map(len, words)) + len(words)
                        held_parts.append((row, words))
                        waiting += len(part)
                    if waiting >= PART_CHARS:
                        add_up()
            add_up()
            total /= np.maximum(size, 1)[:, None]
            each = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * width, total.ravel())
            yield pa.RecordBatch.from_arrays([ids, held, langs, pa.array(letter), each],
                                             names=["doc_id", "held_out", "lang", "letter", "entropy"])

    return rewritten(docs.select("doc_id", "held_out", "lang", "text").mapInArrow(
        score, "doc_id long, held_out boolean, lang string, letter boolean, entropy array<double>"), "langid-entropies")


def calibrate(scored: DataFrame, langs: list[str]) -> tuple[float, dict[str, float]]:
    """Sharpness of the scores, and the cross-entropy beyond which a text of a language is rejected, from all training
    texts: two aggregates with a row a language at most."""
    own = F.array_position(F.lit(langs), F.col("lang")).cast("int")
    taught = scored.where(~F.col("held_out") & F.col("letter") & F.col("lang").isNotNull())
    lead = F.array_min(F.filter("entropy", lambda e, i: i + 1 != own)) - F.element_at("entropy", own)
    seen = taught.select("lang", F.element_at("entropy", own).alias("own"), F.coalesce(lead, F.lit(1.0)).alias("lead"))
    found = seen.groupBy("lang").agg(F.percentile_approx("own", ACCEPTED).alias("limit")).collect()
    # unlike the text itself, a text of the training set has been seen by the model; the slack allows for that
    limits = dict.fromkeys(langs, float("inf")) | {r["lang"]: 1.25 * r["limit"] for r in found}
    middle = seen.where("lead > 0").agg(F.percentile_approx("lead", 0.5)).first()[0]
    return float(np.clip(4.0 / middle, 1.0, 64.0)) if middle else 8.0, limits


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row (doc_id, held_out, lang, text); the model is that
    of the rows that are not held out."""
    bounded_batches(docs.sparkSession)
    counts = rewritten(count_ngrams(docs.where(~F.col("held_out"))), "langid-counts")
    model = model_tables(counts)
    if model is None:
        return docs.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(True).alias("rejected"))
    langs = model[1]
    scored = entropies(docs, hash_arrays(model))
    sharpness, limits = calibrate(scored, langs)
    least, letter = F.array_min("entropy"), F.col("letter")
    best = F.array_position("entropy", least).cast("int")
    odds = F.aggregate("entropy", F.lit(0.0), lambda acc, e: acc + F.pow(F.lit(2.0), -sharpness * (e - least)))
    return scored.select(
        "doc_id", "held_out", F.when(letter, F.element_at(F.lit(langs), best)).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(letter, 1.0 / odds).otherwise(0.0).alias("score"),
        (~letter | (least > F.element_at(F.lit([limits[x] for x in langs]), best))).alias("rejected"))


def langid_report(docs: DataFrame) -> DataFrame:
    """Contract columns of op2: trained on the rows that are not held out, applied to all."""
    return identify(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang",
                                (id_bucket(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out")))

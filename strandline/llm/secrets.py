"""Secret scans: base patterns, and a character convolutional network over every candidate and its context.

Base findings follow three patterns (assignments, access keys, hex runs). They
are the labels: in all documents, candidate tokens that a base finding covers
are positive, all others (numbers, addresses, identifiers) negative. Positives are repeated with their characters redrawn and with their
context blanked, so that the network learns how random tokens look and not only
the words before them. It is a numpy network: character embedding, one
convolution, maximum and mean over the window, logistic output. Parts of the
candidates train it side by side, and weights and moments are averaged after
each pass; as few as one part holds train it in one go.

A third of the documents, split by text, is kept out of training: on it
the outputs are calibrated (a logistic scale) and the threshold is set: as low
as ``PRECISION`` allows, and in any case so low that ``RECALL`` of its findings
are kept. Candidates over the threshold that no base finding covers are added as kind ``cnn``.

Defined results: NULL is the empty text, without spans. Without base findings
there are no labels, and nothing is added. Repeated rows and ids,
extra columns: each row is scanned by itself. Spans count code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.common import bounded_batches, packed, quoted, rewritten, strings

#: Candidates that a part trains on, and parts at most (they grow from there on); passes over all candidates.
PART_ROWS, MOST_PARTS, PASSES = 4_000, 1_024, 8
#: Positive windows made by redrawing, at least, and steps of the outputs to one unit by which candidates are counted.
REDRAWN, GRID = 600, 1_000
#: Share of held-out findings that the threshold must keep, and share of right ones that it aims at.
RECALL, PRECISION = 0.98, 0.99
KINDS = ("assign", "access", "hex", "cnn")
#: Characters of a candidate's window: before, of it (its head and its tail), after.
BEFORE, HEAD, TAIL, AFTER = 24, 40, 16, 8
WIDTH = BEFORE + HEAD + TAIL + AFTER
MASK = "[SECRET]"

_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # as runs are maximal: the runs that are long enough
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_MIXED = re.compile(r"\d|[a-z][A-Z]")

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    """Findings of the base patterns by start, then kind."""
    out: list[Span] = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int]]:
    """Long tokens with a digit or with a capital after a small letter."""
    return [m.span() for m in _CANDIDATE.finditer(text) if _MIXED.search(m.group())]


def covered(span: tuple[int, int], base: list[Span]) -> bool:
    return any(s < span[1] and span[0] < e for s, _, e in base)


def window(text: str, start: int, end: int) -> str:
    """The candidate between its context, in fixed places."""
    token = text[start:end]
    tail = token[max(HEAD, len(token) - TAIL):]
    return (text[max(0, start - BEFORE):start].rjust(BEFORE, "\0") + token[:HEAD].ljust(HEAD, "\0")
            + tail.ljust(TAIL, "\0") + text[end:end + AFTER].ljust(AFTER, "\0"))


def windows_over(text: str, start: int, end: int) -> list[str]:
    """Windows that together show every character of the candidate: its own, and for one longer than a window holds those
    of half-overlapping parts, each between what stands around it."""
    size = HEAD + TAIL
    parts = [(start, end)]
    if end - start > size:
        at = range(start, end - size, size // 2)
        parts += [(a, a + size) for a in at] + [(end - size, end)]
    return [window(text, a, b) for a, b in parts]


def _codes(windows: list[str]) -> np.ndarray:
    """Character codes: 0 for none, printable ASCII, 96 for any other."""
    raw = np.frombuffer("".join(windows).encode("utf-32-le", errors="surrogatepass"), dtype="<u4").reshape(-1, WIDTH)
    return np.where(raw == 0, 0, np.where((raw >= 32) & (raw < 127), raw - 31, 96)).astype(np.uint8)


class CharCnn:
    """Embedding, convolution, maximum and mean, logistic output."""

    SYMBOLS, EMBED, SPAN, FILTERS = 97, 8, 5, 24

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        e, s, f = self.EMBED, self.SPAN, self.FILTERS
        self.p = {"embed": rng.normal(0, 0.3, (self.SYMBOLS, e)), "conv": rng.normal(0, (2 / (e * s)) ** 0.5, (e * s, f)),
                  "bias": np.zeros(f), "out": rng.normal(0, 0.2, 2 * f), "base": np.zeros(1)}
        self.m = {k: np.zeros_like(x) for k, x in self.p.items()}
        self.v = {k: np.zeros_like(x) for k, x in self.p.items()}
        self.step = 0
        self.scale, self.shift, self.threshold = 1.0, 0.0, 2.0
        self.rng = rng

    def state(self) -> np.ndarray:
        """Steps, weights and moments, one after the other."""
        return np.concatenate([[self.step], *[held[k].ravel() for held in (self.p, self.m, self.v) for k in sorted(held)]])

    def set_state(self, values: np.ndarray) -> None:
        self.step, at = round(values[0]), 1
        for held in (self.p, self.m, self.v):
            for k in sorted(held):
                size = held[k].size
                held[k] = np.array(values[at:at + size]).reshape(held[k].shape)
                at += size

    def _forward(self, codes: np.ndarray):
        x = self.p["embed"][codes]
        n, w = len(codes), WIDTH - self.SPAN + 1
        patches = np.lib.stride_tricks.sliding_window_view(x, self.SPAN, axis=1).transpose(0, 1, 3, 2).reshape(n * w, -1)
        z = np.maximum(patches @ self.p["conv"] + self.p["bias"], 0).reshape(n, w, -1)
        top = z.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(z, top[:, None, :], axis=1)[:, 0], z.mean(axis=1)], axis=1)
        return patches, z, top, pooled, pooled @ self.p["out"] + self.p["base"][0]

    def logits(self, codes: np.ndarray) -> np.ndarray:
        parts = [self._forward(codes[at:at + 512])[-1] for at in range(0, len(codes), 512)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(codes) + self.shift, -30, 30)))

    def fit(self, codes: np.ndarray, label: np.ndarray, epochs: int = PASSES, batch: int = 64, rate: float = 0.004,
            share: float | None = None) -> None:
        """``share``: that of label 1 among all rows, where these are a part of them."""
        share = label.mean() if share is None else share
        # both labels weigh the same
        weight = np.where(label > 0, 0.5 / max(1e-9, share), 0.5 / max(1e-9, 1 - share))
        m, v, f = self.m, self.v, self.FILTERS
        for _ in range(epochs):
            for rows in np.array_split(self.rng.permutation(len(codes)), max(1, len(codes) // batch)):
                patches, z, top, pooled, logit = self._forward(codes[rows])
                d = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label[rows]) * weight[rows] / len(rows)
                g = {"out": pooled.T @ d, "base": np.array([d.sum()])}
                dp = d[:, None] * self.p["out"]
                dz = np.broadcast_to(dp[:, None, f:] / z.shape[1], z.shape).copy()
                at = np.take_along_axis(dz, top[:, None, :], axis=1) + dp[:, None, :f]
                np.put_along_axis(dz, top[:, None, :], at, axis=1)
                dz = (dz * (z > 0)).reshape(-1, f)
                g["conv"], g["bias"] = patches.T @ dz, dz.sum(axis=0)
                dx = (dz @ self.p["conv"].T).reshape(len(rows), -1, self.SPAN, self.EMBED)
                at = np.zeros((len(rows), WIDTH, self.EMBED))
                for j in range(self.SPAN):
                    at[:, j:j + dx.shape[1]] += dx[:, :, j]
                place = codes[rows][:, :, None].astype(np.int64) * self.EMBED + np.arange(self.EMBED)
                g["embed"] = np.bincount(place.ravel(), at.ravel(), self.p["embed"].size).reshape(self.p["embed"].shape)
                self.step += 1
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**self.step)) / (np.sqrt(v[k] / (1 - 0.999**self.step)) + 1e-8)

    def calibrate(self, x: np.ndarray, label: np.ndarray, n: np.ndarray, recall: float = RECALL) -> None:
        """Logistic scale of the outputs ``x``, each of ``n`` held-out candidates, and the threshold: as low as
        ``PRECISION`` allows, and never so high that it loses more than 1 - ``recall`` of the findings."""
        theta = np.array([1.0, 0.0])
        design = np.stack([x, np.ones_like(x)], axis=1)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
            gradient = design.T @ (n * (label - p)) - (theta - [1.0, 0.0]) * 0.1
            theta = theta + np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2), gradient)
        self.scale, self.shift = float(theta[0]), float(theta[1])
        prob = lambda x: 1 / (1 + np.exp(-np.clip(self.scale * x + self.shift, -30, 30)))
        p = prob(x)

        def at(of: int, place: int) -> tuple[int, float] | None:
            """The row with the candidate of a label at a place (from 0) in falling order, and how many come before its end."""
            rows = np.flatnonzero(label == of)
            rows = rows[np.argsort(-p[rows], kind="stable")]
            upto = np.cumsum(n[rows])
            found = int(np.searchsorted(upto, place, side="right"))
            return (rows[found], upto[found]) if found < len(rows) else None

        need = int(np.ceil(recall * n[label > 0].sum()))
        if need:
            # the lowest threshold with few false findings, as new kinds of tokens score less; recall goes first, so a single
            # candidate in the step where they end is let in
            spare = int((1 - PRECISION) * need)
            row, upto = at(0, spare) or (None, 0)
            lowest = 0.0 if row is None else p[row] if upto <= spare + 1 else np.nextafter(prob(x[row] + 1 / GRID), 1.0)
            self.threshold = float(min(p[at(1, need - 1)[0]], max(0.5, lowest)))
        else:
            self.threshold = 2.0


_ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
              "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
              "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/")


def _redrawn(text: str, rng: np.random.Generator) -> str:
    """A positive window with the token's characters redrawn, and with its context blanked half of the time."""
    letters = _ALPHABETS[rng.integers(len(_ALPHABETS))]
    head, tail = text[BEFORE:BEFORE + HEAD], text[BEFORE + HEAD:BEFORE + HEAD + TAIL]
    draw = lambda s: "".join(c if c == "\0" else letters[rng.integers(len(letters))] for c in s)
    head = draw(head)
    if rng.random() < 0.3:  # an issuer's mark, as many keys begin with one
        n = int(rng.integers(2, 6))
        mark = "".join(chr(97 + rng.integers(26)) for _ in range(n)) + "_-"[rng.integers(2)]
        head = mark + head[len(mark):]
    before = "\0" * BEFORE if rng.random() < 0.5 else text[:BEFORE]
    return before + head + draw(tail) + text[BEFORE + HEAD + TAIL:]


def _identifier(texts: list[str], rng: np.random.Generator) -> str:
    """A negative window: words of the sample's contexts joined to a mixed-case or numbered identifier."""
    words = re.findall(r"[a-z]{3,}", texts[rng.integers(len(texts))].lower()) or ["value"]
    token = "".join(words[rng.integers(len(words))].capitalize() for _ in range(4))
    token = token[0].lower() + token[1:] if rng.random() < 0.5 else f"{token}_{rng.integers(1000)}"
    return window(f"{words[0]} {token} {words[-1]}", len(words[0]) + 1, len(words[0]) + 1 + len(token))


def _windows(docs: DataFrame) -> DataFrame:
    """(window, label, held, n): every candidate of every text, those alike in one row."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in strings(batch.column(0)):
                text = text or ""
                base = base_spans(text)
                held = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16) % 3 == 0
                # the value of a finding, when it is no candidate by its length, is one by its label
                spans = {s for s in candidates(text)} | {(s, e) for s, k, e in base if k}
                rows += [(window(text, s, e), int(covered((s, e), base)), held) for s, e in sorted(spans)]
            columns = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()),
                                              pa.array(columns[2], pa.bool_())], names=["window", "label", "held"])

    found = docs.select("text").mapInArrow(gather, "window string, label int, held boolean")
    return rewritten(found.groupBy("window", "label", "held").agg(F.count(F.lit(1)).alias("n")), "secrets-windows")


def _dealt(own: DataFrame, parts: int) -> DataFrame:
    """(part, label, window): a row for each candidate, dealt by a hash that tells those alike apart."""
    each = own.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    part = F.pmod(F.xxhash64("copy", "window", "label", "held"), F.lit(parts)).cast("int")
    return rewritten(each.withColumn("part", part).repartition(parts, "part").sortWithinPartitions(
        "part", F.desc("label"), F.xxhash64("window"), "window", "held").select("part", "label", "window"), "secrets-parts")


def _of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[str], list[float]]]:
    """Windows and labels of each part of a task's rows."""
    part, windows, labels = None, [], []
    for batch in batches:
        for p, label, text in zip(*[c.to_pylist() for c in batch.columns]):
            if p != part and windows:
                yield part, windows, labels
                windows, labels = [], []
            part = p
            windows.append(text)
            labels.append(float(label))
    if windows:
        yield part, windows, labels


def _trained(dealt: DataFrame, net: CharCnn, number: int, parts: int, passes: int, share: float) -> np.ndarray:
    """State of the network after each part has trained it from the same state: their mean by rows."""
    sent = dealt.sparkSession.sparkContext.broadcast(net.state())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = 0, 0.0
        for part, windows, labels in _of_parts(batches):
            local, rng = CharCnn(), np.random.default_rng([9, part] if part else 9)
            local.set_state(sent.value)
            if number or part:
                local.rng = np.random.default_rng([5, number, part])
            positive = [w for w, x in zip(windows, labels) if x]
            extra = [_redrawn(positive[i % len(positive)], rng) for i in range(max(-(-REDRAWN // parts), len(positive)))] if positive else []
            plain = [_identifier(windows, rng) for _ in range(len(extra) // 2)]
            local.fit(_codes(windows + extra + plain), np.array(labels + [1.0] * len(extra) + [0.0] * len(plain)), passes, share=share)
            seen, total = seen + len(windows), total + len(windows) * local.state()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([total.tolist()], pa.list_(pa.float64()))],
                                             names=["seen", "total"])

    got = dealt.mapInArrow(run, "seen long, total array<double>").collect()  # a row of about 6,000 numbers for each task
    return np.sum([r["total"] for r in got], axis=0) / sum(r["seen"] for r in got)


def _outputs(judged: DataFrame, net: CharCnn) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Outputs of candidates as lower ends of steps of 1 / GRID, their labels and numbers."""
    sent = judged.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = sent.value.logits(_codes(batch.column(0).to_pylist()))
            step = np.floor(np.clip(x, -30, 30) * GRID).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(step)], names=["label", "n", "step"])

    steps = judged.select("window", "label", "n").mapInArrow(run, "label int, n long, step long") \
        .groupBy("label", "step").agg(F.sum("n").alias("n")).orderBy("label", "step").collect()  # 2 * 60 * GRID rows at most
    label = np.array([float(r["label"]) for r in steps])
    return np.array([r["step"] for r in steps]) / GRID, label, np.array([float(r["n"]) for r in steps])


def train(docs: DataFrame) -> CharCnn | None:
    """A network trained on the candidates of all ``docs`` (text); None without labels."""
    bounded_batches(docs.sparkSession)
    rows = _windows(docs)
    count = {(r["label"], r["held"]): r["n"] for r in rows.groupBy("label", "held").agg(F.sum("n").alias("n")).collect()}
    if {label for label, _ in count} != {0, 1}:
        return None
    apart = any(not held for _, held in count)
    own = rows.where(~F.col("held")) if apart else rows
    judged = rows.where("held") if (1, True) in count else own
    negative, positive = (sum(n for (x, held), n in count.items() if x == label and not (apart and held)) for label in (0, 1))
    redrawn = max(REDRAWN, positive) if positive else 0
    share = (positive + redrawn) / (positive + negative + redrawn + redrawn // 2)
    parts = min(MOST_PARTS, -(-(positive + negative) // PART_ROWS))
    net, dealt = CharCnn(), _dealt(own, parts)
    if parts == 1:
        net.set_state(_trained(dealt, net, 0, 1, PASSES, share))
    else:
        for number in range(PASSES):
            net.set_state(_trained(dealt, net, number, parts, 1, share))
    net.calibrate(*_outputs(judged, net))
    return net


def scan(texts: list[str], net: CharCnn | None) -> list[list[Span]]:
    """All spans of each text, by start, then kind."""
    base = [base_spans(t) for t in texts]
    if net is None:
        return base
    asked = [(i, s, e) for i, t in enumerate(texts) for s, e in candidates(t)]
    if not asked:
        return base
    shown = [windows_over(texts[i], s, e) for i, s, e in asked]
    each = net.probability(_codes([w for ws in shown for w in ws]))
    # a candidate counts for what its likeliest part shows
    p = np.maximum.reduceat(each, np.cumsum([0] + [len(ws) for ws in shown[:-1]]))
    added: list[list[Span]] = [[] for _ in texts]
    for (i, s, e), x in zip(asked, p):
        if x >= net.threshold and not covered((s, e), base[i]):
            added[i].append((s, 3, e))
    return [sorted(b + a) for b, a in zip(base, added)]


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by a mask."""
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join(out) + text[at:]


def _blocks(column: pa.Array, chars: int = 1 << 22) -> Iterator[list[str]]:
    held, size = [], 0
    for t in strings(column):
        held.append(t or "")
        size += len(held[-1])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secrets_report(docs: DataFrame) -> DataFrame:
    """Contract columns of op3."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sent = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s for block in _blocks(batch.column(1)) for s in scan(block, sent.value)]
            base = [[x for x in s if x[1] < 3] for s in found]
            count = [pa.array([sum(x[1] == k for x in b) for b in base], pa.int64()) for k in range(3)]
            sums = [hashlib.sha256(_written(b).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *count, pa.array(sums, pa.string()), pa.array(map(_written, found), pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, with secrets masked; ``n_chars``, if there, follows the text. NULL texts stay."""
    sent = spark.sparkContext.broadcast(train(docs.select("doc_id", "text")))
    rows = docs.select(packed(docs), quoted("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean, hit = [], []
            for block in _blocks(batch.column(1)):
                for text, spans in zip(block, scan(block, sent.value)):
                    clean.append(redacted(text, spans) if spans else None)
                    hit.append(bool(spans))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(clean, pa.string()), pa.array(hit, pa.bool_())],
                                             names=["_row", "text", "_clean", "_hit"])

    schema = T.StructType([*rows.schema, T.StructField("_clean", T.StringType()), T.StructField("_hit", T.BooleanType())])
    out = rows.mapInArrow(run, schema)
    columns = []
    for c in docs.columns:
        value = F.col("_row").getField(c)
        if c == "text":
            value = F.when(F.col("_hit"), F.col("_clean")).otherwise(value)
        elif c == "n_chars":
            value = F.when(F.col("_hit"), F.length("_clean").cast("long")).otherwise(value)
        columns.append(value.alias(c))
    return out.select(*columns)

"""Byte-level BPE encoding by backtracking, and decoding with an offset table.

Encoder: an Aho-Corasick automaton over the vocabulary gives every token match
of a piece, hence the longest token at each position. Tokens are laid down left
to right; a token may follow its predecessor only if BPE would not have merged
across their border (the pair-compatibility test, answered from the merge
table and remembered). If no prefix of the longest match fits, the last token
is taken back and the place is marked as a dead end, so each position is left
at most once and the work is linear in the piece. The result is the tokens that
the merges give (tests compare with the merge loop and the tokenizers library).

Decoder: the bytes of all tokens lie in one array with an offset table; ids are
turned into text by gathering ranges of it.

Defined results: a NULL text is encoded as the empty text, which has no tokens.
NULL and repeated ids, extra columns: each row is encoded by itself. Special
tokens inside a text become their ids, as in the tokenizers library.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import bounded_batches, strings

#: The split before the merges of byte-level vocabularies.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
          r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: A vocabulary file is shipped to the tasks as it is; larger ones are refused.
MAX_VOCABULARY_BYTES = 64 << 20
#: Pieces whose tokens a task remembers; beyond it the memory starts anew.
REMEMBERED_PIECES = 200_000


def _byte_letters() -> dict[str, int]:
    """The vocabulary's letter of each byte: printable bytes stand for themselves, the rest follow from U+0100."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BacktrackingBpe:
    """Encoder and decoder of one vocabulary (the JSON text of a byte-level BPE of the tokenizers library)."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        model = spec["model"]
        if model["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" \
                or spec.get("normalizer") or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        letters = _byte_letters()
        ids = model["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        n = 1 + max([*ids.values(), *special.values()])
        tokens: list[bytes] = [b""] * n
        for word, i in ids.items():
            if word not in special:
                tokens[i] = bytes(letters[c] for c in word)
        for word, i in special.items():
            tokens[i] = word.encode("utf-8")
        self.special = special
        self._special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self._pieces = regex.compile(PIECES)
        # merges: rank and result of a pair, and the pair that made a token
        self._merge: dict[tuple[int, int], tuple[int, int]] = {}
        self._made: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = ids[a], ids[b], ids[a + b]
            self._merge.setdefault((left, right), (rank, whole))
            self._made.setdefault(whole, (rank, left, right))
        by_bytes = {tokens[i]: i for w, i in ids.items() if w not in special}
        self._length = [len(t) for t in tokens]
        self._automaton = ahocorasick.Automaton()
        for word, i in by_bytes.items():
            self._automaton.add_word(word.decode("latin-1"), i)
        self._automaton.make_automaton()
        # the longest token that begins a token and is shorter
        self._shorter = [-1] * n
        for word, i in by_bytes.items():
            self._shorter[i] = next((by_bytes[word[:k]] for k in range(len(word) - 1, 0, -1) if word[:k] in by_bytes), -1)
        self._fits: dict[tuple[int, int], bool] = {}
        self._known: dict[str, tuple[int, ...]] = {}
        self._offsets = np.concatenate([[0], np.cumsum(self._length)]).astype(np.int64)
        self._bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.names = [str(i) for i in range(n)]

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE keeps the border between two adjacent tokens.

        The merges that built both tokens are undone from the latest on. At each
        stage the two parts that meet at the border could merge with some rank; if
        that comes before the merge undone last, BPE would have crossed the border.
        """
        known = self._fits.get((left, right))
        if known is not None:
            return known
        a, b, until, fits = left, right, 1 << 60, True
        while True:
            crossing = self._merge.get((a, b))
            if crossing is not None and crossing[0] < until:
                fits = False
                break
            made_a, made_b = self._made.get(a), self._made.get(b)
            if made_a is None and made_b is None:
                break
            # of equal ranks the left one is merged first, so the right one is undone first
            if made_b is None or (made_a is not None and made_a[0] > made_b[0]):
                # while the left part is unmade, a crossing of the same rank further right would come after it
                until, a = made_a[0], made_a[2]
            else:
                until, b = made_b[0] + 1, made_b[1]
        if len(self._fits) >= 2 * REMEMBERED_PIECES:
            self._fits.clear()
        self._fits[left, right] = fits
        return fits

    def encode_piece(self, data: bytes) -> list[int]:
        n = len(data)
        longest: list[int] = [-1] * n
        length = self._length
        for end, token in self._automaton.iter(data.decode("latin-1")):
            at = end + 1 - length[token]
            if longest[at] < 0 or length[longest[at]] < length[token]:
                longest[at] = token
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0] if n else -1
        while at < n:
            while token >= 0:
                end = at + length[token]
                if alive[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = self._shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            else:
                if not out:
                    raise ValueError("the vocabulary lacks a byte")
                alive[at] = 0
                token = out.pop()
                at -= length[token]
                # its end is dead now, so the next shorter one is tried
        return out

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.encode_piece(piece.encode("utf-8")))
        if len(piece) <= 64:
            if len(self._known) >= REMEMBERED_PIECES:
                self._known.clear()
            self._known[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known, piece_ids, at = self._known.get, self._piece, 0
        marks = [(m.start(), m.end()) for m in self._special.finditer(text)] if self._special else []
        for start, end in [*marks, (len(text), len(text))]:
            for piece in self._pieces.findall(text, at, start) if not marks else self._pieces.findall(text[at:start]):
                out += known(piece) or piece_ids(piece)
            if end > start:
                out.append(self.special[text[start:end]])
            at = end
        return out

    def decode(self, ids: list[int] | np.ndarray) -> str:
        ids = np.asarray(ids, dtype=np.int64)
        if not ids.size:
            return ""
        start, size = self._offsets[ids], self._offsets[ids + 1] - self._offsets[ids]
        to = np.cumsum(size) - size
        where = np.arange(int(size.sum()), dtype=np.int64) + np.repeat(start - to, size)
        return self._bytes[where].tobytes().decode("utf-8", errors="replace")


_LOADED: dict[str, BacktrackingBpe] = {}


def _codec(vocabulary: str) -> BacktrackingBpe:
    """One codec per Python worker."""
    key = hashlib.sha256(vocabulary.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = BacktrackingBpe(vocabulary)
    return _LOADED[key]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        text = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(text) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary larger than {MAX_VOCABULARY_BYTES} bytes")
    return text


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def bpe_digests(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """Contract columns of op7: token count and digests of the ids and of the text decoded from them."""
    bounded_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path or default_vocabulary()))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped.value)
        names = codec.names
        for batch in batches:
            count, ids_sha, text_sha = [], [], []
            for text in strings(batch.column(1)):
                ids = codec.encode(text or "")
                count.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest())
                text_sha.append(hashlib.sha256(codec.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_documents(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): the ids of each whole text, and the digest of the text decoded again."""
    bounded_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path or default_vocabulary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # ids are larger than their text: give them away in small lots
                part = batch.slice(at, 256)
                ids, sums = [], []
                for text in strings(part.column(1)):
                    ids.append(np.array(codec.encode(text or ""), dtype=np.int32))
                    sums.append(hashlib.sha256(codec.decode(ids[-1]).encode("utf-8")).hexdigest())
                sizes = np.array([len(i) for i in ids], dtype=np.int64)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids))),
                     pa.array(sums, pa.string())], names=["doc_id", "n_tokens", "ids", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage (the last one): token ids of each document."""
    return encode_documents(docs)

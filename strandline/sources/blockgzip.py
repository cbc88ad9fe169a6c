"""Block-gzip text files (``.bgz``): many small gzip members whose headers say how long they are.

Spark's text reader cuts the file at the fixed header of a member, so a file is as many tasks as it has splits and every
record is one member (at most 64 KB of text). Tasks inflate their members and check each one's length and checksum. A
second scan takes the unfinished lines at the two ends of each split, inflating few members; they are joined per file.

A file with the extension ``.gz`` is inflated by the file system's codec and stays one task; land such files as ``.bgz``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the file format: the header that its writers put before each member's length, and the empty last member.
MEMBER_HEADER = bytes.fromhex("1f8b08040000000000ff0600424302 00".replace(" ", ""))
LAST_MEMBER = MEMBER_HEADER + bytes.fromhex("1b0003000000000000000000")
MEMBER_TEXT = 65280
_ROWS_A_BATCH = 20_000
_HELD = 64
_ROWS = "file string, split bigint, kind string, value binary"


def _inflate(member: bytes) -> bytes:
    """Text of a member given without its header; raises where length or checksum do not fit."""
    if len(member) < 10 or len(member) + len(MEMBER_HEADER) != int.from_bytes(member[:2], "little") + 1:
        raise ValueError("block-gzip member of a wrong length")
    text = zlib.decompress(member[2:-8], -15)
    if zlib.crc32(text) != int.from_bytes(member[-8:-4], "little") or len(text) != int.from_bytes(member[-4:], "little"):
        raise ValueError("block-gzip member with a wrong checksum")
    return text


def _by_split(members: Iterator[tuple[str, int, bytes]]) -> Iterator[tuple[tuple[str, int], Iterator[bytes]]]:
    """Members of each split; what is before a file's first header is an empty member, left out."""
    for where, rows in groupby(members, key=lambda r: r[:2]):
        yield where, (m for _, _, m in rows if m)


def _whole_lines(members: Iterator[tuple[str, int, bytes]]) -> Iterator[tuple[str, int, str, bytes]]:
    """The lines that begin after a split's first line end and end within the split."""
    for where, own in _by_split(members):
        rest, begun = [], False
        for member in own:
            first, *others = _inflate(member).split(b"\n")
            rest.append(first)
            for text in others:
                if begun:
                    yield (*where, "line", b"".join(rest))
                begun, rest = True, [text]


def _last_piece(rest: bytes, held: list[bytes]) -> bytes:
    """What follows the last line end of the text ``rest`` (which has none) and the members ``held``."""
    pieces = []
    for member in reversed(held):
        _, end, after = _inflate(member).rpartition(b"\n")
        pieces.append(after)
        if end:
            return b"".join(reversed(pieces))
    return rest + b"".join(reversed(pieces))


def _pieces(members: Iterator[tuple[str, int, bytes]]) -> Iterator[tuple[str, int, str, bytes]]:
    """A split's text before its first line end (``head``) and after its last one (``tail``); all of it (``middle``) where
    there is none. Members between are not inflated, but one in 64, so that few are held."""
    for where, own in _by_split(members):
        head: list[bytes] | None = []
        rest, held = b"", []
        for member in own:
            if head is not None:
                first, end, others = _inflate(member).partition(b"\n")
                head.append(first)
                if end:
                    yield (*where, "head", b"".join(head))
                    head, rest = None, others.rpartition(b"\n")[2]
                continue
            held.append(member)
            if len(held) % _HELD == 0:
                _, end, after = _inflate(member).rpartition(b"\n")
                if end:
                    rest, held = after, []
        yield (*where, *(("tail", _last_piece(rest, held)) if head is None else ("middle", b"".join(head))))


def _in_batches(rows_of: Callable):
    schema = pa.schema([("file", pa.string()), ("split", pa.int64()), ("kind", pa.string()), ("value", pa.binary())])

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = rows_of((f, s, m) for b in batches for f, s, m in zip(*(b.column(i).to_pylist() for i in range(3))))
        while some := list(islice(rows, _ROWS_A_BATCH)):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*some), schema)], schema=schema)

    return batches_of


def _members(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("encoding", "ISO-8859-1").option("lineSep", MEMBER_HEADER.decode("latin-1")).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                    F.col("value").cast("binary").alias("member")))


def _border_lines(pieces: DataFrame) -> DataFrame:
    """Lines that lie across ends of splits: per file the pieces in the order of splits, a line end after each head. There are
    two pieces a split, so a file's row holds a line for every 128 MB of it."""
    piece = F.struct("split", F.when(F.col("kind") == "tail", 1).otherwise(0).alias("o"),
                     F.when(F.col("kind") == "head", F.concat("value", F.lit("\n"))).otherwise(F.col("value")).alias("text"))
    joined = pieces.groupBy("file").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    lines = F.split(F.array_join(F.col("p.text"), ""), "\n")
    return joined.select("file", F.posexplode(lines).alias("n", "value")).select("file", (F.col("n") == 0).alias("first"), "value")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, value): the lines of the block-gzip files at ``path``; ``first`` marks the first line of a file. The text
    after the last line end of a file counts as a line unless it is empty. A carriage return before a line end is dropped.
    Members with a wrong length or checksum, and files that do not begin with a member, end the job."""
    members = _members(spark, path)

    def rows(rows_of):  # bytes until here: a piece may end within a character
        return members.mapInArrow(_in_batches(rows_of), _ROWS).withColumn("value", F.col("value").cast("string"))

    inner = rows(_whole_lines).select("file", F.lit(False).alias("first"), "value")
    lines = inner.unionByName(_border_lines(rows(_pieces)))
    lines = lines.withColumn("value", F.regexp_replace("value", r"\r$", ""))
    return lines.where(F.col("first") | (F.length("value") > 0))


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of one of the files at ``path``, from its first member with text; as a rule only one split's beginning is
    read for it. NULL without any text."""
    start = _members(spark, path).where(
        (F.col("split") == 0) & (F.length("member") > len(LAST_MEMBER) - len(MEMBER_HEADER))).select("member").first()
    if start is None:
        return None
    line, end, _ = _inflate(bytes(start["member"])).partition(b"\n")
    if not end:  # longer than a member
        return read_lines(spark, path).where("first").first()["value"]
    return line.decode("utf-8", "replace").rstrip("\r")


def read_delimited(spark: SparkSession, path: str, sep: str = "\t", null_value: str = ".") -> DataFrame:
    """Columns of block-gzip files with a header line, all strings, as ``formats.read_delimited`` reads plain ones. The names
    are read when this is called; a file with another header ends the job. Without any text there are no columns."""
    header = first_line(spark, path)
    if header is None:
        return spark.range(0).select()
    names = header.split(sep)
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    other = F.raise_error(F.concat(F.lit("Another header line in "), F.col("file")))
    rows = read_lines(spark, path).where(F.when(~F.col("first"), True).when(F.col("value") == header, False)
                                         .when(F.length("value") == 0, False).otherwise(other.cast("boolean")))
    return rows.select(F.from_csv("value", schema, {"sep": sep, "nullValue": null_value}).alias("r")).select("r.*").toDF(*names)


def _deflate(text: bytes) -> bytes:
    """A member with its header."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(text) + packer.flush()
    size = (len(MEMBER_HEADER) + 2 + len(body) + 8 - 1).to_bytes(2, "little")
    return MEMBER_HEADER + size + body + zlib.crc32(text).to_bytes(4, "little") + len(text).to_bytes(4, "little")


def pack(text: bytes, size: int = MEMBER_TEXT) -> bytes:
    """A text as one block-gzip file, ``size`` bytes of it a member."""
    return b"".join(_deflate(text[i:i + size]) for i in range(0, len(text), size)) + LAST_MEMBER


def write_lines(lines: DataFrame, path: str, header: str) -> str:
    """One block-gzip file a partition of ``lines`` (column ``value``), each with the header line; every member is followed by
    an empty one, which the format allows anywhere."""
    def pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = header.encode() + b"\n"
        for b in batches:
            text += "".join(f"{v}\n" for v in b.column(0).to_pylist()).encode()
            whole = len(text) - len(text) % MEMBER_TEXT
            members = [_deflate(text[i:i + MEMBER_TEXT]) for i in range(0, whole, MEMBER_TEXT)]
            text = text[whole:]
            if members:
                yield pa.RecordBatch.from_pydict({"member": pa.array(members, pa.binary())})
        yield pa.RecordBatch.from_pydict({"member": pa.array([_deflate(text)], pa.binary())})

    packed = lines.select("value").mapInArrow(pack_batches, "member binary").select(F.col("member").cast("string").alias("value"))
    packed.write.mode("overwrite").option("encoding", "ISO-8859-1").option("lineSep", LAST_MEMBER.decode("latin-1")).text(path)
    return path


def delimited_line(columns: list[str], sep: str = "\t", null_value: str = ".") -> Column:
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit(null_value)) for c in columns])

"""Block-gzip files: lines equal those of the plain text for any sizes of members and splits."""

import gzip
import random

import pytest

from strandline.operators import refdata
from strandline.sources import blockgzip


def _splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(n) for n in names]
    yield lambda size: _splits(spark, size)
    for n, v in zip(names, before):
        spark.conf.set(n, v)


@pytest.mark.parametrize("member,split,end", [(700, 33_331, ""), (700, 4_099, "\n"), (65_280, 9_973, ""), (37, 1_009, "\r\n")])
def test_lines_equal_the_plain_text(spark, small_splits, tmp_path, member, split, end):
    rnd = random.Random(member + split)
    words = ["", "a", "é\u20ac", "x" * 90, "\x1f\x08", "long" * 2000]
    lines = ["name\tscore"] + [rnd.choice(words) + str(rnd.random()) for _ in range(500)]
    text = ("\r\n" if "\r" in end else "\n").join(lines) + end
    (tmp_path / "a.bgz").write_bytes(blockgzip.pack(text.encode(), member))
    (tmp_path / "b.bgz").write_bytes(blockgzip.pack(b"name\tscore", member))
    (tmp_path / "c.bgz").write_bytes(blockgzip.pack(b"", member))
    assert gzip.decompress((tmp_path / "a.bgz").read_bytes()).decode() == text
    small_splits(split)
    got = blockgzip.read_lines(spark, str(tmp_path)).collect()
    assert sorted(r.value for r in got if r.file.endswith("a.bgz")) == sorted(lines)
    assert [r.value for r in got if r.first and r.file.endswith("a.bgz")] == [lines[0]]
    assert [(r.first, r.value) for r in got if r.file.endswith("b.bgz")] == [(True, "name\tscore")]
    assert [r.value for r in got if r.file.endswith("c.bgz") and r.value] == []


def test_one_file_is_several_tasks_with_equal_rows(spark, small_splits, tmp_path):
    rows = [(f"g{i}", "NA" if i % 7 == 0 else "bad;1" if i % 11 == 3 else str(i / 8)) for i in range(4000)]
    text = "gene\tpLI\n" + "".join(f"{g}\t{p}\n" for g, p in rows)
    path, plain = str(tmp_path / "c.txt.bgz"), str(tmp_path / "plain.tsv")
    (tmp_path / "c.txt.bgz").write_bytes(blockgzip.pack(text.encode(), 2_000))
    (tmp_path / "plain.tsv").write_text(text)
    small_splits(3_000)
    assert blockgzip._members(spark, path).select("split").distinct().count() > 3
    got = refdata.import_gnomad_constraint(spark, path)
    want = refdata.import_gnomad_constraint(spark, plain)
    assert got.schema == want.schema and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    rejects = refdata.constraint_rejects(spark, path, ["gene"]).collect()
    assert {(r.gene, r.field, r.value) for r in rejects} == {(g, "pLI", p) for g, p in rows if p == "bad;1"}


def test_long_header_other_header_and_broken_members(spark, tmp_path):
    head = "\t".join(f"column{i}" for i in range(30))
    (tmp_path / "a.bgz").write_bytes(blockgzip.pack((head + "\n" + "\t".join("1" * 30)).encode(), 50))
    assert blockgzip.read_delimited(spark, str(tmp_path / "a.bgz")).columns == head.split("\t")
    (tmp_path / "b.bgz").write_bytes(blockgzip.pack(b"other\n1", 50))
    with pytest.raises(Exception, match="Another header"):
        blockgzip.read_delimited(spark, str(tmp_path)).collect()
    broken = bytearray(blockgzip.pack(b"x\n" * 400, 50))
    broken[-len(blockgzip.LAST_MEMBER) - 6] ^= 1
    (tmp_path / "d.bgz").write_bytes(bytes(broken))
    with pytest.raises(Exception, match="checksum"):
        blockgzip.read_lines(spark, str(tmp_path / "d.bgz")).collect()
    (tmp_path / "e.bgz").write_bytes(b"plain text, no member")
    with pytest.raises(Exception, match="wrong length"):
        blockgzip.read_lines(spark, str(tmp_path / "e.bgz")).collect()
    (tmp_path / "f.bgz").write_bytes(blockgzip.pack(b""))
    assert blockgzip.read_delimited(spark, str(tmp_path / "f.bgz")).columns == []


def test_written_files_are_read_back(spark, tmp_path):
    lines = spark.range(0, 30_000, 1, 3).selectExpr("concat(id, '\t', repeat('ab', CAST(id % 7 AS INT))) AS value")
    path = blockgzip.write_lines(lines, str(tmp_path / "out"), "id\ttext")
    back = blockgzip.read_delimited(spark, path)
    assert back.columns == ["id", "text"] and back.count() == 30_000
    assert back.where("coalesce(text, '') <> repeat('ab', CAST(id % 7 AS INT))").isEmpty()
    for part in (tmp_path / "out").glob("part-*"):
        assert gzip.decompress(part.read_bytes()).startswith(b"id\ttext\n")

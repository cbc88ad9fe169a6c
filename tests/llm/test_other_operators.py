"""SimHash classes, nearest neighbours, chat windows, archives, the pipeline and the queries, against plain versions."""

import hashlib
import io
import random
import struct
import zipfile

import numpy as np
import pytest
import xxhash

from strandline.llm import chat, components, multi_index, queries, simhash_index, warc

SF = "/root/testdata/sf0.001"
rng = random.Random(8)



@pytest.fixture(autouse=True)
def same_draws(request):
    """Each test draws the same values, whichever tests run before it."""
    rng.seed(request.node.name)


def classes(values, bits=2):
    x = np.array(values, dtype=np.uint64)
    parent = list(range(len(x)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(x)):
        for j in np.nonzero(np.bitwise_count(x ^ x[i]) <= bits)[0]:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(x))]


@pytest.mark.parametrize("crowded", [1, 3, 10_000])
def test_links_give_the_classes_of_all_pairs(spark, crowded):
    values = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(14):  # walks of small steps, so that classes are chains
            base ^= sum({1 << rng.randrange(64) for _ in range(rng.randint(1, 3))})
            values.add(base)
    center = rng.getrandbits(64)
    values |= {center ^ (1 << i) for i in range(0, 64, 3)} | {center ^ (1 << i) ^ (1 << (i * 7 % 64)) for i in range(20)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    out = simhash_index.fingerprint_classes(spark.createDataFrame([(v,) for v in signed], "fp long"), crowded).collect()
    root = {r["fp"]: r["root"] for r in out}
    want = classes(values)
    groups = {}
    for v, w in zip(signed, want):
        groups.setdefault(w, []).append(v)
    for members in groups.values():
        if len(members) > 1:
            assert {root[m] for m in members} == {min(members)}
        else:
            assert members[0] not in root


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (7, 7)]
    out = dict(components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert out == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def plain_simhash(text):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_report_and_stage(spark):
    text = " ".join(f"w{rng.randrange(50)}" for _ in range(400))
    rows = [(1, None, 9), (2, "", 9), (3, " \t", 9), (4, text, 9), (5, text.upper(), 9), (6, text + " end", 9), (6, text + " end", 9),
            (None, text, 9), (8, "é É x", 9), (9, "two words", 9), (None, "alone in the world", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _fp int")
    out = simhash_index.simhash_report(docs).collect()
    want = classes([plain_simhash(r[1]) for r in rows])
    least = {w: min((r[0] for r, x in zip(rows, want) if x == w and r[0] is not None), default=None) for w in want}
    expected = sorted((str(r[0]), f"{plain_simhash(r[1]):016x}", str(least[w])) for r, w in zip(rows, want))
    assert sorted((str(r[0]), r[1], str(r[2])) for r in out) == expected
    kept = simhash_index.stage(spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == len(set(want))
    assert {r["doc_id"] for r in kept.collect()} == set(least.values())
    assert simhash_index.simhash_report(docs.limit(0)).count() == simhash_index.stage(spark, docs.limit(0), "").count() == 0


# ---- nearest neighbours ---------------------------------------------------

def test_traversal_is_in_order():
    a, b = np.array([3.0, 1.0, 2.0]), np.array([5.0, 0.5])
    seen = list(multi_index.traverse(a, b))
    assert len(set(seen)) == 6 and [a[i] + b[j] for i, j in seen] == sorted(a[i] + b[j] for i, j in seen)


def neighbours(x, ids, k):
    out = {}
    for i in np.nonzero(ids % 100 == 0)[0]:
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        out[int(ids[i])] = [(int(ids[j]), float(d[j])) for j in np.lexsort((ids, d))[:k] if np.isfinite(d[j])]
    return out


def test_neighbours_and_recall(spark):
    r = np.random.default_rng(4)
    x = np.concatenate([r.normal(0, 1, (1500, 8)), np.repeat(r.normal(0, 1, (1, 8)), 700, axis=0)])  # a hot cell
    ids = np.arange(len(x))
    rows = [(int(i), [float(v) for v in row], 1) for i, row in zip(ids, x)]
    rows += [(10_000, None, 1), (10_100, [0.0] * 8, 1), (10_200, [float("nan")] * 8, 1), (10_300, [1.0] * 3, 1),
             (10_400, [None] * 8, 1), (None, [1.0] * 8, 1), (10_500, [float("inf")] * 8, 1), rows[100]]
    out = multi_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")).collect()
    want, got = neighbours(x, ids, 10), {}
    for r_ in sorted(out, key=lambda z: z["rank"]):
        got.setdefault(r_["query_id"], []).append((r_["vec_id"], r_["score"]))
        assert r_["score"] == pytest.approx(float(np.sqrt(((x[r_["query_id"]] - x[r_["vec_id"]]) ** 2).sum())), abs=1e-12)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 10 * len(want)


def test_few_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0]), (100, [2.0, 0.0])]
    out = multi_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted((r[0], r[1], r[2]) for r in out) == [(0, 1, 100), (0, 2, 1), (0, 3, 2), (100, 1, 0), (100, 2, 1), (100, 3, 2)]
    assert multi_index.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_neighbours_of_rows_that_share_an_id_or_differ_in_length(spark):
    r = np.random.default_rng(5)
    rows = [(int(i % 40) * 50, [float(v) for v in r.normal(0, 1, 2 + i % 2)]) for i in range(160)]  # each id on four rows
    rows += [(100, [9.0]), (200, [8.0]), (7, rows[0][1]), rows[3]]
    distinct = sorted({(i, tuple(v)) for i, v in rows})
    want = []
    for q, (i, v) in enumerate(distinct):
        near = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j) for c, (j, w) in enumerate(distinct)
                      if c != q and len(w) == len(v))
        want += [(i, n + 1, j, round(d, 9)) for n, (d, j) in enumerate(near[:10])] if i % 100 == 0 else []
    out = multi_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), rows=1000).collect()
    assert sorted((x[0], x[1], x[2], round(x[3], 9)) for x in out) == sorted(want)


# ---- chat -----------------------------------------------------------------

@pytest.mark.parametrize("budget,history", [(40, 15), (30, 0), (100_000, 10)])
def test_windows_hold_every_turn_once(spark, budget, history):
    marks = ["<|im_end|>", "<\\|im_sep|>", "[INST]", "[\\\\/INST]", "</s>", "<s>", "$1", "\\", "\n", "é"]
    rows = []
    for c in range(25):
        n = rng.randint(1, 30)
        for t in range(n):
            role = "system" if t == 0 and c % 3 == 0 else rng.choice(["user", "assistant", "assistant", None, "<|im_sep|>"])
            text = None if rng.random() < 0.1 else " ".join(rng.choice(["word", *marks]) for _ in range(rng.randint(0, 30)))
            rows.append((c if c else None, t, role, text, 1))
    rows += [(77, None, "assistant", "tie", 1), (77, 1, "assistant", "b", 1), (77, 1, "assistant", "b", 1), (77, 1, "assistant", "a", 1)]
    windows = chat.chat_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window int"),
                                budget, history)
    conv = {}
    for r in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        conv.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {r["conv_id"]: r for r in chat.chat_report(windows).collect()}
    assert set(out) == set(conv)
    for c, turns in conv.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        r = out[c]
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    shown = {}
    for w in windows.collect():
        shown[w["conv_id"]] = shown.get(w["conv_id"], 0) + len(w["formatted"])
        tokens = len(__import__("regex").findall(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]", w["formatted"]))
        assert w["formatted"].startswith(chat.START) and w["formatted"].endswith(chat.END) and tokens
        if (conv[w["conv_id"]][0][0]) == "system":
            assert w["formatted"].startswith("<|im_start|>system<|im_sep|>")
    assert shown == {c: r["formatted_chars"] for c, r in out.items()}
    if budget > 1000:
        assert windows.count() == len(conv)
    assert chat.chat_report(windows.limit(0)).count() == 0


# ---- archives -------------------------------------------------------------

def test_zip_directories():
    payload = [(str(i), warc.warc_record(i, "http://x", b"p" * i, "d", None)) for i in range(20)]
    data = warc.package(payload)
    assert [m.name for m in warc.zip_members(warc.Ranges(data))] == [warc.RECORD_MEMBER, warc.INDEX_MEMBER]
    assert zipfile.ZipFile(io.BytesIO(data)).testzip() is None
    assert [p for _, p in warc.read_package(io.BytesIO(data))] == [b"p" * i for i in range(20)]
    # the same package with ZIP64 records: sizes and offsets of the directory moved to the wide fields
    end = data.rindex(b"PK\x05\x06")
    count, size, start = struct.unpack_from("<HII", data, end + 10)
    directory, wide, p = data[start:start + size], b"", 0
    for _ in range(count):
        packed, full = struct.unpack_from("<II", directory, p + 20)
        n, x, c = struct.unpack_from("<HHH", directory, p + 28)
        offset = struct.unpack_from("<I", directory, p + 42)[0]
        extra = struct.pack("<HHQQQ", 1, 24, full, packed, offset)
        wide += (directory[p:p + 20] + struct.pack("<II", 2**32 - 1, 2**32 - 1) + struct.pack("<HHH", n, len(extra), 0)
                 + directory[p + 34:p + 42] + struct.pack("<I", 2**32 - 1) + directory[p + 46:p + 46 + n] + extra)
        p += 46 + n + x + c
    at = start + len(wide)
    tail = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, count, count, len(wide), start)
    tail += struct.pack("<4sIQI", b"PK\x06\x07", 0, at, 1)
    tail += struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 2**16 - 1, 2**16 - 1, 2**32 - 1, 2**32 - 1, 0)
    big = data[:start] + wide + tail
    assert [p for _, p in warc.read_package(big)] == [b"p" * i for i in range(20)]


def test_archives_round_trip(spark):
    long, other = "é" * 70, "z" * 200
    rows = [(1, "u", long), (2, None, long), (3, "u\nv", other), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""),
            (None, "u", other), (8, "u", "x" * 99), (9, "u", "x" * 99), (10, "u", "y" * 100), (10, "u", "y" * 100), (11, "u", "y" * 100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = warc.warc_round_trip(pages).collect()
    data = [(r[2] or "").encode() for r in rows]
    first = {}
    for (i, *_), d in zip(rows, data):
        if len(d) >= 100 and i is not None:
            first[d] = min(first.get(d, i), i)
    want = [(i, len(d), hashlib.sha256(d).hexdigest(), "response" if first.get(d, i) == i else "revisit",
             None if first.get(d, i) == i else first[d]) for (i, *_), d in zip(rows, data)]
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


# ---- queries and pipeline -------------------------------------------------

def test_queries_are_registered():
    from __spark_entry__ import oracle_sql, queries as registered
    assert set(queries.QUERIES) <= set(registered()) and set(queries.ORACLE_SQL) <= set(oracle_sql())
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in queries.QUERIES if q != "pipeline"}


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    docs = queries.table(spark, SF, "documents")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    texts = dict(docs.select("doc_id", "text").collect())
    toxic = {r["doc_id"] for r in queries.op4_toxicity(spark, SF).where("predicted = 1").collect()}
    seen, now = {}, docs
    for name, stage in cp.STAGES:
        now = cp.rewritten(stage(spark, now, SF), name)
        seen[name] = now.collect()
        if name != "bpe":
            assert now.columns == docs.columns
    assert {r["doc_id"] for r in seen["toxicity"]} == ids - toxic
    kept = sorted(ids - toxic)
    want = classes([plain_simhash(texts[i]) for i in kept])
    assert {r["doc_id"] for r in seen["simhash"]} == {kept[w] for w in want}
    assert len(seen["secrets"]) == len(seen["simhash"]) and not any("token = \"" in r["text"] for r in seen["secrets"])
    assert {r["doc_id"] for r in seen["mixing"]} <= {r["doc_id"] for r in seen["secrets"]}
    assert len(seen["bpe"]) == len(seen["mixing"])
    hashes = sorted((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in seen["mixing"])
    assert hashes == sorted((r["doc_id"], r["decoded_sha256"]) for r in seen["bpe"])

"""Hard negatives, line de-duplication and spelling variants against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import hard_negatives, line_dedup, queries, spelling

SF = "/root/testdata/sf0.001"
rng = random.Random(5)


@pytest.fixture(autouse=True)
def same_draws(request):
    rng.seed(request.node.name)


# ---- hard negatives ---------------------------------------------------------

def plain_negatives(rows, low=30, high=90):
    """rows: (id, label, vector). Brute force of the contract, in Python integers."""
    kept = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, lab, v) in enumerate(kept):
        if i % 100:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for k, (j, other, w) in enumerate(kept)
                        if k != at and len(w) == len(v))
        for minus, j, _ in [s for s in scores if s[2] == lab][:5]:
            fit = [s for s in scores if s[2] != lab and 30 * -minus <= 100 * -s[0] <= 90 * -minus][:10]
            out += [(i, j, rank, s[1], -minus, -s[0]) for rank, s in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame(rows, "id long, label int, vector array<double>")
    got = hard_negatives.hard_negatives(df)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def clustered(n, dim, centres, spread, seed=3):
    g = np.random.default_rng(seed)
    c = g.normal(size=(centres, dim))
    return [(int(i), int(g.integers(0, 4)), (c[g.integers(0, centres)] + spread * g.normal(size=dim)).tolist())
            for i in range(n)]


@pytest.mark.parametrize("dim,centres,spread", [(3, 5, 0.2), (16, 400, 1.0), (1, 1, 1.0)])
def test_negatives_equal_all_pairs(spark, dim, centres, spread):
    rows = clustered(400, dim, centres, spread)
    assert mined(spark, rows) == plain_negatives(rows)


def test_negatives_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    base = clustered(230, 4, 6, 0.3)
    odd = [(300, None, [1.0, 1.0, 1.0, 1.0]), (301, 1, None), (302, 1, [1.0, None, 1.0, 1.0]), (400, 1, [nan, 1.0, 1.0, 1.0]),
           (401, 1, [inf, 1.0, 1.0, 1.0]), (None, 1, [1.0] * 4), (500, 1, [0.0] * 4), (501, 1, []), (600, 2, []), (602, 1, []),
           (700, 1, [1.0, 2.0]), (701, 1, [1.0, 2.5]), (702, 2, [1.0, 1.0]), (703, 2, [0.5, 0.4])]
    rows = base + odd + [base[100]] * 3 + [(9, 2, base[100][2])] * 12  # repeated anchors, ids and vectors
    assert mined(spark, rows) == plain_negatives(rows)
    assert mined(spark, base[1:50]) == [] == mined(spark, [])


def test_one_vector_may_hold_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TREE_ROWS", 64)
    rows = clustered(300, 5, 8, 0.3)
    rows += [(1000 + i, i % 3, rows[7][2]) for i in range(150)]
    assert mined(spark, rows) == plain_negatives(rows)
    prepared = hard_negatives.prepared(spark.createDataFrame(rows, "id long, label int, vector array<double>"))
    sizes = [r[0] for r in hard_negatives.trees(prepared).select(F.size("ids")).collect()]
    assert sum(sizes) == 450 and max(sizes) <= 130


def test_large_components_are_compared_in_whole_numbers(spark):
    rows = [(i, i % 2, [2.0**21 + i / 256, 2.0**21 - i / 128, 1.0 + i]) for i in range(0, 220)]
    assert mined(spark, rows) == plain_negatives(rows)
    longest = [(0, 0, [3e38, 1.0]), (1, 0, [1.0, 1.0]), (100, 0, [1.0, 1.0]), (2, 1, [0.5, 0.5])]
    assert mined(spark, longest) == plain_negatives(longest[1:])  # no long score with the first


@pytest.mark.parametrize("centres,spread,most", [(40, 0.02, 0.25), (2000, 1.0, 1.6)])
def test_trees_cover_their_rows_and_skip_nodes(centres, spread, most):
    x = np.array([r[2] for r in clustered(2000, 8, centres, spread)])
    x = np.floor(256 * x)
    tree = hard_negatives.CoverTree.build(x)
    y = np.column_stack([x, np.sqrt(np.maximum((x**2).sum(axis=1).max() - (x**2).sum(axis=1), 0))])
    assert sorted(tree.order) == list(range(2000))
    for i, c in enumerate(tree.centre):
        below = tree.order[tree.start[i]:tree.stop[i]]
        far = np.sqrt(((y[below] - y[c]) ** 2).sum(axis=1)).max()
        assert far <= tree.radius[i] + 1e-6 and c in below
        for j in range(tree.child[i], tree.child[i] + tree.n_child[i]):
            assert tree.start[i] <= tree.start[j] <= tree.stop[j] <= tree.stop[i]
            assert tree.radius[j] <= hard_negatives.SHRINK * tree.radius[i] + 1e-6
    ids, fits, taken = np.arange(2000), np.ones(2000, bool), 0
    for q in x[:20]:
        score = (x @ q).astype(np.int64)
        for low, high in ((-(2**62), 2**62), (0, int(0.5 * (q @ q)))):
            w = hard_negatives.Windows([low], [high], 10)
            taken += hard_negatives.descend(tree, q, float((x**2).sum(axis=1).max()), fits, ids, w)
            want = sorted((-s, i) for i, s in enumerate(score.tolist()) if low <= s <= high)[:10]
            assert sorted((-s, -i) for s, i in w.found[0]) == want
    assert taken <= most * 40 * 2000


# ---- line de-duplication ----------------------------------------------------

WHITE = " \t\n\x0b\x0c\r"


def plain_lines(rows):
    """(doc_id, lines, dropped, digest) of rows (doc_id, text)."""
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))
    first = {}
    last = float("inf")
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                first[key(line)] = min(first.get(key(line), last), last if doc is None else doc)
    out = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if len(key(x)) < 10 or first[key(x)] == (last if doc is None else doc)]
        out.append((doc, len(all_lines), len(all_lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def reported(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.line_report(df).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    return sorted((tuple(r) for r in got), key=str)


ODD_LINES = [(5, "A shared line here\nown line of five\n\n"), (2, "  a SHARED line here\t\r\nx\nx"), (9, None), (1, ""),
             (7, "\x0b a shared LINE here\x0c"), (None, "a shared line here\nonly without id"), (None, "only WITHOUT id"),
             (3, "Ünder the ÄPFEL\nünder the äpfel"), (4, "Ünder the ÄPFEL\nünder THE äpfel"), (4, "own own own own\nown own own own"),
             (6, "\n" * 50 + "short\nown own own own"), (8, " a shared line here"), (2, "  a SHARED line here\t\r\nx\nx"),
             (11, "tiny one\nTINY ONE\nnine char"), (12, "nine char\ntiny one"), (13, "own own own own"), (13, "\U0001d4b3" * 9),
             (14, "\U0001d4b3" * 10), (15, "\U0001d4b3" * 10 + "\n" + "\U0001d4b3" * 9)]


def test_lines_equal_a_plain_version(spark):
    assert reported(spark, ODD_LINES) == plain_lines(ODD_LINES)
    assert reported(spark, []) == []
    words = ["alpha beta gamma", "delta epsilon", "ZETA eta theta", "x", "", "iota kappa lambda mu"]
    rows = [(rng.choice([None, *range(40)]), "\n".join(rng.choices(words, k=rng.randint(0, 60))
                                                        + [f"line {rng.randint(0, 200)} of many"])) for _ in range(150)]
    rows.append((77, "\n".join(f"long text, line {i % 7000}" for i in range(20_000))))
    assert reported(spark, rows) == plain_lines(rows)


def test_frequent_lines_are_not_dealt_by_hash(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SAMPLE", 1)
    rows = [(i, f"the line that all documents hold\nown line number {i}") for i in range(300, 0, -1)]
    each = line_dedup.keyed_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert line_dedup.frequent_keys(each).count() == 1
    assert reported(spark, rows) == plain_lines(rows)


def test_bitmaps_hold_runs_of_kept_lines(spark):
    rows = [(1, "one line to share\nanother to share"), (2, "a\nb\none line to share\nANOTHER to share\nc\none line to share")]
    got = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["keep_runs"] for r in got} == {1: None, 2: "0+2,4+1"}


def test_deduped_documents_keep_their_other_columns(spark):
    rows = [(1, "t1", "one line to share", 5, "x"), (2, "t2", "one line to share\nrest", 6, None)]
    df = spark.createDataFrame(rows, "doc_id long, h1 string, text string, n int, `keep` string")
    out = line_dedup.dedup_lines(df)
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == [rows[0], (2, "t2", "rest", 6, None)]


def test_line_plan_runs_no_python(spark):
    df = queries.op12_line_dedup(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
    assert "rangepartitioning" in plan


# ---- spelling variants ------------------------------------------------------

def plain_counts(rows, slip=199):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(low)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            n[w if h % slip else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def plain_variants(counts, ratio=5):
    """(word, form, root, n, n_near, form_n) by comparing words that agree but for one place."""
    at = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            at[w[:i] + "?" + w[i + 1:]].add(w)      # replaced
    near = defaultdict(set)
    for group in at.values():
        for w in group:
            near[w] |= group - {w}
    for w in counts:
        for i in range(len(w)):
            if (short := w[:i] + w[i + 1:]) in counts:  # inserted or deleted
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w, n in counts.items():
        if near[w] and counts[top := min(near[w], key=lambda x: (-counts[x], x))] >= ratio * n:
            form[w] = top

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None)
                  for w, n in counts.items())


def variants(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_spelling_joins_pass_nothing_through_the_driver(spark):
    df = spark.createDataFrame([("spelling", 50), ("speling", 5), ("spellings", 9)], "word string, n long")
    words = spelling.rewritten(df, "test-words")  # a file far below any broadcast threshold
    for out in (spelling.links(words), spelling.spelling_variants(df)):
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_spelling_report_equals_a_plain_version(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain_variants(plain_counts(docs))
    assert variants(queries.op13_spelling(spark, SF)) == want and len(want) > 100 and any(r[1] for r in want)


def test_words_of_odd_texts(spark):
    base = ["Recieve", "receive", "RECEIVE", "Étésété", "étésété", "straßen×x", "naïvetéÿ",
            "Łódzkie", "ábcdefgh", "\U0001d4b3abcdefg", "abcdef1ghijkl", "x" * 3000, "x" * 2999]
    rows = [(d, " ".join(rng.choices(base, k=30))) for d in [None, None, 1, 1, 2, -3, 199, 2**60]] + [(4, None), (5, "")]
    df = spark.createDataFrame([(d, t, "w", 3) for d, t in rows], "doc_id long, text string, word string, n int")
    got = {r["word"]: r["n"] for r in spelling.word_counts(df, spelling.SLIP).collect()}
    assert got == plain_counts(rows)
    assert variants(spelling.spelling_report(df)) == plain_variants(plain_counts(rows))
    assert variants(spelling.spelling_report(df.where("doc_id = 5"))) == []


def test_every_near_pair_shares_a_first_signature(spark):
    """Small alphabets make many anagrams and near pairs; chains of forms are followed to the last."""
    words = {"".join(rng.choices("abcé", k=rng.randint(6, 9))) for _ in range(700)}
    counts = {w: 5 * 6 ** rng.randint(0, 5) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = plain_variants(counts)
    assert variants(spelling.spelling_variants(df)) == want
    assert any(r[1] and r[2] != r[1] for r in want)
    pairs = [tuple(sorted((r["u"], r["v"]))) for r in spelling.links(df).collect()]
    assert len(pairs) == len(set(pairs)) == sum(r[4] for r in want) / 2


def test_a_word_near_very_many_others(spark):
    hub = "hubwords"
    counts = {hub: 10**6}
    counts |= {hub[:i] + chr(224 + c) + hub[i:]: 5 + c for i in range(len(hub) + 1) for c in range(32)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert variants(spelling.spelling_variants(df)) == plain_variants(counts)

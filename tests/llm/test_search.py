"""Exact top-k, hard negatives and reversed lexical search against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import odd
from wardstone.llm import hard_negatives, lexical, mtree, vectors


def clustered(n, width=8, seed=3, centres=12, spread=12):
    """Vectors round a few centres, with exact copies and ties."""
    draw = np.random.default_rng(seed)
    middle = draw.integers(-200, 200, (centres, width))
    out = middle[draw.integers(0, centres, n)] + draw.integers(-spread, spread + 1, (n, width))
    out[n // 2 : n // 2 + n // 10] = out[0]
    return out


def best(values, ids, at, k):
    scores = values @ values[at]
    return sorted(((-int(s), int(i)) for s, i in zip(scores, ids) if i != ids[at]))[:k]


# M-tree


def test_tree_pages_cover_what_lies_below():
    values = clustered(3000).astype(float)
    tree = mtree.build(np.arange(3000), values)
    assert sorted(tree.ids) == list(range(3000)) and (tree.values == values[tree.ids]).all()

    def rows_below(page):
        if tree.leaf[page]:
            return list(range(tree.low[page], tree.high[page]))
        return [row for child in range(tree.low[page], tree.high[page]) for row in rows_below(child)]

    for page in range(len(tree.low)):
        rows, centre = rows_below(page), tree.values[tree.routing[page]]
        far = np.sqrt(((tree.values[rows] - centre) ** 2).sum(1))
        assert tree.routing[page] in rows and math.isclose(far.max(), tree.radius[page])
        assert tree.reach[page] == (tree.values[rows] ** 2).sum(1).max()
        if tree.leaf[page]:
            assert len(rows) <= mtree.PAGE and np.allclose(tree.row_apart[rows], far)
        else:
            children = np.arange(tree.low[page], tree.high[page])
            apart = np.sqrt(((tree.values[tree.routing[children]] - centre) ** 2).sum(1))
            assert np.allclose(tree.apart[children], apart)


def test_bounds_spare_most_products_and_lose_nothing():
    values = clustered(6000, centres=60, spread=4).astype(float)
    tree, ids = mtree.build(np.arange(6000), values), np.arange(6000)
    spent = 0
    for at in range(0, 6000, 97):
        found, reckoned = mtree.best_first(tree, at, values[at], 5)
        spent += reckoned
        assert sorted((-s, i) for s, i in found) == best(values, ids, at, 5)
    assert spent < 0.35 * 6000 * len(range(0, 6000, 97))


def test_a_floor_is_a_bound_not_a_result():
    values = clustered(500).astype(float)
    tree = mtree.build(np.arange(500), values)
    wanted = best(values, np.arange(500), 7, 10)
    found, _ = mtree.best_first(tree, 7, values[7], 10, float(-wanted[-1][0]))
    assert sorted((-s, i) for s, i in found) == wanted
    assert mtree.best_first(tree, 7, values[7], 10, 1e12)[0] == []


@pytest.mark.parametrize("cell_rows, bin_rows", [(10_000, 10_000), (40, 30)])
def test_top_k_equals_brute_force(spark, cell_rows, bin_rows):
    values = clustered(900)
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values.tolist())] + [(5, values[5].tolist())], "vec_id long, v array<bigint>")
    found = mtree.index(rows.repartition(3), cell_rows, bin_rows)
    queries = found.rows.where("vec_id % 60 = 0").select(F.col("vec_id").alias("query_id"), "v")
    got = {}
    for row in mtree.search(found, queries, 7).collect():
        got.setdefault(row.query_id, []).append((row["rank"], -row.score, row.vec_id))
    assert set(got) == set(range(0, 900, 60))
    for query, each in got.items():
        assert [x[1:] for x in sorted(each)] == best(values, np.arange(900), query, 7)


@pytest.mark.parametrize("scale", [1, 1 << 14])
def test_blocks_of_queries_have_the_best_rows_and_open_few_pages(scale):
    values = clustered(6000, centres=60, spread=4).astype(float) * scale
    tree, ids = mtree.build(np.arange(6000), values), np.arange(6000)
    most = float((values**2).sum(1).max())
    single = tree.values.astype(np.float32) if vectors.single(most) is np.float32 else None
    assert (single is None) == (scale > 1)
    own = np.arange(0, 6000, 97)
    own = own[np.lexsort(values[own].T)]
    spent = 0
    for begin in range(0, len(own), 2):  # blocks of near queries
        at = own[begin : begin + 2]
        asked = mtree.Asked(at, values[at], 5, np.full(len(at), -np.inf))
        mtree.best_of_block(tree, asked, None, single)
        again = mtree.Asked(at, values[at], 5, asked.least)
        spent += mtree.best_of_block(tree, again, None, single)
        for i, query in enumerate(at):
            wanted = best(values, ids, query, 5)
            for one in (asked, again):
                assert sorted((-s, v) for s, v in zip(one.score[one.at == i].tolist(), one.vec_id[one.at == i].tolist())) == wanted
        assert mtree.best_of_block(tree, again, np.zeros(0, np.int64), single) == 0
    assert spent < 0.5 * 6000 * len(own)


def test_search_takes_no_blocks_of_queries_for_a_small_table(spark):
    """Spark reckoned packed rows by the bytes of a column's file, and sent them all to the driver to broadcast them."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(clustered(900).tolist())], "vec_id long, v array<bigint>")
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").removesuffix("b")) > 0
    plan = mtree.top_k(rows, F.col("vec_id") % 10 == 0, 3)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Broadcast" not in plan


def odd_vectors(spark, empty=False):
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, None, 1), (2, [], 1), (3, [1.0, None], 1), (4, [float("nan"), 1.0], 1), (5, [float("inf"), 1.0], 1),
        (6, [2.0, 1.0], None), (None, [9.0, 9.0], 1), (8, [0.5, 0.5], 2), (9, [0.5, 0.5], 1), (10, [0.5], 2), (100, [-1.0, -2.0], 1),
    ]
    return spark.createDataFrame([] if empty else [(*r, "x", "x", "x") for r in rows], "vec_id long, embedding array<float>, label int, v string, cell string, far string")


def test_top_k_of_odd_vectors(spark):
    rows = odd_vectors(spark)
    rows = rows.where(vectors.whole(F.col("embedding"))).select("vec_id", vectors.scaled(F.col("embedding"), 4).alias("v"), "cell")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in mtree.top_k(rows, F.col("vec_id") % 100 == 0, 3).collect()]
    assert sorted(got) == [(0, 1, 6, 64), (0, 2, 8, 24), (0, 3, 9, 24), (100, 1, 2, 0), (100, 2, 10, -8), (100, 3, 8, -24)]
    none = odd_vectors(spark, empty=True).select("vec_id", vectors.scaled(F.col("embedding"), 4).alias("v"))
    assert mtree.top_k(none, F.col("vec_id") % 100 == 0, 3).collect() == []


def test_products_beyond_53_bits_are_refused(spark):
    rows = spark.createDataFrame([(1, [2**40, 1])], "vec_id long, v array<bigint>")
    with pytest.raises(ValueError, match="53 bits"):
        mtree.index(rows)


# Hard negatives


def mined_plainly(rows, positives=5, negatives=5):
    """rows: (vec_id, label, vector)."""
    out = []
    for a, label, v in (r for r in rows if r[0] % 100 == 0):
        scored = [(-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in rows if i != a]
        own = sorted((s, i) for s, i, other in scored if other == label)[:positives]
        for p, pos in own:
            below = sorted((s, i) for s, i, other in scored if other != label and 80 * -p <= 100 * -s <= 100 * -p)[:negatives]
            out += [(a, pos, rank, neg, -p, -s) for rank, (s, neg) in enumerate(below, 1)]
    return sorted(out)


@pytest.mark.parametrize("block, chunk", [(256, 4096), (4, 64)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "CHUNK", chunk)
    values, draw = clustered(1500, seed=5), random.Random(1)
    rows = [(i, draw.randrange(4), v) for i, v in enumerate(values.tolist())]
    df = spark.createDataFrame(rows + rows[:40], "vec_id long, label int, v array<bigint>").repartition(5)
    got = sorted(tuple(r) for r in hard_negatives.mined(df, F.col("vec_id") % 100 == 0).collect())
    assert got == mined_plainly(rows) and len(got) > 100


@pytest.mark.parametrize("spared", [0, 1 << 40])
def test_hard_negatives_by_the_tree_or_in_products(spark, monkeypatch, spared):
    """Both ways give the rows of plain Python, for lanes of many chunks too."""
    for name, value in (("SPARED", spared), ("CHUNK", 64), ("TRIED", 10), ("BLOCK", 8), ("LANES_EACH", 0)):
        monkeypatch.setattr(hard_negatives, name, value)
    values, draw = clustered(1200, seed=6), random.Random(2)
    rows = [(i, draw.randrange(3), v) for i, v in enumerate(values.tolist())]
    df = spark.createDataFrame(rows + rows[:40], "vec_id long, label int, v array<bigint>").repartition(4)
    assert sorted(tuple(r) for r in hard_negatives.mined(df, F.col("vec_id") % 100 == 0).collect()) == mined_plainly(rows)


def test_blocks_of_anchors_are_not_taken_for_a_small_table(spark):
    """Spark broadcast a copy of each block for each lane, through the driver."""
    rows = spark.createDataFrame([(i, i % 3, v) for i, v in enumerate(clustered(900).tolist())], "vec_id long, label int, v array<bigint>")
    plan = hard_negatives.mined(rows, F.col("vec_id") % 10 == 0)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Broadcast" not in plan


def test_tree_bounds_spare_products_and_keep_the_windows():
    values = clustered(2000, seed=9, centres=40, spread=3).astype(float)
    anchors = values[:30] + np.arange(30)[:, None] % 3
    tree, norms = hard_negatives.spanning_tree(anchors), np.sqrt((values**2).sum(1))
    assert sorted(tree[0]) == list(range(30)) and (tree[1] < 0).sum() == 1
    windows = {at: (np.quantile(values @ anchors[at], 0.95), np.quantile(values @ anchors[at], 0.99)) for at in range(30)}
    scored = 0
    for at, picked, scores in hard_negatives.overlapping(anchors, tree, values, norms, lambda at: np.ones(2000, bool), windows.get):
        exact = values @ anchors[at]
        assert (exact[picked] == scores).all()
        assert set(np.flatnonzero((exact >= windows[at][0]) & (exact <= windows[at][1]))) <= set(picked)
        scored += len(picked)
    assert scored < 0.6 * 30 * 2000


def test_hard_negatives_of_odd_rows(spark):
    rows = odd_vectors(spark).where(vectors.whole(F.col("embedding"))).select("vec_id", "label", vectors.scaled(F.col("embedding"), 4).alias("v"), "cell")
    got = [tuple(r) for r in hard_negatives.mined(rows, F.col("vec_id") % 100 == 0).collect()]
    # positives of 0: 9 (24), 2 (0), 100 (below 0); of 100: 2 (0), 9 and 0 (below 0)
    assert sorted(got) == [(0, 9, 1, 8, 24, 24)]
    none = odd_vectors(spark, empty=True).select("vec_id", "label", vectors.scaled(F.col("embedding"), 4).alias("v"))
    assert hard_negatives.mined(none, F.col("vec_id") % 100 == 0).collect() == []


# Reversed lexical search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def ranked_plainly(docs, items, n=10):
    counts = [(i, Counter(split(text))) for i, text in docs]
    held = Counter(t for _, c in counts for t in c)
    number, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for doc, c in counts:
            size, s = sum(c.values()), 0
            for t in split(text):
                if c[t]:
                    m = 25 + 75 * size * number // total
                    s += math.floor(1000 * math.log((2 * number + 2) / (2 * held[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        out += [(item, rank, None if null else doc, -s) for rank, (s, null, doc) in enumerate(sorted(scores)[:n], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes, sums", [(1 << 20, 1 << 21), (60, 16)])
def test_ranking_equals_brute_force(spark, monkeypatch, block_bytes, sums):
    monkeypatch.setattr(lexical, "SUMS", sums)
    draw = random.Random(4)
    words = ["Alpha", "beta", "GAMMA", "délta", "ε", "x1", "zz9", "你好", "co-op", "ÉTÉ", "é"] + [f"w{i}" for i in range(30)]
    docs = [(i, draw.choice([" ", "\n", ", "]).join(draw.choices(words, k=draw.randrange(0, 40)))) for i in range(150)]
    docs += [(7, docs[7][1]), (None, "alpha w1 w2"), (1000, None), (1001, "")]
    items = [(i, " ".join(draw.choices(words, k=6))) for i in range(12)] + [(3, "alpha"), (90, None), (91, "unknownword"), (92, "alpha alpha w1")]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string").repartition(4)
    got = lexical.ranked(frame, spark.createDataFrame(items + items[:2], "item_id long, text string"), block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == ranked_plainly(docs, items)


def test_terms_of_long_texts_are_not_cut(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(lexical, "SPAN", 7)
    texts = ["abcdefghijklmnop qrs", "", "tuv", "wxyz0123456789 a b", None, "é" * 9, "end"]
    found = [(int(r), t) for rows, each in lexical.terms(pa.array(texts)) for r, t in zip(rows, each.to_pylist())]
    assert found == [(i, t) for i, text in enumerate(texts) for t in split(text)]


def test_ranking_of_odd_documents(spark):
    items = spark.createDataFrame([(1, "alpha ONE"), (2, None), (3, "你好")], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in odd.docs(spark).collect()]
    got = sorted(map(tuple, lexical.ranked(odd.docs(spark), items).collect()), key=str)
    assert got == ranked_plainly(rows, [(1, "alpha ONE"), (2, None), (3, "你好")])
    assert lexical.ranked(odd.docs(spark, empty=True), items).collect() == []
    assert lexical.ranked(odd.docs(spark), items.where("false")).collect() == []

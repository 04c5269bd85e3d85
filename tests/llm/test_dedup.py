"""Line dedup, near-dedup and passage dedup against plain Python."""

import random
import re
from itertools import combinations

import pyarrow as pa
import pytest

from tests.llm import odd
from wardstone.llm import components, line_dedup, near_dedup, sieve, suffix_dedup


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_line_dedup_takes_odd_rows(spark):
    rows = line_dedup.remove_repeats(odd.docs(spark)).select("doc_id", "text", "doc", "__out.*").collect()
    assert len(rows) == 13 and all(r["doc"] == "x" for r in rows)
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[1]["kept_text"] is None and by[2]["kept_text"] == "" and by[3]["kept_text"] == " \n\t "
    assert by[5]["kept_text"] == odd.LONG and by[6]["n_removed"] == 1
    assert [r["kept_text"] for r in rows if r["doc_id"] == 7] == ["same text twice\nand a second line"] * 2
    assert by[8]["kept_text"] == "" and by[8]["n_removed"] == 2
    assert line_dedup.deduplicated(odd.docs(spark)).where("doc_id IN (6, 8)").count() == 0
    assert line_dedup.deduplicated(odd.docs(spark, empty=True)).count() == 0


@pytest.mark.parametrize("window", [2, 3])
def test_line_dedup_finds_every_run(spark, window):
    rng = random.Random(window)
    texts = ["\n".join(rng.choice(["a", "b", "c", "d", ""]) for _ in range(rng.randint(0, 9))) for _ in range(60)]
    seen, expected = set(), {}
    for doc, text in enumerate(texts):
        solid = line_dedup.solid_lines(text)
        gone = set()
        for i in range(len(solid) - window + 1):
            run = tuple(x for _, x in solid[i : i + window])
            if run in seen:
                gone |= {solid[k][0] for k in range(i, i + window)}
            seen.add(run)
        expected[doc] = "\n".join(x for at, x in enumerate(text.split("\n")) if at not in gone) if gone else text
    out = line_dedup.remove_repeats(frame(spark, texts), window).select("doc_id", "__out.kept_text").collect()
    assert {r[0]: r[1] for r in out} == expected


def near_texts(rng):
    words = [f"w{i}" for i in range(400)]
    texts = []
    for n in (12, 40, 120, 300):
        base = [rng.choice(words) for _ in range(n)]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, n // 12))):
                copy[rng.randrange(n)] = rng.choice(words)
            texts.append(" ".join(copy))
    shared = " ".join(rng.choice(words) for _ in range(90))
    texts += [shared + " " + " ".join(rng.choice(words) for _ in range(130)) for _ in range(14)]
    rng.shuffle(texts)
    return texts + texts[:3] + ["", "solo", "solo", "Solo"]


def groups_of(texts, width):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    group = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        shared = len(sets[i] & sets[j])
        if shared and 100 * shared >= 80 * len(sets[i] | sets[j]):
            low, high = sorted((group[i], group[j]))
            group = [low if g == high else g for g in group]
    return {i: (len(sets[i]), group[i]) for i in range(len(texts))}


@pytest.mark.parametrize(("short", "block"), [(64, 9), (3, 3), (1, 1000)])
def test_near_dedup_finds_every_link(spark, monkeypatch, short, block):
    monkeypatch.setattr(near_dedup, "SHORT", short)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = near_texts(random.Random(5))
    out = near_dedup.near_duplicates(frame(spark, texts), width=2).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == groups_of(texts, 2)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


@pytest.mark.parametrize("part", [40, 1000])
def test_long_lists_in_ranges_of_values(spark, monkeypatch, part):
    for name, value in (("SHORT", 1), ("BLOCK", 9), ("PART", part)):
        monkeypatch.setattr(near_dedup, name, value)
    texts = near_texts(random.Random(6))
    out = near_dedup.near_duplicates(frame(spark, texts), width=2).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == groups_of(texts, 2)


def test_cells_hold_one_range_and_are_few(spark, monkeypatch):
    rng = random.Random(7)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(w if rng.random() > 0.05 else f"x{rng.random()}" for w in base) for _ in range(60)]
    keys = [(0, 0, 0, 0, i, i, 30) for i in range(60)]
    rows = pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in zip(*keys)), pa.array(texts)], names=["low", "high", "x", "y", "id", "uid", "parts", "text"])
    held, overlaps = [], near_dedup._overlaps
    monkeypatch.setattr(near_dedup, "_overlaps", lambda sets: held.append(sum(map(len, sets))) or overlaps(sets))
    slices = pa.Table.from_batches(near_dedup._sliced(2)([rows])).sort_by("part").to_batches()
    links = [x for b in near_dedup._linked(iter(slices)) for x in zip(*b.to_pydict().values())]
    whole = sum(b - a for a, b in zip(*(lambda f: (f[:-1], f[1:]))(near_dedup.shingle_sets(pa.array(texts), 2)[1])))
    assert len(held) == 30 and sum(held) == whole and max(held) < whole / 8
    expected, group = groups_of(texts, 2), list(range(60))
    for a, b in links:
        low, high = sorted((group[a], group[b]))
        group = [low if g == high else g for g in group]
    assert group == [expected[i][1] for i in range(60)] and len(links) > 5
    values, first = near_dedup.shingle_sets(pa.array(texts), 2)
    sets = [(i, int(first[i + 1] - first[i]), [int(v) for v in near_dedup.signed(values[first[i] : first[i + 1]][:64])]) for i in range(60)]
    lists = near_dedup._lists(spark.createDataFrame(sets, "id long, n long, sketch array<long>"))
    assert near_dedup._cells(lists.where("m > 16")).count() < 60 * 12  # in place of one for each of its lists


def test_near_dedup_takes_odd_rows(spark):
    out = near_dedup.near_duplicates(odd.docs(spark)).collect()
    assert len(out) == 13
    by = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert all(by[i]["n_shingles"] == 0 and by[i]["component_id"] == i for i in (1, 2, 3))
    assert (by[6]["component_id"], by[8]["component_id"], by[10]["component_id"]) == (5, 7, 4)
    assert all(r["kept"] and r["component_id"] is None for r in out if r["doc_id"] is None)
    left = near_dedup.first_of_each(odd.docs(spark))
    assert left.columns == odd.docs(spark).columns and left.count() == 10
    assert near_dedup.near_duplicates(odd.docs(spark, empty=True)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 201), (201, 200)]
    got = {r[0]: r[1] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200}


def test_sieve_is_exact(spark, monkeypatch):
    monkeypatch.setattr(sieve, "MOST_BITS", 64)  # nearly full: the join must make it exact
    table = spark.createDataFrame([(i if i % 7 else None, "x") for i in range(500)], "k long, v string")
    ids = spark.range(0, 900, 3)
    assert {r[0] for r in sieve.listed(table, "k", ids).collect()} == {i for i in range(500) if i % 7 and i % 3 == 0}
    assert sorted(r[0] or -1 for r in sieve.unlisted(table, "k", ids).collect()) == sorted(-1 if i % 7 == 0 else i for i in range(500) if i % 7 == 0 or i % 3)


def test_passages_match_brute_force(spark):
    rng = random.Random(8)
    words = [f"v{i}" for i in range(200)]
    passage = [[rng.choice(words) for _ in range(n)] for n in (49, 50, 51, 80)]
    lists = []
    for _ in range(40):
        own = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(own))
            own[at:at] = rng.choice(passage)
        lists.append(own)
    lists += [["again"] * 130, ["again"] * 60]
    seen, expected = {}, set()
    for doc, own in enumerate(lists):
        hits = []
        for i in range(len(own) - 49):
            key = tuple(own[i : i + 50])
            if key in seen:
                hits.append((i, seen[key]))
            else:
                seen[key] = doc
        for k, (i, first) in enumerate(hits):
            if k == 0 or i - hits[k - 1][0] > 50:
                span = [i, i, first]
            span[1] = i
            if k + 1 == len(hits) or hits[k + 1][0] - i > 50:
                expected.add((doc, span[0], span[1] - span[0] + 50, span[2]))
    docs = frame(spark, [" ".join(x) for x in lists])
    assert {tuple(r) for r in suffix_dedup.repeats(docs).collect()} == expected and len(expected) > 10
    left = {r["doc_id"]: r["text"].split() for r in suffix_dedup.without(docs).collect()}
    for doc, first, n, _ in expected:
        assert len(left[doc]) == len(lists[doc]) - sum(x[2] for x in expected if x[0] == doc)


def test_passages_take_odd_rows(spark):
    out = suffix_dedup.repeats(odd.docs(spark)).collect()
    assert [(r["doc_id"], r["first_doc_id"]) for r in sorted(out)] == [(5, 5), (6, 5)]
    assert suffix_dedup.without(odd.docs(spark)).count() == 13
    assert suffix_dedup.repeats(odd.docs(spark, empty=True)).count() == 0


def test_steps_of_near_dedup_leave_no_shuffle_files(spark):
    """The files of all steps lay on the disks at once, until the driver collected its garbage."""
    import gc
    import time

    def files():
        return spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().size()

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    docs = spark.createDataFrame([(i, " ".join(f"w{(i // 3 * 40 + j) % 97}" for j in range(30))) for i in range(60)], "doc_id long, text string").repartition(8)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(3)
    before = files()
    out = near_dedup.near_duplicates(docs, 2)
    for _ in range(20):
        if files() <= before + 40:
            break
        time.sleep(0.5)
    assert files() <= before + 40 and spark.conf.get(name) == "false"
    assert {r.doc_id: r.component_id for r in out.collect()} == {r.doc_id: r.component_id for r in out.collect()}
    assert out.where("kept").count() < 60

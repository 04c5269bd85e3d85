"""Document fingerprints by SimHash, in DataFrame functions alone.

A text's terms are its pairs of neighbouring words (lower case, split at ASCII white space; the last word stands alone).
Every occurrence votes with the number of its characters, 24 at most: on each of 128 bits for or against, by the bits of
its two 64-bit hashes. The bit is the sign of the sum. Votes are summed two bits to a long, so a text may hold 2^32 votes.

`within_radius` finds all fingerprints within a Hamming radius of 6: of eight blocks of 16 bits at least two are equal
then. Every fingerprint stands in 28 tables, one for each pair of blocks, under these two blocks; looking all of them up
finds all partners, and the pair counts in the first table that has it, so nothing is found twice.

`edited` pairs each document with the next by descending doc_id. Documents are dealt into ranges of ids; the head of each
range also visits the range before, so that the next row is always in the same range, and texts move once.

Defined results: null and empty texts, and those without words, have the fingerprint of zeros. Null ids come last;
rows that share an id follow each other by hash and text. With one row, the next document is the row itself. Equal texts
have equal fingerprints. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardstone.llm.storage import cut

RADIUS = 6
BITS = 128
RANGE_ROWS = 500
MOST_RANGES = 100_000
LONGEST_VOTE = 24
SEEDS = (1, 2)

_LANES = "4294967297L"  # the lowest bit of either half of a long


def _votes() -> list[Column]:
    """Sums of the weights of terms with a bit set: bit i in the lower, bit i + 32 in the upper half of a long."""
    return [
        F.sum(F.shiftrightunsigned(f"hash_{k}", i).bitwiseAND(F.expr(_LANES)) * F.col("weight")).alias(f"votes_{k}_{i}")
        for k in range(len(SEEDS)) for i in range(32)
    ]


def _print(k: int) -> Column:
    bits = F.lit(0).cast("long")
    for i in range(32):
        votes, all_votes = F.col(f"votes_{k}_{i}"), F.col("weight")
        low = votes.bitwiseAND(F.expr("4294967295L")) * 2 > all_votes
        high = F.shiftrightunsigned(votes, 32) * 2 > all_votes
        bits = bits.bitwiseOR(F.shiftleft(low.cast("long"), i)).bitwiseOR(F.shiftleft(high.cast("long"), i + 32))
    return bits


def fingerprints(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, print_0, print_1 of every row; rows with equal keys must have equal texts and count once."""
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[ \\t\\n\\x0B\\f\\r]+")
    listed = rows.select(*keys, words.alias("words"))
    pairs = listed.select(*keys, F.inline(F.arrays_zip(F.col("words").alias("a"), F.expr("slice(words, 2, size(words))").alias("b"))).alias("a", "b"))
    weight = F.least(F.length("a") + F.coalesce(F.length("b"), F.lit(0)), F.lit(LONGEST_VOTE)).cast("long")
    terms = pairs.select(*keys, *(F.xxhash64("a", "b", F.lit(seed)).alias(f"hash_{k}") for k, seed in enumerate(SEEDS)), weight.alias("weight"))
    sums = terms.groupBy(*keys).agg(*_votes(), F.sum("weight").alias("weight"))
    return sums.select(*keys, *(_print(k).alias(f"print_{k}") for k in range(len(SEEDS))))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Share of equal bits."""
    return 1 - distance(a, b) / BITS


def distance(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b)), F.lit(0))


def shown(a: Column, b: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def _blocks(prints: tuple[Column, Column]) -> list[Column]:
    return [F.shiftrightunsigned(x, 16 * i).bitwiseAND(F.lit(65535)) for x in prints for i in range(4)]


def _tables(prints: DataFrame) -> DataFrame:
    blocks = _blocks((F.col("print_0"), F.col("print_1")))
    rows = [
        F.struct(F.lit((1 << i) | (1 << j)).alias("tables"), F.shiftleft(blocks[i], 16).bitwiseOR(blocks[j]).alias("key"))
        for i, j in combinations(range(8), 2)
    ]
    return prints.select("print_0", "print_1", F.inline(F.array(*rows)))


def within_radius(queries: DataFrame, prints: DataFrame) -> DataFrame:
    """query_0, query_1, print_0, print_1: every pair of distinct fingerprints that differ in RADIUS bits at most."""
    asked = _tables(queries.select("print_0", "print_1").distinct()).withColumnsRenamed({"print_0": "query_0", "print_1": "query_1"})
    known = _tables(prints.select("print_0", "print_1").distinct())
    own, other = (F.col("query_0"), F.col("query_1")), (F.col("print_0"), F.col("print_1"))
    equal = sum((F.shiftleft((x == y).cast("int"), i) for i, (x, y) in enumerate(zip(_blocks(own), _blocks(other)))), F.lit(0))
    rest = equal.bitwiseAND(equal - 1)
    first_two = equal.bitwiseAND(-equal).bitwiseOR(rest.bitwiseAND(-rest))
    near = (distance(own, other) <= RADIUS) & (distance(own, other) > 0) & (first_two == F.col("tables"))
    # Both sides grow with the documents, so neither is ever sent whole to every task.
    return asked.hint("merge").join(known, ["tables", "key"]).where(near).select("query_0", "query_1", "print_0", "print_1")


def _range_of(doc_id: Column, bounds: list[int]) -> Column:
    """The number of bounds below doc_id, found in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.lit([g[0] for g in groups[1:]]) if len(groups) > 1 else F.expr("CAST(array() AS array<bigint>)")
    group = F.size(F.filter(heads, lambda b: b < doc_id))
    own = F.element_at(F.array(*(F.lit(g) for g in groups)), group + 1)
    return F.coalesce(group * step + F.size(F.filter(own, lambda b: b < doc_id)), F.lit(0))


def with_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """range, place, visitor, doc_id, text, next_text: each document and the next by descending doc_id."""
    count = docs.count()
    number = max(1, min(MOST_RANGES, -(-count // range_rows)))
    shares = [i / number for i in range(1, number)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 10 * number)).first()[0] if shares else None
    bounds = sorted({int(b) for b in bounds or ()})
    dealt = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("range", _range_of(F.col("doc_id"), bounds))
    # One row a range, MOST_RANGES at most.
    heads = sorted((r["range"], r["head"]) for r in docs.select("doc_id", _range_of(F.col("doc_id"), bounds).alias("range")).groupBy("range").agg(F.max("doc_id").alias("head")).collect() if r["head"] is not None)
    spark = docs.sparkSession
    hosts = [(head, heads[(i + 1) % len(heads)][0]) for i, (_, head) in enumerate(heads)]
    if not hosts:
        hosts = [(None, 0)]
    visits = spark.createDataFrame(hosts, "head long, host int")
    joined = dealt.join(F.broadcast(visits), F.col("doc_id").eqNullSafe(F.col("head")), "left")
    places = F.array(F.struct(F.col("range"), F.lit(False).alias("visitor")), F.struct(F.col("host").alias("range"), F.lit(True).alias("visitor")))
    every = joined.select("doc_id", "text", F.inline(F.filter(places, lambda x: x["range"].isNotNull())))
    order = W.partitionBy("range").orderBy("visitor", F.desc_nulls_last("doc_id"), F.xxhash64("text"), "text")
    return every.select("range", F.row_number().over(order).alias("place"), "visitor", "doc_id", "text", F.lead("text").over(order).alias("next_text"))


def edited(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, and the prints of the text, of its edited text and of the next document.

    The edited text has the first characters of the next document for its last floor(n_chars / 2).
    """
    pairs = with_next(docs, range_rows)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    changed = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = pairs.select("range", "place", "visitor", "doc_id", n.cast("long").alias("n_chars"), "text", changed.alias("changed"))
    both = F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("of")), F.struct(F.lit(True).alias("is_edited"), F.col("changed").alias("of")))
    keys = ["range", "place", "visitor", "doc_id", "n_chars", "edited_sha256"]
    rows = rows.withColumn("edited_sha256", F.sha2("changed", 256))
    prints = fingerprints(rows.select(*keys, F.inline(both)), [*keys, "is_edited"], "of")
    wide = prints.groupBy(*keys).agg(*(F.max(F.when(F.col("is_edited") == kind, F.col(f"print_{k}"))).alias(f"{name}_{k}") for kind, name in ((False, "print"), (True, "edited")) for k in (0, 1)))
    order = W.partitionBy("range").orderBy("place")
    ahead = wide.select("*", *(F.lead(f"print_{k}").over(order).alias(f"next_{k}") for k in (0, 1)))
    return ahead.where("NOT visitor").drop("range", "place", "visitor")


def fingerprint_report(docs: DataFrame, asked: Column, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The fingerprints and likenesses of every document; for those asked for, the number of fingerprints near by."""
    rows = cut(edited(docs, range_rows).withColumn("is_asked", F.coalesce(asked, F.lit(False))))
    found = within_radius(rows.where("is_asked"), rows)
    near = found.groupBy(F.col("query_0").alias("print_0"), F.col("query_1").alias("print_1")).agg(F.count("*").alias("n_near"))
    own, changed, ahead = ((F.col(f"{x}_0"), F.col(f"{x}_1")) for x in ("print", "edited", "next"))

    def shaped(part: DataFrame, n_near: Column) -> DataFrame:
        return part.select(
            "doc_id", "n_chars", "edited_sha256", shown(*own).alias("fingerprint"), shown(*changed).alias("edited_fingerprint"),
            likeness(own, changed).alias("near_edited"), likeness(own, ahead).alias("near_next"), n_near.alias("n_near"),
        )

    counted = rows.where("is_asked").join(near, ["print_0", "print_1"], "left")
    return shaped(counted, F.coalesce("n_near", F.lit(0).cast("long"))).unionAll(shaped(rows.where("NOT is_asked"), F.lit(None).cast("long")))

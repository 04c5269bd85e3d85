"""Patterns over the turns of a session, however many turns it has.

Turns are numbered first, within ranges of their own numbers and then over the ranges, so numbers may have gaps, repeat or
be missing. A session is cut into strides of places; a stride also gets the few turns before it, and the end of the text
before it, so a huge session is many small groups and no window spans it.

A payload that is cut over any number of turns shows where the last of its turns completes it. What one turn needs of
those before is the end of their joined text, ``LOOK_BACK`` characters of it. Ends compose: the end of two texts in a row
follows from the ends of both. So each stride folds its own, and takes the end of the stride before, which is whole since
every turn adds a space at least.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstone.operators.screen import apply_rules, topic_overlap, word_set
from wardstone.sources import rules as packs
from wardstone.sources.rules import Rule

#: Characters of the turns before that may belong to a payload, and places of a stride: at least as many.
LOOK_BACK, STRIDE = 400, 512
#: Turns over which blocked turns and risks are counted, blocked ones that make a probing session, and a sum of risks.
RECENT, PROBES, RISK = 5, 3, 2.0


#: The flags of ``turn_patterns``.
PATTERNS = ("blocked_retry", "trust_escalation", "topic_pivot", "payload_splitting", "probing", "risk_accumulation", "script_switch")


def numbered(turns: DataFrame, key: str, turn: str, *ties: str, stride: int = STRIDE) -> DataFrame:
    """Adds ``__session``, equal for turns of one session also where that is null, and ``__place``, from 0.

    Turns without a number come last; of equal numbers the order is that of ``ties``.
    """
    df = turns.withColumn("__session", F.struct(F.col(key).alias("s")))
    df = df.withColumn("__range", F.coalesce(F.floor(F.col(turn) / stride), F.lit(2**62)))
    counts = df.groupBy("__session", "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__session").orderBy("__range")) - F.col("__n")
    starts = counts.select("__session", "__range", before.alias("__start"))
    order = [F.col(turn).asc_nulls_last(), *(F.col(c).asc_nulls_last() for c in ties)]
    within = F.row_number().over(Window.partitionBy("__session", "__range").orderBy(*order)) - 1
    placed = df.withColumn("__within", within).join(starts, ["__session", "__range"])
    return placed.withColumn("__place", F.col("__start") + F.col("__within")).drop("__range", "__start", "__within")


def _ends(look_back: int):
    """Adds ``__before``: the end of the text of all turns before, for rows sorted by session and place."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = ""
        for batch in batches:
            out = []
            for first, given, text in zip(*(batch.column(c).to_pylist() for c in ("__first", "__given", "__text"))):
                end = (given or "") if first else end
                out.append(end)
                end = f"{end} {text}"[-look_back:]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, "__before"])

    return of


def _with_ends(df: DataFrame, stride: int, look_back: int) -> DataFrame:
    """Rows of strides (``__session``, ``__stride``, ``__place``, ``__text``) with ``__before``."""
    piece = F.struct("__place", F.right("__text", F.lit(look_back)).alias("t"))
    joined = F.aggregate(
        F.array_sort(F.collect_list(piece)), F.lit(""),
        lambda end, x: F.right(F.concat(end, F.lit(" "), x["t"]), F.lit(look_back)),
    )
    ends = df.groupBy("__session", (F.col("__stride") + 1).alias("__stride")).agg(joined.alias("__given"))  # a stride of rows each
    df = df.join(ends, ["__session", "__stride"], "left").withColumn("__first", F.col("__place") % stride == 0)
    lain = df.repartition("__session", "__stride").sortWithinPartitions("__session", "__stride", "__place")
    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in lain.schema)
    return lain.mapInArrow(_ends(look_back), f"{kinds}, __before string")


def turn_patterns(
    turns: DataFrame, key: str, turn: str, text: str, risk: str, blocked: str, together: int = 3, stride: int = STRIDE, rules: list[Rule] = packs.PROMPT,
    look_back: int = LOOK_BACK,
) -> DataFrame:
    """Patterns of each turn: key, turn, and a flag for each.

    blocked_retry: like the turn before it, which was blocked. trust_escalation: risk rose over ``together`` turns.
    topic_pivot: no word shared with the turn before. payload_splitting: a rule matches across this turn and those before
    it, and neither this turn nor those before it alone. probing: of the last ``RECENT`` turns ``PROBES`` or more were
    blocked. risk_accumulation: their risks come to ``RISK``, though none was blocked. script_switch: a turn without Latin
    letters after one that has them, or the reverse, both with letters.

    Rows with a null session are one session, turns without a number are its last; null texts are empty, null flags and
    risks are false and 0.
    """
    stride = max(stride, look_back)
    back = max(together, RECENT) - 1
    rows = turns.select(
        F.col(key).alias("__key"), F.col(turn).alias("__turn"), F.coalesce(text, F.lit("")).alias("__text"), F.coalesce(F.col(risk).cast("double"), F.lit(0.0)).alias("__risk"),
        F.coalesce(blocked, F.lit(False)).alias("__blocked"),
    )
    placed = numbered(rows, "__key", "__turn", "__text", "__risk", "__blocked", stride=stride)
    placed = placed.withColumn("__home", F.floor(F.col("__place") / stride))
    # The last turns of a stride also go to the next one, as context.
    later = F.floor((F.col("__place") + back) / stride)
    df = placed.withColumn("__stride", F.explode(F.array_distinct(F.array(F.col("__home"), later))))
    w = Window.partitionBy("__session", "__stride").orderBy("__place")
    recent = w.rowsBetween(1 - RECENT, 0)
    latin = F.when(F.col("__text").rlike("[A-Za-z]"), "latin").when(F.col("__text").rlike(r"\p{L}"), "other")
    df = df.withColumn("__words", word_set(F.col("__text"))).withColumn("__script", latin)
    df = df.withColumns({f"__p_{c}": F.lag(f"__{c}").over(w) for c in ("words", "blocked", "script")})
    df = df.withColumn("__risks", F.collect_list("__risk").over(w.rowsBetween(1 - together, 0)))
    df = df.withColumn("__n_blocked", F.sum(F.col("__blocked").cast("int")).over(recent)).withColumn("__sum", F.round(F.sum("__risk").over(recent), 6))
    df = df.where(F.col("__stride") == F.col("__home"))
    overlap = topic_overlap(F.col("__words"), F.col("__p_words"))
    rises = F.aggregate(
        "__risks", F.struct(F.lit(-1.0).alias("last"), F.lit(True).alias("up")),
        lambda a, x: F.struct(x.alias("last"), (a["up"] & (x > a["last"])).alias("up")), lambda a: a["up"],
    )
    seen = F.col("__p_words").isNotNull()
    flags = {
        "blocked_retry": F.coalesce(seen & F.col("__p_blocked") & (overlap >= 0.5), F.lit(False)),
        "trust_escalation": (F.size("__risks") == together) & rises,
        "topic_pivot": F.coalesce(seen & (F.size("__words") > 0) & (F.size("__p_words") > 0) & (overlap == 0), F.lit(False)),
        "probing": F.col("__n_blocked") >= PROBES,
        "risk_accumulation": (F.col("__n_blocked") == 0) & (F.col("__sum") >= RISK),
        "script_switch": F.coalesce(F.col("__script") != F.col("__p_script"), F.lit(False)),
    }
    df = _with_ends(df.select("__session", "__stride", "__place", "__turn", "__text", *(c.alias(n) for n, c in flags.items())), stride, look_back)
    across = F.when(F.col("__before") != "", F.concat("__before", F.lit(" "), F.left("__text", F.lit(look_back))))
    df = df.withColumn("__across", across)
    for column, found in (("__across", "__f1"), ("__before", "__f2"), ("__text", "__f3")):
        df = apply_rules(df, column, rules, found)
    ids = [F.transform(c, lambda f: f["policy_id"]) for c in ("__f1", "__f2", "__f3")]
    split = F.size(F.array_except(F.array_except(ids[0], ids[1]), ids[2])) > 0
    return df.select(F.col("__session.s").alias(key), F.col("__turn").alias(turn), *list(flags)[:3], split.alias("payload_splitting"), *list(flags)[3:])

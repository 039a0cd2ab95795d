"""Interval lookup: any number of questions, any number of bands, first match wins.

``score_bands`` compares an answer with the constants of three bands.  Here the bands are
data: rows ``(question, lo, hi, score, rank)``, both ends inclusive, overlapping as they
like; of the bands that hold an answer the one with the least rank counts.

1. Per question the ends cut the number line into elementary intervals; each is given to the
   first band that covers it.  A band is written as its canonical pieces, at most two aligned
   runs of 1, 2, 4, 8, ... intervals of each size, and an interval looks only at the aligned
   runs that it lies in: n bands cost about n log n rows, also where all overlap.  This turns
   overlapping bands into sorted, disjoint bounds.
2. The index is one row a question: the array of bounds and the array of scores.
3. An answer finds its interval by binary search over the bounds, as an expression (a fold
   of as many halvings as the longest array needs).  Answers meet the index by equality of
   the question only: there is no range join, and no answer is compared with all bands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casekit.operators.enrich import DEFAULT_BROADCAST_BYTES, probe_bytes


def interval_index(bands: DataFrame) -> DataFrame:
    """``(question, lo, hi, score, rank)`` to ``(question, bounds, scores)``.

    ``scores[k]`` holds from ``bounds[k]`` up to the next bound; NULL where no band is.  Bands
    with a NULL end, or whose ends are the wrong way round, hold nothing.  Bands of one
    question that share a rank: the smaller score counts.
    """
    b = bands.where("lo <= hi").select(
        "question", F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"),
        "score", "rank")
    ends = b.select("question", F.explode(F.array("lo", F.col("hi") + 1)).alias("bound")).distinct()
    place = Window.partitionBy("question").orderBy("bound")
    placed = ends.withColumn("at", F.row_number().over(place) - 1)
    levels = (placed.agg(F.max("at")).first()[0] or 0).bit_length()
    end = lambda bound, at: placed.select(
        "question", F.col("bound").alias(bound), F.col("at").alias(at))
    span = (b.join(end("lo", "i"), ["question", "lo"])
            .join(end("past", "j").withColumn("hi", F.col("past") - 1), ["question", "hi"]))
    pieces = span.select("question", "rank", "score", F.explode(_pieces("i", "j", levels)).alias("p"))
    best = pieces.groupBy("question", F.col("p.level").alias("level"), F.col("p.run").alias("run")).agg(
        F.min(F.struct("rank", "score")).alias("f"))
    runs = placed.select("question", "bound", F.posexplode(F.array(*[
        F.shiftright("at", k) for k in range(levels + 1)])).alias("level", "run"))
    first = (runs.join(best, ["question", "level", "run"], "left")
             .groupBy("question", "bound").agg(F.min("f").alias("f")))
    listed = F.sort_array(F.collect_list(F.struct("bound", F.col("f.score").alias("score"))))
    return first.groupBy("question").agg(listed.alias("steps")).select(
        "question", F.col("steps.bound").alias("bounds"), F.col("steps.score").alias("scores"))


def _pieces(i: str, j: str, levels: int) -> Column:
    """The canonical pieces ``(level, run)`` of the intervals ``i`` up to but without ``j``:
    run ``r`` of level ``k`` is the intervals from ``r << k`` up to ``(r + 1) << k``."""
    out = []
    for k in range(levels + 1):
        left = F.shiftright(F.col(i) + ((1 << k) - 1), k)         # first aligned run inside
        right = F.shiftright(F.col(j), k)                         # past the last one
        for run, odd in ((left, left), (right - 1, right)):
            out.append(F.when((left < right) & (odd % 2 == 1), F.struct(
                F.lit(k).alias("level"), run.alias("run"))))
    return F.filter(F.array(*out), lambda p: p.isNotNull())


def search(bounds: Column, answer: Column, steps: int) -> Column:
    """How many of the sorted bounds are not above ``answer``: binary search in ``steps``
    halvings (enough for arrays of fewer than ``2 ** steps`` entries)."""
    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))

    def halve(state: Column, _: Column) -> Column:
        lo, hi = state["lo"], state["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        up = (lo < hi) & (F.get(bounds, mid) <= answer)
        return F.struct(F.when(up, mid + 1).otherwise(lo).alias("lo"),
                        F.when((lo < hi) & ~up, mid).otherwise(hi).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)["lo"]


def score_answers(answers: DataFrame, bands: DataFrame, question: str = "question",
                  answer: str = "answer", out: str = "score",
                  max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``answers`` (one row an answer) with the score of the band that holds it; NULL in none,
    for a NULL answer and for a question without bands.

    The index is broadcast if it is small (measured).  Else its join shuffles by question;
    then AQE splits the questions that hold a large share of the answers.
    """
    index = interval_index(bands).select(F.col("question").alias("__q"), F.col("bounds").alias("__b"),
                                         F.col("scores").alias("__s"))
    small = probe_bytes([(index, max_broadcast_bytes)])[0]
    longest = index.agg(F.max(F.size("__b"))).first()[0] or 0
    joined = answers.join(F.broadcast(index) if small else index,
                          F.col(question) == F.col("__q"), "left")
    at = search(F.col("__b"), F.col(answer), max(1, longest.bit_length()))
    return joined.withColumn(out, F.get("__s", at - 1)).drop("__q", "__b", "__s")

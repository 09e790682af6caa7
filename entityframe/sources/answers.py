"""Landed API answers: what each holds, whether together they cover the entity, and its records.

An answer has ``entities``, ``startPosition``, ``maxResults`` and ``totalCount``. It
is parsed once, into a variant; the checks, the schema and the records are all read from that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityframe.functions.numbering import Cuts, column, literal_array, whole_div
from entityframe.options import PAGE_SIZE
from entityframe.sources.landing import stage

REPORTED = 20  # problems named in an error


class AnswerError(ValueError):
    """Landed answers are faulty or do not cover their entity."""


def parse_answers(lines: DataFrame, text: str = "value") -> DataFrame:
    """One row per answer: where it starts, how many records it holds, what it says, what is wrong.

    ``problem`` is null for an answer of records, and for one that gives only a
    count or says that it has none. A missing start is 1. ``total_count`` stays null where
    it is not stated.
    """
    answer = F.col("_answer")

    def stated(name: str) -> Column:
        return F.try_variant_get(answer, f"$.{name}", "bigint")

    entities = F.try_variant_get(answer, "$.entities", "array<variant>")
    anything = F.try_variant_get(answer, "$.entities", "variant")
    given = anything.isNotNull() & ~F.coalesce(F.is_variant_null(anything), F.lit(False))
    fault = F.coalesce(*(F.try_variant_get(answer, f"$.{n}", "variant") for n in ("fault", "Fault")))
    problem = (
        F.when(answer.isNull(), "not JSON")
        .when(fault.isNotNull(), F.concat(F.lit("fault: "), F.to_json(fault)))
        .when(given & entities.isNull(), "entities is not an array")
        .when(~given & stated("totalCount").isNull() & ~stated("maxResults").eqNullSafe(F.lit(0)), "no entities")
        .when(stated("startPosition") < 1, "starts before 1")
    )
    return lines.select(F.try_parse_json(column(text)).alias("_answer")).select(
        F.coalesce(stated("startPosition"), F.lit(1).cast("bigint")).alias("start"),
        F.when(problem.isNull(), F.coalesce(F.size(entities), F.lit(0))).otherwise(0).cast("bigint").alias("n"),
        stated("totalCount").alias("total_count"),
        problem.alias("problem"),
        F.when(problem.isNull(), entities).alias("entities"),
    )


def stated_envelope(answers: DataFrame) -> DataFrame:
    """What the answers say together; an entity of unknown total is a single record, one of 0 has none."""
    return answers.agg(
        F.lit(1).cast("bigint").alias("start_position"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("max_results"),
        F.coalesce(F.max("total_count"), F.lit(1).cast("bigint")).alias("total_count"),
    )


def _furthest_before(rows: DataFrame, cuts: Cuts, end: str, into: str) -> DataFrame:
    """The largest ``end`` of all rows that start earlier, in start order; 1 before the first.

    Rows lie in buckets of the start. Inside a bucket a window carries the largest end along; what
    earlier buckets reach is one number each, a constant of the plan.
    """
    reached = {r["bucket"]: r["far"] for r in rows.groupBy("bucket").agg(F.max(end).alias("far")).collect()}
    carried, far = [], 1
    for bucket in range(len(cuts.points) + 1):
        carried.append(str(far))
        far = max(far, reached.get(bucket) or 1)
    earlier = Window.partitionBy("bucket").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    start_of_bucket = F.get(literal_array(carried, T.LongType()), F.col("bucket"))
    return rows.withColumn(into, F.greatest(start_of_bucket, F.max(end).over(earlier)))


def sweep(answers: DataFrame, buckets: int | None = None) -> DataFrame:
    """Answers as intervals ``[start, end)`` in order, one row per start, with what lies before each.

    ``end`` and ``second`` are the furthest and next furthest end of the answers that begin at ``start``,
    ``before`` is the furthest end of all that begin earlier, and ``twice`` how far earlier answers
    cover positions more than once. Answers of one start are put together before anything is
    sorted, so one that was landed a million times is one row.
    """
    ends = (F.col("start") + F.col("n")).alias("end")
    by_end = answers.where("n > 0").groupBy("start", ends).agg(F.count(F.lit(1)).alias("same"))
    far = F.row_number().over(Window.partitionBy("start").orderBy(F.desc("end")))
    first, other = F.col("far") == 1, F.col("far") == 2
    by_start = (
        by_end.withColumn("far", far)
        .where("far <= 2")
        .groupBy("start")
        .agg(
            F.max("end").alias("end"),
            F.max(F.when(first & (F.col("same") > 1), F.col("end"))).alias("shared"),
            F.max(F.when(other, F.col("end"))).alias("other"),
        )
    )
    second = F.coalesce("shared", "other", "start").alias("second")
    rows = stage(by_start.select("start", "end", second), "intervals")
    cuts = Cuts(rows, [], ["start"], buckets)
    swept = _furthest_before(rows.withColumn("bucket", cuts.bucket()), cuts, "end", "before")
    overlap = F.greatest("second", F.least("end", "before"))
    swept = stage(swept.withColumn("again", F.when(overlap > F.col("start"), overlap)), "swept")
    return _furthest_before(swept, cuts, "again", "twice").drop("bucket")


def coverage(answers: DataFrame, buckets: int | None = None) -> DataFrame:
    """``kind, first, last, records``: every stretch of positions that is not answered exactly once.

    ``gap`` lies before the last answered position, ``overlap`` was answered more than once,
    ``short`` lies between the last answered position and the largest stated total, and ``beyond`` is answered
    past that total. Stretches of one kind never overlap. An entity answered whole has no rows.
    """
    swept = stage(sweep(answers, buckets), "coverage")
    start, before = F.col("start"), F.col("before")
    fresh = F.greatest("start", "twice")
    stretches = swept.select(
        F.explode(
            F.array(
                F.struct(F.lit("gap").alias("kind"), before.alias("first"), (start - 1).alias("last")),
                F.struct(F.lit("overlap").alias("kind"), fresh.alias("first"), (F.col("again") - 1).alias("last")),
            )
        ).alias("s")
    ).select("s.*")
    nothing = F.lit(None).cast("bigint")
    ends = answers.select("total_count", nothing.alias("end")).unionByName(
        swept.select(nothing.alias("total_count"), "end")
    )
    total, reached = F.col("total"), F.col("reached")
    edges = ends.agg(
        F.max("total_count").alias("total"), F.coalesce(F.max("end") - 1, F.lit(0)).alias("reached")
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("short").alias("kind"), (reached + 1).alias("first"), total.alias("last")),
                F.struct(F.lit("beyond").alias("kind"), (total + 1).alias("first"), reached.alias("last")),
            )
        )
    )
    found = stretches.unionByName(edges).where(F.col("first") <= F.col("last"))
    return found.withColumn("records", F.col("last") - F.col("first") + 1)


def faults(answers: DataFrame) -> DataFrame:
    """``problem, answers``: what is wrong with answers that could not be read, and how many say so."""
    return answers.where("problem is not null").groupBy("problem").agg(F.count(F.lit(1)).alias("answers"))


def check_answers(answers: DataFrame, repeats: bool = False) -> None:
    """Fails on faulty answers, gaps, a total not reached or passed and, unless ``repeats``, on overlaps."""
    wrong = [f"{r['answers']} x {r['problem'][:200]}" for r in faults(answers).limit(REPORTED).collect()]
    found = coverage(answers)
    if repeats:
        found = found.where("kind <> 'overlap'")
    wrong += [
        f"{r['kind']} at positions {r['first']} to {r['last']}"
        for r in found.orderBy("first", "kind").limit(REPORTED).collect()
    ]
    if wrong:
        raise AnswerError("landed answers do not give the entity once: " + "; ".join(wrong))


def answer_records(answers: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """``value`` (a variant), ``page_no`` and ``pos_in_page`` of every record, repeats included."""
    rows = answers.select("start", F.posexplode("entities").alias("_i", "value"))
    before = F.col("start") + F.col("_i") - 1
    return rows.select(
        "value",
        whole_div(before, page_size).alias("page_no"),
        F.pmod(before, F.lit(page_size)).cast("bigint").alias("pos_in_page"),
    )


def without_repeats(answers: DataFrame) -> DataFrame:
    """Answers cut so that each position is in one of them: the one that begins first has it.

    Of answers that begin together the longest counts, of equally long ones that with the
    smallest hash, and of equal ones either. Only starts are joined; the records
    of an answer that adds nothing are not unfolded.
    """
    keyed = answers.where("n > 0").withColumn("_key", F.xxhash64(F.to_json("entities")))
    keyed = keyed.dropDuplicates(["start", "n", "_key"])
    best = F.min(F.struct((-F.col("n")).alias("less"), "_key")).alias("_best")
    chosen = keyed.groupBy("start").agg(best).select(
        F.col("start").alias("_start"), (-F.col("_best.less")).alias("_n"), F.col("_best._key").alias("_best_key")
    )
    same = (F.col("start") == F.col("_start")) & (F.col("n") == F.col("_n")) & (F.col("_key") == F.col("_best_key"))
    once = keyed.join(chosen, same, "left_semi")
    before = sweep(answers).select(F.col("start").alias("_start"), "before")
    cut = F.greatest(F.col("before") - F.col("start"), F.lit(0)).cast("int")
    placed = once.join(before, F.col("start") == F.col("_start")).withColumn("_cut", cut)
    kept = F.slice("entities", F.col("_cut") + 1, F.greatest(F.size("entities") - F.col("_cut"), F.lit(0)))
    return placed.where(F.col("_cut") < F.col("n")).select(
        (F.col("start") + F.col("_cut")).alias("start"),
        (F.col("n") - F.col("_cut")).alias("n"),
        "total_count",
        "problem",
        kept.alias("entities"),
    )

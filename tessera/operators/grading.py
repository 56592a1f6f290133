"""Grading of outputs by rules over their text, with manual verdicts bound to what they were given for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Word ends by ASCII letters only, spelled out because engines differ in what their boundary takes for a letter (noñ).
NEGATION = r"(?i)(?<![A-Za-z0-9_])(no|not|never|without|must not|cannot|prohibited|forbidden)(?![A-Za-z0-9_])|않|금지|없"


def banned_hits(text: Column, phrase: str, around: int = 60) -> Column:
    """Contexts in which a phrase stands without a negation within so many characters."""
    literal = "".join("\\" + c if not c.isalnum() and not c.isspace() else c for c in phrase)
    contexts = F.regexp_extract_all(text, F.lit(f"(?is).{{0,{around}}}{literal}.{{0,{around}}}"), F.lit(0))
    return F.filter(contexts, lambda c: ~F.rlike(c, F.lit(NEGATION)))


def grade(outputs: DataFrame, rules: Sequence[tuple[str, str, bool]], manual: DataFrame | None = None) -> DataFrame:
    """output_id, assertion, passed: rules are (assertion, pattern, whether it must match); a manual verdict counts for
    assertions without a rule and only while the output's digest is the one it was given for; else it is pending (null)."""
    digest = outputs.withColumn("digest", F.sha2("content", 256))
    verdict = F.array(*[F.struct(F.lit(a).alias("assertion"), (F.rlike(F.col("content"), F.lit(p)) == F.lit(must)).alias("passed")) for a, p, must in rules])
    machine = digest.select("output_id", "digest", F.explode(verdict).alias("v")).select("output_id", "digest", "v.assertion", "v.passed")
    if manual is None:
        return machine.drop("digest")
    by_hand = manual.join(digest.select("output_id", F.col("digest").alias("now")), "output_id").select("output_id", "assertion", F.when(F.col("now") == F.col("digest"), F.col("passed")).alias("by_hand"))
    both = machine.drop("digest").join(by_hand, ["output_id", "assertion"], "full_outer")
    return both.select("output_id", "assertion", F.coalesce("passed", "by_hand").alias("passed"))


def pass_rate(graded: DataFrame) -> DataFrame:
    good, bad = F.count_if(F.col("passed")), F.count_if(~F.col("passed"))
    return graded.agg(good.alias("passed"), bad.alias("failed"), F.count_if(F.col("passed").isNull()).alias("pending"), F.round(good / F.nullif(good + bad, F.lit(0)), 4).alias("rate"))


def set_difference(found: DataFrame, declared: DataFrame, key: str) -> DataFrame:
    """Keys declared but not found and the other way round, for pins, citations and knobs."""
    a, b = found.select(key).distinct(), declared.select(key).distinct()
    return b.join(a, key, "left_anti").withColumn("problem", F.lit("missing")).unionAll(a.join(b, key, "left_anti").withColumn("problem", F.lit("extra")))

"""Quality rules: a table of thresholds compiled into one projection.

Every measure and every verdict is a built-in expression over the text column, so a
scan, one projection and a writer are the whole job: no shuffle, no Python.

Null text counts as empty text; an empty text fails the base rules. Rows are judged one
by one, so repeated rows get equal verdicts, and ids are not looked at. All other
columns pass through; a column of the same name as a measure is replaced."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odotrack.llm.common import GAP, free_name, let, or_empty, words

#: Frequent function words of English, French, German and Spanish (fixed values).
STOP_WORDS = (
    "the of and to in a is that for it as was with on by be at this are from "
    "le la les de des un une et est en que qui dans pour par sur au il "
    "der die das und zu den von mit sich auf ein eine ist im nicht es dem "
    "el los las del y se un una por con para su al lo"
).split()
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``low <= 1000 * count / total <= high``; a zero total passes."""

    name: str
    count: str
    total: str
    low: int | None = None
    high: int | None = None


#: Shares in thousandths, so that verdicts are exact integer comparisons.
RULES: tuple[Rule, ...] = (
    Rule("word_length", "word_chars", "n_words", low=2_000, high=14_000),
    Rule("symbols", "n_symbols", "n_words", high=100),
    Rule("stop_words", "n_stop_words", "n_words", low=10),
    Rule("dup_lines", "n_dup_lines", "n_lines", high=500),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=500),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _repeated(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Windows are sorted with their positions, equal neighbours keep theirs, and each
    kept position covers what the one before has not."""

    def covered(windows: Column) -> Column:
        def spots(ordered: Column) -> Column:
            same = F.filter(
                ordered,
                lambda x, i: F.coalesce(x["k"] == F.get(ordered, i - 1)["k"], F.lit(False))
                | F.coalesce(x["k"] == F.get(ordered, i + 1)["k"], F.lit(False)),
            )
            return F.aggregate(
                F.sort_array(F.transform(same, lambda x: x["p"])),
                F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                lambda acc, p: F.struct(
                    (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")
                ),
                lambda acc: acc["n"],
            )

        placed = F.transform(windows, lambda k, i: F.struct(k.alias("k"), i.alias("p")))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            let(F.sort_array(placed), spots)
        )

    starts = F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0)))
    return let(
        F.transform(starts, lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2))), covered
    )


def measures(text: Column) -> Column:
    """All counts of one text, as a struct of longs."""
    text = or_empty(text)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def counted(w: Column) -> Column:
        return let(
            lines,
            lambda full: F.struct(
                *(
                    value.cast("long").alias(name)
                    for name, value in {
                        "n_words": F.size(w),
                        "word_chars": F.length(F.regexp_replace(text, GAP, "")),
                        "n_symbols": F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")),
                        "n_dup_lines": F.size(full) - F.size(F.array_distinct(full)),
                        "n_repeat_words": _repeated(w),
                        "n_lines": F.size(full),
                        "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))),
                        "n_ellipsis_lines": F.size(
                            F.filter(full, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))
                        ),
                    }.items()
                )
            ),
        )

    return let(words(text), counted)


def _failed(m: Column, rule: Rule) -> Column:
    share, total = m[rule.count] * 1000, m[rule.total]
    bad = F.lit(False)
    if rule.low is not None:
        bad = bad | (share < total * rule.low)
    if rule.high is not None:
        bad = bad | (share > total * rule.high)
    return bad


def _verdict(text: Column, rules: Sequence[Rule]) -> Column:
    """struct(m, base_failed, failed_rules, kept) of one text."""

    def judged(m: Column) -> Column:
        base = (m["n_words"] < MIN_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT)
        failed = F.array_compact(F.array(*(F.when(_failed(m, r), F.lit(r.name)) for r in rules)))
        return let(
            failed,
            lambda names: F.struct(
                m.alias("m"),
                base.alias("base_failed"),
                names.alias("failed_rules"),
                (~base & (F.size(names) == 0)).alias("kept"),
            ),
        )

    return let(measures(text), judged)


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``failed_rules`` (names) and ``kept``."""
    # The struct is computed once: extracting its fields does not inline it.
    own = free_name(docs, "__verdict")
    judged = docs.withColumn(own, _verdict(F.col(text), rules))
    names = [f.name for f in judged.schema[own].dataType["m"].dataType]
    return judged.withColumns(
        {n: F.col(f"{own}.m.{n}") for n in names}
        | {n: F.col(f"{own}.{n}") for n in ("base_failed", "failed_rules", "kept")}
    ).drop(own)


def keep_by_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """``docs`` without those that a rule rejects; columns as they are."""
    return docs.filter(_verdict(F.col(text), rules)["kept"])

"""Quality rules: a threshold table compiled into one Spark projection of built-in functions.

``METRICS`` names each count once; ``RULES`` bounds ratios of them.  The verdict
and the names of the broken rules are expressions over the same row, so there is
no shuffle, no user function, and the text is read once.

Defined results: a null text has no words (all counts 0, base rule failed); an
empty text likewise; texts of any length are counted whole; repeated rows are
judged one by one; an empty table gives no rows; other columns pass through
unless they bear a metric's name, in which case the metric replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import let

#: Frequent short words of the four languages.
STOP_WORDS = (
    "the of and to in a is that it for was on are as with be by this at or from an not have but"
    " der die das und ist von den mit zu für ein eine auf nicht im dem sich des als auch"
    " le la les de des et un une est que en dans pour qui sur au pas par il du avec ce"
    " el los las y del una no con por se su al lo como más para es"
).split()

WORD_GAP = "[\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Rule:
    """A document breaks the rule if ``numerator`` is under ``least`` x ``denominator`` or over ``most`` x it."""

    name: str
    numerator: str
    denominator: str
    least: float | None = None
    most: float | None = None


#: Texts of fewer words than BASE_WORDS fail the base rule, as do those mostly made of repeated three-word runs.
BASE_WORDS, REPEATED_PERCENT = 50, 50

RULES = (
    Rule("word_length", "word_chars", "n_words", least=2.0, most=12.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("stop_words", "n_stop_words", "n_words", least=0.02),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.6),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=0.3),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=0.9),
)


def repeated_words(words: Column) -> Column:
    """Words that lie in a run of three words found twice or more in ``words``.

    Runs are hashed to 64 bits; sorting (hash, place) packed into one long
    brings equal runs together, and the places are then swept once.  Of a hash
    40 bits are sorted by (32 from 16 million words on), so that different runs
    that agree in those, one pair in 10^12, could stand between equal ones and hide them.
    """
    n = F.size(words) - 2
    runs = F.when(
        n > 1,
        F.transform(
            F.arrays_zip(F.slice(words, 1, n).alias("a"), F.slice(words, 2, n).alias("b"), F.slice(words, 3, n).alias("c")),
            lambda x: F.xxhash64(x["a"], x["b"], x["c"]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        low = F.when(F.size(h) < 1 << 24, F.lit((1 << 24) - 1)).otherwise(F.lit((1 << 32) - 1)).cast("bigint")
        return let(low, lambda m: let(F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(m)).bitwiseOR(i.cast("bigint")))), lambda s: sweep(h, m, s)))

    def sweep(h: Column, m: Column, s: Column) -> Column:
        def run_at(i: Column) -> Column:
            return F.get(h, F.get(s, i).bitwiseAND(m).cast("int"))

        twice = F.filter(s, lambda x, i: F.coalesce(run_at(i) == run_at(i - 1), F.lit(False)) | F.coalesce(run_at(i) == run_at(i + 1), F.lit(False)))
        places = F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(m)))
        return let(places, lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(3).cast("bigint"), x - F.coalesce(F.get(p, i - 1), x - 3))), F.lit(0).cast("bigint"), lambda a, x: a + x))

    return let(runs, covered)


def metrics(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """Every count, as long, from the text, its words and its lines that have a word."""
    bare = F.regexp_replace(text, WORD_GAP, "")
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(bare),
        "n_symbols": F.length(text) - F.length(F.translate(text, "#*$%&|<>", "")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated_words(words),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(F.rtrim(w, F.lit(".,;:"))).isin(STOP_WORDS))),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: x.rlike("(?:\\.\\.\\.|…)\\s*$"))),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike("^\\s*[-*•●]\\s"))),
    }
    return {k: c.cast("bigint") for k, c in counts.items()}


def judge(rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """(base_failed, names of broken rules) over the metric columns."""
    base = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    broken = []
    for r in rules:
        top, under = F.col(r.numerator), F.col(r.denominator)
        out = F.lit(False)
        if r.least is not None:
            out = out | (top < r.least * under)
        if r.most is not None:
            out = out | (top > r.most * under)
        broken.append(F.when(out, F.lit(r.name)))
    return base, F.array_compact(F.array(*broken))


def score_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with the counts of ``metrics``, ``base_failed``, ``broken_rules`` and ``kept``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    names = list(metrics(F.lit(""), F.array(F.lit("")), F.array(F.lit(""))))
    rest = [c for c in docs.columns if c.lower() not in {*names, "base_failed", "broken_rules", "kept"}]
    words = F.filter(F.split(whole, WORD_GAP), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    counted = let(
        F.struct(whole.alias("t"), words.alias("w"), lines.alias("l")),
        lambda x: F.struct(*(c.alias(k) for k, c in metrics(x["t"], x["w"], x["l"]).items())),
    )
    base, broken = judge(rules)
    # a generated row, so that no later filter or projection computes the counts again
    out = docs.select(F.struct(*rest).alias("row"), F.explode(F.array(counted)).alias("counts")).select("row.*", "counts.*")
    return out.select("*", base.alias("base_failed"), broken.alias("broken_rules")).withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    return score_quality(docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text")), rules, "_text").where("kept").select("_row.*")

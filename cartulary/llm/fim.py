"""Fill-in-the-middle examples from built-in functions alone: a unit array, hashed cuts, slices put together, sentinels parsed back.

A text is the array of its units (``UNIT``: a run of ASCII letters, or one other
code point), so a cut never splits a word.  Four 32-bit numbers of the SHA-256 of
seed and id place two cuts and choose the form: ``psm`` (prefix, suffix, middle),
``spm`` (suffix, prefix, middle) or ``plain``.  The same id gives the same example in any run.

A text that holds a sentinel stays plain.  In the others every sentinel of the
output is the operator's own: one starts with ``<`` and has no other, so none can
begin in a piece and end in the sentinel after it.  Splitting at the sentinels
gives the pieces back, and ``restore`` rebuilds the text from output and form alone.

Defined results: a null text is empty; an empty text is plain with no units; texts
of any length are cut whole; repeated rows give equal examples; a null id is hashed
as an empty one; an empty table gives no rows; other columns pass through unless
they bear a result's name, in which case the result replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import let

UNIT = "([A-Za-z]+|[^A-Za-z])"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINEL = "<[PSM]>"

RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")


@dataclass(frozen=True)
class Rates:
    """Percent of the texts that are rearranged, and of those the percent in the form spm."""

    rearranged: int = 90
    spm: int = 20


def numbers(id_column: Column, seed: int) -> Column:
    """Four unsigned 32-bit numbers, as longs, of the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))).cast("binary"), 256)
    return let(digest, lambda d: F.array(*(F.conv(F.substring(d, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4))))


def arrange(text: Column, h: Column, rates: Rates) -> Column:
    """struct<n, form, prefix_chars, middle_chars, output> of a text that isn't null, from its numbers."""

    def formed(u: Column) -> Column:
        n = F.size(u["units"])
        plain = (n == 0) | text.rlike(SENTINEL) | (u["h"][2] % 100 >= rates.rearranged)
        form = F.when(plain, "plain").when(u["h"][3] % 100 < rates.spm, "spm").otherwise("psm")
        cut = lambda k: (u["h"][k] % (n + 1)).cast("int")
        return let(F.struct(n.cast("bigint").alias("n"), form.alias("form"), F.least(cut(0), cut(1)).alias("a"), F.greatest(cut(0), cut(1)).alias("b"), u["units"].alias("units")), pieces)

    def pieces(c: Column) -> Column:
        run = lambda start, length: F.array_join(F.slice(c["units"], start + 1, length), "")
        told = F.struct(run(F.lit(0), c["a"]).alias("p"), run(c["a"], c["b"] - c["a"]).alias("m"), run(c["b"], F.size(c["units"]) - c["b"]).alias("s"))
        none = F.lit(None).cast("bigint")
        whole = F.struct(c["n"].alias("n"), c["form"].alias("form"), none.alias("prefix_chars"), none.alias("middle_chars"), text.alias("output"))
        return F.when(c["form"] == "plain", whole).otherwise(let(told, lambda x: joined(c, x)))

    def joined(c: Column, x: Column) -> Column:
        psm = F.concat(F.lit(PREFIX), x["p"], F.lit(SUFFIX), x["s"], F.lit(MIDDLE), x["m"])
        spm = F.concat(F.lit(SUFFIX), x["s"], F.lit(PREFIX), x["p"], F.lit(MIDDLE), x["m"])
        chars = lambda k: F.length(x[k]).cast("bigint")
        return F.struct(c["n"].alias("n"), c["form"].alias("form"), chars("p").alias("prefix_chars"), chars("m").alias("middle_chars"), F.when(c["form"] == "psm", psm).otherwise(spm).alias("output"))

    return let(F.struct(F.regexp_extract_all(text, F.lit(UNIT), F.lit(1)).alias("units"), h.alias("h")), formed)


def restore(output: Column, form: Column) -> Column:
    """The text again: the pieces between the sentinels in their first order; the output itself where the form is plain."""

    def back(p: Column) -> Column:
        return F.when(form == "psm", F.concat(p[1], p[3], p[2])).otherwise(F.concat(p[2], p[3], p[1]))

    return F.when(form == "plain", output).otherwise(let(F.split(output, SENTINEL, -1), back))


def fill_in_middle(docs: DataFrame, id_column: str = "doc_id", text: str = "text", seed: int = 1, rates: Rates = Rates()) -> DataFrame:
    """``docs`` with n (units), form, prefix_chars, middle_chars (null where plain) and output."""
    rest = [c for c in docs.columns if c.lower() not in RESULTS]
    made = arrange(F.coalesce(F.col(text), F.lit("")), numbers(F.col(id_column), seed), rates)
    # a generated row, so that no later filter or projection makes the example again
    out = docs.select(F.struct(*rest).alias("row"), F.explode(F.array(made)).alias("example"))
    return out.select("row.*", "example.*")


def digest(examples: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Each example's counts, and the SHA-256 of its output and of the text that is read back from it."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    back = restore(F.col("output"), F.col("form"))
    return examples.select(id_column, "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(back).alias("restored_sha256"))

"""Line dedup by content-defined chunks of lines.

A chunk is a run of lines between two boundaries.  From each line onwards the
first boundary, and from each line backwards the first one before, is where the
lines in between hold ``LEAST_LINES`` lines and ``LEAST_WORDS`` words and the rolling
hash over their line hashes is a multiple of ``EVERY``, or where they reach
``MOST_WORDS`` words.  So a chunk depends on nothing but its own lines: whatever
stands around a passage of ``MOST_WORDS`` words in whole lines, in both places the
chunks inside it are the same.  A chunk that occurs again anywhere in the corpus
is removed but for its first occurrence (smallest id, text hash, place): each
line of the others goes, if its bytes equal those of the first one's line.  Such
a line's like stands earlier and either stays or goes for a still earlier one,
so every removed line stays once.  Paragraphs are often one long line; a line of
``MOST_WORDS`` words is a chunk by itself, and what goes for such one-line chunks
alone is reported apart (``n_single``).  Lines without words belong to the line
before them.

One scan gives chunk keys (128-bit rolling hashes); first occurrences come from
a partial aggregation.  The lines to compare, not chunks or texts, are then
fetched from the documents that hold first occurrences, joined to the lines
that may go, and compared.  Documents without either pass through unshuffled.  No
filter or size decides what is removed.

Defined results: a null text stays null and an empty one empty; documents
without an id come after all others; different texts under one id are different
documents, rows that repeat id and text are one and are treated alike; a
document that loses all its words is ``emptied``; a text without a repeated chunk
is unchanged to the byte; texts of any length are whole; an empty table gives
no rows; other columns, whatever their names, pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from cartulary.llm.common import discard, fresh, keyed, lookup_join, materialise, split_by_keys, tidy
from cartulary.llm.wordhash import spans

EVERY, LEAST_LINES, LEAST_WORDS, MOST_WORDS = 3, 2, 20, 40

MASK = (1 << 128) - 1
#: An odd multiplier of the rolling hash.
ROLL = 0x9E3779B97F4A7C15F39CC0605CEDC835
#: Space, tab, line feed, vertical tab, form feed, carriage return: what is no word.
BLANK = " \t\n\x0b\x0c\r"
HAS_WORD = r"[^\x20\x09-\x0D]"

REPORT = StructType([StructField("n_lines", LongType()), StructField("n_removed", LongType()), StructField("n_single", LongType()), StructField("emptied", BooleanType())])


def chunk_lines(lines: list[bytes]) -> dict[tuple[int, int], int]:
    """(first, last) to key of the chunks of lines that have words each."""
    words = [len(x.split()) for x in lines]
    hashes = [xxhash.xxh3_128_intdigest(x) for x in lines]
    out: dict[tuple[int, int], int] = {}
    for i in range(len(lines)):
        total, rolled = 0, 0
        for j in range(i, len(lines)):
            total += words[j]
            rolled = (rolled * ROLL + hashes[j]) & MASK
            if total >= MOST_WORDS or (total >= LEAST_WORDS and j - i + 1 >= LEAST_LINES and (rolled >> 40) % EVERY == 0):
                out[i, j] = rolled
                break
        total, rolled, power = 0, 0, 1
        for j in range(i, -1, -1):
            total += words[j]
            rolled = (rolled + hashes[j] * power) & MASK
            power = power * ROLL & MASK
            if total >= MOST_WORDS or (total >= LEAST_WORDS and i - j + 1 >= LEAST_LINES and (rolled >> 40) % EVERY == 0):
                out[j, i] = rolled
                break
    return out


def chunk_keys(docs: DataFrame) -> DataFrame:
    """d, h, first, last (numbers of lines with words), key of every chunk of ``docs(d, h, text)``."""
    kinds = {"d": pa.int64(), "h": pa.int64(), "first": pa.int32(), "last": pa.int32(), "key": pa.binary()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, h, column = batch.columns
            for a, z in spans(column):
                out: list[list] = [[] for _ in kinds]
                for one, two, text in zip(d[a:z].to_pylist(), h[a:z].to_pylist(), column[a:z].to_pylist(), strict=True):
                    found = chunk_lines([x for x in text.encode("utf-8", "surrogatepass").split(b"\n") if x.strip()])
                    out[0] += [one] * len(found)
                    out[1] += [two] * len(found)
                    out[2] += [i for i, _ in found]
                    out[3] += [j for _, j in found]
                    out[4] += [k.to_bytes(16, "big") for k in found.values()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds.values(), strict=True)], names=list(kinds))

    return docs.select("d", "h", "text").mapInArrow(tidy(scan), "d bigint, h bigint, first int, last int, key binary")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(HAS_WORD))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """d, h, u, single, k: the lines of ``docs(d, h, text)``, counting those with words, that are in later occurrences, and the place (d, h, u) of the first one's line."""
    chunks = materialise(chunk_keys(docs), "chunks")
    at = F.struct("d", "h", "first")
    keys = chunks.groupBy("key").agg(F.count("*").alias("n"), F.min(at).alias("keeper"), F.max(at).alias("latest")).where("keeper < latest").drop("latest")
    keys = materialise(keys, "repeated-chunks")
    later = lookup_join(chunks, keys, "key", "n", chunks.count(), "inner").where(at != F.col("keeper"))
    each = later.select("d", "h", "keeper", F.col("first").alias("f"), (F.col("first") == F.col("last")).alias("single"), F.explode(F.sequence("first", "last")).alias("u"))
    first = F.struct(F.col("keeper.d").alias("d"), F.col("keeper.h").alias("h"), (F.col("keeper.first") + F.col("u") - F.col("f")).alias("u"))
    lines = materialise(each.groupBy("d", "h", "u").agg(F.min(first).alias("k"), F.bool_and("single").alias("single")), "repeated-lines")
    discard(chunks, keys)
    return lines


def with_first_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """d, h, cuts array<struct<u, single, line>>: ``lines`` by document, with the bytes of the first occurrence's line."""
    wanted = lines.groupBy("k").agg(F.count("*").alias("n"))
    holders, _ = split_by_keys(docs, lines.select("k.d", "k.h"), ["d", "h"])
    known = holders.select("d", "h", F.posexplode(lines_with_words(F.col("text"))).alias("u", "line")).select(F.struct("d", "h", "u").alias("k"), "line")
    first_lines = materialise(known.join(wanted, "k").groupBy("k").agg(F.first("line").alias("line"), F.first("n").alias("n")), "first-lines")
    joined = lookup_join(lines, first_lines, "k", "n", lines.count(), "inner")
    return joined.groupBy("d", "h").agg(F.collect_list(F.struct("u", "single", "line")).alias("cuts"))


@F.arrow_udf(StructType([StructField("text", StringType()), StructField("report", REPORT)]))
def without_lines(texts: pa.Array, cuts: pa.Array) -> pa.Array:
    """The texts less the lines of ``cuts`` that have the same bytes, with the blank lines after each."""
    kept, reports = [], []
    for text, some in zip(texts, cuts, strict=True):
        if not some.is_valid:
            kept.append(None)
            reports.append(None)
            continue
        lines = text.as_py().split("\n")
        first_lines = {c["u"]: c for c in some.as_py()}
        out, removed, single, u, gone, left = [], 0, 0, -1, None, False
        for line in lines:
            if line.strip(BLANK):
                u += 1
                c = first_lines.get(u)
                gone = c if c is not None and c["line"] == line else None
                left |= gone is None
            if gone is None:
                out.append(line)
            else:
                removed += 1
                single += gone["single"]
        kept.append("\n".join(out))
        reports.append({"n_lines": len(lines), "n_removed": removed, "n_single": single, "emptied": not left})
    kind = pa.struct([("n_lines", pa.int64()), ("n_removed", pa.int64()), ("n_single", pa.int64()), ("emptied", pa.bool_())])
    return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(reports, kind)], names=["text", "report"])


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated chunks cut from ``text``, and a struct ``dedup`` (n_lines, n_removed, n_single, emptied; with underscores after its name where ``docs`` has such a column)."""
    rows = keyed(docs).withColumn("text", F.col("row.text"))
    told = rows.where("text is not null").select("d", "h", "text")
    lines = repeated_lines(told)
    may, plain = split_by_keys(rows, lines.select("d", "h"), ["d", "h"])
    may = may.join(with_first_lines(told, lines).hint("shuffle_hash"), ["d", "h"], "left")
    name = fresh(docs.columns, "dedup")
    n_lines = F.coalesce(F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1, F.lit(0))
    untouched = F.struct(n_lines.alias("n_lines"), F.lit(0).alias("n_removed"), F.lit(0).alias("n_single"), F.lit(False).alias("emptied")).cast(REPORT)
    told = lambda text, report: [*(text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns), report.alias(name)]
    cut = may.select("row", "text", without_lines(F.when(F.col("cuts").isNotNull(), F.col("text")), "cuts").alias("new"))
    cut = cut.select(*told(F.coalesce("new.text", "text"), F.coalesce("new.report", untouched)))
    return plain.select(*told(F.col("text"), untouched)).unionByName(cut)

"""Mixing sources to target weights: Sainte-Laguë quotas of equal blocks, then seeded runs of blocks; built-in functions only.

Each source's target is its weight's part of the wanted tokens, held to ``most``
times its own, the excess shared again by weight.  The wanted tokens are blocks
of equal size, and blocks go to sources by highest quotients (target / 1, / 3,
/ 5, ...).  A source's blocks go on to its shards in the same way by their tokens.

A shard is a bounded part of a source, told by a hash; its documents stand in
seeded order as one stream of tokens, read around and around.  A quota of q
blocks takes q x block tokens from a seeded block of that stream on, so whole laps
take every document and the rest a run of it: blocks may begin and end inside
documents, and no block becomes a row.

Only the first blocks of a quota are given without comparing: with m parties and N
seats, the quotients above the divisor ``total / (N - m / 2)`` surely win, and no
more than m seats remain, for which a few quotients a party are ranked.  Sources
are ranked by ranges; a source's shards form a tree of ``FANOUT`` children a
node, so that no ranking holds more than a node's.  So a source of any size, or any number
of sources, goes through no single task.  Targets are found by Newton steps on a table of one
row a source, which end after a few, each at a single number.

Defined results: a null text has no tokens; documents without tokens take none;
a null source is a source, the last; repeated rows each have their own place;
rows that agree in everything take what they take in any order; a table without tokens
has targets of 0; an empty table gives no rows; columns other than id, text and source are
neither read nor carried, whatever their names.  The same rows and seed give the same mix in any partitioning.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartulary.llm.common import discard, let, lookup_join, materialise
from cartulary.operators.ranking import ranked

TOKEN = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: Tokens and documents of a shard, about; children of a node of a source's shards.
SHARD_TOKENS, SHARD_ROWS, FANOUT = 1 << 17, 128, 256
#: Tokens of a block at most; a block is also no more than one in so many tokens of the smallest target and of a source's mean shard.
BLOCK_TOKENS, PRECISION = 1024, 500

#: What a mix has beside the id, in this order.
COLUMNS = ("source", "size", "source_size", "target", "taken", "spans", "shard", "at", "text_hash")


@dataclass(frozen=True)
class Mix:
    """Weights of the sources in order, repeating; the mix's tokens as a share of all; the most that a source, and so a document, is repeated."""

    weights: tuple[float, ...] = (5, 2, 1)
    share: float = 1.5
    most: float = 2.0
    seed: int = 1


def count_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN)).cast("bigint")


def targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """``sources(source_size, w, ...)`` with their target.

    The level x at which ``sum(min(most * size, x * w))`` is the wanted sum: that sum is concave in x, so Newton
    steps from below, each one aggregate, reach x exactly, and soon.
    """
    wanted = mix.share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    cap = F.lit(float(mix.most)) * F.col("source_size")
    level, capped = 0.0, -1
    while True:
        over = (cap < level * F.col("w")) if capped >= 0 else F.lit(False)
        held, free, n = sources.agg(F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("w"))), F.lit(0.0)), F.count_if(over)).first()
        if n == capped or not free:
            break
        level, capped = (wanted - held) / free, n
    return sources.withColumn("target", F.when(cap < level * F.col("w"), cap).otherwise(level * F.col("w")).cast("double"))


def sure_seats(votes: Column, total: Column, seats: Column, parties: Column, cap: Column) -> tuple[Column, Column]:
    """(seats that a party surely gets, last seat for which its quotient is to be ranked)."""
    divisors = F.greatest(seats - parties / 2.0, F.lit(0.0))
    share = F.when(total > 0, votes / total).otherwise(0.0)
    base = F.least(F.floor(share * divisors + 0.5 - 1e-9), cap).cast("bigint")
    base = F.greatest(base - 1, F.lit(0).cast("bigint"))  # one less, so that rounding of the share can't give a seat too many
    more = F.ceil(share * (F.least(seats, parties * 1.0) + parties)) + 3
    return base, F.least(base + more.cast("bigint"), cap)


def seats_by_ranges(parties: DataFrame, seats: int, votes: str, cap: str) -> DataFrame:
    """``parties`` (with a distinct ``place``) with their ``quota`` of ``seats``; ties go to the earlier place; any number of parties."""
    total, n = parties.agg(F.coalesce(F.sum(votes), F.lit(0.0)), F.count("*")).first()
    base, last = sure_seats(F.col(votes), F.lit(float(total)), F.lit(float(seats)), F.lit(float(n)), F.col(cap))
    told = materialise(parties.withColumn("base", base).withColumn("last", last), "parties")
    left = seats - (told.agg(F.sum("base")).first()[0] or 0)
    quotients = told.where("last > base").select("place", F.explode(F.sequence(F.col("base") + 1, F.col("last"))).alias("k"), F.col(votes).alias("v"))
    order = [(F.col("v") / (2 * F.col("k") - 1)).desc(), F.col("place"), F.col("k")]
    won = ranked(quotients.where("v > 0"), order).where(F.col("rank") <= left).groupBy("place").agg(F.count("*").alias("won"))
    return told.join(won, "place", "left").withColumn("quota", F.col("base") + F.coalesce("won", F.lit(0))).drop("base", "last", "won")


def seats_in_groups(parties: DataFrame, group: list[str], votes: str, cap: str, seats: str, order: list[str]) -> DataFrame:
    """The same within each group of no more than ``FANOUT`` parties, whose seats stand in each of its rows."""
    by = Window.partitionBy(*group)
    base, last = sure_seats(F.col(votes).cast("double"), F.col("_total"), F.col(seats).cast("double"), F.col("_n").cast("double"), F.col(cap))
    told = parties.withColumn("_total", F.sum(votes).over(by).cast("double")).withColumn("_n", F.count("*").over(by))
    told = told.withColumn("_base", base).withColumn("_last", last).withColumn("_left", F.col(seats) - F.sum("_base").over(by))
    ks = F.when(F.col("_last") > F.col("_base"), F.sequence(F.col("_base") + 1, F.col("_last")))
    ranks = Window.partitionBy(*group).orderBy((F.col(votes) / (2 * F.col("_k") - 1)).desc(), *order, "_k")
    tried = told.select("*", F.explode_outer(ks).alias("_k")).withColumn("_rank", F.row_number().over(ranks))
    won = F.count_if(F.col("_k").isNotNull() & (F.col(votes) > 0) & (F.col("_rank") <= F.col("_left")))
    return tried.groupBy(*parties.columns, "_base").agg(won.alias("_won")).withColumn("quota", F.col("_base") + F.col("_won")).drop("_base", "_won")


def shard_quotas(shards: DataFrame, sources: DataFrame, block: int, most: float, fanout: int) -> DataFrame:
    """place, shard, quota: each source's ``quota`` of blocks, dealt down the tree of its shards(place, shard, stream).

    Node ``shard div fanout^k`` of a level has the tokens of the shards below it; a source's root has its quota.
    """
    deepest = shards.agg(F.max("shard")).first()[0] or 0
    levels = 1
    while fanout**levels <= deepest:
        levels += 1
    cap = F.floor(F.col("stream") * most / block).cast("bigint")
    current = sources.where("quota > 0").select("place", F.lit(0).cast("bigint").alias("above"), F.col("quota").alias("seats"))
    for k in reversed(range(levels)):
        nodes = shards.groupBy("place", F.expr(f"shard div {fanout**k}L").alias("node")).agg(F.sum("stream").alias("stream"), F.sum(cap).cast("bigint").alias("cap"))
        held = nodes.withColumn("above", F.expr(f"node div {fanout}L")).join(current, ["place", "above"])
        dealt = seats_in_groups(held, ["place", "above"], "stream", "cap", "seats", ["node"])
        current = materialise(dealt.select("place", F.col("node").alias("above"), F.col("quota").alias("seats")), "quotas")
    return current.select("place", F.col("above").alias("shard"), F.col("seats").alias("quota"))


def overlap(p: Column, n: Column, a: Column, length: Column) -> Column:
    """struct<first, words>: the part of the run [p, p + n) that lies in [a, a + length), from its start; null without one."""
    low, high = F.greatest(p, a), F.least(p + n, a + length)
    return F.when(high > low, F.struct((low - p).alias("first"), (high - low).alias("words")))


def spans_of(place: Column, size: Column, stream: Column, first: Column, length: Column) -> Column:
    """Which words of a document at ``place`` of its stream a run takes that begins at ``first`` and goes around: an array of (first, words), repeats again."""
    around = F.greatest(stream, F.lit(1).cast("bigint"))
    laps, rest = F.floor(length / around).cast("int"), length % around
    whole = F.when(size > 0, F.array_repeat(F.struct(F.lit(0).cast("bigint").alias("first"), size.alias("words")), laps)).otherwise(F.array())
    return F.concat(whole, F.array_compact(F.array(overlap(place, size, first, rest), overlap(place, size, first - around, rest))))


def mix_sources(docs: DataFrame, mix: Mix = Mix(), id_column: str = "doc_id", text: str = "text", source: str = "source", fanout: int = FANOUT) -> DataFrame:
    """One row a document: its id, ``COLUMNS``.

    size is its tokens, source_size and target its source's; taken the tokens that the mix takes of it, spans which
    (repeats again); shard and at say where it stands, text_hash which text the row is about.
    """
    seeded = F.xxhash64(F.lit(mix.seed), F.col(id_column), F.col(text))
    told = docs.select(F.col(id_column).alias("id"), F.col(source).cast("string").alias("source"), count_tokens(F.col(text)).alias("size"), F.xxhash64(text).alias("text_hash"), seeded.alias("h"))
    told = materialise(told, "sized")
    sources = told.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    placed = ranked(sources, [F.col("source").asc_nulls_last()], "place", 0)
    weights = F.array(*(F.lit(float(w)) for w in mix.weights))
    parts = F.greatest(F.ceil(F.col("source_size") / SHARD_TOKENS), F.ceil(F.col("rows") / SHARD_ROWS)).cast("bigint")
    placed = materialise(placed.withColumn("w", F.get(weights, (F.col("place") % len(mix.weights)).cast("int"))).withColumn("n_shards", parts), "sources")
    aimed = materialise(targets(placed, mix), "targets")
    grain = F.least("target", F.col("source_size") / F.col("n_shards"))
    wanted, least, rows = aimed.agg(F.coalesce(F.sum("target"), F.lit(0.0)), F.min(F.when(grain > 0, grain)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    block = min(BLOCK_TOKENS, 1 << math.floor(math.log2(max(1.0, (least or 1.0) / PRECISION))))
    aimed = aimed.withColumn("cap", F.floor(F.col("source_size") * float(mix.most) / block).cast("bigint"))
    quotas = materialise(seats_by_ranges(aimed, round(wanted / block), "target", "cap"), "quotas")

    carried = quotas.select(F.xxhash64("source").alias("key"), F.col("source").alias("of"), "place", "rows", "source_size", "target", "n_shards")
    at = lookup_join(told.withColumn("key", F.xxhash64("source")), carried, "key", "rows", rows).where(F.col("source").eqNullSafe(F.col("of")))
    at = at.withColumn("shard", F.pmod(F.xxhash64(F.lit(mix.seed + 1), "h"), F.col("n_shards")))
    stream = Window.partitionBy("place", "shard")
    before = F.sum("size").over(stream.orderBy("h", "id", "text_hash").rowsBetween(Window.unboundedPreceding, -1))
    at = at.select("id", "source", "size", "text_hash", "source_size", "target", "place", "shard", F.coalesce(before, F.lit(0)).alias("at"), F.sum("size").over(stream).alias("stream"))
    at = materialise(at, "streams")
    discard(told)
    dealt = shard_quotas(at.groupBy("place", "shard").agg(F.max("stream").alias("stream")), quotas, block, mix.most, fanout)
    blocks = F.greatest(F.ceil(F.col("stream") / block), F.lit(1))
    begin = F.pmod(F.xxhash64(F.lit(mix.seed + 2), "place", "shard"), blocks) * block
    spans = F.when(F.col("quota") > 0, spans_of(F.col("at"), F.col("size"), F.col("stream"), begin, F.col("quota") * block)).otherwise(F.array())
    taken = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["words"])
    out = at.join(dealt, ["place", "shard"], "left").withColumn("spans", spans)
    return out.select(F.col("id").alias(id_column), *(taken.alias("taken") if c == "taken" else c for c in COLUMNS))


def mixed_texts(docs: DataFrame, mixed: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, piece (its number in the document) and text of each span of ``mixed``: its words, with the gaps between and after them as they are.

    A document whose row is repeated gives the spans of all its rows.
    """
    spans = mixed.where(F.size("spans") > 0).groupBy(F.col(id_column).alias("id"), "text_hash").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    texts = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")).dropDuplicates(["id", "text_hash"])
    told = texts.join(spans.withColumnRenamed("id", "of"), F.col("id").eqNullSafe(F.col("of")) & (texts["text_hash"] == spans["text_hash"]))
    units = F.regexp_extract_all(F.col("text"), F.lit(f"({TOKEN}(?:{GAP})?)"), F.lit(1))
    cut = let(units, lambda u: F.transform("spans", lambda x: F.array_join(F.slice(u, (x["first"] + 1).cast("int"), x["words"].cast("int")), "")))
    return told.select("id", F.posexplode(cut).alias("piece", "text")).select(F.col("id").alias(id_column), "piece", F.col("text").alias(text))

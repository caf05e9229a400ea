"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. *Targets.* Sources weigh in a repeating cycle and share a budget; none gets more than a multiple of its own size,
   and what is cut off is shared again by weight until no source is above.
2. *Shards.* Texts are cut into blocks of words, and the blocks of a source dealt over shards of bounded length by
   hash. One hot source is many shards, and one giant text lies in many of them.
3. *Quotas.* Sainte-Lague gives each shard its whole number of blocks: the highest quotients of
   target by 1, 3, 5, ... win. They are those above a common divisor, which Spark narrows down in a few passes over the
   shard table, 64 divisors at a time; equal quotients go to the shard that sorts first.
4. *Selection.* A shard takes whole passes over its words, then blocks in the order of a seeded hash until its
   quota is full; of the last block only the first words may be taken.
5. *Texts.* The blocks a row gives and how often are part of the result, and its mixed text is made of just these: those of
   the first pass in order, then those of the next. Neighbours keep the white space between them, a line feed stands
   for what is left out.

Nothing but sums reaches the driver. Results depend on the rows and the seed alone, so reruns agree.

Defined cases: a null text has size 0 and takes nothing. A null source is a source of its own, the last.
Sources of size 0 get nothing. Equal rows are mixed one by one. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statledger.llm.columns import SPACE, WORD, bind, fresh_name, stored_rows, with_row
from statledger.session import written

CYCLE = (5, 2, 1)
BUDGET_PERCENT = 150
MAX_EPOCHS = 2
BLOCK = 32
SHARD_BLOCKS = 4096
SEED = 17
# Divisors tried in one pass over the shards.
STEPS = 64
# A word, and the words of a block, each with the white space after it; the first block has that before it too.
WORD_TEXT = f"(?:\\A{SPACE})?{WORD}+(?:{SPACE})?"
BLOCK_TEXT = f"(?:\\A{SPACE})?{WORD}+(?:{SPACE}+{WORD}+){{0,{BLOCK - 1}}}+(?:{SPACE})?"


def sizes(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, source, size)`` of every row; stored, so that row numbers stay."""
    return _sized(with_row(docs, "doc_id", "source", "text"))


def _sized(rows: DataFrame) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return written(rows.select("doc_id", "source", size.alias("size"), "row"), "mix-sizes")


def _in_order(sources: DataFrame) -> DataFrame:
    """A ``rank`` from 0 by source, nulls last, without one task for all of them."""
    # Stored, since the parts of a sort may differ from run to run.
    ordered = sources.orderBy(F.col("source").asc_nulls_last())
    parts = written(ordered.withColumn("part", F.spark_partition_id()), "mix-sources")
    before = {}
    total = 0
    for r in parts.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():
        before[r["part"]] = total
        total += r["n"]
    offset = F.lit(0)
    for part, n in before.items():
        offset = F.when(F.col("part") == part, F.lit(n)).otherwise(offset)
    own = F.row_number().over(
        Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    )
    return parts.withColumn("rank", own - 1 + offset).drop("part")


def source_targets(rows: DataFrame) -> DataFrame:
    """``(source, source_size, n_blocks, target)``."""
    blocks = F.ceil(F.col("size") / BLOCK)
    sources = _in_order(
        rows.groupBy("source").agg(
            F.sum("size").alias("source_size"), F.sum(blocks).cast("long").alias("n_blocks")
        )
    )
    cycle = F.array(*[F.lit(float(w)) for w in CYCLE])
    weighed = written(
        sources.select(
            "source",
            "source_size",
            "n_blocks",
            F.get(cycle, (F.col("rank") % len(CYCLE)).cast("int")).alias("weight"),
        ),
        "mix-weights",
    )
    cap = F.col("source_size") * float(MAX_EPOCHS)
    budget = weighed.agg(F.sum("source_size")).first()[0] or 0
    budget = budget * BUDGET_PERCENT / 100
    share, capped = 0.0, -1
    while True:
        full = cap <= F.lit(share) * F.col("weight")
        found = weighed.agg(
            F.count_if(full).alias("n"),
            F.sum(F.when(full, cap)).alias("used"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
        ).first()
        if found["n"] == capped or not found["open"]:
            break
        capped = found["n"]
        share = (budget - (found["used"] or 0.0)) / found["open"]
    target = F.least(cap, F.lit(share) * F.col("weight"))
    return written(
        weighed.select("source", "source_size", "n_blocks", target.alias("target")), "mix-targets"
    )


def _seats(divisor: Column) -> Column:
    """Quotients target / (2 s + 1) at or above half a divisor, at most as many as blocks fit."""
    return F.floor(F.col("want") / divisor + 0.5)


def apportion(shards: DataFrame, seats: int) -> DataFrame:
    """``shards`` with a whole number ``quota`` for each, by highest quotients of ``want``.

    ``shards`` is stored and has ``want`` and ``order``, which breaks ties.
    """
    if not seats:
        return shards.withColumn("quota", F.lit(0).cast("long"))
    total = shards.agg(F.sum("want")).first()[0]
    low, high = total / (2.0 * seats), 4.0 * total / seats + 1.0
    while True:
        tried = sorted({low + (high - low) * k / STEPS for k in range(1, STEPS)} - {low, high})
        if not tried:
            break
        counted = shards.agg(
            *[F.sum(_seats(F.lit(d))).alias(f"s{k}") for k, d in enumerate(tried)]
        ).first()
        enough = [d for k, d in enumerate(tried) if counted[k] >= seats]
        less = [d for k, d in enumerate(tried) if counted[k] < seats]
        low, high = max([low, *enough]), min([high, *less])
        exact = [d for k, d in enumerate(tried) if counted[k] == seats]
        if exact:
            return shards.withColumn("quota", _seats(F.lit(exact[0])).cast("long"))
    # Adjacent divisors: only shards with the same last quotient differ between them.
    few, many = _seats(F.lit(high)), _seats(F.lit(low))
    left = seats - (shards.agg(F.sum(few)).first()[0] or 0)
    tied = written(shards.where(many > few).select("order"), "mix-ties")
    winners = tied.orderBy("order").limit(int(left)).withColumn("won", F.lit(1))
    return (
        shards.join(winners, "order", "left")
        .withColumn("quota", (few + F.coalesce("won", F.lit(0))).cast("long"))
        .drop("won")
    )


def _blocks(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """A row per block of words, with its shard and its place in the seeded order."""
    deal = targets.select(
        F.col("source").alias("s"), F.ceil(F.col("n_blocks") / SHARD_BLOCKS).alias("n_shards")
    )
    counted = rows.where("size > 0").join(deal, F.col("source").eqNullSafe(F.col("s")))
    each = counted.select(
        "row",
        "doc_id",
        "source",
        "size",
        "n_shards",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / BLOCK))).alias("block"),
    )
    chance = F.xxhash64(F.lit(SEED), "doc_id", "size", "block")
    return each.select(
        "row",
        "source",
        "block",
        F.least(F.lit(BLOCK), F.col("size") - F.col("block") * BLOCK).alias("words"),
        F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id", "block"), F.col("n_shards")).alias("shard"),
        chance.alias("chance"),
    )


def chosen_blocks(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``(row, block, words, times, extra)`` of the blocks taken: whole so many times, then the first ``extra`` words."""
    blocks = _blocks(rows, targets)
    held = blocks.groupBy("source", "shard").agg(F.sum("words").alias("held"))
    known = targets.select(F.col("source").alias("s"), "source_size", "target")
    shards = written(
        held.join(known, F.col("source").eqNullSafe(F.col("s"))).select(
            "source",
            "shard",
            "held",
            (F.col("target") * F.col("held") / F.col("source_size")).alias("want"),
            F.struct(F.col("source").isNull().alias("last"), "source", "shard").alias("order"),
        ),
        "mix-shards",
    )
    total = shards.agg(F.sum("want")).first()[0] or 0.0
    quotas = apportion(shards, round(total / BLOCK)).select(
        F.col("source").alias("s"), F.col("shard").alias("h"), "held", "quota"
    )
    asked = F.least(F.col("quota") * BLOCK, F.col("held") * MAX_EPOCHS)
    quotas = quotas.withColumn("passes", F.floor(asked / F.col("held"))).withColumn(
        "rest", asked - F.col("passes") * F.col("held")
    )
    dealt = blocks.join(
        quotas, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h"))
    )
    order = Window.partitionBy("source", "shard").orderBy("chance", "row", "block")
    before = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
    more = F.greatest(F.lit(0), F.least(F.col("words"), F.col("rest") - before))
    again = F.col("more") == F.col("words")
    return (
        dealt.withColumn("more", more)
        .where("passes > 0 OR more > 0")
        .select(
            "row",
            F.col("block").cast("int").alias("block"),
            F.col("words").cast("int").alias("words"),
            (F.col("passes") + again.cast("int")).cast("int").alias("times"),
            F.when(again, 0).otherwise(F.col("more")).cast("int").alias("extra"),
        )
    )


def mix_sources(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, size, source_size, target, taken, blocks)`` of every row.

    ``blocks`` has ``(block, times, extra)`` of each block taken, in order; ``taken`` is the sum of their words.
    """
    return _mixed(sizes(docs))


def _mixed(rows: DataFrame) -> DataFrame:
    """:func:`mix_sources` for rows whose sizes are stored."""
    targets = source_targets(rows)
    known = targets.select(F.col("source").alias("s"), "source_size", "target")
    taken = (
        chosen_blocks(rows, targets)
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.col("words") + F.col("extra")).cast("long").alias("taken"),
            F.sort_array(F.collect_list(F.struct("block", "times", "extra"))).alias("blocks"),
        )
    )
    none = F.array().cast("array<struct<block:int,times:int,extra:int>>")
    return (
        rows.join(taken, "row", "left")
        .join(known, F.col("source").eqNullSafe(F.col("s")))
        .select(
            "row",
            "doc_id",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
            F.coalesce("blocks", none).alias("blocks"),
        )
    )


def mixed_text(text: Column, blocks: Column) -> Column:
    """The words of ``text`` that ``blocks`` has, pass by pass; a text taken whole and once is unchanged."""
    parts = F.regexp_extract_all(text, F.lit(BLOCK_TEXT), F.lit(0))

    def one_pass(parts: Column, n: int) -> Column:
        here = F.filter(blocks, lambda b: (b["times"] >= n) | ((b["times"] == n - 1) & (b["extra"] > 0)))

        def piece(b: Column, k: Column, here: Column) -> Column:
            whole = F.get(parts, b["block"])
            words = F.regexp_extract_all(whole, F.lit(WORD_TEXT), F.lit(0))
            some = F.array_join(F.slice(words, 1, b["extra"]), "")
            follows = (k == 0) | (F.get(here, k - 1)["block"] == b["block"] - 1)
            seam = F.when(follows, F.lit("")).otherwise(F.lit("\n"))
            return F.concat(seam, F.when(b["times"] >= n, whole).otherwise(some))

        return bind(here, lambda h: F.array_join(F.transform(h, lambda b, k: piece(b, k, h)), ""))

    def passes(parts: Column) -> Column:
        each = F.array(*[one_pass(parts, n) for n in range(1, MAX_EPOCHS + 1)])
        return F.array_join(F.filter(each, lambda t: t != ""), "\n")

    return bind(parts, passes)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes words of, with the text taken, ``mix_size``, ``mix_target`` and ``mix_taken``.

    Every row stands for all the words taken of it, repeats included, so words per source are the targets.
    """
    rows, row = stored_rows(docs, "mix-texts")
    blocks = fresh_name(rows, "blocks")
    sized = _sized(rows.select("doc_id", "source", "text", F.col(row).alias("row")))
    taken = _mixed(sized).where("taken > 0")
    wanted = taken.select(
        F.col("row").alias(row),
        F.col("blocks").alias(blocks),
        F.col("size").alias("mix_size"),
        F.col("target").alias("mix_target"),
        F.col("taken").alias("mix_taken"),
    )
    kept = [c for c in docs.columns if c not in ("mix_size", "mix_target", "mix_taken")]
    mixed = rows.select(row, *kept).join(wanted.hint("shuffle_hash"), row)
    mixed = mixed.withColumn("text", mixed_text(F.col("text"), F.col(blocks)))
    if "n_chars" in kept:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return mixed.drop(row, blocks)


def mix_report(docs: DataFrame) -> DataFrame:
    """:func:`mix_sources` without row numbers; ``blocks`` as ``block:times:extra``, by commas."""
    listed = F.transform("blocks", lambda b: F.concat_ws(":", b["block"], b["times"], b["extra"]))
    return mix_sources(docs).drop("row").withColumn("blocks", F.array_join(listed, ","))

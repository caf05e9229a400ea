"""Benchmark decontamination by size-partitioned MinHash containment search, with DataFrame functions only.

A text is contaminated by a test item if it holds at least 80 % of the item's distinct 5-word shingles.

1. *Signatures.* Items are partitioned by the number of their shingles, each partition reaching to twice the
   size of the last. Every item of a partition is represented by as many shingles of least
   hash (rarest in the benchmark first) as the partition's size asks for: one more than the share of shingles a
   contaminated text may lack, so that such a text holds at least one of them for certain.
2. *Candidates.* Shingles of whole texts meet the signatures; the shingles hit estimate the containment.
3. *Exact containment.* Candidates are shingled again and all shingles of their items counted.

Signatures and candidates are stored first, so Spark knows their size: it broadcasts them below its
own limit and shuffles beyond it. Hits are counted per text and item, and combined before the shuffle.
Texts are read again and not stored: a row number tells rows apart within one scan only, and from scan to scan
texts are found by content. A hash that two texts share makes a candidate too many, which the exact step refuses.

Defined cases: case is ignored for A-Z; a null text, or one without words, is never contaminated, and such an item
contaminates nothing. Fewer than five words are one shingle, so a short item is found only in a text of just these
words. Items with equal ids are one item; repeated rows are reported once each. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statledger.llm.columns import ascii_lower, bind, shingles, with_text_keys, words
from statledger.llm.lookup import perhaps_in, without
from statledger.session import written

# Whole percentages: the least containment, and what a text may lack.
PERCENT = 80
MISSING = 100 - PERCENT


def distinct_shingles(text: Column) -> Column:
    return bind(words(ascii_lower(text)), lambda ws: F.array_distinct(shingles(ws)))


def item_shingles(benchmark: DataFrame) -> DataFrame:
    """``(item_id, shingle, n_item)`` of all items, and a ``sampled`` mark on their signatures."""
    every = (
        benchmark.select("item_id", F.explode(distinct_shingles(F.col("text"))).alias("shingle"))
        .distinct()
        .withColumn("n_item", F.count("*").over(Window.partitionBy("item_id")))
        .withColumn("items", F.count("*").over(Window.partitionBy("shingle")))
    )
    # The partition of sizes from 2^p up to, but without, 2^(p+1) is served as its largest size asks.
    largest = F.expr("shiftleft(2L, CAST(floor(log2(n_item)) AS INT))") - 1
    length = F.floor(largest * MISSING / 100) + 1
    rank = F.row_number().over(
        Window.partitionBy("item_id").orderBy("items", F.xxhash64("shingle"), "shingle")
    )
    return every.withColumn("sampled", rank <= length).drop("items")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(row, doc_id, item_id, n_item, n_shared)`` of every contaminated row and item."""
    return _contaminated(docs, benchmark).drop("text_key", "digest")


def _contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The same with what tells the text."""
    texts = with_text_keys(docs.select("doc_id", "text"))[0].withColumn("row", F.monotonically_increasing_id())
    items = written(item_shingles(benchmark), "benchmark-shingles")
    signatures = written(items.where("sampled").select("item_id", "shingle"), "benchmark-signatures")

    def exploded(rows: DataFrame, *columns: str) -> DataFrame:
        return rows.select("row", *columns, F.explode(distinct_shingles(F.col("text"))).alias("shingle"))

    hits = (
        exploded(texts, "text_key")
        .join(signatures, "shingle")
        .groupBy("row", "text_key", "item_id")
        .agg(F.count("*").alias("n"))
    )
    sizes = items.groupBy("item_id").agg(
        F.max("n_item").alias("n_item"), F.count_if("sampled").alias("signature")
    )
    least = F.col("signature") - F.floor(F.col("n_item") * MISSING / 100)
    candidates = hits.join(sizes, "item_id").where(F.col("n") >= least)
    candidates = written(candidates.select("text_key", "item_id").distinct(), "benchmark-candidates")
    chosen = written(candidates.select("text_key").distinct(), "benchmark-chosen")
    near = perhaps_in(texts, "text_key", chosen).join(chosen, "text_key", "left_semi")
    shared = (
        exploded(near, "doc_id", "text_key", "digest")
        .join(items.select("item_id", "shingle", "n_item"), "shingle")
        .groupBy("row", "item_id")
        .agg(
            *[F.first(c).alias(c) for c in ("doc_id", "text_key", "digest")],
            F.first("n_item").alias("n_item"),
            F.count("*").alias("n_shared"),
        )
        .join(candidates, ["text_key", "item_id"], "left_semi")
    )
    return shared.where(100 * F.col("n_shared") >= PERCENT * F.col("n_item")).select(
        "row", "doc_id", "item_id", "n_item", "n_shared", "text_key", "digest"
    )


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark).select("doc_id", "item_id", "n_item", "n_shared")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, all columns unchanged."""
    found = written(_contaminated(docs, benchmark).select("text_key", "digest").distinct(), "benchmark-found")
    rows, keys = with_text_keys(docs)
    return without(rows, keys, found).select(*docs.columns)


ORACLE = """
WITH grams AS (
  SELECT kind, id, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END AS s
  FROM (
    SELECT kind, id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents
          UNION ALL SELECT 'i', item_id, text FROM benchmark)
  ) WHERE len(w) > 0
), each AS (SELECT DISTINCT kind, id, unnest(s) AS shingle FROM grams),
items AS (SELECT id AS item_id, shingle, count(*) OVER (PARTITION BY id) AS n_item FROM each WHERE kind = 'i')
SELECT d.id AS doc_id, item_id, max(n_item) AS n_item, count(*) AS n_shared
FROM each d JOIN items USING (shingle) WHERE d.kind = 'd'
GROUP BY d.id, item_id
HAVING 100 * count(*) >= 80 * max(n_item)
"""

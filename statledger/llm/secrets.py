"""Secret scan with corpus-wide ownership.

Candidates are found per text; their digests are counted over the whole corpus by distinct
repositories and distinct owners. A digest held by few of either is live-looking; one copied over
many of them is an example. Counting goes through distinct (digest, repository, owner) triples, which
Spark combines before the shuffle, so a key pasted into a third of all texts costs no more than others.

Defined cases: a null text is empty and gives a row without spans; equal rows give one row each, and
a digest repeated within one repository counts it once, however many texts of it are copies; a null repository or owner counts as one
more of its kind. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statledger.llm.arrays import pieces
from statledger.llm.columns import with_row
from statledger.llm.spans import SECRET_KINDS, count_kind, secret_spans, span_text
from statledger.session import written

# At most so many owners and repositories hold a secret that still looks live.
LIVE_OWNERS = 1
LIVE_REPOSITORIES = 2
BASE_KINDS = 3

_SPANS = "array<struct<start:int,kind:int,end:int,digest:string>>"
_SPAN_TYPE = pa.list_(
    pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("digest", pa.string())])
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            found = [
                [
                    {"start": s, "kind": k, "end": e, "digest": _digest(value)}
                    for s, k, e, value in secret_spans(text or "")
                ]
                for text in piece.column("text").to_pylist()
            ]
            kept = [n for n in piece.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [piece.column(n) for n in kept] + [pa.array(found, _SPAN_TYPE)], [*kept, "spans"]
            )


def _digest(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()[:32]


def scan_secrets(docs: DataFrame, repository: str = "source", owner: str = "owner") -> DataFrame:
    """``(row, doc_id, repository, owner, spans)``; spans carry a digest, never the secret.

    Without an owner column the repository is the owner, so copies of a text within one make no new owners.
    """
    holder = F.col(owner) if owner in docs.columns else F.col(repository)
    rows = with_row(
        docs.select(
            "doc_id",
            F.col(repository).cast("string").alias("repository"),
            holder.cast("string").alias("owner"),
            "text",
        ),
        "doc_id",
        "repository",
        "owner",
        "text",
    )
    schema = f"doc_id bigint, repository string, owner string, row bigint, spans {_SPANS}"
    return rows.mapInArrow(_scan, schema)


def ownership(found: DataFrame) -> DataFrame:
    """Repositories and owners of every digest, over all rows, and whether it looks live."""
    triples = found.select(
        F.explode(F.array_distinct("spans.digest")).alias("digest"),
        F.coalesce(F.col("repository"), F.lit("")).alias("repository"),
        F.coalesce(F.col("owner"), F.lit("")).alias("owner"),
    )

    def counted(by: str) -> DataFrame:
        pairs = triples.groupBy("digest", by).agg(F.count("*").alias("n"))
        return pairs.groupBy("digest").agg(F.count("*").alias(f"n_{by}"))

    both = counted("repository").join(counted("owner"), "digest")
    live = (F.col("n_owner") <= LIVE_OWNERS) | (
        (F.col("n_repository") <= LIVE_REPOSITORIES) & (F.col("n_owner") <= 2 * LIVE_OWNERS)
    )
    return both.withColumn("live", live)


def secrets_report(docs: DataFrame) -> DataFrame:
    """Digest columns of every row, and how many of its spans look live or copied."""
    found = written(scan_secrets(docs), "secrets")
    held = found.select("row", F.explode("spans").alias("span")).select("row", "span.digest")
    verdicts = (
        held.join(ownership(found), "digest")
        .groupBy("row")
        .agg(
            F.count_if("live").alias("n_live"),
            F.count_if(~F.col("live")).alias("n_copied"),
            F.max("n_repository").alias("most_repositories"),
        )
    )
    zero: Column = F.lit(0).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < BASE_KINDS)
    return found.join(verdicts, "row", "left").select(
        "doc_id",
        *[count_kind(F.col("spans"), k).alias(f"n_{SECRET_KINDS[k]}") for k in range(BASE_KINDS)],
        F.sha2(span_text(base, SECRET_KINDS), 256).alias("base_sha256"),
        span_text(F.col("spans"), SECRET_KINDS).alias("spans"),
        F.coalesce("n_live", zero).alias("n_live"),
        F.coalesce("n_copied", zero).alias("n_copied"),
        F.coalesce("most_repositories", zero).alias("most_repositories"),
    )

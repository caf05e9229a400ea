"""Executors that come or go change how a scan is split, and so its row numbers; results must not change."""

import pytest

from statledger.llm import decontaminate, jaccard, mixing, pii, samples, substrings

SPLITS = "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture
def split_docs(ready, sf_dir, tmp_path):
    """A file of many row groups that is cut into as many splits as there are executors, and the benchmark."""
    path = str(tmp_path / "docs")
    docs = ready.read.parquet(f"{sf_dir}/documents.parquet")
    docs.coalesce(1).write.option("parquet.block.size", 16 << 10).parquet(path)
    ready.conf.set("spark.sql.files.openCostInBytes", "1")
    ready.conf.set(SPLITS, "2")
    yield ready.read.parquet(path), ready.read.parquet(f"{sf_dir}/benchmark.parquet")
    for key in (SPLITS, "spark.sql.files.openCostInBytes"):
        ready.conf.unset(key)


def listed(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize(
    "operator",
    [
        lambda docs, benchmark: jaccard.jaccard_report(docs),
        lambda docs, benchmark: jaccard.keep_one_of_each(docs),
        lambda docs, benchmark: mixing.mixed_documents(docs),
        lambda docs, benchmark: pii.mask_pii(docs),
        decontaminate.decontamination_report,
        decontaminate.drop_contaminated,
        lambda docs, benchmark: substrings.substring_report(docs),
    ],
    ids=["jaccard", "one_of_each", "mixed_texts", "masked", "contaminated", "decontaminated", "substrings"],
)
def test_rows_hold_when_splits_change(ready, split_docs, operator):
    docs, benchmark = split_docs
    made = operator(docs, benchmark)
    ready.conf.set(SPLITS, "16")
    assert docs.select("doc_id").rdd.getNumPartitions() != 2
    late = listed(made)
    ready.conf.set(SPLITS, "2")
    assert late == listed(operator(docs, benchmark)) != []


def test_masking_leaves_no_match(ready, split_docs):
    from statledger.llm.spans import pii_spans

    texts = [r["text"] for r in pii.mask_pii(split_docs[0]).select("text").collect()]
    assert not any(pii_spans(t or "") for t in texts)
    # A phone that ran into an address is one only once that is masked.
    text = "+1 555 123 4567 10.20.30.40"
    spans = [{"start": s, "kind": k, "end": e} for s, k, e in pii_spans(text)]
    assert [s["kind"] for s in spans] == [1]
    assert pii.mask_all(text, spans) == "<PHONE> <IP>"


def test_clashing_names(make_docs):
    docs = make_docs([(1, "call +1 555 123 4567 now"), (2, "nothing here")]).toDF(
        "doc_id", "text", "lang", "source", "n_chars", "hit", "spans"
    )
    masked = pii.mask_pii(docs)
    assert masked.columns == docs.columns
    assert {r["text"] for r in masked.collect()} == {"call <PHONE> now", "nothing here"}


def test_samples_are_drawn_without_a_shuffle_of_texts(make_docs):
    docs = make_docs([(k, f"text {k}", None, "en" if k % 3 else "de") for k in range(300)])
    drawn = samples.drawn_rows(docs, "lang", samples.F.xxhash64("text"), 20, 100)
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert {r["lang"] for r in drawn.collect()} == {"en", "de"}
    unlabelled = make_docs([(1, "a"), (2, "b")])
    assert samples.drawn_rows(unlabelled, "lang", samples.F.xxhash64("text")).collect() == []

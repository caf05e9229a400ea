"""Stages find texts again by content; a copy of the corpus for each would fill the disk."""

import collections

import pytest
from plain_text import prose

from statledger.llm import columns, decontaminate, jaccard, pii

FIXED = [
    (1, None), (1, None), (2, ""), (2, ""), (None, None), (3, "  "), (3, "  "),
    (4, prose(4, 60)), (4, prose(4, 60)), (None, prose(4, 60)),
    (None, prose(5, 60)), (None, prose(5, 60)),
    (6, f"{prose(6, 60)} a"), (6, f"{prose(6, 60)} b"), (6, f"{prose(6, 60)} a"),
    (7, f"{prose(7, 30)} mail u@mail.example.org now"), (7, f"{prose(7, 30)} mail u@mail.example.org now"),
    (8, f"{prose(8, 50)} {prose(9, 40)}"), (8, f"{prose(8, 50)} {prose(9, 40)}"), (9, prose(9, 40)),
]


@pytest.fixture
def stored(monkeypatch):
    """Columns that the steps store."""
    names = set()
    for module in (columns, decontaminate, jaccard, pii):

        def kept(df, purpose, store=module.written):
            names.update(df.columns)
            return store(df, purpose)

        monkeypatch.setattr(module, "written", kept)
    return names


def rows_of(df):
    return collections.Counter((r["doc_id"], r["text"]) for r in df.collect())


@pytest.mark.parametrize("splits", [1, 7])
def test_stages_store_no_texts(ready, make_docs, stored, splits):
    docs = make_docs(FIXED).repartition(splits)
    bench = ready.createDataFrame([(1, prose(9, 40)), (2, None)], "item_id bigint, text string")
    given = collections.Counter(FIXED)
    one_each = rows_of(jaccard.keep_one_of_each(docs))
    near = {t for i, t in FIXED if i == 6}
    assert sum(one_each[6, t] for t in near) == 1
    # Rows without words are their own components, all others are kept once.
    expected = {k: n if not (k[1] or "").strip() else 1 for k, n in given.items() if k[1] not in near}
    del expected[None, prose(4, 60)]
    assert {k: n for k, n in one_each.items() if k[1] not in near} == expected

    clean = rows_of(decontaminate.drop_contaminated(docs, bench))
    assert clean == {k: n for k, n in given.items() if k[0] not in (8, 9)}
    found = [tuple(r) for r in decontaminate.decontamination_report(docs, bench).select("doc_id", "item_id").collect()]
    assert sorted(found) == [(8, 1), (8, 1), (9, 1)]

    masked = rows_of(pii.mask_pii(docs))
    assert masked == {(i, t and t.replace("u@mail.example.org", "<EMAIL>")): n for (i, t), n in given.items()}
    assert "text" not in stored


def test_one_of_equal_texts_keeps_its_own_columns(make_docs):
    text = prose(1, 30)
    docs = make_docs([(1, text, "b", "de"), (1, text, "a", "en"), (1, text, "c", "fr"), (2, text, "d", "it")]).coalesce(1)
    kept = jaccard.keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.schema.simpleString() == docs.schema.simpleString()
    assert [tuple(r) for r in kept.collect()] == [tuple(docs.first())]

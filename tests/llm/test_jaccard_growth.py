"""The Jaccard join returns links, not pairs, whatever groups of near copies look like."""

import random

import pytest
from plain_text import plain_components, prose, texts_of

from statledger.llm import jaccard


def near_copies(seed, n, words=200):
    """Copies of one text with one to three words changed."""
    rng = random.Random(seed)
    base = prose(seed, words).split()
    made = []
    for k in range(n):
        copy = list(base)
        for j in range(rng.randrange(1, 4)):
            copy[rng.randrange(words)] = f"changed{seed}x{k}x{j}"
        made.append(" ".join(copy))
    return made


def found_components(docs):
    import collections

    return collections.Counter(tuple(r) for r in jaccard.jaccard_report(docs).collect())


@pytest.fixture
def counted(monkeypatch):
    """Rows that each step stores, by its name."""
    sizes, store = {}, jaccard.written

    def stored(df, purpose):
        kept = store(df, purpose)
        sizes[purpose] = sizes.get(purpose, 0) + kept.count()
        return kept

    monkeypatch.setattr(jaccard, "written", stored)
    return sizes


def test_near_copies_make_few_rows(make_docs, counted):
    docs = make_docs(list(enumerate(near_copies(1, 900)))).repartition(5)
    assert {r[2] for r in found_components(docs)} == {0}
    candidates = sum(counted[k] for k in ("jaccard-links", "jaccard-possible", "jaccard-wanted"))
    assert candidates < 5 * 900


def test_groups_behind_a_text_that_only_shares_a_passage(make_docs, counted):
    """The least text of each bucket links with nothing, so the first round finds no link."""
    passage = prose(7, 60)
    rows = [(0, f"{passage} {prose(8, 12)}")]
    rows += [(1 + k, f"{passage} {prose(9 + k % 3, 12)} tail{k}") for k in range(300)]
    docs = make_docs(rows).repartition(4)
    assert found_components(docs) == plain_components(rows)
    assert counted["jaccard-possible"] < 5 * 300


def test_links_across_tiles_and_bands(make_docs, monkeypatch):
    """Chains of texts that grow by a few words, spread over many tiles."""
    monkeypatch.setattr(jaccard, "TILE", 4)
    monkeypatch.setattr(jaccard, "FEW", 2)
    monkeypatch.setattr(jaccard, "PARTNERS", 1e9)
    passage = prose(3, 80).split()
    rows = []
    for k in range(60):
        rows.append((k, " ".join(passage[: 20 + k])))
        rows.append((100 + k, " ".join([*passage[40:], *prose(50 + k, 20 + k).split()])))
    random.Random(2).shuffle(rows)
    docs = make_docs(rows).repartition(3)
    assert found_components(docs) == plain_components(rows)


def test_rounds_and_tiles_agree(make_docs, monkeypatch):
    rows = []
    for g in range(12):
        shared = prose(1000 + g // 3, 40)
        rows += [(1000 * g + k, f"{shared} {t}") for k, t in enumerate(near_copies(g, 12, words=30))]
    docs = make_docs(rows).repartition(4)
    expected = plain_components(texts_of(docs))
    for partners in (0, 1e9):
        monkeypatch.setattr(jaccard, "PARTNERS", partners)
        assert found_components(docs) == expected

"""Winnowed fingerprints against a plain version of the method."""

import collections
import functools
import hashlib
import random

import numpy as np
import pytest
from plain_text import prose, texts_of

from statledger.llm import fingerprints as fp


LONG = (1 << 64) - 1


def plain_mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & LONG
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & LONG
    return x ^ x >> 31


@functools.cache
def plain_hash(run):
    """The hash of one run, computed on its own."""
    total = len(run)
    for i, c in enumerate(run):
        total += (ord(c) + 1) * pow(fp._BASE, i, 1 << 64)
    return plain_mix(total & LONG) >> fp.POSITION_BITS


def plain_hashes(text, k):
    k = min(k, len(text))
    return [plain_hash(text[i : i + k]) for i in range(len(text) - k + 1)] if k else []


def plain_winnow(text, k=fp.K, w=fp.W):
    hashes = plain_hashes(text, k)
    w, kept = min(w, len(hashes)), {}
    for s in range(len(hashes) - w + 1 if hashes else 0):
        window = hashes[s : s + w]
        least = min(window)
        place = w - 1 - window[::-1].index(least)
        kept[s + place] = window[place]
    return sorted(kept.items())


def plain_report(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    made = []
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed, other = map(plain_winnow, (text, edited, following))
        sets = [{h for _, h in x} for x in (own, changed, other)]
        near = [2 * len(sets[0] & s) / (len(sets[0]) + len(s)) if sets[0] or s else 1.0 for s in sets[1:]]
        texts = [",".join(f"{h:010x}:{p}" for p, h in x) for x in (own, changed)]
        made.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *texts, *near))
    return collections.Counter(made)


def report(docs):
    return collections.Counter(map(tuple, fp.fingerprint_report(docs).collect()))


@pytest.mark.parametrize("text", ["", "a", "ab" * 5, "a" * 500, "abcab" * 60, prose(3, 80), "é𝄞" * 70])
@pytest.mark.parametrize(("k", "w"), [(fp.K, fp.W), (5, 4), (1, 1)])
def test_winnowing_by_window(text, k, w):
    kept, places = fp.winnow(text, k, w)
    assert list(zip(places.tolist(), kept.tolist())) == plain_winnow(text, k, w)


def test_rightmost_of_equal_hashes():
    assert fp.winnow("a" * 100, 4, 10)[1].tolist() == list(range(9, 97))


def test_long_texts_are_cut_without_loss(monkeypatch):
    text = prose(4, 400)
    whole = fp.winnow(text)
    monkeypatch.setattr(fp, "SEGMENT", 100)
    cut = fp.winnow(text)
    assert all((a == b).all() for a, b in zip(whole, cut))


def test_shared_runs_share_an_entry():
    """Match guarantee: a common run of W + K - 1 code points is found at its places in both texts."""
    rng = random.Random(1)
    for seed in range(50):
        run = prose(seed, 30)[: fp.W + fp.K - 1]
        found = []
        for side in range(2):
            before = prose(1000 + 2 * seed + side, rng.randrange(1, 9))
            kept, places = fp.winnow(f"{before} {run} {prose(5000 + 2 * seed + side, 9)}")
            found.append({(h, p - len(before) - 1) for h, p in zip(kept.tolist(), places.tolist())})
        assert any(0 <= p < fp.W for _, p in found[0] & found[1])


def test_report_on_given_rows(ready, sf_dir):
    docs = ready.read.parquet(f"{sf_dir}/documents.parquet")
    found = report(docs)
    assert found == plain_report(texts_of(docs))
    likeness = [(r[5], r[6]) for r in found]
    assert np.mean([a for a, _ in likeness]) > 0.45 and np.mean([b for _, b in likeness]) < 0.05


def test_report_on_odd_rows(make_docs, odd_docs):
    rows = [r for r in odd_docs if r != (9, "1" * 50_000)]
    docs = make_docs(rows + [(-4, "x" * 40), (2**62, prose(8, 20))]).repartition(4)
    assert report(docs) == plain_report(rows + [(-4, "x" * 40), (2**62, prose(8, 20))])


def test_equal_texts_have_equal_fingerprints(make_docs):
    text = prose(1, 70)
    found = fp.fingerprint_report(make_docs([(k, text) for k in range(20)])).collect()
    assert len(found) == 20 and len({r["fingerprint"] for r in found}) == 1
    assert {r["near_next"] for r in found} == {1.0}


def test_an_id_of_many_texts_is_split(make_docs):
    """A third of all rows under one id: every text is once the next one of another."""
    rows = [(5, prose(k, 12)) for k in range(200)] + [(1000 + k, prose(300 + k, 12)) for k in range(400)]
    docs = make_docs(rows).repartition(6)
    ranged, partitions = fp.ranged(docs)
    sizes = [r["count"] for r in ranged.where("doc_id = 5").groupBy("part").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 60
    chained = fp.with_next(ranged, partitions).select("part", "text", "after").collect()
    assert sum(not r["after"] for r in chained) == 600
    assert len(fp.fingerprint_report(docs).collect()) == 600
    texts = {t for _, t in rows}
    heads = [r["text"] for r in chained if r["after"]]
    assert len(heads) == len(set(heads)) == len({r["part"] for r in chained}) and set(heads) <= texts


def test_one_row_and_none(make_docs):
    assert report(make_docs([(1, "abc def ghi jkl")])) == plain_report([(1, "abc def ghi jkl")])
    assert report(make_docs([])) == {}


def test_general_form(make_docs, odd_docs):
    found = {r["doc_id"]: r["fingerprint"] for r in fp.fingerprints(make_docs(odd_docs[:6]), 6, 5).collect()}
    assert found[1] == found[2] == []
    expected = plain_winnow(odd_docs[5][1], 6, 5)
    assert [(e["position"], e["hash"]) for e in found[5]] == expected

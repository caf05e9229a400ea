"""Learned operators by held-out accuracy, page extraction, and the pipeline stage by stage."""

import itertools

import numpy as np
import pytest
from plain_text import plain_components, plain_pii, prose, texts_of
from pyspark.sql import functions as F

from statledger.llm import html_text, language, toxicity, transducers


@pytest.fixture(scope="module")
def given(ready, sf_dir):
    return ready.read.parquet(f"{sf_dir}/documents.parquet")


# -- language ----------------------------------------------------------------------


def test_held_out_language_accuracy(given):
    found = language.language_report(given).join(given.select("doc_id", "lang"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] >= 0.95
    assert found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_language_of_odd_rows(make_docs, odd_docs):
    rows = [*odd_docs, *[(100 + k, prose(k, 50), "s", "aa") for k in range(40)]]
    rows += [(200 + k, prose(k, 50)[::-1], "s", "bb") for k in range(40)] + [(300, "123 !? €", None, "aa")]
    docs = make_docs(rows)
    found = {}
    for r in language.language_report(docs).collect():
        found.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    for k in (1, 2, 3, 9, 300):
        assert found[k] == [("und", 0.0)]
    assert found[5][0] == found[5][1] == found[None][0] and found[5][0][0] == "aa"
    assert all(found[200 + k][0][0] == "bb" for k in range(40))
    kept = language.keep_known_languages(docs)
    assert kept.columns == docs.columns and {1, 2, 3, 9, 300}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_a_language_of_long_texts_only_is_learned(make_docs):
    rows = [(k, prose(k, 40), None, "short") for k in range(30)]
    rows += [(100 + k, " ".join(f"żółw{w[::-1]}ąę" for w in prose(k, 2500).split()), None, "long") for k in range(30)]
    docs = make_docs(rows)
    assert docs.where("lang = 'long'").agg(F.min(F.octet_length("text"))).first()[0] > 20_000
    found = {r["doc_id"]: r["lang_pred"] for r in language.language_report(docs).collect()}
    assert found == {r[0]: r[3] for r in rows}


def test_language_without_labels(make_docs, odd_docs):
    found = language.language_report(make_docs(odd_docs)).collect()
    assert len(found) == len(odd_docs) and {r["lang_pred"] for r in found} == {"und"}
    assert language.language_report(make_docs([])).count() == 0


def test_labels_of_held_out_rows_change_nothing(given):
    other = given.withColumn(
        "lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, "zz").otherwise(F.col("lang"))
    ).withColumn("source", F.lit("s"))
    first, second = (
        {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.language_report(d).collect()}
        for d in (given, other)
    )
    assert first == second


# -- toxicity ----------------------------------------------------------------------


def insulting(k):
    return f"{prose(k, 20)}. You grobble{k % 5} idiot, {prose(-k, 5)}."


@pytest.fixture(scope="module")
def grammar_data(ready, make_docs):
    rows = [(k, insulting(k) if k % 3 == 0 else prose(k, 30)) for k in range(150)]
    labels = ready.createDataFrame(
        [(k, int(k % 3 == 0)) for k in range(150)] + [(None, 1), (4, None), (5, 3)],
        "doc_id bigint, toxic int",
    )
    return rows, labels


def test_toxicity_of_odd_rows(make_docs, odd_docs, grammar_data):
    rows, labels = grammar_data
    extra = [(1000 + k, t) for k, (_, t) in enumerate(odd_docs)]
    found = toxicity.toxicity_report(make_docs([*rows, *extra]), labels).collect()
    assert len(found) == len(rows) + len(extra)
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[k]["predicted"] == int(k % 3 == 0) for k in range(150))
    assert by_id[1000]["score"] == by_id[1001]["score"] < 0.5
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    assert toxicity.toxicity_report(make_docs([]), labels).count() == 0


def test_stems_are_learned(make_docs, grammar_data):
    rows, labels = grammar_data
    learned = toxicity.train_grammar(make_docs(rows), labels)
    import pyarrow as pa

    texts = pa.array(["a grobblest remark", "a grey remark"])
    scores = learned.score(texts)
    assert scores[0] > scores[1]


def test_grammar_composes_clauses():
    import pyarrow as pa

    plain = toxicity.fit([], {0: 1, 1: 1})
    texts = ["you idiot", "an idiot", "you are not an idiot", "he said you idiot", "not. idiot", "i will kill you"]
    direct, bare, negated, reported, apart, threat = plain.features(pa.array(texts))[:, 1]
    assert direct > bare > negated and reported < direct and apart == bare and threat > 0
    assert plain.features(pa.array(["kill the process", "", None]))[:, 1].tolist() == [0, 0, 0]


def plain_clause_score(clause):
    """Score of a list of (class, weight), from positions alone."""
    near, found = toxicity.NEAR, 0.0
    at = {c: [k for k, (x, _) in enumerate(clause) if x == c] for c in transducers.CLASSES}

    def factor(k):
        negated = any(k - near <= g < k for g in at[transducers.NEGATION])
        reported = any(r < k for r in at[transducers.REPORT])
        return (toxicity.NEGATED if negated else 1) * (toxicity.REPORTED if reported else 1)

    chains = []
    for k in sorted(at[transducers.INSULT] + at[transducers.TARGET]):
        if chains and k - chains[-1][-1] <= near:
            chains[-1].append(k)
        else:
            chains.append([k])
    for chain in chains:
        aimed = any(k in at[transducers.TARGET] for k in chain)
        for k in set(chain) - set(at[transducers.TARGET]):
            found += clause[k][1] * factor(k) * (toxicity.TARGETED if aimed else toxicity.BARE)
    for k in at[transducers.THREAT]:
        after = [x for x in sorted(at[transducers.THREAT] + at[transducers.TARGET]) if x > k]
        last = k
        while after and after[0] - last <= near:
            if after[0] in at[transducers.TARGET]:
                found += toxicity.THREAT_WEIGHT * factor(k)
                break
            last = after.pop(0)
    return found


def test_composed_grammar_equals_plain_positions():
    rng = np.random.default_rng(3)
    clauses = [[(c, 1.0) for c in cs] for n in range(1, 5) for cs in itertools.product(transducers.CLASSES, repeat=n)]
    shares = [0.5, 0.15, 0.1, 0.1, 0.1, 0.05]
    for _ in range(1500):
        n = rng.integers(1, 40)
        symbols = rng.choice(transducers.CLASSES, n, p=shares)
        clauses.append([(int(c), float(w) if c == transducers.INSULT else 1.0) for c, w in zip(symbols, rng.random(n))])
    flat = [x for c in clauses for x in c]
    number = np.repeat(np.arange(len(clauses)), [len(c) for c in clauses])
    heads, scores = toxicity.clause_scores(np.array([c for c, _ in flat]), np.array([w for _, w in flat]), number)
    got = np.zeros(len(clauses))
    got[number[heads]] = scores
    assert got == pytest.approx([plain_clause_score(c) for c in clauses])
    # All pairs of states but those in which two different words would stand at one place.
    assert [t.states for t in toxicity.GRAMMAR] == [2 * (5 * 9 - 8), 2 * (5 * 5 - 4)]


def test_factors_compose():
    once = transducers.reported_speech(0.5)
    twice = transducers.Table(transducers.compose(once, transducers.compose(once, transducers.insults(2.0, 1.0, 3))))
    words = np.array([transducers.REPORT, transducers.INSULT, transducers.INSULT])
    # The first mapper takes the report away, so the second never sees it.
    assert twice.run(words, np.array([1.0, 4.0, 4.0]), np.array([0, 3])).tolist() == [4.0]
    assert twice.run(words[:0], np.zeros(0), np.zeros(1, int)).tolist() == []


def test_toxicity_without_labels(ready, make_docs):
    labels = ready.createDataFrame([], "doc_id bigint, toxic int")
    found = toxicity.toxicity_report(make_docs([(1, "you idiot, you moron"), (2, "good day")]), labels)
    assert {r["doc_id"]: r["predicted"] for r in found.collect()} == {1: 1, 2: 0}


def test_held_out_toxic_labels_change_nothing(given, ready, sf_dir):
    labels = ready.read.parquet(f"{sf_dir}/labels.parquet")
    flipped = labels.withColumn(
        "toxic",
        F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")),
    )
    first, second = (
        {r["doc_id"]: r["score"] for r in toxicity.toxicity_report(given, x).collect()} for x in (labels, flipped)
    )
    assert first == second


# -- pages -------------------------------------------------------------------------


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<nav>a</nav><footer>b</footer>", ""),
        ("<article><h1>T</h1><p>a &lt;b&gt;&nbsp; c<br>d</p></article><p>out</p>", "T\na <b> c\nd"),
        ("<main><div class='x-ads'>ad</div><p>x <b>y</b>\n z</p><!-- <p>no</p> --></main>", "x y z"),
        ("<article><p>a</p><section id=comments><p>c</p></section><form>f</form></article>", "a"),
        ("<article><header><h1>H</h1></header><p>1 < 2</p><aside>s</aside></article>", "H\n1 < 2"),
        ("<nav>menu <article><p>open nav</p></article>", "open nav"),
        ("<article><script>var a='</p>';</script><p>t</p><style>p{}", "t"),
        ("<article><p title='a > b'>q</p><p>&amp;lt; &#233;&am", "q\n&lt; é&am"),
        ("<article><p>İ dotted</p><SCRIPT>x</SCRIPT><p>after</p></article>", "İ dotted\nafter"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("""<article><p title="it's">Text don't</p><p>more</p></article>""", "Text don't\nmore"),
        ("""<article><p title='say "hi'>one</p><p>"two"</p></article>""", 'one\n"two"'),
        (f"<article><div data-x='{'<b>x</b>' * 20}'>text</div></article>", "text"),
        ("""<article><p data-x="a hidden place" data_1="class=ad">text</p></article>""", "text"),
        ("<article><p don't>one</p><p title=\"open>two</p></article>", "one\ntwo"),
    ],
)
def test_tags_end_outside_quotes(page, text):
    assert html_text.main_text(page) == text


def test_text_surges_without_an_article():
    body = "word " * 60
    page = (
        "<body><header>Site</header><ul><li><a href=1>One</a><li><a href=2>Two</a></ul>"
        f"<div role='alert'>Note</div><p>{body}</p><p>Short.</p><p>{body}</p>"
        "<ul><li><a href=3>Three</a></ul><div class='reader-comments'><p>" + body + "</p></div></body>"
    )
    assert html_text.main_text(page) == f"{body.strip()}\nShort.\n{body.strip()}"


BODY = " ".join(["word"] * 80)
ITEMS = "".join(f"<li><a href=/{k}>Link {k}</a>" for k in range(5))


@pytest.mark.parametrize(
    "page, text",
    [
        # Comments and teasers marked up as articles.
        (f"<article><p>t</p><article class=comment><p>{BODY}</p></article><p>u</p></article>", "t\nu"),
        (f"<article><p>t</p></article><aside><article><p>{BODY}</p></article></aside>", "t"),
        (f"<article><p>t</p><div id=comments><article><h1>c</h1><p>{BODY}</p></article></div></article>", "t"),
        (f"<main><p>t</p><article role=complementary><p>{BODY}</p></article></main>", "t"),
        ("<article class='post category-social has-sidebar'><p>t</p></article>", "t"),
        # Link sums decide inside the element, windows outside it.
        (f"<article><h1><a href=1>Head</a></h1><p>{BODY}</p><ul>{ITEMS}</ul><p>end</p></article>", f"Head\n{BODY}\nend"),
        (f"<article><p>stub</p></article><div><p>{BODY}</p><p>{BODY}</p></div><p>out</p>", f"stub\n{BODY}\n{BODY}"),
    ],
)
def test_windows_decide_with_an_article(page, text):
    assert html_text.main_text(page) == text


def test_pages_keep_every_row(ready, sf_dir):
    pages = ready.read.parquet(f"{sf_dir}/pages.parquet")
    odd = ready.createDataFrame([(None, None, None), (1, "u", "<p>" * 50_000)], "page_id bigint, url string, html string")
    found = html_text.extract_pages(pages.union(odd).union(odd)).collect()
    assert len(found) == pages.count() + 4
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert all(r["text"] for r in found if r["url"] not in (None, "u"))
    assert html_text.extract_pages(odd.limit(0)).count() == 0


# -- pipeline ----------------------------------------------------------------------


def test_pipeline_stages(ready, given, sf_dir):
    import re

    import corpus_pipeline
    from statledger.session import written

    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "dedup", "decontamination", "pii", "mixing"]
    docs = given.union(given.limit(5).withColumn("doc_id", F.col("doc_id") + 10**6)).union(
        ready.createDataFrame([(10**7, "12 34", None, None, 5), (None, None, None, None, None)], given.schema)
    )
    kept = written(docs, "test")
    counts = {}
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = written(stage(ready, before, sf_dir), "test")
        counts[name] = kept.count()
        if name != "mixing":
            assert kept.columns == given.columns
        if name == "dedup":
            expected = plain_components(texts_of(before))
            assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in expected}
        if name == "pii":
            changed = before.select("doc_id", F.col("text").alias("old")).join(kept, "doc_id").collect()
            for r in changed:
                assert not plain_pii(r["text"]) and r["n_chars"] == len(r["text"])
                assert (r["old"] == r["text"]) or re.search("<(EMAIL|IP|CARD|PHONE|ID)>", r["text"])
    assert counts["language"] == docs.count() - 2 > counts["dedup"] > counts["decontamination"] == counts["pii"]
    assert kept.where("mix_taken <= 0 OR mix_taken > 2 * mix_size").count() == 0

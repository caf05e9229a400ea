"""Toxicity by a weighted finite-state grammar over the clauses of a text.

Each word gets a class with a weight: insult, threat, target, negation, reported speech or none. The
lexicon is a short fixed list and, for insults, words and word stems learned from labelled rows. Transducers
(``transducers.py``) for reported speech and negation are composed with one that accepts insults and one that accepts threats;
the two results read each clause, and a clause matches if one of them scores. Insults near a target weigh more, a
threat counts only with a target after it, and what is negated or reported weighs less. A logistic function of the
clause scores, fitted on the same labelled rows, gives the text's score.

An insult without a target is accepted with a lower weight: the labelled texts hold insults that way, and a grammar
that refuses them finds none of those texts.

Words are runs of letters, compared in lower case; clauses end at . ! ? ; : and line breaks. Everything
in a task is a numpy pass over a piece of bounded size. Fitting uses a bounded sample (``samples.py``)
and the class counts of all labelled rows.

Defined cases: a null or empty text, or one without letters, matches nothing and gets the score of a text
without matches. Labels other than 0 and 1 don't train; without both classes the fixed lexicon alone
scores. Equal rows give equal results, one each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statledger.llm.arrays import Words, find_words, pieces, prefixes, text_bytes
from statledger.llm.samples import drawn_rows, fold, gathered
from statledger.llm.transducers import (
    INSULT,
    NEGATION,
    NONE,
    REPORT,
    TARGET,
    THREAT,
    Table,
    compose,
    insults,
    negation,
    reported_speech,
    threats,
)
from statledger.session import written

# Lexicons, for English, German, French and Spanish.
INSULTS = (
    "idiot moron stupid loser pathetic worthless scum trash clown disgusting dumb imbecile "
    "idiota tonto basura idioten dumm blöd abschaum imbécile crétin ordure"
).split()
THREATS = "kill hurt destroy beat burn crush töten schlagen tuer frapper matar golpear".split()
TARGETS = (
    "you your he she him her they them this that people man woman du ihr er sie dich "
    "tu vous il elle ils toi tú usted ellos ella"
).split()
NEGATIONS = "not no never isn wasn aren nicht kein keine nie ne pas jamais nunca jamás".split()
REPORTS = "said says called calls claimed quoted wrote sagte nannte écrit appelé dijo llamó".split()

# Words that a class may reach: a target on either side, a negation before, a target after a threat.
NEAR = 4
# Weights of the arcs.
TARGETED, BARE, NEGATED, REPORTED = 1.25, 1.0, 0.5, 0.6
THREAT_WEIGHT = 2.0
# Stem lengths in bytes; a learned term needs so many toxic texts, such odds, and the best so many are kept.
STEMS = (4, 5, 6, 7, 8)
MIN_TOXIC_TEXTS = 4
MIN_ODDS = 3.6
MAX_TERMS = 20_000

# Sampled texts of a class.
PER_CLASS = 2000
# Texts whose terms are counted at a time.
MERGED = 200

_NOT_LETTER = np.ones(256, bool)
_NOT_LETTER[97:123] = False
_NOT_LETTER[128:] = False
_CLAUSE_END = np.zeros(256, np.int64)
_CLAUSE_END[[ord(c) for c in ".!?;:\n"]] = 1


def _hashes(words: list[str]) -> np.ndarray:
    return np.sort(find_words(pa.array(words), outside=_NOT_LETTER).hash)


_THREATS, _TARGETS = _hashes(THREATS), _hashes(TARGETS)
_NEGATIONS, _REPORTS = _hashes(NEGATIONS), _hashes(REPORTS)
_SPEECH = compose(reported_speech(REPORTED), negation(NEGATED, NEAR))
GRAMMAR = tuple(
    Table(compose(_SPEECH, last)) for last in (insults(TARGETED, BARE, NEAR), threats(THREAT_WEIGHT, NEAR))
)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def clause_scores(symbols: np.ndarray, weights: np.ndarray, clause: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of the clauses that may match, and their scores; ``clause`` numbers the clause of each word.

    Words without a class only age what came before them, and after ``NEAR`` of them nothing is left to age, so no more are read.
    """
    n = np.arange(len(symbols))
    heads = np.flatnonzero(np.diff(clause, prepend=-1))
    telling = np.add.reduceat((symbols == INSULT) | (symbols == THREAT), heads) > 0
    last = np.maximum.accumulate(np.where(symbols != NONE, n, -1))
    sizes = np.diff(np.append(heads, len(n)))
    head_of = np.repeat(heads, sizes)
    read = np.repeat(telling, sizes) & (last >= head_of) & (n - last <= NEAR)
    kept = np.flatnonzero(read)
    heads = heads[telling]
    first = np.searchsorted(kept, np.append(heads, len(n)))
    return heads, sum(table.run(symbols[kept], weights[kept], first) for table in GRAMMAR)


def _lower(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts, ""))


def _read(texts: pa.Array) -> tuple[pa.Array, Words, np.ndarray]:
    """Lower-case texts, their words, and a clause number for every word."""
    texts = _lower(texts)
    words = find_words(texts, outside=_NOT_LETTER)
    data, at = text_bytes(texts)
    ends = np.cumsum(_CLAUSE_END[data])
    clause = (ends[words.start] if len(words.start) else words.start) + words.text_of
    return texts, words, clause


@dataclass
class Grammar:
    terms: np.ndarray  # sorted hashes of insult words and stems
    weights: np.ndarray
    scale: np.ndarray  # of the features
    slope: np.ndarray
    intercept: float

    def insult_weights(self, texts: pa.Array, words: Words) -> np.ndarray:
        """The weight each word has as an insult: its own or its heaviest stem's."""
        found = np.zeros(len(words.hash))
        if not len(self.terms):
            return found
        for values, at in [
            (words.hash, np.arange(len(words.hash))),
            *[prefixes(texts, words, k) for k in STEMS],
        ]:
            place = np.minimum(np.searchsorted(self.terms, values), len(self.terms) - 1)
            hit = self.terms[place] == values
            found[at[hit]] = np.maximum(found[at[hit]], self.weights[place[hit]])
        return found

    def features(self, texts: pa.Array) -> np.ndarray:
        """Per text: the sum and maximum of clause scores, matched clauses, and their share."""
        texts, words, clause = _read(texts)
        rows = len(texts)
        out = np.zeros((rows, 4))
        if not len(words.hash):
            return out
        insult = self.insult_weights(texts, words)
        symbols = np.full(len(words.hash), NONE)
        for symbol, known in ((REPORT, _REPORTS), (NEGATION, _NEGATIONS), (TARGET, _TARGETS), (THREAT, _THREATS)):
            symbols[_among(words.hash, known)] = symbol
        # What the labels call an insult is one, whatever else the lists say.
        symbols[insult > 0] = INSULT
        heads, scores = clause_scores(symbols, np.where(symbols == INSULT, insult, 1.0), clause)
        owner = words.text_of[heads]
        hit = scores > 0
        out[:, 0] = np.log1p(np.bincount(owner, scores, minlength=rows))
        np.maximum.at(out[:, 1], owner, np.minimum(scores, 12))
        matched = np.bincount(owner[hit], minlength=rows)
        out[:, 2] = np.log1p(matched)
        out[:, 3] = np.minimum(100 * matched / np.maximum(words.counts, 1), 10)
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        x = self.features(texts) * self.scale @ self.slope + self.intercept
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _terms(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct words and stems of every text, as hashes."""
    texts = _lower(texts)
    words = find_words(texts, outside=_NOT_LETTER)
    owner = words.text_of
    values = [(words.hash, np.arange(len(words.hash)))] + [prefixes(texts, words, k) for k in STEMS]
    every = np.concatenate([v for v, _ in values])
    owners = np.concatenate([owner[at] for _, at in values])
    order = np.argsort(owners, kind="stable")
    bounds = np.searchsorted(owners[order], np.arange(len(texts) + 1))
    for k in range(len(texts)):
        yield np.unique(every[order[bounds[k] : bounds[k + 1]]])


def _added(terms, counts, new, n) -> tuple[np.ndarray, np.ndarray]:
    """Two lists of terms with counts as one."""
    both, at = np.unique(np.concatenate([terms, new]), return_inverse=True)
    total = np.bincount(at, np.concatenate([counts, n]), minlength=len(both))
    return both, total.astype(np.int64)


def _learn_lexicon(texts: list[str], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms far more frequent in toxic texts than in others, with their log odds as weights."""
    found = [np.zeros(0, np.uint64)] * 2
    counts = [np.zeros(0, np.int64)] * 2
    for side in (0, 1):
        own = np.flatnonzero(toxic == side)
        for start in range(0, len(own), MERGED):
            part = [next(_terms(pa.array([texts[k]]))) for k in own[start : start + MERGED]]
            new, n = np.unique(np.concatenate(part), return_counts=True)
            found[side], counts[side] = _added(found[side], counts[side], new, n)
    terms, n_toxic = found[1], counts[1]
    clean = np.zeros(len(terms))
    if len(found[0]):
        at = np.minimum(np.searchsorted(found[0], terms), len(found[0]) - 1)
        clean = np.where(found[0][at] == terms, counts[0][at], 0)
    odds = np.log((n_toxic + 0.1) / (toxic.sum() + 0.2))
    odds -= np.log((clean + 0.5) / ((1 - toxic).sum() + 1))
    kept = np.flatnonzero((n_toxic >= MIN_TOXIC_TEXTS) & (odds >= MIN_ODDS))
    kept = kept[np.lexsort((terms[kept], -odds[kept]))][:MAX_TERMS]
    order = np.argsort(terms[kept])
    return terms[kept][order], odds[kept][order]


def _with_fixed(terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    fixed = _hashes(INSULTS)
    new = fixed[~_among(fixed, terms)]
    every = np.concatenate([terms, new])
    order = np.argsort(every)
    return every[order], np.concatenate([weights, np.full(len(new), MIN_ODDS)])[order]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton's steps."""
    a = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(a.shape[1])
    ridge = np.diag([0.01] * x.shape[1] + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (weight * (p - y)) / weight.sum() + ridge @ beta
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a / weight.sum() + ridge
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return beta[:-1], float(beta[-1])


def fit(sample: list[tuple[str, int]], counts: dict[int, int]) -> Grammar:
    """Lexicon from one half of the sample, scores from the other, so that chance terms weigh little."""
    texts = [t for t, _ in sample]
    toxic = np.array([y for _, y in sample], np.int64)
    scale = np.ones(4)
    terms, weights = _with_fixed(np.zeros(0, np.uint64), np.zeros(0))
    plain = Grammar(terms, weights, scale, np.array([1.0, 0.5, 1.0, 0.0]), -1.5)
    if len(set(toxic)) < 2:
        return plain
    x = np.zeros((len(texts), 4))
    half = np.arange(len(texts)) // 2 % 2
    for side in (0, 1):
        own = np.flatnonzero(half != side)
        other = np.flatnonzero(half == side)
        learned = _with_fixed(*_learn_lexicon([texts[k] for k in own], toxic[own]))
        grammar = Grammar(*learned, scale, plain.slope, 0.0)
        for k in other:
            x[k] = grammar.features(pa.array([texts[k]]))[0]
    spread = x.std(axis=0)
    scale = np.where(spread > 0, 1 / np.maximum(spread, 1e-9), 0.0)
    taken = np.array([(toxic == 0).sum(), (toxic == 1).sum()])
    weight = np.array([counts[0], counts[1]])[toxic] / taken[toxic]
    slope, intercept = _logistic(x * scale, toxic, weight)
    return Grammar(*_with_fixed(*_learn_lexicon(texts, toxic)), scale, slope, intercept)


def train_grammar(docs: DataFrame, labels: DataFrame, holdout: int | None = 0) -> Grammar:
    """Fitted on labelled rows whose id doesn't hash to ``holdout`` modulo 5."""
    marks = labels.select("doc_id", "toxic").where("toxic IN (0, 1)")
    if holdout is not None:
        marks = marks.where(fold(5) != holdout)
    # Drawn among the labels, so that only drawn texts meet them; stored, so that Spark knows their size.
    drawn = drawn_rows(marks, "toxic", F.xxhash64("doc_id"), PER_CLASS)
    drawn = written(drawn, "toxicity-labels")
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(drawn, "doc_id")
    sample = gathered(rows, "toxic", PER_CLASS)
    counts = {0: 1, 1: 1} | {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    return fit(sample, counts)


def _score(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grammar = Grammar(*shared.value)
    for batch in batches:
        for piece in pieces(batch):
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(grammar.score(piece.column("text")))],
                ["doc_id", "score"],
            )


def score_toxicity(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """``(doc_id, score)`` of every row."""
    parts = (grammar.terms, grammar.weights, grammar.scale, grammar.slope, grammar.intercept)
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    scorer = partial(_score, shared)
    return docs.select("doc_id", "text").mapInArrow(scorer, "doc_id bigint, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = score_toxicity(docs, train_grammar(docs, labels))
    return found.select(
        "doc_id",
        (fold(5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )

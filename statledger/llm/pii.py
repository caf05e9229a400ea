"""Personal data: fixed patterns plus bootstrapped contextual extraction.

1. *Seeds.* Spans of the fixed kinds (email, ip, card, phone). Each mention induces lexical
   patterns from the words before it: the last word, and the last two.
2. *Candidates.* Tokens shaped like identifiers that no fixed kind covers; groups of digits set apart by
   single spaces are one candidate.
3. *Corpus counts.* How often each induced pattern's words occur at all, over the whole corpus. The
   patterns are looked up through a bitmap of fixed size, so nothing that grows is broadcast.
4. *Scoring.* Spark scores the pattern-instance graph in turns: a pattern is trusted as far as
   its occurrences lead to trusted instances, an instance as far as its best patterns are trusted. Seeds
   keep 1. A pattern takes part once enough trusted instances follow it, so what one round trusts
   brings new patterns into the next, which may have no seed of their own.
5. *Discovery.* Candidates after a pattern of high confidence become spans of kind ``id``.

Ordinary words are followed by an identifier rarely, so their confidence is near 0, however
often seeds follow them. A word of more than 80 characters is no pattern. Defined cases: a null text is empty; rows are told apart by a row number, so
equal rows and null or repeated ids give one result each; an empty table gives an empty result;
other columns are ignored. Memory follows one piece of text at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statledger.llm.arrays import SMALL_PIECE, find_words, pieces, runs
from statledger.llm.columns import fresh_name, with_row, with_text_keys
from statledger.llm.lookup import bitmap, marked, perhaps_in, without
from statledger.llm.spans import PII_KINDS, count_kind, pii_spans, span_text
from statledger.session import written

BASE_KINDS = 4
# A pattern needs so many distinct trusted instances, and trust or a discovery so much confidence.
MIN_SEEDS = 5
MIN_CONFIDENCE = 0.5
ROUNDS = 3
# Places of the pattern bitmap; its 128 KiB is all that goes to every task.
BITMAP_BITS = 20
# Counts a task holds before it passes them on, 16 bytes each.
MOST_HELD = 1 << 18

_WORD_BEFORE = re.compile(r"[^\x20\x09-\x0D]+")
_TOKEN = re.compile(
    r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
)
_EDGE = "\"'()[]{}<>,;:!?.*#"
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
# What may stand between two groups of one identifier.
_JOINT = re.compile(r"\x20(?:[A-Z]{1,6}\x20)?")
# A longer word is no lexical pattern.
LONGEST_WORD = 80
# Letters and digits of the longest identifier written in groups, an IBAN; longer rows of groups are tables.
LONGEST_RUN = 34

_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_MENTION = pa.struct(
    [
        ("start", pa.int32()),
        ("end", pa.int32()),
        ("seed", pa.bool_()),
        ("instance", pa.string()),
        ("one", pa.string()),
        ("two", pa.string()),
    ]
)
_FOUND = (
    "spans array<struct<start:int,kind:int,end:int>>, "
    "mentions array<struct<start:int,end:int,seed:boolean,instance:string,one:string,two:string>>"
)


def _ascii_lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def _word_before(text: str, end: int) -> tuple[str | None, int]:
    """The last word before ``end`` and where it starts; none if there is none or it is too long."""
    while end and text[end - 1] in _SPACES:
        end -= 1
    before = _WORD_BEFORE.findall(text[max(0, end - LONGEST_WORD - 1) : end])
    if not before or len(before[-1]) > LONGEST_WORD:
        return None, end
    return _ascii_lower(before[-1]), end - len(before[-1])


def _context(text: str, start: int) -> tuple[str | None, str | None]:
    """The word before a mention, and the last two."""
    last, at = _word_before(text, start)
    first = _word_before(text, at)[0] if last else None
    return last, (f"{first} {last}" if first else None)


def _tokens(text: str, spans: list) -> Iterator[tuple[int, int]]:
    """Tokens with a digit or an @ outside the spans, without the punctuation around them."""
    k = 0
    for m in _TOKEN.finditer(text):
        while k < len(spans) and spans[k][2] <= m.start():
            k += 1
        if k < len(spans) and spans[k][0] < m.end():
            continue
        token = m[0].strip(_EDGE)
        start = m.start() + m[0].index(token)
        yield start, start + len(token)


def _candidates(text: str, spans: list) -> list[tuple[int, int]]:
    """Identifier-shaped tokens, and rows of digit groups, outside the spans.

    Groups hold no lower-case letters and belong together if a single space, or one short word in capitals, is all
    between them. A row with more letters and digits than the longest identifier is a table, and each of its
    tokens counts alone.
    """
    found: list[tuple[int, int]] = []
    run: list[tuple[int, int]] = []

    def close() -> None:
        whole = [(run[0][0], run[-1][1])]
        long = run[-1][1] - run[0][0] > 2 * LONGEST_RUN
        if long or sum(c.isalnum() for c in text[whole[0][0] : whole[0][1]]) > LONGEST_RUN:
            whole = run
        found.extend(t for t in whole if _is_identifier(text[t[0] : t[1]]))

    for token in _tokens(text, spans):
        if run and not _joined(text, run[-1], token):
            close()
            run = []
        run.append(token)
    if run:
        close()
    return found


def _joined(text: str, left: tuple[int, int], right: tuple[int, int]) -> bool:
    apart = right[0] - left[1]
    if not 1 <= apart <= 8 or not _JOINT.fullmatch(text, left[1], right[0]):
        return False
    return _is_group(text[left[0] : left[1]]) and _is_group(text[right[0] : right[1]])


def _is_group(token: str) -> bool:
    return "@" not in token and token == token.upper()


def _is_identifier(token: str) -> bool:
    return sum(c.isdigit() for c in token) >= 4 or ("@" in token and len(token) > 4)


def _read(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans and mentions of texts, with the columns ``names``."""
    for batch in batches:
        for piece in pieces(batch, size=SMALL_PIECE):
            spans, mentions = [], []
            for text in piece.column("text").to_pylist():
                text = text or ""
                base = pii_spans(text)
                own = [(s, e, True) for s, _, e in base]
                own += [(s, e, False) for s, e in _candidates(text, base)]
                spans.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                mentions.append([_mention(text, *m) for m in own])
            yield pa.RecordBatch.from_arrays(
                [
                    *[piece.column(n) for n in names],
                    pa.array(spans, pa.list_(_SPAN)),
                    pa.array(mentions, pa.list_(_MENTION)),
                ],
                [*names, "spans", "mentions"],
            )


def _mention(text: str, start: int, end: int, seed: bool) -> dict:
    one, two = _context(text, start)
    return {
        "start": start,
        "end": end,
        "seed": seed,
        "instance": text[start:end],
        "one": one,
        "two": two,
    }


def _pattern_keys(patterns: pa.Array) -> np.ndarray:
    """The hash under which the corpus count finds a pattern of one or two words."""
    words = find_words(patterns, lower=True)
    keys = np.zeros(len(patterns), np.uint64)
    one = np.flatnonzero(words.counts == 1)
    keys[one] = words.hash[words.first[one]]
    pairs, at = runs(words, 2)
    keys[words.text_of[at]] = pairs
    return keys


def _with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _pattern_keys(batch.column("pattern")).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("pattern"), pa.array(keys)], ["pattern", "key"]
        )


def _count(marks: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of words and word pairs whose hash has its mark, summed per task as far as they fit."""
    held, size = [], 0
    for batch in batches:
        for piece in pieces(batch, size=SMALL_PIECE):
            words = find_words(piece.column("text"), lower=True)
            keys = np.concatenate([words.hash, runs(words, 2)[0]])
            held.append(np.unique(keys[marked(marks, keys)], return_counts=True))
            size += len(held[-1][0])
            if size > MOST_HELD:
                held = [_summed(held)]
                size = len(held[0][0])
                # Still many after the sum: different keys, which Spark has to bring together.
                if size > MOST_HELD // 2:
                    yield _counted(held.pop())
                    size = 0
    if held:
        yield _counted(_summed(held))


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, place, np.concatenate([n for _, n in held]))
    return keys, sums


def _counted(sums: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    keys, counts = sums
    return pa.RecordBatch.from_arrays(
        [pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], ["key", "n"]
    )


def read_mentions(rows: DataFrame) -> DataFrame:
    """Base spans of every row, and its mentions with their contexts, stored once with all columns but the text."""
    others = rows.drop("text")
    kinds = ", ".join(f"{name} {kind}" for name, kind in others.dtypes)
    return written(rows.mapInArrow(partial(_read, others.columns), f"{kinds}, {_FOUND}"), "pii-mentions")


def score_patterns(docs: DataFrame, read: DataFrame) -> DataFrame:
    """``(pattern, confidence)`` of the patterns that enough distinct trusted instances induce.

    The corpus is counted once for the patterns that seeds induce, and again only after a round that brings new ones.
    """
    links = read.select(F.explode("mentions").alias("m")).select(
        "m.instance", "m.seed", F.explode(F.array("m.one", "m.two")).alias("pattern")
    )
    edges = written(
        links.where("pattern IS NOT NULL")
        .groupBy("pattern", "instance")
        .agg(F.count("*").alias("n"), F.max("seed").alias("seed")),
        "pii-edges",
    )
    trusted = edges.where("seed").withColumn("trust", F.lit(1.0))
    asked = written(_induced(trusted), "pii-patterns")
    known = _totals(docs, asked)
    for _ in range(ROUNDS):
        patterns = written(_confidence(trusted, known), "pii-confidence")
        best = (
            edges.join(patterns, "pattern").groupBy("instance").agg(F.max("confidence").alias("best"))
        )
        trust = F.when(F.col("seed"), F.lit(1.0)).otherwise(F.col("best"))
        trusted = written(
            edges.join(best, "instance", "left").withColumn("trust", trust).where("trust > 0").drop("best"),
            "pii-trusted",
        )
        new = written(_induced(trusted).join(asked, "pattern", "left_anti"), "pii-patterns")
        if not new.isEmpty():
            asked = asked.unionByName(new)
            known = known.unionByName(_totals(docs, new))
    return _confidence(trusted, known)


def _induced(trusted: DataFrame) -> DataFrame:
    """Patterns that enough distinct instances of enough trust follow."""
    instances = F.count_if(F.col("trust") >= MIN_CONFIDENCE).alias("instances")
    return trusted.groupBy("pattern").agg(instances).where(F.col("instances") >= MIN_SEEDS).select("pattern")


def _totals(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """``(pattern, total)``: how often the words of each pattern occur in the corpus."""
    keyed = written(patterns.mapInArrow(_with_keys, "pattern string, key bigint"), "pii-keys")
    counter = partial(_count, bitmap(keyed.select("key"), BITMAP_BITS))
    counts = docs.select("text").mapInArrow(counter, "key bigint, n bigint")
    total = counts.groupBy("key").agg(F.sum("n").alias("total"))
    return written(keyed.join(total, "key").select("pattern", "total"), "pii-totals")


def _confidence(trusted: DataFrame, known: DataFrame) -> DataFrame:
    """Trusted mentions over all occurrences of a pattern, with one occurrence held against it."""
    mentions = trusted.groupBy("pattern").agg(F.sum(F.col("n") * F.col("trust")).alias("mentions"))
    return mentions.join(known, "pattern").select(
        "pattern", (F.col("mentions") / (F.col("total") + 1)).alias("confidence")
    )


def find_pii(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, spans)`` of every row, with a number that is stored."""
    return find_in_rows(with_row(docs, "doc_id", "text"))


def find_in_rows(rows: DataFrame) -> DataFrame:
    """The columns of ``rows`` but the text, which is replaced by ``spans``: (start, kind number, end), discovered ones included.

    ``row`` is a number of each row's own. It is stored with what is read, and holds for that alone.
    """
    read = read_mentions(rows)
    trusted = score_patterns(rows, read).where(F.col("confidence") >= MIN_CONFIDENCE)
    unknown = (
        read.select("row", F.explode("mentions").alias("m"))
        .where("NOT m.seed")
        .select("row", "m.start", "m.end", F.explode(F.array("m.one", "m.two")).alias("pattern"))
    )
    found = (
        unknown.join(trusted.select("pattern"), "pattern")
        .select("row", F.struct("start", F.lit(BASE_KINDS).alias("kind"), "end").alias("span"))
        .groupBy("row")
        .agg(F.collect_set("span").alias("more"))
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return read.join(found, "row", "left").select(
        *rows.drop("text").columns, F.concat("spans", F.coalesce("more", none)).alias("spans")
    )


def pii_report(docs: DataFrame) -> DataFrame:
    """Digest columns of every row."""
    base = F.filter("spans", lambda s: s["kind"] < BASE_KINDS)
    return find_pii(docs).select(
        "doc_id",
        *[count_kind(F.col("spans"), k).alias(f"n_{PII_KINDS[k]}") for k in range(BASE_KINDS)],
        F.sha2(span_text(base, PII_KINDS), 256).alias("base_sha256"),
        span_text(F.col("spans"), PII_KINDS).alias("spans"),
        count_kind(F.col("spans"), BASE_KINDS).alias("n_discovered"),
    )


def _mask(names: list[str], spans: str, batches) -> Iterator[pa.RecordBatch]:
    """Batches with the columns ``names``, texts masked at the spans in the column ``spans``."""
    for batch in batches:
        for piece in pieces(batch, size=SMALL_PIECE):
            found = piece.column(spans).to_pylist()
            texts = piece.column("text").to_pylist()
            masked = [mask_all(t or "", s) for t, s in zip(texts, found, strict=True)]
            columns = {n: piece.column(n) for n in names} | {"text": pa.array(masked, pa.string())}
            if "n_chars" in columns:
                columns["n_chars"] = pa.array(
                    [len(t) for t in masked], piece.column("n_chars").type
                )
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)


def mask_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced by its kind, and ``n_chars``, if there, brought in line.

    Equal texts have equal spans, so texts are not stored but found again by content. Only texts with spans, and the
    few that share their bitmap mark, are shuffled.
    """
    texts = with_text_keys(docs.select("text"))[0].withColumn("row", F.monotonically_increasing_id())
    found = find_in_rows(texts).where(F.size("spans") > 0).dropDuplicates(["digest"])
    hits = written(found.select("text_key", "digest", "spans"), "pii-hits")
    rows, keys = with_text_keys(docs)
    hit, spans = fresh_name(rows, "hit"), fresh_name(rows, "spans")
    known = hits.select(F.col("digest").alias(hit), F.col("spans").alias(spans))
    near = perhaps_in(rows, keys[0], hits.select("text_key")).join(known, F.col(keys[1]) == F.col(hit))
    masked = near.mapInArrow(partial(_mask, docs.columns, spans), docs.schema)
    others = without(rows, keys, hits.select("text_key", "digest"))
    return masked.unionByName(others.select(*docs.columns))


def mask_all(text: str, spans: list[dict]) -> str:
    """``text`` masked at the spans, and then at whatever matches only since its neighbours are masked."""
    while spans:
        text = mask_text(text, spans)
        spans = [{"start": s, "kind": k, "end": e} for s, k, e in pii_spans(text)]
    return text


def mask_text(text: str, spans: list[dict]) -> str:
    """``text`` with every span replaced by its kind; overlapping spans are masked as one."""
    out, done = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if span["end"] <= done:
            continue
        if span["start"] >= done:
            out += [text[done : span["start"]], f"<{PII_KINDS[span['kind']].upper()}>"]
        done = span["end"]
    return "".join([*out, text[done:]])

"""Exact Jaccard join of word-shingle sets by size-banded tiles and bitmap signatures.

Two texts link when their sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

1. *Classes.* Texts with one shingle set form a class, found by a 128-bit hash of the set; from here on a
   class is represented by one text, so copies never meet.
2. *Prefixes.* Shingles are ordered, frequent ones last, by a count-min sketch of fixed size over all texts.
   Linked texts share a shingle among the first fifth of their orders, whatever the order is; only
   those are shuffled.
3. *Linking rounds.* In each bucket of a shingle and a size band every text names one leader, first the least text, later
   others by a hash. It is compared with the one it names most often. A round costs one comparison a text, however
   large a group of near copies is; rounds go on while they close buckets that would cost many comparisons.
4. *Tiles.* Buckets that still hold several components are merged where they hold the same texts, and cut into tiles by size
   band and hash. Tiles of neighbouring bands are compared: places in the orders bound the overlap from above, and so
   do two parity bitmaps, whose differing bits are at most the differing shingles. Out come the possible pairs that connect
   texts, fewer than the tiles have texts. In buckets of a few texts the places alone decide.
5. *Exact comparison.* Texts that possible pairs connect form a cluster, which is cut into tiles again and compared there, so that a
   text is sent once and not for each bucket. Sorted arrays of shingle hashes are intersected for possible pairs that are not
   joined yet, and a pair of tiles returns the links that join something, again fewer than it has texts.

Pairs within a component are not all made, since only components and membership are returned; no link
between components is lost.

Defined cases: a null text, or one without words, has no shingle, links with nothing and is its own
component; fewer than five words are one shingle. Equal rows are one class. A null doc_id is the largest, so
a component's id is null only if all its ids are. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statledger.llm.arrays import SMALL_PIECE, Words, find_words, mix, pieces, runs
from statledger.llm.columns import fresh_name
from statledger.llm.components import components
from statledger.llm.lookup import perhaps_in, without
from statledger.session import written

SHINGLE = 5
# Similarity as a percentage; everything that follows from it is computed with whole numbers.
PERCENT = 80
# Count-min sketch of shingles: cells and blocks it is merged in. Four bytes a cell.
CELL_BITS = 20
BLOCK_BITS = 14
# Shingles estimated at less than this many times the mean cell are alike in order.
COMMON = 4
# Rows of a tile, whose pairs of tiles each send a row again, and of one run of comparisons with the same text.
TILE = 1024
RUN = 256
# Texts of a bucket whose pairs are made without bitmaps, at most this number squared and halved.
FEW = 8
# Another linking round follows while an open text has more possible partners than this, and the last round cut them by a fifth.
PARTNERS = 512
# Parts a component's nodes are dealt to when its least id is looked up.
SALTS = 32
SIGNATURE_BITS = (64, 1 << 14)


def shingle_sets(words: Words) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    values, at = runs(words, SHINGLE)
    owner = words.text_of[at] if len(at) else at
    bounds = np.searchsorted(owner, np.arange(len(words.first)))
    found = []
    for k, n in enumerate(words.counts):
        if n >= SHINGLE:
            found.append(np.unique(values[bounds[k] : bounds[k + 1]]))
        elif n:
            with np.errstate(over="ignore"):
                own = words.hash[words.first[k] : words.first[k] + n]
                step = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                found.append(mix(np.array([np.sum(mix(own + step)) + np.uint64(n)], np.uint64)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def _cells(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - CELL_BITS)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << CELL_BITS, np.uint32)
    for batch in batches:
        for piece in pieces(batch, size=SMALL_PIECE):
            sets = shingle_sets(find_words(piece.column("text"), lower=True))
            counts += np.bincount(
                _cells(np.concatenate(sets)).astype(np.int64), minlength=len(counts)
            ).astype(np.uint32)
    size = 1 << BLOCK_BITS
    for k in range(1 << (CELL_BITS - BLOCK_BITS)):
        part = counts[k * size : (k + 1) * size]
        if part.any():
            yield _block(k, part)


def _block(number: int, counts: np.ndarray) -> pa.RecordBatch:
    packed = zlib.compress(counts.astype(np.uint64).tobytes(), 1)
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int32()), pa.array([packed], pa.binary())], ["block", "counts"]
    )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    merged: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(
            batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True
        ):
            new = np.frombuffer(zlib.decompress(packed), np.uint64)
            merged[block] = merged[block] + new if block in merged else new
    for block, counts in merged.items():
        yield _block(block, counts)


def frequency_classes(docs: DataFrame) -> np.ndarray:
    """For each sketch cell 0, or how many times its count doubles the usual: a number below 64."""
    schema = "block int, counts binary"
    parts = docs.select("text").mapInArrow(_sketch, schema)
    merged = parts.repartition(1 << (CELL_BITS - BLOCK_BITS), "block").mapInArrow(_merge, schema)
    counts = np.zeros(1 << CELL_BITS, np.uint64)
    size = 1 << BLOCK_BITS
    for row in merged.collect():
        k = row["block"]
        counts[k * size : (k + 1) * size] = np.frombuffer(zlib.decompress(row["counts"]), np.uint64)
    usual = COMMON * max(float(counts.mean()), 1.0)
    return np.maximum(0, np.ceil(np.log2(np.maximum(counts, 1) / usual))).astype(np.uint8)


def signature(shingles: np.ndarray) -> bytes:
    """Parity bitmap with at least two bits a shingle: bits that differ need a differing shingle."""
    low, high = SIGNATURE_BITS
    bits = min(high, max(low, 1 << int(2 * max(len(shingles), 1) - 1).bit_length()))
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(sig: bytes, size: int) -> np.ndarray:
    """A bitmap folded to ``size`` bytes; parity bits of merged places add up."""
    return np.bitwise_xor.reduce(np.frombuffer(sig, np.uint64).reshape(-1, size // 8), axis=0)


_FEATURES = (
    "row bigint, doc_id bigint, text_key bigint, text_bytes bigint, id_key bigint, n_shingles bigint, h1 bigint, h2 bigint, "
    "prefix array<bigint>, signature binary"
)
# What tells a text that is read again, whatever the splits of that scan are.
CONTENT = ("text_key", "text_bytes", "id_key")


def _features(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    classes = shared.value
    for batch in batches:
        for piece in pieces(batch, size=SMALL_PIECE):
            sets = shingle_sets(find_words(piece.column("text"), lower=True))
            with np.errstate(over="ignore"):
                h1 = [int(np.sum(mix(s)).view(np.int64)) for s in sets]
                h2 = [int(np.sum(mix(s ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64)) for s in sets]
            prefixes = [_prefix(s, classes) for s in sets]
            offsets = np.append(0, np.cumsum([len(p) for p in prefixes])).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("row"),
                    *[piece.column(c) for c in ("doc_id", *CONTENT)],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(h1, pa.int64()),
                    pa.array(h2, pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(offsets), pa.array(np.concatenate(prefixes).view(np.int64))
                    ),
                    pa.array([signature(s) for s in sets], pa.binary()),
                ],
                [c.split()[0] for c in _FEATURES.split(", ")],
            )


def _prefix(shingles: np.ndarray, classes: np.ndarray) -> np.ndarray:
    n = len(shingles)
    if not n:
        return shingles
    length = n - -(-PERCENT * n // 100) + 1
    order = np.lexsort((shingles, classes[_cells(shingles)]))
    return shingles[order[:length]]


def _linked(inter: int, a: int, b: int) -> bool:
    return 100 * inter >= PERCENT * (a + b - inter)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, run), the text to compare with first; yields the linked pairs."""
    current, key = None, None
    for batch in batches:
        for piece in pieces(batch, size=SMALL_PIECE):
            sets = shingle_sets(find_words(piece.column("text"), lower=True))
            first, second = [], []
            columns = [piece.column(n).to_pylist() for n in ("a", "run", "b", "main")]
            for own, a, run, b, main in zip(sets, *columns, strict=True):
                if main:
                    current, key = own, (a, run)
                elif key == (a, run):
                    inter = len(np.intersect1d(current, own, assume_unique=True))
                    if _linked(inter, len(current), len(own)):
                        first.append(a)
                        second.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(first, pa.int64()), pa.array(second, pa.int64())], ["a", "b"]
            )


def _content() -> list[Column]:
    """The values of ``CONTENT``."""
    return [
        F.xxhash64(F.coalesce("text", F.lit(""))),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"),
        F.xxhash64("doc_id"),  # of a null id too, so that plain equality finds it
    ]


def with_content(docs: DataFrame) -> DataFrame:
    """doc_id and text with what tells the text, and a row number to be stored with the features.

    Such a number depends on how a scan is split, so texts that are read again are found by content.
    """
    content = [value.alias(name) for name, value in zip(CONTENT, _content(), strict=True)]
    return docs.select("doc_id", "text", *content, F.monotonically_increasing_id().alias("row"))


def with_texts(wanted: DataFrame, row: str, feats: DataFrame, rows: DataFrame) -> DataFrame:
    """``wanted`` with the texts of the rows it names in ``row``; few other texts are shuffled."""
    named = written(wanted.join(feats.select(F.col("row").alias(row), *CONTENT), row), "jaccard-wanted")
    near = perhaps_in(rows.select(*CONTENT, "text"), "text_key", named.select("text_key").distinct())
    # Equal rows count once. The join finds the texts dealt as the grouping leaves them.
    texts = near.groupBy(*CONTENT).agg(F.first("text").alias("text"))
    return texts.join(named.hint("shuffle_hash"), list(CONTENT)).select(*wanted.columns, "text")


def verified(pairs: DataFrame, feats: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of row numbers whose texts link, by exact intersection.

    The texts to compare with one text are cut into runs of bounded length, each
    with a copy of that text, so that a text in many pairs keeps no task busy alone.
    """
    counted = pairs.groupBy("a").agg(F.count("*").alias("pairs"))
    others = pairs.join(counted, "a").select(
        "a",
        F.pmod(F.xxhash64("b"), F.ceil(F.col("pairs") / RUN)).alias("run"),
        "b",
        F.lit(False).alias("main"),
    )
    mains = counted.select(
        "a",
        F.explode(F.sequence(F.lit(0), F.ceil(F.col("pairs") / RUN) - 1)).alias("run"),
        F.col("a").alias("b"),
        F.lit(True).alias("main"),
    )
    dealt = (
        with_texts(others.union(mains), "b", feats, rows)
        .select("a", "run", "b", "main", "text")
        .repartition("a", "run")
        .sortWithinPartitions("a", "run", F.desc("main"))
    )
    return dealt.mapInArrow(_compare, "a bigint, b bigint")


def _first_pairs(buckets: DataFrame) -> DataFrame:
    """Each text with the text that its buckets name most often."""
    named = (
        buckets.where(F.col("least") < F.col("row"))
        .groupBy("row", "least")
        .agg(F.count("*").alias("n"))
    )
    best = F.max_by("least", F.struct("n", -F.col("least")))
    return named.groupBy("row").agg(best.alias("a")).select("a", F.col("row").alias("b"))


def _band(size: Column) -> Column:
    """Sizes of linked texts differ by less than one band."""
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(100 / PERCENT)))


def _open_rows(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """Entries of buckets with several components; of buckets with the same texts only one stays.

    The place is then the least of a text's places in them, which leaves the bound of the overlap one.
    """
    known = buckets.join(found.withColumnRenamed("node", "row"), "row", "left").withColumn(
        "component", F.coalesce("component", "row")
    )
    content = [
        F.count("*").alias("size"),
        F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("total"),
        F.bit_xor(F.xxhash64("row", F.lit(1))).alias("mixed"),
    ]
    tokens = written(
        known.groupBy("token")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), *content)
        .where("low < high")
        .drop("low", "high"),
        "jaccard-tokens",
    )
    same = ["size", "total", "mixed"]
    named = tokens.join(tokens.groupBy(*same).agg(F.min("token").alias("bucket")), same)
    return written(
        known.join(named.select("token", "bucket", "size"), "token")
        .groupBy(F.col("bucket").alias("token"), "row", "n_shingles", "component", "size")
        .agg(F.min("place").alias("place")),
        "jaccard-open",
    )


def _leader_pairs(open_rows: DataFrame, number: int) -> DataFrame:
    """Each open text with the leader of another component that its buckets name most often."""
    entries = open_rows.withColumn("band", _band(F.col("n_shingles")))
    least = F.min_by("row", F.xxhash64("row", F.lit(number)))
    leaders = entries.groupBy("token", "band").agg(
        least.alias("least"), F.min_by("component", F.xxhash64("row", F.lit(number))).alias("leads")
    )
    named = entries.join(leaders, ["token", "band"]).where("component <> leads")
    voted = named.groupBy("row", "least").agg(F.count("*").alias("n")).groupBy("row")
    best = voted.agg(F.max_by("least", F.struct("n", -F.col("least"))).alias("other"))
    return best.select(F.least("row", "other").alias("a"), F.greatest("row", "other").alias("b")).distinct()


def _few_pairs(open_rows: DataFrame) -> DataFrame:
    """Pairs of small buckets that components, sizes and places leave possible."""
    few = open_rows.where(F.col("size") <= FEW)
    a, b = few.alias("a"), few.alias("b")
    sizes = F.col("a.n_shingles") + F.col("b.n_shingles")
    overlap = F.least(
        F.col("a.n_shingles") - F.col("a.place"), F.col("b.n_shingles") - F.col("b.place")
    )
    possible = (
        (F.col("a.token") == F.col("b.token"))
        & (F.col("a.row") < F.col("b.row"))
        & (F.col("a.component") != F.col("b.component"))
        & (100 * overlap >= PERCENT * (sizes - overlap))
    )
    return a.join(b, possible).select(F.col("a.row").alias("a"), F.col("b.row").alias("b"))


def _tiled(entries: DataFrame) -> DataFrame:
    """Entries ``(token, row, n_shingles, component, place, size)``, once for each pair of tiles to compare.

    Tiles are numbered by band and, in it, by a hash of the row. Bands that link are equal or next to each other. A bucket
    that fits in a tile is one.
    """
    whole = F.col("size") <= TILE
    entries = entries.withColumn("band", F.when(whole, F.lit(0)).otherwise(_band(F.col("n_shingles"))))
    counts = entries.groupBy("token", "band").agg(F.count("*").alias("n"))
    tiles = F.ceil(F.col("n") / TILE)
    bands = counts.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct("band", tiles))).alias("tiles"))

    def number(band: Column, k: Column) -> Column:
        return F.shiftleft(band, 32) + k

    def others(step: int) -> Column:
        n = F.coalesce(F.col("tiles")[F.col("band") + step], F.lit(0).cast("bigint"))
        all_of = F.transform(F.sequence(F.lit(0).cast("bigint"), n), lambda k: number(F.col("band") + step, k))
        return F.slice(all_of, 1, n.cast("int"))

    placed = entries.join(bands, "token").withColumn(
        "tile", number(F.col("band"), F.pmod(F.xxhash64("row"), F.col("tiles")[F.col("band")]))
    )
    paired = placed.withColumn("other", F.explode(F.concat(others(-1), others(0), others(1))))
    return paired.withColumns({"x": F.least("tile", "other"), "y": F.greatest("tile", "other")}).select(*_TILE_COLUMNS)


def _by_tiles(rows: DataFrame) -> DataFrame:
    return rows.repartition("token", "x", "y").sortWithinPartitions("token", "x", "y", "n_shingles", "row")


_TILE_COLUMNS = ("token", "x", "y", "tile", "row", "n_shingles", "component", "place")


class _TilePair:
    """Rows of one pair of tiles, sorted by size."""

    def __init__(self, rows: list[tuple]):
        token, x, y, self.tile, self.row, self.size, self.component, self.place = (
            np.array([r[k] for r in rows]) for k in range(8)
        )
        self.across = bool(len(rows)) and x[0] != y[0]
        self.signatures = [r[8] for r in rows]
        self.lengths = np.array([len(s) for s in self.signatures])

    def later(self, i: int) -> np.ndarray:
        """Rows after ``i`` that sizes, components, tiles, places and bitmaps leave possible as its partners."""
        size, place = self.size, self.place
        # Partners are at least as large, and not more than 100/PERCENT times.
        stop = int(np.searchsorted(size, 100 * size[i] // PERCENT, side="right"))
        js = np.arange(i + 1, max(i + 1, stop))
        js = js[self.component[js] != self.component[i]]
        if self.across:
            js = js[self.tile[js] != self.tile[i]]
        # With this shingle as their first in common, no more can follow it in either order.
        overlap = np.minimum(size[js] - place[js], size[i] - place[i])
        js = js[100 * overlap >= PERCENT * (size[js] + size[i] - overlap)]
        possible = []
        for length in np.unique(self.lengths[js]):
            same = js[self.lengths[js] == length]
            short = int(min(length, self.lengths[i]))
            own = _folded(self.signatures[i], short)
            others = np.stack([_folded(self.signatures[j], short) for j in same])
            differ = np.bitwise_count(others ^ own).sum(axis=1).astype(np.int64)
            total = size[same] + size[i]
            # Overlap is at most (total - differ) / 2; the rule is on overlap and union.
            overlap = (total - differ) // 2
            possible.append(same[100 * overlap >= PERCENT * (total - overlap)])
        return np.concatenate(possible) if possible else js

    def connecting(self) -> list[tuple[int, int]]:
        """Possible pairs that connect the rows which possible pairs connect, fewer than rows."""
        group, pairs = np.arange(len(self.row)), []
        for i in range(len(group) - 1):
            for j in self.later(i):
                if group[i] != group[j]:
                    pairs.append(self.pair(i, j))
                    group[group == group[j]] = group[i]
        return pairs

    def pair(self, i: int, j: int) -> tuple[int, int]:
        return int(min(self.row[i], self.row[j])), int(max(self.row[i], self.row[j]))

    def joining_links(self, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        """Links that join components, fewer than rows: a pair that is joined by now is not compared."""
        links = []
        for i in range(len(self.row) - 1):
            for j in self.later(i):
                if self.component[i] == self.component[j]:
                    continue
                inter = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if _linked(inter, len(sets[i]), len(sets[j])):
                    links.append(self.pair(i, j))
                    self.component[self.component == self.component[j]] = self.component[i]
        return links


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])


def _connecting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Possible pairs of each pair of tiles, as far as they connect something."""
    held, key = [], None
    for batch in batches:
        for row in zip(*[batch.column(n).to_pylist() for n in (*_TILE_COLUMNS, "signature")], strict=True):
            if row[:3] != key:
                if len(held) > 1:
                    yield _pair_batch(_TilePair(held).connecting())
                held, key = [], row[:3]
            held.append(row)
    yield _pair_batch(_TilePair(held).connecting() if len(held) > 1 else [])


def _joining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each pair of tiles, from rows with their texts."""
    held, sets, key = [], [], None
    for batch in batches:
        for piece in pieces(batch, size=SMALL_PIECE):
            own = shingle_sets(find_words(piece.column("text"), lower=True))
            columns = [piece.column(n).to_pylist() for n in _TILE_COLUMNS]
            for s, *row in zip(own, *columns, strict=True):
                if tuple(row[:3]) != key:
                    if len(held) > 1:
                        yield _pair_batch(_TilePair(held).joining_links(sets))
                    held, sets, key = [], [], tuple(row[:3])
                held.append((*row, signature(s)))
                sets.append(s)
    yield _pair_batch(_TilePair(held).joining_links(sets) if len(held) > 1 else [])


def _late_links(open_rows: DataFrame, feats: DataFrame, rows: DataFrame) -> DataFrame:
    """Links between components that are still apart."""
    signed = _tiled(open_rows.where(F.col("size") > FEW)).join(feats.select("row", "signature"), "row")
    connected = _by_tiles(signed).mapInArrow(_connecting, "a bigint, b bigint")
    possible = written(connected.union(_few_pairs(open_rows)).distinct(), "jaccard-possible")
    clusters = written(components(possible), "jaccard-clusters").select(
        F.col("node").alias("row"), F.col("component").alias("token")
    )
    sizes = clusters.groupBy("token").agg(F.count("*").alias("size"))
    known = open_rows.groupBy("row").agg(F.first("n_shingles").alias("n_shingles"), F.first("component").alias("component"))
    entries = clusters.join(sizes, "token").join(known, "row").withColumn("place", F.lit(0).cast("bigint"))
    texts = with_texts(_tiled(entries), "row", feats, rows)
    return _by_tiles(texts).mapInArrow(_joining, "a bigint, b bigint")


def link_classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features of every row, and every class with its component and least id."""
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(frequency_classes(rows))
    feats = written(rows.mapInArrow(partial(_features, shared), _FEATURES), "jaccard-features")
    reps = (
        feats.where("n_shingles > 0")
        .groupBy("h1", "h2")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("least"))
        .select("h1", "h2", F.col("least.row").alias("rep"), F.col("least.doc_id").alias("rep_doc"))
    )
    reps = written(reps, "jaccard-classes")
    own = feats.join(reps.select(F.col("rep").alias("row")), "row", "left_semi")
    entries = own.select(
        "row", "n_shingles", _band(F.col("n_shingles")).alias("band"), F.posexplode("prefix").alias("place", "token")
    ).repartition("token")
    per_token, per_band = Window.partitionBy("token"), Window.partitionBy("token", "band")
    buckets = (
        entries.withColumn("size", F.count("*").over(per_token))
        .where("size > 1")
        .withColumn("least", F.min("row").over(per_band))
        .select("token", "row", "n_shingles", "place", "least")
    )
    buckets = written(buckets, "jaccard-buckets")
    links = written(verified(_first_pairs(buckets), feats, rows), "jaccard-links")
    open_rows = _open_rows(buckets, written(components(links), "jaccard-found"))
    left, entries = _partners(open_rows)
    number = 0
    while left > PARTNERS * entries:
        number += 1
        more = verified(_leader_pairs(open_rows, number), feats, rows)
        links = written(links.union(more), "jaccard-links")
        open_rows = _open_rows(buckets, written(components(links), "jaccard-found"))
        before, (left, entries) = left, _partners(open_rows)
        if left > 0.8 * before:
            break
    links = links.union(_late_links(open_rows, feats, rows))
    found = written(components(links), "jaccard-components")
    return feats.select("row", "doc_id", *CONTENT, "n_shingles", "h1", "h2"), _with_least(reps, found)


def _partners(open_rows: DataFrame) -> tuple[int, int]:
    """Possible partners of all open entries together, and the number of entries."""
    return tuple(open_rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first())


def _with_least(reps: DataFrame, found: DataFrame) -> DataFrame:
    """Every class with its component and that component's least id.

    The nodes of a large component are dealt by a salt as well, and its least id goes to each part.
    """
    nodes = found.join(reps.select(F.col("rep").alias("node"), "rep_doc"), "node")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    least = nodes.groupBy("component").agg(F.min("rep_doc").alias("component_id")).select("*", salts)
    salted = found.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    ids = salted.join(least, ["component", "salt"]).select(F.col("node").alias("rep"), "component", "component_id")
    return written(
        reps.join(ids, "rep", "left").select(
            "h1",
            "h2",
            F.coalesce("component", "rep").alias("component"),
            F.when(F.col("component").isNull(), F.col("rep_doc")).otherwise(F.col("component_id")).alias("component_id"),
        ),
        "jaccard-classes",
    )


def with_components(rows: DataFrame) -> DataFrame:
    """``(row, doc_id, n_shingles, component, component_id)`` and ``CONTENT``; component_id is the least doc_id reached.

    ``rows`` are texts as by ``with_content``.
    """
    feats, classes = link_classes(rows)
    joined = feats.join(classes, ["h1", "h2"], "left")
    alone = F.col("component").isNull()  # no words, so no class
    return joined.select(
        "row",
        "doc_id",
        *CONTENT,
        "n_shingles",
        F.coalesce("component", "row").alias("component"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The row of least doc_id of every component of near copies, all columns unchanged.

    Ties go to the row read first; a null doc_id is the largest. Texts are not stored but found again by content. Where
    rows of one content are more than those to keep, they have words, so are in one component, which keeps one of them.
    """
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    joined = with_components(with_content(docs)).select("row", "doc_id", *CONTENT, "component")
    joined = written(joined, "jaccard-rows")
    least = joined.groupBy("component").agg(F.min(order)["row"].alias("row")).withColumn("kept", F.lit(1))
    counts = joined.join(least, "row", "left").groupBy(*CONTENT).agg(F.count("*").alias("n"), F.count("kept").alias("kept"))
    dropped = written(counts.where("kept < n").select(*CONTENT, "kept"), "jaccard-dropped")
    names = [fresh_name(docs, name) for name in CONTENT]
    rows = docs.withColumns(dict(zip(names, _content(), strict=True)))
    single = without(rows, names, dropped.select(*CONTENT)).select(*docs.columns)
    copied = dropped.where("kept > 0").select(*CONTENT).toDF(*names)
    return single if copied.isEmpty() else single.unionByName(_first_of_each(rows, names, copied).select(*docs.columns))


def _first_of_each(rows: DataFrame, names: list[str], content: DataFrame) -> DataFrame:
    """The row read first of each content, combined before the shuffle."""
    columns = rows.columns
    number, first = fresh_name(rows, "number"), fresh_name(rows, "first")
    numbered = rows.withColumn(number, F.monotonically_increasing_id())
    near = perhaps_in(numbered, names[0], content.select(names[0])).join(content, names, "left_semi")
    firsts = near.groupBy(*[F.col(n) for n in names]).agg(F.min_by(F.struct(*columns), number).alias(first))
    return firsts.select(f"{first}.*")


def jaccard_report(docs: DataFrame) -> DataFrame:
    return with_components(with_content(docs)).select("doc_id", "n_shingles", "component_id")

"""How far the sources of a language lie apart, from an index built in one pass.

Every task reads its documents once and gathers postings, a term's documents and
its occurrences by source, in memory. When the block is full, or the input at
its end, it is spilled as a run: term by term in order, cut by the terms' hash
into shards and, within a shard, into slices of bounded length. The runs of a
shard come together in one task ordered by their slices' first terms. There a
heap merges them: a slice is opened when it comes, the terms that no later slice
can have leave the heap together and are summed up, and slices without further
terms are closed. So the open slices of the runs are all that has to be in memory.

Shares of terms are whole numbers, all arithmetic is exact. Two sources' sum
over all terms starts from the value that every term would give if neither had
it. Corrections for terms that one of them has need only how many terms have
which share; corrections for shared terms are streamed from the postings and
summed up per pair in the map tasks.

Null texts have no terms, null languages and sources are ''. Rows with equal or
null ids are documents of their own. A group without terms, and a language none
of whose terms is kept, are there with shares of nothing seen. An empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.words import texts_of
from footfall.operators.ranking import top_n
from footfall.settings import materialize

# A term is kept in a language if so many of its documents have it.
LEAST_DOCUMENTS = 10
TOP_TERMS = 10
# Bytes of a block, about, of which a document's posting and a term's name take so many.
BLOCK = 64 << 20
POSTING_BYTES = 12
TERM_BYTES = 100
# Terms of a slice, and of all slices that are open before they are merged.
SLICE = 1_024
HELD = 1 << 18
# Hash shards of the terms for each shuffle partition.
SHARDS = 4
SCALE = 1_000_000_000
SMOOTHING = 2

# A to Z become a to z, letters beyond ASCII stay, all else separates.
LETTERS = bytes(c if c >= 128 else (c | 32) if chr(c).isalpha() else 32 for c in range(256))

RUN = (
    "shard int, lang string, first string, sources array<string>, terms array<string>, "
    "documents array<long>, sizes array<int>, places array<int>, counts array<long>"
)
INDEX = "lang string, term string, sources array<string>, counts array<long>"


class _Numbers(dict):
    """Numbers of keys in the order in which they were first asked for."""

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        return number


def _lists(starts: np.ndarray, values: np.ndarray | pa.Array) -> pa.ListArray:
    """The values cut into lists that begin at ``starts``."""
    offsets = pa.array(np.append(starts, len(values)), pa.int32())
    return pa.ListArray.from_arrays(offsets, values if isinstance(values, pa.Array) else pa.array(values))


def _begins(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


class Block:
    """Postings of the documents seen since the last spill."""

    def __init__(self):
        self.terms, self.groups = _Numbers(), _Numbers()
        self.found: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.group_of: list[int] = []
        self.size = 0

    def add(self, text: bytes, lang: str, source: str) -> None:
        words = text.translate(LETTERS).split()
        if not words:
            return
        known = len(self.terms)
        numbers = np.fromiter(map(self.terms.__getitem__, words), np.int32, len(words))
        found, counts = np.unique(numbers, return_counts=True)
        self.found.append(found)
        self.counts.append(counts.astype(np.int32))
        self.group_of.append(self.groups[lang, source])
        self.size += POSTING_BYTES * len(found) + TERM_BYTES * (len(self.terms) - known)

    def run(self, shards: int, slice_terms: int) -> pa.RecordBatch | None:
        """The block's slices, in the order of language, shard and term."""
        if not self.found:
            return None
        terms = pa.array(list(self.terms), pa.binary()).cast(pa.string())
        shard = np.fromiter((xxhash.xxh64_intdigest(t) % shards for t in self.terms), np.int64, len(terms))
        order = pa.compute.sort_indices(
            pa.table({"shard": shard, "term": terms}), sort_keys=[("shard", "ascending"), ("term", "ascending")]
        ).to_numpy()
        place = np.empty(len(terms), np.int64)
        place[order] = np.arange(len(terms))
        terms, shard = terms.take(pa.array(order)), shard[order]
        langs = _Numbers()
        lang = np.array([langs[name] for name, _ in self.groups], np.int64)
        groups = np.repeat(np.array(self.group_of, np.int64), [len(f) for f in self.found])
        # One number for language, term and group brings all that is one posting together.
        key = (lang[groups] * len(terms) + place[np.concatenate(self.found)]) * len(lang) + groups
        by_key = np.argsort(key, kind="stable")
        key = key[by_key]
        postings = _begins(key)
        counts = np.add.reduceat(np.concatenate(self.counts)[by_key].astype(np.int64), postings)
        documents = np.diff(np.append(postings, len(key)))
        row, group = np.divmod(key[postings], len(lang))
        rows = _begins(row)
        of_lang, at = np.divmod(row[rows], len(terms))
        whole = _begins(of_lang, shard[at])
        within = np.arange(len(rows)) - np.repeat(whole, np.diff(np.append(whole, len(rows))))
        slices = np.flatnonzero(within % slice_terms == 0)
        # A source's place among those of its language.
        sources: list[list[str]] = [[] for _ in langs]
        local = np.empty(len(lang), np.int32)
        for number, (name, source) in enumerate(self.groups):
            local[number] = len(sources[langs[name]])
            sources[langs[name]].append(source)
        names = list(langs)
        columns = [
            pa.array(shard[at[slices]], pa.int32()),
            pa.array([names[k] for k in of_lang[slices]], pa.string()),
            terms.take(pa.array(at[slices])),
            pa.array([sources[k] for k in of_lang[slices]], pa.list_(pa.string())),
            _lists(slices, terms.take(pa.array(at))),
            _lists(slices, np.add.reduceat(documents, rows)),
            _lists(slices, np.diff(np.append(rows, len(postings))).astype(np.int32)),
            _lists(rows[slices], local[group]),
            _lists(rows[slices], counts),
        ]
        return pa.record_batch(columns, names=[part.split()[0] for part in RUN.split(", ")])


def runs(docs: DataFrame, shards: int, block: int = BLOCK, slice_terms: int = SLICE) -> DataFrame:
    """Term-sorted runs of the documents (text, lang, source), cut into shards and slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Block()
        for batch in batches:
            langs, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for text, lang, source in zip(texts_of(batch, "text"), langs, sources, strict=True):
                held.add(text, lang, source)
                if held.size >= block:
                    yield held.run(shards, slice_terms)
                    held = Block()
        if (last := held.run(shards, slice_terms)) is not None:
            yield last

    return docs.select(F.col("text").cast("binary"), "lang", "source").mapInArrow(run, RUN)


class Slice(NamedTuple):
    """A run's terms in one shard of a language, or the next of them."""

    key: tuple
    first: str
    sources: list[str]
    terms: pa.Array
    documents: np.ndarray
    sizes: np.ndarray
    places: np.ndarray
    counts: np.ndarray


class Frequencies(NamedTuple):
    """Merged terms in order: their documents, and for each the sources and occurrences there."""

    key: tuple
    terms: pa.Array
    documents: np.ndarray
    starts: np.ndarray
    sources: pa.Array
    counts: np.ndarray


def _summed(key: tuple, parts: list[tuple[Slice, int, int]]) -> Frequencies:
    """Equal terms of the slices' parts (from, to) added up."""
    terms = pa.concat_arrays([s.terms.slice(a, b - a) for s, a, b in parts]).dictionary_encode()
    by_term = pa.compute.sort_indices(terms.dictionary).to_numpy()
    rank = np.empty(len(by_term), np.int64)
    rank[by_term] = np.arange(len(by_term))
    term = rank[terms.indices.to_numpy()]
    documents = np.zeros(len(by_term), np.int64)
    np.add.at(documents, term, np.concatenate([s.documents[a:b] for s, a, b in parts]))
    sources = _Numbers()
    source, counts, sizes = [], [], []
    for s, a, b in parts:
        ends = np.concatenate(([0], np.cumsum(s.sizes)))
        numbers = np.array([sources[name] for name in s.sources], np.int64)
        source.append(numbers[s.places[ends[a] : ends[b]]])
        counts.append(s.counts[ends[a] : ends[b]])
        sizes.append(s.sizes[a:b])
    posting = np.repeat(term, np.concatenate(sizes)) * len(sources) + np.concatenate(source)
    order = np.argsort(posting, kind="stable")
    posting = posting[order]
    begins = _begins(posting)
    of_term, of_source = np.divmod(posting[begins], len(sources))
    return Frequencies(
        key,
        terms.dictionary.take(pa.array(by_term)),
        documents,
        np.searchsorted(of_term, np.arange(len(by_term))),
        pa.array(list(sources), pa.string()).take(pa.array(of_source)),
        np.add.reduceat(np.concatenate(counts)[order], begins),
    )


def merged(slices: Iterator[Slice], held_terms: int = HELD) -> Iterator[Frequencies]:
    """Frequencies of slices that come in the order of key and first term.

    The heap has the open slices by the next term of each. When they hold
    ``held_terms``, all terms before the next slice's first are taken from it,
    which are complete then; a slice goes back with what it has left.
    """
    heap: list[tuple[str, int, int, Slice]] = []
    held = 0

    def due(until: str | None) -> Iterator[Frequencies]:
        parts = []
        while heap and (until is None or heap[0][0] < until):
            _, serial, at, part = heapq.heappop(heap)
            end = len(part.terms) if until is None else bisect_left(part.terms.to_pylist(), until, at)
            parts.append((part, at, end))
            if end < len(part.terms):
                heapq.heappush(heap, (part.terms[end].as_py(), serial, end, part))
        if parts:
            yield _summed(parts[0][0].key, parts)

    last = None
    for serial, part in enumerate(slices):
        if part.key != last or held >= held_terms:
            yield from due(part.first if part.key == last else None)
            held = sum(len(s.terms) - at for _, _, at, s in heap)
        last = part.key
        heapq.heappush(heap, (part.first, serial, 0, part))
        held += len(part.terms)
    yield from due(None)


def index(docs: DataFrame, least: int = LEAST_DOCUMENTS, block: int = BLOCK, slice_terms: int = SLICE) -> DataFrame:
    """Kept terms of every language with their sources and occurrences there."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, lang, first, sources = (batch.column(k)[row].as_py() for k in range(4))
                terms, *numbers = (batch.column(k)[row].values for k in range(4, 9))
                yield Slice((shard, lang), first, sources, terms, *(n.to_numpy() for n in numbers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in merged(slices(batches)):
            kept = np.flatnonzero(f.documents >= least)
            lists = pa.array(kept)
            offsets = np.append(f.starts, len(f.counts))
            sources, counts = (
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), v).take(lists)
                for v in (f.sources, pa.array(f.counts, pa.int64()))
            )
            langs = pa.array([f.key[1]] * len(kept), pa.string())
            yield pa.record_batch(
                [langs, f.terms.take(lists), sources, counts], names=["lang", "term", "sources", "counts"]
            )

    spilled = runs(docs, SHARDS * tasks, block, slice_terms)
    return spilled.repartition(tasks, "shard").sortWithinPartitions("shard", "lang", "first").mapInArrow(run, INDEX)


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (count + SMOOTHING) / (total + SMOOTHING terms)); of nothing, if there are no terms."""
    wide = (count + SMOOTHING).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = F.greatest(total + SMOOTHING * terms, F.lit(1)).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", wide, below)


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q))"""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pairs(stats: DataFrame, postings: DataFrame) -> DataFrame:
    """(lang, a, b, value) of every two sources of a language, a before b."""
    a = stats.select("lang", F.col("source").alias("a"), F.col("nothing").alias("no_a"), "terms")
    b = stats.select("lang", F.col("source").alias("b"), F.col("nothing").alias("no_b"))
    no_a, no_b = F.col("no_a"), F.col("no_b")
    pair = ["lang", "a", "b"]
    neither = a.join(b, "lang").where("a < b").select(*pair, (F.col("terms") * _apart(no_a, no_b)).alias("value"))
    # Terms that one has, whatever the other has: as many as there are of each share.
    shares = postings.groupBy("lang", "source", "nothing", "p").agg(F.count(F.lit(1)).alias("n"))
    other = stats.select("lang", F.col("source").alias("other"), F.col("nothing").alias("no"))
    either = (
        shares.join(other, "lang")
        .where("source <> other")
        .select(
            "lang",
            F.least("source", "other").alias("a"),
            F.greatest("source", "other").alias("b"),
            (F.col("n") * (_apart(F.col("p"), F.col("no")) - _apart(F.col("nothing"), F.col("no")))).alias("value"),
        )
    )
    # Terms that both have.
    one = postings.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("p_a"), F.col("nothing").alias("no_a"))
    two = postings.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("p_b"), F.col("nothing").alias("no_b"))
    p_a, p_b = F.col("p_a"), F.col("p_b")
    corrected = _apart(p_a, p_b) - _apart(p_a, no_b) - _apart(no_a, p_b) + _apart(no_a, no_b)
    both = one.join(two, ["lang", "term"]).where("a < b").select(*pair, corrected.alias("value"))
    summed = either.groupBy(*pair).agg(F.sum("value").alias("value"))
    summed = summed.unionByName(both.groupBy(*pair).agg(F.sum("value").alias("value"))).unionByName(neither)
    return summed.groupBy(*pair).agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair`` ranks the other sources of the language by their distance,
    part ``term`` the ``top`` terms that the source has more of than its language.
    """
    named = docs.select("text", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")])
    kept = materialize(index(named, least), "index")
    each = kept.select(
        "lang",
        "term",
        F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y).alias("in_lang"),
        F.explode(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("count"))).alias("of"),
    ).select("lang", "term", "in_lang", "of.source", "of.count")
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    totals = each.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    in_lang = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    nothing = F.lit(0).cast("long")
    stats = (
        named.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(terms.join(in_lang, "lang"), "lang", "left")
        .fillna(0, ["total", "terms", "lang_total"])
        .withColumn("nothing", _share(nothing, F.col("total"), F.col("terms")))
    )
    stats = materialize(stats, "source-stats")
    postings = each.join(stats, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        "nothing",
        _share(F.col("count"), F.col("total"), F.col("terms")).alias("p"),
        _share(F.col("in_lang"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    postings = materialize(postings, "postings")
    found = materialize(_pairs(stats, postings), "source-pairs")
    mirrored = found.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        found.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    order = [F.desc("value"), F.col("item")]
    pairs = mirrored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    higher = postings.where("p > q").select("lang", "source", F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    best = top_n(higher, ["lang", "source"], order, top, "rank")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        best.withColumn("part", F.lit("term")).select(*columns)
    )

"""Repeated word passages by compacting a de Bruijn graph.

Runs of thirteen words are the graph's edges. Edges of a document that share
their smallest four-word seed travel together, as one bundle, to the seed's
partition; there every edge finds the first document in which it occurs.
Repeated edges that follow one another in a document, and in the document they
come from, are compacted into paths; a path's coordinates in both documents
state the repeated span. The words that paths cover are removed.

An edge is repeated when its words also start in a document with a smaller
doc_id. Nulls and empty texts have no words. A row without doc_id repeats
nothing and is repeated by nothing. Rows that share a doc_id never repeat each
other; a row is named by its doc_id and the digest of its text, so rows with
both in common share their paths and rows of different texts have their own.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.words import Remembered, gram_hashes, hash_memory, mixed, run_lengths, texts_of, word_hashes
from footfall.settings import materialize

EDGE = 13
SEED = 4
# Edges sorted at once in a task.
CHUNK = 1_500_000
# A seed with this share of all words is frequent; there are at most 1 / FREQUENT such seeds.
FREQUENT = 1e-4

# A bundle: the edges of one seed; a path: repeated edges of one document and their source.
ROWS = "seed long, doc_id long, row long, at int, edges binary, n int, source long, source_at int"
_ROWS = pa.schema(
    [
        ("seed", pa.int64()),
        ("doc_id", pa.int64()),
        ("row", pa.int64()),
        ("at", pa.int32()),
        ("edges", pa.binary()),
        ("n", pa.int32()),
        ("source", pa.int64()),
        ("source_at", pa.int32()),
    ]
)


def _seeds(hashes: np.ndarray, m: int) -> np.ndarray:
    return mixed(gram_hashes(hashes, m)) >> np.uint64(1)


def frequent_seeds(docs: DataFrame, m: int = SEED, share: float = FREQUENT, chunk: int = CHUNK) -> np.ndarray:
    """Seeds with at least ``share`` of all places, counted over all documents.

    A chunk leaves out a seed that is rare in it, so a count may be too low by
    less than ``share``; that only moves where the line is drawn.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = hash_memory()
        parts, held = [], 0

        def counted() -> pa.RecordBatch:
            seeds, n = np.unique(np.concatenate(parts), return_counts=True)
            many = n >= max(2, share * held)
            return pa.record_batch(
                [
                    pa.array(np.append(seeds[many], 0).view(np.int64)),
                    pa.array(np.append(n[many], 0).astype(np.int64)),
                    pa.array(np.append(np.zeros(many.sum(), np.int64), held)),
                ],
                names=["seed", "n", "places"],
            )

        for batch in batches:
            for text in texts_of(batch, "text"):
                words = text.split()
                if len(words) >= m:
                    parts.append(_seeds(word_hashes(words, memory), m))
                    held += len(parts[-1])
                    if held >= chunk:
                        yield counted()
                        parts, held = [], 0
        if parts:
            yield counted()

    counts = materialize(
        docs.select(F.col("text").cast("binary").alias("text"))
        .mapInArrow(run, "seed long, n long, places long")
        .groupBy("seed")
        .agg(F.sum("n").alias("n"), F.sum("places").alias("places")),
        "seeds",
    )
    places = counts.agg(F.sum("places")).first()[0] or 0
    rows = counts.where((F.col("n") >= 2) & (F.col("n") >= share * places)).select("seed").collect()
    return np.sort(np.array([r.seed for r in rows], np.int64).view(np.uint64))


def _first_of_each(key: np.ndarray, doc: np.ndarray, row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every edge, the index of its first occurrence: smallest document, then place; and whether it is
    another one's copy, of the same document, row and place."""
    order = np.lexsort((row, at, doc, key))
    new = np.ones(len(order), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    first = np.empty(len(order), np.int64)
    first[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    copy = np.zeros(len(order), bool)
    same = ~new
    for column in (doc, row, at):
        same[1:] &= column[order][1:] == column[order][:-1]
    copy[order] = same
    return first, copy


def _paths(doc: np.ndarray, row: np.ndarray, at: np.ndarray, source: np.ndarray, source_at: np.ndarray):
    """Repeated edges, sorted by document, row and place, compacted: (doc, row, at, n, source, source_at)."""
    if not len(doc):
        return doc, row, at, at, source, source_at
    follows = (doc[1:] == doc[:-1]) & (row[1:] == row[:-1]) & (source[1:] == source[:-1])
    follows &= (at[1:] == at[:-1] + 1) & (source_at[1:] == source_at[:-1] + 1)
    starts = np.concatenate(([0], np.flatnonzero(~follows) + 1))
    n = np.diff(np.concatenate((starts, [len(doc)])))
    return doc[starts], row[starts], at[starts], n, source[starts], source_at[starts]


def _path_batch(doc, row, at, n, source, source_at) -> pa.RecordBatch:
    none = len(doc)
    return pa.record_batch(
        [
            # Paths go anywhere: their place in the shuffle is drawn from their document.
            pa.array(mixed(doc.view(np.uint64) + at.astype(np.uint64)).view(np.int64)),
            pa.array(doc),
            pa.array(row),
            pa.array(at.astype(np.int32)),
            pa.nulls(none, pa.binary()),
            pa.array(n.astype(np.int32)),
            pa.array(source),
            pa.array(source_at.astype(np.int32)),
        ],
        schema=_ROWS,
    )


def _bundles(
    doc: np.ndarray, row: np.ndarray, at: np.ndarray, edge: np.ndarray, seed: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Consecutive edges of a document with the same seed, as one row each."""
    if not len(doc):
        return
    cut = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1) | (seed[1:] != seed[:-1])
    starts = np.concatenate(([0], np.flatnonzero(cut) + 1))
    n = np.diff(np.concatenate((starts, [len(doc)])))
    # 48 bits of an edge's hash beside the 64 of its seed.
    six = np.ascontiguousarray(edge.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
    offsets = np.concatenate((starts, [len(doc)])).astype(np.int32) * 6
    blobs = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(six.tobytes())]
    )
    none = pa.nulls(len(starts), pa.int64())
    yield pa.record_batch(
        [
            pa.array(seed[starts].view(np.int64)),
            pa.array(doc[starts]),
            pa.array(row[starts]),
            pa.array(at[starts].astype(np.int32)),
            blobs,
            pa.array(n.astype(np.int32)),
            none,
            none.cast(pa.int32()),
        ],
        schema=_ROWS,
    )


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, row (a digest of the text) and text."""
    text = F.col("text").cast("binary")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("row"), text.alias("text"))


def _sent(docs: DataFrame, k: int, m: int, chunk: int) -> DataFrame:
    """Bundles of edges; of an edge in several documents of a task's chunk, those of the first one and paths for the rest."""
    frequent = frequent_seeds(docs, m, chunk=chunk)

    def settle(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        doc, row, at, edge, seed = (np.concatenate(c) for c in zip(*parts, strict=True))
        first, copy = _first_of_each(edge, doc, row, at)
        repeated = doc[first] < doc
        order = np.flatnonzero(repeated)
        yield _path_batch(*_paths(doc[order], row[order], at[order], doc[first][order], at[first][order]))
        # Every place of the edge in its first document: a smaller one may be in another chunk.
        sent = ~repeated & ~copy
        yield from _bundles(doc[sent], row[sent], at[sent], edge[sent], seed[sent])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = hash_memory()
        parts, held = [], 0
        for batch in batches:
            named = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch, "text"), strict=True)
            for doc_id, row, text in named:
                words = text.split()
                n = len(words) - k + 1
                if n <= 0:
                    continue
                hashes = word_hashes(words, memory)
                seeds = _seeds(hashes, m)
                if len(frequent):
                    near = frequent[np.minimum(np.searchsorted(frequent, seeds), len(frequent) - 1)]
                    seeds |= (near == seeds).astype(np.uint64) << np.uint64(63)
                least = np.lib.stride_tricks.sliding_window_view(seeds, k - m + 1).min(axis=1)
                parts.append((*(np.full(n, x, np.int64) for x in (doc_id, row)), np.arange(n), gram_hashes(hashes, k), least))
                held += n
                if held >= chunk:
                    yield from settle(parts)
                    parts, held = [], 0
        if parts:
            yield from settle(parts)

    return _texts(docs.where("doc_id is not null")).mapInArrow(run, ROWS)


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by seed -> paths. A seed's rows stay together; at most a chunk is held besides."""

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        n = table["n"].to_numpy()
        blob = np.frombuffer(b"".join(table["edges"].to_pylist()), np.uint8).reshape(-1, 6)
        edge = np.zeros((len(blob), 8), np.uint8)
        edge[:, :6] = blob
        seed = np.repeat(table["seed"].to_numpy().view(np.uint64), n)
        key = mixed(seed ^ mixed(edge.view("<u8")[:, 0].astype(np.uint64)))
        doc, row = (np.repeat(table[c].to_numpy(), n) for c in ("doc_id", "row"))
        at = np.repeat(table["at"].to_numpy().astype(np.int64), n)
        at += np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        first, _ = _first_of_each(key, doc, row, at)
        found = np.flatnonzero(doc[first] < doc)
        found = found[np.lexsort((at[found], row[found], doc[found]))]
        yield _path_batch(*_paths(doc[found], row[found], at[found], doc[first][found], at[first][found]))

    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        path = table["edges"].is_null()
        yield from table.filter(path).to_batches()
        table = table.filter(pa.compute.invert(path))
        if not table.num_rows:
            continue
        seeds = table["seed"].to_numpy()
        held.append(table)
        rows += table.num_rows
        if rows >= CHUNK // 5:
            whole = pa.concat_tables(held)
            # The last seed may go on in the next batch.
            cut = int(np.searchsorted(whole["seed"].to_numpy(), seeds[-1]))
            if cut:
                yield from settle(whole.slice(0, cut))
            held = [whole.slice(cut).combine_chunks()]
            rows = held[0].num_rows
    if rows:
        yield from settle(pa.concat_tables(held))


def repeated_spans(docs: DataFrame, k: int = EDGE, m: int = SEED, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, row, at, n, source, source_at): n consecutive edges that also start in ``source``."""
    sent = _sent(docs, k, m, chunk).repartition("seed").sortWithinPartitions("seed")
    found = sent.mapInArrow(_settled, ROWS).select("doc_id", "row", "at", "n", "source", "source_at")
    return materialize(found, "spans")


def compacted(spans: DataFrame, k: int = EDGE) -> DataFrame:
    """Paths that continue each other, joined: (doc_id, row, start, end, source, source_start) in words."""
    apart = F.col("at") - F.col("source_at")
    w = Window.partitionBy("doc_id", "row", "source", "apart").orderBy("at")
    end = F.max(F.col("at") + F.col("n")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("apart", apart).withColumn("new", (F.coalesce(end, F.lit(-1)) < F.col("at")).cast("int"))
    path = F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (
        marked.withColumn("path", path)
        .groupBy("doc_id", "row", "source", "apart", "path")
        .agg(F.min("at").alias("start"), (F.max(F.col("at") + F.col("n")) + (k - 1)).alias("end"))
        .select("doc_id", "row", "start", "end", "source", (F.col("start") - F.col("apart")).alias("source_start"))
    )


def without_repeats(docs: DataFrame, k: int = EDGE) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by one space) of every row."""
    spans = (
        compacted(repeated_spans(docs, k), k)
        .groupBy("doc_id", "row")
        .agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            spans_of = batch.column(batch.schema.get_field_index("spans")).to_pylist()
            for text, spans in zip(texts_of(batch, "text"), spans_of, strict=True):
                words = text.split()
                covered = np.zeros(len(words) + 1, np.int32)
                for s in spans or ():
                    covered[s["start"]] += 1
                    covered[min(s["end"], len(words))] -= 1
                gone = np.cumsum(covered)[: len(words)] > 0
                left = [w for a, b in run_lengths(~gone) for w in words[a:b]]
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                kept.append(b" ".join(left))
            yield pa.record_batch(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return _texts(docs).join(spans, ["doc_id", "row"], "left").select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept binary"
    )


def kept_digest(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()

"""Best-fit packing of documents into token sequences, repacked until a bound certifies it.

``pieces`` turns texts into token pieces of at most the sequence length, ``pack``
places them. Pieces are dealt into partitions of a bounded size; each is packed
by best-fit decreasing, and dual feasible functions bound its number of
sequences from below. Where the bound is met, the partition is certified and
only its emptiest sequence stays open; partitions with a gap give up all their
pieces. What is open is dealt anew and packed again, as long as that saves
sequences.

Nulls and empty texts are documents of one token, the end mark. Rows with equal
or null ids are documents of their own. An empty table gives no rows. Columns
other than the id and the text are ignored.
"""

from __future__ import annotations

import functools
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.words import LOWER
from footfall.settings import materialize

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
# Pieces packed by one task.
PARTITION_PIECES = 40_000
# Times that open pieces are exchanged at most; each exchange leaves fewer.
EXCHANGES = 4

# Bytes of text that are encoded at a time, and words remembered per Python worker.
GROUP_BYTES = 2 << 20
REMEMBERED = 400_000

# Words of Latin letters in lower case are one unit to the tokenizer.
_WORD = rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+"
# Lines: a chunk that it parts into a word and the ASCII marks behind it, or any other.
# An apostrophe may begin a contraction, and < a special token.
_CHUNKS = re.compile(rb"(?:(" + _WORD + rb"+)([!-&(-/:;=-@\[-`{-~]*+)|[^\n]*+)\n")

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Encoder:
    """Ids, as little-endian bytes, of texts; chunks between white space are remembered.

    The tokenizer drops white space and never joins across it, lower-cases, and
    parts letters from marks, so "Word," is "word" and ",". Words not yet known
    are encoded together, without the steps that leave them as they are; the last
    token of each is one that ends a word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers import pre_tokenizers as pre

        self.model = Tokenizer.from_file(path)
        self.of_words = Tokenizer(self.model.model)
        self.of_words.pre_tokenizer = pre.Sequence(
            [pre.WhitespaceSplit(), pre.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.model.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.memory: dict[bytes, bytes] = {}

    def one(self, chunk: bytes) -> bytes:
        ids = self.model.encode(chunk.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def learn(self, words: list[bytes]) -> None:
        """Remembers words of Latin letters."""
        if not words:
            return
        text = b" ".join(words).decode("utf-8")
        ids = np.array(self.of_words.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):  # not a tokenizer that marks the ends of words
            self.memory.update((w, self.one(w)) for w in words)
            return
        raw, ends = ids.tobytes(), (ends * 4).tolist()
        self.memory.update((w, raw[s:e]) for w, s, e in zip(words, [0, *ends], ends, strict=False))

    def know(self, chunks: list[bytes]) -> None:
        """Remembers all of the chunks."""
        memory = self.memory
        if len(memory) >= REMEMBERED:
            memory.clear()
        memory[b""] = b""
        new = [chunk for chunk in chunks if chunk not in memory]
        parts = _CHUNKS.findall(b"".join(chunk + b"\n" for chunk in new).translate(LOWER))
        self.learn(list({word for word, _ in parts if word and word not in memory}))
        for chunk, (word, marks) in zip(new, parts, strict=True):
            if not word:
                memory[chunk] = self.one(chunk)
            elif marks:
                if marks not in memory:
                    memory[marks] = self.one(marks)
                memory[chunk] = memory[word] + memory[marks]
            else:
                memory[chunk] = memory[word]

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin, with the end of the last."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.binary()), b"").view(pa.string()))
        coded = split.values.dictionary_encode()
        chunks = coded.dictionary.view(pa.binary()).to_pylist()
        self.know(chunks)
        known = [self.memory[chunk] for chunk in chunks]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        codes = coded.indices.to_numpy()
        lengths = sizes[codes]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        # Every chunk's ids are taken from those of its word, which lie one behind the other.
        shift = (np.cumsum(sizes) - sizes)[codes] - ends[:-1]
        ids = np.frombuffer(b"".join(known), "<u4")[np.repeat(shift, lengths) + np.arange(ends[-1])]
        return ids, ends[split.offsets.to_numpy()]

    def many(self, texts: list[bytes]) -> list[bytes]:
        ids, bounds = self.ids_of(pa.array(texts, pa.binary()))
        return [ids[s:e].tobytes() for s, e in itertools.pairwise(bounds.tolist())]


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> _Encoder:
    """A Python worker's encoder; loading the tokenizer takes a good part of a small task."""
    return _Encoder(path)


def _groups(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text as bytes) in runs of about ``most`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(total, total[start] - sizes[start] + most)) + 1
        yield batch.slice(start, end - start)
        start = min(end, batch.num_rows)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of every document: ids of the tokenizer, then the end mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path or tokenizer_path())
        end = np.array([END_ID], "<u4").tobytes()
        step = capacity * 4
        for batch in batches:
            for group in _groups(batch, GROUP_BYTES):
                rows: list[tuple] = []
                encoded, bounds = encoder.ids_of(group.column(1))
                places = zip(group.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
                for doc_id, first, last in places:
                    ids = encoded[first:last].tobytes() + end
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
                yield pa.record_batch(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES_ARROW, strict=True)],
                    schema=_PIECES_ARROW,
                )
        # Of a task that is over only the tokenizer stays.
        encoder.memory.clear()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: the bin and the offset of every length, and the number of bins.

    Open bins are kept by free space; a bit set finds the least space that is enough.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces, count = 0, 0
    for i, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        enough = spaces >> length
        if enough:
            space = length + (enough & -enough).bit_length() - 1
            at = by_space[space].pop()
            if not by_space[space]:
                spaces ^= 1 << space
        else:
            space, at, count = capacity, count, count + 1
        bins[i], offsets[i] = at, capacity - space
        if left := space - length:
            by_space[left].append(at)
            spaces |= 1 << left
    return bins, offsets, count


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The least number of bins that dual feasible functions allow.

    f0(x, t): lengths over capacity - t count as a whole bin, those under t as
    nothing. f1(x, k): x rounded to parts of k + 1. Both keep every set that fits
    into one bin at one bin or less.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    below = np.concatenate(([0], np.cumsum(count * size)))  # total of the lengths under an index
    many = np.concatenate(([0], np.cumsum(count)))
    t = np.arange(1, capacity // 2 + 1)
    whole = many[-1] - many[capacity - t + 1]
    middle = below[capacity - t + 1] - below[t]
    best = max(-(-int(below[-1]) // capacity), int((whole + -(-middle // capacity)).max()))
    for k in range(1, 33):
        scaled = size * (k + 1)
        f = np.where(scaled % capacity == 0, size * k, (scaled // capacity) * capacity)
        total = int((count * f).sum())
        best = max(best, -(-total // (k * capacity)))
    return best


def _packer(capacity: int, level: int):
    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        lengths = group["length"].to_numpy(np.int64)
        bins, offsets, count = best_fit(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        fill = np.bincount(bins, weights=lengths, minlength=count)
        emptiest = int(np.argmin(fill)) if count else -1
        is_open = (bins == emptiest) & (fill[bins] < capacity) if count == bound else np.ones(len(bins), bool)
        return group.assign(
            level=level, part=int(key[0]), bin=bins, offset=offsets, certified=count == bound, open=is_open
        )

    return run


PACKED = "row long, length long, level int, part long, bin long, offset long, certified boolean, open boolean"


def _packed(rows: DataFrame, n: int, capacity: int, level: int, per_task: int) -> DataFrame:
    """``n`` rows (row, length), dealt evenly into partitions and packed."""
    parts = max(1, -(-n // per_task))
    dealt = rows.select("row", "length", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(parts)).alias("part"))
    return materialize(dealt.groupBy("part").applyInPandas(_packer(capacity, level), PACKED), "packed")


def _bins(packed: DataFrame) -> int:
    return packed.select("level", "part", "bin").distinct().count()


def pack(
    rows: DataFrame, capacity: int = CAPACITY, per_task: int = PARTITION_PIECES, exchanges: int = EXCHANGES
) -> DataFrame:
    """Adds sequence_id, offset and certified to pieces with a ``length`` of 1 to ``capacity``."""
    numbered = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    items = numbered.select(F.col("_row").alias("row"), "length")
    packed = _packed(items, items.count(), capacity, 0, per_task)
    closed, moving = packed.where("not open"), packed.where("open")
    for level in range(1, exchanges + 1):
        n, before = moving.count(), _bins(moving)
        if before < 2:
            break
        again = _packed(moving, n, capacity, level, per_task)
        if _bins(again) >= before:
            break
        closed, moving = closed.unionByName(again.where("not open")), again.where("open")
    placed = closed.unionByName(moving).select(
        F.col("row").alias("_row"),
        # Level, partition and bin each have a range of their own.
        (F.col("level") * (1 << 58) + F.col("part") * (1 << 18) + F.col("bin")).alias("sequence_id"),
        "offset",
        "certified",
    )
    return numbered.join(placed, "_row").drop("_row")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, path, capacity), capacity)

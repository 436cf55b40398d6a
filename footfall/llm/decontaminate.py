"""Passages of benchmark items in documents, found by a generalised suffix automaton.

The automaton is built from the items' normalised words; a document's words are
streamed through it, and the length of the longest match that ends at each word
is tracked. Matches of ``window`` words or more, or of a whole shorter item, are
hits. Items are held in groups of a bounded number of words, so that one
automaton has a bounded size; every group sees every document.

Null and empty texts have no words, and items without words match nothing; an
item without id has the empty id, and items of equal id count as one. Rows
with null or equal ids are judged one by one. Without documents there are no
rows, without items no hits. Other columns are kept by ``decontaminated`` and
ignored by ``hits``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.words import LOWER_ALNUM, run_lengths, texts_of

WINDOW = 10
# Words of one automaton's items at most, unless a single item has more.
GROUP_WORDS = 400_000
# A document is dropped when more than this share of its words is hit.
COVERAGE = 0.5


class Automaton:
    """Generalised suffix automaton over the words of items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.least = window
        ends: list[tuple[int, int, int]] = []  # state, item, words of the item up to here
        for n, (_, words) in enumerate(items):
            last = 0
            for k, word in enumerate(words):
                last = self._extended(last, self.vocabulary.setdefault(word, len(self.vocabulary)))
                if k + 1 >= window or k + 1 == len(words):
                    ends.append((last, n, len(words)))
            if words:
                self.least = min(self.least, len(words))
        self._mark(ends)

    def _extended(self, last: int, word: int) -> int:
        """The state of the item so far with one more word."""
        following = self.next[last].get(word)
        if following is not None and self.length[following] == self.length[last] + 1:
            return following
        if following is not None:
            return self._split(last, word, following)
        state = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            to = self.next[at][word]
            self.link[state] = to if self.length[to] == self.length[at] + 1 else self._split(at, word, to)
        return state

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, at: int, word: int, to: int) -> int:
        """A copy of ``to`` for the shorter matches that reach it from ``at``."""
        copy = self._state(self.length[at] + 1, dict(self.next[to]))
        self.link[copy], self.link[to] = self.link[to], copy
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _mark(self, ends: list[tuple[int, int, int]]) -> None:
        """For every state: the items with a window that ends in its matches.

        A window of ``window`` words belongs to the state whose matches include
        that length, a short item to the state of the whole item.
        """
        self.of_window: dict[int, set[int]] = {}
        self.of_short: dict[int, set[int]] = {}
        self.window_state: dict[int, int] = {}
        for state, item, words in ends:
            if words < self.window:
                self.of_short.setdefault(state, set()).add(item)
            else:
                at = self._window_state(state)
                self.of_window.setdefault(at, set()).add(item)

    def _window_state(self, state: int) -> int:
        found = self.window_state.get(state)
        if found is None:
            found = state
            while self.length[self.link[found]] >= self.window:
                found = self.link[found]
            self.window_state[state] = found
        return found

    def hits(self, words: list[bytes], covered: np.ndarray) -> set[int]:
        """Items with a window among the words; adds what they cover to ``covered``, a difference array."""
        found: set[int] = set()
        get = self.vocabulary.get
        ids = [get(w, -1) for w in words]
        known = np.array(ids, np.int64) >= 0
        for start, end in run_lengths(known):
            if end - start < self.least:
                continue  # no match is that short
            state = length = 0
            for i in range(start, end):
                word = ids[i]
                while state and word not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
                to = self.next[state].get(word)
                if to is None:
                    state = length = 0
                    continue
                state, length = to, length + 1
                if length >= self.window:
                    items = self.of_window.get(self._window_state(state))
                    if items:
                        covered[i + 1 - self.window] += 1
                        covered[i + 1] -= 1
                        found |= items
                if length >= self.least and self.of_short:
                    at = state
                    whole = length == self.length[at]
                    while at > 0:
                        # A shorter match of the state itself is no whole item; its links are.
                        items = self.of_short.get(at) if whole else None
                        if items:
                            covered[i + 1 - self.length[at]] += 1
                            covered[i + 1] -= 1
                            found |= items
                        at, whole = self.link[at], True
        return found


def item_words(text: bytes) -> list[bytes]:
    return text.translate(LOWER_ALNUM).split()


def item_groups(items: DataFrame, group_words: int = GROUP_WORDS) -> list[list[tuple[str, list[bytes]]]]:
    """The items in groups of a bounded number of words, in the order of their ids.

    Items are read one partition at a time. A benchmark is a test set; it does
    not grow with the documents.
    """
    groups: list[list[tuple[str, list[bytes]]]] = [[]]
    held = 0
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.col("text").cast("binary").alias("t"))
    for row in rows.where("t is not null").orderBy("i").toLocalIterator():
        words = item_words(bytes(row.t))
        if not words:
            continue
        if held and held + len(words) > group_words:
            groups.append([])
            held = 0
        groups[-1].append((row.i, words))
        held += len(words)
    return groups


class Matcher:
    """Runs texts through the automata of all groups; one automaton is held at a time."""

    def __init__(self, groups, window: int):
        self.groups, self.window = groups, window
        self.built, self.automaton = -1, None

    def __call__(self, texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray, list[str]]]:
        """Words, which of them are hit, and the ids of items, for every text."""
        words = [item_words(t) for t in texts]
        covered = [np.zeros(len(w) + 1, np.int32) for w in words]
        items: list[set[str]] = [set() for _ in words]
        for n, group in enumerate(self.groups):
            if self.built != n:
                self.built, self.automaton = n, Automaton(group, self.window)
            for k, w in enumerate(words):
                if len(w) >= self.automaton.least:
                    items[k].update(self.automaton.ids[i] for i in self.automaton.hits(w, covered[k]))
        for w, c, i in zip(words, covered, items, strict=True):
            yield w, np.cumsum(c)[: len(w)] > 0, sorted(i)


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    groups = docs.sparkSession.sparkContext.broadcast(item_groups(items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(groups.value, window)
        for batch in batches:
            rows = [
                (len(words), int(hit.sum()), len(found), hashlib.sha256(",".join(found).encode()).hexdigest())
                for words, hit, found in match(texts_of(batch, "text"))
            ]
            n_words, n_hit, n_items, digest = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array(n_items, pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array([n > 0 for n in n_hit], pa.bool_()),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run,
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean",
    )


def _cut(text: bytes, hit: np.ndarray) -> bytes:
    """The text without its hit words; a run of them goes with what stands between them."""
    mask = np.frombuffer(text.translate(LOWER_ALNUM), np.uint8) != 32
    # Bytes 9 to 13 became spaces as well, so words are the runs of other bytes.
    places = list(run_lengths(mask))
    kept, at = [], 0
    for start, end in run_lengths(hit):
        kept.append(text[at : places[start][0]])
        at = places[end - 1][1]
    kept.append(text[at:])
    return b"".join(kept)


def decontaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = COVERAGE, text: str = "text"
) -> DataFrame:
    """The rows with hit spans removed from the text; rows hit beyond ``coverage`` are dropped.

    All columns stay as they are, also a null text.
    """
    groups = docs.sparkSession.sparkContext.broadcast(item_groups(items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(groups.value, window)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            column = batch.column(at).to_pylist()
            keep = np.ones(batch.num_rows, bool)
            raw = texts_of(batch, text)
            for k, (words, hit, _) in enumerate(match(raw)):
                if hit.any():
                    keep[k] = hit.sum() <= coverage * len(words)
                    column[k] = _cut(raw[k], hit).decode("utf-8", "replace")
            changed = batch.set_column(at, batch.schema.field(at), pa.array(column, batch.schema.field(at).type))
            yield changed.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)

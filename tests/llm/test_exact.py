"""Operators whose results are fixed, against plain versions, on odd and ordinary texts."""

from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import decontaminate, near_dedup, packing, pii, quality, sharding, substrings

ITEMS = "item_id long, text string"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_near_duplicates(documents, corpus):
    assert rows_of(near_dedup.near_duplicates(documents(corpus))) == sorted(brute.near(corpus))
    got = near_dedup.near_duplicates(documents(corpus), percent=80)
    assert rows_of(got) == sorted(brute.near(corpus, 80))


def test_recall_of_near_duplicates(spark):
    """Links of every document whose id is divisible by 20, against all documents, by brute force."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    component = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    memory = near_dedup.hash_memory()
    sets = {r.doc_id: near_dedup.shingles((r.text or "").encode(), memory) for r in docs.select("doc_id", "text").collect()}
    having = defaultdict(list)
    for d, grams in sets.items():
        for g in grams.tolist():
            having[g].append(d)
    links = []
    for d in (d for d in sets if d % 20 == 0):
        common = defaultdict(int)
        for g in sets[d].tolist():
            for other in having[g]:
                common[other] += 1
        n = len(sets[d])
        links += [(d, o) for o, c in common.items() if o != d and 100 * c >= 85 * (n + len(sets[o]) - c)]
    found = sum(component[a] == component[b] for a, b in links)
    print(f"recall {found} of {len(links)}")
    assert links and found >= 0.999 * len(links)


@pytest.mark.parametrize("percent", [70, 80, 90])
def test_a_miss_has_one_chance_for_tables_and_sketches(percent):
    from math import comb

    p, m = (percent / 100) ** near_dedup.ROWS, near_dedup.collections_for(percent, miss=near_dedup.MISS / 2)
    no_table = sum(comb(m, i) * p**i * (1 - p) ** (m - i) for i in range(3))
    most, q = near_dedup._most_differing(percent, near_dedup.MISS / 2), (1 - percent / 100) / 2
    apart = sum(comb(near_dedup.BITS, k) * q**k * (1 - q) ** (near_dedup.BITS - k) for k in range(most + 1, near_dedup.BITS + 1))
    assert no_table + apart <= near_dedup.MISS


def test_near_duplicates_at_low_similarity(documents, corpus):
    """More than 255 tables."""
    got = near_dedup.near_duplicates(documents(corpus), percent=70)
    assert rows_of(got) == sorted(brute.near(corpus, 70))


def test_near_duplicates_of_odd_rows(documents):
    text = "a b c d e f g h"
    odd = documents([(None, text), (None, text), (3, text), (3, text), (7, text.upper()), (9, None)])
    got = rows_of(near_dedup.near_duplicates(odd).select("doc_id", "component_id", "kept").fillna(-1))
    assert got == [(-1, -1, True)] * 2 + [(3, 3, True)] * 2 + [(7, 3, False), (9, 9, True)]
    assert near_dedup.near_duplicates(documents([(1, "x")]).limit(0)).collect() == []


def test_a_chain_is_one_component(documents):
    """Each text is like the next one only."""
    words = [f"w{i}" for i in range(140)]
    chain = [(50 - k, " ".join(words[3 * k : 3 * k + 80])) for k in range(20)]
    assert rows_of(near_dedup.near_duplicates(documents(chain))) == sorted(brute.near(chain))


def test_substrings(documents, corpus):
    got = substrings.without_repeats(documents(corpus)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256)
    )
    assert rows_of(got) == sorted(brute.substrings(corpus))


@pytest.mark.parametrize("chunk", [1, 200])
def test_substring_paths_over_many_chunks(documents, corpus, chunk):
    df = documents(corpus, 7)
    paths = substrings.compacted(substrings.repeated_spans(df, chunk=chunk)).collect()
    texts = {d: brute.WORD.findall(t or "") for d, t in corpus}
    removed = defaultdict(set)
    for p in paths:
        n = p.end - p.start
        # Source coordinates hold the same words.
        assert texts[p.doc_id][p.start : p.end] == texts[p.source][p.source_start : p.source_start + n]
        removed[p.doc_id].update(range(p.start, p.end))
    want = {d: n for d, _, n, _ in brute.substrings(corpus) if n}
    assert {d: len(s) for d, s in removed.items()} == want


@pytest.mark.parametrize("chunk", [1, substrings.CHUNK])
def test_rows_of_one_id_with_different_texts(documents, chunk):
    """Each loses its own repeated words, and neither repeats the other."""
    shared, own = (" ".join(f"{c}{i}" for i in range(60)) for c in "sz")
    rows = [(1, f"{shared} one"), (5, own), (5, f"x {shared}"), (5, f"x {shared}"), (5, f"{own} y"), (9, f"{own} s1")]
    docs = documents(rows, 4)
    spans = substrings.repeated_spans(docs, chunk=chunk)
    paths = {(p.doc_id, p.start, p.end, p.source, p.source_start) for p in substrings.compacted(spans).collect()}
    assert paths == {(5, 1, 61, 1, 0), (9, 0, 60, 5, 0)}
    removed = rows_of(substrings.without_repeats(docs).select("doc_id", "n_words", "n_removed", "kept"))
    assert removed == sorted(
        [(1, 61, 0, f"{shared} one".encode()), (5, 60, 0, own.encode()), (5, 61, 60, b"x"), (5, 61, 60, b"x"),
         (5, 61, 0, f"{own} y".encode()), (9, 61, 60, b"s1")]
    )


@pytest.mark.parametrize("chunk", [1, substrings.CHUNK])
def test_a_passage_twice_in_one_document(documents, chunk):
    """Both places go when a document with a smaller id has the passage, in another chunk or the same one."""
    passage = " ".join(f"w{i}" for i in range(20))
    inner = f"{passage} a b c {passage} d"
    # The row of 10 is there twice.
    rows = documents([(10, inner), (10, inner), (12, inner)], 1).union(documents([(3, f"x {passage} y")], 1))
    paths = substrings.compacted(substrings.repeated_spans(rows, chunk=chunk)).collect()
    got = {(p.doc_id, p.start, p.end, p.source, p.source_start) for p in paths if p.doc_id == 10}
    assert got == {(10, 0, 20, 3, 1), (10, 23, 43, 3, 1)}
    removed = rows_of(substrings.without_repeats(rows).select("doc_id", "n_words", "n_removed"))
    assert removed == [(3, 22, 0), (10, 44, 40), (10, 44, 40), (12, 44, 44)]


def test_substrings_of_odd_rows(documents):
    text = " ".join(f"w{i}" for i in range(20))
    odd = documents([(None, text), (2, text), (2, text), (5, text + " end"), (8, None)])
    got = rows_of(substrings.without_repeats(odd).select("doc_id", "n_words", "n_removed").fillna(-1))
    assert got == [(-1, 20, 0), (2, 20, 0), (2, 20, 0), (5, 21, 20), (8, 0, 0)]
    assert substrings.without_repeats(odd.limit(0)).collect() == []


def test_benchmark_hits(spark, documents, corpus):
    items = [
        (2, corpus[5][1]), (10, corpus[6][1].upper() + "!"), (1, "is it, OF the"), (3, "one"), (4, None), (5, "--"),
        (6, corpus[7][1]), (6, corpus[8][1]), (7, "Üñï ça dé"), (8, corpus[5][1]),
    ]
    table = spark.createDataFrame(items, ITEMS)
    want = sorted(brute.hits(corpus, items))
    assert any(r[3] > 1 for r in want)
    assert rows_of(decontaminate.hits(documents(corpus), table)) == want
    assert not any(r[5] for r in rows_of(decontaminate.hits(documents(corpus), table.limit(0))))


def test_benchmark_groups_give_the_same(corpus):
    items = [(str(i), decontaminate.item_words((t or "").encode())) for i, t in corpus[:20]]
    texts = [(t or "").encode() for _, t in corpus]
    whole = [(h.tolist(), i) for _, h, i in decontaminate.Matcher([items], 10)(texts)]
    parts = [(h.tolist(), i) for _, h, i in decontaminate.Matcher([items[:7], items[7:9], items[9:]], 10)(texts)]
    assert whole == parts


def test_cutting_benchmark_passages(spark, documents):
    passage = " ".join(f"q{i}" for i in range(12))
    table = spark.createDataFrame([(1, passage)], ITEMS)
    clean = " ".join(f"c{i}" for i in range(30))
    docs = documents([(1, f"{clean}. {passage}! {clean}"), (2, clean), (3, passage), (4, None), (None, "")])
    got = {r.doc_id: r.text for r in decontaminate.decontaminated(docs, table).collect()}
    assert got == {1: f"{clean}. ! {clean}", 2: clean, 4: None, None: ""}


def test_base_spans(documents, corpus):
    got = pii.spans(documents(corpus), models={})
    assert rows_of(got) == sorted(brute.pii(corpus))
    assert pii.spans(documents(corpus).limit(0), models={}).collect() == []


def test_redaction_keeps_all_else(documents):
    docs = documents([(1, "é a@b.co, 10.0.0.1 é"), (2, None), (3, "clean"), (None, "a@b.co")])
    got = {r.doc_id: r.text for r in pii.redacted(docs, {}).collect()}
    assert got == {1: "é [EMAIL], [IP] é", 2: None, 3: "clean", None: "[EMAIL]"}


def test_check_digit(spark):
    numbers = ["4111111111111111", "4111111111111112", "0" * 13, "79927398713", "1234567812345670"]
    df = spark.createDataFrame([(n,) for n in numbers], "d string")
    got = [r[0] for r in df.select(pii.passes_check_digit(F.col("d"))).collect()]
    assert got == [brute.luhn(n) for n in numbers]


def test_quality_counts(spark, documents, corpus):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.judged(documents(corpus), labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    assert rows_of(got) == sorted(brute.quality(corpus))


def test_pieces_hold_the_tokenizers_ids(documents, corpus):
    from tokenizers import Tokenizer

    odd = [*corpus, (600, "don't <|endoftext|>x I'LĹ ́y z 12 345 ΑΣ İ"), (None, "x")]
    want = brute.pieces(odd, Tokenizer.from_file(packing.tokenizer_path()))
    assert rows_of(packing.pieces(documents(odd)).fillna(-1, "doc_id")) == sorted(
        (-1 if d is None else d, *rest) for d, *rest in want
    )


@pytest.mark.parametrize("remembered", [1, packing.REMEMBERED])
def test_words_encoded_together_keep_their_ids(monkeypatch, remembered):
    monkeypatch.setattr(packing, "REMEMBERED", remembered)
    encoder = packing._Encoder(packing.tokenizer_path())
    pick = np.random.default_rng(3)
    units = ["canción", "Été,", "straße", "ÿ", "a÷b", "ABC...", "it's", "x<|endoftext|>", "é́t", "日本語", "12a", "!?", "ﬁn", "q" * 300]
    texts = [" ".join(pick.choice(units, 40)) + "\u00a0" + "".join(pick.choice(list("abçß"), 9)) for _ in range(30)] + ["", " \n"]
    for group in (texts[:7], texts[7:], texts):
        for text, ids in zip(group, encoder.many([t.encode() for t in group]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == encoder.model.encode(text, add_special_tokens=False).ids


def placed_well(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("per_task", [5, 60, 10_000])
def test_packing(spark, per_task):
    lengths = np.random.default_rng(1).integers(1, 101, 500).tolist() + [100, 1, 50, 50]
    df = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "id long, length long").repartition(4)
    got = packing.pack(df, 100, per_task).collect()
    assert sorted(r.length for r in got) == sorted(lengths)
    n = placed_well(got, 100)
    best = packing.lower_bound(np.array(lengths), 100)
    assert best <= n <= best * (1.35 if per_task == 5 else 1.05)


def test_packing_nothing(documents):
    assert packing.pack_documents(documents([(1, "x")]).limit(0)).collect() == []


def test_bound_is_never_above_the_optimum():
    r = np.random.default_rng(2)
    for _ in range(200):
        # Bins that are full by construction.
        bins, lengths = int(r.integers(1, 6)), []
        for _ in range(bins):
            cuts = np.unique(r.integers(1, 60, r.integers(0, 5)))
            lengths += np.diff(np.concatenate(([0], cuts, [60]))).tolist()
        lengths = np.array(lengths)
        assert packing.lower_bound(lengths, 60) == bins
        assert packing.best_fit(lengths, 60)[2] >= bins
    assert packing.lower_bound(np.array([31, 31, 31]), 60) == 3


@pytest.mark.parametrize("per_task", [7, 10_000])
def test_sharding(documents, corpus, per_task):
    rows = [*corpus, *((700 + i, "hot " * 50) for i in range(60)), (None, "x"), (1, corpus[1][1])]
    got = sharding.shard_documents(documents(rows), 5, per_task, run_rows=20).collect()
    assert len(got) == len(rows)
    texts = defaultdict(set)
    for r in got:
        texts[r.text_crc32, r.size].add(r.shard)
    assert all(len(s) == 1 for s in texts.values())
    for k in range(5):
        slots = sorted(r.slot for r in got if r.shard == k)
        assert slots == list(range(len(slots)))
    assert sorted(r.size for r in got) == sorted(len((t or "").encode()) + 16 for _, t in rows)
    assert sharding.shard_documents(documents(rows).limit(0)).collect() == []


def test_differencing_balances_better_than_dealing():
    r = np.random.default_rng(3)
    sizes = np.sort(r.integers(1, 10**6, 300))[::-1]
    loads = np.zeros((300, 4), np.int64)
    loads[:, 0] = sizes
    moved, total = sharding.differenced(loads)
    sums = np.bincount(moved[:, 0], sizes, 4).astype(np.int64)
    assert sorted(sums) == sorted(total)
    assert sums.max() - sums.min() < 1000


def test_encoded_texts_lie_in_one_array_and_the_tokenizer_is_loaded_once():
    import pyarrow as pa

    encoder = packing._encoder(packing.tokenizer_path())
    assert packing._encoder(packing.tokenizer_path()) is encoder
    texts = [b"Word, word", None, b"", b"  \x0b a<b 's \xc3\x89t\xc3\xa9 \n", b"it's 12 w", b"word,"]
    ids, bounds = encoder.ids_of(pa.array(texts, pa.binary()))
    for k, text in enumerate(texts):
        plain = encoder.model.encode((text or b"").decode(), add_special_tokens=False).ids
        assert ids[bounds[k] : bounds[k + 1]].tolist() == plain
    batch = pa.record_batch([pa.array(range(6)), pa.array(texts, pa.binary())], names=["doc_id", "text"])
    for most in (1, 10, 1000):
        assert pa.Table.from_batches(packing._groups(batch, most)).to_pylist() == batch.to_pylist()

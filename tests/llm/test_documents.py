"""Operators on documents against brute force, over odd rows and random ones."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import (
    DOCUMENTS,
    LOREM,
    Groups,
    documents,
    hits,
    jaccard,
    line_key,
    lines_left,
    odd_rows,
    plain_words,
    removed,
    shingles,
    space_words,
)

from waybill.llm import (
    decontamination,
    graph,
    jaccard_join,
    line_dedup,
    suffix_dedup,
)
from waybill.llm.cuckoo import CuckooFilter


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def random_rows(n, seed, words=40, vocabulary=400):
    """Random texts, some of them edited copies of others."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        if rows and rng.random() < 0.6:
            text = rng.choice(rows)[1].split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                text[rng.randrange(len(text))] = f"w{rng.randrange(vocabulary)}"
        else:
            text = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(1, words))]
        rows.append((i * 7 % 1009, " ".join(text), "en", "s"))
    return rows


# ---- suffix dedup

@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("hot", [1, 1024])
def test_suffix_dedup_is_brute_force(spark, keep, hot):
    rng = random.Random(3)
    base = ["".join(rng.choice("abc ü") for _ in range(150)) for _ in range(4)]
    rows = [(i, "".join(rng.choice(base)[:rng.randrange(150)] for _ in range(3)), "en", "s")
            for i in range(40)] + [(90, "a" * 100, "", ""), (91, "ab" * 60, "", ""),
                                   (92, None, "", ""), (93, "", "", ""), (None, base[0], "", "")]
    got = suffix_dedup.suffix_dedup(documents(spark, rows), length=30, anchor=8, keep=keep,
                                    hot=hot).collect()
    want = removed(rows, 30, keep)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                   for r in got) == want
    for r in got:
        if r.text.isascii():
            assert len(r.text) == r.n_bytes - r.n_removed


def test_suffix_dedup_of_odd_rows(spark):
    rows = [r for r in odd_rows() if r[0] not in (7, 8)]
    got = suffix_dedup.digest(suffix_dedup.suffix_dedup(
        documents(spark, rows), length=60, anchor=20, keep="none")).collect()
    assert Counter(tuple(r) for r in got) == removed(rows, 60, "none")
    long = [r for r in odd_rows() if r[0] in (7, 8)]
    whole = {r.doc_id: r.n_removed for r in
             suffix_dedup.suffix_dedup(documents(spark, long), keep="first").collect()}
    assert whole[8] >= whole[7] > 0  # the text also repeats within itself
    assert suffix_dedup.suffix_dedup(empty(spark)).count() == 0


def test_suffix_dedup_cuts_long_texts_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 97)
    rng = random.Random(4)
    base = "".join(rng.choice("abcd") for _ in range(500))
    rows = [(1, base, "", ""), (2, base[100:400] + base[:50], "", ""), (3, base[250:], "", "")]
    got = {}
    for keep in ("none", "first"):
        pieces = list(suffix_dedup._pieces(np.array([0, 500]), 40))
        assert pieces[0][1] - pieces[0][0] == 97 + 39
        got[keep] = Counter(tuple(r) for r in suffix_dedup.digest(suffix_dedup.suffix_dedup(
            documents(spark, rows), length=40, anchor=10, keep=keep)).collect())
        assert got[keep] == removed(rows, 40, keep)


def test_a_blocks_runs_are_made_once(monkeypatch):
    made = []
    runs = suffix_dedup._runs
    monkeypatch.setattr(suffix_dedup, "_runs", lambda *a: made.append(1) or runs(*a))
    rng = np.random.default_rng(5)
    part = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(40), pa.int64()), "text": [
        "".join(rng.choice(list("abcd "), 300)) for _ in range(40)]})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema) as out:
        out.write_batch(part)
    packed = sink.getvalue().to_pybytes()
    block = suffix_dedup.Block.of(packed, 30, 8, again=True)
    held = list(block.runs())
    assert held and len(made) == len(list(suffix_dedup._pieces(block.offsets, 30)))
    monkeypatch.setattr(suffix_dedup, "HELD", 0)
    again = list(suffix_dedup.Block.of(packed, 30, 8, again=True).runs())
    assert [x[0].low.tolist() for x in held] == [x[0].low.tolist() for x in again]


def test_suffix_ranks_order_suffixes():
    text = b"banana bandana banana"
    data = np.frombuffer(text, np.uint8)
    room = np.arange(len(text), 0, -1)
    for depth in (1, 3, 6, 8, 11):
        rank = suffix_dedup.suffix_ranks(data, room, depth)
        parts = [text[i:i + depth] for i in range(len(text) - depth + 1)]
        order = {p: i for i, p in enumerate(sorted(set(parts)))}
        assert rank[:len(parts)].tolist() == [order[p] for p in parts]
        assert (rank[len(parts):] == -1).all()


# ---- Jaccard join

def test_jaccard_of_odd_rows(spark):
    got = jaccard_join.jaccard_components(documents(spark, odd_rows())).collect()
    assert Counter(tuple(r) for r in got) == jaccard(odd_rows())
    assert jaccard_join.jaccard_components(empty(spark)).count() == 0


@pytest.mark.parametrize("seed, chunk", [(1, 2048), (2, 4), (3, 2)])
def test_jaccard_is_brute_force(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)  # small: groups of several chunks
    rows = random_rows(150, seed)
    got = jaccard_join.jaccard_components(documents(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == jaccard(rows)


def test_jaccard_threshold_is_inclusive(spark):
    base = [f"w{i}" for i in range(39)]  # 35 shingles
    rows = [(1, " ".join(base), "", ""), (2, " ".join([*base[:34], *"abcde"]), "", "")]
    # 30 of 40 shingles in common
    got = jaccard_join.jaccard_components(documents(spark, rows)).collect()
    assert {r.component_id for r in got} == {1}
    rows[1] = (2, " ".join([*base[:33], *"abcdef"]), "", "")
    got = jaccard_join.jaccard_components(documents(spark, rows)).collect()
    assert {r.component_id for r in got} == {1, 2}


def test_deduplicate_keeps_columns_and_rows_without_id(spark):
    docs = documents(spark, odd_rows())
    out = jaccard_join.deduplicate(docs)
    assert out.columns == docs.columns
    ids = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    want = {c for i, n, c in jaccard(odd_rows()) if c is not None}
    assert set(ids) == want
    assert out.where("doc_id is null").count() == 2


def test_deduplicate_tells_rows_of_one_id_apart(spark):
    a, b, c = LOREM, "another text of its own with more than five words", "a third one " * 9
    rows = [(1, a, "en", "s"), (5, a, "en", "s"), (5, b, "en", "s"), (7, c, "en", "x"),
            (7, c, "de", "y"), (7, c, "en", "x"), (8, b + " x", "en", "s"), (9, "", "en", "s"),
            (9, "", "en", "s"), (None, a, "en", "s"), (None, a, "en", "s"), (3, b, "en", "s")]
    out = jaccard_join.deduplicate(documents(spark, rows)).collect()
    got = Counter((r.doc_id, r.text) for r in out)
    assert got == {(1, a): 1, (3, b): 1, (7, c): 1, (9, ""): 2, (None, a): 2}
    assert jaccard_join.deduplicate(documents(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_deduplicate_is_brute_force(spark, seed):
    """One row a component, over rows that share ids and texts."""
    rows = [(r[0] and r[0] % 40, *r[1:]) for r in random_rows(150, seed)]
    rows += rows[:30]
    sets, groups = [shingles(r[1]) for r in rows], Groups()
    for i, s in enumerate(sets):
        for j in range(i):
            if s and rows[i][0] is not None and rows[j][0] is not None and (
                    100 * len(s & sets[j]) >= 75 * len(s | sets[j])):
                groups.join(i, j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[groups.find(i)].append(rows[i])
    out = Counter((r.doc_id, r.text) for r in
                  jaccard_join.deduplicate(documents(spark, rows)).collect())
    assert sum(out.values()) == len(members)
    for own in members.values():
        least = min((r[0] for r in own if r[0] is not None), default=None)
        held = [r for r in {(r[0], r[1]) for r in own} if out[r]]
        assert [r[0] for r in held] == [least]


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 80)]
    edges = spark.createDataFrame([*path, *star, (5, 5), (None, 3), (2000, 1999)],
                                  "u long, v long")
    got = {r.node: r.component for r in graph.components(edges).collect()}
    assert got == ({i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(80)}
                   | {1999: 1999, 2000: 1999})
    assert graph.components(edges.where("u = v")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_components_are_brute_force(spark, seed):
    rng, groups = random.Random(seed), Groups()
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(rng.choice((60, 100, 300)))]
    pairs += pairs[:20] + [(b, a) for a, b in pairs[20:40]]
    for a, b in pairs:
        groups.join(a, b)
    edges = spark.createDataFrame(pairs, "u long, v long")
    got = Counter((r.node, r.component) for r in graph.components(edges).collect())
    assert got == Counter((i, groups.find(i)) for i in {x for a, b in pairs if a != b
                                                        for x in (a, b)})


def test_components_of_stars_take_no_round(spark, monkeypatch):
    written, kept = [], graph.kept
    monkeypatch.setattr(graph, "kept", lambda df, name: written.append(name) or kept(df, name))
    star = spark.createDataFrame([(i % 3, 10 + i) for i in range(30)] * 2, "u long, v long")
    got = {r.node: r.component for r in graph.components(star).collect()}
    assert got == {i: i for i in range(3)} | {10 + i: i % 3 for i in range(30)}
    assert len(written) == 1


def test_a_chunk_of_near_copies_is_counted_not_probed(monkeypatch):
    probed, probe, isin = [], jaccard_join.Chunk._probe, np.isin
    monkeypatch.setattr(jaccard_join.Chunk, "_probe",
                        staticmethod(lambda a, b: probed.append(1) or probe(a, b)))
    monkeypatch.setattr(np, "isin", lambda *a, **b: probed.append(1) or isin(*a, **b))
    rng, docs = np.random.default_rng(0), 300
    base = np.arange(1, 101, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, 90, replace=False),
                                      np.arange(5, dtype=np.uint64) + np.uint64(1000 + 5 * i)]))
            for i in range(docs)]
    rows = pa.table({"doc": range(docs), "n": [len(s) for s in sets],
                     "shingles": [s.tobytes() for s in sets], "asks": [True] * docs,
                     "label": range(docs)})
    groups = Groups()
    for i in range(docs):
        for j in range(i):
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j])):
                groups.join(i, j)
    probed.clear()
    got = jaccard_join._join(75)(rows).to_pylist()
    assert len(probed) < docs  # 37,675 where each candidate is probed
    # a label is at most once a start, and hangs on the smallest one
    assert {r["u"]: r["v"] for r in got} == {i: groups.find(i) for i in range(docs)
                                             if groups.find(i) != i}
    assert len(got) == len({r["u"] for r in got}) > docs / 2


def test_groups_of_several_chunks_are_connected_once(spark, monkeypatch):
    calls, components = [], jaccard_join.components
    monkeypatch.setattr(jaccard_join, "CHUNK", 8)
    monkeypatch.setattr(jaccard_join, "components",
                        lambda edges: calls.append(1) or components(edges))
    parts = [" ".join(f"p{i}w{j}" for j in range(30)) for i in range(12)]
    rng, chosen = random.Random(0), list(combinations(parts, 6))
    rows = [(i, " ".join(x), "", "") for i, x in enumerate(rng.sample(chosen, 60))]
    got = jaccard_join.jaccard_components(documents(spark, rows)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(i, i) for i in range(60)}
    assert Counter(tuple(r) for r in got) == jaccard(rows)
    assert len(calls) == 1  # no link was found between chunks


# ---- line dedup

def digest_of(rows, left):
    return Counter(
        (r[0], len((r[1] or "").split("\n")),
         hashlib.sha256((t or "").encode()).hexdigest()) for r, t in zip(rows, left, strict=True))


def line_rows():
    rng = random.Random(8)
    lines = [f"this is a common line number {i}" for i in range(12)] + ["short", "", "  Short "]
    rows = [(i, "\n".join(rng.choice(lines) + rng.choice(["", " ", "\t"])
                          for _ in range(rng.randrange(9))), "en", "s") for i in range(40)]
    return rows + [(99, "THIS is a common line number 1\nthis is a common line number 1", "", ""),
                   (100, "ü" * 19, "", ""), (101, "ü" * 19, "", ""), (102, "ü" * 19, "", ""),
                   (103, "ü" * 20, "", ""), (104, "ü" * 20, "", ""), (105, "ü" * 20, "", "")]


@pytest.mark.parametrize("rows", [odd_rows(), line_rows()], ids=["odd", "random"])
@pytest.mark.parametrize("sent", [0, 64 << 20], ids=["joined", "filtered"])
def test_line_dedup_is_brute_force(spark, monkeypatch, rows, sent):
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", sent)
    docs = documents(spark, rows)
    store = line_dedup.store_of(docs)
    got = line_dedup.digest(line_dedup.rewritten(store, docs)).collect()
    assert Counter((r.doc_id, r.n_lines, r.kept_sha256) for r in got) == digest_of(
        rows, lines_left(rows))
    out = line_dedup.dedup(store, docs)
    assert out.columns == docs.columns
    assert Counter(r.text for r in out.collect()) == Counter(lines_left(rows))


def test_line_dedup_counts_dropped_lines(spark):
    docs = documents(spark, line_rows())
    rows = line_dedup.rewritten(line_dedup.store_of(docs), docs).collect()
    for r, (text, n_lines, n_dropped) in ((x.row.doc_id, x[1:]) for x in rows):
        before = next(t for i, t, *_ in line_rows() if i == r)
        after = len(text.split("\n")) if text or n_dropped < n_lines else 0
        assert n_lines == len(before.split("\n")) and n_dropped == n_lines - after


def test_rows_with_one_doc_id_lose_only_their_own_lines(spark):
    common = "this line is held by three documents"
    rows = [(1, f"{common}\na clean line of the first text\nx", "", ""),
            (1, f"a clean line of the other text\n{common}\n{common}", "", ""),
            (1, "a third text, all of whose lines are clean\nshort", "", ""),
            (2, common, "", ""), (3, f"{common}\nof the last document", "", "")]
    docs = documents(spark, rows)
    got = line_dedup.digest(line_dedup.rewritten(line_dedup.store_of(docs), docs)).collect()
    assert Counter((r.doc_id, r.n_lines, r.kept_sha256) for r in got) == digest_of(
        rows, lines_left(rows))
    assert sorted((r.doc_id, r.n_lines, r.n_dropped) for r in got) == [
        (1, 2, 0), (1, 3, 1), (1, 3, 2), (2, 1, 1), (3, 2, 0)]


def test_line_store_can_be_undone(spark):
    rows = line_rows()
    docs = documents(spark, rows)
    part = docs.where("doc_id % 3 <> 0")
    rest = docs.where("doc_id % 3 = 0")
    whole = line_dedup.store_of(docs)
    steps = line_dedup.insert(line_dedup.insert(line_dedup.empty_store(spark), part), rest)
    back = line_dedup.delete(steps, rest.select("doc_id"))
    alone = line_dedup.store_of(part)

    def state(store):
        return sorted(map(tuple, store.counts.collect()))

    assert state(steps) == state(whole)
    assert state(back) == state(alone)
    assert state(line_dedup.insert(steps, part)) == state(whole)  # known documents add nothing
    left = lines_left([r for r in rows if r[0] % 3])
    assert Counter(r.text for r in line_dedup.dedup(back, part).collect()) == Counter(left)
    # filters know every counted key
    filters = {r.shard: CuckooFilter.load(r.data) for r in back.filters.collect()}
    for r in back.counts.collect():
        assert filters[r.shard].contains(np.array([r.k1]).view(np.uint64)).all()
    nothing = line_dedup.delete(back, docs.select("doc_id"))
    assert state(nothing) == []


def test_line_dedup_of_nothing(spark):
    docs = empty(spark)
    assert line_dedup.dedup(line_dedup.store_of(docs), docs).count() == 0
    assert line_key(" A\x0b") == "a"


# ---- benchmark decontamination

BENCH = [(1, LOREM), (2, "seven old owls"), (3, "a quiet lake"), (4, ""), (5, None), (None, "one"),
         (6, "--"), (7, LOREM), (7, "jumps over"), (10, "Ünï çødé")]


def bench(spark, rows=None):
    return spark.createDataFrame(BENCH if rows is None else rows,
                                 "item_id long, text string")


@pytest.mark.parametrize("size", [decontamination.SLICE, 3])
def test_decontamination_is_brute_force(spark, size):
    rows = odd_rows() + [(30, "x " + " ".join(LOREM.split()[3:14]) + " y", "", ""),
                         (31, " ".join(LOREM.split()[3:12]), "", "")]
    got = decontamination.digest(decontamination.scan(
        documents(spark, rows), bench(spark), size=size)).collect()
    want = Counter(
        (r[0], n, len(places), len(items), decontamination.sha256_of(items), bool(places))
        for r, (n, places, items) in zip(rows, hits(rows, BENCH), strict=True))
    assert Counter(tuple(r) for r in got) == want


def test_decontamination_removes_documents_or_spans(spark):
    rows = [(1, f"Before. {LOREM}! After.", "", ""), (2, "nothing here", "", ""), (3, None, "", "")]
    docs = documents(spark, rows)
    out = decontamination.decontaminate(docs, bench(spark, [(1, LOREM)]))
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [2, 3]
    cut = {r.doc_id: r.text for r in decontamination.decontaminate(
        docs, bench(spark, [(1, LOREM)]), remove="spans").collect()}
    assert cut == {1: "Before. ! After.", 2: "nothing here", 3: None}


@pytest.mark.parametrize("size", [decontamination.SLICE, 3])
def test_passages_without_item_id_are_removed_too(spark, size):
    rows = [(1, f"Before. {LOREM}! After.", "", ""), (2, "nothing here", "", "")]
    docs, items = documents(spark, rows), bench(spark, [(None, LOREM), (5, "nothing at all")])
    out = decontamination.decontaminate(docs, items)
    assert [r.doc_id for r in out.collect()] == [2]
    cut = decontamination.decontaminate(docs, items, remove="spans").collect()
    assert sorted(r.text for r in cut) == ["Before. ! After.", "nothing here"]
    digest = lambda **more: {r.doc_id: tuple(r)[1:4] for r in decontamination.digest(
        decontamination.scan(docs, items, size=size, **more)).collect()}
    n = len(LOREM.split())
    assert digest() == {1: (n + 2, n, 0), 2: (2, 0, 0)}
    assert digest(unnamed=False) == {1: (n + 2, 0, 0), 2: (2, 0, 0)}


def test_decontamination_with_empty_tables(spark):
    docs = documents(spark, odd_rows())
    none = decontamination.decontaminate(docs, bench(spark, [(None, "x")]))
    assert none.count() == len(odd_rows())
    assert decontamination.scan(empty(spark), bench(spark)).count() == 0


def test_word_helpers_agree():
    assert plain_words("A-b ü9!") == ["a", "b", "ü9"] and space_words(" A-b\tc") == ["a-b", "c"]

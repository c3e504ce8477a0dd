"""The Merkle manifest against a plain tree."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from llm_cases import documents, odd_rows
from pyspark.sql import functions as F

from waybill.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, arity):
    """All levels, from the leaves."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def climb(levels, at, node, arity):
    """(siblings in order, folded top)."""
    proof = ""
    for level in levels[:-1]:
        lo = at // arity * arity
        left, right = level[lo:at], level[at + 1:lo + arity]
        proof += "".join([*left, *right])
        node, at = sha(*left, node, *right), at // arity
    return proof, node


def plain(rows, arity=2):
    """Rows (doc_id, source, lang, n_chars, text) to the counted results."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees, kept = {}, {}
    for name in names:
        kept[name] = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = tree([leaf(r) for r in kept[name]], arity)
    top = tree([trees[x][-1][0] for x in names], arity)
    out = Counter()
    for i, name in enumerate(names):
        for at, r in enumerate(kept[name]):
            new = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                new = (*r[:3], r[3] + 1, r[4])
            a, sub = climb(trees[name], at, leaf(new), arity)
            b, root = climb(top, i, sub, arity)
            out[(r[0], leaf(r), trees[name][-1][0], top[-1][0], sha(a + b), root,
                 root == top[-1][0])] += 1
    return out


def audited(docs, form=None):
    form = form or merkle.shape()
    out = merkle.audit(merkle.build(docs, changed=merkle.tampered(F.col("doc_id")), form=form))
    assert out.columns == ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                           "verified"]
    return Counter(tuple(r) for r in out.collect())


def as_fields(rows):
    return [(i, s, lang, None if t is None else len(t), t) for i, t, lang, s in rows]


def test_odd_rows(spark):
    rows = odd_rows()
    assert audited(documents(spark, rows)) == plain(as_fields(rows))


@pytest.mark.parametrize("arity,chunk", [(2, 2), (2, 4), (2, 8), (3, 9), (5, 5), (2, 1024)])
def test_chunks_and_arity(spark, arity, chunk):
    """One group holds a third of all rows; groups end at, before and behind chunk limits."""
    sizes = {"a": 1, "b": 2, "c": 7, "d": 8, "e": 9, "é": 70, None: 17, "": 16, "B": 4, "z": 3}
    rows, at = [], 1000
    for name, n in sizes.items():
        for _ in range(n):
            rows.append((at * 37 % 1009, f"text {at}", name, "s"))
            at += 1
    assert len({r[0] for r in rows}) == len(rows)
    form = merkle.shape(arity, chunk)
    docs = documents(spark, rows).repartition(5)
    got = audited(docs, form)
    assert got == plain(as_fields(rows), arity)
    bad = [k for k in got if not k[-1]]
    assert len(bad) == sum(zlib.crc32(str(r[0]).encode()) % 7 == 0 for r in rows) > 5


def test_one_group_one_row_and_none(spark):
    one = [(7, "x", "en", "s")]
    assert audited(documents(spark, one)) == plain(as_fields(one))
    assert merkle.roots(merkle.build(documents(spark, one))).collect()[0].key == "sen"
    assert audited(documents(spark, one).limit(0)) == Counter()


def test_parent_keeps_states_before_each_slot():
    children = [sha(str(i)).encode() for i in range(4)]
    parent = merkle.Parent(children)
    for slot in range(4):
        changed = [*children[:slot], b"new", *children[slot + 1:]]
        assert parent.fold(slot, b"new").decode() == hashlib.sha256(b"".join(changed)).hexdigest()
        assert parent.states[slot].digest() == hashlib.sha256(b"".join(children[:slot])).digest()
    assert parent.digest.decode() == hashlib.sha256(b"".join(children)).hexdigest()


def test_fields_do_not_run_together(spark):
    rows = spark.createDataFrame([("a", "b1:c"), ("a1:b", "c"), (None, "-"), ("-", None)],
                                 "x string, y string")
    assert rows.select(merkle.leaf([F.col("x"), F.col("y")]).alias("d")).distinct().count() == 4

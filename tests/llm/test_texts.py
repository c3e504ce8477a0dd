import random
import re

import numpy as np
import pyarrow as pa
import pytest

from waybill.llm import texts
from waybill.llm.cuckoo import CuckooFilter

RNG = random.Random(5)
ALPHABET = ["a", "B", "ü", "é", "9", " ", "\n", "\t", "-", "\x0b", "😀", " ", "Z"]


def random_texts(n, size):
    return ["".join(RNG.choice(ALPHABET) for _ in range(RNG.randrange(size))) for _ in range(n)]


@pytest.mark.parametrize("piece", [7, 64, 1 << 19])
@pytest.mark.parametrize("inside, pattern", [
    (texts.NOT_SPACE, rb"[^\x20\x09-\x0D]+"), (texts.ALNUM, rb"[0-9A-Za-z\x80-\xff]+")])
def test_words_are_those_of_the_pattern(monkeypatch, piece, inside, pattern):
    monkeypatch.setattr(texts, "PIECE", piece)
    rows = [*random_texts(60, 80), "", "x" * 300, "Aa" * 40 + " " + "b" * 90]
    data, offsets = texts.utf8(pa.array(rows))
    h, begin, end, ranges = texts.words(data, offsets, inside)
    by_word = {}
    for i, text in enumerate(rows):
        want = [m.group() for m in re.finditer(pattern, text.encode())]
        at = range(ranges[i], ranges[i + 1])
        assert [data[begin[j]:end[j]].tobytes() for j in at] == want
        for j, w in zip(at, want, strict=True):
            assert by_word.setdefault(w.lower(), h[j]) == h[j]
    assert len(set(by_word.values())) == len(by_word)


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    rows = random_texts(40, 200)
    data, offsets = texts.utf8(pa.array(rows))
    one = texts.words(data, offsets, texts.ALNUM)[0]
    monkeypatch.setattr(texts, "PIECE", 11)
    assert (texts.words(data, offsets, texts.ALNUM)[0] == one).all()


def test_grams_tell_order_apart():
    h = texts.mix(np.array([1, 2, 1, 2, 1], np.uint64))
    g = texts.grams(h, 2)
    assert g[0] == g[2] and g[0] != g[1]
    assert len(texts.grams(h, 6)) == 0


def test_nulls_are_empty_and_slices_start_at_zero():
    column = pa.array(["ab", None, "", "ü"])
    data, offsets = texts.utf8(column)
    assert offsets.tolist() == [0, 2, 2, 2, 4]
    data, offsets = texts.utf8(column.slice(2))
    assert data.tobytes().decode() == "ü" and offsets.tolist() == [0, 0, 2]
    assert texts.utf8(pa.array([], pa.string()))[1].tolist() == [0]


def test_cuckoo_filter_holds_what_was_inserted_and_gives_up_what_was_deleted():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 20_000).astype(np.uint64))
    one, two = keys[::2], keys[1::2]
    held = CuckooFilter.of(one)
    assert held.contains(one).all()
    assert held.contains(two).mean() < 0.002
    held.insert(two[:3000])
    assert held.contains(two[:3000]).all()
    held.delete(one[:5000])
    assert held.contains(one[5000:]).all() and held.contains(two[:3000]).all()
    assert held.contains(one[:5000]).mean() < 0.01
    again = CuckooFilter.load(held.dump())
    assert (again.table == held.table).all()
    with pytest.raises(KeyError):
        held.delete(np.array([12345], np.uint64))


def test_cuckoo_filter_grows_for_its_keys_and_may_be_empty():
    assert not CuckooFilter.of(np.zeros(0, np.uint64)).contains(np.array([7], np.uint64)).any()
    same = texts.mix(np.arange(5000).astype(np.uint64))
    assert CuckooFilter.of(same).contains(same).all()

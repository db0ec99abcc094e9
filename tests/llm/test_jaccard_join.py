import re
from itertools import combinations

import pytest

from pricewright.llm import jaccard_join as J
from tests.llm.conftest import prose

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sets(texts, n):
    out = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(_LOWER))
        out.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    return out


def groups(texts, n, percent):
    s = sets(texts, n)
    root = list(range(len(s)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(s)), 2):
        if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(s))], [len(x) for x in s]


def links(texts, n, percent):
    s = sets(texts, n)
    found = [0] * len(s)
    for i, j in combinations(range(len(s)), 2):
        if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
            found[i] += 1
            found[j] += 1
    return found


def family(seed, size, edits):
    """Near copies: the base with some words changed; at many edits only some pairs link."""
    import random

    r, base = random.Random(seed), prose(seed, 120).split()
    out = []
    for k in range(size):
        words = list(base)
        for _ in range(r.randint(0, edits)):
            words[r.randrange(len(words))] = f"edit{seed}x{k}x{r.random()}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80), (3, 40)])
def test_components_match_brute_force(spark, words, percent):
    texts = [None, "", " \n", "one", "One", "a b", "a b c d", "A B C D", *family(1, 12, 2), *family(2, 25, 5), *(prose(i, 60) for i in range(10, 20))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want, size = groups(texts, words, percent)
    for count in (False, True):
        got = {r.doc_id: r for r in J.component_ids(J.jaccard_components(docs, words, percent, count=count), "doc_id").collect()}
        assert [got[i].n_shingles for i in range(len(texts))] == size
        assert [got[i].component_id for i in range(len(texts))] == want
    assert [got[i].n_links for i in range(len(texts))] == links(texts, words, percent)


def test_small_tiles_and_heavy_tokens_change_nothing(spark, monkeypatch):
    texts = [*family(3, 40, 6), *(prose(i, 40) + " " + prose(99, 30) for i in range(30))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want, _ = groups(texts, 4, 85)
    for name, value in (("TILE", 3), ("TILE_ROWS", 8), ("TILE_TOKENS", 500), ("BANDED", 4), ("GROUP", 50), ("SUMMED", 1), ("ROUNDS", 1), ("CROWDED", 0)):
        monkeypatch.setattr(J, name, value)
    for count in (False, True):
        got = {r.doc_id: r for r in J.component_ids(J.jaccard_components(docs, 4, 85, count=count), "doc_id").collect()}
        assert [got[i].component_id for i in range(len(texts))] == want
    assert [got[i].n_links for i in range(len(texts))] == links(texts, 4, 85)


def test_no_rows_leave_a_task_for_a_pair(spark, monkeypatch):
    """A family whose pairs all link: a tile tells a forest, at most one row for each of its documents, and their counts."""
    texts = family(5, 60, 2)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    told = []
    monkeypatch.setattr(J, "_stars", lambda placed, *_: (None, placed))

    class Kept(J.Scratch):
        def written(self, df, name, large=False):
            out = super().written(df, name, large)
            told.extend([(name, out.count(), out.select("tile", "id").distinct().count() if name == "open" else 0)] if name in ("open", "settled") else [])
            return out

    monkeypatch.setattr(J, "Scratch", Kept)
    for count in (False, True):
        told.clear()
        J.jaccard_components(docs, 4, 85, count=count).collect()
        (_, opened, entries), (_, settled, _) = told
        assert opened == entries and settled < (1 + count) * opened


def test_awkward_rows(spark, docs):
    out = J.component_ids(J.jaccard_components(docs, 5, 80), "doc_id")
    rows = out.collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r.component_id)
    assert by[0] == [0] and by[1] == [1] and by[2] == [2]  # nothing to link
    assert by[5] == [5, 5] and by[6] == [5] and by[7] == [5]  # copies, a repeated row, a near copy
    assert sorted(by[None], key=str) == [5, None]  # a copy without an id, and a row of nulls
    assert by[15] == by[16] == [15]  # case aside equal


def test_one_of_each(spark, docs, no_docs):
    kept = J.one_of_each(docs, "doc_id")
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert kept.columns == docs.columns
    assert ids.count(5) == 1 and 6 not in ids and 7 not in ids and 16 not in ids
    assert {0, 1, 2, 3, 4, 15, 77} <= set(ids) and ids.count(None) == 1
    assert J.one_of_each(no_docs, "doc_id").count() == 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e", 5, "x", 3)], "doc_id long, text string, Root int, k1 string, bits int")
    out = J.jaccard_components(docs)
    assert out.columns == ["doc_id", "text", "k1", "bits", "n_shingles", "class_key", "root"]  # only what it adds is replaced
    assert (out.first().k1, out.first().bits) == ("x", 3)
    kept = J.one_of_each(docs, "doc_id")
    assert kept.columns == docs.columns and kept.first() == docs.first()


def test_signature_bounds_the_difference():
    import numpy as np

    r = np.random.default_rng(3)
    a = np.unique(r.integers(0, 1 << 62, 500).astype(np.uint64))
    b = np.unique(np.concatenate((a[:450], r.integers(0, 1 << 62, 60).astype(np.uint64))))
    differ = int(np.bitwise_count(J._signature(a).view(np.uint64) ^ J._signature(b).view(np.uint64)).sum())
    assert differ <= len(np.setxor1d(a, b))


def test_sketch_blocks_round_trip():
    import numpy as np

    for top in (3, 1000):
        part = np.zeros(J.BLOCK, np.int32)
        part[[1, 77, J.BLOCK - 1]] = (1, 2, top)
        at, back = J._unpacked(J._packed(part, np.flatnonzero(part)))
        assert at.tolist() == [1, 77, J.BLOCK - 1] and back.tolist() == [1, 2, top]

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewright.llm import suffix_dedup as S
from pricewright.llm import windows as W
from tests.llm.conftest import prose


def brute(texts, width):
    """Kept bytes, removed count and spans of each text: windows counted by their bytes."""
    count = {}
    for t in texts:
        for i in range(len(t) - width + 1):
            count[t[i : i + width]] = count.get(t[i : i + width], 0) + 1
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - width + 1):
            if count[t[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def results(docs, width, unit="bytes"):
    return S.suffix_dedup(docs, width, unit, keep_text=False)


@pytest.mark.parametrize("width", [400, 40])
def test_awkward_rows_match_brute_force(spark, docs, width):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted(map(repr, zip([i for i, _ in rows], brute([(t or "").encode() for _, t in rows], width))))
    got = sorted(repr((r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))) for r in results(docs, width).collect())
    assert got == want


def test_periodic_and_random_texts_match_brute_force(spark):
    r = random.Random(5)
    pool = ["".join(r.choice("ab") for _ in range(60)) for _ in range(4)] + ["ab" * 40, "a" * 90]
    texts = ["".join(r.choice(pool)[: r.randint(5, 90)] for _ in range(r.randint(0, 6))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in results(docs, 24).collect()}
    assert [got[i] for i in range(60)] == brute([t.encode() for t in texts], 24)


def test_split_groups_and_small_batches_change_nothing(spark, docs, monkeypatch):
    want = sorted(map(repr, results(docs, 40).select("doc_id", *S.ADDED).collect()))
    monkeypatch.setattr(S, "SPLIT", 1)
    monkeypatch.setattr(S, "MEET", 50)
    monkeypatch.setattr(S, "GROUP", 20)
    assert sorted(map(repr, results(docs, 40).select("doc_id", *S.ADDED).collect())) == want


def test_words_remove_passages_and_keep_the_rest(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(0, f"before {passage} after"), (1, f"other start {passage}"), (2, "short text"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in S.suffix_dedup(docs, 50, "words").collect()}
    assert got == {0: "before  after", 1: "other start ", 2: "short text", 3: None}


def test_empty_table_and_clashing_columns(spark, no_docs):
    assert results(no_docs, 400).count() == 0
    docs = spark.createDataFrame([(1, "a" * 500, 9, 8, "z", 7)], "doc_id long, text string, N_bytes int, k1 int, spans string, runs int")
    out = results(docs, 400)
    assert out.columns == ["doc_id", "text", "k1", "spans", "runs", *S.ADDED]  # only what it adds is replaced
    row = out.first()
    assert (row.k1, row.spans) == (8, "z")
    assert (row.runs, row.n_bytes, row.n_removed, row.n_spans) == (7, 500, 500, 1)


def test_the_sessions_settings_come_back(spark, docs):
    from pricewright.llm.common import BATCH

    before = {k: spark.conf.get(k) for k in (BATCH, "spark.sql.execution.arrow.maxRecordsPerBatch")}
    results(docs, 40).collect()
    assert before == {k: spark.conf.get(k) for k in before}


def test_query_has_the_contracts_columns(spark):
    from tests.conftest import SF

    out = S.op2_suffix_dedup(spark, SF)
    assert out.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_query_returns_what_is_left_of_planted_passages(spark, tmp_path):
    """Passages of 400 bytes that two documents share are gone from both texts; shorter ones of over 50 words and all else stay."""
    long, short = (" ".join(f"{w}{i:0{n}}" for i in range(55)) for w, n in (("passage", 3), ("w", 3)))
    assert len(long) > 400 > len(short)
    rows = [(0, f"{prose(1, 80)} {long} {prose(2, 40)}"), (1, f"{prose(3, 30)} {long}"), (2, f"{short} {prose(4, 70)}"), (3, f"{prose(5, 70)} {short}"), (4, prose(6, 120)), (5, ""), (6, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = S.op2_suffix_dedup(spark, str(tmp_path))
    assert out.columns == ["doc_id", *S.ADDED, "text"]
    got, texts = {r.doc_id: r for r in out.collect()}, dict(rows)
    for i, r in got.items():
        left = (r.text or "").encode()
        assert r.n_bytes == len((texts[i] or "").encode()) and r.n_removed == r.n_bytes - len(left) and r.kept_sha256 == hashlib.sha256(left).hexdigest()
    assert all(long[1:-1] not in got[i].text and got[i].n_removed >= len(long) for i in (0, 1))
    assert all(got[i].text == texts[i] and not got[i].n_removed for i in range(2, 7)) and len(got) == 7


def test_anchor_depends_on_the_window_alone():
    r = np.random.default_rng(1)
    shared = r.integers(0, 4, 300).astype(np.uint8)
    a, b = (np.concatenate((r.integers(0, 4, n).astype(np.uint8), shared, r.integers(0, 4, 50).astype(np.uint8))) for n in (40, 77))

    def anchors(x):
        start, n, key, _ = W.runs(W.BYTE_VALUES[x], 100, 30)
        return np.repeat(key, n)

    assert (anchors(a)[40:241] == anchors(b)[77:278]).all()


def test_merge_joins_touching_intervals():
    lo, hi = W.merge(np.array([5, 0, 9, 20]), np.array([9, 3, 12, 22]))
    assert lo.tolist() == [0, 5, 20] and hi.tolist() == [3, 12, 22]


def test_spans_of_texts_without_repeats_are_absent(spark):
    docs = spark.createDataFrame([(1, "abcdefgh" * 2), (2, "unique text of its own")], "doc_id long, text string")
    assert S.repeated_spans(docs, 20).count() == 0
    assert S.suffix_dedup(docs, 20).filter(F.col("n_removed") > 0).count() == 0


@pytest.mark.parametrize("width", [1, 3, 8, 13, 24])
def test_digit_passes_find_equal_windows(width):
    r = np.random.default_rng(width)
    raw = r.integers(97, 99, 400).astype(np.uint8)
    at = r.permutation(len(raw) - width + 1)
    group = r.integers(0, 2, len(at))
    size = min(8, width)
    places = [*range(0, width - size + 1, size)] + ([width - size] if width % size else [])
    leader = W.equal_windows(W.byte_digits(raw, size), at, group, places)
    least = {}
    for i, (a, g) in enumerate(zip(at, group)):
        least.setdefault((g, raw[a : a + width].tobytes()), i)
    assert leader.tolist() == [least[g, raw[a : a + width].tobytes()] for a, g in zip(at, group)]


def test_equal_hashes_of_first_digits_do_not_make_windows_equal():
    """If first digits all look alike the bytes still decide."""
    texts = ["x" * 60 + prose(1, 30), prose(2, 20) + prose(1, 30), prose(3, 40)]
    data, offset = [], []
    for t in texts:
        first, n, _, at = W.runs(W.BYTE_VALUES[np.frombuffer(t.encode(), np.uint8)], 40, 20)
        data += [t.encode()[a : a + k + 39] for a, k in zip(first.tolist(), n.tolist())]
        offset += at.tolist()
    w = S._Runs("bytes", 40, data, [0] * len(data), offset, [False] * len(data))
    windows = [data[r][a : a + 40] for r, a in zip(w.row, w.at)]
    assert w.twice.tolist() == [windows.count(x) > 1 for x in windows] and w.twice.any() and not w.twice.all()

import random

import corpus_pipeline as C
from pricewright.llm import queries
from tests.conftest import SF
from tests.llm.conftest import DOCUMENTS, awkward, prose


def test_stages_take_effect(spark, tmp_path):
    r = random.Random(1)
    leak = prose(900, 40)
    passage = prose(901, 60)
    rows, labels = [], []
    for i in range(120):
        words = prose(i, 80).split()
        if i % 6 == 0:
            words[r.randrange(80)] = "vilewretch"
        labels.append((i, 1, int(i % 6 == 0)))
        rows.append((i, " ".join(words), "en", "s", 0))
    rows += [(200, rows[1][1], "en", "s", 0), (201, rows[1][1].replace(rows[1][1].split()[40], "edited", 1), "en", "s", 0)]
    rows += [(202, f"{prose(902, 50)} {leak} {prose(903, 50)}", "en", "s", 0)]
    rows += [(203 + k, f"{prose(910 + k, 50)} {passage} {prose(920 + k, 50)}", "en", "s", 0) for k in range(2)]
    rows += [(205, "a vilewretch speaks", "en", "s", 0)]
    d = str(tmp_path)
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    seen = {}
    for name, stage in C.STAGES[:-1]:
        docs = C.written(stage(spark, docs, d), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[name] = {x.doc_id: x for x in docs.collect()}
    clean = {i for i in range(120) if i % 6}
    assert set(seen["toxicity"]) == clean | {200, 201, 202, 203, 204}
    assert set(seen["near_duplicates"]) == clean | {202, 203, 204}
    assert passage not in seen["repeated_passages"][203].text and seen["repeated_passages"][203].n_chars == len(seen["repeated_passages"][203].text)
    assert set(seen["benchmark"]) == clean | {203, 204}
    packed = C.STAGES[-1][1](spark, docs, d).collect()
    assert {x.doc_id for x in packed} == clean | {203, 204}
    assert sorted(map(tuple, C.run(spark, d).collect())) == sorted(map(tuple, packed))


def test_stages_bear_awkward_and_empty_tables(spark):
    for rows in (awkward("extra"), []):
        docs = spark.createDataFrame(rows, DOCUMENTS)
        for _, stage in C.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= max(len(rows) * 12, 1)
            if stage is not C.STAGES[-1][1]:
                assert out.columns == docs.columns


def test_stages_give_extra_columns_back(spark):
    """Columns with names that operators use inside come back untouched from every stage but the last."""
    extra = {"score": 7.0, "predicted": 9, "k1": 1, "K2": "x", "spans": "y", "n_bytes": 3, "n_removed": 4, "kept_sha256": "z", "root": 5, "order": "o", "best": 2, "class_key": 6, "bits": "b"}
    docs = spark.createDataFrame([(i, prose(i, 70), "en", "s", i) for i in range(6)] + [(9, prose(1, 70), "en", "s", 0)], DOCUMENTS)
    docs = docs.withColumns({c: C.F.lit(v) for c, v in extra.items()})
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = {r.doc_id: r.asDict() for r in out.collect()}
        assert len(rows) == (6 if name == "near_duplicates" else 7) and all(r[c] == v for r in rows.values() for c, v in extra.items())
    assert C.STAGES[-1][1](spark, docs, SF).count() == 7


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "benchmark", "packing"]

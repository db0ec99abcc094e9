import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abdeilmnorstu") for _ in range(r.randint(2, 8))) for _ in range(n))


def awkward(extra: str | None = None) -> list[tuple]:
    """Nulls in every column, empty and blank texts, a long text, copies, repeated rows, near copies, a shared passage."""
    passage = prose(1, 120)
    base = prose(2, 300)
    texts = [None, "", "   \n\t", "x", "one two three", base, base, base.replace(base.split()[100], "changed", 1), passage, f"{prose(3, 80)} {passage} {prose(4, 90)}", f"{passage} {prose(5, 30)}", "é" * 900, prose(6, 20_000), "a " * 3000, "ünïcödé wörds ärè hère ôk", prose(7, 50).upper(), prose(7, 50)]
    rows = [(i, t, "en" if i % 3 else None, None if i % 4 == 0 else f"s{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return [*rows, rows[5], (None, base, None, None, None), (None, None, None, None, None), (77, extra, "en", "s", 1)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(awkward("extra words here"), DOCUMENTS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)

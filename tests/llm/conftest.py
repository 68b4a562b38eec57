import random

import pytest

#: Names that the operators use for columns of their own.
CLASHING = ["id", "fp", "q", "kept", "row", "secrets", "block", "k1", "part", "mark", "kinds", "text_", "of", "paths"]


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}x" for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls in any column, empty and very long texts, near copies, ties and repeated rows."""
    rng = random.Random(5)
    rows = [(i, sentence(rng, rng.randrange(1, 120)), rng.choice(["en", "de", None]), rng.choice(["a", "b", None]))
            for i in range(40)]
    rows += [(40, None, "en", "a"), (41, "", "en", "a"), (42, " \n\t ", None, None), (43, "short", "de", None),
             (None, "a text without an id " * 12, "en", "b"), (None, None, None, None)]
    shared = sentence(rng, 60)
    rows += [(50 + i, sentence(rng, 20) + "\n" + shared + " " + sentence(rng, 15), "en", "a") for i in range(4)]
    long = sentence(rng, 20_000)
    rows += [(60, long, "en", "b"), (61, long + " tail", "en", "b")]
    base = sentence(rng, 90).split()
    for i in range(6):  # near copies
        rows.append((70 + i, " ".join(base[:80] + [f"n{i}"] + base[81:]), "fr", "c"))
    rows += [rows[3], rows[3], (80, rows[3][1], "en", "a"), (81, "Ünï ©▁ode \U0001F600 漢字 ſ K", "xx", "d")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    rows = [(*r, None if r[1] is None else len(r[1]), *("x" if i % 2 else None for _ in CLASHING))
            for i, r in enumerate(odd_rows)]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}"
                                 ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)

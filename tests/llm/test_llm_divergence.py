import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from wordloom.llm import divergence as D


def slow(rows, least_docs, top):
    said, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        said[lang, source].update(terms)
        in_docs[lang].update(set(terms))
        groups.add((lang, source))
    out = []
    for lang, source in groups:
        kept = [t for t, n in in_docs[lang].items() if n >= least_docs]
        all_n = {t: sum(said[lang, s][t] for lg, s in groups if lg == lang) for t in kept}

        def shares(count):
            total = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // total for t in kept}

        def far(a, b):
            return (a - b) * (a - b) // (a + b)

        p, q = shares(said[lang, source]), shares(all_n)
        pairs = []
        for lg, s in groups:
            if lg == lang and s != source:
                o = shares(said[lang, s])
                pairs.append((-sum(far(p[t], o[t]) for t in kept), s.encode(), s))
        terms = [(-far(p[t], q[t]), t.encode(), t) for t in kept if said[lang, source][t] and p[t] > q[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, item, -v, k + 1) for k, (v, _, item) in enumerate(found)]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


@pytest.mark.parametrize("blocks", [(1024, 128), (3, 2)])
def test_against_brute_force(odd_docs, odd_rows, blocks):
    """Nulls in any column, groups without terms, texts of other scripts, repeated rows, clashing names."""
    for least in (1, 3):
        got = rows_of(D.divergence(odd_docs, least, 4, *blocks))
        assert got == slow(odd_rows, least, 4) and got


def test_many_sources_in_blocks(spark):
    rng = random.Random(2)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyz"] + ["É", "é", "ÉÉ", "K", "k"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 9))), rng.choice(["en", "xx"]), f"s{rng.randrange(9)}")
            for i in range(200)] + [(900, "never kept", "alone", "s"), (901, None, "alone", "t"), (902, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(4)
    want = slow(rows, 10, 10)
    assert rows_of(D.divergence(df)) == want == rows_of(D.divergence(df, term_block=5, group_block=2))
    assert ("alone", "s", "pair", "t", 0, 1) in want and sum(r[2] == "term" for r in want) > 50


def test_tree_prices_empty_quadrants():
    rng = np.random.default_rng(0)
    for rows, others, terms in ((1, 1, 1), (3, 5, 40), (17, 2, 9), (6, 6, 130)):
        a_zero, b_zero = rng.integers(1, 50, rows), rng.integers(1, 50, others)
        a = a_zero[:, None] + rng.integers(1, 90, (rows, terms)) * (rng.random((rows, terms)) < 0.1)
        b = b_zero[:, None] + rng.integers(1, 90, (others, terms)) * (rng.random((others, terms)) < 0.1)
        want = np.array([[sum(D.distance(int(x), int(y)) for x, y in zip(r, s, strict=True)) for s in b] for r in a])
        assert (D.pair_sums(a, b, a_zero, b_zero, False) == want).all()
        want = np.array([[sum(D.distance(int(x), int(y)) for x, y in zip(r, s, strict=True)) for s in a] for r in a])
        upper = np.triu_indices(rows, 1)
        assert (D.pair_sums(a, a, a_zero, a_zero, True)[upper] == want[upper]).all()


def test_large_counts_are_exact(spark):
    n = 9_000_000_000_000_000_001
    df = spark.createDataFrame([(n, n + 4)], "n bigint, d bigint")
    got = df.select(D.share(df.n, df.d).alias("p")).first().p
    assert got == 1 + 1_000_000_000 * n // (n + 4)


def test_empty_table(no_docs):
    out = D.divergence(no_docs)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"] and out.count() == 0

import hashlib
import random
from collections import defaultdict

import pytest

from wordloom.llm import exact as X


def slow_groups(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    return groups


def check(got, rows):
    assert len(got) == len(rows)
    want = slow_groups(rows)
    shas = {hashlib.sha256(t.encode()).hexdigest(): t for t in want}
    seen = defaultdict(list)
    for r in got:
        ids = want[shas[r.sha256]]
        named = [i for i in ids if i is not None]
        assert (r.keep_id, r.group_size) == (max(named) if named else None, len(ids))
        assert not r.kept or r.id == r.keep_id
        seen[r.sha256].append(r)
    for sha, same in seen.items():
        assert sum(r.kept for r in same) == 1
        assert sorted((r.id is None, r.id or 0) for r in same) == sorted((i is None, i or 0) for i in want[shas[sha]])


def test_chunks_combine_at_any_cut():
    data = random.Random(1).randbytes(1000)
    for size in (1, 7, 333, 1000, 5000):
        parts = [(X.chunk_fingerprint(data[i : i + size]), len(data[i : i + size])) for i in range(0, 1000, size)]
        assert X.combine(parts) == X.chunk_fingerprint(data)
    assert X.combine([]) == 0


def test_powers_do_not_repeat():
    q = (X.PRIME - 1) // 2
    assert all(pow(a, q, X.PRIME) in (1, X.PRIME - 1) and pow(a, q - 1, q) == 1 for a in (2, 3, 5, 7, 11, 256))


@pytest.mark.parametrize("huge", [X.HUGE_BYTES, 50])
def test_against_brute_force(odd_docs, odd_rows, huge):
    """Nulls in any column, empty and long texts, repeated rows, clashing names; with every text in chunks too."""
    check(X.exact_duplicates(odd_docs, chunk_bytes=64, huge_bytes=huge).collect(), odd_rows)


@pytest.mark.parametrize("prime", [2, 101])
def test_equal_fingerprints_of_different_texts(spark, prime):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.choice([3, 40, 41])))) for i in range(120)] + [(500, None), (501, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    check(X.exact_duplicates(df, prime=prime, chunk_bytes=8, huge_bytes=20).collect(), rows)


def test_one_group_and_candidates_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(X, "BROADCAST_KEYS", 0)
    rows = [(i, "the same text" if i % 3 else f"text {i // 6}") for i in range(300)]
    check(X.exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect(), rows)


def test_empty_table(no_docs):
    out = X.exact_duplicates(no_docs)
    assert out.columns == ["id", "keep_id", "group_size", "kept", "sha256", "fp"] and out.count() == 0

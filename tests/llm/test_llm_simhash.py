import re

import numpy as np
import xxhash

from wordloom.llm import simhash as S
from wordloom.llm.common import smallest_reachable


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def slow_fingerprint(text, size=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    grams = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def slow_components(pairs, n):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near(x, most):
    return [(i, i + 1 + int(j)) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(x[i + 1 :] ^ x[i]) <= most)]


def test_spark_hash_is_xxh64(spark):
    got = spark.sql("SELECT xxhash64('a b c') AS h").first().h
    assert got % (1 << 64) == xxhash.xxh64(b"a b c", seed=42).intdigest()


def test_near_duplicates_against_brute_force(odd_docs, odd_rows):
    got = S.near_duplicates(odd_docs, block_rows=8).collect()
    assert len(got) == len(odd_rows)
    want = {}
    for i, t, *_ in odd_rows:
        want.setdefault(i, set()).add(slow_fingerprint(t))
    assert all(r.fp % (1 << 64) in want[r.id] for r in got)
    x = np.array([r.fp for r in got]).view(np.uint64)
    root = slow_components(near(x, 3), len(got))
    for k, r in enumerate(got):
        ids = [o.id for o, c in zip(got, root, strict=True) if c == root[k] and o.id is not None]
        assert r.component_id == (min(ids) if ids else None)
    assert max(root.count(c) for c in root) >= 4  # texts without words are one group


def test_links_in_blocks_and_chunks(spark):
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    x = [c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, 2).astype(np.uint64)) for c in centres for _ in range(40)]
    x = np.unique(np.concatenate([np.array(x), rng.integers(0, 1 << 63, 500, dtype=np.uint64)]))
    want = slow_components(near(x, 3), len(x))
    fps = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp bigint")
    place = {int(v): k for k, v in enumerate(x.view(np.int64))}
    for block_rows, flush in ((1 << 16, 1 << 15), (16, 64)):
        edges = [(place[r.a], place[r.b]) for r in S.links(fps, 3, block_rows, flush).collect()]
        assert all(np.bitwise_count(x[a] ^ x[b]) <= 64 for a, b in edges)
        assert slow_components(edges, len(x)) == want


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7), (200, 150), (150, 149)]
    got = {r.node: r.root for r in smallest_reachable(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[100 + k] == 100 for k in range(50))
    # 149 and 100..149 meet: 149 is a leaf of the hub
    assert got[200] == 100 and 300 not in got
    assert smallest_reachable(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_empty_table(no_docs):
    out = S.near_duplicates(no_docs)
    assert out.columns == ["id", "fp", "component_id"] and out.count() == 0

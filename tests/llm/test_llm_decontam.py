import collections
import re

from wordloom.llm import decontam as D


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def slow(rows, items, length):
    windows = collections.defaultdict(set)
    for key, text in items:
        w = words(text)
        for i in range(max(1, len(w) - length + 1)):
            if w:
                windows[tuple(w[i : i + length])].add(str(key))
    out = []
    for _, text, *_ in rows:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if (k := tuple(w[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[k]
        out.append((len(w), tuple(sorted(hit)), tuple(sorted(found))))
    return collections.Counter(out)


def test_tokens():
    assert D.tokens("Ab-Cd Éİ 9x\x7f_y`z") == [b"ab", b"cd", "Éİ".encode(), b"9x", b"y", b"z"]
    assert D.tokens(None) == D.tokens("") == D.tokens(" .,") == []


def test_contamination_against_brute_force(spark, odd_docs, odd_rows):
    some = odd_rows[50][1].split()
    items = [(1, " ".join(some[:25])), (2, odd_rows[3][1]), (3, "short"), (4, None), (5, ""), (5, "!!"),
             (None, "a text without an id a text without an id a"), (7, odd_rows[0][1].upper()), (7, "short")]
    bench = spark.createDataFrame([(*i, "clash") for i in items], "item_id bigint, text string, block string")
    known = [(k, t) for k, t in items if k is not None]
    got = D.contamination(odd_docs, bench).collect()
    spans = collections.Counter((r.n_words, tuple(k for s in r.spans for k in range(s.first, s.last)),
                                 tuple(i for i in r.items)) for r in got)
    # an item without an id marks words but has no name
    hits = slow(odd_rows, known + [("", items[6][1])], 10)
    named = collections.Counter()
    for (n, hit, found), c in hits.items():
        named[(n, hit, tuple(f for f in found if f))] += c
    assert spans == named


def test_rounds_and_blocks_give_the_same(spark, odd_docs, odd_rows):
    bench = spark.createDataFrame([(i, r[1]) for i, r in enumerate(odd_rows[:12])], "item_id bigint, text string")
    index = D.build_index(odd_docs, gap=1, block_tokens=500)
    one = D.build_index(odd_docs, gap=1)
    assert index.docs.select("block").distinct().count() > one.docs.select("block").distinct().count()
    starts = one.docs.count()
    assert starts == index.docs.count() == len(odd_rows)

    def found(i, size):
        hits = D.search(i, D.phrases(bench, 6), round_bytes=size)
        return sorted((r.id or -1, r.item, r.first, r.last) for r in hits.join(i.docs, ["block", "ord"]).collect())

    assert found(index, 1500) == found(one, 1 << 20)


def test_proximity(spark):
    docs = spark.createDataFrame([(0, "red small green apple"), (1, "green red apple x"), (2, "apple")], "doc_id int, text string")
    wanted = spark.createDataFrame([("q", "red green apple")], "item_id string, text string")
    index = D.build_index(docs, gap=5)
    hits = D.search(index, D.phrases(wanted, 3), slop=1).join(index.docs, ["block", "ord"]).collect()
    assert sorted({r.id for r in hits}) == [0]
    assert D.search(index, D.phrases(wanted, 3)).count() == 0


def test_empty_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert D.contamination(no_docs, some).count() == 0
    assert all(not r.spans and not r.items for r in D.contamination(odd_docs, none).collect())

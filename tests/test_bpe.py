import random
import re

import pytest

from tests.conftest import docs
from wordloom.operators.bpe import train_bpe

GOLD_RULES = [("l", "o"), ("lo", "w"), ("low", "e"), ("low", "</w>"), ("lowe", "r"), ("lower", "</w>")]


def test_tiny_goldens(tiny_model):
    assert [(a, b) for a, b, _ in tiny_model.rules] == GOLD_RULES
    assert tiny_model.sizes[0] == 10 and tiny_model.sizes[-1] == 8
    vocab = [(r.token_id, r.token) for r in tiny_model.vocab.orderBy("token_id").collect()]
    assert vocab == [(0, "<PAD>"), (1, "<END>"), (2, "</w>"), (3, "low</w>"), (4, "lowe"), (5, "lower</w>"),
                     (6, "s"), (7, "t")]
    merges = [(r.rank, r.merged) for r in tiny_model.merges.orderBy("rank").collect()]
    assert merges == [(1, "lo"), (2, "low"), (3, "lowe"), (4, "low</w>"), (5, "lower"), (6, "lower</w>")]


@pytest.mark.parametrize("m,n", [(5, 0), (9, 0), (10, 0), (11, 6), (12, 6), (13, 6)])
def test_target_sizes(spark, m, n):
    model = train_bpe(docs(spark, "low lower lowest low lower"), m)
    assert len(model.rules) == n


def test_empty_and_letterless(spark):
    for text in ["", "123 !?"]:
        model = train_bpe(docs(spark, text), 32)
        assert model.rules == []
        assert [r.token for r in model.vocab.orderBy("token_id").collect()] == ["<PAD>", "<END>"]


def test_invalid_size(spark):
    with pytest.raises(ValueError):
        train_bpe(docs(spark, "a"), 0)


def _python_bpe(words, m):
    """Plain one-pair-at-a-time trainer used as the brute-force check."""
    from collections import Counter

    freq = Counter(words)
    state = {w: list(w) + ["</w>"] for w in freq}
    rules = []
    while True:
        vocab = {t for k in state.values() for t in k}
        if len(vocab) + 2 >= m:
            break
        pairs = Counter()
        for w, k in state.items():
            for x, y in zip(k, k[1:]):
                pairs[(x, y)] += freq[w]
        if not pairs:
            break
        (a, b), n = min(pairs.items(), key=lambda kv: (-kv[1], kv[0][0].encode(), kv[0][1].encode()))
        if n < 2:
            break
        rules.append((a, b))
        for w, k in state.items():
            out, i = [], 0
            while i < len(k):
                if i + 1 < len(k) and k[i] == a and k[i + 1] == b:
                    out.append(a + b)
                    i += 2
                else:
                    out.append(k[i])
                    i += 1
            state[w] = out
    return rules


def test_batched_equals_brute_force(spark):
    rnd = random.Random(7)
    for trial in range(3):
        words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
        m = rnd.randint(8, 30)
        model = train_bpe(docs(spark, " ".join(words)), m)
        assert [(a, b) for a, b, _ in model.rules] == _python_bpe(words, m)


def _indexed_bpe(freq, m):
    """The same trainer with counts kept up to date word by word, for larger inputs."""
    from collections import Counter, defaultdict

    state = {w: [*w, "</w>"] for w in freq}
    pairs, where, tokens = Counter(), defaultdict(set), Counter()

    def count(w, sign):
        k = state[w]
        for t in k:
            tokens[t] += sign * freq[w]
        for p in zip(k, k[1:]):
            pairs[p] += sign * freq[w]
            where[p].add(w)

    for w in freq:
        count(w, 1)
    rules = []
    while sum(n > 0 for n in tokens.values()) + 2 < m:
        (a, b), n = min(pairs.items(), key=lambda x: (-x[1], x[0]), default=((None, None), 0))
        if n < 2:
            break
        rules.append((a, b, n))
        for w in list(where[a, b]):
            count(w, -1)
            out = []
            for t in state[w]:
                if out and out[-1] == a and t == b and not joined:
                    out[-1] = a + b
                    joined = True
                else:
                    out.append(t)
                    joined = False
            state[w] = out
            count(w, 1)
        pairs = +pairs
    return rules


@pytest.mark.parametrize("held", [200_000, 40])
def test_a_thousand_tokens(spark, held):
    """m = 1000 on all documents of the smallest table; with few counts held the words are counted again."""
    from collections import Counter

    path = "/root/testdata/sf0.001/documents.parquet"
    df = spark.read.parquet(path).repartition(4)
    m = 1000 if held > 1000 else 150
    model = train_bpe(df, m, held_pairs=held)
    words = re.findall("[A-Za-z]+", " ".join(r.text for r in df.select("text").collect()))
    assert model.rules == _indexed_bpe(Counter(w.lower() for w in words), m)
    assert model.recounts > 0 if held < 1000 else model.recounts == 0
    assert model.passes < len(model.rules) and model.sizes[-1] <= m


def test_repeated_letters_and_one_at_a_time(spark):
    text = "aaaa aaaa aaa aabaab baab bbbb bbb abab " * 3
    want = _python_bpe(text.split(), 14)
    for batched in (True, False):
        assert [(a, b) for a, b, _ in train_bpe(docs(spark, text), 14, batched=batched).rules] == want
    assert [(a, b) for a, b, _ in train_bpe(docs(spark, text), 14, max_merges=3).rules] == want[:3]
    assert [(a, b) for a, b, _ in train_bpe(docs(spark, text), 14, held_pairs=1).rules] == want


def _long_tail(seed, count):
    rnd = random.Random(seed)
    parts = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 4))) for _ in range(60)]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 3))) for _ in range(count)]


@pytest.mark.parametrize("words", [1 << 15, 40, 1])
def test_many_merges_a_pass_whatever_the_forecast(spark, monkeypatch, words):
    """A pass makes many merges where the forecast is right; a poor one, from few words, gives the same rules."""
    from collections import Counter

    from wordloom.operators import bpe

    monkeypatch.setattr(bpe, "FORECAST_WORDS", words)
    text = _long_tail(3, 3000)
    model = train_bpe(docs(spark, " ".join(text)), 160)
    assert model.rules == _indexed_bpe(Counter(text), 160)
    if words > 1000:
        assert model.passes <= len(model.rules) / 16


def test_changes_near_the_merged_places_only():
    """Each merge of a list changes the counts as recounting all tokens and pairs does, without recounting them."""
    from collections import Counter

    import pyarrow as pa

    from wordloom.operators import bpe as B

    words = {"aaaa": 3, "banana": 5, "ab": 2, "xaay": 7, "aabaab": 1, "q": 4, "nanana": 2}
    rules, merges = [("a", "n", 9)], [("a", "a"), ("an", "a"), ("b", "</w>"), ("aa", "aa")]
    rows = pa.RecordBatch.from_arrays([pa.array(list(words)), pa.array(list(words.values()))], ["word", "n"])
    found = {}
    for out in B._changes(rules, merges)(iter([rows])):
        for r in out.to_pylist():
            found[r["step"], r["a"], r["b"]] = r["n"]
    want: Counter = Counter()
    for word, n in words.items():
        for step in range(len(merges)):
            for sign, count in ((-1, step), (1, step + 1)):
                t = B.Encoder([*(r[:2] for r in rules), *merges[:count]]).replay(word)
                for key in [(x, None) for x in t] + list(zip(t, t[1:])):
                    want[(step, *key)] += sign * n
    assert found == {k: n for k, n in want.items() if n}

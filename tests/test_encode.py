import random

import pytest

from tests.conftest import docs
from wordloom.operators import encode as E


def _rules(model):
    return [(a, b) for a, b, _ in model.rules]


def test_encode_goldens(spark, tiny_model):
    enc = E.encode_documents(docs(spark, "lowest lower", "slow", "lo", "", "123"), _rules(tiny_model))
    got = {r.doc_id: r.tokens for r in enc.collect()}
    assert got[0] == ["lowe", "s", "t", "</w>", "lower</w>"]
    assert got[1] == ["s", "low</w>"]
    assert got[2] == ["lo", "</w>"]
    assert got[3] == [] and got[4] == []
    ids = E.ids_stream(enc, tiny_model.vocab).orderBy("doc_id", "pos").collect()
    assert [(r.doc_id, r.pos, r.token_id) for r in ids] == [
        (0, 0, 4), (0, 1, 6), (0, 2, 7), (0, 3, 2), (0, 4, 5), (1, 0, 6), (1, 1, 3), (2, 0, 2)]
    assert [(r.token, r.n) for r in E.oov_tokens(enc, tiny_model.vocab).collect()] == [("lo", 1)]


def test_corpus_id_stream(spark, tiny_model):
    enc = E.encode_documents(docs(spark, "low lower lowest low lower"), _rules(tiny_model))
    ids = [r.token_id for r in E.ids_stream(enc, tiny_model.vocab).orderBy("pos").collect()]
    assert ids == [3, 5, 4, 6, 7, 2, 3, 5]


def test_encode_words_equals_trained_state(spark, tiny_model):
    st = tiny_model.state.select("word", "t")
    enc = E.encode_words(st.select("word"), _rules(tiny_model))
    got = {r.word: r.tokens for r in enc.collect()}
    want = {r.word: r.t.strip().split("  ") for r in st.collect()}
    assert got == want
    for w, toks in got.items():  # concatenation without the end marker is the word
        assert "".join(toks).replace("</w>", "") == w


def test_word_and_document_encoders_agree(spark, tiny_model):
    text = "slow lowest lower lo wer we lowlow"
    enc = E.encode_documents(docs(spark, text), _rules(tiny_model)).collect()[0].tokens
    words = spark.createDataFrame([(w,) for w in text.split()], "word string")
    per_word = {r.word: r.tokens for r in E.encode_words(words, _rules(tiny_model)).collect()}
    assert enc == [t for w in text.split() for t in per_word[w]]


def test_rules_do_not_cross_words(spark):
    rules = [("a", "</w>"), ("a</w>", "b")]  # second can never fire inside a word
    enc = E.encode_documents(docs(spark, "a b"), rules).collect()[0].tokens
    assert enc == ["a</w>", "b", "</w>"]


def _replayed(word, rules):
    """Every rule in order, on all places from left to right."""
    k = [*word, "</w>"]
    for a, b in rules:
        out, i = [], 0
        while i < len(k):
            if i + 1 < len(k) and (k[i], k[i + 1]) == (a, b):
                out.append(a + b)
                i += 2
            else:
                out.append(k[i])
                i += 1
        k = out
    return k


@pytest.mark.parametrize("n", [0, 50, 1000, 5000])
def test_any_number_of_rules(spark, n):
    rng = random.Random(n)
    pieces = list("abc") + ["</w>"]
    rules = []
    for _ in range(n):  # rules on what earlier rules made, some repeated, some that never fire
        a, b = rng.choice(pieces), rng.choice(pieces)
        rules.append((a, b))
        if len(a + b) < 9:
            pieces.append(a + b)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(60)]
    want = [t for w in words for t in _replayed(w, rules)]
    assert E.encode_documents(docs(spark, " ".join(words)), rules).collect()[0].tokens == want
    got = {r.word: r.tokens for r in E.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), rules).collect()}
    assert all(got[w] == _replayed(w, rules) for w in words)


def test_same_result_with_a_small_memory(spark, tiny_model, monkeypatch):
    encoder = E.Encoder(_rules(tiny_model))
    monkeypatch.setattr(E, "REMEMBERED", 2)
    text = "slow lowest lower lo wer we lowlow lower slow"
    assert encoder.text(text) == [t for w in text.split() for t in _replayed(w, _rules(tiny_model))]
    assert encoder.text(None) == encoder.text("12 !") == []


def test_model_size_is_checked(spark, tiny_model, monkeypatch):
    monkeypatch.setattr(E, "MODEL_BYTES", 5)
    with pytest.raises(OverflowError):
        E.encode_documents(docs(spark, "low"), _rules(tiny_model))


def test_duplicate_vocab_first_id_wins(spark):
    vocab = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a")], "token_id bigint, token string")
    enc = spark.createDataFrame([(0, ["a", "b", "c", "a"])], "doc_id bigint, tokens array<string>")
    got = [(r.pos, r.token_id) for r in E.ids_stream(enc, vocab).orderBy("pos").collect()]
    assert got == [(0, 0), (1, 1), (2, 0)]


def test_global_positions(spark, tiny_model):
    enc = E.encode_documents(docs(spark, "low lower", "lowest low lower", "", "low"), _rules(tiny_model))
    g = E.global_positions(enc).orderBy("gpos").collect()
    assert [r.gpos for r in g] == list(range(len(g)))
    assert [r.doc_id for r in g] == [0, 0, 1, 1, 1, 1, 1, 1, 3]
    offs = {r.doc_id: r.offset for r in E.doc_offsets(enc).collect()}
    assert offs == {0: 0, 1: 2, 2: 8, 3: 8}


def test_offsets_in_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(E, "BUCKET_DOCS", 7)
    rows = [(i * 3, ["t"] * (i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>").repartition(4)
    want, at = {}, 0
    for i, k in rows:
        want[i], at = at, at + len(k)
    assert {r.doc_id: r.offset for r in E.doc_offsets(df).collect()} == want


def test_long_words_and_many_rules():
    """A run of a million letters under 30,000 rules: the work grows with the letters, not with the rules."""
    import time

    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rules = [(a, b) for a in letters for b in letters]
    rules += [(a + b, c) for a, b in rules for c in letters] + [(a + b, c + d) for a, b in rules[:150] for c, d in rules[:80]]
    encoder, word = E.Encoder(rules[:30_000]), "".join(rng.choices(letters, k=1_000_000))
    start = time.time()
    assert "".join(encoder.word(word)) == word + "</w>"
    assert time.time() - start < 60
    short = E.Encoder(rules[:30_000]).word(word[:400])
    assert short == _replayed(word[:400], rules[:30_000])


def test_ids_in_one_pass(spark, tiny_model):
    df = docs(spark, "lowest lower", "slow", "lo", "", None, "LOW 12 low")
    want = E.with_ids(E.encode_documents(df, _rules(tiny_model), keep=["text"]), tiny_model.vocab)
    both = E.encode_to_ids(df, _rules(tiny_model), tiny_model.vocab, keep=["text"], tokens=True)
    assert both.columns == want.columns and sorted(both.collect(), key=str) == sorted(want.collect(), key=str)
    ids = E.encode_to_ids(df, _rules(tiny_model), tiny_model.vocab)
    assert sorted(ids.collect()) == sorted(want.select("doc_id", "ids").collect())
    assert sorted(E.doc_offsets(ids).collect()) == sorted(E.doc_offsets(want.drop("ids")).collect())


def test_memory_is_bounded_by_letters(monkeypatch):
    """What is remembered counts its letters, and a batch of rows is worked on in stretches of bounded bytes."""
    import pyarrow as pa

    monkeypatch.setattr(E, "REMEMBERED", 40)
    encoder = E.Encoder([("a", "b")])
    for i in range(200):
        encoder.word("ab" + "c" * (i % 30))
        assert sum(map(len, encoder.memory.known)) <= 40
    assert encoder.word("ab" * 50) == ["ab"] * 50 + ["</w>"] and "ab" * 50 not in encoder.memory.known
    monkeypatch.setattr(E, "TEXT_BYTES", 10)
    rows = ["four", None, "longer than all ten bytes", "", "x" * 9, "yy", None]
    cut = [part.to_pylist() for part in E._few(pa.array(rows))]
    assert [x for part in cut for x in part] == rows
    assert all(len(part) == 1 or sum(len(x or "") for x in part) <= 10 for part in cut)


def test_lookup_of_null_texts_and_tokens(spark):
    rows = spark.createDataFrame([(1, ["a", "x", "b"]), (2, None), (3, []), (4, [None, "b"])], "doc_id int, tokens array<string>")
    vocab = spark.createDataFrame([(5, "a"), (7, "b"), (6, "b")], "token_id bigint, token string")
    got = {r.doc_id: (r.tokens, r.ids) for r in E.with_ids(rows, vocab).collect()}
    assert got == {1: (["a", "b"], [5, 6]), 2: ([], []), 3: ([], []), 4: (["b"], [6])}


def test_words_are_remembered_as_bytes(spark, tiny_model):
    """A text is put together of its words' bytes, not token by token."""
    import pyarrow as pa

    rules = [(a, b) for a, b, _ in tiny_model.rules]
    look_up = E._looked_up(E.Encoder(rules), ["lo", "w", "</w>"])
    at, ends = look_up(pa.array(["low LOW", None, "12", "slow"]))
    want = [t for w in ("low", "low", "slow") for t in E.Encoder(rules).replay(w) if t in ("lo", "w", "</w>")]
    assert [["lo", "w", "</w>"][i] for i in at] == want
    assert ends.to_pylist()[0] == 0 and ends.to_pylist()[2] == ends.to_pylist()[3] and ends.to_pylist()[-1] == len(want)

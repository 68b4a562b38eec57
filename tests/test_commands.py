import os

import pytest

from wordloom.plans.commands import bpe_command, encode_command, train_command
from wordloom.sources.options import TrainOptions


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_commands_end_to_end(spark, scratch):
    corpus = os.path.join(scratch, "corpus", "c.txt")
    _write(corpus, "low lower lowest low lower")
    base = os.path.join(scratch, "tok")
    r = bpe_command(spark, os.path.dirname(corpus), base, 32)
    assert r["merges"] == 6 and r["vocabulary_size"] == 8
    assert [x.value for x in spark.read.text(base + ".voc").collect()] == [
        "<PAD>", "<END>", "</w>", "low</w>", "lowe", "lower</w>", "s", "t"]
    text = os.path.join(scratch, "text", "t.txt")
    _write(text, "lowest lower")
    enc = os.path.join(scratch, "enc")
    r = encode_command(spark, base, os.path.dirname(text), enc, ids=enc)
    assert r["tokens"] == 5 and r["ids"] == 5
    assert [x.value for x in spark.read.text(enc + ".tok").collect()] == ["lowe s t </w> lower</w>"]
    assert [x.value for x in spark.read.text(enc + ".ids").collect()] == ["4 6 7 2 5"]
    opts = TrainOptions(dim=8, window=2, epochs=1, neg=2, lr=0.05, seed=123)
    out_a = os.path.join(scratch, "model_a")
    a = train_command(spark, base, out_a, tokens=enc, options=opts)
    out_b = os.path.join(scratch, "model_b")
    b = train_command(spark, base, out_b, input_text=os.path.dirname(text), options=opts)
    assert a["token_count"] == b["token_count"] == 5
    ea = [x.value for x in spark.read.text(out_a + ".emb").collect()]
    eb = [x.value for x in spark.read.text(out_b + ".emb").collect()]
    assert ea[0] == "tokens=8 dim=8" and ea == eb  # id path equals text path
    meta = [x.value for x in spark.read.text(out_a + ".meta").collect()]
    assert "token_count=5" in meta and "dim=8" in meta
    with pytest.raises(ValueError):
        train_command(spark, base, out_a, options=opts)
    with pytest.raises(ValueError):
        bpe_command(spark, os.path.dirname(corpus), base, 0)


def test_train_from_parquet_id_table(spark, scratch, tiny_model):
    from tests.conftest import docs
    from wordloom.operators import encode as E
    from wordloom.sources import files as IO

    base = os.path.join(scratch, "tok")
    IO.write_vocab(tiny_model.vocab, base + ".voc", fmt="text")
    IO.write_merges(tiny_model.merges, base + ".merges", fmt="text")
    rules = [(a, b) for a, b, _ in tiny_model.rules]
    enc = E.encode_documents(docs(spark, "low lower", "lowest low lower"), rules)
    table = os.path.join(scratch, "ids.parquet")
    E.ids_stream(enc, tiny_model.vocab).select("doc_id", "pos", "token_id").write.parquet(table)
    opts = TrainOptions(dim=8, window=2, epochs=1, neg=2, lr=0.05, seed=123)
    a = train_command(spark, base, os.path.join(scratch, "m1"), tokens=table, options=opts)
    text_dir = os.path.join(scratch, "texts")
    docs(spark, "low lower", "lowest low lower").write.parquet(os.path.join(text_dir, "d.parquet"))
    b = train_command(spark, base, os.path.join(scratch, "m2"), input_text=os.path.join(text_dir, "d.parquet"),
                      options=opts)
    assert a["token_count"] == b["token_count"] == 8
    ea = [x.value for x in spark.read.text(os.path.join(scratch, "m1") + ".emb").collect()]
    eb = [x.value for x in spark.read.text(os.path.join(scratch, "m2") + ".emb").collect()]
    assert ea == eb


def test_encode_then_train_over_many_parts(spark, scratch, tiny_model):
    from tests.conftest import docs
    from wordloom.sources import files as IO

    base = os.path.join(scratch, "tok")
    IO.write_vocab(tiny_model.vocab, base + ".voc", fmt="text")
    IO.write_merges(tiny_model.merges, base + ".merges", fmt="text")
    texts = os.path.join(scratch, "texts", "d.parquet")
    docs(spark, *["low lower", "lowest low lower", "slow", "", "lower low"] * 40).repartition(6).write.parquet(texts)
    enc = os.path.join(scratch, "enc")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the sorted output has several parts
    try:
        encode_command(spark, base, texts, enc, ids=enc)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len([f for f in os.listdir(enc + ".ids") if f.startswith("part-")]) > 1
    opts = TrainOptions(dim=8, window=2, epochs=1, neg=2, lr=0.05, seed=123)
    a, b = os.path.join(scratch, "m1"), os.path.join(scratch, "m2")
    train_command(spark, base, a, tokens=enc, options=opts)
    train_command(spark, base, b, input_text=texts, options=opts)
    assert [x.value for x in spark.read.text(a + ".emb").collect()] == [x.value for x in spark.read.text(b + ".emb").collect()]

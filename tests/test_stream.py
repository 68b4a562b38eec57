import os

from tests.conftest import docs
from wordloom.operators import encode as E
from wordloom.streaming.encode_stream import encode_available


def test_stream_equals_batch(spark, tiny_model, scratch):
    src = os.path.join(scratch, "in")
    d = docs(spark, "low lower lowest", "slow lo", "lower low").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    d.repartition(2).write.parquet(src)
    rules = [(a, b) for a, b, _ in tiny_model.rules]
    sink, checkpoint = os.path.join(scratch, "out"), os.path.join(scratch, "ck")
    out = encode_available(spark, src, rules, sink, checkpoint)
    batch = E.encode_documents(d, rules)
    assert sorted(out.collect()) == sorted(batch.collect())
    # files that come later are encoded once, after a restart
    more = docs(spark, "", "", "", "lowest").where("doc_id = 3").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    more.write.mode("append").parquet(src)
    out = encode_available(spark, src, rules, sink, checkpoint)
    assert sorted(out.collect()) == sorted(E.encode_documents(d.union(more), rules).collect())


def test_stream_of_ids(spark, tiny_model, scratch):
    src = os.path.join(scratch, "in")
    d = docs(spark, "low lower lowest", "lo").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    d.write.parquet(src)
    rules = [(a, b) for a, b, _ in tiny_model.rules]
    out = encode_available(spark, src, rules, os.path.join(scratch, "out"), os.path.join(scratch, "ck"), tiny_model.vocab)
    want = E.with_ids(E.encode_documents(d, rules), tiny_model.vocab)
    assert sorted(out.collect()) == sorted(want.collect())


def test_a_batch_that_runs_again_adds_no_row(spark, tiny_model, scratch):
    """Text files as documents; the query is stopped after it wrote a batch but before it noted so, and started again."""
    from wordloom.streaming import encode_stream as ES

    src, sink, checkpoint = (os.path.join(scratch, d) for d in ("in", "out", "ck"))
    os.makedirs(src)
    texts = ["low lower\nlowest", "slow lo", " ", "12", "lower low"]
    rules = [(a, b) for a, b, _ in tiny_model.rules]

    def run(fmt="text"):
        ES.start_encode_stream(spark, src, rules, sink, checkpoint, tiny_model.vocab, max_files_per_trigger=1, fmt=fmt).awaitTermination()
        return sorted((os.path.basename(r.doc_id), r.tokens, r.ids) for r in ES.read_sink(spark, sink).collect())

    for i, t in enumerate(texts[:3]):
        with open(os.path.join(src, f"{i}.txt"), "w") as f:
            f.write(t)
    first = run()
    last = max((f for f in os.listdir(os.path.join(checkpoint, "commits")) if f.isdigit()), key=int)
    assert int(last) >= 1  # several batches
    os.remove(os.path.join(checkpoint, "commits", last))
    crc = os.path.join(checkpoint, "commits", f".{last}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    for i, t in enumerate(texts[3:], 3):
        with open(os.path.join(src, f"{i}.txt"), "w") as f:
            f.write(t)
    got = run()
    want = E.encode_to_ids(docs(spark, *texts), rules, tiny_model.vocab, tokens=True).collect()
    assert got == sorted((f"{r.doc_id}.txt", r.tokens, r.ids) for r in want) and set(map(str, first)) <= set(map(str, got))


def test_lines_as_documents(spark, tiny_model, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("low lower\n\nslow\n")
    rules = [(a, b) for a, b, _ in tiny_model.rules]
    out = encode_available(spark, src, rules, os.path.join(scratch, "out"), os.path.join(scratch, "ck"), fmt="lines")
    want = E.encode_documents(docs(spark, "low lower", "", "slow"), rules)
    assert sorted(r.tokens for r in out.collect()) == sorted(r.tokens for r in want.collect())

import os

import pytest

from tests.conftest import docs
from wordloom.operators import encode as E
from wordloom.sources import files as IO
from wordloom.sources.options import validate_sources, validate_target_size


def _write(path, data: bytes):
    with open(path, "wb") as f:
        f.write(data)
    return path


def test_rules_roundtrip(spark, tiny_model, scratch):
    out = os.path.join(scratch, "merges")
    IO.write_merges(tiny_model.merges, out, fmt="text")
    rules = IO.read_rule_lines(spark, out)
    got = [(r.rank, r.a, r.b) for r in rules.orderBy("rank").collect()]
    assert got == [(i + 1, a, b) for i, (a, b, _) in enumerate(tiny_model.rules)]


def test_rule_lines_invalid_kept_with_rank(spark, scratch):
    p = _write(os.path.join(scratch, "r.merges"), b"l + o -> lo\r\n\nbroken\na + b -> zzz\n")
    rules = IO.read_rule_lines(spark, p).orderBy("rank").collect()
    assert [(r.rank, r.a, r.b) for r in rules] == [(1, "l", "o"), (2, None, None), (3, "a", "b")]
    assert IO.rules_list(IO.read_rule_lines(spark, p)) == [("l", "o"), ("a", "b")]


def test_vocab_roundtrip_and_rules(spark, tiny_model, scratch):
    out = os.path.join(scratch, "voc")
    IO.write_vocab(tiny_model.vocab, out, fmt="text")
    back = IO.read_vocab(spark, out)
    # Empty difference both ways means equal, order (ids) included
    assert back.exceptAll(tiny_model.vocab).count() == 0 and tiny_model.vocab.exceptAll(back).count() == 0
    p = _write(os.path.join(scratch, "v.voc"), b"<PAD>\r\n\n<END>\na\na\n")
    v = [(r.token_id, r.token) for r in IO.read_vocab(spark, p).orderBy("token_id").collect()]
    assert v == [(0, "<PAD>"), (1, "<END>"), (2, "a"), (3, "a")]


def test_read_ids(spark, scratch):
    p = _write(os.path.join(scratch, "a.ids"), b"3 99\n\n 5 7 \n")
    got = [(r.doc_id, r.pos, r.token_id) for r in IO.read_ids(spark, p).orderBy("doc_id", "pos").collect()]
    assert [x[1:] for x in got] == [(0, 3), (1, 99), (0, 5), (1, 7)] and len({x[0] for x in got}) == 2
    kept = IO.read_ids(spark, p, vocab_size=8).orderBy("doc_id", "pos")
    assert [(r.pos, r.token_id) for r in kept.collect()] == [(0, 3), (0, 5), (1, 7)]
    bad = _write(os.path.join(scratch, "b.ids"), b"3 x 5")
    with pytest.raises(IO.MalformedIdsError):
        IO.read_ids(spark, bad)
    assert [r.token_id for r in IO.read_ids(spark, bad, mode="permissive").orderBy("pos").collect()] == [3, 5]
    empty = _write(os.path.join(scratch, "c.ids"), b"")
    assert IO.read_ids(spark, empty).count() == 0


def test_ids_of_a_folder_keep_the_order_of_files_and_lines(spark, scratch):
    folder = os.path.join(scratch, "many")
    os.makedirs(folder)
    lines = [f"{i} {i + 1}" for i in range(4000)]
    for k in range(4):
        _write(os.path.join(folder, f"part-{k:05d}.txt"), ("\n".join(lines[k * 1000 : (k + 1) * 1000]) + "\n").encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")  # a file is read in several blocks
    try:
        rows = IO.read_id_lines(spark, folder).orderBy("doc_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [" ".join(map(str, r.ids)) for r in rows] == lines


def test_corpus_texts_are_not_sorted(spark, scratch):
    d = os.path.join(scratch, "plain")
    os.makedirs(d)
    _write(os.path.join(d, "a.txt"), b"x")
    plan = IO.read_corpus(spark, d)._jdf.queryExecution().executedPlan().toString()
    # only sizes of parts meet in one task, and no window holds a text
    assert plan.count("SinglePartition") == 1
    assert not [x for x in plan.splitlines() if "Window" in x and ("value" in x or "text#" in x)]


def test_tokens_and_ids_lines(spark, tiny_model, scratch):
    enc = E.encode_documents(docs(spark, "lowest lower", "slow"), [(a, b) for a, b, _ in tiny_model.rules])
    lines = {r.doc_id: r.value for r in IO.token_lines(enc).collect()}
    assert lines == {0: "lowe s t </w> lower</w>", 1: "s low</w>"}
    ids = {r.doc_id: r.value for r in IO.id_lines(E.ids_stream(enc, tiny_model.vocab)).collect()}
    assert ids == {0: "4 6 7 2 5", 1: "6 3"}
    out = os.path.join(scratch, "tok")
    IO.write_tokens(enc, out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == sorted(lines.values())


def test_embeddings_and_meta(spark, tiny_model, scratch):
    from wordloom.operators import sgns as G
    from wordloom.sources.options import TrainOptions

    corp = E.encode_documents(docs(spark, "low lower lowest low lower"), [(a, b) for a, b, _ in tiny_model.rules])
    opts = TrainOptions(dim=8, window=2, epochs=1, neg=2, lr=0.05, seed=123)
    res = G.sgns_fit(corp, tiny_model.vocab, opts)
    out = os.path.join(scratch, "emb")
    IO.write_embeddings(res.vectors, out, res.vocabulary_size, fmt="text")
    lines = [r.value for r in spark.read.text(out).collect()]
    assert lines[0] == "tokens=8 dim=8" and len(lines) == 9
    assert lines[1].split("\t")[0] == "<PAD>" and len(lines[1].split("\t")) == 9
    meta = os.path.join(scratch, "meta")
    IO.write_run_metadata(IO.run_row(spark, "b", "c.txt", opts, res), meta, fmt="text")
    kv = [r.value for r in spark.read.text(meta).collect()]
    assert [x.split("=")[0] for x in kv] == IO.RUN_KEYS
    assert "token_count=8" in kv and "vocabulary_size=8" in kv
    runs = os.path.join(scratch, "runs")
    IO.write_run_metadata(IO.run_row(spark, "b", "c.txt", opts, res), runs)
    IO.write_run_metadata(IO.run_row(spark, "b", "c.txt", opts, res), runs)
    assert spark.read.parquet(runs).count() == 2


def test_empty_embedding_file(spark, scratch):
    vecs = spark.createDataFrame([], "token_id bigint, token string, vec array<float>")
    out = os.path.join(scratch, "e0")
    IO.write_embeddings(vecs, out, 5, fmt="text")
    assert [r.value for r in spark.read.text(out).collect()] == ["tokens=5 dim=0"]


def test_read_corpus(spark, scratch):
    d = os.path.join(scratch, "corpus")
    os.makedirs(d)
    _write(os.path.join(d, "b.txt"), b"lower lowest\n")
    _write(os.path.join(d, "a.txt"), b"low low\r\n")
    rows = IO.read_corpus(spark, d).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["low low\r\n", "lower lowest\n"]


def test_argument_checks():
    assert validate_target_size(128) == 128
    for bad in (0, -1, "12", 1.5, True):
        with pytest.raises(ValueError):
            validate_target_size(bad)
    assert validate_sources(input_text="x") == "input"
    with pytest.raises(ValueError):
        validate_sources()
    with pytest.raises(ValueError):
        validate_sources(input_text="x", token_ids="y")


def test_lines_are_numbered_over_blocks_and_files(spark, scratch):
    """A vocabulary in several files and in blocks of a few bytes: no file is one row, ids follow the lines."""
    tokens = [f"t{i}é" for i in range(3000)]
    os.makedirs(os.path.join(scratch, "v"))
    for k in range(3):
        body = "".join(f"{t}\r\n" + "\n" * (i % 3) for i, t in enumerate(tokens[1000 * k : 1000 * k + 1000]))
        _write(os.path.join(scratch, "v", f"part-{k}.voc"), body.encode())
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "700")
    try:
        got = IO.read_vocab(spark, os.path.join(scratch, "v"))
        assert spark.read.text(os.path.join(scratch, "v")).rdd.getNumPartitions() > 10
        assert [(r.token_id, r.token) for r in got.orderBy("token_id").collect()] == list(enumerate(tokens))
    finally:
        spark.conf.set(size, before)
    assert IO.read_vocab(spark, _write(os.path.join(scratch, "empty.voc"), b"\n\r\n")).count() == 0


def test_embeddings_roundtrip(spark, scratch):
    rows = [(i, f"tok{i}</w>", [i / 7, -1.5e-9 * i, 3.0]) for i in range(500)]
    vecs = spark.createDataFrame(rows, "token_id bigint, token string, vec array<float>").repartition(4)
    path = os.path.join(scratch, "x.emb")
    IO.write_embeddings(vecs, path, 500, "text")
    back, n = IO.read_embeddings(spark, path)
    back = back.orderBy("token_id").collect()
    assert n == 500 and [(r.token_id, r.token) for r in back] == [r[:2] for r in rows]
    assert all(abs(a - b) <= 1e-5 * abs(b) + 1e-30 for r, w in zip(back, rows) for a, b in zip(r.vec, w[2]))
    for body in (b"", b"no header\n", b"tokens=1 dim=2\na\t1\n"):
        with pytest.raises(ValueError):
            IO.read_embeddings(spark, _write(os.path.join(scratch, "bad.emb"), body))
    none, n = IO.read_embeddings(spark, _write(os.path.join(scratch, "none.emb"), b"tokens=4 dim=0\n"))
    assert n == 4 and none.count() == 0


def test_id_lines_are_parsed_before_they_are_stored(spark, scratch, monkeypatch):
    p = os.path.join(scratch, "a.ids")
    with open(p, "w") as f:
        f.write("3 4\r\n\n \t \n  007\t5  12 \n99999999999999999999 -1 6 x\n")
    kinds = []
    keep = IO.stored
    monkeypatch.setattr(IO, "stored", lambda df, name="table": kinds.extend(df.dtypes) or keep(df, name))
    rows = IO.read_id_lines(spark, p, "permissive").orderBy("doc_id").collect()
    assert [r.ids for r in rows] == [[3, 4], [7, 5, 12], [6]] and [r.doc_id for r in rows] == [0, 2, 3]
    assert not any(name in ("value", "items") for name, _ in kinds)
    with pytest.raises(IO.MalformedIdsError, match="'99999999999999999999' at item 0 of its line"):
        IO.read_id_lines(spark, p)

"""Registered queries on rows of their own."""

from pyspark.sql import functions as F

from wordloom.operators import skipgram as S
from wordloom.plans import catalog as C
from wordloom.sources import files as IO


def _tables(spark, folder, texts):
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string").write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "one two")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_examples_are_those_of_all_documents(spark, scratch):
    """the examples and their loss come from every document, not from the benchmark's few texts."""
    sf = _tables(spark, scratch, ["the low tower lower still", None, "a newer lower tower", "still the lowest", ""])
    kept, model = C._kept(spark, sf)
    pairs = S.skipgram_pairs(kept, model.vocab, C.WINDOW).agg(F.sum("n")).first()[0]
    got = {r.label: r.n for r in C.q_training_examples(spark, sf).groupBy("label").agg(F.sum("n").alias("n")).collect()}
    assert pairs > 0 and got == {1: pairs, 0: C.NEG * pairs}
    assert C.q_sgns_loss(spark, sf).first().examples == (1 + C.NEG) * pairs


def test_lines_are_sorted_and_numbered_in_bounded_parts(spark, scratch, monkeypatch):
    """more lines go to more tasks, whatever the number of shuffle partitions; order and numbers stay."""
    monkeypatch.setattr(IO, "DOCUMENT_LINES", 4)
    rows = spark.createDataFrame([(50 - i, ["w", str(50 - i)], [50 - i]) for i in range(40)],
                                 "doc_id bigint, tokens array<string>, ids array<bigint>").repartition(3)
    for name, write in (("tok", lambda p: IO.write_tokens(rows, p)), ("ids", lambda p: IO.write_ids(rows, p, "text"))):
        path = f"{scratch}/{name}"
        write(path)
        files = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))
        found = [(r.file, r.value) for r in files.collect()]
        assert len({f for f, _ in found}) >= 8 and max(sum(f == g for g, _ in found) for f, _ in found) <= 12
        lines = [v for _, v in sorted(found, key=lambda x: x[0])]
        assert lines == ([f"w {i}" for i in range(11, 51)] if name == "tok" else [str(i) for i in range(11, 51)])

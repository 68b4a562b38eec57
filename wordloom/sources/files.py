"""Text-file sources and sinks of the tokenizer formats.

Parquet is the native form of every table; the plain-text formats (one
token per line, one rule per line, space-separated ids, tab-separated
vectors, key=value metadata) are exports and imports around it.  Where line
order is the meaning (rule rank, vocabulary id), files are still read in blocks
in parallel: the lines of every block are counted, and the blocks' sums number
the lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.functions import text as T
from wordloom.operators.encode import _few
from wordloom.session import numbered, stored


#: What separates ids in a line.
SPACES = " \t\n\x0b\f\r"


class MalformedIdsError(ValueError):
    pass


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Each file is one document, bytes kept: ``(doc_id, path, text)``.

    doc_id numbers the files in path order; only the paths are sorted, the texts
    stay where they are read and meet their numbers in a join.
    """
    paths = spark.read.format("binaryFile").load(path).select("path")
    ids = numbered(paths, "path", "doc_id").withColumnRenamed("path", "of")
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return raw.join(ids, raw["path"] == ids["of"]).select(F.col("doc_id").cast("bigint").alias("doc_id"), "path", "text")


def _lines(spark: SparkSession, path: str, *values) -> tuple[DataFrame, DataFrame]:
    """Non-empty lines ``(file, block, line, value)``, a trailing CR removed, and one row per block of a file.

    ``line`` grows with the place in a block by one; blocks are ``(file, block,
    first, rows, rank)``, ranked by file and place in the file. ``values`` are
    columns to store instead of ``value``.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.regexp_replace("value", "\r$", "").alias("value")).where(F.length("value") > 0)
    raw = raw.withColumn("line", F.monotonically_increasing_id())
    lines = stored(raw.select("file", "block", "line", *(values or ["value"])), "lines")
    blocks = lines.groupBy("file", "block").agg(F.min("line").alias("first"), F.count(F.lit(1)).alias("rows"))
    rank = F.row_number().over(Window.orderBy("file", "block")) - 1
    return lines, stored(blocks.withColumn("rank", rank.cast("bigint")), "line-blocks")


def _numbers(items: pa.Array) -> pa.Array:
    """Strings of ASCII digits as longs; all others, and those above a long, are null."""
    digits = pc.if_else(pc.ascii_is_decimal(items), items, pa.scalar(None, pa.string()))
    try:
        return digits.cast(pa.int64())
    except pa.ArrowInvalid:
        return pa.array([None if x is None or int(x) >= 1 << 63 else int(x) for x in digits.to_pylist()], pa.int64())


def _id_items():
    """Ids of lines of items between white space, null where malformed (a line without items: null), and the first malformed item."""
    @F.arrow_udf("struct<ids:array<bigint>,bad:string,bad_at:int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in (part for batch in batches for part in _few(batch)):
            lines = pc.ascii_trim(rows, SPACES)
            plain = not pc.any(pc.match_substring_regex(lines, f"[{SPACES[1:]}]|  ")).as_py()
            items = pc.split_pattern(lines, " ") if plain else pc.split_pattern_regex(lines, f"[{SPACES}]+")
            starts = items.offsets.to_numpy().copy()
            words = items.values
            ids = _numbers(words)
            bad, bad_at = [None] * len(lines), [None] * len(lines)
            wrong = np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False))
            in_line = np.searchsorted(starts, wrong, side="right") - 1
            for at, line in zip(wrong[::-1].tolist(), in_line[::-1].tolist(), strict=True):
                bad[line], bad_at[line] = words[at].as_py(), at - int(starts[line])
            empty = pc.equal(pc.binary_length(lines), 0)
            yield pa.StructArray.from_arrays([
                pc.if_else(empty, pa.scalar(None, pa.list_(pa.int64())), pa.ListArray.from_arrays(items.offsets, ids)),
                pc.if_else(empty, pa.scalar(None, pa.string()), pa.array(bad, pa.string())), pa.array(bad_at, pa.int32())],
                ["ids", "bad", "bad_at"])

    return run


def _ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty lines with a trailing CR removed, numbered from 0 after the drop, over the files in path order."""
    lines, blocks = _lines(spark, path)
    before = F.sum("rows").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")
    return lines.join(blocks.withColumn("before", before), ["file", "block"]).select(
        (F.col("before") + F.col("line") - F.col("first")).alias("idx"), F.col("value").alias("line"))


def read_rule_lines(spark: SparkSession, path: str) -> DataFrame:
    """S2 + F3 + F4: ``(rank, rule, a, b)``; invalid rules keep their rank with null sides."""
    lines = _ordered_lines(spark, path)
    a, b = T.parse_rule("line")
    return lines.select((F.col("idx") + 1).cast("int").alias("rank"), F.col("line").alias("rule"), a.alias("a"), b.alias("b"))


def valid_rules(rules: DataFrame) -> DataFrame:
    """rules that can fire, in rank order (gaps kept)."""
    return rules.where(T.rule_can_match("a", "b"))


def rules_list(rules: DataFrame) -> list[tuple[str, str]]:
    """The valid rules in rank order, for building the encode expression (rules are vocabulary sized)."""
    return [(r.a, r.b) for r in valid_rules(rules).orderBy("rank").select("a", "b").collect()]


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """S3: ``(token_id, token)``; the id is the line number after empty lines are dropped."""
    return _ordered_lines(spark, path).select(F.col("idx").cast("bigint").alias("token_id"), F.col("line").alias("token"))


def read_id_lines(spark: SparkSession, path: str, mode: str = "failfast", vocab_size: int | None = None) -> DataFrame:
    """S4 (+ F6): ``(doc_id, ids)``, one row per line with an id, of one ``.ids`` file or a folder of them.

    A line is a document; doc_id grows with file, place of the line's block in
    the file, and line, so the order of the files is kept although they are read
    in blocks in parallel. A malformed item fails the whole read
    (``mode='failfast'``), or is skipped (``mode='permissive'``). With
    ``vocab_size``, ids at or above it are removed, so neighbours close up.
    """
    lines, blocks = _lines(spark, path, _id_items()("value").alias("found"))
    lines = lines.select("file", "block", "line", "found.*").where("ids IS NOT NULL")
    if mode == "failfast":
        bad = lines.where("bad IS NOT NULL").select("bad", "bad_at").limit(1).collect()
        if bad:
            raise MalformedIdsError(f"malformed token id {bad[0].bad!r} at item {bad[0].bad_at} of its line")
    keep = (lambda x: x.isNotNull()) if vocab_size is None else (lambda x: x.isNotNull() & (x < F.lit(vocab_size)))
    return lines.join(blocks, ["file", "block"]).select(
        (F.shiftleft("rank", 32) + F.col("line") - F.col("first")).alias("doc_id"), F.filter("ids", keep).alias("ids"))


def read_ids(spark: SparkSession, path: str, mode: str = "failfast", vocab_size: int | None = None) -> DataFrame:
    """S4 (+ F6) as rows: ``(doc_id, pos, token_id)``, positions within the line."""
    return read_id_lines(spark, path, mode, vocab_size).select("doc_id", F.posexplode("ids").alias("pos", "token_id")).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), "token_id")


def write_vocab(vocab: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Parquet keeps the id column; text is one token per line in id order."""
    if fmt == "parquet":
        vocab.write.mode("overwrite").parquet(path)
    else:
        vocab.coalesce(1).sortWithinPartitions("token_id").select("token").write.mode("overwrite").text(path)


def write_merges(merges: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Parquet keeps the rank; text is ``a + b -> ab`` per line in rank order."""
    if fmt == "parquet":
        merges.write.mode("overwrite").parquet(path)
    else:
        merges.coalesce(1).sortWithinPartitions("rank").select(T.format_rule("a", "b").alias("value")).write.mode(
            "overwrite"
        ).text(path)


#: Lines of documents that one task sorts or numbers, a few KB each.
DOCUMENT_LINES = 1 << 14


def _in_order(lines: DataFrame) -> DataFrame:
    """``value`` of ``(doc_id, value)`` in doc_id order, in range partitions of at most about ``DOCUMENT_LINES`` lines."""
    parts = -(-lines.count() // DOCUMENT_LINES)
    if parts <= int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return lines.orderBy("doc_id").select("value")  # as many parts as the session has for any sort
    return lines.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id").select("value")


def token_lines(doc_tokens: DataFrame) -> DataFrame:
    """S7 body: one line per document, tokens joined by a space."""
    return doc_tokens.select("doc_id", F.array_join("tokens", " ").alias("value"))


def write_tokens(doc_tokens: DataFrame, path: str) -> None:
    """``.tok`` lines, one per document, in doc_id order."""
    lines = stored(token_lines(doc_tokens), "token-lines")  # the partitions' ranges are sampled, without encoding again
    _in_order(lines).write.mode("overwrite").text(path)


def id_lines(ids: DataFrame) -> DataFrame:
    """S8 body: ids of a document joined by a space, in position order.

    ``ids`` has rows ``(doc_id, pos, token_id)`` (groups are documents, bounded
    by one row of text each) or arrays ``(doc_id, ids)``.
    """
    if "ids" not in ids.columns:
        ids = ids.groupBy("doc_id").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("pos", "token_id"))), lambda e: e.token_id).alias("ids"))
    return ids.where(F.size("ids") > 0).select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("value"))


def write_ids(ids: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Parquet as given, or ``.ids`` text lines in doc_id order."""
    if fmt == "parquet":
        ids.write.mode("overwrite").parquet(path)
    else:
        _in_order(id_lines(ids)).write.mode("overwrite").text(path)


def _fmt(x):
    s = F.format_string("%.6g", x.cast("double"))
    # drop trailing zeros of the fraction (printf-style %g without '#')
    return F.regexp_replace(F.regexp_replace(s, r"(\.[0-9]*?)0+(e|$)", "$1$2"), r"\.(e|$)", "$1")


def embedding_lines(vectors: DataFrame, vocab_size: int) -> DataFrame:
    """S9 body: header ``tokens=N dim=D`` then ``token<TAB>v1<TAB>...`` per id (``dim=0`` header alone)."""
    spark = vectors.sparkSession
    first = vectors.select(F.size("vec").alias("d")).limit(1).collect()
    dim = first[0].d if first else 0
    header = spark.createDataFrame([(-1, f"tokens={vocab_size} dim={dim}")], "token_id bigint, value string")
    if dim == 0:
        return header
    body = vectors.select("token_id", F.concat_ws("\t", "token", F.array_join(F.transform("vec", _fmt), "\t")).alias("value"))
    return header.unionByName(body)


def write_embeddings(vectors: DataFrame, path: str, vocab_size: int, fmt: str = "parquet") -> None:
    """Parquet ``(token_id, token, vec)`` (lossless) or the text format."""
    if fmt == "parquet":
        vectors.write.mode("overwrite").parquet(path)
    else:
        embedding_lines(vectors, vocab_size).coalesce(1).sortWithinPartitions("token_id").select("value").write.mode(
            "overwrite"
        ).text(path)


def read_embeddings(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """S9 read again: ``(token_id, token, vec)`` of the text format, and the number of tokens its header states.

    Rows are numbered in the order of the lines; the header must state their width.
    """
    lines = stored(_ordered_lines(spark, path), "embedding-lines")
    head = [r.line for r in lines.where("idx = 0").select("line").collect()]
    found = re.fullmatch(r"tokens=(\d+) dim=(\d+)", head[0]) if head else None
    if found is None:
        raise ValueError("an embedding file begins with tokens=N dim=D")
    cut = lines.where("idx > 0").withColumn("c", F.split("line", "\t"))
    if not cut.where(F.size("c") != 1 + int(found[2])).isEmpty():
        raise ValueError(f"a line does not hold a token and {found[2]} values")
    vec = F.transform(F.slice("c", 2, max(int(found[2]), 1)), lambda x: x.cast("float"))
    return cut.select((F.col("idx") - 1).alias("token_id"), F.col("c")[0].alias("token"), vec.alias("vec")), int(found[1])


RUNS_SCHEMA = (
    "tokenizer string, corpus string, dim int, window int, epochs int, neg int, lr double, seed bigint, "
    "token_count bigint, vocabulary_size bigint, elapsed_ms bigint"
)
RUN_KEYS = ["tokenizer", "corpus", "dim", "window", "epochs", "neg", "lr", "seed", "token_count",
            "vocabulary_size", "elapsed_ms"]


def run_row(spark: SparkSession, tokenizer: str, corpus: str, options, result) -> DataFrame:
    """One ``runs`` row (11 columns)."""
    return spark.createDataFrame(
        [(tokenizer, corpus, options.dim, options.window, options.epochs, options.neg, float(options.lr),
          options.seed, result.token_count, result.vocabulary_size, result.elapsed_ms)],
        RUNS_SCHEMA,
    )


def write_run_metadata(run: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append to the ``runs`` table, or write ``key=value`` lines."""
    if fmt == "parquet":
        run.write.mode("append").parquet(path)
    else:
        r = run.collect()[0]
        lines = [(i, f"{k}={r[k]}") for i, k in enumerate(RUN_KEYS)]
        run.sparkSession.createDataFrame(lines, "i int, value string").orderBy("i").select("value").coalesce(1).write.mode(
            "overwrite"
        ).text(path)

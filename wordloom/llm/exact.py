"""Exact deduplication by composable polynomial fingerprints and a chunkwise comparison.

A text's bytes are the digits of a number in base 256; its fingerprint is that
number modulo a prime, so ``f(ab) = f(a) * 256^len(b) + f(b)``: chunks are hashed
apart, in any task, and combined by length-shifted arithmetic. A text of up to
``huge_bytes`` is hashed where it is read; the chunks of a larger one are dealt
over the cluster.

Equal fingerprints are only candidates. Their texts are compared chunk by chunk:
for every (fingerprint, place) the least and the greatest chunk are kept, first
inside each task, so a group of any size sends a few chunks per task; all texts
of a group are equal when both agree at every place. Where they do not, the
group is split by its first place that differs, and compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import bounded_batches, materialize

#: A prime p of 127 bits with (p - 1) / 2 prime too: the powers of 256 do not repeat early (modulo 2^127 - 1 they would).
PRIME = 85070591730234615865843651883156960039
CHUNK_BYTES = 1 << 16
HUGE_BYTES = 1 << 22
#: Keys (of 24 bytes) of groups that may be broadcast.
BROADCAST_KEYS = 1 << 18


def chunk_fingerprint(data: bytes, prime: int = PRIME) -> int:
    return int.from_bytes(data, "big") % prime


def combine(parts, prime: int = PRIME) -> int:
    """The fingerprint of a text from its chunks' ``(fingerprint, length)`` in order."""
    out = 0
    for fp, n in parts:
        out = (out * pow(256, n, prime) + fp) % prime
    return out


def _chunks(data: Column, chunk: int) -> Column:
    """Array of a binary's chunks in order; an empty one has a single empty chunk."""
    count = F.greatest(F.ceil(F.octet_length(data) / F.lit(chunk)).cast("int"), F.lit(1))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(data, i * chunk + 1, F.lit(chunk)))


def _hashed(prime: int):
    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for chunks in batches:
            yield chunks.map(lambda c: chunk_fingerprint(c, prime).to_bytes(16, "big"))

    return run


def _whole(prime: int, chunk: int):
    """Fingerprint of a text of moderate size, chunk after chunk."""
    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: combine(
                ((chunk_fingerprint(t[i : i + chunk], prime), len(t[i : i + chunk])) for i in range(0, len(t), chunk)),
                prime).to_bytes(16, "big"))

    return run


def _combined(prime: int):
    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield rows.map(lambda parts: combine(
                ((int.from_bytes(p["fp"], "big"), p["n"]) for p in parts), prime).to_bytes(16, "big"))

    return run


class Fingerprinted:
    """The stored rows of a table with their fingerprints: ``rows`` (row, id, size, sha, fp) and their chunks."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, prime: int, chunk: int, huge: int):
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        read = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("size", F.octet_length("text"))
        sha, number = F.sha2("text", 256).alias("sha"), F.monotonically_increasing_id()
        data = F.col("text").cast("binary")
        small = bounded_batches(read.filter(F.col("size") <= huge)).select(
            (number * 2).alias("row"), "id", "size", sha, _whole(prime, chunk)(data).alias("fp"), data.alias("data"))
        self.small = materialize(small, "hashed-texts")
        large = read.filter(F.col("size") > huge).select((number * 2 + 1).alias("row"), "id", "size", sha, data.alias("data"))
        large = materialize(large, "huge-texts").select(  # stored first: a task that runs again finds the same numbers
            "row", "id", "size", "sha", F.posexplode(_chunks(F.col("data"), chunk)).alias("place", "chunk"))
        self.parts = materialize(large.repartition("row", "place").withColumn("fp", _hashed(prime)("chunk")), "hashed-chunks")
        part = F.struct("place", "fp", F.octet_length("chunk").alias("n"))  # of one text; the chunks stay where they are
        joined = self.parts.groupBy("row", "id", "size", "sha").agg(F.array_sort(F.collect_list(part)).alias("p"))
        self.large = materialize(joined.withColumn("fp", _combined(prime)("p")).drop("p"), "combined")
        self.rows = self.small.drop("data").unionByName(self.large)
        self.chunk = chunk

    def chunks(self, groups: DataFrame) -> DataFrame:
        """(row, fp, size, place, chunk) of the rows whose (fp, size) is in ``groups``."""
        found = self.small.join(groups, ["fp", "size"], "left_semi").select(
            "row", "fp", "size", F.posexplode(_chunks(F.col("data"), self.chunk)).alias("place", "chunk"))
        ids = self.large.join(groups, ["fp", "size"], "left_semi").select("row", F.col("fp").alias("whole"))
        return found.unionByName(self.parts.join(ids, "row").select(
            "row", F.col("whole").alias("fp"), "size", "place", "chunk"))


def _differing(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """The first place at which a group's texts differ, with its least chunk: (*keys, place, least)."""
    ends = chunks.groupBy(*keys, "place").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    first = F.min(F.struct("place", "least"))
    return ends.filter("least <> most").groupBy(*keys).agg(first.alias("f")).select(*keys, "f.*")


def _split(texts: Fingerprinted, unequal: DataFrame) -> DataFrame:
    """(row, part): the rows of groups that hold different texts, ``part`` equal only for equal texts of a group."""
    chunks = materialize(texts.chunks(unequal.select("fp", "size")), "unequal-chunks")
    part = materialize(chunks.filter("place = 0").select("row", "fp", "size", F.lit("").alias("part")), "parts")
    while True:
        keys = ["fp", "size", "part"]
        found = materialize(_differing(chunks.join(part.select("row", "part"), "row"), keys), "unequal")
        if found.isEmpty():
            return part.select("row", "part")
        at = chunks.select("row", "place", "chunk")
        moved = part.join(found, keys).join(at, ["row", "place"]).select(
            "row", F.concat("part", F.when(F.col("chunk") == F.col("least"), "0").otherwise("1")).alias("to"))
        part = materialize(part.join(moved, "row", "left").select(
            "row", "fp", "size", F.coalesce("to", "part").alias("part")), "parts")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prime: int = PRIME,
                     chunk_bytes: int = CHUNK_BYTES, huge_bytes: int = HUGE_BYTES) -> DataFrame:
    """(id, keep_id, group_size, kept, sha256, fp): one row per row of ``docs``; equal texts are one group.

    The row with the largest id stays, one of them if several have it; null ids
    are below all others, and a group without an id has a null ``keep_id`` and
    keeps one row. Null texts are empty ones; all empty texts are one group.
    ``sha256`` is that of the text's UTF-8. Other columns are not read. An
    empty table gives an empty result. ``prime`` may be small: texts that only
    share a fingerprint are told apart by their bytes.
    """
    texts = Fingerprinted(docs, id_col, text_col, prime, chunk_bytes, huge_bytes)
    sized = materialize(texts.rows.groupBy("fp", "size").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "row")).alias("last")), "fingerprint-groups")
    shared = sized.filter("n > 1").select("fp", "size")
    if shared.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        shared = F.broadcast(shared)
    unequal = materialize(_differing(texts.chunks(shared), ["fp", "size"]), "unequal-groups")
    rows, keys = texts.rows, ["fp", "size"]
    if not unequal.isEmpty():
        rows = materialize(rows.join(_split(texts, unequal), "row", "left"), "split-rows").fillna("", ["part"])
        keys = ["fp", "size", "part"]
        sized = materialize(rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "row")).alias("last")), "groups")
    return rows.join(sized, keys).select(
        "id", F.col("last.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("last.row")).alias("kept"), F.col("sha").alias("sha256"), "fp")


def op11_exact(spark, sf_dir: str) -> DataFrame:
    """Groups of equal texts of ``documents``; the row with the largest doc_id stays."""
    from wordloom.llm.common import read_table

    out = exact_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))

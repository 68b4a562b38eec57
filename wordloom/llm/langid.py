"""Language identification by compression with one raw-content dictionary per language.

Text of a language compresses best after text of the same language. For every
learned language a zstandard dictionary is filled with raw text of a bounded
sample of labelled rows; a text goes to the language whose dictionary gives the
smallest result. The relative distance to the second smallest is the score, and
a text whose score is under ``MARGIN`` is marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import bounded_batches, read_table, slices

#: The sample: rows and characters of a row that a language's dictionary is made of, and its greatest size (letters of two bytes).
SAMPLE_ROWS, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 640, 512 << 10
#: More languages than this are an error (their dictionaries go to every task).
MOST_LANGUAGES = 200
LEVEL = 9
MARGIN = 0.01

_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """The lower-cased text with every run of other characters than letters as one space."""
    return _OTHER.sub(" ", text.lower())


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 2 modulo 4 (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[tuple]:
    """(language, dictionary) by falling number of learned rows, from rows that are not held out.

    Every language takes the ``SAMPLE_ROWS`` distinct texts with the least hash,
    so the sample depends on no row order. Rows without id, text or language
    are not learned from; an empty table teaches nothing.
    """
    rows = docs.filter(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)) & F.col(text_col).isNotNull()
                       & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.xxhash64(text_col).alias("mark"),
        F.col(text_col).alias("text"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("mark").alias("texts"))
    found = counts.orderBy(F.desc("rows"), "lang").take(MOST_LANGUAGES + 1)
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    langs = [r["lang"] for r in found]
    # hashes are spread evenly: about twice the sample lies under this bound, so no language is ranked as a whole
    bounds = [(r["lang"], min((1 << 63) - 1, int(2 * SAMPLE_ROWS / r["texts"] * (1 << 64)) - (1 << 63))) for r in found]
    bound = F.broadcast(docs.sparkSession.createDataFrame(bounds, "lang string, bound bigint"))
    few = rows.join(bound, "lang").filter("mark <= bound").groupBy("lang", "mark").agg(
        F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("text"))
    chosen = few.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("mark"))).filter(
        F.col("k") <= SAMPLE_ROWS)
    sample: dict[str, list[tuple]] = {lang: [] for lang in langs}
    for r in chosen.collect():  # at most SAMPLE_ROWS rows per language
        sample[r["lang"]].append((r["mark"], letters(r["text"])))
    return [(lang, " ".join(t for _, t in sorted(sample[lang])).encode()[-DICTIONARY_BYTES:]) for lang in langs]


class Classifier:
    """Compressors of all languages; ties go to the language that comes first."""

    def __init__(self, dictionaries: list[tuple[str, bytes]]):
        import zstandard

        self.tools = []
        for lang, content in dictionaries:
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            self.tools.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False)))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score); ``und`` and 0 for null, for texts without a letter and with nothing learned."""
        line = letters(text) if text else ""
        if not self.tools or not any(map(str.isalpha, line)):
            return "und", 0.0
        raw = line.encode()
        sizes = [(len(tool.compress(raw)), k) for k, (_, tool) in enumerate(self.tools)]
        best, *rest = sorted(sizes)
        score = 1 - best[0] / rest[0][0] if rest else 1.0
        return self.tools[best[1]][0], min(1.0, max(0.0, score))


def identify(docs: DataFrame, dictionaries: list[tuple[str, bytes]], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected): one row per row of ``docs``, from all letters of its whole text.

    Null texts and texts without a letter are ``und`` with score 0. Null ids
    and repeated rows are kept, other columns are not read. ``rejected`` is
    true where the margin is narrow and for ``und``. An empty table gives an
    empty result.
    """
    bounded_batches(docs)
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Classifier(shared.value)
        for batch in batches:
            found = [tool.predict(t) for _, (_, texts) in slices(batch) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[1] < MARGIN for f in found], pa.bool_())], ["id", "lang_pred", "score", "rejected"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, lang_pred string, score double, rejected boolean")


def op7_langid(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, learn(docs)).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score", "rejected")

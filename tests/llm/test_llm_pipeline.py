import collections

import numpy as np

import corpus_pipeline as C
from wordloom.llm import pieces, secrets

from test_llm_decontam import slow as slow_decontam
from test_llm_secrets import slow as slow_secrets
from test_llm_simhash import near, slow_components, slow_fingerprint


def test_stages_against_brute_force(spark, tmp_path):
    """Every stage's rows on a small table; the quality verdicts themselves are tested with the operator."""
    import random

    from conftest import sentence
    from wordloom.llm import quality

    rng = random.Random(9)
    rows = [(i, sentence(rng, rng.randrange(5, 90), 3000), ("en", "de")[i % 2], "a", 0) for i in range(150)]
    rows += [(200 + i, rows[i][1], "en", "b", 0) for i in range(0, 30, 3)]
    rows += [(300 + i, rows[i][1] + " token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" x", "en", "a", 0) for i in range(40, 50)]
    rows += [(None, sentence(rng, 50), None, None, None), (400, None, "en", "a", None), (401, "", "en", "a", 0)]
    items = [(k, " ".join(rows[i][1].split()[2:18])) for k, i in enumerate(range(60, 70)) if len(rows[i][1].split()) > 20]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = C.run(spark, str(tmp_path)).collect()

    docs = spark.createDataFrame(rows, schema)
    kept = {r.id for r in quality.quality_report(docs).collect() if r.kept}
    left = [r for r in rows if r[0] in kept]
    x = np.array([slow_fingerprint(r[1]) for r in left], np.uint64)
    root = slow_components(near(x, 3), len(left))
    least = {}
    for r, c in zip(left, root, strict=True):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    left = [r for r, c in zip(left, root, strict=True) if r[0] == least.get(c)]
    dirty = {r[0] for r in left if sum(n * bool(hit) for (_, hit, _), n in slow_decontam([r], items, 10).items())}
    assert dirty
    left = [r for r in left if r[0] not in dirty]

    def clean(text):
        out, at = "", 0
        for a, _, _, b in slow_secrets(text):
            if a >= at:
                out += text[at:a] + "[secret]"
            at = max(at, b)
        return out + text[at:]

    tool = pieces.segmenter(pieces.model_path())
    want = {r[0]: clean(r[1]) for r in left}
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(list(want))
    assert sum("[secret]" in t for t in want.values())
    for r in got:
        assert tool.decode(r.ids) == want[r.doc_id] and r.lossless
        assert not slow_secrets(tool.decode(r.ids))


def test_stages_keep_the_columns(spark, odd_docs, tmp_path):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b c")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in C.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != C.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert len(C.STAGES) == 5 and secrets.RULES


def test_contaminated_rows_go_alone(spark, tmp_path):
    """A clean text stays beside a contaminated one that shares its id, or that has no id either."""
    item = " ".join(f"item{i}" for i in range(12))
    rows = [(None, f"one {item} two"), (None, "a clean text without an id"), (7, f"{item} here"), (7, "clean under seven"),
            (7, None), (None, None), (8, f"one {item} two"), (9, f"{item} here"), (9, f"{item} here")]
    rows = [(i, t, "en", "a", 0) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = C.decontaminate(spark, docs.repartition(2), str(tmp_path))
    assert got.columns == docs.columns
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(
        r for r in rows if r[1] is None or item not in r[1])


def test_near_dedup_by_row(spark, odd_docs):
    """A text stays although its id also names a copy of another text, however the rows are dealt out."""
    a, b, c = "one two three four five six", "quite another text of seven words here", "a third text without any id"
    rows = [(3, a), (7, a), (7, b), (3, a), (None, c), (None, c), (None, b + " x y z"), (9, None), (8, "")]
    rows = [(i, t, "en", "s", 0) for i, t in rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for parts in (1, 2, 3, 9):
        got = C.near_dedup(spark, spark.createDataFrame(rows, schema).repartition(parts), "")
        assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert collections.Counter((r.doc_id, r.text) for r in got.collect()) == collections.Counter(
            [(3, a), (7, b), (None, c), (None, b + " x y z"), (8, "")])
    extra = C.near_dedup(spark, odd_docs, "")  # columns with clashing names go along
    assert extra.columns == odd_docs.columns and extra.count() > 40
    assert C.near_dedup(spark, odd_docs.limit(0), "").count() == 0

import collections
import math
import re

import numpy as np

from wordloom.llm import quality as Q


def slow_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside),
            len(lines))


def slow_vector(c):
    n, chars, symbols, dup, repeated, lines = c
    return [math.log(1 + n), math.log(chars / n), math.log(1 + 100 * symbols / chars),
            math.log(1 + 100 * repeated / n), math.log(1 + 100 * dup / lines)]


def low_bin(values, share):
    """The least bin at which the running count reaches the share."""
    b = np.sort(values)
    return b[math.ceil(share * len(b) - 1e-9) - 1]


def floored(cov):
    """The covariance whose pivots are at least the least spreads."""
    low, d = np.eye(Q.D), np.zeros(Q.D)
    for i in range(Q.D):
        for j in range(i):
            low[i, j] = (cov[i, j] - sum(low[i, k] * low[j, k] * d[k] for k in range(j))) / d[j]
        d[i] = max(cov[i, i] - sum(low[i, k] ** 2 * d[k] for k in range(i)), Q.VECTOR[i][1] ** 2)
    return low @ np.diag(d) @ low.T


def slow_starts(x):
    bins = np.floor(x / Q.STEP)
    q1, q2, q3 = (np.array([low_bin(bins[:, i], s) for i in range(Q.D)]) for s in (0.25, 0.5, 0.75))
    mean = Q.STEP * (q2 + 0.5)
    spread = np.maximum(Q.STEP * (q3 - q1) / 1.349, [s for _, s in Q.VECTOR])
    z = (x - mean) / spread
    signs = z / np.maximum(np.linalg.norm(z, axis=1), 1e-12)[:, None]
    for c in (np.eye(Q.D), np.cov(np.tanh(z).T, bias=True), signs.T @ signs / len(z)):
        norm = np.outer(np.diag(c), np.diag(c))
        r = np.where(norm > 1e-12, c / np.sqrt(np.maximum(norm, 1e-300)), 0.0)
        np.fill_diagonal(r, 1.0)
        yield mean, floored(r * np.outer(spread, spread))


def slow_estimate(x):
    """Minimum covariance determinant by concentration steps from several starts, with numpy's linear algebra.

    Also the logarithms of the determinants, step by step, of each start.
    """
    best, paths = None, []
    for mean, cov in slow_starts(x):
        path = []
        for _ in range(Q.STEPS):
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            b = np.floor(Q.BINS * np.log(np.clip(d, 1e-6, 1e6)))
            kept = x[b <= low_bin(b, Q.SHARE)]
            new = floored(Q.CONSISTENCY * np.cov(kept.T, bias=True))
            ld = np.linalg.slogdet(new)[1]
            if path and ld >= path[-1] - Q.FALL:
                break
            path.append(ld)
            mean, cov = kept.mean(axis=0), new
        paths.append(path)
        if best is None or path[-1] < best[0] - 1e-9:
            best = path[-1], mean, cov
    assert best[0] <= min(p[-1] for p in paths) + 1e-6
    return best[1], best[2]


def test_chi_square():
    assert abs(Q.chi2_quantile(0.95, 1) - 3.841459) < 1e-5 and abs(Q.chi2_quantile(0.99, 5) - 15.08627) < 1e-4


def test_counts_of_odd_texts(odd_docs, odd_rows):
    got = Q.with_statistics(odd_docs).select("doc_id", "text", "q.*").collect()
    assert len(got) == len(odd_rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lines) == slow_counts(r.text)


def test_report_against_numpy(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(900):
        lang, source = ("en", "de")[i % 2], ("a", "b", None)[i % 3]
        n = int(rng.integers(12, 200))
        words = ["".join(rng.choice(list("abcde"), int(rng.integers(2, 9)))) for _ in range(n)]
        if i % 20 == 0:
            words = [w + "$$#" for w in words]
        if i % 31 == 0:
            words = [w * 5 for w in words]
        rows.append((i, " ".join(words).replace("a b", "a\nb"), lang, source))
    rows += [(i, "one two three four five six seven eight nine ten " + "xy " * (i % 7), None, "z") for i in range(900, 930)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r.id: r for r in Q.quality_report(df).collect()}
    counts = {i: slow_counts(t) for i, t, *_ in rows}
    fails = {i: c[0] < 10 or 100 * c[4] > 20 * c[0] for i, c in counts.items()}
    groups = collections.defaultdict(list)
    for i, _, lang, source in rows:
        if not fails[i]:
            for key in ((0, lang, source), (1, lang), (2,)):
                groups[key].append(i)
    fit = {}
    for i, _, lang, source in rows:
        r = got[i]
        assert r.base_failed == fails[i]
        if fails[i]:
            assert not r.kept
            continue
        key = next(k for k in ((0, lang, source), (1, lang), (2,)) if len(groups[k]) >= Q.MIN_ROWS or k == (2,))
        if key not in fit:
            fit[key] = slow_estimate(np.array([slow_vector(counts[j]) for j in groups[key]]))
        mean, cov = fit[key]
        x = np.array(slow_vector(counts[i])) - mean
        d = x @ np.linalg.inv(cov) @ x
        assert abs(r.distance - d) < 1e-6 * max(1, d) and r.kept == (d <= Q.LIMIT)
    junk = [i for i in range(0, 900, 20)]
    assert sum(got[i].kept for i in junk) == 0 and sum(r.kept for r in got.values()) > 750
    assert sorted(r.doc_id for r in Q.quality_filter(df).collect()) == sorted(i for i, r in got.items() if r.kept)


def test_odd_rows_and_clashing_columns(odd_docs, odd_rows):
    got = Q.quality_report(odd_docs).collect()
    assert len(got) == len(odd_rows) and all(not r.kept for r in got if r.q.n_words < 10)
    out = Q.quality_filter(odd_docs)
    assert out.columns == odd_docs.columns
    assert out.count() == sum(r.kept for r in got)


def test_empty_table(no_docs):
    assert Q.quality_report(no_docs).count() == 0 and Q.quality_filter(no_docs).count() == 0


def test_every_component_can_reject(spark):
    """Planted outliers of one component each, in texts that are ordinary otherwise; the ordinary ones stay."""
    rng = np.random.default_rng(12)

    def text(n, low=3, high=9):
        return ["".join(rng.choice(list("abcdefghijklm"), int(rng.integers(low, high)))) for _ in range(n)]

    def lines(words, every=10):
        return "\n".join(" ".join(words[i : i + every]) for i in range(0, len(words), every))

    rows = [(i, lines(text(int(rng.integers(60, 140))))) for i in range(600)]
    planted = []
    for i in range(6):
        planted.append((1000 + i, "\n".join(f"{' '.join(text(8))}\nread more" for _ in range(9))))  # half of the lines
        planted.append((2000 + i, lines([w + "#" for w in text(90)])))
        words = text(100)
        planted.append((3000 + i, lines(words[:50] + words[40:50] + words[50:])))  # repeated words
        planted.append((4000 + i, lines(text(90, 20, 30))))
        planted.append((5000 + i, lines(text(9000))))
    df = spark.createDataFrame([(*r, "en", "a") for r in rows + planted], "doc_id bigint, text string, lang string, source string")
    got = {r.id: r for r in Q.quality_report(df).collect()}
    assert all(not got[i].kept for i, _ in planted)
    assert not any(got[i].base_failed for i, _ in planted) and sum(got[i].kept for i, _ in rows) >= 590
    for i, (_, least) in enumerate(Q.VECTOR[2:], 2):  # the largest values that pass the base rules
        most = (None, None, math.log(101), math.log(21), math.log(101))[i]
        assert most**2 / least**2 > Q.LIMIT

"""DuckDB SQL for the queries that SQL can express: plain definitions, without the operators' methods."""

from __future__ import annotations

from wordloom.llm import quality as Q
from wordloom.llm import secrets

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = "regexp_extract_all(coalesce({text}, ''), '[^\\x20\\x09-\\x0D]+')"


def _folded_words(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), "
            "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")


def decontaminate(length: int = 10) -> str:
    """Every window of every document looked up among the items' windows."""
    return f"""
WITH items AS MATERIALIZED (SELECT item_id, {_folded_words('text')} AS w FROM benchmark),
wins AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), {length}) AS size, array_to_string(w[i:i + least(len(w), {length}) - 1], ' ') AS win
  FROM items, range(1, greatest(len(w) - {length} + 1, 1) + 1) r(i) WHERE len(w) > 0),
docs AS MATERIALIZED (SELECT doc_id, {_folded_words('text')} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM wins),
found AS MATERIALIZED (
  SELECT p.doc_id, p.i, p.size, x.item_id FROM (
    SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM docs, sizes, range(1, len(w) - size + 2) r(i)) p
  JOIN wins x ON x.win = p.win AND x.size = p.size),
hit AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, k FROM found, range(i, i + size) q(k)) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n, sha256(string_agg(id, ',' ORDER BY id)) AS h FROM
  (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
  coalesce(m.h, sha256('')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM docs d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN named m ON m.doc_id = d.doc_id"""


def substrings(window: int = 35) -> str:
    """All windows of all documents counted by their words."""
    return f"""
WITH docs AS MATERIALIZED (SELECT doc_id, {_SPACED.format(text='text')} AS w FROM documents),
wins AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(w[i:i + {window - 1}], ' ')) AS win
  FROM docs, range(1, len(w) - {window} + 2) r(i)),
twice AS (SELECT win FROM wins GROUP BY 1 HAVING count(*) > 1),
gone AS MATERIALIZED (SELECT DISTINCT s.doc_id, k FROM wins s JOIN twice t ON t.win = s.win, range(s.i, s.i + {window}) q(k)),
words AS (SELECT d.doc_id, p AS i, d.w[p] AS word FROM docs d, range(1, len(d.w) + 1) r(p)),
kept AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.i) FILTER (WHERE g.k IS NULL) AS t, count(g.k) AS n
  FROM words x LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.k = x.i GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(k.n, 0)::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id"""


def exact_duplicates() -> str:
    return """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW same AS (PARTITION BY t)"""


def divergence(least_docs: int = 10, top_terms: int = 10) -> str:
    """Every group with every kept term of its language, and every pair of its groups."""
    share = "1 + (1000000000::HUGEINT * ({n} + 2)) // ({total} + 2 * v)"
    far = "((p - q) * (p - q)) // (p + q)"
    return f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
said AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM docs),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS all_n FROM said GROUP BY 1, 2 HAVING count(DISTINCT r) >= {least_docs}),
langs AS (SELECT lang, count(*) AS v, sum(all_n) AS lang_n FROM kept GROUP BY 1),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM said JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
own AS (SELECT lang, source, sum(n) AS own_n FROM counts GROUP BY 1, 2),
cells AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {share.format(n='coalesce(c.n, 0)', total='coalesce(o.own_n, 0)')} AS p,
    {share.format(n='k.all_n', total='l.lang_n')} AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
    LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT lang, source, item, sum({far}) AS value FROM (
  SELECT a.lang, a.source, b.source AS item, a.p, b.p AS q FROM cells a JOIN cells b
    ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source) GROUP BY 1, 2, 3),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM groups a
    JOIN groups b ON b.lang = a.lang AND b.source <> a.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, {far} FROM cells WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= {top_terms}"""


def _re2(pattern: str) -> str:
    """A rule's expression for RE2, whose ``(?i)`` would fold more letters than ASCII ones."""
    if pattern.startswith("(?i)"):
        out, depth = "", 0
        for k, c in enumerate(pattern[4:]):
            depth += (c == "[") - (c == "]")
            escaped = pattern[4 + k - 1] == "\\" if k else False
            out += f"[{c.upper()}{c}]" if c.isalpha() and not depth and not escaped and c != "x" else c
        pattern = out
    return pattern.replace("'", "''")


def secret_spans() -> str:
    """Every rule run on every text; the text between matches and the matches add up to positions."""
    parts = []
    for rank, rule in enumerate(secrets.RULES):
        pattern = _re2(rule.pattern)
        parts.append(
            f"SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, string_split_regex(t, '{pattern}') AS p, "
            f"regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS g, "
            f"{rule.least} AS least FROM docs WHERE regexp_matches(t, '{pattern}')")
    union = "\n  UNION ALL ".join(parts)
    base = len(secrets.BASE)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)
    outs = ", ".join(f"coalesce(s.n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in secrets.BASE)
    return f"""
WITH docs AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hits AS MATERIALIZED (
  {union}),
placed AS (SELECT doc_id, rank, kind, least, length(g[k]) AS got, length(m[k]) AS size,
  list_sum(list_transform(p[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0) AS s
  FROM hits, range(1, len(m) + 1) r(k)),
spans AS (SELECT doc_id, rank, kind, s::BIGINT AS s, kind || ':' || s::BIGINT || ':' || (s + size)::BIGINT AS line FROM placed WHERE got >= least),
per AS (SELECT doc_id, {counts}, string_agg(line, ',' ORDER BY s, rank) FILTER (WHERE rank < {base}) AS base,
  string_agg(line, ',' ORDER BY s, rank) AS spans FROM spans GROUP BY 1)
SELECT d.doc_id, {outs}, sha256(coalesce(s.base, '')) AS base_sha256, coalesce(s.spans, '') AS spans
FROM docs d LEFT JOIN per s ON s.doc_id = d.doc_id"""


def _distance(x: str = "x", est: str = "e") -> str:
    """Squared Mahalanobis distance by forward substitution, as an expression."""
    y: list[str] = []
    for i in range(Q.D):
        y.append(f"({x}.x_{i} - {est}.m_{i}" + "".join(f" - {est}.l_{i}_{k} * {y[k]}" for k in range(i)) + ")")
    return " + ".join(f"{v} * {v} / {est}.d_{i}" for i, v in enumerate(y))


def _factors() -> str:
    """Columns d_i and l_i_j from covariances c_i_j, each from those before it."""
    out = []
    for i in range(Q.D):
        for j in range(i):
            rest = "".join(f" - l_{i}_{k} * l_{j}_{k} * d_{k}" for k in range(j))
            out.append(f"(c_{i}_{j}{rest}) / d_{j} AS l_{i}_{j}")
        rest = "".join(f" - l_{i}_{k} * l_{i}_{k} * d_{k}" for k in range(i))
        out.append(f"greatest(c_{i}_{i}{rest}, {Q.VECTOR[i][1] ** 2!r}) AS d_{i}")
    return ", ".join(out) + ", " + " + ".join(f"ln(d_{i})" for i in range(Q.D)) + " AS ld"


def quality() -> str:
    """Counts by unnesting; the concentration steps one after the other."""
    xs = ", ".join(f"x_{i}" for i in range(Q.D))
    covs = [(i, j) for i in range(Q.D) for j in range(i + 1)]
    ctes = [
        f"docs AS MATERIALIZED (SELECT doc_id, lang, source, coalesce(text, '') AS t, {_SPACED.format(text='text')} AS w FROM documents)",
        "grams AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(w[i:i + 4], ' ')) AS g FROM docs, range(1, len(w) - 4 + 1) r(i))",
        "twice AS (SELECT doc_id, g FROM grams GROUP BY 1, 2 HAVING count(*) > 1)",
        "rep AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT s.doc_id, k FROM grams s JOIN twice t ON t.doc_id = s.doc_id "
        "AND t.g = s.g, range(s.i, s.i + 5) q(k)) GROUP BY 1)",
        "cut AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ln FROM docs)",
        "stats AS MATERIALIZED (SELECT c.doc_id, c.lang, c.source, len(c.w)::BIGINT AS n_words, "
        "coalesce(list_sum(list_transform(c.w, lambda x: length(x))), 0)::BIGINT AS word_chars, "
        "length(regexp_replace(c.t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, "
        "(len(c.ln) - len(list_distinct(c.ln)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, "
        "len(c.ln)::BIGINT AS n_lines FROM cut c LEFT JOIN rep r ON r.doc_id = c.doc_id)",
        "vec AS MATERIALIZED (SELECT doc_id, lang, source, ln(1.0 + n_words) AS x_0, ln(word_chars::DOUBLE / n_words) AS x_1, "
        "ln(1.0 + 100.0 * n_symbols / word_chars::DOUBLE) AS x_2, ln(1.0 + 100.0 * n_repeat_words / n_words::DOUBLE) AS x_3, "
        "ln(1.0 + 100.0 * n_dup_lines / n_lines::DOUBLE) AS x_4 FROM stats "
        "WHERE n_words >= 10 AND 100 * n_repeat_words <= 20 * n_words)",
    ]
    lang, source = "coalesce('=' || lang, '')", "coalesce('=' || source, '')"
    keys = [f"'0' || chr(31) || {lang} || chr(31) || {source}", f"'1' || chr(31) || {lang}", "'2'"]
    ctes.append("lev AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT {k} AS key, {xs} FROM vec" for k in keys) + ")")

    def quantiles(counts: str, by: str, shares: dict[str, float]) -> str:
        outs = ", ".join(f"min(b) FILTER (WHERE run >= {share!r} * total) AS {name}" for name, share in shares.items())
        return (f"SELECT {by}, max(total) AS n, {outs} FROM (SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY b) AS run, "
                f"sum(n) OVER (PARTITION BY {by}) AS total FROM {counts}) GROUP BY {by}")

    bins = " UNION ALL ".join(f"SELECT key, {i} AS i, floor(x_{i} / {Q.STEP!r}) AS b, count(*) AS n FROM lev GROUP BY 1, 2, 3" for i in range(Q.D))
    ctes.append(f"b0 AS ({bins})")
    ctes.append(f"q0 AS ({quantiles('b0', 'key, i', {'q1': 0.25, 'q2': 0.5, 'q3': 0.75})})")
    mids = ", ".join(f"max({Q.STEP!r} * (q2 + 0.5)) FILTER (WHERE i = {i}) AS m_{i}" for i in range(Q.D))
    spread = f"{Q.STEP!r} * (q3 - q1) / 1.349"
    spreads = ", ".join(f"max(greatest({spread}, {Q.VECTOR[i][1]!r})) FILTER (WHERE i = {i}) AS s_{i}" for i in range(Q.D))
    ms = ", ".join(f"m_{i}" for i in range(Q.D))
    ctes.append(f"mid AS MATERIALIZED (SELECT key, max(n) AS n, {mids}, {spreads} FROM q0 GROUP BY key)")
    zs = ", ".join(f"(x.x_{i} - m.m_{i}) / m.s_{i} AS z_{i}" for i in range(Q.D))
    size = "greatest(sqrt(" + " + ".join(f"z_{i} * z_{i}" for i in range(Q.D)) + "), 1e-12)"
    ctes.append(f"z AS (SELECT x.key, {zs} FROM lev x JOIN mid m ON m.key = x.key)")
    ctes.append("tu AS (SELECT key, " + ", ".join(f"tanh(z_{i}) AS t_{i}, z_{i} / {size} AS u_{i}" for i in range(Q.D)) + " FROM z)")
    ctes.append("co AS (SELECT key, " + ", ".join(
        f"avg(t_{i} * t_{j}) - avg(t_{i}) * avg(t_{j}) AS t_{i}_{j}, avg(u_{i} * u_{j}) AS u_{i}_{j}" for i, j in covs) + " FROM tu GROUP BY key)")
    first = []
    for start in range(Q.STARTS):
        v = " tu"[start]
        cs = ", ".join(
            f"s_{i} * s_{j} AS c_{i}_{j}" if i == j else f"0.0::DOUBLE AS c_{i}_{j}" if not start else
            f"CASE WHEN {v}_{i}_{i} * {v}_{j}_{j} > 1e-12 THEN s_{i} * s_{j} * {v}_{i}_{j} / sqrt({v}_{i}_{i} * {v}_{j}_{j}) ELSE 0.0 END AS c_{i}_{j}"
            for i, j in covs)
        first.append(f"SELECT m.key, {start} AS start, n, {ms}, {cs} FROM mid m JOIN co c ON c.key = m.key")
    fitted = ", ".join(Q.FITTED)
    ctes.append(f"e0 AS MATERIALIZED (SELECT * REPLACE (1e300 AS ld) FROM (SELECT *, {_factors()} FROM ({' UNION ALL '.join(first)})))")
    for k in range(1, Q.STEPS + 1):
        ctes.append(f"n{k} AS MATERIALIZED (SELECT x.*, e.start, floor({Q.BINS} * ln(greatest(1e-6, least(1e6, {_distance()})))) AS b "
                    f"FROM lev x JOIN e{k - 1} e ON e.key = x.key)")
        ctes.append(f"c{k} AS (" + quantiles(f"(SELECT key, start, b, count(*) AS n FROM n{k} GROUP BY 1, 2, 3)", "key, start", {"cut": Q.SHARE}) + ")")
        means = ", ".join(f"avg(x_{i}) AS m_{i}" for i in range(Q.D))
        seconds = ", ".join(f"avg(x_{i} * x_{j}) AS p_{i}_{j}" for i, j in covs)
        ctes.append(f"a{k} AS (SELECT x.key, x.start, max(c.n) AS n, {means}, {seconds} FROM n{k} x JOIN c{k} c "
                    f"ON c.key = x.key AND c.start = x.start AND x.b <= c.cut GROUP BY 1, 2)")
        scaled = ", ".join(f"{Q.CONSISTENCY!r} * (p_{i}_{j} - m_{i} * m_{j}) AS c_{i}_{j}" for i, j in covs)
        ctes.append(f"f{k} AS MATERIALIZED (SELECT *, {_factors()} FROM (SELECT *, {scaled} FROM a{k}))")
        ctes.append(f"e{k} AS MATERIALIZED (SELECT o.key, o.start, " + ", ".join(
            f"CASE WHEN f.ld < o.ld - {Q.FALL!r} THEN f.{c} ELSE o.{c} END AS {c}" for c in Q.FITTED)
            + f" FROM e{k - 1} o JOIN f{k} f ON f.key = o.key AND f.start = o.start)")
    ctes.append(f"best AS (SELECT key, start, {fitted} FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ld, start) AS r "
                f"FROM e{Q.STEPS}) WHERE r = 1)")
    ctes.append(f"fit AS (SELECT * FROM best WHERE n >= {Q.MIN_ROWS} OR key = '2')")
    picked = " UNION ALL ".join(f"SELECT doc_id, {level} AS level, {k} AS key, {xs} FROM vec" for level, k in enumerate(keys))
    ctes.append(f"judged AS (SELECT x.doc_id, arg_min({_distance()}, x.level) AS d FROM ({picked}) x JOIN fit e ON e.key = x.key GROUP BY 1)")
    return "WITH " + ",\n".join(ctes) + (
        f"\nSELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, j.doc_id IS NULL AS base_failed, "
        f"coalesce(j.d <= {Q.LIMIT!r}, false) AS kept FROM stats s LEFT JOIN judged j ON j.doc_id = s.doc_id")

"""DuckDB spellings of the engine's building blocks, used by the oracle queries.

Each helper returns CTE text; the oracle of a query composes them.  They
restate the same definitions as the Spark code (spaced token strings, rule
replay with ``replace``, ids by token order, md5 draws) in plain SQL.
"""

from __future__ import annotations

from wordloom.functions.rand import uniform_sql

WORDS = "list_transform(regexp_extract_all({text}, '[A-Za-z]+'), lambda x: lower(x))"
SPACED_WORD = "(' ' || regexp_replace({w}, '(.)', '\\1  ', 'g') || '</w> ')"
SPACED_TEXT = "array_to_string(list_transform(" + WORDS + ", lambda w: " + SPACED_WORD.format(w="w") + "), '')"
TOKENS = "CASE WHEN trim({s}) = '' THEN []::VARCHAR[] ELSE string_split(trim({s}), '  ') END"


def word_freq(name: str, source: str, text: str = "text") -> str:
    return (
        f"{name} AS (SELECT w AS word, count(*)::BIGINT AS n FROM "
        f"(SELECT unnest({WORDS.format(text=text)}) AS w FROM {source}) GROUP BY 1)"
    )


def bpe(prefix: str, source: str, m: int, text: str = "text") -> str:
    """CTEs ``{p}_wf``, ``{p}_st`` (recursive), ``{p}_merges``, ``{p}_final``, ``{p}_vocab``.

    One merge per recursion step: pair counts of the current state, best
    pair by (n desc, a, b), applied while the vocabulary is below m and the
    best count is at least 2.
    """
    p = prefix
    return f"""{word_freq(p + '_wf', source, text)},
{p}_st(step, word, n, t, ra, rb, rn) AS (
  SELECT 0, word, n, {SPACED_WORD.format(w='word')}, NULL::VARCHAR, NULL::VARCHAR, NULL::BIGINT FROM {p}_wf
  UNION ALL
  SELECT s.step + 1, s.word, s.n,
         replace(s.t, ' ' || bp.a || '  ' || bp.b || ' ', ' ' || bp.a || bp.b || ' '), bp.a, bp.b, bp.n
  FROM {p}_st s,
   (SELECT a, b, n FROM (
      SELECT q.a, q.b, sum(q.n)::BIGINT AS n FROM (
        SELECT x.n, x.k[i] AS a, x.k[i + 1] AS b
        FROM (SELECT n, string_split(trim(t), '  ') AS k FROM {p}_st) x, range(1, len(x.k)) r(i)) q
      GROUP BY 1, 2) z
    ORDER BY n DESC, a, b LIMIT 1) bp,
   (SELECT count(DISTINCT tok) + 2 AS vs FROM (SELECT unnest(string_split(trim(t), '  ')) AS tok FROM {p}_st)) v
  WHERE bp.n >= 2 AND v.vs < {m}
),
{p}_merges AS MATERIALIZED (SELECT DISTINCT step::INTEGER AS rank, ra AS a, rb AS b, ra || rb AS merged, rn AS n FROM {p}_st WHERE step > 0),
{p}_final AS MATERIALIZED (SELECT word, n, t FROM {p}_st WHERE step = (SELECT max(step) FROM {p}_st)),
{p}_vocab AS MATERIALIZED (
  SELECT 0::BIGINT AS token_id, '<PAD>' AS token UNION ALL SELECT 1::BIGINT, '<END>' UNION ALL
  SELECT (row_number() OVER (ORDER BY token) + 1)::BIGINT, token
  FROM (SELECT DISTINCT unnest(string_split(trim(t), '  ')) AS token FROM {p}_final) WHERE token NOT IN ('<PAD>', '<END>')
)"""


def rule_list(name: str, merges: str, for_text: bool) -> str:
    """The rules as a list of (pattern, replacement) in rank order."""
    flt = "WHERE NOT suffix(a, '</w>')" if for_text else ""
    return (
        f"{name} AS (SELECT coalesce(list({{'p': ' ' || a || '  ' || b || ' ', 'r': ' ' || a || b || ' '}} "
        f"ORDER BY rank), []) AS rl FROM {merges} {flt})"
    )


def encode_docs(name: str, source: str, rules: str, key: str = "doc_id", text: str = "text") -> str:
    """``(doc_id, tokens)`` -- a whole document as one spaced string, rules replayed in order."""
    spaced = SPACED_TEXT.format(text=text)
    s = "list_reduce(rl, lambda acc, x: replace(acc, x.p, x.r), sp)"
    return (
        f"{name} AS MATERIALIZED (SELECT doc_id, {TOKENS.format(s='s')} AS tokens FROM "
        f"(SELECT d.doc_id, {s} AS s FROM (SELECT {key} AS doc_id, {spaced} AS sp FROM {source}) d, {rules}))"
    )


def encode_words(name: str, words: str, rules: str) -> str:
    s = "list_reduce(rl, lambda acc, x: replace(acc, x.p, x.r), " + SPACED_WORD.format(w="word") + ")"
    return f"{name} AS (SELECT word, {TOKENS.format(s='s')} AS tokens FROM (SELECT word, {s} AS s FROM {words}, {rules}))"


def token_rows(name: str, enc: str) -> str:
    """``(doc_id, pos, token)`` from document token lists (pos 0-based)."""
    return f"{name} AS (SELECT doc_id, (i - 1)::BIGINT AS pos, tokens[i] AS token FROM {enc}, range(1, len(tokens) + 1) r(i))"


def id_rows(name: str, rows: str, vocab: str) -> str:
    """``(doc_id, pos, token, token_id)``: unknown tokens dropped, positions closed up."""
    return (
        f"{name} AS MATERIALIZED (SELECT r.doc_id, (row_number() OVER (PARTITION BY r.doc_id ORDER BY r.pos) - 1)::BIGINT AS pos, "
        f"r.token, v.token_id FROM {rows} r JOIN (SELECT token, min(token_id) AS token_id FROM {vocab} GROUP BY 1) v "
        f"ON r.token = v.token)"
    )


def occurrences(name: str, ids: str, window: int) -> str:
    """Skip-gram occurrences ``(doc_id, i, d, center, context)`` within documents (equi-join on pos + d)."""
    return (
        f"{name}_probe AS MATERIALIZED (SELECT a.doc_id, a.pos AS i, dd.d::INTEGER AS d, a.token_id AS center, "
        f"a.pos + dd.d AS q FROM {ids} a CROSS JOIN (SELECT unnest(range(-{window}, {window + 1})) AS d) dd WHERE dd.d <> 0), "
        f"{name} AS MATERIALIZED (SELECT p.doc_id, p.i, p.d, p.center, b.token_id AS context "
        f"FROM {name}_probe p JOIN {ids} b ON b.doc_id = p.doc_id AND b.pos = p.q)"
    )


def token_counts(name: str, ids: str, vocab: str) -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT v.token_id, coalesce(c.n, 0)::BIGINT AS n FROM {vocab} v LEFT JOIN "
        f"(SELECT token_id, count(*) AS n FROM {ids} GROUP BY 1) c ON v.token_id = c.token_id)"
    )


def cdf(name: str, counts: str) -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT token_id, n, w, coalesce(lag(hi) OVER (ORDER BY token_id), 0.0) AS lo, hi FROM "
        f"(SELECT *, sum(w) OVER (ORDER BY token_id ROWS UNBOUNDED PRECEDING) AS hi FROM "
        f"(SELECT token_id, n, CASE WHEN n > 0 THEN pow(n::DOUBLE, 0.75) ELSE 0.0 END AS w FROM {counts})))"
    )


def alias_table(name: str, cdf_name: str) -> str:
    """``(k, token_id, p, other)``: the alias table of the positive weights, by prefix sums of light and heavy slots."""
    return (
        f"{name}_w AS (SELECT row_number() OVER (ORDER BY token_id) - 1 AS k, token_id, w, sum(w) OVER () / count(*) OVER () AS mean "
        f"FROM {cdf_name} WHERE w > 0), "
        f"{name}_l AS (SELECT *, sum(mean - w) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS given FROM {name}_w WHERE w <= mean), "
        f"{name}_lb AS (SELECT *, coalesce(lag(given) OVER (ORDER BY k), 0.0) AS before FROM {name}_l), "
        f"{name}_h AS (SELECT *, sum(w - mean) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS owned, "
        f"lead(token_id) OVER (ORDER BY k) AS next_id FROM {name}_w WHERE w > mean), "
        f"{name}_lf AS (SELECT l.k, l.token_id, l.w / l.mean AS p, coalesce(h.token_id, (SELECT arg_max(token_id, k) FROM {name}_h)) AS other "
        f"FROM {name}_lb l ASOF LEFT JOIN {name}_h h ON l.before <= h.owned), "
        f"{name}_hf AS (SELECT h.k, h.token_id, CASE WHEN l.given IS NULL OR h.next_id IS NULL THEN 1.0 "
        f"ELSE 1 - (l.given - h.owned) / h.mean END AS p, coalesce(h.next_id, h.token_id) AS other "
        f"FROM {name}_h h ASOF LEFT JOIN {name}_l l ON h.owned < l.given), "
        f"{name} AS MATERIALIZED (SELECT k, token_id, p, coalesce(other, token_id) AS other FROM {name}_lf "
        f"UNION ALL SELECT k, token_id, p, other FROM {name}_hf)"
    )


def draws(name: str, occ: str, cdf_name: str, neg: int, seed: int, epoch: int = 0, attempts: int = 8) -> str:
    """Negative draws ``(doc_id, i, d, center, context, k, target)``: alias draws, then the context cut out."""
    def u(attempt, of):
        return uniform_sql(str(seed), str(epoch), *(f"{of}.{c}" for c in ("doc_id", "i", "d", "k")), str(attempt))

    cols = "doc_id, i, d, center, context, k"
    ctes = [alias_table(f"{name}_alias", cdf_name), f"{name}_n AS (SELECT count(*) AS n FROM {name}_alias)",
            f"{name}_0 AS (SELECT o.*, k.k, NULL::BIGINT AS target FROM {occ} o CROSS JOIN range(1, {neg + 1}) k(k))"]
    for j in range(1, attempts + 1):
        again = "" if j == 1 else " WHERE target = context"
        ctes.append(
            f"{name}_{j} AS MATERIALIZED (SELECT {', '.join('x.' + c for c in cols.split(', '))}, "
            f"CASE WHEN x.x - s.k < s.p THEN s.token_id ELSE s.other END AS target FROM "
            f"(SELECT {cols}, {u(j, 'q')} * n AS x FROM (SELECT * FROM {name}_{j - 1}{again}) q CROSS JOIN {name}_n) x "
            f"JOIN {name}_alias s ON s.k = floor(x.x)::BIGINT)")
    last = (
        f"SELECT {', '.join('r.' + c for c in cols.split(', '))}, c.token_id AS target FROM ("
        f"SELECT *, CASE WHEN r0 >= clo THEN r0 + cw ELSE r0 END AS rr FROM (SELECT {cols}, x.w AS cw, x.lo AS clo, "
        f"{u(0, 'q')} * (z.z - x.w) AS r0 FROM {name}_{attempts} q JOIN {cdf_name} x ON x.token_id = q.context "
        f"CROSS JOIN (SELECT max(hi) AS z FROM {cdf_name}) z WHERE q.target = q.context)) r "
        f"JOIN {cdf_name} c ON c.w > 0 AND r.rr >= c.lo AND r.rr < c.hi")
    found = " UNION ALL ".join(f"SELECT {cols}, target FROM {name}_{j} WHERE target <> context" for j in range(1, attempts + 1))
    return ", ".join(ctes) + f", {name} AS MATERIALIZED ({found} UNION ALL {last})"


def init_vectors(name: str, vocab: str, dim: int, seed: int) -> str:
    """``(tbl, token_id, i, v)`` -- both start tables as cells (float values)."""
    u = uniform_sql(str(seed), "t.tbl", "v.token_id", "i.i")
    return (
        f"{name} AS (SELECT t.tbl, v.token_id, i.i, CAST(({u} - 0.5) / {float(dim)} AS FLOAT) AS v "
        f"FROM {vocab} v, (SELECT 0 AS tbl UNION ALL SELECT 1) t, range(0, {dim}) i(i))"
    )


def rule_table(name: str, wf: str, rules: int, longest: int = 8) -> str:
    """``(rank, a, b)``: the ``rules`` most frequent word beginnings, each made of a shorter one and a letter."""
    return (
        f"{name}_p AS (SELECT substr(word, 1, k) AS p, sum(n) AS w FROM {wf}, range(2, {longest + 1}) r(k) "
        f"WHERE k <= length(word) GROUP BY 1),\n"
        f"{name} AS MATERIALIZED (SELECT row_number() OVER (ORDER BY w DESC, p) AS rank, p, substr(p, 1, length(p) - 1) AS a, "
        f"substr(p, length(p), 1) AS b FROM {name}_p ORDER BY w DESC, p LIMIT {rules})"
    )


def encode_by_word(name: str, source: str, rules: str, key: str = "doc_id", text: str = "text") -> str:
    """``(doc_id, wpos, tokens)``: every word of a text, its distinct form encoded by itself."""
    return (
        f"{name}_w AS MATERIALIZED (SELECT doc_id, i AS wpos, w[i] AS word FROM "
        f"(SELECT {key} AS doc_id, {WORDS.format(text=text)} AS w FROM {source}), range(1, len(w) + 1) r(i)),\n"
        f"{name}_d AS (SELECT DISTINCT word FROM {name}_w),\n" + encode_words(name + "_e", name + "_d", rules).replace(
            f"{name}_e AS (", f"{name}_e AS MATERIALIZED (") + ",\n"
        f"{name} AS MATERIALIZED (SELECT w.doc_id, w.wpos, e.tokens FROM {name}_w w JOIN {name}_e e ON e.word = w.word)"
    )


def word_token_rows(name: str, enc: str) -> str:
    """``(doc_id, pos, token)`` from encoded words, positions over the whole document."""
    return (
        f"{name} AS MATERIALIZED (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY wpos, k) - 1)::BIGINT AS pos, "
        f"tokens[k] AS token FROM {enc}, range(1, len(tokens) + 1) r(k))"
    )


def vocabulary(name: str, tokens: str) -> str:
    """Ids of distinct tokens: the two specials first, the rest by token."""
    return (
        f"{name} AS MATERIALIZED (SELECT 0::BIGINT AS token_id, '<PAD>' AS token UNION ALL SELECT 1::BIGINT, '<END>' UNION ALL "
        f"SELECT (row_number() OVER (ORDER BY token) + 1)::BIGINT, token FROM (SELECT DISTINCT token FROM {tokens}) "
        f"WHERE token NOT IN ('<PAD>', '<END>'))"
    )

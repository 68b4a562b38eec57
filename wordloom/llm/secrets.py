"""Secret scans through a trigram inverted index, with built-in functions only.

From every rule's regular expression a Boolean trigram query is derived: a
conjunction of clauses, each a choice of trigram sets of which one must be in
the text. The index holds, for every trigram that some rule asks for, the
postings (trigram, document). Intersecting them gives each rule's candidate
documents, and only there its expression is run; a rule without a mandatory
trigram runs on every text.

The index is over the lower-cased text, so a query finds a superset for
case-sensitive rules. The candidates meet the texts in one join, which Spark
turns into a broadcast when the candidates are few.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from itertools import product
from re import _constants as op
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import let, materialize, read_table


@dataclass(frozen=True)
class Rule:
    """``least``: a match is a secret if its ``group`` has at least so many code points.

    ``sieve`` is an expression that occurs in every text with such a match.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    sieve: str = ""


# The base rules (kind, expression, checked group, least length).
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
         r"[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{6}"),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, r"AKIA[A-Z0-9]{16}"),
    Rule("hex", r"[0-9a-f]+", 0, 24, r"[0-9a-f]{24}"),
)
# Further credential formats that their issuers document.
FURTHER = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("url", r"[a-z]{3,10}://[A-Za-z0-9._%+-]{1,64}:[^\x00-\x20/:@]{4,64}@"),
)
RULES = BASE + FURTHER
#: The most strings that a part of an expression is expanded to.
MOST = 64
#: Matches that one step of the position fold takes.
CHUNK = 256


def _strings(item) -> list[str] | None:
    """All strings that a parsed element matches, in lower case, or None if they are too many."""
    kind, arg = item
    if kind is op.LITERAL:
        return [chr(arg).lower()]
    if kind is op.IN:
        found = set()
        for k, a in arg:
            if k is op.LITERAL:
                found.add(chr(a).lower())
            elif k is op.RANGE and a[1] - a[0] < 16:
                found |= {chr(c).lower() for c in range(a[0], a[1] + 1)}
            else:
                return None
        return sorted(found) if len(found) <= 16 else None
    if kind is op.SUBPATTERN:
        return _sequence(arg[-1])
    if kind is op.BRANCH:
        parts = [_sequence(p) for p in arg[1]]
        return None if None in parts else sorted({s for p in parts for s in p})
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[1] <= 3:
        body = _sequence(arg[2])
        if body is None:
            return None
        out = {"".join(x) for n in range(arg[0], arg[1] + 1) for x in product(body, repeat=n)}
        return sorted(out) if len(out) <= MOST else None
    return None


def _sequence(items) -> list[str] | None:
    held = [""]
    for item in items:
        more = _strings(item)
        if more is None or len(held) * len(more) > MOST:
            return None
        held = [a + b for a in held for b in more]
    return held


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Clauses that all hold in any text with a match; a clause holds if all trigrams of one of its sets occur.

    No clause: the expression has no mandatory trigram.
    """
    clauses: list[list[frozenset[str]]] = []

    def close(strings):
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        if frozenset() not in sets:
            clauses.append(sorted((x for x in sets if not any(y < x for y in sets)), key=sorted))

    def walk(items):
        held = [""]
        for item in items:
            more = _strings(item)
            if more is not None and len(held) * len(more) <= MOST:
                held = [a + b for a in held for b in more]
                continue
            close(held)
            held = [""] if more is None else more
            kind, arg = item
            if more is None and kind is op.SUBPATTERN:
                walk(arg[-1])
            elif more is None and kind in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[0] > 0:
                walk(arg[2])
        close(held)

    walk(_parser.parse(pattern))
    return clauses


def queries(rules=RULES) -> list[tuple[str, int, int, str, int]]:
    """(kind, clause, choice, trigram, trigrams of the choice) of all rules with a query."""
    return [(r.kind, c, a, t, len(choice)) for r in rules for c, clause in enumerate(trigram_query(r.pattern))
            for a, choice in enumerate(clause) for t in sorted(choice)]


def _spans(text: Column, rule: Rule) -> Column:
    """Leftmost non-overlapping matches that are secrets: array of (start, end), code points.

    The text between matches and the matches add up to positions; they are
    summed in chunks, so that a text full of secrets costs little more per match.
    """
    empty = F.array().cast("array<struct<start:int,end:int>>")
    pattern = F.lit(rule.pattern)

    def widths(parts):
        found = F.regexp_extract_all(text, pattern, F.lit(0))
        if rule.group:
            checked = F.regexp_extract_all(text, pattern, F.lit(rule.group))
            found = F.arrays_zip(found.alias("m"), checked.alias("g"))
            sizes = F.transform(found, lambda x: F.struct(F.length(x["m"]).alias("n"), F.length(x["g"]).alias("g")))
        else:
            sizes = F.transform(found, lambda x: F.struct(F.length(x).alias("n"), F.length(x).alias("g")))
        return F.zip_with(F.slice(parts, 1, F.size(parts) - 1), sizes, lambda p, s: F.struct(
            F.length(p).alias("skip"), s["n"].alias("n"), s["g"].alias("g")))

    def chunk(items):
        zero = F.struct(F.lit(0).alias("at"), empty.alias("out"))
        return F.aggregate(items, zero, lambda s, x: F.struct(
            (s["at"] + x["skip"] + x["n"]).alias("at"),
            F.when(x["g"] >= rule.least, F.concat(s["out"], F.array(F.struct(
                (s["at"] + x["skip"]).alias("start"), (s["at"] + x["skip"] + x["n"]).alias("end")))))
            .otherwise(s["out"]).alias("out")))

    def whole(items):
        steps = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int")),
                            lambda c: chunk(F.slice(items, c * CHUNK + 1, CHUNK)))
        zero = F.struct(F.lit(0).alias("at"), empty.alias("out"))
        return F.aggregate(steps, zero, lambda s, x: F.struct(
            (s["at"] + x["at"]).alias("at"),
            F.concat(s["out"], F.transform(x["out"], lambda y: F.struct(
                (y["start"] + s["at"]).alias("start"), (y["end"] + s["at"]).alias("end")))).alias("out")),
            lambda s: s["out"])

    spans = let(F.split(text, rule.pattern, -1), lambda parts: let(widths(parts), whole))
    return F.when(text.rlike(rule.sieve or rule.pattern), spans).otherwise(empty)


def postings(rows: DataFrame, terms: list[str]) -> DataFrame:
    """(trigram, id, mark) for the trigrams ``terms`` that occur in the lower-cased text of ``rows(id, mark, text)``."""
    held = let(F.lower(F.coalesce("text", F.lit(""))), lambda low: F.filter(
        F.array(*[F.lit(t) for t in terms]), lambda t: low.contains(t)))
    return rows.select("id", "mark", F.explode(held).alias("trigram")).distinct()


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(id, mark, kinds): the documents whose postings satisfy a rule's query, with those rules."""
    wanted = queries(rules)
    spark = index.sparkSession
    # one row per trigram of the fixed rules, a constant of the plan
    names = ("kind", "clause", "choice", "trigram", "need")
    rows = F.from_json(F.lit(json.dumps([dict(zip(names, w, strict=True)) for w in wanted])),
                       "array<struct<kind:string,clause:int,choice:int,trigram:string,need:int>>")
    asked = F.broadcast(spark.range(1).select(F.inline(rows)))
    clauses = {r.kind: len(trigram_query(r.pattern)) for r in rules}
    held = index.repartition("id", "mark").join(asked, "trigram")
    met = held.groupBy("id", "mark", "kind", "clause", "choice", "need").agg(F.count(F.lit(1)).alias("n")).filter(
        "n = need")
    count = F.create_map(*[F.lit(x) for pair in clauses.items() for x in pair])
    full = met.groupBy("id", "mark", "kind").agg(F.count_distinct("clause").alias("n")).filter(
        F.col("n") == count[F.col("kind")])
    return full.groupBy("id", "mark").agg(F.collect_set("kind").alias("kinds"))


def scan(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``secrets``: array of (start, rank, kind, end), by start and order of the rules.

    Positions are code points, ``end`` exclusive; ``rank`` is the rule's place.
    Null and empty texts have no secrets; null ids, repeated rows and other
    columns (named ``secrets`` too: replaced) are kept; an empty table gives an
    empty result. A row's candidates are found by its id and a mark of its text,
    so repeated ids do no harm.
    """
    names = [c for c in docs.columns if c != "secrets"]
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("row"), docs[f"`{id_col}`"].alias("id"),
                       F.coalesce(docs[f"`{text_col}`"], F.lit("")).alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    terms = sorted({t for *_, t, _ in queries(rules)})
    index = materialize(postings(rows.drop("row"), terms), "trigram-postings")
    found = candidates(index, rules).withColumnsRenamed({"id": "c_id", "mark": "c_mark"})
    joined = rows.join(found, rows["id"].eqNullSafe(found["c_id"]) & (rows["mark"] == found["c_mark"]), "left")
    def named(rank, rule):
        return F.transform(_spans(F.col("text"), rule), lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"),
            s["end"].alias("end")))

    spans = []
    for rank, rule in enumerate(rules):
        here = named(rank, rule)
        if trigram_query(rule.pattern):
            here = F.when(F.array_contains("kinds", rule.kind), here).otherwise(
                F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>"))
        spans.append(here)
    return joined.select("row.*", F.array_sort(F.concat(*spans)).alias("secrets"))


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every maximal run of overlapping secrets replaced by ``mark``."""
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    end = F.aggregate(spans, zero, lambda s, x: F.struct(
        F.when(x["start"] >= s["at"], F.concat(s["out"], F.substr(text, s["at"] + 1, x["start"] - s["at"]),
                                               F.lit(mark))).otherwise(s["out"]).alias("out"),
        F.greatest(s["at"], x["end"]).alias("at")),
        lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(end)


def op2_secrets(spark, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("secrets", lambda s: s["rank"] < len(BASE))
    return found.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(line(base), 256).alias("base_sha256"),
                        line(F.col("secrets")).alias("spans"))

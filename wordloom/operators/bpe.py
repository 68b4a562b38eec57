"""B1: byte-pair-encoding merge training, many merges a pass.

The distinct words, weighted by their frequency, are stored once. A pass is
given a list of merges that training will probably make next. Every task
replays the rules so far on those of its words that hold one of the merged
strings, makes the listed merges one after the other, and sums the pairs and
tokens that its words lose and gain, separately for every merge. With these sums
the driver goes through the list and keeps a merge as long as it is the one that
one-at-a-time training makes, by the exact counts at that place; the rest of the
list is dropped. A pass reads no state of the pass before it.

The list is a forecast: the driver trains on the ``FORECAST_WORDS`` most frequent
words, from the exact counts. A wrong forecast costs a longer way, never a rule.

The counts of the most frequent pairs (``HELD_PAIRS``) and of the tokens in use
(at most the target size) are kept by the driver. No other pair can have a count
above a known bound; when the best count is not above it, all words are counted
again.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions import text as T
from wordloom.operators import words as W
from wordloom.operators.encode import Encoder, encode_words
from wordloom.session import ensure_checkpoint_dir, stored

MERGES_SCHEMA = "rank int, a string, b string, merged string, n bigint"
#: Pairs whose counts the driver keeps, and those of them that a forecast begins with.
HELD_PAIRS, TOP_PAIRS = 200_000, 2000
#: Words that a forecast is made from, and the merges that it lists at first, at least and at most.
FORECAST_WORDS, FIRST_MERGES, LEAST_MERGES, MOST_MERGES = 1 << 15, 32, 16, 256
#: The end of a word where merged strings are looked for.
STOP = "$"


@dataclass
class BpeModel:
    merges: DataFrame  # (rank, a, b, merged, n)
    vocab: DataFrame  # (token_id, token)
    state: DataFrame  # (word, n, t): trained words and their final tokens
    rules: list = field(default_factory=list)  # [(a, b, n)] in rank order
    passes: int = 0
    sizes: list = field(default_factory=list)  # vocabulary size before each pass
    recounts: int = 0  # how often all words were counted


class Counts:
    """Counts of pairs and of tokens in use, as far as the driver holds them."""

    def __init__(self, rows, held: int):
        self.held = held
        self.tokens: Counter = Counter({a: n for a, b, n in rows if b is None})
        self.pairs = {(a, b): n for a, b, n in rows if b is not None}
        self.bound = 0  # no pair that is not held has a higher count
        self.fresh = True
        self.heap: list = []  # (-count, pair) of every count that a pair has had
        self._prune(held)

    def _prune(self, most: int) -> None:
        if len(self.pairs) > most:
            kept = heapq.nlargest(self.held, self.pairs.items(), key=lambda x: x[1])
            self.bound = max(self.bound, kept[-1][1])
            self.pairs = dict(kept)
            self.heap = []
        if len(self.heap) > 4 * len(self.pairs) or not self.heap:
            self.heap = [(-n, pair) for pair, n in self.pairs.items()]
            heapq.heapify(self.heap)

    def add(self, rows) -> None:
        """Changes ``(a, b, n)`` by one merge; ``b`` is null for a token."""
        self.fresh = False
        new = {a for a, b, n in rows if b is None and self.tokens[a] == 0}
        for a, b, n in rows:
            if b is None:
                self.tokens[a] += n
                if self.tokens[a] <= 0:
                    del self.tokens[a]
            elif (a, b) in self.pairs or not self.bound or a in new or b in new:
                now = self.pairs.get((a, b), 0) + n  # a pair with a new token has no other occurrences
                if now > 0:
                    self.pairs[a, b] = now
                    heapq.heappush(self.heap, (-now, (a, b)))
                else:
                    self.pairs.pop((a, b), None)
            elif n > 0:
                self.bound += n  # some pair that is not held has gained
        self._prune(2 * self.held)

    def best(self) -> tuple[str, str, int] | None:
        """The most frequent pair; ties go to the first in order (of code points, as in UTF-8)."""
        while self.heap and self.pairs.get(self.heap[0][1]) != -self.heap[0][0]:
            heapq.heappop(self.heap)
        return (*self.heap[0][1], -self.heap[0][0]) if self.heap else None

    def top(self, count: int) -> dict[tuple[str, str], int]:
        """The most frequent pairs."""
        return dict(heapq.nsmallest(count, self.pairs.items(), key=lambda x: (-x[1], x[0])))


class Forecast:
    """The merges that training will probably make next, from a bounded number of frequent words ``(word, n)``."""

    def __init__(self, words):
        self.weights = [n for _, n in words]
        self.tokens = [[*word, T.WORD_END] for word, _ in words]
        self.where: dict[tuple[str, str], set[int]] = {}  # words that hold a pair, or have held it
        for i, tokens in enumerate(self.tokens):
            for pair in zip(tokens, tokens[1:]):
                self.where.setdefault(pair, set()).add(i)
        self.steps: list[list] = []  # what the words of every listed merge were before it

    def _merge(self, a: str, b: str) -> tuple[Counter, int]:
        """Makes a merge; what pairs lose and gain, and how often the pair was there."""
        changes: Counter = Counter()
        seen, before, merged = 0, [], a + b
        for i in self.where.get((a, b), ()):
            old, new, at = self.tokens[i], [], 0
            while at < len(old):
                if old[at] == a and at + 1 < len(old) and old[at + 1] == b:
                    new.append(merged)
                    at += 2
                else:
                    new.append(old[at])
                    at += 1
            if len(new) == len(old):
                continue
            n = self.weights[i]
            seen += n * (len(old) - len(new))
            before.append((i, old))
            self.tokens[i] = new
            for pair in zip(old, old[1:]):
                changes[pair] -= n
            for pair in zip(new, new[1:]):
                changes[pair] += n
        for i, _ in before:
            for pair in zip(self.tokens[i], self.tokens[i][1:]):
                if merged in pair:
                    self.where.setdefault(pair, set()).add(i)
        self.steps.append(before)
        return changes, seen

    def listed(self, counts: Counts, length: int) -> list[tuple[str, str]]:
        """Up to ``length`` merges, the first of them certain; ``kept`` must follow."""
        likely: dict = counts.top(TOP_PAIRS)
        out = []
        while len(out) < length and likely:
            (a, b), n = min(likely.items(), key=lambda x: (-x[1], x[0]))
            if n < 2:
                break
            out.append((a, b))
            changes, seen = self._merge(a, b)
            share = n / seen if seen else 0  # these words stand for all that hold the pair
            for pair, change in changes.items():
                if pair in likely or a + b in pair:
                    likely[pair] = likely.get(pair, 0) + change * share
            likely.pop((a, b), None)
        return out

    def kept(self, count: int) -> None:
        """Takes the listed merges back, but for the first ``count``."""
        while len(self.steps) > count:
            for i, old in self.steps.pop():
                self.tokens[i] = old
        self.steps = []


def _counted(words: DataFrame, rules, held: int) -> Counts:
    """Pairs and tokens of all words under ``rules``: the ``held`` most frequent pairs, and all tokens."""
    tokens = encode_words(words, rules, keep=["n"]) if rules else words.select(
        "n", T.token_array(T.spaced_word("word")).alias("tokens"))
    alone = F.transform("tokens", lambda x: F.struct(x.alias("a"), F.lit(None).cast("string").alias("b")))
    rows = tokens.select("n", F.explode(F.concat(T.adjacent_pairs("tokens"), alone)).alias("r")).groupBy(
        "r.a", "r.b").agg(F.sum("n").alias("n"))
    rows = stored(rows, "pair-counts")
    top = rows.where("b IS NOT NULL").orderBy(F.desc("n")).limit(held + 1)
    return Counts([tuple(r) for r in top.unionByName(rows.where("b IS NULL")).collect()], held)


def _changes(rules, merges):
    """What words lose and gain by each of the merges, made in order: (step, a, b, n), with a null ``b`` for tokens."""
    pairs = [(a, b) for a, b, _ in rules]
    swaps = [(step, (a + b).replace(T.WORD_END, STOP), f" {a}{T.SEP}{b} ", f" {a}{b} ") for step, (a, b) in enumerate(merges)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pairs)
        tally: defaultdict = defaultdict(int)
        for rows in batches:
            for word, n in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                marked = word + STOP
                here = [s for s in swaps if s[1] in marked]  # a changed word holds the merged string
                if not here:
                    continue
                spaced = f" {T.SEP.join(encoder.replay(word))} "
                for step, _, pair, merged in here:
                    first = spaced.find(pair)
                    if first < 0:
                        continue
                    # from the token before the first place to the one behind the last: the rest stays as it is
                    start = spaced.rfind(" ", 0, first - 1) if first else 0
                    end = spaced.rfind(pair) + len(pair)
                    end = spaced.find(" ", end + 1) + 1 if end < len(spaced) else end
                    part = spaced[start:end]
                    new_part = part.replace(pair, merged)
                    old, new = part[1:-1].split(T.SEP), new_part[1:-1].split(T.SEP)
                    made = n * (len(old) - len(new))
                    a, b = merges[step]
                    tally[step, a, None] -= made
                    tally[step, b, None] -= made
                    tally[step, a + b, None] += made
                    for x, y in zip(old, old[1:]):
                        tally[step, x, y] -= n
                    for x, y in zip(new, new[1:]):
                        tally[step, x, y] += n
                    spaced = spaced[:start] + new_part + spaced[end:]
        left = [(*k, n) for k, n in tally.items() if n]
        if left:
            step, a, b, n = zip(*left, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(step, pa.int32()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(n, pa.int64())],
                ["step", "a", "b", "n"])

    return run


def train_bpe(docs: DataFrame, target_size: int, text: str = "text", max_merges: int | None = None, batched: bool = True,
              held_pairs: int = HELD_PAIRS) -> BpeModel:
    """Learn merge rules until the vocabulary reaches ``target_size``.

    Stops also when no pair is left or the best count is below 2.  The
    vocabulary is recollected after every merge, so it can shrink.
    """
    if target_size <= 0:
        raise ValueError("target vocabulary size must be a positive integer")
    spark: SparkSession = docs.sparkSession
    ensure_checkpoint_dir(spark)
    # a number of its own: the distinct words are few bytes, which would else be read by one task
    parts = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    words = stored(W.word_frequency(docs, text).repartition(parts, "word"), "distinct-words")
    counts = _counted(words, [], held_pairs)
    forecast = None
    rules: list[tuple[str, str, int]] = []
    sizes: list[int] = []
    passes = recounts = 0
    length = FIRST_MERGES if batched else 1

    def unknown():
        """Whether a pair that is not held may be the best."""
        best = counts.best()
        return counts.bound >= max(2, best[2] if best else 0)

    def over():
        best = counts.best()
        return (len(counts.tokens) + 2 >= target_size or best is None or best[2] < 2  # with <PAD>, <END>
                or (max_merges is not None and len(rules) >= max_merges))

    while True:
        while len(counts.tokens) + 2 < target_size and unknown():
            if counts.fresh:
                held_pairs *= 2  # more pairs share the best count than were held
            counts = _counted(words, [(a, b) for a, b, _ in rules], held_pairs)
            recounts += 1
        sizes.append(len(counts.tokens) + 2)
        if over():
            break
        passes += 1
        if forecast is None:
            top = words.orderBy(F.desc("n"), "word").limit(FORECAST_WORDS).select("word", "n").collect()
            forecast = Forecast([(r.word, r.n) for r in top])
        merges = forecast.listed(counts, length)
        moved = words.mapInArrow(_changes(rules, merges), "step int, a string, b string, n bigint").groupBy(
            "step", "a", "b").agg(F.sum("n").alias("n")).collect()  # at most the pairs that hold a token of a listed merge
        steps: list[list] = [[] for _ in merges]
        for r in moved:
            steps[r.step].append((r.a, r.b, r.n))
        done = 0
        for pair, rows in zip(merges, steps, strict=True):
            if done and (over() or unknown() or counts.best()[:2] != pair):
                break
            rules.append(counts.best())
            counts.add(rows)
            done += 1
        forecast.kept(done)
        if batched:
            length = min(MOST_MERGES, max(LEAST_MERGES, 2 * done))
    merges = spark.createDataFrame([(i + 1, a, b, a + b, n) for i, (a, b, n) in enumerate(rules)], MERGES_SCHEMA)
    # the vocabulary (at most m rows) is written once; every later lookup reads it
    tokens = sorted(t for t in counts.tokens if t not in (T.PAD, T.END))
    vocab = stored(spark.createDataFrame([(0, T.PAD), (1, T.END), *[(i + 2, t) for i, t in enumerate(tokens)]],
                                         "token_id bigint, token string"), "vocabulary")
    state = encode_words(words, [(a, b) for a, b, _ in rules], keep=["n"]).select(
        "word", "n", F.concat(F.lit(" "), F.array_join("tokens", T.SEP), F.lit(" ")).alias("t"))
    return BpeModel(merges, vocab, state, rules, passes, sizes, recounts)

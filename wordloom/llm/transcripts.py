"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A hidden state is a role together with whether a line begins a turn or goes on
with one. A line is seen as a speaker marker (a name before a colon, or a
heading) and features of its text. Transition and emission probabilities are
counted from labelled conversations; Viterbi recovers the states of a
transcript.

A transcript comes in pieces (rows of some lines each) that have an order.
Viterbi is split along them: a piece is summed up by a matrix, the best score
from every state before it to every state at its end. The matrices of ``BLOCK``
neighbours are joined to one, level by level, until a conversation has one; then
the states at the borders are fixed from the top down, and each piece finds its
own path between its borders. So a conversation of any length is never in one
task, and the rendering of a piece needs nothing but the piece.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import materialize, read_table
from wordloom.llm.langid import held_out

ROLES = ("system", "user", "assistant")
#: States: role * 2 + (1 if the line goes on with a turn), and the state before a transcript's first line.
STATES = 2 * len(ROLES) + 1
START = STATES - 1
#: Neighbours that one step joins.
BLOCK = 64
#: Count that every event has beforehand.
SMOOTH = 0.5

# Words of speaker markers by role.
MARKERS = {
    "system": "system instruction instructions context prompt".split(),
    "user": "user human customer question q me client usuario utilisateur nutzer benutzer".split(),
    "assistant": "assistant ai bot agent answer a model chatbot asistente".split(),
}
_KIND = {word: k + 1 for k, role in enumerate(ROLES) for word in MARKERS[role]}
_MARK = re.compile(r"\s*(?:(?:\*\*|__|\[)?([^\W\d_]{1,20})(?:\]|\*\*|__)?\s*:(?:\*\*|__)?"
                   r"|#{1,6}\s*([^\W\d_]{1,20})\s*:?|<\|?([^\W\d_]{1,20})\|?>)(?:\s+|$)")
_LIST = re.compile(r"\s*(?:[-*•]|\d+[.)])\s")
_STOP = re.compile(r"[.!?](?=\s|$)")


def marker(line: str) -> tuple[int, int]:
    """What kind of marker a line begins with (0 none, 1 + role, 4 another name) and where its text begins."""
    m = _MARK.match(line)
    if m is None:
        return 0, 0
    kind = _KIND.get((m[1] or m[2] or m[3]).lower(), 4)
    return kind, m.end() if kind < 4 else 0


#: What is seen of a line: name and number of values.
FEATURES = (("marker", 5), ("size", 8), ("stops", 6), ("shape", 4))


def features(line: str) -> tuple[int, ...]:
    kind, at = marker(line)
    text = line[at:]
    shape = 1 if not text.strip() else 2 if text.rstrip().endswith("?") else 3 if _LIST.match(text) else 0
    return kind, min(7, (len(text) // 8 + 1).bit_length() - 1), min(5, len(_STOP.findall(text))), shape


class Model:
    """Logarithms of transition probabilities (state before, state) and emission probabilities (value, state)."""

    def __init__(self, step: np.ndarray, emit: list[np.ndarray]):
        self.step, self.emit = step, emit

    def matrices(self, lines: list[str]) -> np.ndarray:
        """For every line the score from each state before it to each of its own."""
        seen = np.array([features(x) for x in lines]).reshape(-1, len(FEATURES))
        emit = sum(table[seen[:, k]] for k, table in enumerate(self.emit))
        return self.step[None] + emit[:, None, :]


def _ends(turns: DataFrame) -> DataFrame:
    """(conv, turn, before): the role of the turn with the number before, null if there is none."""
    before = turns.select("conv", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before"),
                          (F.size("lines") > 1).alias("went_on"))
    return turns.join(before.dropDuplicates(["conv", "turn"]), ["conv", "turn"], "left")


def train(turns: DataFrame) -> Model:
    """Counts over all labelled ``turns(conv, turn, role, lines)``, each row one turn.

    The driver receives the counts, whose number depends on the model alone.
    Rows with another role, or null, count as nothing.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            seen: Counter = Counter()
            for turn, role, before, on, lines in zip(rows["turn"], rows["role"], rows["before"], rows["went_on"],
                                                     rows["lines"], strict=True):
                if role not in ROLES or lines is None or not len(lines):
                    continue
                state = 2 * ROLES.index(role)
                if before in ROLES:
                    seen[(-1, 2 * ROLES.index(before) + int(bool(on)), state)] += 1
                elif turn == 0:
                    seen[(-1, START, state)] += 1
                for k, line in enumerate(lines):
                    here = state + (k > 0)
                    if k:
                        seen[(-1, state + (k > 1), here)] += 1
                    for f, value in enumerate(features(line or "")):
                        seen[(f, value, here)] += 1
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["f", "x", "state", "n"])

    rows = _ends(turns).select("turn", "role", "before", "went_on", "lines").mapInPandas(
        count, "f int, x int, state int, n bigint").groupBy("f", "x", "state").agg(F.sum("n").alias("n"))
    step = np.full((STATES, STATES), SMOOTH)
    emit = [np.full((n, STATES), SMOOTH) for _, n in FEATURES]
    for r in rows.collect():
        (step if r["f"] < 0 else emit[r["f"]])[r["x"], r["state"]] += r["n"]
    step[:, START] = 0
    for before in range(STATES):  # a line that goes on belongs to the role of the line before
        for state in range(1, START, 2):
            if before // 2 != state // 2 or before == START:
                step[before, state] = 0
    with np.errstate(divide="ignore"):
        return Model(np.log(step / step.sum(axis=1, keepdims=True)), [np.log(t / t.sum(axis=0)) for t in emit])


def joined(matrices: np.ndarray) -> np.ndarray:
    """The best scores through consecutive matrices: their product with maximum for sum and sum for product."""
    out = matrices[0]
    for m in matrices[1:]:
        out = (out[:, :, None] + m[None]).max(axis=1)
    return out


def best_path(matrices: np.ndarray, enter: int, leave: int | None = None) -> list[int]:
    """The best states after each of the matrices, coming from ``enter`` (and ending in ``leave``); ties: least state."""
    score, back = matrices[0][enter], []
    for m in matrices[1:]:
        total = score[:, None] + m
        back.append(total.argmax(axis=0))
        score = total.max(axis=0)
    states = [int(score.argmax()) if leave is None else leave]
    for b in reversed(back):
        states.append(int(b[states[-1]]))
    return states[::-1]


def _groups(batches: Iterator[pd.DataFrame], keys: list[str], least: int = 4096) -> Iterator[pd.DataFrame]:
    """Whole groups of rows that are sorted by ``keys``, many groups at a time."""
    held = None
    for pdf in batches:
        held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        if len(held) >= least:
            cut = _runs(held, keys)[-1][0]
            if cut:
                yield held[:cut].reset_index(drop=True)
                held = held[cut:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def _runs(rows: pd.DataFrame, keys: list[str]) -> list[tuple[int, int]]:
    """(first, last exclusive) of the runs of rows with equal keys."""
    new = np.ones(len(rows), bool)
    new[1:] = False
    for k in keys:
        v = rows[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    at = np.flatnonzero(new).tolist()
    return list(zip(at, [*at[1:], len(rows)], strict=True))


def _square(rows: pd.DataFrame) -> np.ndarray:
    return np.stack(rows["m"].to_list()).reshape(-1, STATES, STATES)


UP, DOWN = "conv bigint, at bigint, m array<double>", "conv bigint, at bigint, enter int, leave int"


def decode(pieces: DataFrame, model: Model) -> DataFrame:
    """``pieces(conv, at, lines)`` with ``enter``, the state before a piece, and ``states``, those of its lines.

    (conv, at) is unique, ``at`` >= 0 gives the order within a conversation
    (gaps do no harm) and every piece has a line.
    """
    def dealt(df):
        """Rows by block; equal blocks are neighbours, in order."""
        df = df.withColumn("block", F.floor(F.col("at") / BLOCK))
        return df.repartition("conv", "block").sortWithinPartitions("conv", "block", "at")

    def sum_pieces(batches):
        for rows in batches:
            yield pd.DataFrame({"conv": rows["conv"], "at": rows["at"], "m": [
                joined(model.matrices(list(x))).ravel() for x in rows["lines"]]})

    def sum_blocks(batches):
        for rows in _groups(batches, ["conv", "block"]):
            each, runs = _square(rows), _runs(rows, ["conv", "block"])
            yield pd.DataFrame({"conv": [rows["conv"][a] for a, _ in runs], "at": [rows["block"][a] for a, _ in runs],
                                "m": [joined(each[a:b]).ravel() for a, b in runs]})

    def top(batches):
        for rows in batches:
            yield pd.DataFrame({"conv": rows["conv"], "at": rows["at"], "enter": START, "leave": [
                best_path(m[None], START)[0] for m in (_square(rows) if len(rows) else ())]})

    def borders(batches):
        for rows in _groups(batches, ["conv", "block"]):
            each, enter, leave = _square(rows), [], []
            for a, b in _runs(rows, ["conv", "block"]):
                states = best_path(each[a:b], int(rows["enter"][a]), int(rows["leave"][a]))
                enter += [int(rows["enter"][a]), *states[:-1]]
                leave += states
            yield pd.DataFrame({"conv": rows["conv"], "at": rows["at"], "enter": enter, "leave": leave})

    def states(batches):
        for rows in batches:
            rows["states"] = [best_path(model.matrices(list(x)), e, s) for x, e, s in zip(
                rows["lines"], rows["enter"], rows["leave"], strict=True)]
            yield rows[["conv", "at", "lines", "enter", "states"]]

    levels = [materialize(pieces.select("conv", "at", "lines").mapInPandas(sum_pieces, UP), "matrices")]
    while levels[-1].agg(F.max("at")).first()[0]:
        levels.append(materialize(dealt(levels[-1]).mapInPandas(sum_blocks, UP), "matrices"))
    ends = materialize(levels[-1].mapInPandas(top, DOWN), "borders")
    for level in reversed(levels[:-1]):
        above = ends.withColumnRenamed("at", "block")
        found = level.withColumn("block", F.floor(F.col("at") / BLOCK)).join(above, ["conv", "block"])
        ends = materialize(dealt(found).mapInPandas(borders, DOWN), "borders")
    schema = "conv bigint, at bigint, lines array<string>, enter int, states array<int>"
    return pieces.select("conv", "at", "lines").join(ends, ["conv", "at"]).mapInPandas(states, schema)


def rendered(lines, enter: int, states) -> str:
    """The canonical form of a piece; the forms of a conversation's pieces in order, and an end, are its turns.

    A turn is ``<|role|>``, its lines without speaker markers, and ``<|end|>``.
    """
    out = []
    for line, state in zip(lines, states, strict=True):
        if state % 2 == 0:
            out += ([] if enter == START and not out else ["<|end|>"]) + [f"<|{ROLES[state // 2]}|>"]
            line = line[marker(line)[1]:]
            if not line:  # the marker had a line of its own
                continue
        out.append(line)
    return "".join(f"{x}\n" for x in out)


def format_chats(pieces: DataFrame, model: Model) -> DataFrame:
    """(conv, at, roles, begins, rendered): one row per piece, the role of each line and whether it begins a turn."""
    def run(batches):
        for rows in batches:
            if not len(rows):
                continue
            yield pd.DataFrame({
                "conv": rows["conv"], "at": rows["at"],
                "roles": [[ROLES[s // 2] for s in x] for x in rows["states"]],
                "begins": [[s % 2 == 0 for s in x] for x in rows["states"]],
                "rendered": pd.Series([rendered(*x) for x in zip(rows["lines"], rows["enter"], rows["states"], strict=True)],
                                      dtype=object)})

    return decode(pieces, model).mapInPandas(
        run, "conv bigint, at bigint, roles array<string>, begins array<boolean>, rendered string")


def transcripts(conversations: DataFrame) -> DataFrame:
    """(conv, at, turn, role, lines) from ``conversations(conv_id, turn, role, text)``: plain text as found in dumps.

    A conversation has one style of speaker markers, by its id, and one turn in
    five, by its id and number, lacks its marker. Null ids, null turns and null
    texts and negative turns have no place in a transcript and give no row; of
    repeated turns the least role and text stays; an empty text is one empty line.
    """
    known = conversations.filter("conv_id IS NOT NULL AND turn >= 0 AND text IS NOT NULL")
    one = known.groupBy(F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn")).agg(
        F.min(F.struct("role", "text")).alias("t")).select("conv", "turn", "t.*")
    style = F.pmod(F.xxhash64("conv"), F.lit(4))
    name = F.initcap(F.coalesce("role", F.lit("other")))
    short = F.when(F.col("role") == "user", "Q").when(F.col("role") == "assistant", "A").otherwise(name)
    human = F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "AI").otherwise(name)
    mark = F.when(style == 0, F.concat(name, F.lit(": "))).when(style == 1, F.concat(short, F.lit(": "))).when(
        style == 2, F.concat(F.lit("**"), human, F.lit(":** "))).otherwise(F.concat(F.lit("### "), name, F.lit("\n")))
    bare = F.pmod(F.xxhash64("conv", "turn"), F.lit(5)) == 0
    text = F.concat(F.when(bare, F.lit("")).otherwise(mark), "text")
    return one.withColumn("lines", F.split(text, "\n", -1)).select(
        "conv", F.col("turn").alias("at"), "turn", "role", "lines")


def op6_transcripts(spark, sf_dir: str) -> DataFrame:
    """Roles of all transcripts of ``conversations``; the model learns from those that are not held out."""
    pieces = materialize(transcripts(read_table(spark, sf_dir, "conversations")), "transcripts")
    model = train(pieces.filter(~held_out(F.col("conv"))))
    out = format_chats(pieces, model)
    return out.select(F.col("conv").alias("conv_id"), F.col("at").alias("turn"), held_out(F.col("conv")).alias(
        "held_out"), F.element_at("roles", 1).alias("role_pred"), "roles", "begins", "rendered")

"""SentencePiece encoding and decoding with N-best segmentations.

A text's pieces form a lattice over its characters. Forward Viterbi gives every
position the score of the best way to reach it. A backward A* search from the
end adds pieces on the left; what it has, plus the Viterbi score of its
position, is exactly the best total it can reach, so segmentations are completed
in the order of their scores.

No piece crosses certain positions (before a word mark that follows another
character, and around a character that is in no longer piece), so the lattice
falls into chunks there and the N best of a text are combined from the N best
of its chunks. Tasks remember the chunks they have seen, up to a fixed number.

The scores are unigram log probabilities. Those of a BPE model are merge ranks,
which must not be added up; so the pieces of the model's own encoding are
counted over the corpus first, and a piece scores log(n / total).
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import bounded_batches, read_table, release, slices

MARK = "▁"
#: Score of a character without a piece, below the worst piece; it becomes byte pieces.
PENALTY = 10.0
#: Chunks that a task remembers, and the longest one that is solved together with others.
REMEMBERED, TOGETHER = 400_000, 40
#: Count of a piece that the corpus does not have.
UNSEEN = 0.5


def model_path() -> str:
    """Path of the public 32k piece model that is installed next to the library."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Segmenter:
    """N-best segmentation with the pieces and scores of a model.

    ``pieces`` maps ordinary pieces to (id, score), ``byte_ids`` are the ids of
    the 256 byte pieces. Ties go to the segmentation with the shorter last
    piece, and in a text to changes further to the left.
    """

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        self.pieces = pieces
        self.byte_ids = byte_ids
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min((s for _, s in pieces.values() if s > -1e8), default=0.0) - PENALTY
        self.crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        inside = sorted({c for p in pieces if len(p) > 1 for c in p} - {MARK})
        joined = "".join(map(re.escape, inside))
        some = f"[{joined}]" if joined else "(?!)"
        self.cutter = re.compile(f"{MARK}+{some}*|{some}+|.", re.S)
        # solved chunks: place of each, and by place the ids (as bytes), their number, the score, the second's loss
        self.memory: dict[str, int] = {}
        self.solved: list[bytes] = []
        self.counts = np.zeros(REMEMBERED, np.int64)
        self.scores, self.losses = np.zeros(REMEMBERED), np.zeros(REMEMBERED)
        self.tables = self._tables()
        size = max([i for i, _ in pieces.values()] + list(byte_ids)) + 1
        self.texts = [""] * size
        for piece, (i, _) in pieces.items():
            self.texts[i] = piece.replace(MARK, " ")
        for b, i in enumerate(byte_ids):
            if b < 128:
                self.texts[i] = chr(b)
        self.high = np.zeros(size, bool)  # pieces that are part of a character
        self.high[byte_ids[128:]] = True
        self.bytes_of = {i: b for b, i in enumerate(byte_ids) if b >= 128}

    @classmethod
    def load(cls, path: str, scores: np.ndarray | None = None) -> Segmenter:
        """With the model's own scores, or with ``scores`` by id."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        pieces, byte_ids = {}, [0] * 256
        for i in range(model.get_piece_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(text[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[text] = (i, model.get_score(i) if scores is None else float(scores[i]))
        return cls(pieces, byte_ids)

    def chunks(self, text: str) -> list[str]:
        line = MARK + text.replace(" ", MARK)
        return [line] if self.crossing else self.cutter.findall(line)

    def lattice(self, chunk: str):
        """Viterbi scores by position, and by end position the edges (start, score, ids)."""
        n, longest, get = len(chunk), self.longest, self.pieces.get
        best = [0.0] + [-1e300] * n
        edges: list[list] = [[] for _ in range(n + 1)]
        for i in range(n):
            here = best[i]
            single = False
            for j in range(i + 1, min(n, i + longest) + 1):
                hit = get(chunk[i:j])
                if hit is not None:
                    edges[j].append((i, hit[1], hit[0]))
                    if here + hit[1] > best[j]:
                        best[j] = here + hit[1]
                    single = single or j == i + 1
            if not single:
                edges[i + 1].append((i, self.unknown, -1))
                if here + self.unknown > best[i + 1]:
                    best[i + 1] = here + self.unknown
        return best, edges

    def search(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations of a chunk as (score, ids), best first; fewer if there are no more."""
        best, edges = self.lattice(chunk)
        heap = [(-best[-1], 0, 0.0, len(chunk), None)]
        out, made = [], 0
        while heap:
            _, _, got, at, path = heapq.heappop(heap)
            if not at:
                ids: list[int] = []
                while path is not None:
                    (start, end, piece), path = path
                    if piece >= 0:
                        ids.append(piece)
                    else:
                        ids += [self.byte_ids[b] for b in chunk[start:end].encode()]
                out.append((got, tuple(ids)))
                if len(out) == n:
                    break
                continue
            for start, score, piece in reversed(edges[at]):
                made += 1
                total = got + score
                heapq.heappush(heap, (-(total + best[start]), made, total, start, ((start, at, piece), path)))
        return out

    def _tables(self):
        """Per length of pieces: whether any hash has some 20 bits, the hashes in order, ids and scores."""
        by_size: dict[int, list] = {}
        for piece, (i, score) in self.pieces.items():
            by_size.setdefault(len(piece), []).append((piece, i, score))
        out = {}
        for size, rows in by_size.items():
            code = np.frombuffer("".join(r[0] for r in rows).encode("utf-32-le"), np.uint32).reshape(-1, size)
            h = np.zeros(len(rows), np.uint64)
            for k in range(size):
                h = h * _BASE + code[:, k]
            order = np.argsort(h)
            begun = np.zeros(1 << 20, bool)
            begun[h * _BASE >> _REST] = True
            out[size] = (begun, h[order], np.array([r[1] for r in rows], np.int32)[order],
                         np.array([r[2] for r in rows])[order])
        return out

    def solve(self, chunks: list[str]) -> None:
        """Remembers the best ids of new chunks, their score, and the loss of the second best (infinite if none).

        Chunks of one length run through the forward pass together; it keeps the
        two best scores of every position.
        """
        by_size: dict[int, list[str]] = {}
        for c in chunks:
            by_size.setdefault(len(c), []).append(c)
        for size, group in by_size.items():
            if size > TOGETHER:
                for c in group:
                    found = self.search(c, 2)
                    loss = found[0][0] - found[1][0] if len(found) > 1 else float("inf")
                    self._remember(c, found[0][1], found[0][0], loss)
            else:
                for at in range(0, len(group), 8192):
                    self._solve_together(size, group[at : at + 8192])

    def forget(self) -> None:
        """Drops the solved chunks."""
        self.memory.clear()
        self.solved.clear()

    def _remember(self, chunk: str, ids, score: float, loss: float) -> None:
        k = self.memory[chunk] = len(self.solved)
        self.solved.append(array("i", ids).tobytes())
        self.counts[k], self.scores[k], self.losses[k] = len(ids), score, loss

    def _solve_together(self, size: int, group: list[str]) -> None:
        n = len(group)
        code = np.frombuffer("".join(group).encode("utf-32-le"), np.uint32).reshape(n, size).T.astype(np.uint64)
        h = np.zeros((size, n), np.uint64)
        ids, values = {}, {}
        for width in range(1, min(size, self.longest) + 1):
            h = h[: size - width + 1] * _BASE + code[width - 1 :]
            if width not in self.tables:
                continue
            begun, known, numbers, scores = self.tables[width]
            ids[width], values[width] = np.full(h.shape, -1, np.int32), np.full(h.shape, -np.inf)
            some = begun[h * _BASE >> _REST]  # most strings are no piece: only the others are searched for
            asked = h[some]
            at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
            hit = known[at] == asked
            ids[width][some] = np.where(hit, numbers[at], -1)
            values[width][some] = np.where(hit, scores[at], -np.inf)
        if 1 not in ids:
            ids[1], values[1] = np.full((size, n), -1, np.int32), np.full((size, n), -np.inf)
        values[1] = np.where(ids[1] < 0, self.unknown, values[1])
        best, second = np.full((size + 1, n), -np.inf), np.full((size + 1, n), -np.inf)
        back = np.zeros((size + 1, n), np.int32)
        best[0] = 0
        for j in range(1, size + 1):
            top, next_, arg = best[j], second[j], back[j]
            for width, value in values.items():
                if width > j:
                    continue
                one = best[j - width] + value[j - width]
                two = second[j - width] + value[j - width]
                better = one > top
                np.maximum(next_, np.where(better, top, one), out=next_)
                np.maximum(next_, two, out=next_)
                np.copyto(top, one, where=better)
                arg[better] = width
        column = np.arange(n)
        at = np.full(n, size)
        steps = []
        while at.any():
            width = back[at, column]
            start = at - width
            piece = np.full(n, -2, np.int32)
            for w in np.unique(width[width > 0]):
                here = width == w
                piece[here] = ids[w][start[here], column[here]]
            steps.append((piece, start))
            at = start
        unknown = any((p == -1).any() for p, _ in steps)
        rows = np.array([p for p, _ in reversed(steps)]).T.tolist() if unknown else None
        places = np.array([a for _, a in reversed(steps)]).T if unknown else None
        losses = np.where(second[size] == -np.inf, np.inf, best[size] - second[size])
        if places is not None:
            for k, (c, row, score, loss) in enumerate(zip(group, rows, best[size].tolist(), losses.tolist(),
                                                          strict=True)):
                self._remember(c, [x for p, a in zip(row, places[k].tolist(), strict=True) if p > -2
                                   for x in ([self.byte_ids[b] for b in c[a].encode()] if p == -1 else (p,))],
                               score, loss)
            return
        pieces = np.array([p for p, _ in reversed(steps)], np.int32).T
        counts = (pieces >= 0).sum(axis=1)
        flat, ends = pieces[pieces >= 0].tobytes(), (4 * np.cumsum(counts)).tolist()
        first = len(self.solved)
        self.memory.update(zip(group, range(first, first + n), strict=True))
        self.solved += [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        self.counts[first : first + n], self.scores[first : first + n] = counts, best[size]
        self.losses[first : first + n] = losses

    def nbest_all(self, texts: list[str], n: int) -> list[tuple]:
        """``nbest`` of many texts."""
        cut = [self.chunks(t) if t else [] for t in texts]
        out = []
        for first in range(0, len(texts), 1024):
            some = cut[first : first + 1024]
            wanted = set().union(*some)
            new = list(wanted.difference(self.memory))
            if len(self.memory) + len(new) > REMEMBERED:
                self.forget()
                new = list(wanted)
                if len(new) > len(self.scores):  # one round of texts may hold more
                    self.counts, self.scores, self.losses = (np.zeros(len(new), x.dtype) for x in (
                        self.counts, self.scores, self.losses))
            self.solve(new)
            for at in range(0, len(some), 64):
                out += self._together(some[at : at + 64], n)
        return out

    def nbest(self, text: str, n: int) -> tuple:
        """Best ids, their score, and the next ``n - 1`` segmentations.

        Each of these is (score, edits), an edit (at, length, ids) replacing
        ``length`` ids of the best from index ``at``.
        """
        return self.nbest_all([text], n)[0]

    def _together(self, some: list[list[str]], n: int) -> Iterator[tuple]:
        """``nbest`` of texts whose chunks are solved."""
        places = list(map(self.memory.__getitem__, chain.from_iterable(some)))
        at = np.array(places, np.int64)
        counts, scores, losses = self.counts[at], self.scores[at], self.losses[at]
        end = 0
        for parts in some:
            begin, end = end, end + len(parts)
            ids = np.frombuffer(b"".join(map(self.solved.__getitem__, places[begin:end])), np.int32)
            own = slice(begin, end)
            yield self._nbest(parts, n, ids, counts[own], float(scores[own].sum()), losses[own])

    def _nbest(self, parts: list[str], n: int, ids, counts, score: float, losses) -> tuple:
        if not parts or n < 2:
            return ids, score, []
        # a better combination only ever changes the n - 1 chunks that lose least
        limit = np.partition(losses, n - 2)[n - 2] if len(losses) >= n else np.inf
        near = np.flatnonzero(losses <= limit)
        first = near[np.argsort(losses[near], kind="stable")][: n - 1]
        starts = np.cumsum(counts) - counts
        choices = []
        for k in first[np.isfinite(losses[first])].tolist():
            best = tuple(ids[starts[k] : starts[k] + counts[k]].tolist())
            options = self.search(parts[k], n)
            others = [o for o in options if o[1] != best][: n - 1]  # of equal scores any may be the best
            choices.append((int(starts[k]), len(best), [(options[0][0] - s, i) for s, i in others]))
        sums: list[tuple] = [(0.0, ())]
        for c, (_, _, options) in enumerate(choices):
            more = [(loss + o[0], (*picks, (c, j))) for loss, picks in sums for j, o in enumerate(options)]
            sums = heapq.nsmallest(n, sums + more, key=lambda x: x[0])
        rest = []
        for loss, picks in sums[1:]:
            edits = [(choices[c][0], choices[c][1], choices[c][2][j][1]) for c, j in picks]
            rest.append((score - loss, sorted(edits)))
        return ids, score, rest

    def decode(self, ids) -> str:
        """The text of a segmentation; invalid UTF-8 from byte pieces becomes U+FFFD."""
        texts, bytes_of = self.texts, self.bytes_of
        ids = np.asarray(ids, np.int64)
        if not self.high[ids].any():
            return "".join(map(texts.__getitem__, ids.tolist()))[1:]
        out, held = [], bytearray()
        for i in ids.tolist():
            b = bytes_of.get(i)
            if b is not None:
                held.append(b)
                continue
            if held:
                out.append(held.decode(errors="replace"))
                held.clear()
            out.append(texts[i])
        out.append(held.decode(errors="replace"))
        return "".join(out)[1:]


_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, for hashes of short strings
_REST = np.uint64(44)  # bits of a mixed hash behind its first 20
_LOADED: dict[str, tuple[bytes, Segmenter]] = {}


def segmenter(path: str, scores: np.ndarray | None = None) -> Segmenter:
    """One segmenter per worker process and model, with the scores of the last call."""
    key = b"" if scores is None else scores.tobytes()
    if path not in _LOADED or _LOADED[path][0] != key:
        _LOADED[path] = key, Segmenter.load(path, scores)
    return _LOADED[path][1]


def piece_counts(docs: DataFrame, model: str | None = None, text_col: str = "text") -> np.ndarray:
    """How often the model's own encoding of all texts has each piece, by id.

    No piece crosses the start of a run of spaces (else texts stay whole), so
    tasks count words with the spaces before them and encode each distinct one once.
    """
    bounded_batches(docs)
    path = model or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        own = SentencePieceProcessor(model_file=path)
        tool = segmenter(path)
        spaced = re.compile(" +[^ ]*")
        # a character of no longer piece, before a word, takes the mark that the model puts in front
        front = next(c for c in "\n\t\x01\x02\x03\x04\x05" if all(c not in p for p in tool.pieces if len(p) > 1))
        skip = len(own.encode(front))
        counts = np.zeros(own.get_piece_size(), np.int64)
        seen: Counter[str] = Counter()  # without the first space

        def settle():
            names, times = list(seen), np.fromiter(seen.values(), np.int64, len(seen))
            for at in range(0, len(names), 8192):
                ids = [x[skip:] for x in own.encode([f"{front} {w}" for w in names[at : at + 8192]])]
                sizes = list(map(len, ids))
                flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(sizes))
                np.add.at(counts, flat, np.repeat(times[at : at + 8192], sizes))
            seen.clear()

        for batch in batches:
            for _, (part,) in slices(batch, 1024):
                for text in filter(None, part):
                    text = text.replace(MARK, " ")
                    if tool.crossing:
                        seen[text] += 1
                    elif text[0] == " " or "  " in text:
                        seen.update(w[1:] for w in spaced.findall(" " + text))
                    else:
                        seen.update(text.split(" "))
                if len(seen) > REMEMBERED:
                    settle()
        settle()
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], ["id", "n"])
        release()

    from sentencepiece import SentencePieceProcessor

    total = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "id int, n bigint").groupBy("id").agg(
        F.sum("n").alias("n"))
    out = np.zeros(SentencePieceProcessor(model_file=path).get_piece_size(), np.int64)
    for r in total.collect():  # at most as many rows as the model has pieces
        out[r["id"]] = r["n"]
    return out


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Unigram scores log(n / total); a piece that does not occur counts ``UNSEEN``."""
    return np.log(np.maximum(counts, UNSEEN) / max(int(counts.sum()), 1))


def encode(docs: DataFrame, model: str | None = None, n: int = 3, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, ids, score, alternatives, lossless): one row per row of ``docs``, from its whole text.

    ``ids`` is the best segmentation, ``alternatives`` the next ``n - 1`` as
    edits of it, ``lossless`` whether the ids decode to the text (they do not if
    it holds the word mark U+2581 itself). Null gives null ids and score, an
    empty text no ids and score 0; both have no alternatives. Repeated rows and
    null ids are kept, other columns are not read. ``model`` is a path that
    every executor can read. Scores are log probabilities of the pieces in
    ``docs`` itself, so ``docs`` is read twice.
    """
    bounded_batches(docs)
    path = model or model_path()
    scores = docs.sparkSession.sparkContext.broadcast(log_probabilities(piece_counts(docs, path, text_col)))
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"id {id_type}, ids array<int>, score double, alternatives array<struct<score:double,"
              "edits:array<struct<at:int,length:int,ids:array<int>>>>>, lossless boolean")
    edit = pa.struct([("at", pa.int32()), ("length", pa.int32()), ("ids", pa.list_(pa.int32()))])
    other = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(edit))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = segmenter(path, scores.value)
        for batch in batches:
            for first, (_, part) in slices(batch, 1024):
                flat, ends, totals, rest, same = [], [0], [], [], []
                for text, (ids, score, more) in zip(part, tool.nbest_all(part, n), strict=True):
                    flat.append(ids)
                    ends.append(ends[-1] + len(ids))
                    totals.append(None if text is None else score)
                    rest.append([{"score": s, "edits": [dict(zip(("at", "length", "ids"), e, strict=True)) for e in es]}
                                 for s, es in more])
                    same.append(None if text is None else tool.decode(ids) == text)
                null = pa.array([t is None for t in part], pa.bool_())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(
                    np.concatenate(flat) if flat else np.empty(0, np.int32)), mask=null)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(part)), lists, pa.array(totals, pa.float64()), pa.array(rest, other),
                    pa.array(same, pa.bool_())], ["id", "ids", "score", "alternatives", "lossless"])
        tool.forget()
        release()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str | None = None, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with the column ``decoded``: the text of the ids (null ids: null)."""
    path = model or model_path()

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tool = segmenter(path)
        for rows in batches:
            yield rows.map(lambda ids: None if ids is None else tool.decode(ids))

    return encoded.withColumn("decoded", text(F.col(ids_col)))


def op5_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """The three best segmentations of every document, and whether the best decodes to its text."""
    return encode(read_table(spark, sf_dir, "documents"), n=3).withColumnRenamed("id", "doc_id")

"""SentencePiece encoding (N best segmentations) and decoding.

A text is normalised as the model says (a space in front, spaces as U+2581) and
cut where no piece can reach across: before a run of U+2581 that follows
another character, and around control characters that no piece holds. Each cut
is a lattice of vocabulary pieces with their scores. A forward Viterbi pass gives
the best score up to every position (and the second best at the end); the N
best paths come from an A* search from the end backwards, with the forward
scores as exact estimates of what is left, so every path it completes is the
next best. A segmentation of a text is a choice of one path per cut: only the
N - 1 cuts with the smallest gap between best and second best can differ from
the best in the N best segmentations, so only these are searched.

Characters without a piece become byte pieces. Scores are those of the model's
pieces; in the public vocabulary here they are merge ranks, so the best
segmentation is the one of the highest total score, which need not be the one
that merging would give.

Distinct cuts are numbered and solved once per Python worker while they stay in a
bounded table; when it is full, the cuts used most since the last time stay. The vocabulary is read on the driver and broadcast (tens of thousands of
pieces).

Defined results: null and empty texts have one segmentation without pieces, of
score 0; fewer than N segmentations if there are no more; of equal scores the
one found first in a fixed order; U+2581 in a text decodes as a space; repeated
rows get equal results; other columns pass through, and columns of the output's
names (``pieces``, ``piece_score``, ``alternatives``) are replaced.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from contrail.llm.common import free_name

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
MARK = "▁"
CACHED_CUTS = 200_000  # beyond it, or beyond so many characters, all but the most used half are forgotten
CACHED_CHARS = 1 << 22
LONGEST_CACHED = 64  # longer cuts are solved one by one and forgotten first
CACHED_OTHERS = 13_000  # cuts whose next best paths are kept
BATCH_CHARS = 1 << 20  # texts of about so many characters are answered at once
UNKNOWN_PENALTY = 10.0
NOTHING = float("-inf")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)
_SLOTS, _SPARE = 20, 18  # bits of the two tables that find a piece by its hash

ENCODED = T.StructType(
    [
        T.StructField("pieces", T.ArrayType(T.IntegerType())),
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "alternatives",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("score", T.DoubleType()),
                        T.StructField(
                            "edits",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("at", T.IntegerType()),
                                        T.StructField("drop", T.IntegerType()),
                                        T.StructField("put", T.ArrayType(T.IntegerType())),
                                    ]
                                )
                            ),
                        ),
                    ]
                )
            ),
        ),
    ]
)
_ARROW_EDIT = pa.struct([("at", pa.int32()), ("drop", pa.int32()), ("put", pa.list_(pa.int32()))])
_ARROW_ALTERNATIVES = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(_ARROW_EDIT))]))


class SolvedCuts:
    """A table of distinct cuts by number: texts, scores, gaps to the second best, and where their identifiers are in ``ids``.

    ``number[cut]`` gives a cut that is new the next number; ``add`` takes what was found for the new ones.
    """

    def __init__(self, names: list[str], score: np.ndarray, gap: np.ndarray, pieces: np.ndarray, ids: np.ndarray):
        self.names, self.score, self.gap, self.count, self.ids = names, score, gap, pieces, ids
        self.start = np.cumsum(pieces) - pieces
        self.number = defaultdict(count(len(names)).__next__, zip(names, count()))
        self.uses = np.zeros(len(names), np.int64)
        self.chars = sum(map(len, names))

    @classmethod
    def empty(cls) -> SolvedCuts:
        return cls([], np.empty(0), np.empty(0), np.empty(0, np.int64), np.empty(0, np.int32))

    def __getitem__(self, cut: str) -> tuple[bytes, float, float]:
        """What ``PieceLattice.solve`` gives for a cut of the table."""
        k = self.number.get(cut, len(self.names))
        if k >= len(self.names):
            raise KeyError(cut)
        return self.pieces_of(np.array([k])).tobytes(), float(self.score[k]), float(self.gap[k])

    def pieces_of(self, at: np.ndarray) -> np.ndarray:
        """The identifiers of the cuts ``at``, one after the other."""
        counts = self.count[at]
        ends = np.cumsum(counts)
        return self.ids[np.repeat(self.start[at] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]

    def unsolved(self) -> list[str]:
        return list(islice(self.number, len(self.names), None))

    def add(self, names: list[str], places: np.ndarray, score: np.ndarray, gap: np.ndarray, pieces: np.ndarray, ids: np.ndarray) -> None:
        """Takes the results of the unsolved cuts ``names``, given in the order ``places``."""
        start = np.empty(len(names), np.int64)
        start[places] = len(self.ids) + np.cumsum(pieces) - pieces
        back = np.argsort(places)
        self.start, self.ids = np.append(self.start, start), np.append(self.ids, ids)
        self.score, self.gap, self.count = np.append(self.score, score[back]), np.append(self.gap, gap[back]), np.append(self.count, pieces[back])
        self.names += names
        self.chars += sum(map(len, names))

    def used(self, at: list[np.ndarray]) -> None:
        uses = np.bincount(np.concatenate([np.empty(0, np.int32), *at]), minlength=len(self.names))
        uses[: len(self.uses)] += self.uses
        self.uses = uses

    def full(self) -> bool:
        return len(self.names) > CACHED_CUTS or self.chars > CACHED_CHARS

    def most_used(self) -> SolvedCuts:
        """A table of the cuts that were used most, half as large at most; none is a long one."""
        length = np.fromiter(map(len, self.names), np.int64, len(self.names))
        short = np.flatnonzero(length <= LONGEST_CACHED)
        uses = np.append(self.uses, np.zeros(len(self.names) - len(self.uses), np.int64))
        by_use = short[np.argsort(-uses[short], kind="stable")][: CACHED_CUTS // 2]
        at = np.sort(by_use[np.cumsum(length[by_use]) <= CACHED_CHARS // 2])
        return SolvedCuts([self.names[k] for k in at.tolist()], self.score[at], self.gap[at], self.count[at], self.pieces_of(at))


class PieceLattice:
    """Vocabulary, lattice search and decoding; plain Python, sent to the tasks by broadcast."""

    def __init__(self, model: str | bytes):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor()
        p.LoadFromSerializedProto(model) if isinstance(model, bytes) else p.Load(model)
        if p.normalize(" a  b") != f"{MARK}{MARK}a{MARK}{MARK}b":
            raise ValueError("only models that put a space in front and keep the text as it is")
        ids = range(p.get_piece_size())
        self.byte_ids = {int(p.id_to_piece(i)[1:-1], 16): i for i in ids if p.is_byte(i)}
        self.unknown = p.unk_id()
        plain = [i for i in ids if not (p.is_byte(i) or p.is_unknown(i) or p.is_control(i) or p.is_unused(i))]
        self.found = {p.id_to_piece(i): (p.get_score(i), i) for i in plain}
        self.longest = max(map(len, self.found))
        self.unknown_score = min(s for s, _ in self.found.values()) - UNKNOWN_PENALTY
        if any(MARK in piece.lstrip(MARK) for piece in self.found):
            raise ValueError("a piece reaches across a space")
        held = set("".join(self.found))
        cut = "".join(re.escape(c) for c in "\n\t\r\x0b\x0c" if c not in held)
        alone = f"[{cut}]|" if cut else ""
        self.pattern = f"{alone}{MARK}+[^{MARK}{cut}]*|[^{MARK}{cut}]+"
        table = {i: b"" for i in ids if p.is_control(i)}
        table[self.unknown] = " ⁇ ".encode()
        table.update({i: bytes([b]) for b, i in self.byte_ids.items()})
        table.update({i: piece.replace(MARK, " ").encode() for piece, (_, i) in self.found.items()})
        self.bytes_of = [table.get(i, b"") for i in ids]
        self._tables()
        self._start()

    def _start(self) -> None:
        self.cuts = re.compile(self.pattern).findall
        self.cache, self.others = SolvedCuts.empty(), {}

    def _tables(self) -> None:
        """Pieces by the hash of their code points: a slot in one table, or, if that is taken, in the spare one."""
        pieces = [p for p in self.found if len(p) <= LONGEST_CACHED]
        self.piece_hash = np.zeros(len(pieces), np.uint64)
        for k, p in enumerate(pieces):
            h = 0
            for c in p:
                h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
            self.piece_hash[k] = h
        starts = {p[:n] for p in pieces for n in range(1, len(p) + 1)}
        self.begun = np.zeros(1 << _SLOTS, bool)  # by the leading bits of a hash: whether a piece begins with such characters
        hashes = np.zeros(len(starts), np.uint64)
        for k, p in enumerate(starts):
            h = 0
            for c in p:
                h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
            hashes[k] = h
        self.begun[self._begins(hashes)] = True
        self.piece_score = np.array([self.found[p][0] for p in pieces])
        self.piece_id = np.array([self.found[p][1] for p in pieces], np.int32)
        for salt in range(0, 200, 2):  # until every piece has a slot
            self.salt = _OTHER + np.uint64(salt)
            self.slots, self.spare = np.full(1 << _SLOTS, -1, np.int32), np.full(1 << _SPARE, -1, np.int32)
            main, other = self._places(self.piece_hash)
            number = np.arange(len(pieces), dtype=np.int32)
            self.slots[main[::-1]] = number[::-1]
            late = number[self.slots[main] != number]
            self.spare[other[late]] = late
            if (self.spare[other[late]] == late).all():
                return
        raise ValueError("the piece tables are too small for this vocabulary")

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = (h ^ (h >> np.uint64(29))) * self.salt
        return x >> np.uint64(64 - _SLOTS), (x ^ (x >> np.uint64(31))) * _BASE >> np.uint64(64 - _SPARE)

    @staticmethod
    def _begins(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(31))) * _OTHER) >> np.uint64(64 - _SLOTS)

    def _lookup(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers by hash, -1 for none."""
        main, other = self._places(h)
        k = self.slots[main]
        k = np.where((k >= 0) & (self.piece_hash[k] != h), self.spare[other], k)
        return np.where((k >= 0) & (self.piece_hash[k] == h), k, -1)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("cuts", "cache", "others")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    # -- one cut -----------------------------------------------------------

    def ids_of(self, piece: str) -> list[int]:
        known = self.found.get(piece)
        if known is not None:
            return [known[1]]
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in piece.encode()]

    def edge(self, cut: str, i: int, j: int) -> float | None:
        """Score of the piece from i to j; the unknown score for one character without a piece."""
        known = self.found.get(cut[i:j])
        return known[0] if known is not None else self.unknown_score if j == i + 1 else None

    def forward(self, cut: str) -> tuple[list[float], list[int], float]:
        """(best score up to each position, start of the last piece there, second best score at the end)."""
        n, longest, get = len(cut), self.longest, self.found.get
        best, second, back = [NOTHING] * (n + 1), [NOTHING] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            b, s = best[i], second[i]
            for j in range(i + 1, min(n, i + longest) + 1):
                known = get(cut[i:j])
                if known is not None:
                    w = known[0]
                elif j == i + 1:
                    w = self.unknown_score
                else:
                    continue
                c = b + w
                if c > best[j]:
                    second[j] = best[j] if best[j] > s + w else s + w
                    best[j], back[j] = c, i
                elif c > second[j]:
                    second[j] = c
        return best, back, second[n]

    def solve(self, cut: str) -> tuple[bytes, float, float]:
        """(identifiers of the best path as int32 bytes, its score, gap to the second best)."""
        best, back, second = self.forward(cut)
        pieces, j = [], len(cut)
        while j > 0:
            pieces.append(cut[back[j] : j])
            j = back[j]
        ids = [i for piece in reversed(pieces) for i in self.ids_of(piece)]
        return np.array(ids, np.int32).tobytes(), best[-1], best[-1] - second

    def solve_many(self, cuts: list[str]) -> None:
        """``solve`` for many cuts at once. Fills the cache."""
        for c in cuts:
            self.cache.number[c]
        self._solve_new()

    def _solve_new(self) -> None:
        """Solves the new cuts of the cache: the Viterbi pass of all cuts of one length in numpy."""
        cuts = self.cache.unsolved()
        if not cuts:
            return
        length = np.fromiter(map(len, cuts), np.int64, len(cuts))
        by_length = np.argsort(length, kind="stable")
        parts = []  # (places in cuts, score, gap, number of pieces, their identifiers)
        for rows in np.split(by_length, np.flatnonzero(np.diff(length[by_length])) + 1):
            for at in range(0, len(rows), 1 << 14):
                part = rows[at : at + (1 << 14)]
                names, n = [cuts[k] for k in part.tolist()], int(length[part[0]])
                other = np.ones(len(part), bool)
                if n <= LONGEST_CACHED:
                    other, *found = self._solve_length(names, n)
                    parts.append((part[~other], *found))
                if other.any():  # long, or characters without a piece: byte pieces
                    ids, scores, gaps = zip(*[self.solve(names[k]) for k in np.flatnonzero(other).tolist()])
                    sizes = np.array([len(i) // 4 for i in ids], np.int64)
                    parts.append((part[other], np.array(scores), np.array(gaps), sizes, np.frombuffer(b"".join(ids), np.int32)))
        self.cache.add(cuts, *(np.concatenate(c) for c in zip(*parts)))

    def _solve_length(self, group: list[str], n: int) -> tuple[np.ndarray, ...]:
        """(cuts with a character without a piece, and for the others score, gap, number of pieces, identifiers)."""
        m = len(group)
        codes = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(m, n).T.astype(np.uint64) + np.uint64(1)
        best, second = np.full((n + 1, m), NOTHING), np.full((n + 1, m), NOTHING)
        back, last = np.zeros((n + 1, m), np.int16), np.full((n + 1, m), -1, np.int32)
        best[0] = 0.0
        for i in range(n):
            h = codes[i]
            k = self._lookup(h)
            c = best[i] + np.where(k >= 0, self.piece_score[k], self.unknown_score)
            self._relax(best, second, back, last, i, i + 1, slice(None), k, c, second[i] + (c - best[i]))
            # Longer pieces: only where some piece begins with the characters so far.
            r = np.flatnonzero(self.begun[self._begins(h)])
            h = h[r]
            for j in range(i + 2, min(n, i + self.longest) + 1):
                h = h * _BASE + codes[j - 1, r]
                on = np.flatnonzero(self.begun[self._begins(h)])
                if not len(on):
                    break
                r, h = r[on], h[on]
                k = self._lookup(h)
                hit = np.flatnonzero(k >= 0)
                if len(hit):
                    q, k = r[hit], k[hit]
                    w = self.piece_score[k]
                    self._relax(best, second, back, last, i, j, q, k, best[i, q] + w, second[i, q] + w)
        ids, count, place = np.zeros((m, n), np.int32), np.zeros(m, np.int64), np.full(m, n)
        plain, row = np.ones(m, bool), np.arange(m)
        while len(row):
            count[row] += 1
            k = last[place[row], row]
            plain[row] &= k >= 0
            ids[row, n - count[row]] = self.piece_id[k]
            place[row] = back[place[row], row]
            row = row[place[row] > 0]
        flat = ids[(np.arange(n) >= (n - count)[:, None]) & plain[:, None]]
        return ~plain, best[n, plain], (best[n] - second[n])[plain], count[plain], flat

    @staticmethod
    def _relax(best, second, back, last, i: int, j: int, r, k, c, c2) -> None:
        """Offer the scores ``c`` (best) and ``c2`` (second best) of paths that come to ``j`` by pieces ``k`` from ``i``."""
        old = best[j, r]
        better = c > old
        second[j, r] = np.where(better, np.maximum(old, c2), np.maximum(second[j, r], c))
        best[j, r] = np.where(better, c, old)
        back[j, r] = np.where(better, i, back[j, r])
        last[j, r] = np.where(better, k, last[j, r])

    def prepare(self, texts: list[str | None]) -> list[tuple[SolvedCuts, np.ndarray] | None]:
        """Per text, its cuts as numbers of a table of solved cuts."""
        if self.cache.full():
            old, self.cache = self.cache, self.cache.most_used()
            old.number.clear()  # the caller may still hold the table
        find, number = self.cuts, self.cache.number.__getitem__
        seen = []
        for t in texts:
            own = find(MARK + t.replace(" ", MARK)) if t else ()
            seen.append(np.fromiter(map(number, own), np.int32, len(own)))
        self._solve_new()
        self.cache.used(seen)
        return [(self.cache, at) if len(at) else None for at in seen]

    def best_paths(self, cut: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best paths, (score, identifiers) in falling order of score: A* from the end backwards.

        The n best paths need no more than n expansions of a position. Of equal estimates the
        one nearest to the start goes first, so paths that tie are finished one after the other."""
        ahead, _, _ = self.forward(cut)
        agenda, made, out = [(-ahead[-1], len(cut), 0, 0.0, ())], 0, []
        expanded = [0] * (len(cut) + 1)
        while agenda and len(out) < n:
            _, j, _, behind, path = heapq.heappop(agenda)
            if j == 0:
                pieces = []
                while path:
                    piece, path = path
                    pieces += self.ids_of(piece)
                out.append((behind, pieces))
                continue
            if expanded[j] == n:
                continue
            expanded[j] += 1
            for i in range(j - 1, max(-1, j - self.longest - 1), -1):
                w = self.edge(cut, i, j)
                if w is not None:
                    made += 1
                    heapq.heappush(agenda, (-(ahead[i] + w + behind), i, made, w + behind, (cut[i:j], path)))
        return out

    # -- whole texts -------------------------------------------------------

    def encode(self, text: str | None, n: int, cuts: tuple[SolvedCuts, np.ndarray] | None = None) -> tuple[bytes, float, list[dict]]:
        """(identifiers of the best segmentation as int32 bytes, its score, up to n - 1 alternatives).

        An alternative has its score and the edits that make it from the best:
        at piece ``at`` drop ``drop`` pieces and put ``put`` there instead.
        """
        if not text:
            return b"", 0.0, []
        solved, at = cuts if cuts is not None else self.prepare([text])[0]
        counts, gaps = solved.count[at], solved.gap[at]
        ends = np.cumsum(counts)
        begins = ends - counts
        pieces = solved.pieces_of(at).tobytes()
        score = float(solved.score[at].sum())
        if n < 2:
            return pieces, score, []
        if len(gaps) >= n:
            within = np.flatnonzero(gaps <= np.partition(gaps, n - 2)[n - 2])
            near = sorted(within[np.argsort(gaps[within], kind="stable")[: n - 1]].tolist())
        else:
            near = range(len(gaps))
        combos = [(0.0, ())]
        for k in near:
            others = self.other_paths(solved, at[k], n)
            grown = combos + [(d + loss, (*c, (k, put))) for d, c in combos for loss, put in others]
            combos = heapq.nsmallest(n, grown, key=lambda x: x[0])
        alternatives = []
        for loss, changes in combos[1:]:
            edits = [{"at": int(begins[k]), "drop": int(counts[k]), "put": put} for k, put in changes]
            alternatives.append({"score": score - loss, "edits": edits})
        return pieces, score, alternatives

    def other_paths(self, solved: SolvedCuts, k: int, n: int) -> list[tuple[float, list[int]]]:
        """(loss against the best, identifiers) of the n - 1 best paths of cut ``k`` besides the best one."""
        cut = solved.names[k]
        hit = self.others.get((cut, n))
        if hit is None:
            score, best = float(solved.score[k]), solved.pieces_of(np.array([k])).tolist()
            hit = [(score - s, path) for s, path in self.best_paths(cut, n) if path != best][: n - 1]
            if len(cut) <= LONGEST_CACHED:
                if len(self.others) >= CACHED_OTHERS:
                    self.others.clear()
                self.others[cut, n] = hit
        return hit

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")[1:]


def slices(batch: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a batch in lists of about ``BATCH_CHARS`` characters."""
    texts, size = [], 0
    for t in batch:
        texts.append(t.as_py())
        size += len(texts[-1] or "")
        if size >= BATCH_CHARS:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


def load(model: str = MODEL) -> PieceLattice:
    return PieceLattice(model)


def encode(df: DataFrame, lattice: PieceLattice, text: str = "text", n: int = N_BEST) -> DataFrame:
    """``df`` with ``pieces`` (best segmentation), ``piece_score`` and ``alternatives``."""
    shared = df.sparkSession.sparkContext.broadcast(lattice)

    @arrow_udf(ENCODED)
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for batch in batches:
            for texts in slices(batch):
                flat, scores, others = zip(*[own.encode(t, n, cuts) for t, cuts in zip(texts, own.prepare(texts))])
                sizes = [0, *(len(pieces) // 4 for pieces in flat)]
                values = pa.array(np.frombuffer(b"".join(flat), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), values)
                yield pa.StructArray.from_arrays(
                    [lists, pa.array(scores, pa.float64()), pa.array(others, _ARROW_ALTERNATIVES)], ["pieces", "score", "alternatives"]
                )

    name = free_name(df, "_encoded")
    made = df.withColumn(name, encoded(F.col(text)))
    return made.withColumns(
        {"pieces": F.col(f"{name}.pieces"), "piece_score": F.col(f"{name}.score"), "alternatives": F.col(f"{name}.alternatives")}
    ).drop(name)


def decode(df: DataFrame, lattice: PieceLattice, pieces: str = "pieces", out: str = "decoded") -> DataFrame:
    """``df`` with the text of a piece list (null: empty text)."""
    shared = df.sparkSession.sparkContext.broadcast(lattice)

    @arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for batch in batches:
            yield pa.array([own.decode(ids.values.to_numpy().tolist()) if ids.is_valid else "" for ids in batch], pa.string())

    return df.withColumn(out, decoded(F.col(pieces)))


def segmentation(best: Column, alternative: Column) -> Column:
    """The piece list of an alternative: the best one with its edits made (edits are in order and don't overlap)."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("done"))

    def step(state: Column, edit: Column) -> Column:
        kept = F.slice(best, state["at"] + 1, edit["at"] - state["at"])
        return F.struct((edit["at"] + edit["drop"]).alias("at"), F.concat(state["done"], kept, edit["put"]).alias("done"))

    return F.aggregate(
        alternative["edits"], start, step, lambda state: F.concat(state["done"], F.slice(best, state["at"] + 1, F.size(best)))
    )

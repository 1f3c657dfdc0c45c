"""Personal data by bootstrapped contextual extraction.

1. Seeds: e-mail addresses, IP addresses, card and phone numbers that fixed patterns and
   their checks find in every whole text. These spans always stay.
2. Candidates: other tokens that look like identifiers (a word of ``LEAST_CHARS`` or more code points
   with a digit or an @, or a run of digit groups with ``LEAST_DIGITS`` digits), outside the seeds.
3. Every occurrence of a seed or a candidate induces lexical patterns: the two words before it, the
   three words before it, and the word on either side (lower case, digits as 0, without
   punctuation at the ends). Distinct (pattern, instance) pairs are the edges of a graph; an
   instance is a normalised text.
4. Spark scores the graph in rounds. Per kind, a pattern's confidence is the weight of the trusted
   instances it extracts over the number of all it extracts plus one; a pattern counts from
   ``MIN_SUPPORT`` different trusted instances and ``MIN_CONFIDENCE`` on. A candidate's score is the chance that one
   of its counting patterns is right, 1 - prod(1 - confidence); from ``MIN_SCORE`` on it is trusted in the next
   round, so that it can vouch for patterns of its own.
5. All occurrences of the trusted candidates are spans of the kind with the highest score.

The texts are read once; edges are made distinct in the tasks before the shuffle, and copies
of a text count once. Patterns and instances travel as 64-bit hashes. A pattern or instance
may hold any share of the edges: sums are partial before the shuffle, and the joins are with
the (few) counting patterns or trusted candidates, broadcast when a check of their size allows it and
salted beyond it.

Defined results: a null or empty text has no spans; the base patterns take time linear in the text, whatever
it holds; positions are code points, end exclusive; base spans of
different kinds may overlap, added ones overlap no other span; repeated rows get equal results; kinds
of equal score: the one listed first; an empty table gives no rows. ``find_spans`` returns the named columns and
``spans`` (a column of that name among them is an error).
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import shared_table
from contrail.operators.joins import fits_broadcast, salted_join

KINDS = ("email", "ip", "card", "phone")
LEAST_CHARS = 5
LEAST_DIGITS = 6
WINDOW = 96  # code points on either side in which context words are looked for
ROUNDS = 4
MIN_SUPPORT = 5
MIN_CONFIDENCE = 0.7
MIN_SCORE = 0.7
EDGES_HELD = 200_000  # distinct edges a task holds before it hands them on
HOT_SALTS = 16
SPANS = "array<struct<kind:string,start:int,end:int,value:string,added:boolean>>"

# The patterns of the four kinds. Written so that a failed attempt is not tried again
# from the inside of the same run: an address is found from its @, an IP address starts a run of digits.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

GAP = re.compile(r"[\x20\x09-\x0D]")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
MARK = re.compile(r"[0-9@]")
GROUPS = re.compile(r"[(]?[0-9][0-9().-]*(?:\x20[0-9().-]+)*")
ONLY_GROUPS = re.compile(r"[(]?[0-9][0-9().-]*[.,;:!?]?")
ENDS = ".,;:!?\"'()[]{}<>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each @ backwards."""
    floor = 0  # end of the last address
    at = text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at)
        if m is None:
            at = text.find("@", at + 1)
            continue
        start = at
        while start > floor and not NOT_LOCAL.match(text[start - 1]):
            start -= 1
        if start < at:
            yield start, m.end()
            floor = m.end()
            at = text.find("@", floor)
        else:
            at = text.find("@", at + 1)


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of all seeds, by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and passes_luhn(digits):
                out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((3, *m.span()))
    return out


def candidates(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Identifier-like tokens outside ``taken`` (sorted spans)."""
    starts = [a for a, _ in taken]
    floor = 0  # nothing before it is looked at again
    m = MARK.search(text)
    while m is not None:
        hit = m.start()
        # The last span that starts at or before the hit may hold it.
        k = bisect.bisect_right(starts, hit) - 1
        inside = max((b for _, b in taken[max(0, k - 3) : k + 1] if b > hit), default=0)
        if inside:
            floor = inside
            m = MARK.search(text, floor)
            continue
        begin = max([floor, *(text.rfind(c, floor, hit) + 1 for c in "\x20\n\t\r\x0b\x0c")])
        gap = GAP.search(text, hit)
        end = gap.start() if gap else len(text)
        if ONLY_GROUPS.fullmatch(text, begin, end):
            end = max(end, GROUPS.match(text, begin).end())
        nearest = bisect.bisect_left(starts, hit)
        if nearest < len(starts):
            end = min(end, starts[nearest])
        floor = max(end, hit + 1)
        a, b = begin, end
        while a < b and text[a] in ENDS:
            a += 1
        while a < b and (text[b - 1] in ENDS or text[b - 1] in "\x20-"):
            b -= 1
        token = text[a:b]
        if GAP.search(token):
            good = len(NOT_DIGIT.sub("", token)) >= LEAST_DIGITS
        else:
            good = b - a >= LEAST_CHARS and MARK.search(token) is not None
        if good:
            yield a, b
        m = MARK.search(text, floor)


def hash64(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def plain(word: str) -> str:
    """A context word: lower case, digits as 0, no punctuation at its ends."""
    return re.sub("[0-9]", "0", word.lower()).strip(ENDS)


def patterns(text: str, start: int, end: int) -> list[int]:
    """Hashes of the lexical patterns around a span."""
    before = ["^", "^", "^", *map(plain, WORDS.findall(text, max(0, start - WINDOW), start))]
    after = WORDS.search(text, end, min(len(text), end + WINDOW))
    right = plain(after[0]) if after else "$"
    return [hash64("L2", *before[-2:]), hash64("L3", *before[-3:]), hash64("B1", before[-1], right)]


def instance(text: str, kind: int, start: int, end: int) -> int:
    """Hash of a normalised instance: seeds by kind and, for numbers, their digits alone."""
    value = text[start:end].lower()
    return hash64(str(kind), NOT_DIGIT.sub("", value) if kind in (2, 3) else value)


SEEN = pa.schema(
    [
        ("base", pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))),
        ("found", pa.list_(pa.struct([("inst", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))),
        ("edges", pa.list_(pa.struct([("pat", pa.int64()), ("inst", pa.int64()), ("kind", pa.int32())]))),
    ]
)
SEEN_SQL = (
    "base array<struct<kind:int,start:int,end:int,value:string>>, found array<struct<inst:bigint,start:int,end:int,value:string>>, "
    "edges array<struct<pat:bigint,inst:bigint,kind:int>>"
)


def look(text: str, known: set) -> dict:
    """Base spans and candidates of a text, and the edges that are not yet in ``known`` (kind -1: a candidate)."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    found, edges = [], []

    def link(a: int, b: int, inst: int, kind: int) -> None:
        for p in patterns(text, a, b):
            if (p, inst) not in known:
                known.add((p, inst))
                edges.append({"pat": p, "inst": inst, "kind": kind})

    for kind, a, b in base:
        link(a, b, instance(text, kind, a, b), kind)
    for a, b in candidates(text, taken):
        inst = instance(text, -1, a, b)
        found.append({"inst": inst, "start": a, "end": b, "value": text[a:b]})
        link(a, b, inst, -1)
    return {"base": [{"kind": k, "start": a, "end": b, "value": text[a:b]} for k, a, b in base], "found": found, "edges": edges}


NOTHING = {"base": [], "found": [], "edges": []}


def read_texts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    known: set = set()
    for batch in batches:
        seen = []
        for t in batch[text]:
            t = t.as_py()
            seen.append(look(t, known) if t and MARK.search(t) else NOTHING)
            if len(known) > EDGES_HELD:
                known.clear()
        kept = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != text]
        names = [f.name for f in batch.schema if f.name != text]
        new = pa.Table.from_pylist(seen, schema=SEEN).combine_chunks()
        yield pa.RecordBatch.from_arrays([*kept, *(new[c].combine_chunks() for c in SEEN.names)], names=[*names, *SEEN.names])


def joined(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner join on ``on``, unique in ``right``: broadcast when proven small, salted beyond."""
    if fits_broadcast(right):
        return left.join(F.broadcast(right), on)
    other = right.withColumnRenamed(on, "_on")
    return salted_join(left, other, [on], ["_on"], "inner", HOT_SALTS).drop("_on")


def trusted_candidates(
    edges: DataFrame,
    rounds: int = ROUNDS,
    min_support: int = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """(inst, kind, score) of the candidates that the pattern-instance graph vouches for.

    ``edges``: distinct (pat, inst, kind), kind -1 for candidates.
    """
    kinds = range(len(KINDS))
    open_edges = edges.filter("kind < 0").select("pat", "inst")
    # What doesn't change from round to round: all extractions and the seeds of each kind, one row a pattern.
    fixed = edges.groupBy("pat").agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col("kind") == k, 1)).cast("double").alias(f"s{k}") for k in kinds]
    )
    fixed = shared_table(fixed.withColumn("seeds", F.expr("+".join(f"s{k}" for k in kinds))), "pii-patterns")
    trusted, size = None, 0
    for _ in range(rounds):
        support = fixed.select("pat", "n", "seeds", *[f"s{k}" for k in kinds], *[F.col(f"s{k}").alias(f"c{k}") for k in kinds])
        if trusted is not None and size:
            more = joined(open_edges, trusted, "inst").groupBy("pat").agg(
                *[F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(f"m{k}") for k in kinds],
                *[F.count(F.when(F.col("kind") == k, 1)).cast("double").alias(f"d{k}") for k in kinds],
            )
            zero = F.lit(0.0)
            support = fixed.join(more, "pat", "left").select(
                "pat", "n", "seeds",
                *[(F.col(f"s{k}") + F.coalesce(f"m{k}", zero)).alias(f"s{k}") for k in kinds],
                *[(F.col(f"s{k}") + F.coalesce(f"d{k}", zero)).alias(f"c{k}") for k in kinds],
            )
        best = F.greatest(*[F.struct(F.col(f"s{k}").alias("s"), F.lit(-k).alias("order"), F.col(f"c{k}").alias("c")) for k in kinds])
        counting = (
            support.withColumn("best", best)
            .select("pat", (-F.col("best.order")).alias("kind"), (F.col("best.s") / (F.col("n") + 1)).alias("confidence"), "best.c")
            .filter((F.col("c") >= min_support) & (F.col("confidence") >= min_confidence))
            .drop("c")
        )
        counting = shared_table(counting, "pii-counting")
        scored = joined(open_edges, counting, "pat").groupBy("inst", "kind").agg(
            (1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score")
        )
        top = scored.filter(F.col("score") >= min_score).groupBy("inst").agg(
            F.max(F.struct("score", (-F.col("kind")).alias("order"))).alias("top")
        )
        trusted = shared_table(top.select("inst", (-F.col("top.order")).alias("kind"), F.col("top.score").alias("score")), "pii-trusted")
        before, size = size, trusted.count()
        if size == before:
            break
    return trusted


def find_spans(df: DataFrame, text: str = "text", columns: tuple[str, ...] = ("doc_id",), **options) -> DataFrame:
    """``columns`` of every row with ``spans``: all spans by kind as listed, then start."""
    if "spans" in columns:
        raise ValueError("the column spans is made here")
    row = F.struct(*[F.col(c) for c in columns]) if columns else F.struct(F.lit(0).alias("none"))
    narrow = df.select(row.alias("row"), F.col(text).alias("text"))
    read = narrow.mapInArrow(lambda it: read_texts(it, "text"), f"row {narrow.schema['row'].dataType.simpleString()}, {SEEN_SQL}")
    seen = shared_table(read.withColumn("uid", F.monotonically_increasing_id()), "pii-seen")
    edges = shared_table(seen.select(F.explode("edges").alias("e")).select("e.*").distinct(), "pii-edges")
    trusted = trusted_candidates(edges, **options)
    occurrences = seen.select("uid", F.explode("found").alias("f")).select("uid", "f.*")
    hits = joined(occurrences, trusted, "inst").groupBy("uid").agg(  # at most one text's candidates
        F.collect_list(F.struct(F.col("kind"), "start", "end", "value", F.lit(True).alias("added"))).alias("more")
    )
    own = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.lit(False).alias("added")))
    out = seen.select("uid", "row", own.alias("own")).join(hits, "uid", "left")
    every = F.array_sort(F.concat("own", F.coalesce("more", F.array().cast("array<struct<kind:int,start:int,end:int,value:string,added:boolean>>"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    named = F.transform(
        every,
        lambda s: F.struct(
            F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), s["added"].alias("added")
        ),
    )
    return out.select(*([F.col(f"row.{c}").alias(c) for c in columns]), named.alias("spans"))


def count_of(spans: Column, kind: str) -> Column:
    """Number of the spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_list(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span's place taken by [kind] (spans that overlap an earlier one are joined to it)."""
    by_place = F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(state: Column, s: Column) -> Column:
        kept = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        mark = F.when(s["start"] >= state["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise(F.lit(""))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["done"], kept, mark).alias("done"))

    return F.aggregate(by_place, start, step, lambda s: F.concat(s["done"], F.substring(text, s["at"] + 1, F.length(text))))

"""Hard negatives, whitening and personal data against brute force and small cases."""

import hashlib
import math
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm import (
    hard_negatives,
    jaccard_join,
    language_id,
    license_scan,
    pii_bootstrap,
    quality_rules,
    queries,
    rendezvous,
    sentencepiece_nbest,
    source_mix,
    toxicity,
    whitening,
)
from contrail.llm.common import running_offset

SF, SF_MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# -- hard negatives ------------------------------------------------------------


def usable(records):
    out = set()
    for i, v, y in records:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        out.add((i, (y + 1) % 10 if i % 7 == 0 else y, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    return sorted(out)


def mined_by_hand(records):
    taking, out = usable(records), set()
    for i, y, x in taking:
        if i % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, z)), j, w) for j, w, z in taking if j != i and len(z) == len(x))
        for p, j, w in [s for s in scored if s[2] == y][:5]:
            fit = [(n, m) for n, m, v in scored if v != y and 50 * -p <= 100 * -n <= 95 * -p][:3]
            out |= {(i, j, r + 1, m, -p, -n) for r, (n, m) in enumerate(fit)}
    return out


def mined(df, **options):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(df, F.col("id") % 50 == 0, label=label, **options).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def test_hard_negatives_equal_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    records = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    want = mined_by_hand(records)
    assert len(want) > 100 and mined(df) == want == {tuple(r) for r in queries.op11_hard_negatives(spark, SF).collect()}
    assert mined(df.withColumns({c: F.lit(1) for c in ("id", "key", "x", "dim", "grp", "rank", "nth", "tile")}), group_rows=7) == want


def test_hard_negatives_ties_copies_and_odd_rows(spark):
    r = np.random.default_rng(5)
    base = r.integers(-2, 3, (9, 3)) / 8.0  # few different vectors: ties everywhere
    records = [(i, [float(x) for x in base[r.integers(0, 9)]], int(r.integers(0, 3))) for i in range(400)]
    records += [(i, [0.25, 0.25, 0.25], 1) for i in range(1000, 1300)]  # one vector, a third of all rows
    records += records[:40]  # repeated rows
    records += [(2000, None, 1), (2050, [None, 1.0, 0.0], 1), (2100, [NAN, 0.0, 0.0], 1), (2150, [INF, 0.0, 0.0], 2),
                (2200, [0.1, 0.1, 0.1], None), (None, [0.1, 0.1, 0.1], 1), (2250, [], 1), (2251, [], 1), (2252, [], 2),
                (2300, [0.5, 0.5], 1), (2301, [0.5, 0.25], 1), (2303, [0.25, 0.25], 2), (-50, [0.25, 0.0, 0.125], 0)]
    df = spark.createDataFrame(records, VECTORS)
    want = mined_by_hand(records)
    assert mined(df) == want and mined(df, group_rows=5) == want and any(a == 2300 for a, *_ in want) and any(a == 2250 for a, *_ in want)
    assert mined(df.limit(0)) == set()
    assert mined(df.filter("vec_id = 100")) == set()


def test_hard_negatives_large_components(spark):
    records = [(i, [float(v), float(-v), 3.0], i % 3) for i, v in zip(range(0, 200), range(-100_000, 100_000, 1000))]
    assert mined(spark.createDataFrame(records, VECTORS)) == mined_by_hand(records)
    with pytest.raises(Exception, match="too large"):
        mined(spark.createDataFrame([(50, [1e30], 1)], VECTORS))


def test_tree_bounds_hold_and_prune():
    r = np.random.default_rng(3)
    centres = r.normal(size=(20, 6)) * 400
    x = np.floor(np.repeat(centres, 200, axis=0) + r.normal(size=(4000, 6)) * 10)
    tree = hard_negatives.RTree(np.arange(4000), np.repeat(np.arange(20) % 4, 200), x, page=16, fanout=4)
    assert sorted(tree.ids.tolist()) == list(range(4000)) and len(tree.levels) > 3
    q = x[:5]
    for level, (low, high) in zip(tree.levels, tree.bounds(q)):
        assert (low <= high).all()
    leaves = tree.levels[0]
    scores = q @ tree.x.T
    low, high = tree.bounds(q)[0]
    for b, (s, e) in enumerate(zip(leaves.start, leaves.end)):
        assert (scores[:, s:e] >= low[:, [b]]).all() and (scores[:, s:e] <= high[:, [b]]).all()
    opened = []

    class Watched(np.ndarray):
        def __getitem__(self, item):
            if isinstance(item, slice):
                opened.append(item)
            return np.asarray(super().__getitem__(item))

    tree.x = tree.x.view(Watched)
    found = tree.search(q[0], 0, 0, True, [(-(1 << 60), 1 << 60)], 5, [(lo[0], hi[0]) for lo, hi in tree.bounds(q)])
    want = sorted((-int(s), int(i)) for s, i, y in zip(scores[0], tree.ids, tree.labels) if y == 0 and i != 0)[:5]
    assert found == [[(-s, i) for s, i in want]]
    assert len(opened) < len(leaves.start) / 4


# -- whitening --------------------------------------------------------------


def check_whitening(records, got, k=32, offset=1_000_000):
    fit = [(i, [math.floor(64 * float(np.float32(c))) + offset for c in v]) for i, v in records]
    x = np.array([v for _, v in fit], np.float64)
    n, d = x.shape
    a = x - x.mean(axis=0)
    _, sv, vt = np.linalg.svd(a, full_matrices=False)  # more exact than the covariance's eigenvalues
    e, v = sv**2 / n, vt.T
    rank = int((sv > 1e-11 * sv[0]).sum())
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
    assert len(got) == n * min(k, rank)
    sums = [sum(col) for col in zip(*[v for _, v in fit])]
    signs = None
    for i, own in fit:
        rs = sorted(by_id[i], key=lambda r: r["component"])
        assert [r["component"] for r in rs] == list(range(1, min(k, rank) + 1))
        assert {r["deviation"] for r in rs} == {sum((n * y - s) ** 2 for y, s in zip(own, sums))} and {r["n"] for r in rs} == {n}
        w = (np.array(own) - x.mean(axis=0)) @ v[:, : len(rs)] / np.sqrt(e[: len(rs)])
        mine = np.array([r["whitened"] for r in rs])
        signs = np.sign(w * mine) if signs is None else np.where(np.abs(w) < 1e-6, signs, signs)
        assert np.allclose(np.abs(mine), np.abs(w), atol=1e-6)
        assert np.allclose([r["explained"] for r in rs], e[: len(rs)] / e.sum(), rtol=1e-6)
        assert all(r["identity_error"] < 1e-8 for r in rs)


def test_whitening_equals_eigenvectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = rows(queries.op12_whitening(spark, SF))
    check_whitening([(r["vec_id"], r["embedding"]) for r in rows(df)], got)


def whitened(df):
    out, model = whitening.whiten(df)
    one = rows(out.select("vec_id", "deviation", F.posexplode("whitened").alias("component", "whitened")))
    return [r | {"component": r["component"] + 1, "n": model.n, "explained": float(model.explained[r["component"]]),
                 "identity_error": model.identity_error} for r in one], model


def test_whitening_of_ill_conditioned_and_dependent_dimensions(spark):
    r = np.random.default_rng(7)
    a = r.normal(size=(300, 6)) * [4000, 700, 90, 8, 1, 0.2]
    a = np.floor(a * 64) / 64
    tall = np.hstack([a, a[:, :1] * 2, np.full((300, 1), 3.0)])  # a dependent and a constant dimension
    records = [(i, [float(c) for c in v]) for i, v in enumerate(tall)]
    got, model = whitened(spark.createDataFrame(records, "vec_id long, embedding array<float>"))
    check_whitening(records, got)
    assert model.passes <= whitening.MOST_PASSES and len(model.eigenvalues) == 6
    assert np.allclose(model.components.T @ model.components, np.eye(len(model.eigenvalues)), atol=1e-10)


def test_whitening_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, whitened string, x int, row int"
    good = [(i, [i * 0.5, (i % 5) * 1.0, -i * 1.0], "w", 1, 2) for i in range(40)]
    odd = [(100, None, "w", 1, 2), (101, [None, 1.0, 2.0], "w", 1, 2), (102, [NAN, 1.0, 2.0], "w", 1, 2), (103, [1.0, INF, 2.0], "w", 1, 2),
           (104, [], "w", 1, 2), (105, [1.0], "w", 1, 2), (None, [1.0, 1.0, 1.0], "w", 1, 2)]
    df = spark.createDataFrame(good + good[:3] + odd, schema)
    out, model = whitening.whiten(df)
    assert model.n == 44 and out.count() == 44 and out.columns == ["vec_id", "embedding", "x", "row", "deviation", "whitened"]
    assert len(model.eigenvalues) <= 3 and model.identity_error < 1e-9
    assert out.filter("vec_id is null").count() == 1 and out.filter("vec_id = 0").distinct().count() == 1
    for few in (df.limit(0), df.filter("vec_id = 1 and embedding is not null").limit(1), df.filter("vec_id = 100"), df.filter("vec_id = 104")):
        empty, model = whitening.whiten(few)
        assert len(model.eigenvalues) == 0 and all(r["whitened"] == [] for r in rows(empty))
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<float>"))


def test_deviation_beyond_a_long_is_null_and_else_exact(spark):
    model = whitening.WhiteningModel(3, np.array([0, 3], np.int64), np.empty((2, 0)), np.empty(0), np.empty(0), 0.0, 0, False)
    assert model.deviation(np.array([[1 << 40, 1], [5, 0]])).to_pylist() == [None, 234]


def test_triangular_solve_and_shifted_factor():
    r = np.random.default_rng(1)
    u = np.triu(r.normal(size=(70, 70))) + 9 * np.eye(70)
    a = r.normal(size=(20, 70))
    assert np.allclose(whitening.solve_right(a, u) @ u, a)
    flat = np.ones((5, 5))
    f = whitening.shifted_cholesky(flat, 100)
    assert np.allclose(f.T @ f, flat, atol=1e-3 * 5) and np.allclose(f, np.triu(f))


# -- segmentation of runs of equal characters ---------------------------------------


def n_best_by_table(lattice, cut, n):
    """Scores of the n best paths by the plain dynamic programme (n best at every position)."""
    best = [[] for _ in range(len(cut) + 1)]
    best[0] = [0.0]
    for j in range(1, len(cut) + 1):
        found = []
        for i in range(max(0, j - lattice.longest), j):
            w = lattice.edge(cut, i, j)
            if w is not None:
                found += [s + w for s in best[i]]
        best[j] = sorted(found, reverse=True)[:n]
    return best[-1]


@pytest.fixture(scope="module")
def lattice():
    return sentencepiece_nbest.load()


def test_runs_of_equal_characters_end_soon_and_are_the_n_best(lattice):
    for c in (sentencepiece_nbest.MARK, "-", "#", "=", "a", "é"):
        for length in (255, 511, 4_000):
            began = time.time()
            paths = lattice.best_paths(c * length, 4)
            assert time.time() - began < 8, (c, length)
            assert [s for s, _ in paths] == pytest.approx(n_best_by_table(lattice, c * length, 4))
            assert len({tuple(p) for _, p in paths}) == len(paths)
    for text in ("a" + 400 * " " + "b", "#" * 1000, "| " + "-" * 300 + " |", "x" * 200_000):
        began = time.time()
        pieces, _, others = lattice.encode(text, 4)
        assert time.time() - began < 20 and lattice.decode(np.frombuffer(pieces, np.int32).tolist()) == text and others


def test_batched_search_equals_the_search_of_one_cut(lattice):
    r = np.random.default_rng(4)
    cuts = ["".join(r.choice(list("abcdeéthing_-#1▁"), r.integers(1, 40))) for _ in range(400)] + ["▁the", "▁😀x"]
    lattice.solve_many(cuts)
    for c in cuts:
        one, many = lattice.solve(c), lattice.cache[c]
        assert many[1:] == pytest.approx(one[1:]) and len(n_best_by_table(lattice, c, 2)) >= 1
        assert many[1] == pytest.approx(n_best_by_table(lattice, c, 1)[0])


# -- drawn counts and repeated rows --------------------------------------------------


def mix_by_hand(spark, sized, block, shard_slots, seed):
    """Words taken of each (source, key) and the slots of each (shard, ord), slot by slot in Python."""
    targets = rows(source_mix.source_targets(sized))
    totals = {r["ord"]: r for r in rows(source_mix.slot_totals(source_mix.source_targets(sized), block))}
    slots = rows(source_mix.draw_slots(source_mix.slot_totals(source_mix.source_targets(sized), block), shard_slots, seed))
    n = sum(r["total"] for r in totals.values())
    assert sorted(s["shard"] * shard_slots + s["place"] for s in slots) == list(range(n))  # every place is taken once
    for o, r in totals.items():  # passes are whole, each block once, before the next begins
        own = sorted((s["repeat"], s["block"]) for s in slots if s["ord"] == o)
        full, rest = divmod(r["total"], r["blocks"])
        assert len(own) == len(set(own)) == r["total"]
        assert [sum(k == p for k, _ in own) for p in range(full)] == [r["blocks"]] * full and sum(k == full for k, _ in own) == rest
    return targets, totals, slots


def test_counts_per_shard_are_drawn(spark):
    sized = spark.createDataFrame([("a", 1, 128 * 300), ("b", 2, 128 * 500), ("c", 3, 128 * 700)], "source string, doc_id long, size long")
    tables = []
    for seed in range(30):
        found = rows(source_mix.draw_counts(source_mix.source_targets(sized), 128, 250, seed))
        tables.append({(r["shard"], r["ord"]): r["count"] for r in found})
    _, totals, _ = mix_by_hand(spark, sized, 128, 250, 0)
    n = sum(r["total"] for r in totals.values())
    chi = []
    for t in tables:
        for o, r in totals.items():
            assert sum(c for (_, k), c in t.items() if k == o) == r["total"]  # totals are exact
        shards = {s for s, _ in t}
        assert all(sum(c for (k, _), c in t.items() if k == s) == 250 for s in shards if s < n // 250)
        expected = {(s, o): 250 * totals[o]["total"] / n for s in range(n // 250) for o in totals}
        chi.append(sum((t.get(k, 0) - e) ** 2 / e for k, e in expected.items()))
    degrees = (n // 250) * (len(totals) - 1) * (1 - 250 / n)  # without replacement: a little less than the multinomial
    assert 0.7 * degrees < np.mean(chi) < 1.3 * degrees, (np.mean(chi), degrees)
    assert len({tuple(sorted(t.items())) for t in tables}) == 30


def test_taken_words_equal_a_mix_by_hand(spark):
    text = lambda n: " ".join("w" * (1 + i % 3) for i in range(n))
    docs = [(i, text((i * 37) % 90), ("s", "t", None)[i % 3]) for i in range(60)] + [(60, None, "s"), (61, "", "t")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in rows(source_mix.taken_words(df, block_words=16, shard_slots=20, seed=3))}
    sized = spark.createDataFrame([(s, i, len((t or "").split())) for i, t, s in docs], "source string, doc_id long, size long")
    targets, _, slots = mix_by_hand(spark, sized, 16, 20, 3)
    ords = {r["source"]: r["ord"] for r in targets}
    keyed = sized.join(source_mix.source_targets(sized).select(F.col("source").alias("s"), "ord"), F.col("source").eqNullSafe(F.col("s")))
    start = {r["doc_id"]: r["at"] for r in rows(running_offset(keyed.select("ord", "doc_id", "size"), ["ord"], ["doc_id"], "size", "at"))}
    for i, t, s in docs:
        size = len((t or "").split())
        taken, shards = 0, []
        for x in slots:
            if x["ord"] == ords[s]:
                words = max(0, min(start[i] + size, 16 * (x["block"] + 1)) - max(start[i], 16 * x["block"]))
                taken += words
                shards += [x["shard"]] if words else []
        assert (got[i]["taken"], got[i]["first_shard"]) == (taken, min(shards, default=None))


def test_many_equal_rows_unfold_in_parts(spark, monkeypatch):
    from contrail.llm import common

    monkeypatch.setattr(common, "COPIES", 10)
    df = spark.createDataFrame([("g", 1, 2)] * 57 + [("g", 2, 3), ("h", 1, 1)], "g string, k int, w int")
    out = rows(running_offset(df, ["g"], ["k"], "w"))
    own = sorted(r["offset"] for r in out if r["g"] == "g" and r["k"] == 1)
    first = own[0]
    assert len(out) == 59 and own == [first + 2 * i for i in range(57)] and first in (0, 3)
    assert [r["offset"] for r in out if r["k"] == 2] == [0 if first else 114] and [r["offset"] for r in out if r["g"] == "h"] == [0]


# -- columns of the input named as helpers or outputs ----------------------------------

CLASHES = (
    "_words _size _nth _key _runs _src _sz _k _h _id _md5 _keep _same _found _predicted _encoded _lines _doc toxic row own_id own_key id key "
    "size ord start taken target node links class_id n digest spans score lang_pred pieces piece_score alternatives n_words kept base_failed "
    "licenses license_sentences new_text own_text block shard slot"
).split()


def test_no_stage_or_operator_crashes_on_clashing_columns(spark, odd):
    plain = odd.filter("doc_id is not null")
    crowded = plain.select("*", *[F.concat(F.lit(c), F.col("source")).alias(c) for c in CLASHES])
    for same, outputs in (
        (lambda df: jaccard_join.first_of_each_class(df), ()),
        (lambda df: source_mix.mixed_documents(df), ()),
        (lambda df: language_id.identify(df, language_id.train(df)), ("lang_pred", "score")),
        (lambda df: toxicity.score(df, toxicity.train(df, labels)), ("score",)),
        (lambda df: quality_rules.judge(df), ("n_words", "kept", "base_failed")),
        (lambda df: license_scan.scan(df), ("licenses", "license_sentences")),
        (lambda df: sentencepiece_nbest.encode(df, sentencepiece_nbest.load()), ("pieces", "piece_score", "alternatives")),
    ):
        labels = spark.createDataFrame([(1, 1), (6, 0), (9, 1), (8, 0)], "doc_id long, toxic int")
        a, b = same(plain), same(crowded)
        assert set(b.columns) == set(a.columns) | set(CLASHES)
        key = lambda r: str(sorted(r.items(), key=str))
        names = list(a.columns)
        assert sorted((r for r in rows(a.select(*names))), key=key) == sorted((r for r in rows(b.select(*names))), key=key)
        kept = [c for c in CLASHES if c not in outputs]
        assert all(r[c] == (None if r["source"] is None else c + r["source"]) for r in rows(b) for c in kept)
    for f in (jaccard_join.classes, source_mix.taken_words, rendezvous.shard_slots):
        assert f(crowded).count() == f(plain).count()
    assert pii_bootstrap.find_spans(crowded, columns=("doc_id", "_id", "row", "kind") if "kind" in crowded.columns else ("doc_id", "_id", "row")).count() == plain.count()


# -- personal data -------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(x // 10 + x % 10 for x in doubled) % 10 == 0


def base_by_hand(text):
    only = lambda s: re.sub("[^0-9]", "", s)
    tests = [
        ("email", EMAIL, lambda s: True),
        ("ip", IP, lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", CARD, lambda s: 16 <= len(only(s)) <= 19 and luhn(only(s))),
        ("phone", PHONE, lambda s: 8 <= len(only(s)) <= 15),
    ]
    return [(k, *m.span()) for k, r, ok in tests for m in r.finditer(text or "") if ok(m[0])]


def base_of(text):
    return [(pii_bootstrap.KINDS[k], a, b) for k, a, b in pii_bootstrap.base_spans(text or "")]


TRICKY = [
    "a@b.c@d.e x@y.z", "@a.b@c.d", "a@b a@b.c. me@x-.y-", "..@a.b", "é1@x.org ü.a@b.c", "999.1.2.3.4 1.2.3.4.5 0001.002.3.255 256.1.1.1",
    "1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1111-1", "4111 1111 1111 1112 4111111111111111", "4111  1111", "+1 (988) 555-2485.",
    "+1-", "++49 30 1234567", "+1234567", "+12345678", "+1 2 +3 4444444 5", "a" * 50 + "@", "1 2 3 " * 9, "12@3.4.5.6", "+1.2.3.4@5.6 7",
]


def test_base_spans_equal_the_plain_patterns():
    for t in TRICKY:
        assert base_of(t) == base_by_hand(t), t
    r = np.random.default_rng(2)
    for alphabet in ("a.@1- ", "12. -+(", "@a.+4 \n", "é@.19"):
        for _ in range(700):
            t = "".join(r.choice(list(alphabet), r.integers(0, 40)))
            assert base_of(t) == base_by_hand(t), t


def test_base_spans_of_long_runs_end_soon():
    began = time.time()
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" * 150_000, "+1" + " " * 300_000, "@" * 300_000, "a.b" * 100_000 + "@x"):
        found = pii_bootstrap.look(t, set())
        assert len(found["base"]) == (37_500 if t.startswith("1.") else 0)
    assert time.time() - began < 30


def test_pii_base_of_the_table(spark):
    got = {r["doc_id"]: r for r in rows(queries.op13_pii(spark, SF_MORE))}
    docs = rows(spark.read.parquet(f"{SF_MORE}/documents.parquet"))
    assert len(got) == len(docs)
    for d in docs:
        want, r = base_by_hand(d["text"]), got[d["doc_id"]]
        assert [r[f"n_{k}"] for k in pii_bootstrap.KINDS] == [sum(w[0] == k for w in want) for k in pii_bootstrap.KINDS]
        joined = ",".join(":".join(map(str, w)) for w in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r["spans"].split(",")) | {""}


def graph_by_hand(texts):
    """The scoring of the module's text, on plain sets: {candidate instance: (kind, score)}."""
    edges = set()
    for t in texts:
        for e in pii_bootstrap.look(t or "", set())["edges"]:
            edges.add((e["pat"], e["inst"], e["kind"]))
    by_pattern, by_instance = {}, {}
    for p, i, k in edges:
        by_pattern.setdefault(p, []).append((i, k))
        if k < 0:
            by_instance.setdefault(i, []).append(p)
    trusted = {}
    for _ in range(pii_bootstrap.ROUNDS):
        confidence = {}
        for p, own in by_pattern.items():
            best = None
            for kind in range(4):
                s = sum(1.0 if k == kind else trusted[i][1] if k < 0 and i in trusted and trusted[i][0] == kind else 0.0 for i, k in own)
                c = sum(k == kind or (k < 0 and i in trusted and trusted[i][0] == kind) for i, k in own)
                best = max(best or (-1, 0, 0), (s, -kind, c))
            if best[2] >= pii_bootstrap.MIN_SUPPORT and best[0] / (len(own) + 1) >= pii_bootstrap.MIN_CONFIDENCE:
                confidence[p] = (-best[1], best[0] / (len(own) + 1))
        new = {}
        for i, around in by_instance.items():
            miss = {}
            for p in around:
                if p in confidence:
                    kind, c = confidence[p]
                    miss[kind] = miss.get(kind, 1.0) * (1 - c)
            for kind in sorted(miss):
                if 1 - miss[kind] >= pii_bootstrap.MIN_SCORE and (i not in new or 1 - miss[kind] > new[i][1]):
                    new[i] = (kind, 1 - miss[kind])
        done, trusted = set(new) == set(trusted), new
        if done:
            break
    return trusted


def planted():
    r = np.random.default_rng(11)
    words = "river mill old summer village boat stone water light road".split()
    prose = lambda n: " ".join(r.choice(words, n))
    texts = []
    for i in range(30):  # contexts that seeds teach
        texts.append(f"{prose(6)} please call me on +49 30 {5550000 + 37 * i} {prose(4)}")
        texts.append(f"{prose(5)} kindly write to user{i}@mail{i}.example.com {prose(4)}")
    texts.append(f"{prose(5)} please call me on 0171-5559{1234} {prose(3)}")  # no seed: no plus sign
    texts.append(f"{prose(3)} kindly write to jane@localhost {prose(3)}")
    for i in range(6):  # the found ones teach a context that no seed has
        texts.append(f"{prose(4)} please call me on 0171-666{1000 + i} {prose(3)}")
        texts.append(f"{prose(4)} mobile number reads 0171-666{1000 + i} {prose(3)}")
    texts.append(f"{prose(4)} mobile number reads 0160-7771234 {prose(2)}")
    texts += [f"{prose(5)} room B{1000 + i} {prose(4)}" for i in range(20)] + [f"licence version 2.0.{i} {prose(3)}" for i in range(9)]
    return texts


def test_patterns_find_unseen_identifiers(spark):
    texts = planted()
    want = graph_by_hand(texts)
    odd = [None, "", " \n ", texts[0], texts[0], "x" * 50_000 + " 12345 " + "9" * 50_000]
    df = spark.createDataFrame(list(enumerate(texts + odd)), "doc_id long, text string").withColumn("kind", F.lit("k")).withColumn("uid", F.lit(1))
    got = {r["doc_id"]: r for r in rows(pii_bootstrap.find_spans(df.repartition(5), columns=("doc_id", "kind", "uid")))}
    assert len(got) == len(texts) + len(odd) and all(r["kind"] == "k" and r["uid"] == 1 for r in got.values())
    for i, t in enumerate(texts + odd):
        own = [(s["kind"], s["start"], s["end"]) for s in got[i]["spans"] if not s["added"]]
        assert own == base_by_hand(t)
        more = {(s["kind"], s["start"], s["end"]) for s in got[i]["spans"] if s["added"]}
        hits = {(pii_bootstrap.KINDS[want[f["inst"]][0]], f["start"], f["end"]) for f in pii_bootstrap.look(t or "", set())["found"] if f["inst"] in want}
        assert more == hits
        assert all((t or "")[s["start"] : s["end"]] == s["value"] for s in got[i]["spans"])
    values = {s["value"]: s["kind"] for r in got.values() for s in r["spans"] if s["added"]}
    assert values["0171-55591234"] == "phone" and values["jane@localhost"] == "email" and values["0160-7771234"] == "phone"
    assert not any(v.startswith(("B1", "2.0")) for v in values)
    assert pii_bootstrap.find_spans(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        pii_bootstrap.find_spans(df.withColumn("spans", F.lit(1)), columns=("spans",))


def test_redacted(spark):
    df = spark.createDataFrame([(1, "ö a@b.c and 1.2.3.4, bye"), (2, None), (3, "none")], "doc_id long, text string")
    out = rows(pii_bootstrap.find_spans(df, columns=("doc_id", "text")).select("doc_id", pii_bootstrap.redacted(F.col("text"), F.col("spans")).alias("t")))
    assert {r["doc_id"]: r["t"] for r in out} == {1: "ö [email] and [ip], bye", 2: None, 3: "none"}

"""Classifiers, Jaccard join, bundles, Hamming search, SentencePiece and the pipeline, against brute force."""

import base64
import hashlib
import os
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from contrail.llm import hamming_topk, jaccard_join, language_id, queries, sentencepiece_nbest, source_mix, toxicity, warc_bundles
from contrail.llm.chargrams import gram_hashes
from contrail.llm.common import WORD, remainder_of_id
from contrail.llm.components import connected_components
from contrail.session import scratch_path
from tests.llm.conftest import ODD, PROSE

SF, SF_MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_grams_in_pieces_equal_grams_at_once(monkeypatch):
    import contrail.llm.chargrams as c

    text = "Über den Wolken " * 50
    whole = np.sort(np.concatenate(list(gram_hashes(text, (2, 3)))))
    monkeypatch.setattr(c, "PIECE", 64)
    assert (np.sort(np.concatenate(list(gram_hashes(text, (2, 3))))) == whole).all()
    assert sum(len(x) for x in gram_hashes("a", (1, 2, 3))) == 3 + 2 + 1


def test_language(spark, odd, none):
    out = rows(queries.op9_language_id(spark, SF_MORE))
    lang = {r["doc_id"]: r["lang"] for r in rows(spark.read.parquet(f"{SF_MORE}/documents.parquet"))}
    held = [r for r in out if r["held_out"]]
    assert len(out) == len(lang) and np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)
    model = language_id.train(odd)
    got = {r["doc_id"]: r for r in rows(language_id.identify(odd.withColumn("score_", F.lit(1)), model))}
    for i in (3, 4, 5, 7):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert {got[i]["lang_pred"] for i in (1, 2, 6, 8, 9)} <= {"de", "en", "fr"}
    assert language_id.identify(none, model).count() == 0
    untaught = language_id.train(none)
    assert {r["lang_pred"] for r in rows(language_id.identify(odd, untaught))} == {"und"}
    with pytest.raises(ValueError):
        language_id.train(odd, max_languages=1)


def test_language_scores_are_naive_bayes(spark):
    df = spark.createDataFrame([(1, "aba", "x"), (2, "bcb", "y"), (3, "ab", "x")], "doc_id long, text string, lang string")
    model = language_id.train(df, orders=(1,))
    count = {"x": Counter(" aba  ab "), "y": Counter(" bcb ")}
    size = 1 << language_id.BITS
    want = []
    for lang, prior in (("x", 2 / 3), ("y", 1 / 3)):
        total = sum(count[lang].values()) + language_id.SMOOTHING * size
        want.append(np.log(prior) + sum(np.log((count[lang][c] + language_id.SMOOTHING) / total) for c in " cab "))
    assert np.allclose(model.scores(["cab"])[0], want, atol=1e-4)


def test_language_scores_of_a_batch_are_those_of_its_texts(spark, odd, monkeypatch):
    import contrail.llm.chargrams as c

    model = language_id.train(odd)
    texts = [t for t in (r["text"] for r in odd.collect()) if t is not None] + ["a", "zz" * 3_000, ""]
    matrix = model.log_prob.astype(np.float64)
    want = [
        model.log_prior + sum(matrix[h >> np.uint32(32 - model.bits)].sum(axis=0) for h in gram_hashes(t, model.orders))
        for t in texts
    ]
    assert np.allclose(model.scores(texts), want, rtol=1e-9)
    monkeypatch.setattr(language_id, "CELLS", 40)  # few products at a time, texts in many parts
    monkeypatch.setattr(c, "PIECE", 500)
    assert np.allclose(model.scores(texts), want, rtol=1e-9)
    assert model.scores([]).shape == (0, len(model.languages))


def test_toxicity(spark, odd, none):
    d = "/root/testdata/check_s"
    where = d if os.path.isdir(d) else SF_MORE
    words = "loser|idiot|pathetic|scum|worthless|moron|trash|clown|disgusting|stupid"
    out = queries.op7_toxicity(spark, where).filter("held_out").join(spark.read.parquet(f"{where}/labels.parquet"), "doc_id")
    got = out.groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in got}
    right = n.get((0, 0), 0) + n.get((1, 1), 0)
    assert right / sum(n.values()) > (0.99 if where == d else 0.9), words
    texts = [(i, ("you " + ("scum " if i % 2 else "dear ") + PROSE), i % 2) for i in range(1, 61)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in texts] + [(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in rows(toxicity.score(docs, model))}
    assert all((got[i] >= 0.5) == bool(y) for i, _, y in texts)
    scores = {r["doc_id"]: r["score"] for r in rows(toxicity.score(odd, model))}
    assert scores[3] == scores[4] and all(0 <= s <= 1 for s in scores.values())
    assert toxicity.score(none, model).count() == 0
    assert len(toxicity.train(docs, labels.filter("toxic = 1")).keys) == 0
    assert toxicity.train(none, labels).score("x") < 1e-9


def test_toxicity_learns_from_null_and_empty_texts(spark):
    short = [(100, None, 1), (101, "", 1), (102, "x", 1), (103, None, 0), (104, "", 0), (105, "y", 0)]
    full = [(i, "you " + ("scum " if i % 2 else "dear ") + PROSE, i % 2) for i in range(1, 61)]
    for texts in (short, short + full):
        docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string")
        model = toxicity.train(docs, spark.createDataFrame([(i, y) for i, _, y in texts], "doc_id long, toxic int"))
        assert model.score(None) == model.score("") and 0 < model.score("") < 1
        assert len(model.keys) == 0 or (model.score("you scum") > 0.5 > model.score("you dear"))
    assert len(model.keys) > 0
    few = spark.createDataFrame([(1, None), (2, "bad")], "doc_id long, text string")
    alone = toxicity.train(few, spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int"))
    assert alone.score("") == pytest.approx(0.5)  # the null text counts as a document of its class


def test_toxicity_learns_once_from_repeated_rows(spark):
    texts = [(i, "you " + ("scum " if i % 2 else "dear ") + PROSE, i % 2) for i in range(1, 61)]
    once = spark.createDataFrame([(i, t) for i, t, _ in texts] + [(61, None), (62, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in texts] + [(61, 1), (62, 0)], "doc_id long, toxic int")
    again = once.filter("doc_id in (2, 61)").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n")
    one, many = toxicity.train(once, labels), toxicity.train(once.unionByName(again), labels)
    assert (one.keys == many.keys).all() and np.allclose(one.weights, many.weights) and one.intercept == pytest.approx(many.intercept)


def shingle_set(text):
    w = re.findall(WORD, text or "")
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def classes_by_hand(records):
    sets = [shingle_set(t) for _, t in records]
    n, links = len(records), [0] * len(records)
    label = list(range(n))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                label[max(a, b)] = min(a, b)
    groups = {}
    for i in range(n):
        groups.setdefault(top(i), []).append(records[i][0])
    least = lambda ids: min((x for x in ids if x is not None), default=None)
    return Counter((records[i][0], least(groups[top(i)]), links[i]) for i in range(n))


def test_jaccard_join(spark, documents, odd, none, monkeypatch):
    base = PROSE.split() + [f"w{i}" for i in range(60)]
    near = [(100 + k, " ".join(base[:k] + ["new"] + base[k:])) for k in range(0, 75, 3)]
    grown = spark.createDataFrame(near, "doc_id long, text string")
    for df in (documents.select("doc_id", "text"), odd.select("doc_id", "text"), grown):
        want = classes_by_hand([(r["doc_id"], r["text"]) for r in rows(df)])
        got = rows(jaccard_join.classes(df.withColumn("links", F.lit("clash"))))
        assert Counter((r["doc_id"], r["class_id"], r["links"]) for r in got) == want
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)  # many blocks
    monkeypatch.setattr(jaccard_join, "BUCKET", 3)  # large buckets
    got = rows(jaccard_join.classes(grown))
    assert Counter((r["doc_id"], r["class_id"], r["links"]) for r in got) == classes_by_hand(near)
    assert jaccard_join.classes(none).count() == 0


def test_first_of_each_class(odd, none):
    kept = rows(jaccard_join.first_of_each_class(odd))
    assert Counter(r["doc_id"] for r in kept) == Counter([1, 3, 4, 5, 6, 7, 8, 9, None])
    assert jaccard_join.first_of_each_class(none).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 103), (103, 101), (7, 7)] + [(200, k) for k in range(201, 230)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in rows(connected_components(df))}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100, **{i: 200 for i in range(200, 230)}}
    assert connected_components(df.limit(0)).count() == 0


def test_warc_bundles(spark):
    pages = spark.createDataFrame(
        [(5, "http://a b/\n", "<p>x</p>", 1), (3, None, "<p>x</p>", 1), (9, "u", None, 1), (8, "u", "", 1), (3, None, "<p>x</p>", 1),
         (None, "u", "é😀" * 5000, 1), (None, "u", "<p>x</p>", 1), (4, "u", "other\r\n\r\nbody", 1)],
        "page_id long, url string, html string, frame int").repartition(2)
    path = scratch_path(spark, "test-warc")
    warc_bundles.write_bundles(pages, path)
    got = Counter(
        (r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows(warc_bundles.read_records(spark, path)))
    sha = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    x = sha("<p>x</p>")
    assert got == Counter([
        (5, 8, x, "revisit", 3), (3, 8, x, "response", None), (3, 8, x, "response", None), (None, 8, x, "revisit", 3),
        (9, 0, sha(""), "revisit", 8), (8, 0, sha(""), "response", None), (None, 30000, sha("é😀" * 5000), "response", None),
        (4, 13, sha("other\r\n\r\nbody"), "response", None)])
    index = rows(warc_bundles.read_index(spark, path))
    assert len(index) == 8 and all(r["offset"] >= 0 < r["length"] for r in index)
    one = index[0]["record_id"]
    assert {r["record_id"] for r in rows(warc_bundles.read_records(spark, path, [one]))} == {one}
    empty = scratch_path(spark, "test-warc")
    warc_bundles.write_bundles(pages.limit(0), empty)
    assert warc_bundles.read_records(spark, empty).count() == 0


def test_frames(monkeypatch):
    import io

    import zstandard

    monkeypatch.setattr(warc_bundles, "FRAME_BYTES", 1000)
    made = [warc_bundles.make_record(i, "u", b"payload %d" % i, None) for i in range(20)]
    bundle = warc_bundles.Bundle()
    for one in made:
        bundle.add(*one)
    content = bytearray(bundle.finish() + bytes.fromhex("b1ea928f"))
    reader = warc_bundles.BundleReader(bytes(content))
    assert list(reader.records()) == made and len({f for _, f, _, _ in reader.index()}) > 3
    assert list(reader.records({made[7][0]})) == [made[7]]
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(bytes(content)), read_across_frames=True).read()
    assert plain == b"".join(r for _, r in made)  # any reader of the format gets the records
    content[12] ^= 1
    with pytest.raises(Exception):
        list(warc_bundles.BundleReader(bytes(content)).records())


def nearest_by_hand(vectors, asks, k):
    code = {i: sum(1 << j for j, x in enumerate(v) if x and x > 0) for i, v in vectors if v and i is not None}
    out = set()
    for q in (i for i in code if asks(i)):
        near = sorted((bin(code[q] ^ c).count("1"), i) for i, c in code.items())[:k]
        out |= {(q, rank, i, d) for rank, (d, i) in enumerate(near, 1)}
    return out


def test_top_k(spark):
    rng = np.random.default_rng(3)
    few = [(i, rng.normal(size=64).tolist()) for i in range(300)] + [(300 + i, [1.0] * 64) for i in range(40)]
    odd = few + [(400, None), (401, []), (402, [None, 1.0]), (None, [1.0]), (500, [0.5] * 64)]
    df = spark.createDataFrame(odd, "vec_id long, embedding array<double>").withColumn("code", F.lit("clash"))
    for k in (3, 10):
        got = {tuple(r) for r in hamming_topk.top_k(df, F.col("vec_id") % 100 == 0, k=k, sample=64).collect()}
        assert got == nearest_by_hand(odd, lambda i: i % 100 == 0, k)
    tiny = df.filter("vec_id in (0, 7)")
    assert hamming_topk.top_k(tiny, F.lit(True)).count() == 4
    assert hamming_topk.top_k(df.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("size", [65, 128, 768])
def test_top_k_of_longer_vectors(spark, size):
    rng = np.random.default_rng(size)
    centres = rng.normal(size=(5, size))
    vectors = [(i, (centres[i % 5] + rng.normal(scale=0.3, size=size)).tolist()) for i in range(60)]
    vectors += [(100 + i, vectors[i][1][: size - i]) for i in range(3)] + [(200, [1.0]), (201, None), (202, vectors[0][1])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in hamming_topk.top_k(df, F.col("vec_id") % 10 == 0, k=4, sample=16).collect()}
    assert got == nearest_by_hand(vectors, lambda i: i % 10 == 0, 4)


def test_segments_cover_every_bit_once(spark):
    for bits in (64, 128, 768, 1536):
        for n in (0, 1, 100, 10**5, 10**9):
            parts = hamming_topk.segments(n, bits)
            assert [a for a, _ in parts] == [0, *[a + w for a, w in parts[:-1]]] and sum(w for _, w in parts) == bits
    bits = [int(b) for b in np.random.default_rng(1).integers(0, 2, 192)]
    parts = hamming_topk.segments(10**4, 192)
    df = spark.createDataFrame([([float(b) for b in bits],)], "v array<double>").select(hamming_topk.sign_code(F.col("v"), 3).alias("c"))
    got = df.select(*[hamming_topk.segment_value(F.col("c"), a, w) for a, w in parts]).first()
    assert list(got) == [sum(b << i for i, b in enumerate(bits[a : a + w])) for a, w in parts]


def unigram_library():
    import sentencepiece

    raw = open(sentencepiece_nbest.MODEL, "rb").read()
    at = raw.rindex(b"\x18\x02 \x80\xfa\x01")  # the trainer's model type: merges; 1 is the lattice
    p = sentencepiece.SentencePieceProcessor()
    p.LoadFromSerializedProto(raw[: at + 1] + b"\x01" + raw[at + 2 :])
    return p


@pytest.fixture(scope="module")
def lattice():
    return sentencepiece_nbest.load()


def applied(base, alternative):
    out, at = [], 0
    for e in alternative["edits"]:
        out += base[at : e["at"]] + list(e["put"])
        at = e["at"] + e["drop"]
    return out + base[at:]


def test_n_best_equals_the_library(lattice):
    library = unigram_library()
    for text in ("Hello world", "unbelievable internationalization of tokens", "Çtre, le paelle\nfoo 😀 bar", "a", "erinannd thlyan reatin"):
        ids, score, others = lattice.encode(text, 6)
        base = np.frombuffer(ids, np.int32).tolist()
        want = library.nbest_encode_as_ids(text, 6)
        got = [base] + [applied(base, x) for x in others]
        assert got[0] == want[0] and sorted(got) == sorted(want)
        assert [x["score"] for x in others] == sorted((x["score"] for x in others), reverse=True)


def test_n_best_of_every_path(lattice):
    def paths(cut):
        if not cut:
            yield 0.0, []
        for j in range(1, min(len(cut), 16) + 1):
            w = lattice.edge(cut, 0, j)
            if w is not None:
                for s, rest in paths(cut[j:]):
                    yield s + w, lattice.ids_of(cut[:j]) + rest

    for cut in ("▁tokens", "▁abab", "▁ünder"):
        every = sorted((-s for s, _ in paths(cut)))[:5]
        assert [-s for s, _ in lattice.best_paths(cut, 5)] == pytest.approx(every)
        lattice.solve_many([cut])
        assert lattice.cache[cut] == lattice.solve(cut) and lattice.cache[cut][1] == -every[0]


def test_encode_decode(spark, odd, none, documents, lattice):
    for df in (odd, documents):
        encoded = sentencepiece_nbest.encode(df.withColumn("score", F.lit("clash")), lattice)
        for r in rows(sentencepiece_nbest.decode(encoded, lattice)):
            plain = (r["text"] or "").replace("▁", " ")
            assert r["decoded"] == plain
            for x in r["alternatives"]:
                assert x["score"] <= r["piece_score"] and lattice.decode(applied(r["pieces"], x)) == plain
    one = encoded.filter(F.size("alternatives") > 0).limit(1)
    built = one.select("pieces", "alternatives", sentencepiece_nbest.segmentation(F.col("pieces"), F.col("alternatives")[0]).alias("b"))
    r = rows(built)[0]
    assert r["b"] == applied(r["pieces"], r["alternatives"][0])
    assert sentencepiece_nbest.encode(none, lattice).count() == 0


def test_pipeline(spark, documents):
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        docs = docs.cache()
        if name != "SentencePiece encoding":
            assert docs.columns == before.columns
        if name == "toxicity":
            assert docs.join(before, "doc_id", "left_anti").count() == 0 and docs.count() >= 0.8 * before.count()
        if name == "language ID":
            assert docs.count() == before.count()  # every text here has letters
        if name == "n-gram Jaccard join":
            records = [(r["doc_id"], r["text"]) for r in rows(before)]
            want = {c for (_, c, _) in classes_by_hand(records)}
            assert {r["doc_id"] for r in rows(docs)} == want
        if name == "mixing sources to target weights":
            taken = Counter({r["doc_id"]: r["taken"] for r in rows(source_mix.taken_words(before))})
            found = Counter()
            for r in rows(docs):
                found[r["doc_id"]] += len(re.findall(WORD, r["text"]))
            assert +found == +taken
    assert docs.filter("n_pieces > 0").count() == docs.count() == before.count()
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" in E.queries()


def test_stages_take_odd_and_empty_tables(spark, odd, none):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0
        assert stage(spark, odd, SF).count() <= 3 * odd.count()


def test_held_out_rows(spark):
    ids = spark.createDataFrame([(12,), (None,)], "doc_id long")
    assert [r[0] for r in ids.select(remainder_of_id(F.col("doc_id"), 5)).collect()] == [__import__("zlib").crc32(b"12") % 5, None]
    assert len(ODD) == 12

"""Sharding, mixing, quality rules and licence scan against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from contrail.llm import license_scan, quality_rules, rendezvous, source_mix
from contrail.llm.common import WORD, running_offset
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.001"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


@pytest.mark.parametrize("name", sorted(k for k in E.oracle_sql() if k.startswith("op")))
def test_oracle(spark, name):
    from contrail.sources.tables import TABLES
    from tools.check_oracle import digest

    con = duckdb.connect()
    for t in {*TABLES, "documents", "pages", "embeddings"}:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(columns) and len(got) == len(want) > 0
    assert digest(got, df.columns) == digest(want, columns)


def test_running_offset_is_gapless_per_group(spark):
    df = spark.createDataFrame([("a", i % 7, 2) for i in range(50)] + [("b", 1, 3)] * 5, "g string, k int, w int")
    out = rows(running_offset(df, ["g"], ["k"], "w", chunks=4))
    assert sorted(r["offset"] for r in out if r["g"] == "a") == list(range(0, 100, 2))
    assert sorted(r["offset"] for r in out if r["g"] == "b") == [0, 3, 6, 9, 12]


def test_shards(odd, none, documents):
    out = rows(rendezvous.shard_slots(odd))
    assert len(out) == len(ODD)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((i, 16 + len((t or "").encode()), zlib.crc32(t.encode()) if t is not None else None) for i, t, *_ in ODD)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    assert rendezvous.shard_slots(none).count() == 0
    moved = rendezvous.shard_slots(documents, weights=[1.0] * 9).filter("grown_shard <> shard")
    assert moved.count() and moved.filter("grown_shard <> 9").count() == 0


def test_shard_weights(spark):
    ids = spark.range(6000).withColumnRenamed("id", "doc_id").withColumn("shard", F.lit("clashes"))
    shares = dict(rendezvous.with_shard(ids, "doc_id", [1.0, 3.0], out="s").groupBy("s").count().collect())
    assert 0.7 < shares[1] / 6000 < 0.8
    with pytest.raises(ValueError):
        rendezvous.rendezvous_shard(F.col("doc_id"), [1.0, 0.0])


def targets_by_hand(sizes):
    """The excess over 3 times a source, shared again and again by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, full, left = {}, set(), float(sum(sizes.values()))
    while True:
        open_ = [s for s in order if s not in full]
        w = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / w for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s], left = 3.0 * sizes[s], left - 3.0 * sizes[s]
            full.add(s)


def test_mix(documents, odd, none):
    for df in (documents, odd):
        sizes = defaultdict(int)
        for r in rows(df):
            sizes[r["source"]] += len(re.findall(WORD, r["text"] or ""))
        want = targets_by_hand(sizes)
        out = rows(source_mix.taken_words(df))
        again = rows(source_mix.taken_words(df))
        key = lambda r: tuple((v is None, v) for v in r.values())
        assert sorted(out, key=key) == sorted(again, key=key)
        assert len(out) == df.count()
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in out)
        got = {(r["source_size"], round(r["target"], 6)) for r in out}
        assert got == {(sizes[s], round(t, 6)) for s, t in want.items()}
        total = sum(sizes.values())
        assert abs(sum(r["taken"] for r in out) - total) <= max(0.02 * total, 3 * 128)
    assert source_mix.taken_words(none).count() == 0


def test_every_source_gets_its_target_over_many_shards(spark):
    block, shard = 4, 16
    cases = (
        {"a": 4, "b": 40, "c": 400, "d": 12_000},  # the first three are wanted three times over
        {"a": 5, "b": 43, "c": 997, "d": 1499, "e": 1501, "f": 17, None: 2},  # fractions of slots
    )
    for sizes in cases:
        texts = [(s, " ".join(f"w{i}" for i in range(at, min(n, at + 50)))) for s, n in sizes.items() for at in range(0, n, 50)]
        df = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(texts)], "doc_id long, source string, text string")
        want = {sizes[s]: t for s, t in targets_by_hand(sizes).items()}
        for seed in (17, 18, 19):
            taken = defaultdict(int)
            for r in rows(source_mix.taken_words(df, block_words=block, shard_slots=shard, seed=seed)):
                assert r["taken"] <= 3 * r["size"]
                taken[r["source_size"]] += r["taken"]
            # A slot rounded up or down, and the short last block in or out of the pass that ends early.
            assert all(abs(taken[n] - t) <= (2 * block if n % block or t % block else 0) for n, t in want.items()), (taken, want)
            assert all(taken[n] == 3 * n for n, t in want.items() if t == 3 * n)
            sized = spark.createDataFrame(list(sizes.items()), "source string, size long")
            found = rows(source_mix.draw_counts(source_mix.source_targets(sized), block, shard, seed))
            shards, sources = Counter(), Counter()
            for r in found:
                shards[r["shard"]] += r["count"]
                sources[r["ord"]] += r["count"]
                assert r["first"] == sum(x["count"] for x in found if x["ord"] == r["ord"] and x["shard"] < r["shard"])
            assert all(n == shard for k, n in shards.items() if k < max(shards)) and 0 < shards[max(shards)] <= shard
            order = sorted(sizes, key=lambda s: (s is None, s or ""))
            for i, s in enumerate(order, 1):
                blocks = -(-sizes[s] // block)
                assert abs(sources[i] - want[sizes[s]] * blocks / sizes[s]) < 1 and sources[i] <= 3 * blocks


def test_mixed_documents_hold_what_is_taken(documents, odd, none):
    for df in (documents, odd):
        taken = Counter()
        for r in rows(source_mix.taken_words(df)):
            taken[r["doc_id"]] += r["taken"]
        found = Counter()
        for r in rows(source_mix.mixed_documents(df)):
            found[r["doc_id"]] += len(re.findall(WORD, r["text"]))
            assert r["n_chars"] == len(r["text"])
        assert +found == +taken
    assert source_mix.mixed_documents(none).count() == 0


def test_permutation(spark):
    for n in (1, 2, 97, 1000):
        at = spark.range(n).select(source_mix.permuted(F.col("id"), F.lit(n).cast("long"), [F.lit(5)]).alias("p"))
        found = [r["p"] for r in at.collect()]
        assert sorted(found) == list(range(n)) and (n < 10 or found != sorted(found))


def counts_by_hand(text):
    words = re.findall(WORD, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


def test_quality_counts(spark, documents, odd, none):
    clash = odd.withColumn("n_lines", F.lit("kept aside")).drop("n_lines")
    extra = spark.createDataFrame([(20, "a b c d e a b c d e f a b c d e",), (21, "x x x x x x x",), (22, "a b c d e",)], "doc_id long, text string")
    for df in (documents, clash, extra):
        for r in rows(quality_rules.judge(df)):
            want = counts_by_hand(r["text"])
            assert {k: r[k] for k in want} == want
            failed = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
            assert r["base_failed"] == failed and not (failed and r["kept"])
    assert quality_rules.judge(none).count() == 0


def test_quality_rules_keep_good_and_drop_junk(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality_rules.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(labels, "doc_id")
    assert judged.filter("quality = 1 and not kept and not base_failed").count() == 0
    assert judged.filter("quality = 0 and kept").count() == 0


def test_a_text_without_stop_words_is_out_from_20_words_on(spark):
    texts = {n: " ".join(f"Wort{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n)) for n in (9, 10, 19, 20, 50, 51, 120)}
    cases = [(n, t) for n, t in texts.items()] + [(1000 + n, t + " the") for n, t in texts.items()] + [(2000, texts[120] + " the of")]
    df = spark.createDataFrame(cases, "doc_id long, text string")
    kept = {r["doc_id"] for r in rows(quality_rules.judge(df)) if r["kept"]}
    assert kept == {10, 19, 1009, 1010, 1019, 1020, 1050, 1051, 2000}


MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files "
    "(the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, "
    "subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or "
    "substantial portions of the Software.\n"
)


BSD_CLAUSES = (
    "Redistributions of source code must retain the above copyright notice, this\nlist of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice,\nthis list of conditions and the following disclaimer "
    "in the documentation\nand/or other materials provided with the distribution.",
    "Neither the name of HOLDER nor the names of its\ncontributors may be used to endorse or promote products derived from\n"
    "this software without specific prior written permission.",
)


def bsd(markers, holder="the copyright holder", head="Copyright (c) 2020, A Holder\n\n", between="\n\n"):
    grant = (
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following "
        "conditions are met:"
    )
    clauses = [m + c.replace("HOLDER", holder) for m, c in zip(markers, BSD_CLAUSES)]
    return head + between.join([grant, *clauses]) + "\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS \"AS IS\"\n"


def test_numbered_wrapped_and_three_clause_licenses(spark):
    two, three = ["BSDgrant", "BSDsource", "BSDbinary"], ["BSDgrant", "BSDsource", "BSDbinary", "BSDendorse"]
    flat = bsd(("1. ", "2. ", "3. ")).replace("\n\n", "|").replace("\n", " ").replace("|", "\n")
    commented = " * " + bsd(("1. ", "2. "), head="Copyright 2020 A Holder\n\n").replace("\n", "\n * ")
    cases = [
        (bsd(("1. ", "2. ")), two, ["BSD-2-Clause"]),
        (bsd(("* ", "- ")), two, ["BSD-2-Clause"]),
        (bsd(("(a) ", "b) ")), two, ["BSD-2-Clause"]),
        (bsd(("a. ", "ii. "), head="", between="\n"), two, ["BSD-2-Clause"]),
        (commented, two, ["BSD-2-Clause"]),
        (bsd(("1. ", "2. ")).replace("\n", "\r\n"), two, ["BSD-2-Clause"]),
        (bsd(("1. ", "2. ", "3. ")), three, ["BSD-3-Clause"]),
        (bsd(("* ", "* ", "* ")), three, ["BSD-3-Clause"]),
        (bsd(("", "", ""), holder="the University"), three, ["BSD-3-Clause"]),
        (bsd(("1. ", "2. ", "3. "), holder="Some Inc."), [*two, "BSDname", "BSDendorse"], ["BSD-3-Clause"]),
        (flat, three, ["BSD-3-Clause"]),
        (bsd(("1. ", "2. ", "3. ")).replace("specific prior", "his"), [*two, "BSDname"], ["BSD-style"]),
        (bsd(("1. ", "2. Any use must be paid for. ")), two, ["BSD-style"]),  # a sentence between
        (bsd(("1. ", "2. \u8bb8\u53ef\u3002 \u8bb8\u53ef.\n")), two, ["BSD-style"]),  # of letters that aren't ASCII
        (MIT, ["MITgrant", "MITnotice"], ["MIT"]),
        ("A Licence\n\nCopyright 2020 X\n\n" + MIT, ["MITgrant", "MITnotice"], ["MIT"]),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: (r["license_sentences"], r["licenses"]) for r in rows(license_scan.scan(df))}
    for i, (_, sentences, licences) in enumerate(cases):
        assert got[i] == (sentences, licences), i


def test_license_scan(spark, odd, none):
    every = [(i, s, name) for i, (name, found) in enumerate(license_scan.SENTENCES.items()) for s in found]
    assert all(re.search(f"(?i){license_scan.KEYWORDS}", s) for _, s, _ in every)
    df = spark.createDataFrame(
        [(1, MIT), (2, "x |\nReleased under the MIT License.\ny | z"), (3, "no software here"), (4, None), (5, ""),
         (6, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
             "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
         (7, "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.\n")],
        "doc_id long, text string")
    found = {r["doc_id"]: r["licenses"] for r in rows(license_scan.scan(df))}
    assert found == {1: ["MIT"], 2: ["MIT"], 3: [], 4: [], 5: [], 6: ["GPL-3.0-or-later"], 7: ["Apache-2.0", "CC-BY-NC-4.0"]}
    assert {tuple(r["licenses"]) for r in rows(license_scan.scan(odd))} == {()}
    assert license_scan.scan(none).count() == 0

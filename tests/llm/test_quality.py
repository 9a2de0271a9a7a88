"""The classifier, the rules, licence scans and audio features."""

from __future__ import annotations

import hashlib
import random
import textwrap
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.llm import audio, classifier, licenses, rules
from docloom.llm.registry import ORACLE, QUERIES
from tests.llm.brute import WORD, base_counts

DATA = Path("/root/testdata/sf0.01")


# classifier


def test_rules_compile_to_the_same_scores(spark):
    rng = np.random.default_rng(4)
    names = list(classifier.FEATURES)
    x = np.round(rng.random((600, len(names))), 3)
    y = ((x[:, 4] > 0.6) | ((x[:, 2] < 0.3) & (x[:, 9] > 0.5))).astype(float)
    model = classifier.fit(x, y, names)
    assert 0 < len(model.rules) < 120
    odds = model.intercept + classifier.holds(x, names, [r for r, _ in model.rules]) @ np.array([w for _, w in model.rules])
    frame = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(x)], ["k", *names])
    got = np.array([r.s for r in frame.select("k", model.column().alias("s")).orderBy("k").collect()])
    assert np.allclose(got, 1 / (1 + np.exp(-odds)), atol=1e-5) and ((got > 0.5) == (y > 0)).mean() > 0.97


def test_lasso_is_optimal():
    rng = np.random.default_rng(2)
    r = (rng.random((500, 20)) > 0.5).astype(np.float32)
    y = (rng.random(500) < 1 / (1 + np.exp(-(3 * r[:, 0] - 2 * r[:, 1])))).astype(float)
    _, w = classifier.lasso(r, y, 0.02)
    assert w[0] > 0.5 and w[1] < -0.2 and (np.abs(w) < 1e-6).sum() >= 10


@pytest.mark.skipif(not DATA.is_dir(), reason="no test tables here")
def test_held_out_accuracy(spark):
    got = QUERIES["op1_rule_ensemble"](spark, str(DATA))
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").toPandas()
    assert ((rows.predicted == rows.quality).mean() > 0.95) and len(rows) > 40
    every = got.toPandas()
    assert len(every) == spark.read.parquet(f"{DATA}/documents.parquet").count() and every.score.between(0, 1).all()
    assert all(bool(h) == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(every.doc_id, every.held_out))


def test_fit_is_bounded(spark):
    """Never more than the stated number of labelled ids, the same ones whatever the order of rows, none held out."""
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    labels = ids.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality").unionByName(ids.selectExpr("doc_id", "1 as quality"))
    one, other = (sorted(r.doc_id for r in classifier.chosen(x, labels, 300).collect()) for x in (ids, ids.repartition(7)))
    assert one == other and len(set(one)) == 300
    assert all(zlib.crc32(str(i).encode()) % 5 for i in one)
    assert classifier.chosen(ids.where("doc_id < 100"), labels, 300).count() == sum(zlib.crc32(str(i).encode()) % 5 > 0 for i in range(100))


def test_classifier_odd_rows(spark, make, odd_rows):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 20)] + [(None, 1, 0), (4, None, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    rows = odd_rows + odd_rows[:4] + [(None, "x")]
    got = classifier.quality_scores(make(rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.held_out is not None and r.predicted in (0, 1) for r in got)
    none = classifier.quality_scores(make(rows), labels.where("false")).collect()
    assert len({r.score for r in none}) == 1
    assert classifier.quality_scores(make([]), labels).isEmpty()
    docs = make(rows)
    left = classifier.accepted(docs, labels)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == sorted(r.doc_id or -1 for r in got if r.predicted)


# rules


def test_counts(make, odd_rows):
    got = {r.doc_id: r for r in rules.quality_rules(make(odd_rows)).collect()}
    for i, t in odd_rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(t), i
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept)


def plain_verdicts(rows):
    """The limits by sorting, with the sketch's buckets."""

    def bucket(v):
        shift = max(v.bit_length() - 6, 0)
        return v >> shift << shift

    counted = []
    for i, t, lang, source, _ in rows:
        n, chars, symbols, dups, repeats = base_counts(t)
        lines = sum(bool(x.strip(" \t\x0b\x0c\r")) for x in (t or "").split("\n"))
        words = WORD.findall(t or "")
        echoes = sum(a == b for a, b in zip(words, words[1:]))
        part = lambda a, b: a * 1000 // b if b else 0
        ratio = {"symbols": part(symbols, n), "dup_lines": part(dups, lines), "repeats": part(repeats, n), "echoes": part(echoes, n), "word_length": part(chars, n)}
        counted.append((i, lang or "", source or "", n < 20 or 100 * repeats > 30 * n, ratio))
    def share(pool, wider=None):
        found = {b: wider[b] * rules.PRIOR for b in wider} if wider else {}
        for v in pool:
            found[v] = found.get(v, 0) + 1
        total = len(pool) + (rules.PRIOR if wider else 0)
        return {b: found[b] / total for b in sorted(found)}

    def quantile(shares, part):
        upto = 0.0
        return next(b for b, s in shares.items() if (upto := upto + s) >= part - 1e-9)

    limits = {}
    for name, (_, _, least, sides) in rules.RATIOS.items():
        good = [(lang, source, bucket(r[name])) for _, lang, source, failed, r in counted if not failed]
        every = share([v for _, _, v in good]) if good else {}
        for lang, source in {(a, b) for a, b, _ in good}:
            wide = share([v for a, _, v in good if a == lang], every)
            own = share([v for a, b, v in good if (a, b) == (lang, source)], wide)
            q1, q2, q3, d9 = (quantile(own, p) for p in (0.25, 0.5, 0.75, 0.9))
            if sides == "both":
                limits[lang, source, name] = (q2 - rules.REACH * max(q3 - q2, least), q2 + rules.REACH * max(q2 - q1, least))
            else:
                limits[lang, source, name] = (-1, q2 + rules.REACH * max(q3 - q2, (d9 - q2) // 2, least))
    inside = lambda lang, source, ratio: all(limits[lang, source, n][0] <= v <= limits[lang, source, n][1] for n, v in ratio.items())
    return {i: not failed and inside(lang, source, ratio) for i, lang, source, failed, ratio in counted}


def test_adaptive_limits(make, odd_rows):
    rng = random.Random(8)
    rows = [(*r, None, None, 0) for r in odd_rows]
    for k in range(900):
        lang, source = rng.choice([("en", "a"), ("en", "b"), ("fr", "a"), ("de", "rare")][: 3 if k % 50 else 4])
        words = [("x" * rng.randrange(2, 9) if lang == "en" else "y" * rng.randrange(5, 14)) + ("#" if rng.random() < (0.02 if k % 40 else 0.8) else "") + str(rng.randrange(99)) for _ in range(rng.randrange(5, 90))]
        rows.append((1000 + k, " ".join(words), lang, source, 0))
    docs = make(rows)
    got = {r.doc_id: r.kept for r in rules.quality_rules(docs).collect()}
    assert got == plain_verdicts(rows) and 0.5 < sum(got.values()) / len(got) < 1
    left = rules.kept_rows(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == sorted(i for i, k in got.items() if k)
    assert rules.quality_rules(make([])).isEmpty() and rules.kept_rows(make([])).isEmpty()


def test_sources_with_other_tails_get_other_limits(make):
    rng = random.Random(3)
    prose = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]

    def built(symbols: int = 0, repeats: int = 0, echoes: int = 0, dup_lines: int = 0) -> str:
        words = prose(200 - repeats // 2 - echoes)
        words += words[2 : 2 + repeats // 2] + ["again"] * (echoes + 1) * (echoes > 0)
        words[60 : 60 + symbols] = ["#" + w for w in words[60 : 60 + symbols]]
        lines = [" ".join(words[k : k + 5]) for k in range(0, len(words), 5)]
        return "\n".join(lines + lines[: 2 * dup_lines : 2])

    probes = {"symbols": built(symbols=20), "repeats": built(repeats=48), "echoes": built(echoes=16), "dup_lines": built(dup_lines=10)}
    rows = []
    for k in range(600):  # an eighth of source b has such texts, none of source a
        for source, odd in (("a", False), ("b", k % 8 == 0)):
            rows.append((2 * k + (source == "b"), built(14, 40, 12, 4) if odd else built(), "en", source, 0))
    for n, (name, text) in enumerate(probes.items()):
        rows += [(10_000 + 2 * n, text, "en", "a", 0), (10_001 + 2 * n, text, "en", "b", 0)]
    got = {r.doc_id: r for r in rules.quality_rules(make(rows)).collect()}
    for n, name in enumerate(probes):
        strict, wide = got[10_000 + 2 * n], got[10_001 + 2 * n]
        assert not strict.base_failed and name in strict.failed and not strict.kept, name
        assert name not in wide.failed, name


def test_no_step_at_any_size(spark):
    """A small group has its language's limits, a large one its own, and no number of rows switches between them."""

    def limit(n: int) -> int:
        rows = [("en", "big", "symbols", 0, 5000)] + [("en", "own", "symbols", b, n // 4) for b in (8, 16, 24, 32)]
        cells = [(a, b, r, v, k) for a, b, _, v, k in rows for r in rules.RATIOS]
        frame = spark.createDataFrame(cells, "lang string, source string, ratio string, bucket long, n long")
        return rules.limits(frame).where("source = 'own'").first().symbols_high

    seen = [limit(n) for n in (4, 100, 196, 200, 204, 400, 4000)]
    assert seen[0] == 6 * 5 and seen[2] == seen[3] == seen[4] and seen[-1] == 16 + 6 * 8


def test_sketch_merges(spark):
    rng = random.Random(1)
    frame = spark.createDataFrame([(rng.randrange(100), 10 + rng.randrange(90), 0, 5, 0, 4, 0, "en", "s") for _ in range(500)], "n_symbols long, n_words long, n_dup_lines long, n_lines long, n_repeat_words long, word_chars long, n_echo_words long, lang string, source string")
    whole = rules.sketch(frame, ["lang"])
    parts = rules.sketch(frame.where("n_words < 50"), ["lang"]).unionByName(rules.sketch(frame.where("n_words >= 50"), ["lang"]))
    assert rules.merged(parts, ["lang"]).exceptAll(whole.select("lang", "ratio", "bucket", "n")).isEmpty()


# licences


def test_licenses(spark, make):
    mit = licenses.TEXTS[0][1]
    rows = [(1, "Copyright (c) 2020 Some One\n\n" + mit), (2, mit.upper().replace(",", " ,")), (3, mit + " and more"), (4, "text\nLicenced under the Apache Licence, v. 2.0.\nmore"), (5, None), (6, ""), (7, "x\n\nReleased under the MIT License.\nReleased under the MIT License.")]
    got = {r.doc_id: r for r in licenses.license_scan(make(rows + [(None, mit)])).collect()}
    assert [got[i].license for i in (1, 2, 3, 5, 6, None)] == ["MIT", "MIT", None, None, None, "MIT"]
    assert got[4].notices == "Apache-2.0" and (got[7].notices, got[7].n_notices) == ("MIT", 1)
    assert got[1].canonical_sha256 == got[2].canonical_sha256
    assert licenses.license_scan(make([])).isEmpty()
    own = licenses.catalogue(spark, [("mine", "My  Own Terms!"), ("other", "...")])
    assert own.count() == 1 and licenses.license_scan(make([(1, "my own terms")]), own).first().license == "mine"


def test_wrapped_licenses(make):
    texts = licenses.TEXTS + licenses.more_texts()
    wrapped = []
    for name, text in texts:
        for width in (*range(70, 81), 30):  # a line begins at many a word
            parts = [textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in text.split("\n\n")]
            wrapped.append((name, "\n\n".join(parts)))
    wrapped.append(("ISC", "Copyright (c) 2020 Some One\nAll rights reserved.\n" + licenses.TEXTS[3][1].replace("above copyright", "above\ncopyright")))
    wrapped.append(("MIT", "# © Some One\n# Copyright <year> Other\n" + licenses.TEXTS[0][1].replace("OR COPYRIGHT", "OR\nCOPYRIGHT")))
    got = {r.doc_id: r.license for r in licenses.license_scan(make([(k, t) for k, (_, t) in enumerate(wrapped)])).collect()}
    assert [got[k] for k in range(len(wrapped))] == [name for name, _ in wrapped]


def test_copyright_lines(make):
    gone = ["Copyright 2020 X", "(c) 1999 X", "copyright: X, 2001-2003", "Copyright X. All rights reserved.", "All rights reserved", "// Copyright © X", "Copyright [yyyy] [name]"]
    stay = ["copyright notice", "Copyright holders be liable", "all rights reserved to others", "(c) You must keep this", "Copyright Office form 123456"]
    got = {r.doc_id: r.canonical_sha256 for r in licenses.license_scan(make([(k, x) for k, x in enumerate(gone + stay)])).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert [got[k] == empty for k in range(len(got))] == [True] * len(gone) + [False] * len(stay)


def test_headers_of_source_files(make):
    rows = [(1, '/*\n * Licensed under the Apache License, Version 2.0 (the "License");\n * you may not\n */'), (2, "// SPDX-License-Identifier: GPL-2.0-or-later\nint x;")]
    assert {r.doc_id: r.notices for r in licenses.license_scan(make(rows)).collect()} == {1: "Apache-2.0", 2: "GPL-2.0-or-later"}


def test_catalogue_of_a_folder(spark, make, tmp_path):
    texts = {"Own-1.0": "Own terms, first of all.\n\nCopyright (c) 2001 Some One\nDo as you like.", "Other+2.txt": "Other terms"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    known = licenses.catalogue_of(spark, str(tmp_path))
    rows = [(1, "OWN TERMS first of all\nDo as you like"), (2, "other  terms"), (3, licenses.TEXTS[0][1]), (4, "else")]
    assert {r.doc_id: r.license for r in licenses.license_scan(make(rows), known).collect()} == {1: "Own-1.0", 2: "Other+2", 3: "MIT", 4: None}


def test_licence_sql_takes_the_same_copyright_lines(spark):
    import duckdb

    parts = ["copyright 2020 x", "(c) 1999 x", "(c) you must", "copyright notice", "all rights reserved", "all rights reserved. ", "all rights reserved to", "# © x", "-- copyright (c) x", "copyrighted 2020", "text (c) v. 2", "", "(c)copyright", "copyright <year> y"]
    rng = random.Random(2)
    texts = ["\n".join(rng.choice(parts) for _ in range(rng.randrange(1, 6))) for _ in range(300)] + parts
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, text string")
    got = [r.x for r in frame.select("k", licenses.lined(F.col("text")).alias("x")).orderBy("k").collect()]
    con = duckdb.connect()
    con.execute("create table t (k bigint, text varchar)")
    con.executemany("insert into t values (?, ?)", list(enumerate(texts)))
    assert got == [r[0] for r in con.sql(f"select {licenses._sql_form('text')} from t order by k").fetchall()]


def test_licenses_are_native(make):
    seen = []
    kept, licenses.written = licenses.written, lambda df, name: seen.append(df) or kept(df, name)
    try:
        seen.append(licenses.license_scan(make([(1, "a")])))
    finally:
        licenses.written = kept
    for frame in seen[1:]:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert len(seen) == 3


@pytest.mark.skipif(not DATA.is_dir(), reason="no test tables here")
@pytest.mark.parametrize("name", list(ORACLE))
def test_sql(spark, name):
    import duckdb

    from tests.test_oracle import rows

    small = Path("/root/testdata/sf0.001")
    con = duckdb.connect()
    for p in small.glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    assert rows(QUERIES[name](spark, str(small)).toPandas()) == rows(con.sql(ORACLE[name]).df())


# audio


def test_audio_round_trip(make, odd_rows):
    rows = odd_rows + odd_rows[:3]
    got = audio.audio_features(make(rows)).collect()
    assert len(got) == len(rows)
    texts = dict(odd_rows)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert r.n_bytes == len(raw) and r.payload_bytes == len(payload) and audio.from_wav(bytes(r.media)) == payload
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
        assert r.media_sha256 == hashlib.sha256(bytes(r.media)).hexdigest() and r.media_bytes == len(r.media)
        table = pa.ipc.open_stream(bytes(r.tensors)).read_all()
        assert isinstance(table.schema.field("tensor").type, pa.FixedShapeTensorType) and table.num_rows == -(-r.frames // audio.SPAN)
        assert (table["end_s"].to_numpy() > table["begin_s"].to_numpy()).all()
    same = {r.doc_id: r.feature for r in got}
    assert same[4] == same[5] and same[7] == same[8]
    assert audio.audio_features(make([]), stored=False).isEmpty()


def test_features_come_from_the_stored_stream(make, odd_rows):
    wide = {r.doc_id: r for r in audio.audio_features(make(odd_rows)).collect()}
    thin = {r.doc_id: r.feature for r in audio.audio_features(make(odd_rows), stored=False).collect()}
    second = audio.HOP * audio.DOWN / audio.UP / audio.RATE
    for i, r in wide.items():
        table = pa.ipc.open_stream(bytes(r.tensors)).read_all().combine_chunks()
        tensors = table["tensor"].chunk(0).to_numpy_ndarray()
        spans = np.array([(round(s.begin_s / second), round(s.end_s / second)) for s in r.segments], np.int64)
        stored = [tensors, table["begin_s"].to_numpy(), table["end_s"].to_numpy(), spans]
        assert thin[i] == r.feature and hashlib.sha256(b"".join(x.tobytes() for x in stored)).hexdigest()[:32] in r.feature


def test_polyphase_equals_plain_filtering():
    x = np.random.default_rng(1).standard_normal(400).astype(np.float32)
    for up, down in ((1, 2), (3, 2), (2, 3)):
        taps = 16
        h = audio.filters(up, down, taps).T.ravel()
        wide = np.zeros(len(x) * up, np.float32)
        wide[::up] = x
        plain = np.convolve(wide, h)[: len(wide)][::down]
        got = audio.resampled(x, up, down, taps)
        assert np.allclose(got[: len(plain)], plain[: len(got)], atol=1e-4), (up, down)


def test_log_mel_equals_a_plain_one():
    """Filter, windows, transform and mel filters written out, frame by frame."""
    raw = bytes(np.random.default_rng(5).integers(0, 256, 3000, dtype=np.uint8))
    x = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    taps = np.sinc((np.arange(16) - 7.5) / 2) * np.hamming(16)
    y = np.convolve(x, taps / taps.sum())[: len(x) : 2]
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = [700 * (10 ** (mel(4000) * k / 25 / 2595) - 1) for k in range(26)]
    got, power = audio.log_mel(raw)
    for k in range(len(got)):
        frame = np.zeros(256)
        own = y[128 * k : 128 * k + 256]
        frame[: len(own)] = own
        wave_ = frame * (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(256) / 255))
        bins = [abs(sum(wave_ * np.exp(-2j * np.pi * b * np.arange(256) / 256))) ** 2 for b in range(129)]
        for m in range(24):
            low, mid, high = edges[m : m + 3]
            weights = [max(0.0, min((f - low) / (mid - low), (high - f) / (high - mid))) for f in np.arange(129) * 8000 / 256]
            assert abs(got[k, m] - 100 * np.log10(np.dot(weights, bins) + 1e-6)) <= 1.5, (k, m)
        assert abs(power[k] - 10 * np.log10((frame**2).sum() + 1e-6)) <= 0.15


def test_block_borders_do_not_show():
    raw = bytes(np.random.default_rng(3).integers(0, 256, 3 * audio.BLOCK * audio.HOP, dtype=np.uint8))
    whole, _ = audio.log_mel(raw)
    old, audio.BLOCK = audio.BLOCK, 1 << 30
    try:
        single, _ = audio.log_mel(raw)
    finally:
        audio.BLOCK = old
    assert np.abs(whole.astype(int) - single.astype(int)).max() <= 1


def test_hysteresis():
    power = np.array([0.0] * 8 + [2.0, 4.0, 2.0, 1.5, 0.5, 2.0, 0.0] + [0.0] * 10)
    assert audio.segments(power, enter=3.0, leave=1.0) == [(9, 12)]
    assert F is not None

"""Operators on small tables with nulls, ties and gaps."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tonehive.functions import text
from tonehive.operators import filters, manifest, ranks, segments, splits, stats
from tonehive.sources import files, subtitles


def test_fan_out(spark):
    rows = spark.createDataFrame([(0, " 字　", "a", "x", ""), (1, "　", "b", "y", "c.MP3"), (2, None, "c", "z", "sub/d"), (3, "t", None, None, None)], "index long, word string, word_audio string, line string, line_audio string")
    out = manifest.fan_out(rows, {"w": ("word", "word_audio"), "l": ("line", "line_audio"), "n": ("absent", "word_audio")})
    assert sorted(map(tuple, out.collect())) == [("l", 1, "c.MP3", "y"), ("l", 2, "sub/d.mp3", "z"), ("w", 0, "a.mp3", "字")]


def test_ordinal_and_counts(spark):
    df = spark.range(0, 100, 1, 7).select(F.col("id").alias("v"))
    out = manifest.with_ordinal(df).collect()
    assert [(r["index"], r.v) for r in out] == [(i, i) for i in range(100)]
    assert manifest.same_count(df, df) == 100
    with pytest.raises(ValueError):
        manifest.same_count(df, df.limit(3))


def test_merge_replacing(spark):
    left = spark.createDataFrame([("a", "s", "h", "old", 1.0, "extra"), ("b", "s", "h", "old", 1.0, "extra"), (None, "s", "h", "old", 1.0, "extra")], "`音檔` string, `來源` string, `漢字` string, `羅馬字` string, `長短` double, more string")
    right = spark.createDataFrame([("a", "1"), ("a", "2"), (None, "3")], "`音檔` string, `羅馬字_POJ` string")
    out = manifest.merge_replacing(left, right, "音檔", "羅馬字", "羅馬字_POJ", ["音檔", "來源", "漢字", "羅馬字", "長短"])
    assert out.columns == ["音檔", "來源", "漢字", "羅馬字", "長短"]
    assert sorted((r["音檔"] or "-", r["羅馬字"]) for r in out.collect()) == [("-", "3"), ("a", "1"), ("a", "2"), ("b", None)]


def test_reasons_and_counts(spark):
    rows = [(1, 5.0, 2.0, 30.0), (2, 0.5, 9.0, 10.0), (3, 5.0, 9.0, 10.0), (4, 5.0, 2.0, None), (5, None, 2.0, 30.0)]
    df = spark.createDataFrame(rows, "id int, d double, w double, s double")
    rules = filters.Rules(min_dur=1, max_dur=15)
    out = df.withColumn("drop_reason", filters.drop_reason(rules, F.col("d"), F.col("w"), F.col("s")))
    assert [r.drop_reason for r in out.orderBy("id").collect()] == [None, "duration", "wps", "snr", "duration"]
    row = filters.stage_counts(out).first()
    assert (row.kept, row.dropped, row.reasons) == (1, 4, {"duration": 2, "snr": 1, "wps": 1})
    quiet = df.withColumn("drop_reason", filters.drop_reason(filters.Rules(filter_audio=False), F.col("d"), F.col("w"), F.col("s")))
    assert filters.stage_counts(quiet).first().reasons == {"wps": 2}
    assert {r.reason: r.n for r in filters.reason_counts(out).collect()} == {"duration": 2, "snr": 1, "wps": 1}


@pytest.mark.parametrize("partitions", [1, 5])
def test_splits_do_not_depend_on_partitions(spark, partitions):
    df = spark.range(0, 200).select("id", (F.col("id") % 23).alias("speaker"), (F.col("id") % 17 * 1.5).alias("d")).repartition(partitions)
    out = {r.id: r.split for r in splits.random_split(df, "id").collect()}
    order = sorted(range(200), key=lambda i: __import__("hashlib").md5(f"42:{i}".encode()).hexdigest())
    assert out == {i: "validation" if k < 10 else "test" if k < 20 else "train" for k, i in enumerate(order)}
    by = {}
    for r in splits.speaker_split(df, "speaker", val=0.2, test=0.2).collect():
        by.setdefault(r.speaker, set()).add(r.split)
    assert all(len(s) == 1 for s in by.values()) and sum("test" in s for s in by.values()) == 4
    strata = splits.stratified_split(df, "id", "d").groupBy("stratum").agg(F.count("*").alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi"), F.sum((F.col("split") == "test").cast("int")).alias("t")).orderBy("stratum").collect()
    assert [r.n for r in strata] == [40] * 5 and [r.t for r in strata] == [2] * 5
    assert all(a.hi <= b.lo for a, b in zip(strata, strata[1:], strict=False))


def test_ten_rows_all_train(spark):
    out = splits.random_split(spark.range(10), "id")
    counts = {r.split: (r.n, r.ratio) for r in splits.split_counts(out).collect()}
    assert counts == {"train": (10, 1.0), "validation": (0, 0.0), "test": (0, 0.0)}
    assert [r.split for r in splits.split_counts(out, zero_fill=False).collect()] == ["train"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(0, 100).map(lambda x: round(x, 2)), min_size=1, max_size=60))
def test_percentiles(spark, values):
    row = stats.duration_stats(spark.createDataFrame([(v,) for v in values] + [(None,)], "duration_s double")).first()
    s, n = sorted(values), len(values)
    assert row["count"] == n and row.min_s == s[0] and row.max_s == s[-1]
    for p in stats.PERCENTILES:
        assert row[f"p{p}_s"] == s[min(n * p // 100, n - 1)]


def test_shards_and_samples(spark):
    df = spark.range(1201).select("id", F.lit("train").alias("split"))
    assert {r.shard: r.n for r in ranks.shards(df, "split", "id").groupBy("shard").agg(F.count("*").alias("n")).collect()} == {0: 500, 1: 500, 2: 201}
    assert splits.sample_examples(df, "id", 5).collect() == splits.sample_examples(df.repartition(9), "id", 5).collect()


def test_padding_stops_at_the_last_end_so_far(spark):
    rows = [("m", 1, 0, 5000), ("m", 2, 1000, 1200), ("m", 3, 6000, 6500)]
    out = segments.padded(spark.createDataFrame(rows, "media string, i int, start_ms long, end_ms long"), lead=3000).orderBy("i").collect()
    assert [r.clip_start for r in out] == [0, 1000, 5000]


def test_one_file(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text("a,b\n1,x\n2,y\n", encoding="utf-8")
    files.replace_csv(files.read_csv(spark, str(path)).withColumn("c", F.upper("b")), str(path))
    assert path.is_file() and path.read_text(encoding="utf-8") == "a,b,c\n1,x,X\n2,y,Y\n"
    files.write_text(spark, "ä", str(tmp_path / "t.txt"))
    assert (tmp_path / "t.txt").read_text(encoding="utf-8") == "ä"


def test_padding_does_not_bleed(spark):
    rows = [("m", 1, 1000, 2000), ("m", 2, 2100, 3000), ("m", 3, 2900, 4000), ("m", 4, 9000, 9500), ("n", 1, 100, 200)]
    out = segments.padded(spark.createDataFrame(rows, "media string, i int, start_ms long, end_ms long"), lead=300, tail=400).orderBy("media", "i").collect()
    assert [(r.clip_start, r.clip_end) for r in out] == [(700, 2100), (2000, 3000), (2900, 4400), (8700, 9900), (0, 600)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 500), st.integers(0, 300)), max_size=12), st.lists(st.tuples(st.integers(0, 500), st.integers(0, 300)), max_size=12))
def test_overlaps_like_nested_loops(spark, a, b):
    left = spark.createDataFrame([("m", i, s, s + n) for i, (s, n) in enumerate(a)], "media string, i int, start_ms long, end_ms long")
    right = spark.createDataFrame([("m", j, s, s + n) for j, (s, n) in enumerate(b)], "media string, j int, range_start long, range_end long")
    got = sorted((r.i, r.j) for r in segments.overlapping(left, right, "media", 50).collect())
    assert got == sorted((i, j) for i, (s, n) in enumerate(a) for j, (t, m) in enumerate(b) if n and m and s < t + m and s + n > t)


def test_text_scalars(spark):
    df = spark.createDataFrame([("He paid 1205 for 7, not 0.", "台灣 ok", "203.500s")], "t string, h string, o string")
    row = df.select(text.clean_tts(df.t).alias("tts"), text.clean_asr(df.t).alias("asr"), text.words(df.h).alias("w"), text.words(df.h, True).alias("han"), text.seconds_of(df.o).alias("s"), text.seconds_of(df.t).alias("none"), text.cer(F.lit("abcd"), F.lit("abxd")).alias("cer")).first()
    assert row.tts == "He paid one thousand two hundred five for seven, not zero."
    assert row.asr == "he paid 1205 for 7 not 0"
    assert (row.w, row.han, row.s, row.none, row.cer) == (2, 3, 203.5, None, 0.25)


def test_csv(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('lomaji,more\n"a, ""q""\nb",1\n,2\ntsuí,3,surplus\n')
    rows = files.read_csv(spark, path)
    assert [tuple(r) for r in rows.collect()] == [('a, "q"\nb', "1"), ("", "2"), ("tsuí", "3")]
    table = str(tmp_path / "table")
    files.write_csv(rows, table)
    files.replace_csv(files.read_csv(spark, table).withColumn("POJ", F.upper("lomaji")), table)
    again = files.read_csv(spark, table)
    assert again.columns == ["lomaji", "more", "POJ"] and {r.POJ for r in again.collect()} == {'A, "Q"\nB', "", "TSUÍ"}
    assert not [p for p in tmp_path.iterdir() if p.name.endswith((".new", ".old"))]


def test_csv_cells_as_they_are(spark, tmp_path):
    cells = ["", " ", "  a", "a  ", "\ta\t", "\n", "\r", "\r\n", "a\rb", "\na", "a\\", "\\\"", '"', '"a"', "a,b", "#a", "\x00", "\x01a\x02", "\ufeffa", "\u3000a\u3000", "null"]
    rows = [(str(n), a, b) for n, (a, b) in enumerate((a, b) for a in cells for b in cells)]
    files.write_csv(spark.createDataFrame(rows, "n string, a string, b string"), str(tmp_path / "t"))
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "t")).collect())) == sorted(rows)
    files.write_csv(spark.createDataFrame([(c,) for c in [*cells, None]], "a string"), str(tmp_path / "one"))
    assert sorted(r.a for r in files.read_csv(spark, str(tmp_path / "one")).collect()) == sorted([*cells, ""])


def test_listing_and_copy(spark, tmp_path):
    source, target = tmp_path / "src", tmp_path / "dst"
    (source / "sub").mkdir(parents=True)
    target.mkdir()
    for name in ("a.mp3", "sub/b.mp3"):
        (source / name).write_bytes(b"x")
    (target / "a.mp3").write_bytes(b"kept")
    wanted = spark.createDataFrame([("a.mp3",), ("sub/b.mp3",), ("sub/b.mp3",), ("no.mp3",)], "file string")
    found = files.listing(spark, str(source))
    assert {r.file for r in found.collect()} == {"a.mp3", "sub/b.mp3"}
    assert manifest.existing(wanted, found).count() == 3 and manifest.absent(wanted, found).count() == 1
    copied, missing = files.copy_missing(wanted, str(source), "file:" + str(target))
    assert copied == 1 and [r.file for r in missing.collect()] == ["no.mp3"]
    assert (target / "a.mp3").read_bytes() == b"kept" and (target / "sub/b.mp3").exists()
    assert files.copy_missing(wanted, str(source), str(target))[0] == 0
    odd = tmp_path / "x" / "a+b" / "clips" / "x" / "clips"
    odd.mkdir(parents=True)
    (odd / "a b+ä.wav").write_bytes(b"x")
    assert [r.file for r in files.listing(spark, str(tmp_path / "x" / "a+b" / "clips")).collect()] == ["x/clips/a b+ä.wav"]
    assert [r.file for r in files.audio(spark, f"file://{odd}/").collect()] == ["a b+ä.wav"]


def test_srt(spark, tmp_path):
    (tmp_path / "x.srt").write_bytes("﻿1\r\n00:00:01,000 --> 00:00:02,500\r\nline one\r\nline two\r\n\r\n\r\n2\r\n01:00:00.5 --> 01:00:01,25\r\n\r\nnot a block\r\n".encode())
    got = [tuple(r) for r in subtitles.read_srt(spark, str(tmp_path)).orderBy("seg_idx").collect()]
    assert got == [("x.srt", 1, 1000, 2500, "line one\nline two"), ("x.srt", 2, 3_600_500, 3_601_250, "")]
    header = spark.createDataFrame([({"Title": "a", "Language": "x"}, {"Language": "y", "URL": "u"})], "h map<string,string>, n map<string,string>")
    assert header.select(subtitles.patched(header.h, header.n)).first()[0] == {"Title": "a", "Language": "y", "URL": "u"}


def test_plans(spark):
    """Filters and columns reach the scan; semi joins of small sides need no shuffle of the large one."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = docs.where("n_chars > 100").select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(n_chars), GreaterThan(n_chars,100)]" in plan and "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in plan

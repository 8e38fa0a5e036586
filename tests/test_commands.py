"""Commands from end to end on small files."""

import json

import numpy as np

from tonehive.__main__ import main
from tonehive.functions import audio
from tonehive.sources.files import read_csv


def test_subtitles_and_romanising(spark, tmp_path):
    (tmp_path / "a.srt").write_text("1\n00:00:00,500 --> 00:00:01,000\ntsuí\n\n2\n00:00:01,100 --> 00:00:01,900\nua\n")
    p = lambda n: str(tmp_path / n)
    main(["convert-subs", p("a.srt"), p("segs")], spark)
    assert [(r.seg_idx, r.text) for r in read_csv(spark, p("segs")).orderBy("seg_idx").collect()] == [("1", "tsuí"), ("2", "ua")]
    main(["extract-json", p("a.srt"), p("json")], spark)
    assert '{"seg_idx":1,"text":"tsuí"}' in spark.read.text(p("json")).first().value
    (tmp_path / "t.json").write_text('[{"seg_idx":2,"text":"I"}]')
    main(["merge-translations", p("a.srt"), p("t.json"), "a.srt", p("merged")], spark)
    assert {r.text for r in read_csv(spark, p("merged")).collect()} == {"tsuí", "I"}
    main(["add-roman", p("segs"), "--source", "text"], spark)
    assert {r.POJ for r in read_csv(spark, p("segs")).collect()} == {"chúi", "oa"}


def test_slice_and_pack(spark, tmp_path):
    clips = tmp_path / "clips"
    clips.mkdir()
    t = np.arange(32_000) / 16_000
    for n in range(3):
        (clips / f"{n}.wav").write_bytes(audio.write_wav(16_000, np.where(t % 1 < 0.6, 0.3, 0.001) * np.sin(2764 * t)))
    (tmp_path / "m.csv").write_text("index,file,text\n" + "".join(f"{n},{n}.wav,word {n}\n" for n in range(3)))
    (tmp_path / "s.csv").write_text("media,seg_idx,start_ms,end_ms,text\n0.wav,1,100,600,x\n0.wav,2,700,900,y\n")
    p = lambda n: str(tmp_path / n)
    main(["slice", p("s.csv"), str(clips), p("cut"), "--lead", "50", "--tail", "200"], spark)
    assert sorted((r.clip_start, r.clip_end, len(audio.read_wav(bytes(r.wav))[1])) for r in spark.read.parquet(p("cut")).collect()) == [(50, 700, 10_400), (650, 1100, 7200)]
    main(["slice", p("s.csv"), str(clips), p("joined"), "--joined"], spark)
    assert spark.read.parquet(p("joined")).first().clips == 2
    main(["pack", p("m.csv"), str(clips), p("out"), "--name", "made"], spark)
    assert spark.read.parquet(p("out/data")).count() == 3
    main(["stats", p("out/data")], spark)
    main(["pack", p("m.csv"), str(clips), p("picky"), "--max-dur", "1.5", "--sr", "8000", "--workers", "2", "--two-pass", "--val", "0.5"], spark)
    report = json.loads((tmp_path / "picky" / "metadata_overall.json").read_text())
    assert report["stages"]["3_filtered"]["stats"] == {"kept": 0, "dropped": 3, "reasons": {"duration": 3}, "audio_checks_skipped": False}
    assert report["stages"]["1_normalized"]["args"] == {"sr": 8000, "lufs": -23.0, "two_pass": True, "workers": 2}
    part = json.loads((tmp_path / "out" / "metadata_5_packaged.json").read_text())
    assert part["name"] == "packager" and part["args"]["shard_size"] == 500 and part["stats"]["total_samples"] == 3


def test_media_commands(spark, tmp_path, capsys):
    clips = tmp_path / "clips"
    clips.mkdir()
    (clips / "m.wav").write_bytes(audio.write_wav(8000, 0.1 * np.sin(np.arange(24_000))))
    (tmp_path / "s.csv").write_text("media,seg_idx,start_ms,end_ms,text\nm.wav,1,500,900,x\nm.wav,2,1400,2200,y\nm.wav,3,2500,2600,z\n")
    (tmp_path / "h.json").write_text('{"Title": "a", "Language": "x"}')
    p = lambda n: str(tmp_path / n)
    main(["edit-sub", p("s.csv"), p("part"), "--start", "800", "--end", "2000"], spark)
    assert [tuple(r) for r in read_csv(spark, p("part")).orderBy("seg_idx").collect()] == [("m.wav", "1", "0", "100", "x"), ("m.wav", "2", "600", "1200", "y")]
    main(["sync", p("s.csv"), str(clips), p("synced"), "--margin", "100"], spark)
    row = spark.read.parquet(p("synced/media")).first()
    assert row.offset_ms == 400 and len(audio.read_wav(bytes(row.wav))[1]) == 8000 * 2300 // 1000
    assert {(r.start_ms, r.end_ms) for r in read_csv(spark, p("synced/segments")).collect()} == {("100", "500"), ("1000", "1800"), ("2100", "2200")}
    main(["patch-meta", p("h.json"), "--set", "Language=y", "--set", "URL=a=b"], spark)
    assert json.loads((tmp_path / "h.json").read_text()) == {"Title": "a", "Language": "y", "URL": "a=b"}
    main(["convert", str(clips), p("converted"), "--rate", "16000", "--two-pass"], spark)
    row = spark.read.parquet(p("converted")).first()
    rate, x = audio.read_wav(bytes(row.wav))
    assert rate == 16_000 and abs(audio.loudness(x[:, 0], rate) + 23) < 0.1 and row.error is None
    capsys.readouterr()
    main(["inspect", str(clips)], spark)
    assert "|m.wav|8000|1       |16  |3.0    |" in capsys.readouterr().out


def test_prepare_and_merge_column(spark, tmp_path):
    (tmp_path / "sounds").mkdir()
    (tmp_path / "sounds" / "a.mp3").write_bytes(b"x")
    (tmp_path / "t.csv").write_text("word,word_audio\n\"x, y\",a\nz,gone\n", encoding="utf-8")
    p = lambda n: str(tmp_path / n)
    for _ in range(2):
        main(["prepare", p("t.csv"), p("out"), "--dataset", f"words=word,word_audio,{p('sounds')}"], spark)
        assert (tmp_path / "out/words/clips/_manifest.csv").read_text() == 'index,file,text\n0,a.mp3,"x, y"\n'
        assert (tmp_path / "out/words/clips/a.mp3").read_bytes() == b"x"
    (tmp_path / "l.csv").write_text("k,old,n\na,1,7\nb,2,8\n")
    (tmp_path / "r.csv").write_text("k,new\na,x\nb,y\n")
    main(["merge-column", p("l.csv"), p("r.csv"), "k", "old", "new"], spark)
    assert sorted((tmp_path / "l.csv").read_text().splitlines()) == ["a,x,7", "b,y,8", "k,old,n"]

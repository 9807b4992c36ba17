"""Span, phrase and dataset operators against hand-traced cases and sequential versions."""

import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from fonolith.errors import PipelineError
from fonolith.operators import dataset, phrases
from fonolith.operators.spans import merge_adjacent, timeline
from fonolith.operators.words import spans_of, transcripts, valid_words, with_visemes
from fonolith.plans import pipelines
from fonolith.schema import SEGMENT as SEGMENT_TYPE
from fonolith.sources.sinks import write_metadata
from fonolith.sources.transcripts import ensure_audio_input, read_documents, read_transcripts, segments_of, transcribe

SPAN = "audio_id long, seq long, viseme string, start_ms double, end_ms double"
WORD = "array<struct<word:string,start_ms:bigint,end_ms:bigint>>"
SEGMENT = f"audio_id long, seg long, text string, start_ms long, end_ms long, words {WORD}"


def by_order(df, *columns):
    return [tuple(r) for r in df.orderBy("audio_id", columns[0]).select(*columns[1:]).collect()]


def fold(spans, tolerance):
    out = []
    for v, a, z in sorted(spans, key=lambda s: s[1:]):
        if z <= a:
            continue
        if out and out[-1][0] == v and a <= out[-1][2] + tolerance:
            out[-1][2] = max(out[-1][2], z)
        elif not out or z > max(a, out[-1][2]):
            out.append([v, max(a, out[-1][2]) if out else a, z])
    return [tuple(s) for s in out]


def fold_timeline(spans, silence, threshold):
    out, cursor = [], 0.0
    for v, a, z in sorted(spans, key=lambda s: s[1:]):
        if silence and a - cursor >= threshold:
            out.append(("SIL", cursor, a))
        if z > max(a, cursor):
            out.append((v, max(a, cursor), z))
        cursor = max(cursor, z)
    return fold(out, 1)


def test_merge_case(spark):
    spans = [("A", 0, 1000), ("A", 1000.5, 2000), ("B", 1500, 1900), ("B", 1800, 2500), ("B", 2500.5, 3000), ("A", 2600, 2600)]
    rows = spark.createDataFrame([(1, i, v, float(a), float(z)) for i, (v, a, z) in enumerate(spans)], SPAN)
    assert by_order(merge_adjacent(rows), "seq", "viseme", "start_ms", "end_ms") == [("A", 0.0, 2000.0), ("B", 2000.0, 3000.0)]


def test_random_spans(spark):
    rng, sets = random.Random(4), {}
    for k in range(60):
        sets[k] = [(rng.choice("AB"), float(a := rng.randrange(400) * 10), float(a + rng.randrange(40) * 10)) for _ in range(rng.randrange(1, 14))]
    rows = spark.createDataFrame([(k, i, *s) for k, v in sets.items() for i, s in enumerate(v)], SPAN)
    for df, want in (
        (merge_adjacent(rows), lambda s: fold(s, 1)),
        (timeline(rows), lambda s: fold_timeline(s, True, 60)),
        (timeline(rows, threshold=0.0), lambda s: fold_timeline(s, True, 0)),
        (timeline(rows, silence=False), lambda s: fold_timeline(s, False, 0)),
        (merge_adjacent(merge_adjacent(rows)), lambda s: fold(s, 1)),
    ):
        got = {k: [] for k in sets}
        for r in df.orderBy("audio_id", "seq").collect():
            got[r.audio_id].append((r.viseme, r.start_ms, r.end_ms))
        for k, s in sets.items():
            # of spans with equal times any may come first, so only sets whose result doesn't depend on it are exact
            if len({x[1:] for x in s}) == len(s):
                assert got[k] == want(s), (k, s)


def test_long_recordings(spark):
    """Recordings that are named as long give the same spans, though none of them is in one task."""
    rng, rows = random.Random(9), []
    for k in range(6):
        for i in range(rng.choice([0, 1, 30, 200])):
            a = rng.randrange(900) * 10
            rows.append((k, i, rng.choice("AB"), float(a), float(a + rng.randrange(12) * 10)))
    spans = spark.createDataFrame(rows, SPAN)
    long = spark.createDataFrame([(k,) for k in (0, 2, 3, 5)], "audio_id long")
    words = spans.select("audio_id", F.col("seq").alias("word_idx"), F.col("viseme").alias("word"), F.col("start_ms").cast("long").alias("start_ms"), F.col("end_ms").cast("long").alias("end_ms"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for f, df in ((merge_adjacent, spans), (timeline, spans), (valid_words, words)):
            assert sorted(map(tuple, f(df, long=long).collect())) == sorted(map(tuple, f(df).collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_all_events_as_one_recording(spark, duck):
    """The spans of all events merged as those of one long recording, by many tasks, equal the SQL's."""
    from fonolith.plans.oracle import SQL
    from fonolith.sources import derived

    sql = SQL["merge_overlapping"].replace("user_id", "CAST(0 AS BIGINT)")
    spans = derived.overlapping_spans(spark, "/root/testdata/sf0.001").withColumn("audio_id", F.lit(0).cast("long"))
    merged = merge_adjacent(spans, long=spans.select("audio_id").distinct())
    got = sorted((r.seq, r.viseme, r.start_ms, r.end_ms) for r in merged.collect())
    want = sorted((r[1], r[2], r[3], r[4]) for r in duck.sql(f'SELECT audio_id, idx, viseme, start * 1000, "end" * 1000 FROM ({sql})').fetchall())
    assert len(got) == len(want) > 1 and all(g[:2] == w[:2] and abs(g[2] - w[2]) < 1e-3 and abs(g[3] - w[3]) < 1e-3 for g, w in zip(got, want, strict=True))


def test_timeline_case(spark):
    words = [("hola", 520, 980), ("mundo", 1000, 1400), ("2024", 1400, 1900), ("Sí", 2500, 2710)]
    rows = spark.createDataFrame([(1, i, *w) for i, w in enumerate(words)], "audio_id long, word_idx long, word string, start_ms long, end_ms long")
    line = timeline(spans_of(with_visemes(rows)))
    got = [(v, round(a / 1000 + 1e-9, 3), round(z / 1000 + 1e-9, 3)) for v, a, z in by_order(line, "seq", "viseme", "start_ms", "end_ms")]
    assert got == [
        ("SIL", 0.0, 0.52), ("OO", 0.52, 0.68), ("TD", 0.68, 0.813), ("AA", 0.813, 0.98), ("PP", 1.0, 1.075), ("UU", 1.075, 1.158), ("TD", 1.158, 1.309),
        ("OO", 1.309, 1.4), ("SIL", 1.4, 2.5), ("SS", 2.5, 2.6), ("II", 2.6, 2.71),
    ]


def words_of(*items):
    return [(w, a, z) for w, a, z in items]


def test_phrase_order(spark):
    rows = [
        (1, 1, "x", 0, 1200, words_of(("Hola", 0, 400), ("mundo.", 500, 900), ("Que", 1000, 1200))),
        (1, 2, "solo texto", 2000, 3000, []),
        (1, 3, "y", 3000, 3900, words_of(("tal?", 3000, 3400), ("fin", 3500, 3900))),
        (2, 1, "  ", 0, 1, []),
    ]
    got = by_order(phrases.build_phrases(spark.createDataFrame(rows, SEGMENT)), "phrase_idx", "text", "start_ms", "end_ms")
    assert got == [("Hola mundo.", 0, 900), ("solo texto", 2000, 3000), ("Que tal?", 1000, 3400), ("fin", 3500, 3900)]


PHRASE = f"audio_id long, phrase_idx long, start_ms long, end_ms long, text string, words {WORD}"


def test_split(spark):
    a = words_of(("a", 0, 3000), ("b", 3000, 6000), ("c", 6000, 7000), ("d", 7000, 9000))
    b = words_of(("a", 0, 3000), ("b", 3000, 6000), ("c", 6000, 7000))
    one = words_of(("a", 0, 9000))
    rows = [(1, 1, 0, 9000, "t", a), (2, 1, 0, 7000, "kept", b), (3, 1, 0, 9000, "t", one), (4, 1, 0, None, "u", []), (5, 1, 0, 90000, "v", [])]
    got = by_order(phrases.split_long(spark.createDataFrame(rows, PHRASE)), "phrase_idx", "audio_id", "start_ms", "end_ms", "text")
    assert got == [(1, 0, 6000, "a b"), (1, 6000, 9000, "c d"), (2, 0, 7000, "kept"), (3, 0, 9000, "a"), (4, 0, None, "u"), (5, 0, 90000, "v")]


def test_merge_short(spark):
    rows = [(1, 1, 0, 1000, "a", []), (1, 2, 1000, 2600, "b", []), (1, 3, 2600, 3000, "c", []), (2, 1, 0, 500, "solo", []), (2, 2, 500, 2500, "a b.", words_of(("a", 500, 900), ("b.", 1000, 2500)))]
    got = by_order(phrases.merge_short(spark.createDataFrame(rows, PHRASE)), "phrase_idx", "audio_id", "start_ms", "end_ms", "text")
    assert got == [(1, 0, 2600, "a b"), (1, 2600, 3000, "c"), (2, 500, 2500, "a b.")]


def test_long_phrases(spark):
    """Phrases and recordings that are cut as chains of rows come out as by the folds; some have times out of order or none."""
    rng, rows = random.Random(12), []
    for k in range(8):
        t = 0
        for i in range(1, rng.choice([2, 12, 40]) + 1):
            words = []
            for j in range(rng.choice([0, 1, 3, 25])):
                a, t = t + rng.randrange(300), t + rng.randrange(300, 900)
                words.append((f"w{j}", a, None if k == 6 and j == 2 else t - 5000 if k == 7 and j == 1 else t))
            start, end = (words[0][1], words[-1][2]) if words else (t, None if k == 5 and i == 3 else t + 700)
            t = max(t, end or 0)
            rows.append((k, i, start, end, f"text {i}", words))
    df = spark.createDataFrame(rows, PHRASE)
    long = spark.createDataFrame([(k,) for k in range(1, 8)], "audio_id long")
    plain, split = phrases.split_long(df, 4000), phrases.split_long(df, 4000, many=2)
    shown = lambda x: sorted(map(str, x.collect()))
    assert shown(split) == shown(plain) and plain.count() > df.count()
    assert shown(phrases.merge_short(df, 1500, long)) == shown(phrases.merge_short(df, 1500))
    assert shown(phrases.normalize_phrases(df, 2500, 4000, long, 2)) == shown(phrases.normalize_phrases(df, 2500, 4000))


def test_cascade_and_cuts(spark):
    rows = [(1, 0, "a", 0, None), (1, 1, "a", 2000, 2000), (1, 2, " \n", 0, 900), (1, 3, "a", 0, 300), (1, 4, "a", 0, 500), (1, 5, "a", 0, 10000), (1, 6, "a", 0, 10100)]
    df = spark.createDataFrame([(*r, []) for r in rows], SEGMENT)
    assert by_order(dataset.with_skip_reason(df, longest=10000), "seg", "skip_reason") == [("missing timestamps",), ("end <= start",), ("empty text",), ("too short",), (None,), (None,), ("too long",)]
    cut = [(1, 0, "a", 1000, 2000, words_of(("a", 1100, 1500), ("b", 1500, 1900))), (1, 1, "a", 1000, 2000, []), (1, 2, "a", 1000, 2000, words_of(("a", None, 1500)))]
    assert by_order(dataset.cut_list(spark.createDataFrame(cut, SEGMENT)), "seg", "cut_start_ms", "cut_ms") == [(1100, 1050), (1000, 1250), (1000, 1250)]


def test_clip_numbers(spark):
    rows = spark.createDataFrame([(1, 2, "canc"), (1, 5, "canc"), (2, 1, "otro"), (3, 0, "canc")], "audio_id long, seg long, prefix string")
    listing = spark.createDataFrame([("canc", "canc_000007.wav", True), ("canc", "canc_0000099.wav", True), ("canc", "canc_000050.wav", False), ("canc", "canc_00008.wav", True)], "prefix string, name string, is_file boolean")
    got = [r.filename for r in dataset.clip_names(rows, dataset.max_suffix(listing)).orderBy("audio_id", "seg").collect()]
    assert got == ["canc_000008.wav", "canc_000009.wav", "otro_000001.wav", "canc_000010.wav"]


def test_metadata_bytes(spark, tmp_path):
    """One file in the order of names, though many tasks write it, in place of what was there."""
    rows = [("a_000001.wav", 'say "hi"', "x"), ("a_2.wav", " lead", "p|q"), ("a_3.wav", None, "ñ"), ("a_4.wav", "two\nlines", "")]
    path = tmp_path / "m" / "metadata.csv"
    (path / "was").mkdir(parents=True)
    write_metadata(spark.createDataFrame(rows[::-1], "filename string, raw_text string, norm_text string").repartition(4), str(path))
    assert path.read_bytes().decode() == 'a_000001.wav|"say ""hi"""|x\na_2.wav| lead|"p|q"\na_3.wav||ñ\na_4.wav|"two\nlines"|\n'
    many = spark.range(3000).select(F.format_string("c_%06d.wav", "id").alias("filename"), F.repeat(F.lit("é"), (F.col("id") % 50).cast("int")).alias("norm_text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_metadata(many.repartition(6), str(path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert path.read_text() == "".join(f"c_{i:06d}.wav|{'é' * (i % 50)}\n" for i in range(3000))
    assert [p.name for p in path.parent.iterdir()] == ["metadata.csv"]
    write_metadata(many.limit(0), str(path))
    assert path.read_text() == ""


def test_words_and_transcripts(spark):
    raw = spark.createDataFrame([(1, 0, " b ", 5, 9), (1, 1, "a", 1, 5), (1, 2, " ", 1, 5), (1, 3, "c", None, 5), (1, 4, "d", 5, 5)], "audio_id long, word_idx long, word string, start_ms long, end_ms long")
    words = valid_words(raw)
    assert by_order(words, "word_idx", "word_idx", "word") == [(0, "a"), (1, "b")]
    none = spark.createDataFrame([(1, 0, " ", 0, 1, [])], SEGMENT)
    assert [r.transcript for r in transcripts(none, words).collect()] == ["a b"]
    some = spark.createDataFrame([(1, 1, "dos", 0, 1, []), (1, 0, " uno ", 0, 1, [])], SEGMENT)
    assert [r.transcript for r in transcripts(some, words).collect()] == ["uno dos"]


DOCUMENT = {
    "audio_file": "/x/Canción.mp3", "model": "m", "language": "es", "text": "t",
    "segments": [
        {"id": 0, "start": 0.5, "end": 2.0, "text": " Hola mundo. ", "words": [{"word": "Hola", "start": 0.5, "end": 1.0}, {"text": "mundo.", "start": 1.1, "end": 2.0}]},
        {"id": 1, "start": 2.5, "end": "x", "text": "malo"},
        {"id": 2, "start": 3.0, "end": 3.2, "text": "corto", "words": []},
    ],
}


def test_documents_to_outputs(spark, tmp_path):
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(DOCUMENT, indent=1))
    docs = read_transcripts(spark, str(path))
    assert read_transcripts(spark, docs) is docs
    main, cues = pipelines.viseme_payloads(spark, docs, single=True)
    payload = json.loads(main.first().payload)
    assert [w["word"] for w in payload["words"]] == ["hola", "mundo"]
    assert payload["transcript"] == "Hola mundo. malo corto" and payload["metadata"]["timestamp_precision_decimals"] == 3
    assert payload["timeline"][0] == {"viseme": "SIL", "start": 0.0, "end": 0.5}
    assert [c["value"] for c in json.loads(cues.first().payload)["mouthCues"]] == [s["viseme"] for s in payload["timeline"]]
    again = json.loads(pipelines.transcript_payloads(spark, docs).first().payload)
    assert [s["text"] for s in again["segments"]] == ["Hola mundo.", "malo", "corto"]
    assert again["phrases"][0]["text"] == "Hola mundo." and again["phrases"][0]["start"] == 0.5
    summary = pipelines.build_dataset(spark, docs, str(tmp_path / "out"), pipelines.DatasetOptions(export=False)).first()
    assert (summary.total_segments, summary.exported_segments, summary.skipped_segments, summary.audio_prefix) == (3, 1, 2, "canc")
    lines = (tmp_path / "out/metadata.csv").read_text()
    assert lines == "canc_000001.wav|Hola mundo.|Hola mundo\n"
    assert segments_of(docs).where(F.col("end_ms").isNull()).count() == 1


ENCODER = str(pathlib.Path(__file__).parent / "bin" / "encoder")


def cut_document(audio, texts):
    return {"audio_file": str(audio), "segments": [{"id": i, "start": a, "end": z, "text": t, "words": [{"word": t, "start": a, "end": z}]} for i, (t, a, z) in enumerate(texts)]}


def test_export(spark, tmp_path, caplog):
    """Each name of metadata.csv is a file in wavs, numbered on without gaps; of a call that fails, clips are cut one by one."""
    audio = tmp_path / "Canción.mp3"
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(cut_document(audio, [("uno", 0.0, 1.0), ("dos", 1.0, 2.5), ("malo", 9.0, 11.0), ("corto", 11.0, 11.1), ("tres", 12.0, 14.0)])))
    out = tmp_path / "out"
    options = pipelines.DatasetOptions(sample_rate=16_000, encoder=ENCODER)
    with pytest.raises(FileNotFoundError, match="mp3"):
        pipelines.build_dataset(spark, str(path), str(out), options)
    audio.write_text("x")
    with pytest.raises(PipelineError, match="no-such-encoder"):
        pipelines.build_dataset(spark, str(path), str(out), pipelines.DatasetOptions(encoder="no-such-encoder"))
    (out / "wavs").mkdir(parents=True, exist_ok=True)
    (out / "wavs/canc_000004.wav").write_text("there before")
    caplog.set_level("INFO", logger="fonolith.plans.pipelines")
    summary = pipelines.build_dataset(spark, str(path), str(out), options).collect()
    assert "segments: {'total': 5, 'exported': 3, 'too short': 1, 'export failed': 1}" in caplog.text
    assert [(r.total_segments, r.exported_segments, r.skipped_segments, r.sample_rate) for r in summary] == [(5, 3, 2, 16_000)]
    lines = (out / "metadata.csv").read_text().split()
    assert lines == ["canc_000005.wav|uno|uno", "canc_000006.wav|dos|dos", "canc_000007.wav|tres|tres"]
    assert sorted(p.name for p in (out / "wavs").iterdir()) == [f"canc_{i:06d}.wav" for i in (4, 5, 6, 7)]
    assert "-ss 1.000 -t 1.750 -ar 16000 -ac 1 -sample_fmt s16" in (out / "wavs/canc_000006.wav").read_text()
    assert (tmp_path / "Canción.mp3.calls").read_text().split() == ["failed", "cut+", "cut+", "failed", "cut+"]


def test_one_call_a_recording(spark, tmp_path, monkeypatch):
    """A recording is decoded once; a long one in stretches, each read from its first clip on."""
    from fonolith.sources import sinks

    cuts = [(str(tmp_path / f"{name}.mp3"), f"{name}{i}.wav", 2000 * i, 1500) for name in ("a", "b") for i in range(7)]
    rows = lambda: spark.createDataFrame(cuts, "audio_file string, filename string, cut_start_ms long, cut_ms long").repartition(5)
    wavs = tmp_path / "wavs"
    wavs.mkdir()
    done = sinks.export_clips(rows().where("cut_start_ms <> 8000"), str(wavs), encoder=ENCODER).collect()
    assert all(r.ok for r in done) and len(done) == 12
    assert [(tmp_path / f"{n}.mp3.calls").read_text() for n in "ab"] == ["cut++++++\n"] * 2
    assert (wavs / "a3.wav").read_text() == "RIFF -i | -ss 6.000 -t 1.500 -ar 22050 -ac 1 -sample_fmt s16\n"
    monkeypatch.setattr(sinks, "STRETCH_MS", 5000)
    monkeypatch.setattr(sinks, "CLIPS", 2)
    cuts = cuts[:4]
    sinks.export_clips(rows(), str(wavs), encoder=ENCODER).collect()
    assert sorted((tmp_path / "a.mp3.calls").read_text().split()[1:]) == ["cut+", "cut+", "cut++"]
    assert (wavs / "a3.wav").read_text() == "RIFF -ss 6.000 -i | -ss 0.000 -t 1.500 -ar 22050 -ac 1 -sample_fmt s16\n"


def test_encoder_that_hangs(spark, tmp_path):
    """A call beyond its time is stopped, and only the clip that it hangs on fails."""
    from fonolith.sources import sinks

    rows = spark.createDataFrame([(str(tmp_path / "a.mp3"), f"{s}.wav", s, 1000) for s in (1000, 8000, 10_000)], "audio_file string, filename string, cut_start_ms long, cut_ms long")
    done = sinks.export_clips(rows, str(tmp_path), encoder=ENCODER, limit=2).collect()
    assert sorted((r.filename, r.ok, r.message) for r in done) == [("1000.wav", True, ""), ("10000.wav", True, ""), ("8000.wav", False, "stopped after 2 seconds")]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["1000.wav", "10000.wav", "a.mp3.calls"]


def test_paths_that_are_not_mounted(spark, tmp_path):
    docs = spark.createDataFrame([("hdfs://x/a.wav", "es", [])], f"audio_file string, language string, segments array<{SEGMENT_TYPE}>")
    with pytest.raises(PipelineError, match="hdfs://x/a.wav"):
        pipelines.build_dataset(spark, docs, str(tmp_path / "out"), pipelines.DatasetOptions(encoder=ENCODER))
    with pytest.raises(PipelineError, match="s3a://b/out"):
        pipelines.build_dataset(spark, docs, "s3a://b/out", pipelines.DatasetOptions(export=False))


def test_files_that_are_no_documents(spark, tmp_path):
    """A broken file is an error, or is listed with its reason while the others go on."""
    folder = tmp_path / "in"
    folder.mkdir()
    for name, text in (("a", json.dumps(DOCUMENT)), ("b", '{"audio_file": "x.wav", "segments": [{'), ("c", ""), ("d", '{"other": 1}'), ("e", "[]"), ("f", '{"audio_file": 7, "segments": "none"}'), ("g", "plain")):
        (folder / f"{name}.json").write_text(text)
    documents, rejected = read_documents(spark, str(folder))
    assert {r.document[-6:]: r.reason for r in rejected.collect()} == {"b.json": "no JSON", "c.json": "nothing in it", "d.json": "no field of a transcript", "e.json": "nothing in it", "g.json": "no JSON"}
    assert {r.document[-6:] for r in documents.collect()} == {"a.json", "f.json"}
    with pytest.raises(PipelineError, match="b.json is no transcript: no JSON"):
        read_transcripts(spark, str(folder))
    main, _ = pipelines.viseme_payloads(spark, str(folder), pipelines.VisemeOptions(quarantine=str(tmp_path / "bad.jsonl")))
    assert main.count() == 1
    assert [json.loads(x)["document"][-6:] for x in (tmp_path / "bad.jsonl").read_text().splitlines()] == ["b.json", "c.json", "d.json", "e.json", "g.json"]
    read_transcripts(spark, str(folder / "a.json"), str(tmp_path / "bad.jsonl"))
    assert (tmp_path / "bad.jsonl").read_text() == ""


def test_payloads_in_pieces(spark, tmp_path):
    """Files written in pieces, by tasks that share recordings, have the very texts of the payloads."""
    segments = [{"id": i, "start": i * 1.0, "end": i + 0.9, "text": f"palabra {i}", "words": [{"word": w, "start": i + 0.1, "end": i + 0.8}]} for i, w in enumerate(["hola", "¡!", "mundo", "a\\b", 'di "que"'] * 40)]
    docs = [{"audio_file": f'{k}"ñ.wav', "segments": segments[k : k + n]} for k, n in ((0, 1), (1, 1), (3, 150), (2, 199))] + [DOCUMENT]
    (tmp_path / "in").mkdir()
    for k, d in enumerate(docs):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps(d))
    main, cues = pipelines.viseme_payloads(spark, str(tmp_path / "in"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pipelines.write_visemes(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cues"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for want, folder in ((main, "out"), (cues, "cues")):
        got = {p.name: p.read_text() for p in (tmp_path / folder).iterdir()}
        assert got == {f"{r.audio_id}.json": r.payload for r in want.collect()} and len(got) == 4


def test_probability_is_kept(spark, tmp_path):
    words = [{"word": "uno.", "start": 0.0, "end": 0.5, "probability": 0.75}, {"word": "dos", "start": 0.5, "end": 1.0}]
    (tmp_path / "p.json").write_text(json.dumps({"audio_file": "p.wav", "segments": [{"id": 0, "start": 0.0, "end": 1.0, "text": "uno. dos", "words": words}]}))
    for normalize in (True, False):
        got = json.loads(pipelines.transcript_payloads(spark, str(tmp_path / "p.json"), pipelines.TranscriptOptions(normalize_phrases=normalize)).first().payload)
        assert [w["probability"] for w in got["segments"][0]["words"]] == [0.75, None]
        assert [w["probability"] for p in got["phrases"] for w in p["words"]] == [0.75, None]


def test_documents_of_one_file_name(spark):
    """Two documents that name the same audio file, or none, are two recordings."""
    rows = [(name, "es", [(0, 0.0, 1.0, text, [(text, None, 0.0, 1.0, None)])]) for name, text in (("a.wav", "uno"), ("a.wav", "dos"), (None, "tres"), (None, "cuatro"))]
    docs = spark.createDataFrame(rows, f"audio_file string, language string, segments array<{SEGMENT_TYPE}>")
    assert segments_of(docs).select("audio_id").distinct().count() == 4
    assert pipelines.viseme_payloads(spark, docs)[0].count() == 4


def test_one_reading_of_spelling(spark):
    """Nothing of the way from words to timelines is planned, and so computed, twice."""
    from fonolith.plans.queries import QUERIES

    plan = QUERIES["timeline_sil"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gü(?=[ei])") == 1


def test_words_are_normalized_once(spark):
    """A word is normalized once, not for a filter and for its column; a time that two spans share becomes text once."""
    from fonolith.plans.queries import QUERIES

    plan = QUERIES["main_words"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("^[^a-z0-9ñü]+") == 1
    assert "format_string" not in plan and plan.count("as decimal(20,3)") == 1


def test_rejected_alone(spark, tmp_path, monkeypatch):
    """What is rejected is the same without the documents, of which nothing but names is written then."""
    from fonolith.plans.queries import QUERIES
    from fonolith.sources import transcripts as t

    for name, text in {"a": '{"text": "x"}', "b": "", "c": "{", "d": '{"pages": [1]}', "e": '{"segments": [], "text": 3}'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    written = []
    monkeypatch.setattr(t, "materialize", lambda df, to=t.materialize: written.append(df.columns) or to(df))
    assert sorted(t.rejected_documents(spark, str(tmp_path)).collect()) == sorted(t.read_documents(spark, str(tmp_path))[1].collect())
    written.clear()
    QUERIES["rejected_documents"](spark, "/root/testdata/sf0.001").collect()
    assert written == [["document", "reason"]]


def test_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_transcripts(spark, str(tmp_path / "none.json"))
    (tmp_path / "a.txt").write_text("x")
    (tmp_path / "a.wav").write_text("x")
    with pytest.raises(PipelineError, match="m4a, .mp3, .wav"):
        ensure_audio_input(spark, str(tmp_path / "a.txt"))
    with pytest.raises(PipelineError):
        ensure_audio_input(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        ensure_audio_input(spark, str(tmp_path / "b.wav"))
    ensure_audio_input(spark, str(tmp_path / "a.wav"))
    with pytest.raises(PipelineError):
        transcribe(spark.range(1), None)
    empty = spark.createDataFrame([({"audio_file": "a.wav", "segments": []})], "audio_file string, language string, segments array<struct<id:bigint,start:double,end:double,text:string,words:array<struct<word:string,text:string,start:double,end:double,probability:double>>>>")
    with pytest.raises(PipelineError):
        pipelines.viseme_payloads(spark, empty, single=True)


def test_recordings_do_not_depend_on_each_other(spark):
    from fonolith.sources import derived

    words = derived.words(spark, "/root/testdata/sf0.001")
    some = words.select("audio_id").distinct().orderBy("audio_id").limit(2)
    line = lambda w: timeline(spans_of(with_visemes(w)))
    one = sorted(map(tuple, line(words.join(some, "audio_id")).collect()))
    assert one == sorted(map(tuple, line(words).join(some, "audio_id").select("audio_id", "seq", "viseme", "start_ms", "end_ms").collect()))

"""Streams of transcript documents."""

import json

from fonolith.plans.pipelines import viseme_payloads
from fonolith.sources.transcripts import read_transcripts
from fonolith.streaming.transcripts import follow_visemes, read_transcript_stream, segment_counts


def document(name, words):
    segments = [{"id": 0, "start": 0.0, "end": 9.0, "text": " ".join(words), "words": [{"word": w, "start": i, "end": i + 0.9} for i, w in enumerate(words)]}, {"id": 1, "start": 9.0, "text": "x"}]
    return {"audio_file": f"/{name}.wav", "language": "es", "segments": segments}


def test_follow(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for number, words in enumerate((["hola", "mundo"], ["buenos", "días"])):
        (source / f"{number}.json").write_text(json.dumps(document(f"a{number}", words)))
        follow_visemes(spark, str(source), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("audio_id", "payload").collect()
    want = viseme_payloads(spark, read_transcripts(spark, str(source)))[0].collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 2


def test_counts(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps(document("a", ["hola"])))
    query = segment_counts(read_transcript_stream(spark, str(tmp_path))).writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {r.skip_reason: r.segments for r in spark.table("counted").collect()} == {None: 1, "missing timestamps": 1}

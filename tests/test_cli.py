"""The command line."""

import json

from fonolith.__main__ import main
from tests.test_operators import DOCUMENT


def test_commands(spark, tmp_path):
    source = tmp_path / "doc.json"
    source.write_text(json.dumps(DOCUMENT))
    read = lambda name: [json.loads((tmp_path / name).read_text())]
    assert main(["visemes", "--input", str(source), "--output", str(tmp_path / "v"), "--mouth-cues", str(tmp_path / "c"), "--skip-silence-cues"]) == 0
    assert read("v")[0]["timeline"][0]["viseme"] == "OO" and read("c")[0]["mouthCues"][0] == {"value": "OO", "start": 0.5, "end": read("v")[0]["timeline"][0]["end"]}
    assert main(["transcript", "--input", str(source), "--output", str(tmp_path / "t"), "--no-normalize-phrases", "--language", "es"]) == 0
    assert read("t")[0]["language"] == "es" and len(read("t")[0]["phrases"]) == 3
    assert main(["dataset", "--input", str(source), "--output", str(tmp_path / "d"), "--format", "piper", "--min-duration", "0.1", "--no-export"]) == 0
    assert (tmp_path / "d/metadata.csv").read_text() == "canc_000001.wav|Hola mundo\ncanc_000002.wav|corto\n"


def test_exit_codes(spark, tmp_path):
    assert main(["visemes", "--input", str(tmp_path / "none.json"), "--output", str(tmp_path / "v")]) == 1
    (tmp_path / "empty.json").write_text(json.dumps({"audio_file": "a.wav", "segments": []}))
    assert main(["visemes", "--input", str(tmp_path / "empty.json"), "--output", str(tmp_path / "v")]) == 2
    (tmp_path / "lost.json").write_text(json.dumps({"audio_file": str(tmp_path / "lost.wav"), "segments": [{"id": 1}]}))
    assert main(["dataset", "--input", str(tmp_path / "lost.json"), "--output", str(tmp_path / "d")]) == 2
    assert main(["dataset", "--input", str(tmp_path / "none.json"), "--output", str(tmp_path / "d")]) == 1
    (tmp_path / "broken.json").write_text("{")
    assert main(["transcript", "--input", str(tmp_path / "broken.json"), "--output", str(tmp_path / "t")]) == 2
    (tmp_path / "nameless.json").write_text(json.dumps({"segments": [{"id": 1}]}))
    assert main(["dataset", "--input", str(tmp_path / "nameless.json"), "--output", str(tmp_path / "d")]) == 2


def test_audio_to_outputs(spark, tmp_path):
    """From an audio file, by way of a recognizer, to payloads, cues and transcript documents."""
    audio = tmp_path / "talk.wav"
    audio.write_text(json.dumps({"language": "ES", "segments": DOCUMENT["segments"][:1]}))
    read = lambda name: [json.loads((tmp_path / name).read_text())]
    by = ["--input", str(audio), "--recognizer", "tests.recognizer:from_json"]
    assert main(["visemes", *by, "--output", str(tmp_path / "v"), "--beam-size", "3", "--model", "tiny"]) == 0
    (got,) = read("v")
    assert [w["word"] for w in got["words"]] == ["hola", "mundo"] and got["language"] == "es" and got["metadata"]["model"] == "tiny"
    assert got["audio_file"].endswith("talk.wav") and got["transcript"] == "Hola mundo."
    assert main(["transcript", *by]) == 0
    (got,) = read("talk.json")
    assert got["phrases"][0]["text"] == "Hola mundo." and got["model"] == "large-v3"
    assert main(["visemes", "--input", str(audio), "--output", str(tmp_path / "w")]) == 2  # no recognizer
    assert main(["visemes", "--input", str(tmp_path / "none.wav"), "--output", str(tmp_path / "w")]) == 1


def test_a_model_is_loaded_once_a_worker(spark, tmp_path):
    from fonolith.sources.transcripts import RecognizerOptions, audio_files, transcribe
    from tests.recognizer import LOADED

    (tmp_path / "in").mkdir()
    for i in range(24):
        (tmp_path / "in" / f"{i}.wav").write_text(json.dumps({"language": "es", "segments": []}))
    audio, options = audio_files(spark, str(tmp_path / "in")).repartition(24), RecognizerOptions(model=str(tmp_path / "loaded"))
    for _ in range(2):
        assert transcribe(audio, LOADED, options).count() == 24
    workers = (tmp_path / "loaded").read_text().split()
    assert len(workers) == len(set(workers)) < 24
    by = ["--input", str(tmp_path / "in" / "1.wav"), "--recognizer", "tests.recognizer:LOADED", "--model", str(tmp_path / "cli")]
    assert main(["transcript", *by, "--output", str(tmp_path / "t")]) == 0 and (tmp_path / "cli").exists()


def test_fetch(tmp_path, capsys):
    folder = tmp_path / "new"
    assert main(["fetch", "https://example.org/talk", "--output-dir", str(folder), "--format", "opus", "--fetcher", "tests.recognizer:fetch"]) == 0
    assert capsys.readouterr().out.strip() == f"{folder}/talk.opus" and (folder / "talk.opus").read_text() == "https://example.org/talk"
    assert main(["fetch", "x", "--output-dir", str(folder)]) == 2 and main(["fetch", "x", "--fetcher", "tests.none:f"]) == 2


def test_a_folder_of_documents(spark, tmp_path):
    """One file for each recording, named after it, that can be read again."""
    (tmp_path / "in").mkdir()
    for i in range(5):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps({**DOCUMENT, "audio_file": f"{i}.wav"}))
    (tmp_path / "in" / "bad.json").write_text("{")
    assert main(["transcript", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--quarantine", str(tmp_path / "bad.jsonl")]) == 0
    names = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert len(names) == 5 and all(n.endswith(".json") for n in names)
    assert sorted(json.loads((tmp_path / "out" / n).read_text())["audio_file"] for n in names) == [f"{i}.wav" for i in range(5)]
    assert "no JSON" in (tmp_path / "bad.jsonl").read_text()
    assert main(["transcript", "--input", str(tmp_path / "out"), "--output", str(tmp_path / "again")]) == 0
    assert len(list((tmp_path / "again").iterdir())) == 5


def test_fetch_many(spark, tmp_path, capsys):
    """Each address of a table gives a file, or a reason."""
    from fonolith.sources.transcripts import fetch_table
    from tests.recognizer import fetch

    addresses = [(f"https://example.org/{i}",) for i in range(20)] + [("https://example.org/lost",), ("https://example.org/3",), (None,)]
    got = fetch_table(spark.createDataFrame(addresses, "address string"), str(tmp_path / "a"), fetch, "wav").collect()
    assert sorted((r.address, r.path, r.message) for r in got if r.path) == sorted((f"https://example.org/{i}", f"{tmp_path}/a/{i}.wav", None) for i in range(20))
    assert [(r.address, r.message) for r in got if not r.path] == [("https://example.org/lost", "no such talk")]
    assert len(list((tmp_path / "a").iterdir())) == 20
    (tmp_path / "list").write_text("https://example.org/7\n\nhttps://example.org/lost\n")
    assert main(["fetch", "--addresses", str(tmp_path / "list"), "--output-dir", str(tmp_path / "b"), "--fetcher", "tests.recognizer:fetch"]) == 2
    said = capsys.readouterr()
    assert f"{tmp_path}/b/7.mp3" in said.out and "lost: no such talk" in said.out and "1 addresses" in said.err
    assert main(["fetch", "--fetcher", "tests.recognizer:fetch"]) == 2

import json
from pathlib import Path

from furrow import cli

PAD = " The field should be looked at again before the end of the week by whoever works on it."


def test_onboard_and_gaps_from_the_command_line(spark, lexicon_dir, tmp_path, monkeypatch, capsys):
    monkeypatch.setenv("FURROW_EMBEDDING_BACKEND", "lexical")
    monkeypatch.setenv("FURROW_EMBEDDING_DIM", "64")
    data, out = tmp_path / "data", tmp_path / "out"
    data.mkdir()
    (data / "alphaland.txt").write_text("Alphaland. Lentil stands well." + PAD + "\fSesame flowering. Spray the tomato." + PAD)
    (data / "bad.doc").write_bytes(b"\xd0\xcf")
    args = ["onboard", "--lexicon", lexicon_dir, "--data", str(data), "--all", "--out", str(out), "--query", "lentil field",
            "--probe", "looked at again", "--show-resource", "crop"]
    assert cli.main(args) == 0
    said = capsys.readouterr().out
    assert "REFUSED  bad.doc" in said and "ACCEPTED" in said and "first recorded publish" in said and "[spellings only]" in said
    files = list(Path(out, "documents").rglob("*.json"))
    body = json.loads(next(f for f in files if f.stat().st_size).read_text().splitlines()[0])
    assert body["state"] == {"code": "IN-AA", "name": "Alphaland"} and body["resourceCount"] == len(body["resources"])
    assert cli.main(args) == 0 and "claims unchanged" in capsys.readouterr().out
    assert cli.main(["gaps", "--lexicon", lexicon_dir, "--data", str(data), "--json", str(tmp_path / "gaps")]) == 0
    assert "Sesame" in capsys.readouterr().out


def test_nothing_publishable_is_an_error(spark, lexicon_dir, tmp_path, monkeypatch):
    monkeypatch.setenv("FURROW_EMBEDDING_BACKEND", "lexical")
    (tmp_path / "none.txt").write_text("No state is named in here." + PAD)
    assert cli.main(["onboard", "--lexicon", lexicon_dir, "--data", str(tmp_path), "--file", "none.txt", "--out", str(tmp_path / "o")]) == 1

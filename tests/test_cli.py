import json

import pytest

from scriptmill import cli
from scriptmill.schema import ConfigError


def test_config():
    c = cli.read_config({"seconds": "5", "model": None}, {"SCRIPTMILL_MODEL": "m", "SCRIPTMILL_SECONDS": "9"})
    assert (c.seconds, c.model, c.language) == (5.0, "m", "en")
    with pytest.raises(ConfigError, match="seconds.*attempts"):
        cli.read_config({"seconds": "x", "attempts": 0}, {})


def test_commands(spark, tmp_path, capsys):
    g = tmp_path / "g.json"
    g.write_text(json.dumps({"schema_version": 1, "terms": [{"id": "a", "canonical": "strong move"}]}))
    assert cli.main(["glossary", str(g)]) == 0 and '"term_count": 1' in capsys.readouterr().out
    assert cli.main(["glossary", str(tmp_path / "none.json")]) == 2
    src, alt, out = tmp_path / "in", tmp_path / "alt", tmp_path / "out"
    for d in (src, alt):
        d.mkdir()
    twice = [{"id": i, "start": s, "end": e, "text": "the same strong move again"} for i, (s, e) in enumerate([(0, 7), (7, 23)])]
    (src / "t.en.json").write_text(json.dumps({"transcript": " ".join(x["text"] for x in twice), "segments": twice}))
    (alt / "t.en.json").write_text(json.dumps({"transcript": "the same strong move again", "segments": []}))
    assert cli.main(["prepare", str(src), "--output-dir", str(out), "--glossary", str(g), "--alternative", str(alt)]) == 0
    doc = json.loads(spark.read.text(str(out / "documents")).first()[0])
    assert doc["verification"]["status"] == "duplicate_contradicted" and [s["segment_id"] for s in doc["segments"]] == ["0-1"]
    assert spark.read.text(str(out / "reports")).count() == 1

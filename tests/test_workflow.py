"""From recordings to an exported manifest by the command line, with stand-ins for models."""

import json

import numpy as np
import pytest

from lacuna import cli, config
from lacuna.operators import voice
from lacuna.plans import workflow
from lacuna.sources import audio

RATE = 22050


def speech(words, gap=0.4, level=0.5):
    t = np.arange(int(0.5 * RATE)) / RATE
    parts = [x for k in range(words) for x in (np.sin(2 * np.pi * (180 + 20 * k) * t) * level, np.zeros(int(gap * RATE)))]
    return np.concatenate(parts[:-1])


@pytest.fixture(scope="module")
def project(tmp_path_factory):
    root = tmp_path_factory.mktemp("project")
    for d in ("audio", "texts", "clips"):
        (root / d).mkdir()
    for i in range(4):
        (root / f"audio/r{i}.wav").write_bytes(audio.encode(speech(3 + i % 2), RATE))
        (root / f"texts/r{i}.txt").write_text(" ".join("một hai ba bốn".split()[: 3 + i % 2]), encoding="utf-8")
    (root / "audio/bad.wav").write_bytes(b"no recording")
    (root / "texts/bad.txt").write_text("một hai ba")
    rng = np.random.default_rng(0)
    for k, c in enumerate(["laughter", "sigh", "cough", "throatclearing", "sneeze", "sniff"]):
        for j in range(2):
            x = np.concatenate([np.zeros(4000), rng.normal(0, 0.05 + 0.05 * j, 12000 + 900 * k), np.zeros(4000)])
            (root / f"clips/f{j:04d}_0_{c}.wav").write_bytes(audio.encode(x, 16000))
    (root / "run.yaml").write_text(
        "seed: 3\npaths: {raw_audio_dir: audio, raw_transcript_dir: texts, tagged_transcript_dir: tagged, clip_dir: clips, stage_dir: stages, output_dir: out}\n"
        "quality: {max_boundary_activity: 1.2, scores: {max_mos_drop: null, max_discontinuity_drop: null}}\n"
    )
    return root


def rows_of(folder):
    return sorted((json.loads(x) for f in folder.glob("*.json") for x in f.read_text().splitlines()), key=lambda r: r["id"])


def test_whole_way(spark, project, capsys):
    do = lambda *a: cli.main(["--config", str(project / "run.yaml"), *a], spark)
    assert do("doctor") == 0
    assert do("slots") == 0
    offered = rows_of(project / "stages/slots.jsonl")
    assert [r["id"] for r in offered] == ["r0", "r1", "r2", "r3"] and all(r["candidates"] for r in offered)
    assert any("bad" in f.read_text() for f in (project / "stages/slots.jsonl.errors").glob("*.json"))
    assert do("tag-transcripts") == 0
    tagged = rows_of(project / "stages/tagged.jsonl")
    assert tagged and all((project / f"tagged/{r['id']}.txt").read_text(encoding="utf-8").count(r["tag"]) == 1 for r in tagged)
    assert do("run") == 0
    made = rows_of(project / "out/metadata_synth.jsonl")
    assert [r["id"] for r in made] == [r["id"] for r in tagged]
    for r in made:
        source, _ = audio.decode((project / f"audio/{r['id']}.wav").read_bytes())
        out, rate = audio.decode((project / f"out/para_{r['id']}.wav").read_bytes())
        assert rate == RATE and len(out) > len(source) and abs(np.abs(out).max() - 0.95) < 0.01
        assert r["vs_clip"].endswith(f"_{r['vs_class']}.wav")
    assert len(rows_of(project / "out/metadata_filtered.jsonl")) == len(made)
    # nothing is done twice, and a lost file is made again, the same
    before = {p.name: (p.stat().st_mtime_ns, p.read_bytes()) for p in (project / "out").glob("*.wav")}
    gone = project / "out" / f"para_{made[0]['id']}.wav"
    gone.unlink()
    assert do("run") == 0
    after = {p.name: (p.stat().st_mtime_ns, p.read_bytes()) for p in (project / "out").glob("*.wav")}
    assert {k for k in before if before[k][0] != after[k][0]} == {gone.name} and before[gone.name][1] == after[gone.name][1]
    assert do("export") == 0
    lines = [json.loads(x) for f in (project / "out/manifest.jsonl").glob("part-*") for x in f.read_text().splitlines()]
    assert len(lines) == len(made) and all(not x["audio_filepath"].startswith("/") and x["duration"] > 1 for x in lines)
    capsys.readouterr()
    assert do("inspect", "--limit", "1") == 0
    assert "similarity" in capsys.readouterr().out


def test_new_threshold_measures_nothing(spark, project):
    class Never:
        def score(self, samples, rate):
            raise AssertionError("measured again")

    cfg = config.load(str(project / "run.yaml"))
    cfg.quality.max_boundary_activity = -1.0
    judged = workflow.filter_rows(spark, cfg, workflow.Models(scorer=Never())).collect()
    assert judged and all(not r.kept and r.reasons[0].startswith("boundary_activity") for r in judged)


def test_settings():
    assert config.build({"vad": {"on_no_pause": "skip"}}).vad.on_no_pause == "skip"
    assert config.build({"splice": {"gap_shape": {"sigh": [1, 2]}}}).splice.gap_shape == {"sigh": [1, 2]}
    for bad in ({"vad": {"x": 1}}, {"vad": {"on_no_pause": "maybe"}}, {"nope": 1}):
        with pytest.raises(ValueError):
            config.build(bad)
    assert not config.has_criteria(config.build({"quality": {"max_boundary_activity": None, "scores": {"enabled": False}}}))


def test_voice():
    x = np.concatenate([np.full(RATE, 0.5), np.zeros(RATE), np.full(RATE, 0.5)])
    before, after = voice.silence_around(x, RATE, 1.3)
    assert abs(before - 0.3) < 0.02 and abs(after - 0.7) < 0.02
    assert voice.silence_around(x, RATE, 0.5) == (0.0, 0.0) and voice.silence_around(x[:0], RATE, 0.5) == (0.0, 0.0)
    assert abs(voice.typical_pause(speech(3, 0.2), RATE) - 0.2) < 0.1 and voice.typical_pause(np.ones(RATE), RATE) == 0.04
    assert voice.energy_rank(np.linspace(0, 1, 10 * RATE), RATE, 9.9, 2.5) > 0.9 and voice.energy_rank(np.ones(10), RATE, 0, 2.5) == 0.5
    assert len(voice.ready_clip(np.ones(100), RATE)) >= RATE - 1


@pytest.mark.parametrize("mode, placement", [("tempo", "gap"), ("adaptive", "gap"), ("fixed", "gap"), ("fixed", "after")])
def test_splices(mode, placement):
    cfg = config.build({"splice": {"mode": mode, "placement": placement}})
    x = speech(3)
    out, at = workflow.spliced(x, x[:5000], RATE, 0.7, "sigh", 0.5, cfg)
    assert len(out) >= len(x) + 5000 and np.isfinite(out).all() and abs(at - (len(x) / RATE if placement == "after" else 0.7)) < 1 / RATE

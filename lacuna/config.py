"""Settings of a run: the values that are meant to run, and a YAML file's values over them."""

from __future__ import annotations

import os
from types import SimpleNamespace

from lacuna.schemas import Settings

#: The settings' names and the values that run where a file leaves one out.
DEFAULTS = {
    "seed": 0,
    "sample_rate": 22050,
    "splice": {"mode": "tempo", "placement": "gap", "para_gain_db": -3.0, "pad_ms": 10, "fade_ms": 50, "min_pad_ms": 10, "max_gap_ms": 70, "gap_scale": 1.0, "fade_k": 5.0, "level_ref": "context_rms", "context_gain_db": 0.0, "gap_shape": {}, "level_offsets_db": {}},
    "selection": {"energy_weight": 1.0, "clarity_weight": 1.5, "tempo_weight": 1.0, "tilt_weight": 0.0, "context_s": 2.5, "candidate_pool": 48, "max_clipping": 0.01, "intensity_spread": 0.2, "feature_manifest": None},
    "vad": {"enabled": True, "backend": "energy", "min_pause_s": 0.12, "max_shift_s": 0.5, "merge_gap_s": 0.10, "edge_margin_s": 0.05, "on_no_pause": "keep"},
    "quality": {
        "max_boundary_activity": 1.2,
        "scores": {"enabled": True, "min_mos": None, "max_mos_drop": 0.5, "min_noisiness": None, "max_noisiness_drop": None, "min_discontinuity": None, "max_discontinuity_drop": 0.22, "min_coloration": None, "max_coloration_drop": None},
    },
    "tagging": {"max_retries": 2},
    "asr": {"language": "Vietnamese"},
    "paths": {"manifest": None, "raw_audio_dir": "data/raw/audio", "raw_transcript_dir": "data/raw/transcripts", "tagged_transcript_dir": "data/tagged/transcripts", "clip_dir": "data/clips", "stage_dir": "data/work/stages", "output_dir": "data/output/default_run"},
}
CHOICES = {("splice", "mode"): ("tempo", "adaptive", "fixed"), ("splice", "level_ref"): ("context_rms", "peak"), ("splice", "placement"): ("gap", "before", "after"), ("vad", "backend"): ("energy",), ("vad", "on_no_pause"): ("keep", "skip")}
#: Mappings whose keys the user chooses.
OPEN = {("splice", "gap_shape"), ("splice", "level_offsets_db")}


def _merged(base: dict, over: dict, at: tuple = ()) -> dict:
    unknown = sorted(set(over) - set(base))
    if unknown:
        raise ValueError(f"unknown settings: {', '.join('.'.join((*at, str(k))) for k in unknown)}")
    out = dict(base)
    for k, v in over.items():
        here = (*at, k)
        if isinstance(base[k], dict) and here not in OPEN:
            out[k] = _merged(base[k], v or {}, here)
        else:
            if here in CHOICES and v not in CHOICES[here]:
                raise ValueError(f"{'.'.join(here)} is one of {', '.join(CHOICES[here])}, not {v!r}")
            out[k] = v
    return out


def _spaces(values: dict, at: tuple = ()) -> SimpleNamespace:
    return SimpleNamespace(**{k: _spaces(v, (*at, k)) if isinstance(v, dict) and (*at, k) not in OPEN else v for k, v in values.items()})


def build(values: dict | None = None, base: str = ".") -> SimpleNamespace:
    """Settings with values over the defaults; relative paths lie under base. Unknown names and choices raise."""
    merged = _merged(DEFAULTS, values or {})
    merged["paths"] = {k: v if v is None or "://" in v else os.path.join(os.path.abspath(base), v) for k, v in merged["paths"].items()}
    return _spaces(merged)


def read_env(path: str) -> None:
    """KEY=VALUE lines of a file into the environment; what is set already stays, comments and other lines are skipped."""
    if not os.path.isfile(path):
        return
    with open(path, encoding="utf-8") as f:
        for line in map(str.strip, f):
            name, sign, value = line.partition("=")
            if sign and not line.startswith("#"):
                os.environ.setdefault(name.strip(), value.strip().strip('"').strip("'"))


def model_source(folder: str, name: str) -> str:
    """The folder of a model if it is there, else the name under which a hub has it."""
    return folder if os.path.isdir(folder) else name


def load(path: str | None) -> SimpleNamespace:
    """Settings of a YAML file; paths in it are relative to its folder."""
    if path is None:
        return build()
    import yaml

    with open(path, encoding="utf-8") as f:
        return build(yaml.safe_load(f), os.path.dirname(path) or ".")


def stage_settings(cfg: SimpleNamespace) -> Settings:
    """What the declarative stages need of cfg."""
    v, s, q = cfg.vad, cfg.selection, cfg.quality
    return Settings(merge_gap_s=v.merge_gap_s, margin_s=v.edge_margin_s, min_pause_s=v.min_pause_s, max_shift_s=v.max_shift_s, on_no_pause=v.on_no_pause, energy_weight=s.energy_weight, clarity_weight=s.clarity_weight, tempo_weight=s.tempo_weight, intensity_spread=s.intensity_spread, max_mos_drop=q.scores.max_mos_drop, max_discontinuity_drop=q.scores.max_discontinuity_drop, max_boundary_activity=q.max_boundary_activity, seed=cfg.seed)


def has_criteria(cfg: SimpleNamespace) -> bool:
    return cfg.quality.scores.enabled or cfg.quality.max_boundary_activity is not None

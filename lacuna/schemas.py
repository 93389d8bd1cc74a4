"""Schemas of stage tables, and settings with the values that are meant to run."""

from __future__ import annotations

from dataclasses import dataclass

SLOT = "struct<i:int,time_s:double,pause_s:double,char_offset:int,before:string,after:string>"
SCORES = "struct<mos:double,noisiness:double,discontinuity:double,coloration:double,loudness:double>"
ROWS = "id string, audio_filepath string, text string, extra map<string,string>"
SLOTS = f"id string, candidates array<{SLOT}>"
TAGGED = "id string, tag string, slot_i int, insert_at_s double, pause_s double"
ALIGNED = "id string, insert_at_s double, insert_stage string, insert_at_aligned_s double, vad_status string, vad_shift_s double, vad_pause_s double"
SYNTHESISED = "id string, source_audio string, para_audio string, vs_clip string, vs_class string, nv_tag string, transcript string, splice_at_s double, insert_stage string, sim_converted double, sim_raw_baseline double, speaker_score double, clip_intensity double, selection_cost double"
QUALITY = f"id string, para_audio string, para_stat struct<size:bigint,mtime_ns:bigint>, splice_at_s double, boundary_activity struct<before:double,after:double>, source {SCORES}, para {SCORES}"
#: Raised whenever a measure of clips changes: tables of other versions are measured anew.
FEATURE_VERSION = 2


@dataclass(frozen=True)
class Settings:
    merge_gap_s: float = 0.10
    margin_s: float = 0.05
    min_pause_s: float = 0.12
    max_shift_s: float = 0.5
    on_no_pause: str = "keep"
    energy_weight: float = 1.0
    clarity_weight: float = 1.5
    tempo_weight: float = 1.0
    intensity_spread: float = 0.2
    max_mos_drop: float | None = 0.5
    max_discontinuity_drop: float | None = 0.22
    max_boundary_activity: float | None = 1.2
    seed: int | None = 0

    def __post_init__(self):
        if self.on_no_pause not in ("keep", "skip"):
            raise ValueError(f"on_no_pause is keep or skip, not {self.on_no_pause!r}")

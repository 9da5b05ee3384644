"""Thresholds and modes, in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class EngineConfig:
    min_section: int = 100  # shorter sections (stripped) are skipped, or one chunk
    truncate_at: int = 10_000  # text for a model, 80 % from the front
    align_pieces: bool = False  # True: a model's pieces are aligned with the text, else placed by their markers
    min_paragraph: int = 50  # rule split
    merge_min: int = 100  # greedy merge: a shorter rest is dropped
    merge_max: int = 1500  # greedy merge: a buffer of so many characters is a chunk
    big_chunk: int = 2500  # text for a call that cuts and names at once
    min_concept_text: int = 50  # shorter chunks have no concept
    near_threshold: float = 0.9  # cosine of grouped ideas
    offset_mode: str = "aligned"  # or "reference": offsets of raw pages on normalized text
    dehyphenate_join: bool = False  # True: a word that a page break cuts is joined again
    retry_delays: tuple[float, ...] = (1, 2, 4)
    retry_attempts: int = 3
    model_calls: int = 8  # at once in a task
    calls_per_second: float | None = None  # of a task
    stuck_minutes: int = 30
    model_version: str = "rule-1"

    def __post_init__(self):
        if self.offset_mode not in ("aligned", "reference"):
            raise ValueError(f"no such offset_mode: {self.offset_mode}")

    def updated(self, **changes) -> EngineConfig:
        """A changed copy; an unknown name is a ValueError."""
        unknown = set(changes) - {f.name for f in fields(self)}
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        return replace(self, **changes)


DEFAULT = EngineConfig()

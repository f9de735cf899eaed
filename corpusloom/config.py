"""Job settings. Plain frozen values, passed to the operators by the caller."""

from __future__ import annotations

import json
from dataclasses import dataclass, field


@dataclass(frozen=True)
class SpecialTokens:
    # Default special tokens and chat markers.
    bos: str = "<s>"
    eos: str = "</s>"
    unk: str = "<unk>"
    pad: str = "<pad>"
    mask: str = "<mask>"
    extra: tuple[str, ...] = ("<|user|>", "<|bot|>", "<|end|>")

    # The order of the ids 0-4 in a freshly trained vocabulary.
    @property
    def trained(self) -> tuple[str, ...]:
        return (self.bos, self.pad, self.eos, self.unk, self.mask)

    # The order in which named slots are offered to a vocabulary.
    @property
    def named(self) -> tuple[str, ...]:
        return (self.bos, self.eos, self.unk, self.pad, self.mask)

    @classmethod
    def from_json(cls, text: str) -> SpecialTokens:
        """Tokens named in a JSON object; names left out keep their defaults."""
        given = json.loads(text)
        names = {f"{slot}_token": slot for slot in ("bos", "eos", "unk", "pad", "mask")}
        chosen = {slot: given[name] for name, slot in names.items() if name in given}
        if "additional_special_tokens" in given:
            chosen["extra"] = tuple(given["additional_special_tokens"])
        return cls(**chosen)

    def _marker(self, place: int) -> str | None:
        return self.extra[place] if len(self.extra) > place else None

    # Chat needs all three markers; with fewer extra tokens every text is wrapped as it is.
    @property
    def user_marker(self) -> str | None:
        return self._marker(0)

    @property
    def bot_marker(self) -> str | None:
        return self._marker(1)

    @property
    def end_marker(self) -> str | None:
        return self._marker(2)

    def for_phase(self, instruct: bool) -> tuple[str, ...]:
        return self.named + (self.extra if instruct else ())


@dataclass(frozen=True)
class Settings:
    # Defaults of the preparation and training jobs.
    vocab_size: int = 52_000
    min_frequency: int = 2
    max_length: int = 2_048
    pad_multiple: int = 8
    ignore_label: int = -100
    format_batch: int = 100
    corpus_batch: int = 1_000
    batch_size: int = 4
    accumulation: int = 2
    epochs: float = 3.0
    world_size: int = 1
    seed: int = 42
    learning_rate: float = 3e-4
    warmup_steps: int = 0
    nonfinite_limit: int = 50
    stop_check_steps: int = 10
    report_every_windows: int = 5
    timeout_minutes: int = 350
    timeout_buffer: int = 20

    # Rows handled by one window group; a longer run or stream is cut into blocks.
    block_rows: int = 1 << 20

    tokens: SpecialTokens = field(default_factory=SpecialTokens)

    @property
    def budget_minutes(self) -> int:
        return self.timeout_minutes - self.timeout_buffer

    @property
    def logging_steps(self) -> int:
        return max(self.batch_size, self.warmup_steps) if self.warmup_steps > 0 else self.batch_size

"""Training options and their checks (raised at job start)."""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass

# Fixed default values of the embedding trainer.
DEFAULT_DIM = 64
DEFAULT_WINDOW = 4
DEFAULT_EPOCHS = 3
DEFAULT_NEG = 5
DEFAULT_LR = 0.025
DEFAULT_SEED = 1


@dataclass(frozen=True)
class TrainOptions:
    dim: int = DEFAULT_DIM
    window: int = DEFAULT_WINDOW
    epochs: int = DEFAULT_EPOCHS
    neg: int = DEFAULT_NEG
    lr: float = DEFAULT_LR
    seed: int = DEFAULT_SEED
    # tokens of a shard that is trained sequentially (more for a large vocabulary)
    shard_tokens: int = 1 << 17
    stream: str = "document"  # or "global": documents concatenated in doc_id order

    def validate(self) -> "TrainOptions":
        for name in ("dim", "window", "epochs", "neg", "seed", "shard_tokens"):
            v = getattr(self, name)
            if isinstance(v, bool) or not isinstance(v, int) or v <= 0:
                raise ValueError(f"{name} must be a positive integer, got {v!r}")
        if self.seed >= 2**32:
            raise ValueError("seed must fit in 32 bits")
        lr = self.lr
        if isinstance(lr, bool) or not isinstance(lr, (int, float)) or not math.isfinite(lr) or lr <= 0:
            raise ValueError(f"lr must be a finite number above 0, got {lr!r}")
        if self.stream not in ("document", "global"):
            raise ValueError("stream must be 'document' or 'global'")
        return self

    def as_dict(self) -> dict:
        return asdict(self)


def validate_target_size(m) -> int:
    """The BPE target vocabulary size: a positive integer."""
    if isinstance(m, bool) or not isinstance(m, int) or m <= 0:
        raise ValueError(f"target vocabulary size must be a positive integer, got {m!r}")
    return m


def validate_sources(input_text=None, token_ids=None) -> str:
    """Exactly one training source: raw text (``input``) or an id table (``tokens``)."""
    if (input_text is None) == (token_ids is None):
        raise ValueError("give exactly one of input (text) or tokens (ids)")
    return "input" if input_text is not None else "tokens"

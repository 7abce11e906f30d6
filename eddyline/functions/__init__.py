"""Column-expression helpers (all JVM-side, no Python per row)."""

from eddyline.functions.text import (
    java_split, strict_int, strict_long, tokens, first_three, prefix_chars_array,
)
from eddyline.functions.timefmt import (
    TIME_FORMAT, epoch_ms, fmt_epoch_ms, took_note, valid_epoch_ms,
)
from eddyline.functions.fold import (
    apply_map, compose_maps, fold_maps, halving_average, halving_map, identity_map, trunc_half,
)

__all__ = [
    "java_split", "strict_int", "strict_long", "tokens", "first_three",
    "prefix_chars_array", "TIME_FORMAT", "fmt_epoch_ms", "took_note", "epoch_ms",
    "valid_epoch_ms",
    "halving_average", "trunc_half", "apply_map", "compose_maps", "fold_maps",
    "halving_map", "identity_map",
]

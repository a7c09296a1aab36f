"""The weighted scorer in plain Python, text by text: what the joins must agree with."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence


class Text:
    """A text with its letters counted and its words sorted, once."""

    def __init__(self, value: str) -> None:
        self.value = value
        self.letters = Counter(value)
        self.words = sorted(value.split())
        self.unique = set(self.words)
        self.sorted = " ".join(self.words)
        self.shortest = len(" ".join(self.unique))

    def __len__(self) -> int:
        return len(self.value)


def best_match(
    text: str | None, known: Sequence[tuple[str, Text]], cutoff: float, match_case: bool = False
) -> tuple[str | None, float | None]:
    """Highest score at or above the cutoff; the earlier name wins a tie."""
    if not text:
        return None, None
    wanted = Text(text if match_case else text.lower())
    best_name, best_score = None, None
    for name, candidate in known:
        if best_score is None:
            if highest_possible(wanted, candidate) < cutoff:
                continue
            score = weighted_ratio(wanted, candidate)
            if score >= cutoff:
                best_name, best_score = name, score
        elif highest_possible(wanted, candidate) > best_score:
            score = weighted_ratio(wanted, candidate)
            if score > best_score:
                best_name, best_score = name, score
    return best_name, best_score


def highest_possible(a: Text, b: Text) -> float:
    """Bound on the weighted ratio from shared letters. A common subsequence
    cannot be longer than the letters both texts hold."""
    if not len(a) or not len(b):
        return 0.0
    shared = sum((a.letters & b.letters).values())
    whole = min(100.0, 200.0 * shared / max(1, a.shortest + b.shortest))
    common_word = bool(a.unique & b.unique)
    if _spread(a, b) < 1.5:
        return 100.0 if common_word else whole
    partial = min(100.0, 200.0 * shared / max(1, min(a.shortest, b.shortest) + shared))
    return max(whole, _partial_scale(a, b) * (100.0 if common_word else partial))


def _spread(a: Text, b: Text) -> float:
    return max(len(a), len(b)) / min(len(a), len(b))


def _partial_scale(a: Text, b: Text) -> float:
    return 0.9 if _spread(a, b) <= 8.0 else 0.6


def weighted_ratio(a: Text, b: Text) -> float:
    """Best of the ratios, partial ones scaled down as the lengths diverge."""
    if not len(a) or not len(b):
        return 0.0
    whole = ratio(a.value, b.value)
    if _spread(a, b) < 1.5:
        return max(whole, 0.95 * token_ratio(a, b))
    scale = _partial_scale(a, b)
    partial = scale * partial_ratio(a.value, b.value)
    return max(whole, partial, 0.95 * scale * partial_token_ratio(a, b))


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel steps."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hits = row & masks.get(ch, 0)
        row = ((row + hits) | (row - hits)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * common_length(a, b) / total


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text against any stretch of the longer one,
    stretches that run over either end included."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    best = _best_stretch(a, b)
    return max(best, _best_stretch(b, a)) if len(a) == len(b) else best


def _best_stretch(short: str, long: str) -> float:
    if short in long:
        return 100.0
    size = len(short)
    stretches = (long[max(0, end - size) : end] for end in range(1, len(long) + size))
    return max(ratio(short, s) for s in stretches)


def token_ratio(a: Text, b: Text) -> float:
    return max(ratio(a.sorted, b.sorted), token_set_ratio(a, b))


def token_set_ratio(a: Text, b: Text) -> float:
    if not a.unique or not b.unique:
        return 0.0
    shared = " ".join(sorted(a.unique & b.unique))
    only_a = " ".join(sorted(a.unique - b.unique))
    only_b = " ".join(sorted(b.unique - a.unique))
    if shared and (not only_a or not only_b):
        return 100.0
    gap = 1 if shared else 0
    len_a = len(shared) + gap + len(only_a)
    len_b = len(shared) + gap + len(only_b)
    edits = len(only_a) + len(only_b) - 2 * common_length(only_a, only_b)
    best = 100.0 * (1 - edits / (len_a + len_b))
    if shared:
        for full, own in ((len_a, only_a), (len_b, only_b)):
            best = max(best, 100.0 * (1 - (gap + len(own)) / (len(shared) + full)))
    return best


def partial_token_ratio(a: Text, b: Text) -> float:
    if a.unique & b.unique:
        return 100.0
    in_order = partial_ratio(a.sorted, b.sorted)
    only = partial_ratio(" ".join(sorted(a.unique)), " ".join(sorted(b.unique)))
    return max(in_order, only)

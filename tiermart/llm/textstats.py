"""Statistics of one text, for the quality operators."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from tiermart.llm.common import SPACES, words_of

SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish
STOP_WORDS = frozenset(
    (
        "the of and to a in is that it for was on are with as be this by at from or an have not "
        "der die das und in zu den von mit sich des auf für ist im dem nicht ein eine als auch es "
        "de la le et les des en un une du que est pour dans qui par sur au plus ne pas avec "
        "el los las y del se por una con para su al lo como más o pero sus"
    )
    .encode()
    .split()
)

FEATURES = (
    "words",
    "mean_word",
    "word_spread",
    "symbols",
    "dup_lines",
    "repeats",
    "upper",
    "digits",
    "punctuation",
    "exclamation",
    "other_bytes",
    "entropy",
    "distinct",
    "runs",
    "most_common",
    "short",
    "ended",
    "stops",
    "line_words",
    "spaces",
)


@dataclass(frozen=True)
class TextStats:
    """Counts of the rules, and the statistics that the models see."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    features: tuple[float, ...]


def text_stats(text: str) -> TextStats:
    words = words_of(text)
    numbers: dict[bytes, int] = {}
    ids = np.fromiter(
        (numbers.setdefault(word, len(numbers)) for word in words), np.int64, len(words)
    )
    word_chars = len(text) - sum(text.count(space) for space in SPACES)
    n_symbols = sum(text.count(symbol) for symbol in SYMBOLS)
    n_lines, n_dup_lines = _lines(text)
    n_repeats = _repeat_words(ids, len(numbers))
    features = _features(text, ids, list(numbers), n_symbols, n_lines, n_dup_lines, n_repeats)
    return TextStats(len(words), word_chars, n_symbols, n_dup_lines, n_repeats, features)


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    seen: set[str] = set()
    count = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            count += 1
            seen.add(line)
    return count, count - len(seen)


def _repeat_words(ids: np.ndarray, distinct: int) -> int:
    """Words in windows of three words that the text has twice or more."""
    if len(ids) < 4:
        return 0
    # numbers of pairs stay below the number of words, so that the product fits 64 bits
    pairs = ids[:-1] * distinct + ids[1:]
    if distinct > 1_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * distinct + ids[2:]
    _, number, counts = np.unique(windows, return_inverse=True, return_counts=True)
    repeated = counts[number] > 1
    marked = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        marked[shift : shift + len(repeated)] |= repeated
    return int(marked.sum())


def _features(
    text: str,
    ids: np.ndarray,
    words: list[bytes],
    n_symbols: int,
    n_lines: int,
    n_dup_lines: int,
    n_repeats: int,
) -> tuple[float, ...]:
    if not words:
        return (0.0,) * len(FEATURES)
    n = len(ids)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    histogram = np.bincount(data, minlength=256)
    size = len(data)
    letters = histogram[65:91].sum() + histogram[97:123].sum()
    punctuation = (
        histogram[33:48].sum() + histogram[58:65].sum()
        + histogram[91:97].sum() + histogram[123:127].sum()
    )
    shares = histogram[histogram > 0] / size
    # of distinct words, then by the numbers of the words
    lengths = np.array([len(word) for word in words])
    ended = np.array([word[-1] in b".!?" for word in words])
    stops = np.array([word.lower().strip(b".,") in STOP_WORDS for word in words])
    counts = np.bincount(ids)
    long = lengths[ids]
    return (
        math.log1p(n),
        math.log1p(long.mean()),
        math.log1p(long.std()),
        math.log1p(n_symbols / n),
        n_dup_lines / max(n_lines, 1),
        n_repeats / n,
        histogram[65:91].sum() / max(letters, 1),
        math.log1p(20 * histogram[48:58].sum() / size),
        math.log1p(20 * punctuation / size),
        math.log1p(20 * histogram[33] / size),
        histogram[128:].sum() / size,
        float(-(shares * np.log2(shares)).sum()) / 8,
        math.log(len(words) + 1) / math.log(n + 1),
        float((ids[1:] == ids[:-1]).sum()) / n,
        float(counts.max()) / n,
        float((long <= 3).sum()) / n,
        float(counts[ended].sum()) / n,
        float(counts[stops].sum()) / n,
        math.log1p(n / max(n_lines, 1)),
        1 - float(long.sum()) / size,
    )

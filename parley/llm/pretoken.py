"""Vectorised pre-token splitting of whole texts, for use inside Arrow batches.

Two splits are offered. ``gpt`` gives the matches of the usual byte-level BPE pattern
(contractions, letters, digits, other signs, each with one leading space, and runs of
white space); ``spaces`` gives the parts between which a BPE over escaped white space
never merges, that is every run of spaces with what follows it up to the next space.
Texts are cut into slices of bounded size; each slice gives the dictionary of its
distinct pre-tokens, the codes of all pre-tokens and the bounds of every document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex

SLICE_CHARS = 2_000_000
OTHER, LETTER, NUMBER, SPACE, END = range(5)


def char_classes() -> np.ndarray:
    """Class of every code point, as the pattern's \\p{L}, \\p{N} and \\s see it."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    chars, at = "".join(map(chr, points)), np.array(points)
    out = np.zeros(0x110000, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, chars):
            out[at[m.start():m.end()]] = kind
    return out


def _after(mask: np.ndarray, n: int = 1) -> np.ndarray:
    out = np.zeros_like(mask)
    out[n:] = mask[:-n]
    return out


def gpt_starts(points: np.ndarray, ends: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where a match of the pattern starts. ``ends``: places of the separators."""
    cls = classes[points]
    cls[ends] = END
    start = np.ones(len(cls), bool)
    start[1:] = cls[1:] != cls[:-1]
    following = np.append(cls[1:], END)
    # the last white space before a word leaves its run, and a plain space joins the word
    last = (cls == SPACE) & (following < SPACE)
    start |= last
    start &= ~_after(last & (points == 32))
    # contractions count only where a match starts at the apostrophe
    mark = np.flatnonzero((points == 39) & start & (cls == OTHER))
    mark = mark[mark + 1 < len(cls)]
    if len(mark):
        one, two = points[mark + 1], points[np.minimum(mark + 2, len(cls) - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) \
            | ((one == ord("l")) & (two == ord("l")))
        start[mark[short | long] + 1] = False
        after = np.concatenate([mark[short] + 2, mark[long] + 3])
        start[after[after < len(cls)]] = True
    return start


def space_starts(points: np.ndarray, ends: np.ndarray, classes: np.ndarray) -> np.ndarray:
    space = points == 32
    start = space & ~_after(space)
    start[ends] = True
    return start


def escape_spaces(text: str) -> str:
    """The normal form of a piece model with an identity map and a dummy prefix, with
    plain spaces in place of the escape sign."""
    return " " + text.replace("▁", " ") if text else ""


KINDS = {"gpt": (gpt_starts, str), "spaces": (space_starts, escape_spaces)}


def slices(texts: list[str], kind: str, classes: np.ndarray | None) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """(first document, distinct pre-tokens, codes, bounds of the documents) per slice."""
    starts, normal = KINDS[kind]
    first = 0
    while first < len(texts):
        part, size = [], 0
        while first + len(part) < len(texts) and (not part or size + len(texts[first + len(part)]) <= SLICE_CHARS):
            part.append(normal(texts[first + len(part)]))
            size += len(part[-1])
        yield first, *_encode(part, starts, classes)
        first += len(part)


def _encode(part: list[str], starts, classes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    joined = "\n".join(part) + "\n"  # one separator after each document
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in part]) - 1
    start = starts(points, ends, classes)
    start[ends] = True
    start[ends[:-1] + 1] = True
    start[0] = True
    at = np.flatnonzero(start)
    size = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
    offsets = np.append(np.concatenate([[0], np.cumsum(size)])[at], size.sum()).astype(np.int32)
    whole = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(joined.encode())])
    is_end = np.zeros(len(points), bool)
    is_end[ends] = True
    real = ~is_end[at]
    coded = whole.filter(pa.array(real)).dictionary_encode()
    bounds = np.searchsorted(at[real], np.concatenate([[0], ends + 1]))
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds

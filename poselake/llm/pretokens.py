"""Where the pieces of a text begin, found on whole batches of bytes without a regular expression.

The splitting rule of the public byte-level tokenizers,

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

is a finite automaton over four classes of characters: letter, number, white space, other. Its transition
function for a character is fixed by that character and those around it: whatever the state before, a
letter leads to "in letters", and so on. Such constant functions make the associative scan of composed
transitions collapse: the state at a character is the image of the last function alone. What remains to be
known of the past is bounded (the class before; whether an apostrophe stands at the start of a piece), so
all boundaries of a batch come from shifted comparisons of the class array.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

OTHER, LETTER, NUMBER, BLANK, SPACE = 0, 1, 2, 3, 4  # SPACE is U+0020, BLANK any other white space

#: Characters with the property White_Space.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of every code point."""
    major = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((major.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[_WHITE] = BLANK
    table[0x20] = SPACE
    return table


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offset and code point of every character of valid UTF-8 ``data`` (uint8)."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    first = data[at].astype(np.uint32)
    if len(at) == len(data):
        return at, first
    padded = np.r_[data, np.zeros(3, np.uint8)]
    point = first.copy()
    for low, high, mask, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
        which = np.flatnonzero((first >= low) & (first < high))
        value = first[which] & mask
        for k in range(1, more + 1):
            value = value << 6 | (padded[at[which] + k] & 0x3F)
        point[which] = value
    return at, point


def piece_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Byte offsets at which pieces start. ``texts``: ascending byte offsets of the texts' starts."""
    if not len(data):
        return np.empty(0, np.int64)
    at, point = characters(data)
    kind = classes()[point]
    n = len(at)
    opens = np.zeros(n + 1, bool)  # character begins a text; also the end of the batch
    opens[np.searchsorted(at, texts)] = True
    opens[n] = True
    opens, text_ends = opens[:n], opens[1:]
    opens[0] = True

    white = kind >= BLANK
    before = np.r_[np.uint8(BLANK), kind[:-1]]
    # Not white: a piece starts where the class changes, unless a plain space came first and belongs to it.
    start = ~white & (before != kind) & (before != SPACE)
    # White: at the first of a run; and at its last if more than white space follows.
    white_before = (before >= BLANK) & ~opens
    followed = ~text_ends & ~np.r_[white[1:], True]
    start |= white & (~white_before | followed)
    start |= opens

    quote = np.flatnonzero((point == 0x27) & start)
    if len(quote):
        padded = np.r_[point, np.zeros(2, np.uint32)]
        ends = np.r_[text_ends, True, True]
        one, two = padded[quote + 1], padded[quote + 2]
        has_one = ~ends[quote]
        has_two = has_one & ~ends[quote + 1]
        single = has_one & np.isin(one, [ord(c) for c in "stmd"])
        double = has_two & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        start[quote[single | double] + 1] = False
        for where, width in ((quote[single], 2), (quote[double], 3)):
            after = where + width
            start[after[after < n]] = True
    return at[start]

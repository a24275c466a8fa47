"""Word shingles of whole texts as sets of 64-bit hashes, made for many texts at a time with numpy.

Words are the maximal runs of bytes other than space and tab to carriage return, with A-Z lower-cased.
A word's hash is a polynomial modulo the prime 2^61 - 1, its coefficients the word's length and then its bytes, seven
at a time, at a base that is drawn at random for each run. So texts can't be made to collide: two
different words of at most LONG bytes share a hash for LONG / 7 + 1 bases of 2^61 at most, a chance below 2^-51
(2^-57 up to 63 bytes). Longer words have a BLAKE2 hash with the base as its key. A shingle's hash mixes those of
its words in order; two different shingles of usual words share one with a chance of about 2^-57.
"""

import hashlib
import re
import secrets
from collections.abc import Iterator

import numpy as np

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_FIRST_BLANK = re.compile(rb"[\x20\x09-\x0d]")
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
#: Bytes hashed at once; a longer text goes in parts that end between words.
BUFFER = 1 << 20
#: Bytes of the longest word that is hashed as a polynomial.
LONG = 4096
_PRIME = (1 << 61) - 1
_P = np.uint64(_PRIME)


def draw_base() -> int:
    """A random base; one run needs the same in all of its tasks."""
    return 256 + secrets.randbelow(_PRIME - 512)


#: The base of a process whose hashes never leave it.
_OWN_BASE = draw_base()
_STEP = 7
#: What stays of eight bytes, by the number of bytes left.
_MASKS = np.array([(1 << 8 * min(n, _STEP)) - 1 for n in range(LONG + 1)], np.uint64)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> np.uint64(61))
    return np.where(x >= _P, x - _P, x)


def _times(x: np.ndarray, base: int) -> np.ndarray:
    """Products with the base modulo the prime, from products of halves of 31 bits."""
    low, high = np.uint64(base & 0x7FFFFFFF), np.uint64(base >> 31)
    x_low, x_high = x & np.uint64(0x7FFFFFFF), x >> np.uint64(31)
    middle = x_low * high + x_high * low
    # 2^62 is 2 modulo the prime, and 2^61 is 1
    return _reduced(((x_high * high) << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << np.uint64(31)) + x_low * low)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(buffer: bytes, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word of lower-cased bytes."""
    data = np.frombuffer(buffer, np.uint8)
    blank = np.concatenate(([True], _BLANK[data], [True]))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, ends, np.empty(0, np.uint64)
    # the eight bytes from each place on
    eights = np.ndarray((len(data),), "<u8", buffer + bytes(8), strides=(1,))
    left = np.minimum(ends - starts, LONG)
    hashes = _reduced(_times(left.astype(np.uint64), base) + (eights[starts] & _MASKS[left]))
    going, place = np.flatnonzero(left > _STEP), _STEP
    while len(going):
        part = eights[starts[going] + place] & _MASKS[left[going] - place]
        hashes[going] = _reduced(_times(hashes[going], base) + part)
        place += _STEP
        going = going[left[going] > place]
    hashes = mix(hashes)
    for k in np.flatnonzero(ends - starts > LONG):
        word = hashlib.blake2b(buffer[starts[k] : ends[k]], digest_size=8, key=base.to_bytes(8, "little"))
        hashes[k] = int.from_bytes(word.digest(), "little")
    return starts, ends, hashes


def _long_words(text: bytes, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_words`` of a long text, in parts that end at white space."""
    found, at = [], 0
    while at < len(text):
        end = at + BUFFER
        if end < len(text):
            blank = _FIRST_BLANK.search(text, end)
            end = blank.start() if blank else len(text)
        starts, ends, hashes = _words(text[at:end], base)
        found.append((starts + at, ends + at, hashes))
        at = end
    return tuple(np.concatenate(c) for c in zip(*found))


def lowered_words(texts: list[bytes | None], base: int = _OWN_BASE) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The texts in groups of bounded size: the group's bytes with A-Z lower-cased, each word's start, end
    and hash, and the number of words before each text and after the last."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end] or b"") <= BUFFER):
            size += len(texts[end] or b"") + 1
            end += 1
        group = [(t or b"").translate(_LOWER) for t in texts[at:end]]
        buffer = b"\n".join(group)
        starts, ends, hashes = _words(buffer, base) if len(buffer) <= 2 * BUFFER else _long_words(buffer, base)
        yield buffer, starts, ends, hashes, np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in group]))
        at = end


def _rolled(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words."""
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0xC2B2AE3D27D4EB4F) + words[k : k + n])
    return out


def _set_of(words: np.ndarray, width: int) -> np.ndarray:
    return np.unique(_rolled(words, min(width, len(words)))) if len(words) else np.empty(0, np.uint64)


def shingle_sets(texts: list[bytes | None], width: int, base: int = _OWN_BASE) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``width`` words; a text of fewer
    words has one shingle of all, one without words and a null text have none."""
    for _, _, _, words, borders in lowered_words(texts, base):
        rolled = _rolled(words, width) if len(words) >= width else None
        for first, last in zip(borders.tolist(), borders[1:].tolist()):
            if last - first >= width:
                yield np.unique(rolled[first : last - width + 1])
            else:
                yield _set_of(words[first:last], width)

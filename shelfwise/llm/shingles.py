"""Sets of word shingles as sorted 64-bit hashes, made for many texts at once."""

import numpy as np

CHUNK = 4_000_000  # bytes of text that are hashed together
_RANDOM = np.random.default_rng(20)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_SHORT = np.uint64(0xD1B54A32D192ED03)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on all bits of a number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, bounds: np.ndarray):
    """Hashes of the words of texts that lie one after the other, and each word's text.

    ``data`` has the bytes, ``bounds`` where each text begins and the last one ends. A-Z count as
    lower case; words are what lies between blanks (9 to 13 and 32).
    """
    capital = (data >= 65) & (data <= 90)
    data = data + (capital.astype(np.uint8) << 5)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    owner = np.searchsorted(bounds, starts, "right") - 1
    powers = np.full(len(data), _STEP)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.add.reduceat(np.where(inside, _BYTES[data], 0) * powers, starts)
    # Bring all words to the same power, and tell apart lengths.
    back = np.full(len(data), _BACK)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    lengths = np.add.reduceat(inside.astype(np.uint64), starts)
    return mixed(sums * back[starts] + lengths * _SHORT), owner


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """For each text its distinct shingles of ``width`` words, sorted. A text with fewer words
    has all of them as its one shingle, one without words none."""
    out: list[np.ndarray] = []
    begin = 0
    while begin < len(texts):
        end, size = begin, 0
        while end < len(texts) and (end == begin or size + len(texts[end]) <= CHUNK):
            size += len(texts[end])
            end += 1
        out += _sets(texts[begin:end], width)
        begin = end
    return out


def _sets(texts, width):
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    none = np.empty(0, np.uint64)
    if not len(data):
        return [none] * len(texts)
    words, owner = word_hashes(data, bounds)
    joined = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for i in range(width):
        joined = mixed(joined * _STEP + words[i:i + len(joined)])
    firsts = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if a == b:
            out.append(none)
        elif b - a < width:
            whole = np.zeros(1, np.uint64)
            for word in words[a:b]:
                whole = mixed(whole * _STEP + word)
            out.append(mixed(whole + np.full(1, b - a, np.uint64) * _SHORT))
        else:
            found = np.sort(joined[a:b - width + 1])
            out.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
    return out


def text_bytes(column) -> list[bytes]:
    """The texts of an Arrow column in UTF-8; nulls are empty."""
    return [(text or "").encode() for text in column.to_pylist()]

"""Token ids of texts by a public tokenizer, with a memory of the words met before.

The library needs most of its time for words it has already seen. Texts are therefore cut into words
(letter runs, digits, other runs) as Arrow columns, each distinct word of a group of texts is
looked up once, ids are gathered by Arrow, and only new words go to the library. That is
exact where the tokenizer cuts a text into words first and treats each by itself, which is checked
for each text: it must consist of characters whose class and lower case no Unicode version
disputes. Any other text, and any with a special token's name, goes to the library whole. The
memory has two bounded generations: the young one becomes the old one when full, and words that
are met again move from the old one back, so that frequent words stay. New words go to the library
many at a time, parted by blanks; its tokens say where a word ends.
"""

import os
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

TOKENIZER = "word_bpe_49k.json"
MEMORY_WORDS = 100_000  # of each generation
GROUP = 1 << 22  # characters of texts that are cut together
ASKED = 256  # words in one question to the library
WORD_END = "</w>"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _classes():
    """Characters up to Latin Extended-B, and common punctuation, by their general category."""
    plain = [c for c in map(chr, [*range(0x21, 0x7F), *range(0xA1, 0x250), *range(0x2010, 0x2028),
                                  *range(0x2030, 0x205F), 0x20AC])
             if c not in "­İ" and unicodedata.normalize("NFC", c) == c]
    kinds = {"L": [], "N": [], "PS": []}
    for c in plain:
        kind = unicodedata.category(c)[0]
        for name, members in kinds.items():
            if kind in name:
                members.append(c)
    return {name: re.escape("".join(members)) for name, members in kinds.items()}


class Words:
    """Ids of words as bytes; the library is asked for those not met before."""

    def __init__(self, tokenizer):
        tokenizer.normalizer = None  # words are in lower case
        self.library = tokenizer
        self.ends = np.zeros(tokenizer.get_vocab_size(), bool)
        for token, i in tokenizer.get_vocab().items():
            self.ends[i] = token.endswith(WORD_END)
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def codes(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        found: list = []
        for begin in range(0, len(words), MEMORY_WORDS):
            found += self._codes(words[begin:begin + MEMORY_WORDS])
            if len(self.young) >= MEMORY_WORDS:
                self.old, self.young = self.young, {"": b""}
        return found

    def _codes(self, words):
        known = list(map(self.young.get, words))
        places = [i for i, code in enumerate(known) if code is None]
        other = [words[i] for i in places]
        codes = list(map(self.old.get, other))
        new = [word for word, code in zip(other, codes) if code is None]
        fresh = iter(self._fresh(new))
        codes = [next(fresh) if code is None else code for code in codes]
        self.young.update(zip(other, codes))
        for i, code in zip(places, codes):
            known[i] = code
        return known

    def _fresh(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        asked = [" ".join(words[i:i + ASKED]) for i in range(0, len(words), ASKED)]
        given = self.library.encode_batch_fast(asked, add_special_tokens=False)
        ids = np.concatenate([np.array(one.ids, np.uint16) for one in given])
        ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(ends) != len(words):  # a word that is not one to the library
            each = self.library.encode_batch_fast(words, add_special_tokens=False)
            return [np.array(one.ids, np.uint16).tobytes() for one in each]
        data = ids.tobytes()
        return [data[2 * begin:2 * end] for begin, end in zip([0, *ends], ends)]


class WordEncoder:
    """Ids of whole texts as arrays of unsigned 16-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        kinds = _classes()
        single = kinds["N"] + kinds["PS"]
        self.apart = [(c, f" {c} ") for c in re.sub(r"\\(.)", r"\1", single, flags=re.S)]
        self.other = f"[^ \t\n\r\x0b\x0c{''.join(kinds.values())}]"
        self.runs = f"'|[{kinds['PS']}][{kinds['PS']}]"
        self.cut = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|[{kinds['L']}]+|[{kinds['N']}]|[{kinds['PS']}]+").findall
        names = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        if names:
            self.other += "|" + "|".join(map(re.escape, names))
        self.memory = Words(Tokenizer.from_file(path))

    def spaced(self, text: str, runs: bool) -> str:
        """A text in lower case, with white space where the tokenizer cuts it."""
        text = text.lower()
        if runs:
            return " ".join(self.cut(text))
        for c, spaced in self.apart:
            if c in text:
                text = text.replace(c, spaced)
        return text

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        result: list = [None] * len(texts)
        group, places, size = [], [], 0
        column = pa.array(texts, pa.large_string())
        other, runs = (pc.match_substring_regex(column, pattern).to_pylist()
                       for pattern in (self.other, self.runs))
        for place, text in enumerate(texts):
            if other[place]:
                code = self.whole.encode(text, add_special_tokens=False).ids
                result[place] = np.array(code, np.uint16)
                continue
            group.append(self.spaced(text, runs[place]))
            places.append(place)
            size += len(text)
            if size >= GROUP:
                for at, ids in zip(places, self._group(group)):
                    result[at] = ids
                group, places, size = [], [], 0
        if group:
            for at, ids in zip(places, self._group(group)):
                result[at] = ids
        return result

    def _group(self, spaced: list[str]) -> list[np.ndarray]:
        """Ids of texts whose words are parted by white space."""
        lists = pc.ascii_split_whitespace(pa.array(spaced, pa.large_string()))
        words = lists.flatten().dictionary_encode()
        codes = self.memory.codes(words.dictionary.to_pylist())
        found = pa.array(codes, pa.large_binary()).take(words.indices)
        _, places, data = found.buffers()
        places = np.frombuffer(places, np.int64, len(found) + 1)
        ids = np.frombuffer(data or b"", np.uint16, places[-1] // 2)
        cuts = (places[lists.offsets.to_numpy()] // 2).tolist()
        return [ids[begin:end] for begin, end in zip(cuts[:-1], cuts[1:])]


@lru_cache(1)
def encoder(path: str) -> WordEncoder:
    """One encoder a worker process, kept between tasks."""
    return WordEncoder(path)

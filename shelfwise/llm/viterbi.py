"""Best segmentation into the pieces of a SentencePiece vocabulary, as a stream.

The best path over a text is the one with the highest sum of piece scores; of equal ones the
first that a left-to-right pass finds with the longest last piece. ``MODEL`` is a BPE model, whose
scores order merges and are not log probabilities: its ids here are the best path's and not those
of its merges. Going over the characters, only as many states are kept as the longest piece has
characters. Whenever all of them lead back to one boundary, the ids up to it are given out and
forgotten, so memory does not grow with the text. A character that no piece has is written as its bytes, at a score below all others.

Where a space mark follows another character no piece can reach across (that is read off the
vocabulary), so all paths meet there; words between such places are remembered with their ids,
a bounded number of them. New words of a group of texts go through their windows side by side
(``Streams``), one vector operation for a step of all of them; very long ones go alone (``Stream``),
by the same steps.

Cases: null and empty texts have no ids; decoding gives back any text, whatever its characters;
rows that repeat get the same result each; an empty table gives an empty result; other columns
play no part.
"""

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.batches import small

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
MEMORY_WORDS = 200_000  # of each generation
ALONE = 256  # longer words have a stream of their own and are not remembered
TOGETHER = 1 << 14  # words in streams side by side
SETTLINGS = 2  # looks for a meeting of all paths while a window of pieces passes
GROUP = 1 << 22  # characters of texts whose new words are looked for together
UNKNOWN_PENALTY = 10.0


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Vocabulary:
    """Pieces with scores, and the ids of the 256 bytes."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.pieces, self.bytes = {}, [0] * 256
        self.texts = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.texts.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.texts.append(b"")
            else:
                self.pieces[piece] = (i, model.get_score(i))
                self.texts.append(piece.encode())
        self.longest = max(map(len, self.pieces))
        self.unknown = min(score for _, score in self.pieces.values()) - UNKNOWN_PENALTY
        # All beginnings of pieces, with id and score where one is a piece itself.
        self.starts = {piece[:n]: None for piece in self.pieces for n in range(1, len(piece))}
        self.starts |= self.pieces
        self._arrays()
        self.meets_at_space = not any(SPACE in piece.lstrip(SPACE) for piece in self.pieces)

    def _arrays(self):
        """The beginnings of pieces as a tree: nodes are numbers, 0 is the empty beginning."""
        characters = sorted({c for piece in self.pieces for c in piece})
        self.codes = np.zeros(0x110000, np.int32)  # 0: in no piece
        self.codes[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        self.width = len(characters) + 1
        nodes = {"": 0} | {start: i for i, start in enumerate(self.starts, 1)}
        keys = np.array([nodes[start[:-1]] * self.width + int(self.codes[ord(start[-1])])
                         for start in self.starts], np.int64)
        order = np.argsort(keys)
        self.keys, self.children = keys[order], (order + 1).astype(np.int32)
        found = [(-1, 0.0), *(piece or (-1, 0.0) for piece in self.starts.values())]
        self.piece_of = np.array([piece for piece, _ in found], np.int32)
        self.score_of = np.array([score for _, score in found])
        first = np.arange(self.width, dtype=np.int64)
        self.first = self.child(np.zeros(self.width, np.int64), first)

    def child(self, nodes, codes):
        """The nodes one character on; 0 where no piece begins so."""
        keys = nodes * np.int64(self.width) + codes
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (codes > 0), self.children[at], 0)


class Streams:
    """Ids of many texts, each with a window of its own, a step of all of them at a time.

    Scores, lengths and ids of last pieces lie in rings of ``ring`` boundaries; a ring grows only
    while paths of a text do not meet. ``commits`` counts ids given out before a text's end."""

    def __init__(self, vocabulary: Vocabulary, texts: list[str]):
        self.words, self.texts = vocabulary, texts
        self.order = np.argsort([-len(text) for text in texts], kind="stable")
        ordered = [texts[i] for i in self.order]
        self.lengths = np.array([len(text) for text in ordered])
        joined = "".join([text + "\0" for text in ordered])
        self.characters = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        self.coded = vocabulary.codes[self.characters]
        self.starts = np.cumsum(self.lengths + 1) - self.lengths - 1
        self.ring = 1 << (4 * vocabulary.longest - 1).bit_length()
        n = len(texts)
        self.scores = np.full((n, self.ring), -np.inf)
        self.scores[:, 0] = 0.0
        self.last = np.zeros((n, self.ring), np.int32)  # characters of the last piece
        self.piece = np.zeros((n, self.ring), np.int32)  # its id, -1 for a character in no piece
        self.base = np.zeros(n, np.int64)  # ids are given out up to here
        self.out: list[tuple] = []
        self.commits = 0

    def ids(self) -> list[bytes]:
        every = max(1, self.words.longest // SETTLINGS)
        active = len(self.texts)
        for i in range(self.lengths[0]):
            self._step(i, active)
            left = int(np.searchsorted(-self.lengths, -(i + 1), "left"))
            ended = np.arange(left, active)
            self._give(ended, self.lengths[left:active])
            active = left
            if (i + 1) % every == 0 and active:
                self._settle(i + 1, active)
        return self._collected()

    def _step(self, i, active):
        """Follow all pieces that begin at boundary ``i``."""
        words, ring = self.words, self.ring
        self.scores[:active, (i + words.longest) % ring] = -np.inf
        base = self.scores[:active, i % ring].copy()
        node = words.first[self.coded[self.starts[:active] + i]]
        missing = np.flatnonzero(words.piece_of[node] < 0)
        self._offer(missing, i + 1, base[missing] + words.unknown, 1, -1)
        rows = np.flatnonzero(node)
        node = node[rows]
        for n in range(1, words.longest + 1):
            piece = words.piece_of[node]
            whole = np.flatnonzero(piece >= 0)
            which = rows[whole]
            self._offer(which, i + n, base[which] + words.score_of[node[whole]], n, piece[whole])
            node = words.child(node.astype(np.int64), self.coded[self.starts[rows] + i + n]
                               if n < words.longest else np.zeros(len(rows), np.int32))
            alive = np.flatnonzero(node)
            if not len(alive):
                return
            rows, node = rows[alive], node[alive]

    def _offer(self, rows, boundary, scores, length, piece):
        at = rows * self.ring + boundary % self.ring
        better = scores > self.scores.ravel()[at]
        at = at[better]
        self.scores.ravel()[at] = scores[better]
        self.last.ravel()[at] = length
        self.piece.ravel()[at] = piece if np.isscalar(piece) else piece[better]

    def _settle(self, done, active):
        """Ids up to the last boundary that every open path of a text goes through."""
        open_ = done + np.arange(self.words.longest)
        alive = np.isfinite(self.scores[:active, open_ % self.ring])
        at = np.where(alive, open_, done)
        meet = np.empty(active, np.int64)
        rows = np.arange(active)
        while len(rows):
            low = at.min(axis=1)
            meet[rows] = low
            apart = ((at > low[:, None]).any(axis=1)) & (low > self.base[rows])
            # A path that is at the base already leaves nothing to give out.
            rows, at, low = rows[apart], at[apart], low[apart]
            back = self.last.ravel()[rows[:, None] * self.ring + at % self.ring]
            at = np.where(at > low[:, None], at - back, at)
        self._give(np.arange(active), meet)
        self.commits += int((meet > 0).sum())
        while done + 2 * self.words.longest - self.base[:active].min() >= self.ring:
            self._grow(done)

    def _grow(self, done):
        wide = np.arange(max(0, done + self.words.longest - self.ring), done + self.words.longest)
        for name in ("scores", "last", "piece"):
            old = getattr(self, name)
            new = np.full((len(old), 2 * self.ring), -np.inf if name == "scores" else 0, old.dtype)
            new[:, wide % (2 * self.ring)] = old[:, wide % self.ring]
            setattr(self, name, new)
        self.ring *= 2

    def _give(self, rows, until):
        """The pieces of these texts' paths from what is given out up to ``until``."""
        base, at, left = self.base[rows], until, rows
        while True:
            more = at > base
            left, at, base = left[more], at[more], base[more]
            if not len(left):
                break
            place = left * self.ring + at % self.ring
            self.out.append((left, at, self.piece.ravel()[place]))
            at = at - self.last.ravel()[place]
        self.base[rows] = until

    def _collected(self):
        text, end, ids = map(np.concatenate, zip(*self.out))
        order = np.lexsort((end, text))
        text, end, ids = text[order], end[order], ids[order]
        unknown = np.flatnonzero(ids < 0)
        if len(unknown):
            raw = [chr(c).encode() for c in self.characters[self.starts[text[unknown]]
                                                            + end[unknown] - 1]]
            times = np.ones(len(ids), np.int64)
            times[unknown] = [len(c) for c in raw]
            text, ids = np.repeat(text, times), np.repeat(ids, times)
            ids[ids < 0] = [self.words.bytes[b] for c in raw for b in c]
        data = ids.astype(np.uint16).tobytes()
        ends = (2 * np.cumsum(np.bincount(text, minlength=len(self.texts)))).tolist()
        result: list = [None] * len(self.texts)
        for place, begin, until in zip(self.order.tolist(), [0, *ends], ends):
            result[place] = data[begin:until]
        return result


class Stream:
    """Ids of one text given in parts; ``window`` is the most states it has held."""

    def __init__(self, vocabulary: Vocabulary):
        self.words = vocabulary
        self.text = ""  # not settled yet
        self.scores = [0.0]  # best score of a path to each boundary of ``text``
        self.back: list[tuple[int, tuple[int, ...]] | None] = [None]
        self.done = 0  # boundaries whose pieces onward are followed
        self.window = 1

    def push(self, part: str, last=False) -> list[int]:
        """Take more text and give out the ids that are certain by now."""
        self.text += part
        out: list[int] = []
        while self.done < len(self.text) - (0 if last else self.words.longest - 1):
            self._step()
            if self.done % self.words.longest == 0:
                out += self._settle()
        if last:
            out += self._path(len(self.text))
            self.__init__(self.words)
        return out

    def _step(self):
        """Follow all pieces that begin at the next boundary."""
        words, text, i = self.words, self.text, self.done
        grow = min(len(text), i + words.longest) + 1 - len(self.scores)
        if grow > 0:
            self.scores += [float("-inf")] * grow
            self.back += [None] * grow
            self.window = max(self.window, len(self.scores))
        base, scores, back = self.scores[i], self.scores, self.back
        single = False
        if base != float("-inf"):
            for j in range(i + 1, len(scores)):
                found = words.starts.get(text[i:j], False)
                if found is False:
                    break
                if found:
                    single |= j == i + 1
                    if base + found[1] > scores[j]:
                        scores[j] = base + found[1]
                        back[j] = (i, (found[0],))
            if not single and base + words.unknown > scores[i + 1]:
                scores[i + 1] = base + words.unknown
                back[i + 1] = (i, tuple(words.bytes[b] for b in text[i].encode()))
        self.done += 1

    def _path(self, end, begin=0):
        parts = []
        while end > begin:
            end, ids = self.back[end]
            parts.append(ids)
        return [i for ids in reversed(parts) for i in ids]

    def _settle(self):
        """Ids up to the last boundary that every open path goes through."""
        ends = {i for i in range(self.done, len(self.scores)) if self.back[i] or i == self.done}
        ends = {i for i in ends if self.scores[i] != float("-inf")}
        while len(ends) > 1:
            last = max(ends)
            ends.remove(last)
            if last == 0:
                return []
            ends.add(self.back[last][0])
        at = ends.pop()
        if at == 0:
            return []
        out = self._path(at)
        base = self.scores[at]
        self.text = self.text[at:]
        self.scores = [score - base for score in self.scores[at:]]
        self.back = [None] + [step and (step[0] - at, step[1]) for step in self.back[at + 1:]]
        self.done -= at
        return out


class Encoder:
    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # Space marks go with what follows; a line end is no part of any piece.
        alone = "" if any("\n" in piece for piece in self.vocabulary.pieces) else "\n"
        self.cut = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+|{alone}" if alone else
                              f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall

    def _alone(self, word: str) -> bytes:
        stream = Stream(self.vocabulary)
        ids: list[int] = []
        for begin in range(0, len(word), 4096):
            ids += stream.push(word[begin:begin + 4096])
        return np.array(ids + stream.push("", last=True), np.uint16).tobytes()

    def _codes(self, words: set[str]) -> dict[str, bytes]:
        """Ids of distinct words, from memory or by their streams."""
        words = list(words)
        known = list(map(self.young.get, words))
        codes = dict(zip(words, known))
        other = [word for word, code in zip(words, known) if code is None]
        again = {word: code for word, code in zip(other, map(self.old.get, other)) if code}
        codes.update(again)
        self.young.update(again)
        fresh = [word for word in other if word not in again]
        codes.update((word, self._alone(word)) for word in fresh if len(word) > ALONE)
        fresh = [word for word in fresh if len(word) <= ALONE]
        for begin in range(0, len(fresh), TOGETHER):
            some = fresh[begin:begin + TOGETHER]
            ids = Streams(self.vocabulary, some).ids()
            codes.update(zip(some, ids))
            if len(self.young) >= MEMORY_WORDS:
                self.old, self.young = self.young, {}
            self.young.update(zip(some, ids))
        return codes

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, with a space mark before it as SentencePiece puts one."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        result: list[np.ndarray] = []
        group, size = [], 0
        for text in texts:
            group.append(SPACE + text.replace(" ", SPACE) if text else "")
            size += len(text)
            if size >= GROUP:
                result += self._group(group)
                group, size = [], 0
        return result + self._group(group)

    def _group(self, texts: list[str]) -> list[np.ndarray]:
        if not self.vocabulary.meets_at_space:
            return [np.frombuffer(self._alone(text), np.uint16) for text in texts]
        words = [self.cut(text) for text in texts]
        codes = self._codes(set().union(*words))
        return [np.frombuffer(b"".join(map(codes.__getitem__, some)), np.uint16) for some in words]

    def decode(self, ids) -> str:
        texts = self.vocabulary.texts
        text = b"".join([texts[i] for i in ids]).decode()
        return text.replace(SPACE, " ")[1:]


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One encoder a worker process, kept between tasks."""
    return Encoder(path)


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in small(batches, 1000):
        counts, sums, same = [], [], []
        ids_column = []
        texts = [text or "" for text in batch.column(1).to_pylist()]
        for text, ids in zip(texts, encoder(path).encode_all(texts)):
            ids_column.append(ids.tobytes())
            counts.append(len(ids))
            sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
            # The space mark itself decodes to a space, as in SentencePiece.
            same.append(encoder(path).decode(ids.tolist()) == text.replace(SPACE, " "))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.int64()),
             pa.array(same), pa.array(ids_column, pa.binary())],
            names=["doc_id", "n_ids", "ids_crc32", "decodes", "ids"])


def encode(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Every document's ids (16-bit, little-endian), their number and checksum, and whether they
    decode to the text."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        partial(encoded, path=path or default_path()),
        f"doc_id {kind}, n_ids long, ids_crc32 long, decodes boolean, ids binary")

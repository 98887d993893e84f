"""Token files, packing and Viterbi against plain versions."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import packing, rans, token_files, token_ids, viterbi

AWKWARD = [
    (1, None), (2, ""), (3, "  \n"), (4, "a’s “quoted” don't I'LL 3.5% ²½ ªº İstanbul Σας"),
    (5, "naïve <|endoftext|> é"), (5, "another text of the same document"), (7, "日本語 🙂"),
    (None, "no id"), (8, "***%%% &&x&& it's they'd's"), (9, "long " * 40_000),
    (10, "tab\tsep\x0bv\x0cf\rx\x1cy z\u0085q\xa0r"), (8, "***%%% &&x&& it's they'd's"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, text, "x", "ids") for i, text in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, tie string, ids string")


@pytest.fixture(scope="module")
def whole():
    return token_ids.encoder(token_ids.default_path()).whole


def ids_of(whole, text, end):
    return np.array(whole.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_words_are_encoded_as_the_library_encodes_whole_texts(whole):
    letters = "abcXYZäß'.,*%3 \n\t’é!?"
    rng = random.Random(3)
    texts = [text or "" for _, text in AWKWARD]
    texts += ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(400)]
    found = token_ids.encoder(token_ids.default_path()).encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_memory_that_is_too_small_changes_nothing(monkeypatch, whole):
    monkeypatch.setattr(token_ids, "MEMORY_WORDS", 3)
    encoder = token_ids.WordEncoder(token_ids.default_path())
    text = "one two three four five six seven, one two. " * 3
    (ids,) = encoder.encode([text])
    assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, rans.LANES - 1, rans.LANES + 1, rans.BLOCK - 5])
def test_blocks_decode_to_what_was_encoded(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.2, n), 49_000).astype(np.uint16)
    table = rans.Table(np.bincount(ids, minlength=1 << 16) + (np.arange(1 << 16) == 3))
    block = rans.encode_block(ids, table)
    assert (rans.decode_block(block, table) == ids).all()
    for i in reversed(range(rans.sections(block))):  # sections decode by themselves
        size = rans.LANES * rans.CHECKPOINT
        assert (rans.decode_section(block, i, table) == ids[i * size:(i + 1) * size]).all()
    if n > rans.LANES:
        broken = bytearray(block)
        broken[rans.HEADER.size] ^= 1
        with pytest.raises(ValueError, match="checksum"):
            rans.decode_block(bytes(broken), table)


def test_checksums_join():
    a, b = b"first", b"second part" * 9
    assert rans.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_token_files_round_trip(spark, awkward, whole, monkeypatch):
    found = sorted(tuple(r) for r in token_files.round_trip(awkward).select(
        "start", "n_tokens", "ids_crc32", F.coalesce("doc_id", F.lit(-1))).collect())
    texts = defaultdict(list)
    for i, text in AWKWARD:
        texts[-1 if i is None else i].append(ids_of(whole, text, 2))
    at = 0
    assert [row[3] for row in found] == sorted(-1 if i is None else i for i, _ in AWKWARD)
    for start, n, crc, doc_id in found:
        assert start == at
        assert (n, crc) in {(len(x), zlib.crc32(x.tobytes())) for x in texts[doc_id]}
        at += n
    empty = awkward.where("doc_id = 99")
    assert token_files.round_trip(empty).count() == 0


def check_packing(rows, wanted):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append(row)
        pieces[row.doc_id, row.doc_tokens].append(row)
    padding = total = 0
    for members in sequences.values():
        members.sort(key=lambda r: r.offset)
        at = 0
        for row in members:
            assert row.offset == at and row.length > 0
            at += row.length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    counted = Counter((doc, len(ids)) for doc, ids in wanted)
    for (doc, n), members in pieces.items():
        assert sum(r.length for r in members) == n * counted[doc, n]
        ids = next(ids for d, ids in wanted if (d, len(ids)) == (doc, n))
        for row in members:
            part = ids[row.start:row.start + row.length]
            assert zlib.crc32(part.tobytes()) == row.ids_crc32
    assert total == sum(len(ids) for _, ids in wanted)
    steps = Counter()
    for members in sequences.values():
        steps[members[0].step_id] += members[0].context_size
    assert max(steps.values(), default=0) <= packing.STEP_TOKENS
    return padding / max(total, 1)


def test_pieces_hold_each_id_once_with_little_padding(spark, awkward, whole):
    wanted = [(i, ids_of(whole, text, 1)) for i, text in AWKWARD]
    assert check_packing(packing.pack(awkward).collect(), wanted) < 0.05
    assert packing.pack(awkward.where("doc_id = 99")).count() == 0


def test_steps_are_equal_but_for_the_last_of_a_tier(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["one", "two", "sea"], k=rng.randrange(1, 3000)))
             for _ in range(150)]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack(documents.repartition(6)).collect()
    sizes = {(r.sequence_id, r.step_id, r.context_size) for r in rows}
    assert len(sizes) == len({r.sequence_id for r in rows})
    tokens, tiers = Counter(), {}
    for _, step, size in sizes:
        tokens[step] += size
        assert tiers.setdefault(step, size) == size
    short = Counter(tiers[step] for step, n in tokens.items() if n != packing.STEP_TOKENS)
    assert max(tokens.values()) <= packing.STEP_TOKENS and max(short.values()) <= 1
    assert len(tokens) > len(set(tiers.values()))


def test_packer_drains_when_it_holds_much(spark, whole, monkeypatch):
    monkeypatch.setattr(packing, "HELD", 3000)
    packer, rng, wanted = packing.Packer(0), random.Random(1), []
    for doc in range(300):
        ids = np.array(rng.choices(range(9000), k=rng.randrange(1, 900)), "<u2")
        wanted.append((doc, ids.astype("<u4")))
        packer.add(doc, 0, len(ids), ids)
        if packer.held >= packing.HELD:
            packer.drain()
            assert packer.held < 2048
    packer.finish()
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
             "context_size", "step_id")
    rows = [type("Piece", (), dict(zip(names, row)))() for row in packer.rows]
    assert check_packing(rows, wanted) < 0.02


def best_path(words, text):
    """All segmentations at once, without windows."""
    text = viterbi.SPACE + text.replace(" ", viterbi.SPACE) if text else ""
    best = [(0.0, [])] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for begin in range(max(0, end - words.longest), end):
            piece = words.pieces.get(text[begin:end])
            if piece:
                score, ids = piece[1], [piece[0]]
            elif end == begin + 1:
                score, ids = words.unknown, [words.bytes[b] for b in text[begin].encode()]
            else:
                continue
            score += best[begin][0]
            if best[end] is None or score > best[end][0]:
                best[end] = (score, best[begin][1] + ids)
    return best[-1][1]


def test_viterbi_finds_the_best_path_and_decodes(spark, awkward):
    encoder = viterbi.encoder(viterbi.default_path())
    texts = [text or "" for _, text in AWKWARD if len(text or "") < 1000]
    texts += ["a" * 200, "▁x▁ y", "nospaces" * 40, "  two  spaces  "]
    for text in texts:
        ids = encoder.encode(text).tolist()
        assert ids == best_path(encoder.vocabulary, text)
        assert encoder.decode(ids) == text.replace(viterbi.SPACE, " ")
    rows = viterbi.encode(awkward).collect()
    assert len(rows) == len(AWKWARD) and all(row.decodes for row in rows)
    assert viterbi.encode(awkward.where("doc_id = 99")).count() == 0


def fields(data):
    """Places of the fields of a protocol buffer: number, begin of the key, of the value, end."""
    def varint(at):
        value = shift = 0
        while True:
            value |= (data[at] & 0x7F) << shift
            shift, at = shift + 7, at + 1
            if data[at - 1] < 0x80:
                return value, at

    at = 0
    while at < len(data):
        begin = at
        key, at = varint(at)
        value = at
        if key & 7 == 2:
            size, value = varint(at)
            at = value + size
        elif key & 7 == 0:
            at = varint(at)[1]
        else:
            at += 8 if key & 7 == 1 else 4
        yield key >> 3, begin, value, at


def test_no_path_of_the_library_is_better(tmp_path, spark):
    """The library looks for the best path when the same pieces are named a unigram model. In few
    words it takes one whose sum of scores is lower."""
    from sentencepiece import SentencePieceProcessor

    data = bytearray(open(viterbi.default_path(), "rb").read())
    _, _, spec, end = next(field for field in fields(data) if field[0] == 2)  # trainer_spec
    _, _, kind, _ = next(field for field in fields(data[spec:end]) if field[0] == 3)  # model_type
    assert data[spec + kind] == 2
    data[spec + kind] = 1
    path = tmp_path / "unigram.model"
    path.write_bytes(data)
    library, encoder = SentencePieceProcessor(model_file=str(path)), viterbi.encoder(str(path))
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    words = sorted({word for row in rows for word in (row.text or "").split()})
    words += ["xyz é", "a  b", "日本語 abc"]
    same = 0
    for word, ids in zip(words, map(np.ndarray.tolist, encoder.encode_all(words)), strict=True):
        other = library.encode(word)
        same += ids == other
        assert ids == other or sum(map(library.get_score, ids)) > sum(
            map(library.get_score, other)), word
    assert same > 0.99 * len(words)


def test_streams_side_by_side_equal_streams_alone(spark):
    """Ordinary words: the same ids, given out before the word's end where all paths meet."""
    words = viterbi.encoder(viterbi.default_path()).vocabulary
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    cut = viterbi.encoder(viterbi.default_path()).cut
    texts = sorted({w for row in rows for w in cut((row.text or "").replace(" ", viterbi.SPACE))})
    rng = random.Random(4)
    texts += ["".join(rng.choices("abé日\x00\u0301 😀", k=rng.randrange(1, 90)))
              for _ in range(300)]
    streams = viterbi.Streams(words, texts)
    found = streams.ids()
    assert streams.commits > 100
    for text, ids in zip(texts, found, strict=True):
        stream = viterbi.Stream(words)
        assert np.frombuffer(ids, np.uint16).tolist() == stream.push(text, last=True), text


def test_rings_grow_while_paths_do_not_meet():
    """Two ways of cutting that meet nowhere before the end keep the window open."""
    words = viterbi.encoder(viterbi.default_path()).vocabulary

    class Two:
        codes = np.zeros(0x110000, np.int32)
        pieces = {"a": (5, -9.0), "ab": (1, -1.0), "ba": (2, -1.0), "abab": (3, -2.0)}
        longest, unknown, bytes = 4, -100.0, words.bytes
        starts = {"a": (5, -9.0), "b": None, "ab": (1, -1.0), "ba": (2, -1.0), "aba": None,
                  "abab": (3, -2.0)}
        child = viterbi.Vocabulary.child
        _arrays = viterbi.Vocabulary._arrays

    two = Two()
    two._arrays()
    texts = ["ab" * 60, "ab" * 60 + "a", "b" * 7, "a"]
    streams = viterbi.Streams(two, texts)
    for text, ids in zip(texts, streams.ids(), strict=True):
        stream = viterbi.Stream(two)
        assert np.frombuffer(ids, np.uint16).tolist() == stream.push(text, last=True), text
    assert streams.ring > 16


def test_small_memory_changes_no_ids(monkeypatch):
    text = "one two three four one two three, " * 5 + "w" * 300
    wanted = viterbi.Encoder(viterbi.default_path()).encode(text).tolist()
    monkeypatch.setattr(viterbi, "MEMORY_WORDS", 2)
    monkeypatch.setattr(viterbi, "TOGETHER", 3)
    monkeypatch.setattr(viterbi, "GROUP", 10)
    encoder = viterbi.Encoder(viterbi.default_path())
    assert [ids.tolist() for ids in encoder.encode_all([text, "", text])] == [wanted, [], wanted]


def test_stream_keeps_a_bounded_window_and_gives_ids_early():
    words = viterbi.encoder(viterbi.default_path()).vocabulary
    stream, out, text = viterbi.Stream(words), [], "abcdefgh" * 3000
    early = 0
    for begin in range(0, len(text), 100):
        out += stream.push(text[begin:begin + 100])
        early = max(early, len(out))
        assert len(stream.text) <= 100 + 4 * words.longest
    assert early > 100
    out += stream.push("", last=True)
    whole = viterbi.Stream(words)
    assert out == whole.push(text) + whole.push("", last=True)

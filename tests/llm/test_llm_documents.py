"""Operators on documents against brute force, with awkward rows, and the pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from shelfwise.llm import jaccard, language, line_dedup, quality
from shelfwise.llm.tables import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\f\r"


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, text, lang, source, None if text is None else len(text), "x")
         for i, text, lang, source in rows], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, shared lines, short, empty, missing and very long texts."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 7)))
    line = "This line is on very many pages"
    rows = []
    for i in range(120):
        words = [word() for _ in range(rng.randrange(60, 200))]
        rows.append([" ".join(words[:40]), line, " ".join(words[40:]), line.upper() + "  "])
    out = ["\n".join(lines) for lines in rows]
    base = [word() for _ in range(150)]
    for _ in range(80):  # near copies of one text
        copy = list(base)
        for _ in range(rng.randrange(0, 14)):
            copy[rng.randrange(len(copy))] = word()
        out.append(" ".join(copy))
    out += [out[3]] * 9 + [out[125]] * 4
    out += [None, "", " \n ", "one", "One", "two words", "two words", "x " * 30_000, "é" * 9]
    rows = [(i * 3 % 1009, text, "en", f"s{i % 3}" if i % 7 else None)
            for i, text in enumerate(out)]
    rows += [(None, out[0], "en", "s1"), (None, None, None, None),
             (rows[5][0], out[6], "en", "s2"), rows[7]]
    rng.shuffle(rows)
    return rows


def reference_lines(rows):
    """What line dedup must leave of each row, as a multiset of document and text."""
    holders = defaultdict(set)
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    number = lambda i: 1 << 62 if i is None else i
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(number(i))
    out = Counter()
    for i, text, *_ in rows:
        kept = [line for line in (text or "").split("\n") if not (
            len(key(line)) >= 10 and len(holders[key(line)]) > 1
            and min(holders[key(line)]) != number(i))]
        out[i, None if text is None else "\n".join(kept)] += 1
    return out


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_line_dedup_keeps_first_holders(spark, texts, partitions):
    """Many partitions cut the run of the line that most documents have."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        documents = frame(spark, texts)
        found = line_dedup.dedup(documents)
        assert found.columns == documents.columns
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert Counter((r.doc_id, r.text) for r in rows) == reference_lines(texts)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)


def test_line_dedup_of_nothing(spark):
    assert line_dedup.dedup(frame(spark, [])).count() == 0


def components(ids, links):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def reference_groups(rows, width, percent):
    sets = []
    for i, text, *_ in rows:
        words = (text or "").encode().translate(bytes(
            b + 32 if 65 <= b <= 90 else b for b in range(256))).split()
        found = {tuple(words[k:k + width]) for k in range(len(words) - width + 1)}
        sets.append((i, found or ({tuple(words)} if words else set())))
    known = [(i, s) for i, s in sets if i is not None and s]
    links = [(i, j) for k, (i, s) in enumerate(known) for j, t in known[:k]
             if 100 * len(s & t) >= percent * len(s | t)]
    label = components({i for i, _ in sets if i is not None}, links)
    return Counter((i, len(s), label.get(i)) for i, s in sets)


@pytest.mark.parametrize(("width", "percent", "leaf", "run"), [
    (3, 90, 2000, 4096), (5, 80, 2000, 4096), (3, 70, 20, 4096), (3, 80, 12, 3)])
def test_groups_equal_all_pairs(spark, texts, monkeypatch, width, percent, leaf, run):
    """Small leaves send cells through pivots and blocks, short runs through chains."""
    monkeypatch.setattr(jaccard, "PIVOTS", 5)
    monkeypatch.setattr(jaccard, "RUN", run)
    rows = jaccard.groups(frame(spark, texts), width, percent, leaf=leaf).collect()
    assert Counter(map(tuple, rows)) == reference_groups(texts, width, percent)


@pytest.mark.parametrize("tail", [1, 2, 3, 9])
def test_runs_longer_than_the_buffer_are_chained_to_their_end(monkeypatch, tail):
    """Texts on either side of a cut meet, however few rows of a run are left after it."""
    import pyarrow as pa

    monkeypatch.setattr(jaccard, "BUFFER", 20)
    monkeypatch.setattr(jaccard, "RUN", 10)
    rng = np.random.default_rng(tail)
    keys = [1] * 5 + [2] * (58 + tail) + [3] * 30 + [4] * 3
    rows = []
    for i, key in enumerate(keys):  # all texts of a run unrelated, so no bound ties them
        shingles = rng.integers(0, 1 << 60, 40).astype(np.uint64)
        rows.append((1, key, i, 40, None, None, jaccard.class_counts(shingles, 80)))
    schema = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("id", pa.int64()),
                        ("n", pa.int32()), ("a", pa.int64()), ("b", pa.int64()),
                        ("counts", pa.binary())])
    batches = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
        zip(*rows[k:k + 20]), schema)], schema=schema) for k in range(0, len(rows), 20)]
    links = [link for batch in jaccard.candidate_links(iter(batches), 80)
             for link in zip(batch["key"].to_pylist(), batch["id"].to_pylist())]
    label = components(range(len(keys)), links)
    for key in (2, 3):
        assert len({label[i] for i, k in enumerate(keys) if k == key}) == 1, key


def region_batches(rows, size=20):
    import pyarrow as pa

    schema = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("id", pa.int64()),
                        ("n", pa.int32()), ("a", pa.int64()), ("b", pa.int64()),
                        ("counts", pa.binary())])
    return [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
        zip(*rows[k:k + size]), schema)], schema=schema) for k in range(0, len(rows), size)]


@pytest.mark.parametrize("n", [500, 1_100, 8_000, 30_000])
def test_unrelated_texts_of_a_region_make_no_cell(n):
    """Long ones neither: cells of all long texts were compared in copies that grow with the
    square of their number. Nor do the more a region has."""
    rng = np.random.default_rng(n)
    sets = [rng.integers(0, 1 << 60, n).astype(np.uint64) for _ in range(30)]
    near = sets[0].copy()
    near[:n // 20] = rng.integers(0, 1 << 60, n // 20)
    rows = [(1, 7, i, n, None, None, jaccard.class_counts(s, 80))
            for i, s in enumerate([*sets, near])]
    links = [link for batch in jaccard.candidate_links(iter(region_batches(rows)), 80)
             for link in zip(batch["key"].to_pylist(), batch["id"].to_pylist())]
    assert [sorted(link) for link in links] == [[0, 30]]


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_regions_of_one_text_are_left_out(size):
    keys = [1, 2, 2, 3, 4, 4, 4, 4, 4, 5, 6, 6]
    rows = [(0, 0, 0, 1, 1, 1, b"x"), *((1, key, i, 9, None, None, None)
                                        for i, key in enumerate(keys))]
    found = [row for batch in jaccard.shared_regions(iter(region_batches(rows, size)))
             for row in zip(batch["kind"].to_pylist(), batch["id"].to_pylist())]
    assert found == [(0, 0), *((1, i) for i, key in enumerate(keys) if keys.count(key) > 1)]


@pytest.mark.parametrize("short", [True, False])
def test_long_texts_need_no_copies(spark, monkeypatch, short):
    """Texts that share one passage and little else are told apart before any set is shuffled."""
    given = []
    whole = jaccard.exact_links
    monkeypatch.setattr(jaccard, "exact_links", lambda cells, *rest: given.append(
        {r.id for r in cells.collect()}) or whole(cells, *rest))
    rng = np.random.default_rng(5)
    n = 300 if short else 7_500
    passage = " ".join(f"p{k}" for k in range(n // 3))
    texts = [(i, passage + " " + " ".join(f"w{k}" for k in rng.integers(0, 1 << 40, n)))
             for i in range(6)]
    texts.append((9, texts[2][1] + " more"))
    rows = jaccard.groups(frame(spark, [(*row, "en", "s") for row in texts])).collect()
    assert {r.doc_id: r.component_id for r in rows} == {**{i: i for i in range(6)}, 9: 2}
    assert given == [{2, 9}]


def test_groups_of_nothing(spark):
    assert jaccard.groups(frame(spark, [])).count() == 0


def test_cells_of_few_long_texts_are_cut_in_parts(spark, monkeypatch):
    """Forty texts of 100 shingles are too many shingles for one task, if not too many texts."""
    whole = jaccard.to_regions

    def bounded(members, pivots, percent):
        assert members.num_rows <= 20
        return whole(members, pivots, percent)

    monkeypatch.setattr(jaccard, "to_regions", bounded)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 60, (20, 100)).astype(np.uint64)
    rows = [(1, i, 100, base[i // 2].tobytes()) for i in range(40)]  # pairs of equal texts
    cells = spark.createDataFrame(rows, "cell long, id long, n int, shingles binary")
    links = jaccard.exact_links(cells, 80, leaf=2000, leaf_shingles=500).collect()
    label = components(range(40), [tuple(link) for link in links])
    assert label == {i: i - i % 2 for i in range(40)}


def test_regions_bring_close_texts_together():
    import pyarrow as pa

    rng = np.random.default_rng(0)
    base = [rng.integers(0, 1 << 60, 60).astype(np.uint64) for _ in range(4)]
    sets = []
    for k in range(80):
        keep = rng.random(60) > rng.random() * 0.3
        extra = rng.integers(0, 1 << 60, rng.integers(0, 8)).astype(np.uint64)
        sets.append(np.unique(np.concatenate([base[k % 4][keep], extra])))
    cells = pa.table({"cell": [1] * 80, "id": list(range(80)),
                      "n": pa.array([len(s) for s in sets], pa.int32()),
                      "shingles": [s.tobytes() for s in sets]})
    pivots = pa.table({"pivot": [0, 1, 2], "shingles": [sets[i].tobytes() for i in range(3)]})
    found = jaccard.to_regions(cells, pivots, 80)
    regions = defaultdict(set)
    for i, pivot in zip(found["id"].to_pylist(), found["pivot"].to_pylist()):
        regions[i].add(pivot)
    for i in range(80):
        for j in range(i):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                assert regions[i] & regions[j]


def test_language_of_held_out_documents(spark):
    documents = table(spark, SMALL.replace("0.001", "0.01"), "documents")
    rows = language.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
    held = [row for row in rows if row.held_out]
    assert sum(row.lang == row.lang_pred for row in held) / len(held) > 0.98


def plain_profile(texts, size=400):
    """The most frequent n-grams of words between marks, equal counts by their code points."""
    counts = Counter()
    for text in texts:
        letters = "".join(c if c.isalpha() else " " for c in text.lower())
        for word in letters.split():
            marked = f"\x01{word}\x01"
            counts.update(word)
            for n in (2, 3):
                counts.update(marked[i:i + n] for i in range(len(marked) - n + 1))

    def code(gram):
        return sum(ord(c) << 21 * i for i, c in enumerate(reversed(gram)))

    return sorted(counts, key=lambda gram: (-counts[gram], code(gram)))[:size]


def test_language_equals_a_plain_comparison_of_ranks(spark):
    documents = table(spark, SMALL, "documents").select("doc_id", "text", "lang")
    rows = documents.collect()
    learned = defaultdict(list)
    for row in rows:
        if row.text is not None and row.lang and zlib.crc32(str(row.doc_id).encode()) % 4 != 2:
            learned[row.lang].append(row.text)
    ranks = {lang: {gram: i for i, gram in enumerate(plain_profile(texts))}
             for lang, texts in learned.items()}
    found = {row.doc_id: row for row in language.identify(documents).collect()}
    assert len(found) == len(rows) and len(ranks) > 2
    for row in rows:
        own = plain_profile([row.text or ""])
        if not own:
            assert (found[row.doc_id].lang_pred, found[row.doc_id].score) == ("und", 0)
            continue
        far = {lang: sum(abs(places[gram] - i) if gram in places else 400
                         for i, gram in enumerate(own)) for lang, places in ranks.items()}
        best = min(far, key=lambda lang: (far[lang], lang))
        assert found[row.doc_id].lang_pred == best
        assert found[row.doc_id].score == pytest.approx(1 - far[best] / (400 * len(own)), abs=1e-12)


def test_language_of_awkward_rows(spark):
    rows = [(1, "the cat and the dog", "en", "s"), (3, "der Hund und die Katze", "de", "s"),
            (4, None, "en", "s"), (5, "12 % -", "de", "s"), (6, "und die und der", None, "s"),
            (None, "the dog and the cat", None, None), (6, "und die und der", None, "s"),
            (8, "x" * 100_000, "en", "s")]
    found = language.identify(frame(spark, rows)).collect()
    by = defaultdict(list)
    for row in found:
        by[row.doc_id].append((row.lang_pred, row.score > 0))
    assert len(found) == len(rows)
    assert by[4] == by[5] == [("und", False)]
    assert by[6] == [("de", True)] * 2 and by[None] == [("en", True)]
    nothing = language.identify(frame(spark, [(1, "no labels", None, "s")])).collect()
    assert [row.lang_pred for row in nothing] == ["und"]
    assert language.identify(frame(spark, [])).count() == 0
    kept = language.accept(frame(spark, rows), 0.1)
    assert kept.columns == frame(spark, rows).columns
    assert {row.doc_id for row in kept.collect()} >= {1, 3, 6, None}


def test_lines_sent_to_documents_and_lines_joined_give_the_same(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = documents.selectExpr("cast(NULL AS long) AS doc_id", "NULL AS text", *(
        f"`{name}`" for name in documents.columns if name not in ("doc_id", "text"))).limit(2)
    documents = documents.unionByName(documents.limit(50)).unionByName(odd)
    limits = quality.Limits(min_documents=3, percent=1, kept_percent=60)
    sent, joined = (
        sorted(map(repr, quality.clean(documents, limits=limits, shared=n).collect()))
        for n in (quality.SHARED_LINES, 0))
    assert sent == joined and 0 < len(sent) < documents.count()
    texts = {row.text for row in documents.select("text").collect()}
    cleaned = quality.clean(documents, limits=limits)
    assert any(row.text not in texts for row in cleaned.select("text").collect())


def test_quality_removes_lines_of_a_host_and_rejects_depleted_documents(spark):
    rng = random.Random(2)
    body = lambda: " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(70))
    menu = "Home Shop Contact Imprint " * 12
    rows = [(i, f"{body()}\n{menu}", "en", "shop") for i in range(30)]
    rows += [(100 + i, f"{menu}\nrest {i}\n" + "w " * 0 + menu.upper(), "en", "shop")
             for i in range(3)]
    rows += [(200, f"{body()}\n{menu}", "en", "other"), (201, None, "en", None),
             (202, "short", "en", "shop"), rows[0], (None, f"{body()}\n{menu}", "en", "shop")]
    limits = quality.Limits(min_documents=20, percent=50)
    documents = frame(spark, rows)
    found = {r.doc_id: r for r in quality.judge(documents, limits=limits).collect()}
    assert all(found[i].kept and found[i].removed_chars == len(menu) for i in range(30))
    assert not any(found[100 + i].kept for i in range(3))  # little but the menu is left
    assert found[200].kept and found[200].removed_chars == 0  # another host
    assert not found[201].kept and found[202].base_failed
    cleaned = quality.clean(documents, limits=limits)
    assert cleaned.columns == documents.columns
    kept = cleaned.collect()
    assert len(kept) == 33
    assert all(menu not in r.text and r.n_chars == len(r.text) for r in kept if r.doc_id != 200)
    assert quality.judge(frame(spark, [])).count() == 0


def test_copies_of_a_text_are_no_shared_lines(spark):
    text = " ".join(f"word{i}" for i in range(60)) + "\nand its second line"
    documents = frame(spark, [(i, text, "en", "s") for i in range(60)])
    assert all(r.kept for r in quality.judge(documents).collect())


def test_pipeline_stages_hand_over_documents(spark, tmp_path):
    documents = table(spark, SMALL, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "language_id", "line_dedup", "jaccard_join", "packing"]
    rows, given = documents, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = rows
        stage(spark, rows, SMALL).write.parquet(f"{tmp_path}/{name}")
        rows = spark.read.parquet(f"{tmp_path}/{name}")
        assert rows.columns == documents.columns
        assert rows.count() == rows.select("doc_id").distinct().count()
    # One document of each group stays.
    before = [(r.doc_id, r.text) for r in given.collect()]
    wanted = {i for i, _, label in reference_groups(before, 5, 80) if i == label}
    assert {r.doc_id for r in rows.collect()} == wanted
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, SMALL)
    assert packed.select("doc_id").distinct().count() == len(wanted)


def test_one_of_each_keeps_rows_without_an_id(spark, texts):
    table = frame(spark, texts).selectExpr("*", "1 AS kept_id", "2 AS kept", "3 AS component_id")
    kept = jaccard.one_of_each(table).collect()
    assert {(r.kept_id, r.kept, r.component_id) for r in kept} == {(1, 2, 3)}
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    wanted = {i for i, _, label in reference_groups(texts, 5, 80) if i is not None and i == label}
    assert sorted(ids) == sorted(wanted)
    assert sum(r.doc_id is None for r in kept) == 2

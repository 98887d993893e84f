"""Vectors, URL filters and tool calls against brute force, with awkward rows."""

import json

import numpy as np
import pytest

from shelfwise.llm import tool_calls, urls, vectors


def reference_vectors(ids, rows, threshold=0.9):
    good = [(i, np.array(v, float)) for i, v in zip(ids, rows)
            if v and len(v) == 16 and None not in v and np.isfinite(v).all() and np.any(v)]
    unit = np.array([v / np.linalg.norm(v) for _, v in good])
    linked = unit @ unit.T >= threshold
    label = {i: i for i in ids}
    for _ in range(len(good)):
        for k, (i, _) in enumerate(good):
            near = [good[j][0] for j in np.flatnonzero(linked[k])]
            low = min(label[j] for j in near)
            for j in near:
                label[j] = low
    counts = dict.fromkeys(ids, 0) | {i: int(linked[k].sum()) - 1 for k, (i, _) in enumerate(good)}
    return {i: (counts[i], label[i], label[i] == i) for i in ids}


@pytest.mark.parametrize("block", [2048, 7])
def test_vectors_equal_all_pairs(spark, block):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    rows = [list(map(float, centres[k % 40] + 0.2 * rng.normal(size=16))) for k in range(400)]
    rows += [rows[0]] * 30 + [[2 * x for x in rows[1]]]
    rows += [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 3]
    ids = list(range(5, 5 + len(rows)))
    table = spark.createDataFrame(list(zip(ids, rows, ["x"] * len(ids))),
                                  "vec_id long, embedding array<double>, rep string")
    found = vectors.near_duplicates(table, spread=16.0, lists=9, block=block).collect()
    assert {r.vec_id: tuple(r)[1:] for r in found} == reference_vectors(ids, rows)
    usual = vectors.near_duplicates(table).collect()
    assert sorted(usual) == sorted(found)
    assert vectors.near_duplicates(table.where("vec_id < 0")).count() == 0


def brute_force(rows, threshold=0.9):
    """Number of links and smallest connected id of each row, within equal lengths."""
    counts, label = [], list(range(len(rows)))
    near = []
    unit = [np.array(v) / np.linalg.norm(v) for v in rows]
    for i, v in enumerate(unit):
        near.append([j for j, w in enumerate(unit)
                     if j != i and len(v) == len(w) and v @ w >= threshold])
        counts.append(len(near[-1]))
    changed = True
    while changed:
        changed = False
        for i, others in enumerate(near):
            low = min([label[i], *(label[j] for j in others)])
            for j in [i, *others]:
                changed |= label[j] != low
                label[j] = low
    return {i: (counts[i], label[i], label[i] == i) for i in range(len(rows))}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_of_each_length_link_with_their_own(spark, kind):
    rng = np.random.default_rng(11)
    rows = []
    for dim, n in ((16, 90), (8, 60), (32, 40), (3, 2), (1, 3)):
        centres = rng.normal(size=(8, dim))
        rows += [list(map(float, centres[k % 8 if dim > 3 else 0] * (1 + k))) for k in range(n)]
    table = spark.createDataFrame(list(enumerate(rows)), f"vec_id long, embedding array<{kind}>")
    found = vectors.near_duplicates(table).collect()
    assert {r.vec_id: tuple(r)[1:] for r in found} == brute_force(rows)


@pytest.mark.parametrize("block", [2048, 40])
def test_no_link_is_missed_where_offsets_lie_in_few_directions(spark, block):
    """A circle's arc in 64 dimensions: every offset points at the next list's plane."""
    rng = np.random.default_rng(12)
    plane = np.linalg.qr(rng.normal(size=(64, 2)))[0]
    angle = rng.uniform(0, 2 * np.pi, 60)
    # Each has a neighbour just within the threshold, and some are copies.
    angle = np.concatenate([angle, angle + np.arccos(0.9) * 0.995, angle[:20]])
    points = np.stack([np.cos(angle), np.sin(angle)], 1) @ plane.T
    rows = [list(map(float, v)) for v in points]
    table = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    wanted = brute_force(rows)
    for lists in (None, 40):
        found = vectors.near_duplicates(table, lists=lists, block=block).collect()
        assert {r.vec_id: tuple(r)[1:] for r in found} == wanted


def test_no_pair_at_the_threshold_is_missed(spark):
    rng = np.random.default_rng(9)
    a = rng.normal(size=(400, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=(400, 64))
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    pairs = 0.905 * a + np.sqrt(1 - 0.905 ** 2) * b
    rows = [(i, list(map(float, v))) for i, v in enumerate(np.concatenate([a, pairs]))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in vectors.near_duplicates(table, lists=30).collect()}
    assert all(found[i] > 0 for i in range(400))


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/es/x", "allow"),
         ("a.example.org", "/es/", "allow"), ("EXAMPLE.org", "/en/1", "block"), (None, "/", "block"),
         ("com", None, "block"), ("net", "/a", "allow"), ("net", "/a", "block"), ("net", "", "allow")]
URLS = ["http://example.org/es/1", "https://www.EXAMPLE.org/es/xyz?q#f", "http://a.example.org/es/",
        "http://b.a.example.org/es/x", "x://org", "x://org/", "x://notorg/", None, "no scheme", "",
        "http://net", "http://x.net/a/b", "http://x.net/b", "http://example.org/en/12#a?b",
        "a://b://example.org/", "http://..org/", "http://ünï.org/ü", "http://" + "a." * 500 + "org/x"]


def reference_rule(url):
    if not url or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut].lower(), rest[cut:]
    path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    best = max(((len(h) + len(p), len(h), h.lower() + p, v) for h, p, v in RULES
                if h and p is not None and (host == h.lower() or host.endswith("." + h.lower()))
                and path.startswith(p)), default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("sweep", [100_000, 2])
def test_urls_get_the_longest_rule(spark, sweep):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    rows = [(i, url, "own", "b", 1, "o", 2) for i, url in enumerate(URLS * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, best string,"
                                        " salt int, own string, depth int")
    found = urls.verdicts(pages, rules, sweep_rows=sweep).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found} == {
        i: reference_rule(url) for i, url, *_ in rows}
    assert {(r.best, r.salt, r.own, r.depth) for r in found} == {("b", 1, "o", 2)}
    assert urls.verdicts(pages.where("page_id < 0"), rules).count() == 0
    free = urls.verdicts(pages, rules.where("host = 'x'")).collect()
    assert {(r.rule, r.verdict) for r in free} == {(None, "allow")}


def test_deep_nests_of_rules(spark):
    """Many rules inside each other on one host, and pages at every depth of every branch."""
    paths = ["/" + "/".join("ab"[(n >> i) & 1] for i in range(k)) for k in range(7)
             for n in range(2 ** k)]
    rules = [("x.org", path, "block" if i % 3 else "allow") for i, path in enumerate(paths)]
    pages = [(i, f"http://{'y.' * (i % 3)}x.org{path}{end}") for i, (path, end) in enumerate(
        (path, end) for path in paths for end in ("", "b", "/", "/b", "é"))]
    found = urls.verdicts(spark.createDataFrame(pages, "page_id long, url string"),
                          spark.createDataFrame(rules, "host string, path string, verdict string"),
                          sweep_rows=50).collect()
    verdict = {path: v for _, path, v in rules}
    for row in found:
        longest = max((p for p in paths if row.path.startswith(p)), key=len)
        assert (row.rule, row.verdict) == ("x.org" + longest, verdict[longest])
    assert len(found) == len(pages)


def test_tool_calls_are_linked_ordered_and_checked(spark):
    schemas = {"f": {"required": ["a"], "properties": {
        "a": {"type": "integer", "minimum": 0}, "b": {"type": "string", "enum": ["x"]}}}}
    calls = [
        (1, "c1", 0, "f", '{"b":"x", "a": 1}', None), (1, "c2", 1, "f", '{"a": -1}', ["c1", "c1"]),
        (1, "c3", 2, "f", "{", ["c2", "c1", "gone"]), (1, "c4", 3, "g", "{}", ["c5"]),
        (1, "c5", 4, "f", None, ["c4"]), (1, "c6", 5, "f", '{"a":true,"z":"é\\n"}', ["c5"]),
        (2, "c1", 0, "f", '{"a":2,"b":"y"}', ["c1"]), (None, "c1", 0, "f", "{}", None),
        (1, None, 0, "f", "{}", None), (1, "c1", 0, "f", '{"b":"x", "a": 1}', None)]
    results = [("c1", "z"), ("c1", "r"), (None, "lost"), ("c9", "for nobody"), ("c3", None)]
    calls = spark.createDataFrame(calls, "conv_id long, call_id string, seq long, tool string,"
                                         " arguments string, depends_on array<string>")
    results = spark.createDataFrame(results, "call_id string, result string")
    found = {(r.conv_id, r.call_id): r for r in tool_calls.linked(calls, results, schemas).collect()}
    assert len(found) == 7
    level = {key: row.level for key, row in found.items()}
    assert [level[1, f"c{i}"] for i in range(1, 7)] == [0, 1, 2, None, None, None]
    assert level[2, "c1"] is None  # needs itself
    record = {key: json.loads(row.json) for key, row in found.items()}
    errors = {key: value["errors"] for key, value in record.items()}
    assert errors[1, "c1"] == [] and errors[1, "c2"] == ["a: below minimum"]
    assert errors[1, "c3"] == errors[1, "c5"] == ["arguments: no object"]
    assert errors[1, "c4"] == ["unknown tool"]
    assert errors[1, "c6"] == ["a: not integer", "z: unexpected"]
    assert errors[2, "c1"] == ["b: not allowed"]
    assert record[1, "c1"]["result"] == "r" and record[1, "c3"]["result"] is None
    assert record[1, "c3"]["depends_on"] == ["c1", "c2"]
    assert found[1, "c1"].json.startswith('{"arguments":{"a":1,"b":"x"},"call_id":"c1"')
    assert found[1, "c6"].json.count("é\\n") == 1
    assert tool_calls.linked(calls.where("seq > 9"), results, schemas).count() == 0


AWKWARD = {
    "q": '{"a":1}', "lone": '{"b":"\\ud800x"}', "deep": "{\"c\":" + "[" * 200_000 + "]" * 200_000 + "}",
    "nan": '{"d":NaN}', "inf": '{"d":1e999}', "minus": '{"d":-Infinity}', "twice": '{"a":1,"a":2}',
    "whole": '{"a":1.0}', "part": '{"a":1.5}', "any": '{"e":[1,"x",null]}', "list": "[1]",
    "nested": '{"f":{"g":"no","h":[1,-2,"x"]}}', "good": '{"f":{"g":"yes","h":[]}}',
    "huge": '{"a":' + "9" * 5000 + "}", "digits": '{"d":12345678901234567890.5}'}


def test_awkward_arguments_end_no_task(spark):
    schema = {"properties": {
        "a": {"type": "integer"}, "b": {"type": "string"}, "c": {"type": "array"},
        "d": {"type": "number"}, "e": {}, "f": {"type": "object", "required": ["g"], "properties": {
            "g": {"type": "string", "pattern": "^y", "minLength": 3},
            "h": {"type": "array", "maxItems": 2, "items": {"type": "integer", "minimum": 0}}}}}}
    calls = spark.createDataFrame(
        [(1, name, i, "f", text, None) for i, (name, text) in enumerate(AWKWARD.items())],
        "conv_id long, call_id string, seq long, tool string, arguments string,"
        " depends_on array<string>")
    results = spark.createDataFrame([], "call_id string, result string")
    rows = tool_calls.linked(calls, results, {"f": schema}).collect()
    record = {r.call_id: json.loads(r.json, parse_constant=pytest.fail) for r in rows}
    errors = {name: value["errors"] for name, value in record.items()}
    bad = ["arguments: no object"]
    assert errors == {
        "q": [], "lone": [], "deep": ["arguments: too deep"], "nan": bad, "inf": bad, "minus": bad,
        "twice": ["arguments: repeated key"], "whole": [], "part": ["a: not integer"], "any": [],
        "list": bad, "nested": ["f.g: no match", "f.g: wrong length", "f.h: wrong length",
                                "f.h[1]: below minimum", "f.h[2]: not integer"],
        "good": [], "huge": bad, "digits": []}
    assert record["lone"]["arguments"]["b"] == "\ud800x"
    assert [r.json for r in rows if r.call_id == "whole"][0].startswith('{"arguments":{"a":1},')


@pytest.mark.parametrize("part", [100_000, 700, 3])
def test_levels_need_rounds_for_borders_only(spark, part, monkeypatch):
    """Long chains, forward needs, cycles and calls behind them, in parts of several sizes."""
    long = 5_000 if part > 100 else 30
    needs = {(1, f"c{i:05d}"): [f"c{i - 1:05d}"] if i else [] for i in range(long)}
    needs |= {(2, f"f{i}"): [f"f{i + 1}", "f39"] if i < 39 else [] for i in range(40)}  # forward
    needs |= {(3, f"z{i}"): [f"z{(i + 1) % 5}"] for i in range(5)}  # a cycle
    needs |= {(3, "behind"): ["z0", "free"], (3, "free"): [], (3, "after"): ["free"]}
    wanted = {(1, f"c{i:05d}"): i for i in range(long)} | {(2, f"f{i}"): 39 - i for i in range(40)}
    wanted |= {(3, "free"): 0, (3, "after"): 1}
    calls = spark.createDataFrame([(c, name, i) for i, (c, name) in enumerate(needs)],
                                  "conv_id long, call_id string, seq long")
    pairs = spark.createDataFrame([(c, name, n) for (c, name), of in needs.items() for n in of],
                                  "conv_id long, call_id string, needed string")
    rounds = []
    real = tool_calls.with_positions
    monkeypatch.setattr(
        tool_calls, "with_positions", lambda *a, **k: rounds.append(1) or real(*a, **k))
    found = tool_calls.levels(calls, pairs, part).collect()
    assert {(r.conv_id, r.call_id): r.level for r in found} == wanted
    assert len(rounds) <= {100_000: 2, 700: 10, 3: 60}[part]

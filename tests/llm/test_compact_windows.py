"""Compact windows: windows by definition, repeats against comparing all pairs."""

import random

import numpy as np
import pytest

from cohortspark.llm import compact_windows as C
from cohortspark.llm.decontaminate import words_of


def tree_nodes(v: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Nodes by definition: take the smallest token, go on to its left and right."""
    out, todo = [], [(0, len(v))]
    while todo:
        a, b = todo.pop()
        if b - a < least:
            continue
        c = a + int(v[a:b].argmin())
        at = a + np.flatnonzero(v[a:b] == v[c])
        out += [(a, int(c), b) for c in at]
        edges = np.concatenate(([a - 1], at, [b]))
        wide = np.flatnonzero(np.diff(edges) > least)
        todo += [(int(edges[k]) + 1, int(edges[k + 1])) for k in wide]
    return out


def test_windows_cover_each_run_once():
    rng = np.random.default_rng(0)
    for n, top in ((40, 10**6), (60, 5), (7, 3), (0, 2)):
        v = rng.integers(0, top, n).astype(np.uint64)
        found = tree_nodes(v, 4)
        for a in range(n):
            for b in range(a + 4, n + 1):
                low = v[a:b].min()
                holds = {(s, e) for s, c, e in found if s <= a and b <= e and a <= c < b and v[c] == low}
                assert len(holds) == 1


def test_windows_are_the_tree_nodes():
    rng = np.random.default_rng(5)
    for n in (4, 5, 8, 13, 100, 1003):
        for top, least in ((2**63, 1), (2**63, 4), (4, 1), (4, 2), (30, 4), (2, 3)):
            v = rng.integers(1, top, (3, n)).astype(np.uint64)
            got = sorted(zip(*(x.tolist() for x in C.windows(v, least))))
            assert got == sorted((k, *w) for k in range(3) for w in tree_nodes(v[k], least))


def test_wide_spans_reach_to_the_end():
    spans = C.spans_of(np.array([3, 5]), np.array([10, 5 + 2**21]))
    assert C.covered(spans.tolist(), 1).tolist() == [[3, np.iinfo(np.int64).max]] and C.covered(spans.tolist(), 2).tolist() == [[5, 10]]


def vocabulary(rng, n, tag):
    return [f"{tag}{rng.randrange(5000)}" for _ in range(n)]


def texts(rng):
    docs, clean, caught = [], [], []

    def add(words, group):
        group.append(len(docs))
        docs.append((len(docs), " ".join(words)))

    shared = [vocabulary(rng, 60, "s") for _ in range(4)]
    line = vocabulary(rng, 12, "b")
    for i in range(40):
        add(vocabulary(rng, rng.choice([3, 30, 120, 400]), "c") + line + vocabulary(rng, 40, "c"), clean)
    for k, p in enumerate(shared):
        for i in range(3 + 10 * (k == 0)):
            add(vocabulary(rng, rng.choice([0, 5, 80, 300]), "d") + p + vocabulary(rng, rng.choice([0, 7, 90]), "e"), caught)
    base = vocabulary(rng, 300, "n")
    for i in range(6):
        near = list(base)
        for _ in range(i):
            near[rng.randrange(300)] = "other"
        add(near, caught)
    add(base[:49], clean)
    again = vocabulary(rng, 55, "w")
    add(again + vocabulary(rng, 30, "x") + again, clean)
    return docs, clean, caught


def repeats(docs, least):
    """Words of each text that lie in a run of ``least`` words that another text has too."""
    split = {i: words_of(t.encode()) for i, t in docs}
    seen = {}
    for i, w in split.items():
        for k in range(len(w) - least + 1):
            seen.setdefault(tuple(w[k:k + least]), set()).add((i, k))
    out = {}
    for at in seen.values():
        if len({i for i, _ in at}) > 1:
            for i, k in at:
                out.setdefault(i, set()).update(range(k, k + least))
    return out


@pytest.mark.parametrize("part", [200, 400_000])
def test_all_repeats_are_found_and_nothing_else(spark, monkeypatch, part):
    monkeypatch.setattr(C, "PART_ROWS", part)
    docs, clean, caught = texts(random.Random(8))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, spans string, key int").repartition(4)
    found, links = C.repeated(df)
    got = {r.doc: r for r in found.collect()}
    assert not set(got) & set(clean) and set(got) == set(caught)
    for i, words in repeats(docs, 50).items():
        covered = {k for s in got[i].spans for k in range(s.start, s.stop)}
        assert words <= covered, i
    assert all(r.similarity >= .8 for r in links.collect())
    by_class = {}
    for i, r in got.items():
        by_class.setdefault(r["class"], set()).add(i)
    assert all(min(m) == c and len(m) > 1 for c, m in by_class.items())
    assert sorted(map(len, by_class.values())) == [3, 3, 3, 6, 13]


def test_copies_nulls_and_empty(spark):
    rng = random.Random(1)
    own, short = " ".join(vocabulary(rng, 70, "a")), " ".join(vocabulary(rng, 49, "b"))
    rows = [(1, own), (5, own), (None, own), (1, own), (2, short), (3, short), (4, None), (6, ""), (7, None), (8, "?" * 500), (9, "?" * 500),
            (10, "again " * 200), (11, "again " * 200 + "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found, _ = C.repeated(df)
    got = sorted(((r.doc, r["class"], r.n_links, [tuple(s) for s in r.spans]) for r in found.collect()), key=repr)
    assert got[:2] == [(1, 1, 2, [(0, 70)]), (10, 10, 1, [(0, 200)])]
    assert {r[0] for r in got} == {1, 5, None, 10, 11}
    assert C.repeated(df.limit(0))[0].count() == 0


def test_passages():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 2**60, 200).astype(np.uint64), rng.integers(0, 2**60, 150).astype(np.uint64)
    b[20:90] = a[100:170]
    assert C.passages(a, b, 46, .8) == [(100, 170, 20, 90, 1.0)]
    b[50:55] = 1
    (s, e, x, y, j), = C.passages(a, b, 46, .8)
    assert (s, e, x, y) == (100, 170, 20, 90) and j == pytest.approx(65 / 71, abs=.01)
    assert C.passages(a, b[:40], 46, .8) == []


def test_passages_that_lie_apart_in_the_other_text():
    rng = np.random.default_rng(6)
    new = lambda n: rng.integers(0, 2**60, n).astype(np.uint64)
    parts = [new(56), new(56)]
    changed = [p.copy() for p in parts]
    for p in changed:
        p[26:31] = new(5)  # the middle word
    # in a side by side, four shingles span the border
    a, b = np.concatenate((new(30), parts[0], new(4), parts[1], new(30))), np.concatenate((new(9), changed[0], new(24), changed[1], new(9)))
    assert [r[:4] for r in C.passages(a, b, 46, .8)] == [(30, 86, 9, 65), (90, 146, 89, 145)]
    # an exact copy beside other shared text that lies elsewhere
    c = np.concatenate((parts[1], new(40), parts[0]))
    assert [r[:4] for r in C.passages(a, c, 46, .8)] == [(30, 86, 96, 152), (90, 146, 0, 56)]


def test_passages_hold_all_planted_near_copies():
    rng = np.random.default_rng(7)
    for _ in range(40):
        parts = [rng.integers(0, 2**60, rng.integers(56, 90)).astype(np.uint64) for _ in range(4)]
        a, b, want = [], [], []
        for k in rng.permutation(4):
            a += [parts[k], rng.integers(0, 2**60, rng.choice([0, 4, 20])).astype(np.uint64)]
        for k in rng.permutation(4):
            near = parts[k].copy()
            near[25:30] = 7
            b += [near, rng.integers(0, 2**60, rng.choice([0, 4, 20])).astype(np.uint64)]
        a, b = np.concatenate(a), np.concatenate(b)
        got = C.passages(a, b, 46, .8)
        for p in parts:
            s, x = int(np.flatnonzero(a == p[0])[0]), int(np.flatnonzero(b == p[0])[0])
            assert any(i <= s and s + len(p) <= e and j <= x and x + len(p) <= y for i, e, j, y, _ in got)
        assert all(r[4] >= .8 for r in got)


@pytest.mark.parametrize("common, others", [(45, 40), (48, 12)])
def test_repeats_around_a_frequent_line(spark, common, others):
    rng = random.Random(common)
    for _ in range(3):
        whole = vocabulary(rng, 52, "p")
        docs = [(i, " ".join(vocabulary(rng, 30, f"l{i}") + whole[2:2 + common] + vocabulary(rng, 30, f"r{i}"))) for i in range(others)]
        docs += [(others + i, " ".join(vocabulary(rng, 40, f"x{i}") + whole + vocabulary(rng, 40, f"y{i}"))) for i in range(2)]
        found, _ = C.repeated(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
        got = {r.doc: {k for s in r.spans for k in range(s.start, s.stop)} for r in found.collect()}
        assert set(got) == {others, others + 1}
        assert all(set(range(40, 92)) <= spans for spans in got.values())


def test_partly_shared_with_the_first_text(spark):
    """Whichever text comes first, it shares 50 words with each other one, and those share 60 with each other."""
    rng = random.Random(9)
    for n in range(3):
        middle, left, right = vocabulary(rng, 30, "m"), vocabulary(rng, 30, "l"), vocabulary(rng, 30, "r")
        docs = [left + middle + vocabulary(rng, 60, "a"), vocabulary(rng, 60, "b") + middle + right, left + middle + right]
        df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
        found, _ = C.repeated(df)
        got = {r.doc: {k for s in r.spans for k in range(s.start, s.stop)} for r in found.collect()}
        assert all(words <= got[i] for i, words in repeats([(i, " ".join(w)) for i, w in enumerate(docs)], 50).items())


def test_every_place_of_a_key_counts():
    """A line that stands alone and again in a passage has its keys at both places."""
    rng = random.Random(12)
    line, inner = vocabulary(rng, 60, "l"), vocabulary(rng, 60, "i")
    alone = dict.fromkeys(C.window_keys(" ".join(line).encode(), 50, 6)[0].tolist())
    keys, places = C.window_keys(" ".join(line + inner + line).encode(), 50, 6)
    both = {k: places[keys == k].tolist() for k in alone if k in keys}
    assert both and all(len(p) >= 2 and p[-1] - p[0] == 120 for p in both.values())
    assert len(C.window_keys(b"again " * 5000, 50, 6)[0]) < 100


def test_links_are_the_documents_with_the_same_passages(spark):
    rng = random.Random(21)
    shared = [vocabulary(rng, 60, f"s{k}x") for k in range(4)]
    docs = []
    for i in range(60):
        held = rng.sample(range(4), rng.choice([0, 1, 1, 1, 2, 3]))
        docs.append((i, " ".join(sum((shared[k] + vocabulary(rng, 40, f"d{i}x") for k in held), vocabulary(rng, 40, f"e{i}x")))))
    docs += [(60 + i, docs[i][1]) for i in range(5)]  # copies, all long enough or alone
    want, grams = {}, {}
    for i, t in docs:
        w = words_of(t.encode())
        for k in range(len(w) - 49):
            grams.setdefault(tuple(w[k:k + 50]), set()).add(i)
    for at in grams.values():
        for i in at:
            want.setdefault(i, set()).update(at - {i})
    found, _ = C.repeated(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert {r.doc: r.n_links for r in found.collect()} == {i: len(o) for i, o in want.items() if o}


def test_spans_that_have_a_passage_in_common():
    assert C.shared_parts([(0, 60), (5, 70), (100, 160)], 50) == [(0, 60, 10), (5, 70, 10), (100, 160, 110)]
    got = C.shared_parts([(0, 60), (40, 100), (0, 100)], 50)
    assert sorted(p for _, _, p in got) == [10, 10, 50, 50]


def test_rounds_in_a_task_are_the_rounds_by_joins(spark, monkeypatch):
    """Groups that fit go through all their rounds at once; each text shares one word more with the first than the one before."""
    rng = random.Random(31)
    whole = vocabulary(rng, 120, "p")
    docs = [(i, " ".join(vocabulary(rng, 30, f"l{i}x") + whole[60 - k:66 + k] + vocabulary(rng, 30, f"r{i}x"))) for i, k in enumerate([*range(2, 22), 30, 30, 40])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    calls, verify = [], C.verify
    monkeypatch.setattr(C, "verify", lambda *a, **k: calls.append(1) or verify(*a, **k))
    rows = lambda: sorted((r.doc, r["class"], r.n_links, [tuple(s) for s in r.spans]) for r in C.repeated(df)[0].collect())
    at_once = rows()
    assert len(calls) <= 2 and {r[0] for r in at_once} == {i for i in repeats(docs, 50)}
    monkeypatch.setattr(C, "GROUP_ROWS", 1, raising=False)
    assert rows() == at_once and len(calls) > 4


def test_many_shared_classes_make_no_pairs(spark, monkeypatch):
    """Texts that share many classes: no table has a row for each pair of them."""
    rng = random.Random(32)
    shared = [vocabulary(rng, 60, f"s{k}x") for k in range(30)]
    held = [sorted(rng.sample(range(30), 20)) for _ in range(12)]
    docs = [(i, " ".join(sum((shared[k] + vocabulary(rng, 8, f"d{i}x{k}y") for k in own), []))) for i, own in enumerate(held)]
    sizes, store = {}, C.store

    def counted(df, label):
        out = store(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(C, "store", counted)
    found, _ = C.repeated(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert {r.doc: r.n_links for r in found.collect()} == {i: sum(bool(set(own) & set(o)) for o in held) - 1 for i, own in enumerate(held)}
    assert all(n <= 2 * sizes["held"] for label, n in sizes.items() if label in ("kinds", "kind", "numbered", "classes", "two"))


def test_stretches_that_repeat_give_few_rows():
    """Of places one period apart, those inside are left out; all runs that two texts share there are still met from the others."""
    rng = random.Random(41)
    for period in (2, 3, 7):
        line = vocabulary(rng, period, "q")
        text = " ".join(vocabulary(rng, 60, "a") + 300 * line + vocabulary(rng, 60, "b"))
        keys, _ = C.window_keys(text.encode(), 50, 6)
        assert len(keys) < 600


def test_runs_inside_stretches_that_repeat(spark):
    rng = random.Random(42)
    line = vocabulary(rng, 3, "q")
    long, short = (200 * line)[1:], (20 * line)[2:]
    docs = [vocabulary(rng, 40, "a") + long + vocabulary(rng, 40, "b"), vocabulary(rng, 40, "c") + short + vocabulary(rng, 40, "d"),
            vocabulary(rng, 40, "e") + short[1:54] + vocabulary(rng, 40, "f")]
    tail = vocabulary(rng, 30, "t")
    docs += [vocabulary(rng, 40, f"g{k}x") + 4 * k * line + tail + vocabulary(rng, 40, f"h{k}x") for k in (2, 5, 30)]
    docs = [(i, " ".join(w)) for i, w in enumerate(docs)]
    found, _ = C.repeated(spark.createDataFrame(docs, "doc_id long, text string").repartition(2))
    got = {r.doc: {k for s in r.spans for k in range(s.start, s.stop)} for r in found.collect()}
    want = repeats(docs, 50)
    assert set(want) <= set(got)


def test_hot_keys_give_the_same_rows(spark, monkeypatch):
    """Keys whose rows are spread by their texts."""
    docs, _, _ = texts(random.Random(43))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = lambda: sorted((r.doc, r["class"], r.n_links, [tuple(s) for s in r.spans]) for r in C.repeated(df)[0].collect())
    by_key = rows()
    monkeypatch.setattr(C, "HOT_ROWS", 1)
    assert rows() == by_key


def test_ranges_that_meet_share_a_node():
    for size in (1, 2, 8):
        ranges = [(a, b) for a in range(size) for b in range(a + 1, size + 1)]
        trees = {r: C.tree_of(*r, size) for r in ranges}
        for (a, b), (up, held) in trees.items():
            for (c, d), (above, inside) in trees.items():
                meet = bool(set(up) & set(inside) or set(above) & set(held))
                assert meet == (a < d and c < b)

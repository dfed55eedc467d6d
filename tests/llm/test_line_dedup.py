"""Line dedup against a plain count of lines."""

import random
from collections import Counter

import pytest

from cohortspark.llm import line_dedup as L

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line).strip(BLANK)


def brute(docs, keep, least):
    docs = [(i, t or "") for i, t in docs]
    held = Counter(k for i, t in set(docs) for k in {key(x) for x in t.split("\n")} if k)
    first = {}
    for i, t, in sorted(set(docs), key=lambda d: d[0]):
        for p, x in enumerate(t.split("\n")):
            first.setdefault(key(x), (i, t, p))
    out = []
    for i, t in docs:
        stay = [x for p, x in enumerate(t.split("\n"))
                if not key(x) or held[key(x)] < least or keep == "first" and first[key(x)] == (i, t, p)]
        out.append((i, len(t.split("\n")), len(t.split("\n")) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def run(spark, docs, **how):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id long, text string, word string, words string")
    out = L.apply_bitmaps(df, L.line_bitmaps(df, **how))
    assert out.columns[:4] == df.columns
    return sorted(((r.doc_id, r["__n_lines"], r["__n_dropped"], "\n".join(r["__lines"])) for r in out.collect()), key=repr)


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("hot", [5, 100_000])
def test_same_as_counting(spark, keep, hot):
    rng = random.Random(3)
    pool = ["Home", " home\t", "É", "é", "a\x0bb", "", "  ", "login \r"] + [f"line {i}" for i in range(30)]
    docs = [(i, "\n".join(rng.choice(pool) if rng.random() < .6 else f"own {rng.random()}" for _ in range(rng.choice([1, 3, 70, 200]))))
            for i in range(40)]
    docs += [(100, None), (101, ""), (102, "\n\n"), (103, "home\n" * 300), (103, "home\n" * 300)]
    assert run(spark, docs, keep=keep, min_documents=3, hot_rows=hot) == brute(docs, keep, 3)


def test_empty_table_null_id_and_bad_mode(spark):
    assert run(spark, [], min_documents=2) == []
    assert run(spark, [(None, "a"), (1, "a\nb")], min_documents=2) == [(1, 2, 1, "b"), (None, 1, 1, "")]
    with pytest.raises(ValueError):
        run(spark, [], keep="last")


def test_bitmaps_hold_no_text(spark):
    df = spark.createDataFrame([(i, "a\nb" + str(i)) for i in range(3)], "doc_id long, text string")
    got = L.line_bitmaps(df, min_documents=3)
    assert got.columns == ["doc", "sig", "n_dropped", "words"]
    assert {tuple(r.words[0]) for r in got.collect()} == {(0, -2)}

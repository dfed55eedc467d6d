"""License scans against a plain version without gates."""

import random
import re


from cohortspark.llm import licenses as L
from cohortspark.llm.license_rules import RULES


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, rules=RULES):
    w = words(text)
    places = [(i, label) for phrase, label in L.BASE for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    flat = f" {' '.join(w)} "
    found = [(m.start(), m.end(), level, n) for n, (_, level, _, p) in enumerate(rules) for m in re.finditer(L.pattern(p), flat)]
    stay = [x for x in found if not any(
        y != x and y[2] <= x[2] and y[0] <= x[0] and y[1] >= x[1] and ((y[0], y[1]) != (x[0], x[1]) or y[2:] < x[2:]) for y in found)]
    base = {label for _, label in places}
    score = max([L.WEIGHTS[x[2]] for x in stay] + [L.BASE_WEIGHT] * bool(places), default=0.0)
    return (len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
            ",".join(sorted(base)), ",".join(sorted(base | {rules[x[3]][2] for x in stay})), score)


def sample(p, rng):
    """Some text that the pattern fits."""
    for _ in range(60):
        p2 = re.sub(r"\(([^()]*)\)\?", lambda m: m[1].split("|")[0] if rng.random() < .5 else "", p)
        p2 = re.sub(r"\(([^()]*)\)(\{1,8\})?", lambda m: rng.choice(m[1].split("|")), p2)
        p = p2
    p = p.replace("[^ ]+", "thing").replace("{1,8}", "")
    p = re.sub(r"\[([^\]]+)\]", lambda m: rng.choice(m[1]), p)
    return re.sub(r"(.)\?", lambda m: m[1] if rng.random() < .5 else "", p)


def texts():
    rng = random.Random(11)
    filler = ["the", "of", "é", "License", "mit", "public", "general", "Ünï", "apache", "2", "gpl", "and"]
    out = [None, "", "...", "MIT License", "mit license mit license", "the MIT-License, Apache\nLicense Version 2.0", "permit license", "mit licensee",
           "Éapache license", "GNU Lesser General Public License v3 or later", "general public license " * 300, "x " * 5000 + "MIT license",
           "Licensed under the Apache License, Version 2.0 (the \"License\")", "SPDX-License-Identifier: GPL-2.0-only", "cc0 agpl3 eupl"]
    for _ in range(150):
        parts = [sample(rng.choice(RULES)[3], rng) if rng.random() < .4 else " ".join(rng.choice(filler) for _ in range(rng.choice([1, 3, 8]))) for _ in range(4)]
        out.append(rng.choice([" ", "\n", ", "]).join(parts).upper() if rng.random() < .3 else "; ".join(parts))
    return out + [sample(r[3], rng) for r in RULES]


def test_there_are_hundreds_of_rules_and_gates_hold_back_no_match():
    rng = random.Random(2)
    assert len(RULES) > 200 and len({r[3] for r in RULES}) == len(RULES) and {r[1] for r in RULES} == set(L.WEIGHTS)
    for keyword, _, _, p in RULES:
        for _ in range(20):
            text = sample(p, rng)
            m = re.search(L.pattern(p), f" {' '.join(text.split())} ")
            assert not m or set(keyword.split(",")) & set(m[0].split()), (keyword, p, text)


def test_same_as_plain_version(spark):
    docs = [(i, t) for i, t in enumerate(texts())] + [(3, "MIT License"), (None, "BSD license"), (None, None)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, labels string, level int").repartition(4)
    got = sorted(((r.doc, r.n_words, r.n_base, r.first_word, r.last_word, ",".join(r.base_labels), ",".join(r.labels), r.score) for r in L.licenses(df).collect()), key=repr)
    want = sorted(((i, *brute(t)) for i, t in docs), key=repr)
    assert got == want
    assert L.licenses(df.limit(0)).count() == 0


def test_containment_and_priority(spark):
    df = spark.createDataFrame([(1, "GNU Lesser General Public License")], "doc_id long, text string")
    rows = L.detections(L.scan(df)).collect()
    stay = [r for r in rows if r.stays]
    assert len(rows) > 2 and [r.label for r in stay] == ["lgpl"]
    # the base label stays even where the method suppresses its interval
    assert L.licenses(df).first().labels == ["gpl", "lgpl"]



def test_native_plan(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    plan = L.licenses(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

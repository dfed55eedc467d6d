"""Cross-tokenizer alignment against a plain version."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cohortspark.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(docs):
    import sentencepiece

    from cohortspark.llm.tokens import _BYTE

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    rows, counts = [], Counter()
    for doc, text in docs:
        a = t.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        ta = [bytes(_BYTE[c] for c in t.id_to_token(i)) for i in a]
        tb = [bytes([int(sp.id_to_piece(i)[1:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(ta) == b"".join(tb) == (" " + text).encode():
            rows.append((doc, [], [], [], []))
            continue
        ea, eb = np.cumsum([len(x) for x in ta]).tolist(), np.cumsum([len(x) for x in tb]).tolist()
        links, i, j = [], 0, 0
        groups, ga, gb = [], [], []
        while i < len(a):
            links.append((a[i], b[j]))
            x, y = ea[i], eb[j]
            if x <= y:
                ga.append(a[i])
                i += 1
            if y <= x:
                gb.append(b[j])
                j += 1
            if x == y:
                groups.append((ga, gb))
                ga, gb = [], []
        counts.update(links)
        rows.append((doc, a, b, groups, links))
    best = Counter()
    for (x, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for doc, a, b, groups, links in rows:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc, len(a), len(b), len(groups), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links),
                    hashlib.sha256(said.encode()).hexdigest() if a else ""))
    return out, counts


TEXTS = ["The quick brown fox, 12345 jumps!\n\n  over\tthe lazy dog. ", "", None, " ", "x", "▁hidden", "naïve café 你好世界 \U0001f600\U0001f600 end",
         "<|endoftext|> and <s> </s> <unk> <0x41> are plain", "a" * 3000, "一二三" * 500, "tab\x00nul\x7f 　 wide", "The quick brown fox"]


def check(spark, docs, shard_links):
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("shard", __import__("pyspark").sql.functions.lit("x"))
    got, counts = alignment.align(df, A, B, shard_links=shard_links)
    names = ["doc", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    want, pairs = brute(docs)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(want, key=repr)
    assert {(r.a, r.b): r.n for r in counts.collect()} == dict(pairs)


def test_equals_plain_version(spark):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, "repeated id"), (3, "repeated id")]
    check(spark, docs, alignment.SHARD_LINKS)
    check(spark, docs, 40)  # many shards


def test_empty_table(spark):
    check(spark, [], 100)
    check(spark, [(1, None), (2, "")], 100)


def test_long_chains_without_shared_ends(spark):
    rng = np.random.default_rng(5)
    letters = ["ก", "า", "ไ", "你", "é", "é", "\U0001f9d1", " ", "x"]
    check(spark, [(i, "".join(rng.choice(letters, 2000))) for i in range(20)], 5000)


def test_groups_are_listed(spark):
    df = spark.createDataFrame([(1, "naive fox 你"), (2, None)], "doc_id long, text string")
    rows = alignment.token_groups(df, A, B).collect()
    want, _ = brute([(1, "naive fox 你")])
    assert len(rows) == 1 and len(rows[0].groups) == want[0][3]
    assert rows[0].groups[-1].stop == len(" naive fox 你".encode())
    said = ";".join(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in rows[0].groups)
    assert hashlib.sha256(said.encode()).hexdigest() == want[0][7]


def test_steps_round_trip():
    v = np.array([0, 1, 127, 128, 16383, 16384, 2**31, 2**40, 5])
    assert alignment.from_steps(alignment.to_steps(v)).tolist() == v.tolist()
    assert alignment.from_steps(b"").tolist() == []

"""Packing: ids as the tokenizer gives them, whole and gapless sequences, few of them."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortspark.llm import packing as P
from cohortspark.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a\nb c", "it's we'll 'tis", "x  y", "x y z", "tab\t x\ty", "é è 12 3.5 -- !!",
         "<|endoftext|> a b<|endoftext|>", "a <| b", "日本 語 text", "é ​ x", "\x1f a \x85 b", "trail \n", "🙂 🙂🙂 ok", "x\x0b y", "a\r\n b"]


TOKENIZER = Tokenizer.from_file(PATH)


def slow(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizer():
    rng = random.Random(4)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice([*"abZé1.'  \n\t", "'s", " the", "　", "ß"]) for _ in range(rng.choice([3, 30, 300]))) for _ in range(200)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(1, 0x3000), rng.randrange(0xE000, 0x11000)])) for _ in range(50)) for _ in range(300)]
    counts, plain = tokens.ByteBpe(PATH, special=True), tokens.ByteBpe(PATH, special=False)
    assert counts.quick and plain.quick
    assert [counts.ids(t) for t in texts] == [slow(t) for t in texts]
    strict = Tokenizer.from_file(PATH)
    strict.encode_special_tokens = True
    assert [plain.ids(t) for t in texts] == [strict.encode(t, add_special_tokens=False).ids for t in texts]
    assert all(counts.vocabulary.text(np.array(counts.ids(t), np.int64)).tobytes() == t.encode() for t in texts)


def test_other_vocabularies_use_their_own_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    bpe = tokens.ByteBpe(path, special=True)
    assert bpe.quick is None
    assert bpe.ids("Some Text") == Tokenizer.from_file(path).encode("Some Text", add_special_tokens=False).ids


def first_fit(lengths, capacity):
    """Best fit, longest first, one by one."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
        rooms.append((min(fit) if fit else capacity) - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit(seed):
    rng = random.Random(seed)
    capacity = 50
    lengths = [rng.choice([rng.randrange(1, 51), rng.randrange(1, 9), 50]) for _ in range(rng.choice([1, 40, 400]))]
    counts = Counter(lengths)
    runs, used = P.best_fit(counts, capacity)
    room = defaultdict(list)
    for k, (length, rank, per, first, offset) in enumerate(runs):
        stop = min([r for n, r, *_ in runs if n == length and r > rank], default=counts[length])
        for j in range(stop - rank):
            room[first + j // per].append((offset + j % per * length, length))
    assert sorted(room) == list(range(used)) and sum(map(len, room.values())) == len(lengths)
    for parts in room.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    assert used == first_fit(lengths, capacity)


def test_pack(spark):
    rng = random.Random(9)
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(200, "same same"), (200, "same same"), (None, None), (None, "no id")]
    docs += [(300 + i, " ".join(rng.choice(["one", "two", "Ünï", "x1."]) for _ in range(rng.choice([5, 60, 400])))) for i in range(30)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, length int, chunk int").repartition(3)
    capacity = 64
    parts = P.store(P.pieces(df, PATH, 0, capacity, with_ids=True), "pieces")
    placed = P.place(parts, capacity, chunk_rows=7)
    rows = placed.collect()
    want = Counter()
    for i, t in docs:
        ids = [*slow(t), 0]
        head = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(head, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc, r.piece, r.start, r.length, r.crc) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length, r.ids))
    for parts in by.values():
        at = 0
        for offset, n, _ in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(by) == first_fit([r.length for r in rows], capacity)
    for r in P.sequences(placed).collect():
        assert r.ids == [t for _, _, ids in sorted(by[r.sequence_id]) for t in ids]
    assert P.pack(df.limit(0), PATH).count() == 0

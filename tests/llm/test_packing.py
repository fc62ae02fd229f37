import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tables
from tables import SF_SMALL
from tokenizers import Tokenizer

from cartographer.llm import packing, queries


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.vocabulary())


def check(tokenizer, docs, got, window=packing.WINDOW):
    ids = [(i, np.array([*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID], "<u4")) for i, t in docs]
    want = Counter((i, s, len(x[s:s + window]), zlib.crc32(x[s:s + window].tobytes()), len(x)) for i, x in ids for s in range(0, len(x), window))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    assert set(held) == set(range(len(held)))
    assert len(held) == brute_windows(Counter(r.length for r in got), window)


def brute_windows(histogram, window):
    """Windows that best-fit decreasing opens, piece by piece."""
    rooms = []
    for length in sorted(histogram.elements(), reverse=True):
        fit = min((r for r in rooms if r >= length), default=None)
        if fit is None:
            rooms.append(window - length)
        else:
            rooms[rooms.index(fit)] -= length
    return len(rooms)


def test_query(spark, tokenizer):
    check(tokenizer, tables.small_documents(spark, SF_SMALL), queries.op6_packing(spark, SF_SMALL).collect())


@pytest.mark.parametrize("window", [64, 4096])
def test_awkward_rows(spark, tokenizer, window):
    rows = tables.awkward_rows()
    check(tokenizer, tables.clean(rows), packing.pack(tables.frame(spark, rows), queries.vocabulary(), window).collect(), window)


def test_empty_table(spark):
    assert packing.pack(tables.empty(spark), queries.vocabulary()).count() == 0


def test_plan_equals_piece_by_piece():
    rng = random.Random(5)
    for _ in range(300):
        window = rng.choice([7, 16, 30])
        histogram = Counter(rng.randint(1, window) for _ in range(rng.randint(0, 60)))
        plan = sorted(packing.plan_windows(histogram, window))
        room, seen = defaultdict(list), Counter()
        for k, (length, rank, first, each, offset) in enumerate(plan):
            end = plan[k + 1][1] if k + 1 < len(plan) and plan[k + 1][0] == length else histogram[length]
            for r in range(rank, end):
                more, nth = divmod(r - rank, each)
                room[first + more].append((offset + nth * length, length))
                seen[length] += 1
        assert seen == histogram
        for pieces in room.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= window
        assert len(room) == brute_windows(histogram, window)


def test_segment_tree():
    rng = random.Random(2)
    for n in (1, 5, 64, 100):
        tree, held = packing.Capacities(n), set()
        for _ in range(400):
            at = rng.randint(0, n)
            held ^= {at}
            tree.set(at, at in held)
            least = rng.randint(0, n)
            assert tree.tightest(least) == min((x for x in held if x >= least), default=None)


def test_word_ids_equal_the_tokenizer(tokenizer):
    words = packing.WordIds(queries.vocabulary())
    rng = random.Random(1)
    parts = [chr(i) for i in range(1, 256)] + list("ΣσςİıßÄẞǅ가각한글漢字́̈ 　​🙂👍🏽ﬁ①Ⅷ१٣’") + [
        "'s", "'LL", "'re", " ", "\n", "<|endoftext|>", "don't", "ΟΔΟΣ ", "Word.", "two,,", "\x1c", "\x85"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(words.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("text", ["x<|endoftext|>y", "<|startoftext|><|endoftext|>", "a <|endoftext|> b<|ENDOFTEXT|>c", "<|endoftext|", "İ<|startoftext|>ΣΑΣ",
                                  "'s<|endoftext|>'s", "<|endoftext|><|endoftext|>\n"])
def test_added_tokens_are_those_of_the_tokenizer(tokenizer, text):
    ids = np.frombuffer(packing.word_ids(queries.vocabulary()).encode(text), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids

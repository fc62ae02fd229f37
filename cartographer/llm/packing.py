"""Packing documents into windows of a fixed size by best-fit decreasing.

Documents are tokenised and end with an end token. A document longer than a
window is first cut into full windows; full windows and the remaining pieces
(every piece at most a window long) are then packed best-fit decreasing:
longest pieces first, each into the open window with the least room that
still holds it. A segment tree indexed by remaining capacity finds that
window.

Only lengths matter to the packer, so it runs on the histogram of lengths (at
most one entry for each length up to the window): all windows of equal room
are interchangeable and are handled as ranges, and pieces of equal length as
ranges of ranks. The result is the same as placing pieces one by one. The
plan's size depends on the window, not on the number of documents; each piece
then finds its window by (length, rank) on its own.

A null text is empty and packs its end token alone. Repeated rows are packed
as often as they occur; null ids are packed like others.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from bisect import bisect_right

import numpy as np
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_columns, texts

WINDOW = 4096
END_ID = 2
#: Buckets over which pieces of one length are ranked.
RANK_BUCKETS = 256
#: Words whose ids a worker remembers; beyond that it starts anew.
CACHE_WORDS = 1_000_000


class WordIds(dict):
    """Ids (little-endian 32-bit bytes) of words split at ASCII white space, by their UTF-8 bytes.

    Added tokens of the vocabulary file, such as ``<|endoftext|>``, are found first,
    as the tokenizer finds them; a text is split there.

    The vocabulary's normaliser (NFC, white space, lower case) and splitter
    never join characters across white space, so a text's ids are those of
    its words in a row. Unknown words are split here and encoded once.
    """

    #: The splitter's pattern, as in the vocabulary file (fixed value); its white space is Unicode's.
    PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        if any(t.normalized or t.single_word for t in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("added tokens are expected to match any place of the text as it is")
        self.added = {c.encode(): struct.pack("<I", i) for c, i in added.items()}
        self.splits = regex.compile(b"(" + b"|".join(regex.escape(c) for c in sorted(self.added, key=len, reverse=True)) + b")") if added else None
        self.model = self.tokenizer.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # the printable stand-in of each byte; bytes above 127 read off two-byte characters
        self.table = {b: level.pre_tokenize_str(chr(b))[0][0] for b in range(128)}
        for code in range(0x80, 0x800):
            two = chr(code).encode()
            self.table.update(zip(two, level.pre_tokenize_str(chr(code))[0][0], strict=True))
        for code in range(0x800, 0x110000, 0x1000):
            if not 0xD800 <= code < 0xE000:
                more = chr(code).encode()
                self.table.update(zip(more, level.pre_tokenize_str(chr(code))[0][0], strict=True))

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        core = word.rstrip(b".,")
        if not core.isalpha():  # other than ASCII letters with full stops or commas behind
            text = unicodedata.normalize("NFC", word.decode())
            lower = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)  # no final sigma
            pieces = [p.encode() for p in self.PATTERN.findall(lower)]
            ids = b"".join(self[p] if p != word and p.isalpha() and p.islower() else self._piece(p) for p in pieces)
        elif core == word and core.islower():
            ids = self._piece(word)
        else:
            ids = self[core.lower()] + (self[word[len(core):]] if core != word else b"")
        self[word] = ids
        return ids

    def _piece(self, piece: bytes) -> bytes:
        ids = [t.id for t in self.model.tokenize(piece.decode("latin-1").translate(self.table))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        line = text.encode()
        if self.splits is None or not self.splits.search(line):
            return b"".join(map(self.__getitem__, line.split()))
        return b"".join(self.added[part] if part in self.added else b"".join(map(self.__getitem__, part.split()))
                        for part in self.splits.split(line))


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's vocabulary, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def cut_pieces(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of every piece."""
    end = np.array([end_id], "<u4").tobytes()

    def run(ids: list, text: list) -> list:
        words = word_ids(vocabulary)
        out: list[list] = [[], [], [], [], []]
        for doc, t in zip(ids, text, strict=True):
            line = words.encode(t) + end
            n = len(line) // 4
            for start in range(0, n, window):
                piece = line[4 * start:4 * (start + window)]
                for column, x in zip(out, (doc, start, len(piece) // 4, zlib.crc32(piece), n), strict=True):
                    column.append(x)
        return out

    return map_columns(texts(docs), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                       "start long, length long, ids_crc32 long, doc_tokens long")


class Capacities:
    """Segment tree over capacities 0 .. n: which of them have open windows."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, at: int, is_open: bool) -> None:
        at += self.size
        self.open[at] = is_open
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        """Smallest capacity of ``least`` or more that has an open window."""
        at = least + self.size
        if self.open[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def plan_windows(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing on lengths. Rows: length, first rank, first window,
    pieces in each window, offset of the first; pieces of one length fill
    windows one after the other."""
    tree, ranges = Capacities(window), {}
    plan, used = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if not ranges.get(room):
                ranges[room] = []
                tree.set(room, True)
            last = ranges[room][-1] if ranges[room] else None
            if last and last[0] + last[1] == first:
                last[1] += n
            elif last and first + n == last[0]:
                last[:] = [first, last[1] + n]
            else:
                ranges[room].append([first, n])

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room = window
                first, free = used, -(-left // (window // length))
                used += free
            else:
                first, free = ranges[room].pop()
                if not ranges[room]:
                    tree.set(room, False)
            each = room // length
            whole = min(free, left // each)
            if whole:
                plan.append((length, rank, first, each, window - room))
                put(room - each * length, first, whole)
                rank, left = rank + whole * each, left - whole * each
                first, free = first + whole, free - whole
            if free and left and left < each:
                plan.append((length, rank, first, each, window - room))
                put(room - left * length, first, 1)
                first, free, left = first + 1, free - 1, 0
            put(room, first, free)
    return plan


def ranked(pieces: DataFrame) -> DataFrame:
    """Adds each piece's ``rank`` among those of its length, from 0, without one task per length."""
    at = pieces.withColumn("bucket", F.pmod(F.xxhash64("uid"), F.lit(RANK_BUCKETS)).cast("int"))
    counts = at.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(counts.select(F.col("length").alias("l"), F.col("bucket").alias("b"),
                                F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")))
    within = Window.partitionBy("length", "bucket").orderBy("uid")
    return (at.join(offsets, (F.col("length") == F.col("l")) & (F.col("bucket") == F.col("b")))
            .withColumn("rank", F.col("ahead") + F.row_number().over(within) - 1))


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    pieces = cut(cut_pieces(docs, vocabulary, window, end_id).withColumn("uid", F.monotonically_increasing_id()))
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # a row for each length up to the window
    plan = sorted(plan_windows(histogram, window))
    keys = [(p[0], p[1]) for p in plan]

    def run(*columns: list) -> list:
        sequence, offset = [], []
        for length, rank in zip(columns[2], columns[5], strict=True):
            _, first_rank, first, each, ahead = plan[bisect_right(keys, (length, rank)) - 1]
            more, nth = divmod(rank - first_rank, each)
            sequence.append(first + more)
            offset.append(ahead + nth * length)
        return [*columns[:5], sequence, offset]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_columns(ranked(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank"), run,
                       f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")

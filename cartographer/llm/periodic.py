"""Periodic runs of words by longest common extensions on suffix trees.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends. Runs of ``LEAST_WORDS`` words and ``EXPONENT``
periods or more are reported with their spans, and a collapsed text keeps the
first period of each.

Stretches that can hold such a run are found first: a run of period q in
[2^k, 2^(k+1)) covers a word number that is a multiple of 2^k and repeats from
there at distance q, which polynomial hashes of the batch's word numbers show for
all k in O(n log n). Equal words have equal hashes, so no run is missed; a hash
clash costs a tree and changes no result.

Over each stretch two trees are built by Ukkonen's algorithm, of the words and of
their reversal. Their Euler tours, reduced to the least depth between consecutive
leaves, give the longest common extension of two places by one look-up in a sparse
table. The longest Lyndon word that starts at each place, under the order of the
words and under its inverse, is a candidate root; extended both directions, each
gives a maximal repetition, and by the runs theorem every run has such a root.

Null texts have no words. Repeated rows give a row each; rows are handled one by
one, so ties between documents don't arise. A document is one task's work: time and
memory grow with the longest stretch, in proportion.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, powers, slices, texts

#: Words that a run has at least.
LEAST_WORDS = 6
#: Periods that a run has at least.
EXPONENT = 4


class ExtensionTree:
    """Suffix tree of a sequence that ends in a value of its own, with constant-time LCE."""

    def __init__(self, s: list[int]):
        """``s``: numbers of 1 or more, then one 0."""
        self.n = n = len(s)
        width = max(s) + 1
        start, stop, link, kids, leaves = [0], [0], [0], {}, []
        node = edge = length = left = 0
        for i in range(n):
            c = s[i]
            left += 1
            waits = 0  # inner node whose suffix link comes next
            while left:
                if not length:
                    edge = i
                key = node * width + s[edge]
                child = kids.get(key)
                if child is None:
                    leaves.append(len(start))
                    kids[key] = len(start)
                    start.append(i)
                    stop.append(n)
                    link.append(0)
                    if waits:
                        link[waits] = node
                        waits = 0
                else:
                    at = start[child]
                    size = stop[child] - at
                    if length >= size:
                        edge += size
                        length -= size
                        node = child
                        continue
                    if s[at + length] == c:
                        length += 1
                        if waits:
                            link[waits] = node
                        break
                    inner = len(start)
                    leaves.append(inner + 1)
                    start += (at, i)
                    stop += (at + length, n)
                    link += (0, 0)
                    kids[key] = inner
                    start[child] = at + length
                    kids[inner * width + s[at + length]] = child
                    kids[inner * width + c] = inner + 1
                    if waits:
                        link[waits] = inner
                    waits = inner
                left -= 1
                if not node and length:
                    length -= 1
                    edge = i - left + 1
                else:
                    node = link[node]
        keys = np.fromiter(kids.keys(), np.int64, len(kids))
        self.child = np.fromiter(kids.values(), np.int64, len(kids))
        self.parent, self.symbol = keys // width, keys % width
        self.size = np.array(stop) - np.array(start)
        self.leaf = np.full(len(start), -1)
        self.leaf[leaves] = np.arange(len(leaves))  # the j-th leaf is made for the suffix from j
        self.order, between = self.tour()
        self.rank = np.empty(n, np.int64)
        self.rank[self.order] = np.arange(n)
        self.table = [between]  # least depth of 2^k gaps between consecutive leaves
        while 2 << len(self.table) - 1 <= n:
            last, step = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(last[:-step], last[step:]))

    def tour(self, end_last: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of a tour, and the least depth met before each since the one before."""
        by = np.lexsort((np.where(self.symbol == 0, self.symbol.max() + 1, self.symbol) if end_last else self.symbol, self.parent))
        child, parent = self.child[by].tolist(), self.parent[by]
        bounds = np.searchsorted(parent, np.arange(len(self.size) + 1)).tolist()
        size, leaf = self.size.tolist(), self.leaf.tolist()
        order, between, low = [], [], 0
        stack = [(0, 0, 0)]
        while stack:
            node, above, first = stack.pop()
            if not first:
                low = above
            number = leaf[node]
            if number >= 0:
                order.append(number)
                between.append(low)
                low = 1 << 62
                continue
            here = above + size[node] if node else 0
            a, b = bounds[node], bounds[node + 1]
            for k in range(b - 1, a, -1):
                stack.append((child[k], here, 0))
            stack.append((child[a], here, 1))
        return np.array(order, np.int64), np.array(between, np.int64)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes from i and from j (different places)."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b) + 1  # gaps a .. b - 1
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            here = np.flatnonzero(level == k)
            row = self.table[k]
            out[here] = np.minimum(row[a[here]], row[b[here] - (1 << k)])
        return out


def next_smaller(rank: list[int]) -> np.ndarray:
    """For each place the next one of smaller rank; the last place has the smallest."""
    out, stack = np.zeros(len(rank), np.int64), []
    for i, r in enumerate(rank):
        while stack and stack[-1][0] > r:
            out[stack.pop()[1]] = i
        stack.append((r, i))
    return out


def runs_of(ids: np.ndarray, least: int = LEAST_WORDS, exponent: int = EXPONENT) -> np.ndarray:
    """(start, length, period) of all runs of a sequence of word numbers, by start, then period."""
    n = len(ids)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    s = np.unique(ids, return_inverse=True)[1] + 1
    ahead, back = ExtensionTree([*s.tolist(), 0]), ExtensionTree([*s[::-1].tolist(), 0])
    # under the inverse order of the words, an end still being the smallest, suffixes stand
    # in the reverse of the tour that meets ends last
    inverse = np.empty(n + 1, np.int64)
    inverse[ahead.tour(end_last=True)[0][::-1]] = np.arange(n + 1)
    place = np.arange(n)
    found = []
    for rank in (ahead.rank, inverse):
        period = next_smaller(rank.tolist())[:n] - place
        right = ahead.extension(place, place + period)
        left = np.zeros(n, np.int64)
        left[1:] = back.extension(n - place[1:], n - place[1:] - period[1:])
        length = left + period + right
        ok = length >= np.maximum(least, exponent * period)
        found.append(np.stack([place - left, length, period], 1)[ok])
    found = np.unique(np.concatenate(found), axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def stretches(ids: np.ndarray, bounds: np.ndarray, least: int = LEAST_WORDS, exponent: int = EXPONENT) -> np.ndarray:
    """Disjoint stretches [from, to) that hold all runs of the documents in ``ids``, neighbours included.

    Documents end at ``bounds`` and share no word number across their borders, see ``numbered``.
    """
    n, longest = len(ids), int(np.diff(bounds).max(initial=0))
    power = powers(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    # sum of id * base^place: a window's hash is told by its place, so both sides are shifted alike
    np.cumsum(ids.astype(np.uint64) * power[:n], dtype=np.uint64, out=prefix[1:])
    spans, k = [], 0
    while exponent << k <= longest or not k:
        block = np.arange(0, n, 1 << k)
        for distance in range(1 << k, min(2 << k, longest // exponent + 1)):
            # words from a block's start on that a run of this period has at least
            rest = max(least, exponent * distance) - (1 << k) + 1
            a = block[:np.searchsorted(block, n - rest, "right")]
            a = a[ids[a] == ids[a + distance]]
            same = rest - distance
            if len(a):
                ahead, behind = prefix[a + rest] - prefix[a + distance], prefix[a + same] - prefix[a]
                a = a[ahead == behind * power[distance]]
                spans.append(np.stack([a - (1 << k), a + rest + (1 << k)], 1))
        k += 1
    if not spans or not sum(map(len, spans)):
        return np.zeros((0, 2), np.int64)
    spans = np.concatenate(spans)
    doc = np.searchsorted(bounds, (spans[:, 0] + spans[:, 1]) // 2, "right") - 1
    spans = np.stack([np.maximum(spans[:, 0], bounds[doc]), np.minimum(spans[:, 1], bounds[doc + 1])], 1)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    at = np.flatnonzero(np.append(True, spans[1:, 0] >= reach[:-1]))
    return np.stack([spans[at, 0], reach[np.append(at[1:], len(spans)) - 1]], 1)


def numbered(documents: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each document, their numbers (equal words of the batch have one number), and bounds.

    ``bytes.split`` cuts at just space, tab, line feed, vertical tab, form feed and return.
    A number that occurs nowhere else follows each document's words.
    """
    known: dict[bytes, int] = {}
    number = known.setdefault
    words, ids, bounds, end = [], [], [0], -1
    for text in documents:
        of = text.split()
        words.append(of)
        ids.extend([number(w, len(known)) for w in of])
        ids.append(end)
        end -= 1
        bounds.append(len(ids))
    ids = np.array(ids, np.int64)
    return words, np.where(ids < 0, len(known) - ids, ids), np.array(bounds, np.int64)


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, runs (array of start, length, period by start, then period) and the collapsed text of each row.

    ``collapsed`` holds the words that no run contains after its first period, one space apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in slices(batches):
            words, ids, bounds = numbered([t.encode() for t in batch.column(1).to_pylist()])
            found: dict[int, list[np.ndarray]] = {}
            for a, b in stretches(ids, bounds, least, exponent).tolist():
                doc = int(np.searchsorted(bounds, a, "right")) - 1
                runs = runs_of(ids[a:b], least, exponent) + [a - bounds[doc], 0, 0]
                if len(runs):
                    found.setdefault(doc, []).append(runs)
            out, texts_ = [], []
            for doc, of in enumerate(words):
                runs = np.concatenate(found[doc]) if doc in found else np.zeros((0, 3), np.int64)
                out.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()])
                if len(runs):
                    gone = np.zeros(len(of) + 1, np.int64)
                    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
                    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
                    of = [w for w, g in zip(of, np.cumsum(gone).tolist()) if not g]
                texts_.append(b" ".join(of).decode())
            yield [batch.column(0), out, texts_]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(texts(docs), run, f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, of which a tenth of the documents repeat a stretch of their own words to the end.

    With h = crc32(doc_id as text) and g = h div 10, a document of n > 0 words with h mod 10 = 0
    repeats the p words from word a = g mod n on; p = 1 + (n - a) div (3 + g mod 8). A null id changes nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words: Column = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    repeats = F.expr("""concat_ws(' ', transform(sequence(0L, n - 1), i ->
        element_at(words, CAST(1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END AS INT))))""")
    chosen = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (F.floor(h / 10)).cast("long").alias("g"),
                         F.when(h % 10 == 0, words).alias("words"))
    sized = chosen.withColumn("n", F.size("words").cast("long")).withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END"))
    return (sized.withColumn("p", F.expr("1 + CAST(floor((n - a) / (3 + g % 8)) AS BIGINT)"))
            .select("doc_id", F.when(F.col("a").isNotNull(), repeats).otherwise(F.col("text")).alias("text")))


def digest(found: DataFrame) -> DataFrame:
    """One row per document: number of runs, the longest (ties: smallest start, then period), and two digests."""
    longest = F.expr("""array_min(transform(runs, r -> named_struct('l', -r.length, 's', r.start, 'p', r.period)))""")
    lines = F.expr("sha2(concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n'))), 256)")
    best = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("b"), lines.alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return best.select("doc_id", "n_runs", F.expr("b.s").alias("start"), F.expr("-b.l").alias("length"), F.expr("b.p").alias("period"),
                       F.expr("(-1000 * b.l) div b.p").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")

"""Secret scan: fixed patterns, then a guess-cost test of credential values.

Base spans are the matches of three patterns (``assign``, ``access``,
``hex``). The method looks at every value in a credential context (a wider set
of key words, connectors and quotes, and passwords in URLs), whether a base
span covers it or not: the value is cut into the cheapest sequence of words,
dates, repeats, keyboard walks and brute-force spans by dynamic programming,
and its cost and cut are reported. A value that no base span covers and that
takes at least ``10 ** min_log10`` guesses is added as a ``guess`` span;
values such as ``changeme2024`` stay cheap and are left alone.

The words are a short list of common passwords, then the words of the corpus
in at least a share ``WORD_SHARE`` of the documents (and in two), most frequent
first. At most (distinct words of a mean document) / ``WORD_SHARE`` words can
reach that share, whatever the size of the corpus; only they are collected and
broadcast. Values in a credential context do not count there, so a secret that
is repeated does not become a word. A rarer word counts as a secret if it
stands after ``is``, ``:`` or ``=`` and takes that many guesses by its letters.

Time is linear in a text's length: values that end at one place share one pass.
Null texts are empty: no spans. Positions are code points, ends exclusive.
Repeated rows give repeated results; rows with a null id are kept.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, map_columns, texts

KINDS = ("assign", "access", "hex", "guess")

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGN_STEMS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

#: A key word begins at a word's beginning (or a capital after a small letter); before ``:`` and ``=`` the longer ones may end
#: a word (``dbpassword=``). After a mere space a value is quoted or of mixed classes.
_LONG = r"pass(?:word|wd|phrase|code)|secret|token|(?:api|access|private|signing|encryption)[_\x20-]?key|credentials?"
_KEY = rf"(?:{_LONG}|pass|pwd|auth(?:orization|_?token)?|bearer)"
_START = r"(?:(?<![^\W_])|(?<=[a-z0-9])(?=[A-Z]))"
CONTEXT = re.compile(
    rf"""(?:(?:{_START}(?i:{_KEY})|(?i:{_LONG}))["']?\x20*(?:[:=]>?|=>)|{_START}(?i:{_KEY})["']?(?:\x20*\bis\b|(?P<space>\x20)))\x20*"""
    r"""(?=["']?[^\s"'])""", re.ASCII)
#: What ends a value without quotes.
STOP = re.compile(r"""[\s"']""", re.ASCII)
CONTEXT_STEMS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer")
USERINFO = re.compile(r"://[^\s/:@]+:([^\s/@]+)@")

#: Common passwords and words in them, most frequent first (rank = position).
COMMON_WORDS = tuple(
    "password admin welcome login master secret letmein default changeme monkey dragon football baseball "
    "sunshine princess shadow superman batman iloveyou trustno test guest root user hello love summer winter "
    "spring autumn january february march april may june july august september october november december "
    "monday tuesday wednesday thursday friday saturday sunday pass access server system database service "
    "example sample temp demo public private token key company office secure internet computer google "
    "apple orange flower cheese cookie coffee chocolate charlie jordan michael daniel thomas robert george "
    "the and you this that with for from have not your our required optional value string none null true false "
    "undefined placeholder enter here todo".split())

#: The letter rows of a keyboard; a key's neighbours stand in its row and, shifted by half a key, beside it.
KEY_ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = dict(zip('!@#$%^&*()_+{}:"<>?', "1234567890-=[];',./", strict=True))
LEET = dict(zip("@43!10$57", "aaeiiosst", strict=True))

DIGIT_COST, LETTER_COST, UPPER_COST, SYMBOL_COST = 1.0, math.log10(26), math.log10(26), math.log10(33)
SEGMENT_COST = math.log10(2)
YEARS = 200
LONGEST_REPEAT = 16
MIN_LOG10 = 10.0
#: The dictionary from the corpus: least share of documents with a word, and least number.
WORD_SHARE, WORD_DOCS = 5e-4, 2
#: Repeats enter with up to so many blocks and with all that follow; walks with up to so many keys and with all.
REPEAT_TIMES, WALK_KEYS = 8, 16
TIMES = [0.0, *map(math.log10, range(1, REPEAT_TIMES + 1))]
#: Segments of a value's cut that are reported; its cost covers them all.
MOST_PARTS = 64
WORD = re.compile(r"(?<![^\W_])[^\W\d_]{3,24}(?![^\W_])")
#: Words that a task counts before it hands them on.
TASK_WORDS = 500_000

DATE = re.compile(
    r"(?:(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d"
    r"|(?:0[1-9]|1[0-2])([-/._]?)(?:0[1-9]|[12]\d|3[01])\3(?:19|20)\d\d|(?:19|20)\d\d)", re.ASCII)


def _neighbours() -> dict[str, dict[str, int]]:
    at = {c: (y, x + y * 0.5) for y, row in enumerate(KEY_ROWS) for x, c in enumerate(row)}
    out: dict[str, dict[str, int]] = {c: {} for c in at}
    for a, (ya, xa) in at.items():
        for b, (yb, xb) in at.items():
            if a != b and abs(ya - yb) <= 1 and abs(xa - xb) <= (1 if ya == yb else 0.5):
                out[a][b] = (yb - ya) * 3 + (1 if xb > xa else -1)  # the direction of the step
    return out


NEIGHBOURS = _neighbours()


def _char_cost(c: str) -> float:
    if c.isdigit():
        return DIGIT_COST
    if c.isalpha():
        return UPPER_COST if c.isupper() else LETTER_COST
    return SYMBOL_COST


def _class_of(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isalpha() else 3


class Ranked(dict):
    """log10 of the rank of each word, and the length of the longest."""

    longest = 0


def rank_words(words: Sequence[str]) -> Ranked:
    out = Ranked()
    for i, w in enumerate(words, 1):
        out.setdefault(w.lower(), math.log10(i))
    out.longest = max(map(len, out), default=0)
    return out


RANKED = rank_words(COMMON_WORDS)


class Segmentation:
    """Least log10 of guesses for every tail of ``value``, and the segments that give it.

    One pass from the end to the beginning, linear in the length for a fixed
    dictionary: each place has a bounded number of first segments. A
    brute-force span pays for each character and each change of class.
    """

    def __init__(self, value: str, ranked: dict[str, float] | None = None):
        ranked = RANKED if ranked is None else ranked
        self.n = n = len(value)
        low = value.lower() if len(value.lower()) == n else value
        plain = "".join(LEET.get(c, c) for c in low)
        keys = "".join(SHIFTED.get(c, c) for c in low)
        longest = ranked.longest if isinstance(ranked, Ranked) else max(map(len, ranked), default=0)
        spelled = [0, *accumulate(a != b for a, b in zip(plain, low, strict=True))]
        upper = [0, *accumulate(c.isupper() for c in value)]
        single = [_char_cost(c) for c in value]
        costs = [0.0, *accumulate(single)]
        kinds = [_class_of(c) for c in value]
        two, four = math.log10(2), math.log10(4)
        self.tail, self.first = tail, first = [0.0] * (n + 1), [("", n)] * (n + 1)
        follow = [0] * (LONGEST_REPEAT + 1)  # equal characters at this distance from here on
        walk_to, walked = n, [0] * (n + 1)  # end of the walk from here; its directions from each place on
        brute, brute_to, step = math.inf, n, 0
        for i in range(n - 1, -1, -1):
            more = brute + (two if i + 1 < n and kinds[i] != kinds[i + 1] else 0.0)
            if tail[i + 1] < more - 1e-12:  # of equal ones the longer span
                brute, brute_to = tail[i + 1] + single[i], i + 1
            else:
                brute = more + single[i]
            best, kind, to = brute, "brute", brute_to
            if value[i].isalnum() or plain[i].isalnum():
                for j in range(i + 3, min(i + longest, n) + 1):
                    word = plain[i:j]
                    if word not in ranked:
                        word = low[i:j]
                        if word not in ranked:
                            continue
                    size, capitals = j - i, upper[j] - upper[i]
                    extra = (two if capitals == size or capitals == 1 and value[i].isupper() else
                             math.log10(math.comb(size, min(capitals, size // 2)) + 1)) if capitals else 0.0
                    cost = tail[j] + ranked[word] + extra + two * (spelled[j] - spelled[i])
                    if cost < best:
                        best, kind, to = cost, "word", j
            if value[i].isdigit():
                for j, price in _dates(value, i):
                    if tail[j] + price < best:
                        best, kind, to = tail[j] + price, "date", j
            for size in range(1, min(LONGEST_REPEAT, n - i - 1) + 1):
                follow[size] = follow[size] + 1 if low[i] == low[i + size] else 0
                fewest, most = 3 if size == 1 else 2, follow[size] // size + 1
                if most >= fewest:
                    block = min(costs[i + size] - costs[i], ranked.get(low[i:i + size], math.inf))
                    for times in range(fewest, min(most, REPEAT_TIMES) + 1):
                        cost = tail[i + size * times] + block + TIMES[times]
                        if cost < best:
                            best, kind, to = cost, "repeat", i + size * times
                    if most > REPEAT_TIMES and tail[i + size * most] + block + math.log10(most) < best:
                        best, kind, to = tail[i + size * most] + block + math.log10(most), "repeat", i + size * most
            way = NEIGHBOURS.get(keys[i], {}).get(keys[i + 1]) if i + 1 < n else None
            if way is None:
                walk_to, step, walked[i] = i + 1, 0, 0
            else:
                walked[i], step = walked[i + 1] + (way != step), way
                for j in {*range(i + 3, min(walk_to, i + WALK_KEYS) + 1), walk_to} if walk_to - i >= 3 else ():
                    cost = tail[j] + math.log10(47 * (j - i)) + (walked[i] - walked[j - 2] + 1) * four
                    if cost < best:
                        best, kind, to = cost, "walk", j
            tail[i], first[i] = best + SEGMENT_COST, (kind, to)

    def parts(self, start: int = 0, most: int | None = None) -> list[tuple[str, int, int]]:
        """(kind, start, end) of the segments of ``value[start:]``, of the first ``most`` if given."""
        out = []
        while start < self.n and len(out) != most:
            kind, to = self.first[start]
            out.append((kind, start, to))
            start = to
        return out


def _dates(value: str, start: int) -> list[tuple[int, float]]:
    """(end, log10 of guesses) of the dates and the year at a place."""
    m = DATE.match(value, start)
    if not m:
        return []
    mark = math.log10(5) if any(m.groups()) else 0.0
    out = [(m.end(), math.log10(YEARS) + (0.0 if m.end() - start == 4 else math.log10(366)) + mark)]
    if value[start:start + 2] in ("19", "20"):
        out.append((start + 4, math.log10(YEARS)))
    return out


def segment(value: str, ranked: dict[str, float] | None = None) -> tuple[float, list[tuple[str, int, int]]]:
    """Least log10 of guesses for ``value`` and the segments that give it."""
    found = Segmentation(value, ranked)
    return found.tail[0], found.parts()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three fixed patterns."""
    out = []
    low = text.lower()
    if any(s in low for s in ASSIGN_STEMS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _mixed(value: str) -> bool:
    """More than letters of one case, punctuation at the end and a capital at the beginning aside."""
    value = value.rstrip(".,;:!?)]}>")
    return len({_class_of(c) for c in value}) > 1 and not (value.isalpha() and value[1:].islower())


def context_values(text: str) -> list[tuple[int, int]]:
    """Values that stand after a credential word or in a URL's user part, without closing punctuation."""
    out, low = set(), text.lower()
    if any(s in low for s in CONTEXT_STEMS):
        at, stop = 0, -1  # ``stop`` ends the unquoted run that ``at`` is in
        while m := CONTEXT.search(text, at):
            start = m.end()
            quote = text[start] if text[start] in "\"'" else None
            if quote:
                start += 1
                end = text.find(quote, start)
                good = end > start and "\n" not in text[start:end]
            else:
                if stop <= start:
                    found = STOP.search(text, start)
                    stop = found.start() if found else len(text)
                end, good = stop, m["space"] is None or _mixed(text[start:stop])
            if good:
                out.add((start, end))
            at = max(start, at + 1)  # a value may itself be the next key word
    if "://" in text:
        out.update(m.span(1) for m in USERINFO.finditer(text))
    closed: dict[int, int] = {}
    for end in {e for _, e in out}:
        closed[end] = end
        while closed[end] and text[closed[end] - 1] in ".,;:!?)]}>":
            closed[end] -= 1
    return sorted({(s, closed[e]) for s, e in out if closed[e] > s})


def scored_values(text: str, ranked: dict[str, float] | None = None) -> list[tuple[int, int, float, str]]:
    """(start, end, log10 of guesses, segments) of every context value; those with one end share a pass."""
    by_end = defaultdict(list)
    for start, end in context_values(text):
        by_end[end].append(start)
    out = []
    for end, starts in by_end.items():
        least = starts[0]
        found = Segmentation(text[least:end], ranked)
        for start in starts:
            parts = found.parts(start - least, MOST_PARTS)
            out.append((start, end, found.tail[start - least], ",".join(f"{k}:{s + least}:{e + least}" for k, s, e in parts)))
    return sorted(out)


def find_spans(text: str, ranked: dict[str, float] | None = None, min_log10: float = MIN_LOG10,
               values: list[tuple[int, int, float, str]] | None = None) -> list[tuple[int, int, int, float | None]]:
    """(start, kind, end, log10 of guesses) of base and added spans, in order.

    A value that a base span covers wholly adds nothing.
    """
    base = base_spans(text)
    starts, reach = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max))
    added = []
    for start, end, cost, _ in scored_values(text, ranked) if values is None else values:
        at = bisect_right(starts, start) - 1
        if cost >= min_log10 and end - start >= 6 and (at < 0 or reach[at] < end):
            added.append((start, 3, end, cost))
    return sorted([(s, k, e, None) for s, k, e in base] + added, key=lambda x: x[:3])


SPANS = "array<struct<kind:string,start:int,end:int,log10:double>>"
VALUES = "array<struct<start:int,end:int,log10:double,parts:string>>"


def _outside(text: str, values: list[tuple[int, int]]) -> str:
    """``text`` with a space for every stretch of values."""
    out, at = [], 0
    for start, end in values:
        if end > at:
            out += [text[at:max(at, start)], " "]
            at = end
    return "".join([*out, text[at:]])


def corpus_words(docs: DataFrame) -> list[str]:
    """The words of the dictionary: common passwords, then the corpus' words, most frequent first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        counts: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                counts.update(set(WORD.findall(_outside(t, context_values(t)).lower())))
                if len(counts) > TASK_WORDS:
                    yield [list(counts), list(counts.values())]
                    counts = Counter()
        yield [list(counts), list(counts.values())]

    known = docs.select("text").where("text is not null")
    least = max(WORD_DOCS, math.ceil(WORD_SHARE * known.count()))
    found = map_arrow(known, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    # at most (distinct words of a mean document) / WORD_SHARE rows
    return [*COMMON_WORDS, *(r.word for r in sorted(found.collect(), key=lambda r: (-r.n, r.word)))]


def scan_secrets(docs: DataFrame, words: Sequence[str] | None = None, min_log10: float = MIN_LOG10) -> DataFrame:
    """One row per document: doc_id, its ordered ``spans`` and all scored ``values`` with their cut."""
    shared = docs.sparkSession.sparkContext.broadcast(rank_words(corpus_words(docs) if words is None else words))

    def run(ids: list, text: list) -> list:
        values = [scored_values(t, shared.value) for t in text]
        spans = [[{"kind": KINDS[k], "start": s, "end": e, "log10": c} for s, k, e, c in find_spans(t, shared.value, min_log10, v)]
                 for t, v in zip(text, values, strict=True)]
        return [ids, spans, [[{"start": s, "end": e, "log10": c, "parts": p} for s, e, c, p in v] for v in values]]

    return map_columns(texts(docs), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, spans {SPANS}, values {VALUES}")


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]", words: Sequence[str] | None = None,
                   min_log10: float = MIN_LOG10) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``; n_chars follows; null texts stay null.

    Overlapping spans are replaced once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(rank_words(corpus_words(docs) if words is None else words))

    def clean(t: str | None) -> str | None:
        if not t:
            return t
        out, at = [], 0
        for s, _, e, _ in find_spans(t, shared.value, min_log10):
            if s >= at:
                out += [t[at:s], mark]
            at = max(at, e)
        return "".join([*out, t[at:]]) if at else t

    def run(*columns: list) -> list:
        text = [clean(t) for t in columns[1]]
        return [columns[0], text, *columns[2:4], [None if t is None else len(t) for t in text]]

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    return map_columns(docs.select(*columns), run, ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in columns))


def joined(spans: F.Column) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash of the base spans, all spans, and the costs and cuts of the context values of each document."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id", *(of(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        of("guess").alias("n_guess"), F.size("values").cast("long").alias("n_values"),
        F.array_max(F.transform("values", lambda v: v["log10"])).alias("max_log10"),
        F.array_join(F.transform("values", lambda v: F.concat_ws("=", F.concat_ws(":", v["start"], v["end"]), v["parts"])), ";").alias("values"))

"""Secret scans: fixed formats, and values in credential context whose guess cost is high.

Base spans are found by fixed rules. Values that follow a credential word (password, pwd, bearer, ...) are priced by
dynamic programming: the cheapest way to cut a value into dictionary words, dates, repeats, keyboard walks and
brute-force spans, as log10 of the guesses an attacker needs. A value of at least ``LEAST_COST``, or ``LETTERS_COST`` if it
has only letters as long foreign words do, that touches no base span is added as a ``cost`` span. Words are ranked by their place in a public
tokenizer's merge list, whose path is a parameter.

Defined results: a NULL text counts as empty and has no spans; the digest of no spans is that of the empty string.
Rows may repeat and are judged each. Segments of a value are at most ``SEGMENT`` characters long, brute-force spans
add up, so values of any length take time in proportion to it. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfcast.llm.common import batch_of, texts_of

LEAST_COST, LETTERS_COST, SEGMENT = 10.0, 16.5, 32
KINDS = ("assign", "access", "hex", "cost")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
_CONTEXT = re.compile(
    r"""(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|bearer)s?["']?"""
    r"""\s{0,8}(?:[:=]{1,2}>?|\bis\b|(?<=bearer))\s{0,8}["']?([^\s"'<>]+)""", re.I | re.A)
_STEMS = ("pass", "pwd", "secret", "token", "key", "credential", "bearer")
_HEX_MAP = bytes(120 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
# fixed values: common passwords and the rows of a keyboard
COMMON = ("password", "passwd", "qwerty", "letmein", "admin", "welcome", "monkey", "dragon", "master", "login", "abc123",
          "iloveyou", "sunshine", "princess", "football", "shadow", "secret", "changeme", "default", "root", "test", "guest")
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?"
                   r"|(?:0?[1-9]|[12]\d|3[01])[-/._](?:0?[1-9]|1[0-2])[-/._](?:19|20)?\d\d")
_REPEAT = re.compile(r"(.{1,8}?)\1+")


@lru_cache(maxsize=1)
def word_ranks(path: str) -> dict[str, int]:
    """Whole words of the vocabulary with their rank, common passwords first."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    words = [w[:-4] for w, _ in sorted(vocabulary.items(), key=lambda x: x[1]) if w.endswith("</w>")]
    ranks: dict[str, int] = {}
    for word in [*COMMON, *(w for w in words if len(w) >= 3 and w.isalpha())]:
        ranks.setdefault(word, len(ranks) + 1)
    return ranks


def _neighbours() -> set[tuple[str, str]]:
    place = {c: (i, j) for i, row in enumerate(ROWS) for j, c in enumerate(row)}
    return {(a, b) for a, (i, j) in place.items() for b, (k, m) in place.items()
            if a != b and abs(i - k) <= 1 and -1 <= j - m <= 1}


_NEXT_KEYS = _neighbours()
_LEET = str.maketrans("4301$5@7", "aeolssat")


def _alphabet(c: str) -> float:
    if c.isdigit():
        return 1.0
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return math.log10(26)
    return math.log10(33) if ord(c) < 128 else 2.0


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """log10 of the guesses that the cheapest segmentation needs."""
    n, low = len(value), value.lower()
    plain = low.translate(_LEET)
    best = [0.0] + [math.inf] * n
    walk, on_walk = 0, math.inf  # where the keyboard walk that ends here began, and the cheapest way to have begun it
    runs = {m.start(): m for m in _REPEAT.finditer(low)}
    for i in range(n):
        if i and (low[i - 1], low[i]) not in _NEXT_KEYS:
            walk, on_walk = i, math.inf
        # brute force, a character at a time
        best[i + 1] = min(best[i + 1], best[i] + _alphabet(value[i]))
        here = best[i] + 0.3  # each segment must also be guessed to be one
        for j in range(i + 3, min(n, i + SEGMENT) + 1):
            part = low[i:j]
            rank = ranks.get(part)
            if rank is not None:
                cased = 0.0 if value[i:j] == part or value[i:j] == part.capitalize() or value[i:j].isupper() else 1.0
                best[j] = min(best[j], here + math.log10(rank + 1) + cased)
            elif plain[i:j] != part and plain[i:j] in ranks:
                best[j] = min(best[j], here + math.log10(ranks[plain[i:j]] + 1) + 1.0)
        date = _DATE.match(low, i)
        if date:
            best[date.end()] = min(best[date.end()], here + (2.1 if len(date.group()) <= 4 else 4.6))
        repeat = runs.get(i)
        if repeat and len(repeat.group()) >= 3:
            unit = sum(map(_alphabet, repeat.group(1)))
            best[repeat.end()] = min(best[repeat.end()], here + unit + math.log10(len(repeat.group()) / len(repeat.group(1))))
        if i - walk >= 2:
            on_walk = min(on_walk, best[i - 2] - 0.35 * (i - 2))
            best[i + 1] = min(best[i + 1], on_walk + 0.3 + math.log10(47) + 0.35 * i)
    return best[n]


def _base(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if b"x" * 16 in text.encode("utf-8", "surrogatepass").translate(_HEX_MAP):
        out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def scan(text: str, ranks: dict[str, int]) -> tuple[list, list, float | None]:
    """Base spans, added spans, and the highest guess cost of a value in credential context."""
    low = text.lower()
    base, added, highest = _base(text), [], None
    if any(s in low for s in _STEMS):
        at, reach = 0, 0  # base spans that begin before the value ends, and how far they reach
        for m in _CONTEXT.finditer(text):
            value = m.group(1).rstrip(".,;:!?)]}")
            start, end = m.start(1), m.start(1) + len(value)
            if not value:
                continue
            cost = guess_cost(value, ranks)
            highest = cost if highest is None else max(highest, cost)
            while at < len(base) and base[at][0] < end:
                reach = max(reach, base[at][2])
                at += 1
            if cost >= (LETTERS_COST if value.isalpha() else LEAST_COST) and reach <= start:
                added.append((start, 3, end))
    return base, added, highest


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
    T.StructField("n_hex", T.LongType()), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
    T.StructField("n_added", T.LongType()), T.StructField("highest_cost", T.DoubleType())])


def secret_spans(docs: DataFrame, words: str) -> DataFrame:
    """One row per document with its spans; ``words`` is the path of the vocabulary with the word ranks."""
    def work(batches):
        ranks = word_ranks(words)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                base, added, highest = scan(text, ranks)
                rows.append((doc, *[sum(k == i for _, k, _ in base) for i in range(3)],
                             hashlib.sha256(spelled(base).encode()).hexdigest(), spelled(sorted(base + added)), len(added), highest))
            yield batch_of(FOUND, [list(c) for c in zip(*rows)] if rows else [[] for _ in FOUND])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(work, FOUND)

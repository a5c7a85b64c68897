"""Personal data: fixed rules, and boosted trees over the spans that generous generators propose.

Base spans follow fixed rules and always stay. Generators with high recall propose further spans, which may overlap:
addresses spelled with "at" and "dot", digit groups with any separators, dotted quads of any size. Boosted trees judge
every candidate by its format (length, digits, groups, separators, check digit, ...) and its context (neighbouring
characters, words in front). What decides the base rules is hidden from them: spans are read in a plain form without plus
sign, country code and the spelling of "@" and ".", and check digit and number sizes are no features. The trees tell base
spans from untouched candidates, which are unlabelled rather than wrong, on a sample of each kind and class. A candidate
counts if it looks more like a base span than an unlabelled one and scores no lower than the lowest ``BELOW`` of the base spans
of its kind in documents that were not fitted. Accepted candidates that touch no base span are added; where they
overlap each other the more probable one stays.

Defined results: a NULL text counts as empty and has no spans; the digest of no spans is that of the empty string.
Rows may repeat and are judged each. With fewer than ``LEAST`` examples of either class nothing is added,
nor of a kind with fewer than ``LEAST // 4`` base spans that were not fitted, which have no limit to measure. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import string
from bisect import bisect_left

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import batch_of, stored, texts_of

KINDS = ("email", "ip", "card", "phone")
SAMPLE, LEAST, BELOW, BINS = 20_000, 50, 0.25, 1000
TREES, DEPTH = 12, 3
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = string.ascii_letters + string.digits + "._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# the generators
_SPELLED = re.compile(r"(?<![\w.+-])[\w.+-]{2,40}\s?[(\[]?(?:@|\bat\b)[)\]]?\s?[\w-]{2,40}(?:\s?[(\[]?(?:\.|\bdot\b)[)\]]?\s?[A-Za-z][\w-]{1,20}){1,3}", re.A)
_GROUPS = re.compile(r"(?<![0-9A-Za-z])\(?[0-9]{1,19}\)?(?:[\x20./-]{1,2}\(?[0-9]{1,19}\)?){1,5}(?![0-9A-Za-z])|(?<![0-9A-Za-z])[0-9]{9,19}(?![0-9A-Za-z])")
_WORDS = {  # words in front that speak for a kind
    0: ("mail", "contact", "write", "reach"), 1: ("ip", "host", "server", "addr", "login"),
    2: ("card", "visa", "master", "credit", "iban", "pay"), 3: ("tel", "phone", "call", "fax", "mobile", "cell", "whatsapp")}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str):
    at, done = text.find("@"), 0
    while at >= 0:
        # the run of allowed characters in front, however long, read back in growing windows
        width, start = 64, at
        while start > done and start > at - width:
            low = max(done, at - width)
            start = low + len(text[low:at].rstrip(_LOCAL))
            if start > low:
                break
            width *= 4
        d = _DOMAIN.match(text, at + 1) if start < at else None
        if d:
            yield 0, start, d.end()
            done = d.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind, then start."""
    out = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Spans the generators propose, and the kind each is proposed as."""
    out = []
    if "@" in text or (" dot " in text or "(dot)" in text or "[dot]" in text):
        out += [(0, m.start(), m.end()) for m in _SPELLED.finditer(text)]
    if _DIGIT.search(text):
        for m in _GROUPS.finditer(text):
            digits = sum(c.isdigit() for c in m.group())
            if m.group().count(".") == 3:
                out.append((1, m.start(), m.end()))
            if 12 <= digits <= 19 and luhn("".join(c for c in m.group() if c.isdigit())):  # else it is no card by definition
                out.append((2, m.start(), m.end()))
            if 7 <= digits <= 15:
                out.append((3, m.start(), m.end()))
    return out


_AT = re.compile(r"\s?[(\[]\s?(?:@|at)\s?[)\]]\s?|\sat\s|@", re.A)
_DOT = re.compile(r"\s?[(\[]\s?(?:\.|dot)\s?[)\]]\s?|\sdot\s", re.A)
_COUNTRY = re.compile(r"\+(?:[0-9]{1,3}[\x20.-]+(?=[(0-9]))?")


def plain_form(span: str, kind: int) -> str:
    """The span as it would read without what decides the base rule of its kind."""
    if kind == 0:
        return _DOT.sub(".", _AT.sub("@", span, count=1))
    return _COUNTRY.sub("", span, count=1) if kind == 3 else span


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format of the span's plain form, and its context."""
    span = plain_form(text[start:end], kind)
    groups = [len(g) for g in re.findall("[0-9]+", span)] or [0]
    front = re.findall(r"[a-z]+", text[max(0, start - 40):start].lower())[-4:]
    before, after = text[start - 1:start], text[end:end + 1]
    return [float(x) for x in (
        kind == 0, kind == 1, kind == 2, kind == 3, len(span), sum(groups), len(groups), max(groups), min(groups), groups[-1],
        sum(c.isalpha() for c in span), span.count(" "), span.count("-"), span.count("."), span.count("("), span.count("/"),
        before.isspace() or not before, after.isspace() or not after, after in ".,;:!?)", before.isalnum(),
        any(w.startswith(s) for w in front for s in _WORDS[kind]))]


SPAN = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
PROPOSED = T.StructType([*SPAN.fields, T.StructField("base", T.BooleanType()), T.StructField("features", T.ArrayType(T.FloatType()))])
ADDED = T.StructType([T.StructField("row_no", T.LongType()), T.StructField("added", T.ArrayType(SPAN))])
FOUND = T.StructType([
    T.StructField("row_no", T.LongType()), T.StructField("doc_id", T.LongType()),
    *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS], T.StructField("base_sha256", T.StringType()),
    T.StructField("base", T.ArrayType(SPAN)), T.StructField("proposed", T.ArrayType(PROPOSED))])


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def _touches(base: list, start: int, end: int) -> bool:
    return any(s < end and start < e for _, s, e in base)


def proposed_spans(docs: DataFrame) -> DataFrame:
    """Base spans and all candidates of every document; stored."""
    def work(batches):
        for batch in batches:
            rows = []
            for row, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2))):
                base = base_spans(text)
                own = [(k, s, e, True, features(text, k, s, e)) for k, s, e in base]
                by_place = sorted((s, e) for _, s, e in base)
                at, reach = 0, -1
                for k, s, e in sorted(candidates(text), key=lambda c: c[1]):
                    while at < len(by_place) and by_place[at][0] < e:
                        reach = max(reach, by_place[at][1])
                        at += 1
                    if reach <= s:  # touches no base span
                        own.append((k, s, e, False, features(text, k, s, e)))
                rows.append((row, doc, *[sum(k == i for k, _, _ in base) for i in range(4)],
                             hashlib.sha256(spelled(base).encode()).hexdigest(),
                             [dict(zip(("kind", "start", "end"), b)) for b in base],
                             [dict(zip(("kind", "start", "end", "base", "features"), c)) for c in own]))
            yield batch_of(FOUND, [list(c) for c in zip(*rows)] if rows else [[] for _ in FOUND])

    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(work, FOUND), "pii")


def fit(found: DataFrame):
    """Trees and the calibrated probability per kind, or None if there is too little to learn from."""
    each = found.select("row_no", F.explode("proposed").alias("c")).select(
        "row_no", "c.*", (F.pmod(F.xxhash64("row_no", F.lit("fold")), F.lit(3)) == 0).alias("kept_out"))
    counts = {(r.kind, r.base): r.n for r in each.where("NOT kept_out").groupBy("kind", "base").agg(F.count("*").alias("n")).collect()}
    if min(sum(n for (_, base), n in counts.items() if base == label) for label in (True, False)) < LEAST:
        return None
    # about as many of each kind and class, by a hash
    most, place = SAMPLE // (2 * len(KINDS)), F.pmod(F.xxhash64("row_no", "kind", "start"), F.lit(1 << 30))
    part = F.lit(1 << 30)
    for (kind, base), n in counts.items():
        if n > most:
            part = F.when((F.col("kind") == kind) & (F.col("base") == base), int(most / n * (1 << 30))).otherwise(part)
    fold = stored(each.where(~F.col("kept_out") & (place < part)).select(
        F.col("base").cast("double").alias("label"), array_to_vector("features").alias("features")), "pii-sample")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=2, featuresCol="features", labelCol="label").fit(fold)
    # scores of all base spans that were not fitted, as counts per kind and bin
    judged = model.transform(each.where("kept_out AND base").select("kind", array_to_vector("features").alias("features")))
    bins = judged.groupBy("kind", F.floor(vector_to_array("probability")[1] * BINS).alias("bin")).agg(F.count("*").alias("n")).collect()
    limits = {}
    for kind in {r.kind for r in bins}:
        own = sorted((r.bin, r.n) for r in bins if r.kind == kind)
        n = np.cumsum([n for _, n in own])
        if n[-1] >= LEAST // 4:
            limits[kind] = max(0.5, own[int(np.searchsorted(n, BELOW * n[-1]))][0] / BINS)
    return (model, limits) if limits else None


def apart(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (kind, start, end) in order of preference, those that overlap none before them."""
    starts, ends, kept = [], [], []
    for kind, start, end in spans:
        at = bisect_left(starts, end)  # kept spans that begin before this one ends
        if at == 0 or ends[at - 1] <= start:
            starts.insert(at, start)
            ends.insert(at, end)
            kept.append((kind, start, end))
    return kept


def _chosen(found: DataFrame, model, limits: dict[int, float]) -> DataFrame:
    """row_no and the added spans (kind, start, end) of documents that have some."""
    rows = found.select("row_no", F.explode("proposed").alias("c")).where("NOT c.base").select(
        "row_no", "c.kind", "c.start", "c.end", array_to_vector("c.features").alias("features"))
    limit = F.lit(2.0)
    for kind, least in limits.items():
        limit = F.when(F.col("kind") == kind, least).otherwise(limit)
    judged = model.transform(rows).withColumn("p", vector_to_array("probability")[1]).where(F.col("p") >= limit)
    # the accepted spans of one document
    spans = judged.groupBy("row_no").agg(F.sort_array(F.collect_list(F.struct("p", "start", "end", "kind")), asc=False).alias("s"))

    def work(batches):
        for batch in batches:
            kept = [[dict(zip(("kind", "start", "end"), x)) for x in apart([(s["kind"], s["start"], s["end"]) for s in spans])]
                    for spans in batch.column(1).to_pylist()]
            yield batch_of(ADDED, [batch.column(0), kept])
    return spans.mapInArrow(work, ADDED)


def personal_spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the counts and digest of its base spans, all spans, n_added."""
    found = proposed_spans(docs)
    fitted = fit(found)
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    rows = found.drop("proposed")
    if fitted is None:
        rows = rows.withColumn("added", none)
    else:
        rows = rows.join(_chosen(found, *fitted), "row_no", "left").withColumn("added", F.coalesce("added", none))
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(F.array_sort(F.concat("base", "added")), lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string")))
    return rows.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", F.array_join(spans, ",").alias("spans"),
                       F.size("added").cast("long").alias("n_added"))

"""Language identification by interpolated Kneser-Ney character models.

Texts are lower-cased; every run of characters that are not letters counts as one separator, and the model reads the
letters with separators around the words. The counts of all ``ORDER``-grams of each language come from every training
document. Lower orders are continuation counts (how many different characters stand in front), as Kneser-Ney asks,
with one absolute discount per language and order. The finished probabilities are kept in arrays sorted by the
64-bit code of the n-gram, one column per language, so one binary search scores an n-gram for all of them; n-grams
no language has seen fall back through the stored context weights.

The language of the lowest cross-entropy per character wins. A document is rejected if it has no letter, or if even
the best cross-entropy is above what documents of that language reach: mean + ``MARGIN`` + ``SPREADS`` deviations
of a mean over so many characters, measured on all training documents of the language. A language of fewer than
``FEW`` documents has limits no lower than the others; without any measured document nothing is rejected for its entropy.

Defined results: NULL text or text without letters gives ``und``, score 0, rejected. Documents with NULL lang never
train. Without any training document everything is ``und``. Equal entropies give the first language by code point.
Up to ``MOST_CELLS`` cells, distinct n-grams times languages, the model is broadcast: its arrays then hold at most four
times as many 4-byte numbers twice over, 64 MB. A larger one stays in tables, which Spark aggregates make and the documents'
distinct n-grams are joined to; the driver then holds a discount per language and order. Both compute the same probabilities
from all counts, the tables in double and the arrays in single precision.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import batch_of, free_name, map_arrow, numbered, slices, stored, text_runs

ORDER = 4
MOST_CELLS = 2_000_000
MARGIN, SPREADS, FEW = 1.0, 8.0, 30
#: Characters of evidence that the score counts at most.
EVIDENCE = 48
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_SEPARATOR = 32
_MASK = [np.uint64((1 << (16 * n)) - 1) for n in range(ORDER + 1)]


def _letters(text: str) -> str:
    found = _NOT_LETTERS.sub(" ", text.lower())
    if not found.isascii():  # signs such as superscript digits are word characters without being letters
        for c in set(found):
            if c != " " and not c.isalpha():
                found = found.replace(c, " ")
    return found.strip()


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of the n-grams that end at each letter or closing separator, and the owner of each. Codes are
    exact for characters below U+10000; others share codes by their low bits."""
    joined = "".join(" " * (ORDER - 1) + t + " " for t in texts)
    chars = (np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32) & 0xFFFF).astype(np.uint64)
    length = np.array([len(t) for t in texts], np.int64) + 1
    start = np.cumsum(length + ORDER - 1) - length
    owner = np.repeat(np.arange(len(texts)), length)
    at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length) + np.repeat(start, length)
    code = chars.copy()
    for k in range(1, ORDER):
        code[k:] |= chars[:-k] << np.uint64(16 * k)
    return code[at], owner


def _counted(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for a, b in slices((len(x) for x in texts), 1 << 20):
        yield np.unique(_codes(texts[a:b])[0], return_counts=True)


COUNTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("code", T.LongType()),
                       T.StructField("n", T.LongType())])


def ngram_counts(train: DataFrame) -> DataFrame:
    """(lang, code, n) over all of ``train`` (lang, text)."""
    def count(batches):
        for batch in batches:
            at, langs = 0, batch.column(0).to_pylist()
            held: dict[str, list] = {}
            for run in text_runs(batch.column(1)):
                by: dict[str, list[str]] = {}
                for lang, text in zip(langs[at:at + len(run)], run):
                    letters = _letters(text)
                    if letters:
                        by.setdefault(lang, []).append(letters)
                at += len(run)
                for lang, own in by.items():
                    held.setdefault(lang, []).extend(_counted(own))
            for lang, counted in held.items():
                code, back = np.unique(np.concatenate([c for c, _ in counted]), return_inverse=True)
                n = np.bincount(back, weights=np.concatenate([k for _, k in counted])).astype(np.int64)
                yield batch_of(COUNTS, [[lang] * len(code), code.view(np.int64), n])

    partial = train.select("lang", "text").where("lang IS NOT NULL").mapInArrow(count, COUNTS)
    return partial.groupBy("lang", "code").agg(F.sum("n").alias("n"))


class Judge:
    """What follows from cross-entropies, whatever holds the probabilities."""

    def __init__(self, langs: list[str]):
        self.langs, self.calibration = langs, np.full((len(langs), 3), np.inf)

    def calibrate(self, sums: dict[str, tuple[int, int, float, float]]) -> None:
        """Mean, deviation over documents and deviation of one character of each language's own cross-entropy, from
        the sums over its documents: documents, characters, nats, nats squared by characters."""
        measured = np.zeros((len(self.langs), 3))
        docs = np.array([sums.get(x, (0,))[0] for x in self.langs])
        for j in np.flatnonzero(docs):
            n, chars, nats, squares = sums[self.langs[j]]
            mean = nats / chars
            spread = max(0.0, squares - mean * nats)  # of (entropy - mean) squared by characters
            measured[j] = mean, np.sqrt(spread / chars), np.sqrt(spread / n)
        if docs.max() >= FEW:
            measured[docs < FEW] = np.maximum(measured[docs < FEW], measured[docs >= FEW].max(axis=0))
        else:
            measured[docs == 0] = np.inf
        self.calibration = measured

    def decide(self, have: np.ndarray, entropy: np.ndarray, chars: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether the document is rejected; ``have`` tells which have letters."""
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(len(best)), best]
        odds = np.exp(-(entropy - low[:, None]) * np.minimum(chars, EVIDENCE)[:, None])
        score = np.where(have, 1 / odds.sum(axis=1), 0.0)
        mean, wide, each = self.calibration[best].T
        limit = mean + MARGIN + SPREADS * np.sqrt(wide ** 2 + each ** 2 / np.maximum(1, chars))
        rejected = ~have | (low > limit)
        return [self.langs[b] if h else "und" for b, h in zip(best, have)], score, rejected


class KneserNey(Judge):
    """The models of all languages: for every order the sorted codes with natural-log probabilities per language, and
    sorted contexts with the log weight of falling back."""

    def __init__(self, langs: list[str], lang: np.ndarray, code: np.ndarray, n: np.ndarray):
        super().__init__(langs)
        self.grams, self.probs, self.contexts, self.weights = {}, {}, {}, {}
        count, of, wide = n.astype(float), lang, code
        tables = {ORDER: (of, wide, count)}
        for order in range(ORDER - 1, 0, -1):
            # continuation counts: in how many ways the shorter n-gram is extended to the left
            key, back = np.unique(np.stack([of.astype(np.uint64), wide & _MASK[order]]), axis=1, return_inverse=True)
            of, wide, count = key[0].astype(np.int64), key[1], np.bincount(back.ravel()).astype(float)
            tables[order] = (of, wide, count)
        size = max(2, len(np.unique(wide)) + 1)
        lower = np.full((1, len(langs)), 1.0 / size)
        self.floor = np.log(1.0 / size)
        for order in range(1, ORDER + 1):
            of, wide, count = tables[order]
            grams = np.unique(wide)
            context_of = wide >> np.uint64(16)
            contexts = np.unique(context_of)
            row, col = np.searchsorted(grams, wide), np.searchsorted(contexts, context_of)
            ones = np.bincount(of[count == 1], minlength=len(langs))
            twos = np.bincount(of[count == 2], minlength=len(langs))
            discount = np.clip(ones / np.maximum(1, ones + 2 * twos), 0.1, 0.9)
            total, kinds = np.zeros((len(contexts), len(langs))), np.zeros((len(contexts), len(langs)))
            np.add.at(total, (col, of), count)
            np.add.at(kinds, (col, of), 1.0)
            seen = total > 0
            weight = np.where(seen, discount * kinds / np.maximum(total, 1), 1.0)
            # probability of each n-gram any language has seen, for every language
            context_row = np.searchsorted(contexts, grams >> np.uint64(16))
            below = lower if order == 1 else lower[np.searchsorted(self.grams[order - 1], grams & _MASK[order - 1])]
            prob = weight[context_row] * below
            np.add.at(prob, (row, of), np.maximum(count - discount[of], 0) / total[col, of])
            self.grams[order], self.contexts[order] = grams, contexts
            self.probs[order], self.weights[order] = np.log(prob).astype(np.float32), np.log(weight).astype(np.float32)
            lower = prob

    def score(self, code: np.ndarray, order: int = ORDER) -> np.ndarray:
        """(n, languages) log probability of the last character of each n-gram."""
        if order == 0 or not len(self.grams[order]):
            return np.full((len(code), len(self.langs)), self.floor, np.float32)
        own = code & _MASK[order]
        at = np.minimum(np.searchsorted(self.grams[order], own), len(self.grams[order]) - 1)
        out = self.probs[order][at].copy()
        miss = np.flatnonzero(self.grams[order][at] != own)
        if len(miss):
            back = self.score(code[miss], order - 1)
            context = own[miss] >> np.uint64(16)
            c = np.minimum(np.searchsorted(self.contexts[order], context), len(self.contexts[order]) - 1)
            known = self.contexts[order][c] == context
            out[miss] = back + np.where(known[:, None], self.weights[order][c], 0)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(n, languages) cross-entropy per character, and the number of characters, of prepared texts."""
        sums, chars = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        for a, b in slices((len(t) for t in texts), 1 << 20):
            part = texts[a:b] if b > a + 1 else [texts[a][i:i + (1 << 20)] for i in range(0, max(1, len(texts[a])), 1 << 20)]
            code, owner = _codes(part)
            distinct, back = np.unique(code, return_inverse=True)
            scores = self.score(distinct)
            owner = owner if b > a + 1 else np.zeros_like(owner)
            for j in range(len(self.langs)):
                sums[a:b, j] -= np.bincount(owner, weights=scores[back, j], minlength=b - a)
            chars[a:b] += np.bincount(owner, minlength=b - a)
        return sums / np.maximum(1, chars)[:, None], chars

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether the document is rejected."""
        letters = [_letters(t or "") for t in texts]
        have = np.array([bool(x) for x in letters], bool)
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        return self.decide(have, *self.entropies(letters))


class TableModel(Judge):
    """The same models as tables: ``grams[k]`` (code, p) and ``contexts[k]`` (context, total, weight) with one value
    per language in each array. Only discounts, one number per language and order, come to the driver."""

    def __init__(self, counts: DataFrame, langs: list[str]):
        super().__init__(langs)
        spark, many = counts.sparkSession, len(langs)
        index = spark.createDataFrame(list(enumerate(langs)), "of int, lang string")
        tables = {ORDER: stored(counts.join(F.broadcast(index), "lang").select("of", "code", "n"), "kn-counts")}
        for order in range(ORDER - 1, 0, -1):
            shorter = F.col("code").bitwiseAND(F.lit(int(_MASK[order]))).alias("code")
            tables[order] = stored(tables[order + 1].select("of", shorter).groupBy("of", "code").agg(F.count("*").alias("n")), "kn-counts")
        size = max(2, tables[1].select("code").distinct().count() + 1)
        self.start = F.array_repeat(F.lit(1.0 / size), many)
        self.grams, self.contexts = {}, {}
        places = F.sequence(F.lit(0), F.lit(many - 1))
        for order in range(1, ORDER + 1):
            own = tables[order].withColumn("context", F.shiftrightunsigned("code", 16))
            discount = [0.1] * many
            for r in own.groupBy("of").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect():
                discount[r.of] = float(np.clip(r.ones / max(1, r.ones + 2 * r.twos), 0.1, 0.9))
            discounts = F.array(*[F.lit(d) for d in discount])
            # at most one entry per language in each list
            each = own.groupBy("context", "of").agg(F.sum("n").cast("double").alias("total"), F.count("*").alias("kinds"))
            by_context = each.groupBy("context").agg(F.map_from_entries(F.collect_list(F.struct(
                "of", F.struct("total", "kinds")))).alias("m"))
            self.contexts[order] = stored(by_context.select(
                "context", F.transform(places, lambda j: F.coalesce(F.col("m")[j]["total"], F.lit(0.0))).alias("total"),
                F.transform(places, lambda j: F.coalesce(F.get(discounts, j) * F.col("m")[j]["kinds"] / F.col("m")[j]["total"], F.lit(1.0)))
                .alias("weight")), "kn-contexts")
            grams = own.groupBy("code").agg(F.map_from_entries(F.collect_list(F.struct("of", "n"))).alias("m"))
            grams = grams.withColumn("context", F.shiftrightunsigned("code", 16)).join(self.contexts[order], "context")
            if order == 1:
                grams = grams.withColumn("below", self.start)
            else:
                grams = grams.withColumn("suffix", F.col("code").bitwiseAND(F.lit(int(_MASK[order - 1])))).join(
                    self.grams[order - 1].select(F.col("code").alias("suffix"), F.col("p").alias("below")), "suffix")
            self.grams[order] = stored(grams.select("code", F.transform(places, lambda j: F.get("weight", j) * F.get("below", j) + F.coalesce(
                F.try_divide(F.greatest(F.col("m")[j] - F.get(discounts, j), F.lit(0.0)), F.get("total", j)), F.lit(0.0))).alias("p")), "kn-grams")

    def scored(self, codes: DataFrame) -> DataFrame:
        """(code, p) of distinct codes: the stored probability, or that of the shorter n-gram times the context's weight."""
        at = codes.withColumn("p", self.start)
        for order in range(1, ORDER + 1):
            own = F.col("code") if order == ORDER else F.col("code").bitwiseAND(F.lit(int(_MASK[order])))
            at = at.withColumn("own", own).withColumn("context", F.shiftrightunsigned("own", 16))
            at = at.join(self.grams[order].select(F.col("code").alias("own"), F.col("p").alias("found")), "own", "left").join(
                self.contexts[order].select("context", "weight"), "context", "left")
            back = F.when(F.col("weight").isNull(), F.col("p")).otherwise(F.zip_with("p", "weight", lambda p, w: p * w))
            at = at.select("code", F.coalesce("found", back).alias("p"))
        return at

    def entropies(self, docs: DataFrame) -> DataFrame:
        """(row_no, chars, nats) of the rows of ``docs`` (row_no, text) that have letters, nats per language."""
        def grams(batches):
            for batch in batches:
                at, rows = 0, batch.column(0).to_numpy()
                for run in text_runs(batch.column(1)):
                    for row, text in zip(rows[at:at + len(run)], map(_letters, run)):
                        for i in range(0, len(text), 1 << 20):
                            code, n = np.unique(_codes([text[i:i + (1 << 20)]])[0], return_counts=True)
                            yield batch_of(GRAMS, [np.full(len(code), row), code.view(np.int64), n])
                    at += len(run)

        found = stored(docs.select("row_no", "text").mapInArrow(grams, GRAMS), "kn-documents")
        scored = stored(self.scored(found.select("code").distinct()), "kn-scored")
        sums = [F.sum(-F.col("n") * F.ln(F.get("p", F.lit(j)))) for j in range(len(self.langs))]
        return found.join(scored, "code").groupBy("row_no").agg(F.sum("n").alias("chars"), F.array(*sums).alias("nats"))

    def own_sums(self, docs: DataFrame) -> DataFrame:
        rows = numbered(docs.select("lang", "text"), "row_no")
        of = F.array_position(F.array(*[F.lit(x) for x in self.langs]), F.col("lang")).cast("int") - 1
        own = self.entropies(rows).join(rows.select("row_no", "lang"), "row_no").withColumn("nats", F.get("nats", of))
        return own.groupBy("lang").agg(F.count("*").alias("docs"), F.sum("chars").alias("chars"), F.sum("nats").alias("nats"),
                                       F.sum(F.col("nats") * F.col("nats") / F.col("chars")).alias("squares"))

    def identified(self, docs: DataFrame, names) -> DataFrame:
        kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
        row, chars, nats = (free_name(docs, n) for n in ("row_no", "chars", "nats"))
        schema = T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in zip(names, kinds)]])
        rows = numbered(docs, row)
        found = self.entropies(rows.select(F.col(row).alias("row_no"), "text"))
        found = found.select(F.col("row_no").alias(row), F.col("chars").alias(chars), F.col("nats").alias(nats))
        judge = Judge(self.langs)
        judge.calibration = self.calibration

        def work(batches):
            for batch in batches:
                *columns, n, sums = batch.columns[1:]
                have = n.is_valid().to_numpy(zero_copy_only=False)
                n = n.fill_null(0).to_numpy(zero_copy_only=False)
                entropy = np.zeros((len(n), len(judge.langs)))
                if have.any():
                    entropy[have] = np.array(sums.flatten()).reshape(-1, len(judge.langs)) / n[have][:, None]
                lang, score, rejected = judge.decide(have, entropy, n)
                yield batch_of(schema, [*columns, lang, score, pa.array(rejected)])

        joined = rows.join(found, row, "left")
        return map_arrow(joined.select(row, *[F.col(f"`{c}`") for c in docs.columns], chars, nats), work, schema)


GRAMS = T.StructType([T.StructField("row_no", T.LongType()), T.StructField("code", T.LongType()), T.StructField("n", T.LongType())])


def train(docs: DataFrame) -> KneserNey | TableModel:
    """The model of ``docs`` (doc_id, lang, text); rows with NULL lang take no part."""
    rows = docs.where("lang IS NOT NULL")
    counts = stored(ngram_counts(rows), "ngrams")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    if counts.select("code").distinct().count() * len(langs) > MOST_CELLS:
        model = TableModel(counts, langs)
        model.calibrate({r.lang: tuple(r)[1:] for r in model.own_sums(rows).collect()})
        return model
    table = counts.toArrow()  # at most MOST_CELLS rows of numbers
    index = {x: i for i, x in enumerate(langs)}
    of = np.array([index[x] for x in table["lang"].to_pylist()], np.int64)
    model = KneserNey(langs, of, table["code"].to_numpy().astype(np.int64).view(np.uint64), table["n"].to_numpy())
    if langs:
        model.calibrate({r.lang: tuple(r)[1:] for r in _own_sums(rows, model).collect()})  # one row per language
    return model


MEASURED = T.StructType([T.StructField("lang", T.StringType()), T.StructField("docs", T.LongType()),
                         T.StructField("chars", T.LongType()), T.StructField("nats", T.DoubleType()),
                         T.StructField("squares", T.DoubleType())])


def _own_sums(docs: DataFrame, model: KneserNey) -> DataFrame:
    """``MEASURED`` per language: sums over all its documents with letters, of the whole texts under its own model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        known = shared.value
        index = {x: i for i, x in enumerate(known.langs)}
        held = np.zeros((len(index), 4))
        for batch in batches:
            at, langs = 0, batch.column(0).to_pylist()
            for run in text_runs(batch.column(1)):
                pairs = [(index[x], t) for x, t in zip(langs[at:at + len(run)], map(_letters, run)) if t]
                at += len(run)
                of = np.array([j for j, _ in pairs], np.int64)
                entropy, chars = known.entropies([t for _, t in pairs])
                nats = entropy[np.arange(len(of)), of] * chars
                np.add.at(held, of, np.stack([np.ones(len(of)), chars, nats, nats ** 2 / np.maximum(1, chars)], axis=1))
        have = np.flatnonzero(held[:, 0])
        yield batch_of(MEASURED, [[known.langs[j] for j in have], *held[have, :2].astype(np.int64).T, *held[have, 2:].T])

    parts = docs.select("lang", "text").mapInArrow(measure, MEASURED)
    return parts.groupBy("lang").agg(*[F.sum(c).alias(c) for c in MEASURED.names[1:]])


def held_out(docs: DataFrame):
    """Whether a document is kept out of training."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def identified(docs: DataFrame, model: KneserNey | TableModel, names=("lang_pred", "score", "rejected")) -> DataFrame:
    """``docs`` with the predicted language, its score and whether the document is rejected, under ``names``."""
    if isinstance(model, TableModel):
        return model.identified(docs, names)
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in zip(names, kinds)]])
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        known = shared.value
        for batch in batches:
            parts = [known.predict(run) for run in text_runs(batch.column(at))] or [known.predict([])]
            yield batch_of(schema, [*batch.columns, [x for p in parts for x in p[0]], np.concatenate([p[1] for p in parts]),
                                    pa.array(np.concatenate([p[2] for p in parts]))])

    return map_arrow(docs, work, schema)


def train_on_fold(docs: DataFrame) -> KneserNey | TableModel:
    return train(docs.where(~held_out(docs)).select("doc_id", "lang", "text"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    names = [free_name(docs, n) for n in ("lang_pred", "score", "rejected")]
    marked = identified(docs, train_on_fold(docs), names)
    return marked.where(~F.col(names[2])).select(*[F.col(f"`{c}`") for c in docs.columns])

"""Toxicity by class-conditional Kneser-Ney models over the characters of words.

Two models, one of toxic and one of ordinary labelled texts, share all lower orders: the
highest order keeps a count for each class, and what it discounts is dealt by continuation counts of
both classes together. So an expression too rare to tell has the same probability in both (an n-gram that
neither class has takes the pooled value of the shared counts), and the
difference of the two log-likelihoods comes from what the classes really do differently; inflected
forms of an expression share its leading characters. The difference is normalised by length three times, over
the whole document, its worst passage and its worst phrase, and a logistic curve turns these into a score.

Counts are grouped sums over all labelled texts but the held-out fold and the curve's rows (copies of a text once), combined before each shuffle, and every
count is kept. What is broadcast is bounded: up to ``BROADCAST_GRAMS`` n-grams the tables go to the tasks whole;
beyond, each different word is scored once by joins of its n-grams with the stored tables, and the scores
meet the words of the texts in another join. Both ways give the same measures.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearscope.sources.storage import stored

#: Characters of the longest n-gram.
ORDER = 5
#: N-grams of all orders up to which the tables are broadcast (contexts come on top, no more than n-grams).
BROADCAST_GRAMS = 2 ** 21
#: Words of a passage and of a phrase.
PASSAGE, PHRASE = 50, 10
#: Labelled rows the logistic curve is fitted on at most; counts use all others outside the held-out fold.
CURVE_ROWS = 20_000
#: Folds of ``crc32(doc_id) mod 5``: 0 is held out, these are counted, without the curve's rows, which are of the last one.
FOLDS, HELD_OUT, COUNTED, CURVE = 5, 0, (1, 2, 3, 4), 4
#: Word scores that one worker keeps, and characters it looks at in one go.
CACHE_WORDS, CHUNK_CHARS = 300_000, 2_000_000
DISCOUNT = 0.75

_WORD = re.compile(r"[^\W\d_]+")
_START, _END = "\x02", "\x03"
#: Weight of the character k places before the last one in an n-gram's hash, modulo 2 ** 64.
_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, k, 2 ** 64)) for k in range(ORDER)]


def fold_of(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


# ---------------------------------------------------------------- counting

def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic) to partial (word, ordinary, toxic) counts."""
    def flush(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
        words = list(counts[0] | counts[1])
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in counts)],
            names=["word", "ordinary", "toxic"])

    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            counts[toxic].update(_WORD.findall(text.as_py().lower()))
            if len(counts[0]) + len(counts[1]) > CACHE_WORDS:
                yield flush(counts)
                counts = (Counter(), Counter())
    yield flush(counts)


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, fold): one row for each different labelled text outside the held-out fold.

    Of copies the smallest doc_id stands for all; they are toxic if one is. Rows without doc_id,
    text or label are no labelled texts; a doc_id that occurs repeatedly in ``labels`` is toxic if one row says so.
    """
    marks = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    marks = marks.filter(fold_of(F.col("doc_id")) != HELD_OUT)
    texts = docs.filter(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"))
    return texts.join(marks, "doc_id").groupBy("hash").agg(
        F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"),
    ).select("doc_id", "toxic", fold_of(F.col("doc_id")).alias("fold"))


@dataclass
class Model:
    """Sorted n-gram hashes with their numbers, an array for each order."""

    grams: list[np.ndarray]  # hashes by order 1..ORDER
    counts: list[np.ndarray]  # (n,) continuation counts, for the highest order (n, 2) counts
    contexts: list[np.ndarray]  # hashes by order 0..ORDER-1
    totals: list[np.ndarray]  # (n, 2): sum and types; for the highest order (n, 4): sum and types of both classes
    discount: tuple[float, float]
    alphabet: int

    def log_likelihoods(self, words: list[str]) -> np.ndarray:
        """(words, 2): ordinary and toxic log-likelihoods."""
        pad = _START * (ORDER - 1)
        joined = "".join(f"{pad}{w}{_END}" for w in words)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        hashes, levels = codes + np.uint64(1), []
        for order in range(1, ORDER + 1):
            if order > 1:
                hashes = hashes.copy()
                hashes[order - 1:] += (codes[:len(codes) - order + 1] + np.uint64(1)) * _POWERS[order - 1]
            levels.append(hashes)
        # everything follows from the longest n-gram: each different one is looked up once
        _, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        shared = np.full(len(at), 1.0 / self.alphabet)
        both = np.empty((len(at), 2))
        for order in range(1, ORDER + 1):
            context = np.zeros(len(at), np.uint64) if order == 1 else levels[order - 2][at - 1]
            count = _look_up(self.grams[order - 1], self.counts[order - 1], levels[order - 1][at])
            total = _look_up(self.contexts[order - 1], self.totals[order - 1], context)
            if order < ORDER:
                shared = _kneser_ney(count, total[:, 0], total[:, 1], DISCOUNT, shared)
            else:
                for c in (0, 1):
                    both[:, c] = _kneser_ney(count[:, c], total[:, 2 * c], total[:, 2 * c + 1], self.discount[c], shared)
                # what neither class has seen says nothing: the smaller class would leave it more room
                unseen = count.sum(1) == 0
                pooled = _kneser_ney(count[:, 0], total[:, 0] + total[:, 2], total[:, 1] + total[:, 3], DISCOUNT, shared)
                both[unseen] = pooled[unseen, None]
        both = np.log(both)[back]
        both[codes == ord(_START)] = 0.0  # the padding is given, not predicted
        starts = np.cumsum([0, *(len(w) + ORDER for w in words[:-1])])
        return np.add.reduceat(both, starts, axis=0)


def _kneser_ney(count, total, types, discount, lower):
    known = total > 0
    safe = np.where(known, total, 1.0)
    return np.where(known, np.maximum(count - discount, 0.0) / safe + discount * types / safe * lower, lower)


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros((len(wanted), *values.shape[1:]))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    found = values[at].astype(float)
    found[keys[at] != wanted] = 0.0
    return found


def _hash_grams(grams: list[str], order: int) -> np.ndarray:
    if not order:
        return np.zeros(len(grams), np.uint64)
    codes = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, order)
    hashes = np.zeros(len(grams), np.uint64)
    for k in range(order):
        hashes += (codes[:, order - 1 - k].astype(np.uint64) + np.uint64(1)) * _POWERS[k]
    return hashes


@dataclass
class Counts:
    """Stored counts of all n-grams, nothing left out."""

    top: DataFrame  # (gram, ordinary, toxic) of the highest order
    levels: list[DataFrame]  # (gram, n): continuation counts of the orders 1..ORDER-1
    discount: tuple[float, float]
    alphabet: int
    size: int  # n-grams of all orders

    def contexts(self, order: int) -> DataFrame:
        """Sums and types by context of the n-grams of ``order``."""
        if order == ORDER:
            return self.top.groupBy(_head("gram").alias("context")).agg(
                *(f(c).alias(n + c) for c in ("ordinary", "toxic")
                  for n, f in (("sum_", F.sum), ("types_", lambda c: F.count_if(F.col(c) > 0)))))
        return self.levels[order - 1].groupBy(_head("gram").alias("context")).agg(
            F.sum("n").alias("s"), F.count(F.lit(1)).alias("t"))

    def model(self) -> Model:
        """All tables in the driver's memory, for counts of at most ``BROADCAST_GRAMS``."""
        def load(df: DataFrame, order: int, key: str) -> tuple[np.ndarray, np.ndarray]:
            found = df.toPandas()
            hashes = _hash_grams(found[key].tolist(), order)
            at = np.argsort(hashes)
            return hashes[at], found.drop(columns=key).to_numpy(np.float64)[at]

        grams = [load(df, k + 1, "gram") for k, df in enumerate([*self.levels, self.top])]
        contexts = [load(self.contexts(k + 1), k, "context") for k in range(ORDER)]
        return Model(
            grams=[k for k, _ in grams], counts=[v[:, 0] for _, v in grams[:-1]] + [grams[-1][1]],
            contexts=[k for k, _ in contexts], totals=[v for _, v in contexts],
            discount=self.discount, alphabet=self.alphabet,
        )


def _tail(name: str) -> Column:
    return F.expr(f"substring({name}, 2)")


def _head(name: str) -> Column:
    return F.expr(f"left({name}, length({name}) - 1)")


def _grams_of(word: str) -> Column:
    """The longest n-grams of a word, one for each of its characters and its end."""
    padded = F.concat(F.lit(_START * (ORDER - 1)), word, F.lit(_END))
    return F.transform(F.sequence(F.lit(1), F.length(word) + 1), lambda i: F.substring(padded, i, F.lit(ORDER)))


def count_grams(docs: DataFrame, texts: DataFrame) -> Counts | None:
    """Counts of the ``COUNTED`` folds of ``texts``; None unless both classes occur."""
    # the folds are known without the labels, so the other texts needn't move; labels grow with the
    # texts, so they are never broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(
        F.col("text").isNotNull() & fold_of(F.col("doc_id").cast("long")).isin(*COUNTED))
    chosen = texts.filter(F.col("fold").isin(*COUNTED)).select("doc_id", "toxic")
    words = rows.join(chosen.hint("merge"), "doc_id").select("text", "toxic").mapInArrow(
        _count_words, "word string, ordinary long, toxic long")
    words = words.groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    top = stored(words.select(F.explode(_grams_of("word")).alias("gram"), "ordinary", "toxic").groupBy("gram").agg(
        F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")), "grams")
    sums = top.agg(F.sum("ordinary"), F.sum("toxic"), *(
        F.count_if(F.col(c) == n) for c in ("ordinary", "toxic") for n in (1, 2)), F.count(F.lit(1))).first()
    if not sums[0] or not sums[1]:
        return None
    # absolute discounting; bounded away from 1 so that single occurrences keep some weight
    discount = tuple(min(0.9, max(0.1, one / max(1, one + 2 * two))) for one, two in (sums[2:4], sums[4:6]))
    level, levels, size = top.select("gram"), [], sums[6]
    for _ in range(ORDER - 1):
        level = stored(level.groupBy(_tail("gram").alias("gram")).agg(F.count(F.lit(1)).alias("n")), "grams")
        levels.append(level)
        size += (last := level.count())
    return Counts(top, levels[::-1], discount, max(2, last), size)


def fit_models(docs: DataFrame, texts: DataFrame) -> Model | None:
    """Both models of ``count_grams`` in the driver's memory."""
    counts = count_grams(docs, texts)
    return counts and counts.model()


# ---------------------------------------------------------------- scoring

MEASURES = "struct<toxic_ll:double,ordinary_ll:double,whole:double,passage:double,phrase:double>"
_FEATURES = ["whole", "passage", "phrase"]


def _measure(likelihoods: np.ndarray) -> tuple[float, ...]:
    """Log-likelihoods a word, their difference over the whole text, and the largest over a passage and a phrase."""
    if not len(likelihoods):
        return 0.0, 0.0, 0.0, 0.0, 0.0
    ordinary, toxic = likelihoods.mean(0)
    sums = np.concatenate([[0.0], np.cumsum(likelihoods[:, 1] - likelihoods[:, 0])])
    worst = [float((sums[size:] - sums[:-size]).max()) / size for size in (min(n, len(likelihoods)) for n in (PASSAGE, PHRASE))]
    return toxic, ordinary, toxic - ordinary, *worst


def _as_structs(measured: list[tuple[float, ...]]) -> pa.StructArray:
    columns = np.array(measured, np.float64).reshape(-1, 5).T
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["toxic_ll", "ordinary_ll", *_FEATURES])


def measures(spark, model: Model):
    """Arrow UDF: text to ``MEASURES``. Distinct words are scored once and kept for later texts.

    Texts are taken out of a batch one by one, and pandas isn't loaded: workers stay, with what they have used, beside
    those of later steps.
    """
    shared = spark.sparkContext.broadcast(vars(model))

    @F.arrow_udf(MEASURES)
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, known, table = Model(**shared.value), {}, np.zeros((0, 2))
        for texts in batches:
            out, chunk, size = [], [], 0

            def close() -> None:
                nonlocal table
                new = list({w for words in chunk for w in words if w not in known})
                if new:
                    known.update(zip(new, range(len(table), len(table) + len(new))))
                    table = np.concatenate([table, model.log_likelihoods(new)])
                for words in chunk:
                    out.append(_measure(table[np.fromiter(map(known.__getitem__, words), np.int64, len(words))]))
                chunk.clear()
                if len(known) > CACHE_WORDS:
                    known.clear()
                    table = table[:0]

            for value in texts:
                text = value.as_py()
                words = _WORD.findall(text.lower()) if text else []
                chunk.append(words)
                size += len(words) * 8
                if size > CHUNK_CHARS:
                    close()
                    size = 0
            close()
            yield _as_structs(out)

    return measured


# ---------------------------------------------------------------- scoring by joins

def _smoothed(count: str | Column, total: str, types: str, discount: float, lower: Column) -> Column:
    """``_kneser_ney`` of columns; nulls are what a left join hasn't found."""
    count, total, types = (F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0)) for c in (count, total, types))
    return F.when(total > 0, F.greatest(count - discount, F.lit(0.0)) / total + discount * types / total * lower).otherwise(lower)


def word_scores(words: DataFrame, counts: Counts) -> DataFrame:
    """(word, ordinary, toxic): log-likelihoods of different ``words`` (word), joined by shuffle with all counts."""
    parts = words.select("word", F.explode(_grams_of("word")).alias("gram"))
    wanted = stored(parts.select("gram").distinct(), "wanted")
    first = counts.contexts(1).first()
    lower = None
    for order in range(1, ORDER):
        grams = wanted.select(F.expr(f"right(gram, {order})").alias("gram")).distinct().join(counts.levels[order - 1], "gram", "left")
        if order == 1:
            found = grams.withColumns({"s": F.lit(first["s"]), "t": F.lit(first["t"]), "lower": F.lit(1.0 / counts.alphabet)})
        else:
            found = grams.withColumn("context", _head("gram")).join(counts.contexts(order), "context", "left").withColumn(
                "rest", _tail("gram")).join(lower, "rest")
        lower = stored(found.select(F.col("gram").alias("rest"), _smoothed("n", "s", "t", DISCOUNT, F.col("lower")).alias("lower")), "shared")
    found = wanted.join(counts.top, "gram", "left").withColumn("context", _head("gram")).join(
        counts.contexts(ORDER), "context", "left").withColumn("rest", _tail("gram")).join(lower, "rest").withColumns({
            c: F.coalesce(c, F.lit(0)) for c in ("ordinary", "toxic", "sum_ordinary", "types_ordinary", "sum_toxic", "types_toxic")}).withColumns({
                "sum_": F.col("sum_ordinary") + F.col("sum_toxic"), "types_": F.col("types_ordinary") + F.col("types_toxic")})
    # what neither class has seen says nothing
    pooled = _smoothed(F.lit(0), "sum_", "types_", DISCOUNT, F.col("lower"))
    unseen = F.col("ordinary") + F.col("toxic") == 0
    scored = found.select("gram", *(F.log(F.when(unseen, pooled).otherwise(
        _smoothed(c, f"sum_{c}", f"types_{c}", d, F.col("lower")))).alias(c)
        for c, d in zip(("ordinary", "toxic"), counts.discount)))
    return parts.join(scored, "gram").groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, text) to (hash, word, at): the places of each different word of a text. Copies within a task are skipped."""
    seen: set[int] = set()

    def block() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.list_(pa.int32()))],
            names=["hash", "word", "at"])

    out: tuple[list, list, list] = ([], [], [])
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if key in seen:
                continue
            if len(seen) > CACHE_WORDS:
                seen.clear()
            seen.add(key)
            places: dict[str, list[int]] = {}
            for i, word in enumerate(_WORD.findall(text.as_py().lower())):
                places.setdefault(word, []).append(i)
            for word, at in places.items():
                out[0].append(key)
                out[1].append(word)
                out[2].append(at)
            if len(out[0]) > 20_000:
                yield block()
                out = ([], [], [])
    yield block()


def _measured_words(words: pa.Array) -> pa.Array:
    """Measures from the words' places and scores; a place that copies name twice has the same scores."""
    out = []
    for value in words:
        parts = value.as_py()
        counts = [len(p["at"]) for p in parts]
        at = np.concatenate([p["at"] for p in parts])
        likelihoods = np.empty((int(at.max()) + 1, 2))
        likelihoods[at] = np.repeat([[p["ordinary"], p["toxic"]] for p in parts], counts, axis=0)
        out.append(_measure(likelihoods))
    return _as_structs(out)


def text_measures(docs: DataFrame, counts: Counts) -> DataFrame:
    """(hash, m): ``MEASURES`` of each different text with words."""
    places = docs.filter(F.col("text").isNotNull()).select(F.xxhash64("text").alias("hash"), "text").mapInArrow(
        _places, "hash long, word string, at array<int>")
    scores = stored(word_scores(stored(places.select("word").distinct(), "vocabulary"), counts), "word_scores")
    return places.join(scores, "word").groupBy("hash").agg(
        F.collect_list(F.struct("at", "ordinary", "toxic")).alias("words")).select(
        "hash", F.arrow_udf(_measured_words, MEASURES)("words").alias("m"))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weights of a logistic curve (last one constant) by damped Newton steps with a small ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = ridge * len(x) * np.diag([*[1.0] * (x.shape[1] - 1), 0.0])

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, -(2 * y - 1) * (x @ w)).sum() + 0.5 * w @ penalty @ w)

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (p - y) + penalty @ w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w))
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame, curve_rows: int = CURVE_ROWS,
                   broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """``docs`` with held_out, score, predicted and the measures of ``MEASURES``.

    Every row is scored, repeated ones alike. Null and empty texts have all measures 0 and
    the curve's value there. A null doc_id is not held out. Without labelled texts of both classes
    nothing can be learnt and all scores are 0. Columns of ``docs`` with a result's name are replaced.
    """
    texts = stored(labelled_texts(docs, labels), "labelled")
    sample = stored(texts.filter(F.col("fold") == CURVE).orderBy(F.xxhash64("doc_id"), "doc_id").limit(curve_rows), "curve")
    counts = count_grams(docs, texts.join(F.broadcast(sample.select("doc_id")), "doc_id", "left_anti"))
    result = docs.withColumn("held_out", F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT, F.lit(False)))
    if counts is None:
        nothing = {n: F.lit(0.0) for n in ("score", "toxic_ll", "ordinary_ll", *_FEATURES)}
        return result.withColumns(nothing | {"predicted": F.lit(0)})
    if counts.size <= broadcast_grams:
        measured = measures(docs.sparkSession, counts.model())

        def with_measures(rows: DataFrame) -> DataFrame:
            return rows.withColumn("_m", measured("text"))
    else:
        by_text = stored(text_measures(docs, counts), "measures").select(F.col("hash").alias("_hash"), F.col("m").alias("_m"))
        zeros = F.struct(*(F.lit(0.0).alias(n) for n in ("toxic_ll", "ordinary_ll", *_FEATURES)))

        def with_measures(rows: DataFrame) -> DataFrame:
            return rows.join(by_text, F.xxhash64("text") == F.col("_hash"), "left").drop("_hash").withColumn(
                "_m", F.coalesce("_m", zeros))

    fitted = with_measures(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(sample.select("doc_id", "toxic")), "doc_id",  # at most curve_rows rows
    )).select("toxic", *(f"_m.{n}" for n in _FEATURES)).toPandas()
    x, y = fitted[_FEATURES].to_numpy(float), fitted["toxic"].to_numpy(float)
    if 0 < y.sum() < len(y):
        *weights, constant = fit_curve(x, y).tolist()
    else:  # too few labels for a curve: one nat a word in the worst passage is the border
        weights, constant = [0.0, 4.0, 0.0], -4.0
    z = F.lit(constant)
    for name, weight in zip(_FEATURES, weights):
        z = z + F.lit(weight) * F.col(f"_m.{name}")
    return with_measures(result).withColumn(
        "score", 1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), z))))
    ).withColumns({
        "predicted": (F.col("score") >= 0.5).cast("int"),
        **{n: F.col(f"_m.{n}") for n in ("toxic_ll", "ordinary_ll", *_FEATURES)},
    }).drop("_m")

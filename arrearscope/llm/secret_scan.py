"""Secrets: patterns of known kinds, and a battery of randomness tests for strings of no known kind.

A candidate is a long run of characters that encodings use. From its characters an encoding, and so
an alphabet, is inferred. Three tests ask whether it could be drawn uniformly from that alphabet: chi-squared on
the symbols, runs above and below the middle of the alphabet, and serial correlation of
neighbours. Random strings pass, but a short ordinary word may pass as well, so passing proves nothing. What is
put under false-discovery control (Benjamini-Hochberg) is the chance of an ordinary word of the same length to look as random in
the same battery: each of its three statistics has a second probability under ordinary letters (how often they
repeat, change between the halves of the alphabet, follow each other), and three times the least of the three, which holds
whatever they have to do with each other, is the candidate's figure. The control works apart for each encoding and length band: short
candidates are judged among short ones, where more ordinary words look random by chance.

The habits of ordinary words and the numbers of candidates by probability are
taken from all texts. What comes to the driver is some 30 sums and, for the thresholds, one row
a stratum. Built-in functions only; texts are never moved, as the thresholds are a map of at most
``len(ENCODINGS) * len(BANDS)`` entries that is part of the expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.llm.common import redacted, spans_text, with_matches
from arrearscope.sources.storage import stored

# Fixed patterns of the known kinds. Where a length is asked of a whole run, it is part of the pattern.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
#: Shortest value of an assignment, and shortest candidate of the tests.
LEAST_VALUE, LEAST_CANDIDATE = 12, 20
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+" % LEAST_CANDIDATE
KINDS = {"assign": (ASSIGN, 2), "access": (ACCESS, 0), "hex": (HEX, 0), "random": (CANDIDATE, 0)}
BASE = ("assign", "access", "hex")

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encoding: pattern of the whole candidate and alphabet, the first that fits counts. Digits alone encode nothing.
ENCODINGS = {
    "decimal": ("[0-9+/_-]+", _DIGITS),
    "hex": ("(?:[0-9a-f]+|[0-9A-F]+)", "0123456789abcdef"),
    "lower": ("[a-z]+", _LOWER),
    "upper": ("[A-Z]+", _UPPER),
    "base32": ("[A-Z2-7]+", _UPPER + "234567"),
    "base36": ("(?:[a-z0-9]+|[A-Z0-9]+)", _LOWER + _DIGITS),
    "letters": ("[A-Za-z]+", _UPPER + _LOWER),
    "base62": ("[A-Za-z0-9]+", _UPPER + _LOWER + _DIGITS),
    "base64": ("[A-Za-z0-9+/]+", _UPPER + _LOWER + _DIGITS + "+/"),
    "base64url": ("[A-Za-z0-9_-]+", _UPPER + _LOWER + _DIGITS + "-_"),
}
FOLDED = ("hex", "base36")
#: Lower ends of the length bands.
BANDS = (20, 24, 32, 48, 80)
#: Least probability under a uniform draw of a random candidate.
UNIFORM_LEVEL = 0.01
#: Accepted share of false discoveries in a stratum.
FALSE_SHARE = 0.05
_BINS_A_DECADE = 50


@dataclass(frozen=True)
class Habits:
    """Ordinary words: sums of squares and cubes of letter shares, share of neighbours in different halves of the alphabet,
    correlation of neighbours' places in it. The defaults are for corpora without long ordinary words."""

    squares: float = 0.0655
    cubes: float = 0.0054
    changes: float = 0.5
    serial: float = 0.0


def normal_tail(z: Column) -> Column:
    """Upper tail of the standard normal distribution (Abramowitz and Stegun 26.2.17), at least 1e-12."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return F.greatest(F.lit(1e-12), F.when(z >= 0, tail).otherwise(1 - tail))


def _encoding(token: Column) -> Column:
    chosen = F
    for name, (pattern, _) in ENCODINGS.items():
        fits = token.rlike(f"^{pattern}$")
        chosen = chosen.when(fits, name)
    return chosen.otherwise("mixed")


def _counts(token: Column, alphabet: Column) -> Column:
    """How often each symbol of the alphabet occurs."""
    return F.transform(F.split(alphabet, ""), lambda a: F.length(token) - F.length(F.replace(token, a, F.lit(""))))


def _sequence(s: Column) -> Column:
    """The battery's sums over the places ``x`` of symbols in an alphabet of ``a`` symbols."""
    def behind(values: Column) -> Column:
        return F.slice(values, 2, F.size(values))

    def before(values: Column) -> Column:
        return F.slice(values, 1, F.size(values) - 1)

    marked = _let(s, lambda s: F.struct(
        s["x"].alias("x"), (_total(s["x"]) / F.size(s["x"])).alias("mean"),
        F.transform(s["x"], lambda x: (x > (s["a"] / 2)).cast("int")).alias("high")))
    return _let(marked, lambda s: F.struct(
        _total(F.transform(s["high"], lambda h: h.cast("double"))).alias("above"),
        _total(F.zip_with(behind(s["high"]), before(s["high"]), lambda p, q: (p != q).cast("double"))).alias("changes"),
        _total(F.transform(s["x"], lambda x: (x - s["mean"]) * (x - s["mean"]))).alias("spread"),
        _total(F.zip_with(behind(s["x"]), before(s["x"]), lambda p, q: (p - s["mean"]) * (q - s["mean"]))).alias("products")))


def _places(token: Column, alphabet: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.instr(alphabet, c).cast("double"))


def tested(candidate: Column, habits: Habits) -> Column:
    """Struct of encoding, band, and two probabilities of the battery's results.

    ``uniform``: under a uniform draw from the encoding's alphabet; ``ordinary``: under ordinary words, case folded.
    """
    token = candidate["found"]
    alphabets = F.create_map(*(F.lit(x) for name, (_, a) in ENCODINGS.items() for x in (name, a)))
    named = F.struct(token.alias("token"), _encoding(token).alias("encoding"))
    # each step is a one-element transform, so that what it uses is computed once
    folded = _let(named, lambda s: F.struct(
        s["encoding"].alias("encoding"), F.coalesce(alphabets[s["encoding"]], F.lit(_UPPER + _LOWER + _DIGITS + "+/-_")).alias("alphabet"),
        F.when(s["encoding"].isin(*FOLDED), F.lower(s["token"])).otherwise(s["token"]).alias("token")))
    parts = _let(folded, lambda s: F.struct(
        s["encoding"].alias("encoding"), F.length(s["alphabet"]).cast("double").alias("a"), F.length(s["token"]).cast("double").alias("n"),
        _counts(s["token"], s["alphabet"]).alias("counts"), _counts(F.lower(s["token"]), F.lit(_LOWER + _DIGITS)).alias("folds"),
        _places(s["token"], s["alphabet"]).alias("x"), _places(F.lower(s["token"]), F.lit(_LOWER)).alias("folded")))
    sums = _let(parts, lambda s: F.struct(
        s["encoding"].alias("encoding"), s["a"].alias("a"), s["n"].alias("n"),
        _sequence(F.struct(s["a"].alias("a"), s["x"].alias("x"))).alias("own"),
        _sequence(F.struct(F.lit(float(len(_LOWER))).alias("a"), s["folded"].alias("x"))).alias("plain"),
        (_total(F.transform(s["counts"], lambda c: (c * c).cast("double"))) * s["a"] / s["n"] - s["n"]).alias("chi"),
        _total(F.transform(s["folds"], lambda c: (c * (c - 1)).cast("double"))).alias("repeats")))

    def verdict(s: Column) -> Column:
        n, a = s["n"], s["a"]
        chi = normal_tail((s["chi"] - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n))
        own, plain = s["own"], s["plain"]
        below = n - own["above"]
        expected = 2 * own["above"] * below / n + 1
        variance = (expected - 1) * (expected - 2) / (n - 1)
        runs = F.when(variance > 0, 2 * normal_tail(F.abs(own["changes"] + 1 - expected) / F.sqrt(variance))).otherwise(0.0)
        serial = F.when(own["spread"] > 0, 2 * normal_tail(F.abs(own["products"] / own["spread"] + 1 / n) * F.sqrt(n))).otherwise(0.0)
        # the same statistics among ordinary words, each towards what a uniform draw would give
        s2, s3 = habits.squares, habits.cubes
        mean, spread = n * (n - 1) * s2, F.sqrt(4 * n * (n - 1) * (n - 2) * max(0.0, s3 - s2 * s2) + 2 * n * (n - 1) * (s2 - s2 * s2))
        alternating = (n - 1) * habits.changes
        towards = 1 if habits.changes <= 0.5 else -1
        swaps = normal_tail(towards * (plain["changes"] - alternating) / F.sqrt(alternating * (1 - habits.changes) + 1e-9))
        away = 1 if habits.serial <= 0 else -1
        follows = F.when(plain["spread"] > 0, normal_tail(
            away * (plain["products"] / plain["spread"] - habits.serial) * F.sqrt(n))).otherwise(1.0)
        rare = F.least(normal_tail((mean - s["repeats"]) / spread), swaps, follows)
        band = F.lit(BANDS[0])
        for low in BANDS[1:]:
            band = F.when(n >= low, low).otherwise(band)
        return F.struct(
            s["encoding"].alias("encoding"), band.alias("band"), F.least(F.lit(1.0), 3 * F.least(chi, runs, serial)).alias("uniform"),
            F.least(F.lit(1.0), 3 * rare).alias("ordinary"))

    return _let(sums, verdict)


def _let(value: Column, then) -> Column:
    return F.transform(F.array(value), then)[0]


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _bin(probability: Column) -> Column:
    return F.floor(F.log10(probability) * _BINS_A_DECADE)


@dataclass(frozen=True)
class Control:
    """What all texts together say: habits of ordinary words, and the threshold of each stratum."""

    habits: Habits
    limits: dict[str, int]  # encoding:band to the greatest accepted bin of the ordinary probability


def found_in(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_base`` (spans of the known kinds) and ``_candidates`` (runs that overlap none of them)."""
    spotted = with_matches(docs.withColumn("_text", F.coalesce("text", F.lit(""))), "_text", KINDS, {"access": "AKIA"})
    assigned = F.filter("_assign", lambda s: F.length(s["part"]) >= LEAST_VALUE)
    based = spotted.withColumn("_base", F.concat(assigned, "_access", "_hex"))
    free = F.filter("_random", lambda c: ~F.exists("_base", lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"])))
    return based.withColumn("_candidates", free).drop("_text", *(f"_{k}" for k in KINDS))


def ordinary_habits(tokens: DataFrame) -> Habits:
    """Habits of the candidates ``found`` that are made of letters alone; the defaults where there are none.

    Each counts once whatever its length, so that a very long run of one letter doesn't speak for all. Means
    are taken in millionths: whole numbers sum up to the same in any order.
    """
    letters, size = F.lower("found"), F.length("found")
    sequence = _sequence(F.struct(F.lit(float(len(_LOWER))).alias("a"), _places(letters, F.lit(_LOWER)).alias("x")))
    each = tokens.filter(F.col("found").rlike("^[A-Za-z]+$")).select(
        _counts(letters, F.lit(_LOWER)).alias("counts"), sequence.alias("s"), size.alias("n"))
    numbers = [F.col("counts")[i] / F.col("n") for i in range(26)] + [
        F.col("s.changes") / (F.col("n") - 1), F.when(F.col("s.spread") > 0, F.col("s.products") / F.col("s.spread"))]
    whole = each.select(F.array(*(F.round(x * 1_000_000).cast("long") for x in numbers)).alias("m"))
    found = whole.agg(*(F.sum(F.col("m")[i]) for i in range(28)), F.count(F.lit(1)), F.count(F.col("m")[27])).first()
    *sums, words, varied = found
    if not words:
        return Habits()
    shares = [x / words / 1_000_000 for x in sums[:26]]
    return Habits(sum(p ** 2 for p in shares), sum(p ** 3 for p in shares), sums[26] / words / 1_000_000,
                  sums[27] / varied / 1_000_000 if varied else 0.0)


def fit_control(found: DataFrame) -> Control:
    """Habits and thresholds from all candidates. Strata without a discovery have no entry."""
    tokens = found.select(F.explode("_candidates.found").alias("found"))
    habits = ordinary_habits(tokens)
    judged = tokens.select(tested(F.struct("found"), habits).alias("t")).select(
        F.concat_ws(":", "t.encoding", "t.band").alias("stratum"), _bin(F.col("t.ordinary")).alias("bin"))
    counted = judged.groupBy("stratum", "bin").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("stratum").orderBy("bin")
    every = Window.partitionBy("stratum")
    ranked = counted.select("stratum", "bin", F.sum("n").over(upto).alias("rank"), F.sum("n").over(every).alias("all"))
    # Benjamini-Hochberg on the bins' upper ends
    passing = ranked.filter(F.pow(F.lit(10.0), (F.col("bin") + 1) / _BINS_A_DECADE) <= FALSE_SHARE * F.col("rank") / F.col("all"))
    limits = passing.groupBy("stratum").agg(F.max("bin").alias("bin")).collect()
    return Control(habits, {r["stratum"]: r["bin"] for r in limits})


def decided(found: DataFrame, control: Control) -> DataFrame:
    """``found`` with ``_spans``: the known kinds and the candidates that count as random."""
    limits = {k: v for k, v in control.limits.items() if not k.startswith("decimal:")}
    if not limits:
        return found.withColumn("_spans", F.col("_base"))
    border = F.create_map(*(x for k, v in sorted(limits.items()) for x in (F.lit(k), F.lit(v))))

    def random(c: Column) -> Column:
        return _let(tested(c, control.habits), lambda t: (t["uniform"] >= UNIFORM_LEVEL) & F.coalesce(
            _bin(t["ordinary"]) <= border[F.concat_ws(":", t["encoding"], t["band"])], F.lit(False)))

    return found.withColumn("_spans", F.concat("_base", F.filter("_candidates", random)))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of ``docs``.

    Null text is empty. Repeated rows are each returned, as are rows without doc_id. Without
    candidates there are no random spans. Only doc_id and text are read, so further columns can't clash.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stored(found_in(rows).drop("text"), "secrets")

    def number(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return decided(found, fit_control(found)).select(
        "doc_id", *(number(k) for k in BASE), F.sha2(spans_text(F.col("_base")), 256).alias("base_sha256"),
        spans_text(F.col("_spans")).alias("spans"))


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``<kind>``; null texts stay null, other columns as they are.

    Columns may have any names: the row travels in one struct.
    """
    found = found_in(docs.select("text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")))
    masked = F.when(F.size("_spans") > 0, redacted(F.col("text"), F.col("_spans"))).otherwise(F.col("text"))
    return decided(found, fit_control(found.select("_candidates"))).select(
        *(masked.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))

"""Secret scan: base spans against plain Python, behaviour of the randomness tests, masking."""

import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from arrearscope.llm import secret_scan
from tests.llm.span_rules import SECRETS, TRICKY, base_spans, expected

SCHEMA = "doc_id long, text string, score double, spans int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 0.5, i) for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark, small):
    return [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]


def test_base_spans_are_those_of_plain_python(spark, texts):
    every = TRICKY + texts
    rows = secret_scan.scan_secrets(frame(spark, every)).collect()
    assert len(rows) == len(every)
    for row in rows:
        numbers, digest, spans = expected(every[row.doc_id], SECRETS)
        assert [row.n_assign, row.n_access, row.n_hex] == numbers, every[row.doc_id]
        assert row.base_sha256 == digest
        assert [s for s in row.spans.split(",") if s and not s.startswith("random")] == spans


def test_random_strings_are_told_from_words(spark, texts):
    rng = random.Random(5)
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(signs) for _ in range(40)) for _ in range(60)]
    words = ["thelongordinarywordsofalanguagerepeattheletters" + "andandandthethe"[: i % 12] for i in range(60)]
    found = {r.doc_id: r.spans for r in secret_scan.scan_secrets(
        frame(spark, [f"see {k} here" for k in keys] + [f"see {w} here" for w in words])).collect()}
    caught = [found[i] == "random:4:44" for i in range(60)]
    assert sum(caught) >= 54
    assert not any("random" in found[i] for i in range(60, 120))


def test_masking_replaces_spans_and_nothing_else(spark):
    rows = secret_scan.mask_secrets(frame(spark, TRICKY)).collect()
    assert [r.score for r in rows] == [0.5] * len(TRICKY)
    for row in rows:
        text = TRICKY[row.doc_id]
        if text is None:
            assert row.text is None
            continue
        left, at = "", 0
        for start, _, kind, end in base_spans(text, SECRETS):
            if start >= at:
                left += text[at:start] + f"<{kind}>"
            at = max(at, end)
        assert row.text == left + text[at:]


def test_empty_and_repeated(spark):
    assert secret_scan.scan_secrets(frame(spark, [])).collect() == []
    twice = frame(spark, ["token=abcdefghijklmnop"]).union(frame(spark, ["token=abcdefghijklmnop"]))
    nameless = twice.selectExpr("cast(null as long) as doc_id", "text", "score", "spans")
    assert secret_scan.scan_secrets(twice.union(nameless)).count() == 4


# ---------------------------------------------------------------- the battery and its control

def tail(z):
    return max(1e-12, math.erfc(z / math.sqrt(2)) / 2)


def plain_sequence(places, size):
    n, mean = len(places), sum(places) / len(places)
    high = [x > size / 2 for x in places]
    return (sum(high), sum(p != q for p, q in zip(high, high[1:])), sum((x - mean) ** 2 for x in places),
            sum((p - mean) * (q - mean) for p, q in zip(places, places[1:])), n)


def plain_battery(token, habits):
    """(encoding, uniform, ordinary) by the textbook formulas."""
    name, alphabet = next(((k, a) for k, (p, a) in secret_scan.ENCODINGS.items() if re.fullmatch(p, token)),
                          ("mixed", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"))
    own = token.lower() if name in secret_scan.FOLDED else token
    n, a = len(token), len(alphabet)
    chi = sum((own.count(c) - n / a) ** 2 / (n / a) for c in alphabet)
    # symbols beside the alphabet (separators of numbers) are no cell of their own
    chi += sum(0 for c in own if c not in alphabet) if all(c in alphabet for c in own) else (
        sum(own.count(c) ** 2 for c in alphabet) * a / n - n) - chi
    above, changes, spread, products, _ = plain_sequence([alphabet.find(c) + 1 for c in own], a)
    expected = 2 * above * (n - above) / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    uniform = min(
        tail((chi - (a - 1)) / math.sqrt(2 * (a - 1) * (n - 1) / n)),
        2 * tail(abs(changes + 1 - expected) / math.sqrt(variance)) if variance > 0 else 0,
        2 * tail(abs(products / spread + 1 / n) * math.sqrt(n)) if spread > 0 else 0)
    low = token.lower()
    repeats = sum(low.count(c) * (low.count(c) - 1) for c in "abcdefghijklmnopqrstuvwxyz0123456789")
    _, changes, spread, products, _ = plain_sequence(["abcdefghijklmnopqrstuvwxyz".find(c) + 1 for c in low], 26)
    s2, s3 = habits.squares, habits.cubes
    deviation = math.sqrt(4 * n * (n - 1) * (n - 2) * (s3 - s2 ** 2) + 2 * n * (n - 1) * (s2 - s2 ** 2))
    usual = (n - 1) * habits.changes
    ordinary = min(
        tail((n * (n - 1) * s2 - repeats) / deviation),
        tail((1 if habits.changes <= 0.5 else -1) * (changes - usual) / math.sqrt(usual * (1 - habits.changes) + 1e-9)),
        tail((1 if habits.serial <= 0 else -1) * (products / spread - habits.serial) * math.sqrt(n)) if spread > 0 else 1)
    return name, min(1, 3 * uniform), min(1, 3 * ordinary)


def candidates():
    rng = random.Random(9)
    out = ["a" * 30, "ab" * 20, "thelongordinarywordsofalanguage", "0123456789" * 3, "2024-01-02/03_04+05-06",
           "x" * 20_000, "Zz9+" * 5000, "path/to-some_thing/ELSE+here"]
    for _, alphabet in secret_scan.ENCODINGS.values():
        out += ["".join(rng.choice(alphabet) for _ in range(n)) for n in (20, 25, 40, 90)]
    return out


@pytest.mark.parametrize("habits", [secret_scan.Habits(), secret_scan.Habits(0.07, 0.0061, 0.58, 0.1)])
def test_battery_is_that_of_the_formulas(spark, habits):
    tokens = candidates()
    rows = spark.createDataFrame([(t,) for t in tokens], "found string").select(
        "found", secret_scan.tested(F.struct("found"), habits).alias("t")).collect()
    assert {r.t.encoding for r in rows} >= set(secret_scan.ENCODINGS) - {"base32"}
    for r in rows:
        name, uniform, ordinary = plain_battery(r.found, habits)
        assert r.t.encoding == name and r.t.band == max(b for b in secret_scan.BANDS if b <= len(r.found))
        assert r.t.uniform == pytest.approx(uniform, abs=1e-6), r.found[:50]
        assert r.t.ordinary == pytest.approx(ordinary, abs=1e-6), r.found[:50]


def test_control_is_that_of_benjamini_and_hochberg(spark):
    rng = random.Random(10)
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    tokens = candidates() + ["".join(rng.choice(signs) for _ in range(rng.choice([22, 30, 60]))) for _ in range(200)]
    tokens += ["".join(rng.choice("eeeetttaaoinshrdlu") for _ in range(rng.choice([22, 30, 60]))).title() + "7" for _ in range(200)]
    found = secret_scan.found_in(frame(spark, [f"see {t} ." for t in tokens])).cache()
    control = secret_scan.fit_control(found)
    kept = found.select(F.explode("_candidates.found").alias("found"))
    letters = [r.found.lower() for r in kept.collect() if re.fullmatch("[A-Za-z]+", r.found)]
    shares = [sum(t.count(c) / len(t) for t in letters) / len(letters) for c in "abcdefghijklmnopqrstuvwxyz"]
    parts = [plain_sequence([ord(c) - 96 for c in t], 26) for t in letters]
    serial = [p[3] / p[2] for p in parts if p[2] > 0]
    want = (sum(p ** 2 for p in shares), sum(p ** 3 for p in shares), sum(p[1] / (p[4] - 1) for p in parts) / len(parts),
            sum(serial) / len(serial))
    assert (control.habits.squares, control.habits.cubes, control.habits.changes, control.habits.serial) == pytest.approx(want, abs=1e-5)
    strata = defaultdict(list)
    for r in kept.select(secret_scan.tested(F.struct("found"), control.habits).alias("t")).collect():
        strata[f"{r.t.encoding}:{r.t.band}"].append(math.floor(math.log10(r.t.ordinary) * 50))
    limits = {}
    for name, bins in strata.items():
        good = [b for b in bins if 10 ** ((b + 1) / 50) <= 0.05 * sum(c <= b for c in bins) / len(bins)]
        if good:
            limits[name] = max(good)
    assert control.limits == limits and limits


def test_columns_of_any_name_and_long_texts_are_masked(spark):
    names = ["_text", "_base", "_candidates", "_spans", "_assign", "_assign_found", "_access", "_hex", "_random", "row", "text_"]
    long = "word " * 40_000 + "token=abcdefghijklmnop " * 4000 + "é" * 100_000
    docs = spark.createDataFrame([(1, long), (2, None)], "doc_id long, text string").withColumns({c: F.lit(c) for c in names})
    rows = {r.doc_id: r for r in secret_scan.mask_secrets(docs).collect()}
    assert list(rows[1].asDict()) == docs.columns and all(rows[1][c] == c for c in names)
    assert rows[1].text == "word " * 40_000 + "<assign> " * 4000 + "é" * 100_000 and rows[2].text is None

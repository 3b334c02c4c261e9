"""Personal data: base spans against plain Python, disclosing terms against counting by hand."""

import math
import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from arrearscope.llm import personal_data as pd
from tests.llm.span_rules import PERSONAL, TRICKY, base_spans, digits, expected

SCHEMA = "doc_id long, text string, entity double, term int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 0.5, i) for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark, small):
    return [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]


def by_hand(texts):
    """Spans of disclosing terms by counting over Python sets."""
    words = re.compile(r"[^\W\d_]{3,}")
    whole = {t or "" for t in texts}
    n_term, n_entity, n_both, seen = defaultdict(int), defaultdict(set), defaultdict(set), defaultdict(set)
    for t in whole:
        for w in {m[0] for m in words.finditer(t.lower())}:
            n_term[w] += 1
        for start, _, kind, end in base_spans(t, PERSONAL):
            entity = (kind, t[start:end].lower() if kind == "email" else digits(t[start:end]))
            n_entity[entity].add(t)
            low, high = max(0, start - pd.CONTEXT), end + pd.CONTEXT
            for part, at in ((t[low:start], low), (t[end:high], end)):
                for m in words.finditer(part):
                    if at == low and low > 0 and m.start() == 0 or at == end and len(part) == pd.CONTEXT and m.end() == len(part):
                        continue
                    n_both[entity, m[0].lower()].add(t)
                    seen[t].add((entity, m[0].lower(), at + m.start(), at + m.end()))
    out = []
    for t in texts:
        base = base_spans(t, PERSONAL)
        found = {}
        for entity, term, start, end in seen[t or ""]:
            together, owners = len(n_both[entity, term]), len(n_entity[entity])
            if together < pd.LEAST_TOGETHER or owners == len(whole) or any(b[0] < end and start < b[3] for b in base):
                continue
            share = math.log(together * len(whole) / (n_term[term] * owners)) / math.log(len(whole) / owners)
            if share >= pd.GENERALISE:
                kind = "remove" if share >= pd.REMOVE or found.get((start, end)) == "remove" else "generalise"
                found[start, end] = kind
        every = base + [(s, 4 if k == "remove" else 5, k, e) for (s, e), k in found.items()]
        out.append(",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(every)))
    return out


STORY = [f"Write to anna.k@mail.org, the beekeeper of Quillhaven, about order {i}." for i in range(4)] + [
    f"The order {i} is for the town, write about it" for i in range(30)] + [
    "Quillhaven has a town", "call +49 30 1234567 or anna.k@mail.org beekeeper", "a beekeeper and a beekeeper"]


@pytest.mark.parametrize("extra", [[], STORY])
def test_spans_are_those_of_plain_python(spark, texts, extra):
    every = TRICKY + extra + (texts if not extra else [])
    want = by_hand(every)
    rows = pd.scan_personal_data(frame(spark, every)).collect()
    assert len(rows) == len(every)
    for row in rows:
        numbers, digest, spans = expected(every[row.doc_id], PERSONAL)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == numbers, every[row.doc_id]
        assert row.base_sha256 == digest
        assert row.spans == want[row.doc_id], every[row.doc_id]


def test_terms_that_give_the_entity_away_go(spark):
    found = pd.sanitise(frame(spark, STORY)).join(frame(spark, STORY).select("doc_id", "text"), "doc_id")
    first = found.filter("doc_id = 0").select(pd.sanitised_text(F.col("text"), F.col("spans")).alias("t")).first().t
    assert "anna" not in first and "Quillhaven" not in first and "about order 0" in first and "the " in first


def test_empty_and_repeated(spark):
    assert pd.scan_personal_data(frame(spark, [])).collect() == []
    one = frame(spark, ["mail a@b.cd to the clerk"])
    nameless = one.selectExpr("cast(null as long) as doc_id", "text", "entity", "term")
    rows = pd.scan_personal_data(one.union(one).union(nameless)).collect()
    assert [r.spans for r in rows] == ["email:5:11"] * 3


def test_terms_far_from_a_mention_count_and_go(spark):
    filler = "and so the long day went on by the mill " * 6
    told = [f"Write to anna.k@mail.org now {i}. {filler} Quillhaven {filler} Quillhaven" for i in range(4)]
    rows = pd.scan_personal_data(frame(spark, told + [f"{filler} number {i}" for i in range(30)])).collect()
    for r in rows:
        if r.doc_id < 4:
            starts = [m.start() for m in re.finditer("Quillhaven", told[r.doc_id])]
            assert all(f"remove:{s}:{s + 10}" in r.spans for s in starts) and len(starts) == 2
        else:
            assert r.spans == ""


def test_long_texts_full_of_flagged_words(spark):
    """Two texts of 20,000 words that all give the entity away: spans are those of plain Python, and soon."""
    letters = "abcdefghijklmnopqrst"
    words = ["".join(letters[i // 20**k % 20] for k in range(4)) for i in range(20_000)]
    long = [f"mail anna.k@mail.org {i} " + " ".join(words) for i in ("one", "two")]
    every = [*long, *(f"nothing of it {i}" for i in range(40))]
    began = time.time()
    rows = {r.doc_id: r.spans for r in pd.scan_personal_data(frame(spark, every)).collect()}
    assert time.time() - began < 60
    assert rows[0].count("remove") == 20_001 and rows[5] == ""
    for i in (0, 1):
        wanted = [f"remove:{m.start()}:{m.end()}" for m in re.finditer(r"[a-z]+", every[i]) if m.start() >= 25 or m[0] == "mail" and m.start() < 5]
        assert rows[i].split(",")[2:] == wanted[1:] and rows[i].startswith("remove:0:4,email:5:20,remove:")


def test_a_word_beside_and_inside_mentions(spark):
    """A term that stands in a mention only isn't one; with a place outside it is, and no span touches a base span."""
    every = [f"anna.k@mail.org {'anna' if i < 2 else 'other'} +49 30 1234567 x{i}" for i in range(4)] + [f"word {i}" for i in range(40)]
    want = by_hand(every)
    assert [r.spans for r in sorted(pd.scan_personal_data(frame(spark, every)).collect(), key=lambda r: r.doc_id)] == want

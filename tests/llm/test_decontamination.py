"""Template decontamination: exact passages, re-parameterised questions, inconsistent slots, clean texts."""

import re

import pytest

from arrearscope.llm import decontamination as dc

QUESTION = ("A farmer in the valley sells 3 crates of apples to Martin for 12 dollars and keeps 3 crates for the "
            "winter. How many dollars does Martin pay for each crate of apples?")
VARIANT = QUESTION.replace("3", "7").replace("12", "35").replace("Martin", "Sofia")
BROKEN = VARIANT.replace("keeps 7", "keeps 9")
OTHER = "The river flows past the old mill and on to the sea, where nobody counts crates of anything at all today."


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 1.5, "x") for i, t in enumerate(texts)], "doc_id long, text string, hash double, item_id string")


def bench(spark, texts):
    return spark.createDataFrame([(i, t, 2) for i, t in enumerate(texts)], "item_id long, text string, hash int")


@pytest.fixture(scope="module")
def found(spark):
    texts = [QUESTION, f"Intro words. {VARIANT} More words.", BROKEN, OTHER, None, "", f"\n{QUESTION.upper()}\n", QUESTION]
    rows = dc.find_contamination(frame(spark, texts), bench(spark, [QUESTION, "too short", None, ""])).collect()
    return {r.doc_id: r for r in rows}


def test_exact_and_changed_questions_are_found(found):
    assert found[0].changed == 0 and found[0].covered == found[0].n_tokens
    assert found[1].changed == 3  # both numbers and the name
    assert found[7].changed == 0
    assert set(found) <= {0, 1, 6, 7}


def test_inconsistent_values_and_other_texts_are_clean(found):
    assert 2 not in found and 3 not in found and 4 not in found and 5 not in found


def test_filter_keeps_clean_rows_and_all_columns(spark):
    docs = frame(spark, [QUESTION, OTHER, None, "", VARIANT, OTHER])
    left = dc.without_contaminated(docs, bench(spark, [QUESTION]))
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 5]


def test_whole_table_against_plain_search(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "benchmark"))

    def plain(text):
        return " ".join(re.findall(r"[^\W\d_]+", text.lower()))

    texts = {r.doc_id: plain(r.text) for r in docs.collect()}
    passages = {r.item_id: plain(r.text) for r in items.collect()}
    held = {(d, i) for d, t in texts.items() for i, p in passages.items() if p in t}
    got = {(r.doc_id, r.item_id) for r in dc.find_contamination(docs, items).collect()}
    assert held and got == held


def test_empty_tables(spark):
    none, items = frame(spark, []), bench(spark, [QUESTION])
    assert dc.find_contamination(none, items).collect() == []
    assert dc.find_contamination(frame(spark, [QUESTION]), bench(spark, [])).collect() == []
    assert dc.without_contaminated(frame(spark, [QUESTION]), bench(spark, [])).count() == 1


def holding(spark, texts, items):
    return {(r.doc_id, r.item_id) for r in dc.find_contamination(frame(spark, texts), bench(spark, items)).collect()}


def test_edited_copies_are_found(spark):
    words = [f"{a}{b}" for a in ("bal", "cor", "dim", "fen", "gul") for b in ("ta", "no", "ri", "su", "ke", "mo", "la", "pi", "du")][:43]
    broken = [("zz" + w if i in (10, 21, 32) else w) for i, w in enumerate(words)]
    inserted = words[:14] + ["xx", "yy"] + words[14:28] + ["xx"] + words[28:]
    names = QUESTION.replace("Martin", "Anna Maria")
    merged = "Someone buys 3 green apples and 4 yellow pears on the market and carries them home"
    texts = [" ".join(broken), " ".join(inserted), names, merged.replace("3", "5").replace("4", "5")]
    found = holding(spark, texts, [" ".join(words), QUESTION, merged])
    assert found == {(0, 0), (1, 0), (2, 1), (3, 2)}


def test_short_and_odd_items_are_found_verbatim(spark):
    items = ["What is 12 * 7 + 5?", "Which river runs through the old town", "Some Title With Names Only In It Here"]
    texts = [f"please say: {items[0]} thanks", "he asked, Which river runs through the old town, or so", "**which river runs through the OLD town**",
             f"see {items[2].lower()} there", "What is 12 * 8 + 5?", OTHER]
    assert holding(spark, texts, items) == {(0, 0), (1, 1), (2, 1), (3, 2)}


def test_word_table_stands_once_in_the_plan(spark):
    docs = spark.createDataFrame(
        [(1, "we ask how many pears a farmer with 12 trees and 3 dogs can sell in a week")], "doc_id long, text string")
    items = spark.createDataFrame([
        (1, "how many pears a farmer with 12 trees and 3 dogs can sell"), (2, "name the five rivers"),
        (3, "which of the six old towns")], "item_id long, text string")
    found = dc.alignments(docs, items)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # 65,536 bytes in hexadecimal digits, for all sizes of windows and both readings
    assert len(re.findall(r"[0-9a-fA-F]{100000,}", plan)) == 1
    assert {(r["item_id"], r["shift"]) for r in found.collect()} == {(1, 2)}


def test_words_are_made_once_and_mostly_without_patterns(spark):
    docs, items = frame(spark, [QUESTION, VARIANT]), bench(spark, [QUESTION])
    plan = dc.alignments(docs, items)._jdf.queryExecution().optimizedPlan().toString()
    # the marks before a token are taken off in one place, and only where it doesn't begin with an ASCII letter or digit
    assert plan.count("regexp_replace(") == 1 and "CASE WHEN" in plan[:plan.index("regexp_replace(")][-400:]


def test_slots_and_words_are_those_of_plain_patterns(spark):
    texts = ["3 kg, 4 Kg. 5 KG (6 km) -7% «Été 12 mm» Ärger „Über uns“ İstanbul ²³ x² ٣ kg 5 miles|Seven hours 2/3 lb [A `b` {c @D ~e ^F",
             "Z", "z9 Z9 Az aZ 9a 9 in in ß ẞ 'quoted Anna’s", "Ⅷ kg ½ kg .5 kg\nLine A.B.C. 3.kg 4\nkg"]
    tokens = spark.createDataFrame([(t,) for t in texts], "text string").select(dc.tokens_of(dc.F.col("text")).alias("t")).withColumn(
        "w", dc._plain(dc.F.col("t")))
    number, lead = r"[^\W_]", r"^[\W_]+"
    for row in tokens.withColumn("k", dc.templates_of(dc.F.col("t"), dc.F.col("w"))).collect():
        bare = [re.sub(lead, "", t) for t in row.t]
        assert row.w == [b.lower() for b in bare]
        numeric = [re.match(number, b) is not None and not b[0].isalpha() for b in bare]
        named = [i > 0 and len(t) > 1 and t[0].isupper() and t[0].isalpha() and t[1].islower() and t[1].isalpha() for i, t in enumerate(row.t)]
        assert row.k == ["<number>" if n else "<name>" if c else "<unit>" if i and numeric[i - 1] and w in dc.UNITS else w
                         for i, (n, c, w) in enumerate(zip(numeric, named, row.w))]

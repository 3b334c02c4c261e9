"""Toxicity, near duplicates, packing and the pipeline against plain versions."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from arrearscope.llm import near_duplicates as nd
from arrearscope.llm import packing, toxicity
from arrearscope.llm.common import components, union_find

SCHEMA = "doc_id long, text string, score double, row string, component_id int, root string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0.25, "x", 7, "y") for i, t in rows], SCHEMA)


# ---------------------------------------------------------------- near duplicates

def sets_of(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def by_pairs(rows):
    """Component of each row by comparing all pairs; rows without id or words stay alone."""
    sets = [sets_of(t) for _, t in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and rows[a][0] is not None
              and rows[b][0] is not None and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    roots = union_find(len(rows), linked)
    least = defaultdict(lambda: None)
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = i if least[r] is None else min(i, least[r])
    return [(len(s), least[r]) for s, r in zip(sets, roots)]


def edited(words, rng, n):
    out = list(words)
    for _ in range(n):
        out[int(rng.integers(len(out)))] = f"w{rng.integers(10 ** 6)}"
    return " ".join(out)


@pytest.mark.parametrize("settings", [nd.Settings(), nd.Settings(bucket_block=8, weight_block=20_000, broadcast_ids=0)])
def test_components_are_those_of_all_pairs(spark, settings):
    rng = np.random.default_rng(3)
    rows = [(None, "some words without any number at all"), (900, None), (901, ""), (902, " \t\n "), (903, "one two"), (904, "ONE  two"),
            (905, "x " * 30_000), (906, "X\t" * 29_000), (907, "İstanbul ÄÖ one two three"), (908, "i̇stanbul äö one two three")]
    for g in range(6):
        base = [f"b{g}x{k % 70}" for k in range(150)]
        rows += [(1000 * (g + 1) + k, edited(base, rng, k % 4)) for k in range(30)]
    rows += [(5, rows[40][1]), (4, rows[40][1])]
    found = {r.doc_id: r for r in nd.link_documents(frame(spark, rows), settings).collect()}
    assert len(found) == len(rows)
    for (i, _), (n, component) in zip(rows, by_pairs(rows)):
        assert (found[i].n_shingles, found[i].component_id) == (n, component), i
        assert found[i].kept == (i is not None and i == component)


def test_whole_table_against_all_pairs(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = {r.doc_id: r.component_id for r in nd.link_documents(docs).collect()}
    assert found == {i: c for (i, _), (_, c) in zip(rows, by_pairs(rows))}
    assert nd.link_documents(docs.limit(0)).collect() == []


def test_components_of_long_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1100)] + [(5000, 5001), (5001, 5000), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(201)} | {k: 1000 for k in range(1000, 1100)} | {5000: 5000, 5001: 5000}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---------------------------------------------------------------- packing

def test_packing_is_exact_and_tight(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    odd = [(10 ** 6, None), (10 ** 6 + 1, ""), (10 ** 6 + 2, "a<|endoftext|>b"), (10 ** 6 + 3, " " * 5000), (None, "no id"),
           (10 ** 6 + 4, "long text " * 4000), (10 ** 6 + 5, "twice"), (10 ** 6 + 5, "twice")]
    rows = [(r.doc_id, r.text) for r in docs] + odd
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids), 2048), len(ids)] if len(ids) > 2048 else [0, len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    got = packing.pack_documents(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= 1.02 * sum(r.length for r in got) / 2048 + 2
    assert packing.pack_documents(frame(spark, [])).collect() == []


def test_plans_cover_the_histogram():
    rng = np.random.default_rng(1)
    for counts in ({1: 1}, {2048: 5}, {1500: 10, 600: 10}, {1025: 7}, {int(n): int(c) for n, c in zip(
            rng.integers(1, 2048, 300), rng.integers(1, 5000, 300))}):
        planned = packing.plan(counts)
        packed = Counter()
        for config, k in planned:
            assert sum(n * times for n, times in config) <= 2048
            for n, times in config:
                packed[n] += times * k
        assert packed == counts
        number = sum(k for _, k in planned)
        plain = sum(k for _, k in packing.best_fit_decreasing(counts, 2048))
        assert sum(n * k for n, k in counts.items()) / 2048 <= number <= plain


# ---------------------------------------------------------------- toxicity

def labelled(spark, rng):
    common, bad = [f"word{k}" for k in range(300)], ["vilesort", "grubmuck"]
    rows, labels = [], []
    for i in range(400):
        words = [common[int(k)] for k in rng.integers(0, 300, 80)]
        if toxic := i % 4 == 0:
            for _ in range(4):
                words[int(rng.integers(80))] = bad[int(rng.integers(2))] + str(rng.choice(list("aeiou")))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic), 0.5))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int, score double")


def test_held_out_documents_are_told_apart(spark):
    rows, labels = labelled(spark, np.random.default_rng(2))
    odd = [(9000, None), (9001, ""), (9002, "123 456"), (None, "word1 word2"), (9003, "word1 " * 50_000 + "vilesorta " * 40), (9003, "word1")]
    found = toxicity.score_toxicity(frame(spark, rows + odd), labels).collect()
    assert len(found) == len(rows) + len(odd)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    held = [r for r in found if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.held_out for r in held) and len(held) > 50
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    by_id = {r.doc_id: r for r in found if r.doc_id != 9003}
    assert by_id[9000].score == by_id[9001].score == by_id[9002].score < 0.5 and by_id[None].held_out is False
    assert sorted(r.predicted for r in found if r.doc_id == 9003) == [0, 1]


def test_nothing_to_learn_from(spark):
    docs = frame(spark, [(1, "a b c"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score_toxicity(docs, none).collect()] == [0.0, 0.0]
    assert toxicity.score_toxicity(docs.limit(0), none).collect() == []
    ordinary = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.score_toxicity(docs, ordinary).count() == 2


def test_models_are_distributions_over_words(spark):
    rows = [(i, "ab ba abab b a aab"[: 3 + i % 16]) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    docs = frame(spark, rows)
    model = toxicity.fit_models(docs, toxicity.labelled_texts(docs, labels))
    total, words = np.zeros(2), [""]
    for _ in range(9):
        words = [w + c for w in words for c in "ab"]
        total += np.exp(model.log_likelihoods(words)).sum(0)
    # unseen n-grams take a pooled value, so the sum is one only about
    assert np.all(total > 0.8) and np.all(total <= 1.1)


def test_unseen_words_are_no_evidence(spark):
    rows, labels = labelled(spark, np.random.default_rng(4))
    docs = frame(spark, rows)
    model = toxicity.fit_models(docs, toxicity.labelled_texts(docs, labels))
    ordinary, toxic = model.log_likelihoods(["zzqqzz", "vilesortz", "word1"]).T
    assert abs(toxic[0] - ordinary[0]) < 1 and toxic[1] - ordinary[1] > 5 and abs(toxic[2] - ordinary[2]) < 2


def test_rare_grams_count_and_joins_give_the_same_measures(spark):
    rows, labels = labelled(spark, np.random.default_rng(5))
    # 1,600,000 n-grams of ordinary words: one occurrence is less than 2 ** -20 of them
    rows += [(5005, "word1 " * 270_000), (5007, "lonely word2")]
    rows += [(None, None), (6000, ""), (6001, "qqq vilesortz word2"), (6002, rows[3][1]), (6003, rows[3][1])]
    marks = labels.unionByName(spark.createDataFrame([(5005, 1, 0, 0.5), (5007, 1, 0, 0.5)], labels.schema))
    docs = frame(spark, rows)
    assert all(zlib.crc32(i) % 5 in toxicity.COUNTED for i in (b"5005", b"5007"))
    counts = toxicity.count_grams(docs, toxicity.labelled_texts(docs, marks))
    assert counts.top.filter(F.col("gram") == "\x02\x02\x02\x02l").first().ordinary == 1
    model = counts.model()
    assert toxicity._hash_grams(["\x02\x02\x02lo"], 5)[0] in model.grams[-1]
    words = ["zzqqzz", "vilesortz", "word1", "lonely", "x", "\u00e4\U00010400b"]
    joined = {r.word: (r.ordinary, r.toxic) for r in toxicity.word_scores(
        spark.createDataFrame([(w,) for w in words], "word string"), counts).collect()}
    assert np.allclose([joined[w] for w in words], model.log_likelihoods(words), rtol=1e-6)
    key = ["doc_id", "text", "predicted", "score", "toxic_ll", "ordinary_ll", "whole", "passage", "phrase"]
    first, second = (sorted(toxicity.score_toxicity(docs, marks, broadcast_grams=n).select(*key).collect(), key=lambda r: (
        r.doc_id is None, r.doc_id or 0)) for n in (toxicity.BROADCAST_GRAMS, 0))
    assert len(first) == len(rows) and [r[:3] for r in first] == [r[:3] for r in second]
    assert np.allclose([r[3:] for r in first], [r[3:] for r in second], rtol=1e-5, atol=1e-7)


def plain_log_likelihoods(word, counted):
    """Kneser-Ney by its definition; ``counted``: {word: (ordinary, toxic)}."""
    order, pad, end = toxicity.ORDER, toxicity._START * (toxicity.ORDER - 1), toxicity._END

    def grams(w):
        padded = pad + w + end
        return [padded[i:i + order] for i in range(len(w) + 1)]

    top = defaultdict(lambda: [0, 0])
    for w, ns in counted.items():
        for g in grams(w):
            for c in (0, 1):
                top[g][c] += ns[c]
    lower, longer = {}, set(top)
    for k in range(order - 1, 0, -1):
        lower[k] = Counter(g[1:] for g in longer)
        longer = set(lower[k])
    discounts = []
    for c in (0, 1):
        one, two = (sum(ns[c] == n for ns in top.values()) for n in (1, 2))
        discounts.append(min(0.9, max(0.1, one / max(1, one + 2 * two))))

    def smoothed(n, seen, discount, below):
        total, types = sum(seen), sum(x > 0 for x in seen)
        return max(n - discount, 0) / total + discount * types / total * below if total else below

    def shared(g):
        if not g:
            return 1 / max(2, len(lower[1]))
        counts = lower[len(g)]
        return smoothed(counts[g], [n for h, n in counts.items() if h[:-1] == g[:-1]], toxicity.DISCOUNT, shared(g[1:]))

    result = [0.0, 0.0]
    for g in grams(word):
        same = [ns for h, ns in top.items() if h[:-1] == g[:-1]]
        seen = top.get(g, [0, 0])
        for c in (0, 1):
            if any(seen):
                p = smoothed(seen[c], [ns[c] for ns in same], discounts[c], shared(g[1:]))
            else:
                # no class has it: both take the pooled value
                p = smoothed(0, [ns[k] for ns in same for k in (0, 1)], toxicity.DISCOUNT, shared(g[1:]))
            result[c] += float(np.log(p))
    return result


def test_scores_are_those_of_kneser_ney(spark):
    texts = {i: t for i, t in enumerate(["anna banana", "nab a ban", "ban the banner", "a an banana na", "tha the", "ä\U00010400b ban"] * 3)}
    folds = {i: zlib.crc32(str(i).encode()) % 5 for i in texts}
    texts = {i: f"{t} {'xyz'[i % 3] * (i % 4 + 1)}{i // 10 * 'q'}" for i, t in texts.items()}
    docs = frame(spark, list(texts.items()))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in texts], "doc_id long, toxic int")
    counts = toxicity.count_grams(docs, toxicity.labelled_texts(docs, labels))
    counted, seen = defaultdict(lambda: [0, 0]), {}
    for i, t in texts.items():
        if folds[i] in toxicity.COUNTED and folds[i] != toxicity.HELD_OUT:
            seen.setdefault(t, []).append(i)
    for t, ids in seen.items():
        for w in toxicity._WORD.findall(t.lower()):
            counted[w][int(any(i % 3 == 0 for i in ids))] += 1
    words = ["banana", "ban", "the", "nab", "xx", "never", "ä\U00010400b", "b", "bannerban"]
    want = np.array([plain_log_likelihoods(w, counted) for w in words])
    assert np.allclose(counts.model().log_likelihoods(words), want, rtol=1e-9)
    joined = {r.word: (r.ordinary, r.toxic) for r in toxicity.word_scores(
        spark.createDataFrame([(w,) for w in words], "word string"), counts).collect()}
    assert np.allclose([joined[w] for w in words], want, rtol=1e-9)


#: Names that the operators use inside.
CLASHING = ["hash", "gone", "row", "id", "told", "_gone", "_hash", "_text_hash", "_base", "_text", "_candidates", "_spans", "_assign", "_hex", "_toxic"]


@pytest.fixture(scope="module")
def stages(spark, small):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{small}/documents.parquet").withColumns({
        "score": F.when(F.col("doc_id") >= 0, 1.5), **{c: F.when(F.col("doc_id") >= 0, "h") for c in CLASHING}})
    docs = docs.unionByName(spark.createDataFrame(
        [(None, "Of the and the to of.", "en", "s", 3, 0.1, *CLASHING), (77_000, *[None] * (5 + len(CLASHING))),
         (77_001, "", "en", "s", 0, 0.1, *CLASHING)],
        docs.schema))
    found = [docs]
    for name, stage in cp.STAGES:
        found.append(cp.stored(stage(spark, found[-1], small), name))
    return found


def test_pipeline_stages(stages):
    for before, after in zip(stages[:-2], stages[1:-1]):
        assert after.columns == before.columns
        assert 0 < after.count() <= before.count()
    last = stages[-2]
    ids = {r.doc_id for r in last.select("doc_id").collect()}
    assert {None, 77_000, 77_001} <= ids
    kept = [(r.doc_id, r.text) for r in stages[2].select("doc_id", "text").collect()]
    assert all(i == c for (i, _), (_, c) in zip(kept, by_pairs(kept)))
    assert {r.doc_id for r in stages[-1].select("doc_id").distinct().collect()} == ids


def test_pipeline_masks_secrets(stages):
    assert stages[4].filter(F.col("text").rlike("AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}")).count() == 0
    assert stages[4].count() == stages[3].count()


def test_pipeline_links_from_80_percent(spark, small):
    import corpus_pipeline as cp

    base = [f"b{k}" for k in range(204)]
    near, far = list(base), list(base)
    near[50] = near[100] = near[150] = near[200] = "x"  # 181 of 219 shingles in common: 0.83
    for k in range(20, 180, 20):
        far[k] = "y"
    docs = frame(spark, [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (None, " ".join(base))])
    assert {r.doc_id for r in cp.drop_near_duplicates(spark, docs, small).collect()} == {1, 3, None}


def test_labels_outside_the_curve_sample_count(spark):
    docs = frame(spark, [(i, "plain words here" if i % 2 else "vilesort words here" + " again" * i) for i in range(40)])
    four = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == toxicity.CURVE]
    docs = docs.unionByName(frame(spark, [(i + 1000, "other") for i in range(5)])).withColumn("text", F.when(
        F.col("doc_id") == four[0], "onlyhere").otherwise(F.col("text")))
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(40)], "doc_id long, toxic int")
    counts = toxicity.count_grams(docs, toxicity.labelled_texts(docs, labels))
    assert counts.top.filter(F.col("gram") == "onlyh").count() == 1

"""Ranked search, vector codes and sequence files against plain versions."""

import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arrearscope.llm import ranked_search, sequence_files, vector_codes
from arrearscope.llm.token_pieces import Encoder
from arrearscope.sources.storage import stored

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, item int, score string, m int, terms string"
ITEMS = "item_id long, text string, doc_id int, block int"


def ranked(docs, items, top=10):
    """All scores by the definition."""
    told = [(d, TERM.findall(t.translate(UPPER)) if t else []) for d, t in docs]
    n_docs, total = sum(bool(t) for _, t in told), sum(len(t) for _, t in told)
    df = {}
    for _, terms in told:
        for t in set(terms):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for item_id, text in items:
        if text is not None:
            asked.setdefault(item_id, set()).update(TERM.findall(text.translate(UPPER)))
    out = set()
    for item_id, terms in asked.items():
        scores = []
        for doc_id, own in told:
            m = 10 + (90 * len(own) * n_docs) // total if total else 10
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * own.count(t) // (1000 * own.count(t) + 8 * m))
                for t in terms if t in df)
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0, doc_id))
        out |= {(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:top], 1)}
    return out


def test_ranked_search_equals_all_scores(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)] + ["Straße", "ÉTÉ", "x9"]
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 30)))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(200)]  # copies tie
    docs += [(3, docs[3][1]), (None, docs[3][1]), (2000, None), (2001, ""), (2002, "?!,."), (2003, "w1 " * 20_000)]
    items = [(i, " ".join(rng.choice(words, 6))) for i in range(30)] + [(7, "w5 w6"), (None, "w9"), (98, None), (99, "nothing here")]
    df = spark.createDataFrame([(d, t, 1, "", 2, "") for d, t in docs], DOCS).repartition(5)
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS)
    got = {tuple(r) for r in ranked_search.search_ranked(df, asked).collect()}
    assert got == ranked(docs, items)
    empty = df.limit(0)
    assert ranked_search.search_ranked(empty, asked).collect() == []
    assert ranked_search.search_ranked(df, asked.limit(0)).collect() == []


def test_ranked_search_in_blocks_is_the_same(spark, small, monkeypatch):
    docs, items = (spark.read.parquet(f"{small}/{name}.parquet") for name in ("documents", "benchmark"))
    whole = {tuple(r) for r in ranked_search.search_ranked(docs, items).collect()}
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 15)
    assert {tuple(r) for r in ranked_search.search_ranked(docs, items).collect()} == whole
    assert whole == ranked([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 300), st.integers(1, 12))
def test_no_document_is_above_the_bound_of_its_nodes(seed, rows, leaf):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 8, rows)
    terms = np.concatenate([np.sort(rng.choice(20, n, replace=False)) for n in sizes])
    vectors = ranked_search.Vectors(np.concatenate([[0], np.cumsum(sizes)]), terms, rng.integers(1, 10**6, sizes.sum()))
    weights = rng.integers(1, 20_000, 20)
    tree = ranked_search.BallTree(vectors, np.sqrt(weights.astype(float)), leaf)
    wanted = rng.choice(20, 5, replace=False)
    exact, query = np.zeros(20, np.int64), np.zeros(20)
    exact[wanted], query[wanted] = weights[wanted], tree.scale[wanted]
    scores = vectors.dot(exact)
    assert sorted(np.concatenate([n[5] for n in tree.nodes if n[4] is not None])) == list(range(rows))
    for node, (*_, under) in enumerate(tree.nodes):
        assert tree._bound(node, query) >= scores[under].max()
    best = ranked_search.TopRows(3)
    tree.search(wanted, weights[wanted], best, [[i] for i in range(rows)])
    assert sorted(s for _, s in best.rows()) == sorted(s for s in scores.tolist() if s > 0)[-3:]


def test_far_subtrees_are_not_scored():
    """Documents of two subjects: an item on one leaves the other's leaves alone."""
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(30, 8, replace=False)) + (0 if i % 2 else 30) for i in range(2_000)]
    vectors = ranked_search.Vectors(np.arange(0, 8 * 2_001, 8), np.concatenate(rows), rng.integers(9 * 10**5, 10**6, 16_000))
    tree = ranked_search.BallTree(vectors, np.ones(60), 20)
    leaves = sum(node[4] is not None for node in tree.nodes)
    scored = tree.search(np.arange(30, 38), np.ones(8, np.int64), ranked_search.TopRows(), [[i] for i in range(2_000)])
    assert scored <= 0.55 * leaves


VECTORS = "vec_id long, embedding array<float>, label int, whole string, code int, _label int"


def coded(rows, parts=8, entries=16, rounds=6):
    """The contract with plain loops; rows: (vec_id, vector, label)."""
    kept = [(v, [math.floor(4096 * float(np.float32(x))) for x in e], lab) for v, e, lab in rows
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    first = {}
    for v, e, _ in sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], r[1])):
        first.setdefault(v, e)
    first = [first[v] for v in sorted(first)[:entries]]
    width = len(first[0]) // parts
    cut = lambda e, p: e[p * width:(p + 1) * width]
    books = [[cut(e, p) for e in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest(p, part):
        return min((far(part, entry), i) for i, entry in enumerate(books[p]))

    for _ in range(rounds):
        found = [[nearest(p, cut(e, p))[1] for p in range(parts)] for _, e, _ in kept]
        for p in range(parts):
            for i in range(len(first)):
                own = [cut(e, p) for (_, e, _), f in zip(kept, found) if f[p] == i]
                if own:
                    books[p][i] = [sum(c) // len(own) for c in zip(*own)]
    out, totals = [], {}
    for v, e, lab in kept:
        best = [nearest(p, cut(e, p)) for p in range(parts)]
        error = sum(d for d, _ in best)
        totals[lab] = totals.get(lab, 0) + error
        out.append((v, "".join(f"{i:02x}" for _, i in best), error, lab))
    return sorted(((v, c, e, totals[lab]) for v, c, e, lab in out), key=repr), books


def test_codes_equal_plain_rounds(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(-3, 4, 16) / 7).tolist(), int(i % 3) if i % 5 else None) for i in range(300)]
    rows += [(5, rows[5][1], 1)] * 3 + [(None, rows[9][1], None), (-4, None, 1), (-3, [None] + [0.5] * 15, 1), (-2, [float("nan")] * 16, 2), (-1, [float("inf")] * 16, 0)]
    df = spark.createDataFrame([(v, e, lab, "", 0, 1) for v, e, lab in rows], VECTORS).repartition(3)
    found = vector_codes.compress(df).collect()
    wanted, books = coded(rows)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in found), key=repr) == wanted
    assert {r.codebooks_sha256 for r in found} == {vector_codes.fingerprint(np.array(books))}


def test_codes_of_few_odd_and_no_rows(spark):
    few = spark.createDataFrame([(1, [1e30] * 8, None, "", 0, 1), (2, [-0.1] * 8, None, "", 0, 1)], VECTORS)
    assert {(r.vec_id, r.code, r.error) for r in vector_codes.compress(few).collect()} == {(1, "00" * 8, 0), (2, "01" * 8, 0)}
    odd = few.unionByName(spark.createDataFrame([(0, [0.5] * 16, 1, "", 0, 1), (3, [], 1, "", 0, 1)], VECTORS))
    assert {(r.vec_id, r.code, r.error) for r in vector_codes.compress(odd).collect()} == {
        (0, "00" * 8, 0), (1, None, None), (2, None, None), (3, None, None)}
    assert {r.code for r in vector_codes.compress(few.select("vec_id", F.array_repeat(F.lit(0.5), 7).alias("embedding"), "label")).collect()} == {None}
    assert vector_codes.compress(few.limit(0)).collect() == []


def test_shared_prefixes_give_the_same_distances():
    rng = np.random.default_rng(3)
    parts = rng.integers(-2, 3, (5_000, 8))
    entries = rng.integers(-3, 4, (16, 8))
    found, place, counts = vector_codes.distinct_parts(parts)
    assert (found[place] == parts).all() and counts.sum() == 5_000 and [tuple(p) for p in found] == sorted(set(map(tuple, parts.tolist())))
    for leaves in (1, 7, 4_096):
        got = np.concatenate([d for _, d in vector_codes.walk(found, entries, leaves)])
        assert (got == ((found[:, None, :] - entries[None]) ** 2).sum(axis=2)).all()


def test_decoded_vectors_are_the_entries(spark, small):
    whole = stored(vector_codes.integer_vectors(spark.read.parquet(f"{small}/embeddings.parquet")), "vectors")
    books = vector_codes.train_codebooks(whole)
    coded_rows = whole.join(vector_codes.decode(spark, vector_codes.encode(whole, books), books).select("vec_id", "vector", "error"), "vec_id").collect()
    for row in coded_rows[:50]:
        assert ((np.array(row.whole) - np.array(row.vector) * 4096) ** 2).sum() == row.error


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def plain_ids(exact, text):
    return np.array(exact.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def test_files_give_the_ids_back(spark, tokenizer, tmp_path):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(tokenizer)
    docs = [(i * 3 % 101, f"text {i} " * (i % 17)) for i in range(101)] + [(None, "first"), (200, None), (201, ""), (202, "<|endoftext|> a"), (203, "long " * 30_000)]
    docs += [(50, "again")] * 40
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, hash string, row int").repartition(4)
    files = sequence_files.write_sequences(df, tokenizer, str(tmp_path / "files"), length=64)
    found = sorted((tuple(r) for r in sequence_files.read_documents(files).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == sorted((d for d, _ in docs), key=lambda d: (d is not None, d or 0))
    wanted = sorted((d if d is not None else -1, len(ids := plain_ids(exact, t)), zlib.crc32(ids.tobytes())) for d, t in docs)
    assert sorted((r[0] if r[0] is not None else -1, r[2], r[3]) for r in found) == wanted
    at = 0
    for r in found:
        assert r[1] == at
        at += r[2]
    sequences = sequence_files.read_sequences(files).collect()
    assert all(len(r.ids) == len(r.mask) == 64 for r in sequences) and sum(sum(r.mask) for r in sequences) == at
    assert sequence_files.tokenised_documents(df.limit(0)).collect() == []


@pytest.mark.parametrize("kind", [np.uint16, np.uint32])
def test_sequences_are_views(tmp_path, kind):
    writer = sequence_files.SequenceWriter(f"file://{tmp_path}", "one", length=8, batch=4, kind=kind)
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 50_000, n).astype(np.uint32) for n in (1, 8, 70, 3, 31)]
    for i, ids in enumerate(docs):
        writer.add(i, ids)
    writer.close()
    file = sequence_files.SequenceFile(*writer.paths)
    whole = np.concatenate(docs)
    assert len(file) == -(-len(whole) // 8)
    for i in (14, 0, 7, 3):
        view = file.ids(i)
        own = whole[8 * i:8 * i + 8]
        assert not view.flags.owndata and view.dtype == kind and (view[:len(own)] == own).all() and file.mask(i).to_pylist() == [True] * len(own) + [False] * (8 - len(own))
    for (doc_id, start, length), ids in zip(file.documents(), docs):
        assert (np.concatenate(list(file.run(start, length))) == ids).all()


def test_faster_encoder_equals_the_tokenizer_on_all_texts(spark, tokenizer):
    from tokenizers import Tokenizer

    exact, fast = Tokenizer.from_file(tokenizer), Encoder(tokenizer)
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").distinct().collect()]
    for start in range(0, len(texts), 500):
        some = texts[start:start + 500]
        for text, encoded in zip(some, exact.encode_batch(some, add_special_tokens=False)):
            assert fast.ids(text) == np.array(encoded.ids, "<u4").tobytes()

"""URL filter, revisits, shards and nearest neighbours against plain versions."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from arrearscope.llm import nearest_neighbours, sharding, url_filters, warc_revisits
from arrearscope.llm.queries import RULES, SQL
from arrearscope.llm.url_filters import Rule
from tests.oracle_check import compare, connect


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, name):
    assert compare(entry.queries()[name](spark, small), connect(small), SQL[name]) is None


# ---------------------------------------------------------------- url filter

def plain_verdict(url, rules, default="allow"):
    if url is None or "://" not in url:
        host, path = "", ""
    else:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[:min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.name), len(r.host), r.verdict == "block"), default=None)
    return host, path, best and best.name, best.verdict if best else default


URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.ORG/es/1?x#y", "http://example.org", "http://example.org?q", "http://a.example.org/en/1",
    "http://a.example.org/en/19/b", "http://a.example.org/en/2", "http://xexample.org/es/", "http://com/fr/", "http://com/fr", "http://b.com/de/x",
    "http://b.com/fr//de/", "http://b.com:80/de/", "ftp://u:p@b.com/de/", "http://b.com/de/" + "long/" * 20_000, "http://" + "a." * 10_000 + "com/de/q",
    "x://y://z.com/de/", "http://ÄÖ.com/de/", "http://b.com/de/\n", "http://.com/de/", "http://b.com./de/",
    "http://ab.cd/xyzw", "http://a.ef/uvw", "http://b.ef/uvw",
]


@pytest.mark.parametrize("most", [1, 2, 50_000])
def test_longest_rule_wins(spark, most):
    rules = [*RULES, Rule("block", "example.org", "/en/19"), Rule("allow", "a.example.org", "/en/1"), Rule("block", "b.com", "/fr/"),
             Rule("allow", "b.com", "/fr//de"), Rule("block", "b.com", "/fr//de"),
             # as many characters in all: the longer host counts
             Rule("allow", "ab.cd", "/x"), Rule("block", "cd", "/xyzw"), Rule("block", "ef", "/uvw"), Rule("allow", "a.ef", "/u")]
    pages = spark.createDataFrame([(i, u, "old", "x") for i, u in enumerate(URLS)], "page_id int, url string, host string, verdict string")
    rows = url_filters.judge_urls(spark, pages, rules, max_rules=most).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows} == {i: plain_verdict(u, rules) for i, u in enumerate(URLS)}


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id int, url string")
    assert url_filters.judge_urls(spark, pages, [], "block").first().verdict == "block"
    assert url_filters.judge_urls(spark, pages.limit(0), RULES).collect() == []


# ---------------------------------------------------------------- revisits

def plain_resolution(captures):
    out = {}
    for c in captures:
        if c["kind"] != "revisit":
            continue
        earlier = [r for r in captures if r["kind"] == "response" and r["canonical"] == c["canonical"] and c["canonical"] is not None
                   and None not in (r["captured"], c["captured"]) and (r["captured"], r["record_id"]) < (c["captured"], c["record_id"])]
        full = max(earlier, key=lambda r: (r["captured"], r["record_id"]), default=None)
        if full is None:
            out[c["record_id"]] = (None, "missing", None)
            continue
        checks = [strip(c[k]) == strip(full[k]) for k in ("etag", "last_modified", "digest") if c[k] is not None and full[k] is not None]
        state = "unverified" if not checks else "resolved" if all(checks) else "mismatch"
        heads = {**(full["headers"] or {}), **{k: v for k, v in (c["headers"] or {}).items() if k in warc_revisits.PERMITTED}}
        out[c["record_id"]] = (full["record_id"], state, heads if state == "resolved" else None)
    return out


def strip(value):
    return value.removeprefix("W/") if value else value


def test_revisits_of_a_hot_url(spark):
    rng = np.random.default_rng(8)
    captures = []
    for i in range(1500):
        url = "http://www.hot.org/a/?utm_source=x&b=1#top" if rng.random() < 0.6 else f"https://h{rng.integers(40)}.org:443/p"
        captures.append({
            "record_id": i, "url": None if i % 211 == 0 else url, "canonical": None if i % 211 == 0 else "hot.org/a?b=1" if "hot" in url else url[8:].replace(":443", ""),
            "captured": None if i % 307 == 0 else int(rng.integers(900)), "kind": ["response", "revisit", "revisit", "other"][int(rng.integers(4))],
            "etag": [None, '"a"', 'W/"a"', '"b"'][int(rng.integers(4))], "last_modified": [None, None, "Mon"][int(rng.integers(3))], "digest": None,
            "headers": None if i % 13 == 0 else {"date": str(i), "server": f"s{i}", "content-length": "5"}})
    schema = ("record_id long, url string, captured long, kind string, etag string, last_modified string, digest string, "
              "headers map<string,string>, part string, state int")
    frame = spark.createDataFrame([{k: v for k, v in c.items() if k != "canonical"} | {"part": "p", "state": 1} for c in captures], schema)
    rows = warc_revisits.resolve_revisits(frame).collect()
    want = plain_resolution(captures)
    assert {r.record_id: (r.refers_to, r.state, r.headers) for r in rows} == want
    assert {s for _, s, _ in want.values()} == {"missing", "unverified", "resolved", "mismatch"}
    assert warc_revisits.resolve_revisits(frame.limit(0)).collect() == []


# ---------------------------------------------------------------- shards

def best_capacity(sizes, shards):
    low, high = 0, sum(sizes)
    while low < high:
        middle, used, room = (low + high) // 2, 1, 0
        room = middle
        for s in sizes:
            if s > middle:
                used = shards + 1
                break
            if s > room:
                used, room = used + 1, middle
            room -= s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("n,hot", [(3000, 0), (500, 400), (5, 0), (40, 30)])
def test_largest_shard_is_as_small_as_can_be(spark, n, hot):
    rng = np.random.default_rng(n)
    rows = [(i, "x" * int(rng.integers(1, 400)) + f"ü{rng.integers(n)}") for i in range(n)] + [(10 ** 6 + i, "the hot text" * 5) for i in range(hot)]
    rows += [(None, None), (7, ""), (7, ""), (8, None)]
    docs = spark.createDataFrame([(i, t, "s", 5) for i, t in rows], "doc_id long, text string, shard string, slot int")
    found = sharding.shard_documents(docs).collect()
    assert len(found) == len(rows) and {r.law for r in found} == {"bytes"} and {r.grown_shard for r in found} == {None}
    by_text, shards, slots = defaultdict(set), defaultdict(int), defaultdict(list)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t or "")
    for r in found:
        shards[r.shard] += r.size
        slots[r.shard].append(r.slot)
        by_text[r.text_crc32, r.size].add(r.shard)
        assert (r.size, r.text_crc32) in {(len(t.encode()) + 1, zlib.crc32(t.encode())) for t in texts[r.doc_id]}
    assert all(len(s) == 1 for s in by_text.values()) and set(shards) <= set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    keyed = docs.select(sharding.text_key(F.coalesce("text", F.lit(""))).alias("key"), (F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("size"))
    sizes = [r[1] for r in keyed.groupBy("key").sum("size").orderBy("key").collect()]
    assert max(shards.values()) == best_capacity(sizes, 8)
    assert len(shards) == min(8, len(sizes))


def test_other_shards_are_near_equal_beside_an_oversized_text(spark):
    rng = np.random.default_rng(6)
    texts = [f"{i} " + "y" * int(rng.integers(40, 80)) for i in range(1030)]
    texts.append("z" * (sum(map(len, texts)) // 2))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes = defaultdict(int)
    for r in sharding.shard_documents(docs).collect():
        sizes[r.shard] += r.size
    assert sorted(sizes) == list(range(8)) and max(sizes.values()) == len(texts[-1]) + 1
    rest = sum(len(t) + 1 for t in texts[:-1])
    # the two sides of the large text share seven shards, at least one each
    keys = sorted((r.key, r.size) for r in docs.select(sharding.text_key(F.col("text")).alias("key"), (F.length("text") + 1).alias("size")).collect())
    left = sum(s for _, s in keys[:[s for _, s in keys].index(len(texts[-1]) + 1)])
    best = min(max(left / k, (rest - left) / (7 - k)) for k in range(1, 7))
    assert sorted(sizes.values())[-2] <= 1.05 * best


def test_even_cuts_keep_the_ceiling():
    rng = np.random.default_rng(7)
    for _ in range(300):
        n, shards = int(rng.integers(1, 40)), int(rng.integers(1, 9))
        sizes = [int(x) for x in rng.integers(1, 50, n)]
        if rng.random() < 0.5:
            sizes[int(rng.integers(n))] = 500
        frontier = sharding.Frontier([(i, 62, s, True) for i, s in enumerate(sizes)])
        capacity = frontier.bounds(shards)[0]
        assert capacity == best_capacity(sizes, shards)
        cuts = [0, *frontier.even_cuts(capacity, shards)]
        assert cuts[-1] == n and len(cuts) - 1 == min(n, shards)
        assert all(0 < sum(sizes[a:b]) <= capacity for a, b in zip(cuts, cuts[1:]))


def test_no_documents_no_shards(spark):
    assert sharding.shard_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# ---------------------------------------------------------------- nearest neighbours

def exact_neighbours(vectors, queries, nearest=10):
    out = {}
    for q in queries:
        scored = sorted((float(np.sqrt(((v - vectors[q]) ** 2).sum())), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
        out[q] = scored[:nearest]
    return out


@pytest.mark.parametrize("shard_nodes", [nearest_neighbours.SHARD_NODES, 500])
def test_recall_ties_and_unusable_vectors(spark, shard_nodes):
    rng = np.random.default_rng(11)
    vectors = {i: rng.normal(size=24).astype(np.float32).astype(float) for i in range(3000)}
    for i in range(3000, 3900):
        vectors[i] = vectors[100]  # one very common vector
    rows = [(i, [float(x) for x in v], "r", 1) for i, v in vectors.items()]
    rows += [(90_000, None, "r", 1), (90_100, [0.0] * 24, "r", 1), (90_200, [float("nan")] * 24, "r", 1), (90_300, [None] + [1.0] * 23, "r", 1),
             (90_400, [float("inf")] * 24, "r", 1), (None, [1.0] * 24, "r", 1), (90_500, [], "r", 1), (90_600, [1.0, 2.0], "r", 1), (200, rows[200][1], "r", 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string, shard int")
    found = defaultdict(list)
    for r in nearest_neighbours.search_nearest(frame, F.col("vec_id") % 100 == 0, shard_nodes=shard_nodes).orderBy(
            "query_id", "rank").collect():
        found[r.query_id].append((r.score, r.vec_id))
        assert r.rank == len(found[r.query_id])
    want = exact_neighbours(vectors, [i for i in vectors if i % 100 == 0])
    assert set(found) == set(want)
    hits = sum(len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    assert found[100] == want[100] and found[3500] == want[3500]
    assert all(scored == sorted(scored) for scored in found.values())
    assert nearest_neighbours.search_nearest(frame.limit(0), F.lit(True)).collect() == []


def test_graph_is_searched_in_insertion():
    """Every node is reached, no node is its own neighbour or has one twice, and one graph of all nodes finds the nearest."""
    x = np.random.default_rng(5).normal(size=(3000, 16))
    order, sizes = nearest_neighbours.Graph.order(len(x), seed=0)
    graph = nearest_neighbours.Graph.build(x[order], sizes)
    for links, size in zip(graph.links, sizes):
        assert links.shape[0] == size and links.max(initial=-1) < size
        for node, row in enumerate(links.tolist()):
            near = [j for j in row if j >= 0]
            assert node not in near and len(near) == len(set(near)) and near == row[:len(near)]
    hits = 0
    for q in np.random.default_rng(6).normal(size=(100, 16)):
        want = np.argsort(((graph.x - q) ** 2).sum(1), kind="stable")[:10]
        hits += len(set(want.tolist()) & set(graph.search(q[None])[0, :10].tolist()))
    assert hits >= 980
    lone = nearest_neighbours.Graph.build(x[:1], [1])
    assert lone.search(x[:2])[:, :2].tolist() == [[0, -1], [0, -1]]
    assert len(np.unique(graph.search(graph.x)[:, 0])) > 2990


def test_whole_table_recall(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    want = exact_neighbours(vectors, [i for i in vectors if i % 100 == 0])
    got = defaultdict(list)
    for r in entry.queries()["op7_nearest_neighbours"](spark, small).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))

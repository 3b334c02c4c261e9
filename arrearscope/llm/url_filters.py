"""URL filters: a trie over reversed host labels and path segments decides between allow and block entries.

The rules are the small side: at most ``MAX_RULES`` are put into one trie, which is broadcast
(its size is thereby bounded). A longer list is cut into several tries that are asked in one
pass each; the answers so far are written in between, so no rule is left out and no task holds
more than one trie. Each answer carries what it is ranked by, so the number of
tries can't change a verdict. Pages only lend their url column; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearscope.sources.storage import stored

#: Rules in one broadcast trie; about 100 bytes a rule and level.
MAX_RULES = 50_000
#: Keys beside the segments, which are strings: entries by partial segment, and the longest partial segment.
_ENTRY, _LONGEST = 0, 1
#: A match, in the order of precedence: characters of host and path, characters of the host, blocking before allowing.
HIT = "struct<size:int,host_size:int,block:boolean,rule:string,verdict:string>"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


def build_trie(rules: list[Rule]) -> dict:
    """Nested dicts: host labels from the right, then ``"/"``, then path segments.

    The last segment of a path is a prefix of the url's segment, so entries are kept at their
    parent node under ``_ENTRY`` as (partial segment, rule). Of two entries with the same host
    and path the blocking one counts.
    """
    root: dict = {}
    for rule in sorted(rules, key=lambda r: (r.name, r.verdict != "block")):
        node = root
        for label in reversed(rule.host.split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault("/", {})
        *whole, partial = rule.path.split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        node.setdefault(_ENTRY, {}).setdefault(partial, (rule.name, rule.verdict))
        node[_LONGEST] = max(node.get(_LONGEST, 0), len(partial))
    return root


def longest_match(trie: dict, host: str, path: str) -> tuple[int, int, bool, str, str] | None:
    """``HIT`` of the longest fitting entry: more characters of host and path; then the longer host."""
    best, best_key = None, (-1, -1)
    node, host_size = trie, 0
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        host_size += len(label) + 1
        below, used = node.get("/"), 0
        segments = path.split("/")
        for segment in segments:
            if below is None:
                break
            if entries := below.get(_ENTRY):
                for size in range(min(len(segment), below[_LONGEST]), -1, -1):
                    if entry := entries.get(segment[:size]):
                        key = (host_size - 1 + used + size, host_size - 1)
                        if key > best_key:
                            best, best_key = entry, key
                        break
            below, used = below.get(segment), used + len(segment) + 1
    return best and (*best_key, best[1] == "block", *best)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path up to ``?`` or ``#``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _matcher(spark: SparkSession, rules: list[Rule]):
    """Arrow UDF that asks one broadcast trie."""
    trie = spark.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf(HIT)
    def matched(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        root = trie.value
        for hosts, paths in batches:
            found = [longest_match(root, h, p) or (-1, -1, False, None, None) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(found, columns=["size", "host_size", "block", "rule", "verdict"])

    return matched


def judge_urls(
    spark: SparkSession, pages: DataFrame, rules: list[Rule], default: str = "allow", url: str = "url",
    max_rules: int = MAX_RULES,
) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    Null urls and urls without ``://`` have an empty host and path, match nothing and get
    ``default``; so does every url when there are no rules. Repeated pages are judged alike;
    an empty table gives an empty table. Columns of ``pages`` that are called like a result
    column are replaced. Of rules with as many characters of host and path the one with the longer
    host counts, then the blocking one.
    """
    host, path = host_and_path(F.col(url))
    hit = "_hit"
    while hit in pages.columns:
        hit += "_"
    judged = pages.withColumns({"host": host, "path": path})
    parts = [rules[at:at + max_rules] for at in range(0, len(rules), max_rules)]
    if not parts:
        return judged.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    for nth, part in enumerate(parts):
        answer = _matcher(spark, part)("host", "path")
        # all passes but the last are written, so that the next one's workers don't hold this trie too
        judged = judged.withColumn(hit, F.greatest(hit, answer) if nth else answer)
        if nth < len(parts) - 1:
            judged = stored(judged, "urls")
    return judged.withColumns({
        "rule": F.col(hit)["rule"], "verdict": F.coalesce(F.col(hit)["verdict"], F.lit(default)),
    }).drop(hit)

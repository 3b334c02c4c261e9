"""Personal data: patterns of known kinds, and terms around them that give the protected value away.

What the patterns find are protected entities. How much a term reveals of an entity is estimated
from co-occurrence in the corpus, as in C-sanitisation (Sanchez and Batet 2016): the pointwise mutual
information of term and entity, set against the information of the entity itself. A
term that occurs with the entity, and hardly anywhere else, reveals it; "the" reveals nothing. All words of a text
count as terms of each entity in it, and every occurrence of a term in a text with the
entity is generalised or removed when the revealed share exceeds the thresholds.

All counts are numbers of different texts (copies of a text are one witness, not many) and go over the
whole corpus: how often a term occurs at all is counted in all texts. Built-in functions only. Term
occurrences are cut down to terms that co-occur repeatedly with one entity before they are shuffled. Words are given places
only in texts with a flagged term, once a text, and all steps grow with the length of a text, not with its square.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.llm.common import redacted, spans_text, with_matches
from arrearscope.sources.storage import stored

# Fixed patterns of the known kinds. Lookbehinds and possessive runs only save vain attempts:
# a match can start nowhere inside a run but at its beginning or where the last match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = {"email": (EMAIL, 0), "ip": (IP, 0), "card": (CARD, 0), "phone": (PHONE, 0)}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
CARD_DIGITS, PHONE_DIGITS = (12, 19), (9, 15)
#: Characters on either side of a mention whose whole words are looked at: the whole text.
CONTEXT = sys.maxsize
TERM = r"\p{L}{3,}+"
#: Different texts a term must share with an entity: a single one is no estimate.
LEAST_TOGETHER = 2
#: Shares of an entity's information from which a term is generalised, and removed.
GENERALISE, REMOVE = 0.6, 0.9
#: Rows of a table that is broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000
_KIND_RANKS = {"remove": 4, "generalise": 5}


def _luhn(digits: Column) -> Column:
    """Whether the weighted digit sum is a multiple of ten."""
    signs = F.reverse(F.split(digits, ""))
    values = F.transform(signs, lambda d, i: (
        d.cast("int") * (1 + i % 2) - F.when((i % 2 == 1) & (d.cast("int") > 4), 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, b: (a + b).cast("int")) % 10 == 0


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def with_entities(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_base``: spans of the four kinds that pass their checks."""
    spotted = with_matches(docs.withColumn("_text", F.coalesce("text", F.lit(""))), "_text", KINDS,
                           {"email": "@", "ip": ".", "phone": "+"})
    four = rf"^{BYTE}(?:\.{BYTE}){{3}}$"
    return spotted.withColumn("_base", F.concat(
        "_email",
        F.filter("_ip", lambda s: s["found"].rlike(four)),
        F.filter("_card", lambda s: F.length(_digits(s["found"])).between(*CARD_DIGITS) & _luhn(_digits(s["found"]))),
        F.filter("_phone", lambda s: F.length(_digits(s["found"])).between(*PHONE_DIGITS)),
    )).drop("_text", *(f"_{k}" for k in KINDS))


def _mentions(told: DataFrame) -> DataFrame:
    """(hash, entity, inside): the entities of a text, with how often a term stands in mentions of each."""
    named = F.transform("_base", lambda s: F.struct(F.xxhash64(
        s["kind"], F.when(s["kind"] == "email", F.lower(s["found"])).otherwise(_digits(s["found"]))).alias("entity"), s["found"].alias("found")))
    words = told.select("hash", F.explode(named).alias("e")).select(
        "hash", "e.entity", F.explode_outer(_words(F.col("e.found"))).alias("term"))
    counted = words.groupBy("hash", "entity", "term").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return counted.groupBy("hash", "entity").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("term").isNotNull(), F.struct("term", "n")))).alias("inside"))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _small(df: DataFrame) -> DataFrame:
    """``df`` (stored) with a broadcast hint if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def disclosing_terms(texts: DataFrame, told: DataFrame, mentions: DataFrame) -> DataFrame:
    """(entity, term, kind) whose revealed share of the entity's information exceeds a threshold.

    ``texts``: (hash, text) of all documents; ``told``: of the different ones with entities. With N different texts, n(t), n(e)
    and n(t, e) of them holding the term, the entity and both (the term outside the entity's mentions), the share is
    log(n(t, e) N / (n(t) n(e))) / log(N / n(e)).
    """
    size = float(texts.select("hash").distinct().count())
    owners = stored(mentions.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")), "owners")
    # an entity of fewer texts shares fewer with any term
    several = stored(mentions.join(owners.filter(F.col("n_entity") >= LEAST_TOGETHER), "entity"), "several")
    words = told.join(several.select("hash"), "hash", "left_semi").select("hash", F.explode(_words(F.col("text"))).alias("term"))
    counted = words.groupBy("hash", "term").agg(F.count(F.lit(1)).alias("n"))
    outside = counted.join(several, "hash").filter(F.col("n") > F.coalesce(F.try_element_at("inside", F.col("term")), F.lit(0)))
    together = outside.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both")).filter(F.col("n_both") >= LEAST_TOGETHER)
    # a term occurs at least in the texts that have it with any entity: what can't reach the threshold even
    # so, as common words can't, needs no count over all texts
    around = told.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_around"))

    def share(n_term: str) -> Column:
        return F.log(F.col("n_both") * size / (F.col(n_term) * F.col("n_entity"))) / F.log(size / F.col("n_entity"))

    possible = stored(
        together.join(owners, "entity").filter(F.col("n_entity") < size).join(around, "term")
        .filter(share("n_around") >= GENERALISE), "together")
    wanted = _small(stored(possible.select("term").distinct().withColumn("number", F.monotonically_increasing_id()), "terms"))
    # a text's terms go as one list of numbers, in which its copies meet
    held = texts.select("hash", F.explode(F.array_distinct(_words(F.col("text")))).alias("term")).join(wanted, "term").groupBy("hash").agg(
        F.collect_set("number").alias("numbers"))
    spread = held.select(F.explode("numbers").alias("number")).groupBy("number").agg(F.count(F.lit(1)).alias("n_term")).join(wanted, "number")
    judged = possible.join(spread, "term").withColumn("share", share("n_term")).filter(F.col("share") >= GENERALISE)
    return judged.select("entity", "term", F.when(F.col("share") >= REMOVE, "remove").otherwise("generalise").alias("kind"))


def _added(told: DataFrame, mentions: DataFrame, flagged: DataFrame) -> DataFrame:
    """(hash, added): spans of the flagged terms of a text's entities, where they touch no base span.

    Every text is cut into words once. Words and base spans are put in order of their starts: a word is clear if no base span that
    begins before it ends after its start, and the next one begins at its end or later.
    """
    # a word that one entity has generalised and another removed is removed
    asked = stored(mentions.select("hash", "entity").join(flagged, "entity").groupBy("hash", "term").agg(F.max("kind").alias("kind")), "asked")
    texts = told.join(asked.select("hash"), "hash", "left_semi")
    # written before it is exploded, since the optimiser would have the array computed again for each element
    cut = stored(with_matches(texts.select("hash", "text"), "text", {"term": (TERM, 0)}).select("hash", "_term"), "words")
    words = cut.select("hash", F.explode("_term").alias("w")).select(
        "hash", F.lower("w.found").alias("term"), "w.start", "w.end")
    hits = words.join(asked, ["hash", "term"])
    base = texts.select("hash", F.explode("_base").alias("b")).select(
        "hash", F.lit(None).cast("string").alias("term"), "b.start", "b.end", F.lit(None).cast("string").alias("kind"))
    own = F.col("kind").isNull()
    # frames that begin with the first row are summed up as they go, in either direction
    earlier = Window.partitionBy("hash").orderBy("start", ~own).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("hash").orderBy(F.desc("start"), own).rowsBetween(Window.unboundedPreceding, -1)
    placed = hits.select("hash", "term", "start", "end", "kind").unionByName(base).withColumns({
        "before": F.max(F.when(own, F.col("end"))).over(earlier), "next": F.min(F.when(own, F.col("start"))).over(later)})
    clear = placed.filter(~own & (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end")))
    rank = F.when(F.col("kind") == "remove", _KIND_RANKS["remove"]).otherwise(_KIND_RANKS["generalise"])
    return clear.groupBy("hash").agg(F.collect_list(
        F.struct("start", rank.alias("rank"), "kind", "end", F.col("term").alias("found"), F.col("term").alias("part"))).alias("added"))


def sanitise(docs: DataFrame) -> DataFrame:
    """doc_id, base (spans of protected values) and spans (with the disclosing terms) of every row of ``docs``.

    Null text is empty. Repeated rows are each returned, and count once as witnesses; rows without doc_id
    are returned too. Without repeated co-occurrence there are no term spans. Only doc_id and text
    are read, so further columns can't clash. ``sanitised_text`` applies the spans. Texts are told apart by 128 bits of hash.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    hashed = rows.withColumn("hash", F.unhex(F.md5("text")))
    some = F.size("_base") > 0
    # texts without an entity are left behind
    found = stored(with_entities(hashed).select("doc_id", "hash", "_base", F.when(some, F.col("text")).alias("text")), "entities")
    told = stored(found.filter(some).select("hash", "text", "_base").dropDuplicates(["hash"]), "told")
    mentions = stored(_mentions(told), "mentions")
    flagged = _small(stored(disclosing_terms(hashed.select("hash", "text"), told, mentions), "flagged"))
    added = _added(told, mentions, flagged)
    none = F.array().cast(found.schema["_base"].dataType)
    plain = found.filter(~some).select("doc_id", F.col("_base").alias("base"), F.col("_base").alias("spans"))
    return found.filter(some).select("doc_id", "hash", "_base").join(added, "hash", "left").select(
        "doc_id", F.col("_base").alias("base"), F.concat("_base", F.coalesce("added", none)).alias("spans")).unionByName(plain)


def sanitised_text(text: Column, spans: Column) -> Column:
    """``text`` with protected values and generalised terms replaced by their kind, removed terms taken out."""
    return F.replace(redacted(text, spans), F.lit("<remove>"), F.lit(""))


def scan_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row; see ``sanitise``."""
    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return sanitise(docs).select(
        "doc_id", *(number(k) for k in KINDS), F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"))

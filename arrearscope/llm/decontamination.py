"""Benchmark decontamination by templates, so that a question with other numbers or names is still found.

Texts and benchmark items are cut into tokens; numbers, units after a number and names (capitalised words inside a
sentence) become typed slots, everything else stays as a lower-cased word. Windows of templates are
joined by hash, a run of names being one slot. Hits of a text and an item on one diagonal, or on neighbouring
diagonals where words were put in or left out, are one alignment, which covers the item's tokens under any of its
windows and whose slots must be consistent: the same value of the item always stands for the same value of
the text. "3 apples and 3 pears" may be "5 apples and 5 pears", but not "5 apples and 4 pears".

The plain lower-cased words are joined in the same way, so that copies of an item's own words are found
whatever their case, their place in a sentence or their number of slots.

A window of a text is hashed only if its first, middle and last token occur in the benchmark, by a bit table of its words and slots.
The table only saves work: what it lets through is joined by hash, and a benchmark that fills it changes no result.

The windows of the benchmark are the small side and are broadcast if their counted number allows it. Texts
are tokenised once for the join, and again only where windows hit, to read the slots. Copies of
a text are one text from the first hit on. Built-in functions only.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.sources.storage import stored

#: Tokens of a window; shorter items are one window, if they have at least ``LEAST_ITEM`` tokens.
WINDOW, LEAST_ITEM = 8, 4
#: Words (not slots) a window must have, in different forms.
LEAST_WORDS = 3
#: Distance of diagonals that are put together: words put in or left out between two windows.
NEIGHBOURS = 8
#: Share of an item's tokens that one alignment must cover.
LEAST_COVERED = 0.5
#: Entries of the table of the benchmark's words.
TABLE = 2**16
#: Windows of the benchmark, or texts with hits, that are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 300_000

# A token is a word or a number; a mark before it that ends a sentence or opens a line stays with it.
TOKEN = (r"(?:[.!?:;|\n\"“„(»«-][^\p{L}\p{N}]*+)?"
         r"(?:\p{L}[\p{L}\p{M}'’]*+|\p{N}++(?:[.,:/]\p{N}++)*+%?)")
_NUMBER = r"^[^\p{L}\p{N}]*+\p{N}"
_NAME = r"^\p{Lu}\p{Ll}"
_LEAD = r"^[^\p{L}\p{N}]++"
NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
#: Words that are units where they follow a number.
UNITS = (
    "mm cm m km in ft yd mi miles mile inches feet metres meters kilometres kilometers mg g kg lb lbs oz tons tonnes "
    "grams kilograms pounds ounces ml l litres liters gallons s sec min h hr hrs seconds minutes hours days weeks months "
    "years dollars euros cents usd eur percent degrees watts kw kwh volts amps hz mph kmh"
).split()


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _first_in(token: Column, *ranges: str) -> Column:
    """Whether the first byte is in one of the ASCII ranges, told by comparing bytes: a pattern's matcher costs many times that."""
    return reduce(or_, ((token >= r[0]) & (token < chr(ord(r[1]) + 1)) for r in ranges))


def _is_number(token: Column) -> Column:
    return F.when(_first_in(token, "AZ", "az"), False).when(_first_in(token, "09"), True).otherwise(token.rlike(_NUMBER))


def _is_name(token: Column) -> Column:
    return F.when(_first_in(token, "az", "09"), False).otherwise(token.rlike(_NAME))


def _plain(tokens: Column) -> Column:
    """Lower-cased words of an array of tokens, without the marks before them."""
    return F.transform(tokens, lambda t: F.lower(
        F.when(_first_in(t, "AZ", "az", "09"), t).otherwise(F.regexp_replace(t, _LEAD, ""))))


def templates_of(tokens: Column, words: Column) -> Column:
    """Typed slots and lower-cased words of an array of tokens; ``words`` are its ``_plain`` ones."""
    def typed(token: Column, i: Column) -> Column:
        word = F.get(words, i)
        follows = (i > 0) & F.coalesce(_is_number(F.get(tokens, i - 1)), F.lit(False))
        return F.when(_is_number(token), NUMBER).when((i > 0) & _is_name(token), NAME).when(
            follows & word.isin(UNITS), UNIT).otherwise(word)

    return F.transform(tokens, typed)


def _kept(template: Column) -> Column:
    """Positions of a template without those of a name that follows a name."""
    return F.filter(F.sequence(F.lit(0), F.size(template) - 1), lambda i: (i >= 0) & (i < F.size(template)) & ~(
        (F.get(template, i) == NAME) & F.coalesce(F.get(template, i - 1) == NAME, F.lit(False))))


def _collapsed(template: Column) -> Column:
    """``template`` with a run of names as one slot."""
    return F.filter(template, lambda t, i: ~((t == NAME) & F.coalesce(F.get(template, i - 1) == NAME, F.lit(False))))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda t: F.xxhash64(t))


def _known(hashes: Column, table: Column) -> Column:
    """For each hashed token whether the table has it."""
    return F.transform(hashes, lambda h: F.substring(table, (F.pmod(h, F.lit(TABLE)) + 1).cast("int"), F.lit(1)) == F.lit(bytearray([1])))


def _windows(hashes: Column, size: int, known: Column, before: Column) -> Column:
    """(at, window): places and hashes of the windows of ``size`` hashed tokens that pass the table, none where there are fewer.

    ``known`` says it of the tokens from its place ``before`` on.
    """
    def passes(i: Column) -> Column:
        return F.get(known, before + i)

    starts = F.filter(
        F.sequence(F.lit(0), F.size(hashes) - size), lambda i: passes(i) & passes(i + size - 1) & passes(i + size // 2))
    return F.when(F.size(hashes) >= size, F.transform(starts, lambda i: F.struct(
        i.alias("at"), F.xxhash64(F.slice(hashes, i + 1, size)).alias("window")))).otherwise(F.array().cast("array<struct<at:int,window:long>>"))


def _told(items: DataFrame) -> DataFrame:
    return items.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), tokens_of(F.col("text")).alias("own"))


def benchmark_windows(items: DataFrame) -> DataFrame:
    """(item_id, plain, n_tokens, size, at, hash) of the windows; ``size`` is that of the item's windows.

    ``plain`` windows are of lower-cased words, the others informative ones of templates, with both readings
    of a first token that is a capitalised word. Items without an id or text, or with fewer than ``LEAST_ITEM``
    tokens, have none.
    """
    told = _told(items).filter(F.size("own") >= LEAST_ITEM).withColumn("words", _plain(F.col("own"))).withColumn(
        "template", templates_of(F.col("own"), F.col("words")))
    words = told.select("item_id", F.lit(True).alias("plain"), "own", "words")
    slots = told.select("item_id", F.lit(False).alias("plain"), F.transform(
        _kept(F.col("template")), lambda i: F.get("own", i)).alias("own"), _collapsed(F.col("template")).alias("words"))
    sized = words.unionByName(slots).withColumn("n_tokens", F.size("words")).withColumn("size", F.least(F.col("n_tokens"), F.lit(WINDOW)))
    starts = F.posexplode(F.transform(
        F.sequence(F.lit(1), F.col("n_tokens") - F.col("size") + 1),
        lambda i: F.struct(F.slice("words", i, F.col("size")).alias("words"), F.element_at("own", i).alias("first"))))
    cut = sized.select("item_id", "plain", "n_tokens", "size", starts.alias("at", "w")).select(
        "item_id", "plain", "n_tokens", "size", "at", F.col("w.words").alias("window"),
        F.regexp_replace(F.col("w.first"), _LEAD, "").alias("first"))
    rest = F.slice("window", 2, F.greatest(F.col("size") - 1, F.lit(0)))
    readings = F.when(~F.col("plain") & F.col("first").rlike(_NAME), F.array_distinct(F.array(
        "window", F.concat(F.array(F.lit(NAME)), rest), F.concat(F.array(F.lower("first")), rest)))).otherwise(F.array("window"))
    read = cut.select("item_id", "plain", "n_tokens", "size", "at", F.explode(readings).alias("window"))
    distinct = F.size(F.array_distinct(F.filter("window", lambda t: ~t.startswith("<"))))
    return read.filter(F.col("plain") | (distinct >= LEAST_WORDS)).select(
        "item_id", "plain", "n_tokens", "size", "at", F.xxhash64(_hashes(F.col("window"))).alias("hash"))


def _word_table(items: DataFrame) -> Column:
    """``TABLE`` bytes, 1 where a word or slot of ``items`` has its hash; as long whatever the size of the benchmark."""
    own = F.concat("words", templates_of(F.col("own"), F.col("words")), F.array(F.lit(NAME)))
    place = F.pmod(F.xxhash64("word"), F.lit(TABLE)).alias("place")
    told = _told(items).withColumn("words", _plain(F.col("own")))
    filled = {row["place"] for row in told.select(F.explode(own).alias("word")).select(place).distinct().collect()}
    return F.lit(bytearray(i in filled for i in range(TABLE)))


def _broadcast_if_small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def alignments(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(hash, item_id, plain, n_tokens, size, shift, at) of texts and items that share windows.

    ``hash`` stands for the text, ``at`` is a list of the windows' places in the item. ``shift`` is the distance of text and item positions.
    """
    windows = stored(benchmark_windows(items), "windows")
    sizes = [r["size"] for r in windows.select("size").distinct().collect()]  # at most WINDOW
    tokens = docs.filter(F.col("text").isNotNull()).select(
        F.xxhash64("text").alias("hash"), tokens_of(F.col("text")).alias("tokens"))
    # one pass over the tokens makes the words of both readings; not called words, which inside a lambda would mean their hashes
    texts = tokens.withColumn("lower", _plain(F.col("tokens"))).select(
        "hash", _hashes(F.col("lower")).alias("words"), templates_of(F.col("tokens"), F.col("lower")).alias("template")).select(
        "hash", "words", _hashes(_collapsed(F.col("template"))).alias("slots"))
    none = F.array().cast("array<struct<plain:boolean,size:int,at:int,window:long>>")
    # the table stands once in the plan: the driver writes plans out, with all of its bytes, for every change of one
    texts = texts.withColumn("known", _known(F.concat("words", "slots"), _word_table(items)))
    every = F.concat(none, *(F.transform(
        _windows(F.col(name), size, F.col("known"), before), lambda w: F.struct(
            F.lit(name == "words").alias("plain"), F.lit(size).alias("size"), w["at"].alias("at"), w["window"].alias("window")))
        for size in sizes for name, before in (("words", F.lit(0)), ("slots", F.size("words")))))
    told = texts.select("hash", F.explode(every).alias("w")).select(
        "hash", "w.plain", "w.size", F.col("w.at").alias("d_at"), F.col("w.window").alias("window"))
    hits = told.join(_broadcast_if_small(windows.withColumnRenamed("hash", "window")), ["window", "plain", "size"])
    # a text's copies give the same hits: each place once
    return hits.groupBy("hash", "item_id", "plain", "n_tokens", "size", (F.col("d_at") - F.col("at")).alias("shift")).agg(
        F.collect_set("at").alias("at"))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(hash, item_id, covered, n_tokens, n_slots, changed) of texts that hold an item or its template, consistently."""
    aligned = stored(alignments(docs, items), "alignments")
    # each diagonal alone, and neighbouring ones together
    order = Window.partitionBy("hash", "item_id", "plain").orderBy("shift")
    apart = F.coalesce((F.col("shift") - F.lag("shift").over(order) > NEIGHBOURS).cast("int"), F.lit(0))
    grouped = aligned.withColumn("apart", apart).withColumn("part", F.sum("apart").over(order))
    many = grouped.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("hash", "item_id", "plain", "part")))
    ways = F.explode(F.when(F.col("n") > 1, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))).alias("joint")
    places = many.select("hash", "item_id", "plain", "n_tokens", "shift", F.size("at").alias("weight"), "part", F.array_distinct(F.flatten(
        F.transform("at", lambda a: F.sequence(a, a + F.col("size") - 1)))).alias("at"), ways).select(
        "hash", "item_id", "plain", "n_tokens", "joint", F.when(F.col("joint"), F.col("part")).otherwise(F.col("shift")).alias("part"),
        "shift", "weight", F.explode("at").alias("at"))
    # a token of the item stands for one of the text: that on the diagonal with most windows
    single = places.groupBy("hash", "item_id", "plain", "n_tokens", "joint", "part", "at").agg(
        F.max_by("shift", F.struct("weight", "shift")).alias("shift"))
    spans = single.groupBy("hash", "item_id", "plain", "n_tokens", "joint", "part").agg(
        F.collect_list(F.struct("at", "shift")).alias("places"), F.count(F.lit(1)).cast("int").alias("covered"))
    likely = stored(spans.filter(F.col("covered") >= LEAST_COVERED * F.col("n_tokens")), "likely")
    # slots of the texts and items in question only
    hit = _broadcast_if_small(stored(likely.select("hash").distinct(), "hit"))
    texts = docs.filter(F.col("text").isNotNull()).select(F.xxhash64("text").alias("hash"), "text").join(hit, "hash").dropDuplicates(["hash"])

    def read(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(f"{name}_words", _plain(F.col(name))).withColumn(
            f"{name}_kinds", templates_of(F.col(name), F.col(f"{name}_words"))).withColumn(
            f"{name}_kept", _kept(F.col(f"{name}_kinds"))).drop(name)

    both = likely.join(read(texts.select("hash", tokens_of(F.col("text")).alias("found")), "found"), "hash").join(
        read(_told(items), "own"), "item_id")

    def value(name: str, at: Column) -> Column:
        """The word, or the whole run of names, at a place of the plain words or of the collapsed template."""
        kept = F.col(f"{name}_kept")
        first = F.get(kept, at)
        run = F.coalesce(F.get(kept, at + 1), F.size(f"{name}_words")) - first
        return F.when(F.col("plain"), F.get(f"{name}_words", at)).otherwise(
            F.array_join(F.slice(f"{name}_words", first + 1, run), " "))

    def kind(at: Column) -> Column:
        return F.get("own_kinds", F.when(F.col("plain"), at).otherwise(F.get("own_kept", at)))

    pairs = F.transform(F.filter("places", lambda p: kind(p["at"]).startswith("<")), lambda p: F.struct(
        kind(p["at"]).alias("kind"), value("own", p["at"]).alias("own"), value("found", (p["at"] + p["shift"]).cast("int")).alias("found")))
    slots = both.withColumn("slots", F.array_distinct(pairs))
    checked = slots.filter(F.size(F.array_distinct(F.transform("slots", lambda p: F.struct(p["kind"], p["own"])))) == F.size("slots"))
    return checked.groupBy("hash", "item_id").agg(
        F.max(F.struct((F.col("covered") / F.col("n_tokens")).alias("share"), ~F.col("joint"), ~F.col("plain"), "covered", "n_tokens",
                       F.size("slots").alias("n_slots"), F.size(F.filter("slots", lambda p: p["own"] != p["found"])).alias("changed"))).alias("best")).select(
        "hash", "item_id", "best.covered", "best.n_tokens", "best.n_slots", "best.changed")


def find_contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, covered (tokens), n_tokens (of the item), n_slots and changed (slots with another value).

    One row for each row of ``docs`` and item it holds; clean documents have none. Null and empty texts
    are clean; repeated rows and rows without doc_id are reported like others. Without items or
    documents there are no rows. Only the columns named are read, so further columns can't clash.
    """
    found = stored(contaminated(docs, items), "contaminated")
    named = docs.filter(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"))
    return named.join(found, "hash").select("doc_id", "item_id", "covered", "n_tokens", "n_slots", "changed")


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; rows without text stay."""
    found = stored(contaminated(docs, items).select(F.col("hash").alias("found")).distinct(), "contaminated")
    # the row in one struct, so that its columns can have any names
    whole = docs.select(F.xxhash64("text").alias("hash"), F.col("text").isNotNull().alias("told"), F.struct(
        *(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return whole.join(_broadcast_if_small(found), F.col("told") & (F.col("hash") == F.col("found")), "left_anti").select("row.*")

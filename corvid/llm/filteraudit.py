"""Interaction audit of corpus filters: what each removes in each order of application.

Whether a text repeats one of a smaller id is found by partition refinement. Documents are
first split by their length in code points, then by the hashes of successive blocks, each
block eight times as long as the one before, so a text of any length takes few rounds; classes
with a single id are dropped after each round. The whole texts of the classes that survive are compared in an
aggregation by text, and all but the smallest id are marked. Each document is then a mask of
the filters it fails, and the audit is arithmetic on the counts of masks by part, as a document is
removed by the first filter of an order that it fails.

Defined results: a null text is an empty one; rows that repeat count each; rows of one id with
one text do not repeat each other; rows without an id repeat nothing, are repeated by nothing, and
have no labels; of several labels of an id the largest holds; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stash

LETTERS = "ABCDE"
#: Code points of the first block, and how many times as long the next ones are.
BLOCK, TIMES = 64, 8
#: Blocks that cover any text that a row can hold (2 GB).
_BLOCKS = 10
#: Classes of at least one row in so many are sent to every task; there are as many at most.
_HOT = 1000
#: 64-bit words of the bitmap of live ids: 2 MB.
_WORDS = 1 << 18


def failing(text: Column) -> Column:
    """The mask of the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    tests = (n < 100, 100 * distinct < 80 * n, 100 * capitals.cast("long") > 10 * F.length(text).cast("long"), text.rlike(r"[#$%&*|]"))
    return sum((F.when(t, F.lit(1 << k)).otherwise(F.lit(0)) for k, t in enumerate(tests)), F.lit(0)).cast("int")


def block_hashes(text: Column) -> Column:
    """The hashes of a text's blocks, none for those beyond its end."""
    hashes, start, size = [], 1, BLOCK
    for _ in range(_BLOCKS):
        hashes.append(F.when(F.length(text) >= start, F.xxhash64(F.substring(text, start, size))))
        start, size = start + size, size * TIMES
    return F.array_compact(F.array(*hashes))


def _facts(docs: DataFrame, part: Column) -> DataFrame:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"), text.alias("text"))
    return own.select("doc_id", "part", failing(F.col("text")).alias("mask"), F.length("text").cast("long").alias("n"), block_hashes(F.col("text")).alias("hashes"))


def _class(n: Column, hashes: Column) -> Column:
    return F.aggregate(hashes, F.xxhash64(n), lambda at, h: F.xxhash64(at, h))


def _of_several(rows: DataFrame, total: int) -> DataFrame:
    """Rows (doc_id, class, ...) whose class has several ids. Large classes are sent to every
    task, the others joined, so no class makes a task larger than the others."""
    sizes = rows.groupBy("class").agg(F.count("*").alias("_rows"), F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high")).where("_low < _high")
    bound = max(1, total // _HOT)
    hot = F.broadcast(sizes.where(F.col("_rows") >= bound).select("class"))  # _HOT classes at most
    cold = sizes.where(F.col("_rows") < bound).select("class")
    return rows.join(hot, "class", "left_semi").unionByName(rows.join(hot, "class", "left_anti").join(cold, "class", "left_semi"))


def refine(rows: DataFrame, stash: Stash) -> DataFrame:
    """(doc_id, class) of the documents (doc_id, n, hashes) that agree in length and all block
    hashes with another id's; a class is the hash of both."""
    live = stash.keep(rows.where("doc_id is not null").select("doc_id", "hashes", F.xxhash64("n").alias("class")).dropDuplicates(), "split-0")
    for k in range(_BLOCKS + 1):
        total, deepest = live.agg(F.count("*"), F.max(F.size("hashes"))).first()
        if not total:
            break
        step = F.when(F.size("hashes") > k, F.xxhash64("class", F.get("hashes", F.lit(k)))).otherwise(F.col("class"))
        live = stash.keep(_of_several(live, total).select("doc_id", "hashes", step.alias("class")), f"split-{k + 1}")
        stash.drop(f"split-{k}")
        if deepest <= k + 1:
            break
    return live.select("doc_id", "class")


def repeats(docs: DataFrame, stash: Stash, facts: DataFrame | None = None) -> DataFrame:
    """(doc_id, class) of the documents whose text is that of a smaller id. The classes are those
    of refine(); two texts of one id could only be taken for one another if all their hashes agree."""
    facts = _facts(docs, F.lit("")) if facts is None else facts
    live = stash.keep(refine(facts, stash), "live")
    text = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    read = _marked(text, live).withColumn("class", _class(F.length("text").cast("long"), block_hashes(F.col("text"))))
    firsts = stash.keep(read.groupBy("class", "text").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")), "texts")
    several = firsts.groupBy("class").agg(F.count("*").alias("texts"), F.min("first").alias("first"), F.max("last").alias("last"))
    alone = several.where("texts = 1 and first < last").select("class", "first")
    large = F.broadcast(_largest(live, alone))  # _HOT classes at most
    paired = live.join(large, "class").unionByName(live.join(large, "class", "left_anti").join(alone, "class"))
    marks = paired.where("doc_id > first").select("doc_id", "class")
    clash = several.where("texts > 1").select("class")
    if not clash.isEmpty():  # equal hashes of different texts: these are told apart by the texts themselves
        own = firsts.join(clash, "class", "left_semi").where("first < last").select("class", "text", "first")
        marks = marks.unionByName(read.join(own, ["class", "text"]).where("doc_id > first").select("doc_id", "class"))
    return marks.dropDuplicates()


def _marked(text: DataFrame, live: DataFrame) -> DataFrame:
    """The rows whose id stands in a bitmap of the live ids, so that few other texts are sent.

    The bitmap has a fixed size; a row that it lets through by chance is alone in its class.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(_WORDS * 64))
    word, one = F.shiftright(bit, 6), F.expr("shiftleft(1L, cast(bit % 64 AS int))")
    held = live.select(bit.alias("bit")).select(F.shiftright("bit", 6).alias("id"), one.alias("set")).groupBy("id").agg(F.bit_or("set").alias("set"))
    dense = live.sparkSession.range(_WORDS).join(held, "id", "left").select("id", F.coalesce("set", F.lit(0).cast("long")).alias("set"))
    map_ = dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "set"))), lambda x: x["set"]).alias("map"))  # _WORDS entries
    tested = text.where("doc_id is not null").withColumn("bit", bit).withColumn("word", word.cast("int")).crossJoin(F.broadcast(map_))
    return tested.where(F.expr("getbit(get(map, word), cast(bit % 64 AS int)) = 1")).select("doc_id", "text")


def _largest(live: DataFrame, alone: DataFrame) -> DataFrame:
    """(class, first) of the classes with one in _HOT of the rows, _HOT of them at most."""
    bound = max(1, live.count() // _HOT)
    return alone.join(live.groupBy("class").agg(F.count("*").alias("n")).where(F.col("n") >= bound).select("class"), "class", "left_semi")


def masks(docs: DataFrame, labels: DataFrame, part: Column, stash: Stash) -> DataFrame:
    """(part, mask, good, toxic, n): rows of documents by the filters they fail and their labels."""
    facts = stash.keep(_facts(docs, part), "facts")
    again = repeats(docs, stash, facts).select("doc_id", "class", F.lit(1 << 4).alias("again"))
    rows = facts.select("doc_id", _class(F.col("n"), F.col("hashes")).alias("class"), "part", "mask").groupBy("doc_id", "class", "part", "mask").agg(F.count("*").alias("n"))
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].alias("quality"), labels["toxic"].alias("toxic"))
    known = known.where("doc_id is not null").groupBy("doc_id").agg((F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic"))
    named = rows.where("doc_id is not null").join(again, ["doc_id", "class"], "left").join(known, "doc_id", "left")
    bare = rows.where("doc_id is null").select("*", F.lit(None).cast("int").alias("again"), F.lit(None).cast("boolean").alias("good"), F.lit(None).cast("boolean").alias("toxic"))
    whole = (F.col("mask") + F.coalesce("again", F.lit(0))).cast("int")
    both = named.select("part", whole.alias("mask"), "good", "toxic", "n").unionByName(bare.select("part", whole.alias("mask"), "good", "toxic", "n"))
    yes = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return both.groupBy("part", "mask", yes("good"), yes("toxic")).agg(F.sum("n").alias("n"))


def audit(docs: DataFrame, labels: DataFrame, part: Column | None = None) -> DataFrame:
    """A row for each part, order of the five filters and step; part: a column of docs, lang unless given."""
    stash = Stash(docs.sparkSession, "filteraudit")
    counts = stash.keep(masks(docs, labels, docs["lang"] if part is None else part, stash), "masks")
    bit_of = lambda letter: F.expr(f"shiftleft(1, instr('{LETTERS}', {letter}) - 1)")
    orders = ["".join(x) for x in permutations(LETTERS)]
    each = counts.withColumn("filter_order", F.explode(F.split(F.lit(",".join(orders)), ","))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))))
    each = each.withColumn("bit", bit_of("substring(filter_order, step, 1)"))
    each = each.withColumn("before", sum((F.when(F.col("step") > k, bit_of(f"substring(filter_order, {k}, 1)")).otherwise(F.lit(0)) for k in range(1, len(LETTERS))), F.lit(0)))
    m, bit, before = F.col("mask"), F.col("bit"), F.col("before")
    fails, left = m.bitwiseAND(bit) != 0, m.bitwiseAND(before) == 0
    count = lambda test, name, n=F.col("n"): F.sum(F.when(test, n).otherwise(F.lit(0))).cast("long").alias(name)
    # in all orders, a document's failing filters come first equally often
    return each.groupBy("part", "filter_order", "step").agg(
        count(left & ~fails, "kept"),
        count(left & fails, "removed"),
        count(~left & fails, "redundant"),
        count(m == bit, "unique_fails"),
        count(left & fails & F.col("good"), "good_lost"),
        count(left & fails & F.col("toxic"), "toxic_lost"),
        count(fails, "shapley", F.expr(f"n * ({len(orders)} div greatest(bit_count(mask), 1))")),
    )

"""Mixing sources to target weights.

The words of each source are packed into blocks of fixed length. Every output
shard draws how many of its slots each source fills (a multinomial draw, slot
by slot); a source's slots, counted over the shards, are mapped to its blocks
through pseudorandom permutations, a new one each time the source has been
used up; slots and blocks are then joined by index. DataFrame functions only;
every random number is a digest, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadence.llm.common import free_name, materialise, row_id

#: Words of a block, slots of an output shard, rounds of a permutation.
BLOCK, SHARD, ROUNDS = 512, 1024, 24
#: Parts of the sources' shares in which a drawn number is looked up, and of a source's documents.
CELLS, BUCKET_BITS = 1 << 16, 12
#: Fixed values of the mix: weights of the sources in turn, share of all words, uses of a source at most.
WEIGHTS, SHARE, USES = (3, 1, 2), 1.5, 2
WORDS = r"[^\x20\x09-\x0D]+"


def digest_number(*parts: Column | str) -> Column:
    """60 bits of the MD5 digest of the parts joined by colons; null parts are empty."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def with_totals_before(df: DataFrame, order: list[Column], **totals: Column) -> DataFrame:
    """``df`` with, under each name, the total over all rows before a row in the order; a table.

    Rows are sorted into ranges; each range sums by itself and is moved by the
    totals of those before it, one row per range.
    """
    part = free_name(df, "_range")
    ranged = materialise(df.withColumns(totals).orderBy(*order).withColumn(part, F.spark_partition_id()), "ranges")
    before = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranges = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(part).agg(*[F.sum(t).alias(f"_{t}") for t in totals])
    sums = sums.select(part, *[F.coalesce(F.sum(f"_{t}").over(ranges), F.lit(0)).alias(f"_{t}") for t in totals])
    summed = ranged.join(sums, part).withColumns({t: F.coalesce(F.sum(t).over(before), F.lit(0)) + F.col(f"_{t}") for t in totals})
    return materialise(summed.drop(part, *[f"_{t}" for t in totals]), "totals")


def targets(sources: DataFrame, weights: Sequence[float], share: float, uses: int) -> DataFrame:
    """``sources`` with ``number`` in the order of names, null last, and ``target`` words.

    The targets share ``share`` times all words by weight. Those above
    ``uses`` times their source stop there and the rest is shared anew, until
    none is above: a round over the sources for each sum, three numbers back.
    """
    numbered = with_totals_before(sources, [F.col("source").asc_nulls_last()], number=F.lit(1).cast("bigint"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    weighed = materialise(numbered.withColumn("weight", weight), "mix-sources")
    most = F.col("source_size") * uses
    level, known = 0.0, -1
    while True:
        above = most < F.col("weight") * level if known >= 0 else F.lit(False)
        total, stopped, taken, left = weighed.agg(F.sum("source_size"), F.count(F.when(above, 1)), F.sum(F.when(above, most)), F.sum(F.when(~above, F.col("weight")))).first()
        if not total or stopped == known or not left:
            break
        level, known = (share * total - (taken or 0)) / left, stopped
    return weighed.withColumn("target", F.least(most.cast("double"), F.col("weight") * level))


@dataclass(frozen=True)
class Mix:
    """``documents``: a row each with its source's number, its words' place there, and the columns asked for.
    ``slots``: ``shard``, source ``number``, ``index`` there, ``block``, and ``words`` to take from its start."""

    documents: DataFrame
    slots: DataFrame
    block: int


def permuted(x: Column, n: Column, keys: Column) -> Column:
    """The place of x below n after a swap-or-not shuffle: each key pairs the places, and a bit says whether a pair is swapped."""

    def turn(at: Column, key: Column) -> Column:
        other = F.pmod(key - at, n)
        swap = F.ascii(F.md5(F.concat_ws(":", key, F.greatest(at, other)))) % 2 == 1
        return F.when(swap, other).otherwise(at)

    return F.aggregate(keys, x, turn)


def _placed(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents in a pseudorandom order within their source: ``start`` is the number of words before.

    A source is cut into hashed parts; each part sums its own documents and
    starts where the parts before it end, so a hot source is no hot task.
    """
    within = Window.partitionBy("number", "_bucket").orderBy("_hash", "doc_id", "size", "_row").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("number").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    named = docs.join(sources.select("source", "number", "source_size", "target"), docs["_source"].eqNullSafe(sources["source"])).drop("source")
    named = named.withColumn("_bucket", F.shiftright("_hash", 60 - BUCKET_BITS))
    parts = named.groupBy("number", "_bucket").agg(F.sum("size").alias("_words"))
    parts = parts.select("number", "_bucket", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_first"))
    own = F.coalesce(F.sum("size").over(within), F.lit(0))
    return named.withColumn("start", own).join(parts, ["number", "_bucket"]).withColumn("start", F.col("start") + F.col("_first")).drop("_bucket", "_first", "_hash")


def _draws(sources: DataFrame, shard: int) -> DataFrame:
    """``shard``, ``number`` and ``drawn`` slots: each slot draws a source with the probability of its share."""
    n = sources.agg(F.sum("quota")).first()[0] or 0
    cell = n // CELLS + 1
    ranges = sources.filter("quota > 0").select("number", F.col("low"), (F.col("low") + F.col("quota")).alias("high"))
    cells = ranges.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / cell), F.floor((F.col("high") - 1) / cell))))
    slots = sources.sparkSession.range(n).select(F.floor(F.col("id") / shard).alias("shard"), (digest_number("slot", F.col("id")) % n if n else F.col("id")).alias("x"))
    hit = slots.withColumn("cell", F.floor(F.col("x") / cell)).join(cells, "cell").filter("x >= low AND x < high")
    return hit.groupBy("shard", "number").agg(F.count("*").alias("drawn"))


def _slots(sources: DataFrame, shard: int) -> DataFrame:
    """``shard``, ``number`` and ``index``: every source has the indexes below its quota, once each.

    Draws beyond a source's quota are given, in order, to the sources that
    have drawn too little, so that the shards' draws add up to the quotas.
    """
    drawn = materialise(_draws(sources, shard), "mix-draws")
    sums = drawn.groupBy("number").agg(F.sum("drawn").alias("all"))
    balance = F.col("quota") - F.coalesce(F.col("all"), F.lit(0))
    totals = with_totals_before(sources.join(sums, "number", "left").withColumn("balance", balance), [F.col("number")],
                                spare=F.greatest(-F.col("balance"), F.lit(0)), want=F.greatest(F.col("balance"), F.lit(0)))
    before = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    dealt = drawn.withColumn("first", F.coalesce(F.sum("drawn").over(before), F.lit(0))).join(totals.select("number", "quota", "spare"), "number")
    # Dealt by shard again: the slots of a hot source are listed and mapped in many tasks. The rows are small
    # and their slots are not, so the number of tasks is given and Spark does not join them into one.
    dealt = dealt.repartition(int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard")
    end = F.col("first") + F.col("drawn")
    kept = dealt.filter("first < quota").select("shard", "number", F.explode(F.sequence("first", F.least(end, F.col("quota")) - 1)).alias("index"))
    over = dealt.filter(end > F.col("quota")).select(
        "shard", F.explode(F.sequence(F.greatest("first", "quota"), end - 1)).alias("_i"), "quota", "spare").select("shard", (F.col("spare") + F.col("_i") - F.col("quota")).alias("_turn"))
    short = totals.filter("balance > 0").select("number", F.explode(F.sequence(F.col("quota") - F.col("balance"), F.col("quota") - 1)).alias("index"), (F.col("want") - F.col("quota") + F.col("balance")).alias("_from"))
    given = over.join(short.withColumn("_turn", F.col("index") + F.col("_from")), "_turn").select("shard", "number", "index")
    return kept.unionByName(given)


def mix(docs: DataFrame, source: Column, text: str = "text", key: str = "doc_id", weights: Sequence[float] = WEIGHTS, share: float = SHARE,
        uses: int = USES, block: int = BLOCK, shard: int = SHARD, carry: tuple[str, ...] = ()) -> Mix:
    """Which blocks of words each output shard takes from which source.

    Words are parted by ASCII white space; a null text has none. Sources are
    numbered by code point, a null source last, and take the ``weights`` in
    turn. A source's taken words are its target rounded to a whole number, and
    no word is taken more than ``uses`` times: whole rounds over the source
    first, then blocks of a new permutation, the last one cut short. A block
    that is shorter than ``block``, the last of its source, closes each round.
    Rows count one by one, repeated rows and ties too, and null ids stay;
    sources without words have a target of 0. An empty table gives empty
    tables. Columns named in ``carry`` stay on the documents, except those
    that have the name of a column made here.
    """
    made = {"doc_id": F.col(key), "_source": source.cast("string"), "size": F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("bigint"),
            "_hash": digest_number("doc", F.col(key)), "_row": row_id()}
    taken = {*made, "source", "number", "source_size", "target", "start", "_bucket", "_first"}
    sized = materialise(docs.select(*[v.alias(k) for k, v in made.items()], *[c for c in carry if c not in taken]), "mix-documents")
    sums = sized.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    size, words = F.col("source_size"), F.col("words")
    full = F.floor(size / block)
    planned = targets(sums, weights, share, uses).withColumn("words", F.least(F.floor(F.col("target") + 0.5), size * uses))
    planned = planned.withColumn("rounds", F.when(size > 0, F.floor(words / size)).otherwise(0)).withColumn("rest", words - F.col("rounds") * size)
    planned = planned.withColumns({"full": full, "blocks": F.ceil(size / block)})
    planned = planned.withColumn("quota", F.col("rounds") * F.col("blocks") + F.ceil(F.col("rest") / block))
    keys = F.transform(F.sequence(F.lit(0), F.lit(uses)), lambda e: F.transform(F.sequence(F.lit(1), F.lit(ROUNDS)), lambda r: digest_number("key", F.col("number"), e, r)))
    planned = with_totals_before(planned, [F.col("number")], low=F.col("quota")).withColumn("keys", keys)
    index, n = F.col("index"), F.col("blocks")
    turn, at = F.floor(index / n), index % n
    # Rows of a hot source are spread: the join's small side has a row per source.
    slots = _slots(planned, shard).join(planned.select("number", "source_size", "rounds", "rest", "full", "blocks", "keys"), "number")
    slots = slots.withColumns({"turn": turn, "at": at})
    place = F.when(F.col("at") < F.col("full"), permuted(F.col("at"), F.col("full"), F.element_at("keys", (F.col("turn") + 1).cast("int")))).otherwise(F.col("full"))
    own = F.when(F.col("at") < F.col("full"), F.lit(block)).otherwise(F.col("source_size") - F.col("full") * block)
    taken_words = F.when(F.col("turn") < F.col("rounds"), own).otherwise(F.least(own, F.col("rest") - F.col("at") * block))
    slots = slots.select("shard", "number", "index", place.alias("block"), taken_words.cast("bigint").alias("words"))
    return Mix(_placed(sized, planned), materialise(slots, "mix-slots"), block)


def pieces(m: Mix) -> DataFrame:
    """Each document's words in each slot: document columns, slot columns, ``word`` (from 0) and ``n_words``.

    A document that is taken nowhere has one row with null slot columns. A
    block holds at most its length in documents and is in few slots.
    """
    size = m.block
    last = F.floor((F.col("start") + F.col("size") - 1) / size)
    # Documents without words get a block of their own that no slot has.
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / size), last)).otherwise(F.array(-1 - F.col("_row")))
    parted = m.documents.withColumn("block", F.explode(blocks))
    low, high = F.greatest(F.col("start"), F.col("block") * size), F.least(F.col("start") + F.col("size"), F.col("block") * size + F.col("words"))
    joined = parted.join(m.slots, ["number", "block"], "left")
    held = F.when(F.col("words").isNotNull(), F.greatest(high - low, F.lit(0))).otherwise(0)
    return joined.withColumns({"word": low - F.col("start"), "n_words": held})


def taken(m: Mix) -> DataFrame:
    """Per document ``doc_id``, ``size``, ``source_size``, ``target`` of its source, and ``taken`` words, repeats counted."""
    found = pieces(m).groupBy("_row", "doc_id", "size", "source_size", "target").agg(F.sum("n_words").cast("bigint").alias("taken"))
    return found.drop("_row")


def mixed_blocks(docs: DataFrame, source: Column, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The mix itself: ``shard``, ``slot`` (in a pseudorandom order within the shard), ``n_words``, ``text`` and the
    ``pieces`` (doc_id, word, n_words) it is made of. Takes the options of ``mix`` and has its rules; at most a block's
    words meet in one row."""
    m = mix(docs.withColumn("_text", F.col(text)), source, text, key, carry=("_text",), **options)
    piece = F.struct("start", F.col("doc_id"), "word", "n_words", F.array_join(F.slice(F.regexp_extract_all("_text", F.lit(WORDS), F.lit(0)), (F.col("word") + 1).cast("int"), F.col("n_words").cast("int")), " ").alias("text"))
    rows = pieces(m).filter("shard IS NOT NULL AND n_words > 0").groupBy("shard", "number", "index").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    order = Window.partitionBy("shard").orderBy(digest_number("place", F.col("number"), F.col("index")), "number", "index")
    shown = F.transform("p", lambda x: F.struct(x.doc_id.alias("doc_id"), x.word.alias("word"), x.n_words.alias("n_words")))
    return rows.select("shard", (F.row_number().over(order) - 1).alias("slot"), F.aggregate("p", F.lit(0).cast("bigint"), lambda a, x: a + x.n_words).alias("n_words"),
                       F.array_join(F.col("p.text"), " ").alias("text"), shown.alias("pieces"))

"""Mixing sources to target weights, with DataFrame functions only.

Each source's documents form one stream of words in a pseudorandom order,
repeated until the source meets its target and cut there. The stream is packed
into blocks of a fixed length; only a source's last block may be shorter, so
every source gives its target to the word. One pseudorandom permutation of all
slots draws the source counts of each output shard: a multinomial draw under
the condition that every source meets its target. It is drawn shard by shard
from the shard's own slots. A pseudorandom permutation of the source's block
numbers turns slots into blocks, and blocks join the documents they hold by
number.

Permutations are swap-or-not shuffles (Hoang, Morris, Rogaway 2012): they work
for any length and need no state, so no task has to know what another drew.
Positions in a source are prefix sums in two levels (within hash buckets of
about ``BUCKET`` documents, then over buckets), so no task sees a whole source.
What one task holds of all sources is a row of a few numbers for each.

Cases: null text has size 0 and is not taken; a null source is a source, the
last one; a null id is a document like others; a very long text is cut into
blocks like others; documents of equal id go by a hash of their text, in
``mixed_documents`` of all their columns (maps and variants aside), so results
do not depend on the order in which rows are read; repeated rows are documents
of their own; an empty table gives an empty table; ``taken_words`` ignores
further columns, ``mixed_documents`` keeps them, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut
from .quality import _let, words

BLOCK_WORDS = 64
SHARD_SLOTS = 4096
WEIGHTS = (5, 2, 1)
#: No source gives more than so many times its words.
REPEATS = 3
BUCKET = 4_000
ROUNDS = 10
#: Output shards that one task draws.
TASK_SHARDS = 32


def shuffled(x: Column, n: Column, *key: Column) -> Column:
    """Where a pseudorandom permutation of [0, n), chosen by ``key``, sends ``x``."""

    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*key, r), n) - x, n)
        swap = F.pmod(F.xxhash64(*key, r + 1000, F.greatest(x, partner)), F.lit(2)) == 1
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.array(*(F.lit(r) for r in range(ROUNDS))), x.cast("long"), step)


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source: s (its number), source, source_size, docs, target.

    Weights share the total; what lies above a source's bound is reshared by
    weight. The share for one unit of weight is found from prefix sums over the
    sources in order of bound per weight.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    order = Window.orderBy(F.asc_nulls_last("source"))  # one row per source
    w = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.col("s"), F.lit(len(WEIGHTS))).cast("int") + 1)
    numbered = per_source.withColumn("s", F.row_number().over(order) - 1).withColumn("w", w.cast("double")).withColumn("bound", REPEATS * F.col("source_size").cast("double"))
    by_ratio = Window.orderBy(F.col("bound") / F.col("w"), "s")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    shares = numbered.withColumns(
        {
            "rest": F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("bound").over(before), F.lit(0.0)),
            "rest_w": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)),
        }
    ).withColumn("unit", F.when(F.col("rest") / F.col("rest_w") <= F.col("bound") / F.col("w"), F.col("rest") / F.col("rest_w")))
    # the first source that the share does not fill up; later ones give the same share or a smaller one
    found = shares.withColumn("unit", F.max(F.coalesce("unit", F.lit(0.0))).over(everything))
    return found.select("s", "source", "source_size", "docs", F.least(F.col("w") * F.col("unit"), F.col("bound")).alias("target"))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(row, doc_id, source, size, tie): row is a number of its own for every input row, tie a hash that orders rows of equal id."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.coalesce(F.size(words(F.col(text_col))), F.lit(0)).cast("long").alias("size"), F.xxhash64(F.col(text_col)).alias("tie"), F.lit(0).cast("long").alias("rest"))
    return chosen.withColumn("row", F.monotonically_increasing_id())


def _positions(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """(s, row, size, start): where each document starts in its source's stream."""
    known = sizes.filter("size > 0").join(sources, sizes["source"].eqNullSafe(sources["source"])).select("s", "row", "size", F.xxhash64("doc_id", "tie").alias("at"), "doc_id", "tie", "rest", F.pmod(F.xxhash64("doc_id", "tie", F.lit(7)), F.ceil(F.col("docs") / BUCKET)).alias("bucket"))
    inside = Window.partitionBy("s", "bucket").orderBy("at", "doc_id", "tie", "rest", "row")
    local = known.withColumn("upto", F.sum("size").over(inside))
    buckets = known.groupBy("s", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("s", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("offset"))
    return local.join(offsets, ["s", "bucket"]).select("s", "row", "size", (F.col("offset") + F.col("upto") - F.col("size")).alias("start"))


def planned(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(s, source_size, words, blocks, base): the words a source gives, its blocks, and the number of its first block among all."""
    words_due = F.least(F.round("target").cast("long"), REPEATS * F.col("source_size"))
    given = sources.filter("source_size > 0").withColumn("words", words_due).withColumn("blocks", F.ceil(F.col("words") / block_words)).filter("blocks > 0")
    before = F.sum("blocks").over(Window.orderBy("s")) - F.col("blocks")  # one row per source
    return cut(given.select("s", "source_size", "words", "blocks", before.alias("base")), "planned")


def _pieces(positions: DataFrame, plan: DataFrame, block_words: int) -> DataFrame:
    """(s, block, row, pass, first, n): the parts of documents in each block; first counts from the document's start."""
    passes = F.explode(F.sequence(F.lit(0), F.ceil(F.col("words") / F.col("source_size")) - 1))
    every = positions.join(plan.select("s", "source_size", "words"), "s").withColumn("pass", passes)
    begin = F.col("pass") * F.col("source_size") + F.col("start")
    placed = every.select("s", "row", "pass", begin.alias("begin"), F.least(begin + F.col("size"), "words").alias("end")).filter("begin < end")
    numbers = F.sequence(F.floor(F.col("begin") / block_words), F.floor((F.col("end") - 1) / block_words))
    low = F.greatest(F.col("block") * block_words, "begin")
    high = F.least((F.col("block") + 1) * block_words, "end")
    return placed.withColumn("block", F.explode(numbers)).select("s", "block", "row", "pass", (low - F.col("begin")).alias("first"), (high - low).alias("n"))


def slots(plan: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The source counts of each output shard (shard, s, n), and the slots (shard, slot, s, block)."""
    spark = plan.sparkSession
    totals = plan.agg(F.coalesce(F.sum("blocks"), F.lit(0)).alias("slots"), F.count("*").alias("sources")).first()
    total, shards = totals["slots"], -(-totals["slots"] // shard_slots)
    ranges = plan.agg(F.array_sort(F.collect_list(F.struct("base", "s", "blocks"))).alias("ranges")).scalar()
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(max(1, totals["sources"].bit_length())))))

    def drawn(slot: Column) -> Column:
        """The source a slot draws, and which of the source's draws it is."""
        x = shuffled(slot, F.lit(total), F.lit(seed))
        # the last range that begins at or below x, by halving steps
        of = lambda x: F.aggregate(steps, F.lit(0), lambda i, by: F.when(F.get("ranges", i + by)["base"] <= x, i + by).otherwise(i))
        return _let(x, lambda x: _let(F.get("ranges", of(x)), lambda r: F.struct(slot.alias("slot"), r["s"].alias("s"), (x - r["base"]).alias("number"), r["blocks"].alias("blocks"))))

    low = F.col("shard") * shard_slots
    own = F.sequence(low, F.least(low + shard_slots, F.lit(total)) - 1)
    rows = spark.range(0, shards, 1, max(1, -(-shards // TASK_SHARDS))).withColumnRenamed("id", "shard").withColumn("ranges", ranges).withColumn("drawn", F.transform(own, drawn))
    each = rows.select("shard", F.inline("drawn"))
    counts = each.groupBy("shard", "s").agg(F.count("*").alias("n"))
    return counts, each.select("shard", "slot", "s", shuffled(F.col("number"), F.col("blocks"), F.lit(seed), F.col("s")).alias("block"))


def mix(sizes: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The sources with their targets, and the mix as parts of documents (shard, slot, row, pass, first, n)."""
    sources = cut(targets(sizes), "sources")
    plan = planned(sources, block_words)
    _, dealt = slots(plan, shard_slots, seed)
    # both sides grow with the words: no broadcast, however well they compress
    parts = dealt.hint("merge").join(_pieces(_positions(sizes, sources), plan, block_words), ["s", "block"])
    return sources, parts.select("shard", "slot", "row", "pass", "first", "n")


def taken_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken), one for each input row."""
    sizes = cut(sized(docs, id_col, text_col, source_col), "sizes")
    sources, parts = mix(sizes, block_words)
    taken = parts.groupBy("row").agg(F.sum("n").alias("taken"))
    known = sizes.join(taken.hint("merge"), "row", "left").join(sources, sizes["source"].eqNullSafe(sources["source"]))
    return known.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` as the mix has them: for every pass over its source, a row with the words taken of the document, their white space kept.

    Documents with no word taken go; ``n_chars``, where there is one, is
    counted anew.
    """
    rows = cut(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "rows")
    of = lambda c: F.col("doc").getField(c)
    rest = F.xxhash64(*(of(c) for c, t in docs.dtypes if "map<" not in t and "variant" not in t))
    sizes = cut(rows.select("row", of("doc_id").alias("doc_id"), of("source").alias("source"), F.coalesce(F.size(words(of("text"))), F.lit(0)).cast("long").alias("size"), F.xxhash64(of("text")).alias("tie"), rest.alias("rest")), "sizes")
    _, parts = mix(sizes, block_words)
    # all blocks below the target are taken, so a document's parts of one pass stand in a row
    chosen = parts.groupBy("row", "pass").agg(F.min("first").cast("int").alias("first"), F.sum("n").cast("int").alias("n"))
    split = F.regexp_extract_all(of("text"), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    text = F.array_join(F.slice(split, F.col("first") + 1, F.col("n")), "")
    whole = rows.join(chosen, "row").select("doc", text.alias("text"))
    types = dict(docs.dtypes)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(types.get("n_chars", "long"))}
    return whole.select(*(new.get(c, of(c)).alias(c) for c in docs.columns))

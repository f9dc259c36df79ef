"""Mixing sources to target weights by weighted random keys.

Every source gets a number of words: its share by weight of the whole mix, at most ``max_epochs`` times its
own size; what a source cannot give is shared out again. A source gives whole epochs first, then a selection:
its documents are put in the order of Efraimidis-Spirakis keys, ``-ln(u) / weight``, the sizes are summed in
that order, and documents are taken until the rest of the target is reached. The document at the edge gives
only the words that are missing.

The draw ``u`` is a hash of seed and doc_id, so reruns and retries agree. The weight of a document is a share
of words that are not broken by symbols, from 0.05 to 1, unless a column of weights is given. Given weights count from 0.05
to 2^60; null and NaN count as 1.

Defined results: a null or blank text has size 0 and gives nothing. A null source is a source of its own,
after all others. Null doc_ids draw like any other value. Rows that are equal in doc_id and size may swap
places, which changes no row of the result. An empty table gives an empty result. Extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, carry, kept, pick, words_column
from tidemark.operators.ranking import global_rank

ROWS_PER_BUCKET = 1_000
BUCKETS_PER_PAGE = 1_000
BINS_PER_OCTAVE = 8         # of weights; there are 510 bins at most, and 36 for weights from 0.05 to 1
LEAST_WEIGHT = 0.05
MOST_WEIGHT = float(1 << 60)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """1 for plain text, falling with the number of symbols per word."""
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    share = F.coalesce(symbols, F.lit(0)) / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(LEAST_WEIGHT), F.lit(1.0) - share)


def source_targets(sizes: DataFrame, cycle: tuple[int, ...], percent: int, max_epochs: int) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``.

    Sources that reach their limit are set to it and leave; the rest is shared by weight among the others,
    until none is above. Each round is one aggregate over the table of sources, of which only three sums come
    to the driver; a round without a new source at its limit is the last.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    ranked = global_rank(totals, "_rank", [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]),
                          ((F.col("_rank") - 1) % len(cycle) + 1).cast("int"))
    table = kept(ranked.withColumn("_weight", weight).drop("_rank"), "sources")
    limit = F.col("source_size") * F.lit(float(max_epochs))
    level = 0.0  # words per unit of weight; it only rises, so a source at its limit stays there
    while True:
        above = limit <= F.lit(level) * F.col("_weight")
        got = table.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, limit)).alias("given"),
            F.sum(F.when(~above, F.col("_weight"))).alias("weight"),
            F.sum(F.when(~above, F.lit(1))).alias("open")).first()
        if not got["all"] or not got["open"]:
            break
        share = (got["all"] * percent / 100 - (got["given"] or 0.0)) / got["weight"]
        if share <= level:
            break
        level = share
    return table.select("source", "source_size", "rows",
                        F.least(limit, F.lit(level) * F.col("_weight")).alias("target"))


def _copy_key(doc_id: str, text: str, source: str) -> Column:
    return F.xxhash64(doc_id, source, text)


def _numbered(frame: DataFrame, doc_id: str) -> DataFrame:
    """Numbers the rows that agree in id, source and text, which are interchangeable."""
    return frame.withColumn("_nth", F.row_number().over(Window.partitionBy(doc_id, "_copy").orderBy(doc_id)))


def mixed_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                    n_chars: str = "n_chars", **settings) -> DataFrame:
    """The mix itself: each document as often as its words are taken, columns unchanged.

    Where the last taking is not a whole document, that copy holds its first words, joined by single spaces, and
    its length in characters. Documents of which nothing is taken are absent.
    """
    inner, names = carry(documents)
    own, body, origin = (f"_in{names.index(n)}" for n in (doc_id, text, source))
    inner = inner.withColumn("_copy", _copy_key(own, body, origin))
    taken = mix(inner, doc_id=own, text=body, source=origin, keep="_copy", **settings).filter("taken > 0")
    taken = kept(taken.select("doc_id", "_copy", "size", "taken"), "taken")  # so the whole texts meet a small plan
    taken = _numbered(taken, "doc_id").withColumnRenamed("_nth", "_n")
    taken = taken.withColumnRenamed("_copy", "_c").withColumnRenamed("doc_id", "_id")
    joined = _numbered(inner, own).join(taken, F.col(own).eqNullSafe(F.col("_id")) & (F.col("_copy") == F.col("_c"))
                                        & (F.col("_nth") == F.col("_n")))
    whole, rest = F.expr("cast(taken div size as int)"), (F.col("taken") % F.col("size")).cast("int")
    copies = F.concat(F.array_repeat(F.lit(-1), whole), F.array_repeat(rest, F.when(rest > 0, 1).otherwise(0)))
    copied = joined.withColumn("_words", F.explode(copies))
    short = F.col("_words") >= 0
    copied = copied.withColumn(body, F.when(
        short, F.array_join(F.slice(words_column(F.col(body)), 1, F.greatest(F.lit(1), F.col("_words"))), " ")).otherwise(F.col(body)))
    if n_chars in names:
        length = f"_in{names.index(n_chars)}"
        copied = copied.withColumn(length, F.when(short, F.length(body).cast(inner.schema[length].dataType)).otherwise(F.col(length)))
    return copied.select(*[f"_in{i}" for i in range(len(names))]).toDF(*names)


def _key_shares(keyed: DataFrame) -> DataFrame:
    """One row per source: the mean weight and the share of rows of each narrow range of weights.

    A key of weight w lies below x with the probability 1 - exp(-w x), so these few numbers give the distribution of all
    keys of a source, whatever its weights are.
    """
    bins = keyed.groupBy("source", F.floor(F.log2("weight") * BINS_PER_OCTAVE).alias("bin")).agg(
        F.avg("weight").alias("w"), F.count(F.lit(1)).alias("n"))
    return bins.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("w", "n"))).alias("shares"))


def _key_rank(key: Column, shares: Column, rows: Column) -> Column:
    """The expected share of a source's keys that are at most ``key``; it never falls as the key grows."""
    return F.aggregate(shares, F.lit(0.0), lambda sum_, s: sum_ + s["n"] * (F.lit(1.0) - F.exp(-s["w"] * key))) / rows


def with_buckets(sized: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """Adds the key and its bucket, buckets of a source being in the order of keys and about equally full."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11) + 0.5) / float(1 << 53)
    shares = _key_shares(sized).withColumnRenamed("source", "_source")
    # Written, for means of doubles may differ in their last bits when they are computed again, and so may the edges.
    table = kept(targets.join(shares, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"), "sources-of-keys")
    # The table of sources is joined by whatever way Spark finds right for its size; a source that holds
    # many documents is a skewed join, which adaptive execution splits.
    keyed = sized.withColumn("key", -F.log(uniform) / F.col("weight")).join(
        table, sized["source"].eqNullSafe(table["source"])).drop(table["source"])
    buckets = F.ceil(F.col("rows") / ROWS_PER_BUCKET)
    return keyed.withColumn("bucket", F.floor(
        _key_rank(F.col("key"), F.col("shares"), F.col("rows")) * buckets)).drop("shares")


def _earlier(totals: DataFrame) -> DataFrame:
    """_source, _bucket, base: the words of all buckets of the source before this one.

    Pages of buckets are summed first, so the longest window holds a millionth of a source's rows.
    """
    paged = totals.withColumn("page", F.floor(F.col("bucket") / BUCKETS_PER_PAGE))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    pages = paged.groupBy("source", "page").agg(F.sum("in_bucket").alias("in_page"))
    pages = pages.select(
        F.col("source").alias("_of"), F.col("page").alias("_page"),
        F.coalesce(F.sum("in_page").over(before.partitionBy("source").orderBy("page")), F.lit(0)).alias("ahead"))
    inside = F.coalesce(F.sum("in_bucket").over(before.partitionBy("source", "page").orderBy("bucket")), F.lit(0))
    return paged.withColumn("_inside", inside).join(
        pages, F.col("source").eqNullSafe(F.col("_of")) & (F.col("page") == F.col("_page"))).select(
        F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), (F.col("ahead") + F.col("_inside")).alias("base"))


def mix(documents: DataFrame, cycle: tuple[int, ...] = (5, 2, 1), percent: int = 150, max_epochs: int = 2,
        seed: int = 0, weight: str | None = None, doc_id: str = "doc_id", text: str = "text",
        source: str = "source", keep: str | None = None) -> DataFrame:
    """doc_id, size, source_size, target and the words taken of every document; ``keep`` names one more column.

    ``cycle`` holds the weights of the sources in code point order, repeating; ``percent`` the size of the
    mix in percent of all words.

    The prefix sums of a source run in buckets of the key: each bucket is summed on its own on top of the
    totals of the buckets before it, so one source with a third of all rows is no single task's work. The
    number of buckets follows the number of rows of the source, their edges the distribution of its keys.
    """
    columns = {"doc_id": doc_id, "text": text, "source": source} | ({"given": weight} if weight else {})
    docs = pick(documents, **columns, **({"_copy": keep} if keep else {}))
    more = ["_copy"] if keep else []
    size = n_words(F.col("text"))
    if weight:
        given = F.coalesce(F.nanvl(F.col("given").cast("double"), F.lit(1.0)), F.lit(1.0))
        weights = F.least(F.greatest(given, F.lit(LEAST_WEIGHT)), F.lit(MOST_WEIGHT))
    else:
        weights = quality_weight(F.col("text"), size)
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"),
                        weights.alias("weight"), *more)
    sized = kept(sized, "sizes")  # all that follows reads a few bytes a document
    targets = source_targets(sized, cycle, percent, max_epochs)

    keyed = with_buckets(sized, targets, seed)
    base = _earlier(keyed.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket")))
    inside = (Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = keyed.withColumn("inside", F.sum("size").over(inside)).join(
        base, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket")))

    words = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(F.lit(0))
    epochs = F.least(epochs, F.lit(max_epochs)).cast("long")
    rest = words - epochs * F.col("source_size")
    before = F.col("base") + F.col("inside") - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    return summed.select("doc_id", "size", "source_size", "target",
                         (epochs * F.col("size") + part).cast("long").alias("taken"), "source", *more)

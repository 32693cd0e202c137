"""Document fingerprints by consistent weighted sampling (built-in functions only).

A text is the multiset of its white-space separated words; a word's weight is how often it occurs.
For each of ``SAMPLES`` hash functions k and each word i, two hashes of (i, k) give r and c, both
Gamma(2, 1) distributed, and b uniform in (0, 1). With weight S,

    t = floor(ln S / r + b),   ln a = ln c - r (t - b + 1)

and the sample of k is the word and t with the smallest a. Two texts share a sample with probability
equal to their generalised Jaccard similarity, the sum of smaller weights over the sum of larger ones.
As a depends on nothing but (i, k, t), the smallest a itself identifies the sample; the fingerprint
holds 32 bits of its hash per k as hex, and the likeness of two fingerprints is the share of equal
entries.

Scale: words are counted and samples are minimised inside the partitions that already hold a text, so
no word crosses the network, and the minimum is a fixed number of doubles whatever the text's length.
Each sample block adds its own row, which keeps generated code short.

Defined results: a null text counts as empty; a text without words has a fingerprint of zeros (likeness
1 to another such, 0 to others, hash collisions apart); equal texts have equal fingerprints; an empty
table gives no row; columns other than id and text are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from stellate.llm.staging import stage

SAMPLES = 64
BLOCK = 4  # samples computed side by side
_SPACE = r"[\x20\x09-\x0D]+"
_LEAST = -(1 << 63)


def _unit(bits: Column, shift: int, width: int) -> Column:
    """A number in (0, 1) from ``width`` bits of a hash."""
    part = F.shiftrightunsigned(bits, shift).bitwiseAND((1 << width) - 1)
    return (part.cast("double") + F.lit(0.5)) * F.lit(2.0 ** -width)


def _draws(term: Column, k: Column) -> tuple[Column, Column, Column]:
    """r, ln c and b of a word for sample k."""
    h, g = F.xxhash64(term, k), F.xxhash64(k, term)
    r = -F.log(_unit(h, 0, 21) * _unit(h, 21, 21))
    c = -F.log(_unit(g, 0, 21) * _unit(g, 21, 21))
    return r, F.log(c), _unit(h, 42, 21)


def _ln_a(r: Column, ln_c: Column, b: Column, weight_ln: Column) -> Column:
    """ln a at a weight; null where the weight is."""
    return ln_c - r * (F.floor(weight_ln / r + b) - b + F.lit(1.0))


def signatures(texts: DataFrame, keys: list[str], text_cols: list[str], samples: int = SAMPLES) -> DataFrame:
    """(keys, parts): the samples of the texts in ``text_cols``, as sorted (block, one part per text)
    entries; no row where no text has words. ``keys`` tell the rows apart; where ``texts`` is partitioned
    by some of them, nothing is shuffled.

    A word of several texts of a row draws its random numbers once for all of them where it weighs the same.
    """
    if samples % BLOCK:
        raise ValueError(f"samples must be a multiple of {BLOCK}")
    each = F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).alias("text")) for i, c in enumerate(text_cols)])
    words = (texts.select(*keys, F.explode(each).alias("t"))
             .select(*keys, "t.side", F.explode(F.split("t.text", _SPACE)).alias("word")).where("word <> ''")
             .select(*keys, "side", F.xxhash64("word").alias("term")))
    sides = range(len(text_cols))
    weights = words.groupBy(*keys, "term").agg(*[F.sum((F.col("side") == i).cast("int")).alias(f"n{i}") for i in sides])
    # texts in which a word weighs the same share its draws and its values: an entry per different weight, with the texts as bits
    entries = []
    for i in sides:
        bits = sum((F.when(F.col(f"n{j}") == F.col(f"n{i}"), F.lit(1 << j)).otherwise(F.lit(0)) for j in sides if j > i), F.lit(1 << i))
        new = reduce(Column.__and__, [F.col(f"n{j}") != F.col(f"n{i}") for j in sides if j < i], F.col(f"n{i}") > 0)
        entries.append(F.struct(F.when(new, bits).alias("held"), F.col(f"n{i}").alias("n")))
    drawn = (weights.select(*keys, "term", F.inline(F.array(*entries))).where(F.col("held").isNotNull())
             .select(*keys, "held", "term", F.log(F.col("n").cast("double")).alias("w"), F.explode(F.array(*[F.lit(b) for b in range(samples // BLOCK)])).alias("block")))
    draws = [_draws(F.col("term"), F.col("block") * BLOCK + j) for j in range(BLOCK)]
    drawn = drawn.select(*keys, "held", "block", "w", *[x.alias(f"{n}{j}") for j in range(BLOCK) for n, x in zip(("r", "c", "b"), draws[j])])
    least = (drawn.groupBy(*keys, "block", "held")
             .agg(*[F.min(_ln_a(F.col(f"r{j}"), F.col(f"c{j}"), F.col(f"b{j}"), F.col("w"))).alias(f"a{j}") for j in range(BLOCK)])
             .groupBy(*keys, "block").agg(*[F.min(F.when(F.col("held").bitwiseAND(1 << i) != 0, F.col(f"a{j}"))).alias(f"a{i}_{j}")
                                            for i in sides for j in range(BLOCK)]))
    parts = [F.concat(*[F.lpad(F.lower(F.hex(F.xxhash64(f"a{i}_{j}").bitwiseAND(0xFFFFFFFF))), 8, "0") for j in range(BLOCK)])
             for i in sides]
    entry = F.struct("block", *[F.when(F.col(f"a{i}_0").isNotNull(), p).alias(f"part{i}") for i, p in zip(sides, parts)])
    return least.select(*keys, entry.alias("part")).groupBy(*keys).agg(F.sort_array(F.collect_list("part")).alias("parts"))


def joined(i: int, samples: int = SAMPLES) -> Column:
    """The fingerprint of text ``i`` from ``signatures`` (zeros if it has no words)."""
    text = F.array_join(F.col(f"parts.part{i}"), "")
    return F.when(F.length(text) > 0, text).otherwise(F.lit(zero_fingerprint(samples)))


def zero_fingerprint(samples: int = SAMPLES) -> str:
    return "0" * (8 * samples)


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints: estimates the generalised Jaccard similarity."""
    same = F.filter(F.sequence(F.lit(0), F.lit(samples - 1)),
                    lambda i: a.substr(i * 8 + 1, F.lit(8)) == b.substr(i * 8 + 1, F.lit(8)))
    return F.size(same) / F.lit(float(samples))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(id, fingerprint) of every row."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    signed = signatures(rows, ["row"], ["text"], samples)
    return rows.join(signed, "row", "left").select(F.col("id").alias(id_col), joined(0, samples).alias("fingerprint"))


def following(ids: DataFrame, key: str = "k") -> DataFrame:
    """``ids`` (different values of ``key``) with ``next_k``: the next value in ascending order, the first
    one after the last.

    Range partitions are ordered one by one; only the first value of each partition (a row per
    partition) is brought together.
    """
    n = max(int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = stage(ids.repartitionByRange(n, key).withColumn("part", F.spark_partition_id()), "ids")
    firsts = dealt.groupBy("part").agg(F.min(key).alias("first_k"))
    across = Window.orderBy("part")
    firsts = firsts.select("part", F.coalesce(F.lead("first_k").over(across), F.min("first_k").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    inside = Window.partitionBy("part").orderBy(key)
    return (dealt.withColumn("lead_k", F.lead(key).over(inside)).join(F.broadcast(firsts), "part")
            .withColumn("next_k", F.coalesce("lead_k", "after")).drop("part", "lead_k", "after"))


def edit_robustness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """For every row: n_chars, the sha256 of its edited text (the last quarter replaced by the start of the
    next document in ascending id), both fingerprints, and the likeness of its fingerprint to the edited
    text's and to the next document's.

    ``id_col`` is an integer; null counts as the smallest 64-bit integer. Where different texts share an
    id, each is edited by itself; as a next document the id stands for its greatest start and fingerprint.
    Rows that are equal in id and text are worked on once and given back as often as they came.

    Texts cross the network once, by id: the two uses of ``texts`` read one shuffle, and everything up to
    the fingerprints happens in the partitions it makes. Starts of next documents are moved a second time.
    """
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST)).alias("k"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    texts = (rows.repartition(n, "k").groupBy("k", F.xxhash64("text").alias("th"))
             .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")))
    order = stage(following(rows.groupBy("k").agg(F.max(F.char_length("text")).alias("most"))), "order")
    takers = order.select(F.col("next_k").alias("k"), F.col("k").alias("taker"), "most")
    starts = (texts.join(takers.hint("shuffle_merge"), "k")
              .select(F.col("taker").alias("k"), F.substring("text", F.lit(1), F.floor(F.col("most") / 4).cast("int")).alias("start"))
              .groupBy("k").agg(F.max("start").alias("start")))
    size = F.char_length("text")
    cut = F.floor(size / 4).cast("int")
    both = (texts.join(order.select("k", "next_k").hint("shuffle_merge"), "k").join(starts.hint("shuffle_merge"), "k")
            .withColumn("edited", F.concat(F.substring("text", F.lit(1), size - cut), F.substring("start", F.lit(1), cut))))
    pairs = signatures(both.select("k", "th", "text", "edited"), ["k", "th"], ["text", "edited"], samples)
    # joined on k, by which both sides lie already; different texts of one id are told apart by the condition
    left = both.select("k", "th", "copies", "next_k", size.cast("long").alias("n_chars"),
                       F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")).alias("l")
    same = (F.col("l.k") == F.col("p.k")) & (F.col("l.th").bitwiseXOR(F.col("p.th")) == 0)
    done = stage(left.join(pairs.alias("p"), same, "left")
                 .select("l.*", F.unhex(joined(0, samples)).alias("fp"), F.unhex(joined(1, samples)).alias("edited_fp")), "signatures")
    nexts = done.groupBy(F.col("k").alias("next_k")).agg(F.max("fp").alias("next_fp"))
    text = {n: F.lower(F.hex(c)) for n, c in (("fingerprint", "fp"), ("edited_fingerprint", "edited_fp"), ("next_fingerprint", "next_fp"))}
    every = (done.join(nexts, "next_k").withColumns(text)
             .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))
    return every.select(
        F.when(F.col("k") != _LEAST, F.col("k")).cast(id_type).alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"))

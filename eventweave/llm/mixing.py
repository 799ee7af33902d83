"""Mixing sources to target weights by pivotal dependent rounding.

Each source's target is a number of words; its documents all want the same
number of copies p = target / size of the source. Whole copies are taken at
once; what remains is a fraction of each document, rounded by the pivotal
method on words: two fractional documents meet, words move from one to the other
at random until one of them is taken or left as a whole, and the other carries
the rest on. The odds of the two directions keep each document's expected
words, and the source's total never changes.

The meetings form a reduction tree. A node reduces up to ``FAN`` documents of
one source and one size class (powers of two) to at most one fractional
document; these meet in the next level. Nodes are formed by hash of the doc_id
and exact counts, so neither a hot source nor the number of partitions matters
and reruns agree. When a source has no more than ``LAST`` fractional documents
in each size class, some hundreds in all, they are settled from large to small,
and what a document was given beyond or short of the words owed is owed on. Where
the smaller documents left can make up for either outcome, it is drawn with the
odds of the words owed to the document's size; where they cannot, the nearer
outcome is taken. So a source ends within about a small document of its target,
which meetings down to one document, of any size, would not give.

All of it is DataFrame and SQL functions. Nulls: a null text has size 0; a null
source is a source of its own, the last; null doc_ids are kept like others.
Documents without words are never taken. Repeated rows are rounded separately.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventweave.llm.common import saved, scratch, table, unit_uniform

WORD = r"[^\x20\x09-\x0D]+"
FAN = 64
LAST = 8
WEIGHTS = (3, 1, 2)
#: Words of all documents to words of the mix, and the most a source may be repeated.
SHARE = 1.5
MOST = 2

ITEM = "struct<h:bigint,rid:bigint,size:bigint,mass:double>"
DONE = "array<struct<rid:bigint,one:int>>"


def _let(value: Column, body) -> Column:
    """body(value) with value computed once, inside higher-order functions too."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _ranked(df: DataFrame, by: str) -> DataFrame:
    """Adds rank (from 0) in ascending order of ``by``, nulls last, without a single-partition sort."""
    placed = df.withColumn("null_", F.col(by).isNull()).repartitionByRange("null_", by).sortWithinPartitions("null_", by)
    placed = saved(placed.withColumn("at_", F.monotonically_increasing_id()).drop("null_"), "ranked")
    part = F.shiftright("at_", 33)
    counts = placed.groupBy(part.alias("part_")).agg(F.count("*").alias("n_"))
    # one row a partition
    before = counts.withColumn("off_", F.coalesce(F.sum("n_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    joined = placed.withColumn("part_", part).join(before.select("part_", "off_"), "part_")
    return joined.withColumn("rank", F.col("at_").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("off_")).drop("at_", "part_", "off_")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size): ``weights`` repeat over the sources in order of code points.

    A target stops at ``most`` times its source; the excess goes to the others by weight until none is above.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    choice = F.array(*[F.lit(float(w)) for w in weights])
    ranked = _ranked(per, "source").withColumn("weight", F.element_at(choice, (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = saved(ranked, "sources")
    cap = F.col("source_size") * F.lit(float(most))
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:
        above = F.col("weight") * level > cap
        x = ranked.agg(
            F.count_if(above).alias("n"), F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("held"), F.sum(F.when(~above, F.col("weight"))).alias("w")
        ).first()
        if x.n == full or not x.w:
            break
        full, level = x.n, (total - x.held) / x.w
    return ranked.select("source", "source_size", F.least(cap, F.col("weight") * level).alias("target"))


def _meet(acc: Column, x: Column, seed: int, level: int) -> Column:
    """One meeting: the carried document and the next; one of them is decided."""

    def both(r: Column) -> Column:
        up = F.least(r["size"] - r["mass"], x["mass"])
        down = F.least(x["size"] - x["mass"], r["mass"])
        rises = unit_uniform(F.lit(seed), F.lit(level), r["h"], x["h"]) * (up + down) < down
        sum_ = r["mass"] + x["mass"]

        def item(i: Column, mass: Column) -> Column:
            return F.struct(i["h"].alias("h"), i["rid"].alias("rid"), i["size"].alias("size"), mass.alias("mass"))

        def out(carry: Column, decided: Column, one: int) -> Column:
            fact = F.struct(decided["rid"].alias("rid"), F.lit(one).alias("one"))
            return F.struct(carry.alias("carry"), F.concat(acc["done"], F.array(fact)).alias("done"))

        fills_r = r["size"] - r["mass"] <= x["mass"]
        fills_x = x["size"] - x["mass"] <= r["mass"]
        return (
            F.when(rises & fills_r, out(item(x, sum_ - r["size"]), r, 1))
            .when(rises, out(item(r, sum_), x, 0))
            .when(fills_x, out(item(r, sum_ - x["size"]), x, 1))
            .otherwise(out(item(x, sum_), r, 0))
        )

    first = F.struct(x.alias("carry"), acc["done"].alias("done"))
    return F.when(acc["carry"].isNull(), first).otherwise(_let(acc["carry"], both))


def _reduced(groups: DataFrame, keys: list[str], seed: int, level: int) -> DataFrame:
    """Rows (keys, items) to (keys, carry, done)."""
    start = F.struct(F.lit(None).cast(ITEM).alias("carry"), F.array().cast(DONE).alias("done"))
    return groups.select(*keys, F.aggregate("items", start, lambda a, x: _meet(a, x, seed, level)).alias("r")).select(*keys, "r.*")


def rounded(items: DataFrame, seed: int = 0, fan: int = FAN) -> DataFrame:
    """(rid, one) for rows (rid, source, h, size, mass), 0 < mass < size: 1 if the document's fraction is taken as a whole.

    ``h`` orders and randomises; equal rows may share it.
    """
    now = items.withColumn("class", F.floor(F.log2("size")).cast("int"))
    done, level = [], 0
    while True:
        counts = now.groupBy("source", "class").agg(F.count("*").alias("n"))
        counts = saved(counts, "class-sizes")
        most = counts.agg(F.max("n")).first()[0]
        if most is None or most <= LAST:
            break
        # hash buckets of 3/4 fan on average, no fewer than are to be left; a bucket that is larger all the same is cut by position
        sized = now.join(counts.select(F.col("source").alias("s_"), F.col("class").alias("c_"), "n"), F.col("source").eqNullSafe(F.col("s_")) & (F.col("class") == F.col("c_"))).drop("s_", "c_")
        buckets = F.greatest(F.lit(LAST), F.ceil(F.col("n") / (fan * 3 // 4))).cast("long")
        bucketed = sized.withColumn("bucket", F.when(F.col("n") > LAST, F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "h"), buckets)))
        w = Window.partitionBy("source", "class", "bucket").orderBy("h", "size", "mass")
        place = F.row_number().over(w)
        # documents of a class with few left stand alone and wait for the settlement
        cut = bucketed.withColumn("cut", F.when(F.col("n") > LAST, F.floor((place - 1) / fan)).otherwise(place).cast("int"))
        item = F.struct("h", "rid", "size", "mass")
        keys = ["source", "class", "bucket", "cut"]
        groups = cut.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("items"))
        step = saved(_reduced(groups, keys, seed, level), "pivots")
        done.append(step.select(F.inline("done")))
        now = step.where("carry IS NOT NULL").select("source", "class", "carry.*")
        level += 1
    item = F.struct((-F.col("class")).alias("c"), "h", "size", "rid", "mass")
    last = now.groupBy("source").agg(F.array_sort(F.collect_list(item)).alias("items"))
    # what later documents still want, and what they could take beyond that
    total = lambda f: F.aggregate("items", F.lit(0.0), lambda a, x: a + f(x))
    wanted, room = total(lambda x: x["mass"]), total(lambda x: x["size"] - x["mass"])
    start = F.struct(F.lit(0.0).alias("owed"), wanted.alias("wanted"), room.alias("room"), F.array().cast(DONE).alias("done"))

    def settle(acc: Column, x: Column) -> Column:
        later_wanted, later_room = acc["wanted"] - x["mass"], acc["room"] - (x["size"] - x["mass"])

        def decide(owed: Column) -> Column:
            free = (x["size"] - owed <= later_wanted) & (owed <= later_room)
            drawn = unit_uniform(F.lit(seed), F.lit(-1), x["h"]) * x["size"] < owed
            take = F.when(free, drawn).otherwise(owed * 2 >= x["size"]).cast("int")
            fact = F.struct(x["rid"].alias("rid"), take.alias("one"))
            left = (owed - take * x["size"]).alias("owed")
            return F.struct(left, later_wanted.alias("wanted"), later_room.alias("room"), F.concat(acc["done"], F.array(fact)).alias("done"))

        return _let(acc["owed"] + x["mass"], decide)

    done.append(last.select(F.aggregate("items", start, settle).alias("r")).select(F.inline("r.done")))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _copies(rows: DataFrame, weights, share: float, most: int, seed: int) -> DataFrame:
    """Rows (rid, source, size, h) with source_size, target and copies."""
    with scratch(rows.sparkSession) as keep:
        goals = targets(rows, weights, share, most).select(F.col("source").alias("s_"), "source_size", "target")
        # one row a source: Spark broadcasts it only under its own size threshold
        full = rows.join(goals, F.col("source").eqNullSafe(F.col("s_"))).drop("s_")
        p = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        full = full.withColumn("base", F.floor(p).cast("long")).withColumn("mass", (p - F.col("base")) * F.col("size"))
        full = saved(full, "wanted")
        choice = rounded(full.where("size > 0 AND mass > 0 AND mass < size").select("rid", "source", "h", "size", "mass"), seed)
        copies = F.when(F.col("size") > 0, F.col("base") + F.coalesce("one", F.lit(0))).otherwise(0).cast("long")
        # row numbers compress so well that Spark would take the choices for small and broadcast them
        return keep(saved(full.join(choice.hint("merge"), "rid", "left").select(*rows.columns, "source_size", "target", copies.alias("copies")), "copies"))


def _sized(docs: DataFrame, seed: int) -> list[Column]:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return [size.alias("size"), F.xxhash64(F.lit(seed), "doc_id", size).alias("h")]


def mixture(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 0) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of ``docs`` (doc_id, source, text)."""
    rows = saved(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "source", *_sized(docs, seed)), "sizes")
    out = _copies(rows, weights, share, most, seed)
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 0) -> DataFrame:
    """``docs`` with each row as many times as the mix takes it, all columns unchanged."""
    numbered = saved(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*docs.columns).alias("row_")), "numbered")
    of = lambda c: F.col(f"row_.{c}").alias(c)
    rows = numbered.select("rid", of("doc_id"), of("source"), of("text")).select("rid", "source", *_sized(docs, seed))
    plan = _copies(saved(rows, "sizes"), weights, share, most, seed).where("copies > 0").select("rid", "copies")
    # both sides grow with the corpus, so it is a sort-merge join at any size
    each = numbered.join(plan.hint("merge"), "rid").select("row_", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy_"))
    return each.select("row_.*")


def op5_source_mixing(spark, sf_dir):
    out = mixture(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source")

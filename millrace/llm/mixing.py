"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Targets: sources in code point order (null last) weigh 5, 2, 1 and so on and share all words; a target stops
at 3 times its source's words, and what it leaves is shared anew by weight.

Rates: of all document rates that meet a source's token constraint and stay within [0, 3], those closest to 1 in relative
entropy are `min(3, exp(lambda * size / mean))`, with one multiplier a source. Newton steps on the
dual, kept inside a bracket, find all multipliers at once. Every step is one aggregation over counts
of documents by source and size, and the driver sees one number a step. Texts are read twice: to count words by source, and to give
every document its copies; what the second pass shuffles are sizes and keys.

Copies: documents of a source in order of size get whole copies so that copies so far never leave the sum of
rates so far by more than a half. What is still missing of the target, less than about one long document, is made up
by single copies of the shortest documents. A size that very many documents of a source share is dealt
into chunks by a hash of doc_id and text, so that no window holds more than about `CHUNK` documents.

A null text has size 0 and takes nothing. Documents of equal source and size are told apart by doc_id and text;
repeated rows count as often as they occur. An empty table gives no rows. Columns of any name are
carried; what this module adds is named by `MIX` and its results replace columns of their name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import cut
from millrace.session import broadcast_if_small

WEIGHTS = (5, 2, 1)
MOST = 3
CHUNK = 100_000
STEPS = 80
TOLERANCE = 1e-7
MIX = "_mix_"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def _in_parts(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> tuple[DataFrame, dict[str, Column], dict[str, float]]:
    """Rows dealt into ranges of an order, with `part`; for each of `sums` the total of all parts before a row's own,
    and the total of all.

    To the driver come the sums of a part each, of which there are as many as the session shuffles into.
    """
    ranged = cut(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    totals = ranged.groupBy("part").agg(*[F.sum(value).alias(name) for name, value in sums.items()]).orderBy("part").collect()
    before = {name: [0] for name in sums}
    for row in totals:
        for name in sums:
            before[name].append(before[name][-1] + row[name])
    upto = {
        name: F.element_at(F.create_map(*[F.lit(x) for row, n in zip(totals, held, strict=False) for x in (row["part"], n)]), F.col("part"))
        if totals
        else F.lit(0)
        for name, held in before.items()
    }
    return ranged, upto, {name: held[-1] for name, held in before.items()}


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """`sizes(source, words)` to `sid, source, words, target`. There may be any number of sources: they are ordered by ranges."""
    by_name = [F.col("source").asc_nulls_last()]
    ranged, before, _ = _in_parts(sizes, by_name, {"n": F.lit(1)})
    listed = ranged.withColumn("sid", (before["n"] + F.row_number().over(Window.partitionBy("part").orderBy(*by_name))).cast("long"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    listed = listed.drop("part").withColumn("weight", weight).withColumn("cap", (F.col("words") * most).cast("double"))
    # With sources in order of cap per weight, those before a place at their cap, the rest share what is left; the
    # right place is the one with the highest level.
    by_ratio = [F.col("ratio").asc(), F.col("sid").asc()]
    sums = {"caps": F.col("cap"), "weights": F.col("weight"), "all": F.col("words")}
    ranged, before, whole = _in_parts(listed.withColumn("ratio", F.col("cap") / F.col("weight")), by_ratio, sums)
    earlier = Window.partitionBy("part").orderBy(*by_ratio).rowsBetween(Window.unboundedPreceding, -1)
    upto = {name: before[name] + F.coalesce(F.sum(value).over(earlier), F.lit(0.0)) for name, value in sums.items() if name != "all"}
    level = (F.lit(float(whole["all"])) - upto["caps"]) / (F.lit(float(whole["weights"])) - upto["weights"])
    highest = ranged.select(level.alias("level")).agg(F.max("level")).first()[0]
    return ranged.withColumn("target", F.least("cap", F.col("weight") * F.lit(highest).cast("double"))).select("sid", "source", "words", "target")


def _rate(scaled: Column, most: int) -> Column:
    """exp of a multiplier times a scaled size, at most `most`."""
    return F.when(scaled >= F.log(F.lit(float(most))), F.lit(float(most))).otherwise(F.exp(scaled))


def multipliers(counts: DataFrame, wanted: DataFrame, most: int = MOST) -> DataFrame:
    """`sid, mean, lambda` from `counts(sid, size, n)` and `wanted(sid, words, target)`.

    lambda is null where the target is the cap (all rates are `most`) or nothing is wanted.
    """
    mean = counts.groupBy("sid").agg((F.sum(F.col("size") * F.col("n")) / F.greatest(F.sum("n"), F.lit(1))).alias("mean"))
    solvable = wanted.filter((F.col("target") > 0) & (F.col("target") < (most - 1e-9) * F.col("words")))
    state = solvable.join(mean, "sid").select(
        "sid",
        "target",
        "mean",
        F.log(F.col("target") / F.col("words")).alias("lambda"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        F.lit(None).cast("double").alias("miss"),
    )
    state = cut(state)
    scaled = F.col("lambda") * F.col("size") / F.col("mean")
    for _ in range(STEPS):
        tilted = counts.filter("size > 0").join(state, "sid").withColumn("rate", _rate(scaled, most))
        free = F.when(F.col("rate") < most, F.col("rate") * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = tilted.groupBy("sid").agg(
            F.sum(F.col("n") * F.col("size") * F.col("rate")).alias("got"),
            F.sum(F.col("n") * F.col("size") * free).alias("slope"),
        )
        at, miss = F.col("lambda"), F.log(F.col("got") / F.col("target"))
        low = F.when(miss < 0, at).otherwise(F.col("low"))
        high = F.when(miss > 0, at).otherwise(F.col("high"))
        step = at - miss * F.col("got") / F.col("slope")  # Newton on the logarithm of the dual's gradient
        moved = state.join(sums, "sid").select("sid", "target", "mean", at, low.alias("low"), high.alias("high"), miss.alias("miss"), step.alias("step"))
        inside = F.col("step").isNotNull() & ~F.isnan("step") & (F.coalesce(F.col("step") > F.col("low"), F.lit(True)))
        inside &= F.coalesce(F.col("step") < F.col("high"), F.lit(True)) & (F.abs(F.col("step") - at) <= 4 * (1 + F.abs(at)))
        halved = F.when(F.col("low").isNotNull() & F.col("high").isNotNull(), (F.col("low") + F.col("high")) / 2)
        outward = at + F.when(F.col("miss") < 0, 1.0).otherwise(-1.0) * 2 * (1 + F.abs(at))
        done = F.abs(F.col("miss")) <= TOLERANCE / 10
        to = F.when(done, at).when(inside, F.col("step")).otherwise(F.coalesce(halved, outward))
        state = cut(moved.select("sid", "target", "mean", to.alias("lambda"), "low", "high", "miss"))
        worst = state.agg(F.max(F.abs("miss"))).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    return state.select("sid", "mean", F.round("lambda", 10).alias("lambda"))


def _shares(counts: DataFrame, members: DataFrame, wanted: DataFrame, most: int) -> DataFrame:
    """`sid, size, chunk, members, copies`: how many copies the documents of a chunk share."""
    solved = multipliers(counts, wanted, most)
    rated = members.join(wanted.select("sid", "words", "target"), "sid").join(solved, "sid", "left")
    full = F.col("target") >= (most - 1e-9) * F.col("words")
    tilt = _rate(F.col("lambda") * F.col("size") / F.col("mean"), most)
    rate = F.when(F.col("size") == 0, 0.0).when(full, float(most)).otherwise(F.coalesce(tilt, F.lit(0.0)))
    rated = rated.withColumn("billionths", F.round(rate * 1e9).cast("decimal(38,0)"))
    path = Window.partitionBy("sid").orderBy("size", "chunk")
    so_far = F.sum(F.col("members") * F.col("billionths")).over(path.rowsBetween(Window.unboundedPreceding, 0))
    half = F.lit(500_000_000)
    whole = F.floor((so_far + half) / F.lit(1_000_000_000)).cast("long")
    rounded = (
        rated.withColumn("ends", whole)
        .withColumn("copies", F.col("ends") - F.coalesce(F.lag("ends").over(path), F.lit(0)))
        .withColumn("copies", F.least(F.greatest("copies", F.lit(0)), F.col("members") * most))
    )
    source = Window.partitionBy("sid")
    short = F.round(F.col("target") - F.sum(F.col("copies") * F.col("size")).over(source)).cast("long")
    rounded = rounded.withColumn("short", short)
    room = F.when(F.col("short") > 0, F.col("members") * most - F.col("copies")).otherwise(F.col("copies"))
    rounded = rounded.withColumn("room", F.when(F.col("size") > 0, F.least(room, F.col("members"))).otherwise(0))
    used = F.coalesce(
        F.sum(F.col("room") * F.col("size")).over(path.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    spare = F.greatest(F.abs("short") - used, F.lit(0))
    more = F.least("room", F.floor(spare / F.greatest("size", F.lit(1))).cast("long"))
    return rounded.withColumn("more", more).select(
        "sid", "size", "chunk", "members", (F.col("copies") + F.signum("short").cast("long") * F.col("more")).alias("copies")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of `docs(doc_id, text, source)` with `size, source_size, target, copies, taken`."""
    added = ("size", "source_size", "target", "copies", "taken")
    rows = docs.drop(*[c for c in docs.columns if c in added])
    carried = rows.columns
    rows = rows.withColumn(f"{MIX}size", word_count(F.col("text"))).withColumn(f"{MIX}key", F.xxhash64("doc_id", "text"))
    tally = cut(
        rows.groupBy("source", F.col(f"{MIX}size").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    )
    wanted = cut(targets(tally.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words")), weights, most))
    counts = tally.join(wanted.select("sid", F.col("source").alias("_s")), F.col("source").eqNullSafe(F.col("_s")))
    counts = counts.select("sid", "size", "n", F.ceil(F.col("n") / F.lit(CHUNK)).cast("int").alias("chunks"))
    counts = cut(counts)
    # members of each chunk are known only by counting where there are several
    place = F.pmod(F.xxhash64(f"{MIX}key", F.lit(11)), F.col(f"{MIX}chunks")).cast("int")
    known = wanted.select(
        F.col("sid").alias(f"{MIX}sid"), F.col("source").alias(f"{MIX}source"), F.col("words").alias("source_size"), "target"
    )
    wide = counts.filter("chunks > 1").select(
        F.col("sid").alias(f"{MIX}sid"), F.col("size").alias(f"{MIX}size"), F.col("chunks").alias(f"{MIX}chunks")
    )
    rows = rows.join(broadcast_if_small(known), F.col("source").eqNullSafe(F.col(f"{MIX}source")))
    rows = rows.join(wide, [f"{MIX}sid", f"{MIX}size"], "left").withColumn(f"{MIX}chunks", F.coalesce(f"{MIX}chunks", F.lit(1)))
    rows = rows.withColumn(f"{MIX}chunk", place)
    one = counts.filter("chunks = 1").select("sid", "size", F.lit(0).alias("chunk"), F.col("n").alias("members"))
    if wide.isEmpty():
        members = one
    else:
        several = rows.filter(f"{MIX}chunks > 1").groupBy(f"{MIX}sid", f"{MIX}size", f"{MIX}chunk").count()
        members = one.unionAll(several.toDF("sid", "size", "chunk", "members"))
    shares = cut(_shares(counts, members, wanted, most))
    here = Window.partitionBy(f"{MIX}sid", f"{MIX}size", f"{MIX}chunk").orderBy("doc_id", f"{MIX}key")
    ranked = rows.withColumn(f"{MIX}rank", F.row_number().over(here))
    shares = shares.select(
        F.col("sid").alias(f"{MIX}sid"),
        F.col("size").alias(f"{MIX}size"),
        F.col("chunk").alias(f"{MIX}chunk"),
        F.col("members").alias(f"{MIX}members"),
        F.col("copies").alias(f"{MIX}copies"),
    )
    joined = ranked.join(shares, [f"{MIX}sid", f"{MIX}size", f"{MIX}chunk"])
    upto = lambda k: F.floor(k * F.col(f"{MIX}copies") / F.col(f"{MIX}members"))
    copies = (upto(F.col(f"{MIX}rank")) - upto(F.col(f"{MIX}rank") - 1)).cast("long")
    return joined.withColumn("copies", copies).select(
        *[F.col(f"`{c}`") for c in carried],
        F.col(f"{MIX}size").alias("size"),
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        "copies",
        (F.col("copies") * F.col(f"{MIX}size")).alias("taken"),
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it."""
    taken = mix(docs, weights, most).filter("copies > 0")
    again = taken.withColumn(f"{MIX}copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return again.select(*[F.col(f"`{c}`") for c in docs.columns])

"""Entity F0.5, one-owner rule, threshold sweep, recall and volume reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Thresholds of the sweep: 0.05 to 0.95, in the doubles that repeated steps of 0.05 from 0.05 give.
GRID = [0.05 + 0.05 * i for i in range(19)]


def f_half(tp: Column, predicted: Column, true: Column) -> Column:
    """1 if nothing is predicted and nothing true; 0 without a hit; else 1.25 p r / (0.25 p + r)."""
    p, r = F.try_divide(tp, predicted), F.try_divide(tp, true)
    return F.when((predicted == 0) & (true == 0), 1.0).when(F.coalesce(tp, F.lit(0)) == 0, 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


def one_owner(pairs: DataFrame) -> DataFrame:
    """Of the rows of a candidate the one of highest prob stays; ties go to the smaller S1 id."""
    order = Window.partitionBy("candidate_entity_id").orderBy(F.desc("prob"), "source1_entity_id")
    return pairs.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def sweep(pairs: DataFrame, s1: DataFrame | None = None, truth: DataFrame | None = None, grid: list[float] = GRID) -> DataFrame:
    """threshold, owner_exclusive, macro_f05, n_s1 for every threshold and mode, in one aggregation.

    pairs: source1_entity_id, candidate_entity_id, prob, label.  Without ``s1`` and ``truth`` the S1 records are those
    with candidates and truth is what the candidates retain (candidate scope).  With them every S1 record counts, and all
    its true matches (full scope).
    """
    spark = pairs.sparkSession
    if s1 is None:
        base = pairs.groupBy("source1_entity_id").agg(F.sum("label").alias("n_true"))
    else:
        counts = truth.distinct().groupBy("source1_entity_id").agg(F.count("*").alias("n_true"))
        base = s1.select("source1_entity_id").distinct().join(counts, "source1_entity_id", "left").na.fill(0, ["n_true"])
    # The owner of a candidate is its pair of highest probability, at any threshold that it reaches.  Pairs become counts by
    # the number of grid points they reach before those are spread over the grid.
    order = Window.partitionBy("candidate_entity_id").orderBy(F.desc("prob"), "source1_entity_id")
    owned = pairs.withColumn("owner", F.row_number().over(order) == 1)
    level = F.size(F.filter(F.array(*map(F.lit, grid)), lambda t: F.col("prob") >= t))
    counted = owned.groupBy("source1_entity_id", level.alias("level")).agg(F.sum("label").alias("t0"), F.count("*").alias("p0"), F.sum(F.when(F.col("owner"), F.col("label")).otherwise(0)).alias("t1"), F.count_if("owner").alias("p1")).where("level > 0")
    modes = F.array(*[F.struct(F.lit(bool(m)).alias("owner_exclusive"), F.col(f"t{m}").alias("tp"), F.col(f"p{m}").alias("predicted")) for m in (0, 1)])
    spread = counted.select("source1_entity_id", F.explode(F.slice(F.array(*map(F.lit, grid)), F.lit(1), F.col("level"))).alias("threshold"), modes.alias("modes")).select("source1_entity_id", "threshold", F.inline("modes"))
    found = spread.groupBy("source1_entity_id", "threshold", "owner_exclusive").agg(F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted")).where("predicted > 0").join(base, "source1_entity_id")
    # S1 records without a prediction at a threshold score 1 if they have no truth, else 0: they need no row.
    scored = found.withColumn("f", f_half(F.col("tp"), F.col("predicted"), F.col("n_true")))
    sums = scored.groupBy("threshold", "owner_exclusive").agg(F.sum("f").alias("f"), F.sum(F.when(F.col("n_true") == 0, 1).otherwise(0)).alias("false_alarms"))
    whole = base.agg(F.count("*").alias("n_s1"), F.coalesce(F.sum(F.when(F.col("n_true") == 0, 1).otherwise(0)), F.lit(0)).alias("singletons"))
    points = spark.createDataFrame([(float(t), m) for t in grid for m in (False, True)], "threshold double, owner_exclusive boolean")
    rows = points.join(sums, ["threshold", "owner_exclusive"], "left").join(F.broadcast(whole)).na.fill(0)
    return rows.select(F.round("threshold", 2).alias("threshold"), "owner_exclusive", F.try_divide(F.col("f") + F.col("singletons") - F.col("false_alarms"), "n_s1").alias("macro_f05"), "n_s1")


def best(swept: DataFrame) -> DataFrame:
    """The best row: the lowest threshold on ties, and the one-owner mode on ties between modes."""
    return swept.orderBy(F.desc("macro_f05"), F.desc("owner_exclusive"), "threshold").limit(1)


def volume(candidates: DataFrame) -> DataFrame:
    """measure, mean, median, p95 and share of zeros of candidates before and after pruning."""
    sizes = candidates.select(F.explode(F.array(F.struct(F.lit("before_prune").alias("measure"), F.col("n_before_prune").alias("n")), F.struct(F.lit("after_prune").alias("measure"), F.size("candidate_entity_ids").cast("bigint").alias("n")))).alias("x")).select("x.*")
    return sizes.groupBy("measure").agg(F.avg("n").alias("mean"), F.median("n").alias("median"), F.percentile("n", F.lit(0.95)).alias("p95"), F.avg((F.col("n") == 0).cast("int")).alias("zero_share"))


def recall(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: macro and micro recall, share of S1 with recall below 1, and share of singletons with any candidate."""
    pairs = candidates.select("source1_entity_id", F.explode("candidate_entity_ids").alias("match_id"))
    true = truth.select("source1_entity_id", "match_id").distinct()
    hits = true.join(pairs, ["source1_entity_id", "match_id"]).groupBy("source1_entity_id").agg(F.count("*").alias("hit"))
    n = true.groupBy("source1_entity_id").agg(F.count("*").alias("n_true"))
    rows = candidates.select("source1_entity_id", (F.size("candidate_entity_ids") > 0).alias("any")).join(n, "source1_entity_id", "left").join(hits, "source1_entity_id", "left").na.fill(0, ["n_true", "hit"])
    matched, alone = F.col("n_true") > 0, F.col("n_true") == 0
    return rows.agg(
        F.avg(F.when(matched, F.try_divide("hit", "n_true"))).alias("macro_recall"),
        F.try_divide(F.sum(F.when(matched, F.col("hit"))), F.sum("n_true")).alias("micro_recall"),
        F.avg(F.when(matched, (F.col("hit") < F.col("n_true")).cast("int"))).alias("share_below_one"),
        F.avg(F.when(alone, F.col("any").cast("int"))).alias("singletons_with_candidates"),
        F.count_if(matched).alias("n_with_truth"), F.count_if(alone).alias("n_singletons"),
    )

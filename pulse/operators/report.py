"""Distributions and factual summaries per platform.

Everything aggregates first (``groupBy`` with map-side combine) and only the
aggregated rows - at most five labels per platform - are windowed, ranked or
collected. Reports exist only for groups that have rows (A13).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions.labels import label_colour, label_to_ordinal
from pulse.functions.time import iso_utc
from pulse.operators.sequence import number_rows
from pulse.operators.threads import item_texts
from pulse.schema import LABELS

PLATFORM = ["social_media"]
EXTREMES = [LABELS[0], LABELS[-1]]
MAJORITY_SHARE = 50.0


def share(n: Column, total: Column) -> Column:
    """Percentage with one decimal, ties to even on the decimal value."""
    return F.bround((n * 100).cast("double") / total.cast("double"), 1)


def label_counts(labelled: DataFrame, by: list[str] = PLATFORM) -> DataFrame:
    """A1: count per label per group; only labels present."""
    return labelled.groupBy(*by, "sentiment").agg(F.count(F.lit(1)).alias("n"))


def label_share(labelled: DataFrame, by: list[str] = PLATFORM) -> DataFrame:
    """A2: count, share (%) and ordinal per label per group."""
    counts = label_counts(labelled, by)
    total = F.sum("n").over(Window.partitionBy(*by))
    return (counts.withColumn("total", total)
            .withColumn("share", share(F.col("n"), F.col("total")))
            .withColumn("ordinal", label_to_ordinal(F.col("sentiment"))))


def item_series(labelled: DataFrame, order_cols: list[str], by: list[str] = PLATFORM) -> DataFrame:
    """A3: ``Item i`` series per group in arrival order -> ordinal, colour.

    Documents that carry the ``item`` number they got when they were labelled are taken
    as they are: no sort, no checkpoint of the store.
    """
    if "item" in labelled.columns:
        numbered = labelled.select(*by, "item", "content_id", "sentiment")
    else:
        cols = list(dict.fromkeys([*by, *order_cols, "content_id", "sentiment"]))
        numbered = number_rows(labelled.select(*cols), by, order_cols, "item")
    return numbered.select(*by, "item", F.concat(F.lit("Item "), F.col("item").cast("string")).alias("item_label"),
                           "content_id", "sentiment",
                           label_to_ordinal(F.col("sentiment")).alias("ordinal"),
                           label_colour(F.col("sentiment")).alias("colour"))


def texts_by_label(labelled: DataFrame, by: list[str] = PLATFORM) -> DataFrame:
    """A4 + D8: per label, how many texts and how long their space-joined
    concatenation is - without ever building that string. Groups whose
    texts are all blank do not appear. ``labelled`` holds items, or one row per
    text of an item (with a ``text`` column)."""
    texts = labelled if "text" in labelled.columns else labelled.select(
        *by, "content_id", "sentiment", F.explode(item_texts(labelled)).alias("text"))
    agg = texts.groupBy(*by, "sentiment").agg(
        F.count_distinct("content_id").alias("n_items"),
        F.count(F.lit(1)).alias("n_texts"),
        F.sum(F.length("text")).cast("bigint").alias("text_chars"))
    return (agg.withColumn("joined_chars", F.col("text_chars") + F.col("n_texts") - 1)
            .withColumn("ordinal", label_to_ordinal(F.col("sentiment"))))


def _ranked_labels(cond: Column) -> Column:
    """Labels satisfying ``cond``, in scale order, comma-joined."""
    picked = F.collect_list(F.when(cond, F.struct(F.col("ordinal"), F.col("sentiment"))))
    return F.array_join(F.transform(F.array_sort(picked), lambda x: x.getField("sentiment")), ", ")


def per_group_profile(shares: DataFrame, by: list[str] = PLATFORM) -> DataFrame:
    """One aggregate pass over the share table (at most five rows per group)
    giving everything A8-A10 need, so the labelled data is read once."""
    w = Window.partitionBy(*by)
    ranked = (shares.withColumn("_max", F.max("n").over(w))
              .withColumn("_min", F.min("n").over(w)))
    is_extreme = F.col("sentiment").isin(EXTREMES)
    scale = F.array(*[F.lit(x) for x in LABELS])
    agg = ranked.groupBy(*by).agg(
        _ranked_labels(F.col("n") == F.col("_max")).alias("dominant"),
        F.max("share").alias("dominant_share"),
        _ranked_labels(F.col("n") == F.col("_min")).alias("least"),
        F.min("share").alias("least_share"),
        F.first("total").alias("total"),
        F.collect_set("sentiment").alias("_present"),
        F.sum(F.when(is_extreme, F.col("share")).otherwise(F.lit(0.0))).alias("_extreme"),
        F.count_if(is_extreme).alias("_n_extremes"),
        F.sum(F.when(F.col("sentiment") == LABELS[0], F.col("share")).otherwise(0.0)).alias("very_negative_share"),
        F.sum(F.when(F.col("sentiment") == LABELS[-1], F.col("share")).otherwise(0.0)).alias("very_positive_share"),
        F.array_sort(F.collect_list(F.struct((-F.col("share")).alias("k"), F.col("ordinal"),
                                             F.col("sentiment"), F.col("share")))).alias("_dist"),
    )
    return (agg.withColumn("peak_share", F.col("dominant_share"))
            .withColumn("absent", F.array_join(F.array_except(scale, F.col("_present")), ", "))
            .withColumn("extreme_share", F.round(F.col("_extreme"), 1))
            .withColumn("both_extremes", F.col("_n_extremes") == 2)
            .withColumn("majority", F.col("peak_share") > MAJORITY_SHARE))


def dominant_and_least(labelled: DataFrame, by: list[str] = PLATFORM) -> DataFrame:
    """Most and least common label among those present; ties together."""
    return dominant_from_shares(label_share(labelled, by), by)


def dominant_from_shares(shares: DataFrame, by: list[str] = PLATFORM) -> DataFrame:
    return per_group_profile(shares, by).select(
        *by, "dominant", "dominant_share", "least", "least_share", "total")


def distribution_insights(labelled: DataFrame, by: list[str] = PLATFORM) -> DataFrame:
    """Peak share, absent labels, extremes and polarisation flags."""
    return insights_from_shares(label_share(labelled, by), by)


def insights_from_shares(shares: DataFrame, by: list[str] = PLATFORM) -> DataFrame:
    return per_group_profile(shares, by).select(
        *by, "peak_share", "absent", "extreme_share", "very_negative_share",
        "very_positive_share", "both_extremes", "majority")


def render_summary(labelled: DataFrame, by: list[str] = PLATFORM) -> DataFrame:
    """A10: a four-part factual summary per group (distribution, dominant
    and least common, peaks, insights), from one pass over the share table."""
    j = per_group_profile(label_share(labelled, by), by)
    dist = F.array_join(F.transform("_dist", lambda x: F.format_string(
        "%s %.1f%%", x.getField("sentiment"), x.getField("share"))), ", ")
    absent = F.when(F.col("absent") == "", F.lit("no label is absent")) \
        .otherwise(F.concat(F.lit("absent: "), F.col("absent")))
    text = F.concat_ws(" ",
        F.format_string("1. Distribution over %d items: %s.", F.col("total"), dist),
        F.format_string("2. Most common: %s; least common: %s.", F.col("dominant"), F.col("least")),
        F.format_string("3. Peak: %s at %.1f%%%s; %s.", F.col("dominant"), F.col("peak_share"),
                        F.when(F.col("majority"), F.lit(" (majority)")).otherwise(F.lit("")), absent),
        F.format_string("4. Extremes: Very Negative %.1f%%, Very Positive %.1f%%%s.",
                        F.col("very_negative_share"), F.col("very_positive_share"),
                        F.when(F.col("both_extremes"), F.lit(", both present (polarised)"))
                         .otherwise(F.lit(""))),
    )
    return j.select(*by, text.alias("summary"))


def phase_of(ts: Column, phases: list[tuple[str, str, str]]) -> Column:
    """Phase name of an instant: first phase with start <= ts < end."""
    expr = None
    for name, start, end in phases:
        cond = (ts >= F.to_timestamp(F.lit(start))) & (ts < F.to_timestamp(F.lit(end)))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def tag_phases(rows: DataFrame, phases: DataFrame, time_col: str = "publish_date") -> DataFrame:
    """A11 with phases as a table: ``rows`` with the ``phase`` of their instant, or null.

    ``phases`` has ``phase, start, end, rank``; intervals are half-open and of several that
    hold an instant the least rank wins. An interval lies in the one or two cells of its
    own width (a power of two), so phases and instants meet by equality of (width, cell);
    an instant is looked up once per width that occurs, 63 at most. Only distinct
    instants are joined with the phases.
    """
    us = F.unix_micros
    length = us("end") - us("start")
    spans = phases.where(length > 0).withColumn("level", F.ceil(F.log2(length.cast("double"))).cast("int"))
    cells = F.expr("sequence(shiftright(unix_micros(start), level), shiftright(unix_micros(end) - 1, level))")
    spans = spans.withColumn("cell", F.explode(cells))
    levels = sorted(r[0] for r in spans.select("level").distinct().collect())
    at = F.col(time_col)
    probes = rows.select(at.alias("_at")).where("_at is not null").distinct().withColumn(
        "level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>")))
    probes = probes.withColumn("cell", F.expr("shiftright(unix_micros(_at), level)"))
    inside = (F.col("start") <= F.col("_at")) & (F.col("_at") < F.col("end"))
    found = probes.join(spans, ["level", "cell"]).where(inside).groupBy("_at").agg(F.min_by("phase", "rank").alias("phase"))
    return rows.join(found, at == F.col("_at"), "left").drop("_at")


def phase_shares(labelled: DataFrame, phases: DataFrame, by: list[str] = PLATFORM) -> DataFrame:
    """Label shares per phase of a table of phases, a row per phase and label."""
    tagged = tag_phases(labelled, phases).where("phase is not null")
    return label_share(tagged, [*by, "phase"]).select(*by, "phase", "sentiment", "n", "share")


def compare_phases(labelled: DataFrame, phases: list[tuple[str, str, str]],
                   by: list[str] = PLATFORM) -> DataFrame:
    """Label shares per event phase side by side, and their change.

    ``phases`` = [(name, start ISO, end ISO)], half-open intervals; an instant
    in several belongs to the first one listed. The list is evaluated as one
    CASE expression, whatever its length.
    """
    names = [p[0] for p in phases]
    tagged = labelled.withColumn("phase", phase_of(F.col("publish_date"), phases)).filter(F.col("phase").isNotNull())
    shares = label_share(tagged, [*by, "phase"])
    wide = shares.groupBy(*by, "sentiment").pivot("phase", names).agg(F.first("share"))
    out = wide
    for nm in names:
        out = out.withColumn(f"share_{nm}", F.coalesce(F.col(nm), F.lit(0.0))).drop(nm)
    if len(names) >= 2:
        out = out.withColumn("delta", F.round(F.col(f"share_{names[-1]}") - F.col(f"share_{names[0]}"), 1))
    return out


def cycle_metrics(rows: DataFrame, time_col: str, every: str = "1 day",
                  by: list[str] | None = None) -> DataFrame:
    """Items collected per scope per run window."""
    by = by or ["scope"]
    w = F.window(F.col(time_col), every)
    return (rows.groupBy(*by, w.alias("_w"))
            .agg(F.count(F.lit(1)).alias("n_items"),
                 F.count_distinct("content_id").alias("n_distinct"))
            .select(*by, iso_utc(F.col("_w.start")).alias("cycle_start"), "n_items", "n_distinct"))


def sentiment_over_time(labelled: DataFrame, width: str = "1 hour",
                        by: list[str] = PLATFORM) -> DataFrame:
    """Label counts per time window of ``publish_date``."""
    return (labelled.groupBy(F.window("publish_date", width).alias("_w"), *by, "sentiment")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(iso_utc(F.col("_w.start")).alias("window_start"), *by, "sentiment", "n"))


def sentiment_by_place(labelled: DataFrame) -> DataFrame:
    """Label counts per place (geo tag, else profile location)."""
    place = F.coalesce(F.col("geo_location"), F.col("user_location"), F.lit("unknown"))
    return (labelled.groupBy(place.alias("place"), "social_media", "sentiment")
            .agg(F.count(F.lit(1)).alias("n")))

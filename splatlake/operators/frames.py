"""Frame sequences: quality gates, adaptive selection, input scoring, chunking."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.order_stats import evenly_spaced, group_stats, ranked
from ..functions.scalars import finite, problem_list, round_half_even
from ..functions.scaling import attach, durable
from .pixels import _array, channels_of, consecutive_diff, downscale_gray, frame_distance, frame_health, mask_stats

# Default exposure band and the factors of the relaxing passes (sharpness, difference).
EXPOSURE = dict(min_brightness=8.0, max_brightness=247.0, min_contrast=4.0, max_clipped_ratio=0.92)
RELAX = ((1.0, 1.0), (0.65, 0.75), (0.40, 0.50), (0.20, 0.25))
DEFAULT_TARGET = 48
DEFAULT_SPAN = 0.80
GUESSES = 3  # rounds of the near-duplicate gate before chains are walked to their end
GROUP_BYTES = 128 << 20  # pixels that one chunk of the near-duplicate gate holds at most


# ---- gates -----------------------------------------------------------------

def exposure_ok(min_brightness=8.0, max_brightness=247.0, min_contrast=4.0, max_clipped_ratio=0.92) -> Column:
    return (F.col("brightness").between(min_brightness, max_brightness) & (F.col("contrast") >= min_contrast)
            & (F.col("clipped_ratio") <= max_clipped_ratio))


def exposure_gate(metrics: DataFrame, **band) -> DataFrame:
    return metrics.filter(exposure_ok(**band))


def blur_gate(metrics: DataFrame, min_sharpness: float) -> DataFrame:
    return metrics.filter(F.col("sharpness") >= min_sharpness)


def threshold_ladder(min_sharpness: float, min_frame_diff: float, adaptive: bool = True) -> list[tuple[int, str, float, float]]:
    """(order, name, sharpness, difference) of the strict pass and the relaxing ones, equal pairs once."""
    ladder, seen = [], set()
    for i, (fs, fd) in enumerate(RELAX if adaptive else RELAX[:1]):
        pair = max(0.0, min_sharpness * fs), max(0.0, min_frame_diff * fd)
        mark = tuple(round(v, 6) for v in pair)
        if mark not in seen:
            seen.add(mark)
            ladder.append((i, "strict" if i == 0 else f"coverage_{i}", *pair))
    return ladder


def ladder_columns(requests: DataFrame, adaptive: bool = True, sharp: str = "min_sharpness", diff: str = "min_frame_diff") -> DataFrame:
    """Table form of the ladder: one row per request and distinct pass."""
    steps = F.array(*[F.struct(F.lit(i).alias("pass_no"), F.lit("strict" if i == 0 else f"coverage_{i}").alias("pass"),
                               F.greatest(F.lit(0.0), F.col(sharp) * fs).alias("pass_sharpness"), F.greatest(F.lit(0.0), F.col(diff) * fd).alias("pass_diff"))
                      for i, (fs, fd) in enumerate(RELAX if adaptive else RELAX[:1])])
    rows = requests.withColumn("_l", steps)
    same = lambda a, b: (round_half_even(a["pass_sharpness"], 6) == round_half_even(b["pass_sharpness"], 6)) & (round_half_even(a["pass_diff"], 6) == round_half_even(b["pass_diff"], 6))
    fresh = F.filter("_l", lambda a: ~F.exists(F.col("_l"), lambda b: (b["pass_no"] < a["pass_no"]) & same(a, b)))
    return rows.withColumn("_l", F.explode(fresh)).select("*", "_l.*").drop("_l")


def _pass_array(ladder) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("pass_no"), F.lit(name).alias("pass"), F.lit(float(s)).alias("min_sharpness"), F.lit(float(d)).alias("min_frame_diff"))
                     for n, name, s, d in ladder])


# ---- near-duplicate gate ---------------------------------------------------

def near_dup_gate(frames: DataFrame, ladder, keys=("scene_id",), order: str = "raw_index", data: str = "pixels", chunk: int = 256,
                  materialized: bool = False) -> DataFrame:
    """Greedy gate per pass: keep a frame that differs enough from the last kept one.

    The choice is a chain along the sequence, so it is replayed in chunks of at most
    `chunk` frames (fewer where the largest frame would make a chunk exceed GROUP_BYTES), all
    at once.  Each chunk starts from a guess of the frame kept before it; chunks whose
    guess proves wrong run again, until every start is right, so that the result is that of
    one walk over the whole sequence.  A chunk that keeps nothing is taken to keep nothing
    from the right start either, so still stretches settle together, whatever their length.
    Chains that have not met their right start after GUESSES rounds are walked to their end from the first
    wrong chunk on: one sorted pass per scene and pass, which carries one frame, so the number of jobs does not grow with the sequence.

    `frames` needs the sharpness metric; rows below a pass's threshold are no part of
    its chain.  Frames with `channels` are compared over all of them; frame_distance says how
    frames of different shapes compare.  Returns (keys, order, pass_no, kept, frame_diff) for the others.
    Every round reads the frames, so they are written out first unless `materialized`.
    """
    keys = list(keys)
    ladder = list(ladder)
    slim = frames.select(*keys, order, "sharpness", "width", "height", channels_of(frames).alias("channels"), F.col(data).alias("pixels"))
    lowest = min(s for _, _, s, _ in ladder)
    slim = slim.filter(F.col("sharpness") >= lowest)
    if not materialized:
        slim = durable(slim)
    largest = slim.agg(F.max(F.col("width").cast("long") * F.col("height") * F.col("channels"))).first()[0] or 1
    slim = slim.withColumn("_chunk", F.floor(F.col(order) / max(1, min(chunk, GROUP_BYTES // largest))))
    key_fields = [f for f in slim.schema.fields if f.name in keys]
    out = T.StructType([*key_fields, T.StructField("_chunk", T.LongType()), T.StructField(order, T.LongType()), T.StructField("pass_no", T.IntegerType()),
                        T.StructField("kept", T.BooleanType()), T.StructField("frame_diff", T.DoubleType()), T.StructField("_start", T.LongType()),
                        T.StructField("_end", T.LongType())])

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        images = [_array(*shot) for shot in zip(pdf["pixels"], pdf["width"], pdf["height"], pdf["channels"])]
        at, sharp, role = pdf[order].to_numpy(), pdf["sharpness"].to_numpy(), pdf["_for"].to_numpy()
        head = {k: pdf[k].iloc[0] for k in keys}
        number = int(pdf.loc[pdf["_for"] < 0, "_chunk"].iloc[0])
        rows = []
        for pass_no, _, min_sharp, min_diff in ladder:
            given = np.flatnonzero(role == pass_no)
            last = int(given[0]) if len(given) else None
            start, end = int(at[last]) if last is not None else -1, -1
            for i in np.flatnonzero((role < 0) & (sharp >= min_sharp)):
                diff = None if last is None else frame_distance(images[last], images[i])
                keep = diff is None or diff >= min_diff
                rows.append([int(at[i]), pass_no, keep, diff, start])
                if keep:
                    last, end = int(i), int(at[i])
            rows.append([-1, pass_no, False, None, start, end])  # the chunk's own summary
        table = pd.DataFrame([r + [-1] * (6 - len(r)) for r in rows], columns=[order, "pass_no", "kept", "frame_diff", "_start", "_end"])
        for k, v in head.items():
            table[k] = v
        table["_chunk"] = number
        return table[[f.name for f in out.fields]]

    passes = F.array(*[F.lit(n) for n, *_ in ladder])
    parts = slim.select(*keys, "_chunk").distinct()
    # first guess: the last sharp enough frame of the chunk before
    tails = slim.withColumn("pass_no", F.explode(_pass_array(ladder))).filter(F.col("sharpness") >= F.col("pass_no.min_sharpness"))
    tails = tails.groupBy(*keys, "_chunk", F.col("pass_no.pass_no").alias("pass_no")).agg(F.max(order).alias("_last"))
    in_order = Window.partitionBy(*keys, "pass_no").orderBy("_chunk")
    spots = parts.withColumn("pass_no", F.explode(passes)).join(tails, [*keys, "_chunk", "pass_no"], "left")
    starts = durable(spots.withColumn("_need", F.last("_last", True).over(in_order.rowsBetween(Window.unboundedPreceding, -1)))
                     .select(*keys, "_chunk", "pass_no", F.coalesce("_need", F.lit(-1)).cast("bigint").alias("_need")))
    done, todo, rounds = None, starts, 0
    while True:
        if rounds == GUESSES:
            return _walk_on(slim, done, todo, ladder, keys, order)
        rounds += 1
        runs = todo.select(*keys, "_chunk").distinct()
        body = slim.join(runs, [*keys, "_chunk"], "left_semi").withColumn("_for", F.lit(-1))
        givens = starts.join(runs, [*keys, "_chunk"], "left_semi").filter("_need >= 0").withColumnRenamed("_chunk", "_to")
        lead = (slim.withColumnRenamed(order, "_need").join(givens, [*keys, "_need"])
                .select(*keys, F.col("_need").alias(order), "sharpness", "width", "height", "channels", "pixels", F.col("_to").alias("_chunk"), F.col("pass_no").alias("_for")))
        fresh = body.unionByName(lead).groupBy(*keys, "_chunk").applyInPandas(walk, out)
        if done is not None:
            fresh = fresh.unionByName(done.join(runs, [*keys, "_chunk"], "left_anti"))
        done = durable(fresh)
        ends = done.filter(F.col(order) == -1)
        # the last frame that any earlier chunk kept; -1 means nothing kept so far
        earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.last(F.when(F.col("_end") >= 0, F.col("_end")), True).over(earlier), F.lit(-1))
        wanted = durable(ends.withColumn("_need", before).select(*keys, "_chunk", "pass_no", "_need", "_start"))
        todo = wanted.filter("_need <> _start")
        if todo.isEmpty():
            return done.filter(F.col(order) >= 0).select(*keys, F.col(order).cast("int").alias(order), "pass_no", "kept", "frame_diff")
        starts = wanted.drop("_start")


def _walk_on(slim: DataFrame, done: DataFrame, todo: DataFrame, ladder, keys, order: str) -> DataFrame:
    """Results of settled chunks, and of the rest by a walk over frames in order that holds one frame."""
    first = durable(todo.groupBy(*keys, "pass_no").agg(F.min_by(F.struct("_chunk", "_need"), "_chunk").alias("f")).select(*keys, "pass_no", F.col("f._chunk").alias("_from"), F.col("f._need").alias("_lead")))
    limits = {n: (float(s), float(d)) for n, _, s, d in ladder}
    sharp = F.coalesce(*[F.when(F.col("pass_no") == n, F.lit(s)) for n, (s, _) in limits.items()])
    lead = F.col(order) == F.col("_lead")
    rows = attach(slim, first, keys, "inner").filter(((F.col("_chunk") >= F.col("_from")) & (F.col("sharpness") >= sharp)) | lead)
    rows = rows.select(*keys, "pass_no", F.col(order).cast("long").alias(order), lead.alias("_is_lead"), "pixels", "width", "height", "channels")
    out = T.StructType([*[f for f in rows.schema.fields if f.name in (*keys, "pass_no", order)], T.StructField("kept", T.BooleanType()), T.StructField("frame_diff", T.DoubleType())])

    def carry(batches):
        group, last = None, None
        for pdf in batches:
            found = []
            for row in zip(*[pdf[c] for c in (*keys, "pass_no", order, "_is_lead", "pixels", "width", "height", "channels")]):
                *own, at, leads, data, width, height, channels = row
                if own != group:
                    group, last = own, None
                image = _array(data, width, height, channels)
                diff = None if last is None else frame_distance(last, image)
                keep = leads or diff is None or diff >= limits[own[-1]][1]
                if not leads:
                    found.append((*own, at, keep, diff))
                if keep:
                    last = image
            yield pd.DataFrame(found, columns=[*keys, "pass_no", order, "kept", "frame_diff"])

    walked = rows.repartition(*keys, "pass_no").sortWithinPartitions(*keys, "pass_no", order).mapInPandas(carry, out)
    settled = done.filter(F.col(order) >= 0).join(first, [*keys, "pass_no"], "left").filter("_from IS NULL OR _chunk < _from")
    shown = [*keys, F.col(order).cast("int").alias(order), "pass_no", "kept", "frame_diff"]
    return settled.select(*shown).unionByName(walked.select(*shown))


# ---- passes ----------------------------------------------------------------

def filter_frames(frames: DataFrame, ladder, max_frames: int, band: dict | None = None, keys=("scene_id",), order: str = "raw_index",
                  data: str | None = "pixels", chunk: int = 256) -> DataFrame:
    """Fate of every frame in every pass: `reason` is kept, bad_exposure, blur, near_duplicate or thinned.

    `frames` carries the health metrics, measured once for all passes. Without pixel
    `data` the near-duplicate gate is skipped.
    """
    keys, ladder = list(keys), list(ladder)
    good = exposure_ok(**(band or EXPOSURE))
    if data:  # decoded and measured once, then read by the metric table and by every round of the chain
        frames = durable(frames.select(*keys, order, "brightness", "contrast", "clipped_ratio", "sharpness", "width", "height", channels_of(frames).alias("channels"), data))
    metrics = frames.select(*keys, order, "brightness", "contrast", "clipped_ratio", "sharpness", good.alias("_good"))
    rows = metrics.withColumn("_p", F.explode(_pass_array(ladder))).select("*", "_p.*").drop("_p")
    if data:
        chain = near_dup_gate(frames.filter(good), ladder, keys, order, data, chunk, materialized=True)
        rows = rows.join(chain, [*keys, order, "pass_no"], "left")
        duplicate = ~F.coalesce(F.col("kept"), F.lit(True))
    else:
        rows = rows.withColumn("frame_diff", F.lit(None).cast("double"))
        duplicate = F.lit(False)
    reason = (F.when(~F.col("_good"), "bad_exposure").when(F.col("sharpness") < F.col("min_sharpness"), "blur")
              .when(duplicate, "near_duplicate").otherwise("kept"))
    rows = rows.withColumn("reason", reason).drop("kept", "_good")
    return temporal_thin(rows, max_frames, [*keys, "pass_no"], order)


def temporal_thin(rows: DataFrame, max_frames: int, keys=("scene_id", "pass_no"), order: str = "raw_index") -> DataFrame:
    """Of the kept rows leave at most `max_frames` evenly spaced ones; the others become thinned."""
    keys = list(keys)
    kept = F.col("reason") == "kept"
    # kept rows first, so their positions are 1..n
    numbered = ranked(rows.withColumn("_k", F.when(kept, 0).otherwise(1)), keys, ["_k", order], "_at")
    sizes = rows.groupBy(*keys).agg(F.count_if(kept).alias("_n"))
    numbered = attach(numbered, sizes, keys)
    stays = evenly_spaced(F.col("_at") - 1, "_n", max_frames, F.rint)
    if max_frames <= 0:
        stays = F.lit(False)
    return numbered.withColumn("reason", F.when(kept & ~stays, "thinned").otherwise(F.col("reason"))).drop("_k", "_at", "_n")


def extraction_stats(fates: DataFrame, keys=("scene_id",), order: str = "raw_index") -> DataFrame:
    """Counts by reason and metric percentiles over the frames that reached each gate, per scene and pass."""
    keys = [*keys, "pass_no", "pass", "min_sharpness", "min_frame_diff"]
    sees_blur, sees_diff = F.col("reason") != "bad_exposure", F.col("frame_diff").isNotNull()
    eligible, kept = F.col("reason").isin("kept", "thinned"), F.col("reason") == "kept"
    sharp, diff = F.when(sees_blur, F.col("sharpness")), F.when(sees_diff, F.col("frame_diff"))
    count = lambda name: F.count_if(F.col("reason") == name)
    stats = group_stats(fates, keys, {
        "brightness_p10": ("brightness", 0.1), "brightness_p50": ("brightness", 0.5), "brightness_p90": ("brightness", 0.9),
        "contrast_p10": ("contrast", 0.1), "contrast_p50": ("contrast", 0.5), "clipped_ratio_p90": ("clipped_ratio", 0.9),
        "sharpness_p10": (sharp, 0.1), "sharpness_p50": (sharp, 0.5), "frame_diff_p10": (diff, 0.1), "frame_diff_p50": (diff, 0.5)}, [
        F.count("*").alias("raw_count"), F.count_if(eligible).alias("eligible_count"), count("kept").alias("kept_count"),
        count("blur").alias("skipped_blur"), count("bad_exposure").alias("skipped_bad_exposure"), count("near_duplicate").alias("skipped_near_duplicate"),
        count("thinned").alias("temporal_thinned_count"), F.min(sharp).alias("sharpness_min"),
        F.min(F.when(eligible, F.col(order))).alias("eligible_first_raw_index"), F.max(F.when(eligible, F.col(order))).alias("eligible_last_raw_index"),
        F.min(F.when(kept, F.col(order))).alias("selected_first_raw_index"), F.max(F.when(kept, F.col(order))).alias("selected_last_raw_index")])
    span = (F.col("selected_last_raw_index") - F.col("selected_first_raw_index")).cast("double")
    steps = F.nullif(F.col("raw_count") - 1, F.lit(0)).cast("double")
    return stats.withColumn("selected_raw_index_coverage", round_half_even(F.try_divide(span, steps), 3))


def coverage_targets(raw_count: Column, max_frames: int, min_frames: int | None = None, min_span: float | None = DEFAULT_SPAN) -> tuple[Column, Column]:
    want = DEFAULT_TARGET if min_frames is None else max(1, int(min_frames))
    target = F.when((raw_count <= 0) | F.lit(max_frames <= 0), 0).otherwise(F.least(raw_count, F.lit(max_frames), F.lit(want))).cast("int")
    return target, F.lit(DEFAULT_SPAN if min_span is None else max(0.0, min(1.0, float(min_span))))


def score_pass(stats: DataFrame, max_frames: int, min_frames: int | None = None, min_span: float | None = DEFAULT_SPAN) -> DataFrame:
    """Add the targets, whether a pass meets them, and the tuple by which passes compare."""
    target, span_target = coverage_targets(F.col("raw_count"), max_frames, min_frames, min_span)
    rows = stats.withColumns({"target_frames": target, "target_span": span_target})
    span, count = F.col("selected_raw_index_coverage"), F.col("kept_count")
    free = F.col("target_span") <= 0
    value = F.when(span.isNull() & free, 1.0).otherwise(F.coalesce(span, F.lit(0.0)))
    frame_ratio = F.when(F.col("target_frames") <= 0, 1.0).otherwise(F.least(F.lit(1.0), count / F.greatest(F.col("target_frames"), F.lit(1))))
    span_ratio = F.when(free, 1.0).otherwise(F.least(F.lit(1.0), F.try_divide(value, F.col("target_span"))))
    enough, wide = count >= F.col("target_frames"), value >= F.col("target_span")
    spans = free | (F.col("raw_count") <= 1) | F.coalesce(span >= F.col("target_span"), F.lit(False))
    return rows.withColumns({
        "meets_frame_target": enough, "meets_span_target": spans, "meets_target": enough & spans,
        "pass_score": F.struct((enough & wide).alias("both"), F.least(frame_ratio, span_ratio).alias("balanced"), wide.alias("wide"), enough.alias("enough"),
                               frame_ratio.alias("frames"), span_ratio.alias("spans"), value.alias("span"), count.alias("count"))})


def choose_pass(scored: DataFrame, keys=("scene_id",)) -> DataFrame:
    """First pass that meets its targets, else the best-scored one (earliest on ties)."""
    facts = [c for c in scored.columns if c not in keys and c != "pass_score"]
    whole = F.struct(*facts)
    first = F.min_by(whole, F.when(F.col("meets_target"), F.col("pass_no")))
    best = F.max_by(whole, F.struct("pass_score", (-F.col("pass_no")).alias("early")))
    chosen = scored.groupBy(*keys).agg(F.coalesce(first, best).alias("c"))
    return chosen.select(*keys, "c.*").withColumn("relaxed", F.col("pass") != "strict")


def select_frames_adaptive(frames: DataFrame, min_sharpness: float, min_frame_diff: float, max_frames: int, min_frames: int | None = None,
                           min_span: float | None = DEFAULT_SPAN, band: dict | None = None, adaptive: bool = True, keys=("scene_id",),
                           order: str = "raw_index", data: str | None = "pixels", chunk: int = 256) -> tuple[DataFrame, DataFrame]:
    """Selected frames and one manifest row per scene; thresholds relax until coverage is met."""
    keys = list(keys)
    ladder = threshold_ladder(min_sharpness, min_frame_diff, adaptive)
    fates = durable(filter_frames(frames, ladder, max_frames, band, keys, order, data, chunk))
    scored = score_pass(extraction_stats(fates, keys, order), max_frames, min_frames, min_span)
    manifest = durable(choose_pass(scored, keys))
    picked = attach(fates.filter("reason = 'kept'").select(*keys, order, "pass_no"), manifest.select(*keys, "pass_no"), [*keys, "pass_no"], "left_semi")
    return picked.select(*keys, order), manifest


def renumber_selected(selected: DataFrame, keys=("scene_id",), order: str = "raw_index") -> DataFrame:
    """Contiguous output index and frame name in sequence order."""
    rows = ranked(selected, keys, [order], "_at")
    return rows.withColumn("output_index", (F.col("_at") - 1).cast("int")).drop("_at").withColumn("output_name", F.format_string("frame_%05d", "output_index"))


def frame_stride_sample(frames: DataFrame, max_frames: int = 160, keys=("scene_id",), order: str = "raw_index") -> DataFrame:
    """Every step-th frame with step = ceil(n / max_frames); sample before decoding pixels."""
    keys = list(keys)
    sizes = frames.groupBy(*keys).agg(F.count("*").alias("_n"))
    rows = attach(ranked(frames, keys, [order], "_at"), sizes, keys)
    step = F.greatest(F.lit(1), F.ceil(F.col("_n") / max_frames))
    return rows.filter((F.col("_at") - 1) % step == 0).drop("_at", "_n")


def temporal_chunks(frames: DataFrame, n: int, keys=("scene_id",), order: str = "raw_index") -> DataFrame:
    """Chunks of n consecutive frames; the last one repeats its final frame to full length."""
    rows = ranked(frames, keys, [order], "_at").withColumn("chunk", F.floor((F.col("_at") - 1) / n).cast("int"))
    packed = rows.groupBy(*keys, "chunk").agg(F.sort_array(F.collect_list(F.col(order))).alias("frames"))  # at most n each
    pad = F.array_repeat(F.element_at("frames", -1), F.lit(n) - F.size("frames"))
    return packed.select(*keys, "chunk", F.concat("frames", pad).alias("frames"), F.size("frames").alias("real_count"))


def running_psnr(rows: DataFrame, value: str = "psnr", keys=("scene_id",), order: str = "step", chunk: int = 16384) -> DataFrame:
    """Add the exponential mean (0.9 old, 0.1 new, seeded by the first row) and the running maximum.

    The sequence is cut into chunks.  An old value fades by 0.9 per row, so a chunk
    warmed up on the chunk before it has the exact mean to double precision; the
    maximum before a chunk comes from the much shorter table of chunk maxima.
    """
    keys = list(keys)
    numbered = ranked(rows, keys, [order], "_at").withColumn("_chunk", F.floor((F.col("_at") - 1) / chunk))
    copies = numbered.withColumn("_c", F.explode(F.array(F.struct(F.col("_chunk").alias("to"), F.lit(False).alias("warm")),
                                                         F.struct((F.col("_chunk") + 1).alias("to"), F.lit(True).alias("warm")))))
    slim = copies.select(*keys, "_at", F.col(value).alias("_v"), F.col("_c.to").alias("_to"), F.col("_c.warm").alias("_warm"))
    schema = T.StructType([*[f for f in slim.schema.fields if f.name in (*keys, "_at")], T.StructField("running_psnr", T.DoubleType()), T.StructField("_top", T.DoubleType())])

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_at")
        pdf["running_psnr"] = pdf["_v"].ewm(alpha=0.1, adjust=False).mean()
        own = pdf[~pdf["_warm"]].copy()
        own["_top"] = own["_v"].cummax()
        return own[[f.name for f in schema.fields]]

    means = slim.groupBy(*keys, "_to").applyInPandas(walk, schema)
    tops = numbered.groupBy(*keys, "_chunk").agg(F.max(value).alias("_peak"))
    past = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.withColumn("_past", F.max("_peak").over(past)).drop("_peak")
    out = numbered.join(means, [*keys, "_at"]).join(tops, [*keys, "_chunk"], "left")
    return out.withColumn("best_psnr", F.greatest("_top", "_past")).drop("_at", "_chunk", "_top", "_past")


# ---- input assessment ------------------------------------------------------

def stem(c) -> Column:
    base = F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"^.*/", "")
    return F.regexp_replace(base, r"(?<=.)\.[^.]*$", "")


def pair_masks(masks: DataFrame, images: DataFrame, keys=("scene_id",), name: str = "name") -> DataFrame:
    """Masks whose stem matches an image stem of the scene."""
    have = images.select(*keys, stem(name).alias("_stem")).distinct()
    return masks.withColumn("_stem", stem(name)).join(have, [*keys, "_stem"], "left_semi").drop("_stem")


def mask_summary(measured: DataFrame, keys=("scene_id",)) -> DataFrame:
    """Percentiles of foreground ratio and box fill, and the share of masks touching an edge."""
    spec = {f"{c}_{n}": (c, p) for c in ("fg_ratio", "bbox_fill") for n, p in (("min", 0.0), ("p10", 0.1), ("p50", 0.5), ("p90", 0.9), ("max", 1.0))}
    stats = group_stats(measured, keys, spec, [F.count("*").alias("mask_count"), F.count_if("touches_edge").alias("_edge")])
    return stats.withColumn("edge_touch_percent", round_half_even(100.0 * F.col("_edge") / F.greatest(F.lit(1), "mask_count"), 2)).drop("_edge")


def score_inputs(summary: DataFrame) -> DataFrame:
    """Score, problems and recommendations of a scene's input set; a missing metric raises no objection.

    Reads frame_count, sharpness_p10, diff_p50, diff_p90, brightness_p10, brightness_p90, contrast_p10,
    clipped_p90, mask_count, fg_p50, edge_touch_percent.
    """
    c, yes = F.col, lambda t: F.coalesce(t, F.lit(False))
    few, some = yes(c("frame_count") < 48), yes(c("frame_count") < 90)
    blurry, soft = yes(c("sharpness_p10") < 35), yes(c("sharpness_p10") < 80)
    masked = yes(c("mask_count") > 0)
    # Condition, penalty, problem name (if any) and recommendation, in report order.
    rules = [
        (few, 20, "low_frame_count", "Extract more usable frames or capture a slower 360 pass."),
        (~few & some, 8, None, "More frames may help thin or symmetric objects."),
        (blurry, 18, "blurry_frames", "Raise min sharpness or reshoot with slower motion and locked focus."),
        (~blurry & soft, 8, None, "Consider filtering the blurriest frames before training."),
        (yes(c("diff_p50") < 0.015), 10, "near_duplicate_frames", "Increase frame-difference filtering to avoid many repeated views."),
        (yes(c("diff_p90") > 0.22), 12, "large_view_jumps_or_exposure_changes", "Use steadier capture or lower FPS sampling to reduce sudden changes."),
        (yes(c("brightness_p10") < 12) | yes(c("brightness_p90") > 243), 10, "bad_exposure_frames",
         "Filter heavily underexposed/overexposed frames or recapture with locked exposure."),
        (yes(c("contrast_p10") < 5), 10, "low_contrast_frames", "Remove near-flat frames caused by motion, glare, or occlusion before training."),
        (yes(c("clipped_p90") > 0.55), 8, "clipped_frames", "Avoid frames dominated by black/white clipping; they add weak or misleading matches."),
        (masked & F.coalesce(c("fg_p50") < 0.08, F.lit(True)), 14, "mask_too_small", "Use a larger foreground rectangle or better mask backend."),
        (masked & F.coalesce(c("fg_p50") > 0.75, F.lit(True)), 14, "mask_too_large", "Tighten crop/mask so background is not treated as the object."),
        (masked & yes(c("edge_touch_percent") > 35), 10, "mask_touches_edges", "Widen crop or improve masks; edge-cut objects reconstruct poorly."),
        (~masked, 12, "missing_masks", "Run object masks for object-centric videos before masked training."),
    ]
    penalty = sum((F.when(t, p).otherwise(0) for t, p, _, _ in rules), F.lit(0))
    advice = problem_list(*[F.when(t, a) for t, _, _, a in rules])
    usable = "Input set looks usable; prefer small controlled parameter sweeps over long blind training."
    return summary.withColumns({
        "score": F.greatest(F.lit(0), F.least(F.lit(100), 100 - penalty)),
        "problems": problem_list(*[F.when(t, n) for t, _, n, _ in rules if n]),
        "recommendations": F.when(F.size(advice) > 0, advice).otherwise(F.array(F.lit(usable)))})


def assess_scene(frames: DataFrame, masks: DataFrame | None = None, max_frames: int = 160, max_side: int | None = 512, keys=("scene_id",),
                 order: str = "raw_index") -> DataFrame:
    """Input report per scene: total frame count, metrics of a stride sample, mask summary, score.

    Where both tables have a name, masks whose stem no frame of the scene has are left out, before counting and sampling.
    Frames with a `frame_count`, and masks with a `mask_total`, are taken as the sample of so many (see `assess_folder`).
    """
    keys = list(keys)
    if "frame_count" in frames.columns:
        counts, sample = frames.groupBy(*keys).agg(F.max("frame_count").alias("frame_count")), frames.drop("frame_count")
    else:
        counts = frames.groupBy(*keys).agg(F.count("*").alias("frame_count"))
        sample = frame_stride_sample(frames, max_frames, keys, order)
    small = downscale_gray(frame_health(sample, max_side=max_side).withColumns({"_w": F.col("width"), "_h": F.col("height")}), max_side=max_side or 1 << 30)
    measured = durable(consecutive_diff(small, keys, order).drop("pixels", "width", "height").withColumnsRenamed({"_w": "width", "_h": "height"}))
    points = (("min", 0.0), ("p10", 0.1), ("p50", 0.5), ("p90", 0.9), ("max", 1.0))
    metrics = {"sharpness": "sharpness", "diff": "frame_diff", "brightness": "brightness", "contrast": "contrast", "clipped": "clipped_ratio"}
    clean = {n: F.when(finite(m), F.col(m)) for n, m in metrics.items()}
    spec = {f"{n}_{p}": (clean[n], q) for n in metrics for p, q in points}
    first = F.min_by(F.struct("width", "height"), F.col(order))
    stats = group_stats(measured, keys, spec, [F.count("*").alias("sampled_count"), first.alias("_dims")], size_of=frames)
    report = counts.join(stats, keys, "left").withColumns({"width": F.col("_dims.width"), "height": F.col("_dims.height")}).drop("_dims")
    if masks is not None and "mask_total" in masks.columns:
        total = masks.groupBy(*keys).agg(F.max("mask_total").alias("mask_count"))
        summary = mask_summary(durable(mask_stats(masks.drop("mask_total")).drop("pixels")), keys).drop("mask_count").withColumnRenamed("fg_ratio_p50", "fg_p50")
        report = report.join(summary, keys, "left").join(total, keys, "left")
    elif masks is not None:
        if "name" in masks.columns and "name" in frames.columns:
            masks = pair_masks(masks, frames, keys)
        paired = masks if order not in masks.columns else frame_stride_sample(masks, max_frames, keys, order)
        total = masks.groupBy(*keys).agg(F.count("*").alias("mask_total"))
        summary = mask_summary(mask_stats(paired), keys).drop("mask_count").withColumnRenamed("fg_ratio_p50", "fg_p50")
        report = report.join(summary, keys, "left").join(total.withColumnRenamed("mask_total", "mask_count"), keys, "left")
    else:
        report = report.withColumns({"mask_count": F.lit(0), "fg_p50": F.lit(None).cast("double"), "edge_touch_percent": F.lit(None).cast("double")})
    return score_inputs(report)


def assess_folder(spark: SparkSession, root: str, max_frames: int = 160, max_side: int | None = 512) -> DataFrame:
    """The input report of every scene folder below `root`: frames in `images` (or the folder itself), masks in `masks`.

    Files are listed, numbered, paired and sampled by name; only the sampled ones are opened.
    """
    from ..sources.images import decode_frames, list_frames

    def sample(listed: DataFrame, total: str) -> DataFrame:
        counts = listed.groupBy("scene_id").agg(F.count("*").alias(total))
        return decode_frames(attach(frame_stride_sample(listed, max_frames), counts, ["scene_id"]), root)

    frames = durable(list_frames(spark, root).drop("bytes"))
    masks = durable(pair_masks(list_frames(spark, root, child="masks").drop("bytes", "raw_index"), frames))
    masks = ranked(masks, ["scene_id"], ["name", "uri"]).withColumn("raw_index", F.col("ordinal").cast("int")).drop("ordinal")
    return assess_scene(sample(frames, "frame_count"), None if masks.isEmpty() else sample(masks, "mask_total"), max_frames, max_side)


def frame_dims(frames: DataFrame, keys=("scene_id",), order: str = "raw_index") -> DataFrame:
    """Width and height of each scene's first frame, and how many frames it has (`frame_count` where the frames bring one)."""
    keys = list(keys)
    count = F.max("frame_count") if "frame_count" in frames.columns else F.count("*")
    rows = frames.groupBy(*keys).agg(F.min_by(F.struct("width", "height"), F.col(order)).alias("_s"), count.alias("frames"))
    return rows.select(*keys, "_s.width", "_s.height", "frames")


def crop_window(boxes: DataFrame, pad: float = 0.18, keys=("scene_id",)) -> DataFrame:
    """Common crop of a scene from its content boxes (x0, y0, x1, y1) and frame size (width, height)."""
    keys = list(keys)
    q = group_stats(boxes, keys, {"x0": ("x0", 0.15), "y0": ("y0", 0.15), "x1": ("x1", 0.85), "y1": ("y1", 0.85)},
                    [F.max("width").alias("width"), F.max("height").alias("height")])
    q = q.withColumn("_side", F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) * (1.0 + pad * 2.0))
    whole = lambda c: F.rint(c).cast("int")
    q = q.withColumns({"crop_w": F.least(F.col("width").cast("int"), whole(F.col("_side"))), "crop_h": F.least(F.col("height").cast("int"), whole(F.col("_side") * 1.15))})
    inside = lambda start, room: F.greatest(F.lit(0), F.least(room, start))
    left = inside(whole((F.col("x0") + F.col("x1")) * 0.5 - F.col("crop_w") * 0.5), (F.col("width") - F.col("crop_w")).cast("int"))
    top = inside(whole((F.col("y0") + F.col("y1")) * 0.5 - F.col("crop_h") * 0.52), (F.col("height") - F.col("crop_h")).cast("int"))
    return (q.withColumns({"left": left, "top": top}).withColumns({"right": F.col("left") + F.col("crop_w"), "bottom": F.col("top") + F.col("crop_h")})
            .select(*keys, "left", "top", "right", "bottom"))

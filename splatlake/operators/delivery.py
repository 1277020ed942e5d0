"""Delivery checks: listing validation, asset resolution, scoring, page assets, projection of captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import problem_list, round_half_even, fixed_text
from ..functions.scaling import attach

# Files every flat delivery must hold.
BASE_REQUIRED = ("START_HERE.html", "preview.html", "diagnostics.json", "manifest.json", "index.js", "index.css", "settings.json")
MOBILE_MB = 12.0
MIN_POINTS = 120_000
MIN_SCORE = 85


def validate_delivery(deliveries: DataFrame, listing: DataFrame, key: str = "delivery") -> DataFrame:
    """Problems of each flat delivery folder.

    `deliveries` has manifest_present, manifest_ok, manifest_sog, manifest_ply, preview_text,
    start_text, diagnostics_present, diagnostics_ok; a NULL *_ok of a present file means the file
    could not be read. `listing` has (key, name, bytes).
    """
    first = lambda ending: F.min(F.when(F.col("name").endswith(ending) & ~F.col("name").contains("/"), F.col("name")))
    found = listing.groupBy(key).agg(
        first(".sog").alias("_sog"), first("_high_quality.ply").alias("_ply"),
        *[F.max(F.when(F.col("name") == n, 1)).alias(f"_f{i}") for i, n in enumerate(BASE_REQUIRED)])
    blank = lambda c: F.when(F.length(c) > 0, F.col(c))
    rows = deliveries.join(found, key, "left").withColumns({
        "sog": F.coalesce(blank("manifest_sog"), F.col("_sog"), F.lit("")),
        "ply": F.coalesce(blank("manifest_ply"), F.col("_ply"), F.lit(""))})
    # the two expected assets must be listed too
    names = listing.select(key, "name").distinct()
    for asset in ("sog", "ply"):
        rows = rows.join(names.select(key, F.col("name").alias(asset), F.lit(True).alias(f"_{asset}_there")), [key, asset], "left")
    lacking = lambda c: F.coalesce(c.isNull(), F.lit(True))
    has_preview, has_start = F.col("_f1").isNotNull(), F.col("_f0").isNotNull()
    absent = lambda text, needle: ~F.coalesce(F.col(text), F.lit("")).contains(needle)
    name_sog = F.length("sog") > 0
    # Problem texts, in report order.
    problems = problem_list(
        F.when(F.col("manifest_present") & F.col("manifest_ok").isNull(), "manifest unreadable"),
        F.when(F.col("manifest_present") & ~F.col("manifest_ok"), "manifest ok is not true"),
        F.when(~name_sog, "missing SOG asset"), F.when(F.length("ply") == 0, "missing high-quality PLY asset"),
        *[F.when(lacking(F.col(f"_f{i}")), f"missing {n}") for i, n in enumerate(BASE_REQUIRED)],
        *[F.when((F.length(a) > 0) & F.col(f"_{a}_there").isNull(), F.concat(F.lit("missing "), F.col(a))) for a in ("sog", "ply")],
        F.when(has_preview & absent("preview_text", F.col("sog")), F.concat(F.lit("preview.html does not reference "), F.col("sog"))),
        *[F.when(has_preview & absent("preview_text", F.lit(n)), f"preview.html does not reference {n}") for n in ("index.css", "settings.json")],
        F.when(has_start & name_sog & absent("start_text", F.col("sog")), F.concat(F.lit("START_HERE.html does not reference "), F.col("sog"))),
        F.when(F.col("diagnostics_present") & F.col("diagnostics_ok").isNull(), "diagnostics unreadable"),
        F.when(F.col("diagnostics_present") & ~F.col("diagnostics_ok"), "diagnostics ok is not true"))
    return rows.select(key, "sog", "ply", problems.alias("problems"), (F.size(problems) == 0).alias("ok"))


# Asset patterns (layout, kind, rank, regular expression over the path inside the folder).
ASSET_PATTERNS = (
    ("workspace", "ply", 1, r"^clean_output/clean_opa0\.10_standard\.ply$"),
    ("workspace", "ply", 2, r"^clean_output/[^/]*_standard\.ply$"),
    ("workspace", "ply", 3, r"^delivery/professional/[^/]*_standard\.ply$"),
    ("workspace", "sog", 1, r"^[^/]*\.sog$"),
    ("workspace", "splat", 1, r"^[^/]*\.splat$"),
    ("workspace", "splat", 2, r"^delivery/web/splat/[^/]*\.splat$"),
    ("flat_output", "ply", 1, r"^[^/]*_high_quality\.ply$"),
    ("flat_output", "sog", 1, r"^[^/]*\.sog$"),
)


def resolve_assets(deliveries: DataFrame, listing: DataFrame, key: str = "delivery") -> DataFrame:
    """Layout of each folder and the first file per kind by (pattern rank, path).

    A manifest with a file table makes it a delivery (its named files win); clean_output or
    reports make it a workspace; else it is a flat output.
    """
    path = F.col("path")
    best = []
    for layout in ("workspace", "flat_output"):
        for kind in ("ply", "sog", "splat"):
            ranks = [(r, rx) for lay, k, r, rx in ASSET_PATTERNS if lay == layout and k == kind]
            if not ranks:
                continue
            rank = F.when(path.rlike(ranks[0][1]), ranks[0][0])
            for r, rx in ranks[1:]:
                rank = rank.when(path.rlike(rx), r)
            best.append(F.min(F.when(rank.isNotNull(), F.struct(rank.alias("r"), path.alias("p"), F.col("bytes").alias("b")))).alias(f"_{layout}_{kind}"))
    named = []
    found = listing.groupBy(key).agg(F.max(path.startswith("clean_output/") | path.startswith("reports/")).alias("_work"), *best)
    rows = deliveries.join(found, key, "left")
    layout = (F.when(F.coalesce("manifest_has_files", F.lit(False)), "delivery").when(F.coalesce("_work", F.lit(False)), "workspace").otherwise("flat_output"))
    rows = rows.withColumn("kind", layout)
    for asset in ("ply", "sog", "splat"):
        own = F.col(f"manifest_{asset}") if f"manifest_{asset}" in deliveries.columns else F.lit(None).cast("string")
        work = F.col(f"_workspace_{asset}.p")
        flat = F.coalesce(F.when(F.length(own) > 0, own), F.col(f"_flat_output_{asset}.p")) if asset != "splat" else F.lit(None).cast("string")
        named.append(F.when(F.col("kind") == "delivery", F.when(F.length(own) > 0, own)).when(F.col("kind") == "workspace", work).otherwise(flat).alias(asset))
    picked = rows.select(key, "kind", *named)
    files = listing.select(key, "path", "bytes")
    for asset in ("ply", "sog", "splat"):
        picked = (picked.join(files.select(key, F.col("path").alias(asset), F.col("bytes").alias(f"{asset}_bytes")), [key, asset], "left")
                  .withColumn(asset, F.when(F.col(f"{asset}_bytes").isNotNull(), F.col(asset))))
    return picked.select(key, "kind", "ply", "ply_bytes", "sog", "sog_bytes", "splat", "splat_bytes")


def score_delivery(rows: DataFrame, mobile_mb: float = MOBILE_MB, min_points: int = MIN_POINTS) -> DataFrame:
    """Score 0..100 with its problems.

    `rows` has validation_ok, validation_problems, web_bytes, ply_bytes (NULL when missing),
    point_count, radius_p99, diagnostics_ok.
    """
    mb = lambda c: F.coalesce(F.col(c) / 1048576.0, F.lit(0.0))
    web, points = mb("web_bytes"), F.coalesce("point_count", F.lit(0))
    heavy, thin = web > mobile_mb, points < min_points
    fail = F.col("ply_bytes").isNotNull() & ~F.coalesce("diagnostics_ok", F.lit(False))
    # Problem texts.
    own = problem_list(
        F.when(F.col("web_bytes").isNull(), "missing web asset"), F.when(F.col("ply_bytes").isNull(), "missing PLY file"),
        F.when(heavy, F.concat(F.lit("SOG is larger than mobile budget ("), fixed_text(web, 1), F.lit(f"MB > {mobile_mb:.1f}MB)"))),
        F.when(thin, F.concat(F.lit("point count is too low ("), points.cast("string"), F.lit(f" < {min_points})"))),
        F.when(fail, "PLY diagnostics failed"))
    problems = F.concat(F.coalesce("validation_problems", F.array().cast("array<string>")), own)
    rows = rows.withColumn("problems", problems)
    minus = lambda test, n: F.when(test, n).otherwise(0)
    score = (100 - minus(~F.coalesce("validation_ok", F.lit(False)), 40) - minus(heavy, 20) - minus(thin, 20)
             - minus(F.coalesce(F.col("radius_p99") > 20, F.lit(False)), 10) - F.least(F.lit(10), F.size("problems") * 3))
    return rows.withColumns({"score": F.greatest(F.lit(0), score), "ok": F.size("problems") == 0,
                             "sog_mb": round_half_even(web, 2), "ply_mb": round_half_even(mb("ply_bytes"), 2)})


def benchmark_gates(scored: DataFrame, min_score: int = MIN_SCORE) -> DataFrame:
    return scored.withColumn("meets_min_score", F.col("score") >= min_score)


def benchmark_verdict(gated: DataFrame, *groups: str) -> DataFrame:
    return gated.groupBy(*groups).agg(F.bool_and(F.col("ok") & F.col("meets_min_score")).alias("ok"), F.count("*").alias("scene_count"))


# ---- page assets -----------------------------------------------------------

# Where a preview page names its assets. The last group of each pattern is the name.
TAG = r"(?is)<(?:script|link)\b[^>]*>"
FETCH = r"fetch\(['\"]([^'\"]+)['\"]\)"
QUOTED = r"['\"]([^'\"]*(?:settings\.json|\.sog|index\.css|index\.js))['\"]"
REQUIRED_SUFFIXES = (".sog", "index.css", "settings.json")


def attribute(tag: Column, name: str) -> Column:
    return F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", 0)


def _attr_value(tag: Column, name: str) -> Column:
    whole = attribute(tag, name)
    return F.regexp_replace(F.regexp_replace(whole, rf"(?is)^{name}\s*=\s*", ""), r"^['\"]|['\"]$", "")


def page_asset_names(html: str = "html") -> Column:
    """Distinct asset names of a page: script sources, style and module links, fetch calls, quoted names."""
    tags = F.regexp_extract_all(F.col(html), F.lit(TAG), F.lit(0))
    def from_tag(tag):
        script = F.lower(tag).startswith("<script")
        linked = F.lower(_attr_value(tag, "rel")).isin("stylesheet", "modulepreload")
        return F.when(script, _attr_value(tag, "src")).when(linked, _attr_value(tag, "href")).otherwise("")
    tagged = F.filter(F.transform(tags, from_tag), lambda a: F.length(a) > 0)
    fetched = F.regexp_extract_all(F.col(html), F.lit(FETCH), F.lit(1))
    quoted = F.regexp_extract_all(F.col(html), F.lit(QUOTED), F.lit(1))
    names = F.array_union(F.array_union(tagged, fetched), quoted)
    return F.filter(names, lambda a: ~a.startswith("data:"))


def url_join(base: Column, ref: Column) -> Column:
    """Resolve a reference against a page address (absolute, scheme-relative, rooted, or relative with dot segments)."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    host = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_replace(F.substr(base, F.length(host) + 1), r"[?#].*$", "")
    folder = F.regexp_replace(path, r"[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    joined = F.concat(folder, ref)
    # fold dot segments in the path part only
    tail = F.regexp_extract(joined, r"([?#].*)$", 1)
    plain = F.regexp_replace(joined, r"[?#].*$", "")
    parts = F.split(plain, "/")
    kept = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array().cast("array<string>"),
                       lambda acc, s: F.when(s == ".", acc)
                       .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(s))))
    dotted = F.element_at(parts, -1).isin(".", "..")
    folded = F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(dotted & (F.size(kept) > 0), "/").otherwise(""))
    return (F.when(ref == "", base).when(ref.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), ref).when(ref.startswith("//"), F.concat(scheme, ref))
            .when(ref.startswith("/"), F.concat(host, ref)).when(ref.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), ref))
            .when(ref.startswith("?"), F.concat(host, path, ref)).otherwise(F.concat(host, folded, tail)))


def extract_page_assets(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page and distinct asset address."""
    named = pages.select(key, F.col(url).alias("_base"), F.explode(page_asset_names(html)).alias("ref"))
    return named.select(key, url_join(F.col("_base"), F.col("ref")).alias("asset")).distinct()


def missing_page_assets(pages: DataFrame, assets: DataFrame, key: str = "page_id", suffixes=REQUIRED_SUFFIXES) -> DataFrame:
    """Required endings that no discovered asset path of a page has."""
    path = F.regexp_replace("asset", r"[?#].*$", "")
    seen = assets.groupBy(key).agg(*[F.max(path.endswith(s)).alias(f"_s{i}") for i, s in enumerate(suffixes)])
    rows = attach(pages.select(key), seen, [key], isolate=False)
    lacking = problem_list(*[F.when(~F.coalesce(f"_s{i}", F.lit(False)), s) for i, s in enumerate(suffixes)])
    return rows.select(key, F.explode(lacking).alias("missing"))


# ---- capture metadata ------------------------------------------------------

def classify_projection(videos: DataFrame, requested: str = "auto") -> DataFrame:
    """Perspective or 360 degree video by aspect ratio, unless the user says which."""
    requested = requested.lower()
    if requested not in ("auto", "perspective", "equirectangular"):
        raise ValueError(f"unknown projection {requested!r}")
    aspect = F.col("width") / F.greatest("height", F.lit(1))
    shown = fixed_text(aspect, 2)
    wide = aspect.between(1.85, 2.15)
    # Names and reasons.
    if requested == "auto":
        projection = F.when(wide, "equirectangular").otherwise("perspective")
        reason = F.concat(F.when(wide, "auto-detected 2:1-ish aspect ratio (").otherwise("auto-detected non-2:1 aspect ratio ("), shown, F.lit(")"))
    else:
        projection, reason = F.lit(requested), F.lit("user override")
    mode = F.when(projection == "equirectangular", "cubemap_frames").otherwise("perspective_frames")
    return videos.withColumns({"aspect": aspect, "projection": projection, "reconstruction_mode": mode, "reason": reason})

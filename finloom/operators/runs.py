"""Summaries of runs and their state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from finloom.functions.text import truncated
from finloom.operators.dedup import latest_wins
from finloom.storage import spread


def enabled_counts(feeds: DataFrame) -> DataFrame:
    """category (null: all of them), total, enabled and disabled of feeds (category, enabled)."""
    return feeds.rollup("category").agg(
        F.grouping("category").alias("is_total"), F.count("*").alias("total"), F.count_if("enabled").alias("enabled"), F.count_if(~F.col("enabled")).alias("disabled")
    )


def listed(feeds: DataFrame, category: str | None = None, enabled_only: bool = False) -> DataFrame:
    """Feeds of a category, enabled ones alone if asked for."""
    out = feeds if category is None else feeds.where(F.col("category") == category)
    return out.where("enabled") if enabled_only else out


def selected(registry: DataFrame, column: str, wanted: Sequence[str]) -> DataFrame:
    """Rows of the registry with a wanted value; a wanted value that no row has
    stops the query."""
    spark = registry.sparkSession
    asked = spark.createDataFrame([(x,) for x in wanted], "wanted string")
    joined = asked.join(registry, F.col("wanted") == F.col(column), "left")
    unknown = F.raise_error(F.concat(F.lit(f"unknown {column}: "), "wanted"))
    return joined.select(*[F.when(F.col(column).isNull(), unknown).otherwise(F.col(column)).alias(c) if c == column else F.col(c) for c in registry.columns])


def status_counts(runs: DataFrame, status: str, names: Sequence[str]) -> DataFrame:
    """One row: the number of rows of each named status, 0 included, and of all."""
    return runs.agg(F.count("*").alias("total"), *[F.count_if(F.col(status) == n).alias(n) for n in names])


def channel_statistics(channels: DataFrame, videos: DataFrame) -> DataFrame:
    """Every channel with its numbers of videos by transcript status."""
    counts = videos.groupBy("channel_id").agg(
        F.count("*").alias("videos"), *[F.count_if(F.col("transcript_status") == s).alias(s) for s in ("success", "pending", "unavailable", "failed")]
    )
    joined = channels.select("channel_id").join(counts, "channel_id", "left")
    return joined.select("channel_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts.columns[1:]])


def mean_accuracy(scores: DataFrame) -> DataFrame:
    """Means of three axes and of their weighted score (three digits), and how
    many were judged: scores: factual, source, temporal."""
    each = scores.withColumn("overall", weighted_accuracy(F.col("factual"), F.col("source"), F.col("temporal")))
    return each.agg(F.count("*").alias("judged"), *[F.round(F.avg(c), 4).alias(c) for c in ("factual", "source", "temporal", "overall")])


def weighted_accuracy(factual: Column, source: Column, temporal: Column) -> Column:
    """0.4, 0.3 and 0.3 of the axes, three digits."""
    return F.round(0.4 * factual + 0.3 * source + 0.3 * temporal, 3)


def structure_status(pages: DataFrame) -> DataFrame:
    """hit_rate of pages (hits, titles, dates: what selectors found): titles and
    dates found of those possible, 0 without a hit; and its status."""
    rate = F.coalesce(F.try_divide(F.col("titles") + F.col("dates"), 2 * F.col("hits")), F.lit(0.0))
    status = F.when(rate >= 0.8, "healthy").when(rate >= 0.5, "partial_change").when(rate > 0, "major_change").otherwise("complete_change")
    return pages.withColumn("hit_rate", F.round(rate, 4)).withColumn("status", status)


def validation_summary(companies: DataFrame) -> DataFrame:
    """Every status with the number of companies (validation) that have it, 0 included."""
    status = F.when(F.col("validation") == "valid", "healthy").when(F.col("validation") == "partial", "partial_change").otherwise("complete_change")
    counts = companies.groupBy(status.alias("status")).agg(F.count("*").alias("found"))
    names = companies.sparkSession.createDataFrame([(s,) for s in ("healthy", "partial_change", "major_change", "complete_change")], "status string")
    return names.join(counts, "status", "left").select("status", F.coalesce("found", F.lit(0)).cast("long").alias("n"))


def collection_succeeded(sources: DataFrame | GroupedData) -> DataFrame:
    """One row (or one a group), success: there are no sources, or articles, or
    not all sources (articles, error: null without one) failed."""
    failed = F.count_if(F.col("error").isNotNull())
    return sources.agg(((F.count("*") == 0) | (F.coalesce(F.sum("articles"), F.lit(0)) > 0) | (failed != F.count("*"))).alias("success"))


def timing_summary(timings: DataFrame, name: str, ms: str) -> DataFrame:
    """mean, deviation (sample), min, max and median of every name's timings."""
    return timings.groupBy(name).agg(
        F.count("*").alias("n"), F.round(F.avg(ms), 4).alias("mean"), F.round(F.coalesce(F.stddev_samp(ms), F.lit(0.0)), 4).alias("deviation"),
        F.round(F.min(ms), 4).alias("least"), F.round(F.max(ms), 4).alias("most"), F.round(F.median(ms), 4).alias("median"),
    )


def latest_snapshot(snapshots: DataFrame, day: str, value: str, without: str) -> DataFrame:
    """One row: the day and value of the latest snapshot but that of the day ``without``."""
    other = snapshots.where(F.col(day) != F.to_date(F.lit(without)))
    return other.agg(F.max(day).alias(day), F.max_by(value, day).alias(value))


def recent_items(items: DataFrame, feeds: DataFrame, now: Column, hours: int) -> DataFrame:
    """Items (feed_id, item_id, published, fetched_at) of known feeds (feed_id,
    title) at most ``hours`` old, with the feed's title and ``at``: when it was
    published or else fetched.  Newest first is the reader's order, not stored here."""
    at = F.coalesce("published", "fetched_at")
    met = items.withColumn("at", at).where(F.col("at") >= now - F.make_interval(hours=F.lit(hours)))
    return met.join(feeds.select("feed_id", F.col("title").alias("feed_title")), "feed_id")


def associated(tables: DataFrame, documents: DataFrame) -> DataFrame:
    """The chunk of every table by its page: document, table_id, chunk.  documents:
    document, n_chunks, n_pages; pages are spread evenly over chunks, and one past
    the end belongs to the last."""
    per_chunk = F.greatest(F.lit(1), F.ceil(F.col("n_pages") / F.col("n_chunks")))
    chunk = F.least(F.floor((F.col("page") - 1) / per_chunk), F.col("n_chunks") - 1).cast("long")
    return tables.join(documents.where("n_chunks > 0"), "document").select("document", "table_id", chunk.alias("chunk"))


def exported_transcripts(videos: DataFrame, transcripts: DataFrame, source_id: Column, url: Column) -> DataFrame:
    """One queue document for every video (video_id, channel_id, title, published,
    status) that has succeeded and has a transcript (video_id, lines): its source
    and the whole text as one chunk."""
    text = F.trim(F.array_join("lines", " "))
    met = videos.where(F.col("status") == "success").join(transcripts, "video_id")
    chunk = F.concat(F.substring(source_id, 1, 8), F.lit("_chunk_0"))
    return met.select(
        "video_id", source_id.alias("source_id"), url.alias("url"), "title", F.concat(F.lit("YouTube/"), "channel_id").alias("feed_source"), chunk.alias("chunk_id"), text.alias("text")
    )


# Runs of skills ------------------------------------------------------------


def started(runs: DataFrame, starts: DataFrame, most: int = 200) -> DataFrame:
    """Runs (run_id, name, session_id, status, start_at, end_at, summary) after
    starts (run_id, name, session_id, start_at, summary), the latest of each: a
    known run begins anew, others are added; summaries are cut."""
    last = latest_wins(starts, ["run_id"], ["start_at", "session_id"])
    new = last.select("run_id", "name", "session_id", F.lit("running").alias("status"), "start_at", truncated(F.col("summary"), most).alias("summary"))
    old_end = runs.select("run_id", "end_at")
    merged = new.join(old_end, "run_id", "left").select(*runs.columns)
    return runs.join(new.select("run_id"), "run_id", "left_anti").select(*runs.columns).unionByName(merged)


def completed(runs: DataFrame, ends: DataFrame) -> DataFrame:
    """Runs with the status and end of the latest of their ends (run_id, status,
    end_at); an end of an unknown run changes nothing."""
    last = ends.groupBy(F.col("run_id").alias("e_run_id")).agg(F.max(F.struct("end_at", "status")).alias("e"))
    joined = runs.join(spread(last), F.col("run_id") == F.col("e_run_id"), "left")
    changed = F.col("e").isNotNull()
    new = {"status": F.col("e.status"), "end_at": F.col("e.end_at")}
    return joined.select(*[F.when(changed, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in runs.columns])


def invoked(runs: DataFrame, calls: DataFrame) -> DataFrame:
    """Distinct edges (src, dst) of calls (parent_id, child_id) between known runs."""
    known = runs.select("run_id")
    ends = calls.join(known.withColumnRenamed("run_id", "parent_id"), "parent_id", "left_semi").join(known.withColumnRenamed("run_id", "child_id"), "child_id", "left_semi")
    return ends.select(F.col("parent_id").alias("src"), F.col("child_id").alias("dst")).distinct()


def conversation_graph(sessions: DataFrame, project: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, label, name) and edges (src, dst, type) of sessions (session_id,
    topics): the project has its sessions, and they discuss their topics."""
    s = F.concat(F.lit("session:"), F.col("session_id").cast("string"))
    t = sessions.select(s.alias("s"), F.explode("topics").alias("topic")).where(F.trim("topic") != "").withColumn("t", F.concat(F.lit("topic:"), F.lower(F.trim("topic"))))
    p = F.lit(f"project:{project}")
    nodes = sessions.select(s.alias("id"), F.lit("Session").alias("label"), F.col("session_id").cast("string").alias("name"))
    nodes = nodes.unionByName(t.groupBy(F.col("t").alias("id")).agg(F.min(F.trim("topic")).alias("name")).select("id", F.lit("Topic").alias("label"), "name"))
    nodes = nodes.unionByName(sessions.sparkSession.range(1).select(p.alias("id"), F.lit("Project").alias("label"), F.lit(project).alias("name")))
    edges = sessions.select(p.alias("src"), s.alias("dst"), F.lit("HAS_SESSION").alias("type")).unionByName(t.select(F.col("s").alias("src"), F.col("t").alias("dst"), F.lit("DISCUSSED").alias("type")))
    return nodes.distinct(), edges.distinct()


def transcript_states(existing: DataFrame, new: DataFrame, order: Sequence[str]) -> DataFrame:
    """Videos (video_id, status, ...) after a collection: what was collected
    replaces what was known of a video; repeats in it, the last by ``order``."""
    last = latest_wins(new, ["video_id"], order)
    return existing.join(last.select("video_id"), "video_id", "left_anti").unionByName(last)


def typed_tables(raw: DataFrame, content: str) -> DataFrame:
    """Raw tables with the kind that their JSON states (time_series,
    estimate_change or key_value), and its title; others, and what is no JSON,
    stay raw."""
    parsed = F.from_json(content, "table_type string, title string")
    kind = F.lower(F.trim(parsed["table_type"]))
    known = F.when(kind.isin("time_series", "estimate_change", "key_value"), kind)
    return raw.select(*[c for c in raw.columns if c != content], F.coalesce(known, F.lit("raw")).alias("table_type"), F.when(known.isNotNull(), parsed["title"]).alias("title"))

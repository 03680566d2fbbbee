"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import round_half_even
from ..functions.text import SEP, after_sep, before_sep, finite_number, join_fields, number_text
from ..operators import apply, fold, keys, lists, partial, report, stored, summary
from ..schema import STATION, TEMP
from ..sources import delimited, divided, head
from ..storage import new_path, store
from ..streaming import incremental
from . import from_text
from .views import (
    CHUNKS,
    LIST_ROWS,
    SCALE,
    as_chunk_files,
    as_text,
    by_balance,
    by_event_type,
    by_part,
    by_segment,
    by_user,
    by_whole_value,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]


# Summaries


def station_summary(spark, sf_dir):
    return summary.station_summary(by_segment(spark, sf_dir), SCALE)


def station_summary_wide(spark, sf_dir):
    return summary.station_summary(by_part(spark, sf_dir), SCALE)


def station_summary_text(spark, sf_dir):
    path = as_text(by_part(spark, sf_dir))
    return summary.station_summary(delimited.scan_lines(spark, path), SCALE)


def round_mean_only(spark, sf_dir):
    return summary.round_mean_only(by_segment(spark, sf_dir), SCALE)


def agg_spec(spark, sf_dir):
    specs = [(TEMP, "min", "lowest"), (TEMP, "max", "highest"), (TEMP, "count", "n")]
    return summary.summarize(by_part(spark, sf_dir), STATION, specs)


def result_shape(spark, sf_dir):
    return summary.table_shape(station_summary_wide(spark, sf_dir))


# Sources


def scan_delimited(spark, sf_dir):
    return delimited.scan_delimited(spark, as_text(by_segment(spark, sf_dir)))


def scan_lines(spark, sf_dir):
    return delimited.scan_lines(spark, as_text(by_segment(spark, sf_dir)))


def scan_late_cast(spark, sf_dir):
    return delimited.scan_late_cast(spark, as_text(by_segment(spark, sf_dir)))


def strict_bad_rows(spark, sf_dir):
    """Lines of text, some types of event written in a form a strict scan rejects."""
    events = table(spark, sf_dir, "events")
    good = join_fields(F.col("event_type"), F.col("value"), SCALE)
    line = (
        F.when(F.col("event_type") == "error", F.concat_ws(SEP, "event_type", "props"))
        .when(F.col("event_type") == "signup", F.concat_ws(SEP, good, "props"))
        .when(F.col("event_type") == "view", F.col("event_type"))
        .otherwise(good)
    )
    path = new_path(spark, "bad-rows")
    events.select(line.alias("value")).write.text(path)
    return delimited.rejected_lines(spark.read.text(path))


def input_chunks(spark, sf_dir):
    """Merging the states of the input splits gives the summary, wherever the splits are."""
    chunks = delimited.scan_chunks(spark, as_text(by_event_type(spark, sf_dir)), CHUNKS)
    return partial.merge_state(partial.partial_state(chunks, SCALE))


def preview_head(spark, sf_dir):
    head = delimited.preview(by_event_type(spark, sf_dir), 10, "event_id")
    return head.select("event_id", STATION, TEMP)


def preview_file_head(spark, sf_dir):
    """The first lines of text, of which only the beginning is read."""
    rows = by_event_type(spark, sf_dir).orderBy("event_id")
    return head.preview_head(spark, as_text(rows), 10)


def _mixed_lines(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    good = join_fields(F.col("event_type"), F.col("value"), SCALE)
    line = F.when(F.col("event_type") == "error", F.concat_ws(SEP, "event_type", "props"))
    path = new_path(spark, "mixed-rows")
    events.select(line.when(F.col("event_type") == "view", F.col("event_type")).otherwise(good).alias("value")).write.text(path)
    return divided.divide_lines(spark.read.text(path), new_path(spark, "divided"))


def strict_good_rows(spark, sf_dir):
    """What a strict scan takes of text with bad lines, which are set aside in the same pass."""
    return _mixed_lines(spark, sf_dir).good


def strict_set_aside(spark, sf_dir):
    return _mixed_lines(spark, sf_dir).rejected


def rename_columns(spark, sf_dir):
    return by_segment(spark, sf_dir).select(STATION, TEMP)


# Chunks


def partial_state(spark, sf_dir):
    states = partial.partial_state(by_event_type(spark, sf_dir), SCALE)
    return states.withColumn("t_sum", F.col("t_sum").cast("double"))


def merge_state(spark, sf_dir):
    return partial.merge_state(partial.partial_state(by_event_type(spark, sf_dir), SCALE))


def chunk_summary(spark, sf_dir):
    return partial.chunk_summary(by_event_type(spark, sf_dir), SCALE)


def mean_of_means(spark, sf_dir):
    return partial.mean_of_means(partial.chunk_summary(by_event_type(spark, sf_dir), SCALE))


def chunk_mean_report(spark, sf_dir):
    """From text, one file a chunk, to the report with the mean of the chunks' means."""
    return from_text.chunk_mean_report(spark, as_chunk_files(by_event_type(spark, sf_dir)), scale=SCALE)


def fold_mean_variance(spark, sf_dir):
    """An aggregate in Python, whose states merge, over many stations."""
    return fold.fold_by_key(by_part(spark, sf_dir), STATION, TEMP, fold.MeanVariance(SCALE))


def fold_extremes(spark, sf_dir):
    """The same over few hot stations, by chunk too."""
    return fold.fold_by_key(by_event_type(spark, sf_dir), ["chunk", STATION], TEMP, fold.Extremes())


def apply_per_batch(spark, sf_dir):
    rows = by_event_type(spark, sf_dir).select("chunk", STATION, TEMP)
    return apply.merge_batches(apply.apply_per_batch(rows, apply.group_batch, apply.BATCH_SCHEMA))


def apply_chunk_summary(spark, sf_dir):
    """A function that sees whole chunks; nothing is merged after it."""
    rows = by_event_type(spark, sf_dir).select("chunk", STATION, TEMP)
    return apply.apply_per_chunk(rows, apply.summarize_chunk(SCALE), apply.SUMMARY_SCHEMA)


# Lists


def _user_lists(spark, sf_dir):
    rows = lists.number_chunks(by_user(spark, sf_dir), "event_id", LIST_ROWS)
    return lists.group_to_list(rows)


def _as_list_text(found):
    texts = F.transform("temps", lambda temp: number_text(temp, SCALE))
    return found.select(STATION, "chunk", F.array_join(texts, ",").alias("temps"))


def group_to_list(spark, sf_dir):
    return _as_list_text(_user_lists(spark, sf_dir))


def group_to_bounded_list(spark, sf_dir):
    """Chunks that bound nothing: the values of each station and chunk, whatever lists they are in."""
    rows = lists.group_to_list(by_event_type(spark, sf_dir), most=64)
    longest = F.max(F.size("temps")) <= 64
    total = lists.list_summary(rows, SCALE)
    return total.join(rows.groupBy(STATION).agg(longest.alias("bounded")), STATION)


def list_summary(spark, sf_dir):
    return lists.list_summary(_user_lists(spark, sf_dir), SCALE)


def list_summary_raw(spark, sf_dir):
    return lists.list_summary(_user_lists(spark, sf_dir), SCALE, digits=None)


def concat_lists(spark, sf_dir):
    return _as_list_text(lists.merge_lists(_user_lists(spark, sf_dir), fan_in=2))


def merge_lists(spark, sf_dir):
    rows = lists.number_chunks(by_event_type(spark, sf_dir), "event_id", LIST_ROWS)
    return lists.list_summary(lists.merge_lists(lists.group_to_list(rows)), SCALE)


# Stations


def distinct_stations(spark, sf_dir):
    return keys.distinct_stations(by_user(spark, sf_dir))


def union_distinct_stations(spark, sf_dir):
    return keys.union_distinct_stations([by_user(spark, sf_dir), by_part(spark, sf_dir)])


def union_chunks(spark, sf_dir):
    sources = [by_event_type(spark, sf_dir), by_segment(spark, sf_dir)]
    return keys.union_tables([partial.chunk_summary(source, SCALE) for source in sources])


def filter_station(spark, sf_dir):
    found = keys.filter_station(by_event_type(spark, sf_dir), "click")
    return found.select("event_id", STATION, TEMP)


def _alarming(users):
    return users.filter((F.col("event_type") == "error") & (F.col(TEMP) > 100))


def station_semi(spark, sf_dir):
    users = by_user(spark, sf_dir)
    return keys.keep_stations(users, _alarming(users)).select("event_id", STATION, TEMP)


def station_anti(spark, sf_dir):
    users = by_user(spark, sf_dir)
    return keys.drop_stations(users, _alarming(users)).select("event_id", STATION, TEMP)


def station_semi_gated(spark, sf_dir):
    """The same as if the keys were too many to broadcast: rows pass a Bloom filter before they are shuffled."""
    users = by_user(spark, sf_dir)
    found = keys.keep_stations(users, _alarming(users), broadcast_bytes=0)
    return found.select("event_id", STATION, TEMP)


def keys_join_partials(spark, sf_dir):
    users = by_user(spark, sf_dir)
    states = store(partial.partial_state(users, SCALE), "states")
    found = keys.keys_join_partials(_alarming(users), states)
    return found.select(
        "chunk", STATION, "t_min", F.col("t_sum").cast("double").alias("t_sum"), "t_max", "n"
    )


def keys_join_shuffled(spark, sf_dir):
    """The same as if the keys were too many to broadcast, and some users hot."""
    users = by_user(spark, sf_dir)
    states = store(partial.partial_state(users, SCALE), "states")
    found = keys.keys_join_partials(_alarming(users), states, broadcast_bytes=0, rows_per_task=10)
    return found.select(
        "chunk", STATION, "t_min", F.col("t_sum").cast("double").alias("t_sum"), "t_max", "n"
    )


def lookup_join(spark, sf_dir):
    users = by_user(spark, sf_dir)
    result = summary.rounded(summary.station_stats(users, SCALE))
    return keys.lookup(keys.distinct_stations(_alarming(users)), result)


def _full_join(spark, sf_dir, **how_to_join):
    """Events by the whole part of their value with customers by tens of their balance.

    Either side has stations that the other one has not.
    """
    result = summary.rounded(summary.station_stats(by_balance(spark, sf_dir), SCALE))
    rows = by_whole_value(spark, sf_dir).select("event_id", STATION)
    return keys.join_on_station(rows, result, "full", **how_to_join)


def stored_lookup(spark, sf_dir):
    """The same from a result that is stored in buckets, which a lookup leaves where it is."""
    users = by_user(spark, sf_dir)
    table = _stored(spark, summary.rounded(summary.station_stats(users, SCALE)))
    return stored.lookup_stored(_alarming(users), table)


def stored_point(spark, sf_dir):
    """One station of a stored result: a row group of one bucket is read."""
    table = _stored(spark, summary.rounded(summary.station_stats(by_part(spark, sf_dir), SCALE)))
    return stored.row_of(table, "42")


def _stored(spark, result):
    path = new_path(spark, "result")
    return stored.store_result(result, path.rsplit("/", 1)[1].replace("-", "_"), path, buckets=8)


def full_join(spark, sf_dir):
    return _full_join(spark, sf_dir)


def full_join_shuffled(spark, sf_dir):
    return _full_join(spark, sf_dir, broadcast_bytes=0, rows_per_task=20)


# Functions


def _event_lines(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    line = join_fields(F.col("event_type"), F.col("value"), SCALE)
    return events.select("event_id", line.alias("line"), "props")


def fn_split(spark, sf_dir):
    fields = F.split("line", SEP)
    return _event_lines(spark, sf_dir).select(
        "event_id", fields[0].alias("station"), fields[1].alias("temp_text"), F.size(fields).alias("n_fields")
    )


def fn_locate(spark, sf_dir):
    """Multi-byte text cut at its first space."""
    pos = F.locate(" ", F.col("text"))
    rest = F.col("text").substr(pos + 1, F.length("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", pos.alias("pos"), F.substring_index("text", " ", 1).alias("head"), rest.alias("rest")
    )


def fn_parse(spark, sf_dir):
    return _event_lines(spark, sf_dir).select(
        "event_id",
        before_sep(F.col("line")).alias("station"),
        after_sep(F.col("line")).cast("double").alias("temp"),
        finite_number(F.col("props")).alias("props_number"),
    )


def fn_round(spark, sf_dir):
    return by_event_type(spark, sf_dir).select("event_id", round_half_even(F.col(TEMP)).alias("rounded"))


def fn_least_greatest(spark, sf_dir):
    half = F.lit(50.0)
    return by_event_type(spark, sf_dir).select(
        "event_id", F.least(TEMP, half).alias("least_50"), F.greatest(TEMP, half).alias("greatest_50")
    )


def fn_array_index(spark, sf_dir):
    """The state of a chunk as an array, as a merge by position sees it."""
    states = partial.partial_state(by_event_type(spark, sf_dir), SCALE)
    numbers = [F.col(c).cast("double") for c in ("t_min", "t_sum", "t_max", "n")]
    states = states.select("chunk", STATION, F.array(*numbers).alias("state"))
    return states.select(
        "chunk", STATION, F.get("state", F.lit(0)).alias("t_min"), F.element_at("state", -1).alias("n")
    )


def fn_array_distinct_sort(spark, sf_dir):
    rows = lists.number_chunks(by_user(spark, sf_dir), "event_id", LIST_ROWS)
    types = F.array_sort(F.array_distinct(F.collect_list("event_type")))
    return rows.groupBy(STATION, "chunk").agg(F.array_join(types, ",").alias("types"))


# Sinks


def summary_map(spark, sf_dir):
    maps = report.summary_map(summary.station_stats(by_segment(spark, sf_dir), SCALE))
    return report.map_rows(maps)


def report_lines(spark, sf_dir):
    return report.report_lines(summary.station_stats(by_segment(spark, sf_dir), SCALE))


def report_string(spark, sf_dir):
    return report.report_string(summary.station_stats(by_segment(spark, sf_dir), SCALE))


def report_string_trailing(spark, sf_dir):
    stats = summary.station_stats(by_user(spark, sf_dir), SCALE)
    return report.report_string(stats, trailing_sep=True)


# From text to the printed form


def station_report_text(spark, sf_dir):
    return from_text.station_report(spark, as_text(by_segment(spark, sf_dir)), SCALE)


def report_mean_only(spark, sf_dir):
    """The mean rounded, minimum and maximum printed as they are."""
    path = as_text(by_segment(spark, sf_dir))
    return from_text.station_report(spark, path, SCALE, columns=["t_mean"])


def report_file(spark, sf_dir):
    """The lines of a written report, read back."""
    path = new_path(spark, "report")
    report.write_report_lines(summary.station_stats(by_segment(spark, sf_dir), SCALE), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


# Streaming


def _streamed(spark, rows, mode):
    # A few batches at any size: files of at most a quarter of the rows each,
    # and about a quarter of the bytes in a batch.
    path = as_text(rows, rows_per_file=rows.count() // 4 + 1)
    quarter = delimited.input_bytes(spark, path) // 4 + 1
    stats = incremental.incremental_stats(spark, path, SCALE, max_bytes=quarter)
    out = new_path(spark, "stream-out")
    incremental.run_available(stats, out, new_path(spark, "stream-checkpoint"), mode)
    return summary.rounded(incremental.latest_stats(spark, out, mode))


def stream_summary(spark, sf_dir):
    return _streamed(spark, by_event_type(spark, sf_dir), "complete")


def stream_summary_update(spark, sf_dir):
    return _streamed(spark, by_user(spark, sf_dir), "update")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        station_summary,
        station_summary_wide,
        station_summary_text,
        round_mean_only,
        agg_spec,
        result_shape,
        scan_delimited,
        scan_lines,
        scan_late_cast,
        strict_bad_rows,
        input_chunks,
        preview_head,
        preview_file_head,
        strict_good_rows,
        strict_set_aside,
        rename_columns,
        partial_state,
        merge_state,
        chunk_summary,
        mean_of_means,
        chunk_mean_report,
        fold_mean_variance,
        fold_extremes,
        apply_per_batch,
        apply_chunk_summary,
        group_to_list,
        group_to_bounded_list,
        list_summary,
        list_summary_raw,
        concat_lists,
        merge_lists,
        distinct_stations,
        union_distinct_stations,
        union_chunks,
        filter_station,
        station_semi,
        station_semi_gated,
        station_anti,
        keys_join_partials,
        keys_join_shuffled,
        lookup_join,
        stored_lookup,
        stored_point,
        full_join,
        full_join_shuffled,
        fn_split,
        fn_locate,
        fn_parse,
        fn_round,
        fn_least_greatest,
        fn_array_index,
        fn_array_distinct_sort,
        summary_map,
        report_lines,
        report_string,
        report_string_trailing,
        station_report_text,
        report_mean_only,
        report_file,
        stream_summary,
        stream_summary_update,
    )
}

"""Registry of named queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rillet.plans import (changes, dashboard, dau, documents, orders, publisher, routes, searches,
                          stateful, streams, topics)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    # daily actives
    "dau_realtime_hours": dau.dau_realtime_hours,
    "dau_wide": dau.dau_wide,
    "stage_counts": dau.stage_counts,
    "column_scan": dau.column_scan,
    "dau_total_day": dau.dau_total_day,
    "dau_count_by_hour": dau.dau_count_by_hour,
    "dau_hours_empty_today": dau.dau_hours_empty_today,
    # log routing
    "log_route_counts": routes.log_route_counts,
    "log_error_route": routes.log_error_route,
    "log_page_route": routes.log_page_route,
    "log_action_explode": routes.log_action_explode,
    "log_display_explode": routes.log_display_explode,
    "log_display_compat": routes.log_display_compat,
    "log_start_route": routes.log_start_route,
    # change records
    "cdc_op_map": routes.cdc_op_map,
    "cdc_fact_route": routes.cdc_fact_route,
    "cdc_dim_latest": routes.cdc_dim_latest,
    # order wide table
    "order_full_outer": orders.order_full_outer,
    "order_wide": orders.order_wide_report,
    "order_defaults": orders.order_defaults,
    # read side
    "stats_by_gender": publisher.stats_by_gender,
    "stats_by_age_band": publisher.stats_by_age_band,
    "stats_by_gender_day": publisher.stats_by_gender_day,
    "stats_by_age_band_day": publisher.stats_by_age_band_day,
    "stats_unknown_type": publisher.stats_unknown_type,
    "detail_by_item": publisher.detail_by_item,
    "detail_by_item_day": publisher.detail_by_item_day,
    "detail_total": publisher.detail_total,
    "missing_day": publisher.missing_day,
    "term_filter": publisher.term_filter,
    "range_filter": publisher.range_filter,
    "bool_filter": publisher.bool_filter,
    "exclude_fields": publisher.exclude_fields_q,
    "sort_page": publisher.sort_page,
    "point_get": publisher.point_get,
    "read_all": publisher.read_all,
    "max_agg": publisher.max_agg,
    "group_count_top10": publisher.group_count_top10,
    "nested_avg_topk": publisher.nested_avg_topk,
    "match_any": publisher.match_any_q,
    "fuzzy_match": publisher.fuzzy_match,
    "fuzzy_transpose": publisher.fuzzy_transpose,
    "highlight_han": publisher.highlight_han,
    "bm25_rank": publisher.bm25_rank,
    # keyed documents (M1-M6 K4 K6 U3), roll-up (D6), partitioner (U1 U2), scalars
    "upsert_last_wins": documents.upsert_last_wins,
    "partial_update": documents.partial_update,
    "update_by_query": documents.update_by_query,
    "delete_by_id": documents.delete_by_id,
    "bulk_delete": documents.bulk_delete,
    "stored_delete": documents.stored_delete,
    "append_new": documents.append_new,
    "append_ids_unique": documents.append_ids_unique,
    "json_members": documents.json_members,
    "event_rollup": documents.event_rollup,
    "route_partition_ids": documents.route_partition_ids,
    "scalar_map_json": documents.scalar_map_json,
    # dashboard (Q1-Q15)
    "q01_pv": dashboard.q01_pv,
    "q02_uv": dashboard.q02_uv,
    "q03_visit_total": dashboard.q03_visit_total,
    "q04_new_visit_stats": dashboard.q04_new_visit_stats,
    "q05_channel_pv": dashboard.q05_channel_pv,
    "q06_channel_bounce": dashboard.q06_channel_bounce,
    "q07_page_path": dashboard.q07_page_path,
    "q07_page_nodes": dashboard.q07_page_nodes,
    "q08_user_action_convert": dashboard.q08_user_action_convert,
    "q09_user_paid": dashboard.q09_user_paid,
    "q10_user_total": dashboard.q10_user_total,
    "q11_spu": dashboard.q11_spu,
    "q12_tm": dashboard.q12_tm,
    "q13_category": dashboard.q13_category,
    "q14_area": dashboard.q14_area,
    "q15_order_total": dashboard.q15_order_total,
    # streaming replays
    "stream_dau_dedup": streams.stream_dau_dedup,
    "stream_restart": streams.stream_restart,
    "state_rebuild": streams.state_rebuild,
    "stream_order_join": streams.stream_order_join,
    "stream_log_routes": streams.stream_log_routes,
    "log_route_contents": streams.log_route_contents,
    "stream_cdc_dims": streams.stream_cdc_dims,
    "stream_fact_topics": streams.stream_fact_topics,
    "stream_cdc_config_change": streams.stream_cdc_config_change,
    "stream_chain": streams.stream_chain,
    "stream_late_dropped": streams.stream_late_dropped,
    # where a topic stream starts and resumes
    "stream_latest_start": topics.stream_latest_start,
    "stream_explicit_offsets": topics.stream_explicit_offsets,
    # keyed state with timers (D2 D6), metrics of every batch
    "stream_midnight_expiry": stateful.stream_midnight_expiry,
    "stream_event_rollup": stateful.stream_event_rollup,
    "stream_stage_metrics": stateful.stream_stage_metrics,
    # change and log records of any shape
    "cdc_variant_route": changes.cdc_variant_route,
    "cdc_quarantine": changes.cdc_quarantine,
    "log_quarantine": changes.log_quarantine,
    # search over an inverted index
    "bm25_index_rank": searches.bm25_index_rank,
    "index_match_all": searches.index_match_all,
    "fuzzy_index_match": searches.fuzzy_index_match,
    "fuzzy_index_transpose": searches.fuzzy_index_transpose,
    "highlight_fragments": searches.highlight_fragments,
    # deep pages (L2), rows on the partition asked for
    "deep_page": searches.deep_page,
    "partition_placement": documents.partition_placement,
}
# the dashboard as it is asked most: the last 7 days
QUERIES |= {f"{name}_7d": dashboard.last_week(query) for name, query in QUERIES.items()
            if query.__module__ == dashboard.__name__}

"""Web-log analytics (workflow W-A).

parse -> domain group -> organisation -> top-k + rest -> leading organisation
-> day x hour request grid.  One plan per question; the three country groups
are handled in the same pass (a ``grp`` column) instead of three jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import logparse as lp

# Academic domain groups (name, host suffix, organisation labels).
DOMAIN_GROUPS = [("JP", ".ac.jp", 3), ("UK", ".ac.uk", 3), ("US", ".edu", 2)]
REST_KEY = "rest"


def parse_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Raw lines -> (host, timestamp, request, status, bytes)."""
    return lines.select(*lp.parse_columns(value_col))


def group_column(host: str = "host", groups=DOMAIN_GROUPS):
    """the domain group of a host (case-sensitive suffix), else null."""
    expr = None
    for name, suffix, _ in groups:
        cond = F.col(host).endswith(suffix)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def with_group(parsed: DataFrame, groups=DOMAIN_GROUPS) -> DataFrame:
    """Keep rows of the academic groups and tag them with ``grp``."""
    return (parsed.withColumn("grp", group_column("host", groups))
            .filter(F.col("grp").isNotNull()))


def with_org(grouped: DataFrame, groups=DOMAIN_GROUPS) -> DataFrame:
    """Organisation key, last 3 or 2 host labels depending on the group."""
    labels = None
    for name, _, n in groups:
        cond = F.col("grp") == name
        labels = F.when(cond, F.lit(n)) if labels is None else labels.when(cond, F.lit(n))
    return grouped.withColumn("org", lp.org_key("host", labels))


def group_names(spark, groups=DOMAIN_GROUPS) -> DataFrame:
    """The fixed list of group names as a tiny frame (one row per group)."""
    return spark.createDataFrame([(g[0],) for g in groups], "grp string")


def requests_by_group(parsed: DataFrame, groups=DOMAIN_GROUPS) -> DataFrame:
    """A1: requests per academic group in one pass; absent groups count 0."""
    counts = with_group(parsed, groups).groupBy("grp").agg(F.count(F.lit(1)).alias("requests"))
    names = group_names(parsed.sparkSession, groups)
    # The name list has exactly len(groups) rows: a proven bound.
    return (F.broadcast(names).join(counts, "grp", "left")
            .select("grp", F.coalesce("requests", F.lit(0)).alias("requests")))


def hosts_by_group(parsed: DataFrame, groups=DOMAIN_GROUPS) -> DataFrame:
    """D26 extra: distinct hosts and requests per group.

    Two aggregation levels (per host, then per group), each partial before
    its shuffle, so a host with a third of all requests costs one row per task.
    """
    per_host = (with_group(parsed, groups).groupBy("grp", "host")
                .agg(F.count(F.lit(1)).alias("_n")))
    counts = per_host.groupBy("grp").agg(F.count(F.lit(1)).alias("hosts"),
                                         F.sum("_n").alias("requests"))
    names = group_names(parsed.sparkSession, groups)
    return (F.broadcast(names).join(counts, "grp", "left")
            .select("grp", F.coalesce("hosts", F.lit(0)).alias("hosts"),
                    F.coalesce("requests", F.lit(0)).alias("requests")))


def org_requests(parsed: DataFrame, groups=DOMAIN_GROUPS) -> DataFrame:
    """A2: requests per (group, organisation); partial aggregation map-side."""
    return (with_org(with_group(parsed, groups), groups)
            .groupBy("grp", "org").agg(F.count(F.lit(1)).alias("requests")))


def top_k(counts: DataFrame, k: int, by: str = "grp", key: str = "org",
          value: str = "requests") -> DataFrame:
    """O3: the k largest ``value`` rows per ``by``; ties go to the smaller key.

    ``row_number`` followed by a ``<= k`` filter lets Spark insert a
    per-partition group limit before the shuffle, so each task forwards at
    most k rows per group however many keys a group has.
    """
    w = Window.partitionBy(by).orderBy(F.col(value).desc(), F.col(key).asc())
    return (counts.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k))


def top_k_with_rest(counts: DataFrame, k: int = 9, by: str = "grp",
                    key: str = "org", value: str = "requests",
                    rest_key: str = REST_KEY) -> DataFrame:
    """Top-k rows per group plus one ``rest`` row = total - sum(top k).

    The rest row is always present (0 when a group has k keys or fewer) and
    carries rank k + 1.
    """
    top = top_k(counts, k, by, key, value)
    totals = counts.groupBy(by).agg(F.sum(value).alias("_total"))
    top_sum = top.groupBy(by).agg(F.sum(value).alias("_top"))
    rest = (totals.join(top_sum, by)
            .select(by, F.lit(k + 1).alias("rank"), F.lit(rest_key).alias(key),
                    (F.col("_total") - F.col("_top")).alias(value)))
    return top.select(by, "rank", key, value).unionByName(rest)


def with_share(buckets: DataFrame, by: str = "grp",
               value: str = "requests") -> DataFrame:
    """Each row's share of its group's total (the pie percentages)."""
    total = F.sum(value).over(Window.partitionBy(by))
    return buckets.withColumn("share", F.try_divide(F.col(value).cast("double"), total))


def leaders(counts: DataFrame, by: str = "grp", key: str = "org",
            value: str = "requests") -> DataFrame:
    """The top organisation of each group: (grp, leader)."""
    return (top_k(counts, 1, by, key, value)
            .select(by, F.col(key).alias("leader")))


def leader_rows(parsed: DataFrame, k_leaders: DataFrame | None = None,
                match: str = "contains", groups=DOMAIN_GROUPS) -> DataFrame:
    """the requests of each group's leading organisation.

    ``match='contains'`` keeps every organisation whose key contains the
    leader's (the original rule); ``match='eq'`` keeps exact matches only.
    The leader table holds at most one row per group (a fixed, small set),
    so it is broadcast.
    """
    rows = with_org(with_group(parsed, groups), groups)
    if k_leaders is None:
        k_leaders = leaders(rows.groupBy("grp", "org")
                            .agg(F.count(F.lit(1)).alias("requests")))
    lead = F.broadcast(k_leaders.select(F.col("grp").alias("_lgrp"), "leader"))
    cond = F.col("grp") == F.col("_lgrp")
    if match == "contains":
        cond = cond & F.col("org").contains(F.col("leader"))
    elif match == "eq":
        cond = cond & (F.col("org") == F.col("leader"))
    else:
        raise ValueError("match must be 'contains' or 'eq'")
    return rows.join(lead, cond).drop("_lgrp")


def leader_requests(parsed: DataFrame, match: str = "contains",
                    groups=DOMAIN_GROUPS) -> DataFrame:
    """Requests of the leading organisation per group: (grp, leader, requests)."""
    return (leader_rows(parsed, match=match, groups=groups)
            .groupBy("grp", "leader").agg(F.count(F.lit(1)).alias("requests")))


def org_hour_cells(parsed: DataFrame, groups=DOMAIN_GROUPS) -> DataFrame:
    """One pass over the log: (grp, org, day, hour, requests, first_t, last_t).

    Everything about the leading organisation (its requests, day x hour grid,
    time span) is answered from this aggregate, so the raw log is scanned
    once and all later work runs on at most orgs x days x 24 rows.
    """
    rows = with_org(with_group(parsed, groups), groups)
    t = lp.log_time("timestamp")
    return (rows.select("grp", "org", lp.day_of("timestamp").alias("day"),
                        lp.hour_of("timestamp").alias("hour"), t.alias("_t"))
            .groupBy("grp", "org", "day", "hour")
            .agg(F.count(F.lit(1)).alias("requests"), F.min("_t").alias("first_t"),
                 F.max("_t").alias("last_t")))


def leader_cells(cells: DataFrame, match: str = "contains") -> DataFrame:
    """F2 on the aggregate: the cells of each group's leading organisation(s).

    The leader is the top organisation by total requests (ties: smaller
    key); with ``match='contains'`` every organisation containing it is kept.
    The leader table has one row per group, a fixed small set: broadcast.
    """
    totals = cells.groupBy("grp", "org").agg(F.sum("requests").alias("requests"))
    lead = F.broadcast(leaders(totals).select(F.col("grp").alias("_lgrp"), "leader"))
    cond = F.col("grp") == F.col("_lgrp")
    if match == "contains":
        cond = cond & F.col("org").contains(F.col("leader"))
    elif match == "eq":
        cond = cond & (F.col("org") == F.col("leader"))
    else:
        raise ValueError("match must be 'contains' or 'eq'")
    return cells.join(lead, cond).drop("_lgrp")


def leader_cell_requests(lcells: DataFrame) -> DataFrame:
    """(grp, leader, requests) from leader cells."""
    return lcells.groupBy("grp", "leader").agg(F.sum("requests").alias("requests"))


def cell_heat(lcells: DataFrame) -> DataFrame:
    """A3 on leader cells: (grp, day, hour, requests)."""
    return lcells.groupBy("grp", "day", "hour").agg(F.sum("requests").alias("requests"))


def cell_span(lcells: DataFrame) -> DataFrame:
    """A4 on leader cells: first and last request time per group."""
    return lcells.groupBy("grp").agg(F.min("first_t").alias("first_request"),
                                     F.max("last_t").alias("last_request"))


def dense_grid(heat: DataFrame, span: DataFrame) -> DataFrame:
    """Zero-filled day x hour grid from cell counts and the time span.

    Days run over the calendar days between first and last request (as 'dd'
    labels, at most 31 per group) and hours 00-23, generated by
    ``sequence``/``explode``; grid and counts are full-outer joined, so a
    counted cell outside the typed span (unparsable time) is kept.  No
    cross join.
    """
    days = (span.select("grp", F.explode(F.sequence(F.to_date("first_request"),
                                                    F.to_date("last_request"))).alias("_d"))
            .select("grp", F.date_format("_d", "dd").alias("day")).distinct())
    grid = days.select("grp", "day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h"))
    grid = grid.select("grp", "day", F.lpad(F.col("_h").cast("string"), 2, "0").alias("hour"))
    return (grid.join(heat, ["grp", "day", "hour"], "full")
            .select("grp", "day", "hour", F.coalesce("requests", F.lit(0)).alias("requests"))
            .orderBy("grp", "day", "hour"))


def heat_counts(rows: DataFrame) -> DataFrame:
    """A3: requests per (grp, day, hour), unordered."""
    return (rows.select("grp", lp.day_of("timestamp").alias("day"),
                        lp.hour_of("timestamp").alias("hour"))
            .groupBy("grp", "day", "hour").agg(F.count(F.lit(1)).alias("requests")))


def heat_sparse(rows: DataFrame) -> DataFrame:
    """A3 + O2: requests per (grp, day, hour), ordered by day then hour."""
    return heat_counts(rows).orderBy("grp", "day", "hour")


def heat_dense(rows: DataFrame) -> DataFrame:
    """A8 on leader rows: the full day x hour grid per group, zero-filled."""
    return dense_grid(heat_counts(rows), time_span(rows))


def heat_peak(rows: DataFrame) -> DataFrame:
    """A5: the busiest cell's request count per group."""
    return heat_counts(rows).groupBy("grp").agg(F.max("requests").alias("peak_requests"))


def time_span(rows: DataFrame) -> DataFrame:
    """A4: first and last request time per group, on typed time."""
    t = lp.log_time("timestamp")
    return rows.groupBy("grp").agg(F.min(t).alias("first_request"),
                                   F.max(t).alias("last_request"))

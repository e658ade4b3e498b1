"""Funnels, A/B statistics and reports in long metric form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import HOUR_MS
from ..functions.numeric import finite, ratio

# Page, card, action and status names of the behaviour log.
HOME_PAGES = ("recommend", "client_homepage", "native_home_feature")
REC_CARD = "recApps"
REQUESTED, INSTALLED = "download_request", "install_success"
USER_INSTALLS = ("manual_install", "auto_install")

# Experiment labels by push minute, by task, and by both.
MINUTE_LABELS = {"00": "push_at_00min", "15": "push_at_15min", "30": "push_at_30min", "45": "push_at_45min"}
TASK_LABELS = {"SH": "no_score", "BSOF": "position_score", "BSPT": "position_and_updateTime_score"}
TASK_MINUTE_LABELS = {("BSOF", "00"): "exp_position_score", ("BSPT", None): "exp_new_score"}


def _labelled(column: str, labels: dict[str, str]) -> Column:
    return reduce(lambda acc, kv: acc.when(F.col(column) == kv[0], kv[1]), labels.items(), F.when(F.lit(False), None))


def by_minute(pushes: DataFrame) -> DataFrame:
    return pushes.withColumn("expid", _labelled("push_minute", MINUTE_LABELS))


def by_task(pushes: DataFrame) -> DataFrame:
    return pushes.where(F.col("task_id").isin(*TASK_LABELS)).withColumn("expid", _labelled("task_id", TASK_LABELS))


def by_task_and_minute(pushes: DataFrame) -> DataFrame:
    """Labels by task and minute; rows without a label go."""
    label = F.when(F.lit(False), None)
    for (task, minute), name in TASK_MINUTE_LABELS.items():
        hit = F.col("task_id") == task
        label = label.when(hit if minute is None else hit & (F.col("push_minute") == minute), name)
    return pushes.withColumn("expid", label).where(F.col("expid").isNotNull())


def ab_stats(pushes: DataFrame) -> DataFrame:
    """Exposures, clicks and their rates, by rows and by users, per push date and experiment.

    Rows are first folded to one per user, so the distinct counts become sums.
    """
    per_user = pushes.groupBy("push_date", "expid", "user_id").agg(
        F.count_if(F.col("type") == "EXPOSE").alias("e"), F.count_if(F.col("type") == "CLICK").alias("c"))
    stats = per_user.groupBy("push_date", "expid").agg(
        F.sum("e").alias("pv_expose"), F.sum("c").alias("pv_click"),
        F.count_if(F.col("e") > 0).alias("uv_expose"), F.count_if(F.col("c") > 0).alias("uv_click"))
    return stats.select("push_date", "expid", "pv_expose", "pv_click", ratio("pv_click", "pv_expose").alias("pv_ctr"),
                        "uv_expose", "uv_click", ratio("uv_click", "uv_expose").alias("uv_ctr"))


def long_metrics(wide: DataFrame, dims: list[str], metrics: list[str], key: str = "index_key", value: str = "index_value") -> DataFrame:
    """One row per metric; null, NaN and infinite values and repeated rows go."""
    typed = wide.select(*dims, *[F.col(m).cast("double").alias(m) for m in metrics])
    return typed.unpivot(dims, metrics, key, value).where(finite(value)).distinct()


def exploded_track(track: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per event and experiment id, for events logged on their experiment's day, with the item's level."""
    from ..sources.logs import experiment_fields

    fields = experiment_fields("packed")
    dated = (track.where(F.col("packed").isNotNull() & F.col("user_id").isNotNull())
             .withColumn("_day", fields["exp_date"]).withColumn("_ids", fields["model_ids"]).where(F.col("_day") == F.col("date")))
    return dated.join(catalog.select("item_id", "level"), "item_id").drop("_day")


def with_uninstalls(track: DataFrame, log: DataFrame) -> DataFrame:
    """Left join of the same day's last uninstall per hour of the same user and item."""
    last = (log.where(F.col("action") == "uninstall").groupBy("user_id", "item_id", "date", F.col("hour").alias("uninstall_hour"))
            .agg(F.max("time_ms").alias("uninstall_ms")))
    return track.join(last, ["user_id", "item_id", "date"], "left")


def funnel_track(track: DataFrame, catalog: DataFrame) -> DataFrame:
    return with_uninstalls(exploded_track(track, catalog), track).withColumn("model_id", F.explode("_ids")).drop("_ids")


def _reached_home() -> Column:
    """From a card on a home page, or on a detail page opened from one."""
    direct = F.col("page").isin(*HOME_PAGES) & (F.col("card_type") == REC_CARD)
    detail = F.col("page").contains("detail") & F.col("pre_page").isin(*HOME_PAGES) & (F.col("pre_card_type") == REC_CARD)
    return direct | detail


_DIMS = ["date", "model_id", "level"]


def exposure_stats(track: DataFrame) -> DataFrame:
    home = F.col("page").isin(*HOME_PAGES)
    seen, clicked = home & (F.col("action") == "item_exposure"), home & (F.col("action") == "item_click")
    folded = track.groupBy(*_DIMS, "user_id", "item_id").agg(F.count_if(seen).alias("s"), F.count_if(clicked).alias("c"))
    some = lambda n, col: F.when(F.col(n) > 0, F.col(col))
    return folded.groupBy(*_DIMS).agg(
        F.sum("s").alias("exposure_pv"), F.count_distinct(some("s", "user_id")).alias("exposure_uv"),
        F.count_distinct(some("s", "item_id")).alias("exposure_app"), F.sum("c").alias("click_pv"),
        F.count_distinct(some("c", "user_id")).alias("click_uv"), F.count_distinct(some("c", "item_id")).alias("click_app"),
        F.sum("s").alias("exposure_app_pv"))


def stage_stats(track: DataFrame, stage: str, condition: Column, uninstalls: bool = False) -> DataFrame:
    """Counts of one funnel stage: all, and those not uninstalled within the hour (``eff_``).

    Rows are folded to one per user and item before the distinct counts.
    """
    gap = F.col("uninstall_ms") - F.col("time_ms")
    kept = F.col("uninstall_hour").isNull() | (gap > HOUR_MS)
    folded = track.where(_reached_home() & condition).groupBy(*_DIMS, "user_id", "item_id").agg(
        F.count("*").alias("n"), F.count_if(kept).alias("k"), F.count_if(gap > 0).alias("u"),
        F.count_if((gap > 0) & (gap < HOUR_MS)).alias("h"))
    some = lambda n, col: F.when(F.col(n) > 0, F.col(col))
    metrics = [
        F.sum("n").alias(f"{stage}_pv"), F.count_distinct("user_id").alias(f"{stage}_uv"), F.count("*").alias(f"{stage}_puv"),
        F.count_distinct("item_id").alias(f"{stage}_app"), F.sum("k").alias(f"eff_{stage}_pv"),
        F.count_distinct(some("k", "user_id")).alias(f"eff_{stage}_uv"),
        F.count_distinct(some("k", "item_id")).alias(f"eff_{stage}_app"), F.sum("k").alias(f"eff_{stage}_puv")]
    if uninstalls:
        # The puv names are plain counts; the report is defined that way.
        metrics += [F.count_distinct(some("u", "user_id")).alias("uninstall_uv"),
                    F.count_distinct(some("u", "item_id")).alias("uninstall_app"), F.sum("u").alias("uninstall_puv"),
                    F.sum("u").alias("uninstall_puv_day"), F.sum("h").alias("uninstall_puv_hour")]
    return folded.groupBy(*_DIMS).agg(*metrics)


def _user_install(status: str) -> Column:
    return ((F.col("action") == "download_install") & (F.col("install_status") == status)
            & F.col("install_type").isin(*USER_INSTALLS))


def download_stats(track: DataFrame) -> DataFrame:
    return stage_stats(track, "download", _user_install(REQUESTED), uninstalls=True)


def install_stats(track: DataFrame) -> DataFrame:
    return stage_stats(track, "install", _user_install(INSTALLED))


def active_stats(track: DataFrame) -> DataFrame:
    return stage_stats(track, "active", F.col("action") == "activate")


def funnel_report(track: DataFrame, by_model: bool = False) -> DataFrame:
    """Means over the experiments (or per experiment) that reached every stage, with uninstall rates.

    The track is folded once, to one row per user and item with the counts of all stages.
    """
    gap = F.col("uninstall_ms") - F.col("time_ms")
    home = _reached_home()
    downloaded = home & _user_install(REQUESTED)
    folded = track.dropna(subset=_DIMS).groupBy(*_DIMS, "user_id", "item_id").agg(
        F.count_if(F.col("page").isin(*HOME_PAGES) & (F.col("action") == "item_exposure")).alias("s"),
        F.count_if(downloaded).alias("d"), F.count_if(home & _user_install(INSTALLED)).alias("i"),
        F.count_if(home & (F.col("action") == "activate")).alias("a"), F.count_if(downloaded & (gap > 0)).alias("u"),
        F.count_if(downloaded & (gap > 0) & (gap < HOUR_MS)).alias("h"))
    counts = folded.groupBy(*_DIMS).agg(
        F.sum("s").alias("exposure_app_pv"), F.count_if(F.col("d") > 0).alias("download_puv"),
        F.count_if(F.col("i") > 0).alias("install_puv"), F.sum("u").alias("uninstall_puv_day"),
        F.sum("h").alias("uninstall_puv_hour"), F.sum("a").alias("active_pv"))
    reached = counts.where("download_puv > 0 AND install_puv > 0 AND active_pv > 0")
    names = ["exposure_app_pv", "download_puv", "install_puv", "uninstall_puv_day", "uninstall_puv_hour"]
    dims = _DIMS if by_model else ["date", "level"]
    means = reached.groupBy(*dims).agg(*[F.avg(n).alias(n) for n in names])
    rate = lambda n: F.round(ratio(n, "install_puv"), 4)
    return (means.withColumn("uninstall_day_rate", rate("uninstall_puv_day"))
            .withColumn("uninstall_hour_rate", rate("uninstall_puv_hour")))


def uninstall_rate(installs: DataFrame, uninstalls: DataFrame, catalog: DataFrame, levels: list[str],
                   across_midnight: bool = False) -> DataFrame:
    """Share of installers that uninstall within an hour and a day, per item.

    ``installs`` and ``uninstalls`` hold ``user_id, item_id, time_ms, date``. Both
    must fall on one date unless ``across_midnight``. Dates without any such
    uninstall do not count. Rates have four decimals.
    """
    scope = catalog.where(F.col("level").isin(levels)).select("item_id")
    starts = installs.join(scope, "item_id", "left_semi").groupBy("user_id", "item_id", "date", "time_ms").agg(F.lit(1).alias("_one"))
    ends = uninstalls.join(scope, "item_id", "left_semi").groupBy("user_id", "item_id", "date", F.col("time_ms").alias("end_ms")).agg(
        F.lit(1).alias("_two"))
    on = ["user_id", "item_id"] if across_midnight else ["user_id", "item_id", "date"]
    matched = starts.join(ends.drop("date") if across_midnight else ends, on, "left")
    gap = F.col("end_ms") - F.col("time_ms")
    within = lambda hours: F.max(F.coalesce((gap > 0) & (gap <= hours * HOUR_MS), F.lit(False)))
    per_user = matched.groupBy("item_id", "date", "user_id").agg(within(1).alias("h"), within(24).alias("d"))
    daily = per_user.groupBy("item_id", "date").agg(
        F.count("*").alias("i"), F.count_if("h").alias("h"), F.count_if("d").alias("d")).where("h > 0 or d > 0")
    sums = daily.groupBy("item_id").agg(
        F.sum("i").alias("install_uv"), F.sum("h").alias("hour_uninstall_uv"), F.sum("d").alias("day_uninstall_uv"))
    return (sums.withColumn("hour_uninstall_rate", F.round(ratio("hour_uninstall_uv", "install_uv"), 4))
            .withColumn("day_uninstall_rate", F.round(ratio("day_uninstall_uv", "install_uv"), 4))
            .join(catalog.select("item_id", "level"), "item_id"))


def roll_up(df: DataFrame, column: str, members: DataFrame | list[str], label: str, dims: list[str]) -> DataFrame:
    """The rows, and below them the sums of several members under one label, flagged ``rolled``.

    ``members`` is a list or a one-column frame of values of ``column``.
    """
    flagged = df if "rolled" in df.columns else df.withColumn("rolled", F.lit(False))
    if isinstance(members, DataFrame):
        chosen = flagged.join(members.select(F.col(members.columns[0]).alias(column)), column, "left_semi")
    else:
        chosen = flagged.where(F.col(column).isin(members))
    metrics = [c for c in flagged.columns if c not in (*dims, "rolled")]
    summed = (chosen.withColumn(column, F.lit(label)).groupBy(*dims).agg(*[F.sum(m).alias(m) for m in metrics])
              .withColumn("rolled", F.lit(True)))
    return flagged.unionByName(summed.select(*flagged.columns))


def daily_counts(log: DataFrame, dims: list[str], kinds: dict[str, Column], means: dict[str, Column] | None = None,
                 user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Per group of ``dims``: ``k_pv, k_uv, k_puv`` (rows, users, user-item pairs) of every kind, means over rows, ``users``.

    The log is folded to one row per user and item and then to one per user, so all distinct counts are sums: one scan,
    and no row is copied for a count. Rows without a user or an item count as rows only.
    """
    means = means or {}
    folded = log.groupBy(*dims, user, item).agg(
        *[F.count_if(c).alias(k) for k, c in kinds.items()], *[F.sum(c.cast("double")).alias(f"_s_{m}") for m, c in means.items()],
        *[F.count(c).alias(f"_n_{m}") for m, c in means.items()])
    both = F.col(user).isNotNull() & F.col(item).isNotNull()
    per_user = folded.groupBy(*dims, user).agg(
        *[F.sum(k).alias(k) for k in kinds], *[F.count_if((F.col(k) > 0) & both).alias(f"_p_{k}") for k in kinds],
        *[F.sum(f"_{x}_{m}").alias(f"_{x}_{m}") for m in means for x in "sn"])
    return per_user.groupBy(*dims).agg(
        *[F.sum(k).alias(f"{k}_pv") for k in kinds], *[F.count_if((F.col(k) > 0) & F.col(user).isNotNull()).alias(f"{k}_uv") for k in kinds],
        *[F.sum(f"_p_{k}").alias(f"{k}_puv") for k in kinds], F.count(user).alias("users"),
        *[F.try_divide(F.sum(f"_s_{m}"), F.sum(f"_n_{m}")).alias(m) for m in means])


def labels_of(members: dict[str, list[str]], column: str) -> Column:
    """The labels of the groups that a value belongs to."""
    return F.filter(F.array(*[F.when(F.col(column).isin(values), F.lit(label)) for label, values in members.items()]), lambda x: x.isNotNull())


def roll_up(df: DataFrame, labels: dict[str, Column], dims: list[str], dropped: tuple[str, ...] = ()) -> DataFrame:
    """The rows, and the sums of several members under one label, flagged ``rolled``.

    ``labels`` gives for each column an array of the groups that a row's value belongs to (null or empty: none). A row is
    copied to its own value and to every label, over all columns, so that a region of experiment groups is summed as well;
    one aggregate makes all sums. Columns in ``dropped`` go.
    """
    metrics = [c for c in df.columns if c not in (*dims, "rolled", *dropped)]
    rows = df.withColumn("rolled", F.coalesce(F.col("rolled"), F.lit(False)) if "rolled" in df.columns else F.lit(False))
    for column, groups in labels.items():
        own = F.array(F.struct(F.col(column).alias("v"), F.lit(False).alias("r")))
        other = F.transform(F.coalesce(groups, F.array().cast("array<string>")), lambda g: F.struct(g.alias("v"), F.lit(True).alias("r")))
        rows = (rows.withColumn("_l", F.explode(F.concat(own, other))).withColumn(column, F.col("_l.v"))
                .withColumn("rolled", F.col("rolled") | F.col("_l.r")).drop("_l"))
    return rows.groupBy(*dims, "rolled").agg(*[F.sum(m).alias(m) for m in metrics])


# Report ratios as (name, numerator, denominator), counts as (name, column), rates that do not add up,
# metrics of the whole market, metrics a table may lack, and the ranges whose names are written another way.
RATIOS = (("cvr_pv", "download_puv", "expose_pv"), ("cvr_uv", "download_uv", "expose_uv"),
          ("avg_expose_download", "download_puv", "expose_uv"), ("ctr_pv", "click_pv", "expose_pv"),
          ("ctr_uv", "click_uv", "expose_uv"))
COUNTS = (("expose_pv", "expose_pv"), ("expose_uv", "expose_uv"), ("click_pv", "click_pv"), ("click_uv", "click_uv"),
          ("download_pv", "download_num"), ("download_uv", "download_uv"), ("download_puv", "download_puv"),
          ("download_pv_detail", "discover_detail_download_pv"), ("download_uv_detail", "discover_detail_download_uv"),
          ("download_puv_detail", "discover_detail_download_puv"), ("download_pv_get", "discover_get_pv"),
          ("download_uv_get", "discover_get_uv"), ("download_puv_get", "discover_get_puv"), ("install_num", "install_num"),
          ("install_uv", "install_uv"), ("install_puv", "install_puv"), ("active_num", "active_num"), ("active_uv", "active_uv"),
          ("active_puv", "active_puv"), ("discover_detail_expose_uv", "discover_detail_expose_uv"),
          ("discover_detail_expose_pv", "discover_detail_expose_pv"))
NOT_ADDITIVE = ("down_scroll_rate", "slide_rate", "retain_rate")
SEARCH = ("search_retain_rate", "search_uv", "search_retain_uv")
OPTIONAL = ("uninstall_rate", "eff_install_puv", "adpdau", "uninstall_puv2")
RANGES = ("top1000", "top1001-2000", "top2001-3000", "top3001-4000", "top4001-5000", "5000+")
NO_VALUE = -1.0


def report_metrics(wide: DataFrame, whole_market: bool = False) -> DataFrame:
    """``date, locale, model_id, page, stat_type`` (and ``market_v``) with every metric of the report.

    Rates that do not add up become −1 on rolled rows; metrics that a table may lack are −1 where it does; a count it
    lacks is null. Search retention belongs to the table of the whole market alone.
    """
    def column(name: str, absent: Column) -> Column:
        return F.col(name).cast("double") if name in wide.columns else absent

    dims = [c for c in ("date", "locale", "model_id", "page", "stat_type", "market_v") if c in wide.columns]
    none, missing = F.lit(None).cast("double"), F.lit(NO_VALUE)
    rolled = F.coalesce(F.col("rolled"), F.lit(False)) if "rolled" in wide.columns else F.lit(False)
    return wide.select(
        *dims, *[ratio(column(top, none), column(bottom, none)).alias(name) for name, top, bottom in RATIOS],
        *[column(source, none).alias(name) for name, source in COUNTS],
        *[F.when(rolled, missing).otherwise(column(name, none)).alias(name) for name in NOT_ADDITIVE],
        *[F.coalesce(column(name, missing), missing).alias(name) for name in (*(SEARCH if whole_market else ()), *OPTIONAL)])


def range_name(c: Column) -> Column:
    """Ranges of ranks as the report writes them; other names stay."""
    written = F.replace(F.replace(F.replace(c, F.lit("-"), F.lit("_")), F.lit("top"), F.lit("Top")), F.lit("+"), F.lit(""))
    return F.when(c.isin(*RANGES), written).otherwise(c)


def report_rows(wide: DataFrame, whole_market: bool = False) -> DataFrame:
    """``date, tag, index_key, index_value``: tag is locale, experiment and market version, the key page, group and metric.

    Group names of the whole market end in ``_all``; the version ``ALL`` is not written.
    """
    rated = report_metrics(wide, whole_market)
    dims = ("date", "locale", "model_id", "page", "stat_type", "market_v")
    tag = F.concat_ws("_", "locale", F.replace(F.col("model_id"), F.lit("-"), F.lit("_")))
    if "market_v" in rated.columns:
        tag = F.concat(tag, F.when(F.col("market_v") != "ALL", F.col("market_v")).otherwise(F.lit("")))
    group = F.concat(range_name(F.col("stat_type")), F.lit("_all" if whole_market else ""))
    tagged = rated.withColumn("tag", tag).withColumn("stat_type", group)
    rows = long_metrics(tagged, ["date", "tag", "page", "stat_type"], [c for c in rated.columns if c not in dims])
    return rows.select("date", "tag", F.concat_ws("_", "page", "stat_type", "index_key").alias("index_key"), "index_value").distinct()


def volume_check(snapshots: DataFrame, day: Column | str, days: int = 30, share: float = 0.8) -> DataFrame:
    """``today, mean_before, ok``: distinct items on a day against the mean of the days before it.

    ``snapshots`` holds ``item_id, date``. The mean is over ``days`` days.
    """
    day = F.lit(day) if isinstance(day, str) else day
    daily = snapshots.groupBy("date").agg(F.count_distinct("item_id").alias("n"))
    age = F.date_diff(F.to_date(day, "yyyyMMdd"), F.to_date("date", "yyyyMMdd"))
    sums = daily.agg(F.coalesce(F.sum(F.when(age == 0, F.col("n"))), F.lit(0)).alias("today"),
                     (F.coalesce(F.sum(F.when(age.between(1, days), F.col("n"))), F.lit(0)) / days).alias("mean_before"))
    return sums.withColumn("ok", F.col("today") >= F.col("mean_before") * share)


def require_volume(check: DataFrame) -> DataFrame:
    """The check's row, or an error when it failed."""
    return check.where(F.assert_true(F.col("ok"), F.lit("too few items today")).isNull())

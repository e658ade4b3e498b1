"""Lists, reports, profiles and audiences on small frames."""

import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shoal.functions.dates import day_shift
from shoal.operators import audience, filters, hot, profiles, reports, sets


def test_valid_id_drops_null_empty_and_zero(spark):
    rows = spark.createDataFrame([(None,), ("",), (filters.ZERO_ID,), ("a",)], "id string")
    assert [r.id for r in rows.where(filters.valid_id("id")).collect()] == ["a"]


def test_locale_widening(spark):
    regions = spark.createDataFrame([("A1", "A"), ("A2", "A"), ("B1", "B")], "locale string, cluster string")
    got = lambda *a, **k: sorted(r.locale for r in filters.locales_of(regions, *a, **k).collect())
    assert got("A1") == ["A1"] and got("A1,B1") == ["A1", "B1"] and got("A") == ["A1", "A2"]
    assert got("A1", widening=("A",)) == ["A1", "A2"] and got("A1,B1", widening=("A",)) == ["A1", "A2", "B1"]


def test_empty_audit_list_is_an_error(spark):
    tags = spark.createDataFrame([(1, 5, "20240130")], "item_id int, audit_tag int, date string")
    assert filters.audit_deny_list(tags, [5], "20240131").count() == 1
    with pytest.raises(ValueError):
        filters.audit_deny_list(tags, [9], "20240131")


def test_open_bands(spark):
    rows = spark.createDataFrame([("u1", "a"), ("u2", "a"), ("u2", "b"), ("u3", "a"), ("u3", "b"), ("u3", "c")], "u string, i string")
    got = filters.activity_band(rows, "u", "i", (1, 3), (0, 2))
    assert sorted(got.collect()) == [("u2", "a"), ("u2", "b")]


def test_trending_divides_by_the_days(spark):
    rows = [("u%d" % n, 1, "activate", "20240108") for n in range(6)] + [("u%d" % n, 1, "activate", "20240102") for n in range(7)]
    log = spark.createDataFrame(rows, "user_id string, item_id int, action string, date string")
    row = hot.trending(log, "20240108", ("20240101", "20240107"), 7, 0.2, floor_today=1, floor_before=1).first()
    assert row.ratio == 6.0
    assert hot.trending(log, "20240108", ("20240101", "20240107"), 7, 0.2, floor_today=7, floor_before=1).count() == 0


def test_lists_are_cut_by_score_then_item(spark):
    rows = spark.createDataFrame([("l", "b", 1.0), ("l", "a", 1.0), ("l", "c", 3.0)], "list_id string, item string, score double")
    from shoal.operators.topn import lists_of

    assert sorted(r.item for r in lists_of(rows, 2).collect()) == ["a", "c"]
    merged = hot.merge_lists(rows.select("item", F.lit(9.0).alias("score")), rows.select("item", "score"), "m", n=None)
    assert {r.score for r in merged.collect()} == {9.0}


def test_cold_start_puts_unseen_items_first(spark):
    rows = [("u1", 1, "item_exposure", "recommend", None, None), ("u1", 1, "download_install", "app_detail", "download_request", "auto_install")]
    log = spark.createDataFrame(rows, "user_id string, item_id int, action string, page string, install_status string, install_type string")
    pool = spark.createDataFrame([(1,), (2,)], "item_id int")
    got = {r.item: r.score for r in hot.cold_start(log, pool, "c", scale=0.1).collect()}
    assert got["2"] == hot.UNSEEN_SCORE and got["1"] == pytest.approx(1 + math.log10(5))


def test_weighted_categories_score(spark):
    rows = [("u", 1, "item_click", "d"), ("u", 1, "download_install", "d"), ("u", 1, "install", "d"), ("v", 1, "item_click", "d")]
    log = spark.createDataFrame(rows, "user_id string, item_id int, action string, date string")
    classes = spark.createDataFrame([(1, 5)], "item_id int, class int")
    assert [(r.user_id, r.score) for r in hot.weighted_categories(log, classes, 3, most_downloads=200).collect()] == [("u", 1.0)]


def test_usage_is_ordered_by_score(spark):
    usage = spark.createDataFrame([("u", "z", 1.0, 9.0), ("u", "a", 1.0, 1.0), ("u", "m", 0.0, 5.0)],
                                  "user_id string, item_id string, frequency double, duration double")
    assert [(r.item_id, r.score) for r in hot.top_usage(usage).orderBy("rank").collect()] == [("z", 48.0), ("a", 8.0)]


def test_neighbour_file_is_ordered_by_score(spark):
    rows = spark.createDataFrame([("a", 0.0, "a"), ("a", 0.3, "z"), ("a", 0.1, "b"), ("a", 0.5, "c")], "id string, distance double, item string")
    got = hot.knn_rows_to_lists(rows, 2, max_distance=0.42).orderBy("rank").collect()
    assert [(r.item, r.score) for r in got] == [("b", 99.9), ("z", 99.7)]


def test_thresholds_give_null_where_nothing_qualifies(spark):
    log = spark.createDataFrame([("u", 1), ("u", 1), ("v", 2)], "user_id string, item_id int")
    got = {r.user_id: (r.seen_1, r.seen_2) for r in hot.exposure_thresholds(log, "user_id", "item_id").collect()}
    assert got == {"u": ({"1": 1}, {"1": 2}), "v": ({"2": 1}, None)}


def test_uninstalls_match_within_one_date_unless_asked(spark):
    midnight = 1_706_572_800_000
    installs = spark.createDataFrame([("u", 1, midnight - 1000, "20240129")], "user_id string, item_id int, time_ms long, date string")
    gone = spark.createDataFrame([("u", 1, midnight + 1000, "20240130")], "user_id string, item_id int, time_ms long, date string")
    catalog = spark.createDataFrame([(1, "C")], "item_id int, level string")
    assert reports.uninstall_rate(installs, gone, catalog, ["C"]).count() == 0
    row = reports.uninstall_rate(installs, gone, catalog, ["C"], across_midnight=True).first()
    assert (row.install_uv, row.hour_uninstall_uv, row.day_uninstall_rate) == (1, 1, 1.0)


def test_long_metrics_drop_what_is_not_a_number(spark):
    wide = spark.createDataFrame([("d", 1, math.nan, math.inf, None, 2.0)], "date string, a int, b double, c double, e double, f double")
    got = {r.index_key: r.index_value for r in reports.long_metrics(wide, ["date"], ["a", "b", "c", "e", "f"]).collect()}
    assert got == {"a": 1.0, "f": 2.0}


def test_roll_up_and_sentinel(spark):
    cols = ["expose_pv", "expose_uv", "click_pv", "click_uv", "download_uv", "download_puv"]
    wide = spark.createDataFrame([("L", m, 10, 5, 2, 2, 1, 1, 0.5) for m in ("1", "2", "3")],
                                 "locale string, model_id string, " + ", ".join(f"{c} long" for c in cols) + ", retain_rate double")
    labels = {"model_id": reports.labels_of({"1_3": ["1", "3"], "1_2": ["1", "2"]}, "model_id"), "locale": F.array(F.lit("ALL"))}
    summed = reports.roll_up(wide, labels, ["locale", "model_id"])
    rows = {(r.locale, r.model_id): (r.expose_pv, r.rolled) for r in summed.collect()}
    assert rows == {("L", "1"): (10, False), ("L", "2"): (10, False), ("L", "3"): (10, False), ("L", "1_3"): (20, True), ("L", "1_2"): (20, True),
                    ("ALL", "1"): (10, True), ("ALL", "2"): (10, True), ("ALL", "3"): (10, True), ("ALL", "1_3"): (20, True), ("ALL", "1_2"): (20, True)}
    rated = reports.report_metrics(summed)
    row = rated.where("model_id = '1_3' and locale = 'L'").first()
    assert (row.retain_rate, row.ctr_pv, row.install_uv, row.uninstall_rate, "search_uv" in rated.columns) == (-1.0, 0.2, None, -1.0, False)
    assert rated.where("model_id = '1' and locale = 'L'").first().retain_rate == 0.5


def test_report_names_ranges_versions_and_the_whole_market(spark):
    wide = spark.createDataFrame([("d", "L", "1-2", "p", "top1001-2000", "ALL", 4, 2, 7), ("d", "L", "1", "p", "5000+", "v9", 4, 2, 7),
                                  ("d", "L", "1", "p", "other-x+", "v9", 4, 0, 7)],
                                 "date string, locale string, model_id string, page string, stat_type string, market_v string, expose_pv long, click_pv long, search_uv long")
    rows = {(r.tag, r.index_key): r.index_value for r in reports.report_rows(wide, whole_market=True).collect()}
    assert rows["L_1_2", "p_Top1001_2000_all_ctr_pv"] == 0.5 and rows["L_1v9", "p_5000_all_ctr_pv"] == 0.5
    assert rows["L_1v9", "p_other-x+_all_search_uv"] == 7.0 and rows["L_1v9", "p_other-x+_all_search_retain_rate"] == -1.0
    assert not any(k.endswith("install_uv") for _, k in rows)
    assert not any("search" in k for _, k in {(r.tag, r.index_key) for r in reports.report_rows(wide).collect()})


def test_daily_counts_equal_plain_counts(spark):
    rng = random.Random(2)
    rows = [("d%d" % rng.randrange(2), rng.choice(["u1", "u2", "u3", None]), rng.choice([1, 2, None]), rng.choice("ab"), rng.randrange(5)) for _ in range(120)]
    frame = spark.createDataFrame(rows, "day string, user_id string, item_id int, kind string, x int")
    got = {r.day: r for r in reports.daily_counts(frame, ["day"], {"a": F.col("kind") == "a"}, {"m": F.when(F.col("kind") == "a", F.col("x"))}).collect()}
    for day in ("d0", "d1"):
        own = [r for r in rows if r[0] == day and r[3] == "a"]
        assert got[day].a_pv == len(own) and got[day].a_uv == len({r[1] for r in own} - {None})
        assert got[day].a_puv == len({(r[1], r[2]) for r in own if r[1] and r[2]}) and got[day].m == pytest.approx(sum(r[4] for r in own) / len(own))
        assert got[day].users == len({r[1] for r in rows if r[0] == day} - {None})


def test_sliding_windows_equal_single_days(spark):
    rng = random.Random(5)
    rows = [(f"u{rng.randrange(12)}", rng.randrange(3), f"202401{rng.randrange(1, 29):02d}", "activate") for _ in range(500)]
    log = spark.createDataFrame(rows, "user_id string, item_id int, date string, action string")
    days = ["20240112", "20240113", "20240120", "20240128"]
    got = {(r.date, r.item_id): r.ratio for r in hot.trending_days(log, days, 7, 0.0, floor_today=1, floor_before=0).collect()}
    want = {}
    for day in days:
        before = (day_shift(day, -7), day_shift(day, -1))
        for r in hot.trending(log, day, before, 7, 0.0, floor_today=1, floor_before=0).collect():
            want[day, r.item_id] = r.ratio
    assert got == want and len(want) > 3


def test_cold_start_lists_have_their_own_totals(spark):
    rows = [("u1", 1, "item_exposure", "recommend", None, None), ("u1", 1, "download_install", "app_detail", "download_request", "auto_install"),
            ("u2", 3, "item_exposure", "recommend", None, None), ("u3", 3, "item_exposure", "recommend", None, None)]
    log = spark.createDataFrame(rows, "user_id string, item_id int, action string, page string, install_status string, install_type string")
    pool = spark.createDataFrame([(1, "app"), (2, "app"), (3, "game"), (4, "game")], "item_id int, list_id string")
    got = {(r.list_id, r.item): r.score for r in hot.cold_start(log, pool, "c", scale=0.1).collect()}
    assert got == {("c_app", "1"): pytest.approx(1 + math.log10(5)), ("c_app", "2"): hot.UNSEEN_SCORE, ("c_game", "4"): hot.UNSEEN_SCORE}
    assert {(r.list_id, r.item) for r in hot.cold_start(log, pool, "c", scale=0.1, only_logged=True).collect()} == {("c_app", "1")}


def test_hierarchy_equals_the_joined_flags(spark):
    rng = random.Random(7)
    rows = [(f"u{rng.randrange(9)}", rng.choice(["20240129", "20240130"]), rng.choice(["home", "push", "skip", None, ""]), rng.choice(["miniCard", "x"]),
             rng.choice(["recApps", "other"]), rng.randrange(6), rng.choice(["end", "go"]), rng.random() * 9) for _ in range(60)] + [("", "20240130", "home", "x", "recApps", 1, "end", 1.0)]
    log = spark.createDataFrame(rows, "user_id string, date string, launch_ref string, page_ref string, card_type string, card_pos int, action string, s double")
    launch = {"ignored": ["skip"], "page_refs": ["miniCard"]}
    today, ms = log.where("date = '20240130'"), F.col("s") * 1000
    levels = log.groupBy("user_id").agg(F.count("*").alias("n")).select("user_id", F.when(F.col("n") > 7, "high").otherwise("low").alias("level"))
    want = profiles.merged([profiles.glide_flags(today, **launch), profiles.duration_tiers(log, action="end", duration_ms=ms, **launch),
                            profiles.active_flags(today, home="home", **launch), profiles.level_flags(levels, "l", ("high", "low"))], only_valid=True)
    got = profiles.hierarchy(log, "20240130", ("20240129", "20240130"), "home", "end", ms, levels={"high": F.col("n") > 7, "low": F.lit(True)}, prefix="l", **launch)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_locale_flags_equal_locales_of(spark):
    regions = spark.createDataFrame([("A", "X"), ("B", "X"), ("C", "Y"), ("D", "Z")], "locale string, cluster string")
    predicates = {"one": ("A", ()), "many": ("A, C", ()), "cluster": ("X", ()), "wide": ("B,C", ("X",)), "any": ("C", True)}
    rows = filters.locale_flags(regions, predicates).collect()
    got = {name: sorted(r.locale for r in rows if r[name]) for name in predicates}
    assert got == {"one": ["A"], "many": ["A", "C"], "cluster": ["A", "B"], "wide": ["A", "B", "C"], "any": ["C"]}


def test_volume_check(spark):
    days = [(n, "20240130") for n in range(5)] + [(n, f"202401{d:02d}") for d in range(1, 30) for n in range(10)]
    snapshots = spark.createDataFrame(days, "item_id int, date string")
    row = reports.volume_check(snapshots, "20240130").first()
    assert (row.today, row.ok) == (5, False) and row.mean_before == pytest.approx(290 / 30)
    with pytest.raises(PySparkException):
        reports.require_volume(reports.volume_check(snapshots, "20240130")).collect()


def test_flags_and_tiers(spark):
    rows = [("a", "home", "x", "recApps", 4, "end", 3.0), ("b", "push", "x", "recApps", 1, "end", 30.0), ("c", None, "miniCard", "other", 9, "end", 10.0),
            ("d", "skip", "x", "recApps", 9, "end", 1.0)]
    log = spark.createDataFrame(rows, "user_id string, launch_ref string, page_ref string, card_type string, card_pos int, action string, seconds double")
    args = {"ignored": ["skip"], "page_refs": ["miniCard"]}
    assert {r.user_id: r.is_glide for r in profiles.glide_flags(log, **args).collect()} == {"a": 1, "b": 0, "c": 0}
    tiers = profiles.duration_tiers(log, action="end", duration_ms=F.col("seconds") * 1000, **args).collect()
    assert {r.user_id: (r.is_light, r.is_middle, r.is_heavy) for r in tiers} == {"a": (1, 0, 0), "b": (0, 0, 1), "c": (0, 1, 0)}
    active = profiles.active_flags(log, home="home", **args).collect()
    assert {r.user_id: (r.is_active, r.is_passive) for r in active} == {"a": (1, None), "b": (None, 1), "c": (None, 1)}


def test_features_fill_zero_vectors(spark):
    audiences = spark.createDataFrame([("u", "v6"), ("u", "v3")], "user_id string, audience string")
    features = spark.createDataFrame([("w", [1.0, 2.0])], "user_id string, emb array<double>")
    got = {r.user_id: (r.audience, r.emb) for r in profiles.user_features(audiences, features, ["emb"], 2).collect()}
    assert got == {"u": ("v3", [0.0, 0.0]), "w": (None, [1.0, 2.0])}


def test_audiences(spark):
    users = spark.createDataFrame([("a", 0, 3, 0, 9), ("b", 2, 3, 2, 2), ("c", 0, 0, 0, 0)],
                                  "user_id string, clicks_week long, clicks_month long, click_days_week long, click_days_month long")
    hour = 3_600_000
    searches = spark.createDataFrame([("a", 9 * hour, "20240110"), ("b", 10 * hour, "20240110"), ("b", 10 * hour + 5, "20240110")],
                                     "user_id string, time_ms long, date string")
    month = ("20240101", "20240130")
    assert [tuple(r) for r in audience.month_not_week(searches, users, month).collect()] == [("a", 9)]
    hours = audience.everyone_n_hours(users, "s").groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct("hour").alias("d")).collect()
    assert {r.user_id: (r.n, r.d) for r in hours} == {"a": (6, 6), "b": (2, 2)}
    rows = audience.search_or_random_hour(searches.where("user_id = 'a'"), users, month, "s", min_week=0).collect()
    assert {r.user_id for r in rows} == {"a", "b", "c"} and all(8 <= r.hour <= 22 for r in rows)


def test_split_parts_are_disjoint_before_the_allow_list(spark):
    users = spark.range(200).select(F.col("id").cast("string").alias("user_id"))
    allow = spark.createDataFrame([("vip",), ("5",)], "user_id string")
    plain = audience.split_audience(users, allow.limit(0), 4, "s")
    assert plain.count() == 200 and plain.select("user_id").distinct().count() == 200
    parts = audience.split_audience(users, allow, 4, "s")
    assert parts.where("user_id = 'vip'").count() == 4 and parts.where("user_id = '5'").count() == 4
    assert parts.count() == 200 + 4 + 3


def test_running_counts(spark):
    rows = spark.createDataFrame([("a", 8), ("a", 9), ("b", 9), ("c", 7)], "user_id string, hour int")
    assert [tuple(r) for r in audience.running_counts(rows, 8, 22).orderBy("hour").collect()] == [(8, 1, 1), (9, 3, 2)]


def test_dedup_and_union(spark):
    rows = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new")], "k string, t int, v string")
    assert [tuple(r) for r in sets.dedup(rows, ["k"], ["t"], descending=True).collect()] == [("k", 2, "new")]
    assert sets.union_by_name(None, rows, None).count() == 2 and sets.union_by_name(None) is None


def test_scatter_versions(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "id string, kind string, member string, items long")
    allow = spark.createDataFrame([("a",)], "id string")
    got = sets.scatter_sets({"x": rows(("a", "item", "b", 1), ("z", "item", "b", 1)), "y": rows(("a", "item", "b", 1), ("a", "title", "t", 3))},
                            {"v1": ["x", "y"], "v2": ["y"]}, allow)
    assert {(r.version, r.kind, r.member) for r in got.collect()} == {
        ("v1", "item", "b"), ("v1", "title", "t"), ("v2", "item", "b"), ("v2", "title", "t")}
    assert got.count() == 4

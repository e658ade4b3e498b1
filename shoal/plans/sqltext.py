"""The inputs of inputs.py as SQL, composed into one statement per query."""

from __future__ import annotations

from ..functions.numeric import WILSON_Z

_CTES: dict[str, tuple[str, str]] = {
    "regions": ("", """SELECT n_nationkey, n_name AS locale, r_name AS cluster
        FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "ratings": ("", """SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item_id, SUM(l_quantity) AS score
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey, l_partkey"""),
    "track": ("regions", """SELECT event_id, CAST(user_id AS VARCHAR) AS user_id,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
        CASE event_type WHEN 'view' THEN 'item_exposure' WHEN 'click' THEN 'item_click' WHEN 'purchase' THEN 'download_install'
             WHEN 'error' THEN 'uninstall' ELSE CASE WHEN event_id % 2 = 0 THEN 'install' ELSE 'activate' END END AS action,
        strftime(ts, '%Y%m%d') AS date, epoch_us(ts) // 1000 AS time_ms, CAST(hour(ts) AS INTEGER) AS hour, value,
        CASE event_id % 3 WHEN 0 THEN 'recommend' WHEN 1 THEN 'app_detail' ELSE 'search' END AS page,
        CASE WHEN event_id % 2 = 0 THEN 'recommend' ELSE 'search' END AS pre_page,
        CASE WHEN event_id % 7 < 5 THEN 'recApps' ELSE 'banner' END AS card_type,
        CASE WHEN event_id % 4 < 3 THEN 'recApps' ELSE 'banner' END AS pre_card_type,
        CASE WHEN event_id % 5 < 3 THEN 'download_request' ELSE 'install_success' END AS install_status,
        CASE event_id % 4 WHEN 0 THEN 'system_install' WHEN 3 THEN 'auto_install' ELSE 'manual_install' END AS install_type,
        CASE event_id % 6 WHEN 0 THEN 'home' WHEN 1 THEN 'push' WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN 'update'
             ELSE 'DELIVERY_feed' END AS launch_ref,
        CASE WHEN event_id % 5 = 0 THEN 'miniCard' ELSE 'other' END AS page_ref,
        CASE WHEN event_id % 2 = 0 THEN 'minicard' ELSE 'main' END AS first_page,
        CASE event_id % 4 WHEN 0 THEN 'home' WHEN 1 THEN 'ads' WHEN 2 THEN 'cleaner' ELSE 'browser' END AS launch_pkg,
        'kw' || (CAST(floor(value) AS BIGINT) % 40) AS keyword,
        CASE WHEN event_id % 13 <> 0 THEN (CASE WHEN event_id % 9 = 0 THEN 'p;' ELSE '' END)
             || strftime(CASE WHEN event_id % 11 = 0 THEN ts - INTERVAL 1 DAY ELSE ts END, '%Y%m%d') || '_a_b_c_d_x@y@z@'
             || (event_id % 4) || (CASE WHEN event_id % 3 = 0 THEN '，' ELSE ',' END) || (event_id % 5) || '#t' END AS packed,
        CASE WHEN event_id % 11 = 0 THEN strftime(ts - INTERVAL 1 DAY, '%Y%m%d') ELSE strftime(ts, '%Y%m%d') END AS exp_day,
        CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 6 AS INTEGER) AS card_pos, locale, cluster
        FROM events JOIN regions ON user_id % 25 = n_nationkey"""),
    "catalog": ("regions", """SELECT p_partkey AS item_id, p_name || ' ' || brand AS displayname,
        CASE WHEN p_size <= 10 THEN 'S' WHEN p_size <= 20 THEN 'A' WHEN p_size <= 30 THEN 'B' WHEN p_size <= 40 THEN 'C' ELSE 'D' END AS level,
        CAST(brand + CASE WHEN p_partkey % 3 = 0 THEN 100 ELSE 0 END AS INTEGER) AS category_id, CAST(brand AS BIGINT) AS developer_id,
        p_type AS publisher, p_size / 10 AS gp_score, brand / 5 AS display_score,
        '["' || p_size || '","' || brand || '"]' AS tagids,
        'AppStore/' || p_partkey || CASE WHEN p_partkey % 10 = 0 AND day = '20240130' THEN '-new' ELSE '' END AS icon,
        locale, cluster, day AS date, p_size AS audit_tag
        FROM (SELECT *, CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) AS brand FROM part)
        JOIN regions ON p_partkey % 25 = n_nationkey CROSS JOIN (VALUES ('20240129'), ('20240130')) d(day)
        WHERE NOT (day = '20240129' AND p_partkey % 11 = 0)"""),
    "latest": ("catalog", "SELECT * FROM catalog WHERE date = (SELECT max(date) FROM catalog WHERE date <= '20240131')"),
    "denied": ("latest", "SELECT item_id FROM latest WHERE audit_tag IN (7, 13)"),
    "vectors": ("", "SELECT CAST(vec_id AS VARCHAR) AS id, label, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings"),
    "texts": ("", """SELECT CAST(doc_id AS VARCHAR) AS id,
        list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda w: w <> '') AS words FROM documents"""),
    "edges": ("ratings", "SELECT 'u' || user_id AS src, 'i' || item_id AS dst, score AS weight FROM ratings"),
    "push_log": ("", """SELECT CAST(user_id AS VARCHAR) AS user_id, strftime(ts, '%Y%m%d') AS log_date,
        json_extract_string(props, '$.k') AS item_id, CASE WHEN event_type = 'click' THEN 'CLICK' ELSE 'EXPOSE' END AS type,
        CAST(event_id AS VARCHAR) AS push_id, epoch_us(ts) // 1000 AS reach_ms, strftime(ts, '%Y%m%d') AS push_date,
        strftime(ts, '%H') AS push_hour, lpad(CAST((minute(ts) // 15) * 15 AS VARCHAR), 2, '0') AS push_minute,
        CASE event_id % 3 WHEN 0 THEN 'SH' WHEN 1 THEN 'BSOF' ELSE 'BSPT' END AS task_id FROM events"""),
    "recall_hits": ("track", """SELECT DISTINCT user_id, 'g' || (event_id % 3) AS mark, CAST(event_id % 3 AS INTEGER) AS slot,
        'q' || (item_id % 3) AS channel, CAST(item_id AS VARCHAR) AS item_id, (time_ms // 3600000) * 3600000 AS time_ms, date
        FROM track WHERE action = 'item_exposure'"""),
    "push_users": ("track", """SELECT user_id, count(*) FILTER (date >= '20240124') AS clicks_week, count(*) AS clicks_month,
        count(DISTINCT date) FILTER (date >= '20240124') AS click_days_week, count(DISTINCT date) AS click_days_month
        FROM track WHERE action = 'item_click' AND date < '20240131' AND date >= '20240101' GROUP BY user_id"""),
    "push_customers": ("", """SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_nationkey % 5 AS clicks_week, c_nationkey AS clicks_month,
        c_nationkey % 5 AS click_days_week, c_nationkey AS click_days_month FROM customer"""),
    "searches": ("track", "SELECT user_id, time_ms, date FROM track WHERE action = 'item_exposure'"),
    "search_hours": ("searches", """SELECT DISTINCT user_id, CAST((time_ms // 3600000) % 24 AS INTEGER) AS hour, date FROM searches"""),
    "allow_users": ("", "SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer WHERE c_acctbal > 9500"),
    "excluded_users": ("", "SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer WHERE c_acctbal < 500"),
}


def define(name: str, deps: str, sql: str) -> None:
    """Add a shared input used by several queries."""
    _CTES[name] = (deps, sql)


def compose(names: list[str], body: str) -> str:
    """One statement: the named inputs and what they need, in order, before ``body``.

    A body that starts with ``WITH`` goes on with its own list.
    """
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in _CTES[name][0].split():
            visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    body = body.strip()
    if not ordered:
        return body
    shared = ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in ordered)
    if body[:5].upper() == "WITH ":
        return f"WITH {shared},\n{body[5:]}"
    return f"WITH {shared}\n{body}"


def u01(seed, *keys: str) -> str:
    """The seeded uniform draw of functions/draws.py."""
    return f"(CAST('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(keys)})), 1, 8) AS BIGINT) / 4294967296.0)"


def draw(seed, *keys: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(keys)})), 1, 8) AS BIGINT)"


def wilson_sql(k: str, n: str) -> str:
    z, zz = WILSON_Z, WILSON_Z ** 2
    k, n = f"CAST({k} AS DOUBLE)", f"CAST({n} AS DOUBLE)"
    return (f"CASE WHEN {n} = 0 THEN 0.0 ELSE ({k}/{n} + {zz}/(2*{n}) - {z}*sqrt(({k}/{n})*(1-{k}/{n})/{n} + {zz}/(4*{n}*{n})))"
            f" / (1 + {zz}/{n}) END")

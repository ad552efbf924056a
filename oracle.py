"""DuckDB SQL giving the same rows as each registered query, over the same ``events`` table.

Written in the literal form of each metric (outer joins, per-row random draws, numerical
integration for tail probabilities) rather than in the form of the Spark plan, so that the two
check each other. Doubles are rounded to 6 decimals, days and times are text.
"""

from __future__ import annotations

import datetime as dt
import math

AS_OF = "date '2024-01-31'"
YESTERDAY = "date '2024-01-30'"
IN_WINDOW = "cast(time AS date) BETWEEN date '2024-01-08' AND date '2024-01-14'"
LAST_WEEK = f"date_diff('day', cast(time AS date), {AS_OF}) BETWEEN 1 AND 7"
N_BOOT, N_EXP, SAMPLE, SMALL_SAMPLE, WHOLE_GROUP, SEED, BINS = 10_000, 10_000, 10, 5, 29, 42, 20

SOURCES = """
b AS (
  SELECT event_id, ts AS time, user_id, event_type,
         cast(json_extract_string(props, '$.k') AS bigint) AS k,
         cast(user_id % 5 AS integer) AS exp_group, cast(user_id % 2 AS integer) AS gender,
         cast(18 + user_id % 3 AS integer) AS age,
         CASE WHEN user_id % 4 < 2 THEN 'iOS' ELSE 'Android' END AS os
  FROM events),
feed AS (
  SELECT user_id, event_id // 3 AS post_id, CASE WHEN event_type = 'click' THEN 'like' ELSE 'view' END AS action,
         time, exp_group, gender, age, os
  FROM b WHERE event_type IN ('click', 'view')),
msg AS (
  SELECT user_id, (user_id // 10) * 10 + k % 10 AS reciever_id, time, gender, age, os
  FROM b WHERE event_type = 'purchase'),
sparse_feed AS (
  SELECT user_id * 100 + k AS user_id, event_id // 3 AS post_id, time
  FROM b WHERE event_type IN ('click', 'view')),
sparse_msg AS (
  SELECT user_id * 100 + k AS user_id, ((user_id // 10) * 10 + k % 10) * 100 + k AS reciever_id, time
  FROM b WHERE event_type = 'purchase')"""


def _sql(select: str, *ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join([SOURCES, *ctes]) + "\n" + select


def _text(day: str) -> str:
    return f"strftime({day}, '%Y-%m-%d')"


# --- feed -------------------------------------------------------------------------------------

FEED_DAILY = f"""
daily AS (
  SELECT cast(time AS date) AS day, count(DISTINCT user_id) AS "DAU",
         cast(sum(CASE WHEN action = 'like' THEN 1 ELSE 0 END) AS bigint) AS "Likes",
         cast(sum(CASE WHEN action = 'view' THEN 1 ELSE 0 END) AS bigint) AS "Views",
         round_even(sum(CASE WHEN action = 'like' THEN 1 ELSE 0 END)
                    / nullif(sum(CASE WHEN action = 'view' THEN 1 ELSE 0 END), 0), 3) AS "CTR"
  FROM feed WHERE {LAST_WEEK} GROUP BY 1)"""

# --- app --------------------------------------------------------------------------------------

USAGE = f"""
presence AS (
  SELECT coalesce(l.user_id, r.user_id) AS user_id, coalesce(l.day, r.day) AS day,
         CASE WHEN l.user_id IS NOT NULL AND r.user_id IS NULL THEN 'feed'
              WHEN l.user_id IS NULL AND r.user_id IS NOT NULL THEN 'messenger'
              WHEN l.user_id IS NOT NULL AND r.user_id IS NOT NULL THEN 'feed+messenger'
              ELSE 'error' END AS using_service,
         coalesce(l.user_id, 0) AS left_user_id
  FROM (SELECT DISTINCT user_id, cast(time AS date) AS day FROM feed) l
  FULL OUTER JOIN (SELECT DISTINCT user_id, cast(time AS date) AS day FROM msg) r
    ON l.user_id = r.user_id AND l.day = r.day
  WHERE date_diff('day', coalesce(l.day, r.day), {AS_OF}) BETWEEN 1 AND 7),
usage AS (
  SELECT {_text('day')} AS day, using_service, count(DISTINCT user_id) AS cnt_users
  FROM presence GROUP BY 1, 2),
share AS (
  SELECT u.day, using_service, cnt_users, cast(total AS bigint) AS total,
         round_even(cnt_users / total, 3) AS per
  FROM usage u JOIN (SELECT day, sum(cnt_users) AS total FROM usage GROUP BY day) t ON u.day = t.day)"""

MESSAGES_DAILY = f"""
messages AS (
  SELECT cast(time AS date) AS day, count(user_id) AS mess_sent
  FROM msg WHERE {LAST_WEEK} GROUP BY 1)"""

NEW_POSTS = f"""
posts AS (
  SELECT count(*) AS new_posts
  FROM (SELECT post_id, date_trunc('day', min(time)) AS public_time FROM feed GROUP BY post_id)
  WHERE cast(public_time AS date) = {YESTERDAY})"""

LIFESPAN = """
activity AS (
  SELECT user_id, time FROM sparse_feed UNION SELECT user_id, time FROM sparse_msg
  UNION SELECT reciever_id, time FROM sparse_msg),
lifespan AS (
  SELECT user_id, cast(min(time) AS date) AS first_time, cast(max(time) AS date) AS last_time
  FROM activity GROUP BY user_id)"""


def _gone(ref_day: str) -> str:
    return f"date_diff('day', last_time, {ref_day}) > 7"


GONE = f"""
gone AS (
  SELECT (SELECT count(*) FROM lifespan WHERE {_gone(YESTERDAY)}) AS gone_yesterday,
         (SELECT count(*) FROM lifespan WHERE {_gone(YESTERDAY + ' - 1')}) AS gone_day_before)"""

# --- cube -------------------------------------------------------------------------------------

KEYS = "day, user_id, gender, age, os"
MSG_DAY = f"FROM (SELECT cast(time AS date) AS day, * FROM msg) WHERE day = {YESTERDAY}"
MEASURES = ["views", "likes", "messages_received", "messages_sent", "users_received", "users_sent"]


def _feed_cube(strict: bool) -> str:
    likes = "count(action = 'like')" if strict else "count_if(action = 'like')"
    views = "count(action = 'views')" if strict else "count_if(action = 'view')"
    return f"""
feed_cube AS (
  SELECT cast(time AS date) AS day, user_id, gender, age, os,
         cast({likes} AS bigint) AS likes, cast({views} AS bigint) AS views
  FROM feed WHERE cast(time AS date) = {YESTERDAY} GROUP BY ALL)"""


MESSAGE_SIDES = f"""
m_sent AS (SELECT {KEYS}, count(*) AS messages_sent {MSG_DAY} GROUP BY ALL),
m_received AS (
  SELECT day, reciever_id AS user_id, gender, age, os, count(*) AS messages_received {MSG_DAY} GROUP BY ALL),
u_sent AS (
  SELECT {KEYS}, count(*) AS users_sent
  FROM (SELECT DISTINCT {KEYS}, reciever_id {MSG_DAY}) GROUP BY ALL),
u_received AS (
  SELECT day, reciever_id AS user_id, gender, age, os, count(*) AS users_received
  FROM (SELECT DISTINCT {KEYS}, reciever_id {MSG_DAY}) GROUP BY ALL)"""


def _message_cube(strict: bool) -> str:
    join = "LEFT JOIN" if strict else "FULL OUTER JOIN"
    keep = "WHERE messages_sent IS NOT NULL AND user_id <> 0" if strict else ""
    return f"""{MESSAGE_SIDES},
message_cube AS (
  SELECT {KEYS}, coalesce(messages_sent, 0) AS messages_sent, coalesce(messages_received, 0) AS messages_received,
         coalesce(users_sent, 0) AS users_sent, coalesce(users_received, 0) AS users_received
  FROM m_sent {join} m_received USING (day, user_id, gender, age, os)
  {join} (SELECT * FROM u_sent FULL OUTER JOIN u_received USING (day, user_id, gender, age, os))
    USING (day, user_id, gender, age, os)
  {keep})"""


def _activity_cube(strict: bool) -> str:
    zero = ", ".join(f"coalesce({m}, 0) AS {m}" for m in MEASURES)
    return f"""{_feed_cube(strict)},{_message_cube(strict)},
cube AS (SELECT {KEYS}, {zero} FROM feed_cube FULL OUTER JOIN message_cube USING (day, user_id, gender, age, os))"""


def _rollup(dimension: str) -> str:
    sums = ", ".join(f"cast(sum({m}) AS bigint) AS {m}" for m in MEASURES)
    return (
        f"SELECT {_text('day')} AS event_date, '{dimension}' AS dimension, "
        f"cast({dimension} AS varchar) AS dimension_value, {sums} FROM cube GROUP BY day, {dimension}"
    )


ALL_ROLLUPS = "\nUNION ALL ".join(_rollup(d) for d in ("os", "gender", "age"))

# --- experiment -------------------------------------------------------------------------------


def _users(groups: str) -> str:
    return f"""
users AS (
  SELECT *, likes / nullif(views, 0) AS ctr
  FROM (SELECT user_id, exp_group, cast(count_if(action = 'like') AS bigint) AS likes,
               cast(count_if(action = 'view') AS bigint) AS views
        FROM feed WHERE {IN_WINDOW} AND exp_group IN ({groups}) GROUP BY 1, 2))"""


USERS = _users("1, 2")
SMOOTHED = f"""{USERS},
grp AS (
  SELECT exp_group, count_if(action = 'like') / nullif(count_if(action = 'view'), 0) AS global_ctr
  FROM feed WHERE {IN_WINDOW} AND exp_group IN (1, 2) GROUP BY 1),
smoothed AS (
  SELECT user_id, u.exp_group, ctr, global_ctr, likes, views, (likes + 5 * global_ctr) / (views + 5) AS smoothed_ctr
  FROM users u JOIN grp g ON u.exp_group = g.exp_group)"""


def _hash(key: str, digits: int = 8) -> str:
    return f"cast('0x' || substr(md5({key}), 1, {digits}) AS bigint)"


def _uniform(key: str, digits: int = 8) -> str:
    return f"({_hash(key, digits)} / {float(16 ** digits)!r})"


BUCKETS = f"""{USERS},
buckets AS (
  SELECT exp_group, cast({_hash('cast(user_id AS varchar)')} % 50 AS integer) AS bucket,
         sum(likes) / nullif(sum(views), 0) AS bucket_ctr
  FROM users GROUP BY 1, 2)"""


def _integral(density: str, upper: str) -> str:
    """Simpson's rule with 2000 steps from 0 to ``upper``; ``density`` is a function of x."""
    weight = "CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    body = density.replace("{x}", f"({upper} * i / 2000.0)")
    return f"(SELECT sum({weight} * {body}) * {upper} / 6000.0 FROM range(0, 2001) AS r(i))"


def _t_p_value(t: str, df: str) -> str:
    density = (
        f"exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt(pi() * {df}) "
        f"* pow(1 + {{x}} * {{x}} / {df}, -({df} + 1) / 2)"
    )
    return f"(1 - 2 * {_integral(density, f'abs({t})')})"


def _normal_p_value(z: str) -> str:
    density = "exp(-{x} * {x} / 2) / sqrt(2 * pi())"
    return f"CASE WHEN {z} <= 0 THEN 1.0 ELSE 1 - 2 * {_integral(density, f'abs({z})')} END"


def _moments(table: str, metric: str, groups: tuple[int, int], by: str = "") -> str:
    cols = ", ".join(
        f"count({metric}) FILTER (exp_group = {g}) AS n{i}, avg({metric}) FILTER (exp_group = {g}) AS mean{i}, "
        f"var_samp({metric}) FILTER (exp_group = {g}) AS var{i}"
        for i, g in enumerate(groups, start=1)
    )
    head, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"SELECT {head}{cols} FROM {table}{tail}"


def _t_test(name: str, table: str, metric: str, groups: tuple[int, int], welch: bool = True, by: str = "") -> str:
    if welch:
        error = "sqrt(var1 / n1 + var2 / n2)"
        df = ("pow(var1 / n1 + var2 / n2, 2) / nullif(pow(var1 / n1, 2) / (n1 - 1) + pow(var2 / n2, 2) / (n2 - 1), 0)")
    else:
        df = "cast(n1 + n2 - 2 AS double)"
        error = "sqrt(((n1 - 1) * var1 + (n2 - 1) * var2) / (n1 + n2 - 2) * (1.0::double / n1 + 1.0::double / n2))"
    t = (f"CASE WHEN {error} > 0 THEN (mean1 - mean2) / {error} WHEN {error} = 0 AND mean1 <> mean2 "
         "THEN sign(mean1 - mean2) * 'Infinity'::double END")
    return f"""
{name}_t AS (SELECT *, {t} AS t, {df} AS df FROM ({_moments(table, metric, groups, by)})),
{name} AS (SELECT *, CASE WHEN t IS NULL THEN NULL WHEN isinf(t) THEN 0 ELSE {_t_p_value('t', 'df')} END AS p_value FROM {name}_t)"""


T_TEST_COLUMNS = (
    "n1, round(mean1, 6) AS mean1, round(var1, 6) AS var1, n2, round(mean2, 6) AS mean2, round(var2, 6) AS var2, "
    "round(t, 6) AS t, round(df, 6) AS df, round(p_value, 6) AS p_value"
)


def _mann_whitney(name: str, table: str, metric: str) -> str:
    """U by counting pairs, the definition; ties from the value counts."""
    return f"""
{name}_x AS (SELECT exp_group, {metric} AS x FROM {table} WHERE {metric} IS NOT NULL),
{name}_u AS (
  SELECT (SELECT count(*) FROM {name}_x WHERE exp_group = 1) AS n1,
         (SELECT count(*) FROM {name}_x WHERE exp_group = 2) AS n2,
         (SELECT sum(CASE WHEN a.x > b.x THEN 1.0::double WHEN a.x = b.x THEN 0.5::double ELSE 0.0::double END)
          FROM {name}_x a, {name}_x b WHERE a.exp_group = 1 AND b.exp_group = 2) AS u1,
         (SELECT sum(cast(c AS double) * c * c - c) FROM (SELECT count(*) AS c FROM {name}_x GROUP BY x)) AS ties),
{name}_z AS (
  SELECT n1, n2, u1, n1 * n2 - u1 AS u2, ties,
         (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5::double)
         / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS z
  FROM {name}_u),
{name} AS (SELECT *, {_normal_p_value('z')} AS p_value FROM {name}_z)"""


MANN_WHITNEY_COLUMNS = (
    "n1, n2, round(u1, 6) AS u1, round(u2, 6) AS u2, round(ties, 6) AS ties, round(z, 6) AS z, "
    "round(p_value, 6) AS p_value"
)


def _poisson_case(u: str) -> str:
    """Poisson(1) by its distribution function, as far as 52 bits reach."""
    total, whens = [], []
    while not total or math.ceil(math.fsum(total) * 16**13) < 16**13:
        total.append(math.exp(-1.0) / math.factorial(len(total)))
        whens.append(f"WHEN {u} < {math.fsum(total)!r}::double THEN {len(total) - 1}")
    return "CASE " + " ".join(whens[:-1]) + f" ELSE {len(total) - 1} END"


_DRAW_KEY = f"concat_ws(':', user_id, exp_group, replicate, {SEED})"
REPLICATES = f"(SELECT cast(i AS integer) AS replicate FROM range(0, {N_BOOT}) AS r(i))"

_BOOT = """
boot AS (
  SELECT replicate,
         sum(w * likes) FILTER (exp_group = 1) / nullif(sum(w * views) FILTER (exp_group = 1), 0) AS ctr1,
         sum(w * likes) FILTER (exp_group = 2) / nullif(sum(w * views) FILTER (exp_group = 2), 0) AS ctr2
  FROM weights GROUP BY 1),
boot_diff AS (
  SELECT avg(ctr2 - ctr1) AS mean_diff, quantile_cont(ctr2 - ctr1, 0.025) AS ci_low,
         quantile_cont(ctr2 - ctr1, 0.975) AS ci_high,
         avg(CASE WHEN ctr2 - ctr1 > 0 THEN 1 ELSE 0 END) FILTER (ctr2 - ctr1 IS NOT NULL) AS share_positive
  FROM boot)"""

BOOTSTRAP = f"""{USERS},
weights AS (
  SELECT replicate, exp_group, likes, views, {_poisson_case('u')} AS w
  FROM (SELECT *, {_uniform(_DRAW_KEY, 13)} AS u FROM users, {REPLICATES})),{_BOOT}"""


def _scrambled(z: str, shift: int, factor: int) -> str:
    """One round of the splitmix64 mixer, modulo 2 ** 64."""
    return f"cast((cast(xor({z}, {z} >> {shift}) AS uhugeint) * {factor}) % 18446744073709551616 AS ubigint)"


# The weight of n equal users is one Poisson(n) quantile, from the mass function summed up.
BOOTSTRAP_CELLS = f"""{USERS},
cells AS (
  SELECT exp_group, likes, views, count(*) AS n,
         {_hash(f"concat_ws(':', exp_group, likes, views, {SEED})", 15)} AS seed
  FROM users GROUP BY 1, 2, 3),
cdf AS (
  SELECT n, list(c ORDER BY k) AS steps
  FROM (SELECT n, k, sum(exp(-n + k * ln(n) - lgamma(k + 1))) OVER (PARTITION BY n ORDER BY k) AS c
        FROM (SELECT DISTINCT n FROM cells), range(0, 400) AS r(k)) GROUP BY n),
z0 AS (
  SELECT c.*, replicate,
         cast((cast(seed AS uhugeint) + cast(replicate AS uhugeint) * 11400714819323198485) % 18446744073709551616 AS ubigint) AS z
  FROM cells c, {REPLICATES}),
z1 AS (SELECT * REPLACE ({_scrambled('z', 30, 13787848793156543929)} AS z) FROM z0),
z2 AS (SELECT * REPLACE ({_scrambled('z', 27, 10723151780598845931)} AS z) FROM z1),
draws AS (SELECT *, (xor(z, z >> 31) >> 12) / 4503599627370496.0::double AS u FROM z2),
weights AS (
  SELECT replicate, exp_group, likes, views, len(list_filter(steps, lambda c: c <= u)) AS w
  FROM draws JOIN cdf USING (n)),{_BOOT}"""


def _histogram(table: str, column: str, by: str = "", bounds: tuple[float, float] | None = None) -> tuple[str, str]:
    lo, hi = (f"{bounds[0]}::double", f"{bounds[1]}::double") if bounds else (f"min({column})", f"max({column})")
    head = f"{by}, " if by else ""
    cte = f"""
edges AS (SELECT {lo} AS lo, ({hi} - {lo}) / {BINS}.0::double AS width {'' if bounds else f'FROM {table}'}),
binned AS (
  SELECT {head}least(coalesce(floor(({column} - lo) / nullif(width, 0)), 0), {BINS - 1}) AS bin, lo, width
  FROM {table}, edges WHERE {column} IS NOT NULL)"""
    select = (
        f"SELECT {head}round(lo + bin * width, 6) AS bin_lo, round(lo + (bin + 1) * width, 6) AS bin_hi, "
        f"count(*) AS n FROM binned GROUP BY {head}bin, lo, width"
    )
    return cte, select


# --- A/A --------------------------------------------------------------------------------------


def _aa(size: int) -> str:
    """The first ``size`` of a pack of numbered users, after swapping place i with a drawn place from i on."""
    draw_key = f"concat_ws(':', 'draw', exp_group, replicate, i, {SEED})"
    return f"""{_users('2, 3')},
pool AS (
  SELECT user_id, exp_group, ctr AS metric,
         row_number() OVER (PARTITION BY exp_group ORDER BY {_hash('cast(user_id AS varchar)', 13)}, user_id) - 1 AS number
  FROM users WHERE ctr IS NOT NULL),
deal AS (
  SELECT replicate, exp_group, size, 0 AS i, range(0, size) AS pack
  FROM (SELECT exp_group, count(*) AS size FROM pool GROUP BY 1),
       (SELECT cast(i AS integer) AS replicate FROM range(0, {N_EXP}) AS r(i))
  UNION ALL
  SELECT replicate, exp_group, size, i + 1,
         list_transform(range(0, size), lambda k: pack[CASE k WHEN i THEN p WHEN p THEN i ELSE k END + 1])
  FROM (SELECT *, i + cast(floor({_uniform(draw_key, 13)} * (size - i)) AS bigint) AS p FROM deal WHERE i < {size})),
samples AS (
  SELECT replicate, d.exp_group, user_id, metric
  FROM (SELECT replicate, exp_group, unnest(pack[1:{size}]) AS number FROM deal WHERE i = {size}) d
  JOIN pool p ON d.exp_group = p.exp_group AND d.number = p.number)"""


AA = _aa(SAMPLE)
AA_TESTS = AA + "," + _t_test("aa", "samples", "metric", (2, 3), welch=False, by="replicate")
SAMPLE_ROWS = "SELECT replicate, exp_group, user_id, round(metric, 6) AS metric FROM samples"


def _histogram_query(base: str, *args, **kw) -> str:
    cte, select = _histogram(*args, **kw)
    return _sql(select, base, cte)


WELCH = USERS + "," + _t_test("welch", "users", "ctr", (1, 2))
MANN_WHITNEY = USERS + "," + _mann_whitney("mw", "users", "ctr")
SMOOTHED_WELCH = SMOOTHED + "," + _t_test("welch_s", "smoothed", "smoothed_ctr", (1, 2))
BUCKET_WELCH = BUCKETS + "," + _t_test("welch_b", "buckets", "bucket_ctr", (1, 2))
BUCKET_MW = BUCKETS + "," + _mann_whitney("mw_b", "buckets", "bucket_ctr")

_AFTER_USERS = len(USERS) + 1  # every block below starts with the same per-user table
REPORT = ",".join([
    WELCH,
    MANN_WHITNEY[_AFTER_USERS:],
    SMOOTHED_WELCH[_AFTER_USERS:],
    BUCKET_WELCH[_AFTER_USERS:],
    BUCKET_MW[len(BUCKETS) + 1:],
    BOOTSTRAP_CELLS[_AFTER_USERS:],
])


def _report_row(method: str, table: str, statistic: str) -> str:
    return (
        f"SELECT '{method}' AS method, round({statistic}, 6) AS statistic, round(p_value, 6) AS p_value, "
        f"p_value < 0.05 AS reject FROM {table}"
    )


REPORT_ROWS = "\nUNION ALL ".join([
    _report_row("welch_ctr", "welch", "t"),
    _report_row("mann_whitney_ctr", "mw", "u1"),
    _report_row("welch_smoothed_ctr", "welch_s", "t"),
    _report_row("welch_bucket_ctr", "welch_b", "t"),
    _report_row("mann_whitney_bucket_ctr", "mw_b", "u1"),
    "SELECT 'poisson_bootstrap', round(mean_diff, 6), NULL, NOT (ci_low <= 0 AND ci_high >= 0) FROM boot_diff",
])

BOOT_ROWS = "SELECT replicate, round(ctr1, 6) AS ctr1, round(ctr2, 6) AS ctr2 FROM boot"
BOOT_DIFF_ROW = (
    "SELECT round(mean_diff, 6) AS mean_diff, round(ci_low, 6) AS ci_low, round(ci_high, 6) AS ci_high, "
    "round(share_positive, 6) AS share_positive, ci_low <= 0 AND ci_high >= 0 AS touches_zero FROM boot_diff"
)

CONSTANT = f"{USERS}, constant AS (SELECT *, exp_group / 2.0::double AS share FROM users)"

# Values outside the bounds are in bins open on that side.
HISTOGRAM_NARROW = f"""
SELECT exp_group, round(CASE bin WHEN -1 THEN NULL WHEN {BINS} THEN 1.0 ELSE 0.5 + bin * 0.5 / {BINS} END, 6) AS bin_lo,
       round(CASE bin WHEN -1 THEN 0.5 WHEN {BINS} THEN NULL ELSE 0.5 + (bin + 1) * 0.5 / {BINS} END, 6) AS bin_hi, count(*) AS n
FROM (SELECT exp_group, CASE WHEN ctr < 0.5 THEN -1 WHEN ctr > 1 THEN {BINS}
                             ELSE least(floor((ctr - 0.5::double) / (0.5::double / {BINS})), {BINS - 1}) END AS bin
      FROM users WHERE ctr IS NOT NULL)
GROUP BY exp_group, bin"""

# Received messages by the receiver's own attributes, as everybody's own events show them.
PEOPLE = "people AS (SELECT DISTINCT user_id, gender, age, os FROM (SELECT user_id, gender, age, os FROM feed UNION ALL SELECT user_id, gender, age, os FROM msg))"
RECEIVED_OWN = f"""{PEOPLE},
day_msg AS (SELECT user_id, reciever_id, gender, age, os {MSG_DAY}),
sides AS (
  SELECT user_id, gender, age, os, count(*) AS messages_sent, 0 AS messages_received,
         count(DISTINCT reciever_id) AS users_sent, 0 AS users_received
  FROM day_msg GROUP BY ALL
  UNION ALL
  SELECT r.user_id, p.gender, p.age, p.os, 0, messages, 0, senders
  FROM (SELECT reciever_id AS user_id, count(*) AS messages, count(DISTINCT user_id) AS senders FROM day_msg GROUP BY 1) r
  LEFT JOIN people p ON p.user_id = r.user_id),
own_messages AS (
  SELECT {YESTERDAY} AS day, user_id, gender, age, os,
         {", ".join(f"cast(sum({m}) AS bigint) AS {m}" for m in ("messages_sent", "messages_received", "users_sent", "users_received"))}
  FROM sides GROUP BY ALL)"""
OWN_CUBE = f"""{_feed_cube(False)},{RECEIVED_OWN},
cube AS (
  SELECT day, gender, age, os, likes, views, 0 AS messages_sent, 0 AS messages_received, 0 AS users_sent, 0 AS users_received
  FROM feed_cube
  UNION ALL
  SELECT day, gender, age, os, 0, 0, messages_sent, messages_received, users_sent, users_received FROM own_messages)"""


def _day_before(sql: str) -> str:
    """The same query one day earlier."""
    return sql.replace(YESTERDAY, "date '2024-01-29'").replace(AS_OF, YESTERDAY)


def _as_of(sql: str, day: str) -> str:
    """The same query with another day for today."""
    before = f"date '{dt.date.fromisoformat(day) - dt.timedelta(days=1)}'"
    return sql.replace(YESTERDAY, "{before}").replace(AS_OF, f"date '{day}'").replace("{before}", before)


LOADED_LATE = "\nUNION ALL ".join(
    f"SELECT *, {day in (27, 30)} AS again FROM ("
    + _as_of(_sql(ALL_ROLLUPS, _activity_cube(False)), f"2024-01-{day + 1}") + ")" for day in range(25, 31))

# Every feed action shows attributes of its user; a message counts for those its receiver showed last.
IN_TIME = f"""
shown AS (
  SELECT user_id, time, max({{'gender': gender, 'age': age, 'os': os}}) AS a
  FROM (SELECT user_id, time, cast(post_id % 3 AS integer) AS gender, cast(20 + post_id % 2 AS integer) AS age,
               CASE WHEN post_id % 2 = 0 THEN 'iOS' ELSE 'Android' END AS os FROM feed)
  GROUP BY 1, 2),
got AS (
  SELECT cast(m.time AS date) AS day, m.reciever_id AS user_id, m.user_id AS sender, s.a.gender AS gender, s.a.age AS age, s.a.os AS os
  FROM msg m ASOF LEFT JOIN shown s ON m.reciever_id = s.user_id AND m.time >= s.time
  WHERE cast(m.time AS date) = {YESTERDAY}),
in_time AS (
  SELECT day, user_id, gender, age, os, cast(sum(sent) AS bigint) AS messages_sent, cast(sum(received) AS bigint) AS messages_received,
         cast(sum(to_users) AS bigint) AS users_sent, cast(sum(from_users) AS bigint) AS users_received
  FROM (
    SELECT cast(time AS date) AS day, user_id, gender, age, os, count(*) AS sent, 0 AS received,
           count(DISTINCT reciever_id) AS to_users, 0 AS from_users
    FROM msg WHERE cast(time AS date) = {YESTERDAY} GROUP BY 1, 2, 3, 4, 5
    UNION ALL
    SELECT day, user_id, gender, age, os, 0, count(*), 0, count(DISTINCT sender) FROM got GROUP BY 1, 2, 3, 4, 5)
  GROUP BY 1, 2, 3, 4, 5),
cube AS (
  SELECT day, gender, age, os, likes, views, 0 AS messages_sent, 0 AS messages_received, 0 AS users_sent, 0 AS users_received
  FROM feed_cube
  UNION ALL
  SELECT day, gender, age, os, 0, 0, messages_sent, messages_received, users_sent, users_received FROM in_time)"""


def _window(days: int) -> str:
    return f"date_diff('day', cast(time AS date), {AS_OF}) BETWEEN 1 AND {days}"


FEED_WINDOWS = " UNION ALL ".join(
    f"SELECT {days} AS days, count(DISTINCT user_id) AS users, count_if(action = 'like') AS likes, count_if(action = 'view') AS views, "
    f"round_even(count_if(action = 'like') / nullif(count_if(action = 'view'), 0), 3) AS ctr FROM feed WHERE {_window(days)}"
    for days in (1, 7, 21))
USAGE_WINDOWS = " UNION ALL ".join(
    f"SELECT {days} AS days, count_if(f) AS feed, count_if(m) AS messenger, count(*) AS either, count_if(f AND m) AS both FROM ("
    f"SELECT user_id, bool_or(f) AS f, bool_or(m) AS m FROM (SELECT user_id, true AS f, false AS m FROM feed WHERE {_window(days)} "
    f"UNION ALL SELECT user_id, false, true FROM msg WHERE {_window(days)}) GROUP BY 1)" for days in (1, 7, 21))
ACTIVE_DAYS = (
    "SELECT n_days, count(*) AS users FROM (SELECT user_id, count(DISTINCT cast(time AS date)) AS n_days FROM ("
    f"SELECT user_id, time FROM feed UNION ALL SELECT user_id, time FROM msg) WHERE {_window(28)} GROUP BY 1) GROUP BY 1")


def _dyadic(base: str, table: str, column: str, by: str, bins: int) -> str:
    """Bins of a power of two, the least that covers all values in ``bins`` steps."""
    return _sql(
        f"SELECT {by}, round(floor({column} / w) * w, 6) AS bin_lo, round((floor({column} / w) + 1) * w, 6) AS bin_hi, count(*) AS n "
        f"FROM {table}, wide WHERE {column} IS NOT NULL GROUP BY 1, floor({column} / w), w",
        *([base] if base else []), f"""
wide AS (
  SELECT min(pow(2.0::double, e)) AS w FROM (SELECT min({column}) AS lo, max({column}) AS hi FROM {table}), range(-45, 60) AS r(e)
  WHERE floor(hi / pow(2.0::double, e)) - floor(lo / pow(2.0::double, e)) < {bins})""")


def _aa_cells(size: int) -> str:
    """Users per distinct value in a sample: hypergeometric draws down a binary tree over the values in order.

    Distribution functions are tabled for each half a node can have and each number of users drawn.
    """
    return f"""{_users('2, 3')},
vals AS (
  SELECT exp_group, ctr, n, row_number() OVER (PARTITION BY exp_group ORDER BY ctr) - 1 AS number,
         cast(ceil(log2(count(*) OVER (PARTITION BY exp_group))) AS integer) AS bits
  FROM (SELECT exp_group, ctr, count(*) AS n FROM users WHERE ctr IS NOT NULL GROUP BY 1, 2)),
nodes AS (
  SELECT exp_group, level, number >> (bits - level) AS node, any_value(bits) AS bits, cast(sum(n) AS bigint) AS size
  FROM vals, range(0, 12) AS r(level) WHERE level <= bits GROUP BY 1, 2, 3),
halves AS (
  SELECT p.exp_group, p.level, p.node, p.size, coalesce(l.size, 0) AS l,
         {_hash(f"concat_ws(':', p.exp_group, p.level, p.node, {SEED})", 15)} AS seed
  FROM nodes p LEFT JOIN nodes l ON l.exp_group = p.exp_group AND l.level = p.level + 1 AND l.node = 2 * p.node
  WHERE p.level < p.bits),
cdf AS (
  SELECT exp_group, level, node, k, seed, greatest(0, k - (any_value(size) - any_value(l))) AS low, list(c ORDER BY x) AS steps
  FROM (
    SELECT *, sum(exp(lgamma(l + 1) - lgamma(x + 1) - lgamma(l - x + 1) + lgamma(size - l + 1) - lgamma(k - x + 1)
                      - lgamma(size - l - k + x + 1) - lgamma(size + 1) + lgamma(k + 1) + lgamma(size - k + 1)))
              OVER (PARTITION BY exp_group, level, node, k ORDER BY x) AS c
    FROM halves, range(1, {size} + 1) AS r(k), range(0, {size} + 1) AS s(x)
    WHERE k <= size AND x <= l AND x <= k AND x >= k - (size - l))
  GROUP BY 1, 2, 3, 4, 5),
drawn AS (
  SELECT DISTINCT cast(i AS integer) AS replicate, exp_group, 0 AS level, 0::bigint AS node, {size}::bigint AS k
  FROM vals, range(0, {N_EXP}) AS r(i)
  UNION ALL
  SELECT replicate, exp_group, level + 1, 2 * node + side, CASE side WHEN 0 THEN x ELSE k - x END
  FROM (
    SELECT replicate, exp_group, level, node, k,
           low + len(list_filter(steps[1 : len(steps) - 1], lambda c: c <= (xor(z, z >> 31) >> 12) / 4503599627370496.0::double)) AS x
    FROM (
      SELECT * REPLACE ({_scrambled('z', 27, 10723151780598845931)} AS z) FROM (
        SELECT * REPLACE ({_scrambled('z', 30, 13787848793156543929)} AS z) FROM (
          SELECT d.*, low, steps,
                 cast((cast(seed AS uhugeint) + cast(replicate AS uhugeint) * 11400714819323198485) % 18446744073709551616 AS ubigint) AS z
          FROM drawn d JOIN cdf USING (exp_group, level, node, k))))), range(0, 2) AS s(side)
  WHERE CASE side WHEN 0 THEN x ELSE k - x END > 0),
samples AS (
  SELECT replicate, exp_group, metric
  FROM (SELECT replicate, d.exp_group, ctr AS metric, unnest(range(0, k))
        FROM drawn d JOIN vals v ON d.exp_group = v.exp_group AND d.level = v.bits AND d.node = v.number))"""


AA_CELL_TESTS = _aa_cells(SAMPLE) + "," + _t_test("aa", "samples", "metric", (2, 3), welch=False, by="replicate")


def _moment_rows(size: int) -> str:
    rounded = ", ".join(f"n{i}, round(mean{i}, 6) AS mean{i}, round(var{i}, 6) AS var{i}" for i in (1, 2))
    return _sql(f"SELECT replicate, {rounded} FROM ({_moments('samples', 'metric', (2, 3), 'replicate')})", _aa_cells(size))


SQL: dict[str, str] = {
    "read_events": (
        "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, "
        "round(value, 6) AS value, props FROM events"
    ),
    "feed_actions": _sql(
        "SELECT user_id, post_id, action, strftime(time, '%Y-%m-%d %H:%M:%S.%f') AS time, "
        "exp_group, gender, age, os FROM feed"
    ),
    "message_actions": _sql(
        "SELECT user_id, reciever_id, strftime(time, '%Y-%m-%d %H:%M:%S.%f') AS time, gender, age, os FROM msg"
    ),
    "feed_metrics_yesterday": _sql(
        f'SELECT "DAU", "Likes", "Views", "CTR" FROM daily WHERE day = {YESTERDAY}', FEED_DAILY
    ),
    "feed_metrics_daily": _sql(
        f'SELECT {_text("day")} AS day, "DAU", "Likes", "Views", "CTR" FROM daily ORDER BY 1', FEED_DAILY
    ),
    "period_bounds": _sql(
        f"SELECT (SELECT {_text('min(cast(time AS date))')} FROM feed WHERE {LAST_WEEK}) AS start_period, "
        f"(SELECT {_text('max(cast(time AS date))')} FROM feed WHERE {LAST_WEEK}) AS end_period"
    ),
    "feed_report_metrics": _sql(
        "\nUNION ALL ".join(
            f"SELECT '2024-01-31' AS report_date, '{m}' AS metric, cast(\"{m}\" AS double) AS value "
            f"FROM daily WHERE day = {YESTERDAY}"
            for m in ("DAU", "Likes", "Views", "CTR")
        ),
        FEED_DAILY,
    ),
    "daily_presence": _sql(f"SELECT user_id, {_text('cast(time AS date)')} AS day FROM feed GROUP BY 1, 2"),
    "daily_presence_messenger": _sql(
        f"SELECT user_id, {_text('cast(time AS date)')} AS day FROM msg GROUP BY 1, 2"
    ),
    "service_usage_daily": _sql("SELECT * FROM usage ORDER BY day, using_service", USAGE),
    "service_usage_daily_strict": _sql(
        f"SELECT {_text('day')} AS day, using_service, count(DISTINCT left_user_id) AS cnt_users "
        "FROM presence GROUP BY 1, 2 ORDER BY 1, 2",
        USAGE,
    ),
    "service_usage_share": _sql("SELECT * FROM share", USAGE),
    "service_usage_pivot": _sql(
        "SELECT day, "
        + ", ".join(
            f"max(per) FILTER (using_service = '{s}') AS \"{s}\"" for s in ("feed", "feed+messenger", "messenger")
        )
        + " FROM share GROUP BY day ORDER BY day",
        USAGE,
    ),
    "messages_sent_daily": _sql(f"SELECT {_text('day')} AS day, mess_sent FROM messages ORDER BY 1", MESSAGES_DAILY),
    "messages_sent_latest": _sql("SELECT mess_sent FROM messages ORDER BY day DESC LIMIT 1", MESSAGES_DAILY),
    "new_posts": _sql("SELECT '2024-01-30' AS day, new_posts FROM posts", NEW_POSTS),
    "all_activity": _sql(
        "SELECT user_id, strftime(time, '%Y-%m-%d %H:%M:%S.%f') AS time FROM ("
        "SELECT user_id, time FROM feed UNION ALL SELECT user_id, time FROM msg "
        "UNION SELECT reciever_id, time FROM msg)"
    ),
    "user_lifespan": _sql(
        f"SELECT user_id, {_text('first_time')} AS first_time, {_text('last_time')} AS last_time FROM lifespan",
        LIFESPAN,
    ),
    "new_users": _sql(
        f"SELECT user_id, {_text('first_time')} AS first_time FROM lifespan WHERE first_time = {YESTERDAY}", LIFESPAN
    ),
    "new_users_count": _sql(
        f"SELECT count(DISTINCT user_id) AS new_users FROM lifespan WHERE first_time = {YESTERDAY}", LIFESPAN
    ),
    "gone_users": _sql(
        f"SELECT user_id, {_text('last_time')} AS last_time FROM lifespan WHERE {_gone(YESTERDAY)}", LIFESPAN
    ),
    "gone_users_day_before": _sql(
        f"SELECT user_id, {_text('last_time')} AS last_time FROM lifespan "
        f"WHERE {_gone(YESTERDAY + ' - 1')} ORDER BY last_time",
        LIFESPAN,
    ),
    "gone_users_delta": _sql(
        "SELECT gone_yesterday, gone_day_before, gone_yesterday - gone_day_before AS delta FROM gone", LIFESPAN, GONE
    ),
    "app_report_metrics": _sql(
        f"""SELECT '2024-01-31' AS report_date, 'new_users' AS metric, count(*) AS value
FROM lifespan WHERE first_time = {YESTERDAY}
UNION ALL SELECT '2024-01-31', 'gone_users_delta', gone_yesterday - gone_day_before FROM gone
UNION ALL SELECT '2024-01-31', 'new_posts', new_posts FROM posts
UNION ALL SELECT '2024-01-31', 'messages_sent', (SELECT mess_sent FROM messages ORDER BY day DESC LIMIT 1)""",
        LIFESPAN, GONE, NEW_POSTS, MESSAGES_DAILY,
    ),
    "gone_users_delta_recent": _sql("SELECT gone_yesterday - gone_day_before AS delta FROM gone", LIFESPAN, GONE),
    "feed_cube": _sql(f"SELECT * REPLACE ({_text('day')} AS day) FROM feed_cube", _feed_cube(False)),
    "feed_cube_strict": _sql(f"SELECT * REPLACE ({_text('day')} AS day) FROM feed_cube", _feed_cube(True)),
    "messages_sent": _sql(f"SELECT * REPLACE ({_text('day')} AS day) FROM m_sent", MESSAGE_SIDES),
    "messages_received": _sql(f"SELECT * REPLACE ({_text('day')} AS day) FROM m_received", MESSAGE_SIDES),
    "users_sent": _sql(f"SELECT * REPLACE ({_text('day')} AS day) FROM u_sent", MESSAGE_SIDES),
    "users_received": _sql(f"SELECT * REPLACE ({_text('day')} AS day) FROM u_received", MESSAGE_SIDES),
    "message_cube": _sql(f"SELECT * REPLACE ({_text('day')} AS day) FROM message_cube", _message_cube(False)),
    "message_cube_strict": _sql(f"SELECT * REPLACE ({_text('day')} AS day) FROM message_cube", _message_cube(True)),
    "message_cube_demographics": _sql(f"SELECT * REPLACE ({_text('day')} AS day) FROM own_messages", RECEIVED_OWN),
    "activity_cube": _sql(f"SELECT * REPLACE ({_text('day')} AS day) FROM cube", _activity_cube(False)),
    "rollup_dimension_os": _sql(_rollup("os"), _activity_cube(False)),
    "rollup_dimension_gender": _sql(_rollup("gender"), _activity_cube(False)),
    "rollup_dimension_age": _sql(_rollup("age"), _activity_cube(False)),
    "dimension_rollup": _sql(ALL_ROLLUPS, _activity_cube(False)),
    "dimension_rollup_strict": _sql(ALL_ROLLUPS, _activity_cube(True)),
    "run_daily": _sql(ALL_ROLLUPS, _activity_cube(False)),
    "run_daily_strict": _sql(ALL_ROLLUPS, _activity_cube(True)),
    "run_daily_demographics": _sql(ALL_ROLLUPS, OWN_CUBE),
    "load_daily": "SELECT * FROM (" + _sql(ALL_ROLLUPS, _activity_cube(False)) + ")\nUNION ALL SELECT * FROM ("
    + _day_before(_sql(ALL_ROLLUPS, _activity_cube(False))) + ")",
    "load_changed": LOADED_LATE,
    "message_cube_in_time": _sql(f"SELECT * REPLACE ({_text('day')} AS day) FROM in_time", _feed_cube(False), IN_TIME),
    "run_daily_in_time": _sql(ALL_ROLLUPS, _feed_cube(False), IN_TIME),
    "feed_metrics_of_days": _sql(f"SELECT * REPLACE ({_text('day')} AS day) FROM daily", FEED_DAILY),
    "feed_metrics_of_windows": _sql(FEED_WINDOWS),
    "service_usage_of_windows": _sql(USAGE_WINDOWS),
    "service_usage_of": "\nUNION ALL ".join(
        f"SELECT *, '{day}' AS as_of FROM (" + _as_of(_sql("SELECT * FROM usage", USAGE), day) + ")"
        for day in ("2024-01-31", "2024-01-20", "2024-01-08")),
    "active_days": _sql(ACTIVE_DAYS),
    "user_ctr": _sql("SELECT user_id, exp_group, round(ctr, 6) AS ctr, likes, views FROM users", USERS),
    "group_ctr": _sql("SELECT exp_group, round(global_ctr, 6) AS global_ctr FROM grp", SMOOTHED),
    "smoothed_ctr": _sql(
        "SELECT user_id, exp_group, round(ctr, 6) AS ctr, round(global_ctr, 6) AS global_ctr, likes, views, "
        "round(smoothed_ctr, 6) AS smoothed_ctr FROM smoothed",
        SMOOTHED,
    ),
    "group_summary": _sql(
        "SELECT exp_group, round(avg(global_ctr), 6) AS global_ctr, round(avg(ctr), 6) AS mean_ctr_by_user "
        "FROM smoothed GROUP BY 1",
        SMOOTHED,
    ),
    "histogram_ctr": _histogram_query(USERS, "users", "ctr", "exp_group"),
    "histogram_ctr_narrow": _sql(HISTOGRAM_NARROW, USERS),
    "histogram_smoothed_ctr": _histogram_query(SMOOTHED, "smoothed", "smoothed_ctr", "exp_group"),
    "histogram_bucket_ctr": _histogram_query(BUCKETS, "buckets", "bucket_ctr", "exp_group"),
    "histogram_bootstrap_ctr": _histogram_query(
        BOOTSTRAP + ", both_ctr AS (SELECT 'ctr1' AS sample, ctr1 AS ctr FROM boot "
        "UNION ALL SELECT 'ctr2', ctr2 FROM boot)",
        "both_ctr", "ctr", "sample",
    ),
    "histogram_bootstrap_diff": _histogram_query(
        BOOTSTRAP + ", diffs AS (SELECT ctr2 - ctr1 AS diff FROM boot)", "diffs", "diff"
    ),
    "histogram_one_scan": _dyadic(USERS, "users", "ctr", "exp_group", BINS),
    "histogram_one_scan_values": _dyadic("", "events", "value", "event_type", 50),
    "welch_ttest": _sql(f"SELECT {T_TEST_COLUMNS} FROM welch", WELCH),
    "welch_ttest_constant": _sql(
        f"SELECT {T_TEST_COLUMNS} FROM welch_c", CONSTANT, _t_test("welch_c", "constant", "share", (1, 2))),
    "pooled_ttest_constant": _sql(
        f"SELECT {T_TEST_COLUMNS} FROM pooled_c", CONSTANT, _t_test("pooled_c", "constant", "share", (1, 2), welch=False)),
    "mann_whitney": _sql(f"SELECT {MANN_WHITNEY_COLUMNS} FROM mw", MANN_WHITNEY),
    "poisson_bootstrap": _sql(BOOT_ROWS, BOOTSTRAP),
    "bootstrap_diff": _sql(BOOT_DIFF_ROW, BOOTSTRAP),
    "poisson_bootstrap_cells": _sql(BOOT_ROWS, BOOTSTRAP_CELLS),
    "bootstrap_diff_cells": _sql(BOOT_DIFF_ROW, BOOTSTRAP_CELLS),
    "bucket_ctr": _sql("SELECT exp_group, bucket, round(bucket_ctr, 6) AS bucket_ctr FROM buckets", BUCKETS),
    "bucket_welch": _sql(f"SELECT {T_TEST_COLUMNS} FROM welch_b", BUCKET_WELCH),
    "bucket_mann_whitney": _sql(f"SELECT {MANN_WHITNEY_COLUMNS} FROM mw_b", BUCKET_MW),
    "smoothed_welch": _sql(f"SELECT {T_TEST_COLUMNS} FROM welch_s", SMOOTHED_WELCH),
    "experiment_report": _sql(REPORT_ROWS, REPORT),
    "aa_samples": _sql(SAMPLE_ROWS, AA),
    "aa_samples_large_group": _sql(SAMPLE_ROWS, _aa(SMALL_SAMPLE)),
    "aa_samples_whole_group": _sql(SAMPLE_ROWS, _aa(WHOLE_GROUP)),
    "aa_pvalues": _sql(
        "SELECT replicate, round(t, 6) AS t, round(df, 6) AS df, round(p_value, 6) AS p_value FROM aa", AA_TESTS
    ),
    "aa_fpr": _sql(
        "SELECT count(*) AS n_exp, round(count_if(p_value < 0.05) / count(*), 6) AS fpr, "
        "count_if(p_value < 0.05) / count(*) <= 0.05 AS split_ok FROM aa",
        AA_TESTS,
    ),
    "aa_moments": _moment_rows(SAMPLE),
    "aa_moments_whole_group": _moment_rows(WHOLE_GROUP),
    "aa_pvalues_of": _sql(
        "SELECT replicate, round(t, 6) AS t, round(df, 6) AS df, round(p_value, 6) AS p_value FROM aa", AA_CELL_TESTS),
    "aa_fpr_of": _sql(
        "SELECT count(*) AS n_exp, round(count_if(p_value < 0.05) / count(*), 6) AS fpr, "
        "count_if(p_value < 0.05) / count(*) <= 0.05 AS split_ok FROM aa",
        AA_CELL_TESTS,
    ),
    "aa_pvalue_histogram": _histogram_query(AA_TESTS, "aa", "p_value", bounds=(0.0, 1.0)),
}

SQL["user_lifespan_merged"] = SQL["user_lifespan"]
SQL["app_report_metrics_incremental"] = SQL["app_report_metrics"]
SQL["user_lifespan_kept"] = SQL["user_lifespan"]
SQL["new_posts_kept"] = SQL["new_posts"]

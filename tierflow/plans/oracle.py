"""Reference SQL (DuckDB dialect) for every registered query.

Each statement is an independent formulation over the same parquet tables —
written the way the modelled warehouse SQL would state it (cross join for
candidate scoring, plain windows per user, correlated logic as CTEs) — and is
used only to check the Spark plans. Columns are aliased to the Spark names.
"""

from __future__ import annotations

AS_OF = "DATE '2025-06-30'"
RUN_TS = "TIMESTAMP '2025-07-01 00:00:00'"


def D(x) -> str:
    """A double literal (DuckDB reads 2.5 as DECIMAL)."""
    return f"CAST({x} AS DOUBLE)"


RAW_FOODS = """
raw_foods AS (
  SELECT p_name AS label,
         CAST(p_size * 10 AS VARCHAR) || ' g' AS weight,
         CAST(p_size * 20 AS VARCHAR) AS calories,
         CAST(p_partkey % 40 AS VARCHAR) AS protein,
         CAST(p_partkey % 60 AS VARCHAR) AS carbohydrates,
         CAST(p_partkey % 30 AS VARCHAR) AS fats,
         CAST(p_partkey % 12 AS VARCHAR) AS fiber,
         CAST(p_partkey % 25 AS VARCHAR) AS sugars,
         CAST(p_retailprice AS VARCHAR) AS sodium
  FROM part)"""

DIRTY_FOODS = """
dirty_base AS (
  SELECT '  ' || upper(p_name) || ' ' AS label,
         ' ' || CAST(p_size * 10 AS VARCHAR) || ' G ' AS weight,
         ' ' || CASE WHEN p_size * 20 >= 1000
                     THEN CAST(CAST(floor(p_size * 20 / 1000) AS BIGINT) AS VARCHAR) || ','
                          || lpad(CAST((p_size * 20) % 1000 AS VARCHAR), 3, '0')
                     ELSE CAST(p_size * 20 AS VARCHAR) END AS calories,
         CASE WHEN p_partkey % 97 = 0 THEN 'n/a' ELSE CAST(p_partkey % 40 AS VARCHAR) END AS protein,
         CAST(p_partkey % 60 AS VARCHAR) AS carbohydrates,
         CAST(p_partkey % 30 AS VARCHAR) AS fats,
         CASE WHEN p_partkey % 97 = 0 THEN '' ELSE CAST(p_partkey % 12 AS VARCHAR) END AS fiber,
         CAST(p_partkey % 25 AS VARCHAR) AS sugars,
         CAST(p_retailprice AS VARCHAR) AS sodium,
         p_partkey AS k
  FROM part),
raw_foods AS (
  SELECT label, weight, calories, protein, carbohydrates, fats, fiber, sugars, sodium FROM dirty_base
  UNION ALL
  SELECT label, weight, calories, protein, carbohydrates, fats, fiber, sugars, sodium FROM dirty_base
  WHERE k % 5 = 0)"""


def _num(c: str) -> str:
    return f"TRY_CAST(replace(trim({c}), ',', '') AS DOUBLE) AS {c}"


BRONZE = f"""
bronze AS (
  SELECT DISTINCT trim(lower(label)) AS label, trim(lower(weight)) AS weight,
         {_num('calories')}, {_num('protein')}, {_num('carbohydrates')}, {_num('fats')},
         {_num('fiber')}, {_num('sugars')}, {_num('sodium')}
  FROM raw_foods)"""


def _band(c: str, lo: int, hi: int, name: str) -> str:
    return (f"CASE WHEN {c} < {lo} THEN 'low' WHEN {c} >= {lo} AND {c} < {hi} THEN 'medium' "
            f"ELSE 'high' END AS {name}")


SILVER = f"""
silver AS (
  SELECT trim(lower(label)) AS food_name,
         trim(lower(weight)) AS serving_description,
         calories AS calories_kcal, protein AS protein_g, carbohydrates AS carbohydrates_g,
         fats AS fat_g, fiber AS fiber_g, sugars AS sugar_g, sodium AS sodium_mg,
         TRY_CAST(NULLIF(regexp_extract(trim(lower(weight)), '([0-9]+(\\.[0-9]+)?)', 1), '') AS DOUBLE)
           AS serving_size_value,
         {_band('calories', 150, 300, 'calorie_band')},
         {_band('protein', 5, 15, 'protein_band')},
         {_band('carbohydrates', 10, 25, 'carb_band')},
         {_band('fats', 5, 15, 'fat_band')},
         CAST(CASE WHEN protein >= 10 AND calories <= 250 THEN 1 ELSE 0 END AS INTEGER)
           AS is_high_protein_low_calorie,
         CAST(CASE WHEN fiber >= 5 THEN 1 ELSE 0 END AS INTEGER) AS is_high_fiber,
         CAST(CASE WHEN sugars <= 8 THEN 1 ELSE 0 END AS INTEGER) AS is_low_sugar
  FROM (SELECT DISTINCT * FROM bronze))"""

USERS = f"""
users AS (
  SELECT printf('U%03d', c_custkey) AS user_id,
         c_name AS user_name,
         CASE c_custkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'other'
              ELSE 'prefer_not_to_say' END AS gender,
         DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER) AS birth_date,
         {D(150)} + c_custkey % 50 AS height_cm,
         {D(120)} + c_custkey % 120 AS current_weight_lb,
         {D(120)} + (c_custkey * 7) % 120 AS target_weight_lb
  FROM customer),
enriched AS (
  SELECT *,
         CAST(floor(datediff('day', birth_date, {AS_OF}) / {D(365.25)}) AS INTEGER) AS age,
         CASE WHEN target_weight_lb < current_weight_lb THEN 'weight_loss'
              WHEN target_weight_lb > current_weight_lb THEN 'weight_gain'
              ELSE 'maintenance' END AS goal_type
  FROM users)"""

REASON_SQL = """CASE WHEN {g} = 'weight_loss' THEN 'Higher protein/fiber with relatively lower calories and sugar'
     WHEN {g} = 'weight_gain' THEN 'Higher calories and protein for weight gain support'
     ELSE 'Balanced nutrition profile for maintenance' END"""


def score_sql(g: str, f: str = "") -> str:
    p = f"{f}." if f else ""
    return (f"round(CASE WHEN {g} = 'weight_loss' THEN {p}protein_g * {D(2.5)} + {p}fiber_g * {D(2.0)}"
            f" - {p}calories_kcal * {D(0.015)} - {p}sugar_g * {D(0.8)} - {p}fat_g * {D(0.2)}"
            f" WHEN {g} = 'weight_gain' THEN {p}calories_kcal * {D(0.02)} + {p}protein_g * {D(2.0)}"
            f" + {p}carbohydrates_g * {D(0.8)} + {p}fat_g * {D(0.5)}"
            f" ELSE {p}protein_g * {D(2.0)} + {p}fiber_g * {D(1.5)} - {p}sugar_g * {D(0.7)}"
            f" - abs({p}calories_kcal - {D(400)}) * {D(0.01)} END, 2)")


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


FOODS_CHAIN = (RAW_FOODS, BRONZE, SILVER)

GOALS_CTE = """
goals AS (SELECT * FROM (VALUES ('weight_loss'), ('weight_gain'), ('maintenance')) t(goal_type))"""

CAND_BY_GOAL = f"""
cand AS (
  SELECT g.goal_type, s.*, {score_sql('g.goal_type', 's')} AS recommendation_score,
         {REASON_SQL.format(g='g.goal_type')} AS recommendation_reason
  FROM goals g CROSS JOIN silver s)"""

BEST_BY_GOAL = """
best AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY goal_type, food_name
             ORDER BY recommendation_score DESC NULLS LAST, serving_description, serving_size_value) AS rn
    FROM cand) WHERE rn = 1)"""

TOP_USERS = f"""
cand_u AS (
  SELECT u.user_id, u.goal_type, f.food_name, f.serving_description, f.serving_size_value,
         {score_sql('u.goal_type', 'f')} AS recommendation_score,
         {REASON_SQL.format(g='u.goal_type')} AS recommendation_reason
  FROM enriched u CROSS JOIN silver f),
best_u AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, food_name
             ORDER BY recommendation_score DESC NULLS LAST, serving_description, serving_size_value) AS rn1
    FROM cand_u) WHERE rn1 = 1),
top_u AS (
  SELECT * FROM (
    SELECT user_id, goal_type, food_name, serving_description, recommendation_score, recommendation_reason,
           CAST(row_number() OVER (PARTITION BY user_id
                ORDER BY recommendation_score DESC NULLS LAST, food_name) AS INTEGER) AS recommendation_rank
    FROM best_u) WHERE recommendation_rank <= 10)"""

# ------------------------------------------------------------------ profile events
EVENTS = f"""
ev_m AS (
  SELECT *, CASE event_type WHEN 'signup' THEN 'create' WHEN 'click' THEN 'update'
                 WHEN 'purchase' THEN 'update' WHEN 'error' THEN 'delete' ELSE event_type END AS m
  FROM events),
ev AS (
  SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, m AS event_type, printf('U%03d', user_id) AS user_id,
    CASE WHEN m = 'delete' OR (m = 'update' AND event_id % 2 = 0) THEN NULL
         WHEN event_id % 41 = 0 THEN '' ELSE 'user_' || CAST(user_id AS VARCHAR) END AS user_name,
    CASE WHEN m = 'delete' OR (m = 'update' AND event_id % 3 = 0) THEN NULL
         WHEN event_id % 17 = 0 THEN 'unknown'
         ELSE CASE user_id % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'other'
                   ELSE 'prefer_not_to_say' END END AS gender,
    CASE WHEN m = 'delete' OR (m = 'update' AND event_id % 4 = 0) THEN NULL
         WHEN event_id % 29 = 0 THEN '1899-12-31'
         ELSE CAST(DATE '1940-01-01' + CAST((user_id * 97) % 25000 AS INTEGER) AS VARCHAR) END AS birth_date,
    CASE WHEN m = 'delete' OR (m = 'update' AND event_id % 3 = 1) THEN NULL
         WHEN event_id % 61 = 0 THEN {D(0)} ELSE {D(150)} + user_id % 50 END AS height_cm,
    CASE WHEN m = 'delete' OR (m = 'update' AND event_id % 7 = 0) THEN NULL
         WHEN event_id % 53 = 0 THEN NULL ELSE value + {D(60)} END AS current_weight_lb,
    CASE WHEN m = 'delete' OR (m = 'update' AND event_id % 5 = 0) THEN NULL
         ELSE {D(100)} + CAST(json_extract_string(props, '$.k') AS DOUBLE) * 2 END AS target_weight_lb
  FROM ev_m)"""


def _rule(field: str, bad: str, req: str, msg: str) -> str:
    return (f"CASE WHEN (CASE WHEN {field} IS NULL THEN {req} ELSE coalesce({bad}, TRUE) END) "
            f"THEN '{msg}' END")


def errors_sql(req: str) -> str:
    from tierflow.constants import FIELD_MESSAGES as M
    b = "TRY_CAST(birth_date AS DATE)"
    rules = [
        _rule("user_name", "length(user_name) < 1 OR length(user_name) > 100", req, M["user_name"]),
        _rule("gender", "gender NOT IN ('male', 'female', 'other', 'prefer_not_to_say')", req, M["gender"]),
        _rule("birth_date", f"{b} IS NULL OR {b} >= {AS_OF} OR year({b}) < 1900", req, M["birth_date"]),
        _rule("height_cm", "height_cm <= 0 OR height_cm > 300", req, M["height_cm"]),
        _rule("current_weight_lb", "current_weight_lb <= 0 OR current_weight_lb > 800", req,
              M["current_weight_lb"]),
        _rule("target_weight_lb", "target_weight_lb <= 0 OR target_weight_lb > 800", req, M["target_weight_lb"]),
    ]
    return "concat_ws('; ', " + ", ".join(rules) + ")"


VALIDATED = f"""
routed AS (
  SELECT *, CASE WHEN user_id IS NULL OR event_type NOT IN ('create', 'update', 'delete') THEN 'rejected'
                 ELSE event_type END AS route,
            CASE WHEN user_id IS NULL THEN 'missing user_id'
                 WHEN event_type NOT IN ('create', 'update', 'delete') THEN 'unknown event_type: ' || event_type
            END AS reject_reason
  FROM ev),
validated AS (
  SELECT *, errors = '' AS is_valid FROM (
    SELECT *, CASE WHEN route = 'rejected' THEN reject_reason
                   WHEN route IN ('create', 'update') THEN {errors_sql("route = 'create'")}
                   ELSE '' END AS errors
    FROM routed))"""

_FIELDS = ["user_name", "gender", "birth_date", "height_cm", "current_weight_lb", "target_weight_lb"]


def fold_sql(strict: bool) -> str:
    opens = ("event_type = 'create'" if strict else
             "event_type = 'create' OR (event_type = 'update' AND current_weight_lb IS NOT NULL "
             "AND target_weight_lb IS NOT NULL)")
    merged = ",\n    ".join(
        f"last_value({f} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {f}" for f in _FIELDS)
    return f"""
ok AS (SELECT event_id, ts, event_type, user_id, {', '.join(_FIELDS)} FROM validated
       WHERE route IN ('create', 'update', 'delete') AND is_valid),
segd AS (
  SELECT *,
    SUM(CASE WHEN event_type = 'delete' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS del_upto,
    SUM(CASE WHEN event_type = 'delete' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS del_total
  FROM ok),
lastseg AS (SELECT *, ({opens}) AS opens FROM segd WHERE del_upto = del_total AND event_type <> 'delete'),
opened AS (
  SELECT *, SUM(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_open
  FROM lastseg),
acc AS (SELECT * FROM opened WHERE (opens AND n_open = 1) OR (event_type = 'update' AND n_open >= 1)),
merged AS (
  SELECT event_id, ts, event_type, user_id,
    {merged}
  FROM acc),
dim AS (
  SELECT event_id AS user_profile_key, user_id, user_name, gender,
    TRY_CAST(birth_date AS DATE) AS birth_date,
    CAST(year({AS_OF}) - year(TRY_CAST(birth_date AS DATE))
         - CASE WHEN month({AS_OF}) < month(TRY_CAST(birth_date AS DATE))
                  OR (month({AS_OF}) = month(TRY_CAST(birth_date AS DATE))
                      AND day({AS_OF}) < day(TRY_CAST(birth_date AS DATE))) THEN 1 ELSE 0 END AS INTEGER) AS age,
    height_cm, current_weight_lb, target_weight_lb,
    CASE WHEN target_weight_lb < current_weight_lb THEN 'weight_loss'
         WHEN target_weight_lb > current_weight_lb THEN 'weight_gain' ELSE 'maintenance' END AS goal_type,
    ts AS effective_start,
    lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS effective_end,
    lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) IS NULL AS is_current,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS INTEGER) AS version_number
  FROM merged)"""


FOLD = fold_sql(False)
FOLD_STRICT = fold_sql(True)


#: Outcome of every event that is not erased (needs ``ok``).
OUTCOMES = """
gone AS (SELECT user_id, max(event_id) AS d FROM ok WHERE event_type = 'delete' GROUP BY user_id),
left_over AS (SELECT o.*, g.d FROM ok o LEFT JOIN gone g USING (user_id) WHERE g.d IS NULL OR o.event_id > g.d),
begun AS (SELECT user_id, min(event_id) AS f FROM left_over
          WHERE event_type = 'create' OR (event_type = 'update' AND current_weight_lb IS NOT NULL AND target_weight_lb IS NOT NULL) GROUP BY user_id),
refused AS (
  SELECT l.event_id, l.user_id, l.event_type,
    CASE WHEN l.event_id > b.f THEN 'user exists' WHEN l.d IS NOT NULL THEN 'user deleted' ELSE 'user not found' END AS reason
  FROM left_over l LEFT JOIN begun b USING (user_id)
  WHERE b.f IS NULL OR l.event_id < b.f OR (l.event_id > b.f AND l.event_type = 'create'))"""
REFUSED = " SELECT event_id, user_id, event_type, reason FROM refused"

#: Loaded users as events before all others (needs ``enriched`` and ``validated``).
LOADED = f"""
loaded_and_events AS (
  SELECT event_id, ts, event_type, user_id, {', '.join(_FIELDS)}, route, is_valid FROM validated
  UNION ALL
  SELECT -1, {RUN_TS}, 'create', user_id, user_name, gender, CAST(birth_date AS VARCHAR), height_cm, current_weight_lb, target_weight_lb, 'create', TRUE
  FROM enriched)"""


# ------------------------------------------------------------------ warehouse
def top_sql(users: str, name: str) -> str:
    """Top-10 per user of ``users`` (user_id, goal_type) by cross join, as CTE ``name``."""
    return f"""
{name}_c AS (
  SELECT u.user_id, u.goal_type, f.food_name, f.serving_description, f.serving_size_value,
         {score_sql('u.goal_type', 'f')} AS recommendation_score,
         {REASON_SQL.format(g='u.goal_type')} AS recommendation_reason
  FROM {users} u CROSS JOIN silver f),
{name}_b AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, food_name
             ORDER BY recommendation_score DESC NULLS LAST, serving_description, serving_size_value) AS rn1
    FROM {name}_c) WHERE rn1 = 1),
{name} AS (
  SELECT * FROM (
    SELECT user_id, food_name, goal_type, recommendation_score, recommendation_reason,
           CAST(row_number() OVER (PARTITION BY user_id
                ORDER BY recommendation_score DESC NULLS LAST, food_name) AS INTEGER) AS recommendation_rank
    FROM {name}_b) WHERE recommendation_rank <= 10)"""


def dec(c: str, alias: str | None = None) -> str:
    return f"CAST({c} AS DECIMAL(10,2)) AS {alias or c}"


WAREHOUSE = f"""
cur_ev AS (SELECT user_id, goal_type FROM dim WHERE is_current),
{top_sql('cur_ev', 'fact_ev')},
new_users AS (SELECT * FROM enriched e WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.user_id = e.user_id)),
{top_sql('new_users', 'fact_new')},
wdim AS (
  SELECT user_id, user_name, gender, birth_date, age, {dec('height_cm')}, {dec('current_weight_lb')},
         {dec('target_weight_lb')}, goal_type, effective_start, effective_end, is_current, version_number
  FROM dim
  UNION ALL
  SELECT user_id, user_name, gender, birth_date, age, {dec('height_cm')}, {dec('current_weight_lb')},
         {dec('target_weight_lb')}, goal_type, {RUN_TS} AS effective_start, CAST(NULL AS TIMESTAMP) AS effective_end,
         TRUE AS is_current, 1 AS version_number
  FROM new_users),
wfact AS (
  SELECT user_id, food_name, goal_type, {dec('recommendation_score')}, recommendation_rank, recommendation_reason
  FROM fact_ev
  UNION ALL
  SELECT user_id, food_name, goal_type, {dec('recommendation_score')}, recommendation_rank, recommendation_reason
  FROM fact_new),
wfood AS (
  SELECT food_name, serving_description, {dec('serving_size_value')}, {dec('calories_kcal')}, {dec('protein_g')},
         {dec('carbohydrates_g')}, {dec('fat_g')}, {dec('fiber_g')}, {dec('sugar_g')}, {dec('sodium_mg')},
         calorie_band, protein_band, carb_band, fat_band, is_high_protein_low_calorie, is_high_fiber, is_low_sugar
  FROM silver)"""

WAREHOUSE_CHAIN = (*FOODS_CHAIN, USERS, EVENTS, VALIDATED, FOLD, WAREHOUSE)

# fixed values: the report's columns, by the table they come from
REPORT_COLUMNS = {
    "users": ["user_id", "user_name", "gender", "age", "goal_type", "height_cm", "current_weight_lb", "target_weight_lb"],
    "picks": ["food_name", "recommendation_score", "recommendation_rank", "recommendation_reason"],
    "foods": ["calories_kcal", "protein_g", "fiber_g", "carbohydrates_g", "fat_g", "sugar_g", "calorie_band",
              "protein_band", "is_high_protein_low_calorie", "is_high_fiber", "is_low_sugar"],
}

# every pick of a user who has a current version, once for each serving of its
# food, and once with nulls when the food is unknown (two branches, no outer join)
REPORT = f"""
picked AS (
  SELECT {', '.join(f'users.{c}' for c in REPORT_COLUMNS['users'])}, {', '.join(f'picks.{c}' for c in REPORT_COLUMNS['picks'])}
  FROM (SELECT * FROM wdim WHERE is_current) AS users, wfact AS picks
  WHERE picks.user_id = users.user_id),
report AS (
  SELECT picked.*, {', '.join(f'foods.{c}' for c in REPORT_COLUMNS['foods'])}
  FROM picked, wfood AS foods WHERE foods.food_name = picked.food_name
  UNION ALL
  SELECT picked.*, {', '.join('NULL' for _ in REPORT_COLUMNS['foods'])}
  FROM picked WHERE picked.food_name IS NULL OR picked.food_name NOT IN (SELECT food_name FROM wfood WHERE food_name IS NOT NULL))"""

# progress as a signed gain over the version numbered one less
HISTORY = """
earlier AS (SELECT user_id, version_number + 1 AS version_number, current_weight_lb AS was, target_weight_lb AS was_target FROM wdim),
sizes AS (SELECT user_id, COUNT(*) AS total_versions FROM wdim GROUP BY user_id),
moves AS (
  SELECT d.*, e.was, n.total_versions,
         CAST(ROUND(d.current_weight_lb - d.target_weight_lb, 1) AS DECIMAL(10,1)) AS weight_delta_lb,
         CASE d.goal_type WHEN 'weight_loss' THEN e.was - d.current_weight_lb
                          WHEN 'weight_gain' THEN d.current_weight_lb - e.was
                          WHEN 'maintenance' THEN ABS(e.was - e.was_target) - ABS(d.current_weight_lb - d.target_weight_lb) END AS gain
  FROM wdim d JOIN sizes n ON n.user_id = d.user_id
  LEFT JOIN earlier e ON e.user_id = d.user_id AND e.version_number = d.version_number),
hist AS (
  SELECT *, effective_start AS changed_at,
         CASE WHEN was IS NULL THEN 'initial' WHEN gain > 0 THEN 'improving'
              WHEN was = current_weight_lb THEN 'unchanged' ELSE 'not_improving' END AS progress_status
  FROM moves)"""


# ------------------------------------------------------------------ data quality
def dq_sql(stage: str, src: str, checks: list[tuple]) -> str:
    """Oracle for a DQ report: one SELECT per check, UNION ALL in check order."""
    def q(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    parts = []
    for i, (kind, col, arg, label) in enumerate(checks):
        pre = f"{label} " if label else ""
        if kind == "row_count":
            m = arg
            parts.append(f"SELECT {i} AS i, '{kind}' AS chk, '' AS col, n >= {m} AS ok, n AS observed, "
                         f"'{pre}count=' || n || ' min_required={m}' AS detail FROM (SELECT COUNT(*) AS n FROM {src})")
            continue
        if kind == "unique":
            cols = ", ".join(col)
            parts.append(f"SELECT {i}, '{kind}', '{','.join(col)}', t = d, t - d, "
                         f"{q(f'{pre}cols={list(col)} total=')} || t || ' distinct=' || d || ' duplicates=' || (t - d) "
                         f"FROM (SELECT (SELECT COUNT(*) FROM {src}) AS t, "
                         f"(SELECT COUNT(*) FROM (SELECT DISTINCT {cols} FROM {src})) AS d)")
            continue
        cond = {
            "not_null": f"{col} IS NULL",
            "positive": f"{col} IS NOT NULL AND {col} <= 0",
            "non_negative": f"{col} IS NOT NULL AND {col} < 0",
            "value_range": f"{col} IS NOT NULL AND ({col} < {arg[0] if arg else 0} OR {col} > {arg[1] if arg else 0})",
            "categorical": f"{col} IS NOT NULL AND {col} NOT IN ({', '.join(repr(v) for v in (arg or []))})",
        }[kind]
        word = {"not_null": "null_count", "positive": "non_positive_count", "non_negative": "negative_count",
                "value_range": "violations", "categorical": "invalid_count"}[kind]
        mid = {"value_range": f" range=[{arg[0]},{arg[1]}]" if arg else "",
               "categorical": f" valid={list(arg)}" if arg else ""}.get(kind, "")
        parts.append(f"SELECT {i}, '{kind}', '{col}', n = 0, n, {q(f'{pre}col={col}{mid} {word}=')} || n "
                     f"FROM (SELECT COUNT(*) FILTER (WHERE {cond}) AS n FROM {src})")
    body = "\nUNION ALL\n".join(parts)
    return (f"SELECT '{stage}' AS stage, chk AS \"check\", col AS \"column\", "
            f"CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status, CAST(observed AS BIGINT) AS observed, detail "
            f"FROM ({body}) q")

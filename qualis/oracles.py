"""DuckDB oracle SQL for the registered queries.

Each text inlines the raw tables it needs as ``q_<table>`` CTEs (the
same projection texts Spark runs) and then states the operator in plain
SQL, independently of the DataFrame code.  Dialect notes: ``||`` keeps
NULL-propagating concatenation (DuckDB's ``concat`` skips NULLs),
``try_strptime`` is the safe parser, ``dayofweek(d) + 1`` gives the
Sunday = 1 numbering.
"""

from __future__ import annotations

from qualis.sources.fixtures import duckdb_with

ORACLES: dict[str, str] = {}

ORACLES["weighted_score"] = duckdb_with("manual_rating") + """,
rated AS (SELECT review_id, IF(rating = 42, 0, weight) AS w, IF(rating = 42, 0, rating / rating_max * weight) AS p
  FROM q_manual_rating)
SELECT review_id, IF(SUM(w) = 0, 0.0::DOUBLE, round(100 * (SUM(p) / SUM(w)), 9)) AS final_score_percentage
FROM rated GROUP BY review_id"""

ORACLES["avg_score_per_ticket"] = duckdb_with("autoqa_ratings") + """
SELECT external_ticket_id, round(AVG(score), 9) AS avg_score FROM q_autoqa_ratings GROUP BY external_ticket_id"""

ORACLES["avg_score_per_reviewee"] = duckdb_with("manual_reviews") + """
SELECT reviewee_id, COUNT(*) AS total_reviews, round(AVG(score), 9) AS avg_score
FROM q_manual_reviews GROUP BY reviewee_id HAVING COUNT(*) >= 2"""


# ---------------------------------------------------------------------------
# Mart SQL templates.  ``r`` maps a raw table name to the relation to read
# (``q_<table>`` for a full build, ``q_<table>_b1`` for a first batch);
# ``d`` maps a dimension name to its relation.

def _fid(x: str) -> str:
    """Text form of a float id as the keys hash it."""
    return f"(CASE WHEN {x} = round({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END)"


def _r(r: dict | None, t: str) -> str:
    return (r or {}).get(t, f"q_{t}")


def dim_team_sql(r=None) -> str:
    return f"""SELECT md5(CAST(team_id AS VARCHAR)) AS team_key, team_id, updated_at FROM (
  SELECT team_id, MAX(updated_at) AS updated_at FROM (
    SELECT team_id, CAST(updated_at AS TIMESTAMP) AS updated_at FROM {_r(r, 'autoqa_reviews')} WHERE team_id IS NOT NULL
    UNION ALL SELECT team_id, CAST(updated_at AS TIMESTAMP) FROM {_r(r, 'manual_reviews')} WHERE team_id IS NOT NULL
    UNION ALL SELECT team_id, TIMESTAMP '1970-01-01' FROM {_r(r, 'manual_rating')} WHERE team_id IS NOT NULL) u
  GROUP BY team_id) g"""


def dim_payment_sql(r=None) -> str:
    return f"""SELECT md5(CAST(payment_id AS VARCHAR)) AS payment_key, payment_id, updated_at FROM (
  SELECT payment_id, MAX(updated_at) AS updated_at FROM (
    SELECT payment_id, CAST(updated_at AS TIMESTAMP) AS updated_at FROM {_r(r, 'autoqa_reviews')} WHERE payment_id IS NOT NULL
    UNION ALL SELECT payment_id, CAST(updated_at AS TIMESTAMP) FROM {_r(r, 'manual_reviews')} WHERE payment_id IS NOT NULL
    UNION ALL SELECT payment_id, CAST(updated_at AS TIMESTAMP) FROM {_r(r, 'conversations')} WHERE payment_id IS NOT NULL
    UNION ALL SELECT payment_id, TIMESTAMP '1970-01-01' FROM {_r(r, 'manual_rating')} WHERE payment_id IS NOT NULL
    UNION ALL SELECT payment_id, TIMESTAMP '1970-01-01' FROM {_r(r, 'autoqa_ratings')} WHERE payment_id IS NOT NULL) u
  GROUP BY payment_id) g"""


def dim_user_sql(r=None) -> str:
    return f"""SELECT md5(CAST(user_id AS VARCHAR)) AS user_key, user_id, updated_at FROM (
  SELECT user_id, MAX(updated_at) AS updated_at FROM (
    SELECT CAST(round(reviewee_id) AS BIGINT) AS user_id, CAST(updated_at AS TIMESTAMP) AS updated_at
      FROM {_r(r, 'manual_reviews')} WHERE reviewee_id IS NOT NULL
    UNION ALL SELECT CAST(reviewer_id AS BIGINT), CAST(updated_at AS TIMESTAMP)
      FROM {_r(r, 'manual_reviews')} WHERE reviewer_id IS NOT NULL
    UNION ALL SELECT assignee_id, CAST(updated_at AS TIMESTAMP)
      FROM {_r(r, 'conversations')} WHERE assignee_id IS NOT NULL
    UNION ALL SELECT CAST(round(reviewee_internal_id) AS BIGINT), CAST(updated_at AS TIMESTAMP)
      FROM {_r(r, 'autoqa_reviews')} WHERE reviewee_internal_id IS NOT NULL
    UNION ALL SELECT CAST(reviewee_internal_id AS BIGINT), TIMESTAMP '1970-01-01'
      FROM {_r(r, 'autoqa_ratings')} WHERE reviewee_internal_id IS NOT NULL) u
  WHERE user_id IS NOT NULL GROUP BY user_id) g"""


def dim_rating_category_sql(r=None, target: str | None = None) -> str:
    incr = f"WHERE category_id NOT IN (SELECT category_id FROM {target})" if target else ""
    return f"""SELECT md5(CAST(category_id AS VARCHAR)) AS rating_category_key, category_id, category_name FROM (
  SELECT category_id, MIN(category_name) AS category_name FROM (
    SELECT rating_category_id AS category_id, rating_category_name AS category_name
      FROM {_r(r, 'autoqa_ratings')} WHERE rating_category_id IS NOT NULL
    UNION ALL SELECT category_id, category_name FROM {_r(r, 'manual_rating')} WHERE category_id IS NOT NULL) u
  GROUP BY category_id) g {incr}"""


def _d(d: dict | None, name: str) -> str:
    return (d or {}).get(name, name)


def _since(target: str | None, expr: str = "updated_at") -> str:
    if not target:
        return ""
    return (f"WHERE {expr} > (SELECT COALESCE(MAX(updated_at), TIMESTAMP '1900-01-01') FROM {target})")


def fact_autoqa_reviews_sql(r=None, d=None, target=None) -> str:
    return f"""SELECT md5(f.autoqa_review_id) AS autoqa_review_key, f.autoqa_review_id, dp.payment_key,
  f.payment_token_id, dt.team_key, du.user_key AS reviewee_key, f.external_ticket_id,
  try_strptime(f.created_at, '%Y-%m-%d %H:%M:%S') AS created_ts,
  try_strptime(f.conversation_created_at, '%Y-%m-%d %H:%M:%S') AS conversation_created_ts,
  CAST(try_strptime(f.conversation_created_date, '%Y-%m-%d') AS DATE) AS conversation_created_dt,
  f.updated_at,
  CAST(strftime(try_strptime(f.created_at, '%Y-%m-%d %H:%M:%S'), '%Y%m%d') AS BIGINT) AS date_key_created,
  CAST(strftime(f.updated_at, '%Y%m%d') AS BIGINT) AS date_key_updated,
  CAST(strftime(CAST(try_strptime(f.conversation_created_date, '%Y-%m-%d') AS DATE), '%Y%m%d') AS BIGINT) AS date_key_conversation
FROM (SELECT * FROM (SELECT * REPLACE (CAST(updated_at AS TIMESTAMP) AS updated_at) FROM {_r(r, 'autoqa_reviews')}) b
      {_since(target)}) f
LEFT JOIN {_d(d, 'dim_payment')} dp ON md5(CAST(f.payment_id AS VARCHAR)) = dp.payment_key
LEFT JOIN {_d(d, 'dim_team')} dt ON md5(CAST(f.team_id AS VARCHAR)) = dt.team_key
LEFT JOIN {_d(d, 'dim_user')} du ON md5({_fid('f.reviewee_internal_id')}) = du.user_key"""


def fact_autoqa_ratings_sql(r=None, d=None, target=None) -> str:
    incr = f"WHERE autoqa_rating_id NOT IN (SELECT autoqa_rating_id FROM {target})" if target else ""
    return f"""SELECT md5(b.autoqa_rating_id) AS autoqa_rating_key, b.autoqa_rating_id,
  md5(b.autoqa_review_id) AS autoqa_review_key, dp.payment_key, dt.team_key, du.user_key AS reviewee_key,
  dr.rating_category_key, b.external_ticket_id, b.payment_token_id, b.rating_scale_score, b.score
FROM (SELECT * FROM {_r(r, 'autoqa_ratings')} {incr}) b
LEFT JOIN {_d(d, 'dim_payment')} dp ON md5(CAST(b.payment_id AS VARCHAR)) = dp.payment_key
LEFT JOIN {_d(d, 'dim_team')} dt ON md5(CAST(b.team_id AS VARCHAR)) = dt.team_key
LEFT JOIN {_d(d, 'dim_user')} du ON md5(CAST(b.reviewee_internal_id AS VARCHAR)) = du.user_key
LEFT JOIN {_d(d, 'dim_rating_category')} dr ON md5(CAST(b.rating_category_id AS VARCHAR)) = dr.rating_category_key"""


def fact_autoqa_root_cause_sql(r=None, target=None) -> str:
    nat = "(autoqa_rating_id || COALESCE(root_cause, ''))"
    incr = f"AND {nat} NOT IN (SELECT {nat} FROM {target})" if target else ""
    return f"""SELECT DISTINCT md5({nat}) AS autoqa_root_cause_key, autoqa_rating_id,
  md5(autoqa_rating_id) AS autoqa_rating_key, category, count AS root_cause_count, root_cause
FROM {_r(r, 'autoqa_root_cause')} WHERE autoqa_rating_id IS NOT NULL {incr}"""


def fact_conversations_sql(r=None, d=None, target=None) -> str:
    return f"""SELECT DISTINCT
  md5(CAST(b.payment_id AS VARCHAR) || '_' || CAST(b.external_ticket_id AS VARCHAR) || '_'
      || COALESCE(b.conversation_created_at, '') || '_' || CAST(b.message_count AS VARCHAR)) AS conversation_key,
  dp.payment_key, b.payment_token_id, b.external_ticket_id, du.user_key AS assignee_key,
  try_strptime(b.conversation_created_at, '%Y-%m-%d %H:%M:%S') AS conversation_created_ts,
  CAST(try_strptime(b.conversation_created_at_date, '%Y-%m-%d') AS DATE) AS conversation_created_dt,
  b.updated_at,
  try_strptime(b.closed_at, '%Y-%m-%d %H:%M:%S') AS closed_ts,
  b.channel, b.language, b.is_closed, b.message_count, b.private_message_count, b.public_message_count,
  b.unique_public_agent_count, b.agent_most_public_messages, b.first_response_time,
  b.first_resolution_time_seconds, b.full_resolution_time_seconds, b.last_reply_at, b.klaus_sentiment,
  b.deleted_at, b.imported_at, b.public_mean_character_count, b.public_mean_word_count,
  b.most_active_internal_user_id,
  CAST(strftime(try_strptime(b.conversation_created_at, '%Y-%m-%d %H:%M:%S'), '%Y%m%d') AS BIGINT) AS date_key_created,
  CAST(strftime(b.updated_at, '%Y%m%d') AS BIGINT) AS date_key_updated,
  CAST(strftime(try_strptime(b.closed_at, '%Y-%m-%d %H:%M:%S'), '%Y%m%d') AS BIGINT) AS date_key_closed
FROM (SELECT * FROM (SELECT * REPLACE (CAST(updated_at AS TIMESTAMP) AS updated_at) FROM {_r(r, 'conversations')}) c
      {_since(target)}) b
LEFT JOIN {_d(d, 'dim_payment')} dp ON md5(CAST(b.payment_id AS VARCHAR)) = dp.payment_key
LEFT JOIN {_d(d, 'dim_user')} du ON md5(CAST(b.assignee_id AS VARCHAR)) = du.user_key"""


def fact_manual_ratings_sql(r=None, d=None, target=None) -> str:
    nat = "(CAST(review_id AS VARCHAR) || '_' || CAST(category_id AS VARCHAR))"
    incr = f"WHERE {nat} NOT IN (SELECT {nat} FROM {target})" if target else ""
    return f"""SELECT DISTINCT md5(CAST(b.review_id AS VARCHAR) || '_' || CAST(b.category_id AS VARCHAR)) AS manual_rating_key,
  b.review_id, b.category_id, dp.payment_key, dt.team_key, dr.rating_category_key,
  b.rating, b.cause, b.rating_max, b.weight, b.critical, b.category_name
FROM (SELECT * FROM {_r(r, 'manual_rating')} {incr}) b
LEFT JOIN {_d(d, 'dim_payment')} dp ON md5(CAST(b.payment_id AS VARCHAR)) = dp.payment_key
LEFT JOIN {_d(d, 'dim_team')} dt ON md5(CAST(b.team_id AS VARCHAR)) = dt.team_key
LEFT JOIN {_d(d, 'dim_rating_category')} dr ON md5(CAST(b.category_id AS VARCHAR)) = dr.rating_category_key"""


def fact_manual_reviews_sql(r=None, d=None, target=None) -> str:
    return f"""SELECT md5(CAST(f.review_id AS VARCHAR)) AS manual_review_key, f.review_id, dp.payment_key,
  f.payment_token_id, dt.team_key, dr1.user_key AS reviewer_key, dr2.user_key AS reviewee_key,
  try_strptime(f.created, '%Y-%m-%d %H:%M:%S') AS created_ts,
  try_strptime(f.conversation_created_at, '%Y-%m-%d %H:%M:%S') AS conversation_created_ts,
  CAST(try_strptime(f.conversation_created_date, '%Y-%m-%d') AS DATE) AS conversation_created_dt,
  f.conversation_external_id, f.comment_id, f.scorecard_id, f.scorecard_tag, f.score, f.updated_at,
  f.updated_by, f.assignment_review, f.seen, f.disputed, f.review_time_seconds, f.assignment_name, f.imported_at,
  CAST(strftime(try_strptime(f.created, '%Y-%m-%d %H:%M:%S'), '%Y%m%d') AS BIGINT) AS date_key_created,
  CAST(strftime(f.updated_at, '%Y%m%d') AS BIGINT) AS date_key_updated,
  CAST(strftime(CAST(try_strptime(f.conversation_created_date, '%Y-%m-%d') AS DATE), '%Y%m%d') AS BIGINT) AS date_key_conversation
FROM (SELECT * FROM (SELECT * REPLACE (CAST(updated_at AS TIMESTAMP) AS updated_at) FROM {_r(r, 'manual_reviews')}) b
      {_since(target)}) f
LEFT JOIN {_d(d, 'dim_payment')} dp ON md5(CAST(f.payment_id AS VARCHAR)) = dp.payment_key
LEFT JOIN {_d(d, 'dim_team')} dt ON md5(CAST(f.team_id AS VARCHAR)) = dt.team_key
LEFT JOIN {_d(d, 'dim_user')} dr1 ON md5(CAST(f.reviewer_id AS VARCHAR)) = dr1.user_key
LEFT JOIN {_d(d, 'dim_user')} dr2 ON md5({_fid('f.reviewee_id')}) = dr2.user_key"""


FULL_TABLES = ("autoqa_reviews", "autoqa_ratings", "autoqa_root_cause", "conversations",
               "manual_reviews", "manual_rating")


def _dims_ctes() -> str:
    return (f",\ndim_team AS ({dim_team_sql()}),\ndim_payment AS ({dim_payment_sql()}),\n"
            f"dim_user AS ({dim_user_sql()}),\ndim_rating_category AS ({dim_rating_category_sql()})")


def _with_dims() -> str:
    return duckdb_with(*FULL_TABLES) + _dims_ctes()


ORACLES["dim_team"] = duckdb_with("autoqa_reviews", "manual_reviews", "manual_rating") + "\n" + dim_team_sql()
ORACLES["dim_payment"] = duckdb_with(*FULL_TABLES) + "\n" + dim_payment_sql()
ORACLES["dim_user"] = duckdb_with(*FULL_TABLES) + "\n" + dim_user_sql()
ORACLES["dim_rating_category"] = duckdb_with("autoqa_ratings", "manual_rating") + "\n" + dim_rating_category_sql()
ORACLES["fact_autoqa_reviews"] = _with_dims() + "\n" + fact_autoqa_reviews_sql()
ORACLES["fact_autoqa_ratings"] = _with_dims() + "\n" + fact_autoqa_ratings_sql()
ORACLES["fact_autoqa_root_cause"] = duckdb_with("autoqa_root_cause") + "\n" + fact_autoqa_root_cause_sql()
ORACLES["fact_conversations"] = _with_dims() + "\n" + fact_conversations_sql()
ORACLES["fact_manual_ratings"] = _with_dims() + "\n" + fact_manual_ratings_sql()
ORACLES["fact_manual_reviews"] = _with_dims() + "\n" + fact_manual_reviews_sql()
ORACLES["stg_autoqa_root_cause"] = duckdb_with("autoqa_root_cause") + """
SELECT autoqa_rating_id, category, count, root_cause FROM q_autoqa_root_cause WHERE autoqa_rating_id IS NOT NULL"""


def _flat_sql(columns, prefix: str) -> str:
    from qualis.plans.marts import out_name
    cols = ", ".join(f"{c} AS {out_name(c, prefix)}" for c in columns)
    return duckdb_with("customer_subscriptions") + f"\nSELECT {cols} FROM q_customer_subscriptions"


def _register_flat() -> None:
    from qualis.plans.marts import CUSTOMER_COLUMNS, SUBSCRIPTION_COLUMNS
    ORACLES["mart_customer"] = _flat_sql(CUSTOMER_COLUMNS, "customer_")
    ORACLES["mart_subscriptions"] = _flat_sql(SUBSCRIPTION_COLUMNS, "subscription_")


_register_flat()


# ---------------------------------------------------------------------------
# Incremental (two-batch) oracles: build every mart from batch 1, then
# load batch 2 (the whole tables) incrementally and merge by unique key.

def _upsert_sql(target: str, new: str, key: str) -> str:
    return (f"SELECT * FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {new} n WHERE n.{key} = t.{key})\n"
            f"UNION ALL SELECT * FROM {new}")


def _incremental_with() -> str:
    from qualis.plans.warehouse import UNIQUE_KEYS
    from qualis.sources.fixtures import BATCH1_PREDICATES
    parts = [duckdb_with(*FULL_TABLES)]
    for t, pred in BATCH1_PREDICATES.items():
        parts.append(f"q_{t}_b1 AS (SELECT * FROM q_{t} WHERE {pred})")
    r1 = {t: f"q_{t}_b1" for t in BATCH1_PREDICATES}
    # batch 1: full build
    parts += [f"dim_team_1 AS ({dim_team_sql(r1)})", f"dim_payment_1 AS ({dim_payment_sql(r1)})",
              f"dim_user_1 AS ({dim_user_sql(r1)})", f"dim_rating_category_1 AS ({dim_rating_category_sql(r1)})"]
    d1 = {n: f"{n}_1" for n in ("dim_team", "dim_payment", "dim_user", "dim_rating_category")}
    parts += [f"fact_autoqa_reviews_1 AS ({fact_autoqa_reviews_sql(r1, d1)})",
              f"fact_autoqa_ratings_1 AS ({fact_autoqa_ratings_sql(r1, d1)})",
              f"fact_autoqa_root_cause_1 AS ({fact_autoqa_root_cause_sql(r1)})",
              f"fact_conversations_1 AS ({fact_conversations_sql(r1, d1)})",
              f"fact_manual_ratings_1 AS ({fact_manual_ratings_sql(r1, d1)})",
              f"fact_manual_reviews_1 AS ({fact_manual_reviews_sql(r1, d1)})"]
    # batch 2: new rows per model, then merge
    for n, sql in (("dim_team", dim_team_sql()), ("dim_payment", dim_payment_sql()), ("dim_user", dim_user_sql())):
        parts.append(f"{n}_n AS (SELECT * FROM ({sql}) s {_since(n + '_1')})")
    parts.append(f"dim_rating_category_n AS ({dim_rating_category_sql(None, 'dim_rating_category_1')})")
    for n in d1:
        parts.append(f"{n}_2 AS ({_upsert_sql(n + '_1', n + '_n', UNIQUE_KEYS[n])})")
    d2 = {n: f"{n}_2" for n in d1}
    parts += [f"fact_autoqa_reviews_n AS ({fact_autoqa_reviews_sql(None, d2, 'fact_autoqa_reviews_1')})",
              f"fact_autoqa_ratings_n AS ({fact_autoqa_ratings_sql(None, d2, 'fact_autoqa_ratings_1')})",
              f"fact_autoqa_root_cause_n AS ({fact_autoqa_root_cause_sql(None, 'fact_autoqa_root_cause_1')})",
              f"fact_conversations_n AS ({fact_conversations_sql(None, d2, 'fact_conversations_1')})",
              f"fact_manual_ratings_n AS ({fact_manual_ratings_sql(None, d2, 'fact_manual_ratings_1')})",
              f"fact_manual_reviews_n AS ({fact_manual_reviews_sql(None, d2, 'fact_manual_reviews_1')})"]
    for n in ("fact_autoqa_reviews", "fact_autoqa_ratings", "fact_autoqa_root_cause", "fact_conversations",
              "fact_manual_ratings", "fact_manual_reviews"):
        parts.append(f"{n}_2 AS ({_upsert_sql(n + '_1', n + '_n', UNIQUE_KEYS[n])})")
    return ",\n".join(parts)


INCREMENTAL_MODELS = ("dim_team", "dim_payment", "dim_user", "dim_rating_category",
                      "fact_autoqa_reviews", "fact_autoqa_ratings", "fact_autoqa_root_cause",
                      "fact_conversations", "fact_manual_ratings", "fact_manual_reviews")
for _n in INCREMENTAL_MODELS:
    ORACLES[f"incr_{_n}"] = _incremental_with() + f"\nSELECT * FROM {_n}_2"


def _merge_sql() -> str:
    from qualis import schemas
    from qualis.sources.fixtures import merge_batch_duckdb
    cols = schemas.columns("customer_subscriptions")
    sel = ", ".join(
        f"t.{c}" if c in ("subscription_id", "dt_customer_signup_date")
        else f"CASE WHEN c.subscription_id IS NOT NULL THEN c.{c} ELSE t.{c} END AS {c}" for c in cols)
    return duckdb_with("customer_subscriptions") + ",\n" + merge_batch_duckdb() + f""",
chg AS (SELECT s.* FROM merge_s s JOIN merge_t t ON t.subscription_id = s.subscription_id
        WHERE COALESCE(t.subscription_updated_at <> s.subscription_updated_at
                       OR t.customer_updated_at <> s.customer_updated_at, false))
SELECT {sel} FROM merge_t t LEFT JOIN chg c ON c.subscription_id = t.subscription_id
UNION ALL
SELECT * FROM merge_s s WHERE NOT EXISTS (SELECT 1 FROM merge_t t WHERE t.subscription_id = s.subscription_id)"""


ORACLES["subs_merge"] = _merge_sql()


def _marts_with() -> str:
    return (_with_dims() + f""",
fact_autoqa_reviews AS ({fact_autoqa_reviews_sql()}),
fact_autoqa_ratings AS ({fact_autoqa_ratings_sql()}),
fact_autoqa_root_cause AS ({fact_autoqa_root_cause_sql()}),
fact_conversations AS ({fact_conversations_sql()}),
fact_manual_ratings AS ({fact_manual_ratings_sql()}),
fact_manual_reviews AS ({fact_manual_reviews_sql()})""")


def _checks_sql(kind: str) -> str:
    from qualis.plans.checks import NOT_NULL, RELATIONSHIPS, UNIQUE
    rows = []
    if kind in ("not_null", "all"):
        rows += [f"SELECT '{t}' AS table_name, 'not_null' AS check_name, '{c}' AS column_name, "
                 f"CAST(COUNT(*) AS BIGINT) AS failures FROM {t} WHERE {c} IS NULL" for t, c in NOT_NULL]
    if kind in ("unique", "all"):
        rows += [f"SELECT '{t}' AS table_name, 'unique' AS check_name, '{c}' AS column_name, "
                 f"CAST(COUNT(*) AS BIGINT) AS failures FROM "
                 f"(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1) x" for t, c in UNIQUE]
    if kind in ("relationships", "all"):
        rows += [f"SELECT '{ch}' AS table_name, 'relationships' AS check_name, '{c}' AS column_name, "
                 f"CAST(COUNT(*) AS BIGINT) AS failures FROM {ch} ch "
                 f"LEFT JOIN {p} p ON ch.{c} = p.{f} WHERE ch.{c} IS NOT NULL AND p.{f} IS NULL"
                 for ch, c, p, f in RELATIONSHIPS]
    return _marts_with() + "\n" + "\nUNION ALL ".join(rows)


ORACLES["check_not_null"] = _checks_sql("not_null")
ORACLES["check_unique"] = _checks_sql("unique")
ORACLES["check_relationships"] = _checks_sql("relationships")
ORACLES["check_suite"] = _checks_sql("all")


# ---------------------------------------------------------------------------
# Raw relations, star drills, dashboard metrics.

ORACLES["raw_reviews_ratings"] = duckdb_with("autoqa_reviews", "autoqa_ratings") + """
SELECT r.autoqa_review_id, r.created_at, r.team_id, r.updated_at AS review_updated_at, a.autoqa_rating_id,
  a.external_ticket_id, a.rating_category_id, a.rating_category_name, a.score
FROM q_autoqa_reviews r JOIN q_autoqa_ratings a ON r.autoqa_review_id = a.autoqa_review_id"""

ORACLES["raw_ratings_causes"] = duckdb_with("autoqa_ratings", "autoqa_root_cause") + """
SELECT a.autoqa_rating_id, a.autoqa_review_id, a.rating_category_id, a.score, c.category,
  c.count AS root_cause_count, c.root_cause
FROM q_autoqa_ratings a JOIN q_autoqa_root_cause c ON a.autoqa_rating_id = c.autoqa_rating_id"""

ORACLES["raw_reviews_conversations"] = duckdb_with("autoqa_reviews", "conversations") + """
SELECT r.payment_id, r.payment_token_id, r.external_ticket_id, r.autoqa_review_id, r.created_at,
  c.channel, c.message_count, c.is_closed
FROM q_autoqa_reviews r JOIN q_conversations c ON r.payment_id = c.payment_id
  AND r.payment_token_id = c.payment_token_id AND r.external_ticket_id = c.external_ticket_id"""

ORACLES["raw_manual_ratings"] = duckdb_with("manual_reviews", "manual_rating") + """
SELECT r.review_id, r.reviewer_id, r.reviewee_id, r.score AS review_score, m.category_id, m.rating, m.weight, m.cause
FROM q_manual_reviews r JOIN q_manual_rating m ON r.review_id = m.review_id"""

ORACLES["raw_manual_conversations"] = duckdb_with("manual_reviews", "conversations") + """
SELECT r.payment_id, r.payment_token_id, r.conversation_external_id, r.review_id, r.score, c.channel, c.message_count
FROM q_manual_reviews r JOIN q_conversations c ON r.payment_id = c.payment_id
  AND r.payment_token_id = c.payment_token_id AND r.conversation_external_id = c.external_ticket_id"""

ORACLES["star_root_cause_drill"] = _marts_with() + """
SELECT c.autoqa_root_cause_key, c.autoqa_rating_key, c.category, c.root_cause, a.autoqa_review_key,
  a.rating_category_key, a.score, r.team_key, r.created_ts
FROM fact_autoqa_root_cause c JOIN fact_autoqa_ratings a ON c.autoqa_rating_key = a.autoqa_rating_key
JOIN fact_autoqa_reviews r ON a.autoqa_review_key = r.autoqa_review_key"""

ORACLES["star_manual_rating_drill"] = _marts_with() + """
SELECT m.manual_rating_key, m.review_id, m.rating_category_key, m.rating, m.weight, r.manual_review_key,
  r.reviewer_key, r.reviewee_key, r.score AS review_score
FROM fact_manual_ratings m JOIN fact_manual_reviews r ON m.review_id = r.review_id"""

DIM_DATE_SQL = """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS calendar_date,
  CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month, CAST(day(d) AS BIGINT) AS day,
  CAST(dayofweek(d) + 1 AS BIGINT) AS day_of_week,
  CASE dayofweek(d) + 1 WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday'
    WHEN 4 THEN 'Wednesday' WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday' WHEN 7 THEN 'Saturday' END AS day_name,
  CAST(quarter(d) AS BIGINT) AS quarter
FROM (SELECT CAST(ts AS DATE) AS d FROM generate_series(TIMESTAMP '2022-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY) g(ts)) x"""

ORACLES["star_reviews_by_date"] = _marts_with() + f""",
dim_date AS ({DIM_DATE_SQL})
SELECT d.year, d.month, d.day_name, COUNT(*) AS n_reviews, round(AVG(f.score), 9) AS avg_score
FROM fact_manual_reviews f LEFT JOIN dim_date d ON f.date_key_created = d.date_key
GROUP BY d.year, d.month, d.day_name"""

ORACLES["ticket_scores_auto_vs_manual"] = duckdb_with("autoqa_ratings", "manual_reviews") + """,
a AS (SELECT external_ticket_id, round(AVG(score), 9) AS auto_avg_score FROM q_autoqa_ratings GROUP BY external_ticket_id),
m AS (SELECT conversation_external_id, round(AVG(score), 9) AS manual_avg_score FROM q_manual_reviews GROUP BY conversation_external_id)
SELECT COALESCE(a.external_ticket_id, m.conversation_external_id) AS external_ticket_id, a.auto_avg_score, m.manual_avg_score
FROM a FULL OUTER JOIN m ON a.external_ticket_id = m.conversation_external_id"""

ORACLES["reviewer_performance"] = _marts_with() + """
SELECT reviewer_key, round(AVG(score), 9) AS avg_score, COUNT(*) AS review_count FROM fact_manual_reviews GROUP BY reviewer_key"""

ORACLES["root_cause_breakdown"] = _marts_with() + """
SELECT c.category, c.root_cause, COUNT(*) AS frequency, SUM(c.root_cause_count) AS total_count,
  round(AVG(a.score), 9) AS avg_rating_score
FROM fact_autoqa_root_cause c LEFT JOIN fact_autoqa_ratings a ON c.autoqa_rating_key = a.autoqa_rating_key
GROUP BY c.category, c.root_cause"""


def _series_sql(unit: str) -> str:
    return _marts_with() + f"""
SELECT 'manual' AS source, CAST(date_trunc('{unit}', created_ts) AS DATE) AS period, round(AVG(score), 9) AS avg_score, COUNT(*) AS n
FROM fact_manual_reviews GROUP BY 2
UNION ALL
SELECT 'auto', CAST(date_trunc('{unit}', r.created_ts) AS DATE), round(AVG(a.score), 9), COUNT(*)
FROM fact_autoqa_ratings a JOIN fact_autoqa_reviews r ON a.autoqa_review_key = r.autoqa_review_key GROUP BY 2"""


ORACLES["score_by_week"] = _series_sql("week")
ORACLES["score_by_month"] = _series_sql("month")

ORACLES["top_agents"] = _marts_with() + """
SELECT reviewee_key, round(AVG(score), 9) AS avg_score, COUNT(*) AS review_count FROM fact_manual_reviews
WHERE reviewee_key IS NOT NULL GROUP BY reviewee_key
ORDER BY avg_score DESC NULLS LAST, review_count DESC, reviewee_key ASC LIMIT 10"""

ORACLES["top_root_causes"] = _marts_with() + """
SELECT root_cause, COUNT(*) AS frequency FROM fact_autoqa_root_cause WHERE root_cause IS NOT NULL
GROUP BY root_cause ORDER BY frequency DESC, root_cause ASC LIMIT 5"""


ORACLES["root_cause_heatmap"] = _marts_with() + """
SELECT category, root_cause, COUNT(*) AS frequency FROM fact_autoqa_root_cause GROUP BY category, root_cause"""


ORACLES["scan_csv"] = duckdb_with("conversations") + "\nSELECT * FROM q_conversations"
ORACLES["json_flatten"] = duckdb_with("customer_subscriptions") + "\nSELECT * FROM q_customer_subscriptions"
ORACLES["subs_initial_load"] = ORACLES["json_flatten"]
ORACLES["subs_merge_load"] = ORACLES["subs_merge"]


def _load_counts_sql() -> str:
    from qualis.sources.csv_source import LANDED_FILES
    return duckdb_with(*LANDED_FILES) + "\n" + "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM q_{t}" for t in LANDED_FILES)


ORACLES["load_counts"] = _load_counts_sql()
ORACLES["scan_csv_split"] = ORACLES["scan_csv"]
ORACLES["json_split"] = ORACLES["json_flatten"]
ORACLES["json_tokens"] = duckdb_with("customer_subscriptions") + """
SELECT * REPLACE ('D''' || customer_first_name || ' None''s True' AS customer_first_name) FROM q_customer_subscriptions"""
ORACLES["sync_columns"] = duckdb_with("manual_rating") + """
SELECT review_id, category_id, rating_max, CASE WHEN category_id % 2 <> 0 THEN weight END AS weight
FROM q_manual_rating WHERE category_id IS NOT NULL"""
ORACLES["running_avg_score"] = duckdb_with("autoqa_ratings") + """
SELECT external_ticket_id, round(AVG(score), 9) AS avg_score
FROM (SELECT DISTINCT autoqa_rating_id, external_ticket_id, score FROM q_autoqa_ratings WHERE autoqa_rating_id IS NOT NULL) d
GROUP BY external_ticket_id"""
ORACLES["running_unique"] = duckdb_with("manual_reviews") + """
SELECT COUNT(*) AS failures FROM (
  SELECT conversation_external_id FROM (SELECT DISTINCT review_id, conversation_external_id FROM q_manual_reviews WHERE review_id IS NOT NULL) d
  WHERE conversation_external_id IS NOT NULL GROUP BY conversation_external_id HAVING COUNT(*) > 1) r"""

"""DuckDB statements that give the expected rows of the registered queries.

Each statement names shared views; ``_statement`` puts the views it needs in front of it.
"""

from __future__ import annotations

import re

from mealmarts.functions.text import STOPWORDS
from mealmarts.plans.insights import PROMPT_TEMPLATE
from mealmarts.registry import BATCH_START, CHANGED_MONTH, DAY, LATE_REGION, LOAD_SPLIT, LOST_USERS, MONTH, RECENT_DAYS, TWICE
from mealmarts.schemas import CONTRACTS, SOURCE_TABLES
from mealmarts.sources.views import SOURCE_SQL

_VIEWS = {
    **SOURCE_SQL,
    "users": """
        SELECT user_id, lower(gender) AS gender, CAST(year(birth_date) AS INTEGER) AS birth_year,
               CAST(ssafy_year AS INTEGER) AS ssafy_year, CAST(class_num AS INTEGER) AS ssafy_class, ssafy_region
        FROM account""",
    "dishes": """
        SELECT menu_food.menu_id, menu.date AS menu_date, food_id, food_name,
               CASE main_sub WHEN '주메뉴' THEN 'main' WHEN '서브메뉴' THEN 'sub' ELSE 'etc' END AS main_sub,
               category AS category_name, tag AS tag_name
        FROM menu_food JOIN food USING (food_id) JOIN menu USING (menu_id)""",
    "attributes": """
        SELECT food_id, min(food_name) AS food_name, min(category_name) AS category_name, min(tag_name) AS tag_name
        FROM dishes GROUP BY food_id""",
    "ratings": """
        SELECT user_id, food_id, food_score, CAST(timestamp AS DATE) AS rating_date
        FROM food_review
        QUALIFY row_number() OVER (PARTITION BY user_id, food_id, CAST(timestamp AS DATE)
                                   ORDER BY id DESC, food_score DESC) = 1""",
    "votes": "SELECT DISTINCT user_id, menu_id FROM pre_vote",
    "menu_ratings": """
        SELECT r.user_id, r.menu_id, menu_score, menu_regret, menu_comment,
               CASE WHEN votes.user_id IS NULL THEN 0 ELSE 1 END AS pre_vote, CAST(timestamp AS DATE) AS comment_date
        FROM (SELECT * FROM menu_review
              QUALIFY row_number() OVER (PARTITION BY user_id, menu_id, CAST(timestamp AS DATE) ORDER BY id DESC) = 1) r
        LEFT JOIN votes ON r.user_id = votes.user_id AND r.menu_id = votes.menu_id""",
    "people": "SELECT *, CAST(floor((2025 - birth_year) / 10) AS BIGINT) AS age_group FROM users",
    "rated": "SELECT * FROM ratings JOIN attributes USING (food_id) JOIN people USING (user_id)",
    "groups": """
        SELECT 'all' AS group_type, 'all' AS group_value, avg(food_score) AS group_avg_score,
               count(DISTINCT category_name) AS group_diversity_score FROM rated
        UNION ALL
        SELECT 'gender', gender, avg(food_score), count(DISTINCT category_name) FROM rated GROUP BY gender
        UNION ALL
        SELECT 'age', CAST(age_group AS VARCHAR), avg(food_score), count(DISTINCT category_name)
        FROM rated GROUP BY age_group""",
    "own": """
        SELECT user_id, any_value(gender) AS gender, any_value(age_group) AS age_group,
               avg(food_score) AS user_avg_score, count(DISTINCT category_name) AS user_diversity_score
        FROM rated GROUP BY user_id""",
    "comparison_rows": """
        SELECT user_id, group_type, group_value, user_avg_score, group_avg_score,
               user_diversity_score, group_diversity_score
        FROM own JOIN groups ON group_type = 'all' OR (group_type = 'gender' AND group_value = gender)
             OR (group_type = 'age' AND group_value = CAST(age_group AS VARCHAR))""",
    "user_food": "SELECT user_id, food_id, avg(food_score) AS food_score FROM ratings GROUP BY user_id, food_id",
    "food_rank": """
        SELECT user_id, food_name, food_score, CAST(place AS INTEGER) AS rank_order, score_type FROM (
            SELECT *, 'best' AS score_type,
                   row_number() OVER (PARTITION BY user_id ORDER BY food_score DESC, food_id) AS place FROM user_food
            UNION ALL
            SELECT *, 'worst', row_number() OVER (PARTITION BY user_id ORDER BY food_score NULLS FIRST, food_id)
            FROM user_food) LEFT JOIN attributes USING (food_id)
        WHERE place <= 5""",
    "tag_counts": """
        SELECT user_id, tag_name AS tag, count(*) AS count FROM ratings JOIN attributes USING (food_id)
        GROUP BY ALL""",
    "category_counts": """
        SELECT user_id, category_name AS category, count(*) AS count FROM ratings JOIN attributes USING (food_id)
        GROUP BY ALL""",
    "words": f"""
        SELECT user_id, word, comment_date, count(*) AS count
        FROM (SELECT user_id, comment_date, unnest(regexp_split_to_array(menu_comment, '[^\\p{{L}}\\p{{N}}]+')) AS word
              FROM review_comment WHERE menu_comment IS NOT NULL)
        WHERE length(word) > 1 AND word NOT IN ({", ".join(f"'{w}'" for w in STOPWORDS)})
        GROUP BY user_id, word, comment_date""",
    "food_means": """
        SELECT strftime(timestamp, '%Y-%m') AS month, food_id, food_name, avg(food_score) AS mean, count(*) AS count
        FROM food_review JOIN food USING (food_id) GROUP BY ALL""",
    "food_ranking": """
        SELECT month, food_id, food_name, CAST(CAST(mean AS VARCHAR) AS DECIMAL(3,2)) AS avg_score, rank_type,
               CAST(place AS INTEGER) AS rank, count FROM (
            SELECT *, 'best' AS rank_type,
                   row_number() OVER (PARTITION BY month ORDER BY mean DESC, food_id) AS place FROM food_means
            UNION ALL
            SELECT *, 'worst', row_number() OVER (PARTITION BY month ORDER BY mean NULLS FIRST, food_id) FROM food_means)
        WHERE place <= 5""",
    "evaluations": """
        SELECT strftime(timestamp, '%Y-%m') AS month FROM menu_review
        UNION ALL
        SELECT strftime(date, '%Y-%m') FROM pre_vote JOIN menu USING (menu_id)""",
    "activity": """
        SELECT strftime(timestamp, '%Y-%m') AS month, user_id FROM menu_review
        UNION ALL
        SELECT strftime(date, '%Y-%m'), user_id FROM pre_vote JOIN menu USING (menu_id)""",
    "statistics": """
        SELECT strftime(timestamp, '%Y-%m') AS month,
               CAST(trunc(min(food_score)) AS INTEGER) AS min, CAST(trunc(max(food_score)) AS INTEGER) AS max,
               CAST(CAST(avg(food_score) AS VARCHAR) AS DECIMAL(3,2)) AS avg,
               CAST(trunc(quantile_disc(food_score, 0.25)) AS INTEGER) AS q1,
               CAST(trunc(quantile_disc(food_score, 0.75)) AS INTEGER) AS q3,
               CAST(CAST(var_samp(food_score) AS VARCHAR) AS DECIMAL(3,2)) AS variance,
               CAST(CAST(stddev_samp(food_score) AS VARCHAR) AS DECIMAL(3,2)) AS stdev
        FROM food_review GROUP BY 1""",
    "evaluators": """
        SELECT month, row_number() OVER (PARTITION BY month ORDER BY evaluates DESC, username, user_id) AS rank,
               username AS name, evaluates, last_evaluate FROM (
            SELECT month, user_id, count(*) AS evaluates, max(moment) AS last_evaluate FROM (
                SELECT strftime(timestamp, '%Y-%m') AS month, user_id, timestamp AS moment FROM food_review
                UNION ALL
                SELECT strftime(date, '%Y-%m'), user_id, CAST(date AS TIMESTAMP) FROM pre_vote JOIN menu USING (menu_id))
            GROUP BY month, user_id) JOIN account USING (user_id)""",
    "pairs": """
        SELECT date, min(menu_id) AS menu_id_a, max(menu_id) AS menu_id_b
        FROM menu GROUP BY date HAVING count(DISTINCT menu_id) > 1""",
    "dish_features": """
        SELECT food_id, category, tag, main_sub, avg_food_score, review_count
        FROM food LEFT JOIN (SELECT food_id, avg(food_score) AS avg_food_score, count(id) AS review_count
                             FROM food_review GROUP BY food_id) USING (food_id)""",
    "offer_features": """
        SELECT menu_id, string_agg(CAST(food_id AS VARCHAR), ',' ORDER BY food_id) AS food_ids,
               avg(avg_food_score) AS avg_food_score, count(review_count) AS review_count,
               CAST(sum(review_count) AS BIGINT) AS total_reviews
        FROM menu_food JOIN dish_features USING (food_id) GROUP BY menu_id""",
    "choices": """
        SELECT r.id AS review_id, r.user_id, pairs.date, menu_id_a, menu_id_b, r.menu_id AS chosen_menu_id,
               CASE WHEN r.menu_id = menu_id_a THEN 0 ELSE 1 END AS label, gender,
               CAST(2025 - year(birth_date) AS INTEGER) AS age, ssafy_region AS region, class_num,
               round(a.avg_food_score, 9) AS avg_food_score_a, a.review_count AS review_count_a,
               round(b.avg_food_score, 9) AS avg_food_score_b, b.review_count AS review_count_b
        FROM menu_review r JOIN pairs ON CAST(r.timestamp AS DATE) = pairs.date JOIN account USING (user_id)
             JOIN offer_features a ON a.menu_id = menu_id_a JOIN offer_features b ON b.menu_id = menu_id_b""",
    "sides": """
        SELECT menu_date AS train_date, unnest([min(menu_id), max(menu_id)]) AS menu_id, unnest([0, 1]) AS label
        FROM dishes GROUP BY menu_date HAVING count(DISTINCT menu_id) > 1""",
    "side_tags": "SELECT DISTINCT train_date, label, tag_name FROM dishes JOIN sides USING (menu_id)",
    "side_categories": "SELECT DISTINCT train_date, label, category_name FROM dishes JOIN sides USING (menu_id)",
    "labels_ab": """
        SELECT user_id, menu_id, train_date, label, menu_regret, pre_vote
        FROM menu_ratings JOIN sides USING (menu_id) WHERE menu_score IS NOT NULL""",
    "dish_rows": "SELECT food_id, tag_name, category_name, count(*) AS menus FROM dishes GROUP BY ALL",
    "liked": """
        SELECT r.user_id, tag_name, category_name, sum(food_score * menus) AS total, sum(menus) AS n
        FROM ratings r JOIN (SELECT user_id, avg(food_score) AS mean FROM ratings GROUP BY user_id) m
             ON r.user_id = m.user_id AND food_score >= mean JOIN dish_rows USING (food_id) GROUP BY ALL""",
    "tag_scores": "SELECT user_id, tag_name, sum(total) / sum(n) AS score FROM liked GROUP BY user_id, tag_name",
    "category_scores": "SELECT user_id, category_name, sum(total) / sum(n) AS score FROM liked GROUP BY user_id, category_name",
    "tag_facts": """
        SELECT l.user_id, l.menu_id, l.train_date, s.label AS side, count(t.tag_name) AS shared,
               count(t.tag_name) / count(*) AS ratio, round(avg(t.score), 9) AS score
        FROM labels_ab l JOIN side_tags s ON s.train_date = l.train_date
             LEFT JOIN tag_scores t ON t.user_id = l.user_id AND t.tag_name = s.tag_name GROUP BY ALL""",
    "category_facts": """
        SELECT l.user_id, l.menu_id, l.train_date, s.label AS side, count(c.category_name) AS shared,
               count(c.category_name) / count(*) AS ratio, round(avg(c.score), 9) AS score
        FROM labels_ab l JOIN side_categories s ON s.train_date = l.train_date
             LEFT JOIN category_scores c ON c.user_id = l.user_id AND c.category_name = s.category_name GROUP BY ALL""",
    "feature_rows": """
        SELECT l.*, CAST(ta.shared AS INTEGER) AS A_tag_overlap, round(ta.ratio, 9) AS A_tag_ratio,
               CAST(tb.shared AS INTEGER) AS B_tag_overlap, round(tb.ratio, 9) AS B_tag_ratio,
               CAST(ca.shared AS INTEGER) AS A_category_overlap, round(ca.ratio, 9) AS A_category_ratio,
               CAST(cb.shared AS INTEGER) AS B_category_overlap, round(cb.ratio, 9) AS B_category_ratio,
               ta.score AS A_avg_score_on_tags, tb.score AS B_avg_score_on_tags,
               ca.score AS A_avg_score_on_categories, cb.score AS B_avg_score_on_categories
        FROM labels_ab l
        JOIN (SELECT DISTINCT user_id FROM liked) USING (user_id)
        JOIN tag_facts ta ON (ta.user_id, ta.menu_id, ta.train_date, ta.side) = (l.user_id, l.menu_id, l.train_date, 0)
        JOIN tag_facts tb ON (tb.user_id, tb.menu_id, tb.train_date, tb.side) = (l.user_id, l.menu_id, l.train_date, 1)
        JOIN category_facts ca ON (ca.user_id, ca.menu_id, ca.train_date, ca.side) = (l.user_id, l.menu_id, l.train_date, 0)
        JOIN category_facts cb ON (cb.user_id, cb.menu_id, cb.train_date, cb.side) = (l.user_id, l.menu_id, l.train_date, 1)""",
    "training": """
        SELECT user_id, menu_id, gender AS user_gender, CAST(2025 - birth_year AS INTEGER) AS user_age,
               A_tag_overlap, B_tag_overlap, A_tag_ratio, B_tag_ratio,
               A_category_overlap, B_category_overlap, A_category_ratio, B_category_ratio,
               A_avg_score_on_tags, B_avg_score_on_tags, A_avg_score_on_categories, B_avg_score_on_categories,
               menu_regret, pre_vote, label, train_date
        FROM feature_rows LEFT JOIN users USING (user_id)""",
    "menu_tags": "SELECT menu_id, tag, count(*) AS dishes FROM menu_food JOIN food USING (food_id) WHERE tag IS NOT NULL GROUP BY ALL",
    "review_features": """
        SELECT review_id, label, 1 AS position, 'user_id' AS block, user_id AS number, '' AS value, 1.0::DOUBLE AS x FROM choices
        UNION ALL SELECT review_id, label, 2, 'gender', 0, gender, 1 FROM choices
        UNION ALL SELECT review_id, label, 3, 'region', 0, region, 1 FROM choices
        UNION ALL SELECT review_id, label, 4, 'class_num', 0, class_num, 1 FROM choices
        UNION ALL SELECT review_id, label, 5, 'tag_a', 0, tag, dishes FROM choices JOIN menu_tags ON menu_id = menu_id_a
        UNION ALL SELECT review_id, label, 6, 'tag_b', 0, tag, dishes FROM choices JOIN menu_tags ON menu_id = menu_id_b
        UNION ALL SELECT review_id, label, 7, 'avg_food_score_a', 0, '', avg_food_score_a FROM choices
        UNION ALL SELECT review_id, label, 8, 'avg_food_score_b', 0, '', avg_food_score_b FROM choices""",
    "dictionary": """
        SELECT row_number() OVER (ORDER BY position, number, value) - 1 AS idx, position, block, number, value,
               CASE WHEN position = 1 THEN block || '=' || CAST(number AS VARCHAR) WHEN position <= 4 THEN block || '=' || value
                    WHEN position <= 6 THEN block || '_' || value ELSE block END AS feature
        FROM (SELECT DISTINCT position, block, number, value FROM review_features WHERE value IS NOT NULL)""",
    "marked_features": f"""
        SELECT d.*, EXISTS (SELECT 1 FROM review_features f JOIN choices c ON c.review_id = f.review_id
                            WHERE c.date < DATE '{LOAD_SPLIT}' AND (f.position, f.number, f.value) = (d.position, d.number, d.value)) AS is_early
        FROM dictionary d""",
    "encoded": """
        SELECT review_id, label, idx, x AS value FROM review_features r
        JOIN dictionary d ON (r.position, r.number, r.value) = (d.position, d.number, d.value)
        WHERE x IS NOT NULL AND x <> 0""",
    "scored": """
        SELECT label, round(avg_food_score_b_full / (avg_food_score_a_full + avg_food_score_b_full), 9) AS score
        FROM (SELECT CASE WHEN r.menu_id = menu_id_a THEN 0 ELSE 1 END AS label,
                     a.avg_food_score AS avg_food_score_a_full, b.avg_food_score AS avg_food_score_b_full
              FROM menu_review r JOIN pairs ON CAST(r.timestamp AS DATE) = pairs.date JOIN account USING (user_id)
                   JOIN offer_features a ON a.menu_id = menu_id_a JOIN offer_features b ON b.menu_id = menu_id_b)
        WHERE avg_food_score_a_full IS NOT NULL AND avg_food_score_b_full IS NOT NULL""",
    "confusion": """
        SELECT count(*) FILTER (label = 1 AND score >= 0.5) AS tp, count(*) FILTER (label = 0 AND score >= 0.5) AS fp,
               count(*) FILTER (label = 1 AND score < 0.5) AS fn, count(*) FILTER (label = 0 AND score < 0.5) AS tn
        FROM scored""",
    "context": """
        SELECT user_id, top_food_lines, tag AS top_tag, t.count AS top_tag_count, category AS top_category,
               c.count AS top_category_count, user_avg_score, group_avg_score, user_diversity_score, group_diversity_score
        FROM (SELECT DISTINCT user_id FROM ratings)
        LEFT JOIN (SELECT user_id, string_agg('- ' || food_name || ' (' || CAST(food_score AS VARCHAR) || '점)', chr(10)
                                              ORDER BY rank_order) AS top_food_lines
                   FROM food_rank WHERE score_type = 'best' AND rank_order <= 3 GROUP BY user_id) USING (user_id)
        LEFT JOIN (SELECT * FROM tag_counts
                   QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count DESC, tag) = 1) t USING (user_id)
        LEFT JOIN (SELECT * FROM category_counts
                   QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count DESC, category) = 1) c USING (user_id)
        LEFT JOIN (SELECT * FROM comparison_rows WHERE group_type = 'all') USING (user_id)""",
    "load_target": f"SELECT * FROM menu_review WHERE timestamp < TIMESTAMP '{LOAD_SPLIT}'",
    "load_batch": f"""
        SELECT id, user_id, menu_id, 5.5::DOUBLE - menu_score AS menu_score, menu_regret, menu_comment, timestamp
        FROM menu_review WHERE timestamp >= TIMESTAMP '{BATCH_START}'""",
    "rating_target": f"SELECT * FROM ratings WHERE rating_date < DATE '{LOAD_SPLIT}'",
    "rating_batch": f"""
        SELECT id, user_id, food_id, 5.5::DOUBLE - food_score AS food_score, CAST(timestamp AS DATE) AS rating_date
        FROM food_review WHERE timestamp >= TIMESTAMP '{BATCH_START}'""",
    "text_messages": "SELECT CAST(event_id AS VARCHAR) AS key, props AS value FROM events",
    "json_fields": "SELECT CAST(event_id AS VARCHAR) AS key, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
}

_BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _statement(body: str) -> str:
    """The body with every view it needs, directly or through others, in front of it."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql):
            if name in _VIEWS and name not in needed:
                visit(_VIEWS[name])
                needed.append(name)

    visit(body)
    views = ",\n".join(f"{name} AS ({_VIEWS[name]})" for name in needed)
    return f"WITH {views}\n{body}" if needed else body


def _bulk_copy() -> str:
    parts = [
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM (DESCRIBE SELECT * FROM {t})) AS column_count, "
        f"(SELECT count(*) FROM {t}) AS row_count"
        for t in _BASE_TABLES
    ]
    return "\nUNION ALL ".join(parts)


# Columns of the base tables; a mark tells how a value becomes text: d double, t timestamp, a array of floats.
_BASE_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal:d c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal:d",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice:d",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice:d o_orderdate:t o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity:d l_extendedprice:d l_discount:d l_tax:d "
    "l_returnflag l_linestatus l_shipdate:t",
    "events": "event_id ts:t user_id event_type value:d props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding:a label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


def _double_text(x: str) -> str:
    return f"concat(CAST(floor({x}) AS BIGINT), '+', CAST(floor(({x} - floor({x})) * 4503599627370496.0::DOUBLE) AS BIGINT))"


def _bulk_copy_fingerprints() -> str:
    texts = {
        "": lambda c: f"CAST({c} AS VARCHAR)",
        "d": lambda c: f"CASE WHEN {c} IS NOT NULL THEN {_double_text(c)} END",
        "t": lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')",
        "a": lambda c: f"array_to_string(list_transform({c}, lambda x: {_double_text('x::DOUBLE')}), ',')",
    }
    parts = []
    for table, columns in _BASE_COLUMNS.items():
        for column in columns.split():
            name, _, mark = column.partition(":")
            parts.append(
                f"SELECT '{table}' AS table_name, '{name}' AS column_name, count(*) AS row_count, count(*) - count({name}) AS null_count, "
                f"CAST(coalesce(sum(CAST(concat('0x', substr(md5({texts[mark](name)}), 1, 15)) AS BIGINT)), 0) AS DECIMAL(38,0)) AS fingerprint, "
                f"TRUE AS same_rows FROM {table}"
            )
    return "\nUNION ALL ".join(parts)


def _contract_report() -> str:
    stored = {name: name for name in SOURCE_TABLES}
    stored |= {
        "dim_user": "users",
        "dim_menu_food_combined": "dishes",
        "fact_user_food_feedback": "ratings",
        "fact_user_menu_feedback": "menu_ratings",
    }
    parts = []
    for table, view in stored.items():
        spec = CONTRACTS[table]
        for i, column in enumerate(spec.schema):
            parts.append(
                f"SELECT '{table}' AS table_name, {i + 1} AS position, '{column.name}' AS column_name, "
                f"'{column.dataType.simpleString()}' AS data_type, {str(column.name in spec.key).lower()} AS is_key, "
                f"count(*) - count({column.name}) AS null_count, count(*) AS row_count FROM {view}"
            )
    return "\nUNION ALL ".join(parts)


def _prompt() -> str:
    text = PROMPT_TEMPLATE.replace("'", "''")
    text = re.sub(r"\{(\w+)\}", r"' || CAST(\1 AS VARCHAR) || '", text)
    return (
        f"SELECT user_id, '{text}' AS prompt FROM context "
        "WHERE top_tag_count IS NOT NULL AND top_category_count IS NOT NULL AND group_diversity_score IS NOT NULL"
    )


_SQL = {
    "dim_user": "SELECT * FROM users",
    "dim_menu_food": "SELECT * FROM dishes",
    "fact_food_feedback": "SELECT * FROM ratings",
    "fact_food_feedback_day": f"SELECT * FROM ratings WHERE rating_date = DATE '{DAY}'",
    "fact_menu_feedback": "SELECT * FROM menu_ratings",
    "fact_menu_feedback_day": f"SELECT * FROM menu_ratings WHERE comment_date = DATE '{DAY}'",
    "food_attributes": "SELECT * FROM attributes",
    "rated_users": "SELECT DISTINCT user_id FROM ratings",
    "load_append": f"""
        SELECT * FROM load_target
        UNION ALL SELECT * FROM load_batch WHERE timestamp >= TIMESTAMP '{LOAD_SPLIT}'""",
    "load_ignore": """
        SELECT * FROM load_target
        UNION ALL SELECT * FROM load_batch WHERE id NOT IN (SELECT id FROM load_target)""",
    "load_upsert": """
        SELECT * FROM load_target WHERE id NOT IN (SELECT id FROM load_batch)
        UNION ALL SELECT * FROM load_batch""",
    "store_append": "SELECT * FROM ratings",
    "store_ignore": """
        SELECT * FROM rating_target
        UNION ALL
        SELECT user_id, food_id, food_score, rating_date FROM rating_batch ANTI JOIN rating_target USING (user_id, food_id, rating_date)
        QUALIFY row_number() OVER (PARTITION BY user_id, food_id, rating_date
                                   ORDER BY id NULLS FIRST, food_score NULLS FIRST) = 1""",
    "store_upsert": """
        SELECT * FROM rating_target ANTI JOIN rating_batch USING (user_id, food_id, rating_date)
        UNION ALL
        SELECT user_id, food_id, food_score, rating_date FROM rating_batch
        QUALIFY row_number() OVER (PARTITION BY user_id, food_id, rating_date
                                   ORDER BY id DESC NULLS LAST, food_score DESC NULLS LAST) = 1""",
    "mart_overwrite_roundtrip": """
        SELECT 'dm_user_category_stats' AS table_name, user_id, category AS value, count FROM category_counts
        UNION ALL SELECT 'dm_user_tag_stats', user_id, tag, count FROM tag_counts""",
    "bulk_copy": _bulk_copy(),
    "bulk_copy_fingerprints": _bulk_copy_fingerprints(),
    "bulk_copy_changes": f"""
        SELECT * FROM (
            SELECT id, CASE WHEN user_id % {LOST_USERS} = 0 THEN 'missing' WHEN id % {TWICE} = 0 THEN 'repeated'
                            WHEN strftime(timestamp, '%Y-%m') = '{CHANGED_MONTH}' THEN 'changed' END AS change,
                   CASE WHEN user_id % {LOST_USERS} <> 0 AND id % {TWICE} <> 0 THEN 'menu_score' ELSE '' END AS columns
            FROM menu_review) WHERE change IS NOT NULL""",
    "training_csv_roundtrip": "SELECT * FROM training",
    "json_sink_roundtrip": "SELECT * FROM json_fields",
    "empty_table_contracts": _contract_report(),
    "key_violations": """
        SELECT 'fact_user_food_feedback' AS table_name,
               concat_ws('|', user_id, food_id, CAST(timestamp AS DATE)) AS key_text, count(*) AS row_count
        FROM food_review GROUP BY user_id, food_id, CAST(timestamp AS DATE) HAVING count(*) > 1
        UNION ALL
        SELECT 'fact_user_menu_feedback', concat_ws('|', user_id, menu_id, CAST(timestamp AS DATE)), count(*)
        FROM menu_review GROUP BY user_id, menu_id, CAST(timestamp AS DATE) HAVING count(*) > 1""",
    "domain_violations": """
        SELECT 'account' AS table_name, 'gender' AS column_name, gender AS value, count(*) AS row_count
        FROM account WHERE gender NOT IN ('m', 'f') GROUP BY gender
        UNION ALL
        SELECT 'food', 'main_sub', main_sub, count(*)
        FROM food WHERE main_sub NOT IN ('main', 'sub', 'etc') GROUP BY main_sub
        UNION ALL
        SELECT 'dim_user', 'gender', gender, count(*) FROM users WHERE gender NOT IN ('m', 'f') GROUP BY gender
        UNION ALL
        SELECT 'dim_menu_food_combined', 'main_sub', main_sub, count(*)
        FROM dishes WHERE main_sub NOT IN ('main', 'sub', 'etc') GROUP BY main_sub
        UNION ALL
        SELECT 'xgb_train_data', 'user_gender', user_gender, count(*)
        FROM training WHERE user_gender NOT IN ('m', 'f') GROUP BY user_gender""",
    "orphan_rows": f"""
        SELECT 'fact_user_food_feedback' AS table_name, user_id AS key_value, count(*) AS row_count
        FROM ratings WHERE user_id NOT IN (SELECT user_id FROM users WHERE ssafy_region <> '{LATE_REGION}')
        GROUP BY user_id
        UNION ALL
        SELECT 'fact_user_menu_feedback', user_id, count(*)
        FROM menu_ratings WHERE user_id NOT IN (SELECT user_id FROM users WHERE ssafy_region <> '{LATE_REGION}')
        GROUP BY user_id
        UNION ALL
        SELECT 'raw_user_review_word', user_id, count(*)
        FROM words WHERE user_id NOT IN (SELECT user_id FROM users WHERE ssafy_region <> '{LATE_REGION}')
        GROUP BY user_id""",
    "ab_gate": """
        SELECT menu_date AS date, count(DISTINCT menu_id) AS menu_count
        FROM dishes GROUP BY menu_date HAVING count(DISTINCT menu_id) >= 2""",
    "user_summary": """
        SELECT user_id, avg_score, total_reviews, coalesce(pre_vote_count, 0) AS pre_vote_count
        FROM (SELECT user_id, coalesce(avg(food_score), 0) AS avg_score, count(food_score) AS total_reviews
              FROM ratings GROUP BY user_id)
        LEFT JOIN (SELECT user_id, CAST(sum(pre_vote) AS BIGINT) AS pre_vote_count FROM menu_ratings GROUP BY user_id)
             USING (user_id)""",
    "user_food_rating_rank": "SELECT * FROM food_rank",
    "user_category_stats": "SELECT * FROM category_counts",
    "user_tag_stats": "SELECT * FROM tag_counts",
    "group_stats": "SELECT * FROM groups",
    "user_group_comparison": "SELECT * FROM comparison_rows",
    "recent_reviews": f"""
        SELECT user_id, since, count(*) AS review_count
        FROM menu_review JOIN (SELECT user_id, max(timestamp) - INTERVAL {RECENT_DAYS} DAY AS since FROM menu_review GROUP BY user_id) USING (user_id)
        WHERE timestamp >= since GROUP BY user_id, since""",
    "user_review_word": "SELECT user_id, word, CAST(sum(count) AS BIGINT) AS count FROM words GROUP BY user_id, word",
    "user_insight_latest": """
        SELECT user_id, insight FROM raw_insight
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY insight_date DESC, event_id DESC) = 1""",
    "monthly_food_ranking": "SELECT * FROM food_ranking",
    "monthly_food_ranking_month": f"SELECT * FROM food_ranking WHERE month = '{MONTH}'",
    "monthly_count": f"""
        SELECT count(*) AS evaluator, count(*) AS cumulative, count(*) AS difference
        FROM evaluations WHERE month = '{MONTH}'""",
    "monthly_count_series": """
        SELECT month, n AS evaluator, CAST(sum(n) OVER (ORDER BY month) AS BIGINT) AS cumulative,
               n - coalesce(lag(n) OVER (ORDER BY month), 0) AS difference
        FROM (SELECT month, count(*) AS n FROM evaluations GROUP BY month)""",
    "cumulative_distinct_evaluators": """
        SELECT count(DISTINCT user_id) AS cumulative_evaluators
        FROM (SELECT user_id FROM menu_review UNION ALL SELECT user_id FROM pre_vote)""",
    "monthly_count_chained": """
        SELECT month, n AS evaluator, CAST(sum(n) OVER (ORDER BY month) AS BIGINT) AS cumulative,
               n - coalesce(lag(n) OVER (ORDER BY month), 0) AS difference
        FROM (SELECT month, count(*) AS n FROM evaluations GROUP BY month)""",
    "running_distinct_evaluators": """
        SELECT month, people - coalesce(lag(people) OVER (ORDER BY month), 0) AS new_evaluators, people AS cumulative_evaluators
        FROM (SELECT m.month, count(DISTINCT a.user_id) AS people
              FROM (SELECT DISTINCT month FROM activity) m JOIN activity a ON a.month <= m.month GROUP BY m.month)""",
    "monthly_quartiles_merged": """
        SELECT strftime(timestamp, '%Y-%m') AS month, count(food_score) AS n, TRUE AS q1_within, TRUE AS q3_within
        FROM food_review GROUP BY 1""",
    "user_rank_incremental": "SELECT * FROM food_rank",
    "insight_append": """
        SELECT user_id, insight_date, insight FROM raw_insight
        QUALIFY row_number() OVER (PARTITION BY user_id, insight_date ORDER BY event_id DESC) = 1""",
    "monthly_statistic": "SELECT * FROM statistics",
    "monthly_statistic_month": f"SELECT * FROM statistics WHERE month = '{MONTH}'",
    "monthly_frequent_evaluator": "SELECT * FROM evaluators",
    "monthly_frequent_evaluator_month": f"SELECT * FROM evaluators WHERE month = '{MONTH}'",
    "class_engagement_monthly": """
        SELECT CAST(date_trunc('month', timestamp) AS DATE) AS month, class_num AS class, ssafy_year AS generation,
               count(*) AS review_count
        FROM menu_review JOIN account USING (user_id) GROUP BY ALL""",
    "previous_month": """
        SELECT strftime(timestamp, '%Y-%m') AS month,
               strftime(min(date_trunc('month', timestamp)) - INTERVAL 1 MONTH, '%Y-%m') AS previous_month,
               count(*) AS review_count
        FROM menu_review GROUP BY 1""",
    "menu_pairs": "SELECT * FROM pairs",
    "food_features": "SELECT * FROM dish_features",
    "menu_features": """
        SELECT menu_id, food_ids, round(avg_food_score, 9) AS avg_food_score, review_count, total_reviews
        FROM offer_features""",
    "menu_comparison": "SELECT * FROM choices",
    "menu_comparison_day": f"SELECT * FROM choices WHERE date = DATE '{DAY}'",
    "menu_pairs_day": f"SELECT * FROM pairs WHERE date = DATE '{DAY}'",
    "menu_dishes": """
        SELECT menu_id, food_id, category, tag, main_sub, avg_food_score, review_count
        FROM menu_food JOIN dish_features USING (food_id)""",
    "ab_training_rows_day": f"SELECT * FROM training WHERE train_date = DATE '{DAY}'",
    "fm_train_predict": "SELECT review_id, label, TRUE AS score_is_share, TRUE AS class_follows_score FROM choices",
    "fm_train_metrics": """
        SELECT count(*) AS rows, count(*) FILTER (label = 1) AS positive, TRUE AS rmse_agrees, TRUE AS precision_agrees,
               TRUE AS recall_agrees FROM choices""",
    "gbt_train_predict": """
        SELECT user_id, train_date, menu_id, label, TRUE AS score_is_share, TRUE AS class_follows_score FROM training""",
    "gbt_train_metrics": """
        SELECT count(*) AS rows, count(*) FILTER (label = 1) AS positive, TRUE AS accuracy_agrees, TRUE AS precision_agrees,
               TRUE AS recall_agrees, TRUE AS f1_score_agrees FROM training""",
    "gbt_holdout_metrics": """
        SELECT count(*) AS all_rows, TRUE AS share_held, TRUE AS only_held, TRUE AS accuracy_agrees, TRUE AS precision_agrees,
               TRUE AS recall_agrees, TRUE AS f1_score_agrees FROM training""",
    "json_object_columns": "SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events",
    "ab_user_preferences": """
        SELECT user_id, string_agg(DISTINCT tag_name, ',' ORDER BY tag_name) AS user_tags,
               string_agg(DISTINCT category_name, ',' ORDER BY category_name) AS user_cats
        FROM liked GROUP BY user_id""",
    "ab_overlap_features": """
        SELECT user_id, menu_id, train_date, A_tag_overlap, B_tag_overlap, A_tag_ratio, B_tag_ratio,
               A_category_overlap, B_category_overlap, A_category_ratio, B_category_ratio FROM feature_rows""",
    "ab_affinity_scores": """
        SELECT user_id, menu_id, train_date, A_avg_score_on_tags, B_avg_score_on_tags,
               A_avg_score_on_categories, B_avg_score_on_categories FROM feature_rows""",
    "ab_labels": "SELECT * FROM labels_ab",
    "ab_training_rows": "SELECT * FROM training",
    "fm_feature_dictionary": "SELECT idx, block, feature FROM dictionary",
    "fm_dictionary_append": """
        SELECT CASE WHEN is_early THEN place ELSE place + (SELECT count(*) FROM marked_features WHERE is_early) END - 1 AS idx, block, feature
        FROM (SELECT *, row_number() OVER (PARTITION BY is_early ORDER BY position, number, value) AS place FROM marked_features)""",
    "fm_sparse_rows": "SELECT review_id, idx, value FROM encoded",
    "fm_libfm_lines": """
        SELECT concat_ws(' ', CAST(any_value(label) AS VARCHAR),
                         string_agg(concat(idx, ':', CASE WHEN value = floor(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR)
                                                          ELSE CAST(value AS VARCHAR) END), ' ' ORDER BY idx)) AS line
        FROM encoded GROUP BY review_id""",
    "json_feature_columns": """
        SELECT event_id, 'k' AS name, CAST(json_extract(props, '$.k') AS DOUBLE) AS value FROM events
        WHERE json_extract(props, '$.k') IS NOT NULL""",
    "binary_metrics": """
        SELECT tp, fp, fn, tn, CASE WHEN tp + fp + fn + tn = 0 THEN 0 ELSE (tp + tn) / (tp + fp + fn + tn) END AS accuracy,
               CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
               CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
               CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1_score
        FROM confusion""",
    "rmse_metric": "SELECT round(sqrt(avg((score - label) * (score - label))), 9) AS rmse FROM scored",
    "review_words": "SELECT * FROM words",
    "review_words_text_dates": """
        SELECT user_id, word, CASE WHEN day(comment_date) % 7 = 0 THEN DATE '1970-01-01' ELSE comment_date END AS comment_date,
               CAST(sum(count) AS BIGINT) AS count
        FROM words GROUP BY ALL""",
    "insight_context": "SELECT * FROM context",
    "insight_prompt": _prompt(),
    "json_messages": "SELECT * FROM json_fields",
    "stream_exactly_once": "SELECT * FROM text_messages",
    "stream_messages": "SELECT * FROM text_messages",
    "publish_messages": "SELECT * FROM text_messages",
}


def all_sql() -> dict[str, str]:
    return {key: _statement(body) for key, body in _SQL.items()}

"""SQL forms of the versioned dimensions, for the side-by-side check."""

from __future__ import annotations

from .columns import MODEL_HASH_SQL, POST_HASH_SQL


def versions_sql(rows: str, key: str, attributes: str, order: str, until: str = "") -> dict[str, str]:
    """CTEs ``<rows>_loads`` and ``<rows>_versions`` over a CTE of prepared rows."""
    loads, versions = f"{rows}_loads", f"{rows}_versions"
    where = f"WHERE loaded_at < TIMESTAMP '{until}'" if until else ""
    return {
        loads: f"""
            SELECT * FROM {rows} {where}
            QUALIFY row_number() OVER (PARTITION BY {key}, loaded_at ORDER BY {order}) = 1""",
        versions: f"""
            SELECT md5({key} || '|' || strftime(loaded_at, '%Y-%m-%d %H:%M:%S.%f')) AS id,
              {key}, {attributes}, hashdiff, loaded_at AS valid_from,
              coalesce(lead(loaded_at) OVER w, loaded_at + to_days(36500)) AS valid_to,
              lead(loaded_at) OVER w IS NULL AS is_current
            FROM (SELECT *, lag(hashdiff) OVER (PARTITION BY {key} ORDER BY loaded_at) AS before
                  FROM {loads})
            WHERE before IS DISTINCT FROM hashdiff
            WINDOW w AS (PARTITION BY {key} ORDER BY loaded_at)""",
    }


POST_ROWS = {
    "post_rows": f"""
        SELECT *, {POST_HASH_SQL} AS hashdiff
        FROM (SELECT * REPLACE (nullif(trim(author), '') AS author) FROM ods_posts)""",
}
MODEL_ROWS = {
    "model_rows": f"""
        SELECT *, id AS name, {MODEL_HASH_SQL} AS hashdiff FROM ods_models
        WHERE owner IS NOT NULL AND created_at >= TIMESTAMP '2000-01-01'""",
}
MODEL_ORDER_SQL = (
    "position DESC, downloads DESC, likes DESC, trending_score DESC"
)

POST_VERSIONS = {**POST_ROWS, **versions_sql("post_rows", "slug", "content_raw", "position DESC")}
MODEL_VERSIONS = {
    **MODEL_ROWS, **versions_sql("model_rows", "name", "owner, license", MODEL_ORDER_SQL),
}

"""DuckDB CTEs of the test-data mapping (the SQL twin of sources/testdata.py).

Each oracle query names the logical tables it reads; :func:`with_views`
prefixes the needed CTEs in dependency order.  Types are cast to the Spark
result types (INTEGER ↔ int, BIGINT ↔ bigint, DOUBLE ↔ double).
"""

from __future__ import annotations

from tastemesh.functions.stopwords import default_stop_words

VIEWS: dict[str, tuple[list[str], str]] = {
    "review": ([], """
    SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                     CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS review_id,
           o_custkey AS user_id,
           l_partkey AS business_id,
           CAST(1 + (CAST(l_quantity AS INTEGER) - 1) % 5 AS DOUBLE) AS stars,
           CAST(NULL AS VARCHAR) AS text
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "review_raw": (["review"], """
    SELECT review_id, user_id, business_id,
           CASE WHEN business_id % 50 = 0 THEN '2018-01-02' ELSE CAST(stars AS VARCHAR) END AS stars,
           text
    FROM review"""),
    "user_friends": ([], """
    SELECT c_custkey AS user_id,
           CASE WHEN c_custkey % 10 = 9 THEN 'None'
                ELSE concat(CAST((c_custkey * 3 + 1) % cnt.n AS VARCHAR), ', ',
                            CAST((c_custkey * 7 + 5) % cnt.n AS VARCHAR)) END AS friends
    FROM customer, (SELECT count(*) AS n FROM customer) cnt"""),
    "users": (["user_friends", "review"], """
    SELECT c.c_custkey AS user_id, c.c_name AS name,
           CAST(coalesce(rc.review_count, 0) AS BIGINT) AS review_count,
           CAST(NULL AS VARCHAR) AS yelping_since,
           uf.friends,
           0 AS useful, 0 AS funny, 0 AS cool, 0 AS fans,
           CAST(NULL AS VARCHAR) AS elite
    FROM customer c
    JOIN user_friends uf ON uf.user_id = c.c_custkey
    LEFT JOIN (SELECT user_id, count(*) AS review_count FROM review GROUP BY user_id) rc
      ON rc.user_id = c.c_custkey"""),
    "business_details": ([], """
    SELECT p_partkey AS business_id, p_name AS name,
           CAST(NULL AS VARCHAR) AS neighborhood, CAST(NULL AS VARCHAR) AS address,
           p_brand AS city, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS postal_code,
           CAST(p_size AS DOUBLE) / CAST(1 AS DOUBLE) AS latitude,
           p_retailprice / CAST(100 AS DOUBLE) AS longitude,
           1 AS is_open,
           concat(p_type, ', ', replace(p_name, ' ', ', ')) AS categories
    FROM part"""),
    "business": (["business_details", "review"], """
    SELECT b.business_id, b.name, b.neighborhood, b.address, b.city, b.state, b.postal_code,
           b.latitude, b.longitude, s.stars,
           CAST(coalesce(s.review_count, 0) AS BIGINT) AS review_count,
           b.is_open, b.categories
    FROM business_details b
    LEFT JOIN (SELECT business_id, avg(stars) AS stars, count(*) AS review_count
               FROM review GROUP BY business_id) s ON s.business_id = b.business_id"""),
    "review_text": ([], """
    SELECT doc_id AS review_id,
           doc_id % ((SELECT count(*) FROM part) // 10) AS business_id,
           text
    FROM documents"""),
    "item_vectors": ([], """
    SELECT vec_id AS business_id, CAST(embedding AS DOUBLE[]) AS vector
    FROM embeddings WHERE vec_id IN (SELECT p_partkey FROM part)"""),
    "stop_words": ([], None),  # filled lazily below (needs the Spark jar list)
    # friend edges and levels
    "l1": (["user_friends"], """
    SELECT DISTINCT user_id, TRY_CAST(f AS BIGINT) AS friend
    FROM (SELECT user_id, trim(unnest(string_split(friends, ','))) AS f FROM user_friends)
    WHERE f <> 'None' AND f <> '' AND TRY_CAST(f AS BIGINT) IS NOT NULL"""),
    "l2": (["l1"], """
    SELECT user_id, friend FROM l1
    UNION
    SELECT a.user_id, b.friend FROM l1 a JOIN l1 b ON a.friend = b.user_id"""),
    "l3": (["l2"], """
    SELECT user_id, friend FROM l2
    UNION
    SELECT a.user_id, b.friend FROM l2 a JOIN l2 b ON a.friend = b.user_id"""),
}


def _stop_words_sql() -> str:
    vals = ", ".join("('" + w.replace("'", "''") + "')" for w in default_stop_words())
    return f"SELECT w FROM (VALUES {vals}) t(w)"


def _view_sql(name: str) -> str:
    if name == "stop_words":
        return _stop_words_sql()
    return VIEWS[name][1]


def with_views(names: list[str], body: str) -> str:
    """``WITH`` the needed views (transitively, dependency order) + body.

    The body may continue the WITH list by starting with ``, name AS (...)``.
    """
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({_view_sql(n)})" for n in order)
    body = body.strip()
    if not order:
        return "WITH " + body.lstrip(", ") if body.startswith(",") else body
    if body.startswith(","):
        return f"WITH {ctes}{body}"
    return f"WITH {ctes}\n{body}"

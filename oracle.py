"""DuckDB SQL for every registered query, written apart from the Spark code."""

from __future__ import annotations

from topicloom.functions.vocabulary import TOPICS
from topicloom.plans import catalog as c


def _hash60(text: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({text} AS VARCHAR)), 1, 15) AS BIGINT)"


def _hash(text: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({text} AS VARCHAR)), 1, 8) AS BIGINT)"


VOCABULARY = ", ".join(f"({i}, '{topic}')" for i, topic in enumerate(TOPICS))

# Tables of the event binding, by name.
EVENT_TABLES = {
    "raw": """
        SELECT event_id,
               CASE event_type WHEN 'click' THEN 'ForkEvent' WHEN 'view' THEN 'CommitCommentEvent'
                    ELSE event_type END AS type,
               event_id % 37 <> 0 AS has_actor,
               CASE WHEN event_id % 37 <> 0 AND event_id % 33 <> 0 THEN 'u' || user_id END AS login,
               CASE WHEN event_id % 35 <> 0
                    THEN 'r' || regexp_extract(props, '"k": *([0-9]+)', 1) END AS repo,
               CASE WHEN event_id % 31 <> 0
                    THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' END AS created_at
        FROM events""",
    "vocabulary": f"SELECT * FROM (VALUES {VOCABULARY}) AS v(topic_id, topic)",
    "clean": """
        SELECT event_id, login, repo, created_at FROM raw
        WHERE (type = 'ForkEvent' OR type = 'CommitCommentEvent')
          AND login IS NOT NULL AND repo IS NOT NULL AND created_at IS NOT NULL""",
    "coded": """
        SELECT event_id, login, repo, created_at FROM raw
        WHERE (type = 'ForkEvent' OR type = 'CommitCommentEvent' AND has_actor
               AND created_at IS NOT NULL AND repo IS NOT NULL)
          AND created_at IS NOT NULL""",
    "activity": """
        SELECT event_id, login AS usr, repo, CAST(substr(created_at, 1, 10) AS DATE) AS day
        FROM clean""",
    "activity_coded": """
        SELECT event_id, login AS usr, repo, CAST(substr(created_at, 1, 10) AS DATE) AS day
        FROM coded WHERE login IS NOT NULL""",
    "repo_topic": f"""
        SELECT r.repo, v.topic FROM (SELECT DISTINCT repo FROM activity) r
        JOIN vocabulary v ON v.topic_id = {_hash('r.repo')} % 177""",
    "repo_topic_coded": f"""
        SELECT e.repo, v.topic FROM coded e
        JOIN vocabulary v ON v.topic_id = {_hash('e.event_id')} % 177
        WHERE e.repo IS NOT NULL""",
    "bag": "SELECT a.usr, a.day, t.topic FROM activity a JOIN repo_topic t ON a.repo = t.repo",
    "counts": "SELECT usr, day, topic, count(*) AS n FROM bag GROUP BY usr, day, topic",
    "counts_coded": """
        SELECT a.usr, a.day, t.topic, CAST(sum(a.n * t.n) AS BIGINT) AS n
        FROM (SELECT usr, day, repo, count(*) AS n FROM activity_coded GROUP BY ALL) a
        JOIN (SELECT repo, topic, count(*) AS n FROM repo_topic_coded GROUP BY ALL) t
          ON a.repo = t.repo
        GROUP BY a.usr, a.day, t.topic""",
    "repo_counts": "SELECT usr, day, repo, count(*) AS n FROM activity GROUP BY usr, day, repo",
    "users": """
        SELECT usr, row_number() OVER (ORDER BY usr) - 1 AS idx
        FROM (SELECT DISTINCT usr FROM activity)""",
    "users_coded": """
        SELECT usr, row_number() OVER (ORDER BY usr) - 1 AS idx
        FROM (SELECT DISTINCT usr FROM activity_coded)""",
    "entries_coded": """
        SELECT usr, row_number() OVER (ORDER BY event_id) - 1 AS idx FROM activity_coded""",
}


def _edges(activity: str, index: str) -> str:
    return f"""
        SELECT d.event_id, d.usr, u.usr AS follow
        FROM (SELECT event_id, usr,
                     ({_hash60("'s' || event_id")}
                      + i * (1 + {_hash60("'p' || event_id")} % ((n - 1) // 4))) % n AS idx
              FROM {activity}, (SELECT count(*) AS n FROM {index}), range(5) r(i)) d
        JOIN {index} u ON u.idx = d.idx"""


EVENT_TABLES["edges"] = _edges("activity", "users")
EVENT_TABLES["edges_coded"] = _edges("activity_coded", "entries_coded")

# Tables of the order binding.
STAR_TABLES = {
    "activity": """
        SELECT o_custkey AS usr, l_partkey AS repo, CAST(o_orderdate AS DATE) AS day
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "bag": "SELECT usr, day, p_type AS topic FROM activity JOIN part ON repo = p_partkey",
    "brand_bag": "SELECT usr, day, p_brand AS topic FROM activity JOIN part ON repo = p_partkey",
    "counts": "SELECT usr, day, topic, count(*) AS n FROM bag GROUP BY usr, day, topic",
    "brand_counts": "SELECT usr, day, topic, count(*) AS n FROM brand_bag GROUP BY usr, day, topic",
    "repo_counts": "SELECT usr, day, repo, count(*) AS n FROM activity GROUP BY usr, day, repo",
    "star_orders": "SELECT o_orderkey AS event_id, o_custkey AS usr FROM orders",
    "users": """
        SELECT usr, row_number() OVER (ORDER BY usr) - 1 AS idx
        FROM (SELECT DISTINCT usr FROM star_orders)""",
    "edges": _edges("star_orders", "users"),
    "given": """
        SELECT o_custkey AS usr, l_suppkey AS follow
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "supplier_counts": """
        SELECT l_suppkey AS usr, CAST(l_shipdate AS DATE) AS day, p_type AS topic, count(*) AS n
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
}


def _with(tables: dict[str, str], query: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in tables.items()) + query


def _events(query: str) -> str:
    return _with(EVENT_TABLES, "\n" + query)


def _star(query: str) -> str:
    return _with(STAR_TABLES, "\n" + query)


def _lists(source: str, keys: str, item: str, name: str, max_items=10_000) -> str:
    """Lists in parts, cut by the items' places."""
    return f"""
        SELECT {keys}, CAST(place // {max_items} AS BIGINT) AS part,
               array_to_string(list({item} ORDER BY {item}), ',') AS {name},
               array_to_string(list(n ORDER BY {item}), ',') AS counts,
               CAST(sum(n) AS BIGINT) AS n
        FROM (SELECT {keys}, {item}, n,
                     row_number() OVER (PARTITION BY {keys} ORDER BY {item}) - 1 AS place
              FROM {source})
        GROUP BY {keys}, part"""


def _date(day) -> str:
    return f"DATE '{day.isoformat()}'"


def _within(start, end) -> str:
    return f"day > {_date(start)} AND day < {_date(end)}"


def _network(counts: str, edges: str, user: str, start, end) -> str:
    return f"""
        SELECT DISTINCT topic FROM {counts}
        WHERE {_within(start, end)} AND usr IN (SELECT follow FROM {edges} WHERE usr = {user})"""


def _first(counts: str, topic: str, start, end, network: str = "") -> str:
    return f"""
        SELECT usr, min(day) AS first_day FROM {counts}
        WHERE topic = '{topic}' AND {_within(start, end)} {network}
        GROUP BY usr ORDER BY first_day, usr LIMIT 5"""


def _nulls(column: str) -> str:
    return f"""
        SELECT '{column}' AS "column", count(*) FILTER (WHERE {column} IS NULL) AS nulls,
               count(*) AS "rows",
               CAST(count(*) FILTER (WHERE {column} IS NULL) AS DOUBLE) / count(*) AS share
        FROM (SELECT *, CAST(substr(created_at, 1, 10) AS DATE) AS day FROM raw)
        WHERE type IN ('ForkEvent', 'CommitCommentEvent')"""


DAY_LISTS = """
    SELECT 'usertopic' AS name, usr AS key, day, topic AS item, n FROM counts
    UNION ALL SELECT 'topicuser', topic, day, usr, n FROM counts
    UNION ALL SELECT 'userrepo', usr, day, repo, n FROM repo_counts"""

REJECTS = f"""
    SELECT * FROM (
      SELECT CASE WHEN event_id % 41 = 0 THEN 'broken' WHEN login IS NULL THEN 'no_user'
                  WHEN repo IS NULL THEN 'no_repo' WHEN created_at IS NULL THEN 'no_time'
                  WHEN NOT CAST(substr(created_at, 1, 10) AS DATE)
                       BETWEEN {_date(c.REJECT_DAYS[0])} AND {_date(c.REJECT_DAYS[1])}
                  THEN 'other_day' END AS outcome,
             CASE WHEN event_id % 41 <> 0 THEN event_id END AS event_id,
             CASE WHEN event_id % 41 = 0 THEN '{{"event_id":' || event_id END AS line
      FROM raw WHERE event_id % 41 = 0 OR type IN ('ForkEvent', 'CommitCommentEvent'))
    WHERE outcome IS NOT NULL"""


def oracle_queries() -> dict[str, str]:
    user = f"'{c.USER}'"
    topic_lists = _lists("counts", "usr, day", "topic", "topics")
    user_lists = _lists("counts", "topic, day", "usr", "users")
    follow_lists = _lists(
        "(SELECT usr, follow, count(*) AS n FROM edges GROUP BY usr, follow)",
        "usr",
        "follow",
        "follows",
    )
    repo_lists = _lists("repo_counts", "usr, day", "repo", "repos")
    network = f"AND usr IN (SELECT follow FROM edges WHERE usr = {user})"
    first = _first("counts", c.TOPIC, c.START, c.TOPIC_END)
    small = c.SMALL
    return {
        "load_events": _events("SELECT event_id, type, login, repo, created_at FROM raw"),
        "topic_vocabulary": _events(
            """SELECT CAST(v.topic_id AS BIGINT) AS topic_id, v.topic, count(t.repo) AS repos
               FROM vocabulary v LEFT JOIN repo_topic t ON t.topic = v.topic
               GROUP BY v.topic_id, v.topic"""
        ),
        "filter_event_types": _events(
            "SELECT event_id, type FROM raw WHERE type IN ('ForkEvent', 'CommitCommentEvent')"
        ),
        "clean_events": _events("SELECT * FROM clean"),
        "clean_events_sql": _events("SELECT * FROM clean"),
        "clean_events_coded": _events("SELECT * FROM coded"),
        "event_day": _events(
            "SELECT event_id, CAST(substr(created_at, 1, 10) AS DATE) AS day FROM raw"
        ),
        "null_profile": _events(
            " UNION ALL ".join(map(_nulls, ("login", "repo", "created_at", "day")))
        ),
        "user_repo": _events("SELECT usr, repo, day FROM activity"),
        "user_repo_coded": _events("SELECT usr, repo, day FROM activity_coded"),
        "user_repo_star": _star("SELECT usr, repo, day FROM activity"),
        "repo_topic": _events("SELECT * FROM repo_topic"),
        "repo_topic_coded": _events("SELECT * FROM repo_topic_coded"),
        "repo_topic_first": _events(
            "SELECT repo, min(topic) AS topic FROM repo_topic_coded GROUP BY repo"
        ),
        "user_topic_bag": _events("SELECT * FROM bag"),
        "user_topic_star": _star("SELECT * FROM brand_bag"),
        "user_topic_counts": _events("SELECT * FROM counts_coded"),
        "user_topic_counts_clean": _events("SELECT * FROM counts"),
        "user_topic_counts_star": _star("SELECT * FROM counts"),
        "user_topic_counts_joined": _star("SELECT * FROM brand_counts"),
        "user_topic_day": _events(topic_lists),
        "user_topic_day_coded": _events(_lists("counts_coded", "usr, day", "topic", "topics")),
        "user_topic_day_star": _star(topic_lists),
        "topic_user_day": _events(user_lists),
        "topic_user_day_parts": _events(_lists("counts", "topic, day", "usr", "users", **small)),
        "topic_user_day_coded": _events(_lists("counts_coded", "topic, day", "usr", "users")),
        "topic_user_day_star": _star(user_lists),
        "topic_user_day_brand_star": _star(_lists("brand_counts", "topic, day", "usr", "users")),
        "user_repo_day": _events(repo_lists),
        "user_repo_day_star": _star(repo_lists),
        "user_index": _events("SELECT * FROM users"),
        "follow_edges": _events("SELECT * FROM edges"),
        "follow_edges_coded": _events("SELECT * FROM edges_coded"),
        "user_user": _events(follow_lists),
        "user_user_coded": _events(follow_lists.replace("FROM edges", "FROM edges_coded")),
        "user_user_star": _star(follow_lists),
        "user_follows": _events(f"SELECT DISTINCT follow FROM edges WHERE usr = {user}"),
        "window_bounds": _events(
            """SELECT from_day, to_day, strftime(from_day, '%Y-%m-%d') AS from_text,
                      strftime(to_day, '%Y-%m-%d') AS to_text
               FROM (SELECT CAST(strptime(strftime(day, '%a %b %d %Y'), '%a %b %d %Y')
                                 AS DATE) AS from_day,
                            CAST(strptime(strftime(day + 7, '%a %b %d %Y'), '%a %b %d %Y')
                                 AS DATE) AS to_day
                     FROM (SELECT CAST(substr(created_at, 1, 10) AS DATE) AS day FROM raw))"""
        ),
        "network_topics": _events(_network("counts", "edges", user, c.START, c.END)),
        "network_topics_coded": _events(
            _network("counts_coded", "edges_coded", user, c.START, c.END)
        ),
        "network_topics_star": _star(
            _network("counts", "edges", str(c.STAR_USER), c.STAR_START, c.STAR_END)
        ),
        "network_topics_published": _events(_network("counts", "edges", user, c.START, c.END)),
        "topic_users": _events(first),
        "topic_users_star": _star(_first("counts", c.STAR_TOPIC, c.STAR_START, c.STAR_END)),
        "topic_users_published": _events(first),
        "network_topic_users": _events(_first("counts", c.TOPIC, c.START, c.TOPIC_END, network)),
        "topic_user_links": _events(
            f"SELECT usr, 'https://github.com/' || usr AS link FROM ({first})"
        ),
        "popular_users": _events(
            f"""SELECT follow, count(DISTINCT usr) AS n FROM edges
                GROUP BY follow HAVING count(DISTINCT usr) > {c.MORE_THAN}"""
        ),
        "ego_network": _events(f"SELECT DISTINCT usr, follow FROM edges WHERE usr = {user}"),
        "publish_user_user": _events(follow_lists),
        "publish_user_topic": _events(topic_lists),
        "publish_topic_user": _events(user_lists),
        "publish_user_user_late": _events(follow_lists),
        "publish_user_topic_emptied": _events(
            f"SELECT * FROM ({topic_lists}) WHERE NOT ({_within(c.START, c.END)})"
        ),
        "publish_user_repo": _events(repo_lists),
        "publish_user_user_compacted": _events(follow_lists),
        "event_rejects": _events(REJECTS),
        "daily_tables": _events(
            DAY_LISTS + """
               UNION ALL SELECT 'useruser', usr, NULL, follow, count(*) FROM edges GROUP BY usr, follow"""
        ),
        "tables_by_deltas": _events(DAY_LISTS),
        "load_events_stream": _events(
            "SELECT event_id, usr, repo, day FROM activity WHERE event_id % 2 = 0 OR event_id % 3 <> 2"
        ),
        "network_topics_requests": _events(
            """SELECT DISTINCT r.usr AS request, t.topic
               FROM (SELECT usr, min(day) AS start, min(day) + CAST(4 + count(*) % 23 AS INT) AS "end"
                     FROM activity GROUP BY usr) r
               JOIN (SELECT DISTINCT usr, follow FROM edges) e ON e.usr = r.usr
               JOIN counts t ON t.usr = e.follow AND t.day > r.start AND t.day < r."end\""""
        ),
        "topic_users_any_window": _events(
            """SELECT topic, start, "end", usr, first_day
               FROM (SELECT w.topic, w.start, w."end", t.usr, min(t.day) AS first_day,
                            row_number() OVER (PARTITION BY w.topic, w.start, w."end"
                                               ORDER BY min(t.day), t.usr) AS place
                     FROM (SELECT topic, CAST(a.day AS DATE) AS start, CAST(b.day AS DATE) AS "end"
                           FROM (SELECT topic, min(day) AS first, max(day) AS last FROM counts GROUP BY topic),
                                generate_series(first - 1, last, INTERVAL 1 DAY) a(day),
                                generate_series(first, last + 1, INTERVAL 1 DAY) b(day)
                           WHERE a.day < b.day) w
                     JOIN counts t ON t.topic = w.topic AND t.day > w.start AND t.day < w."end"
                     GROUP BY w.topic, w.start, w."end", t.usr)
               WHERE place <= 5"""
        ),
        "user_repos_published": _events(
            f"SELECT DISTINCT repo FROM activity WHERE usr = {user} AND {_within(c.START, c.TOPIC_END)}"
        ),
        "network_topic_users_published": _events(
            _first("counts", c.TOPIC, c.START, c.TOPIC_END, network)
        ),
        "user_user_given": _star(follow_lists.replace("FROM edges", "FROM given")),
        "popular_users_given": _star(
            f"""SELECT follow, count(DISTINCT usr) AS n FROM given
                GROUP BY follow HAVING count(DISTINCT usr) > {c.MORE_THAN}"""
        ),
        "popular_users_sketched": _star(
            "SELECT follow, count(DISTINCT usr) AS n, true AS near FROM given GROUP BY follow"
        ),
        "ego_network_hops": _events(
            f"""SELECT start, usr, min(distance)::INT AS distance FROM (
                  WITH RECURSIVE tenth AS (
                    SELECT DISTINCT usr, follow FROM edges WHERE event_id % 10 = 0
                  ), hop(start, usr, distance) AS (
                    SELECT DISTINCT usr, usr, 0 FROM tenth WHERE usr IN ({user}, 'u1')
                    UNION SELECT h.start, t.follow, h.distance + 1
                    FROM hop h JOIN tenth t ON t.usr = h.usr WHERE h.distance < {c.HOPS}
                  ) SELECT * FROM hop)
                GROUP BY start, usr"""
        ),
        "network_topics_given": _star(
            _network("supplier_counts", "given", str(c.STAR_USER), c.STAR_START, c.STAR_END)
        ),
        "network_topic_users_given": _star(
            _first(
                "supplier_counts", c.STAR_TOPIC, c.STAR_START, c.STAR_END,
                f"AND usr IN (SELECT follow FROM given WHERE usr = {c.STAR_USER})",
            )
        ),
    }

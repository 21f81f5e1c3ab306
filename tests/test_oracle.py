"""Every registered query against its SQL on DuckDB."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from oracle import oracle_queries
from topicloom.plans.catalog import catalog

SF_DIRS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DATE": "date",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
}
QUERIES = catalog()
ORACLE = oracle_queries()


# Rows at sf0.001 and sf0.01, from FIXTURES.md.
ROWS = {
    "clean_events": (360, 3_538),
    "clean_events_coded": (383, 3_761),
    "user_repo_coded": (368, 3_586),
    "user_repo_star": (6_000, 60_000),
    "repo_topic": (98, 100),
    "repo_topic_coded": (375, 3_712),
    "user_topic_bag": (360, 3_538),
    "user_topic_counts": (1_626, 111_549),
    "user_topic_counts_clean": (357, 3_515),
    "user_topic_counts_star": (4_383, 43_676),
    "user_topic_day": (248, 2_421),
    "user_topic_day_star": (1_472, 14_711),
    "topic_user_day": (323, 1_736),
    "topic_user_day_coded": (1_315, 5_310),
    "topic_user_day_star": (3_735, 13_765),
    "topic_user_day_brand_star": (5_226, 36_218),
    "user_index": (15, 150),
    "follow_edges": (1_800, 17_690),
    "follow_edges_coded": (1_840, 17_930),
    "topic_vocabulary": (177, 177),
}
# With 15 users nobody has that many followers, and nobody followed has the topic.
EMPTY = {("popular_users", "sf0.001"), ("network_topic_users", "sf0.001")}


@pytest.fixture(scope="module", params=SF_DIRS, ids=lambda p: Path(p).name)
def scale(request):
    con = duckdb.connect()
    for file in Path(request.param).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield request.param, con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, scale, name):
    sf_dir, con = scale
    result = QUERIES[name](spark, sf_dir)
    names = sorted(result.columns)
    rows = Counter(tuple(row[c] for c in names) for row in result.collect())
    table = con.execute(ORACLE[name])
    columns = [d[0] for d in table.description]
    types = {d[0]: TYPES[str(d[1])] for d in table.description}
    assert types == dict(result.dtypes)
    order = [columns.index(c) for c in names]
    assert rows == Counter(tuple(row[i] for i in order) for row in table.fetchall())
    if name in ROWS:
        assert rows.total() == ROWS[name][SF_DIRS.index(sf_dir)]
    assert rows or (name, Path(sf_dir).name) in EMPTY

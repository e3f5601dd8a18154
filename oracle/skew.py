"""A copy of a sample folder in which single keys hold a third of the rows.

    python -m oracle.skew <sample folder> <new folder>

One customer gets a third of the orders, one order a third of the lines, one user a third of the
events. The hot order belongs to a customer of nation 3 and lies in the reported window.
"""

from __future__ import annotations

import sys
from pathlib import Path

import pyarrow.parquet as pq

from oracle.compare import TABLES, database

HOT_LOAN = (
    "SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 3 "
    "AND o_orderdate BETWEEN DATE '2000-08-01' AND DATE '2001-04-01' AND o_orderstatus = 'P' "
    "AND o_orderpriority LIKE '5%' ORDER BY o_orderkey LIMIT 1"
)
CHANGED = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 AND o_orderkey <> ({loan}) "
    "THEN (SELECT min(c_custkey) FROM customer WHERE c_nationkey = 3) ELSE o_custkey END AS o_custkey) FROM orders",
    "lineitem": "SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN ({loan}) ELSE l_orderkey END AS l_orderkey) FROM lineitem",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 3 ELSE user_id END AS user_id) FROM events",
}


def skewed(source: str, target: str) -> str:
    con = database(source)
    Path(target).mkdir(parents=True, exist_ok=True)
    loan = con.execute(HOT_LOAN).fetchall()
    for name in TABLES:
        query = CHANGED.get(name, f"SELECT * FROM {name}").format(loan=loan[0][0])
        table = con.sql(query).to_arrow_table()
        pq.write_table(table, f"{target}/{name}.parquet")
    return target


if __name__ == "__main__":
    print(skewed(sys.argv[1], sys.argv[2]))

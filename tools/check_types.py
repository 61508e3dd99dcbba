"""Compare the column types of every query with its oracle (DuckDB types mapped to Spark names)."""
import sys
import os
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import duckdb
from sparkdeck.session import build_session
from sparkdeck.plans.registry import QUERIES, ORACLES, load_all
from sparkdeck.plans.bindings import TABLES
load_all()
spark = build_session()
d = sys.argv[1] if len(sys.argv) > 1 else '/root/testdata/sf0.001'
con = duckdb.connect()
for t in TABLES:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
M = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "FLOAT": "float",
     "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}
for k in sorted(ORACLES):
    st = dict(QUERIES[k](spark, d).dtypes)
    rel = con.sql(ORACLES[k])
    dt = {c: M.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    diff = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
    if diff:
        print(k, diff)
print("done")

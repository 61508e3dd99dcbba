"""The bindings of ``bindings.py`` restated in DuckDB SQL, for the oracle.

Each constant is a SELECT usable as a CTE body over the driver's views.
Keep them in step with ``bindings.py``: same key-modulus rules, same casts.
"""

# Java String.trim(): strip U+0000..U+0020 at both ends.
JTRIM = r"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def jtrim(x: str) -> str:
    return JTRIM.format(x=x)


PRICE = "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)"
TXN_BASE = f"concat_ws(',', o_custkey, o_orderkey, {PRICE}, strftime(o_orderdate, '%Y-%m-%d'))"

TXN_LINES = f"""
SELECT CASE WHEN o_orderkey % 13 = 0 THEN ' ' || chr(9) || ' '
            WHEN o_orderkey % 11 = 0 THEN concat_ws(',', o_custkey, o_orderkey, {PRICE}, '')
            WHEN o_orderkey % 7 = 0 THEN chr(9) || {TXN_BASE} || ' '
            ELSE {TXN_BASE} END AS value
FROM orders"""

# Parsed transaction lines (non-blank, exactly 4 fields after the JVM split).
TXN_PARSED = f"""
SELECT value,
       {jtrim("string_split(regexp_replace(" + jtrim("value") + ", ',+$', ''), ',')[1]")} AS "user",
       {jtrim("string_split(regexp_replace(" + jtrim("value") + ", ',+$', ''), ',')[2]")} AS item,
       {jtrim("string_split(regexp_replace(" + jtrim("value") + ", ',+$', ''), ',')[3]")} AS amount_text,
       {jtrim("string_split(regexp_replace(" + jtrim("value") + ", ',+$', ''), ',')[4]")} AS date
FROM ({TXN_LINES}) t
WHERE length({jtrim("value")}) > 0
  AND len(string_split(regexp_replace({jtrim("value")}, ',+$', ''), ',')) = 4"""

def _padded(line: str, key: str) -> str:
    return f"CASE WHEN {key} % 5 = 0 THEN {line} || ' ' ELSE {line} END"


_SET_A_LINE = "concat_ws(',', o_custkey, o_orderstatus)"
_SET_B_LINE = "concat_ws(',', o.o_custkey, l.l_linestatus)"
SET_A = f"SELECT {_padded(_SET_A_LINE, 'o_orderkey')} AS value FROM orders"
SET_B = (f"SELECT {_padded(_SET_B_LINE, 'l.l_orderkey')} AS value "
         "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey")

RATINGS = """
SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, CAST(l.l_quantity AS INTEGER) AS rating,
       l.l_orderkey, l.l_linenumber
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

USERS = """
SELECT c.c_custkey AS user_id, c.c_mktsegment AS segment, n.n_name AS nation
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""

# Same category list as bindings.CATEGORY_NAMES.
CATEGORY_NAMES = ["blue", "cold", "hot", "large", "new", "old", "red", "small",
                  "anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]

ITEM_CATEGORIES = ("SELECT p_partkey AS item_id, p_name AS title, list_filter(["
                   + ", ".join(f"CASE WHEN list_contains(string_split(p_name, ' '), '{n}') THEN '{n}' END"
                               for n in CATEGORY_NAMES)
                   + "], lambda x: x IS NOT NULL) AS categories FROM part")

EVENT_RATINGS = "SELECT event_id AS user_id, user_id AS item_id, value AS rating FROM events"
EVENT_TITLES = "SELECT s_suppkey AS item_id, s_name AS title FROM supplier"

MATRIX = "SELECT l_suppkey AS \"row\", l_partkey AS col, l_quantity AS value FROM lineitem"
VECTOR = "SELECT p_partkey AS col, CAST(p_size AS DOUBLE) AS value FROM part"

LOAN = """
SELECT o.o_orderkey AS id,
       CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE c.c_mktsegment END AS segment,
       o.o_orderstatus AS status,
       CASE WHEN o.o_orderkey % 29 = 0 THEN NULL ELSE o.o_orderpriority END AS priority,
       CASE WHEN o.o_orderkey % 17 = 0 THEN NULL
            WHEN o.o_orderkey % 19 = 0 THEN CAST('NaN' AS DOUBLE)
            ELSE o.o_totalprice END AS price,
       CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE c.c_acctbal END AS balance,
       CAST(o.o_orderstatus = 'F' AS INTEGER) AS label
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""

ADULT = """
SELECT o.o_orderkey AS id,
       CASE WHEN o.o_orderkey % 13 = 0 THEN ' ?' ELSE ' ' || c.c_mktsegment END AS segment,
       ' ' || o.o_orderstatus AS status,
       CASE WHEN o.o_orderkey % 31 = 0 THEN ' ?' ELSE ' ' || o.o_orderpriority END AS priority,
       o.o_totalprice AS price,
       c.c_acctbal AS balance,
       CAST(o.o_orderstatus = 'F' AS INTEGER) AS label
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""

REGRESSION = """
SELECT l_orderkey AS order_id, l_linenumber AS line_id, l_quantity, l_discount, l_tax,
       l_extendedprice AS label
FROM lineitem"""

SCORED_LABELS = """
SELECT l.doc_id, l.quality AS label, l.toxic AS prediction, d.n_chars / 1000.0 AS score
FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


def stable_hash(key_sql: str, seed: int) -> str:
    """Same number as ``features.stable_hash``."""
    return f"CAST(('0x' || substr(md5(concat_ws(':', {key_sql}, '{seed}')), 1, 8)) AS BIGINT)"


def train_test(key_sql: str, seed: int = 42, share: float = 0.7) -> str:
    """Same split as ``features.stable_split`` into train and test."""
    return f"CASE WHEN {stable_hash(key_sql, seed)} < {int(round(share * 2**32))} THEN 'train' ELSE 'test' END"


def stable_bucket(key_sql: str, seed: int, n: int) -> str:
    """Same bucket as ``features.stable_bucket``: md5 hex prefix -> int % n."""
    return f"({stable_hash(key_sql, seed)} % {n})"

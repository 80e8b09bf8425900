"""DuckDB views used by the oracle SQL (the same derivations as the Spark side)."""

from __future__ import annotations

VIEWS: dict[str, str] = {}

VIEWS["retail"] = """
SELECT CAST(l.l_orderkey AS VARCHAR) AS InvoiceNo,
       CAST(l.l_partkey AS VARCHAR) AS StockCode,
       p.p_name AS Description,
       CAST(l.l_quantity AS INTEGER) AS Quantity,
       o.o_orderdate AS InvoiceDate,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS UnitPrice,
       CAST(o.o_custkey AS INTEGER) AS CustomerID,
       n.n_name AS Country,
       (l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice) AS RowKey
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey"""

VIEWS["raw_retail"] = """
SELECT CAST(o.o_orderkey AS VARCHAR) AS InvoiceNo,
       CAST(l.l_partkey AS VARCHAR) AS StockCode,
       p.p_name AS Description,
       CAST(l.l_quantity AS INTEGER) AS Quantity,
       strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS InvoiceDate,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS UnitPrice,
       CAST(o.o_custkey AS DOUBLE) AS CustomerID,
       n.n_name AS Country
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey"""

VIEWS["clean"] = """
SELECT InvoiceNo, StockCode, Description, Quantity,
       CAST(InvoiceDate AS TIMESTAMP) AS InvoiceDate, UnitPrice,
       CAST(CustomerID AS INTEGER) AS CustomerID, Country
FROM (SELECT DISTINCT * FROM raw_retail
      WHERE InvoiceNo IS NOT NULL AND StockCode IS NOT NULL
        AND CustomerID IS NOT NULL AND InvoiceDate IS NOT NULL)
WHERE TRY_CAST(InvoiceDate AS TIMESTAMP) IS NOT NULL"""

VIEWS["rollup"] = """
SELECT InvoiceNo, StockCode,
       arg_min(Description, RowKey) FILTER (WHERE Description IS NOT NULL) AS Description,
       CAST(sum(Quantity) AS BIGINT) AS Quantity,
       max(UnitPrice) AS UnitPrice,
       arg_min(InvoiceDate, RowKey) AS h_date,
       arg_min(CustomerID, RowKey) AS h_cust,
       arg_min(Country, RowKey) AS h_country,
       min(RowKey) AS first_key
FROM retail GROUP BY InvoiceNo, StockCode"""

VIEWS["headers"] = """
SELECT InvoiceNo,
       arg_min(h_date, first_key) AS InvoiceDate,
       arg_min(h_cust, first_key) AS CustomerID,
       arg_min(h_country, first_key) AS Country,
       min(first_key) AS first_key,
       count(*) AS n_items
FROM rollup GROUP BY InvoiceNo"""

VIEWS["refs"] = """
SELECT CustomerID, arg_min(Country, first_key) AS Country FROM headers GROUP BY CustomerID"""

VIEWS["tx_items"] = """
SELECT r.InvoiceNo, h.InvoiceDate, h.CustomerID, r.StockCode, r.Description, r.Quantity, r.UnitPrice
FROM rollup r JOIN headers h ON r.InvoiceNo = h.InvoiceNo"""

VIEWS["cust_items"] = """
SELECT t.CustomerID, f.Country, t.InvoiceNo, t.InvoiceDate, t.StockCode, t.Description, t.Quantity, t.UnitPrice
FROM tx_items t JOIN refs f ON t.CustomerID = f.CustomerID"""

# dependencies, so a query names only what it reads
DEPS = {
    "retail": [], "raw_retail": [], "clean": ["raw_retail"],
    "rollup": ["retail"], "headers": ["rollup"], "refs": ["headers"],
    "tx_items": ["rollup", "headers"], "cust_items": ["tx_items", "refs"],
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first)."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]}\n)" for n in order)
    return f"WITH {ctes}\n{body.strip()}"


def register_view(name: str, sql: str, deps: list[str]) -> None:
    VIEWS[name] = sql
    DEPS[name] = deps

VIEWS["reviews"] = """
SELECT d.doc_id AS id, d.text, l.quality AS label FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
DEPS["reviews"] = []

# whitespace tokens: runs of whitespace collapse, no empty tokens
SQL_TOKENS = "CASE WHEN trim(regexp_replace({t}, '\\s+', ' ', 'g')) = '' THEN []::VARCHAR[] ELSE string_split(trim(regexp_replace({t}, '\\s+', ' ', 'g')), ' ') END"

VIEWS["sentences"] = """
SELECT CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'validation' ELSE 'test' END AS split,
       doc_id AS id, tokens, list_transform(tokens, lambda t: CAST(length(t) % 9 AS INTEGER)) AS ner_tags
FROM (SELECT doc_id, """ + SQL_TOKENS.format(t="text") + """ AS tokens FROM documents)"""
DEPS["sentences"] = []

SQL_TAG_NAMES = "['O', 'B-PER', 'I-PER', 'B-ORG', 'I-ORG', 'B-LOC', 'I-LOC', 'B-MISC', 'I-MISC']"

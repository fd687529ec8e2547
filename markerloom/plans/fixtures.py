"""Input tables of the operators' shapes, as SQL that Spark and DuckDB both run over the given tables.

``geno`` needs a spelling of its own per engine, for exclusive or. Tables that number their rows get
the number from ``ROW_NUMBER`` in DuckDB and from ``with_row_number`` in Spark, which sorts no table
in one task.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from markerloom.operators.numbering import with_row_number
from markerloom.plans.staging import shared

SQL = {
    "contig_length": """
SELECT CONCAT('ctg', CAST(p_partkey AS STRING)) AS contig, CAST(20000 + p_size * 1000 AS BIGINT) AS length FROM part
""",
    "map_markers": """
SELECT CONCAT('ctg', CAST(l_partkey AS STRING)) AS contig,
 1 + CAST(FLOOR(l_extendedprice * 100 + 0.5) AS BIGINT) % (20000 + p_size * 1000) AS pos,
 CASE WHEN l_tax > 0.07 THEN 1 + l_suppkey % 12 ELSE 1 + l_partkey % 12 END AS lg,
 ROUND((l_orderkey % 1000) * 0.1 + l_quantity * 0.001 + CASE WHEN l_orderkey % 1000 >= 985 THEN 30 ELSE 0 END, 3) AS male_cm,
 ROUND((l_orderkey % 1000) * 0.12 + l_discount + CASE WHEN l_orderkey % 1000 < 10 THEN 0 ELSE 20 END, 3) AS female_cm,
 l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax
 FROM lineitem JOIN part ON l_partkey = p_partkey
""",
    "paf": """
SELECT CONCAT('r', CAST(l_orderkey AS STRING)) AS qname, CAST(20000 AS BIGINT) AS qlen,
 CAST(l_linenumber * 1000 AS BIGINT) AS qstart, CAST(l_linenumber * 1000 + 500 + FLOOR(l_quantity) * 20 AS BIGINT) AS qend,
 CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, CONCAT('ctg', CAST(l_partkey % 40 AS STRING)) AS tname, CAST(60000 AS BIGINT) AS tlen,
 CAST(FLOOR(l_extendedprice) AS BIGINT) % 50000 AS tstart,
 CAST(FLOOR(l_extendedprice) AS BIGINT) % 50000 + CAST(500 + FLOOR(l_quantity) * 20 AS BIGINT) AS tend,
 CAST(FLOOR(l_discount * 600 + 0.5) AS BIGINT) AS mapq, CAST(FLOOR(l_extendedprice) AS BIGINT) % 2000 AS as_score FROM lineitem
""",
    "sam10x": """
SELECT CAST(64 + 16 * (event_id % 2) AS BIGINT) AS flag, CONCAT('ctg', CAST(event_id % 20 AS STRING)) AS contig,
 1 + CAST(FLOOR(value * 1000) AS BIGINT) AS pos,
 CASE WHEN event_id % 2 = 0 THEN CONCAT(CAST(14 + event_id % 12 AS STRING), 'S100M') ELSE CONCAT('100M', CAST(14 + event_id % 12 AS STRING), 'S') END AS cigar,
 TRANSLATE(MD5(CAST(user_id AS STRING)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq FROM events
""",
    "fasta_seq": """
SELECT CONCAT('ctg', CAST(doc_id AS STRING)) AS contig, REPEAT(TRANSLATE(MD5(CAST(doc_id AS STRING)), '0123456789abcdef', 'ACGTACGTACGTACGT'), CAST(1 + n_chars % 50 AS INT)) AS seq FROM documents
""",
    "la": """
SELECT contig, orig_start AS start_pos, orig_end AS end_pos, orientation, chr,
 orig_start, orig_start + 5 AS alt_start, orig_end, orig_end - 5 AS alt_end,
 CASE WHEN linked = 1 THEN COALESCE(LAG(contig) OVER (PARTITION BY chr ORDER BY contig, orig_start), 'null') ELSE 'null' END AS prev_contig,
 CASE WHEN linked = 1 THEN link_type ELSE 'null' END AS prev_type, CASE WHEN linked = 1 THEN prev_score ELSE 0 END AS prev_score,
 CASE WHEN linked = 1 THEN COALESCE(LEAD(contig) OVER (PARTITION BY chr ORDER BY contig, orig_start), 'null') ELSE 'null' END AS next_contig,
 CASE WHEN linked = 1 THEN link_type ELSE 'null' END AS next_type, CASE WHEN linked = 1 THEN next_score ELSE 0 END AS next_score, map_score
 FROM (SELECT CONCAT('ctg', CAST(l_partkey AS STRING)) AS contig,
  CASE WHEN l_tax > 0.07 THEN 1 + l_suppkey % 12 ELSE 1 + l_partkey % 12 END AS chr,
  CAST(1 + 10000 * (l_suppkey % 2) AS BIGINT) AS orig_start, CAST(10000 + 10000 * (l_suppkey % 2) AS BIGINT) AS orig_end,
  CASE MIN(l_orderkey) % 7 WHEN 0 THEN '+' WHEN 1 THEN '-' WHEN 2 THEN '++' WHEN 3 THEN '--' WHEN 4 THEN '+++' WHEN 5 THEN '---' ELSE '?' END AS orientation,
  CASE WHEN MIN(l_orderkey) % 3 = 0 THEN 1 ELSE 0 END AS linked,
  CASE MIN(l_orderkey) % 5 WHEN 0 THEN 'null' WHEN 1 THEN 'paf' ELSE 'chain' END AS link_type,
  CAST(MAX(FLOOR(l_quantity)) AS BIGINT) AS prev_score, CAST(MAX(FLOOR(l_discount * 100 + 0.5)) AS BIGINT) AS next_score,
  CAST(CASE WHEN MAX(l_tax) > 0.07 AND MIN(l_orderkey) % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS map_score
  FROM lineitem GROUP BY 1, 2, 3, 4) t
""",
    "recomb_log": """
SELECT event_type AS family, CONCAT('s', CAST(user_id AS STRING)) AS sample, 1 + event_id % 12 AS lg, COUNT(*) AS n_recomb FROM events GROUP BY event_type, user_id, 1 + event_id % 12
""",
    "lod_maps": """
SELECT l_linenumber + 9 AS lod, l_partkey AS marker_id, CASE WHEN l_quantity < 8 THEN 0 ELSE 1 + l_suppkey % (l_linenumber + 5) END AS lg FROM lineitem
""",
    "popmap": """
SELECT s_suppkey AS line, s_name AS sample, CASE WHEN s_suppkey <= 2 THEN 'parent' ELSE 'offspring' END AS pop FROM supplier
""",
    "bed": """
SELECT CONCAT('ctg', CAST(p_partkey AS STRING)) AS contig, '1' AS start_s, '9990-10010' AS end_s, '?' AS orientation, 1 + p_partkey % 12 AS chr FROM part
 UNION ALL SELECT CONCAT('ctg', CAST(p_partkey AS STRING)), '9991-10011', '20000*', '?', 1 + p_partkey % 12 FROM part
""",
    "chain": """
SELECT * FROM (SELECT CAST(FLOOR(l_extendedprice * 100 + 0.5) AS BIGINT) AS score,
 CONCAT('ctg', CAST(l_partkey AS STRING)) AS tname, CAST(20000 + p1.p_size * 1000 AS BIGINT) AS tsize, '+' AS tstrand,
 CAST(FLOOR(l_quantity) * 100 AS BIGINT) AS tstart, CAST(20000 + p1.p_size * 1000 - l_linenumber * 100 AS BIGINT) AS tend,
 CONCAT('ctg', CAST(p2.p_partkey AS STRING)) AS qname, CAST(20000 + p2.p_size * 1000 AS BIGINT) AS qsize,
 CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS qstrand, CAST((l_suppkey * 10) % 5000 AS BIGINT) AS qstart, CAST(20000 + p2.p_size * 1000 - l_linenumber * 200 AS BIGINT) AS qend
 FROM (SELECT *, (l_partkey * 7 + l_suppkey) % (SELECT COUNT(*) FROM part) AS partner FROM lineitem) l JOIN part p1 ON l_partkey = p1.p_partkey JOIN part p2 ON p2.p_partkey = partner) c WHERE tname <> qname
""",
    "chain_records": """
SELECT CAST(CAST(FLOOR(l_extendedprice * 100 + 0.5) AS BIGINT) / 1000 AS BIGINT) AS score,
 CONCAT('ctg', CAST(l_partkey AS STRING)) AS contig, CAST(20000 + p1.p_size * 1000 AS BIGINT) AS length, CONCAT('ctg', CAST(partner AS STRING)) AS partner
 FROM (SELECT l_extendedprice, l_partkey, (l_partkey * 7 + l_suppkey) % (SELECT COUNT(*) FROM part) AS partner FROM lineitem) l
 LEFT SEMI JOIN part p2 ON p2.p_partkey = partner JOIN part p1 ON l_partkey = p1.p_partkey WHERE l_partkey <> partner
""",
    "chain_claims": """
SELECT CAST(CAST(FLOOR(l_extendedprice * 100 + 0.5) AS BIGINT) / 1000 AS BIGINT) AS score, l_partkey, CAST(partner AS STRING) AS partner
 FROM (SELECT l_extendedprice, l_partkey, (l_partkey * 7 + l_suppkey) % (SELECT COUNT(*) FROM part) AS partner FROM lineitem) l WHERE l_partkey <> partner
""",
    "claimed": """
SELECT p_partkey AS l_partkey, CAST(p_partkey AS STRING) AS partner, CAST(20000 + p_size * 1000 AS BIGINT) AS length FROM part
""",
    "agp": """
SELECT CONCAT('LG', CAST(1 + p_partkey % 12 AS STRING)) AS obj, SUM(20000 + p_size * 1000) OVER w - (20000 + p_size * 1000) + 1 AS obj_beg, SUM(20000 + p_size * 1000) OVER w AS obj_end,
 CAST(ROW_NUMBER() OVER w AS BIGINT) AS part_no, 'W' AS ctype, CONCAT('ctg', CAST(p_partkey AS STRING)) AS contig, 1 AS contig_beg, 20000 + p_size * 1000 AS contig_end, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS orientation
 FROM part WHERE p_partkey % 10 <> 0 WINDOW w AS (PARTITION BY p_partkey % 12 ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""",
    "cuts": """
SELECT CONCAT('ctg', CAST(p_partkey AS STRING)) AS contig, CAST(4000 + 100 * p_size AS BIGINT) AS cut_lo, CAST(4050 + 100 * p_size AS BIGINT) AS cut_hi FROM part WHERE p_partkey % 4 = 0
""",
    "marey": """
SELECT CONCAT('LG', CAST(1 + l_suppkey % 12 AS STRING)) AS lg, CAST(l_orderkey * 1000 + l_partkey AS BIGINT) AS pos, 1 AS map_id, ROUND((CASE WHEN l_suppkey % 2 = 0 THEN l_orderkey ELSE 60000 - l_orderkey END) * CAST(0.01 AS DOUBLE), 3) AS male_cm, ROUND(l_orderkey * CAST(0.012 AS DOUBLE), 3) AS female_cm FROM lineitem
""",
    "axt": """
SELECT CONCAT('ctg', CAST(l_partkey % 40 AS STRING)) AS tname, CAST(FLOOR(l_quantity) * 1000 AS BIGINT) AS tstart, CAST(FLOOR(l_quantity) * 1000 + 900 AS BIGINT) AS tend,
 CONCAT('ctg', CAST(l_suppkey % 40 AS STRING)) AS qname, CAST(l_linenumber * 4000 AS BIGINT) AS qstart, CAST(l_linenumber * 4000 + 900 AS BIGINT) AS qend,
 CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, CAST(70 + FLOOR(l_discount * 100 + 0.5) * 3 AS BIGINT) AS identity FROM lineitem
""",
    "links": """
SELECT l_linenumber AS file_no, CONCAT('ctg', CAST(l_partkey AS STRING)) AS contig1, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS o1,
 CONCAT('ctg', CAST((l_partkey * 3 + l_suppkey) % (SELECT COUNT(*) FROM part) AS STRING)) AS contig2, CASE WHEN l_returnflag = 'A' THEN '+' ELSE '-' END AS o2,
 CAST(FLOOR(l_quantity) AS BIGINT) AS score FROM lineitem
""",
    "prox": """
SELECT CONCAT('ctg', CAST(user_id AS STRING)) AS contig1, CAST(1 + 10000 * (event_id % 7) AS BIGINT) AS pos1,
 CONCAT('ctg', CAST(user_id - user_id % 3 AS STRING)) AS contig2, CAST(1 + 10000 * (event_id % 4) AS BIGINT) AS pos2, CAST(COUNT(*) AS BIGINT) AS weight
 FROM events GROUP BY user_id, event_id % 7, event_id % 4
""",
    "ld_pairs": """
SELECT CONCAT('ctg', CAST(l_partkey AS STRING)) AS contig1, CAST(l_linenumber * 700 AS BIGINT) AS pos1,
 CONCAT('sup', CAST(l_suppkey AS STRING)) AS contig2, CAST(FLOOR(l_quantity) * 900 AS BIGINT) AS pos2, CAST(MAX(FLOOR(l_extendedprice)) AS BIGINT) AS weight FROM lineitem GROUP BY 1, 2, 3, 4
""",
    "agp_seq": """
SELECT CONCAT('LG', CAST(1 + p_partkey % 12 AS STRING)) AS obj, SUM(20000 + p_size * 1000) OVER w - (20000 + p_size * 1000) + 1 AS obj_beg, SUM(20000 + p_size * 1000) OVER w AS obj_end,
 CAST(ROW_NUMBER() OVER w AS BIGINT) AS part_no, 'W' AS ctype, CONCAT('ctg', CAST(p_partkey AS STRING)) AS contig, 1 AS contig_beg, 20000 + p_size * 1000 AS contig_end, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS orientation
 FROM part WHERE p_partkey % 10 <> 0 AND p_partkey IN (SELECT doc_id FROM documents) WINDOW w AS (PARTITION BY p_partkey % 12 ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""",
}
#: Tables that number their rows: the number's name, what orders them, columns that only order them.
_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity", "l_discount", "l_tax"]
NUMBERED: dict[str, tuple[str, list[str], list[str]]] = {
    "map_markers": ("marker_id", _LINE, _LINE),
    "la": ("line", ["chr", "contig", "orig_start"], []),
    "chain": ("id", ["-score", "tname", "qname", "tstart", "qstart", "qend", "tend", "qstrand"], []),
    "ld_pairs": ("line", ["-weight", "contig1", "pos1", "contig2", "pos2"], []),
}


def _key(name: str) -> str:
    """A contig's number out of its name."""
    return f"CAST(SUBSTRING({name}, 4) AS BIGINT) AS {name[0]}key"


#: Of numbered tables: what their columns follow from, the same order over that, and the columns.
_NARROW: dict[str, tuple[str, list[str], list[str]]] = {
    "map_markers": (
        f"SELECT {', '.join(_LINE)}, p_size FROM lineitem JOIN part ON l_partkey = p_partkey",
        _LINE,
        [c.strip() for c in SQL["map_markers"].split(" FROM lineitem")[0].strip().removeprefix("SELECT ").split(",\n")[:-1]],
    ),
    "chain": (
        f"SELECT score, {_key('tname')}, tsize, tstart, tend, {_key('qname')}, qsize, qstrand = '-' AS minus, qstart, qend FROM ({SQL['chain'].strip()}) named",
        ["-score", "CAST(tkey AS STRING)", "CAST(qkey AS STRING)", "tstart", "qstart", "qend", "tend", "minus"],
        ["score", "CONCAT('ctg', CAST(tkey AS STRING)) AS tname", "tsize", "'+' AS tstrand", "tstart", "tend", "CONCAT('ctg', CAST(qkey AS STRING)) AS qname", "qsize", "CASE WHEN minus THEN '-' ELSE '+' END AS qstrand", "qstart", "qend"],
    ),
}
GENO_DUCKDB = """
SELECT p_partkey AS marker_id, xor(CAST(((1 + p_partkey % 12) * 7919 * 104729 * 1299709) % 1099511627776 AS BIGINT), CAST(POWER(2, p_partkey % 40) AS BIGINT)) AS bits FROM part
"""
GENO_SPARK = """
SELECT p_partkey AS marker_id, CAST(((1 + p_partkey % 12) * 7919 * 104729 * 1299709) % 1099511627776 AS BIGINT) ^ CAST(POWER(2, p_partkey % 40) AS BIGINT) AS bits FROM part
"""

_TABLES = re.compile(r"\b(FROM|JOIN) (region|nation|customer|supplier|part|orders|lineitem|events|documents)\b")


def fixture(spark: SparkSession, sf_dir: str, name: str, numbered: bool = True, columns: tuple[str, ...] = ()) -> DataFrame:
    """A fixture over the tables of ``sf_dir``, read in place; no view is registered.

    Tables that number their rows are sorted once a session and folder; where ``_NARROW`` names them,
    only the columns that the others follow from are sorted and written, and those of ``columns``
    alone if some are named. Rows that are equal up to the last of these in the order differ in
    nothing that is asked for, so the order's columns behind it are left out, too. Without
    ``numbered`` nothing is sorted, and the number is left out.
    """
    read = lambda sql: spark.sql(_TABLES.sub(lambda m: f"{m[1]} parquet.`{sf_dir}/{m[2]}.parquet`", sql))
    sql = GENO_SPARK if name == "geno" else SQL[name]
    if name not in NUMBERED:
        return read(sql)
    number, order, extra = NUMBERED[name]
    if not numbered:
        return read(sql).drop(*extra)

    def make() -> DataFrame:
        if name not in _NARROW:
            return with_row_number(read(sql), order, number).drop(*extra)
        narrow, by, every = _NARROW[name]
        wanted = [c for c in every if not columns or c.rsplit(" ", 1)[-1] in columns]
        rows = read(narrow)
        used = [c for c in rows.columns if re.search(rf"\b{c}\b", " ".join(wanted))]
        if columns and set(by) <= set(rows.columns):
            by = by[: max((k for k, c in enumerate(by, 1) if c in used), default=0)] or by[:1]
        return with_row_number(rows, by, number, used, rows.count()).selectExpr(number, *wanted)

    return shared(spark, ("fixture", sf_dir, name, columns), make)


def _numbered_sql(name: str) -> str:
    number, order, extra = NUMBERED[name]
    rest = f"* EXCLUDE ({', '.join(extra)})" if extra else "*"
    return f"SELECT CAST(ROW_NUMBER() OVER (ORDER BY {', '.join(order)}) AS BIGINT) AS {number}, {rest} FROM ({SQL[name].strip()}) numbered"


def with_fixtures(names: str, query: str, recursive: bool = False) -> str:
    """``query`` for DuckDB with the named fixtures as leading common table expressions."""
    sql = SQL | {"geno": GENO_DUCKDB} | {n: _numbered_sql(n) for n in NUMBERED}
    head = ",\n".join(f"{n} AS ({sql[n].strip()})" for n in names.split())
    query = query.strip()
    rest = ", " + query[5:] if query.upper().startswith("WITH ") else " " + query
    return f"WITH {'RECURSIVE ' if recursive else ''}{head}{rest}"

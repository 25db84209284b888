"""Role views: bars, companies, ledgers and so on as subqueries over the given tables.

Texts are common SQL; `spark()` and `duck()` turn the few marks into each dialect.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.scratch import scratch_folder  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

ROLES = {
    "trades": """SELECT p_brand AS symbol, CAST(o_orderdate AS DATE) AS date, l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS quantity, l_returnflag AS flag,
      (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS seq
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "bars": """SELECT symbol, date, min_by(price, seq) AS open, max(price) AS high, min(price) AS low, max_by(price, seq) AS close, sum(quantity) AS volume,
      floor(CAST(sum(quantity) AS DOUBLE) * (max(price) + min(price)) / 2 + 0.5) AS turnover FROM trades GROUP BY symbol, date""",
    "coarse": "SELECT symbol, date, floor(log2(max_by(price, seq))) AS close, sum(CASE WHEN flag = 'N' THEN quantity ELSE 0 END) AS volume FROM trades GROUP BY symbol, date",
    "market": "SELECT date, round(sum(close), 4) AS level FROM bars GROUP BY date",
    "company": "SELECT s_suppkey AS id, s_name AS name, n_name AS sector, r_name AS country, s_acctbal AS cap FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "brand": "SELECT p_brand AS symbol, count(*) AS shares, min(p_type) AS sector FROM part GROUP BY p_brand",
    "returns": "SELECT symbol, date, close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS ret FROM bars",
    "market_returns": "SELECT date, level / lag(level) OVER (ORDER BY date) - 1 AS mret FROM market",
    "ledger": """SELECT user_id AS portfolio, event_id, ts, CASE event_type WHEN 'click' THEN 'DEPOSIT' WHEN 'view' THEN 'BUY' WHEN 'purchase' THEN 'SELL' ELSE 'WITHDRAW' END AS type, floor(abs(value)) + 1 AS amount FROM events""",
    "runs": "SELECT symbol, date, close, volume, sum(step) OVER (PARTITION BY symbol ORDER BY date) AS run FROM (SELECT *, CASE WHEN close = lag(close) OVER (PARTITION BY symbol ORDER BY date) THEN 0 ELSE 1 END AS step FROM coarse) x",
    "flagged": "SELECT symbol, date, close, volume, CASE WHEN volume <= 0 OR count(*) OVER (PARTITION BY symbol, run) > 3 THEN 1 ELSE 0 END AS illiquid FROM runs",
    "panel": "SELECT s.symbol, d.date, last_value(b.close) IGNORE NULLS OVER (PARTITION BY s.symbol ORDER BY d.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close FROM (SELECT DISTINCT date FROM bars) d CROSS JOIN (SELECT DISTINCT symbol FROM bars) s LEFT JOIN bars b ON b.symbol = s.symbol AND b.date = d.date",
    "caps": "SELECT p.symbol, p.date, p.close * r.shares AS value FROM panel p JOIN brand r ON p.symbol = r.symbol WHERE p.close IS NOT NULL",
    "totals": "SELECT date, sum(value) AS total FROM caps GROUP BY date",
    "drawdowns": "SELECT symbol, date, close / max(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS drawdown FROM bars",
    "two_source": "SELECT o_custkey AS ticker, year(o_orderdate) AS exercice, CASE WHEN o_orderkey % 2 = 0 THEN 'official' ELSE 'other' END AS src, o_orderkey AS seq, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS amount FROM orders",
    "quotes": "SELECT symbol, max(date) AS date, max_by(close, date) AS last FROM bars GROUP BY symbol",
}


def roles_of(sql: str, stored: tuple[str, ...] = ()) -> list[str]:
    """The roles that the text mentions, with theirs, in order of need; those that are stored count as tables."""
    out: list[str] = []

    def need(text: str) -> None:
        for name in ROLES:
            if name not in stored and re.search(rf"\b{name}\b", text) and name not in out:
                need(re.sub(rf"\b{name}\b", "", ROLES[name]))
                if name not in out:
                    out.append(name)

    need(sql)
    return out


def whole(sql: str, stored: tuple[str, ...] = ()) -> str:
    own = ",\n".join(f"{name} AS ({ROLES[name]})" for name in roles_of(sql, stored))
    rest = sql.strip()
    if rest.upper().startswith("WITH "):
        return f"WITH {own},\n{rest[5:]}" if own else rest
    return f"WITH {own}\n{rest}" if own else rest


def duck(sql: str) -> str:
    text = whole(sql).replace(") IGNORE NULLS OVER", " IGNORE NULLS) OVER")
    text = re.sub(r"DAYS\(([^;]*);([^)]*)\)", r"date_diff('day', \2, \1)", text)
    text = re.sub(r"REALL\(([^;]*);('[^']*');('[^']*')\)", r"regexp_replace(\1, \2, \3, 'g')", text)
    text = re.sub(r"explode\(sequence\((\d+), (\d+)\)\)", r"unnest(generate_series(\1, \2))", text)
    return re.sub(r"BACK\(([^;]*);([^)]*)\)", r"CAST(\1 - INTERVAL (\2) DAY AS DATE)", text)


def spark_text(sql: str, stored: tuple[str, ...] = ()) -> str:
    text = re.sub(r"DAYS\(([^;]*);([^)]*)\)", r"datediff(\1, \2)", whole(sql, stored))
    text = re.sub(r"REALL\(([^;]*);('[^']*');('[^']*')\)", r"regexp_replace(\1, \2, \3)", text)
    return re.sub(r"BACK\(([^;]*);([^)]*)\)", r"date_sub(\1, CAST(\2 AS INT))", text)


#: Roles that are written once, each made of the tables and of those before it.
STORED = ("bars", "coarse", "panel")
#: Folders and schemas of stored roles by name, application, input and the input's state.
_stored: dict[tuple, tuple] = {}


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored role of an input, written once for all queries of a session, and anew when the input's files have changed."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.sc().hadoopConfiguration()
    state = []
    for t in ("lineitem", "orders", "part"):
        at = path(f"{sf_dir}/{t}.parquet")
        fs = at.getFileSystem(conf)
        size = fs.getContentSummary(at)
        state.append((fs.getFileStatus(at).getModificationTime(), size.getLength(), size.getFileCount()))
    key = (name, spark.sparkContext.applicationId, sf_dir, *state)
    known, schema = _stored.get(key, (None, None))
    if known is None or not path(f"{known}/_SUCCESS").getFileSystem(conf).exists(path(f"{known}/_SUCCESS")):
        known = scratch_folder(spark, name)
        own = run(spark, sf_dir, f"SELECT * FROM {name}", STORED[: STORED.index(name)])
        own.write.parquet(known)
        schema = own.schema
        _stored[key] = known, schema
    return spark.read.schema(schema).parquet(known)


def stored_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "bars")


def filled(spark: SparkSession, sf_dir: str, text: str, **more: DataFrame) -> DataFrame:
    """The text's rows over the tables that it mentions; frames are passed by name, no views are left behind."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if re.search(rf"(FROM|JOIN)\s+{t}\b", text)} | more
    for t in used:
        text = re.sub(rf"((?:FROM|JOIN)\s+){t}\b", rf"\1{{{t}}}", text)
    return spark.sql(text, **used)


def run(spark: SparkSession, sf_dir: str, sql: str, roles: tuple[str, ...] = STORED) -> DataFrame:
    """The query over the tables and the stored ones of the roles, where it needs them."""
    text = spark_text(sql, roles)
    return filled(spark, sf_dir, text, **{r: stored(spark, sf_dir, r) for r in roles if re.search(rf"(FROM|JOIN)\s+{r}\b", text)})

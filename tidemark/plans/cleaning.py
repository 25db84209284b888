"""Text, date and number clean-up, page fields, upserts and increments."""

from __future__ import annotations

# Accented letters and their plain forms.
ACCENTED = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"
_GAPS = "[ \t\n\r]+"
_TITLE = "REALL(regexp_extract(html, '<title>([^<]*)</title>', 1);'" + _GAPS + "';' ')"
_HEAD = "REALL(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1);'" + _GAPS + "';' ')"
_UNESCAPED = "replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&nbsp;', ' '), '&amp;', '&')"
_TARGET = "SELECT o_custkey AS k, year(o_orderdate) AS y, o_totalprice AS v, o_orderkey AS seq, 0 AS given FROM orders WHERE o_orderpriority < '3'"
_SOURCE = "SELECT o_custkey AS k, year(o_orderdate) AS y, o_totalprice AS v, o_orderkey AS seq, 1 AS given FROM orders WHERE o_orderpriority >= '3'"

SQL = {
    "french_numbers": "SELECT id, t, TRY_CAST(replace(replace(replace(replace(t, ' ', ''), 'FCFA', ''), '%', ''), ',', '.') AS DOUBLE) AS value FROM (SELECT p_partkey AS id, concat(replace(CAST(CAST(p_retailprice AS DECIMAL(18, 2)) AS STRING), '.', ','), ' FCFA') AS t FROM part) x",
    "digits_only": "SELECT c_custkey AS id, TRY_CAST(nullif(REALL(c_name;'[^0-9]';''), '') AS BIGINT) AS digits FROM customer",
    "clean_spaces": f"SELECT doc_id, length(trim(REALL(coalesce(text, '');'{_GAPS}';' '))) AS n_chars, md5(trim(REALL(coalesce(text, '');'{_GAPS}';' '))) AS digest FROM documents",
    "plain_letters": f"SELECT doc_id, md5(translate(lower(replace(coalesce(text, ''), '’', '''')), '{ACCENTED}', '{PLAIN}')) AS digest FROM documents",
    "page_titles": f"SELECT page_id, {_UNESCAPED} AS title FROM (SELECT page_id, trim(coalesce(nullif({_TITLE}, ''), nullif({_HEAD}, ''))) AS t FROM pages) x WHERE t IS NOT NULL",
    "page_hosts": "SELECT regexp_extract(url, '://([^/:]+)', 1) AS host, count(*) AS n FROM pages GROUP BY regexp_extract(url, '://([^/:]+)', 1)",
    "page_sections": "SELECT page_id, nullif(regexp_extract(url, '://[^/]+/([^/?#]+)', 1), '') AS section FROM pages",
    "symbol_codes": "SELECT DISTINCT p_brand AS brand, translate(p_brand, '.-#', '___') AS code, lower(p_brand) AS key FROM part",
    "dividend_status": "SELECT o_orderkey AS id, CASE WHEN o_orderdate IS NULL THEN 'A préciser' WHEN CAST(o_orderdate AS DATE) < (SELECT BACK(max(CAST(o_orderdate AS DATE));90) FROM orders) THEN 'Passé' ELSE 'A venir' END AS statut FROM orders",
    "wide_to_long": "SELECT id, kind, value FROM (SELECT c_custkey AS id, 'balance' AS kind, c_acctbal AS value FROM customer UNION ALL SELECT c_custkey, 'nation', CAST(c_nationkey AS DOUBLE) FROM customer) x WHERE value IS NOT NULL",
    "upsert": f"SELECT k, y, v, seq, given FROM (SELECT *, row_number() OVER (PARTITION BY k, y ORDER BY given DESC, seq DESC) AS rn FROM ({_TARGET} UNION ALL {_SOURCE}) u) x WHERE rn = 1",
    "insert_only": f"SELECT k, y, v, seq FROM ({_TARGET}) t UNION ALL SELECT k, y, v, seq FROM (SELECT *, row_number() OVER (PARTITION BY k, y ORDER BY seq) AS rn FROM ({_SOURCE}) s WHERE NOT EXISTS (SELECT 1 FROM ({_TARGET}) o WHERE o.k = s.k AND o.y = s.y)) x WHERE rn = 1",
    "keyed_update": f"SELECT t.seq, t.k, coalesce(n.v, t.v) AS v FROM ({_TARGET}) t LEFT JOIN (SELECT k, y, max_by(v, seq) AS v FROM ({_SOURCE}) s GROUP BY k, y) n ON t.k = n.k AND t.y = n.y",
    "increment_position": "SELECT symbol, BACK(max(date);-1) AS since, count(*) AS n_rows FROM bars GROUP BY symbol",
    "rejected_rows": "SELECT n_name AS nation, sum(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END) AS loaded, sum(CASE WHEN c_acctbal >= 0 THEN 0 ELSE 1 END) AS skipped FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    "issuer_lookup": "SELECT c_custkey AS id, coalesce(s_name, concat('?', c_name)) AS issuer, CASE WHEN s_suppkey IS NULL THEN 0 ELSE 1 END AS known FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey",
    "signed_format": "SELECT c_custkey AS id, CASE WHEN c_acctbal > 0 THEN 'gain' WHEN c_acctbal < 0 THEN 'loss' ELSE 'flat' END AS class, concat(CASE WHEN c_acctbal > 0 THEN '+' ELSE '' END, replace(CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS STRING), '.', ','), ' %') AS shown FROM customer",
}

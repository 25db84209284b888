"""Queries over the given tables and the same results as DuckDB SQL."""

from __future__ import annotations

from functools import partial

from tidemark.plans import applied, cleaning, market, roles, strategy, studies, technical, uses

SQL = market.SQL | technical.SQL | strategy.SQL | cleaning.SQL


def _run(spark, sf_dir, sql):
    return roles.run(spark, sf_dir, sql)


QUERIES = {name: partial(_run, sql=sql) for name, sql in SQL.items()} | applied.QUERIES | studies.QUERIES | uses.QUERIES
ORACLE: dict[str, str] = {name: roles.duck(sql) for name, sql in SQL.items()} | applied.ORACLE | studies.ORACLE | uses.ORACLE

"""Registry of queries over the driver tables, each with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return add


def h(purpose: str, *keys: str, seed: int = 42) -> str:
    """SQL for the seeded 32-bit hash of the key expressions."""
    text = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST('0x' || substr(md5('{seed}:{purpose}:' || {text}), 1, 8) AS BIGINT)"


def u(purpose: str, *keys: str, seed: int = 42) -> str:
    return f"(CAST({h(purpose, *keys, seed=seed)} AS DOUBLE) / CAST(4294967296 AS DOUBLE))"


def randint(low, high, purpose: str, *keys: str, seed: int = 42) -> str:
    return f"({low} + (({h(purpose, *keys, seed=seed)} * (({high}) - ({low}) + 1)) >> 32))"


def zfill(expr: str, width: int) -> str:
    return f"lpad(CAST({expr} AS VARCHAR), CAST(greatest({width}, length(CAST({expr} AS VARCHAR))) AS INTEGER), '0')"


def pick(options, expr: str) -> str:
    listed = ", ".join(f"'{o}'" for o in options)
    return f"([{listed}])[{expr}]"


def letters(expr: str, chars: str) -> str:
    return f"(length({expr}) - length(translate({expr}, '{chars}', '')))"


def percent_2dp(part: str, whole: str) -> str:
    scaled = f"(({part}) * 10000)"
    floor = f"({scaled} // ({whole}))"
    rest = f"({scaled} % ({whole}))"
    up = f"(CASE WHEN {rest} * 2 > ({whole}) OR ({rest} * 2 = ({whole}) AND {floor} % 2 = 1) THEN 1 ELSE 0 END)"
    return f"(CAST({floor} + {up} AS DOUBLE) / 100)"


def stream_draw(stream: str, i: str) -> str:
    """SQL of draw number i of a stream."""
    x = f"(({stream} + {i} * 2654435761) & 4294967295)"
    return f"((xor({x}, {x} >> 16) * 73244475) & 4294967295)"

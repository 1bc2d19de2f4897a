"""Queries on the problems of texts in TESTDATA.md. SQL cannot merge byte pairs, so none has SQL: see tests/llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vintara.functions.common import table
from vintara.llm.encode import token_counts, token_ids
from vintara.llm.packing import pack
from vintara.llm.splitting import split_texts

#: Tokens in a container; tokens of a piece and of the overlap of two.
CAPACITY, LIMIT, OVERLAP = 8192, 512, 64


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return token_ids(table(spark, d, "documents"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return pack(token_counts(table(spark, d, "documents")), CAPACITY)


def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_texts(table(spark, d, "documents"), LIMIT, OVERLAP)


QUERIES = {f.__name__: f for f in (p7_ids, p8_containers, p9_pieces)}
ORACLE: dict[str, str] = {}

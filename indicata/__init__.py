"""Indicata: economic and public-health indicator tables on Spark DataFrames."""

from indicata.session import spark_session

__all__ = ["spark_session"]

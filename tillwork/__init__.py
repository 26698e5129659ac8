"""Retail sales analytics on Spark DataFrames."""

from tillwork.session import build_session

__all__ = ["build_session"]

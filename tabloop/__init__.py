"""Tabular classification data work as Spark jobs: prepare, rebalance, score, watch, relabel."""

from tabloop.config import ProblemConfig

__all__ = ["ProblemConfig"]

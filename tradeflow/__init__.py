"""tradeflow: Spark operators for tidy trade-statistics fact tables."""

__version__ = "0.1.0"

"""logledger: log reconciliation, catalogue id packing, grouped reports and a
collaborative-filtering recommender, written as DataFrame-to-DataFrame Spark jobs."""

__version__ = "0.1.0"

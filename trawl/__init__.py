"""trawl: batch text retrieval and ranking on Spark.

Documents are tokenised with column-expression analyzers, postings and
corpus statistics are stored as parquet tables, and whole topic sets are
ranked at once (TF-IDF, BM25, vector space, Dirichlet and Jelinek-Mercer
language models) with joins, aggregations and window top-k.
"""

from trawl.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]

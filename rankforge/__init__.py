"""Retrieval, ranking and relevance evaluation over tables of queries."""

import sys

from pyspark import cloudpickle

from rankforge.config import Bm25Params, FunnelParams
from rankforge.operators.batch import prepare_queries
from rankforge.operators.encode import ArrowEncoder, HashingEncoder, attach_embeddings, encode_queries
from rankforge.operators.fusion import fuse, hybrid_search, neural_search
from rankforge.operators.knn import cell_knn, exact_knn
from rankforge.operators.lexical import lexical_search
from rankforge.operators.metrics import evaluate_queries, evaluate_run
from rankforge.operators.rerank import ArrowScorer, OverlapScorer, rerank
from rankforge.plans.funnel import run as run_funnel
from rankforge.plans.index import Index, build_index, frames, open_index

__all__ = [
    "ArrowEncoder", "ArrowScorer", "Bm25Params", "FunnelParams", "HashingEncoder", "Index",
    "OverlapScorer", "attach_embeddings", "build_index", "cell_knn", "encode_queries",
    "evaluate_queries", "evaluate_run", "exact_knn", "frames", "fuse", "hybrid_search",
    "lexical_search", "neural_search", "open_index", "prepare_queries", "rerank", "run_funnel",
]

# The Arrow functions travel to the executors with the job, so that the package
# need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

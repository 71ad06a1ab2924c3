"""Parameters of the retrieval funnel and the fixed values it is defined by."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values -----------------------------------------------------------------
# Relevance labels: exact, substitute, complement, irrelevant.
LABEL_GRADES = {"E": 3, "S": 2, "C": 1, "I": 0}
LABEL_GAINS = {"E": 1.0, "S": 0.1, "C": 0.01, "I": 0.0}
RELEVANT_LABELS = ("E",)
# Searchable fields and the weight of a match in each.
FIELD_BOOSTS = {"title": 2.0, "features": 1.0, "text": 1.0}
UNJUDGED = "—unjudged—"
MIN_TITLE_CHARS = 3
KEYWORD_MAX_CHARS = 256
EMBED_DIM = 384
EMBED_MAX_TOKENS = 256

# Scores are compared at this many decimals, so that the order of a
# floating-point sum (which differs between runs of a distributed job) never
# decides a rank; the id decides instead.
SCORE_DECIMALS = 9

# Broadcast bounds -------------------------------------------------------------
# Largest number of (query, field, term) rows / shortlist rows sent to every
# executor, and the largest query matrix in bytes. Larger inputs are worked off
# in several chunks, each under the bound.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# Up to this many (query term, document) pairs a lexical search scores them all
# in one pass; beyond it makes three passes that skip the frequent terms.
MAX_SCORED_PAIRS = 2_000_000_000
# (query, document) pairs that one task sums up and ranks at a time, about.
MAX_TASK_PAIRS = 4_000_000
# A query batch of up to this many tokens names its terms to the scan of the
# postings; a shortlist of up to so many rows may name its ids to that of documents.
MAX_PUSHED_TERMS = 256
MAX_PUSHED_IDS = 10_000
# A shuffled term with more than one in so many (query, document) pairs is cut.
TERM_SPLITS = 1024


# Fixed values as well: the constants of the score and the depths of the funnel.


@dataclass(frozen=True)
class Bm25Params:
    """Okapi BM25 constants (Robertson & Zaragoza 2009)."""

    k1: float = 1.2
    b: float = 0.75


@dataclass(frozen=True)
class FunnelParams:
    """How many candidates survive each stage, per query."""

    candidates: int = 20
    after_trim: int = 12
    rerank_top_k: int = 10
    final_k: int = 5
    rrf_k: int = 60

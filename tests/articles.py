"""The small article corpus that the search and stage tests share."""

ARTICLES = [
    # id, title, features, text, kind, tags, year, (lat, lon)
    ("a1", "Tuning cache_lines in practice", "", "Raise cache_lines until recall stops growing.", "search", ["knn", "tuning"], 2023, (10.0, 20.0)),
    ("a2", "Out of memory while indexing", "", "The node raised disk_quota_exceeded and stopped.", "ops", ["memory"], 2024, (14.0, 26.0)),
    ("a3", "Ranking with two lists", "rank fusion", "Reciprocal ranks add up across lists and reward agreement.", "search", ["fusion"], 2025, (40.0, -70.0)),
    ("a4", "What reranking costs", "cost per pair", "Reranking reads query and document together, so its cost grows with the shortlist.", "ops", ["rerank", "cost"], 2025, (-20.0, 50.0)),
    ("a5", "Gardening in spring", "", "Plant tomatoes after the last frost and water them.", "garden", ["plants"], 2022, (60.0, 100.0)),
    ("a6", "Garden tools", "", "A spade, a rake and a hose cover most of the garden.", "garden", ["plants", "tools"], 2026, (-50.0, -60.0)),
    ("a7", "", "", "", "empty", [], 2026, (0.0, 0.0)),
    ("a8", "The garden the garden the garden", "", "the the the the", "garden", None, 2021, (18.0, 22.0)),
]
ARTICLE_TYPE = (
    "doc_id string, title string, features string, text string, kind string, tags array<string>, "
    "published_year int, location struct<lat:double,lon:double>"
)

import pytest
from pyspark.sql import functions as F

from rankforge.functions.text import embedding_text, join_items, keyword, parse_price, strip, tokens
from rankforge.sources import catalogue, judged


def one(spark, column, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("x"))).collect()]


def test_prices(spark):
    good = one(spark, parse_price, "13.99", "$13.99", "$$1,299.50", " 5 ", "$ 7", "-3", "1e2", ".5", "5.")
    assert good == [13.99, 13.99, 1299.5, 5.0, 7.0, -3.0, 100.0, 0.5, 5.0]
    junk = one(spark, parse_price, None, "None", "from 3", "", "1.0d", "5f", "nan", "inf", "1_000", "true", "1e999")
    assert junk == [None] * 11


def test_strip_is_python_strip(spark):
    values = ["  a\tb \n", "　x ", "\x1cq\x0b", "  ", "", "né ", "​z"]
    assert one(spark, strip, *values) == [v.strip() for v in values]


def test_tokens(spark):
    assert one(spark, tokens, "BPACT08WT, 429: cache_lines; naïve Über", None) == [
        ["bpact08wt", "429", "cache_lines", "naïve", "über"], []]


def test_embedding_text(spark):
    rows = spark.createDataFrame(
        [(1, " t ", "", " b\n"), (2, "t", None, None), (3, " ", "", None), (4, "a", "b", "c")],
        "i int, a string, b string, c string")
    got = rows.orderBy("i").select(embedding_text(F.col("a"), F.col("b"), F.col("c"))).collect()
    assert [r[0] for r in got] == ["t\n\nb", "t", "", "a\n\nb\n\nc"]


def test_items_and_keyword(spark):
    rows = spark.createDataFrame([(1, [" a ", "", None, "b"]), (2, None)], "i int, x array<string>")
    assert [r[0] for r in rows.orderBy("i").select(join_items(F.col("x"))).collect()] == ["a b", ""]
    assert one(spark, keyword, "x" * 256, "x" * 257) == ["x" * 256, None]


def test_jsonl_scan_keeps_nan_repeated_keys_and_replacement_characters(spark):
    lines = [
        '{"parent_asin":"a","price":NaN,"average_rating":4.5,"features":["x",null]}',
        '{"parent_asin":"b","title":"one","title":"two"}',
        '{"parent_asin":"c","title":"t\ufffdu"}',
        '{"parent_asin":"d"} {"x":1}',
        '{"parent_asin":"e","price":NaN} {"x":1}',
        '{"parent_asin":"f","price":NaN,"ti',
        '{"parent_asin":"g","price":-Infinity,"rating_number":"many"}',
        '{"parent_asin":"h","average_rating":NaN, bad}',
    ]
    table = spark.createDataFrame([(x,) for x in lines], "value string")
    rows = catalogue.parse_json_lines(table, catalogue.RAW_PRODUCT_FIELDS)
    found = {r["parent_asin"]: (r["title"], r["price"], r["average_rating"], r["features"], r["rating_number"])
             for r in rows.collect()}
    assert found == {
        "a": (None, "NaN", 4.5, ["x", None], None),
        "b": ("two", None, None, None, None),
        "c": ("t\ufffdu", None, None, None, None),
        "g": (None, "-Infinity", None, None, None),
    }


def test_jsonl_scan_skips_what_is_not_a_record(spark, tmp_path):
    lines = [
        b'{"parent_asin": "A1", "title": " caf\xff\xc3\xa9 ", "price": 13.99, "features": [" a ", ""], "rating_number": 3}',
        b'{"parent_asin": "A2", "title": "broken"',
        b"",
        b'{"parent_asin": "A3", "title": "ab"}',
        b'{"parent_asin": "", "title": "no id"}',
        b'["a", "list"]',
        b'{"parent_asin": "A4", "title": "two objects"} {"x": 1}',
        b'{"parent_asin": "A5", "title": "odd types", "average_rating": "x", "features": 7, "price": true}',
        b'{"parent_asin": "A6", "title": "dollars", "price": "$1,200", "categories": ["X", "Y"]}',
    ]
    path = tmp_path / "meta.jsonl"
    path.write_bytes(b"\n".join(lines) + b"\n")
    docs = {r["id"]: r for r in catalogue.clean_products(catalogue.read_raw_products(spark, str(path))).collect()}
    assert sorted(docs) == ["A1", "A5", "A6"]
    assert (docs["A1"]["title"], docs["A1"]["features"], docs["A1"]["price"]) == ("café", "a", 13.99)
    assert (docs["A5"]["average_rating"], docs["A5"]["features"], docs["A5"]["price"]) == (None, "", None)
    assert (docs["A6"]["price"], docs["A6"]["categories"], docs["A1"]["categories"]) == (1200.0, ["X", "Y"], [])
    assert (docs["A1"]["rating_number"], docs["A6"]["rating_number"]) == (3, 0)


def test_articles_round_trip(spark, tmp_path):
    raw = spark.createDataFrame(
        [(7, "Seven", "body", "cat", ["x"], 2024, 4.5, "Eastport")],
        "position int, title string, text string, category string, tags array<string>, "
        "published_year int, rating double, city string")
    built = catalogue.build_articles(raw, {"Westhill": (1.5, 2.5), "Eastport": (3.5, 4.5)})
    path = str(tmp_path / "articles")
    catalogue.save(built, path, fmt="json")
    (tmp_path / "articles" / "part-blank.json").write_text("\n\n")
    row = catalogue.read_articles(spark, path).collect()
    assert [(r.id, r.city, r.location.lat) for r in row] == [("doc-0007", "Eastport", 3.5)]


def test_save_keeps_what_is_there(spark, tmp_path):
    path = str(tmp_path / "corpus")
    for n, force in ((3, False), (5, False)):
        catalogue.save(spark.range(n), path, force)
    assert spark.read.parquet(path).count() == 3
    catalogue.save(spark.range(5), path, force=True)
    assert spark.read.parquet(path).count() == 5
    assert [r.id for r in catalogue.first_n(spark.range(9), 2).collect()] == [0, 1]
    assert catalogue.first_n(spark.range(9), None).count() == 9


def test_upsert_last_write_wins(spark):
    base = spark.createDataFrame([("a", 1), ("b", 1)], "id string, v int")
    batch = spark.createDataFrame(
        [("b", 2, 0), ("b", 3, 1), ("c", 4, 2), ("c", None, 3), ("", 9, 4), (None, 9, 5)], "id string, v int, pos int")
    assert {r.id: r.v for r in catalogue.upsert(base, batch).collect()} == {"a": 1, "b": 3, "c": None}
    counts = catalogue.upsert_outcome(base, batch).first().asDict()
    assert counts == {"succeeded": 4, "inserted": 1, "updated": 3, "rejected": 2}


def test_judged_products(spark):
    raw = spark.createDataFrame(
        [("p1", " One ", None, "x ", "  ", " red", "us"), ("p2", "ab", "", "", "b", "c", "us"), (None, "No id", "", "", "", "", "us"),
         ("", "Empty id", "", "", "", "", "us")],
        "product_id string, product_title string, product_description string, product_bullet_point string, "
        "product_brand string, product_color string, product_locale string")
    rows = [r.asDict() for r in judged.clean_judged_products(raw).collect()]
    assert rows == [{"id": "p1", "title": "One", "features": "x", "text": "", "brand": None, "color": "red", "locale": "us"}]
    numeric = raw.withColumn("product_brand", F.lit(5))
    assert judged.clean_judged_products(numeric).first().brand is None


EXAMPLES = "query_id int, query string, product_id string, product_locale string, esci_label string, small_version int, split string"


def test_examples_and_qrels(spark, tmp_path):
    rows = [(1, "q", "p1", "us", "E", 1, "test"), (1, "q", "p2", "us", "S", 0, "test"),
            (2, "r", "p1", "us", "I", 1, "train"), (3, "s", "p9", "es", "C", 1, "test")]
    path = str(tmp_path / "examples")
    spark.createDataFrame(rows, EXAMPLES).write.parquet(path)
    us = judged.read_examples(spark, path)
    assert {(r.query_id, r.product_id) for r in us.collect()} == {(1, "p1"), (2, "p1")}
    every = judged.read_examples(spark, path, small=False, splits=("test",))
    qrels = judged.build_qrels(every)
    assert {(r.doc_id, r.gain, r.graded) for r in qrels.collect()} == {("p1", 1.0, 3), ("p2", 0.1, 2)}
    assert judged.slice_statistics(us).first().asDict() == {"n_judgments": 2, "n_queries": 2, "n_products": 1}


def test_unknown_label_stops_the_job(spark):
    rows = spark.createDataFrame([(1, "q", "p", "us", "X", 1, "test")], EXAMPLES)
    with pytest.raises(Exception, match="unknown relevance label: X"):
        judged.build_qrels(rows).collect()
    assert judged.build_qrels(rows, unknown_is_null=True).first().graded is None


def test_nested_qrels_split_a_hot_query(spark):
    rows = spark.createDataFrame([(1, "first", f"d{i}", "E", i) for i in range(50)] + [(1, "later", "d0", "S", 99), (2, "two", "d1", "I", 5)],
                                 "query_id int, query string, doc_id string, label string, pos int")
    flat = judged.dedupe_qrels(rows, "pos")
    assert {r.query for r in flat.where("query_id = 1").collect()} == {"first"}
    assert flat.where("query_id = 1 and doc_id = 'd0'").first().label == "S"
    nested = judged.nest_qrels(flat, part_rows=10).collect()
    assert sum(len(r.judgments) for r in nested if r.query_id == 1) == 50
    assert len([r for r in nested if r.query_id == 1]) == 5
    assert [dict(r.judgments)["d1"].label for r in nested if r.query_id == 2] == ["I"]
    assert len(judged.nest_qrels(flat).collect()) == 2


def test_unknown_city_fails(spark):
    raw = spark.createDataFrame([(1, "t", "Nowhere")], "position int, title string, city string")
    with pytest.raises(Exception, match="no coordinates for city Nowhere"):
        catalogue.build_articles(raw, {"Eastport": (3.5, 4.5)}).collect()

"""Product catalogue and article corpus: scan, clean, write, reload."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rankforge.config import MIN_TITLE_CHARS
from rankforge.functions.text import join_items, parse_price, strip

_LOCATION = "struct<lat:double,lon:double>"
ARTICLE_SCHEMA = (
    "id string, title string, text string, category string, tags array<string>, "
    f"published_year int, rating double, city string, location {_LOCATION}"
)
# Raw catalogue fields and the types they are read as. Prices stay text: they
# come as numbers, as "$13.99" and as junk.
RAW_PRODUCT_FIELDS = {
    "parent_asin": "string",
    "title": "string",
    "features": "array<string>",
    "description": "array<string>",
    "main_category": "string",
    "categories": "array<string>",
    "store": "string",
    "price": "string",
    "average_rating": "double",
    "rating_number": "bigint",
}


def parse_json_lines(lines: DataFrame, fields: dict[str, str], line: str = "value") -> DataFrame:
    """One row per line that holds a JSON object; other lines are skipped.

    Invalid UTF-8 bytes are dropped from the line before it is parsed. A field
    whose value does not fit its type is null; the rest of the row is kept. Of a
    repeated key the last value counts, and ``NaN`` and ``Infinity`` are numbers.
    """
    raw = F.col(line)
    # a line that is valid keeps the replacement characters it came with
    clean = F.when(F.is_valid_utf8(raw), raw).otherwise(
        F.regexp_replace(F.make_valid_utf8(raw), "�", ""))
    is_object = F.regexp_like(clean, F.lit(r"^\s*\{[\s\S]*\}\s*$"))
    # the parser stops after the first value; inside brackets a second one on
    # the same line is an error, or shows up as a second element
    bracketed = F.concat(F.lit("["), clean, F.lit("]"))
    listed = F.try_parse_json(bracketed)
    # the strict parser refuses repeated keys and numbers like NaN; such lines
    # go to the lenient one
    schema = ", ".join(f"`{name}`: {kind}" for name, kind in fields.items())
    lenient = F.from_json(bracketed, f"array<struct<{schema}>>")
    # Exploding a one-element array keeps the filter from being pushed below the
    # parser, where it would parse every line once more per condition; the
    # lambda keeps the parser's result from being computed twice.
    parsed = lines.select(F.explode(F.transform(F.array(F.when(is_object, listed)), lambda v: F.struct(
        v.alias("v"), F.when(v.isNull() & is_object, lenient).alias("l")))).alias("_p"))
    one = F.col("_p.v").isNotNull() & F.try_variant_get("_p.v", "$[1]", "variant").isNull()
    other = F.col("_p.v").isNull() & (F.size("_p.l") == 1) & F.get("_p.l", F.lit(0)).isNotNull()

    def second(name: str, kind: str) -> Column:
        value = F.get("_p.l", F.lit(0))[name]
        # read as text, a number like NaN comes in quotes
        return F.regexp_replace(value, r'^"(NaN|-?Infinity)"$', "$1") if kind == "string" else value

    return parsed.where(one | other).select(*(
        F.when(F.col("_p.v").isNotNull(), F.try_variant_get("_p.v", f"$[0].{name}", kind))
        .otherwise(second(name, kind)).alias(name)
        for name, kind in fields.items()
    ))


def read_raw_products(spark: SparkSession, path: str) -> DataFrame:
    """Scan product metadata, one JSON object per line, tolerating bad lines."""
    return parse_json_lines(spark.read.text(path), RAW_PRODUCT_FIELDS)


def _present(c: Column) -> Column:
    return c.isNotNull() & (c.cast("string") != "")


def clean_products(raw: DataFrame, id_col: str = "parent_asin") -> DataFrame:
    """Raw metadata to index documents; rows without id or title are dropped."""
    cleaned = raw.withColumn("_title", strip(F.col("title")))
    return cleaned.where(
        (F.length("_title") >= MIN_TITLE_CHARS) & _present(F.col(id_col))
    ).select(
        F.col(id_col).alias("id"),
        F.col("_title").alias("title"),
        join_items(F.col("features")).alias("features"),
        join_items(F.col("description")).alias("text"),
        "main_category",
        F.coalesce("categories", F.array().cast("array<string>")).alias("categories"),
        "store",
        parse_price(F.col("price")).alias("price"),
        "average_rating",
        F.coalesce("rating_number", F.lit(0).cast("bigint")).alias("rating_number"),
    )


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """The small article corpus; blank lines are skipped by the JSON source."""
    return spark.read.schema(ARTICLE_SCHEMA).json(path)


def build_articles(raw: DataFrame, coordinates: dict[str, tuple[float, float]],
                   position: str = "position") -> DataFrame:
    """Number the articles (``doc-0007``) and look up their city's location.

    ``position`` is the 0-based place of the article; a file has no order in
    Spark. The city table is a literal of a few rows, so the join broadcasts.
    An article in a city without coordinates fails the job.
    """
    spark = raw.sparkSession
    places = spark.createDataFrame(
        [(city, lat, lon) for city, (lat, lon) in coordinates.items()],
        "city string, _lat double, _lon double",
    )
    unknown = F.raise_error(F.concat(F.lit("no coordinates for city "), F.coalesce("city", F.lit("null"))))
    located = raw.join(F.broadcast(places), "city", "left").withColumn(
        "_lat", F.when(F.col("_lat").isNull(), unknown.cast("double")).otherwise(F.col("_lat")))
    return located.select(
        F.format_string("doc-%04d", F.col(position)).alias("id"),
        *[c for c in raw.columns if c not in (position, "city")],
        "city",
        F.struct(F.col("_lat").alias("lat"), F.col("_lon").alias("lon")).alias("location"),
    )


def first_n(df: DataFrame, n: int | None, by: str = "id") -> DataFrame:
    """The first ``n`` rows by id; all of them when ``n`` is None."""
    if n is None:
        return df
    if n < 1:
        raise ValueError("n must be at least 1")
    return df.orderBy(by).limit(n)


def save(df: DataFrame, path: str, force: bool = False, fmt: str = "parquet",
         partition_by: str | None = None, sort_by: str | None = None) -> None:
    """Write a prepared corpus; an existing one is kept unless ``force``.

    With ``partition_by`` a scan for one of its values opens that folder alone;
    with ``sort_by`` as well, files hold ranges, so that a scan for some of its
    values skips files and pages. A large partition is spread over several files.
    """
    keys = [c for c in (partition_by, sort_by) if c]
    if sort_by:
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = df.write.mode("overwrite" if force else "ignore").format(fmt)
    (writer.partitionBy(partition_by) if partition_by else writer).save(path)


def save_checked(df: DataFrame, path: str, reasons: Mapping[str, Column]) -> dict[str, int]:
    """Write ``df`` and count, in the same pass, what is kept and what each of
    ``reasons`` rejects; the first that holds counts.

    Rejected rows are kept apart with their reason, in the column ``rejected``;
    see :func:`kept` and :func:`rejected`. The result has a count under ``kept``
    and under each reason.
    """
    reason = F.lit(None).cast("string")
    for name, holds in reversed(list(reasons.items())):
        reason = F.when(F.coalesce(holds, F.lit(False)), F.lit(name)).otherwise(reason)
    counts = Observation()
    named = {f"n{i}": name for i, name in enumerate(reasons)}
    marked = df.withColumn("rejected", reason).observe(
        counts, F.count_if(F.col("rejected").isNull()).alias("kept"),
        *(F.count_if(F.col("rejected") == name).alias(key) for key, name in named.items()))
    marked.write.partitionBy("rejected").parquet(path)
    return {named.get(key, key): n for key, n in counts.get.items()}


def kept(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("rejected").isNull()).drop("rejected")


def rejected(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("rejected").isNotNull())


def doc_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_docs"))


def corpus_profile(docs: DataFrame, words: Column, *, has: dict[str, Column],
                   by: list[str] | None = None) -> DataFrame:
    """Share of documents for which each ``has`` condition holds, and the median
    number of words. The median runs over (words, count) pairs, which are few
    however many documents there are."""
    by = by or []
    flags = [F.sum(c.cast("int")).alias(f"_{name}") for name, c in has.items()]
    counted = docs.groupBy(*by, words.alias("_words")).agg(F.count(F.lit(1)).alias("_n"), *flags)
    return counted.groupBy(*by).agg(
        F.sum("_n").alias("n_docs"),
        *(
            F.round(F.sum(f"_{name}") / F.sum("_n"), 6).alias(f"share_{name}")
            for name in has
        ),
        F.percentile("_words", 0.5, F.col("_n")).alias("median_words"),
    )


def latest(rows: DataFrame, key: str = "id", order: Sequence[str] = ("pos",)) -> DataFrame:
    """The row with the highest ``order`` of every key; rows without a key are
    left out and the order columns dropped.

    ``max_by`` keeps one row per key already on the map side, so a key that is
    written over and over never gathers in one task.
    """
    columns = [c for c in rows.columns if c != key and c not in order]
    newest = (
        rows.where(_present(F.col(key)))
        .select(key, F.struct(*order).alias("_order"), F.struct(*columns).alias("_row"))
        .groupBy(key).agg(F.max_by("_row", "_order").alias("_row"))
    )
    return newest.select(key, *(F.col(f"_row.{c}").alias(c) for c in columns))


def upsert(base: DataFrame, batch: DataFrame, key: str = "id", order: str = "pos") -> DataFrame:
    """Rows of ``batch`` replace rows of ``base`` with the same key; within the
    batch the highest ``order`` wins."""
    both = base.select("*", F.lit(0).alias("_batch"), F.lit(0).cast("bigint").alias("_pos")).unionByName(
        batch.select(
            *base.columns, F.lit(1).alias("_batch"), F.col(order).cast("bigint").alias("_pos")
        )
    )
    return latest(both, key, ("_batch", "_pos")).select(*base.columns)


def upsert_outcome(base: DataFrame, batch: DataFrame, key: str = "id") -> DataFrame:
    """How many rows of a batch insert a document, update one, or are rejected
    for want of an id. A repeated id counts as one insert, then updates."""
    keys = base.select(key).withColumn("_known", F.lit(1)).dropDuplicates([key])
    ok = _present(F.col(key))
    per_key = (
        batch.where(ok).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        .join(keys, key, "left")
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("succeeded"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), 1)), F.lit(0)).alias("inserted"),
        )
    )
    rejected = batch.agg(F.count_if(~F.coalesce(ok, F.lit(False))).alias("rejected"))
    # two one-row tables side by side
    return per_key.unionByName(rejected, allowMissingColumns=True).agg(
        F.max("succeeded").alias("succeeded"),
        F.max("inserted").alias("inserted"),
        (F.max("succeeded") - F.max("inserted")).alias("updated"),
        F.max("rejected").alias("rejected"),
    )


__all__ = [
    "ARTICLE_SCHEMA", "RAW_PRODUCT_FIELDS", "build_articles", "clean_products",
    "corpus_profile", "doc_count", "first_n", "latest", "parse_json_lines", "read_articles",
    "kept", "read_raw_products", "rejected", "save", "save_checked", "upsert", "upsert_outcome",
]

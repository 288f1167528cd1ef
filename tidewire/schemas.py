"""Input and table schemas, and checks against them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT, WHOLE, REAL, FLAG, WHEN = (
    T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.TimestampType())
TEXT_MAP = T.MapType(TEXT, TEXT)

CONCEPT = _struct(uri=TEXT, type=TEXT, score=WHOLE, label=TEXT_MAP)

LANDED_ARTICLE = _struct(
    uri=TEXT, title=TEXT, body=TEXT, url=TEXT, dateTimePub=TEXT, sentiment=REAL,
    source=_struct(uri=TEXT, ranking=_struct(importanceRank=WHOLE)),
    eventUri=TEXT, totalArticleCountInEvent=WHOLE, concepts=T.ArrayType(CONCEPT),
)

LANDED_EVENT = _struct(
    uri=TEXT, lang=TEXT, concepts=T.ArrayType(CONCEPT), eventDate=TEXT, totalArticleCount=WHOLE, title=TEXT_MAP,
    summary=TEXT_MAP, location=_struct(type=TEXT, label=TEXT_MAP),
    categories=T.ArrayType(_struct(uri=TEXT, label=TEXT, wgt=WHOLE)),
    articleCounts=T.MapType(TEXT, WHOLE), sentiment=REAL, wgt=T.LongType(), relevance=WHOLE,
    sourceUris=T.ArrayType(TEXT),
)

TREND_ITEM = _struct(uri=TEXT, type=TEXT, trendingScore=_struct(news=_struct(score=REAL)))
LANDED_TRENDING = _struct(
    uri=TEXT, type=TEXT, trendingScore=_struct(news=_struct(score=REAL)),
    trendingConcepts=T.ArrayType(TREND_ITEM), results=T.ArrayType(TREND_ITEM),
)

ARTICLES = _struct(
    id=TEXT, title=TEXT, body=TEXT, url=TEXT, published_at=WHEN, collected_at=WHEN, sentiment=REAL,
    source_name=TEXT, source_importance=WHOLE, event_uri=TEXT, total_articles_in_event=WHOLE,
    concepts=T.ArrayType(CONCEPT), published_at_imputed=FLAG, logical_date=T.DateType(),
)

ARTICLE_SCORES = _struct(
    id=TEXT, event_uri=TEXT, source_name=TEXT, published_at=WHEN, collected_at=WHEN, sentiment=REAL,
    source_importance=WHOLE, total_articles_in_event=WHOLE, entity_hot_score=REAL, hot_score_v2=REAL,
    rep_score_v2=REAL, sent_score_v2=REAL, hot_norm_raw=REAL, hot_norm=REAL, rep_norm=REAL, sent_norm=REAL,
    concept_hot_norm=REAL, freshness_score=REAL, final_score_v2=REAL, is_routine_topic=FLAG,
    is_category_topic=FLAG, is_breaking_news=FLAG, is_suppressed=FLAG, is_downweighted=FLAG, scored_as_of=WHEN,
)

TRENDING = _struct(uri=TEXT, score=REAL, updated_at=WHEN)

# Names of field metadata: Parquet files keep them, Spark fills columns that a file lacks with the second.
DEFAULT, FILLED, REQUIRED = "CURRENT_DEFAULT", "EXISTS_DEFAULT", "required"


def declared(schema: T.StructType, defaults: Mapping[str, str], required: Iterable[str] = ()) -> T.StructType:
    """The schema with defaults (as SQL literals) and the fields that hold no NULL, as field metadata."""
    needed = set(required)
    return T.StructType([
        T.StructField(f.name, f.dataType, True, {
            **f.metadata, **({DEFAULT: defaults[f.name], FILLED: defaults[f.name]} if f.name in defaults else {}),
            **({REQUIRED: True} if f.name in needed else {})})
        for f in schema.fields])


def with_declarations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the metadata of the schema on its columns of the same name, so that files keep it."""
    kept = {f.name: f.metadata for f in schema.fields if f.metadata}
    return df.select(*[F.col(c).alias(c, metadata=kept[c]) if c in kept else F.col(c) for c in df.columns])


def read_declared(spark: SparkSession, path: str, expected: T.StructType | None = None) -> DataFrame:
    """A table as its files declare it: a file without a column takes the default that other files store for it.

    Columns that no file has are added with the default of ``expected``. NULLs in files stay NULL.
    """
    found = spark.read.option("mergeSchema", "true").parquet(path).schema
    names = set(found.fieldNames())
    more = [f for f in (expected.fields if expected else []) if f.name not in names]
    return spark.read.schema(T.StructType([*found.fields, *more])).parquet(path)


FLAG_DEFAULTS = {
    name: False for name in (
        "is_routine_topic", "is_category_topic", "is_breaking_news", "is_suppressed", "is_downweighted")
}


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


DECLARED_SCORES = declared(
    ARTICLE_SCORES, {name: str(value).lower() for name, value in FLAG_DEFAULTS.items()}, ["id", *FLAG_DEFAULTS])


def schema_differences(df: DataFrame, expected: T.StructType) -> list[str]:
    """Expected columns that are absent, of another type, or declared otherwise, as readable lines."""
    actual = {f.name: f for f in df.schema.fields}
    lines = []
    for field in expected.fields:
        if field.name not in actual:
            lines.append(f"{field.name}: missing")
            continue
        found = actual[field.name]
        if found.dataType != field.dataType:
            lines.append(f"{field.name}: {found.dataType.simpleString()} instead of {field.dataType.simpleString()}")
        for name, said in ((DEFAULT, "default"), (REQUIRED, "required")):
            wanted, got = field.metadata.get(name), found.metadata.get(name)
            if name == REQUIRED:
                wanted, got = bool(wanted), bool(got)
            if field.metadata and wanted != got:
                lines.append(f"{field.name}: {said} {got} instead of {wanted}")
    return lines


def column_check(df: DataFrame, names: Iterable[str] = tuple(FLAG_DEFAULTS)) -> DataFrame:
    """One row per wanted column: its type, default and nullability as the table declares them, its NULLs and values."""
    fields = {f.name: f for f in df.schema.fields}
    wanted = sorted(names)
    counts = df.agg(
        F.count("*").alias("total"),
        *[F.count(n).alias(f"n_{n}") for n in wanted if n in fields],
    )
    rows = [
        F.struct(
            F.lit(n).alias("column_name"), F.lit(fields[n].dataType.simpleString() if n in fields else None).alias("data_type"),
            F.lit(fields[n].metadata.get(DEFAULT) if n in fields else None).alias("column_default"),
            F.lit(not fields[n].metadata.get(REQUIRED, False) if n in fields else None).cast("boolean").alias("is_nullable"),
            (F.col(f"n_{n}") if n in fields else F.lit(0).cast("long")).alias("n_values"),
            (F.col("total") - (F.col(f"n_{n}") if n in fields else F.lit(0))).alias("n_null"),
        )
        for n in wanted
    ]
    return counts.select(F.inline(F.array(*rows)))

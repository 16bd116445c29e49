"""Code quality pipeline: cleaning, exact deduplication, metrics, rule labels, outlier marks and the two result sets.

Defined results: null and empty contents are dropped first, white-space-only ones stay; of equal contents the row with the
smallest order key stays; a row's good/bad fate never depends on partitioning; good and bad are disjoint and together are all
rows that pass the length filter; an empty table gives empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import pyast, textfn
from corpusmill.operators.joins import anti_join_in_place, skew_safe_join
from corpusmill.operators.outliers import isolation_forest, local_outlier_factor
from corpusmill.runtime import materialize
from corpusmill.sources.jsonl import documents
from corpusmill.sources.sinks import write_jsonl

FEATURES = ("content_length", "cyclomatic_complexity", "maintainability_index", "comment_ratio")


@dataclass(frozen=True)
class PipelineConfig:
    """Parameters of the pipeline. ``load_limit`` 0 means all rows; ``legacy_cc`` makes the complexity rule never fire."""

    source: str = ""
    good_path: str = "train.jsonl"
    bad_path: str = "bad_data.jsonl"
    min_content_length: int = 10
    load_limit: int = 0
    max_complexity: float = 50.0
    min_maintainability: float = 20.0
    contamination: float = 0.1
    neighbours: int = 20
    seed: int = 42
    legacy_cc: bool = False

    def __post_init__(self) -> None:
        if self.min_content_length < 0 or self.load_limit < 0 or not 0 < self.contamination < 0.5:
            raise ValueError("invalid pipeline configuration")

    @classmethod
    def from_mapping(cls, values: dict[str, str]) -> PipelineConfig:
        """From environment-like settings; a missing source is an error, everything else has a default."""
        if not values.get("SOURCE"):
            raise ValueError("SOURCE is required")
        return cls(
            source=values["SOURCE"],
            good_path=values.get("OUTPUT_GOOD_JSONL_FILE", cls.good_path),
            bad_path=values.get("OUTPUT_BAD_JSONL_FILE", cls.bad_path),
            min_content_length=int(values.get("MIN_CONTENT_LENGTH", cls.min_content_length)),
            load_limit=int(values.get("DATA_LOAD_LIMIT", cls.load_limit)),
        )


def drop_empty(df: DataFrame, content: str = "content") -> DataFrame:
    """Rows with content, with its length in characters."""
    if content not in df.columns:
        raise KeyError(content)
    return df.where(F.col(content).isNotNull() & (F.length(content) > 0)).withColumn("original_content_length", F.length(content))


def first_of_each(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the smallest ``order``, a unique key, among rows equal in ``keys`` (nulls are equal to nulls).

    Only a digest of the keys and the order key travel. Copies combine per task before the shuffle and hot ones are joined in
    place, so a text that a third of all rows repeat gathers nowhere; rows that are no copy of another never move.
    """
    digest = F.unhex(F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256))
    narrow = materialize(df.select(digest.alias("__digest"), F.col(order).alias("__order")), "digests")
    several = narrow.groupBy("__digest").agg(F.min("__order").alias("__first"), F.count("*").alias("__n")).where("__n > 1")
    several = materialize(several.select("__digest", "__first"), "several")
    copies = skew_safe_join(narrow, several, "__digest").where(F.col("__order") != F.col("__first"))
    return anti_join_in_place(df, materialize(copies.select(F.col("__order").alias(order)), "copies"), order)


def text_metrics(df: DataFrame, content: str = "content") -> DataFrame:
    """Native metrics: comment-free text and its length, share of special characters, line statistics."""
    clean = textfn.remove_comments(content)
    lines = textfn.py_splitlines(content)
    return df.withColumns(
        {
            "special_ratio": textfn.special_char_ratio(content),
            "clean_content": clean,
            "content_length": F.length(clean),
            "number_of_lines": F.size(lines),
            "comment_ratio": textfn.comment_line_ratio(lines),
        }
    )


def with_code_metrics(df: DataFrame, content: str = "content", cleaned: str = "clean_content") -> DataFrame:
    """Syntax, complexity, maintainability and structure: one parse of each text in one Arrow call."""
    out = df.withColumn("__m", pyast.code_metrics(F.col(content), F.col(cleaned)))
    fields = [f.split(" ")[0] for f in pyast._fields(pyast.METRICS)]
    return out.select(*df.columns, *(F.col(f"__m.{f}").alias(f) for f in fields))


def rule_label(cfg: PipelineConfig = PipelineConfig()) -> Column:
    """1 for good, 0 for bad: too short, not parsable, too complex or hardly maintainable."""
    bad = (F.col("content_length") < cfg.min_content_length) | F.col("is_syntax_error") | (F.col("maintainability_index") < cfg.min_maintainability)
    if not cfg.legacy_cc:
        bad = bad | (F.col("cyclomatic_complexity") > cfg.max_complexity)
    return F.when(bad, 0).otherwise(1)


def labelled(df: DataFrame, order: str, cfg: PipelineConfig = PipelineConfig(), content: str = "content") -> DataFrame:
    """Cleaned, deduplicated rows with all metrics and ``label``; the cheap length filter runs before any parse."""
    rows = df.orderBy(order).limit(cfg.load_limit) if cfg.load_limit else df
    rows = first_of_each(drop_empty(rows, content), [content], order)
    rows = text_metrics(rows, content).where(F.col("content_length") >= cfg.min_content_length)
    return with_code_metrics(rows, content).withColumn("label", rule_label(cfg))


def pipeline(df: DataFrame, order: str, cfg: PipelineConfig = PipelineConfig(), content: str = "content") -> DataFrame:
    """All rows with ``label`` and ``removed_by`` (null, ``rules``, ``isolation`` or ``lof``): flags by row, so both sets are disjoint."""
    rows = materialize(labelled(df, order, cfg, content), "labelled")
    good = rows.where("label = 1").select(order, *FEATURES)
    after_forest = materialize(isolation_forest(good, order, FEATURES, cfg.contamination, cfg.seed), "forest")
    kept = after_forest.where(~F.col("is_outlier")).select(order, *FEATURES)
    after_lof = local_outlier_factor(kept, order, FEATURES, cfg.neighbours, cfg.contamination)
    marks = (
        after_forest.where("is_outlier").select(order, F.lit("isolation").alias("__by"))
        .unionByName(after_lof.where("is_outlier").select(order, F.lit("lof").alias("__by")))
    )
    return (
        rows.join(marks, order, "left")
        .withColumn("removed_by", F.coalesce("__by", F.when(F.col("label") == 0, F.lit("rules"))))
        .withColumn("label", F.when(F.col("removed_by").isNull(), 1).otherwise(0))
        .drop("__by")
    )


def good(rows: DataFrame) -> DataFrame:
    return rows.where("label = 1").drop("removed_by")


def bad(rows: DataFrame) -> DataFrame:
    """The union of rule-bad rows and removed outliers."""
    return rows.where("label = 0")


def stage_counts(rows: DataFrame) -> DataFrame:
    """Rows per fate of the whole pipeline's result."""
    return rows.groupBy(F.coalesce("removed_by", F.lit("kept")).alias("stage")).agg(F.count("*").alias("n_rows"))


STAGES = ("loaded", "with_content", "distinct", "long_enough", "good", "bad")


def stage_report(df: DataFrame, order: str, cfg: PipelineConfig = PipelineConfig(), content: str = "content") -> DataFrame:
    """(stage, n_rows) after each of ``STAGES`` up to the rule label: what is loaded, has content, is distinct, is long enough, and how
    the latter are labelled."""
    filled = drop_empty(df, content)
    distinct = text_metrics(first_of_each(filled, [content], order), content)
    kept = with_code_metrics(distinct.where(F.col("content_length") >= cfg.min_content_length), content).select(rule_label(cfg).alias("label"))
    count = lambda rows, stage: rows.agg(F.count("*").alias("n_rows")).select(F.lit(stage).alias("stage"), "n_rows")
    label = F.when(F.col("label") == 1, "good").otherwise("bad")
    labels = kept.groupBy(label.alias("stage")).agg(F.count("*").alias("n_rows"))
    labels = labels.unionByName(df.sparkSession.createDataFrame([("good", 0), ("bad", 0)], "stage string, n_rows long")).groupBy("stage").agg(F.sum("n_rows").alias("n_rows"))
    return count(df, STAGES[0]).unionByName(count(filled, STAGES[1])).unionByName(count(distinct, STAGES[2])).unionByName(labels.agg(F.sum("n_rows").alias("n_rows")).select(F.lit(STAGES[3]).alias("stage"), "n_rows")).unionByName(labels)


def run(spark: SparkSession, cfg: PipelineConfig, order: str, content: str = "content", fmt: str = "parquet") -> DataFrame:
    """The pipeline from ``cfg.source`` to both line files: good rows to ``cfg.good_path``, all others to ``cfg.bad_path``, without the
    comment-free copy of the text; returns the rows per fate."""
    rows = materialize(pipeline(documents(spark, cfg.source, fmt), order, cfg, content), "pipeline")
    write_jsonl(good(rows).drop("clean_content"), cfg.good_path)
    write_jsonl(bad(rows).drop("clean_content"), cfg.bad_path)
    return stage_counts(rows)


def union_of_sets(*parts: DataFrame) -> DataFrame:
    """All rows of all parts; columns that a part lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def without(df: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among ``removed``; rows with a null key stay."""
    return df.join(removed.select(key).distinct(), key, "left_anti")

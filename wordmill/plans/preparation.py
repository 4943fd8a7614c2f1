"""Corpus preparation: clean, tokenise, drop stopwords, stem, label, split, write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.functions.constants import PLACEHOLDERS, RELIABLE
from wordmill.functions.entities import entity_list, mark_entities
from wordmill.functions.labels import text_label
from wordmill.functions.stemming import stem_tokens
from wordmill.functions.text import remove_stopwords, tokens_of_marked
from wordmill.operators.combine import labelled_union, union_left_columns, with_constant
from wordmill.operators.splits import exact_split
from wordmill.sources.readers import read_inferred_csv, read_text_csv, read_three
from wordmill.sources.writers import write_processed, write_splits
from wordmill.session import stage, staging


def derived_columns(column: str) -> list[str]:
    tokens = [f"{column}-tokens", f"{column}-tokens_no_stop", f"{column}-tokens_stemmed"]
    return [*PLACEHOLDERS, *tokens]


def prepare(df: DataFrame, column: str = "content") -> DataFrame:
    """Adds the four entity arrays and the three token arrays; drops rows without any token left.

    Row-local, so it runs on batch and streaming frames alike and shuffles nothing. Rows are
    dropped before stemming: a stem of a token is never empty.
    """
    if column not in df.columns:
        raise ValueError(f"column {column!r} not found")
    tokens, kept, stemmed = derived_columns(column)[-3:]
    marked = df.withColumn("_marked", mark_entities(F.col(f"`{column}`")))
    tokenised = marked.withColumns(
        {kind: entity_list(F.col("_marked"), kind) for kind in PLACEHOLDERS}
        | {tokens: tokens_of_marked(F.col("_marked"))}
    ).drop("_marked")
    # The generator emits one row or none, and keeps the test behind the tokens it needs: a plain
    # filter would be pushed below them and clean every text a second time.
    none_left = F.filter(
        F.array(F.struct(remove_stopwords(F.col(f"`{tokens}`")).alias(kept))),
        lambda row: F.size(row[kept]) > 0,
    )
    rest = [F.col(f"`{c}`") for c in tokenised.columns]
    filtered = tokenised.select(*rest, F.inline(none_left))
    return filtered.withColumn(stemmed, stem_tokens(F.col(f"`{kept}`")))


def split_columns(df: DataFrame, column: str = "content", type_column: str = "type") -> DataFrame:
    """What a split file holds: no raw text, no intermediate tokens, and ``label`` last."""
    if type_column not in df.columns:
        raise ValueError(f"column {type_column!r} not found")
    slim = df.drop(column, f"{column}-tokens", f"{column}-tokens_no_stop")
    return slim.withColumn("label", text_label(F.col(type_column)))


def reduced(df: DataFrame, column: str = "content", label: str = "label") -> DataFrame:
    """Label and stems only: all the classifiers read. ``label="type"`` for statements."""
    return df.select(label, f"{column}-tokens_stemmed")


def add_articles(news: DataFrame, articles: DataFrame) -> DataFrame:
    """News plus scraped articles, which all count as reliable, under the columns of the news."""
    return union_left_columns(news, with_constant(articles, "type"))


def prepare_single(
    df: DataFrame, keys: list[str], path: str, column: str = "content", seed: int = 42,
    val_positive_label: str = RELIABLE, keep_processed: bool = False,
) -> None:
    """One corpus and its labelled 80/10/10 splits, these to ``path/splits``.

    The processed corpus is staged in the shared folder, so that counting for the split and writing
    the splits do not clean the texts again, and removed when the splits are written.
    ``keep_processed`` writes it to ``path`` as CSV too.
    """
    with staging(df.sparkSession):
        processed = stage(prepare(df, column))
        write_processed(processed, f"{path.rstrip('/')}/processed_csv", keep_processed)
        placed = exact_split(processed, keys, seed)
        label = F.when(
            F.col("split") == "val", text_label(F.col("type"), val_positive_label)
        ).otherwise(F.col("label"))
        write_splits(split_columns(placed, column).withColumn("label", label), f"{path.rstrip('/')}/splits")


def prepare_three_frames(frames: dict[str, DataFrame], path: str, column: str = "content") -> None:
    """Three given frames, e.g. of ``read_statements``, to ``path/splits``; each keeps its rows."""
    joined = prepare(labelled_union(frames), column)
    write_splits(split_columns(joined, column), f"{path.rstrip('/')}/splits")


def prepare_three(spark, paths: dict[str, str], path: str, column: str = "content", **options) -> None:
    """Three given files to ``path/splits``; each file keeps its rows and is not shuffled."""
    frame = read_three(spark, paths, **options)
    write_splits(split_columns(prepare(frame, column), column), f"{path.rstrip('/')}/splits")


def combine_files(spark, news_path: str, articles_path: str, **options) -> DataFrame:
    """News and article files with inferred types, combined."""
    return add_articles(
        read_inferred_csv(spark, news_path, **options), read_inferred_csv(spark, articles_path, **options)
    )


def prepare_file(spark, source: str, keys: list[str], path: str, **options) -> None:
    """``prepare_single`` on a CSV file read as text."""
    prepare_single(read_text_csv(spark, source), keys, path, **options)

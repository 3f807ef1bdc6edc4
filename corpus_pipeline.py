"""A training corpus from raw documents: toxicity, line dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``, with texts, rows and row
counts as the stage decides. Null, empty and repeated rows are treated as the operator of the stage says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimscope.llm.common import stored, table, word_count
from claimscope.llm.line_dedup import dedup_lines
from claimscope.llm.mixing import mix
from claimscope.llm.near_dedup import near_dedup
from claimscope.llm.packing import pack
from claimscope.llm.queries import tokenizer_path
from claimscope.llm.toxicity import learn, score_toxicity
from claimscope.session import delete, fresh_dir, scratch


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows under names that no operator uses, and the new name of each column."""
    names = {name: f"_c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))]), names


def _back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"_c{i}").alias(name) for i, name in enumerate(docs.columns)])


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """With ``_row``: a number of its own for each row, which stays with it. Ids may be null or come twice."""
    return stored(rows.withColumn("_row", F.monotonically_increasing_id()), name)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the model of the labelled documents finds toxic go."""
    model = learn(docs, table(spark, sf_dir, "labels"))
    rows, names = _plain(docs)
    scored = score_toxicity(rows, model, names["doc_id"], names["text"])
    return _back(scored.where("predicted = 0"), docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; ``n_chars`` follows the text. A document that had words and has none left goes
    too: all that it said is in others. One that had none to begin with stays."""
    rows, names = _plain(docs)
    text = names["text"]
    rows = rows.withColumn("_had", word_count(F.col(text)) > 0)
    out = dedup_lines(rows, names["doc_id"], text).where((word_count(F.col(text)) > 0) | ~F.col("_had"))
    if "n_chars" in names:
        out = out.withColumn(names["n_chars"], F.char_length(text).cast(docs.schema["n_chars"].dataType))
    return _back(out, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, by five-word shingles at 0.8, the row with the smallest id stays.

    Every row is a document of its own, whether or not its id is null or comes again: null ids come after all others, and
    of rows that are copies and share an id the one whose text has the smallest hash stays. Texts without words are no copies and stay.
    """
    rows, names = _plain(docs)
    rows = _numbered(rows, "near-rows")
    found = near_dedup(rows, "_row", names["text"]).select("_row", "component_id")
    doc_id = F.col(names["doc_id"]).cast("long")
    place = F.struct(doc_id.isNull().alias("_null"), doc_id.alias("_id"), F.xxhash64(names["text"]).alias("_hash"), "_row")
    first = found.join(rows.select("_row", place.alias("_place")), "_row").groupBy("component_id").agg(F.min("_place").alias("_first"))
    return _back(rows.join(first.select("_first._row"), "_row", "left_semi"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix doesn't take go; those that it takes twice come twice. Each row follows its own place in the mix."""
    rows, names = _plain(docs)
    rows = _numbered(rows, "mix-rows")
    taken = mix(rows, names["doc_id"], names["text"], names["source"], row_col="_row").where("copies > 0")
    found = rows.join(taken.select("_row", F.col("copies").alias("_copies")), "_row")
    return _back(found.withColumn("_n", F.explode(F.sequence(F.lit(1), "_copies"))), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document in a sequence; a document that comes twice is packed twice."""
    return pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the learned model nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage stores on its way goes when its rows are written, and those of the stage
    before go with it, so the shared folder holds two stages at most; an executor lost meanwhile costs the running stage's tasks only."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_dir(spark, f"pipeline-{name}")
        with scratch(spark, f"pipeline-{name}-steps"):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs

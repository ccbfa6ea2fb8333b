"""Text vectors, retrieval through an inverted index, and prompt assembly."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.text import PROMPT, fill_template, format_passages
from tablewright.operators.term_index import TermIndex, best_matches


def fit_text_vectors(docs: DataFrame, text: str = "content", dimensions: int = 256) -> PipelineModel:
    """Word counts hashed into a fixed number of dimensions, weighted by rarity, unit length."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"\W+"),
            HashingTF(inputCol="__words", outputCol="__counts", numFeatures=dimensions),
            IDF(inputCol="__counts", outputCol="__weighted"),
            Normalizer(inputCol="__weighted", outputCol="__unit", p=2.0),
        ]
    ).fit(docs)


def embed_text(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``vector``, an array of floats."""
    return model.transform(df).select(*df.columns, vector_to_array("__unit", "float32").alias("vector"))


def assemble_prompts(hits: DataFrame, questions: DataFrame, docs: DataFrame, template: str = PROMPT) -> DataFrame:
    """One row per question with its passages in rank order and the filled-in prompt.

    ``hits`` holds query_id, rank and corpus_id, at most k rows per question.
    """
    passages = (
        hits.join(docs.select(F.col("id").alias("corpus_id"), "content"), "corpus_id")
        .groupBy("query_id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "content"))).alias("__ranked"))
        .select("query_id", F.col("__ranked.content").alias("passages"))
    )
    return questions.join(passages, questions["id"] == passages["query_id"]).select(
        "id", "question", "passages",
        fill_template(template, context=format_passages("passages")).alias("system_prompt"),
    )


def retrieve_context(questions: DataFrame, docs: DataFrame, index: TermIndex, k: int = 3) -> DataFrame:
    """Search and assemble: questions ``(id, question)``, documents ``(id, content)`` and their index."""
    return assemble_prompts(best_matches(questions, index, k), questions, docs)
